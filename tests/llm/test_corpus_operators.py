"""Operators over all texts, against brute force and SQL."""

import re
from collections import Counter, defaultdict

import pytest
from compare import compare, connect

import __spark_entry__ as entry
from cases import LONG, ODD_ROWS, SF
from siftwell.llm import exact, line_dedup, links, mixing, ngram_join, passages, warc

LLM_SQL = ["op3_exact_dedup", "op6_line_dedup", "op7_warc", "op10_mixing"]


@pytest.mark.parametrize("name", LLM_SQL)
def test_same_rows_as_sql(spark, name):
    got, want = compare(spark, connect(SF), entry.queries()[name], entry.oracle_sql()[name], SF)
    assert got == want


def sets_of(rows, words_of):
    out = {}
    for i, text in rows:
        w = words_of(text)
        out[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    return out


def brute_components(sets):
    above = {i: i for i in sets}

    def top(a):
        while above[a] != a:
            a = above[a]
        return a

    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for g in s for j in where[g] if j < i).items():
            if 100 * both >= 75 * len(s | sets[j]):
                a, b = sorted((top(i), top(j)))
                above[b] = a
    return {i: top(i) for i in sets}


def test_ngram_join(documents, texts, words_of):
    sets = sets_of(texts.items(), words_of)
    want = brute_components(sets)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(documents).collect()}
    assert got == {i: (len(sets[i]), want[i]) for i in sets}
    left = {r.doc_id for r in ngram_join.keep_one(documents).collect()}
    assert left == set(want.values())


def test_ngram_join_on_chains_and_hot_groups(spark, words_of):
    """A large group of near copies that are not all alike, a passage that most texts share, and texts at the threshold."""
    base = [f"b{k}" for k in range(60)]
    common = " ".join(f"c{k}" for k in range(20))
    rows = []
    for k in range(150):
        words = list(base)
        words[k * 7 % 60] = f"x{k % 11}"
        rows.append(" ".join(words))
    for k in range(150):
        rows.append(common + " " + " ".join(f"u{k}_{j}" for j in range(k % 30)))
    for k in range(1, 30):
        rows.append(" ".join(f"s{j}" for j in range(k, k + 40)))
    data = list(enumerate(rows))
    want = brute_components(sets_of(data, words_of))
    docs = spark.createDataFrame(data, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(docs).collect()}
    assert got == want


def test_ngram_join_odd_rows(odd, empty, words_of):
    rows = ngram_join.near_duplicates(odd).collect()
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in rows)
    want = {i: len(s) for i, s in sets_of([(r[0], r[1]) for r in ODD_ROWS if r[0]], words_of).items()}
    group = {5: 4, 6: 4, 9: 8}
    expected = Counter((r[0], want[r[0]], group.get(r[0], r[0])) for r in ODD_ROWS if r[0])
    expected += Counter({(None, want[4], 4): 1, (None, 0, None): 1})
    assert got == expected
    assert ngram_join.near_duplicates(empty).count() == 0
    assert ngram_join.keep_one(odd).columns == odd.columns


def test_components(spark):
    chain = [(k, k + 1) for k in range(0, 60)] + [(100 + k, 99) for k in range(50)] + [(7, 7)]
    got = dict(links.components(spark.createDataFrame(chain, "a long, b long")).distinct().collect())
    assert got == {**{k: 0 for k in range(61)}, **{k: 99 for k in range(99, 150)}}
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_prefix_tree_finds_all_pairs():
    import numpy as np

    chance = np.random.default_rng(4)
    base = chance.choice(400, 40, replace=False)
    sets = [np.unique(np.r_[base[chance.random(40) < 0.93], chance.choice(400, 3)]) for _ in range(60)] + [np.zeros(0, int)]
    sizes = np.array([len(s) for s in sets])
    found = {tuple(sorted(p)) for p in ngram_join.PrefixTree(sets, sizes).join()}
    want = {
        (i, j)
        for i in range(60)
        for j in range(i + 1, 60)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 75 * len(np.union1d(sets[i], sets[j]))
    }
    assert want and want <= found and all(p in want or p[1] == 60 for p in found)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_dedup_odd_rows(odd, empty, keep):
    pick = max if keep == "largest" else min
    groups = defaultdict(list)
    for r in ODD_ROWS:
        groups[r[1] or ""].append(r[0])
    want = Counter()
    for ids in groups.values():
        known = [i for i in ids if i is not None]
        own = pick(known) if known else None
        want += Counter((i, own, len(ids), i == own) for i in ids)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact.dedup_report(odd, keep=keep).collect())
    assert got == want
    assert exact.dedup_report(empty).count() == 0
    left = exact.keep_one(odd, keep=keep)
    assert left.columns == odd.columns and Counter(r.doc_id for r in left.collect()) == Counter(i for (i, _, _, k), c in want.items() if k for _ in range(c))


def test_patricia_spills_and_merges():
    trie, total = exact.Patricia(), Counter()
    keys = [bytes([k % 7, k % 3]) * (k % 5 + 1) for k in range(500)]
    for n, key in enumerate(keys):
        trie.insert(key, n)
        if trie.bytes > 2000:
            for k, own, rows in trie.spill(500):
                total[k] += rows
    for k, own, rows in trie.terminals():
        total[k] += rows
    assert total == Counter(keys)
    trie = exact.Patricia()
    for n, key in [(3, b"abc"), (1, b"ab"), (2, b"abc"), (9, b""), (4, b"abd")]:
        trie.insert(key, n)
    assert list(trie.terminals()) == [(b"", 9, 1), (b"ab", 1, 1), (b"abc", 2, 2), (b"abd", 4, 1)]


def test_line_dedup_odd_rows(odd, empty):
    rows = line_dedup.dedup(odd)
    assert rows.columns == odd.columns
    got = {r.doc_id: r.text for r in rows.where("doc_id IN (1, 2, 11, 12)").collect()}
    assert got == {1: "", 2: None, 11: "a\nb\nc\nd", 12: "z"}
    assert rows.count() == odd.count() and line_dedup.report(empty).count() == 0


def test_warc_odd_rows(spark):
    body = "<p>same page " * 20
    rows = [(3, "http://a/\r\nx", body), (1, None, body), (1, "http://a", body), (2, "u", "short"), (4, "u", "short"),
            (5, "u", None), (None, "u", body), (6, "u", LONG)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = Counter((r.page_id, r.payload_bytes, r.record_type, r.refers_to, r.payload) for r in warc.round_trip(pages).collect())
    n = len(body)
    assert got == Counter([
        (3, n, "revisit", 1, None), (1, n, "response", None, body), (1, n, "response", None, body), (2, 5, "response", None, "short"),
        (4, 5, "response", None, "short"), (5, 0, "response", None, ""), (None, n, "revisit", 1, None), (6, len(LONG), "response", None, LONG),
    ])
    assert warc.round_trip(pages.where("false")).count() == 0


def test_warc_header_fields():
    whole = warc.record(1, "u", b"<p>one</p>", 10, "0" * 64, None, False, "2025-05-06T07:08:09Z").split(b"\r\n\r\n")[0].split(b"\r\n")
    again = warc.record(2, "u", b"", 10, "0" * 64, 1, True, "2025-05-06T07:08:09Z").split(b"\r\n\r\n")[0].split(b"\r\n")
    assert all(b"WARC-Date: 2025-05-06T07:08:09Z" in lines for lines in (whole, again))
    assert b"WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" in again
    assert b"WARC-Refers-To: <urn:page:1>" in again and b"Payload-Length: 10" in again
    assert not any(line.startswith((b"WARC-Profile", b"WARC-Refers-To", b"Payload-Length")) for line in whole)


def test_warc_files(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    warc.write(pages, str(tmp_path / "rows"), archive_bytes=50_000)
    (tmp_path / "files").mkdir()
    warc.export(spark, str(tmp_path / "rows"), str(tmp_path / "files"))
    files = list((tmp_path / "files").glob("*.warc.zst"))
    found = [f for p in files for f, _ in warc.unpack(p.read_bytes())]
    assert len(files) > 1 and len(found) == pages.count()
    # A trained dictionary makes small records smaller.
    records = [warc.record(k, "u", f"<html><body><h1>Title {k}</h1><p>Always the same frame</p>".encode(), 9, "0" * 64, None, False) for k in range(200)]
    import zstandard

    alone = sum(len(zstandard.ZstdCompressor().compress(r)) for r in records)
    assert len(warc.pack(records)) < 0.6 * alone


def test_passages(documents, texts, words_of):
    found = passages.near_passages(documents).collect()
    words = {i: words_of(t) for i, t in texts.items()}
    cover = defaultdict(list)
    for r in found:
        cover[r.doc_id].append((r.start_word, r.end_word))
        mine, other = words[r.doc_id][r.start_word : r.end_word], words[r.of_doc_id][r.of_start_word : r.of_end_word]
        a, b = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (mine, other))
        assert len(mine) >= 50 and len(a & b) >= 0.75 * len(a | b) and r.doc_id != r.of_doc_id
    seen = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            key = tuple(words[i][k : k + 50])
            if seen.setdefault(key, i) != i:
                assert any(a <= k and k + 50 <= b for a, b in cover[i]), (i, k)


def edited(words, edits, kind, chance):
    """``words`` with so many words changed, inserted or deleted, spread over the passage."""
    out = list(words)
    for n in range(edits, 0, -1):
        k = len(words) * n // (edits + 1)
        out[k : k + (kind != "inserted")] = [] if kind == "deleted" else [f"new{chance.random()}"]
    return out


def test_verified_finds_edited_passages():
    """All passages of 50 to 150 words with 1 to 3 edits whose shingle sets have similarity 0.75, between words of their own."""
    import random

    import numpy as np

    chance, n_near = random.Random(3), 0
    for length in range(50, 151, 10):
        for edits in (1, 2, 3):
            for kind in ("changed", "inserted", "deleted"):
                a = [f"p{chance.random()}" for _ in range(length)]
                b = edited(a, edits, kind, chance)
                if len(b) < 50:
                    continue
                one, two = ({tuple(w[k : k + 5]) for k in range(len(w) - 4)} for w in (a, b))
                if 4 * len(one & two) < 3 * len(one | two):
                    continue
                n_near += 1
                sides = []
                for w in (b, a):
                    w = [f"x{chance.random()}" for _ in range(30)] + w + [f"y{chance.random()}" for _ in range(40)]
                    sides.append(np.array([hash(tuple(w[k : k + 5])) for k in range(len(w) - 4)]))
                found = passages.verified(*sides, 46)
                assert any(s <= 30 and 30 + len(b) - 4 <= e for s, e, *_ in found), (length, edits, kind)
                for s, e, s2, e2, similarity in found:
                    x, y = set(sides[0][s:e].tolist()), set(sides[1][s2:e2].tolist())
                    assert e - s >= 46 and 0.75 <= similarity == len(x & y) / len(x | y)
    assert n_near > 60


def test_passages_with_edits(spark):
    """The same through the whole operator: every edited passage is reported where it lies."""
    import random

    chance, rows, want = random.Random(4), [], {}
    for length, edits, kind in [(50, 1, "changed"), (60, 1, "changed"), (70, 1, "inserted"), (100, 2, "changed"), (80, 2, "deleted"), (150, 3, "changed"), (55, 1, "deleted")]:
        a = [f"p{chance.random()}" for _ in range(length)]
        for w in (a, edited(a, edits, kind, chance)):
            own = [[f"x{chance.random()}" for _ in range(60)] for _ in range(2)]
            want[len(rows)] = (60, 60 + len(w))
            rows.append((len(rows), " ".join(own[0] + w + own[1])))
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i in range(1, len(rows), 2):
        got = [r for r in found if r.doc_id == i and r.of_doc_id == i - 1]
        assert any(r.start_word <= want[i][0] and want[i][1] <= r.end_word for r in got), (i, want[i], got)


def test_passages_between_first_and_previous(spark):
    """Six texts share too little for a passage, and two of them, neither the first nor neighbours, a whole one around it."""
    import random

    chance = random.Random(5)

    def own(n):
        return [f"x{chance.random()}" for _ in range(n)]

    rows, want = [], {}
    for _ in range(8):
        core, before, after = own(38), own(6), own(6)
        for n in range(6):
            both = n in (2, 4)
            middle = (before if both else own(6)) + core + (after if both else own(6))
            rows.append((len(rows), " ".join(own(30) + middle + own(30))))
        want[len(rows) - 2] = len(rows) - 4
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = {r.doc_id: r.of_doc_id for r in found if r.start_word <= 30 and r.end_word >= 80}
    assert got == want


def test_passages_around_passages_found(spark):
    """The first and the previous text give a passage, and a text between them a longer one around it, by a few words on each side."""
    import random

    chance = random.Random(6)

    def own(n):
        return [f"x{chance.random()}" for _ in range(n)]

    rows, want = [], []
    for _ in range(12):
        core, before, after = own(55), own(2), own(2)
        for n in range(4):
            both = n in (1, 3)
            rows.append((len(rows), " ".join(own(30) + (before if both else own(2)) + core + (after if both else own(2)) + own(30))))
        want.append(len(rows) - 1)
    found = passages.near_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for i in want:
        assert any(r.doc_id == i and r.of_doc_id == i - 2 and r.start_word <= 30 and r.end_word >= 89 for r in found), i


def test_alignments_meet_across_ranges():
    import numpy as np

    for one in range(80, 100):
        seeds = [(f, 200 + f, 60, 60, 200 + f - shift, 60, 60) for f, shift in ((0, one), (1, one + 1))]
        assert passages.met_intervals(np.array(seeds, np.int64), 46), one


def test_stretches_alive_are_those_of_brute_force():
    import numpy as np

    chance = np.random.default_rng(2)
    kind = chance.choice(3, 600, p=[0.6, 0.1, 0.3])
    kind[100:180] = 0
    several, once, edges = kind == 0, kind == 2, np.array([0, 150, 170, 400, 400, 600])
    want = np.zeros(600, bool)
    for a, b in zip(edges[:-1], edges[1:]):
        for x in range(a, b):
            for y in range(x + 15, b + 1):
                if several[x:y].sum() >= 3 * once[x:y].sum():
                    want[max(a, x - 5) : min(b, y + 5)] = True
    assert (passages.alive(several, once, edges, 20) == want).all() and 0 < want.sum() < 600


def test_only_stretches_that_others_have_are_dealt_out(spark):
    """Of texts of their own words nothing is kept, of those that share a passage little more than that; windows come from there alone."""
    import random

    chance = random.Random(7)

    def own(n):
        return [f"x{chance.random()}" for _ in range(n)]

    both = own(60)
    rows = [(k, " ".join(own(500))) for k in range(30)] + [(k, " ".join(own(200) + both + own(200))) for k in (40, 50)]
    kept = passages.kept_stretches(spark.createDataFrame(rows, "id long, text string"), 5, 46)
    got = {r.id: r for r in kept.collect()}
    assert set(got) == {40, 50}
    for r in got.values():
        assert 170 <= r.start <= 200 and r.start + len(r.tokens) // 5 >= 256 and len(r.tokens) // 5 < 56 + 60
    assert 0 < passages.window_rows(kept, 46).count() < 150


def test_passages_odd_rows(odd, empty):
    found = passages.near_passages(odd).collect()
    assert {(r.doc_id, r.of_doc_id, r.whole) for r in found} == {(5, 4, True), (6, 4, False)}
    assert passages.near_passages(empty).count() == 0


def test_cartesian_windows_are_those_of_brute_force():
    import numpy as np

    chance = np.random.default_rng(9)
    order = chance.permutation(300).astype(np.uint64)
    doc = np.repeat([0, 1, 2], [120, 20, 160])
    edges = np.array([0, 120, 140, 300])
    got = set(zip(*(x.tolist() for x in passages.compact_windows(order, doc, 30, edges))))
    want = set()
    for c in range(300):
        a, b = edges[doc[c]], edges[doc[c] + 1]
        left = max([p + 1 for p in range(a, c) if order[p] < order[c]], default=a)
        right = min([p - 1 for p in range(c + 1, b) if order[p] < order[c]], default=b - 1)
        if right - left + 1 >= 30:
            want.add((int(left), c, int(right)))
    assert got == want


def test_mixing_odd_rows(odd, empty):
    rows = mixing.report(odd).collect()
    assert len(rows) == odd.count()
    by_source = defaultdict(list)
    sources = {r[0]: r[3] for r in ODD_ROWS}
    for r in rows:
        assert r.taken <= 3 * r.size
        by_source[sources[r.doc_id]].append(r)
    sizes = {s: sum(r.size for r in rs) for s, rs in by_source.items()}
    total = sum(sizes.values())
    weights, rest, want = {"a": 1, "b": 2, "c": 3, None: 1}, total, {}
    open_sources = set(sizes)
    while True:
        level = rest / sum(weights[s] for s in open_sources)
        over = {s for s in open_sources if level * weights[s] > 3 * sizes[s]}
        if not over:
            break
        want |= {s: 3.0 * sizes[s] for s in over}
        rest -= sum(3.0 * sizes[s] for s in over)
        open_sources -= over
    want |= {s: level * weights[s] for s in open_sources}
    for s, rs in by_source.items():
        assert all(abs(r.target - want[s]) < 1e-6 * total and r.source_size == sizes[s] for r in rs)
    assert mixing.report(empty).count() == 0 and mixing.mix(odd).columns == odd.columns
    assert sorted(map(tuple, rows), key=str) == sorted(map(tuple, mixing.report(odd.repartition(7)).collect()), key=str)


def test_mixing_hits_targets(documents):
    rows = mixing.report(documents).collect()
    taken, target = Counter(), {}
    sources = {r.doc_id: r.source for r in documents.select("doc_id", "source").collect()}
    for r in rows:
        taken[sources[r.doc_id]] += r.taken
        target[sources[r.doc_id]] = r.target
    largest = max(r.size for r in rows)
    assert all(abs(taken[s] - target[s]) <= 2 * largest for s in target)
    mixed = Counter(r.doc_id for r in mixing.mix(documents).collect())
    assert mixed == Counter({r.doc_id: r.copies for r in rows if r.copies})


def test_long_near_copies_are_verified_in_linear_memory():
    """An edited book: every tenth token changed in 60,000, so that runs of shared tokens have very many ends."""
    import tracemalloc

    import numpy as np

    rng = np.random.default_rng(4)
    mine = rng.integers(0, 1 << 30, 60_000).astype(np.int32)
    other = mine.copy()
    other[::10] = rng.integers(0, 1 << 30, 6_000)
    tracemalloc.start()
    found = passages.verified(mine, other, 46)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 1 and found[0][1] - found[0][0] >= 59_990
    assert most < 50e6


def test_blocks_of_long_texts_have_few_members(spark, monkeypatch):
    """A block holds about so many shingles, so its memory does not follow the lengths of its texts; each part has the centre."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", 1000)
    rows = [(1, k, 400) for k in range(1, 42)] + [(100, k, 5) for k in range(100, 140)] + [(7, 7, 5000)]
    parts = defaultdict(set)
    for r in ngram_join.split_blocks(spark.createDataFrame(rows, "block long, id long, n int")).collect():
        parts[r.block, r.part].add(r.id)
    long = [ids for (block, _), ids in parts.items() if block == 1]
    assert len(long) == 16 and all(1 in ids for ids in long) and max(map(len, long)) < 20
    assert set().union(*long) == set(range(1, 42))
    assert sum(map(len, long)) == 40 + 16
    assert [ids for (block, _), ids in parts.items() if block == 100] == [set(range(100, 140))]
    assert [ids for (block, _), ids in parts.items() if block == 7] in ([], [{7}])
