"""SimHash, clustering and hard negatives, against brute force and SQL."""

import hashlib
import math
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from compare import compare, connect

import __spark_entry__ as entry
from cases import LONG, PLAIN, SF
from siftwell.llm import hard_negatives, lloyd, simhash, slices

SCHEMA = "vec_id long, embedding array<double>, label int, pack string, shard string, id string, v string, p string"
NAMES = ("x",) * 5


def vectors(spark, rows):
    return spark.createDataFrame([(*r, *NAMES) for r in rows], SCHEMA)


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op13_hard_negatives"])
def test_same_rows_as_sql(spark, name):
    got, want = compare(spark, connect(SF), entry.queries()[name], entry.oracle_sql()[name], SF)
    assert got == want


def test_xxh64_equals_the_library():
    rng = np.random.default_rng(5)
    data = rng.integers(0, 256, 5000, dtype=np.uint8)
    lengths = np.r_[np.arange(0, 200), rng.integers(0, 700, 100), 4000]
    starts = np.array([int(rng.integers(0, len(data) - n + 1)) for n in lengths])
    got = simhash.xxh64(data, starts, lengths)
    assert got.tolist() == [xxhash.xxh64_intdigest(data[s : s + n].tobytes(), seed=42) for s, n in zip(starts, lengths, strict=True)]


def plain_print(words):
    shingles = [" ".join(words[k : k + 3]) for k in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, bits=2):
    """Smallest id reachable, by comparing all pairs."""
    nodes = sorted(set(prints.values()))
    above = list(range(len(nodes)))

    def top(k):
        while above[k] != k:
            k = above[k]
        return k

    values = np.array(nodes, np.uint64)
    for k in range(len(nodes)):
        for j in np.flatnonzero(np.bitwise_count(values[k + 1 :] ^ values[k]) <= bits) + k + 1:
            above[top(int(j))] = top(k)
    least = {}
    root = {p: top(k) for k, p in enumerate(nodes)}
    for i, p in prints.items():
        if i is not None:
            least[root[p]] = min(i, least.get(root[p], i))
    return {i: least.get(root[p]) for i, p in prints.items()}


def test_simhash(documents, texts, words_of):
    prints = {i: plain_print(words_of(t)) for i, t in texts.items()}
    want = plain_components(prints)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(documents).collect()}
    assert got == {i: (f"{p:016x}", want[i]) for i, p in prints.items()}


def test_simhash_odd_rows(odd, empty, words_of):
    assert simhash.near_duplicates(empty).collect() == []
    source = odd.select("doc_id", "text").collect()
    got = sorted((r.doc_id if r.doc_id is not None else -1, r.fingerprint) for r in simhash.near_duplicates(odd).collect())
    assert got == sorted((r.doc_id if r.doc_id is not None else -1, f"{plain_print(words_of(r.text)):016x}") for r in source)
    component = {(r.doc_id, r.fingerprint): r.component_id for r in simhash.near_duplicates(odd).collect()}
    zero = "0" * 16
    # Null, empty and blank texts have fingerprint zero, and a row without an id is linked like them.
    assert {component[k] for k in ((1, zero), (2, zero), (3, zero), (None, zero))} == {1}
    plain = f"{plain_print(words_of(PLAIN)):016x}"
    assert {component[4, plain], component[5, plain], component[None, plain]} == {4}


def test_chunks_of_any_size_give_one_fingerprint(words_of):
    column = pa.array([LONG, None, "a b", PLAIN])
    for limit in (1, 50_000, 1 << 22):
        got = np.concatenate([simhash.chunk_fingerprints(c) for c in slices.chunks(column, limit)])
        assert got.tolist() == [plain_print(words_of(t)) for t in column.to_pylist()]


def test_a_byte_is_determined_by_its_differences():
    prints = np.arange(256, dtype=np.uint64) << np.uint64(16)
    table = simhash.distance_table(prints).reshape(-1, 9, 8).astype(int)
    differ = table[:, 0] - table[:, 3]
    assert len(np.unique(differ, axis=0)) == 256
    assert (table[:, 0] - table[:, 2] == (table[:, 0] - table[:, 2])[0]).all()


@pytest.mark.parametrize("bits", [0, 1, 2])
def test_print_links_on_dense_groups(spark, bits):
    """A large group around one fingerprint, chains at every distance up to three, and random ones."""
    rng = random.Random(bits)
    centre = rng.getrandbits(64)
    prints = {centre}
    while len(prints) < 1500:
        prints.add(centre ^ sum(1 << b for b in rng.sample(range(16), rng.randint(1, 4))))
    for step in (1, 2, 3):
        at = rng.getrandbits(64)
        for _ in range(60):
            at ^= sum(1 << b for b in rng.sample(range(64), step))
            prints.add(at)
    prints |= {rng.getrandbits(64) for _ in range(400)}
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    nodes = spark.createDataFrame([(p,) for p in signed], "print long").repartition(5)
    from siftwell.llm.links import components

    links = simhash.print_links(nodes, bits)
    # In a file there are fewer links than nodes: parts are joined, pairs are not listed.
    assert links.count() < 28 * len(prints)
    label = {r.node: r.component for r in components(links).collect()}
    by_label = {}
    for p in signed:
        by_label.setdefault(label.get(p, p), set()).add(p)
    want = {}
    for i, c in plain_components({p: p % (1 << 64) for p in signed}, bits).items():
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, by_label.values())) == sorted(map(sorted, want.values()))


def test_a_file_is_compared_by_cells():
    rng = np.random.default_rng(3)
    prints = np.unique(rng.integers(0, 1 << 16, 3000).astype(np.uint64))
    table = simhash.distance_table(prints)
    listed = set()
    for a, b in simhash.cell_pairs(table, 2):
        listed |= set(zip(np.minimum(a, b).tolist(), np.maximum(a, b).tolist(), strict=True))
    near = {
        (k, int(j)) for k in range(len(prints))
        for j in np.flatnonzero(np.bitwise_count(prints[k + 1 :] ^ prints[k]) <= 2) + k + 1
    }
    assert near <= listed
    assert len(listed) < len(prints) * (len(prints) - 1) / 2 * 0.5


def plain_lloyd(rows, k, rounds, dims):
    """Python integers only."""
    kept = [
        (i, [math.floor(256 * x) for x in v]) for i, v, *_ in rows
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) and abs(256 * x) < (1 << 27) - 1 for x in v)
    ]
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest(), r[1]))
    centres = [v for _, v in order[:k]]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in kept:
            groups.setdefault(near(v)[1], []).append(v)
        for n, g in groups.items():
            centres[n] = [sum(x) // len(g) for x in zip(*g, strict=True)]
    found = [(i, near(v)) for i, v in kept]
    inertia = sum(d for _, (d, _) in found)
    own = {}
    for _, (d, n) in found:
        own[n] = own.get(n, 0) + d
    small = lambda x: x if x < 1 << 63 else None
    return sorted(
        ((-1 if i is None else i), n, d, small(own[n]), small(inertia), hashlib.sha256(",".join(map(str, centres[n])).encode()).hexdigest())
        for i, (d, n) in found
    )


def clusters(df):
    return sorted(
        ((-1 if r.vec_id is None else r.vec_id), r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
        for r in df.collect()
    )


@pytest.mark.parametrize(("k", "size"), [(4, 1.0), (4, 9000.0), (3, 500_000.0), (40, 1.0)])
def test_clustering_equals_plain_integers(spark, k, size):
    """Packs and blocks of several sizes, ties, repeated ids and rows, and everything that takes no part."""
    rng = random.Random(k)
    rows = [(i, [rng.uniform(-size, size) for _ in range(20)], 0) for i in range(60)]
    rows += [(i, [float(i % 3)] * 20, None) for i in range(60, 80)]
    rows += [rows[5], rows[61], (5, rows[6][1], 0), (None, rows[8][1], 1)]
    rows += [(100, None, 1), (101, [], 1), (102, [1.0] * 19, 1), (103, [None] + [1.0] * 19, 1)]
    rows += [(104 + j, [x] + [1.0] * 19, 1) for j, x in enumerate((math.nan, math.inf, -math.inf, 1e30))]
    df = vectors(spark, rows).repartition(3)
    assert clusters(lloyd.cluster(df, k=k, rounds=3, dims=20)) == plain_lloyd(rows, k, 3, 20)


def test_clustering_of_nothing_and_of_few(spark):
    assert lloyd.cluster(vectors(spark, []), dims=3).collect() == []
    assert lloyd.cluster(vectors(spark, [(1, None, 1)]), dims=3).collect() == []
    rows = [(1, [0.5, 0.25, 0.0], 1), (2, [0.5, 0.25, 0.0], 1)]
    assert clusters(lloyd.cluster(vectors(spark, rows), dims=3)) == plain_lloyd(rows, 40, 5, 3)


def test_partial_distances_add_up():
    rng = np.random.default_rng(1)
    for top in (100, lloyd.LIMIT - 1):
        values = rng.integers(-top, top, (50, 64)).astype(np.int32)
        centres = rng.integers(-top, top, (7, 64))
        parts = [lloyd.partial_distances(values[:, c : c + 16], centres[:, c : c + 16]) for c in range(0, 64, 16)]
        want = [[sum((int(a) - int(b)) ** 2 for a, b in zip(v, c, strict=True)) for c in centres] for v in values]
        assert sum(p.astype(object) for p in parts).tolist() == want


@pytest.mark.parametrize(("top", "width"), [(3, 1), (257, 64), (2**15, 700), (2**26, 64), (60, 2500)])
def test_residue_products_are_exact(top, width):
    rng = np.random.default_rng(width)
    rows, anchors = rng.integers(-top, top + 1, (30, width)), rng.integers(-top, top + 1, (8, width))
    largest = max(hard_negatives.largest_norm(rows), hard_negatives.largest_norm(anchors))
    primes = hard_negatives.moduli(largest)
    assert math.prod(primes) > 2 * largest
    got = hard_negatives.ResidueMatrix(rows, primes).scores(anchors)
    want = [[sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for y in rows] for x in anchors]
    assert got.tolist() == want


def plain_negatives(rows, every):
    kept = [
        (i, (label + 1) % 10 if i % 7 == 0 else label, [math.floor(256 * x) for x in v]) for i, v, label in rows
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) and abs(x) < 2**40 for x in v)
    ]
    kept = [r for r in kept if sum(x * x for x in r[2]) < 2**61]
    out = []
    for i, label, v in kept:
        if i % every:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=False)), j, other) for j, other, w in kept)
        for s, j, _ in [r for r in scored if r[2] == label and r[1] != i][:5]:
            window = [r for r in scored if r[2] != label and 80 * -s <= 100 * -r[0] <= 100 * -s][:5]
            out += [(i, j, n, r[1], -s, -r[0]) for n, r in enumerate(window, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1.0, 3000.0, 4e6])
def test_hard_negatives_equal_plain_integers(spark, monkeypatch, size):
    """A grid of many cells, ties, hot labels, short vectors, and everything that takes no part."""
    rng = random.Random(3)
    rows = [(i, [size * (i % 5 + rng.uniform(-1, 1)) for _ in range(12)], 0 if i % 3 else i % 10) for i in range(300)]
    rows += [(300 + j, [size] * 12, j % 2) for j in range(20)]
    rows += [(400, [], 1), (401, [size] * 3, 1), (402, [-size] * 12, 0)]
    rows += [(None, [size] * 12, 0), (500, None, 0), (501, [size] * 12, None), (502, [None] * 12, 1), (503, [math.nan] * 12, 1)]
    rows += [(504, [math.inf] * 12, 1), (505, [1e15] * 12, 1), (506, [9e6] * 12, 1)]
    monkeypatch.setattr(hard_negatives, "ROWS", 50)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 6)
    monkeypatch.setattr(hard_negatives, "SCORES", 200)
    got = hard_negatives.mine(vectors(spark, rows), every=20).collect()
    assert sorted(tuple(r) for r in got) == plain_negatives(rows, 20)


def test_hard_negatives_of_nothing(spark):
    assert hard_negatives.mine(vectors(spark, [])).collect() == []
    assert hard_negatives.mine(vectors(spark, [(100, [1.0], 1), (101, None, 2)])).collect() == []
    # Rows that repeat an id are no positives of each other.
    rows = [(100, [1.0, 0.0], 1), (100, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (4, [0.9, 0.0], 2)]
    got = {(r.anchor_id, r.positive_id, r.negative_id) for r in hard_negatives.mine(vectors(spark, rows)).collect()}
    assert got == {(100, 3, 4)}
