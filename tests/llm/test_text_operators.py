"""Operators that look at one text at a time, against the libraries and plain Python."""

import base64
import math
import random
import re
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers as P
import pyarrow as pa
import pytest
import sentencepiece
import tiktoken

from siftwell.llm import attention, byte_bpe, lm_scoring, quality, slices, token_counts

RANKS, MODEL = P.path("byte_bpe_multi_50k.tiktoken"), P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def tik():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(RANKS, "rb"))}
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def piece():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def encode_all(bpe, texts):
    out = []
    for chunk in slices.chunks(pa.array(texts)):
        ids, edges = bpe.encode_chunk(chunk)
        out += [ids[a:b].tolist() for a, b in zip(edges, edges[1:])]
    return out


def test_bpe_is_the_library_on_random_texts(tik):
    chance, alphabet = random.Random(1), "ab's tmdrevl\n\t  1! é中'😀　 Ǆ½"
    texts = ["".join(chance.choice(alphabet) for _ in range(chance.randint(0, 14))) for _ in range(20_000)]
    texts += ["ab" * 5000 + "é" * 3000, "", "'", "''s", " 's"]
    assert encode_all(byte_bpe.load(RANKS), texts) == tik.encode_ordinary_batch(texts)


def test_bpe_classes_of_all_code_points(tik):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}a 1{chr(c)}1 {chr(c)} .{chr(c)}. " for c in points[k : k + 512]) for k in range(0, len(points), 512)]
    assert encode_all(byte_bpe.load(RANKS), texts) == tik.encode_ordinary_batch(texts)


def test_bpe_offsets_and_ranges():
    bpe, text = byte_bpe.load(RANKS), "déjà vu, it's 42 times"
    ids = bpe.encode(text)
    offsets = bpe.offsets(ids)
    part, start, end = bpe.decode_range(ids, offsets, 2, 5)
    assert text.encode()[start:end] == part and bpe.decode(ids) == text.encode()


def test_bpe_query(spark, documents, texts, tik):
    for r in byte_bpe.round_trip(documents, RANKS).collect():
        ids = tik.encode_ordinary(texts[r.doc_id] or "")
        assert r.n_tokens == len(ids) and r.ids_sha256 == sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == sha256((texts[r.doc_id] or "").encode()).hexdigest()


def test_bpe_odd_rows(odd, empty, tik):
    rows = byte_bpe.encode(odd, RANKS).collect()
    want = sorted((str(r.doc_id), tik.encode_ordinary(r.text or "")) for r in odd.collect())
    assert sorted((str(r.doc_id), r.ids) for r in rows) == want
    back = byte_bpe.decode(byte_bpe.encode(odd, RANKS), RANKS).collect()
    assert Counter(r.text for r in back) == Counter(r.text or "" for r in odd.collect())
    assert byte_bpe.round_trip(empty, RANKS).count() == 0
    whole = byte_bpe.encode_documents(odd, RANKS)
    assert whole.count() == odd.count() and "text" not in whole.columns and "size" in whole.columns


def test_prefix_counts_are_the_library(texts, piece):
    counter, chance = token_counts.load(MODEL), random.Random(3)
    for text in list(texts.values())[:40]:
        part = text[: chance.randint(0, 120)]
        assert counter.prefix_counts(part) == [len(piece.encode(part[:k])) for k in range(len(part) + 1)]
    alphabet = ["a", " ", "  ", "▁", "é", "中", "😀", "\n", "the", "<s>", "</s>", "<unk>", "<0x0A>", "\x00", "    ", "ing"]
    for _ in range(3000):
        text = "".join(chance.choice(alphabet) for _ in range(chance.randint(0, 10)))
        assert counter.count(text) == len(piece.encode(text)), text


def test_token_budget(odd, empty, documents, texts, piece):
    for r in token_counts.budget(documents, MODEL, 300).collect():
        raw = (texts[r.doc_id] or "").encode()
        assert (r.n_bytes, r.n_tokens) == (len(raw), len(piece.encode(texts[r.doc_id] or "")))
        assert r.over_limit == (r.n_tokens > 300)
        assert len(piece.encode(raw[: r.bytes_within].decode())) <= 300
    rows = token_counts.budget(odd, MODEL, 4).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in rows) == Counter((r.doc_id, len(piece.encode(r.text or ""))) for r in odd.collect())
    assert token_counts.budget(empty, MODEL, 4).count() == 0
    cut = token_counts.truncate(odd.where("doc_id < 15 AND doc_id <> 7"), MODEL, 5).collect()
    assert all(len(piece.encode(r.text or "")) <= 5 for r in cut) and any(r.text is None for r in cut)
    table = token_counts.prefix_table(odd, MODEL).collect()
    assert all((r.tokens or [0])[-1] >= len(r.tokens) / 2 for r in table)


def measures(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    seen = Counter(zip(words, words[1:], words[2:]))
    again = [False] * len(words)
    for k in range(len(words) - 2):
        if seen[tuple(words[k : k + 3])] > 1:
            again[k] = again[k + 1] = again[k + 2] = True
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    failed = len(words) < 50 or 100 * sum(again) > 50 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), sum(again), failed


def test_quality_measures(odd, empty, documents, texts):
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    for r in quality.judge(documents).collect():
        assert tuple(r[n] for n in names) == measures(texts[r.doc_id])
        assert not (r.kept and r.base_failed)
    got = Counter((r.doc_id, *(r[n] for n in names)) for r in quality.judge(odd).collect())
    assert got == Counter((r.doc_id, *measures(r.text)) for r in odd.collect())
    assert quality.judge(empty).count() == 0 and quality.keep_good(empty).columns == empty.columns


def test_quality_bands(spark):
    chance = random.Random(5)
    noise = base64.b64encode(chance.randbytes(6000)).decode()
    texts = {
        "prose": " ".join(chance.choice(["river", "stone", "light", "under", "mountain", "seven", "quietly"]) + str(k % 13) for k in range(400)),
        "noise": " ".join(noise[k : k + 9] for k in range(0, len(noise), 9)),
        "cycle": " ".join(f"a{k % 3}b" for k in range(3000)),
    }
    docs = spark.createDataFrame(list(enumerate(texts.values())), "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in quality.judge(docs).collect()}
    assert kept == {0: True, 1: False, 2: False}
    assert [r.doc_id for r in quality.keep_good(docs).collect()] == [0]


def test_lm_base_and_held_out(documents, texts, words_of):
    rows = {r.doc_id: r for r in lm_scoring.score(documents, RANKS).collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in texts}
    words = {i: [*words_of(t), None] for i, t in texts.items()}
    count = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(count.values()), len(count)
    assert rows.keys() == texts.keys()
    for i, r in rows.items():
        base = sum(math.log10((count[w] + 1) / (n + v + 1)) for w in words[i])
        assert (r.held_out, r.n_tokens, r.train_tokens) == (held[i], len(words[i]), n)
        assert r.n_known == sum(count[w] > 0 for w in words[i])
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.score < 0
    # Far better than every subword being equally likely.
    bpe = byte_bpe.load(RANKS)
    subwords = sum(len(bpe.encode(" " + w)) for i, ws in words.items() if held[i] for w in ws if w) + sum(held.values())
    assert sum(rows[i].score for i in rows if held[i]) > -subwords * math.log10(attention.TOKENS) * 0.62


def test_lm_odd_rows(odd, empty):
    rows = lm_scoring.score(odd, RANKS).collect()
    assert len(rows) == odd.count() and all(np.isfinite(r.score) and np.isfinite(r.base_score) for r in rows)
    assert {r.n_tokens for r in rows if r.doc_id in (1, 2, 3)} == {1}
    assert lm_scoring.score(empty, RANKS).count() == 0


def test_lm_trains_on_every_window_of_every_text(spark):
    """Texts of one to many windows, and texts that share their first word."""
    texts = [" ".join(f"w{k}" for k in range(n)) for n in range(1, 60)] + [f"same opening {n}" for n in range(40)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    encoder = lm_scoring.Encoder(RANKS)
    size = len(encoder.bpe.tokens)
    compact = lm_scoring.Compact(np.zeros(0, np.int64), np.zeros(0, np.int64), size)
    rows = lm_scoring.training_windows(docs, RANKS, spark.sparkContext.broadcast(compact)).collect()
    want = Counter()
    for t in texts:
        words = (t or "").split()
        ids = compact.of[[i for w in words for i in encoder.bpe.encode(" " + w)] + [encoder.end]]
        table, _, _ = attention.text_windows(ids, np.array([0, len(ids)]))
        want.update(r.tobytes() for r in table)
    assert Counter(bytes(r.window) for r in rows) == want
    assert {r.round for r in rows} <= set(range(lm_scoring.ROUNDS))


def test_lm_windows_of_like_texts_spread_over_shards(spark):
    """Empty texts, copies and texts with one opening, all with documents of their own."""
    docs = spark.createDataFrame([(k, ["", "same opening", f"same {k}"][k % 3]) for k in range(300)], "id long, text string")
    compact = lm_scoring.Compact(np.zeros(0, np.int64), np.zeros(0, np.int64), len(byte_bpe.load(RANKS).tokens))
    rows = lm_scoring.training_windows(docs, RANKS, spark.sparkContext.broadcast(compact)).collect()
    assert len({r.shard for r in rows}) == len(rows) == 300
    assert min(Counter(r.round for r in rows).values()) > 60


def test_attention_scores_every_token_once_and_learns():
    chance = np.random.default_rng(0)
    texts = [np.r_[np.tile(chance.integers(0, 50, 6), 8)[: chance.integers(1, 48)], attention.END] for _ in range(400)]
    edges = np.r_[0, np.cumsum([len(t) for t in texts])]
    rows, owner, real = attention.text_windows(np.concatenate(texts), edges)
    targets = rows[:, -attention.SCORED :]
    kept = np.arange(attention.SCORED)[None, :] < real[:, None]
    assert np.array_equal(targets[kept], np.concatenate(texts))
    assert np.array_equal(np.bincount(owner, weights=real), np.diff(edges))
    flat = np.concatenate(texts)
    before = np.r_[attention.START, flat[:-1]]
    before[edges[:-1]] = attention.START
    biases = attention.Biases(before, flat, np.ones(len(flat), np.float32))
    trainer = attention.Trainer(attention.initial(), biases)
    first = attention.log_probs(trainer.params, biases, rows)[kept].mean()
    for _ in range(6):
        for k in range(0, len(rows), 32):
            trainer.batch(rows[k : k + 32])
    last = attention.log_probs(trainer.params, biases, rows)[kept].mean()
    assert last > first + 0.2
    # What comes later in a window changes nothing before it.
    changed = rows.copy()
    changed[:, -1] = 7
    one, two = (attention.log_probs(trainer.params, biases, x)[:, :-1] for x in (rows, changed))
    assert np.allclose(one, two, atol=1e-5)


def test_attention_is_a_distribution():
    biases = attention.Biases(np.array([1, 1, 2]), np.array([3, 4, 5]), np.ones(3, np.float32))
    row = np.full((attention.TOKENS, attention.CONTEXT + 1), attention.START, np.int16)
    row[:, -2], row[:, -1] = 1, np.arange(attention.TOKENS)
    total = np.exp(attention.log_probs(attention.initial(), biases, row)[:, -1].astype(float)).sum()
    assert math.isclose(total, 1.0, rel_tol=1e-3)


def test_words_merged_by_the_library_equal_the_operators_merges():
    """Words of all lengths, known and unknown, with and without the cache, and a cache that is emptied when full."""
    encoder = lm_scoring.Encoder(RANKS)
    words = ["a", "the", "zqxj", "中文😀", "\u00a0\u0085x", "<|endoftext|>", "it's", "x" * 700, "é" * 90, "\x00\x1f", "don't3½"]
    pieces = [b" " + w.encode() for w in words]
    want = [tuple(encoder.bpe.merge(p)) for p in pieces]
    assert encoder.ids_of(pieces) == want
    assert encoder.ids_of(pieces[::-1] + [b" other"])[:-1] == want[::-1]
    assert encoder.ids_of([]) == []
