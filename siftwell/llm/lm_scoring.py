"""Language-model scoring: word frequencies as a base, and a causal self-attention model over subword ids.

Texts are lowered (A-Z) and cut into words; an end follows the last word and counts as a token. Documents are for training
unless the CRC-32 of their id as text has remainder ``HELD_OUT`` modulo 7.

1. One pass encodes all texts and writes their subword ids to the shared folder, two bytes each; no later pass reads a text.
2. Passes over the training ids count words, subwords, and pairs of adjacent compact ids; counts are summed per task, then by key.
   The most frequent subwords have compact ids, and pairs of these give the model's fixed frequencies (at most TOKENS squared).
3. Every window of every training text belongs to one of ``ROUNDS`` rounds, by a hash of its document and number. In a round, tasks
   train copies of the model in numpy on the windows of the ids that lie with them, in batches of ``BATCH``; the copies are averaged by
   block of parameters. Nothing but models is shuffled.
4. The last pass scores all texts. Frequent words carry their counts to the tasks (``HEAVY`` words at most); for the others the
   counts are joined by word.

Subwords come from a byte-level vocabulary (words are merged by the tiktoken library), with a blank before each word, so ids spell the words one to one and the score is the
probability of the text. Rare subwords share one compact id, and within it follow their smoothed
frequencies. Null texts are empty: an end alone. Rows are scored one by one, repeated ones too; a null id counts as empty
text for the split. Without training texts the model is what it starts from. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siftwell.llm import attention, byte_bpe, slices
from siftwell.session import cut_lineage, scratch_path

HELD_OUT = 2
ROUNDS = 3
#: Windows that a task trains on in a round, at least where there are so many; windows in a step; windows that are put in random order together.
SHARE = 20_000
BATCH = 64
SHUFFLED = 16_384
HEAVY = 1 << 16
#: Words by the logarithm of their count, in so many steps a doubling.
STEPS = 16
#: Entries that a counting task holds before it passes them on.
COUNTER_ENTRIES = 2_000_000
BLOCKS = 64
#: Bytes of ids that are worked on together.
IDS_BYTES = 1 << 20

WORD, SUBWORD = 0, 1


class Encoder:
    """Words of a chunk as subword ids; the end is one id above the vocabulary, the start two."""

    def __init__(self, ranks_path: str):
        self.bpe = byte_bpe.load(ranks_path)
        self.end = len(self.bpe.tokens)
        self.start = self.end + 1
        if self.start >= 1 << 16:
            raise ValueError("The vocabulary must leave two ids of 16 bits free.")
        #: Whether an id begins a word, or is the end.
        self.opens = np.array([token[:1] == b" " for token in self.bpe.tokens] + [True, True])
        self.library = tiktoken.Encoding("words", pat_str=" [^ ]+", mergeable_ranks=self.bpe.ranks, special_tokens={})
        self.cache: dict[bytes, tuple[int, ...]] = {}

    def ids_of(self, pieces: list[bytes]) -> list[tuple[int, ...]]:
        """The ids of distinct words, each after a blank, from a bounded cache where it has them. The others are merged by the library in one
        call: their ids begin where a token begins with a blank."""
        found = list(map(self.cache.get, pieces))
        missing = [k for k, ids in enumerate(found) if ids is None]
        if not missing:
            return found
        new = [pieces[k] for k in missing]
        flat = self.library.encode_ordinary(b"".join(new).decode())
        starts = np.flatnonzero(self.opens[flat]).tolist()
        merged = [tuple(flat[a:b]) for a, b in zip(starts, [*starts[1:], len(flat)])]
        for k, ids in zip(missing, merged, strict=True):
            found[k] = ids
        if len(self.cache) + len(new) > byte_bpe.CACHE_TOKENS:
            self.cache.clear()
        self.cache.update(zip(new, merged))
        return found

    def chunk(self, chunk: slices.Chunk) -> tuple[np.ndarray, np.ndarray]:
        """Subword ids with the edges of each text, with an end after every text."""
        data = slices.LOWER[chunk.data]
        starts, ends, doc = slices.words(data, chunk.offsets)
        _, one, which = np.unique(slices.hash_spans(data, starts, ends), return_index=True, return_inverse=True)
        raw = data.tobytes()
        pieces = [b" " + raw[a:b] for a, b in zip(starts[one].tolist(), ends[one].tolist())]
        found = self.ids_of(pieces) + [(self.end,)]
        counts = np.bincount(doc, minlength=chunk.docs)
        which = np.insert(which, np.cumsum(counts), len(pieces))
        lengths = np.fromiter(map(len, found), np.int64, len(found))
        table = np.fromiter(chain.from_iterable(found), np.uint16, int(lengths.sum()))
        own = lengths[which]
        ids = slices.ragged(table, (np.cumsum(lengths) - lengths)[which], own)
        return ids, np.r_[0, np.cumsum(own)][np.r_[0, np.cumsum(counts + 1)]]

    def words(self, ids: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word keys, the end's among them, and the edges of each text. Ids spell words one to one, so a key hashes a word's ids."""
        starts = np.flatnonzero(self.opens[ids])
        keys = slices.hash_spans(ids.view(np.uint8), 2 * starts, 2 * np.r_[starts[1:], len(ids)]).view(np.int64)
        return keys, np.searchsorted(starts, edges)


@lru_cache(2)
def load_encoder(ranks_path: str) -> Encoder:
    """One encoder per worker and file, with what its cache has learned."""
    return Encoder(ranks_path)


class Counter:
    """Counts of (kind, key), merged by sorting when many have come together."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.entries = 0

    def add(self, keys: np.ndarray) -> None:
        found, times = np.unique(keys, return_counts=True)
        self.parts.append((found, times))
        self.entries += len(found)

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        keys = np.concatenate([p[0] for p in self.parts])
        times = np.concatenate([p[1] for p in self.parts])
        found, which = np.unique(keys, return_inverse=True)
        total = np.bincount(which, weights=times).astype(np.int64)
        self.parts, self.entries = [], 0
        return found, total


def with_split(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    name = F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")
    return docs.select(
        F.col(id_column).alias("id"), F.col(text_column).alias("text"), (F.crc32(name) % 7 == HELD_OUT).alias("held_out")
    )


def encode(split: DataFrame, ranks_path: str) -> DataFrame:
    """``id, held_out, place, ids``: subword ids of each text as the bytes of 16-bit integers; ``place`` is a hash of the id."""
    kind = split.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks_path)
        for batch in batches:
            for chunk in slices.chunks(batch.column(3)):
                ids, edges = encoder.chunk(chunk)
                packed = pa.Array.from_buffers(
                    pa.binary(), chunk.docs, [None, pa.py_buffer((2 * edges).astype(np.int32)), pa.py_buffer(ids)]
                )
                own = [batch.column(k).slice(chunk.first, chunk.docs) for k in range(3)]
                yield pa.RecordBatch.from_arrays([*own, packed], ["id", "held_out", "place", "ids"])

    rows = split.select("id", "held_out", F.xxhash64("id").alias("place"), "text")
    return rows.mapInArrow(run, f"id {kind}, held_out boolean, place long, ids binary")


def _ids(column: pa.Array) -> Iterator[tuple[slices.Chunk, np.ndarray, np.ndarray]]:
    for chunk in slices.chunks(column, IDS_BYTES):
        yield chunk, np.ascontiguousarray(chunk.data).view(np.uint16), chunk.offsets // 2


def _counted(names: list[str], *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def count(training: DataFrame, ranks_path: str) -> DataFrame:
    """``kind, key, times`` of words and subwords over the training ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, words = load_encoder(ranks_path), Counter()
        subwords = np.zeros(encoder.start + 1, np.int64)
        names = ["kind", "key", "times"]

        def flush(kind, keys, times):
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                yield _counted(names, np.full(len(part), kind, np.int32), part, times[at : at + 100_000])

        for batch in batches:
            for _, ids, edges in _ids(batch.column(0)):
                words.add(encoder.words(ids, edges)[0])
                subwords += np.bincount(ids, minlength=len(subwords))
                if words.entries > COUNTER_ENTRIES:
                    yield from flush(WORD, *words.take())
        yield from flush(WORD, *words.take())
        found = np.flatnonzero(subwords)
        yield from flush(SUBWORD, found, subwords[found])

    counted = training.select("ids").mapInArrow(run, "kind int, key long, times long")
    return counted.groupBy("kind", "key").agg(F.sum("times").alias("times"))


def count_pairs(training: DataFrame, compact) -> DataFrame:
    """``before, after, times`` of adjacent compact ids, the start before every text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = Counter()

        def flush():
            keys, times = pairs.take()
            for at in range(0, len(keys), 100_000):
                part = keys[at : at + 100_000]
                yield _counted(["before", "after", "times"], part // attention.TOKENS, part % attention.TOKENS, times[at : at + 100_000])

        for batch in batches:
            for _, ids, edges in _ids(batch.column(0)):
                after = compact.value.of[ids].astype(np.int32)
                before = np.r_[np.int32(attention.START), after[:-1]]
                before[edges[:-1]] = attention.START
                pairs.add(before * np.int32(attention.TOKENS) + after)
                if pairs.entries > COUNTER_ENTRIES:
                    yield from flush()
        yield from flush()

    counted = training.select("ids").mapInArrow(run, "before int, after int, times long")
    return counted.groupBy("before", "after").agg(F.sum("times").alias("times"))


class Compact:
    """Compact ids of subwords, and the log probability of a subword given its compact id."""

    def __init__(self, ids: np.ndarray, times: np.ndarray, size: int):
        known = ids < size
        order = np.lexsort((ids[known], -times[known]))
        top = ids[known][order][: attention.OTHER]
        self.of = np.full(size + 2, attention.OTHER, np.int64)
        self.of[top] = np.arange(len(top))
        self.of[size], self.of[size + 1] = attention.END, attention.START
        totals = np.ones(size + 2)
        totals[ids] += times
        rare = self.of == attention.OTHER
        self.within = np.where(rare, np.log(totals / max(1.0, totals[rare].sum())), 0.0)


def pair_biases(pairs: DataFrame) -> attention.Biases:
    """Frequencies from counts of pairs; at most one row per compact id, with at most as many followers, comes to the driver."""
    grouped = pairs.groupBy("before").agg(F.collect_list("after").alias("after"), F.collect_list("times").alias("times"))
    before, after, times = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.float32)]
    for row in grouped.toLocalIterator():
        before.append(np.full(len(row.after), row.before))
        after.append(np.array(row.after))
        times.append(np.array(row.times, np.float32))
    # Tasks end in any order; the model does not depend on it.
    before, after, times = map(np.concatenate, (before, after, times))
    order = np.lexsort((after, before))
    return attention.Biases(before[order], after[order], times[order])


def deal(places: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, number and shard of each window. Texts with the same opening, and copies, spread over all rounds."""
    owner, number = attention.layout(edges)
    return owner, number, slices.mix(slices.mix(places)[owner] + number.astype(np.uint64))


def training_windows(training: DataFrame, ranks_path: str, compact) -> DataFrame:
    """``round, shard, window``: the windows that training sees, each as the bytes of 16-bit integers. For inspection."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = batch.column(0).to_numpy().view(np.uint64)
            for chunk, ids, edges in _ids(batch.column(1)):
                owner, number, shard = deal(places[chunk.first : chunk.last], edges)
                rows = attention.cut_windows(compact.value.of[ids], edges, owner, number)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((shard % np.uint64(ROUNDS)).astype(np.int32)),
                        pa.array(shard.view(np.int64)),
                        pa.array([r.tobytes() for r in rows], pa.binary()),
                    ],
                    ["round", "shard", "window"],
                )

    encoded = encode(training.withColumn("held_out", F.lit(False)), ranks_path)
    return encoded.select("place", "ids").mapInArrow(run, "round int, shard long, window binary")


def train(training: DataFrame, subwords: int, compact, biases) -> dict[str, np.ndarray]:
    """Parameters after all rounds over ``place, ids``. What comes to the driver is one model, in ``BLOCKS`` rows."""
    spark = training.sparkSession
    params = attention.initial(biases.value)
    # Small inputs are trained on by few tasks; splits are merged for that, not shuffled.
    near = training.select("place", "ids").coalesce(max(1, -(-subwords // (attention.SCORED * ROUNDS * SHARE))))
    for turn in range(ROUNDS):
        shared = spark.sparkContext.broadcast(params)

        def fit(batches: Iterator[pa.RecordBatch], shared=shared, turn=turn) -> Iterator[pa.RecordBatch]:
            trainer, seen = attention.Trainer(shared.value, biases.value), 0
            chance = np.random.default_rng([turn, TaskContext.get().partitionId()])
            waiting: list[np.ndarray] = []

            def learn() -> int:
                rows = np.concatenate(waiting)
                waiting.clear()
                chance.shuffle(rows)
                for at in range(0, len(rows), BATCH):
                    trainer.batch(rows[at : at + BATCH])
                return len(rows)

            for batch in batches:
                places = batch.column(0).to_numpy().view(np.uint64)
                for chunk, ids, edges in _ids(batch.column(1)):
                    owner, number, shard = deal(places[chunk.first : chunk.last], edges)
                    own = np.flatnonzero(shard % np.uint64(ROUNDS) == turn)
                    waiting.append(attention.cut_windows(compact.value.of[ids], edges, owner[own], number[own]))
                    if sum(map(len, waiting)) >= SHUFFLED:
                        seen += learn()
            if waiting:
                seen += learn()
            if seen:
                parts = np.array_split(attention.flatten(trainer.params), BLOCKS)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.arange(BLOCKS, dtype=np.int32)),
                        pa.array(np.full(BLOCKS, float(seen))),
                        pa.array([p * np.float32(seen) for p in parts], pa.list_(pa.float32())),
                    ],
                    ["block", "weight", "total"],
                )

        def average(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sums: dict[int, tuple[float, np.ndarray]] = {}
            for batch in batches:
                for block, weight, total in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                    old = sums.get(block, (0.0, 0.0))
                    sums[block] = (old[0] + weight, old[1] + total.values.to_numpy().astype(np.float64))
            rows = [(b, (t / w).astype(np.float32)) for b, (w, t) in sums.items()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.list_(pa.float32()))],
                ["block", "mean"],
            )

        trained = near.mapInArrow(fit, "block int, weight double, total array<float>")
        means = trained.repartition("block").mapInArrow(average, "block int, mean array<float>").collect()
        if means:
            blocks = {r["block"]: np.array(r["mean"], np.float32) for r in means}
            params = attention.unflatten(np.concatenate([blocks[b] for b in range(BLOCKS)]))
    return params


def frequent(words: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and counts of frequent words, at most ``HEAVY``: those above a threshold that counts of counts give."""
    step = F.floor(F.log2("times") * STEPS).cast("int")
    above, least = 0, None
    for row in words.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("step")).collect():
        above += row.n
        if above > HEAVY:
            break
        least = row.step
    if least is None:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    found = words.where(step >= least).toPandas()
    order = np.argsort(found["key"].to_numpy(np.int64))
    return found["key"].to_numpy(np.int64)[order], found["times"].to_numpy(np.int64)[order]


def score(docs: DataFrame, ranks_path: str, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: id, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``."""
    spark = docs.sparkSession
    split = with_split(docs, id_column, text_column)
    path = scratch_path(spark, "subword-ids")
    encode(split, ranks_path).write.option("compression", "zstd").parquet(path)
    encoded = spark.read.parquet(path)
    training = encoded.where(~F.col("held_out"))
    counted = cut_lineage(count(training, ranks_path))
    words = counted.where(F.col("kind") == WORD).select("key", "times")
    totals = words.agg(F.coalesce(F.sum("times"), F.lit(0)).alias("n"), F.count(F.lit(1)).alias("v")).first()
    subwords = counted.where(F.col("kind") == SUBWORD).select("key", "times").toPandas()
    size = len(byte_bpe.load(ranks_path).tokens)
    times = subwords["times"].to_numpy(np.int64)
    compact = spark.sparkContext.broadcast(Compact(subwords["key"].to_numpy(np.int64), times, size))
    biases = spark.sparkContext.broadcast(pair_biases(count_pairs(training, compact)))
    model = spark.sparkContext.broadcast((train(training, int(times.sum()), compact, biases), frequent(words)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = load_encoder(ranks_path)
        params, (heavy_keys, heavy_times) = model.value
        row, partition = 0, TaskContext.get().partitionId()
        for batch in batches:
            for chunk, ids, edges in _ids(batch.column(1)):
                keys, word_edges = encoder.words(ids, edges)
                rows, owner, real = attention.text_windows(compact.value.of[ids], edges)
                found = attention.log_probs(params, biases.value, rows).astype(np.float64)
                found = np.where(np.arange(attention.SCORED)[None, :] < real[:, None], found, 0.0).sum(axis=1)
                scores = np.bincount(owner, weights=found, minlength=chunk.docs)
                doc_of_id = np.repeat(np.arange(chunk.docs), np.diff(edges))
                scores += np.bincount(doc_of_id, weights=compact.value.within[ids], minlength=chunk.docs)

                doc = np.repeat(np.arange(chunk.docs), np.diff(word_edges))
                if len(heavy_keys):
                    at = np.minimum(np.searchsorted(heavy_keys, keys), len(heavy_keys) - 1)
                    is_heavy = heavy_keys[at] == keys
                    logs = np.where(is_heavy, np.log10(heavy_times[at] + 1.0), 0.0)
                else:
                    is_heavy, logs = np.zeros(len(keys), bool), np.zeros(len(keys))
                light = np.flatnonzero(~is_heavy)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array((np.int64(partition) << 40) + row + np.arange(chunk.docs)),
                        batch.column(0).slice(chunk.first, chunk.docs),
                        batch.column(2).slice(chunk.first, chunk.docs),
                        pa.array(np.diff(word_edges)),
                        pa.array(np.bincount(doc, weights=is_heavy, minlength=chunk.docs).astype(np.int64)),
                        pa.array(np.bincount(doc, weights=logs, minlength=chunk.docs)),
                        pa.array(scores / np.log(10.0)),
                        slices.gather(keys[light], np.r_[0, np.cumsum(np.bincount(doc[light], minlength=chunk.docs))]),
                    ],
                    ["row", "id", "held_out", "n_tokens", "n_heavy", "log_heavy", "score", "light"],
                )
                row += chunk.docs

    kind = docs.schema[id_column].dataType.simpleString()
    scored = cut_lineage(
        encoded.select("id", "ids", "held_out").mapInArrow(
            run,
            f"row long, id {kind}, held_out boolean, n_tokens long, n_heavy long, log_heavy double, score double, light array<long>",
        )
    )
    rare = (
        scored.select("row", F.explode("light").alias("key")).groupBy("row", "key").agg(F.count(F.lit(1)).alias("n"))
        .join(words, "key")
        .groupBy("row").agg(F.sum("n").alias("n_light"), F.sum(F.col("n") * F.log10(F.col("times") + 1.0)).alias("log_light"))
    )
    unit = float(np.log10(totals["n"] + totals["v"] + 1.0))
    known_tokens = F.col("n_heavy") + F.coalesce("n_light", F.lit(0))
    logs = F.col("log_heavy") + F.coalesce("log_light", F.lit(0.0))
    return scored.drop("light").join(rare, "row", "left").select(
        F.col("id").alias(id_column),
        "held_out",
        "n_tokens",
        known_tokens.alias("n_known"),
        F.lit(int(totals["n"])).cast("long").alias("train_tokens"),
        (logs - F.col("n_tokens") * unit).alias("base_score"),
        "score",
    )
