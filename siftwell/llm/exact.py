"""Exact deduplication: Patricia tries own the texts.

The key of a text is its length, its content hash and then its full bytes. Every task first inserts
its rows into a trie of its own, so that a group of copies leaves the task as one row however many
rows it has. What is left is dealt out by length and hash and merged in tries that hold full byte
strings, so texts are equal only when their bytes are. A terminal node keeps the owner (the smallest
or the largest identifier) and the number of rows. A trie that grows beyond its memory
spills: its largest subtrees are emitted as partial owners and freed. In the second stage rows come sorted by
key, and a subtree is emitted as soon as the next one begins, so one of them is open at a time.

Null counts as empty. All empty texts are one group. Identifiers may be integers or strings; a null
identifier counts as the last choice for an owner. Rows that repeat an identifier and a text are rows of
the same group and count each. Only the two named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siftwell.llm.names import plain

TRIE_BYTES = 64 << 20


class _Node:
    """A compressed edge with what hangs below it. A terminal has rows > 0."""

    __slots__ = ("children", "label", "owner", "rows")

    def __init__(self, label: bytes):
        self.label = label
        self.children: dict[int, _Node] = {}
        self.owner = None
        self.rows = 0


def _common(a: bytes, b: bytes) -> int:
    """Length of the common prefix, by halving."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


class Patricia:
    """A radix trie from byte strings to (owner, rows)."""

    def __init__(self, largest: bool = False):
        self.largest = largest
        self.root = _Node(b"")
        self.bytes = 0

    def _better(self, new, old) -> bool:
        if old is None or new is None:
            return new is not None
        return new > old if self.largest else new < old

    def insert(self, key: bytes, owner, rows: int = 1) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node.children.get(key[at])
            if child is None:
                child = _Node(key[at:])
                node.children[key[at]] = child
                self.bytes += len(child.label) + 200
                node, at = child, len(key)
                break
            rest = key[at : at + len(child.label)]
            same = len(rest) if rest == child.label else _common(rest, child.label)
            if same < len(child.label):
                upper = _Node(child.label[:same])
                child.label = child.label[same:]
                upper.children[child.label[0]] = child
                node.children[key[at]] = upper
                self.bytes += 200
                child = upper
            node, at = child, at + same
        if node.rows == 0 or self._better(owner, node.owner):
            node.owner = owner
        node.rows += rows

    def terminals(self) -> Iterator[tuple[bytes, object, int]]:
        """Every key with its owner and rows, in byte order."""
        stack = [(self.root, b"")]
        while stack:
            node, above = stack.pop()
            key = above + node.label
            if node.rows:
                yield key, node.owner, node.rows
            stack += [(node.children[b], key) for b in sorted(node.children, reverse=True)]

    def spill(self, to_bytes: int) -> Iterator[tuple[bytes, object, int]]:
        """Empty subtrees of the root, the largest first, until ``to_bytes`` are left."""

        def size(top: _Node) -> int:
            total, stack = 0, [top]
            while stack:
                node = stack.pop()
                total += len(node.label) + 200
                stack += node.children.values()
            return total

        sizes = sorted(((size(n), b) for b, n in self.root.children.items()), reverse=True)
        for n_bytes, b in sizes:
            if self.bytes <= to_bytes:
                return
            part = Patricia(self.largest)
            part.root.children[b] = self.root.children.pop(b)
            yield from part.terminals()
            self.bytes -= n_bytes


def trie_key(text: bytes) -> bytes:
    """Hash first, so that subtrees of the root are of even size, then length and content."""
    return sha256(text).digest()[:8] + len(text).to_bytes(8, "big") + text


def owners(docs: DataFrame, id_column: str, text: Column, keep: str = "smallest", trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """One row per distinct text: ``text_sha256``, ``n_bytes``, ``keep_id``, ``group_size``. Null texts are empty."""
    largest = keep == "largest"
    kind = docs.schema[id_column].dataType.simpleString()
    id_type = docs.select(id_column).schema

    from pyspark.sql.pandas.types import to_arrow_type

    arrow_id = to_arrow_type(id_type[0].dataType)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Patricia(largest)

        def batch_of(items):
            keys, own, rows = zip(*items)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([k[:8] for k in keys], pa.binary()),
                    pa.array([len(k) - 16 for k in keys], pa.int64()),
                    pa.array([k[16:] for k in keys], pa.binary()),
                    pa.array(own, arrow_id),
                    pa.array(rows, pa.int64()),
                ],
                ["h", "n_bytes", "content", "owner", "n_rows"],
            )

        for batch in batches:
            texts = pc.fill_null(batch.column(1).cast(pa.binary()), b"")
            for k, own in zip(texts, batch.column(0).to_pylist()):
                trie.insert(trie_key(k.as_py()), own)
                if trie.bytes > trie_bytes:
                    yield from _batches(trie.spill(trie_bytes // 2), batch_of)
        yield from _batches(trie.terminals(), batch_of)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(items):
            keys, own, rows = zip(*items)
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([sha256(k[16:]).hexdigest() for k in keys]),
                    pa.array([len(k) - 16 for k in keys], pa.int64()),
                    pa.array(own, arrow_id),
                    pa.array(rows, pa.int64()),
                ],
                ["text_sha256", "n_bytes", "keep_id", "group_size"],
            )

        def groups():
            trie, open_subtree = Patricia(largest), None
            for batch in batches:
                h, n, content, own, rows = (batch.column(k) for k in range(5))
                for k in range(batch.num_rows):
                    subtree = (h[k].as_py(), n[k].as_py())
                    if subtree != open_subtree:
                        yield from trie.terminals()
                        trie, open_subtree = Patricia(largest), subtree
                    key = subtree[0] + subtree[1].to_bytes(8, "big") + content[k].as_py()
                    trie.insert(key, own[k].as_py(), rows[k].as_py())
            yield from trie.terminals()

        yield from _batches(groups(), batch_of)

    local = docs.select(F.col(id_column), text.alias("content")).mapInArrow(
        partial, f"h binary, n_bytes long, content binary, owner {kind}, n_rows long"
    )
    dealt = local.repartition("h", "n_bytes").sortWithinPartitions("h", "n_bytes")
    return dealt.mapInArrow(merge, f"text_sha256 string, n_bytes long, keep_id {kind}, group_size long")


def _batches(items: Iterator, batch_of, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for item in items:
        rows.append(item)
        size += len(item[0])
        if size > limit or len(rows) >= 10_000:
            yield batch_of(rows)
            rows, size = [], 0
    if rows:
        yield batch_of(rows)


def dedup_report(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """One row per document: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Of rows that repeat the owner's identifier too, each is ``kept``: they cannot be told apart.
    """
    text = F.coalesce(F.col(text_column), F.lit(""))
    own = owners(docs, id_column, text, keep)
    marked = docs.select(
        id_column, F.sha2(text, 256).alias("text_sha256"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    joined = marked.join(own, ["text_sha256", "n_bytes"])
    return joined.select(
        id_column,
        "keep_id",
        "group_size",
        F.col(id_column).eqNullSafe(F.col("keep_id")).alias("kept"),
        "text_sha256",
    )


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", keep: str = "smallest") -> DataFrame:
    """The rows of ``docs`` that own their text, with all columns, whatever their names. Rows that repeat an owner whole all stay."""
    named, (id_column, text_column) = plain(docs, id_column, text_column)
    text = F.coalesce(F.col(text_column), F.lit(""))
    names = ["__owner", "__digest", "__bytes"]
    own = owners(named, id_column, text, keep).select(
        F.col("keep_id").alias(names[0]), F.col("text_sha256").alias(names[1]), F.col("n_bytes").alias(names[2])
    )
    same = (
        F.col(id_column).eqNullSafe(F.col(names[0]))
        & (F.sha2(text, 256) == F.col(names[1]))
        & (F.octet_length(text).cast("long") == F.col(names[2]))
    )
    return named.join(own, same, "left_semi").toDF(*docs.columns)
