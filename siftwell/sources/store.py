"""The document store: schema checks, column completion, appends, deletes, and a table that changes by partition."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siftwell.session import cut_lineage

# Store columns and their types.
CORE_COLUMNS = {"doc_id": "bigint", "content": "string", "embeddings": "array<float>"}
OPTIONAL_COLUMNS = {
    "added_at": "timestamp_ntz",
    "raw_payload": "string",
    "source_url": "string",
    "source_title": "string",
    "retrieval_query": "string",
    "retrieval_timestamp": "timestamp_ntz",
    "retrieval_mode": "string",
    "cache_hit": "int",
    "inserted_from": "string",
    "provider_name": "string",
    "memory_scope": "string",
    "expires_at": "timestamp_ntz",
    "last_seen_at": "timestamp_ntz",
    "query_count": "bigint",
    "content_hash": "string",
}
# Columns of a partitioned store that readers do not see.
PARTITION, LIVE = "store_partition", "store_live"
PARTITIONS = 64
Token = tuple[str, int]
LIFECYCLE_COLUMNS = ("memory_scope", "expires_at", "last_seen_at", "query_count")


def _is_vector(t: T.DataType) -> bool:
    return isinstance(t, T.ArrayType) and isinstance(t.elementType, (T.FloatType, T.DoubleType))


_CLASSES = {
    "array<float>": ("a vector", _is_vector),
    "string": ("text", lambda t: isinstance(t, (T.StringType, T.CharType, T.VarcharType))),
    "timestamp_ntz": (
        "a timestamp",
        lambda t: isinstance(t, (T.TimestampType, T.TimestampNTZType, T.DateType)),
    ),
    "bigint": ("a number", lambda t: isinstance(t, T.NumericType)),
    "int": ("a number", lambda t: isinstance(t, T.NumericType)),
}
_JSON_CLASS = ("JSON text", lambda t: isinstance(t, (T.StringType, T.VariantType)))


def check_store(df: DataFrame, required: tuple[str, ...] = ()) -> DataFrame:
    """``df`` itself, if its known columns have types of their class and none required is missing.

    Only the schema is looked at; no job runs.
    """
    fields = {field.name.lower(): field.dataType for field in df.schema.fields}
    missing = sorted({"content", "embeddings", *required} - fields.keys())
    if missing:
        raise ValueError(f"The store is missing columns: {', '.join(missing)}.")
    for name, kind in {**CORE_COLUMNS, **OPTIONAL_COLUMNS}.items():
        expected, accepts = _JSON_CLASS if name == "raw_payload" else _CLASSES[kind]
        if name in fields and not accepts(fields[name]):
            raise ValueError(
                f"Store column {name} must be {expected}; found {fields[name].simpleString()}."
            )
    return df


def open_store(
    spark: SparkSession,
    path: str,
    columns: Mapping[str, str] | None = None,
    required: tuple[str, ...] = (),
) -> DataFrame:
    """A parquet folder as a checked store; ``columns`` maps its own names to store names."""
    df = spark.read.parquet(path)
    return check_store(df.withColumnsRenamed(dict(columns or {})), required)


def missing_columns(df: DataFrame, wanted: Mapping[str, str] = OPTIONAL_COLUMNS) -> dict[str, str]:
    present = {name.lower() for name in df.columns}
    return {name: kind for name, kind in wanted.items() if name not in present}


def ensure_columns(
    df: DataFrame, wanted: Mapping[str, str] = OPTIONAL_COLUMNS
) -> tuple[DataFrame, list[str]]:
    """``df`` with absent columns added as typed NULLs, and the names that were added."""
    absent = missing_columns(df, wanted)
    added = [F.lit(None).cast(kind).alias(name) for name, kind in absent.items()]
    return df.select("*", *added), list(absent)


def append(store: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows of both; a column absent on one side is NULL there."""
    lacking = sorted({"content", "embeddings"} - set(docs.columns))
    if lacking:
        raise ValueError(f"Documents must have {', '.join(lacking)}.")
    return store.unionByName(docs, allowMissingColumns=True)


def delete_where(store: DataFrame, doomed: Column) -> DataFrame:
    """Survivors: rows for which ``doomed`` is not true."""
    return store.filter(~F.coalesce(doomed, F.lit(False)))


def count_where(store: DataFrame, doomed: Column) -> DataFrame:
    """One row ``deleted``."""
    return store.agg(F.count_if(F.coalesce(doomed, F.lit(False))).alias("deleted"))


class PartitionedStore:
    """A Parquet store partitioned by a hash of its merge key, changed by rewriting only the partitions that change.

    Rows without the key go by their id. Appends add files. Merges and deletions read the partitions they touch, write the
    outcome to a staging folder beside them and then replace exactly these partitions, so a run that dies before that changes
    nothing. A commit may be named by ``token``, a stream's name and the number of its batch: the batch run again finds its
    outcome staged and puts the same rows in place. Every partition has one row that stands for no document, so that
    emptied partitions are replaced like others; readers do not see it.

    One writer at a time may merge or delete; a DataFrame read before that must be read anew after it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str | None = None, partitions: int = PARTITIONS):
        self.spark, self.path = spark, path.rstrip("/")
        kept = self._read_if_there(f"{self.path}/_settings")
        self.key, self.partitions = kept.select("key", "partitions").first() if kept is not None else (key, partitions)

    def _read_if_there(self, path: str) -> DataFrame | None:
        try:
            return self.spark.read.parquet(path)
        except AnalysisException:
            return None

    def exists(self) -> bool:
        return self._read_if_there(f"{self.path}/_settings") is not None

    def _partition(self, columns: list[str]) -> Column:
        by_id = F.xxhash64(F.lit(0), F.col("doc_id").cast("long"))
        if self.key is None or self.key not in columns:
            by_key = by_id
        else:
            by_key = F.when(F.coalesce(F.col(self.key) != "", F.lit(False)), F.xxhash64(F.lit(1), F.col(self.key))).otherwise(by_id)
        return F.pmod(by_key, F.lit(self.partitions)).cast("int")

    def _placed(self, df: DataFrame) -> DataFrame:
        return df.withColumns({LIVE: F.lit(True), PARTITION: self._partition(df.columns)})

    def _with_markers(self, df: DataFrame, partitions: list[int]) -> DataFrame:
        """Rows, and each partition's row that stands for no document."""
        marks = self.spark.createDataFrame([(p,) for p in partitions], f"{PARTITION} int").withColumn(LIVE, F.lit(False))
        return self._placed(df).unionByName(marks, allowMissingColumns=True)

    def create(self, df: DataFrame) -> None:
        """Make ``df`` the store."""
        whole = self._with_markers(df, list(range(self.partitions)))
        whole.hint("rebalance", PARTITION).write.mode("overwrite").partitionBy(PARTITION).parquet(self.path)
        kept = self.spark.createDataFrame([(self.key, self.partitions)], "key string, partitions int")
        kept.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/_settings")

    def _rows(self) -> DataFrame:
        if not self.exists():
            raise ValueError(f"No store at {self.path}.")
        return self.spark.read.parquet(self.path).where(LIVE).drop(LIVE)

    def read(self) -> DataFrame:
        return self._rows().drop(PARTITION)

    def _touched(self, partitions: list[int]) -> DataFrame:
        """The rows of some partitions; the filter reaches the scan."""
        return self._rows().where(F.col(PARTITION).isin(partitions)).drop(PARTITION)

    # A token's folder is used again two batches later, when its batch is long committed.
    def _folder(self, token: Token | None) -> str:
        name, number = token or ("once", 0)
        return f"{self.path}/_batches/{name}-{number % 2}"

    def staged(self, token: Token) -> bool:
        """Whether the outcome of a batch was written, and so may be in place already."""
        done = self._read_if_there(f"{self._folder(token)}/done")
        return done is not None and done.first()["number"] == token[1]

    def _commit(
        self, replaced: tuple[DataFrame, list[int]] | None, added: DataFrame | None, token: Token | None, scattered: bool = False
    ) -> None:
        """Stage both kinds of rows, then put them in place. Rows that are not ``scattered`` still lie as their partitions were read,
        and are staged and put in place without a shuffle."""
        folder = self._folder(token)
        nothing = self.spark.createDataFrame([], f"{PARTITION} int")
        parts = {
            "replaced": self._with_markers(*replaced) if replaced is not None and replaced[1] else nothing,
            "added": self._placed(added) if added is not None else nothing,
        }
        if scattered:
            parts["replaced"] = parts["replaced"].hint("rebalance", PARTITION)
        for kind, rows in parts.items():
            rows.write.mode("overwrite").parquet(f"{folder}/{kind}")
        if token is not None:
            done = self.spark.createDataFrame([(token[1],)], "number long")
            done.coalesce(1).write.mode("overwrite").parquet(f"{folder}/done")
        self._put(folder, again=False)

    def replay(self, token: Token) -> None:
        """Put the staged outcome of a batch in place once more; what is there already stays as it is."""
        self._put(self._folder(token), again=True)

    def _put(self, folder: str, again: bool) -> None:
        replaced, added = (self.spark.read.parquet(f"{folder}/{kind}") for kind in ("replaced", "added"))
        if LIVE in replaced.columns:
            kept = replaced.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            kept.partitionBy(PARTITION).parquet(self.path)
        if LIVE in added.columns:
            if again:
                added = cut_lineage(added.join(self._rows().select("doc_id"), "doc_id", "left_anti"))
            added.write.mode("append").partitionBy(PARTITION).parquet(self.path)

    def append(self, rows: DataFrame, token: Token | None = None) -> None:
        """Add rows that have the store's columns."""
        self._commit(None, rows, token)

    def merge(
        self,
        docs: DataFrame,
        key: str,
        upsert: Callable[[DataFrame, DataFrame, str], DataFrame],
        token: Token | None = None,
        scattered: bool = True,
    ) -> None:
        """Merge documents by ``key`` with ``upsert``, in the partitions their keys lie in; documents without a key are added.
        ``scattered`` is whether ``upsert`` shuffles the rows of the store."""
        has_key = F.coalesce(F.col(key) != "", F.lit(False))
        keyed, plain = docs.where(has_key), docs.where(~has_key)
        if key == self.key:
            touched = [r[0] for r in keyed.select(self._partition(keyed.columns)).distinct().collect()]
        else:
            touched = list(range(self.partitions))
        merged = upsert(self._touched(touched), keyed, key)
        empty = self._rows().drop(PARTITION).limit(0)
        self._commit((merged, touched), upsert(empty, plain, key), token, scattered)

    def delete_where(self, doomed: Column) -> int:
        """Delete the rows for which ``doomed`` is true; returns how many there were. The columns of the condition are read to
        find them; whole rows are read only in the partitions that lose some."""
        found = self._rows().where(F.coalesce(doomed, F.lit(False))).groupBy(PARTITION).count().collect()
        touched = [r[PARTITION] for r in found]
        if touched:
            self._commit((delete_where(self._touched(touched), doomed), touched), None, None)
        return sum(r["count"] for r in found)


def ensure_index(spark: SparkSession, path: str, build: Callable[[str], object]) -> bool:
    """Build an index under ``path`` only if there is none; True when it was built. It counts as there once it is whole."""
    try:
        spark.read.parquet(f"{path}/_built")
        return False
    except AnalysisException:
        build(path)
        spark.range(1).coalesce(1).write.mode("overwrite").parquet(f"{path}/_built")
        return True


def index_name(table: str, column: str, kind: str) -> str:
    """Default name of an index: 'vec' or 'text' on a column of a table."""
    return f"{table}_{column}_{kind}_idx".upper()
