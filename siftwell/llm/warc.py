"""Dictionary-compressed web archives: writing and reading.

An archive is a file of Zstandard frames. It begins with a skippable frame that holds a dictionary built from the
archive's own records; every record follows as a frame of its own, compressed with that dictionary.
Archives are closed at ``archive_bytes`` of plain records, so memory is bounded, and are
written by Spark as rows (archive_id, records, data), one whole file in ``data``: lost tasks are then run again
without half-written files, on any file system that Spark can write. ``export`` puts them into plain files.

Of records with equal payloads of at least ``revisit_bytes`` bytes, the one with the smallest id carries the payload; the
others are revisits that refer to it. Payloads are compared by length and SHA-256. Null payloads are empty. Rows that
repeat the smallest id with the same payload are all responses. A null id is written as such, comes
after all others and never is referred to unless all equal records have null ids; a null URL leaves its header out. Only the
three named columns are read. An empty table gives no archive.
"""

from __future__ import annotations

import os
import struct
from collections.abc import Iterator
from hashlib import sha256
from uuid import NAMESPACE_URL, uuid5

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwell.session import scratch_path

# Fixed values of the file format.
DICTIONARY_MAGIC = 0x184D2A5D
VERSION = b"WARC/1.1"
PROFILE = b"http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEADER = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=UTF-8\r\n\r\n"

ARCHIVE_BYTES = 8 << 20
DICTIONARY_BYTES = 48 << 10
#: Dictionary training needs some samples; fewer records share a dictionary made of their beginnings.
MIN_SAMPLES = 32
DATE = "2024-01-31T00:00:00Z"


def record_id(page_id: int | None) -> bytes:
    return b"<urn:page:%s>" % (b"none" if page_id is None else b"%d" % page_id)


def page_of(urn: str) -> int | None:
    name = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if name == "none" else int(name)


def record(page_id, url: str | None, payload: bytes, n_bytes: int, digest: str, refers_to, revisit: bool, date: str = DATE) -> bytes:
    """One record: its header lines, a blank line, the block and two line ends."""
    block = HTTP_HEADER + (b"" if revisit else payload)
    lines = [
        VERSION,
        b"WARC-Type: " + (b"revisit" if revisit else b"response"),
        b"WARC-Record-ID: " + record_id(page_id),
        b"WARC-Date: " + date.encode(),
        b"WARC-Payload-Digest: sha256:" + digest.encode(),
        b"Content-Type: application/http; msgtype=response",
        b"Content-Length: %d" % len(block),
    ]
    if url is not None:
        lines.append(b"WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A").encode())
    if revisit:
        # A revisit does not hold its payload, so a field of its own tells the length.
        lines += [b"WARC-Profile: " + PROFILE, b"WARC-Refers-To: " + record_id(refers_to), b"Payload-Length: %d" % n_bytes]
    return b"\r\n".join(lines) + b"\r\n\r\n" + block + b"\r\n\r\n"


def dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> zstandard.ZstdCompressionDict:
    """Trained on all records of the archive, or, if they are few or too alike, made of how they begin.

    It is at most a sixteenth of the records' size, so that it pays for its place in the file.
    """
    size = min(size, max(1024, sum(map(len, records)) // 16))
    if len(records) >= MIN_SAMPLES:
        try:
            return zstandard.train_dictionary(size, records, k=512, d=8)
        except zstandard.ZstdError:
            pass
    share = max(256, size // max(1, len(records)))
    return zstandard.ZstdCompressionDict(b"".join(r[:share] for r in records)[:size], dict_type=zstandard.DICT_TYPE_RAWCONTENT)


def pack(records: list[bytes], level: int = 3) -> bytes:
    """An archive file."""
    shared = dictionary(records)
    press = zstandard.ZstdCompressor(level=level, dict_data=shared)
    raw = shared.as_bytes()
    return struct.pack("<II", DICTIONARY_MAGIC, len(raw)) + raw + b"".join(map(press.compress, records))


def unpack(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of every record of an archive file."""
    magic, size = struct.unpack_from("<II", data)
    if magic != DICTIONARY_MAGIC:
        raise ValueError("The archive does not begin with a dictionary frame.")
    raw = data[8 : 8 + size]
    trained = raw[:4] == b"\x37\xa4\x30\xec"
    shared = zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_FULLDICT if trained else zstandard.DICT_TYPE_RAWCONTENT)
    with zstandard.ZstdDecompressor(dict_data=shared).stream_reader(data[8 + size :], read_across_frames=True) as stream:
        plain = stream.read()
    at = 0
    while at < len(plain):
        end = plain.index(b"\r\n\r\n", at)
        first, *lines = plain[at:end].decode().split("\r\n")
        if first.encode() != VERSION:
            raise ValueError(f"A record begins with {first[:20]!r}.")
        fields = dict(line.split(": ", 1) for line in lines)
        at = end + 4
        size = int(fields["Content-Length"])
        yield fields, plain[at : at + size]
        at += size + 4


def payload_of(block: bytes) -> bytes:
    return block.partition(b"\r\n\r\n")[2]


def write(
    pages: DataFrame,
    path: str,
    id_column: str = "page_id",
    url_column: str = "url",
    html_column: str = "html",
    revisit_bytes: int = 100,
    archive_bytes: int = ARCHIVE_BYTES,
    date: str = DATE,
) -> None:
    """Write all pages as archives to ``path``; ``date`` is when they were fetched, as in 2024-01-31T00:00:00Z."""
    payload = F.coalesce(F.col(html_column), F.lit("")).cast("binary")
    told = pages.select(
        F.col(id_column).cast("long").alias("id"),
        F.col(url_column).alias("url"),
        payload.alias("payload"),
        F.octet_length(payload).cast("long").alias("n_bytes"),
        F.sha2(payload, 256).alias("digest"),
    )
    first = (
        told.where(F.col("n_bytes") >= revisit_bytes)
        .groupBy("digest", "n_bytes")
        .agg(F.min("id").alias("first_id"))
    )
    linked = told.join(first, ["digest", "n_bytes"], "left").select(
        "id", "url", "payload", "n_bytes", "digest", "first_id",
        ((F.col("n_bytes") >= revisit_bytes) & ~F.col("id").eqNullSafe(F.col("first_id"))).alias("revisit"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def archive(records: list[bytes]) -> pa.RecordBatch:
            name = str(uuid5(NAMESPACE_URL, sha256(b"".join(sha256(r).digest() for r in records)).hexdigest()))
            return pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([len(records)], pa.int64()), pa.array([pack(records)], pa.binary())],
                ["archive_id", "records", "data"],
            )

        records, size = [], 0
        for batch in batches:
            page_id, url, body, n_bytes, digest, first_id, revisit = batch.columns
            for k in range(batch.num_rows):
                records.append(
                    record(
                        page_id[k].as_py(), url[k].as_py(), body[k].as_py(), n_bytes[k].as_py(),
                        digest[k].as_py(), first_id[k].as_py(), revisit[k].as_py(), date,
                    )
                )
                size += len(records[-1])
                if size >= archive_bytes:
                    yield archive(records)
                    records, size = [], 0
        if records:
            yield archive(records)

    archives = linked.mapInArrow(run, "archive_id string, records long, data binary")
    archives.write.option("compression", "none").parquet(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """Every record of the archives under ``path``; digests of responses are computed from what was read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                rows = []
                for fields, block in unpack(data.as_py()):
                    revisit = fields["WARC-Type"] == "revisit"
                    payload = payload_of(block)
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if not revisit and sha256(payload).hexdigest() != digest:
                        raise ValueError(f"The payload of {fields['WARC-Record-ID']} is damaged.")
                    rows.append(
                        (
                            page_of(fields["WARC-Record-ID"]),
                            int(fields["Payload-Length"]) if revisit else len(payload),
                            digest if revisit else sha256(payload).hexdigest(),
                            fields["WARC-Type"],
                            page_of(fields["WARC-Refers-To"]) if revisit else None,
                            fields.get("WARC-Target-URI"),
                            None if revisit else payload.decode("utf-8"),
                        )
                    )
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url", "payload"],
                )

    schema = (
        "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, "
        "url string, payload string"
    )
    return spark.read.parquet(path).select("data").mapInArrow(run, schema)


def round_trip(pages: DataFrame) -> DataFrame:
    """Write archives to the shared folder and read them back."""
    path = scratch_path(pages.sparkSession, "archives")
    write(pages, path)
    return read(pages.sparkSession, path)


def export(spark: SparkSession, path: str, folder: str) -> None:
    """One ``.warc.zst`` file per archive, in a folder that all executors can write to as a local path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = os.path.join(folder, f".{name}-{os.getpid()}")
                with open(part, "wb") as file:
                    file.write(data.as_buffer())
                os.replace(part, os.path.join(folder, f"{name}.warc.zst"))
            yield batch.select([0])

    spark.read.parquet(path).select("archive_id", "data").mapInArrow(run, "archive_id string").count()
