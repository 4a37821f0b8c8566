"""A deterministic sharded WARC writer, and a reader.

Records are sorted by id, payload and url, and cut into shards, which are ranges of that order. A shard
begins at each record that a hash selects, one of ``SHARD`` on average, so boundaries follow from the rows
alone, whatever ids look like, and rows with equal or null ids are cut like others. A shard is a series of
files of gzip members, one per record, rolled when a file has ``roll`` compressed bytes. Headers, record ids and digests follow
from the rows alone, so a task that runs again writes the same bytes. A file is written under a
temporary name and renamed when complete; the manifest lists the files and is renamed last, so a folder
with a manifest is complete.

Of records with equal payloads the one with the smallest id is a response, the others are revisits that
refer to it. Files go through pyarrow's file systems: the folder may be any URI they can open.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.session import settled

SHARD = 4096  # records of a shard, on average
MOST_SHARDS = 100_000  # about; larger tables have larger shards
ROLL = 64 << 20
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's name space for URLs
MANIFEST = "file string, shard long, records long, bytes long, sha256 string"
RECORDS = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"


def place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def digest(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page: int | None, payload_digest: str, url: str | None, nth: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, f'record {page} {payload_digest} {nth} {url}')}>"


def _line(text: str) -> str:
    """A header value without control characters, spaces or per cent signs of its own."""
    return "".join(c if c > " " and c not in "%\x7f" else f"%{ord(c):02X}" for c in text)


def record(page: int | None, url: str | None, payload: bytes, refers_to: tuple[int, str | None] | None, nth: int = 0, date: str = DATE) -> bytes:
    """One record, uncompressed. ``refers_to``: id and url of the first page with this payload. ``nth``: repetition of the same row."""
    own = digest(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if refers_to is None else http
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {record_id(page, own, url, nth)}", f"WARC-Date: {date}",
        *([] if url is None else [f"WARC-Target-URI: {_line(url)}"]), *([] if page is None else [f"X-Page-ID: {page}"]),
        f"WARC-Payload-Digest: sha1:{own}", f"WARC-Block-Digest: sha1:{digest(block)}",
        *([] if refers_to is None else [f"WARC-Refers-To: {record_id(refers_to[0], own, refers_to[1], 0)}", f"X-Refers-To-Page: {refers_to[0]}", f"WARC-Profile: {PROFILE}"]),
        f"X-Payload-Length: {len(payload)}", "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)  # no name and no time in the header
    return pack.compress(data) + pack.flush()


def _written(folder: str, roll: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = place(folder)
        out = name = None
        shard = seq = last = nth = again = first = None
        state: dict = {}

        def close():
            out.close()
            files.move(f"{base}/{name}.{state['try']}", f"{base}/{name}")  # the same bytes if it is there already
            row = [name, shard, state["records"], state["bytes"], state["hash"].hexdigest()]
            return pa.RecordBatch.from_arrays([pa.array([v]) for v in row], names=["file", "shard", "records", "bytes", "sha256"])

        for batch in batches:
            for row in batch.to_pylist():
                if row["_payload"] is None:  # of the records that follow: the first one with their payload
                    again, first = row["_order"], (row["_first"]["_page"], row["_first"]["_url"])
                    continue
                if out is not None and (row["_shard"] != shard or state["bytes"] >= roll):
                    yield close()
                    out, seq = None, seq + 1 if row["_shard"] == shard else 0
                if out is None:
                    seq = 0 if row["_shard"] != shard else seq
                    shard = row["_shard"]
                    name = f"part-{shard:012d}-{seq:05d}.warc.gz"
                    state = {"records": 0, "bytes": 0, "hash": hashlib.sha256(), "try": f"tmp-{uuid.uuid4().hex}"}
                    out = files.open_output_stream(f"{base}/{name}.{state['try']}", compression=None)
                page, refers = row["_page"], first if row["_order"] == again else None
                nth = nth + 1 if last == (page, row["_url"], row["_payload"]) else 0
                last = (page, row["_url"], row["_payload"])
                data = _member(record(page, row["_url"], row["_payload"], refers, nth))
                out.write(data)
                state["hash"].update(data)
                state["records"] += 1
                state["bytes"] += len(data)
        if out is not None:
            yield close()

    return run


def _order() -> Column:
    """Text whose order is that of records: null ids first, then by id, payload digest and url."""
    page = F.lpad(F.hex(F.col("_page").bitwiseXOR(F.lit(-(1 << 63)))), 16, "0")
    return F.concat(F.when(F.col("_page").isNull(), "0").otherwise(F.concat(F.lit("1"), page)), "_key", F.when(F.col("_url").isNull(), "0").otherwise(F.concat(F.lit("1"), "_url")))


def _shards(rows: DataFrame, size: int):
    """The number of the shard that a place in the order lies in, as a function of that column.

    Shards begin at places a hash selects. Their beginnings are collected: about ``MOST_SHARDS`` at most.
    """
    spark = rows.sparkSession
    hashed = settled(rows.select(F.col("_order"), F.xxhash64("_order").alias("_hash")).where(F.pmod("_hash", F.lit(size)) == 0).distinct(), "shards")
    # Twice as many records a shard halves them; every second one of the selected hashes stays.
    while hashed.where(F.pmod("_hash", F.lit(size)) == 0).count() > MOST_SHARDS:
        size *= 2
    begins = [r[0].encode() for r in hashed.where(F.pmod("_hash", F.lit(size)) == 0).select("_order").collect()]
    shared = spark.sparkContext.broadcast(np.array(sorted(begins), object))

    @F.pandas_udf("long")
    def shard(order: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, np.array([o.encode() for o in order], object), "right"), dtype="int64")

    return shard


def write(pages: DataFrame, folder: str, id: str = "page_id", url: str = "url", html: str = "html", least: int = 0, shard: int = SHARD, roll: int = ROLL) -> DataFrame:
    """Writes ``pages`` into the new ``folder`` and returns the manifest.

    A null html is an empty payload. Payloads of fewer than ``least`` bytes are all responses. Rows
    that repeat an id are records of their own; with equal payloads they have the same type. Rows with
    a null id come first and are always responses. ``shard`` is the mean number of records of a shard. An empty table gives a manifest without files.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(id).cast("long").alias("_page"), F.col(url).alias("_url"), F.coalesce(F.col(html).cast("binary"), F.lit(b"")).alias("_payload"))
    rows = rows.withColumn("_key", F.sha2("_payload", 256)).withColumn("_order", _order())
    shard_of = _shards(rows, shard)
    # Same payload: same digest and length. A hot payload sends one row per task here.
    keyed = rows.where(F.col("_page").isNotNull() & (F.octet_length("_payload") >= least)).select("_page", "_key", "_url", "_order").distinct()
    first = keyed.groupBy("_key").agg(F.min(F.struct("_page", "_url")).alias("_first"))
    # Only pages that repeat another one; ids and payload digests, no payloads.
    again = keyed.join(first, "_key").where("_page <> _first._page").select(shard_of(F.col("_order")).alias("_shard"), "_order", "_first")
    # One shuffle, by shard, of payloads and of what they repeat: a join by shard and place would deal a shard
    # to several tasks, which then write the same files.
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = rows.select(shard_of(F.col("_order")).alias("_shard"), "_order", "_page", "_url", "_payload")
    # Shards are dealt in turn; by hash a few of them would often meet in one task.
    dealt = placed.unionByName(again, allowMissingColumns=True).repartitionById(n, F.pmod("_shard", F.lit(n)).cast("int"))
    ordered = dealt.sortWithinPartitions("_shard", "_order", F.col("_payload").isNotNull())
    files, base = place(folder)
    files.create_dir(base, recursive=True)
    manifest = ordered.mapInArrow(_written(folder, roll), MANIFEST)
    manifest.write.mode("overwrite").parquet(f"{folder}/manifest.tmp")
    files.move(f"{base}/manifest.tmp", f"{base}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def _records(stream) -> Iterator[dict]:
    """Records of one file, one at a time; digests are computed anew and compared."""
    lines = gzip.GzipFile(fileobj=stream)
    while True:
        start = lines.readline()
        if not start:
            return
        if start.strip() != b"WARC/1.1":
            raise ValueError(f"no record where one should start: {start[:40]!r}")
        head = {}
        while (line := lines.readline().rstrip(b"\r\n")):
            key, _, value = line.partition(b": ")
            head[key.decode()] = value.decode()
        block = lines.read(int(head["Content-Length"]))
        lines.read(4)
        kind, own = head["WARC-Type"], head["WARC-Payload-Digest"].removeprefix("sha1:")
        payload = block.partition(b"\r\n\r\n")[2]
        if head["WARC-Block-Digest"] != f"sha1:{digest(block)}" or kind == "response" and digest(payload) != own:
            raise ValueError(f"digest of {head['WARC-Record-ID']} does not fit")
        yield {
            "page_id": int(head["X-Page-ID"]) if "X-Page-ID" in head else None, "url": head.get("WARC-Target-URI"),
            "payload_bytes": len(payload) if kind == "response" else int(head["X-Payload-Length"]), "payload_digest": own, "record_type": kind,
            "refers_to": int(head["X-Refers-To-Page"]) if kind == "revisit" else None,
        }


def read(spark: SparkSession, folder: str) -> DataFrame:
    """One row per record of the files the manifest of ``folder`` lists."""
    manifest = spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")
    kinds = {"page_id": pa.int64(), "url": pa.string(), "payload_bytes": pa.int64(), "payload_digest": pa.string(), "record_type": pa.string(), "refers_to": pa.int64()}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = place(folder)
        for batch in batches:
            for name in batch.column("file").to_pylist():
                held: list[dict] = []
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for r in _records(stream):
                        held.append(r)
                        if len(held) == 4096:
                            yield pa.RecordBatch.from_pylist(held, pa.schema(kinds))
                            held = []
                if held:
                    yield pa.RecordBatch.from_pylist(held, pa.schema(kinds))

    # A file a task: about as many partitions as files, of which the manifest knows the number.
    n = max(1, manifest.count())
    return manifest.select("file").repartition(min(n, 10_000), "file").mapInArrow(run, RECORDS)
