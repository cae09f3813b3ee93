"""Deterministic sharded WARC archives of pages."""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .commit import commit, manifest, open_fs, temporary
from .workspace import Workspace, partitions

#: Least and most raw bytes of a shard, what a record's headers count for, compressed bytes at which a file is closed, and the date of every record.
SHARD_LEAST, SHARD_MOST, HEADERS, ROLL, DATE = 128 << 20, 1 << 30, 700, 32 << 20, "2024-01-01T00:00:00Z"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_FILES = "shard int, roll int, tmp string, n_records long, n_bytes long, sha256 string"
_MANIFEST = "name string, n_records long, n_bytes long, sha256 string"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string"


def _sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _clean(value: str) -> str:
    """A header value on one line."""
    return value.replace("\r", "%0D").replace("\n", "%0A")


def _record_id(kind: str, page_id: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id} {kind} {digest} {copy}')}>"


def record(kind: str, page_id: int | None, url: str | None, payload: bytes, refers_to: int | None = None, copy: int = 0) -> bytes:
    """One WARC/1.1 record as a gzip member. All headers are made afresh; equal input gives equal bytes. copy: how many records of this id and payload are before it."""
    digest = _sha1(payload)
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if kind == "revisit" else http + payload
    head = {
        "WARC-Type": kind,
        "WARC-Record-ID": _record_id(kind, page_id, digest, copy),
        "WARC-Date": DATE,
        "WARC-Target-URI": None if url is None else _clean(url),
        "Content-Type": "application/http; msgtype=response",
        "WARC-Block-Digest": f"sha1:{_sha1(block)}",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": _PROFILE if kind == "revisit" else None,
        "WARC-Refers-To": _record_id("response", refers_to, digest, 0) if kind == "revisit" else None,
        "X-Page-ID": page_id,
        "X-Refers-To-Page-ID": refers_to,
        "Content-Length": len(block),
    }
    lines = "".join(f"{k}: {v}\r\n" for k, v in head.items() if v is not None)
    return gzip.compress(b"WARC/1.1\r\n" + lines.encode() + b"\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers, block) of the records of an open .warc.gz file, one at a time."""
    data = io.BufferedReader(gzip.GzipFile(fileobj=source), 1 << 16)
    while line := data.readline():
        if line.strip() == b"":
            continue
        if not line.startswith(b"WARC/"):
            raise ValueError(f"not a record: {line[:40]!r}")
        head = {}
        while (line := data.readline().rstrip(b"\r\n")):
            k, _, v = line.partition(b": ")
            head[k.decode()] = v.decode()
        block = data.read(int(head["Content-Length"]))
        yield head, block


def _shards(narrow: DataFrame, shard_bytes: int | None, ws: Workspace) -> list[tuple[int, int]]:
    """First ids of the shards after the first: where the bytes of all records before pass a multiple of ``shard_bytes``, by default a 64th of all, within bounds.

    The cuts depend on the order of ids alone, not on how Spark samples or splits its partitions. Sorted ranges are written, each
    range's sum goes to the driver, then the cuts do: a number for each range and shard.
    """
    spark = narrow.sparkSession
    order = F.col("id").asc_nulls_first()
    ws.save(narrow.groupBy("id").agg(F.sum("n").alias("n")).repartitionByRange(partitions(spark), order).sortWithinPartitions(order).withColumn("pid", F.spark_partition_id()), "order")
    parts = spark.read.schema("id long, n long, pid int").parquet(ws.path("order"))
    sums = {r.pid: r.n for r in parts.groupBy("pid").agg(F.sum("n").alias("n")).collect()}
    before, total = [], 0
    for pid in sorted(sums):
        before.append((pid, total))
        total += sums[pid]
    shard_bytes = shard_bytes or min(SHARD_MOST, max(SHARD_LEAST, total // 64))
    if total <= shard_bytes:
        return []
    base = spark.createDataFrame(before, "pid int, before long")
    run = F.sum("n").over(Window.partitionBy("pid").orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("n")
    cut = parts.withColumn("run", run).join(base, "pid").select("id", F.floor((F.col("run") + F.col("before")) / shard_bytes).alias("shard")).where("id is not null and shard > 0")
    return sorted((r.first, r.shard) for r in cut.groupBy("shard").agg(F.min("id").alias("first")).collect())


def write_warc(pages: DataFrame, root: str, ws: Workspace, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", min_revisit_bytes: int = 0, shard_bytes: int | None = None, roll_bytes: int = ROLL) -> None:
    """Write a record for every row of ``pages`` below ``root`` as .warc.gz files.

    Of equal payloads of ``min_revisit_bytes`` or more the one with the smallest id is a response, the others are revisits that
    refer to it; smaller ones are all responses. Records lie in ascending order of id. A file closes at ``roll_bytes`` compressed bytes. What one task writes is a shard: a range of ids of about
    ``shard_bytes`` raw bytes with headers, a multiple of what closes a file. The same pages give the same
    files, whatever the cluster. Files get their names at the end, and a manifest with their digests makes them count.

    Payloads are shuffled once: digests find the copies, and the few columns of a verdict travel to the shard beside the page.
    Tasks stream; an Arrow batch (bounded in bytes by Spark) and one record are held at a time.

    Defined cases: null html has an empty payload; null ids come first: they revisit the smallest known id of their payload, or else the first of them, with a null
    refers_to; null URLs have no target header; repeated rows are revisits of the first of them, each with a record id of its own; an empty table gives a manifest without files. Other columns aren't read.
    """
    spark = pages.sparkSession
    data = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), data.alias("data"))
    narrow = ws.save(rows.select("id", F.length("data").cast("long").alias("n"), F.sha2("data", 256).alias("key"), F.md5(F.coalesce("url", F.lit(""))).alias("u")), "digests")
    # one verdict for each (id, key): its response, and how many rows have it (repeated rows are told apart in the writer)
    groups = narrow.where(F.col("n") >= min_revisit_bytes).groupBy("key").agg(F.min("id").alias("first"), F.count("*").alias("copies")).where("copies > 1").drop("copies")
    verdicts = narrow.select("id", "key").join(groups, "key").groupBy("id", "key").agg(F.min("first").alias("first"))
    firsts = _shards(narrow.select("id", (F.col("n") + HEADERS).alias("n")), shard_bytes, ws)
    starts, numbers = np.array([a for a, _ in firsts], np.int64), np.array([0, *(b for _, b in firsts)], np.int64)

    @F.pandas_udf("int")
    def place(ids: pd.Series) -> pd.Series:
        known = ids.notna()
        at = np.searchsorted(starts, ids.fillna(0).astype("int64").to_numpy(), "right")
        return pd.Series(np.where(known, at, 0).astype("int32"))

    n_shards = len(numbers)
    none = F.lit(None)
    both = rows.select(place("id").alias("shard"), "id", F.sha2("data", 256).alias("key"), F.lit(1).alias("kind"), "url", "data", none.cast("long").alias("first")).unionByName(
        verdicts.select(place("id").alias("shard"), "id", "key", F.lit(0).alias("kind"), none.cast("string").alias("url"), none.cast("binary").alias("data"), "first")
    )
    dealt = both.repartitionById(n_shards, "shard") if hasattr(both, "repartitionById") else both.repartitionByRange(n_shards, "shard")
    ordered = dealt.sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "key", "kind", "url")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done: list[tuple] = []
        out = tmp = digest = None
        size = count = roll = copy = 0
        now = verdict = last = None

        def close() -> None:
            nonlocal out, roll
            if out is not None:
                out.close()
                done.append((now, roll, tmp, count, size, digest.hexdigest()))
                out, roll = None, roll + 1

        for batch in batches:
            for r in ({name: column[k].as_py() for name, column in zip(batch.schema.names, batch.columns, strict=True)} for k in range(batch.num_rows)):
                if r["shard"] != now:
                    close()
                    now, roll = r["shard"], 0
                if r["kind"] == 0:
                    verdict = [r["id"], r["key"], r["first"], False]
                    continue
                kind, refers = "response", None
                if verdict and verdict[:2] == [r["id"], r["key"]]:
                    if r["id"] != verdict[2] or verdict[3]:
                        kind, refers = "revisit", verdict[2]
                    verdict[3] = True
                copy, last = copy + 1 if last == (r["id"], r["key"], kind) else 0, (r["id"], r["key"], kind)
                if out is None:
                    tmp, size, count, digest = temporary(root, ".warc.gz"), 0, 0, hashlib.sha256()
                    fs, path = open_fs(tmp)
                    fs.create_dir(path.rpartition("/")[0], recursive=True)
                    out = fs.open_output_stream(path, compression=None)
                member = record(kind, r["id"], r["url"], r["data"], refers, copy)
                out.write(member)
                digest.update(member)
                size, count = size + len(member), count + 1
                if size >= roll_bytes:
                    close()
        close()
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        names = ["shard", "roll", "tmp", "n_records", "n_bytes", "sha256"]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)

    written = sorted(ordered.mapInArrow(write, _FILES).collect())  # a row for each file
    commit(spark, root, [{"name": f"pages-{x.shard:06d}-{x.roll:04d}.warc.gz", "tmp": x.tmp, "n_records": x.n_records, "n_bytes": x.n_bytes, "sha256": x.sha256} for x in written])
    ws.drop("digests", "order")


def read_warc(spark: SparkSession, root: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to and url of every record of the committed files.

    The digest of a response is computed again from its payload and must be the header's. A task streams a file.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"]

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

        for batch in batches:
            for f in batch.to_pylist():
                fs, path = open_fs(f"{root}/{f['name']}")
                rows: list[tuple] = []
                with fs.open_input_stream(path, compression=None) as source:
                    for head, block in read_records(source):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest, kind = head["WARC-Payload-Digest"].removeprefix("sha1:"), head["WARC-Type"]
                        if kind == "response" and _sha1(payload) != digest:
                            raise ValueError(f"{f['name']}: payload of {head['WARC-Record-ID']} doesn't match its digest")
                        length = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length:"))
                        ids = [None if (v := head.get(k)) is None else int(v) for k in ("X-Page-ID", "X-Refers-To-Page-ID")]
                        rows.append((ids[0], length, digest, kind, ids[1], head.get("WARC-Target-URI")))
                        if len(rows) >= 4096:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    return manifest(spark, root, _MANIFEST).mapInArrow(read, _RECORD)
