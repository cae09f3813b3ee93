import base64
import hashlib
import random

from marlstone.llm import warc
from marlstone.llm.workspace import Workspace, hadoop_path

SCHEMA = "page_id long, url string, html string, key string"
ROWS = [
    (5, "http://a/", "same", "clash"), (3, "http://b/\r\nX: y", "same", None), (9, None, "same", None), (1, "http://c/", None, None), (2, "http://d/", "", None), (4, "é", "ünï\r\n\r\nWARC/1.1\r\n", None),
    (7, "http://e/", "x" * 300_000, None), (8, "http://f/", "x" * 300_000, None), (5, "http://a/", "same", "clash"), (None, "http://n/", "same", None),
]


def expected(rows, least=0):
    first = {}
    for i, _, h, _ in rows:
        h = h or ""
        if i is not None and len(h.encode()) >= least:
            first[h] = min(first.get(h, i), i)
    seen, out = set(), []
    for i, _, h, _ in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        h = h or ""
        n = sum((r[2] or "") == h for r in rows)
        revisit = len(h.encode()) >= least and n > 1 and ((h in first and i != first[h]) or (i, h) in seen)
        seen.add((i, h))
        out.append((i, len(h.encode()), base64.b32encode(hashlib.sha1(h.encode()).digest()).decode(), "revisit" if revisit else "response", first.get(h) if revisit else None))
    return out


def write(spark, rows, **options):
    ws = Workspace(spark, "t")
    warc.write_warc(spark.createDataFrame(rows, SCHEMA).repartition(3), ws.path("w"), ws, **options)
    return ws.path("w")


def order(rows):
    return sorted(rows, key=str)


def test_round_trip(spark):
    for least in (0, 5):
        root = write(spark, ROWS, min_revisit_bytes=least)
        got = [tuple(r)[:5] for r in warc.read_warc(spark, root).collect()]
        assert order(got) == order(expected(ROWS, least))


def test_files_are_deterministic_and_rolled(spark):
    def digests(**options):
        root = write(spark, ROWS, **options)
        rows = spark.read.json(f"{root}/MANIFEST.jsonl").collect()
        path, fs = hadoop_path(spark, f"{root}/_temporary")
        assert not fs.exists(path)
        return sorted((r.name, r.sha256, r.n_records) for r in rows)

    one = digests(shard_bytes=200_000, roll_bytes=400)
    assert one == digests(shard_bytes=200_000, roll_bytes=400) and len(one) > 3
    assert sum(n for *_, n in one) == len(ROWS)
    root = write(spark, ROWS, shard_bytes=200_000, roll_bytes=400)
    assert order(tuple(r)[:5] for r in warc.read_warc(spark, root).collect()) == order(expected(ROWS))


def headers(spark, root):
    """Of the records of each committed file, in order."""
    out = {}
    for f in sorted(r.name for r in spark.read.json(f"{root}/MANIFEST.jsonl").collect()):
        with open(f"{root}/{f}".removeprefix("file:"), "rb") as source:
            out[f] = [head for head, _ in warc.read_records(source)]
    return out


def test_record_ids(spark):
    rows = [*ROWS, ROWS[0], (5, "http://other/", "same", None)]
    heads = [h for x in headers(spark, write(spark, rows)).values() for h in x]
    ids = [h["WARC-Record-ID"] for h in heads]
    assert len(set(ids)) == len(ids) == len(rows)
    at = {h["WARC-Record-ID"]: h for h in heads}
    for h in heads:
        if h["WARC-Type"] == "revisit":
            first = at[h["WARC-Refers-To"]]
            assert first["WARC-Type"] == "response" and first["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and first.get("X-Page-ID") == h.get("X-Refers-To-Page-ID")


def test_files_close_by_compressed_bytes(spark):
    """At the defaults: pages that don't compress, so that one shard is more than one file."""
    rng = random.Random(3)
    rows = [(i, f"http://x/{i}", base64.b85encode(rng.randbytes(400_000)).decode(), None) for i in range(100)]
    root = write(spark, rows)
    files = sorted((r.name, r.n_bytes) for r in spark.read.json(f"{root}/MANIFEST.jsonl").collect())
    assert [name for name, _ in files] == ["pages-000000-0000.warc.gz", "pages-000000-0001.warc.gz"] and warc.ROLL <= files[0][1] < warc.ROLL + 500_000
    assert order(tuple(r)[:5] for r in warc.read_warc(spark, root).collect()) == order(expected(rows))


def test_empty_pages_count_in_shards(spark):
    assert len(headers(spark, write(spark, [(i, None, None, None) for i in range(100)], shard_bytes=10 * warc.HEADERS))) == 10


def test_empty(spark):
    assert warc.read_warc(spark, write(spark, [])).count() == 0
