"""Files written by tasks and committed by the driver: temporary names, then final names, then a manifest."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession

from .workspace import delete, hadoop_path

MANIFEST = "MANIFEST.jsonl"


def open_fs(uri: str):
    """(filesystem, path) of a URI as pyarrow sees it: local paths and file, hdfs, s3 and gs URIs."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri)


def temporary(root: str, suffix: str) -> str:
    """A name that no other attempt of the same task uses."""
    return f"{root}/_temporary/{uuid.uuid4().hex}{suffix}"


def commit(spark: SparkSession, root: str, files: list[dict]) -> None:
    """Give each file (``tmp``: where a finished task wrote it, ``name``: its final name) its name, and write the manifest last.

    A reader that goes by the manifest sees all files or none. What failed or repeated attempts left goes with the temporary
    folder. The list has an entry for each file, not for each row.
    """
    top, fs = hadoop_path(spark, root)
    fs.mkdirs(top)
    for f in files:
        if not fs.rename(hadoop_path(spark, f["tmp"])[0], hadoop_path(spark, f"{root}/{f['name']}")[0]):
            raise OSError(f"can't rename {f['tmp']} to {f['name']}")
    part, _ = hadoop_path(spark, f"{root}/_{MANIFEST}")
    out = fs.create(part, True)
    out.write(bytearray("".join(json.dumps({k: v for k, v in f.items() if k != "tmp"}, sort_keys=True) + "\n" for f in files).encode()))
    out.close()
    if not fs.rename(part, hadoop_path(spark, f"{root}/{MANIFEST}")[0]):
        raise OSError("can't write the manifest")
    delete(spark, f"{root}/_temporary")


def manifest(spark: SparkSession, root: str, schema: str) -> DataFrame:
    """The committed files, one partition each."""
    files = spark.read.schema(schema).json(f"{root}/{MANIFEST}")
    n = files.count()
    return files.repartitionByRange(max(1, n), "name")
