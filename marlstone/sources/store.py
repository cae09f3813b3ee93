"""A table as numbered Parquet versions; a commit publishes all changes of a run at once."""

from __future__ import annotations

import json
import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .workspace import delete, hadoop_path

_COMMIT = re.compile(r"commit-([0-9]{12})\.json\Z")


class Conflict(RuntimeError):
    """Another writer has published this version."""


class TableStore:
    """``root`` holds a folder of files for each version and a small file ``commit-N.json`` that names it; the highest whole one is current.

    A commit writes its data to a folder of a name of its own and then creates its commit file, which fails if there is one. Nothing that readers use is changed or removed, so a reader sees one version or the next,
    a crash at any point leaves the last version current, and what a failed attempt left is in nobody's way.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _commits(self) -> list[int]:
        """Numbers of the commit files, highest first."""
        path, fs = hadoop_path(self.spark, self.root)
        names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
        return sorted((int(m[1]) for m in map(_COMMIT.match, names) if m), reverse=True)

    def _place(self, v: int) -> str:
        return f"{self.root}/commit-{v:012d}.json"

    def _folder(self, v: int) -> str | None:
        """The folder that commit ``v`` names; None where its writer didn't get to the end of the file."""
        path, fs = hadoop_path(self.spark, self._place(v))
        source = fs.open(path)
        try:
            text = self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        try:
            return json.loads(text)["folder"]
        except (ValueError, KeyError, TypeError):
            return None

    def _current(self) -> tuple[int, str] | None:
        return next(((v, folder) for v in self._commits() if (folder := self._folder(v))), None)

    def version(self) -> int | None:
        found = self._current()
        return found[0] if found else None

    def read(self, columns: list[str] | None = None, *, version: int | None = None) -> DataFrame:
        """The current version, or an earlier one: one scan, whose filters and columns Spark pushes into the files."""
        found = self._current() if version is None else (version, self._folder(version))
        if found is None or found[1] is None:
            raise FileNotFoundError(f"no version in {self.root}")
        df = self.spark.read.parquet(f"{self.root}/{found[1]}")
        return df.select(*columns) if columns else df

    def count(self) -> int:
        return self.read().count()

    def estimated_count(self) -> int:
        """Rows by the footers of the files alone: what an aggregate pushed into the scan reads."""
        before = self.spark.conf.get("spark.sql.parquet.aggregatePushdown", "false")
        sources = self.spark.conf.get("spark.sql.sources.useV1SourceList")
        self.spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
        self.spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in sources.split(",") if x != "parquet"))
        try:
            return self.read().agg(F.count("*").alias("n")).first().n
        finally:
            self.spark.conf.set("spark.sql.parquet.aggregatePushdown", before)
            self.spark.conf.set("spark.sql.sources.useV1SourceList", sources)

    def commit(self, df: DataFrame, *, sort: str | None = None, dry_run: bool = False) -> int | None:
        """Write ``df`` as the next version. sort: a column by which files are laid out, so that row-group statistics prune like an index. A dry run writes nothing."""
        if dry_run:
            return None
        v = max(self._commits(), default=-1) + 1
        folder = f"v{v}-{uuid.uuid4().hex}"
        laid = df.repartitionByRange(F.col(sort)).sortWithinPartitions(sort) if sort else df
        laid.write.parquet(f"{self.root}/{folder}")
        path, fs = hadoop_path(self.spark, self._place(v))
        try:
            out = fs.create(path, False)  # fails where the file is there
        except Exception as e:
            if fs.exists(path):
                raise Conflict(f"version {v} of {self.root} is there already") from e
            raise
        out.write(bytearray((json.dumps({"folder": folder}) + "\n").encode()))
        out.close()
        return v

    def vacuum(self, keep: int = 2) -> list[str]:
        """Delete folders that none of the last ``keep`` versions name; only while nobody writes. Their names."""
        held = [folder for v in self._commits() if (folder := self._folder(v))][:keep]
        path, fs = hadoop_path(self.spark, self.root)
        gone = sorted(n for n in (f.getPath().getName() for f in fs.listStatus(path) if f.isDirectory()) if n not in held)
        for name in gone:
            delete(self.spark, f"{self.root}/{name}")
        return gone


def delete_rows(table: DataFrame, doomed: DataFrame, key: str = "id") -> DataFrame:
    """``table`` without the keys of ``doomed``."""
    return table.join(doomed.select(key).distinct(), key, "left_anti")


def with_telemetry(table: DataFrame) -> DataFrame:
    """``table`` with the columns that lookups keep, where they are missing."""
    kinds = {"ids_checked_at": "timestamp_ntz", "ids_source": "string", "ids_confidence": "double"}
    table = table.withColumns({c: F.lit(None).cast(k) for c, k in kinds.items() if c not in table.columns})
    return table if "ids_attempts" in table.columns else table.withColumn("ids_attempts", F.lit(0))
