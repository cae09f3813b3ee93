"""Intermediate tables in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; only where that is unset and all runs in this process (tests) a temporary one, which is then set."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if sc.getCheckpointDir() is None:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="marlstone-"))
    return sc.getCheckpointDir().rstrip("/")


#: Spark's setting to delete an execution's shuffle files when it ends.
_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Workspace:
    """Named Parquet tables below the shared folder.

    A saved table cuts the lineage: a lost executor costs only the tasks that ran on it, and what is read twice is computed
    once. Tables still needed by a returned DataFrame stay until the session ends; others go with ``drop``.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
        atexit.register(self.close)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    @contextmanager
    def shuffles_dropped(self) -> Iterator[None]:
        """Shuffle files of the writes made inside go when each write ends: nothing reads them again."""
        before = self.spark.conf.get(_SHUFFLES, "false")
        self.spark.conf.set(_SHUFFLES, "true")
        try:
            yield
        finally:
            self.spark.conf.set(_SHUFFLES, before)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        with self.shuffles_dropped():
            df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            delete(self.spark, self.path(name))

    def close(self) -> None:
        try:
            delete(self.spark, self.root)
        except Exception:  # noqa: BLE001  the session may have ended before
            pass


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete(spark: SparkSession, path: str) -> None:
    p, fs = hadoop_path(spark, path)
    fs.delete(p, True)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
