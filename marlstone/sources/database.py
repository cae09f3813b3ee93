"""A table that lives in a database: ranged reads by Spark, and sparse updates and deletes in batches by tasks, over any DB-API connection."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .resolver import Transient, with_retry

#: What a server says of an error that another try may not meet (SQLSTATE classes and words), and of one in the data itself.
TRANSIENT_STATES = ("08", "40", "53", "55", "57")
DATA_STATES = ("22", "23", "42804")
_TRANSIENT_WORDS = re.compile(r"time[d ]?\s?out|connection|reset|refused|unavailable|too many|deadlock|serializ|locked|network|temporar|shutting down", re.IGNORECASE)
_DATA_WORDS = re.compile(r"constraint|too long|invalid input|out of range|datatype mismatch|not null", re.IGNORECASE)
_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*\Z")


def is_data_error(error: BaseException) -> bool:
    """Whether the rows themselves are at fault: the batch must be taken apart, not tried again."""
    state = str(getattr(error, "sqlstate", None) or getattr(error, "pgcode", None) or "")
    return state.startswith(DATA_STATES) if state else bool(_DATA_WORDS.search(str(error)))


def is_transient(error: BaseException) -> bool:
    """Whether another try may do."""
    state = str(getattr(error, "sqlstate", None) or getattr(error, "pgcode", None) or "")
    if state:
        return state.startswith(TRANSIENT_STATES)
    return not is_data_error(error) and (isinstance(error, (TimeoutError, ConnectionError)) or bool(_TRANSIENT_WORDS.search(str(error))))


def read_jdbc(spark: SparkSession, url: str, table: str, *, key: str, low: int, high: int, parts: int, properties: dict[str, str] | None = None) -> DataFrame:
    """A database table in ranges of its key, read by as many tasks; filters and columns go to the database. The driver's jar must be on the class path."""
    return spark.read.jdbc(url, table, column=key, lowerBound=low, upperBound=high, numPartitions=parts, properties=properties or {})


class _Session:
    """One task's connection; opened again after a transient error."""

    def __init__(self, connect: Callable[[], object], tries: int):
        self._connect, self._tries, self._open = connect, tries, None

    def run(self, work: Callable[[object], None]) -> None:
        """``work`` with a cursor, as one transaction, again after transient errors."""

        def once() -> None:
            try:
                self._open = self._open or self._connect()
                cursor = self._open.cursor()
                work(cursor)
                self._open.commit()
            except Exception as e:
                if self._open is not None:
                    try:
                        self._open.rollback()
                    except Exception:  # noqa: BLE001  the connection is gone; the error that matters is raised below
                        self._open = None
                if is_transient(e):
                    self.close()
                    raise Transient(str(e)) from e
                raise

        with_retry(once, tries=self._tries)

    def close(self) -> None:
        connection, self._open = self._open, None
        if connection is not None:
            try:
                connection.close()
            except Exception:  # noqa: BLE001  it may be broken
                pass


def _batches(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while part := list(itertools.islice(rows, size)):
        yield part


def _names(*names: str) -> None:
    for n in names:
        if not all(_NAME.match(part) for part in n.split(".")):
            raise ValueError(f"not a name: {n}")


def _apply(df: DataFrame, connect: Callable[[], object], execute: Callable, key: str, batch: int, tries: int) -> DataFrame:
    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        session = _Session(connect, tries)
        try:
            for part in _batches((row for p in parts for row in p.to_pylist()), batch):
                done, failed = 0, []
                try:
                    session.run(lambda cursor, part=part: [execute(cursor, row) for row in part])
                    done = len(part)
                except Exception as e:
                    if not is_data_error(e):
                        raise
                    for row in part:  # one bad row must not keep the others out
                        try:
                            session.run(lambda cursor, row=row: execute(cursor, row))
                            done += 1
                        except Exception as own:  # noqa: BLE001
                            if not is_data_error(own):
                                raise
                            failed.append((str(row[key]), str(own)))
                yield pa.RecordBatch.from_arrays([pa.array([done, *[0] * len(failed)], pa.int64()), pa.array([None, *[f[0] for f in failed]], pa.string()), pa.array([None, *[f[1] for f in failed]], pa.string())], names=["done", key, "error"])
        finally:
            session.close()

    return df.mapInArrow(run, f"done long, `{key}` string, error string")


def update_rows(patch: DataFrame, connect: Callable[[], object], table: str, columns: Sequence[str], *, key: str = "id", batch: int = 500, tries: int = 4, mark: str = "?") -> DataFrame:
    """Write a sparse patch (key, ``changed``, columns) to a database table; run by the action on its result: ``done`` rows for each batch, and the key and error of each row that the database refuses.

    Only the columns that ``changed`` names are set, so others keep what anyone else wrote meanwhile. A batch is one transaction; if its data are at fault its rows go one by one, and transient errors are tried again with a new
    connection. Updates set values, so a task that runs again does no harm. connect: opens a DB-API connection in a task; mark: its placeholder; a patch with 200 partitions opens up to that many, so repartition it to what the server bears.

    Defined cases: rows with nothing changed and keys that the table lacks change nothing; a null in a changed column sets null; equal keys are all written, in any order; an empty patch opens no connection.
    """
    _names(table, key, *columns)

    def execute(cursor, row: dict) -> None:
        named = [c for c in columns if c in (row["changed"] or ())]
        if named:
            cursor.execute(f"UPDATE {table} SET {', '.join(f'{c} = {mark}' for c in named)} WHERE {key} = {mark}", [*(row[c] for c in named), row[key]])

    return _apply(patch.select(key, "changed", *columns), connect, execute, key, batch, tries)


def delete_ids(doomed: DataFrame, connect: Callable[[], object], table: str, *, key: str = "id", batch: int = 500, tries: int = 4, mark: str = "?") -> DataFrame:
    """Delete the keys of ``doomed`` from a database table, in batches, as ``update_rows`` does; keys that are gone already do no harm."""
    _names(table, key)
    return _apply(doomed.select(key).where(F.col(key).isNotNull()).distinct(), connect, lambda cursor, row: cursor.execute(f"DELETE FROM {table} WHERE {key} = {mark}", [row[key]]), key, batch, tries)
