"""Row functions over Arrow batches: one Python pass in the scan's own tasks, without a shuffle."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType, _parse_datatype_string

#: Characters of text handed to Python functions at a time are bounded by rows; long texts come alone after a slice.
ROWS = 512


def add_columns(df: DataFrame, inputs: Sequence[str], schema: str, start: Callable[[], Callable[..., tuple | None]], keep: Sequence[str] | None = None) -> DataFrame:
    """``keep`` columns of ``df`` (all if None) plus the columns of ``schema``.

    start() runs once a task and gives the function of a row's ``inputs`` that returns its new values, or None to leave the row
    out. Names of new columns must differ from the kept ones.
    """
    cols = list(df.columns if keep is None else keep)
    read = list(dict.fromkeys([*cols, *inputs]))
    new = _parse_datatype_string(schema)
    kinds = [to_arrow_type(f.dataType) for f in new.fields]
    names = [f.name for f in new.fields]
    at = [read.index(c) for c in inputs]
    kept = [read.index(c) for c in cols]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        row = start()
        for whole in batches:
            for i in range(0, whole.num_rows, ROWS):
                batch = whole.slice(i, ROWS)
                made = [row(*(v.as_py() for v in values)) for values in zip(*(batch.column(k) for k in at), strict=True)]
                left = [m for m in made if m is not None]
                if len(left) < len(made):
                    batch = batch.filter(pa.array([m is not None for m in made]))
                fresh = [pa.array([m[j] for m in left], kind) for j, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in kept), *fresh], names=[*cols, *names])

    source = df.select(*read)
    return source.mapInArrow(run, StructType([*(source.schema[c] for c in cols), *new.fields]))


def positional(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """``df`` with columns c0, c1, ... (so that no name can clash), and the names to give back with toDF."""
    return df.toDF(*[f"c{i}" for i in range(len(df.columns))]), df.columns
