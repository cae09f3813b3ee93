"""Row policies on streams: predicates are plain columns, so a stream takes them as a table does."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def keep_stream(stream: DataFrame, doomed: Column) -> DataFrame:
    """Rows of a stream that a policy doesn't doom; stateless, so it needs no watermark."""
    return stream.where(~F.coalesce(doomed, F.lit(False)))
