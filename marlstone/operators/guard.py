"""The guard against runaway deletes."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MIN_ROWS = 10


class DeleteGuard(RuntimeError):
    """A rule would delete too large a share."""


def exceeds(pending: float, evaluated: float, most: float, min_rows: int = MIN_ROWS) -> bool:
    """Whether deleting ``pending`` of ``evaluated`` rows must be stopped: strictly more than the share ``most``, or numbers that make no sense; few rows may all go."""
    if not all(map(math.isfinite, (pending, evaluated, most))) or pending < 0 or evaluated < 0 or not 0 <= most <= 1:
        return True
    if pending == 0:
        return False
    if evaluated == 0 or pending > evaluated:
        return True
    return evaluated >= min_rows and pending / evaluated > most


def blocked(pending: Column, evaluated: Column, most: float, min_rows: int = MIN_ROWS) -> Column:
    """``exceeds`` as a column."""
    bad = pending.isNull() | evaluated.isNull() | (pending < 0) | (evaluated < 0) | F.lit(not (math.isfinite(most) and 0 <= most <= 1))
    return bad | ((pending > 0) & ((evaluated == 0) | (pending > evaluated) | ((evaluated >= min_rows) & (pending / F.nullif(evaluated, F.lit(0)) > most))))


def describe(label: str, pending: int, evaluated: int, most: float) -> str:
    share = f" ({100 * pending / evaluated:.1f} %)" if evaluated else ""
    return f"{label}: would delete {pending} of {evaluated} rows{share}; at most {100 * most:.1f} % are allowed"


def check(df: DataFrame, rules: dict[str, tuple[Column, Column]], most: float, min_rows: int = MIN_ROWS) -> dict[str, tuple[int, int]]:
    """Counts of (doomed, evaluated) rows for each rule, by one aggregation over one scan; raises before anything is deleted if any rule exceeds its share."""
    counts = df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(f"{i}{j}") for i, pair in enumerate(rules.values()) for j, c in enumerate(pair)]).first()
    found = {label: (counts[f"{i}0"], counts[f"{i}1"]) for i, label in enumerate(rules)}
    for label, (pending, evaluated) in found.items():
        if exceeds(pending, evaluated, most, min_rows):
            raise DeleteGuard(describe(label, pending, evaluated, most))
    return found
