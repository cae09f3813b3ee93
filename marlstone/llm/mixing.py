"""Mixing sources to target weights."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"
#: Rows that a range of a source holds, about, if all rows were of that source.
RANGE_ROWS = 1 << 16


def _keyed(docs: DataFrame, id_col: str, text_col: str, source_col: str, seed: str) -> DataFrame:
    text, ident = F.col(text_col), F.col(id_col).cast("string")
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(ident, F.concat(F.lit("null:"), F.md5(F.coalesce(text, F.lit("")))))))
    return docs.select(
        "*",
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("_mix_size"),
        key.alias("_mix_key"),
        F.xxhash64(text).alias("_mix_text"),
        F.when(F.col(source_col).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), F.col(source_col))).alias("_mix_source"),
    )


def _in_ranges(keyed: DataFrame, digits: int) -> DataFrame:
    return keyed.withColumn("_mix_bucket", F.conv(F.substring("_mix_key", 1, digits), 16, 10).cast("int"))


def _ranked(sources: DataFrame, ws: Workspace) -> DataFrame:
    """Adds _mix_rank, the place by code point from 0 with the null source last: range partitions plus the sum of their counts."""
    order = [(F.col("_mix_source") == "n").asc(), F.col("_mix_source").asc()]
    parted = ws.save(sources.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_pid", F.spark_partition_id()), "sources-sorted")
    counts = parted.groupBy("_pid").count()
    before = counts.select("_pid", (F.sum("count").over(Window.orderBy("_pid")) - F.col("count")).alias("_before"))
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order))
    return parted.withColumn("_row", local).join(before, "_pid").withColumn("_mix_rank", F.col("_row") - 1 + F.col("_before")).drop("_pid", "_row", "_before")


def _targets(sources: DataFrame, weights: Sequence[int], cap: int, ws: Workspace) -> DataFrame:
    """Adds _mix_target: shares of all words by weight, stopped at cap times the source's words, the excess shared again."""
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), (F.col("_mix_rank") % len(weights) + 1).cast("int"))
    s = ws.save(_ranked(sources, ws).withColumn("_w", w).withColumn("_most", F.col("_mix_total") * cap), "sources")
    total = s.agg(F.coalesce(F.sum("_mix_total"), F.lit(0))).first()[0]
    capped, n = F.lit(False), 0
    while True:  # a source that is stopped once stays so: the level only rises
        x = s.agg(
            F.coalesce(F.sum(F.when(~capped, F.col("_w"))), F.lit(0)).alias("w"),
            F.coalesce(F.sum(F.when(capped, F.col("_most"))), F.lit(0)).alias("c"),
        ).first()
        share = F.col("_w") * F.lit(total - x.c) / F.lit(max(x.w, 1)).cast("double")
        more = capped | (share > F.col("_most"))
        now = s.where(more).count()
        if now == n:
            return s.withColumn("_mix_target", F.when(capped, F.col("_most").cast("double")).otherwise(share))
        capped, n = share > F.col("_most"), now


def plan_mix(docs: DataFrame, ws: Workspace, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: Sequence[int] = (1, 2, 3), cap: int = 3, seed: str = "mix", bucket_digits: int | None = None, carry: Sequence[str] | None = None) -> DataFrame:
    """Mix ``docs`` so that each source's words come to its target exactly.

    Every row gets a hash-random key (md5 of seed and id). The keys are uniform, so their leading hex digits cut each source
    into ranges of equal expectation, however many rows a source has: 16**bucket_digits ranges a source (by default so many that one holds RANGE_ROWS, had one source all rows), each small enough to be sorted by one
    task. A distributed prefix sum over the ranges plus one inside a range gives each row the words before it; a source
    takes its rows floor(target / total) times whole and then up to its exact budget, whose last row counts in part.

    carry: columns to return besides; None returns the id alone. Adds ``size``, ``source_size``, ``target``, ``taken``
    and ``_mix_before`` (words of the source before the row), ``_mix_rest`` (the words of the last, partial epoch) and
    ``_mix_epochs``.

    Defined cases: a null text has 0 words; the null source is a source of its own, weighed last; a source without words has
    target 0; rows without an id are keyed by their text; rows with one id go by size and then by a hash of their text, and equal rows tie, where either order gives the same rows; an empty
    table gives an empty result. Other columns are ignored.
    """
    names = [id_col] if carry is None else list(carry)
    need = list(dict.fromkeys([*names, id_col, text_col, source_col]))
    narrow = _keyed(docs.select(id_col, text_col, source_col), id_col, text_col, source_col, seed).drop(text_col, source_col)
    narrow = ws.save(narrow, "keys")
    digits = bucket_digits or min(6, max(2, math.ceil(math.log(max(1, narrow.count()) / RANGE_ROWS, 16))))
    narrow = _in_ranges(narrow, digits)
    ranges = ws.save(narrow.groupBy("_mix_source", "_mix_bucket").agg(F.sum("_mix_size").alias("_in_range")), "ranges")
    sources = _targets(ranges.groupBy("_mix_source").agg(F.sum("_in_range").alias("_mix_total")), weights, cap, ws)
    prefix = F.sum("_in_range").over(Window.partitionBy("_mix_source").orderBy("_mix_bucket")) - F.col("_in_range")
    cuts = ranges.withColumn("_range_before", prefix).drop("_in_range").join(sources.select("_mix_source", "_mix_total", "_mix_target"), "_mix_source")
    rows = narrow if carry is None else _in_ranges(_keyed(docs.select(need), id_col, text_col, source_col, seed), digits)
    inside = Window.partitionBy("_mix_source", "_mix_bucket").orderBy("_mix_key", id_col, "_mix_size", "_mix_text").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    budget = F.floor("_mix_target").cast("long")
    size, total, rest = F.col("_mix_size"), F.col("_mix_total"), F.col("_mix_rest")
    out = (
        rows.join(cuts, ["_mix_source", "_mix_bucket"])
        .withColumn("_mix_before", F.col("_range_before") + F.sum("_mix_size").over(inside) - size)
        .withColumn("_mix_epochs", F.when(total > 0, F.floor(budget / total)).otherwise(0).cast("long"))
        .withColumn("_mix_epochs", F.when(F.col("_mix_epochs") * total > budget, F.col("_mix_epochs") - 1).otherwise(F.col("_mix_epochs")))
        .withColumn("_mix_rest", budget - F.col("_mix_epochs") * total)
        .withColumn("_mix_taken", F.col("_mix_epochs") * size + F.greatest(F.lit(0), F.least(size, rest - F.col("_mix_before"))))
    )
    kept = [F.col(c) for c in names]
    return out.select(*kept, size.alias("size"), total.alias("source_size"), F.col("_mix_target").alias("target"), F.col("_mix_taken").alias("taken"), "_mix_before", "_mix_rest", "_mix_epochs")


def mixed_documents(docs: DataFrame, ws: Workspace, **options) -> DataFrame:
    """The mix itself: rows of ``docs``, each as often as the mix takes it.

    A document is written whole: the one on the edge of its source's budget is taken once more if at least half of it lies
    inside. A document without words is never part of a budget and so isn't returned. Columns are those of ``docs``, of whatever names; a column called like a helper of this
    module (``_mix_...``) is carried through.
    """
    cols = docs.columns
    safe = docs.toDF(*[f"c{i}" for i in range(len(cols))])
    place = {n: f"c{cols.index(options.pop(k, n))}" for k, n in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    planned = plan_mix(safe, ws, id_col=place["doc_id"], text_col=place["text"], source_col=place["source"], carry=safe.columns, **options)
    inside = F.least(F.col("size"), F.col("_mix_rest") - F.col("_mix_before"))
    copies = F.when(F.col("size") > 0, F.col("_mix_epochs") + (2 * inside >= F.col("size")).cast("long")).otherwise(0)
    return planned.where(copies > 0).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), copies))).select(*[F.col(c).alias(n) for c, n in zip(safe.columns, cols, strict=True)])
