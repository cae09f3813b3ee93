"""Sparse patches: which columns change, and to what."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.labels import codec_label, fit, pick_quality, type_label
from ..functions.languages import language_labels, union_sorted


def patch_of(df: DataFrame, key: str, new: Mapping[str, tuple[Column, Column]]) -> DataFrame:
    """(key, changed, one column for each of ``new``) for rows with a change.

    new: for each column its value and the condition under which it is set. ``changed`` names the columns, so that a value set to null differs from one left alone.
    """
    names = list(new)
    picked = df.select(key, *[F.when(F.coalesce(test, F.lit(False)), value).alias(n) for n, (value, test) in new.items()], F.array_compact(F.array(*[F.when(F.coalesce(test, F.lit(False)), n) for n, (_, test) in new.items()])).alias("changed"))
    return picked.where(F.size("changed") > 0).select(key, "changed", *names)


def diff(before: DataFrame, after: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """The patch that turns ``before`` into ``after`` in these columns; keys are unique on either side."""
    b = after.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = before.select(key, *columns).join(b, key)
    return patch_of(joined, key, {c: (F.col(f"_new_{c}"), ~F.col(c).eqNullSafe(F.col(f"_new_{c}"))) for c in columns})


def apply_patch(table: DataFrame, patch: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """``table`` with the patched values: a column takes the patch's value where ``changed`` names it. Other columns, freshness among them, stay."""
    p = patch.select(F.col(key).alias("_key"), "changed", *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = table.join(p, table[key] == F.col("_key"), "left")
    return joined.select(*[F.when(F.array_contains("changed", c), F.col(f"_new_{c}")).otherwise(table[c]).alias(c) if c in columns else table[c] for c in table.columns])


def refreshed(before: DataFrame, after: DataFrame, key: str, sources: Sequence[str], at, *, freshness: str = "updated_at") -> DataFrame:
    """``after`` with the freshness rule of the table: it becomes ``at`` where a column that the source of the rows maintains has changed, and stays what it was where only maintenance wrote.

    Rows that ``before`` lacks are fresh; rows that it alone has are gone.
    """
    old = before.select(F.col(key).alias("_key"), F.col(freshness).alias("_then"), *[F.col(c).alias(f"_old_{c}") for c in sources])
    joined = after.join(old, after[key] == F.col("_key"), "left")
    moved = reduce(lambda a, b: a | b, [~after[c].eqNullSafe(F.col(f"_old_{c}")) for c in sources], F.col("_key").isNull())
    return joined.select(*[F.when(moved, F.lit(at)).otherwise(F.col("_then")).cast(after.schema[freshness].dataType).alias(c) if c == freshness else after[c] for c in after.columns])


def histogram(patch: DataFrame) -> DataFrame:
    """Changes for each column."""
    return patch.select(F.explode("changed").alias("column_name")).groupBy("column_name").agg(F.count("*").alias("n_changes"))


def split_valid(patch: DataFrame, rules: Mapping[str, Column]) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected with ``reasons``): a rule is checked where its column changes and the value isn't null; one bad row doesn't hold back others."""
    bad = F.array_compact(F.array(*[F.when(F.array_contains("changed", c) & F.col(c).isNotNull() & ~F.coalesce(ok, F.lit(False)), c) for c, ok in rules.items()]))
    marked = patch.withColumn("reasons", bad)
    return marked.where(F.size("reasons") == 0).drop("reasons"), marked.where(F.size("reasons") > 0)


#: What the table demands of patched values.
CONSTRAINTS = {
    "imdb_id": "imdb_id rlike '^tt[0-9]+$'",
    "type": "type in ('movie', 'series', 'anime')",
    "codec": "length(codec) <= 20",
    "quality": "length(quality) <= 20",
}


def constraint_columns(names: Sequence[str]) -> dict[str, Column]:
    return {n: F.expr(CONSTRAINTS[n]) for n in names if n in CONSTRAINTS}


def exact_int(c: Column) -> Column:
    """The integer of a number or text if it is exactly one, else null."""
    t = F.trim(c.cast("string"))
    return F.when(t.rlike(r"\A[+-]?[0-9]+(?:\.0*)?\z"), F.regexp_replace(t, r"\.0*\z", "").try_cast("int"))


def normalisation_patch(table: DataFrame, parsed: str, *, key: str = "id", clean_title: str = "title_text", overwrite_type: bool = False, overwrite_episodes: bool = False, merge_languages: bool = True, confidence: float = 0.8) -> DataFrame:
    """What normalising changes in each row. parsed: the column with the struct of the parser.

    The clean title is set if it differs; an unknown kind becomes the parsed one and a known spelling its label; episode numbers fill nulls, and text that is a number
    becomes one; codec and quality become labels; languages become sorted labels, joined with the title's. Null stays where nothing is known.
    """
    p = lambda n: F.col(f"{parsed}.{n}")
    table = table.withColumn("_labels_audio", language_labels(F.col("audio"))).withColumn("_labels_subtitles", language_labels(F.col("subtitles")))
    kinds = {f.name: f.dataType.simpleString() for f in table.schema.fields}
    label = type_label(F.col("type"))
    overwrite = F.lit(overwrite_type) & (p("type") != label) & (p("type_confidence") >= confidence)
    kind = F.when(label.isNull(), p("type")).when(~label.eqNullSafe(F.col("type")), label).when(overwrite, p("type"))
    final = F.coalesce(kind, label)
    new = {clean_title: (p("clean_title"), (F.coalesce(p("clean_title"), F.lit("")) != "") & ~p("clean_title").eqNullSafe(F.coalesce(F.col(clean_title), F.lit("")))), "type": (fit("type", kind), kind.isNotNull())}
    for column in ("season", "episode", "absolute_episode"):
        now, value = exact_int(F.col(column)), p(column)
        fills = ((final != "movie") | p("episode").isNotNull()) & value.isNotNull() & (now.isNull() | (F.lit(overwrite_episodes) & (now != value)))
        as_text = F.lit(kinds[column] == "string") & now.isNotNull()
        new[column] = (F.when(fills, value).otherwise(now), fills | as_text)
    codec, quality = F.coalesce(codec_label(F.col("codec")), p("codec")), pick_quality(F.col("quality"), p("quality"))
    new["codec"] = (fit("codec", codec), codec.isNotNull() & ~codec.eqNullSafe(F.col("codec")))
    new["quality"] = (fit("quality", quality), quality.isNotNull() & ~quality.eqNullSafe(F.col("quality")))
    for column in ("audio", "subtitles"):
        labels = F.col(f"_labels_{column}")
        labels = union_sorted(labels, p(column)) if merge_languages else labels
        if kinds[column] == "string":
            none, same = F.coalesce(F.col(column), F.lit("")) == "", F.lit(False)
        else:
            none, same = F.coalesce(F.size(column), F.lit(0)) <= 0, labels.eqNullSafe(F.col(column))
        new[column] = (labels, ~same & ~((F.size(labels) == 0) & none))
    return patch_of(table, key, new)
