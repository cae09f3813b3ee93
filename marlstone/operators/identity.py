"""Which rows are the same work: identifiers, components, title aliases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.workspace import Workspace
from .components import connected_components
from .policies import missing_number, missing_text


def work_identifiers(kind: Column, imdb: Column, tmdb: Column, anilist: Column, kitsu: Column, mal: Column) -> Column:
    """Namespaced ids of a row, in the order of trust; missing ones (null, empty, 0) are left out."""
    space = F.when(kind == "movie", "movie").otherwise("tv")
    named = lambda name, c: F.when(~missing_number(c), F.concat(F.lit(f"{name}:"), c.cast("string")))
    return F.array_compact(
        F.array(
            F.when(~missing_text(imdb), F.concat(F.lit("imdb:"), F.lower(F.trim(imdb)))),
            F.when(~missing_number(tmdb), F.concat(F.lit("tmdb:"), space, F.lit(":"), tmdb.cast("string"))),
            named("anilist", anilist),
            named("kitsu", kitsu),
            named("mal", mal),
        )
    )


def title_alias(kind: Column, search_key: Column, year: Column) -> Column:
    """The name under which rows of one title meet; null for keys of less than three characters."""
    return F.when(F.length(search_key) >= 3, F.concat_ws(":", F.lit("title"), kind, search_key, F.coalesce(year.cast("string"), F.lit(""))))


def work_roots(rows: DataFrame, ws: Workspace, *, key: str = "id", ids: str = "ids", alias: str | None = "alias") -> DataFrame:
    """(key, root, by_alias, ambiguous) of every row that has an id or an alias.

    Ids that share a row are one component. A row without ids takes the component that owns its alias if exactly one does; if several do the alias is ambiguous,
    and such rows, like those whose alias nobody owns, are a work of their own under it. Roots are found before aliases link, so an alias never joins two components.

    The graph is built of distinct pairs of ids, not of rows; a row with many ids adds a chain.
    """
    name = F.col(alias) if alias else F.lit(None).cast("string")
    own = rows.select(F.col(key), F.col(ids).alias("_ids"), name.alias("_alias"))
    pairs = own.where(F.size("_ids") > 1).select(F.explode(F.transform(F.sequence(F.lit(1), F.size("_ids") - 1), lambda i: F.struct(F.element_at("_ids", i).alias("a"), F.element_at("_ids", i + 1).alias("b")))).alias("e"))
    labels = connected_components(pairs.select("e.a", "e.b").distinct(), "a", "b", ws, "work")
    first = own.withColumn("_first", F.when(F.size("_ids") > 0, F.element_at("_ids", 1)))
    rooted = first.join(labels.select(F.col("node").alias("_first"), F.col("component").alias("_c")), "_first", "left").withColumn("_root", F.coalesce("_c", "_first"))
    owners = rooted.where("_root is not null and _alias is not null").groupBy("_alias").agg(F.min("_root").alias("_owner"), (F.min("_root") != F.max("_root")).alias("_many"))
    joined = rooted.join(owners, "_alias", "left")
    root = F.coalesce("_root", F.when(F.coalesce("_many", F.lit(True)), F.col("_alias")).otherwise(F.col("_owner")))
    return joined.select(key, root.alias("root"), (F.col("_root").isNull() & F.col("_alias").isNotNull()).alias("by_alias"), (F.col("_root").isNull() & F.coalesce("_many", F.lit(False))).alias("ambiguous")).where("root is not null")


def whole_number(c: Column) -> Column:
    """A number or numeric text cut towards zero; anything else is null."""
    x = F.trim(c.cast("string")).try_cast("double")
    cut = F.when(x < 0, F.ceil(x)).otherwise(F.floor(x))
    return F.when(~F.isnan(x) & (F.abs(x) < 1e15), cut).cast("long")


def episode_key(kind: Column, season: Column, episode: Column, absolute: Column, *, episode_end: Column, season_end: Column, complete: Column) -> Column:
    """What part of its work a row is: movie, an episode or range, a season pack, complete, or full where nothing says. season, episode and absolute are the stored values or else the parsed ones."""
    text = lambda c: c.cast("string")
    span = F.when(episode_end.isNotNull() & (episode_end != episode), F.concat(F.lit("-e"), text(episode_end))).otherwise("")
    seasons = F.when(season_end.isNotNull() & (season_end != season), F.concat(F.lit("-s"), text(season_end))).otherwise("")
    first = (kind == "anime") & (season.isNull() | (season == 1))
    return (
        F.when((kind == "movie") & episode.isNull() & season.isNull(), "movie")
        .when(episode.isNotNull() & (season.isNull() | F.coalesce(first, F.lit(False))), F.concat(F.lit("e"), text(episode), span))
        .when(episode.isNotNull(), F.concat(F.lit("s"), text(season), F.lit("e"), text(episode), span))
        .when(absolute.isNotNull(), F.concat(F.lit("e"), text(absolute)))
        .when(season.isNotNull(), F.concat(F.lit("s"), text(season), seasons, F.lit("pack")))
        .otherwise(F.when(F.coalesce(complete, F.lit(False)), "complete").otherwise("full"))
    )
