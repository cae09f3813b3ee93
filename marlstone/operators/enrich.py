"""Work groups, propagation of ids inside them, and lookups against catalogue tables.

Catalogues are DataFrames: ``search`` (source, kind, work_id, title, alt_titles, year, popularity, rank, and perhaps mal_id), ``bridge`` (site, external_id, kitsu_id),
``find`` (imdb_id, kind, tmdb_id) and ``external`` (kind, tmdb_id, imdb_id). Exact joins come first; only what they leave unresolved is matched by title.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.release import variants
from ..functions.text import adjusted_score, best_similarity, search_key

ID_COLUMNS = ("imdb_id", "tmdb_id", "anilist_id", "kitsu_id", "mal_id")
TELEMETRY = ("ids_checked_at", "ids_source", "ids_confidence", "ids_attempts")


def has_telemetry(df: DataFrame) -> bool:
    """Whether attempts can be tracked: by the columns, without a probe."""
    return {"ids_checked_at", "ids_attempts"} <= set(df.columns)


def work_key(kind: Column, key: Column, year: Column, season: Column) -> Column:
    late = F.when((kind == "anime") & (season > 1), season.cast("string")).otherwise("")
    return F.concat_ws("|", kind, key, F.coalesce(year.cast("string"), F.lit("")), late)


def work_groups(rows: DataFrame, *, key: str = "id", kind: str = "kind", title_key: str = "search_key", year: str = "year", season: str = "season", needed: str = "needed", ids: Sequence[str] = ID_COLUMNS, attempts: str | None = None, flags: Sequence[str] = ()) -> DataFrame:
    """One row for each work: its rows' number, the first id known of each sort (by the smallest key), the ids needed, the most attempts, and for each of ``flags`` whether any row has it.

    A work without a year joins the one work of the same kind, title and season that has one; if several do its year is ambiguous.
    """
    base = rows.withColumn("_season", F.when((F.col(kind) == "anime") & (F.col(season) > 1), F.col(season)))
    bucket = ["_bk", "_bt", "_bs"]
    base = base.withColumn("_bk", F.col(kind)).withColumn("_bt", F.col(title_key)).withColumn("_bs", F.coalesce("_season", F.lit(0)))
    years = base.groupBy(*bucket).agg(F.min(year).alias("_low"), F.max(year).alias("_high"))
    placed = base.join(years, bucket)
    merged = F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.col(year))
    unsure = F.col(year).isNull() & (F.col("_low") != F.col("_high"))
    placed = placed.withColumn("_year", merged).withColumn("_unsure", F.coalesce(unsure, F.lit(False))).withColumn("work", work_key(F.col(kind), F.col(title_key), F.col("_year"), F.col("_season")))
    known = [F.min_by(F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "0") & (F.col(c).cast("string") != ""), F.col(c)), F.when(F.col(c).isNotNull() & (F.col(c).cast("string") != "0") & (F.col(c).cast("string") != ""), F.col(key))).alias(c) for c in ids]
    needs = F.array_sort(F.array_distinct(F.flatten(F.collect_set(needed)))).alias("needed")
    tries = F.max(F.coalesce(F.col(attempts), F.lit(0))).alias("attempts") if attempts else F.lit(0).alias("attempts")
    return placed.groupBy("work", F.col("_bk").alias("kind"), F.col("_bt").alias("search_key"), F.col("_year").alias("year"), F.col("_season").alias("season")).agg(F.count("*").alias("n_rows"), F.max("_unsure").alias("ambiguous_year"), *known, needs, tries, *[F.max(F.coalesce(F.col(f), F.lit(False))).alias(f) for f in flags])


def still_needed(groups: DataFrame, ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """``groups`` with ``open``: the needed ids that nothing in the group knows."""
    known = F.array_compact(F.array(*[F.when(F.col(c).isNotNull(), c) for c in ids]))
    return groups.withColumn("open", F.array_except("needed", known))


def propagate(rows: DataFrame, groups: DataFrame, *, work: str = "work", ids: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """``rows`` with the ids that they miss and their group knows; ``filled`` names those."""
    g = groups.select(F.col("work").alias("_work"), *[F.col(c).alias(f"_g_{c}") for c in ids])
    joined = rows.join(g, rows[work] == F.col("_work"), "left")
    lacks = {c: (rows[c].isNull() | (rows[c].cast("string") == "0") | (rows[c].cast("string") == "")) & F.col(f"_g_{c}").isNotNull() for c in ids}
    return joined.select(*[F.when(lacks[c], F.col(f"_g_{c}")).otherwise(rows[c]).alias(c) if c in ids else rows[c] for c in rows.columns], F.array_compact(F.array(*[F.when(lacks[c], c) for c in ids])).alias("filled"))


def lookup_budget(groups: DataFrame, most: int) -> DataFrame:
    """The works to look up in this run: the largest first, then by name. The number is the feature: a quota of the catalogues."""
    return groups.where((F.size("open") > 0) & ~F.col("ambiguous_year")).orderBy(F.col("n_rows").desc(), "work").limit(most)


def by_external_id(works: DataFrame, bridge: DataFrame, site: str, id_col: str) -> DataFrame:
    """``works`` with the kitsu id that the bridge has first for their id at ``site``."""
    first = bridge.where(F.col("site") == site).groupBy("external_id").agg(F.min("kitsu_id").alias("bridged_kitsu_id"))
    return works.join(first.withColumnRenamed("external_id", id_col), id_col, "left")


def ids_of_kitsu(works: DataFrame, bridge: DataFrame, kitsu_col: str = "kitsu_id", sites: dict[str, str] | None = None) -> DataFrame:
    """``works`` with one column for each site's id of their kitsu id."""
    sites = sites or {"anilist/anime": "bridged_anilist_id", "myanimelist/anime": "bridged_mal_id"}
    back = bridge.where(F.col("site").isin(*sites)).groupBy("kitsu_id").agg(*[F.min(F.when(F.col("site") == s, F.col("external_id"))).alias(n) for s, n in sites.items()])
    return works.join(back.withColumnRenamed("kitsu_id", kitsu_col), kitsu_col, "left")


def find_by_imdb(works: DataFrame, find: DataFrame, *, imdb: str = "imdb_id", kind: str = "kind") -> DataFrame:
    """``works`` with the tmdb id and kind behind their imdb id, of the work's own kind if there is one."""
    own = F.when(F.col(kind) == "movie", "movie").otherwise("tv")
    hits = works.select("work", F.col(imdb).alias("_imdb"), own.alias("_own")).join(find.select(F.col("imdb_id").alias("_imdb"), F.col("kind").alias("_kind"), F.col("tmdb_id").alias("_tmdb")), "_imdb")
    best = hits.groupBy("work").agg(F.min(F.struct((F.col("_kind") != F.col("_own")).alias("other"), F.col("_kind").alias("kind"), F.col("_tmdb").alias("tmdb_id"))).alias("_hit"))
    return works.join(best, "work", "left").withColumn("found_tmdb_id", F.col("_hit.tmdb_id")).withColumn("found_kind", F.col("_hit.kind")).drop("_hit")


def external_ids(works: DataFrame, external: DataFrame, *, tmdb: str = "tmdb_id", kind: str = "kind") -> DataFrame:
    """``works`` with the imdb id behind their tmdb id, which counts by kind: movie, or tv for all others."""
    own = F.when(F.col(kind) == "movie", "movie").otherwise("tv")
    table = external.select(F.col("kind").alias("_kind"), F.col("tmdb_id").alias("_tmdb"), F.col("imdb_id").alias("found_imdb_id")).dropDuplicates(["_kind", "_tmdb"])
    return works.join(table, (own == F.col("_kind")) & (F.col(tmdb) == F.col("_tmdb")), "left").drop("_kind", "_tmdb")


def best_match(attempts: DataFrame, candidates: DataFrame, *, block: str, min_score: float = 0.6, window: int = 3, penalty: float = 0.15, bonus: float = 0.1, popularity_bonus: bool = False) -> DataFrame:
    """(work, attempt, work_id, match_score): for each work the best candidate of its first attempt that has one.

    attempts: work, attempt, query, year and the blocking key; candidates: work_id, titles, year, popularity, rank and the same key. Only pairs with one blocking key are scored: what a
    search service would return is what shares the key here. The best is the highest score, then the lowest rank; scores are capped at 1 at the end.
    """
    pairs = attempts.join(candidates.select(F.col(block), "work_id", "titles", F.col("year").alias("item_year"), "popularity", "rank"), block)
    base = best_similarity(F.col("query"), F.col("titles"))
    if popularity_bonus:
        base = base + F.least(F.lit(0.05), F.coalesce("popularity", F.lit(0.0)) / 2000)
    scored = pairs.withColumn("match_score", F.round(adjusted_score(base, F.col("query"), F.col("titles"), F.col("year"), F.col("item_year"), window=window, penalty=penalty, bonus=bonus), 9)).where(F.col("match_score") >= min_score)
    # the best row of a work by an aggregate that combines before the shuffle
    best = scored.groupBy("work").agg(F.min(F.struct("attempt", (-F.col("match_score")).alias("minus"), "rank", "work_id")).alias("best"))
    return best.select("work", "best.attempt", "best.work_id", F.least(F.lit(1.0), -F.col("best.minus")).alias("match_score"))


def with_block(df: DataFrame, title: Column, name: str = "block") -> DataFrame:
    """The first word of the search key: a blocking key for titles."""
    return df.withColumn(name, F.split(search_key(title), " ")[0])


def with_blocks(df: DataFrame, titles: Column, name: str = "block") -> DataFrame:
    """A row for each word of the search keys of any of ``titles``: titles that share a word, wherever it stands, meet. Rows without a word are left out, since they score 0."""
    words = F.flatten(F.transform(F.filter(titles, lambda t: t.isNotNull()), lambda t: F.split(search_key(t), " ")))
    return df.withColumn(name, F.explode(F.array_distinct(F.filter(words, lambda w: w != ""))))


def attempts_of(works: DataFrame, *, only_season: bool = False, with_year_first: bool = False) -> DataFrame:
    """(work, kind, attempt, query, year): a row for each title variant, the most specific first; with_year_first: all of them with the year, then all without.

    works: work, kind, title, year and, if there, season.
    """
    season = F.col("season").cast("int") if "season" in works.columns else F.lit(None).cast("int")
    titles = variants(F.col("title"), season, F.col("kind") == "anime", only_season=only_season)
    each = works.select("work", "kind", F.posexplode(titles).alias("attempt", "query"), F.col("year").cast("int").alias("year"))
    if with_year_first:
        later = each.where("year is not null").select("work", "kind", (F.col("attempt") + 100).alias("attempt"), "query", F.lit(None).cast("int").alias("year"))
        return each.unionByName(later)
    return each


#: What is added to the attempts among the other kind, which come after all of the own.
_OTHER_KIND = 1000
#: Catalogues searched by title: the id they give, the kinds they have, and how years count there.
SEARCHES = (
    ("tmdb", "tmdb_id", ("movie", "series", "anime"), {"window": 2, "penalty": 0.2, "popularity_bonus": True}),
    ("anilist", "anilist_id", ("anime",), {}),
    ("kitsu", "kitsu_id", ("anime",), {}),
)


def resolve(works: DataFrame, search: DataFrame, bridge: DataFrame, find: DataFrame, external: DataFrame, *, min_score: float = 0.6) -> DataFrame:
    """``works`` with ids resolved, ``ids_source`` and ``ids_confidence``.

    Exact ways first: the tmdb id behind the imdb id, and the bridge for anime with an id. What is left is searched by title, each catalogue for the works that still lack its
    id: TMDB with the year and then without, AniList and Kitsu (one entry a season) by season variants. An AniList hit leads over the bridge to the other anime ids, and the tmdb id to
    the imdb id. works: work, kind, title, year, the id columns, and if there season, ``has_episode`` and ``type_guessed``: anime without episodes, and works without episodes whose kind
    only the parser gave, are looked for among the other kind of TMDB's entries too, if their own has none.
    """
    flag = lambda name: F.coalesce(F.col(name), F.lit(False)) if name in works.columns else F.lit(False)
    either = ~(flag("has_episode") if "has_episode" in works.columns else F.lit(True)) & ((F.col("kind") == "anime") | flag("type_guessed"))
    w = find_by_imdb(works, find).withColumn("tmdb_id", F.coalesce("tmdb_id", "found_tmdb_id")).withColumn("_exact", F.col("found_tmdb_id").isNotNull()).withColumn("_bridged", F.lit(False))

    def bridged(w: DataFrame) -> DataFrame:
        w = by_external_id(w, bridge, "anilist/anime", "anilist_id").withColumnRenamed("bridged_kitsu_id", "_k1")
        w = by_external_id(w, bridge, "myanimelist/anime", "mal_id").withColumnRenamed("bridged_kitsu_id", "_k2")
        w = w.withColumn("_new", F.col("kitsu_id").isNull() & F.coalesce("_k1", "_k2").isNotNull()).withColumn("kitsu_id", F.coalesce("kitsu_id", "_k1", "_k2"))
        w = ids_of_kitsu(w, bridge).withColumn("_new", F.col("_new") | (F.col("mal_id").isNull() & F.col("bridged_mal_id").isNotNull()) | (F.col("anilist_id").isNull() & F.col("bridged_anilist_id").isNotNull()))
        w = w.withColumn("mal_id", F.coalesce("mal_id", "bridged_mal_id")).withColumn("anilist_id", F.coalesce("anilist_id", "bridged_anilist_id"))
        return w.withColumn("_bridged", F.col("_bridged") | F.col("_new")).drop("_k1", "_k2", "_new", "bridged_mal_id", "bridged_anilist_id")

    w = bridged(w)
    for source, target, kinds, options in SEARCHES:
        films = source == "tmdb"
        lacking = w.where(F.col("kind").isin(*kinds) & F.col(target).isNull())
        tried = with_blocks(attempts_of(lacking, only_season=not films, with_year_first=films), F.array("query"))
        titles = search.where(F.col("source") == source).withColumn("titles", F.concat(F.array("title"), F.coalesce("alt_titles", F.array().cast("array<string>"))))
        titles = with_blocks(titles, F.col("titles"))
        if films:
            own, other = F.when(F.col("kind") == "movie", "movie").otherwise("tv"), F.when(F.col("kind") == "movie", "tv").otherwise("movie")
            more = with_blocks(attempts_of(lacking.where(either), with_year_first=True), F.array("query")).withColumn("attempt", F.col("attempt") + _OTHER_KIND)
            tried = tried.withColumn("block", F.concat_ws("|", own, "block")).unionByName(more.withColumn("block", F.concat_ws("|", other, "block")))
            titles = titles.withColumn("block", F.concat_ws("|", "kind", "block"))
        hit = best_match(tried, titles, block="block", min_score=min_score, **options).select("work", F.col("work_id").alias(f"_{source}_id"), F.col("match_score").alias(f"_{source}_score"), F.col("attempt").alias(f"_{source}_attempt"))
        w = w.join(hit, "work", "left").withColumn(target, F.coalesce(target, f"_{source}_id"))
        if source == "anilist":
            if "mal_id" in search.columns:
                both = search.where((F.col("source") == source) & F.col("mal_id").isNotNull()).groupBy(F.col("work_id").alias("_anilist_id")).agg(F.min("mal_id").alias("_mal"))
                w = w.join(both, "_anilist_id", "left").withColumn("mal_id", F.coalesce("mal_id", "_mal")).drop("_mal")
            w = bridged(w)
    own, other = F.when(F.col("kind") == "movie", "movie").otherwise("tv"), F.when(F.col("kind") == "movie", "tv").otherwise("movie")
    known = F.coalesce(F.col("found_kind"), F.when(F.col("_tmdb_attempt") >= _OTHER_KIND, other).when(F.col("_tmdb_attempt").isNotNull(), own))
    w = external_ids(w.withColumn("_kind_of_id", F.coalesce(known, own)), external, kind="_kind_of_id")
    # an id that was there before, of a work whose kind is a guess, may be of the other kind
    w = external_ids(w.withColumnRenamed("found_imdb_id", "_own_imdb_id").withColumn("_kind_of_id", F.when(known.isNull() & flag("type_guessed") & F.col("_own_imdb_id").isNull(), other)), external, kind="_kind_of_id")
    w = w.withColumn("found_imdb_id", F.coalesce("_own_imdb_id", F.when(F.col("_kind_of_id").isNotNull(), F.col("found_imdb_id"))))
    found = F.col("imdb_id").isNull() & F.col("found_imdb_id").rlike("^tt[0-9]+$")
    w = w.withColumn("_by_tmdb", F.col("_exact") | F.col("_tmdb_id").isNotNull() | F.coalesce(found, F.lit(False))).withColumn("imdb_id", F.when(found, F.col("found_imdb_id")).otherwise(F.col("imdb_id")))
    used = F.concat_ws("+", F.when(F.col("_by_tmdb"), "tmdb"), F.when(F.col("_anilist_id").isNotNull(), "anilist"), F.when(F.col("_bridged") | F.col("_kitsu_id").isNotNull(), "kitsu"))
    sure = F.greatest(F.when(F.col("_exact"), 1.0), F.col("_tmdb_score"), F.col("_anilist_score"), F.col("_kitsu_score"))
    return w.select(*works.columns, F.when(used == "", "none").otherwise(used).alias("ids_source"), F.round(sure, 3).alias("ids_confidence"))


def telemetry_patch(rows: DataFrame, *, key: str = "id", as_of, source: str = "ids_source", confidence: str = "ids_confidence", attempts: str = "ids_attempts") -> DataFrame:
    """The patch that records an attempt: one more, when, by what and how surely."""
    changed = F.array(*map(F.lit, ("ids_attempts", "ids_checked_at", "ids_source", "ids_confidence")))
    return rows.select(key, changed.alias("changed"), (F.coalesce(attempts, F.lit(0)) + 1).alias("ids_attempts"), F.lit(as_of).alias("ids_checked_at"), F.coalesce(source, F.lit("none")).alias("ids_source"), F.round(F.col(confidence), 3).alias("ids_confidence"))


def outcome_counts(groups: DataFrame, resolved: DataFrame) -> DataFrame:
    """One row: works that were complete by propagation, resolved, and left open."""
    done = resolved.select("work", (F.size("open") == 0).alias("_done"))
    joined = groups.join(done, "work", "left")
    return joined.agg(F.count_if(F.size("open") == 0).alias("n_propagated"), F.count_if((F.size("open") > 0) & F.coalesce("_done", F.lit(False))).alias("n_resolved"), F.count_if((F.size("open") > 0) & ~F.coalesce("_done", F.lit(False))).alias("n_unresolved"))
