"""The engine's operators as queries over the driver's tables, each with the SQL that checks it.

The tables hold no catalogue, so rows are bound to roles: parts become releases whose titles are made of their columns, documents become rows with a language class,
customers rows with dirty labels. Inputs are whole tables; texts are whole.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import labels, languages, release, text
from ..operators import enrich, guard, identity, patch, policies, survivors
from ..operators.components import connected_components
from ..sources.store import TableStore, delete_rows, with_telemetry
from ..sources.workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = dt.datetime(2024, 1, 31)


def _query(sql: str):
    def register(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# --- inputs as expressions that both engines read ------------------------------------------------------------------------------

QUALITY = "CASE p_partkey % 4 WHEN 0 THEN '1080p' WHEN 1 THEN '720p' WHEN 2 THEN '2160p' ELSE '480p' END"
SOURCE = "CASE p_partkey % 5 WHEN 0 THEN 'BluRay' WHEN 1 THEN 'WEB-DL' WHEN 2 THEN 'HDTV' WHEN 3 THEN 'DVDRip' ELSE 'WEBRip' END"
CODEC = "CASE p_partkey % 3 WHEN 0 THEN 'x264' WHEN 1 THEN 'HEVC' ELSE 'XviD' END"
CODEC_LABEL = "CASE p_partkey % 3 WHEN 0 THEN 'h264' WHEN 1 THEN 'hevc' ELSE 'xvid' END"
SEASON, EPISODE, YEAR = "CAST(1 + p_size % 9 AS INT)", "CAST(1 + p_partkey % 24 AS INT)", "CAST(1990 + p_partkey % 30 AS INT)"
EPISODE_TITLE = f"concat(p_name, ' S0', CAST({SEASON} AS STRING), 'E', lpad(CAST({EPISODE} AS STRING), 2, '0'), ' ', {QUALITY}, ' ', {SOURCE}, ' ', {CODEC})"
FILM_TITLE = f"concat(p_name, ' (', CAST({YEAR} AS STRING), ') ', {QUALITY}, ' ', {SOURCE}, ' ', {CODEC}, '.mkv')"
KEY = "p_name"  # its letters are plain and no article is among them


def _parts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return _t(spark, sf_dir, "part").selectExpr("p_partkey", *columns)


# --- policies ------------------------------------------------------------------------------------------------------------------

_KEYWORDS, _HARD, _ALLOWED = ("token", "license", "that"), ("password",), ("mit license",)


@_query(
    """SELECT doc_id FROM documents WHERE NOT (text IS NOT NULL AND regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])(token|license|that|password)([^\\p{L}\\p{N}]|$)')
    AND (regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])password([^\\p{L}\\p{N}]|$)')
         OR NOT contains(' ' || trim(regexp_replace(strip_accents(lower(text)), '[^a-z0-9]+', ' ', 'g')) || ' ', ' mit license ')))"""
)
def policy_regex_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of documents that the keyword policy keeps."""
    docs = _t(spark, sf_dir, "documents")
    return policies.split_by(docs, policies.keyword_policy(F.col("text"), keywords=_KEYWORDS, hard=_HARD, allowed=_ALLOWED, doubtful="", known=()))[0].select("doc_id")


@_query("SELECT doc_id, lang, n_chars FROM documents WHERE coalesce(n_chars > 0 AND n_chars < CASE WHEN lang = 'en' THEN 1500 WHEN lang IN ('fr', 'de') THEN 500 END, false)")
def policy_size_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of documents that are too small for their kind."""
    kind = F.when(F.col("lang") == "en", "movie").when(F.col("lang") == "fr", "series").when(F.col("lang") == "de", "anime")
    docs = _t(spark, sf_dir, "documents")
    return policies.split_by(docs, policies.size_policy(kind, F.col("n_chars"), movie=1500, series=500))[1].select("doc_id", "lang", "n_chars")


@_query(
    "SELECT p_partkey, CASE WHEN p_partkey % 2 = 0 THEN 'movie' ELSE 'series' END AS kind FROM part WHERE p_size > 0 AND p_size < CASE WHEN p_partkey % 2 = 0 THEN 30 ELSE 10 END"
)
def policy_size_untyped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a kind go by the parsed one."""
    rows = _parts(spark, sf_dir, "p_size", f"CASE WHEN p_partkey % 2 = 0 THEN {FILM_TITLE} ELSE {EPISODE_TITLE} END AS title").withColumn("p", release.parsed(F.col("title")))
    doomed = policies.size_policy(F.lit(None).cast("string"), F.col("p_size"), movie=30, series=10, parsed_kind=F.col("p.type"), parsed_confidence=F.col("p.type_confidence"))
    return policies.split_by(rows, doomed)[1].select("p_partkey", F.col("p.type").alias("kind"))


@_query("SELECT event_id, user_id FROM events WHERE ts < TIMESTAMP '2024-01-21 00:00:00' AND event_type = 'error'")
def policy_stale_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that nobody needs and that are older than ten days."""
    popularity = F.when(F.col("event_type") == "error", 0).otherwise(1)
    return policies.split_by(_t(spark, sf_dir, "events"), policies.stale_policy(popularity, F.col("ts"), as_of=AS_OF, days=10))[1].select("event_id", "user_id")


@_query(
    """SELECT l_returnflag, count(*) FILTER (l_quantity < 10)::BIGINT AS pending, count(*)::BIGINT AS evaluated,
    CASE WHEN count(*) FILTER (l_quantity < 10) = 0 THEN false ELSE count(*) >= 10 AND count(*) FILTER (l_quantity < 10) * 1.0 / count(*) > 0.18 END AS blocked FROM lineitem GROUP BY l_returnflag"""
)
def guard_delete_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = _t(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.count_if(F.col("l_quantity") < 10).alias("pending"), F.count("*").alias("evaluated"))
    return counts.withColumn("blocked", guard.blocked(F.col("pending"), F.col("evaluated"), 0.18))


@_query("SELECT event_id FROM events WHERE (event_type = 'view' OR ts < TIMESTAMP '2024-01-17 00:00:00') AND user_id % 5 < 3")
def recheck_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that may be looked up again: never checked or before the cutoff day, with attempts left."""
    checked = F.when(F.col("event_type") != "view", F.col("ts"))
    return _t(spark, sf_dir, "events").where(policies.recheck_due(checked, F.col("user_id") % 5, as_of=AS_OF, days=14, most=3)).select("event_id")


@_query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN concat_ws(',', CASE WHEN c_nationkey % 2 = 0 THEN 'anilist_id' END, CASE WHEN c_nationkey % 3 = 0 THEN 'kitsu_id' END, 'mal_id', CASE WHEN c_nationkey = 0 THEN 'tmdb_id' END,
    CASE WHEN c_custkey % 4 = 0 THEN 'imdb_id' END) ELSE concat_ws(',', CASE WHEN c_nationkey = 0 THEN 'tmdb_id' END, CASE WHEN c_custkey % 4 = 0 THEN 'imdb_id' END) END AS needed FROM customer"""
)
def needed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that a row of its kind lacks: null, 0 and empty are missing."""
    kind = F.when(F.col("c_custkey") % 3 == 0, "anime").when(F.col("c_custkey") % 3 == 1, "movie").otherwise("series")
    ids = {
        "imdb_id": F.when(F.col("c_custkey") % 4 == 0, "").otherwise("tt1"),
        "tmdb_id": F.col("c_nationkey").cast("long"),
        "anilist_id": F.when(F.col("c_nationkey") % 2 == 1, 7),
        "kitsu_id": F.when(F.col("c_nationkey") % 3 != 0, 7).otherwise(0),
        "mal_id": F.lit(None).cast("long"),
    }
    return _t(spark, sf_dir, "customer").select("c_custkey", F.array_join(policies.needed_ids(kind, ids), ",").alias("needed"))


@_query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'tt' || c_custkey END AS imdb_id FROM customer")
def imdb_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    raw = F.when(k % 3 == 0, F.concat(F.lit(" tt"), k.cast("string"), F.lit(" "))).when(k % 3 == 1, F.concat(F.lit("nm"), k.cast("string"))).otherwise(F.lit("tt"))
    return _t(spark, sf_dir, "customer").select("c_custkey", policies.valid_imdb(raw).alias("imdb_id"))


# --- text ----------------------------------------------------------------------------------------------------------------------

_FOLD = "trim(regexp_replace(strip_accents(lower(coalesce(text, ''))), '[^a-z0-9]+', ' ', 'g'))"


@_query(f"SELECT doc_id, md5({_FOLD}) AS folded_md5, contains(' ' || {_FOLD} || ' ', ' mit license ') OR contains(' ' || {_FOLD} || ' ', ' apache license ') AS has_phrase FROM documents")
def fold_phrase_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    folded = text.fold(F.col("text"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(folded).alias("folded_md5"), text.has_phrase(folded, ["mit license", "apache license"]).alias("has_phrase"))


@_query(
    """SELECT doc_id, md5(trim(regexp_replace(regexp_replace(regexp_replace(replace(strip_accents(lower(coalesce(text, ''))), '&', ' and '), '[^a-z0-9\\x{3040}-\\x{30ff}\\x{3400}-\\x{9fff}]+', ' ', 'g'),
    '\\b(the|a|an|el|la|los|las|un|una|le|les|der|die|das)\\b', ' ', 'g'), '\\s+', ' ', 'g'))) AS key_md5 FROM documents"""
)
def search_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(text.search_key(F.col("text"))).alias("key_md5"))


_BIGRAMS = "list_transform(range(1, length({0})), lambda i: substr({0}, i, 2))"
_DICE = f"""CASE WHEN a = b THEN 1.0 ELSE 2.0 * list_sum(list_transform(list_distinct({_BIGRAMS.format('a')}), lambda g: least(len(list_filter({_BIGRAMS.format('a')}, lambda x: x = g)), len(list_filter({_BIGRAMS.format('b')}, lambda x: x = g))))) / (length(a) + length(b) - 2) END"""
_JACCARD = "len(list_intersect(string_split(a, ' '), string_split(b, ' '))) * 1.0 / len(list_distinct(list_concat(string_split(a, ' '), string_split(b, ' '))))"
_PAIRS = "WITH n AS (SELECT DISTINCT p_brand, p_name AS b FROM part), p AS (SELECT p_brand, a, b FROM (SELECT p_brand, min(b) AS a FROM n GROUP BY p_brand) JOIN n USING (p_brand) WHERE a <> b)"


def _name_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part name beside the first of its brand: as many pairs as names."""
    n = _t(spark, sf_dir, "part").select("p_brand", F.col("p_name").alias("b")).distinct()
    return n.groupBy("p_brand").agg(F.min("b").alias("a")).join(n, "p_brand").where("a <> b")


@_query(f"{_PAIRS} SELECT p_brand, a, b, round({_DICE}, 6) AS score FROM p")
def sim_dice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).withColumn("score", F.round(text.dice(F.col("a"), F.col("b")), 6))


@_query(f"{_PAIRS} SELECT p_brand, a, b, round({_JACCARD}, 6) AS score FROM p")
def sim_token_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).withColumn("score", F.round(text.token_jaccard(F.col("a"), F.col("b")), 6))


@_query(f"{_PAIRS} SELECT p_brand, a, b, round(least(1.0, greatest({_DICE}, {_JACCARD}, CASE WHEN contains(a, b) OR contains(b, a) THEN least(length(a), length(b)) * 1.0 / greatest(length(a), length(b)) + 0.15 ELSE 0 END)), 6) AS score FROM p")
def sim_combined(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _name_pairs(spark, sf_dir).withColumn("score", F.round(text.similarity(F.col("a"), F.col("b")), 6))


@_query(
    f"""{_PAIRS} SELECT p_brand, a, b, round(least(1.0, greatest({_DICE}, {_JACCARD}, CASE WHEN contains(a, b) OR contains(b, a) THEN least(length(a), length(b)) * 1.0 / greatest(length(a), length(b)) + 0.15 ELSE 0 END)) - CASE WHEN length(a) % 2 = 0 THEN 0.22 ELSE 0 END
    + CASE WHEN abs(length(a) - length(b)) <= 1 THEN 0.1 WHEN abs(length(a) - length(b)) > 2 THEN -0.2 ELSE 0 END, 6) AS score FROM p"""
)
def sim_adjusted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The similarity adjusted for a season that the other title lacks, and for years."""
    query = F.concat(F.col("a"), F.when(F.length("a") % 2 == 0, " season 2").otherwise(""))
    score = text.adjusted_score(text.similarity(F.col("a"), F.col("b")), query, F.array("b"), 2000 + F.length("a"), 2000 + F.length("b"), window=2, penalty=0.2)
    return _name_pairs(spark, sf_dir).withColumn("score", F.round(score, 6))


@_query("SELECT p_partkey, p_size::VARCHAR || CASE WHEN p_size % 100 IN (11, 12, 13) THEN 'th' WHEN p_size % 10 = 1 THEN 'st' WHEN p_size % 10 = 2 THEN 'nd' WHEN p_size % 10 = 3 THEN 'rd' ELSE 'th' END AS name FROM part")
def ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "part").select("p_partkey", text.ordinal(F.col("p_size")).alias("name"))


# --- labels --------------------------------------------------------------------------------------------------------------------

_DIRTY_QUALITY = "CASE p_partkey % 9 WHEN 0 THEN '1920x1080' WHEN 1 THEN ' 720P ' WHEN 2 THEN '4K' WHEN 3 THEN 'Full HD' WHEN 4 THEN 'TS' WHEN 5 THEN '1720' WHEN 6 THEN 'web 1080p x264' WHEN 7 THEN 'SD' END"
_DIRTY_CODEC = "CASE p_partkey % 9 WHEN 0 THEN 'H.264' WHEN 1 THEN 'x265 10bit' WHEN 2 THEN 'AV1' WHEN 3 THEN 'DivX' WHEN 4 THEN 'mpeg-2' WHEN 5 THEN 'WMV3' WHEN 6 THEN 'VP09' WHEN 7 THEN 'other' END"
_DIRTY_TYPE = "CASE p_partkey % 7 WHEN 0 THEN 'Movies' WHEN 1 THEN ' TV ' WHEN 2 THEN 'ANIME' WHEN 3 THEN 'película' WHEN 4 THEN 'tv show' WHEN 5 THEN 'song' END"


@_query("SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN '1080p' WHEN 1 THEN '720p' WHEN 2 THEN '2160p' WHEN 3 THEN '1080p' WHEN 6 THEN '1080p' WHEN 7 THEN '480p' END AS label FROM part")
def value_normalise_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, f"{_DIRTY_QUALITY} AS v").select("p_partkey", labels.quality_label(F.col("v")).alias("label"))


@_query("SELECT p_partkey, CASE p_partkey % 9 WHEN 0 THEN 'h264' WHEN 1 THEN 'hevc' WHEN 2 THEN 'av1' WHEN 3 THEN 'xvid' WHEN 4 THEN 'mpeg2' WHEN 5 THEN 'vc1' WHEN 6 THEN 'vp9' END AS label FROM part")
def value_normalise_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, f"{_DIRTY_CODEC} AS v").select("p_partkey", labels.codec_label(F.col("v")).alias("label"))


@_query("SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN 'movie' WHEN 1 THEN 'series' WHEN 2 THEN 'anime' WHEN 3 THEN 'movie' WHEN 4 THEN 'series' END AS label FROM part")
def value_normalise_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, f"{_DIRTY_TYPE} AS v").select("p_partkey", labels.type_label(F.col("v")).alias("label"))


@_query("SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 THEN CASE WHEN p_partkey % 2 = 0 THEN '1080p' ELSE '720p' END WHEN p_partkey % 3 = 1 THEN '2160p' ELSE CASE WHEN p_partkey % 2 = 0 THEN '1080p' END END AS quality FROM part")
def pick_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vague stored label gives way to the title's, an explicit one wins."""
    stored = F.expr("CASE p_partkey % 3 WHEN 0 THEN 'HD' WHEN 1 THEN '4K' END")
    title = F.expr("CASE WHEN p_partkey % 2 = 0 THEN '1080p' END")
    return _t(spark, sf_dir, "part").select("p_partkey", labels.pick_quality(stored, title).alias("quality"))


# --- languages -----------------------------------------------------------------------------------------------------------------

_AUDIO = "CASE doc_id % 8 WHEN 0 THEN '{en,es}' WHEN 1 THEN '[\"SPA-LA\",\"eng\"]' WHEN 2 THEN 'Spanish (Latin America)' WHEN 3 THEN 'english + french' WHEN 4 THEN 'AC3 5.1' WHEN 5 THEN '' WHEN 6 THEN 'jpn; de' END"
_AUDIO_LABELS = "CASE doc_id % 8 WHEN 0 THEN 'english,spanish' WHEN 1 THEN 'english,latino' WHEN 2 THEN 'latino' WHEN 3 THEN 'english,french' WHEN 6 THEN 'german,japanese' ELSE '' END"


@_query(f"SELECT doc_id, {_AUDIO_LABELS} AS labels FROM documents")
def language_array_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(languages.language_labels(F.expr(_AUDIO)), ",").alias("labels"))


@_query("SELECT doc_id, CASE lang WHEN 'en' THEN 'english' WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' WHEN 'es' THEN 'spanish' END AS label, CASE WHEN lang = 'en' THEN 'english' WHEN lang IN ('fr', 'de', 'es') THEN concat_ws(',', 'english', CASE lang WHEN 'fr' THEN 'french' WHEN 'de' THEN 'german' ELSE 'spanish' END) ELSE 'english' END AS labels FROM documents")
def language_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known codes by map literals alone."""
    both = languages.array_labels(F.array("lang", F.lit("ENG"), F.lit("en-GB"), F.lit("?")))
    return _t(spark, sf_dir, "documents").select("doc_id", languages.token_label(F.col("lang")).alias("label"), F.array_join(both, ",").alias("labels"))


@_query(
    """SELECT doc_id, lang = 'es' AS spanish, lang = 'en' OR (lang = 'fr' AND doc_id % 3 = 1) AS english, (lang IN ('fr', 'de')) AND doc_id % 3 = 2 AS other,
    (lang = 'de' AND doc_id % 3 <> 2) OR (lang = 'fr' AND doc_id % 3 = 0) AS unknown FROM documents"""
)
def language_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    subtitles = F.when(F.col("doc_id") % 3 == 2, F.array(F.lit("german"))).when((F.col("doc_id") % 3 == 1) & (F.col("lang") == "fr"), F.array(F.lit("english"))).otherwise(F.array().cast("array<string>"))
    c = languages.language_class(F.array(languages.token_label(F.col("lang"))), subtitles)
    return _t(spark, sf_dir, "documents").select("doc_id", c.alias("c")).select("doc_id", "c.*")


@_query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'english,japanese' WHEN 1 THEN 'spanish' ELSE '' END AS audio, CASE p_partkey % 3 WHEN 0 THEN 'latino' WHEN 1 THEN '' ELSE 'spanish' END AS subtitles, p_partkey % 3 = 0 AS dual, p_partkey % 3 = 2 AS original FROM part")
def title_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audio and subtitle languages of titles."""
    title = f"concat(p_name, ' (', CAST({YEAR} AS STRING), ') 1080p ', CASE p_partkey % 3 WHEN 0 THEN 'Dual Audio ENG JPN Subs SPA-LA' WHEN 1 THEN 'Castellano' ELSE 'VOSE' END)"
    p = release.parsed(F.expr(title))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", F.array_join("p.audio", ",").alias("audio"), F.array_join("p.subtitles", ",").alias("subtitles"), "p.dual", "p.original")


# --- titles --------------------------------------------------------------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, title: str, *fields: str) -> DataFrame:
    """Parts, and attributes of a title made of their columns, by the parser that users call."""
    p = release.parsed(F.expr(title))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", *[F.col(f"p.{f}") for f in fields])


@_query(f"SELECT p_partkey, {SEASON} AS season, {EPISODE} AS episode FROM part")
def parse_season_episode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, EPISODE_TITLE, "season", "episode")


_S, _E = f"CAST({SEASON} AS STRING)", f"lpad(CAST({EPISODE} AS STRING), 2, '0')"
_NOTATIONS = (f"concat('S0', {_S}, 'E', {_E}, '-E', CAST({EPISODE} + 30 AS STRING))", f"concat('T', {_S}, ' EP', {_E})", f"concat('Season ', {_S}, ' Episode ', {_E})", f"concat({_S}, 'x', {_E}, ' al ', {_S}, 'x', CAST({EPISODE} + 30 AS STRING))", f"concat('Cap.', {_S}, {_E})", f"concat({_S}, ' - ', {_E})")


@_query(f"SELECT p_partkey, p_name AS clean_title, {SEASON} AS season, {EPISODE} AS episode, CASE WHEN p_partkey % 6 IN (0, 3) THEN {EPISODE} + 30 END AS episode_end FROM part")
def parse_episode_notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six notations of season and episode, two of them with a range."""
    forms = " ".join(f"WHEN {i} THEN {x}" for i, x in enumerate(_NOTATIONS))
    return _read(spark, sf_dir, f"concat(p_name, ' ', CASE p_partkey % 6 {forms} END, ' 720p')", "clean_title", "season", "episode", "episode_end")


@_query(f"SELECT p_partkey, p_name AS clean_title, {SEASON} AS season, CASE WHEN p_partkey % 4 = 3 THEN {SEASON} + 2 END AS season_end, true AS is_season_pack FROM part")
def parse_season_notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three notations of a season alone, and a range of seasons."""
    forms = f"WHEN 0 THEN concat('S0', {_S}) WHEN 1 THEN concat('Temporada ', {_S}) WHEN 2 THEN concat({_S}, CASE {SEASON} WHEN 1 THEN 'st' WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END, ' Season') ELSE concat('S0', {_S}, '-S', lpad(CAST({SEASON} + 2 AS STRING), 2, '0'))"
    return _read(spark, sf_dir, f"concat(p_name, ' ', CASE p_partkey % 4 {forms} END, ' 1080p')", "clean_title", "season", "season_end", "is_season_pack")


@_query(f"SELECT p_partkey, p_name AS clean_title, NULL::INT AS season, {EPISODE} AS episode, {EPISODE} AS absolute_episode FROM part")
def parse_absolute_notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five notations of an episode without a season."""
    forms = f"WHEN 0 THEN concat(' - ', {_E}) WHEN 1 THEN concat(' Ep. ', {_E}) WHEN 2 THEN concat(' 第', {_E}, '話') WHEN 3 THEN concat(' #', {_E}) ELSE concat(' [', {_E}, ']')"
    return _read(spark, sf_dir, f"concat(p_name, CASE p_partkey % 5 {forms} END, ' [720p]')", "clean_title", "season", "episode", "absolute_episode")


@_query("SELECT p_partkey, p_name AS clean_title, CASE WHEN p_partkey % 2 = 0 THEN 100 + p_partkey % 700 ELSE 1000 + p_partkey % 900 END::INT AS episode, 'trailing-number-episode' AS flags FROM part")
def parse_trailing_number(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A number at the end of a name is an episode."""
    number = "CAST(CASE WHEN p_partkey % 2 = 0 THEN 100 + p_partkey % 700 ELSE 1000 + p_partkey % 900 END AS STRING)"
    return _read(spark, sf_dir, f"concat(p_name, ' ', {number}, ' [Latino]')", "clean_title", "episode", "flags").withColumn("flags", F.array_join("flags", ","))


@_query(f"SELECT p_partkey, CASE WHEN p_partkey % 3 = 2 THEN '1984 ' ELSE '' END || p_name AS clean_title, {YEAR} AS year FROM part")
def parse_year_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A year in brackets, behind the name, and the last of two."""
    y = f"CAST({YEAR} AS STRING)"
    return _read(spark, sf_dir, f"CASE p_partkey % 3 WHEN 0 THEN concat(p_name, ' [', {y}, '] 1080p') WHEN 1 THEN concat(replace(p_name, ' ', '.'), '.', {y}, '.1080p.WEB') ELSE concat('1984 ', p_name, ' ', {y}, ' 720p') END", "clean_title", "year")


@_query("SELECT p_partkey, p_name AS clean_title, p_name AS search_key FROM part")
def parse_noise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What sites write around a name, languages and editions behind it, and names only found without tokens."""
    forms = ("concat('Descargar Pelicula ', p_name, ' 2011 1080p')", "concat(p_name, ' Torrent 2011 1080p')", "concat('www.some-site.com - ', p_name, ' (2011)')", "concat('ver.pelicula.online.', replace(p_name, ' ', '.'), '.2011.720p')", "concat(p_name, ' Spanish Dubbed 2011 HDTV')", "concat(p_name, ' Extended Cut 2011 720p')", "concat('1920x1080 ', p_name)", "concat('[1080p] (2011) ', p_name, ' AKA other name')")
    return _read(spark, sf_dir, f"CASE p_partkey % {len(forms)} {' '.join(f'WHEN {i} THEN {x}' for i, x in enumerate(forms))} END", "clean_title", "search_key")


@_query("SELECT p_partkey, p_name AS clean_title, CASE p_partkey % 3 WHEN 0 THEN 'Anime Time' WHEN 1 THEN 'Erai-raws' ELSE 'Judas' END AS release_group, CASE WHEN p_partkey % 3 = 1 THEN 'japanese' ELSE 'english,japanese' END AS audio FROM part")
def parse_bare_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A known group without brackets before the name, or in brackets behind it."""
    title = "CASE p_partkey % 3 WHEN 0 THEN concat('Anime Time ', p_name, ' 1080p') WHEN 1 THEN concat('Erai-raws - ', p_name, ' 1080p') ELSE concat(p_name, ' 1080p [Judas]') END"
    return _read(spark, sf_dir, title, "clean_title", "release_group", "audio").withColumn("audio", F.array_join("audio", ","))


@_query(f"SELECT p_partkey, {YEAR} AS year FROM part")
def parse_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(spark, sf_dir, f"{FILM_TITLE} AS title").select("p_partkey", release.parsed(F.col("title")).year.alias("year"))


@_query(f"SELECT p_partkey, {QUALITY} AS quality, lower({SOURCE}) AS source, {CODEC_LABEL} AS codec, 'mkv' AS container FROM part")
def parse_quality_source_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _read(spark, sf_dir, FILM_TITLE, "quality", "source", "codec", "container")


@_query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'eac3' WHEN 1 THEN 'truehd' WHEN 2 THEN 'aac' END AS audio_codec, CASE p_partkey % 4 WHEN 1 THEN '7.1' END AS channels,
    CASE p_partkey % 4 WHEN 0 THEN 'dv' WHEN 1 THEN 'hdr10+' WHEN 3 THEN 'hlg' END AS hdr, CASE p_partkey % 4 WHEN 2 THEN 10 WHEN 3 THEN 8 END AS bit_depth FROM part"""
)
def parse_audio_hdr_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = "CASE p_partkey % 4 WHEN 0 THEN 'DDP5.1 HDR10 DV' WHEN 1 THEN 'TrueHD 7.1 HDR10+' WHEN 2 THEN 'AAC2.0 10bit' ELSE 'HLG 8-bit' END"
    return _read(spark, sf_dir, f"concat(p_name, ' 2160p ', {tokens}, ' x265')", "audio_codec", "channels", "hdr", "bit_depth")


@_query(f"SELECT p_partkey, {KEY} AS clean_title, {KEY} AS search_key FROM part")
def parse_clean_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = release.parsed(F.expr(f"CASE WHEN p_partkey % 2 = 0 THEN {FILM_TITLE} ELSE {EPISODE_TITLE} END"))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.clean_title", "p.search_key")


@_query("SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'movie' WHEN 1 THEN 'series' ELSE 'anime' END AS type, CASE p_partkey % 3 WHEN 0 THEN 0.8 WHEN 1 THEN 0.9 ELSE 1.0 END::DOUBLE AS confidence FROM part")
def parse_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    anime = f"concat('[SubsPlease] ', p_name, ' - ', lpad(CAST({EPISODE} AS STRING), 2, '0'), ' (1080p) [A1B2C3D4].mkv')"
    p = release.parsed(F.expr(f"CASE p_partkey % 3 WHEN 0 THEN {FILM_TITLE} WHEN 1 THEN {EPISODE_TITLE} ELSE {anime} END"))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.type", F.col("p.type_confidence").alias("confidence"))


@_query(f"SELECT p_partkey, {EPISODE} AS absolute_episode, 'SubsPlease' AS release_group, true AS has_crc, 'japanese' AS audio, 'english' AS subtitles FROM part")
def parse_group_absolute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, checksum, absolute episode and the group's languages."""
    p = release.parsed(F.expr(f"concat('[SubsPlease] ', p_name, ' - ', lpad(CAST({EPISODE} AS STRING), 2, '0'), ' (1080p) [A1B2C3D4].mkv')"))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.absolute_episode", "p.release_group", "p.has_crc", F.array_join("p.audio", ",").alias("audio"), F.array_join("p.subtitles", ",").alias("subtitles"))


@_query(f"SELECT p_partkey, {SEASON} AS season, true AS is_season_pack, p_partkey % 2 = 0 AS is_complete, CASE WHEN p_partkey % 2 = 0 THEN 'complete,repack' ELSE 'proper' END AS flags FROM part")
def parse_packs_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = release.parsed(F.expr(f"concat(p_name, ' S0', CAST({SEASON} AS STRING), CASE WHEN p_partkey % 2 = 0 THEN ' COMPLETE REPACK' ELSE ' PROPER' END, ' 1080p WEB-DL')"))
    return _t(spark, sf_dir, "part").select("p_partkey", p.alias("p")).select("p_partkey", "p.season", "p.is_season_pack", "p.is_complete", F.array_join("p.flags", ",").alias("flags"))


@_query(
    f"""SELECT p_partkey, CASE WHEN {SEASON} > 1 AND p_partkey % 2 = 0 THEN concat_ws('|', {KEY} || ' ' || {SEASON} || CASE {SEASON} WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END || ' Season', {KEY} || ' Season ' || {SEASON}, {KEY} || ' ' || {SEASON}, {KEY}) ELSE {KEY} END AS variants FROM part"""
)
def search_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parts(spark, sf_dir, "p_name", f"{SEASON} AS season")
    return rows.select("p_partkey", F.array_join(release.variants(F.col("p_name"), F.col("season"), F.col("p_partkey") % 2 == 0), "|").alias("variants"))


@_query("SELECT p_partkey, p_name AS clean_title, 1 AS season, CASE WHEN p_partkey % 3 = 1 THEN NULL ELSE 2 END::INT AS episode FROM part")
def parse_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names that stand in the place of a group, behind the number, and between labels."""
    forms = "WHEN 0 THEN concat('[', p_name, '] S01E02 1080p') WHEN 1 THEN concat('S01 720p ', p_name) ELSE concat('1x02 ', p_name, ' HDTV') END"
    return _read(spark, sf_dir, f"CASE p_partkey % 3 {forms}", "clean_title", "season", "episode")


@_query(
    """SELECT p_partkey, p_name AS clean_title, CASE p_partkey % 4 WHEN 0 THEN 'dualaudio' WHEN 1 THEN 'remastered' WHEN 2 THEN 'proper' ELSE '' END AS flags, p_partkey % 4 = 0 AS dual, p_partkey % 4 = 2 AS multi_subs,
    p_partkey % 4 = 3 AS original, CASE WHEN p_partkey % 4 = 3 THEN 'french' WHEN p_partkey % 4 = 2 THEN 'english,spanish' ELSE '' END AS subtitles FROM part"""
)
def parse_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Marks of editions, of several languages and of original audio."""
    forms = "WHEN 0 THEN concat(p_name, ' 2011 Dual-Audio 1080p') WHEN 1 THEN concat(p_name, ' 2011 Remastered 1080p') WHEN 2 THEN concat(p_name, ' (2011) PROPER 720p [Multi Subs][ENG][SPA]') ELSE concat(p_name, ' 2011 VOSTFR 1080p') END"
    found = _read(spark, sf_dir, f"CASE p_partkey % 4 {forms}", "clean_title", "flags", "dual", "multi_subs", "original", "subtitles")
    return found.withColumn("flags", F.array_join(F.filter("flags", lambda f: f != "multisubs"), ",")).withColumn("subtitles", F.array_join("subtitles", ","))


@_query("SELECT doc_id, 'english,' || CASE lang WHEN 'en' THEN 'latino' WHEN 'fr' THEN 'french,latino' WHEN 'de' THEN 'german,latino' ELSE 'latino,spanish' END AS sorted, 'latino,english' || CASE lang WHEN 'en' THEN '' WHEN 'fr' THEN ',french' WHEN 'de' THEN ',german' ELSE ',spanish' END AS ordered, lang = 'en' AS same FROM documents")
def language_unions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both ways to join arrays of labels, and their equality element by element."""
    own, other = F.array(languages.token_label(F.col("lang"))), F.array(F.lit("latino"), F.lit("english"))
    return _t(spark, sf_dir, "documents").select("doc_id", F.array_join(languages.union_sorted(own, other), ",").alias("sorted"), F.array_join(languages.union_ordered(other, own), ",").alias("ordered"), languages.same_labels(own, F.array(F.lit("english"))).alias("same"))


# --- patches -------------------------------------------------------------------------------------------------------------------


def _dirty(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customers, and a copy with some values changed, some set to null."""
    before = _t(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    k = F.col("c_custkey")
    after = before.select("c_custkey", F.when(k % 3 == 0, F.upper("c_name")).otherwise(F.col("c_name")).alias("c_name"), F.when(k % 5 != 0, F.col("c_nationkey")).alias("c_nationkey"), F.when(k % 7 == 0, "OTHER").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return before, after


_CHANGED = "concat_ws(',', CASE WHEN c_custkey % 3 = 0 THEN 'c_name' END, CASE WHEN c_custkey % 5 = 0 THEN 'c_nationkey' END, CASE WHEN c_custkey % 7 = 0 THEN 'c_mktsegment' END)"
_COLUMNS = ["c_name", "c_nationkey", "c_mktsegment"]


@_query(f"SELECT c_custkey, {_CHANGED} AS changed, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) END AS c_name, NULL::INT AS c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN 'OTHER' END AS c_mktsegment FROM customer WHERE c_custkey % 3 = 0 OR c_custkey % 5 = 0 OR c_custkey % 7 = 0")
def normalise_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sparse difference of two tables; a value set to null is a change."""
    before, after = _dirty(spark, sf_dir)
    return patch.diff(before, after, "c_custkey", _COLUMNS).withColumn("changed", F.array_join("changed", ","))


@_query(
    """SELECT 'c_name' AS column_name, count(*)::BIGINT AS n_changes FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'c_nationkey', count(*)::BIGINT FROM customer WHERE c_custkey % 5 = 0
    UNION ALL SELECT 'c_mktsegment', count(*)::BIGINT FROM customer WHERE c_custkey % 7 = 0"""
)
def patch_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _dirty(spark, sf_dir)
    return patch.histogram(patch.diff(before, after, "c_custkey", _COLUMNS))


@_query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN upper(c_name) ELSE c_name END AS c_name, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN 'OTHER' ELSE c_mktsegment END AS c_mktsegment, c_acctbal FROM customer")
def patch_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    before, after = _dirty(spark, sf_dir)
    return patch.apply_patch(_t(spark, sf_dir, "customer"), patch.diff(before, after, "c_custkey", _COLUMNS), "c_custkey", _COLUMNS)


@_query(
    "SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'rejected' ELSE 'valid' END AS verdict, CASE WHEN c_custkey % 11 = 0 THEN 'imdb_id' ELSE '' END AS reasons FROM customer"
)
def patch_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patches that break a rule of the table are set aside, the others go on."""
    rows = _t(spark, sf_dir, "customer").select("c_custkey", F.array(F.lit("imdb_id"), F.lit("type")).alias("changed"), F.when(F.col("c_custkey") % 11 == 0, "x1").otherwise("tt1").alias("imdb_id"), F.lit("movie").alias("type"))
    good, bad = patch.split_valid(rows, patch.constraint_columns(["imdb_id", "type"]))
    return good.select("c_custkey", F.lit("valid").alias("verdict"), F.lit("").alias("reasons")).unionByName(bad.select("c_custkey", F.lit("rejected").alias("verdict"), F.array_join("reasons", ",").alias("reasons")))


@_query(
    """SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN p_size WHEN 1 THEN p_size WHEN 2 THEN -p_size END::INT AS number, repeat('x', least(20, p_size::BIGINT)::INT) AS codec FROM part"""
)
def exact_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts that are whole numbers, and values cut to the width of their column."""
    text = "CASE p_partkey % 6 WHEN 0 THEN concat(' ', CAST(p_size AS STRING), ' ') WHEN 1 THEN concat(CAST(p_size AS STRING), '.00') WHEN 2 THEN concat('-', CAST(p_size AS STRING)) WHEN 3 THEN concat(CAST(p_size AS STRING), '.5') WHEN 4 THEN 'seven' ELSE '99999999999' END"
    return _parts(spark, sf_dir, f"{text} AS t", "repeat('x', CAST(p_size AS INT)) AS c").select("p_partkey", patch.exact_int(F.col("t")).alias("number"), labels.fit("codec", F.col("c")).alias("codec"))


@_query(
    """SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN '2024-01-31' ELSE '2023-05-05' END AS updated_at FROM customer
    UNION ALL SELECT c_custkey + 1000000, '2024-01-31' FROM customer WHERE c_custkey % 7 = 0"""
)
def freshness_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows are as fresh as the last change by their source; what maintenance writes doesn't count, and new rows are fresh."""
    k = F.col("c_custkey")
    before = _t(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", "c_name", F.lit("2023-05-05").alias("updated_at"))
    after = before.select("c_custkey", F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_acctbal")).alias("c_acctbal"), F.upper("c_name").alias("c_name"), F.lit("x").alias("updated_at"))
    more = before.where(k % 7 == 0).withColumn("c_custkey", k + 1000000)
    return patch.refreshed(before, after.unionByName(more), "c_custkey", ["c_acctbal"], "2024-01-31").select("c_custkey", "updated_at")


def _as_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalogue rows with dirty or missing attributes."""
    return _parts(
        spark, sf_dir, f"{EPISODE_TITLE} AS title", "CASE WHEN p_partkey % 2 = 0 THEN p_name END AS title_text", "CASE p_partkey % 3 WHEN 0 THEN 'Series' WHEN 1 THEN 'series' END AS type",
        f"CASE WHEN p_partkey % 4 = 0 THEN {SEASON} END AS season", "CAST(NULL AS INT) AS episode", "CAST(NULL AS INT) AS absolute_episode", f"CASE WHEN p_partkey % 5 = 0 THEN {CODEC_LABEL} ELSE {CODEC} END AS codec",
        "CASE WHEN p_partkey % 6 = 0 THEN 'HD' END AS quality", "CASE WHEN p_partkey % 2 = 0 THEN array('english') ELSE array('en') END AS audio", "CAST(array() AS array<string>) AS subtitles",
    ).withColumnRenamed("p_partkey", "id")


@_query(
    f"""SELECT p_partkey AS id, concat_ws(',', CASE WHEN p_partkey % 2 = 1 THEN 'title_text' END, CASE WHEN p_partkey % 3 <> 1 THEN 'type' END, CASE WHEN p_partkey % 4 <> 0 THEN 'season' END, 'episode',
    CASE WHEN p_partkey % 5 <> 0 THEN 'codec' END, 'quality', CASE WHEN p_partkey % 2 = 1 THEN 'audio' END) AS changed, CASE WHEN p_partkey % 5 <> 0 THEN {CODEC_LABEL} END AS codec, {QUALITY} AS quality, {EPISODE} AS episode FROM part"""
)
def normalise_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole normalisation of rows: what the title and the labels change."""
    rows = _as_rows(spark, sf_dir).withColumn("p", release.parsed(F.col("title")))
    return patch.normalisation_patch(rows, "p").select("id", F.array_join("changed", ",").alias("changed"), "codec", "quality", "episode")


@_query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderkey % 3 <> 0")
def store_commit_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two versions of a table: as it was, and without some rows."""
    store = TableStore(spark, Workspace(spark, "store").path("orders"))
    store.commit(_t(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), sort="o_orderkey")
    table = store.read()
    store.commit(delete_rows(table, table.where("o_orderkey % 3 = 0"), "o_orderkey"), sort="o_orderkey")
    return store.read(["o_orderkey", "o_orderstatus"])


@_query(
    """SELECT p_partkey AS id, CASE p_partkey % 4 WHEN 0 THEN 'english,spanish' WHEN 1 THEN 'japanese' WHEN 2 THEN 'latino' ELSE '' END AS audio, CASE WHEN p_partkey % 2 = 0 THEN 'english' ELSE '' END AS subtitles,
    concat_ws(',', CASE WHEN p_partkey % 4 = 0 THEN 'audio' WHEN p_partkey % 4 = 2 THEN 'audio' END, CASE WHEN p_partkey % 2 = 0 THEN 'subtitles' END) AS changed FROM part WHERE p_partkey % 2 = 0"""
)
def normalise_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rules of audio and subtitles: text becomes labels, and labels that are right stay."""
    audio = "CASE p_partkey % 4 WHEN 0 THEN array('ES', 'eng') WHEN 1 THEN array('japanese') WHEN 2 THEN array('Spanish (Latin America)') ELSE array() END"
    rows = _parts(spark, sf_dir, "'one two' AS title", "'one two' AS title_text", "'movie' AS type", "CAST(NULL AS INT) AS season", "CAST(NULL AS INT) AS episode", "CAST(NULL AS INT) AS absolute_episode", "CAST(NULL AS STRING) AS codec", "CAST(NULL AS STRING) AS quality", f"{audio} AS audio", "CASE WHEN p_partkey % 2 = 0 THEN array('EN', 'english') ELSE CAST(array() AS array<string>) END AS subtitles").withColumnRenamed("p_partkey", "id")
    made = patch.normalisation_patch(rows.withColumn("p", release.parsed(F.col("title"))), "p")
    return made.select("id", F.array_join("audio", ",").alias("audio"), F.array_join("subtitles", ",").alias("subtitles"), F.array_join("changed", ",").alias("changed"))


@_query("SELECT count(*)::BIGINT AS n_rows, count(*)::BIGINT AS n_estimated, 0 AS version, true AS dry_run_wrote_nothing FROM orders")
def store_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of a stored table, the second by file footers alone, and what a dry run leaves."""
    store = TableStore(spark, Workspace(spark, "counts").path("orders"))
    store.commit(_t(spark, sf_dir, "orders").select("o_orderkey"))
    wrote = store.commit(store.read().limit(0), dry_run=True)
    return spark.createDataFrame([(store.count(), store.estimated_count(), store.version(), wrote is None)], "n_rows long, n_estimated long, version int, dry_run_wrote_nothing boolean")


@_query("SELECT c_custkey, c_name, NULL::TIMESTAMP AS ids_checked_at, NULL::VARCHAR AS ids_source, NULL::DOUBLE AS ids_confidence, 0 AS ids_attempts FROM customer")
def telemetry_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table gets the columns that lookups keep; none is there before."""
    c = _t(spark, sf_dir, "customer").select("c_custkey", "c_name")
    assert not enrich.has_telemetry(c) and enrich.has_telemetry(with_telemetry(c))
    return with_telemetry(c)


# --- works ---------------------------------------------------------------------------------------------------------------------


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows of works: the name is the title, the brand decides on the year, one id is known here and there."""
    return _parts(
        spark, sf_dir, "CASE WHEN p_type = 'PROMO' THEN 'anime' ELSE 'movie' END AS kind", "p_name AS search_key", "CASE WHEN p_size % 2 = 0 THEN CAST(2000 + length(p_name) % 2 AS INT) END AS year", "CAST(1 AS INT) AS season",
        "array('tmdb_id', 'imdb_id') AS needed", "CAST(NULL AS STRING) AS imdb_id", "CASE WHEN p_partkey % 10 = 3 THEN p_partkey ELSE 0 END AS tmdb_id", "CAST(NULL AS BIGINT) AS anilist_id", "CAST(NULL AS BIGINT) AS kitsu_id", "CAST(NULL AS BIGINT) AS mal_id",
    ).withColumnRenamed("p_partkey", "id")


_ORPHANS = "SELECT p_partkey AS id, CASE WHEN p_type = 'PROMO' THEN 'anime' ELSE 'movie' END AS kind, p_name, CASE WHEN p_size % 2 = 0 THEN CAST(2000 + length(p_name) % 2 AS INT) END AS y, CASE WHEN p_partkey % 10 = 3 THEN p_partkey END AS tmdb FROM part"
_WORKS = f"WITH o AS ({_ORPHANS}), w AS (SELECT *, concat_ws('|', kind, p_name, coalesce((max(y) OVER (PARTITION BY kind, p_name))::VARCHAR, ''), '') AS work FROM o)"


@_query(f"{_WORKS} SELECT work, count(*)::BIGINT AS n_rows, arg_min(tmdb, id) FILTER (tmdb IS NOT NULL) AS tmdb_id, false AS ambiguous_year FROM w GROUP BY work")
def work_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by work, with the first id known; rows without a year join the one year there is."""
    return enrich.work_groups(_orphans(spark, sf_dir)).select("work", "n_rows", "tmdb_id", "ambiguous_year")


@_query(
    """WITH o AS (SELECT o_custkey % 50 AS k, CASE WHEN o_custkey % 50 < 10 THEN CASE WHEN o_orderkey % 3 > 0 THEN CAST(year(o_orderdate) AS INT) END WHEN o_orderkey % 3 > 0 AND year(o_orderdate) = 1998 THEN 1998 END AS y FROM orders),
    b AS (SELECT k, count(DISTINCT y) AS n, max(y) AS top FROM o GROUP BY k)
    SELECT concat_ws('|', 'movie', 'k' || o.k, coalesce((CASE WHEN n <= 1 THEN top ELSE y END)::VARCHAR, ''), '') AS work, count(*)::BIGINT AS n_rows, bool_or(y IS NULL AND n > 1) AS ambiguous_year FROM o JOIN b USING (k) GROUP BY 1"""
)
def year_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order: a fifth of the titles has several years, so those without one stay apart and are marked; the others have one."""
    none, known = F.lit(None).cast("long"), F.col("o_orderkey") % 3 > 0
    year = F.when(F.col("o_custkey") % 50 < 10, F.when(known, F.year("o_orderdate"))).when(known & (F.year("o_orderdate") == 1998), F.lit(1998))
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("movie").alias("kind"), F.concat(F.lit("k"), (F.col("o_custkey") % 50).cast("string")).alias("search_key"), year.alias("year"), F.lit(1).alias("season"), F.array(F.lit("tmdb_id")).alias("needed"), F.lit(None).cast("string").alias("imdb_id"), *[none.alias(c) for c in enrich.ID_COLUMNS[1:]])
    return enrich.work_groups(rows).select("work", "n_rows", "ambiguous_year")


_NEEDED = "CASE WHEN p_size % 3 = 0 THEN 'imdb_id' WHEN p_size % 3 = 1 THEN 'tmdb_id' ELSE 'mal_id' END"


@_query(
    f"""SELECT concat_ws('|', 'movie', p_name, '', '') AS work, string_agg(DISTINCT {_NEEDED}, ',' ORDER BY {_NEEDED}) AS needed, max(p_size % 5)::INT AS attempts, bool_or(p_partkey % 7 = 0) AS has_episode,
    bool_or(p_partkey % 11 = 0) AS type_guessed FROM part GROUP BY p_name"""
)
def work_needs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a work's rows need together, their most attempts, and whether any has an episode or a guessed kind."""
    none = F.lit(None).cast("long")
    rows = _parts(spark, sf_dir, "'movie' AS kind", "p_name AS search_key", "CAST(NULL AS INT) AS year", "1 AS season", f"array({_NEEDED}) AS needed", "CAST(p_size % 5 AS INT) AS tries", "p_partkey % 7 = 0 AS has_episode", "p_partkey % 11 = 0 AS type_guessed").withColumnRenamed("p_partkey", "id")
    rows = rows.withColumn("imdb_id", F.lit(None).cast("string")).withColumns({c: none for c in enrich.ID_COLUMNS[1:]})
    works = enrich.work_groups(rows, attempts="tries", flags=("has_episode", "type_guessed"))
    return works.select("work", F.array_join("needed", ",").alias("needed"), "attempts", "has_episode", "type_guessed")


@_query(
    """SELECT count(*) FILTER (p % 2 = 0)::BIGINT AS n_propagated, count(*) FILTER (p % 2 = 1 AND p % 3 = 0)::BIGINT AS n_resolved, count(*) FILTER (p % 2 = 1 AND p % 3 > 0)::BIGINT AS n_unresolved FROM (SELECT c_custkey AS p FROM customer)"""
)
def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Works complete by propagation, resolved and left open."""
    c, k = _t(spark, sf_dir, "customer"), F.col("c_custkey")
    none = F.array().cast("array<string>")
    groups = c.select(k.alias("work"), F.when(k % 2 == 0, none).otherwise(F.array(F.lit("tmdb_id"))).alias("open"))
    resolved = c.where(k % 2 == 1).select(k.alias("work"), F.when(k % 3 == 0, none).otherwise(F.array(F.lit("tmdb_id"))).alias("open"))
    return enrich.outcome_counts(groups, resolved)


@_query(
    f"""WITH v AS (SELECT p_partkey AS work, 0 AS i, p_name AS query FROM part WHERE {SEASON} = 1 OR p_partkey % 2 = 1
      UNION ALL SELECT p_partkey, i, CASE i WHEN 0 THEN p_name || ' ' || {SEASON} || CASE {SEASON} WHEN 2 THEN 'nd' WHEN 3 THEN 'rd' ELSE 'th' END || ' Season' WHEN 1 THEN p_name || ' Season ' || {SEASON} WHEN 2 THEN p_name || ' ' || {SEASON} ELSE p_name END
      FROM part, range(4) AS u(i) WHERE {SEASON} > 1 AND p_partkey % 2 = 0)
    SELECT work, i::INT AS attempt, query, 2011 AS year FROM v UNION ALL SELECT work, (i + 100)::INT, query, NULL FROM v"""
)
def search_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title variants with the year, and then without."""
    works = _parts(spark, sf_dir, "CASE WHEN p_partkey % 2 = 0 THEN 'anime' ELSE 'series' END AS kind", "p_name AS title", "2011 AS year", f"{SEASON} AS season").withColumnRenamed("p_partkey", "work")
    return enrich.attempts_of(works, with_year_first=True).select("work", "attempt", "query", "year")


@_query(f"{_WORKS}, g AS (SELECT work, arg_min(tmdb, id) FILTER (tmdb IS NOT NULL) AS t FROM w GROUP BY work) SELECT id, CASE WHEN tmdb IS NULL THEN coalesce(t, 0) ELSE tmdb END AS tmdb_id, CASE WHEN tmdb IS NULL AND t IS NOT NULL THEN 'tmdb_id' ELSE '' END AS filled FROM w JOIN g USING (work)")
def propagate_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of a work reach its rows that miss them."""
    rows = _orphans(spark, sf_dir)
    placed = rows.join(rows.groupBy(F.col("kind").alias("_k"), F.col("search_key").alias("_t")).agg(F.max("year").alias("_y")), (F.col("kind") == F.col("_k")) & (F.col("search_key") == F.col("_t")))
    placed = placed.withColumn("work", enrich.work_key(F.col("kind"), F.col("search_key"), F.col("_y"), F.col("season"))).select("id", "work", *enrich.ID_COLUMNS)
    return enrich.propagate(placed, enrich.work_groups(rows)).select("id", "tmdb_id", F.array_join("filled", ",").alias("filled"))


@_query("SELECT concat_ws('|', 'movie', 'k' || o_custkey, '', '') AS work, count(*)::BIGINT AS n_rows FROM orders GROUP BY o_custkey ORDER BY n_rows DESC, work LIMIT 25")
def lookup_budget_topn(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quota's works: the largest groups first."""
    none = F.lit(None).cast("long")
    rows = _t(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), F.lit("movie").alias("kind"), F.concat(F.lit("k"), F.col("o_custkey").cast("string")).alias("search_key"), F.lit(None).cast("int").alias("year"), F.lit(1).alias("season"), F.array(F.lit("tmdb_id")).alias("needed"), F.lit(None).cast("string").alias("imdb_id"), *[none.alias(c) for c in enrich.ID_COLUMNS[1:]])
    return enrich.lookup_budget(enrich.still_needed(enrich.work_groups(rows)), 25).select("work", "n_rows")


@_query("SELECT o_orderkey, CASE WHEN c_nationkey < 10 THEN c_custkey + 1000000 END AS kitsu_id FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def exact_bridge_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as works with an id at a site, customers as the bridge to another."""
    bridge = _t(spark, sf_dir, "customer").where("c_nationkey < 10").select(F.lit("anilist/anime").alias("site"), F.col("c_custkey").alias("external_id"), (F.col("c_custkey") + 1000000).alias("kitsu_id"))
    works = _t(spark, sf_dir, "orders").select("o_orderkey", F.col("o_custkey").alias("anilist_id"))
    return enrich.by_external_id(works, bridge, "anilist/anime", "anilist_id").select("o_orderkey", F.col("bridged_kitsu_id").alias("kitsu_id"))


@_query("SELECT c_custkey AS work, CASE WHEN c_custkey % 4 = 0 THEN c_custkey * 10 WHEN c_custkey % 4 = 1 THEN c_custkey * 10 + 1 END AS tmdb_id, CASE WHEN c_custkey % 4 = 0 THEN 'movie' WHEN c_custkey % 4 = 1 THEN 'tv' END AS found_kind FROM customer")
def find_by_imdb(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exact lookup that prefers the work's own kind."""
    c = _t(spark, sf_dir, "customer")
    imdb = F.concat(F.lit("tt"), F.col("c_custkey").cast("string"))
    works = c.select(F.col("c_custkey").alias("work"), F.lit("movie").alias("kind"), imdb.alias("imdb_id"))
    tv = c.where("c_custkey % 4 < 2").select(imdb.alias("imdb_id"), F.lit("tv").alias("kind"), (F.col("c_custkey") * 10 + 1).alias("tmdb_id"))
    films = c.where("c_custkey % 4 = 0").select(imdb.alias("imdb_id"), F.lit("movie").alias("kind"), (F.col("c_custkey") * 10).alias("tmdb_id"))
    return enrich.find_by_imdb(works, tv.unionByName(films)).select("work", F.col("found_tmdb_id").alias("tmdb_id"), "found_kind")


_SCORE = f"round(least(1.0, greatest({_DICE}, {_JACCARD})), 9)"


@_query(
    f"""WITH w AS (SELECT DISTINCT p_name AS a FROM part), c AS (SELECT p_name AS b, min(p_partkey) AS work_id FROM part WHERE p_size > 20 GROUP BY p_name),
    s AS (SELECT a, work_id, {_SCORE} AS score FROM w JOIN c ON split_part(a, ' ', 1) = split_part(b, ' ', 1))
    SELECT a AS work, work_id, score AS match_score FROM s WHERE score >= 0.4 QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, work_id) = 1"""
)
def catalogue_best_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names against a catalogue of names, blocked by their first word."""
    part = _t(spark, sf_dir, "part")
    attempts = enrich.with_block(part.select(F.col("p_name").alias("work"), F.lit(0).alias("attempt"), F.col("p_name").alias("query"), F.lit(None).cast("int").alias("year")).distinct(), F.col("query"))
    found = part.where("p_size > 20").groupBy("p_name").agg(F.min("p_partkey").alias("work_id"))
    candidates = enrich.with_block(found.select("work_id", F.array("p_name").alias("titles"), F.lit(None).cast("int").alias("year"), F.lit(0.0).alias("popularity"), F.col("work_id").alias("rank"), "p_name"), F.col("p_name"))
    return enrich.best_match(attempts, candidates, block="block", min_score=0.4).select("work", "work_id", "match_score")


@_query(
    """SELECT c_custkey AS work, CASE WHEN c_custkey % 2 = 0 THEN c_custkey + 5 END AS tmdb_id, CASE WHEN c_custkey % 4 = 0 THEN 'tt' || (c_custkey + 5) WHEN c_custkey % 2 = 0 THEN 'tt' || c_custkey END AS imdb_id,
    CASE WHEN c_custkey % 2 = 0 THEN 'tmdb' ELSE 'none' END AS ids_source, CASE WHEN c_custkey % 2 = 0 THEN 1.0 END::DOUBLE AS ids_confidence FROM customer"""
)
def resolve_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Films by imdb id where there is one, else by title; the imdb id behind the tmdb id fills in."""
    c = _t(spark, sf_dir, "customer")
    k, none = F.col("c_custkey"), F.lit(None).cast("long")
    title = F.concat(F.lit("w"), F.md5(k.cast("string")))
    works = c.select(k.alias("work"), F.lit("movie").alias("kind"), title.alias("title"), F.lit(None).cast("int").alias("year"), F.when(k % 4 == 2, F.concat(F.lit("tt"), k.cast("string"))).alias("imdb_id"), none.alias("tmdb_id"), none.alias("anilist_id"), none.alias("kitsu_id"), none.alias("mal_id"))
    find = c.where("c_custkey % 4 = 2").select(F.concat(F.lit("tt"), k.cast("string")).alias("imdb_id"), F.lit("movie").alias("kind"), (k + 5).alias("tmdb_id"))
    search = c.where("c_custkey % 4 = 0").select(F.lit("tmdb").alias("source"), F.lit("movie").alias("kind"), (k + 5).alias("work_id"), title.alias("title"), F.array().cast("array<string>").alias("alt_titles"), F.lit(None).cast("int").alias("year"), F.lit(0.0).alias("popularity"), F.lit(0).alias("rank"))
    external = c.where("c_custkey % 2 = 0").select(F.lit("movie").alias("kind"), (k + 5).alias("tmdb_id"), F.concat(F.lit("tt"), (k + 5).cast("string")).alias("imdb_id"))
    bridge = c.where("false").select(F.lit("x").alias("site"), k.alias("external_id"), k.alias("kitsu_id"))
    return enrich.resolve(works, search, bridge, find, external).select("work", "tmdb_id", "imdb_id", "ids_source", "ids_confidence")


@_query(
    """SELECT c_custkey AS work, CASE WHEN c_custkey % 5 = 3 OR c_custkey % 10 = 4 THEN c_custkey + 5000000 END AS tmdb_id, CASE c_custkey % 5 WHEN 0 THEN c_custkey WHEN 1 THEN c_custkey + 3000000 END AS anilist_id,
    CASE WHEN c_custkey % 5 < 2 THEN c_custkey + 1000000 WHEN c_custkey % 5 = 2 THEN c_custkey + 4000000 END AS kitsu_id, CASE WHEN c_custkey % 5 < 2 THEN c_custkey + 2000000 END AS mal_id,
    CASE WHEN c_custkey % 5 = 3 THEN 'tt1' || c_custkey WHEN c_custkey % 10 = 4 THEN 'tt2' || c_custkey END AS imdb_id,
    CASE c_custkey % 5 WHEN 0 THEN 'kitsu' WHEN 1 THEN 'anilist+kitsu' WHEN 2 THEN 'kitsu' WHEN 3 THEN 'tmdb' ELSE CASE WHEN c_custkey % 10 = 4 THEN 'tmdb' ELSE 'none' END END AS ids_source,
    CASE WHEN c_custkey % 5 IN (1, 2, 3) OR c_custkey % 10 = 4 THEN 1.0 END::DOUBLE AS ids_confidence FROM customer"""
)
def resolve_cascade_anime(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anime by the bridge, by AniList's and Kitsu's titles and alternative titles, and by TMDB's series, or films where there are no episodes."""
    c = _t(spark, sf_dir, "customer")
    k, none, m = F.col("c_custkey"), F.lit(None).cast("long"), F.col("c_custkey") % 5
    title = F.concat(F.lit("w"), F.md5(k.cast("string")))
    works = c.select(k.alias("work"), F.lit("anime").alias("kind"), title.alias("title"), F.lit(None).cast("int").alias("year"), F.lit(False).alias("has_episode"), F.lit(None).cast("string").alias("imdb_id"), none.alias("tmdb_id"), F.when(m == 0, k).alias("anilist_id"), none.alias("kitsu_id"), none.alias("mal_id"))
    source, found = F.when(m == 1, "anilist").when(m == 2, "kitsu").otherwise("tmdb"), F.when(m == 1, k + 3000000).when(m == 2, k + 4000000).otherwise(k + 5000000)
    kind, known_as = F.when(m == 4, "movie").otherwise("tv"), F.when(m == 1, F.concat(F.lit("x"), title)).otherwise(title)  # AniList knows them by an alternative title
    search = c.where((m > 0) & ((m < 4) | (k % 10 == 4))).select(source.alias("source"), kind.alias("kind"), found.alias("work_id"), known_as.alias("title"), F.array(title).alias("alt_titles"), F.lit(None).cast("int").alias("year"), F.lit(0.0).alias("popularity"), F.lit(0).alias("rank"))
    at_anilist = F.when(m == 0, k).otherwise(k + 3000000)
    site = lambda name, external: c.where(m < 2).select(F.lit(name).alias("site"), external.alias("external_id"), (k + 1000000).alias("kitsu_id"))
    bridge = site("anilist/anime", at_anilist).unionByName(site("myanimelist/anime", k + 2000000))
    external = c.where(m >= 3).select(kind.alias("kind"), (k + 5000000).alias("tmdb_id"), F.concat(F.when(m == 3, "tt1").otherwise("tt2"), k.cast("string")).alias("imdb_id"))
    find = c.where("false").select(F.lit("").alias("imdb_id"), F.lit("").alias("kind"), k.alias("tmdb_id"))
    return enrich.resolve(works, search, bridge, find, external).select("work", "tmdb_id", "anilist_id", "kitsu_id", "mal_id", "imdb_id", "ids_source", "ids_confidence")


@_query("SELECT event_id, user_id % 4 + 1 AS ids_attempts, TIMESTAMP '2024-01-31 00:00:00' AS ids_checked_at, CASE WHEN event_type = 'view' THEN 'tmdb' ELSE 'none' END AS ids_source, round(floor(value) / 100, 3) AS ids_confidence FROM events")
def telemetry_patch(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = _t(spark, sf_dir, "events").select("event_id", F.when(F.col("event_type") == "view", "tmdb").alias("ids_source"), (F.floor("value") / 100).alias("ids_confidence"), (F.col("user_id") % 4).alias("ids_attempts"))
    return enrich.telemetry_patch(e, key="event_id", as_of=AS_OF).drop("changed").withColumn("ids_checked_at", F.col("ids_checked_at").cast("timestamp_ntz"))


# --- identity and survivors ----------------------------------------------------------------------------------------------------


@_query("")  # a recursive reach is too slow on the whole graph; the tests hold it against a union-find
def connected_components_of_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders and parts that line items join: every line item."""
    e = _t(spark, sf_dir, "lineitem").select(F.concat(F.lit("o"), F.col("l_orderkey").cast("string")).alias("a"), F.concat(F.lit("p"), F.col("l_partkey").cast("string")).alias("b"))
    return connected_components(e, "a", "b", Workspace(spark, "cc"))


def _identified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as rows with ids (or none) and an alias of name and brand."""
    k = F.col("p_partkey")
    ids = identity.work_identifiers(F.lit("movie"), F.when(k % 4 == 0, F.concat(F.lit(" TT"), (k % 40).cast("string"))), F.when(k % 4 < 2, k % 60), F.lit(0).cast("long"), F.lit(None).cast("long"), F.lit(None).cast("long"))
    return _t(spark, sf_dir, "part").select(k.alias("id"), ids.alias("ids"), identity.title_alias(F.lit("movie"), F.concat_ws(" ", "p_name", "p_brand"), F.lit(None).cast("int")).alias("alias"))


@_query("SELECT p_partkey AS id, concat_ws(',', CASE WHEN p_partkey % 4 = 0 THEN 'imdb:tt' || p_partkey % 40 END, CASE WHEN p_partkey % 4 < 2 AND p_partkey % 60 > 0 THEN 'tmdb:movie:' || p_partkey % 60 END) AS ids FROM part")
def work_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _identified(spark, sf_dir).select("id", F.array_join("ids", ",").alias("ids"))


@_query(
    """WITH RECURSIVE r AS (SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN 'imdb:tt' || p_partkey % 40 END AS i, CASE WHEN p_partkey % 4 < 2 AND p_partkey % 60 > 0 THEN 'tmdb:movie:' || p_partkey % 60 END AS t,
      'title:movie:' || p_name || ' ' || p_brand || ':' AS alias FROM part),
    e AS (SELECT i AS a, t AS b FROM r WHERE i IS NOT NULL AND t IS NOT NULL), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
    reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, x.b FROM reach r JOIN both_ways x ON r.b = x.a), cc AS (SELECT a AS node, least(a, min(b)) AS c FROM reach GROUP BY a),
    rooted AS (SELECT r.*, coalesce(cc.c, coalesce(i, t)) AS root FROM r LEFT JOIN cc ON cc.node = coalesce(i, t)),
    owners AS (SELECT alias, min(root) AS owner, count(DISTINCT root) AS n FROM rooted WHERE root IS NOT NULL GROUP BY alias)
    SELECT id, CASE WHEN root IS NOT NULL THEN root WHEN n = 1 THEN owner ELSE alias END AS root, root IS NULL AS by_alias, root IS NULL AND coalesce(n, 0) > 1 AS ambiguous FROM rooted LEFT JOIN owners USING (alias)"""
)
def alias_link_unambiguous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without ids join the component that alone owns their title."""
    return identity.work_roots(_identified(spark, sf_dir), Workspace(spark, "roots"))


@_query(
    f"""SELECT p_partkey, CASE p_partkey % 6 WHEN 0 THEN 'movie' WHEN 1 THEN 'e' || {EPISODE} WHEN 2 THEN 's' || {SEASON} || 'e' || {EPISODE} || '-e99' WHEN 3 THEN 's' || {SEASON} || 'pack' WHEN 4 THEN 'complete' ELSE 'full' END AS episode_key FROM part"""
)
def episode_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("p_partkey") % 6
    rows = _parts(spark, sf_dir, f"{SEASON} AS s", f"{EPISODE} AS e")
    kind = F.when(m == 0, "movie").when(m == 1, "anime").otherwise("series")
    key = identity.episode_key(kind, F.when(m.isin(2, 3), F.col("s")).when(m == 1, 1), F.when(m.isin(1, 2), F.col("e")), F.lit(None).cast("int"), episode_end=F.when(m == 2, 99), season_end=F.lit(None).cast("int"), complete=m == 4)
    return rows.select("p_partkey", key.alias("episode_key"))


@_query(
    """SELECT p_partkey, round(log2(1 + p_size) * 20 + CASE p_partkey % 3 WHEN 0 THEN 40 WHEN 1 THEN 25 ELSE -30 END + 10 + CASE p_partkey % 5 WHEN 0 THEN 12 WHEN 1 THEN 12 WHEN 2 THEN 2 WHEN 3 THEN -8 ELSE 8 END
    + CASE p_partkey % 4 WHEN 0 THEN 15 WHEN 1 THEN 8 WHEN 2 THEN 6 ELSE -6 END + CASE WHEN p_partkey % 2 = 0 THEN 4 ELSE 0 END - CASE WHEN p_partkey % 4 = 0 THEN 10 ELSE 0 END, 6) AS score FROM part"""
)
def candidate_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _parts(spark, sf_dir, "p_size", f"{CODEC_LABEL} AS codec", f"lower({SOURCE}) AS source", f"{QUALITY} AS quality")
    given = {"codec": F.col("codec"), "container": F.lit("mkv"), "source": F.col("source"), "quality": F.col("quality"), "audio_codec": F.lit(None).cast("string"), "hdr": F.lit(None).cast("string")}
    s = survivors.score(given, F.col("p_size"), F.lit(200 * survivors.MIB), bit_depth=F.lit(8), flags=F.array().cast("array<string>"), dual=F.col("p_partkey") % 2 == 0)
    return rows.select("p_partkey", F.round(s, 6).alias("score"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as candidates: groups of a source and ten lengths, a class by language, a score by length."""
    d = _t(spark, sf_dir, "documents")
    lang = F.col("lang")
    c = F.struct((lang == "es").alias("spanish"), (lang == "en").alias("english"), (lang == "fr").alias("other"), (lang == "de").alias("unknown"))
    return d.select(
        F.col("doc_id").alias("id"), F.coalesce("source", F.lit("?")).alias("root"), F.when(F.col("doc_id") % 17 == 0, "full").otherwise(F.concat(F.lit("e"), (F.col("doc_id") % 13).cast("string"))).alias("episode_key"),
        F.round(F.log2(1 + F.col("n_chars")) * 2, 9).alias("score"), (F.col("n_chars") % 100).alias("seeders"), F.lit(None).cast("timestamp").alias("updated_at"), F.col("n_chars").alias("size_bytes"), c.alias("lang"),
        ((lang == "es") & (F.col("doc_id") % 3 == 0)).alias("spanish_audio"), ((lang == "en") & (F.col("doc_id") % 3 == 0)).alias("english_audio"),
    )


def _survivor_sql(margin: float, keep_others: bool) -> str:
    return f"""
    WITH c AS (SELECT doc_id AS id, coalesce(source, '?') AS root, CASE WHEN doc_id % 17 = 0 THEN 'full' ELSE 'e' || doc_id % 13 END AS ep, round(log2(1 + n_chars) * 2, 9) AS score, n_chars % 100 AS seeders, n_chars AS size, lang, doc_id % 3 = 0 AS audio FROM documents),
    r AS (SELECT *, count(*) OVER (PARTITION BY root, ep) AS n, row_number() OVER (PARTITION BY root, ep ORDER BY score DESC, seeders DESC, size DESC, id) AS best FROM c),
    es AS (SELECT id, root, ep, score, audio, row_number() OVER w AS k, first_value(score) OVER w AS top, first_value(audio) OVER w AS dubbed FROM c WHERE lang = 'es' WINDOW w AS (PARTITION BY root, ep ORDER BY score DESC, seeders DESC, size DESC, id)),
    en AS (SELECT id, root, ep, score, audio AND lang = 'en' AS audio, row_number() OVER w AS k, first_value(score) OVER w AS top, first_value(audio AND lang = 'en') OVER w AS dubbed FROM c WHERE lang IN ('en', 'de') WINDOW w AS (PARTITION BY root, ep ORDER BY score DESC, seeders DESC, size DESC, id)),
    picks AS (SELECT root, ep, CASE WHEN bool_or(dubbed) THEN 1 ELSE coalesce(min(k) FILTER (k > 1 AND audio AND top - score <= {margin}), 1) END AS k, 'es' AS class FROM es GROUP BY root, ep
      UNION ALL SELECT root, ep, CASE WHEN bool_or(dubbed) THEN 1 ELSE coalesce(min(k) FILTER (k > 1 AND audio AND top - score <= {margin}), 1) END, 'en' FROM en GROUP BY root, ep),
    kept AS (SELECT id FROM es JOIN picks p ON p.class = 'es' AND p.root = es.root AND p.ep = es.ep AND p.k = es.k UNION SELECT id FROM en JOIN picks p ON p.class = 'en' AND p.root = en.root AND p.ep = en.ep AND p.k = en.k
      UNION SELECT id FROM c WHERE {'lang = ' + chr(39) + 'fr' + chr(39) if keep_others else 'false'}),
    held AS (SELECT DISTINCT root, ep FROM c JOIN kept USING (id))
    SELECT r.id, r.root, r.ep AS episode_key, (n = 1 OR r.ep = 'full' OR k.id IS NOT NULL OR (s.root IS NULL AND best = 1)) AS keep FROM r LEFT JOIN kept k USING (id) LEFT JOIN held s ON s.root = r.root AND s.ep = r.ep"""


_GROUP = {"group": ["root", "episode_key"], "episode": "episode_key"}


@_query(_survivor_sql(10, False))
def dedupe_survivors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Which documents survive of each group."""
    return survivors.mark_survivors(_candidates(spark, sf_dir), **_GROUP).select("id", "root", "episode_key", "keep")


@_query(_survivor_sql(0.5, False))
def dedupe_audio_preference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A narrow margin for rows that have the language as audio."""
    return survivors.mark_survivors(_candidates(spark, sf_dir), margin=0.5, **_GROUP).select("id", "root", "episode_key", "keep")


@_query(_survivor_sql(10, True))
def dedupe_policy_keep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other languages are left alone."""
    return survivors.mark_survivors(_candidates(spark, sf_dir), other_policy="keep", **_GROUP).select("id", "root", "episode_key", "keep")


@_query(f"SELECT id FROM ({_survivor_sql(10, False)}) WHERE NOT keep")
def dedupe_delete_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return survivors.delete_set(survivors.mark_survivors(_candidates(spark, sf_dir), **_GROUP))


@_query(
    f"""WITH m AS ({_survivor_sql(10, False)}), g AS (SELECT root, episode_key, count(*) AS n, count(*) FILTER (NOT keep) AS gone FROM m GROUP BY ALL)
    SELECT count(*)::BIGINT AS n_groups, count(*) FILTER (n > 1)::BIGINT AS n_duplicated, count(*) FILTER (n > 1 AND episode_key = 'full')::BIGINT AS n_unknown_episode, sum(gone)::BIGINT AS n_deletes FROM g"""
)
def pipeline_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counters of a deduplication."""
    marked = survivors.mark_survivors(_candidates(spark, sf_dir), **_GROUP)
    return survivors.dedupe_metrics(marked, ["root", "episode_key"], "episode_key")
