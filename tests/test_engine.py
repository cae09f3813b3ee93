"""Policies, guard, languages, patches, identity, survivors, store and the whole run."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from marlstone.config import Config, as_ratio, choose_steps, read_env_file
from marlstone.functions import labels, languages, text
from marlstone.operators import components, enrich, guard, identity, patch, policies, survivors
from marlstone.plans import pipeline
from marlstone.sources.resolver import RateLimited, RateLimiter, Transient, once, ordered_map, with_retry
from marlstone.sources.store import TableStore, with_telemetry
from marlstone.sources.workspace import Workspace

NOW = dt.datetime(2025, 6, 1)
CATALOGUE = (
    "id long, title string, title_text string, type string, season int, episode int, absolute_episode int, imdb_id string, tmdb_id long, anilist_id long, kitsu_id long, mal_id long, "
    "size_bytes long, seeders long, audio array<string>, subtitles array<string>, codec string, quality string, updated_at timestamp, info_hash string"
)


def catalogue(spark, rows):
    base = dict.fromkeys([c.split()[0] for c in CATALOGUE.split(", ")]) | {"size_bytes": 2 << 30, "seeders": 10, "updated_at": NOW - dt.timedelta(days=1)}
    return spark.createDataFrame([tuple((base | r).values()) for r in rows], CATALOGUE)


def values(spark, column, data, kind="string"):
    return [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(data)], f"i int, x {kind}").orderBy("i").select(column(F.col("x"))).collect()]


def test_keyword_policy(spark):
    titles = [None, "", "Plain title", "A NSFW thing", "Hardcore Henry 2015", "hardcore.stuff", "Vixen 1968", "Vixen again", "analítico", "xXx Return of Xander Cage", "XXX anything", "hardcorex", "porn - Hardcore Henry"]
    got = values(spark, policies.keyword_policy, titles)
    assert got == [False, False, False, True, False, True, False, True, False, False, True, False, True]


def test_policies_keep_where_unknown(spark):
    df = spark.createDataFrame([(1, "movie", 5), (2, "movie", None), (3, None, 5), (4, "series", 5), (5, "anime", 0), (6, "movie", 50), (7, "series", -1)], "id int, k string, n int")
    kept, gone = policies.split_by(df, policies.size_policy(F.col("k"), F.col("n"), movie=10, series=8))
    assert {r.id for r in gone.collect()} == {1, 4} and kept.count() == 5
    assert {r.id for r in policies.split_by(df, policies.size_policy(F.col("k"), F.col("n"), movie=10, series=8, anime=False, zero=True))[1].collect()} == {1, 4, 7}
    old = spark.createDataFrame([(1, 0, NOW - dt.timedelta(days=30)), (2, 0, NOW - dt.timedelta(days=31)), (3, None, NOW - dt.timedelta(days=90)), (4, 0, None)], "id int, s int, t timestamp")
    assert {r.id for r in policies.split_by(old, policies.stale_policy(F.col("s"), F.col("t"), as_of=NOW, days=30))[1].collect()} == {2}
    assert {r.id for r in policies.split_by(old, policies.stale_policy(F.col("s"), F.col("t"), as_of=NOW, days=30, include_null=True))[1].collect()} == {2, 3}


GUARD = [(0, 0, 0.5, False), (0, 100, 0.0, False), (5, 9, 0.1, False), (6, 10, 0.5, True), (5, 10, 0.5, False), (1, 0, 0.5, True), (11, 10, 0.9, True), (1, 100, 1.5, True), (-1, 10, 0.5, True), (math.nan, 10, 0.5, True), (1, math.inf, 0.5, True)]


@pytest.mark.parametrize(("pending", "evaluated", "most", "want"), GUARD)
def test_guard(pending, evaluated, most, want):
    assert guard.exceeds(pending, evaluated, most) is want


def test_guard_as_column_and_check(spark):
    rows = [(i, p, e) for i, (p, e, m, _) in enumerate(GUARD) if m == 0.5 and math.isfinite(p) and math.isfinite(e)]
    got = {r.i: r.b for r in spark.createDataFrame(rows, "i int, p long, e long").select("i", guard.blocked(F.col("p"), F.col("e"), 0.5).alias("b")).collect()}
    assert got == {i: GUARD[i][3] for i, *_ in rows}
    df = spark.range(100)
    assert guard.check(df, {"x": (F.col("id") < 10, F.lit(True))}, 0.1) == {"x": (10, 100)}
    with pytest.raises(guard.DeleteGuard, match="x: would delete 11 of 100"):
        guard.check(df, {"x": (F.col("id") < 11, F.lit(True))}, 0.1)


def test_languages(spark):
    assert languages.labels_of(["Spanish (Latin America)", "ENG", None, "AC3 5.1"]) == ["english", "latino"]
    assert languages.labels_of('["es","pt-br"]') == ["portuguese", "spanish"] and languages.labels_of("{en, fr}") == ["english", "french"]
    assert languages.labels_of(7) == [] and languages.labels_of(None) == [] and languages.labels_of("es/en; de") == ["english", "german", "spanish"]
    assert languages.in_text("Audio: Español Latino") == ["latino"] and languages.in_text("SPA-LA SPA") == ["latino", "spanish"]
    assert values(spark, languages.language_labels, ["es,en", None, ""]) == [["english", "spanish"], [], []]
    got = spark.createDataFrame([(["latino"], []), ([], ["english"]), (["french"], ["german"]), (["french"], []), (None, None)], "a array<string>, s array<string>").select(languages.language_class(F.col("a"), F.col("s")).alias("c")).collect()
    assert [tuple(r.c) for r in got] == [(True, False, False, False), (False, True, False, False), (False, False, True, False), (False, False, False, True), (False, False, False, True)]


def test_text(spark):
    assert values(spark, text.fold, ["Big.Ass_Spider!", "ÉÑ ü", None, "é"]) == ["big ass spider", "en u", "", "e"]
    assert values(spark, text.search_key, ["The Man & the Sea", "El Niño", "アニメ the", None]) == ["man and sea", "nino", "アニメ", ""]
    pairs = [("frieren", "frieren"), ("", "x"), ("abc", "xyz"), ("night watch", "night watching"), ("a b", "b a")]
    got = [tuple(r) for r in spark.createDataFrame(pairs, "a string, b string").select(text.dice(F.col("a"), F.col("b")), text.similarity(F.col("a"), F.col("b"))).collect()]
    assert got[0] == (1.0, 1.0) and got[1] == (0.0, 0.0) and got[2] == (0.0, 0.0) and got[3][1] >= 11 / 14 + 0.15 - 1e-9
    assert values(spark, text.ordinal, [1, 2, 3, 4, 11, 12, 13, 21, 112], "int") == ["1st", "2nd", "3rd", "4th", "11th", "12th", "13th", "21st", "112th"]


def test_labels(spark):
    assert values(spark, labels.quality_label, ["1080P", "1720", "8K", "full hd", "TS", None, "", "x720p-"]) == ["1080p", None, "2160p", "1080p", None, None, None, "720p"]
    assert values(spark, labels.codec_label, ["X264", "H.265 Main10", "av1", "?", None]) == ["h264", "hevc", "av1", None, None]
    assert values(spark, labels.type_label, ["Película", "TV Show", "x"]) == ["movie", "series", None]


def test_patches(spark):
    before = spark.createDataFrame([(1, "a", 1), (2, "b", None), (3, None, 3)], "id int, x string, n int")
    after = spark.createDataFrame([(1, "a", None), (2, "c", None), (3, None, 3)], "id int, x string, n int")
    p = patch.diff(before, after, "id", ["x", "n"])
    assert {(r.id, tuple(r.changed), r.x, r.n) for r in p.collect()} == {(1, ("n",), None, None), (2, ("x",), "c", None)}
    assert sorted(map(tuple, patch.apply_patch(before, p, "id", ["x", "n"]).collect())) == sorted(map(tuple, after.collect()))
    assert patch.diff(after, patch.apply_patch(before, p, "id", ["x", "n"]), "id", ["x", "n"]).isEmpty()


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components(spark, seed):
    rng = random.Random(seed)
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 140)]
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", Workspace(spark, "t")).collect()}
    for a, b in edges:
        if a != b:
            assert got[a] == got[b] <= min(a, b)
    assert got[140] == 100


def test_aliases(spark):
    rows = [(1, ["imdb:a"], "t1"), (2, ["imdb:a", "tmdb:1"], None), (3, [], "t1"), (4, ["mal:9"], "t2"), (5, ["mal:8"], "t2"), (6, [], "t2"), (7, [], "t3"), (8, [], None), (9, ["tmdb:1"], "t9"), (10, [], "t9")]
    got = {r.id: (r.root, r.by_alias, r.ambiguous) for r in identity.work_roots(spark.createDataFrame(rows, "id int, ids array<string>, alias string"), Workspace(spark, "t")).collect()}
    assert got[1][0] == got[2][0] == got[3][0] == got[9][0] == got[10][0] and got[3][1:] == (True, False)
    assert got[4][0] != got[5][0] and got[6] == ("t2", True, True) and got[7] == ("t3", True, False) and 8 not in got


def candidates(spark, rows):
    cols = "id int, g string, ep string, score double, seeders long, updated_at timestamp, size_bytes long, lang struct<spanish:boolean,english:boolean,other:boolean,unknown:boolean>, spanish_audio boolean, english_audio boolean"
    full = [(i, "w", "e1", s, 1, None, 1, lang, es, en) for i, s, lang, es, en in rows]
    return spark.createDataFrame(full, cols)


ES, EN, OTHER, UNKNOWN, BOTH = (True, False, False, False), (False, True, False, False), (False, False, True, False), (False, False, False, True), (True, True, False, False)


@pytest.mark.parametrize(
    ("rows", "options", "want"),
    [
        ([(1, 50.0, ES, True, False), (2, 40.0, ES, True, False), (3, 30.0, EN, False, True)], {}, {1, 3}),
        ([(1, 50.0, BOTH, True, True), (2, 49.0, ES, True, False)], {}, {1}),
        ([(1, 50.0, ES, False, False), (2, 41.0, ES, True, False)], {}, {2}),
        ([(1, 50.0, ES, False, False), (2, 39.0, ES, True, False)], {}, {1}),
        ([(1, 50.0, OTHER, False, False), (2, 40.0, OTHER, False, False)], {}, {1}),
        ([(1, 50.0, OTHER, False, False), (2, 40.0, EN, False, True)], {}, {2}),
        ([(1, 50.0, OTHER, False, False), (2, 40.0, EN, False, True)], {"other_policy": "keep"}, {1, 2}),
        ([(1, 50.0, UNKNOWN, False, False), (2, 40.0, UNKNOWN, False, False)], {}, {1}),
        ([(1, 50.0, UNKNOWN, False, False), (2, 40.0, UNKNOWN, False, False)], {"unknown_as": "keep"}, {1, 2}),
        ([(1, 50.0, UNKNOWN, False, False), (2, 45.0, EN, False, True)], {}, {2}),
        ([(2, 50.0, EN, False, True), (1, 50.0, EN, False, True)], {}, {1}),
        ([(1, 50.0, OTHER, False, False)], {}, {1}),
    ],
)
def test_survivors(spark, rows, options, want):
    got = survivors.mark_survivors(candidates(spark, rows), group=["g", "ep"], episode="ep", **options)
    assert {r.id for r in got.where("keep").collect()} == want
    again = survivors.mark_survivors(got.where("keep").drop("keep"), group=["g", "ep"], episode="ep", **options)
    assert again.where("not keep").isEmpty()


def test_unknown_episodes_are_left(spark):
    df = candidates(spark, [(1, 5.0, EN, False, True), (2, 4.0, EN, False, True)]).withColumn("ep", F.lit("full"))
    assert survivors.mark_survivors(df, group=["g", "ep"], episode="ep").where("keep").count() == 2


def seed_rows():
    d = dt.timedelta(days=1)
    return [
        {"id": 1, "title": "Some NSFW clip 1080p", "type": "movie"},
        {"id": 2, "title": "Hardcore Henry 2015 1080p BluRay", "type": "movie", "imdb_id": "tt1"},
        {"id": 3, "title": "Tiny Film 2020 1080p", "type": "movie", "size_bytes": 10 << 20},
        {"id": 4, "title": "Unknown Size 2020 1080p", "type": "movie", "size_bytes": 0},
        {"id": 5, "title": "Untyped Small 2019 1080p BluRay", "size_bytes": 20 << 20},
        {"id": 6, "title": "Old Thing 2001 720p", "type": "movie", "seeders": 0, "updated_at": NOW - 90 * d},
        {"id": 7, "title": "New Thing 2001 720p", "type": "movie", "seeders": 0},
        {"id": 8, "title": "Glass Harbour S01E01 1080p x264 Castellano", "type": "Series", "imdb_id": "tt9", "seeders": 100},
        {"id": 9, "title": "Glass Harbour S01E01 720p XviD Castellano", "type": "series", "imdb_id": "tt9", "seeders": 2},
        {"id": 10, "title": "Glass Harbour S01E01 1080p x264 English", "type": "series", "tmdb_id": 77, "imdb_id": "tt9", "seeders": 50, "audio": ["en"]},
        {"id": 11, "title": "Glass Harbour S01E02 1080p x264 English", "type": "series", "tmdb_id": 77},
        {"id": 12, "title": "Glass Harbour S01E01 480p English", "type": "series", "tmdb_id": 77, "seeders": 0},
        {"id": 13, "title": None, "type": "movie"},
        {"id": 14, "title": "Blue Mountain (2020) 1080p BluRay x264", "type": "movie", "tmdb_id": 5},
        {"id": 15, "title": "Blue Mountain (2020) 720p", "type": "movie"},
        {"id": 16, "title": "x" * 3000, "type": "SERIES", "codec": "weird" * 10, "quality": "HD"},
    ]


def test_run(spark):
    ws = Workspace(spark, "t")
    store = TableStore(spark, ws.path("table"))
    store.commit(catalogue(spark, seed_rows()), sort="id")
    dry = pipeline.run(store, Config(as_of=NOW))
    assert dry.ok, dry.markdown()
    assert store.version() == 0 and store.count() == 16
    wet = pipeline.run(store, Config(as_of=NOW, dry_run=False))
    assert wet.ok and store.version() == 1
    left = {r.id: r for r in store.read().collect()}
    assert set(left) == {2, 4, 7, 8, 10, 11, 13, 14, 16}
    assert left[8].type == "series" and (left[8].season, left[8].episode) == (1, 1) and left[8].codec == "h264" and left[8].title_text == "Glass Harbour" and left[8].audio == ["spanish"]
    assert left[10].audio == ["english"] and left[16].quality == "720p" and left[4].info_hash is None
    again = pipeline.curate(store.read(), Config(as_of=NOW, steps=("normalize", "dedupe")))
    assert again.ok and sorted(map(tuple, again.table.collect()), key=str) == sorted(map(tuple, store.read().collect()), key=str)
    assert "| dedupe |" in wet.markdown()


def test_guard_ends_the_run(spark):
    rows = [{"id": i, "title": f"NSFW clip {i}", "type": "movie"} for i in range(20)]
    result = pipeline.curate(catalogue(spark, rows), Config(as_of=NOW, max_delete_ratio=0.5))
    assert not result.ok and len(result.steps) == 1 and result.table.count() == 20
    assert len(pipeline.curate(catalogue(spark, rows), Config(as_of=NOW, max_delete_ratio=0.5, continue_on_error=True, steps=("adult", "dead"))).steps) == 2


def test_enrich_with_catalogues(spark):
    table = catalogue(spark, [{"id": 1, "title": "Blue Mountain (2020) 1080p", "type": "movie"}, {"id": 2, "title": "Blue Mountain (2020) 720p", "type": "movie", "imdb_id": "tt5"}, {"id": 3, "title": "Green Valley 2011 1080p", "type": "movie"}])
    extras = {
        "search": spark.createDataFrame([("tmdb", "movie", 42, "Green Valley", None, 2011, 1.0, 0)], "source string, kind string, work_id long, title string, alt_titles array<string>, year int, popularity double, rank int"),
        "bridge": spark.createDataFrame([], "site string, external_id long, kitsu_id long"),
        "find": spark.createDataFrame([("tt5", "movie", 7)], "imdb_id string, kind string, tmdb_id long"),
        "external": spark.createDataFrame([("movie", 42, "tt42")], "kind string, tmdb_id long, imdb_id string"),
    }
    result = pipeline.curate(table, Config(as_of=NOW, dry_run=False, steps=("enrich",)), extras)
    assert result.ok, result.markdown()
    got = {r.id: r for r in result.table.collect()}
    assert {k: (r.tmdb_id, r.imdb_id) for k, r in got.items()} == {1: (7, "tt5"), 2: (7, "tt5"), 3: (42, "tt42")}
    assert got[3].ids_attempts == 1 and got[3].ids_source == "tmdb" and got[3].ids_checked_at is not None
    assert not enrich.has_telemetry(table) and enrich.has_telemetry(with_telemetry(table))


def test_cascade_for_anime(spark):
    works = spark.createDataFrame([("a", "anime", "Paper Lanterns", None, 2, None, None, None, None, None), ("b", "anime", "Glass Sea", 2010, None, None, None, 31, None, None), ("c", "anime", "Odd One", None, None, None, None, None, None, None), ("d", "movie", "Blue Hill", 1990, None, None, None, None, None, None)], "work string, kind string, title string, year int, season int, imdb_id string, tmdb_id long, anilist_id long, kitsu_id long, mal_id long")
    search = spark.createDataFrame(
        [("anilist", "tv", 10, "Paper Lanterns", None, None, 0.0, 0), ("anilist", "tv", 11, "Paper Lanterns 2nd Season", None, None, 0.0, 1), ("kitsu", "tv", 77, "Odd One", ["Odd 1"], None, 0.0, 0), ("tmdb", "movie", 5, "Blue Hill", None, 2001, 0.0, 0), ("tmdb", "tv", 9, "Glass Sea", None, 2010, 0.0, 0)],
        "source string, kind string, work_id long, title string, alt_titles array<string>, year int, popularity double, rank int",
    )
    bridge = spark.createDataFrame([("anilist/anime", 11, 110), ("myanimelist/anime", 12, 110), ("anilist/anime", 31, 310), ("myanimelist/anime", 32, 310)], "site string, external_id long, kitsu_id long")
    find, external = spark.createDataFrame([], "imdb_id string, kind string, tmdb_id long"), spark.createDataFrame([("tv", 9, "tt9"), ("movie", 5, "bad")], "kind string, tmdb_id long, imdb_id string")
    got = {r.work: r for r in enrich.resolve(works, search, bridge, find, external).collect()}
    assert (got["a"].anilist_id, got["a"].kitsu_id, got["a"].mal_id, got["a"].ids_source) == (11, 110, 12, "anilist+kitsu")  # the season's entry, not the title's
    assert (got["b"].anilist_id, got["b"].kitsu_id, got["b"].mal_id, got["b"].tmdb_id, got["b"].imdb_id) == (31, 310, 32, 9, "tt9") and got["b"].ids_source == "tmdb+kitsu"
    assert (got["c"].kitsu_id, got["c"].anilist_id, got["c"].ids_source, got["c"].ids_confidence) == (77, None, "kitsu", 1.0)
    assert (got["d"].tmdb_id, got["d"].imdb_id, got["d"].ids_source) == (5, None, "tmdb")  # first with its year, which is too far, then without
    assert enrich.attempts_of(works.where("work = 'd'"), with_year_first=True).count() == 2


def test_config():
    assert as_ratio("95", 0.5) == 0.95 and as_ratio("-1", 0.5) == 0.5 and as_ratio("x", 0.5) == 0.5
    assert choose_steps("dedupe, ADULT,zzz") == (("adult", "dedupe"), ("zzz",))
    c = Config.from_env({"DRY_RUN": "no", "MAX_DELETE_RATIO": "80", "MAX_LOOKUPS": "-5", "EXTRA_KEYWORDS": "a, b", "STEPS": "size"})
    assert (c.dry_run, c.max_delete_ratio, c.max_lookups, c.extra_keywords, c.steps) == (False, 0.8, 0, ("a", "b"), ("size",))
    assert Config(unknown_language_as="x", clean_title_column="a b").problems() and not Config().problems()
    assert read_env_file("export A='x # y'\nB=1 # c\nA=2\n#no\nC=") == {"A": "x # y", "B": "1", "C": ""}


def test_resolver_helpers():
    slept, now = [], [0.0]
    calls = iter([Transient("a"), Transient("b", 9.0), "ok"])

    def call():
        x = next(calls)
        if isinstance(x, Exception):
            raise x
        return x

    assert with_retry(call, sleep=slept.append, rng=random.Random(1)) == "ok" and slept[1] == 9.0
    limit = RateLimiter(2, window=10, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s), patience=2, rest=50)
    for _ in range(3):
        limit.acquire()
    assert now[0] == 10.0
    limit.refused(1)
    assert limit.rate == 1
    with pytest.raises(RateLimited):
        limit.refused(1)
    with pytest.raises(RateLimited):
        limit.acquire()
    n = []
    f = once(lambda k: n.append(k) or k)
    assert f("a") == f("a") == "a" and n == ["a"]
    assert ordered_map([3, 1, 2], 2, lambda x: x * 2) == [6, 2, 4]


def test_episode_keys(spark):
    def key(kind, s, e, a, end=None, send=None, done=False):
        lit = lambda v: F.lit(v).cast("int")
        return spark.range(1).select(identity.episode_key(F.lit(kind), lit(s), lit(e), lit(a), episode_end=lit(end), season_end=lit(send), complete=F.lit(done))).first()[0]

    assert [key("movie", None, None, None), key("series", 1, 2, None), key("anime", 1, 2, None), key("anime", 2, 2, None), key("series", 1, 1, None, 5), key("series", None, None, 7), key("series", 2, None, None, None, 4), key("series", None, None, None, done=True), key("anime", None, None, None)] == ["movie", "s1e2", "e2", "s2e2", "s1e1-e5", "e7", "s2-s4pack", "complete", "full"]
    assert values(spark, identity.whole_number, ["1.5", "-1.5", "09", "x", None, "inf", ""]) == [1, -1, 9, None, None, None, None]




def test_resolve_by_alias_and_by_later_words(spark):
    """A work is found by an alt title that starts otherwise, and by a title whose first word differs."""
    queries = {1: "Hollow Lantern Road", 2: "Copper Rivr Crossing", 3: "Nothing Alike"}
    works = spark.createDataFrame([(i, "movie", q, None, None, None, None, None, None) for i, q in queries.items()], "work long, kind string, title string, year int, imdb_id string, tmdb_id long, anilist_id long, kitsu_id long, mal_id long")
    search = spark.createDataFrame([("tmdb", "movie", 11, "Attack of Giants", ["Hollow Lantern Road"], None, 0.0, 0), ("tmdb", "movie", 12, "The 2 Coper River Crossing", None, None, 0.0, 0)], "source string, kind string, work_id long, title string, alt_titles array<string>, year int, popularity double, rank int")
    bridge = spark.createDataFrame([], "site string, external_id long, kitsu_id long")
    find = spark.createDataFrame([], "imdb_id string, kind string, tmdb_id long")
    external = spark.createDataFrame([], "kind string, tmdb_id long, imdb_id string")
    got = {r.work: (r.tmdb_id, r.ids_confidence) for r in enrich.resolve(works, search, bridge, find, external).collect()}
    assert got[1] == (11, 1.0) and got[2][0] == 12 and got[3][0] is None
