"""Catalogue clients against answers in the shape of the services', without a network."""

import threading
from urllib.parse import parse_qs, urlsplit

import pytest

from marlstone.operators import enrich
from marlstone.sources import catalogues
from marlstone.sources.resolver import RateLimiter, Transient

MEDIA = [
    {"id": 11, "idMal": 12, "format": "TV", "seasonYear": 2021, "title": {"romaji": "Kami no Akari", "english": "Paper Lanterns", "native": None, "userPreferred": "Kami no Akari"}, "synonyms": ["Lanterns"]},
    {"id": 13, "format": "MUSIC", "title": {"romaji": "A Song"}},
]


class Answers:
    def __init__(self):
        self.asked, self._lock = [], threading.Lock()

    def __call__(self, url, *, headers=None, body=None, timeout=15.0):
        with self._lock:
            self.asked.append((url, body, headers or {}))
        parts, query = urlsplit(url), parse_qs(urlsplit(url).query)
        if url == catalogues.ANILIST:
            return {"data": {"Page": {"media": MEDIA if "lanterns" in body["variables"]["title"] else []}}}
        if parts.path.endswith("/mappings") and "filter[externalId]" in query:
            return {"data": [{"relationships": {"item": {"data": {"id": "14", "type": "anime"}}}}]} if query["filter[externalId]"] == ["11"] else {"data": []}
        if parts.path.endswith("/anime/14/mappings"):
            return {"data": [{"attributes": {"externalSite": "myanimelist/anime", "externalId": "12"}}, {"attributes": {"externalSite": "anilist/anime", "externalId": "11"}}, {"attributes": {"externalSite": "other", "externalId": "9"}}]}
        if parts.path.endswith("/edge/anime"):
            return {"data": [{"id": "15", "attributes": {"canonicalTitle": "Glass Harbour", "titles": {"en": "The Glass Harbour"}, "abbreviatedTitles": None, "startDate": "2019-04-01", "subtype": "TV"}}, {"id": "16", "attributes": {"subtype": "music"}}]} if "harbour" in query["filter[text]"][0] else {"data": []}
        if parts.path.endswith("/search/movie"):
            return {"results": [{"id": 21, "title": "Blue Mountain", "original_title": "Montaña Azul", "release_date": "2020-02-02", "popularity": 3.5}]} if "mountain" in query["query"][0] and "primary_release_year" not in query else {"results": []}
        if "/external_ids" in parts.path:
            return {"imdb_id": "tt21" if "/movie/21/" in parts.path else None}
        if "/find/" in parts.path:
            return {"movie_results": [], "tv_results": [{"id": 22}]}
        return {"results": []}


WORKS = [
    {"work": "a", "kind": "anime", "title": "paper lanterns", "year": 2021, "season": None, "has_episode": True},
    {"work": "b", "kind": "anime", "title": "glass harbour", "year": None, "season": None, "has_episode": True},
    {"work": "c", "kind": "movie", "title": "blue mountain", "year": 2020, "season": None},
    {"work": "d", "kind": "series", "title": "nobody knows", "year": None, "season": 2, "imdb_id": "tt5", "has_episode": True},
]


def test_tables_resolve(spark):
    answers = Answers()
    tables = catalogues.Catalogues(tmdb_key="k" * 32, ask=answers).tables(spark, WORKS)
    assert {k: v.columns for k, v in tables.items()} == {k: [c.split()[0] for c in s.split(", ")] for k, s in catalogues.SCHEMAS.items()}
    rows = [(w["work"], w["kind"], w["title"], w["year"], w["season"], w.get("has_episode", False), w.get("imdb_id"), None, None, None, None) for w in WORKS]
    works = spark.createDataFrame(rows, "work string, kind string, title string, year int, season int, has_episode boolean, imdb_id string, tmdb_id long, anilist_id long, kitsu_id long, mal_id long")
    got = {r.work: r for r in enrich.resolve(works, tables["search"], tables["bridge"], tables["find"], tables["external"]).collect()}
    assert (got["a"].anilist_id, got["a"].mal_id, got["a"].kitsu_id, got["a"].ids_source) == (11, 12, 14, "anilist+kitsu")
    assert (got["b"].kitsu_id, got["b"].ids_source) == (15, "kitsu")
    assert (got["c"].tmdb_id, got["c"].imdb_id, got["c"].ids_source) == (21, "tt21", "tmdb")
    assert (got["d"].tmdb_id, got["d"].imdb_id) == (22, "tt5")
    assert all("api_key=" + "k" * 32 in url for url, _, _ in answers.asked if url.startswith(catalogues.TMDB))
    assert len({(u, str(b)) for u, b, _ in answers.asked}) == len(answers.asked)  # each question once


def test_key_and_no_key():
    answers = Answers()
    assert catalogues.Catalogues(ask=answers).search_tmdb("movie", "blue mountain", None) == [] and not answers.asked
    token = catalogues.Catalogues(tmdb_key="eyJ" + "x" * 60, ask=answers)
    assert token.search_tmdb("movie", "blue mountain", None) and "api_key" not in answers.asked[0][0] and answers.asked[0][2]["Authorization"].startswith("Bearer eyJ")
    assert token.check_key() is True and catalogues.Catalogues(ask=answers).check_key() is None
    assert catalogues.Catalogues.from_env({"TMDB_API_KEY": " k ", "TMDB_RPS": "7"}).tmdb.limiter.rate == 7


def test_a_service_that_refuses_falls_silent():
    asked = []

    def refuse(url, **_):
        asked.append(url)
        raise Transient("429", 1.0)

    service = catalogues.Service(RateLimiter(1000, patience=3, sleep=lambda _: None), refuse)
    assert service.get("u", lambda a: a, "none") == "none" and service.silent
    n = len(asked)
    assert service.get("v", lambda a: a, "none") == "none" and len(asked) == n == 3


def test_one_bad_answer_ends_nothing():
    service = catalogues.Service(RateLimiter(1000), lambda url, **_: {"broken": url})
    assert service.get("u", lambda a: a["missing"], []) == [] and service.get("u", lambda a: a["broken"], []) == "u"
    with pytest.raises(Transient):
        catalogues.anilist_rows({"errors": [{"message": "Too Many Requests."}]})
    assert catalogues.mapped_kitsu_id({"data": [{}], "included": [{"type": "anime", "id": "3"}]}) == 3
