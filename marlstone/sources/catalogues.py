"""Online catalogues as tables: what AniList, Kitsu and TMDB answer about some works becomes the rows that ``operators.enrich.resolve`` joins and scores.

A service is only asked for candidates; which of them fits is decided in Spark, as with a catalogue table that is there already. The works are those of a run's quota, so all answers fit the driver.
"""

from __future__ import annotations

import logging
import os
from collections.abc import Callable, Iterable, Mapping
from urllib.parse import quote, urlencode

from pyspark.sql import DataFrame, SparkSession

from ..functions.release import search_variants
from .resolver import RateLimited, RateLimiter, Transient, fetch_json, once, ordered_map, with_retry

log = logging.getLogger(__name__)

#: Addresses of the public services (fixed values).
ANILIST, KITSU, TMDB = "https://graphql.anilist.co", "https://kitsu.io/api/edge", "https://api.themoviedb.org/3"
_ANILIST_QUERY = "query ($title: String) { Page(perPage: 10) { media(search: $title, type: ANIME, sort: SEARCH_MATCH) { id idMal format seasonYear title { romaji english native userPreferred } synonyms } } }"
_SITES = ("anilist/anime", "myanimelist/anime")
SCHEMAS = {
    "search": "source string, kind string, work_id long, title string, alt_titles array<string>, year int, popularity double, rank int, mal_id long",
    "bridge": "site string, external_id long, kitsu_id long",
    "find": "imdb_id string, kind string, tmdb_id long",
    "external": "kind string, tmdb_id long, imdb_id string",
}


def _year(date: str | None) -> int | None:
    return int(date[:4]) if date and date[:4].isdigit() else None


def _titles(*given: str | None) -> tuple[str | None, list[str]]:
    """The first title there is, and the others once each."""
    there = list(dict.fromkeys(t for t in given if t))
    return (there[0], there[1:]) if there else (None, [])


# --- answers to rows ----------------------------------------------------------------------------------------------------------


def anilist_rows(answer: Mapping) -> list[tuple]:
    """Rows of ``search``; a refusal inside an answer is one like any other."""
    media = ((answer.get("data") or {}).get("Page") or {}).get("media")
    if media is None:
        said = "; ".join(e.get("message", "") for e in answer.get("errors") or ()) or "no results"
        raise Transient(said, 60.0) if "too many" in said.lower() or "rate limit" in said.lower() else RuntimeError(f"AniList: {said}")
    rows = []
    for rank, m in enumerate(x for x in media if x.get("format") != "MUSIC"):
        names = m.get("title") or {}
        title, others = _titles(names.get("romaji"), names.get("english"), names.get("native"), names.get("userPreferred"), *(m.get("synonyms") or ()))
        rows.append(("anilist", "anime", m["id"], title, others, m.get("seasonYear"), 0.0, rank, m.get("idMal")))
    return rows


def kitsu_rows(answer: Mapping) -> list[tuple]:
    rows = []
    for rank, item in enumerate(answer.get("data") or ()):
        a = item.get("attributes") or {}
        if a.get("subtype") != "music":
            title, others = _titles(a.get("canonicalTitle"), *(a.get("titles") or {}).values(), *(a.get("abbreviatedTitles") or ()))
            rows.append(("kitsu", "anime", int(item["id"]), title, others, _year(a.get("startDate")), 0.0, rank, None))
    return rows


def tmdb_rows(kind: str, answer: Mapping) -> list[tuple]:
    keys = ("title", "original_title", "release_date") if kind == "movie" else ("name", "original_name", "first_air_date")
    rows = []
    for rank, r in enumerate(answer.get("results") or ()):
        title, others = _titles(r.get(keys[0]), r.get(keys[1]))
        rows.append(("tmdb", kind, r["id"], title, others, _year(r.get(keys[2])), float(r.get("popularity") or 0), rank, None))
    return rows


def mapping_rows(kitsu_id: int, answer: Mapping) -> list[tuple]:
    """Rows of ``bridge``: the ids that other sites have for a Kitsu entry."""
    found = [(a.get("externalSite"), str(a.get("externalId") or "")) for a in ((x.get("attributes") or {}) for x in answer.get("data") or ())]
    return [(site, int(ident), kitsu_id) for site, ident in found if site in _SITES and ident.isdigit()]


def mapped_kitsu_id(answer: Mapping) -> int | None:
    """The Kitsu entry that a search among mappings leads to."""
    for mapping in (answer.get("data") or ())[:1]:
        item = ((mapping.get("relationships") or {}).get("item") or {}).get("data") or {}
        if item.get("id") and item.get("type", "anime") == "anime":
            return int(item["id"])
    return next((int(x["id"]) for x in answer.get("included") or () if x.get("type") == "anime"), None)


# --- questions ----------------------------------------------------------------------------------------------------------------


class Service:
    """One service's questions: limited in rate, asked again after transient errors, each asked once. ``silent`` when it keeps refusing: then nothing more is asked of it."""

    def __init__(self, limiter: RateLimiter, ask: Callable[..., object] = fetch_json, *, tries: int = 4):
        self.limiter, self.silent = limiter, False
        self._ask, self._tries, self._bodies = ask, tries, {}
        self._once = once(self._send)

    def _send(self, key: str) -> object:
        url, options = self._bodies[key]

        def go() -> object:
            self.limiter.acquire()
            try:
                answer = self._ask(url, **options)
            except Transient as e:
                self.limiter.refused(e.retry_after)
                raise
            self.limiter.accepted()
            return answer

        return with_retry(go, tries=self._tries, sleep=lambda _: None)  # the limiter waits

    def get(self, url: str, read: Callable[[Mapping], object], default: object, **options) -> object:
        """What ``read`` makes of the answer; ``default`` if there is none. One failing question doesn't end the others."""
        if self.silent:
            return default
        key = f"{url} {options.get('body')}"
        self._bodies[key] = (url, options)
        try:
            return read(self._once(key))
        except RateLimited:
            self.silent = True
        except Exception as e:  # noqa: BLE001
            log.warning("%s: %s", url.split("?")[0], e)
        return default


class Catalogues:
    """The clients of a run, made from settings; tmdb_key None leaves TMDB out. A key longer than 40 letters, or a JSON web token, is sent as a header."""

    def __init__(self, *, tmdb_key: str | None = None, anilist_per_minute: int = 20, kitsu_per_minute: int = 90, tmdb_per_second: int = 20, ask: Callable[..., object] = fetch_json, sleep: Callable[[float], None] | None = None):
        waits = {"sleep": sleep} if sleep else {}
        self.anilist = Service(RateLimiter(anilist_per_minute, floor=5, **waits), ask)
        self.kitsu = Service(RateLimiter(kitsu_per_minute, floor=15, **waits), ask)
        self.key = (tmdb_key or "").strip()
        self.tmdb = Service(RateLimiter(tmdb_per_second, window=1.0, **waits), ask) if self.key else None

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Catalogues:
        env = os.environ if env is None else env
        number = lambda name, default: int(env.get(name) or default)
        return cls(tmdb_key=env.get("TMDB_API_KEY"), anilist_per_minute=number("ANILIST_RPM", 20), kitsu_per_minute=number("KITSU_RPM", 90), tmdb_per_second=number("TMDB_RPS", 20))

    def _tmdb(self, path: str, read: Callable, default: object, **query) -> object:
        if self.tmdb is None:
            return default
        token = self.key.startswith("eyJ") or len(self.key) > 40
        given = {k: v for k, v in query.items() if v is not None} | ({} if token else {"api_key": self.key})
        return self.tmdb.get(f"{TMDB}{path}?{urlencode(given)}", read, default, headers={"Authorization": f"Bearer {self.key}"} if token else {})

    def check_key(self) -> bool | None:
        """Whether TMDB takes the key; None without one."""
        return None if self.tmdb is None else bool(self._tmdb("/authentication", lambda a: a.get("success", True), False))

    # what each service knows about a title or an id

    def search_anilist(self, title: str) -> list[tuple]:
        return self.anilist.get(ANILIST, anilist_rows, [], body={"query": _ANILIST_QUERY, "variables": {"title": title}})

    def search_kitsu(self, title: str) -> list[tuple]:
        return self.kitsu.get(f"{KITSU}/anime?filter[text]={quote(title)}&page[limit]=10&fields[anime]=canonicalTitle,titles,abbreviatedTitles,startDate,subtype", kitsu_rows, [], headers={"Accept": "application/vnd.api+json"})

    def search_tmdb(self, kind: str, title: str, year: int | None) -> list[tuple]:
        by_year = {"primary_release_year" if kind == "movie" else "first_air_date_year": year}
        return self._tmdb(f"/search/{kind}", lambda a: tmdb_rows(kind, a), [], query=title, include_adult="false", **by_year)

    def bridge_from(self, site: str, ident: int) -> list[tuple]:
        """Rows of ``bridge`` of the entry that another site's id leads to."""
        found = self.kitsu.get(f"{KITSU}/mappings?filter[externalSite]={quote(site)}&filter[externalId]={ident}&include=item&fields[anime]=canonicalTitle", mapped_kitsu_id, None)
        return [(site, ident, found), *(r for r in self.bridge_of(found) if r[:2] != (site, ident))] if found else []

    def bridge_of(self, kitsu_id: int) -> list[tuple]:
        return self.kitsu.get(f"{KITSU}/anime/{kitsu_id}/mappings?page[limit]=20", lambda a: mapping_rows(kitsu_id, a), [])

    def find(self, imdb_id: str) -> list[tuple]:
        read = lambda a: [(imdb_id, kind, a[f"{kind}_results"][0]["id"]) for kind in ("movie", "tv") if a.get(f"{kind}_results")]
        return self._tmdb(f"/find/{imdb_id}", read, [], external_source="imdb_id") if imdb_id.startswith("tt") and imdb_id[2:].isdigit() else []

    def external(self, kind: str, tmdb_id: int) -> list[tuple]:
        return self._tmdb(f"/{kind}/{tmdb_id}/external_ids", lambda a: [(kind, tmdb_id, a["imdb_id"])] if a.get("imdb_id") else [], [])

    def about(self, work: Mapping) -> dict[str, list[tuple]]:
        """All rows that the services have about one work (kind, title, year, season, has_episode, ids): exact ways first, and titles only where an id is missing."""
        out: dict[str, list[tuple]] = {name: [] for name in SCHEMAS}
        anime, season, year = work["kind"] == "anime", work.get("season"), work.get("year")
        own = "movie" if work["kind"] == "movie" else "tv"
        names = search_variants(work["title"], season, anime)
        if work.get("imdb_id"):
            out["find"] += self.find(work["imdb_id"])
        if anime:
            for site, ident in zip(_SITES, (work.get("anilist_id"), work.get("mal_id")), strict=True):
                out["bridge"] += self.bridge_from(site, ident) if ident else []
            if work.get("kitsu_id"):
                out["bridge"] += self.bridge_of(work["kitsu_id"])
            known = {site for site, _, _ in out["bridge"]}
            if not work.get("anilist_id") and _SITES[0] not in known:
                for name in search_variants(work["title"], season, anime, only_season=(season or 0) > 1):
                    rows = self.search_anilist(name)
                    out["search"] += rows
                    out["bridge"] += [b for r in rows[:1] for b in self.bridge_from(_SITES[0], r[2])]
                    if rows:
                        break
            if not work.get("kitsu_id") and not out["bridge"]:
                out["search"] += next((rows for name in names if (rows := self.search_kitsu(name))), [])
        if not work.get("tmdb_id") and not out["find"]:
            either = not work.get("has_episode") and (anime or work.get("type_guessed"))
            for kind in (own, *(["movie" if own == "tv" else "tv"] if either else [])):
                rows = next((rows for y in dict.fromkeys((year, None)) for name in names if (rows := self.search_tmdb(kind, name, y))), [])
                out["search"] += rows
                if rows:
                    break
        if not work.get("imdb_id"):
            ids = {(own, work["tmdb_id"])} if work.get("tmdb_id") else {(r[1], r[2]) for r in out["search"] if r[0] == "tmdb" and r[7] < 3}
            out["external"] += [row for kind, ident in sorted(ids) for row in self.external(kind, ident)]
        return out

    def tables(self, spark: SparkSession, works: Iterable[Mapping], *, workers: int = 4) -> dict[str, DataFrame]:
        """The four catalogue tables about ``works``, a quota's number of them."""
        rows: dict[str, dict[tuple, None]] = {name: {} for name in SCHEMAS}
        for found in ordered_map(works, workers, self.about):
            for name, part in found.items():
                rows[name].update((tuple(tuple(x) if isinstance(x, list) else x for x in r), None) for r in part)
        return {name: spark.createDataFrame([tuple(list(x) if isinstance(x, tuple) else x for x in r) for r in rows[name]], schema) for name, schema in SCHEMAS.items()}
