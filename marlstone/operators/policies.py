"""Row policies as native predicates. A row goes only where its predicate is true; null keeps it."""

from __future__ import annotations

import datetime as dt
import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import fold, has_phrase

#: Policy words (parameters of the operator; short and neutral by intent). Hard words hold against exceptions.
KEYWORDS = ("porn", "porno", "xxx", "nsfw", "hentai", "erotic", "erotica", "hardcore", "only fans", "18+")
HARD = ("porn", "porno", "nsfw", "hentai", "onlyfans", "vixen")
ALLOWED = ("hardcore henry", "xxx return of xander cage", "xxx state of the union", "xxx 2002", "erotica 1994")
#: A hard word that is a word of a known film besides, and the phrases that show it.
DOUBTFUL, KNOWN = "vixen", ("vixen 1968", "russ meyer s vixen")


def word_pattern(words: Sequence[str]) -> str:
    """A case-insensitive pattern of the words between other than letters and digits; a blank is any or no separator."""
    each = [re.sub(r"(?:\\ |\s)+", "[ ._-]?", re.escape(w.lower())) for w in dict.fromkeys(words)]
    return rf"(?iu)(?<![\p{{L}}\p{{N}}])(?:{'|'.join(each)})(?![\p{{L}}\p{{N}}])"


def keyword_policy(title: Column, *, keywords: Sequence[str] = KEYWORDS, extra: Sequence[str] = (), hard: Sequence[str] = HARD, allowed: Sequence[str] = ALLOWED, doubtful: str = DOUBTFUL, known: Sequence[str] = KNOWN) -> Column:
    """Whether a title is against the policy: a keyword, and either a hard word (unless all of them are the doubtful one in a known phrase) or no allowed phrase.

    Accented letters are letters, so they don't end a word. Null and empty titles aren't against it.
    """
    t, folded = F.coalesce(title, F.lit("")), fold(title)
    hits = F.transform(F.regexp_extract_all(t, F.lit(f"({word_pattern(hard)})"), F.lit(1)), lambda w: F.lower(w))
    excused = F.forall(hits, lambda w: w == doubtful) & has_phrase(folded, [" ".join(re.sub("[^a-z0-9]+", " ", p.lower()).split()) for p in known])
    exact = F.when(F.size(hits) > 0, ~excused).otherwise(~has_phrase(folded, [" ".join(re.sub("[^a-z0-9]+", " ", p.lower()).split()) for p in allowed]))
    return t.rlike(word_pattern([*keywords, *hard, *extra])) & exact


def size_policy(kind: Column, size: Column, *, movie: int, series: int, anime: bool = True, zero: bool = False, parsed_kind: Column | None = None, parsed_confidence: Column | None = None, confidence: float = 0.8) -> Column:
    """Whether a row is too small for its kind. Unknown sizes (null, or 0 unless ``zero``) are kept; a row without kind goes by the parsed one if that is confident."""
    if parsed_kind is not None:
        guess = F.when(kind.isNull() & (parsed_confidence >= max(confidence, 0.8)), parsed_kind)
        kind = F.coalesce(kind, guess)
    least = F.when(kind == "movie", F.lit(movie)).when(kind.isin("series", *(["anime"] if anime else [])), F.lit(series))
    return (size < least) & (size.isNotNull() if zero else size > 0)


def stale_policy(popularity: Column, updated: Column, *, as_of: dt.datetime, days: int, include_null: bool = False) -> Column:
    """Whether a row was last seen more than ``days`` before ``as_of`` and nobody has it."""
    none = (popularity == 0) | popularity.isNull() if include_null else popularity == 0
    return none & (updated < F.lit(as_of - dt.timedelta(days=days)))


def recheck_due(checked: Column, attempts: Column, *, as_of: dt.datetime, days: int, most: int) -> Column:
    """Whether a lookup may be tried again: never checked or before the cutoff day, and attempts left (0: without end)."""
    cutoff = F.lit((as_of - dt.timedelta(days=days)).date()).cast("timestamp_ntz")
    due = checked.isNull() | (checked.cast("timestamp_ntz") < cutoff)
    return due & (attempts.isNull() | (attempts < most)) if most else due


def missing_number(c: Column) -> Column:
    return c.isNull() | (c == 0)


def missing_text(c: Column) -> Column:
    return c.isNull() | (c == "")


def valid_imdb(c: Column) -> Column:
    """The trimmed id if it is tt and digits, else null."""
    t = F.trim(c)
    return F.when(t.rlike(r"\Att[0-9]+\z"), t)


def needed_ids(kind: Column, ids: dict[str, Column], *, has_tmdb: bool = True, tmdb_for_anime: bool = True) -> Column:
    """Names of the ids that a row of its kind should have and hasn't."""
    lack = {n: missing_text(c) if n == "imdb_id" else missing_number(c) for n, c in ids.items()}

    def names(wanted: Sequence[str]) -> Column:
        return F.array_compact(F.array(*[F.when(lack[n], n) for n in wanted])) if wanted else F.array().cast("array<string>")

    film = ["tmdb_id", "imdb_id"] if has_tmdb else []
    anime = ["anilist_id", "kitsu_id", "mal_id", *(film if tmdb_for_anime else [])]
    return F.when(kind == "anime", names(anime)).otherwise(names(film))


def split_by(df: DataFrame, doomed: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, doomed) rows; where the predicate is null the row is kept."""
    sure = F.coalesce(doomed, F.lit(False))
    return df.where(~sure), df.where(sure)
