"""Folding, search keys and title similarity as native columns."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F


def _accents() -> tuple[str, str]:
    """Latin letters with marks, and the letters that canonical decomposition leaves of them."""
    marked, plain = [], []
    for point in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        c = chr(point)
        base = "".join(x for x in unicodedata.normalize("NFD", c) if not "̀" <= x <= "ͯ")
        if base != c and len(base) == 1:
            marked.append(c)
            plain.append(base)
    return "".join(marked), "".join(plain)


_MARKED, _PLAIN = _accents()
#: Words that a search key leaves out (fixed values).
ARTICLES = ("the", "a", "an", "el", "la", "los", "las", "un", "una", "le", "les", "der", "die", "das")


def unaccent(c: Column) -> Column:
    """``c`` without diacritics, composed or not; other scripts stay."""
    return F.translate(F.regexp_replace(c, "[̀-ͯ]", ""), _MARKED, _PLAIN)


def fold(c: Column) -> Column:
    """Lower case, no accents, everything but a-z and 0-9 one blank; null becomes empty."""
    return F.trim(F.regexp_replace(unaccent(F.lower(F.coalesce(c, F.lit("")))), "[^a-z0-9]+", " "))


def has_phrase(folded: Column, phrases: list[str]) -> Column:
    """Whether a folded text has one of the (already folded) phrases at word boundaries."""
    padded, found = F.concat(F.lit(" "), folded, F.lit(" ")), F.lit(False)
    for p in phrases:
        if p:
            found = found | padded.contains(f" {p} ")
    return found


def search_key(c: Column) -> Column:
    """Key under which equal titles meet: fold, & is and, kana and CJK stay, articles go."""
    t = F.regexp_replace(unaccent(F.lower(F.coalesce(c, F.lit("")))), "&", " and ")
    t = F.regexp_replace(t, "[^a-z0-9぀-ヿ㐀-鿿]+", " ")
    t = F.regexp_replace(t, f"(?<![a-z0-9_])(?:{'|'.join(ARTICLES)})(?![a-z0-9_])", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def bigrams(key: Column) -> Column:
    return F.when(F.length(key) > 1, F.transform(F.sequence(F.lit(1), F.length(key) - 1), lambda i: F.substring(key, i, F.lit(2)))).otherwise(F.array().cast("array<string>"))


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once, however often the body mentions it."""
    return F.element_at(F.transform(F.array(value), lambda v: body(v)), 1)


def key_dice(a: Column, b: Column) -> Column:
    """Sørensen-Dice over the bigram multisets of two search keys."""

    def of(v: Column) -> Column:
        x, y = v["x"], v["y"]
        common = F.aggregate(F.array_distinct(F.array_intersect(x, y)), F.lit(0), lambda n, g: n + F.least(F.size(F.filter(x, lambda w: w == g)), F.size(F.filter(y, lambda w: w == g))))
        total = F.size(x) + F.size(y)
        return F.when((v["a"] == "") | (v["b"] == ""), 0.0).when(v["a"] == v["b"], 1.0).when(total == 0, 0.0).otherwise(2.0 * common / total)

    return _let(F.struct(a.alias("a"), b.alias("b")), lambda k: _let(F.struct(k["a"].alias("a"), k["b"].alias("b"), bigrams(k["a"]).alias("x"), bigrams(k["b"]).alias("y")), of))


def _tokens(key: Column) -> Column:
    return F.array_distinct(F.filter(F.split(key, " "), lambda t: t != ""))


def key_jaccard(a: Column, b: Column) -> Column:
    x, y = _tokens(a), _tokens(b)
    return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))


def key_similarity(a: Column, b: Column) -> Column:
    """The larger of Dice and Jaccard; where one key contains the other, at least the ratio of their lengths plus 0.15; at most 1."""

    def of(v: Column) -> Column:
        x, y = v["a"], v["b"]
        score = F.greatest(key_dice(x, y), key_jaccard(x, y))
        ratio = F.least(F.length(x), F.length(y)) / F.greatest(F.length(x), F.length(y)) + 0.15
        inside = (x != y) & (x.contains(y) | y.contains(x))
        return F.when((x == "") | (y == ""), 0.0).otherwise(F.least(F.lit(1.0), F.greatest(score, F.when(inside, ratio).otherwise(0.0))))

    return _let(F.struct(a.alias("a"), b.alias("b")), of)


def dice(a: Column, b: Column) -> Column:
    return key_dice(search_key(a), search_key(b))


def token_jaccard(a: Column, b: Column) -> Column:
    return key_jaccard(search_key(a), search_key(b))


def similarity(a: Column, b: Column) -> Column:
    return key_similarity(search_key(a), search_key(b))


def best_similarity(query: Column, titles: Column) -> Column:
    """The largest similarity to any of an array of titles; 0 without one."""

    def of(key: Column) -> Column:
        scores = F.transform(F.filter(titles, lambda t: t.isNotNull() & (t != "")), lambda t: key_similarity(key, search_key(t)))
        return F.coalesce(F.array_max(scores), F.lit(0.0))

    return _let(search_key(query), of)


def has_season_marker(c: Column) -> Column:
    return F.coalesce(c, F.lit("")).rlike(r"(?i)(?<![a-z0-9_])(?:season|temporada|saison|staffel)(?![a-z0-9_])|[0-9](?:st|nd|rd|th)\s+season")


def adjusted_score(base: Column, query: Column, titles: Column, year: Column, item_year: Column, *, window: int = 3, penalty: float = 0.15, bonus: float = 0.1) -> Column:
    """``base`` with what the similarity can't see: a query of 7 or more characters that is a word prefix (or the other way) counts 0.78 at least; a season in
    the query but in no title costs 0.22; a year within 1 adds ``bonus``, one beyond ``window`` costs ``penalty``."""
    q = search_key(query)
    keys = F.transform(F.filter(titles, lambda t: t.isNotNull() & (t != "")), lambda t: search_key(t))
    prefixed = _let(q, lambda v: F.exists(keys, lambda k: (k != "") & (k != v) & (k.startswith(F.concat(v, F.lit(" "))) | v.startswith(F.concat(k, F.lit(" "))))))
    score = F.when((F.length(q) >= 7) & prefixed, F.greatest(base, F.lit(0.78))).otherwise(base)
    named = F.exists(F.filter(titles, lambda t: t.isNotNull()), lambda t: has_season_marker(t))
    score = score - F.when(has_season_marker(query) & ~named, 0.22).otherwise(0.0)
    apart = F.abs(item_year - year)
    known = (F.coalesce(year, F.lit(0)) != 0) & (F.coalesce(item_year, F.lit(0)) != 0)
    return score + F.when(known & (apart <= 1), bonus).when(known & (apart > window), -penalty).otherwise(0.0)


def ordinal(n: Column) -> Column:
    last, two = n % 10, n % 100
    end = F.when((two >= 11) & (two <= 13), "th").when(last == 1, "st").when(last == 2, "nd").when(last == 3, "rd").otherwise("th")
    return F.concat(n.cast("string"), end)
