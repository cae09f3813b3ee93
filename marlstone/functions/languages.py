"""Language labels: free text and arrays to canonical labels, and classes for survivorship."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

#: Languages in the order of evaluation: label, two-letter code, three-letter codes, regions, names (fixed values). Tokens, codes and patterns are built from them.
TABLE = (
    ("latino", "", ["lat", "latam", "spa-la", "spa-lat"], ["es-419", "es-la", "es-mx", "es-ar", "es-cl", "es-co", "es-pe", "es-ve", "es-xl"], ["latino", "latina", "latam", "latin", "español-latino", "espanol-latino", "latin-american", "latin-spanish", "spanish-latino", "spanish-latin"]),
    ("spanish", "es", ["spa", "esp", "cast", "cas", "spa-es"], ["es-es"], ["spanish", "español", "espanol", "castellano", "castilian"]),
    ("english", "en", ["eng"], ["en-us", "en-gb"], ["english", "ingles", "inglés", "inglese", "anglais", "englisch"]),
    ("japanese", "ja", ["jpn", "jap", "jp"], ["ja-jp"], ["japanese", "japones", "japonés", "japonês", "nihongo", "giapponese", "japonais"]),
    ("french", "fr", ["fre", "fra", "vf", "vff", "vfq"], ["fr-fr", "fr-ca"], ["french", "frances", "francés", "français", "francais", "truefrench", "vff", "vfq", "vfi"]),
    ("german", "de", ["ger", "deu"], ["de-de"], ["german", "aleman", "alemán", "deutsch"]),
    ("italian", "it", ["ita"], ["it-it"], ["italian", "italiano"]),
    ("portuguese", "pt", ["por", "ptb", "por-br"], ["pt-br", "pt-pt"], ["portuguese", "portugues", "português", "brazilian", "brasileiro", "dublado", "legendado"]),
    ("russian", "ru", ["rus"], ["ru-ru"], ["russian", "ruso", "русский"]),
    ("korean", "ko", ["kor"], ["ko-kr"], ["korean", "coreano"]),
    ("chinese", "zh", ["chi", "zho", "chs", "cht"], ["zh-cn", "zh-tw", "zh-hk", "zh-hans", "zh-hant"], ["chinese", "chino", "mandarin", "mandarín", "cantonese", "cantones", "cantonés"]),
    ("hindi", "hi", ["hin"], [], ["hindi"]),
    ("arabic", "ar", ["ara"], [], ["arabic", "arabe", "árabe"]),
    ("catalan", "ca", ["cat"], [], ["catalan", "català", "catalán", "valencia", "valencià"]),
    ("basque", "eu", ["eus", "baq"], [], ["basque", "vasco", "euskera", "euskara"]),
    ("galician", "gl", ["glg"], [], ["galician", "gallego", "galego"]),
    ("turkish", "tr", ["tur"], [], ["turkish", "turco", "türkçe"]),
    ("polish", "pl", ["pol"], [], ["polish", "polaco", "polski"]),
    ("dutch", "nl", ["dut", "nld"], [], ["dutch", "holandes", "holandés", "nederlands", "neerlandés"]),
    ("swedish", "sv", ["swe"], [], ["swedish", "sueco", "svenska"]),
    ("danish", "da", ["dan"], [], ["danish", "danes", "danés", "dansk"]),
    ("norwegian", "no", ["nor"], [], ["norwegian", "noruego", "norsk"]),
    ("finnish", "fi", [], [], ["finnish", "finlandes", "finlandés", "suomi"]),
    ("thai", "th", ["tha"], [], ["thai", "tailandes", "tailandés"]),
    ("vietnamese", "vi", ["vie"], [], ["vietnamese", "vietnamita"]),
    ("indonesian", "id", ["ind"], [], ["indonesian", "indonesio", "bahasa"]),
    ("hebrew", "he", ["heb"], [], ["hebrew", "hebreo"]),
    ("greek", "el", ["gre", "ell"], [], ["greek", "griego"]),
    ("czech", "cs", ["cze", "ces"], [], ["czech", "checo"]),
    ("hungarian", "hu", ["hun"], [], ["hungarian", "hungaro", "húngaro", "magyar"]),
    ("romanian", "ro", ["rum", "ron"], [], ["romanian", "rumano"]),
    ("ukrainian", "uk", ["ukr"], [], ["ukrainian", "ucraniano"]),
    ("filipino", "tl", ["fil", "tgl"], [], ["filipino", "tagalog"]),
)
#: Three-letter codes that only count in lower case, as whole entries: as capitals they are words or ids of something else.
_ENTRY_ONLY = {"jp"}
SPANISH, ENGLISH = ("spanish", "latino"), ("english",)
LABELS = tuple(row[0] for row in TABLE)


class _Rules:
    """Index of whole entries, and for each language what matches in free text and as a code in capitals."""

    def __init__(self, table=TABLE):
        self.tokens: dict[str, str] = {}
        self.ordered: list[tuple[str, re.Pattern, re.Pattern | None]] = []
        self._all: list[str] = []
        for label, two, three, regions, names in table:
            codes, places, words = list(three), list(regions), list(names)
            for entry in [two, *codes, *words, *places]:
                for form in {entry, entry.replace("-", "_"), entry.replace("-", ""), entry.replace("-", " ")} if "-" in entry else {entry}:
                    if form:
                        self.tokens[form] = label
            self.tokens.setdefault(label, label)
            free = "|".join(re.escape(w).replace(r"\-", r"[ ._-]?(?:\(?)") for w in sorted(words, key=len, reverse=True))
            where = "|".join(re.escape(p).replace(r"\-", "[-_]") for p in places if "-" in p)
            word = re.compile(rf"(?<![a-z])(?:{free}{'|' + where if where else ''})(?![a-z])", re.IGNORECASE)
            self._all.append(f"(?i:{word.pattern})")
            caps = [re.escape(c.upper()).replace(r"\-", "[-_]") for c in sorted([*codes, *places], key=len, reverse=True) if c not in _ENTRY_ONLY]
            self.ordered.append((label, word, re.compile(rf"(?<![A-Za-z0-9])(?:{'|'.join(caps)})(?![A-Za-z0-9])") if caps else None))
            if caps:
                self._all.append(self.ordered[-1][2].pattern)
        self.any = re.compile("|".join(self._all))


RULES = _Rules()


def in_text(text: str, *, codes: bool = True, rules: _Rules = RULES) -> list[str]:
    """Languages named in free text. Rules go in order and take what they match, so that a variety isn't also counted as its language."""
    found, rest = set(), text or ""
    if not rules.any.search(rest):
        return []
    for label, words, caps in rules.ordered:
        for pattern in (words, caps if codes else None):
            if pattern is not None and pattern.search(rest):
                found.add(label)
                rest = pattern.sub(lambda m: " " * len(m[0]), rest)
    return sorted(found)


_EDGES = " \t\r\n\"'`[]{}().:;,-"
_JOINTS = re.compile(r"[/,|+&;]+|\s+y\s+|\s+and\s+")


def entry_labels(entry: object, rules: _Rules = RULES) -> list[str]:
    """Labels of one entry of an array: a known token, else its parts, else free text."""
    text = "" if entry is None else str(entry).strip().lower().strip(_EDGES)
    if not text:
        return []
    if text in rules.tokens:
        return [rules.tokens[text]]
    parts = [p.strip() for p in _JOINTS.split(text) if p.strip()]
    if len(parts) > 1:
        found = {label for p in parts for label in ([rules.tokens[p]] if p in rules.tokens else in_text(p, codes=False, rules=rules))}
        if found:
            return sorted(found)
    return in_text(text, codes=False, rules=rules)


def _entries(value: object) -> Sequence[object]:
    if value is None:
        return []
    if not isinstance(value, str):
        return list(value) if hasattr(value, "__iter__") else []
    text = value.strip()
    if text.startswith("["):
        try:
            read = json.loads(text)
            return read if isinstance(read, list) else []
        except ValueError:
            return text.strip("[]").split(",")
    if text.startswith("{"):
        return text.strip("{}").split(",")
    return re.split(r"[,;|]", text)


def labels_of(value: object, rules: _Rules = RULES) -> list[str]:
    """Sorted distinct labels of an array, or of its JSON, braces or delimited text; anything else has none."""
    return sorted({label for e in _entries(value) for label in entry_labels(e, rules)})


def _labels_of_batch(values: pd.Series) -> pd.Series:
    known: dict[object, list[str]] = {}
    out = []
    for v in values:
        key = v if v is None or isinstance(v, str) else tuple(v)
        if key not in known:
            known[key] = labels_of(v)
        out.append(known[key])
    return pd.Series(out, dtype=object)


def language_labels(c: Column) -> Column:
    """Canonical labels of a text or array column. Free text is consumed rule by rule, which columns can't express, so this is one Arrow function.

    It is marked nondeterministic, so that no filter on it is pushed below and evaluates it twice; give it a column of its own before using it more than once.
    """
    return F.pandas_udf(_labels_of_batch, ArrayType(StringType())).asNondeterministic()(c)


def token_label(c: Column, table=TABLE) -> Column:
    """The label of a whole entry, by a map literal: the native path where entries are known codes."""
    pairs = [x for token, label in sorted(_Rules(table).tokens.items()) for x in (F.lit(token), F.lit(label))]
    return F.create_map(*pairs)[F.lower(F.trim(c))]


def array_labels(c: Column) -> Column:
    """Sorted distinct labels of the entries of an array that are known tokens; native."""
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_distinct(F.filter(F.transform(F.coalesce(c, empty), lambda x: token_label(x)), lambda x: x.isNotNull())))


def same_labels(a: Column, b: Column) -> Column:
    """Element-wise equality; null is an empty array."""
    empty = F.array().cast("array<string>")
    return F.coalesce(a, empty) == F.coalesce(b, empty)


def union_sorted(a: Column, b: Column) -> Column:
    empty = F.array().cast("array<string>")
    return F.array_sort(F.array_union(F.coalesce(a, empty), F.coalesce(b, empty)))


def union_ordered(a: Column, b: Column) -> Column:
    """Set union in order of first appearance."""
    empty = F.array().cast("array<string>")
    return F.array_union(F.coalesce(a, empty), F.coalesce(b, empty))


def language_class(audio: Column, subtitles: Column) -> Column:
    """struct of spanish, english, other, unknown: other needs both arrays and neither language, unknown is the rest."""
    empty = F.array().cast("array<string>")
    a, s = F.coalesce(audio, empty), F.coalesce(subtitles, empty)
    has = lambda group: F.arrays_overlap(a, F.array(*map(F.lit, group))) | F.arrays_overlap(s, F.array(*map(F.lit, group)))
    es, en = F.coalesce(has(SPANISH), F.lit(False)), F.coalesce(has(ENGLISH), F.lit(False))
    other = ~es & ~en & (F.size(a) > 0) & (F.size(s) > 0)
    return F.struct(es.alias("spanish"), en.alias("english"), other.alias("other"), (~es & ~en & ~other).alias("unknown"))


#: Known release groups by the languages that they usually have: audio, subtitles, names (fixed values; a parameter of the parser).
GROUP_PROFILES: Sequence[tuple[tuple[str, ...], tuple[str, ...], Sequence[str]]] = (
    (("japanese",), ("english",), [
        "subsplease", "horriblesubs", "asw", "anime pahe", "animepahe", "dkb", "cleo", "cerberus", "reaktor", "kaizoku", "animekaizoku", "nc-raws", "lilith-raws", "coalgirls", "commie", "underwater", "fff",
        "damedesuyo", "doki", "chihiro", "gjm", "kaleido", "sallysubs", "mtbb", "sweetsub", "uccuss", "pog42", "neodesu", "nyanpasu", "hakata ramen", "edge", "yuri", "hi10", "thora", "ctr", "sxales", "baaro",
        "mysteria", "nep_blanc", "shimatta", "setsugen", "pantsu", "crow", "animeout", "anime4life", "anime-chap", "sam", "ani", "hianime", "hidive", "crunchyroll", "cr", "gst", "smol", "zza", "shirσ", "ssa",
        "nan0", "aergia", "okay-subs", "newbsubs", "bakedfish", "deanzel",
    ]),
    (("japanese", "english"), ("english",), ["judas", "ember", "ember encodes", "anime time", "animetime", "kametsu", "yameii", "golumpa", "animerg", "lostyears", "cbm", "toonshub", "trix", "arid", "exiled-destiny", "anime land", "anidl", "varyg"]),
    (("japanese",), ("english", "spanish", "latino"), ["erai-raws"]),
    (("japanese",), (), ["moozzi2", "beatrice-raws", "vcb-studio", "tsundere-raws", "ohys-raws", "leopard-raws", "anime-raws", "deadmau-raws", "seed-raws", "philosophy-raws", "kawaiika-raws", "raws-maji"]),
    (("japanese",), ("spanish",), [
        "puyasubs", "puya", "animeflv", "anime-underground", "au", "animeid", "nihonjin", "tanoshii", "hunter subs", "backbeard", "shinsen", "inari", "friki no fansub", "rakuen", "tenshi", "kuroneko", "anime yabai",
        "anime-yabai", "mct", "rakuen no fansub", "ñyuum", "eldoradosubs", "ataraxia", "sakura fansub", "fenixfansub", "akiba-kei", "nanikano", "nanikano fansub", "shin-sekai",
    ]),
    (("japanese",), ("latino",), ["animelatino", "jkanime", "latinoanime", "monoschinos", "animefenix", "animeyt", "animejl"]),
)
GROUPS: Mapping[str, tuple[tuple[str, ...], tuple[str, ...]]] = {name: (audio, subtitles) for audio, subtitles, names in GROUP_PROFILES for name in names}


def group_profile(name: str | None, groups: Mapping = GROUPS) -> tuple[str, tuple, tuple] | None:
    """(name, audio, subtitles) of a known group: the whole name, else its first word or what stands before a bracket."""
    key = re.sub(r"\s+", " ", re.sub(r"!+$", "", (name or "").strip().lower()))
    for k in (key, re.split(r"[\s(]", key)[0]):
        if k and k in groups:
            return (k, *groups[k])
    return None
