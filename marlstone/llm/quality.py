"""Quality rules from tokeniser fertility."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame

from .arrow_map import add_columns, positional
from .vocab import rank_encoder, single_threaded


@dataclass(frozen=True)
class Band:
    """What a language's texts keep to. entropy: its floor in bits, by the binary logarithm of the number of tokens; between the points it is linear."""

    chars_per_token: tuple[float, float]
    most_fallback: float
    entropy: tuple[tuple[float, float], ...]


def _floor(shift: float) -> tuple[tuple[float, float], ...]:
    return tuple((x, y + shift) for x, y in ((5.0, 3.6), (6.5, 5.0), (7.0, 5.4), (8.0, 5.72), (9.0, 6.0), (10.0, 6.2), (11.0, 6.4), (12.0, 6.55), (13.0, 6.65)))


#: Bands by the language of a row, set on the labelled rows of the small tables.
LANGUAGES: Mapping[str, Band] = {
    "en": Band((2.0, 6.5), 0.03, _floor(0.0)),
    "de": Band((2.0, 6.5), 0.05, _floor(-0.12)),
    "es": Band((1.85, 6.5), 0.05, _floor(-0.12)),
    "fr": Band((1.85, 6.5), 0.05, _floor(-0.12)),
}
#: For other languages by script. Latin is the union of the four languages; no labelled rows have another script, so those are set around samples of plain prose
#: (Russian, Greek, Chinese, Japanese, Korean, Arabic, Hindi, Thai), wide, since a vocabulary covers scripts unevenly.
SCRIPTS: Mapping[str, Band] = {
    "latin": Band((1.85, 6.5), 0.05, _floor(-0.12)),
    "greek": Band((1.0, 4.5), 0.25, _floor(-1.0)),
    "cyrillic": Band((1.2, 5.5), 0.20, _floor(-1.0)),
    "other": Band((0.4, 5.0), 0.90, _floor(-1.2)),
}
#: First code points of ranges and their scripts (fixed values).
_RANGES = ((0x0, ""), (0x41, "latin"), (0x5B, ""), (0x61, "latin"), (0x7B, ""), (0xC0, "latin"), (0x250, ""), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "other"))
_STARTS = np.array([a for a, _ in _RANGES])
_NAMES = ("latin", "greek", "cyrillic", "other")
_OF_RANGE = np.array([_NAMES.index(n) if n else len(_NAMES) for _, n in _RANGES])


def script(text: str) -> str:
    """The script with most letters; other if there is none."""
    points = np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")
    counts = np.bincount(_OF_RANGE[np.searchsorted(_STARTS, points, "right") - 1], minlength=len(_NAMES) + 1)[:-1]
    return _NAMES[int(counts.argmax())] if counts.any() else "other"


_SPACE, _INNER, _SYMBOL, _CHAR = range(4)
_CLASS = np.full(256, _CHAR, np.uint8)
_CLASS[0x80:0xC0] = _INNER
_CLASS[[0x20, *range(0x09, 0x0E)]] = _SPACE
_CLASS[list(b"#*$%&|<>")] = _SYMBOL


def repeated_words(words: list[bytes]) -> int:
    """Words inside 3-word windows that occur twice or more."""
    if len(words) < 4:
        return 0
    ids: dict[bytes, int] = {}
    x = np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words))
    n = len(ids)
    keys = (x[:-2] * n + x[1:-1]) * n + x[2:] if n < 2_000_000 else np.unique(np.stack([x[:-2], x[1:-1], x[2:]]), axis=1, return_inverse=True)[1].reshape(-1)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return 0
    twice = twice[np.concatenate([[True], twice[1:] != twice[:-1]])]
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    hit = twice[at] == keys
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : len(words) - 2 + i] |= hit
    return int(covered.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    data = text.encode("utf-8", "surrogatepass")
    words = data.split()
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=4)
    lines = data.split(b"\n")
    same = 0
    if len(lines) > 1:
        seen: set[bytes] = set()
        for line in lines:
            if line in seen:
                same += bool(line.split(None, 1))
            seen.add(line)
    return len(words), int(kinds[_SYMBOL] + kinds[_CHAR]), int(kinds[_SYMBOL]), same, repeated_words(words)


def fertility(ids: np.ndarray, part: np.ndarray, n_chars: int) -> tuple[float, float, float]:
    """Characters a token, share of tokens that are no whole characters, entropy of the tokens in bits."""
    n = len(ids)
    if not n:
        return 0.0, 0.0, 0.0
    counts = np.bincount(ids)
    counts = counts[counts > 0]
    return n_chars / n, float(part[ids].mean()), max(0.0, float(np.log2(n) - (counts * np.log2(counts)).sum() / n))


def in_band(band: Band, n_tokens: int, chars: float, fallback: float, entropy: float) -> bool:
    low, high = band.chars_per_token
    floor = np.interp(np.log2(max(1, n_tokens)), *zip(*band.entropy, strict=True))
    return bool(low <= chars <= high and fallback <= band.most_fallback and entropy >= floor)


RESULT = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, chars_per_token double, fallback_share double, token_entropy double"


def _judge(vocabulary: str, languages: Mapping[str, Band], scripts: Mapping[str, Band], min_words: int) -> Callable[[], Callable]:
    def start() -> Callable:
        single_threaded()
        encoder, part = rank_encoder(vocabulary)

        def row(text: str | None, lang: str | None) -> tuple:
            text = text or ""
            n, chars, symbols, same, repeated = base_counts(text)
            failed = n < min_words or 100 * repeated > 50 * n
            ids = encoder.encode(text)
            measured = fertility(ids, part, len(text))
            kept = not failed and in_band(languages.get(lang) or scripts[script(text)], len(ids), *measured)
            return n, chars, symbols, same, repeated, failed, kept, *measured

        return row

    return start


def rate_quality(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", languages: Mapping[str, Band] = LANGUAGES, scripts: Mapping[str, Band] = SCRIPTS, min_words: int = 50) -> DataFrame:
    """Base counts, fertility and verdict of every row.

    A text is kept if it has ``min_words`` words, no more than half of them in repeated 3-word windows, and its characters a token,
    byte-fallback share and token entropy under the public ``vocabulary`` (a rank file) lie in the band of its language, or of its main script where the language has none.

    One pass over the rows in the tasks of the scan, without a shuffle; a task holds one text's tokens and bounded caches.

    Defined cases: a null text is an empty one and fails; a null or unknown language goes by script; repeated rows are judged
    alike; an empty table gives an empty result; other columns are ignored.
    """
    return add_columns(docs.select(id_col, text_col, lang_col), [text_col, lang_col], RESULT, _judge(vocabulary, languages, scripts, min_words), keep=[id_col])


def keep_quality(docs: DataFrame, vocabulary: str, *, text_col: str = "text", lang_col: str = "lang", languages: Mapping[str, Band] = LANGUAGES, scripts: Mapping[str, Band] = SCRIPTS, min_words: int = 50) -> DataFrame:
    """The rows of ``docs`` that ``rate_quality`` keeps, with their columns."""
    judge = _judge(vocabulary, languages, scripts, min_words)

    def start() -> Callable:
        row = judge()
        return lambda text, lang: (True,) if row(text, lang)[6] else None

    safe, names = positional(docs)
    inputs = [f"c{names.index(text_col)}", f"c{names.index(lang_col)}"]
    return add_columns(safe, inputs, "kept boolean", start).drop("kept").toDF(*names)
