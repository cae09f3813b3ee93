"""Public tokenizers with caches of words.

Both byte-level vocabularies cut a text into words by the same pattern before merging, and merge each word by itself. So a text of Latin letters is cut
by that pattern here, and equal words are encoded once; the ids are exactly those of the whole text. The pattern always starts a new word at a single space that a visible
character follows: other texts are cut there, and pieces with characters outside the Latin blocks go to the library uncut.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from operator import attrgetter

import numpy as np

_CUT = re.compile(r" (?=[!-~¡-ᙿ])")
#: The pattern of both vocabularies for texts of ASCII and Latin letters (fixed values; the ranges are the letters of these blocks).
_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zªµºÀ-ÖØ-öø-ɏ]+| ?[0-9²³¹¼-¾]+| ?[^\sA-Za-zªµºÀ-ÖØ-öø-ɏ0-9²³¹¼-¾]+|\s+(?!\S)|\s+")
_LATIN = re.compile(r"[\t\n\r -~¡-ɏ]*\Z")
#: Bounds of the caches: entries of the newer half (the older half has as many), and characters of what is kept.
PIECES, WORDS, LENGTH = 20_000, 250_000, 48


class _Cache(dict):
    """Makes what is missing. When full, what is there becomes the older half, from which used entries come back."""

    def __init__(self, make, bound: int):
        super().__init__()
        self._make, self._bound, self._older = make, bound, {}

    def __missing__(self, key: str) -> bytes:
        made = self._older.get(key)
        if made is None:
            made = self._make(key)
        if len(key) <= LENGTH:
            if len(self) >= self._bound:
                self._older = dict(self)
                self.clear()
            self[key] = made
        return made


class PieceEncoder:
    """``encode`` gives the ids of a text as uint32. word: the library's ids of one word, in order; text: of any string; whole: strings that make the library treat a whole text otherwise."""

    def __init__(self, word, text, whole: tuple[str, ...] = ()):
        self._text, self._whole = text, whole
        self._words = _Cache(lambda x: array("I", word(x)).tobytes(), WORDS)
        self._pieces = _Cache(lambda x: array("I", text(x)).tobytes(), PIECES)

    def _piece(self, x: str) -> bytes:
        return b"".join(map(self._words.__getitem__, _WORDS.findall(x))) if _LATIN.match(x) else self._pieces[x]

    def _cut(self, text: str) -> bytes:
        head, *rest = _CUT.split(text)
        return self._piece(head) + b"".join(self._piece(" " + x) for x in rest)

    def encode(self, text: str) -> np.ndarray:
        if any(x in text for x in self._whole):
            return np.array(self._text(text), np.uint32)
        return np.frombuffer(self._piece(text) if _LATIN.match(text) else self._cut(text), np.uint32)


def _byte_letters() -> list[str]:
    """How byte-level vocabularies write each byte: visible ones as they are, the others as the characters from 256 on."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return [chr(b) if b in shown else chr(256 + hidden.index(b)) for b in range(256)]


_held: dict[tuple[str, str], object] = {}


def _one_a_process(make):
    """Keeps what ``make`` gives for the last argument, for all tasks of a process; what any other maker gave goes, so that a process holds one vocabulary and its caches."""

    def get(path: str):
        key = (make.__name__, path)
        if key not in _held:
            _held.clear()
            _held[key] = make(path)
        return _held[key]

    get.__doc__, get.cache_clear = make.__doc__, _held.clear
    return get


@_one_a_process
def hf_encoder(path: str) -> PieceEncoder:
    """For a byte-level vocabulary file of the tokenizers library; texts with the string of an added token go to it whole, since it takes these out first. One a process, for all its tasks: its caches are bounded and stay warm."""
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path)
    added = tuple(x.content for x in t.get_added_tokens_decoder().values())
    merge, letters, number = t.model.tokenize, dict(enumerate(_byte_letters())), attrgetter("id")

    def word(x: str) -> Iterator[int]:
        if x.isascii() and x.isprintable():  # all but the space are written as they are
            written = x.replace(" ", "Ġ")
        else:
            written = x.encode().decode("latin-1").translate(letters)
        return map(number, merge(written))

    return PieceEncoder(word, lambda x: t.encode(x, add_special_tokens=False).ids, added)


@_one_a_process
def rank_encoder(path: str) -> tuple[PieceEncoder, np.ndarray]:
    """For a tiktoken rank file; also which ids are no whole characters by themselves (byte fallback). One a process."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    t = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    part = np.zeros(max(ranks.values()) + 1, bool)
    for token, rank in ranks.items():
        try:
            token.decode()
        except UnicodeDecodeError:
            part[rank] = True
    return PieceEncoder(t.encode_ordinary, t.encode_ordinary), part


def single_threaded() -> None:
    """A task has one core."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    os.environ.setdefault("RAYON_NUM_THREADS", "1")
