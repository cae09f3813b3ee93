"""Secret scans: fixed patterns, and a conditional random field for what they miss."""

from __future__ import annotations

import base64
import hashlib
import random
import re
from collections.abc import Callable, Iterator, Sequence
from functools import cache, lru_cache

import numpy as np
from pyspark.sql import DataFrame

from .arrow_map import add_columns
from .crf import CRF, train

#: Kinds of spans in the order of ties.
KINDS = ("assign", "access", "hex", "crf")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?((?-i:[A-Za-z0-9+/_.=-]+))""", re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]+")
_LONG_HEX = re.compile(rb"[0-9a-f]{32}")
_CUES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")


def base_spans(text: str, data: bytes) -> list[tuple[int, int, str]]:
    """(start, end, kind) of the pattern matches; ``data`` is the text in UTF-8, searched first for what a match must hold."""
    out = []
    if b"=" in data or b":" in data:
        low = data.lower()
        if any(c in low for c in _CUES):
            out += [(*m.span(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    if b"AKIA" in data:
        out += [(*m.span(), "access") for m in _ACCESS.finditer(text) if len(m[0]) >= 16]
    if _LONG_HEX.search(data):
        out += [(*m.span(), "hex") for m in _HEX.finditer(text) if len(m[0]) >= 32]
    return sorted(out, key=lambda s: (s[0], KINDS.index(s[2])))


def join_spans(spans: Sequence[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, b, kind in spans)


# --- tokens and features -------------------------------------------------------------------------------------------------------

#: A name and its value are two tokens; = stays with a long token only as padding at its end. A mark after a mark that begins no token begins none itself: said
#: first, so that a run of marks is read once.
_TOKEN = re.compile(r"(?<=[+/_.~-])[+/_.~-]|[A-Za-z0-9+/_.~-]{15,}[A-Za-z0-9]={1,2}(?![A-Za-z0-9+/_.=~\"'-])|[A-Za-z0-9+/_.~-]*[A-Za-z0-9]|[^\sA-Za-z0-9]|[A-Za-z0-9]")
_SPACE = re.compile(r"\s")
#: Words that announce a secret (fixed values).
_WORDS = ("password", "passwd", "pwd", "secret", "token", "apikey", "api_key", "api", "key", "access", "auth", "bearer", "credential", "private", "login", "client_secret")
#: Beginnings of issued keys (fixed values).
_STARTS = ("AKIA", "ghp_", "gho_", "sk-", "sk_", "xox", "eyJ", "AIza", "glpat-", "SG.")
_MARK = np.zeros(256, bool)
_MARK[list(b"0123456789=_/+@\\")] = True
_GAP = np.zeros(256, bool)
_GAP[[0x20, *range(0x09, 0x0E)]] = True
_LONG = 24
#: Characters of a text that are cut into tokens, and tokens that are scored, at a time; tokens that are remembered.
_PIECE, _BLOCK, _KNOWN = 1 << 18, 1 << 18, 1 << 17


def shape(token: str) -> str:
    out = []
    for c in token:
        kind = "9" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c
        if not out or out[-1] != kind:
            out.append(kind)
        if len(out) > 6:
            return "mixed"
    return "".join(out)


def _looks(token: str) -> list[str]:
    n = len(token)
    digits, upper, lower = sum(c.isdigit() for c in token), sum(c.isupper() for c in token), sum(c.islower() for c in token)
    distinct = len(set(token))
    f = [f"shape={shape(token)}", f"length={min(n, 64).bit_length()}.{n > 11}{n > 15}{n > 19}", f"classes={digits > 0}{upper > 0}{lower > 0}", f"spread={distinct > 6}{distinct > 9}{distinct > 14}"]
    f.append(f"digits={(4 * digits + n - 1) // n if n else 0}")
    if n >= 16 and all(c in "0123456789abcdef" for c in token):
        f.append("hex")
    f += [f"start={s}" for s in _STARTS if token.startswith(s)]
    if token.count(".") + token.count("/") + token.count("-") > 1 and n < 40:
        f.append("parts")
    return f


def _word(token: str) -> str:
    low = token.lower()
    if low in _WORDS:
        return f"word={low}"
    if any(w in low for w in _WORDS[:8]):
        return "word=near"
    if len(token) == 1 and not token.isalnum():
        return f"mark={token}"
    return "plain" if token.isalpha() else "number" if token.isdigit() else "other"


def _has_looks(own: str, token: str) -> bool:
    return own in ("other", "number", "word=near") or len(token) >= _LONG


def features(tokens: Sequence[str], marked: int) -> list[list[str]]:
    """For each token: its looks, its neighbours up to two away, and how many marked words the file has."""
    words = [_word(t) for t in tokens]
    file = f"file={min(marked, 64).bit_length()}"
    out = []
    for i, t in enumerate(tokens):
        near = [f"{d}:{words[i + d] if 0 <= i + d < len(words) else 'edge'}" for d in (-2, -1, 1, 2)]
        own = words[i]
        looks = _looks(t) if _has_looks(own, t) else []
        out.append([f"own={own}", *looks, *near, *([f"{near[0]}|{near[1]}"] if looks else []), f"{file}|{'looks' if looks else 'none'}"])
    return out


# --- training on invented lines ------------------------------------------------------------------------------------------------

#: The number of invented lines that the field is fitted on.
LINES = 1500


def _invented(rng: random.Random) -> list[tuple[str, bool]]:
    """A line as (text, is secret) parts: words around a secret, or around something that looks like one."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    def word() -> str:
        return "".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) + rng.choice(["", "", "", ",", "."])

    def some(alphabet: str, n: int) -> str:
        return "".join(rng.choice(alphabet) for _ in range(n))

    hexes, alnum = "0123456789abcdef", letters + letters.upper() + "0123456789"
    digits = "0123456789"
    secret = rng.choice(
        [
            lambda: some(hexes, rng.choice([16, 18, 24, 32, 40, 64])),
            lambda: some(alnum, rng.choice([16, 20, 24, 32, 40])),
            lambda: base64.b64encode(bytes(rng.randrange(256) for _ in range(rng.choice([15, 24, 30])))).decode(),
            lambda: "AKIA" + some(letters.upper() + digits, 16),
            lambda: rng.choice(["ghp_", "sk-", "xoxb-", "glpat-"]) + some(alnum, rng.choice([20, 36])),
            lambda: "eyJ" + some(alnum, 20) + "." + some(alnum, 24) + "." + some(alnum, 24),
            lambda: word().strip(",.").capitalize() + some(digits, 3) + rng.choice("_-+") + some(alnum, 6),
        ]
    )
    harmless = rng.choice(
        [
            lambda: f"{rng.randint(1950, 2030)}-{rng.randint(1, 12):02d}-{rng.randint(1, 28):02d}",
            lambda: f"+{rng.randint(1, 99)} {rng.randint(100, 999)} {rng.randint(1000, 9999)} {rng.randint(100, 999)}",
            lambda: f"+1-{rng.randint(200, 999)}-{rng.randint(200, 999)}-{rng.randint(1000, 9999)}",
            lambda: f"{word().strip(',.')}.{word().strip(',.')}{rng.randint(1, 99)}@{word().strip(',.')}.com",
            lambda: f"https://www.{word().strip(',.')}.org/{word().strip(',.')}/{rng.randint(1, 99999)}?page={rng.randint(1, 9)}",
            lambda: f"{rng.randint(1, 9)}.{rng.randint(0, 20)}.{rng.randint(0, 20)}",
            lambda: some(digits, rng.randint(1, 16)),
            lambda: " ".join(some(digits, 4) for _ in range(4)),
            lambda: f"{rng.randint(1, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}.{rng.randint(0, 255)}",
            lambda: f"{word().strip(',.')}_{word().strip(',.')}",
            lambda: f"/{word().strip(',.')}/{word().strip(',.')}.txt",
            lambda: some(letters, rng.randint(24, 40)),
            lambda: some(letters.upper(), rng.randint(4, 30)),
            lambda: f"{word().strip(',.')}-{word().strip(',.')}-{word().strip(',.')}",
            lambda: f"{rng.randint(1, 999)},{rng.randint(100, 999)}.{rng.randint(0, 99):02d}",
            lambda: f"{some(hexes, 2)}",
            lambda: word().strip(",.") + rng.choice(["***", "$$$", "!!", "%%%"]),
        ]
    )
    name = rng.choice(_WORDS)
    said = [(" ".join(word() for _ in range(rng.randint(1, 8))), False)]
    roll = rng.random()
    if roll < 0.3:
        quote = rng.choice(["", '"', "'"])
        said.append((rng.choice([name, name.upper(), "my " + name]) + rng.choice(["=", ": ", " = ", ":"]) + quote, False))
        said += [(secret(), True), (quote + rng.choice(["", ";", ","]), False)]
    elif roll < 0.45:
        said += [(name + rng.choice([" is", " ", " to", ""]), False), (" ", False), (secret(), True)]
    elif roll < 0.5:
        said += [(secret(), True)]
    elif roll < 0.65:
        said += [(rng.choice([name, word()]) + rng.choice([" ", ": "]), False), (harmless(), False)]
    elif roll < 0.9:
        said += [(harmless(), False), (" " + word() + " ", False), (harmless(), False)]
    said.append((" " + " ".join(word() for _ in range(rng.randint(1, 8))), False))
    return said


def _line(parts: list[tuple[str, bool]]) -> tuple[str, list[tuple[int, int]]]:
    text, spans = "", []
    for i, (part, is_secret) in enumerate(parts):
        if text and not text[-1].isspace() and text[-1] not in "=:\"'" and part and part[0] not in "\"';, ":
            text += " "
        if is_secret:
            spans.append((len(text), len(text) + len(part)))
        text += part
    return text, spans


def labelled(n: int, seed: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """Invented lines and where their secrets are; ``n`` bounds the sample that training sees."""
    rng = random.Random(seed)
    return [_line(_invented(rng)) for _ in range(n)]


def _tags(tokens: list[re.Match], spans: list[tuple[int, int]]) -> list[int]:
    out, before = [], None
    assert {a for a, _ in spans} <= {m.start() for m in tokens}, "a labelled span must start a token"
    for m in tokens:
        own = next((s for s in spans if s[0] <= m.start() < s[1]), None)
        out.append(0 if own is None else 2 if own == before else 1)
        before = own
    return out


@cache
def model(n: int = LINES, seed: int = 7) -> CRF:
    """The field, fitted on ``n`` invented lines; the same for the same arguments."""
    sentences, labels = [], []
    for text, spans in labelled(n, seed):
        tokens = list(_TOKEN.finditer(text))
        sentences.append(features([m[0] for m in tokens], len(_marked(text.encode()))))
        labels.append(_tags(tokens, spans))
    return train(sentences, labels)


# --- scanning ------------------------------------------------------------------------------------------------------------------


def _marked(data: bytes) -> np.ndarray:
    """(start, end) bytes of the words with a digit or a mark, or of unusual length: all that can look like a secret."""
    x = np.frombuffer(data, np.uint8)
    gap = _GAP[x]
    edges = np.flatnonzero(np.diff(gap, prepend=True, append=True))
    words = edges.reshape(-1, 2)
    if not len(words):
        return words
    marks = np.flatnonzero(_MARK[x])
    has = np.diff(np.searchsorted(marks, np.append(words[:, 0], len(x)))) > 0
    return words[has | (words[:, 1] - words[:, 0] >= _LONG)]


class _Kinds(dict):
    """The number of a token's class, with that of all classes added if it has looks; as many tokens are remembered as fit."""

    def __init__(self, classes: Sequence[str]):
        self.classes, self.at = len(classes), {c: i for i, c in enumerate(classes)}

    def __missing__(self, token: str) -> int:
        own = _word(token)
        kind = self.at.get(own, self.at["unseen"]) + self.classes * _has_looks(own, token)
        if len(token) <= 64:
            if len(self) >= _KNOWN:
                self.clear()
            self[token] = kind
        return kind


class _Tables:
    """The weights of a field by classes of tokens, so that the features of all tokens of a text are added up without naming them."""

    def __init__(self, field: CRF):
        marks = sorted({m for name in field.weights for m in re.findall("mark=.", name, re.DOTALL)})
        classes = ["edge", "plain", "number", "other", "word=near", *(f"word={w}" for w in _WORDS), *marks, "unseen"]  # a mark that training didn't see weighs nothing

        def rows(names: Sequence[str]) -> np.ndarray:
            return np.array([field.scores([n]) for n in names])

        self.kinds, self.n = _Kinds(classes), len(classes)
        files = [np.repeat(rows([f"file={b}|{x}" for x in ("none", "looks")]), self.n, axis=0) for b in range(8)]
        self.own = [np.tile(rows([f"own={c}" for c in classes]), (2, 1)) + file for file in files]
        self.near = [(2 + d, rows([f"{d}:{c}" for c in classes])) for d in (-2, -1, 1, 2)]
        self.pairs = np.array([rows([f"-2:{a}|-1:{b}" for b in classes]) for a in classes])
        self.looks = lru_cache(_KNOWN)(lambda token: field.scores(_looks(token)))


@lru_cache(4)
def _tables(field: CRF) -> _Tables:
    return _Tables(field)


def _pieces(text: str) -> Iterator[tuple[int, int]]:
    """(start, end) of pieces of ``text`` that end at white space, which no token holds."""
    a = 0
    while a < len(text):
        cut = _SPACE.search(text, a + _PIECE)
        b = cut.start() if cut else len(text)
        yield a, b
        a = b


def crf_spans(text: str, data: bytes, field: CRF) -> list[tuple[int, int]]:
    """Where the field sees secrets: the likeliest labels of all tokens of the whole text. Every token is scored; of those that are surely O
    (see ``CRF.margin``) no path needs to be searched."""
    tables, pieces = _tables(field), list(_pieces(text))
    kinds, looks = [np.zeros(0, np.int16)], [np.zeros((0, 3))]
    for a, b in pieces:
        tokens = _TOKEN.findall(text, a, b)
        kinds.append(np.fromiter(map(tables.kinds.__getitem__, tokens), np.int16, len(tokens)))
        seen = [tokens[i] for i in np.flatnonzero(kinds[-1] >= tables.n).tolist()]
        looks.append(np.array([tables.looks(t) if len(t) <= 64 else tables.looks.__wrapped__(t) for t in seen]).reshape(-1, 3))
    firsts, kind, rows = np.cumsum([len(k) for k in kinds]), np.concatenate(kinds), np.concatenate(looks)
    n, looked = len(kind), np.flatnonzero(kind >= tables.n)
    around = np.zeros(n + 4, np.int16)  # token i is at i + 2; before and after all are edges, class 0
    around[2:-2] = kind % tables.n
    own, places, scores = tables.own[min(len(_marked(data)), 64).bit_length()], [np.zeros(0, int)], [np.zeros((0, 3))]
    for a in range(0, n, _BLOCK):
        b = min(n, a + _BLOCK)
        block = own[kind[a:b]]
        for d, table in tables.near:
            block += table[around[a + d : b + d]]
        i, j = np.searchsorted(looked, (a, b))
        at = looked[i:j]
        block[at - a] += rows[i:j] + tables.pairs[around[at], around[at + 1]]
        unsure = np.flatnonzero((block[:, :1] - block[:, 1:] <= field.margin).any(axis=1))
        places.append(unsure + a)
        scores.append(block[unsure])
    spans: list[list[int]] = []
    for i, tag in field.decode_unsure(np.concatenate(places), np.concatenate(scores), n):
        if tag == 2 and spans and spans[-1][1] == i - 1:
            spans[-1][1] = i
        else:
            spans.append([i, i])
    ends, found = {i for s in spans for i in s}, {}
    for first, last, (a, b) in zip(firsts, firsts[1:], pieces, strict=False):
        if any(first <= i < last for i in ends):
            found |= {i: m.span() for i, m in enumerate(_TOKEN.finditer(text, a, b), int(first)) if i in ends}
    return [(found[i][0], found[j][1]) for i, j in spans]


def scan(text: str, field: CRF) -> tuple[list[tuple[int, int, str]], list[tuple[int, int, str]]]:
    """The pattern spans, and all spans: those plus what the field adds beside or beyond them."""
    data = text.encode("utf-8", "surrogatepass")
    base = base_spans(text, data)
    added = [(a, b, "crf") for a, b in crf_spans(text, data, field) if not any(x <= a and b <= y for x, y, _ in base)]
    return base, sorted([*base, *added], key=lambda s: (s[0], KINDS.index(s[2]))) if added else base


RESULT = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def find_secrets(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lines: int = LINES, seed: int = 7) -> DataFrame:
    """Secrets of every whole text: counts and digest of the pattern matches, and all spans in code points.

    The field is fitted by the driver on ``lines`` invented lines, a fixed bound, and sent to the tasks (some thousand weights).
    One pass over the rows in the tasks of the scan, without a shuffle.

    Defined cases: a null text is an empty one; no spans give an empty string and its digest; overlapping matches of different kinds all
    count; repeated rows are scanned alike; an empty table gives an empty result; other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model(lines, seed))

    def start() -> Callable:
        field = sent.value

        def row(text: str | None) -> tuple:
            base, spans = scan(text or "", field)
            counts = [sum(k == kind for _, _, k in base) for kind in KINDS[:3]]
            return *counts, hashlib.sha256(join_spans(base).encode()).hexdigest(), join_spans(spans)

        return row

    return add_columns(docs.select(id_col, text_col), [text_col], RESULT, start, keep=[id_col])
