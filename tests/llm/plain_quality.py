"""The quality verdict once more, without the operator's code but its bands: whole texts by the rank tokenizer as it comes."""

import base64
import math
import re
import unicodedata
from collections import Counter
from functools import cache

import public_tokenizers
import tiktoken

from marlstone.llm import quality

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@cache
def tokenizer():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def whole_characters(token):
    try:
        tokenizer().decode_single_token_bytes(token).decode()
    except UnicodeDecodeError:
        return False
    return True


def measures(text):
    ids = tokenizer().encode_ordinary(text)
    n = len(ids)
    if not n:
        return 0, 0.0, 0.0, 0.0
    return n, len(text) / n, sum(not whole_characters(i) for i in ids) / n, -sum(c / n * math.log2(c / n) for c in Counter(ids).values())


def band_of(text, lang):
    if lang in quality.LANGUAGES:
        return quality.LANGUAGES[lang]
    names = Counter()
    for c in text:
        first = unicodedata.name(c, "").split(" ")[0].lower() if c.isalpha() else ""
        if first in ("latin", "greek", "cyrillic") or ord(c) >= 0x530:
            names[first if first in ("latin", "greek", "cyrillic") and ord(c) < 0x530 else "other"] += 1
    order = ("latin", "greek", "cyrillic", "other")
    return quality.SCRIPTS[max(order, key=lambda s: (names[s], -order.index(s))) if names else "other"]


def kept(text, lang):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    repeated = {j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    if len(words) < 50 or 100 * len(repeated) > 50 * len(words):
        return False
    n, chars, fallback, entropy = measures(text)
    band, x = band_of(text, lang), math.log2(n)
    points = band.entropy
    if x <= points[0][0]:
        floor = points[0][1]
    elif x >= points[-1][0]:
        floor = points[-1][1]
    else:
        (x0, y0), (x1, y1) = next(p for p in zip(points, points[1:], strict=False) if p[0][0] <= x <= p[1][0])
        floor = y0 + (y1 - y0) * (x - x0) / (x1 - x0)
    return band.chars_per_token[0] <= chars <= band.chars_per_token[1] and fallback <= band.most_fallback and entropy >= floor - 1e-12
