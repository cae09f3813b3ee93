"""License scans by patience alignment."""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Callable, Mapping
from pathlib import Path

from pyspark.sql import DataFrame

from .arrow_map import add_columns
from .decontaminate import words_of

#: Short notices by name (fixed values: standard license statements).
SHORT: Mapping[str, str] = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-header": "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
    "CC0-1.0": "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work under CC0 1.0 Universal.",
    "EPL-2.0": "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    "Unlicense": "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
}
_GNU = "This work is licensed under the GNU {}General Public License, version {}."
_GNU_HEADER = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation, either version {} of the License, or (at your option) any later version."
_GNU_NAMES = {"GPL-2.0": ("", "2"), "GPL-3.0": ("", "3"), "LGPL-2.1": ("Lesser ", "2.1"), "LGPL-3.0": ("Lesser ", "3"), "AGPL-3.0": ("Affero ", "3")}
_NO_ENDORSEMENT = "Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
#: What tells licenses apart that are worded alike: a notice that has such a word is found only where the word is.
DECIDING = frozenset("affero apache by cc cc0 eclipse general lesser mit mozilla mpl nc nd sa 0 1 2 3 4 5".split())


def _full_texts() -> dict[str, str]:
    """The full texts beside this module, by name; two are made from others."""
    texts = {f.stem: f.read_text("utf-8") for f in sorted(Path(__file__).with_name("license_texts").glob("*.txt"))}
    head, _, tail = texts["BSD-2-Clause"].partition("THIS SOFTWARE IS PROVIDED")
    texts["BSD-3-Clause"] = f"{head}3. {_NO_ENDORSEMENT}\n\nTHIS SOFTWARE IS PROVIDED{tail}"
    texts["AGPL-3.0"] = texts["GPL-3.0"].replace("GNU GENERAL", "GNU AFFERO GENERAL").replace("GNU General", "GNU Affero General")
    return {f"{name}-text": text for name, text in texts.items()}


#: Notices that differ from each other in a word or two, by family: of those whose windows overlap the one that fits best stands.
FAMILIES: Mapping[str, Mapping[str, str]] = {
    "cc": {f"CC-{x}-{v}": f"Licensed under CC {x} {v}." for x in ("BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND") for v in ("2.0", "2.5", "3.0", "4.0")},
    "gnu": {name: _GNU.format(*x) for name, x in _GNU_NAMES.items()},
    "gnu-header": {f"{name}-header": _GNU_HEADER.format(*x) for name, x in _GNU_NAMES.items()},
    "gnu-text": {name: text for name, text in _full_texts().items() if "GPL" in name},
    "bsd": {name: text for name, text in _full_texts().items() if "BSD" in name},
}
_FAMILY = {name: family for family, members in FAMILIES.items() for name in members}
NOTICES: Mapping[str, str] = {**SHORT, **_full_texts(), **{name: text for members in FAMILIES.values() for name, text in members.items()}}
#: Notices of at most so many words must have their deciding words; longer ones are told apart by the rest of their text.
DECIDED = 80


def _rising(pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest run of ``pairs`` (sorted by their first) whose seconds rise too, by patience sorting."""
    tops: list[int] = []
    pile_of: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        pile = bisect_left(tops, j)
        if pile == len(tops):
            tops.append(j)
            pile_of.append(k)
        else:
            tops[pile], pile_of[pile] = j, k
        back.append(pile_of[pile - 1] if pile else -1)
    out, k = [], pile_of[-1] if pile_of else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def align(a: list[bytes], b: list[bytes]) -> list[tuple[int, int]]:
    """Matching places of ``a`` and ``b``: equal ends, then words that are unique in both as anchors, then the gaps between them in the same way.

    A gap without unique common words falls back to its rarest common words, taken in order.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, i_end, j, j_end = todo.pop()
        while i < i_end and j < j_end and a[i] == b[j]:
            out.append((i, j))
            i, j = i + 1, j + 1
        while i < i_end and j < j_end and a[i_end - 1] == b[j_end - 1]:
            i_end, j_end = i_end - 1, j_end - 1
            out.append((i_end, j_end))
        if i == i_end or j == j_end:
            continue
        in_a, in_b = Counter(a[i:i_end]), Counter(b[j:j_end])
        common = in_a.keys() & in_b.keys()
        if not common:
            continue
        unique = {w for w in common if in_a[w] == 1 and in_b[w] == 1}
        if unique:
            at = {w: k for k, w in enumerate(b[j:j_end], j) if w in unique}
            anchors = _rising([(k, at[a[k]]) for k in range(i, i_end) if a[k] in unique])
        else:
            word = min(common, key=lambda w: (in_a[w] * in_b[w], w))
            anchors = list(zip((k for k in range(i, i_end) if a[k] == word), (k for k in range(j, j_end) if b[k] == word), strict=False))
        out += anchors
        for (x, y), (x_end, y_end) in zip([(i - 1, j - 1), *anchors], [*anchors, (i_end, j_end)], strict=True):
            if x + 1 < x_end and y + 1 < y_end:
                todo.append((x + 1, x_end, y + 1, y_end))
    return sorted(out)


class Scanner:
    """Finds the notices in a text that a window of it covers to ``coverage`` or more, deciding words included."""

    def __init__(self, notices: Mapping[str, str] = NOTICES, coverage: float = 0.8, stretch: float = 1.5):
        self.coverage, self.stretch = coverage, stretch
        self.notices = {name: words_of(text) for name, text in sorted(notices.items()) if words_of(text)}
        self._bags = {name: Counter(words) for name, words in self.notices.items()}
        self._deciding = {name: frozenset(w for w in words if w.decode() in DECIDING) if len(words) <= DECIDED else frozenset() for name, words in self.notices.items()}
        self._all = frozenset(w for words in self.notices.values() for w in words)

    def find(self, words: list[bytes]) -> list[tuple[str, float, int, int]]:
        """(name, coverage, first word, end) of each notice; a window is what lies between words of the notice that are no further apart than it can stretch.

        A window with fewer of the notice's words than the coverage takes can't be aligned to it and is left out; all others are aligned.
        """
        known = self._all.intersection(words)
        out = []
        if not known:
            return out
        places = [k for k, w in enumerate(words) if w in known]
        for name, notice in self.notices.items():
            bag, need = self._bags[name], self.coverage * len(notice)
            deciding = self._deciding[name]
            if not deciding <= known or sum(n for w, n in bag.items() if w in known) < need:
                continue
            best = None
            span = int(len(notice) * self.stretch)
            own = [k for k in places if words[k] in bag]
            seen, total, low = Counter(), 0, 0
            ready: tuple[int, int] | None = None
            for high, k in enumerate(own):
                w = words[k]
                seen[w] += 1
                total += seen[w] <= bag[w]
                while k - own[low] >= span:
                    x = words[own[low]]
                    total -= seen[x] <= bag[x]
                    seen[x] -= 1
                    low += 1
                if total >= need:
                    here = (own[low], k + 1)
                    if ready and len(notice) > DECIDED and here[0] < ready[1] and here[1] - ready[0] <= 2 * span:
                        ready = (ready[0], here[1])  # long notices are aligned once for windows that overlap
                    else:
                        best = self._better(best, words, notice, deciding, ready)
                        ready = here
            best = self._better(best, words, notice, deciding, ready)
            if best and best[0] >= self.coverage:
                out.append((name, *best))
        return out

    def choose(self, found: list[tuple[str, float, int, int]]) -> list[tuple[str, float, int, int]]:
        """What stands of ``found``: of a family's notices at one place those that fit best."""
        return [x for x in found if not any(self._fits_better(y, x) for y in found)]

    def _fits_better(self, y: tuple, x: tuple) -> bool:
        """Whether ``y`` is another notice of the family of ``x`` at its place that has more words in the text, less those that are missing there."""
        if y[0] == x[0] or _FAMILY.get(y[0], y[0]) != _FAMILY.get(x[0], x[0]) or y[2] >= x[3] or x[2] >= y[3]:
            return False
        fit = lambda z: round((2 * z[1] - 1) * len(self.notices[z[0]]))
        return fit(y) > fit(x)

    @staticmethod
    def _better(best, words: list[bytes], notice: list[bytes], deciding: frozenset[bytes], window: tuple[int, int] | None):
        if window is None:
            return best
        matched = align(words[window[0] : window[1]], notice)
        if not deciding <= {notice[j] for _, j in matched}:
            return best
        found = (len(matched) / len(notice), window[0] + matched[0][0], window[0] + matched[-1][0] + 1) if matched else None
        return found if found and (best is None or found[0] > best[0]) else best


RESULT = "n_words long, n_licenses long, license string, coverage double, start_word long, end_word long, licenses string"


def find_licenses(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", notices: Mapping[str, str] = NOTICES, coverage: float = 0.8) -> DataFrame:
    """For every row: how many notices its whole text contains, the best covered one with its place in words, and the names of all.

    Coverage is the share of a notice's words that patience alignment matches in order. One pass over the rows in the tasks of
    the scan; the notices are configuration.

    Defined cases: null and empty texts contain none, with a null license; of equally covered notices the longest wins, then the
    first name; repeated rows are scanned alike; an empty table gives an empty result; other columns are ignored.
    """

    def start() -> Callable:
        scanner = Scanner(notices, coverage)

        def row(text: str | None) -> tuple:
            words = words_of(text)
            found = scanner.choose(scanner.find(words))
            if not found:
                return len(words), 0, None, None, None, None, ""
            name, share, a, b = min(found, key=lambda f: (-f[1], -len(scanner.notices[f[0]]), f[0]))
            return len(words), len(found), name, share, a, b, ",".join(f[0] for f in found)

        return row

    return add_columns(docs.select(id_col, text_col), [text_col], RESULT, start, keep=[id_col])
