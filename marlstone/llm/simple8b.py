"""Simple-8b: as many equally wide ids in each 64-bit word as fit.

The top four bits of a word are its selector, the other 60 hold the ids, the first in the lowest bits. Selector 0 is an escape:
the next word is one id of up to 64 bits. Ids are coded in blocks of a fixed number of ids; the last word of a block may have
room left. All blocks of a call are coded and decoded side by side.
"""

from __future__ import annotations

import numpy as np

#: Ids in a word and bits of an id, by selector (fixed values; 0 is the escape).
COUNTS = np.array([1, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1])
WIDTHS = np.array([64, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60])
BLOCK = 4096
_MAX = int(COUNTS.max())
_MASKS = np.array([(1 << int(w)) - 1 if w < 64 else 0 for w in WIDTHS], dtype=np.uint64)


_SMALL = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def _bits(ids: np.ndarray) -> np.ndarray:
    """Bits of each id: small ones by table, others by the exponent of a float, whose 53 bits hold either half of an id exactly."""
    if ids.size and int(ids.max()) < len(_SMALL):
        return _SMALL[ids]
    out = np.frexp((ids & np.uint64(0xFFFFFFFF)).astype(np.float64))[1].astype(np.uint8)
    high = ids >> np.uint64(32)
    if high.any():
        out = np.where(high != 0, np.frexp(high.astype(np.float64))[1].astype(np.uint8) + np.uint8(32), out)
    return out


def encode(ids: np.ndarray, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(words, first word of each block and the total, places of escaped words)."""
    n = len(ids)
    lanes = -(-n // block)
    padded = np.zeros((lanes, block + _MAX), np.uint64)
    padded[:, :block] = np.pad(ids.astype(np.uint64), (0, lanes * block - n)).reshape(lanes, block)
    ends = np.full(lanes, block)
    if lanes:
        ends[-1] = n - (lanes - 1) * block
    bits = _bits(padded)
    tops, span = {1: bits}, 1
    while span < 64:
        low = tops[span]
        tops[span * 2] = np.maximum(low, np.concatenate([low[:, span:], np.zeros((lanes, span), np.uint8)], axis=1))
        span *= 2
    # what fits a selector fits all later ones: they hold fewer and wider ids. So the choice is the number of those that don't fit, plus one
    choice = np.ones((lanes, block), np.uint8)
    for s in range(1, 16):
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        span = 1 << (count.bit_length() - 1)
        most = np.maximum(tops[span][:, :block], tops[span][:, count - span : count - span + block])
        choice += most > width
    choice[choice == 16] = 0
    at, live, lane_of, start_of = np.zeros(lanes, np.int64), np.arange(lanes), [], []
    while len(live):
        here = at[live]
        lane_of.append(live)
        start_of.append(here)
        at[live] = here + COUNTS[choice[live, here]]
        live = live[at[live] < ends[live]]
    if not lanes:
        return np.zeros(0, np.uint64), np.zeros(1, np.int64), np.zeros(0, np.int64)
    lane, start = np.concatenate(lane_of), np.concatenate(start_of)
    order = np.argsort(lane.astype(np.uint16 if lanes < 65536 else np.int64), kind="stable")
    lane, start = lane[order], start[order]
    sel = choice[lane, start]
    size = 1 + (sel == 0)
    place = np.cumsum(size) - size
    words = np.zeros(int(size.sum()), np.uint64)
    for s in np.unique(sel):
        rows = np.flatnonzero(sel == s)
        if s == 0:
            words[place[rows] + 1] = padded[lane[rows], start[rows]]
            continue
        count, width = int(COUNTS[s]), int(WIDTHS[s])
        word = np.full(len(rows), np.uint64(int(s) << 60))
        if width:
            for j in range(count):
                word |= padded[lane[rows], start[rows] + j] << np.uint64(j * width)
        words[place[rows]] = word
    first = np.searchsorted(lane, np.arange(lanes))
    return words, np.append(place[first], len(words)), place[sel == 0] + 1


def decode(words: np.ndarray, offsets: np.ndarray, escaped: np.ndarray, n: int, block: int = BLOCK) -> np.ndarray:
    """The ``n`` ids of whole blocks that start at ``offsets`` (the last entry is the end); escaped: places of escaped words."""
    lanes = len(offsets) - 1
    if not lanes:
        return np.zeros(0, np.uint64)
    sel = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    raw[escaped] = True
    count = np.where(raw, 1, np.where(sel == 0, 0, COUNTS[sel]))
    before = np.cumsum(count) - count
    lane = np.repeat(np.arange(lanes), np.diff(offsets))
    place = before - before[offsets[:-1]][lane] + lane * (block + _MAX)
    out = np.zeros(lanes * (block + _MAX), np.uint64)
    out[place[raw]] = words[raw]
    for s in range(2, 16):
        rows = np.flatnonzero((sel == s) & ~raw)
        if len(rows):
            w, p = words[rows], place[rows]
            for j in range(int(COUNTS[s])):
                out[p + j] = (w >> np.uint64(j * int(WIDTHS[s]))) & _MASKS[s]
    return out.reshape(lanes, block + _MAX)[:, :block].reshape(-1)[:n]
