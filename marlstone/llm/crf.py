"""A linear-chain conditional random field over string features, trained by maximum likelihood."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

LABELS = ("O", "B", "I")


class CRF:
    """Scores: a weight for each feature and label, and one for each pair of neighbouring labels. Unknown features count nothing."""

    def __init__(self, weights: dict[str, np.ndarray], moves: np.ndarray):
        self.weights, self.moves = weights, moves
        self._none = np.zeros(len(LABELS))
        #: A token at which O leads B and I by more is O in every best path: no neighbours' transitions can make up for it, and no end of the text.
        self.margin = np.maximum(0, (moves[:, 1:] - moves[:, :1]).max(axis=0)) + np.maximum(0, (moves[1:] - moves[0]).max(axis=1))

    def scores(self, features: Sequence[str]) -> np.ndarray:
        get, none = self.weights.get, self._none
        return sum((get(f, none) for f in features), start=none.copy())

    def decode(self, sentence: Sequence[Sequence[str]]) -> list[int]:
        """The likeliest labels (Viterbi)."""
        if not sentence:
            return []
        best, back = self.scores(sentence[0]), []
        for features in sentence[1:]:
            ways = best[:, None] + self.moves
            back.append(ways.argmax(axis=0))
            best = ways.max(axis=0) + self.scores(features)
        path = [int(best.argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        return path[::-1]

    def safe_margin(self, features: Sequence[str]) -> float:
        """By how much O leads at a token, less the most that its two transitions can make up for. Above 0 the token is O in every best path."""
        s = self.scores(features)
        return float((s[0] - s[1:] - self.margin).min())

    def decode_unsure(self, places: np.ndarray, scores: np.ndarray, n: int) -> Iterator[tuple[int, int]]:
        """(token, label) of the tokens that aren't O in the likeliest labels of ``n`` tokens; ``places`` and ``scores`` are of those that ``margin`` doesn't make O.

        A token that is O in every best path parts what is before it from what is after it, so each run of the others is decoded apart, between two O.
        """
        moves, into = self.moves.tolist(), self.moves.T.tolist()
        ends = np.append(np.flatnonzero(np.diff(places) > 1) + 1, len(places)).tolist() if len(places) else []
        for i, j in zip([0, *ends], ends, strict=False):
            first, last, back = int(places[i]), int(places[j - 1]), bytearray()
            best = [s + (moves[0][y] if first else 0.0) for y, s in enumerate(scores[i].tolist())]
            for block in range(i + 1, j, 4096):
                for s in scores[block : min(j, block + 4096)].tolist():
                    ways = [[b + m for b, m in zip(best, to, strict=True)] for to in into]
                    tops = [max(w) for w in ways]
                    back += bytes([w.index(t) for w, t in zip(ways, tops, strict=True)])
                    best = [t + x for t, x in zip(tops, s, strict=True)]
            if last + 1 < n:
                best = [b + moves[y][0] for y, b in enumerate(best)]
            path = bytearray([best.index(max(best))])
            for k in range(len(back) - len(LABELS), -1, -len(LABELS)):
                path.append(back[k + path[-1]])
            path.reverse()
            yield from ((first + k, y) for k, y in enumerate(path) if y)


def train(sentences: Sequence[Sequence[Sequence[str]]], labels: Sequence[Sequence[int]], *, rounds: int = 80, rate: float = 0.4, l2: float = 0.02) -> CRF:
    """Batch gradient ascent with per-weight rates; every sentence in every round, so that equal input gives equal weights."""
    names = sorted({f for s in sentences for token in s for f in token})
    index = {f: i for i, f in enumerate(names)}
    n, longest, k = len(sentences), max(map(len, sentences)), len(LABELS)
    width = max(len(token) for s in sentences for token in s)
    at = np.full((n, longest, width), len(names))
    gold = np.zeros((n, longest), int)
    mask = np.zeros((n, longest), bool)
    for i, (s, y) in enumerate(zip(sentences, labels, strict=True)):
        mask[i, : len(s)] = True
        gold[i, : len(s)] = y
        for t, token in enumerate(s):
            at[i, t, : len(token)] = [index[f] for f in token]
    one = np.eye(k)[gold] * mask[:, :, None]
    pairs = np.einsum("nta,ntb->ab", one[:, :-1], one[:, 1:])
    w, moves = np.zeros((len(names) + 1, k)), np.zeros((k, k))
    gw, gm = np.full_like(w, 1e-8), np.full_like(moves, 1e-8)

    def spread(x: np.ndarray) -> np.ndarray:
        flat = at[mask].reshape(-1)
        return np.stack([np.bincount(flat, np.repeat(x[mask][:, j], width), len(names) + 1) for j in range(k)], axis=1)

    seen = spread(one)
    for _ in range(rounds):
        emit = w[at].sum(axis=2)
        fore = np.zeros((n, longest, k))
        fore[:, 0] = emit[:, 0]
        for t in range(1, longest):
            step = np.logaddexp.reduce(fore[:, t - 1, :, None] + moves, axis=1) + emit[:, t]
            fore[:, t] = np.where(mask[:, t, None], step, fore[:, t - 1])
        total = np.logaddexp.reduce(fore[:, -1], axis=1)
        rear = np.zeros((n, longest, k))
        for t in range(longest - 2, -1, -1):
            step = np.logaddexp.reduce(moves[None] + (emit[:, t + 1] + rear[:, t + 1])[:, None, :], axis=2)
            rear[:, t] = np.where(mask[:, t + 1, None], step, 0)
        node = np.exp(fore + rear - total[:, None, None]) * mask[:, :, None]
        edge = np.exp(fore[:, :-1, :, None] + moves + (emit + rear)[:, 1:, None, :] - total[:, None, None, None]) * mask[:, 1:, None, None]
        dw, dm = seen - spread(node) - l2 * w, pairs - edge.sum(axis=(0, 1)) - l2 * moves
        dw[-1] = 0
        gw, gm = gw + dw**2, gm + dm**2
        w, moves = w + rate * dw / np.sqrt(gw), moves + rate * dm / np.sqrt(gm)
    return CRF({f: w[i] for f, i in index.items()}, moves)
