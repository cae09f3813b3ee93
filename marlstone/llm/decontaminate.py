"""Benchmark decontamination: a prefix-filtered join of documents with the windows of benchmark items."""

from __future__ import annotations

import hashlib
from array import array
from collections import Counter, defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_map import add_columns, positional
from .workspace import Workspace

#: A-Z become a-z; what is neither a letter or digit of ASCII nor beyond ASCII becomes a space.
_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: Words of benchmark text that are broadcast at a time (about 60 bytes each), cells that words are counted in, and words that a task counts before it adds them up by cell.
BLOCK_WORDS, CELLS, REMEMBERED = 2_000_000, 1 << 20, 300_000


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split() if text else []


def _cell(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word) & (CELLS - 1)


class Windows:
    """The windows of some items, each filed under the rarest of its words.

    A window is a set of ordered words that must be contained whole, so the necessary prefix of its words in order of rarity is
    the rarest one: a text without it can't contain the window. rarity: how often each cell of words is in documents. What is kept for a window is three numbers: its item, its first word and where its rarest is.
    """

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int, rarity: np.ndarray):
        self.window = window
        self.names, self.words, same = [n for n, _ in items], [], {}
        filed: dict[bytes, array] = defaultdict(lambda: array("I"))
        for k, (_, words) in enumerate(items):
            words = [same.setdefault(w, w) for w in words]
            self.words.append(words)
            size = min(window, len(words))
            rare = [(int(rarity[_cell(w)]), w) for w in words]
            for i in range(len(words) - size + 1 if size else 0):
                at = min(range(i, i + size), key=rare.__getitem__)
                filed[words[at]].extend((k, i, at - i))
        self.filed = dict(filed)

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """(start, end) of the windows in ``words``, and the names of the items they are of."""
        filed, n, spans, names = self.filed, len(words), set(), set()
        if filed.keys().isdisjoint(words):
            return [], names
        for i, word in enumerate(words):
            if word in filed:
                places = filed[word]
                for j in range(0, len(places), 3):
                    item, first, at = places[j], places[j + 1], places[j + 2]
                    whole, a = self.words[item], i - at
                    size = min(self.window, len(whole))
                    if a >= 0 and a + size <= n and words[a : a + size] == whole[first : first + size]:
                        spans.add((a, a + size))
                        names.add(self.names[item])
        return sorted(spans), names


def rarity_of(docs: DataFrame, text_col: str, known: frozenset[bytes] | None = None) -> np.ndarray:
    """In how many documents the words of each cell are, over all documents; of the words of ``known`` alone if given. Words that share a cell are taken for commoner than they are, which costs time alone."""
    sent = None if known is None else docs.sparkSession.sparkContext.broadcast(known)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()
        cells = np.zeros(CELLS, np.int64)

        def settle() -> None:
            np.add.at(cells, np.fromiter(map(_cell, seen), np.int64, len(seen)), np.fromiter(seen.values(), np.int64, len(seen)))
            seen.clear()

        for batch in batches:
            for text in batch.column(0):
                words = words_of(text.as_py())
                seen.update(set(words) if sent is None else sent.value.intersection(words))
                if len(seen) > REMEMBERED:
                    settle()
        settle()
        used = np.flatnonzero(cells)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int64()), pa.array(cells[used], pa.int64())], names=["cell", "n"])

    found = docs.select(text_col).mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).toArrow()  # at most a row for each cell
    out = np.zeros(CELLS, np.int64)
    out[found.column("cell").to_numpy()] = found.column("n").to_numpy()
    return out


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, block_words: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    """The items in blocks of about ``block_words`` words; the driver holds two at a time."""
    held, n = [], 0
    for r in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        words = words_of(r[1])
        if held and n + len(words) > block_words:
            yield held
            held, n = [], 0
        held.append((r[0] or "", words))
        n += len(words)
    yield held


def _passes(docs: DataFrame, benchmark: DataFrame, text: str, item_col: str, item_text_col: str, window: int, block_words: int) -> Iterator[tuple[Callable[[], Windows], Callable[[], None], bool]]:
    """For each block of items: what gives its windows in a task, what frees them, and whether it is the only block. A block is broadcast when the one before has been freed."""
    blocks = _blocks(benchmark, item_col, item_text_col, block_words)
    block, following = next(blocks), next(blocks, None)
    only = following is None
    rarity = rarity_of(docs, text, frozenset(w for _, words in block for w in words) if only else None)
    while block is not None:
        windows = Windows(block, window, rarity)
        sent = docs.sparkSession.sparkContext.broadcast(windows)
        del windows
        yield (lambda sent=sent: sent.value), sent.destroy, only
        block, following = following, next(blocks, None)


def _digest(text: str | None) -> bytes:
    return xxhash.xxh3_128_digest((text or "").encode("utf-8", "surrogatepass"))


def covered(spans: list[tuple[int, int]]) -> int:
    n = reach = 0
    for a, b in sorted(spans):
        n += max(0, b - max(a, reach))
        reach = max(reach, b)
    return n


RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def find_contamination(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """For every row of ``docs``: its words, those inside an occurrence of a benchmark window, and the items they are of.

    Windows are ``window`` consecutive words of an item, or the whole of a shorter one. The words of a window are ordered by rarity
    (documents of the whole corpus that have them); its rarest word is joined with the documents' words; the window must
    then fit into the text around that word, and is compared word by word. Rarity is counted once. Benchmarks larger than ``block_words`` go in blocks: what a block finds is
    written, by a digest of the text, before the next one is broadcast, so a task holds one block whatever the benchmark's size; documents' texts aren't shuffled.

    Defined cases: null and empty texts have no words; an item without words has no window; items with one id count once, the null id is written as an empty string; repeated rows
    are judged alike; an empty benchmark leaves all clean; an empty table gives an empty result; other columns are ignored.
    """

    narrow = docs.select(F.col(id_col).alias("c0"), F.col(text_col).alias("c1"))

    def judged(n: int, spans: list, names: set) -> tuple:
        return n, covered(spans), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(spans)

    ws = None
    for k, (windows, free, only) in enumerate(_passes(narrow, benchmark, "c1", item_col, item_text_col, window, block_words)):
        if only:

            def start(windows=windows) -> Callable:
                held = windows()

                def row(text: str | None) -> tuple:
                    words = words_of(text)
                    return judged(len(words), *held.find(words))

                return row

            return add_columns(narrow, ["c1"], RESULT, start, keep=["c0"]).withColumnRenamed("c0", id_col)
        ws = ws or Workspace(docs.sparkSession, "windows")

        def found(windows=windows) -> Callable:
            held, seen = windows(), set()

            def row(text: str | None) -> tuple | None:
                spans, names = held.find(words_of(text))
                digest = _digest(text)
                if not spans or digest in seen:  # equal texts once a task
                    return None
                seen.add(digest)
                return digest, [x for s in spans for x in s], sorted(names)

            return row

        ws.save(add_columns(narrow, ["c1"], "digest binary, spans array<int>, names array<string>", found, keep=[]), f"found/block={k}")
        free()
    hits = ws.spark.read.schema("digest binary, spans array<int>, names array<string>").parquet(ws.path("found"))
    hits = hits.groupBy("digest").agg(F.flatten(F.collect_set("spans")).alias("spans"), F.array_distinct(F.flatten(F.collect_set("names"))).alias("names"))
    rows = add_columns(narrow, ["c1"], "digest binary, n long", lambda: lambda text: (_digest(text), len(words_of(text))), keep=["c0"]).join(hits, "digest", "left")

    def last() -> Callable:
        return lambda n, spans, names: judged(n, list(zip(spans[::2], spans[1::2], strict=True)) if spans else [], set(names or ()))

    return add_columns(rows.drop("digest"), ["n", "spans", "names"], RESULT, last, keep=["c0"]).withColumnRenamed("c0", id_col)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, *, window: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` without any benchmark window, with their columns. Of a benchmark of several blocks each leaves what it keeps to the next, written once a block.

    Defined cases: those of ``find_contamination``; rows without a text stay, and columns of any name do.
    """
    safe, names = positional(docs)
    text, ws = f"c{names.index(text_col)}", None
    for k, (windows, free, only) in enumerate(_passes(safe, benchmark, text, item_col, item_text_col, window, block_words)):

        def start(windows=windows) -> Callable:
            held = windows()
            return lambda value: None if held.find(words_of(value))[0] else (True,)

        safe = add_columns(safe, [text], "_clean boolean", start).drop("_clean")
        if not only:
            ws = ws or Workspace(docs.sparkSession, "clean")
            safe = ws.save(safe, f"block-{k}")
            ws.drop(f"block-{k - 1}")
            free()
    return safe.toDF(*names)
