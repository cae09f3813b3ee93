"""Similarity join of documents on word n-grams: MinHash banding, then exact verification in blocks."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from functools import reduce
from itertools import groupby

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrow_map import add_columns, positional
from .components import connected_components
from .decontaminate import words_of
from .workspace import Workspace, partitions

_WORDS_KEPT = 300_000
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FOLD = np.uint64(0xFF51AFD7ED558CCD)
#: Bounds of a block that is verified at once: documents, and n-grams of all of them.
BLOCK_DOCS, BLOCK_GRAMS = 512, 1_000_000


def choose_bands(threshold: float, recall: float, most_hashes: int = 128) -> tuple[int, int]:
    """(bands, rows): most rows, so fewest false candidates, with which a pair at ``threshold`` is found with probability ``recall``."""
    for rows in range(most_hashes, 0, -1):
        bands = int(np.ceil(np.log(1 - recall) / np.log1p(-(threshold**rows)))) if threshold < 1 else 1
        if bands * rows <= most_hashes:
            return bands, rows
    raise ValueError("no such bands; allow more hashes or less recall")


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _FOLD
    return x ^ (x >> np.uint64(29))


class Grams:
    """Distinct word n-grams of texts as sorted 64-bit hashes; a shorter text is one n-gram."""

    def __init__(self, n: int):
        self.n, self._known = n, {}

    def __call__(self, text: str | None) -> np.ndarray:
        words, known = words_of(text), self._known
        if not words:
            return np.zeros(0, np.uint64)
        if len(known) > _WORDS_KEPT:
            known.clear()
        try:
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        except KeyError:
            known.update((w, xxhash.xxh3_64_intdigest(w)) for w in set(words) if w not in known)
            h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
        n = min(self.n, len(h))
        x = h[: len(h) - n + 1].copy()
        for i in range(1, n):
            x = x * _MIX + h[i : len(h) - n + 1 + i]
        return np.unique(_mixed(x + np.uint64(n)))


def digest(grams: np.ndarray) -> Decimal | None:
    """120 bits that stand for the set; equal sets are one node of the join."""
    return Decimal(xxhash.xxh3_128_intdigest(grams.tobytes()) >> 8) if len(grams) else None


class Sketch:
    """Hashes of the bands of a set's MinHash signature, and a byte of each of its values."""

    def __init__(self, bands: int, rows: int, seed: int = 1):
        r = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self._a = r.integers(0, 1 << 63, bands * rows, dtype=np.uint64)[:, None] * np.uint64(2) + np.uint64(1)
        self._b = r.integers(0, 1 << 63, bands * rows, dtype=np.uint64)[:, None]

    def __call__(self, grams: np.ndarray) -> tuple[list[int], list[int]]:
        low = np.full(len(self._a), np.uint64(2**64 - 1))
        for i in range(0, len(grams), 2048):
            np.minimum(low, (grams[None, i : i + 2048] * self._a + self._b).min(axis=1), out=low)
        brief = _mixed(low).astype(np.uint8).view(np.int8)
        low = low.reshape(self.bands, self.rows)
        x = low[:, 0]
        for j in range(1, self.rows):
            x = x * _MIX + low[:, j]
        return _mixed(x).view(np.int64).tolist(), brief.tolist()


def _overlaps(left: list[np.ndarray], right: list[np.ndarray] | None) -> np.ndarray:
    """Numbers of common n-grams of each set of ``left`` with each of ``right`` (of ``left`` itself if None). What is in one set only is left out first."""
    sets = left + (right or [])
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, column, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = counts > 1
    keep = shared[column]
    rows, column = rows[keep], (np.cumsum(shared) - 1)[column[keep]]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    out = np.zeros((len(left), len(right) if right else len(left)), np.float32)
    width = 4096
    for a in range(0, int(shared.sum()), width):
        i, j = np.searchsorted(column, (a, a + width))
        x = np.zeros((len(sets), min(width, int(shared.sum()) - a)), np.float32)
        x[rows[i:j], column[i:j] - a] = 1
        out += x[: len(left)] @ (x[len(left) :] if right else x).T
    return out


def _verified(block: list[tuple], other: list[tuple], threshold: float) -> list[tuple]:
    """(node, linked documents, a node of its group) of the sets with links; block and other: (node, copies, grams). other empty: pairs inside the block."""
    left = [g for _, _, g in block]
    right = [g for _, _, g in other] or None
    common = _overlaps(left, right)
    a, b = (np.array([len(g) for g in x], np.float32) for x in (left, right or left))
    linked = common >= threshold * (a[:, None] + b[None, :] - common) - 1e-4
    if right is None:
        np.fill_diagonal(linked, False)
    both = block + other
    i, j = np.nonzero(linked)
    if right is None:
        i, j = i[i < j], j[i < j]
    else:
        j = j + len(block)
    copies = np.array([c for _, c, _ in both])
    links = np.bincount(i, copies[j], len(both)) + np.bincount(j, copies[i], len(both))
    root = np.arange(len(both))
    while True:  # smallest root of the neighbours, then of the roots
        low = root.copy()
        np.minimum.at(low, i, root[j])
        np.minimum.at(low, j, root[i])
        low = low[low]
        if (low == root).all():
            break
        root = low
    return [(both[k][0], int(links[k]), both[root[k]][0]) for k in np.flatnonzero(links)]


def _verify(n: int, threshold: float) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams = Grams(n)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for i in range(0, batch.num_rows, 256):
                    for r in batch.slice(i, 256).to_pylist():
                        yield (r["component"], r["low"], r["high"]), (r["node"], r["copies"], grams(r["text"])), r["block"]

        done: list[tuple] = []
        for (_, low, high), group in groupby(rows(), key=lambda r: r[0]):
            sides: tuple[list, list] = ([], [])
            for _, item, block in group:
                sides[block != low].append(item)
            if low == high and len(sides[0]) > 1 or sides[0] and sides[1]:
                done += _verified(*sides, threshold)
            if len(done) > 20_000:
                yield _linked(done)
                done = []
        yield _linked(done)

    return run


def _linked(rows: list[tuple]) -> pa.RecordBatch:
    kind = pa.decimal128(38, 0)
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], kind), pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)], names=["node", "links", "root"])


#: Least and most bits of the filter that texts pass before they are shuffled, and bits that it has for each node if it isn't larger than that.
FILTER_LEAST, FILTER_MOST, FILTER_BITS = 1 << 20, 1 << 28, 16


def _places(bits: int) -> tuple[int, int]:
    """The two moduli that place a node in a filter."""
    return bits, bits - 39


def _filter(numbers: DataFrame) -> bytes:
    """A Bloom filter of the whole numbers of a frame's one column, combined word by word before it reaches the driver: 32 MB at most. Beyond 16 million it lets more through, which costs shuffle alone."""
    numbers, bits = numbers.toDF("v"), FILTER_LEAST
    n = numbers.count()
    while bits < FILTER_MOST and bits < FILTER_BITS * n:
        bits *= 2
    place = F.explode(F.array(*[F.expr(f"cast(pmod(v, {m}) as int)") for m in _places(bits)])).alias("place")
    words = numbers.select(place).groupBy(F.expr("place div 64").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, place % 64)")).alias("bits")).toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.tobytes()


def _holds(bits: np.ndarray, number: int | Decimal) -> bool:
    return all(bits[(p := int(number) % m) >> 3] >> (p & 7) & 1 for m in _places(8 * len(bits)))


class _Chosen:
    """Which rows have one of some sets of n-grams: by their ids first, so that only texts that may have one are read again."""

    def __init__(self, rows: DataFrame, nodes: DataFrame):
        """rows: (id, node) of all rows; nodes: the chosen ones."""
        send = nodes.sparkSession.sparkContext.broadcast
        self._sent = send(_filter(rows.join(nodes.distinct(), "node").select(F.xxhash64("id")))), send(_filter(nodes))

    def test(self, n: int) -> Callable[[str | None, int], Decimal | None]:
        """In a task: the node of a text, given the hash of its row's id, if it may be a chosen one."""
        ids, nodes = (np.frombuffer(x.value, np.uint8) for x in self._sent)
        grams = Grams(n)

        def chosen(text: str | None, id_hash: int) -> Decimal | None:
            node = digest(grams(text)) if _holds(ids, id_hash) else None
            return node if node is not None and _holds(nodes, node) else None

        return chosen


def _distinct_texts(docs: DataFrame, id_col: str, text_col: str, n: int, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the texts that may be of ``nodes``: each set of n-grams once for each task that reads it, so that copies are few before the shuffle."""
    which = _Chosen(rows, nodes)

    def start() -> Callable:
        test, seen = which.test(n), set()

        def row(text: str | None, id_hash: int) -> tuple | None:
            node = test(text, id_hash)
            if node is None or node in seen:
                return None
            seen.add(node)
            return (node,)

        return row

    return add_columns(docs.select(F.xxhash64(id_col).alias("id_hash"), F.col(text_col).alias("text")), ["text", "id_hash"], "node decimal(38,0)", start, keep=["text"])


#: Shares of equal values of two signatures: below the first two sets aren't similar, from the second on a set is near enough to its bucket's lowest that what is similar to it is above the first too.
FAR, CLOSE, ROUNDS = 0.2, 0.65, 3


def _edges(buckets: DataFrame, sets: DataFrame, ws: Workspace) -> DataFrame:
    """(node, low): edges whose components hold all similar sets that share a bucket.

    Each set of a bucket meets the lowest. Edges whose signatures say that the sets aren't similar are chance, and would chain unrelated sets into components without end: they are left out, and what isn't close to
    the lowest then meets the lowest of the rest. What is left after a few rounds, many unrelated sets in one bucket, is kept as it is. By the signature's 120 values a pair of 0.8 falls below 0.2 less often than once in 10 ** 40, and one that CLOSE vouches
    for (0.35 at least) less often than once in a thousand.
    """
    lowest = buckets.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
    open_ = ws.save(buckets.join(lowest, ["band", "hash"]).where("node <> low"), "open-0")
    brief = sets.select("node", "brief")
    parts = []
    for r in range(ROUNDS):
        pairs = open_.select("node", "low").distinct()
        pairs = pairs.join(brief, "node").join(brief.select(F.col("node").alias("low"), F.col("brief").alias("low_brief")), "low")
        equal = F.expr("aggregate(zip_with(brief, low_brief, (x, y) -> if(x = y, 1, 0)), 0, (n, x) -> n + x) / size(brief)")
        judged = ws.save(pairs.select("node", "low", equal.alias("equal")), f"judged-{r}")
        parts.append(judged.where(F.col("equal") >= FAR).select("node", "low"))
        rest = open_.join(judged.where(F.col("equal") < CLOSE).select("node", "low"), ["node", "low"], "left_semi").select("band", "hash", "node")
        lowest = rest.groupBy("band", "hash").agg(F.min("node").alias("low"), F.count("*").alias("n")).where("n > 1").drop("n")
        open_ = ws.save(rest.join(lowest, ["band", "hash"]).where("node <> low"), f"open-{r + 1}")
        if open_.isEmpty():
            break
    else:
        parts.append(open_.select("node", "low"))
    return reduce(DataFrame.unionByName, parts)


def _classes(docs: DataFrame, ws: Workspace, id_col: str, text_col: str, n: int, threshold: float, recall: float) -> tuple[DataFrame, DataFrame]:
    """(id, node) of every row, and (node, component, first, class_id, n_links) of every set of n-grams."""
    spark = docs.sparkSession
    bands, rows = choose_bands(threshold, recall)

    def start() -> Callable:
        grams, sketch = Grams(n), Sketch(bands, rows)

        def row(text: str | None) -> tuple:
            g = grams(text)
            return (digest(g), len(g), *sketch(g)) if len(g) else (None, 0, None, None)

        return row

    sketches = ws.save(add_columns(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), ["text"], "node decimal(38,0), grams long, bands array<long>, brief array<tinyint>", start, keep=["id"]), "sketches")
    sets = ws.save(sketches.where("node is not null").groupBy("node").agg(F.count("*").alias("copies"), F.min("id").alias("first"), F.min("grams").alias("grams"), F.first("bands").alias("bands"), F.first("brief").alias("brief")), "sets")
    groups = ws.save(connected_components(_edges(sets.select("node", F.posexplode("bands").alias("band", "hash")), sets, ws), "node", "low", ws, "candidates"), "groups")
    ws.drop(*[f"{x}-{r}" for x in ("open", "judged") for r in range(ROUNDS + 1)])
    members = groups.join(sets.select("node", "copies", "grams"), "node")
    sizes = members.groupBy("component").agg(F.ceil(F.greatest(F.count("*") / BLOCK_DOCS, F.sum("grams") / BLOCK_GRAMS)).cast("int").alias("blocks"))
    placed = ws.save(members.join(sizes, "component").select("node", "component", "copies", "blocks", F.pmod(F.xxhash64("node"), "blocks").cast("int").alias("block")), "placed")
    # every two blocks of a group meet once; a group of one block meets itself
    meets = F.explode(F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("low"), F.greatest(o, F.col("block")).alias("high"))))
    one_each = _distinct_texts(docs, id_col, text_col, n, sketches.select("id", "node"), placed.select("node")).join(placed, "node").dropDuplicates(["node"])
    dealt = one_each.withColumn("meet", meets).select("component", "meet.low", "meet.high", "block", "node", "copies", "text")
    keys = ["component", "low", "high"]
    linked = ws.save(dealt.repartition(partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(_verify(n, threshold), "node decimal(38,0), links long, root decimal(38,0)"), "linked")
    labels = connected_components(linked, "node", "root", ws, "links")
    links = linked.groupBy("node").agg(F.sum("links").alias("links"))
    known = sets.select("node", "copies", "first").join(links, "node", "left").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    known = ws.save(known, "known")
    lowest_id = known.groupBy("component").agg(F.min("first").alias("class_id"))
    classes = known.join(lowest_id, "component").select("node", "component", "first", "class_id", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    return sketches.select("id", "node"), classes


def join_ngrams(docs: DataFrame, ws: Workspace, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """The id, ``class_id`` and ``n_links`` of every row of ``docs``.

    Two rows are linked if the Jaccard similarity of their sets of word ``n``-grams (lower-case words of letters, digits and
    what is beyond ASCII) is ``threshold`` or more; n_links counts linked rows, copies included, and class_id is the smallest id
    that links lead to.

    Equal sets are one node from the start, so copies cost nothing later. Bands and rows of the MinHash signature are chosen for
    ``recall`` at the threshold. Nodes that share a band's hash are joined to the smallest of their bucket unless their signatures say that this is chance, and the components of these candidates are verified
    on full n-gram sets: a component is dealt into blocks of bounded size, every two blocks meet in one task, and a task
    sends back a row for each node with links, not for each pair. So no group is too large for a task, and no candidate is left out.

    Defined cases: null texts and texts without words have no links and are their own class; a text of fewer words is one n-gram; rows with
    equal ids and texts are copies of each other; null ids are never a class id unless a class has no other; an empty table
    gives an empty result; other columns are ignored.
    """
    rows, classes = _classes(docs, ws, id_col, text_col, n, threshold, recall)
    joined = rows.join(classes, "node", "left")
    return joined.select(F.col("id").alias(id_col), F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def one_of_each(docs: DataFrame, ws: Workspace, *, id_col: str = "doc_id", text_col: str = "text", n: int = 5, threshold: float = 0.8, recall: float = 0.9999) -> DataFrame:
    """Rows of ``docs``, with their columns: the one with the smallest id of each class of ``join_ngrams``, and all without words."""
    safe, names = positional(docs)
    ident, text = f"c{names.index(id_col)}", f"c{names.index(text_col)}"
    rows, classes = _classes(safe, ws, ident, text, n, threshold, recall)
    classes = ws.save(classes, "classes")
    which = _Chosen(rows, classes.where("n_links > 0").select("node"))

    def start(linked: bool) -> Callable:
        test, seen = which.test(n), set()

        def row(value: str | None, id_: int | None, id_hash: int) -> tuple | None:
            node = test(value, id_hash)
            if (node is not None) != linked:
                return None
            if linked:
                if (node, id_) in seen:  # rows with equal ids and texts: one a task
                    return None
                seen.add((node, id_))
            return (node,)

        return row

    def marked(linked: bool) -> DataFrame:
        return add_columns(safe.withColumn("_id_hash", F.xxhash64(ident)), [text, ident, "_id_hash"], "_node decimal(38,0)", lambda: start(linked), keep=safe.columns)

    # what surely has no link stays where it is; the rest is joined with the winner of its class, the smallest node of those with its smallest id
    winners = classes.where(F.col("first").eqNullSafe(F.col("class_id"))).groupBy("component").agg(F.min("node").alias("_node"), F.min("class_id").alias("_class")).drop("component")
    chosen = marked(True).join(winners, "_node").where(F.col(ident).eqNullSafe(F.col("_class"))).dropDuplicates(["_node"]).drop("_class", "_node")
    return marked(False).drop("_node").unionByName(chosen).toDF(*names)
