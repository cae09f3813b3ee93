"""The n-gram join against all pairs, on texts with copies, edits, short texts and nulls."""

import random
from collections import Counter

import pytest

from marlstone.llm import ngram_join
from marlstone.llm.decontaminate import words_of
from marlstone.llm.workspace import Workspace

SCHEMA = "doc_id long, text string, node string"


def grams(text, n=5):
    w = words_of(text)
    return {tuple(w[i : i + min(n, len(w))]) for i in range(len(w) - min(n, len(w)) + 1)} if w else set()


def brute(rows, t=0.8):
    sets = [grams(r[1]) for r in rows]
    links = {i: set() for i in range(len(rows))}
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= t * len(sets[i] | sets[j]) - 1e-9:
                links[i].add(j)
                links[j].add(i)
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in links:
        for j in links[i]:
            root[find(i)] = find(j)
    members = {}
    for i in range(len(rows)):
        members.setdefault(find(i), []).append(rows[i][0])
    low = {k: min((x for x in v if x is not None), default=None) for k, v in members.items()}
    return [(rows[i][0], low[find(i)], len(links[i])) for i in range(len(rows))]


def made(seed=3):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    texts = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.randint(6, 120))]
        texts.append(" ".join(base))
        for _ in range(rng.randint(0, 5)):
            other = list(base)
            for _ in range(rng.randint(0, 3)):
                other[rng.randrange(len(other))] = rng.choice(words)
            texts.append(" ".join(other))
    texts += ["", None, " .,; ", "one two", "ONE, two!", "a", texts[0].upper(), texts[0], "long " * 20000, "日本 語"]
    rng.shuffle(texts)
    return [(i, t, "x") for i, t in enumerate(texts)]


def test_against_all_pairs(spark):
    rows = made()
    got = ngram_join.join_ngrams(spark.createDataFrame(rows, SCHEMA), Workspace(spark, "t"))
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))


def test_blocks_lose_nothing(spark, monkeypatch):
    """Groups far larger than a block."""
    monkeypatch.setattr(ngram_join, "BLOCK_DOCS", 3)
    rows = made(8)
    got = ngram_join.join_ngrams(spark.createDataFrame(rows, SCHEMA), Workspace(spark, "t"))
    assert Counter(map(tuple, got.collect())) == Counter(brute(rows))


def test_chance_chains_join_nothing(spark):
    """Unrelated sets in a chain of buckets with two each, and similar ones in a bucket whose lowest is unrelated: the first aren't one component, the others are found."""
    ws = Workspace(spark, "t")
    rng = random.Random(2)
    brief = lambda: [rng.randint(-128, 127) for _ in range(120)]
    one = brief()
    near = [x if rng.random() < 0.85 else 0 for x in one]
    sets = [(i, brief()) for i in range(40)] + [(100, one), (101, near)]
    kinds = "cast(node as decimal(38,0)) as node"
    sets = spark.createDataFrame(sets, "node long, brief array<tinyint>").selectExpr(kinds, "brief")
    chain = [(0, h, n) for h in range(39) for n in (h, h + 1)]
    buckets = spark.createDataFrame([*chain, (1, 7, 5), (1, 7, 100), (1, 7, 101), (1, 8, 6), (1, 8, 9)], "band int, hash long, node long").selectExpr("band", "hash", kinds)
    got = {tuple(map(int, r)) for r in ngram_join._edges(buckets, sets, ws).collect()}
    assert got == {(101, 100)}
    many = spark.createDataFrame([(0, 1, n) for n in range(30)], "band int, hash long, node long").selectExpr("band", "hash", kinds)
    kept = {tuple(map(int, r)) for r in ngram_join._edges(many, sets, Workspace(spark, "t")).collect()}
    assert len(kept) == 26  # what the rounds can't part stays together


def test_filter(spark, monkeypatch):
    nodes = spark.range(3000).selectExpr("cast(id * 7919 as decimal(38,0)) as node")
    for least in (1 << 20, 1 << 10):
        monkeypatch.setattr(ngram_join, "FILTER_LEAST", least)
        bits = ngram_join.np.frombuffer(ngram_join._filter(nodes), "uint8")
        assert all(ngram_join._holds(bits, i * 7919) for i in range(3000))
        assert sum(ngram_join._holds(bits, i * 7919 + 1) for i in range(3000)) < 300
    signed = spark.range(-50, 50).selectExpr("xxhash64(id) as h")
    bits = ngram_join.np.frombuffer(ngram_join._filter(signed), "uint8")
    assert all(ngram_join._holds(bits, r.h) for r in signed.collect())
    assert len(ngram_join._filter(nodes.limit(0))) == (1 << 10) // 8


def test_one_of_each(spark):
    rows = made(5) + [(None, "just a text that is here twice", "y"), (None, "just a text that is here twice", "y"), (None, "and another one that nobody has here", "y"), (3, dict((r[0], r[1]) for r in made(5))[3], "x")]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = [tuple(r) for r in ngram_join.one_of_each(df, Workspace(spark, "t")).collect()]
    classes = {}
    for i, (_, c, _n) in enumerate(brute(rows)):
        classes.setdefault((c, rows[i][1] if c is None else None) if grams(rows[i][1]) else ("empty", i), []).append(rows[i])
    assert len(kept) == len(classes)
    assert all(k in rows for k in kept)
    assert ngram_join.one_of_each(df.limit(0), Workspace(spark, "t")).count() == 0


def test_empty_and_repeated(spark):
    assert ngram_join.join_ngrams(spark.createDataFrame([], SCHEMA), Workspace(spark, "t")).count() == 0
    rows = [(7, "the same words again and again", "a")] * 4
    assert {tuple(r) for r in ngram_join.join_ngrams(spark.createDataFrame(rows, SCHEMA), Workspace(spark, "t")).collect()} == {(7, 7, 3)}


@pytest.mark.parametrize("recall", [0.9, 0.99, 0.9999])
def test_bands_reach_the_recall(recall):
    bands, rows = ngram_join.choose_bands(0.8, recall)
    assert bands * rows <= 128 and 1 - (1 - 0.8**rows) ** bands >= recall
