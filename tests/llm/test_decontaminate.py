import hashlib
import random
import re

import pytest

from marlstone.llm import decontaminate

SCHEMA = "doc_id long, text string, n_words string"


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, bench, size=10):
    out = []
    for i, t, *_ in docs:
        w, hit, items = words(t), set(), set()
        for item, text in bench:
            b = words(text)
            n = min(size, len(b))
            for k in range(len(b) - n + 1 if n else 0):
                for j in range(len(w) - n + 1):
                    if w[j : j + n] == b[k : k + n]:
                        hit.update(range(j, j + n))
                        items.add("" if item is None else str(item))
        out.append((i, len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)))
    return out


def made(seed):
    rng = random.Random(seed)
    vocabulary = ["aa", "bb", "cc", "dd", "Éé", "9", "zz", "q", "long", "rare"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    bench = [(i, text(rng.randint(8, 20))) for i in range(8)] + [(20, "Aa, BB"), (21, ""), (22, None), (3, text(12)), (None, "rare rare rare")]
    docs = [(i, text(rng.randint(0, 60)), "clash") for i in range(30)]
    docs += [(100 + i, text(5) + " " + b[1].upper() + "! " + text(5), None) for i, b in enumerate(bench[:6])]
    docs += [(200, None, None), (201, "", None), (202, "aa-BB", None), (None, "aa bb", None), (5, "aa bb", None), (5, "aa bb", None), (300, "zz " * 40_000 + "aa bb", None)]
    return docs, bench


@pytest.mark.parametrize("block_words", [1_000_000, 30])
def test_against_brute_force(spark, block_words):
    docs, bench = made(1)
    got = decontaminate.find_contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, "item_id long, text string"), block_words=block_words)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(docs, bench)))


@pytest.mark.parametrize("block_words", [1_000_000, 30])
def test_drop(spark, block_words):
    docs, bench = made(2)
    df = spark.createDataFrame(docs, SCHEMA)
    got = decontaminate.drop_contaminated(df, spark.createDataFrame(bench, "item_id long, text string"), block_words=block_words)
    assert got.columns == df.columns
    clean = [d for d, b in zip(docs, brute(docs, bench), strict=True) if not b[5]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, clean))


def test_one_block_is_broadcast_at_a_time(spark, monkeypatch):
    docs, bench = made(3)
    held, most = set(), []
    broadcast = spark.sparkContext.broadcast

    def counted(value):
        sent = broadcast(value)
        if isinstance(value, decontaminate.Windows):
            held.add(id(sent))
            most.append((len(held), sum(map(len, value.words))))
            destroy = sent.destroy
            sent.destroy = lambda: (held.discard(id(sent)), destroy())
        return sent

    monkeypatch.setattr(spark.sparkContext, "broadcast", counted)
    got = decontaminate.find_contamination(spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, "item_id long, text string"), block_words=30)
    assert len(most) > 4 and all(n == 1 and words <= 30 for n, words in most) and not held
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, brute(docs, bench)))


def test_memory_of_windows():
    """What a window costs when it is sent: a word's reference and three numbers, not a copy of its words."""
    import pickle

    rng = random.Random(4)
    items = [(str(k), [b"w%d" % rng.randrange(20_000) for _ in range(1_000)]) for k in range(100)]
    windows = decontaminate.Windows(items, 10, decontaminate.np.zeros(decontaminate.CELLS, "int64"))
    assert len(pickle.dumps(windows)) < 30 * 100_000


def test_empty(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.find_contamination(spark.createDataFrame([], SCHEMA), none).count() == 0
    assert [tuple(r)[1:4] for r in decontaminate.find_contamination(spark.createDataFrame([(1, "a b", None)], SCHEMA), none).collect()] == [(2, 0, 0)]
