"""The mix against a plain version: targets, exact budgets, epochs."""

import hashlib
import re
from collections import Counter, defaultdict

from marlstone.llm import mixing
from marlstone.llm.workspace import Workspace

SCHEMA = "doc_id long, text string, source string, size string"


def brute(rows, weights=(1, 2, 3), cap=3):
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    total = defaultdict(int)
    for r in rows:
        total[r[2]] += size(r[1])
    names = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + ([None] if None in total else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    stopped, all_ = set(), sum(total.values())
    while True:
        free = [s for s in names if s not in stopped]
        rest, weight = all_ - sum(cap * total[s] for s in stopped), sum(w[s] for s in free)
        over = {s for s in free if w[s] * rest / weight > cap * total[s]}
        if not over:
            break
        stopped |= over
    target = {s: float(cap * total[s]) if s in stopped else w[s] * rest / weight for s in names}
    out = []
    for s in names:
        key = lambda r: (hashlib.md5(f"mix:{r[0] if r[0] is not None else 'null:' + hashlib.md5((r[1] or '').encode()).hexdigest()}".encode()).hexdigest(), r[0] or 0, size(r[1]))
        budget, before = int(target[s]), 0
        for r in sorted((r for r in rows if r[2] == s), key=key):
            n = size(r[1])
            epochs, rest_ = divmod(budget, total[s]) if total[s] else (0, 0)
            out.append((r[0], n, total[s], round(target[s], 6), epochs * n + max(0, min(n, rest_ - before))))
            before += n
    return out


ROWS = [
    *((i, "w " * (i % 7) + "x", f"s{i % 5}", "clash") for i in range(60)),
    *((100 + i, "big words here " * 40, "hot", None) for i in range(30)),
    (500, None, "s1", None), (501, "", None, None), (502, "a\tb c\u00a0d", None, None), (None, "no id", "s2", None), (None, None, "s2", None), (7, "w x", "é", None), (7, "w x", "é", None), (900, "only", "zz", None),
]


def test_plan(spark):
    got = mixing.plan_mix(spark.createDataFrame(ROWS, SCHEMA), Workspace(spark, "t")).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert Counter((a, b, c, round(d, 6), e) for a, b, c, d, e in got) == Counter(brute(ROWS))
    assert all(r.taken <= 3 * r.size for r in got)
    want, place = brute(ROWS), 0  # in order of sources: each budget is met exactly
    for source in sorted({r[2] for r in ROWS}, key=lambda s: (s is None, (s or "").encode())):
        n = sum(r[2] == source for r in ROWS)
        part, place = want[place : place + n], place + n
        assert sum(r[4] for r in part) == int(part[0][3] + 1e-6)


def test_partitions_dont_matter(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    a, b = (Counter(map(tuple, mixing.plan_mix(d, Workspace(spark, "t"), bucket_digits=k).select("doc_id", "size", "taken").collect())) for d, k in ((df.repartition(1), 1), (df.repartition(7), 3)))
    assert a == b


def test_equal_ids_and_sizes(spark):
    """Of rows with one id and size but other texts the mix takes the same ones, however they come."""
    rows = [(7, f"word{i} b c", "a", None) for i in range(12)] + [(i, "x y z", "b", None) for i in range(20, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    a, b = (Counter(map(tuple, mixing.mixed_documents(d, Workspace(spark, "t")).collect())) for d in (df.repartition(5, "text"), df.orderBy(mixing.F.desc("text")).coalesce(1)))
    assert a == b and len({r for r in a if r[0] == 7}) < 12


def test_documents(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    got = mixing.mixed_documents(df, Workspace(spark, "t"))
    assert got.columns == df.columns
    rows = [tuple(r) for r in got.collect()]
    assert set(rows) <= set(ROWS) and max(Counter(rows).values()) <= 6  # repeated rows are two documents
    assert all(r[1] and r[1].strip() for r in rows)


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert mixing.plan_mix(df, Workspace(spark, "t")).count() == 0
    assert mixing.mixed_documents(df, Workspace(spark, "t")).count() == 0
    none = spark.createDataFrame([(1, None, "a", None), (2, "", None, None)], SCHEMA)
    assert {tuple(r) for r in mixing.plan_mix(none, Workspace(spark, "t")).select("doc_id", "target", "taken").collect()} == {(1, 0.0, 0), (2, 0.0, 0)}
