import random

from marlstone.llm import licenses
from marlstone.llm.decontaminate import words_of

SCHEMA = "doc_id long, text string, license string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_alignment_is_ordered_and_good():
    rng = random.Random(1)
    worst = 1.0
    for _ in range(200):
        b = [rng.choice("abcdefghijklmnopqrstuvwxyz").encode() for _ in range(rng.randint(0, 40))]
        a = [x for x in b if rng.random() > 0.1]
        for _ in range(rng.randint(0, 5)):
            a.insert(rng.randint(0, len(a)), rng.choice("abcxyz").encode())
        got = licenses.align(a, b)
        assert all(a[i] == b[j] for i, j in got)
        assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(got, got[1:], strict=False))
        best = lcs(a, b)
        assert len(got) <= best
        worst = min(worst, len(got) / best if best else 1.0)
    assert worst > 0.6


def test_rows(spark):
    mit, gpl = licenses.NOTICES["MIT-text"], licenses.NOTICES["GPL-3.0"]
    edited = " ".join(w for i, w in enumerate(mit.split()) if i % 12)
    rows = [
        (1, "some words\n" + mit + "\nmore", "clash"), (2, "x " * 500 + edited.upper(), None), (3, gpl + " between " + licenses.NOTICES["MIT"], None), (4, "released under something else entirely", None),
        (5, None, None), (6, "", None), (7, "word " * 50_000 + gpl, None), (3, gpl, None), (None, mit[: len(mit) // 2], None),
    ]
    got = {(r.doc_id, r.n_words): r for r in licenses.find_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    find = lambda i: [r for (k, _), r in got.items() if k == i]
    assert find(1)[0].license == "MIT-text" and find(1)[0].coverage == 1.0 and find(1)[0].start_word == 2
    assert find(2)[0].license == "MIT-text" and 0.85 < find(2)[0].coverage < 1
    assert {r.licenses for r in find(3)} == {"GPL-3.0,MIT", "GPL-3.0"}
    assert [(r.n_licenses, r.license) for i in (4, 5, 6, None) for r in find(i)] == [(0, None)] * 4
    assert find(7)[0].start_word == 50_000
    assert licenses.find_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


def test_bound_loses_no_coverage():
    """What the word count leaves out can't reach the coverage."""
    rng = random.Random(2)
    scanner = licenses.Scanner()
    for name, notice in scanner.notices.items():
        for _ in range(5 if len(notice) < 400 else 0):
            kept = [w for w in notice if rng.random() < 0.93 or w.decode() in licenses.DECIDING]
            if lcs(kept, notice) >= 0.8 * len(notice):
                assert name in [f[0] for f in scanner.find(words_of("before it") + kept + words_of("after it"))]


def test_licenses_that_differ_in_a_word():
    scanner = licenses.Scanner()
    names = lambda text: [f[0] for f in scanner.choose(scanner.find(words_of("before it " + text + " after it")))]
    for name in ("BY", "BY-SA", "BY-NC", "BY-NC-ND"):
        assert names(f"Licensed under CC {name} 4.0.") == [f"CC-{name}-4.0"]
    assert names("Licensed under CC BY-NC 3.0.") == ["CC-BY-NC-3.0"]
    gnu = "This work is licensed under the GNU {} Public License, version {}."
    assert [names(gnu.format(*x)) for x in (("General", 2), ("General", 3), ("Lesser General", 3), ("Affero General", 3))] == [["GPL-2.0"], ["GPL-3.0"], ["LGPL-3.0"], ["AGPL-3.0"]]
    for x in ("BSD-2-Clause-text", "BSD-3-Clause-text", "MIT-text", "EPL-2.0", "CC0-1.0", "LGPL-3.0-text", "CC0-1.0-text"):
        assert names(licenses.NOTICES[x]) == [x]
    assert names(licenses.NOTICES["AGPL-3.0-text"]) == ["AGPL-3.0-header", "AGPL-3.0-text"]


def test_other_licenses_words_are_no_notice():
    scanner = licenses.Scanner()
    for text, right in (
        ("Licensed under CC BY 4.0.", {"CC-BY-4.0"}), ("Released under the BSD License.", set()), ("GNU General Public License, version 2", {"GPL-2.0"}), ("GNU Lesser General Public License, version 3", {"LGPL-3.0"}),
        ("Licensed under CC BY-NC 5.0.", set()), ("Licensed under the Academic License, Version 2.0.", set()), ("This work is licensed under the GNU Free Documentation License, version 3.", set()), ("Released under the same License.", set()),
    ):
        assert {f[0] for f in scanner.choose(scanner.find(words_of(text)))} <= right


def plain(text, notices, coverage=0.8, stretch=1.5):
    """Names of the notices of a text: each aligned to every window that ends at one of its words and begins at the first of them in reach, without a count of words."""
    words, found = words_of(text), []
    for name, notice in ((name, words_of(x)) for name, x in sorted(notices.items())):
        span, best = int(len(notice) * stretch), None
        deciding = {w for w in notice if w.decode() in licenses.DECIDING} if len(notice) <= licenses.DECIDED else set()
        own = [k for k, w in enumerate(words) if w in notice]
        for k in own:
            i = min(x for x in own if x > k - span)
            matched = licenses.align(words[i : k + 1], notice)
            if matched and len(matched) >= coverage * len(notice) and deciding <= {notice[j] for _, j in matched} and (best is None or len(matched) > best[1]):
                best = (name, len(matched), i + matched[0][0], i + matched[-1][0] + 1, len(notice))
        found += [best] if best else []
    family = {x: f for f, members in licenses.FAMILIES.items() for x in members}
    beaten = lambda x, y: family.get(x[0], x[0]) == family.get(y[0], y[0]) and y[2] < x[3] and x[2] < y[3] and 2 * y[1] - y[4] > 2 * x[1] - x[4]
    return [x[0] for x in found if not any(beaten(x, y) for y in found if y[0] != x[0])]


def test_query_against_plain_windows(spark):
    rng = random.Random(7)
    notices = {k: v for k, v in licenses.NOTICES.items() if len(words_of(v)) <= licenses.DECIDED}
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randint(0, 3)):
            kept = [w for w in rng.choice(sorted(notices.items()))[1].split() if rng.random() > rng.choice([0, 0.05, 0.12, 0.3])]
            for _ in range(rng.choice([0, 0, 2])):
                kept.insert(rng.randrange(len(kept) + 1), rng.choice(["the", "software", "whale", "License"]))
            parts += [" ".join(kept), " ".join(rng.choice(["some", "words", "of", "the", "whale", "permission", "License,", "2.0"]) for _ in range(rng.randint(0, 40)))]
        rows.append((i, "\n".join(parts), None))
    got = {r.doc_id: r for r in licenses.find_licenses(spark.createDataFrame(rows, SCHEMA), notices=notices).collect()}
    for i, text, _ in rows:
        want = plain(text, notices)
        assert got[i].licenses.split(",") == (want or [""]) and got[i].n_licenses == len(want) and (got[i].license in want or not want), (i, text)
    assert sum(r.n_licenses for r in got.values()) > 40
