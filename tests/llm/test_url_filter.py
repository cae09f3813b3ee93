import pytest

from marlstone.llm import url_filter
from marlstone.llm.components import connected_components
from marlstone.llm.workspace import Workspace

SCHEMA = "page_id long, url string, html string, host string"


def judge(spark, rows, **options):
    return {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge_urls(spark.createDataFrame(rows, SCHEMA), Workspace(spark, "t"), **options).collect()}


def test_rules(spark):
    rows = [
        (1, "https://www.Example.NET/en/x?q#f", None, "clash"), (2, "http://a.net/x", "", None), (3, "http://net", None, None), (4, "http://example.com/de/1", None, None), (5, "http://notexample.com/de/1", None, None),
        (6, "http://x.org/fr/", None, None), (7, None, None, None), (8, "no scheme", None, None), (9, "http://x.org/en", None, None), (10, "http://x.net?a", None, None), (11, "a://b://c/d", None, None), (12, "x\ny://h.net/p\nq", None, None),
    ]
    got = judge(spark, rows)
    assert got[1] == ("www.example.net", "/en/x", "example.net/en/", "allow")
    assert got[2] == ("a.net", "/x", "net/", "block")
    assert got[3] == ("net", "", None, "allow")
    assert got[4][2:] == ("example.com/de/", "block")
    assert got[5][2:] == (None, "allow")
    assert got[6][2:] == ("org/fr/", "allow")
    assert got[7] == got[8] == ("", "", None, "allow")
    assert got[10] == ("x.net", "", None, "allow")
    assert got[11][:2] == ("b:", "//c/d")
    assert got[12] == ("h.net", "/p\nq", "net/", "block")


def test_classes(spark):
    link = '<head><LINK href="{}" rel="canonical"/></head>'
    rows = [
        (1, "http://alias.io/a", link.format("http://bad.net/x"), None),  # an alias of a blocked page that isn't a row
        (2, "https://alias.io/b#top", link.format("/a"), None),  # and an alias of the alias, relative
        (3, "http://alias.io/c", '<meta http-equiv="refresh" content="0; url=b">', None),
        (4, "http://mixed.io/1", link.format("http://bad.net/y"), None),
        (5, "http://mixed.io/1", link.format("http://x.org/fr/1"), None),  # with an allowed one: allowed
        (6, "http://x.org/fr/2", link.format("http://bad.net/x"), None),  # its own rule stands, and allows its class
        (7, "http://alone.io/", "<p>", None),
    ]
    got = {k: v[3] for k, v in judge(spark, rows[:5] + rows[6:]).items()}
    assert got == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 7: "allow"}
    assert {k: v[3] for k, v in judge(spark, rows).items()}[1] == "allow"
    assert judge(spark, [(1, "http://q.io/", None, None)], redirects=spark.createDataFrame([("http://q.io", "http://z.net/"), (None, "x")], "source string, target string"))[1][3] == "block"


def test_empty(spark):
    assert judge(spark, []) == {}


@pytest.mark.parametrize("edges", [[(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(7, 99), (98, 99)], [(1, 1), (None, 2), (5, 4), (4, 5)], []])
def test_components(spark, edges):
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long"), "a", "b", Workspace(spark, "t")).collect()}
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    assert got == {x: find(x) for x in list(root)}
