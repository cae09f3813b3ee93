"""URL rules with redirect equivalence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import connected_components
from .workspace import Workspace

#: (verdict, host, path)
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_node(url: Column) -> Column:
    """What a URL and its plain variants share: scheme, default port and fragment go, the host is lower case, an empty path is /."""
    host = F.regexp_replace(url_host(url), r":(80|443)\z", "")
    path = url_path(url)
    query = F.regexp_extract(url, r"(?s)^[^#]*?(\?[^#]*)", 1)
    return F.when(host != "", F.concat(host, F.when(path == "", "/").otherwise(path), query))


def best_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null where none does. Rules are configuration: a list of fixed length, made into one CASE."""
    rule = verdict = None
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "allow", r[1], r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        rule = F.when(fits, rule_host + rule_path) if rule is None else rule.when(fits, rule_host + rule_path)
        verdict = F.when(fits, kind) if verdict is None else verdict.when(fits, kind)
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def html_links(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(source, target) URL pairs from canonical links and meta refreshes; relative targets are resolved against the page."""
    html, url = F.col(html_col), F.col(url_col)
    canonical = F.regexp_extract(html, r"(?is)<link\b[^>]*\brel\s*=\s*[\"']?canonical\b[^>]*>", 0)
    refresh = F.regexp_extract(html, r"(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*[\"']?refresh\b[^>]*>", 0)
    found = F.filter(
        F.array(
            F.regexp_extract(canonical, r"(?is)\bhref\s*=\s*[\"']?([^\"'\s>]+)", 1),
            F.regexp_extract(refresh, r"(?is)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1),
        ),
        lambda x: x != "",
    )
    to = F.col("_to")
    root = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*(/(?:[^?#]*/)?)", 1)
    target = (
        F.when(to.contains("://"), to)
        .when(to.startswith("//"), F.concat(F.lit("x:"), to))
        .when(to.startswith("/"), F.concat(root, to))
        .when(to.startswith("#"), url)
        .when(to.startswith("?"), F.concat(F.regexp_extract(url, r"(?s)^([^?#]*)", 1), to))
        .otherwise(F.concat(root, F.when(folder == "", "/").otherwise(folder), to))
    )
    return pages.select(url.alias("source"), F.explode(found).alias("_to"), url).select("source", target.alias("target"))


def judge_urls(pages: DataFrame, ws: Workspace, rules: Sequence[tuple[str, str, str]] = RULES, redirects: DataFrame | None = None, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", default: str = "allow") -> DataFrame:
    """page id, host, path, rule and verdict for every row of ``pages``.

    A rule fits its host and all subdomains where the URL's path starts with the rule's; the longest wins. A URL that no rule
    fits takes the decision of its redirect class: the connected component over canonical links, meta refreshes and
    ``redirects`` (source, target URLs; a crawler's log). A class with an allowed URL is allowed, else one with a blocked URL
    is blocked, whether or not that URL is itself a page. A page's own rule is never overruled. Else ``default``.

    Defined cases: null URLs and URLs without :// have empty host and path and belong to no class; repeated pages are judged
    alike; an empty table gives an empty result; other columns are ignored.
    """
    pages = pages.select(id_col, url_col, html_col)
    links = html_links(pages, url_col, html_col)
    if redirects is not None:
        links = links.unionByName(redirects.select("source", "target"))
    edges = links.select(url_node(F.col("source")).alias("a"), url_node(F.col("target")).alias("b"))
    nodes = connected_components(edges, "a", "b", ws)
    split = F.concat(F.lit("x://"), F.col("node"))
    own = best_rule(url_host(split), url_path(split), rules)[1]
    marked = nodes.withColumn("_own", own)
    decided = marked.groupBy("component").agg(F.when(F.max((F.col("_own") == "allow").cast("int")) == 1, "allow").when(F.max((F.col("_own") == "block").cast("int")) == 1, "block").alias("_class")).where("_class is not null")
    classes = ws.save(nodes.join(decided, "component").select(F.col("node").alias("_node"), "_class"), "classes")
    url = F.col(url_col)
    seen = pages.select(id_col, url_host(url).alias("host"), url_path(url).alias("path"), url_node(url).alias("_node"))
    rule, verdict = best_rule(F.col("host"), F.col("path"), rules)
    judged = seen.select(id_col, "host", "path", rule.alias("rule"), verdict.alias("_verdict"), "_node")
    return judged.join(classes, "_node", "left").select(id_col, "host", "path", "rule", F.coalesce("_verdict", "_class", F.lit(default)).alias("verdict"))
