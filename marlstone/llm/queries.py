"""One query for each operator, over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, licenses, line_dedup, mixing, ngram_join, quality, secrets, token_store, url_filter, warc
from .workspace import Workspace

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op3_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    planned = mixing.plan_mix(_table(spark, sf_dir, "documents"), Workspace(spark, "op3"))
    return planned.select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op3_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         md5('mix:' || coalesce(doc_id::VARCHAR, 'null:' || md5(coalesce(text, '')))) AS k
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS total, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM d GROUP BY source
), w AS (
  SELECT source, total, 1 + place % 3 AS w, 3 * total AS most, (SELECT sum(total) FROM s)::BIGINT AS grand, (SELECT sum(1 + place % 3) FROM s)::BIGINT AS weights FROM s
), o AS (
  SELECT *, coalesce(sum(most) OVER o, 0)::BIGINT AS stopped, coalesce(sum(w) OVER o, 0)::BIGINT AS stopped_w, row_number() OVER (ORDER BY most::DOUBLE / w, source NULLS LAST) AS i
  FROM w WINDOW o AS (ORDER BY most::DOUBLE / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT grand - stopped AS num, weights - stopped_w AS den, i AS first_free FROM o WHERE w * (grand - stopped)::DOUBLE / (weights - stopped_w) <= most ORDER BY i LIMIT 1
), t AS (
  SELECT source, total, CASE WHEN i < (SELECT first_free FROM level) THEN most::DOUBLE ELSE (w * (SELECT num FROM level))::DOUBLE / (SELECT den FROM level) END AS target FROM o
), p AS (
  SELECT doc_id, size, total AS source_size, target, floor(target)::BIGINT AS budget,
         (sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id NULLS FIRST, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT - size AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (CASE WHEN source_size > 0 THEN (budget // source_size) * size + greatest(0, least(size, budget % source_size - before)) ELSE 0 END)::BIGINT AS taken
FROM p
"""


@_query
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, sf_dir, "pages"), Workspace(spark, "op9"))


ORACLES["op9_url_rules"] = r"""
WITH RECURSIVE p AS (
  SELECT page_id, url, coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
         regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1) AS root, regexp_extract(url, '(?s)^.*?://[^/?#]*(/(?:[^?#]*/)?)', 1) AS folder,
         unnest([NULL, regexp_extract(regexp_extract(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>'), '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
                 regexp_extract(regexp_extract(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>'), '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1)]) AS link,
         unnest([0, 1, 2]) AS n
  FROM pages
), l AS (
  SELECT url AS a, CASE WHEN link LIKE '%://%' THEN link WHEN link LIKE '//%' THEN 'x:' || link WHEN link LIKE '/%' THEN root || link WHEN link LIKE '#%' THEN url
         WHEN link LIKE '?%' THEN regexp_extract(url, '(?s)^([^?#]*)', 1) || link ELSE root || CASE WHEN folder = '' THEN '/' ELSE folder END || link END AS b
  FROM p WHERE link <> ''
), u AS (SELECT url FROM p WHERE n = 0 UNION SELECT a FROM l UNION SELECT b FROM l), named AS (
  SELECT url, CASE WHEN h <> '' THEN h || CASE WHEN path = '' THEN '/' ELSE path END || q END AS node, h, path FROM (
    SELECT url, regexp_replace(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), ':(80|443)$', '') AS h,
           regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path, regexp_extract(url, '(?s)^[^#]*?(\?[^#]*)', 1) AS q FROM u)
), e AS (
  SELECT x.node AS a, y.node AS b FROM l JOIN named x ON x.url = l.a JOIN named y ON y.url = l.b WHERE x.node <> y.node
), both_ways AS (SELECT a, b FROM e UNION SELECT b, a FROM e), reach(a, b) AS (
  SELECT a, b FROM both_ways UNION SELECT r.a, s.b FROM reach r JOIN both_ways s ON r.b = s.a
), rules(kind, host, path) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
ruled AS (
  SELECT node, arg_max(kind, length(r.host || r.path)) AS kind FROM (SELECT DISTINCT node, h, CASE WHEN path = '' THEN '/' ELSE path END AS path FROM named WHERE node IS NOT NULL) n
  JOIN rules r ON (n.h = r.host OR n.h LIKE '%.' || r.host) AND starts_with(n.path, r.path) GROUP BY node
), classes AS (
  SELECT a AS node, CASE WHEN bool_or(kind = 'allow') THEN 'allow' WHEN bool_or(kind = 'block') THEN 'block' END AS verdict FROM reach JOIN ruled ON ruled.node = reach.b GROUP BY a
), own AS (
  SELECT p.page_id, p.url, p.host, p.path, r.host || r.path AS rule, r.kind, row_number() OVER (PARTITION BY p.page_id, p.url ORDER BY length(r.host || r.path) DESC) AS i
  FROM p LEFT JOIN rules r ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path) WHERE p.n = 0
)
SELECT page_id, o.host, o.path, rule, coalesce(kind, c.verdict, 'allow') AS verdict
FROM own o LEFT JOIN named n ON n.url = o.url LEFT JOIN classes c ON c.node = n.node WHERE i = 1
"""


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = Workspace(spark, "op2").path("tokens")
    token_store.write_tokens(_table(spark, sf_dir, "documents"), root, vocabulary("byte_bpe_50k.json"))
    return token_store.read_tokens(spark, root)


@_query
def op5_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.rate_quality(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


@_query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


ORACLES["op8_decontaminate"] = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS size, array_to_string(w[i : i + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM bw), hits AS (
  SELECT doc_id, i, x.size, item_id
  FROM (SELECT doc_id, s.size, i, array_to_string(w[i : i + s.size - 1], ' ') AS win FROM d, sizes s, unnest(range(1, greatest(len(w) - s.size + 1, 0) + 1)) AS u(i)) x JOIN bw USING (size, win)
), n AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id
), k AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN k USING (doc_id)
"""


@_query
def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    ws = Workspace(spark, "op1")
    warc.write_warc(_table(spark, sf_dir, "pages"), ws.path("warc"), ws)
    return warc.read_warc(spark, ws.path("warc")).drop("url")


_SHA1_BASE32 = "array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ('0b' || substr(bits, 1 + i * 5, 5))::INT, 1)), '')"
ORACLES["op1_warc"] = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), f AS (SELECT h, min(page_id) AS first FROM p GROUP BY h)
SELECT page_id, octet_length(encode(p.h))::BIGINT AS payload_bytes, {_SHA1_BASE32} AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, h, first, array_to_string(list_transform(range(40), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 1 + 4 * (strpos('0123456789abcdef', substr(sha1(p.h), 1 + i, 1)) - 1)::INT, 4)), '') AS bits FROM p JOIN f USING (h)) p
"""


@_query
def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(_table(spark, sf_dir, "documents"))


@_query
def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.find_licenses(_table(spark, sf_dir, "documents"))


@_query
def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedupe_lines(_table(spark, sf_dir, "documents"), Workspace(spark, "op6"))


ORACLES["op6_line_dedup"] = r"""
WITH RECURSIVE o AS (
  SELECT doc_id, line, i - 1 AS line_no FROM (SELECT doc_id, l[i] AS line, i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL), unnest(range(1, len(l) + 1)) AS u(i))
  WHERE translate(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') <> ''
), d AS (SELECT line, row_number() OVER (ORDER BY line) AS id, length(line) AS n FROM (SELECT DISTINCT line FROM o)), s AS (
  SELECT DISTINCT id, hash(substr(line, i, 5)) AS g FROM d, unnest(range(1, greatest(n - 4, 1) + 1)) AS u(i)
), sizes AS (SELECT id, count(*) AS n FROM s GROUP BY id), rarity AS (SELECT g, count(*) AS f FROM s GROUP BY g), p AS (
  SELECT id, g, n FROM (SELECT id, g, sizes.n, row_number() OVER (PARTITION BY id ORDER BY f, g) AS r FROM s JOIN rarity USING (g) JOIN sizes USING (id)) WHERE r <= n - ceil(0.8 * n) + 1
), c AS (
  SELECT DISTINCT a.id AS a, b.id AS b FROM p a JOIN p b USING (g) WHERE a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n)
), links AS (
  SELECT a, b FROM (SELECT c.a, c.b, count(*) AS common FROM c JOIN s x ON x.id = c.a JOIN s y ON y.id = c.b AND y.g = x.g GROUP BY ALL) JOIN sizes m ON m.id = a JOIN sizes n ON n.id = b
  WHERE 10 * common >= 8 * (m.n + n.n - common)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links), reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, l.b FROM reach r JOIN both_ways l ON r.b = l.a),
class AS (SELECT id, least(id, (SELECT min(b) FROM reach WHERE a = id)) AS class FROM d),
firsts AS (SELECT class, min({'d': doc_id, 'l': line_no}) AS place FROM o JOIN d USING (line) JOIN class USING (id) GROUP BY class),
kept AS (SELECT place.d AS doc_id, count(*) AS n_kept, string_agg(place.l::VARCHAR, ',' ORDER BY place.l) AS kept_lines FROM firsts GROUP BY 1),
counts AS (SELECT doc_id, count(line_no) AS n_lines FROM documents LEFT JOIN o USING (doc_id) GROUP BY doc_id)
SELECT doc_id, n_lines::BIGINT AS n_lines, coalesce(n_kept, 0)::BIGINT AS n_kept, coalesce(kept_lines, '') AS kept_lines FROM counts LEFT JOIN kept USING (doc_id)
"""


@_query
def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_ngrams(_table(spark, sf_dir, "documents"), Workspace(spark, "op7"))


ORACLES["op7_ngram_join"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM d WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM g a JOIN g b USING (gram) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 10 * common >= 8 * (x.n + y.n - common)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, least(d.doc_id, (SELECT min(b) FROM reach WHERE a = d.doc_id)) AS class_id, (SELECT count(*) FROM links WHERE a = d.doc_id)::BIGINT AS n_links FROM d
"""


@_query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # it imports this module

    return corpus_pipeline.run(spark, sf_dir)
