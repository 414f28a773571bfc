"""The queries of this package for the driver's contract: one for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltstone.llm import encode, langid, lines, minhash, packing, pii, quality, tokenout, topk, urls
from siltstone.llm.common import load

Query = Callable[[SparkSession, str], DataFrame]


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantised(load(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return topk.exact_topk(vectors, topk.every_nth_query(vectors, 50), k=5)


OP1_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 256) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return packing.pack_documents(documents, path, public_tokenizers.PATTERN, end_id=2, capacity=1024)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents", "doc_id", "text", "source")
    cleaned = lines.drop_boilerplate(documents, host="source", text="text")
    n_lines, n_dropped = F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped")
    return cleaned.select("doc_id", n_lines, n_dropped, F.md5(F.col("text").cast("binary")).alias("text_md5"))


OP3_SQL = r"""
WITH space AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS s),
docs AS (SELECT row_number() OVER () AS k, doc_id, text, source FROM documents),
cut AS (SELECT k, source, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
line AS (SELECT k, source, line, i, trim(line, s) AS key FROM cut, space),
total AS (SELECT source, count(DISTINCT text) AS pages FROM docs GROUP BY source),
line_of AS (SELECT line.k, line.source, key, text FROM line JOIN docs USING (k)),
seen AS (SELECT source, key, count(DISTINCT text) AS n FROM line_of WHERE key <> '' GROUP BY source, key),
bad AS (
  SELECT seen.source, key FROM seen JOIN total ON seen.source IS NOT DISTINCT FROM total.source
  WHERE n >= 5 AND n > pages * CAST(0.01 AS DOUBLE)
), judged AS (
  SELECT line.k, line.line, i, line.key, bad.key IS NOT NULL AS dropped
  FROM line LEFT JOIN bad ON line.key = bad.key AND line.source IS NOT DISTINCT FROM bad.source
), page AS (
  SELECT k, count(*) FILTER (WHERE key <> '') AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '') AS clean
  FROM judged GROUP BY k
)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped,
       CASE WHEN text IS NOT NULL THEN md5(clean) END AS text_md5
FROM docs LEFT JOIN page USING (k)
"""

#: Fixed values of the contract.
RULES = (
    urls.Rule("allow", "org", "/"),
    urls.Rule("block", "example.org", "/es/"),
    urls.Rule("block", "example.org", "/en/1"),
    urls.Rule("allow", "com", "/fr/"),
    urls.Rule("block", "com", "/de/"),
)


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(load(spark, sf_dir, "pages", "page_id", "url", "html"), RULES)


OP4_SQL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'),
         ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), found AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '(?i)<link\b[^>]*>'),
      lambda t: regexp_matches(t, '(?i)\srel\s*=\s*["'']?canonical\b')),
      lambda t: regexp_extract(t, '(?i)\shref\s*=\s*["'']?([^"''\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(html, '(?i)<meta\b[^>]*>'),
      lambda t: regexp_matches(t, '(?i)\shttp-equiv\s*=\s*["'']?refresh\b')),
      lambda t: regexp_extract(t, '(?i);\s*url\s*=\s*[''"]?([^"''\s>]+)', 1)))) AS target
  FROM pages WHERE contains(url, '://') AND html IS NOT NULL
), cleaned AS (
  SELECT url, regexp_extract(url, '^(.*?://[^/?#]*)', 1) AS root, regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS own,
         regexp_replace(replace(replace(replace(replace(replace(target, '&quot;', '"'), '&#39;', ''''), '&#x27;', ''''), '&#38;', '&'), '&amp;', '&'), '#.*$', '') AS target
  FROM found WHERE target <> ''
), parts AS (
  SELECT *, regexp_replace(target, '\?.*$', '') AS rel, regexp_extract(target, '(\?.*)$', 1) AS rest FROM cleaned WHERE target <> ''
), paths AS (
  SELECT *, CASE WHEN starts_with(rel, '/') THEN rel WHEN rel = '' THEN own
    ELSE '/' || regexp_extract(own, '^/(.*/)?', 1) || rel END AS path FROM parts
), resolved AS (
  SELECT *, CASE WHEN NOT regexp_matches(path, '/\.\.?(/|$)') THEN path ELSE
    coalesce(nullif(list_reduce(list_prepend('', string_split(path, '/')[2:]),
      lambda acc, x: CASE x WHEN '..' THEN regexp_replace(acc, '/[^/]*$', '') WHEN '.' THEN acc ELSE acc || '/' || x END)
      || CASE WHEN string_split(path, '/')[-1] IN ('.', '..') THEN '/' ELSE '' END, ''), '/') END AS straight FROM paths
), whole AS (
  SELECT url, CASE WHEN regexp_matches(target, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN target
    WHEN starts_with(target, '//') THEN 'x:' || target ELSE root || straight || rest END AS target
  FROM resolved
), split AS (
  SELECT lower(regexp_extract(url, '://([^/?#]*)', 1)) AS h1, regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS p1,
         lower(regexp_extract(target, '://([^/?#]*)', 1)) AS h2, regexp_extract(target, '://[^/?#]*([^#]*)', 1) AS p2
  FROM whole
), nodes AS (
  SELECT '://' || h1 || CASE WHEN starts_with(p1, '/') THEN '' ELSE '/' END || p1 AS a,
         '://' || h2 || CASE WHEN starts_with(p2, '/') THEN '' ELSE '/' END || p2 AS b
  FROM split
), edges AS (
  SELECT a, b FROM nodes WHERE a <> b UNION SELECT b, a FROM nodes WHERE a <> b
), reach AS (
  SELECT a AS node, a AS other FROM edges UNION SELECT r.node, e.b FROM reach r JOIN edges e ON r.other = e.a
), others AS (
  SELECT DISTINCT other, lower(regexp_extract(other, '://([^/?#]*)', 1)) AS host,
         regexp_extract(other, '://[^/?#]*([^?#]*)', 1) AS path FROM reach
), other_rule AS (
  SELECT o.other, arg_max(r.verdict, length(r.host || r.path) * 2 + CAST(r.verdict = 'allow' AS INTEGER)) AS verdict
  FROM others o JOIN rules r ON (o.host = r.host OR ends_with(o.host, '.' || r.host)) AND starts_with(o.path, r.path)
  GROUP BY o.other
), spread AS (
  SELECT node FROM reach LEFT JOIN other_rule USING (other) GROUP BY node
  HAVING count(*) FILTER (WHERE verdict = 'block') > 0 AND count(*) FILTER (WHERE verdict = 'allow') = 0
), own AS (
  SELECT row_number() OVER () AS k, page_id, coalesce(lower(regexp_extract(url, '://([^/?#]*)', 1)), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path,
         '://' || lower(regexp_extract(url, '://([^/?#]*)', 1)) || CASE WHEN starts_with(regexp_extract(url, '://[^/?#]*([^#]*)', 1), '/') THEN '' ELSE '/' END
         || regexp_extract(url, '://[^/?#]*([^#]*)', 1) AS node
  FROM pages
), own_rule AS (
  SELECT o.k, arg_max(r.host || r.path, length(r.host || r.path) * 2 + CAST(r.verdict = 'allow' AS INTEGER)) AS rule,
         arg_max(r.verdict, length(r.host || r.path) * 2 + CAST(r.verdict = 'allow' AS INTEGER)) AS verdict
  FROM own o JOIN rules r ON (o.host = r.host OR ends_with(o.host, '.' || r.host)) AND starts_with(o.path, r.path)
  GROUP BY o.k
)
SELECT page_id, host, path, rule, coalesce(verdict, CASE WHEN s.node IS NOT NULL THEN 'block' END, 'allow') AS verdict
FROM own LEFT JOIN own_rule USING (k) LEFT JOIN spread s ON own.node = s.node
"""


#: Html for url_aliases: pages of every third id point to the next one's url, of every seventh to another by a refresh.
ALIAS_PAGES = """
SELECT p.page_id, p.url, concat(
  CASE WHEN p.page_id % 3 = 0 AND n.url IS NOT NULL THEN concat('<link rel="canonical" href="', n.url, '">') ELSE '' END,
  CASE WHEN p.page_id % 7 = 0 THEN '<meta http-equiv=refresh content="0; url=../de/x.html?a=1&amp;b=2">' ELSE '' END) AS html
FROM pages p LEFT JOIN (SELECT page_id - 1 AS k, min(url) AS url FROM pages GROUP BY page_id) n ON p.page_id = n.k
"""


def url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op4 over pages that are linked, so that components decide: the table's own html holds no redirects."""
    load(spark, sf_dir, "pages", "page_id", "url").createOrReplaceTempView("pages_of_url_aliases")
    return urls.judge_urls(spark.sql(ALIAS_PAGES.replace("FROM pages", "FROM pages_of_url_aliases")), RULES)


def op5_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digests(pii.find_personal_data(load(spark, sf_dir, "documents", "doc_id", "text")))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    return minhash.near_duplicates(documents, width=2, percent=80)


OP6_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
    ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM docs
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
    AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS node, doc_id AS other FROM sets UNION SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
), least_of AS (SELECT node, min(other) AS component_id FROM reach GROUP BY node)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least_of ON doc_id = node
"""


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify_languages(load(spark, sf_dir, "documents", "doc_id", "text", "lang"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(load(spark, sf_dir, "documents", "doc_id", "text"))


OP8_SQL = r"""
WITH c AS (SELECT ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13) AS space),
docs AS (SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS t FROM documents),
word AS (SELECT k, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM docs),
win AS (SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM word)),
twice AS (SELECT k, g FROM win GROUP BY k, g HAVING count(*) > 1),
spot AS (SELECT DISTINCT k, i + o AS p FROM win JOIN twice USING (k, g), (VALUES (0), (1), (2)) v(o)),
again AS (SELECT k, count(*) AS n FROM spot GROUP BY k),
line AS (SELECT k, l, translate(l, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS low FROM (SELECT k, unnest(string_split(t, chr(10))) AS l FROM docs) WHERE regexp_matches(l, '[^\x20\x09-\x0D]')),
judged AS (
  SELECT k, l, length(translate(l, space, '')) AS seen,
    NOT regexp_matches(rtrim(l, space), '[.!?…:;؟۔।॥።။។։。！？．｡]["''”’»)\]]*$')
    OR (len(regexp_extract_all(l, '!!')) >= 3 AND len(regexp_extract_all(l, '!!')) * 50 >= length(translate(l, space, '')))
    OR (len(regexp_extract_all(l, '[|•·]| [›»] ')) >= 3 AND len(regexp_extract_all(l, '[|•·]| [›»] ')) * 50 >= length(translate(l, space, '')))
    OR (len(regexp_extract_all(low, 'https?://|www\.')) >= 1 AND len(regexp_extract_all(low, 'https?://|www\.')) * 40 >= length(translate(l, space, '')))
    OR (len(regexp_extract_all(low, 'BOILERPLATE')) >= 1 AND len(regexp_extract_all(low, 'BOILERPLATE')) * 150 >= length(translate(l, space, '')))
    OR (length(l) - length(translate(l, '#*$%&|<>', ''))) * 100 > length(translate(l, space, '')) * 10 AS fails
  FROM line, c
), page AS (
  SELECT k, count(*) AS n_lines, count(*) - count(DISTINCT l) AS dup, count(*) FILTER (WHERE fails) AS n_failed, coalesce(sum(seen) FILTER (WHERE fails), 0) AS lost
  FROM judged GROUP BY k
), base AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, space, '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '#*$%&|<>', '')) AS BIGINT) AS n_symbols, CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines,
    CAST(coalesce(again.n, 0) AS BIGINT) AS n_repeat_words, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
    CAST(coalesce(n_failed, 0) AS BIGINT) AS n_failed_lines, CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars
  FROM docs JOIN word USING (k) LEFT JOIN again USING (k) LEFT JOIN page USING (k), c
)
SELECT *, n_words < 50 OR n_repeat_words * 100 > n_words * 50 AS base_failed,
  NOT (n_words < 50 OR n_repeat_words * 100 > n_words * 50) AND lost_chars * 100 <= word_chars * 50 AS kept
FROM base
""".replace("BOILERPLATE", "|".join(quality.BOILERPLATE))


def op9_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokenout.packed_sequences(documents, path, public_tokenizers.PATTERN, end_id=50_256, capacity=1024)


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    documents = load(spark, sf_dir, "documents", "doc_id", "text")
    return encode.round_trip_digests(documents, path, public_tokenizers.PATTERN, "doc_id", "text")


ALIAS_SQL = OP4_SQL.replace("WITH RECURSIVE rules", f"WITH RECURSIVE linked AS ({ALIAS_PAGES}), rules").replace("FROM pages WHERE", "FROM linked WHERE").replace("FROM pages\n), own_rule", "FROM linked\n), own_rule")
QUERIES: dict[str, Query] = {f.__name__: f for f in (op1_exact_topk, op2_best_fit_packing, op3_line_dedup, op4_url_filters, op5_personal_data, op6_near_duplicates, op7_language, op8_quality, op9_token_matrices, op10_byte_bpe, url_aliases)}
SQL: dict[str, str] = {"op1_exact_topk": OP1_SQL, "op3_line_dedup": OP3_SQL, "op4_url_filters": OP4_SQL, "url_aliases": ALIAS_SQL, "op6_near_duplicates": OP6_SQL, "op8_quality": OP8_SQL}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
