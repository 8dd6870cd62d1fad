"""Registered queries of this subpackage and the SQL that must give the same rows."""

from __future__ import annotations

import public_tokenizers

import corpus_pipeline
from tabproof.llm.bpe import token_digests
from tabproof.llm.clustering import cluster
from tabproof.llm.decontaminate import contamination
from tabproof.llm.exact_dedup import exact_duplicates
from tabproof.llm.html_extract import extract_pages
from tabproof.llm.mixing import mix_sources
from tabproof.llm.near_dedup import near_duplicates
from tabproof.llm.quality import classify_quality
from tabproof.llm.secrets import scan_secrets
from tabproof.llm.substring_dedup import repeat_digests
from tabproof.llm.topk_search import search
from tabproof.llm.url_filter import filter_urls
from tabproof.llm.whitening import whiten

#: The tokenizer file of op6.
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def _table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_html_extract(spark, sf_dir):
    return extract_pages(_table(spark, sf_dir, "pages"))


def op2_substring_dedup(spark, sf_dir):
    return repeat_digests(_table(spark, sf_dir, "documents"))


def op3_quality(spark, sf_dir):
    return classify_quality(_table(spark, sf_dir, "documents"))


def op4_exact_dedup(spark, sf_dir):
    return exact_duplicates(_table(spark, sf_dir, "documents"))


OP4_SQL = r"""
    WITH t AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm
        FROM documents
    ), g AS (
        SELECT *, first_value(doc_id) OVER w AS keep_id,
               count(*) OVER (PARTITION BY norm) AS group_size
        FROM t WINDOW w AS (PARTITION BY norm ORDER BY n DESC, doc_id NULLS LAST)
    )
    SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept,
           sha256(norm) AS text_sha256
    FROM g
"""


def op5_secret_scan(spark, sf_dir):
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op6_bpe(spark, sf_dir):
    return token_digests(_table(spark, sf_dir, "documents"), TOKENIZER)


def op7_url_filter(spark, sf_dir):
    return filter_urls(_table(spark, sf_dir, "pages"))


# The pages' links are taken from the same attributes; the closure walks them both ways.
OP7_SQL = r"""
    WITH RECURSIVE u AS (
        SELECT page_id, html, coalesce(url, '') AS url,
               translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
               regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path,
               regexp_extract(coalesce(url, ''), '(?s)^([^#]*)', 1) AS node
        FROM pages
    ), tag AS (
        SELECT node, unnest(regexp_extract_all(html, '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM u
    ), attribute AS (
        SELECT node, tag, regexp_extract(tag, '(?is)[\s"''/]rel\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c']) AS rel,
               regexp_extract(tag, '(?is)[\s"''/]href\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c']) AS href,
               regexp_extract(tag, '(?is)[\s"''/]http-equiv\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c']) AS equiv,
               regexp_extract(tag, '(?is)[\s"''/]content\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s"''>]+))', ['a', 'b', 'c']) AS content
        FROM tag
    ), link AS (
        SELECT DISTINCT node, href.a || href.b || href.c AS target FROM attribute
        WHERE tag ILIKE '<link%' AND list_contains(
            string_split_regex(lower(rel.a || rel.b || rel.c), '\s+'), 'canonical')
        UNION
        SELECT node, regexp_extract(content.a || content.b || content.c,
                                    '(?is)\burl\s*=\s*["'']?([^"''>\s]+)', 1) FROM attribute
        WHERE tag ILIKE '<meta%' AND trim(lower(equiv.a || equiv.b || equiv.c)) = 'refresh'
    ), edge AS (
        SELECT node AS a, regexp_extract(target, '(?s)^([^#]*)', 1) AS b FROM link WHERE target != ''
        UNION
        SELECT regexp_extract(target, '(?s)^([^#]*)', 1), node FROM link WHERE target != ''
    ), reach AS (
        SELECT a, b FROM edge
        UNION
        SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a
    ), judged AS (
        SELECT *, CASE
            WHEN (host = 'example.net' OR suffix(host, '.example.net')) AND starts_with(path, '/en/') THEN 'example.net/en/'
            WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/de/') THEN 'example.com/de/'
            WHEN (host = 'org' OR suffix(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
            WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/') THEN 'net/'
        END AS rule
        FROM u
    ), said AS (
        SELECT *, CASE rule WHEN 'example.net/en/' THEN 'allow' WHEN 'org/fr/' THEN 'allow'
                            WHEN 'example.com/de/' THEN 'block' WHEN 'net/' THEN 'block' END AS by_rule
        FROM judged
    ), aliased AS (
        SELECT DISTINCT r.a AS node FROM reach r JOIN said s ON s.node = r.b WHERE s.by_rule = 'block'
    )
    SELECT page_id, host, path, rule,
           coalesce(by_rule, CASE WHEN node IN (SELECT node FROM aliased) THEN 'block' END, 'allow') AS verdict
    FROM said
"""


def op8_mixing(spark, sf_dir):
    return mix_sources(_table(spark, sf_dir, "documents"))


OP8_SQL = r"""
    WITH d AS (
        SELECT doc_id, source, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'text:' || md5(coalesce(text, '')))) AS draw,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
        FROM documents
    ), s AS (
        SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
               row_number() OVER (ORDER BY source NULLS LAST) AS place
        FROM d GROUP BY source
    ), w AS (
        SELECT *, CAST([5, 2, 1][1 + (place - 1) % 3] AS DOUBLE) AS weight,
               CAST(source_size AS DOUBLE) * 3 AS most
        FROM s
    ), l AS (
        SELECT *, most / weight AS ratio,
               (sum(CAST(source_size AS DOUBLE)) OVER ()
                - coalesce(sum(most) OVER before, 0)) / (sum(weight) OVER ()
                - coalesce(sum(weight) OVER before, 0)) AS level
        FROM w
        WINDOW before AS (ORDER BY most / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), t AS (
        SELECT source, source_size, least(most, weight * (
            SELECT level FROM l WHERE level <= ratio ORDER BY ratio, place LIMIT 1)) AS target
        FROM l
    ), r AS (
        SELECT d.*, source_size, target,
               row_number() OVER (PARTITION BY d.source ORDER BY size, draw, doc_id) AS place,
               CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS share,
               CAST('0x' || substr(md5('mix:source:' || coalesce(d.source, '')), 1, 8) AS BIGINT)
                   / 4294967296.0 AS start
        FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
    ), c AS (
        SELECT *, CAST(floor(place * share + start) - floor((place - 1) * share + start) AS BIGINT) AS copies
        FROM r
    )
    SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM c
"""


def op9_near_dedup(spark, sf_dir):
    return near_duplicates(_table(spark, sf_dir, "documents"))


def op10_topk_search(spark, sf_dir):
    """Every document whose id is divisible by 50, as a query against all documents."""
    docs = _table(spark, sf_dir, "documents")
    queries = docs.where("doc_id % 50 = 0").select(docs["doc_id"].alias("query_id"), "text")
    return search(docs, queries)


def op11_clustering(spark, sf_dir):
    return cluster(_table(spark, sf_dir, "embeddings"))


def _op11_round(n: int) -> str:
    """Assignment to the centroids before round ``n``, and the centroids after it."""
    return f"""
    a{n} AS MATERIALIZED (
        SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
        FROM (SELECT v.r, k.c, sum((v.x - k.x) * (v.x - k.x)) AS d
              FROM v JOIN c{n} k USING (j) GROUP BY v.r, k.c)
        GROUP BY r
    ), c{n + 1} AS MATERIALIZED (
        SELECT k.c, j, coalesce(m.x, k.x) AS x
        FROM c{n} k LEFT JOIN (
            SELECT c, j, CAST((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS BIGINT) AS x
            FROM v JOIN a{n} USING (r) GROUP BY c, j) m USING (c, j)
    ),"""


OP11_SQL = f"""
    WITH e AS (
        SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
    ), w AS (
        SELECT r, vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS j
        FROM e WHERE len(embedding) = 64
    ), v AS MATERIALIZED (
        SELECT r, vec_id, j, CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT) AS x FROM w
        WHERE r NOT IN (SELECT r FROM w WHERE x IS NULL OR NOT isfinite(x))
    ), f AS (
        SELECT r, row_number() OVER (ORDER BY sha256('1:' || coalesce(CAST(vec_id AS VARCHAR), ''))) - 1 AS c
        FROM (SELECT DISTINCT r, vec_id FROM v)
    ), c0 AS MATERIALIZED (
        SELECT c, j, x FROM v JOIN f USING (r) WHERE c < 16
    ), {"".join(_op11_round(n) for n in range(4))} s AS (
        SELECT c, sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY j)) AS centroid_sha256 FROM c3 GROUP BY c
    )
    SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
           CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia,
           CAST(sum(d) OVER () AS BIGINT) AS inertia, centroid_sha256
    FROM a3 JOIN s USING (c) JOIN e USING (r)
"""


def op12_whitening(spark, sf_dir):
    return whiten(_table(spark, sf_dir, "embeddings"))


def op13_decontaminate(spark, sf_dir):
    return contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
    WITH d AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM documents
    ), b AS (
        SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
        FROM benchmark
    ), g AS (
        SELECT DISTINCT item, least(len(w), 10) AS n, w[i:i + least(len(w), 10) - 1] AS gram
        FROM (SELECT *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) AS i FROM b WHERE len(w) > 0)
    ), o AS (
        SELECT r, n, i, w[i:i + n - 1] AS gram
        FROM (SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i
              FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)
    ), f AS (
        SELECT o.r, o.i, o.n, g.item FROM o JOIN g ON o.n = g.n AND o.gram = g.gram
    ), h AS (
        SELECT r, count(DISTINCT k) AS n_hit
        FROM (SELECT r, unnest(range(i, i + n)) AS k FROM f) GROUP BY r
    ), t AS (
        SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT r, item FROM f) GROUP BY r
    )
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
           coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
           n_hit IS NOT NULL AS contaminated
    FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


QUERIES = {f.__name__: f for f in (
    op1_html_extract, op2_substring_dedup, op3_quality, op4_exact_dedup, op5_secret_scan, op6_bpe, op7_url_filter, op8_mixing,
    op9_near_dedup, op10_topk_search, op11_clustering, op12_whitening,
    op13_decontaminate)}
QUERIES["pipeline"] = corpus_pipeline.run
ORACLES = {
    "op4_exact_dedup": OP4_SQL,
    "op7_url_filter": OP7_SQL,
    "op8_mixing": OP8_SQL,
    "op11_clustering": OP11_SQL,
    "op13_decontaminate": OP13_SQL,
}
