"""The registered queries of the training-data operators, with production parameters over whole tables, and their SQL where there is some."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, html_extract, lm_score, near_dedup, packing, substring_dedup, topk, toxicity, url_filters, warc
from ._common import crc_mod, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    """Place of a public tokenizer's file; the folder may be given by PUBLIC_TOKENIZERS."""
    if folder := os.environ.get("PUBLIC_TOKENIZERS"):
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


#: The rules of op8: host, path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.digest(table(spark, sf_dir, "documents"), n=20)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), n=10)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.search(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5, scale=256.0)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), least=0)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select("doc_id", F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score(table(spark, sf_dir, "documents"), crc_mod("doc_id", 5) == 1)


def op7_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), n=5, percent=75)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, rules = table(spark, sf_dir, "pages"), url_filters.Rules(URL_RULES)
    return url_filters.judge(pages, rules, url_filters.fit(pages, rules))


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"), counts=True)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_substring_dedup, op2_decontamination, op3_topk, op4_warc, op5_toxicity, op6_lm_score, op7_near_dedup, op8_url_filters, op9_html_extraction, op10_packing)}

#: op1: a window is removed if its first place is before it; places are (doc_id, start).
_OP1 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT r, coalesce(doc_id, 9223372036854775807) AS k, s, array_to_string(w[s:s + 19], ' ') AS g FROM (SELECT r, doc_id, w, unnest(generate_series(1, len(w) - 19)) AS s FROM d WHERE len(w) >= 20)),
f AS (SELECT g, min((k, s)) AS first FROM p GROUP BY g),
c AS (SELECT DISTINCT r, unnest(generate_series(s, s + 19)) AS i FROM p JOIN f USING (g) WHERE (k, s) <> first),
x AS (SELECT r, list(i) AS gone FROM c GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed, sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE list_filter(w, lambda v, i: NOT list_contains(gone, i)) END, ' ')) AS kept_sha256
FROM d LEFT JOIN x USING (r)
"""

#: op7: sets of distinct shingles, pairs that share one, links, then the smallest id that is reachable.
_OP7 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(len(w) - 4, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
b AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS m FROM s x JOIN s y USING (g) WHERE x.doc_id < y.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM b JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * m >= 75 * (p.n + q.n - m)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT a AS doc_id, a AS c FROM (SELECT DISTINCT a FROM e) UNION SELECT e.b, t.c FROM t JOIN e ON e.a = t.doc_id WHERE t.c < e.b),
c AS (SELECT doc_id, min(c) AS c FROM t GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(d.doc_id, coalesce(c, d.doc_id)) AS component_id, least(d.doc_id, coalesce(c, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""

#: op2: windows of each item, then every place of every document that equals one; words are 1-based.
_OP2 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
g AS (SELECT DISTINCT item_id, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS gram, least(len(w), 10) AS n FROM (SELECT item_id, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
p AS (SELECT r, n, s, array_to_string(w[s:s + n - 1], ' ') AS gram FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM g) WHERE len(w) >= n)),
h AS (SELECT p.r, p.s, p.n, g.item_id FROM p JOIN g USING (gram, n)),
c AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(generate_series(s, s + n - 1)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids FROM h GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (r) LEFT JOIN t USING (r)
"""

_OP3 = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 50 = 0),
r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

#: op4: base32 by five bits of the hex digest at a time.
_OP4 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT h, min(page_id) AS first, sha1(h) AS x FROM p GROUP BY h),
g AS (SELECT h, first, array_to_string(list_transform(generate_series(0, 31), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((16 * (strpos('0123456789abcdef', substr(x, 1 + (5 * i) // 4, 1)) - 1) + strpos('0123456789abcdef', substr(x, 2 + (5 * i) // 4, 1)) - 1) >> (3 - (5 * i) % 4)) & 31)::INTEGER, 1)), '') AS b FROM f)
SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes, b AS payload_digest, CASE WHEN first IS NULL OR first IS NOT DISTINCT FROM page_id THEN 'response' ELSE 'revisit' END AS record_type,
CASE WHEN first IS DISTINCT FROM page_id THEN first END AS refers_to FROM p JOIN g USING (h)
"""

ORACLE: dict[str, str] = {"op1_substring_dedup": _OP1, "op2_decontamination": _OP2, "op3_topk": _OP3, "op4_warc": _OP4, "op7_near_dedup": _OP7}
