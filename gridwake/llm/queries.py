"""The registered queries of the training-data operators.

``QUERIES``: name -> ``(spark, sf_dir) -> DataFrame`` over whole tables, with
production parameters. ``ORACLE_SQL``: DuckDB SQL where SQL can express one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from .decontaminate import contaminated
from .exact_dedup import exact_duplicates
from .hard_negatives import mine_embeddings
from .jaccard_join import jaccard_join
from .license_scan import license_scan
from .merkle import verify_tampering
from .order_minhash import order_fingerprints
from .packing import pack
from .quality import quality_scores
from .secrets import secret_scan
from .tables import read_table
from .token_counts import token_counts
from .toxicity import toxicity_scores
from .warc import derivatives


def op1_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(read_table(spark, sf_dir, "documents"), words=4, num=85, den=100)


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_fingerprints(read_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return derivatives(read_table(spark, sf_dir, "pages"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(read_table(spark, sf_dir, "documents"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(read_table(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_embeddings(read_table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify_tampering(read_table(spark, sf_dir, "documents"))


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(read_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_order_minhash": op2_order_minhash,
    "op3_toxicity": op3_toxicity,
    "op4_packing": op4_packing,
    "op5_decontaminate": op5_decontaminate,
    "op6_warc_derivatives": op6_warc_derivatives,
    "op7_token_counts": op7_token_counts,
    "op8_license_scan": op8_license_scan,
    "op9_quality": op9_quality,
    "op10_secret_scan": op10_secret_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_exact_dedup": op13_exact_dedup,
}

ORACLE_SQL = {
    "op1_jaccard_join": r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []
                      WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN range(1, len(w) - 2)]) END AS s
  FROM w),
n AS (SELECT doc_id, len(s) AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
c AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM e x JOIN e y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT c.a, c.b FROM c JOIN n p ON p.doc_id = c.a JOIN n q ON q.doc_id = c.b
  WHERE 100 * c.c >= 85 * (p.n + q.n - c.c)),
r AS (SELECT doc_id AS d, doc_id AS r FROM n UNION SELECT r.d, l.b FROM r JOIN l ON l.a = r.r)
SELECT n.doc_id, CAST(n.n AS BIGINT) AS n_shingles, m.component_id,
       coalesce(k.n_links, 0) AS n_links
FROM n JOIN (SELECT d, min(r) AS component_id FROM r GROUP BY d) m ON m.d = n.doc_id
LEFT JOIN (SELECT a, count(*) AS n_links FROM l GROUP BY a) k ON k.a = n.doc_id
""",
    "op11_hard_negatives": r"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * CAST(c AS DOUBLE)) FOR c IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len([c FOR c IN embedding IF c IS NULL OR NOT isfinite(c)]) = 0),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
p AS (
  SELECT a, b, score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
SELECT p.a AS anchor_id, p.b AS positive_id,
       CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.b) AS INTEGER) AS rank,
       n.b AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM p JOIN s n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
QUALIFY rank <= 5
""",
    "op12_merkle_manifest": r"""
WITH RECURSIVE d AS (
  SELECT *, coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
            || coalesce(octet_length(encode(source)) || ':' || source, '-')
            || coalesce(octet_length(encode(lang)) || ':' || lang, '-')
            || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS head,
         translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lower_text
  FROM documents),
l AS (
  SELECT doc_id, coalesce('=' || lang, '') AS t,
         sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(octet_length(encode(lower_text)) || ':' || lower_text, '-')) AS tampered
  FROM d),
crc_bytes AS (
  SELECT n AS b, list_reduce(list_prepend(n, range(8)),
           lambda c, i: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END)) AS v
  FROM range(256) r(n)),
crc_table AS (SELECT list(v ORDER BY b) AS v FROM crc_bytes),
crc AS (
  SELECT doc_id, xor(4294967295, list_reduce(list_prepend(4294967295,
           [CAST(ord(c) AS BIGINT) FOR c IN string_split(CAST(doc_id AS VARCHAR), '')]),
           lambda a, b: xor(a >> 8, v[1 + (xor(a, b) & 255)]))) AS crc
  FROM (SELECT DISTINCT doc_id FROM l WHERE doc_id IS NOT NULL), crc_table),
leaves AS (
  SELECT row_number() OVER () AS k, l.doc_id, t, leaf, CASE WHEN crc % 3 = 0 THEN tampered ELSE leaf END AS used,
         row_number() OVER (PARTITION BY t ORDER BY l.doc_id NULLS FIRST, leaf) - 1 AS idx
  FROM l LEFT JOIN crc ON crc.doc_id = l.doc_id),
nodes AS (
  SELECT t, 0 AS lvl, idx, leaf AS h FROM leaves
  UNION ALL
  SELECT t, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY t) AS c FROM nodes) WHERE c > 1 GROUP BY t, lvl, idx // 8),
tops AS (SELECT t, max(lvl) AS top, arg_max(h, lvl) AS subroot FROM nodes GROUP BY t),
walk AS (
  SELECT k, t, 0 AS lvl, idx, used AS h, '' AS proof FROM leaves
  UNION ALL
  SELECT w.k, w.t, w.lvl + 1, w.idx // 8,
         sha256(string_agg(CASE WHEN n.idx = w.idx THEN w.h ELSE n.h END, '' ORDER BY n.idx)),
         any_value(w.proof) || coalesce(string_agg(CASE WHEN n.idx <> w.idx THEN n.h END, '' ORDER BY n.idx), '')
  FROM walk w JOIN tops o ON o.t = w.t AND w.lvl < o.top
  JOIN nodes n ON n.t = w.t AND n.lvl = w.lvl AND n.idx // 8 = w.idx // 8
  GROUP BY w.k, w.t, w.lvl, w.idx),
upper_nodes AS (
  SELECT 0 AS lvl, row_number() OVER (ORDER BY t) - 1 AS idx, subroot AS h FROM tops
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER () AS c FROM upper_nodes) WHERE c > 1 GROUP BY lvl, idx // 8),
summit AS (SELECT max(lvl) AS top, arg_max(h, lvl) AS root FROM upper_nodes),
upper_walk AS (
  SELECT w.k, 0 AS lvl, o.idx, w.h, w.proof
  FROM walk w JOIN (SELECT t, top, row_number() OVER (ORDER BY t) - 1 AS idx FROM tops) o ON o.t = w.t AND w.lvl = o.top
  UNION ALL
  SELECT w.k, w.lvl + 1, w.idx // 8,
         sha256(string_agg(CASE WHEN n.idx = w.idx THEN w.h ELSE n.h END, '' ORDER BY n.idx)),
         any_value(w.proof) || coalesce(string_agg(CASE WHEN n.idx <> w.idx THEN n.h END, '' ORDER BY n.idx), '')
  FROM upper_walk w JOIN summit s ON w.lvl < s.top
  JOIN upper_nodes n ON n.lvl = w.lvl AND n.idx // 8 = w.idx // 8
  GROUP BY w.k, w.lvl, w.idx)
SELECT f.doc_id, f.leaf, o.subroot, s.root, sha256(u.proof) AS proof_sha256, u.h AS folded_root, u.h = s.root AS verified
FROM leaves f JOIN tops o ON o.t = f.t JOIN summit s ON true JOIN upper_walk u ON u.k = f.k AND u.lvl = s.top
""",
    "op13_exact_dedup": r"""
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW w AS (PARTITION BY coalesce(text, ''))
""",
}
