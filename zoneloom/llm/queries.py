"""The operators of this package as queries over the tables, with SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from zoneloom.llm.common import table
from zoneloom.llm.embedding_dedup import link_vectors
from zoneloom.llm.exact_dedup import exact_duplicates
from zoneloom.llm.filter_audit import audit
from zoneloom.llm.language import identify
from zoneloom.llm.ngram_join import near_groups
from zoneloom.llm.packing import pack
from zoneloom.llm.pieces import encoded_digests
from zoneloom.llm.quality import score_documents
from zoneloom.llm.ranked_search import search
from zoneloom.llm.sharding import assign_shards
from zoneloom.llm.simhash import fingerprint_documents
from zoneloom.llm.suffix_dedup import repeated_strings
from zoneloom.llm.url_filter import judge

VOCABULARY = "/opt/tokenizers/piece_bpe_32k.model"

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None):
    def add(fn):
        QUERIES[key] = fn
        if sql is not None:
            ORACLES[key] = sql
        return fn

    return add


@query("op1_suffix_dedup")
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_strings(table(spark, folder, "documents"))


@query("op4_exact_dedup", """
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)""")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return exact_duplicates(table(spark, folder, "documents"))


@query("op6_sharding")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return assign_shards(table(spark, folder, "documents"))


@query("op7_packing")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return pack(table(spark, folder, "documents"))


@query("op10_fingerprints")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprint_documents(table(spark, folder, "documents"))


@query("op5_ngram_join")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return near_groups(table(spark, folder, "documents"))


@query("op2_language")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return identify(table(spark, folder, "documents"))


@query("op3_url_filter")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return judge(table(spark, folder, "pages"))


@query("op8_pieces")
def op8(spark: SparkSession, folder: str, vocabulary: str = VOCABULARY) -> DataFrame:
    return encoded_digests(table(spark, folder, "documents"), vocabulary)


@query("op9_quality")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op11_embedding_dedup", """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS e,
         coalesce(len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
                  AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false) AS fine
  FROM embeddings),
links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM v a JOIN v b ON a.r <> b.r AND a.fine AND b.fine AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (SELECT r AS a, r AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
n AS (SELECT a AS r, count(*) AS n_links FROM links GROUP BY 1)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN least USING (r) LEFT JOIN n USING (r)""")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return link_vectors(table(spark, folder, "embeddings"))


@query("op12_filter_audit", """
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY 1),
m AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
         CASE WHEN len(w) < 100 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END
         + CASE WHEN min(d.doc_id) OVER (PARTITION BY t) < d.doc_id THEN 16 ELSE 0 END AS mask
  FROM d LEFT JOIN l ON d.doc_id = l.doc_id),
cells AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY 1, 2),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS f(c, bit)),
orders AS (
  SELECT a.c || b.c || c.c || d.c || e.c AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a JOIN f b ON b.c <> a.c JOIN f c ON c.c NOT IN (a.c, b.c) JOIN f d ON d.c NOT IN (a.c, b.c, c.c)
  JOIN f e ON e.c NOT IN (a.c, b.c, c.c, d.c)),
steps AS (
  SELECT filter_order, step::INT AS step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
  FROM orders, unnest(range(1, 6)) AS s(step)),
told AS (
  SELECT part, filter_order, step, bit,
         sum(CASE WHEN mask & (before | bit) = 0 THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM cells, steps GROUP BY 1, 2, 3, 4)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant,
       unique_fails::BIGINT AS unique_fails, good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM told""")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_ranked_search", """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
total AS (SELECT count(*) FILTER (len(w) > 0) AS n_docs, coalesce(sum(len(w)), 0)::BIGINT AS n_terms FROM d),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) GROUP BY 1, 2),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
weight AS (SELECT term, floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM tf, total GROUP BY term, n_docs),
scored AS (
  SELECT item_id, doc_id, d.r, sum(weight.w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * len(d.w) * n_docs) // n_terms))))::BIGINT AS score
  FROM i JOIN weight USING (term) JOIN tf USING (term) JOIN d ON d.r = tf.r, total GROUP BY 1, 2, 3),
ranked AS (SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST))::INT AS rank, doc_id, score
           FROM scored WHERE score > 0)
SELECT * FROM ranked WHERE rank <= 10""")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
