"""Registered queries of this subpackage: each operator with production
parameters over its whole table, and SQL where it can express the result."""

from __future__ import annotations

import string

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from opslake.llm.bpe_prefix import decode_documents, encode_documents
from opslake.llm.exact_dedup import exact_dedup
from opslake.llm.kd_sharding import kd_shards
from opslake.llm.language_id import language_id
from opslake.llm.lexical_scan import lexical_search
from opslake.llm.license_scan import license_scan
from opslake.llm.mixing import mixed_documents
from opslake.llm.ngram_join import ngram_join
from opslake.llm.packing import best_fit_packing
from opslake.llm.secret_scan import joined, secret_scan
from opslake.llm.topk_search import top_k
from opslake.llm.url_filter import url_filter
from opslake.llm.whitening import whiten


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"), k=3, per_mille=900).select("doc_id", "n_shingles", "component_id")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(_table(spark, sf_dir, "documents")).drop("spans")


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan(_table(spark, sf_dir, "documents"))

    def count(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long")

    return found.select("doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"), count("hex").alias("n_hex"),
                        F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op4_kd_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kd_shards(_table(spark, sf_dir, "documents"), 16)


def op5_temperature_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed_documents(_table(spark, sf_dir, "documents"), repetitions=2.0)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("toxic").alias("bad"))
    return url_filter(_table(spark, sf_dir, "pages"), labels).select("page_id", "host", "path", "rule", "verdict")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op8_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(_table(spark, sf_dir, "embeddings"), every=20, k=20, scale=64)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(_table(spark, sf_dir, "documents"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(_table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(_table(spark, sf_dir, "embeddings"), k=16, scale=64)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=50)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = decode_documents(encode_documents(_table(spark, sf_dir, "documents")))
    return coded.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_ngram_jaccard_join, op2_license_scan, op3_secret_scan, op4_kd_sharding, op5_temperature_mixing, op6_url_filter,
    op7_exact_dedup, op8_topk_search, op9_best_fit_packing, op10_language_id,
    op11_embedding_whitening, op12_lexical_search, op13_byte_bpe)}

ORACLE = {
    "op1_ngram_jaccard_join": rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)]) END AS g
  FROM words),
grams AS (SELECT doc_id, len(g) AS n, unnest(g) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM grams a JOIN grams b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS doc, doc_id AS other FROM sets
          UNION SELECT reach.doc, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT s.doc_id, len(s.g)::BIGINT AS n_shingles, r.component_id
FROM sets s JOIN (SELECT doc, min(other) AS component_id FROM reach GROUP BY doc) r ON r.doc = s.doc_id""",
    "op7_exact_dedup": r"""
WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS chars,
                  regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
best AS (SELECT norm, arg_max(doc_id, (chars, -doc_id)) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, best.keep_id, best.group_size, t.doc_id = best.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN best ON t.norm = best.norm""",
    "op8_topk_search": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
      FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS place FROM s)
SELECT query_id, place::INTEGER AS rank, vec_id, score FROM r WHERE place <= 20""",
    "op12_lexical_search": rf"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
size AS (SELECT count(*) AS docs, sum(len(w))::BIGINT AS words FROM t WHERE len(w) > 0),
tf AS (SELECT doc_id, len(w) AS n, x AS term, count(*) AS tf FROM (SELECT doc_id, w, unnest(w) AS x FROM t) GROUP BY doc_id, w, x),
weight AS (SELECT term, floor(1000 * ln((2 * size.docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w
           FROM tf, size GROUP BY term, size.docs),
item AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(
           translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS term
         FROM benchmark),
scores AS (
  SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // words))))::BIGINT AS score
  FROM item JOIN tf USING (term) JOIN weight USING (term), size GROUP BY item_id, doc_id),
r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS place FROM scores WHERE score > 0)
SELECT item_id, place::INTEGER AS rank, doc_id, score FROM r WHERE place <= 50""",
}
