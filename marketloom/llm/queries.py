"""The registered queries of the corpus operators; each covers its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketloom.llm import align, bpe, forest, html, licenses, minhash, packing, resample, sharding, suffix, topk, toxicity, urls
from marketloom.llm.common import table
from marketloom.session import apply_runtime_conf

import public_tokenizers

ORACLES: dict[str, str] = {}


def op1_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= toxicity.CUT).cast("int").alias("predicted")
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    done = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN), path)
    return done.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html")).select(
        "page_id", "url", F.col("main_text").alias("text"), F.length("main_text").cast("bigint").alias("n_chars")
    )


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_vector_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_vectors(table(spark, sf_dir, "embeddings"))


def op11_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return align.align(table(spark, sf_dir, "documents"), *paths)


# The rules the query's contract lists.
URL_RULES = (
    ("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/"),
)


def op12_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.filter_urls(table(spark, sf_dir, "pages").select("page_id", "url"), URL_RULES).drop("url")


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES["op3_sharding"] = f"""
WITH RECURSIVE h AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS n_bytes,
         CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS hash
  FROM documents),
b AS (
  SELECT doc_id, n_bytes, hash, 0 AS depth, CAST(0 AS BIGINT) AS cell,
         sum(n_bytes) OVER () AS shard_bytes, count(*) OVER () AS shard_rows FROM h
  UNION ALL
  SELECT doc_id, n_bytes, hash, depth + 1, hash >> ({sharding.BITS} - depth - 1),
         sum(n_bytes) OVER (PARTITION BY hash >> ({sharding.BITS} - depth - 1)),
         count(*) OVER (PARTITION BY hash >> ({sharding.BITS} - depth - 1))
  FROM b WHERE shard_bytes > {sharding.LIMIT} AND depth < {sharding.BITS})
SELECT doc_id, CAST(n_bytes AS BIGINT) AS n_bytes, CAST(depth AS INTEGER) AS depth,
       CASE WHEN depth = 0 THEN '' ELSE right(bin(cell + (CAST(1 AS BIGINT) << depth)), depth) END AS shard,
       CAST(shard_bytes AS BIGINT) AS shard_bytes, shard_rows
FROM b WHERE shard_bytes <= {sharding.LIMIT} OR depth = {sharding.BITS}"""

ORACLES["op9_topk"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLES["op10_vector_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach(n, r) AS (SELECT a, b FROM l UNION SELECT reach.n, l.b FROM reach JOIN l ON l.a = reach.r),
c AS (SELECT n, min(r) AS r FROM reach GROUP BY n),
d AS (SELECT a, count(*) AS k FROM l GROUP BY a)
SELECT vec_id, coalesce(k, 0) AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(r, vec_id)) AS kept
FROM embeddings LEFT JOIN d ON d.a = vec_id LEFT JOIN c ON c.n = vec_id"""

_BUILDS = [
    op1_minhash_dedup, op2_suffix_dedup, op3_sharding, op4_toxicity, op5_license_scan, op6_bpe, op7_html_text,
    op8_packing, op9_topk, op10_vector_dedup, op11_align, op12_url_filter, op13_resample, pipeline,
]


def _with_settings(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(apply_runtime_conf(spark), sf_dir)


QUERIES = {f.__name__: _with_settings(f) for f in _BUILDS}
