"""The corpus pipeline: toxic documents go, near copies go, repeated passages go, the rest is packed."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from marketloom.llm import minhash, packing, suffix, toxicity
from marketloom.llm.common import staged, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents scored below the cut, by a model fitted on these documents."""
    docs = docs.select(*COLUMNS)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model, column="toxicity")
    return scored.filter(F.col("toxicity") < toxicity.CUT).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies, that with the smallest id, and one row of those that repeat an id
    and a text. Rows that repeat an id with other texts stay or go together. Rows without an id are compared with
    nothing and all stay."""
    docs = docs.select(*COLUMNS)
    kept = minhash.near_duplicates(docs).filter("kept").select("doc_id")
    named = docs.filter("doc_id is not null")
    again = named.groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1").select("doc_id")
    again = staged(again, "again")
    rest = F.min(F.struct("lang", "source", "n_chars")).alias("rest")
    one = named.join(again, "doc_id", "left_semi").groupBy("doc_id", "text").agg(rest).select("doc_id", "text", "rest.*")
    rows = named.join(again, "doc_id", "left_anti").unionByName(one)
    return rows.join(kept, "doc_id", "left_semi").select(*COLUMNS).unionAll(docs.filter("doc_id is null"))


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages an earlier one has. Bytes of a character that was cut apart go, too, and no others;
    n_chars follows the text. A document that loses all its bytes stays with an empty text, and so does a null
    text. Rows without an id come neither before nor after others and keep their text."""
    done = suffix.remove_repeats(docs, carry=("lang", "source"), whole=True).withColumn("text", F.col("kept").cast("string"))
    unnamed = docs.filter("doc_id is null").withColumn("text", F.coalesce("text", F.lit(""))).select(*COLUMNS)
    rows = done.withColumn("n_chars", F.lit(None).cast("bigint")).select(*COLUMNS).unionAll(unnamed)
    return rows.withColumn("n_chars", F.length("text").cast("bigint"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents in sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("minhash_dedup", drop_near_copies),
    ("suffix_dedup", drop_repeats),
    ("packing", pack),
]

ORACLE_SQL = None  # scores, components and token ids aren't SQL; tests/llm compares run() with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents, each written and read by the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
