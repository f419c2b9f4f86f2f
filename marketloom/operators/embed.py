"""Text embedding in Arrow batches, one model per task."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F, types as T

from marketloom.functions import text, vectors
from marketloom.operators import content
from marketloom.schemas import EMBEDDING_DIMENSION, VECTOR
from marketloom.sources.versions import VersionedTable

SENTENCES = 256  # texts that a model sees at a time, so that its work arrays don't grow with the Arrow batch

STORE_SCHEMA = T.StructType([
    T.StructField("article_id", T.StringType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("embedding", VECTOR),
    T.StructField("embedding_model", T.StringType()),
])


class Model(Protocol):
    """What an embedding model offers (the sentence-transformers calling convention)."""

    def encode(self, sentences: list[str], *, convert_to_numpy: bool, normalize_embeddings: bool) -> np.ndarray: ...


ModelFactory = Callable[[], Model]


class HashingModel:
    """Offline default: signed feature hashing of lower-cased words.

    A word's md5 gives its bucket (first 8 hex digits) and its sign (9th digit, below 8 is +).
    """

    name = "feature-hash-md5"

    def __init__(self, dimension: int = EMBEDDING_DIMENSION) -> None:
        self.dimension = dimension
        self._place = lru_cache(maxsize=50_000)(self._hash)

    def _hash(self, word: str) -> tuple[int, float]:
        digest = hashlib.md5(word.encode("utf-8", "surrogatepass"), usedforsecurity=False).hexdigest()
        return int(digest[:8], 16) % self.dimension, 1.0 if digest[8] < "8" else -1.0

    def encode(self, sentences: list[str], *, convert_to_numpy: bool = True, normalize_embeddings: bool = True) -> np.ndarray:
        words = [s.lower().split(" ") for s in sentences]
        places = [self._place(w) for sentence in words for w in sentence]
        row = np.repeat(np.arange(len(sentences)), [len(w) for w in words])
        bucket = np.fromiter((p[0] for p in places), dtype=np.int64, count=len(places))
        sign = np.fromiter((p[1] for p in places), dtype=np.float64, count=len(places))
        out = np.bincount(row * self.dimension + bucket, weights=sign, minlength=len(sentences) * self.dimension)
        out = out.reshape(len(sentences), self.dimension)
        if normalize_embeddings:
            norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
            out = np.divide(out, norms, out=out, where=norms > 0)
        return out


def embed(df: DataFrame, text_column: str, keys: Sequence[str], model_factory: ModelFactory = HashingModel, dimension: int = EMBEDDING_DIMENSION, output: str = "embedding", partitions: int | None = None) -> DataFrame:
    """(keys, text) -> (keys, vector). Blank text has no vector and is left out.

    The model is made once per task and sees at most SENTENCES normalized texts at a time; a vector of the
    wrong length or with a non-finite value fails the job. ``partitions`` spreads the rows evenly
    by key first, worth its shuffle when the model costs more than moving the text.
    """
    normalized = df.select(*keys, text.collapse_ws(F.col(text_column)).alias("_text"))
    if partitions is not None:
        normalized = normalized.repartition(partitions, *keys)
    schema = T.StructType([*normalized.drop("_text").schema.fields, T.StructField(output, VECTOR, False)])


    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = model_factory()
        for batch in batches:
            batch = batch[batch["_text"] != ""]
            for first in range(0, len(batch), SENTENCES):
                part = batch.iloc[first : first + SENTENCES]
                made = np.asarray(model.encode(part["_text"].tolist(), convert_to_numpy=True, normalize_embeddings=True))
                if made.shape != (len(part), dimension) or not np.isfinite(made).all():
                    raise ValueError("The embedding model returned an unusable vector.")
                yield part.drop(columns="_text").assign(**{output: list(made.astype("float32"))})

    return normalized.mapInPandas(run, schema)


def run_embed_job(
    chunks: DataFrame, store: VersionedTable, run: str, model_factory: ModelFactory = HashingModel, dimension: int = EMBEDDING_DIMENSION,
    model: str = HashingModel.name, max_chunks: int | None = None,
) -> DataFrame:
    """Embed the chunks that have no vector, once per ``run``, append (article_id, chunk_index, embedding, embedding_model) to ``store``,
    and report on it. The model sees each chunk in one pass, the write; the metrics read what was written."""
    work = content.unembedded_chunks(chunks)
    if max_chunks is not None:
        work = content.next_chunks(work, max_chunks)
    if run not in store.version().runs:
        made = embed(work, "chunk_text", ["article_id", "chunk_index"], model_factory, dimension)
        store.append(made.withColumn("embedding_model", F.lit(model)), run)
    return embed_metrics(work, store.read_run(run), dimension)


def embed_metrics(eligible: DataFrame, written: DataFrame, dimension: int = EMBEDDING_DIMENSION) -> DataFrame:
    """One row: chunks eligible, written with a valid vector, and of those the ones that are still waiting for it."""
    valid = written.filter(vectors.is_valid_vector(F.col("embedding"), dimension))
    keys = ["article_id", "chunk_index"]
    persisted = valid.select(*keys).join(eligible.select(*keys), keys, "left_semi").agg(F.count(F.lit(1))).scalar()
    return eligible.agg(F.count(F.lit(1)).alias("eligible_count")).select(
        "eligible_count", valid.agg(F.count(F.lit(1))).scalar().alias("embedded_count"), persisted.alias("persisted_count")
    )
