"""Helpers shared by the corpus operators: written intermediate tables, byte chunks, 64-bit mixing."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from marketloom.session import shared_dir

CHUNK_BYTES = 1 << 20
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder the cluster names and read back: lineage ends there,
    and lost executors cost only the tasks that read it. The write's shuffle files go when it is done; otherwise
    they stay beside what follows until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/llm/{uuid.uuid4().hex}/{name}"
    before = spark.conf.get(SHUFFLE_CLEANUP, None)
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        if before is None:
            spark.conf.unset(SHUFFLE_CLEANUP)
        else:
            spark.conf.set(SHUFFLE_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null is empty."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]


def chunks(values: list[bytes], limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes (or one row), so that work arrays stay small."""
    start = size = 0
    for i, v in enumerate(values):
        if i > start and size + len(v) > limit:
            yield start, i
            start, size = i, 0
        size += len(v)
    if start < len(values):
        yield start, len(values)


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finalizer: spreads every input bit over the 64 output bits."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def seeds(n: int, salt: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(salt << 32)) * np.uint64(0x9E3779B97F4A7C15))


class Rolling:
    """Polynomial hashes of byte strings modulo 2**64 over random letter values, from prefix sums."""

    BASE = 0x5851F42D4C957F2B  # odd, so it has an inverse
    LETTERS = seeds(256, 11)

    def __init__(self) -> None:
        self.power = self.inverse = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.power) < n:
            size = max(n, 2 * len(self.power))
            back = pow(self.BASE, -1, 1 << 64)
            for name, base in (("power", self.BASE), ("inverse", back)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))

    def prefixes(self, data: np.ndarray) -> np.ndarray:
        self._grow(len(data) + 1)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.LETTERS[data] * self.power[: len(data)], dtype=np.uint64, out=out[1:])
        return out

    def spans(self, prefixes: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Mixed hash of data[start:end] for each pair; the length takes part."""
        raw = (prefixes[end] - prefixes[start]) * self.inverse[start]
        return mix(raw + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


ROLLING = Rolling()
