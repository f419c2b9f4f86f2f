"""Embedding columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from marketloom.schemas import EMBEDDING_DIMENSION

# Distances are compared at 12 decimals, so the order does not depend on summation order.
DISTANCE_DECIMALS = 12


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b) in double precision; NULL when either vector has no length. Both are read in one fold."""

    def add(sums: Column, pair: Column) -> Column:
        x, y = pair["x"], pair["y"]
        return F.struct((sums["ab"] + x * y).alias("ab"), (sums["aa"] + x * x).alias("aa"), (sums["bb"] + y * y).alias("bb"))

    def cosine(sums: Column) -> Column:
        return F.try_divide(sums["ab"], F.sqrt(sums["aa"]) * F.sqrt(sums["bb"]))

    pairs = F.zip_with(a, b, lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y")))
    none = F.struct(F.lit(0.0).alias("ab"), F.lit(0.0).alias("aa"), F.lit(0.0).alias("bb"))
    return F.round(F.lit(1.0) - F.aggregate(pairs, none, add, cosine), DISTANCE_DECIMALS)


def similarity(distance: Column) -> Column:
    """Cosine distance to a similarity inside [-1, 1]; NULL for NULL, NaN and infinite input."""
    finite = F.abs(distance) < F.lit(float("inf"))
    return F.when(finite, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 1.0 - distance)))


def is_valid_vector(v: Column, dimension: int = EMBEDDING_DIMENSION) -> Column:
    """Exact length, no NULL, NaN or infinite entries."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce((F.size(v) == dimension) & finite, F.lit(False))


def vector_text(v: Column) -> Column:
    """``[a,b,...]``; parsing it back gives the same numbers."""
    return F.concat(F.lit("["), F.array_join(F.transform(v, lambda x: x.cast("string")), ","), F.lit("]"))


def parse_vector(text: Column, element: str = "double") -> Column:
    return F.from_json(text, f"array<{element}>")
