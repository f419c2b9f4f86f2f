"""Scans and writes of engine tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession


def read_table(
    spark: SparkSession,
    path: str,
    columns: Sequence[str | Column] | None = None,
    *,
    jdbc: dict[str, str] | None = None,
) -> DataFrame:
    """A pruned scan: Parquet by default, or the same table over JDBC.

    For JDBC ``path`` is the table name, and ``jdbc`` the reader options; give
    partitionColumn, lowerBound, upperBound and numPartitions so that the read is parallel.
    """
    if jdbc is None:
        df = spark.read.parquet(path)
    else:
        df = spark.read.format("jdbc").options(dbtable=path, **jdbc).load()
    return df.select(*columns) if columns else df


def append_rows(df: DataFrame, path: str, *, jdbc: dict[str, str] | None = None) -> None:
    """Append straight from the executors, one file or batch stream per task."""
    if jdbc is None:
        df.write.mode("append").parquet(path)
    else:
        df.write.format("jdbc").options(dbtable=path, **jdbc).mode("append").save()


def write_new(df: DataFrame, path: str) -> None:
    """Write the next state of a table to a path that must not exist yet.

    A next state is computed from the current one, so it is never written over the files
    it reads; callers keep one path per state.
    """
    df.write.mode("errorifexists").parquet(path)
