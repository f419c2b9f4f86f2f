"""The table of registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketloom.session import apply_runtime_conf
from registry.bindings import Data

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``build(data) -> DataFrame`` under ``name``, with its DuckDB text if it has one."""

    def register(build: Callable[[Data], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(Data(apply_runtime_conf(spark), sf_dir))

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register


def joined(c: str | Column) -> Column:
    """An array as comma-joined text."""
    return F.array_join(c, ",")


def r6(c: str | Column) -> Column:
    return F.round(c, 6)
