"""Data-quality checks over whole tables."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketloom.functions import text
from marketloom.schemas import FOREIGN_KEYS, PRIMARY_KEYS, TABLES

# The messages a failing summary is reported with.
NO_SINGLE_COMPANY = "expected exactly one company row"
NO_PRICES = "expected at least one price row"
NO_ARTICLES = "expected at least one associated news article"
DUPLICATE_LINKS = "ticker associations contain duplicate article relationships"


def stock_data_errors(summary: DataFrame) -> DataFrame:
    """(ticker, error) for every expectation a summary row breaks."""
    errors = F.array_compact(
        F.array(
            F.when(F.col("company_count") != 1, F.lit(NO_SINGLE_COMPANY)),
            F.when(F.col("price_count") < 1, F.lit(NO_PRICES)),
            F.when(F.col("distinct_news_articles") < 1, F.lit(NO_ARTICLES)),
            F.when(F.col("news_associations") != F.col("distinct_news_articles"), F.lit(DUPLICATE_LINKS)),
        )
    )
    return summary.select("ticker", F.explode(errors).alias("error"))


def _result(table: str, rule: str, violations: DataFrame) -> DataFrame:
    """(table_name, rule_name, violations) from a one-column count."""
    return violations.select(
        F.lit(table).alias("table_name"), F.lit(rule).alias("rule_name"), F.col("violations").cast("long")
    )


def duplicate_keys(df: DataFrame, table: str, keys: Sequence[str]) -> DataFrame:
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return _result(table, "primary_key", counted.agg(F.count(F.lit(1)).alias("violations")))


def orphans(df: DataFrame, table: str, key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Rows whose parent is missing; the parent key is unique, so the hot side is the streamed one."""
    missing = df.filter(F.col(key).isNotNull()).join(
        parent.select(F.col(parent_key).alias(key)), key, "left_anti"
    )
    return _result(table, f"foreign_key:{key}", missing.agg(F.count(F.lit(1)).alias("violations")))


def row_rules(df: DataFrame, table: str, rules: dict[str, Column]) -> DataFrame:
    """Count rows that break each rule (True = broken) in one pass over the table."""
    counts = df.agg(*[F.count_if(F.coalesce(broken, F.lit(False))).alias(f"r{i}") for i, broken in enumerate(rules.values())])
    pairs = F.array(
        *[F.struct(F.lit(name).alias("rule_name"), F.col(f"r{i}").alias("violations")) for i, name in enumerate(rules)]
    )
    return counts.select(F.explode(pairs).alias("_p")).select(
        F.lit(table).alias("table_name"), "_p.rule_name", F.col("_p.violations").cast("long").alias("violations")
    )


def check_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, rule_name, violations) of every declared constraint of the given tables, in one pass: primary_key (keys that
    several rows have), not_null:<column> (rows without it), foreign_key:<column> (rows whose parent is missing, where the parent is given).

    Each table is scanned once. A row gives one tagged key per constraint it takes part in, as the one that holds the key or as
    the one that refers to it; keys are counted together, before the shuffle first, so a key that very many
    rows share costs no single task. Rows with a NULL in a key break not_null and no other rule.
    """
    spark = next(iter(tables.values())).sparkSession
    rules: list[tuple[str, str]] = []
    tagged: list[DataFrame] = []

    def cell(table: str, rule: str, key: Column, rows: int, parent: int) -> Column:
        return F.struct(
            F.lit(table).alias("table_name"), F.lit(rule).alias("rule_name"), key.alias("key"),
            F.lit(rows).alias("rows"), F.lit(parent).alias("parent"),
        )

    for name, df in tables.items():
        keys = [F.col(k).cast("string") for k in PRIMARY_KEYS[name]]
        whole = F.when(~F.exists(F.array(*keys), lambda k: k.isNull()), F.to_json(F.array(*keys)))
        cells = [cell(name, "primary_key", whole, 1, 0)]
        rules.append((name, "primary_key"))
        for f in TABLES[name].fields:
            if not f.nullable and f.name in df.columns:
                cells.append(cell(name, f"not_null:{f.name}", F.when(F.col(f.name).isNull(), F.lit("")), 1, 0))
                rules.append((name, f"not_null:{f.name}"))
        for child, (column, parent, parent_key) in FOREIGN_KEYS.items():
            if child in tables and parent in tables:
                if child == name:
                    cells.append(cell(child, f"foreign_key:{column}", F.col(column).cast("string"), 1, 0))
                    rules.append((child, f"foreign_key:{column}"))
                if parent == name:
                    cells.append(cell(child, f"foreign_key:{column}", F.col(parent_key).cast("string"), 0, 1))
        tagged.append(df.select(F.inline(F.filter(F.array(*cells), lambda c: c["key"].isNotNull()))))
    every = tagged[0]
    for more in tagged[1:]:
        every = every.unionAll(more)
    counted = every.groupBy("table_name", "rule_name", "key").agg(F.sum("rows").alias("rows"), F.max("parent").alias("parent"))
    rule, n = F.col("rule_name"), F.col("rows")
    broken = (
        F.when(rule == "primary_key", (n > 1).cast("long"))
        .when(rule.startswith("not_null:"), n)
        .otherwise(F.when(F.col("parent") == 0, n).otherwise(0))
    )
    sums = counted.groupBy("table_name", "rule_name").agg(F.sum(broken).cast("long").alias("violations"))
    declared = spark.createDataFrame(rules, "table_name string, rule_name string")
    return declared.join(sums, ["table_name", "rule_name"], "left").select(
        "table_name", "rule_name", F.coalesce("violations", F.lit(0).cast("long")).alias("violations")
    )


def split_tickers(df: DataFrame, column: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """(rows with a valid, normalized ticker, rows without)."""
    valid = text.normalize_ticker(F.col(column))
    return df.filter(valid.isNotNull()).withColumn(column, valid), df.filter(valid.isNull())


def require_tickers(df: DataFrame, column: str = "ticker") -> DataFrame:
    """Normalized tickers; one invalid ticker fails the whole batch when it is written."""
    valid = text.normalize_ticker(F.col(column))
    checked = F.when(valid.isNotNull(), valid).otherwise(F.raise_error(F.lit("The batch holds an invalid ticker.")))
    return df.withColumn(column, checked)


def not_upper(column: str) -> Column:
    return F.col(column) != F.upper(column)


def set_differences(expected: DataFrame, actual: DataFrame, key: str) -> DataFrame:
    """(side, key): keys expected but missing, and present but unexpected, sorted."""
    e, a = expected.select(key), actual.select(key)
    missing = e.subtract(a).select(F.lit("missing").alias("side"), key)
    unexpected = a.subtract(e).select(F.lit("unexpected").alias("side"), key)
    return missing.unionByName(unexpected).orderBy("side", key)


def table_differences(spark: SparkSession, table_names: Iterable[str] | None = None) -> DataFrame:
    """Missing and unexpected tables of the current catalog database (or of the given names)."""
    if table_names is None:
        table_names = [t.name for t in spark.catalog.listTables() if not t.isTemporary]
    schema = "table_name string"
    expected = spark.createDataFrame([(name,) for name in TABLES], schema)
    actual = spark.createDataFrame([(name,) for name in table_names], schema)
    return set_differences(expected, actual, "table_name")
