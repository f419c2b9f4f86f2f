"""Every registered query against its DuckDB text at the smallest scale, and the plans' shape."""

import pytest

import __spark_entry__ as e
from oracle_check import compare, duck
from registry.catalog import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_STAGES = {  # text spans, character references, embedding models and batch scoring are the only Python on executors
    "chunk_articles", "replace_chunks", "embed_chunks", "embed_queries",
    "semantic_search_batch", "approx_semantic_search", "diversify_evidence", "research_context",
    "research_context_json", "semantic_search_service", "extract_articles", "resolve_content",
}


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_matches_duckdb(spark, con, name):
    text, _, _, ok = compare(spark, con, name, QUERIES[name], ORACLES.get(name), SF)
    assert ok, text


def test_only_approximate_search_has_no_sql():
    assert set(QUERIES) - set(ORACLES) == {"approx_semantic_search"}


@pytest.mark.parametrize("name", list(QUERIES))
def test_plans_stay_in_the_jvm_and_never_cross_join(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    python = any(stage in plan for stage in ("MapInPandas", "ArrowEvalPython", "BatchEvalPython", "FlatMap"))
    assert python == (name in PYTHON_STAGES)


def test_entry(spark):
    assert e.entry(spark).count() > 0


def test_prices_and_links_are_reduced_as_narrow_lines(spark, tmp_path, monkeypatch):
    """The lines' own columns are sorted and shuffled, not decimals and texts made from them; the last write of a key still wins."""
    import datetime as dt

    from registry.bindings import Data

    day = dt.datetime(1998, 3, 1)
    lines = [  # order, part, supplier, line, quantity, price, discount, tax, flag, status, date
        (1, 5, 7, 1, 1.0, 10.0, 0.1, 0.01, "N", "O", day), (2, 5, 7, 1, 2.0, 20.5, 0.2, 0.02, "R", "F", day.replace(hour=9)),
        (2, 5, 7, 2, 3.0, 30.25, 0.3, None, "A", "F", day), (2, 4, 7, 2, 9.0, 90.0, 0.3, 0.0, "A", "F", day),
        (3, 1, None, 1, 4.0, 40.0, None, 0.0, None, "O", day), (3, 1, 8, 1, 5.0, None, 0.0, 0.0, "R", "O", None), (3, 1, 8, 3, 6.0, 60.0, 0.0, 0.0, "N", "O", None),
    ]
    schema = "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    spark.createDataFrame(lines, schema).write.parquet(str(tmp_path / "lineitem.parquet"))
    built = {}
    monkeypatch.setattr(Data, "stored", lambda self, name, build: built.setdefault(name, build()))
    d = Data(spark, str(tmp_path))
    prices = {r.ticker: (r.price_date, r.open, r.high, r.low, r.close, r.volume, r.vwap) for r in d.prices().selectExpr(
        "ticker", "price_date", *[f"CAST({c} AS double) AS {c}" for c in ("open", "high", "low", "close", "volume", "vwap")]).collect()}
    assert prices == {
        "S7": (day.date(), None, 31.25, 30.25, 30.25, 3.0, 0.3), None: (day.date(), 0.0, 41.0, None, 40.0, 4.0, None), "S8": (None, 0.0, 61.0, None, 60.0, 6.0, 0.0),
    }
    assert {(r.article_id, r.ticker, r.sentiment, r.sentiment_reasoning) for r in d.article_tickers().collect()} == {
        ("1", "S7", None, "line 1"), ("2", "S7", "neutral", "line 2"), ("3", None, None, "line 1"), ("3", "S8", None, "line 3"),
    }
    for df in built.values():
        plan = df._jdf.queryExecution().executedPlan().toString()
        shuffles = [x for x in plan.splitlines() if "Exchange hashpartitioning" in x]
        assert shuffles and all("l_suppkey" in x and "ticker" not in x for x in shuffles)
