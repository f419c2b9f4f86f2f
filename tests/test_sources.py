import datetime as dt
import json

from pyspark.sql import functions as F

from marketloom.sources import landed, tables

NEWS = {
    "id": "n1", "title": " Title ", "description": 5, "publisher": {"name": "Pub"}, "published_utc": "2024-01-02T03:04:05Z",
    "keywords": ["a", " ", 3, " b "], "tickers": ["aapl", "MSFT", "nvda", "bad ticker"],
    "insights": [
        {"ticker": "MSFT", "sentiment": "negative"}, {"ticker": "AAPL", "sentiment": "positive", "sentiment_reasoning": "r"},
        {"ticker": "GOOG", "sentiment": " "}, 7, {"ticker": "MSFT", "sentiment": "neutral"}, {"sentiment": "x"},
    ],
}


def payloads(spark, *rows):
    return spark.createDataFrame([(json.dumps(r) if not isinstance(r, str) else r,) for r in rows], "payload string")


def test_news_and_relationship_merge_order(spark):
    out = landed.normalize_news(payloads(spark, NEWS, {**NEWS, "id": " "}, {**NEWS, "published_utc": "2024-01-02T03:04:05"}, {**NEWS, "publisher": " P ", "published_utc": ""}, "[]")).collect()
    assert [r.reject_reason for r in out] == [None, "missing id", "invalid published_utc", None, "missing id"]
    assert (out[0].title, out[0].description, out[0].publisher, out[0].keywords) == ("Title", None, "Pub", ["a", "b"])
    assert (out[3].publisher, out[3].published_at) == ("P", None)
    assert [tuple(x) for x in out[0].relationships] == [
        ("AAPL", "positive", "r"), ("MSFT", "neutral", None), ("NVDA", None, None), ("GOOG", None, None),
    ]


def test_company(spark):
    rows = [
        ("X", json.dumps({"results": {"ticker": "aapl", "name": " Apple ", "market_cap": 123.5, "active": "yes", "list_date": "2020-01-02", "sic_code": 5, "sic_description": "Phones"}})),
        ("brk.b", json.dumps({"results": {"name": "B", "active": True, "list_date": ""}})),
        ("Y", json.dumps({"results": []})),
        ("Z", json.dumps({"results": {"name": "z", "list_date": "1999-99-99"}})),
    ]
    out = landed.normalize_companies(spark.createDataFrame(rows, "ticker string, payload string")).collect()
    assert (out[0].ticker, out[0].name, out[0].legal_name, str(out[0].market_cap), out[0].active, out[0].sic_code, out[0].industry) == (
        "AAPL", "Apple", "Apple", "123.5000", None, None, "Phones",
    )
    assert (out[1].ticker, out[1].active, out[1].list_date, out[1].reject_reason) == ("BRK.B", True, None, None)
    assert [r.reject_reason for r in out[2:]] == ["invalid company response", "invalid list_date"]


def test_price_bars_and_range(spark):
    bars = {"results": [{"t": 1577941200000, "o": 1, "c": 2.5, "v": 100}, {"t": 1578027600000, "c": 3}, {"t": "x"}, {"t": True}]}
    df = spark.createDataFrame([("aapl", json.dumps(bars))], "ticker string, payload string")
    every = landed.normalize_price_bars(df).orderBy("bar_pos").collect()
    assert [r.price_date for r in every] == [dt.date(2020, 1, 2), dt.date(2020, 1, 3), None, None]
    assert [r.reject_reason for r in every] == [None, None, "bar without timestamp", "bar without timestamp"]
    day = F.lit("2020-01-03").cast("date")
    kept = landed.accepted(landed.normalize_price_bars(df, day, day)).collect()
    assert [(r.ticker, str(r.close)) for r in kept] == [("AAPL", "3.000000")]


def pages(spark, *rows):
    return spark.createDataFrame([(r, n, json.dumps(p)) for r, n, p in rows], "request_id int, page_no int, payload string")


def results(df):
    return {(r.request_id, r.result_no, r.result, r.reject_reason) for r in df.collect()}


def test_pages_stop_and_reject(spark):
    a, b, c, d = ({"v": i} for i in range(4))
    df = pages(
        spark,
        (1, 1, {"results": [a, b], "next_url": "u1"}), (1, 2, {"results": [c], "next_url": "u2"}), (1, 3, {"results": [d]}), (1, 4, {"results": [a]}),
        (2, 1, {"results": [a], "next_url": "u"}), (2, 2, {"results": [a], "next_url": "u"}), (2, 3, {"results": []}),
        (3, 1, {"results": [3]}), (4, 1, {"next_url": 5}), (5, 1, {"results": [a], "next_url": ""}), (5, 2, {"results": [b]}),
    )
    got = results(landed.collect_pages(df))
    assert {g for g in got if g[0] == 1} == {(1, i + 1, json.dumps({"v": i}, separators=(",", ":")), None) for i in range(4)} - {(1, 5, None, None)}
    assert {g[0] for g in got if g[3]} == {2, 3, 4}
    assert {g[1] for g in got if g[0] == 5} == {1}
    limited = results(landed.collect_pages(df, max_results=1))
    assert {g[0] for g in limited if g[3]} == {3, 4} and {g[1] for g in limited if g[0] == 2} == {1}
    assert {g[1] for g in results(landed.collect_pages(df, max_pages=2)) if g[0] == 1} == {1, 2, 3}


def test_newest_per_request(spark):
    rows = [(1, f"a{i}", dt.datetime(2024, 1, i + 1)) for i in range(5)] + [(1, "z", None)]
    df = spark.createDataFrame(rows, "request_id int, article_id string, published_at timestamp")
    assert [r.article_id for r in landed.newest_per_request(df, ["request_id"], 2).orderBy("article_id").collect()] == ["a3", "a4"]
    after = F.lit("2024-01-04").cast("timestamp")
    assert landed.newest_per_request(df, ["request_id"], 100, after).count() == 2


def test_scan_prunes_and_pushes(spark, tmp_path):
    df = spark.createDataFrame([("a", 0, None), ("b", 1, [1.0])], "article_id string, chunk_index int, embedding array<float>")
    tables.append_rows(df, str(tmp_path / "t"))
    tables.append_rows(df, str(tmp_path / "t"))
    read = tables.read_table(spark, str(tmp_path / "t"), ["article_id"]).filter("article_id = 'a'")
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert read.count() == 2 and "EqualTo(article_id,a)" in plan and "chunk_index" not in plan.split("ReadSchema")[1]
