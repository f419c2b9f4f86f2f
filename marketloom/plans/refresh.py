"""Refresh of all landed tickers: normalize, keep each ticker's window, summarize."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.functions import dates, text
from marketloom.operators.reads import latest_rows, newest_first, of_tickers
from marketloom.session import materialize
from marketloom.sources import landed

NEWS_LIMIT = 5
SHOWN_TITLES = 3


def refresh(requests: DataFrame, company_payloads: DataFrame, bar_payloads: DataFrame, news_payloads: DataFrame):
    """requests(ticker, as_of) -> (companies, prices, news) inside each ticker's window.

    Tickers are normalized first, what isn't a ticker is dropped, and a ticker that is asked for more than
    once has one window, the latest.
    News payloads carry the ticker they were requested for; the newest five since the start of
    the price window are kept per ticker.
    """
    start, end = dates.price_window(F.col("as_of"))
    wanted = requests.select(text.normalize_ticker(F.col("ticker")).alias("ticker"), "as_of").filter("ticker IS NOT NULL")
    wanted = wanted.groupBy("ticker").agg(F.max("as_of").alias("as_of"))
    windows = materialize(wanted.select("ticker", start.alias("start_date"), end.alias("end_date")))
    # payloads stay where they are, or are dealt over a hot ticker's slices; only typed rows meet the windows
    companies = landed.accepted(landed.normalize_companies(of_tickers(company_payloads, windows)))
    bars = landed.accepted(landed.normalize_price_bars(of_tickers(bar_payloads, windows))).join(windows, "ticker")
    prices = bars.filter(F.col("price_date").between(F.col("start_date"), F.col("end_date"))).drop("start_date", "end_date")
    news = landed.accepted(landed.normalize_news(of_tickers(news_payloads, windows), keep=["ticker"])).join(windows, "ticker")
    recent = news.filter(F.to_date("published_at") >= F.col("start_date")).drop("start_date", "end_date")
    return companies, prices, latest_rows(recent, ["ticker"], newest_first(), NEWS_LIMIT), windows


def refresh_summary(companies: DataFrame, prices: DataFrame, news: DataFrame, windows: DataFrame) -> DataFrame:
    """One row per requested ticker: company, window, bar and article counts, first three titles."""
    bars = prices.groupBy("ticker").agg(F.count(F.lit(1)).alias("bars"))
    titles = F.sort_array(F.collect_list(F.struct("rank", text.preview_line(F.col("title")).alias("title"))))
    articles = news.groupBy("ticker").agg(  # at most NEWS_LIMIT rows per ticker
        F.count(F.lit(1)).alias("articles"),
        F.transform(F.slice(titles, 1, SHOWN_TITLES), lambda x: x["title"]).alias("titles"),
    )
    zero = F.lit(0).cast("long")
    return (
        windows.join(companies.select("ticker", "name", "exchange"), "ticker", "left")
        .join(bars, "ticker", "left")
        .join(articles, "ticker", "left")
        .select(
            "ticker", "start_date", "end_date", "name", "exchange",
            F.coalesce("bars", zero).alias("bars"),
            F.coalesce("articles", zero).alias("articles"),
            F.coalesce("titles", F.array().cast("array<string>")).alias("titles"),
        )
    )
