"""Relational reads, for every key at once; a single key is a filter on the result or the input."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marketloom.functions import text


def latest_rows(df: DataFrame, by: Sequence[str], order: Sequence[Column], limit: int, rank: str = "rank") -> DataFrame:
    """The first ``limit`` rows of each group.

    The planner keeps at most ``limit`` rows per group and task before the shuffle, so a hot
    group never arrives in one task as a whole.
    """
    w = W.partitionBy(*by).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= limit)


TICKER_SLICES = 32


def of_tickers(rows: DataFrame, tickers: DataFrame, slice_by: str | None = None) -> DataFrame:
    """The rows of the given tickers.

    The planner copies a list that it measures to be small. A longer one is joined on (ticker, slice),
    so that the rows of a hot ticker are dealt over the slices of their ``slice_by``, or else of the task that reads them.
    """
    slices = F.sequence(F.lit(0), F.lit(TICKER_SLICES - 1))
    wanted = tickers.select("ticker").distinct().withColumn("_slice", F.explode(slices))
    own = F.xxhash64(slice_by) if slice_by else F.spark_partition_id()
    sliced = rows.withColumn("_slice", F.pmod(own, F.lit(TICKER_SLICES)).cast("int"))
    return sliced.join(wanted, ["ticker", "_slice"], "left_semi").drop("_slice")


def company_lookup(requests: DataFrame, companies: DataFrame) -> DataFrame:
    """requests(request_id, ticker) -> one envelope row each: ok, not_found or validation_error."""
    fields = ["name", "description", "market_cap", "industry", "exchange"]
    asked = requests.select("request_id", text.normalize_ticker(F.col("ticker")).alias("ticker"))
    found = asked.join(companies.select("ticker", *fields, F.lit(True).alias("_found")), "ticker", "left")
    error = F.when(F.col("ticker").isNull(), F.lit("validation_error")).when(
        F.col("_found").isNull(), F.lit("not_found")
    )
    return found.select(
        "request_id",
        error.isNull().alias("ok"),
        F.when(error.isNull(), F.struct("ticker", *fields)).alias("data"),
        F.when(error.isNotNull(), F.struct(error.alias("type"))).alias("error"),
    )


BIN_DAYS = 64


def price_range(prices: DataFrame, bounds: DataFrame) -> DataFrame:
    """bounds(request_id, ticker, start, end) -> the prices inside, both ends inclusive, NULL = open.

    Dates fall into bins of 64 days. A price has one bin, bounds have those they touch, cut to the days there are prices
    for; both meet on (ticker, bin), so a ticker with very many prices or bounds is dealt over its bins.
    """
    day = F.col("price_date")

    def bin_of(c: Column) -> Column:
        return F.floor(F.unix_date(c) / BIN_DAYS).cast("int")

    first, last = prices.agg(F.min("price_date")).scalar(), prices.agg(F.max("price_date")).scalar()
    asked = bounds.withColumns({"_from": F.greatest("start", first), "_to": F.least("end", last)}).filter("_from <= _to")
    asked = asked.withColumn("_bin", F.explode(F.sequence(bin_of(F.col("_from")), bin_of(F.col("_to")))))
    joined = prices.withColumn("_bin", bin_of(day)).join(asked, ["ticker", "_bin"])
    return joined.filter(day.between(F.col("_from"), F.col("_to"))).drop("start", "end", "_from", "_to", "_bin")


def recent_prices(prices: DataFrame, limit: int = 30) -> DataFrame:
    """Each ticker's latest ``limit`` prices; ``position`` counts them oldest to newest."""
    if not 1 <= limit <= text.MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {text.MAX_LIMIT}.")
    latest = latest_rows(prices, ["ticker"], [F.col("price_date").desc()], limit)
    oldest_first = F.row_number().over(W.partitionBy("ticker").orderBy("price_date"))
    return latest.withColumn("position", oldest_first).drop("rank")


def related_tickers(article_tickers: DataFrame) -> DataFrame:
    """article_id -> sorted array of its tickers.

    (article_id, ticker) is the key of the input, so an array is no longer than the ticker
    universe; callers that need a few articles restrict the input first.
    """
    return article_tickers.groupBy("article_id").agg(F.sort_array(F.collect_set("ticker")).alias("tickers"))


def with_related_tickers(rows: DataFrame, article_tickers: DataFrame) -> DataFrame:
    """Add the tickers array of each row's article, empty when it has none."""
    return rows.join(related_tickers(article_tickers), "article_id", "left").withColumn(
        "tickers", F.coalesce("tickers", F.array().cast("array<string>"))
    )


NEWEST = (F.desc_nulls_last, "published_at"), (F.asc, "article_id")


def newest_first() -> list[Column]:
    return [make(name) for make, name in NEWEST]


def recent_news(articles: DataFrame, article_tickers: DataFrame, limit: int = 25, related: bool = True) -> DataFrame:
    """Each ticker's newest ``limit`` articles with that ticker's sentiment.

    Ranking moves keys and timestamps only; the article columns join the survivors.
    """
    if not 1 <= limit <= text.MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {text.MAX_LIMIT}.")
    dated = article_tickers.join(articles.select("article_id", "published_at"), "article_id")
    ranked = latest_rows(dated, ["ticker"], newest_first(), limit).drop("published_at")
    rows = ranked.join(articles, "article_id")
    if not related:
        return rows
    shown = article_tickers.join(ranked.select("article_id").distinct(), "article_id", "left_semi")
    return with_related_tickers(rows, shown)


def watchlist_listing(watchlists: DataFrame, tickers: DataFrame) -> DataFrame:
    """(user_id, ticker, added_at) of every watchlist, a user's rows together and ordered by ticker."""
    rows = watchlists.select(F.col("id").alias("watchlist_id"), "user_id", "name").join(tickers, "watchlist_id")
    return rows.select("user_id", "name", "ticker", "added_at").repartition("user_id").sortWithinPartitions("user_id", "ticker")


def stock_summary(companies: DataFrame, prices: DataFrame, articles: DataFrame, article_tickers: DataFrame, headlines: int = 3) -> DataFrame:
    """Per company: row counts, price dates, article counts and its newest headlines."""
    company = companies.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("company_count"), F.max("name").alias("name"), F.max("exchange").alias("exchange")
    )
    price = prices.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("price_count"),
        F.min("price_date").alias("minimum_price_date"),
        F.max("price_date").alias("maximum_price_date"),
    )
    # an article counts at its first link to the ticker and its first row: marked in the join's own sorts, so no task holds a table of pairs
    by_ticker = W.partitionBy("article_id").orderBy("ticker")
    new_link = F.row_number().over(by_ticker) == F.rank().over(by_ticker)
    first_row = F.row_number().over(W.partitionBy("article_id").orderBy("published_at")) == 1
    linked = article_tickers.select("article_id", "ticker", new_link.alias("_new")).join(
        articles.select("article_id", "published_at", first_row.alias("_first")), "article_id"
    )
    news = linked.groupBy("ticker").agg(
        F.count(F.lit(1)).alias("news_associations"),
        F.count_if(F.col("_new") & F.col("_first")).alias("distinct_news_articles"),
        F.max("published_at").alias("newest_published_at"),
    )
    newest = recent_news(articles, article_tickers, headlines)
    top = newest.groupBy("ticker").agg(
        F.sort_array(F.collect_list(F.struct("rank", "title", "published_at", "sentiment", "tickers"))).alias("articles")
    )  # at most `headlines` per ticker
    zero = F.lit(0).cast("long")
    joined = (
        company.join(price, "ticker", "full_outer").join(news, "ticker", "full_outer").join(top, "ticker", "left")
    )
    counts = ["company_count", "price_count", "news_associations", "distinct_news_articles"]
    return joined.withColumns({c: F.coalesce(F.col(c), zero) for c in counts})
