"""Grounded research contexts for a table of requests, and their JSON form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketloom.functions import text
from marketloom.operators import reads, search

COMPANY_FIELDS = ["ticker", "name", "description", "industry", "market_cap", "exchange"]
PRICE_FIELDS = ["ticker", "price_date", "open", "high", "low", "close", "volume", "vwap"]
NEWS_FIELDS = ["article_id", "title", "publisher", "published_at", "sentiment", "sentiment_reasoning", "article_url"]
EVIDENCE_FIELDS = [
    "article_id", "chunk_index", "chunk_text", "title", "publisher", "published_at", "article_url",
    "ticker", "sentiment", "sentiment_reasoning", "similarity",
]
VECTOR_NAMES = {"embedding", "vector", "query_embedding"}


def valid_requests(requests: DataFrame) -> DataFrame:
    """requests(request_id, ticker, question, query) with a valid ticker and question, normalized."""
    return (
        requests.withColumn("ticker", text.normalize_ticker(F.col("ticker")))
        .withColumn("question", text.question_text(F.col("question")))
        .filter("ticker IS NOT NULL AND question IS NOT NULL")
    )


def _ordered_array(df: DataFrame, by: str, order: str, fields: list[str], name: str) -> DataFrame:
    """Bounded groups (a limit was applied before) as one ordered array of structs per key."""
    items = F.sort_array(F.collect_list(F.struct(order, F.struct(*fields).alias("item"))))
    return df.groupBy(by).agg(F.transform(items, lambda x: x["item"]).alias(name))


def research_context(
    requests: DataFrame,
    companies: DataFrame,
    prices: DataFrame,
    articles: DataFrame,
    article_tickers: DataFrame,
    chunks: DataFrame,
    semantic_top_k: int = 8,
    recent_news_limit: int = 5,
    price_history_limit: int = 30,
) -> DataFrame:
    """One row per valid request: company, latest prices, newest news, diversified evidence.

    Prices and links are cut to the requested tickers first, then to each ticker's newest rows.
    """
    asked = valid_requests(requests)
    tickers = asked.select("ticker").distinct()
    evidence_limit = search.clamp_top_k(semantic_top_k)

    company = companies.select("ticker", F.struct(*COMPANY_FIELDS).alias("company"))
    price_rows = reads.recent_prices(reads.of_tickers(prices, tickers, "price_date"), price_history_limit)
    price = _ordered_array(price_rows, "ticker", "position", PRICE_FIELDS, "prices")

    linked = reads.of_tickers(article_tickers, tickers, "article_id")
    news_rows = reads.recent_news(articles, linked, recent_news_limit, related=False)
    news = _ordered_array(news_rows, "ticker", "rank", NEWS_FIELDS, "recent_news")

    hits = search.search_batch_by_ticker(asked, chunks, article_tickers, search.candidate_limit(evidence_limit))
    kept = search.diversify(hits, evidence_limit)
    described = search.describe_hits(kept, chunks, articles).withColumnRenamed("publisher_name", "publisher")
    evidence = _ordered_array(described, "request_id", "position", EVIDENCE_FIELDS, "semantic_evidence")

    out = (
        asked.select("request_id", "ticker", "question")
        .join(company, "ticker", "left")
        .join(price, "ticker", "left")
        .join(news, "ticker", "left")
        .join(evidence, "request_id", "left")
    )
    return out.select(
        "request_id",
        "ticker",
        "question",
        "company",
        *[
            F.coalesce(c, F.array().cast(out.schema[c].dataType)).alias(c)
            for c in ("prices", "recent_news", "semantic_evidence")
        ],
    )


def context_counts(contexts: DataFrame) -> DataFrame:
    """How much of each part a context holds."""
    return contexts.select(
        "request_id",
        "ticker",
        F.when(F.col("company").isNotNull(), 1).otherwise(0).alias("company_count"),
        F.size("prices").alias("price_count"),
        F.size("recent_news").alias("news_count"),
        F.size("semantic_evidence").alias("evidence_count"),
    )


def strip_vectors(df: DataFrame) -> DataFrame:
    """Drop vector fields (by name, any case) at every depth of structs and arrays."""
    return df.select(
        *[
            _without_vectors(F.col(f"`{f.name}`"), f.dataType).alias(f.name)
            for f in df.schema.fields
            if f.name.lower() not in VECTOR_NAMES
        ]
    )


def _without_vectors(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.ArrayType) and _holds_vectors(dtype.elementType):
        return F.transform(c, lambda x: _without_vectors(x, dtype.elementType))
    if isinstance(dtype, T.StructType) and _holds_vectors(dtype):
        kept = [
            _without_vectors(c[f.name], f.dataType).alias(f.name)
            for f in dtype.fields
            if f.name.lower() not in VECTOR_NAMES
        ]
        return F.when(c.isNotNull(), F.struct(*kept))
    return c


def _holds_vectors(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _holds_vectors(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(f.name.lower() in VECTOR_NAMES or _holds_vectors(f.dataType) for f in dtype.fields)
    return False


def _iso_seconds(c: Column) -> Column:
    """Date and time with microseconds where there are any."""
    fraction = F.date_format(c, ".SSSSSS")
    return F.concat(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss"), F.when(fraction == ".000000", "").otherwise(fraction))


def json_safe(c: Column, dtype: T.DataType) -> Column:
    """Decimals, dates and timestamps as strings (ISO), at every depth; other values as they are."""
    if isinstance(dtype, T.DecimalType):
        return c.cast("string")
    if isinstance(dtype, T.DateType):
        return F.date_format(c, "yyyy-MM-dd")
    if isinstance(dtype, T.TimestampType):
        return F.concat(_iso_seconds(c), F.date_format(c, "xxx"))
    if isinstance(dtype, T.TimestampNTZType):
        return _iso_seconds(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: json_safe(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        return F.when(
            c.isNotNull(), F.struct(*[json_safe(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
        )
    return c


def context_json(contexts: DataFrame) -> DataFrame:
    """(request_id, json) with null fields kept, as the web boundary returns it."""
    body = F.struct(
        *[json_safe(F.col(f.name), f.dataType).alias(f.name) for f in contexts.schema.fields if f.name != "request_id"]
    )
    return contexts.select("request_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("json"))
