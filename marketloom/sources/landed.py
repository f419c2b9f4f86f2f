"""Landed source payloads (JSON text) to typed rows.

Every function maps whole tables and shuffles nothing unless a per-request limit asks for it.
Rows the source contract forbids stay in the output with ``reject_reason`` set; ``accepted``
and ``rejected`` split them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marketloom.functions import dates, text, variant


def accepted(df: DataFrame) -> DataFrame:
    return df.filter("reject_reason IS NULL").drop("reject_reason")


def rejected(df: DataFrame) -> DataFrame:
    return df.filter("reject_reason IS NOT NULL")


def _first_reason(*checks: tuple[Column, str]) -> Column:
    return F.coalesce(*[F.when(failed, F.lit(reason)) for failed, reason in checks])


def normalize_companies(payloads: DataFrame) -> DataFrame:
    """(ticker, payload) -> company rows; the requested ticker stands in for a missing one."""
    src = variant.with_parsed(payloads, path="$.results")
    r = F.col("_r")
    own = F.nullif(variant.any_text(r, "$.ticker"), F.lit(""))
    list_date = F.nullif(variant.any_text(r, "$.list_date"), F.lit(""))
    name = variant.optional_text(r, "$.name")
    industry = variant.optional_text(r, "$.sic_description")
    out = src.select(
        text.normalize_ticker(F.coalesce(own, F.col("ticker"))).alias("ticker"),
        name.alias("name"),
        name.alias("legal_name"),
        variant.optional_text(r, "$.description").alias("description"),
        variant.number(r, "$.market_cap", "decimal(24,4)").alias("market_cap"),
        variant.optional_text(r, "$.market").alias("market"),
        variant.optional_text(r, "$.primary_exchange").alias("exchange"),
        variant.optional_text(r, "$.type").alias("security_type"),
        variant.boolean(r, "$.active").alias("active"),
        text.iso_date(list_date).alias("list_date"),
        variant.optional_text(r, "$.sic_code").alias("sic_code"),
        industry.alias("sic_description"),
        industry.alias("industry"),
        variant.optional_text(r, "$.homepage_url").alias("homepage_url"),
        variant.optional_text(r, "$.currency_name").alias("currency_name"),
        variant.optional_text(r, "$.locale").alias("locale"),
        F.when(variant.is_object(r), F.to_json(r)).otherwise("{}").alias("raw_source_payload"),
        variant.is_object(r).alias("_object"),
        list_date.isNotNull().alias("_dated"),
    )
    reason = _first_reason(
        (~F.col("_object"), "invalid company response"),
        (F.col("ticker").isNull(), "invalid ticker"),
        (F.col("name").isNull(), "missing name"),
        (F.col("_dated") & F.col("list_date").isNull(), "invalid list_date"),
    )
    return out.withColumn("reject_reason", reason).drop("_object", "_dated")


def normalize_price_bars(payloads: DataFrame, start: Column | None = None, end: Column | None = None) -> DataFrame:
    """(ticker, payload) -> one row per bar, dated by the New York calendar.

    ``start`` and ``end`` (dates or columns of ``payloads``) bound the bars, both inclusive.
    """
    none = F.lit(None).cast("date")
    bars = variant.with_parsed(payloads).select(
        text.normalize_ticker(F.col("ticker")).alias("ticker"),
        (start if start is not None else none).alias("_start"),
        (end if end is not None else none).alias("_end"),
        F.posexplode_outer(variant.array(F.col("_r"), "$.results")).alias("bar_pos", "_b"),
    ).filter("bar_pos IS NOT NULL")
    b = F.col("_b")
    t = variant.number(b, "$.t", "double")
    out = bars.select(
        "ticker",
        "bar_pos",
        dates.market_date(F.floor(t)).alias("price_date"),
        *[
            variant.number(b, f"$.{key}", "decimal(20,6)").alias(name)
            for key, name in (("o", "open"), ("h", "high"), ("l", "low"), ("c", "close"))
        ],
        variant.number(b, "$.v", "decimal(24,4)").alias("volume"),
        variant.number(b, "$.vw", "decimal(20,6)").alias("vwap"),
        _first_reason(
            (F.col("ticker").isNull(), "invalid ticker"),
            (F.col("_start") > F.col("_end"), "start after end"),
            (t.isNull(), "bar without timestamp"),
        ).alias("reject_reason"),
        "_start",
        "_end",
    )
    day = F.col("price_date")
    in_range = day.between(F.coalesce("_start", day), F.coalesce("_end", day))
    return out.filter(F.col("reject_reason").isNotNull() | in_range).drop("_start", "_end")


def normalize_news(payloads: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One article payload per row -> article rows with their ticker relationships.

    ``keep`` names payload-table columns (a request id, a sequence) to carry along.
    """
    src = variant.with_parsed(payloads)
    r = F.col("_r")
    publisher = variant.field(r, "$.publisher")
    published = F.nullif(variant.any_text(r, "$.published_utc"), F.lit(""))
    strings = F.filter(
        F.transform(
            variant.array(r, "$.keywords"),
            lambda k: F.when(variant.is_string(k), text.trim_ws(F.try_variant_get(k, "$", "string"))),
        ),
        lambda k: k != "",
    )
    out = src.select(
        *keep,
        variant.optional_text(r, "$.id").alias("article_id"),
        variant.optional_text(r, "$.title").alias("title"),
        variant.optional_text(r, "$.description").alias("description"),
        variant.optional_text(r, "$.author").alias("author"),
        F.when(variant.is_object(publisher), variant.optional_text(r, "$.publisher.name"))
        .otherwise(variant.optional_text(r, "$.publisher"))
        .alias("publisher"),
        variant.optional_text(r, "$.article_url").alias("article_url"),
        text.iso_timestamp(published).alias("published_at"),
        strings.alias("keywords"),
        F.when(variant.is_object(r), F.to_json(r)).otherwise("{}").alias("raw_source_payload"),
        _listed_tickers(r).alias("_listed"),
        _ticker_insights(r).alias("_insights"),
        published.isNotNull().alias("_dated"),
    ).withColumn("relationships", _relationships(F.col("_listed"), F.col("_insights")))
    reason = _first_reason(
        (F.col("article_id").isNull(), "missing id"),
        (F.col("title").isNull(), "missing title"),
        (F.col("_dated") & F.col("published_at").isNull(), "invalid published_utc"),
    )
    return out.withColumn("reject_reason", reason).drop("_dated", "_listed", "_insights")


def _listed_tickers(r: Column) -> Column:
    named = F.transform(
        variant.array(r, "$.tickers"), lambda t: text.ticker_or_blank(F.try_variant_get(t, "$", "string"))
    )
    return F.filter(named, lambda t: t != "")


def _ticker_insights(r: Column) -> Column:
    fields = "struct<ticker string, sentiment variant, sentiment_reasoning variant>"
    objects = F.transform(variant.array(r, "$.insights"), lambda i: F.try_variant_get(i, "$", fields))
    named = F.transform(
        objects,
        lambda i: F.struct(
            text.ticker_or_blank(i["ticker"]).alias("ticker"),
            variant.text_of(i["sentiment"]).alias("sentiment"),
            variant.text_of(i["sentiment_reasoning"]).alias("sentiment_reasoning"),
        ),
    )
    return F.filter(named, lambda i: i["ticker"] != "")


def _relationships(listed: Column, insights: Column) -> Column:
    """tickers[] in order, then tickers named by insights only; the last insight of a ticker wins.

    Both inputs are columns of their own, so nothing is parsed again per element.
    """

    def named(ticker: Column, last: Column) -> Column:
        return F.struct(
            ticker.alias("ticker"), last["sentiment"].alias("sentiment"), last["sentiment_reasoning"].alias("sentiment_reasoning")
        )

    # the newest insight of each ticker is looked up once, and both fields are taken from it
    tickers = F.array_union(listed, F.transform(insights, lambda i: i["ticker"]))
    backwards = F.reverse(insights)
    lasts = F.transform(tickers, lambda t: F.get(F.filter(backwards, lambda i: i["ticker"] == t), 0))
    return F.zip_with(tickers, lasts, named)


def article_ticker_rows(articles: DataFrame) -> DataFrame:
    """The (article_id, ticker) relationship rows of normalized articles."""
    exploded = articles.select("article_id", F.posexplode_outer("relationships").alias("position", "_x"))
    return exploded.filter("position IS NOT NULL").select(
        "article_id", "_x.ticker", "_x.sentiment", "_x.sentiment_reasoning", "position"
    )


def newest_per_request(news: DataFrame, request: Sequence[str], limit: int, published_after: Column | None = None) -> DataFrame:
    """A request's newest articles, at most ``limit`` (1..100), none before ``published_after``."""
    if not 1 <= limit <= text.MAX_LIMIT:
        raise ValueError(f"limit must be between 1 and {text.MAX_LIMIT}.")
    if published_after is not None:
        news = news.filter(F.col("published_at") >= published_after)
    order = W.partitionBy(*request).orderBy(F.col("published_at").desc_nulls_last(), F.col("article_id"))
    return news.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= limit).drop("_rn")


def collect_pages(pages: DataFrame, max_results: int | None = None, max_pages: int | None = None) -> DataFrame:
    """(request_id, page_no 1.., payload) -> the results of each request in page order.

    Reading a request stops at ``max_pages``, once ``max_results`` are found, or at the first
    page without ``next_url``. A page read up to there whose results are not a list of objects,
    or a followed ``next_url`` that repeats or is not text, rejects the request: its only row
    then carries ``reject_reason``.

    The running totals are taken over page metadata alone, and joined back to the payloads by
    (request_id, page_no), so a request with very many pages never moves its payloads to one task.
    """
    if max_pages is not None and max_pages < 1:
        raise ValueError("max_pages must be a positive integer.")
    if max_pages is not None:
        pages = pages.filter(F.col("page_no") <= max_pages)
    parsed = variant.with_parsed(pages)
    v = F.col("_r")
    items = variant.field(v, "$.results")
    link = variant.field(v, "$.next_url")
    elements = variant.array(v, "$.results")
    meta = parsed.select(
        "request_id",
        "page_no",
        F.size(elements).alias("n"),
        (
            variant.is_object(v)
            & (items.isNull() | variant.is_array(items))
            & F.forall(elements, variant.is_object)
        ).alias("valid"),
        F.coalesce(~(variant.type_name(link) == "VOID"), F.lit(False)).alias("linked"),
        F.when(variant.is_string(link), F.try_variant_get(link, "$", "string")).alias("next_url"),
    ).withColumn("linked", F.col("linked") & (F.coalesce("next_url", F.lit("?")) != ""))
    before = W.partitionBy("request_id").orderBy("page_no").rowsBetween(W.unboundedPreceding, -1)
    limit = F.lit(max_results).cast("long")
    reached = meta.select(
        "*",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"),
        F.coalesce(F.min("linked").over(before), F.lit(True)).alias("chained"),
    ).filter("chained")
    if max_results is not None:
        reached = reached.filter(F.col("offset") < limit)
    followed = F.col("linked")
    if max_results is not None:
        followed = followed & (F.col("offset") + F.col("n") < limit)
    if max_pages is not None:
        followed = followed & (F.col("page_no") < max_pages)
    reached = reached.withColumn("followed", followed)
    repeat = F.row_number().over(W.partitionBy("request_id", "next_url").orderBy(F.col("followed").desc(), "page_no"))
    checked = reached.withColumn(
        "bad_page", ~F.col("valid") | (F.col("followed") & (F.col("next_url").isNull() | (repeat > 1)))
    )
    bad_requests = checked.filter("bad_page").select("request_id").distinct()
    good = checked.join(bad_requests, "request_id", "left_anti").select("request_id", "page_no", "offset")
    rows = (
        variant.with_parsed(pages.join(good, ["request_id", "page_no"]))
        .select("request_id", "page_no", "offset", F.posexplode_outer(elements).alias("pos", "result"))
        .filter("pos IS NOT NULL")
        .withColumn("result_no", F.col("offset") + F.col("pos") + 1)
    )
    if max_results is not None:
        rows = rows.filter(F.col("result_no") <= limit)
    rows = rows.select(
        "request_id", "page_no", "result_no", F.to_json("result").alias("result"), F.lit(None).cast("string").alias("reject_reason")
    )
    rejects = bad_requests.select(
        "request_id",
        F.lit(None).cast(pages.schema["page_no"].dataType).alias("page_no"),
        F.lit(None).cast("long").alias("result_no"),
        F.lit(None).cast("string").alias("result"),
        F.lit("invalid page").alias("reject_reason"),
    )
    return rows.unionByName(rejects)
