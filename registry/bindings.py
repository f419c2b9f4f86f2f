"""The provided tables bound to the engine's tables: once as DataFrames, once as DuckDB CTEs.

Every binding maps whole tables. Values are varied by attributes (status, priority, region), and
no binding drops rows to be cheap.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketloom.operators import content, state
from marketloom.session import materialize, shared_dir
from marketloom.sources.tables import write_new
from marketloom.sources.versions import VersionedTable

AS_OF = "2026-01-02 03:04:05"
HELD_SINCE = "2023-12-01 00:00:00"


def as_of() -> Column:
    return F.lit(AS_OF).cast("timestamp_ntz")


def text(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


# (application, scale directory, table) -> where this application stored it
_STORED: dict[tuple[str, str, str], str] = {}


class Data:
    """The tables of one scale directory."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.dir = spark, str(sf_dir).rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    def stored(self, name: str, build: Callable[[], DataFrame]) -> DataFrame:
        """A keyed engine table, written once per application to the shared folder and scanned
        from there: its readers prune columns instead of reducing the raw feed again."""
        key = (self.spark.sparkContext.applicationId, self.dir, name)
        if key not in _STORED:
            path = f"{shared_dir(self.spark)}/marketloom/{uuid.uuid4().hex}/{name}"
            write_new(build(), path)
            _STORED[key] = path
        return self.spark.read.parquet(_STORED[key])

    def versioned(self, name: str, schema: T.StructType) -> VersionedTable:
        """A new versioned table in the shared folder."""
        return VersionedTable(self.spark, self.new_path(name), schema)

    def new_path(self, name: str) -> str:
        return f"{shared_dir(self.spark)}/marketloom/{uuid.uuid4().hex}/{name}"

    def next_version(self, name: str, current: DataFrame, change: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """``change`` applied to ``current`` through a versioned table: both states are committed, the second is read."""
        table = self.versioned(name, current.schema)
        table.replace(current)
        table.update(change)
        return table.read()

    # -- companies and prices

    def located_suppliers(self) -> DataFrame:
        nation, region = self.table("nation"), self.table("region")
        return (
            self.table("supplier")
            .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        )

    def companies(self) -> DataFrame:
        return self.located_suppliers().select(
            F.concat(F.lit("S"), text("s_suppkey")).alias("ticker"),
            F.col("s_name").alias("name"),
            F.col("r_name").alias("industry"),
            F.col("n_name").alias("exchange"),
            F.col("s_acctbal").cast("decimal(24,4)").alias("market_cap"),
            F.lit(None).cast("string").alias("description"),
        )

    def company_feed(self) -> DataFrame:
        """Every line re-sends its supplier's company record, in (seq1..seq5) order."""
        return self.table("lineitem").select(
            F.concat(F.lit("S"), text("l_suppkey")).alias("ticker"),
            F.concat(F.lit("Supplier at line "), text("l_linenumber")).alias("name"),
            F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("industry"),
            F.col("l_extendedprice").cast("decimal(24,4)").alias("market_cap"),
            F.col("l_shipdate").alias("seq1"), F.col("l_orderkey").alias("seq2"),
            F.col("l_linenumber").alias("seq3"), F.col("l_partkey").alias("seq4"),
            F.col("l_extendedprice").alias("seq5"),
        )

    def price_feed(self, lines: DataFrame | None = None) -> DataFrame:
        """One bar per line, duplicates per (ticker, price_date); the last by seq1..seq3 wins."""
        return (self.table("lineitem") if lines is None else lines).select(
            F.concat(F.lit("S"), text("l_suppkey")).alias("ticker"),
            F.col("l_shipdate").cast("date").alias("price_date"),
            F.col("l_extendedprice").cast("decimal(20,6)").alias("close"),
            F.col("l_quantity").cast("decimal(24,4)").alias("volume"),
            F.col("l_discount").cast("decimal(20,6)").alias("vwap"),
            F.col("l_tax").cast("decimal(20,6)").alias("open"),
            (F.col("l_extendedprice") + 1).cast("decimal(20,6)").alias("high"),
            F.when(F.col("l_returnflag") != "N", F.col("l_extendedprice")).cast("decimal(20,6)").alias("low"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_orderkey").alias("seq1"), F.col("l_linenumber").alias("seq2"),
            F.col("l_partkey").alias("seq3"),
        )

    def prices(self) -> DataFrame:
        """The last line of each (supplier, day) as a bar. The lines' own narrow columns are reduced; the bar's decimals, made
        from one line each, come after that."""

        def build() -> DataFrame:
            day = F.col("l_shipdate").cast("date").alias("l_shipdate")
            lines = self.table("lineitem").select(
                "l_suppkey", day, "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_returnflag", "l_orderkey", "l_linenumber", "l_partkey",
                F.lit(None).cast("string").alias("l_linestatus"),
            )
            last = state.last_write(lines, ["l_suppkey", "l_shipdate"], ["l_orderkey", "l_linenumber", "l_partkey"])
            return self.price_feed(last).drop("line_status", "seq1", "seq2", "seq3")

        return self.stored("price_snapshots", build)

    # -- articles

    def articles(self) -> DataFrame:
        low = F.col("o_orderpriority") == "5-LOW"
        return self.table("orders").select(
            text("o_orderkey").alias("article_id"),
            F.concat(F.lit("Order "), text("o_orderkey")).alias("title"),
            F.when(F.col("o_orderstatus") != "P", F.concat(F.lit("Customer "), text("o_custkey"))).alias("description"),
            F.when(~low, F.concat(F.lit("https://news.example.org/"), text("o_orderkey"))).alias("article_url"),
            F.col("o_orderpriority").alias("publisher"),
            F.when(F.col("o_totalprice") >= 10000, F.col("o_orderdate")).alias("published_at"),
        )

    def article_ticker_feed(self, lines: DataFrame | None = None) -> DataFrame:
        flag = F.col("l_returnflag")
        return (self.table("lineitem") if lines is None else lines).select(
            text("l_orderkey").alias("article_id"),
            F.concat(F.lit("S"), text("l_suppkey")).alias("ticker"),
            F.when(flag == "R", "negative").when(flag == "A", "neutral").alias("sentiment"),
            F.concat(F.lit("line "), text("l_linenumber")).alias("sentiment_reasoning"),
            F.col("l_linestatus").alias("line_status"),
            F.col("l_linenumber").alias("seq1"), F.col("l_partkey").alias("seq2"),
            F.col("l_extendedprice").alias("seq3"),
        )

    def article_tickers(self) -> DataFrame:
        def build() -> DataFrame:
            lines = self.table("lineitem").select(
                "l_orderkey", "l_suppkey", "l_returnflag", "l_linenumber", "l_partkey", "l_extendedprice", F.lit(None).cast("string").alias("l_linestatus")
            )
            last = state.last_write(lines, ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_partkey", "l_extendedprice"])
            return self.article_ticker_feed(last).drop("line_status", "seq1", "seq2", "seq3")

        return self.stored("news_article_tickers", build)

    def chunks(self) -> DataFrame:
        """Five chunks per article; label 0 plays "not embedded yet"."""
        done = F.col("label") != 0
        return self.table("embeddings").select(
            text(F.floor(F.col("vec_id") / 5).cast("long")).alias("article_id"),
            (F.col("vec_id") % 5).cast("int").alias("chunk_index"),
            F.concat(F.lit("Evidence "), text("vec_id")).alias("chunk_text"),
            F.when(done, F.col("embedding")).alias("embedding"),
            F.when(done, F.lit("model-a")).alias("embedding_model"),
        )

    def requests(self) -> DataFrame:
        """One question per company that has a question vector."""
        return self.table("supplier").join(self.table("embeddings"), F.col("s_suppkey") == F.col("vec_id")).select(
            F.col("s_suppkey").alias("request_id"),
            F.concat(F.lit("S"), text("s_suppkey")).alias("ticker"),
            F.concat(F.lit("What  moves "), F.col("s_name"), F.lit("?")).alias("question"),
            F.col("embedding").alias("query"),
        )

    def question_vector(self) -> Column:
        """One question: the last vector whose chunk is not embedded yet (a scalar subquery)."""
        waiting = self.table("embeddings").filter("label = 0")
        return waiting.agg(F.max_by("embedding", "vec_id")).scalar()

    # -- documents

    def document_chunks(self, size: int = content.CHUNK_SIZE, overlap: int = content.CHUNK_OVERLAP) -> DataFrame:
        docs = self.table("documents").select(text("doc_id").alias("article_id"), "text")
        return content.chunk_articles(docs, "text", size, overlap)

    def document_articles(self) -> DataFrame:
        spanish = F.col("lang") == "es"
        return self.table("documents").select(
            text("doc_id").alias("article_id"),
            F.col("source").alias("title"),
            F.concat(F.lit(" written in  "), F.col("lang")).alias("description"),
            F.when(~spanish, F.concat(F.lit("https://docs.example.org/"), text("doc_id"))).alias("article_url"),
            F.lit(None).cast("timestamp_ntz").alias("published_at"),
        )

    # -- users and their actions

    def actions(self) -> DataFrame:
        kind = F.col("event_type")
        return self.table("events").filter(kind != "view").select(
            F.concat(F.lit("user"), text("user_id"), F.lit("@example.com")).alias("user_email"),
            F.concat(F.lit("K"), F.get_json_object("props", "$.k")).alias("ticker"),
            F.when(kind == "error", "remove").otherwise("add").alias("action"),
            "ts",
            "event_id",
        )

    def held(self) -> DataFrame:
        """Membership before the actions: what each user viewed."""
        return (
            self.table("events")
            .filter(F.col("event_type") == "view")
            .select(
                F.concat(F.lit("user"), text("user_id"), F.lit("@example.com")).alias("user_email"),
                F.concat(F.lit("K"), F.get_json_object("props", "$.k")).alias("ticker"),
            )
            .distinct()
            .withColumn("added_at", F.lit(HELD_SINCE).cast("timestamp_ntz"))
        )

    def known_users(self) -> DataFrame:
        emails = self.table("conversations").select(
            F.concat(F.lit("u"), text("conv_id"), F.lit("@example.com")).alias("email")
        )
        since = F.lit(HELD_SINCE).cast("timestamp_ntz")
        return materialize(
            state.with_new_ids(emails.distinct(), ["email"])
            .withColumn("created_at", since)
            .withColumn("updated_at", since)
            .select("id", "email", "created_at", "updated_at")
        )


# ---------------------------------------------------------------- the same bindings for DuckDB

CTES: dict[str, str] = {
    "b_companies": """
SELECT 'S' || s_suppkey AS ticker, s_name AS name, r_name AS industry, n_name AS exchange,
       CAST(s_acctbal AS DECIMAL(24,4)) AS market_cap
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
    "b_price_feed": """
SELECT 'S' || l_suppkey AS ticker, CAST(l_shipdate AS DATE) AS price_date,
       CAST(l_extendedprice AS DECIMAL(20,6)) AS close, CAST(l_quantity AS DECIMAL(24,4)) AS volume,
       CAST(l_discount AS DECIMAL(20,6)) AS vwap, CAST(l_tax AS DECIMAL(20,6)) AS open,
       CAST(l_extendedprice + 1 AS DECIMAL(20,6)) AS high,
       CAST(CASE WHEN l_returnflag <> 'N' THEN l_extendedprice END AS DECIMAL(20,6)) AS low, l_linestatus AS line_status,
       l_orderkey AS seq1, l_linenumber AS seq2, l_partkey AS seq3
FROM lineitem""",
    "b_prices": """
SELECT ticker, price_date, open, high, low, close, volume, vwap FROM b_price_feed
QUALIFY row_number() OVER (PARTITION BY ticker, price_date ORDER BY seq1 DESC, seq2 DESC, seq3 DESC) = 1""",
    "b_articles": """
SELECT CAST(o_orderkey AS VARCHAR) AS article_id, 'Order ' || o_orderkey AS title,
       CASE WHEN o_orderstatus <> 'P' THEN 'Customer ' || o_custkey END AS description,
       CASE WHEN o_orderpriority <> '5-LOW' THEN 'https://news.example.org/' || o_orderkey END AS article_url,
       o_orderpriority AS publisher, CASE WHEN o_totalprice >= 10000 THEN o_orderdate END AS published_at
FROM orders""",
    "b_article_ticker_feed": """
SELECT CAST(l_orderkey AS VARCHAR) AS article_id, 'S' || l_suppkey AS ticker,
       CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'neutral' END AS sentiment,
       'line ' || l_linenumber AS sentiment_reasoning, l_linestatus AS line_status,
       l_linenumber AS seq1, l_partkey AS seq2, l_extendedprice AS seq3
FROM lineitem""",
    "b_article_tickers": """
SELECT article_id, ticker, sentiment, sentiment_reasoning FROM b_article_ticker_feed
QUALIFY row_number() OVER (PARTITION BY article_id, ticker ORDER BY seq1 DESC, seq2 DESC, seq3 DESC) = 1""",
    "b_related": """
SELECT article_id, string_agg(ticker, ',' ORDER BY ticker) AS tickers FROM b_article_tickers GROUP BY article_id""",
    "b_chunks": """
SELECT CAST(vec_id // 5 AS VARCHAR) AS article_id, CAST(vec_id % 5 AS INTEGER) AS chunk_index,
       'Evidence ' || vec_id AS chunk_text, CASE WHEN label <> 0 THEN embedding END AS embedding,
       CASE WHEN label <> 0 THEN 'model-a' END AS embedding_model
FROM embeddings""",
    "b_requests": """
SELECT s_suppkey AS request_id, 'S' || s_suppkey AS ticker, 'What moves ' || s_name || '?' AS question,
       embedding AS query
FROM supplier JOIN embeddings ON vec_id = s_suppkey""",
    "b_question": "SELECT arg_max(embedding, vec_id) AS query FROM embeddings WHERE label = 0",
    "b_actions": """
SELECT 'user' || user_id || '@example.com' AS user_email, 'K' || regexp_extract(props, '[0-9]+') AS ticker,
       CASE WHEN event_type = 'error' THEN 'remove' ELSE 'add' END AS action, ts, event_id
FROM events WHERE event_type <> 'view'""",
    "b_held": f"""
SELECT DISTINCT 'user' || user_id || '@example.com' AS user_email, 'K' || regexp_extract(props, '[0-9]+') AS ticker,
       TIMESTAMP '{HELD_SINCE}' AS added_at
FROM events WHERE event_type = 'view'""",
    "b_known_users": f"""
SELECT row_number() OVER (ORDER BY left(md5(email), 4), email) AS id, email,
       TIMESTAMP '{HELD_SINCE}' AS created_at, TIMESTAMP '{HELD_SINCE}' AS updated_at
FROM (SELECT DISTINCT 'u' || conv_id || '@example.com' AS email FROM conversations)""",
    "b_ranked": """
SELECT r.request_id, r.ticker, c.article_id, c.chunk_index, c.chunk_text, t.sentiment, t.sentiment_reasoning,
       round(list_cosine_distance(CAST(c.embedding AS DOUBLE[]), CAST(r.query AS DOUBLE[])), 12) AS distance,
       row_number() OVER (PARTITION BY r.request_id ORDER BY
         round(list_cosine_distance(CAST(c.embedding AS DOUBLE[]), CAST(r.query AS DOUBLE[])), 12) NULLS LAST,
         c.article_id, c.chunk_index) AS rank
FROM b_requests r JOIN b_article_tickers t ON t.ticker = r.ticker JOIN b_chunks c ON c.article_id = t.article_id
WHERE c.embedding IS NOT NULL""",
    "b_evidence": """
SELECT request_id, ticker, article_id, chunk_index, chunk_text, sentiment, distance, position FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY rank) AS position FROM (
    SELECT *, row_number() OVER (PARTITION BY request_id, article_id ORDER BY rank) AS n FROM b_ranked WHERE rank <= 16)
  WHERE n <= 2)
WHERE position <= 8""",
    "b_recent_prices": """
SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY price_date) AS position FROM (
  SELECT * FROM b_prices QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY price_date DESC) <= 30)""",
    "b_recent_news": """
SELECT t.ticker, a.article_id, a.title, a.publisher, a.published_at, a.article_url, t.sentiment,
       t.sentiment_reasoning, row_number() OVER (PARTITION BY t.ticker ORDER BY a.published_at DESC NULLS LAST,
       a.article_id) AS rank
FROM b_article_tickers t JOIN b_articles a ON a.article_id = t.article_id""",
    "b_links": """
SELECT t.ticker, t.article_id, a.published_at FROM b_article_tickers t JOIN b_articles a ON a.article_id = t.article_id""",
}

# what each CTE is built from
NEEDS: dict[str, list[str]] = {
    "b_prices": ["b_price_feed"],
    "b_article_tickers": ["b_article_ticker_feed"],
    "b_related": ["b_article_tickers"],
    "b_ranked": ["b_requests", "b_article_tickers", "b_chunks"],
    "b_evidence": ["b_ranked"],
    "b_recent_prices": ["b_prices"],
    "b_recent_news": ["b_article_tickers", "b_articles"],
    "b_links": ["b_article_tickers", "b_articles"],
}


def with_ctes(names: str, body: str, recursive: str = "") -> str:
    """``body`` after the CTEs named in ``names`` and what they need; ``recursive`` CTE text goes first."""
    ordered: list[str] = []

    def add(name: str) -> None:
        for need in NEEDS.get(name, []):
            add(need)
        if name not in ordered:
            ordered.append(name)

    for name in names.split():
        add(name)
    parts = ([recursive] if recursive else []) + [f"{n} AS ({CTES[n]})" for n in ordered]
    if not parts:
        return body
    return f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" + body


def chunk_cte(name: str, source: str, size: int, overlap: int) -> str:
    """Recursive CTEs ``name``(article_id, chunk_index, chunk_text) over ``source``(id, raw text).

    One step finds a chunk's end (the last space in reach) and the next start (after a space
    inside the overlap).
    """
    from marketloom.functions.text import WS_CLASS

    reach = size - overlap

    def end(s: str) -> str:
        back = f"strpos(reverse(substr(t, {s} + {overlap + 2}, {reach})), ' ')"
        return (
            f"CASE WHEN {s} + {size} >= n THEN n WHEN {back} BETWEEN 1 AND {reach - 1} "
            f"THEN {s} + {size + 1} - {back} ELSE {s} + {size} END"
        )

    step = (
        f"CASE WHEN e - {overlap} > 0 AND substr(t, e - {overlap}, 1) <> ' ' "
        f"AND strpos(substr(t, e - {overlap - 1}, {overlap}), ' ') > 0 "
        f"THEN e - {overlap} + strpos(substr(t, e - {overlap - 1}, {overlap}), ' ') ELSE e - {overlap} END"
    ) if overlap else "e"
    return f"""{name}_src AS (
  SELECT id, t, length(t) AS n FROM (
    SELECT id, trim(regexp_replace(raw, '{WS_CLASS}+', ' ', 'g')) AS t FROM ({source})) WHERE t <> ''),
{name}_spans(id, t, n, k, s, e) AS (
  SELECT id, t, n, 0, CAST(0 AS BIGINT), {end('0')} FROM {name}_src
  UNION ALL
  SELECT id, t, n, k + 1, s2, {end('s2')} FROM (
    SELECT id, t, n, k, greatest(s + 1, {step}) AS s2 FROM {name}_spans WHERE e < n)),
{name} AS (
  SELECT id AS article_id, CAST(row_number() OVER (PARTITION BY id ORDER BY k) - 1 AS INTEGER) AS chunk_index, chunk_text
  FROM (SELECT id, k, trim(substr(t, s + 1, e - s)) AS chunk_text FROM {name}_spans) WHERE chunk_text <> '')"""
