"""Lookups, price and news reads, retrieval, research contexts."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.functions import text as tx, vectors
from marketloom.operators import content, quality, reads, search, state
from marketloom.plans import context
from marketloom.plans.requests import validate_requests
from registry.bindings import Data, text, with_ctes
from registry.catalog import joined, query, r6

TICKER = r"^[A-Z][A-Z0-9]{0,4}([.-][A-Z0-9]{1,2})?$"


# ---------------------------------------------------------------- lookups


def lookup_requests(d: Data) -> DataFrame:
    user, kind = text("user_id"), F.col("event_type")
    return d.table("events").select(
        F.col("event_id").alias("request_id"),
        F.when(kind == "view", F.concat(F.lit(" s"), user, F.lit(" ")))
        .when(kind == "click", F.concat(F.lit("S"), user))
        .when(kind == "error", F.concat(F.lit("S"), user, F.lit("?key=1")))
        .otherwise(F.concat(F.lit("K"), F.get_json_object("props", "$.k")))
        .alias("ticker"),
    )


@query(
    "company_lookup",
    with_ctes(
        "b_companies",
        f"""
SELECT q.request_id, q.ticker IS NOT NULL AND c.ticker IS NOT NULL AS ok, c.ticker, c.name, c.market_cap, c.exchange,
       CASE WHEN q.ticker IS NULL THEN 'validation_error' WHEN c.ticker IS NULL THEN 'not_found' END AS error_type
FROM (SELECT event_id AS request_id, CASE WHEN regexp_matches(raw, '{TICKER}') THEN raw END AS ticker FROM (
        SELECT event_id, upper(trim(CASE event_type WHEN 'view' THEN ' s' || user_id || ' ' WHEN 'click' THEN 'S' || user_id
          WHEN 'error' THEN 'S' || user_id || '?key=1' ELSE 'K' || regexp_extract(props, '[0-9]+') END)) AS raw FROM events)) q
LEFT JOIN b_companies c ON c.ticker = q.ticker""",
    ),
)
def company_lookup(d: Data) -> DataFrame:
    out = reads.company_lookup(lookup_requests(d), d.companies())
    return out.select(
        "request_id", "ok", "data.ticker", "data.name", "data.market_cap", "data.exchange",
        F.col("error.type").alias("error_type"),
    )


@query(
    "price_history_range",
    with_ctes(
        "b_prices b_companies",
        """
SELECT p.ticker, p.price_date, p.close FROM b_prices p JOIN b_companies b ON b.ticker = p.ticker
WHERE (b.market_cap < 2000 OR p.price_date >= DATE '1998-01-01') AND (b.market_cap > 8000 OR p.price_date <= DATE '2000-06-30')""",
    ),
)
def price_history_range(d: Data) -> DataFrame:
    cap = F.col("market_cap")
    bounds = d.companies().select(
        "ticker",
        F.when(cap >= 2000, F.lit("1998-01-01").cast("date")).alias("start"),
        F.when(cap <= 8000, F.lit("2000-06-30").cast("date")).alias("end"),
    )
    return reads.price_range(d.prices(), bounds).select("ticker", "price_date", "close")


@query(
    "recent_prices",
    with_ctes("b_recent_prices", "SELECT ticker, price_date, close, volume, CAST(position AS INTEGER) AS position FROM b_recent_prices"),
)
def recent_prices(d: Data) -> DataFrame:
    return reads.recent_prices(d.prices(), 30).select("ticker", "price_date", "close", "volume", "position")


@query(
    "recent_news",
    with_ctes(
        "b_recent_news b_related",
        """
SELECT n.ticker, n.article_id, CAST(n.rank AS INTEGER) AS rank, n.title, n.sentiment, n.published_at, r.tickers
FROM b_recent_news n JOIN b_related r ON r.article_id = n.article_id WHERE n.rank <= 5""",
    ),
)
def recent_news(d: Data) -> DataFrame:
    rows = reads.recent_news(d.articles(), d.article_tickers(), 5)
    return rows.select(
        "ticker", "article_id", "rank", "title", "sentiment", "published_at", joined("tickers").alias("tickers")
    )


@query(
    "related_tickers",
    with_ctes(
        "b_articles b_related",
        "SELECT a.article_id, coalesce(r.tickers, '') AS tickers FROM b_articles a LEFT JOIN b_related r ON r.article_id = a.article_id",
    ),
)
def related_tickers(d: Data) -> DataFrame:
    out = reads.with_related_tickers(d.articles().select("article_id"), d.article_tickers())
    return out.select("article_id", joined("tickers").alias("tickers"))


SUMMARY_SQL = """
SELECT coalesce(c.ticker, p.ticker, n.ticker) AS ticker, coalesce(company_count, 0) AS company_count,
       coalesce(price_count, 0) AS price_count, minimum_price_date, maximum_price_date,
       coalesce(news_associations, 0) AS news_associations, coalesce(distinct_news_articles, 0) AS distinct_news_articles,
       newest_published_at
FROM (SELECT ticker, count(*) AS company_count FROM ({companies}) GROUP BY ticker) c
FULL JOIN (SELECT ticker, count(*) AS price_count, min(price_date) AS minimum_price_date, max(price_date) AS maximum_price_date
           FROM b_prices GROUP BY ticker) p ON p.ticker = c.ticker
FULL JOIN (SELECT ticker, count(*) AS news_associations, count(DISTINCT article_id) AS distinct_news_articles,
                  max(published_at) AS newest_published_at FROM {links} GROUP BY ticker) n ON n.ticker = coalesce(c.ticker, p.ticker)
"""


@query(
    "stock_summary",
    with_ctes(
        "b_companies b_prices b_links b_recent_news b_related",
        f"""
SELECT s.*, coalesce(h.headlines, '') AS headlines FROM ({SUMMARY_SQL.format(companies='SELECT ticker FROM b_companies', links='b_links')}) s
LEFT JOIN (SELECT ticker, string_agg(title || ' [' || coalesce(sentiment, '') || '] ' || tickers, '; ' ORDER BY rank) AS headlines
           FROM b_recent_news JOIN b_related USING (article_id) WHERE rank <= 3 GROUP BY ticker) h ON h.ticker = s.ticker""",
    ),
)
def stock_summary(d: Data) -> DataFrame:
    out = reads.stock_summary(d.companies(), d.prices(), d.articles(), d.article_tickers())
    shown = F.transform(
        "articles",
        lambda a: F.concat(a["title"], F.lit(" ["), F.coalesce(a["sentiment"], F.lit("")), F.lit("] "), joined(a["tickers"])),
    )
    return out.select(
        "ticker", "company_count", "price_count", "minimum_price_date", "maximum_price_date",
        "news_associations", "distinct_news_articles", "newest_published_at",
        F.coalesce(F.array_join(shown, "; "), F.lit("")).alias("headlines"),
    )


@query(
    "stock_data_checks",
    with_ctes(
        "b_companies b_prices b_article_ticker_feed",
        f"""
SELECT ticker, error FROM (SELECT ticker, unnest(list_filter([
    CASE WHEN company_count <> 1 THEN 'expected exactly one company row' END,
    CASE WHEN price_count < 1 THEN 'expected at least one price row' END,
    CASE WHEN distinct_news_articles < 1 THEN 'expected at least one associated news article' END,
    CASE WHEN news_associations <> distinct_news_articles THEN 'ticker associations contain duplicate article relationships' END
  ], lambda x : x IS NOT NULL)) AS error FROM ({SUMMARY_SQL.format(
      companies="SELECT ticker FROM b_companies UNION ALL SELECT 'N' || n_nationkey FROM nation "
      "UNION ALL SELECT 'S' || s_suppkey FROM supplier WHERE s_acctbal < 0",
      links='(SELECT f.ticker, f.article_id, o_orderdate AS published_at FROM b_article_ticker_feed f JOIN orders ON CAST(o_orderkey AS VARCHAR) = f.article_id)')}))""",
    ),
)
def stock_data_checks(d: Data) -> DataFrame:
    # nations have no data, suppliers in debt are listed twice, and the raw feed has duplicate links
    nations = d.table("nation").select(F.concat(F.lit("N"), text("n_nationkey")).alias("ticker"))
    twice = d.table("supplier").filter("s_acctbal < 0").select(F.concat(F.lit("S"), text("s_suppkey")).alias("ticker"))
    companies = d.companies().unionByName(nations, allowMissingColumns=True).unionByName(twice, allowMissingColumns=True)
    summary = reads.stock_summary(companies, d.prices(), d.articles(), d.article_ticker_feed())
    return quality.stock_data_errors(summary)


@query(
    "constraint_checks",
    with_ctes(
        "b_price_feed b_article_ticker_feed b_articles b_chunks",
        """
SELECT 'price_snapshots' AS table_name, 'primary_key' AS rule_name, count(*) AS violations
FROM (SELECT 1 FROM b_price_feed GROUP BY ticker, price_date HAVING count(*) > 1)
UNION ALL SELECT 'news_article_tickers', 'primary_key', count(*) FROM (SELECT 1 FROM b_article_ticker_feed GROUP BY article_id, ticker HAVING count(*) > 1)
UNION ALL SELECT 'news_article_tickers', 'foreign_key:article_id', count(*) FROM b_article_ticker_feed f
  WHERE f.article_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM documents)
UNION ALL SELECT 'news_article_chunks', 'foreign_key:article_id', count(*) FROM b_chunks WHERE article_id NOT IN (SELECT article_id FROM b_articles)
UNION ALL SELECT 'news_article_chunks', 'chunk_index >= 0', count(*) FROM b_chunks WHERE chunk_index < 0
UNION ALL SELECT 'news_article_chunks', 'embedding not null', count(*) FROM b_chunks WHERE embedding IS NULL
UNION ALL SELECT 'news_articles', 'description not null', count(*) FROM b_articles WHERE description IS NULL
UNION ALL SELECT 'news_articles', 'title not null', count(*) FROM b_articles WHERE title IS NULL
UNION ALL SELECT 'research_notes', 'ticker upper', count(*) FROM part WHERE p_name <> upper(p_name)""",
    ),
)
def constraint_checks(d: Data) -> DataFrame:
    links, chunks, articles = d.article_ticker_feed(), d.chunks(), d.articles()
    bodies = d.table("documents").select(text("doc_id").alias("article_id"))
    notes = d.table("part").select(F.col("p_name").alias("ticker"))
    checks = [
        quality.duplicate_keys(d.price_feed(), "price_snapshots", ["ticker", "price_date"]),
        quality.duplicate_keys(links, "news_article_tickers", ["article_id", "ticker"]),
        quality.orphans(links, "news_article_tickers", "article_id", bodies, "article_id"),
        quality.orphans(chunks, "news_article_chunks", "article_id", articles, "article_id"),
        quality.row_rules(
            chunks,
            "news_article_chunks",
            {"chunk_index >= 0": F.col("chunk_index") < 0, "embedding not null": F.col("embedding").isNull()},
        ),
        quality.row_rules(
            articles,
            "news_articles",
            {"description not null": F.col("description").isNull(), "title not null": F.col("title").isNull()},
        ),
        quality.row_rules(notes, "research_notes", {"ticker upper": quality.not_upper("ticker")}),
    ]
    out = checks[0]
    for check in checks[1:]:
        out = out.unionByName(check)
    return out


# raw feeds that play the ten tables, with what their constraints forbid; each table's columns in both languages
RAW_TABLES = {
    "users": ("customer", {"id": "c_custkey % 9000", "email": "CASE WHEN c_mktsegment <> 'MACHINERY' THEN c_name END"}),
    "watchlists": ("orders", {"id": "o_orderkey", "user_id": "CASE WHEN o_orderstatus <> 'P' THEN o_custkey END", "name": "o_orderpriority"}),
    "watchlist_tickers": ("lineitem", {"watchlist_id": "CASE WHEN l_linenumber > 6 THEN -l_orderkey ELSE l_orderkey END", "ticker": "concat('S', l_suppkey)"}),
    "companies": ("supplier", {"ticker": "concat('S', s_suppkey)", "name": "CASE WHEN s_acctbal >= 0 THEN s_name END", "raw_source_payload": "s_name"}),
    "price_snapshots": ("lineitem", {"ticker": "CASE WHEN l_returnflag <> 'R' THEN concat('S', l_suppkey) END", "price_date": "CAST(l_shipdate AS DATE)"}),
    "news_articles": ("documents", {"article_id": "CAST(doc_id AS STRING)", "title": "CASE WHEN lang <> 'es' THEN lang END", "raw_source_payload": "text"}),
    "news_article_tickers": ("labels", {"article_id": "CAST(doc_id + quality AS STRING)", "ticker": "CASE WHEN toxic = 0 THEN 'T' END"}),
    "news_article_chunks": ("embeddings", {"article_id": "CAST(vec_id AS STRING)", "chunk_index": "label", "chunk_text": "CASE WHEN label > 0 THEN 'c' END"}),
    "research_notes": ("conversations", {"id": "conv_id", "user_id": "conv_id", "ticker": "role", "note_text": "text"}),
    "analysis_reports": (
        "part", {"id": "p_partkey", "user_id": "CASE WHEN p_size > 5 THEN p_size END", "ticker": "p_brand", "title": "p_name", "report_text": "p_type"}
    ),
}
NOT_NULL = (
    "users.id users.email watchlists.id watchlists.user_id watchlists.name watchlist_tickers.watchlist_id watchlist_tickers.ticker companies.ticker "
    "companies.name companies.raw_source_payload price_snapshots.ticker price_snapshots.price_date news_articles.article_id news_articles.title "
    "news_articles.raw_source_payload news_article_tickers.article_id news_article_tickers.ticker news_article_chunks.article_id "
    "news_article_chunks.chunk_index news_article_chunks.chunk_text research_notes.id research_notes.user_id research_notes.ticker "
    "research_notes.note_text analysis_reports.id analysis_reports.user_id analysis_reports.ticker analysis_reports.title analysis_reports.report_text"
)
UNIQUE = (
    "users:id watchlists:id watchlist_tickers:watchlist_id,ticker companies:ticker price_snapshots:ticker,price_date news_articles:article_id "
    "news_article_tickers:article_id,ticker news_article_chunks:article_id,chunk_index research_notes:id analysis_reports:id"
)
REFERENCES = (
    "watchlists.user_id=users.id watchlist_tickers.watchlist_id=watchlists.id news_article_tickers.article_id=news_articles.article_id "
    "news_article_chunks.article_id=news_articles.article_id research_notes.user_id=users.id analysis_reports.user_id=users.id"
)


def _constraint_sql() -> str:
    ctes = [
        f"raw_{name} AS (SELECT {', '.join(f'{sql} AS {c}' for c, sql in columns.items())} FROM {table})"
        for name, (table, columns) in RAW_TABLES.items()
    ]
    parts = []
    for item in UNIQUE.split():
        name, keys = item.split(":")
        sound = " AND ".join(f"{k} IS NOT NULL" for k in keys.split(","))
        parts.append(f"SELECT '{name}' AS table_name, 'primary_key' AS rule_name, (SELECT count(*) FROM (SELECT 1 FROM raw_{name} WHERE {sound} GROUP BY {keys} HAVING count(*) > 1)) AS violations")
    for item in NOT_NULL.split():
        name, column = item.split(".")
        parts.append(f"SELECT '{name}', 'not_null:{column}', (SELECT count(*) FROM raw_{name} WHERE {column} IS NULL)")
    for item in REFERENCES.split():
        child, parent = (x.split(".") for x in item.split("="))
        parts.append(
            f"SELECT '{child[0]}', 'foreign_key:{child[1]}', (SELECT count(*) FROM raw_{child[0]} c WHERE c.{child[1]} IS NOT NULL "
            f"AND NOT EXISTS (SELECT 1 FROM raw_{parent[0]} p WHERE p.{parent[1]} = c.{child[1]}))"
        )
    return "WITH " + ",\n".join(ctes) + "\n" + "\nUNION ALL ".join(parts)


@query("declared_constraints", _constraint_sql())
def declared_constraints(d: Data) -> DataFrame:
    tables = {name: d.table(table).selectExpr(*[f"{sql} AS {c}" for c, sql in columns.items()]) for name, (table, columns) in RAW_TABLES.items()}
    return quality.check_tables(tables)


@query(
    "schema_differences",
    with_ctes(
        "b_companies",
        """
SELECT 'missing' AS side, ticker FROM (SELECT ticker FROM b_companies EXCEPT SELECT concat('S', user_id) FROM events)
UNION ALL SELECT 'unexpected', ticker FROM (SELECT concat('S', user_id) AS ticker FROM events EXCEPT SELECT ticker FROM b_companies)""",
    ),
)
def schema_differences(d: Data) -> DataFrame:
    used = d.table("events").select(F.concat(F.lit("S"), text("user_id")).alias("ticker"))
    return quality.set_differences(d.companies(), used, "ticker")


# ---------------------------------------------------------------- retrieval


def _hit_columns(hits: DataFrame, *more: str) -> DataFrame:
    return hits.select(
        "article_id", "chunk_index", "chunk_text", "title", "publisher_name", "published_at", "ticker", "sentiment",
        r6("distance").alias("distance"), r6("similarity").alias("similarity"), joined("tickers").alias("tickers"),
    )


SEARCH_SQL = """
SELECT s.article_id, s.chunk_index, s.chunk_text, a.title, a.publisher AS publisher_name, a.published_at, s.ticker, s.sentiment,
       round(s.distance, 6) AS distance, round(greatest(-1, least(1, 1 - s.distance)), 6) AS similarity, coalesce(r.tickers, '') AS tickers
FROM ({scored}) s JOIN b_articles a ON a.article_id = s.article_id LEFT JOIN b_related r ON r.article_id = s.article_id
"""
DISTANCE_SQL = "round(list_cosine_distance(CAST(c.embedding AS DOUBLE[]), CAST((SELECT query FROM b_question) AS DOUBLE[])), 12)"


@query(
    "semantic_search",
    with_ctes(
        "b_chunks b_articles b_related b_question",
        SEARCH_SQL.format(
            scored=f"""SELECT c.article_id, c.chunk_index, c.chunk_text, CAST(NULL AS VARCHAR) AS ticker, CAST(NULL AS VARCHAR) AS sentiment,
  {DISTANCE_SQL} AS distance FROM b_chunks c WHERE c.embedding IS NOT NULL ORDER BY distance, article_id, chunk_index LIMIT 20"""
        ),
    ),
)
def semantic_search(d: Data) -> DataFrame:
    hits = search.search(d.chunks(), d.question_vector(), 20)
    return _hit_columns(search.describe_hits(hits, d.chunks(), d.articles(), d.article_tickers()))


@query(
    "semantic_search_ticker",
    with_ctes(
        "b_chunks b_articles b_related b_question b_article_tickers",
        f"""
SELECT article_id, chunk_index, title, publisher_name AS publisher, published_at, sentiment, similarity, chunk_text FROM ({SEARCH_SQL.format(
            scored=f'''SELECT c.article_id, c.chunk_index, c.chunk_text, t.ticker, t.sentiment, {DISTANCE_SQL} AS distance
  FROM b_chunks c JOIN b_article_tickers t ON t.article_id = c.article_id
  WHERE c.embedding IS NOT NULL AND t.ticker = 'S7' ORDER BY distance, article_id, chunk_index LIMIT 10'''
        )})""",
    ),
)
def semantic_search_ticker(d: Data) -> DataFrame:
    links = d.article_tickers()
    hits = search.search(d.chunks(), d.question_vector(), 10, links, "S7")
    cited = search.citations(search.describe_hits(hits, d.chunks(), d.articles()))
    return cited.withColumn("similarity", r6("similarity")).drop("article_url", "sentiment_reasoning")


@query(
    "semantic_search_batch",
    with_ctes(
        "b_requests b_chunks",
        """
SELECT request_id, article_id, chunk_index, round(distance, 6) AS distance, CAST(rank AS INTEGER) AS rank FROM (
  SELECT *, row_number() OVER (PARTITION BY request_id ORDER BY distance NULLS LAST, article_id, chunk_index) AS rank FROM (
    SELECT r.request_id, c.article_id, c.chunk_index,
           round(list_cosine_distance(CAST(c.embedding AS DOUBLE[]), CAST(r.query AS DOUBLE[])), 12) AS distance
    FROM b_requests r, b_chunks c WHERE c.embedding IS NOT NULL))
WHERE rank <= 8""",
    ),
)
def semantic_search_batch(d: Data) -> DataFrame:
    hits = search.search_batch(d.requests(), d.chunks(), 8)
    return hits.select("request_id", "article_id", "chunk_index", r6("distance").alias("distance"), "rank")


@query("approx_semantic_search")
def approx_semantic_search(d: Data) -> DataFrame:
    path = d.new_path("index")
    search.write_index(d.chunks(), path, cells=16)
    hits = search.search_index(d.requests(), path, 8, probes=12)
    return hits.select("request_id", "article_id", "chunk_index", r6("distance").alias("distance"), "rank")


@query(
    "diversify_evidence",
    with_ctes(
        "b_evidence",
        "SELECT request_id, ticker, article_id, chunk_index, sentiment, round(distance, 6) AS distance, CAST(position AS INTEGER) AS position FROM b_evidence",
    ),
)
def diversify_evidence(d: Data) -> DataFrame:
    hits = search.search_batch_by_ticker(d.requests(), d.chunks(), d.article_tickers(), search.candidate_limit(8))
    kept = search.diversify(hits, 8)
    return kept.select(
        "request_id", "ticker", "article_id", "chunk_index", "sentiment", r6("distance").alias("distance"), "position"
    )


def contexts(d: Data) -> DataFrame:
    return context.research_context(
        d.requests(), d.companies(), d.prices(), d.articles(), d.article_tickers(), d.chunks()
    )


@query(
    "research_context",
    with_ctes(
        "b_requests b_companies b_recent_prices b_recent_news b_evidence",
        """
SELECT r.request_id, r.ticker, r.question, c.name AS company_name, c.market_cap,
       CAST(CASE WHEN c.ticker IS NULL THEN 0 ELSE 1 END AS INTEGER) AS company_count,
       CAST(coalesce(p.n, 0) AS INTEGER) AS price_count, CAST(coalesce(n.n, 0) AS INTEGER) AS news_count,
       CAST(coalesce(e.n, 0) AS INTEGER) AS evidence_count,
       coalesce(p.days, '') AS price_dates, coalesce(n.news, '') AS news, coalesce(e.evidence, '') AS evidence
FROM b_requests r LEFT JOIN b_companies c ON c.ticker = r.ticker
LEFT JOIN (SELECT ticker, count(*) AS n, string_agg(CAST(price_date AS VARCHAR) || '=' || CAST(close AS VARCHAR), ',' ORDER BY position) AS days
           FROM b_recent_prices GROUP BY ticker) p ON p.ticker = r.ticker
LEFT JOIN (SELECT ticker, count(*) AS n, string_agg(article_id || ':' || coalesce(sentiment, ''), ',' ORDER BY rank) AS news
           FROM b_recent_news WHERE rank <= 5 GROUP BY ticker) n ON n.ticker = r.ticker
LEFT JOIN (SELECT request_id, count(*) AS n, string_agg(article_id || '/' || chunk_index || ':' || chunk_text, ',' ORDER BY position) AS evidence
           FROM b_evidence GROUP BY request_id) e ON e.request_id = r.request_id""",
    ),
)
def research_context(d: Data) -> DataFrame:
    out = contexts(d)
    counts = ["company_count", "price_count", "news_count", "evidence_count"]
    days = F.transform("prices", lambda p: F.concat(p["price_date"].cast("string"), F.lit("="), p["close"].cast("string")))
    news = F.transform("recent_news", lambda n: F.concat(n["article_id"], F.lit(":"), F.coalesce(n["sentiment"], F.lit(""))))
    evidence = F.transform(
        "semantic_evidence",
        lambda e: F.concat(e["article_id"], F.lit("/"), e["chunk_index"].cast("string"), F.lit(":"), e["chunk_text"]),
    )
    return out.select(
        "request_id", "ticker", "question", F.col("company.name").alias("company_name"), "company.market_cap",
        F.when(F.col("company").isNotNull(), 1).otherwise(0).alias(counts[0]),
        F.size("prices").alias(counts[1]), F.size("recent_news").alias(counts[2]),
        F.size("semantic_evidence").alias(counts[3]),
        joined(days).alias("price_dates"), joined(news).alias("news"), joined(evidence).alias("evidence"),
    )


@query(
    "research_context_json",
    with_ctes(
        "b_requests b_companies b_recent_prices b_recent_news b_evidence",
        """
SELECT r.request_id, r.ticker, r.question, CAST(c.market_cap AS VARCHAR) AS market_cap, p.first_date, p.first_close,
       p.first_open, p.first_high, p.first_low, p.first_vwap, p.first_volume,
       strftime(n.published_at, '%Y-%m-%dT%H:%M:%S') AS newest_published_at, n.title AS newest_title,
       n.publisher AS newest_publisher, n.article_url AS newest_url, n.sentiment_reasoning AS newest_reasoning,
       e.article_id || '/' || e.chunk_index AS evidence_key, e.chunk_text AS evidence_text, e.ticker AS evidence_ticker
FROM b_requests r LEFT JOIN b_companies c ON c.ticker = r.ticker
LEFT JOIN (SELECT ticker, CAST(price_date AS VARCHAR) AS first_date, CAST(close AS VARCHAR) AS first_close,
             CAST(open AS VARCHAR) AS first_open, CAST(high AS VARCHAR) AS first_high, CAST(low AS VARCHAR) AS first_low,
             CAST(vwap AS VARCHAR) AS first_vwap, CAST(volume AS VARCHAR) AS first_volume
           FROM b_recent_prices WHERE position = 1) p ON p.ticker = r.ticker
LEFT JOIN (SELECT * FROM b_recent_news WHERE rank = 1) n ON n.ticker = r.ticker
LEFT JOIN (SELECT * FROM b_evidence WHERE position = 1) e ON e.request_id = r.request_id""",
    ),
)
def research_context_json(d: Data) -> DataFrame:
    def at(path: str):
        return F.get_json_object("json", path)

    return context.context_json(contexts(d)).select(
        "request_id",
        at("$.ticker").alias("ticker"),
        at("$.question").alias("question"),
        at("$.company.market_cap").alias("market_cap"),
        at("$.prices[0].price_date").alias("first_date"),
        *[at(f"$.prices[0].{f}").alias(f"first_{f}") for f in ("close", "open", "high", "low", "vwap", "volume")],
        at("$.recent_news[0].published_at").alias("newest_published_at"),
        at("$.recent_news[0].title").alias("newest_title"),
        at("$.recent_news[0].publisher").alias("newest_publisher"),
        at("$.recent_news[0].article_url").alias("newest_url"),
        at("$.recent_news[0].sentiment_reasoning").alias("newest_reasoning"),
        F.concat(at("$.semantic_evidence[0].article_id"), F.lit("/"), at("$.semantic_evidence[0].chunk_index")).alias("evidence_key"),
        at("$.semantic_evidence[0].chunk_text").alias("evidence_text"),
        at("$.semantic_evidence[0].ticker").alias("evidence_ticker"),
    )


@query(
    "strip_vectors",
    """
SELECT vec_id, '{"id":' || vec_id || ',"parts":[{"label":' || label || '},{"label":' || (label + 1) || '}]}' AS payload FROM embeddings""",
)
def strip_vectors(d: Data) -> DataFrame:
    v = F.col("embedding")

    def part(label):
        return F.struct(label.alias("label"), v.alias("QUERY_EMBEDDING"))

    nested = F.struct(
        F.col("vec_id").alias("id"),
        v.alias("Vector"),
        F.array(part(F.col("label")), part(F.col("label") + 1)).alias("parts"),
    )
    rows = d.table("embeddings").select("vec_id", "embedding", nested.alias("payload"))
    out = context.strip_vectors(rows)
    return out.select(*[F.to_json(c).alias(c) if c == "payload" else F.col(c) for c in out.columns])


# ---------------------------------------------------------------- previews and requests

WS = tx.WS_CLASS


@query(
    "result_preview",
    f"""
SELECT doc_id, left(t, 160) AS line, left(t, 240) AS passage, left(t, 40) AS label,
       CASE WHEN length(text) > 280 THEN left(text, 277) || '…' ELSE text END AS card
FROM (SELECT doc_id, text, trim(regexp_replace(text, '{WS}+', ' ', 'g')) AS t FROM documents)""",
)
def result_preview(d: Data) -> DataFrame:
    c = F.col("text")
    return d.table("documents").select(
        "doc_id",
        tx.preview_line(c).alias("line"),
        tx.preview_line(c, 240).alias("passage"),
        tx.preview_line(c, 40).alias("label"),
        tx.card_preview(c).alias("card"),
    )


@query(
    "card_values",
    with_ctes(
        "b_prices b_companies",
        """
SELECT ticker, regexp_replace(format('{:,.2f}', CAST(close AS DOUBLE)), '\\.?0+$', '') AS latest_close, strftime(price_date, '%b %-d, %Y') AS latest_date,
       CASE WHEN market_cap < 0 THEN '-$' ELSE '$' END || CASE WHEN abs(market_cap) >= 999.995
         THEN regexp_replace(CAST(CAST(round(abs(market_cap) / 1000, 2) AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '') || 'K'
         ELSE regexp_replace(CAST(CAST(round(abs(market_cap), 2) AS DECIMAL(18,2)) AS VARCHAR), '\\.?0+$', '') END AS market_cap
FROM (SELECT ticker, arg_max(close, price_date) AS close, max(price_date) AS price_date FROM b_prices GROUP BY ticker)
JOIN b_companies USING (ticker)""",
    ),
)
def card_values(d: Data) -> DataFrame:
    latest = d.prices().groupBy("ticker").agg(
        F.max_by("close", "price_date").alias("close"), F.max("price_date").alias("price_date")
    )
    return latest.join(d.companies(), "ticker").select(
        "ticker",
        tx.display_number(F.col("close")).alias("latest_close"),
        tx.display_date(F.col("price_date")).alias("latest_date"),
        tx.compact_money(F.col("market_cap")).alias("market_cap"),
    )


@query(
    "similarity_clamp",
    with_ctes(
        "b_question",
        """
SELECT vec_id, factor, CASE WHEN abs(d) < CAST('inf' AS DOUBLE) THEN round(greatest(-1, least(1, 1 - d)), 6) END AS similarity,
       CASE WHEN abs(d) < CAST('inf' AS DOUBLE) THEN CAST(CAST(floor(round(greatest(-1, least(1, 1 - d)), 6) * 100 + 0.5) AS BIGINT) AS VARCHAR) || '% similarity'
            ELSE 'Similarity unavailable' END AS label
FROM (SELECT vec_id, factor, factor * round(list_cosine_distance(CAST(embedding AS DOUBLE[]), CAST((SELECT query FROM b_question) AS DOUBLE[])), 12) AS d
      FROM embeddings, (SELECT unnest([CAST(-2 AS DOUBLE), 0.5, 1, 3, CAST('inf' AS DOUBLE)]) AS factor))""",
    ),
)
def similarity_clamp(d: Data) -> DataFrame:
    factors = F.array(*[F.lit(float(x)) for x in (-2, 0.5, 1, 3, "inf")])
    asked = d.table("embeddings").withColumn("question", d.question_vector())
    scored = asked.select("vec_id", vectors.cosine_distance(F.col("embedding"), F.col("question")).alias("d"))
    scaled = scored.select("vec_id", "d", F.explode(factors).alias("factor"))
    s = r6(vectors.similarity(F.col("factor") * F.col("d")))
    return scaled.select("vec_id", "factor", s.alias("similarity"), tx.percent_label(s).alias("label"))


@query(
    "validate_requests",
    f"""
SELECT request_id, tool, ticker, question, lim AS "limit", CASE WHEN error IS NOT NULL THEN 'validation_error' END AS error_type, error AS error_message
FROM (SELECT *, CASE WHEN ticker IS NULL THEN 'invalid ticker'
    WHEN tool IN ('semantic_search', 'news_search', 'agent') AND question IS NULL THEN 'blank question'
    WHEN tool = 'agent' AND length(question) > 5000 THEN 'question too long'
    WHEN tool <> 'agent' AND lim IS NULL THEN 'limit out of bounds' END AS error
  FROM (SELECT request_id, tool, CASE WHEN regexp_matches(upper(trim(raw)), '{TICKER}') THEN upper(trim(raw)) END AS ticker,
      nullif(trim(regexp_replace(q, '{WS}+', ' ', 'g')), '') AS question,
      CASE tool WHEN 'price_history' THEN CASE WHEN l BETWEEN 1 AND 90 THEN l END WHEN 'news_search' THEN CASE WHEN l BETWEEN 1 AND 10 THEN l END
        WHEN 'recent_news' THEN CASE WHEN l BETWEEN 1 AND 100 THEN l END WHEN 'semantic_search' THEN CASE WHEN l >= 1 THEN least(l, 20) END END AS lim
    FROM (SELECT event_id AS request_id, CASE event_type WHEN 'view' THEN 'price_history' WHEN 'click' THEN 'news_search'
        WHEN 'error' THEN 'recent_news' WHEN 'signup' THEN 'semantic_search' ELSE 'agent' END AS tool,
        CASE WHEN value BETWEEN 85 AND 90 THEN ' bad ticker' ELSE ' k' || user_id || ' ' END AS raw,
        CASE WHEN value < 5 THEN ' ' WHEN value > 95 THEN repeat('why  ', 1300) ELSE ' why  ' || props END AS q,
        CAST(floor(value) AS BIGINT) AS l FROM events)))""",
)
def validate(d: Data) -> DataFrame:
    kind, value = F.col("event_type"), F.col("value")
    requests = d.table("events").select(
        F.col("event_id").alias("request_id"),
        F.when(kind == "view", "price_history")
        .when(kind == "click", "news_search")
        .when(kind == "error", "recent_news")
        .when(kind == "signup", "semantic_search")
        .otherwise("agent")
        .alias("tool"),
        F.when(value.between(85, 90), " bad ticker").otherwise(F.concat(F.lit(" k"), text("user_id"), F.lit(" "))).alias("ticker"),
        F.when(value < 5, " ")
        .when(value > 95, F.repeat(F.lit("why  "), 1300))
        .otherwise(F.concat(F.lit(" why  "), F.col("props")))
        .alias("question"),
        F.floor(value).cast("long").alias("limit"),
    )
    return validate_requests(requests)
