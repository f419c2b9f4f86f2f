"""Landed payloads, keyed state and user actions."""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions import dates, variant
from marketloom.operators import reads, state
from marketloom.plans import actions as act, refresh
from marketloom.session import materialize
from marketloom.sources import landed
from marketloom.streaming import ingest
from registry.bindings import AS_OF, Data, as_of, text, with_ctes
from registry.catalog import joined, query

TICKER = r"^[A-Z][A-Z0-9]{0,4}([.-][A-Z0-9]{1,2})?$"


def epoch_ms(ts: str) -> Column:
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"), F.col(ts))


# ---------------------------------------------------------------- landed payloads


def company_payloads(d: Data) -> DataFrame:
    """JSON per supplier; region decides what is wrong with it."""
    region = F.col("r_name")
    result = F.struct(
        F.when(region != "EUROPE", F.concat(F.lit(" s"), text("s_suppkey"), F.lit(" "))).alias("ticker"),
        F.when(region == "ASIA", "  ").otherwise(F.concat(F.lit(" "), F.col("s_name"))).alias("name"),
        F.col("s_acctbal").alias("market_cap"),
        F.col("n_name").alias("primary_exchange"),
        region.alias("sic_description"),
        F.col("s_nationkey").alias("sic_code"),
        F.when(region == "AFRICA", "yes").alias("active_text"),
        F.when(region == "AFRICA", "1998-02-30").when(region == "AMERICA", "").otherwise("1998-02-03").alias("list_date"),
    )
    json = F.to_json(F.struct(result.alias("results")))
    # a JSON boolean, or the text "yes", which is none
    json = F.replace(F.replace(json, F.lit('"active_text":"yes"'), F.lit('"active":"yes"')), F.lit('"sic_code"'), F.lit('"locale":" us ","sic_code"'))
    json = F.when(region == "MIDDLE EAST", F.replace(json, F.lit('"locale"'), F.lit('"active":true,"locale"'))).otherwise(json)
    return d.located_suppliers().select(F.concat(F.lit("s"), text("s_suppkey")).alias("ticker"), json.alias("payload"))


@query(
    "normalize_companies",
    """
SELECT 'S' || s_suppkey AS ticker, CASE WHEN r_name <> 'ASIA' THEN s_name END AS name, CASE WHEN r_name <> 'ASIA' THEN s_name END AS legal_name,
       CAST(s_acctbal AS DECIMAL(24,4)) AS market_cap, n_name AS exchange, r_name AS industry, CASE WHEN r_name = 'MIDDLE EAST' THEN TRUE END AS active,
       CASE WHEN r_name IN ('ASIA', 'EUROPE', 'MIDDLE EAST') THEN DATE '1998-02-03' END AS list_date, CAST(NULL AS VARCHAR) AS sic_code, 'us' AS locale,
       CASE r_name WHEN 'ASIA' THEN 'missing name' WHEN 'AFRICA' THEN 'invalid list_date' END AS reject_reason
FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey""",
)
def normalize_companies(d: Data) -> DataFrame:
    out = landed.normalize_companies(company_payloads(d))
    return out.select(
        "ticker", "name", "legal_name", "market_cap", "exchange", "industry", "active", "list_date", "sic_code",
        "locale", "reject_reason",
    )


@query(
    "normalize_price_bars",
    """
SELECT 'K' || regexp_extract(props, '[0-9]+') AS ticker, CAST(0 AS INTEGER) AS bar_pos,
       CAST((to_timestamp(epoch_ms(ts) / 1000.0) AT TIME ZONE 'America/New_York') AS DATE) AS price_date,
       CAST(value AS DECIMAL(20,6)) AS close, CAST(user_id AS DECIMAL(24,4)) AS volume, CAST(NULL AS VARCHAR) AS reject_reason FROM events
UNION ALL
SELECT 'K' || regexp_extract(props, '[0-9]+'), 1, NULL, NULL, CAST(user_id AS DECIMAL(24,4)), 'bar without timestamp' FROM events""",
)
def normalize_price_bars(d: Data) -> DataFrame:
    good = F.to_json(F.struct(epoch_ms("ts").alias("t"), F.col("value").alias("c"), F.col("user_id").alias("v")))
    bad = F.to_json(F.struct(F.col("event_type").alias("t"), F.col("user_id").alias("v")))
    payload = F.concat(F.lit('{"results":['), good, F.lit(","), bad, F.lit("]}"))
    rows = d.table("events").select(
        F.concat(F.lit(" k"), F.get_json_object("props", "$.k")).alias("ticker"), payload.alias("payload")
    )
    return landed.normalize_price_bars(rows).select("ticker", "bar_pos", "price_date", "close", "volume", "reject_reason")


def news_payload() -> Column:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    publisher = F.when(
        status == "F", F.to_json(F.struct(F.concat(F.lit(" "), priority).alias("name")))
    ).otherwise(F.concat(F.lit('"'), priority, F.lit('"')))
    published = (
        F.when(priority == "5-LOW", "")
        .when(priority == "1-URGENT", F.concat(day, F.lit("T10:00:00")))
        .when(priority == "2-HIGH", F.concat(day, F.lit("T10:00:00+02:00")))
        .otherwise(F.concat(day, F.lit("T10:00:00Z")))
    )
    rest = F.to_json(
        F.struct(
            F.concat(F.lit(" "), text("o_orderkey")).alias("id"),
            F.when(status == "P", " ").otherwise(F.concat(F.lit("Order "), text("o_orderkey"))).alias("title"),
            F.col("o_custkey").alias("description"),
            F.concat(F.lit("https://news.example.org/"), text("o_orderkey")).alias("article_url"),
            published.alias("published_utc"),
        )
    )
    keywords = F.concat(F.lit('[" a ","",5,"'), status, F.lit('"]'))
    return F.concat(
        F.left(rest, F.length(rest) - 1), F.lit(',"publisher":'), publisher, F.lit(',"keywords":'), keywords, F.lit("}")
    )


@query(
    "normalize_news",
    """
SELECT CAST(o_orderkey AS VARCHAR) AS article_id, CASE WHEN o_orderstatus <> 'P' THEN 'Order ' || o_orderkey END AS title,
       CAST(NULL AS VARCHAR) AS description, o_orderpriority AS publisher, 'https://news.example.org/' || o_orderkey AS article_url,
       CASE o_orderpriority WHEN '5-LOW' THEN NULL WHEN '1-URGENT' THEN NULL WHEN '2-HIGH' THEN date_trunc('day', o_orderdate) + INTERVAL 8 HOUR
            ELSE date_trunc('day', o_orderdate) + INTERVAL 10 HOUR END AS published_at, 'a,' || o_orderstatus AS keywords,
       CASE WHEN o_orderstatus = 'P' THEN 'missing title' WHEN o_orderpriority = '1-URGENT' THEN 'invalid published_utc' END AS reject_reason
FROM orders""",
)
def normalize_news(d: Data) -> DataFrame:
    out = landed.normalize_news(d.table("orders").select(news_payload().alias("payload")))
    return out.select(
        "article_id", "title", "description", "publisher", "article_url",
        F.col("published_at").cast("timestamp_ntz").alias("published_at"),
        joined("keywords").alias("keywords"), "reject_reason",
    )


def relationship_payload() -> Column:
    s, q = F.concat(F.lit("s"), text("l_suppkey")), F.concat(F.lit("Q"), text("l_linenumber"))
    flag = F.col("l_returnflag")
    verdict = F.when(flag == "R", " negative ").when(flag == "A", "positive").otherwise(" ")
    listed = F.to_json(F.array(s, F.upper(s), F.concat(F.lit("p"), text("l_partkey")), F.lit("bad ticker!")))
    first = F.to_json(F.struct(s.alias("ticker"), F.lit("neutral").alias("sentiment")))
    last = F.to_json(F.struct(F.upper(s).alias("ticker"), verdict.alias("sentiment"), F.lit(3).alias("sentiment_reasoning")))
    extra = F.to_json(F.struct(q.alias("ticker"), F.lit("mixed").alias("sentiment"), flag.alias("sentiment_reasoning")))
    key = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey"))
    return F.concat(
        F.lit('{"id":"'), key, F.lit('","title":"t","tickers":'), listed,
        F.lit(',"insights":['), first, F.lit(",7,"), last, F.lit(","), extra, F.lit("]}"),
    )


@query(
    "news_ticker_relationships",
    f"""
WITH lines AS (SELECT l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS article_id, * FROM lineitem)
SELECT article_id, 'S' || l_suppkey AS ticker, CASE l_returnflag WHEN 'R' THEN 'negative' WHEN 'A' THEN 'positive' END AS sentiment,
       CAST(NULL AS VARCHAR) AS sentiment_reasoning, CAST(0 AS INTEGER) AS position FROM lines
UNION ALL SELECT article_id, 'P' || l_partkey, NULL, NULL, 1 FROM lines WHERE regexp_matches('P' || l_partkey, '{TICKER}')
UNION ALL SELECT article_id, 'Q' || l_linenumber, 'mixed', l_returnflag, CASE WHEN regexp_matches('P' || l_partkey, '{TICKER}') THEN 2 ELSE 1 END FROM lines""",
)
def news_ticker_relationships(d: Data) -> DataFrame:
    articles = landed.normalize_news(d.table("lineitem").select(relationship_payload().alias("payload")))
    return landed.article_ticker_rows(landed.accepted(articles))


@query(
    "paged_results",
    """
WITH pages AS (
  SELECT conv_id AS request_id, turn + 1 AS page_no, string_split(text, chr(10)) AS items, 'next-' || (length(text) % 40) AS next_url,
         length(text) % 11 <> 0 AS linked FROM conversations WHERE turn + 1 <= 4),
reached AS (
  SELECT *, coalesce(sum(len(items)) OVER w, 0) AS before, coalesce(bool_and(linked) OVER w, TRUE) AS chained FROM pages
  WINDOW w AS (PARTITION BY request_id ORDER BY page_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
read AS (SELECT *, linked AND before + len(items) < 8 AND page_no < 4 AS followed FROM reached WHERE chained AND before < 8),
bad AS (SELECT DISTINCT request_id FROM read WHERE followed GROUP BY request_id, next_url HAVING count(*) > 1)
SELECT request_id, page_no, CAST(before + pos AS BIGINT) AS result_no, items[pos] AS line, CAST(NULL AS VARCHAR) AS reject_reason
FROM (SELECT request_id, page_no, before, items, unnest(range(1, len(items) + 1)) AS pos FROM read WHERE request_id NOT IN (SELECT request_id FROM bad))
WHERE before + pos <= 8
UNION ALL SELECT request_id, NULL, NULL, NULL, 'invalid page' FROM bad""",
)
def paged_results(d: Data) -> DataFrame:
    """A conversation is a request and each turn a page; its lines are the results."""
    items = F.transform(F.split("text", "\n"), lambda line: F.struct(line.alias("line")))
    size = F.length("text")
    link = F.when(size % 11 != 0, F.concat(F.lit("next-"), text(size % 40)))
    pages = d.table("conversations").select(
        F.col("conv_id").alias("request_id"),
        (F.col("turn") + 1).alias("page_no"),
        F.to_json(F.struct(items.alias("results"), link.alias("next_url"))).alias("payload"),
    )
    out = landed.collect_pages(pages, max_results=8, max_pages=4)
    return out.select("request_id", "page_no", "result_no", F.get_json_object("result", "$.line").alias("line"), "reject_reason")


@query(
    "news_window",
    with_ctes(
        "b_links",
        """
SELECT ticker, article_id, published_at FROM b_links WHERE published_at >= TIMESTAMP '1996-01-01'
QUALIFY row_number() OVER (PARTITION BY ticker ORDER BY published_at DESC, article_id) <= 10""",
    ),
)
def news_window(d: Data) -> DataFrame:
    """Each ticker's ten newest articles since a given time."""
    dated = d.articles().select("article_id", "published_at")
    news = d.article_tickers().select("ticker", "article_id").join(dated, "article_id")
    since = F.lit("1996-01-01 00:00:00").cast("timestamp_ntz")
    return landed.newest_per_request(news, ["ticker"], 10, since).select("ticker", "article_id", "published_at")


@query(
    "canonical_json",
    """
SELECT event_id, CASE event_type WHEN 'view' THEN '{}' WHEN 'click' THEN '{}' ELSE
  '{"a":[' || user_id || ',"' || event_type || '"],"m":{"b":' || CAST(round(value * 100) AS BIGINT) || ',"y":null},"z":' || replace(props, ' ', '') || '}' END AS canonical
FROM events""",
)
def canonical_json(d: Data) -> DataFrame:
    kind = F.col("event_type")
    cents = F.round(F.col("value") * 100).cast("long").cast("string")
    payload = F.concat(
        F.lit('{"z": '), F.col("props"), F.lit(', "m": {"y": null, "b": '), cents, F.lit('}, "a": ['), text("user_id"),
        F.lit(', "'), kind, F.lit('"]}'),
    )
    raw = F.when(kind == "view", "[1, 2]").when(kind == "click", "{oops").otherwise(payload)
    return d.table("events").select("event_id", variant.canonical_json(raw).alias("canonical"))


@query(
    "price_windows",
    """
SELECT as_of, last_day - 10 AS start_date, last_day AS end_date
FROM (SELECT as_of, as_of - CAST(CASE isodow(as_of) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS INTEGER) AS last_day
      FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS as_of FROM orders))""",
)
def price_windows(d: Data) -> DataFrame:
    start, end = dates.price_window(F.col("as_of"))
    days = d.table("orders").select(F.col("o_orderdate").cast("date").alias("as_of")).distinct()
    return days.select("as_of", start.alias("start_date"), end.alias("end_date"))


@query(
    "refresh_summary",
    with_ctes(
        "b_companies",
        """
, windows AS (SELECT 'S' || s_suppkey AS ticker, r_name, last_day - 10 AS start_date, last_day AS end_date FROM (
  SELECT s_suppkey, r_name, d - CAST(CASE isodow(d) WHEN 1 THEN 3 WHEN 7 THEN 2 ELSE 1 END AS INTEGER) AS last_day
  FROM (SELECT s_suppkey, r_name, DATE '1999-03-01' + CAST(s_nationkey AS INTEGER) AS d
        FROM supplier JOIN nation ON n_nationkey = s_nationkey JOIN region ON r_regionkey = n_regionkey))),
bars AS (SELECT 'S' || l_suppkey AS ticker, CAST((to_timestamp(epoch_ms(l_shipdate + INTERVAL 15 HOUR) / 1000.0) AT TIME ZONE 'America/New_York') AS DATE) AS day FROM lineitem),
news AS (SELECT 'S' || l_suppkey AS ticker, CAST(l_orderkey AS VARCHAR) AS article_id, 'Line ' || l_orderkey AS title, l_shipdate AS published_at FROM lineitem),
kept AS (SELECT n.*, row_number() OVER (PARTITION BY n.ticker ORDER BY published_at DESC, article_id) AS rank
         FROM news n JOIN windows w ON w.ticker = n.ticker WHERE CAST(published_at AS DATE) >= start_date)
SELECT w.ticker, w.start_date, w.end_date, c.name, c.exchange,
       (SELECT count(*) FROM bars b WHERE b.ticker = w.ticker AND b.day BETWEEN w.start_date AND w.end_date) AS bars,
       (SELECT count(*) FROM kept k WHERE k.ticker = w.ticker AND k.rank <= 5) AS articles,
       coalesce((SELECT string_agg(title, '|' ORDER BY rank) FROM kept k WHERE k.ticker = w.ticker AND k.rank <= 3), '') AS titles
FROM windows w LEFT JOIN b_companies c ON c.ticker = w.ticker AND w.r_name NOT IN ('ASIA', 'AFRICA')""",
    ),
)
def refresh_summary(d: Data) -> DataFrame:
    requests = d.located_suppliers().select(
        F.concat(F.lit("S"), text("s_suppkey")).alias("ticker"),
        F.date_add(F.lit("1999-03-01").cast("date"), F.col("s_nationkey")).alias("as_of"),
    )
    line = d.table("lineitem").withColumn("ticker", F.concat(F.lit("S"), text("l_suppkey")))
    noon = epoch_ms("l_shipdate") + F.lit(15 * 3_600_000)
    bars = line.select(
        "ticker", F.to_json(F.struct(F.array(F.struct(noon.alias("t"), F.col("l_extendedprice").alias("c"))).alias("results"))).alias("payload")
    )
    news = line.select(
        "ticker",
        F.to_json(
            F.struct(
                text("l_orderkey").alias("id"),
                F.concat(F.lit("Line "), text("l_orderkey")).alias("title"),
                F.concat(F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")).alias("published_utc"),
            )
        ).alias("payload"),
    )
    companies = company_payloads(d).withColumn("ticker", F.upper("ticker"))
    out = refresh.refresh_summary(*refresh.refresh(requests, companies, bars, news))
    return out.withColumn("titles", F.array_join("titles", "|"))


# ---------------------------------------------------------------- keyed state

STAMP = f"TIMESTAMP '{AS_OF}'"


@query(
    "upsert_companies",
    with_ctes(
        "b_companies",
        f"""
, feed AS (SELECT 'S' || l_suppkey AS ticker, 'Supplier at line ' || l_linenumber AS name, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS industry,
    CAST(l_extendedprice AS DECIMAL(24,4)) AS market_cap FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_suppkey ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC, l_extendedprice DESC) = 1)
SELECT ticker, name, industry, market_cap, {STAMP} AS updated_at FROM feed
UNION ALL SELECT ticker, name, industry, market_cap, NULL FROM b_companies WHERE ticker NOT IN (SELECT ticker FROM feed)
UNION ALL SELECT 'R' || r_regionkey, r_name, NULL, NULL, NULL FROM region""",
    ),
)
def upsert_companies(d: Data) -> DataFrame:
    regions = d.table("region").select(F.concat(F.lit("R"), text("r_regionkey")).alias("ticker"), F.col("r_name").alias("name"))
    known = d.companies().select("ticker", "name", "industry", "market_cap")
    current = known.unionByName(regions, allowMissingColumns=True).withColumn("updated_at", F.lit(None).cast("timestamp_ntz"))
    seq = ["seq1", "seq2", "seq3", "seq4", "seq5"]
    return d.next_version("companies", current, lambda now: state.upsert(now, d.company_feed(), ["ticker"], seq, "updated_at", as_of()))


PRICES_SQL = with_ctes(
    "b_price_feed",
    f"""
SELECT ticker, price_date, close, volume, CASE line_status WHEN 'O' THEN {STAMP} END AS fetched_at FROM b_price_feed
QUALIFY row_number() OVER (PARTITION BY ticker, price_date ORDER BY line_status DESC, seq1 DESC, seq2 DESC, seq3 DESC) = 1""",
)


def finished_prices(d: Data) -> DataFrame:
    """Finished lines are the current table, open lines the incoming bars."""
    keys, seq = ["ticker", "price_date"], ["seq1", "seq2", "seq3"]
    return state.last_write(d.price_feed().filter("line_status = 'F'"), keys, seq).select(
        *keys, "close", "volume", F.lit(None).cast("timestamp_ntz").alias("fetched_at")
    )


@query("upsert_prices", PRICES_SQL)
def upsert_prices(d: Data) -> DataFrame:
    incoming = d.price_feed().filter("line_status = 'O'")
    keys, seq = ["ticker", "price_date"], ["seq1", "seq2", "seq3"]
    return d.next_version("prices", finished_prices(d), lambda now: state.upsert(now, incoming, keys, seq, "fetched_at", as_of()))


@query("stream_upsert_prices", PRICES_SQL)
def stream_upsert_prices(d: Data) -> DataFrame:
    """The same upsert, with the lines arriving as a stream of files."""
    keys, seq = ["ticker", "price_date"], ["seq1", "seq2", "seq3"]
    stream = (
        d.spark.readStream.schema(d.table("lineitem").schema).option("pathGlobFilter", "lineitem.parquet").parquet(d.dir)
    )
    changes = d.price_feed(stream).filter("line_status = 'O'")
    current = finished_prices(d)
    table = d.versioned("prices", current.schema)
    table.replace(current)
    ingest.start_upserts(changes, table, keys, seq, f"{table.path}/_checkpoint", "fetched_at", as_of()).awaitTermination()
    return table.read()


@query(
    "upsert_articles",
    with_ctes(
        "b_articles",
        f"""
, feed AS (SELECT CAST(l_orderkey AS VARCHAR) AS article_id, 'Line ' || l_linenumber AS title, CASE WHEN l_returnflag <> 'N' THEN l_returnflag END AS description,
    l_shipdate AS published_at FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) = 1)
SELECT article_id, title, description, published_at, {STAMP} AS synced_at FROM feed
UNION ALL SELECT article_id, title, description, published_at, NULL FROM b_articles a WHERE NOT EXISTS (SELECT 1 FROM feed f WHERE f.article_id = a.article_id)""",
    ),
)
def upsert_articles(d: Data) -> DataFrame:
    """Every line re-sends its order's article, with a NULL description where it was not returned."""
    feed = d.table("lineitem").select(
        text("l_orderkey").alias("article_id"),
        F.concat(F.lit("Line "), text("l_linenumber")).alias("title"),
        F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")).alias("description"),
        F.col("l_shipdate").alias("published_at"),
        F.col("l_linenumber").alias("seq1"), F.col("l_partkey").alias("seq2"), F.col("l_suppkey").alias("seq3"),
        F.col("l_extendedprice").alias("seq4"),
    )
    current = d.articles().select(
        "article_id", "title", "description", "published_at", F.lit(None).cast("timestamp_ntz").alias("synced_at")
    )
    return state.upsert(current, feed, ["article_id"], ["seq1", "seq2", "seq3", "seq4"], "synced_at", as_of())


@query(
    "upsert_article_tickers",
    with_ctes(
        "b_article_ticker_feed",
        """
SELECT article_id, ticker, sentiment, sentiment_reasoning FROM b_article_ticker_feed
QUALIFY row_number() OVER (PARTITION BY article_id, ticker ORDER BY line_status DESC, seq1 DESC, seq2 DESC, seq3 DESC) = 1""",
    ),
)
def upsert_article_tickers(d: Data) -> DataFrame:
    keys, seq = ["article_id", "ticker"], ["seq1", "seq2", "seq3"]
    feed = d.article_ticker_feed()
    current = state.last_write(feed.filter("line_status = 'F'"), keys, seq).drop("line_status", *seq)
    return state.upsert(current, feed.filter("line_status = 'O'"), keys, seq)


@query(
    "cascade_delete",
    with_ctes(
        "b_article_tickers b_chunks",
        """
SELECT 'news_article_tickers' AS table_name, article_id, ticker AS detail FROM b_article_tickers
WHERE article_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')
UNION ALL SELECT 'news_article_chunks', article_id, CAST(chunk_index AS VARCHAR) FROM b_chunks
WHERE article_id NOT IN (SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderstatus = 'P')""",
    ),
)
def cascade_delete(d: Data) -> DataFrame:
    """Deleting the articles of pending orders takes their ticker links and chunks along."""
    gone = d.table("orders").filter("o_orderstatus = 'P'").select(text("o_orderkey").alias("id"))
    links = state.cascade_delete(d.article_tickers(), "article_id", gone, "id")
    chunks = state.cascade_delete(d.chunks(), "article_id", gone, "id")
    return links.select(F.lit("news_article_tickers").alias("table_name"), "article_id", F.col("ticker").alias("detail")).unionByName(
        chunks.select(F.lit("news_article_chunks").alias("table_name"), "article_id", text("chunk_index").alias("detail"))
    )


# ---------------------------------------------------------------- users and their actions

USERS_SQL = f"""
b_users AS (SELECT * FROM b_known_users UNION ALL
  SELECT (SELECT max(id) FROM b_known_users) + row_number() OVER (ORDER BY left(md5(email), 4), email) AS id, email, {STAMP}, {STAMP}
  FROM (SELECT DISTINCT {{emails}}) WHERE email NOT IN (SELECT email FROM b_known_users))"""
EVENT_USERS = USERS_SQL.format(emails="'user' || user_id || '@example.com' AS email FROM events")


def event_emails(d: Data) -> DataFrame:
    from marketloom.functions.text import normalize_email

    raw = F.concat(F.lit(" User"), text("user_id"), F.lit("@Example.com "))
    return d.table("events").select(normalize_email(raw).alias("email"))


@query("users_get_or_create", with_ctes("b_known_users", f", {EVENT_USERS}\nSELECT id, email, created_at, updated_at FROM b_users"))
def users_get_or_create(d: Data) -> DataFrame:
    return state.get_or_create_users(d.known_users(), event_emails(d), as_of())


WATCHLISTS_SQL = f"""
b_known_lists AS (SELECT row_number() OVER (ORDER BY left(md5(CAST(id AS VARCHAR)), 4), id) AS id, id AS user_id FROM b_known_users),
b_lists AS (SELECT id, user_id, TIMESTAMP '2023-12-01 00:00:00' AS created_at FROM b_known_lists UNION ALL
  SELECT (SELECT max(id) FROM b_known_lists) + row_number() OVER (ORDER BY left(md5(CAST(id AS VARCHAR)), 4), id), id, {STAMP}
  FROM b_users WHERE id NOT IN (SELECT id FROM b_known_users))"""


def users_and_watchlists(d: Data) -> tuple[DataFrame, DataFrame]:
    """Both tables after the events, written once each, as they are used several times."""
    known = d.known_users()
    users = materialize(state.get_or_create_users(known, event_emails(d), as_of()))
    since = F.col("created_at")
    current = state.with_new_ids(known.select(F.col("id").alias("user_id"), "created_at"), ["user_id"]).select(
        "id", "user_id", F.lit(state.DEFAULT_WATCHLIST).alias("name"), since, since.alias("updated_at")
    )
    lists = state.get_or_create_watchlists(materialize(current), users.select(F.col("id").alias("user_id")), as_of())
    return users, materialize(lists)


@query(
    "default_watchlists",
    with_ctes("b_known_users", f", {EVENT_USERS}, {WATCHLISTS_SQL}\nSELECT id, user_id, 'My Watchlist' AS name, created_at FROM b_lists"),
)
def default_watchlists(d: Data) -> DataFrame:
    return users_and_watchlists(d)[1].select("id", "user_id", "name", "created_at")


@query(
    "cascade_users",
    with_ctes(
        "b_known_users b_held",
        f"""
, {EVENT_USERS}, {WATCHLISTS_SQL},
kept AS (SELECT id, email FROM b_users WHERE email NOT LIKE '%7@example.com')
SELECT 'user_watchlists' AS table_name, l.id AS owner_id, CAST(NULL AS VARCHAR) AS detail FROM b_lists l JOIN kept k ON k.id = l.user_id
UNION ALL SELECT 'watchlist_tickers', l.id, h.ticker FROM b_held h JOIN kept k ON k.email = h.user_email JOIN b_lists l ON l.user_id = k.id
UNION ALL SELECT 'research_notes', k.id, 'C' || turn FROM conversations c JOIN kept k ON k.email = 'u' || conv_id || '@example.com'""",
    ),
)
def cascade_users(d: Data) -> DataFrame:
    """Deleting users takes their watchlists, the tickers on those, and their notes along."""
    users, lists = users_and_watchlists(d)
    owners = users.select(F.col("email").alias("user_email"), F.col("id").alias("user_id"))
    listed = lists.select(F.col("id").alias("watchlist_id"), "user_id")
    tickers = d.held().join(owners, "user_email").join(listed, "user_id").select("watchlist_id", "ticker")
    notes = (
        d.table("conversations")
        .select(F.concat(F.lit("u"), text("conv_id"), F.lit("@example.com")).alias("user_email"), F.concat(F.lit("C"), text("turn")).alias("ticker"))
        .join(owners, "user_email")
    )
    gone = users.filter(F.col("email").like("%7@example.com"))
    gone_lists = state.cascaded_rows(lists, "user_id", gone, "id")

    def left(table: str, rows: DataFrame, owner: str, detail: Column) -> DataFrame:
        return rows.select(F.lit(table).alias("table_name"), F.col(owner).alias("owner_id"), detail.alias("detail"))

    return (
        left("user_watchlists", state.cascade_delete(lists, "user_id", gone, "id"), "id", F.lit(None).cast("string"))
        .unionByName(left("watchlist_tickers", state.cascade_delete(tickers, "watchlist_id", gone_lists, "id"), "watchlist_id", F.col("ticker")))
        .unionByName(left("research_notes", state.cascade_delete(notes, "user_id", gone, "id"), "user_id", F.col("ticker")))
    )


KEYS, SEQ = ["user_email", "ticker"], ["ts", "event_id"]


def results(d: Data) -> DataFrame:
    return state.watchlist_results(d.held(), d.actions(), KEYS, SEQ)


@query(
    "watchlist_apply",
    with_ctes(
        "b_actions b_held",
        """
SELECT event_id, user_email, ticker, action, action = 'add' AND prev = 'remove' AS added, action = 'add' AND prev = 'add' AS already_present,
       action = 'remove' AND prev = 'add' AS removed
FROM (SELECT a.*, coalesce(lag(action) OVER (PARTITION BY a.user_email, a.ticker ORDER BY ts, event_id),
        CASE WHEN h.ticker IS NOT NULL THEN 'add' ELSE 'remove' END) AS prev
      FROM b_actions a LEFT JOIN b_held h ON h.user_email = a.user_email AND h.ticker = a.ticker)""",
    ),
)
def watchlist_apply(d: Data) -> DataFrame:
    return results(d).select("event_id", *KEYS, "action", "added", "already_present", "removed")


@query(
    "watchlist_listing",
    with_ctes(
        "b_known_users b_actions b_held",
        f"""
, {EVENT_USERS}, {WATCHLISTS_SQL},
flags AS (SELECT a.*, h.added_at AS held_at, coalesce(lag(action) OVER (PARTITION BY a.user_email, a.ticker ORDER BY ts, event_id),
            CASE WHEN h.ticker IS NOT NULL THEN 'add' ELSE 'remove' END) AS prev
          FROM b_actions a LEFT JOIN b_held h ON h.user_email = a.user_email AND h.ticker = a.ticker),
members AS (
  SELECT user_email, ticker, coalesce(max(ts) FILTER (WHERE action = 'add' AND prev = 'remove'), any_value(held_at)) AS added_at
  FROM flags GROUP BY user_email, ticker HAVING arg_max(action, (ts, event_id)) = 'add'
  UNION ALL SELECT user_email, ticker, added_at FROM b_held h
  WHERE NOT EXISTS (SELECT 1 FROM b_actions a WHERE a.user_email = h.user_email AND a.ticker = h.ticker))
SELECT l.user_id, 'My Watchlist' AS name, m.ticker, m.added_at FROM members m JOIN b_users u ON u.email = m.user_email JOIN b_lists l ON l.user_id = u.id""",
    ),
)
def watchlist_listing(d: Data) -> DataFrame:
    users, lists = users_and_watchlists(d)
    members = state.watchlist_members(d.held(), results(d), KEYS, SEQ, "ts")
    owners = users.select(F.col("email").alias("user_email"), F.col("id").alias("user_id"))
    rows = (
        members.join(owners, "user_email")
        .join(lists.select(F.col("id").alias("watchlist_id"), "user_id"), "user_id")
        .select("watchlist_id", "ticker", "added_at")
    )
    return reads.watchlist_listing(lists, rows)


@query(
    "save_notes",
    with_ctes(
        "b_known_users",
        f"""
, notes AS (SELECT conv_id, turn, CASE WHEN role = 'system' THEN role ELSE 'n' || conv_id || '@example.com' END AS email,
    'C' || turn AS ticker, trim(text, ' ' || chr(9) || chr(10) || chr(13)) AS note_text FROM conversations),
checked AS (SELECT *, CASE WHEN email NOT LIKE '%@%' THEN 'invalid email' WHEN note_text = '' THEN 'Research note cannot be blank.'
    WHEN length(note_text) > 5000 THEN 'Research note must be at most 5000 characters.' END AS reason FROM notes),
{USERS_SQL.format(emails="email FROM checked WHERE reason IS NULL")}
SELECT 'saved' AS kind, row_number() OVER (ORDER BY left(md5(conv_id || chr(31) || turn), 4), conv_id, turn) AS id, u.id AS user_id, ticker, note_text, NULL AS reason
FROM checked c JOIN b_users u ON u.email = c.email WHERE reason IS NULL
UNION ALL SELECT 'rejected', NULL, NULL, NULL, NULL, reason FROM checked WHERE reason IS NOT NULL""",
    ),
)
def save_notes(d: Data) -> DataFrame:
    notes = d.table("conversations").select(
        F.when(F.col("role") == "system", F.col("role"))
        .otherwise(F.concat(F.lit("N"), text("conv_id"), F.lit("@example.com")))
        .alias("user_email"),
        F.concat(F.lit("c"), text("turn")).alias("ticker"),
        F.col("text").alias("note_text"),
        "conv_id",
        "turn",
    )
    _, saved, rejects = act.save_notes(d.known_users(), notes, ["conv_id", "turn"], as_of())
    return _outcome(saved.select("id", "user_id", "ticker", "note_text"), rejects)


def _outcome(saved: DataFrame, rejects: DataFrame) -> DataFrame:
    none = F.lit(None).cast("string")
    return saved.select(F.lit("saved").alias("kind"), "*", none.alias("reason")).unionByName(
        rejects.select(F.lit("rejected").alias("kind"), "reason"), allowMissingColumns=True
    )


WS_SQL = "' ' || chr(9) || chr(10) || chr(13)"


@query(
    "save_reports",
    with_ctes(
        "b_known_users",
        f"""
, reports AS (SELECT doc_id, 'r' || source || '@example.com' AS email, 'D' AS ticker,
    trim(CASE WHEN lang = 'es' THEN left(text, 201) ELSE left(text, 150) END, {WS_SQL}) AS title, trim(text, {WS_SQL}) AS report_text FROM documents),
checked AS (SELECT *, CASE WHEN title = '' THEN 'Analysis report title cannot be blank.' WHEN length(title) > 200 THEN 'Analysis report title must be at most 200 characters.'
    WHEN report_text = '' THEN 'Analysis report body cannot be blank.' WHEN length(report_text) > 20000 THEN 'Analysis report body must be at most 20000 characters.' END AS reason FROM reports),
{USERS_SQL.format(emails="email FROM checked WHERE reason IS NULL")}
SELECT 'saved' AS kind, row_number() OVER (ORDER BY left(md5(CAST(doc_id AS VARCHAR)), 4), doc_id) AS id, u.id AS user_id, ticker, title, report_text, NULL AS reason
FROM checked c JOIN b_users u ON u.email = c.email WHERE reason IS NULL
UNION ALL SELECT 'rejected', NULL, NULL, NULL, NULL, NULL, reason FROM checked WHERE reason IS NOT NULL""",
    ),
)
def save_reports(d: Data) -> DataFrame:
    reports = d.table("documents").select(
        F.concat(F.lit("R"), F.col("source"), F.lit("@Example.com")).alias("user_email"),
        F.lit("d").alias("ticker"),
        F.when(F.col("lang") == "es", F.left("text", F.lit(201))).otherwise(F.left("text", F.lit(150))).alias("title"),
        F.col("text").alias("report_text"),
        "doc_id",
    )
    _, saved, rejects = act.save_reports(d.known_users(), reports, ["doc_id"], as_of())
    return _outcome(saved.select("id", "user_id", "ticker", "title", "report_text"), rejects)
