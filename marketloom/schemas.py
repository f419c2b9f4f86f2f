"""Declared table schemas."""

from __future__ import annotations

from pyspark.sql import types as T

EMBEDDING_DIMENSION = 384


def _table(*fields: tuple[str, T.DataType] | tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(f[0], f[1], f[2] if len(f) > 2 else True) for f in fields])


_S, _L, _I, _TS = T.StringType(), T.LongType(), T.IntegerType(), T.TimestampType()
_PRICE, _AMOUNT = T.DecimalType(20, 6), T.DecimalType(24, 4)
VECTOR = T.ArrayType(T.FloatType(), containsNull=False)

TABLES: dict[str, T.StructType] = {
    "users": _table(("id", _L, False), ("email", _S, False), ("created_at", _TS), ("updated_at", _TS)),
    "watchlists": _table(
        ("id", _L, False), ("user_id", _L, False), ("name", _S, False), ("created_at", _TS), ("updated_at", _TS)
    ),
    "watchlist_tickers": _table(("watchlist_id", _L, False), ("ticker", _S, False), ("added_at", _TS)),
    "companies": _table(
        ("ticker", _S, False), ("name", _S, False), ("legal_name", _S), ("description", _S),
        ("market_cap", _AMOUNT), ("market", _S), ("exchange", _S), ("security_type", _S),
        ("active", T.BooleanType()), ("list_date", T.DateType()), ("sic_code", _S),
        ("sic_description", _S), ("industry", _S), ("homepage_url", _S), ("currency_name", _S),
        ("locale", _S), ("raw_source_payload", _S, False), ("updated_at", _TS),
    ),
    "price_snapshots": _table(
        ("ticker", _S, False), ("price_date", T.DateType(), False), ("open", _PRICE), ("high", _PRICE),
        ("low", _PRICE), ("close", _PRICE), ("volume", _AMOUNT), ("vwap", _PRICE), ("fetched_at", _TS),
    ),
    "news_articles": _table(
        ("article_id", _S, False), ("title", _S, False), ("description", _S), ("author", _S),
        ("publisher", _S), ("article_url", _S), ("published_at", _TS), ("keywords", T.ArrayType(_S)),
        ("raw_source_payload", _S, False), ("synced_at", _TS),
    ),
    "news_article_tickers": _table(
        ("article_id", _S, False), ("ticker", _S, False), ("sentiment", _S), ("sentiment_reasoning", _S)
    ),
    "news_article_chunks": _table(
        ("article_id", _S, False), ("chunk_index", _I, False), ("chunk_text", _S, False), ("created_at", _TS),
        ("embedding", VECTOR), ("embedding_model", _S),
    ),
    "research_notes": _table(
        ("id", _L, False), ("user_id", _L, False), ("ticker", _S, False), ("note_text", _S, False),
        ("created_at", _TS), ("updated_at", _TS),
    ),
    "analysis_reports": _table(
        ("id", _L, False), ("user_id", _L, False), ("ticker", _S, False), ("title", _S, False),
        ("report_text", _S, False), ("created_at", _TS), ("updated_at", _TS),
    ),
}

PRIMARY_KEYS: dict[str, list[str]] = {
    "users": ["id"],
    "watchlists": ["id"],
    "watchlist_tickers": ["watchlist_id", "ticker"],
    "companies": ["ticker"],
    "price_snapshots": ["ticker", "price_date"],
    "news_articles": ["article_id"],
    "news_article_tickers": ["article_id", "ticker"],
    "news_article_chunks": ["article_id", "chunk_index"],
    "research_notes": ["id"],
    "analysis_reports": ["id"],
}

# child table -> (foreign key column, parent table, parent key column)
FOREIGN_KEYS: dict[str, tuple[str, str, str]] = {
    "watchlists": ("user_id", "users", "id"),
    "watchlist_tickers": ("watchlist_id", "watchlists", "id"),
    "news_article_tickers": ("article_id", "news_articles", "article_id"),
    "news_article_chunks": ("article_id", "news_articles", "article_id"),
    "research_notes": ("user_id", "users", "id"),
    "analysis_reports": ("user_id", "users", "id"),
}
