"""Text questions: validate, embed, retrieve."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marketloom.functions import text
from marketloom.operators import embed, search
from marketloom.schemas import EMBEDDING_DIMENSION


def embed_questions(
    requests: DataFrame,
    model_factory: embed.ModelFactory = embed.HashingModel,
    dimension: int = EMBEDDING_DIMENSION,
) -> DataFrame:
    """requests(request_id, question, ..) -> the same with normalized questions and a ``query`` vector.

    Requests with a blank question are left out. The result fits ``research_context``.
    """
    asked = requests.withColumn("question", text.question_text(F.col("question"))).filter("question IS NOT NULL")
    carried = [c for c in asked.columns if c != "query"]
    return embed.embed(asked, "question", carried, model_factory, dimension, output="query")


def semantic_news_search(
    requests: DataFrame,
    chunks: DataFrame,
    top_k: int = 5,
    article_tickers: DataFrame | None = None,
    model_factory: embed.ModelFactory = embed.HashingModel,
    dimension: int = EMBEDDING_DIMENSION,
) -> DataFrame:
    """requests(request_id, question[, ticker]) -> ranked hits; ``article_tickers`` binds them to the ticker."""
    asked = embed_questions(requests, model_factory, dimension)
    if article_tickers is None:
        return search.search_batch(asked, chunks, top_k)
    bound = asked.withColumn("ticker", text.normalize_ticker(F.col("ticker"))).filter("ticker IS NOT NULL")
    return search.search_batch_by_ticker(bound, chunks, article_tickers, top_k)
