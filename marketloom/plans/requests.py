"""Validation of tool requests: which are answered, with which bounds, and why others are not."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions import text

# Limits of each tool, and the longest question the agent route takes.
TOOL_LIMITS = {"price_history": 90, "news_search": 10, "recent_news": 100}
MAX_AGENT_QUESTION = 5000


def validate_requests(requests: DataFrame) -> DataFrame:
    """requests(request_id, tool, ticker, question, limit) -> normalized fields and an error or NULL.

    ``limit`` is rejected outside the tool's bounds; ``semantic_search`` clamps it instead. Tools
    that read text need a question; the agent's is bounded after white space is collapsed.
    """
    tool, limit, ticker, question = (F.col(c) for c in ("tool", "limit", "ticker", "question"))
    # normalized behind a one-element generator, so that what follows reads the results and repeats no pattern
    asked = requests.select(
        "request_id", "tool", "limit",
        F.inline(F.array(F.struct(text.normalize_ticker(ticker).alias("ticker"), text.question_text(question).alias("question")))),
    )
    bounded: Column = F.lit(None).cast("long")
    for name, maximum in TOOL_LIMITS.items():
        bounded = F.when(tool == name, text.bounded_limit(limit, maximum)).otherwise(bounded)
    bounded = F.when(tool == "semantic_search", text.top_k(limit)).otherwise(bounded)
    needs_limit = tool.isin("semantic_search", *TOOL_LIMITS)
    needs_question = tool.isin("semantic_search", "news_search", "agent")
    error = (
        F.when(ticker.isNull(), "invalid ticker")
        .when(needs_question & question.isNull(), "blank question")
        .when((tool == "agent") & (F.length(question) > MAX_AGENT_QUESTION), "question too long")
        .when(needs_limit & bounded.isNull(), "limit out of bounds")
    )
    return asked.select(
        "request_id", "tool", "ticker", "question",
        bounded.cast("long").alias("limit"),
        F.when(error.isNotNull(), F.lit("validation_error")).alias("error_type"),
        error.alias("error_message"),
    )
