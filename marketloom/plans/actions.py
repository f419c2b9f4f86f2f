"""Explicit user actions: notes and reports. Validation comes before any side effect."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions import text
from marketloom.operators import state

# Longest note, report title and report body.
MAX_NOTE, MAX_TITLE, MAX_REPORT = 5000, 200, 20000


def _checked(actions: DataFrame, fields: dict[str, tuple[str, int]]) -> DataFrame:
    """Normalized columns plus ``reason``; texts are trimmed in a projection of their own, once."""
    trimmed = actions.withColumns(
        {
            "email": text.normalize_email(F.col("user_email")),
            "ticker": text.normalize_ticker(F.col("ticker")),
            **{c: text.trim_ws(F.col(c)) for c in fields},
        }
    )
    errors = [F.when(F.col("email").isNull(), F.lit("invalid email"))]
    errors.append(F.when(F.col("ticker").isNull(), F.lit("invalid ticker")))
    errors += [text.bounded_text_error(F.col(c), label, maximum) for c, (label, maximum) in fields.items()]
    return trimmed.withColumn("reason", F.coalesce(*errors))


def _save(users: DataFrame, actions: DataFrame, fields: dict[str, tuple[str, int]], seq: Sequence[str], as_of: Column, start: Column | None):
    checked = _checked(actions, fields)
    sound = checked.filter("reason IS NULL")
    # owners and ids are found for the keys alone; the texts join them once
    narrow = sound.select(*seq, "email")
    all_users = state.get_or_create_users(users, narrow, as_of)
    owned = narrow.join(all_users.select(F.col("id").alias("user_id"), "email"), "email").drop("email")
    saved = sound.join(state.with_new_ids(owned, seq, start), list(seq)).select(
        "id", "user_id", "ticker", *fields, as_of.alias("created_at"), as_of.alias("updated_at")
    )
    rejects = checked.filter("reason IS NOT NULL").select(*seq, "reason")
    return all_users, saved, rejects


def save_notes(users: DataFrame, actions: DataFrame, seq: Sequence[str], as_of: Column, start: Column | None = None):
    """actions(user_email, ticker, note_text, seq..) -> (users, new notes, rejects)."""
    return _save(users, actions, {"note_text": ("Research note", MAX_NOTE)}, seq, as_of, start)


def save_reports(users: DataFrame, actions: DataFrame, seq: Sequence[str], as_of: Column, start: Column | None = None):
    """actions(user_email, ticker, title, report_text, seq..) -> (users, new reports, rejects)."""
    fields = {"title": ("Analysis report title", MAX_TITLE), "report_text": ("Analysis report body", MAX_REPORT)}
    return _save(users, actions, fields, seq, as_of, start)
