"""Upserts from a stream: each batch is applied to the newest version of a keyed table, once.

A step reads the table and its own batch, nothing of earlier batches. The version it commits carries the batch's number, so a
batch that is replayed after a crash, before or after that commit, never applies twice. Order across batches is
their order of arrival; inside a batch it is ``seq``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.query import StreamingQuery

from marketloom.operators import state
from marketloom.sources.versions import VersionedTable


def start_upserts(
    changes: DataFrame,
    table: VersionedTable,
    keys: Sequence[str],
    seq: Sequence[str],
    checkpoint_path: str,
    touch: str | None = None,
    as_of: Column | None = None,
    stream: str = "changes",
) -> StreamingQuery:
    """Apply everything available now. ``stream`` names the source among all that feed the table, and goes with its checkpoint."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        table.apply_batch(stream, batch_id, lambda current: state.upsert(current, batch, keys, seq, touch, as_of))

    return (
        changes.writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint_path)
        .trigger(availableNow=True)
        .start()
    )
