"""Keyed table maintenance as ``(current, changes) -> next`` functions over whole tables.

Change feeds carry an explicit, total write order (``seq``): the last write of a key wins, and a
NULL in it overwrites. Reductions keep one row per key and task before they shuffle, so a key that
holds a third of the feed arrives as a few rows; the rest are anti joins on distinct keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from marketloom.functions import vectors
from marketloom.session import materialize

DEFAULT_WATCHLIST = "My Watchlist"
ID_BUCKET_DIGITS = 4  # 16**4 id buckets


def last_write(changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key: the one written last."""
    return _first_by(changes, keys, [F.col(c).desc() for c in seq])


def first_write(changes: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """One row per key: the one written first."""
    return _first_by(changes, keys, [F.col(c).asc() for c in seq])


def _first_by(changes: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    # the planner keeps one row per key and task before the shuffle (WindowGroupLimit)
    number = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return changes.withColumn("_rn", number).filter("_rn = 1").drop("_rn")


def key_reason(rows: DataFrame, keys: Sequence[str]) -> Column:
    """Why a row cannot be stored under its key: a NULL key column, or a blank one; else NULL."""
    kinds = dict(rows.dtypes)
    checks = []
    for k in keys:
        checks.append(F.when(F.col(k).isNull(), F.lit(f"missing {k}")))
        if kinds[k] == "string":
            checks.append(F.when(F.btrim(k) == "", F.lit(f"blank {k}")))
    return F.coalesce(*checks)


def refused(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The changes that ``upsert`` and ``insert_absent`` leave out, with a reason."""
    return changes.withColumn("reason", key_reason(changes, keys)).filter("reason IS NOT NULL")


def upsert(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    seq: Sequence[str],
    touch: str | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Insert or overwrite by key; ``touch`` is stamped with ``as_of`` on every written row. Changes with a NULL or
    blank key are left out (``refused`` lists them).

    Untouched rows pass through an anti join on the changed keys, which is a broadcast join (no
    shuffle of ``current``) whenever the planner measures those keys to be small enough.
    """
    changes = changes.filter(key_reason(changes, keys).isNull())
    written = last_write(changes, keys, seq)
    if touch is not None:
        written = written.withColumn(touch, as_of)
    kept = current.join(changes.select(*keys).distinct(), list(keys), "left_anti")
    return kept.unionByName(written.select(*current.columns))


def insert_absent(current: DataFrame, rows: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Rows of ``rows`` whose key is new, the first write of each; rows with a NULL or blank key are left out."""
    rows = rows.filter(key_reason(rows, keys).isNull())
    return first_write(rows, keys, seq).join(current.select(*keys), list(keys), "left_anti")


def with_new_ids(rows: DataFrame, unique_by: Sequence[str], start: Column | None = None, name: str = "id") -> DataFrame:
    """Dense ids ``start + 1 ..`` in the order of (md5 bucket, unique_by), without a global sort.

    Rows are numbered inside 65,536 hash buckets and shifted by the count of all lower buckets;
    only that fixed-size table of counts is ever in one task. Ids depend on the data alone, so a
    recomputed partition gets the same ones.
    """
    key = F.concat_ws("\x1f", *[F.col(c).cast("string") for c in unique_by])
    bucketed = rows.withColumn("_bucket", F.left(F.md5(key), F.lit(ID_BUCKET_DIGITS)))
    sizes = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    lower = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)  # at most 65,536 rows
    offsets = sizes.select("_bucket", F.coalesce(F.sum("_n").over(lower), F.lit(0)).alias("_offset"))
    number = F.row_number().over(W.partitionBy("_bucket").orderBy(*unique_by))
    first = start if start is not None else F.lit(0)
    return (
        bucketed.withColumn("_number", number)
        .join(F.broadcast(offsets), "_bucket")  # at most 65,536 rows
        .withColumn(name, (first + F.col("_offset") + F.col("_number")).cast("long"))
        .drop("_bucket", "_number", "_offset")
    )


def max_id(table: DataFrame, name: str = "id") -> Column:
    """The highest id of a table (0 when empty) as a scalar subquery."""
    return F.coalesce(table.agg(F.max(name)).scalar(), F.lit(0))


def get_or_create_users(users: DataFrame, emails: DataFrame, as_of: Column) -> DataFrame:
    """Users plus one new row per unknown email; known rows keep their timestamps."""
    unknown = emails.select("email").filter("email IS NOT NULL").distinct().join(users, "email", "left_anti")
    created = with_new_ids(unknown, ["email"], max_id(users))
    return users.unionByName(
        created.withColumn("created_at", as_of).withColumn("updated_at", as_of).select(*users.columns)
    )


def get_or_create_watchlists(watchlists: DataFrame, user_ids: DataFrame, as_of: Column) -> DataFrame:
    """Every user's default watchlist; existing ones are untouched."""
    wanted = user_ids.select("user_id").distinct().withColumn("name", F.lit(DEFAULT_WATCHLIST))
    missing = wanted.join(watchlists.select("user_id", "name"), ["user_id", "name"], "left_anti")
    created = with_new_ids(missing, ["user_id"], max_id(watchlists))
    return watchlists.unionByName(
        created.withColumn("created_at", as_of).withColumn("updated_at", as_of).select(*watchlists.columns)
    )


def watchlist_results(members: DataFrame, actions: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Each add/remove action with what it did: added, already_present, removed.

    An action's effect depends on the one before it on the same key, or on ``members`` for the first. Actions are cut into
    blocks by ranges of (key, seq), so even one user's, ticker's and day's actions are dealt over several. A block is summed up by its
    last action; summaries of neighbouring blocks join to the later one's, so what a block begins with is the last action of the
    nearest block before it. Only one row per key and block takes part in that, however hot a key is.
    """
    keys = list(keys)
    parts = max(1, int(actions.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    # written once: range borders come from a sample, and a block must not change when a task runs again
    blocked = materialize(actions.repartitionByRange(parts, *keys, *seq).withColumn("_block", F.spark_partition_id()))
    inside = W.partitionBy(*keys, "_block").orderBy(*seq)
    acts = blocked.withColumn("_prev", F.lag("action").over(inside))
    blocks = blocked.groupBy(*keys, "_block").agg(F.max_by("action", F.struct(*seq)).alias("_last"))
    carried = blocks.select(
        *keys, "_block", F.lag("_last").over(W.partitionBy(*keys).orderBy("_block")).alias("_carried")
    )
    member = members.select(*keys).distinct().withColumn("_member", F.lit("add"))
    carried = carried.join(member, keys, "left").select(
        *keys, "_block", F.coalesce("_carried", "_member", F.lit("remove")).alias("_carried")
    )
    present = F.coalesce(F.col("_prev"), F.col("_carried")) == "add"
    add = F.col("action") == "add"
    return acts.join(carried, keys + ["_block"]).select(
        *actions.columns,
        (add & ~present).alias("added"),
        (add & present).alias("already_present"),
        (~add & present).alias("removed"),
    )


def watchlist_members(members: DataFrame, results: DataFrame, keys: Sequence[str], seq: Sequence[str], added_at: str) -> DataFrame:
    """Membership (keys, added_at) after the actions of ``watchlist_results``.

    A key is a member when its last action is an add; it dates from its last effective add, or
    keeps its old date when it never left.
    """
    keys = list(keys)
    order = F.struct(*seq)
    after = results.groupBy(*keys).agg(
        F.max_by("action", order).alias("_last"),
        F.max_by(added_at, F.when(F.col("added"), order)).alias("_since"),
    )
    held = members.select(*keys, F.col("added_at").alias("_held"))
    acted = after.filter("_last = 'add'").join(held, keys, "left").select(
        *keys, F.coalesce("_since", "_held").alias("added_at")
    )
    return members.select(*keys, "added_at").join(after.select(*keys), keys, "left_anti").unionByName(acted)


def replace_chunks(current: DataFrame, replaced: DataFrame, chunks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Chunks of every article in ``replaced`` are swapped for those in ``chunks`` (none: deleted)
    -> (next chunks, refused articles with reason).

    Replacements are numbered from 0 in the order of the index they were sent with. An article with a
    blank replacement chunk is refused and left as it is.
    """
    body = F.nullif(F.btrim("chunk_text"), F.lit(""))
    blank = chunks.filter(body.isNull()).select("article_id").distinct()
    ids = replaced.select("article_id").distinct().join(blank, "article_id", "left_anti")
    place = F.row_number().over(W.partitionBy("article_id").orderBy("chunk_index", "chunk_text")) - 1
    fresh = chunks.join(ids, "article_id", "left_semi").select(
        "article_id", place.cast("int").alias("chunk_index"), body.alias("chunk_text")
    )
    kept = current.join(ids, "article_id", "left_anti")
    refused = replaced.select("article_id").distinct().join(blank, "article_id", "left_semi")
    return kept.unionByName(fresh, allowMissingColumns=True), refused.withColumn("reason", F.lit("blank replacement chunk"))


def set_embeddings(current: DataFrame, updates: DataFrame, dimension: int, seq: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Set embedding and model on existing chunks -> (next chunks, rejected updates with reason)."""
    keys = ["article_id", "chunk_index"]
    reason = F.when(
        F.coalesce(F.size("embedding"), F.lit(0)) != dimension, F.lit("wrong embedding size")
    ).when(~vectors.is_valid_vector(F.col("embedding"), dimension), F.lit("embedding is not finite")).when(F.coalesce(F.btrim("embedding_model"), F.lit("")) == "", F.lit("missing embedding model"))
    checked = updates.withColumn("reason", reason)
    sound = checked.filter("reason IS NULL").drop("reason")
    new = last_write(sound, keys, seq).select(
        *keys, F.col("embedding").alias("_embedding"), F.col("embedding_model").alias("_model")
    )
    updated = current.join(new, keys, "left").select(
        *[c for c in current.columns if c not in ("embedding", "embedding_model")],
        F.coalesce("_embedding", "embedding").alias("embedding"),
        F.coalesce("_model", "embedding_model").alias("embedding_model"),
    )
    unmatched = sound.join(current.select(*keys), keys, "left_anti").withColumn("reason", F.lit("chunk not found"))
    rejects = checked.filter("reason IS NOT NULL").unionByName(unmatched)
    return updated, rejects


def cascade_delete(rows: DataFrame, foreign_key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child rows whose parent is not deleted."""
    gone = deleted.select(F.col(deleted_key).alias(foreign_key)).distinct()
    return rows.join(gone, foreign_key, "left_anti")


def cascaded_rows(rows: DataFrame, foreign_key: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child rows that go with their deleted parents, to cascade further."""
    gone = deleted.select(F.col(deleted_key).alias(foreign_key)).distinct()
    return rows.join(gone, foreign_key, "left_semi")
