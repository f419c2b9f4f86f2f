import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.operators import quality, reads, state
from marketloom.plans import actions
from marketloom.sources.versions import ConflictError, VersionedTable
from marketloom.streaming import ingest

NOW = dt.datetime(2026, 1, 1)


def as_of():
    return F.lit(NOW)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_upsert_last_write_wins_and_nulls_overwrite(spark):
    cur = spark.createDataFrame([("A", "a", 1.0, None), ("B", "b", 2.0, None)], "k string, name string, v double, at timestamp")
    ch = spark.createDataFrame([("A", "a2", 5.0, 1), ("A", None, None, 2), ("C", "c", 3.0, 1)], "k string, name string, v double, seq int")
    nxt = state.upsert(cur, ch, ["k"], ["seq"], "at", as_of())
    want = [("A", None, None, NOW), ("B", "b", 2.0, None), ("C", "c", 3.0, NOW)]
    assert rows(nxt, "k", "name", "v", "at") == sorted(want, key=str)
    again = state.upsert(nxt, ch, ["k"], ["seq"], "at", as_of())
    assert rows(again, "k", "name", "v", "at") == sorted(want, key=str)


def test_hot_key_is_reduced_before_the_shuffle(spark):
    feed = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), "id")
    plan = state.last_write(feed, ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    partial = plan.rindex("WindowGroupLimit")
    assert plan.index("Exchange") < partial and "Partial" in plan[partial : partial + 200]
    got = {r.k: r.id for r in state.last_write(feed, ["k"], ["id"]).filter("k = 'hot'").collect()}
    assert got == {"hot": 29_997}


def test_insert_absent_keeps_the_first(spark):
    cur = spark.createDataFrame([("A", 1)], "k string, at int")
    new = spark.createDataFrame([("A", 9), ("B", 5), ("B", 3)], "k string, at int")
    assert rows(state.insert_absent(cur, new, ["k"], ["at"]), "k", "at") == [("B", 3)]


def test_ids_are_dense_unique_and_stable(spark):
    df = spark.range(5000).select(F.concat(F.lit("u"), "id").alias("email"))
    a = {r.email: r.id for r in state.with_new_ids(df, ["email"], F.lit(10)).collect()}
    b = {r.email: r.id for r in state.with_new_ids(df.repartition(3), ["email"], F.lit(10)).collect()}
    assert a == b and sorted(a.values()) == list(range(11, 5011))


def test_users_and_watchlists_are_created_once(spark):
    users = spark.createDataFrame([(7, "a@x", NOW, NOW)], "id long, email string, created_at timestamp, updated_at timestamp")
    emails = spark.createDataFrame([("a@x",), ("b@x",), ("b@x",), (None,)], "email string")
    nxt = state.get_or_create_users(users, emails, as_of())
    assert rows(nxt, "id", "email") == [(7, "a@x"), (8, "b@x")]
    assert rows(state.get_or_create_users(nxt, emails, as_of()), "id") == [(7,), (8,)]
    empty = spark.createDataFrame([], "id long, user_id long, name string, created_at timestamp, updated_at timestamp")
    lists = state.get_or_create_watchlists(empty, nxt.select(F.col("id").alias("user_id")), as_of())
    assert lists.count() == 2 and {r.name for r in lists.collect()} == {"My Watchlist"}


def test_watchlist_actions_across_blocks(spark):
    key = ["user", "ticker"]
    held = spark.createDataFrame([("u", "H", 0), ("v", "K", 0)], "user string, ticker string, added_at int")
    acts = [("u", "A", "add", 1), ("u", "A", "add", 2), ("u", "A", "remove", 11), ("u", "A", "remove", 12), ("u", "A", "add", 35),
            ("u", "H", "add", 3), ("u", "H", "remove", 40), ("u", "G", "remove", 5)]
    df = spark.createDataFrame(acts, "user string, ticker string, action string, seq int")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for parts in ("1", "8"):  # any number of blocks gives the same answer
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            res = state.watchlist_results(held, df, key, ["seq"])
            flags = {r.seq: (r.added, r.already_present, r.removed) for r in res.collect()}
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
        assert flags == {
            1: (True, False, False), 2: (False, True, False), 11: (False, False, True), 12: (False, False, False),
            35: (True, False, False), 3: (False, True, False), 40: (False, False, True), 5: (False, False, False),
        }
    assert rows(state.watchlist_members(held, res, key, ["seq"], "seq"), *key, "added_at") == [("u", "A", 35), ("v", "K", 0)]


def test_one_users_hot_ticker_is_dealt_over_blocks(spark):
    """One key holds most actions of one moment: they are spread, and every effect is that of the plain walk."""
    import random

    rng = random.Random(1)
    acts = [("u" if rng.random() < 0.8 else f"u{rng.randrange(50)}", "A", rng.choice(["add", "remove"]), i) for i in range(4000)]
    df = spark.createDataFrame(acts, "user string, ticker string, action string, seq int")
    held = spark.createDataFrame([("u", "A", 0)], "user string, ticker string, added_at int")
    now, want = {"u": True}, {}
    for user, _, action, i in acts:
        was = now.get(user, False)
        now[user] = action == "add"
        want[i] = (action == "add" and not was, action == "add" and was, action == "remove" and was)
    res = state.watchlist_results(held, df, ["user", "ticker"], ["seq"])
    assert {r.seq: (r.added, r.already_present, r.removed) for r in res.collect()} == want
    blocks = df.repartitionByRange(8, "user", "ticker", "seq").filter("user = 'u'").groupBy(F.spark_partition_id()).count().collect()
    assert len(blocks) >= 5 and max(r["count"] for r in blocks) < 1000


def test_replace_chunks(spark):
    cur = spark.createDataFrame([("a", 0, "x"), ("a", 1, "y"), ("b", 0, "z"), ("c", 0, "w")], "article_id string, chunk_index int, chunk_text string")
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "article_id string")
    new = spark.createDataFrame([("a", 3, " new "), ("a", 7, "newer"), ("c", 0, "ok"), ("c", 1, " ")], "article_id string, chunk_index int, chunk_text string")
    nxt, refused = state.replace_chunks(cur, ids, new)
    assert rows(nxt, "article_id", "chunk_index", "chunk_text") == [("a", 0, "new"), ("a", 1, "newer"), ("c", 0, "w")]
    assert rows(refused, "article_id", "reason") == [("c", "blank replacement chunk")]


def test_set_embeddings(spark):
    schema = "article_id string, chunk_index int, chunk_text string, embedding array<float>, embedding_model string"
    cur = spark.createDataFrame([("a", 0, "x", None, None), ("a", 1, "y", [1.0, 1.0], "m")], schema)
    ups = [("a", 0, [1.0, 2.0], "m", 1), ("a", 0, [3.0, 4.0], "m", 2), ("a", 1, [1.0], "m", 1), ("a", 1, [1.0, 2.0], " ", 1), ("z", 0, [1.0, 2.0], "m", 1), ("a", 1, [float("nan"), 1.0], "m", 1), ("a", 1, [None, 1.0], "m", 1)]
    nxt, rej = state.set_embeddings(cur, spark.createDataFrame(ups, "article_id string, chunk_index int, embedding array<float>, embedding_model string, seq int"), 2, ["seq"])
    assert {(r.chunk_index, tuple(r.embedding)) for r in nxt.collect()} == {(0, (3.0, 4.0)), (1, (1.0, 1.0))}
    assert sorted(r.reason for r in rej.collect()) == ["chunk not found", "embedding is not finite", "embedding is not finite", "missing embedding model", "wrong embedding size"]


def test_refresh_windows_are_one_per_normalized_ticker(spark):
    from pyspark.sql import functions as F

    from marketloom.plans import refresh

    asked = spark.createDataFrame([("AAPL",), (" aapl ",), ("no ticker!",), (None,)], "ticker string")
    empty = spark.createDataFrame([], "ticker string, payload string")
    *_, windows = refresh.refresh(asked.withColumn("as_of", F.lit("2026-01-02").cast("timestamp_ntz")), empty, empty, empty)
    assert [r.ticker for r in windows.collect()] == ["AAPL"]


def test_json_safe_keeps_microseconds(spark):
    from pyspark.sql import functions as F, types as T

    from marketloom.plans.context import json_safe

    row = spark.range(1).select(F.lit("2026-01-02 03:04:05.678901").cast("timestamp").alias("a"), F.lit("2026-01-02 03:04:05").cast("timestamp").alias("b"))
    got = row.select(json_safe(F.col("a"), T.TimestampType()).alias("a"), json_safe(F.col("b"), T.TimestampType()).alias("b")).first()
    assert tuple(got) == ("2026-01-02T03:04:05.678901+00:00", "2026-01-02T03:04:05+00:00")


def test_cascade(spark):
    users = spark.createDataFrame([(1,), (2,)], "id long")
    lists = spark.createDataFrame([(10, 1), (20, 2)], "id long, user_id long")
    tickers = spark.createDataFrame([(10, "A"), (20, "B")], "watchlist_id long, ticker string")
    gone = users.filter("id = 1")
    gone_lists = state.cascaded_rows(lists, "user_id", gone, "id")
    assert rows(state.cascade_delete(lists, "user_id", gone, "id"), "id") == [(20,)]
    assert rows(state.cascade_delete(tickers, "watchlist_id", gone_lists, "id"), "ticker") == [("B",)]


def test_bad_notes_create_no_user(spark):
    users = spark.createDataFrame([], "id long, email string, created_at timestamp, updated_at timestamp")
    acts = [(" U@x.y ", "aapl", "  a\n b ", 1), ("v@x.y", "AAPL", " ", 2), ("w@x.y", "AAPL", "n" * 5001, 3), ("bad", "AAPL", "n", 4), ("u@x.y", "A?", "n", 5)]
    df = spark.createDataFrame(acts, "user_email string, ticker string, note_text string, seq int")
    all_users, saved, rejects = actions.save_notes(users, df, ["seq"], as_of())
    assert rows(all_users, "email") == [("u@x.y",)]
    assert rows(saved, "id", "user_id", "ticker", "note_text") == [(1, 1, "AAPL", "a\n b")]
    assert {r.seq: r.reason for r in rejects.collect()} == {
        2: "Research note cannot be blank.", 3: "Research note must be at most 5000 characters.", 4: "invalid email", 5: "invalid ticker",
    }


def test_schema_and_set_differences(spark):
    from marketloom.schemas import TABLES

    names = [t for t in TABLES if t != "users"] + ["other_table"]
    got = [(r.side, r.table_name) for r in quality.table_differences(spark, names).collect()]
    assert got == [("missing", "users"), ("unexpected", "other_table")]


def test_stock_errors(spark):
    df = spark.createDataFrame([("Z", 0, 0, 0, 0), ("K", 1, 3, 2, 2), ("D", 1, 1, 1, 2)],
                               "ticker string, company_count long, price_count long, distinct_news_articles long, news_associations long")
    assert rows(quality.stock_data_errors(df), "ticker", "error") == sorted(
        [("Z", quality.NO_SINGLE_COMPANY), ("Z", quality.NO_PRICES), ("Z", quality.NO_ARTICLES), ("D", quality.DUPLICATE_LINKS)], key=str)


def test_streamed_upserts_read_their_own_batch_and_replay_is_harmless(spark, tmp_path):
    schema = "k string, v int, seq int"
    parts = [[("A", 1, 1), ("B", 1, 1)], [("A", 2, 0)], [("C", 5, 1), ("B", 7, 1), (None, 1, 1), (" ", 1, 2)]]
    src, ckpt = str(tmp_path / "src"), str(tmp_path / "ckpt")
    cur = spark.createDataFrame([("A", 0), ("Z", 9)], "k string, v int")
    table = VersionedTable(spark, str(tmp_path / "t"), cur.schema)
    table.replace(cur)
    seen = []
    for part in parts:  # one file per run, so batch order is the arrival order
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(src)
        ingest.start_upserts(spark.readStream.schema(schema).parquet(src), table, ["k"], ["seq"], ckpt).awaitTermination()
        seen.append((table.version().number, table.version().batches["changes"]))
    ingest.start_upserts(spark.readStream.schema(schema).parquet(src), table, ["k"], ["seq"], ckpt).awaitTermination()
    assert seen == [(2, 0), (3, 1), (4, 2)] and table.version().number == 4
    want = [("A", 2), ("B", 7), ("C", 5), ("Z", 9)]
    assert rows(table.read(), "k", "v") == want
    # a checkpoint behind the table, as after a crash between commit and checkpoint: its batches aren't applied again
    ingest.start_upserts(spark.readStream.schema(schema).parquet(src), table, ["k"], ["seq"], ckpt + "2").awaitTermination()
    assert rows(table.read(), "k", "v") == want and table.version().number == 4


def test_versions(spark, tmp_path):
    df = spark.createDataFrame([("A", 1)], "k string, v int")
    table = VersionedTable(spark, str(tmp_path / "t"), df.schema)
    assert table.version().number == 0 and table.read().count() == 0
    table.replace(df)
    old = table.version()
    # a writer that dies between its data and its commit leaves the old state to be read
    table._write(spark.createDataFrame([("B", 2)], "k string, v int"))
    assert rows(table.read(), "k", "v") == [("A", 1)]
    bound = table.read()
    table.update(lambda now: now.selectExpr("k", "v + 1 AS v"))
    assert rows(table.read(), "k", "v") == [("A", 2)] and rows(bound, "k", "v") == [("A", 1)] == rows(table.read(old), "k", "v")
    with pytest.raises(ConflictError):  # a second writer that began from the old version
        table.replace(df, old)
    assert rows(table.read(), "k", "v") == [("A", 2)] and table.versions() == [1, 2]
    table.append(df, "run 1")
    table.append(df, "run 1")
    table.append(df.limit(0), "run 2")
    assert rows(table.read(), "k", "v") == [("A", 1), ("A", 2)] and table.read_run("run 2").count() == 0
    assert table.version(2).folders != table.version().folders and table.version().number == 4


def test_blank_and_missing_keys_are_refused(spark):
    cur = spark.createDataFrame([("A", 1, 0)], "k string, n int, v int")
    changes = spark.createDataFrame([("A", 1, 5, 1), (None, 1, 6, 1), (" ", 1, 7, 1), ("B", None, 8, 1), ("C", 3, 9, 1)], "k string, n int, v int, s int")
    assert rows(state.upsert(cur, changes, ["k", "n"], ["s"]), "k", "v") == [("A", 5), ("C", 9)]
    assert rows(state.insert_absent(cur, changes.drop("s").withColumn("s", F.lit(1)), ["k", "n"], ["s"]), "k", "v") == [("C", 9)]
    assert sorted(r.reason for r in state.refused(changes, ["k", "n"]).collect()) == ["blank k", "missing k", "missing n"]


def test_lenient_and_strict_tickers(spark):
    df = spark.createDataFrame([(" aapl",), ("bad ticker",), (None,)], "ticker string")
    good, bad = quality.split_tickers(df)
    assert rows(good, "ticker") == [("AAPL",)] and bad.count() == 2
    assert rows(quality.require_tickers(df.limit(1)), "ticker") == [("AAPL",)]
    with pytest.raises(Exception, match="invalid ticker"):
        quality.require_tickers(df).collect()


def test_price_ranges_and_a_hot_ticker(spark):
    """Open, closed, empty and inverted bounds; a ticker with a third of the rows is dealt over its bins."""
    days = spark.range(2000).selectExpr("CAST(id AS INT) i", "date_add(DATE'2020-01-01', CAST(id AS INT)) price_date")
    tickers = spark.range(41).selectExpr("CASE WHEN id < 14 THEN 'HOT' ELSE concat('T', id) END ticker")
    prices = tickers.crossJoin(days.filter("i % 10 = 0 OR true")).select("ticker", "price_date", "i")
    hot = [(n, "HOT", dt.date(2020, 1, 1) + dt.timedelta(days=n), dt.date(2020, 1, 1) + dt.timedelta(days=n + 30)) for n in range(0, 1900, 50)]
    some = [(5001, "T20", None, dt.date(2020, 1, 3)), (5002, "T21", dt.date(2025, 6, 20), None), (5003, "T22", None, None), (5004, "T23", dt.date(2021, 1, 2), dt.date(2021, 1, 1)),
            (5005, "NONE", None, None), (5006, "T24", dt.date(2030, 1, 1), None)]
    bounds = spark.createDataFrame(hot + some, "request_id int, ticker string, start date, end date")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold"), spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    for name, value in zip(("autoBroadcastJoinThreshold", "shuffle.partitions", "adaptive.enabled"), ("-1", "16", "false")):
        spark.conf.set(f"spark.sql.{name}", value)
    try:
        out = reads.price_range(prices, bounds)
        counts = {r.request_id: r["count"] for r in out.groupBy("request_id").count().collect()}
        dealt = sorted(r["count"] for r in prices.withColumn("bin", F.floor(F.unix_date("price_date") / reads.BIN_DAYS)).repartition(16, "ticker", "bin").groupBy(F.spark_partition_id()).count().collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in zip(("autoBroadcastJoinThreshold", "shuffle.partitions", "adaptive.enabled"), before):
            spark.conf.set(f"spark.sql.{name}", value)
    assert counts == {n: 14 * 31 for n, *_ in hot} | {5001: 3, 5002: 3, 5003: 2000}
    assert "hashpartitioning(ticker" in plan and "_bin" in plan
    assert dealt[-1] <= 4 * dealt[len(dealt) // 2]


def test_declared_constraints(spark):
    users = spark.createDataFrame([(1, "a"), (1, "b"), (2, None), (None, "d")], "id long, email string")
    lists = spark.createDataFrame([(1, 1, "x"), (2, 9, "y"), (3, None, "z"), (3, 9, "z")], "id long, user_id long, name string")
    got = {(r.table_name, r.rule_name): r.violations for r in quality.check_tables({"users": users, "watchlists": lists}).collect()}
    assert got == {
        ("users", "primary_key"): 1, ("users", "not_null:id"): 1, ("users", "not_null:email"): 1, ("watchlists", "primary_key"): 1,
        ("watchlists", "not_null:id"): 0, ("watchlists", "not_null:user_id"): 1, ("watchlists", "not_null:name"): 0, ("watchlists", "foreign_key:user_id"): 2,
    }


def test_summaries_count_articles_without_a_table_of_pairs(spark):
    """Repeated links and articles, and keys that are NULL or unknown, count as before; no task groups all (ticker, article) pairs."""
    day = [dt.datetime(2024, 1, n) for n in range(1, 9)]
    links = [("a", "T1"), ("a", "T1"), ("a", "T2"), ("b", "T1"), ("b", None), ("b", None), ("c", "T2"), ("c", "T1"), ("x", "T1"), (None, "T1"), ("d", "T3"), ("x", "T4")]
    rows = [("a", day[1]), ("a", day[5]), ("b", None), ("c", day[2]), ("c", day[2]), ("c", None), ("d", None), (None, day[7]), ("e", day[7])]
    feed = spark.createDataFrame([(a, t, None, None) for a, t in links], "article_id string, ticker string, sentiment string, sentiment_reasoning string")
    articles = spark.createDataFrame([(a, f"title {a}", d) for a, d in rows], "article_id string, title string, published_at timestamp_ntz")
    companies = spark.createDataFrame([(t, "n", "e") for t in ("T1", "T4")], "ticker string, name string, exchange string")
    prices = spark.createDataFrame([("T5", dt.date(2024, 1, 1))], "ticker string, price_date date")
    out = reads.stock_summary(companies, prices, articles, feed)
    got = {r.ticker: (r.news_associations, r.distinct_news_articles, r.newest_published_at) for r in out.collect()}
    want = {"T4": (0, 0, None), "T5": (0, 0, None)}
    for ticker in {t for _, t in links} - {"T4"}:
        met = [(a, d) for a, t in links for b, d in rows if t == ticker and a is not None and a == b]
        want[ticker] = (len(met), len({a for a, _ in met}), max((d for _, d in met if d), default=None))
    assert got == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    keys = [line.split("keys=[")[1].split("]")[0] for line in plan.splitlines() if "Aggregate(keys=[" in line]
    assert keys and not any("ticker" in k and "article_id" in k for k in keys)
