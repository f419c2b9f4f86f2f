import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketloom.operators import embed, reads, search
from marketloom.plans import context, questions, requests as rq

SCHEMA = "article_id string, chunk_index int, chunk_text string, embedding array<float>"


@pytest.fixture(scope="module")
def fixture(spark):
    """300 chunks of 60 articles, a third of them on one ticker, with ties and a zero vector."""
    rng = np.random.default_rng(3)
    vecs = rng.normal(size=(300, 8)).astype("float32")
    vecs[50] = vecs[20]
    vecs[51] = vecs[20] * 2
    vecs[52] = 0
    rows = [(f"a{i // 5}", i % 5, f"t{i}", None if i % 17 == 0 else [float(x) for x in v]) for i, v in enumerate(vecs)]
    tickers = [(f"a{i}", t, "s", None) for i in range(60) for t in (["HOT"] if i % 3 else ["HOT", f"T{i % 7}"])]
    asked = [(i, "HOT" if i % 2 else f"T{i % 7}", "q", [float(x) for x in rng.normal(size=8)]) for i in range(12)] + [(99, "HOT", "q", [float(x) for x in vecs[20]])]
    return (
        spark.createDataFrame(rows, SCHEMA).repartition(5),
        spark.createDataFrame(tickers, "article_id string, ticker string, sentiment string, sentiment_reasoning string"),
        spark.createDataFrame(asked, "request_id long, ticker string, question string, query array<float>"),
        rows, tickers, asked,
    )


def brute(rows, query, k, allowed=None):
    q = np.array(np.float32(query), dtype=float)
    out = []
    for article, index, _, v in rows:
        if v is None or (allowed is not None and article not in allowed):
            continue
        v = np.array(np.float32(v), dtype=float)
        n = np.linalg.norm(v) * np.linalg.norm(q)
        out.append((round(1 - v @ q / n, 12) if n else np.inf, article, index))
    return [(a, i) for _, a, i in sorted(out)[:k]]


def got(hits):
    out = {}
    for r in hits.orderBy("request_id", "rank").collect():
        out.setdefault(r.request_id, []).append((r.article_id, r.chunk_index))
    return out


def test_batch_equals_brute_force(fixture):
    chunks, _, asked, rows, _, questions = fixture
    want = {rid: brute(rows, q, 7) for rid, _, _, q in questions}
    assert got(search.search_batch(asked, chunks, 7)) == want


def test_small_slices_give_the_same(fixture, monkeypatch):
    chunks, links, asked, rows, _, questions = fixture
    whole = got(search.search_batch_by_ticker(asked, chunks, links, 7))
    monkeypatch.setattr(search, "SLICE", 7)
    monkeypatch.setattr(search, "RUN", 3)
    monkeypatch.setattr(search, "CELLS", 9)
    assert got(search.search_batch(asked, chunks, 7)) == {rid: brute(rows, q, 7) for rid, _, _, q in questions}
    assert got(search.search_batch_by_ticker(asked, chunks, links, 7)) == whole


def test_cells_are_skipped_where_vectors_cluster(spark):
    """Most cells' bounds lie beyond the k-th distance, a third of all rows lies in one cell, and results stay exact."""
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(20, 16))
    member = np.where(rng.random(1500) < 0.33, 0, rng.integers(0, 20, 1500))
    vecs = (centres[member] + 0.05 * rng.normal(size=(1500, 16))).astype("float32")
    vecs[7] = 0
    rows = [(f"a{i // 5}", i % 5, "t", [float(x) for x in v]) for i, v in enumerate(vecs)]
    asked = [(i, [float(x) for x in np.float32(centres[i] + 0.05 * rng.normal(size=16))]) for i in range(20)] + [(77, [0.0] * 16)]
    chunks = spark.createDataFrame(rows, SCHEMA).repartition(4)
    vectors = chunks.select("article_id", "chunk_index", "embedding").withColumn("scopes", F.array(F.lit("*")))
    questions = spark.createDataFrame(asked, "request_id long, query array<float>").withColumn("scope", F.lit("*"))
    found = search.BoundedSearch(questions, vectors, 5, cells=20)
    assert got(found.hits) == {rid: brute(rows, q, 5) for rid, q in asked}
    visited = {r.request_id: r.n for r in found.visits.groupBy("request_id").agg(F.count("*").alias("n")).collect()}
    cells = found.cells.count()
    assert sum(n for rid, n in visited.items() if rid != 77) < 0.2 * 20 * cells
    assert visited[77] == cells - search.FIRST  # a question without a direction sees everything


def test_empty_sides(spark, fixture):
    chunks, links, asked, *_ = fixture
    assert search.search_batch(asked.limit(0), chunks, 3).count() == 0
    assert search.search_batch(asked, chunks.limit(0), 3).count() == 0


def test_by_ticker_equals_brute_force(fixture):
    chunks, links, asked, rows, tickers, questions = fixture
    want = {}
    for rid, ticker, _, q in questions:
        found = brute(rows, q, 20, {a for a, t, _, _ in tickers if t == ticker})
        if found:
            want[rid] = found
    assert got(search.search_batch_by_ticker(asked, chunks, links, 50)) == want  # top_k is clamped to 20


def test_single_search(fixture):
    chunks, links, _, rows, tickers, questions = fixture
    rid, ticker, _, q = questions[1]
    vector = F.lit(q)
    hits = [(r.article_id, r.chunk_index) for r in search.search(chunks, vector, 5).collect()]
    assert hits == brute(rows, q, 5)
    hits = search.search(chunks, vector, 5, links, "T3")
    assert [(r.article_id, r.chunk_index) for r in hits.collect()] == brute(rows, q, 5, {a for a, t, _, _ in tickers if t == "T3"})
    assert "TakeOrderedAndProject" in hits._jdf.queryExecution().executedPlan().toString()
    for bad in (0, True, "3"):
        with pytest.raises(ValueError):
            search.clamp_top_k(bad)


def test_stored_index(spark, tmp_path):
    """Few questions read few folders and find what exact search finds, where vectors cluster."""
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(16, 12))
    vecs = (centres[rng.integers(0, 16, 1200)] + 0.1 * rng.normal(size=(1200, 12))).astype("float32")
    rows = [(f"a{i}", 0, "t", [float(x) for x in v]) for i, v in enumerate(vecs)] + [("zero", 0, "t", [0.0] * 12), ("none", 0, "t", None)]
    asked = [(i, [float(x) for x in np.float32(centres[i] + 0.1 * rng.normal(size=12))]) for i in range(2)]
    path = str(tmp_path / "index")
    search.write_index(spark.createDataFrame(rows, SCHEMA), path, cells=16)
    requests = spark.createDataFrame(asked, "request_id long, query array<float>")
    hits = search.search_index(requests, path, 8, probes=3)
    found = got(hits)
    want = {rid: set(brute(rows, q, 8)) for rid, q in asked}
    assert np.mean([len(set(found[k]) & v) / 8 for k, v in want.items()]) >= 0.9
    assert "dynamicpruning" in hits._jdf.queryExecution().executedPlan().toString().lower()
    every = got(search.search_index(requests, path, 8, probes=16))
    assert {k: set(v) for k, v in every.items()} == want  # every cell probed: exact


def test_diversify(spark):
    rows = [(1, "a", 0, 1, None), (1, "a", 1, 2, "X"), (1, "a", 2, 3, None), (1, "b", 0, 4, ""), (1, " ", 0, 5, None), (1, "c", 0, 6, None), (1, "d", 0, 7, None)]
    df = spark.createDataFrame(rows, "request_id int, article_id string, chunk_index int, rank int, ticker string")
    out = search.diversify(df, 4, F.lit("T")).orderBy("position").collect()
    assert [(r.article_id, r.chunk_index, r.ticker) for r in out] == [("a", 0, "T"), ("a", 1, "X"), ("b", 0, "T"), ("c", 0, "T")]
    assert search.candidate_limit(8) == 16 and search.candidate_limit(15) == 20


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_context_and_json(spark, fixture, threshold):
    # with and without copying of small sides
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        check_context_and_json(spark, fixture)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def check_context_and_json(spark, fixture):
    chunks, links, _, _, _, questions = fixture
    asked = spark.createDataFrame(
        [(1, " hot ", " a  b ", questions[0][3]), (2, "NONE", "q", questions[1][3]), (3, "HOT", " ", questions[1][3]), (4, "b@d", "q", questions[1][3])],
        "request_id long, ticker string, question string, query array<float>",
    )
    companies = spark.sql("SELECT 'HOT' ticker, 'Hot Inc' name, CAST(12.5 AS DECIMAL(24,4)) market_cap, 'I' industry, 'N' exchange, CAST(NULL AS STRING) description")
    prices = spark.range(40).selectExpr("'HOT' ticker", "date_add(DATE'2024-01-01', CAST(id AS INT)) price_date", "CAST(id AS DECIMAL(20,6)) close", "CAST(1 AS DECIMAL(24,4)) volume", *[f"CAST(NULL AS DECIMAL(20,6)) {c}" for c in ("open", "high", "low", "vwap")])
    articles = spark.range(60).selectExpr("concat('a', id) article_id", "concat('T', id) title", "'p' publisher", "CAST(NULL AS STRING) article_url", "timestamp_seconds(id) published_at")
    out = context.research_context(asked, companies, prices, articles, links, chunks).orderBy("request_id")
    a, b = out.collect()
    assert (a.ticker, a.question, a.company.name, b.company) == ("HOT", "a b", "Hot Inc", None)
    assert [len(a.prices), len(a.recent_news), len(a.semantic_evidence)] == [30, 5, 8] and b.prices == [] and b.semantic_evidence == []
    assert [int(p.close) for p in a.prices] == list(range(10, 40)) and [n.article_id for n in a.recent_news] == ["a59", "a58", "a57", "a56", "a55"]
    articles_used = [e.article_id for e in a.semantic_evidence]
    assert max(articles_used.count(x) for x in articles_used) <= 2
    assert [tuple(r)[2:] for r in context.context_counts(out).orderBy("request_id").collect()] == [(1, 30, 5, 8), (0, 0, 0, 0)]
    body = json.loads(context.context_json(out).orderBy("request_id").first().json)
    assert body["company"]["market_cap"] == "12.5000" and body["company"]["description"] is None
    assert body["prices"][0] == {"ticker": "HOT", "price_date": "2024-01-11", "open": None, "high": None, "low": None, "close": "10.000000", "volume": "1.0000", "vwap": None}
    assert body["recent_news"][0]["published_at"] == "1970-01-01T00:00:59+00:00"


def test_strip_vectors_at_any_depth(spark):
    df = spark.sql("SELECT 1 id, array(1.0) Embedding, named_struct('a', 1, 'VECTOR', array(1.0), 'n', array(named_struct('query_embedding', 1, 'b', 2))) s")
    assert [f.simpleString() for f in context.strip_vectors(df).schema] == ["id:int", "s:struct<a:int,n:array<struct<b:int>>>"]


def test_request_validation(spark):
    rows = [(1, "price_history", "aapl", None, 90), (2, "price_history", "aapl", None, 91), (3, "news_search", "aapl", "q", 11), (4, "semantic_search", "aapl", " q  x ", 100),
            (5, "semantic_search", "aapl", " ", 1), (6, "recent_news", "aapl", None, 0), (7, "agent", "aapl", "y" * 5001, None), (8, "agent", "a?", "y", None), (9, "agent", "a", "y", None)]
    df = spark.createDataFrame(rows, "request_id int, tool string, ticker string, question string, limit int")
    got_rows = {r.request_id: (r["limit"], r.error_message) for r in rq.validate_requests(df).collect()}
    assert got_rows == {1: (90, None), 2: (None, "limit out of bounds"), 3: (None, "limit out of bounds"), 4: (20, None), 5: (1, "blank question"),
                        6: (None, "limit out of bounds"), 7: (None, "question too long"), 8: (None, "invalid ticker"), 9: (None, None)}


def test_text_questions_find_their_own_chunk(spark):
    rows = [(f"a{i}", 0, f"alpha{i} beta{i} gamma") for i in range(30)]
    texts = spark.createDataFrame(rows, "article_id string, chunk_index int, chunk_text string")
    chunks = texts.join(embed.embed(texts, "chunk_text", ["article_id", "chunk_index"]), ["article_id", "chunk_index"])
    links = spark.createDataFrame([(f"a{i}", "X" if i < 9 else "Y", None, None) for i in range(30)],
                                  "article_id string, ticker string, sentiment string, sentiment_reasoning string")
    asked = spark.createDataFrame([(1, "x", " alpha3  beta3 "), (2, "y", "beta3 alpha12"), (3, "bad ticker", "q"), (4, "x", " ")],
                                  "request_id long, ticker string, question string")
    every = questions.semantic_news_search(asked.filter("request_id = 1"), chunks, 1).first()
    assert (every.article_id, every.rank) == ("a3", 1)
    bound = {r.request_id: r.article_id for r in questions.semantic_news_search(asked, chunks, 1, links).collect()}
    assert bound == {1: "a3", 2: "a12"}


def test_hits_are_described_with_all_related_tickers(spark, fixture):
    chunks, links, _, rows, tickers, questions_ = fixture
    articles = spark.range(60).selectExpr("concat('a', id) article_id", "concat('T', id) title", "'p' publisher", "'u' article_url", "timestamp_seconds(id) published_at")
    hits = search.search(chunks, F.lit(questions_[0][3]), 4)
    out = {(r.article_id, r.chunk_index): r for r in search.describe_hits(hits, chunks, articles, links).collect()}
    assert set(out) == set(brute(rows, questions_[0][3], 4))
    for (article, _), r in out.items():
        assert r.tickers == sorted(t for a, t, _, _ in tickers if a == article) and abs(r.similarity - (1 - r.distance)) < 1e-12
        assert (r.ticker, r.sentiment, r.title) == (None, None, "T" + article[1:])


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_slice_is_scored_for_few_questions_at_a_time(fixture, tmp_path, monkeypatch):
    """Many questions and large cells are streamed: no group of rows and questions arrives in a worker as a whole."""
    chunks, links, asked, rows, _, questions = fixture
    many = asked.crossJoin(asked.sparkSession.range(6)).select((F.col("request_id") + 100 * F.col("id")).alias("request_id"), "ticker", "query")
    want = {rid + 100 * i: brute(rows, q, 4) for rid, _, _, q in questions for i in range(6)}
    monkeypatch.setattr(search, "ASKED", 7)
    hits = search.search_batch(many, chunks, 4)
    assert got(hits) == want
    assert "CoGroup" not in _plan(hits) and "CoGroup" not in _plan(search.search_batch_by_ticker(many, chunks, links, 4))
    path = str(tmp_path / "index")
    search.write_index(chunks, path, cells=3)
    monkeypatch.setattr(search, "SLICE", 11)
    hits = search.search_index(many.select("request_id", "query"), path, 4, probes=3)
    assert "CoGroup" not in _plan(hits)
    sound = [r for r in rows if r[3] is not None and any(r[3])]  # vectors without a length are in no cell that is probed
    assert got(hits) == {rid + 100 * i: brute(sound, q, 4) for rid, _, _, q in questions for i in range(6)}


def test_models_see_few_texts_at_a_time(spark):
    class Counting(embed.HashingModel):
        def encode(self, sentences, **options):
            assert len(sentences) <= 256
            return super().encode(sentences, **options)

    texts = spark.range(0, 1500, 1, 1).select("id", F.when(F.col("id") % 7 == 0, " ").otherwise(F.concat(F.lit("word "), F.col("id").cast("string"))).alias("t"))
    made = {r.id: r.embedding for r in embed.embed(texts, "t", ["id"], Counting).collect()}
    assert sorted(made) == [i for i in range(1500) if i % 7]
    for i in (1, 255, 256, 257, 1499):
        assert made[i] == [float(x) for x in np.float32(embed.HashingModel().encode([f"word {i}"])[0])]
