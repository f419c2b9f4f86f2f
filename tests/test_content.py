import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketloom.functions import vectors
from marketloom.sources.versions import VersionedTable
from marketloom.operators import content, embed


def chunks_of(spark, body, size=1200, overlap=200):
    df = spark.createDataFrame([("a", body)], "article_id string, body string")
    return [r.chunk_text for r in content.chunk_articles(df, "body", size, overlap).orderBy("chunk_index").collect()]


@pytest.mark.parametrize(
    ("body", "size", "overlap", "want"),
    [
        ("alpha beta gamma delta epsilon", 12, 4, ["alpha beta", "beta gamma", "amma delta", "elta epsilon"]),
        ("abcdefghijklmnopqrstuvwxyz", 10, 3, ["abcdefghij", "hijklmnopq", "opqrstuvwx", "vwxyz"]),
        ("aa bb cc dd ee ff gg hh", 8, 0, ["aa bb cc", "dd ee", "ff gg", "hh"]),
        ("  short \n text ", 1200, 200, ["short text"]),
        (" \t ", 10, 2, []),
        (None, 10, 2, []),
        ("😀" * 25, 10, 0, ["😀" * 10, "😀" * 10, "😀" * 5]),
    ],
)
def test_worked_chunks(spark, body, size, overlap, want):
    assert chunks_of(spark, body, size, overlap) == want


def test_words_keep_whole_and_overlap(spark):
    words = " ".join(f"word{i:03d}" for i in range(80))
    got = chunks_of(spark, words, 100, 24)
    assert len(got) == 9 and got[0].endswith("word011") and got[1].startswith("word009")
    assert all(w.startswith("word") and len(w) == 7 for c in got for w in c.split())
    assert list(dict.fromkeys(w for c in got for w in c.split())) == words.split()


def test_spans_cover_any_text():
    rng = np.random.default_rng(1)
    for _ in range(200):
        body = " ".join("x" * int(n) for n in rng.integers(1, 30, rng.integers(1, 60)))
        size = int(rng.integers(1, 60))
        overlap = int(rng.integers(0, size))
        spans = content.chunk_spans(body, size, overlap)
        covered = np.zeros(len(body), dtype=bool)
        for a, b in spans:
            assert 0 <= a < b <= len(body) and b - a <= size
            covered[a:b] = True
        assert all(covered[i] or body[i] == " " for i in range(len(body)))
        assert [a for a, _ in spans] == sorted({a for a, _ in spans})


@pytest.mark.parametrize(("size", "overlap"), [(0, 0), (10, -1), (10, 10), (10, 11), (True, 0), (10.0, 1)])
def test_bad_chunk_settings(size, overlap):
    with pytest.raises(ValueError):
        content.check_chunk_settings(size, overlap)


def html(body):
    return f"<html><body><nav>Menu</nav><article><h1>T</h1><script>x</script><!-- c --><p>{body}</p><table><tr><td>t</td></tr></table></article></body></html>"


def test_extraction_and_supplied_extractor(spark):
    pages = spark.createDataFrame([(1, "https://x/1", html("word " * 60 + "&amp; end")), (2, "https://x/2", html("tiny")), (3, None, None)], "page_id int, url string, html string")
    got = {r.page_id: r.body for r in content.extract_articles(pages).collect()}
    assert got == {1: "T " + "word " * 60 + "& end", 2: None, 3: None}

    def extractor(page, **kwargs):
        if "tiny" in page:
            raise RuntimeError("broken page")
        return f" {kwargs['url']}  {kwargs['include_tables']} " + "y" * 200

    made = {r.page_id: r.body for r in content.extract_articles(pages, extractor=extractor).collect()}
    assert made == {1: "https://x/1 False " + "y" * 200, 2: None, 3: None}
    with pytest.raises(ValueError):
        content.extract_articles(pages, minimum_characters=0)


BODY = " ".join(f"word{i}" for i in range(100))


@pytest.mark.parametrize(
    ("page", "want"),
    [
        (f"<html><body><header>Site</header><div>{BODY}</div><footer>f</footer></body></html>", BODY),
        (f"<div>{BODY}</div>", BODY),
        (f"<body>x<main><p>{BODY}</p><aside>a</aside></main></body>", BODY),
        (f"<article>{BODY}</article><p>between</p><ARTICLE class='b'>second</ARTICLE>", BODY + " second"),
        (f"<article>{BODY} &lt;b&gt; &#39;q&#x27;&nbsp;&eacute;</article>", BODY + " <b> 'q' é"),
        (f"<article>{BODY}<div id='x' class='box ad wide'>buy</div><div class='made'>kept</div></article>", BODY + " kept"),
        (f"<script>'<article>no</article>'</script><!-- <article>no</article> --><article>{BODY}", BODY),
    ],
)
def test_main_text_of_literal_pages(spark, page, want):
    df = spark.createDataFrame([(page,)], "html string")
    assert df.select(content.main_text(F.col("html")).alias("t")).first().t == want


ARTICLES = [
    ("a", "Title", "Desc", "https://x/a", "2024-01-02"), ("b", "Title", None, "ftp://x/b", "2024-01-03"),
    ("c", None, " ", "\t", "2024-01-04"), ("d", None, None, None, "2024-01-05"), ("e", "E", None, "https://x/e", None),
]


def articles(spark):
    return spark.createDataFrame(ARTICLES, "article_id string, title string, description string, article_url string, published_at string")


def test_content_job_is_incremental(spark):
    bodies = spark.createDataFrame([("a", "body " * 50), ("b", "body " * 50)], "article_id string, body string")
    none = spark.createDataFrame([], content.CHUNK_SCHEMA)
    eligible = content.eligible_articles(articles(spark), none)
    assert sorted(r.article_id for r in eligible.collect()) == ["a", "b", "c", "e"]  # a tab-only URL is not blank here
    resolved = {r.article_id: (r.extraction_source, r.extracted_text[:9]) for r in content.resolve_content(eligible, bodies).collect()}
    assert resolved == {"a": ("article_body", "body body"), "b": ("metadata_fallback", "Title: Ti"), "e": ("metadata_fallback", "Title: E")}
    first = content.content_job(articles(spark), bodies, none)
    assert first.count() == 3
    assert content.content_job(articles(spark), bodies, first).count() == 0
    assert [r.article_id for r in content.newest_work(eligible, 2).collect()] == ["c", "b"]


def test_content_run_is_written_once_and_extracts_once(spark, tmp_path):
    """The pages are extracted once in a run; the same run again, and a later one, write nothing."""
    seen = spark.sparkContext.accumulator(0)

    def extractor(html, **_):
        seen.add(1)
        return html

    pages = spark.createDataFrame([("a", "u", "body " * 50), ("b", "u", "body " * 50)], "article_id string, url string, html string")
    bodies = content.extract_articles(pages, extractor=extractor)
    table = VersionedTable(spark, str(tmp_path / "chunks"), content.RUN_SCHEMA)
    assert tuple(content.run_content_job(articles(spark), bodies, table, "day 1").first()) == (4, 1, 2, 1, 3, 3)
    assert seen.value == 2 and table.read().count() == 3 and table.version().number == 1
    assert tuple(content.run_content_job(articles(spark), bodies, table, "day 1").first()) == (4, 1, 2, 1, 3, 3)
    assert seen.value == 2 and table.version().number == 1
    assert tuple(content.run_content_job(articles(spark), bodies, table, "day 2").first()) == (1, 0, 0, 1, 0, 0)
    assert table.read().count() == 3 and table.read_run("day 2").count() == 0


def test_embed_run_embeds_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    class Counting:
        def encode(self, sentences, *, convert_to_numpy, normalize_embeddings):
            seen.add(len(sentences))
            return np.ones((len(sentences), 3))

    rows = [("a", 0, "x", None), ("a", 1, "y", None), ("b", 0, " ", None), ("c", 0, "z", [1.0, 1.0, 1.0])]
    chunks = spark.createDataFrame(rows, "article_id string, chunk_index int, chunk_text string, embedding array<float>")
    store = VersionedTable(spark, str(tmp_path / "vectors"), embed.STORE_SCHEMA)
    assert tuple(embed.run_embed_job(chunks, store, "1", Counting, 3, "m").first()) == (3, 2, 2)
    assert tuple(embed.run_embed_job(chunks, store, "1", Counting, 3, "m").first()) == (3, 2, 2)
    assert seen.value == 2 and {r.embedding_model for r in store.read().collect()} == {"m"}


def test_models_are_injected_and_checked(spark):
    class Fake:  # local, so that it travels with the job
        def encode(self, sentences, *, convert_to_numpy, normalize_embeddings):
            return np.array([[len(s), 0.0, 0.0] for s in sentences])

    df = spark.createDataFrame([(1, " ab  c "), (2, " "), (3, None)], "i int, t string")
    got = embed.embed(df, "t", ["i"], Fake, 3).collect()
    assert [(r.i, list(r.embedding)) for r in got] == [(1, [4.0, 0.0, 0.0])]
    with pytest.raises(Exception, match="unusable vector"):
        embed.embed(df, "t", ["i"], Fake, 4).collect()


def test_hash_model(spark):
    df = spark.createDataFrame([(i, f"Word{i} word{i} other") for i in range(40)] + [(40, "word3 WORD3 Other")], "i int, t string")
    made = embed.embed(df, "t", ["i"], partitions=4)
    assert made.filter(~vectors.is_valid_vector(F.col("embedding"))).count() == 0
    by_id = {r.i: np.array(r.embedding) for r in made.collect()}
    assert np.allclose(by_id[3], by_id[40]) and abs(np.linalg.norm(by_id[5]) - 1) < 1e-6


def test_chunks_leave_a_worker_before_a_batch_is_over(spark, monkeypatch):
    texts = [(f"a{i}", " ".join(f"w{i}x{j}" for j in range(300 * (i % 4))), i) for i in range(40)]
    df = spark.createDataFrame(texts, "article_id string, t string, n long").coalesce(1)
    monkeypatch.setattr(content, "HELD_CHARACTERS", 2000)
    want = {(a, n, i, t[x:y].strip()) for a, t, n in texts for i, (x, y) in enumerate(content.chunk_spans(t, 500, 100))}
    out = content.chunk_articles(df, "t", 500, 100, carry=("n",))
    assert {(r.article_id, r.n, r.chunk_index, r.chunk_text) for r in out.collect()} == want
    frames = list(content._split(df.withColumnRenamed("t", "_text").toPandas(), 500, 100, ("n",)))
    assert len(frames) > 25 and set(pd.concat(frames)[["article_id", "n", "chunk_index", "chunk_text"]].itertuples(index=False, name=None)) == want
