"""Corpus operators against plain versions, on small tables with nulls, empties, ties and repeated rows."""

import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import brute  # noqa: E402

SF = "/root/testdata/sf0.001"
WORDS = [f"w{i}" for i in range(200)]
LONG = " ".join(WORDS)
TEXTS = [
    (1, None), (2, ""), (3, "  \n "), (4, "one two"), (5, "One\ttwo"), (6, LONG), (7, LONG), (8, LONG.replace("w50 ", "x ")),
    (9, LONG * 3), (10, "a" * 400), (11, "a" * 120), (12, "ünï " * 60), (13, "zz ünï " * 60), (14, " ".join(WORDS[::-1])),
    (15, " ".join(WORDS[20:180])), (16, " ".join(WORDS[40:160])),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = spark.createDataFrame(TEXTS, "doc_id bigint, text string")
    # columns that clash with names the operators use
    return rows.withColumns({c: F.lit("x") for c in ("n_shingles", "score", "hash", "key", "codes", "lang", "source")})


def test_minhash(docs):
    from marketloom.llm.minhash import near_duplicates

    want = brute.near_duplicates(dict(TEXTS))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs).collect()}
    assert got == want
    twice = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs.unionAll(docs)).collect()}
    assert twice == want
    assert near_duplicates(docs.limit(0)).count() == 0


def test_minhash_group_around_the_bound(spark):
    """Members of one bucket that are similar to each other, to the centre, to both or to none."""
    import random

    from marketloom.llm.minhash import near_duplicates

    rng = random.Random(3)
    base = [f"b{i}" for i in range(120)]
    rows = []
    for i in range(90):
        words = list(base)
        for block in rng.sample(range(6), 2):  # changes that several members share
            at = rng.randrange(110)
            words[at] = f"s{block}"
        if i % 3 == 0:
            words[rng.randrange(120)] = f"own{i}"
        rows.append((i + 1, " ".join(words[: 120 - rng.randrange(20)])))
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    # many one-row bands, so that every pair meets and only the comparison decides
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, percent=90, bands=64, rows=1).collect()}
    assert got == brute.near_duplicates(dict(rows), percent=90)
    assert len({c for _, c in got.values()}) > 3


def test_suffix(docs):
    from marketloom.llm.suffix import remove_repeats

    got = {r.doc_id: (r.n_bytes, r.n_removed, len(r.spans), bytes(r.kept)) for r in remove_repeats(docs).collect()}
    assert got == brute.remove_repeats(dict(TEXTS))
    assert remove_repeats(docs.limit(0)).count() == 0


def _shuffle_files(spark):
    from pathlib import Path

    dirs = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().localDirsString()
    return {f: f.stat().st_size for d in dirs for f in Path(d).glob("*/shuffle_*.data")}


def test_staged_leaves_no_shuffle_files(spark):
    """Nor does it change the caller's setting, also where the write fails."""
    from marketloom.llm.common import SHUFFLE_CLEANUP, staged

    counted = spark.range(20_000).groupBy((F.col("id") % 5_000).alias("k")).agg(F.count("*").alias("n")).repartition(3, "n")
    failing = spark.range(10).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    try:
        for value in (None, "false", "true"):
            spark.conf.unset(SHUFFLE_CLEANUP) if value is None else spark.conf.set(SHUFFLE_CLEANUP, value)
            before = set(_shuffle_files(spark))
            kept = staged(counted, "counted")
            assert not set(_shuffle_files(spark)) - before
            assert [tuple(r) for r in kept.agg(F.count("*"), F.sum("k"), F.max("n")).collect()] == [(5_000, 12_497_500, 4)]
            with pytest.raises(Exception, match="no"):
                staged(failing, "failing")
            assert spark.conf.get(SHUFFLE_CLEANUP, None) == value
    finally:
        spark.conf.unset(SHUFFLE_CLEANUP)


def test_suffix_drops_the_shuffled_samples(spark):
    """The shuffle of the sampled suffixes is gone before the documents are shuffled."""
    import random

    from marketloom.llm.suffix import remove_repeats

    rng = random.Random(5)
    texts = {i: "".join(rng.choices("abcdefghij klmnop", k=20_000)) for i in range(40)}
    texts[39] = texts[3][5_000:9_000] + texts[39]
    docs = spark.createDataFrame(list(texts.items()), "doc_id bigint, text string")
    before = _shuffle_files(spark)
    done = remove_repeats(docs)
    assert sum(n for f, n in _shuffle_files(spark).items() if f not in before) < 100_000  # some 50,000 samples of 16 bytes
    assert {r.doc_id: r.n_removed for r in done.collect()} == {i: 4_000 * (i == 39) for i in texts}


@pytest.mark.parametrize("limit", [200, 1000, 10**9])
def test_sharding(docs, limit):
    from marketloom.llm.sharding import shards

    rows = shards(docs, limit=limit).collect()
    assert sorted(r.doc_id for r in rows) == [i for i, _ in TEXTS]
    groups = {}
    for r in rows:
        groups.setdefault(r.shard, []).append(r)
        assert len(r.shard) == r.depth
    for own in groups.values():
        total = sum(r.n_bytes for r in own)
        assert all(r.shard_bytes == total and r.shard_rows == len(own) for r in own)
        assert total <= limit or len(own) == 1
    names = set(groups)
    assert not any(a != b and b.startswith(a) for a in names for b in names)


def test_bpe_and_packing(docs):
    import tiktoken
    from tokenizers import Tokenizer

    import public_tokenizers as P
    from marketloom.llm import bpe, packing

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = bpe.encoder(path, P.PATTERN).ranks
    plain = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in bpe.decode(bpe.encode(docs, path, P.PATTERN), path).collect():
        text = dict(TEXTS)[r.doc_id] or ""
        assert r.ids == plain.encode_ordinary(text) and bytes(r.bytes) == text.encode()

    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, bins = {}, {}
    for r in packing.pack(docs, P.path("byte_bpe_50k.json"), length=64, segments=3).collect():
        pieces.setdefault(r.doc_id, []).append((r.start, r.length))
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for i, text in TEXTS:
        at = 0
        for start, length in sorted(pieces[i]):
            assert start == at and length > 0
            at += length
        assert at == len(tool.encode(text or "", add_special_tokens=False).ids) + 1
    for own in bins.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 64 and (at & (at - 1)) == 0 and len(own) <= 3


def test_html(spark):
    import pyarrow.parquet as pq

    from marketloom.llm.html import extract, main_text, trained

    for r in pq.read_table(f"{SF}/pages.parquet").to_pylist():
        assert extract(r["html"], trained()) == brute.article(r["html"])
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "<"), (4, "<script>x"), (5, "</p></p>")], "page_id bigint, html string")
    assert {r.page_id: r.main_text for r in main_text(odd).collect()} == {1: "", 2: "", 3: "<", 4: "", 5: ""}  # a lone "<" is text


def check_pieces(rows, texts, length, segments, loss=None):
    """Ids, checksums, gapless offsets, padding only to a power of two, and the limits. texts: (doc_id, text, scored tokens)."""
    import struct
    import zlib

    from tokenizers import Tokenizer

    import public_tokenizers as P

    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, bins = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        bins.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == {i for i, *_ in texts}
    for i, text, scored in texts:
        ids, at = tool.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            own = ids[r.start : r.start + r.length]
            first = len(ids) - (len(ids) if scored is None else min(scored, len(ids)))
            assert (r.start, r.doc_tokens, len(own)) == (at, len(ids), r.length)
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            assert r.loss_tokens == max(0, at + r.length - max(at, first))
            at += r.length
        assert at == len(ids)
    for own in bins.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length and len(own) <= segments and (loss is None or sum(r.loss_tokens for r in own) <= loss)
    return [sum(r.length for r in own) for own in bins.values()], [sum(r.loss_tokens for r in own) for own in bins.values()]


def test_packing_with_special_tokens_and_repeated_rows(spark):
    import random

    import public_tokenizers as P
    from marketloom.llm import packing

    rng = random.Random(2)
    parts = ["a", " ", "\n\n", "\u2003", "<|endoftext|>", "don't", " the", "\t", "\u5b57", "  ", "1904", "\u00a0", "\x1c"]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randint(0, 40))), None) for i in range(1500)]
    texts += [(5000, "a\n\n<|endoftext|>b", None), (5001, "a \u2003<|endoftext|>", None), (5002, None, None), (5003, "word " * 250_000, None)]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("start", "scored", "length")})
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), length=256, segments=20).collect()
    totals, _ = check_pieces(rows, texts, 256, 20)
    assert sum(1 for t in totals if t & (t - 1)) < 0.05 * len(totals)
    again = packing.pack(docs.filter("doc_id < 3").unionAll(docs.filter("doc_id < 3")), P.path("byte_bpe_50k.json")).collect()
    assert len({(r.sequence_id, r.offset) for r in again}) == len(again) and {r.doc_id for r in again} == {0, 1, 2}
    assert packing.pack(docs.limit(0), P.path("byte_bpe_50k.json")).count() == 0


def test_packing_where_the_loss_limit_binds_first(spark):
    """Long prompts without loss and answers with it: bins close on loss-bearing tokens, before tokens or segments are full."""
    import public_tokenizers as P
    from marketloom.llm import packing

    texts = [(i, " word" * (20 + i % 13), 18 + i % 5) for i in range(300)] + [(900, " word" * 900, 0), (901, " word" * 900, 5000), (902, " word", None)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string, answer int").coalesce(1)
    rows = packing.pack(docs, P.path("byte_bpe_50k.json"), length=512, segments=64, loss=128, loss_col="answer").collect()
    totals, losses = check_pieces(rows, texts, 512, 64, 128)
    # bins closed by loss aren't full, and so come as sequences of power-of-two lengths
    assert sum(x >= 120 for x in losses) > 0.5 * len(losses) and sum(t < 500 for t in totals) > 0.7 * len(totals)


TEXT = "The harvest came in early that autumn, and the barns were full before the first frost reached the valley."
UNSEEN = [  # (page, its main text); none of these texts or pages is among those the model learned from
    ("<article><p>%s</p><aside><h3>Related</h3><ul><li><a href=x>Other</a></li></ul></aside></article>"% TEXT, TEXT),
    ("<article><p>%s</p></article><aside><p>%s %s</p></aside>"% (TEXT, TEXT, TEXT), TEXT),
    ("<article><p>%s</p><nav><a>Page 1</a></nav></article>"% TEXT, TEXT),
    ("<article><p>%s</p><footer>Posted by X in Y</footer></article>"% TEXT, TEXT),
    ("<article><p>%s</p><div class='alert alert-info'>Note: old text.</div></article>"% TEXT, TEXT),
    ("<body>%s<br>%s</body>"% (TEXT, TEXT),TEXT + " "+ TEXT),
    (TEXT, TEXT),
    ("<html><head><title>x</title></head><body><nav><a href=/>Home</a></nav><div class='container'><h1>Barns</h1><p>%s</p><p>Yes.</p></div><footer><p>Copyright Me. All rights reserved.</p></footer></body></html>"% TEXT,"Barns\n\n"+TEXT + "\n\nYes."),
    ("<body><header><a href=/>Logo</a><nav><ul><li><a>A</a><li><a>B</a></ul></nav></header><main><h1>T</h1><p>%s</p><section class='comments'><p>%s</p></section></main></body>"% (TEXT, TEXT),"T\n\n"+ TEXT),
    ("<div id=page><div id=main-content><h2>Title</h2>%s<p>%s</p></div><div class='sidebar'><p>%s</p></div></div>"% (TEXT, TEXT, TEXT),"Title\n\n"+TEXT + "\n\n"+ TEXT),
    ("<article><h1>A</h1><p>%s</p><div class='comments'><h3>Comments</h3><p>Great %s</p></div></article>"% (TEXT, TEXT),"A\n\n"+ TEXT),
    ("<article><h1>A</h1><div class='ad'><p>%s</p></div><p>%s</p><form><p>Sign up: %s</p></form></article>"% (TEXT, TEXT, TEXT),"A\n\n"+ TEXT),
    ("<div class='notice'>%s</div><article><p>Short.</p></article>"% TEXT,"Short."),
    ("<main><p>%s</p><ul><li>one</li><li>two</li></ul></main><div class='related'><a href=a>%s</a></div>"% (TEXT, TEXT),TEXT + "\n\none\n\ntwo"),
    ("<nav>Menu</nav><footer>Foot</footer>",""),
    ("<article><header><h1>Head</h1></header><p>%s</p></article><div id='cookie-consent'>We use cookies. %s</div>"% (TEXT, TEXT),"Head\n\n"+ TEXT),
    ("<body><article><p>%s</p><aside>%s</aside><p>End of it.</p></article></body>"% (TEXT, TEXT),TEXT + "\n\nEnd of it."),
]


@pytest.mark.parametrize("page, want", UNSEEN)
def test_html_on_other_templates(page, want):
    from marketloom.llm.html import extract, trained

    assert extract(page, trained()) == want


def test_html_tables(spark):
    from marketloom.llm.html import main_text

    long = "<article>" + "<p>One more line of the long story.</p>" * 40_000 + "</article>"
    pages = spark.createDataFrame([(1, UNSEEN[0][0]), (1, UNSEEN[0][0]), (2, long)], "page_id bigint, html string").withColumn("label", F.lit("x"))
    got = [(r.page_id, len(r.main_text)) for r in main_text(pages).orderBy("page_id").collect()]
    assert got == [(1, len(TEXT)), (1, len(TEXT)), (2, 40_000 * 34 - 2)]
    assert main_text(pages.limit(0)).count() == 0


def test_licenses(spark):
    from marketloom.llm.licenses import TEMPLATES, scan

    rows = [(1, None), (2, ""), (3, f"{LONG}\n{TEMPLATES['mit']} {LONG}"), (4, f"{LONG} Licensed under CC BY-NC 4.0.\n"), (5, LONG)]
    got = {(r.doc_id, r.license) for r in scan(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert got == {(3, "mit"), (4, "cc-by-nc-4.0-notice")}


def test_vectors(spark):
    import math

    from marketloom.llm.forest import near_vectors
    from marketloom.llm.topk import top_k

    vectors = [(i, [math.cos(i / 9), math.sin(i / 9), 0.1 * (i % 3)]) for i in range(60)]
    odd = [(100, None), (101, []), (102, [0.0, 0.0, 0.0]), (103, [1.0, None, 0.0]), (104, [float("nan"), 1.0, 0.0]), (105, [1.0, 2.0]), (0, vectors[0][1])]
    table = spark.createDataFrame(vectors + odd + [(200, vectors[5][1])], "vec_id bigint, embedding array<double>")
    sound = vectors + [(200, vectors[5][1])]
    whole = {i: [math.floor(256 * x) for x in v] for i, v in sound}
    whole[102] = [0, 0, 0]
    want = set()
    for q in (i for i in whole if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(whole[q], v)), i) for i, v in whole.items() if i != q)
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores[:5])}
    got = {tuple(r) for r in top_k(table, F.col("vec_id") % 50 == 0).collect()}
    assert got == want

    def cosine(a, b):
        return sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))

    links = [(i, j) for i, a in sound for j, b in sound if i != j and cosine(a, b) >= 0.95]
    ids = [i for i, _ in sound] + [r[0] for r in odd if r[0]]
    root = brute.closure(ids, links)
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_vectors(table).collect()}
    assert got == {i: (sum(a == i for a, _ in links), root[i]) for i in ids}


def test_vectors_in_a_large_group(spark):
    """A third of the rows is one group of distinct near copies around the bound: every link inside it is found."""
    import numpy as np

    from marketloom.llm.forest import near_vectors

    rng = np.random.default_rng(5)
    x = rng.standard_normal((2400, 64))
    x[::3] = rng.standard_normal(64) + 0.2 * rng.standard_normal((800, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = (x @ x.T >= 0.95).sum(axis=1) - 1
    assert 200_000 < want.sum() < 600_000  # some pairs of the group are linked, some not
    table = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, embedding array<double>")
    got = {r.vec_id: r.n_links for r in near_vectors(table, leaf=16).collect()}
    assert got == dict(enumerate(want.tolist()))


def test_toxicity_on_held_out_rows(spark):
    """Ranking, recall and precision at the cut, and what a single sure insult does to a clean text."""
    import re

    from marketloom.llm import toxicity
    from marketloom.llm.common import table

    sf = "/root/testdata/sf0.1"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    docs = table(spark, sf, "documents")
    model = toxicity.fit(docs, table(spark, sf, "labels"))
    scores = {r.doc_id: r.score for r in toxicity.score(docs, model).select("doc_id", "score").collect()}
    held = [i for i in scores if i in labels and brute.held_out(i)]
    assert brute.auc([(scores[i], labels[i]) for i in held]) > 0.9

    # entries that at least 20 labelled toxic rows have and hardly any other: each lifts an otherwise clean text over the cut
    words = {i: set(re.findall(r"[^\W\d_]+", texts[i].lower())) for i in labels if i in texts and not brute.held_out(i)}
    sure = set()
    for entry in model.voters.entries:
        rows = [i for i, w in words.items() if any(x == entry[1:] if entry[0] == "=" else x.startswith(entry[1:]) for x in w)]
        toxic = sum(labels[i] for i in rows)
        if toxic >= 20 and toxic >= 0.95 * len(rows):
            sure.add(entry)
            assert model.scores([f"the fields were {entry[1:]} under water"])[0] >= toxicity.CUT, entry
    assert len(sure) >= 5
    assert max(model.scores(["the fields were under water", "", None])) < 0.2

    # of held-out toxic rows with any such insult all are found, and hardly a clean row is
    def insulted(i):
        w = re.findall(r"[^\W\d_]+", texts[i].lower())
        return any(x.startswith(e[1:]) for x in w for e in sure)

    named = [i for i in held if labels[i] and insulted(i)]
    assert len(named) > 50 and sum(scores[i] >= toxicity.CUT for i in named) >= 0.95 * len(named)
    clean = [i for i in held if not labels[i]]
    assert sum(scores[i] >= toxicity.CUT for i in clean) <= 0.01 * len(clean)


def test_toxicity_of_odd_tables(spark):
    from marketloom.llm import toxicity

    rows = [(i, f"fine words {i} here and there") for i in range(40)] + [(100 + i, f"you {chr(97 + i) * 3} wretchling of a thing") for i in range(20)]
    rows += [(None, "you wretchling"), (300, None), (300, ""), (100, "you aaa wretchling of a thing"), (301, "wretchling " * 120_000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("toxic", "pattern", "n")})
    labels = spark.createDataFrame([(i, int(i >= 100)) for i, _ in rows if i is not None and i < 200] + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    model = toxicity.fit(docs, labels)
    got = [(r.doc_id, r.score) for r in toxicity.score(docs, model).collect()]
    assert len(got) == len(rows)
    assert all((s >= 0.7) == (i is None or 100 <= i < 200 or i == 301) for i, s in got), got
    nothing = toxicity.fit(docs.limit(0), labels.limit(0))
    assert toxicity.score(docs.limit(0), nothing).count() == 0 and 0 <= nothing.scores(["idiot"])[0] <= 1


def test_pipeline_against_plain_stages(spark):
    """run() over a whole small table; the model's own scores decide what is toxic, the rest is plain Python."""
    import struct
    import zlib

    from tokenizers import Tokenizer

    import corpus_pipeline as C
    import public_tokenizers as P
    from marketloom.llm import toxicity
    from marketloom.llm.common import table

    docs = table(spark, SF, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, SF, "labels")), column="toxicity")
    toxic = {r.doc_id for r in scored.filter(F.col("toxicity") >= toxicity.CUT).select("doc_id").collect()}
    texts = {r.doc_id: r.text for r in docs.collect() if r.doc_id not in toxic}
    texts = {i: texts[i] for i, (_, root) in brute.near_duplicates(texts).items() if root == i}
    cut = brute.remove_repeats(texts)
    texts = {i: texts[i] if not gone else kept.decode("utf-8", "replace").replace("\ufffd", "") for i, (_, gone, _, kept) in cut.items()}
    assert toxic and any(gone for _, gone, _, _ in cut.values())

    tool = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    pieces, sequences = {}, {}
    for r in C.run(spark, SF).collect():
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(pieces) == set(texts)
    for i, text in texts.items():
        ids, at = tool.encode(text or "", add_special_tokens=False).ids + [1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            own = ids[r.start : r.start + r.length]
            assert (r.start, r.doc_tokens) == (at, len(ids)) and len(own) == r.length
            assert r.ids_crc32 == zlib.crc32(struct.pack(f"<{len(own)}I", *own))
            at += r.length
        assert at == len(ids)
    for own in sequences.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 2048


def test_pipeline_stages_on_odd_tables(spark, docs):
    """Null and empty texts stay, an empty table stays empty; columns of other names don't get through."""
    import corpus_pipeline as C

    odd = docs.filter("doc_id <= 4").withColumn("n_chars", F.length("text").cast("bigint"))
    for name, stage in C.STAGES[:-1]:
        out = stage(spark, odd, SF)
        assert out.columns == C.COLUMNS
        assert {r.doc_id for r in out.collect()} == {1, 2, 3, 4}, name
        assert stage(spark, odd.limit(0), SF).count() == 0, name
    assert C.STAGES[-1][1](spark, odd.limit(0), SF).count() == 0


def test_pipeline_keeps_rows_without_id_and_one_of_repeated_rows(spark):
    import corpus_pipeline as C

    rows = [
        (1, LONG, "en", "a", 1), (1, LONG, "en", "b", 1), (2, "one two", "en", "a", 7), (2, "three four", "en", "a", 10),
        (3, LONG, "en", "a", 1), (4, None, "en", "a", None), (4, None, "en", "a", None),
        (None, LONG, "en", "a", 1), (None, LONG, "en", "a", 1), (None, None, "en", "a", None),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    near = C.drop_near_copies(spark, docs, SF)
    texts = [(1, LONG), (2, "one two"), (2, "three four"), (4, None), (None, LONG), (None, LONG), (None, None)]
    key = lambda r: (r[0] or 0, r[1] or "")
    assert sorted(((r.doc_id, r.text) for r in near.collect()), key=key) == sorted(texts, key=key)
    done = C.drop_repeats(spark, near, SF).collect()
    assert sorted(((r.doc_id, r.text) for r in done), key=key) == sorted(((i, t or "") for i, t in texts), key=key)
    assert all(r.n_chars == len(r.text) for r in done)
    unnamed = docs.filter("doc_id is null")
    for name, stage in C.STAGES:  # each stage by itself, over nothing but such rows
        out = [r.doc_id for r in stage(spark, unnamed, SF).collect() if name != "packing" or r.start == 0]
        assert out == [None] * 3, name


def test_pipeline_keeps_replacement_characters(spark):
    """Of the text around a removed passage only what is left of characters that were cut apart goes."""
    import corpus_pipeline as C

    passage = " ".join(WORDS[:30])
    # \u00e4 and \u00e5 share their first byte, \u00e9 and \U0001f4a9 their last one, so both repeats end inside a character
    rows = [
        (1, f"\u00e4{passage}\u00e4"), (2, f"\ufffd one \ufffd\u00e5{passage}\u00e5\ufffd two \ufffd"),
        (3, f"\u00e9{passage[::-1]}."), (4, f"\ufffd\U0001f4a9{passage[::-1]}.\ufffd"),
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "'en' lang", "'a' source", "1L n_chars")
    got = {r.doc_id: (r.text, r.n_chars) for r in C.drop_repeats(spark, docs, SF).collect()}
    want = dict(rows[:1] + rows[2:3]) | {2: "\ufffd one \ufffd\u00e5\ufffd two \ufffd", 4: "\ufffd\ufffd"}
    assert got == {i: (t, len(t)) for i, t in want.items()}

    import numpy as np

    from marketloom.llm.suffix import whole_characters

    text = np.frombuffer("a\u00e4\u20ac\U0001f4a9b".encode() + b"\x80", np.uint8)
    for cut, out in ((0, [0]), (2, [1, 2]), (3, [3, 4, 5]), (9, [6, 7, 8, 9]), (10, [10]), (11, [11])):
        assert np.flatnonzero(whole_characters(text, np.arange(len(text)) == cut)).tolist() == out
