"""Resampling against a plain version, and the exact cut against sorting."""

import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from marketloom.llm import resample as R

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def features(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    runs = [" ".join(words[i : i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return [zlib.crc32(x.encode()) % 10000 for x in runs], len(words)


def plain(docs, target):
    own = [features(t) for _, t in docs]
    s, t = [0] * 10000, [0] * 10000
    for side, lists in ((s, (f for f, _ in own)), (t, (features(x)[0] for x in target))):
        for f in lists:
            for b in f:
                side[b] += 1
    gain = [math.floor(1000 * math.log((y + 1) * (sum(s) + 10000) / ((x + 1) * (sum(t) + 10000)))) for x, y in zip(s, t)]
    rows = []
    for (i, _), (f, n) in zip(docs, own):
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        rows.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in rows if r[5] >= 20 and r[0] is not None), key=lambda r: (-r[3], r[0], r[1]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return [tuple(r[:5]) for r in rows]


@pytest.mark.parametrize("size", [1 << 20, 64])
def test_resample(spark, monkeypatch, size):
    rng = random.Random(size)
    alphabet = ["the", "River", "é", "字", "ß1", "  ", ",", "\n", "x" * 90, "A-b"]
    texts = [" ".join(rng.choice(alphabet) for _ in range(rng.randint(0, 120))) for _ in range(400)]
    texts[:4] = [None, "", " .,! ", "one"]
    docs = [(i, t) for i, t in enumerate(texts)] + [(7, texts[7]), (8, texts[9]), (None, texts[10])] + [(1000, "word " * 300_000)]
    target = [texts[20], None, "the river the river", texts[30]]
    monkeypatch.setattr(R, "SLICE", size)
    table = spark.createDataFrame(docs, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("score", "rank", "low", "part")})
    goal = spark.createDataFrame([(t,) for t in target], "text string")
    key = lambda r: (r[0] is None, r[0], r[1:4], r[4] or 0)
    got = sorted((tuple(r) for r in R.resample(table, goal).collect()), key=key)
    assert got == sorted(plain(docs, target), key=key)
    assert R.resample(table.limit(0), goal).count() == 0
    assert R.resample(table, goal.limit(0)).count() == len(docs)


def test_slices_of_a_long_text(monkeypatch):
    rng = random.Random(2)
    monkeypatch.setattr(R, "SLICE", 50)
    for _ in range(200):
        text = "".join(rng.choice("abcXYZ019 ,.\n\té字ß'") for _ in range(rng.randint(0, 400)))
        buckets, words = [], 0
        for _, pieces in R._blocks([text.encode()]):
            _, found, counts = R.features(pieces)
            buckets += found.tolist()
            words += int(counts.sum())
        assert (sorted(buckets), words) == (sorted(features(text)[0]), features(text)[1])


def test_cutoff_is_exact(spark, monkeypatch):
    """Any rank, many ties, few keys to a block, and so several rounds and rewritings."""
    monkeypatch.setattr(R, "KEYS", 16)
    rng = random.Random(6)
    keys = [(rng.choice([5, 5, 5, rng.randint(-10**12, 10**12), rng.randint(0, 40)]), i) for i in range(3000)]
    table = spark.createDataFrame(keys + keys[:50], "low bigint, id bigint").repartition(8)
    ordered = sorted(keys + keys[:50])
    for k in (1, 2, 700, 1525, 3049, 3050):
        assert R.cutoff(table, k, rest=8) == R.Key(*ordered[k - 1])
    assert R.cutoff(table, 3051) is None and R.cutoff(table, 0) is None and R.cutoff(table.limit(0), 1) is None
    assert R.weighted_median([(1, 1, 1), (2, 1, 5), (3, 1, 1)]) == R.Key(2, 1)
