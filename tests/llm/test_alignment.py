"""Alignment of two tokenizers against a plain walk over both token lists."""

import hashlib
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

import public_tokenizers as P
from marketloom.llm import align as A

PATHS = P.path("byte_bpe_50k.json"), P.path("piece_bpe_32k.model")
PIECES = [
    "a", "b", " ", "  ", "\n", "é", "字", "。", "the ", "'s", "don't", "1", "▁", "<|endoftext|>", "<s>", "\t", "tion", ".", ", ",
    "\x00", "😀", "-", "\r\n", "Ünd",
]


def plain(text):
    """(n_a, n_b, groups, links, linked pairs, groups' text), or None."""
    a, b = A._tools(*PATHS)
    ids_a, ids_b = a.tool.encode(" " + (text or ""), add_special_tokens=False).ids, b.tool.encode(text or "")
    if not text or b"".join(b.bytes[i] for i in ids_b) != (" " + text).encode():
        return None
    ends = []
    for ids, sizes in ((ids_a, a.sizes), (ids_b, b.sizes)):
        at = 0
        ends.append([at := at + int(sizes[i]) for i in ids])
    groups, pairs, i, j = [], Counter(), 0, 0
    for c in sorted(set(ends[0]) & set(ends[1])):
        x = [t for t, e in zip(ids_a[i:], ends[0][i:]) if e <= c] if len(ids_a) - i < 50 else _upto(ids_a, ends[0], i, c)
        y = [t for t, e in zip(ids_b[j:], ends[1][j:]) if e <= c] if len(ids_b) - j < 50 else _upto(ids_b, ends[1], j, c)
        i, j = i + len(x), j + len(y)
        groups.append(",".join(map(str, x)) + "|" + ",".join(map(str, y)))
        pairs.update((u, v) for u in x for v in y)
    return len(ids_a), len(ids_b), len(groups), sum(pairs.values()), pairs, ";".join(groups)


def _upto(ids, ends, at, limit):
    out = []
    while at < len(ids) and ends[at] <= limit:
        out.append(ids[at])
        at += 1
    return out


def figures(fragment):
    done = fragment.groups()
    if not fragment.sound or not done.groups:
        return None
    pairs = {(k >> 32, k & 0xFFFFFFFF): n for k, n in zip(done.pairs.tolist(), done.times.tolist())}
    return fragment.n_a, fragment.n_b, done.groups, done.links, pairs, done.text


@pytest.mark.parametrize("group", [4096, 4])
def test_fragments_compose_in_any_order(monkeypatch, group):
    import pyarrow as pa

    rng = random.Random(group)
    monkeypatch.setattr(A, "GROUP", group)
    for _ in range(400):
        text = "".join(rng.choice(PIECES) for _ in range(rng.randint(1, 60)))
        want = plain(text)
        assert figures(A._range(" " + text, 0, " " + text, 0, *PATHS)) == want, text
        monkeypatch.setattr(A, "STEP", rng.choice([3, 7, 20]))
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], ["row", "doc_id", "text"])
        ranges = [r for b in A._ranges(iter([batch]), *PATHS) for r in b.to_pylist()]
        parts = [A._range(r["text_a"], r["start_a"], r["text_b"], r["start_b"], *PATHS) for r in ranges]
        parts = [A._fragment(A._row(1, 1, 0, f)) for f in parts]
        while len(parts) > 1:
            k = rng.randrange(len(parts) - 1)
            parts[k : k + 2] = [parts[k] + parts[k + 1]]
        assert figures(parts[0]) == want, text


def test_align(spark, monkeypatch):
    """Nulls, empties, repeated ids, rows without an id, long texts in ranges, several blocks, and clashing columns."""
    rng = random.Random(9)
    some = ["".join(rng.choice(PIECES[:7] + PIECES[8:12]) for _ in range(rng.randint(1, 80))) for _ in range(60)]
    wide = " ".join(rng.choice(["the", "of", "字。字", "don't", "x" * 30, "1904", "é"]) for _ in range(30_000))
    texts = [None, "", " ", "a▁b", "<|endoftext|> <s>", wide, wide[:70_000], "ab" * 40_000, *some, *some[:5]]
    rows = [(None if i == 10 else 5 if i in (11, 12) else i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumns({c: F.lit("x") for c in ("block", "pair", "row", "n_a")})
    want = []
    done = [plain(t) for _, t in rows]
    count = Counter(k for d in done if d for k in d[4])
    best = {}
    for (a, _), n in count.items():
        best[a] = max(best.get(a, 0), n)
    for (i, _), d in zip(rows, done):
        if d is None:
            want.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        sums = [sum(n for (a, b), n in d[4].items() if count[a, b] == best[a]), sum(n * count[k] for k, n in d[4].items())]
        want.append((i, *d[:4], *sums, hashlib.sha256(d[5].encode()).hexdigest()))
    key = lambda r: (r[0] is None, r[0], r[1:])
    got = [tuple(r) for r in A.align(docs, *PATHS).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert A.align(docs.limit(0), *PATHS).count() == 0
