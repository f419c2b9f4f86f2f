"""Toxicity by weak supervision: lexicon and pattern voters, a generative label model, a linear classifier."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marketloom.llm.common import staged

SAMPLE = 20_000  # most labelled rows that are learned from
ENTRIES = 256  # most learned lexicon entries
CANDIDATES = 4096  # most candidates that are compared with each other, the most frequent in toxic rows
OWN, SHARED = 48, 8  # entries that are surely pure vote each for itself, the others are dealt to so many voters
SURE = 0.9  # the least purity, at 95 % confidence, of an entry with a voter of its own
LEAST, PURITY, RATIO = 5, 0.85, 20.0  # an entry's toxic rows, the toxic share of its rows, and how much more often toxic rows have it
STEMS = (4, 5, 6)  # word beginnings that may become entries, besides whole words
ROUNDS = 12
CUT = 0.7

# A general lexicon of insults in four languages.
GENERAL = frozenset(
    "idiot idiots moron morons imbecile stupid dumb fool scum trash garbage loser losers worthless pathetic disgusting "
    "clown filth vermin bastard bitch asshole dummkopf trottel abschaum arschloch idiota estúpido imbécil basura "
    "mierda connard salaud ordure crétin".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_ATTACK = re.compile(r"\b(?:you are|you're|du bist|tu es|eres)\s+(?:an?|ein|eine|une?)\b", re.I)
_SHOUT = re.compile(r"\b[A-Z]{4,}\b")
PATTERNS = 4  # general lexicon, two or more insults, form of attack, shouting
VOTERS = OWN + SHARED + PATTERNS
LEXICONS = OWN + SHARED
SEVERAL = LEXICONS + 1  # the voter for two or more insults


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that nothing is learned from."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % 3 == 1


@dataclass
class Voters:
    """Lexicon entries ("=word" or "^stem") and the votes they and the patterns cast."""

    entries: list[str]
    own: int = 0  # the first so many have a voter of their own

    def __post_init__(self) -> None:
        self.words = {e[1:]: i for i, e in enumerate(self.entries) if e[0] == "="}
        self.stems = {n: {e[1:]: i for i, e in enumerate(self.entries) if e[0] == "^" and len(e) == n + 1} for n in STEMS}

    def read(self, text: str) -> tuple[int, list[int], int]:
        """The votes as bits, the entries that the text has, and its insults. A voter that doesn't fire abstains."""
        words = set(_WORD.findall(text.lower()))
        hits = words & self.words.keys()
        entries = [self.words[w] for w in hits]
        for n, stems in self.stems.items():
            for stem in stems.keys() & {w[:n] for w in words}:
                entries.append(stems[stem])
                hits.update(w for w in words if w[:n] == stem)
        bits = 0
        for i in entries:
            bits |= 1 << (i if i < self.own else OWN + i % SHARED)
        general = words & GENERAL
        found = len(hits | general)
        for k, fired in enumerate((bool(general), found > 1, bool(_ATTACK.search(text)), len(_SHOUT.findall(text)) > 4)):
            bits |= fired << (LEXICONS + k)
        return bits, entries, found


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return (patterns.reshape(-1, 1) >> np.arange(VOTERS) & 1).astype(float)


def inputs(read: list[tuple[int, list[int], int]]) -> np.ndarray:
    """The classifier's inputs: entries, voters, and the logarithm of the number of insults."""
    x = np.zeros((len(read), ENTRIES + VOTERS + 1))
    x[:, ENTRIES:-1] = votes_of(np.array([b for b, _, _ in read], np.int64))
    for row, (_, entries, found) in zip(x, read):
        row[entries] = 1
        row[-1] = np.log1p(found)
    return x


def _entries(word: str) -> list[str]:
    return (["=" + word] if len(word) > 2 else []) + ["^" + word[:n] for n in STEMS if len(word) >= n]


def _candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task, in how many toxic and other texts each word and word beginning occurs, and in the toxic ones behind
    which words, as a bitmap of 64 hash values."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    behind: dict[str, int] = {}

    def flush() -> pa.RecordBatch:
        keys = list(counts[0].keys() | counts[1].keys())
        out = [pa.array(keys, pa.string())] + [pa.array([c[k] for k in keys], pa.int64()) for c in (counts[1], counts[0])]
        masks = np.array([behind.get(k, 0) for k in keys], np.uint64).view(np.int64)
        for c in (*counts, behind):
            c.clear()
        return pa.RecordBatch.from_arrays([*out, pa.array(masks)], ["entry", "toxic", "clean", "behind"])

    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            words = _WORD.findall((text or "").lower())
            counts[1 if toxic else 0].update({e for w in set(words) for e in _entries(w)})
            if toxic:
                for before, w in set(zip(["", *words], words)):
                    bit = 1 << (zlib.crc32(before.encode()) & 63)
                    for e in _entries(w):
                        behind[e] = behind.get(e, 0) | bit
            if len(counts[0]) + len(counts[1]) > 300_000:
                yield flush()
    yield flush()


def sure_purity(toxic: int, clean: int) -> float:
    """The lower end of the 95 % interval of an entry's purity (Wilson)."""
    n, z = toxic + clean, 1.96
    p = toxic / n
    return (p + z * z / (2 * n) - z * np.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)


def choose_entries(found: list[tuple[str, int, int]]) -> Voters:
    """Of candidates (entry, toxic rows, other rows) that say the same one stays, and only then the most frequent are taken.

    A beginning gives way to a longer entry that is purer and keeps nine tenths of its toxic rows; the entries it covers go.
    """
    rows = sorted(found, key=lambda x: (len(x[0]), x[0][0] != "^", x[0]))
    kept: list[tuple[str, int]] = []
    stems: set[str] = set()
    for entry, toxic, clean in rows:
        body = entry[1:]
        if any(body[:n] in stems for n in STEMS if n <= len(body)):
            continue
        better = entry[0] == "^" and any(
            e != entry and e[1:].startswith(body) and 10 * t >= 9 * toxic and (c + 1) * toxic < (clean + 1) * t for e, t, c in rows
        )
        if not better:
            kept.append((entry, toxic))
            if entry[0] == "^":
                stems.add(body)
    counts = {e: (t, c) for e, t, c in found}
    kept.sort(key=lambda x: (-x[1], x[0]))
    sure = [e for e, _ in kept if sure_purity(*counts[e]) >= SURE][:OWN]
    return Voters((sure + [e for e, _ in kept if e not in sure])[:ENTRIES], len(sure))


def learn_lexicon(sample: DataFrame) -> Voters:
    """Words and word beginnings that at least LEAST toxic rows have, hardly any others, the most frequent first. They must stand behind
    at least LEAST different words, too: all words of one toxic text that has many copies are as frequent as an insult, but where
    they stand is always the same."""
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic, clean = n.get(1, 0), n.get(0, 0)
    if not toxic:
        return Voters([])
    found = (
        sample.select("text", "toxic").mapInArrow(_candidates, "entry string, toxic bigint, clean bigint, behind bigint")
        .groupBy("entry").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"), F.bit_count(F.bit_or("behind")).alias("behind"))
        .filter(F.col("behind") >= LEAST)
        .filter((F.col("toxic") >= LEAST) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("clean"))))
        .filter(F.col("toxic") / toxic >= RATIO * (F.col("clean") + 0.5) / (clean + 1))
        .orderBy(F.desc("toxic"), F.length("entry"), "entry").limit(CANDIDATES).collect()
    )
    return choose_entries([(r["entry"], r["toxic"], r["clean"]) for r in found])


@dataclass
class LabelModel:
    """Log odds of the classes, of a vote whose parent in the tree of correlations is silent, of one whose parent fired, too, and of
    silence of all voters. A voter that doesn't fire abstains.

    Voters that repeat each other are neighbours in that tree, so what both say counts once, as far as the second vote is explained
    by the first in either class; and what a vote says by itself differs from what it says beside others.
    """

    prior: float
    parent: np.ndarray
    alone: np.ndarray
    after: np.ndarray
    silent: float

    def logits(self, votes: np.ndarray) -> np.ndarray:
        again = votes * votes[:, self.parent] * (self.parent != np.arange(VOTERS))
        return self.prior + votes @ self.alone + again @ (self.after - self.alone) + (votes.sum(axis=1) == 0) * self.silent

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(votes), -30, 30)))


def _tree(rates: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Each voter's parent in the tree of the largest dependence within the classes (a root is its own parent)."""
    weight = np.zeros((VOTERS, VOTERS))
    for p, j in zip(rates, both):
        for a, b, cell in ((p, p, j), (p, 1 - p, p[:, None] - j), (1 - p, p, p[None, :] - j), (1 - p, 1 - p, 1 - p[:, None] - p[None, :] + j)):
            cell = np.clip(cell, 1e-12, None)
            weight += cell * np.log(cell / np.clip(np.outer(a, b), 1e-12, None))
    parent = np.arange(VOTERS)
    inside = np.zeros(VOTERS, bool)
    inside[0] = True
    best, near = weight[0].copy(), np.zeros(VOTERS, int)
    for _ in range(VOTERS - 1):
        k = int(np.where(inside, -np.inf, best).argmax())
        parent[k], inside[k] = near[k], True
        closer = weight[k] > best
        best, near = np.where(closer, weight[k], best), np.where(closer, k, near)
    return parent


def maximise(mass: np.ndarray, ones: np.ndarray, pairs: np.ndarray, quiet: np.ndarray) -> LabelModel:
    """The model of (expected) counts: rows per class, rows a voter fires in, rows two voters fire in, rows without any vote."""
    total = mass[:, None] + 2
    rate = (ones + 0.1) / total
    parent = _tree(rate, pairs / total[:, :, None])
    own = np.arange(VOTERS)
    # a weak entry is weighed by whether it is the text's only one
    if OWN <= parent[SEVERAL] < LEXICONS:
        parent[SEVERAL] = SEVERAL
    parent[OWN:LEXICONS] = SEVERAL
    root = parent == own
    both = np.where(root, 0, pairs[:, own, parent])
    # cells of few rows lean towards the voter's own rate
    alone = (ones - both + 5 * rate) / (mass[:, None] + 5)
    after = (both + 5 * rate) / (np.where(root, 0, ones[:, parent]) + 5)
    silent = (quiet + 0.1) / total[:, 0]
    prior = float(np.clip(mass[1] / max(mass.sum(), 1e-9), 1e-3, 0.5))
    odds = [np.log(np.clip(x[1], 1e-9, 1) / np.clip(x[0], 1e-9, 1)) for x in (alone, after)]
    return LabelModel(float(np.log(prior / (1 - prior))), parent, *odds, float(np.log(silent[1] / silent[0])))


def _expect(batches: Iterator[pa.RecordBatch], model: LabelModel | None) -> Iterator[pa.RecordBatch]:
    """One task's expected counts; labelled rows keep their class, and without a model they are the only ones."""
    sums = np.zeros(4 + 2 * VOTERS + 2 * VOTERS * VOTERS)
    for batch in batches:
        pattern, n, clean, toxic = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
        votes = votes_of(pattern.astype(np.int64))
        mass = np.stack([clean, toxic]).astype(float)
        if model is not None:
            p = model.posterior(votes)
            mass += np.maximum(n - clean - toxic, 0) * np.stack([1 - p, p])
        quiet = votes.sum(axis=1) == 0
        pairs = [(votes * m[:, None]).T @ votes for m in mass]
        sums += np.concatenate([mass.sum(axis=1), (mass @ votes).ravel(), np.ravel(pairs), mass[:, quiet].sum(axis=1)])
    yield pa.RecordBatch.from_arrays([pa.array([sums.tobytes()], pa.binary())], ["sums"])


def fit_label_model(patterns: DataFrame, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over patterns(pattern, n, clean, toxic): all rows that vote so, and labelled ones of either class.
    Every round is one pass over the patterns, of which a task sends one row of sums. The shared voters keep what labelled rows say of
    them: they are too weak for rows without labels to teach them."""
    model = base = None
    for _ in range(rounds + 1):
        rows = patterns.mapInArrow(partial(_expect, model=model), "sums binary").collect()
        sums = np.sum([np.frombuffer(r["sums"]) for r in rows], axis=0) if rows else np.zeros(4 + 2 * VOTERS + 2 * VOTERS**2)
        mass, ones, pairs, quiet = np.split(sums, np.cumsum([2, 2 * VOTERS, 2 * VOTERS * VOTERS]))
        if model is None:
            mass = mass + [0.5, 0.5]  # without labels the classes begin even
        model = maximise(mass, ones.reshape(2, -1), pairs.reshape(2, VOTERS, VOTERS), quiet)
        base = base or model
        for name in ("parent", "alone", "after"):
            getattr(model, name)[OWN:LEXICONS] = getattr(base, name)[OWN:LEXICONS]
    return model


def fit_linear(x: np.ndarray, target: np.ndarray, start: np.ndarray, ridge: float = 1.0, rounds: int = 60) -> np.ndarray:
    """Weights (the bias last) of a logistic regression on soft labels, by Newton steps. What the rows don't say stays near ``start``."""
    z = np.column_stack([x, np.ones(len(x))])
    w = start.copy()
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (p - target) + ridge * (w - start)
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w)), slope)
        w -= step * min(1.0, 4 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    voters: Voters
    labels: LabelModel
    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        entry, vote, many = np.split(self.weights, [ENTRIES, ENTRIES + VOTERS])
        out = np.full(len(texts), self.bias)
        for i, text in enumerate(texts):
            if text:
                bits, entries, found = self.voters.read(text)
                if bits:
                    fired = [k for k in range(VOTERS) if bits >> k & 1]
                    out[i] += entry[entries].sum() + vote[fired].sum() + many[0] * np.log1p(found)
        return 1 / (1 + np.exp(-np.clip(out, -30, 30)))


def _patterns(batches: Iterator[pa.RecordBatch], voters: Voters) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = [pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())]
        counts.clear()
        return pa.RecordBatch.from_arrays(out, ["pattern", "n"])

    for batch in batches:
        counts.update(voters.read(t or "")[0] for t in batch.column(0).to_pylist())
        if len(counts) > 300_000:
            yield flush()
    yield flush()


def _known(sample: DataFrame, voters: Voters) -> DataFrame:
    """What the voters read in the labelled rows."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = [voters.read(t or "") for t in batch.column(0).to_pylist()]
            columns = [pa.array(c, t) for c, t in zip(zip(*seen), (pa.int64(), pa.list_(pa.int32()), pa.int32()))] if seen else []
            if columns:
                yield pa.RecordBatch.from_arrays([*columns, batch.column(1)], ["pattern", "entries", "found", "toxic"])

    return sample.select("text", "toxic").mapInArrow(read, "pattern bigint, entries array<int>, found int, toxic int")


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE) -> Model:
    """Learn from ``docs`` (doc_id, text) and ``labels`` (doc_id, toxic) outside the held-out rows.

    Labels come from at most ``sample_rows`` rows, those with the smallest hash of the id (so that
    every size takes them alike); that table's bound is what lets it be copied to the scan. The label
    model is fitted to the vote patterns of all documents, which stay on the executors. Null labels and
    ids are ignored; a document with several labels has the largest. Without labelled toxic rows
    only the general lexicon and the patterns vote. Texts of any length are read whole, one at a time.
    """
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    chosen = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )
    sample = staged(docs.join(F.broadcast(staged(chosen, "labels")), "doc_id"), "sample")
    voters = learn_lexicon(sample)
    known = staged(_known(sample, voters), "known")
    counted = docs.select("text").mapInArrow(partial(_patterns, voters=voters), "pattern bigint, n bigint")

    of = [F.count_if(F.col("toxic") == y).alias(name) for y, name in ((0, "clean"), (1, "toxic"))]
    none = F.lit(0).cast("bigint")
    patterns = (
        counted.select("pattern", "n", none.alias("clean"), none.alias("toxic"))
        .unionAll(known.groupBy("pattern").agg(*of).select("pattern", none.alias("n"), "clean", "toxic"))
        .groupBy("pattern").agg(F.sum("n").alias("n"), F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    model = fit_label_model(staged(patterns, "patterns"))
    rows = known.collect()  # at most ``sample_rows``
    x = inputs([(r["pattern"], r["entries"], r["found"]) for r in rows])
    # a vote that the rows hardly show weighs what it says by itself in the label model
    start = np.concatenate([np.zeros(ENTRIES), model.alone - model.silent, [0.0, model.prior + model.silent]])
    weights = fit_linear(x, model.posterior(x[:, ENTRIES:-1]), start)
    return Model(voters, model, weights[:-1], float(weights[-1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", column: str = "score") -> DataFrame:
    """All columns of ``docs`` and the score. Null and empty texts get the score of a text without any vote.
    Rows are neither merged nor dropped."""
    names = docs.columns
    schema = StructType([*docs.schema.fields, StructField(column, DoubleType())])
    text_at = names.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(model.scores(batch.column(text_at).to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*names, column])

    return docs.mapInArrow(run, schema)
