"""Alignment of two tokenizers: fragments of byte ranges, composed associatively, and corpus-wide counts of linked ids."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from marketloom.llm.common import staged
from marketloom.llm.filetokens import FileTokens

LONG = 32_768  # bytes of a text beyond which its ranges go to tasks of their own
STEP = 16_384  # characters of a range
FAN = 8  # fragments composed into one at a time
ENTRIES = 1 << 20  # document and pair entries in one block
GROUP = 4096  # links of a group up to which they are listed; larger groups are counted by id first

# Letters whose class no Unicode version disputes, and what may follow them in a pre-token of its own.
_LETTER = "A-Za-zÀ-ÖØ-öø-ɏЀ-ҁぁ-ゖァ-ヺ一-龥가-힣"
_CUT_A = re.compile(f"[{_LETTER}](?=[.,;:!?\"()\\-。、，]| [{_LETTER}])")


class ByteTokens(FileTokens):
    """Ids of a tokenizer file of the byte-level kind, strings of special tokens being plain text."""

    def __init__(self, path: str) -> None:
        super().__init__(path, specials=False)
        self.sizes = np.zeros(self.tool.get_vocab_size(), np.int64)
        for token, i in self.tool.get_vocab().items():
            self.sizes[i] = len(token)  # one character a byte

    def read(self, text: str, start: int, size: int) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and ends of the tokens of ``text``, whose ``size`` bytes begin at ``start``; None if the tokens aren't those bytes."""
        ids = np.array(self.ids(text), np.int64)
        ends = np.cumsum(self.sizes[ids]) + start
        return (ids, ends) if (ends[-1] if len(ends) else start) == start + size else None

    def cut(self, text: str, at: int) -> int:
        """The first place from ``at`` on where no pre-token of ``text`` goes on."""
        m = _CUT_A.search(text, max(at - 1, 0))
        return m.end() if m else len(text)


class PieceTokens:
    """Ids of a sentencepiece model that keeps its text and puts a space before it. A merged piece is a piece, so a
    text can be cut wherever no piece holds the two characters beside the cut."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.tool = SentencePieceProcessor(model_file=path)
        n = self.tool.vocab_size()
        names = [self.tool.id_to_piece(i) for i in range(n)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self.tool.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)
        ]
        self.sizes = np.array([len(b) for b in self.bytes], np.int64)
        plain = [p.replace("▁", " ") for i, p in enumerate(names) if not (self.tool.is_byte(i) or self.tool.is_control(i) or self.tool.is_unknown(i))]
        self.joined = {p[i : i + 2] for p in plain for i in range(len(p) - 1)}
        self.lead = self.tool.encode("\n")  # a line's end, which no piece goes over, stands in for the text before a cut
        if any("\n" in x for x in self.joined) or self.tool.decode(self.lead) != "\n":
            raise ValueError("The model has pieces that reach over a line's end.")

    def read(self, text: str, start: int) -> tuple[np.ndarray, np.ndarray] | None:
        """As of ``ByteTokens``; None if the tokens aren't the text (U+2581 becomes a shorter space)."""
        if text[:1] == " " and len(text) > 1:
            ids = self.tool.encode(text[1:])
        else:
            ids = self.tool.encode("\n" + text)[len(self.lead) :] if text else []
        if b"".join(map(self.bytes.__getitem__, ids)) != text.encode():
            return None
        found = np.array(ids, np.int64)
        return found, np.cumsum(self.sizes[found]) + start

    def cut(self, text: str, at: int) -> int:
        at, n = max(at, 1), len(text)
        while at < n and text[at - 1 : at + 1] in self.joined:
            at += 1
        return min(at, n)


@lru_cache(maxsize=2)
def _tools(path_a: str, path_b: str) -> tuple[ByteTokens, PieceTokens]:
    return ByteTokens(path_a), PieceTokens(path_b)


@lru_cache(maxsize=1)
def _names(n: int) -> list[str]:
    """Decimal ids, each with the three signs that may follow it."""
    return [f"{i}{sign}" for i in range(n) for sign in ",|;"]


Open = tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]  # A ids and ends, B ids and ends
_NONE = np.zeros(0, np.int64)
_EMPTY: Open = (_NONE, _NONE, _NONE, _NONE)


def _join(x: Open, y: Open) -> Open:
    return tuple(np.concatenate(p) for p in zip(x, y))


def _add(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys with the sums of their times."""
    if not len(keys):
        return keys, times
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(times[order], first)


@dataclass
class Closed:
    """Groups in order: how many, their links, linked pairs (A id << 32 | B id) with their times, and their text."""

    groups: int = 0
    links: int = 0
    pairs: np.ndarray = field(default_factory=lambda: _NONE)
    times: np.ndarray = field(default_factory=lambda: _NONE)
    text: str = ""

    def __add__(self, other: Closed) -> Closed:
        if not other.groups or not self.groups:
            return self if self.groups else other
        pairs, times = _add(np.concatenate((self.pairs, other.pairs)), np.concatenate((self.times, other.times)))
        return Closed(self.groups + other.groups, self.links + other.links, pairs, times, f"{self.text};{other.text}")


def _closed(tokens: Open, common: np.ndarray) -> Closed:
    """The groups that end at ``common``; the last of them is the last end of both sides."""
    a, ends_a, b, ends_b = tokens
    if not len(common):
        return Closed()
    hi_a, hi_b = np.searchsorted(ends_a, common, "right"), np.searchsorted(ends_b, common, "right")
    lo_a, lo_b = np.concatenate(([0], hi_a[:-1])), np.concatenate(([0], hi_b[:-1]))
    n_a, n_b = hi_a - lo_a, hi_b - lo_b
    links = n_a * n_b
    of_a = np.repeat(np.arange(len(common)), n_a)
    of_b = np.repeat(np.arange(len(common)), n_b)
    partners = np.where(links > GROUP, 0, n_b)[of_a]
    at = np.arange(int(partners.sum())) - np.repeat(np.cumsum(partners) - partners - lo_b[of_a], partners)
    keys, times = np.unique(np.repeat(a << 32, partners) | b[at], return_counts=True)
    for g in np.flatnonzero(links > GROUP):
        ids_a, m = np.unique(a[lo_a[g] : hi_a[g]], return_counts=True)
        ids_b, n = np.unique(b[lo_b[g] : hi_b[g]], return_counts=True)
        more = ((ids_a << 32)[:, None] | ids_b).ravel(), (m[:, None] * n).ravel()
        keys, times = _add(np.concatenate((keys, more[0])), np.concatenate((times, more[1])))
    codes = np.empty(len(a) + len(b), np.int64)
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[hi_a - 1], sign_b[hi_b - 1] = 1, 2
    codes[np.arange(len(a)) + lo_b[of_a]] = 3 * a + sign_a
    codes[np.arange(len(b)) + hi_a[of_b]] = 3 * b + sign_b
    names = _names(1 << 17 if codes.max() >= 3 << 16 else 1 << 16)
    text = "".join(map(names.__getitem__, codes.tolist()))[:-1]
    return Closed(len(common), int(links.sum()), keys, times.astype(np.int64), text)


@dataclass
class Fragment:
    """Tokens of a byte range: ``head`` up to its first common end, the closed groups behind it, and ``tail`` behind its last
    common end. Without a common end (``cut`` false) all tokens are its head. ``sound``: the tokens are the text's bytes."""

    head: Open = _EMPTY
    cut: bool = False
    closed: Closed = field(default_factory=Closed)
    tail: Open = _EMPTY
    n_a: int = 0
    n_b: int = 0
    sound: bool = True

    @staticmethod
    def of(tokens: Open) -> Fragment:
        a, ends_a, b, ends_b = tokens
        common = np.intersect1d(ends_a, ends_b, assume_unique=True)
        if not len(common):
            return Fragment(tokens, False, Closed(), _EMPTY, len(a), len(b))
        (f_a, l_a), (f_b, l_b) = (np.searchsorted(e, common[[0, -1]], "right") for e in (ends_a, ends_b))
        middle = (a[f_a:l_a], ends_a[f_a:l_a], b[f_b:l_b], ends_b[f_b:l_b])
        head, tail = (a[:f_a], ends_a[:f_a], b[:f_b], ends_b[:f_b]), (a[l_a:], ends_a[l_a:], b[l_b:], ends_b[l_b:])
        return Fragment(head, True, _closed(middle, common[1:]), tail, len(a), len(b))

    def __add__(self, other: Fragment) -> Fragment:
        """The fragment of both ranges; associative. Common ends that neither range knew lie in the joint between them."""
        joint = Fragment.of(_join(self.tail if self.cut else self.head, other.head))
        head, closed, tail, cut = joint.head, joint.closed, joint.tail, joint.cut
        if self.cut:
            first = _closed(joint.head, joint.head[1][-1:]) if joint.cut else Closed()
            closed, tail = self.closed + first + closed, tail if joint.cut else joint.head
            head, cut = self.head, True
        if other.cut:
            closed, tail = closed + other.closed, other.tail
        return Fragment(head, cut or other.cut, closed, tail, self.n_a + other.n_a, self.n_b + other.n_b, self.sound and other.sound)

    def groups(self) -> Closed:
        """All groups of a whole text, whose first begins where the text does."""
        return _closed(self.head, self.head[1][-1:]) + self.closed if self.cut else Closed()


def _range(text_a: str, start_a: int, text_b: str, start_b: int, path_a: str, path_b: str) -> Fragment:
    tool_a, tool_b = _tools(path_a, path_b)
    a = tool_a.read(text_a, start_a, len(text_a.encode()))
    b = tool_b.read(text_b, start_b)
    return Fragment.of((*a, *b)) if a and b else Fragment(sound=False)


# ---------------------------------------------------------------- blocks of documents

BLOCK = (
    "block bigint, doc_id array<bigint>, stats array<bigint>, digest array<string>, ends array<bigint>, "
    "steps binary, times binary, pairs array<bigint>, holders array<bigint>"
)
_INT, _INTS = pa.int64(), pa.list_(pa.int64())
_BLOCK_TYPES = [_INT, _INTS, _INTS, pa.list_(pa.string()), _INTS, pa.binary(), pa.binary(), _INTS, _INTS]


def _planes(x: np.ndarray) -> bytes:
    """32-bit values byte plane by byte plane, so that the files' compression finds the zeros together."""
    return np.ascontiguousarray(x.astype("<u4").view(np.uint8).reshape(-1, 4).T).tobytes()


def _values(x: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(x, np.uint8).reshape(4, -1).T).view("<u4").ravel().astype(np.int64)


def _blocks(fragments: Iterable[tuple[int | None, Fragment]], kind: int) -> Iterator[pa.RecordBatch]:
    """Documents together up to ENTRIES pairs: their figures, each one's pairs as places in the block's sorted distinct
    pairs, and how many of the block's documents hold each of those."""
    ids, stats, digest, keys, times = [], [], [], [], []
    base, count = (kind << 62) + (TaskContext.get().partitionId() << 32), 0

    def block() -> pa.RecordBatch:
        every = np.concatenate(keys)
        pairs, place, holders = np.unique(every, return_inverse=True, return_counts=True)
        ends = np.cumsum([len(k) for k in keys])
        steps = np.diff(place, prepend=0)
        begins = np.concatenate(([0], ends[:-1]))
        begins = begins[begins < ends]
        steps[begins] = place[begins]
        row = [base + count, ids, stats, digest, ends, _planes(steps), _planes(np.concatenate(times)), pairs, holders]
        out = pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, _BLOCK_TYPES)], [c.split()[0] for c in BLOCK.split(", ")])
        for x in (ids, stats, digest, keys, times):
            x.clear()
        return out

    size = 0
    for doc_id, f in fragments:
        done = f.groups() if f.sound else Closed()
        ids.append(doc_id)
        stats += [f.n_a, f.n_b, done.groups, done.links] if done.groups else [0] * 4
        digest.append(hashlib.sha256(done.text.encode()).hexdigest() if done.groups else "")
        keys.append(done.pairs)
        times.append(done.times)
        size += len(done.pairs) + 16
        if size >= ENTRIES:
            yield block()
            count, size = count + 1, 0
    if ids:
        yield block()


def _short(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    def fragments() -> Iterator[tuple[int | None, Fragment]]:
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                spaced = " " + text if text else ""
                yield doc_id, _range(spaced, 0, spaced, 0, path_a, path_b)

    return _blocks(fragments(), 0)


# ---------------------------------------------------------------- ranges of long documents

RANGE = "row bigint, doc_id bigint, place bigint, text_a string, start_a bigint, text_b string, start_b bigint"
_ARRAYS = [f"{part}_{x}" for part in ("head", "tail") for x in ("a", "ends_a", "b", "ends_b")] + ["pairs", "times"]
FRAGMENT = (
    "row bigint, doc_id bigint, place bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, cut boolean, sound boolean, text string, "
    + ", ".join(f"{x} binary" for x in _ARRAYS)
)


def _ranges(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    """Both tokenizers' texts of each range: from the first place where it can be cut to the next range's."""
    tools = _tools(path_a, path_b)
    names = [c.split()[0] for c in RANGE.split(", ")]
    types = [pa.string() if n.startswith("text") else pa.int64() for n in names]
    for batch in batches:
        for row, doc_id, text in zip(*(c.to_pylist() for c in batch.columns)):
            text = " " + text
            at, byte = [0, 0], [0, 0]
            for place, end in enumerate(range(STEP, len(text) + STEP, STEP)):
                cells: list = [row, doc_id, place]
                for side, tool in enumerate(tools):
                    to = len(text) if end >= len(text) else max(at[side], tool.cut(text, max(end, at[side])))
                    piece = text[at[side] : to]
                    cells += [piece, byte[side]]
                    at[side], byte[side] = to, byte[side] + len(piece.encode())
                yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(cells, types)], names)


def _row(row: int, doc_id: int | None, place: int, f: Fragment) -> dict:
    arrays = [*f.head, *f.tail, f.closed.pairs, f.closed.times]
    figures = [row, doc_id, place, f.n_a, f.n_b, f.closed.groups, f.closed.links, f.cut, f.sound, f.closed.text]
    return dict(zip([c.split()[0] for c in FRAGMENT.split(", ")], figures + [x.astype(np.int64).tobytes() for x in arrays]))


def _fragment(r: dict) -> Fragment:
    x = [np.frombuffer(r[name], np.int64) for name in _ARRAYS]
    closed = Closed(r["n_groups"], r["n_links"], x[8], x[9], r["text"])
    return Fragment(tuple(x[:4]), r["cut"], closed, tuple(x[4:8]), r["n_a"], r["n_b"], r["sound"])


_FRAGMENT_TYPES = pa.schema([
    (name, {"bigint": pa.int64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary()}[kind])
    for name, kind in (c.split() for c in FRAGMENT.split(", "))
])


def _read_ranges(batches: Iterator[pa.RecordBatch], path_a: str, path_b: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for r in batch.to_pylist():
            f = _range(r["text_a"], r["start_a"], r["text_b"], r["start_b"], path_a, path_b)
            yield pa.RecordBatch.from_pylist([_row(r["row"], r["doc_id"], r["place"], f)], _FRAGMENT_TYPES)


def _compose(group: pa.Table) -> pa.Table:
    """Neighbouring fragments of one document as one."""
    rows = sorted(group.to_pylist(), key=lambda r: r["place"])
    whole = _fragment(rows[0])
    for r in rows[1:]:
        whole = whole + _fragment(r)
    first = rows[0]
    return pa.Table.from_pylist([_row(first["row"], first["doc_id"], first["place"] // FAN, whole)], _FRAGMENT_TYPES)


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return _blocks(((r["doc_id"], _fragment(r)) for batch in batches for r in batch.to_pylist()), 1)


def _long(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """Blocks of long documents. Their ranges are dealt to tasks, and fragments composed by a tree of fan FAN."""
    # a row's number comes from its place in the scan, is written at once and read from there
    named = rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text")
    ranges = staged(named.mapInArrow(partial(_ranges, path_a=path_a, path_b=path_b), RANGE), "ranges")
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    read = ranges.repartition(parts, "row", "place").mapInArrow(partial(_read_ranges, path_a=path_a, path_b=path_b), FRAGMENT)
    fragments = staged(read, "fragments")
    last = ranges.agg(F.max("place")).collect()[0][0] or 0
    while last:
        composed = fragments.groupBy("row", F.floor(F.col("place") / FAN).alias("parent")).applyInArrow(_compose, FRAGMENT)
        fragments, last = staged(composed, "fragments"), last // FAN
    return fragments.mapInArrow(_roots, BLOCK)


# ---------------------------------------------------------------- counts

ANSWER = (
    "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"
)


def _answer(block: pa.Table, counted: pa.Table) -> pa.Table:
    """A block's documents with the sums over their links."""
    names = [c.split()[0] for c in ANSWER.split(", ")]
    if not len(block):
        return pa.table({n: pa.array([], pa.string() if n.startswith("groups") else pa.int64()) for n in names})
    r = block.to_pylist()[0]
    count = np.zeros(len(counted), np.int64)
    best = np.zeros(len(counted), np.int64)
    at = counted["at"].to_numpy()
    count[at], best[at] = counted["count"].to_numpy(), counted["best"].to_numpy()
    times, steps = _values(r["times"]), _values(r["steps"])
    ends = np.array(r["ends"], np.int64)
    starts = np.concatenate(([0], ends[:-1]))
    run = np.concatenate(([0], np.cumsum(steps)))
    place = run[1:] - np.repeat(run[starts], ends - starts)
    sums = [np.concatenate(([0], np.cumsum(times * x[place]))) for x in (best, count)]
    stats = np.array(r["stats"], np.int64).reshape(-1, 4).T
    columns = [r["doc_id"], *stats, *(s[ends] - s[starts] for s in sums), r["digest"]]
    return pa.table({n: pa.array(c, pa.string() if n.startswith("groups") else pa.int64()) for n, c in zip(names, columns)})


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every row.

    Space and text are encoded by the byte-level tokenizer file (A), the text by the sentencepiece model (B), both at paths on every
    executor and without special tokens. Byte offsets where tokens of both end cut them into groups; all A and B tokens of a group are
    linked. A pair of ids counts the documents that hold it linked. n_best: links whose count is the highest of their A id.

    Null and empty texts, and texts that B doesn't keep (those with U+2581), have no tokens: zeros and ''. Rows are neither merged
    nor dropped: rows that repeat an id are documents of their own, and a missing id stays null. Texts beyond ``LONG`` bytes are
    cut into ranges that tasks read apart and a tree of compositions joins; only a text without any place to cut stays
    in one. Other columns are ignored.

    Documents meet the counts in blocks: a block asks once for each distinct pair, so a pair that every document holds costs one row
    a block, and nothing that grows with the corpus is copied to the tasks or sent to the driver.
    """
    rows = docs.selectExpr(f"cast(`{id_col}` as bigint) as doc_id", f"cast(`{text_col}` as string) as text")
    long = F.coalesce(F.octet_length("text") > LONG, F.lit(False))
    short = rows.filter(~long).mapInArrow(partial(_short, path_a=path_a, path_b=path_b), BLOCK)
    blocks = staged(short.unionAll(_long(rows.filter(long), path_a, path_b)), "blocks")
    asked = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "holders")).alias("at", "p"))
    asked = asked.select("block", "at", F.col("p.pairs").alias("pair"), F.col("p.holders").alias("n"))
    counts = asked.groupBy("pair").agg(F.sum("n").alias("count")).withColumn("a", F.shiftright("pair", 32))
    # an A id's window holds at most one row per B id
    highest = F.max("count").over(Window.partitionBy("a"))
    counts = counts.withColumn("best", (F.col("count") == highest).cast("bigint")).select("pair", "count", "best")
    found = asked.select("block", "at", "pair").join(counts, "pair").select(F.col("block").alias("of"), F.col("at").cast("bigint").alias("at"), "count", "best")
    return blocks.groupBy("block").cogroup(found.groupBy("of")).applyInArrow(_answer, ANSWER)
