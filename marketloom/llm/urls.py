"""URL filters: listed host and path rules first, then association rules mined by FP-growth from labelled URLs."""

from __future__ import annotations

import math
import string
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import partial, reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marketloom.llm.common import staged

SUPPORT, CONFIDENCE = 0.005, 0.9  # of a mined rule: share of labelled rows, and of those with its tokens
ROWS = 10  # labelled rows a mined rule holds in at least
ITEMS = 16  # frequent tokens in one labelled row up to which all their combinations are grown, of any length
LENGTH = 3  # most tokens in a mined rule
EVERYWHERE = 0.95  # tokens in a larger share of the labelled rows say nothing and aren't mined
LISTED = 100_000  # most listed rules
ALLOW, BLOCK = "allow", "block"
OUT = ("host", "path", "rule", "verdict", "mined", "confidence")


def _rest(url: Column) -> Column:
    """What follows the first "://"; null without one."""
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host(url: Column) -> Column:
    """A-Z lower-cased, up to the first "/", "?" or "#"; empty where there is no "://"."""
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path(url: Column) -> Column:
    """From the host's end up to the first "?" or "#"; empty where there is no "://"."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def tokens(url: Column) -> Column:
    """Distinct tokens of a URL: h: labels of the host, t: the last of them, p: and s: words and depth of the path, x: the
    extension, q: names of parameters. Words are lower-cased, and digits in a path word become one "0"."""
    labels = F.filter(F.split(host(url), r"\."), lambda x: x != "")
    whole = F.lower(path(url))
    steps = F.filter(F.split(whole, "/"), lambda x: x != "")
    query = F.regexp_extract(_rest(url), r"^[^?#]*\?([^#]*)", 1)
    names = F.filter(F.transform(F.split(query, "&"), lambda x: F.split(x, "=")[0]), lambda x: x != "")
    extension = F.regexp_extract(whole, r"\.([a-z0-9]{1,5})$", 1)
    parts = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("h:"), x)),
        F.transform(F.slice(F.reverse(labels), 1, 1), lambda x: F.concat(F.lit("t:"), x)),
        F.transform(steps, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0"))),
        F.array(F.concat(F.lit("s:"), F.size(steps))),
        F.when(extension != "", F.array(F.concat(F.lit("x:"), extension))).otherwise(F.array().cast("array<string>")),
        F.transform(names, lambda x: F.concat(F.lit("q:"), F.lower(x))),
    )
    return F.when(_rest(url).isNull(), F.array().cast("array<string>")).otherwise(F.array_distinct(parts))


@dataclass
class Mined:
    """Mined rules, the surest first: (tokens, verdict, confidence, support)."""

    rules: list[tuple[tuple[str, ...], str, float, float]]
    default: str = ALLOW
    index: dict[str, list[int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        uses = Counter(item for items, *_ in self.rules for item in items)
        for i, (items, *_) in enumerate(self.rules):  # each under its rarest token
            self.index.setdefault(min(items, key=lambda x: (uses[x], x)), []).append(i)

    def judge(self, found: Iterable[str]) -> tuple[str, str | None, float | None]:
        """The first rule all of whose tokens are found: its verdict, its text and its confidence."""
        found = set(found)
        best = len(self.rules)
        for item in found:
            for i in self.index.get(item, ()):
                if i >= best:
                    break
                if found.issuperset(self.rules[i][0]):
                    best = i
        if best == len(self.rules):
            return self.default, None, None
        items, verdict, confidence, _ = self.rules[best]
        return verdict, " ".join(items), confidence


def mine(
    labelled: DataFrame, support: float = SUPPORT, confidence: float = CONFIDENCE, url_col: str = "url", label_col: str = "label"
) -> Mined:
    """Rules "tokens => label" of labelled(url, label), label being allow or block; other labels and null URLs are left out.

    FP-growth covers all labelled rows and all tokens of them that are frequent enough and not everywhere, so the support
    alone bounds the model, whatever the table's size: a row counts for at most its combinations of up to LENGTH tokens. A rule goes if
    one with fewer of the same tokens and the same label is at least as sure. Without rules every URL gets the more frequent label.
    """
    rows = labelled.select(F.col(url_col).alias("url"), F.col(label_col).alias("label"))
    rows = rows.filter(F.col("label").isin(ALLOW, BLOCK) & F.col("url").isNotNull())
    rows = staged(rows.select(tokens(F.col("url")).alias("tokens"), "label"), "labelled")
    sizes = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(sizes.values())
    support = max(support, ROWS / max(total, 1))
    default = BLOCK if sizes.get(BLOCK, 0) > sizes.get(ALLOW, 0) else ALLOW
    counts = rows.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    # at most 1 / support of a row's tokens on average
    names = [r["token"] for r in counts.filter(F.col("n").between(support * total, EVERYWHERE * total)).collect()]
    if not names or support > 1:
        return Mined([], default)
    rows = rows.select(F.array_sort(F.filter("tokens", lambda x: x.isin(names))).alias("items"), "label")
    widest = rows.agg(F.max(F.size("items"))).first()[0]
    grown = _grown(rows, support, confidence) if widest <= ITEMS else _grown_to_length(rows, support, total)
    found = staged(grown.filter(F.col("confidence") >= confidence), "rules")
    fewer = found.select(F.explode(_subsets(F.col("items"))).alias("part"), "items", "label", "confidence")
    known = found.select(F.col("items").alias("part"), "label", F.col("confidence").alias("sure"))
    weaker = fewer.join(known, ["part", "label"]).filter("sure >= confidence").select("items", "label")
    kept = found.join(weaker, ["items", "label"], "left_anti")
    order = [F.desc("confidence"), F.desc("support"), F.size("items"), F.col("items"), F.col("label")]
    rules = kept.orderBy(*order).collect()
    return Mined([(tuple(r["items"]), r["label"], r["confidence"], r["support"]) for r in rules], default)


def _grown(rows: DataFrame, support: float, confidence: float) -> DataFrame:
    """(items, label, confidence, support) of rows(items, label), from all frequent combinations."""
    parts = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    baskets = rows.select(F.concat("items", F.array(F.concat(F.lit("="), F.col("label")))).alias("items"))
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=confidence, numPartitions=parts).fit(baskets)
    return model.associationRules.filter(
        F.col("consequent")[0].isin("=" + ALLOW, "=" + BLOCK) & (F.size("antecedent") <= LENGTH)
        & ~F.exists("antecedent", lambda x: x.startswith("="))
    ).select(F.array_sort("antecedent").alias("items"), F.substring(F.col("consequent")[0], 2, 10).alias("label"), "confidence", "support")


def _grown_to_length(rows: DataFrame, support: float, total: int) -> DataFrame:
    """The same, growing combinations no longer than LENGTH, for rows of so many tokens that those of any length are too many.

    A combination's pattern base is what follows it in the rows that hold it, equal ones once with their counts. Each step
    grows the combinations that are frequent with a label by one token of their base.
    """
    least = math.ceil(support * total)
    labels = [ALLOW, BLOCK]
    base = rows.groupBy(F.array().cast("array<string>").alias("items"), F.col("items").alias("rest")).agg(
        *[F.count_if(F.col("label") == x).alias(x) for x in labels]
    )
    levels = []
    for length in range(1, LENGTH + 1):
        longer = base.select("items", F.posexplode("rest").alias("at", "token"), "rest", *labels).select(
            F.array_append("items", F.col("token")).alias("items"), F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"), *labels
        )
        if length < LENGTH:
            longer = staged(longer.groupBy("items", "rest").agg(*[F.sum(x).alias(x) for x in labels]), "bases")
        counted = longer.groupBy("items").agg(*[F.sum(x).alias(x) for x in labels])
        counted = staged(counted.filter(F.greatest(*labels) >= least), "counted")
        levels.append(counted)
        base = longer.filter(F.size("rest") > 0).join(counted.select("items"), "items", "left_semi")
    every = reduce(DataFrame.unionAll, levels)
    whole = F.col(ALLOW) + F.col(BLOCK)
    sides = F.explode(F.array(*[F.struct(F.lit(x).alias("label"), F.col(x).alias("n")) for x in labels]))
    return every.select("items", whole.alias("whole"), sides.alias("_s")).filter(F.col("_s.n") >= least).select(
        "items", "_s.label", (F.col("_s.n") / F.col("whole")).alias("confidence"), (F.col("_s.n") / total).alias("support")
    )


def _subsets(items: Column) -> Column:
    """Non-empty proper subsets of at most LENGTH tokens, as arrays."""
    n = F.size(items)
    masks = F.sequence(F.lit(1), F.greatest(F.lit(1), F.pow(F.lit(2), n).cast("int") - 2))
    picked = F.transform(masks, lambda m: F.filter(items, lambda x, i: F.getbit(m, i) == 1))
    return F.filter(picked, lambda x: (F.size(x) > 0) & (F.size(x) < n))


class Listed:
    """Listed rules by host; a rule fits its host, all subdomains of it, and paths that start with its own."""

    def __init__(self, rules: Iterable[tuple[str, str]]) -> None:
        self.hosts: dict[str, list[tuple[str, str]]] = {}
        for n, (verdict, rule) in enumerate(rules):
            if n >= LISTED:
                raise ValueError(f"At most {LISTED} rules can be listed.")
            if verdict not in (ALLOW, BLOCK) or not rule.partition("/")[1]:
                raise ValueError(f"Not a rule: {verdict} {rule}")
            name, _, rest = rule.partition("/")
            self.hosts.setdefault(name, []).append(("/" + rest, verdict))

    def judge(self, name: str, where: str) -> tuple[str | None, str | None]:
        """(rule, verdict) of the longest rule that fits; of equally long ones that with the longer host, then the first."""
        best: tuple[int, str, str] | None = None
        suffix = name
        while suffix:
            for start, verdict in self.hosts.get(suffix, ()):
                if where.startswith(start) and (best is None or len(suffix) + len(start) > best[0]):
                    best = len(suffix) + len(start), suffix + start, verdict
            suffix = suffix.partition(".")[2]
        return best[1:] if best else (None, None)


def _judge(batches: Iterator[pa.RecordBatch], listed: Listed, mined: Mined | None, names: list[str], keep: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hosts, paths, found = (batch.column(keep + i).to_pylist() for i in range(3))
        rows = []
        for name, where, items in zip(hosts, paths, found):
            rule, verdict = listed.judge(name, where)
            text = sure = None
            if rule is None and mined is not None:
                verdict, text, sure = mined.judge(items)
            rows.append((rule, verdict, text, sure))
        columns = list(zip(*rows)) or [()] * 4
        out = [pa.array(c, pa.float64() if i == 3 else pa.string()) for i, c in enumerate(columns)]
        yield pa.RecordBatch.from_arrays([*batch.columns[: keep + 2], *out], names)


def judge(pages: DataFrame, rules: Iterable[tuple[str, str]], mined: Mined | None = None, url_col: str = "url") -> DataFrame:
    """``pages`` and host, path, rule, verdict, mined, confidence: the longest listed rule that fits, or null, and its verdict;
    else the verdict, text and confidence of the first mined rule (null without ``mined``).

    Columns of these names are replaced. Null URLs and those without "://" have an empty host and path, no tokens, and so the
    mined default. Rows are neither merged nor dropped, and nothing is shuffled; very long URLs are only cut into tokens.
    """
    pages = pages.drop(*[c for c in pages.columns if c.lower() in OUT and c != url_col])
    kept = [F.col(f"`{c}`") for c in pages.columns]
    url = F.col(f"`{url_col}`").cast("string")
    free = "_" * (1 + max((len(c) for c in pages.columns), default=0))  # no column's name begins like this
    rows = pages.select(*kept, *[f(url).alias(free + f.__name__) for f in (host, path, tokens)])
    fields = [StructField(c, DoubleType() if c == "confidence" else StringType()) for c in OUT]
    run = partial(_judge, listed=Listed(rules), mined=mined, names=[*pages.columns, *OUT], keep=len(pages.columns))
    return rows.mapInArrow(run, StructType([*pages.schema.fields, *fields]))


def filter_urls(pages: DataFrame, rules: Iterable[tuple[str, str]], url_col: str = "url", **limits: float) -> DataFrame:
    """``judge`` with rules mined from the pages that a listed rule decides: what the list says of them is their label,
    and the mined rules carry it over to the other pages."""
    rules = list(rules)
    labelled = judge(pages.select(url_col), rules, url_col=url_col).select(url_col, F.col("verdict").alias("label"))
    return judge(pages, rules, mine(labelled, url_col=url_col, **limits), url_col)
