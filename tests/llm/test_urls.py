"""URL filters against a plain rule list and rules counted over all token combinations."""

import random
from itertools import combinations

from pyspark.sql import functions as F

from marketloom.llm import urls as U
from marketloom.llm.queries import URL_RULES

ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG", "http://example.org/es/", "http://a.example.org/es/x?y#z", "http://xexample.org/es/",
    "http://example.org/en/1", "http://example.org/en/19", "http://example.org/en/2", "http://org", "http://org/", "http://x.org?a=/es/", "http://a.COM/fr/1",
    "http://a.com/FR/1", "https://com/de/", "x://y://z.com/de/1", "http://a.net/" + "b/" * 200_000, "http://b.com/de\n/1", "http://İ.org/ı", "http://a.com#/fr/",
]


def plain(url):
    """(host, path, rule, verdict)"""
    head, sign, rest = (url or "").partition("://")
    if not sign:
        return "", "", None, None
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:].split("?")[0].split("#")[0]
    fits = []
    for verdict, rule in URL_RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            fits.append((len(rule), rule, verdict))
    return host, path, *(max(fits)[1:] if fits else (None, None))


def test_listed_rules(spark):
    rows = [(i, u) for i, u in enumerate(ODD + ODD[:3])]
    pages = spark.createDataFrame(rows, "page_id bigint, url string").withColumns({c: F.lit("x") for c in ("rule", "Host", "tokens", "label")})
    out = U.judge(pages, URL_RULES)
    assert out.columns == ["page_id", "url", "tokens", "label", *U.OUT]
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in out.collect()} == {i: plain(u) for i, u in rows}
    filled = U.filter_urls(pages, URL_RULES).collect()
    assert {r.page_id: (r.host, r.path, r.rule) for r in filled} == {i: plain(u)[:3] for i, u in rows}
    assert {r.verdict for r in filled} <= {"allow", "block"}
    assert U.filter_urls(pages.limit(0), URL_RULES).count() == 0


def test_mined_rules_are_all_sure_combinations(spark):
    rng = random.Random(4)
    rows = []
    for _ in range(1500):
        a, b, c = rng.choice("pqr"), rng.choice("xyz"), rng.choice(["1", "22"])
        toxic = (a == "p" and b == "x") or (b == "z" and rng.random() < 0.95)
        rows.append((f"http://{a}.site.{rng.choice(['com', 'net'])}/{b}/{c}.html", "block" if toxic else "allow"))
    rows += [(None, "block"), ("http://p.site.com/x/1", None), ("http://p.site.com/x/1", "other")]
    table = spark.createDataFrame(rows, "url string, label string")
    sets = [(set(r.t), r.label) for r in table.filter("url is not null and label in ('allow', 'block')").select(U.tokens(F.col("url")).alias("t"), "label").collect()]
    common = {x for s, _ in sets for x in s}
    common = {x for x in common if sum(x in s for s, _ in sets) <= 0.95 * len(sets)}
    sure = {}
    for n in (1, 2, 3):
        for items in combinations(sorted(common), n):
            labels = [y for s, y in sets if s.issuperset(items)]
            for y in ("allow", "block"):
                k = labels.count(y)
                if k >= 0.01 * len(sets) and k / len(labels) >= 0.9:
                    sure[items, y] = k / len(labels)
    want = {
        (items, y) for (items, y), p in sure.items()
        if not any(sure.get((part, y), 0) >= p for n in range(1, len(items)) for part in combinations(items, n))
    }
    mined = U.mine(table, support=0.01)
    assert {(items, y) for items, y, *_ in mined.rules} == want and want
    assert all(abs(p - sure[items, y]) < 1e-12 for items, y, p, _ in mined.rules)
    assert [p for *_, p, _ in mined.rules] == sorted((p for *_, p, _ in mined.rules), reverse=True)
    # an unseen page is judged by the rules' tokens
    seen = U.judge(spark.createDataFrame([("http://p.other.org/x/9",), ("http://q.other.org/y/9",), ("?",)], "url string"), [], mined).collect()
    assert [r.verdict for r in seen] == ["block", "allow", mined.default] and seen[2].mined is None
    assert U.mine(table.limit(0)).rules == []


def test_no_frequent_token_and_no_rule_is_left_out(spark):
    """Rows of over twenty frequent tokens, the telling ones the rarest; and more tokens and rules than any fixed number."""
    rng = random.Random(7)
    words = [f"w{x}{y}" for x in "abcde" for y in "fghij"]
    rows = []
    for i in range(600):
        told = [["zz"], ["yy", "xx"], ["yy"], ["xx"], []][min(i % 50, 4)]
        rows.append(("http://a.com/" + "/".join([*rng.sample(words, 19), *told]), "block" if "zz" in told or len(told) == 2 else "allow"))
    table = spark.createDataFrame(rows, "url string, label string")
    sets = [(set(r.t), r.label) for r in table.select(U.tokens(F.col("url")).alias("t"), "label").collect()]
    counts = U.Counter(x for s, _ in sets for x in s)
    common = sorted(x for x, n in counts.items() if 10 <= n <= 0.95 * len(sets))
    sure = {}
    for n in (1, 2, 3):
        held = U.Counter()
        for s, y in sets:
            held.update((c, y) for c in combinations([x for x in common if x in s], n))
        for (items, y), k in held.items():
            whole = k + held[items, "block" if y == "allow" else "allow"]
            if k >= 10 and k / whole >= 0.9:
                sure[items, y] = k / whole
    want = {
        (items, y) for (items, y), p in sure.items()
        if not any(sure.get((part, y), 0) >= p for n in range(1, len(items)) for part in combinations(items, n))
    }
    mined = U.mine(table)
    assert {(("p:zz",), "block"), (("p:xx", "p:yy"), "block")} <= want
    assert len(mined.rules) == len(want) and {(items, y) for items, y, *_ in mined.rules} == want
    assert all(abs(p - sure[items, y]) < 1e-12 for items, y, p, _ in mined.rules)

    names = ["".join("abcdefghij"[int(x)] for x in f"{i:04}") for i in range(1100)]
    rows = [(f"http://{'bd'[i % 2]}.com/{name}/{j}", "block" if i % 3 else "allow") for i, name in enumerate(names) for j in range(10)]
    mined = U.mine(spark.createDataFrame(rows, "url string, label string"), support=0.0009)
    assert {(("p:" + name,), "block" if i % 3 else "allow") for i, name in enumerate(names)} <= {(items, y) for items, y, *_ in mined.rules}
    assert all(mined.judge({"p:" + name})[0] == ("block" if i % 3 else "allow") for i, name in enumerate(names))
