import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketloom.functions import dates, text, variant, vectors


def test_ticker_grammar(one):
    values = ["  aapl  ", "brk.b", "brk-b", "", "../AAPL", "AAPL?key=value", "TOO-LONG-SUFFIX", "123", None, "AAPL\n", "ABCDEF", "A.BC1"]
    assert one(text.normalize_ticker, values) == ["AAPL", "BRK.B", "BRK-B", None, None, None, None, None, None, "AAPL", None, None]


def test_email(one):
    values = [" User@Example.com ", "not an email", "a@b@c", "@x", "x@", "a b@c", None, "a b@c", " a@b　"]
    assert one(text.normalize_email, values) == ["user@example.com", None, None, None, None, None, None, None, "a@b"]


def test_white_space_is_unicode_aware(one):
    values = ["  alpha\n\tbeta   gamma ", None, "a b\u0085c d　e\u001cf", "   "]
    assert one(text.collapse_ws, values) == ["alpha beta gamma", "", "a b c d e f", ""]
    assert one(text.trim_ws, ["　 x y \u001f"]) == ["x y"]


def test_bounded_text_keeps_inner_white_space(one):
    assert one(lambda c: text.bounded_text(c, 40), ["  First line\n  second line  ", None, " \t", "x" * 41]) == [
        "First line\n  second line", None, None, None,
    ]
    assert one(lambda c: text.bounded_text_error(text.trim_ws(c), "Note", 3), ["abc", " ", None, "abcd"]) == [
        None, "Note cannot be blank.", "Note cannot be blank.", "Note must be at most 3 characters.",
    ]


def test_limits_reject_and_top_k_clamps(one):
    assert one(lambda c: text.bounded_limit(c, 100), [0, 1, 100, 101, None], "int") == [None, 1, 100, None, None]
    assert one(text.top_k, [0, 1, 100], "int") == [None, 1, 20]


def test_iso_dates_and_zones(one):
    assert one(text.iso_date, ["2020-01-02", "20200102", "2020-02-30", "x", None]) == [
        dt.date(2020, 1, 2), dt.date(2020, 1, 2), None, None, None,
    ]
    got = one(lambda c: text.iso_timestamp(c).cast("string"), ["2024-01-02T03:04:05Z", "2024-01-02T03:04:05+02:00", "2024-01-02T03:04:05", "bad"])
    assert got == ["2024-01-02 03:04:05", "2024-01-02 01:04:05", None, None]


@pytest.mark.parametrize(
    ("url", "usable"),
    [
        ("https://x.example/a?b", True), ("HTTP://host_name:80", True), ("http://[::1]/x", True), ("  https://x  ", True),
        ("ftp://x/", False), ("https://u:p@x/", False), ("https:///x", False), ("x", False), (None, False), ("\t", False),
        ("https://x/a@b", True),
    ],
)
def test_usable_urls(one, url, usable):
    assert one(text.is_usable_url, [url]) == [usable]


def test_https_base_and_origin(one, spark):
    values = [" https://x.example/api// ", "https://x/?q=1", "https://x/#f", "http://x", "https://u@x", "https://x?"]
    assert one(text.https_base_url, values) == ["https://x.example/api", None, None, None, None, "https://x?"]
    df = spark.createDataFrame([("https://A.b/x", "https://a.b:8/y"), ("http://a", "https://a"), ("x", "x")], "a string, b string")
    assert [r[0] for r in df.select(text.same_origin(F.col("a"), F.col("b"))).collect()] == [True, False, False]


def test_spaces_only_test_differs_from_normalizing(one):
    assert one(text.non_blank_spaces, ["\t", " ", None, "x"]) == [True, False, False, True]


def test_metadata_fallback(spark):
    rows = [("T\n x", " D "), ("T", None), (" ", None), (None, "D")]
    df = spark.createDataFrame(rows, "t string, d string")
    got = [r[0] for r in df.select(text.metadata_fallback(F.col("t"), F.col("d"))).collect()]
    assert got == ["Title: T x\n\nDescription: D", "Title: T", None, "Description: D"]


def test_redaction(one):
    values = [
        "Authorization: Bearer oauth-token-secret p_embedding=[0.1,0.2] payload={private} real[]",
        "see HTTPS://x.y/z?a=1, postgresql://h/db (http://q)", "password : hunter2; oauth_token=abc, Secret x",
        "{a {b {c}}}", "mytoken x token", "x" * 700, " \n ", None,
    ]
    assert one(text.redact, values) == [
        "Authorization: Bearer [redacted] p_embedding=[redacted-array] payload=[redacted-object] real[]",
        "see [redacted-url] [redacted-url] ([redacted-url])", "password : [redacted]; oauth_token=[redacted], Secret [redacted]",
        "[redacted-object]", "mytoken x token", "x" * 500, None, None,
    ]


def test_safe_tokens(one):
    assert one(text.safe_code, [" AB.1-x ", "bad code", "x" * 33]) == ["AB.1-x", None, None]
    assert one(text.safe_content_type, ["text/html;  charset=utf-8", None, "a|b"]) == ["text/html; charset=utf-8", "unknown", "unknown"]
    many = "{" + ",".join(f'"k{i:02d}":1' for i in range(12)) + ',"bad key":1}'
    assert one(text.safe_json_keys, [many, "[1]", "x"]) == [[f"k{i:02d}" for i in range(10)], [], []]


def test_display_values(one):
    assert one(text.compact_money, [1.0, 872.13, 999.999, 999999.0, 1234.0, 3e12, -4560000.0, 100.0, None], "double") == [
        "$1", "$872.13", "$1K", "$1M", "$1.23K", "$3T", "-$4.56M", "$100", None,
    ]
    assert one(text.display_number, [1234.5, 10.0], "double") == ["1,234.5", "10"]
    assert one(text.card_preview, ["x" * 280, "x" * 281]) == ["x" * 280, "x" * 277 + "…"]
    assert one(text.percent_label, [0.875, None, float("nan")], "double") == ["88% similarity", "Similarity unavailable", "Similarity unavailable"]


def test_market_dates(one):
    assert one(dates.market_date, [1577941200000, 1577939999999], "long") == [dt.date(2020, 1, 2), dt.date(2020, 1, 1)]
    start, end = (one(lambda c, i=i: dates.price_window(c)[i], [dt.date(2026, 8, 9), dt.date(2026, 8, 10), dt.date(2026, 8, 12)], "date") for i in (0, 1))
    assert end == [dt.date(2026, 8, 7), dt.date(2026, 8, 7), dt.date(2026, 8, 11)]
    assert start[0] == dt.date(2026, 7, 28)


def test_vectors(one, spark):
    assert one(vectors.similarity, [0.25, -1.0, 3.0, float("inf"), float("nan")], "double") == [0.75, 1.0, -1.0, None, None]
    good = [0.5] * 384
    got = one(vectors.is_valid_vector, [good, good[1:], good + [0.1], good[1:] + [float("inf")], None], "array<double>")
    assert got == [True, False, False, False, False]
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 2.0]), ([1.0, 1.0], [2.0, 2.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    assert [r[0] for r in df.select(vectors.cosine_distance(F.col("a"), F.col("b"))).collect()] == [1.0, 0.0, None]
    assert one(lambda c: vectors.parse_vector(vectors.vector_text(c)), [[0.1, -1e-9, 3.0]], "array<double>") == [[0.1, -1e-9, 3.0]]


def test_canonical_json(one):
    assert one(variant.canonical_json, ['{"b": 1, "a": {"d": null, "c": "é"}}', "[1]", "oops", None]) == ['{"a":{"c":"é","d":null},"b":1}', "{}", "{}", "{}"]
