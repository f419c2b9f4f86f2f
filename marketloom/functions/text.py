"""Text, URL and identifier columns.

Java's ``\\s`` knows ASCII white space only, so the class below spells out the Unicode
white space that user text is trimmed and collapsed by.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white-space code points, as a trim set and as a regex class.
WS_RANGES = (
    (0x09, 0x0D), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
)
WS_CHARS = "".join(chr(p) for first, last in WS_RANGES for p in range(first, last + 1))
_WS = "".join(f"\\x{{{first:x}}}-\\x{{{last:x}}}" for first, last in WS_RANGES)
WS_CLASS = f"[{_WS}]"

# Identifier grammar and bounds.
TICKER_PATTERN = r"\A[A-Z][A-Z0-9]{0,4}([.-][A-Z0-9]{1,2})?\z"
SAFE_TOKEN_PATTERN = r"\A[A-Za-z0-9_.-]{1,32}\z"
CONTENT_TYPE_PATTERN = r"\A[A-Za-z0-9!#$&^_.+*/;= -]+\z"
MAX_TOP_K = 20
MAX_LIMIT = 100

# URL shapes: host[:port] without user info, and the (scheme, host) of any URL.
_HOST = r"(?:\[[^\]/?#@]*\]|[^/?#@:\[\]]+)"
_CLEAN_AUTHORITY = rf"{_HOST}(?::[^/?#@]*)?"
ORIGIN_PATTERN = rf"\A([a-z][a-z0-9+.-]*)://(?:[^/?#]*@)?({_HOST})"

# Redaction rules as (pattern, replacement), applied in order after white space
# is collapsed. Group 1 is the character before the word (a Unicode-aware word boundary).
REDACTION_RULES = (
    (r"(?i)(^|[^\p{L}\p{N}_])(?:https?|postgres(?:ql)?)://[^\s<>()]+", "$1[redacted-url]"),
    (r"(?i)(^|[^\p{L}\p{N}_])Bearer\s+[^\s,;)\]}]+", "$1Bearer [redacted]"),
    (
        r"(?i)(^|[^\p{L}\p{N}_])(oauth(?:[_ -]?(?:token|secret))?|token|password|secret)"
        r"(\s*(?:[:=]\s*|\s+))[^\s,;)\]}]+",
        "$1$2$3[redacted]",
    ),
    # nested objects: the innermost braces first, five levels
    *(((r"\{[^{}]*\}", "[redacted-object]"),) * 5),
    (r"\[[^\]\r\n]*\p{Nd}[^\]\r\n]*\]", "[redacted-array]"),
)
REDACTED_LENGTH = 500


def trim_ws(c: Column) -> Column:
    return F.btrim(c, F.lit(WS_CHARS))


def blank_to_null(c: Column) -> Column:
    return F.nullif(trim_ws(c), F.lit(""))


def collapse_ws(c: Column) -> Column:
    """Every run of white space becomes one space, ends trimmed, NULL becomes ''."""
    return F.coalesce(F.btrim(F.regexp_replace(c, WS_CLASS + "+", " "), F.lit(" ")), F.lit(""))


def _whole_match(c: Column, pattern: str) -> Column:
    """The text itself where the pattern matches all of it, else NULL (one evaluation of ``c``)."""
    return F.nullif(F.regexp_extract(c, pattern, 0), F.lit(""))


def ticker_or_blank(c: Column) -> Column:
    """Upper-cased ticker, '' where the text is not a ticker (one evaluation, also in lambdas)."""
    return F.regexp_extract(F.upper(trim_ws(c)), TICKER_PATTERN, 0)


def normalize_ticker(c: Column) -> Column:
    """Upper-cased ticker, NULL where the text is not a ticker."""
    return _filled(ticker_or_blank(c))


def normalize_email(c: Column) -> Column:
    """Lower-cased address with exactly one @ and no white space, else NULL."""
    part = rf"[^@{_WS}]+"
    return _whole_match(F.lower(trim_ws(c)), rf"\A{part}@{part}\z")


def bounded_text(c: Column, maximum: int) -> Column:
    """Text trimmed at its ends; NULL where blank or longer than ``maximum`` characters."""
    t = blank_to_null(c)
    return F.when(F.length(t) <= maximum, t)


def bounded_text_error(trimmed: Column, field: str, maximum: int) -> Column:
    """Why a trimmed text is refused, NULL where it is not."""
    length = F.coalesce(F.length(trimmed), F.lit(0))
    return F.when(length == 0, F.lit(f"{field} cannot be blank.")).when(
        length > maximum, F.lit(f"{field} must be at most {maximum} characters.")
    )


def bounded_limit(c: Column, maximum: int = MAX_LIMIT) -> Column:
    """An integer limit is rejected (NULL), not clamped, outside 1..maximum."""
    return F.when(c.between(1, maximum), c)


def top_k(c: Column) -> Column:
    """A positive result count is clamped to the search bound; anything else is NULL."""
    return F.when(c >= 1, F.least(c, F.lit(MAX_TOP_K)))


def question_text(c: Column) -> Column:
    return _filled(collapse_ws(c))


def _filled(c: Column) -> Column:
    """NULL for '', with one evaluation of ``c``."""
    return F.get(F.filter(F.array(c), lambda t: t != ""), 0)


def iso_date(c: Column) -> Column:
    t = F.when(c.rlike(r"\A\d{4}-\d{2}-\d{2}\z"), c).when(
        c.rlike(r"\A\d{8}\z"), F.regexp_replace(c, r"\A(\d{4})(\d{2})(\d{2})\z", "$1-$2-$3")
    )
    return t.try_cast("date")


def iso_timestamp(c: Column) -> Column:
    """ISO timestamp that carries a zone; NULL where it is malformed or has none."""
    t = F.replace(c, F.lit("Z"), F.lit("+00:00"))
    zoned = t.rlike(r"\A\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,6})?)?[+-]\d{2}:\d{2}\z")
    return F.when(zoned, t.try_cast("timestamp"))


def non_blank_spaces(c: Column) -> Column:
    """The work-selection test: only U+0020 counts as blank here."""
    return F.length(F.trim(F.coalesce(c, F.lit("")))) > 0


def is_http_url(c: Column) -> Column:
    return F.coalesce(c.rlike(r"\A(?i:https?):"), F.lit(False))


def is_usable_url(c: Column) -> Column:
    """http(s) with a host and without a user or password."""
    return F.coalesce(collapse_ws(c).rlike(rf"\A(?i:https?)://{_CLEAN_AUTHORITY}(?:[/?#]|\z)"), F.lit(False))


def https_base_url(c: Column) -> Column:
    """Credential-free https base without query or fragment, trailing slashes stripped, else NULL."""
    stripped = F.regexp_replace(trim_ws(c), r"/+\z", "")
    return _whole_match(stripped, rf"\A(?i:https)://{_CLEAN_AUTHORITY}(?:/[^?#]*)?\??#?\z")


def same_origin(a: Column, b: Column) -> Column:
    """Same scheme and host, whatever the case, user or port."""

    def origin(c: Column) -> Column:
        return _whole_match(F.lower(c), ORIGIN_PATTERN)

    def site(c: Column) -> Column:
        return F.concat(*[F.regexp_extract(F.lower(c), ORIGIN_PATTERN, g) for g in (1, 2)])

    return F.coalesce(origin(a).isNotNull() & (site(a) == site(b)), F.lit(False))


def metadata_fallback(title: Column, description: Column) -> Column:
    """``Title: ...`` and ``Description: ...`` sections that are not blank; NULL when both are."""

    def section(label: str, c: Column) -> Column:
        t = collapse_ws(c)
        return F.when(t != "", F.concat(F.lit(f"{label}: "), t))

    return F.nullif(
        F.concat_ws("\n\n", section("Title", title), section("Description", description)), F.lit("")
    )


def redact(c: Column) -> Column:
    """URLs, secrets, objects and numeric arrays masked, then cut; blank text becomes NULL."""
    t = F.nullif(collapse_ws(c), F.lit(""))
    for pattern, replacement in REDACTION_RULES:
        t = F.regexp_replace(t, pattern, replacement)
    return F.left(t, F.lit(REDACTED_LENGTH))


def safe_code(c: Column) -> Column:
    t = trim_ws(c)
    return F.when(t.rlike(SAFE_TOKEN_PATTERN), t)


def safe_content_type(c: Column) -> Column:
    t = F.left(collapse_ws(c), F.lit(100))
    return F.when(t.rlike(CONTENT_TYPE_PATTERN), t).otherwise(F.lit("unknown"))


def safe_json_keys(c: Column) -> Column:
    """Up to ten safe top-level keys of a JSON object, sorted; empty array for anything else."""
    keys = F.filter(F.json_object_keys(c), lambda k: k.rlike(SAFE_TOKEN_PATTERN))
    return F.coalesce(F.slice(F.array_sort(keys), 1, 10), F.array().cast("array<string>"))


def preview_line(c: Column, length: int = 160) -> Column:
    return F.left(collapse_ws(c), F.lit(length))


def card_preview(c: Column) -> Column:
    """Passages over 280 characters are shown as their first 277 and an ellipsis."""
    return F.when(F.length(c) > 280, F.concat(F.left(c, F.lit(277)), F.lit("…"))).otherwise(c)


def display_number(c: Column) -> Column:
    """Grouped digits, at most two decimals."""
    return F.call_function("format_number", F.round(c.cast("decimal(30,6)"), 2), F.lit("#,##0.##"))


def compact_money(c: Column) -> Column:
    """$1.23K / M / B / T with at most two decimals."""
    v = c.cast("decimal(30,6)")
    size = F.abs(v)

    def shown(power: int, suffix: str) -> Column:
        scaled = F.round(size / F.lit(10**power).cast("decimal(14,0)"), 2)
        text = F.regexp_replace(scaled.cast("decimal(30,2)").cast("string"), r"\.?0+\z", "")
        return F.concat(F.when(v < 0, F.lit("-$")).otherwise(F.lit("$")), text, F.lit(suffix))

    # a value that rounds up to the next thousand is shown in the next unit
    return (
        F.when(size < F.lit("999.995").cast("decimal(30,6)"), shown(0, ""))
        .when(size < F.lit("999995").cast("decimal(30,6)"), shown(3, "K"))
        .when(size < F.lit("999995000").cast("decimal(30,6)"), shown(6, "M"))
        .when(size < F.lit("999995000000").cast("decimal(30,6)"), shown(9, "B"))
        .when(size.isNotNull(), shown(12, "T"))
    )


def percent_label(similarity: Column) -> Column:
    return F.when(
        similarity.isNull() | F.isnan(similarity), F.lit("Similarity unavailable")
    ).otherwise(F.concat(F.floor(similarity * 100 + 0.5).cast("string"), F.lit("% similarity")))


def display_date(c: Column) -> Column:
    return F.coalesce(F.date_format(c, "MMM d, yyyy"), F.lit("Date unavailable"))
