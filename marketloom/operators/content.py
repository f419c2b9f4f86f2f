"""Article text: body extraction, fallback, word-aware chunks, and the incremental content job."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketloom.functions import text
from marketloom.operators.reads import newest_first
from marketloom.sources.versions import VersionedTable

# Chunk settings and the least body length.
CHUNK_SIZE = 1200
CHUNK_OVERLAP = 200
MINIMUM_CHARACTERS = 200
HELD_CHARACTERS = 1 << 20  # of texts whose chunks a Python worker holds before it hands them on

CHUNK_SCHEMA = T.StructType(
    [T.StructField("article_id", T.StringType()), T.StructField("chunk_index", T.IntegerType()), T.StructField("chunk_text", T.StringType())]
)
# rows of the chunk table that content runs append to
RUN_SCHEMA = T.StructType([*CHUNK_SCHEMA.fields, T.StructField("extraction_source", T.StringType())])

# Cut from the page before anything is looked for in it.
NOT_SHOWN = (r"(?s)<!--.*?(?:-->|\z)", r"(?is)<(script|style|noscript|template|head)\b[^>]*>.*?(?:</\1\s*>|\z)")
# The main body: all elements of the first kind that the page has; else its body; else the page.
MAIN_ELEMENTS = (r"(?is)<article\b[^>]*>(.*?)(?:</article\s*>|\z)", r"(?is)<main\b[^>]*>(.*?)(?:</main\s*>|\z)")
BODY_ELEMENT = r"(?is)<body\b[^>]*>(.*?)(?:</body\s*>|\z)"
# Cut from the main body; a page's header only where neither kind marks the main body.
PAGE_HEADER = r"(?is)<header\b[^>]*>.*?</header\s*>"
CUT_FROM_BODY = (
    r"(?is)<(nav|footer|aside|form|table)\b[^>]*>.*?</\1\s*>",
    r"(?is)<(div|section|p|span)\b[^>]*\b(?:class|id)\s*=\s*"
    r"""["'](?:[^"']*\s)?(?:ad|ads|advert|advertisement|promo|sponsored)(?:\s[^"']*)?["'][^>]*>.*?</\1\s*>""",
    r"<[^>]+>",
)


def _check_minimum(minimum: int) -> None:
    if isinstance(minimum, bool) or not isinstance(minimum, int) or minimum < 1:
        raise ValueError("minimum_characters must be a positive integer.")


@F.pandas_udf(T.StringType())
def _unescaped(s: pd.Series) -> pd.Series:
    return s.map(unescape, na_action="ignore")


def main_text(html: Column) -> Column:
    """Normalized main-body text of a page ('' when there is none): markup is cut by patterns in the JVM,
    then character references, named or numeric, are decoded in Arrow batches."""
    page = html
    for pattern in NOT_SHOWN:
        page = F.regexp_replace(page, pattern, " ")
    whole = F.regexp_replace(F.coalesce(F.nullif(F.regexp_extract(page, BODY_ELEMENT, 1), F.lit("")), page), PAGE_HEADER, " ")
    found = [F.array_join(F.regexp_extract_all(page, F.lit(pattern), 1), " ") for pattern in MAIN_ELEMENTS]
    body = F.coalesce(*[F.when(F.btrim(f) != "", f) for f in found], whole)
    for pattern in CUT_FROM_BODY:
        body = F.regexp_replace(body, pattern, " ")
    return text.collapse_ws(_unescaped(body))


def extract_articles(pages: DataFrame, minimum_characters: int = MINIMUM_CHARACTERS, extractor: Callable[..., str | None] | None = None) -> DataFrame:
    """Add ``body`` to pages(url, html, ...).

    A supplied ``extractor(html, url=..., output_format='txt', include_comments=False,
    include_tables=False)`` runs in Python workers instead; a page it fails on has no body.
    """
    _check_minimum(minimum_characters)
    enough = F.when(F.length("body") >= minimum_characters, F.col("body"))
    if extractor is None:
        return pages.withColumn("body", main_text(F.col("html"))).drop("html").withColumn("body", enough)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def one(html: str | None, url: str | None) -> str | None:
            if not isinstance(html, str) or not html.strip():
                return None
            try:
                return extractor(html, url=url, output_format="txt", include_comments=False, include_tables=False)
            except Exception:  # whatever a supplied extractor raises, the page has no body
                return None

        for batch in batches:
            batch["body"] = [one(h, u) for h, u in zip(batch["html"], batch["url"])]
            yield batch.drop(columns="html")

    raw = pages.mapInPandas(run, pages.drop("html").withColumn("body", F.lit(None).cast("string")).schema)
    return raw.withColumn("body", text.collapse_ws(F.col("body"))).withColumn("body", enough)


def resolve_content(articles: DataFrame, bodies: DataFrame) -> DataFrame:
    """articles + bodies(article_id, body) -> text to chunk and where it came from.

    The body counts only for a usable URL; else title and description stand in; an article with
    neither is dropped.
    """
    fallback = text.metadata_fallback(F.col("title"), F.col("description"))
    body = F.when(text.is_usable_url(F.col("article_url")), F.col("body"))
    joined = articles.join(bodies.select("article_id", "body"), "article_id", "left")
    return joined.select(
        "article_id",
        "title",
        "article_url",
        F.when(body.isNotNull(), F.lit("article_body")).otherwise("metadata_fallback").alias("extraction_source"),
        F.coalesce(body, fallback).alias("extracted_text"),
    ).filter("extracted_text IS NOT NULL")


def eligible_articles(articles: DataFrame, chunks: DataFrame) -> DataFrame:
    """Articles without chunks that have a URL or metadata to work with."""
    usable = (
        text.non_blank_spaces(F.col("article_url"))
        | text.non_blank_spaces(F.col("title"))
        | text.non_blank_spaces(F.col("description"))
    )
    return articles.filter(usable).join(chunks.select("article_id").distinct(), "article_id", "left_anti")


def newest_work(eligible: DataFrame, max_articles: int) -> DataFrame:
    """A bounded run: the newest articles first."""
    return eligible.orderBy(*newest_first()).limit(max_articles)


def unembedded_chunks(chunks: DataFrame) -> DataFrame:
    return chunks.filter(F.col("embedding").isNull()).select("article_id", "chunk_index", "chunk_text")


def next_chunks(unembedded: DataFrame, max_chunks: int) -> DataFrame:
    """A bounded run in (article_id, chunk_index) order."""
    return unembedded.orderBy("article_id", "chunk_index").limit(max_chunks)


# ---------------------------------------------------------------- chunks


def check_chunk_settings(size: int, overlap: int) -> None:
    for value in (size, overlap):
        if isinstance(value, bool) or not isinstance(value, int):
            raise ValueError("Chunk settings must be integers.")
    if size < 1 or not 0 <= overlap < size:
        raise ValueError("Chunk size must be positive and the overlap at least 0 and below it.")


def chunk_spans(normalized: str, size: int, overlap: int) -> list[tuple[int, int]]:
    """[start, end) of each chunk of white-space-normalized text.

    Chunks end at the last space in reach and start after a space inside the overlap; a stretch
    without spaces is cut mid-word. All breaks are looked up in the sorted space positions.
    """
    n = len(normalized)
    if n <= size:
        return [(0, n)] if n else []
    codes = np.frombuffer(normalized.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    spaces = np.flatnonzero(codes == 32)
    spans, start = [], 0
    while True:
        end = min(start + size, n)
        if end < n:
            last = int(np.searchsorted(spaces, end, side="right")) - 1
            if last >= 0 and spaces[last] > start + overlap + 1:
                end = int(spaces[last])
        spans.append((start, end))
        if end >= n:
            return spans
        follow = end - overlap
        if follow > 0 and codes[follow - 1] != 32:
            gap = int(np.searchsorted(spaces, follow))
            if gap < len(spaces) and spaces[gap] < end:
                follow = int(spaces[gap]) + 1
        start = max(start + 1, follow)


def chunk_articles(
    contents: DataFrame, text_column: str = "extracted_text", size: int = CHUNK_SIZE, overlap: int = CHUNK_OVERLAP, carry: tuple[str, ...] = (),
) -> DataFrame:
    """(article_id, text) -> chunk rows, none for blank text, with the article's columns in ``carry``. White space is normalized
    in the JVM, spans in Arrow batches."""
    check_chunk_settings(size, overlap)
    normalized = contents.select("article_id", text.collapse_ws(F.col(text_column)).alias("_text"), *carry)
    schema = T.StructType([*CHUNK_SCHEMA.fields, *(normalized.schema[c] for c in carry)])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield from _split(batch, size, overlap, carry)

    return normalized.mapInPandas(run, schema)


def _split(batch: pd.DataFrame, size: int, overlap: int, carry: tuple[str, ...]) -> Iterator[pd.DataFrame]:
    """Chunk rows of a batch, handed on as soon as they stand for HELD_CHARACTERS of text."""
    of, numbers, pieces, held = [], [], [], 0
    for place, body in enumerate(batch["_text"]):
        parts = [p for p in (body[a:b].strip() for a, b in chunk_spans(body, size, overlap)) if p]
        of += [place] * len(parts)
        numbers += range(len(parts))
        pieces += parts
        held += len(body)
        if pieces and (held >= HELD_CHARACTERS or place + 1 == len(batch)):
            rows = {"article_id": batch["article_id"].to_numpy()[of], "chunk_index": np.array(numbers, dtype="int32"), "chunk_text": pieces}
            yield pd.DataFrame(rows | {c: batch[c].to_numpy()[of] for c in carry})
            of, numbers, pieces, held = [], [], [], 0


def content_job(articles: DataFrame, bodies: DataFrame, chunks: DataFrame, max_articles: int | None = None) -> DataFrame:
    """New chunk rows for all articles that have none, as one lazy plan ending in one append."""
    work = eligible_articles(articles, chunks)
    if max_articles is not None:
        work = newest_work(work, max_articles)
    return chunk_articles(resolve_content(work, bodies))


def run_content_job(articles: DataFrame, bodies: DataFrame, chunks: VersionedTable, run: str, max_articles: int | None = None) -> DataFrame:
    """Append the chunks of all articles that have none, once per ``run``, and report on it.

    ``run`` names the input's snapshot. The articles are extracted and chunked in one pass, the write; the metrics come from the keys
    and from what was written, so they stay right where tasks ran twice. A run that has been committed writes nothing and
    reports what it did.
    """
    base = chunks.version()
    before = chunks.read(base)
    if run in base.runs:
        before = before.join(chunks.read_run(run).select("article_id").distinct(), "article_id", "left_anti")
    eligible = eligible_articles(articles, before)
    work = eligible if max_articles is None else newest_work(eligible, max_articles)
    if run not in base.runs:
        resolved = resolve_content(work, bodies)
        chunks.append(chunk_articles(resolved, carry=("extraction_source",)), run)
    return content_metrics(work, chunks.read_run(run))


def content_metrics(eligible: DataFrame, written: DataFrame) -> DataFrame:
    """One row: eligible, bodies, fallbacks, skipped, chunks, articles written. An article's first chunk stands for it."""
    first = F.col("chunk_index") == 0
    done = written.agg(
        F.count(F.lit(1)).alias("chunk_count"),
        F.count_if(first).alias("articles_written"),
        F.count_if(first & (F.col("extraction_source") == "article_body")).alias("article_body_count"),
    )
    count = eligible.agg(F.count(F.lit(1)).alias("n")).scalar()
    return done.select(
        count.alias("eligible_count"),
        "article_body_count",
        (F.col("articles_written") - F.col("article_body_count")).alias("metadata_fallback_count"),
        (count - F.col("articles_written")).alias("skipped_count"),
        "chunk_count",
        "articles_written",
    )
