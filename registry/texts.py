"""Text, content and embedding queries."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from marketloom.functions import text as tx, vectors
from marketloom.operators import content, embed, quality, search, state
from marketloom.plans import questions
from marketloom.schemas import EMBEDDING_DIMENSION
from registry.bindings import Data, chunk_cte, text, with_ctes
from registry.catalog import query

WS = tx.WS_CLASS
TRIM = tx.WS_CHARS


def collapse_sql(c: str) -> str:
    return f"trim(regexp_replace({c}, '{WS}+', ' ', 'g'))"


TICKER = r"^[A-Z][A-Z0-9]{0,4}([.-][A-Z0-9]{1,2})?$"


# ---------------------------------------------------------------- identifiers


TICKERS_SQL = f"""
SELECT raw, CASE WHEN regexp_matches(upper(trim(raw, '{TRIM}')), '{TICKER}') THEN upper(trim(raw, '{TRIM}')) END AS ticker
FROM (SELECT p_name AS raw FROM part UNION ALL SELECT chr(9) || p_type || '.b' || chr(10) FROM part UNION ALL SELECT p_brand FROM part
  UNION ALL SELECT chr(160) || ' k' || regexp_extract(props, '[0-9]+') || chr(8195) FROM events
  UNION ALL SELECT 'k' || user_id || '-' || regexp_extract(props, '[0-9]+') FROM events)"""


def raw_tickers(d: Data) -> DataFrame:
    part, events = d.table("part"), d.table("events")
    k = F.get_json_object("props", "$.k")
    return (
        part.select(F.col("p_name").alias("raw"))
        .unionByName(part.select(F.concat(F.lit("\t"), F.col("p_type"), F.lit(".b\n")).alias("raw")))
        .unionByName(part.select(F.col("p_brand").alias("raw")))
        .unionByName(events.select(F.concat(F.lit(chr(160) + " k"), k, F.lit(chr(8195))).alias("raw")))
        .unionByName(events.select(F.concat(F.lit("k"), text("user_id"), F.lit("-"), k).alias("raw")))
    )


@query("normalize_tickers", TICKERS_SQL)
def normalize_tickers(d: Data) -> DataFrame:
    return raw_tickers(d).select("raw", tx.normalize_ticker(F.col("raw")).alias("ticker"))


@query(
    "split_tickers",
    f"SELECT CASE WHEN ticker IS NULL THEN 'rejected' ELSE 'accepted' END AS kind, coalesce(ticker, raw) AS ticker FROM ({TICKERS_SQL})",
)
def split_tickers(d: Data) -> DataFrame:
    """A batch with bad tickers in two, and the sound part through the strict check."""
    sound, bad = quality.split_tickers(raw_tickers(d), "raw")
    accepted = quality.require_tickers(sound, "raw").select(F.lit("accepted").alias("kind"), F.col("raw").alias("ticker"))
    return accepted.unionByName(bad.select(F.lit("rejected").alias("kind"), F.col("raw").alias("ticker")))


@query(
    "normalize_emails",
    f"""
SELECT raw, CASE WHEN regexp_matches(lower(trim(raw, '{TRIM}')), '^[^@{WS[1:-1]}]+@[^@{WS[1:-1]}]+$') THEN lower(trim(raw, '{TRIM}')) END AS email
FROM (SELECT CASE c_mktsegment WHEN 'MACHINERY' THEN c_name || ' @example.com' WHEN 'HOUSEHOLD' THEN c_name || '@a@b'
        WHEN 'BUILDING' THEN '@' || c_name WHEN 'AUTOMOBILE' THEN chr(8195) || c_name || '@Example.COM' || chr(10) ELSE c_name END AS raw FROM customer
  UNION ALL SELECT ' User' || user_id || '@Example.com ' FROM events)""",
)
def normalize_emails(d: Data) -> DataFrame:
    name, segment = F.col("c_name"), F.col("c_mktsegment")
    customers = d.table("customer").select(
        F.when(segment == "MACHINERY", F.concat(name, F.lit(" @example.com")))
        .when(segment == "HOUSEHOLD", F.concat(name, F.lit("@a@b")))
        .when(segment == "BUILDING", F.concat(F.lit("@"), name))
        .when(segment == "AUTOMOBILE", F.concat(F.lit(chr(8195)), name, F.lit("@Example.COM\n")))
        .otherwise(name)
        .alias("raw")
    )
    users = d.table("events").select(F.concat(F.lit(" User"), text("user_id"), F.lit("@Example.com ")).alias("raw"))
    return customers.unionByName(users).select("raw", tx.normalize_email(F.col("raw")).alias("email"))


@query(
    "normalize_text",
    f"""
SELECT 'd' || doc_id AS id, {collapse_sql('text')} AS normalized FROM documents
UNION ALL SELECT 'c' || conv_id || '-' || turn, {collapse_sql('text')} FROM conversations""",
)
def normalize_text(d: Data) -> DataFrame:
    docs = d.table("documents").select(F.concat(F.lit("d"), text("doc_id")).alias("id"), "text")
    turns = d.table("conversations").select(
        F.concat(F.lit("c"), text("conv_id"), F.lit("-"), text("turn")).alias("id"), "text"
    )
    return docs.unionByName(turns).select("id", tx.collapse_ws(F.col("text")).alias("normalized"))


URL_VARIANTS = ["plain", "upper", "ftp", "userinfo", "bare", "slash"]


@query(
    "usable_urls",
    r"""
SELECT page_id, variant, u AS url,
  regexp_matches(u, '^(?i)https?://[^/?#@:]+') AND NOT regexp_matches(u, '^(?i)[a-z]+://[^/?#]*@') AS usable,
  regexp_matches(u, '^(?i)https?:') AS web_link,
  CASE WHEN regexp_matches(b, '^(?i)https://[^/?#@:]+') AND NOT regexp_matches(b, '^(?i)[a-z]+://[^/?#]*@') AND NOT regexp_matches(b, '[?#].') THEN b END AS base_url,
  coalesce(lower(regexp_extract(u, '^([A-Za-z]+)://', 1)) || '//' || lower(regexp_extract(u, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1))
    = lower(regexp_extract(url, '^([A-Za-z]+)://', 1)) || '//' || lower(regexp_extract(url, '^[A-Za-z]+://(?:[^/?#@]*@)?([^/?#:]+)', 1)), FALSE) AS same_site
FROM (SELECT page_id, url, variant, u, regexp_replace(u, '/+$', '') AS b FROM (
  SELECT page_id, url, variant, CASE variant WHEN 'plain' THEN url WHEN 'upper' THEN regexp_replace(url, '^http', 'HTTP') WHEN 'ftp' THEN regexp_replace(url, '^https?', 'ftp')
    WHEN 'userinfo' THEN regexp_replace(url, '://', '://me:pw@') WHEN 'bare' THEN regexp_replace(url, '^https?://', '') ELSE regexp_extract(url, '^https?://[^/?#]+') || '//' END AS u
  FROM pages, (SELECT unnest(['plain', 'upper', 'ftp', 'userinfo', 'bare', 'slash']) AS variant)))""",
)
def usable_urls(d: Data) -> DataFrame:
    url, variant = F.col("page_url"), F.col("variant")
    made = (
        F.when(variant == "plain", url)
        .when(variant == "upper", F.regexp_replace(url, "^http", "HTTP"))
        .when(variant == "ftp", F.regexp_replace(url, "^https?", "ftp"))
        .when(variant == "userinfo", F.regexp_replace(url, "://", "://me:pw@"))
        .when(variant == "bare", F.regexp_replace(url, "^https?://", ""))
        .otherwise(F.concat(F.regexp_extract(url, "^https?://[^/?#]+", 0), F.lit("//")))
    )
    rows = (
        d.table("pages")
        .select("page_id", F.col("url").alias("page_url"), F.explode(F.array(*map(F.lit, URL_VARIANTS))).alias("variant"))
        .withColumn("url", made)
    )
    u = F.col("url")
    return rows.select(
        "page_id", "variant", "url",
        tx.is_usable_url(u).alias("usable"),
        tx.is_http_url(u).alias("web_link"),
        tx.https_base_url(u).alias("base_url"),
        tx.same_origin(u, F.col("page_url")).alias("same_site"),
    )


# ---------------------------------------------------------------- redaction

_RULES_SQL = [
    (pattern, replacement.replace("$1", r"\1").replace("$2", r"\2").replace("$3", r"\3"))
    for pattern, replacement in tx.REDACTION_RULES
]


def redact_sql(c: str) -> str:
    sql = f"nullif({collapse_sql(c)}, '')"
    for pattern, replacement in _RULES_SQL:
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    return f"left({sql}, 500)"


@query(
    "redact_text",
    f"""
SELECT 'd' || doc_id AS id, {redact_sql('text')} AS redacted,
  CASE WHEN regexp_matches(trim(source), '^[A-Za-z0-9_.-]{{1,32}}$') THEN trim(source) END AS code, 'unknown' AS content_type,
  'body,lang,n' AS json_keys
FROM documents
UNION ALL
SELECT 'c' || conv_id || '-' || turn, {redact_sql(f"'token: ' || role || turn || ' see https://x.example/' || conv_id || ' {{a {{b}} c}} [' || turn || '] [none] ' || text")},
  CASE WHEN regexp_matches(trim(role), '^[A-Za-z0-9_.-]{{1,32}}$') THEN trim(role) END, 'text/' || role || '; v=' || turn, 'body,lang,n'
FROM conversations""",
)
def redact_text(d: Data) -> DataFrame:
    docs = d.table("documents").select(
        F.concat(F.lit("d"), text("doc_id")).alias("id"), "text", F.col("source").alias("code"),
        F.concat(F.col("lang"), F.lit("|")).alias("content_type"),
    )
    turn = text("turn")
    noisy = F.concat(
        F.lit("token: "), F.col("role"), turn, F.lit(" see https://x.example/"), text("conv_id"),
        F.lit(" {a {b} c} ["), turn, F.lit("] [none] "), F.col("text"),
    )
    turns = d.table("conversations").select(
        F.concat(F.lit("c"), text("conv_id"), F.lit("-"), turn).alias("id"), noisy.alias("text"),
        F.col("role").alias("code"),
        F.concat(F.lit("text/"), F.col("role"), F.lit(";  v="), turn).alias("content_type"),
    )
    body = F.to_json(F.struct(F.lit(1).alias("n"), F.lit("x").alias("bad key!"), F.col("code").alias("lang"), F.col("id").alias("body")))
    return docs.unionByName(turns).select(
        "id",
        tx.redact(F.col("text")).alias("redacted"),
        tx.safe_code(F.col("code")).alias("code"),
        tx.safe_content_type(F.col("content_type")).alias("content_type"),
        F.array_join(tx.safe_json_keys(body), ",").alias("json_keys"),
    )


# ---------------------------------------------------------------- content


@query(
    "eligible_articles",
    with_ctes(
        "b_articles",
        """
SELECT article_id, title, published_at FROM b_articles WHERE article_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)""",
    ),
)
def eligible_articles(d: Data) -> DataFrame:
    return content.eligible_articles(d.articles(), done(d)).select("article_id", "title", "published_at")


def done(d: Data) -> DataFrame:
    """Chunk keys of the articles a former run handled."""
    return d.table("labels").select(text("doc_id").alias("article_id"))


@query(
    "bounded_article_work",
    with_ctes(
        "b_articles",
        """
SELECT article_id, title, published_at FROM b_articles WHERE article_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels)
ORDER BY published_at DESC NULLS LAST, article_id LIMIT 100""",
    ),
)
def bounded_article_work(d: Data) -> DataFrame:
    work = content.newest_work(content.eligible_articles(d.articles(), done(d)), 100)
    return work.select("article_id", "title", "published_at")


# the provided pages mark their body with one article element and hold these elements and character references
BODY_SQL = "regexp_extract(html, '(?s)<article>(.*?)</article>', 1)"
for _element in ("script", "style", "nav", "footer", "aside", "form", "table"):
    BODY_SQL = f"regexp_replace({BODY_SQL}, '(?s)<{_element}[^>]*>.*?</{_element}>', ' ', 'g')"
for _pattern in ("(?s)<!--.*?-->", '(?s)<div class="ad">.*?</div>', "<[^>]+>"):
    BODY_SQL = f"regexp_replace({BODY_SQL}, '{_pattern}', ' ', 'g')"
for _reference, _character in (("&quot;", '"'), ("&middot;", "·"), ("&copy;", "©"), ("&amp;", "&")):
    BODY_SQL = f"replace({BODY_SQL}, '{_reference}', '{_character}')"
BODY_SQL = f"SELECT page_id, url, CASE WHEN length(t) >= 200 THEN t END AS body FROM (SELECT page_id, url, {collapse_sql(BODY_SQL)} AS t FROM pages)"


@query("extract_articles", BODY_SQL)
def extract_articles(d: Data) -> DataFrame:
    return content.extract_articles(d.table("pages")).select("page_id", "url", "body")


def page_bodies(d: Data) -> DataFrame:
    return content.extract_articles(d.table("pages")).select(text("page_id").alias("article_id"), "body")


FALLBACK_SQL = f"""nullif(concat_ws(chr(10) || chr(10), CASE WHEN {collapse_sql('title')} <> '' THEN 'Title: ' || {collapse_sql('title')} END,
  CASE WHEN {collapse_sql('description')} <> '' THEN 'Description: ' || {collapse_sql('description')} END), '')"""


@query(
    "resolve_content",
    with_ctes(
        "b_articles",
        f"""
SELECT a.article_id, CASE WHEN a.article_url IS NOT NULL AND p.body IS NOT NULL THEN 'article_body' ELSE 'metadata_fallback' END AS extraction_source,
       CASE WHEN a.article_url IS NOT NULL AND p.body IS NOT NULL THEN p.body ELSE {FALLBACK_SQL} END AS extracted_text
FROM b_articles a LEFT JOIN ({BODY_SQL}) p ON CAST(p.page_id AS VARCHAR) = a.article_id""",
    ),
)
def resolve_content(d: Data) -> DataFrame:
    return content.resolve_content(d.articles(), page_bodies(d)).select("article_id", "extraction_source", "extracted_text")


@query("metadata_fallback", with_ctes("b_articles", f"SELECT article_id, {FALLBACK_SQL} AS fallback FROM b_articles"))
def metadata_fallback(d: Data) -> DataFrame:
    return d.articles().select(
        "article_id", tx.metadata_fallback(F.col("title"), F.col("description")).alias("fallback")
    )


DOC_SOURCE = "SELECT CAST(doc_id AS VARCHAR) AS id, text AS raw FROM documents"


@query("chunk_articles", with_ctes("", "SELECT * FROM doc_chunks", chunk_cte("doc_chunks", DOC_SOURCE, 1200, 200)))
def chunk_articles(d: Data) -> DataFrame:
    return d.document_chunks()


# Spanish documents have no URL, so their metadata stands in
NEW_SOURCE = f"""SELECT CAST(doc_id AS VARCHAR) AS id,
  CASE WHEN lang <> 'es' AND length({collapse_sql('text')}) > 0 THEN text ELSE 'Title: ' || source || ' Description: written in ' || lang END AS raw
  FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"""


def document_bodies(d: Data) -> DataFrame:
    return d.table("documents").select(
        text("doc_id").alias("article_id"), F.nullif(tx.collapse_ws(F.col("text")), F.lit("")).alias("body")
    )


@query("append_new_chunks", with_ctes("", "SELECT * FROM new_chunks", chunk_cte("new_chunks", NEW_SOURCE, 1200, 200)))
def append_new_chunks(d: Data) -> DataFrame:
    table = d.versioned("chunks", content.RUN_SCHEMA)
    # articles with labels have their chunks already
    held = done(d).select("article_id", F.lit(0).alias("chunk_index"), F.lit("held").alias("chunk_text"), F.lit("held").alias("extraction_source"))
    table.replace(held)
    for run in ("documents@1", "documents@1", "documents@2"):  # the second is the first again, the third finds nothing left
        content.run_content_job(d.document_articles(), document_bodies(d), table, run)
    rows = table.read_run("documents@1").unionByName(table.read_run("documents@2"))
    return rows.select("article_id", "chunk_index", "chunk_text")


@query(
    "content_run_metrics",
    with_ctes(
        "",
        """
SELECT (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)) AS eligible_count,
  (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang <> 'es') AS article_body_count,
  (SELECT count(*) FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang = 'es') AS metadata_fallback_count,
  CAST(0 AS BIGINT) AS skipped_count, (SELECT count(*) FROM new_chunks) AS chunk_count,
  (SELECT count(DISTINCT article_id) FROM new_chunks) AS articles_written""",
        chunk_cte("new_chunks", NEW_SOURCE, 1200, 200),
    ),
)
def content_run_metrics(d: Data) -> DataFrame:
    table = d.versioned("chunks", content.RUN_SCHEMA)
    held = done(d).select("article_id", F.lit(0).alias("chunk_index"), F.lit("held").alias("chunk_text"), F.lit("held").alias("extraction_source"))
    table.replace(held)
    return content.run_content_job(d.document_articles(), document_bodies(d), table, "documents@1")


@query(
    "replace_chunks",
    with_ctes(
        "",
        """
SELECT article_id, chunk_index, chunk_text FROM old_chunks
WHERE article_id NOT IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 0 OR toxic = 1)
UNION ALL SELECT article_id, chunk_index, chunk_text FROM long_chunks
WHERE article_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 0)""",
        chunk_cte("old_chunks", DOC_SOURCE, 1200, 200) + ",\n" + chunk_cte("long_chunks", DOC_SOURCE, 2400, 0),
    ),
)
def replace_chunks(d: Data) -> DataFrame:
    # low quality is re-chunked; what is toxic only is replaced by nothing
    labels = d.table("labels").select(text("doc_id").alias("article_id"), "quality", "toxic")
    low = labels.filter("quality = 0").select("article_id")
    docs = d.table("documents").select(text("doc_id").alias("article_id"), "text").join(low, "article_id", "left_semi")
    fresh = content.chunk_articles(docs, "text", 2400, 0)
    return state.replace_chunks(d.document_chunks(), labels.filter("quality = 0 OR toxic = 1"), fresh)[0]


@query(
    "unembedded_chunks",
    with_ctes("b_chunks", "SELECT article_id, chunk_index, chunk_text FROM b_chunks WHERE embedding IS NULL"),
)
def unembedded_chunks(d: Data) -> DataFrame:
    return content.unembedded_chunks(d.chunks())


@query(
    "bounded_chunk_work",
    with_ctes(
        "b_chunks",
        "SELECT article_id, chunk_index, chunk_text FROM b_chunks WHERE embedding IS NULL ORDER BY article_id, chunk_index LIMIT 25",
    ),
)
def bounded_chunk_work(d: Data) -> DataFrame:
    return content.next_chunks(content.unembedded_chunks(d.chunks()), 25)


# ---------------------------------------------------------------- embeddings


def hash_vector_sql(keys: str, source: str) -> str:
    """Vectors of ``source``(keys.., t) as comma-joined integers (millionths of float32 weights)."""
    dim = EMBEDDING_DIMENSION
    return f"""
SELECT {keys}, array_to_string(list_transform(range({dim}), lambda i :
    CAST(round(CAST(CAST(coalesce(element_at(weights, i)[1], 0) / norm AS FLOAT) AS DOUBLE) * 1000000) AS BIGINT)), ',') AS embedding
FROM (SELECT {keys}, map_from_entries(list((bucket, weight))) AS weights, sqrt(sum(weight * weight)) AS norm FROM (
  SELECT {keys}, bucket, sum(sign) AS weight FROM (
    SELECT {keys}, CAST('0x' || left(h, 8) AS BIGINT) % {dim} AS bucket, CASE WHEN substr(h, 9, 1) < '8' THEN 1.0 ELSE -1.0 END AS sign
    FROM (SELECT {keys}, md5(unnest(string_split(lower(t), ' '))) AS h FROM ({source})))
  GROUP BY ALL)
GROUP BY ALL)"""


def millionths(v: str) -> Column:
    scaled = F.transform(v, lambda x: F.round(x.cast("double") * 1000000).cast("long").cast("string"))
    return F.array_join(scaled, ",")


@query(
    "embed_chunks",
    with_ctes(
        "",
        hash_vector_sql("article_id, chunk_index", "SELECT article_id, chunk_index, chunk_text AS t FROM doc_chunks"),
        chunk_cte("doc_chunks", DOC_SOURCE, 1200, 200),
    ),
)
def embed_chunks(d: Data) -> DataFrame:
    made = embed.embed(d.document_chunks(), "chunk_text", ["article_id", "chunk_index"])
    return made.select("article_id", "chunk_index", millionths("embedding").alias("embedding"))


@query("embed_queries", hash_vector_sql("item_id", f"SELECT item_id, {collapse_sql('text')} AS t FROM benchmark"))
def embed_queries(d: Data) -> DataFrame:
    made = embed.embed(d.table("benchmark"), "text", ["item_id"])
    return made.select("item_id", millionths("embedding").alias("embedding"))


class Millionths(embed.HashingModel):
    """Weights as whole millionths, so that both engines rank the same numbers."""

    def encode(self, sentences: list[str], **options) -> np.ndarray:
        return np.rint(super().encode(sentences, **options).astype("float32").astype("float64") * 1_000_000)


@query(
    "semantic_search_service",
    with_ctes(
        "",
        f"""
, vectors AS (SELECT article_id, chunk_index, list_transform(string_split(embedding, ','), lambda x : CAST(x AS DOUBLE)) AS v FROM (
  {hash_vector_sql("article_id, chunk_index", "SELECT article_id, chunk_index, chunk_text AS t FROM doc_chunks")})),
questions AS (SELECT item_id, list_transform(string_split(embedding, ','), lambda x : CAST(x AS DOUBLE)) AS q FROM (
  {hash_vector_sql("item_id", f"SELECT item_id, {collapse_sql('text')} AS t FROM benchmark")}))
SELECT item_id, article_id, chunk_index, CAST(rank AS INTEGER) AS rank, round(d, 6) AS distance FROM (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY d, article_id, chunk_index) AS rank FROM (
    SELECT item_id, article_id, chunk_index, round(list_cosine_distance(v, q), 12) AS d FROM questions, vectors))
WHERE rank <= 5""",
        chunk_cte("doc_chunks", DOC_SOURCE, 1200, 200),
    ),
)
def semantic_search_service(d: Data) -> DataFrame:
    """Every benchmark text as a question over the embedded chunks of all documents."""
    chunks = embed.embed(d.document_chunks(), "chunk_text", ["article_id", "chunk_index"], Millionths)
    asked = d.table("benchmark").select(F.col("item_id").alias("request_id"), F.col("text").alias("question"))
    hits = questions.semantic_news_search(asked, chunks, 5, model_factory=Millionths)
    return hits.select(
        F.col("request_id").alias("item_id"), "article_id", "chunk_index", "rank", F.round("distance", 6).alias("distance")
    )


@query(
    "embed_run_metrics",
    with_ctes(
        "b_chunks",
        """
SELECT count(*) AS eligible_count, count(*) AS embedded_count, count(*) AS persisted_count FROM b_chunks WHERE embedding IS NULL""",
    ),
)
def embed_run_metrics(d: Data) -> DataFrame:
    return embed.run_embed_job(d.chunks(), d.versioned("vectors", embed.STORE_SCHEMA), "chunks@1")


@query(
    "set_embeddings",
    with_ctes(
        "b_chunks",
        """
SELECT 'chunk' AS kind, c.article_id, c.chunk_index, len(CASE WHEN u.ok THEN u.embedding ELSE c.embedding END) AS dimension,
       CASE WHEN u.ok THEN 'model-b' ELSE c.embedding_model END AS embedding_model, CAST(NULL AS VARCHAR) AS reason
FROM b_chunks c LEFT JOIN (SELECT CAST(vec_id // 5 AS VARCHAR) AS article_id, vec_id % 5 AS chunk_index, embedding, TRUE AS ok
   FROM embeddings WHERE label NOT IN (1, 2, 3)) u ON u.article_id = c.article_id AND u.chunk_index = c.chunk_index
UNION ALL
SELECT 'reject', CASE WHEN label = 3 THEN 'X' ELSE '' END || (vec_id // 5), CAST(vec_id % 5 AS INTEGER), CASE WHEN label = 1 THEN 63 ELSE 64 END,
       CASE WHEN label = 2 THEN '  ' ELSE 'model-b' END,
       CASE label WHEN 1 THEN 'wrong embedding size' WHEN 2 THEN 'missing embedding model' ELSE 'chunk not found' END
FROM embeddings WHERE label IN (1, 2, 3)""",
    ),
)
def set_embeddings(d: Data) -> DataFrame:
    """Every vector is sent as an update: label 1 is cut short, 2 has a blank model, 3 an unknown article."""
    label = F.col("label")
    updates = d.table("embeddings").select(
        F.concat(F.when(label == 3, "X").otherwise(""), text(F.floor(F.col("vec_id") / 5).cast("long"))).alias("article_id"),
        (F.col("vec_id") % 5).cast("int").alias("chunk_index"),
        F.when(label == 1, F.slice("embedding", 1, 63)).otherwise(F.col("embedding")).alias("embedding"),
        F.when(label == 2, "  ").otherwise("model-b").alias("embedding_model"),
        F.col("vec_id").alias("seq"),
    )
    nxt, rejects = state.set_embeddings(d.chunks(), updates, 64, ["seq"])

    def shown(df: DataFrame, kind: str, reason: Column) -> DataFrame:
        size = F.when(F.col("embedding").isNotNull(), F.size("embedding").cast("long"))
        return df.select(
            F.lit(kind).alias("kind"), "article_id", "chunk_index", size.alias("dimension"), "embedding_model",
            reason.alias("reason"),
        )

    return shown(nxt, "chunk", F.lit(None).cast("string")).unionByName(shown(rejects, "reject", F.col("reason")))


@query(
    "validate_embeddings",
    """
SELECT vec_id, variant, len(v) = 64 AND list_bool_and(list_transform(v, lambda x : x IS NOT NULL AND NOT isnan(x) AND NOT isinf(x))) AS valid
FROM (SELECT vec_id, variant, CASE variant WHEN 'as is' THEN embedding WHEN 'short' THEN embedding[1:63]
    WHEN 'nan' THEN list_append(embedding[1:63], CAST('nan' AS FLOAT)) WHEN 'infinite' THEN list_append(embedding[1:63], CAST('inf' AS FLOAT))
    WHEN 'null' THEN list_append(embedding[1:63], NULL) ELSE list_append(embedding, CAST(0 AS FLOAT)) END AS v
  FROM embeddings, (SELECT unnest(['as is', 'short', 'nan', 'infinite', 'null', 'long']) AS variant))""",
)
def validate_embeddings(d: Data) -> DataFrame:
    v, variant = F.col("embedding"), F.col("variant")

    def ended(value: Column) -> Column:
        return F.array_append(F.slice(v, 1, 63), value.cast("float"))

    made = (
        F.when(variant == "as is", v)
        .when(variant == "short", F.slice(v, 1, 63))
        .when(variant == "nan", ended(F.lit(float("nan"))))
        .when(variant == "infinite", ended(F.lit(float("inf"))))
        .when(variant == "null", ended(F.lit(None)))
        .otherwise(F.array_append(v, F.lit(0.0).cast("float")))
    )
    variants = F.explode(F.array(*map(F.lit, ["as is", "short", "nan", "infinite", "null", "long"])))
    rows = d.table("embeddings").select("vec_id", "embedding", variants.alias("variant"))
    return rows.select("vec_id", "variant", vectors.is_valid_vector(made, 64).alias("valid"))


@query(
    "vector_text_roundtrip",
    """
SELECT vec_id, TRUE AS equal, len(embedding) AS dimension, round(list_sum(CAST(embedding AS DOUBLE[])), 6) AS total FROM embeddings""",
)
def vector_text_roundtrip(d: Data) -> DataFrame:
    parsed = vectors.parse_vector(vectors.vector_text(F.col("embedding")), "float")
    total = F.aggregate("parsed", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    rows = d.table("embeddings").select("vec_id", "embedding", parsed.alias("parsed"))
    return rows.select(
        "vec_id",
        (F.col("parsed") == F.col("embedding")).alias("equal"),
        F.size("parsed").cast("long").alias("dimension"),
        F.round(total, 6).alias("total"),
    )
