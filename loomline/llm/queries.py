"""The operators on the driver's tables, with production parameters, and DuckDB statements for those SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from loomline.llm.files import remove
from loomline.llm.licenses import licence_scan
from loomline.llm.mixing import mix_sources
from loomline.llm.packing import best_fit_packing
from loomline.llm.quality import quality_rules
from loomline.llm.secrets import secret_spans, span_digest
from loomline.llm.simhash import simhash_components
from loomline.llm.tokens import count_tokens, named, write_tokens
from loomline.llm.topk import top_k
from loomline.llm.urls import DEFAULT_RULES, base_verdicts, url_filter
from loomline.llm.vocabularies import BYTE_BPE, BYTE_BPE_RANKS, PIECES
from loomline.llm.warc import all_read, read_warc, record_digest, write_warc
from loomline.session import cut, fresh_dir, table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files: every fourth is a LICENSE file of source/lang, the others lie one directory below."""
    home = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")))
    licence = F.concat(home, F.lit("/LICENSE-"), F.col("doc_id").cast("string"))
    other = F.concat(home, F.lit("/"), (F.col("doc_id") % 10).cast("string"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt"))
    files = table(spark, sf_dir, "documents").withColumn("path", F.when(F.col("doc_id") % 4 == 0, licence).otherwise(other))
    return licence_scan(files)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return base_verdicts(url_filter(table(spark, sf_dir, "pages")))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_digest(secret_spans(table(spark, sf_dir, "documents")))


def op5_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_dir(spark, "warc")
    files = write_warc(table(spark, sf_dir, "pages"), folder)
    found = cut(record_digest(read_warc(files)))
    remove(folder)
    all_read(files, found)
    return found


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents")).drop("sources")


def op7_bit_sliced_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), BYTE_BPE, BYTE_BPE_RANKS)


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id and n_tokens of each document, read from flat token files alone."""
    folder = fresh_dir(spark, "tokens")
    files = write_tokens(table(spark, sf_dir, "documents"), folder, PIECES)
    counts = count_tokens(files)
    remove(folder)
    return named(counts, files)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), PIECES)


QUERIES = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_url_filter,
        op3_simhash_near_dedup,
        op4_secret_scan,
        op5_warc_salvage,
        op6_source_mix,
        op7_bit_sliced_top_k,
        op8_best_fit_packing,
        op9_token_counts,
        op10_quality_rules,
    )
} | {"pipeline": corpus_pipeline.run}

#: The word of all contracts in DuckDB, as the class of one of its characters.
_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _url_sql() -> str:
    rows = ", ".join(f"({_quoted(x.name)}, {_quoted(x.verdict)}, {_quoted(x.pattern)}, {x.rank})" for x in DEFAULT_RULES)
    return f"""
WITH rules(name, verdict, pattern, rank) AS (VALUES {rows}),
parts AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^(?s:.*?)://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
fits AS (
  SELECT page_id, arg_max(name, (rank, length(name), name)) AS name, arg_max(verdict, (rank, length(name), name)) AS verdict, max(rank) AS rank
  FROM parts JOIN rules ON regexp_matches(host || '?' || path || '?', pattern) GROUP BY page_id)
SELECT p.page_id, p.host, p.path, CASE WHEN f.rank = 1 THEN f.name END AS rule, coalesce(f.verdict, 'allow') AS verdict, CASE WHEN f.rank = 0 THEN f.name END AS pattern
FROM parts p LEFT JOIN fits f USING (page_id)"""


_WARC_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body) AS n, sha1(body) AS digest FROM p),
t AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY digest, n) ELSE page_id END AS top FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
       CASE WHEN top = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN top <> page_id THEN top END AS refers_to
FROM t"""

_MIX_SQL = rf"""
WITH RECURSIVE sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{_WORD}')) AS BIGINT) AS size,
         md5('42:' || doc_id) AS drawn, row_number() OVER (ORDER BY doc_id) AS row
  FROM documents),
sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s, CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT) AS w
  FROM sized GROUP BY source),
filling AS (
  SELECT *, 3.0 * s / w AS full_at,
         sum(3 * s) OVER (ORDER BY 3.0 * s / w, w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS given,
         sum(w) OVER (ORDER BY 3.0 * s / w, w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS gone,
         sum(s) OVER () AS words, sum(w) OVER () AS weights
  FROM sources),
level AS (
  SELECT min(CASE WHEN (words - coalesce(given, 0)) * w <= 3 * s * (weights - coalesce(gone, 0)) THEN full_at END) AS from_,
         arg_min(words - coalesce(given, 0), full_at) FILTER (WHERE (words - coalesce(given, 0)) * w <= 3 * s * (weights - coalesce(gone, 0))) AS rest,
         arg_min(weights - coalesce(gone, 0), full_at) FILTER (WHERE (words - coalesce(given, 0)) * w <= 3 * s * (weights - coalesce(gone, 0))) AS weight
  FROM filling),
targets AS (
  SELECT source, s, CASE WHEN full_at < from_ THEN CAST(3 * s AS DOUBLE) ELSE CAST(rest * w AS DOUBLE) / CAST(weight AS DOUBLE) END AS target
  FROM filling, level),
quotas AS (
  SELECT *, CAST(round_even(target, 0) AS BIGINT) AS quota FROM targets),
placed AS (
  SELECT d.*, q.s, q.target, CASE WHEN q.s > 0 THEN q.quota // q.s ELSE 0 END AS rounds, CASE WHEN q.s > 0 THEN q.quota % q.s ELSE 0 END AS rest,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.drawn, d.size, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM sized d JOIN quotas q ON d.source IS NOT DISTINCT FROM q.source),
first_ AS (SELECT *, CASE WHEN rest - before > before + size - rest THEN size ELSE 0 END AS last FROM placed),
gapped AS (SELECT *, rest - sum(last) OVER (PARTITION BY source) AS gap FROM first_),
turns AS (
  SELECT source, arg_min(row, (abs(abs(gap) - size), drawn, row)) AS row FROM gapped
  WHERE size > 0 AND rest > 0 AND gap <> 0 AND abs(abs(gap) - size) < abs(gap) AND (gap > 0) = (last = 0) GROUP BY source)
SELECT g.doc_id, g.size, g.s AS source_size, g.target,
       CAST(g.rounds * g.size + CASE WHEN t.row IS NOT NULL THEN g.size - g.last ELSE g.last END AS BIGINT) AS taken
FROM gapped g LEFT JOIN turns t ON g.row = t.row"""

_TOP_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM c)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""

ORACLE_SQL = {"op2_url_filter": _url_sql(), "op5_warc_salvage": _WARC_SQL, "op6_source_mix": _MIX_SQL, "op7_bit_sliced_top_k": _TOP_SQL}
if corpus_pipeline.ORACLE_SQL:
    ORACLE_SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
