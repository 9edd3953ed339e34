"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverbrook.llm.common import table
from silverbrook.llm.decontamination import find_passages
from silverbrook.llm.exact_dedup import exact_dedup
from silverbrook.llm.language_id import language_id
from silverbrook.llm.line_dedup import line_dedup
from silverbrook.llm.near_dedup import near_groups
from silverbrook.llm.packing import pack_documents
from silverbrook.llm.sharding import shard
from silverbrook.llm.spelling import spelling_forms
from silverbrook.llm.substring_dedup import repeated_passages
from silverbrook.llm.token_counts import token_counts
from silverbrook.llm.token_frames import read_digests, write_tokens
from silverbrook.llm.url_filters import filter_captures, url_host
from silverbrook.llm.whitening import whiten
from silverbrook.session import shared_dir


#: Tokens beyond which a document is too long for the model's context.
CONTEXT = 2048


def tokenizer_file() -> str:
    """The byte-level vocabulary that the registered queries use."""
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_passages(table(spark, sf_dir, "documents"))


def op2_token_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return read_digests(write_tokens(docs, shared_dir(spark, "tokens"), tokenizer_file()))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = exact_dedup(table(spark, sf_dir, "documents"))
    return marked.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file())


def captures(pages: DataFrame) -> DataFrame:
    """The pages as captures: the table has no fetch time, so page n is fetched in hour n since 2024 began."""
    hour = F.expr("timestamp'2024-01-01 00:00:00' + make_dt_interval(0, page_id)")
    return pages.select("page_id", "url", F.to_date(hour).alias("fetched_on"))


def dated_entries(seen: DataFrame) -> DataFrame:
    """Two dated lists drawn from the captures themselves.

    ``flood`` follows hosts: a day with three captures or more adds the host
    from the next day on, a day with fewer removes it. ``hyphen`` follows
    domains with a hyphen in the name (without www, m or blog): an odd day of
    the month adds, an even one removes.
    """
    host = url_host(F.col("url"))
    daily = (
        seen.withColumn("host", host)
        .filter("host IS NOT NULL")
        .groupBy("host", "fetched_on")
        .agg(F.count("*").alias("n"))
    )
    next_day = F.date_add("fetched_on", 1)
    domain = F.regexp_replace("host", r"^(www|m|blog)\.", "")
    entries = F.array(
        F.struct(
            F.lit("flood").alias("list"),
            F.lit("host").alias("scope"),
            F.col("host").alias("key"),
            F.when(F.col("n") >= 3, "add").otherwise("remove").alias("action"),
            next_day.alias("day"),
        ),
        F.struct(
            F.lit("hyphen").alias("list"),
            F.lit("domain").alias("scope"),
            F.when(domain.contains("-"), domain).alias("key"),
            F.when(F.dayofmonth("fetched_on") % 2 == 1, "add").otherwise("remove").alias("action"),
            next_day.alias("day"),
        ),
    )
    return daily.select(F.inline(entries))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = captures(table(spark, sf_dir, "pages"))
    judged = filter_captures(seen, dated_entries(seen))
    label = F.transform("active", lambda e: F.concat_ws(":", e["list"], e["key"]))
    return judged.select(
        "page_id",
        "host",
        "fetched_on",
        "blocked",
        F.array_join(F.sort_array(label), ",").alias("active"),
        F.array_min(F.transform("active", lambda e: e["valid_from"])).alias("since"),
    )


def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(table(spark, sf_dir, "documents"))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    white = whiten(table(spark, sf_dir, "embeddings"))
    # A long holds it up to some ten million vectors like these; beyond that it is null here.
    return white.withColumn("deviation", F.col("deviation").try_cast("long"))


def op12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return counted.withColumn("over_limit", F.col("n_tokens") > CONTEXT)


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_forms(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_token_frames": op2_token_frames,
    "op3_language_id": op3_language_id,
    "op4_line_dedup": op4_line_dedup,
    "op5_exact_dedup": op5_exact_dedup,
    "op6_packing": op6_packing,
    "op7_url_filters": op7_url_filters,
    "op8_minhash_near_dedup": op8_minhash_near_dedup,
    "op9_sharding": op9_sharding,
    "op10_decontamination": op10_decontamination,
    "op11_embedding_whitening": op11_embedding_whitening,
    "op12_token_counts": op12_token_counts,
    "op13_spelling_variants": op13_spelling_variants,
}

ORACLES: dict[str, str] = {
    "op4_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, row_number() OVER () AS r, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
numbered AS (
  SELECT doc_id, r, unnest(l) AS line, unnest(range(1, len(l) + 1)) AS pos FROM lines),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM numbered),
owners AS (
  SELECT k, min(doc_id) AS owner FROM keyed WHERE length(k) >= 10
  GROUP BY k HAVING count(DISTINCT doc_id) > 1),
flagged AS (
  SELECT x.*, o.owner IS NOT NULL AND o.owner <> x.doc_id AS gone FROM keyed x LEFT JOIN owners o USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM flagged GROUP BY doc_id, r
""",
    "op5_exact_dedup": r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
  doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
""",
    "op7_url_filters": r"""
WITH seen AS (
  SELECT page_id, CAST(TIMESTAMP '2024-01-01 00:00:00' + to_hours(page_id) AS DATE) AS fetched_on,
    nullif(regexp_replace(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)),
      '\.+$', ''), '') AS host
  FROM pages),
daily AS (
  SELECT host, fetched_on, count(*) AS n, regexp_replace(host, '^(www|m|blog)\.', '') AS domain
  FROM seen WHERE host IS NOT NULL GROUP BY host, fetched_on),
entries AS (
  SELECT 'flood' AS list, 'host' AS scope, host AS key, n >= 3 AS is_on, fetched_on + 1 AS day FROM daily
  UNION ALL
  SELECT 'hyphen', 'domain', domain, day(fetched_on) % 2 = 1, fetched_on + 1 FROM daily
  WHERE contains(domain, '-')),
net AS (SELECT list, scope, key, day, bool_or(is_on) AS is_on FROM entries GROUP BY ALL),
spans AS (
  SELECT *, lead(day) OVER (PARTITION BY list, scope, key ORDER BY day) AS until FROM net),
active AS (
  SELECT s.page_id, s.host, s.fetched_on, e.list, e.key, e.scope, e.day
  FROM seen s JOIN spans e
    ON (s.host = e.key OR (e.scope = 'domain' AND ends_with(s.host, '.' || e.key)))
    AND e.is_on AND s.fetched_on >= e.day AND (e.until IS NULL OR s.fetched_on < e.until)),
-- The day since which an entry holds without a break: after its last removal.
since AS (
  SELECT a.page_id, a.list, a.key, min(e.day) AS since
  FROM active a JOIN net e ON e.list = a.list AND e.scope = a.scope AND e.key = a.key AND e.is_on AND e.day <= a.day
  LEFT JOIN LATERAL (
    SELECT max(r.day) AS last_off FROM net r
    WHERE r.list = a.list AND r.scope = a.scope AND r.key = a.key AND NOT r.is_on AND r.day < a.day) off ON true
  WHERE off.last_off IS NULL OR e.day > off.last_off
  GROUP BY a.page_id, a.list, a.key)
SELECT s.page_id, s.host, s.fetched_on, count(x.page_id) > 0 AS blocked,
  coalesce(string_agg(x.list || ':' || x.key, ',' ORDER BY x.list || ':' || x.key), '') AS active,
  min(x.since) AS since
FROM seen s LEFT JOIN since x ON s.page_id = x.page_id
GROUP BY s.page_id, s.host, s.fetched_on
""",
}
