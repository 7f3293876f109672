"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from obsframe.llm import (
    importance, languages, license_table, licenses, mixing, neardup, neighbours, packing, periodic, quality, secrets, substrings,
    voting, warc)
from obsframe.llm.common import table, written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _registered(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


# ---- 1 license scans ------------------------------------------------------------------


@_registered
def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences among the entire texts and the lines of all documents."""
    return licenses.scan(table(spark, sf_dir, "documents"), license_table.table(spark))


def _values(rows: Iterable[tuple[str, ...]]) -> str:
    return ", ".join(f"({', '.join(map(_quoted, row))})" for row in rows)


def _canonical_sql(text: str) -> str:
    spelled = f"lower(coalesce({text}, ''))"
    for variant, usual in licenses.SPELLINGS:
        spelled = f"replace({spelled}, {_quoted(variant)}, {_quoted(usual)})"
    plain = rf"regexp_replace({spelled}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"
    return (
        f"list_filter(list_transform(string_split({plain}, chr(10)), lambda x: trim(x)), "
        f"lambda x: x <> '' AND NOT regexp_matches(x, {_quoted(licenses.COPYRIGHT_LINE)}))"
    )


ORACLES["op1_license_scan"] = f"""
WITH listed(license, known_text) AS (VALUES {_values(
    [*licenses.KNOWN, *license_table.identifiers(), *license_table.short_texts()])}),
names(license, called) AS (VALUES {_values((n, called) for n, names in license_table.NAMES.items() for called in names)}),
phrases(phrase) AS (VALUES {_values((p,) for p in license_table.PHRASES)}),
texts AS (SELECT * FROM listed UNION ALL SELECT license, phrase || called FROM names CROSS JOIN phrases),
long_texts(license, digest) AS (VALUES {_values(license_table.LONG_TEXTS)}),
known AS (
  SELECT license, md5(array_to_string({_canonical_sql("known_text")}, ' ')) AS digest FROM texts
  UNION SELECT license, digest FROM long_texts),
lines AS (SELECT doc_id, {_canonical_sql("text")} AS lines FROM documents),
units AS (
  SELECT doc_id, TRUE AS whole, md5(array_to_string(lines, ' ')) AS digest FROM lines WHERE len(lines) > 0
  UNION ALL SELECT doc_id, FALSE, md5(line) FROM (SELECT doc_id, unnest(lines) AS line FROM lines)),
found AS (
  SELECT doc_id, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses,
         CAST(sum(CASE WHEN whole THEN 0 ELSE 1 END) AS BIGINT) AS n_notices, bool_or(whole) AS whole_text
  FROM units JOIN known USING (digest) GROUP BY doc_id)
SELECT d.doc_id, coalesce(licenses, '') AS licenses, coalesce(n_notices, 0) AS n_notices,
       coalesce(whole_text, FALSE) AS whole_text
FROM documents d LEFT JOIN found f ON d.doc_id IS NOT DISTINCT FROM f.doc_id
"""


# ---- 2 near-duplicates ----------------------------------------------------------------


@_registered
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under links of 3-word shingles at 85 percent."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


# ---- 3 substrings ---------------------------------------------------------------------


@_registered
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of every document without windows of 35 words that occur again."""
    return substrings.without_repeats(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


# ---- 4 mixing -------------------------------------------------------------------------


@_registered
def op4_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document; sources weigh 5, 2, 1, repeating."""
    sizes = written(mixing.sized(table(spark, sf_dir, "documents")), "mix-sizes")
    return mixing.taken(mixing.mix(sizes))


ORACLES["op4_source_mix"] = rf"""
WITH sized AS (
  SELECT doc_id, source,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS shuffle_key
  FROM documents),
placed AS (
  SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY shuffle_key, doc_id, size
                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS place
  FROM sized),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (
  SELECT source, source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS position,
         source_size * {mixing.MAX_EPOCHS} AS capacity, CAST(sum(source_size) OVER () AS BIGINT) AS total
  FROM totals),
weighted AS (
  SELECT *, CASE (position - 1) % 3 WHEN 0 THEN {mixing.WEIGHTS[0]} WHEN 1 THEN {mixing.WEIGHTS[1]}
            ELSE {mixing.WEIGHTS[2]} END AS weight FROM ranked),
filling AS (
  SELECT *, total - coalesce(sum(capacity) OVER (ORDER BY capacity / weight, position
              ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room,
         sum(weight) OVER (ORDER BY capacity / weight, position
              ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weight_left
  FROM weighted),
filled AS (SELECT *, capacity * weight_left <= weight * room AS is_full FROM filling),
shared AS (
  SELECT *, CAST(total - sum(CASE WHEN is_full THEN capacity ELSE 0 END) OVER () AS BIGINT) AS rest,
         sum(CASE WHEN is_full THEN 0 ELSE weight END) OVER () AS rest_weight
  FROM filled),
targets AS (
  SELECT source, source_size, position, total,
         CASE WHEN is_full THEN CAST(capacity AS DOUBLE)
              ELSE CAST(rest AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(rest_weight AS DOUBLE) END AS target,
         least(CAST(ceil(total / {float(mixing.SLOTS)}) AS BIGINT),
               min(CASE WHEN (CASE WHEN is_full THEN CAST(capacity AS DOUBLE)
                    ELSE CAST(rest AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(rest_weight AS DOUBLE) END) > 0
                   THEN CAST(floor((CASE WHEN is_full THEN CAST(capacity AS DOUBLE)
                    ELSE CAST(rest AS DOUBLE) * CAST(weight AS DOUBLE) / CAST(rest_weight AS DOUBLE) END)
                    / {float(mixing.LEAST_BLOCKS)}) AS BIGINT) END) OVER ()) AS narrow
  FROM shared),
cut AS (
  SELECT *, greatest(narrow, 1) AS block, CAST(ceil(CAST(total AS DOUBLE) / greatest(narrow, 1)) AS BIGINT) AS n_slots,
         CAST(sum(CAST(floor(target) AS BIGINT)) OVER (ORDER BY position
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative,
         position = max(position) OVER () AS is_last
  FROM targets),
grids AS (SELECT *, length(bin(greatest(n_slots - 1, 0))) AS bits FROM cut),
ends AS (
  SELECT *, CAST(CASE WHEN is_last THEN pow(2.0, bits)
                 ELSE ceil(CAST(cumulative AS DOUBLE) / greatest(total, 1) * pow(2.0, bits)) END AS BIGINT) AS high
  FROM grids),
bounds AS (SELECT *, coalesce(lag(high) OVER (ORDER BY position), 0) AS low FROM ends),
slots AS (
  SELECT source, low, high, p.point FROM bounds, (SELECT unnest(range((SELECT max(n_slots) FROM bounds))) AS slot) s,
  LATERAL (SELECT CAST(('0b' || reverse(lpad(bin(s.slot), CAST(bits AS INTEGER), '0'))) AS BIGINT) AS point) p
  WHERE p.point >= low AND p.point < high),
blocks AS (SELECT source, count(*) AS n_blocks FROM slots GROUP BY source),
supply AS (
  SELECT b.source, source_size, target, coalesce(n_blocks, 0) * block AS words
  FROM bounds b LEFT JOIN blocks k ON b.source IS NOT DISTINCT FROM k.source)
SELECT d.doc_id, d.source, size, source_size, target, CAST(
  least(greatest(words - place, 0), size) + least(greatest(words - place - source_size, 0), size)
  + least(greatest(words - place - 2 * source_size, 0), size) AS BIGINT) AS taken
FROM placed d JOIN supply s ON d.source IS NOT DISTINCT FROM s.source
"""


# ---- 5 quality rules ------------------------------------------------------------------


@_registered
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures, rule bits and verdicts of every document."""
    return quality.ledger(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality.verdict("base-1")).alias("base_failed"), quality.verdict("full-1").alias("kept"), "rule_bits",
    )


ORACLES["op5_quality_rules"] = rf"""
WITH base AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)),
                     lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM base)),
repeated AS (SELECT r, w FROM windows GROUP BY r, w HAVING count(*) > 1),
covered AS (
  SELECT r, count(DISTINCT i + k) AS n FROM windows JOIN repeated USING (r, w), (VALUES (0), (1), (2)) AS t(k)
  GROUP BY r),
measured AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
         CAST(len(regexp_extract_all(text, '[#*$%&|<>]')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n, 0) AS n_repeat_words,
         len(regexp_extract_all(text, '[A-Z]')) AS n_upper, len(regexp_extract_all(text, '[a-z]')) AS n_lower,
         len(regexp_extract_all(text, '!')) AS n_exclamations
  FROM base LEFT JOIN covered USING (r)),
judged AS (
  SELECT *, CAST((n_words < 50)::INT + 2 * (100 * n_repeat_words > 50 * n_words)::INT
         + 4 * (10 * n_symbols > 3 * n_words)::INT + 8 * (2 * n_dup_lines > n_lines)::INT
         + 16 * (n_upper > n_lower)::INT + 32 * (10 * n_exclamations > 3 * n_words)::INT
         + 64 * (word_chars < 2 * n_words OR word_chars > 15 * n_words)::INT AS BIGINT) AS rule_bits
  FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (rule_bits & 3) <> 0 AS base_failed, rule_bits = 0 AS kept, rule_bits
FROM judged
"""


# ---- 6 WARC derivatives ---------------------------------------------------------------


@_registered
def op6_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and conversion records of every page."""
    pages = table(spark, sf_dir, "pages")
    return warc.derive(warc.responses_of_pages(pages), keep=("page_id",)).select(
        "page_id", "record_type", "record_id", "refers_to", "target_uri", "content_type", "content_length",
        "block_digest", "source_digest", "source_headers", "block",
    )


def _uuid_sql(*parts: str) -> str:
    digest = f"md5({" || '|' || ".join(parts)})"
    cuts = " || '-' || ".join(f"substr({digest}, {a}, {n})" for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12)))
    return f"'urn:uuid:' || {cuts}"


def _decoded_sql(text: str) -> str:
    for name, character in warc.REFERENCES:
        text = f"replace({text}, {_quoted(name)}, {_quoted(character)})"
    return text


def _plain_sql(html: str) -> str:
    def swap(text: str, pattern: str, by: str) -> str:
        return f"regexp_replace({text}, {_quoted(pattern)}, {by}, 'g')"

    body = swap(html, warc.DROPPED, "' '")
    body = swap(swap(body, r"[\r\n]+", "' '"), warc.LINE_TAGS, "chr(10)")
    body = swap(_decoded_sql(swap(body, warc.OTHER_TAGS, "''")), r"[ \t]+", "' '")
    return f"trim({swap(swap(body, r" ?\n[ \n]*", "chr(10)"), r"^\n+|\n+$", "''")})"


ORACLES["op6_warc_derivatives"] = f"""
WITH responses AS (
  SELECT page_id, url AS target_uri, coalesce(html, '') AS payload,
         {_uuid_sql("'response'", "coalesce(CAST(page_id AS VARCHAR), '')", "coalesce(url, '')")} AS refers_to,
         'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' AS source_headers
  FROM pages),
made AS (
  SELECT *, {_uuid_sql("'conversion'", "refers_to")} AS conversion_id,
         {_uuid_sql("'metadata'", "refers_to")} AS metadata_id, {_plain_sql("payload")} AS plain,
         'sha256:' || sha256(payload) AS source_digest, chr(13) || chr(10) AS eol
  FROM responses),
records AS (
  SELECT page_id, 'conversion' AS record_type, conversion_id AS record_id, refers_to, target_uri,
         'text/plain; charset=utf-8' AS content_type, source_digest, source_headers, plain AS block FROM made
  UNION ALL
  SELECT page_id, 'metadata', metadata_id, refers_to, target_uri, 'application/warc-fields', source_digest,
         source_headers,
         'title: ' || trim(regexp_replace({_decoded_sql(f"regexp_extract(payload, {_quoted(warc.TITLE)}, 1)")}, '\\s+', ' ', 'g'))
         || eol || 'language: ' || regexp_extract(payload, {_quoted(warc.LANGUAGE)}, 1)
         || eol || 'outlinks: ' || CAST(len(regexp_extract_all(payload, {_quoted(warc.LINK)})) AS VARCHAR)
         || eol || 'conversion: <' || conversion_id || '>' || eol || 'source-digest: ' || source_digest
         || eol || 'source-header: ' || replace(source_headers, eol, eol || 'source-header: ') || eol
  FROM made)
SELECT page_id, record_type, record_id, refers_to, target_uri, content_type,
       CAST(strlen(block) AS BIGINT) AS content_length, 'sha256:' || sha256(block) AS block_digest, source_digest,
       source_headers, block
FROM records
"""


# ---- 7 nearest neighbours -------------------------------------------------------------


@_registered
def op7_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest rows by cosine of every row whose id is divisible by 50."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


# ---- 8 secrets ------------------------------------------------------------------------


@_registered
def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets in every document."""
    scanned = secrets.found(table(spark, sf_dir, "documents"))
    return scanned.select(
        "doc_id", *[secrets.counted("base", kind).alias(f"n_{kind}") for kind in secrets.KINDS[:3]], F.sha2(secrets.joined("base"), 256).alias("base_sha256"),
        secrets.joined("spans").alias("spans"))


# ---- 9 packing ------------------------------------------------------------------------


@_registered
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"))


# ---- 10 languages ---------------------------------------------------------------------


@_registered
def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return languages.identified(table(spark, sf_dir, "documents"))


# ---- 11 periodic runs -----------------------------------------------------------------


def planted(doc_id: int | None, words: list[str]) -> list[str]:
    """The words of a document whose tail is made periodic, in one of ten documents; NULL ids keep theirs."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    n, g = len(words), h // 10
    if h % 10 or not n:
        return words
    a = g % n
    root = words[a:a + 1 + (n - a) // (3 + g % 8)]
    return words[:a] + (root * -(-(n - a) // len(root)))[:n - a]


@_registered
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of every document, the one of the greatest exponent, and digests of runs and other words."""
    found = periodic.periodic_runs(table(spark, sf_dir, "documents"), planted)
    # runs are in the order that settles ties
    best = F.reduce(
        "runs", F.lit(None).cast(periodic.RUN), lambda held, run: F.when(
            held.isNull() | (run["length"] * held["period"] > held["length"] * run["period"]), run).otherwise(held))
    line = lambda run: F.concat_ws(",", run["start"], run["length"], run["period"])
    listed = F.array_join(F.transform("runs", lambda run: F.concat(line(run), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("bigint").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))


# ---- 12 quality classifier ------------------------------------------------------------


@_registered
def op12_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by votes of the nearest labelled ones, folds 1 to 4 of 5."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = voting.train(docs, labels.where(languages.fold(F.col("doc_id"), 5) != 0))
    scored = voting.scored(docs, model, languages.fold(F.col("doc_id"), 5) == 0)
    return scored.withColumn("predicted", F.when(F.col("score") >= 0.3, 1).otherwise(0))


# ---- 13 importance resampling ---------------------------------------------------------


@_registered
def op13_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tenth of the documents of 20 words or more, drawn towards the words of the benchmark."""
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return importance.resampled(docs, target, percent=10, least_words=20).select(
        "doc_id", "n_features", "weight", "score", "rank")
