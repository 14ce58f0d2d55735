"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontam, langid, neardup, packing, pii, pitmanyor, quality, toktransducer, toxicity, warc
from .common import table

PII_KEY = "not-secret"  # of the queries over public test data; users bring their own
Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity_bigru(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(packing.TOKENIZER))


def op3_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.replace_entities(table(spark, sf_dir, "documents").select("doc_id", "text"), PII_KEY)


def op4_warc_capture_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.capture(table(spark, sf_dir, "pages"))


def op5_minhash_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_transducer_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toktransducer.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(toktransducer.TOKENIZER))


def op7_spaced_seed_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), decontam.SHARE)


def op8_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "pages"), langid.fit(table(spark, sf_dir, "documents")))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.judge(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op10_pitman_yor_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pitmanyor.scores(table(spark, sf_dir, "documents"))


def quality_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts of op9 and their fixed rules, without the learned ones."""
    counts = quality.statistics(table(spark, sf_dir, "documents"))
    return counts.select("doc_id", *quality.COUNTS, quality.base_failed().alias("base_failed"))


QUERIES = (
    op1_toxicity_bigru, op2_best_fit_packing, op3_pii_surrogates, op4_warc_capture_index, op5_minhash_neardup,
    op6_transducer_token_counts, op7_spaced_seed_decontamination,
    op8_language_fusion, op9_quality_rules, op10_pitman_yor_scores, quality_base,
)


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in QUERIES}


#: SHA-1 in base32: 40 hex digits to 160 bits, read five at a time.
_OP4_SQL = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
h AS (SELECT page_id, octet_length(body) AS payload_bytes, sha1(body) AS hex FROM p),
b AS (SELECT page_id, payload_bytes, hex, array_to_string(list_transform(range(1, 41), lambda i: substr('0000000100100011010001010110011110001001101010111100110111101111', 4 * (strpos('0123456789abcdef', substr(hex, i::BIGINT, 1)) - 1) + 1, 4)), '') AS bits FROM h),
d AS (SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1
    + 16 * substr(bits, (5 * i + 1)::BIGINT, 1)::INT + 8 * substr(bits, (5 * i + 2)::BIGINT, 1)::INT + 4 * substr(bits, (5 * i + 3)::BIGINT, 1)::INT
    + 2 * substr(bits, (5 * i + 4)::BIGINT, 1)::INT + substr(bits, (5 * i + 5)::BIGINT, 1)::INT, 1)), '') AS payload_digest FROM b),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to FROM f
"""

#: Exact similarity of all sets that share a shingle, then reachability.
_OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [md5(array_to_string(words, ' '))]
    ELSE list_distinct(list_transform(range(1, len(words) - 3), lambda i: md5(array_to_string(words[i:i + 4], ' ')))) END AS shingles FROM w),
n AS (SELECT doc_id, len(shingles) AS size, md5(array_to_string(list_sort(shingles), ',')) AS whole, shingles FROM s),
c AS (SELECT whole, min(doc_id) AS rep, any_value(size) AS size, any_value(shingles) AS shingles FROM n WHERE size > 0 GROUP BY whole),
e AS (SELECT rep, size, unnest(shingles) AS g FROM c),
l AS (SELECT a.rep AS x, b.rep AS y FROM e a JOIN e b ON a.g = b.g AND a.rep <> b.rep AND 100 * least(a.size, b.size) >= 85 * greatest(a.size, b.size)
    GROUP BY a.rep, b.rep, a.size, b.size HAVING 100 * count(*) >= 85 * (a.size + b.size - count(*))),
r(x, y) AS (SELECT rep, rep FROM c UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y),
k AS (SELECT x, min(y) AS component FROM r GROUP BY x)
SELECT n.doc_id, n.size::BIGINT AS n_shingles, coalesce(k.component, n.doc_id) AS component_id, coalesce(k.component, n.doc_id) = n.doc_id AS kept
FROM n LEFT JOIN c ON c.whole = n.whole AND n.size > 0 LEFT JOIN k ON k.x = c.rep
"""


#: Words, symbols and repeated lines and windows of whole texts.
_BASE_SQL = r"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
h AS (SELECT doc_id, unnest(list_transform(range(1, len(words) - 3), lambda i: md5(array_to_string(words[i:i + 4], ' ')))) AS h, unnest(range(1, len(words) - 3)) AS p FROM w WHERE len(words) >= 5),
r AS (SELECT doc_id, p FROM h QUALIFY count(*) OVER (PARTITION BY doc_id, h) > 1),
c AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM r, range(5) x(k) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
b AS (SELECT w.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words FROM w JOIN l USING (doc_id) LEFT JOIN c USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_warc_capture_index": _OP4_SQL, "op5_minhash_neardup": _OP5_SQL, "quality_base": _BASE_SQL}
