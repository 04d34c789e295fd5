"""Registered queries of the row-wise operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gleanframe.llm import bpe
from gleanframe.llm.base import documents
from gleanframe.llm.licenses import license_scan
from gleanframe.llm.quality import quality_rules
from gleanframe.llm.registry import query

QUALITY_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
    list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS x
  FROM documents),
tri AS (SELECT r, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c FROM (SELECT r, w, unnest(range(1, len(w) - 1)) AS i FROM d)),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS n FROM tri),
rep AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE n > 1) GROUP BY r),
m AS (
  SELECT d.r, doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(x) - len(list_distinct(x)) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words,
    len(list_filter(w, lambda v: lower(v[1]) || v[2:] IN (
      'the','of','and','to','in','a','is','that','it','was','for','on','are','as','with','be','at','by','this','from',
      'or','an','not','le','la','les','de','des','et','en','un','une','du','est','que','qui','dans','pour','pas','sur',
      'au','avec','il','elle','der','die','das','und','den','von','zu','mit','sich','auf','ist','im','dem','nicht',
      'ein','eine','als','auch','es','el','los','las','y','del','se','con','por','para','su','no','lo','como','al'))) AS stop,
    len(x) AS lines, len(list_filter(x, lambda v: ltrim(v, ' ')[1] IN ('-', '*', '•'))) AS bullets,
    len(list_filter(x, lambda v: ends_with(rtrim(v, ' '), '...') OR ends_with(rtrim(v, ' '), '…'))) AS dots
  FROM d LEFT JOIN rep USING (r)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND word_chars BETWEEN 2 * n_words AND 15 * n_words AND 10 * n_symbols <= 3 * n_words
    AND 100 * stop >= 3 * n_words AND 10 * n_dup_lines <= 4 * lines AND 10 * bullets <= 9 * lines AND 10 * dots <= 3 * lines AS kept
FROM b
"""


@query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query("op10_byte_bpe")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(
        documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    )


@query("op9_license_scans")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir))
