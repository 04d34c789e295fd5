"""Registered queries of the operators that compare documents."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm import fingerprint as fp
from gleanframe.llm.base import documents
from gleanframe.llm.jaccard import jaccard_components
from gleanframe.llm.lines import drop_repeated_lines
from gleanframe.llm.packing import pack
from gleanframe.llm.registry import query
from gleanframe.llm.suffixes import remove_repeats

LINES_SQL = r"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
l AS (
  SELECT doc_id, i, x[i] AS line, translate(regexp_replace(x[i], '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
  FROM (SELECT doc_id, x, unnest(range(1, len(x) + 1)) AS i FROM d)),
f AS (SELECT k, max(doc_id) AS last FROM l WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (doc_id < last) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (last IS NULL OR doc_id = last), '')) AS kept_sha256
FROM l LEFT JOIN f USING (k) GROUP BY doc_id
"""


@query("op3_line_dedup", LINES_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = lambda c: F.size(c).cast("long")
    return drop_repeated_lines(documents(spark, sf_dir)).select(
        F.col("row.doc_id").alias("doc_id"),
        n("lines").alias("n_lines"),
        (n("lines") - n("kept")).alias("n_dropped"),
        F.sha2(F.array_join("kept", "\n"), 256).alias("kept_sha256"),
    )


@query("op6_fingerprints")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    own, edited, after = F.col("sketch"), F.col("edited_sketch"), F.col("next_sketch")
    return fp.fingerprints(documents(spark, sf_dir)).select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        fp.as_text(own).alias("fingerprint"),
        fp.as_text(edited).alias("edited_fingerprint"),
        fp.resemblance(own, edited).alias("near_edited"),
        fp.resemblance(own, after).alias("near_next"),
    )


JACCARD_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
r AS (SELECT doc_id, doc_id AS reach FROM d UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.reach = e.a)
SELECT doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach) AS component_id FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""


@query("op7_ngram_jaccard", JACCARD_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir))


TOKENIZER = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.path("byte_bpe_50k.tiktoken"),
    public_tokenizers.PATTERN,
)


@query("op5_best_fit_packing")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), *TOKENIZER)


@query("op1_suffix_array_dedup")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return remove_repeats(documents(spark, sf_dir)).select(
        "doc_id",
        "n_bytes",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )
