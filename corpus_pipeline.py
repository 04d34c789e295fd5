"""The training-data pipeline: toxic texts out, repeated lines out, near copies out, personal data masked, packed.

``STAGES`` lists the stages in order. Each takes (spark, docs, sf_dir) and returns a DataFrame;
all but the last return the columns of ``documents``. ``run`` applies them to ``documents``,
each written to the shared folder and read again. Null ids and texts pass as each operator
states; an empty table passes as an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm import pii, toxicity
from gleanframe.llm.base import documents, stored
from gleanframe.llm.corpus_queries import TOKENIZER
from gleanframe.llm.jaccard import jaccard_components
from gleanframe.llm.lines import drop_repeated_lines
from gleanframe.llm.packing import pack

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _rewritten(rows: DataFrame, schema, column, text) -> DataFrame:
    """The columns of ``schema``, each by ``column(name)``, with another text and its length in code points."""
    new = {"text": text, "n_chars": F.char_length(text).cast(schema["n_chars"].dataType)}
    return rows.select(*[new.get(f.name, column(f.name)).alias(f.name) for f in schema])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the texts that the model predicts as toxic.

    A null text scores as an empty one. Repeated rows and rows with null ids are judged one by
    one; all columns stay as they are, and an empty table gives an empty one.
    """
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return docs.where(model.score(F.col("text")) < 0.5)


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the lines that many documents repeat.

    A null text stays null, an empty one empty. Repeated rows count as documents of their own,
    rows with null ids count and lose nothing; an empty table gives an empty one.
    """
    rows = drop_repeated_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.array_join("kept", "\n"))
    return _rewritten(rows, docs.schema, lambda name: F.col("row")[name], text)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Exactly one row of each component; rows without shingles are components of their own and stay.

    The row with the smallest id stays, of rows that share that id the one with the smallest
    hash of its text, and of rows that share both the first by its columns as JSON. Rows are
    told apart by id and text, so a unique text stays whatever its id. Null ids come last.
    Null and empty texts all stay; an empty table gives an empty one.
    """
    some_id = F.coalesce("doc_id", F.lit(0).cast(docs.schema["doc_id"].dataType))
    text = F.coalesce("text", F.lit(""))
    row_key = F.struct(F.col("doc_id").isNull().alias("missing"), some_id.alias("id"), F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"))
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), row_key.alias("row_key"))
    parts = jaccard_components(keyed.select("row_key", "row.text"), id_col="row_key").where("n_shingles > 0")
    counts = parts.groupBy(F.col("doc_id").alias("row_key"), "component_id").count()
    first = F.col("row_key") == F.col("component_id")
    fewer = stored(counts.where(~first | (F.col("count") > 1)).select("row_key", first.alias("first")), "near-copies")
    others = keyed.join(fewer, "row_key", "left_anti").select("row.*")
    repeated = keyed.join(fewer.where("first"), "row_key", "left_semi")
    one = repeated.groupBy("row_key").agg(F.min_by("row", F.to_json("row")).alias("row")).select("row.*")
    return others.unionByName(one)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data and secrets replaced by their kind in brackets.

    A null text stays null, an empty one empty. Rows are masked one by one, repeated ones and
    those with null ids too; an empty table gives an empty one.
    """
    masked = docs.withColumn("text", pii.redact(F.col("text"), pii.fit(docs)))
    return masked.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Places of all pieces in sequences.

    Null and empty texts are one closing id. Each row is packed, repeated ones and those with
    null ids too; an empty table gives an empty result.
    """
    return pack(docs, *TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_lines),
    ("ngram_jaccard", drop_near_copies),
    ("pii", mask_personal_data),
    ("packing", pack_sequences),
]

#: SQL cannot express the trained stages; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
