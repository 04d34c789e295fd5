"""Registered queries of the operators that train a model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanframe.llm import pii, toxicity
from gleanframe.llm.base import documents
from gleanframe.llm.registry import query


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = docs.select(
        "doc_id", (toxicity.fold(F.col("doc_id")) == 0).alias("held_out"), model.score(F.col("text")).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


@query("op8_pii")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return pii.find_pii(docs, pii.fit(docs))
