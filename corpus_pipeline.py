"""Corpus preparation as five stages over ``documents``; each stage's result is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from promptmill.llm import decontaminate, personal, pieces, quality, simhash
from promptmill.session import materialise

STAGES = [("quality", quality.stage), ("simhash_dedup", simhash.stage), ("decontaminate", decontaminate.stage),
          ("personal", personal.stage), ("pieces", pieces.stage)]

# The stages train models and run tokenizer libraries, which SQL cannot express; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
