"""Exact dedup and set operations on row hashes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.session import materialise


def row_text(*columns: str) -> Column:
    """The row as JSON: field names and null stay apart from text."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def row_hash(*columns: str) -> Column:
    return F.sha2(row_text(*columns), 256)


def dedup(df: DataFrame, key: str, columns: list[str] | None = None, hashed: Column | None = None) -> DataFrame:
    """One row per distinct content: the one with the smallest ``key``.

    (hash, key) goes through the first aggregate, and equal hashes combine before the shuffle, so a content that fills a
    third of the table costs one row per task.  Rows whose hash is not theirs alone are compared: a second aggregate over those
    takes the content itself as its key, again combined before the shuffle, so equal copies send one text per
    task and different rows with an equal hash all stay.  The kept keys then pick whole rows by a semi join on the unique key.
    ``hashed`` replaces the hash, for tests.
    """
    content = columns or [c for c in df.columns if c != key]
    own = row_hash(*content) if hashed is None else hashed
    groups = materialise(df.groupBy(own.alias("_hash")).agg(F.min(key).alias(key), F.count(F.lit(1)).alias("_n")), "row-hashes")
    shared = df.withColumn("_hash", own).join(groups.filter("_n > 1").select("_hash"), "_hash", "left_semi")
    compared = shared.groupBy("_hash", row_text(*content).alias("_row")).agg(F.min(key).alias(key))
    kept = groups.filter("_n = 1").select(key).unionByName(compared.select(key))
    return df.join(kept, key, "left_semi")


def cross_dedup(train: DataFrame, evaluation: DataFrame, key: str,
                columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Both splits deduplicated, and evaluation without any content of train.

    One aggregate over both splits gives the kept key of each side; these pairs of keys are written once for both.
    """
    content = columns or [c for c in train.columns if c != key]

    def hashes(df: DataFrame, side: int) -> DataFrame:
        return df.select(row_hash(*content).alias("_hash"), F.col(key), F.lit(side).alias("_side"))

    both = materialise(hashes(train, 0).unionByName(hashes(evaluation, 1)).groupBy("_hash").agg(
        F.min(F.when(F.col("_side") == 0, F.col(key))).alias("train"),
        F.min(F.when(F.col("_side") == 1, F.col(key))).alias("evaluation")).drop("_hash"), "kept-keys")
    keep_train = both.filter(F.col("train").isNotNull()).select(F.col("train").alias(key))
    keep_eval = both.filter(F.col("train").isNull()).select(F.col("evaluation").alias(key))
    return train.join(keep_train, key, "left_semi"), evaluation.join(keep_eval, key, "left_semi")


def union_all(parts: list[DataFrame]) -> DataFrame:
    """Bag union by column name; a column one part lacks is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def key_set(parts: list[DataFrame], key: str) -> DataFrame:
    return union_all([p.select(key) for p in parts]).distinct()
