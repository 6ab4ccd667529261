"""Shards, splits, samples and orders; every choice is fixed by seed and key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.text import col_of
from promptmill.operators.order import chunk_of, ordinal, shuffle_key, shuffled_ordinal, unit_interval
from promptmill.session import materialise


def shard(df: DataFrame, key: str, shards: int, index: int, seed: int = 42) -> DataFrame:
    """Shard ``index`` of ``shards`` after a seeded shuffle.

    The test reads only the key, so it is applied at the scan, before any text work.
    """
    return df.filter(shard_of(key, shards, seed) == index)


def shard_of(key: str, shards: int, seed: int = 42) -> Column:
    return F.conv(F.substring(shuffle_key(seed, key), 1, 8), 16, 10).cast("long") % shards


def exact_shard(df: DataFrame, shards: int, index: int, ordinal_col: str = "ordinal") -> DataFrame:
    """Every ``shards``-th row of a numbered table: shard sizes differ by one at most."""
    return df.filter(F.col(ordinal_col) % shards == index)


def test_rows(total: Column, size: float) -> Column:
    """Rows in the test part: a size above 1 is a count, otherwise a fraction, rounded up."""
    return F.lit(int(size)).cast("long") if size > 1 else F.ceil(total * F.lit(size)).cast("long")


def ordered_split(df: DataFrame, key: str, test_size: float, out: str = "split") -> DataFrame:
    """No shuffle: the tail in key order is test."""
    numbered = ordinal(df, key)
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return _cut(numbered, total, test_size, out)


def random_split(df: DataFrame, key: str, test_size: float, seed: int = 42, out: str = "split") -> DataFrame:
    """Each row falls by a threshold on its hash; no shuffle of data at all."""
    return df.withColumn(out, F.when(unit_interval(seed, key) < test_size, "test").otherwise("train"))


def exact_split(df: DataFrame, key: str, test_size: float, seed: int = 42, out: str = "split") -> DataFrame:
    """Exactly the wanted number of test rows, taken from a seeded shuffle."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return _cut(shuffled_ordinal(df, seed, key), total, test_size, out)


def _cut(numbered: DataFrame, total: DataFrame, test_size: float, out: str) -> DataFrame:
    n = total.scalar()
    return numbered.withColumn(out, F.when(F.col("ordinal") >= n - test_rows(n, test_size), "test")
                               .otherwise("train")).drop("ordinal")


def head(df: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows in key order; a top-n per task, then of the tasks."""
    return df.orderBy(key).limit(n)


def sample_exactly(df: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    return df.orderBy(shuffle_key(seed, key), key).limit(n)


def take_skip(df: DataFrame, key: str, n: int, out: str = "split") -> DataFrame:
    """The first n rows validate, the rest train."""
    return ordinal(df, key).withColumn(out, F.when(F.col("ordinal") < n, "valid").otherwise("train")).drop("ordinal")


def buffered_shuffle(df: DataFrame, key: str, buffer: int, seed: int = 42, out: str = "place") -> DataFrame:
    """Order after shuffling inside consecutive windows of ``buffer`` rows."""
    numbered = ordinal(df, key).withColumn("_w", chunk_of("ordinal", buffer))
    inside = F.row_number().over(Window.partitionBy("_w").orderBy(shuffle_key(seed, key), key))
    return numbered.withColumn(out, F.col("_w") * buffer + inside - 1).drop("ordinal", "_w")


def curriculum(df: DataFrame, length: str, key: str, partitions: int | None = None) -> DataFrame:
    """Rows in order of length: range partitions, each sorted; read one after the other."""
    ranged = (df.repartitionByRange(partitions, length, key) if partitions else df.repartitionByRange(length, key))
    return ranged.sortWithinPartitions(length, key)


def group_length(kind: str) -> Column:
    """Characters that length grouping compares."""
    if kind == "pair":
        return F.length("input") + F.length("output")
    if kind == "text":
        return F.length("text")
    if kind == "messages":
        return F.aggregate("messages", F.lit(0), lambda s, m: (s + F.length(m["content"])).cast("int"))
    if kind == "pair_max":
        return F.greatest(F.length("chosen"), F.length("rejected"))
    raise ValueError(f"unknown length kind {kind!r}")


def repeated(df: DataFrame, tries: int, out: str = "try") -> DataFrame:
    """Every row once per try."""
    return df.withColumn(out, F.explode(F.sequence(F.lit(1), F.lit(tries))))


def dictionary(keys: DataFrame, key: str, out: str = "index", seed: int = 0) -> DataFrame:
    """Distinct keys with a dense index in hash order; duplicates combine before the shuffle."""
    return shuffled_ordinal(keys.select(key).distinct(), seed, key, out=out)


BROADCAST_BYTES = 8 << 20


def encode_keys(df: DataFrame, index: DataFrame, key: str, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """The index joined back.

    The dictionary is written out and measured; up to ``broadcast_bytes`` of keys and numbers it is broadcast,
    beyond that both sides are shuffled and AQE splits a hot key.
    """
    written = materialise(index, "dictionary")
    size = written.agg(F.coalesce(F.sum(F.octet_length(F.col(key).cast("string")) + 16), F.lit(0))).first()[0]
    return df.join(F.broadcast(written) if size <= broadcast_bytes else written.hint("merge"), key)


def batches(df: DataFrame, key: str, size: int, out: str = "batch") -> DataFrame:
    return ordinal(df, key).withColumn(out, chunk_of("ordinal", size))


def bands(length: Column | str, width: int) -> Column:
    return F.floor(col_of(length) / width).cast("long")
