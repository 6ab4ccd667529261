"""Total orders without a single-task sort: seeded shuffles and dense row numbers.

A dense number over N rows never comes from an unpartitioned window.  Rows fall
into buckets whose size has a bound, buckets are counted (map-side combine),
bucket offsets are a running sum over the small count table, and the number
inside a bucket is a window over that bucket only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.text import col_of

BUCKET_BITS = 16


def shuffle_key(seed: int | str, *keys: Column | str) -> Column:
    """A text whose order is a seeded shuffle; the same on any cluster size."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[col_of(k).cast("string") for k in keys]))


def unit_interval(seed: int | str, *keys: Column | str) -> Column:
    """A number in [0, 1) fixed by seed and key, in place of a random draw."""
    return F.conv(F.substring(shuffle_key(seed, *keys), 1, 7), 16, 10).cast("double") / F.lit(float(16 ** 7))


def _running_start(counts: DataFrame, bucket: str, levels: int) -> DataFrame:
    """(bucket, start): rows in all earlier buckets.

    With ``levels`` > 0 the running sum itself is cut into ranges of 2**16
    buckets, so no task sees more than 2**16 counts.
    """
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    if levels == 0:
        return counts.select(bucket, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    upper = f"{bucket}u"
    ranged = counts.withColumn(upper, F.shiftright(bucket, BUCKET_BITS))
    above = _running_start(ranged.groupBy(upper).agg(F.sum("n").alias("n")), upper, levels - 1)
    within = Window.partitionBy(upper).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    inside = ranged.select(bucket, upper, F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside"))
    return inside.join(above, upper).select(bucket, (F.col("inside") + F.col("start")).alias("start"))


def _number(bucketed: DataFrame, bucket: str, order: list[Column], levels: int, out: str) -> DataFrame:
    counts = bucketed.groupBy(bucket).agg(F.count(F.lit(1)).alias("n"))
    starts = _running_start(counts, bucket, levels)
    inside = F.row_number().over(Window.partitionBy(bucket).orderBy(*order))
    return (bucketed.join(starts, bucket)
            .withColumn(out, F.col("start") + inside - 1)
            .drop(bucket, "start"))


def key_levels(df: DataFrame, key: str) -> int:
    """How often bucket counts must be cut into ranges so that one task sums up at most 2**17 of them."""
    low, high = df.agg(F.min(F.col(key).cast("long")), F.max(F.col(key).cast("long"))).first()
    bits = max((abs(x).bit_length() for x in (low, high) if x is not None), default=0)
    return max(0, -(-bits // BUCKET_BITS) - 2)


def ordinal(df: DataFrame, key: str, out: str = "ordinal", levels: int | None = None) -> DataFrame:
    """Dense 0-based number in the order of a unique integer ``key`` that is never null.

    A bucket is a range of 2**16 key values, so it holds at most 2**16 rows however
    the keys are spread.  ``levels`` follows from the largest key: 0 below 2**32, 1 below 2**48, 2 for all 64 bits.
    """
    levels = key_levels(df, key) if levels is None else levels
    bucketed = df.withColumn("_b", F.shiftright(F.col(key).cast("long"), BUCKET_BITS))
    return _number(bucketed, "_b", [F.col(key)], levels, out)


def shuffled_ordinal(df: DataFrame, seed: int | str, *keys: str, out: str = "ordinal",
                     digits: int = 4) -> DataFrame:
    """Dense 0-based number in seeded shuffle order.

    Buckets are the leading hex digits of an md5 over a unique key: 16**digits
    buckets of equal expected size, whose count table (65,536 rows by default) is all
    that one task ever sums up.
    """
    keyed = df.withColumn("_h", shuffle_key(seed, *keys)).withColumn("_b", F.substring("_h", 1, digits))
    return _number(keyed, "_b", [F.col("_h"), *[F.col(k) for k in keys]], 0, out).drop("_h")


def shuffled(df: DataFrame, seed: int | str, *keys: str) -> DataFrame:
    """Seeded global shuffle: a range-partitioned sort by hash."""
    return df.orderBy(shuffle_key(seed, *keys), *keys)


def ranked(df: DataFrame, group: str, ordinal_col: str, out: str = "rank", chunk_rows: int = 10_000) -> DataFrame:
    """Number of each row in its ``group``, from 0 in the order of a dense ``ordinal_col``; a hot group is counted in chunks of the order."""
    cut = df.withColumn("_c", chunk_of(ordinal_col, chunk_rows))
    counts = cut.groupBy(group, "_c").agg(F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_c")) - F.col("_n")
    starts = counts.select(group, "_c", before.alias("_start"))
    inside = F.row_number().over(Window.partitionBy(group, "_c").orderBy(ordinal_col)) - 1
    return cut.withColumn("_inside", inside).join(starts, [group, "_c"]).withColumn(out, F.col("_start") + F.col("_inside")).drop("_c", "_start", "_inside")


def chunk_of(ordinal_col: Column | str, size: int) -> Column:
    return F.floor(col_of(ordinal_col) / F.lit(size)).cast("long")
