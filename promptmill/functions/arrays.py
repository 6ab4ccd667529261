"""Array expressions that stay linear in the array's length."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK = 256


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once.

    An expression used twice is evaluated twice when it holds a lambda, because
    common-subexpression elimination does not see through lambda variables.
    """
    return F.transform(F.array(value), body)[0]


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Adds columns that are computed once per row, whatever reads them later.

    The one-element explode keeps the optimizer from copying a costly expression
    into filters and projections above it.
    """
    packed = F.struct(*[c.alias(n) for n, c in columns.items()])
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.explode(F.array(packed)).alias("_once")).select(
        *kept, *[F.col(f"_once.{n}").alias(n) for n in columns])


def indices(a: Column) -> Column:
    """0 .. size-1, empty for an empty array."""
    return F.when(F.size(a) > 0, F.sequence(F.lit(0), F.size(a) - 1)).otherwise(F.array().cast("array<int>"))


def _running(a: Column, first: Column) -> Column:
    """Exclusive running sums of a short array, starting at ``first``."""
    return F.aggregate(
        a, F.struct(F.array().cast("array<int>").alias("out"), first.cast("int").alias("total")),
        lambda s, x: F.struct(F.concat(s["out"], F.array(s["total"])).alias("out"),
                              (s["total"] + x).cast("int").alias("total")),
        lambda s: s["out"])


def running_starts(a: Column) -> Column:
    """Exclusive running sums of an int array, in blocks so that the fold never copies a long array."""
    n = F.size(a)
    blocks = F.when(n > 0, F.transform(F.sequence(F.lit(0), F.floor((n - 1) / BLOCK).cast("int")),
                                       lambda b: F.slice(a, b * BLOCK + 1, BLOCK)))
    blocks = F.coalesce(blocks, F.array().cast("array<array<int>>"))
    total = F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda s, x: (s + x).cast("int")))
    pairs = F.arrays_zip(blocks.alias("items"), _running(total, F.lit(0)).alias("first"))
    return F.flatten(F.transform(pairs, lambda p: _running(p["items"], p["first"])))
