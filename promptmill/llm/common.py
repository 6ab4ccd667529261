"""Small helpers the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HELD = "crc32(cast(coalesce(cast(doc_id as string), '') as binary)) % {mod} = {rest}"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def held_out(mod: int, rest: int, key: str = "doc_id"):
    """True where crc32 of the key as text leaves ``rest`` on division by ``mod``; a null key counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % mod == rest


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into pieces of few rows, so that what a task holds beside a batch stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def by_size(batches: Iterator[pa.RecordBatch], column: int, size: int) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut where the texts of a column reach ``size`` bytes."""
    import pyarrow.compute as pc
    for batch in batches:
        held = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(held, (held[at - 1] if at else 0) + size, "right")))
            yield batch.slice(at, to - at)
            at = to


def texts(column: pa.Array) -> list[str]:
    """The column's texts; null is the empty text."""
    return [t or "" for t in column.to_pylist()]


def arrow_schema(spark_schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string
    return to_arrow_schema(_parse_datatype_string(spark_schema))


def as_batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    """A batch from Python lists, numpy arrays or Arrow arrays in the order of the schema."""
    made = [c if isinstance(c, pa.Array) else pa.array(c, f.type, from_pandas=False) for c, f in zip(columns, schema)]
    return pa.RecordBatch.from_arrays(made, schema=schema)


Place = tuple[bool, int, int]


def place(doc_id: int | None, text_hash: int) -> Place:
    """Where a row stands in ascending doc_id order: rows without doc_id first, equal ones by a hash of their texts."""
    return doc_id is not None, doc_id or 0, text_hash


def range_starts(rows: DataFrame, rows_a_range: int, most: int) -> list[Place]:
    """First places, in order, of at most ``most`` ranges of about ``rows_a_range`` rows of (doc_id, hash); none for no rows."""
    ranges = max(1, min(most, rows.count() // rows_a_range))
    keys = rows.select(F.struct(F.col("doc_id").isNotNull().alias("known"), F.coalesce("doc_id", F.lit(0)).alias("id"), "hash").alias("key"))
    found = keys.repartitionByRange(ranges, "key").groupBy(F.spark_partition_id()).agg(F.min("key").alias("key")).collect()
    return sorted(tuple(r.key) for r in found)


def unused(name: str, taken: list[str]) -> str:
    """``name``, or that with marks in front, so that it is no column of ``taken`` in any case of letters."""
    known = {c.lower() for c in taken}
    while name.lower() in known:
        name = f"_{name}"
    return name


class Memo(dict):
    """word -> fn(word), computed once while the word is in use and forgotten beyond two generations of ``bound`` words."""

    def __init__(self, fn: Callable, bound: int = 200_000):
        super().__init__()
        self.fn, self.bound, self.old = fn, bound, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.fn(word)
        self[word] = value
        return value

    def turn(self) -> None:
        """Between two texts: start a new generation once this one is full."""
        if len(self) > self.bound:
            self.old = dict(self)
            self.clear()
