"""Nearest neighbours by inner product: a block matrix join with int8 tiles and exact rescoring.

Queries and candidates are packed into blocks of vectors.  A task joins one query block with one candidate block.
Vectors are quantised to int8 with a scale of their own; the product of two int8 matrices (exact in float32 while
127 * 127 * dim < 2^24, in float64 beyond) gives each inner product within a proven bound: with x = s a + u and
y = t b + v, where |u| <= s / 2 and |v| <= t / 2 in each component,
|xy - s t ab| <= (s |y|_1 + t |x|_1) / 2 + dim s t / 4.
A pair survives if its upper bound reaches the k-th best lower bound of its query in the tile.  Survivors are computed from
the original vectors in double precision, in order of the components, and the tile's k best of each query leave the task; the
tiles' lists are merged per query by a heap of k.  The result is exact: no candidate is left out without its bound.

Each candidate block meets each block of the stated queries once; nothing grows beyond a block in any task but the k
rows per query and tile.  Block sizes are bytes, so they hold for any dimension.

Defined results: vectors that are null, empty, all zero or hold a null, infinite or NaN component take no part, as rows or
as queries; vectors of other dimensions are no candidates; ties go to the smaller id; rows that repeat an id are candidates each, but a query's
own id is none of its candidates; repeated query rows of an id and vector give one answer, with different vectors the smallest vector asks;
null ids take no part; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema

QUERY_ROWS, BLOCK_BYTES, TILE, PAIRS = 1024, 2 << 20, 1 << 20, 1 << 16
ROOM = 1 + 1e-6  # the bounds' own rounding


def usable(df: DataFrame, key: str, vector: str) -> DataFrame:
    """id, v (array of double) of the rows that take part."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"))
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.filter(F.col("id").isNotNull() & F.coalesce(fine, F.lit(False)) & F.coalesce(F.exists("v", lambda x: x != 0), F.lit(False)))


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Rows of a partition packed into blocks of up to ``most`` vectors and BLOCK_BYTES: dim, ids and vectors as bytes."""
    out = arrow_schema("dim int, ids binary, vectors binary")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}

        def made(dim: int) -> pa.RecordBatch:
            ids, vectors = zip(*held.pop(dim))
            return pa.RecordBatch.from_arrays([pa.array([dim], pa.int32()), pa.array([np.concatenate(ids).tobytes()], pa.binary()),
                                               pa.array([np.concatenate(vectors).tobytes()], pa.binary())], schema=out)

        for b in batches:
            ids, lists = b.column(0).to_numpy(), b.column(1)
            size = lists.value_lengths().to_numpy()
            start, values = np.cumsum(size) - size, lists.flatten().to_numpy()
            for dim in np.unique(size).tolist():
                own = np.flatnonzero(size == dim)
                limit = max(1, min(most, BLOCK_BYTES // (8 * dim)))
                for at in range(0, own.size, limit):
                    piece = own[at:at + limit]
                    if dim in held and sum(x.size for x, _ in held[dim]) + piece.size > limit:
                        yield made(dim)
                    held.setdefault(dim, []).append((ids[piece], values[start[piece][:, None] + np.arange(dim)]))
        for dim in list(held):
            yield made(dim)

    return rows.mapInArrow(run, "dim int, ids binary, vectors binary")


def _quantised(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 values, scale and sum of sizes of each row."""
    scale = np.abs(m).max(axis=1) / 127
    scale = np.where(scale > 0, scale, 1.0)
    return np.rint(m / scale[:, None]).astype(np.int8), scale, np.abs(m).sum(axis=1)


def _exact(q: np.ndarray, c: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of the rows x of q and y of c, summed in order of the components."""
    total = np.zeros(x.size)
    for at in range(0, x.size, PAIRS):
        own = slice(at, at + PAIRS)
        a, b = q[x[own]], c[y[own]]
        with np.errstate(over="ignore", invalid="ignore"):
            for d in range(q.shape[1]):
                total[own] += a[:, d] * b[:, d]
    return total


def tile(q_ids: np.ndarray, q: np.ndarray, c_ids: np.ndarray, c: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Per query its id and the scores and ids of its k best candidates in the tile, best first, ties to the smaller id."""
    dim = q.shape[1]
    holds = np.float32 if 127 * 127 * dim < 1 << 24 else np.float64
    (qa, qs, q1), (ca, cs, c1) = _quantised(q), _quantised(c)
    ca = ca.astype(holds).T
    step = max(1, TILE // len(c))
    for at in range(0, len(q), step):
        rows = slice(at, at + step)
        with np.errstate(over="ignore", invalid="ignore"):
            scales = np.outer(qs[rows], cs)
            near = (qa[rows].astype(holds) @ ca).astype(np.float64) * scales
            error = ((np.outer(qs[rows], c1) + np.outer(q1[rows], cs)) / 2 + dim / 4 * scales) * ROOM
            low, high = near - error, near + error
        bounded = np.isfinite(low) & np.isfinite(high)
        if not bounded.all():  # beyond the range of doubles: nothing is known
            low, high = np.where(bounded, low, -np.inf), np.where(bounded, high, np.inf)
        own = q_ids[rows][:, None] == c_ids[None, :]
        low = np.where(own, -np.inf, low)
        least = np.partition(low, low.shape[1] - k, axis=1)[:, -k] if low.shape[1] > k else np.full(len(low), -np.inf)
        x, y = np.nonzero((high >= least[:, None]) & ~own)
        score = _exact(q[rows], c, x, y)
        order = np.lexsort((c_ids[y], -score, x))
        x, y, score = x[order], y[order], score[order]
        ends = np.searchsorted(x, np.arange(len(low) + 1))
        for i in range(len(low)):
            best = slice(ends[i], min(ends[i] + k, ends[i + 1]))
            if ends[i] < ends[i + 1]:
                yield int(q_ids[rows][i]), score[best], c_ids[y[best]]


def nearest(rows: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank (from 1), vec_id, score; both inputs are ``usable`` rows."""
    asked = queries.groupBy("id").agg(F.min("v").alias("v"))
    n, n_queries = rows.agg(F.coalesce(F.sum(F.size("v")), F.lit(0))).first()[0], queries.count()
    blocks = -(-8 * n // BLOCK_BYTES)
    q = _blocks(asked.repartition(max(1, -(-n_queries // QUERY_ROWS))), QUERY_ROWS).toDF("dim", "q_ids", "q")
    q = q.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(max(1, blocks) - 1))))
    c = _blocks(rows.repartition(max(1, blocks)), 1 << 30).toDF("dim", "c_ids", "c").withColumn("block", F.spark_partition_id())
    tiles = c.join(q, ["block", "dim"]).select("dim", "c_ids", "c", "q_ids", "q")
    out = arrow_schema("query_id long, scores array<double>, ids array<long>")

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                dim, *data = (b.column(i)[r].as_py() for i in range(5))
                c_ids, c, q_ids, q = (np.frombuffer(x, kind) for x, kind in zip(data, (np.int64, np.float64) * 2))
                found = list(tile(q_ids, q.reshape(-1, dim), c_ids, c.reshape(-1, dim), k))
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*found), out)], schema=out)

    ranked = arrow_schema("query_id long, rank int, vec_id long, score double")

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        query, heap = None, []

        def made() -> pa.RecordBatch:
            rows = [(query, n + 1, -i, s) for n, (s, i) in enumerate(sorted(heap, reverse=True))]
            return pa.RecordBatch.from_arrays([pa.array(list(x), f.type) for x, f in zip(zip(*rows), ranked)], schema=ranked)

        for b in batches:
            for i, scores, ids in zip(*(b.column(c).to_pylist() for c in range(3))):
                if i != query:
                    if heap:
                        yield made()
                    query, heap = i, []
                for s, v in zip(scores, ids):  # the worst of the k is on top of the heap
                    if len(heap) < k:
                        heapq.heappush(heap, (s, -v))
                    elif (s, -v) > heap[0]:
                        heapq.heapreplace(heap, (s, -v))
                    else:
                        break
        if heap:
            yield made()

    lists = tiles.mapInArrow(best, "query_id long, scores array<double>, ids array<long>")
    return (lists.repartition("query_id").sortWithinPartitions("query_id")
            .mapInArrow(merge, "query_id long, rank int, vec_id long, score double"))


def op4_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    rows = usable(spark.read.parquet(f"{sf}/embeddings.parquet"), "vec_id", "embedding")
    return nearest(rows, rows.filter("id % 20 = 0"))


SQL = """
WITH e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS score
           FROM e q JOIN e c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= 20
"""
