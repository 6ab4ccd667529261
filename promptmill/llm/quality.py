"""Quality classifier: linear SVM over n-gram indicators scaled by naive Bayes log-count ratios.

Words stand between ASCII white space.  Indicators of a text: its lower-cased words, and 1- to 3-grams of word shapes
(runs of letters and digits stand for themselves by case, other characters are kept), where a word equal to the one
before it has the shape "repeat".  They are hashed into 2^18 columns.  Each indicator is scaled by the log ratio of its
smoothed share in either class; a hinge-loss model is fitted by dual coordinate descent, mixed with the mean weight
size, and its margin turned into a probability by a logistic curve.

At ``mix`` = 1 the weights are the model's own.

The fit takes at most ``rows`` labelled documents, those with the smallest hash of doc_id; scoring is one pass over all
whole texts without a shuffle.

Defined results: a null text counts as empty; an empty text is scored by the always-on column alone; of several labels
of a doc_id the smallest counts, of several texts of a sampled doc_id one; null labels are ignored; with fewer than two
classes every score is the smoothed share of label 1; repeated rows are scored each; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import Memo, arrow_schema, as_batch, documents, held_out, slices, texts

BITS = 18
SAMPLE = 12_000
_RUN = re.compile(r"[^\W\d_]+|\d+")


def _kind(w: str) -> str:
    return "a" if w.islower() else "A" if w.isupper() and len(w) > 1 else "Aa" if w.isalpha() else "0"


def _shape_code(shape: str) -> int:
    return zlib.crc32(shape.encode()) >> 9


_PLAIN = {k: _shape_code(k) for k in ("a", "A", "Aa", "0")}


def _code(word: bytes) -> int:
    """41 bits for the lower-cased word, 23 bits for its shape."""
    t = word.decode()
    shape = _PLAIN[_kind(t)] if t.isalpha() else _shape_code(_RUN.sub(lambda run: _kind(run[0]), t)[:12])
    return xxhash.xxh64_intdigest(t.lower().encode()) >> 23 << 23 | shape


_CODES = Memo(_code)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def indicators(text: str) -> np.ndarray:
    """The columns set for a text, ascending; column 0 always is."""
    words = text.encode().split()
    _CODES.turn()
    code = np.fromiter(map(_CODES.__getitem__, words), np.uint64, len(words))
    word, shape = code >> np.uint64(23), code & np.uint64((1 << 23) - 1)
    shape[1:][word[1:] == word[:-1]] = 1
    grams, so_far = [np.unique(word)], np.zeros(len(words), np.uint64)
    for n in range(1, 4):
        if len(words) >= n:
            so_far = (so_far[:len(words) - n + 1] + shape[n - 1:] + np.uint64(n << 24)) * _MIX
            grams.append(np.unique(so_far))
    mixed = np.concatenate(grams) * _MIX
    return np.unique(np.append((mixed >> np.uint64(64 - BITS)).astype(np.int32), np.int32(0)))


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float

    def score(self, columns: np.ndarray) -> float:
        x = self.slope * float(self.weights[columns].sum(dtype=np.float64)) + self.offset
        return float(1 / (1 + np.exp(-np.clip(x, -500, 500))))


def _dual_coordinate_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: float, rounds: int) -> np.ndarray:
    """Weights of the hinge-loss model over the scaled indicators: one dual variable per row, solved one at a time."""
    w, alpha = np.zeros(scale.size), np.zeros(len(rows))
    values = [scale[r] for r in rows]
    norm = np.array([max(float(v @ v), 1e-12) for v in values])
    order = np.random.default_rng(7)
    for _ in range(rounds):
        most = 0.0
        for i in order.permutation(len(rows)):
            slope = y[i] * float(w[rows[i]] @ values[i]) - 1
            new = min(max(alpha[i] - slope / norm[i], 0.0), cost)
            if new != alpha[i]:
                most = max(most, abs(new - alpha[i]) * norm[i] ** 0.5)
                w[rows[i]] += (new - alpha[i]) * y[i] * values[i]
                alpha[i] = new
        if most < 1e-3:
            break
    return w


def _logistic(margin: np.ndarray, good: np.ndarray) -> tuple[float, float]:
    """Slope and offset of the probability of label 1, by Newton steps; targets kept off 0 and 1 by a pseudo-row each."""
    n1, n0 = good.sum(), (~good).sum()
    target = np.where(good, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        g = np.array([((p - target) * margin).sum(), (p - target).sum()])
        v = p * (1 - p) + 1e-9
        h = np.array([[(v * margin * margin).sum() + 1e-6, (v * margin).sum()], [(v * margin).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2 / max(1e-12, float(np.abs(step).max())))
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-7:
            break
    return float(a), float(b)


def train(rows: list[np.ndarray], good: np.ndarray, cost: float = 1.0, mix: float = 1.0, rounds: int = 30) -> Model:
    n1, n0 = int(good.sum()), int((~good).sum())
    if not n1 or not n0:
        share = (n1 + 1) / (n1 + n0 + 2)
        return Model(np.zeros(1 << BITS, np.float32), 0.0, float(np.log(share / (1 - share))))
    count = np.ones((2, 1 << BITS))
    for r, g in zip(rows, good):
        count[int(g), r] += 1
    share = count / count.sum(axis=1, keepdims=True)
    ratio = np.log(share[1] / share[0])
    ratio[count.sum(axis=0) == 2] = 0  # seen in no row
    ratio[0] = 1.0
    w = _dual_coordinate_descent(rows, ratio, np.where(good, 1.0, -1.0), cost, rounds)
    w = ((1 - mix) * np.abs(w).sum() / max(1, np.count_nonzero(w)) + mix * w) * ratio
    w = w.astype(np.float32)
    margin = np.array([w[r].sum(dtype=np.float64) for r in rows])
    return Model(w, *_logistic(margin, good))


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = SAMPLE) -> Model:
    """``docs`` has doc_id and text, ``labels`` doc_id and the label; at most ``rows`` labelled documents are read."""
    sample = (labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
              .groupBy("doc_id").agg(F.min(label).cast("int").alias("good"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    picked = docs.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(sample), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = pa.array([indicators(t).tobytes() for t in texts(b.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), made], names=["doc_id", "good", "set"])

    kind = picked.schema["doc_id"].dataType.simpleString()
    found = (picked.select("doc_id", "text", "good").mapInArrow(run, f"doc_id {kind}, good int, set binary")
             .groupBy("doc_id").agg(F.min("good").alias("good"), F.min("set").alias("set")).toPandas())
    found = found.sort_values("doc_id")
    return train([np.frombuffer(s, np.int32) for s in found["set"]], found["good"].to_numpy() == 1)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id and score of every row."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = pa.array([model.score(indicators(t)) for t in texts(b.column(1))], pa.float64())
            yield pa.RecordBatch.from_arrays([b.column(0), made], names=["doc_id", "score"])

    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(run, f"doc_id {kind}, score double")


def op1_quality(spark: SparkSession, sf: str) -> DataFrame:
    docs, labels = documents(spark, sf), spark.read.parquet(f"{sf}/labels.parquet")
    scored = score(docs, fit(docs, labels.filter(~held_out(4, 2))))
    return scored.select("doc_id", held_out(4, 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The rows whose text scores at least 0.7, with all their columns."""
    model = fit(docs, spark.read.parquet(f"{sf}/labels.parquet").filter(~held_out(4, 2)))
    schema = docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            good = [model.score(indicators(t)) >= 0.7 for t in texts(b.column(b.schema.names.index("text")))]
            yield b.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(run, schema)
