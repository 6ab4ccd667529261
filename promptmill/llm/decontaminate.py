"""Benchmark decontamination: a BM25 inverted index of the test items, queried with every passage of every document.

Words are runs of letters, digits and underscores, lower-cased.  An item is indexed as segments of its answer, runs of at
most four five-word shingles (eight words) that share none, and a document is queried as passages of 64 words that start
every 32.  Weights are divided by the segment's score for itself, so the threshold is a share of a full match.
Retrieval takes every segment whose score for a passage reaches the threshold, with no limit on their number, and loses
no item that the verification would keep: if 0.8 of the answer's shingles stand anywhere in a document, then so does 0.8
of some segment's, which of four or fewer is all; its first and last shingle cover the segment, so one of them holds half of the
weight or more; and a shingle's words lie in one passage.  Texts that hold no shingle of any answer, by hash codes of
shingles, are not looked at further.


* bounds from block maxima (BLOCK segments a block) are added up for all passages of an Arrow batch at once; the most frequent
  terms, which together hold at most ``SLACK`` of any segment, are not looked up but allowed for in each block's bound;
* where a block may reach the threshold, block-max WAND runs over the passage's terms from that block on, to the next block
  that can not.

Each retrieved item is then verified against the document: five-word shingles of the question (all but the last quarter
of the words) and of the answer (the last quarter, five words at least) must both be found at 0.8 or more.

The index is cut into shards of a bounded number of characters (``SHARD_CHARS``) with document frequencies counted over
all items; each shard is one pass over the documents, so what a task holds stays bounded however large the benchmark is.

Defined results: null and blank texts hold nothing; an item without words is never found; an item of fewer than ten words
is its own question and answer, and one under five words a single shingle; repeated items and documents are rows of their
own; other columns are not read; an empty benchmark or table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, documents, slices, texts
from promptmill.session import materialise

HALF, BLOCK, TOGETHER = 32, 4, 4
K1, B = 1.2, 0.75
THRESHOLD, SLACK, OVERLAP, SHINGLE = 0.5, 0.3, 0.8, 5
SHARD_CHARS = 8_000_000
_WORD = re.compile(r"\w+")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words(text: str) -> list[str]:
    return _WORD.findall(text.lower())


def shingles(own: list[str]) -> set[tuple[str, ...]]:
    return {tuple(own[i:i + SHINGLE]) for i in range(max(1, len(own) - SHINGLE + 1))} if own else set()


def question_answer(own: list[str]) -> tuple[list[str], list[str]]:
    if len(own) < 2 * SHINGLE:
        return own, own
    cut = len(own) - max(SHINGLE, len(own) // 4)
    return own[:cut], own[cut:]


def segments(own: list[str]) -> list[list[str]]:
    """The words of the answer in runs of at most TOGETHER shingles; a shingle that repeats counts where it stands first."""
    own = question_answer(own)[1]
    seen, runs = set(), []
    for i in range(max(1, len(own) - SHINGLE + 1) if own else 0):
        shingle = tuple(own[i:i + SHINGLE])
        if shingle not in seen:
            seen.add(shingle)
            if not runs or runs[-1][1] != i:
                runs.append([i, i])
            runs[-1][1] = i + 1
    out = []
    for a, b in runs:
        n = -(-(b - a) // TOGETHER)
        cuts = [a + (b - a) * i // n for i in range(n + 1)]
        out += [own[x:y - 1 + SHINGLE] for x, y in zip(cuts, cuts[1:])]
    return out


class Index:
    """BM25 postings of one shard; a segment's weights add up to 1."""

    def __init__(self, items: list[tuple], frequency: dict[str, int], n_segments: int, mean_length: float):
        self.parts = [tuple(shingles(p) for p in question_answer(own)) for _, own in items]
        self.sizes = {len(s) for parts in self.parts for p in parts for s in p}  # under five for the shortest items
        self.ids = [i for i, _ in items]
        self.answers = {s for _, answer in self.parts for s in answer}
        self.item: list[int] = []
        postings: dict[str, list[tuple[int, float]]] = defaultdict(list)
        for k, (_, own) in enumerate(items):
            for piece in segments(own):
                weight = {}
                for w, tf in Counter(piece).items():
                    df = frequency[w]
                    idf = np.log(1 + (n_segments - df + 0.5) / (df + 0.5))
                    weight[w] = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(piece) / mean_length))
                whole = sum(weight.values())
                for w, x in weight.items():
                    postings[w].append((len(self.item), x / whole))
                self.item.append(k)
        self.term = {w: t for t, w in enumerate(postings)}
        self.codes = {}
        for n in {len(s) for s in self.answers}:
            terms = np.array([[self.term[w] for w in s] for s in self.answers if len(s) == n], np.int64)
            self.codes[n] = np.unique(self._codes(list(terms.T)))
        self.where = [[s for s, _ in p] for p in postings.values()]
        self.weight = [[x for _, x in p] for p in postings.values()]
        self.most = [max(x) for x in self.weight]
        self.block_most = []
        for where, weight in zip(self.where, self.weight):
            top: dict[int, float] = {}
            for s, x in zip(where, weight):
                top[s // BLOCK] = max(top.get(s // BLOCK, 0.0), x)
            self.block_most.append(top)
        # the most frequent terms, as long as they hold at most SLACK of any segment
        held, light = np.zeros(len(self.item)), np.zeros(len(self.term), bool)
        for t in sorted(range(len(self.term)), key=lambda t: -len(self.where[t])):
            more = held.copy()
            more[self.where[t]] += self.weight[t]
            if more.max(initial=0) > SLACK:
                break
            held, light[t] = more, True
        self.blocks = -(-len(self.item) // BLOCK)
        # what the other terms must reach in a block
        self.enough = THRESHOLD - 1e-9 - (np.maximum.reduceat(held, np.arange(0, held.size, BLOCK)) if held.size else held)
        self.count = np.array([0 if light[t] else len(top) for t, top in enumerate(self.block_most)], np.int64)
        self.first = np.cumsum(self.count) - self.count
        kept = [top for t, top in enumerate(self.block_most) if not light[t]]
        self.block_of = np.array([b for top in kept for b in top], np.int64)
        self.bound_of = np.array([x for top in kept for x in top.values()])

    @staticmethod
    def _codes(columns: list[np.ndarray]) -> np.ndarray:
        """Hash codes of shingles, given as their first terms, their second terms and so on."""
        code = np.zeros(columns[0].size, np.uint64)
        for c in columns:
            code = code * _MIX + c.astype(np.uint64)
        return code

    def near(self, terms: list[np.ndarray]) -> np.ndarray:
        """Which texts may hold a shingle of an answer; shingles across two texts and equal codes can only add texts."""
        start = np.cumsum([0, *[t.size for t in terms]])
        out, term = np.zeros(len(terms), bool), np.concatenate(terms)
        for n, codes in self.codes.items():
            if term.size >= n:
                code = self._codes([term[k:term.size - n + 1 + k] for k in range(n)])
                at = np.searchsorted(codes, code)
                at[at == codes.size] = 0
                out[np.searchsorted(start, np.flatnonzero(codes[at] == code), "right") - 1] = True
        return out

    def passages(self, terms: list[np.ndarray]) -> list[tuple[int, int, int, int]]:
        """(text, half, first block, block after the last): runs of blocks of passages that may reach the threshold.

        terms are the texts' term numbers, -1 for none.
        """
        halves = [-(-t.size // HALF) for t in terms]
        base = np.cumsum([1, *[h + 1 for h in halves]])  # a gap of one keeps texts apart
        if not self.block_of.size or not sum(halves):
            return []
        half = np.concatenate([b + np.arange(t.size) // HALF for b, t in zip(base, terms)])
        term = np.concatenate(terms)
        known = term >= 0
        key = np.unique(half[known] * len(self.term) + term[known])
        half, term = key // len(self.term), key % len(self.term)
        count = self.count[term]
        at = np.repeat(self.first[term], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        cell, place = np.unique(np.repeat(half, count) * self.blocks + self.block_of[at], return_inverse=True)
        bound = np.bincount(place, self.bound_of[at], cell.size)
        # a passage is a half with the next one; also one whose first half has no bound in the block
        both = np.unique(np.concatenate([cell, cell - self.blocks]))
        total = np.zeros(both.size)
        for shift in (0, self.blocks):
            there = np.searchsorted(cell, both + shift)
            there[there == cell.size] = 0
            total += np.where(cell[there] == both + shift, bound[there], 0)
        may = both[total >= self.enough[both % self.blocks]]
        if not may.size:
            return []
        first = np.flatnonzero(np.r_[True, (np.diff(may) != 1) | (may[1:] % self.blocks == 0)])
        stop = np.r_[first[1:], may.size] - 1
        out = []
        for a, b in zip(may[first].tolist(), may[stop].tolist()):
            text = int(np.searchsorted(base, a // self.blocks, "right")) - 1
            half = a // self.blocks - int(base[text]) if text >= 0 else -1
            if 0 <= text < len(terms) and half < halves[text]:
                out.append((text, half, a % self.blocks, b % self.blocks + 1))
        return out

    def wand(self, terms: list[int], threshold: float = THRESHOLD, blocks: tuple[int, int] | None = None) -> list[tuple[int, float]]:
        """(segment, score) of all segments, in a run of blocks, that reach the threshold, by block-max WAND."""
        first, end = (0, len(self.item)) if blocks is None else (blocks[0] * BLOCK, min(blocks[1] * BLOCK, len(self.item)))
        found, lists = [], []
        threshold -= 1e-9
        for t in terms:
            where = self.where[t]
            at = bisect_left(where, first)
            if at < len(where) and where[at] < end:
                lists.append([where[at], at, t])
        while lists:
            lists.sort()
            total, pivot = 0.0, None
            for k, (seg, _, t) in enumerate(lists):
                total += self.most[t]
                if total >= threshold:
                    pivot = seg
                    break
            if pivot is None:
                return found
            while k + 1 < len(lists) and lists[k + 1][0] == pivot:
                k += 1
            block = pivot // BLOCK
            if sum(self.block_most[t].get(block, 0.0) for _, _, t in lists[:k + 1]) < threshold:
                # nothing up to the block's end, or up to the next list's segment, can reach it
                target = min((block + 1) * BLOCK, lists[k + 1][0] if k + 1 < len(lists) else end)
            elif lists[0][0] == pivot:
                score = sum(self.weight[t][at] for _, at, t in lists[:k + 1])
                if score >= threshold:
                    found.append((pivot, score))
                target = pivot + 1
            else:
                target = pivot
            for row in lists[:k + 1]:
                if row[0] < target:
                    where = self.where[row[2]]
                    row[1] = bisect_left(where, target, row[1])
                    row[0] = where[row[1]] if row[1] < len(where) else end
            lists = [row for row in lists if row[0] < end]
        return found

    def hits(self, batch: list[str]) -> list[list[tuple]]:
        """Per text, (item id, score, question overlap, answer overlap) of the items it holds."""
        own = [words(t) for t in batch]
        terms = [np.fromiter(map(self.term.get, w, repeat(-1)), np.int64, len(w)) for w in own]
        if terms:
            terms = [t if near else t[:0] for t, near in zip(terms, self.near(terms))]
        best: dict[tuple[int, int], float] = {}
        for text, half, *blocks in self.passages(terms):
            held = set(terms[text][half * HALF:(half + 2) * HALF].tolist()) - {-1}
            for segment, score in self.wand(list(held), THRESHOLD, tuple(blocks)):
                pair = (text, self.item[segment])
                best[pair] = max(best.get(pair, 0.0), score)
        out, at, there = [[] for _ in batch], -1, set()
        for (text, item), score in sorted(best.items()):
            if text != at:
                at = text
                there = {tuple(own[text][i:i + n]) for n in self.sizes for i in range(len(own[text]) - n + 1)}
            question, answer = (len(p & there) / len(p) for p in self.parts[item])
            if question >= OVERLAP and answer >= OVERLAP:
                out[text].append((self.ids[item], score, question, answer))
        return out


def indexes(items: DataFrame, key: str = "item_id", text: str = "text") -> list[Index]:
    """The shards' indexes, each of at most about SHARD_CHARS characters of items."""
    kind = items.schema[key].dataType.simpleString()
    out = arrow_schema("shard int, words array<string>")
    rows = items.select(F.col(key).alias("item"), F.col(text).cast("string").alias("text"))
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    n = -(-total // SHARD_CHARS)
    if not n:
        return []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = pa.array([words(t) for t in texts(b.column(1))], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), made], schema=pa.schema([b.schema.field(0), out.field(0), out.field(1)]))

    shard = F.pmod(F.xxhash64("text"), F.lit(n)).cast("int").alias("shard")
    rows = rows.select("item", "text", shard).mapInArrow(run, f"item {kind}, shard int, words array<string>")
    rows = materialise(rows.filter(F.size("words") > 0), "items")
    out2 = arrow_schema("shard int, word string, df long, size long")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for shard, own in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                for piece in segments(own):
                    new = sorted(set(piece))
                    yield pa.RecordBatch.from_arrays([pa.array([shard] * len(new), pa.int32()), pa.array(new), pa.array([1] * len(new), pa.int64()),
                                                      pa.array([len(piece)] + [0] * (len(new) - 1), pa.int64())], schema=out2)

    counted = materialise(rows.select("shard", "words").mapInArrow(cut, "shard int, word string, df long, size long")
                          .groupBy("shard", "word").agg(F.sum("df").alias("df"), F.sum("size").alias("size"),
                                                        F.sum(F.when(F.col("size") > 0, 1).otherwise(0)).alias("n")), "frequencies")
    whole = counted.groupBy("word").agg(F.sum("df").alias("df"))
    size, count = counted.agg(F.sum("size"), F.sum("n")).first()
    if not count:
        return []
    made = []
    for s in range(n):
        own = rows.filter(F.col("shard") == s).select("item", "words").collect()
        frequency = counted.filter(F.col("shard") == s).select("word").join(whole, "word").collect()
        made.append(Index(sorted(((r[0], r[1]) for r in own), key=str), {r[0]: r[1] for r in frequency}, count, size / count))
    return [x for x in made if x.ids]


def contaminated(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text") -> DataFrame:
    """key, item_id, score, question_overlap, answer_overlap for each document and item it holds."""
    kind, item_kind = docs.schema[key].dataType.simpleString(), items.schema[item].dataType.simpleString()
    schema = f"key {kind}, item_id {item_kind}, score double, question_overlap double, answer_overlap double"
    out = arrow_schema(schema)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    found = docs.sparkSession.createDataFrame([], schema)
    for index in indexes(items, item, item_text):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 256):
                hits = index.hits(texts(b.column(1)))
                of = [i for i, h in enumerate(hits) for _ in h]
                if of:
                    columns = zip(*[h for own in hits for h in own])
                    made = [pa.array(list(c), f.type) for c, f in zip(columns, list(out)[1:])]
                    yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(of)), *made], schema=out)

        found = found.unionByName(rows.mapInArrow(run, schema))
    return found.withColumnRenamed("key", key)


def op10_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = contaminated(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    return found.select("doc_id", "item_id", F.round("question_overlap", 6).alias("question_overlap"),
                        F.round("answer_overlap", 6).alias("answer_overlap"))


def stage(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    schema = docs.schema
    for index in indexes(spark.read.parquet(f"{sf}/benchmark.parquet")):
        def run(batches: Iterator[pa.RecordBatch], index: Index = index) -> Iterator[pa.RecordBatch]:
            for b in slices(batches, 256):
                hits = index.hits(texts(b.column(b.schema.names.index("text"))))
                yield b.filter(pa.array([not h for h in hits], pa.bool_()))

        docs = docs.mapInArrow(run, schema)
    return docs


# Every document against every item by shingles alone: what retrieval with a lower threshold than the overlaps may not lose.
SQL = r"""
WITH dw AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM documents),
     bw AS (SELECT item_id, row_number() OVER () AS b, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}_]+') AS w FROM benchmark),
     parts AS (
       SELECT item_id, b, 'q' AS part, CASE WHEN len(w) < 10 THEN w ELSE w[:len(w) - greatest(5, len(w) // 4)] END AS p FROM bw WHERE len(w) > 0
       UNION ALL
       SELECT item_id, b, 'a', CASE WHEN len(w) < 10 THEN w ELSE w[len(w) - greatest(5, len(w) // 4) + 1:] END FROM bw WHERE len(w) > 0),
     ps AS (SELECT DISTINCT item_id, b, part, array_to_string(p[i:i + least(5, len(p)) - 1], ' ') AS s, least(5, len(p)) AS k
            FROM (SELECT *, unnest(range(1, greatest(2, len(p) - 3))) AS i FROM parts)),
     total AS (SELECT b, part, count(*) AS n FROM ps GROUP BY ALL),
     ds AS (SELECT DISTINCT doc_id, r, k, array_to_string(w[i:i + k - 1], ' ') AS s
            FROM (SELECT doc_id, r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, (SELECT DISTINCT k FROM ps))),
     hit AS (SELECT doc_id, r, item_id, b, part, count(*) AS n FROM ds JOIN ps USING (s, k) GROUP BY ALL),
     share AS (SELECT doc_id, r, item_id, b, part, hit.n / total.n AS o FROM hit JOIN total USING (b, part))
SELECT q.doc_id, q.item_id, round(q.o, 6) AS question_overlap, round(a.o, 6) AS answer_overlap
FROM share q JOIN share a ON q.r = a.r AND q.b = a.b AND q.part = 'q' AND a.part = 'a' AND q.o >= 0.8 AND a.o >= 0.8
"""
