"""Near-duplicate documents by 64-bit SimHash and an anchor-point Hamming join.

The bits of a fingerprint are cut into parts of up to 23 bits and each part takes the perfect [23, 12] Golay code
as its covering code (covering radius 3).  A product of code words is an anchor.  Every fingerprint has one home
anchor, the nearest code word of each part; it is sent to each anchor whose distance exceeds the covering radius by at
most the threshold, all parts together.  If x and y differ in at most ``bits`` bits, y is sent to the home anchor of x,
so comparing homes with guests per anchor finds every link.

Only different fingerprints are joined (exact copies share one), and of the links at an anchor a spanning forest leaves
the task, never all pairs.  ``codes`` = 1, 2 or 3 parts give 2^12, 2^24 or 2^36 anchors at about 22, 61 or 118 rows a
fingerprint; the result is the same.

Defined results: a null or blank text has fingerprint zero and is linked like any other; repeated rows each get a row;
a null doc_id never is a component's smallest id, and a component without any id has a null component_id; other columns
are not read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, as_batch, documents, slices, texts, unused
from promptmill.session import materialise

# The generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1 of the [23, 12] Golay code and its radius.
GENERATOR, PART, RADIUS = 0b110001110101, 23, 3
SEED = 42
SHINGLES_AT_ONCE = 1 << 16


def fingerprint(text: str, words: int = 3) -> int:
    """SimHash of the word shingles, ASCII letters lower-cased, words between ASCII white space."""
    parts = text.encode().lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts]) - 1
    n = max(1, len(parts) - words + 1)
    starts = [0, *(ends[:n - 1] + 1).tolist()]
    stops = ends[min(words, len(parts)) - 1:].tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, n, SHINGLES_AT_ONCE):
        pairs = zip(starts[at:at + SHINGLES_AT_ONCE], stops[at:at + SHINGLES_AT_ONCE])
        h = np.array([digest(line[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3) -> DataFrame:
    """key, fp (the fingerprint's bits as a signed long)."""
    out = arrow_schema("fp long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            fps = np.array([fingerprint(t, words) for t in texts(b.column(1))], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], schema=pa.schema([b.schema.field(0), out.field(0)]))

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(run, f"key {rows.schema['key'].dataType.simpleString()}, fp long")


@cache
def _cosets() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the low 12 and high 11 bits; by remainder, the error patterns of up to RADIUS + 2 bits, few bits first."""
    column = []
    for bit in range(PART):
        r = 1 << bit
        for top in range(PART - 1, 10, -1):
            if r >> top & 1:
                r ^= GENERATOR << (top - 11)
        column.append(r)
    low, high = np.zeros(1 << 12, np.int64), np.zeros(1 << 11, np.int64)
    for table, first in ((low, 0), (high, 12)):
        for bit in range(table.size.bit_length() - 1):
            table[np.arange(table.size) >> bit & 1 == 1] ^= column[first + bit]
    found: list[list[tuple[int, int]]] = [[] for _ in range(1 << 11)]
    for weight in range(RADIUS + 3):
        for bits in combinations(range(PART), weight):
            r = 0
            for bit in bits:
                r ^= column[bit]
            found[r].append((max(0, weight - RADIUS), sum(1 << b for b in bits)))
    upto = np.array([[sum(e <= t for e, _ in x) for t in range(3)] for x in found])
    width = int(upto.max())
    patterns = np.zeros((1 << 11, width), np.uint64)
    for r, x in enumerate(found):
        patterns[r, :len(x)] = [p for _, p in x]
    return low, high, upto, patterns


def anchors(fps: np.ndarray, bits: int = 2, codes: int = 2) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Index of the fingerprint, anchor, whether it is its home; for each anchor in reach of each fingerprint."""
    if not 0 <= bits <= 2 or not 1 <= codes <= 3:
        raise ValueError("bits is 0 to 2, codes 1 to 3")
    low, high, upto, patterns = _cosets()
    row, anchor, left = np.arange(fps.size), np.zeros(fps.size, np.uint64), np.full(fps.size, bits)
    home = np.ones(fps.size, bool)
    for part in range(codes):
        value = (fps >> np.uint64(PART * part) & np.uint64((1 << PART) - 1))[row]
        coset = low[(value & np.uint64(4095)).astype(np.int64)] ^ high[(value >> np.uint64(12)).astype(np.int64)]
        count = upto[coset, left]  # patterns of a coset stand in order of excess
        of = np.repeat(np.arange(row.size), count)
        nth = np.arange(of.size) - np.repeat(np.cumsum(count) - count, count)
        coset = coset[of]
        excess = (nth >= upto[coset, 0]).astype(np.int64) + (nth >= upto[coset, 1])
        # a code word is told apart by its 12 free bits, the upper ones
        word = (value[of] ^ patterns[coset, nth]) >> np.uint64(11)
        row, anchor, left, home = row[of], anchor[of] << np.uint64(12) | word, left[of] - excess, home[of] & (nth == 0)
    return row, anchor, home


def _forest(fps: np.ndarray, home: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links at one anchor that have a home fingerprint at an end."""
    found, todo = [], np.ones(fps.size, bool)
    for first in np.flatnonzero(home):
        if not todo[first]:
            continue
        todo[first] = False
        stack = [first]
        while stack:
            x = stack.pop()
            rest = np.flatnonzero(todo if home[x] else todo & home)
            near = rest[np.bitwise_count(fps[rest] ^ fps[x]) <= bits]
            todo[near] = False
            found += [(int(fps[x]), int(fps[y])) for y in near]
            stack += near.tolist()
    return found


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """anchor, fp, home of whole anchors, from rows sorted by anchor."""
    rest = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)]
    for b in batches:
        new = [b.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        rest = [np.concatenate(x) for x in zip(rest, new)]
        if not rest[0].size:
            continue
        cut = int(np.searchsorted(rest[0], rest[0][-1]))
        if cut:
            yield tuple(x[:cut] for x in rest)
            rest = [x[cut:] for x in rest]
    if rest[0].size:
        yield tuple(rest)


def links(fps: DataFrame, bits: int = 2, codes: int = 2) -> DataFrame:
    """a, b: links that connect all fingerprints of ``fps`` (different values in column fp) at up to ``bits`` bits."""
    near = arrow_schema("anchor long, fp long, home boolean")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 4096):
            own = b.column(0).to_numpy().astype(np.int64)
            row, anchor, home = anchors(own.view(np.uint64), bits, codes)
            yield as_batch(near, anchor.view(np.int64), own[row], home)

    out = arrow_schema("a long, b long")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for anchor, fp, home in _groups(batches):
            fp = fp.view(np.uint64)
            first = np.flatnonzero(np.r_[True, anchor[1:] != anchor[:-1]])
            size = np.diff(np.r_[first, anchor.size])
            homes = np.add.reduceat(home.astype(np.int64), first)
            a, b = [], []
            small = (homes > 0) & (size > 1) & (size <= 32)
            # few rows at an anchor: rows at the same distance in the sorted order are compared all at once
            inside = np.repeat(small, size)
            group = np.repeat(np.arange(first.size), size)
            for step in range(1, int(size[small].max(initial=1))):
                x, y = slice(None, -step), slice(step, None)
                hit = inside[x] & (group[x] == group[y]) & (home[x] | home[y])
                hit &= np.bitwise_count(fp[x] ^ fp[y]) <= bits
                a.append(fp[x][hit])
                b.append(fp[y][hit])
            for g in np.flatnonzero((homes > 0) & (size > 32)):
                own = slice(first[g], first[g] + size[g])
                if pairs := _forest(fp[own], home[own], bits):
                    a.append(np.array([p[0] for p in pairs], np.uint64))
                    b.append(np.array([p[1] for p in pairs], np.uint64))
            if a:
                a, b = np.concatenate(a).view(np.int64), np.concatenate(b).view(np.int64)
                yield as_batch(out, np.minimum(a, b), np.maximum(a, b))

    dealt = fps.select("fp").mapInArrow(deal, "anchor long, fp long, home boolean")
    return (dealt.repartition("anchor").sortWithinPartitions("anchor")
            .mapInArrow(compare, "a long, b long").distinct())


def components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """fp, component: the smallest ``label`` reachable over the edges; nodes has fp (unique) and label.

    Each round takes the smallest label of the neighbours, then the label of the node that label came from.  Rounds
    are written to the shared folder; labels only fall, so it ends after about the logarithm of the longest path.
    """
    both = materialise(edges.select("a", "b").unionByName(edges.selectExpr("b as a", "a as b")), "links")
    seen = both.select(F.col("a").alias("fp")).distinct()
    # no label is the largest; the fingerprint tells which node a label came from
    own = F.struct(F.col("label").isNull().alias("none"), F.col("label").alias("id"), F.col("fp").alias("of"))
    now = materialise(nodes.join(seen, "fp").select("fp", own.alias("label")), "labels")
    while True:
        near = both.join(now.select(F.col("fp").alias("b"), F.col("label").alias("l")), "b").groupBy("a").agg(F.min("l").alias("l"))
        step = now.join(near, now.fp == near.a).select("fp", "label", F.least("label", "l").alias("new"))
        source = now.select(F.col("fp").alias("source"), F.col("label").alias("jump"))
        step = step.join(source, F.col("new.of") == F.col("source")).select("fp", F.least("new", "jump").alias("next"), "label")
        step = materialise(step.select("fp", F.col("next").alias("label"), (F.col("next") != F.col("label")).alias("moved")), "labels")
        now = step.drop("moved")
        if step.filter("moved").isEmpty():
            return now.select("fp", F.col("label.id").alias("component"))


def near_duplicates(df: DataFrame, key: str = "doc_id", text: str = "text", words: int = 3, bits: int = 2, codes: int = 2) -> DataFrame:
    """key, fp, component_id for every row of ``df``."""
    rows = materialise(fingerprints(df, key, text, words), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("key").alias("label"))
    joined = components(nodes, links(nodes, bits, codes))
    classes = nodes.join(joined, "fp", "left").select("fp", F.coalesce("component", "label").alias("component_id"))
    return rows.join(classes, "fp", "left").select(F.col("key").alias(key), "fp", "component_id")


def op7_simhash(spark: SparkSession, sf: str) -> DataFrame:
    found = near_duplicates(documents(spark, sf))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def stage(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """Keeps the document with the smallest doc_id of each component; rows without doc_id, which none can name, stay.

    Of rows that share the doc_id, the one with the smallest hash of all its columns stays.
    """
    kept = near_duplicates(docs).filter("doc_id = component_id").select("doc_id").distinct()
    own, least = unused("_own", docs.columns), unused("_least", docs.columns)
    hashed = docs.filter("doc_id is not null").withColumn(own, F.xxhash64(*[docs[c] for c in docs.columns]))
    chosen = hashed.groupBy("doc_id").agg(F.min(own).alias(least)).join(kept, "doc_id", "left_semi")
    one = hashed.join(chosen, "doc_id").filter(F.col(own) == F.col(least)).dropDuplicates(["doc_id"]).select(docs.columns)
    return one.unionByName(docs.filter("doc_id is null"))
