"""Document fingerprints: a quartile bucket digest, compared with a bounded difference.

Every window of five bytes (four zero bytes stand before a text) gives the six triplets that hold its newest byte; each is
hashed into one of 256 buckets and counted.  A bucket's code says above how many quartiles of the text's own 256 counts its
count lies (0 to 3).  The digest is a byte for the length, an eighth of an octave a step, and 64 bytes of codes.

``difference`` of two digests lies in 0 to 1: the codes' distances over the largest distance that codes of this size can
have (the sum of the larger code of each bucket), and the lengths' distance, bounded at four octaves, which makes up to half of
the rest.  It is 0 for equal digests and 1 where no bucket is used by both; likeness is 1 - difference.

``neighbours`` gives each document the one after it in ascending doc_id order without a sort in one task: keys alone (doc_id and
the text's hash) are cut into ranges, whose first keys go to the driver (at most ``MOST_RANGES``), texts are shuffled once to their range, and
the first row of a range is sent to the range before as well.  Equal rows are counted before the shuffle.

Defined results: null counts as the empty text, whose digest is all zero and whose likeness to itself is 1; texts are never cut;
rows without doc_id come first, equal doc_ids in the order of a hash of their texts; repeated rows stay; the last document is followed by the
first, a single one by itself; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, documents, place, range_starts, slices, texts

BUCKETS, PAD = 256, 4
# distances from the newest byte of a window of five
TRIPLETS = [(1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4)]
STEPS_AN_OCTAVE, MOST_STEPS = 8, 32
ROWS_A_RANGE, MOST_RANGES = 10_000, 1 << 16
BYTES_AT_ONCE = 1 << 20


def _add(counts: np.ndarray, data: np.ndarray, owner: np.ndarray) -> None:
    """Adds the triplets of ``data``; ``owner`` has the row of each byte after the first ``PAD``, the last row for none."""
    x = data.astype(np.uint32)
    newest = x[PAD:] << np.uint32(16)
    row = owner.astype(np.int64) * BUCKETS
    for k, (a, b) in enumerate(TRIPLETS, 1):
        mixed = (newest | x[PAD - a:-a] << np.uint32(8) | x[PAD - b:-b]) + np.uint32(k << 24)
        bucket = (mixed * np.uint32(0x9E3779B1)) >> np.uint32(24)
        counts += np.bincount(row + bucket, minlength=counts.size).reshape(counts.shape)


def bucket_counts(batch: list[bytes]) -> np.ndarray:
    """Row by row, how many triplets of a text fall into each bucket."""
    n = len(batch)
    counts = np.zeros((n + 1, BUCKETS), np.int64)
    zeros, at = bytes(PAD), 0
    while at < n:
        to, size = at + 1, len(batch[at])
        while to < n and size + len(batch[to]) <= BYTES_AT_ONCE:
            size += len(batch[to])
            to += 1
        if size > BYTES_AT_ONCE:
            for start in range(0, size, BYTES_AT_ONCE):
                before = batch[at][max(0, start - PAD):start]
                part = np.frombuffer(zeros[len(before):] + before + batch[at][start:start + BYTES_AT_ONCE], np.uint8)
                _add(counts, part, np.full(len(part) - PAD, at))
        elif size:
            data = np.frombuffer(b"".join([p for t in batch[at:to] for p in (zeros, t)]), np.uint8)
            lengths = np.array([[PAD, len(t)] for t in batch[at:to]]).ravel()
            rows = np.column_stack([np.full(to - at, n), np.arange(at, to)]).ravel()
            _add(counts, data, np.repeat(rows, lengths)[PAD:])
        at = to
    return counts[:n]


def length_code(n_bytes: int) -> int:
    """0 for no bytes, else 1 and the steps above one byte."""
    if not n_bytes:
        return 0
    octave = n_bytes.bit_length() - 1
    return 1 + STEPS_AN_OCTAVE * octave + ((n_bytes * STEPS_AN_OCTAVE >> octave) & STEPS_AN_OCTAVE - 1)


def digests(batch: list[bytes]) -> np.ndarray:
    """Row by row: the length code, then the codes of all buckets."""
    counts = bucket_counts(batch)
    ranked = np.sort(counts, axis=1)
    codes = np.zeros((len(batch), 1 + BUCKETS), np.int16)
    for quartile in (1, 2, 3):
        codes[:, 1:] += counts > ranked[:, quartile * BUCKETS // 4 - 1][:, None]
    codes[:, 0] = [min(255, length_code(len(t))) for t in batch]
    return codes


def spelt(codes: np.ndarray) -> list[str]:
    """Digests as lower-case hex."""
    four = codes[:, 1:].reshape(len(codes), -1, 4).astype(np.uint8)
    packed = four[:, :, 0] << 6 | four[:, :, 1] << 4 | four[:, :, 2] << 2 | four[:, :, 3]
    return [row.tobytes().hex() for row in np.column_stack([codes[:, 0].astype(np.uint8), packed])]


def read(fingerprint: str) -> np.ndarray:
    """The codes of a digest in hex."""
    data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8)
    return np.concatenate([data[:1], (data[1:, None] >> np.array([6, 4, 2, 0], np.uint8) & 3).ravel()]).astype(np.int16)


def difference(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row between digests as codes, 0 to 1."""
    apart = np.abs(a[:, 1:] - b[:, 1:]).sum(1)
    most = np.maximum(a[:, 1:], b[:, 1:]).sum(1)
    steps = np.minimum(np.abs(a[:, 0] - b[:, 0]), MOST_STEPS)
    return 1 - (1 - apart / np.maximum(most, 1)) * (1 - steps / (2 * MOST_STEPS))


def neighbours(docs: DataFrame, use, schema: str) -> DataFrame:
    """Rows of ``schema`` that ``use(keys, texts, next texts)`` makes of every document and the one after it, some hundred at a time."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("hash", F.xxhash64("text"))
    starts = range_starts(rows, ROWS_A_RANGE, MOST_RANGES)
    moved = "range int, guest boolean, doc_id long, hash long, copies long, text string"
    out, made = arrow_schema(moved), arrow_schema(schema)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            equal: dict[tuple, int] = {}
            for row in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                equal[row] = equal.get(row, 0) + 1
            found = []
            for (key, text, h), n in equal.items():
                own = place(key, h)
                r = bisect_right(starts, own) - 1
                found.append((r, False, key, h, n, text))
                if starts[r] == own:
                    found.append(((r or len(starts)) - 1, True, key, h, 1, text))
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), out)], schema=out)

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        last, closed = None, False
        for b in slices(batches):
            for _, guest, key, _, n, text in zip(*(c.to_pylist() for c in b.columns)):
                if closed:
                    continue  # the guest again
                if last is not None:
                    yield (*last, text)
                closed, last = guest, (key, text)
                for _ in range(0 if guest else n - 1):
                    yield (key, text, text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in pairs(batches):
            held.append(row)
            size += len(row[1])
            if len(held) == 256 or size > BYTES_AT_ONCE:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(use(*zip(*held)), made)], schema=made)
                held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(use(*zip(*held)), made)], schema=made)

    dealt = rows.mapInArrow(deal, moved).repartitionById(max(1, len(starts)), F.col("range"))
    return dealt.sortWithinPartitions("guest", F.col("doc_id").asc_nulls_first(), "hash").mapInArrow(run, schema)


def edited(text: str, following: str) -> str:
    """The last half of the code points, rounded down, replaced by as many first ones of the next text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _compared(keys, own, following):
    """The columns of the query for some documents in order."""
    changed = [edited(t, f) for t, f in zip(own, following)]
    n = len(own)
    # a document is mostly the one that followed the last, so its digest is made once
    at = {t: i for i, t in enumerate(dict.fromkeys([*own, *following]))}
    plain = digests([t.encode() for t in at])
    mine, after = plain[[at[t] for t in own]], plain[[at[t] for t in following]]
    other = digests([t.encode() for t in changed])
    return (keys, [len(t) for t in own], [hashlib.sha256(t.encode()).hexdigest() for t in changed], spelt(mine), spelt(other),
            1 - difference(mine, other), 1 - difference(mine, after))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, fingerprint of every row, where the rows lie."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = arrow_schema("doc_id long, fingerprint string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 256):
            found = spelt(digests([t.encode() for t in texts(b.column(1))]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(found, pa.string())], schema=out)

    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def op11_fingerprints(spark: SparkSession, sf: str) -> DataFrame:
    return neighbours(documents(spark, sf), _compared, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
                      "edited_fingerprint string, near_edited double, near_next double")
