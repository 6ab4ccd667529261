"""Token ids in binary files: an independent zstandard frame per document, a seek table at the end.

A file holds documents in ascending doc_id order.  Each document's ids, unsigned 32-bit little-endian, are one frame; a
skippable frame with the file's place in the order and the doc_ids follows, then the seek table of zstandard's seekable
format: compressed size, size and checksum (low 32 bits of XXH64) of each frame.  Any zstandard tool decompresses the
whole file; ``TokenFile`` reads the table and then only the frames of the documents asked for, and checks them.

Writing: the order by doc_id and a hash of the text is cut into ranges (keys alone are shuffled for that), texts are encoded where they
lie, and the compressed frames are shuffled to their range, sorted and packed into files of about ``FILE_BYTES``.  Spark's
text sink writes each file as one row, its line separator being the last four bytes of the format, so tasks that are lost or
run twice do no harm and any store that Spark knows will do.  Positions in the whole are sums over ranges and over a
range's files, not one sorted pass.

The tokenizer drops white space, lower-cases and cuts between letters, digits and signs.  A batch of texts is cut the same way at once, by
the classes of its bytes, into units that are encoded on their own, each once per worker while in use; ASCII letters are lower-cased
before.  A word between white space stays whole where that would not hold: if an apostrophe stands before a letter, if it may hold a
special token, or if letters beyond ASCII are not letters alone, before and after lower-casing.  Units over ``LONGEST_KEPT`` bytes are not kept.

Defined results: null and empty texts are the end id alone; texts are never cut; rows without doc_id come first; equal
doc_ids are put in the order of a hash of their texts; other columns are not read; an empty table writes nothing and reads as empty.
"""

from __future__ import annotations

import io
import os
import re
import struct
import zlib
from array import array
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, by_size, documents, place, range_starts, slices, texts
from promptmill.session import materialise, scratch_path

FILE_BYTES = 16 << 20
ROWS_A_RANGE, MOST_RANGES = 10_000, 1 << 16
UNITS_KEPT, LONGEST_KEPT, BYTES_AT_ONCE = 300_000, 64, 1 << 20
# classes of bytes: white space, letters and all beyond ASCII, digits, signs and the rest
BLANK, LETTER, DIGIT, SIGN = range(4)
_CLASS = np.full(256, SIGN, np.uint8)
_CLASS[list(b" \t\n\r\x0b\x0c")] = BLANK
_CLASS[[c for c in range(256) if c >= 128 or chr(c).isalpha()]] = LETTER
_CLASS[list(b"0123456789")] = DIGIT
_LETTERS = re.compile(rb"[A-Za-z\x80-\xff]+")
_LOWER = np.array([c + 32 if chr(c).isalpha() and c < 91 else c for c in range(256)], np.uint8)
# Fixed values of zstandard's seekable format: the skippable frames' magic numbers, the flag for checksums, the last bytes.
INDEX_MAGIC, TABLE_MAGIC, CHECKSUMS, LAST = 0x184D2A51, 0x184D2A5E, 1 << 7, bytes([0xB1, 0xEA, 0x92, 0x8F])
END_ID = 1


def default_model() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


class Encoder:
    """Ids of texts as bytes, by a tokenizer that drops white space."""

    def __init__(self, path: str, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.library = Tokenizer.from_file(path)
        self.end = struct.pack("<I", end_id)
        self.units: dict[bytes, bytes] = {}
        self.before: dict[bytes, bytes] = {}
        self.mixed: set[bytes] = set()  # runs beyond ASCII that are not letters alone

    def _cut(self, data: np.ndarray) -> tuple[pa.Array, list[bytes], np.ndarray]:
        """The units of the bytes, as places in a list of different ones, that list, and where each unit begins."""
        kind = _CLASS[data]
        inside = kind != BLANK
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        begins, word = np.flatnonzero(begin), np.cumsum(begin, dtype=np.int32) - 1
        whole = np.zeros(len(begins), bool)
        whole[word[:-1][(data[:-1] == ord("'")) & (kind[1:] == LETTER)]] = True
        whole[word[:-1][(data[:-1] == ord("<")) & (data[1:] == ord("|"))]] = True
        edge = kind == DIGIT
        edge[1:] |= kind[1:] != kind[:-1]
        plain, place = _LOWER[data], np.cumsum(inside, dtype=np.int32) - 1
        while True:
            free = ~whole[word] if len(begins) else inside
            starts = edge & free
            starts[begins] = True
            starts = np.flatnonzero(starts & inside)
            kept = np.where(free, plain, data)[inside]
            offsets = np.append(place[starts], len(kept)).astype(np.int32)
            units = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
            names = units.dictionary.to_numpy(zero_copy_only=False).tolist()
            for u, ids in zip(names, map(self.units.get, names)):
                if ids is None and not u.isascii() and _LETTERS.fullmatch(u):
                    text = u.decode()
                    if not (text.isalpha() and text.lower().isalpha()):
                        self.mixed.add(u)
            odd = self.mixed.intersection(names)
            if not odd:
                return units.indices, names, starts
            known = np.fromiter(map(odd.__contains__, names), bool, len(names))
            found = np.unique(word[starts[known[units.indices.to_numpy()]]])
            if whole[found].all():
                return units.indices, names, starts
            whole[found] = True

    def _learn(self, fresh: list[bytes]) -> None:
        found = self.library.encode_batch_fast([u.decode() for u in fresh], add_special_tokens=False)
        self.units.update(zip(fresh, [array("I", e.ids).tobytes() for e in found]))

    def batch(self, batch: list[str]) -> list[bytes]:
        """The ids of each text, with the end id, as bytes."""
        texts = [t.encode() for t in batch]
        data = np.frombuffer(b"\n".join(texts), np.uint8)
        if not len(data):
            return [self.end for _ in batch]
        places, names, starts = self._cut(data)
        units, fresh = self.units, []
        found = list(map(units.get, names))
        if None in found:
            for u, ids in zip(names, found):
                if ids is None:
                    if (old := self.before.get(u)) is not None:
                        units[u] = old
                    else:
                        fresh.append(u)
            if fresh:
                self._learn(fresh)
            found = list(map(units.__getitem__, names))
        ids = pa.array(found, pa.large_binary()).take(places)
        _, offsets, held = ids.buffers()
        offsets = np.frombuffer(offsets, np.int64)[ids.offset:ids.offset + len(ids) + 1]
        ends = np.cumsum([len(t) + 1 for t in texts])  # where the next text begins
        edges = [0, *offsets[np.searchsorted(starts, ends)].tolist()] if len(ids) else [0] * (len(texts) + 1)
        view = memoryview(held) if held is not None else b""
        out = [bytes(view[a:b]) + self.end for a, b in zip(edges, edges[1:])]
        for u in fresh:
            if len(u) > LONGEST_KEPT:
                del units[u]
        if len(units) > UNITS_KEPT:
            self.before, self.units, self.mixed = units, {}, set()
        return out


@cache
def encoder(path: str, end_id: int) -> Encoder:
    return Encoder(path, end_id)


def pack(frames: Iterable[tuple[int | None, bytes, int, int]], place: tuple[int, int]) -> bytes:
    """A file from (doc_id, frame, size, checksum) in order; ``place`` is its range and number in the range."""
    frames = list(frames)
    ids = np.array([0 if f[0] is None else f[0] for f in frames], "<i8").tobytes() + bytes(f[0] is not None for f in frames)
    index = struct.pack("<qq", *place) + ids
    index = struct.pack("<II", INDEX_MAGIC, len(index)) + index
    table = b"".join(struct.pack("<III", len(f), size, check) for _, f, size, check in frames) + struct.pack("<III", len(index), 0, 0)
    foot = struct.pack("<IB", len(frames) + 1, CHECKSUMS) + LAST
    return b"".join([*[f[1] for f in frames], index, struct.pack("<II", TABLE_MAGIC, len(table) + len(foot)), table, foot])


class TokenFile:
    """Random access to a file's documents; ValueError where the file or a frame is damaged."""

    def __init__(self, file):
        self.file = file
        end = file.seek(0, 2)
        file.seek(max(0, end - 9))
        foot = file.read(9)
        if len(foot) < 9 or foot[5:] != LAST or not foot[4] & CHECKSUMS:
            raise ValueError("no seek table")
        n = struct.unpack("<I", foot[:4])[0]
        start = end - 9 - 12 * n
        if start < 8:
            raise ValueError("no seek table")
        file.seek(start - 8)
        if file.read(8) != struct.pack("<II", TABLE_MAGIC, 12 * n + 9):
            raise ValueError("no seek table")
        self.table = np.frombuffer(file.read(12 * n), "<u4").reshape(n, 3).astype(np.int64)
        self.starts = np.cumsum(self.table[:, 0]) - self.table[:, 0]
        if not n or self.starts[-1] + self.table[-1, 0] != start - 8:
            raise ValueError("frame sizes do not fit")
        file.seek(self.starts[-1])
        index = file.read(self.table[-1, 0])
        if struct.unpack("<II", index[:8]) != (INDEX_MAGIC, len(index) - 8) or len(index) != 24 + 9 * (n - 1):
            raise ValueError("no document index")
        self.place = struct.unpack("<qq", index[8:24])
        ids, known = np.frombuffer(index[24:24 + 8 * (n - 1)], "<i8"), index[24 + 8 * (n - 1):]
        self.doc_ids = [int(i) if k else None for i, k in zip(ids, known)]
        self.sizes = self.table[:-1, 1] // 4
        self.unpack = zstandard.ZstdDecompressor()

    def ids(self, k: int) -> bytes:
        """The bytes of the k-th document's ids."""
        compressed, size, check = self.table[k]
        self.file.seek(self.starts[k])
        try:
            data = self.unpack.decompress(self.file.read(compressed), max_output_size=max(1, size))
        except zstandard.ZstdError:
            raise ValueError(f"frame {k} is damaged") from None
        if len(data) != size or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        return data


def write(docs: DataFrame, path: str, model: str | None = None, end_id: int = END_ID, file_bytes: int = FILE_BYTES) -> None:
    """Token files of ``docs`` (doc_id, text) in a new folder ``path``."""
    model = model or default_model()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("hash", F.xxhash64(F.coalesce("text", F.lit(""))))
    starts = range_starts(rows, ROWS_A_RANGE, MOST_RANGES)
    schema = "range long, doc_id long, hash long, crc long, size long, check long, frame binary"
    out = arrow_schema(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, press = encoder(model, end_id), zstandard.ZstdCompressor(level=1, write_content_size=True)
        for b in by_size(batches, 1, BYTES_AT_ONCE):
            ids = own.batch(texts(b.column(1)))
            keys, hashes = b.column(0), b.column(2)
            ranges = [bisect_right(starts, place(k, h)) - 1 for k, h in zip(keys.to_pylist(), hashes.to_pylist())]
            columns = [pa.array(ranges, pa.int64()), keys, hashes, pa.array([zlib.crc32(x) for x in ids], pa.int64()), pa.array([len(x) for x in ids], pa.int64()),
                       pa.array([xxhash.xxh64_intdigest(x) & 0xFFFFFFFF for x in ids], pa.int64()), pa.array([press.compress(x) for x in ids], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    def files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, at = [], 0, None

        def made() -> pa.RecordBatch:
            data = pack(held, at).removesuffix(LAST)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], names=["file"])

        for b in slices(batches, 256):
            for r, key, n, check, frame in zip(*(b.column(b.schema.names.index(c)).to_pylist() for c in ("range", "doc_id", "size", "check", "frame"))):
                if held and (r != at[0] or size > file_bytes):
                    yield made()
                    size = 0
                if not held:
                    at = (r, at[1] + 1 if at and at[0] == r else 0)
                held.append((key, frame, n, check))
                size += len(frame)
        if held:
            yield made()

    dealt = rows.mapInArrow(encode, schema).repartitionById(max(1, len(starts)), F.col("range").cast("int"))
    dealt = dealt.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), "hash")
    (dealt.mapInArrow(files, "file binary").select(F.col("file").cast("string").alias("value")).write
     .option("lineSep", LAST.decode("latin-1")).option("encoding", "ISO-8859-1").option("maxRecordsPerFile", 1).text(path))


def read(spark: SparkSession, path: str, wanted: list[int] | None = None) -> DataFrame:
    """range, number (of the file), nth (in it), doc_id, before (ids before it in the file), n_tokens, ids (as bytes).

    With ``wanted`` doc_ids, only their frames are decompressed.
    """
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").filter("length(content) > 0")
    schema = "range long, number long, nth long, doc_id long, before long, n_tokens long, ids binary"
    out, only = arrow_schema(schema), None if wanted is None else frozenset(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, 1):
            file = TokenFile(io.BytesIO(b.column(0)[0].as_py()))
            before = np.cumsum(file.sizes) - file.sizes
            chosen = [k for k, i in enumerate(file.doc_ids) if only is None or i in only]
            for at in range(0, len(chosen), 256):
                ks = chosen[at:at + 256]
                columns = [[file.place[0]] * len(ks), [file.place[1]] * len(ks), ks, [file.doc_ids[k] for k in ks],
                           before[ks].tolist(), file.sizes[ks].tolist(), [file.ids(k) for k in ks]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, out)], schema=out)

    return files.mapInArrow(run, schema)


def positions(found: DataFrame) -> DataFrame:
    """``found`` with start, the number of ids in all documents before; needs all documents of the files."""
    files = found.groupBy("range", "number").agg(F.sum("n_tokens").alias("n"))
    inside = files.withColumn("ahead", F.sum("n").over(Window.partitionBy("range").orderBy("number")) - F.col("n"))
    # at most MOST_RANGES rows
    ranges = files.groupBy("range").agg(F.sum("n").alias("n"))
    ranges = ranges.select("range", (F.sum("n").over(Window.orderBy("range")) - F.col("n")).alias("base"))
    starts = inside.join(ranges, "range").select("range", "number", (F.col("ahead") + F.col("base")).alias("ahead"))
    return found.join(starts, ["range", "number"]).withColumn("start", F.col("ahead") + F.col("before"))


def op9_tokenfiles(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    write(documents(spark, sf), path)
    found = materialise(read(spark, path).withColumn("ids_crc32", F.crc32("ids")).drop("ids"), "tokens")
    return positions(found).select("doc_id", "start", "n_tokens", "ids_crc32")
