"""Cross-tokenizer alignment: where two tokenizers' tokens of a text end together, and which of their tokens overlap.

A text's tokens are two ascending lists of byte ends.  The shorter list drives: from the place where the last one was found, steps
of 1, 2, 4, ... pass over ends of the longer list until one is not smaller, then a binary search in the last step finds its
rank.  Equal ends close a group of tokens of both; the differences of successive ranks are the ranges of tokens that each
driving token overlaps.  Many stretches of the driving list are searched at the same time, each from its own place.

Both tokenizers cut a text where a blank or line end follows a character that is no white space (checked when they are loaded: otherwise a text
is one word), so words are encoded once per worker while in use; words over ``LONGEST_KEPT`` characters are not kept.  A text with
a word whose tokens' bytes are not its own is encoded whole and left without tokens if its bytes differ.

Counts: a task counts for its own documents how many hold each linked pair of ids, then counts are summed over the corpus and the highest
of each first id is marked.  The pairs that occur are at most the product of the vocabularies; they go back to the documents in slices of
``SLICE_PAIRS`` (16 bytes each), each slice in one pass over the documents' pairs, which lie in the shared folder as compressed codes.

Defined results: null and empty texts and those whose bytes are not kept have zeros and no groups; texts are never cut; repeated rows and
null ids stay and count each time; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import sentencepiece
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, documents, slices, texts
from promptmill.session import materialise, scratch_path

SPACE = "▁"
WORDS_KEPT, LONGEST_KEPT = 300_000, 48
CHARS_AT_ONCE, STRETCH = 400_000, 32
PAIRS_HELD, SLICE_PAIRS = 2_000_000, 4_000_000

_WORD = re.compile(r"[ \n]*[^ \n]+|[ \n]+")
# characters that some library may take for white space
_DOUBTS = r"\t\x0b\x0c\r\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f-\u2064\u3000\ufeff"
_DOUBTFUL, _DOUBTFUL_END = re.compile(f"[{_DOUBTS}][ \n]"), re.compile(f"[{_DOUBTS}]\\Z")
_CUT = re.compile(f"(?<=[^ \n{_DOUBTS}]) ")


def default_models() -> tuple[str, str]:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next one from U+0100."""
    shown = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers, their tokens' bytes, and the words encoded lately."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        letters, vocabulary = byte_letters(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, i in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_a[i] = bytes(letters[c] for c in token) if known else token.encode()
        names = [self.b.id_to_piece(i) for i in range(len(self.b))]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if self.b.is_byte(i) else p.replace(SPACE, " ").encode() for i, p in enumerate(names)]
        self.length_a, self.length_b = (np.array([len(t) for t in own], np.int64) for own in (self.bytes_a, self.bytes_b))
        spelling = json.loads(self.a.to_str())
        level = spelling.get("pre_tokenizer") or {}
        cuts_a = spelling.get("normalizer") is None and level.get("type") == "ByteLevel" and level.get("use_regex") and not level.get("add_prefix_space")
        cuts_b = not any(SPACE in p.lstrip(SPACE) or "\n" in p for p in names)
        probes = ["a", " a  b ", "\tAÉ１​\nﬁ", "  "]
        plain = all(self.b.normalize(p) == SPACE + p.replace(" ", SPACE) for p in probes)
        self.cuts = bool(cuts_a and cuts_b and plain)
        self.blank = self.b.encode("\n")[:-1] if self.cuts else []  # the space in front; a line end is one byte piece
        self.words: dict[str, tuple[bytes, bytes, bool]] = {}
        self.before: dict[str, tuple[bytes, bytes, bool]] = {}
        # each id as text with the sign behind it: A's , and |, then B's , and ;
        signs = [f"{i}{s}".encode() for n, pair in ((len(self.bytes_a), ",|"), (len(self.bytes_b), ",;")) for s in pair for i in range(n)]
        self.spelt = pa.array(signs, pa.large_binary())

    def cut(self, text: str) -> list[str]:
        """The words of a text with a space in front, in order."""
        spaced = " " + text
        if not self.cuts:
            return [spaced]
        found = _WORD.findall(spaced)
        if _DOUBTFUL.search(spaced):
            joined = [found[0]]
            for word in found[1:]:
                if _DOUBTFUL_END.search(joined[-1]):
                    joined[-1] += word
                else:
                    joined.append(word)
            return joined
        return found

    def sections(self, text: str, chars: int) -> list[str]:
        """Texts of about ``chars`` characters whose tokens, one after the other, are those of a text."""
        spaced, at, out = " " + text, 0, []
        while self.cuts and (found := _CUT.search(spaced, at + chars)):
            out.append(spaced[at + 1:found.start()])
            at = found.start()
        return [*out, spaced[at + 1:]]

    def _tokens_b(self, words: list[str]) -> list[list[int]]:
        """B's ids of words that begin with a blank or line end, as inside a text."""
        asked = [w[1:] if w[0] == " " else "\n" + w for w in words]
        found = self.b.encode(asked, num_threads=1)
        return [self.blank if w == " " and self.cuts else ids if w[0] == " " else ids[len(self.blank) + 1:] for w, ids in zip(words, found)]

    def _learn(self, fresh: list[str], held: dict) -> None:
        of_a = self.a.encode_batch_fast(fresh, add_special_tokens=False)
        for w, a, b in zip(fresh, of_a, self._tokens_b(fresh)):
            data = w.encode()
            same = b"".join([self.bytes_a[i] for i in a.ids]) == data == b"".join([self.bytes_b[i] for i in b])
            (self.words if len(w) <= LONGEST_KEPT else held)[w] = (np.array(a.ids, "<i4").tobytes(), np.array(b, "<i4").tobytes(), same)

    def whole(self, text: str) -> tuple[bytes, bytes]:
        """Ids of A and B of a whole text, none where bytes differ."""
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        data = (" " + text).encode()
        if b"".join([self.bytes_a[i] for i in a]) != data or b"".join([self.bytes_b[i] for i in b]) != data:
            return b"", b""
        return np.array(a, "<i4").tobytes(), np.array(b, "<i4").tobytes()

    def batch(self, batch: list[str]) -> list[tuple[bytes, bytes]]:
        """Per text: the ids of A and of B as 32-bit integers."""
        own = [self.cut(t) if t else [] for t in batch]
        held: dict[str, tuple[bytes, bytes, bool]] = {}
        fresh, words = [], self.words
        for w in set().union(*own):
            if w not in words:
                if (old := self.before.get(w)) is not None:
                    words[w] = old
                else:
                    fresh.append(w)
        if fresh:
            self._learn(fresh, held)
        out = []
        for text, parts in zip(batch, own):
            found = [words.get(w) or held[w] for w in parts] if held else [words[w] for w in parts]
            a, b, same = zip(*found) if found else ((), (), ())
            out.append((b"".join(a), b"".join(b)) if all(same) else self.whole(text))
        if len(words) > WORDS_KEPT:
            self.before, self.words = words, {}
        return out


@cache
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


def gallop(short: np.ndarray, long: np.ndarray, stretch: int = STRETCH) -> np.ndarray:
    """For each of ``short`` (ascending) the rank of the first of ``long`` (ascending) that is not smaller."""
    n, m = len(short), len(long)
    ranks = np.empty(n, np.int64)
    padded = np.append(long, np.iinfo(np.int64).max)
    at = np.arange(0, n, stretch)
    place = np.searchsorted(long, short[at])  # where each stretch starts
    while len(at):
        sought = short[at]
        low, high = place.copy(), place.copy()
        step, open_ = 1, np.flatnonzero(padded[high] < sought)
        while len(open_):
            low[open_] = high[open_] + 1
            high[open_] = np.minimum(high[open_] + step, m)
            step *= 2
            open_ = open_[padded[high[open_]] < sought[open_]]
        open_ = np.flatnonzero(low < high)
        while len(open_):
            middle = (low[open_] + high[open_]) >> 1
            smaller = padded[middle] < sought[open_]
            low[open_[smaller]] = middle[smaller] + 1
            high[open_[~smaller]] = middle[~smaller]
            open_ = open_[low[open_] < high[open_]]
        ranks[at] = place = low
        going = (at + 1) % stretch != 0
        going &= at + 1 < n
        at, place = at[going] + 1, place[going]
    return ranks


def overlaps(driving: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For ends of both lists (the last ones equal): rank and whether equal, of each driving end; then all overlapping (driving, other) places."""
    rank = gallop(driving, other)
    equal = other[rank] == driving
    first = np.concatenate([[0], rank[:-1] + equal[:-1]])
    n = rank - first + 1
    places = np.repeat(np.arange(len(driving)), n)
    return rank, equal, places, np.arange(n.sum()) - np.repeat(np.cumsum(n) - n - first, n)


class Aligned:
    """Some texts' tokens one after the other, aligned; ``which`` are the numbers of the texts."""

    def __init__(self, own: Tokenizers, which: np.ndarray, found: list[tuple[bytes, bytes]], drives_a: bool):
        self.which = which
        ids = [np.frombuffer(b"".join([found[i][k] for i in which]), "<i4").astype(np.int64) for k in (0, 1)]
        self.n = [np.array([len(found[i][k]) // 4 for i in which], np.int64) for k in (0, 1)]
        ends = [np.cumsum(lengths[i]) for i, lengths in zip(ids, (own.length_a, own.length_b))]
        d, o = (0, 1) if drives_a else (1, 0)
        rank, equal, *places = overlaps(ends[d], ends[o])
        last = [None, None]  # the tokens that close groups
        last[d] = np.flatnonzero(equal)
        last[o] = rank[last[d]]
        a, b = places if drives_a else places[::-1]
        self.pairs = ids[0][a] * len(own.bytes_b) + ids[1][b]
        stops = np.cumsum(self.n[0])
        self.owner = np.searchsorted(stops, a, "right")
        self.groups = np.diff(np.searchsorted(last[0], stops), prepend=0)
        # the texts of groups: A's tokens of a group, then B's
        closes = [np.zeros(len(i), np.int64) for i in ids]
        group = []
        for k in (0, 1):
            closes[k][last[k]] = 1
            group.append(np.cumsum(closes[k]) - closes[k])
        spelt = np.empty(len(ids[0]) + len(ids[1]), np.int64)
        spelt[np.arange(len(ids[0])) + np.concatenate([[0], last[1] + 1])[group[0]]] = ids[0] + closes[0] * len(own.bytes_a)
        spelt[np.arange(len(ids[1])) + last[0][group[1]] + 1] = ids[1] + closes[1] * len(own.bytes_b) + 2 * len(own.bytes_a)
        text = own.spelt.take(pa.array(spelt))
        _, offsets, data = text.buffers()
        offsets = np.frombuffer(offsets, np.int64)[text.offset:text.offset + len(text) + 1]
        edges = offsets[np.concatenate([[0], np.cumsum(self.n[0] + self.n[1])])].tolist()
        view = memoryview(data)
        self.told = [view[x:y - 1] for x, y in zip(edges, edges[1:])]


ALIGNED = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"


Found = tuple[list[tuple[int, int, int, int, bytes]], np.ndarray, np.ndarray, np.ndarray]


def align(own: Tokenizers, found: list[tuple[bytes, bytes]]) -> Found:
    """n_a, n_b, n_groups, n_links and the groups as text, of each text's ids; and by (text, pair code) in order: text, code, links."""
    rows = [(0, 0, 0, 0, b"")] * len(found)
    held = np.array([i for i, (a, _) in enumerate(found) if a], np.int64)
    shorter_a = np.array([len(found[i][0]) <= len(found[i][1]) for i in held], bool)
    product, keys = len(own.bytes_a) * len(own.bytes_b), [np.empty(0, np.int64)]
    for drives_a in (True, False):
        which = held[shorter_a == drives_a]
        if len(which):
            part = Aligned(own, which, found, drives_a)
            links = np.bincount(part.owner, minlength=len(which))
            for i, *row in zip(which.tolist(), part.n[0].tolist(), part.n[1].tolist(), part.groups.tolist(), links.tolist(), part.told):
                rows[i] = tuple(row)
            keys.append(which[part.owner] * product + part.pairs)
    key, n = np.unique(np.concatenate(keys), return_counts=True)
    return rows, key // product, key % product, n


def align_texts(own: Tokenizers, batch: list[str], chars: int = CHARS_AT_ONCE) -> Found:
    """As ``align``, with digests of the groups in place of their text; a text of more than ``chars`` characters comes alone and is aligned by sections."""
    if len(batch) > 1 or len(batch[0]) <= chars:
        rows, *pairs = align(own, own.batch(batch))
        return [(*row, hashlib.sha256(told).hexdigest() if told else "") for *row, told in rows], *pairs
    total, groups, codes, links = np.zeros(4, np.int64), hashlib.sha256(), np.empty(0, np.int64), np.empty(0, np.int64)
    for k, section in enumerate(own.sections(batch[0], chars)):
        ((*row, told),), _, more, n = align(own, own.batch([section]))
        if not told:  # bytes differ here: the whole text decides
            ((*row, told),), *pairs = align(own, [own.whole(batch[0])])
            return [(*row, hashlib.sha256(told).hexdigest() if told else "")], *pairs
        total += row
        groups.update(b";" * (k > 0) + told)
        codes, links = _summed(np.concatenate([codes, more]), np.concatenate([links, n]))
    return [(*total.tolist(), groups.hexdigest())], np.zeros(len(codes), np.int64), codes, links


def _summed(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes in order, with the sums of their numbers."""
    order = np.argsort(codes)
    codes = codes[order]
    first = np.flatnonzero(np.diff(codes, prepend=-1))
    return codes[first], np.add.reduceat(n[order], first) if len(first) else n


def _together(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """doc_ids and texts of at most ``CHARS_AT_ONCE`` characters, or one longer text."""
    keys, held, size = [], [], 0
    for b in slices(batches, 256):
        for key, text in zip(b.column(0).to_pylist(), texts(b.column(1))):
            if held and (size + len(text) > CHARS_AT_ONCE or len(held) == 1024):
                yield keys, held
                keys, held, size = [], [], 0
            keys.append(key)
            held.append(text)
            size += len(text)
    if held:
        yield keys, held


def _squeezed(numbers: np.ndarray, press) -> bytes:
    """Numbers as differences, byte by byte of equal weight, compressed."""
    return press.compress(np.diff(numbers, prepend=0).astype("<i8").view(np.uint8).reshape(-1, 8).T.tobytes())


def _numbers(data: bytes, unpack) -> np.ndarray:
    planes = np.frombuffer(unpack.decompress(data), np.uint8).reshape(8, -1)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<i8").ravel())


def aligned(docs: DataFrame, models: tuple[str, str] | None = None, slice_pairs: int = SLICE_PAIRS, held_pairs: int = PAIRS_HELD) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row."""
    spark, paths = docs.sparkSession, models or default_models()
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # kind 0: the rows of documents; 1: their pairs, many documents in one value; 2: pairs and in how many of the task's documents
    schema = f"kind int, {ALIGNED}, rows binary, codes binary, counts binary"
    out = arrow_schema(schema)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, press = tokenizers(*paths), zstandard.ZstdCompressor(level=1)
        row, counted, waiting = TaskContext.get().partitionId() << 33, (np.empty(0, np.int64),) * 2, [[], 0]

        def made(kind: int, columns: dict, n: int) -> pa.RecordBatch:
            columns["kind"] = [kind] * n
            return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in out], schema=out)

        def summed() -> tuple[np.ndarray, np.ndarray]:
            own = _summed(*[np.concatenate(c) for c in zip(counted, *waiting[0])])
            waiting[:] = [[], 0]
            return own

        def told() -> pa.RecordBatch:
            codes, n = counted
            return made(2, {"codes": [_squeezed(codes, press)], "counts": [_squeezed(n, press)]}, 1)

        for keys, batch in _together(batches):
            found, text, codes, links = align_texts(own, batch)
            numbers = np.arange(row, row + len(batch))
            row += len(batch)
            names = ["row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
            yield made(0, dict(zip(names, [numbers, keys, *zip(*found)])), len(batch))
            if len(codes):
                yield made(1, {"rows": [_squeezed(numbers[text], press)], "codes": [_squeezed(codes, press)], "counts": [_squeezed(links, press)]}, 1)
                different, n = np.unique(codes, return_counts=True)
                waiting[0].append((different, n))
                waiting[1] += len(different)
                if waiting[1] > held_pairs:
                    counted = summed()
                    if len(counted[0]) > held_pairs:
                        yield told()
                        counted = (np.empty(0, np.int64),) * 2
        counted = summed()
        if len(counted[0]):
            yield told()

    path = scratch_path(spark, "aligned")
    rows.mapInArrow(find, schema).write.partitionBy("kind").parquet(path)
    made = spark.read.schema(schema).parquet(path)
    pairs = materialise(_pair_counts(made.filter("kind = 2"), len(tokenizers(*paths).bytes_b)), "pairs")
    sums = _sums(made.filter("kind = 1"), pairs, slice_pairs)
    told = made.filter("kind = 0").drop("kind", "rows", "codes", "counts").join(sums, "row", "left")
    zero = {c: F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")}
    return told.select("doc_id", "n_a", "n_b", "n_groups", "n_links", *zero.values(), "groups_sha256")


def _pair_counts(counted: DataFrame, base: int) -> DataFrame:
    """code, n documents that hold the pair, best: whether no pair with the same first id has more."""
    schema = "code long, n long"
    out = arrow_schema(schema)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in slices(batches, 1):
            codes, n = (_numbers(c[0].as_py(), unpack) for c in b.columns)
            for at in range(0, len(codes), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array(x[at:at + 100_000]) for x in (codes, n)], schema=out)

    summed = counted.select("codes", "counts").mapInArrow(read, schema).groupBy("code").agg(F.sum("n").alias("n"))
    summed = materialise(summed.withColumn("first", F.expr(f"code div {base}")), "pair-counts")
    highest = summed.groupBy("first").agg(F.max("n").alias("most"))
    return summed.join(highest, "first").select("code", "n", (F.col("n") == F.col("most")).alias("best"))


def _sums(links: DataFrame, pairs: DataFrame, slice_pairs: int) -> DataFrame:
    """row, n_best, count_sum from the documents' pairs, one pass for each slice of ``slice_pairs`` pair counts."""
    spark, count = links.sparkSession, pairs.count()
    parts = -(-count // slice_pairs)
    schema = "row long, n_best long, count_sum long"
    if parts < 2:
        bounds = [None] * (parts + 1)
    else:
        at = [i / parts for i in range(1, parts)]
        inner = pairs.agg(F.percentile_approx("code", at, 100 * parts).alias("q")).first().q
        bounds = [None, *sorted(set(inner)), None]
    out, found = arrow_schema(schema), None
    for low, high in zip(bounds, bounds[1:]):
        held = pairs.filter(" and ".join([x for x in (low is not None and f"code > {low}", high is not None and f"code <= {high}") if x]) or "true")
        table = held.orderBy("code").toArrow()
        if not table.num_rows:
            continue
        codes, value = table["code"].to_numpy(), table["n"].to_numpy() * 2 + table["best"].to_numpy()
        known = spark.sparkContext.broadcast((codes, value))  # at most about slice_pairs pairs

        def add(batches: Iterator[pa.RecordBatch], known=known) -> Iterator[pa.RecordBatch]:
            unpack, (codes, value) = zstandard.ZstdDecompressor(), known.value
            for b in slices(batches, 1):
                row, code, n = (_numbers(c[0].as_py(), unpack) for c in b.columns)
                at = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
                hit = codes[at] == code
                row, n, value_of = row[hit], n[hit], value[at[hit]]
                if len(row):
                    first = np.flatnonzero(np.diff(row, prepend=-1))
                    columns = [row[first], np.add.reduceat(n * (value_of & 1), first), np.add.reduceat(n * (value_of >> 1), first)]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=out)

        part = links.select("rows", "codes", "counts").mapInArrow(add, schema)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], schema)
    return found.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def op13_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return aligned(documents(spark, sf))
