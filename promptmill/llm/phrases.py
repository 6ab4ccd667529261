"""Phrase collocations: multikey three-way quicksort of suffix pointers, scored by the weakest cut.

Texts are lower-cased (A-Z), cut into pieces at signs and line ends and into words at blanks; a suffix is a place in a piece and
its key is the next ``LONGEST`` words.  Suffixes go to targets by their two leading words.  In a target, pointers are partitioned by
language, first, second and third word in turn: a three-way split around a pivot word puts the smaller, the equal and the
larger keys apart, the equal ones go on to the next word, and the size of an equal partition is the count of that phrase.  A
partition whose suffixes are fewer than ``least`` is abandoned, as nothing in it can be frequent.  Partitions of at most ``SMALL`` pointers are
finished together, one sort for all of a depth.

A first pass counts words and finds the pairs that lead at least one in ``HOT_SHARE`` of all places: a pair that does so in the
whole does so, at half that share, in some block of texts, so blocks report those alone and at most ``2 * HOT_SHARE`` pairs remain.  Suffixes that start
with such a pair go to targets by all three words, and the pair's own count in a block goes to its target as one suffix
without a third word.  Equal suffixes of a block are one pointer with a weight.  A target reads its blocks one after
the other and merges equal suffixes each time ``MERGE_ROWS`` have come, so what it holds grows with different suffixes only.

Words, pairs and triples that reach ``least`` are one table; the parts of every cut of a candidate are looked up there by two
joins, exact in 38 decimal digits (counts to 10^15; beyond that Spark raises an error).

Defined results: a null or empty text has no words, a null lang is ``und``; texts are never cut short (long ones are read in
sections that end at a piece's end); repeated rows count each time; ties go by phrase in the order of UTF-8 bytes; other
columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.llm.common import arrow_schema, documents, slices
from promptmill.session import materialise

LEAST, LONGEST, FIRST, SCALE, INSIDE = 10, 3, 2000, 1_000_000, 50
BLOCK_CHARS = 4 << 20
HOT_SHARE = 512
SUFFIXES_A_TARGET, MOST_PARTITIONS, MERGE_ROWS = 2_000_000, 1 << 16, 4_000_000
SMALL = 1024
TOTAL, PHRASE, PAIR = 0, 1, 2

_SIGNS = re.compile(r"[.,;:!?\n-\r]")
_FOLD = bytearray(range(256))
_FOLD[ord("A"):ord("Z") + 1] = bytes(range(ord("a"), ord("z") + 1))
for _c in b".,;:!?\n\v\f\r":
    _FOLD[_c] = 10
_FOLD[9] = 32
_FOLD = bytes(_FOLD)


class Block:
    """The words of some texts: ``word`` numbers of ``names``, ``piece`` numbers, ``lang`` numbers of ``langs``, place by place."""

    def __init__(self, rows: list[tuple[str, str]]):
        self.langs = sorted({lang for lang, _ in rows})
        number = {lang: i for i, lang in enumerate(self.langs)}
        folded = [t.encode().translate(_FOLD) for _, t in rows]
        data = np.frombuffer(b"\n".join(folded), np.uint8)
        inside = (data != 10) & (data != 32)
        edges = np.flatnonzero(np.diff(inside.view(np.int8), prepend=0, append=0))
        starts, lengths = edges[::2], edges[1::2] - edges[::2]
        self.piece = np.cumsum(data == 10, dtype=np.int32)[starts]
        text = np.searchsorted(np.cumsum([len(t) + 1 for t in folded]), starts, "right")
        self.lang = np.array([number[lang] for lang, _ in rows], np.int64)[text]
        ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(data[inside])]).dictionary_encode()
        self.word, self.names = words.indices.to_numpy(zero_copy_only=False).astype(np.int64), words.dictionary
        self.n = len(starts)

    def follows(self, k: int) -> np.ndarray:
        """True at places whose k-th next word is in the same piece."""
        same = np.zeros(self.n, bool)
        same[:self.n - k] = self.piece[k:] == self.piece[:self.n - k]
        return same


def blocks(batches: Iterator[pa.RecordBatch], chars: int) -> Iterator[Block]:
    """Blocks of about ``chars`` characters from batches of lang, text."""
    held, size = [], 0
    for b in slices(batches):
        for lang, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            at = 0
            while at < len(text):
                end = _SIGNS.search(text, at + chars)
                to = end.end() if end else len(text)
                held.append((lang, text[at:to]))
                size, at = size + to - at, to
                if size >= chars:
                    yield Block(held)
                    held, size = [], 0
    if held:
        yield Block(held)


def _strings(names: pa.Array, *numbers: np.ndarray) -> pa.Array:
    """Words joined by spaces."""
    import pyarrow.compute as pc
    columns = [names.take(pa.array(x)).cast(pa.string()) for x in numbers]
    return pc.binary_join_element_wise(*columns, " ") if len(columns) > 1 else columns[0]


def _word_counts(block: Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    own = len(block.names)
    key, n = np.unique(block.lang * own + block.word, return_counts=True)
    return key // own, key % own, n


def _led_by_many(block: Block, share: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """lang, first, second, count of the pairs that lead one in ``2 * share`` of the block's places."""
    enough = block.n / (2 * share)
    often = np.bincount(block.word, minlength=len(block.names)) >= enough
    places = np.flatnonzero(block.follows(1) & often[block.word])
    places = places[often[block.word[places + 1]]]
    own = len(block.names)
    key, n = np.unique((block.lang[places] * own + block.word[places]) * own + block.word[places + 1], return_counts=True)
    key, n = key[n >= enough], n[n >= enough]
    return key // own // own, key // own % own, key % own, n


COUNTED = "kind int, lang string, phrase string, n long"


def _counts(block: Block, share: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """All words, each word and the pairs that lead many places, with their counts in the block."""
    langs = pa.array(block.langs, pa.string())
    total = np.bincount(block.lang, minlength=len(langs))
    lang, word, n = _word_counts(block)
    pair_lang, first, second, pairs = _led_by_many(block, share)
    kinds = [(TOTAL, langs, pa.nulls(len(langs), pa.string()), total), (PHRASE, langs.take(pa.array(lang)), _strings(block.names, word), n),
             (PAIR, langs.take(pa.array(pair_lang)), _strings(block.names, first, second), pairs)]
    for kind, lang, phrase, n in kinds:
        columns = [pa.array(np.full(len(n), kind, np.int32)), lang, phrase, pa.array(n.astype(np.int64))]
        yield pa.RecordBatch.from_arrays(columns, schema=schema)


def _merged(columns: list[np.ndarray], weight: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Equal rows of ``columns`` (numbers from 0) made one, their weights summed."""
    if not len(weight):
        return columns, weight
    bases = [int(c.max()) + 1 for c in columns]
    key, room = columns[0], bases[0]
    for c, base in zip(columns[1:], bases[1:]):
        if room * base >= 1 << 63:
            seen, key = np.unique(key, return_inverse=True)
            room = len(seen)
        key, room = key * base + c, room * base
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
    return [c[order[first]] for c in columns], np.add.reduceat(weight[order], first)


def _suffixes(block: Block, hot: set[tuple[str, bytes, bytes]]) -> tuple[list[np.ndarray], np.ndarray]:
    """lang * 2 + (1 for a hot pair), three words (0 for none, else number + 1), and weights of the block's suffixes of two words and more."""
    places = np.flatnonzero(block.follows(1))
    third = np.zeros(len(places), np.int64)
    more = block.follows(2)[places]
    third[more] = block.word[places[more] + 2] + 1
    columns, weight = _merged([block.lang[places] * 2, block.word[places] + 1, block.word[places + 1] + 1, third], np.ones(len(places), np.int64))
    number, own = {}, len(block.names) + 1
    if hot:
        wanted = {w for _, a, b in hot for w in (a, b)}
        found = block.names.cast(pa.binary()).to_pylist()
        number = {w: i + 1 for i, w in enumerate(found) if w in wanted}
    langs = {lang: i for i, lang in enumerate(block.langs)}
    pairs = [(langs[lang] * own + number[a]) * own + number[b] for lang, a, b in hot if lang in langs and a in number and b in number]
    if pairs:
        split = np.isin((columns[0] // 2 * own + columns[1]) * own + columns[2], pairs)
        alone, own_weight = _merged([*[c[split] for c in columns[:3]], np.zeros(split.sum(), np.int64)], weight[split])
        kept = ~split | (columns[3] > 0)  # split suffixes count triples alone
        columns[0] = columns[0] + split
        columns = [np.concatenate([c[kept], a]) for c, a in zip(columns, alone)]
        weight = np.concatenate([weight[kept], own_weight])
    return columns, weight


def _targets(block: Block, columns: list[np.ndarray], targets: int) -> np.ndarray:
    """By lang and two words, or by all three where the pair is hot."""
    of_word = np.array([0, *map(xxhash.xxh64_intdigest, block.names.to_pylist())], np.uint64)
    of_lang = np.array([xxhash.xxh64_intdigest(lang) for lang in block.langs], np.uint64)
    prime = np.uint64(0x9E3779B97F4A7C15)
    mixed = (of_lang[columns[0] // 2] * prime ^ of_word[columns[1]]) * prime ^ of_word[columns[2]]
    mixed = np.where(columns[0] % 2 == 1, mixed * prime ^ of_word[columns[3]], mixed) * prime
    return ((mixed >> np.uint64(20)) % np.uint64(targets)).astype(np.int64)


DEALT = "target int, langs array<string>, n int, data binary"


def _parcels(block: Block, columns: list[np.ndarray], weight: np.ndarray, targets: int, press) -> Iterator[tuple]:
    """Per target: langs, number of suffixes, and their words, columns and weights in one compressed value."""
    target = _targets(block, columns, targets)
    order = np.argsort(target, kind="stable")
    names, edges = block.names.to_pylist(), np.searchsorted(target[order], np.arange(targets + 1)) if targets < len(order) else None
    if edges is None:
        ids, first = np.unique(target[order], return_index=True)
        spans = zip(ids.tolist(), first.tolist(), [*first[1:].tolist(), len(order)])
    else:
        spans = zip(range(targets), edges[:-1].tolist(), edges[1:].tolist())
    for t, a, b in spans:
        if a == b:
            continue
        rows = order[a:b]
        words = np.concatenate([c[rows] for c in columns[1:]])
        used, own = np.unique(words, return_inverse=True)
        listed = b" ".join([names[i - 1] for i in used.tolist() if i])
        if used[0]:
            own = own + 1  # 0 stays the sign for no word
        packed = np.concatenate([columns[0][rows], own, weight[rows]]).astype("<i4")
        planes = packed.view(np.uint8).reshape(-1, 4).T.tobytes()
        yield t, block.langs, b - a, press.compress(len(listed).to_bytes(8, "little") + listed + planes)


class Suffixes:
    """The suffixes of one target, with words numbered for it."""

    def __init__(self, together: int = MERGE_ROWS):
        self.langs, self.names, self.columns, self.weight, self.rows, self.together = {}, None, None, None, 0, together
        self.fresh: list[tuple[list[str], list[bytes], np.ndarray]] = []

    def add(self, langs: list[str], n: int, data: bytes) -> None:
        size = int.from_bytes(data[:8], "little")
        planes = np.frombuffer(data, np.uint8, offset=8 + size)
        packed = np.ascontiguousarray(planes.reshape(4, -1).T).view("<i4").ravel().reshape(5, n).astype(np.int64)
        self.fresh.append((langs, data[8:8 + size].split(b" "), packed))
        self.rows += n
        if self.rows > self.together:
            self.merge()
            self.rows = 0

    def merge(self) -> None:
        held = [] if self.names is None else [self.names]
        told = pa.chunked_array([*held, *[pa.array(w, pa.binary()) for _, w, _ in self.fresh]]).combine_chunks().dictionary_encode()
        number, at = told.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, 0 if self.names is None else len(self.names)
        parts = [] if self.names is None else [[self.columns[0], *[np.concatenate([[0], number[:at]])[c] for c in self.columns[1:]], self.weight]]
        for langs, words, packed in self.fresh:
            own = np.concatenate([[0], number[at:at + len(words)]])
            lang = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs])
            parts.append([lang[packed[0] // 2] * 2 + packed[0] % 2, own[packed[1]], own[packed[2]], own[packed[3]], packed[4]])
            at += len(words)
        joined = [np.concatenate(c) for c in zip(*parts)]
        self.columns, self.weight = _merged(joined[:4], joined[4])
        self.names, self.fresh = told.dictionary, []


def equal_partitions(keys: list[np.ndarray], weight: np.ndarray, least: int, few: int = SMALL) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each depth d from 1: a pointer into each partition with d equal keys whose weight reaches ``least``, and that weight."""
    depths = len(keys)
    pointers, sums = [[] for _ in keys], [[] for _ in keys]
    small: list[list[np.ndarray]] = [[] for _ in keys]
    stack = [(np.arange(len(weight)), 0)]
    while stack:
        part, depth = stack.pop()
        if weight[part].sum() < least:
            continue
        if len(part) <= few:
            small[depth].append(part)
            continue
        key = keys[depth][part]
        sample = np.sort(key[::len(key) // 31])
        pivot = sample[len(sample) // 2]
        stack += [(part[key < pivot], depth), (part[key > pivot], depth)]
        same = part[key == pivot]
        total = weight[same].sum()
        if total >= least:
            pointers[depth].append(same[:1])
            sums[depth].append([total])
            if depth + 1 < depths:
                stack.append((same, depth + 1))
    part, group = np.empty(0, np.int64), np.empty(0, np.int64)  # what the depth before left, and its partitions
    for depth in range(depths):
        base = int(group[-1]) + 1 if len(group) else 0
        sizes = [len(p) for p in small[depth]]
        part = np.concatenate([part, *small[depth]])
        group = np.concatenate([group, np.repeat(np.arange(base, base + len(sizes)), sizes)])
        if not len(part):
            continue
        order = np.argsort(group * (int(keys[depth].max()) + 1) + keys[depth][part], kind="stable")
        part, group = part[order], group[order]
        key = keys[depth][part]
        first = np.flatnonzero((np.diff(group, prepend=-1) != 0) | (np.diff(key, prepend=key[0] - 1) != 0))
        total = np.add.reduceat(weight[part], first)
        kept = total >= least
        pointers[depth].append(part[first[kept]])
        sums[depth].append(total[kept])
        lengths = np.diff(np.append(first, len(part)))
        stays = np.repeat(kept, lengths)
        part, group = part[stays], np.repeat(np.arange(kept.sum()), lengths[kept])
    return [(np.concatenate([np.empty(0, np.int64), *p]), np.concatenate([np.empty(0, np.int64), *s])) for p, s in zip(pointers, sums)]


def _found(suffixes: Suffixes, least: int) -> Iterator[tuple[pa.Array, pa.Array, pa.Array]]:
    """lang, phrase, count of the frequent pairs and triples of a target."""
    if suffixes.fresh:
        suffixes.merge()
    columns = suffixes.columns
    langs = pa.array(list(suffixes.langs), pa.string())
    for depth, (at, n) in enumerate(equal_partitions(columns, suffixes.weight, least), 1):
        if depth < 3:
            continue
        real = columns[0][at] % 2 == 0 if depth == 3 else columns[3][at] > 0
        at, n = at[real], n[real]
        yield langs.take(pa.array(columns[0][at] // 2)), _strings(suffixes.names, *[c[at] - 1 for c in columns[1:depth]]), pa.array(n)


def frequent(docs: DataFrame, least: int = LEAST, chars: int = BLOCK_CHARS, share: int = HOT_SHARE, room: int = SUFFIXES_A_TARGET) -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, n) of all phrases of up to three words that occur ``least`` times, and (lang, n) of all words.

    ``chars`` a block, the ``share`` of a hot pair and the ``room`` of a target are tuning values.
    """
    told = arrow_schema(COUNTED)
    rows = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, chars):
            if block.n:
                yield from _counts(block, share, told)

    counted = rows.mapInArrow(count, COUNTED).groupBy("kind", "lang", "phrase").agg(F.sum("n").alias("n"))
    counted = materialise(counted.filter((F.col("kind") == TOTAL) | (F.col("n") >= least)), "words")
    totals = counted.filter(F.col("kind") == TOTAL).select("lang", "n")
    places = totals.agg(F.sum("n")).first()[0] or 0
    # at most 2 * share rows
    led = counted.filter((F.col("kind") == PAIR) & (F.col("n") >= places / (2 * share))).select("lang", "phrase").collect()
    hot = {(r.lang, *r.phrase.encode().split(b" ")) for r in led}
    targets = max(1, places // room)
    dealt, out = arrow_schema(DEALT), arrow_schema("lang string, phrase string, n long")

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for block in blocks(batches, chars):
            if block.n < 2:
                continue
            for t, langs, n, data in _parcels(block, *_suffixes(block, hot), targets, press):
                yield pa.RecordBatch.from_arrays([pa.array([c], f.type) for c, f in zip((t, langs, n, data), dealt)], schema=dealt)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack, held, last = zstandard.ZstdDecompressor(), None, None
        for b in slices(batches, 1):
            t, langs, n, data = (c[0].as_py() for c in b.columns)
            if held is not None and t != last:
                for columns in _found(held, least):
                    yield pa.RecordBatch.from_arrays(list(columns), schema=out)
                held = None
            held, last = held or Suffixes(), t
            held.add(langs, n, unpack.decompress(data))
        if held is not None:
            for columns in _found(held, least):
                yield pa.RecordBatch.from_arrays(list(columns), schema=out)

    parcels = rows.mapInArrow(deal, DEALT)
    if targets <= MOST_PARTITIONS:
        parcels = parcels.repartitionById(targets, F.col("target"))
    else:
        parcels = parcels.repartition(MOST_PARTITIONS, "target")
    longer = parcels.sortWithinPartitions("target").mapInArrow(sort, "lang string, phrase string, n long")
    words = counted.filter(F.col("kind") == PHRASE).select("lang", "phrase", "n")
    return words.unionByName(materialise(longer, "phrases")), totals


def collocations(docs: DataFrame, least: int = LEAST, first: int = FIRST, inside: int = INSIDE, **tuning: int) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``first`` best candidates of each language."""
    known, totals = frequent(docs, least, **tuning)
    words = F.split("phrase", " ")
    candidates = known.withColumn("words", words).filter(F.size("words") > 1).withColumnRenamed("n", "a")
    parts = F.array(F.array_join(F.slice("words", 1, 2), " "), F.array_join(F.slice("words", 2, 2), " "))
    longer = candidates.filter(F.size("words") == LONGEST).select("lang", F.explode(parts).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    kept = candidates.join(longer, ["lang", "phrase"], "left").filter(f"most is null or 100 * most < {inside} * a")
    cuts = kept.select("lang", "phrase", "a", "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("words", F.col("k") + 1, F.size("words") - F.col("k")), " ").alias("right"))
    lefts = known.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    rights = known.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    wide = "decimal(19,0)"
    score = F.expr(f"(cast(a as {wide}) * cast(a as {wide}) * cast({SCALE} as decimal(7,0))) div (cast(l as {wide}) * cast(r as {wide}))")
    scored = cuts.join(lefts, ["lang", "left"]).join(rights, ["lang", "right"]).withColumn("score", score)
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= first)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
  from documents),
worded as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
placed as (select lang, ws, unnest(range(1, len(ws) + 1)) as i from worded),
sized as (select lang, ws, i, unnest([1, 2, 3]) as k from placed),
f as (select lang, array_to_string(ws[i:i + k - 1], ' ') as phrase, k, count(*) as f from sized where i + k - 1 <= len(ws) group by all),
totals as (select lang, sum(f) as n from f where k = 1 group by lang),
cand as (select lang, phrase, k, f as a, string_split(phrase, ' ') as w from f where k > 1 and f >= 10),
longer as (
  select lang, phrase, max(a) as most from (
    select lang, w[1] || ' ' || w[2] as phrase, a from cand where k = 3 union all select lang, w[2] || ' ' || w[3], a from cand where k = 3)
  group by all),
kept as (select c.* from cand c left join longer g on c.lang = g.lang and c.phrase = g.phrase and c.k = 2 where most is null or 100 * most < 50 * a),
cuts as (
  select lang, phrase, a, 1 as cut, w[1] as lw, array_to_string(w[2:], ' ') as rw from kept
  union all select lang, phrase, a, 2, w[1] || ' ' || w[2], w[3] from kept where k = 3),
scored as (
  select c.lang, c.phrase, c.a, c.cut, x.f as l, y.f as r, (1000000::hugeint * c.a * c.a) // (x.f::hugeint * y.f) as score
  from cuts c join f x on x.lang = c.lang and x.phrase = c.lw join f y on y.lang = c.lang and y.phrase = c.rw),
best as (select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
ranked as (select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from best)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""


def op12_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return collocations(documents(spark, sf))
