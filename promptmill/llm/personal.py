"""Personal data: fixed forms, and identifiers found by bootstrapped lexical contexts.

Fixed forms (e-mail, IP address, card, phone) are found by pattern and check and are the seeds.  A pattern is the one
word or the two words before a mention, lower-cased, digits masked.  Mentions are the seeds and what looks like an identifier
outside of them: words of four letters or digits at least, one a digit, and groups of digits with a space between them, as one.  Spark
scores the graph of patterns and mentions in rounds:

* a pattern's confidence is the score-weighted share of its mentions among all occurrences of its words in all texts;
* a mention that is no seed scores as its best pattern that at least ``SUPPORT`` accepted mentions support, rounded down to ``STEPS``.

Scores only rise and have ``STEPS`` values, so the rounds end at a fixpoint, when a round leaves their sum as it was.  Patterns with
confidence and support then add the identifiers they precede, as kind "other".  Patterns with
fewer than SUPPORT different mentions can never count and are left out of the graph; the occurrences of the rest are
counted behind a bit set of fixed size, so nothing that grows with the corpus is broadcast.

Defined results: null and empty texts hold nothing; equal texts get equal spans; repeated rows stay rows of their own;
null ids are kept; other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.llm.common import Memo, arrow_schema, documents, slices, texts, unused
from promptmill.session import materialise

KINDS = ["email", "ip", "card", "phone", "other"]
SUPPORT, CONFIDENCE, STEPS = 3, 0.5, 64
FILTER_BITS = 24

# A run of e-mail letters is taken whole, with what follows if that completes an address, so long runs cost linear time.
_EMAIL = re.compile(r"[A-Za-z0-9._%+-]++(?:@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+)?")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_DIGIT = re.compile(r"[0-9]")
# digits, and signs inside a number
_GROUP = re.compile(r"[0-9][0-9/.-]*")
_EDGE = "\"'`()[]{}<>,.;:!?=*"


def _luhn(digits: str) -> bool:
    double = [2 * int(d) - 9 * (d > "4") for d in digits[-2::-2]]
    return (sum(double) + sum(map(int, digits[::-2]))) % 10 == 0


def _ip_ok(found: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p[-4:].lstrip("0") or 0) <= 255 for p in found.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed forms, by kind, then start; matches that fail their check are dropped."""
    if not _ANY.search(text):
        return []
    found = []
    if "@" in text:
        found += [(0, *m.span()) for m in _EMAIL.finditer(text) if m[1]]
    if "." in text:
        found += [(1, *m.span()) for m in _IP.finditer(text) if _ip_ok(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = m[0].replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and _luhn(digits):
                found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 9 <= len(_DIGIT.findall(m[0])) <= 15]
    return found


def identifiers(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Spans, without edge punctuation, that look like an identifier and touch no base span; digit groups one space apart are one."""
    words: list[tuple[int, int, bool]] = []
    taken, at = sorted((a, b) for _, a, b in base), 0
    for m in re.finditer(r"\S+", text):
        if not _DIGIT.search(m[0]):
            continue
        start = m.start() + len(m[0]) - len(m[0].lstrip(_EDGE))
        end = m.start() + len(m[0].rstrip(_EDGE))
        while at < len(taken) and taken[at][1] <= start:
            at += 1
        if any(a < end and start < b for a, b in taken[at:at + 5]):
            continue
        group = _GROUP.fullmatch(text, start, end) is not None
        if words and group and start == m.start() and words[-1][2] and words[-1][1] + 1 == start and text[start - 1] == " ":
            words[-1] = (words[-1][0], end, group)
        else:
            words.append((start, end, group))
    return [(start, end) for start, end, _ in words if sum(map(str.isalnum, text[start:end])) >= 4]


def _masked(word: str) -> str:
    return _DIGIT.sub("0", word.lower())


def _hash(word: str) -> int:
    return xxhash.xxh64_intdigest(_masked(word).encode())


_MIX = 0x9E3779B97F4A7C15
_ALL = (1 << 64) - 1


def contexts(text: str, start: int) -> list[tuple[str, int]]:
    """The patterns, one word and two words, that end before ``start``: their words and code."""
    size = 64
    while True:
        piece = text[max(0, start - size):start]
        own = piece.split()
        if start <= size or len(own) > 2:
            break
        size *= 4
    own = own[-2:]
    out = []
    if own:
        out.append((_masked(own[-1]), _signed(_hash(own[-1]))))
    if len(own) == 2:
        out.append((f"{_masked(own[0])} {_masked(own[1])}", _signed((_hash(own[0]) * _MIX & _ALL) ^ _hash(own[1]))))
    return out


def _signed(h: int) -> int:
    return h - (1 << 64) if h >> 63 else h


_SPANS = "array<struct<kind:int,start:int,end:int>>"
_MENTIONS = "array<struct<pattern:string,code:bigint,instance:bigint,seed:boolean,start:int,end:int>>"


def mentions(df: DataFrame, key: str, text: str) -> DataFrame:
    """row, key, digest and length of the text, its base spans, and a mention for each pattern of each span."""
    rows = df.select(F.col(key).alias("key"), F.xxhash64(text).alias("digest"), F.coalesce(F.length(text), F.lit(0)).alias("length"),
                     F.col(text).cast("string").alias("text"))
    schema = f"key {rows.schema['key'].dataType.simpleString()}, digest long, length int, base {_SPANS}, mentions {_MENTIONS}"
    out = arrow_schema(f"base {_SPANS}, mentions {_MENTIONS}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            base, found = [], []
            for t in texts(b.column(3)):
                own = base_spans(t)
                base.append([{"kind": k, "start": s, "end": e} for k, s, e in own])
                more = [(s, e, False) for s, e in identifiers(t, own)] if _DIGIT.search(t) else []
                found.append([{"pattern": p, "code": c, "instance": _signed(_hash2(t[s:e])), "seed": seed, "start": s, "end": e}
                              for s, e, seed in [(s, e, True) for _, s, e in own] + more for p, c in contexts(t, s)])
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(base, out.field(0).type), pa.array(found, out.field(1).type)],
                                             schema=pa.schema([*list(b.schema)[:3], *out]))

    return rows.mapInArrow(run, schema).withColumn("row", F.monotonically_increasing_id())


def _hash2(found: str) -> int:
    return xxhash.xxh64_intdigest(found.lower().encode())


def occurrences(df: DataFrame, text: str, codes: DataFrame) -> DataFrame:
    """code, total: how often the words of each pattern in ``codes`` stand in the texts with a word after them."""
    bits = 1 << FILTER_BITS
    slots = codes.select(F.pmod("code", F.lit(bits)).cast("int").alias("slot"))
    # the set's words of 64 bits: at most 2^18 rows of 16 bytes however many patterns there are
    filled = slots.groupBy((F.col("slot") / 64).cast("int").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits")).toPandas()
    mask = np.zeros(bits // 64, np.int64)
    mask[filled["word"].to_numpy(np.int64)] = filled["bits"].to_numpy(np.int64)
    flags = mask.view(np.uint64)
    out = arrow_schema("code long, total long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo, mix, counts = Memo(_hash), np.uint64(_MIX), Counter()

        def emit() -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.int64()), pa.array(list(counts.values()), pa.int64())], schema=out)
            counts.clear()
            return made

        for b in slices(batches):
            for t in texts(b.column(0)):
                own = t.split()[:-1]
                if not own:
                    continue
                one = np.fromiter(map(memo.__getitem__, own), np.uint64, len(own))
                memo.turn()
                code = np.concatenate([one, (one[:-1] * mix) ^ one[1:]])
                slot = code & np.uint64(bits - 1)
                hit = code[(flags[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)) > 0]
                if hit.size:
                    value, n = np.unique(hit.view(np.int64), return_counts=True)
                    counts.update(dict(zip(value.tolist(), n.tolist())))
            if len(counts) > 200_000:
                yield emit()
        if counts:
            yield emit()

    counted = df.select(F.col(text).cast("string")).mapInArrow(run, "code long, total long")
    return counted.groupBy("code").agg(F.sum("total").alias("total")).join(codes.select("code"), "code", "left_semi")


def strong_patterns(df: DataFrame, text: str, found: DataFrame) -> DataFrame:
    """pattern, code, confidence, support of the patterns that hold at the fixpoint."""
    edges = (found.select(F.explode("mentions").alias("m")).groupBy("m.code", "m.instance")
             .agg(F.min("m.pattern").alias("pattern"), F.max("m.seed").alias("seed"), F.count("*").alias("n")))
    edges = materialise(edges, "edges")
    codes = materialise(edges.groupBy("code").agg(F.min("pattern").alias("pattern"), F.count("*").alias("kinds"), F.sum("n").alias("seen"))
                        .filter(F.col("kinds") >= SUPPORT), "patterns")
    codes = materialise(codes.join(occurrences(df, text, codes), "code", "left")
                        .select("code", "pattern", F.greatest("seen", "total").alias("total")), "patterns")
    edges = materialise(edges.join(codes.select("code"), "code", "left_semi"), "edges")
    seeds = edges.groupBy("instance").agg(F.max("seed").cast("double").alias("score"))
    scores, reached = seeds, None
    while True:
        of = edges.join(scores, "instance").groupBy("code").agg(
            F.sum(F.col("score") * F.col("n")).alias("weight"), F.count_if(F.col("score") >= CONFIDENCE).alias("support"))
        rated = materialise(codes.join(of, "code").select("pattern", "code", (F.col("weight") / F.col("total")).alias("confidence"), "support"), "rated")
        step = F.floor(F.col("confidence") * STEPS) / STEPS
        best = edges.join(rated.filter(F.col("support") >= SUPPORT), "code").groupBy("instance").agg(F.max(step).alias("best"))
        scores = materialise(seeds.join(best, "instance", "left").select("instance", F.greatest("score", "best").alias("score")), "scores")
        before, reached = reached, scores.agg(F.sum("score")).first()[0]
        if reached == before:
            break
    return rated.filter((F.col("support") >= SUPPORT) & (F.col("confidence") >= CONFIDENCE))


def personal_data(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, digest, length of the text, base (spans of fixed forms) and more (spans that patterns add), for every row."""
    found = materialise(mentions(df, key, text), "mentions")
    strong = strong_patterns(df, text, found)
    more = (found.select("row", F.explode("mentions").alias("m")).filter("not m.seed").select("row", "m.*")
            .join(strong.select("code"), "code", "left_semi").groupBy("row")
            .agg(F.array_sort(F.collect_set(F.struct(F.lit(KINDS.index("other")).alias("kind"), "start", "end"))).alias("more")))
    return found.join(more, "row", "left").select(F.col("key").alias(key), "digest", "length", "base",
                                                  F.coalesce("more", F.array().cast(_SPANS)).alias("more"))


def _listed(spans):
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.get(kinds, x.kind), x.start, x.end)), ",")


def op8_personal(spark: SparkSession, sf: str) -> DataFrame:
    found = personal_data(documents(spark, sf))
    counts = [F.expr(f"cast(size(filter(base, x -> x.kind = {k})) as long)").alias(f"n_{name}") for k, name in enumerate(KINDS[:4])]
    return found.select("doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"), _listed(F.concat("base", "more")).alias("spans"))


def redact(text: str, spans: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced as one, by the first's kind."""
    out, at, end = [], 0, 0
    for start, stop, kind in sorted((s, e, k) for k, s, e in spans):
        if start >= end:
            out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end = max(end, stop)
    return "".join([*out, text[at:]])


def stage(spark: SparkSession, docs: DataFrame, sf: str) -> DataFrame:
    """All rows; personal data in the text replaced by its kind, with n_chars of the new text."""
    found = personal_data(docs).filter((F.size("base") > 0) | (F.size("more") > 0))
    added = unused("_spans", docs.columns)
    found = found.select(F.col("doc_id").alias("_id"), "digest", "length", F.concat("base", "more").alias(added)).dropDuplicates(["_id", "digest", "length"])
    same = docs.doc_id.eqNullSafe(found["_id"]) & (F.xxhash64(docs.text) == found["digest"]) & (F.length(docs.text) == found["length"])
    names, schema = docs.columns, docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        text, n = names.index("text"), names.index("n_chars")
        for b in slices(batches):
            old, sizes = b.column(text).to_pylist(), b.column(n).to_pylist()
            for i, spans in enumerate(b.column(len(names)).to_pylist()):
                if spans:
                    old[i] = redact(old[i], [(s["kind"], s["start"], s["end"]) for s in spans])
                    sizes[i] = len(old[i])
            columns = b.columns[:len(names)]
            columns[text], columns[n] = pa.array(old, columns[text].type), pa.array(sizes, columns[n].type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.join(found, same, "left").select(*[docs[c] for c in names], found[added]).mapInArrow(run, schema)
