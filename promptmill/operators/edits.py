"""Translation edit rate: insertions, deletions, substitutions and shifts of whole runs of words, per reference word.

An edit distance with free moves is hard, so shifts are found greedily: of all runs of the prediction that also stand in the
reference, the move that lowers the word edit distance most is made and costs one edit, until none lowers it.  A run is moved
only if it holds a word that is out of place and its place in the reference is not matched; among equal moves the longest run wins,
then the one that starts first, then the nearest to the front.  All texts of a batch go through a round together,
and so do their moves: before the words that a move changes the distances are those of the text as it is, and behind them as well, from
the end; only the changed words are filled in, word by word for all moves.

Defined results: words are split at white space and lower-cased unless ``case`` is set; null counts as the empty text; with several
references the fewest edits count and the mean of their lengths; against no reference words the rate is 100 where there are edits, else 0.
The work of a row grows with the product of both lengths; texts are never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.text import col_of
from promptmill.session import by_rows

# The longest run that is moved, and how far apart its places in both texts may be.
LONGEST_RUN, FARTHEST = 10, 50
TOGETHER = 512  # rows, a tuning value


# A row of a distance table is kept as bits (Myers 1999, Hyyro 2003): where it goes up and where it goes down from one reference
# word to the next.  Arrays of bits are (64-bit words, ..., texts), so that a step handles all texts and 64 reference words at a time.


def numbered(hypothesis: list, reference: list) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Both texts as numbers (hypothesis words that the reference lacks share one), and for each number the places
    where it stands in the reference, as bits, from the front and from the end."""
    known = {w: k for k, w in enumerate(dict.fromkeys(reference))}
    h, r = (np.array([known.get(w, len(known)) for w in words], np.int64) for words in (hypothesis, reference))

    def bits(row: np.ndarray) -> np.ndarray:
        out = np.zeros((len(known) + 1, -(-len(row) // 64) * 8), np.uint8)
        packed = np.packbits(np.arange(len(known) + 1)[:, None] == row[None, :], axis=1, bitorder="little")
        out[:, :packed.shape[1]] = packed
        return out.view("<u8")

    return h, r, bits(r), bits(r[::-1])


def padded(rows: list[np.ndarray]) -> np.ndarray:
    """Word numbers of several texts, a row each, 0 behind the end."""
    out = np.zeros((len(rows), max(map(len, rows))), np.int64)
    for row, words in zip(out, rows):
        row[:len(words)] = words
    return out


def stacked(marks: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The places of all texts' numbers in one array, and where each text's begin in it."""
    counts = np.array([len(m) for m in marks])
    out = np.zeros((max(m.shape[1] for m in marks), counts.sum()), "<u8")
    begins = np.cumsum(counts) - counts
    for m, at in zip(marks, begins.tolist()):
        out[:m.shape[1], at:at + len(m)] = m.T
    return out, begins


def advance(equal: np.ndarray, up: np.ndarray, down: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The next rows behind one more hypothesis word, ``equal`` to the reference at these places.

    Also where the distance stays as it was one word before on both sides, and where it is one more than in the row above.
    """
    total = (equal & up) + up
    carry, high = total[:-1] < up[:-1], total[1:]
    while carry.any():
        high += carry
        over = carry & (high == 0)
        carry = np.zeros_like(carry)
        carry[1:] = over[:-1]
    same = (total ^ up) | equal | down
    more, less = down | ~(same | up), up & same
    more_, less_ = more << 1, less << 1
    more_[1:] |= more[:-1] >> 63
    less_[1:] |= less[:-1] >> 63
    more_[0] |= 1
    return less_ | ~(same | more_), more_ & same, same, more


def tables(hypotheses: np.ndarray, marks: np.ndarray, begins: np.ndarray, ways: bool = False) -> tuple[np.ndarray, ...]:
    """Rows up and down for all beginnings of padded hypotheses; with ``ways`` also, for each word, where no best alignment
    comes over both words, and where one comes over the hypothesis word alone.

    What stands behind the end of a text changes nothing in front of it.
    """
    n, rows = hypotheses.shape
    ups, downs = (np.zeros((len(marks), rows + 1, n), "<u8") for _ in range(2))
    ups[:, 0] = ~np.uint64(0)
    apart, alone = (np.empty((len(marks), rows, n), "<u8") for _ in range(2)) if ways else (None, None)
    for i in range(rows):
        equal = marks.take(begins + hypotheses[:, i], axis=1)
        ups[:, i + 1], downs[:, i + 1], same, more = advance(equal, ups[:, i], downs[:, i])
        if ways:
            apart[:, i], alone[:, i] = same & ~equal, more
    return ups, downs, apart, alone


def unpacked(bits: np.ndarray) -> np.ndarray:
    """A row of 0 and 1 for each text."""
    return np.unpackbits(np.ascontiguousarray(bits.T).view(np.uint8), axis=1, bitorder="little")


def rows_of(up: np.ndarray, down: np.ndarray, first: np.ndarray, width: int) -> np.ndarray:
    """Rows of distances, ``first`` in front, against up to ``width`` reference words."""
    out = np.empty((up.shape[1], width + 1), np.int32)
    out[:, 0] = first
    np.subtract(unpacked(up)[:, :width], unpacked(down)[:, :width], out=out[:, 1:], dtype=np.int32)
    return np.cumsum(out, axis=1, out=out)


def distance_table(hypothesis: np.ndarray, reference: np.ndarray) -> np.ndarray:
    """Edit distances of all beginnings: a row for each number of hypothesis words."""
    h, r, ahead, _ = numbered(hypothesis.tolist(), reference.tolist())
    ups, downs, _, _ = tables(h[None, :], *stacked([ahead]))
    return rows_of(ups[:, :, 0], downs[:, :, 0], np.arange(len(h) + 1), len(r))


def alignment(apart: np.ndarray, alone: np.ndarray, hypothesis: np.ndarray, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each reference word the last hypothesis word at or before it (-1: none); which hypothesis words and which reference words are wrong."""
    i, j = len(hypothesis), len(reference)
    bits = unpacked(apart[:, :i])
    way, width = (2 * (1 - bits) + unpacked(alone[:, :i])).tobytes(), bits.shape[1]
    h, r = hypothesis.tolist(), reference.tolist()
    at, wrong_h, wrong_r = [-1] * j, [True] * i, [True] * j
    while i and j:
        step = way[(i - 1) * width + j - 1]
        if step >= 2:
            i, j = i - 1, j - 1
            at[j] = i
            wrong_h[i] = wrong_r[j] = h[i] != r[j]
        elif step:
            i -= 1
        else:
            j -= 1
            at[j] = i - 1
    return np.array(at, np.int64), np.array(wrong_h, bool), np.array(wrong_r, bool)


def moves(hypothesis: np.ndarray, reference: np.ndarray, at: np.ndarray, wrong_h: np.ndarray, wrong_r: np.ndarray) -> list[tuple[int, int, int]]:
    """(length, start, target): runs worth trying and the place, in front of a word, where they go."""
    equal = hypothesis[:, None] == reference[None, :]
    errors_h, errors_r = (np.concatenate([[0], np.cumsum(wrong)]) for wrong in (wrong_h, wrong_r))
    starts, places = np.nonzero(equal)
    near = np.abs(starts - places) <= FARTHEST
    starts, places = starts[near], places[near]
    targets, found = at.tolist(), set()
    for length in range(1, LONGEST_RUN + 1):
        if length > 1:
            fits = (starts + length <= len(hypothesis)) & (places + length <= len(reference))
            starts, places = starts[fits], places[fits]
            on = equal[starts + length - 1, places + length - 1]
            starts, places = starts[on], places[on]
        if not len(starts):
            break
        here = at[places]
        good = ((errors_h[starts + length] > errors_h[starts]) & (errors_r[places + length] > errors_r[places])
                & ~((starts <= here) & (here < starts + length)))
        for start, place in zip(starts[good].tolist(), places[good].tolist()):
            found.add((length, start, targets[place - 1] + 1 if place else 0))
            found.update((length, start, t + 1) for t in targets[place:place + length])
    return sorted(found, key=lambda m: (-m[0], m[1], m[2]))


def changed(hypothesis: np.ndarray, length: int, start: int, target: int) -> tuple[int, np.ndarray]:
    """Where a move begins to change the text, and the words from there to where it ends to.

    The run is taken out and put in front of word ``target``; a target inside the run counts in the words that remain.
    """
    k = min(target - length if target > start + length else target, len(hypothesis) - length)
    run = hypothesis[start:start + length]
    if k <= start:
        return k, np.concatenate([run, hypothesis[k:start]])
    return start, np.concatenate([hypothesis[start + length:k + length], run])


def distances(texts: np.ndarray, parts: list[tuple[int, np.ndarray]], sizes_h: np.ndarray, sizes_r: np.ndarray, marks: np.ndarray,
              begins: np.ndarray, front: tuple[np.ndarray, np.ndarray], back: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Edit distance after each change of the text with that number.

    ``front`` holds the rows of all beginnings of the texts as they are, ``back`` those of the texts read from their ends.
    """
    sizes = np.array([len(words) for _, words in parts])
    order = np.argsort(-sizes, kind="stable")
    sizes, owner = sizes[order], texts[order]
    filled = padded([parts[k][1] for k in order]) + begins[owner][:, None]
    first = np.array([parts[k][0] for k in order])
    up, down = (x[:, first, owner] for x in front)
    counts = np.searchsorted(-sizes, -np.arange(filled.shape[1])).tolist()  # those with more words than step stand in front
    for step, open_ in enumerate(counts):
        up[:, :open_], down[:, :open_], _, _ = advance(marks.take(filled[:open_, step], axis=1), up[:, :open_], down[:, :open_])
    width = int(sizes_r[owner].max())
    ends = sizes_h[owner] - first - sizes
    total = rows_of(up, down, first + sizes, width)
    behind = rows_of(*(x[:, ends, owner] for x in back), ends, width)
    rest = sizes_r[owner][:, None] - np.arange(width + 1)
    total += np.take_along_axis(behind, np.maximum(rest, 0), axis=1)
    found = np.empty(len(parts), np.int64)
    found[order] = np.where(rest >= 0, total, np.iinfo(np.int32).max).min(axis=1)
    return found


def _round(texts: list[tuple[np.ndarray, ...]], cells: int) -> list[tuple[int, tuple[int, np.ndarray] | None]]:
    """Of each numbered pair of texts the distance and the best change, if any lowers it."""
    sizes_h, sizes_r = (np.array([len(t[k]) for t in texts]) for k in (0, 1))
    marks, begins = stacked([t[2] for t in texts])
    ups, downs, apart, alone = tables(padded([t[0] for t in texts]), marks, begins, ways=True)
    each = np.arange(len(texts))
    last = rows_of(ups[:, sizes_h, each], downs[:, sizes_h, each], sizes_h, int(sizes_r.max()))
    now = last[each, sizes_r].tolist()
    tried = [(k, m) for k, (h, r, _, _) in enumerate(texts) if now[k]
             for m in moves(h, r, *alignment(apart[:, :, k], alone[:, :, k], h, r))]
    del apart, alone
    best, to = list(now), [None] * len(texts)
    if tried:
        back = tables(padded([t[0][::-1] for t in texts]), *stacked([t[3] for t in texts]))[:2]
    together = max(1, cells // last.shape[1])
    for at in range(0, len(tried), together):
        # a move of n words saves 2 n edits at most
        some = [(k, m) for k, m in tried[at:at + together] if to[k] is None or now[k] - best[k] < 2 * m[0]]
        if not some:
            continue
        parts = [changed(texts[k][0], *m) for k, m in some]
        found = distances(np.array([k for k, _ in some]), parts, sizes_h, sizes_r, marks, begins, (ups, downs), back).tolist()
        for (k, _), part, edits in zip(some, parts, found):
            if edits < best[k]:
                best[k], to[k] = edits, part
    return list(zip(now, to))


def shifted_edits_of(pairs: list[tuple[list[str], list[str]]], cells: int = 4_000_000) -> list[tuple[int, int]]:
    """Edits with shifts of each pair of texts, and how many of them are shifts.

    Pairs go through a round together, as many as have about ``cells`` bytes of rows, or one; moves as many as have that many numbers.
    """
    done: list[tuple[int, int]] = [(len(h) + len(r), 0) for h, r in pairs]
    waiting = [(k, numbered(h, r), 0) for k, (h, r) in enumerate(pairs) if h and r]
    waiting.sort(key=lambda w: (len(w[1][0]), len(w[1][1])))
    while waiting:
        left, at = [], 0
        while at < len(waiting):
            end, widest = at, 0
            while end < len(waiting):  # sorted by their hypotheses, so the last has the most rows
                widest = max(widest, waiting[end][1][2].shape[1])
                if end > at and (end + 1 - at) * (len(waiting[end][1][0]) + 1) * widest * 8 > cells:
                    break
                end += 1
            unit = waiting[at:end]
            for (k, texts, shifts), (now, to) in zip(unit, _round([texts for _, texts, _ in unit], cells)):
                if to is None:
                    done[k] = now + shifts, shifts
                else:
                    texts[0][to[0]:to[0] + len(to[1])] = to[1]
                    left.append((k, texts, shifts + 1))
            at = end
        waiting = left
    return done


def shifted_edits(hypothesis: list[str], reference: list[str], cells: int = 4_000_000) -> tuple[int, int]:
    """Edits with shifts, and how many of them are shifts; about ``cells`` numbers of moves are held at a time."""
    return shifted_edits_of([(hypothesis, reference)], cells)[0]


def edit_rows(df: DataFrame, key: str, prediction: Column | str, references: Column | str, case: bool = False) -> DataFrame:
    """key, edits, shifts, words: the fewest edits to any of the ``references`` (an array), and the mean of their lengths."""
    def words(text: Column) -> Column:
        plain = F.coalesce(text, F.lit(""))
        return F.filter(F.split(plain if case else F.lower(plain), r"\s+"), lambda w: w != "")

    texts = df.select(F.col(key).alias("_key"), col_of(prediction).alias("p"), col_of(references).alias("r"))
    rows = by_rows(texts).select("_key", words(F.col("p")).alias("p"), F.transform("r", words).alias("r"))
    kind = rows.schema["_key"].dataType.simpleString()
    schema = f"_key {kind}, edits long, shifts long, words double"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in (b.slice(at, TOGETHER) for b in batches for at in range(0, b.num_rows, TOGETHER)):
            sides = list(zip(b.column(1).to_pylist(), b.column(2).to_pylist()))
            scores = iter(shifted_edits_of([(p, r) for p, several in sides for r in several]))
            found = []
            for p, several in sides:
                edits, shifts = min((next(scores) for _ in several), default=(len(p), 0))
                found.append((edits, shifts, sum(map(len, several)) / max(1, len(several))))
            columns = [pa.array(c, t) for c, t in zip(zip(*found), (pa.int64(), pa.int64(), pa.float64()))]
            yield pa.RecordBatch.from_arrays([b.column(0), *columns], names=["_key", "edits", "shifts", "words"])

    return rows.mapInArrow(run, schema).withColumnRenamed("_key", key)


def rate(edits: Column, words: Column) -> Column:
    return F.when(words > 0, 100 * edits / words).when(edits > 0, 100.0).otherwise(0.0)


def corpus_ter(df: DataFrame, key: str, prediction: Column | str = "prediction", references: Column | str = "references",
               case: bool = False, by: tuple[str, ...] = ()) -> DataFrame:
    """Translation edit rate of a whole table (of each group of ``by``), with its edits and reference words."""
    rows = edit_rows(df.withColumn("_id", F.struct(*dict.fromkeys([key, *by]))), "_id", prediction, references, case)
    sums = rows.groupBy(*[F.col(f"_id.{c}").alias(c) for c in by]).agg(
        F.coalesce(F.sum("edits"), F.lit(0)).alias("edits"), F.coalesce(F.sum("words"), F.lit(0.0)).alias("words"))
    return sums.withColumn("ter", rate(F.col("edits"), F.col("words")))
