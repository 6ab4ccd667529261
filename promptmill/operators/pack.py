"""Packing: restartable running budgets, bins, packed rows, padding, unpacking.

A budget that starts over when it is full is a fold, not a window frame.  It runs over (id, length) only; token arrays
are joined to the result afterwards.  Bins, stream blocks and character buffers are one sequence over the whole table
(``folds``); where the operation itself has a buffer of rows, the fold restarts with each buffer.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.arrays import indices, let
from promptmill.functions.text import col_of
from promptmill.functions.tokens import EOS, IGNORED, PAD
from promptmill.operators import folds
from promptmill.operators.order import chunk_of, ranked
from promptmill.operators.split import batches
from promptmill.session import materialise


def greedy_blocks(rows: Column, fresh: Column, grow: Callable[[Column, Column], Column],
                  fits: Callable[[Column, Column], Column]) -> Column:
    """Cuts an ordered array into blocks: a row opens a new block when it does not fit the running state.

    The fold keeps block starts only, so it stays linear in the number of rows.
    """
    begin = F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).alias("i"), fresh.alias("state"))

    def step(acc: Column, row: Column) -> Column:
        def placed(stay: Column) -> Column:
            starts = F.when(stay, acc["starts"]).otherwise(F.concat(acc["starts"], F.array(acc["i"])))
            state = let(F.when(stay, acc["state"]).otherwise(fresh), lambda s: grow(s, row))
            return F.struct(starts.alias("starts"), (acc["i"] + 1).cast("int").alias("i"), state.alias("state"))

        return let((acc["i"] > 0) & fits(acc["state"], row), placed)

    def cut(starts: Column) -> Column:
        n = F.size(starts)
        return F.transform(starts, lambda a, k: F.slice(
            rows, a + 1, F.when(k + 1 < n, starts[k + 1]).otherwise(F.size(rows)) - a))

    return let(F.aggregate(rows, begin, step, lambda acc: acc["starts"]), cut)


def chunked(df: DataFrame, key: str, fields: list[str], chunk_rows: int, ordinal: str = "ordinal",
            by: tuple[str, ...] = ()) -> DataFrame:
    """(chunk, rows): the ordered small records of each buffer of rows (and of each ``by`` group inside it)."""
    record = F.struct(F.col(ordinal).alias("ordinal"), F.col(key).alias("key"), *fields)
    return (df.withColumn("chunk", chunk_of(ordinal, chunk_rows)).groupBy("chunk", *by)
            .agg(F.sort_array(F.collect_list(record)).alias("rows")))


def flat_blocks(grouped: DataFrame, blocks: Column, key: str, fields: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """(chunk, block, place, key, fields): one row per record."""
    per_block = grouped.select("chunk", *by, F.posexplode(blocks).alias("block", "members"))
    flat = per_block.select("chunk", *by, "block", F.posexplode("members").alias("place", "r"))
    return flat.select("chunk", *by, "block", "place", F.col("r.key").alias(key),
                       *[F.col(f"r.{f}").alias(f) for f in fields])


def _sum_state() -> Column:
    return F.struct(F.lit(0).cast("long").alias("used"))


def next_fit(df: DataFrame, key: str, length: str, capacity: int, ordinal: str = "ordinal",
             chunk_rows: int = folds.CHUNK_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Rows go to the open block until the next does not fit; small ``carry`` columns go along."""
    return folds.blocks(df, ordinal, F.col(length), F.col(length), capacity, [key, length, *carry], chunk_rows)


def next_fit_in_buffers(df: DataFrame, key: str, length: str, capacity: int, buffer: int, ordinal: str = "ordinal") -> DataFrame:
    """As ``next_fit``, but each ``buffer`` of rows (chunk) starts anew."""
    grouped = chunked(df, key, [length], buffer, ordinal)
    cut = greedy_blocks(F.col("rows"), _sum_state(),
                        lambda s, r: F.struct((s["used"] + r[length]).cast("long").alias("used")),
                        lambda s, r: s["used"] + r[length] <= capacity)
    return flat_blocks(grouped, cut, key, [length])


def longest_first(packed: DataFrame, length: str, key: str) -> DataFrame:
    """Places inside a bin in order of falling length."""
    order = Window.partitionBy("block").orderBy(F.col(length).desc(), F.col("place"))
    return packed.withColumn("place", F.row_number().over(order) - 1)


def multipack(df: DataFrame, key: str, length: str, capacity: int, ordinal: str = "ordinal",
              chunk_rows: int = folds.CHUNK_ROWS) -> DataFrame:
    """Bins as the one-bin-per-step allocator makes them: the longest prefix that fits, longest first inside."""
    return longest_first(next_fit(df, key, length, capacity, ordinal, chunk_rows), length, key)


def concat_pad_lengths(length: Column | str, max_tokens: int) -> Column:
    """Length of a text in concatenate-and-pad blocks: cut to two below the block, then EOS and PAD."""
    return F.least(col_of(length), F.lit(max_tokens - 2)) + 2


def with_members(members: DataFrame, data: DataFrame, key: str) -> DataFrame:
    """Token arrays joined to their places by the unique key.

    Spark's size estimate knows nothing of array lengths, so the arrays must never be
    taken for a small side; a sort-merge join can spill on both sides.
    """
    return members.hint("merge").join(data, key)


def concat_pad_blocks(packed: DataFrame, data: DataFrame, key: str, max_tokens: int, ids: str = "ids") -> DataFrame:
    """Blocks of texts closed by EOS and PAD, filled up to ``max_tokens``.

    Only ids are shuffled; labels and mask follow from them inside the block.
    """
    joined = with_members(packed.select("chunk", "block", "place", key),
                          data.select(key, F.slice(ids, 1, max_tokens - 2).alias("ids")), key)
    blocks = joined.groupBy("chunk", "block").agg(F.sort_array(F.collect_list(F.struct("place", "ids"))).alias("m"))

    def cat(close: Callable[[Column], Column], pad: int) -> Column:
        return filled_up(F.flatten(F.transform("m", lambda x: close(x["ids"]))), max_tokens, pad)

    return blocks.select(
        "chunk", "block",
        cat(lambda i: F.concat(i, F.array(F.lit(EOS), F.lit(PAD))), PAD).alias("input_ids"),
        cat(lambda i: F.concat(i, F.array(F.lit(EOS), F.lit(IGNORED))), IGNORED).alias("labels"),
        cat(lambda i: F.concat(F.array_repeat(F.lit(1), F.size(i) + 1), F.array(F.lit(0))), 0).alias("attention_mask"))


def constant_length(df: DataFrame, key: str, length: str, needs_separator: str, capacity: int,
                    ordinal: str = "ordinal", chunk_rows: int = folds.CHUNK_ROWS) -> DataFrame:
    """Stream packing: a separator where the text lacks one; over-long texts close the block and are dropped.

    ``segment`` counts rows since the block opened, a dropped opener included.
    """
    size = F.col(length) + F.col(needs_separator).cast("int")
    packed = folds.blocks(df, ordinal, size, F.when(F.col(length) <= capacity, size).otherwise(0), capacity,
                          [key, length, needs_separator], chunk_rows)
    return packed.filter(F.col(length) <= capacity).withColumn("segment", F.col("place") + 1)


def character_buffers(df: DataFrame, key: str, characters: str, budget: str, ordinal: str = "ordinal",
                      chunk_rows: int = folds.CHUNK_ROWS, carry: tuple[str, ...] = ()) -> DataFrame:
    """Buffers that close once they hold ``budget`` characters (a column with one value)."""
    # whole characters are below the budget up to the number before its ceiling
    return folds.blocks(df, ordinal, F.lit(0), F.col(characters), F.ceil(budget) - 1, [key, characters, *carry], chunk_rows)


def budget_batches(df: DataFrame, key: str, input_length: str, max_new_tokens: str, prefill_budget: int,
                   token_budget: int, queue: tuple[str, ...] = (), min_size: int = 1, padded: bool = True,
                   block_size: int = 1, window: int | None = None, speculate: int = 0, ordinal: str = "ordinal",
                   chunk_rows: int = 10_000) -> DataFrame:
    """Requests in arrival order until prefill, or prefill and decode, exceed their budget.

    Arrivals are taken in intakes of ``chunk_rows``; batches are made per queue inside an
    intake.  ``held`` marks a batch below ``min_size``, ``over_budget`` a request too large
    for any batch.
    """
    grouped = chunked(df, key, [input_length, max_new_tokens], chunk_rows, ordinal, queue)

    def rounded(x: Column) -> Column:
        return F.ceil(x / block_size) * block_size

    fresh = F.struct(*[F.lit(0).cast("long").alias(n) for n in ("count", "longest", "prefill", "decode")])

    def grow(s: Column, r: Column) -> Column:
        count, longest = s["count"] + 1, F.greatest(s["longest"], r[input_length].cast("long"))
        if padded:
            prefill, decode = count * longest, s["decode"] + r[max_new_tokens]
        else:
            new = r[max_new_tokens].cast("long")
            if window is not None:
                new = F.least(F.greatest(F.lit(window) - r[input_length], F.lit(0)).cast("long"), new)
            prefill, decode = s["prefill"] + rounded(r[input_length]), s["decode"] + rounded(new)
        return F.struct(*[c.cast("long").alias(n) for n, c in
                          (("count", count), ("longest", longest), ("prefill", prefill), ("decode", decode))])

    def within(s: Column) -> Column:
        return (s["prefill"] <= prefill_budget) & (s["prefill"] + s["decode"] + speculate <= token_budget)

    blocks = greedy_blocks(F.col("rows"), fresh, grow, lambda s, r: let(grow(s, r), within))
    per_block = grouped.select("chunk", *queue, F.posexplode(blocks).alias("batch", "members"))
    total = F.aggregate("members", fresh, grow)
    sized = per_block.withColumns({"size": F.size("members"), "_t": total}).withColumns({
        "max_tokens": F.col("_t.prefill") + F.col("_t.decode"), "over_budget": (~within(F.col("_t"))).cast("int"),
        "held": (F.size("members") < min_size).cast("int")})
    flat = sized.select("chunk", *queue, "batch", "size", "max_tokens", "over_budget", "held",
                        F.explode("members").alias("r"))
    return flat.select("chunk", *queue, "batch", "size", "max_tokens", "over_budget", "held", F.col("r.key").alias(key))


# First-fit decreasing over n bins -------------------------------------------------------


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> np.ndarray:
    """Bin number of each length: longest first, each into the first bin with room.

    A tree over the bins holds the most room below each node, so a bin is found in as many steps as the tree is deep.
    """
    order = np.argsort(-lengths, kind="stable").tolist()
    leaves = 1 << max(0, len(order) - 1).bit_length()
    most = [capacity] * (2 * leaves)
    sizes, bins = lengths.tolist(), np.empty(len(order), dtype=np.int64)
    for i in order:
        at = 1
        if sizes[i] <= most[1]:
            while at < leaves:
                at = 2 * at if most[2 * at] >= sizes[i] else 2 * at + 1
        else:  # longer than a bin: the first that is still empty
            at = leaves + next(k for k in range(leaves) if most[leaves + k] == capacity)
        bins[i] = at - leaves
        most[at] -= sizes[i]
        while at > 1:
            at //= 2
            most[at] = max(most[2 * at], most[2 * at + 1])
    return bins


def fits_in(lengths: np.ndarray, capacity: int, bins: int) -> bool:
    """Whether first-fit decreasing needs at most ``bins`` bins and no length exceeds one."""
    if len(lengths) == 0:
        return True
    return bool(lengths.max() <= capacity and first_fit_decreasing(lengths, capacity).max() < bins)


def ffd_segments(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int]]:
    """First-fit decreasing over whole length classes: (length, rank, bin, per bin), where a class's items from ``rank`` on fill bins from ``bin`` on.

    Bins next to each other with equal room are one run, so a class is placed run by run, however many items it has.
    An item leaves less than half of the room it is put into, or less than its own length, so a run is touched about as often as the capacity has bits.
    """
    out: list[tuple[int, int, int, int]] = []
    runs: list[tuple[int, int, int]] = []  # first bin, bins, room
    bins = 0
    for length in sorted(counts, reverse=True):
        left, rank, after = counts[length], 0, []

        def put(first: int, many: int, room: int, each: int) -> None:
            """As many as fit into ``many`` bins, ``each`` into one."""
            nonlocal left, rank
            full = min(many, left // each)
            rest = left - full * each if full < many else 0
            for start, n, held in ((first, full, each), (first + full, 1 if rest else 0, rest), (first + full + bool(rest), many - full - bool(rest), 0)):
                if n:
                    if held:
                        out.append((length, rank, start, held))
                        rank, left = rank + n * held, left - n * held
                    if after and after[-1][2] == room - held * length and after[-1][0] + after[-1][1] == start:
                        after[-1] = (after[-1][0], after[-1][1] + n, after[-1][2])
                    else:
                        after.append((start, n, room - held * length))

        for first, many, room in runs:
            if left and length <= room:
                put(first, many, room, room // length if length else left)
            else:
                after.append((first, many, room))
        if left:
            each = max(1, capacity // length) if length else left
            many = -(-left // each)
            put(bins, many, capacity, each)
            bins += many
        runs = after
    return out


def ffd_pack(df: DataFrame, key: str, length: str, capacity: int, ordinal: str = "ordinal") -> DataFrame:
    """bin, key, length: first-fit-decreasing bins of the whole table; equal lengths in the order of the dense ``ordinal``.

    Lengths are counted, so what the driver places is a row per different length (at most the capacity, where no length exceeds it); each
    row then finds its bin from its rank among equal lengths.  An item longer than a bin gets one of its own.
    """
    small = df.select(F.col(ordinal).cast("long").alias("ordinal"), F.col(key).cast("long").alias(key), F.col(length).cast("long").alias(length))
    small = materialise(small, "lengths")
    counts = {r[0]: r[1] for r in small.groupBy(length).count().collect()}
    segments = sorted(ffd_segments(counts, capacity))
    sizes, starts, firsts, each = (np.array(c, np.int64) for c in zip(*segments)) if segments else (np.empty(0, np.int64),) * 4
    begins = np.append(np.flatnonzero(np.diff(sizes, prepend=-1)), len(sizes))
    known = sizes[begins[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own, rank = b.column(1).to_numpy(), b.column(2).to_numpy()
            base = rank.max(initial=0) + starts.max(initial=0) + 1
            of = np.searchsorted(known, own)
            at = np.searchsorted(np.searchsorted(known, sizes) * base + starts, of * base + rank, "right") - 1
            bins = firsts[at] + (rank - starts[at]) // each[at]
            yield pa.RecordBatch.from_arrays([pa.array(bins), b.column(0), b.column(1)], names=["bin", key, length])

    return ranked(small, length, "ordinal").select(key, length, F.col("rank").cast("long")).mapInArrow(run, f"bin long, {key} long, {length} long")


# Packed rows, padding, unpacking --------------------------------------------------------


def packed_rows(members: DataFrame, data: DataFrame, key: str, numbered: bool = False,
                by: tuple[str, ...] = ("block",), place: str = "place") -> DataFrame:
    """Concatenated ids, labels and positions per bin; the mask is ones, or the member's number.

    A bin's group is bounded by its token capacity.  Positions are carried only where
    ``data`` brings its own; otherwise each member counts from 0.
    """
    own = "position_ids" in data.columns
    fields = ["input_ids", "labels", *(["position_ids"] if own else [])]
    joined = with_members(members.select(*by, F.col(place).alias("place"), key), data.select(key, *fields), key)
    bins = joined.groupBy(*by).agg(F.sort_array(F.collect_list(F.struct("place", *fields))).alias("m"))

    def cat(name: str) -> Column:
        return F.flatten(F.transform("m", lambda x: x[name])).alias(name)

    positions = cat("position_ids") if own else F.flatten(
        F.transform("m", lambda x: indices(x["input_ids"]))).alias("position_ids")
    mask = F.flatten(F.transform("m", lambda x, i: F.array_repeat(
        (i + 1) if numbered else F.lit(1), F.size(x["input_ids"]))))
    return bins.select(*by, cat("input_ids"), cat("labels"), positions, mask.alias("attention_mask"),
                       F.size("m").alias("members"))


def filled_up(a: Column | str, length: Column | int, pad: int, left: bool = False) -> Column:
    x = col_of(a)
    rest = F.array_repeat(F.lit(pad), F.greatest((F.lit(length) if isinstance(length, int) else length) - F.size(x),
                                                 F.lit(0)))
    return F.concat(rest, x) if left else F.concat(x, rest)


# What each field is padded with.
PADDING = {"input_ids": PAD, "labels": IGNORED, "attention_mask": 0, "position_ids": 0}


def pad_batches(df: DataFrame, key: str, size: int, columns: dict[str, int] | None = None, multiple: int | None = None,
                left: tuple[str, ...] = (), common: list[list[str]] | None = None) -> DataFrame:
    """Batches of ``size`` rows in the order of an integer ``key``; every field padded to the longest of its batch.

    Lengths are rounded up to ``multiple``; fields in ``left`` are filled up in front.  Fields in one list of ``common``
    share their length, as both sides of a pair do.  Only keys and lengths are numbered and compared; the arrays
    are read again and joined once.
    """
    pads = columns or {c: p for c, p in PADDING.items() if c in df.columns}
    groups = common or [[c] for c in pads]
    lengths = [(F.greatest(*[F.size(c) for c in group]) if len(group) > 1 else F.size(group[0])).alias(f"_n{n}")
               for n, group in enumerate(groups)]
    small = batches(materialise(df.select(key, *lengths), "lengths"), key, size)
    inside = Window.partitionBy("batch")
    for n in range(len(groups)):
        top = F.max(f"_n{n}").over(inside)
        small = small.withColumn(f"_n{n}", (F.ceil(top / multiple) * multiple).cast("int") if multiple else top)
    sized = with_members(small.drop("ordinal"), df, key)
    return sized.withColumns({c: filled_up(c, F.col(f"_n{n}"), pads[c], c in left)
                              for n, group in enumerate(groups) for c in group}).drop(
        *[f"_n{n}" for n in range(len(groups))])


def unpacked(df: DataFrame, columns: list[str], positions: str = "position_ids") -> DataFrame:
    """One row per range of a packed row: a range opens where the position is 0; single tokens are left out."""
    n = F.size(positions)
    opens = F.filter(F.sequence(F.lit(1), n), lambda i: (i == 1) | (F.col(positions)[i - 1] == 0))
    ends = F.concat(F.slice(opens, 2, F.greatest(F.size(opens), F.lit(1))), F.array(n + 1))
    ranges = F.filter(F.transform(F.arrays_zip(opens.alias("a"), ends.alias("b")),
                                  lambda r: F.struct(r["a"].alias("a"), (r["b"] - r["a"]).alias("n"))),
                      lambda r: r["n"] > 1)
    rest = [c for c in df.columns if c not in columns]
    flat = df.filter(n > 0).select(*rest, *columns, F.posexplode(ranges).alias("range", "_r"))
    return flat.select(*[c for c in rest], "range", *[F.slice(c, F.col("_r.a"), F.col("_r.n")).alias(c) for c in columns])
