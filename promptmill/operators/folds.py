"""Running budgets over a whole ordered table: exact for any size, with no task that sees more than a chunk.

A row stays in the open block while ``used + cost <= limit`` and then adds ``gain``; otherwise it opens the next block with
``used = gain``.  Inside a chunk each row has a successor, the row that opens the next block if it opens one: a binary search
over running sums finds all successors at once, and following them in steps of 1, 2, 4, ... gives the blocks.  What a chunk does
depends on its entry state only through the first row that opens a block, so a
chunk is a short table: for each such row, how the chunk is left.  These tables are composed, 1,024 chunks at a time, then
chained; with the true entry state known, each chunk is cut once.  The chunk size is a tuning value; results do not depend on it.
Costs and gains are not negative, and their sum over a chunk times its rows stays below 2^62.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.operators.order import chunk_of
from promptmill.session import materialise

CHUNK_ROWS, CHUNKS_TOGETHER = 10_000, 1024

# state: used, rows in the open block, block number; before the first row no block is open
State = tuple[int, int, int]
START: State = (1 << 62, 0, -1)
# a chunk: its rows, the sum of gains, and by falling threshold (used above it opens that row): used, rows, new blocks on leaving
Left = tuple[int, int, list[int], list[State]]


class Chunk:
    """The rows of a chunk with their successors; its length stands for none."""

    def __init__(self, cost: np.ndarray, gain: np.ndarray, limit: int):
        n = len(cost)
        self.n, self.limit, self.sums = n, limit, np.concatenate([[0], np.cumsum(gain)])
        before, place = self.sums[:-1], np.arange(1, n + 1)
        # a row whose cost exceeds the limit opens a block whatever came before: its place decides among equal sums
        self.scale = n + 2
        needs = np.where(cost > limit, (limit + before) * self.scale + place, (np.minimum(cost, limit) + before) * self.scale)
        self.most = np.maximum.accumulate(needs)
        self.next = np.searchsorted(self.most, (limit + before) * self.scale + place, "right")
        self.threshold = limit - before - cost

    def first(self, used: int) -> int:
        """The row that opens a block when the chunk is entered with ``used``."""
        if used > self.limit:
            return 0
        return int(np.searchsorted(self.most, (self.limit - used) * self.scale, "right"))

    def jumps(self) -> list[np.ndarray]:
        """Successors after 1, 2, 4, ... steps."""
        out = [np.append(self.next, self.n)]
        while (out[-1] < self.n).any():
            out.append(out[-1][out[-1]])
        return out

    def exits(self, first: np.ndarray) -> list[State]:
        """How the chunk is left if each of ``first`` opens a block."""
        blocks, last = np.ones(len(first), np.int64), first.copy()
        for k, jump in reversed(list(enumerate(self.jumps()))):
            goes = jump[last] < self.n
            last = np.where(goes, jump[last], last)
            blocks += goes.astype(np.int64) << k
        used = self.sums[-1] - self.sums[last]
        return list(zip(used.tolist(), (self.n - last).tolist(), blocks.tolist()))

    def places(self, state: State) -> tuple[np.ndarray, np.ndarray]:
        """The block of each row and its place in it, entered in ``state``."""
        used, inside, block = state
        opened, first = np.zeros(self.n + 1, bool), self.first(used)
        starts = np.array([first])
        for jump in self.jumps():
            starts = np.concatenate([starts, jump[starts]])
        opened[starts] = True
        opened, at = opened[:-1], np.arange(self.n)
        begin = np.maximum.accumulate(np.where(opened, at, -inside))
        return block + np.cumsum(opened), at - begin


def summary(cost: np.ndarray, gain: np.ndarray, limit: int) -> Left:
    chunk = Chunk(cost, gain, limit)
    falls = np.flatnonzero(chunk.threshold < np.minimum.accumulate(np.r_[np.int64(1) << 61, chunk.threshold[:-1]]))
    below = np.flatnonzero(chunk.threshold[falls] < 0)
    falls = falls[:below[0] + 1] if below.size else falls
    return len(cost), int(gain.sum()), chunk.threshold[falls].tolist(), chunk.exits(falls)


def leave(chunk: Left, state: State) -> State:
    rows, total, thresholds, left = chunk
    used, inside, block = state
    at = bisect_right(thresholds, -used, key=lambda t: -t)  # the first threshold below used
    if at == len(left):
        return used + total, inside + rows, block
    return left[at][0], left[at][1], block + left[at][2]


def compose(chunks: list[Left]) -> Left:
    """Several chunks in a row as one."""
    rows = total = 0
    thresholds, left = [], []
    for k, (n, gain, own, exits) in enumerate(chunks):
        for t, state in zip(own, exits):
            if (thresholds[-1] if thresholds else 1 << 61) >= 0 and (not thresholds or t - total < thresholds[-1]):
                for later in chunks[k + 1:]:
                    state = leave(later, state)
                thresholds.append(t - total)
                left.append(state)
        rows, total = rows + n, total + gain
    return rows, total, thresholds, left


_LEFT = "rows long, total long, thresholds array<long>, used array<long>, inside array<long>, blocks array<long>"
_STATE = "used long, inside long, block long"


def _row(chunk: Left) -> dict:
    rows, total, thresholds, left = chunk
    return {"rows": rows, "total": total, "thresholds": thresholds, **{n: [s[i] for s in left] for i, n in enumerate(("used", "inside", "blocks"))}}


def _chunk(row: dict) -> Left:
    return row["rows"], row["total"], row["thresholds"], list(zip(row["used"], row["inside"], row["blocks"]))


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"long": pa.int64(), "array<long>": pa.list_(pa.int64())}
    return pa.Table.from_pylist(rows, pa.schema([(name, kinds[kind]) for name, kind in (f.split() for f in schema.split(", "))]))


def _entries(rows: list[dict], name: str, state: State) -> list[dict]:
    out = []
    for r in sorted(rows, key=lambda r: r[name]):
        out.append({name: r[name], **dict(zip(("used", "inside", "block"), state))})
        state = leave(_chunk(r), state)
    return out


def blocks(df: DataFrame, ordinal: str, cost: Column, gain: Column, limit: Column | int, fields: list[str],
           chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """fields, block, place: the block of each row, numbered over the whole table, and the row's place in it.

    ``ordinal`` numbers the rows from 0; ``limit`` is one value for the table.
    """
    limit = F.lit(limit) if isinstance(limit, int) else limit
    numbers = {"_o": F.col(ordinal), "_cost": cost, "_gain": gain, "_limit": limit}
    rows = materialise(df.select(*fields, *[c.cast("long").alias(n) for n, c in numbers.items()], chunk_of(ordinal, chunk_rows).alias("_chunk")), "fold")

    def ordered(table: pa.Table) -> tuple[pa.Table, np.ndarray, np.ndarray, int]:
        table = table.sort_by("_o")
        cost, gain, limit = (table.column(n).to_numpy() for n in ("_cost", "_gain", "_limit"))
        return table, cost, gain, int(limit[0])

    chunk_schema = f"_group long, _chunk long, {_LEFT}"

    def shorten(table: pa.Table) -> pa.Table:
        table, cost, gain, limit = ordered(table)
        chunk = table.column("_chunk")[0].as_py()
        return _table([{"_group": chunk // CHUNKS_TOGETHER, "_chunk": chunk, **_row(summary(cost, gain, limit))}], chunk_schema)

    small = rows.select("_o", "_cost", "_gain", "_limit", "_chunk").groupBy("_chunk").applyInArrow(shorten, chunk_schema)
    small = materialise(small, "fold-chunks")

    def together(table: pa.Table) -> pa.Table:
        own = sorted(table.to_pylist(), key=lambda r: r["_chunk"])
        return _table([{"_group": own[0]["_group"], **_row(compose([_chunk(r) for r in own]))}], f"_group long, {_LEFT}")

    def chain(table: pa.Table) -> pa.Table:
        return _table(_entries(table.to_pylist(), "_group", START), f"_group long, {_STATE}")

    # a row for about ten million rows of the table
    groups = small.groupBy("_group").applyInArrow(together, f"_group long, {_LEFT}")
    groups = groups.groupBy(F.lit(0).alias("_all")).applyInArrow(chain, f"_group long, {_STATE}")

    def enter(table: pa.Table) -> pa.Table:
        own = table.to_pylist()
        return _table(_entries(own, "_chunk", tuple(own[0][f"_{n}"] for n in ("used", "inside", "block"))), f"_chunk long, {_STATE}")

    entry = groups.select("_group", *[F.col(n).alias(f"_{n}") for n in ("used", "inside", "block")])
    states = small.join(entry, "_group").groupBy("_group").applyInArrow(enter, f"_chunk long, {_STATE}")
    entered = rows.join(states.select("_chunk", *[F.col(n).alias(f"_{n}") for n in ("used", "inside", "block")]), "_chunk")

    def place(table: pa.Table) -> pa.Table:
        table, cost, gain, limit = ordered(table)
        used, inside, block = (table.column(f"_{n}")[0].as_py() for n in ("used", "inside", "block"))
        of, at = Chunk(cost, gain, limit).places((used, inside, block))
        return table.select(fields).append_column("block", pa.array(of, pa.int64())).append_column("place", pa.array(at, pa.int64()))

    schema = ", ".join([f"`{n}` {df.schema[n].dataType.simpleString()}" for n in fields] + ["block long", "place long"])
    return entered.groupBy("_chunk").applyInArrow(place, schema)
