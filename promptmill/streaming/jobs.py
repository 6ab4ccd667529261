"""Streaming forms: packed pretraining text, the loss watchdog, stop rules, request metrics, budget batches."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import once
from promptmill.operators import labels, pack
from promptmill.operators.filters import length_fits
from promptmill.operators.order import ordinal, shuffled_ordinal
from promptmill.session import materialise


def run_available(writer, checkpoint: str) -> StreamingQuery:
    """Runs a stream over what is there now, then ends."""
    query = writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def write_batch(df: DataFrame, out: str, batch_id: int) -> None:
    """A micro-batch's folder is replaced as a whole, so a replayed batch leaves the same rows."""
    df.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")


def pretrain_blocks(docs: DataFrame, key: str, text: str, max_tokens: int, buffer: int, truncate: bool = False) -> DataFrame:
    """Concatenate-and-pad blocks of one table or micro-batch, packed anew for each ``buffer`` of texts.

    A text longer than a block goes on in further windows; with ``truncate`` only its first window is kept.
    """
    width = max_tokens - 2
    last = F.floor((F.greatest(F.col("tokens"), F.lit(1)) - 1) / width).cast("int")
    windows = F.explode(F.sequence(F.lit(0), F.lit(0) if truncate else last)).alias("window")
    # the text is read once for its counts, which are numbered and packed, and once for its ids
    sized = materialise(docs.select(key, tk.token_count(text).alias("tokens")), "lengths")
    each = ordinal(sized, key).select("ordinal", key, "tokens", windows).select(
        "ordinal", F.struct(key, "window").alias("item"), (F.least(F.col("tokens") - F.col("window") * width, F.lit(width)) + 2).alias("n"))
    packed = pack.next_fit_in_buffers(each, "item", "n", max_tokens, buffer)
    ids = once(docs.select(key, text), ids=tk.token_ids(text, width if truncate else None)).withColumn("tokens", F.size("ids"))
    data = ids.select(key, "ids", windows).select(F.struct(key, "window").alias("item"), F.slice("ids", F.col("window") * width + 1, width).alias("ids"))
    return pack.concat_pad_blocks(packed, data, "item", max_tokens)


def stream_pretrain(stream: DataFrame, out: str, checkpoint: str, key: str = "doc_id", text: str = "text",
                    max_tokens: int = 2048, buffer: int = 10_000) -> StreamingQuery:
    """Text to packed blocks, buffers flushed per micro-batch."""

    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(pretrain_blocks(batch, key, text, max_tokens, buffer), out, batch_id)

    return run_available(stream.writeStream.foreachBatch(each), checkpoint)


def packed_pretrain(docs: DataFrame, key: str, text: str, max_tokens: int, batch_size: int, stride: int,
                    seed: int | str = 42, window_tokens: int | None = None, numbered: bool = True) -> DataFrame:
    """Windows of text, over-long ones dropped, packed to ``batch_size`` x ``max_tokens`` and built."""
    width = window_tokens or max_tokens
    flat = labels.explode_windows(once(docs.select(key, text), input_ids=tk.token_ids(text)).drop(text),
                                  labels.strided_windows("input_ids", width, stride))
    flat = flat.withColumn("row_id", F.concat_ws("-", key, "window")).filter(length_fits(F.size("input_ids"), max_tokens))
    data = flat.select("row_id", "input_ids", F.col("input_ids").alias("labels"))
    sized = shuffled_ordinal(flat.select("row_id", F.size("input_ids").alias("n")), seed, "row_id")
    bins = pack.multipack(sized, "row_id", "n", max_tokens * batch_size)
    return pack.packed_rows(bins, data, "row_id", numbered)


def stream_packed_pretrain(stream: DataFrame, out: str, checkpoint: str, key: str = "doc_id", text: str = "text",
                           max_tokens: int = 2048, batch_size: int = 4, stride: int = 256) -> StreamingQuery:
    def each(batch: DataFrame, batch_id: int) -> None:
        write_batch(packed_pretrain(batch, key, text, max_tokens, batch_size, stride), out, batch_id)

    return run_available(stream.writeStream.foreachBatch(each), checkpoint)


def _milliseconds(stamp) -> int:
    return int(pd.Timestamp(stamp).timestamp() * 1000)


class IdleState(StatefulProcessor):
    """State per key that an event-time timer clears once the key has been silent for ``idle_ms``."""

    idle_ms: int

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("state", self.state_schema)

    def seen(self, frame: pd.DataFrame) -> None:
        """Moves the timer behind the latest event."""
        for t in self.handle.listTimers():
            self.handle.deleteTimer(t)
        self.handle.registerTimer(_milliseconds(frame["ts"].max()) + self.idle_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.state.clear()
        return iter([])

    def close(self) -> None:
        pass


class Watchdog(IdleState):
    """Counts violations in a row per run; the state is two numbers."""

    state_schema = "violations int, stopped int"

    def __init__(self, threshold: float, patience: int, idle_ms: int):
        self.threshold, self.patience, self.idle_ms = threshold, patience, idle_ms

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, stopped = self.state.get() if self.state.exists() else (0, 0)
        frame = pd.concat(list(rows)).sort_values(["ts", "step"])
        place = np.arange(len(frame))
        fine = np.maximum.accumulate(np.where(frame["loss"].to_numpy() > self.threshold, -1, place))
        streak = np.where(fine < 0, count + place + 1, place - fine)
        hits = np.flatnonzero(streak >= self.patience)
        self.state.update((int(streak[-1]), int(stopped or hits.size > 0)))
        self.seen(frame)
        if hits.size and not stopped:
            yield pd.DataFrame({"run_id": [key[0]], "step": [int(frame["step"].iloc[hits[0]])], "violations": [self.patience]})


def stream_watchdog(events: DataFrame, threshold: float, patience: int = 3, late: str = "1 hour",
                    idle_ms: int = 86_400_000) -> DataFrame:
    """(run_id, ts, step, loss) to one row per run that must stop.

    A run's rows of one micro-batch are held together, so the source must bound a trigger (``maxFilesPerTrigger``); only the
    two counters live on, until the run has been silent for ``idle_ms``.
    """
    return events.withWatermark("ts", late).groupBy("run_id").transformWithStateInPandas(
        Watchdog(threshold, patience, idle_ms), "run_id long, step long, violations int", "Append", "EventTime")


class StopState(IdleState):
    """Follows a request's tokens until it finishes; the state is a count and a tail of text."""

    state_schema = "tokens int, tail string, done int"

    def __init__(self, stops: tuple[str, ...], max_new_tokens: int, eos_id: int, idle_ms: int):
        self.stops, self.limit, self.eos_id, self.idle_ms = stops, max_new_tokens, eos_id, idle_ms

    def first(self, count: int, tail: str, ids: np.ndarray, texts: list[str]) -> tuple[int, str | None]:
        """Place of the token that ends the request and why; the number of tokens and None if none does."""
        length = self.limit - count - 1
        ends_ids = np.flatnonzero(ids == self.eos_id)
        found = [(length, 0, "length")] if length < len(ids) else []
        found += [(int(ends_ids[0]), 1, "eos_token")] if ends_ids.size else []
        upto = min([f[0] for f in found], default=len(ids) - 1) + 1
        text = tail + "".join(texts[:upto])
        at = {int(e): i for i, e in reversed(list(enumerate(len(tail) + np.cumsum([len(t) for t in texts[:upto]]))))}
        for stop in self.stops:
            # a token also ends it if it puts one line feed behind the stop text
            ends = [m.end() for m in re.finditer(f"(?={re.escape(stop)})", text)]
            for e in (e + len(stop) for e in ends):
                found += [(at[x], 2, "stop_sequence") for x in (e, e + 1) if x in at and (x == e or text[e] == "\n")]
        return min(found)[::2] if found else (len(ids), None)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        count, tail, done = self.state.get() if self.state.exists() else (0, "", 0)
        frame = pd.concat(list(rows)).sort_values("pos")
        self.seen(frame)
        if done:
            return
        texts = frame["text"].tolist()
        place, reason = self.first(count, tail, frame["id"].to_numpy(), texts)
        if reason is None:
            keep = max(map(len, self.stops), default=0) + 1
            self.state.update((count + len(texts), (tail + "".join(texts))[-keep:], 0))
            return
        self.state.update((count + place + 1, "", 1))
        yield pd.DataFrame({"request_id": [key[0]], "finish_reason": [reason], "generated_tokens": [count + place + 1]})

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        count, _, done = self.state.get() if self.state.exists() else (0, "", 1)
        self.state.clear()
        if not done:
            yield pd.DataFrame({"request_id": [key[0]], "finish_reason": ["idle"], "generated_tokens": [count]})


def stream_stop_rule(tokens: DataFrame, stops: tuple[str, ...], max_new_tokens: int, eos_id: int = tk.EOS,
                     late: str = "1 hour", idle_ms: int = 86_400_000) -> DataFrame:
    """(request_id, ts, pos, id, text) to one row per finished request; a silent one finishes as idle."""
    return tokens.withWatermark("ts", late).groupBy("request_id").transformWithStateInPandas(
        StopState(stops, max_new_tokens, eos_id, idle_ms),
        "request_id long, finish_reason string, generated_tokens int", "Append", "EventTime")


def stream_request_metrics(requests: DataFrame, width: str = "1 day", late: str = "1 hour") -> DataFrame:
    """Latency percentiles, tokens and failures per time bucket; rows behind the watermark are dropped.

    percentile_approx keeps a bounded sketch per bucket and combines before the shuffle.
    """
    ok = F.col("status") == 200
    return requests.withWatermark("ts", late).groupBy(F.window("ts", width)).agg(
        F.count(F.lit(1)).alias("requests"), F.count(F.when(~ok, 1)).alias("failed"),
        F.sum(F.when(ok, F.col("new_tokens"))).alias("new_tokens"),
        F.percentile_approx(F.when(ok, F.col("duration_ms")), [0.5, 0.9, 0.99]).alias("latency")).select(
        F.unix_timestamp("window.start").alias("bucket"), "requests", "failed", "new_tokens",
        *[F.col("latency")[i].alias(n) for i, n in enumerate(("p50", "p90", "p99"))])


def stream_budget_batches(requests: DataFrame, out: str, waiting: str, checkpoint: str, prefill_budget: int,
                          token_budget: int, min_size: int = 1, intake: int = 10_000) -> StreamingQuery:
    """Budget batches per queue as requests arrive; batches below ``min_size`` wait for the next micro-batch.

    The waiting table is versioned by batch id: batch k reads version k-1 and writes
    version k, so a replay starts from the same rows.
    """

    def each(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # only the first batch has no version before it; any other that can't be read is an error
        held = spark.read.schema(batch.schema).parquet(f"{waiting}/version={batch_id - 1}") if batch_id else batch.limit(0)
        rows = held.unionByName(batch)
        numbered = ordinal(rows, "request_id")
        made = pack.budget_batches(numbered, "request_id", "input_length", "max_new_tokens", prefill_budget,
                                   token_budget, ("queue",), min_size, chunk_rows=intake)
        write_batch(made.filter("held = 0"), out, batch_id)
        held = rows.join(made.filter("held = 1").select("request_id"), "request_id", "left_semi")
        held.select(*batch.columns).write.mode("overwrite").parquet(f"{waiting}/version={batch_id}")

    return run_available(requests.writeStream.foreachBatch(each), checkpoint)
