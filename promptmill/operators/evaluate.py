"""Joins of outputs with references, metrics, timing tables and run checks."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.text import col_of, cut_at, first_present, normalise_output
from promptmill.functions.tokens import IGNORED, token_count, token_texts
from promptmill.operators.dedup import union_all
from promptmill.operators.labels import split_labelled
from promptmill.operators.pack import unpacked
from promptmill.session import by_rows, materialise

# Joins ----------------------------------------------------------------------------------


def outputs_with_cases(outputs: DataFrame, cases: DataFrame) -> DataFrame:
    """Each program's output beside the expected output of its case; a case without output keeps null."""
    programs = outputs.select("program_id", "problem_id").distinct()
    wanted = programs.join(cases, "problem_id")
    return wanted.join(outputs, ["program_id", "problem_id", "case_no"], "left")


# Answer columns in order of preference and the mark that ends an answer.
ANSWER_COLUMNS = ["generation_truncated", "generation", "text"]
ANSWER_MARKER = "A chat between a curious human and an artificial intelligence"


def answer_column(df: DataFrame) -> Column:
    name = first_present(df, ANSWER_COLUMNS)
    return F.col(name) if name == "text" else cut_at(name, ANSWER_MARKER)


def judged_questions(questions: DataFrame, a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Question with both answers by id."""
    one = a.select(key, answer_column(a).alias("answer_1"))
    two = b.select(key, answer_column(b).alias("answer_2"))
    return questions.join(one, key).join(two, key)


def unanswered(questions: DataFrame, answers: list[DataFrame], key: str) -> DataFrame:
    """Ids that some answer set lacks; must be empty before judging."""
    parts = [questions.join(a, key, "left_anti").select(key) for a in answers]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def with_default(df: DataFrame, dim: DataFrame, on: str, dim_key: str, order: str, fields: list[str]) -> DataFrame:
    """Lookup of ``fields`` by ``on``; a key without a match takes the first dimension row.

    No broadcast hint: Spark broadcasts the dimension while it is below its threshold.
    """
    first = dim.agg(F.min_by(F.struct(*fields), order).alias("d")).scalar()
    found = dim.withColumn("_hit", F.struct(*fields)).select(F.col(dim_key).alias("_k"), "_hit")
    joined = df.join(found, df[on] == found["_k"], "left")
    pick = F.coalesce("_hit", first)
    return joined.withColumns({f: pick[f] for f in fields}).drop("_k", "_hit")


def with_ids_of(df: DataFrame, questions: DataFrame, key: str) -> DataFrame:
    return df.join(questions.select(key), key, "left_semi")


def close(a: Column, b: Column, rtol: float) -> Column:
    """Equal within a relative tolerance; null equals only null."""
    near = F.abs(a - b) <= F.lit(rtol) * F.greatest(F.abs(a), F.abs(b))
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(near)


def snapshot_compare(tokens: DataFrame, snapshot: DataFrame, response: str = "response_id", rtol: float = 0.2) -> DataFrame:
    """Per response: whether every token agrees in id, text, special flag and, within tolerance, log-probability."""
    left, right = tokens.alias("l"), snapshot.alias("r")
    both = left.join(right, [response, "pos"], "full_outer")
    same = (F.col("l.id").eqNullSafe(F.col("r.id")) & F.col("l.text").eqNullSafe(F.col("r.text"))
            & F.col("l.special").eqNullSafe(F.col("r.special")) & F.col("l.id").isNotNull() & F.col("r.id").isNotNull()
            & close(F.col("l.logprob"), F.col("r.logprob"), rtol))
    return both.groupBy(response).agg(
        F.min(same.cast("int")).alias("matches"), F.count(F.col("l.id")).alias("tokens"),
        F.count(F.col("r.id")).alias("expected"), F.count(F.when(~same, 1)).alias("differences"))


def details_compare(now: DataFrame, before: DataFrame, response: str = "response_id") -> DataFrame:
    """Per response: generated text, finish reason, token count and seed are the same."""
    both = now.alias("l").join(before.alias("r"), response, "full_outer")
    same = F.lit(True)
    for c in ("generated_text", "finish_reason", "generated_tokens", "seed"):
        same = same & F.col(f"l.{c}").eqNullSafe(F.col(f"r.{c}"))
    return both.select(response, same.cast("int").alias("matches"))


# Token counts ---------------------------------------------------------------------------


def length_column(df: DataFrame) -> Column:
    """A row's length from its length column, its last position, or its ids."""
    if "length" in df.columns:
        return F.col("length")
    if "position_ids" in df.columns:
        return F.element_at("position_ids", -1) + 1
    return F.size("input_ids")


def supervised(labels: Column | str) -> Column:
    return F.size(F.filter(col_of(labels), lambda x: x != IGNORED))


def token_totals(df: DataFrame, by: str | None = None) -> DataFrame:
    return (df.groupBy(by) if by else df.groupBy()).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.size("input_ids")).alias("tokens"),
        F.sum(supervised("labels")).alias("supervised_tokens"))


def characters_per_token(df: DataFrame, text: str, key: str | None = None, rows: int | None = None) -> DataFrame:
    """Over all rows, or the first ``rows`` in the order of ``key``."""
    some = df.select(text) if rows is None else df.select(key, text).orderBy(key).limit(rows)
    return some.agg((F.sum(F.length(text)) / F.sum(token_count(text))).alias("chars_per_token"))


def steps_packed(tokens: Column, efficiency: float, sequence_len: int, batch_size: int, epochs: float) -> Column:
    whole = F.floor(F.floor(F.lit(0.99) * tokens / efficiency / sequence_len / batch_size))
    return (whole - 1) * F.lit(epochs)


def steps_binned(bins: Column, micro_batch: int, batch_size: int, epochs: float) -> Column:
    return F.floor(F.floor(bins * micro_batch / batch_size) * F.lit(epochs))


def steps_plain(rows: Column, batch_size: int, epochs: float) -> Column:
    return F.ceil(rows * F.lit(epochs) / batch_size)


def packing_efficiency(packed: DataFrame, length: str, capacity: int) -> DataFrame:
    """Bins, used tokens and efficiency, rounded up to 0.01; bins are counted from per-bin sums."""
    bins = packed.groupBy("block").agg(F.sum(length).alias("used"))
    total = bins.agg(F.count(F.lit(1)).alias("bins"), F.sum("used").alias("used"))
    share = F.col("used") / (F.col("bins") * capacity)
    return total.select("bins", "used", share.alias("efficiency"), (F.ceil(share * 100) / 100).alias("estimate"))


def length_estimate(tokens: Column, efficiency: float, capacity: int, batch_size: int = 1, world: int = 1) -> Column:
    share = F.floor(tokens / world)
    return F.greatest(F.lit(0), world * F.floor(F.lit(0.99) * share / efficiency / (capacity * batch_size)) - 1)


# Scores ---------------------------------------------------------------------------------


def choice_index(scores: Column | str) -> Column:
    """Index of the largest score; the first of equals."""
    return F.array_position(col_of(scores), F.array_max(col_of(scores))) - 1


def benchmark_accuracy(df: DataFrame, names: DataFrame, loss: str = "loss") -> DataFrame:
    """Accuracy per name, macro mean, micro total and mean loss; a name without rows counts 0."""
    per = df.groupBy("name").agg(F.count(F.lit(1)).alias("n"),
                                 F.sum((F.col("prediction") == F.col("reference")).cast("int")).alias("right"),
                                 F.sum(loss).alias("loss"))
    per = names.join(per, "name", "left").withColumn(
        "accuracy", F.coalesce(F.col("right") / F.col("n"), F.lit(0.0)))
    total = per.agg(F.avg("accuracy").alias("macro"), (F.sum("right") / F.sum("n")).alias("micro"),
                    (F.sum("loss") / F.sum("n")).alias("loss"))
    rows = total.select(F.explode(F.array(
        F.struct(F.lit("average_accuracy").alias("metric"), F.col("macro").alias("value")),
        F.struct(F.lit("total_accuracy").alias("metric"), F.col("micro").alias("value")),
        F.struct(F.lit("loss").alias("metric"), F.col("loss").alias("value")))).alias("m")).select("m.*")
    return per.select(F.concat(F.lit("accuracy_"), "name").alias("metric"),
                      F.col("accuracy").alias("value")).unionByName(rows)


def test_case_score(joined: DataFrame, program: str = "program_id") -> DataFrame:
    """Share of cases whose normalised output equals the reference; a missing output never matches."""
    hit = F.coalesce(normalise_output("output") == normalise_output("expected"), F.lit(False))
    return joined.groupBy(program).agg(F.avg(hit.cast("double")).alias("score"), F.count(F.lit(1)).alias("cases"))


def log_sigmoid(x: Column) -> Column:
    """Stable on both sides: min(x, 0) - log1p(exp(-|x|))."""
    return F.least(x, F.lit(0.0)) - F.log1p(F.exp(-F.abs(x)))


def pairwise_reward(chosen: Column | str, rejected: Column | str) -> list[Column]:
    """Accuracy (a tie is right) and mean loss of chosen over rejected."""
    margin = col_of(chosen) - col_of(rejected)
    return [F.avg((margin >= 0).cast("double")).alias("accuracy"), F.avg(-log_sigmoid(margin)).alias("loss")]


def preference_log(df: DataFrame, split: str = "split") -> DataFrame:
    """Sum / count means of rewards, logps and logits per side, and the reward margin."""
    sums = []
    for side in ("chosen", "rejected"):
        of_side = F.col("side") == side
        count = F.sum(F.when(of_side, F.col("count")))
        for m in ("rewards", "logps", "logits"):
            sums.append((F.sum(F.when(of_side, F.col(m))) / count).alias(f"{m}_{side}"))
    out = df.groupBy(split).agg(*sums)
    return out.withColumn("rewards_margins", F.col("rewards_chosen") - F.col("rewards_rejected"))


def odds_ratio(log: DataFrame, pair: str = "pair_id") -> DataFrame:
    """Per pair: mean answer log-probability of both sides, log odds and its log sigmoid."""
    mean = {s: F.avg(F.when((F.col("side") == s) & F.col("answer"), F.col("logprob"))).alias(s)
            for s in ("chosen", "rejected")}
    rows = log.groupBy(pair).agg(*mean.values())
    c, r = F.col("chosen"), F.col("rejected")
    odds = (c - r) - (F.log(1 - F.exp(c)) - F.log(1 - F.exp(r)))
    return rows.withColumn("log_odds", odds).withColumn("ratio", log_sigmoid(F.col("log_odds")))


def perplexity(losses: DataFrame, text: str, pos: str = "pos", loss: str = "loss", max_len: int = 512,
               stride: int = 256) -> DataFrame:
    """exp of the mean of window losses; a token counts in the window that first reaches it.

    That window's number is arithmetic on the position, so windows are never generated.
    """
    if not 0 < stride <= max_len:
        raise ValueError("stride must be between 1 and the window length")
    p = F.col(pos)
    number = F.when(p < max_len, 0).otherwise(F.ceil((p - max_len + 1) / stride)).cast("int")
    windows = losses.groupBy(text, number.alias("window")).agg(F.avg(loss).alias("window_loss"))
    return windows.groupBy(text).agg(F.count(F.lit(1)).alias("windows"), F.exp(F.avg("window_loss")).alias("score"))


# Timing ---------------------------------------------------------------------------------


# values a task may rank, and parts a bucket is cut into
RANKED_VALUES, BUCKET_PARTS = 65_536, 65_536


def value_bucket(v: Column) -> Column:
    """A monotone bucket about 0.1% wide over the whole range of doubles."""
    return F.when(F.isnan(v), 1 << 20).otherwise(F.floor(F.least(F.greatest(F.asinh(v), F.lit(-800.0)), F.lit(800.0)) * 1024)).cast("long")


def values_at(df: DataFrame, by: list[str], value: str, wanted: dict[str, Callable[[Column], Column]],
              ranked_values: int = RANKED_VALUES) -> DataFrame:
    """Exact order statistics: per group and label the value at a 0-based index that depends on the row count.

    A radix select: counting narrow value buckets finds the bucket an index falls in.  While a bucket that was hit
    holds more than ``ranked_values`` rows of different values, it is cut into ``BUCKET_PARTS`` equal parts between its lowest
    and highest value, and those are counted.  Three cuts reach single doubles, whatever the values are.  The distinct
    values of the last buckets are ranked.  All counting combines before the shuffle.  An index past the end gives NaN.
    """
    rows = df.select(*by, F.col(value).cast("double").alias("_v")).withColumn("_p", value_bucket(F.col("_v")).cast("string"))
    counted = [F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    counts = rows.groupBy(*by, "_p").agg(*counted)
    group = Window.partitionBy(*by)
    below = Window.unboundedPreceding, -1
    lower = F.coalesce(F.sum("_n").over(group.orderBy("_low").rowsBetween(*below)), F.lit(0))
    placed = counts.withColumns({"_lo": lower, "_total": F.sum("_n").over(group)})
    asks = F.array(*[F.struct(F.lit(k).alias("label"), f(F.col("_total")).cast("long").alias("at")) for k, f in wanted.items()])
    inside = F.filter(asks, lambda a: (a["at"] >= F.col("_lo")) & (a["at"] < F.col("_lo") + F.col("_n")))
    told = [F.col("_ask.label").alias("label"), (F.col("_ask.at") - F.col("_lo")).alias("_at")]
    # every group has a row without a label, so that labels past the end are known
    every = F.concat(inside, F.array(F.struct(F.lit(None).cast("string").alias("label"), F.lit(None).cast("long").alias("at"))))
    asked = F.when(F.col("_lo") == 0, every).otherwise(inside)
    hits = materialise(placed.withColumn("_ask", F.explode(asked)).select(*by, "_p", *told, "_n", "_low", "_high"), "ranks")
    groups, hits = hits.select(*by).distinct(), hits.filter("label is not null")
    wide = (F.col("_n") > ranked_values) & (F.col("_low") < F.col("_high"))
    while not hits.filter(wide).isEmpty():
        cut = hits.select(*by, "_p", "_low", "_high", wide.alias("_wide")).distinct()
        part = F.when(F.col("_wide"), F.floor((F.col("_v") - F.col("_low")) / (F.col("_high") - F.col("_low")) * (BUCKET_PARTS - 1))).otherwise(0)
        rows = rows.join(cut, [*by, "_p"]).select(*by, "_v", F.col("_p").alias("_of"), F.concat("_p", F.lit("/"), part.cast("string")).alias("_p"))
        counts = rows.groupBy(*by, "_of", "_p").agg(*counted)
        rows = rows.drop("_of")
        order = Window.partitionBy(*by, "_of").orderBy("_low").rowsBetween(*below)
        placed = counts.withColumn("_lo", F.coalesce(F.sum("_n").over(order), F.lit(0)))
        old = hits.select(*by, F.col("_p").alias("_of"), F.struct("label", F.col("_at").alias("at")).alias("_ask"))
        near = placed.join(old, [*by, "_of"]).filter((F.col("_ask.at") >= F.col("_lo")) & (F.col("_ask.at") < F.col("_lo") + F.col("_n")))
        hits = materialise(near.select(*by, "_p", *told, "_n", "_low", "_high"), "ranks")
    single = hits.filter("_low = _high").select(*by, "label", F.col("_low").alias("value"))
    several = hits.filter("_low < _high")
    near = rows.join(several.select(*by, "_p").distinct(), [*by, "_p"], "left_semi")
    distinct = near.groupBy(*by, "_p", "_v").agg(F.count(F.lit(1)).alias("_n"))
    under = Window.partitionBy(*by, "_p").orderBy("_v").rowsBetween(*below)
    ranked = distinct.withColumn("_lo", F.coalesce(F.sum("_n").over(under), F.lit(0)))
    found = ranked.join(several.select(*by, "_p", "label", "_at"), [*by, "_p"]).filter(
        (F.col("_at") >= F.col("_lo")) & (F.col("_at") < F.col("_lo") + F.col("_n")))
    labels = groups.withColumn("label", F.explode(F.array(*[F.lit(k) for k in wanted])))
    known = single.unionByName(found.select(*by, "label", F.col("_v").alias("value")))
    return labels.join(known, [*by, "label"], "left").withColumn("value", F.coalesce("value", F.lit(float("nan"))))


def rank_index(percent: float) -> Callable[[Column], Column]:
    """floor(p / 100 * n)."""
    return lambda n: F.floor(F.lit(percent / 100.0) * n)


def latency_table(df: DataFrame, by: list[str], value: str, percents=(50, 90, 99)) -> DataFrame:
    basic = df.groupBy(*by).agg(F.avg(value).alias("average"), F.min(value).alias("lowest"), F.max(value).alias("highest"))
    exact = values_at(df, by, value, {f"p{p}": rank_index(p) for p in percents})
    wide = exact.groupBy(*by).pivot("label", [f"p{p}" for p in percents]).agg(F.first("value"))
    return basic.join(wide, by)


def throughput(df: DataFrame) -> DataFrame:
    """prefill = batch / seconds; decode = batch x length / seconds, and the latency of one token."""
    seconds = F.col("latency_ms") / 1000
    tokens = F.when(F.col("step") == "prefill", F.col("batch_size")).otherwise(F.col("batch_size") * F.col("decode_length"))
    return df.withColumns({"throughput": tokens / seconds,
                           "token_latency_ms": F.when(F.col("step") == "decode", F.col("latency_ms") / F.col("decode_length"))})


def throughput_table(df: DataFrame, by: list[str]) -> DataFrame:
    return throughput(df).groupBy(*by).agg(
        F.avg("throughput").alias("average"), F.min("throughput").alias("lowest"),
        F.max("throughput").alias("highest"), F.avg("token_latency_ms").alias("token_latency"))


def histogram(df: DataFrame, value: str, buckets: int) -> DataFrame:
    """Counts in ``buckets`` buckets from min to max; one value only puts all in bucket 0."""
    if buckets < 2:
        raise ValueError("a histogram needs two buckets")
    ends = df.agg(F.struct(F.min(value).alias("lo"), F.max(value).alias("hi")).alias("e")).scalar()
    placed = df.select(F.col(value).alias("_v"), ends["lo"].alias("_lo"),
                       ((ends["hi"] - ends["lo"]) / (buckets - 1)).alias("_step"))
    number = F.when(F.col("_step") == 0, 0).otherwise(
        F.least(F.ceil((F.col("_v") - F.col("_lo")) / F.col("_step")), F.lit(buckets - 1)))
    counts = placed.groupBy(number.cast("long").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(buckets).withColumnRenamed("id", "bucket")
    step = (ends["hi"] - ends["lo"]) / (buckets - 1)
    return every.join(counts, "bucket", "left").select(
        "bucket", (ends["lo"] + step * F.col("bucket")).alias("start"), F.coalesce("n", F.lit(0)).alias("n"))


def load_run(df: DataFrame, reference_ms: float) -> DataFrame:
    """Counters, median time per token and whether the run passes.

    Client errors are left out; a server error fails the run.
    """
    served = df.filter((F.col("status") < 400) | (F.col("status") >= 500))
    good = F.col("status") == 200
    timed = served.filter(good).select(F.lit(1).alias("g"), (F.col("duration_ms") / F.col("new_tokens")).alias("v"))
    middle = values_at(timed, ["g"], "v", {"lo": lambda n: F.floor((n - 1) / 2), "hi": lambda n: F.ceil((n - 1) / 2)})
    p50 = middle.agg(F.avg("value").alias("p50"))
    counts = served.agg(
        F.count(F.lit(1)).alias("requests"), F.count(F.when(~good, 1)).alias("failed"),
        F.sum(F.when(good, F.col("input_tokens"))).alias("input_tokens"),
        F.sum(F.when(good, F.col("new_tokens"))).alias("new_tokens"),
        F.sum(F.when(good, F.col("input_tokens") + F.col("new_tokens"))).alias("tokens"))
    out = counts.withColumn("time_per_token_p50", p50.scalar())
    return out.withColumn("passed", ((F.col("failed") == 0) & (F.col("time_per_token_p50") < 5 * reference_ms)).cast("int"))


# Votes, text metrics, best of n ---------------------------------------------------------


def vote_count(df: DataFrame, choice: str) -> DataFrame:
    return df.groupBy(choice).agg(F.count(F.lit(1)).alias("votes"))


def token_overlap(df: DataFrame, key: str, prediction: str, reference: str) -> DataFrame:
    """Token F1 per row from token counts; a long text is spread over tasks, not folded in one."""
    flat = df.select(key, F.explode(F.array(
        F.struct(F.lit(1).alias("p"), F.lit(0).alias("r"), token_texts(prediction).alias("t")),
        F.struct(F.lit(0).alias("p"), F.lit(1).alias("r"), token_texts(reference).alias("t")))).alias("s"))
    tokens = flat.select(key, "s.p", "s.r", F.explode("s.t").alias("token"))
    counts = tokens.groupBy(key, "token").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    sums = counts.groupBy(key).agg(F.sum(F.least("p", "r")).alias("common"), F.sum("p").alias("p"), F.sum("r").alias("r"))
    return sums.select(key, (2 * F.col("common") / (F.col("p") + F.col("r"))).alias("token_f1"))


def edit_similarity(prediction: Column | str, reference: Column | str) -> Column:
    p, r = col_of(prediction), col_of(reference)
    longest = F.greatest(F.length(p), F.length(r))
    return F.when(longest == 0, 1.0).otherwise(1 - F.levenshtein(p, r) / longest)


# The replacements of the 13a tokenization, and the orders and weight of the character score.
BLEU_PLAIN = [("<skipped>", ""), ("-\n", ""), ("\n", " "), ("&quot;", '"'), ("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">")]
BLEU_SPLIT = [(r"([{-~\[-` -&(-+:-@/])", " $1 "), (r"([^0-9])([.,])", "$1 $2 "), (r"([.,])([^0-9])", " $1 $2"), (r"([0-9])(-)", "$1 $2 ")]
BLEU_ORDER, CHRF_ORDER, CHRF_BETA = 4, 6, 2


def bleu_words(text: Column | str) -> Column:
    t = col_of(text)
    for old, new in BLEU_PLAIN:
        t = F.replace(t, F.lit(old), F.lit(new))
    t = F.concat(F.lit(" "), t, F.lit(" "))
    for form, new in BLEU_SPLIT:
        t = F.regexp_replace(t, form, new)
    return F.filter(F.split(t, r"\s+"), lambda w: w != "")


def characters(text: Column | str) -> Column:
    """Characters without white space."""
    return F.filter(F.split(F.regexp_replace(col_of(text), r"\s", ""), ""), lambda c: c != "")


def _gram_sums_of_keys(rows: DataFrame, order: int) -> DataFrame:
    """As ``_gram_sums``, for keys of several rows: their n-grams meet in a shuffle."""
    sides = rows.select("_key", F.explode(F.array(
        F.struct(F.lit(1).alias("p"), F.lit(0).alias("r"), F.col("_p").alias("t")),
        F.struct(F.lit(0).alias("p"), F.lit(1).alias("r"), F.col("_r").alias("t")))).alias("s")).select("_key", "s.*")
    grams = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(order)), lambda n: F.when(F.size("t") >= n, F.transform(
        F.sequence(F.lit(1), F.size("t") - n + 1), lambda i: F.struct(n.alias("n"), F.array_join(F.slice("t", i, n), "\u0001").alias("g"))))
        .otherwise(F.array().cast("array<struct<n:int,g:string>>"))))
    counts = sides.select("_key", "p", "r", F.explode(grams).alias("x")).groupBy("_key", "x").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    return counts.groupBy(F.col("x.n").alias("n")).agg(F.sum("p").alias("p"), F.sum("r").alias("r"), F.sum(F.least("p", "r")).alias("hit"))


def _gram_sums_of_rows(rows: DataFrame, order: int) -> DataFrame:
    """As ``_gram_sums``, for keys of one row, a few texts at a time: an n-gram is the number of the one before it in its row and a word."""

    def count(texts: list[pa.ListArray]) -> list[tuple[int, int, int, int]]:
        sizes = np.concatenate([pc.list_value_length(t).fill_null(0).to_numpy(zero_copy_only=False) for t in texts]).astype(np.int64)
        words = pa.concat_arrays([t.flatten() for t in texts])
        codes, known = pd.factorize(words.dictionary_encode().indices.to_numpy(zero_copy_only=False))
        left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(codes))  # words from here to the end of the text
        at, grams = np.arange(len(codes)), np.repeat(np.tile(np.arange(len(texts[0])), 2), sizes)
        predicted = at < sizes[:len(texts[0])].sum()
        sums = []
        for n in range(1, order + 1):
            inside = left[at] >= n
            at, grams = at[inside], grams[inside]
            if not len(at):
                break
            grams, _ = pd.factorize(grams * len(known) + codes[at + n - 1])
            p, r = (np.bincount(grams[side], minlength=grams.max() + 1) for side in (predicted[at], ~predicted[at]))
            sums.append((n, int(p.sum()), int(r.sum()), int(np.minimum(p, r).sum())))
        return sums

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 128):
                part = b.slice(at, 128)
                found = count([part.column(0), part.column(1)])
                yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], t) for k, t in enumerate([pa.int32(), *[pa.int64()] * 3])],
                                                 names=["n", "p", "r", "hit"])

    return rows.select("_p", "_r").mapInArrow(run, "n int, p long, r long, hit long")


def _gram_sums(df: DataFrame, key: str, prediction: Column, reference: Column, order: int) -> DataFrame:
    """Per order: n-grams of all predictions and references, and matches, clipped text by text (rows of one key count as one text)."""
    often = df.groupBy(F.col(key).alias("_often")).count().filter("count > 1").select("_often", F.lit(True).alias("_several"))
    marked = df.join(often, df[key].eqNullSafe(often["_often"]), "left")
    several = F.col("_several").isNotNull()
    texts = [F.col(key).alias("_key"), prediction.alias("_p"), reference.alias("_r")]
    parts = [_gram_sums_of_rows(by_rows(marked.filter(~several)).select(*texts), order),
             _gram_sums_of_keys(marked.filter(several).select(*texts), order)]
    return union_all(parts).groupBy("n").agg(*[F.sum(c).alias(c) for c in ("p", "r", "hit")])


def corpus_bleu(df: DataFrame, key: str, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """BLEU of a whole table with one reference a row (key unique): 13a words, four orders, exponential smoothing of orders without a match."""
    sums = _gram_sums(df, key, bleu_words(prediction), bleu_words(reference), BLEU_ORDER)
    at = [F.first(F.when(F.col("n") == n, F.struct("p", "r", "hit")), ignorenulls=True).alias(f"o{n}") for n in range(1, BLEU_ORDER + 1)]
    one = sums.agg(*at)
    total, empty = F.lit(0.0), F.lit(0)
    for n in range(1, BLEU_ORDER + 1):
        p, hit = F.coalesce(F.col(f"o{n}.p"), F.lit(0)), F.coalesce(F.col(f"o{n}.hit"), F.lit(0))
        empty = empty + F.when(hit == 0, 1).otherwise(0)
        share = F.when(hit > 0, hit / p).otherwise(1 / (F.pow(F.lit(2.0), empty) * p))
        total = total + F.when(p > 0, F.log(share))
    words_p, words_r = F.coalesce(F.col("o1.p"), F.lit(0)), F.coalesce(F.col("o1.r"), F.lit(0))
    short = F.when(words_p < words_r, F.exp(1 - words_r / words_p)).otherwise(1.0)
    return one.select(F.coalesce(F.when(F.col("o1.hit") > 0, 100 * short * F.exp(total / BLEU_ORDER)), F.lit(0.0)).alias("bleu"))


def corpus_chrf(df: DataFrame, key: str, prediction: str = "prediction", reference: str = "reference") -> DataFrame:
    """Character F-score of a whole table with one reference a row: mean precision and recall over the orders both sides have."""
    sums = _gram_sums(df, key, characters(prediction), characters(reference), CHRF_ORDER).filter("p > 0 and r > 0")
    means = sums.agg(F.avg(F.col("hit") / F.col("p")).alias("p"), F.avg(F.col("hit") / F.col("r")).alias("r"))
    weight = CHRF_BETA ** 2
    return means.select(F.coalesce(F.when(F.col("p") + F.col("r") > 0, 100 * (1 + weight) * F.col("p") * F.col("r") / (weight * F.col("p") + F.col("r"))),
                                   F.lit(0.0)).alias("chrf"))


# Metrics that are a column expression over prediction and reference.
TEXT_METRICS: dict[str, Callable[[Column, Column], Column]] = {
    "exact_match": lambda p, r: (p == r).cast("double"),
    "edit_similarity": edit_similarity,
}


def text_metrics(df: DataFrame, key: str, prediction: str = "prediction", references: str = "references",
                 metrics: tuple[str, ...] = ("exact_match", "edit_similarity", "token_f1")) -> DataFrame:
    """Mean per metric; with several references a prediction takes its best one."""

    def best(metric: Callable[[Column, Column], Column]) -> Column:
        return F.array_max(F.transform(references, lambda r: metric(F.col(prediction), r)))

    scores = {m: best(TEXT_METRICS[m]) for m in metrics if m in TEXT_METRICS}
    rows = df.select(key, *[s.alias(m) for m, s in scores.items()])
    if "token_f1" in metrics:
        each = df.select(key, prediction, F.posexplode(references).alias("_n", "_r"))
        each = each.withColumn("_k", F.struct(key, "_n"))
        overlap = token_overlap(each, "_k", prediction, "_r").groupBy(F.col(f"_k.{key}").alias(key)).agg(
            F.max("token_f1").alias("token_f1"))
        rows = rows.join(overlap, key, "left").fillna({"token_f1": 0.0})
    return rows.agg(*[F.avg(m).alias(f"eval_{m}") for m in metrics])


def prediction_split(rows: DataFrame) -> DataFrame:
    """Prompt, correct and predicted ids of rows with ids, labels and ``predicted``, the model's choice at every position."""
    hits = F.filter(F.arrays_zip(F.col("labels"), F.col("predicted")), lambda p: p["labels"] != IGNORED)
    rest = [c for c in rows.columns if c not in ("input_ids", "labels", "predicted")]
    return rows.select(*rest, *split_labelled("input_ids", "labels"),
                       F.transform(hits, lambda p: p["predicted"]).alias("predicted_ids"))


def prediction_table(packed: DataFrame, order: list[str], rows: int | None = None) -> DataFrame:
    """``prediction_split`` of each member of packed rows; the first ``rows`` in order."""
    flat = unpacked(packed, ["input_ids", "labels", "predicted"]).select(*order, "range", "input_ids", "labels", "predicted")
    return prediction_split(flat if rows is None else flat.orderBy(*order, "range").limit(rows))


def best_of(log: DataFrame, prompt: str = "prompt_id", attempt: str = "try", logprob: str = "logprob") -> DataFrame:
    """Mean log-probability per try and whether it is its prompt's best; the first of equals wins."""
    score = log.groupBy(prompt, attempt).agg(F.avg(logprob).alias("score"))
    top = score.groupBy(prompt).agg(F.max(F.struct("score", (-F.col(attempt)).alias("_t"))).alias("_top"))
    return score.join(top, prompt).select(
        prompt, attempt, "score", (F.col(attempt) == -F.col("_top._t")).cast("int").alias("is_best"))


# Run checks -----------------------------------------------------------------------------


def first_violation(df: DataFrame, run: str, step: str, loss: str, threshold: float, patience: int = 3,
                    bucket_bits: int = 16) -> DataFrame:
    """Per run, the first step that ends ``patience`` losses above ``threshold`` in a row.

    Steps are unique integers, so a bucket of 2**bucket_bits steps bounds the rows any
    window sees, however hot a run is.  Buckets are summed up by an aggregate and carry
    the last good row across.
    """
    rows = df.select(run, step, (F.col(loss) > threshold).alias("_bad"),
                     F.shiftright(F.col(step).cast("long"), bucket_bits).alias("_b"))
    inside = Window.partitionBy(run, "_b").orderBy(step)
    rows = rows.withColumn("_rn", F.row_number().over(inside))
    rows = rows.withColumn("_good", F.max(F.when(~F.col("_bad"), F.col("_rn"))).over(
        inside.rowsBetween(Window.unboundedPreceding, 0)))
    parts = rows.groupBy(run, "_b").agg(F.count(F.lit(1)).alias("_n"), F.max("_good").alias("_last"))
    earlier = Window.partitionBy(run).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    parts = parts.withColumn("_carry", F.coalesce(F.max(F.col("_before") + F.col("_last")).over(earlier), F.lit(0)))
    at = F.col("_before") + F.col("_rn")
    last_good = F.coalesce(F.col("_before") + F.col("_good"), F.col("_carry"))
    hits = rows.join(parts.select(run, "_b", "_before", "_carry"), [run, "_b"]).filter(at - last_good >= patience)
    return hits.groupBy(run).agg(F.min(F.struct(at.alias("at"), F.col(step).alias(step))).alias("_f")).select(
        run, F.col("_f.at").alias("step_number"), F.col(f"_f.{step}").alias(step))
