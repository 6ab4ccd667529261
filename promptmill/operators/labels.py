"""Token ids with labels: masks, chat encodings, windows, weights, audits.

Texts are tokenized segment by segment, so every mask boundary is known and no
search for it is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import indices, let, once, running_starts
from promptmill.functions.text import col_of, fill, strip
from promptmill.functions.tokens import BOS, EOS, IGNORED, PAD, encode, ignored, no_ids, token_ids
from promptmill.operators.chat import PERSONA_MODEL_MARK
from promptmill.operators.order import shuffle_key, unit_interval


def attention(ids: Column) -> Column:
    return F.array_repeat(F.lit(1), F.size(ids))


def encoded(ids: Column, labels: Column) -> Column:
    """The tokenized row: ids, mask and labels."""
    return let(ids, lambda i: F.struct(i.alias("input_ids"), attention(i).alias("attention_mask"), labels.alias("labels")))


def with_encoded(df: DataFrame, row: Column) -> DataFrame:
    """Adds input_ids, attention_mask and labels; the row is computed once, also below later filters."""
    names = ("input_ids", "attention_mask", "labels")
    out = once(df, _row=row)
    return out.withColumns({n: F.col(f"_row.{n}") for n in names}).drop("_row")


def prompt_masked(prompt: Column | str, answer: Column | str, max_len: int | None = None, bos: bool = False,
                  train_on_inputs: bool = False, eos_count: int = 1) -> Column:
    """Prompt masked, answer trains, closed by EOS."""
    def row(p: Column, a: Column) -> Column:
        return encoded(F.concat(p, a), F.concat(p if train_on_inputs else ignored(F.size(p)), a))

    return let(encode(prompt, max_len, bos=bos), lambda p: let(
        encode(answer, max_len, bos=bos, eos=True, strip_bos=True, eos_count=eos_count), lambda a: row(p, a)))


def whole_text_masked(full: Column, prompt: Column, max_len: int | None = None,
                      train_on_inputs: bool = False) -> Column:
    """The full text is tokenized once and its first prompt-length labels are masked."""
    def row(ids: Column) -> Column:
        if train_on_inputs:
            return encoded(ids, ids)
        return let(F.least(tk.token_count(prompt), F.size(ids)), lambda n: encoded(
            ids, F.concat(ignored(n), F.slice(ids, n + 1, F.size(ids)))))

    return let(encode(full, max_len, eos=True), row)


def flat_parts(parts: Column) -> Column:
    """One tokenized row of an array of (ids, labels) parts."""
    return let(parts, lambda p: encoded(F.flatten(F.transform(p, lambda x: x["ids"])),
                                        F.flatten(F.transform(p, lambda x: x["labels"]))))


def part(ids: Column, trains: Column) -> Column:
    return let(ids, lambda t: F.struct(t.alias("ids"), F.when(trains, t).otherwise(ignored(F.size(t))).alias("labels")))


def labelled(segments: Column, text: str = "text", trains: str = "trains") -> Column:
    """Ids and labels of an array of (text, trains) segments."""
    return flat_parts(F.transform(segments, lambda s: part(token_ids(s[text]), F.coalesce(s[trains], F.lit(False)))))


def turn_masked(messages: Column | str, before: str = "<|im_start|>{role}\n", roles_to_train=("assistant",),
                train_on_inputs: bool = False, train_on_eos: str = "turn",
                training: str | None = None, detail: str | None = None) -> Column:
    """Per-turn labels of a chat whose turns are mark, content, EOS.

    A turn trains by its own flag, else by having spans, else by its role; a turn with
    spans trains only the tokens its train spans cover.  ``train_on_eos`` is all, turn or last.
    """
    m = col_of(messages)
    count = F.size(m)
    return flat_parts(F.transform(m, lambda x, i: turn_part(
        x["role"], x["content"], i == count - 1, before, roles_to_train, train_on_inputs, train_on_eos,
        x[training] if training else None, x[detail] if detail else None)))


def turn_part(role: Column, content: Column, is_last: Column, before: str = "<|im_start|>{role}\n", roles_to_train=("assistant",),
              train_on_inputs: bool = False, train_on_eos: str = "turn", training: Column | None = None,
              detail: Column | None = None) -> Column:
    """(ids, labels) of one turn of such a chat."""
    trains = F.lit(train_on_inputs) | role.isin(*roles_to_train)
    if detail is not None:
        trains = F.when(detail.isNotNull(), F.size(detail) > 0).otherwise(trains)
    if training is not None:
        trains = F.coalesce(training, trains)
    eos = {"all": F.lit(True), "turn": trains, "last": is_last}[train_on_eos]
    end = F.array(F.lit(EOS))

    def turn(mark: Column, body: Column) -> Column:
        return F.struct(
            F.concat(mark, body["ids"], end).alias("ids"),
            F.concat(ignored(F.size(mark)), body["labels"], F.when(eos, end).otherwise(ignored(1))).alias("labels"))

    body = part(token_ids(content), trains)
    if detail is not None:
        spanned = trains & (F.coalesce(F.size(detail), F.lit(0)) > 0)
        body = F.when(spanned, span_labels(content, detail)).otherwise(body)
    return let(token_ids(fill(before, {"role": role})), lambda k: let(body, lambda b: turn(k, b)))


PIECE_PATTERN = r"\s+|" + tk.WORD_PATTERN


def token_spans(text: Column | str) -> Column:
    """(token, start, end) per token; a token reaches up to the next token's start."""
    t = col_of(text)
    last = F.length(t) - 1

    def placed(pieces: Column) -> Column:
        starts = running_starts(F.transform(pieces, lambda p: F.length(p)))
        return let(starts, lambda s: F.transform(
            pieces, lambda p, i: F.struct(p.alias("token"), s[i].alias("start"))))

    def ended(kept: Column) -> Column:
        return F.transform(kept, lambda p, i: F.struct(
            p["token"].alias("token"), p["start"].alias("start"),
            F.coalesce(F.try_element_at(kept, i + 2)["start"] - 1, last).cast("int").alias("end")))

    all_pieces = let(F.regexp_extract_all(t, F.lit(PIECE_PATTERN), F.lit(0)), placed)
    return let(F.filter(all_pieces, lambda p: ~p["token"].rlike(r"^\s")), ended)


def span_labels(text: Column | str, details: Column) -> Column:
    """Ids and labels from character spans: spans snap outward to tokens, covered tokens of a train span train."""

    def labels(t: Column, starts: Column, ends: Column) -> Column:
        n = F.size(t)

        def snapped(d: Column) -> Column:
            first = F.size(F.filter(starts, lambda s: s < d["begin_offset"]))
            last = F.size(F.filter(ends, lambda e: e <= d["end_offset"])) - 1
            return F.struct(
                F.when((first > 0) & (F.try_element_at(ends, first) > d["begin_offset"]), first - 1).otherwise(first).alias("first"),
                F.when((last < n - 1) & (F.try_element_at(starts, last + 2) < d["end_offset"]), last + 1).otherwise(last).alias("last"),
                d["train"].alias("train"))

        def marked(spans: Column, ids: Column) -> Column:
            return F.struct(ids.alias("ids"), F.transform(ids, lambda x, i: F.when(
                F.exists(spans, lambda d: d["train"] & (i >= d["first"]) & (i <= d["last"])), x)
                .otherwise(F.lit(IGNORED))).alias("labels"))

        return let(F.transform(details, snapped), lambda spans: let(
            F.transform(t, lambda x: tk.token_id(x["token"])), lambda ids: marked(spans, ids)))

    return let(token_spans(text), lambda t: let(
        F.transform(t, lambda x: x["start"]), lambda starts: let(
            F.transform(t, lambda x: x["end"]), lambda ends: labels(t, starts, ends))))


def span_masked(df: DataFrame, text: str, details: str) -> DataFrame:
    out = once(df, _row=span_labels(text, F.col(details)))
    return out.withColumns({"input_ids": F.col("_row.ids"), "labels": F.col("_row.labels")}).drop("_row")


def weighted_labels(segments: Column) -> Column:
    """Ids and labels of weighted segments; weight zero masks, a missing weight trains."""
    flagged = F.transform(segments, lambda s: F.struct(
        s["text"].alias("text"), (F.coalesce(s["weight"], F.lit(1)) != 0).alias("trains")))
    return labelled(flagged)


# Windows over long texts ----------------------------------------------------------------


def chunks(ids: Column | str, length: int) -> Column:
    """Consecutive blocks of ``length``; empty input gives no block."""
    a = col_of(ids)
    starts = F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(length))
    return F.when(F.size(a) > 0, F.transform(starts, lambda s: F.slice(a, s, length))).otherwise(
        F.array().cast("array<array<int>>"))


def strided_windows(ids: Column | str, max_len: int, stride: int = 256) -> Column:
    """Windows of ``max_len`` - 1 ids that overlap by ``stride``, each closed by EOS."""
    a, width = col_of(ids), max_len - 1
    if not 0 <= stride < width:
        raise ValueError("stride must be below the window length")
    last = F.greatest(F.ceil((F.size(a) - width) / (width - stride)).cast("int"), F.lit(0))
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.concat(
        F.slice(a, k * (width - stride) + 1, width), F.array(F.lit(EOS))))


def explode_windows(df: DataFrame, windows: Column, out: str = "input_ids") -> DataFrame:
    return df.select(*[c for c in df.columns if c != out], F.posexplode(windows).alias("window", out))


# Other encodings ------------------------------------------------------------------------


def source_target(source: Column | str, target: Column | str, source_max: int, target_max: int,
                  train_on_source: bool = False, predict: bool = False) -> Column:
    """BOS + source and target + EOS, each cut at its own limit."""
    source_ids = F.slice(F.concat(F.array(F.lit(BOS)), token_ids(source, source_max)), 1, source_max)
    if predict:
        return let(source_ids, lambda s: encoded(s, ignored(F.size(s))))
    target_ids = F.slice(F.concat(token_ids(target, target_max), F.array(F.lit(EOS))), 1, target_max)
    return let(source_ids, lambda s: let(target_ids, lambda t: encoded(
        F.concat(s, t), F.concat(s if train_on_source else ignored(F.size(s)), t))))


# Marks of the two fixed-length chat markups and the default system line.
CODER_SYSTEM = ("You are an exceptionally intelligent coding assistant that consistently delivers accurate "
                "and reliable responses to user instructions.\n")
CODER_TURNS = {"user": "### Instruction:\n{content}\n", "assistant": "### Response:\n{content}\n<|EOT|>\n"}
ROLE_MARK = "<|{role}|>\n"


def fixed_length(row: Column, length: int, cut_label: int) -> Column:
    """Padded with EOS / -100 to ``length``, or cut with EOS forced last."""
    def fit(a: Column, pad: int, last: int) -> Column:
        return F.when(F.size(a) < length, F.concat(a, F.array_repeat(F.lit(pad), length - F.size(a)))).otherwise(
            F.concat(F.slice(a, 1, length - 1), F.array(F.lit(last))))
    return let(row, lambda r: F.struct(fit(r["input_ids"], EOS, EOS).alias("input_ids"),
                                       fit(r["labels"], IGNORED, cut_label).alias("labels")))


def lead_part(ids: Column) -> Column:
    """An array with one masked part."""
    return F.array(part(ids, F.lit(False)))


def coder_chat(messages: Column | str, length: int) -> Column:
    """Instruction / response lines; only answers train; a default system line where none is given."""
    m = col_of(messages)
    has_system = F.exists(m, lambda x: x["role"] == "system")
    lead = F.when(has_system, no_ids()).otherwise(token_ids(F.lit(CODER_SYSTEM)))

    def one(x: Column) -> Column:
        text = (F.when(x["role"] == "system", x["content"])
                .when(x["role"] == "user", fill(CODER_TURNS["user"], {"content": x["content"]}))
                .otherwise(fill(CODER_TURNS["assistant"], {"content": x["content"]})))
        return part(token_ids(text), ~x["role"].isin("user", "system"))

    parts = F.concat(lead_part(F.concat(F.array(F.lit(BOS)), lead)), F.transform(m, one))
    return fixed_length(flat_parts(parts), length, IGNORED)


def role_chat(messages: Column | str, length: int) -> Column:
    """``<|role|>`` lines with EOS after each answer; answers and their EOS train."""
    def one(x: Column) -> Column:
        answer = x["role"] == "assistant"
        mark = part(token_ids(fill(ROLE_MARK, {"role": x["role"]})), F.lit(False))
        end = F.when(answer, F.array(F.lit(EOS))).otherwise(no_ids())
        return F.array(mark, part(F.concat(token_ids(strip(x["content"])), end), answer))

    parts = F.concat(lead_part(F.array(F.lit(BOS))), F.flatten(F.transform(col_of(messages), one)))
    return fixed_length(flat_parts(parts), length, EOS)


def inst_encoded(segments: Column, length: int) -> Column:
    """[INST] chat: BOS first, questions masked, cut or padded to ``length``."""
    def fit(a: Column, pad: int) -> Column:
        return F.concat(F.slice(a, 1, length),
                        F.array_repeat(F.lit(pad), F.greatest(length - F.size(a), F.lit(0))))

    parts = F.concat(lead_part(F.array(F.lit(BOS))),
                     F.transform(segments, lambda s: part(token_ids(s["text"]), s["trains"])))
    return let(flat_parts(parts), lambda r: F.struct(
        fit(r["input_ids"], PAD).alias("input_ids"), fit(r["labels"], IGNORED).alias("labels"),
        F.transform(fit(r["input_ids"], PAD), lambda x: (x != PAD).cast("int")).alias("attention_mask")))


def persona_encoded(segments: Column) -> Column:
    """Persona chat: the model's turn trains after its mark and is closed by EOS; system opens with BOS."""
    mark_len = tk.token_count(F.lit(PERSONA_MODEL_MARK))

    def one(s: Column) -> Column:
        def turn(ids: Column) -> Column:
            model = s["role"] == "bot"
            whole = (F.when(s["role"] == "system", F.concat(F.array(F.lit(BOS)), ids))
                     .when(model, F.concat(ids, F.array(F.lit(EOS)))).otherwise(ids))
            return let(whole, lambda w: F.struct(w.alias("ids"), F.when(model, F.concat(
                ignored(mark_len), F.slice(w, mark_len + 1, F.size(w)))).otherwise(ignored(F.size(w))).alias("labels")))
        return let(token_ids(s["text"]), turn)

    return flat_parts(F.transform(segments, one))


def raw_segments(segments: Column | str, train_on_inputs: bool = False) -> Column:
    """(text, label) segments kept as they are."""
    return flat_parts(F.transform(col_of(segments), lambda s: part(
        token_ids(s["text"]), F.lit(train_on_inputs) | F.coalesce(s["label"], F.lit(False)))))


def odds_ratio_pair(df: DataFrame, prompt: Column | str, chosen: Column | str, rejected: Column | str) -> DataFrame:
    """Adds both sides with labels and the prompt mask of the chosen side."""
    t = once(df, _p=token_ids(prompt), _c=token_ids(chosen), _r=token_ids(rejected))
    p, c, r = F.col("_p"), F.col("_c"), F.col("_r")
    n = F.size(p)
    return t.withColumns({
        "input_ids": F.concat(p, c), "labels": F.concat(ignored(n), c),
        "attention_mask": F.array_repeat(F.lit(1), n + F.size(c)),
        "rejected_input_ids": F.concat(p, r), "rejected_labels": F.concat(ignored(n), r),
        "rejected_attention_mask": F.array_repeat(F.lit(1), n + F.size(r)),
        "prompt_attention_mask": F.concat(attention(p), F.array_repeat(F.lit(0), F.size(c)))}).drop("_p", "_c", "_r")


def reward_pair_encoded(df: DataFrame, chosen: Column | str, rejected: Column | str, max_len: int) -> DataFrame:
    """Adds both sides cut at ``max_len``, their constant labels and the pair's length."""
    t = once(df, input_ids_chosen=encode(chosen, max_len), input_ids_rejected=encode(rejected, max_len))
    c, r = F.col("input_ids_chosen"), F.col("input_ids_rejected")
    return t.withColumns({"attention_mask_chosen": attention(c), "labels_chosen": F.lit(1.0),
                          "attention_mask_rejected": attention(r), "labels_rejected": F.lit(0.0),
                          "length": F.greatest(F.size(c), F.size(r))})


def without_bos(ids: str, others: tuple[str, ...]) -> dict[str, Column]:
    """A leading BOS taken off a list of ids and off the lists beside it."""
    leads = F.try_element_at(F.col(ids), F.lit(1)) == BOS
    return {c: F.when(leads, F.slice(c, 2, F.greatest(F.size(c) - 1, F.lit(0)))).otherwise(F.col(c))
            for c in (ids, *others)}


def classification(text: Column | str, label: Column | str, max_len: int) -> list[Column]:
    ids = F.slice(F.concat(F.array(F.lit(BOS)), token_ids(text, max_len)), 1, max_len)
    return [ids.alias("input_ids"), col_of(label).cast("float").alias("labels")]


# Positions and weights ------------------------------------------------------------------


def positions(ids: Column | str) -> list[Column]:
    return [indices(col_of(ids)).alias("position_ids"), F.size(col_of(ids)).alias("length")]


def skipped_positions(df: DataFrame, key: str, ids: str = "input_ids", max_context: int = 32768,
                      split_tokens: tuple[int, ...] = (), chunk_count: int = 2, seed: int = 42) -> DataFrame:
    """Positions with skips before split points, so that a short text covers a long context.

    The skip before split point k is drawn from md5(seed, key, k): a rerun agrees.
    """
    n = F.size(ids)
    if split_tokens:
        points = F.filter(indices(F.col(ids)), lambda i: F.col(ids)[i].isin(*split_tokens))
    else:
        step = F.floor(n / chunk_count).cast("int")
        points = F.transform(F.array(*[F.lit(k) for k in range(1, chunk_count)]), lambda k: (k * step).cast("int"))
    points = let(F.concat(points, F.array(n)), lambda p: F.when(p[0] < 2, F.slice(p, 2, F.size(p))).otherwise(p))

    start = F.struct(F.lit(0).alias("from"), F.lit(0).alias("skipped"), F.lit(0).alias("k"),
                     F.array().cast("array<struct<from:int,to:int,skip:int>>").alias("parts"))

    def step_on(s: Column, point: Column) -> Column:
        left = F.greatest(F.lit(max_context) - n - s["skipped"], F.lit(0))
        draw = F.floor(unit_interval(seed, F.col(key), s["k"]) * (left + 1)).cast("int")
        skip = (s["skipped"] + F.when(s["from"] > 0, draw).otherwise(0)).cast("int")
        part = F.struct(s["from"].alias("from"), point.alias("to"), skip.alias("skip"))
        return F.struct(point.alias("from"), skip.alias("skipped"), (s["k"] + 1).alias("k"),
                        F.concat(s["parts"], F.array(part)).alias("parts"))

    out = once(df, _p=F.aggregate(points, start, step_on, lambda s: s["parts"]))
    spread = F.transform(F.filter("_p", lambda p: p["to"] > p["from"]),
                         lambda p: F.sequence(p["from"] + p["skip"], p["to"] + p["skip"] - 1))
    out = once(out, position_ids=F.flatten(spread)).drop("_p")
    return out.withColumns({"length": F.size("position_ids"),
                            "sequence_len": F.element_at("position_ids", -1)})


def run_weights(labels: Column | str) -> Column:
    """1 / run length over each run of labels that train, 0 elsewhere.

    Runs come from a text of 0 and 1 cut by a pattern: linear, and no row is exploded.
    """
    flags = F.array_join(F.transform(col_of(labels), lambda x: F.when(x != IGNORED, "1").otherwise("0")), "")
    runs = F.regexp_extract_all(flags, F.lit("1+|0+"), F.lit(0))
    return F.flatten(F.transform(runs, lambda r: F.array_repeat(
        F.when(F.startswith(r, F.lit("1")), F.lit(1.0) / F.length(r)).otherwise(0.0), F.length(r))))


# Audits ---------------------------------------------------------------------------------


def label_audit(df: DataFrame, key: str, sample: int | None = None, seed: int = 42, ids: str = "input_ids",
                labels: str = "labels") -> DataFrame:
    """One row per token: id, label and status trained, masked or zero."""
    rows = df if sample is None else df.orderBy(shuffle_key(seed, key), key).limit(sample)
    flat = rows.select(key, F.posexplode(F.arrays_zip(F.col(ids).alias("id"), F.col(labels).alias("label")))
                       .alias("pos", "t"))
    status = (F.when(F.col("t.label") == IGNORED, "masked").when(F.col("t.label") == 0, "zero").otherwise("trained"))
    return flat.select(key, "pos", F.col("t.id").alias("id"), F.col("t.label").alias("label"), status.alias("status"))


def preference_audit(df: DataFrame, key: str, sample: int | None = None, seed: int = 42) -> DataFrame:
    """One row per token of prompt, chosen, rejected or completion, with its part."""
    rows = df if sample is None else df.orderBy(shuffle_key(seed, key), key).limit(sample)
    parts = [c for c in ("prompt", "chosen", "rejected", "completion") if c in df.columns]
    stacked = rows.select(key, F.explode(F.array(*[
        F.struct(F.lit(c).alias("part"), tk.token_texts(c).alias("tokens")) for c in parts])).alias("p"))
    return stacked.select(key, "p.part", F.posexplode("p.tokens").alias("pos", "token"))


def split_labelled(ids: Column | str, labels: Column | str) -> list[Column]:
    """Prompt = masked ids that are not padding; completion = ids that train."""
    pairs = F.arrays_zip(col_of(ids).alias("id"), col_of(labels).alias("label"))
    prompt = F.filter(pairs, lambda p: (p["label"] == IGNORED) & (p["id"] != PAD))
    answer = F.filter(pairs, lambda p: p["label"] != IGNORED)
    return [F.transform(prompt, lambda p: p["id"]).alias("prompt_ids"),
            F.transform(answer, lambda p: p["id"]).alias("completion_ids")]


# Generated tokens -----------------------------------------------------------------------


def stop_rule(log: DataFrame, request: str = "request_id", pos: str = "pos", token: str = "id", text: str = "text",
              stops: tuple[str, ...] = (), max_new_tokens: int = 20, eos_id: int = EOS,
              ignore_eos: bool = False) -> DataFrame:
    """Finish reason and cut position per request: length, then EOS, then a stop text.

    A stop text can only end at a token inside the first ``max_new_tokens``, so a group never exceeds that many rows.
    It is matched against the last tokens that hold text, one more than the longest stop text has characters.
    """
    near = log.filter(F.col(pos) < max_new_tokens)
    order = Window.partitionBy(request).orderBy(pos)
    filled_so_far = F.sum(F.when(F.length(text) > 0, 1).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    last = Window.partitionBy(request).orderBy("_filled").rangeBetween(-max(map(len, stops), default=0), 0)
    running = F.array_join(F.collect_list(F.when(F.length(text) > 0, F.col(text))).over(last), "")
    hits_stop = F.lit(False)
    for s in stops:
        # a match at the end, or before one closing newline
        hits_stop = hits_stop | F.endswith(F.col("_out"), F.lit(s)) | F.endswith(F.col("_out"), F.lit(s + "\n"))
    rows = near.withColumn("_filled", filled_so_far).withColumn("_out", running) if stops else near
    is_eos = F.lit(False) if ignore_eos else F.col(token) == eos_id
    reason = (F.when(F.col(pos) >= max_new_tokens - 1, "length").when(is_eos, "eos_token")
              .when(hits_stop, "stop_sequence"))
    hit = rows.withColumn("_reason", reason)
    done = hit.groupBy(request).agg(
        F.min(F.when(F.col("_reason").isNotNull(), F.struct(pos, "_reason"))).alias("_first"),
        F.max(pos).alias("_seen"))
    return done.select(request, F.col("_first._reason").alias("finish_reason"),
                       (F.coalesce(F.col(f"_first.{pos}"), F.col("_seen")) + 1).alias("generated_tokens"))


def top_tokens(candidates: DataFrame, n: int, step: tuple[str, ...] = ("request_id", "pos"),
               logprob: str = "logprob") -> DataFrame:
    """All candidates at or above the n-th highest log-probability of their step; n = 0 gives none.

    ``rank() <= n`` is a group limit Spark applies before the shuffle as well.
    """
    order = Window.partitionBy(*step).orderBy(F.col(logprob).desc())
    return candidates.withColumn("rank", F.rank().over(order)).filter(F.col("rank") <= n)


