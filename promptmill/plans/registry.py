"""Named strategies and whole pipelines made of the operators."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import once
from promptmill.functions.text import fill
from promptmill.operators import chat, dedup, labels, pack, template
from promptmill.operators.evaluate import outputs_with_cases, test_case_score
from promptmill.operators.order import shuffled_ordinal
from promptmill.operators.split import repeated
from promptmill.session import materialise

Strategy = Callable[[DataFrame, dict], DataFrame]
STRATEGIES: dict[str, Strategy] = {}
TOKENIZED = ("input_ids", "attention_mask", "labels")


def strategy(name: str):
    def add(fn: Strategy) -> Strategy:
        if name in STRATEGIES:
            raise ValueError(f"strategy {name!r} already exists")
        STRATEGIES[name] = fn
        return fn
    return add


def is_tokenized(df: DataFrame) -> bool:
    return set(TOKENIZED) <= set(df.columns)


def apply_strategy(df: DataFrame, kind: str | dict, config: dict | None = None) -> DataFrame:
    """The transform a dataset's ``type`` names.

    Already tokenized tables pass through; a dict is a user-defined format; an
    unknown name is an error that lists what there is.
    """
    c = config or {}
    if is_tokenized(df):
        return df
    if isinstance(kind, dict):
        return STRATEGIES["user_defined"](df, {**c, "type": kind})
    name = kind if kind in STRATEGIES else f"{kind}.load"
    if name not in STRATEGIES:
        hint = "; use completion for plain text" if "completion" in kind else ""
        raise ValueError(f"unhandled prompt tokenization strategy: {kind}{hint}; known: {sorted(STRATEGIES)}")
    return STRATEGIES[name](df, c)


def _tokenize(df: DataFrame, prompt: Column, answer: Column, c: dict, eos_count: int = 1) -> DataFrame:
    row = labels.prompt_masked(prompt, answer, c.get("sequence_len"), c.get("bos", False),
                               c.get("train_on_inputs", False), eos_count)
    return labels.with_encoded(df, row)


def _instruction(mapped, prompter: str, style: str | None = None, eos_count: int = 1) -> Strategy:
    """A strategy of a field mapper and a prompter."""
    def run(df: DataFrame, c: dict) -> DataFrame:
        cols = mapped(df)
        keep = [k for k in c.get("keep", []) if k in df.columns]
        rows = df.select(*keep, *[x.alias(n) for x, n in zip(cols, ("instruction", "input", "output"))])
        prompt = template.instruction_prompt(prompter=prompter, style=style or c.get("conversation", "instruct"))
        return _tokenize(rows, prompt, F.col("output"), c, eos_count).select(*keep, *TOKENIZED)
    return run


def _pair(kind: str):
    return lambda df: template.map_pair(kind)


for _name, _mapper, _prompter, _style in [
    ("alpaca.load", template.map_instruction, "alpaca", None),
    ("alpaca_chat.load", template.map_instruction, "alpaca", "chat"),
    ("alpaca_chat.load_concise", template.map_instruction, "concise", "chat"),
    ("alpaca_chat.load_no_prompt", template.map_instruction, "unprompted", "chat"),
    ("alpaca_chat.load_qa", _pair("alpaca_qa"), "chat", None),
    ("alpaca_chat.load_camel_ai", _pair("camel_ai"), "chat", None),
    ("alpaca_instruct.load", template.map_instruction, "alpaca", "instruct"),
    ("alpaca_instruct.load_no_prompt", template.map_instruction, "unprompted", "instruct"),
    ("gpteacher.load", lambda df: template.map_instruction(df, "response"), "alpaca", None),
    ("oasst.load", _pair("oasst"), "alpaca", None),
    ("gpt4all.load", _pair("gpt4all"), "alpaca", None),
    ("summarizetldr.load", _pair("summarizetldr"), "summarize", None),
    ("jeopardy.load", lambda df: template.map_quiz(), "alpaca", None),
    ("explainchoice.load", template.map_multiple_choice, "choice_explain", None),
    ("concisechoice.load", template.map_multiple_choice, "choice_concise", None),
    ("context_qa.load", lambda df: template.map_context_qa("v1"), "context", None),
    ("context_qa.load_v2", lambda df: template.map_context_qa("v2"), "context_v2", None),
    ("context_qa.load_404", lambda df: template.map_context_qa("unanswerable"), "context", None),
]:
    STRATEGIES[_name] = _instruction(_mapper, _prompter, _style)
STRATEGIES["metharme.load"] = _instruction(_pair("metharme"), "metharme", None, eos_count=3)


def _with_system(family: str, style: str) -> Strategy:
    def run(df: DataFrame, c: dict) -> DataFrame:
        rows = df if family == "system" else df.select(
            *c.get("keep", []), *template.map_system_pair())
        prompt = template.system_prompt(input="input" if "input" in rows.columns else None, family=family, style=style)
        return _tokenize(rows, prompt, F.col("output"), c).select(*c.get("keep", []), *TOKENIZED)
    return run


for _style in ("instruct", "chat", "chatml"):
    STRATEGIES[f"alpaca_w_system.load_{_style}"] = _with_system("system", _style)
    STRATEGIES[f"alpaca_w_system.load_open_orca_{_style}"] = _with_system("context", _style)
STRATEGIES["alpaca_w_system.load"] = STRATEGIES["alpaca_w_system.load_chat"]
STRATEGIES["alpaca_w_system.load_open_orca"] = STRATEGIES["alpaca_w_system.load_open_orca_instruct"]


@strategy("orcamini.load")
def _orca_mini(df: DataFrame, c: dict) -> DataFrame:
    rows = df.select(*c.get("keep", []), *template.map_system_pair())
    return _tokenize(rows, template.orca_mini_prompt(), F.col("output"), c).select(*c.get("keep", []), *TOKENIZED)


def _critique(kind: str) -> Strategy:
    def run(df: DataFrame, c: dict) -> DataFrame:
        rows = df.select(*c.get("keep", []), *template.map_critique(df, kind))
        return _tokenize(rows, F.col("prompt"), F.col("output"), c).select(*c.get("keep", []), *TOKENIZED)
    return run


for _kind in ("answer", "critique", "revise"):
    STRATEGIES[f"creative_acr.load_{_kind}"] = _critique(_kind)


@strategy("reflection.load")
def _reflection(df: DataFrame, c: dict) -> DataFrame:
    row = labels.whole_text_masked(template.reflection_prompt(), template.reflection_prompt(with_answer=False),
                                   c.get("sequence_len"), c.get("train_on_inputs", False))
    return labels.with_encoded(df, row).select(*c.get("keep", []), *TOKENIZED)


@strategy("user_defined")
def _user_defined(df: DataFrame, c: dict) -> DataFrame:
    rows = template.user_defined(df, c["type"])
    return _tokenize(rows, F.col("prompt"), F.col("response"), c).select(*c.get("keep", []), *TOKENIZED)


@strategy("completion.load")
def _completion(df: DataFrame, c: dict) -> DataFrame:
    rows = once(df.select(*c.get("keep", []), F.col(c.get("field", "text")).alias("_text")),
                input_ids=tk.encode("_text", eos=True)).drop("_text")
    flat = labels.explode_windows(rows, labels.chunks("input_ids", c["sequence_len"]))
    return labels.with_encoded(flat, labels.encoded(F.col("input_ids"), F.col("input_ids")))


@strategy("pretrain.load")
def _pretrain(df: DataFrame, c: dict) -> DataFrame:
    rows = once(df.select(*c.get("keep", []), F.col(c.get("field", "text")).alias("_text")),
                input_ids=tk.token_ids("_text")).drop("_text")
    flat = labels.explode_windows(rows, labels.strided_windows("input_ids", c["sequence_len"], c.get("stride", 256)))
    return labels.with_encoded(flat, labels.encoded(F.col("input_ids"), F.col("input_ids")))


@strategy("chat_template.load")
def _chat(df: DataFrame, c: dict) -> DataFrame:
    """Conversations with an unknown role are left out; ``rejected_rows`` gives them with the reason."""
    df = df.filter(~chat.unknown_roles(c.get("field_messages", "messages")))
    turns = chat.conversation_thread(c.get("field_messages", "messages"), c.get("drop_system_message", False))
    row = labels.turn_masked(turns, roles_to_train=tuple(c.get("roles_to_train", ["assistant"])),
                             train_on_inputs=c.get("train_on_inputs", False), train_on_eos=c.get("train_on_eos", "turn"))
    return labels.with_encoded(df, row).select(*c.get("keep", []), *TOKENIZED)


@strategy("input_output.load")
def _input_output(df: DataFrame, c: dict) -> DataFrame:
    return labels.with_encoded(df, labels.raw_segments("segments", c.get("train_on_inputs", False))).select(
        *c.get("keep", []), *TOKENIZED)


@strategy("llama2_chat.load")
def _inst(df: DataFrame, c: dict) -> DataFrame:
    df = df.filter(chat.inst_turns("messages").isNotNull())
    return labels.with_encoded(df, labels.inst_encoded(chat.inst_segments("messages"), c["sequence_len"])).select(
        *c.get("keep", []), *TOKENIZED)


@strategy("pygmalion.load")
def _persona(df: DataFrame, c: dict) -> DataFrame:
    return labels.with_encoded(df, labels.persona_encoded(chat.persona_segments("messages"))).select(
        *c.get("keep", []), *TOKENIZED)


def _preference(shape: str, markup: str) -> Strategy:
    return lambda df, c: df.select(*c.get("keep", []), *template.preference_pair(df, shape, markup))


def _unpaired(shape: str, markup: str) -> Strategy:
    return lambda df, c: df.select(*c.get("keep", []), *template.unpaired_preference(df, shape, markup))


for _markup in ("chatml", "llama3"):
    for _shape in (*template.PAIR_SHAPES, "argilla_chat", "ultra"):
        STRATEGIES[f"dpo.{_markup}.{_shape}"] = _preference(_shape, _markup)
    for _shape in (*template.UNPAIRED_SHAPES, "argilla_chat"):
        STRATEGIES[f"kto.{_markup}.{_shape}"] = _unpaired(_shape, _markup)
STRATEGIES["dpo.zephyr.nectar"] = lambda df, c: df.select(*c.get("keep", []), *template.ranked_pair())
STRATEGIES["dpo.user_defined.default"] = lambda df, c: df.select(*c.get("keep", []), *template.user_defined_pair(df, c["type"]))
STRATEGIES["kto.user_defined.default"] = lambda df, c: df.select(
    *c.get("keep", []), *template.user_defined_unpaired(df, c["type"]))
STRATEGIES["bradley_terry.llama3.icr"] = lambda df, c: df.select(*c.get("keep", []), *template.reward_pair(df))


def _said(df: DataFrame, field: str) -> Column:
    """Text of an answer given as text or as a message."""
    return F.col(f"{field}.content") if df.schema[field].dataType.typeName() == "struct" else F.col(field)


@strategy("dpo.chat_template.default")
def _preference_chat(df: DataFrame, c: dict) -> DataFrame:
    name = c.get("chat_template", "chatml")
    prompt = chat.render_chat(c.get("field_messages", "messages"), name, add_generation_prompt=True)
    answers = [chat.answer_text(_said(df, c.get(f"field_{k}", k)), name).alias(k) for k in ("chosen", "rejected")]
    return df.select(*c.get("keep", []), prompt.alias("prompt"), *answers)


@strategy("orpo.chat_template.argilla")
def _odds_ratio_text(df: DataFrame, c: dict) -> DataFrame:
    """Prompt and both answers as text; conversations of an odd number of turns have no last answer and are left out."""
    texts = template.odds_ratio_format(df, c.get("chat_template", "chatml"))
    return df.filter(F.size("chosen") % 2 == 0).select(*c.get("keep", []), *texts)


@strategy("orpo.chat_template.load")
def _odds_ratio(df: DataFrame, c: dict) -> DataFrame:
    return labels.odds_ratio_pair(_odds_ratio_text(df, c), "prompt", "chosen", "rejected").drop("prompt", "chosen", "rejected")


@strategy("bradley_terry.chat_template.load")
def _reward_chat(df: DataFrame, c: dict) -> DataFrame:
    rows = _preference_chat(df, c)
    return labels.reward_pair_encoded(rows, F.concat("prompt", "chosen"), F.concat("prompt", "rejected"), c["sequence_len"]).drop(
        "prompt", "chosen", "rejected")


@strategy("messages.chat.load")
def _weighted_chat(df: DataFrame, c: dict) -> DataFrame:
    field = c.get("field_messages", "messages")
    messages = chat.weighted_messages(field, c.get("message_field_role", "role"), c.get("message_field_content", "content"),
                                      c.get("message_field_training"), c.get("train_on_inputs", False))
    known = df.filter(~chat.unknown_roles(field, chat.WEIGHTED_ROLES))
    return labels.with_encoded(known, labels.weighted_labels(chat.weighted_segments(messages, c.get("chat_template", "chatml")))).select(
        *c.get("keep", []), *TOKENIZED)


def rejected_rows(df: DataFrame, kind: str, config: dict | None = None) -> DataFrame:
    """The ``keep`` columns and a reason for each row that a chat strategy leaves out."""
    c = config or {}
    field = c.get("field_messages", "messages")
    name = kind if kind in STRATEGIES else f"{kind}.load"
    reasons = {
        "chat_template.load": F.when(chat.unknown_roles(field), "unknown role"),
        "messages.chat.load": F.when(chat.unknown_roles(field, chat.WEIGHTED_ROLES), "unknown role"),
        "llama2_chat.load": F.when(chat.inst_turns(field).isNull(), "roles do not alternate"),
    } if field in df.columns else {}
    if name not in reasons:
        return df.limit(0).select(*c.get("keep", []), F.lit(None).cast("string").alias("reason"))
    return df.select(*c.get("keep", []), reasons[name].alias("reason")).filter("reason is not null")


# Model calls ----------------------------------------------------------------------------


def call_model(df: DataFrame, key: str, prompt: str, load_client: Callable[[], Callable[[list[str]], list[str]]],
               out: str = "prediction", retries: int = 3, wait_seconds: float = 0.0, batch: int = 100,
               status: str | None = None) -> DataFrame:
    """(key, ``out``): the user's model run over prompts in batches, one client per task.

    A batch that still fails after ``retries`` gives the text ``error``; with ``status`` a column of that name says
    ok or the error's type, and failed rows have no text.  Save the result before using it twice, or a recomputed
    task calls the model again.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = load_client()

        def ask(texts: list[str]) -> tuple[list, str]:
            failed = "none"
            for attempt in range(retries):
                try:
                    return client(texts), "ok"
                except Exception as e:
                    failed = type(e).__name__
                    time.sleep(wait_seconds * (attempt + 1))
            return [None if status else "error"] * len(texts), failed

        for frame in frames:
            for i in range(0, len(frame), batch):
                part = frame.iloc[i:i + batch]
                answers, how = ask(part[prompt].tolist())
                yield pd.DataFrame({key: part[key], out: answers, **({status: how} if status else {})})

    extra = f", {status} string" if status else ""
    return df.select(key, prompt).mapInPandas(run, f"{key} {df.schema[key].dataType.simpleString()}, {out} string{extra}")


def refine(requests: DataFrame, cases: DataFrame, key: str, feedback_client, code_client, run_client,
           tries: int = 1) -> DataFrame:
    """Score per request and try: feedback, correction prompt, refined program, its outputs, test-case score.

    Model results are written to the shared scratch folder between the calls.
    """
    tried = repeated(requests, tries).withColumn("program_id", F.concat_ws("-", key, "try"))
    feedback = materialise(call_model(tried, "program_id", "model_input", feedback_client), "feedback")
    second = template.correction_prompt(tried, feedback, "program_id")
    programs = materialise(call_model(second, "program_id", "model_input", code_client, "program"), "programs")
    todo = tried.select("program_id", "problem_id").join(programs, "program_id").join(cases, "problem_id")
    todo = todo.withColumn("case_key", F.concat_ws("/", "program_id", "case_no")).withColumn(
        "call", F.concat("program", F.lit("\n"), "input"))
    ran = materialise(call_model(todo, "case_key", "call", run_client, "output"), "outputs")
    outputs = todo.select("case_key", "program_id", "problem_id", "case_no").join(ran, "case_key").drop("case_key")
    scores = test_case_score(outputs_with_cases(outputs, cases))
    return tried.select("program_id", key, "try").join(scores, "program_id").drop("program_id")


# The headline pipeline ------------------------------------------------------------------


def instruction_rows(docs: DataFrame) -> DataFrame:
    """Documents as instruction rows: a task line, the first line as input, the text as output."""
    return docs.select(
        "doc_id", "lang", "source",
        F.concat(F.lit("Write a "), "source", F.lit(" text in "), "lang", F.lit(".")).alias("instruction"),
        F.when(F.col("lang") == "en", "").otherwise(F.substring_index("text", "\n", 1)).alias("input"),
        F.col("text").alias("output"))


def prepare_and_pack(docs: DataFrame, capacity: int = 2048, seed: int = 42) -> DataFrame:
    """Rows, tokens, bins and efficiency per language of a packed supervised table.

    Lengths are all that packing needs, so ids are never built here.  The text is read
    once, for its hash and token counts; equal rows combine before the shuffle; what is
    left, a few numbers per row, is written out and packed.
    """
    rows = instruction_rows(docs)
    prompt = fill("{instruction}\n{input}\n")
    counted = rows.select(
        "doc_id", "lang", dedup.row_hash("instruction", "input", "output").alias("hash"),
        tk.token_count(prompt).alias("n_prompt"), (tk.token_count("output") + 1).alias("n_answer"))
    # the length band reads aggregated values, so it is not evaluated again below the aggregate
    first = counted.groupBy("hash").agg(F.min(F.struct("doc_id", "lang", "n_prompt", "n_answer")).alias("r")).select(
        "r.doc_id", "r.lang", (F.col("r.n_prompt") + F.col("r.n_answer")).alias("n"), "r.n_answer")
    fitting = materialise(first.filter(F.col("n").between(2, capacity) & (F.col("n_answer") > 1)), "lengths")
    bins = pack.next_fit(shuffled_ordinal(fitting, seed, "doc_id"), "doc_id", "n", capacity, carry=("lang", "n_answer"))
    per_bin = bins.groupBy("lang", "block").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("tokens"), F.sum("n_answer").alias("trained"))
    return per_bin.groupBy("lang").agg(
        F.sum("rows").alias("rows"), F.sum("tokens").alias("tokens"), F.sum("trained").alias("trained_tokens"),
        F.count(F.lit(1)).alias("bins_touched"),
        F.round(F.sum("tokens") / (F.count(F.lit(1)) * capacity), 6).alias("share_of_bins"))
