"""Filters that return accepted rows, rejects with a reason, and drop reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.text import col_of, filled
from promptmill.functions.tokens import IGNORED, token_count


def length_fits(length: Column, sequence_len: int = 2048, min_len: int = 2) -> Column:
    """A row's length lies in the band; a token count does as well as the size of its ids."""
    return length.between(min_len, sequence_len)


def has_trainable(labels: Column | str) -> Column:
    return F.exists(col_of(labels), lambda x: x != IGNORED)


# Text columns every preference kind needs.
PREFERENCE_KEYS = {"dpo": ("prompt", "chosen", "rejected"), "ipo": ("prompt", "chosen", "rejected"),
                   "orpo": ("prompt", "chosen", "rejected"), "simpo": ("prompt", "chosen", "rejected"),
                   "kto": ("prompt", "completion")}


def preference_keys(kind: str) -> tuple[str, ...]:
    if kind not in PREFERENCE_KEYS:
        raise ValueError(f"unknown preference kind {kind!r}")
    return PREFERENCE_KEYS[kind]


def missing_key(df: DataFrame, kind: str) -> Column:
    """The first empty required text, or null.  A missing column is an error before any job."""
    keys = preference_keys(kind)
    absent = [k for k in keys if k not in df.columns]
    if absent:
        raise ValueError(f"columns {absent} are required for {kind}")
    return F.coalesce(*[F.when(~filled(k), F.lit(k)) for k in keys])


def preference_fits(kind: str, sequence_len: int) -> Column:
    """Prompt with either answer (or with the completion) fits, in tokens."""
    prompt, *answers = preference_keys(kind)
    longest = token_count(answers[0]) if len(answers) == 1 else F.greatest(*[token_count(a) for a in answers])
    return token_count(prompt) + longest <= sequence_len


def characters_fit(limit: int) -> Column:
    return (F.length("prompt") + F.length("chosen") <= limit) & (F.length("prompt") + F.length("rejected") <= limit)


def joined_tokens_fit(columns: list[str], limit: int) -> Column:
    return token_count(F.concat(*columns)) <= limit


def both_fit(a: Column | str, b: Column | str, limit: int) -> Column:
    return (F.size(col_of(a)) <= limit) & (F.size(col_of(b)) <= limit)


def example_fits(text: Column | str, limit: int) -> Column:
    return token_count(text) <= limit


def choice_answer(labels: Column | str, choice_ids: list[int]) -> Column:
    """The token before the closing EOS is one of the choices."""
    return F.coalesce(F.try_element_at(col_of(labels), F.lit(-2)).isin(*choice_ids), F.lit(False))


# Default limits of request validation.
REQUEST_LIMITS = {"max_best_of": 2, "max_stop_sequences": 4, "max_top_n_tokens": 5,
                  "max_input_length": 1024, "max_total_tokens": 2048}


def request_reason(limits: dict | None = None, known_length: bool = True) -> Column:
    """The first rule a generation request breaks, or null.

    Reads best_of, do_sample, temperature, repetition_penalty, top_k, top_p, typical_p,
    max_new_tokens, stop, truncate, seed, top_n_tokens, inputs and, where the input's
    token count is known, input_length.
    """
    c, m = F.col, {**REQUEST_LIMITS, **(limits or {})}
    best_of = F.coalesce(c("best_of"), F.lit(1))
    sampling = (F.coalesce(c("do_sample"), F.lit(False)) | c("temperature").isNotNull() | c("top_k").isNotNull()
                | c("top_p").isNotNull() | c("typical_p").isNotNull())
    total, longest = F.lit(m["max_total_tokens"]), F.lit(m["max_input_length"])
    rules = [
        ("best_of", (best_of < 1) | (best_of > m["max_best_of"])),
        ("best_of_sampling", (best_of > 1) & ~sampling),
        ("temperature", F.coalesce(c("temperature"), F.lit(1.0)) <= 0),
        ("repetition_penalty", F.coalesce(c("repetition_penalty"), F.lit(1.0)) <= 0),
        ("top_p", (c("top_p") <= 0) | (c("top_p") >= 1)),
        ("typical_p", (c("typical_p") <= 0) | (c("typical_p") >= 1)),
        ("top_k", c("top_k") <= 0),
        ("max_new_tokens", c("max_new_tokens") <= 0),
        ("stop_sequences", F.size(F.coalesce(c("stop"), F.array().cast("array<string>"))) > m["max_stop_sequences"]),
        ("best_of_seed", (best_of > 1) & c("seed").isNotNull()),
        ("top_n_tokens", c("top_n_tokens") > m["max_top_n_tokens"]),
        ("empty_input", ~filled("inputs")),
        ("truncate", (c("truncate") <= 0) | (c("truncate") > longest)),
    ]
    if known_length:
        cut = F.least(c("input_length"), F.coalesce(c("truncate"), c("input_length")))
        new = F.coalesce(c("max_new_tokens"), F.greatest(total - cut, F.lit(0)))
        rules += [("total_tokens", cut + new > total), ("input_length", cut > longest)]
    else:
        given = F.coalesce(c("truncate"), longest)
        new = F.coalesce(c("max_new_tokens"), F.when(c("truncate").isNotNull(), F.greatest(total - c("truncate"), F.lit(0))))
        rules += [("unset_max_new_tokens", new.isNull()), ("total_tokens", given + new > total)]
    return F.coalesce(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules])


def drop_report(df: DataFrame, rules: dict[str, Column], by: str | None = "source") -> DataFrame:
    """Rows before, dropped by each filter in turn, and after; one aggregate for all filters."""
    kept = F.lit(True)
    aggs = [F.count(F.lit(1)).alias("before")]
    for name, rule in rules.items():
        ok = F.coalesce(rule, F.lit(False))
        aggs.append(F.count(F.when(kept & ~ok, 1)).alias(f"dropped_{name}"))
        kept = kept & ok
    aggs.append(F.count(F.when(kept, 1)).alias("after"))
    return (df.groupBy(by) if by else df.groupBy()).agg(*aggs)
