"""Tokenizers as column expressions.

The default tokenizer needs no vocabulary file: words, digit runs and single
other marks, each mapped to an id taken from its md5.  Real vocabularies plug in
through ``plug_in`` as an Arrow function that loads its model once per worker.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.arrays import let
from promptmill.functions.text import col_of

# Ids 0-3 are special, word ids start at 16.
PAD, BOS, EOS, UNKNOWN = 0, 1, 2, 3
FIRST_WORD_ID = 16
IGNORED = -100
WORD_PATTERN = r"\p{L}+|\p{N}+|[^\s\p{L}\p{N}]"
INT_ARRAY = "array<int>"
UNIT = 500_000  # characters a plugged-in tokenizer gets at a time, a tuning value


def no_ids() -> Column:
    return F.array().cast(INT_ARRAY)


def token_texts(text: Column | str) -> Column:
    return F.regexp_extract_all(col_of(text), F.lit(WORD_PATTERN), F.lit(0))


def token_id(token: Column) -> Column:
    return F.conv(F.substring(F.md5(token), 1, 7), 16, 10).cast("int") + F.lit(FIRST_WORD_ID)


def token_ids(text: Column | str, limit: int | Column | None = None) -> Column:
    """Ids of the text, or of its first ``limit`` tokens only."""
    words = token_texts(text)
    return F.transform(words if limit is None else F.slice(words, 1, limit), token_id)


def token_count(text: Column | str) -> Column:
    """Number of tokens without building ids: enough for every length rule."""
    return F.size(token_texts(text))


def encode(text: Column | str, max_len: int | None = None, bos: bool = False, eos: bool = False,
           strip_bos: bool = False, ids: Column | None = None, eos_count: int = 1) -> Column:
    """Truncated ids, closed by EOS where there is room.

    ``bos`` says that the tokenizer itself opens a text with BOS; ``strip_bos``
    removes it again.  Empty text stays empty.  ``eos_count`` marks are appended
    at most, one fewer where the text already ends with EOS.
    """
    def close(words: Column) -> Column:
        cut = words if max_len is None else F.slice(words, 1, max_len - 1 if bos else max_len)
        return F.concat(F.array(F.lit(BOS)), cut) if bos else cut

    def finish(body: Column) -> Column:
        out = body
        if eos:
            room = F.lit(eos_count) - F.when(F.element_at(body, -1) == EOS, 1).otherwise(0)
            if max_len is not None:
                room = F.least(room, F.lit(max_len) - F.size(body))
            out = F.concat(body, F.array_repeat(F.lit(EOS), F.greatest(room, F.lit(0))))
        if bos and strip_bos:
            out = F.slice(out, 2, F.size(body) + eos_count)
        return out

    def whole(words: Column) -> Column:
        return F.when(F.size(words) > 0, let(close(words), finish)).otherwise(no_ids())

    return let(token_ids(text, max_len) if ids is None else ids, whole)


def ignored(n: Column | int) -> Column:
    """``n`` label places that do not train."""
    return F.array_repeat(F.lit(IGNORED), n)


def keep_last(text: Column | str, k: int) -> tuple[Column, Column]:
    """Left truncation: the last ``k`` tokens as ids and as text."""
    tail = let(token_texts(text), lambda w: F.when(F.size(w) > k, F.slice(w, -k, k)).otherwise(w))
    return F.transform(tail, token_id), F.array_join(tail, " ")


def plug_in(load: Callable[[], Callable[[list[str]], list[list[int]]]]) -> Callable[[Column], Column]:
    """A tokenizer of the user's as a column function.

    ``load`` runs once per Python worker and returns a batch encoder.  It gets a
    run of texts of about ``UNIT`` characters at a time, so the ids held as Python
    numbers do not grow with the length of the texts in a batch.
    """

    @F.pandas_udf(INT_ARRAY)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoder = load()
        for texts in batches:
            texts = texts.fillna("")
            unit = texts.str.len().cumsum() // UNIT
            for _, part in texts.groupby(unit.to_numpy()):
                yield pd.Series(encoder(part.tolist()), index=part.index)

    return run
