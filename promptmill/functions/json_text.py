"""JSON texts written anew with a given spacing, as column expressions; key order, numbers and escapes stay as they are."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from promptmill.functions.arrays import let, running_starts
from promptmill.functions.text import col_of

# a string, an empty container, a sign, or another scalar
_TOKEN = r'"(?:[^"\\]|\\.)*"|\{\s*\}|\[\s*\]|[{}\[\],:]|[^\s{}\[\],:"]+'


def spaced_json(text: Column | str, indent: int | None = None) -> Column:
    """``{"a": 1, "b": [2, 3]}``, or one entry a line with ``indent`` more spaces a level; null stays null."""
    t = col_of(text)

    def compact(tokens: Column) -> Column:
        return F.array_join(F.transform(tokens, lambda x: F.when(x.isin(",", ":"), F.concat(x, F.lit(" "))).otherwise(
            F.when(x.rlike(r"^[{\[]\s*[}\]]$"), F.regexp_replace(x, r"\s+", "")).otherwise(x))), "")

    def lines(tokens: Column) -> Column:
        depth = running_starts(F.transform(tokens, lambda x: F.when(x.isin("{", "["), 1).when(x.isin("}", "]"), -1).otherwise(0)))

        def one(x: Column, d: Column) -> Column:
            def line(level: Column) -> Column:
                return F.concat(F.lit("\n"), F.repeat(F.lit(" " * indent), level))
            return (F.when(x.isin("{", "["), F.concat(x, line(d + 1))).when(x.isin("}", "]"), F.concat(line(d - 1), x))
                    .when(x == ",", F.concat(x, line(d))).when(x == ":", ": ")
                    .when(x.rlike(r"^[{\[]\s*[}\]]$"), F.regexp_replace(x, r"\s+", "")).otherwise(x))

        return let(depth, lambda ds: F.array_join(F.transform(tokens, lambda x, i: one(x, F.get(ds, i))), ""))

    return F.when(t.isNotNull(), let(F.regexp_extract_all(t, F.lit(_TOKEN), F.lit(0)), compact if indent is None else lines))


def json_string(text: Column | str) -> Column:
    """The text as a JSON string, quoted and escaped; null stays null."""
    t = col_of(text)
    whole = F.to_json(F.struct(t.alias("x")))
    return F.when(t.isNotNull(), F.substring(whole, F.lit(6), F.length(whole) - 6))
