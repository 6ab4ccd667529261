"""Registration of queries with their DuckDB oracles, and the SQL pieces the oracles share."""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


# Spark helpers --------------------------------------------------------------------------


def joined(a: Column | str) -> Column:
    c = F.col(a) if isinstance(a, str) else a
    return F.array_join(c.cast("array<string>"), " ")


def digest(a: Column | str) -> Column:
    return F.md5(joined(a))


def variants(df: DataFrame, keep: list[str], cases: dict[str, dict[str, Column]], label: str = "kind") -> DataFrame:
    """One row per named case from a single scan."""
    items = [F.struct(F.lit(n).alias(label), *[c.alias(k) for k, c in cols.items()]) for n, cols in cases.items()]
    return df.select(*keep, F.explode(F.array(*items)).alias("_v")).select(*keep, "_v.*")


def hex_digit(c: Column, k: int, n: int = 1) -> Column:
    return F.conv(F.substring(c, k, n), 16, 10).cast("int")


def r6(c: Column) -> Column:
    return F.round(c, 6)


# SQL helpers ----------------------------------------------------------------------------

WORDS = r"'\p{L}+|\p{N}+|[^\s\p{L}\p{N}]'"
BLANKS_SQL = "chr(32)||chr(9)||chr(10)||chr(13)||chr(12)||chr(11)"


def q(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("'", "''") + "'"


def words(text: str) -> str:
    return f"regexp_extract_all({text}, {WORDS})"


def ids(text: str) -> str:
    return f"list_transform({words(text)}, lambda tk: 16 + ('0x' || substr(md5(tk), 1, 7))::INT)"


def count(text: str) -> str:
    return f"len({words(text)})"


def cat(a: str) -> str:
    return f"coalesce(array_to_string({a}, ' '), '')"


def dig(a: str) -> str:
    return f"md5({cat(a)})"


def rep(value: str | int, n: str) -> str:
    """A list of n equal ints."""
    return f"list_transform(range(greatest(({n})::BIGINT, 0)), lambda zz: {value}::INT)"


def take(a: str, n: str | int) -> str:
    return f"list_slice({a}, 1, {n})"


def trim(text: str) -> str:
    return f"trim({text}, {BLANKS_SQL})"


def rtrim(text: str) -> str:
    return f"rtrim({text}, {BLANKS_SQL})"


def fmt(template: str, fields: dict[str, str] | None = None) -> str:
    """A {field} template as a SQL concatenation."""
    out = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            out.append(q(literal))
        if name:
            out.append(f"({(fields or {}).get(name, name)})::VARCHAR")
    return "(" + (" || ".join(out) or "''") + ")"


def union(source: str, keep: str, cases: dict[str, dict[str, str]], label: str = "kind", ctes: str = "") -> str:
    """UNION ALL of named cases over one source."""
    parts = [f"SELECT {keep}, {q(n)} AS {label}, " + ", ".join(f"{e} AS {k}" for k, e in cols.items()) + f" FROM {source}"
             for n, cols in cases.items()]
    return (f"WITH {ctes} " if ctes else "") + " UNION ALL ".join(parts)


def digit(col: str, k: int, n: int = 1) -> str:
    return f"('0x' || substr({col}, {k}, {n}))::INT"


DOCS = ("d AS (SELECT doc_id, lang, source, text, 'Write a ' || source || ' text in ' || lang || '.' AS instruction, "
        "CASE WHEN lang = 'en' THEN '' ELSE split_part(text, chr(10), 1) END AS input, text AS output, "
        "CASE WHEN lang = 'fr' THEN '' ELSE 'You answer in ' || lang || '.' END AS system, "
        "split_part(text, chr(10), 1) AS head FROM documents)")

CONV = ("c AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS m "
        "FROM conversations GROUP BY conv_id)")

PAIRS = ("p AS (SELECT u.conv_id * 10000000 + u.turn AS pair_id, u.conv_id, coalesce(s.text, '') AS system, u.text AS prompt, "
         "a.text AS chosen, coalesce(r.text, u.text) AS rejected FROM conversations u "
         "JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1 AND a.role = 'assistant' "
         "LEFT JOIN conversations r ON r.conv_id = u.conv_id + 1 AND r.turn = a.turn AND r.role = 'assistant' "
         "LEFT JOIN conversations s ON s.conv_id = u.conv_id AND s.turn = 0 AND s.role = 'system' "
         "WHERE u.role = 'user')")


def fold(rows: str, capacity: int) -> str:
    """Next-fit as a recursion over r(grp, i, key, n): adds block."""
    return (f"WITH RECURSIVE r AS ({rows}), f AS (SELECT grp, i, key, n, 0 AS block, n::BIGINT AS used FROM r WHERE i = 1 "
            "UNION ALL SELECT r.grp, r.i, r.key, r.n, "
            f"CASE WHEN f.used + r.n <= {capacity} THEN f.block ELSE f.block + 1 END, "
            f"CASE WHEN f.used + r.n <= {capacity} THEN f.used + r.n ELSE r.n END "
            "FROM f JOIN r ON r.grp = f.grp AND r.i = f.i + 1)")
