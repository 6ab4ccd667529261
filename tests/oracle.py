"""Runs a query on Spark and its oracle on DuckDB and compares columns and rows, order left out."""

from __future__ import annotations

import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
          "conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if v is None or isinstance(v, (int, str)):
        return v
    return str(v)


def normal(v):
    v = plain(v)
    return (v is None, str(float(v)) if isinstance(v, (int, float)) else str(v))


def compare(spark, con, name, fn, sql, sf_dir) -> list[str]:
    """Differences found; empty when the results agree."""
    df = fn(spark, sf_dir)
    cols = sorted(df.columns)
    rel = con.sql(sql)
    theirs = sorted(rel.columns)
    if cols != theirs:
        return [f"{name}: columns {cols} vs {theirs}"]
    got = sorted(tuple(normal(r[c]) for c in cols) for r in df.select(*cols).collect())
    want = sorted(tuple(normal(x) for x in r) for r in rel.project(", ".join(f'"{c}"' for c in cols)).fetchall())
    problems = [] if got else [f"{name}: no rows"]
    if len(got) != len(want):
        problems.append(f"{name}: {len(got)} rows vs {len(want)}")
    for g, w in zip(got, want):
        if g != w:
            bad = [c for c, a, b in zip(cols, g, w) if a != b]
            problems.append(f"{name}: first difference in {bad}:\n  spark  {str(g)[:600]}\n  oracle {str(w)[:600]}")
            break
    return problems
