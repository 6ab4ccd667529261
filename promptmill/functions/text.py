"""Column expressions over text: templates, hashes, score parsing, clean-up."""

from __future__ import annotations

from string import Formatter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: characters the reference's strip() calls remove in ASCII text.
BLANKS = " \t\n\r\f\x0b"


def col_of(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def fill(template: str, fields: dict[str, Column | str] | None = None,
         null_as: str | None = None) -> Column:
    """``template.format(**row)`` as one ``concat`` expression.

    A null field makes the whole result null, so the row can be rejected; give
    ``null_as`` to print another text instead.
    """
    parts: list[Column] = []
    for literal, name, _, _ in Formatter().parse(template):
        if literal:
            parts.append(F.lit(literal))
        if name:
            value = col_of(fields[name] if fields and name in fields else name).cast("string")
            parts.append(value if null_as is None else F.coalesce(value, F.lit(null_as)))
    return F.concat(*parts) if parts else F.lit("")


def template_fields(template: str) -> list[str]:
    return [name for _, name, _, _ in Formatter().parse(template) if name]


def filled(c: Column | str) -> Column:
    """True where a text is there and not empty."""
    return F.coalesce(F.length(col_of(c)) > 0, F.lit(False))


def strip(c: Column | str) -> Column:
    return F.btrim(col_of(c), F.lit(BLANKS))


def rstrip(c: Column | str) -> Column:
    return F.rtrim(col_of(c), F.lit(BLANKS))


def md5_text(c: Column | str) -> Column:
    return F.md5(col_of(c).cast("string"))


def sha256_text(c: Column | str) -> Column:
    return F.sha2(col_of(c).cast("string"), 256)


def parse_score_pair(review: Column | str) -> Column:
    """First line as two numbers, or (-1, -1)."""
    words = F.split(F.replace(F.split(col_of(review), "\n")[0], F.lit(","), F.lit(" ")), " ")
    a, b = words[0].try_cast("double"), F.try_element_at(words, F.lit(2)).try_cast("double")
    good = (F.size(words) == 2) & a.isNotNull() & b.isNotNull()
    return F.when(good, F.array(a, b)).otherwise(F.array(F.lit(-1.0), F.lit(-1.0)))


def parse_class_score(review: Column | str) -> Column:
    """Last line as an integer, or -1."""
    last = strip(F.element_at(F.split(strip(review), "\n"), -1))
    return F.coalesce(F.when(last.rlike(r"^[+-]?[0-9]+$"), last.try_cast("int")), F.lit(-1))


def cut_at(c: Column | str, marker: str) -> Column:
    """The text before the first ``marker``."""
    return F.split_part(col_of(c), F.lit(marker), F.lit(1))


def first_present(df: DataFrame, names: list[str]) -> str:
    """The first of ``names`` that is a column; decided on the schema, not per row."""
    for name in names:
        if name in df.columns:
            return name
    raise ValueError(f"none of {names} is a column; columns are {df.columns}")


def normalise_output(c: Column | str) -> Column:
    """CRLF to LF, then outer newlines off."""
    return F.btrim(F.replace(col_of(c), F.lit("\r\n"), F.lit("\n")), F.lit("\n"))


def remove_input(prediction: Column | str, given: Column | str) -> Column:
    """A decoded prediction without the prompt that leads it, blanks stripped."""
    return strip(F.replace(col_of(prediction), col_of(given), F.lit("")))


def clear_ignored(ids: Column | str, pad_id: int = 0) -> Column:
    """-100 to the pad id, so that a prediction can be decoded."""
    return F.transform(col_of(ids), lambda x: F.when(x == -100, F.lit(pad_id)).otherwise(x))
