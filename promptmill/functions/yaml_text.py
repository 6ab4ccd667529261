"""Records as YAML blocks: keys sorted, strings plain where that reads back as the same string, else quoted; long lines folded.

A string is plain if nothing in it is a sign of the format where it stands, single-quoted if it only has to be marked off, and double-quoted if it
holds characters outside of printable ASCII, or blanks next to line ends, which single quotes would lose.
"""

from __future__ import annotations

import json
import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

WIDTH, STEP = 80, 2

# reads as something else than a string
_OTHER = re.compile(r"""(?:yes|Yes|YES|no|No|NO|true|True|TRUE|false|False|FALSE|on|On|ON|off|Off|OFF|~|null|Null|NULL||<<|=
    |[-+]?(?:[0-9][0-9_]*)\.[0-9_]*(?:[eE][-+][0-9]+)?|\.[0-9][0-9_]*(?:[eE][-+][0-9]+)?
    |[-+]?[0-9][0-9_]*(?::[0-5]?[0-9])+\.[0-9_]*|[-+]?\.(?:inf|Inf|INF)|\.(?:nan|NaN|NAN)
    |[-+]?0b[0-1_]+|[-+]?0[0-7_]+|[-+]?(?:0|[1-9][0-9_]*)|[-+]?0x[0-9a-fA-F_]+|[-+]?[1-9][0-9_]*(?::[0-5]?[0-9])+
    |[0-9]{4}-[0-9]{2}-[0-9]{2}
    |[0-9]{4}-[0-9][0-9]?-[0-9][0-9]?(?:[Tt]|[ \t]+)[0-9][0-9]?:[0-9]{2}:[0-9]{2}(?:\.[0-9]*)?(?:[ \t]*(?:Z|[-+][0-9][0-9]?(?::[0-9]{2})?))?)""", re.X)
_MARK = re.compile(r"""---|\.\.\.|[#,\[\]{}&*!|>'"%@`]|[?:-](?=[\0 \t\r\n]|\Z)""")
_INSIDE = re.compile(r"(?s).+?(?::(?=[\0 \t\r\n]|\Z)|(?<=[\0 \t\r\n])#)")
_PRINTABLE = re.compile(r"[\n\x20-\x7e]*")
# One-letter escapes.
_ESCAPES = {"\0": "0", "\x07": "a", "\b": "b", "\t": "t", "\n": "n", "\v": "v", "\f": "f", "\r": "r", "\x1b": "e", '"': '"', "\\": "\\",
            "\x85": "N", "\xa0": "_", "\u2028": "L", "\u2029": "P"}


def style(text: str) -> str:
    """"" for plain, else the quote."""
    if not _PRINTABLE.fullmatch(text) or " \n" in text or "\n " in text:
        return '"'
    marked = "\n" in text or text != text.strip(" ") or _OTHER.fullmatch(text) or _MARK.match(text) or _INSIDE.match(text)
    return "'" if marked else ""


class _Line:
    """Text being written, with the place in the line."""

    def __init__(self, column: int, indent: int):
        self.out, self.column, self.indent = [], column, indent

    def put(self, text: str) -> None:
        self.out.append(text)
        self.column += len(text)

    def fold(self) -> None:
        self.out.append("\n" + " " * self.indent)
        self.column = self.indent


def _plain(line: _Line, text: str) -> None:
    for piece in re.findall(r" +|[^ ]+", text):
        if piece == " " and line.column > WIDTH:
            line.fold()
        else:
            line.put(piece)


def _single(line: _Line, text: str) -> None:
    line.put("'")
    at = 0
    for piece in re.findall(r" +|\n+|[^ \n]+", text):
        end = at + len(piece)
        if piece == " " and line.column > WIDTH and at and end < len(text):
            line.fold()
        elif piece[0] == "\n":
            line.out.append("\n" * len(piece))
            line.fold()
        else:
            line.put(piece.replace("'", "''"))
        at = end
    line.put("'")


def _escape(c: str) -> str:
    if c in _ESCAPES:
        return "\\" + _ESCAPES[c]
    code = ord(c)
    return f"\\x{code:02X}" if code < 256 else f"\\u{code:04X}" if code < 65_536 else f"\\U{code:08X}"


def _double(line: _Line, text: str) -> None:
    line.put('"')
    start = 0
    for end in range(len(text) + 1):
        c = text[end] if end < len(text) else None
        special = c is not None and (c in '"\\' or not " " <= c <= "~")
        if c is None or special:
            if start < end:
                line.put(text[start:end])
                start = end
            if special:
                line.put(_escape(c))
                start = end + 1
        if 0 < end < len(text) - 1 and (c == " " or start >= end) and line.column + (end - start) > WIDTH:
            line.put(text[start:end] + "\\")
            start = max(start, end)
            line.fold()
            if text[start] == " ":
                line.put("\\")
    line.put('"')


def scalar(text: str, column: int, indent: int) -> str:
    """A string that begins at ``column``; folded lines begin at ``indent``."""
    line = _Line(column, indent)
    {"": _plain, "'": _single, '"': _double}[style(text)](line, text)
    return "".join(line.out)


def block(value: dict, indent: int = 0) -> str:
    """A record as ``key: value`` lines, keys sorted, records in it indented."""
    out = []
    for name in sorted(value):
        own, lead = value[name], " " * indent + scalar(name, indent, indent) + ":"
        if isinstance(own, dict):
            out.append(f"{lead}\n{block(own, indent + STEP)}" if own else f"{lead} {{}}\n")
        elif isinstance(own, str):
            out.append(f"{lead} {scalar(own, len(lead) + 1, indent + STEP)}\n")
        else:
            out.append(f"{lead} {'null' if own is None else json.dumps(own)}\n")
    return "".join(out)


@F.pandas_udf(StringType())
def _blocks(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: block(json.loads(t)))


def yaml_block(record: Column | str) -> Column:
    """A struct column as a YAML block."""
    return _blocks(F.to_json(record, {"ignoreNullFields": "false"}))
