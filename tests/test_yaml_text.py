import random

import pytest
from pyspark.sql import functions as F

from promptmill.functions import yaml_text as y

GOLDEN = {
    "plain words": "plain words", "a: b": "'a: b'", "it's": "it's", "'quoted'": "'''quoted'''", "# no": "'# no'", "a #b": "'a #b'", "a#b": "a#b", "": "''", "10": "'10'",
    "1.5": "'1.5'", "true": "'true'", "No": "'No'", "null": "'null'", "- item": "'- item'", "-item": "-item", " lead": "' lead'", "tail ": "'tail '", "2024-01-02": "'2024-01-02'",
    "two\nlines": "'two\n\n  lines'", "é": '"\\xE9"', "日本🙂": '"\\u65E5\\u672C\\U0001F642"', 'say "x"': 'say "x"', "tab\there": '"tab\\there"', "[x]": "'[x]'", "x [y], {z}": "x [y], {z}",
    "ends:": "'ends:'", "a:b": "a:b", "@x": "'@x'", "%": "'%'", "space \nbreak": '"space \\nbreak"', "---": "'---'", "?": "'?'", "0x1F": "'0x1F'", "1e5": "1e5"}


def test_golden_rows():
    for text, want in GOLDEN.items():
        assert y.scalar(text, 3, 2) == want, text
    long = "word " * 30 + "end"
    assert y.block({"k": long}).split("\n")[0] == "k: " + "word " * 15 + "word" and y.block({"k": long}).split("\n")[1].startswith("  word")


def test_against_the_library():
    yaml = pytest.importorskip("yaml")
    r = random.Random(7)
    parts = ["a", "word", "longer-word", " ", " ", "  ", ": ", ":", "#", " #", "-", "- ", "'", '"', "\n", "\n\n", "é", "日", "🙂", "\t", "[", "]", "{", ",", "?", "!", "&", "*", "%", "@", "`", "|", ">", "1", "0", ".", "_",
             "true", "no", "null", "~", "=", "<<", "\\", "\x00", "\x85", "\xa0", "\u2028", "\ufeff", "\r", "1e+5", "12:30", "2001-02-03", "+", "x" * 30]
    for k in range(6000):
        text = "".join(r.choices(parts, k=r.randrange(40 if k % 4 == 0 else 5)))
        record = {"scores": r.randrange(11), "b": {"text": text, "none": None, "yes it": True}, "explanation": text, "f": 1.5}
        assert y.block(record) == yaml.dump(record, default_flow_style=False), repr(text)


def test_column(spark):
    df = spark.createDataFrame([(1, ("a: b", 3)), (2, (None, 4))], "id long, r struct<note:string,a:int>")
    assert [r.t for r in df.orderBy("id").select(y.yaml_block(F.col("r")).alias("t")).collect()] == ["a: 3\nnote: 'a: b'\n", "a: 4\nnote: null\n"]
