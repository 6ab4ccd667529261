import json
import random

from pyspark.sql import functions as F

from promptmill.functions.json_text import spaced_json
from promptmill.operators import chat

TOOL = {"type": "function", "function": {"name": "weather", "parameters": {"type": "object", "properties": {"city": {"type": "string", "enum": ["a, b", "c: {d}"]}}, "required": [], "x": {}}}}
RESPONSE = '{"t": 4, "é": "\\n"}'
SCHEMA = "id long, messages array<struct<role:string,content:string,tool_calls:array<struct<name:string,arguments:string>>>>, tools array<string>"


def some(r, depth=0):
    kind = r.randrange(7 if depth < 4 else 4)
    if kind < 4:
        return [r.choice(["", "a\"b", "c\\", "{,}:[", "é🙂", "\n"]), r.randrange(99), r.choice([True, None]), 1.5e-7][kind]
    if kind == 4:
        return [some(r, depth + 1) for _ in range(r.randrange(4))]
    return {r.choice("abc,:{") + str(k): some(r, depth + 1) for k in range(r.randrange(4))}


def test_spacing_equals_the_json_module(spark):
    r = random.Random(3)
    values = [some(r) for _ in range(200)] + [TOOL, {}, [], [[]], {"a": {}}]
    forms = [{}, {"indent": 1}, {"separators": (",", ":")}, {"indent": "\t"}]
    rows = [(k, json.dumps(v, ensure_ascii=False, **forms[k % 4])) for k, v in enumerate(values)]
    df = spark.createDataFrame([*rows, (-1, None)], "id long, t string").repartition(4)
    for got in df.select("id", spaced_json("t").alias("c"), spaced_json("t", 2).alias("two"), spaced_json("t", 4).alias("four")).collect():
        if got.id < 0:
            assert got.c is None and got.two is None
            continue
        v = values[got.id]
        assert got.c == json.dumps(v, ensure_ascii=False)
        assert got.two == json.dumps(v, ensure_ascii=False, indent=2) and got.four == json.dumps(v, ensure_ascii=False, indent=4)


def rendered(spark, column, messages, tools):
    rows = [(1, [(m[0], m[1], m[2] if len(m) > 2 else None) for m in messages], tools)]
    return spark.createDataFrame(rows, SCHEMA).select(column.alias("t")).first().t


def test_qwen_tools(spark):
    talk = [("user", "hi"), ("assistant", "", [("weather", '{"city":"a"}'), ("time", "{}")]), ("tool", "4 C"), ("tool", "noon"), ("assistant", "cold"),
            ("system", "late"), ("assistant", "let me see", [("weather", '{"city": "b"}')]), ("tool", "5 C")]
    listed = "\n" + json.dumps(TOOL) + "\n" + '{"name": "t"}'
    body = ("<|im_start|>user\nhi<|im_end|>\n<|im_start|>assistant\n<tool_call>\n{\"name\": \"weather\", \"arguments\": {\"city\": \"a\"}}\n</tool_call>"
            "\n<tool_call>\n{\"name\": \"time\", \"arguments\": {}}\n</tool_call><|im_end|>\n<|im_start|>user\n<tool_response>\n4 C\n</tool_response>"
            "\n<tool_response>\nnoon\n</tool_response><|im_end|>\n<|im_start|>assistant\ncold<|im_end|>\n<|im_start|>system\nlate<|im_end|>\n"
            "<|im_start|>assistant\nlet me see\n<tool_call>\n{\"name\": \"weather\", \"arguments\": {\"city\": \"b\"}}\n</tool_call><|im_end|>\n"
            "<|im_start|>user\n<tool_response>\n5 C\n</tool_response><|im_end|>\n")
    default = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."
    column = chat.render_qwen_tools("messages", "tools", True)
    assert rendered(spark, column, talk, [json.dumps(TOOL, separators=(",", ":")), '{ "name" : "t" }']) == (
        f"<|im_start|>system\n{default}{chat.QWEN_TOOLS[0]}{listed}{chat.QWEN_TOOLS[1]}{body}<|im_start|>assistant\n")
    for none in (None, []):
        assert rendered(spark, column, [("system", "Be."), *talk], none) == f"<|im_start|>system\nBe.<|im_end|>\n{body}<|im_start|>assistant\n"
    plain = [("system", "s"), ("user", "u"), ("assistant", "a")]
    df = spark.createDataFrame([(1, [(r, c, None) for r, c in plain], None)], SCHEMA)
    row = df.select(chat.render_qwen_tools("messages", "tools").alias("a"), chat.render_chat("messages", "qwen_25").alias("b")).first()
    assert row.a == row.b


def test_header_tools(spark):
    talk = [("system", " Be kind. "), ("user", " hi "), ("assistant", None, [("weather", '{"city":"a"}')]), ("ipython", RESPONSE), ("assistant", "cold")]
    listed = json.dumps(TOOL, indent=4) + "\n\n"
    opening = "<s><|start_header_id|>system<|end_header_id|>\n\nEnvironment: ipython\nCutting Knowledge Date: December 2023\nToday Date: 26 Jul 2024\n\n"
    rest = ("<|start_header_id|>assistant<|end_header_id|>\n\n{\"name\": \"weather\", \"parameters\": {\"city\": \"a\"}}<|eot_id|>"
            f"<|start_header_id|>ipython<|end_header_id|>\n\n{json.dumps(RESPONSE, ensure_ascii=False)}<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\ncold<|eot_id|>")
    tools = [json.dumps(TOOL)]
    assert rendered(spark, chat.render_header_tools("messages", "tools"), talk, tools) == (
        f"{opening}Be kind.<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n{chat.HEADER_TOOLS}{listed}hi<|eot_id|>{rest}")
    assert rendered(spark, chat.render_header_tools("messages", "tools", in_user_message=False), talk, tools) == (
        f"{opening}{chat.HEADER_TOOLS_IN_SYSTEM}{listed}Be kind.<|eot_id|><|start_header_id|>user<|end_header_id|>\n\n hi <|eot_id|>{rest}")
    assert rendered(spark, chat.render_header_tools("messages", "tools"), [("user", "u"), ("assistant", "", [("a", "{}"), ("b", "{}")])], tools) is None
    assert rendered(spark, chat.render_header_tools("messages", "tools"), [("system", "only")], tools) is None
    df = spark.createDataFrame([(1, [(r, c, None) for r, c in (("user", "u"), ("assistant", "a"))], None)], SCHEMA)
    row = df.select(chat.render_header_tools("messages", "tools", True).alias("a"), chat.render_chat("messages", "llama3_2_vision", True).alias("b"), F.lit(1)).first()
    assert row.a == row.b
