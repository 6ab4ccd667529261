"""Hand-made cases: golden values, nulls, empties and refusals."""

import math

import pytest
from pyspark.sql import functions as F

from promptmill.functions import text as tx, tokens as tk
from promptmill.functions.arrays import running_starts
from promptmill.operators import chat, evaluate as ev, filters, labels as lb, pack, template as tp
from promptmill.plans import registry
from promptmill.sources import io


def one(spark, column, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(column.alias("x")).first()[0]


@pytest.mark.parametrize("review,want", [("8 9", [8, 9]), ("8,9", [8, 9]), ("8", [-1, -1]), ("a b", [-1, -1]), ("7.5 8\nwhy", [7.5, 8])])
def test_score_pair(spark, review, want):
    assert one(spark, tx.parse_score_pair("r"), r=review) == want


@pytest.mark.parametrize("review,want", [("because\n2", 2), ("x\n 3 \n", 3), ("none", -1), ("1\ntwo", -1)])
def test_class_score(spark, review, want):
    assert one(spark, tx.parse_class_score("r"), r=review) == want


def stop(spark, tokens, **kw):
    log = spark.createDataFrame([(1, i, t, x) for i, (t, x) in enumerate(tokens)], "request_id long, pos int, id int, text string")
    return tuple(lb.stop_rule(log, **kw).first())[1:]


def test_stop_rule(spark):
    # at the end of the running output only
    assert stop(spark, [(9, "/"), (9, "test"), (9, ";"), (9, " ")], stops=("/test;",), max_new_tokens=9) == ("stop_sequence", 3)
    assert stop(spark, [(9, "/"), (9, "test"), (9, "; ")], stops=("/test;",), max_new_tokens=9) == (None, 3)
    assert stop(spark, [(9, "a")] * 5, stops=("/test;",), max_new_tokens=5) == ("length", 5)
    assert stop(spark, [(1, ""), (0, "")], eos_id=0, max_new_tokens=9) == ("eos_token", 2)
    # length is tested before EOS, tokens past the limit do not matter
    assert stop(spark, [(1, ""), (0, ""), (0, "")], eos_id=0, max_new_tokens=2) == ("length", 2)
    assert stop(spark, [(1, ""), (0, ""), (1, "")], eos_id=0, max_new_tokens=9, ignore_eos=True) == (None, 3)


@pytest.mark.parametrize("n,size", [(0, 0), (2, 4), (3, 4), (4, 4), (5, 5)])
def test_top_tokens_keeps_ties(spark, n, size):
    c = spark.createDataFrame([(1, 0, i, float(v)) for i, v in enumerate([-1, -3, -4, -2, -3])], "request_id int, pos int, id int, logprob double")
    want = {0: 0, 2: 2, 3: 4, 4: 4, 5: 5}[n]
    assert lb.top_tokens(c, n).count() == want


REQUEST = {"best_of": None, "do_sample": False, "temperature": None, "repetition_penalty": None, "top_k": None, "top_p": None,
           "typical_p": None, "max_new_tokens": 10, "stop": [], "seed": None, "top_n_tokens": None, "inputs": "hi", "truncate": None,
           "input_length": 3}
REQUEST_SCHEMA = ("best_of int, do_sample boolean, temperature double, repetition_penalty double, top_k int, top_p double, typical_p double, "
                  "max_new_tokens int, stop array<string>, seed long, top_n_tokens int, inputs string, truncate int, input_length int")


@pytest.mark.parametrize("change,want", [
    ({}, None), ({"best_of": 0}, "best_of"), ({"best_of": 2}, "best_of_sampling"), ({"best_of": 2, "do_sample": True}, None),
    ({"best_of": 2, "do_sample": True, "seed": 1}, "best_of_seed"), ({"temperature": 0.0}, "temperature"),
    ({"repetition_penalty": 0.0}, "repetition_penalty"), ({"top_p": 1.0}, "top_p"), ({"typical_p": 0.0}, "typical_p"), ({"top_k": 0}, "top_k"),
    ({"max_new_tokens": 0}, "max_new_tokens"), ({"stop": ["x"] * 5}, "stop_sequences"), ({"inputs": ""}, "empty_input"), ({"inputs": None}, "empty_input"),
    ({"truncate": 2000}, "truncate"), ({"input_length": 2045}, "total_tokens"), ({"input_length": 1500, "max_new_tokens": None}, "input_length"),
    ({"input_length": 1500, "truncate": 100}, None)])
def test_request_reason(spark, change, want):
    row = {**REQUEST, **change}
    df = spark.createDataFrame([tuple(row.values())], REQUEST_SCHEMA)
    assert df.select(filters.request_reason()).first()[0] == want


def test_snapshot_tolerance(spark):
    def frame(lp):
        return spark.createDataFrame([(1, 0, 5, "a", False, None), (1, 1, 6, "b", False, lp)],
                                     "response_id int, pos int, id int, text string, special boolean, logprob double")
    assert ev.snapshot_compare(frame(-1.0), frame(-0.9)).first().matches == 1
    assert ev.snapshot_compare(frame(-1.0), frame(-0.7)).first().matches == 0
    assert ev.snapshot_compare(frame(-1.0), frame(None)).first().matches == 0
    assert ev.snapshot_compare(frame(-1.0), frame(-0.7), rtol=0.75).first().matches == 1
    assert ev.snapshot_compare(frame(-1.0), frame(-1.0).filter("pos = 0")).first().differences == 1


def test_percentiles(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(10)], "g string, v double")
    r = ev.latency_table(df, ["g"], "v").first()
    assert (r.p50, r.p99, r.lowest, r.highest) == (5.0, 9.0, 0.0, 9.0)
    past = ev.values_at(df, ["g"], "v", {"x": lambda n: n}).first()
    assert math.isnan(past.value)


def test_percentiles_of_equal_and_negative_values(spark):
    values = [-5.0] * 400 + [0.0] * 300 + [1e-9] * 100 + [7.25] * 201
    df = spark.createDataFrame([(1, v) for v in values], "g int, v double")
    r = ev.latency_table(df, ["g"], "v", (10, 50, 70, 90)).first()
    s = sorted(values)
    assert [r.p10, r.p50, r.p70, r.p90] == [s[int(p / 100 * len(s))] for p in (10, 50, 70, 90)]


def test_test_case_score(spark):
    df = spark.createDataFrame([(1, "1\r\n", "1"), (1, None, "2")], "program_id int, output string, expected string")
    assert ev.test_case_score(df).first().score == 0.5


def test_histogram_of_one_value(spark):
    rows = ev.histogram(spark.createDataFrame([(3.0,), (3.0,)], "v double"), "v", 3).collect()
    assert sorted((r.bucket, r.n) for r in rows) == [(0, 2), (1, 0), (2, 0)]


def test_log_sigmoid_is_stable(spark):
    assert one(spark, ev.log_sigmoid(F.lit(-800.0))) == -800.0
    assert one(spark, ev.log_sigmoid(F.lit(800.0))) == 0.0


def test_template_nulls(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    assert df.select(tx.fill("{x}-{y}").alias("t")).first().t is None
    assert df.select(tx.fill("{x}-{y}", null_as="").alias("t")).first().t == "a-"
    with pytest.raises(ValueError):
        tp.named_template(df, "{z}", "{x}")


def test_empty_input_uses_the_bare_turn(spark):
    df = spark.createDataFrame([("do", ""), ("do", None), ("do", "x")], "instruction string, input string")
    texts = [r[0] for r in df.select(tp.instruction_prompt(prompter="no_system")).collect()]
    assert texts == ["do ", "do ", "do x "]


def test_encode_edges(spark):
    e = tk.EOS
    assert one(spark, tk.encode("t", 4, eos=True), t="") == []
    assert len(one(spark, tk.encode("t", 4, eos=True), t="a b c d e")) == 4
    assert one(spark, tk.encode("t", 4, eos=True), t="a b")[-1] == e
    assert one(spark, tk.encode("t", 4, bos=True, eos=True), t="a b c d")[0] == tk.BOS
    assert len(one(spark, tk.encode("t", 9, eos=True, eos_count=3), t="a")) == 4
    assert len(one(spark, tk.encode("t", 3, eos=True, eos_count=3), t="a")) == 3


def test_running_starts_over_blocks(spark):
    a = list(range(1000))
    got = one(spark, running_starts(F.sequence(F.lit(0), F.lit(999)).cast("array<int>")))
    assert got == [sum(a[:i]) for i in range(1000)]
    assert one(spark, running_starts(F.array().cast("array<int>"))) == []


def test_run_weights(spark):
    labels = [5, 6, -100, 7, -100, -100, 8, 9, 4]
    got = one(spark, lb.run_weights(F.array(*[F.lit(x) for x in labels])))
    assert [round(x, 6) for x in got] == [0.5, 0.5, 0, 1, 0, 0, 0.333333, 0.333333, 0.333333]


def test_turns_with_training_spans(spark):
    spans = "training_detail array<struct<begin_offset int, end_offset int, train boolean>>"
    schema = f"messages array<struct<role string, content string, training boolean, {spans}>>".replace(" int", ":int").replace(
        " boolean", ":boolean").replace(" string", ":string").replace("messages array", "messages array").replace("detail array", "detail:array")
    messages = [("user", "one two", None, None), ("assistant", "aa bb cc dd", None, [(4, 6, True), (9, 10, False)]),
                ("assistant", "ee ff", False, [(0, 1, True)])]
    df = spark.createDataFrame([(messages,)], schema)
    row = df.select(lb.turn_masked("messages", training="training", detail="training_detail").alias("r")).select("r.*").first()
    trained = [x for x in row.labels if x != tk.IGNORED]
    ids = spark.range(1).select(tk.token_ids(F.lit("bb"))).first()[0]
    assert trained == ids + [tk.EOS] and len(row.labels) == len(row.input_ids)


def chat_frame(spark, *roles):
    return spark.createDataFrame([(1, i, r, f"t{i}") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("roles,want", [
    (["user", "assistant"], None), (["system", "user", "assistant", "user"], None), (["assistant", "user"], None),
    (["user"], "too short"), (["user", "user"], "roles do not alternate"), (["user", "system", "assistant"], "late system turn"),
    (["user", "robot"], "unknown role"), (["user", "assistant", "assistant", "user"], "roles do not alternate")])
def test_role_report(spark, roles, want):
    assert chat.role_report(chat_frame(spark, *roles)).first().reason == want


def test_role_report_finds_a_missing_turn(spark):
    df = chat_frame(spark, "user", "assistant", "user", "assistant").filter("turn <> 2")
    assert chat.role_report(df).first().reason == "missing turn"


def test_rollup_keeps_a_conversation_of_any_length_whole(spark):
    roles = ["system", *["user", "assistant"] * 1250]
    df = chat_frame(spark, *roles).repartition(7)
    assert chat.rollup(df, range_turns=4).collect() == chat.rollup(df).collect()
    row = chat.rollup(df).select("messages", chat.render_chat("messages", "qwen_25").alias("qwen"), chat.inst_prompt("messages").alias("inst")).collect()
    assert len(row) == 1 and [m.content for m in row[0].messages] == [f"t{i}" for i in range(2501)]
    assert row[0].qwen.count("<|im_start|>system") == 1 and row[0].qwen.count("<|im_start|>assistant") == 1250
    assert row[0].inst.count("<<SYS>>") == 1 and row[0].inst.count("[/INST]") == 1250


def test_refused_templates_are_null(spark):
    m = chat.rollup(chat_frame(spark, "system", "user", "assistant"))
    row = m.select(*[chat.render_chat("messages", n).alias(n) for n in ("gemma", "mistral_v1", "chatml")]).first()
    assert row.gemma is None and row.mistral_v1 is None and row.chatml.startswith("<|im_start|>system\nt0<|im_end|>\n")


def test_template_registry():
    with pytest.raises(ValueError):
        chat.register_chat_template("chatml", chat.ChatTemplate())
    chat.register_chat_template("plain", chat.ChatTemplate(any_role=("{role}: ", "\n")))
    with pytest.raises(ValueError):
        chat.chat_template("no such template")


def test_strategy_errors(spark):
    with pytest.raises(ValueError, match="unhandled"):
        registry.apply_strategy(spark.range(1), "no_such_type")
    with pytest.raises(ValueError, match="exists"):
        registry.strategy("alpaca.load")(lambda df, c: df)


def test_user_defined_strategy(spark):
    df = spark.createDataFrame([("q", "a")], "q string, a string")
    out = registry.apply_strategy(df, {"field_instruction": "q", "field_output": "a"}).first()
    assert len(out.input_ids) == 3 and out.labels[0] == tk.IGNORED and out.labels[-1] == tk.EOS


def test_formats_and_paths():
    assert [io.detect_format(p) for p in ("x.parquet", "d/x.arrow.gz", "x.csv", "x.txt", "x")] == ["parquet", "arrow", "csv", "text", "json"]
    assert io.detect_format("x.csv", "json") == "json"


def test_load_by_suffix_refuses(spark):
    with pytest.raises(ValueError):
        io.load_by_suffix(spark, "/tmp/x.xlsx")


def test_select_split_errors_before_any_job(spark):
    df = spark.createDataFrame([(1, "train")], "id int, split string")
    with pytest.raises(ValueError):
        io.select_split(df, "test", known=("train",))
    assert io.select_split(df, "train").count() == 1


def test_cache_key_covers_parameters():
    base = {"sequence_len": 8, "datasets": [{"path": "a"}, {"path": "b"}], "seed": 1}
    assert io.cache_key(base) == io.cache_key({**base, "datasets": base["datasets"][::-1]})
    assert len({io.cache_key({**base, "seed": s}) for s in (1, 2)}) == 2


def test_chat_schema(spark):
    schema = spark.createDataFrame([], "messages array<struct<from:string,role:string,value:string>>").schema
    assert io.discover_chat_schema(schema) == {"field_messages": "messages", "message_field_role": "from", "message_field_content": "value"}
    with pytest.raises(ValueError):
        io.discover_chat_schema(spark.createDataFrame([], "text string").schema)


def test_model_call_retries_and_gives_up(spark):
    def flaky():
        state = {"n": 0}

        def client(texts):
            state["n"] += 1
            if state["n"] < 3:
                raise RuntimeError("busy")
            return [t.upper() for t in texts]
        return client

    def broken():
        def client(texts):
            raise RuntimeError("down")
        return client

    df = spark.createDataFrame([(1, "a")], "id long, p string").coalesce(1)
    assert registry.call_model(df, "id", "p", flaky, retries=3).first().prediction == "A"
    assert registry.call_model(df, "id", "p", broken, retries=2).first().prediction == "error"


def test_first_fit_decreasing():
    import numpy as np
    a = np.array([5, 6, 4, 3, 2, 10, 1])
    bins = pack.first_fit_decreasing(a, 10)
    assert all(a[bins == b].sum() <= 10 for b in set(bins)) and bins.max() + 1 == 4
    assert pack.fits_in(a, 10, 4) and not pack.fits_in(a, 10, 3) and not pack.fits_in(np.array([11]), 10, 9)


def test_inst_marks_do_not_train(spark):
    turns = [("system", "Be kind."), ("user", " Hi "), ("assistant", "Hello"), ("user", "More"), ("assistant", "No")]
    df = spark.createDataFrame([([{"role": r, "content": c} for r, c in turns],)], "messages array<struct<role:string,content:string>>")
    segments = df.select(chat.inst_segments("messages").alias("s")).first().s
    assert [tuple(x) for x in segments] == [
        ("[INST] <<SYS>>\nBe kind.\n<</SYS>>\n\nHi", False), ("[/INST]", False), (" Hello </s><s>", True),
        ("[INST] More ", False), ("[/INST]", False), (" No </s><s>", True)]
    row = df.select(lb.inst_encoded(chat.inst_segments("messages"), 200).alias("r")).first().r
    mark = df.select(tk.token_ids(F.lit("[/INST]")).alias("i")).first().i
    at = [k for k in range(len(row.input_ids)) if row.input_ids[k:k + len(mark)] == mark]
    assert len(at) == 2 and all(x == -100 for k in at for x in row.labels[k:k + len(mark)])
