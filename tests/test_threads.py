import random

import pytest
from pyspark.sql import functions as F

from promptmill.functions.arrays import once
from promptmill.operators import chat, labels as lb, threads


def turns(spark, conversations):
    rows = [(c, 3 * k + 5, role, f" {role} {k} ") for c, roles in conversations.items() for k, role in enumerate(roles)]
    random.Random(1).shuffle(rows)
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(5)


def some():
    r = random.Random(3)
    found = {0: ["system", *["user", "assistant"] * 1250], 1: ["user", "assistant"] * 30, 2: ["system", "assistant", "user", "assistant"], 3: ["system"],
             4: ["user"], 5: ["assistant", "user"], 6: ["system", "user", "tool", "user", "assistant"], 7: ["user", "assistant", "user"], 8: ["system", "assistant"]}
    for c in range(9, 60):
        found[c] = [r.choice(["system", "user", "user", "assistant", "assistant", "tool"]) for _ in range(r.randrange(1, 12))]
    for c in range(60, 80):
        found[c] = (["system"] * r.randrange(2) + ["assistant"] * r.randrange(2) + ["user", "assistant"] * r.randrange(9) + ["user"] * r.randrange(2)) or ["user"]
    return found


@pytest.fixture(scope="module")
def flat(spark):
    return turns(spark, some()).cache()


@pytest.mark.parametrize("range_turns", [1, 2, 7, 100_000])
def test_turn_by_turn_equals_whole_records(spark, flat, range_turns):
    names = list(chat.CHAT_TEMPLATES)
    pieces = threads.threaded(flat, range_turns=range_turns).select(
        "conv_id", "i", *[threads.rendered(n, k % 2 == 0).alias(n) for k, n in enumerate(names)],
        F.array_join(F.transform(threads.inst_pieces(), lambda s: s["text"]), "").alias("inst")).collect()
    whole = chat.rollup(flat).select("conv_id", "messages", *[chat.render_chat("messages", n, k % 2 == 0).alias(n) for k, n in enumerate(names)],
                                     chat.inst_prompt("messages").alias("inst")).collect()
    by = {}
    for p in sorted(pieces, key=lambda p: (p.conv_id, p.i)):
        by.setdefault(p.conv_id, []).append(p)
    assert {c: [p.i for p in ps] for c, ps in by.items()} == {c: list(range(len(roles))) for c, roles in some().items()}
    for w in whole:
        for n in [*names, "inst"]:
            parts = [p[n] for p in by[w.conv_id]]
            assert (None if None in parts else "".join(parts)) == w[n], (w.conv_id, n)
    assert sum(w.inst is not None for w in whole) > 10 and sum(w.mistral_v1 is None for w in whole) > 10


@pytest.mark.parametrize("range_turns", [1, 5, 100_000])
def test_labels_and_offsets_equal_whole_records(spark, flat, range_turns):
    rows = threads.threaded(flat, range_turns=range_turns)
    part = lb.turn_part(F.col("role"), F.col("text"), F.col("i") == F.col("thread.n") - 1, train_on_eos="last")
    rows = once(rows.select("conv_id", "range", "i", "role", "text", "thread"), row=part)
    rows = threads.offsets(rows, F.size("row.ids").cast("long")).select("conv_id", "i", "start", F.col("row.ids").alias("input_ids"), "row.labels")
    whole = {r.conv_id: r.row for r in chat.rollup(flat).select("conv_id", lb.turn_masked("messages", train_on_eos="last").alias("row")).collect()}
    ids, labels = {}, {}
    for r in sorted(rows.collect(), key=lambda r: (r.conv_id, r.i)):
        assert r.start == len(ids.setdefault(r.conv_id, []))
        ids[r.conv_id] += r.input_ids
        labels.setdefault(r.conv_id, []).extend(r.labels)
    assert ids == {c: r.input_ids for c, r in whole.items()} and labels == {c: r.labels for c, r in whole.items()}
    cut = {r.conv_id: (r.input_ids, r.labels) for r in threads.first_tokens(rows, 40).collect()}
    assert cut == {c: (r.input_ids[:40], r.labels[:40]) for c, r in whole.items()}


def test_no_group_holds_more_than_a_range(spark):
    """A conversation with all rows: the largest group that is sorted or collected is a range."""
    long = turns(spark, {1: ["user", "assistant"] * 6000})
    rows = threads.threaded(long, range_turns=30)
    assert rows.groupBy("conv_id", "range").count().agg(F.max("count")).first()[0] <= 10  # every third turn number is taken
    assert rows.select(F.sum("i")).first()[0] == 12_000 * 11_999 // 2
    assert threads.threaded(long.limit(0)).count() == 0
