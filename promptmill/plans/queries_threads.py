"""P24, P25, T05, T12 turn by turn: conversations that need not fit a row."""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import once
from promptmill.operators import chat, labels as lb, threads
from promptmill.plans import fixtures as fx
from promptmill.plans.kit import CONV, ORACLES, cat, count, ids, q, query, rep, trim, variants
from promptmill.plans.queries_prompts import INST_CTE, P24_CASES, template_parts_sql
from promptmill.plans.queries_tokens import T05_FLAG, out


def _pieces_sql(name: str, gen: bool) -> str:
    p = template_parts_sql(name, gen)
    piece = (f"(CASE WHEN i = 1 THEN {p['opening']} ELSE '' END) || (CASE WHEN i = 1 AND {p['taken']} THEN '' ELSE {p['piece']} END) || "
             f"(CASE WHEN i = len(m) THEN {p['closing']} ELSE '' END)")
    return f"list_transform(m, lambda x, i: CASE WHEN NOT ({p['refused'].replace('lambda x, i:', 'lambda y, j:').replace('(x.role = ', '(y.role = ').replace('(i % 2', '(j % 2')}) THEN {piece} END)"


@query("p24_chat_templates_by_turn", f"WITH {CONV} " + " UNION ALL ".join(
    f"SELECT conv_id, unnest(range(len(m))) AS i, {q(f'{n}/{int(g)}')} AS template, unnest({_pieces_sql(n, g)}) AS text FROM c" for n, g in P24_CASES))
def p24_by_turn(spark, sf):
    rows = threads.threaded(fx.turns(spark, sf))
    return variants(rows, ["conv_id", "i"], {f"{n}/{int(g)}": {"text": threads.rendered(n, g)} for n, g in P24_CASES}, "template")


@query("p25_inst_chat_by_turn", f"""WITH {INST_CTE}, s AS (SELECT conv_id, m, kept, ok, len(m) - len(st) AS sk FROM c3)
 SELECT conv_id, unnest(range(len(m))) AS i, unnest(list_transform(m, lambda x, i: CASE WHEN NOT ok THEN NULL WHEN i <= sk OR i - sk > len(kept) THEN ''
 WHEN i - sk = 1 THEN '[INST] <<SYS>>' || chr(10) || CASE WHEN m[1].role = 'system' THEN m[1].content ELSE {q(chat.INST_DEFAULT_SYSTEM)} END || chr(10) ||
 '<</SYS>>' || chr(10) || chr(10) || {trim('x.content')} WHEN (i - sk) % 2 = 1 THEN '[INST] ' || {trim('x.content')} || ' '
 ELSE '[/INST] ' || {trim('x.content')} || ' </s><s>' END)) AS text FROM s""")
def p25_by_turn(spark, sf):
    text = F.array_join(F.transform(threads.inst_pieces(), lambda s: s["text"]), "")
    return threads.threaded(fx.turns(spark, sf)).select("conv_id", "i", text.alias("text"))


_EOS = {"turn": "coalesce(flag, role = 'assistant')", "last": "i = n_turns - 1"}


@query("t05_turn_mask_by_turn", f"""WITH a AS (SELECT conv_id, role, text, {T05_FLAG} AS flag, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS i,
 count(*) OVER (PARTITION BY conv_id) AS n_turns FROM conversations), b AS (SELECT *, {ids("'<|im_start|>' || role || chr(10)")} AS k, {ids('text')} AS t FROM a), """
       + ", ".join(f"e_{e} AS (SELECT conv_id, i, k || t || [2] AS x, {rep(-100, 'len(k)')} || (CASE WHEN coalesce(flag, role = 'assistant') THEN t ELSE "
                   f"{rep(-100, 'len(t)')} END) || [CASE WHEN {rule} THEN 2 ELSE -100 END] AS l FROM b)" for e, rule in _EOS.items()) + " "
       + " UNION ALL ".join(f"SELECT conv_id, i, '{e}' AS eos, (sum(len(x)) OVER (PARTITION BY conv_id ORDER BY i) - len(x))::BIGINT AS start, len(x) AS n, "
                            f"{cat('x')} AS input_ids, {cat('l')} AS labels FROM e_{e}" for e in _EOS))
def t05_by_turn(spark, sf):
    rule = F.length("text") % 5
    flagged = fx.turns(spark, sf).withColumn("flag", F.when(rule == 0, True).when(rule == 1, False))
    rows = threads.threaded(flagged)
    is_last = F.col("i") == F.col("thread.n") - 1
    rows = variants(rows, ["conv_id", "range", "i"], {e: {"row": lb.turn_part(
        F.col("role"), F.col("text"), is_last, train_on_eos=e, training=F.col("flag"))} for e in _EOS}, "eos")
    rows = threads.offsets(rows, F.size("row.ids").cast("long"), group=("eos",))
    return out(rows.select("conv_id", "i", "eos", "start", F.col("row.ids").alias("input_ids"), "row.labels"), "conv_id", "i", "eos", "start", hashed=False)


@query("t12_inst_mask_by_turn", ORACLES["t12_inst_mask"])
def t12_by_turn(spark, sf):
    """The first 512 tokens of each conversation, put together from its turns."""
    rows = threads.threaded(fx.turns(spark, sf)).withColumn("s", threads.inst_pieces()).filter("s is not null")
    rows = once(rows.select("conv_id", "range", "i", "s"), row=lb.labelled(F.col("s")))
    begin = F.col("i") == 0
    rows = rows.select("conv_id", "range", "i", F.when(begin, F.concat(F.array(F.lit(tk.BOS)), "row.input_ids")).otherwise(F.col("row.input_ids")).alias("input_ids"),
                       F.when(begin, F.concat(F.array(F.lit(tk.IGNORED)), "row.labels")).otherwise(F.col("row.labels")).alias("labels"))
    cut = threads.first_tokens(threads.offsets(rows, F.size("input_ids").cast("long")), 512)
    cut = cut.withColumn("attention_mask", F.transform("input_ids", lambda x: (x != tk.PAD).cast("int")))
    room = F.greatest(512 - F.size("input_ids"), F.lit(0))
    fitted = cut.select("conv_id", *[F.concat(c, F.array_repeat(F.lit(pad), room)).alias(c) for c, pad in
                                     (("input_ids", tk.PAD), ("labels", tk.IGNORED), ("attention_mask", 0))])
    return out(fitted, "conv_id", columns=("input_ids", "labels", "attention_mask"), hashed=False)
