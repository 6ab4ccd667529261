"""Token ids, masks, windows, audits.

Long id lists are returned as the md5 of their text, short ones as text.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import once
from promptmill.operators import chat, labels as lb, split, template as tp
from promptmill.plans import fixtures as fx
from promptmill.plans.fixtures import TOKEN_LOG_SQL
from promptmill.plans.kit import (CONV, DOCS, PAIRS, cat, count, dig, digest, fmt, ids, joined, q, query, r6, rep,
                                  trim, variants, words)
from promptmill.plans.queries_prompts import INST_CTE, PERSONA_SQL, _marked_sql, _p14_sql

MAX = 256


def out(df, *keep, columns=("input_ids", "labels"), hashed=True):
    """Key columns, list sizes and the lists as digests or text."""
    f = digest if hashed else joined
    return df.select(*keep, F.size(columns[0]).alias("n"), *[f(c).alias(c) for c in columns])


@query("t01_tokenize", f"""WITH a AS (SELECT doc_id, {ids('text')} AS i, {ids("CASE WHEN lang = 'es' THEN '' ELSE text END")} AS e FROM documents),
 b AS (SELECT doc_id, i AS whole, i[1:{MAX}] || (CASE WHEN len(i) > 0 AND len(i) < {MAX} THEN [2] ELSE [] END) AS cut,
 CASE WHEN len(e) > 0 THEN e[1:{MAX - 1}] || (CASE WHEN len(e) < {MAX - 1} THEN [2] ELSE [] END) ELSE [] END AS stripped FROM a)
 SELECT doc_id, len(whole) AS n, {dig('whole')} AS whole, {dig('cut')} AS cut, {dig('stripped')} AS stripped FROM b""")
def t01(spark, sf):
    d = fx.documents(spark, sf)
    some = F.when(F.col("lang") == "es", "").otherwise(F.col("text"))
    rows = once(d, whole=tk.encode("text"), stripped=tk.encode(some, MAX, bos=True, eos=True, strip_bos=True))
    rows = rows.withColumn("cut", tk.encode("text", MAX, eos=True, ids=F.col("whole")))
    return out(rows, "doc_id", columns=("whole", "cut", "stripped"))


T02_PROMPT = "{instruction}\n{input}\n"


@query("t02_prompt_mask", f"""WITH {DOCS}, a AS (SELECT doc_id, {ids(fmt(T02_PROMPT))} AS p, {ids('output')} AS o FROM d),
 b AS (SELECT doc_id, p, o || (CASE WHEN len(o) > 0 THEN [2] ELSE [] END) AS o FROM a)
 SELECT doc_id, len(p) + len(o) AS n, {dig('p || o')} AS input_ids, {dig(rep(-100, 'len(p)') + ' || o')} AS labels,
 {dig('p || o')} AS all_labels FROM b""")
def t02(spark, sf):
    d = fx.docs(spark, sf)
    prompt = F.concat("instruction", F.lit("\n"), "input", F.lit("\n"))
    rows = once(d, row=lb.prompt_masked(prompt, "output"), kept=lb.prompt_masked(prompt, "output", train_on_inputs=True))
    rows = rows.select("doc_id", "row.input_ids", "row.labels", F.col("kept.labels").alias("all_labels"))
    return out(rows, "doc_id", columns=("input_ids", "labels", "all_labels"))


_REFLECT_CTE = DOCS.replace("d AS (", "d0 AS (") + ", d AS (SELECT *, CASE WHEN lang = 'de' THEN '' ELSE upper(source) END AS corrected FROM d0)"
_T03_PROMPT = (f"CASE WHEN length(input) > 0 THEN {fmt(tp.REFLECT_SYSTEM + tp.REFLECT['chat'][0])} "
               f"ELSE {fmt(tp.REFLECT_BARE_SYSTEM + tp.REFLECT['chat'][1])} END")


@query("t03_whole_text_mask", f"""WITH {_REFLECT_CTE}, a AS (SELECT doc_id, {ids(_p14_sql('chat'))} || [2] AS i, {count(_T03_PROMPT)} AS np FROM d)
 SELECT doc_id, len(i) AS n, {dig('i')} AS input_ids, {dig(rep(-100, 'np') + ' || i[np + 1:]')} AS labels FROM a""")
def t03(spark, sf):
    raw = fx.docs(spark, sf).withColumns({
        "reflection": F.col("head"), "corrected": F.when(F.col("lang") == "de", "").otherwise(F.upper("source"))})
    row = lb.whole_text_masked(tp.reflection_prompt("chat"), tp.reflection_prompt("chat", with_answer=False))
    return out(lb.with_encoded(raw, row), "doc_id")


@query("t04_end_tokens", f"""WITH a AS (SELECT doc_id, {ids('text')} AS i FROM documents),
 b AS (SELECT doc_id, i[1:{MAX}] || {rep(2, f"CASE WHEN len(i) = 0 THEN 0 ELSE least(3, {MAX} - len(i[1:{MAX}])) END")} AS i FROM a)
 SELECT doc_id, len(i) AS n, {dig('i')} AS input_ids FROM b""")
def t04(spark, sf):
    rows = once(fx.documents(spark, sf).select("doc_id", "text"), input_ids=tk.encode("text", MAX, eos=True, eos_count=3))
    return out(rows, "doc_id", columns=("input_ids",))


def _turns_sql(trains: str, eos: str) -> str:
    """Ids and labels of a conversation in the mark / content / EOS chat."""
    mark = ids("'<|im_start|>' || x.role || chr(10)")
    nm = count("'<|im_start|>' || x.role || chr(10)")
    return (f"flatten(list_transform(m, lambda x: {mark} || {ids('x.content')} || [2])) AS i, "
            f"flatten(list_transform(m, lambda x, j: {rep(-100, nm)} || "
            f"(CASE WHEN {trains} THEN {ids('x.content')} ELSE {rep(-100, count('x.content'))} END) || "
            f"[CASE WHEN {eos} THEN 2 ELSE -100 END])) AS l")


T05_FLAG = "CASE length(text) % 5 WHEN 0 THEN true WHEN 1 THEN false END"
T05_CTE = ("c AS (SELECT conv_id, list({'role': role, 'content': text, 'flag': " + T05_FLAG
           + "} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)")
_T05_TRAINS = "coalesce(x.flag, x.role = 'assistant')"
T05_EOS = {"all": "true", "turn": _T05_TRAINS, "last": "j = len(m)"}


@query("t05_turn_mask", "WITH " + T05_CTE + ", " + ", ".join(
    f"e_{k} AS (SELECT conv_id, {_turns_sql(_T05_TRAINS, e)} FROM c)" for k, e in T05_EOS.items()) + " " + " UNION ALL ".join(
    f"SELECT conv_id, '{k}' AS eos, len(i) AS n, {cat('i')} AS input_ids, {cat('l')} AS labels FROM e_{k}" for k in T05_EOS))
def t05(spark, sf):
    rule = F.length("text") % 5
    flagged = fx.turns(spark, sf).withColumn("flag", F.when(rule == 0, True).when(rule == 1, False))
    c = chat.rollup(flagged, extra=("flag",))
    rows = variants(c, ["conv_id"], {k: {"row": lb.turn_masked("messages", train_on_eos=k, training="flag")} for k in T05_EOS}, "eos")
    return out(rows.select("conv_id", "eos", "row.input_ids", "row.labels"), "conv_id", "eos", hashed=False)


_PIECES = r"regexp_extract_all(text, '\s+|\p{L}+|\p{N}+|[^\s\p{L}\p{N}]')"


@query("t06_span_mask", f"""WITH x AS (SELECT conv_id, turn, text, length(text) AS len, {_PIECES} AS ps FROM conversations),
 y AS (SELECT conv_id, turn, len, unnest(ps) AS tok, unnest(range(len(ps))) AS k FROM x),
 z AS (SELECT *, coalesce(sum(length(tok)) OVER (PARTITION BY conv_id, turn ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS s FROM y),
 w AS (SELECT conv_id, turn, len, tok, s, row_number() OVER (PARTITION BY conv_id, turn ORDER BY k) - 1 AS i,
 coalesce(lead(s) OVER (PARTITION BY conv_id, turn ORDER BY k) - 1, len - 1) AS e FROM z WHERE NOT regexp_matches(tok, '^\\s')),
 spans AS (SELECT DISTINCT conv_id, turn, unnest([{{'b': len // 4, 'e': len // 2, 't': true}}, {{'b': len * 3 // 5, 'e': len * 4 // 5, 't': turn % 2 = 0}}]) AS d FROM w),
 snap0 AS (SELECT s.conv_id, s.turn, s.d, count(*) FILTER (w.s < s.d.b) AS f0, count(*) FILTER (w.e <= s.d.e) - 1 AS l0, count(*) AS n
 FROM spans s JOIN w USING (conv_id, turn) GROUP BY s.conv_id, s.turn, s.d),
 snap AS (SELECT a.conv_id, a.turn, a.d.t AS t, CASE WHEN f0 > 0 AND p.e > a.d.b THEN f0 - 1 ELSE f0 END AS f,
 CASE WHEN l0 < n - 1 AND nx.s < a.d.e THEN l0 + 1 ELSE l0 END AS l FROM snap0 a
 LEFT JOIN w p ON p.conv_id = a.conv_id AND p.turn = a.turn AND p.i = a.f0 - 1
 LEFT JOIN w nx ON nx.conv_id = a.conv_id AND nx.turn = a.turn AND nx.i = a.l0 + 1),
 lab AS (SELECT w.conv_id, w.turn, w.i, 16 + ('0x' || substr(md5(w.tok), 1, 7))::INT AS id,
 EXISTS (SELECT 1 FROM snap s WHERE s.conv_id = w.conv_id AND s.turn = w.turn AND s.t AND s.f <= s.l AND w.i BETWEEN s.f AND s.l) AS tr FROM w)
 SELECT conv_id, turn, count(*) AS n, string_agg(id, ' ' ORDER BY i) AS input_ids,
 string_agg(CASE WHEN tr THEN id ELSE -100 END, ' ' ORDER BY i) AS labels FROM lab GROUP BY conv_id, turn""")
def t06(spark, sf):
    n = F.length("text")

    def span(b, e, train):
        return F.struct(F.floor(b).cast("int").alias("begin_offset"), F.floor(e).cast("int").alias("end_offset"), train.alias("train"))
    details = F.array(span(n / 4, n / 2, F.lit(True)), span(n * 3 / 5, n * 4 / 5, F.col("turn") % 2 == 0))
    rows = lb.span_masked(fx.turns(spark, sf).withColumn("details", details), "text", "details")
    return out(rows, "conv_id", "turn", hashed=False)


_SEG_CTE = CONV + (", s AS (SELECT conv_id, flatten(list_transform(m, lambda x: [{'t': '<|im_start|>' || x.role || chr(10), 'w': 0}, "
                   "{'t': x.content, 'w': (x.role = 'assistant')::INT}, {'t': '<|im_end|>', 'w': (x.role = 'assistant')::INT}, "
                   "{'t': chr(10), 'w': 0}])) AS s FROM c)")


@query("t07_weighted_segments", f"""WITH {_SEG_CTE}, a AS (SELECT conv_id, flatten(list_transform(s, lambda x: {ids('x.t')})) AS i,
 flatten(list_transform(s, lambda x: CASE WHEN x.w <> 0 THEN {ids('x.t')} ELSE {rep(-100, count('x.t'))} END)) AS l FROM s)
 SELECT conv_id, len(i) AS n, {cat('i')} AS input_ids, {cat('l')} AS labels FROM a""")
def t07(spark, sf):
    c = fx.conversations(spark, sf).withColumn("w", chat.weighted_messages("messages"))
    rows = lb.with_encoded(c, lb.weighted_labels(chat.weighted_segments("w", "chatml")))
    return out(rows, "conv_id", hashed=False)


@query("t08_completion_chunks", f"""WITH a AS (SELECT doc_id, {ids('text')} || [2] AS i FROM documents),
 b AS (SELECT doc_id, i, unnest(range((len(i) + 127) // 128)) AS w FROM a)
 SELECT doc_id, w AS "window", len(i[w * 128 + 1:w * 128 + 128]) AS n, {dig('i[w * 128 + 1:w * 128 + 128]')} AS input_ids FROM b""")
def t08(spark, sf):
    rows = once(fx.documents(spark, sf).select("doc_id", "text"), input_ids=tk.encode("text", eos=True)).drop("text")
    return out(lb.explode_windows(rows, lb.chunks("input_ids", 128)), "doc_id", "window", columns=("input_ids",))


@query("t09_strided_windows", f"""WITH a AS (SELECT doc_id, {ids('text')} AS i FROM documents),
 b AS (SELECT doc_id, i, unnest(range(1 + greatest(0, ceil((len(i) - 511) / 255.0)::BIGINT))) AS w FROM a)
 SELECT doc_id, w AS "window", len(i[w * 255 + 1:w * 255 + 511]) + 1 AS n, {dig('(i[w * 255 + 1:w * 255 + 511] || [2])')} AS input_ids FROM b""")
def t09(spark, sf):
    rows = once(fx.documents(spark, sf).select("doc_id", "text"), input_ids=tk.token_ids("text")).drop("text")
    return out(lb.explode_windows(rows, lb.strided_windows("input_ids", 512, 256)), "doc_id", "window", columns=("input_ids",))


@query("t10_source_target", f"""WITH {DOCS}, a AS (SELECT doc_id, ([1] || {ids("instruction || chr(10) || input")})[1:32] AS s, ({ids('output')} || [2])[1:128] AS t FROM d)
 SELECT doc_id, len(s) + len(t) AS n, {dig('s || t')} AS input_ids, {dig(rep(-100, 'len(s)') + ' || t')} AS labels FROM a""")
def t10(spark, sf):
    d = fx.docs(spark, sf)
    row = lb.source_target(F.concat("instruction", F.lit("\n"), "input"), "output", 32, 128)
    return out(lb.with_encoded(d, row), "doc_id")


def _fit_sql(a: str, length: int, pad: int, last: int) -> str:
    return f"(CASE WHEN len({a}) < {length} THEN {a} || {rep(pad, f'{length} - len({a})')} ELSE {a}[1:{length - 1}] || [{last}] END)"


_CODER_TEXT = ("CASE x.role WHEN 'system' THEN x.content WHEN 'user' THEN '### Instruction:' || chr(10) || x.content || chr(10) "
               "ELSE '### Response:' || chr(10) || x.content || chr(10) || '<|EOT|>' || chr(10) END")


@query("t11_fixed_length_chat", f"""WITH {CONV}, lead AS (SELECT conv_id, m, [1] || CASE WHEN len(list_filter(m, lambda x: x.role = 'system')) > 0 THEN [] ELSE
 {ids(q(lb.CODER_SYSTEM))} END AS ld FROM c),
 coder AS (SELECT conv_id, ld || flatten(list_transform(m, lambda x: {ids(_CODER_TEXT)})) AS i,
 {rep(-100, 'len(ld)')} || flatten(list_transform(m, lambda x: CASE WHEN x.role IN ('user', 'system') THEN {rep(-100, count(_CODER_TEXT))} ELSE {ids(_CODER_TEXT)} END)) AS l FROM lead),
 roles AS (SELECT conv_id, [1] || flatten(list_transform(m, lambda x: {ids("'<|' || x.role || '|>'")} || {ids(trim('x.content'))} ||
 (CASE WHEN x.role = 'assistant' THEN [2] ELSE [] END))) AS i, [-100] || flatten(list_transform(m, lambda x: {rep(-100, count("'<|' || x.role || '|>'"))} ||
 CASE WHEN x.role = 'assistant' THEN {ids(trim('x.content'))} || [2] ELSE {rep(-100, count(trim('x.content')))} END)) AS l FROM c)
 SELECT conv_id, 'coder' AS markup, 512 AS n, {cat(_fit_sql('i', 512, 2, 2))} AS input_ids, {cat(_fit_sql('l', 512, -100, -100))} AS labels FROM coder
 UNION ALL SELECT conv_id, 'roles', 512, {cat(_fit_sql('i', 512, 2, 2))}, {cat(_fit_sql('l', 512, -100, 2))} FROM roles""")
def t11(spark, sf):
    rows = variants(fx.conversations(spark, sf), ["conv_id"], {
        "coder": {"row": lb.coder_chat("messages", 512)}, "roles": {"row": lb.role_chat("messages", 512)}}, "markup")
    return out(rows.select("conv_id", "markup", "row.input_ids", "row.labels"), "conv_id", "markup", hashed=False)


@query("t12_inst_mask", f"""WITH {INST_CTE}, a AS (SELECT conv_id, [1] || flatten(list_transform(seg, lambda s: {ids('s.text')})) AS i,
 [-100] || flatten(list_transform(seg, lambda s: CASE WHEN s.trains THEN {ids('s.text')} ELSE {rep(-100, count('s.text'))} END)) AS l FROM c4 WHERE ok),
 b AS (SELECT conv_id, i[1:512] || {rep(0, '512 - len(i)')} AS i, l[1:512] || {rep(-100, '512 - len(l)')} AS l FROM a)
 SELECT conv_id, len(i) AS n, {cat('i')} AS input_ids, {cat('l')} AS labels, {cat('list_transform(i, lambda z: (z <> 0)::INT)')} AS attention_mask FROM b""")
def t12(spark, sf):
    c = fx.conversations(spark, sf).withColumn("s", chat.inst_segments("messages")).filter("s is not null")
    rows = lb.with_encoded(c, lb.inst_encoded(F.col("s"), 512))
    return out(rows, "conv_id", columns=("input_ids", "labels", "attention_mask"), hashed=False)


@query("t13_persona_mask", f"""WITH {PERSONA_SQL}, a AS (SELECT conv_id, flatten(list_transform(m, lambda x:
 (CASE WHEN x.role = 'system' THEN [1] ELSE [] END) || {ids('x.text')} || (CASE WHEN x.role = 'bot' THEN [2] ELSE [] END))) AS i,
 flatten(list_transform(m, lambda x: CASE WHEN x.role = 'bot' THEN {rep(-100, 5)} || ({ids('x.text')})[6:] || [2] ELSE
 {rep(-100, count('x.text') + " + (CASE WHEN x.role = 'system' THEN 1 ELSE 0 END)")} END)) AS l FROM c)
 SELECT conv_id, len(i) AS n, {cat('i')} AS input_ids, {cat('l')} AS labels FROM a""")
def t13(spark, sf):
    rows = lb.with_encoded(fx.conversations(spark, sf), lb.persona_encoded(chat.persona_segments("messages")))
    return out(rows, "conv_id", hashed=False)


@query("t14_raw_segments", f"""WITH {CONV}, a AS (SELECT conv_id, flatten(list_transform(m, lambda x: {ids('x.content')})) AS i,
 flatten(list_transform(m, lambda x: CASE WHEN x.role = 'assistant' THEN {ids('x.content')} ELSE {rep(-100, count('x.content'))} END)) AS l FROM c)
 SELECT conv_id, len(i) AS n, {cat('i')} AS input_ids, {cat('l')} AS labels FROM a""")
def t14(spark, sf):
    segments = F.transform("messages", lambda m: F.struct(m["content"].alias("text"), (m["role"] == "assistant").alias("label")))
    return out(lb.with_encoded(fx.conversations(spark, sf), lb.raw_segments(segments)), "conv_id", hashed=False)


@query("t15_odds_ratio_pair", f"""WITH {PAIRS}, a AS (SELECT pair_id, {ids('prompt')} AS p, {ids('chosen')} AS c, {ids('rejected')} AS r FROM p)
 SELECT pair_id, len(p || c) AS n, {cat('p || c')} AS input_ids, {cat(rep(-100, 'len(p)') + ' || c')} AS labels, {cat('p || r')} AS rejected_input_ids,
 {cat(rep(-100, 'len(p)') + ' || r')} AS rejected_labels, {cat(rep(1, 'len(p)') + ' || ' + rep(0, 'len(c)'))} AS prompt_attention_mask FROM a""")
def t15(spark, sf):
    p = fx.pairs(spark, sf)
    rows = lb.odds_ratio_pair(p, "prompt", "chosen", "rejected")
    return out(rows, "pair_id", columns=("input_ids", "labels", "rejected_input_ids", "rejected_labels", "prompt_attention_mask"), hashed=False)


@query("t16_reward_pair", f"""WITH {PAIRS}, a AS (SELECT pair_id, ({ids(_marked_sql('chatml') + " || chosen")})[1:200] AS c, ({ids(_marked_sql('chatml') + " || rejected")})[1:200] AS r FROM p)
 SELECT pair_id, len(c) AS n, {cat('c')} AS input_ids_chosen, {cat('r')} AS input_ids_rejected, greatest(len(c), len(r)) AS length,
 1.0::DOUBLE AS labels_chosen, 0.0::DOUBLE AS labels_rejected FROM a""")
def t16(spark, sf):
    p = fx.pairs(spark, sf)
    text = tp.marked_prompt(p, "chatml", "prompt")
    rows = lb.reward_pair_encoded(p, F.concat(text, "chosen"), F.concat(text, "rejected"), 200)
    return out(rows, "pair_id", "length", "labels_chosen", "labels_rejected", columns=("input_ids_chosen", "input_ids_rejected"), hashed=False)


@query("t17_preference_row_fix", f"""WITH {PAIRS}, a AS (SELECT pair_id, {ids('chosen')} || [2] AS c, {ids('rejected')} || [2] AS r, {rep(1, count('chosen') + ' + 1')} AS m FROM p)
 SELECT pair_id, len(c) AS n, {cat('c')} AS chosen_input_ids, {cat('c')} AS chosen_labels, {cat('m')} AS chosen_attention_mask, {cat('r')} AS rejected_input_ids FROM a""")
def t17(spark, sf):
    p = fx.pairs(spark, sf).select("pair_id", tk.encode("chosen", bos=True, eos=True).alias("chosen_input_ids"),
                                   tk.encode("rejected", eos=True).alias("rejected_input_ids"))
    p = p.withColumns({"chosen_labels": F.col("chosen_input_ids"), "chosen_attention_mask": lb.attention(F.col("chosen_input_ids"))})
    fixed = p.withColumns({**lb.without_bos("chosen_input_ids", ("chosen_labels", "chosen_attention_mask")),
                           **lb.without_bos("rejected_input_ids", ())})
    return out(fixed, "pair_id", columns=("chosen_input_ids", "chosen_labels", "chosen_attention_mask", "rejected_input_ids"), hashed=False)


T18_KEYS = "k AS (SELECT src, row_number() OVER (ORDER BY md5('0|' || src), src) - 1 AS index FROM (SELECT DISTINCT source || '-' || lang AS src FROM documents))"


@query("t18_query_encode", f"""WITH {T18_KEYS}, a AS (SELECT doc_id, source || '-' || lang AS src, ({ids('text')})[1:2048] AS i FROM documents)
 SELECT doc_id, index, len(i) AS n, {dig('i')} AS input_ids FROM a JOIN k USING (src)""")
def t18(spark, sf):
    d = fx.documents(spark, sf).withColumn("src", F.concat_ws("-", "source", "lang"))
    rows = once(split.encode_keys(d, split.dictionary(d, "src"), "src"), input_ids=tk.encode("text", 2048))
    return out(rows, "doc_id", "index", columns=("input_ids",))


@query("t19_length_positions", f"""WITH a AS (SELECT doc_id, {count('text')} AS length FROM documents)
 SELECT doc_id, length, {dig('range(length)')} AS position_ids FROM a""")
def t19(spark, sf):
    rows = once(fx.documents(spark, sf).select("doc_id", "text"), input_ids=tk.token_ids("text"))
    return rows.select("doc_id", *lb.positions("input_ids")).select("doc_id", "length", digest("position_ids").alias("position_ids"))


@query("t20_skipped_positions", f"""WITH a AS (SELECT doc_id, {count('text')} AS n FROM documents),
 b AS (SELECT doc_id, n, CASE WHEN n // 4 < 2 THEN [2 * (n // 4), 3 * (n // 4), n] ELSE [n // 4, 2 * (n // 4), 3 * (n // 4), n] END AS pts FROM a),
 f AS (SELECT doc_id, n, list_reduce(list_transform(pts, lambda p: {{'f': p, 'sk': 0::BIGINT, 'k': 0, 'parts': [{{'a': 0::BIGINT, 'b': 0::BIGINT}}][1:0]}}), lambda s, p: {{'f': p.f,
 'sk': s.sk + CASE WHEN s.f > 0 THEN floor(('0x' || substr(md5('42|' || doc_id || '|' || s.k), 1, 7))::INT / 268435456.0::DOUBLE * (greatest(32768 - n - s.sk, 0) + 1))::BIGINT ELSE 0 END,
 'k': s.k + 1, 'parts': s.parts || [{{'a': s.f + s.sk + CASE WHEN s.f > 0 THEN floor(('0x' || substr(md5('42|' || doc_id || '|' || s.k), 1, 7))::INT / 268435456.0::DOUBLE * (greatest(32768 - n - s.sk, 0) + 1))::BIGINT ELSE 0 END,
 'b': p.f + s.sk + CASE WHEN s.f > 0 THEN floor(('0x' || substr(md5('42|' || doc_id || '|' || s.k), 1, 7))::INT / 268435456.0::DOUBLE * (greatest(32768 - n - s.sk, 0) + 1))::BIGINT ELSE 0 END}}]}},
 {{'f': 0::BIGINT, 'sk': 0::BIGINT, 'k': 0, 'parts': [{{'a': 0::BIGINT, 'b': 0::BIGINT}}][1:0]}}).parts AS ps FROM b),
 g AS (SELECT doc_id, n, flatten(list_transform(ps, lambda p: range(p.a, p.b))) AS pos FROM f)
 SELECT doc_id, n AS length, pos[len(pos)] AS sequence_len, {dig('pos')} AS position_ids FROM g""")
def t20(spark, sf):
    rows = once(fx.documents(spark, sf).select("doc_id", "text"), input_ids=tk.token_ids("text"))
    done = lb.skipped_positions(rows, "doc_id", chunk_count=4)
    return done.select("doc_id", "length", "sequence_len", digest("position_ids").alias("position_ids"))


ENC_SQL = CONV + f", enc AS (SELECT conv_id, {_turns_sql(chr(120) + '.role = ' + q('assistant'), chr(120) + '.role = ' + q('assistant'))} FROM c)"


@query("t21_label_weights", f"""WITH {ENC_SQL}, a AS (SELECT conv_id, unnest(l) AS l, unnest(range(len(l))) AS pos FROM enc),
 b AS (SELECT *, sum(CASE WHEN l <> -100 AND (pl IS NULL OR pl = -100) THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY pos) AS isl
 FROM (SELECT *, lag(l) OVER (PARTITION BY conv_id ORDER BY pos) AS pl FROM a)),
 w AS (SELECT conv_id, pos, CASE WHEN l <> -100 THEN 1.0::DOUBLE / count(*) FILTER (l <> -100) OVER (PARTITION BY conv_id, isl) ELSE 0 END AS w FROM b)
 SELECT conv_id, pos, round(w, 6) AS weight FROM w""")
def t21(spark, sf):
    rows = fx.encoded_conversations(spark, sf).withColumn("w", lb.run_weights("labels"))
    return rows.select("conv_id", F.posexplode("w").alias("pos", "weight")).withColumn("weight", r6(F.col("weight")))


@query("t22_label_audit", f"""WITH {ENC_SQL} SELECT conv_id, unnest(range(len(i))) AS pos, unnest(i) AS id, unnest(l) AS label,
 unnest(list_transform(l, lambda z: CASE z WHEN -100 THEN 'masked' WHEN 0 THEN 'zero' ELSE 'trained' END)) AS status FROM enc""")
def t22(spark, sf):
    return lb.label_audit(fx.encoded_conversations(spark, sf), "conv_id")


_PARTS = " UNION ALL ".join(f"SELECT pair_id, '{c}' AS part, unnest(range({count(c)})) AS pos, unnest({words(c)}) AS token FROM p" for c in ("prompt", "chosen", "rejected"))


@query("t22_preference_audit", f"WITH {PAIRS} {_PARTS}")
def t22_preference(spark, sf):
    return lb.preference_audit(fx.pairs(spark, sf), "pair_id")


@query("t23_prompt_completion_split", f"""WITH {ENC_SQL}, a AS (SELECT conv_id, list_transform(list_filter(list_zip(i, l), lambda z: z[2] = -100), lambda z: z[1]) AS p,
 list_filter(l, lambda z: z <> -100) AS o FROM enc) SELECT conv_id, len(p) AS n, {cat('p')} AS prompt_ids, {cat('o')} AS completion_ids FROM a""")
def t23(spark, sf):
    rows = fx.encoded_conversations(spark, sf)
    return out(rows.select("conv_id", *lb.split_labelled("input_ids", "labels")), "conv_id",
               columns=("prompt_ids", "completion_ids"), hashed=False)


@query("t24_classification", f"""WITH a AS (SELECT doc_id, ([1] || {ids('text')})[1:512] AS i, toxic::FLOAT::DOUBLE AS labels FROM documents JOIN labels USING (doc_id))
 SELECT doc_id, len(i) AS n, labels, {dig('i')} AS input_ids FROM a""")
def t24(spark, sf):
    from promptmill.plans.kit import table
    d = fx.documents(spark, sf).join(table(spark, sf, "labels").select("doc_id", "toxic"), "doc_id")
    ids_, label = lb.classification("text", "toxic", 512)
    rows = once(d, input_ids=ids_, labels=label.cast("double"))
    return out(rows, "doc_id", "labels", columns=("input_ids",))


@query("t25_left_truncation", f"""WITH a AS (SELECT conv_id, turn, {words('text')} AS w FROM conversations),
 b AS (SELECT conv_id, turn, w[greatest(len(w) - 31, 1):] AS w FROM a)
 SELECT conv_id, turn, len(w) AS n, array_to_string(w, ' ') AS kept, {cat("list_transform(w, lambda tk: 16 + ('0x' || substr(md5(tk), 1, 7))::INT)")} AS input_ids FROM b""")
def t25(spark, sf):
    kept_ids, kept = tk.keep_last("text", 32)
    rows = fx.turns(spark, sf).select("conv_id", "turn", kept.alias("kept"), kept_ids.alias("input_ids"))
    return out(rows, "conv_id", "turn", "kept", columns=("input_ids",), hashed=False)


T26_STOPS = ("de.", "the.", "en.")


@query("t26_stop_rule", f"""WITH {TOKEN_LOG_SQL}, w AS (SELECT *, string_agg(text, '') OVER (PARTITION BY request_id ORDER BY pos) AS o FROM tl WHERE pos < 100),
 h AS (SELECT *, CASE WHEN pos >= 99 THEN 'length' WHEN id = 2 THEN 'eos_token' WHEN {' OR '.join(f"ends_with(o, {q(s)})" for s in T26_STOPS)}
 THEN 'stop_sequence' END AS reason FROM w)
 SELECT request_id, arg_min(reason, pos) FILTER (reason IS NOT NULL) AS finish_reason,
 coalesce(min(pos) FILTER (reason IS NOT NULL), max(pos)) + 1 AS generated_tokens FROM h GROUP BY request_id""")
def t26(spark, sf):
    return lb.stop_rule(fx.token_log(spark, sf), stops=T26_STOPS, max_new_tokens=100)


@query("t27_top_tokens", f"""WITH {TOKEN_LOG_SQL}, c AS (SELECT request_id, pos // 20 AS step, pos, id, round(logprob, 1) AS logprob FROM tl)
 SELECT * FROM (SELECT request_id, step, pos, id, logprob, rank() OVER (PARTITION BY request_id, step ORDER BY logprob DESC) AS rank FROM c) WHERE rank <= 3""")
def t27(spark, sf):
    log = fx.token_log(spark, sf).select("request_id", F.floor(F.col("pos") / 20).alias("step"), "pos", "id",
                                         F.round("logprob", 1).alias("logprob"))
    return lb.top_tokens(log, 3, ("request_id", "step"))
