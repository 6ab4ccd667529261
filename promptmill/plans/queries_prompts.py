"""Records to prompt text."""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.operators import chat, template as tp
from promptmill.plans import fixtures as fx
from promptmill.plans.kit import (CONV, DOCS, PAIRS, digit, fmt, hex_digit, q, query, rtrim, table, trim,
                                  union, variants)

P01_IN, P01_OUT = "[{lang}/{source}] {instruction}\n{head}\n", "Answer: {text}"


@query("p01_named_template", f"WITH {DOCS} SELECT row_number() OVER (ORDER BY doc_id) - 1 AS id, doc_id, "
       f"{fmt(P01_IN)} AS model_input, {fmt(P01_OUT)} AS label FROM d")
def p01(spark, sf):
    from promptmill.operators.order import ordinal
    return ordinal(tp.named_template(fx.docs(spark, sf), P01_IN, P01_OUT), "doc_id", out="id").select(
        "id", "doc_id", "model_input", "label")


def _instruction_sql(prompter: str, style: str, output: bool) -> str:
    p = tp.PROMPTERS[prompter]
    s = p.style or tp.STYLES[style]

    def side(line: str, turn: str) -> str:
        lead = f"{fmt(s.system, {'system': q(line)})} || " if line else ""
        return lead + fmt(turn)

    text = f"CASE WHEN length(input) > 0 THEN {side(p.system, s.turn)} ELSE {side(p.bare_system, s.bare_turn)} END"
    return f"({text}){' || output' if output else ''}"


@query("p02_instruction_styles", union("d", "doc_id", {
    s: {"prompt": _instruction_sql("alpaca", s, True)} for s in tp.STYLES}, "style", DOCS))
def p02(spark, sf):
    return variants(fx.docs(spark, sf), ["doc_id"], {
        s: {"prompt": tp.instruction_prompt(output="output", style=s)} for s in tp.STYLES}, "style")


P03_CASES = {"unprompted": "instruct", "concise": "instruct", "chat": "chat", "no_system": "instruct",
             "choice_explain": "chat", "choice_concise": "chat"}


@query("p03_prompters", union("d", "doc_id", {
    p: {"prompt": _instruction_sql(p, s, False)} for p, s in P03_CASES.items()}, "prompter", DOCS))
def p03(spark, sf):
    return variants(fx.docs(spark, sf), ["doc_id"], {
        p: {"prompt": tp.instruction_prompt(prompter=p, style=s)} for p, s in P03_CASES.items()}, "prompter")


P04_CASES = [("system", s) for s in tp.STYLES] + [("context", s) for s in tp.CONTEXT_STYLES]


def _system_sql(family: str, style: str) -> str:
    s = tp.CONTEXT_STYLES[style] if family == "context" else tp.STYLES[style]
    return (f"CASE WHEN length(system) > 0 THEN {fmt(s.system)} ELSE '' END || "
            f"CASE WHEN length(input) > 0 THEN {fmt(s.turn)} ELSE {fmt(s.bare_turn)} END")


@query("p04_system_column", union("d", "doc_id", {
    f"{f}/{s}": {"prompt": _system_sql(f, s)} for f, s in P04_CASES}, "kind", DOCS))
def p04(spark, sf):
    return variants(fx.docs(spark, sf), ["doc_id"], {
        f"{f}/{s}": {"prompt": tp.system_prompt(family=f, style=s)} for f, s in P04_CASES})


@query("p05_orca_mini", f"WITH {DOCS} SELECT doc_id, {fmt(tp.ORCA_MINI_TURN)} || output AS prompt FROM d")
def p05(spark, sf):
    return fx.docs(spark, sf).select("doc_id", tp.orca_mini_prompt(output="output").alias("prompt"))


P06_CONFIG = {"field_instruction": "head", "field_output": "text", "field_system": "absent", "system_prompt": "Be brief.",
              "format": "Q: {instruction}\nC: {input}\n", "no_input_format": "Q: {instruction}\n",
              "system_format": "## {system}\n"}


@query("p06_user_defined", f"""WITH {DOCS} SELECT doc_id, '## Be brief.' || chr(10) || 'Q: ' || head || chr(10) ||
 CASE WHEN length(input) > 0 THEN 'C: ' || input || chr(10) ELSE '' END AS prompt, text AS response FROM d""")
def p06(spark, sf):
    return tp.user_defined(fx.docs(spark, sf), P06_CONFIG).select("doc_id", "prompt", "response")


@query("p07_map_instruction", f"""WITH {DOCS} SELECT doc_id, 'output' AS kind, instruction, input, output FROM d
 UNION ALL SELECT doc_id, 'response', instruction, '', text FROM d""")
def p07(spark, sf):
    d = fx.docs(spark, sf)
    with_input = d.select("doc_id", F.lit("output").alias("kind"), *tp.map_instruction(d))
    bare = d.select("doc_id", "instruction", F.col("text").alias("response"))
    return with_input.unionByName(bare.select("doc_id", F.lit("response").alias("kind"),
                                              *tp.map_instruction(bare, "response")))


@query("p08_multiple_choice", union("d", "doc_id", {p: {"prompt": (
    lambda s, p: f"CASE WHEN length(text) > 0 THEN {fmt(s.system, {'system': q(tp.PROMPTERS[p].system)})} || "
    f"{fmt(s.turn, {'instruction': 'instruction', 'input': 'lines'})} END")(
        tp.PROMPTERS[p].style or tp.STYLES["instruct"], p), "answer": "head"}
    for p in ("choice_explain", "choice_concise")}, "kind",
    DOCS.replace("d AS (", "d0 AS (") + """, d AS (SELECT *, array_to_string(list_transform(string_split(text, chr(10)),
 lambda x: '- "' || x || '"'), chr(10)) AS lines FROM d0)"""))
def p08(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", F.col("instruction").alias("question"),
                                    F.split("text", "\n").alias("choices"), F.col("head").alias("solution"))
    mapped = raw.select("doc_id", *tp.map_multiple_choice(raw))
    return variants(mapped, ["doc_id"], {
        p: {"prompt": tp.instruction_prompt(prompter=p), "answer": F.col("output")}
        for p in ("choice_explain", "choice_concise")})


@query("p09_quiz", f"WITH {DOCS} SELECT doc_id, head AS instruction, source AS input, 'what is ' || lang AS output FROM d")
def p09(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", F.col("head").alias("question"), F.col("source").alias("category"),
                                    F.col("lang").alias("answer"))
    return raw.select("doc_id", *tp.map_quiz())


@query("p10_pair_mappers", union("d", "doc_id", {
    **{k: {"instruction": "head", "output": "md5(text)", "system": "''"} for k in tp.PAIR_FIELDS},
    "question_response": {"instruction": "head", "output": "md5(text)", "system": "system"}}, "kind", DOCS))
def p10(spark, sf):
    d = fx.docs(spark, sf).withColumn("answer_md5", F.md5("text"))
    # column names are not case-sensitive, so INSTRUCTION and RESPONSE also serve the lower-case fields
    names = {s for s, _ in tp.PAIR_FIELDS.values()}
    answers = {t for _, t in tp.PAIR_FIELDS.values()} - {"response"}
    raw = d.select("doc_id", F.col("system").alias("system_prompt"), *[F.col("head").alias(n) for n in sorted(names)],
                   *[F.col("answer_md5").alias(n) for n in sorted(answers)])
    cases = {}
    for kind in tp.PAIR_FIELDS:
        i, _, o = tp.map_pair(kind)
        cases[kind] = {"instruction": i, "output": o, "system": F.lit("")}
    i, _, o, s = tp.map_system_pair()
    cases["question_response"] = {"instruction": i, "output": o, "system": s}
    return variants(raw, ["doc_id"], cases)


@query("p11_summarize", f"""WITH {DOCS} SELECT doc_id, 'USER: Summarize the following article as a TL;DR.' || chr(10) || text ||
 chr(10) || 'ASSISTANT:' AS prompt, head AS output FROM d""")
def p11(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", F.col("text").alias("article"), F.col("head").alias("summary"))
    return raw.select("doc_id", *tp.map_pair("summarizetldr")).select(
        "doc_id", tp.instruction_prompt(prompter="summarize").alias("prompt"), "output")


P12_FIELDS = {"article": "text", "context": "text", "question": "head", "unanswerable_question": "instruction",
              "answer": "lang"}


@query("p12_context_qa", union("d", "doc_id", {
    k: {"instruction": fmt(t, P12_FIELDS), "output": fmt(a, P12_FIELDS)} for k, (t, a) in tp.CONTEXT_QA.items()},
    "kind", DOCS))
def p12(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", *[F.col(c).alias(n) for n, c in P12_FIELDS.items()])
    cases = {}
    for k in tp.CONTEXT_QA:
        i, _, o = tp.map_context_qa(k)
        cases[k] = {"instruction": i, "output": o}
    return variants(raw, ["doc_id"], cases)


CRITERIA = ("refusal", "prescriptive_bias", "creativity", "comprehensiveness")
_P13_EVAL = ("(" + " || ".join(f"'{c}: ' || s{c} || chr(10)" for c in sorted(CRITERIA)) + " || " + " || ".join(
    f"'{c}:' || chr(10) || '  explanation: ' || source || chr(10) || '  improvements: ' || lang || chr(10)"
    for c in sorted(CRITERIA)) + ")")
_P13_SQL = (f"WITH {DOCS}, e AS (SELECT *, " + ", ".join(
    f"{digit('md5(doc_id::VARCHAR)', k + 1)} % 11 AS s{c}" for k, c in enumerate(CRITERIA)) + " FROM d), "
    f"v AS (SELECT *, {_P13_EVAL} AS ev FROM e) "
    f"SELECT doc_id, 'answer' AS kind, {fmt(tp.CREATIVE_ANSWER_SYSTEM + chr(10) + tp.CREATIVE_TURN)} AS prompt, head AS output FROM v "
    "UNION ALL SELECT doc_id, 'critique', "
    f"{fmt(tp.CREATIVE_TURN, {'instruction': fmt(tp.CRITIQUE_PROMPT, {'question': 'instruction', 'answer': 'text'})})}, ev FROM v "
    "UNION ALL SELECT doc_id, 'revise', "
    f"{fmt(tp.CREATIVE_TURN, {'instruction': fmt(tp.REVISE_PROMPT, {'question': 'instruction', 'answer': 'text', 'evaluation': 'ev'})})}, head FROM v")


@query("p13_critique_formats", _P13_SQL)
def p13(spark, sf):
    h = F.md5(F.col("doc_id").cast("string"))
    scores = F.struct(*[(hex_digit(h, k + 1) % 11).alias(c) for k, c in enumerate(CRITERIA)])
    notes = F.struct(*[F.struct(F.col("source").alias("explanation"), F.col("lang").alias("improvements")).alias(c)
                       for c in CRITERIA])
    raw = fx.docs(spark, sf).select("doc_id", "instruction", F.col("text").alias("answer"), F.col("head").alias("revision"),
                                    scores.alias("scores"), notes.alias("critiques"))
    cases = {}
    for k in ("answer", "critique", "revise"):
        p, o = tp.map_critique(raw, k)
        cases[k] = {"prompt": p, "output": o}
    return variants(raw, ["doc_id"], cases)


def _p14_sql(style: str) -> str:
    turn, bare, label = tp.REFLECT[style]
    f = {"reflection": "head", "corrected": "corrected"}
    return (f"CASE WHEN length(input) > 0 THEN {fmt(tp.REFLECT_SYSTEM + turn)} ELSE {fmt(tp.REFLECT_BARE_SYSTEM + bare)} END || "
            f"CASE WHEN length(output) > 0 AND length(head) > 0 AND length(corrected) > 0 THEN {fmt(label, f)} ELSE '' END")


@query("p14_reflection", union("d", "doc_id", {s: {"prompt": _p14_sql(s)} for s in tp.REFLECT}, "style",
       DOCS.replace("d AS (", "d0 AS (") + ", d AS (SELECT *, CASE WHEN lang = 'de' THEN '' ELSE upper(source) END AS corrected FROM d0)"))
def p14(spark, sf):
    raw = fx.docs(spark, sf).withColumns({
        "reflection": F.col("head"), "corrected": F.when(F.col("lang") == "de", "").otherwise(F.upper("source"))})
    return variants(raw, ["doc_id"], {s: {"prompt": tp.reflection_prompt(s)} for s in tp.REFLECT}, "style")


@query("p15_dialogue_split", f"WITH {DOCS} SELECT doc_id, instruction || ' ' || head AS input, text AS output FROM d")
def p15(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", F.concat(
        F.lit("<human>: "), "instruction", F.lit(" "), "head", F.lit("\n<bot>: "), "text").alias("text"))
    return tp.format_pairs(raw, "chip2", ["doc_id"])


@query("p16_rename_formats", union("d", "doc_id", {
    "self-instruct": {"input": "head", "output": "text"}, "hh-rlhf": {"input": "''", "output": "text"},
    "oasst1": {"input": "''", "output": "text"}, "input-output": {"input": "input", "output": "output"}}, "kind", DOCS))
def p16(spark, sf):
    raw = fx.docs(spark, sf).withColumns({"prompt": F.col("head"), "completion": F.col("text"), "chosen": F.col("text")})
    parts = [tp.format_pairs(raw, k, ["doc_id"]).withColumn("kind", F.lit(k))
             for k in ("self-instruct", "hh-rlhf", "oasst1", "input-output")]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


P17_FIELDS = {"description": "instruction", "wrong_code": "head", "feedback": "system", "prediction": "source",
              "correct_code": "text", "input_format": "lang", "output_format": "source"}


@query("p17_code_edit_formats", union("d", "doc_id", {
    k: {"input": fmt(i, P17_FIELDS), "output_md5": f"md5({fmt(o, P17_FIELDS)})"} for k, (i, o) in tp.CODE_EDIT.items()},
    "kind", DOCS))
def p17(spark, sf):
    raw = fx.docs(spark, sf).select("doc_id", *[F.col(c).alias(n) for n, c in P17_FIELDS.items()])
    from promptmill.functions.text import fill
    return variants(raw, ["doc_id"], {
        k: {"input": fill(i), "output_md5": F.md5(fill(o))} for k, (i, o) in tp.CODE_EDIT.items()})


@query("p18_column_pruning", f"WITH {DOCS} SELECT {_instruction_sql('alpaca', 'instruct', False)} AS input, output FROM d")
def p18(spark, sf):
    return tp.format_pairs(fx.docs(spark, sf), "alpaca")


RAW_ROLES = {"user": "human", "assistant": "gpt"}
_ROLE_SQL = "CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'gpt' ELSE role END"
_THREAD = "array_to_string(list_transform({m}, lambda x: x.role || '=' || x.content), '|')"


def _raw_roles(spark, sf):
    return fx.turns(spark, sf).withColumn("role", F.coalesce(chat.lookup(RAW_ROLES, F.col("role")), "role"))


@query("p19_conversation_thread", f"""WITH {CONV} SELECT conv_id, {_THREAD.format(m='m')} AS thread,
 coalesce({_THREAD.format(m="CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END")}, '') AS without_system FROM c""")
def p19(spark, sf):
    raw = chat.rollup(_raw_roles(spark, sf))

    def text(m):
        return F.array_join(F.transform(m, lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|")
    return raw.select("conv_id", text(chat.conversation_thread("messages")).alias("thread"),
                      text(chat.conversation_thread("messages", drop_system=True)).alias("without_system"))


@query("p20_legacy_messages", f"WITH {CONV} SELECT conv_id, {_THREAD.format(m='m')} AS messages FROM c")
def p20(spark, sf):
    legacy = chat.rollup(_raw_roles(spark, sf)).withColumn("conversations", F.transform(
        "messages", lambda m: F.struct(m["role"].alias("from"), m["content"].alias("value"))))
    done = legacy.withColumn("messages", chat.legacy_messages("conversations"))
    return done.select("conv_id", F.array_join(F.transform(
        "messages", lambda x: F.concat(x["role"], F.lit("="), x["content"])), "|").alias("messages"))


@query("p21_weighted_messages", f"""WITH {CONV} SELECT conv_id, array_to_string(list_transform(m, lambda x: x.role || ':' ||
 CASE WHEN x.role = 'assistant' THEN 1 ELSE 0 END || ':text:' || x.content), '|') AS messages FROM c""")
def p21(spark, sf):
    m = chat.rollup(_raw_roles(spark, sf)).withColumn("w", chat.weighted_messages("messages"))
    return m.select("conv_id", F.array_join(F.transform("w", lambda x: F.concat(
        x["role"], F.lit(":"), x["weight"].cast("string"), F.lit(":"), x["content"][0]["type"], F.lit(":"),
        x["content"][0]["value"])), "|").alias("messages"))


def _segments_text(s):
    return F.array_join(F.transform(s, lambda x: F.concat(F.lit("["), x["weight"].cast("string"), F.lit("]"), x["text"])), "")


_W = "CASE WHEN x.role = 'assistant' THEN 1 ELSE 0 END"


@query("p22_weighted_segments", union("c", "conv_id", {
    "chatml": {"segments": f"""array_to_string(list_transform(m, lambda x: '[0]<|im_start|>' || x.role || chr(10) || '[' || {_W} || ']' ||
 x.content || '[' || {_W} || ']<|im_end|>[0]' || chr(10)), '')"""},
    "llama3": {"segments": f"""'[0]<|begin_of_text|>' || array_to_string(list_transform(m, lambda x: '[0]<|start_header_id|>' || x.role ||
 '<|end_header_id|>' || chr(10) || chr(10) || '[' || {_W} || ']' || x.content || '[' || {_W} || ']<|eot_id|>'), '')"""}},
    "markup", CONV))
def p22(spark, sf):
    m = fx.conversations(spark, sf).withColumn("w", chat.weighted_messages("messages"))
    return variants(m, ["conv_id"], {
        k: {"segments": _segments_text(chat.weighted_segments("w", k))} for k in ("chatml", "llama3")}, "markup")


@query("p23_tool_wrapping", f"""WITH c AS (SELECT conv_id, list({{'role': role, 'content': text,
 'kind': CASE WHEN role = 'assistant' AND length(text) % 2 = 0 THEN 'tool_call' WHEN role = 'user' AND length(text) % 2 = 0
 THEN 'tool_response' ELSE 'text' END}} ORDER BY turn) AS m FROM conversations GROUP BY conv_id)
 SELECT conv_id, array_to_string(list_transform(m, lambda x: '[0]<|im_start|>' || x.role || chr(10) ||
 CASE WHEN x.kind = 'text' THEN '[' || {_W} || ']' || x.content ELSE '[' || {_W} || ']<' || x.kind || '>' || chr(10) || '[' || {_W} || ']' ||
 x.content || CASE WHEN ends_with(x.content, chr(10)) THEN '' ELSE chr(10) END || '[' || {_W} || ']</' || x.kind || '>' || chr(10) END ||
 '[' || {_W} || ']<|im_end|>[0]' || chr(10)), '') AS segments FROM c""")
def p23(spark, sf):
    even = F.length("text") % 2 == 0
    kind = (F.when((F.col("role") == "assistant") & even, "tool_call")
            .when((F.col("role") == "user") & even, "tool_response").otherwise("text"))
    m = chat.rollup(fx.turns(spark, sf).withColumn("kind", kind), extra=("kind",))
    weighted = F.transform("messages", lambda x: F.struct(
        x["role"].alias("role"),
        F.array(F.struct(x["kind"].alias("type"), x["content"].alias("value"),
                         (x["role"] == "assistant").cast("int").alias("weight"))).alias("content"),
        (x["role"] == "assistant").cast("int").alias("weight")))
    return m.select("conv_id", _segments_text(chat.weighted_segments(weighted, "chatml")).alias("segments"))


def template_parts_sql(name: str, gen: bool, m: str = "m") -> dict[str, str]:
    """A named chat template over a list of {role, content} in SQL: leads, turns, opening, piece of x, closing, refused."""
    t = chat.CHAT_TEMPLATES[name]
    sp = {"bos": "'<s>'", "eos": "'</s>'"}
    leads = f"coalesce({m}[1].role = 'system', false)"
    turns = f"(CASE WHEN {leads} THEN {m}[2:] ELSE {m} END)" if t.system else m
    content = trim("x.content") if t.stripped else "x.content"
    shown = "x.role"
    for a, b in t.rename.items():
        shown = f"CASE WHEN x.role = {q(a)} THEN {q(b)} ELSE x.role END"
    whens = []
    for role, (before, after) in t.roles.items():
        body = f"{fmt(before, sp)} || {content} || {fmt(after, sp)}"
        if role in t.skip_empty:
            body = f"CASE WHEN length(x.content) > 0 THEN {body} ELSE '' END"
        whens.append(f"WHEN x.role = {q(role)} THEN {body}")
    rest = "''"
    if t.any_role:
        f = {**sp, "role": shown}
        rest = f"{fmt(t.any_role[0], f)} || {content} || {fmt(t.any_role[1], f)}"
    piece = f"CASE {' '.join(whens)} ELSE {rest} END" if whens else rest
    opening = [fmt(t.start, sp)]
    if t.system:
        given = trim(f"{m}[1].content") if t.stripped_system else f"{m}[1].content"
        default = "''" if t.default_system is None else q(t.system[0] + t.default_system + t.system[1])
        opening.append(f"CASE WHEN {leads} THEN {q(t.system[0])} || {given} || {q(t.system[1])} ELSE {default} END")
    if t.start_without_system:
        opening.append(f"CASE WHEN {leads} THEN '' ELSE {q(t.start_without_system)} END")
    refused = ["false"]
    if t.alternate:
        refused.append(f"len(list_filter(list_transform({turns}, lambda x, i: (x.role = 'user') <> (i % 2 = 1)), lambda b: b)) > 0")
    if t.refuse_system:
        refused.append(leads)
    if t.refuse_unknown:
        refused.append(f"len(list_filter({turns}, lambda x: x.role NOT IN ({', '.join(q(r) for r in t.roles)}))) > 0")
    return {"taken": leads if t.system else "false", "turns": turns, "opening": " || ".join(opening), "piece": piece,
            "closing": q(t.generation) if gen else fmt(t.end, sp), "refused": " OR ".join(refused)}


def template_sql(name: str, gen: bool, m: str = "m") -> str:
    """The whole text of a conversation in a named chat template."""
    p = template_parts_sql(name, gen, m)
    return (f"CASE WHEN NOT ({p['refused']}) THEN {p['opening']} || coalesce(array_to_string(list_transform({p['turns']}, "
            f"lambda x: {p['piece']}), ''), '') || {p['closing']} END")


P24_CASES = [(n, g) for n in chat.CHAT_TEMPLATES for g in (False, True)]


@query("p24_chat_templates", union("c", "conv_id", {
    f"{n}/{int(g)}": {"text": template_sql(n, g)} for n, g in P24_CASES}, "template", CONV))
def p24(spark, sf):
    return variants(fx.conversations(spark, sf), ["conv_id"], {
        f"{n}/{int(g)}": {"text": chat.render_chat("messages", n, g)} for n, g in P24_CASES}, "template")


INST_CTE = (CONV + ", c1 AS (SELECT conv_id, m, CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END AS rest FROM c), "
            "c2 AS (SELECT *, CASE WHEN rest[1].role <> 'user' THEN rest[2:] ELSE rest END AS st FROM c1), "
            "c3 AS (SELECT *, CASE WHEN st[len(st)].role = 'user' THEN st[1:len(st) - 1] ELSE st END AS kept, "
            "len(rest) >= 2 AND len(list_filter(list_transform(st, lambda x, i: (x.role = 'user') <> (i % 2 = 1)), lambda b: b)) = 0 AS ok FROM c2), "
            "c4 AS (SELECT conv_id, ok, flatten(list_transform(kept, lambda x, i: CASE WHEN i = 1 THEN [{'text': '[INST] <<SYS>>' || chr(10) || "
            f"CASE WHEN m[1].role = 'system' THEN m[1].content ELSE {q(chat.INST_DEFAULT_SYSTEM)} END || chr(10) || '<</SYS>>' || chr(10) || chr(10) || "
            f"{trim('x.content')}, 'trains': false}}] WHEN i % 2 = 1 THEN [{{'text': '[INST] ' || {trim('x.content')} || ' ', 'trains': false}}] "
            f"ELSE [{{'text': '[/INST]', 'trains': false}}, {{'text': ' ' || {trim('x.content')} || ' </s><s>', 'trains': true}}] END)) AS seg FROM c3)")


@query("p25_inst_chat", f"""WITH {INST_CTE} SELECT conv_id, CASE WHEN ok THEN
 coalesce(array_to_string(list_transform(seg, lambda s: s.text), ''), '') END AS prompt FROM c4""")
def p25(spark, sf):
    return fx.conversations(spark, sf).select("conv_id", chat.inst_prompt("messages").alias("prompt"))


PERSONA_ROLE_SQL = "CASE role WHEN 'user' THEN 'human' WHEN 'assistant' THEN 'bot' ELSE role END"
PERSONA_SQL = ("c AS (SELECT conv_id, list({'role': " + PERSONA_ROLE_SQL + ", 'text': CASE role WHEN 'system' THEN '<|system|>Persona: ' "
               f"WHEN 'user' THEN '<|user|> ' ELSE '<|model|> ' END || {trim('text')}}} ORDER BY turn) AS m "
               "FROM conversations GROUP BY conv_id)")


@query("p26_persona_chat", f"WITH {PERSONA_SQL} SELECT conv_id, array_to_string(list_transform(m, lambda x: x.role || '=' || x.text), '|') AS segments FROM c")
def p26(spark, sf):
    t = fx.turns(spark, sf)
    marked = t.withColumn("text", F.when(F.col("role") == "system", F.concat("text", F.lit("\n<START>"))).otherwise(F.col("text")))
    return chat.rollup(marked).select("conv_id", F.array_join(F.transform(
        chat.persona_segments("messages"), lambda s: F.concat(s["role"], F.lit("="), s["text"])), "|").alias("segments"))


@query("p27_raw_segments", "SELECT conv_id, turn AS pos, text, (role = 'assistant')::INT AS label FROM conversations")
def p27(spark, sf):
    segments = fx.conversations(spark, sf).withColumn("segments", F.transform("messages", lambda m: F.struct(
        m["content"].alias("text"), (m["role"] == "assistant").alias("label"))))
    return segments.select("conv_id", F.posexplode("segments").alias("pos", "s")).select(
        "conv_id", "pos", "s.text", F.col("s.label").cast("int").alias("label"))


def _marked_sql(markup: str, prompt: str = "prompt") -> str:
    m = tp.MARKUPS[markup]
    return f"CASE WHEN length(system) > 0 THEN {fmt(m.system)} ELSE '' END || {fmt(m.user, {'prompt': prompt})}"


P28_CASES = [(s, m) for s in tp.PAIR_SHAPES for m in tp.MARKUPS]


@query("p28_preference_flat", union("p", "pair_id", {
    f"{s}/{m}": {"prompt": _marked_sql(m), "chosen": f"chosen || {q(tp.MARKUPS[m].end)}",
                 "rejected": f"rejected || {q(tp.MARKUPS[m].end)}"} for s, m in P28_CASES}, "kind", PAIRS))
def p28(spark, sf):
    p = fx.pairs(spark, sf).withColumns({"instruction": F.col("prompt"), "input": F.col("prompt"), "question": F.col("prompt"),
                                         "chosen_response": F.col("chosen"), "rejected_response": F.col("rejected")})
    cases = {}
    for s, m in P28_CASES:
        a, b, c = tp.preference_pair(p, s, m)
        cases[f"{s}/{m}"] = {"prompt": a, "chosen": b, "rejected": c}
    return variants(p, ["pair_id"], cases)


def _as_messages(p):
    def two(answer):
        return F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content")),
                       F.struct(F.lit("assistant").alias("role"), F.col(answer).alias("content")))
    return p.withColumns({"chosen": two("chosen"), "rejected": two("rejected")})


P29_CASES = [(s, m) for s in ("argilla_chat", "ultra") for m in tp.MARKUPS]


@query("p29_preference_messages", union("p", "pair_id", {
    f"{s}/{m}": {"prompt": _marked_sql(m) if s == "ultra" else fmt(tp.MARKUPS[m].user),
                 "chosen": f"chosen || {q(tp.MARKUPS[m].end)}", "rejected": f"rejected || {q(tp.MARKUPS[m].end)}"}
    for s, m in P29_CASES}, "kind", PAIRS))
def p29(spark, sf):
    p = _as_messages(fx.pairs(spark, sf))
    cases = {}
    for s, m in P29_CASES:
        a, b, c = tp.preference_pair(p, s, m)
        cases[f"{s}/{m}"] = {"prompt": a, "chosen": b, "rejected": c}
    return variants(p, ["pair_id"], cases)


_RANKED = ("a AS (SELECT pair_id, prompt, list_sort([{'rank': " + digit("md5(pair_id::VARCHAR)", 1) + ", 'i': 0, 'answer': chosen}, {'rank': "
           + digit("md5(pair_id::VARCHAR)", 2) + ", 'i': 1, 'answer': rejected}, {'rank': " + digit("md5(pair_id::VARCHAR)", 3)
           + ", 'i': 2, 'answer': prompt}]) AS a FROM p)")


@query("p30_ranked_answers", f"""WITH {PAIRS}, {_RANKED} SELECT pair_id, 'last' AS best, {fmt(tp.RANKED_PROMPT)} AS prompt,
 a[3].answer AS chosen, a[2].answer AS rejected FROM a UNION ALL SELECT pair_id, 'first', {fmt(tp.RANKED_PROMPT)}, a[1].answer, a[2].answer FROM a""")
def p30(spark, sf):
    h = F.md5(F.col("pair_id").cast("string"))
    p = fx.pairs(spark, sf).withColumn("answers", F.array(*[
        F.struct(hex_digit(h, k + 1).alias("rank"), F.col(c).alias("answer"))
        for k, c in enumerate(("chosen", "rejected", "prompt"))]))
    cases = {}
    for best in ("last", "first"):
        a, b, c = tp.ranked_pair(best=best)
        cases[best] = {"prompt": a, "chosen": b, "rejected": c}
    return variants(p, ["pair_id"], cases, "best")


P31_CONFIG = {"field_prompt": "question", "prompt_format": "<sys>{system}</sys>{prompt}", "chosen_format": "good: {chosen}",
              "field_rejected": "bad"}


@query("p31_preference_user_defined", f"""WITH {PAIRS} SELECT pair_id, '<sys>' || system || '</sys>' || prompt AS prompt,
 'good: ' || chosen AS chosen, rejected FROM p""")
def p31(spark, sf):
    p = fx.pairs(spark, sf).withColumnsRenamed({"prompt": "question", "rejected": "bad"})
    return p.select("pair_id", *tp.user_defined_pair(p, P31_CONFIG))


P32_TEMPLATES = ("chatml", "llama3", "phi_35", "jamba")


def _answer_sql(name: str, answer: str) -> str:
    t = chat.CHAT_TEMPLATES[name]
    after = t.roles["assistant"][1] if "assistant" in t.roles else t.any_role[1]
    body = trim(answer) if t.stripped else answer
    return rtrim(f"({body} || {q(after)})")


@query("p32_preference_chat_template", union("p1", "pair_id", {
    n: {"prompt": template_sql(n, True), "chosen": _answer_sql(n, "chosen"), "rejected": _answer_sql(n, "rejected")}
    for n in P32_TEMPLATES}, "template", PAIRS + ", p1 AS (SELECT *, [{'role': 'user', 'content': prompt}] AS m FROM p)"))
def p32(spark, sf):
    p = fx.pairs(spark, sf).withColumn("messages", F.array(F.struct(F.lit("user").alias("role"), F.col("prompt").alias("content"))))
    return variants(p, ["pair_id"], {n: {
        "prompt": chat.render_chat("messages", n, add_generation_prompt=True), "chosen": chat.answer_text("chosen", n),
        "rejected": chat.answer_text("rejected", n)} for n in P32_TEMPLATES}, "template")


P33_CASES = [(s, m) for s in (*tp.UNPAIRED_SHAPES, "argilla_chat") for m in tp.MARKUPS]
P33_CONFIG = {"field_completion": "answer", "completion_format": "A: {completion}", "prompt_format": "{system}|{prompt}", "field_label": "good"}
_P33_LABEL = f"({digit('md5(pair_id::VARCHAR)', 4)} < 8)::INT"


@query("p33_unpaired", union("p", "pair_id", {
    **{f"{s}/{m}": {"prompt": fmt(tp.MARKUPS[m].user) if s == "argilla_chat" else _marked_sql(m),
                    "completion": f"chosen || {q(tp.MARKUPS[m].end)}", "label": _P33_LABEL} for s, m in P33_CASES},
    "user_defined": {"prompt": "system || '|' || prompt", "completion": "'A: ' || chosen", "label": _P33_LABEL}}, "kind", PAIRS))
def p33(spark, sf):
    p = fx.pairs(spark, sf).withColumn("label", hex_digit(F.md5(F.col("pair_id").cast("string")), 4) < 8)
    flat = p.withColumns({"instruction": F.col("prompt"), "question": F.col("prompt"), "completion": F.col("chosen"),
                          "answer": F.col("chosen"), "good": F.col("label")})
    nested = _as_messages(p).withColumn("completion", F.col("chosen"))
    cases, nested_cases = {}, {}
    for s, m in P33_CASES:
        source, into = (nested, nested_cases) if s == "argilla_chat" else (flat, cases)
        a, b, c = tp.unpaired_preference(source, s, m)
        into[f"{s}/{m}"] = {"prompt": a, "completion": b, "label": c.cast("int")}
    a, b, c = tp.user_defined_unpaired(flat, P33_CONFIG)
    cases["user_defined"] = {"prompt": a, "completion": b, "label": c.cast("int")}
    return variants(flat, ["pair_id"], cases).unionByName(variants(nested, ["pair_id"], nested_cases))


def _im(role: str, content: str) -> str:
    return f"'<|im_start|>{role}' || chr(10) || {content} || '<|im_end|>' || chr(10)"


@query("p34_odds_ratio_format", f"""WITH {CONV}, t AS (SELECT conv_id, CASE WHEN m[1].role = 'system' THEN m[2:] ELSE m END AS k,
 CASE WHEN m[1].role = 'system' THEN m[1].content ELSE '' END AS system FROM c)
 SELECT conv_id, CASE WHEN len(k) % 2 = 0 THEN CASE WHEN length(system) > 0 THEN {_im('system', 'system')} ELSE '' END ||
 coalesce(array_to_string(list_transform(k[1:len(k) - 1], lambda x: '<|im_start|>' || x.role || chr(10) || x.content || '<|im_end|>' || chr(10)), ''), '') ||
 '<|im_start|>assistant' || chr(10) END AS prompt,
 CASE WHEN len(k) % 2 = 0 THEN k[len(k)].content || '<|im_end|>' || chr(10) END AS chosen,
 CASE WHEN len(k) % 2 = 0 THEN 'No: ' || k[1].content || '<|im_end|>' || chr(10) END AS rejected FROM t""")
def p34(spark, sf):
    m = fx.conversations(spark, sf)
    leads = F.col("messages")[0]["role"] == "system"
    talk = F.when(leads, chat.tail(F.col("messages"))).otherwise(F.col("messages"))
    rows = m.select("conv_id", F.when(leads, F.col("messages")[0]["content"]).otherwise("").alias("system"),
                    talk.alias("chosen"))
    rows = rows.withColumn("rejected", F.concat(
        F.slice("chosen", 1, F.greatest(F.size("chosen") - 1, F.lit(0))),
        F.array(F.struct(F.lit("assistant").alias("role"), F.concat(F.lit("No: "), F.col("chosen")[0]["content"]).alias("content")))))
    return rows.select("conv_id", *tp.odds_ratio_format(rows))


@query("p35_reward_pair", union("p", "pair_id", {m: {
    "chosen": f"{_marked_sql(m)} || chosen || {q(tp.MARKUPS[m].end)}",
    "rejected": f"{_marked_sql(m)} || rejected || {q(tp.MARKUPS[m].end)}"} for m in tp.MARKUPS}, "markup", PAIRS))
def p35(spark, sf):
    p = fx.pairs(spark, sf).withColumn("input", F.col("prompt"))
    return variants(p, ["pair_id"], {m: dict(zip(("chosen", "rejected"), tp.reward_pair(p, m))) for m in tp.MARKUPS}, "markup")


@query("p36_question_pair", union("p", "pair_id", {k: {
    "prompt": "'Question: ' || prompt || chr(10) || chr(10) || 'Answer: '", "chosen": "chosen", "rejected": "rejected"}
    for k in ("responses", "model")}, "kind", PAIRS))
def p36(spark, sf):
    p = fx.pairs(spark, sf).withColumns({
        "question": F.col("prompt"), "response_j": F.col("chosen"), "response_k": F.col("rejected"),
        "label": F.col("chosen"), "prediction": F.col("rejected")})
    return variants(p, ["pair_id"], {k: dict(zip(("prompt", "chosen", "rejected"), tp.question_pair(k))) for k in ("responses", "model")})


@query("p37_correction_prompt", union("p", "pair_id", {
    "feedback": {"model_input": "prompt || rejected || chr(10)"},
    "refine": {"model_input": "prompt || rejected || chr(10) || 'Correct code:' || chr(10)"}}, "kind", PAIRS))
def p37(spark, sf):
    p = fx.pairs(spark, sf)
    requests = p.select("pair_id", F.col("prompt").alias("model_input"))
    feedback = p.select("pair_id", F.col("rejected").alias("prediction"))
    parts = [tp.correction_prompt(requests, feedback, "pair_id", k).select("pair_id", F.lit(k).alias("kind"), "model_input")
             for k in tp.CORRECTION_MARKS]
    return parts[0].unionByName(parts[1])


JUDGE_PROMPT = ("[Question]\n{question}\n\n[The Start of Assistant 1's Answer]\n{answer_1}\n\n[The End of Assistant 1's Answer]\n\n"
                "[The Start of Assistant 2's Answer]\n{answer_2}\n\n[The End of Assistant 2's Answer]\n\n[System]\n{prompt}\n\n")
JUDGES_SQL = "j AS (SELECT r_regionkey + 1 AS reviewer_id, r_name AS category, 'Judge for ' || r_name AS prompt FROM region)"


def judges(spark, sf):
    return table(spark, sf, "region").select(
        (F.col("r_regionkey") + 1).alias("reviewer_id"), F.col("r_name").alias("category"),
        F.concat(F.lit("Judge for "), "r_name").alias("prompt"))


def categorised(spark, sf):
    """Documents as questions; the category is a region name, or one no judge has."""
    names = F.array(*[F.lit(n) for n in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST", "MARS", "VENUS")])
    return fx.docs(spark, sf).withColumn("category", names[hex_digit(F.md5(F.col("doc_id").cast("string")), 1, 2) % 7])


CATEGORISED_SQL = DOCS + (", qc AS (SELECT *, (['AFRICA','AMERICA','ASIA','EUROPE','MIDDLE EAST','MARS','VENUS'])"
                          f"[{digit('md5(doc_id::VARCHAR)', 1, 2)} % 7 + 1] AS category FROM d)")


@query("p38_judge_prompt", f"""WITH {CATEGORISED_SQL}, {JUDGES_SQL} SELECT doc_id, coalesce(j.reviewer_id, 1) AS reviewer_id,
 {fmt(JUDGE_PROMPT, {'question': 'instruction', 'answer_1': 'head', 'answer_2': 'text',
                     'prompt': "coalesce(j.prompt, (SELECT prompt FROM j WHERE reviewer_id = 1))"})} AS judge_prompt
 FROM qc LEFT JOIN j ON qc.category = j.category""")
def p38(spark, sf):
    from promptmill.functions.text import fill
    from promptmill.operators.evaluate import with_default
    found = with_default(categorised(spark, sf), judges(spark, sf), "category", "category", "reviewer_id", ["reviewer_id", "prompt"])
    return found.select("doc_id", "reviewer_id", fill(JUDGE_PROMPT, {
        "question": "instruction", "answer_1": "head", "answer_2": "text"}).alias("judge_prompt"))


@query("p39_subject_normalise", """SELECT doc_id, replace(lower(source || '-' || upper(lang)), '-', '_') AS name,
 CASE WHEN lang = 'en' THEN 'all' ELSE replace('Sub-' || source, '-', '_') END AS subject FROM documents""")
def p39(spark, sf):
    raw = F.concat("source", F.lit("-"), F.upper("lang"),
                   F.when(F.col("lang") == "en", "").otherwise(F.concat(F.lit(" : Sub-"), "source")))
    return fx.documents(spark, sf).withColumn("raw", raw).select("doc_id", *tp.normalise_subject("raw"))
