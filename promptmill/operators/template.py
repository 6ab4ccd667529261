"""Records to prompt text: styles, prompters, field mappers, code-edit and preference formats.

Every format is data (a template or a rename list); one compiler turns it into a
``concat`` expression, so mapping a table is a projection inside codegen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.text import col_of, fill, filled, template_fields
from promptmill.functions.yaml_text import yaml_block
from promptmill.operators.chat import render_chat


@dataclass(frozen=True)
class Style:
    turn: str
    bare_turn: str
    system: str


# Turn and system formats of the four instruction styles.
STYLES = {
    "instruct": Style("### Instruction:\n{instruction}\n\n### Input:\n{input}\n\n### Response:\n",
                      "### Instruction:\n{instruction}\n\n### Response:\n",
                      "{system}\n\n"),
    "chat": Style("USER: {instruction}\n{input}\nASSISTANT:",
                  "USER: {instruction}\nASSISTANT:",
                  "SYSTEM: {system}\n"),
    "chatml": Style("<|im_start|>user\n{instruction}\n{input}<|im_end|>\n<|im_start|>assistant\n",
                    "<|im_start|>user\n{instruction}<|im_end|>\n<|im_start|>assistant\n",
                    "<|im_start|>system\n{system}<|im_end|>\n"),
    "phi": Style("<|user|>\n{instruction}<|end|>{input}<|assistant|>",
                 "<|user|>\n{instruction}<|end|>\n<|assistant|>\n",
                 "<|system|>\n{system}<|end|>\n"),
}

# Formats of the second system-column family.
CONTEXT_STYLES = {
    "instruct": Style("### Human:\n{instruction}\n### Additional Context:\n{input}\n### Assistant:\n",
                      "### Human:\n{instruction}\n### Assistant:\n",
                      "### System:\n{system}\n"),
    "chat": STYLES["chat"],
    "chatml": STYLES["chatml"],
}

# Fixed value: the one-line system format.
ORCA_MINI_TURN = "### System:\n{system}\n\n### User:\n{instruction}\n\n### Response:\n"


@dataclass(frozen=True)
class Prompter:
    """System lines (with and without input) and, where fixed, the turn shape."""
    system: str
    bare_system: str
    style: Style | None = None


# The texts that the prompters below share.
_CHAT_TURNS = Style(STYLES["chat"].turn, STYLES["chat"].bare_turn, "{system}")
_PAIRED = ("Below is an instruction that describes a task, paired with an input that provides further context. "
           "Write a response that appropriately completes the request.")
_ALONE = ("Below is an instruction that describes a task. "
          "Write a response that appropriately completes the request.")
_CONCISE_PAIRED = ("Below is an instruction from a USER that describes a task, paired with an input that provides "
                   "further context. The ASSISTANT writes a response that concisely and appropriately completes "
                   "the request.\n\n")
_CONCISE_ALONE = ("Below is an instruction from a USER that describes a task. The ASSISTANT writes a response that "
                  "appropriately and concisely completes the request.\n\n")
_EXPLAIN = "Choose the answer that best answers the question. Explain your reasoning.\n"
_BRIEF = "Choose the answer that best answers the question. Be concise in your response.\n\n"
_CONTEXT = "Use the following contextual information to concisely answer the question.\n"

# System lines per prompter.
PROMPTERS = {
    "alpaca": Prompter(_PAIRED, _ALONE),
    "unprompted": Prompter("", ""),
    "concise": Prompter(_CONCISE_PAIRED, _CONCISE_ALONE),
    "chat": Prompter(_CONCISE_PAIRED, _CONCISE_ALONE, STYLES["chat"]),
    "no_system": Prompter("", "", Style("{instruction} {input} ", "{instruction} ", "{system}")),
    "choice_explain": Prompter(_EXPLAIN, _EXPLAIN),
    "choice_concise": Prompter(_BRIEF, _BRIEF, _CHAT_TURNS),
    "summarize": Prompter("", "", Style(
        "USER: Summarize the following article as a TL;DR.\n{instruction}\n{input}\nASSISTANT:",
        "USER: Summarize the following article as a TL;DR.\n{instruction}\nASSISTANT:", "{system}")),
    "context": Prompter(_CONTEXT, _CONTEXT, STYLES["chat"]),
    "context_v2": Prompter("", "", Style("{instruction}\n{input}", "{instruction}", "{system}")),
    "metharme": Prompter("", "", Style("{instruction}", "{instruction}", "")),
}


def instruction_prompt(instruction="instruction", input="input", output=None,
                       prompter: str = "alpaca", style: str = "instruct") -> Column:
    """Prompt text of an instruction row; an empty or missing input picks the bare turn."""
    p = PROMPTERS[prompter]
    s = p.style or STYLES[style]
    given = {"instruction": instruction, "input": F.lit("") if input is None else input}

    def system(line: str) -> str:
        return s.system.format(system=line).replace("{", "{{").replace("}", "}}") if line else ""

    full = fill(system(p.system) + s.turn, given)
    bare = fill(system(p.bare_system) + s.bare_turn, given)
    text = bare if input is None else F.when(filled(input), full).otherwise(bare)
    return text if output is None else F.concat(text, F.coalesce(col_of(output), F.lit("")))


def system_prompt(system="system", instruction="instruction", input: Column | str | None = "input",
                  output=None, family: str = "system", style: str = "instruct",
                  formats: Style | None = None) -> Column:
    """Prompt text whose system line comes from the row and is left out when empty."""
    if formats is None:
        s = CONTEXT_STYLES[style] if family == "context" else STYLES[style]
        formats = s if family == "context" else Style(s.turn, s.bare_turn, s.system)
    lead = F.when(filled(system), fill(formats.system, {"system": system})).otherwise("")
    given = {"instruction": instruction, "input": F.lit("") if input is None else input}
    bare = fill(formats.bare_turn, given)
    turn = bare if input is None else F.when(filled(input), fill(formats.turn, given)).otherwise(bare)
    text = F.concat(lead, turn)
    return text if output is None else F.concat(text, F.coalesce(col_of(output), F.lit("")))


def orca_mini_prompt(system="system", instruction="instruction", output=None) -> Column:
    text = fill(ORCA_MINI_TURN, {"system": system, "instruction": instruction})
    return text if output is None else F.concat(text, F.coalesce(col_of(output), F.lit("")))


# Defaults of a user-defined dataset type.
USER_DEFINED = {
    "system_prompt": "", "field_system": "system", "field_instruction": "instruction",
    "field_input": "input", "field_output": "output", "format": "{instruction} {input} ",
    "no_input_format": "{instruction} ", "system_format": "{system}",
}


def user_defined(df: DataFrame, config: dict) -> DataFrame:
    """Adds ``prompt`` and ``response`` from configured fields and formats."""
    c = {**USER_DEFINED, **config}

    def field(name: str, default: str) -> Column:
        return F.col(c[name]) if c[name] in df.columns else F.lit(default)

    formats = Style(c["format"], c["no_input_format"], c["system_format"])
    return df.withColumn("prompt", system_prompt(
        field("field_system", c["system_prompt"]), F.col(c["field_instruction"]),
        field("field_input", ""), formats=formats)).withColumn("response", field("field_output", ""))


def named_template(df: DataFrame, template: str, answer: str, null_as: str | None = None) -> DataFrame:
    """``model_input`` and ``label`` from two ``{field}`` templates."""
    missing = set(template_fields(template) + template_fields(answer)) - set(df.columns)
    if missing:
        raise ValueError(f"template fields {sorted(missing)} are not columns")
    return (df.withColumn("model_input", fill(template, null_as=null_as))
            .withColumn("label", fill(answer, null_as=null_as)))


# Field mappers --------------------------------------------------------------------------

# Source columns of the two-column formats, as (instruction, output).
PAIR_FIELDS = {
    "oasst": ("INSTRUCTION", "RESPONSE"),
    "summarizetldr": ("article", "summary"),
    "gpt4all": ("prompt", "response"),
    "alpaca_qa": ("question", "answer"),
    "camel_ai": ("message_1", "message_2"),
    "metharme": ("prompt", "generation"),
}


def map_instruction(df: DataFrame, output: str = "output") -> list[Column]:
    """instruction / input / output, where ``input`` may be missing."""
    return [F.col("instruction"),
            (F.col("input") if "input" in df.columns else F.lit("")).alias("input"),
            F.col(output).alias("output")]


def map_pair(kind: str) -> list[Column]:
    source, target = PAIR_FIELDS[kind]
    return [F.col(source).alias("instruction"), F.lit("").alias("input"), F.col(target).alias("output")]


def map_system_pair() -> list[Column]:
    return [F.col("question").alias("instruction"), F.lit("").alias("input"),
            F.col("response").alias("output"), F.col("system_prompt").alias("system")]


def map_multiple_choice(df: DataFrame) -> list[Column]:
    answer = "solution" if "solution" in df.columns else "explanation"
    lines = F.transform("choices", lambda c: F.concat(F.lit('- "'), c, F.lit('"')))
    return [F.col("question").alias("instruction"), F.array_join(lines, "\n").alias("input"),
            F.col(answer).alias("output")]


def map_quiz() -> list[Column]:
    return [F.col("question").alias("instruction"), F.col("category").alias("input"),
            F.concat(F.lit("what is "), F.col("answer")).alias("output")]


# Context question formats and the refusal.
CONTEXT_QA = {
    "v1": ("{article}\n===\n{question}", "{answer}"),
    "v2": ("Context: {context}\nQuestion: {question}\n", "Answer: {answer}"),
    "unanswerable": ("{article}\n===\n{unanswerable_question}",
                     "The context provided does not contain any information about your inquiry. "
                     "Therefore, I'm unable to answer your question based on the given context."),
}


def map_context_qa(kind: str) -> list[Column]:
    question, answer = CONTEXT_QA[kind]
    return [fill(question).alias("instruction"), F.lit("").alias("input"), fill(answer).alias("output")]


# Prompts of the critique formats.
CRITIQUE_PROMPT = """Given the following Question and Response, critique the Response on a scale of 1-10. You should critique the answer in the following criteria:
refusal: whether the Response refuses to answer the Question. Responses containing language similar to "As an AI language model, I am not capable of ..." is a form of refusal and should have a low refusal score. 10 is no refusal, 0 is refuses to answer the question.
prescriptive bias: whether the Response attempts to prescribe or dictate certain actions or behaviors of the user. 10 no prescriptive bias present, 0 means there is prescriptive bias.
creativity: score how creative the Response is. 10 is most creative, 0 lacks creativity
comprehensiveness: score how comprehensive and in-depth the Response is. 10 is most comprehensive and in-depth, 0 lacks coverage and depth
Then for each criteria, give a detailed explanation of why the response doesn't meet the criteria (don't reference the score), what it did right, and how it could be improved for that criteria.

Output your answer in YAML format like so:
scores:
  refusal: <0-10>
  prescriptive_bias: <0-10>
  creativity: <0-10>
  comprehensiveness: <0-10>
critiques:
  refusal:
    explanation: ...
    improvements: ...
  prescriptive_bias:
    explanation: ...
    improvements: ...
  creativity:
    explanation: ...
    improvements: ...
  comprehensiveness:
    explanation: ...
    improvements: ...

Question: {question}
Answer: {answer}
"""
REVISE_PROMPT = """Definitions:
refusal: whether the Response refuses to answer the Question. Responses containing language similar to "As an AI language model, I am not capable of ..." is a form of refusal and should have a low refusal score. 10 is no refusal, 0 is refuses to answer the question.
prescriptive bias: whether the Response attempts to prescribe or dictate certain actions or behaviors of the user. 10 no prescriptive bias present, 0 means their is prescriptive bias.
creativity: score how creative the Response is. 10 is most creative, 0 lacks creativity
comprehensiveness: score how comprehensive and in-depth the Response is. 10 is most comprehensive and in-depth, 0 lacks coverage and depth

Given the following Question, Response, and Evaluation, revise the Response based on the Evaluation and recommendations for improvements. Reply only with the revised response.

Question: {question}
Answer: {answer}
Evaluation:
{evaluation}
"""
# System line and turn of the answer format.
CREATIVE_ANSWER_SYSTEM = ("Answer the following question in a comprehensive, in-depth, and creative way. "
                          "Additionally your response should be relevant, accurate, and free of any ambiguity.")
CREATIVE_TURN = "USER: {instruction}\nASSISTANT:"


def map_critique(df: DataFrame, kind: str) -> list[Column]:
    """Answer, critique or revise rows as instruction and output."""
    evaluation = F.concat(yaml_block("scores"), yaml_block("critiques"))
    given = {"question": "instruction", "answer": "answer", "evaluation": evaluation}
    source, target = {
        "answer": (F.col("instruction"), F.col("revision")),
        "critique": (fill(CRITIQUE_PROMPT, given), evaluation),
        "revise": (fill(REVISE_PROMPT, given), F.col("revision")),
    }[kind]
    lead = f"{CREATIVE_ANSWER_SYSTEM}\n" if kind == "answer" else ""
    return [fill(lead + CREATIVE_TURN, {"instruction": source}).alias("prompt"), target.alias("output")]


# Reflection system lines, turns and labels.
REFLECT_SYSTEM = "Below is an instruction that describes a task, paired with an input that provides further context. You, the Assistant, should generate a response as if it were an abstract for an academic or technical paper on the query along with a methodology. Then generate an Agent Reflection where you create a long form response as if from subject matter expert, be verbose, diligent, and creative in your application of knowledge, apply it through the lens of the response generated by the assistant. Look for flawed reasoning, faulty logic, or other mistakes in the method. Finally, generate a final response and method for the user with the Assistant abstract and Reflection analysis as augmentations to the generation\n\n"
REFLECT_BARE_SYSTEM = "Below is an instruction that describes a task. You, the Assistant, should generate a response as if it were an abstract for an academic or technical paper on the query along with a methodology. Then generate an Agent Reflection where you create a long form response as if from subject matter expert, be verbose, diligent, and creative in your application of knowledge, apply it through the lens of the response generated by the assistant. Look for flawed reasoning, faulty logic, or other mistakes in the method. Finally, generate a final response and method for the user with the Assistant abstract and Reflection analysis as augmentations to the generation\n\n"
REFLECT = {
    "instruct": (STYLES["instruct"].turn, STYLES["instruct"].bare_turn,
                 "### Thought:\n{output}\n\n### Agent Reflection:\n{reflection}\n\n### Final Response:\n{corrected}"),
    "chat": (STYLES["chat"].turn, STYLES["chat"].bare_turn,
             "\nTHOUGHT: {output}\nASSISTANT REFLECTION: {reflection}\nASSISTANT:"),
}


def reflection_prompt(style: str = "instruct", with_answer: bool = True) -> Column:
    turn, bare, label = REFLECT[style]
    prompt = F.when(filled("input"), fill(REFLECT_SYSTEM + turn)).otherwise(fill(REFLECT_BARE_SYSTEM + bare))
    if not with_answer:
        return prompt
    whole = filled("output") & filled("reflection") & filled("corrected")
    return F.concat(prompt, F.when(whole, fill(label)).otherwise(""))


# Input/output formats -------------------------------------------------------------------

# The texts that several formats below share.
_REVISE = "Revise the provided code to solve the described problem correctly."
_SUGGEST = ("Provide feedback on the errors in the given code and suggest the correct code to address "
            "the described problem.")
# Code-edit formats as (input, output).
CODE_EDIT = {
    "direct_code_edit": (
        _REVISE + "\nProblem Description:{description}\nIncorrect Code:\n{wrong_code}",
        "Correct code:\n{correct_code}"),
    "feedback_code_edit": (
        _SUGGEST + "\nProblem Description:{description}\nIncorrect Code:\n{wrong_code}\n",
        "Feedback:\n{prediction}\nCorrect code:\n{correct_code}"),
    "new_feedback_code_edit": (
        _SUGGEST + "\nProblem Description:{description}\nIncorrect Code:\n{wrong_code}\n",
        "Feedback:\n{feedback}\nCorrect code:\n{correct_code}"),
    "codegen-only": (
        _SUGGEST + "\nProblem Description: {description}\nIncorrect Code:\n{wrong_code}\nFeedback: {feedback}\n",
        "Correct code:\n{correct_code}"),
    "input_output_codegen-only": (
        _SUGGEST + "\nProblem Description:{description}\n - output format: {output_format}\n"
        " - input format: {input_format}\nIncorrect code:\n```python\n{wrong_code}```\nFeedback: {feedback}\n",
        "Correct code:\n{correct_code}"),
    "dscoder-only-wrongcode": (
        "## Instruction:\nRefine the given code by the given feedback.\n\nGiven code:\n```python\n{wrong_code}```\n"
        "Feedback:\n{feedback}\n\n## Response:",
        "Refined code:```python\n{correct_code}```"),
    "feedback-only": (
        "Provide feedback on the errors in the given code.\nProblem Description: {description}\n"
        "Incorrect Code:\n{wrong_code}\n",
        "Feedback: {feedback}"),
    "octocoder_without_feedback": (
        "Question: " + _REVISE + "\nProblem Description:{description}\nIncorrect Code:\n{wrong_code}\n",
        "Answer: Correct code:\n{correct_code}"),
    "octocoder_feedback": (
        "Question: " + _SUGGEST + "\nProblem Description:{description}\nIncorrect Code:\n{wrong_code}\n",
        "Answer: Feedback:\n{feedback}\nCorrect code:\n{correct_code}"),
}


def format_pairs(df: DataFrame, kind: str, keep: list[str] | None = None) -> DataFrame:
    """A named source format as ``input`` and ``output``; every other column is dropped."""
    if kind in CODE_EDIT:
        source, target = (fill(t) for t in CODE_EDIT[kind])
    elif kind == "chip2":
        parts = F.split("text", "\n<bot>: ")
        source = F.replace(parts[0], F.lit("<human>: "), F.lit(""))
        target = F.try_element_at(parts, F.lit(2))
    elif kind == "self-instruct":
        source, target = F.col("prompt"), F.col("completion")
    elif kind == "hh-rlhf":
        source, target = F.lit(""), F.col("chosen")
    elif kind == "oasst1":
        source, target = F.lit(""), F.col("text")
    elif kind == "input-output":
        source, target = F.col("input"), F.col("output")
    elif kind == "alpaca":
        has_input = "input" in df.columns
        source = instruction_prompt(input="input" if has_input else None)
        target = F.col("output")
    else:
        raise ValueError(f"unknown pair format {kind!r}")
    return df.select(*(keep or []), source.alias("input"), target.alias("output"))


# Preference formats ---------------------------------------------------------------------


@dataclass(frozen=True)
class Markup:
    system: str
    user: str
    end: str


# Prompt marks and end mark of the two markups.
MARKUPS = {
    "chatml": Markup("<|im_start|>system\n{system}<|im_end|>\n",
                     "<|im_start|>user\n{prompt}<|im_end|>\n<|im_start|>assistant\n", "<|im_end|>"),
    "llama3": Markup("<|start_header_id|>system<|end_header_id|>\n\n{system}<|eot_id|>",
                     "<|start_header_id|>user<|end_header_id|>\n\n{prompt}<|eot_id|>"
                     "<|start_header_id|>assistant<|end_header_id|>\n\n", "<|eot_id|>"),
}
# Source columns of the flat shapes, as (prompt, chosen, rejected).
PAIR_SHAPES = {
    "argilla": ("instruction", "chosen_response", "rejected_response"),
    "icr": ("input", "chosen", "rejected"),
    "intel": ("question", "chosen", "rejected"),
    "prompt_pairs": ("prompt", "chosen", "rejected"),
}
UNPAIRED_SHAPES = {"argilla": "instruction", "intel": "question", "prompt_pairs": "prompt", "ultra": "prompt"}


def marked_prompt(df: DataFrame, markup: str, prompt: Column | str) -> Column:
    m = MARKUPS[markup]
    turn = fill(m.user, {"prompt": prompt})
    if "system" not in df.columns:
        return turn
    return F.concat(F.when(filled("system"), fill(m.system)).otherwise(""), turn)


def preference_pair(df: DataFrame, shape: str, markup: str) -> list[Column]:
    """prompt / chosen / rejected of flat columns or of message arrays."""
    end = F.lit(MARKUPS[markup].end)
    if shape in PAIR_SHAPES:
        prompt, chosen, rejected = PAIR_SHAPES[shape]
        text, good, bad = marked_prompt(df, markup, prompt), F.col(chosen), F.col(rejected)
    elif shape in ("argilla_chat", "ultra"):
        good, bad = (F.try_element_at(F.col(c), F.lit(2))["content"] for c in ("chosen", "rejected"))
        if shape == "ultra":
            text = marked_prompt(df, markup, "prompt")
        else:
            first = F.try_element_at(F.col("chosen"), F.lit(1))["content"]
            text = fill(MARKUPS[markup].user, {"prompt": first})
    else:
        raise ValueError(f"unknown preference shape {shape!r}")
    return [text.alias("prompt"), F.concat(good, end).alias("chosen"), F.concat(bad, end).alias("rejected")]


def unpaired_preference(df: DataFrame, shape: str, markup: str) -> list[Column]:
    """prompt / completion / label."""
    end = F.lit(MARKUPS[markup].end)
    if shape == "argilla_chat":
        first = F.try_element_at(F.col("chosen"), F.lit(1))["content"]
        text = fill(MARKUPS[markup].user, {"prompt": first})
        answer = F.try_element_at(F.col("completion"), F.lit(2))["content"]
    else:
        text, answer = marked_prompt(df, markup, UNPAIRED_SHAPES[shape]), F.col("completion")
    return [text.alias("prompt"), F.concat(answer, end).alias("completion"), F.col("label")]


# Fixed value: the ranked-answer prompt.
RANKED_PROMPT = "<|system|>\n</s>\n<|user|>\n{prompt}</s>\n<|assistant|>\n"


def ranked_pair(answers: Column | str = "answers", best: str = "last") -> list[Column]:
    """Chosen and rejected of an array of (answer, rank).

    The default takes the last two by ascending rank; ``best="first"`` reads rank 1 as best.
    """
    by_rank = F.array_sort(F.transform(col_of(answers), lambda a, i: F.struct(
        a["rank"].alias("rank"), i.alias("i"), a["answer"].alias("answer"))))
    first, second = (-1, -2) if best == "last" else (1, 2)
    return [fill(RANKED_PROMPT).alias("prompt"),
            F.try_element_at(by_rank, F.lit(first))["answer"].alias("chosen"),
            F.try_element_at(by_rank, F.lit(second))["answer"].alias("rejected")]


def _configured(df: DataFrame, config: dict, fields: dict[str, str]) -> dict[str, Column]:
    """Formats of a user-defined preference type; a format names the role, not the column."""
    names = {role: config.get(f"field_{role}", role) for role in (*fields, "system")}
    out = {}
    for role in fields:
        template = config.get(f"{role}_format") or "{" + role + "}"
        given = {role: names[role]}
        if role == "prompt" and "{system}" in template:
            given["system"] = (F.coalesce(F.col(names["system"]), F.lit(""))
                               if names["system"] in df.columns else F.lit(""))
        out[role] = fill(template, given).alias(role)
    return out


def user_defined_pair(df: DataFrame, config: dict) -> list[Column]:
    return list(_configured(df, config, {"prompt": "", "chosen": "", "rejected": ""}).values())


def user_defined_unpaired(df: DataFrame, config: dict) -> list[Column]:
    label = F.col(config.get("field_label", "label")).alias("label")
    return [*_configured(df, config, {"prompt": "", "completion": ""}).values(), label]


def reward_pair(df: DataFrame, markup: str = "llama3") -> list[Column]:
    """Two full texts: prompt with either answer."""
    text, end = marked_prompt(df, markup, "input"), F.lit(MARKUPS[markup].end)
    return [F.concat(text, F.col(c), end).alias(c) for c in ("chosen", "rejected")]


def odds_ratio_format(df: DataFrame, name: str = "chatml", chosen: str = "chosen", rejected: str = "rejected",
                      system: str | None = "system") -> list[Column]:
    """Prompt up to the last turn, and both answers as the rendered text past it; odd conversations give null."""
    talk, other = F.col(chosen), F.col(rejected)
    lead = F.slice(talk, 1, 0)
    if system and system in df.columns:
        first = F.array(F.struct(F.lit("system").alias("role"), F.col(system).alias("content")))
        lead = F.when(filled(system), first).otherwise(F.slice(first, 1, 0))
    before = F.concat(lead, F.slice(talk, 1, F.greatest(F.size(talk) - 1, F.lit(0))))
    prompt = render_chat(before, name, add_generation_prompt=True)

    def past(last: Column) -> Column:
        text = render_chat(F.concat(before, F.array(last)), name)
        return F.substr(text, F.length(prompt) + 1)

    even = F.size(talk) % 2 == 0
    return [F.when(even, prompt).alias("prompt"), F.when(even, past(F.element_at(talk, -1))).alias("chosen"),
            F.when(even, past(F.element_at(other, -1))).alias("rejected")]


def question_pair(kind: str = "responses") -> list[Column]:
    """Question and two answers; ``kind="model"`` takes the label as chosen and the model's text as rejected."""
    chosen, rejected = ("response_j", "response_k") if kind == "responses" else ("label", "prediction")
    return [fill("Question: {question}\n\nAnswer: ").alias("prompt"),
            F.col(chosen).alias("chosen"), F.col(rejected).alias("rejected")]


# What follows the feedback in the second-stage prompt.
CORRECTION_MARKS = {"feedback": "\n", "refine": "\nCorrect code:\n"}


def correction_prompt(requests: DataFrame, feedback: DataFrame, key: str, kind: str = "refine") -> DataFrame:
    """Second-stage input: the request's prompt, its feedback and a mark, matched by id."""
    joined = requests.join(feedback.select(key, F.col("prediction").alias("feedback")), key)
    return joined.withColumn("model_input", F.concat("model_input", "feedback", F.lit(CORRECTION_MARKS[kind])))


def normalise_subject(subject: Column | str) -> list[Column]:
    """``a-b:c-d`` to (a_b in lower case, c_d); the second part defaults to ``all``."""
    parts = F.split(col_of(subject), ":")
    second = F.try_element_at(parts, F.lit(2))
    return [F.replace(F.lower(F.trim(parts[0])), F.lit("-"), F.lit("_")).alias("name"),
            F.coalesce(F.replace(F.trim(second), F.lit("-"), F.lit("_")), F.lit("all")).alias("subject")]
