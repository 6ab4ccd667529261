"""Conversations: roll-up, roles, rendering with weights, the chat-template registry, checks."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from promptmill.functions.json_text import json_string, spaced_json
from promptmill.functions.text import col_of, fill, rstrip, strip

# Source role names and what they become.
ROLE_MAP = {"human": "user", "user": "user", "assistant": "assistant", "gpt": "assistant",
            "system": "system", "tool": "tool"}
WEIGHTED_ROLES = {"system": "system", "user": "user", "human": "user", "assistant": "assistant",
                  "gpt": "assistant", "tool": "tool", "ipython": "ipython"}
LEGACY_ROLES = {"human": "user", "gpt": "assistant"}
RANGE_TURNS = 1000


def lookup(mapping: dict[str, str], key: Column) -> Column:
    """A small literal map as an expression; null for an unknown key."""
    return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])[key]


def rollup(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
           text: str = "text", range_turns: int = RANGE_TURNS, extra: tuple[str, ...] = ()) -> DataFrame:
    """Flat turns to one record per conversation with a ``messages`` array, however long it is.

    (conv, turn) is the key of the flat table.  Turns are sorted in ranges of ``range_turns`` turn numbers, which are
    spread over the tasks, and a conversation is put together from its sorted ranges.  A record has to fit a row; a table
    whose conversations do not is rendered turn by turn, by ``operators.threads``.
    """
    item = F.struct(F.col(turn).alias("turn"), F.col(role).alias("role"), F.col(text).alias("content"), *extra)
    ranged = df.groupBy(conv, F.floor(F.col(turn) / range_turns).alias("_range")).agg(F.sort_array(F.collect_list(item)).alias("_items"))
    whole = ranged.groupBy(conv).agg(F.sort_array(F.collect_list(F.struct("_range", "_items"))).alias("_ranges"))
    messages = F.flatten(F.transform("_ranges", lambda r: F.transform(r["_items"], lambda m: m.dropFields("turn"))))
    return whole.select(conv, messages.alias("messages"))


def conversation_thread(messages: Column | str = "messages", drop_system: bool = False,
                        roles: dict[str, str] | None = None) -> Column:
    """Roles mapped; a leading system message dropped on request."""
    mapped = F.transform(col_of(messages), lambda m: m.withField("role", lookup(roles or ROLE_MAP, m["role"])))
    if not drop_system:
        return mapped
    return F.when(mapped[0]["role"] == "system", tail(mapped)).otherwise(mapped)


def unknown_roles(messages: Column | str = "messages", roles: dict[str, str] | None = None) -> Column:
    return F.exists(col_of(messages), lambda m: lookup(roles or ROLE_MAP, m["role"]).isNull())


def legacy_messages(conversations: Column | str = "conversations") -> Column:
    """from/value to role/content; an unknown role is kept."""
    return F.transform(col_of(conversations), lambda m: F.struct(
        F.coalesce(lookup(LEGACY_ROLES, m["from"]), m["from"]).alias("role"), m["value"].alias("content")))


def weighted_messages(messages: Column | str = "messages", role_field: str = "role",
                      content_field: str = "content", weight_field: str | None = None,
                      train_on_inputs: bool = False) -> Column:
    """role, content list and weight; the weight comes from the message or from its role."""

    def one(m: Column) -> Column:
        role = lookup(WEIGHTED_ROLES, m[role_field])
        if weight_field:
            weight = m[weight_field].cast("int")
        else:
            weight = F.when(F.lit(train_on_inputs) | (role == "assistant"), 1).otherwise(0)
        text = F.struct(F.lit("text").alias("type"), m[content_field].alias("value"), weight.alias("weight"))
        return F.struct(role.alias("role"), F.array(text).alias("content"), weight.alias("weight"))

    return F.transform(col_of(messages), one)


def segment(text: Column | str, weight: Column | int) -> Column:
    return F.struct((F.lit(text) if isinstance(text, str) else text).alias("text"),
                    (F.lit(weight) if isinstance(weight, int) else weight).cast("int").alias("weight"))


def tool_segments(content: Column, weight: Column) -> Column:
    """Contents as segments; tool calls and responses get tags and a closing newline."""

    def one(c: Column) -> Column:
        def wrapped(tag: str) -> Column:
            body = F.when(F.endswith(c["value"], F.lit("\n")), c["value"]).otherwise(
                F.concat(c["value"], F.lit("\n")))
            return F.array(segment(f"<{tag}>\n", weight), segment(body, c["weight"]),
                           segment(f"</{tag}>\n", weight))
        return (F.when(c["type"] == "tool_call", wrapped("tool_call"))
                .when(c["type"] == "tool_response", wrapped("tool_response"))
                .otherwise(F.array(segment(c["value"], c["weight"]))))

    return F.flatten(F.transform(content, one))


def weighted_segments(messages: Column | str, markup: str) -> Column:
    """Rendered segments with weights, in the ChatML or the Llama-3 markup."""

    def one(m: Column, i: Column) -> Column:
        body = tool_segments(m["content"], m["weight"])
        if markup == "chatml":
            lead = F.array(segment(F.concat(F.lit("<|im_start|>"), m["role"], F.lit("\n")), 0))
            close = F.array(segment("<|im_end|>", m["weight"]), segment("\n", 0))
            return F.concat(lead, body, close)
        role = F.when(m["role"] == "tool", "ipython").otherwise(m["role"])
        lead = F.array(segment(F.concat(F.lit("<|start_header_id|>"), role, F.lit("<|end_header_id|>\n\n")), 0))
        close = F.array(segment("<|eot_id|>", m["weight"]))
        begin = F.when(i == 0, F.array(segment("<|begin_of_text|>", 0))).otherwise(F.slice(lead, 1, 0))
        return F.concat(begin, lead, body, close)

    return F.flatten(F.transform(col_of(messages), one))


# Chat templates -------------------------------------------------------------------------



def tail(messages: Column, skip: int = 1) -> Column:
    return F.slice(messages, skip + 1, F.greatest(F.size(messages) - skip, F.lit(0)))


@dataclass(frozen=True)
class ChatTemplate:
    """What a named template puts around messages.

    ``roles`` holds (before, after) per role, ``any_role`` the pair for all other
    roles ({role} is the role's name).  ``system`` takes a leading system message
    (or ``default_system``) out of the turns.  ``alternate`` refuses turns that are
    not user, assistant, user, ...; a refused conversation renders as null.
    """
    roles: dict[str, tuple[str, str]] = field(default_factory=dict)
    any_role: tuple[str, str] | None = None
    rename: dict[str, str] = field(default_factory=dict)
    start: str = ""
    system: tuple[str, str] | None = None
    default_system: str | None = None
    stripped_system: bool = False
    start_without_system: str = ""
    end: str = ""
    generation: str = ""
    stripped: bool = False
    alternate: bool = False
    refuse_system: bool = False
    refuse_unknown: bool = False
    skip_empty: tuple[str, ...] = ()


def _mistral(user: tuple[str, str], before_answer: str) -> ChatTemplate:
    return ChatTemplate(start="{bos}", roles={"user": user, "assistant": (before_answer, "{eos}")},
                        alternate=True, refuse_unknown=True)


# Marks that several templates share.
_HEADER = "<|start_header_id|>{role}<|end_header_id|>\n\n"
_HEADER_GENERATION = "<|start_header_id|>assistant<|end_header_id|>\n\n"
_IM = ("<|im_start|>{role}\n", "<|im_end|>\n")

# The sixteen named templates.
CHAT_TEMPLATES: dict[str, ChatTemplate] = {
    "alpaca": ChatTemplate(roles={"user": ("### Instruction: ", "\n\n"), "assistant": ("### Response: ", "{eos}")}),
    "mistral_v1": _mistral((" [INST] ", " [/INST]"), " "),
    "mistral_v2v3": _mistral(("[INST] ", "[/INST]"), " "),
    "mistral_v3_tekken": _mistral(("[INST]", "[/INST]"), ""),
    "chatml": ChatTemplate(any_role=_IM, generation="<|im_start|>assistant\n"),
    "gemma": ChatTemplate(start="{bos}", any_role=("<start_of_turn>{role}\n", "<end_of_turn>\n"),
                          rename={"assistant": "model"}, stripped=True, alternate=True, refuse_system=True,
                          generation="<start_of_turn>model\n"),
    "cohere": ChatTemplate(start="{bos}",
                           system=("<|START_OF_TURN_TOKEN|><|SYSTEM_TOKEN|>", "<|END_OF_TURN_TOKEN|>"),
                           roles={"user": ("<|START_OF_TURN_TOKEN|><|USER_TOKEN|>", "<|END_OF_TURN_TOKEN|>"),
                                  "assistant": ("<|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>",
                                                "<|END_OF_TURN_TOKEN|>")},
                           stripped=True, alternate=True,
                           generation="<|START_OF_TURN_TOKEN|><|CHATBOT_TOKEN|>"),
    "llama3": ChatTemplate(start="{bos}", any_role=(_HEADER, "<|eot_id|>"), stripped=True,
                           generation=_HEADER_GENERATION),
    "llama3_2_vision": ChatTemplate(
        start="{bos}",
        system=("<|start_header_id|>system<|end_header_id|>\n\nCutting Knowledge Date: December 2023\n"
                "Today Date: 26 Jul 2024\n\n", "<|eot_id|>"),
        default_system="", stripped_system=True, any_role=(_HEADER, "<|eot_id|>"), generation=_HEADER_GENERATION),
    "phi_3": ChatTemplate(start="{bos}", roles={"system": ("<|system|>\n", "<|end|>\n"),
                                                "user": ("<|user|>\n", "<|end|>\n<|assistant|>\n"),
                                                "assistant": ("", "<|end|>\n")}),
    "phi_35": ChatTemplate(roles={"system": ("<|system|>\n", "<|end|>\n"), "user": ("<|user|>\n", "<|end|>\n"),
                                  "assistant": ("<|assistant|>\n", "<|end|>\n")},
                           skip_empty=("system",), generation="<|assistant|>\n"),
    "deepseek_v2": ChatTemplate(start="{bos}", roles={"user": ("<｜User｜>", ""),
                                                      "assistant": ("<｜Assistant｜>", "{eos}"),
                                                      "system": ("", "\n\n")}, generation="<｜Assistant｜>"),
    "jamba": ChatTemplate(start="<|startoftext|>", system=("<|bom|><|system|> ", "<|eom|>"), default_system="",
                          any_role=("<|bom|><|{role}|> ", "<|eom|>"), generation="<|bom|><|assistant|>"),
    "qwen_25": ChatTemplate(system=("<|im_start|>system\n", "<|im_end|>\n"),
                            default_system="You are Qwen, created by Alibaba Cloud. You are a helpful assistant.",
                            any_role=_IM, generation="<|im_start|>assistant\n"),
    "exaone": ChatTemplate(start_without_system="[|system|][|endofturn|]\n",
                           roles={"user": ("[|user|]", "\n")}, any_role=("[|{role}|]", "[|endofturn|]\n"),
                           generation="[|assistant|]"),
    "metharme": ChatTemplate(
        start="{bos}", system=("<|system|>", ""),
        default_system="Enter RP mode. You shall reply to the user while staying in character. Your responses must "
                       "be detailed, creative, immersive, and drive the scenario forward.",
        roles={"user": ("<|user|>", ""), "assistant": ("<|model|>", "")}, stripped=True,
        end="{eos}", generation="<|model|>"),
}


def register_chat_template(name: str, template: ChatTemplate) -> None:
    if name in CHAT_TEMPLATES:
        raise ValueError(f"chat template {name!r} already exists")
    CHAT_TEMPLATES[name] = template


def chat_template(name: str) -> ChatTemplate:
    if name not in CHAT_TEMPLATES:
        raise ValueError(f"chat template {name!r} not found; known: {sorted(CHAT_TEMPLATES)}")
    return CHAT_TEMPLATES[name]


def turn_text(t: ChatTemplate, role: Column, content: Column, bos: str = "<s>", eos: str = "</s>") -> Column:
    """A turn between the template's marks for its role."""
    special = {"bos": F.lit(bos), "eos": F.lit(eos)}
    content = strip(content) if t.stripped else content
    shown = F.coalesce(lookup(t.rename, role), role) if t.rename else role
    out = None
    for name, (before, after) in t.roles.items():
        around = F.concat(fill(before, special), content, fill(after, special))
        if name in t.skip_empty:
            around = F.when(F.length(content) > 0, around).otherwise("")
        out = (F if out is None else out).when(role == name, around)
    if t.any_role is None:
        return out.otherwise("")
    before, after = t.any_role
    rest = F.concat(fill(before, {**special, "role": shown}), content, fill(after, special))
    return rest if out is None else out.otherwise(rest)


def opening_text(t: ChatTemplate, leads: Column, lead: Column, bos: str = "<s>", eos: str = "</s>") -> Column:
    """What stands before the turns; ``leads`` says whether a system message ``lead`` comes first."""
    parts = [fill(t.start, {"bos": F.lit(bos), "eos": F.lit(eos)})]
    if t.system:
        before, after = (F.lit(s) for s in t.system)
        default = "" if t.default_system is None else F.concat(before, F.lit(t.default_system), after)
        parts.append(F.when(leads, F.concat(before, strip(lead) if t.stripped_system else lead, after)).otherwise(default))
    if t.start_without_system:
        parts.append(F.when(leads, "").otherwise(t.start_without_system))
    return F.concat(*parts)


def closing_text(t: ChatTemplate, add_generation_prompt: bool = False, eos: str = "</s>") -> Column:
    return F.lit(t.generation) if add_generation_prompt else fill(t.end, {"eos": F.lit(eos)})


def render_chat(messages: Column | str, name: str, add_generation_prompt: bool = False,
                bos: str = "<s>", eos: str = "</s>") -> Column:
    """A conversation as text in a named template."""
    t, all_messages = chat_template(name), col_of(messages)
    leads = F.coalesce(all_messages[0]["role"] == "system", F.lit(False))
    turns = F.when(leads, tail(all_messages)).otherwise(all_messages) if t.system else all_messages
    shown = F.array_join(F.transform(turns, lambda m: turn_text(t, m["role"], m["content"], bos, eos)), "")
    text = F.concat(opening_text(t, leads, all_messages[0]["content"], bos, eos), shown, closing_text(t, add_generation_prompt, eos))

    refused = F.lit(False)
    if t.alternate:
        refused = refused | F.exists(
            F.transform(turns, lambda m, i: (m["role"] == "user") != (i % 2 == 0)), lambda x: x)
    if t.refuse_system:
        refused = refused | leads
    if t.refuse_unknown:
        refused = refused | F.exists(turns, lambda m: ~m["role"].isin(*t.roles))
    return F.when(~refused, text)


# Tools in chats -------------------------------------------------------------------------

# What two templates say around tool lists, calls and responses.
QWEN_TOOLS = ("\n\n# Tools\n\nYou may call one or more functions to assist with the user query.\n\nYou are provided with function "
              "signatures within <tools></tools> XML tags:\n<tools>",
              "\n</tools>\n\nFor each function call, return a json object with function name and arguments within <tool_call></tool_call> "
              "XML tags:\n<tool_call>\n{\"name\": <function-name>, \"arguments\": <args-json-object>}\n</tool_call><|im_end|>\n")
QWEN_CALL = ("\n<tool_call>\n{\"name\": \"", "\", \"arguments\": ", "}\n</tool_call>")
QWEN_RESPONSE = ("\n<tool_response>\n", "\n</tool_response>")
HEADER_TOOLS = ("Given the following functions, please respond with a JSON for a function call with its proper arguments that best answers the given "
                "prompt.\n\nRespond in the format {\"name\": function name, \"parameters\": dictionary of argument name and its value}."
                "Do not use variables.\n\n")
HEADER_TOOLS_IN_SYSTEM = ("You have access to the following functions. To call a function, please respond with JSON for a function call."
                          "Respond in the format {\"name\": function name, \"parameters\": dictionary of argument name and its value}."
                          "Do not use variables.\n\n")
HEADER_CALL = ("{\"name\": \"", "\", \"parameters\": ", "}")
HEADER_ENVIRONMENT = "Environment: ipython\n"


def _calls(m: Column, marks: tuple[str, str, str]) -> Column:
    """Tool calls of a message, an array of (name, arguments as JSON text); empty where there are none."""
    calls = F.coalesce(m["tool_calls"], F.array().cast("array<struct<name:string,arguments:string>>"))
    return F.transform(calls, lambda c: F.concat(F.lit(marks[0]), c["name"], F.lit(marks[1]), spaced_json(c["arguments"]), F.lit(marks[2])))


def render_qwen_tools(messages: Column | str, tools: Column | str, add_generation_prompt: bool = False) -> Column:
    """The qwen_25 chat with a tool list (an array of JSON texts, null or empty for none), tool calls and responses.

    ``messages`` has role, content and tool_calls.  Responses that follow each other share one turn.
    """
    t, m, listed = chat_template("qwen_25"), col_of(messages), F.coalesce(col_of(tools), F.array().cast("array<string>"))
    leads = F.coalesce(m[0]["role"] == "system", F.lit(False))
    system = F.when(leads, m[0]["content"]).otherwise(t.default_system)
    shown = F.array_join(F.transform(listed, lambda x: F.concat(F.lit("\n"), spaced_json(x))), "")
    opening = F.concat(F.lit(t.system[0]), system, F.when(F.size(listed) > 0, F.concat(F.lit(QWEN_TOOLS[0]), shown, F.lit(QWEN_TOOLS[1])))
                       .otherwise(t.system[1]))

    def is_tool(i: Column) -> Column:
        return F.coalesce(F.get(m, i)["role"] == "tool", F.lit(False))

    def piece(x: Column, i: Column) -> Column:
        start, end = F.concat(F.lit("<|im_start|>"), x["role"]), F.lit("<|im_end|>\n")
        plain = F.concat(start, F.lit("\n"), x["content"], end)
        calls = _calls(x, QWEN_CALL)
        called = F.concat(start, F.when(F.length(x["content"]) > 0, F.concat(F.lit("\n"), x["content"])).otherwise(""), F.array_join(calls, ""), end)
        response = F.concat(F.when(~is_tool(i - 1), "<|im_start|>user").otherwise(""), F.lit(QWEN_RESPONSE[0]), x["content"],
                            F.lit(QWEN_RESPONSE[1]), F.when(~is_tool(i + 1), end).otherwise(""))
        return (F.when((x["role"] == "system") & (i == 0), "").when((x["role"] == "assistant") & (F.size(calls) > 0), called)
                .when(x["role"].isin("user", "system", "assistant"), plain).when(x["role"] == "tool", response).otherwise(""))

    return F.concat(opening, F.array_join(F.transform(m, piece), ""), F.lit(t.generation if add_generation_prompt else ""))


def render_header_tools(messages: Column | str, tools: Column | str, add_generation_prompt: bool = False, in_user_message: bool = True,
                        bos: str = "<s>") -> Column:
    """The llama3_2_vision chat with a tool list (null for none, as JSON with four spaces a level), tool calls and responses.

    Tools stand in front of the first message, or in the system message; a response is a JSON string.  Null where a message has several calls, or where no
    message is there to put the tools in.
    """
    t, m = chat_template("llama3_2_vision"), col_of(messages)
    listed, given = col_of(tools), col_of(tools).isNotNull()
    leads = F.coalesce(m[0]["role"] == "system", F.lit(False))
    rest = F.when(leads, tail(m)).otherwise(m)
    shown = F.array_join(F.transform(listed, lambda x: F.concat(spaced_json(x, 4), F.lit("\n\n"))), "")
    mark, dates = t.system[0].split("\n\n", 1)
    opening = F.concat(F.lit(bos + mark + "\n\n"), F.when(given, HEADER_ENVIRONMENT).otherwise(""), F.lit(dates),
                       F.when(given, F.concat(F.lit(HEADER_TOOLS_IN_SYSTEM), shown)).otherwise("") if not in_user_message else F.lit(""),
                       F.when(leads, strip(m[0]["content"])).otherwise(""), F.lit(t.system[1]))

    def header(role: Column | str) -> Column:
        return F.concat(F.lit("<|start_header_id|>"), F.lit(role) if isinstance(role, str) else role, F.lit("<|end_header_id|>\n\n"))

    def piece(x: Column) -> Column:
        end = F.lit("<|eot_id|>")
        return (F.when(x["tool_calls"].isNotNull(), F.concat(header("assistant"), F.get(_calls(x, HEADER_CALL), F.lit(0)), end))
                .when(x["role"].isin("tool", "ipython"), F.concat(header("ipython"), json_string(x["content"]), end))
                .otherwise(F.concat(header(x["role"]), x["content"], end)))

    first = F.concat(header("user"), F.lit(HEADER_TOOLS), shown, strip(F.get(rest, F.lit(0))["content"]), F.lit("<|eot_id|>"))
    moved = given if in_user_message else F.lit(False)
    turns = F.when(moved, tail(rest)).otherwise(rest)
    text = F.concat(opening, F.when(moved, first).otherwise(""), F.array_join(F.transform(turns, piece), ""),
                    F.lit(t.generation if add_generation_prompt else ""))
    refused = F.exists(turns, lambda x: x["tool_calls"].isNotNull() & (F.size(x["tool_calls"]) != 1)) | (moved & (F.size(rest) == 0))
    return F.when(~refused, text)


def answer_text(content: Column | str, name: str, eos: str = "</s>") -> Column:
    """An answer as the template closes it: the answer's text and what follows, right-stripped."""
    t = chat_template(name)
    after = t.roles["assistant"][1] if "assistant" in t.roles else (t.any_role or ("", ""))[1]
    body = strip(content) if t.stripped else col_of(content)
    return rstrip(F.concat(body, fill(after + t.end, {"eos": F.lit(eos)})))


# Two-party and persona chats ------------------------------------------------------------

# The system block and marks of the [INST] chat.
INST_DEFAULT_SYSTEM = (
    "You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe. "
    "Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. "
    "Please ensure that your responses are socially unbiased and positive in nature.\n\n"
    "If a question does not make any sense, or is not factually coherent, explain why instead of answering something "
    "not correct. If you don't know the answer to a question, please don't share false information.")
INST_SYSTEM = ("[INST] <<SYS>>\n", "\n<</SYS>>\n\n")
INST_MARKS = ("[INST]", "[/INST]")
INST_SEPARATORS = (" ", " </s><s>")


def inst_turns(messages: Column | str = "messages") -> Column:
    """Turns of an [INST] chat: system and a leading answer taken off, an unanswered last question dropped."""
    m = col_of(messages)
    rest = F.when(m[0]["role"] == "system", tail(m)).otherwise(m)
    started = F.when(rest[0]["role"] != "user", tail(rest)).otherwise(rest)
    open_end = F.element_at(started, -1)["role"] == "user"
    kept = F.when(open_end, F.slice(started, 1, F.size(started) - 1)).otherwise(started)
    alternates = ~F.exists(F.transform(started, lambda x, i: (x["role"] == "user") != (i % 2 == 0)), lambda x: x)
    return F.when((F.size(rest) >= 2) & alternates, kept)


def inst_system(text: Column) -> Column:
    return F.concat(F.lit(INST_SYSTEM[0]), text, F.lit(INST_SYSTEM[1]))


def inst_turn(said: Column, k: Column, system: Column) -> Column:
    """(text, trains) segments of the k-th turn, a question where k is even.  The mark before an answer does not train."""
    def piece(text: Column, trains: bool) -> Column:
        return F.struct(text.alias("text"), F.lit(trains).alias("trains"))

    question = F.when(k == 0, F.concat(system, said)).otherwise(
        F.concat(F.lit(INST_MARKS[0] + " "), said, F.lit(INST_SEPARATORS[0])))
    answer = F.concat(F.lit(" "), said, F.lit(INST_SEPARATORS[1]))
    return F.when(k % 2 == 0, F.array(piece(question, False))).otherwise(
        F.array(piece(F.lit(INST_MARKS[1]), False), piece(answer, True)))


def inst_segments(messages: Column | str = "messages") -> Column:
    """(text, trains) segments; null where the conversation is refused."""
    m = col_of(messages)
    system = inst_system(F.when(m[0]["role"] == "system", m[0]["content"]).otherwise(INST_DEFAULT_SYSTEM))
    return F.flatten(F.transform(inst_turns(m), lambda x, i: inst_turn(strip(x["content"]), i, system)))


def inst_prompt(messages: Column | str = "messages") -> Column:
    return F.array_join(F.transform(inst_segments(messages), lambda s: s["text"]), "")


# Marks of the persona chat and the suffix cut off its system text.
PERSONA_MARKS = {"system": "<|system|>Persona: ", "human": "<|user|> ", "bot": "<|model|> "}
PERSONA_MODEL_MARK = "<|model|>"
PERSONA_START = "\n<START>"


def persona_segments(messages: Column | str = "messages", roles: dict[str, str] | None = None) -> Column:
    """(role, text) with marks; turns of an unknown role are skipped."""
    names = roles or {"system": "system", "user": "human", "human": "human", "assistant": "bot", "bot": "bot"}

    def one(m: Column) -> Column:
        role = lookup(names, m["role"])
        cut = F.when((role == "system") & F.endswith(m["content"], F.lit(PERSONA_START)),
                     F.left(m["content"], F.length(m["content"]) - len(PERSONA_START))).otherwise(m["content"])
        return F.struct(role.alias("role"), F.concat(lookup(PERSONA_MARKS, role), strip(cut)).alias("text"))

    return F.filter(F.transform(col_of(messages), one), lambda s: s["role"].isNotNull())


# Checks ---------------------------------------------------------------------------------


def role_report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                min_turns: int = 2) -> DataFrame:
    """One row per conversation: turns, and the first failing rule or null.

    Roles alternate exactly when all users stand on one parity of the turn number
    and all assistants on the other, so the check is an aggregate with map-side
    combine; a hot conversation needs neither a window nor a collected group.
    """
    is_user, is_answer = F.col(role) == "user", F.col(role) == "assistant"
    odd = F.col(turn) % 2 == 1
    talk = df.groupBy(conv).agg(
        F.count(F.when(F.col(role) != "system", 1)).alias("turns"),
        F.count(F.lit(1)).alias("n"), F.min(turn).alias("lo"), F.max(turn).alias("hi"),
        F.min(F.when(F.col(role) != "system", F.col(turn))).alias("first_talk"),
        F.max(F.when(F.col(role) == "system", F.col(turn))).alias("last_system"),
        F.count(F.when(~role_known(role), 1)).alias("unknown"),
        F.count(F.when(is_user & odd, 1)).alias("uo"), F.count(F.when(is_user & ~odd, 1)).alias("ue"),
        F.count(F.when(is_answer & odd, 1)).alias("ao"), F.count(F.when(is_answer & ~odd, 1)).alias("ae"))
    users_first = F.when(F.col("first_talk") % 2 == 1, (F.col("ue") == 0) & (F.col("ao") == 0)).otherwise(
        (F.col("uo") == 0) & (F.col("ae") == 0))
    answers_first = F.when(F.col("first_talk") % 2 == 1, (F.col("uo") == 0) & (F.col("ae") == 0)).otherwise(
        (F.col("ue") == 0) & (F.col("ao") == 0))
    reason = (F.when(F.col("unknown") > 0, "unknown role")
              .when(F.col("turns") < min_turns, "too short")
              .when(F.coalesce(F.col("last_system") > F.col("lo"), F.lit(False)), "late system turn")
              .when(F.col("hi") - F.col("lo") + 1 != F.col("n"), "missing turn")
              .when(~(users_first | answers_first), "roles do not alternate"))
    return talk.select(conv, "turns", reason.alias("reason"))


def role_known(role: Column | str) -> Column:
    return F.coalesce(col_of(role).isin("system", "user", "assistant"), F.lit(False))


