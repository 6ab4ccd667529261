"""Conversations turn by turn: rendering and labels of threads that need not fit a row.

``threaded`` numbers the turns of a conversation and gives each turn what rendering has to know of the whole.  Turns are
grouped by ranges of ``RANGE_TURNS`` turn numbers, so no group grows with a conversation; a range is summed up in
one row (its turns, its first two, its roles, how often users stand on odd places), and running sums over those rows carry places and facts
across ranges.
What follows is a column of one turn; ``offsets`` carries token counts across ranges in the same way, and ``first_tokens`` puts
together no more than a fixed number of tokens of each conversation.

Defined results: a conversation is ordered by turn; turns are unique in a conversation; a refused conversation has null
pieces; a null role is a role of its own that is no user; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from promptmill.functions.arrays import once
from promptmill.functions.text import col_of, strip
from promptmill.operators import chat

RANGE_TURNS = 1000


def threaded(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text",
             range_turns: int = RANGE_TURNS) -> DataFrame:
    """Adds ``range``, ``i`` (the turn's place from 0) and ``thread``, what a turn has to know of its conversation."""
    ranged = turns.withColumn("range", F.floor(F.col(turn) / range_turns).cast("long"))
    at = F.row_number().over(Window.partitionBy(conv, "range").orderBy(turn)) - 1
    placed = ranged.withColumn("_at", at.cast("long"))
    is_user = F.coalesce(F.col(role) == "user", F.lit(False))
    opening = F.struct(F.col(role).alias("role"), F.col(text).alias("text"))
    facts = placed.groupBy(conv, "range").agg(
        F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("_at") == 0, opening)).alias("first"), F.max(F.when(F.col("_at") == 1, F.col(role))).alias("second"),
        F.collect_set(F.when(F.col("_at") > 0, F.col(role))).alias("roles"),
        F.count(F.when(is_user != (F.col("_at") % 2 == 0), 1)).alias("breaks"))
    order = Window.partitionBy(conv).orderBy("range")
    facts = facts.withColumn("start", F.sum("n").over(order) - F.col("n"))
    whole = Window.partitionBy(conv)
    later = F.when(F.col("start") > 0, F.concat(F.array("first.role"), "roles")).otherwise(F.col("roles"))
    thread = F.struct(
        F.sum("n").over(whole).alias("n"),
        F.max(F.when(F.col("start") == 0, F.col("first"))).over(whole).alias("lead"),
        F.max(F.when(F.col("start") == 0, F.col("second")).when(F.col("start") == 1, F.col("first.role"))).over(whole).alias("second"),
        F.array_distinct(F.flatten(F.collect_set(later).over(whole))).alias("later_roles"),
        F.sum(F.when(F.col("start") % 2 == 0, F.col("breaks")).otherwise(F.col("n") - F.col("breaks"))).over(whole).alias("breaks"))
    told = facts.select(conv, "range", "start", thread.alias("thread"))
    joined = placed.join(told, [conv, "range"])
    return joined.select(*turns.columns, "range", (F.col("_at") + F.col("start")).alias("i"), "thread")


def offsets(rows: DataFrame, size: Column | str, out: str = "start", conv: str = "conv_id", group: tuple[str, ...] = ()) -> DataFrame:
    """Adds the sum of ``size`` over a conversation's turns before each one (``group`` columns keep several renderings apart)."""
    keys = [conv, *group]
    sized = once(rows, _size=col_of(size))
    inside = F.sum("_size").over(Window.partitionBy(*keys, "range").orderBy("i")) - F.col("_size")
    sums = sized.groupBy(*keys, "range").agg(F.sum("_size").alias("_sum"))
    before = F.sum("_sum").over(Window.partitionBy(*keys).orderBy("range")) - F.col("_sum")
    carried = sums.select(*keys, "range", before.alias("_before"))
    joined = sized.withColumn("_inside", inside).join(carried, [*keys, "range"])
    return joined.withColumn(out, F.col("_inside") + F.col("_before")).drop("_size", "_inside", "_before")


def _lead_is(*roles: str) -> Column:
    return F.coalesce(F.col("thread.lead.role").isin(*roles), F.lit(False))


def _breaks(skipped: Column) -> Column:
    """Turns after the first ``skipped`` ones that are not user, assistant, user, ...; none of the skipped ones is a user."""
    found, n = F.col("thread.breaks"), F.col("thread.n")
    return F.when(skipped == 0, found).when(skipped == 1, n - found).otherwise(found - 1)


def rendered(name: str, add_generation_prompt: bool = False, bos: str = "<s>", eos: str = "</s>", role: str = "role", text: str = "text") -> Column:
    """A turn's piece of its conversation in a named chat template; the pieces in order are the whole text."""
    t = chat.chat_template(name)
    leads, first, last = _lead_is("system"), F.col("i") == 0, F.col("i") == F.col("thread.n") - 1
    taken = leads if t.system else F.lit(False)
    own = F.when(first & taken, "").otherwise(chat.turn_text(t, F.col(role), F.col(text), bos, eos))
    opening = chat.opening_text(t, leads, F.col("thread.lead.text"), bos, eos)
    piece = F.concat(F.when(first, opening).otherwise(""), own, F.when(last, chat.closing_text(t, add_generation_prompt, eos)).otherwise(""))
    refused = F.lit(False)
    if t.alternate:
        refused = refused | (_breaks(F.when(taken, 1).otherwise(0)) > 0)
    if t.refuse_system:
        refused = refused | leads
    if t.refuse_unknown:
        shown = F.when(taken, F.col("thread.later_roles")).otherwise(F.concat(F.array("thread.lead.role"), "thread.later_roles"))
        refused = refused | F.exists(shown, lambda r: ~r.isin(*t.roles))
    return F.when(~refused, piece)


def inst_pieces(role: str = "role", text: str = "text") -> Column:
    """A turn's (text, trains) segments of the [INST] chat; empty where the turn has none, null where the conversation is refused."""
    system = _lead_is("system")
    head = F.when(system, F.col("thread.second")).otherwise(F.col("thread.lead.role"))
    size = F.col("thread.n") - system.cast("long")
    skipped = system.cast("int") + (F.coalesce(head, F.lit("")) != "user").cast("int")
    k = F.col("i") - skipped
    open_end = (F.col("i") == F.col("thread.n") - 1) & F.coalesce(F.col(role) == "user", F.lit(False))
    said = strip(F.col(text))
    lead = chat.inst_system(F.when(system, F.col("thread.lead.text")).otherwise(chat.INST_DEFAULT_SYSTEM))
    segments = F.when((k < 0) | open_end, F.array().cast("array<struct<text:string,trains:boolean>>")).otherwise(chat.inst_turn(said, k, lead))
    return F.when((size >= 2) & (_breaks(skipped) == 0), segments)


def first_tokens(rows: DataFrame, limit: int, conv: str = "conv_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per conversation with its first ``limit`` input_ids and labels, from rows with ``start``, ``input_ids`` and ``labels``.

    A turn that starts before ``limit`` and has tokens is one of at most ``limit``, so no group grows with the conversation.
    """
    near = rows.filter((F.col("start") < limit) & ((F.size("input_ids") > 0) | (F.col("i") == 0)))
    parts = near.groupBy(conv, *keep).agg(F.sort_array(F.collect_list(F.struct("i", "input_ids", "labels"))).alias("_parts"))

    def first(name: str) -> Column:
        return F.slice(F.flatten(F.transform("_parts", lambda p: p[name])), 1, limit).alias(name)

    return parts.select(conv, *keep, first("input_ids"), first("labels"))
