"""Views over the given tables in the shapes the operators read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.functions.arrays import once
from promptmill.operators import chat, labels
from promptmill.plans.kit import hex_digit, table
from promptmill.plans.registry import instruction_rows
from promptmill.session import spread


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents").select("doc_id", "text", "lang", "source"))


def docs(spark: SparkSession, sf: str) -> DataFrame:
    rows = instruction_rows(documents(spark, sf))
    return rows.withColumns({
        "system": F.when(F.col("lang") == "fr", "").otherwise(F.concat(F.lit("You answer in "), "lang", F.lit("."))),
        "head": F.substring_index("output", "\n", 1), "text": F.col("output")})


def turns(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "conversations"))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return chat.rollup(turns(spark, sf))


# turns a conversation may have before ids of two conversations could meet
MOST_TURNS = 10_000_000


def turn_id():
    return F.col("conv_id") * MOST_TURNS + F.col("turn")


def pairs(spark: SparkSession, sf: str) -> DataFrame:
    """User turn, the answer after it, and the answer at the same turn of the next conversation."""
    t = turns(spark, sf)
    answers = t.filter("role = 'assistant'")
    u = t.filter("role = 'user'").select("conv_id", "turn", F.col("text").alias("prompt"))
    a = answers.select("conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("chosen"))
    r = answers.select((F.col("conv_id") - 1).alias("conv_id"), (F.col("turn") - 1).alias("turn"),
                       F.col("text").alias("other"))
    s = t.filter("role = 'system' and turn = 0").select("conv_id", F.col("text").alias("system"))
    out = u.join(a, ["conv_id", "turn"]).join(r, ["conv_id", "turn"], "left").join(s, "conv_id", "left")
    return out.select(turn_id().alias("pair_id"), "conv_id",
                      F.coalesce("system", F.lit("")).alias("system"), "prompt", "chosen",
                      F.coalesce("other", "prompt").alias("rejected"))


def encoded_conversations(spark: SparkSession, sf: str) -> DataFrame:
    """conv_id, input_ids, attention_mask, labels of the chat encoding."""
    return labels.with_encoded(conversations(spark, sf), labels.turn_masked("messages")).drop("messages")


def encoded_documents(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, lang, source, ids and labels of the documents as instruction rows."""
    rows = docs(spark, sf)
    prompt = F.concat("instruction", F.lit("\n"), "input", F.lit("\n"))
    return labels.with_encoded(rows, labels.prompt_masked(prompt, "output")).select(
        "doc_id", "lang", "source", "input_ids", "attention_mask", "labels")


def document_lengths(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id and the length of the encoded row, without building ids."""
    prompt = F.concat("instruction", F.lit("\n"), "input", F.lit("\n"))
    rows = once(docs(spark, sf), n=tk.token_count(prompt) + tk.token_count("output") + 1)
    return rows.select("doc_id", "lang", "source", "n")


def events(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").withColumn("h", F.md5(F.col("event_id").cast("string")))


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """Generation requests with parameters drawn from the event's hash."""

    def d(k: int):
        return hex_digit(F.col("h"), k)

    def unless(rule, value):
        return F.when(~rule, value)

    return events(spark, sf).select(
        F.col("event_id").alias("request_id"), F.col("user_id").alias("queue"), "ts",
        unless(d(1) % 4 == 0, d(1) % 4).alias("best_of"), (d(2) % 2 == 0).alias("do_sample"),
        unless(d(3) > 10, d(3) / 10.0).alias("temperature"), unless(d(4) > 8, d(4) / 4.0).alias("repetition_penalty"),
        unless(d(5) > 9, d(5)).alias("top_k"), unless(d(6) > 10, d(6) / 10.0).alias("top_p"),
        unless(d(7) > 10, d(7) / 10.0).alias("typical_p"), unless(d(8) == 15, d(8) * 100).alias("max_new_tokens"),
        F.array_repeat(F.lit("x"), d(9) % 6).alias("stop"), unless(d(10) > 7, d(10)).alias("seed"),
        unless(d(11) > 8, d(11)).alias("top_n_tokens"), F.when(d(12) > 0, F.col("props")).otherwise("").alias("inputs"),
        unless(d(13) < 12, (d(13) - 12) * 500).alias("truncate"),
        (d(14) * 80 + F.length("props")).alias("input_length"))


REQUESTS_SQL = """rq AS (SELECT event_id AS request_id, user_id AS queue, ts,
 CASE WHEN d1 % 4 <> 0 THEN d1 % 4 END AS best_of, d2 % 2 = 0 AS do_sample,
 CASE WHEN d3 <= 10 THEN d3 / 10.0 END AS temperature, CASE WHEN d4 <= 8 THEN d4 / 4.0 END AS repetition_penalty,
 CASE WHEN d5 <= 9 THEN d5 END AS top_k, CASE WHEN d6 <= 10 THEN d6 / 10.0 END AS top_p,
 CASE WHEN d7 <= 10 THEN d7 / 10.0 END AS typical_p, CASE WHEN d8 <> 15 THEN d8 * 100 END AS max_new_tokens,
 d9 % 6 AS stops, CASE WHEN d10 <= 7 THEN d10 END AS seed, CASE WHEN d11 <= 8 THEN d11 END AS top_n_tokens,
 CASE WHEN d12 > 0 THEN props ELSE '' END AS inputs, CASE WHEN d13 >= 12 THEN (d13 - 12) * 500 END AS truncate,
 d14 * 80 + length(props) AS input_length
 FROM (SELECT *, """ + ", ".join(
    f"('0x' || substr(md5(event_id::VARCHAR), {k}, 1))::INT AS d{k}" for k in range(1, 15)) + " FROM events))"


def token_log(spark: SparkSession, sf: str) -> DataFrame:
    """Generated tokens: the words of every assistant turn, with log-probabilities from their hash."""
    answers = turns(spark, sf).filter("role = 'assistant'").select(
        turn_id().alias("request_id"), F.posexplode(tk.token_texts("text")).alias("pos", "text"))
    h = F.md5(F.concat_ws("|", "request_id", "pos", "text"))
    return answers.withColumns({
        "id": F.when(hex_digit(h, 1, 2) == 0, F.lit(tk.EOS)).otherwise(tk.token_id(F.col("text"))),
        "logprob": -(hex_digit(h, 3, 4) + 1) / 8192.0, "special": hex_digit(h, 7) == 0, "h": h})


TOKEN_LOG_SQL = """tl0 AS (SELECT conv_id * 10000000 + turn AS request_id, unnest(range(len(w))) AS pos, unnest(w) AS text
 FROM (SELECT conv_id, turn, regexp_extract_all(text, '\\p{L}+|\\p{N}+|[^\\s\\p{L}\\p{N}]') AS w FROM conversations
 WHERE role = 'assistant')),
 tl AS (SELECT *, CASE WHEN ('0x' || substr(h, 1, 2))::INT = 0 THEN 2 ELSE 16 + ('0x' || substr(md5(text), 1, 7))::INT END AS id,
 -(('0x' || substr(h, 3, 4))::INT + 1) / 8192.0::DOUBLE AS logprob, ('0x' || substr(h, 7, 1))::INT = 0 AS special
 FROM (SELECT *, md5(request_id || '|' || pos || '|' || text) AS h FROM tl0))"""
