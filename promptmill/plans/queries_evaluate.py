"""Joins, metrics, run checks and text functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from promptmill.functions import text as tx, tokens as tk
from promptmill.functions.arrays import indices
from promptmill.operators import edits, evaluate as ev, pack
from promptmill.plans import fixtures as fx
from promptmill.plans.fixtures import TOKEN_LOG_SQL
from promptmill.plans.kit import (DOCS, PAIRS, cat, count, dig, digest, digit, hex_digit, joined, query, r6, table, trim,
                                  words)
from promptmill.plans.queries_prompts import CATEGORISED_SQL, JUDGES_SQL, categorised, judges
from promptmill.plans.queries_rows import LEN_SQL, _K05, multipack_sql, multipacked, packed
from promptmill.plans.queries_tokens import ENC_SQL
from promptmill.plans.registry import prepare_and_pack

# The headline table ---------------------------------------------------------------------

_X01 = f"""WITH RECURSIVE {DOCS}, u AS (SELECT doc_id, lang, {count("instruction || chr(10) || input || chr(10)")} AS np, {count('output')} + 1 AS na FROM d
 WHERE doc_id IN (SELECT min(doc_id) FROM d GROUP BY instruction, input, output)),
 r AS (SELECT o + 1 AS i, lang, n, na FROM (
 SELECT *, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS o FROM (SELECT doc_id, lang, np + na AS n, na FROM u WHERE np + na BETWEEN 2 AND 2048 AND na > 1))),
 f AS (SELECT i, lang, n, na, 0 AS block, n::BIGINT AS used FROM r WHERE i = 1 UNION ALL SELECT r.i, r.lang, r.n, r.na,
 CASE WHEN f.used + r.n <= 2048 THEN f.block ELSE f.block + 1 END, CASE WHEN f.used + r.n <= 2048 THEN f.used + r.n ELSE r.n END FROM f JOIN r ON r.i = f.i + 1)
 SELECT lang, count(*) AS rows, sum(n)::BIGINT AS tokens, sum(na)::BIGINT AS trained_tokens, count(DISTINCT block) AS bins_touched,
 round(sum(n) / (count(DISTINCT block) * 2048)::DOUBLE, 6) AS share_of_bins FROM f GROUP BY lang"""


@query("x01_packed_summary", _X01)
def x01(spark, sf):
    return prepare_and_pack(fx.documents(spark, sf))


# Joins ----------------------------------------------------------------------------------

CASES_SQL = ("cs AS (SELECT item_id AS problem_id, unnest(range(len(s))) AS case_no, unnest(s) AS expected FROM "
             "(SELECT item_id, string_split(text, '. ') AS s FROM benchmark)), "
             "ou AS (SELECT problem_id * 10 + k AS program_id, problem_id, case_no, CASE WHEN h < 6 THEN expected || chr(13) || chr(10) "
             "WHEN h < 9 THEN chr(10) || expected WHEN h < 12 THEN expected || '!' END AS output FROM (SELECT *, "
             f"{digit('md5(problem_id || chr(45) || case_no || chr(45) || k)', 1)} AS h FROM cs, (SELECT unnest([1, 2, 3]) AS k)))")


def cases(spark, sf):
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("problem_id"), F.posexplode(
        F.split("text", r"\. ")).alias("case_no", "expected"))


def program_outputs(spark, sf):
    c = cases(spark, sf).withColumn("k", F.explode(F.array(F.lit(1), F.lit(2), F.lit(3))))
    h = hex_digit(F.md5(F.concat_ws("-", "problem_id", "case_no", "k")), 1)
    output = (F.when(h < 6, F.concat("expected", F.lit("\r\n"))).when(h < 9, F.concat(F.lit("\n"), "expected"))
              .when(h < 12, F.concat("expected", F.lit("!"))))
    return c.select((F.col("problem_id") * 10 + F.col("k")).alias("program_id"), "problem_id", "case_no", output.alias("output"))


@query("j01_outputs_to_cases", f"WITH {CASES_SQL} SELECT program_id, problem_id, case_no, expected, output FROM ou JOIN cs USING (problem_id, case_no)")
def j01(spark, sf):
    return ev.outputs_with_cases(program_outputs(spark, sf), cases(spark, sf))


@query("j02_three_way_join", f"""WITH {DOCS} SELECT doc_id, head, 'A ' || source || ' ' || head AS answer_1, text AS answer_2 FROM d""")
def j02(spark, sf):
    d = fx.docs(spark, sf)
    a = d.select("doc_id", F.concat(F.lit("A "), "source", F.lit(" "), "head", F.lit(ev.ANSWER_MARKER), "lang").alias("generation"))
    return ev.judged_questions(d.select("doc_id", "head"), a, d.select("doc_id", "text"), "doc_id")


@query("j02_unanswered", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j02_unanswered(spark, sf):
    d, marked = fx.documents(spark, sf).select("doc_id"), table(spark, sf, "labels").select("doc_id")
    return ev.unanswered(d, [d, marked], "doc_id")


@query("j03_lookup_default", f"""WITH {CATEGORISED_SQL}, {JUDGES_SQL} SELECT doc_id, qc.category, coalesce(j.reviewer_id, 1) AS reviewer_id,
 coalesce(j.prompt, (SELECT prompt FROM j WHERE reviewer_id = 1)) AS prompt FROM qc LEFT JOIN j ON j.category = qc.category""")
def j03(spark, sf):
    rows = categorised(spark, sf).select("doc_id", "category")
    return ev.with_default(rows, judges(spark, sf), "category", "category", "reviewer_id", ["reviewer_id", "prompt"])


@query("j04_semi_join", "SELECT doc_id, md5(text) AS text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def j04(spark, sf):
    rows = ev.with_ids_of(fx.documents(spark, sf), table(spark, sf, "labels"), "doc_id")
    return rows.select("doc_id", F.md5("text").alias("text"))


@query("j05_stage_join", """SELECT event_id AS request_id, user_id, props || '|' || event_type AS joined FROM events""")
def j05(spark, sf):
    e = table(spark, sf, "events")
    requests = e.select(F.col("event_id").alias("request_id"), "user_id", "props")
    feedback = e.select(F.col("event_id").alias("request_id"), "event_type")
    return requests.join(feedback, "request_id").select("request_id", "user_id", F.concat_ws("|", "props", "event_type").alias("joined"))


_J06 = f"""{TOKEN_LOG_SQL}, l AS (SELECT request_id AS response_id, pos, id, text, special, CASE WHEN pos = 0 THEN NULL ELSE logprob END AS logprob FROM tl),
 r AS (SELECT response_id, pos, id, text, special, logprob * CASE WHEN {digit('md5(response_id::VARCHAR)', 1)} < 8 THEN 0.9 ELSE 0.7 END AS logprob FROM l
 WHERE NOT ({digit('md5(response_id::VARCHAR)', 2)} = 0 AND pos = 3)),
 b AS (SELECT coalesce(l.response_id, r.response_id) AS response_id, l.id AS li, r.id AS ri, coalesce(l.id = r.id AND l.text = r.text AND l.special = r.special AND
 CASE WHEN l.logprob IS NULL OR r.logprob IS NULL THEN l.logprob IS NULL AND r.logprob IS NULL ELSE abs(l.logprob - r.logprob) <= {{rtol}} * greatest(abs(l.logprob), abs(r.logprob)) END, false) AS same
 FROM l FULL JOIN r ON l.response_id = r.response_id AND l.pos = r.pos)"""


@query("j06_snapshot_compare", "WITH " + _J06.replace("{rtol}", "0.2") + """ SELECT response_id, min(same::INT) AS matches, count(li) AS tokens, count(ri) AS expected,
 count(*) FILTER (NOT same) AS differences FROM b GROUP BY response_id""")
def j06(spark, sf):
    log = fx.token_log(spark, sf).withColumnRenamed("request_id", "response_id")
    now = log.select("response_id", "pos", "id", "text", "special", F.when(F.col("pos") > 0, F.col("logprob")).alias("logprob"))
    h = F.md5(F.col("response_id").cast("string"))
    old = now.withColumn("logprob", F.col("logprob") * F.when(hex_digit(h, 1) < 8, 0.9).otherwise(0.7))
    old = old.filter(~((hex_digit(h, 2) == 0) & (F.col("pos") == 3)))
    return ev.snapshot_compare(now, old)


@query("j06_details_compare", """WITH e AS (SELECT event_id, event_type, user_id, md5(event_id::VARCHAR) AS h FROM events)
 SELECT event_id AS response_id, (substr(h, 1, 1) <> '0' AND substr(h, 2, 1) NOT IN ('0', '1') AND substr(h, 3, 1) <> '0')::INT AS matches FROM e""")
def j06_details(spark, sf):
    """Responses against a run in which some texts, finish reasons or seeds are others, or missing."""
    e = table(spark, sf, "events").withColumn("h", F.md5(F.col("event_id").cast("string")))
    now = e.select(F.col("event_id").alias("response_id"), F.col("event_type").alias("generated_text"), F.lit("length").alias("finish_reason"),
                   F.length("event_type").alias("generated_tokens"), F.when(F.col("user_id") % 2 == 0, F.col("user_id")).alias("seed"), "h")
    before = now.filter(hex_digit(F.col("h"), 3) > 0).withColumns({
        "generated_text": F.when(hex_digit(F.col("h"), 1) == 0, F.lit("other")).otherwise(F.col("generated_text")),
        "finish_reason": F.when(hex_digit(F.col("h"), 2) == 0, F.lit("eos_token")).otherwise(F.col("finish_reason")),
        "seed": F.when(hex_digit(F.col("h"), 2) == 1, F.coalesce("seed", F.lit(0)) + 1).otherwise(F.col("seed"))})
    return ev.details_compare(now.drop("h"), before.drop("h"))


# Token counts ---------------------------------------------------------------------------


@query("a01_length_profile", f"""WITH a AS (SELECT {count('text')} AS n FROM documents) SELECT source, min(n) AS lo, max(n) AS hi FROM a, (SELECT unnest(['length', 'position_ids', 'input_ids']) AS source) GROUP BY source""")
def a01(spark, sf):
    d = fx.documents(spark, sf).select(tk.token_ids("text").alias("input_ids"))
    shapes = {"length": d.select(F.size("input_ids").alias("length")),
              "position_ids": d.select(indices(F.col("input_ids")).alias("position_ids")), "input_ids": d}
    parts = [df.select(F.lit(k).alias("source"), ev.length_column(df).alias("n")) for k, df in shapes.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).groupBy("source").agg(F.min("n").alias("lo"), F.max("n").alias("hi"))


@query("a02_token_totals", f"""WITH {DOCS}, {LEN_SQL} SELECT lang, count(*) AS rows, sum(n)::BIGINT AS tokens, sum({count('output')} + 1)::BIGINT AS supervised_tokens FROM ln JOIN d USING (doc_id, lang) GROUP BY lang""")
def a02(spark, sf):
    return ev.token_totals(fx.encoded_documents(spark, sf), "lang")


@query("a03_chars_per_token", f"""SELECT round(sum(length(text)) / sum({count('text')})::DOUBLE, 6) AS chars_per_token FROM documents""")
def a03(spark, sf):
    return ev.characters_per_token(fx.documents(spark, sf), "text").select(r6(F.col("chars_per_token")).alias("chars_per_token"))


_BINS = multipack_sql(4096) + ", bn AS (SELECT block, sum(n)::BIGINT AS used FROM f GROUP BY block)"


@query("a04_step_estimate", _BINS + """, t AS (SELECT sum(used)::BIGINT AS tokens, count(*) AS bins, (SELECT count(*) FROM f) AS rows FROM bn)
 SELECT ((floor(0.99::DOUBLE * tokens / 0.95::DOUBLE / 2048 / 8) - 1) * 3)::BIGINT AS packed, floor(floor(bins * 2 / 8) * 3)::BIGINT AS binned, ceil(rows * 3 / 8)::BIGINT AS plain FROM t""")
def a04(spark, sf):
    bins = multipacked(spark, sf, 4096)
    per = bins.groupBy("block").agg(F.sum("n").alias("used"), F.count(F.lit(1)).alias("rows"))
    t = per.agg(F.sum("used").alias("tokens"), F.count(F.lit(1)).alias("bins"), F.sum("rows").alias("rows"))
    return t.select(ev.steps_packed(F.col("tokens"), 0.95, 2048, 8, 3).cast("long").alias("packed"),
                    ev.steps_binned(F.col("bins"), 2, 8, 3).cast("long").alias("binned"),
                    ev.steps_plain(F.col("rows"), 8, 3).cast("long").alias("plain"))


@query("a05_packing_efficiency", _BINS + """ SELECT count(*) AS bins, sum(used)::BIGINT AS used, round(sum(used) / (count(*) * 4096)::DOUBLE, 6) AS efficiency,
 ceil(sum(used) / (count(*) * 4096)::DOUBLE * 100) / 100 AS estimate, greatest(0, 2 * floor(0.99::DOUBLE * floor(sum(used) / 2) / 0.95::DOUBLE / 4096) - 1)::BIGINT AS length FROM bn""")
def a05(spark, sf):
    e = ev.packing_efficiency(multipacked(spark, sf, 4096), "n", 4096)
    return e.select("bins", "used", r6(F.col("efficiency")).alias("efficiency"), "estimate",
                    ev.length_estimate(F.col("used"), 0.95, 4096, world=2).cast("long").alias("length"))


# Scores ---------------------------------------------------------------------------------


@query("a06_benchmark_accuracy", f"""WITH e AS (SELECT 'NATION_' || label AS name, list_position(embedding[1:4], list_max(embedding[1:4])) - 1 AS pr, {digit('md5(vec_id::VARCHAR)', 1)} % 4 AS re,
 {digit('md5(vec_id::VARCHAR)', 2, 3)} / 1000.0::DOUBLE AS loss FROM embeddings), n AS (SELECT n_name AS name FROM nation),
 per AS (SELECT n.name, count(e.name) AS n, sum((pr = re)::INT) AS r, sum(loss) AS loss FROM n LEFT JOIN e ON e.name = n.name GROUP BY n.name),
 acc AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE r / n::DOUBLE END AS a FROM per)
 SELECT 'accuracy_' || name AS metric, round(a, 6) AS value FROM acc UNION ALL SELECT 'average_accuracy', round(avg(a), 6) FROM acc
 UNION ALL SELECT 'total_accuracy', round(sum(r) / sum(n)::DOUBLE, 6) FROM acc UNION ALL SELECT 'loss', round(sum(loss) / sum(n), 6) FROM acc""")
def a06(spark, sf):
    h = F.md5(F.col("vec_id").cast("string"))
    e = table(spark, sf, "embeddings").select(
        F.concat(F.lit("NATION_"), F.col("label").cast("string")).alias("name"),
        ev.choice_index(F.slice("embedding", 1, 4)).alias("prediction"), (hex_digit(h, 1) % 4).alias("reference"),
        (hex_digit(h, 2, 3) / 1000.0).alias("loss"))
    names = table(spark, sf, "nation").select(F.col("n_name").alias("name"))
    return ev.benchmark_accuracy(e, names).withColumn("value", r6(F.col("value")))


@query("a07_test_case_score", f"""WITH {CASES_SQL} SELECT program_id, round(avg(coalesce((trim(replace(output, chr(13) || chr(10), chr(10)), chr(10)) = trim(replace(expected, chr(13) || chr(10), chr(10)), chr(10)))::INT, 0)), 6) AS score,
 count(*) AS cases FROM ou JOIN cs USING (problem_id, case_no) GROUP BY program_id""")
def a07(spark, sf):
    rows = ev.test_case_score(ev.outputs_with_cases(program_outputs(spark, sf), cases(spark, sf)))
    return rows.withColumn("score", r6(F.col("score")))


_REWARDS = ("rw AS (SELECT pair_id, conv_id, (" + digit("md5(pair_id::VARCHAR)", 1, 3) + " - 2048) / 256.0::DOUBLE AS c, ("
            + digit("md5(pair_id::VARCHAR)", 4, 3) + " - 2048) / 256.0::DOUBLE AS r FROM p)")


def rewards(spark, sf):
    h = F.md5(F.col("pair_id").cast("string"))
    return fx.pairs(spark, sf).select("pair_id", "conv_id", ((hex_digit(h, 1, 3) - 2048) / 256.0).alias("c"),
                                      ((hex_digit(h, 4, 3) - 2048) / 256.0).alias("r"))


@query("a08_pairwise_reward", f"""WITH {PAIRS}, {_REWARDS} SELECT round(avg((c >= r)::INT), 6) AS accuracy, round(avg(greatest(r - c, 0) + ln(1 + exp(-abs(c - r)))), 6) AS loss FROM rw""")
def a08(spark, sf):
    return rewards(spark, sf).agg(*ev.pairwise_reward("c", "r")).select(r6(F.col("accuracy")).alias("accuracy"), r6(F.col("loss")).alias("loss"))


@query("a09_preference_log", f"""WITH {PAIRS}, {_REWARDS}, a AS (SELECT CASE WHEN conv_id % 4 = 0 THEN 'eval' ELSE 'train' END AS split, c, r FROM rw)
 SELECT split, round(sum(c) / sum(2), 6) AS rewards_chosen, round(sum(r) / sum(2), 6) AS rewards_rejected, round(sum(c - 3) / sum(2), 6) AS logps_chosen,
 round(sum(r - 3) / sum(2), 6) AS logps_rejected, round(sum(c * 2) / sum(2), 6) AS logits_chosen, round(sum(r * 2) / sum(2), 6) AS logits_rejected,
 round(sum(c) / sum(2) - sum(r) / sum(2), 6) AS rewards_margins FROM a GROUP BY split""")
def a09(spark, sf):
    rows = rewards(spark, sf).withColumn("s", F.explode(F.array(
        F.struct(F.lit("chosen").alias("side"), F.col("c").alias("v")), F.struct(F.lit("rejected").alias("side"), F.col("r").alias("v")))))
    log = rows.select(F.when(F.col("conv_id") % 4 == 0, "eval").otherwise("train").alias("split"), "s.side", F.lit(2).alias("count"),
                      F.col("s.v").alias("rewards"), (F.col("s.v") - 3).alias("logps"), (F.col("s.v") * 2).alias("logits"))
    done = ev.preference_log(log)
    return done.select("split", *[r6(F.col(c)).alias(c) for c in done.columns if c != "split"])


_LOG10 = " UNION ALL ".join(
    f"SELECT pair_id, '{s}' AS side, {a} AS answer, unnest(range({count(t)})) AS k, unnest({words(t)}) AS tok FROM p"
    for s, a, t in (("chosen", "false", "prompt"), ("chosen", "true", "chosen"), ("rejected", "false", "prompt"), ("rejected", "true", "rejected")))


@query("a10_odds_ratio", f"""WITH {PAIRS}, lg AS ({_LOG10}), m AS (SELECT pair_id, avg(lp) FILTER (side = 'chosen' AND answer) AS c, avg(lp) FILTER (side = 'rejected' AND answer) AS r
 FROM (SELECT *, -({digit('md5(tok || k)', 1, 4)} + 1) / 32768.0::DOUBLE AS lp FROM lg) GROUP BY pair_id),
 o AS (SELECT *, (c - r) - (ln(1 - exp(c)) - ln(1 - exp(r))) AS od FROM m)
 SELECT pair_id, round(c, 6) AS chosen, round(r, 6) AS rejected, round(od, 6) AS log_odds, round(least(od, 0) - ln(1 + exp(-abs(od))), 6) AS ratio FROM o""")
def a10(spark, sf):
    parts = F.array(*[F.struct(F.lit(s).alias("side"), F.lit(a).alias("answer"), tk.token_texts(t).alias("w"))
                      for s, a, t in (("chosen", False, "prompt"), ("chosen", True, "chosen"), ("rejected", False, "prompt"), ("rejected", True, "rejected"))])
    flat = fx.pairs(spark, sf).select("pair_id", F.explode(parts).alias("s")).select(
        "pair_id", "s.side", "s.answer", F.posexplode("s.w").alias("k", "tok"))
    log = flat.withColumn("logprob", -(hex_digit(F.md5(F.concat("tok", F.col("k").cast("string"))), 1, 4) + 1) / 32768.0)
    return ev.odds_ratio(log).select("pair_id", *[r6(F.col(c)).alias(c) for c in ("chosen", "rejected", "log_odds", "ratio")])


@query("a11_perplexity", f"""WITH w AS (SELECT doc_id, {words('text')} AS w FROM documents), t AS (SELECT doc_id, unnest(range(len(w))) AS pos, unnest(w) AS tok FROM w),
 l AS (SELECT doc_id, pos, {digit('md5(tok)', 1, 4)} / 16384.0::DOUBLE AS loss FROM t),
 g AS (SELECT doc_id, CASE WHEN pos < 512 THEN 0 ELSE ceil((pos - 511) / 256.0)::INT END AS k, avg(loss) AS a FROM l WHERE pos > 0 GROUP BY 1, 2)
 SELECT doc_id, count(*) AS windows, round(exp(avg(a)), 6) AS score FROM g GROUP BY doc_id""")
def a11(spark, sf):
    t = fx.documents(spark, sf).select("doc_id", F.posexplode(tk.token_texts("text")).alias("pos", "tok"))
    losses = t.filter("pos > 0").withColumn("loss", hex_digit(F.md5("tok"), 1, 4) / 16384.0)
    return ev.perplexity(losses, "doc_id").withColumn("score", r6(F.col("score")))


# Timing ---------------------------------------------------------------------------------

TIMING_SQL = ("tm AS (SELECT event_id, event_type AS step, (1 << (" + digit("md5(event_id::VARCHAR)", 1) + " % 4))::INT AS batch_size, value + 0.01 AS latency_ms, "
              + "1 + " + digit("md5(event_id::VARCHAR)", 2) + " AS decode_length FROM events)")


def timing(spark, sf):
    return fx.events(spark, sf).select("event_id", F.col("event_type").alias("step"), F.array(*[F.lit(n) for n in (1, 2, 4, 8)])[hex_digit(F.col("h"), 1) % 4].alias("batch_size"),
                                       (F.col("value") + 0.01).alias("latency_ms"), (1 + hex_digit(F.col("h"), 2)).alias("decode_length"))


def _at(p: int) -> str:
    return f"round(coalesce(l[floor({p / 100.0}::DOUBLE * len(l))::BIGINT + 1], 'nan'::DOUBLE), 6) AS p{p}"


@query("a12_latency_table", f"""WITH {TIMING_SQL}, g AS (SELECT step, batch_size, avg(latency_ms) AS a, min(latency_ms) AS lo, max(latency_ms) AS hi, list(latency_ms ORDER BY latency_ms) AS l FROM tm GROUP BY step, batch_size)
 SELECT step, batch_size, round(a, 6) AS average, round(lo, 6) AS lowest, round(hi, 6) AS highest, {_at(50)}, {_at(90)}, {_at(99)} FROM g""")
def a12(spark, sf):
    rows = ev.latency_table(timing(spark, sf), ["step", "batch_size"], "latency_ms")
    return rows.select("step", "batch_size", *[r6(F.col(c)).alias(c) for c in ("average", "lowest", "highest", "p50", "p90", "p99")])


@query("a13_throughput_table", f"""WITH {TIMING_SQL}, t AS (SELECT CASE WHEN step IN ('click', 'view') THEN 'prefill' ELSE 'decode' END AS step, batch_size, latency_ms, decode_length FROM tm)
 SELECT step, batch_size, round(avg(x), 6) AS average, round(min(x), 6) AS lowest, round(max(x), 6) AS highest, round(avg(tl), 6) AS token_latency FROM (
 SELECT step, batch_size, CASE WHEN step = 'prefill' THEN batch_size ELSE batch_size * decode_length END / (latency_ms / 1000) AS x,
 CASE WHEN step = 'decode' THEN latency_ms / decode_length END AS tl FROM t) GROUP BY step, batch_size""")
def a13(spark, sf):
    t = timing(spark, sf).withColumn("step", F.when(F.col("step").isin("click", "view"), "prefill").otherwise("decode"))
    rows = ev.throughput_table(t, ["step", "batch_size"])
    return rows.select("step", "batch_size", *[r6(F.col(c)).alias(c) for c in ("average", "lowest", "highest", "token_latency")])


@query("a14_histogram", """WITH e AS (SELECT min(value) AS lo, max(value) AS hi, (max(value) - min(value)) / 19 AS st FROM events),
 c AS (SELECT least(ceil((value - lo) / st), 19)::BIGINT AS bucket, count(*) AS n FROM events, e GROUP BY 1)
 SELECT b.bucket, round(lo + st * b.bucket, 6) AS start, coalesce(n, 0) AS n FROM (SELECT unnest(range(20)) AS bucket) b LEFT JOIN c USING (bucket), e""")
def a14(spark, sf):
    return ev.histogram(table(spark, sf, "events"), "value", 20).withColumn("start", r6(F.col("start")))


RUN_SQL = ("ru AS (SELECT CASE " + digit("md5(event_id::VARCHAR)", 1, 2) + " WHEN 0 THEN 429 WHEN 1 THEN 503 ELSE 200 END AS status, value + 0.5 AS duration_ms, 1 + "
           + digit("md5(event_id::VARCHAR)", 3) + " AS new_tokens, length(props) AS input_tokens FROM events)")


def load_runs(spark, sf):
    code = hex_digit(F.col("h"), 1, 2)
    return fx.events(spark, sf).select("event_id", "ts", F.when(code == 0, 429).when(code == 1, 503).otherwise(200).alias("status"),
                                       (F.col("value") + 0.5).alias("duration_ms"), (1 + hex_digit(F.col("h"), 3)).alias("new_tokens"),
                                       F.length("props").alias("input_tokens"))


@query("a15_load_run", f"""WITH {RUN_SQL}, g AS (SELECT * FROM ru WHERE status < 400 OR status >= 500)
 SELECT count(*) AS requests, count(*) FILTER (status <> 200) AS failed, sum(input_tokens) FILTER (status = 200)::BIGINT AS input_tokens, sum(new_tokens) FILTER (status = 200)::BIGINT AS new_tokens,
 sum(input_tokens + new_tokens) FILTER (status = 200)::BIGINT AS tokens, round(median(duration_ms / new_tokens) FILTER (status = 200), 6) AS time_per_token_p50,
 (count(*) FILTER (status <> 200) = 0 AND median(duration_ms / new_tokens) FILTER (status = 200) < 350)::INT AS passed FROM g""")
def a15(spark, sf):
    return ev.load_run(load_runs(spark, sf), 70).withColumn("time_per_token_p50", r6(F.col("time_per_token_p50")))


# Votes, text metrics, best of n ---------------------------------------------------------


@query("a16_vote_count", f"""SELECT (['model_a', 'model_b', 'tie'])[{digit('md5(event_id::VARCHAR)', 1)} % 3 + 1] AS choice, count(*) AS votes FROM events GROUP BY 1""")
def a16(spark, sf):
    names = F.array(F.lit("model_a"), F.lit("model_b"), F.lit("tie"))
    return ev.vote_count(fx.events(spark, sf).select(names[hex_digit(F.col("h"), 1) % 3].alias("choice")), "choice")


_REFS = f"[rejected, CASE WHEN {digit('md5(pair_id::VARCHAR)', 1)} < 4 THEN chosen ELSE prompt END]"


@query("a17_text_metrics", f"""WITH {PAIRS}, r AS (SELECT pair_id, chosen, unnest(range(2)) AS k, unnest({_REFS}) AS ref FROM p),
 tw AS (SELECT pair_id, k, tok, sum(a)::INT AS a, sum(b)::INT AS b FROM (SELECT pair_id, k, unnest({words('chosen')}) AS tok, 1 AS a, 0 AS b FROM r
 UNION ALL SELECT pair_id, k, unnest({words('ref')}), 0, 1 FROM r) GROUP BY 1, 2, 3),
 f AS (SELECT pair_id, k, 2 * sum(least(a, b)) / sum(a + b)::DOUBLE AS f1 FROM tw GROUP BY 1, 2),
 s AS (SELECT pair_id, max((chosen = ref)::INT) AS em, max(f1) AS f1 FROM r JOIN f USING (pair_id, k) GROUP BY pair_id)
 SELECT round(avg(em), 6) AS eval_exact_match, round(avg(f1), 6) AS eval_token_f1 FROM s""")
def a17(spark, sf):
    h = F.md5(F.col("pair_id").cast("string"))
    p = fx.pairs(spark, sf).withColumn("references", F.array("rejected", F.when(hex_digit(h, 1) < 4, F.col("chosen")).otherwise(F.col("prompt"))))
    done = ev.text_metrics(p.withColumnRenamed("chosen", "prediction"), "pair_id", metrics=("exact_match", "token_f1"))
    return done.select(*[r6(F.col(c)).alias(c) for c in done.columns])


# DuckDB's edit distance counts bytes, so its side gives each other letter an ASCII code that no text has.
_LETTERS = "éèêëàâîïôûçœÉÈÊÀÂÎÔÇäöüßÄÖÜñáíóúÑÁÍÓÚ"
_CODES = " || ".join(f"chr({k})" for k in [*range(1, 9), *range(14, 32), 35, 94, 96, 123, 125, 126, 127, 91, 93, 95, 60][:len(_LETTERS)])


def _ascii(c: str) -> str:
    return f"translate({c}, '{_LETTERS}', {_CODES})"


@query("a17_edit_similarity", f"""WITH {PAIRS}, a AS (SELECT pair_id, {_ascii('chosen')} AS c, {_ascii('rejected')} AS r FROM p)
 SELECT pair_id, round(1 - levenshtein(c, r) / greatest(length(c), length(r))::DOUBLE, 6) AS similarity FROM a""")
def a17_edit(spark, sf):
    return fx.pairs(spark, sf).select("pair_id", r6(ev.edit_similarity("chosen", "rejected")).alias("similarity"))


def _bleu_words(c: str) -> str:
    t = f"replace(replace(replace(replace(replace(replace(replace({c}, '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '), '&quot;', '\"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>')"
    t = f"regexp_replace(' ' || {t} || ' ', '([\\{{-\\~\\[-\\` -\\&\\(-\\+\\:-\\@\\/])', ' \\1 ', 'g')"
    t = f"regexp_replace({t}, '([^0-9])([\\.,])', '\\1 \\2 ', 'g')"
    t = f"regexp_replace({t}, '([\\.,])([^0-9])', ' \\1 \\2', 'g')"
    t = f"regexp_replace({t}, '([0-9])(-)', '\\1 \\2 ', 'g')"
    return f"list_filter(regexp_split_to_array({t}, '\\s+'), lambda w: w <> '')"


def _grams_sql(p: str, r: str, order: int) -> str:
    return f"""WITH {PAIRS}, w AS (SELECT pair_id, {p} AS p, {r} AS r FROM p),
 g AS (SELECT pair_id, n, array_to_string(p[i:i + n - 1], '|~|') AS g, 1 AS a, 0 AS b FROM (SELECT *, unnest(range(1, len(p) - n + 2)) AS i FROM w, range(1, {order + 1}) t(n))
 UNION ALL SELECT pair_id, n, array_to_string(r[i:i + n - 1], '|~|'), 0, 1 FROM (SELECT *, unnest(range(1, len(r) - n + 2)) AS i FROM w, range(1, {order + 1}) t(n))),
 c AS (SELECT n, sum(a) AS p, sum(b) AS r, sum(least(a, b)) AS hit FROM (SELECT pair_id, n, g, sum(a) AS a, sum(b) AS b FROM g GROUP BY ALL) GROUP BY n)"""


@query("a17_bleu", _grams_sql(_bleu_words("chosen"), _bleu_words("rejected"), 4) + """,
 z AS (SELECT *, CASE WHEN hit = 0 THEN 1 / (pow(2, count(*) FILTER (hit = 0) OVER (ORDER BY n)) * p) ELSE hit / p END AS share FROM c)
 SELECT round(100 * (SELECT least(1, exp(1 - r / p)) FROM c WHERE n = 1) * exp(avg(ln(share))), 6) AS bleu FROM z""")
def a17_bleu(spark, sf):
    rows = fx.pairs(spark, sf).select("pair_id", F.col("chosen").alias("prediction"), F.col("rejected").alias("reference"))
    return ev.corpus_bleu(rows, "pair_id").select(r6(F.col("bleu")).alias("bleu"))


def _letters(c: str) -> str:
    return f"list_filter(regexp_split_to_array(regexp_replace({c}, '\\s', '', 'g'), ''), lambda x: x <> '')"


@query("a17_chrf", _grams_sql(_letters("chosen"), _letters("rejected"), 6) + """,
 m AS (SELECT avg(hit / p) AS p, avg(hit / r) AS r FROM c) SELECT round(500 * p * r / (4 * p + r), 6) AS chrf FROM m""")
def a17_chrf(spark, sf):
    rows = fx.pairs(spark, sf).select("pair_id", F.col("chosen").alias("prediction"), F.col("rejected").alias("reference"))
    return ev.corpus_chrf(rows, "pair_id").select(r6(F.col("chrf")).alias("chrf"))


@query("a17_ter")
def a17_ter(spark, sf):
    """Edits with shifts of every answer against two references; tests compare with a plain version and with worked examples."""
    rows = fx.pairs(spark, sf).withColumn("references", F.array("rejected", "prompt"))
    return edits.edit_rows(rows, "pair_id", "chosen", "references")


_WORD_LIST = "list_filter(regexp_split_to_array(lower({c}), '\\s+'), lambda w: w <> '')"


@query("a17_ter_bounds", f"""WITH {PAIRS}, w AS (SELECT pair_id, {_WORD_LIST.format(c='chosen')} AS p, {_WORD_LIST.format(c='rejected')} AS r FROM p),
 u AS (SELECT pair_id, unnest(p) AS t, 1 AS a, 0 AS b FROM w UNION ALL SELECT pair_id, unnest(r), 0, 1 FROM w),
 c AS (SELECT pair_id, sum(least(a, b)) AS common FROM (SELECT pair_id, t, sum(a) AS a, sum(b) AS b FROM u GROUP BY pair_id, t) GROUP BY pair_id)
 SELECT pair_id, len(r)::DOUBLE AS words, (greatest(len(p), len(r)) - common)::BIGINT AS least_edits, true AS within FROM w JOIN c USING (pair_id)""")
def a17_ter_bounds(spark, sf):
    """Words, the edits that no order of words can save, and whether the edits found lie between those and the longer text."""
    rows = fx.pairs(spark, sf).withColumn("references", F.array("rejected"))
    found = edits.edit_rows(rows, "pair_id", "chosen", "references")
    sides = rows.select("pair_id", F.explode(F.array(*[F.struct(F.lit(int(k == 0)).alias("p"), F.lit(k).alias("r"), F.filter(F.split(F.lower(c), r"\s+"), lambda w: w != "").alias("t"))
                                                       for k, c in enumerate(("chosen", "rejected"))])).alias("s"))
    tokens = sides.select("pair_id", "s.p", "s.r", F.explode("s.t").alias("t")).groupBy("pair_id", "t").agg(F.sum("p").alias("p"), F.sum("r").alias("r"))
    counts = tokens.groupBy("pair_id").agg(F.sum("p").alias("p"), F.sum("r").alias("r"), F.sum(F.least("p", "r")).alias("common"))
    both = found.join(counts, "pair_id")
    least = F.greatest("p", "r") - F.col("common")
    return both.select("pair_id", "words", least.cast("long").alias("least_edits"),
                       ((F.col("edits") >= least) & (F.col("edits") <= F.greatest("p", "r"))).alias("within"))


@query("a18_prediction_table", f"""{_K05}, o AS (SELECT block, place - 1 AS "range", p, o FROM pl JOIN t USING (doc_id) ORDER BY block, place LIMIT 200)
 SELECT block, "range", {dig('p')} AS prompt_ids, {dig('o')} AS completion_ids, {dig('list_transform(o, lambda z: z + 1)')} AS predicted_ids FROM o""")
def a18(spark, sf):
    # the 200 rows are chosen by their places; arrays are joined to those only
    members = multipacked(spark, sf, 2048).select("block", F.col("place").alias("range"), "doc_id").orderBy("block", "range").limit(200)
    data = fx.encoded_documents(spark, sf).select("doc_id", "input_ids", "labels")
    rows = pack.with_members(members, data, "doc_id").withColumn("predicted", F.transform("input_ids", lambda x: x + 1))
    done = ev.prediction_split(rows)
    return done.select("block", "range", *[digest(c).alias(c) for c in ("prompt_ids", "completion_ids", "predicted_ids")])


@query("a19_best_of", f"""WITH {TOKEN_LOG_SQL}, s AS (SELECT request_id // 10000000 AS prompt_id, request_id % 10000000 AS try, avg(logprob) AS score FROM tl GROUP BY 1, 2)
 SELECT prompt_id, try, round(score, 6) AS score, (row_number() OVER (PARTITION BY prompt_id ORDER BY score DESC, try) = 1)::INT AS is_best FROM s""")
def a19(spark, sf):
    log = fx.token_log(spark, sf).select(F.expr("request_id div 10000000").alias("prompt_id"), (F.col("request_id") % fx.MOST_TURNS).alias("try"), "logprob")
    return ev.best_of(log).withColumn("score", r6(F.col("score")))


@query("w01_consecutive_violations", """WITH r AS (SELECT user_id, event_id, value > 40 AS bad, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rn FROM events),
 g AS (SELECT *, rn - coalesce(max(rn) FILTER (NOT bad) OVER (PARTITION BY user_id ORDER BY rn), 0) AS streak FROM r)
 SELECT user_id, min(rn) AS step_number, arg_min(event_id, rn) AS event_id FROM g WHERE streak >= 4 GROUP BY user_id""")
def w01(spark, sf):
    return ev.first_violation(table(spark, sf, "events"), "user_id", "event_id", "value", 40.0, 4)


# Scalar functions -----------------------------------------------------------------------


@query("l01_hashes", "SELECT doc_id, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def l01(spark, sf):
    return fx.documents(spark, sf).select("doc_id", tx.md5_text("text").alias("md5"), tx.sha256_text("text").alias("sha256"))


REVIEW_SQL = ("rv AS (SELECT event_id, CASE h WHEN 0 THEN '8' WHEN 1 THEN 'a b' WHEN 2 THEN '7.5 x' WHEN 3 THEN h2 || ',' || h WHEN 4 THEN h2 || ' ' || h || ' 1' ELSE h || ' ' || h2 END "
              "|| chr(10) || event_type || chr(10) || CASE WHEN h2 < 4 THEN ' ' || h2 || ' ' WHEN h2 < 6 THEN 'none' ELSE h2::VARCHAR END || chr(10) AS review FROM (SELECT *, "
              + digit("md5(event_id::VARCHAR)", 1) + " AS h, " + digit("md5(event_id::VARCHAR)", 2) + " AS h2 FROM events))")


def reviews(spark, sf):
    a, b = hex_digit(F.col("h"), 1), hex_digit(F.col("h"), 2)
    s, t = a.cast("string"), b.cast("string")
    first = (F.when(a == 0, "8").when(a == 1, "a b").when(a == 2, "7.5 x").when(a == 3, F.concat(t, F.lit(","), s))
             .when(a == 4, F.concat(t, F.lit(" "), s, F.lit(" 1"))).otherwise(F.concat(s, F.lit(" "), t)))
    last = F.when(b < 4, F.concat(F.lit(" "), t, F.lit(" "))).when(b < 6, "none").otherwise(t)
    return fx.events(spark, sf).select("event_id", F.concat(first, F.lit("\n"), "event_type", F.lit("\n"), last, F.lit("\n")).alias("review"))


@query("l02_score_pair", f"""WITH {REVIEW_SQL}, p AS (SELECT event_id, string_split(replace(split_part(review, chr(10), 1), ',', ' '), ' ') AS w FROM rv),
 n AS (SELECT event_id, len(w) = 2 AND try_cast(w[1] AS DOUBLE) IS NOT NULL AND try_cast(w[2] AS DOUBLE) IS NOT NULL AS ok, try_cast(w[1] AS DOUBLE) AS a, try_cast(w[2] AS DOUBLE) AS b FROM p)
 SELECT event_id, CASE WHEN ok THEN a ELSE -1 END AS first, CASE WHEN ok THEN b ELSE -1 END AS second FROM n""")
def l02(spark, sf):
    pair = tx.parse_score_pair("review")
    return reviews(spark, sf).select("event_id", pair.alias("p")).select("event_id", F.col("p")[0].alias("first"), F.col("p")[1].alias("second"))


@query("l03_class_score", f"""WITH {REVIEW_SQL} SELECT event_id, coalesce(try_cast({trim("list_last(string_split(" + trim('review') + ", chr(10)))")} AS INT), -1) AS score FROM rv""")
def l03(spark, sf):
    return reviews(spark, sf).select("event_id", tx.parse_class_score("review").alias("score"))


@query("l04_cut_at_marker", "SELECT doc_id, split_part(text, '. ', 1) AS lead FROM documents")
def l04(spark, sf):
    d = fx.documents(spark, sf)
    return d.select("doc_id", tx.cut_at(tx.first_present(d, ["generation_truncated", "generation", "text"]), ". ").alias("lead"))


@query("l05_normalise_output", f"""WITH {DOCS} SELECT doc_id, {trim("replace(text, head, '')")} AS prediction, text || chr(10) || 'x' AS output FROM (SELECT doc_id, head, trim(text, chr(10)) AS text FROM d)""")
def l05(spark, sf):
    d = fx.docs(spark, sf).withColumn("text", F.btrim("text", F.lit("\n")))
    noisy = F.concat(F.lit("\r\n"), "text", F.lit("\r\nx\n\n"))
    return d.select("doc_id", tx.remove_input("text", "head").alias("prediction"), tx.normalise_output(noisy).alias("output"))


@query("l06_masked_cleanup", f"WITH {ENC_SQL} SELECT conv_id, {cat('list_transform(l, lambda z: CASE z WHEN -100 THEN 0 ELSE z END)')} AS ids FROM enc")
def l06(spark, sf):
    return fx.encoded_conversations(spark, sf).select("conv_id", joined(tx.clear_ignored("labels")).alias("ids"))
