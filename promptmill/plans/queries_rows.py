"""Filters, dedup, splits and packing."""

from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from promptmill.functions import tokens as tk
from promptmill.operators import chat, dedup, evaluate as ev, filters, folds, labels as lb, order, pack, split
from promptmill.plans import fixtures as fx
from promptmill.plans.fixtures import REQUESTS_SQL
from promptmill.plans.kit import DOCS, PAIRS, cat, count, dig, digit, fold, hex_digit, ids, query, rep, table
from promptmill.plans.queries_tokens import ENC_SQL, out
from promptmill.session import materialise

LEN_SQL = f"ln AS (SELECT doc_id, lang, source, {count('instruction || chr(10) || input || chr(10)')} + {count('output')} + 1 AS n FROM d)"


# Filters --------------------------------------------------------------------------------


@query("f01_length_band", f"WITH {DOCS}, {LEN_SQL} SELECT doc_id, n FROM ln WHERE n BETWEEN 2 AND 512")
def f01(spark, sf):
    rows = fx.document_lengths(spark, sf)
    return rows.filter(filters.length_fits(F.col("n"), 512)).select("doc_id", "n")


@query("f02_trainable", f"""WITH {ENC_SQL} SELECT conv_id, len(i) AS n FROM enc
 WHERE len(list_filter(l, lambda z: z <> -100)) > 0 AND {digit('md5(conv_id::VARCHAR)', 1)} >= 4""")
def f02(spark, sf):
    masked = hex_digit(F.md5(F.col("conv_id").cast("string")), 1) < 4
    rows = fx.encoded_conversations(spark, sf).withColumn("labels", F.when(
        masked, F.transform("labels", lambda x: F.lit(tk.IGNORED))).otherwise(F.col("labels")))
    return rows.filter(filters.has_trainable("labels")).select("conv_id", F.size("input_ids").alias("n"))


@query("f03_preference_length", f"""WITH {PAIRS}, a AS (SELECT pair_id, {count('prompt')} AS p, {count('chosen')} AS c, {count('rejected')} AS r FROM p)
 SELECT pair_id, 'dpo' AS kind FROM a WHERE p + c <= 150 AND p + r <= 150 UNION ALL SELECT pair_id, 'kto' FROM a WHERE p + c <= 150""")
def f03(spark, sf):
    p = fx.pairs(spark, sf).withColumn("completion", F.col("chosen"))
    parts = [p.filter(filters.preference_fits(k, 150)).select("pair_id", F.lit(k).alias("kind")) for k in ("dpo", "kto")]
    return parts[0].unionByName(parts[1])


@query("f04_required_keys", f"""WITH {PAIRS}, a AS (SELECT pair_id, CASE WHEN length(prompt) < 150 THEN '' ELSE prompt END AS prompt, CASE WHEN length(chosen) % 3 = 0 THEN NULL ELSE chosen END AS chosen,
 rejected FROM p) SELECT pair_id, CASE WHEN coalesce(length(prompt), 0) = 0 THEN 'prompt' WHEN coalesce(length(chosen), 0) = 0 THEN 'chosen'
 WHEN coalesce(length(rejected), 0) = 0 THEN 'rejected' END AS missing FROM a""")
def f04(spark, sf):
    p = fx.pairs(spark, sf).withColumns({"prompt": F.when(F.length("prompt") < 150, "").otherwise(F.col("prompt")),
                                         "chosen": F.when(F.length("chosen") % 3 != 0, F.col("chosen"))})
    return p.select("pair_id", filters.missing_key(p, "dpo").alias("missing"))


@query("f05_character_pair", f"WITH {PAIRS} SELECT pair_id FROM p WHERE length(prompt) + length(chosen) <= 800 AND length(prompt) + length(rejected) <= 800")
def f05(spark, sf):
    return fx.pairs(spark, sf).filter(filters.characters_fit(800)).select("pair_id")


@query("f06_token_pair", f"""WITH {PAIRS} SELECT pair_id, 'joined' AS rule FROM p WHERE {count('prompt || chosen')} <= 150
 UNION ALL SELECT pair_id, 'both' FROM p WHERE {count('chosen')} <= 80 AND {count('rejected')} <= 80""")
def f06(spark, sf):
    p = fx.pairs(spark, sf)
    one = p.filter(filters.joined_tokens_fit(["prompt", "chosen"], 150)).select("pair_id", F.lit("joined").alias("rule"))
    ids_ = p.withColumns({"c": tk.token_ids("chosen"), "r": tk.token_ids("rejected")})
    return one.unionByName(ids_.filter(filters.both_fit("c", "r", 80)).select("pair_id", F.lit("both").alias("rule")))


@query("f07_example_length", f"SELECT doc_id FROM documents WHERE {count('text')} <= 300")
def f07(spark, sf):
    return fx.documents(spark, sf).filter(filters.example_fits("text", 300)).select("doc_id")


CHOICES = ("A", "B", "C", "D")


def word_id(word: str) -> int:
    return tk.FIRST_WORD_ID + int(hashlib.md5(word.encode()).hexdigest()[:7], 16)


@query("f08_choice_answer", f"""SELECT doc_id, upper(lang[1:1]) AS choice FROM documents
 WHERE upper(lang[1:1]) IN ('A', 'B', 'C', 'D')""")
def f08(spark, sf):
    d = fx.documents(spark, sf).withColumn("choice", F.upper(F.substring("lang", 1, 1)))
    rows = lb.with_encoded(d, lb.prompt_masked("text", "choice"))
    return rows.filter(filters.choice_answer("labels", [word_id(w) for w in CHOICES])).select("doc_id", "choice")


F09_SQL = """CASE WHEN coalesce(best_of, 1) < 1 OR coalesce(best_of, 1) > 2 THEN 'best_of'
 WHEN coalesce(best_of, 1) > 1 AND NOT (do_sample OR temperature IS NOT NULL OR top_k IS NOT NULL OR top_p IS NOT NULL OR typical_p IS NOT NULL) THEN 'best_of_sampling'
 WHEN temperature <= 0 THEN 'temperature' WHEN repetition_penalty <= 0 THEN 'repetition_penalty' WHEN top_p <= 0 OR top_p >= 1 THEN 'top_p'
 WHEN typical_p <= 0 OR typical_p >= 1 THEN 'typical_p' WHEN top_k <= 0 THEN 'top_k' WHEN max_new_tokens = 0 THEN 'max_new_tokens'
 WHEN stops > 4 THEN 'stop_sequences' WHEN coalesce(best_of, 1) > 1 AND seed IS NOT NULL THEN 'best_of_seed' WHEN top_n_tokens > 5 THEN 'top_n_tokens'
 WHEN length(inputs) = 0 THEN 'empty_input' WHEN truncate = 0 OR truncate > 1024 THEN 'truncate'
 WHEN least(input_length, coalesce(truncate, input_length)) + coalesce(max_new_tokens, greatest(2048 - least(input_length, coalesce(truncate, input_length)), 0)) > 2048 THEN 'total_tokens'
 WHEN least(input_length, coalesce(truncate, input_length)) > 1024 THEN 'input_length' END"""


@query("f09_request_validation", f"WITH {REQUESTS_SQL} SELECT request_id, {F09_SQL} AS reason FROM rq")
def f09(spark, sf):
    return fx.requests(spark, sf).select("request_id", filters.request_reason().alias("reason"))


_BROKEN = "CASE WHEN ('0x' || substr(md5(conv_id || '|' || turn), 1, 2))::INT < 12 THEN 'user' ELSE role END"


@query("f10_alternating_roles", f"""WITH t AS (SELECT conv_id, turn, {_BROKEN} AS role FROM conversations),
 g AS (SELECT conv_id, list(role ORDER BY turn) AS r FROM t GROUP BY conv_id),
 k AS (SELECT conv_id, r, list_filter(r, lambda x: x <> 'system') AS k FROM g)
 SELECT conv_id, len(k) AS turns, CASE WHEN len(k) < 2 THEN 'too short' WHEN len(list_filter(r[2:], lambda x: x = 'system')) > 0 THEN 'late system turn'
 WHEN len(list_filter(range(2, len(k) + 1), lambda i: k[i] = k[i - 1])) > 0 THEN 'roles do not alternate' END AS reason FROM k""")
def f10(spark, sf):
    h = F.md5(F.concat_ws("|", "conv_id", "turn"))
    t = fx.turns(spark, sf).withColumn("role", F.when(
        F.conv(F.substring(h, 1, 2), 16, 10).cast("int") < 12, "user").otherwise(F.col("role")))
    return chat.role_report(t)


@query("f11_drop_report", f"""WITH {DOCS}, {LEN_SQL}, a AS (SELECT source, n, lang, doc_id FROM ln)
 SELECT source, count(*) AS before, count(*) FILTER (n < 2 OR n > 512) AS dropped_length, count(*) FILTER (n BETWEEN 2 AND 512 AND lang = 'de') AS dropped_language,
 count(*) FILTER (n BETWEEN 2 AND 512 AND lang <> 'de') AS after FROM a GROUP BY source""")
def f11(spark, sf):
    return filters.drop_report(fx.document_lengths(spark, sf), {
        "length": F.col("n").between(2, 512), "language": F.col("lang") != "de"})


# Dedup ----------------------------------------------------------------------------------


@query("d01_exact_dedup", "SELECT min(doc_id) AS doc_id, text, lang FROM documents GROUP BY text, lang")
def d01(spark, sf):
    return dedup.dedup(fx.documents(spark, sf).select("doc_id", "text", "lang"), "doc_id")


def _splits(spark, sf):
    d = fx.documents(spark, sf).select("doc_id", "text")
    marked = table(spark, sf, "labels").select("doc_id")
    return d.join(marked, "doc_id", "left_anti"), d.join(marked, "doc_id", "left_semi")


@query("d02_cross_split", """WITH tr AS (SELECT doc_id, text FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)),
 ev AS (SELECT doc_id, text FROM documents WHERE doc_id IN (SELECT doc_id FROM labels))
 SELECT 'train' AS split, min(doc_id) AS doc_id, text FROM tr GROUP BY text UNION ALL
 SELECT 'eval', min(doc_id), text FROM ev WHERE text NOT IN (SELECT text FROM tr) GROUP BY text""")
def d02(spark, sf):
    train, evaluation = dedup.cross_dedup(*_splits(spark, sf), "doc_id")
    return train.withColumn("split", F.lit("train")).unionByName(evaluation.withColumn("split", F.lit("eval")))


@query("d03_union", """SELECT doc_id AS id, text, lang, NULL::BIGINT AS turn FROM documents UNION ALL
 SELECT conv_id, text, NULL, turn FROM conversations UNION ALL SELECT item_id, text, NULL, NULL FROM benchmark""")
def d03(spark, sf):
    return dedup.union_all([
        fx.documents(spark, sf).select(F.col("doc_id").alias("id"), "text", "lang"),
        fx.turns(spark, sf).select("turn", F.col("conv_id").alias("id"), "text"),
        table(spark, sf, "benchmark").select("text", F.col("item_id").alias("id"))])


@query("d04_distinct_keys", "SELECT DISTINCT source || '-' || lang AS src FROM documents")
def d04(spark, sf):
    d = fx.documents(spark, sf).withColumn("src", F.concat_ws("-", "source", "lang"))
    marked = table(spark, sf, "labels").select("doc_id")
    return dedup.key_set([d.join(marked, "doc_id", "left_anti"), d.join(marked, "doc_id", "left_semi")], "src")


# Order, samples and splits --------------------------------------------------------------


@query("r01_seeded_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS place FROM documents")
def r01(spark, sf):
    return order.shuffled_ordinal(fx.documents(spark, sf).select("doc_id"), 42, "doc_id", out="place")


@query("r02_shard", """SELECT l_orderkey, l_linenumber, ('0x' || substr(md5('42|' || l_orderkey), 1, 8))::BIGINT % 8 AS shard FROM lineitem
 WHERE ('0x' || substr(md5('42|' || l_orderkey), 1, 8))::BIGINT % 8 = 3""")
def r02(spark, sf):
    rows = split.shard(table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"), "l_orderkey", 8, 3)
    return rows.withColumn("shard", F.lit(3).cast("long"))


@query("r02_exact_shard", """SELECT o_orderkey, ordinal FROM (SELECT o_orderkey, row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) - 1 AS ordinal FROM orders) WHERE ordinal % 8 = 3""")
def r02_exact(spark, sf):
    return split.exact_shard(order.shuffled_ordinal(table(spark, sf, "orders").select("o_orderkey"), 42, "o_orderkey"), 8, 3)


@query("r03_ordered_split", """SELECT o_orderkey, CASE WHEN row_number() OVER (ORDER BY o_orderkey) > count(*) OVER () - ceil(count(*) OVER () * 0.05)
 THEN 'test' ELSE 'train' END AS split FROM orders""")
def r03(spark, sf):
    return split.ordered_split(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 0.05)


@query("r04_random_split", """SELECT o_orderkey, CASE WHEN ('0x' || substr(md5('42|' || o_orderkey), 1, 7))::INT / 268435456.0::DOUBLE < 0.1 THEN 'test' ELSE 'train' END AS split,
 CASE WHEN row_number() OVER (ORDER BY md5('42|' || o_orderkey), o_orderkey) > count(*) OVER () - 100 THEN 'test' ELSE 'train' END AS exact FROM orders""")
def r04(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey")
    return split.exact_split(split.random_split(o, "o_orderkey", 0.1), "o_orderkey", 100, out="exact")


@query("r05_head", "SELECT doc_id, md5(text) AS text FROM documents ORDER BY doc_id LIMIT 100")
def r05(spark, sf):
    return split.head(fx.documents(spark, sf), "doc_id", 100).select("doc_id", F.md5("text").alias("text"))


@query("r06_exact_sample", "SELECT o_orderkey, o_custkey FROM orders ORDER BY md5('0|' || o_orderkey), o_orderkey LIMIT 200")
def r06(spark, sf):
    return split.sample_exactly(table(spark, sf, "orders"), "o_orderkey", 200).select("o_orderkey", "o_custkey")


@query("r07_take_skip", "SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY doc_id) <= 50 THEN 'valid' ELSE 'train' END AS split FROM documents")
def r07(spark, sf):
    return split.take_skip(fx.documents(spark, sf).select("doc_id"), "doc_id", 50)


@query("r08_buffered_shuffle", """WITH o AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o FROM documents)
 SELECT doc_id, o // 128 * 128 + row_number() OVER (PARTITION BY o // 128 ORDER BY md5('42|' || doc_id), doc_id) - 1 AS place FROM o""")
def r08(spark, sf):
    return split.buffered_shuffle(fx.documents(spark, sf).select("doc_id"), "doc_id", 128)


@query("r09_curriculum", f"SELECT doc_id, {count('text')} AS n FROM documents")
def r09(spark, sf):
    rows = fx.documents(spark, sf).select("doc_id", tk.token_count("text").alias("n"))
    return split.curriculum(rows, "n", "doc_id")


@query("r10_group_length", f"""WITH {DOCS}, {PAIRS} SELECT doc_id AS id, 'pair' AS kind, length(input) + length(output) AS length, (length(input) + length(output)) // 512 AS band FROM d
 UNION ALL SELECT doc_id, 'text', length(text), length(text) // 512 FROM d
 UNION ALL SELECT pair_id, 'pair_max', greatest(length(chosen), length(rejected)), greatest(length(chosen), length(rejected)) // 512 FROM p
 UNION ALL SELECT conv_id, 'messages', sum(length(text))::BIGINT, sum(length(text))::BIGINT // 512 FROM conversations GROUP BY conv_id""")
def r10(spark, sf):
    d, p, c = fx.docs(spark, sf), fx.pairs(spark, sf), fx.conversations(spark, sf)
    parts = [df.select(F.col(k).alias("id"), F.lit(kind).alias("kind"), split.group_length(kind).alias("length"))
             for df, k, kind in ((d, "doc_id", "pair"), (d, "doc_id", "text"), (p, "pair_id", "pair_max"), (c, "conv_id", "messages"))]
    return dedup.union_all(parts).withColumn("band", split.bands("length", 512))


@query("r11_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey) - 1 AS id FROM orders")
def r11(spark, sf):
    return order.ordinal(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", out="id")


@query("r12_repeated_tries", "SELECT doc_id, unnest([1, 2, 3]) AS try FROM documents")
def r12(spark, sf):
    return split.repeated(fx.documents(spark, sf).select("doc_id"), 3)


@query("r13_dictionary", """WITH k AS (SELECT l_suppkey, row_number() OVER (ORDER BY md5('0|' || l_suppkey), l_suppkey) - 1 AS index FROM (SELECT DISTINCT l_suppkey FROM lineitem))
 SELECT l_orderkey, l_linenumber, index FROM lineitem JOIN k USING (l_suppkey)""")
def r13(spark, sf):
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey")
    return split.encode_keys(rows, split.dictionary(rows, "l_suppkey"), "l_suppkey").drop("l_suppkey")


# Packing --------------------------------------------------------------------------------

BUFFER = 10_000


K01_SQL = fold(f"""SELECT o // {BUFFER} AS grp, row_number() OVER (PARTITION BY o // {BUFFER} ORDER BY o, w) AS i, doc_id || '-' || w AS key, least(n - w * 1022, 1022) + 2 AS n
 FROM (SELECT *, unnest(range(0, greatest(1, (n + 1021) // 1022))) AS w FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS o, {count('text')} AS n FROM documents))""", 1024) + f""",
 t AS (SELECT doc_id || '-' || w AS key, ids[w * 1022 + 1:w * 1022 + 1022] AS i FROM (SELECT *, unnest(range(0, greatest(1, (len(ids) + 1021) // 1022))) AS w FROM (SELECT doc_id, {ids('text')} AS ids FROM documents))),
 b AS (SELECT f.grp AS chunk, f.block, flatten(list(t.i || [2, 0] ORDER BY f.i)) AS ids, flatten(list(t.i || [2, -100] ORDER BY f.i)) AS l,
 flatten(list({rep(1, 'len(t.i) + 1')} || [0] ORDER BY f.i)) AS a FROM f JOIN t ON t.key = f.key GROUP BY f.grp, f.block)
 SELECT chunk, block, 1024 AS n, {dig(f"ids || {rep(0, '1024 - len(ids)')}")} AS input_ids, {dig(f"l || {rep(-100, '1024 - len(l)')}")} AS labels,
 {dig(f"a || {rep(0, '1024 - len(a)')}")} AS attention_mask FROM b"""


@query("k01_concat_pad", K01_SQL)
def k01(spark, sf):
    from promptmill.streaming.jobs import pretrain_blocks
    return out(pretrain_blocks(fx.documents(spark, sf), "doc_id", "text", 1024, BUFFER), "chunk", "block",
               columns=("input_ids", "labels", "attention_mask"))


@query("k02_constant_length", f"""WITH RECURSIVE s AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, {count('text')} AS n FROM documents),
 f AS (SELECT doc_id, i, n, 0 AS block, 1 AS segment, CASE WHEN n <= 1024 THEN n + 1 ELSE 0 END::BIGINT AS used FROM s WHERE i = 1 UNION ALL
 SELECT s.doc_id, s.i, s.n, CASE WHEN f.used + s.n + 1 > 1024 THEN f.block + 1 ELSE f.block END, CASE WHEN f.used + s.n + 1 > 1024 THEN 1 ELSE f.segment + 1 END,
 CASE WHEN f.used + s.n + 1 > 1024 THEN 0 ELSE f.used END + CASE WHEN s.n <= 1024 THEN s.n + 1 ELSE 0 END FROM f JOIN s ON s.i = f.i + 1)
 SELECT doc_id, block, segment, n FROM f WHERE n <= 1024""")
def k02(spark, sf):
    rows = fx.documents(spark, sf).select("doc_id", tk.token_count("text").alias("n"), F.lit(True).alias("sep"))
    packed = pack.constant_length(order.ordinal(rows, "doc_id"), "doc_id", "n", "sep", 1024)
    return packed.select("doc_id", "block", "segment", "n")


_SHUFFLED = f"SELECT doc_id, row_number() OVER (ORDER BY md5('42|' || doc_id), doc_id) - 1 AS o, n FROM ln WHERE n BETWEEN 2 AND 2048"


def multipack_sql(capacity: int) -> str:
    rows = f"SELECT 0 AS grp, row_number() OVER (ORDER BY o) AS i, doc_id AS key, n FROM ({_SHUFFLED})"
    return fold(rows, capacity).replace("WITH RECURSIVE ", f"WITH RECURSIVE {DOCS}, {LEN_SQL}, ")


def multipacked(spark, sf, capacity: int, chunk: int = folds.CHUNK_ROWS):
    # ids and lengths are small and read twice (bucket counts, rows), the text is read once
    rows = materialise(fx.document_lengths(spark, sf).filter(F.col("n").between(2, 2048)).select("doc_id", "n"), "lengths")
    return pack.multipack(order.shuffled_ordinal(rows, 42, "doc_id"), "doc_id", "n", capacity, chunk_rows=chunk)


_K03 = multipack_sql(4096) + " SELECT block, key AS doc_id, n, row_number() OVER (PARTITION BY block ORDER BY n DESC, i) - 1 AS place FROM f"


@query("k03_multipack", _K03)
def k03(spark, sf):
    return multipacked(spark, sf, 4096).select("block", "doc_id", "n", "place")


@query("k03_multipack_chunked", _K03)
def k03_chunked(spark, sf):
    """The same bins, folded in chunks of 128 rows."""
    return multipacked(spark, sf, 4096, 128).select("block", "doc_id", "n", "place")


@query("k04_first_fit_decreasing", f"""WITH RECURSIVE {DOCS}, {LEN_SQL}, s AS MATERIALIZED (SELECT row_number() OVER (ORDER BY n DESC, o) AS i, doc_id, n FROM ({_SHUFFLED})),
 f AS (SELECT i, doc_id, n, 0::BIGINT AS bin, [4096 - n] AS room FROM s WHERE i = 1 UNION ALL
 SELECT i, doc_id, n, bin, CASE WHEN bin = len(room) THEN room || [4096 - n] ELSE list_concat(room[:bin], [room[bin + 1] - n], room[bin + 2:]) END FROM (
 SELECT s.*, f.room, coalesce(list_position(list_transform(f.room, lambda x: x >= s.n), true) - 1, len(f.room))::BIGINT AS bin FROM f JOIN s ON s.i = f.i + 1))
 SELECT bin, doc_id, n FROM f""")
def k04(spark, sf):
    rows = materialise(fx.document_lengths(spark, sf).filter(F.col("n").between(2, 2048)).select("doc_id", "n"), "lengths")
    return pack.ffd_pack(order.shuffled_ordinal(rows, 42, "doc_id"), "doc_id", "n", 4096)


_K05 = f"""{multipack_sql(2048)}, pl AS (SELECT block, key AS doc_id, row_number() OVER (PARTITION BY block ORDER BY n DESC, i) AS place FROM f),
 t AS (SELECT doc_id, {ids('instruction || chr(10) || input || chr(10)')} AS p, {ids('output')} || [2] AS o FROM d),
 b AS (SELECT block, count(*) AS members, flatten(list(p || o ORDER BY place)) AS i, flatten(list({rep(-100, 'len(p)')} || o ORDER BY place)) AS l,
 flatten(list(range(len(p || o)) ORDER BY place)) AS pos, flatten(list({rep('place', 'len(p || o)')} ORDER BY place)) AS a FROM pl JOIN t USING (doc_id) GROUP BY block)"""


def packed(spark, sf, numbered=True):
    data = fx.encoded_documents(spark, sf).filter(filters.length_fits(F.size("input_ids")))
    return pack.packed_rows(multipacked(spark, sf, 2048), data, "doc_id", numbered)


@query("k05_packed_rows", _K05 + f" SELECT block, members, len(i) AS n, {dig('i')} AS input_ids, {dig('l')} AS labels, {dig('pos')} AS position_ids, {dig('a')} AS attention_mask FROM b")
def k05(spark, sf):
    return out(packed(spark, sf), "block", "members", columns=("input_ids", "labels", "position_ids", "attention_mask"))


_BATCHED = "bt AS (SELECT *, (row_number() OVER (ORDER BY conv_id) - 1) // 8 AS batch FROM enc), mx AS (SELECT batch, (max(len(i)) + 63) // 64 * 64 AS m FROM bt GROUP BY batch)"


def recorded(spark, sf):
    return fx.encoded_conversations(spark, sf).withColumn("record_id", F.col("conv_id"))


@query("k06_pad_batch", f"""WITH {ENC_SQL}, {_BATCHED} SELECT conv_id, batch, m AS n, {cat(f"i || {rep(0, 'm - len(i)')}")} AS input_ids, {cat(f"l || {rep(-100, 'm - len(l)')}")} AS labels,
 {cat(f"{rep(0, 'm - len(i)')} || i")} AS left_ids FROM bt JOIN mx USING (batch)""")
def k06(spark, sf):
    rows = recorded(spark, sf).select("record_id", "conv_id", "input_ids", "labels", F.col("input_ids").alias("left_ids"))
    pads = {"input_ids": tk.PAD, "labels": tk.IGNORED, "left_ids": tk.PAD}
    both = pack.pad_batches(rows, "record_id", 8, pads, multiple=64, left=("left_ids",), common=[list(pads)])
    return out(both, "conv_id", "batch", columns=("input_ids", "labels", "left_ids"), hashed=False)


@query("k07_pad_pair_batch", f"""WITH {PAIRS}, a AS (SELECT pair_id, (row_number() OVER (ORDER BY pair_id) - 1) // 8 AS batch, {ids('chosen')} AS c, {ids('rejected')} AS r FROM p),
 mx AS (SELECT batch, max(len(c)) AS mc, max(len(r)) AS mr, max(greatest(len(c), len(r))) AS m FROM a GROUP BY batch)
 SELECT pair_id, batch, mc AS n, {cat(f"c || {rep(0, 'mc - len(c)')}")} AS input_ids_j, {cat(f"r || {rep(0, 'mr - len(r)')}")} AS input_ids_k,
 {cat(f"c || {rep(0, 'm - len(c)')}")} AS chosen, {cat(f"r || {rep(0, 'm - len(r)')}")} AS rejected FROM a JOIN mx USING (batch)""")
def k07(spark, sf):
    p = fx.pairs(spark, sf).select("pair_id", tk.token_ids("chosen").alias("input_ids_j"), tk.token_ids("rejected").alias("input_ids_k"))
    b = p.withColumns({"chosen": F.col("input_ids_j"), "rejected": F.col("input_ids_k")})
    pads = {c: tk.PAD for c in ("input_ids_j", "input_ids_k", "chosen", "rejected")}
    rows = pack.pad_batches(b, "pair_id", 8, pads, common=[["input_ids_j"], ["input_ids_k"], ["chosen", "rejected"]])
    return out(rows, "pair_id", "batch", columns=("input_ids_j", "input_ids_k", "chosen", "rejected"), hashed=False)


@query("k08_unpack", f"""{_K05} SELECT block, place - 1 AS "range", len(p || o) AS n, {dig('p || o')} AS input_ids, {dig(rep(-100, 'len(p)') + ' || o')} AS labels
 FROM pl JOIN t USING (doc_id)""")
def k08(spark, sf):
    rows = pack.unpacked(packed(spark, sf).select("block", "input_ids", "labels", "position_ids"), ["input_ids", "labels"])
    return out(rows.drop("position_ids"), "block", "range")


_K09_REQ = ("SELECT request_id, queue, row_number() OVER (ORDER BY request_id) - 1 AS o, 1 + ('0x' || substr(md5(request_id::VARCHAR), 1, 2))::INT * 4 AS n, "
            "1 + ('0x' || substr(md5(request_id::VARCHAR), 3, 2))::INT AS new FROM (SELECT event_id AS request_id, user_id AS queue FROM events)")


def _k09_sql(padded: bool, prefill_budget: int, token_budget: int, block: int = 16, window: int = 600) -> str:
    if padded:
        pre, dec, lon = "(f.cnt + 1) * greatest(f.lon, r.n)", "f.dec + r.new", "greatest(f.lon, r.n)"
        pre1, dec1 = "r.n", "r.new"
    else:
        pre1, dec1 = f"ceil(r.n / {block}.0) * {block}", f"ceil(least(greatest({window} - r.n, 0), r.new) / {block}.0) * {block}"
        pre, dec, lon = f"f.pre + {pre1}", f"f.dec + {dec1}", "greatest(f.lon, r.n)"
    fits = f"({pre} <= {prefill_budget} AND {pre} + {dec} <= {token_budget})"
    return f"""WITH RECURSIVE rq AS ({_K09_REQ}), r AS (SELECT o // 10000 AS chunk, queue, row_number() OVER (PARTITION BY o // 10000, queue ORDER BY o) AS i, request_id, n, new FROM rq),
 f AS (SELECT chunk, queue, i, request_id, 0 AS batch, 1::BIGINT AS cnt, n::BIGINT AS lon, ({pre1})::BIGINT AS pre, ({dec1})::BIGINT AS dec FROM r WHERE i = 1 UNION ALL
 SELECT r.chunk, r.queue, r.i, r.request_id, CASE WHEN {fits} THEN f.batch ELSE f.batch + 1 END, CASE WHEN {fits} THEN f.cnt + 1 ELSE 1 END, CASE WHEN {fits} THEN {lon} ELSE r.n END,
 (CASE WHEN {fits} THEN {pre} ELSE {pre1} END)::BIGINT, (CASE WHEN {fits} THEN {dec} ELSE {dec1} END)::BIGINT FROM f JOIN r ON r.chunk = f.chunk AND r.queue = f.queue AND r.i = f.i + 1)
 SELECT chunk, queue, batch, request_id, count(*) OVER w AS size, max(pre + dec) OVER w AS max_tokens, (count(*) OVER w < 2)::INT AS held,
 (max(pre) OVER w > {prefill_budget} OR max(pre + dec) OVER w > {token_budget})::INT AS over_budget FROM f WINDOW w AS (PARTITION BY chunk, queue, batch)"""


def budget_requests(spark, sf):
    h = F.md5(F.col("request_id").cast("string"))
    r = table(spark, sf, "events").select(F.col("event_id").alias("request_id"), F.col("user_id").alias("queue"), "ts")
    return r.withColumns({"input_length": 1 + F.conv(F.substring(h, 1, 2), 16, 10).cast("int") * 4,
                          "max_new_tokens": 1 + F.conv(F.substring(h, 3, 2), 16, 10).cast("int")})


K09_COLUMNS = ("chunk", "queue", "batch", "request_id", "size", "max_tokens", "held", "over_budget")


@query("k09_budget_batches", _k09_sql(True, 4096, 6000))
def k09(spark, sf):
    rows = order.ordinal(budget_requests(spark, sf), "request_id")
    return pack.budget_batches(rows, "request_id", "input_length", "max_new_tokens", 4096, 6000, ("queue",), 2).select(*K09_COLUMNS)


@query("k09_budget_batches_blocks", _k09_sql(False, 4096, 6000))
def k09_blocks(spark, sf):
    rows = order.ordinal(budget_requests(spark, sf), "request_id")
    return pack.budget_batches(rows, "request_id", "input_length", "max_new_tokens", 4096, 6000, ("queue",), 2, padded=False,
                               block_size=16, window=600).select(*K09_COLUMNS)


@query("k10_fixed_batches", "SELECT o_orderkey, (row_number() OVER (ORDER BY o_orderkey) - 1) // 100 AS batch FROM orders")
def k10(spark, sf):
    return split.batches(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 100).select("o_orderkey", "batch")


@query("k11_character_buffers", f"""WITH RECURSIVE ra AS MATERIALIZED (SELECT sum(length(text))::DOUBLE / sum({count('text')}) * 4096 AS budget FROM documents),
 s AS MATERIALIZED (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS i, length(text) AS c, {count('text')} AS t FROM documents),
 f AS (SELECT doc_id, i, c, t, 0 AS block, c::BIGINT AS used FROM s WHERE i = 1 UNION ALL
 SELECT s.doc_id, s.i, s.c, s.t, CASE WHEN f.used < budget THEN f.block ELSE f.block + 1 END, CASE WHEN f.used < budget THEN f.used + s.c ELSE s.c END FROM f JOIN s ON s.i = f.i + 1, ra)
 SELECT block, count(*) AS texts, sum(c)::BIGINT AS characters, (sum(t + 1) // 1024)::BIGINT AS sequences FROM f GROUP BY block""")
def k11(spark, sf):
    d = fx.documents(spark, sf)
    ratio = ev.characters_per_token(d, "text")
    rows = d.select("doc_id", F.length("text").alias("c"), tk.token_count("text").alias("t"))
    numbered = order.ordinal(rows, "doc_id").withColumn("budget", ratio.scalar() * 4096)
    buffers = pack.character_buffers(numbered, "doc_id", "c", "budget", carry=("t",))
    return buffers.groupBy("block").agg(F.count(F.lit(1)).alias("texts"), F.sum("c").alias("characters"),
                                        F.floor(F.sum(F.col("t") + 1) / 1024).alias("sequences"))
