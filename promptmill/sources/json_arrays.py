"""Records of JSON arrays, however large one file is, read by as many tasks as the file has splits.

Spark's text source cuts a file into splits at any separator, so an array is read as pieces that end at "}", quoted or not.
What a piece does depends on where it starts: inside a string or not, and at which depth.  Both are carried along the file like running
sums: a piece turns the quote state by its unescaped quotes and moves the depth by one amount if it starts outside a
string and by another if inside.  A split is one row with these sums for either state, those rows are chained per
file (a row per 64 MB or so), and then every piece knows its state.  A record ends where a brace outside of strings comes back to
depth 1, and pieces up to there are put together; no task holds more than a split's pieces or one record's.

Defined results: records are objects; other elements, text behind the array and arrays that break off are errors; white space
between tokens is kept as spaces; an empty array has no records.  Strings may not hold raw line ends, as JSON says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from promptmill.session import scratch_path

# a backslash and what it escapes, a whole string, an open string at the end, a string that goes on from the piece before
_ESCAPED, _STRING, _OPEN, _GOING = r"\\.", r'"[^"]*"', r'"[^"]*$', r'^[^"]*"'


def pieces(spark: SparkSession, path) -> DataFrame:
    """file, block (where its split starts), at (order inside) and text of each piece, without the brace that ends it."""
    return spark.read.option("lineSep", "}").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"), F.col("value").alias("text"), F.col("_metadata.file_size").alias("size"))


def array_files(spark: SparkSession, path) -> tuple[list[str], list[str]]:
    """Files whose first character is "[", and the other ones that are not empty."""
    first = pieces(spark, path).filter((F.col("block") == 0) & F.col("text").rlike(r"\S")).groupBy("file").agg(
        F.min_by(F.left(F.ltrim(F.regexp_replace(F.left("text", F.lit(1000)), r"\s+", " ")), F.lit(1)), "at").alias("sign")).collect()
    return [r.file for r in first if r.sign == "["], [r.file for r in first if r.sign != "["]


def _count(text: Column, sign: str) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(sign), F.lit("")))


def _moves(bare: Column) -> Column:
    """How text outside of strings moves the depth."""
    outside = F.regexp_replace(F.regexp_replace(bare, _STRING, ""), _OPEN, "")
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "]")


def record_texts(spark: SparkSession, path) -> DataFrame:
    """file, number (of the record in its file) and record, as text without line ends."""
    bare = pieces(spark, path).withColumn("bare", F.regexp_replace("text", _ESCAPED, ""))
    turns = _count(F.col("bare"), '"') % 2
    inside = F.when(F.instr("bare", '"') > 0, _moves(F.regexp_replace("bare", _GOING, ""))).otherwise(0)
    # the brace behind a piece closes if the piece ends outside of strings
    moved = bare.withColumns({"turns": turns, "d0": _moves(F.col("bare")) - F.when(turns == 0, 1).otherwise(0),
                              "d1": inside - F.when(turns == 1, 1).otherwise(0)}).drop("bare")
    split = Window.partitionBy("file", "block")
    upto = split.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    state = (F.sum("turns").over(upto) - F.col("turns")) % 2
    # depth sums inside the split if it starts outside (e0) or inside (e1) of a string
    moved = moved.withColumn("state", state).withColumns({
        "e0": F.sum(F.when(F.col("state") == 0, F.col("d0")).otherwise(F.col("d1"))).over(upto),
        "e1": F.sum(F.when(F.col("state") == 0, F.col("d1")).otherwise(F.col("d0"))).over(upto)})

    splits = moved.groupBy("file", "block").agg(F.sum("turns").alias("turns"), F.max_by("e0", "at").alias("e0"), F.max_by("e1", "at").alias("e1"),
                                                F.sum(F.octet_length("text") + 1).alias("bytes"), F.max("size").alias("size"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("start", F.coalesce(F.sum("turns").over(before), F.lit(0)) % 2)
    splits = splits.withColumn("moved", F.when(F.col("start") == 0, F.col("e0")).otherwise(F.col("e1")))
    # a brace behind the last piece of all is no end of an array
    entry = splits.select("file", "block", "start", (F.sum("bytes").over(Window.partitionBy("file")) == F.col("size")).alias("bad"), F.coalesce(F.sum("moved").over(before), F.lit(0)).alias("depth"))

    known = moved.join(entry, ["file", "block"]).select(
        "file", "block", "at", "text", "bad", (F.col("depth") + F.when(F.col("start") == 0, F.col("e0")).otherwise(F.col("e1"))).alias("depth"),
        ((F.col("start") + F.col("state") + F.col("turns")) % 2 == 0).alias("closes"))
    ends = F.when(F.col("closes") & (F.col("depth") == 1), 1).otherwise(0)
    known = known.withColumn("ends", ends).withColumn("_n", F.sum("ends").over(upto) - F.col("ends"))
    counted = known.groupBy("file", "block").agg(F.sum("ends").alias("ends"))
    base = counted.select("file", "block", F.coalesce(F.sum("ends").over(before), F.lit(0)).alias("_base"))
    numbered = known.join(base, ["file", "block"]).withColumn("number", F.col("_n") + F.col("_base"))
    whole = numbered.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("block", "at", "text"))).alias("p"), F.max("ends").alias("ended"), F.max("bad").alias("bad"))
    text = F.translate(F.array_join(F.transform("p", lambda x: x["text"]), "}"), "\n\r", "  ")
    shape = whole.select("file", "number", "ended", "bad", F.when(F.col("ended") == 1, F.concat(text, F.lit("}"))).otherwise(text).alias("t"))
    # a record stands behind the opening bracket or a comma; what is left behind the last one is the closing bracket
    lead = F.when(F.col("number") == 0, r"^\s*\[\s*\{").otherwise(r"^\s*,\s*\{")
    rest = F.when(F.col("number") == 0, r"^\s*\[\s*\]\s*$").otherwise(r"^\s*\]\s*$")
    wrong = F.raise_error(F.concat(F.lit("no array of objects: "), "file", F.lit(" at record "), F.col("number").cast("string")))
    good = F.when(F.col("ended") == 1, F.regexp_like("t", lead)).otherwise(F.regexp_like("t", rest))
    record = F.when(F.col("bad") | ~good, wrong).when(F.col("ended") == 1, F.expr("substr(t, instr(t, '{'))"))
    return shape.select("file", "number", record.alias("record")).filter("record is not null")


def read_arrays(spark: SparkSession, path, schema) -> DataFrame:
    """The records as rows of ``schema``."""
    return record_texts(spark, path).select(F.from_json("record", schema, {"mode": "FAILFAST"}).alias("j")).select("j.*")


def as_lines(spark: SparkSession, path) -> str:
    """A folder with the records as lines, for Spark to infer their schema."""
    lines = scratch_path(spark, "json-lines")
    record_texts(spark, path).select("record").write.text(lines)
    return lines
