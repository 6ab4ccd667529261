"""Sources, sinks, the prepared-table cache and schema discovery."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from promptmill.functions.text import remove_input
from promptmill.operators.dedup import union_all
from promptmill.sources import json_arrays
from promptmill.sources.arrow_files import ArrowFiles

# Substrings of a path that name its format, in order; json is the default.
PATH_FORMATS = ((".parquet", "parquet"), (".arrow", "arrow"), (".csv", "csv"), (".txt", "text"))
CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def detect_format(path: str, ds_type: str | None = None) -> str:
    if ds_type:
        return ds_type
    return next((f for mark, f in PATH_FORMATS if mark in path), "json")


def _reader(spark: SparkSession, schema: StructType | str | None):
    return spark.read.schema(schema) if schema is not None else spark.read


def json_layout(spark: SparkSession, path) -> tuple[list[str], list[str]]:
    """Files that hold one object per line, and files that are one JSON document.

    Every filled line of every file is looked at: it is an object of its own if it opens and closes with a brace.
    """
    line = F.trim("value")
    whole = ~(F.startswith(line, F.lit("{")) & F.endswith(line, F.lit("}")))
    seen = (spark.read.text(path).select(F.input_file_name().alias("file"), line.alias("value"), whole.alias("whole"))
            .filter(F.length("value") > 0).groupBy("file").agg(F.max("whole").alias("whole")).collect())
    return [r.file for r in seen if not r.whole], [r.file for r in seen if r.whole]


def read_json(spark: SparkSession, path, schema=None, lines: bool | None = None) -> DataFrame:
    """JSON lines, arrays of objects (both read in splits) or one JSON document per file; a record that is neither is an error.

    ``lines`` says whether lines or documents; else names in .jsonl and .ndjson do, and the files themselves for all others.
    """
    def read(files, multi: bool) -> DataFrame:
        return _reader(spark, schema).option("multiLine", str(multi).lower()).option("mode", "FAILFAST").json(files)

    names = path if isinstance(path, list) else [path]
    if lines is None and all(n.endswith((".jsonl", ".ndjson")) for n in names):
        lines = True
    if lines is not None:
        return read(path, not lines)
    arrays, others = json_arrays.array_files(spark, path)
    of_lines, documents = json_layout(spark, others) if others else ([], [])
    parts = [json_arrays.read_arrays(spark, arrays, schema)] if arrays and schema is not None else []
    if arrays and schema is None:
        of_lines = [*of_lines, json_arrays.as_lines(spark, arrays)]
    parts += [read(files, multi) for files, multi in ((of_lines, False), (documents, True)) if files]
    return union_all(parts) if parts else read(path, False)


def read_jsonl(spark: SparkSession, path, schema) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_format(spark: SparkSession, path, fmt: str, schema=None) -> DataFrame:
    if fmt == "json":
        return read_json(spark, path, schema)
    if fmt == "arrow":
        spark.dataSource.register(ArrowFiles)
        return union_all([_reader(spark, schema).format("arrow_files").load(p)
                          for p in (path if isinstance(path, list) else [path])])
    if fmt in ("csv", "tsv"):
        sep = "\t" if fmt == "tsv" else ","
        return _reader(spark, schema).options(**CSV_OPTIONS).option("sep", sep).csv(path)
    if fmt == "text":
        return spark.read.text(path).withColumnRenamed("value", "text")
    return _reader(spark, schema).format(fmt).load(path)


def write_arrow(df: DataFrame, path: str, mode: str = "append") -> None:
    """Arrow files in a folder that all machines mount, one for each task with rows."""
    df.sparkSession.dataSource.register(ArrowFiles)
    df.write.format("arrow_files").mode(mode).save(path)


def read_files(spark: SparkSession, path: str, ds_type: str | None = None, data_files=None, schema=None) -> DataFrame:
    """A file or folder in a detected format; ``data_files`` names files below or instead of the path.

    Paths go straight to Spark, so any file system it knows will do.  A folder
    without ``data_files`` and without a format is a saved table: parquet.
    """
    if data_files:
        files = [data_files] if isinstance(data_files, str) else list(data_files)
        files = [f if "/" in f else f"{path.rstrip('/')}/{f}" for f in files]
        return read_format(spark, files, detect_format(files[0], ds_type), schema)
    last = path.rstrip("/").rsplit("/", 1)[-1]
    if ds_type is None and "." not in last:
        return _reader(spark, schema).parquet(path)
    return read_format(spark, path, detect_format(path, ds_type), schema)


# Suffixes the local loader takes.
SUFFIXES = {".jsonl": "json", ".json": "json", ".csv": "csv", ".tsv": "tsv"}


def load_by_suffix(spark: SparkSession, path: str, schema=None) -> DataFrame:
    for suffix, fmt in SUFFIXES.items():
        if path.endswith(suffix):
            return read_format(spark, path, fmt, schema)
    raise ValueError(f"unsupported dataset format: {path}")


def select_split(df: DataFrame, phase: str, configured: str | None = None, known: tuple[str, ...] = ()) -> DataFrame:
    """The configured split, else the phase's; the choice is made before any job runs.

    ``known`` lists the splits of the source, as its partition folders do.
    """
    if "split" not in df.columns:
        return df
    wanted = configured or phase
    if known and wanted not in known:
        raise ValueError(f"no split {wanted!r} in {sorted(known)}; set one of them")
    return df.filter(F.col("split") == wanted).drop("split")


def folder_name(config: Column) -> Column:
    """A name for a partition folder, which cannot be empty: the empty name is _, and names of underscores alone get one more."""
    return F.when(config.rlike("^_*$"), F.concat(config, F.lit("_"))).otherwise(config)


def config_of(folder: Column) -> Column:
    """The name that ``folder_name`` was given."""
    return F.when(folder.rlike("^_+$"), F.regexp_replace(folder, "^_", "")).otherwise(folder)


def read_configs(spark: SparkSession, root: str, schema: StructType | str, names: list[str] | None = None, fmt: str = "parquet") -> DataFrame:
    """All named configurations of a source in one scan: folders ``config=<name>`` below ``root``; ``names`` picks some before files are read.

    ``schema`` has the column ``config``, a string, so that a name like 01 stays as it is.
    """
    found = read_format(spark, root, fmt, schema)
    return found if names is None else found.filter(F.col("config").isin(*names))


def read_named(names: list[str | None], read: Callable[[str | None], DataFrame]) -> DataFrame:
    """One scan per named configuration of a source, joined by column name; None is a configuration of its own."""
    return union_all([read(n).withColumn("config", F.lit(n).cast("string")) for n in names])


TEST_CASES = "data array<struct<test_cases:array<struct<input:string,output:string>>>>"


def read_test_cases(spark: SparkSession, folder: str, id_pattern: str = r"([^/]+)\.json$") -> DataFrame:
    """(problem_id, case_no, input, expected) of one JSON file per problem, in one scan.

    ``id_pattern`` takes the problem id out of a file's path.
    """
    files = spark.read.schema(TEST_CASES).options(
        multiLine="true", recursiveFileLookup="true", pathGlobFilter="*.json").json(folder)
    named = files.withColumn("problem_id", F.regexp_extract(F.input_file_name(), id_pattern, 1))
    return named.select("problem_id", F.posexplode(F.col("data")[0]["test_cases"]).alias("case_no", "c")).select(
        F.url_decode("problem_id").alias("problem_id"), "case_no", "c.input", F.col("c.output").alias("expected"))


# Prepared tables ------------------------------------------------------------------------


def cache_key(config: dict) -> str:
    """md5 over every parameter that changes rows; the order of sources does not matter."""
    fixed = {**config, "datasets": sorted(json.dumps(d, sort_keys=True) for d in config.get("datasets", []))}
    return hashlib.md5(json.dumps(fixed, sort_keys=True, default=str).encode()).hexdigest()


def prepared(spark: SparkSession, root: str, config: dict, build: Callable[[], DataFrame]) -> DataFrame:
    """The table for ``config``: read if a finished one is there, else built and saved.

    The marker table is written last, so a half-written table is never read.
    """
    base = f"{root.rstrip('/')}/{cache_key(config)}"
    try:
        schema = spark.read.parquet(f"{base}/finished").first()
    except AnalysisException:
        schema = None
    if schema is None:
        df = build()
        df.write.mode("overwrite").parquet(f"{base}/data")
        spark.createDataFrame([(df.schema.json(),)], "schema string").write.mode("overwrite").parquet(f"{base}/finished")
        return spark.read.schema(df.schema).parquet(f"{base}/data")
    return spark.read.schema(StructType.fromJson(json.loads(schema[0]))).parquet(f"{base}/data")


# Sinks ----------------------------------------------------------------------------------


def json_array_to_lines(spark: SparkSession, source: str, target: str, schema=None) -> None:
    """Each record of the arrays as a line; with ``schema`` its fields alone, in that order."""
    if schema is not None:
        json_arrays.read_arrays(spark, source, schema).write.json(target)
    else:
        json_arrays.record_texts(spark, source).select("record").write.text(target)


def prediction_rows(df: DataFrame, decoded: str = "decoded", given: str = "input") -> DataFrame:
    """``prediction_with_input`` and ``prediction``, the input's text taken out."""
    return df.withColumn("prediction_with_input", F.trim(decoded)).withColumn(
        "prediction", remove_input(decoded, given)).drop(decoded)


def write_predictions(df: DataFrame, path: str, run: str = "run_name") -> None:
    df.write.partitionBy(run).json(path)


def metric_summary(metrics: DataFrame) -> DataFrame:
    """metric / training / validation from (name, value) rows with train_ and eval_ prefixes."""
    named = metrics.select(
        F.regexp_replace("name", "^(train|eval)_", "").alias("metric"),
        F.regexp_extract("name", "^(train|eval)_", 1).alias("side"), F.col("value").cast("string").alias("value"))
    wide = named.groupBy("metric").pivot("side", ["train", "eval"]).agg(F.first("value"))
    return wide.select("metric", F.coalesce("train", F.lit("")).alias("training"),
                       F.coalesce("eval", F.lit("")).alias("validation"))


def write_metric_summary(metrics: DataFrame, path: str) -> None:
    """One CSV; the table has a row per metric name."""
    metric_summary(metrics).orderBy("metric").coalesce(1).write.option("header", "true").option(
        "emptyValue", "").csv(path)


def text_stream(spark: SparkSession, folder: str, schema, name_filter: str = "*", files_per_trigger: int | None = 16) -> DataFrame:
    """Parquet files of a folder, or folders of such files in it, as a stream; without ``files_per_trigger`` all there are make one micro-batch.

    The filter is part of the path: as ``pathGlobFilter`` it would have to fit the names of the files inside a folder as well.
    """
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(f"{folder.rstrip('/')}/{name_filter}")


# Names looked for, in order; the first hit wins.
CONVERSATION_FIELDS = ("conversation", "conversations", "messages")
ROLE_FIELDS = ("from", "role")
CONTENT_FIELDS = ("content", "text", "value")


def discover_chat_schema(schema: StructType) -> dict[str, str]:
    """Names of the conversation, role and content fields, read from the schema alone."""

    def first(wanted: tuple[str, ...], given: list[str], what: str) -> str:
        for name in wanted:
            if name in given:
                return name
        raise ValueError(f"no {what} field found in {given}")

    top = first(CONVERSATION_FIELDS, schema.fieldNames(), "conversation")
    kind = schema[top].dataType
    if not (isinstance(kind, ArrayType) and isinstance(kind.elementType, StructType)):
        raise ValueError(f"{top} is not an array of structs")
    inner = kind.elementType.fieldNames()
    return {"field_messages": top, "message_field_role": first(ROLE_FIELDS, inner, "role"),
            "message_field_content": first(CONTENT_FIELDS, inner, "content")}


def format_sample(df: DataFrame, key: str) -> DataFrame:
    """The first formatted pair in key order."""
    return df.orderBy(key).limit(1).select("input", "output")


def write_format_sample(df: DataFrame, key: str, path: str) -> None:
    format_sample(df, key).write.json(path)
