"""Readers and writers: strict, permissive and lenient JSON lines, source lines and snippets, deterministic output."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop)


def jsonl(spark: SparkSession, path: str, schema: T.StructType, mode: str = "strict") -> DataFrame:
    """``strict`` fails on a bad line, ``lenient`` drops it, ``permissive`` keeps it in ``_corrupt_record``; no file is an empty table."""
    if not exists(spark, path):
        return spark.createDataFrame([], schema)
    if mode == "permissive":
        schema = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    spark_mode = {"strict": "FAILFAST", "lenient": "DROPMALFORMED", "permissive": "PERMISSIVE"}[mode]
    return spark.read.schema(schema).option("mode", spark_mode).json(path)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value) of text files, lines counting from 1 in each file.

    A task numbers the rows of its blocks and the blocks' counts add up by their offsets, so a large file stays split."""
    own = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("at"))
    blocks = own.groupBy("file", "block").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row for each block
    bases = blocks.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    return own.join(F.broadcast(bases), ["file", "block"]).select("file", (F.col("base") + F.col("at") - F.col("first") + 1).alias("line"), "value")


def json_rows(spark: SparkSession, path: str, schema: T.StructType, mode: str = "strict") -> tuple[DataFrame, DataFrame]:
    """(rows, findings) of JSON lines: rows have ``_file`` and ``_line``. Blank lines are left out; a line that is no JSON object
    fails the read if ``strict``, is a finding if ``permissive`` and goes silently if ``lenient``. No file is an empty table."""
    empty = spark.createDataFrame([], "severity string, file string, line bigint, message string")
    full = T.StructType([*schema.fields, T.StructField("_file", T.StringType()), T.StructField("_line", T.LongType())])
    if not exists(spark, path):
        return spark.createDataFrame([], full), empty
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    good = F.json_object_keys("value").isNotNull()
    if mode == "strict":
        value = F.when(good, F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no JSON object at line "), F.col("line").cast("string"))))
        kept = lines.withColumn("value", value)
    else:
        kept = lines.where(good)
    rows = kept.select(F.from_json("value", schema).alias("r"), F.col("file").alias("_file"), F.col("line").alias("_line")).select("r.*", "_file", "_line")
    bad = lines.where(~good).select(F.lit("FAIL").alias("severity"), "file", "line", F.lit("line is no JSON object").alias("message"))
    return rows, bad if mode == "permissive" else empty


def corrupt_findings(rows: DataFrame) -> DataFrame:
    return rows.where(F.col("_corrupt_record").isNotNull()).select(F.lit("FAIL").alias("severity"), F.lit("json").alias("rule"), F.substring("_corrupt_record", 1, 80).alias("key"), F.lit("line is no JSON object").alias("message"))


def write_jsonl(df: DataFrame, path: str, order: list[str]) -> None:
    """Sorted keys and a total order: equal tables give equal bytes."""
    df.orderBy(*order).select(F.to_json(F.struct(*sorted(df.columns))).alias("value")).write.mode("overwrite").text(path)


def line_table(sources: DataFrame) -> DataFrame:
    """(source_id, line, text), lines counting from 1."""
    return sources.select("source_id", F.posexplode(F.split("text", "\n")).alias("at", "line_text")).select("source_id", (F.col("at") + 1).alias("line"), F.col("line_text").alias("text"))


def snippets(sources: DataFrame, wanted: DataFrame, compact: bool = False, width: int = 180, context: int = 0, numbered: bool = False) -> DataFrame:
    """(key, snippet) for (key, source_id, start, end): the lines and ``context`` more on both sides, as they are or with their
    numbers; or ``compact`` in one line of ``width`` at most."""
    first = F.greatest(F.col("start") - context, F.lit(1))
    own = F.slice(F.split("text", "\n"), first, F.greatest(F.col("end") + context - first + 1, F.lit(0)))
    both = wanted.join(sources.select("source_id", "text"), "source_id").select("key", own.alias("own"), first.alias("first"))
    if not compact:
        shown = F.transform("own", lambda x, i: F.concat((F.col("first") + i).cast("string"), F.lit(": "), x)) if numbered else F.col("own")
        return both.select("key", F.array_join(shown, "\n").alias("snippet"))
    clean = F.filter(F.transform("own", lambda x: F.trim(F.regexp_replace(x, r"\s+", " "))), lambda x: x != "")
    joined = F.array_join(clean, " / ")
    short = F.when(F.length(joined) > width, F.concat(F.rtrim(F.substring(joined, 1, width - 3)), F.lit("..."))).otherwise(joined)
    return both.select("key", F.when(joined == "", "(blank lines)").otherwise(short).alias("snippet"))


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of ``new`` and the rows of ``old`` without a successor."""
    return old.join(new.select(key), key, "left_anti").unionByName(new)


def checked_edges(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges both of whose ends exist."""
    ids = nodes.select("id")
    return edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")


def append_done(done: DataFrame, new: DataFrame, path: str, key: str = "case_id") -> int:
    """Append the rows of ``new`` whose key is not done yet to a Parquet folder; their number."""
    fresh = pending(new, done, key).dropDuplicates([key])
    n = fresh.count()
    if n:
        fresh.write.mode("append").parquet(path)
    return n


def pending(wanted: DataFrame, done: DataFrame, key: str = "case_id") -> DataFrame:
    """What a resumed run has still to do."""
    return wanted.join(done.select(key), key, "left_anti")
