"""Incremental maintenance: change classification, pending files, debounced bursts, usage streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def classify(old: DataFrame, new: DataFrame) -> DataFrame:
    """(path, change): added, removed, modified, or touched where size or time differ and the content doesn't.

    Equal size and whole-second time count as unchanged without a look at the content.
    """
    a = old.select("path", F.col("content_hash").alias("h0"), F.col("size").alias("s0"), F.floor("modified_at").alias("m0"))
    b = new.select("path", F.col("content_hash").alias("h1"), F.col("size").alias("s1"), F.floor("modified_at").alias("m1"))
    both = a.join(b, "path", "full_outer")
    same = (F.col("s0") == F.col("s1")) & (F.col("m0") == F.col("m1"))
    change = F.when(F.col("h0").isNull(), "added").when(F.col("h1").isNull(), "removed").when(same, "unchanged").when(F.col("h0") != F.col("h1"), "modified").otherwise("touched")
    return both.select("path", change.alias("change"))


def bursts(events: DataFrame, gap: str = "2 seconds", key: str = "path", late: str = "10 minutes") -> DataFrame:
    """(key, start, end, n): events of a key that follow each other within the gap, in a batch or a stream."""
    own = events.withWatermark("ts", late) if events.isStreaming else events
    return own.groupBy(F.session_window("ts", gap).alias("w"), F.col(key)).agg(F.count(F.lit(1)).alias("n")).select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def pending_files(events: DataFrame) -> DataFrame:
    """(path, first_seen, last_seen, n)."""
    return events.groupBy("path").agg(F.min("ts").alias("first_seen"), F.max("ts").alias("last_seen"), F.count(F.lit(1)).alias("n"))


def usage_stream(lines: DataFrame, column: str = "value") -> DataFrame:
    """(input_tokens, output_tokens, total_tokens) of the JSON lines that report usage; others are skipped."""
    j = lambda *p: F.coalesce(*[F.get_json_object(column, x).try_cast("bigint") for x in p])
    own = lines.select(j("$.usage.input_tokens", "$.payload.info.total_token_usage.input_tokens").alias("input_tokens"), j("$.usage.output_tokens", "$.payload.info.total_token_usage.output_tokens").alias("output_tokens"), j("$.usage.total_tokens", "$.payload.info.total_token_usage.total_tokens").alias("total_tokens"))
    total = F.coalesce("total_tokens", F.col("input_tokens") + F.col("output_tokens"))
    return own.withColumn("total_tokens", total).where(F.col("total_tokens").isNotNull())


def refresh(stream: DataFrame, apply, checkpoint: str):
    """Runs ``apply(batch)`` on each micro-batch of changed files."""
    return stream.writeStream.foreachBatch(lambda batch, _: apply(batch)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
