"""The operators of this package bound to the test tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import byte_bpe, line_dedup, media_boxes, parity_join, perspectives, secret_markov, source_mix, token_files, toxicity, treap_search, url_intervals, vector_codes, wu_manber


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    model = toxicity.train(docs, labels.where(toxicity.third() != 1))
    scored = toxicity.score(docs, model)
    return scored.select(
        "doc_id",
        F.coalesce(toxicity.third() == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))


def op3_parity_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parity_join.join(_table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.summary(line_dedup.dedup(_table(spark, sf_dir, "documents")))


def op5_secret_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = secret_markov.train(secret_markov.default_samples(spark))
    return secret_markov.report(secret_markov.spans(_table(spark, sf_dir, "documents"), model))


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, parts = token_files.write(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1, vocabulary=49_408, added=True)
    return token_files.read(spark, path, parts)


def op7_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return perspectives.segments(_table(spark, sf_dir, "conversations"))


def url_list(hosts: DataFrame) -> DataFrame:
    """Dated entries over the distinct ``host`` values, laid out by their lengths and first letters."""
    day = lambda n: F.date_add(F.lit("2024-01-01").cast("date"), n.cast("int"))
    own = hosts.where("host <> ''").distinct().withColumn("d", (F.length("host") * 37 + F.ascii("host") * 13) % 240).withColumn("k", F.length("host") % 3)
    entry = lambda pattern, action, n: F.struct(pattern.alias("pattern"), F.lit(action).alias("action"), day(n).alias("at"))
    d, host, english = F.col("d"), F.col("host"), F.concat("host", F.lit("/en/"))
    made = (
        F.when(F.col("k") == 0, F.array(entry(host, "add", d), entry(host, "remove", d + 60), entry(host, "add", d + 120)))
        .when(F.col("k") == 1, F.array(entry(english, "add", d), entry(english, "remove", d + 30)))
        .otherwise(F.array(entry(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), "add", F.lit(300))))
    )
    return own.select(F.explode(made).alias("e")).select("e.*").where("pattern <> ''")


def op8_url_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages").select("page_id", "url")
    captures = pages.withColumn("fetched", F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 365).cast("int")))
    entries = url_list(pages.select(url_intervals.host_of(F.coalesce("url", F.lit(""))).alias("host")))
    found = url_intervals.matches(captures, entries)
    return found.withColumns({"fetched": F.col("fetched").cast("string"), "since": F.col("since").cast("string")})


def op9_media_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media_boxes.columns(_table(spark, sf_dir, "documents"))


def op10_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.codes(_table(spark, sf_dir, "embeddings"))


def op12_treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mix.mix(_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"op1_toxicity": op1_toxicity, "op2_byte_bpe": op2_byte_bpe, "op3_parity_join": op3_parity_join, "op4_line_dedup": op4_line_dedup, "op5_secret_markov": op5_secret_markov, "op6_token_files": op6_token_files, "op7_perspectives": op7_perspectives, "op8_url_intervals": op8_url_intervals, "op9_media_boxes": op9_media_boxes, "op10_wu_manber": op10_wu_manber, "op11_vector_codes": op11_vector_codes, "op12_treap_search": op12_treap_search, "op13_source_mix": op13_source_mix}


def oracle_sql() -> dict[str, str]:
    return {"op7_perspectives": perspectives.SQL, "op8_url_intervals": url_intervals.SQL, "op11_vector_codes": vector_codes.SQL, "op12_treap_search": treap_search.SQL, "op13_source_mix": source_mix.SQL}
