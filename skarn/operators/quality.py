"""Data-quality rules: each yields findings (severity, rule, key, message); findings are united and counted."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S


def rule(df: DataFrame, name: str, severity: str, key: str, broken: Column, message: str) -> DataFrame:
    return df.where(F.coalesce(broken, F.lit(False))).select(F.lit(severity).alias("severity"), F.lit(name).alias("rule"), F.col(key).cast("string").alias("key"), F.lit(message).alias("message"))


def missing_parent(child: DataFrame, key: str, column: str, parent: DataFrame, parent_key: str, name: str) -> DataFrame:
    """Rows whose reference has no row in the parent table."""
    p = parent.select(F.col(parent_key).alias("__p")).distinct()
    gone = child.where(F.col(column).isNotNull()).join(p, F.col(column) == F.col("__p"), "left_anti")
    return rule(gone, name, "FAIL", key, F.lit(True), f"{column} is unknown")


def repeated(df: DataFrame, key: str, order: list, name: str) -> DataFrame:
    """Every later occurrence of a key."""
    nth = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return rule(df.withColumn("__nth", nth).where("__nth > 1"), name, "FAIL", key, F.lit(True), f"{key} is repeated")


def all_of(*findings: DataFrame) -> DataFrame:
    out = findings[0]
    for f in findings[1:]:
        out = out.unionByName(f)
    return out


def severity_verdict(findings: DataFrame) -> DataFrame:
    """One row: counts by severity and the verdict."""
    out = findings.agg(F.count_if(F.col("severity") == "FAIL").alias("fails"), F.count_if(F.col("severity") == "WARN").alias("warns"))
    return out.withColumn("verdict", F.when(F.col("fails") > 0, "FAIL").when(F.col("warns") > 0, "WARN").otherwise("PASS"))


def source_rules(sources: DataFrame, languages: list[str]) -> DataFrame:
    return all_of(
        rule(sources, "line_count", "FAIL", "source_id", F.col("line_count") < 1, "line_count must be positive"),
        rule(sources, "language", "WARN", "source_id", ~F.col("language").isin(*languages), "language is unknown"),
        rule(sources, "digest", "FAIL", "source_id", ~F.col("sha256").rlike("^[0-9a-f]{64}$"), "sha256 is malformed"),
        rule(sources, "size", "WARN", "source_id", F.col("size_bytes") > 20_000, "source is very long"),
    )


def reuse(evidence: DataFrame, most: int = 3) -> DataFrame:
    """(path, lines, n, first_case): places cited by more rows than ``most``, with the first."""
    return evidence.groupBy("path", "lines").agg(F.count(F.lit(1)).alias("n"), F.min("case_id").alias("first_case")).where(F.col("n") > most)


def surface_diversity(queries: DataFrame, least_rows: int = 50, floor: float = 0.15) -> DataFrame:
    """One row: distinct surfaces, rows, ratio and whether it falls below the floor."""
    out = queries.select(S.query_surface(F.col("query")).alias("s")).agg(F.count_distinct("s").alias("surfaces"), F.count(F.lit(1)).alias("rows"))
    ratio = F.col("surfaces") / F.greatest(F.col("rows"), F.lit(1))
    return out.withColumns({"ratio": ratio, "poor": (F.col("rows") >= least_rows) & (ratio < floor)})


def answer_rules(answers: DataFrame, least: int = 40) -> DataFrame:
    """Findings on answers (key, text): too short, yes/no openings, refusal cues, no citation."""
    low = F.lower("text")
    return all_of(
        rule(answers, "short", "WARN", "key", F.length(F.trim("text")) < least, "answer is short"),
        rule(answers, "yes_no", "WARN", "key", low.rlike("^(yes|no)([^a-z]|$)"), "answer opens with yes or no"),
        rule(answers, "refusal", "WARN", "key", low.contains("cannot be determined") | low.contains("not enough evidence") | low.contains("insufficient evidence"), "answer refuses"),
        rule(answers, "citation", "FAIL", "key", F.size(S.citations(F.col("text"))) == 0, "answer cites nothing"),
    )


def bundle_diff(old: DataFrame, new: DataFrame, by: str) -> DataFrame:
    """(value, n_old, n_new, change), 0 where a side lacks the value."""
    a, b = (x.groupBy(F.coalesce(by, F.lit("unknown")).alias("value")).agg(F.count(F.lit(1)).alias(n)) for x, n in ((old, "n_old"), (new, "n_new")))
    return a.join(b, "value", "full_outer").na.fill(0, ["n_old", "n_new"]).withColumn("change", F.col("n_new") - F.col("n_old"))
