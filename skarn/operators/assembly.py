"""Export and assembly: bundle tables from the graph, claim checks, capped selections, synthesised edges, rubric rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .graph import kept

#: Kinds of the graph as kinds of the bundle; file and import nodes are not exported (fixed values).
KIND_MAP = {"method": "function", "trait": "interface", "protocol": "interface", "enum_member": "constant"}
NOT_EXPORTED = ("file", "import")


def bundle_kind(kind: Column, language: Column | None = None) -> Column:
    """The bundle's kind; null for what is not exported. A Verilog class is a module."""
    table = F.create_map(*[F.lit(x) for kv in KIND_MAP.items() for x in kv])
    verilog = (kind == "class") & (F.lower(F.coalesce(language, F.lit(""))) == "verilog") if language is not None else F.lit(False)
    return F.when(~kind.isin(*NOT_EXPORTED), F.when(verilog, "module").otherwise(F.coalesce(F.try_element_at(table, kind), kind)))


def bundle_predicate(kind: Column) -> Column:
    return F.when(kind == "imports", "imports_or_includes").otherwise(kind)


def ordinals(df: DataFrame, name: str, form: str, order: list[str]) -> DataFrame:
    """Ids by position in a total order: ranks within ranges of the first column, then the ranges' prefix sums.

    No task sees more than a range, so the numbering of a large table stays spread out.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    placed = df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id())
    placed = placed.withColumn("__row", F.monotonically_increasing_id() - (F.col("__part").cast("long") * (1 << 33)))
    placed = kept(placed)  # range bounds are sampled: both uses below must see the same ranges
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy("__part").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))  # a row a partition
    return placed.join(F.broadcast(bases.select("__part", "base")), "__part").withColumn(name, F.format_string(form, F.col("base") + F.col("__row") + 1)).drop("__part", "__row", "base")


def capped(df: DataFrame, by: list[str], order: list, most: int) -> DataFrame:
    """At most ``most`` rows of each group, in order."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("__nth") <= most).drop("__nth")


def signals_for_rows(rows: DataFrame, signals: DataFrame) -> DataFrame:
    """(case_id, signal_id) where a row names the signal's source or its path, each pair once: two equi-joins, united.

    The pairs themselves are not shuffled: a signal with one source and one path meets a case at most once by each, and
    what its path finds goes if the case names its source as well. Only pairs of signals with more go through a distinct."""
    named = lambda key: rows.where(F.col(key).isNotNull()).select("case_id", key).distinct()
    by_source, by_path = named("source_id"), named("path")
    own = signals.select("signal_id", "source_id", "path").distinct()
    several = own.groupBy("signal_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("signal_id").alias("s"))
    same = F.col("signal_id").eqNullSafe(F.col("s"))
    one, more = own.join(several, same, "left_anti"), own.join(several, same, "left_semi")
    told = by_source.select(F.col("case_id").alias("c"), F.col("source_id").alias("at"))
    found = by_path.join(one, "path").join(told, F.col("case_id").eqNullSafe(F.col("c")) & (F.col("source_id") == F.col("at")), "left_anti")
    rest = by_source.join(more, "source_id").select("case_id", "signal_id").unionByName(by_path.join(more, "path").select("case_id", "signal_id")).distinct()
    return by_source.join(one, "source_id").select("case_id", "signal_id").unionByName(found.select("case_id", "signal_id")).unionByName(rest)


def claim_findings(claims: DataFrame, signals: DataFrame) -> DataFrame:
    """(case_id, signal_id, code): claims (case_id, project, axis, attribute, signal_id) on unknown or differing signals."""
    s = signals.select("signal_id", *[F.col(c).alias("s_" + c) for c in ("project", "axis", "attribute")], F.lit(True).alias("known"))
    both = claims.join(s, "signal_id", "left")
    same = F.lit(True)
    for c in ("project", "axis", "attribute"):
        same = same & F.col(c).eqNullSafe(F.col("s_" + c))
    code = F.when(F.col("known").isNull(), "UNKNOWN_CLAIM_SOURCE_SIGNAL").when(~same, "CLAIM_SOURCE_SIGNAL_MISMATCH")
    return both.withColumn("code", code).where("code is not null").select("case_id", "signal_id", "code")


def implements(members: DataFrame, interfaces: DataFrame) -> DataFrame:
    """(type, interface): types whose members (owner, name) include every member of an interface (owner, name)."""
    wanted = interfaces.select(F.col("owner").alias("interface"), "name").distinct()
    total = wanted.groupBy("interface").agg(F.count(F.lit(1)).alias("wanted"))
    have = members.select(F.col("owner").alias("type"), "name").distinct().join(wanted, "name").groupBy("type", "interface").agg(F.count(F.lit(1)).alias("have"))
    return have.join(total, "interface").where((F.col("have") == F.col("wanted")) & (F.col("type") != F.col("interface"))).select("type", "interface")


def rubric_atoms(evidence: DataFrame) -> DataFrame:
    """(case_id, atom_id, role, weight, depends_on): the first evidence concludes with weight 2; L3 atoms form a chain.

    ``evidence`` (case_id, layer, position, statement).
    """
    previous = F.lag("atom_id").over(Window.partitionBy("case_id").orderBy("position"))
    named = evidence.withColumn("atom_id", F.concat(F.lit("A"), F.col("position").cast("string")))
    return named.select("case_id", "atom_id", F.when(F.col("position") == 1, "conclusion").otherwise("support").alias("role"), F.when(F.col("position") == 1, 2.0).otherwise(1.0).alias("weight"), F.when(F.col("layer") == "L3", previous).alias("depends_on"))


#: Attributes and the baselines that must fail for them (fixed values).
ATTRIBUTE_BASELINES = {
    "long_tail": ["closed_book_llm"], "distracting_info": ["top_1_dense_only"], "version_fork": ["single_source_set_retrieval"], "non_code_anchor": ["code_only_retrieval"],
    "false_premise": ["closed_book_llm", "oracle_evidence_llm"], "doc_code_divergence": ["doc_only_retrieval"], "conditional_behavior": ["top_1_dense_only"],
    "negative_evidence": ["closed_book_llm"], "implicit_domain_knowledge": ["oracle_evidence_no_reasoning_llm"], "quantitative_aggregation": ["top_1_dense_only"],
}
#: What tells documents from code in a path, and refusals (fixed values).
DOC_ENDINGS = (".rst", ".md", ".txt")
NOT_CODE = ("doc/", ".rst", ".md", ".txt", "Makefile", "/ci/", "/.github/")
REFUSALS = ("refuse", "无法判断", "无法确认", "no evidence", "Cannot ", "cannot confirm", "只能给出有限结论")


def evidence_view(evidence: DataFrame, baseline: str, candidates: DataFrame | None = None) -> DataFrame:
    """The evidence (case_id, position, source_id, path, lines) that a baseline may see: nothing, the first candidate (or the
    first evidence of a case without any), what looks like documents or like code, one source, or all."""
    path = F.coalesce("path", F.lit(""))
    if baseline == "closed_book_llm":
        return evidence.limit(0)
    if baseline == "top_1_dense_only":
        first = evidence.where("position = 1")
        if candidates is None:
            return first
        head = candidates.where("position = 1").select(*[c for c in evidence.columns])
        return head.unionByName(first.join(head.select("case_id"), "case_id", "left_anti"))
    if baseline == "doc_only_retrieval":
        wanted = path.contains("doc")
        for e in DOC_ENDINGS:
            wanted = wanted | path.endswith(e)
        return evidence.where(wanted)
    if baseline == "code_only_retrieval":
        other = F.lit(False)
        for part in NOT_CODE:
            other = other | path.contains(part)
        return evidence.where(~other)
    if baseline == "single_source_set_retrieval":
        first = evidence.groupBy("case_id").agg(F.min_by("source_id", "position").alias("source_id"))
        return evidence.join(first, ["case_id", "source_id"], "left_semi").select(evidence.columns)
    return evidence


def baseline_plan(cases: DataFrame) -> DataFrame:
    """(case_id, attribute, baseline) to run for cases (case_id, attributes); unknown attributes have none."""
    table = F.create_map(*[x for a, b in ATTRIBUTE_BASELINES.items() for x in (F.lit(a), F.array(*map(F.lit, b)))])
    each = cases.select("case_id", F.explode("attributes").alias("attribute"))
    return each.select("case_id", "attribute", F.explode(F.try_element_at(table, F.col("attribute"))).alias("baseline"))


def refuses(text: Column) -> Column:
    out, low = F.lit(False), F.lower(text)
    for token in REFUSALS:
        out = out | low.contains(token.lower())
    return out


def outcome(answer: Column, query: Column, gold: Column, attribute: Column | None = None) -> Column:
    """inconclusive without an answer; on negative evidence a refusal fails the baseline and any other answer succeeds; else
    a refusal fails it, a token of the gold answer that the query lacks succeeds, and all the rest is inconclusive."""
    own = F.array_except(S.answer_tokens(gold), S.answer_tokens(query))
    shared = F.size(F.array_intersect(own, S.answer_tokens(answer))) > 0
    negative = F.coalesce(attribute == "negative_evidence", F.lit(False)) if attribute is not None else F.lit(False)
    empty = F.trim(F.regexp_replace(F.coalesce(answer, F.lit("")), r"\s+", " ")) == ""
    return F.when(empty, "inconclusive").when(refuses(answer), "baseline_failed").when(negative | shared, "baseline_succeeded").otherwise("inconclusive")


def dry_run_gate(claims: DataFrame, judge: str = "none") -> DataFrame:
    """(case_id, attribute, baseline, status, cache_key) for claims (case_id, attribute): what a run without a judge records."""
    table = F.create_map(*[x for a, b in ATTRIBUTE_BASELINES.items() for x in (F.lit(a), F.lit(b[0]))])
    baseline = F.coalesce(F.try_element_at(table, F.col("attribute")), F.lit("closed_book_llm"))
    return claims.select("case_id", "attribute", baseline.alias("baseline"), F.lit("skipped_no_provider").alias("status"), F.concat_ws(":", F.col("case_id").cast("string"), "attribute", baseline, F.lit(judge), F.lit("dry-run-v1")).alias("cache_key"))


def reattach(kept_edges: DataFrame, old_nodes: DataFrame, new_nodes: DataFrame) -> DataFrame:
    """Edges into re-indexed files, pointed at the new node of the same name and kind (the smallest id of several)."""
    old = old_nodes.select(F.col("id").alias("target"), "name", F.col("kind").alias("node_kind"))
    new = new_nodes.groupBy("name", F.col("kind").alias("node_kind")).agg(F.min("id").alias("new_target"))
    return kept_edges.join(old, "target").join(new, ["name", "node_kind"]).select("source", F.col("new_target").alias("target"), "kind", "line")


def case_coverage(stages: dict[str, DataFrame], key: str = "case_id") -> DataFrame:
    """(case_id, missing): for every case of any stage, the stages without it, in order."""
    tagged = None
    for name, df in stages.items():
        own = df.select(key).distinct().withColumn("stage", F.lit(name))
        tagged = own if tagged is None else tagged.unionByName(own)
    have = tagged.groupBy(key).agg(F.collect_set("stage").alias("have"))
    return have.select(key, F.array_join(F.array_except(F.array(*[F.lit(n) for n in stages]), "have"), ",").alias("missing"))
