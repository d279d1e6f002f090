"""Selection of sources, signals and evidence for evaluation rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .graph import kept
from .assembly import ordinals

#: Paths that are no material, attributes that selection knows, and pairs of them in order of preference (fixed values).
LOW_QUALITY_MARKS = ("external", "third_party", "gtest", "golden", "protobuf", "vendor", "node_modules", "traces/traceplayer")
LOW_QUALITY_ENDINGS = (".a", ".dat", ".dimg", ".gif", ".jpeg", ".jpg", ".md5", ".o", ".pdf", ".png", ".so")
KNOWN_ATTRIBUTES = ("long_tail", "distracting_info", "non_code_anchor", "conditional_behavior", "implicit_domain_knowledge", "doc_code_divergence", "version_fork_diff")
PAIRS = (
    ("long_tail", "implicit_domain_knowledge"), ("distracting_info", "conditional_behavior"), ("non_code_anchor", "implicit_domain_knowledge"),
    ("long_tail", "doc_code_divergence"), ("distracting_info", "implicit_domain_knowledge"), ("long_tail", "conditional_behavior"),
)
ANSWER_TYPES = ("location", "procedure", "mechanism", "synthesis")
#: What a line must hold to guard something, licences, and files that hold code (fixed values).
COMMENT_LEADS = r"^\s*(//|#|--|\*)"
GUARD_LINE = r"^\s*(`ifndef|`endif|#ifndef|#endif)|^\s*(`define|#define)\S*(\s+\S+)?\s*$"
INCLUDE_LINE = r"^\s*(`include|#include)"


def is_material(path: Column, line_count: Column, source_type: Column) -> Column:
    """Whether a source serves for rows: it has lines, is not binary, and its path has no mark of foreign or generated files."""
    low, bad = F.lower(path), F.lit(False)
    for mark in LOW_QUALITY_MARKS:
        bad = bad | low.contains(mark)
    for ending in LOW_QUALITY_ENDINGS:
        bad = bad | low.endswith(ending)
    return F.coalesce((line_count > 0) & ~F.coalesce(source_type.startswith("binary."), F.lit(False)) & ~bad, F.lit(False))


def material(sources: DataFrame, project: str) -> DataFrame:
    """A project's sources that serve for rows."""
    return sources.where((F.col("project") == project) & is_material(F.col("path"), F.col("line_count"), F.col("source_type")))


def admitted(signals: DataFrame, sources: DataFrame, project: str, order: str = "ordinal") -> tuple[DataFrame, DataFrame]:
    """(kept, dropped): signals of the project on a known source with its path and an axis of 2 or 3, the first by ``order`` of
    each attribute and source; and (attribute, n) of those whose attribute selection does not know."""
    known = sources.select("source_id", F.col("path").alias("s_path"))
    own = signals.where((F.col("project") == project) & F.col("axis").isin(2, 3)).join(known, "source_id").where("path = s_path").drop("s_path")
    unknown = own.where(~F.col("attribute").isin(*KNOWN_ATTRIBUTES)).groupBy("attribute").agg(F.count(F.lit(1)).alias("n"))
    nth = F.row_number().over(Window.partitionBy("attribute", "source_id").orderBy(order))
    return own.where(F.col("attribute").isin(*KNOWN_ATTRIBUTES)).withColumn("nth", nth).where("nth = 1").drop("nth"), unknown


def pair_of(index: Column, available: list[str]) -> Column:
    """The first pair of attributes, from the one at ``index`` on and around, of which both are available; null without one."""
    usable = [all(a in available for a in p) for p in PAIRS]
    table = []
    for start in range(len(PAIRS)):
        at = next((k for k in range(start, start + len(PAIRS)) if usable[k % len(PAIRS)]), None)
        pair = PAIRS[at % len(PAIRS)] if at is not None else None
        table.append(F.array(*map(F.lit, pair)) if pair else F.lit(None).cast("array<string>"))
    return F.get(F.array(*table), F.pmod(index, F.lit(len(PAIRS))).cast("int"))


def same_source_picks(cases: DataFrame, signals: DataFrame) -> DataFrame:
    """(case_id, source_id, axis2, axis3) for cases (case_id, index): sources that have signals of both axes, conditions aside,
    in order of their ids, the case's by its index around; and of the source's signals of either axis, by attribute and
    id, the one at the index and the one at the rounds of the first."""
    own = signals.where("attribute <> 'conditional_behavior'")
    listed = lambda n: F.array_sort(F.collect_list(F.when(F.col("axis") == n, F.struct("path", "attribute", "signal_id")))).alias(f"axis{n}")
    both = own.groupBy("source_id").agg(listed(2), listed(3)).where((F.size("axis2") > 0) & (F.size("axis3") > 0))
    numbered = ordinals(both, "ordinal", "%d", ["source_id"]).withColumn("ordinal", F.col("ordinal").cast("long") - 1)
    total = numbered.agg(F.count(F.lit(1)).alias("total"))  # one row
    wanted = cases.join(F.broadcast(total), F.lit(True)).where("total > 0").withColumn("ordinal", F.pmod("index", F.col("total")))
    at = lambda items, i: F.get(items, F.pmod(i, F.size(items)).cast("int"))["signal_id"]
    return wanted.join(numbered, "ordinal").select("case_id", "source_id", at(F.col("axis2"), F.col("index")).alias("axis2"), at(F.col("axis3"), F.floor(F.col("index") / F.size("axis2"))).alias("axis3"))


def claim_sources(selected: DataFrame, order: str = "position") -> DataFrame:
    """(case_id, attribute, signals): the ids of a case's signals of an attribute, in order."""
    kept = selected.groupBy("case_id", "attribute").agg(F.array_sort(F.collect_list(F.struct(order, "signal_id"))).alias("s"))
    return kept.select("case_id", "attribute", F.transform("s", lambda x: x["signal_id"]).alias("signals"))


def line_window(preferred: Column, line_count: Column, width: int = 3) -> Column:
    """``width`` lines from the preferred start, held to the source."""
    start = F.least(F.greatest(S.line_start(preferred), F.lit(1)), line_count)
    end = F.least(line_count, start + width - 1)
    one = F.when(start == end, start.cast("string")).otherwise(F.concat_ws("-", start.cast("string"), end.cast("string")))
    return F.when(line_count <= 0, "1").otherwise(one)


def path_label(path: Column) -> Column:
    """A path without repo_sources and the repository."""
    parts = F.split(path, "/")
    return F.when((F.size(parts) >= 3) & (F.get(parts, F.lit(0)) == "repo_sources"), F.array_join(F.slice(parts, F.lit(3), F.greatest(F.size(parts) - 2, F.lit(0))), "/")).otherwise(path)


def evidence_role(attribute: Column) -> Column:
    return F.when(attribute == "conditional_behavior", "trigger_condition").when(attribute == "doc_code_divergence", "comparison_point").otherwise("evidence_fact")


def answer_type(answerability: Column, index: Column) -> Column:
    cycled = F.get(F.array(*map(F.lit, ANSWER_TYPES)), F.pmod(index, F.lit(len(ANSWER_TYPES))).cast("int"))
    return F.when(answerability.isin("unanswerable_missing_evidence", "unanswerable_ambiguous"), "negative").when(answerability == "unanswerable_false_premise", "fact_check").otherwise(cycled)


def diversity(rows: DataFrame, most_spans: int = 3, most_anchors: int = 5) -> DataFrame:
    """(what, key, n): spans and sources of candidates (case_id, path, lines, source_id) that too many rows use."""
    what = lambda name, key, most: rows.where(key != "").groupBy(F.lit(name).alias("what"), key.alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)
    span = F.when((F.col("path") != "") & (F.col("lines") != ""), F.concat_ws(":", "path", "lines")).otherwise("")
    return what("span", span, most_spans).unionByName(what("anchor", F.coalesce("source_id", F.lit("")), most_anchors))


def code_part(line: Column) -> Column:
    """What of a line is no comment; a line that starts as one has none."""
    return F.when(line.rlike(COMMENT_LEADS), "").otherwise(F.substring_index(F.substring_index(line, "//", 1), "#", 1))


def guard_lines(lines: DataFrame, pattern: str) -> DataFrame:
    """(source_id, line): lines whose code holds a guard token; include guards are none."""
    return lines.where(~F.col("text").rlike(GUARD_LINE) & code_part(F.col("text")).rlike(pattern)).select("source_id", "line")


def conditional_spans(spans: DataFrame, lines: DataFrame, pattern: str, licences: tuple = ("Redistribution and use in source", "Apache License", "Permission is hereby granted"), width: int = 3, margin: int = 2) -> DataFrame:
    """(span_id, lines, kept): spans (span_id, source_id, lines, snippet) that hold a guard within ``margin`` lines and no
    licence keep their lines; others move to the first guard of the source; without one they go (``kept`` false)."""
    guards = guard_lines(lines, pattern)
    count = lines.groupBy("source_id").agg(F.max("line").alias("last"))
    first = guards.groupBy("source_id").agg(F.min("line").alias("first"))
    own = spans.withColumn("range", S.line_range(F.col("lines")))
    near = own.join(guards, "source_id").where(F.col("line").between(F.col("range.start") - margin, F.col("range.end") + margin)).select("span_id").distinct().withColumn("near", F.lit(True))
    licensed = F.lit(False)
    for phrase in licences:
        licensed = licensed | F.coalesce(F.col("snippet"), F.lit("")).contains(phrase)
    both = own.join(near, "span_id", "left").join(first, "source_id", "left").join(count, "source_id", "left")
    moved = F.concat_ws("-", F.col("first").cast("string"), F.least(F.col("last"), F.col("first") + width - 1).cast("string"))
    stays = F.coalesce(F.col("near"), F.lit(False)) & ~licensed
    usable = F.col("range").isNotNull()
    return both.select("span_id", F.when(stays & usable, F.col("lines")).when(usable & F.col("first").isNotNull(), moved).alias("lines"), (usable & (stays | F.col("first").isNotNull())).alias("kept"))


def first_declaration(lines: DataFrame) -> DataFrame:
    """(source_id, line): the first line outside block comments that is no comment, guard or include; sources without one are
    left out. A block comment's state is folded over the source's lines."""
    said = lines.select("source_id", "line", F.regexp_replace("text", r"^\s+|\s+$", "").alias("t"), "text")
    code = ~F.col("t").rlike(r"^(//|#|--|\*)") & ~F.col("text").rlike(GUARD_LINE) & ~F.col("text").rlike(INCLUDE_LINE)
    kind = F.when(F.col("t") == "", "blank").when(F.col("t").startswith("/*"), F.when(F.col("t").contains("*/"), "whole").otherwise("open")).when(code, "code").otherwise("other")
    marked = said.groupBy("source_id").agg(F.array_sort(F.collect_list(F.struct("line", kind.alias("kind"), F.col("t").contains("*/").alias("ends")))).alias("all"))

    def step(state: Column, x: Column) -> Column:
        inside = F.when(x["kind"] == "blank", state["inside"]).when(state["inside"], ~x["ends"]).otherwise(x["kind"] == "open")
        hit = F.when(state["hit"].isNull() & ~state["inside"] & (x["kind"] == "code"), x["line"]).otherwise(state["hit"])
        return F.struct(inside.alias("inside"), hit.alias("hit"))

    start = F.struct(F.lit(False).alias("inside"), F.lit(None).cast("int").alias("hit"))
    return marked.select("source_id", F.aggregate("all", start, step)["hit"].alias("line")).where("line is not null")


def include_targets(sources: DataFrame) -> DataFrame:
    """(basename, source_id): the first source by id of each file name."""
    return sources.groupBy(S.basename(F.col("path")).alias("basename")).agg(F.min("source_id").alias("source_id"))


def merged_stages(candidates: DataFrame, stages: dict[str, DataFrame], key: str = "case_id") -> DataFrame:
    """Candidates with the columns of every stage (prefixed by its name) and ``stages``, the names of those that have the case."""
    out, names = candidates, []
    for name, df in stages.items():
        own = df.select(key, *[F.col(c).alias(f"{name}_{c}") for c in df.columns if c != key], F.lit(True).alias(f"__{name}"))
        out = out.join(own, key, "left")
        names.append(F.when(F.col(f"__{name}"), F.lit(name)))
    return out.withColumn("stages", F.array_join(F.array_compact(F.array(*names)), ",")).drop(*[f"__{n}" for n in stages])


def required_stages(stages: dict[str, DataFrame], expected: DataFrame, key: str = "case_id") -> DataFrame:
    """(stage, missing, shown): how many expected cases each stage lacks, and the first five by id."""
    out = None
    for name, df in stages.items():
        gone = expected.select(key).distinct().join(df.select(key), key, "left_anti")
        first = gone.orderBy(key).limit(5).agg(F.array_join(F.array_sort(F.collect_list(key)), ",").alias("shown"))
        own = gone.agg(F.count(F.lit(1)).alias("missing")).join(first, F.lit(True)).select(F.lit(name).alias("stage"), "missing", "shown")
        out = own if out is None else out.unionByName(own)
    return out


def diverse_sample(rows: DataFrame, findings: DataFrame, size: int) -> DataFrame:
    """(case_id, place) of at most ``size`` cases, by place from 1: those of findings (place, case_id) first, in their order;
    then the first row of each bucket of project, layer and capability, until what is chosen and the buckets seen would
    fill the sample; from there on every row.

    ``rows`` has (place, case_id, project, layer, capability). With f cases of findings the look-ahead ends at the
    ceil((size - f) / 2)-th new bucket, so ranks of buckets tell all of it. Of rows that repeat a case the first counts;
    findings of no row and without a case do not. ``size`` is the report's length: everything else is ordered and cut."""
    if size <= 0:
        return rows.select("case_id", F.lit(0).alias("place")).where(F.lit(False))
    label = lambda c: S.label_code(F.col(c)) if rows.schema[c].dataType.typeName() == "struct" else F.coalesce(F.col(c).cast("string"), F.lit("unknown"))
    bucket = F.struct(F.coalesce(F.col("project").cast("string"), F.lit("")).alias("project"), label("layer").alias("layer"), label("capability").alias("capability"))
    own = rows.where(F.col("case_id").isNotNull()).groupBy("case_id").agg(F.min_by(F.struct(F.col("place"), bucket.alias("bucket")), "place").alias("r")).select("case_id", "r.place", "r.bucket")
    told = findings.where(F.col("case_id").isNotNull()).groupBy("case_id").agg(F.min("place").alias("f")).join(own.select("case_id"), "case_id")
    first = told.orderBy("f").limit(size)
    first = kept(first.withColumn("turn", F.lit(0)).select("turn", F.col("f").alias("at"), "case_id"))
    left = size - first.count()
    if left == 0:
        return _placed(first)
    rest = kept(own.join(first.select("case_id"), "case_id", "left_anti"))
    new = rest.groupBy("bucket").agg(F.min_by(F.struct("place", "case_id"), "place").alias("r")).select(F.lit(1).alias("turn"), F.col("r.place").alias("at"), "r.case_id")
    new = kept(new.orderBy("at").limit(-(-left // 2)))
    chosen = first.unionByName(new)
    if new.count() == -(-left // 2):
        last = new.agg(F.max("at")).first()[0]
        more = rest.where(F.col("place") > last).select(F.lit(2).alias("turn"), F.col("place").alias("at"), "case_id")
        chosen = chosen.unionByName(more.orderBy("at").limit(left - -(-left // 2)))
    return _placed(chosen)


def _placed(chosen: DataFrame) -> DataFrame:
    """Places of a sample, which has as many rows as a report."""
    return chosen.select("case_id", F.row_number().over(Window.orderBy("turn", "at")).alias("place"))


def rotated_anchors(candidates: DataFrame, cap: int = 3) -> DataFrame:
    """(case_id, candidate_id): each row's anchor, in the order of rows: of its candidates (case_id, row, candidate_id, path, lines,
    degree) those whose span has been an anchor fewer than ``cap`` times first, then by degree, path, lines and id.

    The tally runs across rows, yet no row waits for another: rows propose to their best span, a span takes the ``cap``
    first rows that propose, and the others go on to their next. A span's last row taken only ever gets earlier, so a
    round looks each row's best span up among these bounds, until none changes; then each row has what it would have had
    in turn. A row that no span takes has its first candidate, whose tally is full. A span that very many rows want is cut
    to ``cap`` rows for each task before it is sorted. Rows (equal or null ``row``) stand in the order of row and case_id;
    a null degree is the least."""
    shape = ["row", "case_id"]
    own = candidates.select(*shape, "candidate_id", F.struct("path", "lines").alias("span"), F.struct(-F.coalesce("degree", F.lit(-(1 << 30))), F.col("path"), F.col("lines"), F.col("candidate_id")).alias("wish"))
    # one wish for each span of a row, and rows told apart by their places
    wishes = own.groupBy(*shape, "span").agg(F.min("wish").alias("wish")).select(F.struct(F.coalesce("row", F.lit(-1)).alias("row"), F.col("case_id").alias("case_id")).alias("turn"), "span", "wish")
    wishes = kept(wishes)
    taken = None
    while True:
        if taken is None:
            open_ = wishes
        else:
            bounds = F.broadcast(taken) if taken.count() <= 1 << 18 else taken
            open_ = wishes.join(bounds, "span", "left").where(F.col("last").isNull() | (F.col("turn") <= F.col("last"))).drop("last")
        best = open_.groupBy("turn").agg(F.min_by(F.struct("span", "wish"), "wish").alias("best")).select("turn", F.col("best.span").alias("span"), F.col("best.wish").alias("wish"))
        nth = F.row_number().over(Window.partitionBy("span").orderBy("turn"))
        full = kept(best.withColumn("nth", nth).where(F.col("nth") <= cap).where(F.col("nth") == cap).select("span", F.col("turn").alias("last")))
        now = full if taken is None else kept(taken.unionByName(full).groupBy("span").agg(F.min("last").alias("last")))
        if taken is not None and now.count() == taken.count() and now.exceptAll(taken).isEmpty():
            break
        taken = now
    first = wishes.groupBy("turn").agg(F.min("wish").alias("first"))
    return first.join(best.select("turn", "wish"), "turn", "left").select("turn.case_id", F.coalesce("wish", "first")["candidate_id"].alias("candidate_id"))
