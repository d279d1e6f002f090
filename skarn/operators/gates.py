"""Gates and validators over nested evaluation rows: each yields findings (case_id, severity, rule, position) or reason codes.

Rows have: case_id, project, layer, axis1_layer, answer_type, answerability, axis2 and axis3 (arrays of attributes), has_difficulty,
claims (array of (attribute, signals), null if missing), tags, query, query_rewrite, expected_answer, evidence (array of (evidence_id,
source_id, path, lines, role, statement)), refs (array of (source_id, path)), atoms (array of (id, role, match_type, statement, weight,
evidence_ids, depends_on)), forbidden (array of (id, statement, match_type, severity)), required, granularity and required_ids.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from .evaluation import asks_for_citation

#: Values and phrases that the gates know (fixed values).
ANSWER_TYPES = ("yes_no", "mechanism", "fact_check", "comparison", "location", "procedure", "negative", "synthesis")
ANSWERABILITY = ("answerable", "unanswerable_missing_evidence", "unanswerable_false_premise", "unanswerable_ambiguous")
MISSING = "unanswerable_missing_evidence"
CONDITION_ROLES = ("trigger_condition", "branch", "guard", "predicate", "state")
ATOM_ROLES = ("conclusion", "evidence_fact", "reasoning", "boundary", "location", "procedure_step", "comparison_point")
MATCH_TYPES = ("semantic_yes_no", "semantic_fact", "semantic_reasoning", "path_or_symbol", "numeric_or_version", "list_set", "semantic_contradiction")
SEVERITIES = ("fatal", "major", "minor")
CITATION_REQUIRED = ("always", "never", "when_query_requests_evidence")
GRANULARITIES = ("path_line", "path_only", "source_only")
RUBRIC_LIKE = ("应说明", "应把", "应围绕 query 指定的上下文", "检索并串联这些关键证据", "答案需要说明", "如何支持或修正用户的假设")
REWRITE_FORBIDDEN = ("检索并回答", "验证假设", "优先参考实体", "范围约束", "需要定位触发条件", "状态/数据更新", "后续调用或消费关系", "不能只做符号定位", "回答应服务后续推理")
CHATTY = ("帮我", "我想", "我知道", "我在看", "我已经知道", "想看", "到底", "顺便", "吧", "不用泛泛")
DIRECT = ("会", "不会", "无法判断", "不能确认", "可以", "不可以", "支持", "不支持")
REFUSAL_LEAKS = ("我没有看到可核验证据", "没有提供任何可用信息", "请说明能确认什么、不能确认什么", "没有给出可核验")
SHOWN = "这些行显示："
BOILERPLATE = (
    "this distribution for more information", "Unless required by applicable law", "NVDLA Open Source Project documentation",
    "If extensions (or modules to document with autodoc)", "Invoke manually from the Actions tab", "`define FORCE_CONTENTION_ASSERTION_RESET_ACTIVE",
    "`define ASSERT_RESET nvdla_core_rstn", "`define SYNC_PL_NOSYNTHESIS_NOSYNTH_GCS", "ASSERT_OFF_RESET_IS_X", "1. DEFINITIONS",
)
GUARD_TOKENS = r"\bif\s*\(|\belse\b|\bcase\b|\bwhen\b|\bassert\b|\bposedge\b|\bnegedge\b|@\s*\(|`ifdef\b|`ifndef\b|\brequire\b|\bassume\b|\bwait\b"
POINTER = r"^[\w./@+\-]+:\d+(-\d+)?\s*显示："
GENERIC_FORBIDDEN = r"^答案声称\s+.+\s+支持与引用证据相反的结论\s*$"
REWRITE_TOKEN = r"([A-Za-z_][A-Za-z0-9_:.>\\/-]*)"
STYLES = ("colloquial", "contextual", "hypothesis-check", "follow-up")
INTERROGATIVES = ("吗", "是否", "能否", "?", "？", "什么", "怎样", "怎么", "哪", "Does ", "Is ", "Are ", "Can ", "How ", "What ", "Where ", "Why ", "Will ")
QUERY_CUES = (*REFUSAL_LEAKS, "我没有看到")
CLAIM_KINDS = ("behavior", "state", "invariant", "negative", "comparison")
REJECT_REASONS = (
    "license_header", "copyright_continuation", "rst_heading_only", "sphinx_config_boilerplate", "ci_workflow_header", "assertion_macro_fence",
    "blank_or_separator", "no_guard_token_available", "layer_companion_missing", "other_boilerplate",
)
ANSWER_RUBRIC = ("应说明", "应当", "应该", "请检索", "答案需要", "答案应", "should explain", "the answer should")
YES_NO_OPENINGS = ("会", "不会", "无法判断", "Yes", "No", "Cannot")
FACT_OPENINGS = ("支持", "不支持", "Confirmed", "Refuted")
NEGATIVE_OPENINGS = ("无法判断", "只能给出有限结论", "Cannot")
VERIFIER_REFUSALS = ("无法判断", "只能给出有限结论", "无法确认", "没有证据")
VERIFIER_REFUSALS_ANY_CASE = ("Cannot ", "cannot confirm", "no evidence", "Unable to")
CONFIDENCES = ("low", "medium", "high")
DOC_SUFFIX, DOC_HINT = r"\.(rst|md|txt|adoc|html)$", r"/docs?/|/document/|readme|/manual/"
CODE_SUFFIX = r"\.(c|h|cc|cpp|cxx|hpp|sv|v|vh|sva|py|rb|go|rs|java|scala|ts|js|mk|cmake|yaml|yml|tcl|sh)$"
CODE_HINT = r"/(src|sw|hw|rtl|sim|lib|include)/"


def any_of(text: Column, phrases: tuple) -> Column:
    out = F.lit(False)
    for p in phrases:
        out = out | text.contains(p)
    return out


def blank(text: Column) -> Column:
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " ")) == ""


def findings(rows: DataFrame, rules: list[tuple], key: str = "case_id") -> DataFrame:
    """(case_id, severity, rule, position). A rule is (severity, name, condition), or (severity, name, array, condition of an
    item and its place from 0), which yields a finding for each such item."""
    kind = "struct<severity:string,rule:string,position:int>"

    def made(severity: str, name: str, position: Column) -> Column:
        return F.struct(F.lit(severity).alias("severity"), F.lit(name).alias("rule"), position.cast("int").alias("position"))

    def each(severity: str, name: str, items: Column, broken) -> Column:
        hits = F.transform(items, lambda x, i: F.when(F.coalesce(broken(x, i), F.lit(False)), made(severity, name, i)))
        return F.filter(hits, lambda x: x.isNotNull())

    parts = []
    for severity, name, *rest in rules:
        if len(rest) == 1:
            parts.append(F.when(F.coalesce(rest[0], F.lit(False)), F.array(made(severity, name, F.lit(None)))))
        else:
            parts.append(each(severity, name, *rest))
    none = F.array().cast(f"array<{kind}>")
    every = F.concat(*[F.coalesce(p.cast(f"array<{kind}>"), none) for p in parts])
    return rows.select(F.col(key).alias("case_id"), F.explode(every).alias("f")).select("case_id", "f.*")


def repeated_before(items: Column, field: str) -> Column:
    """For each item, whether an earlier one has the same value of a field."""
    values = F.transform(items, lambda x: x[field])
    return F.transform(items, lambda x, i: F.array_contains(F.slice(values, F.lit(1), i), x[field]))


def attributes() -> Column:
    return F.when(F.col("has_difficulty"), F.concat("axis2", "axis3")).otherwise(F.array().cast("array<string>"))


def axis_attributes(rows: DataFrame) -> DataFrame:
    """(case_id, axis, attribute) of the rows' difficulty."""
    both = F.concat(F.transform("axis2", lambda a: F.struct(F.lit(2).alias("axis"), a.alias("attribute"))), F.transform("axis3", lambda a: F.struct(F.lit(3).alias("axis"), a.alias("attribute"))))
    return rows.where("has_difficulty").select("case_id", F.explode(both).alias("x")).select("case_id", "x.*")


def _named_in(query: Column, path: Column) -> Column:
    name = S.basename(path)
    return ((path != "") & query.contains(path)) | (name.contains(".") & query.contains(name))


def mentions_file(query: Column, evidence: Column) -> Column:
    """Whether a query holds the path of an evidence item, or its file name if that has a dot."""
    return F.exists(evidence, lambda x: _named_in(query, x["path"]))


def name_parts(text: Column) -> Column:
    """Lower-case parts of three letters or digits or more."""
    return F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda t: F.length(t) >= 3))


def stem(path: Column) -> Column:
    return F.regexp_replace(S.basename(path), r"^(.+)\.[^.]*$", "$1")


def mentions_file_parts(query: Column, evidence: Column) -> Column:
    """The same, or two parts of a file's name."""
    return F.exists(evidence, lambda x: (x["path"] != "") & (_named_in(query, x["path"]) | (F.size(F.array_intersect(name_parts(stem(x["path"])), name_parts(query))) >= 2)))


def shown(statement: Column) -> Column:
    """A statement without the lead that marks a quotation."""
    return F.regexp_replace(F.regexp_replace(statement, f"^{SHOWN}", ""), r"^\s+|\s+$", "")


def is_boilerplate(statement: Column) -> Column:
    """Nothing, a known phrase, or underlines with at most one other part, of less than 80 characters."""
    body = shown(statement)
    parts = F.filter(F.transform(F.split(body, " / "), F.trim), lambda p: p != "")
    ruled = F.size(F.filter(parts, lambda p: p.rlike("^[=-]+$")))
    size = F.aggregate(parts, F.lit(0), lambda n, p: n + F.length(p))
    return (body == "") | (body == "(blank lines)") | any_of(body, BOILERPLATE) | ((ruled > 0) & (ruled >= F.size(parts) - 1) & (size < 80))


def is_pointer(statement: Column) -> Column:
    return F.trim(statement).rlike(POINTER)


def only_quoted_reasoning() -> Column:
    """Whether a row on implicit knowledge has no reasoning atom beyond what its evidence says."""
    bodies = F.filter(F.transform("evidence", lambda x: shown(x["statement"])), lambda b: b != "")
    own = F.transform(F.filter("atoms", lambda a: a["role"] == "reasoning"), lambda a: F.trim(F.regexp_replace(F.trim(a["statement"]), POINTER, "")))
    new = F.exists(own, lambda s: (s != "") & ~F.exists(bodies, lambda b: b.contains(s)))
    return F.col("has_difficulty") & F.array_contains("axis3", "implicit_domain_knowledge") & (F.size(bodies) > 0) & ~new


def _codes(*parts: Column) -> Column:
    return F.filter(F.concat(*parts), lambda c: c.isNotNull())


def _when(condition: Column, code: str) -> Column:
    return F.array(F.when(F.coalesce(condition, F.lit(False)), F.lit(code)))


def _unsupported(exempt: bool) -> Column:
    """MISSING_CLAIM_SOURCE_ATTRIBUTE for each attribute without a claim that names signals."""

    def bad(a: Column) -> Column:
        named = F.exists("claims", lambda c: (c["attribute"] == a) & (F.size(c["signals"]) > 0) & F.forall(c["signals"], lambda s: ~blank(s)))
        own = ~F.coalesce(named, F.lit(False))
        return own & ~((a == "negative_evidence") & (F.col("answerability") == MISSING)) if exempt else own

    each = F.transform(F.filter(attributes(), bad), lambda a: F.lit("MISSING_CLAIM_SOURCE_ATTRIBUTE"))
    return F.when(F.col("has_difficulty") & F.col("claims").isNotNull(), each).otherwise(F.array().cast("array<string>"))


def _shared_codes(floor: Column, exempt: bool) -> list[Column]:
    layer, attrs = F.col("layer"), attributes()
    sources = F.size(F.array_distinct(F.filter(F.transform("evidence", lambda x: x["source_id"]), lambda s: ~blank(s))))
    chained = F.exists("atoms", lambda a: F.size(a["depends_on"]) > 0)
    return [
        _when(~F.col("has_difficulty"), "MISSING_DIFFICULTY"),
        _when(F.col("has_difficulty") & (F.col("axis1_layer") != layer), "DIFFICULTY_LAYER_MISMATCH"),
        _when(F.col("has_difficulty") & F.col("claims").isNull(), "MISSING_CLAIM_SOURCES"),
        _unsupported(exempt),
        _when(floor, "INSUFFICIENT_DIFFICULTY_SIGNALS"),
        _when((layer == "L2") & (sources < 2), "L2_SINGLE_SOURCE"),
        _when((layer == "L3") & (sources < 2), "L3_SINGLE_SOURCE"),
        _when((layer == "L3") & ~chained, "L3_NO_ATOM_CHAIN"),
        _when(F.array_contains(attrs, "conditional_behavior") & ~_has_role(), "CONDITIONAL_BEHAVIOR_WITHOUT_ROLE"),
    ]


def _has_role() -> Column:
    return F.exists("evidence", lambda x: x["role"].isin(*CONDITION_ROLES))


def _few_signals() -> Column:
    l3 = F.when(F.col("layer") == "L3", F.array(F.lit("L3"))).otherwise(F.array().cast("array<string>"))
    return F.size(F.array_distinct(F.concat(attributes(), l3))) < 2


def validator_gate(rows: DataFrame, signals: DataFrame | None = None) -> DataFrame:
    """(case_id, codes, passed): reasons against a row in a fixed order, then those of its claims' signals, sorted."""
    from .assembly import claim_findings

    attrs = attributes()
    needs = F.col("answer_type").isin("yes_no", "fact_check") | (F.col("answerability") == "unanswerable_false_premise") | F.array_contains(attrs, "false_premise")
    codes = _codes(
        *_shared_codes(_few_signals(), exempt=False),
        _when(needs & (F.size("forbidden") == 0), "FORBIDDEN_ATOMS_REQUIRED"),
        _when(~F.array_contains("tags", "file_anchor_required") & mentions_file(F.col("query"), F.col("evidence")), "FILE_ANCHOR_LEAK"),
    )
    out = rows.select("case_id", codes.alias("codes"))
    if signals is not None:
        axes = axis_attributes(rows.where("claims is not null"))
        named = rows.where("claims is not null").select("case_id", "project", F.explode("claims").alias("c")).select("case_id", "project", "c.attribute", "c.signals").where((F.size("signals") > 0) & F.forall("signals", lambda s: ~blank(s)))
        claims = named.join(axes, ["case_id", "attribute"]).select("case_id", "project", "axis", "attribute", F.explode("signals").alias("signal_id"))
        found = claim_findings(claims, signals).groupBy("case_id").agg(F.array_sort(F.collect_list("code")).alias("more"))
        out = out.join(found, "case_id", "left").select("case_id", F.concat("codes", F.coalesce("more", F.array().cast("array<string>"))).alias("codes"))
    return out.select("case_id", F.array_join("codes", ",").alias("codes"), (F.size("codes") == 0).alias("passed"))


def generator_gate(rows: DataFrame) -> DataFrame:
    """(case_id, codes, warns, passed): the stricter gate before release. Rows of missing evidence claim negative evidence and
    nothing else."""
    attrs, missing = attributes(), F.col("answerability") == MISSING
    few = F.when(missing, attrs != F.array(F.lit("negative_evidence"))).otherwise(_few_signals())
    unanswerable = F.col("answerability").startswith("unanswerable")
    needs = F.col("answer_type").isin("yes_no", "fact_check") | unanswerable | F.array_contains(attrs, "false_premise")
    codes = _codes(
        *_shared_codes(few, exempt=True),
        _when(needs & (F.size("forbidden") == 0), "FORBIDDEN_ATOMS_REQUIRED"),
        _when(~F.array_contains("tags", "file_anchor_required") & mentions_file_parts(F.col("query"), F.col("evidence")), "FILE_ANCHOR_LEAK"),
        _when(unanswerable & any_of(F.col("query"), REFUSAL_LEAKS), "UNANSWERABLE_REFUSAL_LEAK"),
        _when(F.exists("evidence", lambda x: is_boilerplate(x["statement"])), "BOILERPLATE_EVIDENCE"),
        _when(F.exists("atoms", lambda a: is_pointer(a["statement"])), "POINTER_STYLE_ATOM"),
        _when(only_quoted_reasoning(), "IMPLICIT_DK_VERBATIM_REASONING"),
    )
    unguarded = F.array_contains(attrs, "conditional_behavior") & _has_role() & ~F.exists("evidence", lambda x: x["statement"].rlike(GUARD_TOKENS))
    warns = F.when(unguarded, "CONDITIONAL_BEHAVIOR_NO_GUARD_TOKENS").otherwise("")
    return rows.select("case_id", F.array_join(codes, ",").alias("codes"), warns.alias("warns"), (F.size(codes) == 0).alias("passed"))


def row_findings(rows: DataFrame) -> DataFrame:
    """Required fields, answer types and answerability."""
    return findings(
        rows,
        [
            ("FAIL", "project_required", blank(F.col("project"))),
            ("FAIL", "layer_required", blank(F.col("layer"))),
            ("FAIL", "answer_type_required", blank(F.col("answer_type"))),
            ("WARN", "answer_type_not_standard", ~F.col("answer_type").isin(*ANSWER_TYPES)),
            ("FAIL", "answerability_unknown", F.col("answerability").isNull() | ~F.col("answerability").isin(*ANSWERABILITY)),
        ],
    )


def rewrite_findings(rows: DataFrame) -> DataFrame:
    """A missing query or rewrite; a chatty rewrite; hidden-context phrases; technical tokens that the query lacks."""
    q, w = F.coalesce("query", F.lit("")), F.coalesce("query_rewrite", F.lit(""))
    both = ~blank(q) & ~blank(w)
    tokens = F.regexp_extract_all(w, F.lit(REWRITE_TOKEN), F.lit(1))
    known = F.regexp_extract_all(q, F.lit(REWRITE_TOKEN), F.lit(1))
    technical = lambda t: ((F.upper(t) == t) & (F.lower(t) != t)) | t.contains("_") | t.contains("::") | t.contains(".")
    phrases = F.when(both, F.array(*[F.lit(p) for p in REWRITE_FORBIDDEN]))
    return findings(
        rows,
        [
            ("FAIL", "query_required", blank(q)),
            ("FAIL", "rewrite_required", ~blank(q) & blank(w)),
            ("WARN", "rewrite_repeats_chatty_query", both & (F.trim(q) == F.trim(w)) & any_of(q, CHATTY)),
            ("FAIL", "rewrite_hidden_context", phrases, lambda p, i: w.contains(p)),
            ("WARN", "rewrite_new_token", F.when(both, tokens), lambda t, i: (F.length(t) >= 4) & ~F.array_contains(known, t) & technical(t)),
        ],
    )


def first_sentence(text: Column) -> Column:
    return F.get(F.split(F.trim(text), r"[。.!?？]", 2), F.lit(0))


def answer_findings(rows: DataFrame) -> DataFrame:
    """The expected answer: missing, rubric-like, short, not direct on a yes/no question, without a citation it must have."""
    a = F.coalesce("expected_answer", F.lit(""))
    policy = F.coalesce("required", F.lit("when_query_requests_evidence"))
    must = (policy == "always") | ((policy == "when_query_requests_evidence") & asks_for_citation(F.col("query")))
    return findings(
        rows,
        [
            ("FAIL", "answer_required", blank(a)),
            ("FAIL", "answer_rubric_like", ~blank(a) & any_of(a, RUBRIC_LIKE)),
            ("WARN", "answer_short", ~blank(a) & (F.length(F.trim(a)) < 40)),
            ("WARN", "answer_not_direct", ~blank(a) & (F.col("answer_type") == "yes_no") & ~any_of(first_sentence(a), DIRECT)),
            ("FAIL", "answer_without_citation", ~blank(a) & must & ~a.rlike(r"[\w./@+-]+:\d+(-\d+)?")),
        ],
    )


def evidence_findings(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """References and evidence: missing, without names, repeated ids, unknown sources, malformed lines or lines beyond the
    source's end, and evidence that no reference covers. ``sources`` (source_id, line_count)."""
    named = rows.select("case_id", F.posexplode(F.transform("evidence", lambda x: x["source_id"])).alias("position", "source_id"))
    known = named.join(sources, "source_id").groupBy("case_id").agg(F.map_from_entries(F.collect_set(F.struct("source_id", "line_count"))).alias("counts"))
    none = F.create_map().cast("map<string,bigint>")
    own = rows.join(known.withColumn("counts", F.col("counts").cast("map<string,bigint>")), "case_id", "left").withColumn("counts", F.coalesce("counts", none))
    own = own.withColumn("again", repeated_before(F.col("evidence"), "evidence_id"))
    optional = F.col("answerability") == MISSING
    span = lambda x: S.line_range(x["lines"])
    count = lambda x: F.try_element_at("counts", x["source_id"])
    paths, ids = F.transform("refs", lambda r: r["path"]), F.transform("refs", lambda r: r["source_id"])
    covered = lambda x: (F.size(F.filter(paths, lambda p: ~blank(p))) == 0) | F.array_contains(paths, x["path"]) | (~blank(x["source_id"]) & F.array_contains(ids, x["source_id"]))
    e = F.col("evidence")
    return findings(
        own,
        [
            ("FAIL", "references_required", (F.size("refs") == 0) & ~optional),
            ("FAIL", "reference_unnamed", F.col("refs"), lambda r, i: blank(r["source_id"]) & blank(r["path"])),
            ("FAIL", "evidence_required", (F.size(e) == 0) & ~optional),
            ("FAIL", "evidence_id_required", e, lambda x, i: blank(x["evidence_id"])),
            ("FAIL", "evidence_id_repeated", e, lambda x, i: ~blank(x["evidence_id"]) & F.get("again", i)),
            *[("FAIL", f"evidence_{f}_required", e, lambda x, i, f=f: blank(x[f])) for f in ("source_id", "path", "role", "statement")],
            ("FAIL", "evidence_source_unknown", e, lambda x, i: ~blank(x["source_id"]) & count(x).isNull()),
            ("WARN", "evidence_not_referenced", e, lambda x, i: ~blank(x["path"]) & ~covered(x)),
            ("FAIL", "evidence_lines_malformed", e, lambda x, i: (x["lines"] != "") & span(x).isNull()),
            ("FAIL", "evidence_lines_beyond_end", e, lambda x, i: (count(x) > 0) & (span(x)["end"] > count(x))),
        ],
    )


def _atom_rules(severity: str, prefix: str = "atom") -> list[tuple]:
    atoms, ids = F.col("atoms"), F.transform("evidence", lambda x: x["evidence_id"])
    unknown = lambda names: F.exists(names, lambda n: ~F.array_contains(ids, n))
    return [
        ("FAIL", f"{prefix}s_required", F.size(atoms) == 0),
        ("FAIL", f"{prefix}_id_required", atoms, lambda a, i: blank(a["id"])),
        ("FAIL", f"{prefix}_id_repeated", atoms, lambda a, i: ~blank(a["id"]) & F.get("atom_again", i)),
        (severity, f"{prefix}_role_unknown", atoms, lambda a, i: ~a["role"].isin(*ATOM_ROLES)),
        (severity, f"{prefix}_match_type_unknown", atoms, lambda a, i: ~a["match_type"].isin(*MATCH_TYPES)),
        ("FAIL", f"{prefix}_statement_required", atoms, lambda a, i: blank(a["statement"])),
        ("FAIL", f"{prefix}_weight_not_positive", atoms, lambda a, i: F.coalesce(a["weight"] <= 0, F.lit(True))),
        ("FAIL", f"{prefix}_evidence_unknown", atoms, lambda a, i: unknown(a["evidence_ids"])),
        ("FAIL", f"no_conclusion_{prefix}", ~F.exists(atoms, lambda a: a["role"] == "conclusion")),
    ]


def rubric_findings(rows: DataFrame) -> DataFrame:
    """Atoms, forbidden atoms and the citation policy."""
    ids = F.transform("evidence", lambda x: x["evidence_id"])
    own = rows.withColumn("atom_again", repeated_before(F.col("atoms"), "id"))
    return findings(
        own,
        [
            *_atom_rules("WARN"),
            ("FAIL", "forbidden_incomplete", F.col("forbidden"), lambda f, i: blank(f["id"]) | blank(f["statement"])),
            ("WARN", "forbidden_match_type", F.col("forbidden"), lambda f, i: f["match_type"] != "semantic_contradiction"),
            ("WARN", "forbidden_severity", F.col("forbidden"), lambda f, i: ~f["severity"].isin(*SEVERITIES)),
            ("WARN", "policy_required_not_standard", F.col("required").isNull() | ~F.col("required").isin(*CITATION_REQUIRED)),
            ("WARN", "policy_granularity_not_standard", F.col("granularity").isNull() | ~F.col("granularity").isin(*GRANULARITIES)),
            ("FAIL", "policy_evidence_unknown", F.col("required_ids"), lambda n, i: ~F.array_contains(ids, n)),
        ],
    )


def repeated_cases(rows: DataFrame, order: str) -> DataFrame:
    """A finding for every later row of a case_id."""
    nth = F.row_number().over(Window.partitionBy("case_id").orderBy(order))
    return rows.withColumn("nth", nth).where("nth > 1").select("case_id", F.lit("FAIL").alias("severity"), F.lit("case_repeated").alias("rule"), F.lit(None).cast("int").alias("position"))


def missing_cases(expected: DataFrame, rows: DataFrame, dropped: DataFrame | None = None) -> DataFrame:
    """A finding for every expected case that a stage lacks and that no earlier stage dropped."""
    gone = expected.select("case_id").distinct().join(rows.select("case_id"), "case_id", "left_anti")
    gone = gone.join(dropped.select("case_id"), "case_id", "left_anti") if dropped is not None else gone
    return gone.select("case_id", F.lit("FAIL").alias("severity"), F.lit("case_missing").alias("rule"), F.lit(None).cast("int").alias("position"))


def dropped_cases(curated: DataFrame, candidates: DataFrame) -> DataFrame:
    """Cases without curated evidence that are no rows of missing evidence."""
    own = curated.where(F.size("evidence") == 0).select("case_id").join(candidates.select("case_id", "answerability"), "case_id", "left")
    return own.where(F.coalesce(F.col("answerability") != MISSING, F.lit(True))).select("case_id")


def is_doc(path: Column) -> Column:
    low = F.lower(path)
    return low.rlike(DOC_SUFFIX) | low.rlike(DOC_HINT)


def is_code(path: Column) -> Column:
    low = F.lower(path)
    return low.rlike(CODE_SUFFIX) | (low.rlike(CODE_HINT) & ~is_doc(path))


# Stage outputs, one row a case. candidates: case_id, layer, answer_type, answerability, axis3, tags, style_hint, spans (array of (path,
# lines, raw_snippet)). curated: case_id, evidence, rejected (array of reasons). claims: case_id, claims (array of (id, text, kind,
# evidence_ids)). queries: case_id, query, query_rewrite, style. answers: case_id, expected_answer, citation_paths. rubrics: case_id, atoms,
# forbidden. verifier: case_id, rederived_answer, confidence, citations.


def curated_findings(curated: DataFrame, candidates: DataFrame) -> DataFrame:
    """Curated evidence against the candidates it was chosen from."""
    both = curated.join(candidates.select("case_id", "layer", "answerability", "axis3", "spans", F.lit(True).alias("known")), "case_id", "left")
    both = both.withColumn("again", repeated_before(F.col("evidence"), "evidence_id"))
    e, known, chosen = F.col("evidence"), F.col("known").isNotNull(), F.size("evidence") > 0
    match = lambda x: F.get(F.filter("spans", lambda c: (c["path"] == x["path"]) & (c["lines"] == x["lines"])), F.lit(0))
    quoted = F.filter(F.transform(e, lambda x: F.coalesce(match(x)["raw_snippet"], F.lit(""))), lambda s: s != "")
    sources = F.size(F.array_distinct(F.filter(F.transform(e, lambda x: x["source_id"]), lambda s: s != "")))
    missing = F.col("answerability") == MISSING
    paths = F.transform(e, lambda x: x["path"])
    full = known & ~missing
    return findings(
        both,
        [
            ("FAIL", "case_unknown", ~known),
            ("FAIL", "evidence_id_required", F.when(known, e), lambda x, i: F.coalesce(x["evidence_id"], F.lit("")) == ""),
            ("FAIL", "evidence_id_repeated", F.when(known, e), lambda x, i: F.get("again", i)),
            *[("FAIL", f"evidence_{f}_required", F.when(known, e), lambda x, i, f=f: F.coalesce(x[f], F.lit("")) == "") for f in ("source_id", "path", "lines", "role", "statement")],
            ("FAIL", "evidence_not_candidate", F.when(known, e), lambda x, i: match(x).isNull()),
            ("FAIL", "evidence_verbatim", F.when(known, e), lambda x, i: (x["statement"] != "") & (match(x)["raw_snippet"] != "") & match(x)["raw_snippet"].contains(x["statement"])),
            ("WARN", "evidence_long", F.when(known, e), lambda x, i: F.length(x["statement"]) >= 200),
            ("FAIL", "missing_evidence_not_empty", known & missing & chosen),
            ("FAIL", "l1_not_single", full & (F.col("layer") == "L1") & (F.size(e) != 1)),
            ("FAIL", "too_few_sources", full & F.col("layer").isin("L2", "L3") & (sources < 2) & chosen),
            ("FAIL", "no_guard_token", full & F.array_contains("axis3", "conditional_behavior") & chosen & ~F.exists(quoted, lambda s: s.rlike(GUARD_TOKENS))),
            ("FAIL", "doc_or_code_missing", full & F.array_contains("axis3", "doc_code_divergence") & chosen & ~(F.exists(paths, is_doc) & F.exists(paths, is_code))),
            ("FAIL", "reject_reason_unknown", F.when(known, F.col("rejected")), lambda r, i: ~r.isin(*REJECT_REASONS)),
        ],
    ).unionByName(missing_cases(candidates, curated))


def claims_findings(claims: DataFrame, curated: DataFrame, candidates: DataFrame) -> DataFrame:
    """Claims against curated evidence and candidates."""
    both = claims.join(curated.select("case_id", "evidence"), "case_id", "left").join(candidates.select("case_id", "layer", "answerability", "spans"), "case_id", "left")
    both = both.withColumn("again", repeated_before(F.col("claims"), "id"))
    known, c = F.col("evidence").isNotNull(), F.when(F.col("evidence").isNotNull(), F.col("claims"))
    ids = F.transform("evidence", lambda x: x["evidence_id"])
    used = F.filter(F.flatten(F.transform("claims", lambda x: x["evidence_ids"])), lambda n: F.array_contains(ids, n))
    chained = F.size(used) > F.size(F.array_distinct(used))
    quotes = lambda x, items, field: (F.trim(x["text"]) != "") & F.exists(items, lambda s: s[field].contains(x["text"]))
    n, missing = F.size("claims"), F.col("answerability") == MISSING
    every = findings(
        both,
        [
            ("FAIL", "case_unknown", ~known),
            ("FAIL", "negative_claim_required", known & (n == 0) & missing),
            ("FAIL", "claims_required", known & (n == 0) & ~F.coalesce(missing, F.lit(False)) & (F.size("evidence") > 0)),
            ("FAIL", "claim_id_required", c, lambda x, i: F.coalesce(x["id"], F.lit("")) == ""),
            ("FAIL", "claim_id_repeated", c, lambda x, i: (x["id"] != "") & F.get("again", i)),
            ("FAIL", "claim_text_required", c, lambda x, i: blank(x["text"])),
            ("WARN", "claim_text_short", c, lambda x, i: ~blank(x["text"]) & (F.length(x["text"]) < 30)),
            ("FAIL", "claim_kind_unknown", c, lambda x, i: F.coalesce(~x["kind"].isin(*CLAIM_KINDS), F.lit(True))),
            ("FAIL", "claim_evidence_unknown", c, lambda x, i: F.exists(x["evidence_ids"], lambda k: ~F.array_contains(ids, k))),
            ("FAIL", "negative_claim_with_evidence", c, lambda x, i: (x["kind"] == "negative") & (F.size(x["evidence_ids"]) > 0) & missing),
            ("FAIL", "claim_quotes_statement", c, lambda x, i: quotes(x, "evidence", "statement")),
            ("FAIL", "claim_quotes_snippet", c, lambda x, i: quotes(x, "spans", "raw_snippet")),
            ("FAIL", "claims_not_chained", known & (n > 0) & (F.col("layer") == "L3") & (F.col("answerability") == "answerable") & ~chained),
            ("WARN", "too_many_claims", known & (n > 3)),
        ],
    )
    return every.unionByName(missing_cases(curated, claims, dropped_cases(curated, candidates)))


def is_question(query: Column) -> Column:
    return any_of(query, INTERROGATIVES)


def query_findings(queries: DataFrame, candidates: DataFrame, curated: DataFrame) -> DataFrame:
    """Queries: length, style, names of evidence files, refusal cues, question marks; and queries that repeat."""
    both = queries.join(candidates.select("case_id", "answer_type", "answerability", "tags", "style_hint"), "case_id", "left").join(curated.select("case_id", "evidence"), "case_id", "left")
    q, ok = F.col("query"), ~blank(F.col("query"))
    shared = lambda x: F.size(F.array_intersect(name_parts(stem(x["path"])), name_parts(q)))
    leaks = F.exists("evidence", lambda x: (shared(x) >= 2) | ((shared(x) == 1) & (F.size(name_parts(stem(x["path"]))) == 1)))
    every = findings(
        both,
        [
            ("FAIL", "query_required", ~ok),
            ("FAIL", "rewrite_required", ok & blank(F.col("query_rewrite"))),
            ("FAIL", "query_short", ok & (F.length(q) < 10)),
            ("FAIL", "query_long", ok & (F.length(q) > 240)),
            ("FAIL", "style_unknown", ok & ~F.col("style").isin(*STYLES)),
            ("WARN", "style_not_as_hinted", ok & (F.col("style_hint") != "") & (F.col("style") != "") & (F.col("style") != F.col("style_hint"))),
            ("FAIL", "query_leaks_file", ok & ~F.coalesce(F.array_contains("tags", "file_anchor_required"), F.lit(False)) & leaks),
            ("FAIL", "query_telegraphs_refusal", ok & F.col("answerability").startswith("unanswerable") & any_of(q, QUERY_CUES)),
            ("FAIL", "query_no_question", ok & F.col("answer_type").isin("yes_no", "fact_check") & ~is_question(q)),
            ("WARN", "colloquial_long", ok & (F.col("style_hint") == "colloquial") & (F.length(q) > 60)),
            ("WARN", "contextual_short", ok & (F.col("style_hint") == "contextual") & (F.length(q) < 25)),
        ],
    )
    same = queries.where(ok).groupBy(F.trim("query").alias("q")).agg(F.count(F.lit(1)).alias("n")).where("n >= 3")
    again = same.select(F.lit(None).cast("string").alias("case_id"), F.lit("WARN").alias("severity"), F.lit("query_repeats").alias("rule"), F.col("n").cast("int").alias("position"))
    return every.unionByName(again).unionByName(missing_cases(candidates, queries, dropped_cases(curated, candidates)))


def cited(entry: Column) -> tuple[Column, Column]:
    """Path and lines of path:lines, parted at the last colon."""
    return F.regexp_extract(entry, r"^(.*):[^:]*$", 1), F.substring_index(entry, ":", -1)


def expected_answer_findings(answers: DataFrame, candidates: DataFrame, curated: DataFrame) -> DataFrame:
    """Expected answers: rubric phrases, citations outside the evidence or missing from the text, openings, quotations."""
    both = answers.join(curated.select("case_id", "evidence"), "case_id", "left").join(candidates.select("case_id", "answer_type", "answerability", "spans"), "case_id", "left")
    a, known = F.col("expected_answer"), F.col("evidence").isNotNull()
    ok = known & ~blank(a)
    cites = F.when(ok, F.col("citation_paths"))
    inside = lambda c: F.exists("evidence", lambda x: (x["path"] == cited(c)[0]) & (x["lines"] == cited(c)[1]))
    snippet = lambda x: F.get(F.filter("spans", lambda c: (c["path"] == x["path"]) & (c["lines"] == x["lines"])), F.lit(0))["raw_snippet"]
    opening = first_sentence(a)
    n = F.coalesce(F.size("citation_paths"), F.lit(0))
    every = findings(
        both,
        [
            ("FAIL", "case_unknown", ~known),
            ("FAIL", "answer_required", known & blank(a)),
            ("FAIL", "answer_rubric_language", F.when(ok, F.array(*[F.lit(p) for p in ANSWER_RUBRIC])), lambda p, i: a.contains(p)),
            ("FAIL", "answer_quotation_lead", ok & a.contains(SHOWN)),
            ("FAIL", "citation_malformed", cites, lambda c, i: ~c.contains(":")),
            ("FAIL", "citation_not_curated", cites, lambda c, i: c.contains(":") & ~inside(c)),
            ("FAIL", "citation_not_in_answer", cites, lambda c, i: c.contains(":") & ~a.contains(F.concat(F.lit("`"), c, F.lit("`")))),
            ("FAIL", "missing_evidence_cites", ok & (F.col("answerability") == MISSING) & (n > 0)),
            ("FAIL", "yes_no_opening", ok & (F.col("answer_type") == "yes_no") & ~any_of(opening, YES_NO_OPENINGS)),
            ("FAIL", "fact_check_opening", ok & (F.col("answer_type") == "fact_check") & ~any_of(opening, FACT_OPENINGS)),
            ("FAIL", "unanswerable_opening", ok & F.col("answerability").isin(MISSING, "unanswerable_ambiguous") & ~any_of(opening, NEGATIVE_OPENINGS)),
            ("FAIL", "answer_quotes_snippet", F.when(ok, F.col("evidence")), lambda x, i: (F.length(snippet(x)) > 30) & a.contains(snippet(x))),
            ("WARN", "answer_long", ok & (F.length(a) > 400)),
            ("WARN", "many_citations", ok & (n > 5)),
        ],
    )
    return every.unionByName(missing_cases(curated, answers, dropped_cases(curated, candidates)))


def rubric_stage_findings(rubrics: DataFrame, candidates: DataFrame, curated: DataFrame, claims: DataFrame) -> DataFrame:
    """Rubrics: atoms, their quotations and chains, forbidden atoms where the case calls for them."""
    texts = claims.select("case_id", F.transform("claims", lambda c: c["text"]).alias("texts"))
    both = rubrics.join(curated.select("case_id", "evidence"), "case_id", "left").join(texts, "case_id", "left").join(candidates.select("case_id", "layer", "answer_type", "answerability", "axis3"), "case_id", "left")
    known = F.col("evidence").isNotNull()
    none = F.array().cast("array<string>")
    both = both.withColumns({"known": known, "bodies": F.coalesce(F.transform("evidence", lambda x: x["statement"]), none), "texts": F.filter(F.coalesce("texts", none), lambda t: t != "")})
    both = both.withColumn("atom_again", repeated_before(F.col("atoms"), "id"))
    atoms, forbidden = F.when(known, F.col("atoms")), F.when(known, F.col("forbidden"))
    said = lambda a, field: (F.trim(a["statement"]) != "") & F.exists(field, lambda b: b.contains(F.trim(a["statement"])))
    ids = F.transform("atoms", lambda a: a["id"])
    depends = F.exists("atoms", lambda a: F.size(a["depends_on"]) > 0)
    trigger = F.col("answer_type").isin("yes_no", "fact_check") | F.col("answerability").isin(*ANSWERABILITY[1:])
    new = F.exists("atoms", lambda a: (a["role"] == "reasoning") & (F.trim(a["statement"]) != "") & ~said(a, "bodies") & ~said(a, "texts"))
    known_rules = [(s, n, known & r[0]) if len(r) == 1 else (s, n, F.when(known, r[0]), r[1]) for s, n, *r in _atom_rules("FAIL")]
    every = findings(
        both,
        [
            ("FAIL", "case_unknown", ~known),
            *known_rules,
            ("WARN", "too_many_atoms", known & (F.size("atoms") > 4)),
            ("FAIL", "atom_is_pointer", atoms, lambda a, i: is_pointer(a["statement"])),
            ("FAIL", "atom_quotes_statement", atoms, lambda a, i: said(a, "bodies")),
            ("FAIL", "atom_quotes_claim", atoms, lambda a, i: said(a, "texts")),
            ("FAIL", "atom_depends_on_unknown", atoms, lambda a, i: F.exists(a["depends_on"], lambda d: ~F.array_contains(ids, d))),
            ("FAIL", "no_atom_chain", known & (F.col("layer") == "L3") & (F.col("answerability") == "answerable") & ~depends),
            ("FAIL", "forbidden_id_required", forbidden, lambda f, i: F.coalesce(f["id"], F.lit("")) == ""),
            ("FAIL", "forbidden_statement_required", forbidden, lambda f, i: blank(f["statement"])),
            ("FAIL", "forbidden_generic", forbidden, lambda f, i: F.trim(f["statement"]).rlike(GENERIC_FORBIDDEN)),
            ("FAIL", "forbidden_match_type_unknown", forbidden, lambda f, i: ~f["match_type"].isin(*MATCH_TYPES)),
            ("FAIL", "forbidden_severity_unknown", forbidden, lambda f, i: ~f["severity"].isin(*SEVERITIES)),
            ("FAIL", "forbidden_required", known & trigger & (F.size("forbidden") == 0)),
            ("WARN", "no_yes_no_match", known & (F.col("answer_type") == "yes_no") & ~F.exists("atoms", lambda a: a["match_type"] == "semantic_yes_no")),
            ("FAIL", "only_quoted_reasoning", known & F.array_contains("axis3", "implicit_domain_knowledge") & ~new),
        ],
    )
    return every.unionByName(missing_cases(curated, rubrics, dropped_cases(curated, candidates)))


def is_refusal(text: Column) -> Column:
    low = F.lower(text)
    out = any_of(text, VERIFIER_REFUSALS)
    for token in VERIFIER_REFUSALS_ANY_CASE:
        out = out | low.contains(token.lower())
    return out


def verifier_findings(verifier: DataFrame, candidates: DataFrame, curated: DataFrame, answers: DataFrame) -> DataFrame:
    """Answers derived again from the evidence against the case and the expected answer."""
    both = verifier.join(candidates.select("case_id", "answerability"), "case_id", "left").join(curated.select("case_id", "evidence"), "case_id", "left").join(answers.select("case_id", "expected_answer", "citation_paths"), "case_id", "left")
    r, ok = F.col("rederived_answer"), ~blank(F.col("rederived_answer"))
    cites = F.when(ok, F.col("citations"))
    inside = lambda c: F.exists("evidence", lambda x: (x["path"] == cited(c)[0]) & (x["lines"] == cited(c)[1]))
    gold = F.coalesce("expected_answer", F.lit(""))
    longer, shorter = F.greatest(F.length(r), F.length(gold)), F.greatest(F.least(F.length(r), F.length(gold)), F.lit(1))
    apart = (F.size("citation_paths") > 0) & (F.size("citations") > 0) & ~F.arrays_overlap("citation_paths", "citations")
    every = findings(
        both,
        [
            ("FAIL", "answer_required", ~ok),
            ("FAIL", "confidence_unknown", ok & F.coalesce(~F.col("confidence").isin(*CONFIDENCES), F.lit(True))),
            ("FAIL", "citation_malformed", cites, lambda c, i: ~c.contains(":")),
            ("FAIL", "citation_not_curated", cites, lambda c, i: c.contains(":") & (F.size("evidence") > 0) & ~inside(c)),
            ("FAIL", "answerable_but_refused", ok & (F.col("answerability") == "answerable") & is_refusal(r)),
            ("FAIL", "unanswerable_but_answered", ok & (F.col("answerability") == MISSING) & ~is_refusal(r)),
            ("WARN", "confident_on_unanswerable", ok & F.col("answerability").startswith("unanswerable") & (F.col("confidence") == "high")),
            ("WARN", "length_differs", ok & (gold != "") & (longer / shorter > 3)),
            ("WARN", "citations_disjoint", ok & (gold != "") & apart),
        ],
    )
    return every.unionByName(missing_cases(curated, verifier))


def verifier_status(rows: DataFrame) -> DataFrame:
    """(case_id, status) of (case_id, answerability, rederived_answer, confidence, citations, keys): not_run, cite_fabricated,
    disagrees, confidence_mismatch or agrees, the first that holds. ``keys`` are the path:lines of the evidence."""
    r = F.coalesce("rederived_answer", F.lit(""))
    invented = F.exists("citations", lambda c: c.contains(":") & ~F.array_contains("keys", c))
    status = (
        F.when(r == "", "not_run")
        .when(F.coalesce(invented, F.lit(False)), "cite_fabricated")
        .when(((F.col("answerability") == "answerable") & is_refusal(r)) | ((F.col("answerability") == MISSING) & ~is_refusal(r)), "disagrees")
        .when(F.col("answerability").startswith("unanswerable") & (F.col("confidence") == "high"), "confidence_mismatch")
        .otherwise("agrees")
    )
    return rows.select("case_id", status.alias("status"))


def anchored_share(rows: DataFrame, most: float = 0.35, least_rows: int = 3) -> DataFrame:
    """One row: rows, share whose query names an evidence file or that may, and whether that is too much."""
    anchored = F.array_contains("tags", "file_anchor_required") | mentions_file(F.col("query"), F.col("evidence"))
    out = rows.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.avg(anchored.cast("int")), F.lit(0.0)).alias("share"))
    return out.withColumn("too_many", (F.col("rows") >= least_rows) & (F.col("share") > most))


def coverage(rows: DataFrame, dimensions: list[str]) -> DataFrame:
    """(dimension, value, n) over each dimension by itself."""
    own = F.array(*[F.struct(F.lit(d).alias("dimension"), F.coalesce(F.col(d).cast("string"), F.lit("<missing>")).alias("value")) for d in dimensions])
    return rows.select(F.explode(own).alias("x")).groupBy("x.dimension", "x.value").agg(F.count(F.lit(1)).alias("n"))


def attribute_counts(rows: DataFrame) -> DataFrame:
    return axis_attributes(rows).groupBy("attribute").agg(F.count(F.lit(1)).alias("n"))


def evidence_reuse(rows: DataFrame, order: str, most: int = 3) -> DataFrame:
    """(path, lines, n, first_case): spans that more evidence items cite than ``most``, with their first row by ``order``."""
    each = rows.select(F.col(order).alias("at"), "case_id", F.explode("evidence").alias("x")).where("x.path <> ''")
    found = each.groupBy("x.path", "x.lines").agg(F.count(F.lit(1)).alias("n"), F.min_by("case_id", "at").alias("first_case"))
    return found.where(F.col("n") > most)


def stamped(rows: DataFrame, signals: DataFrame) -> DataFrame:
    """(case_id, axis2, axis3, claims): difficulty from all signals (signal_id, axis, attribute, source_id, path) on a row's
    sources or paths; attributes sorted, claims as attribute and sorted signals."""
    each = rows.select("case_id", F.explode("evidence").alias("x")).select("case_id", "x.source_id", "x.path")
    s = signals.where("axis in (2, 3) and attribute <> ''")
    by_source = each.where("source_id <> ''").select("case_id", "source_id").distinct().join(s, "source_id").select("case_id", "signal_id", "axis", "attribute")
    by_path = each.where("path <> ''").select("case_id", "path").distinct().join(s, "path").select("case_id", "signal_id", "axis", "attribute")
    hits = by_source.unionByName(by_path).distinct()
    per = hits.groupBy("case_id", "axis", "attribute").agg(F.array_sort(F.collect_set("signal_id")).alias("signals"))
    axis = lambda n: F.array_sort(F.collect_set(F.when(F.col("axis") == n, F.col("attribute")))).alias(f"axis{n}")
    made = per.groupBy("case_id").agg(axis(2), axis(3), F.array_sort(F.collect_list(F.struct("attribute", "signals"))).alias("claims"))
    none = F.array().cast("array<string>")
    return rows.select("case_id").join(made, "case_id", "left").select("case_id", F.coalesce("axis2", none).alias("axis2"), F.coalesce("axis3", none).alias("axis3"), F.coalesce("claims", F.array().cast("array<struct<attribute:string,signals:array<string>>>")).alias("claims"))
