"""Queries of evaluation rows: gates, validators, scores, baselines, selection."""

from __future__ import annotations

from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import assembly, corpora, evaluation, gates
from .plans import adapters as A
from .plans import rows as R
from .registry import query

_NONE = "CAST([] AS VARCHAR[])"


def _rows_sql(body: str, *more: str) -> str:
    return A.sql(body, "ev", "bench", *more)


def _in(values: tuple) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _has(text: str, values: tuple) -> str:
    return "(" + " OR ".join(f"contains({text}, '{v}')" for v in values) + ")"


_BLANK = "trim(regexp_replace(coalesce({}, ''), '\\s+', ' ', 'g')) = ''"


def _blank(c: str) -> str:
    return _BLANK.format(c)


# ---- gates ----------------------------------------------------------------------------------------------------------


@query("axis_attributes", _rows_sql("SELECT case_id, 2 AS axis, unnest(axis2) AS attribute FROM bench WHERE has_difficulty UNION ALL SELECT case_id, 3, unnest(axis3) FROM bench WHERE has_difficulty"))
def axis_attributes(spark, d):
    return gates.axis_attributes(R.bench(spark, d))


_ATTRS = f"CASE WHEN has_difficulty THEN list_concat(axis2, axis3) ELSE {_NONE} END"
_SOURCES = "len(list_distinct(list_filter(list_transform(evidence, lambda x: x.source_id), lambda s: s <> '')))"
_ROLE = f"len(list_filter(evidence, lambda x: x.role IN {_in(gates.CONDITION_ROLES)})) > 0"
_FEW = f"len(list_distinct(list_concat(attrs, CASE WHEN layer = 'L3' THEN ['L3'] ELSE {_NONE} END))) < 2"
_NAMED = "((x.path <> '' AND contains(query, x.path)) OR (contains(regexp_extract(x.path, '[^/]*$'), '.') AND contains(query, regexp_extract(x.path, '[^/]*$'))))"


def _code(condition: str, code: str) -> str:
    return f"CASE WHEN {condition} THEN ['{code}'] ELSE {_NONE} END"


def _all(*lists: str) -> str:
    out = lists[0]
    for x in lists[1:]:
        out = f"list_concat({out}, {x})"
    return out


def _shared(few: str, exempt: str) -> list[str]:
    bad = f"len(list_filter(claims, lambda c: c.attribute = a AND len(c.signals) > 0)) = 0{exempt}"
    return [
        _code("NOT has_difficulty", "MISSING_DIFFICULTY"),
        _code("has_difficulty AND axis1_layer <> layer", "DIFFICULTY_LAYER_MISMATCH"),
        _code("has_difficulty AND claims IS NULL", "MISSING_CLAIM_SOURCES"),
        f"CASE WHEN has_difficulty AND claims IS NOT NULL THEN list_transform(list_filter(attrs, lambda a: {bad}), lambda a: 'MISSING_CLAIM_SOURCE_ATTRIBUTE') ELSE {_NONE} END",
        _code(few, "INSUFFICIENT_DIFFICULTY_SIGNALS"),
        _code(f"layer = 'L2' AND {_SOURCES} < 2", "L2_SINGLE_SOURCE"),
        _code(f"layer = 'L3' AND {_SOURCES} < 2", "L3_SINGLE_SOURCE"),
        _code("layer = 'L3' AND len(list_filter(atoms, lambda x: len(x.depends_on) > 0)) = 0", "L3_NO_ATOM_CHAIN"),
        _code(f"list_contains(attrs, 'conditional_behavior') AND NOT {_ROLE}", "CONDITIONAL_BEHAVIOR_WITHOUT_ROLE"),
    ]


_VALIDATOR = _all(
    *_shared(_FEW, ""),
    _code("(answer_type IN ('yes_no', 'fact_check') OR answerability = 'unanswerable_false_premise' OR list_contains(attrs, 'false_premise')) AND len(forbidden) = 0", "FORBIDDEN_ATOMS_REQUIRED"),
    _code(f"NOT list_contains(tags, 'file_anchor_required') AND len(list_filter(evidence, lambda x: {_NAMED})) > 0", "FILE_ANCHOR_LEAK"),
)


@query("validator_gate", _rows_sql(f"""WITH a AS (SELECT *, {_ATTRS} AS attrs FROM bench), c AS (SELECT case_id, {_VALIDATOR} AS codes FROM a),
each AS (SELECT case_id, project, axis2, axis3, unnest(claims) AS c FROM bench WHERE has_difficulty AND claims IS NOT NULL),
named AS (SELECT case_id, project, axis, c.attribute AS attribute, unnest(c.signals) AS signal_id FROM (SELECT *, 2 AS axis FROM each WHERE list_contains(axis2, c.attribute) UNION ALL SELECT *, 3 FROM each WHERE list_contains(axis3, c.attribute))),
more AS (SELECT case_id, list(code ORDER BY code) AS more FROM (SELECT n.case_id, CASE WHEN s.signal_id IS NULL THEN 'UNKNOWN_CLAIM_SOURCE_SIGNAL' WHEN s.project <> n.project OR s.axis <> n.axis OR s.attribute <> n.attribute THEN 'CLAIM_SOURCE_SIGNAL_MISMATCH' END AS code FROM named n LEFT JOIN row_signals s USING (signal_id)) WHERE code IS NOT NULL GROUP BY 1)
SELECT case_id, array_to_string(list_concat(codes, coalesce(more, {_NONE})), ',') AS codes, len(codes) + len(coalesce(more, {_NONE})) = 0 AS passed FROM c LEFT JOIN more USING (case_id)""", "row_signals"))
def validator_gate(spark, d):
    return gates.validator_gate(R.bench(spark, d), R.signals(spark, d))


_PARTS = "list_distinct(list_filter(regexp_split_to_array(lower({}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) >= 3))"
_STEM = "regexp_replace(regexp_extract(x.path, '[^/]*$'), '^(.+)\\.[^.]*$', '\\1')"
_SHOWN = "regexp_replace(regexp_replace({}, '^这些行显示：', ''), '^\\s+|\\s+$', '', 'g')"
_BODY = _SHOWN.format("x.statement")
_RULED = f"list_filter(list_transform(string_split({_BODY}, ' / '), lambda p: trim(p, ' ')), lambda p: p <> '')"
_BOILER = f"({_BODY} = '' OR {_BODY} = '(blank lines)' OR {_has(_BODY, gates.BOILERPLATE)} OR (len(list_filter({_RULED}, lambda p: regexp_full_match(p, '[=-]+'))) > 0 AND len(list_filter({_RULED}, lambda p: regexp_full_match(p, '[=-]+'))) >= len({_RULED}) - 1 AND list_sum(list_transform({_RULED}, lambda p: length(p))) < 80))"
_POINTER_SQL = "^[0-9A-Za-z_./@+-]+:[0-9]+(-[0-9]+)?\\s*显示："
_BODIES = f"list_filter(list_transform(evidence, lambda x: {_BODY}), lambda b: b <> '')"
_REASONS = f"list_transform(list_filter(atoms, lambda a: a.role = 'reasoning'), lambda a: trim(regexp_replace(trim(a.statement), '{_POINTER_SQL}', '')))"
_GUARD_SQL = gates.GUARD_TOKENS.replace("'", "''")
_GENERATOR = _all(
    *_shared(f"CASE WHEN answerability = 'unanswerable_missing_evidence' THEN attrs <> ['negative_evidence'] ELSE {_FEW} END", " AND NOT (a = 'negative_evidence' AND answerability = 'unanswerable_missing_evidence')"),
    _code("(answer_type IN ('yes_no', 'fact_check') OR starts_with(answerability, 'unanswerable') OR list_contains(attrs, 'false_premise')) AND len(forbidden) = 0", "FORBIDDEN_ATOMS_REQUIRED"),
    _code(f"NOT list_contains(tags, 'file_anchor_required') AND len(list_filter(evidence, lambda x: x.path <> '' AND ({_NAMED} OR len(list_intersect({_PARTS.format(_STEM)}, {_PARTS.format('query')})) >= 2))) > 0", "FILE_ANCHOR_LEAK"),
    _code(f"starts_with(answerability, 'unanswerable') AND {_has('query', gates.REFUSAL_LEAKS)}", "UNANSWERABLE_REFUSAL_LEAK"),
    _code(f"len(list_filter(evidence, lambda x: {_BOILER})) > 0", "BOILERPLATE_EVIDENCE"),
    _code(f"len(list_filter(atoms, lambda x: regexp_matches(trim(x.statement), '{_POINTER_SQL}'))) > 0", "POINTER_STYLE_ATOM"),
    _code(f"has_difficulty AND list_contains(axis3, 'implicit_domain_knowledge') AND len({_BODIES}) > 0 AND len(list_filter({_REASONS}, lambda s: s <> '' AND len(list_filter({_BODIES}, lambda b: contains(b, s))) = 0)) = 0", "IMPLICIT_DK_VERBATIM_REASONING"),
)


@query("generator_gate", _rows_sql(f"""WITH a AS (SELECT *, {_ATTRS} AS attrs FROM bench), c AS (SELECT case_id, {_GENERATOR} AS codes,
  CASE WHEN list_contains(attrs, 'conditional_behavior') AND {_ROLE} AND len(list_filter(evidence, lambda x: regexp_matches(x.statement, '{_GUARD_SQL}'))) = 0 THEN 'CONDITIONAL_BEHAVIOR_NO_GUARD_TOKENS' ELSE '' END AS warns FROM a)
SELECT case_id, array_to_string(codes, ',') AS codes, warns, len(codes) = 0 AS passed FROM c"""))
def generator_gate(spark, d):
    return gates.generator_gate(R.bench(spark, d))


def _findings_sql(source: str, *rules: tuple, more: str = "") -> str:
    """A union of the rules' findings over ``source``; a rule is (severity, name, condition) or (severity, name, list, condition
    of x at place i from 1)."""
    parts = []
    for severity, rule, *rest in rules:
        if len(rest) == 1:
            parts.append(f"SELECT case_id, '{severity}' AS severity, '{rule}' AS rule, CAST(NULL AS INT) AS position FROM {source} WHERE {rest[0]}")
        else:
            hit = f"list_filter(list_transform({rest[0]}, lambda x, i: CASE WHEN {rest[1]} THEN i - 1 END), lambda n: n IS NOT NULL)"
            parts.append(f"SELECT case_id, '{severity}' AS severity, '{rule}' AS rule, CAST(unnest({hit}) AS INT) AS position FROM {source}")
    return " UNION ALL ".join(parts) + more


@query("row_findings", _rows_sql(_findings_sql("bench", ("FAIL", "project_required", _blank("project")), ("WARN", "answer_type_not_standard", f"answer_type NOT IN {_in(gates.ANSWER_TYPES)}"), ("FAIL", "answerability_unknown", f"answerability NOT IN {_in(gates.ANSWERABILITY)}"))))
def row_findings(spark, d):
    return gates.row_findings(R.bench(spark, d))


_TOKENS = "regexp_extract_all({}, '[A-Za-z_][A-Za-z0-9_:.>\\\\/-]*')"
_BOTH = f"NOT ({_blank('query')}) AND NOT ({_blank('query_rewrite')})"


@query("rewrite_findings", _rows_sql(_findings_sql(
    "bench",
    ("FAIL", "query_required", _blank("query")),
    ("FAIL", "rewrite_required", f"NOT ({_blank('query')}) AND {_blank('query_rewrite')}"),
    ("WARN", "rewrite_repeats_chatty_query", f"{_BOTH} AND trim(query) = trim(query_rewrite) AND {_has('query', gates.CHATTY)}"),
    ("FAIL", "rewrite_hidden_context", f"CASE WHEN {_BOTH} THEN [{_in(gates.REWRITE_FORBIDDEN)[1:-1]}] END", "contains(query_rewrite, x)"),
    ("WARN", "rewrite_new_token", f"CASE WHEN {_BOTH} THEN {_TOKENS.format('query_rewrite')} END", f"length(x) >= 4 AND NOT list_contains({_TOKENS.format('query')}, x) AND ((upper(x) = x AND lower(x) <> x) OR contains(x, '_') OR contains(x, '::') OR contains(x, '.'))"),
)))
def rewrite_findings(spark, d):
    return gates.rewrite_findings(R.bench(spark, d))


_OPENING = "regexp_split_to_array(trim({}), '[。.!?？]')[1]"
_ASKS = _has("lower(query)", evaluation.CITATION_TRIGGERS)


@query("expected_answers", _rows_sql(_findings_sql(
    "bench",
    ("FAIL", "answer_required", _blank("expected_answer")),
    ("FAIL", "answer_rubric_like", f"NOT ({_blank('expected_answer')}) AND {_has('expected_answer', gates.RUBRIC_LIKE)}"),
    ("WARN", "answer_short", f"NOT ({_blank('expected_answer')}) AND length(trim(expected_answer)) < 40"),
    ("WARN", "answer_not_direct", f"NOT ({_blank('expected_answer')}) AND answer_type = 'yes_no' AND NOT {_has(_OPENING.format('expected_answer'), gates.DIRECT)}"),
    ("FAIL", "answer_without_citation", f"NOT ({_blank('expected_answer')}) AND (coalesce(required, 'when_query_requests_evidence') = 'always' OR (coalesce(required, 'when_query_requests_evidence') = 'when_query_requests_evidence' AND {_ASKS})) AND NOT regexp_matches(expected_answer, '[0-9A-Za-z_./@+-]+:[0-9]+(-[0-9]+)?')"),
)))
def expected_answers(spark, d):
    return gates.answer_findings(R.bench(spark, d))


_AGAIN = "list_contains(list_transform({0}[1:i - 1], lambda z: z.{1}), x.{1})"
_START, _END = "TRY_CAST(regexp_extract(x.lines, '^([0-9]+)(-([0-9]+))?$', 1) AS BIGINT)", "coalesce(TRY_CAST(regexp_extract(x.lines, '^([0-9]+)(-([0-9]+))?$', 3) AS BIGINT), TRY_CAST(regexp_extract(x.lines, '^([0-9]+)(-([0-9]+))?$', 1) AS BIGINT))"
_SPAN_OK = f"coalesce({_START} > 0 AND {_END} >= {_START}, FALSE)"
_COUNT = "counts[x.source_id]"


@query("evidence_findings", _rows_sql("WITH m AS (SELECT map(list(source_id), list(line_count)) AS counts FROM row_sources), own AS (SELECT * FROM bench, m) " + _findings_sql(
    "own",
    ("FAIL", "references_required", "len(refs) = 0 AND answerability <> 'unanswerable_missing_evidence'"),
    ("FAIL", "reference_unnamed", "refs", "x.source_id = '' AND x.path = ''"),
    ("FAIL", "evidence_required", "len(evidence) = 0 AND answerability <> 'unanswerable_missing_evidence'"),
    ("FAIL", "evidence_source_id_required", "evidence", "x.source_id = ''"),
    ("FAIL", "evidence_source_unknown", "evidence", f"x.source_id <> '' AND {_COUNT} IS NULL"),
    ("WARN", "evidence_not_referenced", "evidence", "NOT list_contains(list_transform(refs, lambda r: r.path), x.path) AND NOT (x.source_id <> '' AND list_contains(list_transform(refs, lambda r: r.source_id), x.source_id))"),
    ("FAIL", "evidence_lines_malformed", "evidence", f"x.lines <> '' AND NOT {_SPAN_OK}"),
    ("FAIL", "evidence_lines_beyond_end", "evidence", f"{_COUNT} > 0 AND {_SPAN_OK} AND {_END} > {_COUNT}"),
), "row_sources"))
def evidence_findings(spark, d):
    return gates.evidence_findings(R.bench(spark, d), R.sources(spark, d))


def _atom_sql(severity: str, where: str = "TRUE") -> list[tuple]:
    ids, atoms = "list_transform(evidence, lambda e: e.evidence_id)", f"CASE WHEN {where} THEN atoms END"
    return [
        ("FAIL", "atoms_required", f"{where} AND len(atoms) = 0"),
        ("FAIL", "atom_id_required", atoms, "x.id = ''"),
        ("FAIL", "atom_id_repeated", atoms, f"x.id <> '' AND {_AGAIN.format('atoms', 'id')}"),
        (severity, "atom_role_unknown", atoms, f"x.role NOT IN {_in(gates.ATOM_ROLES)}"),
        (severity, "atom_match_type_unknown", atoms, f"x.match_type NOT IN {_in(gates.MATCH_TYPES)}"),
        ("FAIL", "atom_statement_required", atoms, _blank("x.statement")),
        ("FAIL", "atom_weight_not_positive", atoms, "x.weight <= 0"),
        ("FAIL", "atom_evidence_unknown", atoms, f"len(list_filter(x.evidence_ids, lambda n: NOT list_contains({ids}, n))) > 0"),
        ("FAIL", "no_conclusion_atom", f"{where} AND len(list_filter(atoms, lambda x: x.role = 'conclusion')) = 0"),
    ]


@query("rubric_findings", _rows_sql(_findings_sql(
    "bench",
    *_atom_sql("WARN"),
    ("FAIL", "forbidden_incomplete", "forbidden", "x.id = '' OR x.statement = ''"),
    ("WARN", "forbidden_match_type", "forbidden", "x.match_type <> 'semantic_contradiction'"),
    ("WARN", "forbidden_severity", "forbidden", f"x.severity NOT IN {_in(gates.SEVERITIES)}"),
    ("WARN", "policy_required_not_standard", "required IS NULL"),
    ("FAIL", "policy_evidence_unknown", "required_ids", "NOT list_contains(list_transform(evidence, lambda e: e.evidence_id), x)"),
)))
def rubric_findings(spark, d):
    return gates.rubric_findings(R.bench(spark, d))


@query("anchored_share", _rows_sql(f"SELECT count(*) AS rows, round(avg(CAST(hit AS INT)), 6) AS share, count(*) >= 3 AND avg(CAST(hit AS INT)) > 0.35 AS too_many FROM (SELECT list_contains(tags, 'file_anchor_required') OR len(list_filter(evidence, lambda x: {_NAMED})) > 0 AS hit FROM bench)"))
def anchored_share(spark, d):
    return gates.anchored_share(R.bench(spark, d)).withColumn("share", F.round("share", 6))


@query("row_coverage", _rows_sql("SELECT dimension, value, count(*) AS n FROM (SELECT 'project' AS dimension, project AS value FROM bench UNION ALL SELECT 'layer', layer FROM bench UNION ALL SELECT 'answer_type', answer_type FROM bench UNION ALL SELECT 'answerability', answerability FROM bench) GROUP BY ALL"))
def row_coverage(spark, d):
    return gates.coverage(R.bench(spark, d), ["project", "layer", "answer_type", "answerability"])


@query("attribute_counts", _rows_sql("SELECT attribute, count(*) AS n FROM (SELECT unnest(list_concat(axis2, axis3)) AS attribute FROM bench WHERE has_difficulty) GROUP BY 1"))
def attribute_counts(spark, d):
    return gates.attribute_counts(R.bench(spark, d))


@query("corpus_reuse", _rows_sql("SELECT e.path AS path, e.lines AS lines, count(*) AS n, arg_min(case_id, k) AS first_case FROM (SELECT k, case_id, unnest(evidence) AS e FROM bench) WHERE e.path <> '' GROUP BY 1, 2 HAVING count(*) > 3"))
def corpus_reuse(spark, d):
    return gates.evidence_reuse(R.bench(spark, d), "k")


@query("stamped_rows", _rows_sql(f"""WITH s AS (SELECT signal_id, axis, attribute, 'src_' || (CAST(substr(signal_id, 5) AS INT) % 50) AS source_id, 'src/core_unit_' || (CAST(substr(signal_id, 5) AS INT) % 20) || '.sv' AS path FROM row_signals),
e AS (SELECT DISTINCT case_id, x.source_id AS source_id, x.path AS path FROM (SELECT case_id, unnest(evidence) AS x FROM bench)),
h AS (SELECT DISTINCT case_id, signal_id, axis, attribute FROM e JOIN s ON (e.source_id <> '' AND e.source_id = s.source_id) OR (e.path <> '' AND e.path = s.path)),
a AS (SELECT case_id, axis, attribute, string_agg(signal_id, '+' ORDER BY signal_id) AS ids FROM h GROUP BY ALL),
c AS (SELECT case_id, string_agg(attribute, ',' ORDER BY attribute) FILTER (axis = 2) AS a2, string_agg(attribute, ',' ORDER BY attribute) FILTER (axis = 3) AS a3, string_agg(attribute || ':' || ids, ',' ORDER BY attribute, ids) AS claims FROM a GROUP BY 1)
SELECT case_id, coalesce(a2, '') AS axis2, coalesce(a3, '') AS axis3, coalesce(c.claims, '') AS claims FROM bench LEFT JOIN c USING (case_id)""", "row_signals"))
def stamped_rows(spark, d):
    n = F.substring("signal_id", 5, 10).cast("int")
    s = R.signals(spark, d).select("signal_id", "axis", "attribute", F.concat(F.lit("src_"), (n % 50).cast("string")).alias("source_id"), F.concat(F.lit("src/core_unit_"), (n % 20).cast("string"), F.lit(".sv")).alias("path"))
    out = gates.stamped(R.bench(spark, d), s)
    claims = F.transform("claims", lambda c: F.concat(c["attribute"], F.lit(":"), F.array_join(c["signals"], "+")))
    return out.select("case_id", F.array_join("axis2", ",").alias("axis2"), F.array_join("axis3", ",").alias("axis3"), F.array_join(claims, ",").alias("claims"))


# ---- citations, atoms, verdicts -------------------------------------------------------------------------------------

_CHOSEN = "list_filter(evidence, lambda x: len(required_ids) = 0 OR list_contains(required_ids, x.evidence_id))"
_TOLD = "(x.path <> '' AND contains(expected_answer, x.path))"
_CITED = f"len(list_filter(cited, lambda c: c.path = x.path AND {_SPAN_OK} AND greatest({_START}, c.a) <= least({_END}, c.b) AND c.a > 0 AND c.b >= c.a)) > 0"
_CITE_LIST = "list_transform(regexp_extract_all(expected_answer, '[A-Za-z0-9_./@+-]+:[0-9]+(-[0-9]+)?'), lambda t: {'path': regexp_extract(t, '^(.*):', 1), 'a': CAST(regexp_extract(t, ':([0-9]+)(-[0-9]+)?$', 1) AS BIGINT), 'b': coalesce(TRY_CAST(regexp_extract(t, '-([0-9]+)$', 1) AS BIGINT), CAST(regexp_extract(t, ':([0-9]+)(-[0-9]+)?$', 1) AS BIGINT))})"
_GRAIN = "CASE granularity WHEN 'source_only' THEN (x.source_id <> '' AND contains(expected_answer, x.source_id)) OR " + _TOLD + " WHEN 'path_only' THEN " + _TOLD + " ELSE {} END"


def _answers(spark, d):
    own = R.bench(spark, d)
    items = own.select("case_id", F.explode("evidence").alias("x")).select("case_id", "x.*")
    return own.select("case_id", "query", F.col("expected_answer").alias("answer"), "required", "granularity", "required_ids"), items


_FIRST = f"SELECT case_id, coalesce(required, 'always') = 'never' OR (len(ch) > 0 AND len(list_filter(ch, lambda x: NOT ({_GRAIN.format(_CITED)}))) = 0) AS citation_pass FROM (SELECT *, {_CHOSEN} AS ch, {_CITE_LIST} AS cited FROM bench)"
_EXACT = "contains(expected_answer, x.path || ':' || x.lines)"
_SECOND = f"SELECT case_id, NOT (coalesce(required, 'when_query_requests_evidence') = 'always' OR (coalesce(required, 'when_query_requests_evidence') = 'when_query_requests_evidence' AND {_ASKS})) OR (len(ch) > 0 AND len(list_filter(ch, lambda x: NOT ({_GRAIN.format(_EXACT)}))) = 0) AS citation_pass FROM (SELECT *, {_CHOSEN} AS ch FROM bench)"


@query("citation_pass", _rows_sql(_FIRST))
def citation_pass(spark, d):
    return evaluation.citation_pass(*_answers(spark, d))


@query("citation_pass_exact", _rows_sql(_SECOND))
def citation_pass_exact(spark, d):
    return evaluation.citation_pass(*_answers(spark, d), exact=True)


def _sig(text: str) -> str:
    han = "regexp_extract_all(" + text + ", '[一-鿿]+')"
    pairs = f"flatten(list_transform({han}, lambda r: list_transform(range(1, greatest(length(r), 2)), lambda p: substr(r, p, 2))))"
    return f"list_distinct(list_concat(list_filter(regexp_extract_all(lower({text}), '[a-z_][a-z0-9_:.>\\\\/-]*'), lambda t: length(t) >= 3), {pairs}))"


def _lexical(want: str, text: str, threshold: float) -> str:
    w, h = _sig(want), _sig(text)
    return f"(len({w}) > 0 AND len({h}) > 0 AND len(list_filter({w}, lambda t: regexp_matches(t, '[_./]') AND NOT list_contains({h}, t))) = 0 AND len(list_intersect({w}, {h})) / len({w}) >= {threshold})"


_ATOMS = f"""said AS (SELECT *, 'claims that ' || coalesce(evidence[1].path, '') || ' holds, denies ' || k || ' ' || expected_answer AS answer FROM bench),
req AS (SELECT case_id, x.role AS role, CASE WHEN x.weight > 0 THEN x.weight ELSE 1 END AS weight, {_lexical('x.statement', 'answer', 0.35)} AS hit FROM (SELECT case_id, answer, unnest(atoms) AS x FROM said)),
forb AS (SELECT case_id, x.severity AS severity, {_lexical('x.statement', 'answer', 0.65)} AS hit FROM (SELECT case_id, answer, unnest(forbidden) AS x FROM said)),
scored AS (SELECT case_id, coalesce(sum(weight) FILTER (hit), 0) / sum(weight) AS coverage, coalesce(bool_and(hit) FILTER (role = 'conclusion'), FALSE) AS conclusion_ok FROM req GROUP BY 1),
fatal AS (SELECT case_id, bool_or(hit AND severity = 'fatal') AS fatal FROM forb GROUP BY 1),
atoms_of AS (SELECT coalesce(s.case_id, f.case_id) AS case_id, coalesce(coverage, 0) AS coverage, coalesce(conclusion_ok, FALSE) AS conclusion_ok, coalesce(fatal, FALSE) AS fatal FROM scored s FULL JOIN fatal f ON s.case_id = f.case_id)"""


def _atoms_of(spark, d):
    own = R.bench(spark, d)
    fields = lambda x, forbidden: F.struct(x["id"].alias("atom_id"), x["statement"].alias("statement"), (x["role"] if not forbidden else F.lit(None).cast("string")).alias("role"), (x["weight"] if not forbidden else F.lit(None).cast("double")).alias("weight"), F.lit(forbidden).alias("forbidden"), (x["severity"] if forbidden else F.lit(None).cast("string")).alias("severity"))
    every = F.concat(F.transform("atoms", lambda a: fields(a, False)), F.transform("forbidden", lambda a: fields(a, True)))
    atoms = own.select("case_id", F.explode(every).alias("x")).select("case_id", "x.*")
    first = F.coalesce(F.get("evidence", F.lit(0))["path"], F.lit(""))
    answers = own.select("case_id", F.concat(F.lit("claims that "), first, F.lit(" holds, denies "), F.col("k").cast("string"), F.lit(" "), F.col("expected_answer")).alias("answer"))
    return evaluation.atom_coverage(atoms, answers)


@query("atom_coverage", _rows_sql(f"WITH {_ATOMS} SELECT case_id, round(coverage, 6) AS coverage, conclusion_ok, fatal FROM atoms_of"))
def atom_coverage(spark, d):
    return _atoms_of(spark, d).withColumn("coverage", F.round("coverage", 6))


@query("case_verdicts", _rows_sql(f"""WITH {_ATOMS}, cp AS ({_SECOND}), r AS (SELECT case_id, k % 3 / 2.0 AS evidence_recall FROM bench)
SELECT case_id, CASE WHEN evidence_recall = 1 AND conclusion_ok AND coverage >= 0.8 AND NOT fatal AND citation_pass THEN 'PASS' WHEN evidence_recall = 0 OR fatal THEN 'FAIL' ELSE 'WARN' END AS verdict FROM atoms_of JOIN cp USING (case_id) JOIN r USING (case_id)"""))
def case_verdicts(spark, d):
    recall = R.bench(spark, d).select("case_id", (F.col("k") % 3 / 2.0).alias("evidence_recall"))
    both = _atoms_of(spark, d).join(citation_pass_exact(spark, d), "case_id").join(recall, "case_id")
    return evaluation.case_verdict(both).select("case_id", "verdict")


_JUDGE = """judged AS (SELECT event_id AS k, CASE event_id % 6 WHEN 0 THEN '{"score": ' || (event_id % 13) / 10.0 || ', "verdict": " Correct "}' WHEN 1 THEN 'so: {"score": "0.5", "verdict": "PARTIAL"} end' WHEN 2 THEN 'none' WHEN 3 THEN '{"score": "x", "verdict": "fail", "rationale": "r"}' WHEN 4 THEN '{"verdict": "not_run"}' ELSE '{"score": 0.9, "verdict": "yes"}' END AS text FROM events),
cut AS (SELECT k, CASE WHEN json_valid(text) THEN text WHEN json_valid(regexp_extract(text, '(?s)\\{.*\\}')) THEN regexp_extract(text, '(?s)\\{.*\\}') END AS raw FROM judged),
part AS (SELECT k, raw, TRY_CAST(raw->>'$.score' AS DOUBLE) AS s, lower(trim(coalesce(raw->>'$.verdict', ''))) AS v FROM cut),
judgement AS (SELECT k, raw IS NOT NULL AS known, CASE WHEN s IS NOT NULL THEN least(greatest(s, 0.0), 1.0) END AS score, CASE WHEN raw IS NULL THEN NULL WHEN v IN ('correct', 'pass', 'passed', 'yes', 'true') THEN 'correct' WHEN v IN ('partial', 'partially_correct', 'warn') THEN 'partial' WHEN v IN ('incorrect', 'fail', 'failed', 'no', 'false') THEN 'incorrect' WHEN v IN ('not_run', 'error') THEN v ELSE 'unknown' END AS verdict FROM part)"""


def _judged(spark, d):
    k = F.col("event_id")
    text = (
        F.when(k % 6 == 0, F.concat(F.lit('{"score": '), ((k % 13) / 10.0).cast("string"), F.lit(', "verdict": " Correct "}')))
        .when(k % 6 == 1, 'so: {"score": "0.5", "verdict": "PARTIAL"} end')
        .when(k % 6 == 2, "none")
        .when(k % 6 == 3, '{"score": "x", "verdict": "fail", "rationale": "r"}')
        .when(k % 6 == 4, '{"verdict": "not_run"}')
        .otherwise('{"score": 0.9, "verdict": "yes"}')
    )
    own = A.table(spark, d, "events").select(k.alias("k"), "user_id", "event_type", "value", S.judgement(text).alias("j"))
    return own.select("k", "user_id", "event_type", "value", F.col("j").isNotNull().alias("known"), F.col("j.score").alias("score"), F.col("j.verdict").alias("verdict"))


@query("judgements", "WITH " + _JUDGE + " SELECT k, known, score, verdict FROM judgement")
def judgements(spark, d):
    return _judged(spark, d).select("k", "known", "score", "verdict")


_STRICT = _JUDGE + """, results AS (SELECT k, event_type, k % 4 / 3.0 AS evidence_recall, k % 5 / 4.0 AS reference_recall, k % 3 / 2.0 AS evidence_precision, k % 7 / 6.0 AS evidence_f1, k % 2 = 0 AS citation_pass, score, coalesce(verdict, 'error') AS verdict, k % 11 = 0 AS missing, CASE WHEN k % 3 = 0 THEN NULL ELSE k END AS total_tokens FROM judgement JOIN events ON event_id = k),
strict AS (SELECT *, evidence_recall = 1 AS retrieval_pass, coalesce(score >= 0.8 AND verdict = 'correct', FALSE) AS answer_pass, evidence_recall = 1 AND coalesce(score >= 0.8 AND verdict = 'correct', FALSE) AND citation_pass AS strict_pass FROM results)"""


def _strict(spark, d):
    k = F.col("k")
    out = _judged(spark, d).withColumns({"evidence_recall": k % 4 / 3.0, "reference_recall": k % 5 / 4.0, "evidence_precision": k % 3 / 2.0, "evidence_f1": k % 7 / 6.0, "citation_pass": k % 2 == 0, "verdict": F.coalesce("verdict", F.lit("error")), "missing": k % 11 == 0, "total_tokens": F.when(k % 3 == 0, None).otherwise(k)})
    return evaluation.strict(out)


def _rounded(df):
    return df.select(*[F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


@query("strict_results", "WITH " + _STRICT + " SELECT k, retrieval_pass, answer_pass, strict_pass FROM strict")
def strict_results(spark, d):
    return _strict(spark, d).select("k", "retrieval_pass", "answer_pass", "strict_pass")


_RATE = lambda c, n: f"round(avg(CAST({c} AS INT)), 6) AS {n}"


@query("evaluation_summary", "WITH " + _STRICT + " SELECT count(*) AS cases, count(*) FILTER (missing) AS missing_predictions, " + ", ".join(_RATE(c, c + "_rate") for c in ("retrieval_pass", "strict_pass", "answer_pass", "citation_pass")) + ", " + ", ".join(f"round(avg({c}), 6) AS mean_{c}" for c in ("reference_recall", "evidence_recall", "evidence_precision", "evidence_f1")) + ", " + _RATE("score IS NOT NULL", "judge_coverage") + ", round(avg(score), 6) AS mean_score, " + _RATE("total_tokens IS NOT NULL", "token_coverage") + ", CAST(sum(total_tokens) AS BIGINT) AS sum_total_tokens, round(avg(total_tokens), 6) AS mean_total_tokens FROM strict")
def evaluation_summary(spark, d):
    return _rounded(evaluation.full_summary(_strict(spark, d)))


@query("evaluation_slices", "WITH " + _STRICT + ", s AS (SELECT 'event_type' AS dimension, event_type AS value, * EXCLUDE (event_type) FROM strict UNION ALL SELECT 'verdict', verdict, * EXCLUDE (event_type) FROM strict) SELECT dimension, value, count(*) AS cases, " + _RATE("strict_pass", "strict_pass_rate") + ", " + _RATE("retrieval_pass", "retrieval_pass_rate") + ", round(avg(evidence_recall), 6) AS mean_evidence_recall, round(coalesce(avg(score), 0), 6) AS mean_score, round(coalesce(avg(total_tokens), 0), 6) AS mean_total_tokens, " + _RATE("total_tokens IS NOT NULL", "token_coverage") + " FROM s GROUP BY 1, 2")
def evaluation_slices(spark, d):
    own = _strict(spark, d).drop("value")
    return _rounded(evaluation.slices(own, ["event_type", "verdict"], evaluation.slice_measures()))


@query("verdict_counts", "WITH " + _STRICT + " SELECT verdict, count(*) AS n FROM strict GROUP BY 1")
def verdict_counts(spark, d):
    return evaluation.verdict_counts(_strict(spark, d))


@query("error_counts", "SELECT regexp_replace(e, '\\b(sk|ds)-[A-Za-z0-9_-]{8,}\\b', '[redacted]', 'gi') AS error, count(*) AS n FROM (SELECT event_type || ' failed with sk-abcdefgh' || (event_id % 3) AS e FROM events) GROUP BY 1 ORDER BY n DESC, error LIMIT 10")
def error_counts(spark, d):
    return evaluation.error_counts(A.table(spark, d, "events").select(F.concat("event_type", F.lit(" failed with sk-abcdefgh"), (F.col("event_id") % 3).cast("string")).alias("error")))


@query("prediction_problems", "WITH p AS (SELECT l_orderkey AS case_id, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS line FROM lineitem), c AS (SELECT o_orderkey AS case_id FROM orders WHERE o_orderstatus <> 'P') SELECT case_id, line, 'duplicate' AS problem FROM p QUALIFY row_number() OVER (PARTITION BY case_id ORDER BY line) > 1 UNION ALL SELECT case_id, line, 'unknown' FROM p WHERE case_id NOT IN (SELECT case_id FROM c)")
def prediction_problems(spark, d):
    numbered = assembly.ordinals(A.table(spark, d, "lineitem"), "line", "%d", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"])
    preds = numbered.select(F.col("l_orderkey").alias("case_id"), F.col("line").cast("long").alias("line"))
    return evaluation.first_predictions(preds, A.table(spark, d, "orders").where("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("case_id")))[1]


# ---- baselines ------------------------------------------------------------------------------------------------------

_PLAN = "plan AS (SELECT case_id, attribute, unnest(CASE attribute WHEN 'long_tail' THEN ['closed_book_llm'] WHEN 'distracting_info' THEN ['top_1_dense_only'] WHEN 'conditional_behavior' THEN ['top_1_dense_only'] WHEN 'negative_evidence' THEN ['closed_book_llm'] WHEN 'implicit_domain_knowledge' THEN ['oracle_evidence_no_reasoning_llm'] END) AS baseline FROM (SELECT case_id, unnest(list_concat(axis2, axis3)) AS attribute FROM bench))"


def _plan(spark, d):
    return assembly.baseline_plan(R.bench(spark, d).select("case_id", F.concat("axis2", "axis3").alias("attributes")))


@query("baseline_plan", _rows_sql("WITH " + _PLAN + " SELECT * FROM plan"))
def baseline_plan(spark, d):
    return _plan(spark, d)


_OUTCOMES = _PLAN + ", outcomes AS (SELECT *, CASE length(case_id || attribute) % 3 WHEN 0 THEN 'baseline_succeeded' ELSE 'baseline_failed' END AS outcome FROM plan WHERE baseline <> 'oracle_evidence_no_reasoning_llm')"


def _outcomes(spark, d):
    made = F.when(F.length(F.concat("case_id", "attribute")) % 3 == 0, "baseline_succeeded").otherwise("baseline_failed")
    return _plan(spark, d).where("baseline <> 'oracle_evidence_no_reasoning_llm'").withColumn("outcome", made)


@query("adversarial_gate", _rows_sql("WITH " + _OUTCOMES + """, u AS (SELECT case_id, count(*) FILTER (baseline = 'oracle_evidence_no_reasoning_llm') AS untested FROM plan GROUP BY 1),
p AS (SELECT case_id, bool_or(coalesce(ok, FALSE)) AS any_ok FROM (SELECT DISTINCT case_id, attribute FROM plan) LEFT JOIN (SELECT case_id, attribute, bool_and(outcome = 'baseline_failed') AS ok FROM outcomes GROUP BY 1, 2) USING (case_id, attribute) GROUP BY 1)
SELECT case_id, coalesce(untested, 0) = 0 AND coalesce(any_ok, TRUE) AS passed, CASE WHEN any_ok IS NULL THEN 'no_attributes_to_test' WHEN untested > 0 THEN 'untested_baselines' WHEN any_ok THEN 'at_least_one_attribute_confirmed' ELSE 'no_attribute_confirmed' END AS reason, coalesce(untested, 0) AS untested FROM bench LEFT JOIN u USING (case_id) LEFT JOIN p USING (case_id)"""))
def adversarial_gate(spark, d):
    return evaluation.adversarial(_outcomes(spark, d), R.bench(spark, d), _plan(spark, d))


@query("gate_summary", _rows_sql("WITH " + _OUTCOMES + " SELECT baseline, attribute, outcome, count(*) AS n FROM outcomes GROUP BY ALL"))
def gate_summary(spark, d):
    return _outcomes(spark, d).groupBy("baseline", "attribute", "outcome").agg(F.count(F.lit(1)).alias("n"))


def _words(text: str) -> str:
    return f"list_transform(regexp_extract_all({text}, '[A-Za-z_][A-Za-z0-9_]{{2,}}|[一-鿿]{{2,}}'), lambda w: lower(w))"


_OWN = f"list_filter({_words('gold')}, lambda w: w NOT IN {_in(S.ANSWER_STOP)} AND NOT list_contains({_words('query')}, w))"
_REFUSED = _has("lower(answer)", tuple(r.lower() for r in assembly.REFUSALS))


@query("adversarial_outcomes", f"""WITH c AS (SELECT conv_id, max(text) FILTER (turn = 0) AS query, max(text) FILTER (turn = 1) AS answer FROM conversations GROUP BY 1), n AS (SELECT count(*) AS n FROM benchmark),
x AS (SELECT conv_id, coalesce(query, '') AS query, coalesce(answer, '') AS answer, coalesce(b.text, '') AS gold, CASE WHEN conv_id % 4 = 0 THEN 'negative_evidence' ELSE 'long_tail' END AS attribute FROM c, n LEFT JOIN benchmark b ON item_id = conv_id % n)
SELECT conv_id, CASE WHEN {_blank('answer')} THEN 'inconclusive' WHEN {_REFUSED} THEN 'baseline_failed' WHEN attribute = 'negative_evidence' OR len(list_intersect({_OWN}, list_filter({_words('answer')}, lambda w: w NOT IN {_in(S.ANSWER_STOP)}))) > 0 THEN 'baseline_succeeded' ELSE 'inconclusive' END AS outcome FROM x""")
def adversarial_outcomes(spark, d):
    by_turn = lambda n: F.coalesce(F.max(F.when(F.col("turn") == n, F.col("text"))), F.lit(""))
    c = A.table(spark, d, "conversations").groupBy("conv_id").agg(by_turn(0).alias("query"), by_turn(1).alias("answer"))
    b = A.table(spark, d, "benchmark").select("item_id", F.col("text").alias("gold"))
    n = b.agg(F.count(F.lit(1)).alias("n"))  # one row
    both = c.join(F.broadcast(n), F.lit(True)).withColumn("item_id", F.col("conv_id") % F.col("n")).join(b, "item_id", "left")
    attribute = F.when(F.col("conv_id") % 4 == 0, "negative_evidence").otherwise("long_tail")
    return both.select("conv_id", assembly.outcome(F.col("answer"), F.col("query"), F.coalesce("gold", F.lit("")), attribute).alias("outcome"))


_VIEWS = {
    "closed_book_llm": "FALSE",
    "top_1_dense_only": "pos = 1",
    "doc_only_retrieval": "contains(path, 'doc') OR ends_with(path, '.rst') OR ends_with(path, '.md') OR ends_with(path, '.txt')",
    "code_only_retrieval": "NOT (" + " OR ".join(f"contains(path, '{x}')" for x in assembly.NOT_CODE) + ")",
    "single_source_set_retrieval": "source_id = first_value(source_id) OVER (PARTITION BY k ORDER BY pos)",
    "oracle_evidence_llm": "TRUE",
}


@query("evidence_views", A.sql(" UNION ALL ".join(f"SELECT '{b}' AS baseline, 'case_' || k AS case_id, CAST(pos AS INT) AS position, source_id, path, lines FROM (SELECT *, {w} AS keep FROM ev) WHERE keep" for b, w in _VIEWS.items()), "ev"))
def evidence_views(spark, d):
    own = R.evidence(spark, d).select(F.concat(F.lit("case_"), F.col("k").cast("string")).alias("case_id"), F.col("pos").alias("position"), "source_id", "path", "lines")
    out = None
    for b in _VIEWS:
        one = assembly.evidence_view(own, b).select(F.lit(b).alias("baseline"), "case_id", "position", "source_id", "path", "lines")
        out = one if out is None else out.unionByName(one)
    return out


@query("dry_run_gate", _rows_sql("SELECT case_id, attribute, b AS baseline, 'skipped_no_provider' AS status, case_id || ':' || attribute || ':' || b || ':none:dry-run-v1' AS cache_key FROM (SELECT *, CASE attribute WHEN 'long_tail' THEN 'closed_book_llm' WHEN 'negative_evidence' THEN 'closed_book_llm' WHEN 'implicit_domain_knowledge' THEN 'oracle_evidence_no_reasoning_llm' ELSE 'top_1_dense_only' END AS b FROM (SELECT case_id, unnest(list_concat(axis2, axis3)) AS attribute FROM bench WHERE has_difficulty))"))
def dry_run_gate(spark, d):
    return assembly.dry_run_gate(gates.axis_attributes(R.bench(spark, d)))


# ---- stage validators -----------------------------------------------------------------------------------------------


def _stages_sql(body: str, *names: str) -> str:
    return _rows_sql(body, *["s_" + n for n in names])


_DROPPED = "SELECT case_id FROM s_curated JOIN s_candidates USING (case_id) WHERE len(evidence) = 0 AND answerability <> 'unanswerable_missing_evidence'"


def _missing(expected: str, stage: str, dropped: bool = True) -> str:
    return f" UNION ALL SELECT case_id, 'FAIL', 'case_missing', CAST(NULL AS INT) FROM s_{expected} WHERE case_id NOT IN (SELECT case_id FROM s_{stage})" + (f" AND case_id NOT IN ({_DROPPED})" if dropped else "")


_MATCH = "list_filter(spans, lambda c: c.path = x.path AND c.lines = x.lines)[1]"
_QUOTED = f"list_filter(list_transform(evidence, lambda x: coalesce({_MATCH}.raw_snippet, '')), lambda s: s <> '')"
_FULL = "answerability <> 'unanswerable_missing_evidence'"
_DOC = "regexp_matches(lower(x.path), '{}') OR regexp_matches(lower(x.path), '{}')".format(gates.DOC_SUFFIX, gates.DOC_HINT)
_CODE_PATH = "regexp_matches(lower(x.path), '{}') OR (regexp_matches(lower(x.path), '{}') AND NOT ({}))".format(gates.CODE_SUFFIX, gates.CODE_HINT, _DOC)


def _any(items: str, condition: str) -> str:
    return f"len(list_filter({items}, lambda x: {condition})) > 0"


@query("curated_findings", _stages_sql("WITH own AS (SELECT * FROM s_curated JOIN s_candidates USING (case_id)) " + _findings_sql(
    "own",
    ("FAIL", "evidence_source_id_required", "evidence", "x.source_id = ''"),
    ("FAIL", "evidence_not_candidate", "evidence", f"{_MATCH} IS NULL"),
    ("FAIL", "evidence_verbatim", "evidence", f"x.statement <> '' AND {_MATCH}.raw_snippet <> '' AND contains({_MATCH}.raw_snippet, x.statement)"),
    ("FAIL", "missing_evidence_not_empty", f"NOT {_FULL} AND len(evidence) > 0"),
    ("FAIL", "l1_not_single", f"{_FULL} AND layer = 'L1' AND len(evidence) <> 1"),
    ("FAIL", "too_few_sources", f"{_FULL} AND layer IN ('L2', 'L3') AND {_SOURCES} < 2 AND len(evidence) > 0"),
    ("FAIL", "no_guard_token", f"{_FULL} AND list_contains(axis3, 'conditional_behavior') AND len(evidence) > 0 AND len(list_filter({_QUOTED}, lambda s: regexp_matches(s, '{_GUARD_SQL}'))) = 0"),
    ("FAIL", "doc_or_code_missing", f"{_FULL} AND list_contains(axis3, 'doc_code_divergence') AND len(evidence) > 0 AND NOT ({_any('evidence', _DOC)} AND {_any('evidence', _CODE_PATH)})"),
    ("FAIL", "reject_reason_unknown", "rejected", f"x NOT IN {_in(gates.REJECT_REASONS)}"),
), "candidates", "curated"))
def curated_findings(spark, d):
    return gates.curated_findings(R.stage(spark, d, "curated"), R.stage(spark, d, "candidates"))


_IDS = "list_transform(evidence, lambda e: e.evidence_id)"
_USED = f"list_filter(flatten(list_transform(claims, lambda c: c.evidence_ids)), lambda n: list_contains({_IDS}, n))"


@query("claims_findings", _stages_sql("WITH own AS (SELECT * FROM s_claims JOIN s_curated USING (case_id) JOIN s_candidates USING (case_id)) " + _findings_sql(
    "own",
    ("FAIL", "negative_claim_required", f"len(claims) = 0 AND NOT {_FULL}"),
    ("FAIL", "claims_required", f"len(claims) = 0 AND {_FULL} AND len(evidence) > 0"),
    ("FAIL", "claim_id_repeated", "claims", _AGAIN.format("claims", "id")),
    ("FAIL", "claim_text_required", "claims", _blank("x.text")),
    ("WARN", "claim_text_short", "claims", f"NOT ({_blank('x.text')}) AND length(x.text) < 30"),
    ("FAIL", "claim_kind_unknown", "claims", f"x.kind NOT IN {_in(gates.CLAIM_KINDS)}"),
    ("FAIL", "claim_evidence_unknown", "claims", f"len(list_filter(x.evidence_ids, lambda n: NOT list_contains({_IDS}, n))) > 0"),
    ("FAIL", "negative_claim_with_evidence", "claims", f"x.kind = 'negative' AND len(x.evidence_ids) > 0 AND NOT ({_FULL})"),
    ("FAIL", "claim_quotes_statement", "claims", "trim(x.text) <> '' AND len(list_filter(evidence, lambda e: contains(e.statement, x.text))) > 0"),
    ("FAIL", "claim_quotes_snippet", "claims", "trim(x.text) <> '' AND len(list_filter(spans, lambda e: contains(e.raw_snippet, x.text))) > 0"),
    ("FAIL", "claims_not_chained", f"len(claims) > 0 AND layer = 'L3' AND answerability = 'answerable' AND len({_USED}) <= len(list_distinct({_USED}))"),
    ("WARN", "too_many_claims", "len(claims) > 3"),
    more=_missing("curated", "claims"),
), "candidates", "curated", "claims"))
def claims_findings(spark, d):
    return gates.claims_findings(R.stage(spark, d, "claims"), R.stage(spark, d, "curated"), R.stage(spark, d, "candidates"))


_LEAK = f"len(list_intersect({_PARTS.format(_STEM)}, {_PARTS.format('query')}))"


@query("query_findings", _stages_sql("WITH own AS (SELECT * FROM s_queries JOIN s_candidates USING (case_id) JOIN s_curated USING (case_id)) " + _findings_sql(
    "own",
    ("FAIL", "rewrite_required", _blank("query_rewrite")),
    ("FAIL", "query_short", "length(query) < 10"),
    ("FAIL", "query_long", "length(query) > 240"),
    ("FAIL", "style_unknown", f"style NOT IN {_in(gates.STYLES)}"),
    ("WARN", "style_not_as_hinted", "style_hint <> '' AND style <> style_hint"),
    ("FAIL", "query_leaks_file", f"NOT list_contains(tags, 'file_anchor_required') AND {_any('evidence', f'{_LEAK} >= 2 OR ({_LEAK} = 1 AND len({_PARTS.format(_STEM)}) = 1)')}"),
    ("FAIL", "query_telegraphs_refusal", f"starts_with(answerability, 'unanswerable') AND {_has('query', gates.QUERY_CUES)}"),
    ("FAIL", "query_no_question", f"answer_type IN ('yes_no', 'fact_check') AND NOT {_has('query', gates.INTERROGATIVES)}"),
    ("WARN", "colloquial_long", "style_hint = 'colloquial' AND length(query) > 60"),
    ("WARN", "contextual_short", "style_hint = 'contextual' AND length(query) < 25"),
    more=" UNION ALL SELECT NULL, 'WARN', 'query_repeats', CAST(count(*) AS INT) FROM s_queries GROUP BY trim(query) HAVING count(*) >= 3" + _missing("candidates", "queries"),
), "candidates", "curated", "queries"))
def query_findings(spark, d):
    return gates.query_findings(R.stage(spark, d, "queries"), R.stage(spark, d, "candidates"), R.stage(spark, d, "curated"))


_INSIDE = "len(list_filter(evidence, lambda e: e.path = regexp_extract(x, '^(.*):[^:]*$', 1) AND e.lines = regexp_extract(x, '[^:]*$'))) > 0"
_OK = f"NOT ({_blank('expected_answer')})"
_SNIPPET = "list_filter(spans, lambda c: c.path = x.path AND c.lines = x.lines)[1].raw_snippet"


@query("expected_answer_findings", _stages_sql("WITH own AS (SELECT * FROM s_answers JOIN s_curated USING (case_id) JOIN s_candidates USING (case_id)) " + _findings_sql(
    "own",
    ("FAIL", "answer_required", _blank("expected_answer")),
    ("FAIL", "answer_rubric_language", f"CASE WHEN {_OK} THEN [{_in(gates.ANSWER_RUBRIC)[1:-1]}] END", "contains(expected_answer, x)"),
    ("FAIL", "answer_quotation_lead", f"{_OK} AND contains(expected_answer, '这些行显示：')"),
    ("FAIL", "citation_malformed", f"CASE WHEN {_OK} THEN citation_paths END", "NOT contains(x, ':')"),
    ("FAIL", "citation_not_curated", f"CASE WHEN {_OK} THEN citation_paths END", f"contains(x, ':') AND NOT {_INSIDE}"),
    ("FAIL", "citation_not_in_answer", f"CASE WHEN {_OK} THEN citation_paths END", "contains(x, ':') AND NOT contains(expected_answer, '`' || x || '`')"),
    ("FAIL", "missing_evidence_cites", f"{_OK} AND NOT ({_FULL}) AND len(citation_paths) > 0"),
    ("FAIL", "yes_no_opening", f"{_OK} AND answer_type = 'yes_no' AND NOT {_has(_OPENING.format('expected_answer'), gates.YES_NO_OPENINGS)}"),
    ("FAIL", "fact_check_opening", f"{_OK} AND answer_type = 'fact_check' AND NOT {_has(_OPENING.format('expected_answer'), gates.FACT_OPENINGS)}"),
    ("FAIL", "unanswerable_opening", f"{_OK} AND answerability IN ('unanswerable_missing_evidence', 'unanswerable_ambiguous') AND NOT {_has(_OPENING.format('expected_answer'), gates.NEGATIVE_OPENINGS)}"),
    ("FAIL", "answer_quotes_snippet", f"CASE WHEN {_OK} THEN evidence END", f"length({_SNIPPET}) > 30 AND contains(expected_answer, {_SNIPPET})"),
    more=_missing("curated", "answers"),
), "candidates", "curated", "answers"))
def expected_answer_findings(spark, d):
    return gates.expected_answer_findings(R.stage(spark, d, "answers"), R.stage(spark, d, "candidates"), R.stage(spark, d, "curated"))


_BODY_HIT = "trim(x.statement) <> '' AND len(list_filter(evidence, lambda e: contains(e.statement, trim(x.statement)))) > 0"
_TEXT_HIT = "trim(x.statement) <> '' AND len(list_filter(texts, lambda t: contains(t, trim(x.statement)))) > 0"
_NEW = f"len(list_filter(atoms, lambda x: x.role = 'reasoning' AND trim(x.statement) <> '' AND NOT ({_BODY_HIT}) AND NOT ({_TEXT_HIT}))) > 0"


@query("rubric_stage_findings", _stages_sql(f"WITH t AS (SELECT case_id, list_filter(list_transform(claims, lambda c: c.text), lambda x: x <> '') AS texts FROM s_claims), own AS (SELECT r.*, c.evidence, coalesce(texts, {_NONE}) AS texts, layer, answer_type, answerability, axis3 FROM s_rubrics r JOIN s_curated c USING (case_id) JOIN s_candidates USING (case_id) LEFT JOIN t USING (case_id)) " + _findings_sql(
    "own",
    *_atom_sql("FAIL"),
    ("WARN", "too_many_atoms", "len(atoms) > 4"),
    ("FAIL", "atom_is_pointer", "atoms", f"regexp_matches(trim(x.statement), '{_POINTER_SQL}')"),
    ("FAIL", "atom_quotes_statement", "atoms", _BODY_HIT),
    ("FAIL", "atom_quotes_claim", "atoms", _TEXT_HIT),
    ("FAIL", "atom_depends_on_unknown", "atoms", "len(list_filter(x.depends_on, lambda n: NOT list_contains(list_transform(atoms, lambda a: a.id), n))) > 0"),
    ("FAIL", "no_atom_chain", "layer = 'L3' AND answerability = 'answerable' AND len(list_filter(atoms, lambda x: len(x.depends_on) > 0)) = 0"),
    ("FAIL", "forbidden_id_required", "forbidden", "x.id = ''"),
    ("FAIL", "forbidden_statement_required", "forbidden", "x.statement = ''"),
    ("FAIL", "forbidden_generic", "forbidden", f"regexp_matches(trim(x.statement), '{gates.GENERIC_FORBIDDEN}')"),
    ("FAIL", "forbidden_match_type_unknown", "forbidden", f"x.match_type NOT IN {_in(gates.MATCH_TYPES)}"),
    ("FAIL", "forbidden_severity_unknown", "forbidden", f"x.severity NOT IN {_in(gates.SEVERITIES)}"),
    ("FAIL", "forbidden_required", "(answer_type IN ('yes_no', 'fact_check') OR starts_with(answerability, 'unanswerable')) AND len(forbidden) = 0"),
    ("WARN", "no_yes_no_match", "answer_type = 'yes_no' AND len(list_filter(atoms, lambda x: x.match_type = 'semantic_yes_no')) = 0"),
    ("FAIL", "only_quoted_reasoning", f"list_contains(axis3, 'implicit_domain_knowledge') AND NOT ({_NEW})"),
    more=_missing("curated", "rubrics"),
), "candidates", "curated", "claims", "rubrics"))
def rubric_stage_findings(spark, d):
    return gates.rubric_stage_findings(R.stage(spark, d, "rubrics"), R.stage(spark, d, "candidates"), R.stage(spark, d, "curated"), R.stage(spark, d, "claims"))


_RE_OK = f"NOT ({_blank('rederived_answer')})"
_RE_REFUSED = f"({_has('rederived_answer', gates.VERIFIER_REFUSALS)} OR {_has('lower(rederived_answer)', tuple(t.lower() for t in gates.VERIFIER_REFUSALS_ANY_CASE))})"


@query("verifier_findings", _stages_sql("WITH own AS (SELECT * FROM s_verifier JOIN s_curated USING (case_id) JOIN s_candidates USING (case_id) LEFT JOIN s_answers USING (case_id)) " + _findings_sql(
    "own",
    ("FAIL", "answer_required", _blank("rederived_answer")),
    ("FAIL", "confidence_unknown", f"{_RE_OK} AND confidence NOT IN {_in(gates.CONFIDENCES)}"),
    ("FAIL", "citation_malformed", f"CASE WHEN {_RE_OK} THEN citations END", "NOT contains(x, ':')"),
    ("FAIL", "citation_not_curated", f"CASE WHEN {_RE_OK} THEN citations END", f"contains(x, ':') AND len(evidence) > 0 AND NOT {_INSIDE}"),
    ("FAIL", "answerable_but_refused", f"{_RE_OK} AND answerability = 'answerable' AND {_RE_REFUSED}"),
    ("FAIL", "unanswerable_but_answered", f"{_RE_OK} AND NOT ({_FULL}) AND NOT {_RE_REFUSED}"),
    ("WARN", "confident_on_unanswerable", f"{_RE_OK} AND starts_with(answerability, 'unanswerable') AND confidence = 'high'"),
    ("WARN", "length_differs", f"{_RE_OK} AND coalesce(expected_answer, '') <> '' AND greatest(length(rederived_answer), length(expected_answer)) / greatest(least(length(rederived_answer), length(expected_answer)), 1) > 3"),
    ("WARN", "citations_disjoint", f"{_RE_OK} AND coalesce(expected_answer, '') <> '' AND len(citation_paths) > 0 AND len(citations) > 0 AND NOT list_has_any(citation_paths, citations)"),
    more=_missing("curated", "verifier", dropped=False),
), "candidates", "curated", "answers", "verifier"))
def verifier_findings(spark, d):
    return gates.verifier_findings(R.stage(spark, d, "verifier"), R.stage(spark, d, "candidates"), R.stage(spark, d, "curated"), R.stage(spark, d, "answers"))


_KEYS = "list_transform(evidence, lambda x: x.path || ':' || x.lines)"


@query("verifier_status", _stages_sql(f"SELECT case_id, CASE WHEN coalesce(rederived_answer, '') = '' THEN 'not_run' WHEN len(list_filter(citations, lambda c: contains(c, ':') AND NOT list_contains({_KEYS}, c))) > 0 THEN 'cite_fabricated' WHEN (answerability = 'answerable' AND {_RE_REFUSED}) OR (NOT ({_FULL}) AND NOT {_RE_REFUSED}) THEN 'disagrees' WHEN starts_with(answerability, 'unanswerable') AND confidence = 'high' THEN 'confidence_mismatch' ELSE 'agrees' END AS status FROM s_candidates JOIN s_curated USING (case_id) LEFT JOIN s_verifier USING (case_id)", "candidates", "curated", "verifier"))
def verifier_status(spark, d):
    own = R.stage(spark, d, "candidates").select("case_id", "answerability").join(R.stage(spark, d, "curated"), "case_id").join(R.stage(spark, d, "verifier"), "case_id", "left")
    return gates.verifier_status(own.withColumn("keys", F.transform("evidence", lambda x: F.concat(x["path"], F.lit(":"), x["lines"]))))


@query("merged_stages", _stages_sql("SELECT case_id, concat_ws(',', CASE WHEN q.case_id IS NOT NULL THEN 'queries' END, CASE WHEN v.case_id IS NOT NULL THEN 'verifier' END) AS stages, q.style AS queries_style, v.confidence AS verifier_confidence FROM (SELECT case_id FROM s_candidates) c LEFT JOIN s_queries q USING (case_id) LEFT JOIN s_verifier v USING (case_id)", "candidates", "queries", "verifier"))
def merged_stages(spark, d):
    out = corpora.merged_stages(R.stage(spark, d, "candidates").select("case_id"), {"queries": R.stage(spark, d, "queries").select("case_id", "style"), "verifier": R.stage(spark, d, "verifier").select("case_id", "confidence")})
    return out.select("case_id", "stages", "queries_style", "verifier_confidence")


@query("required_stages", _stages_sql(" UNION ALL ".join(f"SELECT '{n}' AS stage, count(*) AS missing, coalesce(array_to_string(list_slice(list(case_id ORDER BY case_id), 1, 5), ','), '') AS shown FROM s_candidates WHERE case_id NOT IN (SELECT case_id FROM s_{n})" for n in ("claims", "verifier")), "candidates", "claims", "verifier"))
def required_stages(spark, d):
    return corpora.required_stages({n: R.stage(spark, d, n) for n in ("claims", "verifier")}, R.stage(spark, d, "candidates"))


# ---- selection ------------------------------------------------------------------------------------------------------

_SIGNALS = "sg AS (SELECT 'sg_' || l_orderkey || '_' || l_linenumber || '_' || l_partkey || '_' || l_suppkey AS signal_id, l_partkey AS ordinal, 'p' || (l_orderkey % 2) AS project, CASE WHEN l_returnflag = 'R' THEN 2 WHEN l_returnflag = 'A' THEN 3 ELSE 4 END AS axis, CASE l_linenumber % 4 WHEN 0 THEN 'long_tail' WHEN 1 THEN 'signal_dataflow' WHEN 2 THEN 'conditional_behavior' ELSE 'doc_code_divergence' END AS attribute, 'src_' || (l_suppkey % 60) AS source_id, 'path/' || CASE WHEN l_suppkey % 7 = 0 THEN 'x' ELSE '' END || (l_suppkey % 60) AS path, '5' AS lines FROM lineitem)"
_PLACES = "places AS (SELECT source_id, line_count, 'path/' || substr(source_id, 5) AS path FROM row_sources)"


def _selection(spark, d):
    li, c = A.table(spark, d, "lineitem"), F.col
    text = lambda x: c(x).cast("string")
    attribute = F.when(c("l_linenumber") % 4 == 0, "long_tail").when(c("l_linenumber") % 4 == 1, "signal_dataflow").when(c("l_linenumber") % 4 == 2, "conditional_behavior").otherwise("doc_code_divergence")
    n = (c("l_suppkey") % 60).cast("string")
    own = li.select(
        F.concat_ws("_", F.lit("sg"), text("l_orderkey"), text("l_linenumber"), text("l_partkey"), text("l_suppkey")).alias("signal_id"),
        c("l_partkey").alias("ordinal"),
        F.concat(F.lit("p"), (c("l_orderkey") % 2).cast("string")).alias("project"),
        F.when(c("l_returnflag") == "R", 2).when(c("l_returnflag") == "A", 3).otherwise(4).alias("axis"),
        attribute.alias("attribute"),
        F.concat(F.lit("src_"), n).alias("source_id"),
        F.concat(F.lit("path/"), F.when(c("l_suppkey") % 7 == 0, "x").otherwise(""), n).alias("path"),
        F.lit("5").alias("lines"),
    )
    places = R.sources(spark, d).withColumn("path", F.concat(F.lit("path/"), F.expr("substr(source_id, 5)")))
    return own.withColumn("ordinal", F.struct("ordinal", "signal_id")), places


_OK_SIGNALS = "own AS (SELECT sg.* FROM sg JOIN places USING (source_id) WHERE project = 'p1' AND axis IN (2, 3) AND sg.path = places.path)"
_ADMITTED = "admitted AS (SELECT * FROM own WHERE attribute <> 'signal_dataflow' QUALIFY row_number() OVER (PARTITION BY attribute, source_id ORDER BY ordinal, signal_id) = 1)"


@query("admitted_signals", A.sql(f"WITH {_SIGNALS}, {_PLACES}, {_OK_SIGNALS}, {_ADMITTED} SELECT signal_id, axis, attribute, source_id FROM admitted", "row_sources"))
def admitted_signals(spark, d):
    return corpora.admitted(*_selection(spark, d), "p1")[0].select("signal_id", "axis", "attribute", "source_id")


@query("unknown_attributes", A.sql(f"WITH {_SIGNALS}, {_PLACES}, {_OK_SIGNALS} SELECT attribute, count(*) AS n FROM own WHERE attribute = 'signal_dataflow' GROUP BY 1", "row_sources"))
def unknown_attributes(spark, d):
    return corpora.admitted(*_selection(spark, d), "p1")[1]


@query("same_source_picks", A.sql(f"""WITH {_SIGNALS}, {_PLACES}, {_OK_SIGNALS}, {_ADMITTED}, s AS (SELECT source_id, list(signal_id ORDER BY path, attribute, signal_id) FILTER (axis = 2) AS a2, list(signal_id ORDER BY path, attribute, signal_id) FILTER (axis = 3) AS a3 FROM admitted WHERE attribute <> 'conditional_behavior' GROUP BY 1),
n AS (SELECT *, row_number() OVER (ORDER BY source_id) - 1 AS ordinal, count(*) OVER () AS total FROM s WHERE a2 IS NOT NULL AND a3 IS NOT NULL)
SELECT o_orderkey AS case_id, source_id, a2[o_orderkey % len(a2) + 1] AS axis2, a3[o_orderkey // len(a2) % len(a3) + 1] AS axis3 FROM orders JOIN n ON o_orderkey % total = ordinal""", "row_sources"))
def same_source_picks(spark, d):
    kept = corpora.admitted(*_selection(spark, d), "p1")[0]
    return corpora.same_source_picks(A.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_orderkey").alias("index")), kept)


@query("claim_sources", A.sql("SELECT 'case_' || k AS case_id, role AS attribute, string_agg(evidence_id, ',' ORDER BY pos) AS signals FROM ev GROUP BY 1, 2", "ev"))
def claim_sources(spark, d):
    own = R.evidence(spark, d).select(F.concat(F.lit("case_"), F.col("k").cast("string")).alias("case_id"), F.col("role").alias("attribute"), F.col("pos").alias("position"), F.col("evidence_id").alias("signal_id"))
    return corpora.claim_sources(own).withColumn("signals", F.array_join("signals", ","))


@query("line_windows", A.sql("WITH x AS (SELECT k, pos, path, lines, q, greatest(coalesce(TRY_CAST(trim(string_split(lines, '-')[1]) AS INT), 1), 1) AS a FROM (SELECT *, k % 12 AS q FROM ev)), y AS (SELECT *, least(a, q) AS s, least(q, least(a, q) + 2) AS e FROM x) SELECT k, CAST(pos AS INT) AS pos, CASE WHEN q <= 0 THEN '1' WHEN s = e THEN '' || s ELSE s || '-' || e END AS window_lines, CASE WHEN len(string_split(p, '/')) >= 3 AND string_split(p, '/')[1] = 'repo_sources' THEN array_to_string(string_split(p, '/')[3:], '/') ELSE p END AS label FROM (SELECT *, CASE WHEN k % 2 = 0 THEN 'repo_sources/demo/' || path ELSE path END AS p FROM y)", "ev"))
def line_windows(spark, d):
    own = R.evidence(spark, d).withColumn("p", F.when(F.col("k") % 2 == 0, F.concat(F.lit("repo_sources/demo/"), "path")).otherwise(F.col("path")))
    return own.select("k", "pos", corpora.line_window(F.col("lines"), F.col("k") % 12).alias("window_lines"), corpora.path_label(F.col("p")).alias("label"))


@query("cycled_types", _rows_sql("SELECT case_id, CASE WHEN answerability IN ('unanswerable_missing_evidence', 'unanswerable_ambiguous') THEN 'negative' WHEN answerability = 'unanswerable_false_premise' THEN 'fact_check' ELSE ['location', 'procedure', 'mechanism', 'synthesis'][k % 4 + 1] END AS answer_type, " + "CASE k % 6 " + " ".join(f"WHEN {i} THEN '{next('+'.join(p) for j in range(6) for p in [corpora.PAIRS[(i + j) % 6]] if 'non_code_anchor' not in p and 'distracting_info' not in p)}'" for i in range(6)) + " END AS pair FROM bench"))
def cycled_types(spark, d):
    pair = corpora.pair_of(F.col("k"), ["long_tail", "implicit_domain_knowledge", "doc_code_divergence", "conditional_behavior"])
    return R.bench(spark, d).select("case_id", corpora.answer_type(F.col("answerability"), F.col("k")).alias("answer_type"), F.array_join(pair, "+").alias("pair"))


@query("candidate_diversity", A.sql("SELECT 'span' AS what, path || ':' || lines AS key, count(*) AS n FROM ev WHERE path <> '' AND lines <> '' GROUP BY ALL HAVING count(*) > 3 UNION ALL SELECT 'anchor', source_id, count(*) FROM ev WHERE source_id <> '' GROUP BY ALL HAVING count(*) > 5", "ev"))
def candidate_diversity(spark, d):
    return corpora.diversity(R.evidence(spark, d))


_CODE_LINE = "CASE WHEN regexp_matches(text, '^\\s*(//|#|--|\\*)') THEN '' ELSE string_split(string_split(text, '//')[1], '#')[1] END"
_WORD_GUARD = "(^|[^\\p{L}\\p{N}_])(the|der|la|le)([^\\p{L}\\p{N}_]|$)"


@query("conditional_spans", A.sql(f"""WITH g AS (SELECT source_id, line FROM lines WHERE regexp_matches({_CODE_LINE}, '{_WORD_GUARD}')), f AS (SELECT source_id, min(line) AS first FROM g GROUP BY 1), n AS (SELECT source_id, max(line) AS last FROM lines GROUP BY 1),
sp AS (SELECT source_id AS span_id, source_id, CASE line_count % 4 WHEN 0 THEN 'x' WHEN 1 THEN '2' ELSE '1-1' END AS lines, CASE WHEN line_count % 5 = 0 THEN 'Apache License' ELSE '' END AS snippet FROM sources),
r AS (SELECT *, TRY_CAST(string_split(lines, '-')[1] AS INT) AS a, TRY_CAST(string_split(lines, '-')[-1] AS INT) AS b FROM sp)
SELECT span_id, CASE WHEN a IS NULL THEN NULL WHEN stays THEN lines WHEN first IS NOT NULL THEN first || '-' || least(last, first + 2) END AS lines, a IS NOT NULL AND (stays OR first IS NOT NULL) AS kept
FROM (SELECT r.*, first, last, snippet = '' AND EXISTS (SELECT 1 FROM g WHERE g.source_id = r.source_id AND g.line BETWEEN a - 2 AND b + 2) AS stays FROM r LEFT JOIN f USING (source_id) LEFT JOIN n USING (source_id))""", "sources", "lines"))
def conditional_spans(spark, d):
    own = A.sources(spark, d)
    n = F.col("line_count")
    spans = own.select(F.col("source_id").alias("span_id"), "source_id", F.when(n % 4 == 0, "x").when(n % 4 == 1, "2").otherwise("1-1").alias("lines"), F.when(n % 5 == 0, "Apache License").otherwise("").alias("snippet"))
    return corpora.conditional_spans(spans, A.lines(spark, d), _WORD_GUARD)


@query("include_targets", A.sql("SELECT regexp_extract(path, '[^/]*$') AS basename, min(source_id) AS source_id FROM sources GROUP BY 1", "sources"))
def include_targets(spark, d):
    return corpora.include_targets(A.sources(spark, d))


@query("material_sources", A.sql("SELECT source_id FROM (SELECT source_id, p, line_count, t FROM (SELECT source_id, CASE length(path) % 5 WHEN 0 THEN 'third_party/' || path WHEN 1 THEN path || '.png' ELSE path END AS p, line_count, CASE modality WHEN 'script' THEN 'binary.x' ELSE 'code.source' END AS t FROM sources)) WHERE line_count > 0 AND NOT starts_with(t, 'binary.') AND NOT " + _has("lower(p)", corpora.LOW_QUALITY_MARKS) + " AND NOT (" + " OR ".join(f"ends_with(lower(p), '{e}')" for e in corpora.LOW_QUALITY_ENDINGS) + ")", "sources"))
def material_sources(spark, d):
    n = F.length("path") % 5
    path = F.when(n == 0, F.concat(F.lit("third_party/"), "path")).when(n == 1, F.concat("path", F.lit(".png"))).otherwise(F.col("path"))
    own = A.sources(spark, d).withColumns({"path": path, "project": F.lit("demo"), "source_type": F.when(F.col("modality") == "script", "binary.x").otherwise("code.source")})
    return corpora.material(own, "demo").select("source_id")


@query("rotated_anchors")
def rotated_anchors(spark, d):
    """The tally runs across rows, which SQL can't say; a test holds it against a loop."""
    own = R.evidence(spark, d).where("path <> ''")
    return corpora.rotated_anchors(own.select(F.concat(F.lit("case_"), F.col("k").cast("string")).alias("case_id"), F.col("k").alias("row"), "evidence_id", "path", "lines", (F.length("statement") % 5).alias("degree")).withColumnRenamed("evidence_id", "candidate_id"))
