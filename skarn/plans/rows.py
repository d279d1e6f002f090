"""Views of the test tables as nested evaluation rows and as files of code; each also as a common table expression of
DuckDB's SQL. Both dialects come from one text, in which ``list`` and ``row`` stand for their literals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .adapters import CTES, table


def _list(spark: bool, *items: str) -> str:
    return f"array({', '.join(items)})" if spark else f"[{', '.join(items)}]"


def _row(spark: bool, **fields: str) -> str:
    return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")" if spark else "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"


#: Evidence of an order, from its lines.
EVIDENCE = {
    "evidence_id": "'E' || pos",
    "source_id": "CASE WHEN p % 17 = 0 THEN '' ELSE 'src_' || (p % 50) END",
    "path": "CASE rf WHEN 'R' THEN 'docs/guide_' || (s % 20) || '.md' WHEN 'A' THEN 'src/core_unit_' || (s % 20) || '.sv' ELSE 'tests/x_' || (s % 20) || '.py' END",
    "lines": "CASE WHEN q % 9 = 0 THEN 'x' WHEN q % 7 = 0 THEN '' || ln ELSE ln || '-' || (ln + q) END",
    "role": "CASE ln % 4 WHEN 0 THEN 'evidence_fact' WHEN 1 THEN 'guard' WHEN 2 THEN 'comparison_point' ELSE 'branch' END",
    "statement": "'这些行显示：' || CASE q % 6 WHEN 0 THEN 'if (a) b' || p WHEN 1 THEN '=====' WHEN 2 THEN '1. DEFINITIONS of ' || p WHEN 3 THEN '' WHEN 4 THEN 'unit ' || p || ' sets state_' || s ELSE 'value of part ' || p END",
}


def _fields(spark: bool) -> dict[str, str]:
    li, row = (lambda *x: _list(spark, *x)), (lambda **x: _row(spark, **x))
    none = "CAST(array() AS array<string>)" if spark else "CAST([] AS VARCHAR[])"
    claim = lambda a, s: row(attribute=f"'{a}'", signals=s)
    signal = li("'sig_' || (k % 40)")
    return {
        "case_id": "'case_' || k",
        "k": "k",
        "project": "CASE WHEN k % 23 = 0 THEN '' ELSE 'p' || (k % 2) END",
        "layer": "'L' || (k % 3 + 1)",
        "axis1_layer": "'L' || (CASE WHEN k % 5 = 0 THEN (k + 1) % 3 + 1 ELSE k % 3 + 1 END)",
        "answer_type": "CASE k % 5 WHEN 0 THEN 'yes_no' WHEN 1 THEN 'mechanism' WHEN 2 THEN 'fact_check' WHEN 3 THEN 'location' ELSE 'odd' END",
        "answerability": "CASE k % 7 WHEN 0 THEN 'unanswerable_missing_evidence' WHEN 1 THEN 'unanswerable_false_premise' WHEN 2 THEN 'unanswerable_ambiguous' WHEN 3 THEN 'maybe' ELSE 'answerable' END",
        "axis2": f"CASE k % 3 WHEN 0 THEN {li(chr(39) + 'long_tail' + chr(39))} WHEN 1 THEN {li(chr(39) + 'distracting_info' + chr(39), chr(39) + 'long_tail' + chr(39))} ELSE {none} END",
        "axis3": f"CASE k % 4 WHEN 0 THEN {li(chr(39) + 'conditional_behavior' + chr(39))} WHEN 1 THEN {li(chr(39) + 'implicit_domain_knowledge' + chr(39))} WHEN 2 THEN {li(chr(39) + 'negative_evidence' + chr(39))} ELSE {none} END",
        "has_difficulty": "k % 19 <> 0",
        "claims": f"CASE WHEN k % 6 = 5 THEN NULL WHEN k % 4 = 0 THEN {li(claim('long_tail', signal), claim('conditional_behavior', signal))} WHEN k % 4 = 1 THEN {li(claim('long_tail', signal), claim('implicit_domain_knowledge', none))} ELSE {li(claim('long_tail', signal))} END",
        "tags": f"CASE WHEN k % 13 = 0 THEN {li(chr(39) + 'file_anchor_required' + chr(39))} ELSE {none} END",
        "query": "CASE k % 5 WHEN 0 THEN 'How does unit core handle case ' || k || '?' WHEN 1 THEN '帮我看 docs/guide_' || (k % 20) || '.md 的证据' WHEN 2 THEN 'Is core_unit_' || (k % 20) || ' stable' WHEN 3 THEN '我没有看到可核验证据 ' || k ELSE 'tell line ' || (k % 20) END",
        "query_rewrite": "CASE k % 4 WHEN 0 THEN 'How does unit core handle case ' || k || '?' WHEN 1 THEN 'explain CORE_UNIT state::x in a.b' WHEN 2 THEN '检索并回答 ' || k ELSE '' END",
        "expected_answer": "CASE k % 4 WHEN 0 THEN '会 because docs/guide_1.md:3-4 shows it and some more text is here' WHEN 1 THEN '应说明 short' WHEN 2 THEN 'It holds in src/core_unit_3.sv:10 as the cited lines say so plainly.' ELSE '' END",
        "required": "CASE k % 4 WHEN 0 THEN 'always' WHEN 1 THEN 'never' WHEN 2 THEN 'when_query_requests_evidence' ELSE NULL END",
        "granularity": "CASE k % 3 WHEN 0 THEN 'path_line' WHEN 1 THEN 'path_only' ELSE 'source_only' END",
        "required_ids": f"CASE WHEN k % 5 = 0 THEN {li(chr(39) + 'E1' + chr(39))} WHEN k % 11 = 0 THEN {li(chr(39) + 'E99' + chr(39))} ELSE {none} END",
    }


#: Atoms of a row, from its first three evidence items ``x`` at place ``i`` from 1.
def _atom(spark: bool) -> str:
    li, none = (lambda *x: _list(spark, *x)), ("CAST(array() AS array<string>)" if spark else "CAST([] AS VARCHAR[])")
    return _row(
        spark,
        id="CASE WHEN k % 10 = 0 THEN 'A1' WHEN k % 27 = 0 THEN '' ELSE 'A' || i END",
        role="CASE WHEN k % 21 = 0 THEN 'odd' WHEN i = 1 AND k % 9 <> 0 THEN 'conclusion' WHEN k % 3 = 2 THEN 'reasoning' ELSE 'evidence_fact' END",
        match_type="CASE WHEN k % 14 = 0 THEN 'odd' WHEN k % 5 = 0 AND k % 2 = 0 THEN 'semantic_yes_no' ELSE 'semantic_fact' END",
        statement="CASE k % 6 WHEN 1 THEN x.path || ':' || x.lines || ' 显示：y' WHEN 2 THEN substr(x.statement, 7) WHEN 3 THEN '' ELSE 'claims that ' || x.path || ' holds' END",
        weight="CASE WHEN k % 15 = 0 THEN CAST(0 AS DOUBLE) WHEN i = 1 THEN CAST(2 AS DOUBLE) ELSE CAST(1 AS DOUBLE) END",
        evidence_ids=f"CASE WHEN k % 16 = 0 THEN {li(chr(39) + 'E99' + chr(39))} ELSE {li('x.evidence_id')} END",
        depends_on=f"CASE WHEN k % 3 = 2 AND i > 1 THEN {li(chr(39) + 'A' + chr(39) + ' || (i - 1)')} ELSE {none} END",
    )


def _forbidden(spark: bool) -> str:
    one = _row(spark, id="CASE WHEN k % 8 = 2 THEN '' ELSE 'F1' END", statement="CASE WHEN k % 12 = 3 THEN '' WHEN k % 12 = 7 THEN '答案声称 a 支持与引用证据相反的结论' ELSE 'denies ' || k END", match_type="CASE WHEN k % 9 = 2 THEN 'odd' ELSE 'semantic_contradiction' END", severity="CASE WHEN k % 11 = 3 THEN 'odd' ELSE 'fatal' END")
    empty = "CAST(array() AS array<struct<id:string,statement:string,match_type:string,severity:string>>)" if spark else "CAST([] AS STRUCT(id VARCHAR, statement VARCHAR, match_type VARCHAR, severity VARCHAR)[])"
    return f"CASE WHEN k % 4 IN (0, 1) THEN {empty} ELSE {_list(spark, one)} END"


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(k, pos, evidence_id, source_id, path, lines, role, statement) of all order lines."""
    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))
    own = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("k"), nth.alias("pos"), F.col("l_partkey").alias("p"), F.col("l_suppkey").alias("s"), F.col("l_linenumber").alias("ln"), F.col("l_quantity").cast("int").alias("q"), F.col("l_returnflag").alias("rf"))
    return own.select("k", "pos", *[F.expr(e).alias(n) for n, e in EVIDENCE.items()])


def bench(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A nested evaluation row for every order."""
    names = list(EVIDENCE)
    lines = evidence(spark, sf_dir).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("pos", *names))).alias("e")).select("k", F.transform("e", lambda x: F.struct(*[x[n].alias(n) for n in names])).alias("evidence"))
    none = F.array().cast("array<struct<" + ",".join(f"{n}:string" for n in names) + ">>")
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("k")).join(lines, "k", "left").withColumn("evidence", F.coalesce("evidence", none))
    rows = rows.select("evidence", *[F.expr(e).alias(n) for n, e in _fields(True).items()])
    atoms = F.expr(f"transform(slice(evidence, 1, 3), (x, j) -> element_at(transform(array(j + 1), i -> {_atom(True)}), 1))")
    refs = F.transform(F.slice("evidence", 1, 2), lambda x: F.struct(x["source_id"].alias("source_id"), x["path"].alias("path")))
    return rows.withColumns({"atoms": atoms, "forbidden": F.expr(_forbidden(True)), "refs": refs})


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, line_count) of the rows' sources: parts by their numbers below 40."""
    return table(spark, sf_dir, "part").select((F.col("p_partkey") % 40).alias("id")).distinct().select(F.concat(F.lit("src_"), F.col("id").cast("string")).alias("source_id"), (F.col("id") + 5).alias("line_count"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(signal_id, project, axis, attribute) that the rows' claims name: suppliers by their numbers below 30."""
    return table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 30).alias("id")).distinct().select(
        F.concat(F.lit("sig_"), F.col("id").cast("string")).alias("signal_id"),
        F.concat(F.lit("p"), (F.col("id") % 2).cast("string")).alias("project"),
        F.when(F.col("id") % 3 == 0, 2).otherwise(3).alias("axis"),
        F.when(F.col("id") % 2 == 0, "long_tail").otherwise("conditional_behavior").alias("attribute"),
    )


_EV = "SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, l_partkey AS p, l_suppkey AS s, l_linenumber AS ln, CAST(trunc(l_quantity) AS INT) AS q, l_returnflag AS rf FROM lineitem"
CTES["ev"] = "ev AS (SELECT k, pos, " + ", ".join(f"{e} AS {n}" for n, e in EVIDENCE.items()) + f" FROM ({_EV}))"
CTES["bench"] = (
    "bench0 AS (SELECT o_orderkey AS k, coalesce(list(" + _row(False, **{n: n for n in EVIDENCE}) + " ORDER BY pos) FILTER (pos IS NOT NULL), []) AS evidence FROM orders LEFT JOIN ev ON o_orderkey = ev.k GROUP BY 1),\n"
    "bench1 AS (SELECT evidence, " + ", ".join(f"{e} AS {n}" for n, e in _fields(False).items()) + " FROM bench0),\n"
    "bench AS (SELECT *, list_transform(evidence[1:3], lambda x, i: " + _atom(False) + ") AS atoms, " + _forbidden(False) + " AS forbidden, list_transform(evidence[1:2], lambda x: {'source_id': x.source_id, 'path': x.path}) AS refs FROM bench1)"
)
CTES["row_sources"] = "row_sources AS (SELECT 'src_' || id AS source_id, id + 5 AS line_count FROM (SELECT DISTINCT p_partkey % 40 AS id FROM part))"
CTES["row_signals"] = "row_signals AS (SELECT 'sig_' || id AS signal_id, 'p' || (id % 2) AS project, CASE WHEN id % 3 = 0 THEN 2 ELSE 3 END AS axis, CASE WHEN id % 2 = 0 THEN 'long_tail' ELSE 'conditional_behavior' END AS attribute FROM (SELECT DISTINCT s_suppkey % 30 AS id FROM supplier))"


# ---- stage outputs of the rows ---------------------------------------------------------------------------------------


def _slice(spark: bool, items: str, n: int) -> str:
    return f"slice({items}, 1, {n})" if spark else f"{items}[1:{n}]"


def _map(spark: bool, items: str, body: str) -> str:
    """``body`` for each item ``x`` at place ``i`` from 1."""
    return f"transform({items}, (x, j) -> element_at(transform(array(j + 1), i -> {body}), 1))" if spark else f"list_transform({items}, lambda x, i: {body})"


def _stage(name: str, spark: bool) -> tuple[dict[str, str], str]:
    """Columns of a stage over ``bench`` and which rows it has."""
    li, row = (lambda *x: _list(spark, *x)), (lambda **x: _row(spark, **x))
    none = "CAST(array() AS array<string>)" if spark else "CAST([] AS VARCHAR[])"
    n = "size(evidence)" if spark else "len(evidence)"
    first = "get(evidence, 0)" if spark else "evidence[1]"
    cite = f"CASE k % 3 WHEN 0 THEN {li(f'{first}.path || {chr(39)}:{chr(39)} || {first}.lines')} WHEN 1 THEN {li(chr(39) + 'nocolon' + chr(39), chr(39) + 'a:b' + chr(39))} ELSE {none} END"
    two = _slice(spark, "evidence", 2)
    return {
        "candidates": (
            {
                "layer": "layer",
                "answer_type": "answer_type",
                "answerability": "answerability",
                "axis3": f"CASE WHEN k % 5 = 3 THEN {li(chr(39) + 'doc_code_divergence' + chr(39))} ELSE axis3 END",
                "tags": "tags",
                "style_hint": "CASE k % 3 WHEN 0 THEN 'colloquial' WHEN 1 THEN 'contextual' ELSE '' END",
                "spans": _map(spark, two, row(path="x.path", lines="x.lines", raw_snippet="CASE WHEN k % 2 = 0 THEN x.statement || ' in full' ELSE substr(x.statement, 7) END")),
            },
            "TRUE",
        ),
        "curated": ({"evidence": f"CASE WHEN k % 7 = 0 AND k % 2 = 0 THEN {_slice(spark, 'evidence', 0) if spark else 'evidence[1:0]'} ELSE {_slice(spark, 'evidence', 3)} END", "rejected": f"CASE WHEN k % 5 = 0 THEN {li(chr(39) + 'license_header' + chr(39), chr(39) + 'odd' + chr(39))} ELSE {none} END"}, "TRUE"),
        "claims": (
            {
                "claims": _map(
                    spark,
                    f"CASE WHEN k % 8 = 5 THEN {_slice(spark, 'evidence', 0) if spark else 'evidence[1:0]'} ELSE {_slice(spark, 'evidence', 4)} END",
                    row(id="CASE WHEN k % 6 = 0 THEN 'C1' ELSE 'C' || i END", text="CASE k % 4 WHEN 0 THEN substr(x.statement, 7) WHEN 1 THEN '' ELSE 'claim number ' || k || ' about some longer thing' END", kind="CASE k % 5 WHEN 0 THEN 'odd' WHEN 1 THEN 'negative' ELSE 'behavior' END", evidence_ids=f"CASE WHEN k % 2 = 0 THEN {li(chr(39) + 'E1' + chr(39))} ELSE {li('x.evidence_id')} END"),
                )
            },
            f"{n} > 0",
        ),
        "queries": ({"query": "query", "query_rewrite": "query_rewrite", "style": "CASE k % 4 WHEN 0 THEN 'colloquial' WHEN 1 THEN 'odd' WHEN 2 THEN 'contextual' ELSE 'follow-up' END"}, f"{n} > 1"),
        "answers": ({"expected_answer": f"CASE k % 4 WHEN 0 THEN '支持 because `' || coalesce({first}.path, '') || ':' || coalesce({first}.lines, '') || '` has it' WHEN 1 THEN '应该 explain' WHEN 2 THEN '这些行显示：' || coalesce(substr({first}.statement, 7), '') || ' in full and then some. More' ELSE '' END", "citation_paths": cite}, f"{n} > 1"),
        "rubrics": ({"atoms": "atoms", "forbidden": "forbidden"}, f"{n} > 0"),
        "verifier": ({"rederived_answer": "CASE k % 4 WHEN 0 THEN '无法判断 x' WHEN 1 THEN '' WHEN 2 THEN 'it is so and so, and rather a long text that differs from the other in its length' ELSE 'There is no EVIDENCE' END", "confidence": "CASE k % 4 WHEN 0 THEN 'high' WHEN 1 THEN 'odd' ELSE 'low' END", "citations": cite}, f"{n} > 2"),
    }[name]


STAGES = ("candidates", "curated", "claims", "queries", "answers", "rubrics", "verifier")


def stage(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A stage's output for the rows that it has."""
    columns, where = _stage(name, True)
    return bench(spark, sf_dir).where(where).selectExpr("case_id", *[f"{e} AS {n}" for n, e in columns.items()])


for _name in STAGES:
    _columns, _where = _stage(_name, False)
    CTES["s_" + _name] = f"s_{_name} AS (SELECT case_id, " + ", ".join(f"{e} AS {n}" for n, e in _columns.items()) + f" FROM bench WHERE {_where})"


# ---- files of code from documents -----------------------------------------------------------------------------------

_LANGUAGE = "CASE doc_id % 6 WHEN 0 THEN 'python' WHEN 1 THEN 'yaml' WHEN 2 THEN 'verilog' WHEN 3 THEN 'markdown' WHEN 4 THEN 'cpp' ELSE 'odd' END"
_PATH = "'inner/' || source || '/f' || doc_id || '.txt'"
_ERRORS = "CASE doc_id % 10 WHEN 0 THEN '[\"x\"]' WHEN 1 THEN '[]' ELSE NULL END"
_LINE = "CAST(doc_id % 7 AS INT)"
_NODES = (
    ("'file:' || path", "'file'", "path", "path", "0", "0", "NULL"),
    ("'class:' || doc_id", "'class'", "'C' || (doc_id % 50)", "'m' || doc_id || '::C' || (doc_id % 50)", _LINE, f"{_LINE} * 2", "CASE WHEN doc_id % 3 = 0 THEN 'sig ' || doc_id WHEN doc_id % 3 = 1 THEN '' END"),
    ("'method:' || doc_id", "'method'", "'f' || doc_id", "'f' || doc_id", "5", "9", "NULL"),
    ("'import:' || doc_id", "'import'", "'i' || doc_id", "'i' || doc_id", "1", "1", "NULL"),
)
_EDGES = (
    ("1", "'file:' || path", "'class:' || doc_id", "'contains'", "1"),
    ("2", "'class:' || doc_id", "'method:' || doc_id", "'contains'", "NULL"),
    ("3", "'file:' || path", "'class:' || (doc_id + 1)", "'imports'", "2"),
    ("4", "'method:' || doc_id", "'method:' || (doc_id + 1)", "'calls'", "5"),
    ("5", "'method:' || doc_id", "'import:' || doc_id", "'references'", "6"),
    ("6", "'method:' || doc_id", "'class:' || (doc_id % 10)", "'returns'", "7"),
)
_NODE_NAMES = ("id", "kind", "name", "qualified_name", "start_line", "end_line", "signature")
_EDGE_NAMES = ("n", "source", "target", "kind", "line")


def code_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, path, content_hash, language, size, modified_at, indexed_at, errors), a file for each document."""
    own = table(spark, sf_dir, "documents").select("doc_id", "source", F.coalesce("text", F.lit("")).alias("text"))
    return own.select("doc_id", F.expr(_PATH).alias("path"), F.sha2("text", 256).alias("content_hash"), F.expr(_LANGUAGE).alias("language"), F.octet_length("text").cast("long").alias("size"), (F.col("doc_id") * 1000).alias("modified_at"), (F.col("doc_id") * 1000 + 7).alias("indexed_at"), F.expr(_ERRORS).alias("errors"))


def code_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, kind, name, qualified_name, start_line, end_line, signature, file_path, language): a file, a class, a method, an
    import for each document."""
    files = code_files(spark, sf_dir)
    made = F.array(*[F.expr("named_struct(" + ", ".join(f"'{n}', CAST({e} AS {'INT' if n.endswith('line') else 'STRING'})" for n, e in zip(_NODE_NAMES, node)) + ")") for node in _NODES])
    return files.select(F.explode(made).alias("x"), F.col("path").alias("file_path"), "language").select("x.*", "file_path", "language")


def code_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, source, target, kind, line); some ends have no node."""
    files = code_files(spark, sf_dir)
    made = F.array(*[F.expr("named_struct(" + ", ".join(f"'{n}', CAST({e} AS {'INT' if n in ('n', 'line') else 'STRING'})" for n, e in zip(_EDGE_NAMES, edge)) + ")") for edge in _EDGES])
    return files.select("doc_id", F.explode(made).alias("x")).select((F.col("doc_id") * 10 + F.col("x.n")).alias("id"), "x.source", "x.target", "x.kind", "x.line")


CTES["files"] = f"files AS (SELECT doc_id, {_PATH} AS path, sha256(coalesce(text, '')) AS content_hash, {_LANGUAGE} AS language, CAST(strlen(coalesce(text, '')) AS BIGINT) AS size, doc_id * 1000 AS modified_at, doc_id * 1000 + 7 AS indexed_at, {_ERRORS} AS errors FROM documents)"
CTES["code_nodes"] = "code_nodes AS (" + " UNION ALL ".join("SELECT " + ", ".join(f"CAST({e} AS {'INT' if n.endswith('line') else 'VARCHAR'}) AS {n}" for n, e in zip(_NODE_NAMES, node)) + ", path AS file_path, language FROM files" for node in _NODES) + ")"
CTES["code_edges"] = "code_edges AS (" + " UNION ALL ".join(f"SELECT doc_id * 10 + {e[0]} AS id, {e[1]} AS source, {e[2]} AS target, {e[3]} AS kind, CAST({e[4]} AS INT) AS line FROM files" for e in _EDGES) + ")"
