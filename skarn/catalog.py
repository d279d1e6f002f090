"""All queries of the engine over the test tables, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import scalars as S
from .operators import assembly, evaluation, graph, quality, search, signals
from .plans import adapters as A
from .registry import QUERIES, SQL, query
from .sources import bundle
from .streaming import sync

FLAGSHIP = "retrieval_scores"


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    from . import catalog_code, catalog_programs, catalog_rows  # noqa: F401

    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    from . import catalog_code, catalog_programs, catalog_rows  # noqa: F401

    return dict(SQL)


# ---- graph ----------------------------------------------------------------------------------------------------------


@query("graph_stats", A.sql("""SELECT what, value, CAST(count(*) AS BIGINT) AS n FROM (
  SELECT 'kind' AS what, kind AS value FROM nodes UNION ALL SELECT 'language', language FROM nodes UNION ALL SELECT 'edge', kind FROM edges) GROUP BY ALL""", "nodes", "edges"))
def graph_stats(spark, d):
    return graph.stats(A.nodes(spark, d), A.edges(spark, d))


@query("node_metrics", A.sql("""SELECT id, nodes.kind AS kind, coalesce(n_out, 0) AS n_out, coalesce(n_in, 0) AS n_in, coalesce(n_calls, 0) AS n_calls, coalesce(n_callers, 0) AS n_callers, coalesce(n_children, 0) AS n_children FROM nodes
  LEFT JOIN (SELECT source AS id, count(*) AS n_out, count(*) FILTER (kind = 'calls') AS n_calls, count(*) FILTER (kind = 'contains') AS n_children FROM edges GROUP BY 1) USING (id)
  LEFT JOIN (SELECT target AS id, count(*) AS n_in, count(*) FILTER (kind = 'calls') AS n_callers FROM edges GROUP BY 1) USING (id)""", "nodes", "edges"))
def node_metrics(spark, d):
    return graph.metrics(A.nodes(spark, d), A.edges(spark, d))


@query("dead_code", A.sql("""SELECT id, kind, name, file_path FROM nodes WHERE kind IN ('function', 'method', 'class') AND is_exported = 0
  AND NOT EXISTS (SELECT 1 FROM edges WHERE edges.kind <> 'contains' AND target = id)""", "nodes", "edges"))
def dead_code(spark, d):
    return graph.dead_code(A.nodes(spark, d), A.edges(spark, d)).select("id", "kind", "name", "file_path")


@query("file_dependencies", A.sql("""SELECT a.file_path AS source_file, b.file_path AS target_file, count(*) AS n FROM edges JOIN nodes a ON source = a.id JOIN nodes b ON target = b.id
  WHERE edges.kind <> 'contains' AND a.file_path <> b.file_path GROUP BY 1, 2""", "nodes", "edges"))
def file_dependencies(spark, d):
    return graph.file_edges(A.nodes(spark, d), A.edges(spark, d))


@query("dominant_files", A.sql("""SELECT row_number() OVER (ORDER BY n DESC, file_path) AS rank, file_path, n FROM (
  SELECT a.file_path, count(*) AS n FROM edges JOIN nodes a ON source = a.id JOIN nodes b ON target = b.id WHERE a.file_path = b.file_path GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20)
  QUALIFY rank <= 2 AND max(n) OVER () >= 20""", "nodes", "edges"))
def dominant_files(spark, d):
    return graph.dominant_files(A.nodes(spark, d), A.edges(spark, d), S.is_low_value_file(F.col("file_path"))).withColumn("rank", F.col("rank").cast("long"))


@query("callers_depth1", A.sql("""SELECT target AS id, source AS other, kind FROM edges WHERE kind IN ('calls', 'references', 'imports', 'instantiates') AND target IN ('function:7', 'class:3', 'interface:5')""", "edges"))
def callers_depth1(spark, d):
    return graph.callers(A.edges(spark, d), graph.ids(A.edges(spark, d), ["function:7", "class:3", "interface:5"]))


_REACH = """WITH RECURSIVE step AS (SELECT DISTINCT {0} AS a, {1} AS b FROM edges{2}),
walk(id, depth) AS (SELECT * FROM (VALUES {3}) UNION SELECT b, depth + 1 FROM walk JOIN step ON a = id WHERE depth < {4})
SELECT id, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY id{5}"""
_CALLS = " WHERE kind IN ('calls', 'references', 'imports', 'instantiates')"


@query("callees_depth2", A.sql(_REACH.format("source", "target", _CALLS, "('method:11', 0), ('method:12', 0)", 2, " HAVING min(depth) > 0"), "edges", recursive=True))
def callees_depth2(spark, d):
    return graph.callees(A.edges(spark, d), graph.ids(A.edges(spark, d), ["method:11", "method:12"]), 2)


_EITHER_WAY = "(SELECT source AS x, target AS y FROM edges UNION ALL SELECT target, source FROM edges)"


@query("bfs_both", A.sql(_REACH.replace("FROM edges{2}", "FROM " + _EITHER_WAY + "{2}").format("x", "y", "", "('interface:9', 0)", 2, ""), "edges", recursive=True))
def bfs_both(spark, d):
    return graph.reach(A.edges(spark, d), graph.ids(A.edges(spark, d), ["interface:9"]), 2, "both")


@query("call_graph", A.sql("""WITH RECURSIVE step AS (SELECT DISTINCT source AS a, target AS b FROM edges WHERE kind IN ('calls', 'references', 'imports', 'instantiates')),
up(id, depth) AS (SELECT 'function:42', 0 UNION SELECT a, depth + 1 FROM up JOIN step ON b = id WHERE depth < 2),
down(id, depth) AS (SELECT 'function:42', 0 UNION SELECT b, depth + 1 FROM down JOIN step ON a = id WHERE depth < 2)
SELECT id, CAST(arg_min(depth, abs(depth) * 2 - CAST(depth > 0 AS INT)) AS INT) AS depth FROM (SELECT id, -depth AS depth FROM up UNION ALL SELECT * FROM down) GROUP BY id""", "edges", recursive=True))
def call_graph(spark, d):
    return graph.call_graph(A.edges(spark, d), graph.ids(A.edges(spark, d), ["function:42"]))


@query("impact_radius", A.sql("""WITH RECURSIVE inside AS (SELECT source AS a, target AS b FROM edges WHERE kind = 'contains'),
walk(id, depth) AS (SELECT 'module:3', 0 UNION SELECT n.id, n.depth FROM walk w, LATERAL (
    SELECT b AS id, w.depth AS depth FROM inside WHERE a = w.id AND w.depth < 2 AND split_part(w.id, ':', 1) IN ('class', 'interface', 'module')
    UNION ALL SELECT source, w.depth + 1 FROM edges WHERE kind <> 'contains' AND target = w.id AND w.depth < 2) n)
SELECT id, CAST(min(depth) AS INT) AS depth FROM walk GROUP BY id""", "edges", recursive=True))
def impact_radius(spark, d):
    return graph.impact(A.nodes(spark, d), A.edges(spark, d), graph.ids(A.edges(spark, d), ["module:3"]), 2)


@query("ancestors", A.sql("""WITH p AS (SELECT target AS child, min(source) AS parent FROM edges WHERE kind = 'contains' GROUP BY 1)
SELECT child AS id, parent AS ancestor, CAST(1 AS INT) AS level FROM p WHERE child LIKE 'class:%' UNION ALL SELECT a.child, b.parent, 2 FROM p a JOIN p b ON a.parent = b.child WHERE a.child LIKE 'class:%'""", "edges"))
def ancestors(spark, d):
    return graph.ancestors(A.edges(spark, d), A.nodes(spark, d).where("kind = 'class'").select("id"))


@query("shortest_path", A.sql("""WITH RECURSIVE walk(id, path, depth) AS (SELECT 'NATION_0', ['NATION_0'], 0 UNION ALL
  SELECT target, list_append(path, target), depth + 1 FROM walk JOIN deps ON source = id WHERE NOT list_contains(path, target) AND depth < 6),
best AS (SELECT path FROM walk WHERE id = (SELECT max(id) FROM (SELECT id, min(depth) AS far FROM walk GROUP BY id) WHERE far = (SELECT max(far) FROM (SELECT min(depth) AS far FROM walk GROUP BY id))) ORDER BY depth, path LIMIT 1)
SELECT CAST(i - 1 AS INT) AS position, path[i] AS id FROM best, unnest(range(1, 1 + len(path))) AS t(i)""", "deps", recursive=True))
def shortest_path(spark, d):
    """To the farthest nation that NATION_0 reaches within 6 steps, of several the last by name."""
    deps = A.file_deps(spark, d).withColumn("kind", F.lit("dep"))
    far = graph.reach(deps, graph.ids(deps, ["NATION_0"]), 6).orderBy(F.desc("depth"), F.desc("id")).first()  # one row
    return graph.shortest_path(deps, "NATION_0", far["id"] if far else "NATION_0")


@query("circular_dependencies", A.sql("""WITH RECURSIVE walk(a, b) AS (SELECT source, target FROM deps UNION SELECT a, target FROM walk JOIN deps ON b = source)
SELECT x.a AS id, least(x.a, min(x.b)) AS component FROM walk x WHERE x.a <> x.b AND EXISTS (SELECT 1 FROM walk y WHERE y.a = x.b AND y.b = x.a) GROUP BY x.a""", "deps", recursive=True))
def circular_dependencies(spark, d):
    return graph.cycles(A.file_deps(spark, d))


@query("affected_tests", A.sql("""WITH RECURSIVE walk(id, depth) AS (SELECT 'NATION_9', 0 UNION SELECT source, depth + 1 FROM walk JOIN deps ON target = id WHERE depth < 5 AND id NOT LIKE '%1')
SELECT id, CAST(min(depth) AS INT) AS depth FROM walk WHERE id LIKE '%1' GROUP BY id""", "deps", recursive=True))
def affected_tests(spark, d):
    deps = A.file_deps(spark, d)
    return graph.affected(deps, graph.ids(deps, ["NATION_9"]), F.col("id").endswith("1"))


_PR = """WITH n AS (SELECT source AS id FROM deps UNION SELECT target FROM deps),
e AS (SELECT source AS a, target AS b FROM deps UNION ALL SELECT target, source FROM deps),
g AS (SELECT a AS id, count(*) AS degree FROM e GROUP BY 1),
s AS (SELECT a, b, count(*) * 1.0 / any_value(degree) AS share FROM e JOIN g ON a = id GROUP BY 1, 2),
r0 AS (SELECT id, CAST(id = 'NATION_3' AS INT) * 1.0::DOUBLE AS rank FROM n)"""
for _k in range(1, 7):
    _PR += f""",
r{_k} AS (SELECT n.id, 0.25 * CAST(n.id = 'NATION_3' AS INT) + 0.75 * coalesce((SELECT sum(rank * share) FROM r{_k - 1} r JOIN s ON r.id = s.a WHERE s.b = n.id), 0) AS rank FROM n)"""
_PR += "\nSELECT id, round(rank, 6) AS rank FROM r6"


@query("personalized_pagerank", A.sql(_PR, "deps"))
def personalized_pagerank(spark, d):
    """Six rounds from one seed over the nations' dependencies."""
    deps = A.file_deps(spark, d).withColumn("kind", F.lit("imports"))
    files = deps.select(F.col("source").alias("id")).union(deps.select("target")).distinct()
    return graph.pagerank(files, deps, graph.ids(deps, ["NATION_3"]), rounds=6).select("id", F.round("rank", 6).alias("rank"))


@query("pagerank_full")
def pagerank_full(spark, d):
    """All 25 rounds over the whole node graph from two seeds; a per-round SQL would repeat the graph 25 times."""
    return graph.pagerank(A.nodes(spark, d), A.edges(spark, d), graph.ids(A.edges(spark, d), ["function:3", "class:7"])).where("rank > 0")


@query("filtered_subgraph", A.sql("""SELECT source, target, edges.kind AS kind, line FROM edges JOIN nodes a ON source = a.id JOIN nodes b ON target = b.id WHERE a.kind IN ('module', 'class', 'namespace') AND b.kind IN ('module', 'class', 'namespace')""", "nodes", "edges"))
def filtered_subgraph(spark, d):
    return graph.filtered_subgraph(A.nodes(spark, d), A.edges(spark, d), F.col("kind").isin("module", "class", "namespace")).select("source", "target", "kind", "line")


@query("module_structure", A.sql("""SELECT CASE WHEN contains(file_path, '/') THEN regexp_extract(file_path, '^(.*)/[^/]*$', 1) ELSE '.' END AS folder, string_agg(file_path, ',' ORDER BY file_path) AS files, count(*) AS n_files
  FROM (SELECT DISTINCT file_path FROM nodes) GROUP BY 1""", "nodes"))
def module_structure(spark, d):
    return graph.module_structure(A.nodes(spark, d))


@query("exported_symbols", A.sql("SELECT id, kind, name FROM nodes WHERE is_exported = 1 AND file_path IN ('Brand#2', 'NATION_4')", "nodes"))
def exported_symbols(spark, d):
    return A.nodes(spark, d).where("is_exported = 1 and file_path in ('Brand#2', 'NATION_4')").select("id", "kind", "name")


# ---- search and resolution ------------------------------------------------------------------------------------------

_INDEX = r"""columns AS (SELECT id, 'name' AS col, 20.0 AS w, name AS t FROM nodes UNION ALL SELECT id, 'qualified_name', 5.0, qualified_name FROM nodes),
tok AS (SELECT id, col, w, x AS token, count(*) AS tf FROM columns, unnest(regexp_split_to_array(lower(t), '[^a-z0-9]+')) AS u(x) WHERE x <> '' GROUP BY ALL),
len AS (SELECT id, sum(tf) AS length FROM tok GROUP BY 1),
per AS (SELECT id, term, sum(tf * w) AS wtf FROM tok JOIN (VALUES ('red'), ('wid')) AS q(term) ON starts_with(token, term) GROUP BY 1, 2),
df AS (SELECT term, count(*) AS df FROM per GROUP BY 1),
big AS (SELECT (SELECT count(*) FROM nodes) AS n, (SELECT sum(length) FROM len) AS total),
bm AS (SELECT id, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * wtf * 2.2 / (wtf + 1.2 * (0.25 + 0.75 * length / (total / n)))) AS score FROM per JOIN df USING (term) JOIN len USING (id), big GROUP BY id)"""


@query("search_bm25", A.sql("WITH " + _INDEX + " SELECT id, round(score, 6) AS score FROM bm", "nodes"))
def search_bm25(spark, d):
    return search.bm25(A.nodes(spark, d), "red wid").select("id", F.round("score", 6).alias("score"))


@query("search_like", A.sql("""SELECT id, CAST(CASE WHEN name = 'NATION_1' THEN 1.0 WHEN starts_with(lower(name), 'nation_1') THEN 0.9 WHEN contains(lower(name), 'nation_1') THEN 0.8 ELSE 0.7 END AS DOUBLE) AS score FROM nodes
  WHERE contains(lower(name), 'nation_1') OR contains(lower(qualified_name), 'nation_1')""", "nodes"))
def search_like(spark, d):
    return search.like(A.nodes(spark, d), "NATION_1")


@query("search_fuzzy", A.sql("""WITH names AS (SELECT DISTINCT name, levenshtein(lower(name), 'blue bot') AS d FROM nodes WHERE levenshtein(lower(name), 'blue bot') <= 2 ORDER BY d, name LIMIT 50)
SELECT id, 1.0 / (1 + d) AS score FROM (SELECT id, d, row_number() OVER (PARTITION BY name ORDER BY id) AS nth FROM nodes JOIN names USING (name)) WHERE nth <= 5""", "nodes"))
def search_fuzzy(spark, d):
    return search.fuzzy(A.nodes(spark, d), "blue bot")


@query("search_ranked")
def search_ranked(spark, d):
    """The whole cascade; its parts are checked by SQL of their own and its order by tests."""
    return search.search(A.nodes(spark, d), 'kind:function red widget path:brand')


@query("resolve_references", A.sql("""WITH refs AS (
  SELECT 'a' || p_partkey AS ref_id, p_name AS name, 'calls' AS kind, 'ECONOMY' AS language, p_brand AS file_path FROM part
  UNION ALL SELECT 'b' || s_suppkey, 'NATION_' || s_nationkey || '::' || s_name, 'references', 'SUPPLIER', '' FROM supplier UNION ALL SELECT 'c' || c_custkey, lower(c_name), 'calls', c_mktsegment, '' FROM customer),
qu AS (SELECT ref_id, id AS target, 1 AS priority, 'qualified-name' AS strategy, 0.95 AS confidence FROM refs JOIN nodes ON refs.name = qualified_name WHERE contains(refs.name, '::') OR contains(refs.name, '.') QUALIFY count(*) OVER (PARTITION BY ref_id) = 1),
pa AS (SELECT ref_id, id AS target, 2, 'qualified-name', 0.85 FROM refs JOIN nodes n ON n.name = regexp_extract(refs.name, '[^:.]*$') AND ends_with(qualified_name, refs.name) WHERE contains(refs.name, '::') OR contains(refs.name, '.') QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY id) = 1),
c AS (SELECT ref_id, id, r.language = n.language AS alike, count(*) OVER w AS n, max(CAST(r.language = n.language AS INT)) OVER w AS any_same,
  CASE WHEN r.file_path = n.file_path THEN 100 + greatest(0, 20 - abs(start_line - 1) / 10) ELSE 0 END + CASE WHEN r.language = n.language THEN 50 ELSE -80 END + CASE WHEN r.kind = 'calls' AND n.kind IN ('function', 'method') THEN 25 ELSE 0 END + CASE WHEN is_exported = 1 THEN 10 ELSE 0 END AS score
  FROM refs r JOIN nodes n ON r.name = n.name WHERE r.kind <> 'references' OR r.language = n.language WINDOW w AS (PARTITION BY ref_id)),
ex AS (SELECT ref_id, id AS target, 3, 'exact-match', CASE WHEN n = 1 THEN CASE WHEN alike THEN 0.9 ELSE 0.5 END ELSE 0.4 END FROM c WHERE n = 1 OR ((alike OR any_same = 0) AND score > -1) QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY score DESC, id) = 1),
l AS (SELECT ref_id, id, CAST(r.language = n.language AS INT) AS alike FROM refs r JOIN nodes n ON lower(r.name) = lower(n.name) WHERE n.kind IN ('function', 'method', 'class') AND (r.kind <> 'references' OR r.language = n.language)),
lo AS (SELECT ref_id, id AS target, 4, 'fuzzy', CASE WHEN alike = 1 THEN 0.5 ELSE 0.3 END FROM (SELECT * FROM l QUALIFY alike = max(alike) OVER (PARTITION BY ref_id)) QUALIFY count(*) OVER (PARTITION BY ref_id) = 1)
SELECT ref_id, target, strategy, CAST(confidence AS DOUBLE) AS confidence FROM (SELECT * FROM qu UNION ALL SELECT * FROM pa UNION ALL SELECT * FROM ex UNION ALL SELECT * FROM lo)
QUALIFY row_number() OVER (PARTITION BY ref_id ORDER BY priority) = 1""", "nodes"))
def resolve_references(spark, d):
    return search.resolve(references(spark, d), A.nodes(spark, d))


def references(spark, d):
    """Names of parts, qualified suppliers and lower-case customers as references."""
    t = lambda n: A.table(spark, d, n)
    s = lambda p, k: F.concat(F.lit(p), F.col(k).cast("string")).alias("ref_id")
    rest = lambda kind, language, path: (F.lit(kind).alias("kind"), language.alias("language"), path.alias("file_path"), F.lit(1).alias("line"))
    refs = t("part").select(s("a", "p_partkey"), F.col("p_name").alias("name"), *rest("calls", F.lit("ECONOMY"), F.col("p_brand")))
    refs = refs.unionByName(t("supplier").select(s("b", "s_suppkey"), F.concat(F.lit("NATION_"), F.col("s_nationkey").cast("string"), F.lit("::"), "s_name").alias("name"), *rest("references", F.lit("SUPPLIER"), F.lit(""))))
    return refs.unionByName(t("customer").select(s("c", "c_custkey"), F.lower("c_name").alias("name"), *rest("calls", F.col("c_mktsegment"), F.lit(""))))


@query("name_bonus", A.sql("""SELECT DISTINCT name, CAST(CASE WHEN lower(name) = 'redwidget' THEN 80 WHEN lower(name) IN ('red', 'widget') THEN 60 WHEN starts_with(lower(name), 'redwidget') THEN floor(10 + 30 * (9.0 / length(name)) + 0.5)
  WHEN contains(lower(name), 'red') AND contains(lower(name), 'widget') THEN 15 WHEN contains(lower(name), 'redwidget') THEN 10 ELSE 0 END AS INT) AS bonus FROM nodes""", "nodes"))
def name_bonus(spark, d):
    return A.nodes(spark, d).select("name", S.name_bonus(F.col("name"), "red widget").alias("bonus")).distinct()


# ---- evaluation -----------------------------------------------------------------------------------------------------

_EVAL = """gold AS (SELECT row_number() OVER () AS item, 'case_' || o_orderkey AS case_id, 'E' || l_linenumber AS evidence_id, 'src_' || l_partkey AS source_id, 'p/' || l_suppkey AS path, l_linenumber * 10 AS a, l_linenumber * 10 + CAST(l_quantity AS INT) AS b
  FROM orders JOIN lineitem ON l_orderkey = o_orderkey WHERE l_linestatus = 'F'),
preds AS (SELECT 'case_' || l_orderkey AS case_id, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_linenumber, l_suppkey, l_extendedprice) AS position, CASE WHEN l_returnflag = 'N' THEN '' ELSE 'src_' || l_partkey END AS source_id, 'p/' || l_suppkey AS path, l_linenumber * 10 + 20 AS a, l_linenumber * 10 + 25 AS b FROM lineitem),
top AS (SELECT * FROM preds WHERE position <= 5),
hit AS (SELECT g.case_id, item, evidence_id, position FROM gold g JOIN top p ON g.case_id = p.case_id AND ((p.source_id <> '' AND g.source_id = p.source_id) OR g.path = p.path) AND greatest(g.a, p.a) <= least(g.b, p.b)),
rf AS (SELECT DISTINCT case_id, source_id, path FROM gold),
rhit AS (SELECT DISTINCT r.case_id, r.source_id, r.path FROM rf r JOIN top p ON r.case_id = p.case_id AND ((p.source_id <> '' AND r.source_id = p.source_id) OR r.path = p.path)),
one AS (SELECT 'case_' || o_orderkey AS case_id, CASE WHEN o_orderstatus = 'P' THEN 'unanswerable_missing_evidence' ELSE 'answerable' END AS answerability, o_orderpriority, o_orderstatus FROM orders),
counted AS (SELECT one.*, coalesce(ng, 0) AS ng, coalesce(np, 0) AS np, coalesce(nr, 0) AS nr, coalesce(m, 0) AS m, coalesce(mp, 0) AS mp, coalesce(ids, '') AS ids, coalesce(mr, 0) AS mr FROM one
  LEFT JOIN (SELECT case_id, count(*) AS ng FROM gold GROUP BY 1) USING (case_id) LEFT JOIN (SELECT case_id, count(*) AS np FROM top GROUP BY 1) USING (case_id) LEFT JOIN (SELECT case_id, count(*) AS nr FROM rf GROUP BY 1) USING (case_id)
  LEFT JOIN (SELECT case_id, count(DISTINCT item) AS m, count(DISTINCT position) AS mp FROM hit GROUP BY 1) USING (case_id) LEFT JOIN (SELECT case_id, string_agg(evidence_id, ',' ORDER BY evidence_id) AS ids FROM (SELECT DISTINCT case_id, item, evidence_id FROM hit) GROUP BY 1) USING (case_id) LEFT JOIN (SELECT case_id, count(*) AS mr FROM rhit GROUP BY 1) USING (case_id)),
free AS (SELECT *, CASE WHEN answerability = 'unanswerable_missing_evidence' AND ng = 0 AND nr = 0 THEN 1.0 ELSE 0.0 END AS f FROM counted),
scored AS (SELECT *, CASE WHEN nr > 0 THEN mr / nr ELSE f END AS rr, CASE WHEN ng > 0 THEN m / ng ELSE f END AS er, CASE WHEN np > 0 THEN mp / np ELSE f END AS ep FROM free)"""


def _cases(spark, d):
    t = lambda n: A.table(spark, d, n)
    case = lambda k: F.concat(F.lit("case_"), F.col(k).cast("string")).alias("case_id")
    cases = t("orders").select(case("o_orderkey"), F.when(F.col("o_orderstatus") == "P", evaluation.REFUSAL).otherwise("answerable").alias("answerability"), "o_orderpriority", "o_orderstatus")
    span = lambda a, b: F.concat_ws("-", a.cast("string"), b.cast("string")).alias("lines")
    ln = F.col("l_linenumber") * 10
    src, path = F.concat(F.lit("src_"), F.col("l_partkey").cast("string")), F.concat(F.lit("p/"), F.col("l_suppkey").cast("string"))
    own = t("lineitem").where("l_linestatus = 'F'").join(t("orders").select("o_orderkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    gold = own.select(case("l_orderkey"), F.concat(F.lit("E"), F.col("l_linenumber").cast("string")).alias("evidence_id"), src.alias("source_id"), path.alias("path"), span(ln, ln + F.col("l_quantity").cast("int")))
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_linenumber", "l_suppkey", "l_extendedprice"))
    preds = t("lineitem").select(case("l_orderkey"), nth.alias("position"), F.lit(None).cast("int").alias("rank"), F.when(F.col("l_returnflag") == "N", "").otherwise(src).alias("source_id"), path.alias("path"), span(ln + 20, ln + 25))
    return cases, gold, gold.select("case_id", "source_id", "path").distinct(), preds


@query("retrieval_scores", "WITH " + _EVAL + """ SELECT case_id, round(rr, 6) AS reference_recall, round(er, 6) AS evidence_recall, round(ep, 6) AS evidence_precision, ids AS matched_ids, np AS n_preds,
  round(CASE WHEN er + ep > 0 THEN 2 * er * ep / (er + ep) ELSE 0 END, 6) AS evidence_f1 FROM scored""")
def retrieval_scores(spark, d):
    out = evaluation.score_retrieval(*_cases(spark, d), k=5)
    return out.withColumns({c: F.round(c, 6) for c in ("reference_recall", "evidence_recall", "evidence_precision", "evidence_f1")})


@query("retrieval_summary", "WITH " + _EVAL + """ SELECT count(*) AS cases, round(avg(CAST(er >= 1 AS INT)), 6) AS retrieval_pass, round(avg(rr), 6) AS mean_reference_recall, round(avg(er), 6) AS mean_evidence_recall, round(avg(ep), 6) AS mean_evidence_precision,
  round(avg(CASE WHEN er + ep > 0 THEN 2 * er * ep / (er + ep) ELSE 0 END), 6) AS mean_evidence_f1 FROM scored""")
def retrieval_summary(spark, d):
    out = evaluation.summary(evaluation.score_retrieval(*_cases(spark, d), k=5))
    return out.select("cases", *[F.round(c, 6).alias(c) for c in out.columns if c != "cases"])


@query("retrieval_slices", "WITH " + _EVAL + """ SELECT dimension, value, count(*) AS cases, round(avg(CAST(er >= 1 AS INT)), 6) AS pass_rate, round(avg(er), 6) AS mean_recall FROM (
  SELECT 'o_orderpriority' AS dimension, o_orderpriority AS value, er FROM scored UNION ALL SELECT 'o_orderstatus', o_orderstatus, er FROM scored) GROUP BY 1, 2""")
def retrieval_slices(spark, d):
    cases, *rest = _cases(spark, d)
    scores = evaluation.score_retrieval(cases, *rest, k=5).join(cases.select("case_id", "o_orderpriority", "o_orderstatus"), "case_id")
    return evaluation.slices(scores, ["o_orderpriority", "o_orderstatus"]).withColumns({c: F.round(c, 6) for c in ("pass_rate", "mean_recall")})


@query("token_totals", """SELECT event_type, count(*) AS events, count(k) AS covered, CAST(coalesce(sum(k), 0) AS BIGINT) AS total_tokens, round(coalesce(avg(k), 0), 6) AS mean_tokens FROM (SELECT event_type, TRY_CAST(props->>'$.k' AS BIGINT) AS k FROM events) GROUP BY 1""")
def token_totals(spark, d):
    usage = A.table(spark, d, "events").select("event_type", F.get_json_object("props", "$.k").try_cast("bigint").alias("total_tokens"), F.lit(None).cast("bigint").alias("input_tokens"), F.lit(None).cast("bigint").alias("output_tokens"))
    return evaluation.token_totals(usage, ["event_type"]).withColumn("mean_tokens", F.round("mean_tokens", 6))


@query("latest_usage", """SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type FROM events GROUP BY 1""")
def latest_usage(spark, d):
    return evaluation.latest(A.table(spark, d, "events").select("user_id", "event_id", "event_type", "ts"), "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


# ---- signals and sampling -------------------------------------------------------------------------------------------

_SIG = """ent AS (SELECT 'part:' || p_partkey AS entity_id, p_brand AS source_id, p_name AS name, CAST(p_size AS VARCHAR) AS line FROM part),
src AS (SELECT DISTINCT p_brand AS source_id, CASE length(p_brand) % 2 WHEN 0 THEN 'script' ELSE 'code' END AS modality, 'verilog' AS language FROM part),
rel AS (SELECT 'rel_' || o_orderkey AS relation_id, 'Brand#' || (o_orderkey % 25 + 1) AS subject_id, 'part:' || o_custkey AS object_id, CASE o_orderkey % 4 WHEN 0 THEN 'contains' WHEN 1 THEN 'imports_or_includes' WHEN 2 THEN 'doc_mentions_entity' ELSE 'checks_condition' END AS predicate, CAST(o_orderkey % 9 AS VARCHAR) AS line FROM orders)"""


def bundle_tables(spark, d):
    """Brands as sources, parts as entities, orders as relations to the parts of their customers' numbers."""
    t = lambda n: A.table(spark, d, n)
    key = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    ent = t("part").select(key("part:", "p_partkey").alias("entity_id"), F.col("p_brand").alias("source_id"), F.col("p_name").alias("name"), F.col("p_size").alias("line_start"))
    src = ent.select("source_id").distinct().select("source_id", F.when(F.length("source_id") % 2 == 0, "script").otherwise("code").alias("modality"), F.lit("verilog").alias("language"))
    k = F.col("o_orderkey")
    predicate = F.when(k % 4 == 0, "contains").when(k % 4 == 1, "imports_or_includes").when(k % 4 == 2, "doc_mentions_entity").otherwise("checks_condition")
    brand = F.concat(F.lit("Brand#"), (k % 25 + 1).cast("string"))
    evidence = F.array(F.struct(brand.alias("source_id"), (k % 9).cast("string").alias("lines")))
    rel = t("orders").select(key("rel_", "o_orderkey").alias("relation_id"), brand.alias("subject_id"), F.lit("source").alias("subject_type"), key("part:", "o_custkey").alias("object_id"), F.lit("entity").alias("object_type"), predicate.alias("predicate"), evidence.alias("evidence"))
    return src, ent, rel


_EMITTED = _SIG + """, raw AS (
  SELECT 2 AS axis, 'long_tail' AS attribute, source_id, entity_id, line FROM ent LEFT JOIN (SELECT object_id AS entity_id, count(*) AS n FROM rel GROUP BY 1) USING (entity_id) WHERE coalesce(n, 0) <= 3
  UNION ALL SELECT 2, 'non_code_anchor', source_id, entity_id, line FROM ent JOIN src USING (source_id) WHERE modality = 'script'
  UNION ALL SELECT 2, 'distracting_info', source_id, entity_id, line FROM ent WHERE name IN (SELECT name FROM ent GROUP BY name HAVING count(DISTINCT source_id) >= 2)
  UNION ALL SELECT 3, 'implicit_domain_knowledge', source_id, NULL, '1' FROM src
  UNION ALL SELECT 3, 'doc_code_divergence', src.source_id, ent.entity_id, rel.line FROM rel JOIN src ON subject_id = src.source_id JOIN ent ON object_id = entity_id WHERE predicate = 'doc_mentions_entity'),
emitted AS (SELECT 'sig:demo:' || attribute || ':' || replace(source_id, '_', '-') || '-' || substr(sha256(source_id || '|' || line || '|' || attribute || '|'), 1, 12) AS signal_id, axis, attribute, source_id, entity_id, line AS lines FROM raw)"""


@query("signals_all", "WITH " + _EMITTED + " SELECT * FROM emitted")
def signals_all(spark, d):
    return signals.emit_all(*bundle_tables(spark, d)).select("signal_id", "axis", "attribute", "source_id", "entity_id", "lines")


@query("first_signal_per_source", "WITH " + _EMITTED + " SELECT source_id, attribute, min(signal_id) AS signal_id FROM emitted GROUP BY 1, 2")
def first_signal_per_source(spark, d):
    return signals.first_by(signals.emit_all(*bundle_tables(spark, d)), ["source_id", "attribute"], ["signal_id"]).select("source_id", "attribute", "signal_id")


@query("signals_built", "WITH " + _SIG + r""", raw AS (
  SELECT 2 AS axis, 'long_tail' AS attribute, entity_id AS anchor_id, source_id, CASE WHEN line <> '0' THEN line END AS lines FROM ent LEFT JOIN (SELECT object_id AS entity_id, count(*) AS n FROM rel GROUP BY 1) USING (entity_id) WHERE coalesce(n, 0) <= 3
  UNION ALL SELECT 2, 'non_code_anchor', source_id, source_id, NULL FROM src WHERE modality = 'script'
  UNION ALL SELECT 2, 'distracting_info', entity_id, source_id, CASE WHEN line <> '0' THEN line END FROM ent WHERE name IN (SELECT name FROM ent GROUP BY name HAVING count(DISTINCT source_id) >= 2)
  UNION ALL SELECT 3, 'conditional_behavior', relation_id, subject_id, line FROM rel WHERE predicate = 'checks_condition'
  UNION ALL SELECT 3, CASE predicate WHEN 'doc_mentions_entity' THEN 'doc_code_divergence' ELSE 'implicit_domain_knowledge' END, relation_id, subject_id, line FROM rel WHERE predicate <> 'checks_condition')
SELECT 'sig:demo:' || attribute || ':' || substr(regexp_replace(regexp_replace(lower(anchor_id), '[^\p{L}\p{N}]+', '-', 'g'), '^-|-$', '', 'g'), 1, 80) || '-' || substr(sha1(anchor_id), 1, 12) AS signal_id, axis, attribute, anchor_id, source_id, lines FROM raw""")
def signals_built(spark, d):
    return signals.emit_all(*bundle_tables(spark, d), registry=signals.BUILDERS).select("signal_id", "axis", "attribute", "anchor_id", "source_id", "lines")


@query("name_collisions", "WITH " + _SIG + " SELECT name, string_agg(DISTINCT source_id, ',' ORDER BY source_id) AS sources, count(DISTINCT source_id) AS n_sources, count(*) AS n_entities FROM ent GROUP BY name HAVING count(DISTINCT source_id) >= 2")
def name_collisions(spark, d):
    return signals.collisions(bundle_tables(spark, d)[1]).select("name", F.array_join("sources", ",").alias("sources"), F.col("n_sources").cast("long").alias("n_sources"), "n_entities")


@query("endpoint_counts", "WITH " + _SIG + " SELECT object_id AS entity_id, count(*) AS n FROM rel GROUP BY 1")
def endpoint_counts(spark, d):
    return signals.endpoints(bundle_tables(spark, d)[2])


@query("disambiguated_signals", "WITH " + _EMITTED + r""", named AS (SELECT *, 'x:' || attribute AS id, row_number() OVER (PARTITION BY attribute ORDER BY signal_id, entity_id) AS nth FROM emitted WHERE entity_id IS NOT NULL),
suffixed AS (SELECT CASE WHEN nth > 1 THEN id || ':' || regexp_replace(entity_id, ':', '-') || '-' || substr(sha1(entity_id), 1, 12) ELSE id END AS id, nth, attribute, entity_id FROM named)
SELECT id AS signal_id, attribute, entity_id FROM suffixed QUALIFY row_number() OVER (PARTITION BY id ORDER BY nth DESC) = 1""")
def disambiguated_signals(spark, d):
    own = signals.emit_all(*bundle_tables(spark, d)).where("entity_id is not null")
    named = own.withColumns({"order_id": F.col("signal_id"), "signal_id": F.concat(F.lit("x:"), "attribute")})
    return signals.suffixed(named, ["order_id", "entity_id"], "entity_id").select("signal_id", "attribute", "entity_id")


@query("conditional_lines", A.sql(r"""SELECT source_id, CAST(min(line) OVER (PARTITION BY source_id) AS INT) AS first_line, CAST(line AS INT) AS line, substr(regexp_replace(text, '^\s+|\s+$', '', 'g'), 1, 160) AS text FROM lines
  WHERE regexp_matches(text, '(?i)(^|[^\p{L}\p{N}_])(if|else|case|switch|when|guard|assert|for|while|unless)([^\p{L}\p{N}_]|$)|&&|\|\||\?') AND source_id IN (SELECT source_id FROM sources WHERE modality IN ('code', 'script', 'config', 'test'))
  QUALIFY row_number() OVER (PARTITION BY source_id ORDER BY line) <= 5""", "sources", "lines"))
def conditional_lines(spark, d):
    return signals.conditional_text(A.lines(spark, d), A.sources(spark, d)).select("source_id", "first_line", "line", "text")


@query("sampled_signals", """WITH s AS (SELECT p_partkey, 'sig_' || lpad(CAST(p_partkey AS VARCHAR), 9, '0') AS signal_id FROM part), n AS (SELECT signal_id, row_number() OVER (ORDER BY signal_id) - 1 AS ordinal FROM s),
t AS (SELECT count(*) AS total FROM s) SELECT s_suppkey AS case_id, CAST(i AS INT) AS nth, signal_id FROM supplier, t, unnest(range(0, 3)) AS u(i) JOIN n ON ordinal = (s_suppkey + 17 * i) % total""")
def sampled_signals(spark, d):
    own = A.table(spark, d, "part").select(F.concat(F.lit("sig_"), F.lpad(F.col("p_partkey").cast("string"), 9, "0")).alias("signal_id"))
    return signals.picked(own, A.table(spark, d, "supplier").select(F.col("s_suppkey").alias("case_id"), F.col("s_suppkey").alias("index")))


@query("two_hop_neighbours", """WITH r AS (SELECT DISTINCT l_suppkey AS s, l_partkey AS o FROM lineitem),
p AS (SELECT DISTINCT a.s AS anchor, b.s AS neighbour FROM r a JOIN r b ON a.o = b.o AND a.s <> b.s)
SELECT anchor, neighbour, CAST(rank AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY neighbour) AS rank FROM p) WHERE rank <= 3""")
def two_hop_neighbours(spark, d):
    return signals.two_hops(A.table(spark, d, "lineitem").select(F.col("l_suppkey").alias("subject_id"), F.col("l_partkey").alias("object_id"), F.lit("imports_or_includes").alias("predicate")))


# ---- quality --------------------------------------------------------------------------------------------------------


@query("source_inventory", A.sql("SELECT source_id, path, modality, language, line_count, size_bytes, sha256 FROM sources", "sources"))
def source_inventory(spark, d):
    return A.sources(spark, d).drop("text")


@query("source_findings", A.sql("""SELECT severity, rule, key FROM (SELECT 'WARN' AS severity, 'language' AS rule, source_id AS key FROM sources WHERE language NOT IN ('en', 'de')
  UNION ALL SELECT 'WARN', 'size', source_id FROM sources WHERE size_bytes > 20000)""", "sources"))
def source_findings(spark, d):
    return quality.source_rules(A.sources(spark, d), ["en", "de"]).select("severity", "rule", "key")


@query("foreign_keys", """SELECT 'FAIL' AS severity, 'order_lines' AS rule, CAST(o_orderkey AS VARCHAR) AS key FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL
SELECT 'FAIL', 'customer_orders', CAST(c_custkey AS VARCHAR) FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def foreign_keys(spark, d):
    t = lambda n: A.table(spark, d, n)
    return quality.all_of(quality.missing_parent(t("orders"), "o_orderkey", "o_orderkey", t("lineitem"), "l_orderkey", "order_lines"), quality.missing_parent(t("customer"), "c_custkey", "c_custkey", t("orders"), "o_custkey", "customer_orders")).select("severity", "rule", "key")


@query("duplicate_keys", """SELECT 'FAIL' AS severity, 'repeated_name' AS rule, p_name AS key FROM (SELECT p_name, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS nth FROM part) WHERE nth > 1""")
def duplicate_keys(spark, d):
    return quality.repeated(A.table(spark, d, "part"), "p_name", ["p_partkey"], "repeated_name").select("severity", "rule", "key")


@query("evidence_reuse", """SELECT 'p/' || l_suppkey AS path, CAST(l_linenumber AS VARCHAR) AS lines, count(*) AS n, min(l_orderkey) AS first_case FROM lineitem GROUP BY 1, 2 HAVING count(*) > 90""")
def evidence_reuse(spark, d):
    return quality.reuse(A.table(spark, d, "lineitem").select(F.concat(F.lit("p/"), F.col("l_suppkey").cast("string")).alias("path"), F.col("l_linenumber").cast("string").alias("lines"), F.col("l_orderkey").alias("case_id")), 90)


@query("answer_findings", r"""WITH a AS (SELECT conv_id * 1000 + turn AS key, text FROM conversations WHERE role = 'assistant')
SELECT severity, rule, CAST(key AS VARCHAR) AS key FROM (SELECT 'WARN' AS severity, 'short' AS rule, key FROM a WHERE length(trim(text, ' ')) < 40 UNION ALL SELECT 'FAIL', 'citation', key FROM a WHERE NOT regexp_matches(text, '[A-Za-z0-9_./@+-]+:[0-9]+')
UNION ALL SELECT 'WARN', 'yes_no', key FROM a WHERE regexp_matches(lower(text), '^(yes|no)([^a-z]|$)') UNION ALL SELECT 'WARN', 'refusal', key FROM a WHERE contains(lower(text), 'cannot be determined') OR contains(lower(text), 'not enough evidence') OR contains(lower(text), 'insufficient evidence'))""")
def answer_findings(spark, d):
    own = A.table(spark, d, "conversations").where("role = 'assistant'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("key"), "text")
    return quality.answer_rules(own).select("severity", "rule", "key")


@query("bundle_diff", """SELECT coalesce(a.v, b.v) AS value, coalesce(x, 0) AS n_old, coalesce(y, 0) AS n_new, coalesce(y, 0) - coalesce(x, 0) AS change FROM (SELECT p_type AS v, count(*) AS x FROM part WHERE p_size <= 25 GROUP BY 1) a
FULL JOIN (SELECT p_type AS v, count(*) AS y FROM part WHERE p_size > 25 GROUP BY 1) b ON a.v = b.v""")
def bundle_diff(spark, d):
    part = A.table(spark, d, "part")
    return quality.bundle_diff(part.where("p_size <= 25"), part.where("p_size > 25"), "p_type")


# ---- incremental ----------------------------------------------------------------------------------------------------


@query("change_classification", """WITH o AS (SELECT c_custkey AS k, c_acctbal AS h, length(c_mktsegment) AS s FROM customer WHERE c_custkey % 10 <> 1), n AS (SELECT c_custkey AS k, CASE WHEN c_custkey % 3 = 0 THEN c_acctbal + 1 ELSE c_acctbal END AS h, length(c_mktsegment) + CAST(c_custkey % 2 AS INT) AS s FROM customer WHERE c_custkey % 10 <> 2)
SELECT change, count(*) AS n FROM (SELECT CASE WHEN o.k IS NULL THEN 'added' WHEN n.k IS NULL THEN 'removed' WHEN o.s = n.s THEN 'unchanged' WHEN o.h <> n.h THEN 'modified' ELSE 'touched' END AS change FROM o FULL JOIN n ON o.k = n.k) GROUP BY 1""")
def change_classification(spark, d):
    k = F.col("c_custkey")
    one = A.table(spark, d, "customer").select(k.cast("string").alias("path"), F.col("c_acctbal").alias("content_hash"), F.length("c_mktsegment").alias("size"), F.lit(0).alias("modified_at"), k)
    new = one.withColumns({"content_hash": F.when(k % 3 == 0, F.col("content_hash") + 1).otherwise(F.col("content_hash")), "size": F.col("size") + (k % 2).cast("int")})
    return sync.classify(one.where(k % 10 != 1), new.where(k % 10 != 2)).groupBy("change").agg(F.count(F.lit(1)).alias("n"))


@query("event_bursts", """WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER w + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)), s AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS burst FROM g)
SELECT user_id, n, count(*) AS bursts FROM (SELECT user_id, burst, count(*) AS n FROM s GROUP BY 1, 2) GROUP BY 1, 2""")
def event_bursts(spark, d):
    return sync.bursts(A.table(spark, d, "events"), "6 hours", "user_id").groupBy("user_id", "n").agg(F.count(F.lit(1)).alias("bursts"))


@query("pending_files", """SELECT CAST(user_id AS VARCHAR) AS path, min(event_id) AS first_event, max(event_id) AS last_event, count(*) AS n FROM events GROUP BY 1""")
def pending_files(spark, d):
    ev = A.table(spark, d, "events")
    return sync.pending_files(ev.select(F.col("user_id").cast("string").alias("path"), F.col("event_id").alias("ts"))).select("path", F.col("first_seen").alias("first_event"), F.col("last_seen").alias("last_event"), "n")


@query("snippets", A.sql("""SELECT source_id AS key, CASE WHEN j = '' THEN '(blank lines)' WHEN length(j) > 180 THEN rtrim(substr(j, 1, 177), ' ') || '...' ELSE j END AS snippet FROM (
  SELECT source_id, coalesce(string_agg(t, ' / ' ORDER BY line) FILTER (t <> ''), '') AS j FROM (SELECT source_id, line, trim(regexp_replace(text, '\\s+', ' ', 'g'), ' ') AS t FROM lines WHERE line <= 3) GROUP BY 1)""".replace("\\\\", "\\"), "lines"))
def snippets(spark, d):
    own = A.sources(spark, d)
    return bundle.snippets(own, own.select(F.col("source_id").alias("key"), "source_id", F.lit(1).alias("start"), F.lit(3).alias("end")), compact=True)


# ---- export and assembly --------------------------------------------------------------------------------------------


@query("capped_by_file", A.sql("""SELECT file_path, id FROM (SELECT file_path, id, row_number() OVER (PARTITION BY file_path ORDER BY CASE kind WHEN 'module' THEN 0 ELSE 1 END, id) AS nth FROM nodes) WHERE nth <= 5""", "nodes"))
def capped_by_file(spark, d):
    return assembly.capped(A.nodes(spark, d), ["file_path"], [F.when(F.col("kind") == "module", 0).otherwise(1), "id"], 5).select("file_path", "id")


@query("signals_for_rows", """SELECT DISTINCT l_orderkey AS case_id, p_partkey AS signal_id FROM lineitem JOIN part ON (p_partkey % 100 = l_suppkey % 100 AND p_size = l_linenumber)
UNION SELECT l_orderkey, p_partkey FROM lineitem JOIN part ON p_partkey = l_partkey""")
def signals_for_rows(spark, d):
    key = lambda a, b: F.concat_ws("/", (F.col(a) % 100).cast("string"), F.col(b).cast("string"))
    rows = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("case_id"), key("l_suppkey", "l_linenumber").alias("source_id"), F.col("l_partkey").alias("path"))
    return assembly.signals_for_rows(rows, A.table(spark, d, "part").select(key("p_partkey", "p_size").alias("source_id"), F.col("p_partkey").alias("path"), F.col("p_partkey").alias("signal_id")))


@query("claim_findings", """SELECT o_orderkey AS case_id, o_custkey AS signal_id, CASE WHEN c_custkey IS NULL THEN 'UNKNOWN_CLAIM_SOURCE_SIGNAL' ELSE 'CLAIM_SOURCE_SIGNAL_MISMATCH' END AS code FROM orders
LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 7 <> 0) ON o_custkey = c_custkey WHERE c_custkey IS NULL OR o_orderkey % 5 <> c_nationkey % 5 OR c_mktsegment <> 'BUILDING' OR o_orderkey % 2 <> c_custkey % 2""")
def claim_findings(spark, d):
    claims = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id"), F.col("o_custkey").alias("signal_id"), (F.col("o_orderkey") % 2).alias("project"), (F.col("o_orderkey") % 5).alias("axis"), F.lit("BUILDING").alias("attribute"))
    sig = A.table(spark, d, "customer").where("c_custkey % 7 <> 0").select(F.col("c_custkey").alias("signal_id"), (F.col("c_custkey") % 2).alias("project"), (F.col("c_nationkey") % 5).alias("axis"), F.col("c_mktsegment").alias("attribute"))
    return assembly.claim_findings(claims, sig)


@query("implements_edges", """WITH m AS (SELECT DISTINCT l_suppkey AS t, p_type AS name FROM lineitem JOIN part ON l_partkey = p_partkey), i AS (SELECT DISTINCT s_nationkey AS i, p_type AS name FROM supplier JOIN part ON p_partkey % 25 = s_nationkey)
SELECT t AS type, i + 100000 AS interface FROM m JOIN i USING (name) GROUP BY t, i HAVING count(*) = (SELECT count(*) FROM i x WHERE x.i = i.i)""")
def implements_edges(spark, d):
    t = lambda n: A.table(spark, d, n)
    m = t("lineitem").join(t("part"), F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_suppkey").alias("owner"), F.col("p_type").alias("name"))
    i = t("supplier").join(t("part"), F.col("p_partkey") % 25 == F.col("s_nationkey")).select((F.col("s_nationkey") + 100000).alias("owner"), F.col("p_type").alias("name"))
    return assembly.implements(m, i)


@query("rubric_atoms", """SELECT l_orderkey AS case_id, 'A' || p AS atom_id, CASE WHEN p = 1 THEN 'conclusion' ELSE 'support' END AS role, CASE WHEN p = 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight, CASE WHEN l_orderkey % 3 = 0 AND p > 1 THEN 'A' || (p - 1) END AS depends_on
FROM (SELECT l_orderkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_partkey, l_suppkey, l_linenumber) AS p FROM lineitem)""")
def rubric_atoms(spark, d):
    from pyspark.sql import Window

    nth = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_partkey", "l_suppkey", "l_linenumber"))
    return assembly.rubric_atoms(A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.when(F.col("l_orderkey") % 3 == 0, "L3").otherwise("L1").alias("layer"), nth.alias("position")))


@query("case_coverage", """SELECT k AS case_id, concat_ws(',', CASE WHEN max(a) = 0 THEN 'candidates' END, CASE WHEN max(b) = 0 THEN 'claims' END) AS missing FROM (SELECT o_orderkey AS k, 1 AS a, 0 AS b FROM orders UNION ALL SELECT l_orderkey, 0, 1 FROM lineitem WHERE l_quantity > 30) GROUP BY 1""")
def case_coverage(spark, d):
    return assembly.case_coverage({"candidates": A.table(spark, d, "orders").select(F.col("o_orderkey").alias("case_id")), "claims": A.table(spark, d, "lineitem").where("l_quantity > 30").select(F.col("l_orderkey").alias("case_id"))})
