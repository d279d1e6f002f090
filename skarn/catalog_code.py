"""Queries of code graphs: export as a bundle, lookups, ranking, context, changes."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import catalog
from .functions import scalars as S
from .operators import assembly, context, corpora, export, gates, graph, search
from .plans import adapters as A
from .plans import rows as R
from .registry import query
from .sources import bundle


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


# ---- export ---------------------------------------------------------------------------------------------------------

_MODALITY = "CASE " + " ".join(f"WHEN lower(language) IN {_in(v.split())} THEN '{k}'" for k, v in export.MODALITIES.items()) + " ELSE 'unknown' END"
A.CTES["src"] = f"""src AS (SELECT 'src_demo_' || lpad('' || row_number() OVER (ORDER BY path), 5, '0') AS source_id, path AS file_path, substr(path, 7) AS relative_path, 'repo_sources/repo/' || substr(path, 7) AS path, language, {_MODALITY} AS modality,
  CASE WHEN size > 0 THEN greatest(1, size // 50) ELSE 1 END AS line_count, size AS size_bytes, 'sha256:' || content_hash AS sha256, CASE WHEN errors IS NULL OR errors = '[]' THEN 'parsed' ELSE 'errors' END AS parse_status FROM files)"""
A.CTES["ent"] = """ent AS (SELECT 'ent_demo_' || substr(sha256('demo|' || source_id || '|' || kind || '|' || name || '|' || line_start), 1, 12) AS entity_id, * FROM (
  SELECT id AS node_id, source_id, src.path AS path, name, CASE kind WHEN 'method' THEN 'function' WHEN 'class' THEN CASE WHEN n.language = 'verilog' THEN 'module' ELSE 'class' END ELSE kind END AS kind, CASE WHEN start_line = 0 THEN 1 ELSE start_line END AS line_start,
    CASE WHEN end_line <> 0 THEN end_line WHEN start_line <> 0 THEN start_line ELSE 1 END AS line_end, CASE WHEN qualified_name <> '' AND qualified_name <> name THEN qualified_name END AS qualified_name, nullif(signature, '') AS signature
  FROM code_nodes n JOIN src ON n.file_path = src.file_path WHERE kind NOT IN ('file', 'import')))"""
A.CTES["rel"] = """ends AS (SELECT node_id, 'entity' AS type, entity_id AS id, name FROM ent UNION ALL SELECT n.id, 'source', source_id, regexp_replace(n.id, '^file:', '') FROM code_nodes n JOIN src ON n.file_path = src.file_path WHERE kind = 'file'),
rel AS (SELECT 'rel_demo_' || lpad('' || row_number() OVER (ORDER BY e.id), 7, '0') AS relation_id, s.type AS subject_type, s.id AS subject_id, CASE e.kind WHEN 'imports' THEN 'imports_or_includes' ELSE e.kind END AS predicate, o.type AS object_type, o.id AS object_id,
  source_id AS evidence_source, src.path AS evidence_path, coalesce('' || e.line, '1') AS evidence_lines, n.name || ' ' || CASE e.kind WHEN 'imports' THEN 'imports_or_includes' ELSE e.kind END || ' ' || o.name AS summary, e.id AS edge_id
  FROM code_edges e JOIN ends s ON e.source = s.node_id JOIN ends o ON e.target = o.node_id JOIN code_nodes n ON n.id = e.source JOIN src ON n.file_path = src.file_path)"""
_CODE = ("files", "code_nodes", "code_edges", "src", "ent", "rel")


def _bundle(spark, d):
    nodes, edges = R.code_nodes(spark, d), R.code_edges(spark, d)
    sources = graph.kept(export.source_inventory(R.code_files(spark, d), "demo", "repo", "inner"))
    entities = graph.kept(export.entity_index(nodes, sources, "demo"))
    return nodes, edges, sources, entities


@query("exported_sources", A.sql("SELECT source_id, file_path, relative_path, path, language, modality, CASE modality WHEN 'unknown' THEN 'unknown' ELSE modality || '.source' END AS source_type, line_count, size_bytes, sha256, parse_status FROM src", *_CODE[:4]))
def exported_sources(spark, d):
    return _bundle(spark, d)[2].select("source_id", "file_path", "relative_path", "path", "language", "modality", "source_type", "line_count", "size_bytes", "sha256", "parse_status")


@query("entity_index", A.sql("SELECT * FROM ent", *_CODE[:5]))
def entity_index(spark, d):
    return _bundle(spark, d)[3].drop("confidence")


def _relations(spark, d):
    nodes, edges, sources, entities = _bundle(spark, d)
    return export.relation_graph(nodes, edges, sources, entities, "demo")


@query("relation_graph", A.sql("SELECT * EXCLUDE (edge_id) FROM rel", *_CODE))
def relation_graph(spark, d):
    e = F.get("evidence", F.lit(0))
    return _relations(spark, d).select("relation_id", F.col("subject.type").alias("subject_type"), F.col("subject.id").alias("subject_id"), "predicate", F.col("object.type").alias("object_type"), F.col("object.id").alias("object_id"), e["source_id"].alias("evidence_source"), e["path"].alias("evidence_path"), e["lines"].alias("evidence_lines"), e["summary"].alias("summary"))


@query("predicate_counts", A.sql("SELECT p AS predicate, n_edges, coalesce(n_kept, 0) AS n_kept, n_edges - coalesce(n_kept, 0) AS n_dropped FROM (SELECT CASE kind WHEN 'imports' THEN 'imports_or_includes' ELSE kind END AS p, count(*) AS n_edges FROM code_edges GROUP BY 1) LEFT JOIN (SELECT predicate AS p, count(*) AS n_kept FROM rel GROUP BY 1) USING (p)", *_CODE))
def predicate_counts(spark, d):
    return export.predicate_counts(R.code_edges(spark, d), _relations(spark, d))


@query("most_used_entities", A.sql("SELECT name, n FROM (SELECT target, count(*) AS n, min(id) AS first FROM code_edges GROUP BY 1) JOIN ent ON target = node_id ORDER BY n DESC, first LIMIT 5", *_CODE))
def most_used_entities(spark, d):
    _, edges, _, entities = _bundle(spark, d)
    return export.most_used(edges, entities)


@query("entity_kinds", A.sql("SELECT kind, count(*) AS n FROM ent GROUP BY 1 ORDER BY n DESC, min(node_id) LIMIT 8", *_CODE))
def entity_kinds(spark, d):
    return export.kinds_of(_bundle(spark, d)[3])


@query("manifest", A.sql("SELECT 'project-manifest/v1' AS schema_version, '2024-01-01T00:00:00Z' AS created_at, 'demo' AS project, 'Demo' AS display_name, (SELECT count(*) FROM src) AS sources, (SELECT count(*) FROM ent) AS entities, (SELECT count(*) FROM rel) AS relations, (SELECT '{' || string_agg('\"' || predicate || '\":' || n, ',' ORDER BY predicate) || '}' FROM (SELECT predicate, count(*) AS n FROM rel GROUP BY 1)) AS relations_by_predicate, 'pin' AS pin, '1.2' AS indexed_with_version", *_CODE).replace('\\"', '"'))
def manifest(spark, d):
    nodes, edges, sources, entities = _bundle(spark, d)
    meta = spark.createDataFrame([("indexed_with_version", "1.2"), ("other", "x")], "key string, value string")
    return export.manifest(sources, entities, export.relation_graph(nodes, edges, sources, entities, "demo"), meta, "demo", "2024-01-01T00:00:00Z", "pin")


@query("file_scan", A.sql("SELECT path, content_hash, language, size, modified_at, indexed_at, errors FROM files", "files"))
def file_scan(spark, d):
    return R.code_files(spark, d).drop("doc_id").orderBy("path")


@query("edge_scan", A.sql("SELECT id, source, target, kind, line FROM code_edges", "files", "code_edges"))
def edge_scan(spark, d):
    return R.code_edges(spark, d).orderBy("id")


@query("latest_index", A.sql("SELECT max(indexed_at) AS indexed_at FROM files", "files"))
def latest_index(spark, d):
    return R.code_files(spark, d).agg(F.max("indexed_at").alias("indexed_at"))


@query("row_counts", A.sql("SELECT 'files' AS name, count(*) AS n FROM files UNION ALL SELECT 'nodes', count(*) FROM code_nodes UNION ALL SELECT 'edges', count(*) FROM code_edges", *_CODE[:3]))
def row_counts(spark, d):
    return export.row_counts({"files": R.code_files(spark, d), "nodes": R.code_nodes(spark, d), "edges": R.code_edges(spark, d)})


@query("first_substantive_lines", A.sql("SELECT source_id, CAST(coalesce(min(line) FILTER (NOT regexp_matches(text, '" + export.NOT_SUBSTANTIVE + "')), 1) AS INT) AS line FROM (SELECT source_id, line, CASE line WHEN 1 THEN '// ' || text WHEN 2 THEN '  * ' || text ELSE text END AS text FROM lines) GROUP BY 1", "lines"))
def first_substantive_lines(spark, d):
    n = F.col("line")
    own = A.lines(spark, d).withColumn("text", F.when(n == 1, F.concat(F.lit("// "), "text")).when(n == 2, F.concat(F.lit("  * "), "text")).otherwise(F.col("text")))
    return export.first_substantive_line(own)


@query("first_declarations", A.sql("""WITH x AS (SELECT source_id, line, CASE line WHEN 1 THEN '/* ' || text WHEN 2 THEN text || ' */' WHEN 3 THEN '# ' || text ELSE text END AS text, count(*) OVER (PARTITION BY source_id) AS n FROM lines),
y AS (SELECT *, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS t FROM x)
SELECT source_id, CAST(min(line) AS INT) AS line FROM y WHERE line > 2 AND t <> '' AND NOT regexp_matches(t, '^(//|#|--|\\*)') AND NOT starts_with(t, '/*') AND NOT regexp_matches(text, '^\\s*(`ifndef|`endif|#ifndef|#endif)|^\\s*(`define|#define)\\S*(\\s+\\S+)?\\s*$') AND NOT regexp_matches(text, '^\\s*(`include|#include)') GROUP BY 1""".replace("\\\\", "\\"), "lines"))
def first_declarations(spark, d):
    """Every source's first two lines are a block comment, its third a comment."""
    n = F.col("line")
    text = F.when(n == 1, F.concat(F.lit("/* "), "text")).when(n == 2, F.concat("text", F.lit(" */"))).when(n == 3, F.concat(F.lit("# "), "text")).otherwise(F.col("text"))
    return corpora.first_declaration(A.lines(spark, d).withColumn("text", text))


# ---- lookups --------------------------------------------------------------------------------------------------------


@query("nodes_of_file", A.sql("SELECT id, start_line FROM nodes WHERE file_path = 'NATION_3'", "nodes"))
def nodes_of_file(spark, d):
    return A.nodes(spark, d).where("file_path = 'NATION_3'").orderBy("start_line", "id").select("id", "start_line")


@query("nodes_by_name", A.sql("SELECT 'kind' AS how, id FROM nodes WHERE kind = 'module' UNION ALL SELECT 'name', id FROM nodes WHERE name = 'red widget' UNION ALL SELECT 'qualified', id FROM nodes WHERE qualified_name = 'Brand#13::cold widget' UNION ALL SELECT 'lower', id FROM nodes WHERE lower(name) = 'customer#000000007'", "nodes"))
def nodes_by_name(spark, d):
    n = A.nodes(spark, d)
    found = {"kind": F.col("kind") == "module", "name": F.col("name") == "red widget", "qualified": F.col("qualified_name") == "Brand#13::cold widget", "lower": F.lower("name") == "customer#000000007"}
    how = F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in found.items()]))
    return n.select(F.explode(how).alias("how"), "id")


@query("nodes_by_id", A.sql("SELECT id, name FROM nodes WHERE id IN ('class:3', 'function:9', 'module:1')", "nodes"))
def nodes_by_id(spark, d):
    n = A.nodes(spark, d)
    return n.join(F.broadcast(graph.ids(n, ["class:3", "function:9", "module:1", "none"])), "id", "left_semi").select("id", "name")


@query("distinct_names", A.sql("SELECT DISTINCT name FROM nodes", "nodes"))
def distinct_names(spark, d):
    return A.nodes(spark, d).select("name").distinct()


@query("glob_nodes", A.sql(r"SELECT id FROM nodes WHERE kind IN ('class', 'function') AND regexp_full_match(qualified_name, 'NATION_1.*::Customer#0.*[0-9]')", "nodes"))
def glob_nodes(spark, d):
    return A.nodes(spark, d).where(F.col("kind").isin("class", "function") & F.col("qualified_name").rlike(S.glob_pattern("NATION_1*::Customer#0*")) & F.col("qualified_name").rlike("[0-9]$")).select("id")


@query("usages", A.sql("SELECT e.target AS id, source, e.kind AS kind, n.name AS name FROM edges e JOIN nodes n ON source = n.id WHERE e.target IN ('class:7', 'function:12')", "nodes", "edges"))
def usages(spark, d):
    e, n = A.edges(spark, d), A.nodes(spark, d).select(F.col("id").alias("source"), "name")
    own = e.join(F.broadcast(graph.ids(e, ["class:7", "function:12"])).withColumnRenamed("id", "target"), "target", "left_semi")
    return own.join(n, "source").select(F.col("target").alias("id"), "source", "kind", "name")


@query("children", A.sql("SELECT source AS id, target AS child FROM edges WHERE kind = 'contains'", "edges"))
def children(spark, d):
    return A.edges(spark, d).where("kind = 'contains'").select(F.col("source").alias("id"), F.col("target").alias("child"))


# ---- graph ----------------------------------------------------------------------------------------------------------


@query("node_context", A.sql("""WITH f AS (SELECT unnest(['class:3', 'function:12', 'interface:5']) AS id), p AS (SELECT target AS child, min(source) AS parent FROM edges WHERE kind = 'contains' GROUP BY 1),
a AS (SELECT id, parent FROM f JOIN p ON child = id UNION ALL SELECT id, q.parent FROM f JOIN p ON p.child = id JOIN p q ON q.child = p.parent)
SELECT id, 'ancestor' AS role, parent AS other, 'contains' AS kind FROM a UNION ALL SELECT id, 'child', target, kind FROM f JOIN edges ON source = id WHERE kind = 'contains' UNION ALL SELECT id, 'incoming', source, kind FROM f JOIN edges ON target = id WHERE kind <> 'contains' UNION ALL SELECT id, 'outgoing', target, kind FROM f JOIN edges ON source = id WHERE kind <> 'contains'""", "edges"))
def node_context(spark, d):
    e = A.edges(spark, d)
    return graph.node_context(A.nodes(spark, d), e, graph.ids(e, ["class:3", "function:12", "interface:5"]))


@query("definitions_impact", A.sql("""SELECT root, id, CAST(min(depth) AS INT) AS depth FROM (SELECT n.id AS root, n.id AS id, 0 AS depth FROM nodes n WHERE lower(name) = 'red widget' UNION ALL SELECT n.id, source, 1 FROM nodes n JOIN edges e ON e.target = n.id AND e.kind <> 'contains' WHERE lower(n.name) = 'red widget') GROUP BY 1, 2""", "nodes", "edges"))
def definitions_impact(spark, d):
    return graph.definitions_impact(A.nodes(spark, d), A.edges(spark, d), "Red Widget", 1)


@query("united_impact", A.sql("SELECT DISTINCT source, target, edges.kind AS kind FROM edges JOIN nodes n ON target = n.id WHERE lower(n.name) = 'red widget' AND edges.kind <> 'contains'", "nodes", "edges"))
def united_impact(spark, d):
    own = A.nodes(spark, d).where("lower(name) = 'red widget'").select(F.col("id").alias("target"))
    return A.edges(spark, d).where("kind <> 'contains'").join(own, "target").select("source", "target", "kind").dropDuplicates(["source", "target", "kind"])


_ROUTES = "routes AS (SELECT * REPLACE (CASE kind WHEN 'method' THEN 'route' ELSE kind END AS kind, CASE kind WHEN 'method' THEN 'routes/' || language ELSE file_path END AS file_path) FROM nodes)"


def _routes(spark, d):
    """Orders as routes, in files by their status."""
    route = F.col("kind") == "method"
    return A.nodes(spark, d).withColumn("file_path", F.when(route, F.concat(F.lit("routes/"), "language")).otherwise(F.col("file_path"))).withColumn("kind", F.when(route, "route").otherwise(F.col("kind")))


@query("top_route_file", A.sql(f"WITH {_ROUTES}, c AS (SELECT file_path, count(*) AS n FROM routes WHERE kind = 'route' GROUP BY 1 ORDER BY n DESC, 1 LIMIT 20), t AS (SELECT *, CAST(sum(n) OVER () AS BIGINT) AS total FROM c ORDER BY n DESC, file_path LIMIT 1) SELECT * FROM t WHERE n >= 3 AND total >= 3 AND n / total >= 0.3", "nodes"))
def top_route_file(spark, d):
    return graph.top_route_file(_routes(spark, d), S.is_low_value_file(F.col("file_path")))


@query("routing_manifest", A.sql(f"WITH {_ROUTES} SELECT r.name AS url, h.name AS handler, h.file_path AS handler_file, h.start_line AS handler_line, h.kind AS handler_kind FROM routes r JOIN edges e ON e.source = r.id JOIN routes h ON e.target = h.id WHERE r.kind = 'route' AND e.kind IN ('references', 'calls') AND h.kind IN ('function', 'method', 'class') ORDER BY r.file_path, r.start_line, r.id, h.id LIMIT 40", "nodes", "edges"))
def routing_manifest(spark, d):
    return graph.routing_manifest(_routes(spark, d), A.edges(spark, d), S.is_low_value_file(F.col("file_path")))


@query("promoted_edges", A.sql("SELECT source, target, CASE kind WHEN 'instantiates' THEN 'implements' WHEN 'calls' THEN 'extends' WHEN 'references' THEN 'references' ELSE kind END AS kind FROM edges", "edges"))
def promoted_edges(spark, d):
    """Instantiations are taken for extensions of interfaces, calls for extensions of functions, references for callbacks."""
    e = A.edges(spark, d)
    own = e.withColumn("kind", F.when(F.col("kind").isin("instantiates", "calls"), "extends").when(F.col("kind") == "references", "function_ref").otherwise(F.col("kind"))).select("source", "target", "kind")
    return search.promoted(own, A.nodes(spark, d))


# ---- names and paths ------------------------------------------------------------------------------------------------

_STEMS = """CASE WHEN ends_with(w, 'ing') AND n > 5 THEN [w[:-4], w[:-4] || 'e', CASE WHEN w[-4] = w[-5] THEN w[:-5] END] ELSE [] END || CASE WHEN (ends_with(w, 'tion') OR ends_with(w, 'sion')) AND n > 5 THEN [w[:-4]] ELSE [] END || CASE WHEN ends_with(w, 'ment') AND n > 6 THEN [w[:-5]] ELSE [] END
|| CASE WHEN ends_with(w, 'ies') AND n > 4 THEN [w[:-4] || 'y'] WHEN ends_with(w, 'es') AND n > 4 THEN [w[:-3]] WHEN ends_with(w, 's') AND NOT ends_with(w, 'ss') AND n > 4 THEN [w[:-2]] ELSE [] END
|| CASE WHEN ends_with(w, 'ed') AND NOT ends_with(w, 'eed') AND n > 4 THEN [w[:-2], w[:-3], CASE WHEN ends_with(w, 'ied') AND n > 5 THEN w[:-4] || 'y' END] ELSE [] END || CASE WHEN ends_with(w, 'er') AND n > 4 THEN [w[:-3], w[:-3] || 'e', CASE WHEN w[-3] = w[-4] THEN w[:-4] END] ELSE [] END"""


@query("stem_variants", "SELECT w AS word, array_to_string(list_sort(list_distinct(list_filter(" + _STEMS + ", lambda x: x IS NOT NULL AND length(x) >= 3 AND x <> w))), ',') AS stems FROM (SELECT w, length(w) AS n FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[a-z]+')) AS w FROM benchmark))")
def stem_variants(spark, d):
    words = A.table(spark, d, "benchmark").select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]+)"), F.lit(1))).alias("word")).distinct()
    return words.select("word", F.array_join(F.array_sort(S.stems(F.col("word"))), ",").alias("stems"))


A.CTES["paths"] = "paths AS (SELECT doc_id, CASE doc_id % 12 WHEN 0 THEN 'test/' WHEN 1 THEN 'src/jvmTest/' WHEN 2 THEN 'a/examples/' WHEN 3 THEN 'latest/' WHEN 4 THEN 'pkg/testing/' WHEN 5 THEN 'Docs/Manual/' ELSE 'src/' || source || '/' END || CASE doc_id % 11 WHEN 0 THEN 'foo_test.go' WHEN 1 THEN 'FooTest.kt' WHEN 2 THEN 'a.pb.go' WHEN 3 THEN 'mock_x.go' WHEN 4 THEN 'test_a.py' WHEN 5 THEN 'BarGrpc.java' WHEN 6 THEN 'x.spec.ts' WHEN 7 THEN 'readme.md' WHEN 8 THEN 'Makefile' WHEN 9 THEN 'rtl_unit.sv' ELSE 'get_user_name.c' END AS path FROM documents)"


def _paths(spark, d):
    k = F.col("doc_id")
    folder = F.when(k % 12 == 0, "test/").when(k % 12 == 1, "src/jvmTest/").when(k % 12 == 2, "a/examples/").when(k % 12 == 3, "latest/").when(k % 12 == 4, "pkg/testing/").when(k % 12 == 5, "Docs/Manual/").otherwise(F.concat(F.lit("src/"), "source", F.lit("/")))
    names = ["foo_test.go", "FooTest.kt", "a.pb.go", "mock_x.go", "test_a.py", "BarGrpc.java", "x.spec.ts", "readme.md", "Makefile", "rtl_unit.sv", "get_user_name.c"]
    return A.table(spark, d, "documents").select("doc_id", F.concat(folder, F.get(F.array(*map(F.lit, names)), (k % 11).cast("int"))).alias("path"))


_BASE, _LOW = "regexp_extract(path, '[^/]*$')", "lower(path)"
_IS_TEST = f"(regexp_matches(lower({_BASE}), '{S.TEST_NAME}') OR regexp_matches({_BASE}, '{S.TEST_NAME_CASED}') OR regexp_matches({_LOW}, '{S.TEST_FOLDER}') OR regexp_matches(path, '{S.TEST_FOLDER_CASED}'))"
_DOC = f"(regexp_matches({_LOW}, '{gates.DOC_SUFFIX}') OR regexp_matches({_LOW}, '{gates.DOC_HINT}'))"


@query("path_classes", A.sql(f"SELECT doc_id, path, {_IS_TEST} AS is_test, regexp_matches({_LOW}, '{S.LOW_VALUE}') OR regexp_matches(path, '{S.GENERATED}') AS is_low_value, {_DOC} AS is_doc, regexp_matches({_LOW}, '{gates.CODE_SUFFIX}') OR (regexp_matches({_LOW}, '{gates.CODE_HINT}') AND NOT {_DOC}) AS is_code FROM paths", "paths"))
def path_classes(spark, d):
    p = F.col("path")
    return _paths(spark, d).select("doc_id", "path", S.is_test_file(p).alias("is_test"), S.is_low_value_file(p).alias("is_low_value"), gates.is_doc(p).alias("is_doc"), gates.is_code(p).alias("is_code"))


_DIR = "lower(CASE WHEN contains(path, '/') THEN regexp_replace(path, '/[^/]*$', '') ELSE '.' END)"


def _word_score(*parts: str) -> str:
    hit = lambda c: "(" + " OR ".join(f"contains({c}, '{t}')" for t in parts) + ")"
    return f"CASE WHEN {hit('lower(' + _BASE + ')')} THEN 10 ELSE 0 END + CASE WHEN {hit(_DIR)} THEN 5 WHEN {hit(_LOW)} THEN 3 ELSE 0 END"


@query("path_scores", A.sql(f"SELECT doc_id, {_word_score('getusername', 'get', 'user', 'name')} + {_word_score('src')} - CASE WHEN {_IS_TEST} THEN 15 ELSE 0 END AS score FROM paths", "paths"))
def path_scores(spark, d):
    return _paths(spark, d).select("doc_id", S.path_relevance(F.col("path"), "getUserName src SuperProject", ("superproject",)).alias("score"))


@query("name_tokens", A.sql("SELECT DISTINCT name, regexp_replace(lower(name), '[^a-z0-9]', '', 'g') AS token FROM nodes", "nodes"))
def name_tokens(spark, d):
    return A.nodes(spark, d).select("name", S.name_token(F.col("name")).alias("token")).distinct()


@query("truncated_texts", "SELECT doc_id, CASE WHEN length(t) > 80 THEN rtrim(substr(t, 1, 77), ' ') || '...' ELSE t END AS text, CAST(floor(n_chars / 7.0 + 0.5) AS BIGINT) AS half_up, CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars / 2 AS BIGINT) END AS whole FROM (SELECT doc_id, n_chars, trim(regexp_replace(coalesce(text, ''), '\\s+', ' ', 'g'), ' ') AS t FROM documents)")
def truncated_texts(spark, d):
    return A.table(spark, d, "documents").select("doc_id", S.truncated(F.col("text"), 80).alias("text"), S.half_up(F.col("n_chars") / 7.0).cast("long").alias("half_up"), S.whole_number(F.col("n_chars") / 2.0).alias("whole"))


@query("query_surfaces", "SELECT conv_id, turn, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '[A-Za-z_][A-Za-z0-9_]*', 'X', 'g'), '[一-鿿]+', 'C', 'g'), '[0-9]+', '0', 'g'), '\\s+', ' ', 'g')) AS surface FROM conversations")
def query_surfaces(spark, d):
    return A.table(spark, d, "conversations").select("conv_id", "turn", S.query_surface(F.col("text")).alias("surface"))


@query("distinctive_tokens", "SELECT name, regexp_matches(name, '[_0-9]') OR regexp_matches(substr(name, 2), '[A-Z]') AS distinctive FROM (SELECT DISTINCT p_type AS name FROM part UNION SELECT DISTINCT p_name FROM part UNION SELECT c_name FROM customer)")
def distinctive_tokens(spark, d):
    t = lambda n, c: A.table(spark, d, n).select(F.col(c).alias("name"))
    every = t("part", "p_type").union(t("part", "p_name")).union(t("customer", "c_name")).distinct()
    return every.select("name", (F.col("name").rlike("[_0-9]") | F.expr("substr(name, 2)").rlike("[A-Z]")).alias("distinctive"))


# ---- ranking and context --------------------------------------------------------------------------------------------

_NAMED = "own AS (SELECT *, lower(name) AS low FROM nodes WHERE lower(name) IN ('red widget', 'customer#000000007', 'nation_3')), spread AS (SELECT low FROM own GROUP BY 1 HAVING count(DISTINCT file_path) < 10), core AS (SELECT DISTINCT file_path FROM own JOIN spread USING (low))"


@query("exact_names", A.sql(f"""WITH {_NAMED}, few AS (SELECT * FROM own QUALIFY row_number() OVER (PARTITION BY low ORDER BY id) <= 51), s AS (SELECT *, CASE WHEN file_path IN (SELECT file_path FROM core) THEN 21.0 ELSE 1.0 END AS score FROM few),
k AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY low ORDER BY score DESC, id) <= 17)
SELECT id, name, file_path, CAST(score AS DOUBLE) AS score FROM k ORDER BY score DESC, id LIMIT 50""", "nodes"))
def exact_names(spark, d):
    return context.exact_names(A.nodes(spark, d), ["Red Widget", "Customer#000000007", "NATION_3"])


@query("names_containing", A.sql("SELECT id, name FROM nodes WHERE contains(lower(name), 'widget') AND NOT starts_with(lower(name), 'widget') ORDER BY length(name), id LIMIT 30", "nodes"))
def names_containing(spark, d):
    return context.names_containing(A.nodes(spark, d), "Widget", inside_only=True)


_RESULTS = "res AS (SELECT id, kind, name, file_path, CAST(start_line AS DOUBLE) AS score, kind = 'function' AND start_line % 3 = 0 AS exact FROM nodes)"


def _results(spark, d):
    return A.nodes(spark, d).select("id", "kind", "name", "file_path", F.col("start_line").cast("double").alias("score"), ((F.col("kind") == "function") & (F.col("start_line") % 3 == 0)).alias("exact"))


def _term(*terms: str) -> str:
    folders = "string_split(lower(CASE WHEN contains(file_path, '/') THEN regexp_replace(file_path, '/[^/]*$', '') ELSE '.' END), '/')"
    return "(" + " OR ".join(f"contains(lower(name), '{t}') OR list_contains({folders}, '{t}')" for t in terms) + ")"


_MET = f"CAST({_term('widget')} AS INT) + CAST({_term('orders', 'order')} AS INT) + CAST({_term('red')} AS INT)"


@query("reranked_results", A.sql(f"WITH {_RESULTS} SELECT id, round(score * CASE WHEN {_MET} >= 2 THEN 1 + 0.5 * ({_MET}) WHEN exact THEN 0.3 ELSE 0.6 END, 6) AS score FROM res", "nodes"))
def reranked_results(spark, d):
    return context.reranked(_results(spark, d), "red widget orders", F.col("exact")).select("id", F.round("score", 6).alias("score"))


@query("core_boosted_results", A.sql(f"WITH {_RESULTS} SELECT id, score + CASE WHEN starts_with(file_path, 'orders/') THEN 25 ELSE 0 END AS score FROM res", "nodes"))
def core_boosted_results(spark, d):
    lead = spark.createDataFrame([(1, "orders/x", 90), (2, "other/y", 30)], "rank int, file_path string, n int")
    return context.core_boosted(_results(spark, d), lead).select("id", "score")


@query("dampened_results", A.sql(f"WITH {_RESULTS}, t AS (SELECT id, score, CASE WHEN kind = 'method' THEN 'tests/' || file_path ELSE file_path END AS path FROM res) SELECT id, round(score * CASE WHEN {_IS_TEST} THEN 0.3 ELSE 1 END, 6) AS score FROM t", "nodes"))
def dampened_results(spark, d):
    own = _results(spark, d).withColumn("file_path", F.when(F.col("kind") == "method", F.concat(F.lit("tests/"), "file_path")).otherwise(F.col("file_path")))
    return context.without_tests(own, "red widget").select("id", F.round("score", 6).alias("score"))


@query("search_confidence", A.sql(f"WITH {_RESULTS} SELECT CASE WHEN count(*) > 0 AND NOT coalesce(bool_or(CAST({_term('zebra')} AS INT) + CAST({_term('widget')} AS INT) >= 2), FALSE) THEN 'low' ELSE 'high' END AS confidence FROM res", "nodes"))
def search_confidence(spark, d):
    return context.confidence(_results(spark, d), "zebra widget")


@query("trimmed_nodes", A.sql("""WITH r AS (SELECT 'module:3' AS id), near AS (SELECT target AS id FROM edges JOIN r ON source = r.id UNION SELECT source FROM edges JOIN r ON target = r.id)
SELECT id FROM nodes ORDER BY CASE WHEN id = 'module:3' THEN 0 WHEN id IN (SELECT id FROM near) THEN 1 ELSE 2 END, id LIMIT 60""", "nodes", "edges"))
def trimmed_nodes(spark, d):
    n, e = A.nodes(spark, d), A.edges(spark, d)
    return context.trimmed(n.select("id"), e, graph.ids(n, ["module:3"]), 60)


_PRIORITY = "CASE WHEN kind IN ('class', 'interface', 'struct', 'trait', 'protocol', 'enum') THEN 3 WHEN kind IN ('method', 'function') THEN 1 ELSE 0 END"


@query("capped_nodes", A.sql(f"""WITH f AS (SELECT id, kind, CASE WHEN kind = 'method' THEN 'tests/' || file_path ELSE file_path END AS path FROM nodes), a AS (SELECT *, {_IS_TEST} AS other FROM f QUALIFY row_number() OVER (PARTITION BY path ORDER BY CASE WHEN id = 'module:3' THEN 10 ELSE 0 END + {_PRIORITY} DESC, id) <= 6),
b AS (SELECT *, row_number() OVER (PARTITION BY other ORDER BY id) AS nth FROM a) SELECT id FROM b WHERE NOT other OR nth <= 5""", "nodes"))
def capped_nodes(spark, d):
    n = A.nodes(spark, d)
    own = n.select("id", "kind", F.when(F.col("kind") == "method", F.concat(F.lit("tests/"), "file_path")).otherwise(F.col("file_path")).alias("file_path"))
    return context.capped(own, graph.ids(n, ["module:3"]), 30).select("id")


@query("assembled_context")
def assembled_context(spark, d):
    """Nodes of a bounded context and the edges among them; its parts have SQL of their own."""
    n, e = A.nodes(spark, d), A.edges(spark, d)
    nodes, inside = context.assembled(n, e, graph.ids(n, ["function:12", "class:3"]), most=20)
    return nodes.select("id", F.lit("node").alias("what")).unionByName(inside.select("source", F.lit("edge").alias("what")).withColumnRenamed("source", "id"))


@query("search_scores", """WITH f AS (SELECT l_orderkey AS query_id, l_linenumber AS name, min(l_suppkey) AS rank FROM (SELECT * REPLACE (l_suppkey + 1 AS l_suppkey) FROM lineitem) GROUP BY 1, 2), e AS (SELECT o_orderkey AS query_id, i AS position, i + o_orderkey % 3 AS name FROM orders, unnest(range(1, 5)) AS t(i)),
b AS (SELECT e.query_id, position, rank FROM e LEFT JOIN f USING (query_id, name))
SELECT query_id, round(avg(CAST(rank IS NOT NULL AS INT)), 6) AS recall, avg(CAST(rank IS NOT NULL AS INT)) >= 0.5 AS passed, round(coalesce(1.0 / arg_min(rank, position) FILTER (rank IS NOT NULL), 0), 6) AS reciprocal_rank FROM b GROUP BY 1""")
def search_scores(spark, d):
    found = A.table(spark, d, "lineitem").select(F.col("l_orderkey").alias("query_id"), F.col("l_linenumber").cast("long").alias("name"), (F.col("l_suppkey") + 1).alias("rank"))
    wanted = A.table(spark, d, "orders").select(F.col("o_orderkey").alias("query_id"), F.explode(F.sequence(F.lit(1), F.lit(4))).alias("position")).withColumn("name", F.col("position") + F.col("query_id") % 3)
    out = context.search_scores(found, wanted)
    return out.select("query_id", F.round("recall", 6).alias("recall"), "passed", F.round("reciprocal_rank", 6).alias("reciprocal_rank"))


@query("import_definitions", A.sql("""WITH k AS (SELECT id, CASE WHEN kind = 'function' AND start_line % 2 = 0 THEN 'import' ELSE kind END AS kind, CAST(start_line AS DOUBLE) AS score FROM nodes), t AS (SELECT source AS id, min(target) AS target FROM edges WHERE kind = 'instantiates' GROUP BY 1),
m AS (SELECT CASE WHEN k.kind = 'import' THEN coalesce(target, k.id) ELSE k.id END AS id, score FROM k LEFT JOIN t USING (id)) SELECT id, max(score) AS score FROM m GROUP BY 1""", "nodes", "edges"))
def import_definitions(spark, d):
    """Every second function is an import of the suppliers that it instantiates."""
    n = A.nodes(spark, d)
    own = n.select("id", F.when((F.col("kind") == "function") & (F.col("start_line") % 2 == 0), "import").otherwise(F.col("kind")).alias("kind"), "name", "file_path", F.col("start_line").cast("double").alias("score"))
    e = A.edges(spark, d).withColumn("kind", F.when(F.col("kind") == "instantiates", "imports").otherwise(F.col("kind")))
    return context.definitions_for_imports(own, e, n).select("id", "score")


# ---- references -----------------------------------------------------------------------------------------------------


@query("possible_references", A.sql("""WITH refs AS (SELECT 'a' || p_partkey AS ref_id, p_name AS name FROM part UNION ALL SELECT 'b' || s_suppkey, 'NATION_' || s_nationkey || '::' || s_name FROM supplier UNION ALL SELECT 'c' || c_custkey, lower(c_name) FROM customer),
p AS (SELECT ref_id, name AS part FROM refs UNION SELECT ref_id, string_split(name, '::')[1] FROM refs WHERE contains(name, '::') UNION SELECT ref_id, string_split(name, '::')[2] FROM refs WHERE contains(name, '::'))
SELECT DISTINCT ref_id FROM p JOIN nodes ON part = nodes.name""", "nodes"))
def possible_references(spark, d):
    return search.possible(catalog.references(spark, d), A.nodes(spark, d)).select("ref_id")


@query("method_call_targets", A.sql("""WITH refs AS (SELECT 'm' || n_nationkey || '_' || c_custkey AS ref_id, 'nATION_' || n_nationkey AS receiver, c_custkey FROM customer JOIN nation ON c_nationkey = n_nationkey) SELECT ref_id, 'method:' || c_custkey AS target FROM refs""", "nodes"))
def method_call_targets(spark, d):
    """A call on each customer, whose receiver is its nation in lower case, to a method of the customer's number."""
    both = A.table(spark, d, "customer").join(F.broadcast(A.table(spark, d, "nation")), F.col("c_nationkey") == F.col("n_nationkey"))
    key = F.col("c_custkey").cast("string")
    refs = both.select(F.concat(F.lit("m"), F.col("n_nationkey").cast("string"), F.lit("_"), key).alias("ref_id"), F.concat(F.lit("nATION_"), F.col("n_nationkey").cast("string"), F.lit(".c"), key).alias("name"))
    nodes = both.select(F.concat(F.lit("method:"), key).alias("id"), F.lit("method").alias("kind"), F.concat(F.lit("c"), key).alias("name"), F.concat(F.lit("x::"), "n_name", F.lit("::c"), key).alias("qualified_name"))
    return search.method_calls(refs, nodes)


@query("reference_pages", "WITH refs AS (SELECT 'a' || p_partkey AS ref_id, p_name AS name FROM part UNION ALL SELECT 'b' || s_suppkey, s_name FROM supplier UNION ALL SELECT 'c' || c_custkey, lower(c_name) FROM customer) SELECT ref_id FROM refs ORDER BY ref_id LIMIT 40 OFFSET 20")
def reference_pages(spark, d):
    return export.pending_references(catalog.references(spark, d), offset=20, limit=40).select("ref_id")


# ---- changes --------------------------------------------------------------------------------------------------------


@query("without_files", A.sql("""WITH dead AS (SELECT id FROM nodes WHERE file_path IN ('NATION_3', 'orders/1-URGENT')) SELECT 'node' AS what, kind, count(*) AS n FROM nodes WHERE id NOT IN (SELECT id FROM dead) GROUP BY ALL UNION ALL SELECT 'edge', kind, count(*) FROM edges WHERE source NOT IN (SELECT id FROM dead) AND target NOT IN (SELECT id FROM dead) GROUP BY ALL""", "nodes", "edges"))
def without_files(spark, d):
    n, e = A.nodes(spark, d), A.edges(spark, d)
    gone = spark.createDataFrame([("NATION_3",), ("orders/1-URGENT",)], "path string")
    nodes, edges, _ = export.without_files(n, e, catalog.references(spark, d), gone)
    count = lambda df, what: df.groupBy(F.lit(what).alias("what"), "kind").agg(F.count(F.lit(1)).alias("n"))
    return count(nodes, "node").unionByName(count(edges, "edge"))


@query("stale_files", A.sql("SELECT path FROM files WHERE length(path) % 2 = 0", "files"))
def stale_files(spark, d):
    own = R.code_files(spark, d).select("path", "content_hash")
    return export.stale(own, own.select("path", F.when(F.length("path") % 2 == 0, "changed").otherwise(F.col("content_hash")).alias("content_hash")))


@query("upserted_rows", "SELECT c_custkey AS k, CASE WHEN s_suppkey IS NULL THEN c_name ELSE s_name END AS name FROM customer LEFT JOIN supplier ON c_custkey = s_suppkey UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT c_custkey FROM customer)")
def upserted_rows(spark, d):
    t = lambda n, k, v: A.table(spark, d, n).select(F.col(k).alias("k"), F.col(v).alias("name"))
    replaced = export.put(t("customer", "c_custkey", "c_name"), t("supplier", "s_suppkey", "s_name").join(t("customer", "c_custkey", "c_name").select("k"), "k", "left_semi"), "k")
    parts = t("part", "p_partkey", "p_name")
    return export.put_missing(replaced, parts.unionByName(parts.withColumn("name", F.concat(F.lit("z"), "name"))), "k", "name")


@query("numbered_snippets", A.sql("SELECT source_id AS key, coalesce(string_agg(line || ': ' || text, chr(10) ORDER BY line) FILTER (line BETWEEN 2 AND 4), '') AS snippet FROM lines GROUP BY 1", "lines"))
def numbered_snippets(spark, d):
    own = A.sources(spark, d)
    return bundle.snippets(own, own.select(F.col("source_id").alias("key"), "source_id", F.lit(3).alias("start"), F.lit(3).alias("end")), context=1, numbered=True)


@query("covered_kinds", A.sql("SELECT id, CASE kind WHEN 'method' THEN 'function' ELSE kind END AS kind FROM nodes", "nodes"))
def covered_kinds(spark, d):
    return A.nodes(spark, d).select("id", assembly.bundle_kind(F.col("kind"), F.col("language")).alias("kind"))
