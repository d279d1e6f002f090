"""Views of the test tables in the engine's schemas: nodes and edges of a graph, sources and their lines."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, kind, name, qualified_name, file_path, language, start_line, is_exported)."""
    t = lambda n: table(spark, sf_dir, n)

    def shaped(df, kind, key, name, qualified, path, language, exported):
        return df.select(F.concat(F.lit(kind + ":"), F.col(key).cast("string")).alias("id"), F.lit(kind).alias("kind"), name.alias("name"), qualified.alias("qualified_name"), path.alias("file_path"), language.alias("language"), (F.col(key) % 1000 + 1).cast("int").alias("start_line"), exported.alias("is_exported"))

    c, lit = F.col, F.lit
    nation = F.broadcast(t("nation"))  # 25 rows by definition
    customer = t("customer").join(nation, c("c_nationkey") == c("n_nationkey"))
    supplier = t("supplier").join(nation, c("s_nationkey") == c("n_nationkey"))
    parts = [
        shaped(t("region"), "namespace", "r_regionkey", c("r_name"), c("r_name"), c("r_name"), lit("REGION"), lit(1)),
        shaped(t("nation"), "module", "n_nationkey", c("n_name"), c("n_name"), c("n_name"), lit("NATION"), lit(1)),
        shaped(customer, "class", "c_custkey", c("c_name"), F.concat_ws("::", "n_name", "c_name"), c("n_name"), c("c_mktsegment"), (c("c_acctbal") > 0).cast("int")),
        shaped(supplier, "interface", "s_suppkey", c("s_name"), F.concat_ws("::", "n_name", "s_name"), c("n_name"), lit("SUPPLIER"), lit(1)),
        shaped(t("part"), "function", "p_partkey", c("p_name"), F.concat_ws("::", "p_brand", "p_name"), c("p_brand"), c("p_type"), (c("p_size") > 25).cast("int")),
        shaped(t("orders"), "method", "o_orderkey", F.concat(lit("Order#"), c("o_orderkey").cast("string")), F.concat(lit("Order#"), c("o_orderkey").cast("string")), F.concat(lit("orders/"), c("o_orderpriority")), c("o_orderstatus"), lit(0)),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, target, kind, line); several edges may join the same nodes."""
    t = lambda n: table(spark, sf_dir, n)
    node = lambda kind, key: F.concat(F.lit(kind + ":"), F.col(key).cast("string"))

    def shaped(df, source, target, kind, line):
        return df.select(source.alias("source"), target.alias("target"), F.lit(kind).alias("kind"), line.cast("int").alias("line"))

    out = shaped(t("nation"), node("namespace", "n_regionkey"), node("module", "n_nationkey"), "contains", F.lit(1))
    for more in (
        shaped(t("customer"), node("module", "c_nationkey"), node("class", "c_custkey"), "contains", F.lit(2)),
        shaped(t("supplier"), node("module", "s_nationkey"), node("interface", "s_suppkey"), "contains", F.lit(3)),
        shaped(t("orders"), node("method", "o_orderkey"), node("class", "o_custkey"), "references", F.lit(4)),
        shaped(t("lineitem"), node("method", "l_orderkey"), node("function", "l_partkey"), "calls", F.col("l_linenumber")),
        shaped(t("lineitem"), node("function", "l_partkey"), node("interface", "l_suppkey"), "instantiates", F.col("l_linenumber")),
    ):
        out = out.unionByName(more)
    return out


def file_deps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, target): each customer nation's two other supplier nations with the most order lines, by name."""
    t = lambda n: table(spark, sf_dir, n)
    lines = t("lineitem").join(t("orders"), F.col("l_orderkey") == F.col("o_orderkey")).join(t("customer"), F.col("o_custkey") == F.col("c_custkey")).join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    counts = lines.where("c_nationkey <> s_nationkey").groupBy("c_nationkey", "s_nationkey").count()
    best = Window.partitionBy("c_nationkey").orderBy(F.desc("count"), "s_nationkey")
    top = counts.withColumn("rank", F.row_number().over(best)).where("rank <= 2")
    return top.select(F.format_string("NATION_%d", "c_nationkey").alias("source"), F.format_string("NATION_%d", "s_nationkey").alias("target"))


def sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, path, modality, language, line_count, size_bytes, sha256, text) of documents."""
    number = F.regexp_extract("source", r"(\d+)$", 1).cast("int") % 4
    modality = F.when(number == 0, "code").when(number == 1, "doc").when(number == 2, "script").otherwise("config")
    return table(spark, sf_dir, "documents").select(
        F.format_string("src_demo_%05d", "doc_id").alias("source_id"),
        F.concat(F.lit("repo_sources/demo/"), "source", F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"),
        modality.alias("modality"),
        F.col("lang").alias("language"),
        F.size(F.split("text", "\n")).alias("line_count"),
        F.octet_length("text").alias("size_bytes"),
        F.sha2("text", 256).alias("sha256"),
        "text",
    )


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source_id, line, text), lines counting from 1."""
    return sources(spark, sf_dir).select("source_id", F.posexplode(F.split("text", "\n")).alias("at", "line_text")).select("source_id", (F.col("at") + 1).alias("line"), F.col("line_text").alias("text"))


#: The same views as common table expressions of DuckDB's SQL.
CTES = {
    "nodes": """nodes AS (
  SELECT 'namespace:' || r_regionkey AS id, 'namespace' AS kind, r_name AS name, r_name AS qualified_name, r_name AS file_path, 'REGION' AS language, CAST(r_regionkey % 1000 + 1 AS INT) AS start_line, 1 AS is_exported FROM region
  UNION ALL SELECT 'module:' || n_nationkey, 'module', n_name, n_name, n_name, 'NATION', CAST(n_nationkey % 1000 + 1 AS INT), 1 FROM nation
  UNION ALL SELECT 'class:' || c_custkey, 'class', c_name, n_name || '::' || c_name, n_name, c_mktsegment, CAST(c_custkey % 1000 + 1 AS INT), CAST(c_acctbal > 0 AS INT) FROM customer JOIN nation ON c_nationkey = n_nationkey
  UNION ALL SELECT 'interface:' || s_suppkey, 'interface', s_name, n_name || '::' || s_name, n_name, 'SUPPLIER', CAST(s_suppkey % 1000 + 1 AS INT), 1 FROM supplier JOIN nation ON s_nationkey = n_nationkey
  UNION ALL SELECT 'function:' || p_partkey, 'function', p_name, p_brand || '::' || p_name, p_brand, p_type, CAST(p_partkey % 1000 + 1 AS INT), CAST(p_size > 25 AS INT) FROM part
  UNION ALL SELECT 'method:' || o_orderkey, 'method', 'Order#' || o_orderkey, 'Order#' || o_orderkey, 'orders/' || o_orderpriority, o_orderstatus, CAST(o_orderkey % 1000 + 1 AS INT), 0 FROM orders)""",
    "edges": """edges AS (
  SELECT 'namespace:' || n_regionkey AS source, 'module:' || n_nationkey AS target, 'contains' AS kind, 1 AS line FROM nation
  UNION ALL SELECT 'module:' || c_nationkey, 'class:' || c_custkey, 'contains', 2 FROM customer
  UNION ALL SELECT 'module:' || s_nationkey, 'interface:' || s_suppkey, 'contains', 3 FROM supplier
  UNION ALL SELECT 'method:' || o_orderkey, 'class:' || o_custkey, 'references', 4 FROM orders
  UNION ALL SELECT 'method:' || l_orderkey, 'function:' || l_partkey, 'calls', l_linenumber FROM lineitem
  UNION ALL SELECT 'function:' || l_partkey, 'interface:' || l_suppkey, 'instantiates', l_linenumber FROM lineitem)""",
    "deps": """deps AS (
  SELECT 'NATION_' || c AS source, 'NATION_' || s AS target FROM (
    SELECT c_nationkey AS c, s_nationkey AS s, row_number() OVER (PARTITION BY c_nationkey ORDER BY count(*) DESC, s_nationkey) AS rank
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
    WHERE c_nationkey <> s_nationkey GROUP BY 1, 2) WHERE rank <= 2)""",
    "sources": r"""sources AS (
  SELECT printf('src_demo_%05d', doc_id) AS source_id, 'repo_sources/demo/' || source || '/' || doc_id || '.txt' AS path,
    CASE CAST(regexp_extract(source, '(\d+)$', 1) AS INT) % 4 WHEN 0 THEN 'code' WHEN 1 THEN 'doc' WHEN 2 THEN 'script' ELSE 'config' END AS modality,
    lang AS language, len(string_split(text, chr(10))) AS line_count, strlen(text) AS size_bytes, sha256(text) AS sha256, text FROM documents)""",
    "lines": """lines AS (
  SELECT printf('src_demo_%05d', doc_id) AS source_id, i AS line, string_split(text, chr(10))[i] AS text
  FROM documents, unnest(range(1, 1 + len(string_split(text, chr(10))))) AS t(i))""",
}


def sql(body: str, *names: str, recursive: bool = False) -> str:
    """``body`` after the common table expressions of the given views."""
    head = ",\n".join(CTES[n] for n in names)
    if body.lstrip().upper().startswith("WITH"):
        rest = body.lstrip()[4:].lstrip()
        rest = rest[9:].lstrip() if rest.upper().startswith("RECURSIVE") else rest
        return f"WITH {'RECURSIVE ' if recursive else ''}{head},\n{rest}"
    return f"WITH {'RECURSIVE ' if recursive else ''}{head}\n{body}"
