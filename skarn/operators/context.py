"""Ranking of search results for a question, and assembly of a bounded context around them.

Results have (id, kind, name, file_path, score). Terms of the question are taken on the driver, scores in one pass over the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Weights of the ranking (fixed values).
TEST_SHARE, CORE_BONUS, CORE_LEAD, CO_LOCATED, DISTINCTIVE_FILES = 0.3, 25, 3, 20, 10
COMMON_EXACT, SINGLE_TERM, PER_TERM = 0.3, 0.6, 0.5
FILE_SHARE, LEAST_PER_FILE, OTHER_SHARE, LEAST_OTHER, ROOT_WEIGHT = 0.2, 5, 0.15, 3, 10
KIND_PRIORITY = {"class": 3, "interface": 3, "struct": 3, "trait": 3, "protocol": 3, "enum": 3, "method": 1, "function": 1}


def asks_for_tests(query: str) -> bool:
    return "test" in query.lower() or "spec" in query.lower()


def exact_names(nodes: DataFrame, names: list[str], limit: int = 50) -> DataFrame:
    """(id, name, file_path, score): nodes named so in any case. A name in fewer than ten files is distinctive, and what shares a
    file with one gains 20. Of each name the best ``max(8, limit / names)`` stay, of all the best ``limit``; ties by id."""
    wanted = [n.lower() for n in names]
    own = nodes.where(F.lower("name").isin(*wanted)).withColumn("low", F.lower("name"))
    spread = own.groupBy("low").agg(F.count_distinct("file_path").alias("files")).where(F.col("files") < DISTINCTIVE_FILES)
    core = own.join(spread.select("low"), "low", "left_semi").select("file_path").distinct().withColumn("core", F.lit(True))
    per_name = max(8, math.ceil(limit / max(len(names), 1)))
    nth = lambda *order: F.row_number().over(Window.partitionBy("low").orderBy(*order))
    few = own.withColumn("nth", nth("id")).where(F.col("nth") <= max(3 * per_name, 50))
    scored = few.join(F.broadcast(core.limit(DISTINCTIVE_FILES * max(len(names), 1))), "file_path", "left").withColumn("score", F.when(F.col("core"), 1.0 + CO_LOCATED).otherwise(1.0))
    kept = scored.withColumn("nth", nth(F.desc("score"), "id")).where(F.col("nth") <= per_name)
    return kept.orderBy(F.desc("score"), "id").limit(limit).select("id", "name", "file_path", "score")


def names_containing(nodes: DataFrame, part: str, inside_only: bool = False, limit: int = 30) -> DataFrame:
    """(id, name): names that contain a part in any case, shortest first; ``inside_only`` leaves out those that start with it."""
    low = F.lower("name")
    found = nodes.where(low.contains(part.lower()) & (~low.startswith(part.lower()) if inside_only else F.lit(True)))
    return found.orderBy(F.length("name"), "id").limit(limit).select("id", "name")


#: Kinds that names are sought in by part, and the most names of a part (fixed values).
DEFINITION_KINDS = ("class", "interface", "struct", "trait", "protocol", "enum", "type_alias")
MOST_PARTS = 200


def _parts(names: list[str]) -> list[str]:
    """The names as parts of compound names, each once: a capital and small letters, three at least."""
    titled = [n[:1].upper() + n[1:].lower() for n in names]
    return [t for t in dict.fromkeys(titled) if len(t) >= 3]


def _with_parts(nodes: DataFrame, parts: list[str], inside_only: bool) -> DataFrame:
    """(id, name, file_path, turn, part): of every part the 200 shortest names of definitions that have it in any case."""
    low = F.lower("name")
    has = lambda p: low.contains(p.lower()) & (~low.startswith(p.lower()) if inside_only else F.lit(True))
    hits = F.array_compact(F.array(*[F.when(has(p), F.struct(F.lit(k).alias("turn"), F.lit(p).alias("part"))) for k, p in enumerate(parts)]))
    own = nodes.where(F.col("kind").isin(*DEFINITION_KINDS)).select("id", "name", "file_path", F.explode(hits).alias("h")).select("id", "name", "file_path", "h.turn", "h.part")
    nth = F.row_number().over(Window.partitionBy("part").orderBy(F.length("name"), "id"))
    return own.withColumn("nth", nth).where(F.col("nth") <= MOST_PARTS).drop("nth")


def boundary_names(nodes: DataFrame, query: str, names: list[str], results: DataFrame, limit: int = 20) -> DataFrame:
    """(id, name, file_path, score): definitions with a part of the question behind a letter inside their names, which the
    word index can't find. Names with several parts gain; ``results`` (id) and, for other questions, tests stay out."""
    parts = _parts(names)
    if not parts:
        return nodes.select("id", "name", "file_path", F.lit(0.0).alias("score")).where(F.lit(False))
    own = _with_parts(nodes, parts, True)
    at = F.instr(F.col("name"), F.col("part"))
    own = own.where((at > 1) & F.substring(F.col("name"), at - 1, F.lit(1)).rlike("[a-zA-Z]")).join(results.select("id"), "id", "left_anti")
    if not asks_for_tests(query):
        own = own.where(~S.is_test_file(F.col("file_path")))
    brevity = F.greatest(F.lit(0.0), 6 - (F.length("name") - F.length("part")) / 4)
    own = own.withColumn("score", 8 + brevity + S.path_relevance(F.col("file_path"), query))
    most = 4 * -(-limit // 2)
    own = own.withColumn("nth", F.row_number().over(Window.partitionBy("part").orderBy(F.desc("score"), F.length("name"), "id"))).where(F.col("nth") <= most)
    met = own.groupBy("id", "name", "file_path").agg(F.min_by("score", "turn").alias("score"), F.count(F.lit(1)).alias("n"))
    met = met.withColumn("score", F.col("score") * (1 + F.col("n")) + (F.col("n") - 1) * 30)
    return met.orderBy(F.desc("score"), "id").limit(limit).select("id", "name", "file_path", "score")


def compound_names(nodes: DataFrame, query: str, names: list[str], results: DataFrame, limit: int = 20) -> DataFrame:
    """(id, name, file_path, score): definitions whose names have two or more parts of the question anywhere."""
    parts = _parts(names)
    own = _with_parts(nodes, parts or [""], False).join(results.select("id"), "id", "left_anti")
    if not asks_for_tests(query):
        own = own.where(~S.is_test_file(F.col("file_path")))
    met = own.groupBy("id", "name", "file_path").agg(F.count_distinct("part").alias("n")).where("n >= 2")
    score = 10 + (F.col("n") - 1) * 20 + S.path_relevance(F.col("file_path"), query) + F.greatest(F.lit(0.0), 6 - F.length("name") / 8)
    return met.withColumn("score", score.cast("double")).orderBy(F.desc("score"), "id").limit(-(-limit // 2)).select("id", "name", "file_path", "score")


def without_tests(results: DataFrame, query: str) -> DataFrame:
    """Scores of tests and other files beside production at three tenths, unless the question is about tests."""
    if asks_for_tests(query):
        return results
    return results.withColumn("score", F.when(S.is_test_file(F.col("file_path")), F.col("score") * TEST_SHARE).otherwise(F.col("score")))


def core_boosted(results: DataFrame, dominant: DataFrame) -> DataFrame:
    """25 more in the folder of the dominant file (rank, file_path, n) if it leads the next one threefold."""
    lead = dominant.agg(
        F.max(F.when(F.col("rank") == 1, F.col("n"))).alias("first"), F.coalesce(F.max(F.when(F.col("rank") == 2, F.col("n"))), F.lit(0)).alias("next"), F.max(F.when(F.col("rank") == 1, F.col("file_path"))).alias("path")
    )  # one row
    folder = F.regexp_extract("path", "^(.+/)[^/]*$", 1)
    core = lead.select(F.when(F.col("first") >= CORE_LEAD * F.col("next"), F.nullif(folder, F.lit(""))).alias("__core"))
    both = results.join(F.broadcast(core), F.lit(True), "left")
    return both.withColumn("score", F.col("score") + F.when(F.col("file_path").startswith(F.col("__core")), CORE_BONUS).otherwise(0)).drop("__core")


def term_groups(terms: list[str]) -> list[list[str]]:
    """Terms that contain one another are one concept."""
    groups: list[list[str]] = []
    left = sorted(terms, key=len, reverse=True)
    while left:
        head = left[0]
        groups.append([t for t in left if t in head or head in t])
        left = [t for t in left if t not in groups[-1]]
    return groups


def _matches(group: list[str]) -> Column:
    """Whether a term of a group is in the name, or is a folder of the path."""
    name, folders = F.lower("name"), F.split(F.lower(S.dirname(F.col("file_path"))), "/")
    out = F.lit(False)
    for t in group:
        out = out | name.contains(t) | F.array_contains(folders, t)
    return out


def reranked(results: DataFrame, query: str, exact: Column | None = None, symbols: list[str] = ()) -> DataFrame:
    """Scores by the number of concepts of the question that a result meets: from two on, half as much again for each; with
    fewer, whole for an exact match of a symbol that looks like an identifier, three tenths for other exact matches
    (``exact``), six tenths else. A question of one concept leaves all scores."""
    terms = S.search_terms(query)
    if len(terms) < 2:
        return results
    met = F.lit(0)
    for group in term_groups(terms):
        met = met + _matches(group).cast("int")
    exact = F.lit(False) if exact is None else exact
    named = F.lower("name").isin(*[s.lower() for s in symbols if S.is_distinctive(s)]) if any(map(S.is_distinctive, symbols)) else F.lit(False)
    weight = F.when(met >= 2, 1 + PER_TERM * met).when(exact & named, 1.0).when(exact, COMMON_EXACT).otherwise(SINGLE_TERM)
    return results.withColumn("score", F.col("score") * weight)


def confidence(results: DataFrame, query: str, symbols: list[str] = ()) -> DataFrame:
    """One row: low if a question of two terms or more has results, none named as a distinctive symbol and none with two of
    the terms; else high."""
    terms = S.search_terms(query, with_stems=False)
    strong = F.lower("name").isin(*[s.lower() for s in symbols if S.is_distinctive(s)]) if any(map(S.is_distinctive, symbols)) else F.lit(False)
    hits = F.lit(0)
    for t in terms:
        hits = hits + _matches([t]).cast("int")
    out = results.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.some(strong | (hits >= 2)), F.lit(False)).alias("any"))
    low = (F.col("n") > 0) & ~F.col("any") if len(terms) >= 2 else F.lit(False)
    return out.select(F.when(low, "low").otherwise("high").alias("confidence"))


def kind_priority(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in KIND_PRIORITY.items() for x in kv])
    return F.coalesce(F.try_element_at(table, kind), F.lit(0))


def trimmed(found: DataFrame, edges: DataFrame, roots: DataFrame, most: int) -> DataFrame:
    """``found`` (id, ...) cut to ``most`` nodes: roots first, then their neighbours, then others, each by id."""
    root = roots.select("id").distinct()
    near = edges.join(root.withColumnRenamed("id", "source"), "source", "left_semi").select(F.col("target").alias("id")).unionByName(edges.join(root.withColumnRenamed("id", "target"), "target", "left_semi").select(F.col("source").alias("id"))).distinct()
    tier = found.join(root.withColumn("r", F.lit(0)), "id", "left").join(near.withColumn("n", F.lit(1)), "id", "left")
    return tier.withColumn("tier", F.coalesce("r", "n", F.lit(2))).orderBy("tier", "id").limit(most).drop("r", "n", "tier").select(found.columns)


def capped(found: DataFrame, roots: DataFrame, most: int, query: str = "") -> DataFrame:
    """``found`` (id, kind, file_path) with a fifth of ``most`` for one file, roots and types first, then three twentieths for
    tests and the like unless the question is about them; ties by id."""
    own = found.join(roots.select("id").distinct().withColumn("root", F.lit(ROOT_WEIGHT)), "id", "left")
    weight = F.coalesce("root", F.lit(0)) + kind_priority(F.col("kind"))
    nth = F.row_number().over(Window.partitionBy("file_path").orderBy(F.desc("weight"), "id"))
    own = own.withColumn("weight", weight).withColumn("nth", nth).where(F.col("nth") <= max(LEAST_PER_FILE, math.ceil(most * FILE_SHARE)))
    if not asks_for_tests(query):
        own = own.withColumn("other", S.is_test_file(F.col("file_path")))
        nth = F.row_number().over(Window.partitionBy("other").orderBy("id"))
        few = own.where("other").withColumn("nth", nth).where(F.col("nth") <= max(LEAST_OTHER, math.ceil(most * OTHER_SHARE)))
        own = own.where("not other").unionByName(few)
    return own.select(found.columns)


def assembled(nodes: DataFrame, edges: DataFrame, roots: DataFrame, depth: int = 1, most: int = 20, query: str = "") -> tuple[DataFrame, DataFrame]:
    """Nodes around the roots within ``depth`` steps, trimmed and capped, and the edges among them."""
    from .graph import kept, reach

    around = reach(edges, roots, depth, "both").select("id")
    own = nodes.select("id", "kind", "name", "file_path").join(around, "id", "left_semi")
    own = kept(capped(trimmed(own, edges, roots, most), roots, most, query))
    ids = own.select("id")
    inside = edges.join(ids.withColumnRenamed("id", "source"), "source", "left_semi").join(ids.withColumnRenamed("id", "target"), "target", "left_semi")
    return own, inside


def definitions_for_imports(results: DataFrame, edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """``results`` with each import node replaced by what it imports, the smallest id of several; others stay."""
    target = edges.where("kind = 'imports'").groupBy(F.col("source").alias("id")).agg(F.min("target").alias("target"))
    moved = results.join(target, "id", "left").withColumn("id", F.when(F.col("kind") == "import", F.coalesce("target", "id")).otherwise(F.col("id")))
    best = moved.groupBy("id").agg(F.max("score").alias("score"))
    return nodes.select("id", "kind", "name", "file_path").join(best, "id").select("id", "kind", "name", "file_path", "score")


def search_scores(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(query_id, recall, passed, reciprocal_rank): ``found`` (query_id, rank, name), ``expected`` (query_id, position, name). A
    query passes from half of its symbols; the rank is that of the first expected symbol, in their order, that is found."""
    first = found.groupBy("query_id", "name").agg(F.min("rank").alias("rank"))
    both = expected.join(first, ["query_id", "name"], "left")
    out = both.groupBy("query_id").agg(F.avg(F.col("rank").isNotNull().cast("int")).alias("recall"), F.min_by("rank", F.when(F.col("rank").isNotNull(), F.col("position"))).alias("rank"))
    return out.select("query_id", "recall", (F.col("recall") >= 0.5).alias("passed"), F.coalesce(1 / F.col("rank"), F.lit(0.0)).alias("reciprocal_rank"))
