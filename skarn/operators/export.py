"""Export of a code graph as a bundle: sources, entities, relations, manifest and report; and scans of its tables.

Tables: files (path, content_hash, language, size, indexed_at, errors), nodes (id, kind, name, qualified_name, file_path, language,
start_line, end_line, signature), edges (id, source, target, kind, line).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from .assembly import bundle_kind, bundle_predicate, ordinals

#: Modalities of languages; others are unknown, and a known modality m is of type m.source (fixed values).
MODALITIES = {
    "code": "cpp c python typescript javascript tsx jsx java go rust csharp ruby swift kotlin dart scala lua luau r objc pascal php verilog razor svelte vue astro liquid",
    "config": "yaml xml properties twig",
    "doc": "rst markdown",
}
TYPED = ("code", "config", "doc", "build", "script")
#: Lines that say nothing: blank, comments, include guards (fixed values).
NOT_SUBSTANTIVE = r"^\s*(//.*|/\*.*|\*.*|#.*|`(ifndef|ifdef|define|endif|include).*|$)"
ENTITY_CONFIDENCE = 0.95


def modality(language: Column) -> Column:
    low, out = F.lower(language), F.lit("unknown")
    for name, languages in MODALITIES.items():
        out = F.when(low.isin(*languages.split()), name).otherwise(out)
    return out


def source_type(kind: Column) -> Column:
    return F.when(kind.isin(*TYPED), F.concat(kind, F.lit(".source"))).otherwise("unknown")


def without_prefix(path: Column, prefix: str) -> Column:
    lead = prefix.rstrip("/") + "/" if prefix else ""
    return F.when(path.startswith(lead), F.substring(path, F.lit(len(lead) + 1), F.length(path))).otherwise(path) if lead else path


def full_path(repo: str, relative: Column) -> Column:
    return F.concat_ws("/", F.lit("repo_sources"), F.lit(repo), relative)


def line_count(size: Column, lines: Column | None = None) -> Column:
    """The real number of lines where it is known, else a line for each 50 bytes, and one at least."""
    guess = F.when(size > 0, F.greatest(F.lit(1), F.floor(size / 50))).otherwise(1)
    return F.coalesce(lines, guess).cast("long") if lines is not None else guess.cast("long")


def source_inventory(files: DataFrame, project: str, repo: str, prefix: str = "", source_set: str = "main") -> DataFrame:
    """A source for every file, numbered by path."""
    relative = without_prefix(F.col("path"), prefix)
    kind = modality(F.col("language"))
    numbered = ordinals(files, "source_id", f"src_{project}_%05d", ["path"])
    return numbered.select(
        "source_id",
        F.col("path").alias("file_path"),
        relative.alias("relative_path"),
        full_path(repo, relative).alias("path"),
        F.coalesce(F.nullif("language", F.lit("")), F.lit("unknown")).alias("language"),
        kind.alias("modality"),
        source_type(kind).alias("source_type"),
        line_count(F.col("size")).alias("line_count"),
        F.coalesce("size", F.lit(0).cast("long")).alias("size_bytes"),
        F.concat(F.lit("sha256:"), "content_hash").alias("sha256"),
        F.when(F.col("errors").isNull() | (F.col("errors") == "[]"), "parsed").otherwise("errors").alias("parse_status"),
        F.lit(project).alias("project"),
        F.lit(repo).alias("repo_name"),
        F.lit(source_set).alias("source_set_id"),
        F.lit("primary_source").alias("authority"),
    )


def entity_index(nodes: DataFrame, sources: DataFrame, project: str) -> DataFrame:
    """An entity for every node of a known file whose kind is exported; a missing or zero line is 1, a qualified name that says
    no more than the name and an empty signature are null."""
    kind = bundle_kind(F.col("kind"), F.col("language"))
    start = F.coalesce(F.nullif("start_line", F.lit(0)), F.lit(1))
    own = nodes.select("id", "name", "qualified_name", "signature", "file_path", kind.alias("kind"), start.alias("line_start"), F.coalesce(F.nullif("end_line", F.lit(0)), start).alias("line_end"))
    own = own.where("kind is not null").join(sources.select("file_path", "source_id", "path"), "file_path")
    return own.select(
        S.entity_id(F.lit(project), F.col("source_id"), F.col("kind"), F.col("name"), F.col("line_start")).alias("entity_id"),
        F.col("id").alias("node_id"),
        "source_id",
        "path",
        "name",
        "kind",
        "line_start",
        "line_end",
        F.when((F.col("qualified_name") != "") & (F.col("qualified_name") != F.col("name")), F.col("qualified_name")).alias("qualified_name"),
        F.nullif("signature", F.lit("")).alias("signature"),
        F.lit(ENTITY_CONFIDENCE).alias("confidence"),
    )


def endpoints(nodes: DataFrame, sources: DataFrame, entities: DataFrame) -> DataFrame:
    """(node_id, end): each node's entity, or the source of a file node, as (type, id, name)."""
    end = lambda kind, key, name: F.struct(F.lit(kind).alias("type"), F.col(key).alias("id"), name.alias("name")).alias("end")
    own = entities.select("node_id", end("entity", "entity_id", F.col("name")))
    file = nodes.where("kind = 'file'").join(sources.select("file_path", "source_id"), "file_path")
    return own.unionByName(file.select(F.col("id").alias("node_id"), end("source", "source_id", F.regexp_replace("id", "^file:", ""))))


def relation_graph(nodes: DataFrame, edges: DataFrame, sources: DataFrame, entities: DataFrame, project: str) -> DataFrame:
    """A relation for every edge with both endpoints, numbered by edge id; its evidence is where the subject's file has it."""
    ends = endpoints(nodes, sources, entities)
    subject, target = (ends.select(F.col("node_id").alias(c), F.col("end").alias(n)) for c, n in (("source", "subject"), ("target", "object")))
    at = nodes.select(F.col("id").alias("source"), F.col("name").alias("s_name"), "file_path").join(sources.select("file_path", "source_id", F.col("path").alias("s_path")), "file_path", "left").drop("file_path")
    kept = edges.join(subject, "source").join(target, "target").join(at, "source", "left")
    predicate = bundle_predicate(F.col("kind"))
    evidence = F.struct(
        F.coalesce("source_id", F.lit("src_unknown")).alias("source_id"),
        F.coalesce("s_path", F.concat(F.lit("<"), "source", F.lit(">"))).alias("path"),
        F.coalesce(F.col("line").cast("string"), F.lit("1")).alias("lines"),
        F.trim(F.concat_ws(" ", F.coalesce("s_name", "source"), predicate, F.col("object.name"))).alias("summary"),
    )
    named = ordinals(kept, "relation_id", f"rel_{project}_%07d", ["id"])
    return named.select("relation_id", "subject", predicate.alias("predicate"), "object", F.array(evidence).alias("evidence"), F.lit(ENTITY_CONFIDENCE).alias("confidence"))


def predicate_counts(edges: DataFrame, relations: DataFrame) -> DataFrame:
    """(predicate, n_edges, n_kept, n_dropped)."""
    all_of = edges.groupBy(bundle_predicate(F.col("kind")).alias("predicate")).agg(F.count(F.lit(1)).alias("n_edges"))
    kept = relations.groupBy("predicate").agg(F.count(F.lit(1)).alias("n_kept"))
    out = all_of.join(kept, "predicate", "left").na.fill(0, ["n_kept"])
    return out.withColumn("n_dropped", F.col("n_edges") - F.col("n_kept"))


def most_used(edges: DataFrame, entities: DataFrame, top: int = 5) -> DataFrame:
    """(name, n): the entities with most edges into them; ties to the one met first by edge id."""
    counted = edges.groupBy(F.col("target").alias("node_id")).agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first"))
    return counted.join(entities.select("node_id", "name"), "node_id").orderBy(F.desc("n"), "first").limit(top).select("name", "n")


def kinds_of(entities: DataFrame, top: int = 8) -> DataFrame:
    """(kind, n) of the most frequent kinds; ties to the one met first by node id."""
    return entities.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.min("node_id").alias("first")).orderBy(F.desc("n"), "first").limit(top).select("kind", "n")


def manifest(sources: DataFrame, entities: DataFrame, relations: DataFrame, metadata: DataFrame, project: str, created_at: str, pin: str = "") -> DataFrame:
    """One row: the bundle's description with its counts; ``metadata`` (key, value)."""
    n = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    by = relations.groupBy("predicate").agg(F.count(F.lit(1)).alias("n")).agg(F.array_sort(F.collect_list(F.struct("predicate", "n"))).alias("by"))
    meta = metadata.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("key", "value")))).alias("meta"))
    one = n(sources, "sources").join(n(entities, "entities"), F.lit(True)).join(n(relations, "relations"), F.lit(True)).join(by, F.lit(True)).join(meta, F.lit(True))  # rows of one row
    return one.select(
        F.lit("project-manifest/v1").alias("schema_version"),
        F.lit(created_at).alias("created_at"),
        F.lit(project).alias("project"),
        F.initcap(F.lit(project)).alias("display_name"),
        "sources",
        "entities",
        "relations",
        F.to_json(F.map_from_entries("by")).alias("relations_by_predicate"),
        F.lit(pin).alias("pin"),
        F.try_element_at("meta", F.lit("indexed_with_version")).alias("indexed_with_version"),
    )


def report(sources: DataFrame, edges: DataFrame, entities: DataFrame, relations: DataFrame, project: str) -> str:
    """The analysis report as Markdown, from small aggregates."""
    rows = lambda df: [tuple(r) for r in df.collect()]
    table = lambda head, body: [f"| {' | '.join(head)} |", "|" + "---|" * len(head), *(f"| {' | '.join(map(str, r))} |" for r in body)]
    by = relations.groupBy("predicate").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "predicate")
    out = [f"# Analyzer report: {project}", "", *(f"- {n}: {df.count()}" for n, df in (("sources", sources), ("entities", entities), ("relations", relations))), "", "## Top entity kinds", "", *table(("kind", "count"), rows(kinds_of(entities)))]
    out += ["", "## Most referenced", "", *(f"- `{n}` ({k} inbound)" for n, k in rows(most_used(edges, entities))), "", "## Relations by predicate", "", *table(("predicate", "count"), rows(by))]
    return "\n".join(out) + "\n"


def first_substantive_line(lines: DataFrame) -> DataFrame:
    """(source_id, line): the first line of each source that is no comment or guard, else 1."""
    hit = F.min(F.when(~F.col("text").rlike(NOT_SUBSTANTIVE), F.col("line")))
    return lines.groupBy("source_id").agg(F.coalesce(hit, F.lit(1)).alias("line"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(name, n) of several tables."""
    out = None
    for name, df in tables.items():
        own = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        out = own if out is None else out.unionByName(own)
    return out


def pending_references(refs: DataFrame, files: list[str] | None = None, name: str | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
    """Unresolved references of some files or of a name, in pages by id."""
    out = refs.where(F.col("file_path").isin(*files)) if files is not None else refs
    out = out.where(F.col("name") == name) if name is not None else out
    out = out.orderBy("ref_id").offset(offset) if offset or limit is not None else out
    return out.limit(limit) if limit is not None else out


def without_files(nodes: DataFrame, edges: DataFrame, refs: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Nodes, edges and references that remain when the files (path) go, with all edges at their nodes."""
    left = nodes.join(gone.select(F.col("path").alias("file_path")), "file_path", "left_anti").select(nodes.columns)
    dead = nodes.join(gone.select(F.col("path").alias("file_path")), "file_path", "left_semi").select("id")
    stay = edges.join(dead.withColumnRenamed("id", "source"), "source", "left_anti").join(dead.withColumnRenamed("id", "target"), "target", "left_anti").select(edges.columns)
    return left, stay, refs.join(gone.select(F.col("path").alias("file_path")), "file_path", "left_anti").select(refs.columns)


def put(table: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """``table`` with the rows of ``new`` in place of those of the same key."""
    return table.join(new.select(key), key, "left_anti").select(table.columns).unionByName(new.select(table.columns))


def put_missing(table: DataFrame, new: DataFrame, key: str, order: str) -> DataFrame:
    """``table`` with the first row by ``order`` of each key of ``new`` that it lacks."""
    from .signals import first_by

    fresh = first_by(new, [key], [order]).join(table.select(key), key, "left_anti")
    return table.unionByName(fresh.select(table.columns))


def stale(files: DataFrame, hashes: DataFrame) -> DataFrame:
    """(path): tracked files whose content hash is another now; ``hashes`` (path, content_hash)."""
    now = hashes.select("path", F.col("content_hash").alias("now"))
    return files.join(now, "path").where("content_hash <> now").select("path")
