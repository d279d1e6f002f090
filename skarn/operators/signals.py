"""Signal emitters over sources, entities and relations, and their deduplication. An emitter is a function of tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Languages whose sources imply domain knowledge (fixed values).
DOMAIN_LANGUAGES = ("verilog", "systemverilog", "chisel", "scala_chisel", "amaranth")
#: Words of a condition, where conditions are looked for, and attributes of predicates (fixed values).
CONDITION = r"(?i)\b(if|else|case|switch|when|guard|assert|for|while|unless)\b|&&|\|\||\?"
CONDITION_MODALITIES = ("code", "script", "config", "test")
PREDICATE_ATTRIBUTES = {"contains": "implicit_domain_knowledge", "doc_mentions_entity": "doc_code_divergence", "imports_or_includes": "implicit_domain_knowledge"}

REGISTRY: dict[str, Callable[..., DataFrame]] = {}
BUILDERS: dict[str, Callable[..., DataFrame]] = {}


def emitter(name: str, registry: dict = REGISTRY):
    """Registers an emitter; emitters of other packages join ``emit_all`` the same way."""

    def put(f):
        registry[name] = f
        return f

    return put


def signal_id(project: str, attribute: str, source: Column, lines: Column, salt: Column | None = None) -> Column:
    """sig:project:attribute:source-hash, the source with dashes, the hash over source, lines, attribute and salt."""
    source = F.coalesce(source, F.lit("anchor"))
    digest = F.substring(F.sha2(F.concat_ws("|", source, F.coalesce(lines, F.lit("")), F.lit(attribute), F.coalesce(salt if salt is not None else F.lit(""), F.lit(""))), 256), 1, 12)
    return F.concat(F.lit(f"sig:{project}:{attribute}:"), F.replace(source, F.lit("_"), F.lit("-")), F.lit("-"), digest)


def readable_suffix(value: Column) -> Column:
    """Letters and digits of a value joined by dashes, 80 at most, then a dash and 12 hex digits of its sha1."""
    digest = F.substring(F.sha1(value), 1, 12)
    words = F.regexp_replace(F.regexp_replace(F.lower(value), r"[^\p{L}\p{N}]+", "-"), "^-|-$", "")
    return F.when(words == "", digest).otherwise(F.concat(F.substring(words, 1, 80), F.lit("-"), digest))


def builder_id(project: str, attribute: str, anchor: Column) -> Column:
    return F.concat(F.lit(f"sig:{project}:{attribute}:"), readable_suffix(anchor))


def _signal(df: DataFrame, project: str, attribute: str, axis: int, confidence: float, source: Column, entity: Column, lines: Column) -> DataFrame:
    return df.select(signal_id(project, attribute, source, lines).alias("signal_id"), F.lit(axis).alias("axis"), F.lit(attribute).alias("attribute"), source.alias("source_id"), entity.alias("entity_id"), lines.alias("lines"), F.lit(confidence).alias("confidence"))


def _entity_lines() -> Column:
    return F.coalesce("line_start", F.lit(1)).cast("string")


def inbound(relations: DataFrame) -> DataFrame:
    return relations.groupBy(F.col("object_id").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))


def endpoints(relations: DataFrame) -> DataFrame:
    """Uses of an entity at either end, entity-typed ends only."""
    ends = F.array(F.struct(F.col("subject_id").alias("id"), F.col("subject_type").alias("type")), F.struct(F.col("object_id").alias("id"), F.col("object_type").alias("type")))
    return relations.select(F.explode(ends).alias("e")).where("e.type = 'entity'").groupBy(F.col("e.id").alias("entity_id")).agg(F.count(F.lit(1)).alias("n"))


# Tables: sources (source_id, path, modality, language), entities (entity_id, source_id, name, kind, line_start),
# relations (relation_id, subject_id, subject_type, predicate, object_id, object_type, evidence: array of (source_id, lines)).


@emitter("long_tail")
def long_tail(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", most: int = 3) -> DataFrame:
    rare = entities.join(inbound(relations), "entity_id", "left").where(F.coalesce("n", F.lit(0)) <= most)
    return _signal(rare, project, "long_tail", 2, 0.95, F.col("source_id"), F.col("entity_id"), _entity_lines())


@emitter("non_code_anchor")
def non_code_anchor(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", modalities: tuple = ("script", "config", "build")) -> DataFrame:
    own = entities.join(sources.where(F.col("modality").isin(*modalities)).select("source_id"), "source_id", "left_semi")
    return _signal(own, project, "non_code_anchor", 2, 0.95, F.col("source_id"), F.col("entity_id"), _entity_lines())


def collisions(entities: DataFrame, least: int = 2) -> DataFrame:
    """(name, sources, n_sources, n_entities) of names that several sources have."""
    named = entities.groupBy("name").agg(F.array_sort(F.collect_set(F.when(F.col("source_id") != "", F.col("source_id")))).alias("sources"), F.count(F.lit(1)).alias("n_entities"))
    return named.withColumn("n_sources", F.size("sources")).where(F.col("n_sources") >= least)


@emitter("distracting_info")
def distracting_info(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", least: int = 2) -> DataFrame:
    own = entities.join(collisions(entities, least).select("name"), "name", "left_semi")
    return _signal(own, project, "distracting_info", 2, 0.95, F.col("source_id"), F.col("entity_id"), _entity_lines())


@emitter("implicit_domain_knowledge")
def implicit_domain_knowledge(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", languages: tuple = DOMAIN_LANGUAGES) -> DataFrame:
    return _signal(sources.where(F.lower("language").isin(*languages)), project, "implicit_domain_knowledge", 3, 0.7, F.col("source_id"), F.lit(None).cast("string"), F.lit("1"))


@emitter("doc_code_divergence")
def doc_code_divergence(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo") -> DataFrame:
    """One signal for each evidence of a mention, or one at line 1."""
    mention = relations.where("predicate = 'doc_mentions_entity'").join(sources.select("source_id"), F.col("subject_id") == F.col("source_id")).join(entities.select("entity_id"), F.col("object_id") == F.col("entity_id"))
    each = mention.select("source_id", "entity_id", F.explode_outer("evidence").alias("e"))
    return _signal(each, project, "doc_code_divergence", 3, 0.7, F.col("source_id"), F.col("entity_id"), F.coalesce(F.nullif(F.col("e.lines"), F.lit("")), F.lit("1")))


def _built(df: DataFrame, project: str, attribute: str, axis: int, confidence: float, anchor: Column, source: Column, lines: Column) -> DataFrame:
    return df.select(builder_id(project, attribute, anchor).alias("signal_id"), F.lit(axis).alias("axis"), F.lit(attribute).alias("attribute"), anchor.alias("anchor_id"), source.alias("source_id"), lines.cast("string").alias("lines"), F.lit(confidence).alias("confidence"))


@emitter("long_tail", BUILDERS)
def build_long_tail(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", most: int = 3) -> DataFrame:
    """By uses at either end; lines only where the entity has a line."""
    rare = entities.join(endpoints(relations), "entity_id", "left").where((F.coalesce("n", F.lit(0)) <= most) & (F.col("entity_id") != ""))
    return _built(rare, project, "long_tail", 2, 0.72, F.col("entity_id"), F.col("source_id"), F.when(F.col("line_start") != 0, F.col("line_start")))


@emitter("non_code_anchor", BUILDERS)
def build_non_code_anchor(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", modalities: tuple = ("script", "config")) -> DataFrame:
    own = sources.where(F.col("modality").isin(*modalities))
    return _built(own, project, "non_code_anchor", 2, 0.78, F.col("source_id"), F.col("source_id"), F.lit(None))


@emitter("distracting_info", BUILDERS)
def build_distracting_info(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo") -> DataFrame:
    own = entities.where("name <> '' and source_id <> ''")
    own = own.join(collisions(own).select("name"), "name", "left_semi")
    return _built(own, project, "distracting_info", 2, 0.66, F.col("entity_id"), F.col("source_id"), F.when(F.col("line_start") != 0, F.col("line_start")))


def _first_evidence(relations: DataFrame) -> DataFrame:
    return relations.where("relation_id <> ''").withColumn("e", F.get("evidence", F.lit(0)))


@emitter("conditional_behavior", BUILDERS)
def build_conditional(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", predicates: tuple = ("checks_condition",)) -> DataFrame:
    own = _first_evidence(relations.where(F.col("predicate").isin(*predicates)))
    return _built(own, project, "conditional_behavior", 3, 0.74, F.col("relation_id"), F.col("e.source_id"), F.col("e.lines"))


def build_reasoning(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", attribute: str = "implicit_domain_knowledge") -> DataFrame:
    own = _first_evidence(relations.where(F.col("predicate").isin(*[p for p, a in PREDICATE_ATTRIBUTES.items() if a == attribute])))
    return _built(own, project, attribute, 3, 0.68, F.col("relation_id"), F.col("e.source_id"), F.col("e.lines"))


@emitter("relation_knowledge", BUILDERS)
def build_relation_knowledge(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo") -> DataFrame:
    return build_reasoning(sources, entities, relations, project)


@emitter("relation_divergence", BUILDERS)
def build_relation_divergence(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo") -> DataFrame:
    return build_reasoning(sources, entities, relations, project, "doc_code_divergence")


def conditional_text(lines: DataFrame, sources: DataFrame, project: str = "demo", most: int = 5, width: int = 160) -> DataFrame:
    """The first ``most`` lines of each source of a fit modality that read like conditions, trimmed; ``signal_id`` is the
    source's and ``first_line`` where its anchor is."""
    own = sources.where(F.col("modality").isin(*CONDITION_MODALITIES)).select("source_id")
    by = Window.partitionBy("source_id").orderBy("line")
    hits = lines.where(F.col("text").rlike(CONDITION)).join(own, "source_id", "left_semi").withColumns({"nth": F.row_number().over(by), "first_line": F.min("line").over(by)}).where(F.col("nth") <= most)
    trimmed = F.regexp_replace("text", r"^\s+|\s+$", "")
    return hits.select(builder_id(project, "conditional_behavior", F.col("source_id")).alias("signal_id"), "source_id", "first_line", "line", F.substring(trimmed, 1, width).alias("text"))


def emit_all(sources: DataFrame, entities: DataFrame, relations: DataFrame, project: str = "demo", names: list[str] | None = None, registry: dict = REGISTRY) -> DataFrame:
    """All registered emitters in order, with ``emit_order`` for first-wins rules."""
    out = None
    for order, name in enumerate(names or registry):
        own = registry[name](sources, entities, relations, project).withColumn("emit_order", F.lit(order))
        out = own if out is None else out.unionByName(own)
    return out


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("__nth = 1").drop("__nth")


def suffixed(signals: DataFrame, order: list, anchor: str = "anchor_id") -> DataFrame:
    """Later rows of an id get the readable suffix of their anchor; of rows that share an id after that the last stays."""
    nth = F.row_number().over(Window.partitionBy("signal_id").orderBy(*order))
    named = signals.withColumn("__nth", nth).withColumn("signal_id", F.when(F.col("__nth") > 1, F.concat("signal_id", F.lit(":"), readable_suffix(F.col(anchor)))).otherwise(F.col("signal_id")))
    last = F.row_number().over(Window.partitionBy("signal_id").orderBy(*[F.desc(c) for c in order]))
    return named.withColumn("__last", last).where("__last = 1").drop("__nth", "__last")


def picked(signals: DataFrame, cases: DataFrame, per_case: int = 3, stride: int = 17) -> DataFrame:
    """(case_id, nth, signal_id): case ``index`` takes signals at (index + stride * nth) modulo their number."""
    from .assembly import ordinals

    numbered = ordinals(signals, "ordinal", "%d", ["signal_id"]).withColumn("ordinal", F.col("ordinal").cast("long") - 1)
    total = signals.agg(F.count(F.lit(1)).alias("total"))  # one row
    wanted = cases.join(F.broadcast(total), F.lit(True)).where("total > 0").select("case_id", "total", F.col("index"), F.explode(F.sequence(F.lit(0), F.lit(per_case - 1))).alias("nth"))
    wanted = wanted.withColumn("ordinal", F.pmod(F.col("index") + stride * F.col("nth"), F.col("total")))
    return wanted.join(numbered.select("ordinal", "signal_id"), "ordinal").select("case_id", "nth", "signal_id")


def two_hops(relations: DataFrame, includes: tuple = ("imports_or_includes",), most: int = 3) -> DataFrame:
    """(anchor, neighbour, rank): other subjects sharing an object with each subject, mentions first, at most ``most``.

    A neighbour that ``most`` smaller others of an object precede cannot be among the first, so each object offers only
    its ``most + 1`` smallest subjects, one of which may be the anchor.
    """
    own = relations.select(F.col("subject_id").alias("anchor"), "object_id", F.when(F.col("predicate") == "doc_mentions_entity", 0).otherwise(1).alias("priority"))
    smallest = Window.partitionBy("object_id").orderBy("neighbour")
    other = relations.select(F.col("subject_id").alias("neighbour"), "object_id").where("neighbour is not null").distinct()
    other = other.withColumn("nth", F.row_number().over(smallest)).where(F.col("nth") <= most + 1).drop("nth")
    own = own.groupBy("anchor", "object_id").agg(F.min("priority").alias("priority"))
    found = own.join(other, "object_id").where("anchor <> neighbour").groupBy("anchor", "neighbour").agg(F.min("priority").alias("priority"))
    by = Window.partitionBy("anchor").orderBy("priority", "neighbour")
    return found.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= most).select("anchor", "neighbour", "rank")
