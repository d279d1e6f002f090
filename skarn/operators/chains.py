"""Calls on what calls return: ``Factory.make().next().run`` resolved link by link, through supertypes.

``refs`` has (ref_id, name, language, file_path); ``nodes`` also has return_type, the simple name of what a routine returns,
``self`` for its own type. The type of the first link comes from its text; each round then looks the next link's method up
on the types found so far and takes on the type that it returns, so all references advance together and a round is a few
equi-joins. A method counts where a node has it: a wrong guess finds nothing. What a type doesn't have itself comes from
the nearest of its supertypes, four levels up at most.

Defined results: references of another shape, of unknown types or with a link that no type has are left out. Ties go to
the smallest id, and to the nearest supertype in place of the first in depth. References that repeat an id are resolved for
each row. Null names, languages and types match nothing. ``imports`` (file_path, local_name, source), where given, tells
which of several types of one name a file means. Empty tables give no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import kept

#: Kinds of types that have supertypes, and levels that are looked at (fixed values).
TYPES = ("class", "struct", "interface", "trait", "protocol", "enum")
MOST_LEVELS = 4
#: Languages whose chains start at a scoped call, whose capitalised calls construct, and the confidences (fixed values).
SCOPED = ("rust", "php")
CONSTRUCTING = ("kotlin", "swift", "scala", "dart", "pascal")
FOUND, ASSUMED = 0.85, 0.8


def supertypes(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(language, type, super, level): each type's name with itself at level 0 and its supertypes' names up to four levels.

    Types are told by name within a language, so what is declared in one node and extended in another counts as one."""
    types = nodes.where(F.col("kind").isin(*TYPES) & F.col("name").isNotNull())
    up = edges.where("kind in ('implements', 'extends')").join(types.select(F.col("id").alias("source"), "language", F.col("name").alias("type")), "source").join(nodes.select(F.col("id").alias("target"), F.col("name").alias("super")), "target")
    up = kept(up.where("super is not null and super <> type").select("language", "type", "super").distinct())
    found = frontier = up.select("language", "type", "super", F.lit(1).alias("level"))
    step = up.select("language", F.col("type").alias("super"), F.col("super").alias("next"))
    for level in range(2, MOST_LEVELS + 1):
        frontier = frontier.join(step, ["language", "super"]).select("language", "type", F.col("next").alias("super")).where("type <> super").distinct()
        frontier = kept(frontier.join(found, ["language", "type", "super"], "left_anti").withColumn("level", F.lit(level)))
        if frontier.isEmpty():
            break
        found = found.unionByName(frontier)
    return found


def _routines(nodes: DataFrame) -> DataFrame:
    return nodes.where("kind in ('method', 'function') and name is not null").select(F.col("id").alias("target"), F.col("kind").alias("n_kind"), F.col("name").alias("method"), "language", "qualified_name", "return_type", F.col("file_path").alias("n_file"))


def _last(name: Column) -> Column:
    return F.element_at(F.split(name, "::|\\."), -1)


def on_types(wanted: DataFrame, nodes: DataFrame, closure: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """(w, target, return_type) of the method that each of ``wanted`` (w, language, type, method, file_path) has on its type
    or on the nearest supertype: one whose qualified name is or ends with ``type::method``."""
    shape = ["w", "language", "type", "method", "file_path"]
    own = wanted.select(*shape, F.col("type").alias("on"), F.lit(0).alias("level"))
    above = wanted.select(*shape).join(closure.select("language", "type", F.col("super").alias("on"), "level"), ["language", "type"]).select(*shape, "on", "level")
    tried = own.unionByName(above).withColumn("want", F.concat("on", F.lit("::"), "method")).withColumn("last", _last(F.col("on")))
    methods = _routines(nodes).where("n_kind = 'method'").withColumn("last", _last(F.regexp_extract("qualified_name", r"^([\s\S]*)::[^:]*$", 1)))
    both = tried.join(methods, ["language", "method", "last"]).where((F.col("qualified_name") == F.col("want")) | F.col("qualified_name").endswith(F.concat(F.lit("::"), F.col("want"))))
    meant = F.lit(1)
    if imports is not None:
        named = imports.groupBy("file_path", F.col("local_name").alias("type")).agg(F.min("source").alias("source"))
        both = both.join(named, ["file_path", "type"], "left")
        ending = F.concat(F.replace("source", F.lit("."), F.lit("/")), F.when(F.col("language") == "kotlin", ".kt").otherwise(".java"))
        meant = F.when(F.col("n_file").endswith(ending), 0).otherwise(1)
    best = both.groupBy("w").agg(F.min_by(F.struct("target", "return_type"), F.struct("level", meant.alias("meant"), "target")).alias("b"))
    return best.select("w", "b.target", "b.return_type")


def _returned(wanted: DataFrame, nodes: DataFrame) -> DataFrame:
    """(w, ret): the return type of the routine ``class::method`` for ``wanted`` (w, language, class, method), where the
    call may name more or fewer scopes than the node; without a class, of the function. Calls and routines meet by the last
    scope too, so that a method's name that many types share makes no pairs of all calls with all types."""
    one = F.struct("target", "return_type")
    routines = _routines(nodes).where("return_type <> ''")
    fields = ["language", "method", "qualified_name"]
    named = routines.where("qualified_name is not null").groupBy(*fields).agg(F.min(one).alias("b")).select(*fields, "b")
    want = F.concat("class", F.lit("::"), "method")
    scope = lambda c: F.regexp_extract(c, r"([^:]*)::([^:]*)$", 1)  # noqa: E731  the same for two names of which one ends the other
    own = wanted.where(F.col("class").isNotNull()).withColumn("want", want).withColumn("scope", scope(F.col("want")))
    scoped = F.col("qualified_name").contains("::")
    fits = (F.col("qualified_name") == F.col("want")) | F.col("qualified_name").endswith(F.concat(F.lit("::"), "want")) | F.col("want").endswith(F.concat(F.lit("::"), "qualified_name"))
    within = own.join(named.where(scoped).withColumn("scope", scope(F.col("qualified_name"))), ["language", "method", "scope"]).where(fits)
    bare = own.join(named.where(~scoped), ["language", "method"]).where(fits)
    free = routines.where("n_kind = 'function'").groupBy("language", "method").agg(F.min(one).alias("b"))
    alone = wanted.where(F.col("class").isNull()).join(free, ["language", "method"])
    every = within.select("w", "b").unionByName(bare.select("w", "b")).unionByName(alone.select("w", "b"))
    return every.groupBy("w").agg(F.min("b").alias("b")).select("w", F.col("b.return_type").alias("ret"))


def _first_types(links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(w, type, sure) of the first links (w, language, first)."""
    language, first = F.col("language"), F.col("first")
    scoped = language.isin(*SCOPED, "cpp")
    parts = F.split(first, r"::")
    by_scope = F.when(F.size(parts) > 1, F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), "::"))
    dots = F.split(first, r"\.")
    by_dot = F.when(F.size(dots) > 1, F.get(dots, F.size(dots) - 2))
    own = links.withColumns({"class": F.when(scoped, by_scope).otherwise(by_dot), "method": F.when(scoped, F.element_at(parts, -1)).otherwise(F.element_at(dots, -1))})
    free = own.where(F.col("class").isNotNull() | language.isin("go", "cpp"))
    own = own.join(_returned(free.select("w", "language", "class", "method"), nodes), "w", "left")
    classes = nodes.where("kind in ('class', 'struct')").select("language", F.col("name").alias("last")).distinct().withColumn("known", F.lit(True))
    own = own.withColumn("last", _last(F.regexp_replace("first", "<.*$", ""))).join(classes, ["language", "last"], "left")
    made = F.regexp_extract("first", r"(?:^|::)(?:make_unique|make_shared)\s*<\s*([A-Za-z_]\w*)", 1)
    capital = F.col("method").rlike("^[A-Z]")
    told = F.when(scoped & (F.col("ret") == "self"), F.col("class")).otherwise(F.col("ret"))
    kind = (
        F.when(language == "cpp", F.when(made != "", made).when(F.col("ret").isNotNull(), told).when(F.col("known"), F.col("last")))
        .when(language.isin(*SCOPED), F.when(F.col("class").isNotNull(), told))
        .when(F.col("class").isNull(), F.when(language == "go", F.col("ret")).when(language.isin(*CONSTRUCTING) & capital, first))
        .otherwise(F.coalesce("ret", F.when((language == "objc") & F.col("class").rlike("^[A-Z]") | (language == "pascal") & F.col("class").rlike("^[TI]"), F.col("class"))))
    )
    sure = ~(language.isin("objc", "pascal") & F.col("class").isNotNull() & F.col("ret").isNull())
    return own.select("w", kind.alias("type"), sure.alias("sure")).where("type is not null")


def chains(refs: DataFrame, nodes: DataFrame, edges: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """(ref_id, target, confidence) of the references ``first().next()...method`` whose links all resolve."""
    shape = ["name", "language", "file_path"]
    asked = refs.where(F.col("name").rlike(r"^.+\(\)\.\w+$")).select(*shape).distinct().withColumn("w", F.xxhash64(*shape))
    links = F.split("name", r"\(\)\.")
    asked = kept(asked.select("w", *shape, F.get(links, 0).alias("first"), F.slice(links, 2, F.size(links)).alias("links")))
    closure = kept(supertypes(nodes, edges))
    state = asked.select("w", "language", "file_path", "links", "first").join(_first_types(asked.select("w", "language", "first"), nodes), "w").drop("first")
    state, found, k = kept(state), None, 0
    while not state.isEmpty():
        wanted = state.select("w", "language", "type", F.get("links", k).alias("method"), "file_path")
        hit = state.join(on_types(wanted, nodes, closure, imports), "w")
        last = F.size("links") == k + 1
        done = hit.where(last).select("w", "target", F.when(F.col("sure"), FOUND).otherwise(ASSUMED).alias("confidence"))
        done = kept(done)
        found = done if found is None else found.unionByName(done)
        returned = F.when(F.col("return_type") == "self", F.col("type")).otherwise(F.nullif("return_type", F.lit("")))
        state = kept(hit.where(~last).select("w", "language", "file_path", "links", returned.alias("type"), "sure").where("type is not null"))
        k += 1
    if found is None:
        return refs.select("ref_id", F.lit(None).cast("string").alias("target"), F.lit(None).cast("double").alias("confidence")).where(F.lit(False))
    keyed = refs.withColumn("w", F.xxhash64(*shape)).select("ref_id", "w")
    return keyed.join(found, "w").select("ref_id", "target", "confidence")


def field_calls(refs: DataFrame, nodes: DataFrame, edges: DataFrame, imports: DataFrame | None = None) -> DataFrame:
    """(ref_id, target, confidence): Java and Kotlin references ``field.method`` where the class around the reference has a
    field of that name, whose signature begins with its type.

    ``refs`` also has ``line``; ``nodes`` also has signature and end_line. The class is the innermost around the line."""
    from .synthesis import enclosing

    own = refs.where(F.col("language").isin("java", "kotlin") & F.col("name").rlike(r"^\w+\.\w+$"))
    spans = nodes.where("kind in ('class', 'interface', 'enum') and language in ('java', 'kotlin')")
    placed = enclosing(own.select("ref_id", "name", "language", "file_path", "line"), spans).withColumn("field", F.substring_index("name", ".", 1))
    fields = nodes.where("kind in ('field', 'property')").join(spans.select(F.col("id").alias("owner"), "file_path", F.col("start_line").alias("low"), F.col("end_line").alias("high")), "file_path").where("start_line between low and high")
    bare = F.element_at(F.split(F.trim(F.regexp_replace(F.regexp_extract("signature", r"^([\s\S]+)\s+\S+$", 1), "<[^>]*>", "")), r"[\s.]+"), -1)
    fields = fields.select("owner", F.col("name").alias("field"), bare.alias("type"), "id").where("type <> ''").groupBy("owner", "field").agg(F.min_by("type", "id").alias("type"))
    wanted = placed.join(fields, ["owner", "field"]).select(F.col("ref_id").alias("w"), "language", "type", F.substring_index("name", ".", -1).alias("method"), "file_path")
    found = on_types(wanted, nodes, kept(supertypes(nodes, edges)), imports)
    return found.select(F.col("w").alias("ref_id"), "target", F.lit(0.9).alias("confidence"))
