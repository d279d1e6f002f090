"""Ranked search of symbols: query language, BM25 prefix search, substring and edit-distance fallbacks, rescoring."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S

#: Column weights of the text index and the constants of BM25 (fixed values).
WEIGHTS = {"name": 20.0, "qualified_name": 5.0, "docstring": 1.0, "signature": 2.0}
K1, B = 1.2, 0.75


@dataclass
class Query:
    text: str = ""
    kinds: list[str] = field(default_factory=list)
    languages: list[str] = field(default_factory=list)
    paths: list[str] = field(default_factory=list)
    names: list[str] = field(default_factory=list)


def parse(raw: str) -> Query:
    """``kind: lang: language: path: name:`` filters and free text; quotes span blanks; unknown prefixes stay text."""
    out, words = Query(), []
    fields = {"kind": out.kinds, "lang": out.languages, "language": out.languages, "path": out.paths, "name": out.names}
    for token in re.findall(r'(?:[^\s"]|"[^"]*"?)+', raw or ""):
        head, colon, rest = token.partition(":")
        value = rest.replace('"', "")
        if colon and head.lower() in fields and value:
            fields[head.lower()].append(value)
        else:
            words.append(token.replace('"', ""))
    out.text = " ".join(w for w in words if w)
    return out


def filtered(nodes: DataFrame, q: Query) -> DataFrame:
    out = nodes.where(F.col("kind").isin(*q.kinds)) if q.kinds else nodes
    return out.where(F.col("language").isin(*q.languages)) if q.languages else out


def bm25(nodes: DataFrame, text: str, columns: dict[str, float] | None = None) -> DataFrame:
    """(id, score): BM25 over weighted columns with the query's words as prefixes, any of which may match.

    Term frequencies come from the row itself; one pass counts documents, words and each term's documents, so only
    these sums are shuffled.
    """
    columns = columns or {c: w for c, w in WEIGHTS.items() if c in nodes.columns}
    terms = sorted({t for t in re.split(r"[^a-z0-9]+", text.lower()) if t})
    if not terms:
        return nodes.select("id", F.lit(0.0).alias("score")).limit(0)
    words = lambda c: F.filter(F.split(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+"), lambda w: F.length(w) > 0)
    split = nodes.select("id", *[words(F.col(c)).alias(f"w_{c}") for c in columns])

    def frequency(term: str) -> Column:
        return sum((F.size(F.filter(f"w_{c}", lambda w: w.startswith(term))) * weight for c, weight in columns.items()), F.lit(0.0))

    counted = split.select(
        "id",
        sum((F.size(f"w_{c}") for c in columns), F.lit(0)).alias("length"),
        *[frequency(t).alias(f"t{i}") for i, t in enumerate(terms)],
    )
    every = counted.agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("all"), *[F.count_if(F.col(f"t{i}") > 0).alias(f"df{i}") for i in range(len(terms))])  # one row
    both = counted.where(sum((F.col(f"t{i}") for i in range(len(terms))), F.lit(0.0)) > 0).join(F.broadcast(every), F.lit(True))
    norm = 1 - B + B * F.col("length") / (F.col("all") / F.col("n"))
    score = F.lit(0.0)
    for i in range(len(terms)):
        idf = F.log(1 + (F.col("n") - F.col(f"df{i}") + 0.5) / (F.col(f"df{i}") + 0.5))
        score = score + idf * F.col(f"t{i}") * (K1 + 1) / (F.col(f"t{i}") + K1 * norm)
    return both.select("id", score.alias("score"))


def like(nodes: DataFrame, text: str) -> DataFrame:
    """(id, score): 1.0 the name, 0.9 its start, 0.8 inside it, 0.7 inside the qualified name."""
    low, name, qualified = text.lower(), F.lower("name"), F.lower("qualified_name")
    score = F.when(F.col("name") == text, 1.0).when(name.startswith(low), 0.9).when(name.contains(low), 0.8).when(qualified.contains(low), 0.7)
    return nodes.select("id", score.alias("score")).where("score is not null")


def fuzzy(nodes: DataFrame, text: str, limit: int = 20, per_name: int = 5) -> DataFrame:
    """(id, score) of names within edit distance 1, or 2 from five letters: 1 / (1 + distance), five rows a name."""
    most = 1 if len(text) <= 4 else 2
    distance = F.levenshtein(F.lower("name"), F.lit(text.lower()), most)
    names = nodes.select("name").distinct().select("name", distance.alias("d")).where("d >= 0").orderBy("d", "name").limit(max(2 * limit, 50))
    by = Window.partitionBy("name").orderBy("id")
    return nodes.join(F.broadcast(names), "name").withColumn("nth", F.row_number().over(by)).where(F.col("nth") <= per_name).select("id", (1 / (1 + F.col("d"))).alias("score"))


def search(nodes: DataFrame, raw: str, limit: int = 20) -> DataFrame:
    """(id, kind, name, file_path, score): the first channel with hits, exact names added, rescored and cut, then gated.

    All channels are one job: each row carries its channel's priority and only the lowest present priority stays.
    """
    q = parse(raw)
    own = filtered(nodes, q)
    if not q.text:
        scored = own.orderBy("name", "id").limit(5 * limit).withColumn("score", F.lit(1.0))
    else:
        found = bm25(own, q.text).withColumn("channel", F.lit(1))
        if len(q.text) >= 2:
            found = found.unionByName(like(own, q.text).withColumn("channel", F.lit(2)))
        if len(q.text) >= 3:
            found = found.unionByName(fuzzy(own, q.text, limit).withColumn("channel", F.lit(3)))
        first = F.broadcast(found.agg(F.min("channel").alias("first"), F.max(F.when(F.col("channel") == 1, F.col("score"))).alias("best")))  # one row
        base = found.join(first, F.col("channel") == F.col("first")).select("id", "score", "best")
        wanted = [t.lower() for t in q.text.split()]
        exact = own.where(F.lower("name").isin(*wanted)).withColumn("nth", F.row_number().over(Window.partitionBy(F.lower("name")).orderBy("id"))).where("nth <= 20").select("id").join(F.broadcast(first.select("best")), F.lit(True)).select("id", F.coalesce("best", F.lit(1.0)).alias("score"), "best")
        base = base.unionByName(exact).groupBy("id").agg(F.max("score").alias("base"))
        top = base.orderBy(F.desc("base"), "id").limit(max(5 * limit, 100))
        scored = own.join(top, "id").withColumn("score", F.col("base") + S.kind_bonus(F.col("kind")) + S.path_relevance(F.col("file_path"), q.text) + S.name_bonus(F.col("name"), q.text))
    best = scored.orderBy(F.desc("score"), "id").limit(limit)
    for column, terms in (("file_path", q.paths), ("name", q.names)):  # hard gates stand after the limit on purpose
        for_any = None
        for t in terms:
            hit = F.lower(column).contains(t.lower())
            for_any = hit if for_any is None else for_any | hit
        if for_any is not None:
            best = best.where(for_any)
    return best.select("id", "kind", "name", "file_path", "score")


#: Languages that share types, by family; others are families of their own (fixed values).
FAMILIES = {"java": "jvm", "kotlin": "jvm", "scala": "jvm", "swift": "apple", "objc": "apple", "typescript": "web", "tsx": "web", "javascript": "web", "jsx": "web", "c": "c", "cpp": "c", "csharp": "dotnet", "razor": "dotnet"}
CALLABLE = ("function", "method", "class")
#: Weights of a candidate among several, and what makes it near (fixed values).
SAME_FILE, SHARED_FOLDER, MOST_SHARED, SAME_LANGUAGE, OTHER_LANGUAGE, FIT_KIND, SOME_FIT, EXPORTED, NEAR = 100, 15, 80, 50, -80, 25, 15, 10, 30
_FILE_NAME = r"\.[A-Za-z][A-Za-z0-9]{0,3}$"


def family(language: Column) -> Column:
    """A language's family, or null where it is one of its own."""
    table = F.create_map(*[F.lit(x) for kv in FAMILIES.items() for x in kv])
    return F.try_element_at(table, language)


def language_gate(kind: Column, a: Column, b: Column) -> Column:
    """Whether a reference of a kind may cross from language ``a`` to ``b``: type references stay in the family, imports do
    not cross two known families, the rest may."""
    same = (a == b) | F.coalesce(family(a) == family(b), F.lit(False))
    crosses = family(a).isNotNull() & family(b).isNotNull() & ~same
    return F.when(kind.isin("references", "function_ref"), same).when(kind == "imports", ~crosses).otherwise(True)


def proximity(a: Column, b: Column) -> Column:
    """15 for each folder that two paths share from the root, 80 at most."""
    folders = lambda p: F.slice(F.split(p, "/"), 1, F.size(F.split(p, "/")) - 1)
    same = F.zip_with(folders(a), folders(b), lambda x, y: F.coalesce(x == y, F.lit(False)))
    shared = F.array_position(F.concat(same, F.array(F.lit(False))), F.lit(False)) - 1
    return F.least(shared * SHARED_FOLDER, F.lit(MOST_SHARED))


def possible(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """References of which the name, or its part before or after the first or behind the last ``.`` or ``::``, or its file
    name, is some node's name."""
    name = F.col("name")

    def parts(mark: str):
        at = F.instr(name, mark)
        first, rest = F.substring(name, F.lit(1), at - 1), F.substring(name, at + len(mark), F.length(name))
        more = [first, rest, F.substring_index(name, mark, -1)]
        if mark == ".":
            more.append(F.concat(F.upper(F.substring(first, 1, 1)), F.substring(first, F.lit(2), F.length(first))))
        return F.when(at > 1, F.array(*more)).otherwise(F.array().cast("array<string>"))

    file = F.when(F.instr(name, "/") > 1, F.array(F.substring_index(name, "/", -1))).otherwise(F.array().cast("array<string>"))
    tried = refs.select("ref_id", F.explode(F.array_distinct(F.concat(F.array(name), parts("."), parts("::"), file))).alias("part"))
    known = tried.join(nodes.select(F.col("name").alias("part")).distinct(), "part", "left_semi").select("ref_id").distinct()
    return refs.join(known, "ref_id", "left_semi")


def resolve(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(ref_id, target, strategy, confidence): the first strategy that finds a target for a reference.

    ``refs`` has (ref_id, name, kind, language, file_path, line). In order: the path of a file (0.95 whole, 0.85 its end and the
    nearest, 0.7 the only one of its name); a qualified name (0.95 if unique, else 0.85 by its end); an exact name (0.9
    alone, 0.5 alone in another language, of several the best by file, folders, language, kind and export: 0.7 if near,
    else 0.4); a name that differs in case and is the only callable one, in the same language if there is any (0.5, else
    0.3). Imports are no targets of names. Ties go to the smallest id. Equal references are resolved once.
    """
    same = ["name", "kind", "language", "file_path", "line"]
    own = refs.select(*same).distinct().withColumn("r", F.xxhash64(*same))
    cand = nodes.select(F.col("id").alias("target"), F.col("name").alias("n_name"), "qualified_name", F.col("kind").alias("n_kind"), F.col("language").alias("n_language"), F.col("file_path").alias("n_file"), F.col("is_exported").alias("n_exported"), F.col("start_line").alias("n_line"))
    by_ref = Window.partitionBy("r")
    best = lambda df, *order: df.withColumn("nth", F.row_number().over(by_ref.orderBy(*order))).where("nth = 1").drop("nth")
    named = lambda df, priority, strategy, confidence: df.select("r", "target", F.lit(priority).alias("priority"), F.lit(strategy).alias("strategy"), confidence.alias("confidence"))
    gate = language_gate(F.col("kind"), F.col("n_language"), F.col("language"))
    near = proximity(F.col("file_path"), F.col("n_file"))

    file = own.where(F.col("name").contains("/") | F.col("name").rlike(_FILE_NAME)).withColumn("base", F.substring_index("name", "/", -1)).join(cand.where("n_kind = 'file'"), F.col("base") == F.col("n_name"))
    whole = (F.col("qualified_name") == F.col("name")) | (F.col("n_file") == F.col("name"))
    ends = F.col("qualified_name").endswith(F.col("name")) | F.col("n_file").endswith(F.col("name"))
    closeness = F.when(S.dirname(F.col("n_file")) == S.dirname(F.col("file_path")), 1000).otherwise(0) + near + F.when((F.col("language") == F.col("n_language")) | F.coalesce(family(F.col("language")) == family(F.col("n_language")), F.lit(False)), 5).otherwise(0)
    file = file.withColumns({"n": F.count(F.lit(1)).over(by_ref), "rank": F.when(whole, 0).when(ends, 1).otherwise(2), "close": F.when(ends & ~whole, closeness).otherwise(0)})
    file = best(file.where("rank < 2 or n = 1"), "rank", F.desc("close"), "target")
    file = named(file, 0, "file-path", F.when(F.col("rank") == 0, 0.95).when(F.col("rank") == 1, 0.85).otherwise(0.7))

    scoped = own.where(F.col("name").contains("::") | F.col("name").contains("."))
    qualified = scoped.join(cand, F.col("name") == F.col("qualified_name")).withColumn("n", F.count(F.lit(1)).over(by_ref)).where("n = 1")
    qualified = named(qualified, 1, "qualified-name", F.lit(0.95))
    last = F.element_at(F.split("name", "[:.]"), -1)
    partial = scoped.withColumn("last", last).where("last <> ''").join(cand, F.col("last") == F.col("n_name")).where(F.col("qualified_name").endswith(F.col("name")))
    partial = named(best(partial, "target"), 2, "qualified-name", F.lit(0.85))

    exact = own.join(cand.where("n_kind <> 'import'"), F.col("name") == F.col("n_name")).where(gate).withColumns({"n": F.count(F.lit(1)).over(by_ref), "any_same": F.max((F.col("language") == F.col("n_language")).cast("int")).over(by_ref)})
    here, call, new, mark = F.col("file_path") == F.col("n_file"), F.col("kind") == "calls", F.col("kind") == "instantiates", F.col("kind") == "decorates"
    routine, typed = F.col("n_kind").isin("function", "method"), F.col("n_kind").isin("class", "struct", "interface")
    score = (
        F.when(here, SAME_FILE + F.greatest(F.lit(0.0), 20 - F.abs(F.col("n_line") - F.col("line")) / 10)).otherwise(0)
        + near
        + F.when(F.col("language") == F.col("n_language"), SAME_LANGUAGE).otherwise(OTHER_LANGUAGE)
        + F.when((call | mark) & routine | new & typed, FIT_KIND).when(mark & F.col("n_kind").isin("class", "interface"), SOME_FIT).otherwise(0)
        + F.when(F.col("n_exported") == 1, EXPORTED).otherwise(0)
    )
    exact = exact.withColumns({"score": score, "near": near}).where((F.col("n") == 1) | ((F.col("language") == F.col("n_language")) | (F.col("any_same") == 0)) & (F.col("score") > -1))
    alone = F.when(F.col("language") == F.col("n_language"), 0.9).otherwise(0.5)
    exact = named(best(exact, F.desc("score"), "target"), 3, "exact-match", F.when(F.col("n") == 1, alone).when(F.col("near") >= NEAR, 0.7).otherwise(0.4))

    loose = own.join(cand.where(F.col("n_kind").isin(*CALLABLE)), F.lower("name") == F.lower("n_name")).where(gate).withColumn("alike", (F.col("language") == F.col("n_language")).cast("int"))
    loose = loose.withColumn("any_same", F.max("alike").over(by_ref)).where("alike = any_same").withColumn("n", F.count(F.lit(1)).over(by_ref)).where("n = 1")
    loose = named(loose, 4, "fuzzy", F.when(F.col("alike") == 1, 0.5).otherwise(0.3))

    every = file.unionByName(qualified).unionByName(partial).unionByName(exact).unionByName(loose)
    chosen = best(every, "priority").drop("priority")
    # by the hash of all fields, null ones too
    return refs.withColumn("r", F.xxhash64(*same)).join(chosen, "r").select("ref_id", "target", "strategy", "confidence")


def promoted(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges where an ``extends`` of something that is no interface to an interface is an ``implements``."""
    kinds = nodes.select("id", F.col("kind").alias("k"))
    own = edges.join(kinds.withColumnsRenamed({"id": "source", "k": "s_kind"}), "source", "left").join(kinds.withColumnsRenamed({"id": "target", "k": "t_kind"}), "target", "left")
    abstract = lambda c: F.col(c).isin("interface", "protocol")
    becomes = (F.col("kind") == "extends") & F.coalesce(abstract("t_kind"), F.lit(False)) & F.coalesce(~abstract("s_kind"), F.lit(False))
    return own.withColumn("kind", F.when(becomes, "implements").when(F.col("kind") == "function_ref", "references").otherwise(F.col("kind"))).select(edges.columns)


def method_calls(refs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(ref_id, target): ``receiver.member`` references to a method whose qualified name is ``receiver::member`` or ends so,
    the receiver as written or capitalised; only unique ones."""
    own = refs.where(F.col("name").rlike(r"^\w+\.\w+$")).withColumns({"receiver": F.substring_index("name", ".", 1), "member": F.substring_index("name", ".", -1)})
    capital = F.concat(F.upper(F.substring("receiver", 1, 1)), F.substring(F.col("receiver"), F.lit(2), F.length("receiver")))
    cand = nodes.where(F.col("kind").isin("method", "function")).select(F.col("id").alias("target"), F.col("name").alias("member"), "qualified_name")
    fits = lambda r: F.col("qualified_name").endswith(F.concat(r, F.lit("::"), F.col("member")))
    found = own.join(cand, "member").where(fits(F.col("receiver")) | fits(capital))
    return found.groupBy("ref_id").agg(F.min("target").alias("target"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")
