"""Graph operators over ``nodes`` and ``edges`` tables: lookups, traversals, impact, paths, cycles, rank.

Traversals are level-synchronous: each round joins the frontier with the edges and drops what was seen, so a node's depth
is its smallest. Frontiers are checkpointed in the shared folder, which ends their lineage and survives lost executors.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Edge kinds that make a caller (fixed values).
CALL_KINDS = ("calls", "references", "imports", "instantiates")
CONTAINERS = ("class", "interface", "struct", "trait", "protocol", "module", "enum")
DEAD_KINDS = ("function", "method", "class")
#: Ids that go to every task beside a part of the edges.
SMALL_FRONTIER = 100_000
RANK_KINDS = ("calls", "references", "extends", "implements", "overrides", "instantiates", "returns", "type_of", "imports")


def _checkpoints(spark) -> str:
    """The checkpoint folder: in spark.checkpoint.dir; in local mode, where that is unset, a temporary one."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or "file://" + tempfile.mkdtemp(prefix="skarn-"))
    return sc._jsc.sc().getCheckpointDir().get()


def kept(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the checkpoint folder."""
    _checkpoints(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame) -> DataFrame:
    """``df`` as a compressed table in the checkpoint folder, for rows that are too many for checkpoints; ``let_go`` ends it."""
    spark = df.sparkSession
    path = f"{_checkpoints(spark).rstrip('/')}/skarn-{uuid.uuid4().hex}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_at = [path]
    return out


def together(tables: list[DataFrame]) -> DataFrame:
    """The rows of several ``written`` tables as one."""
    paths = [p for t in tables for p in t._written_at]
    out = tables[0].sparkSession.read.schema(tables[0].schema).parquet(*paths)
    out._written_at = paths
    return out


def let_go(spark, *tables: DataFrame) -> None:
    """Delete ``written`` tables that nothing reads any more, and let Spark find the shuffles that no plan uses."""
    for df in tables:
        for path in df._written_at:
            hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)
    spark.sparkContext._jvm.System.gc()


def ids(df: DataFrame, names: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(n,) for n in names], "id string")


def directed(edges: DataFrame, direction: str = "out", kinds: tuple | None = None) -> DataFrame:
    """(at, to, kind): one step along the edges in a direction."""
    own = edges.where(F.col("kind").isin(*kinds)) if kinds else edges
    out = own.select(F.col("source").alias("at"), F.col("target").alias("to"), "kind")
    back = own.select(F.col("target").alias("at"), F.col("source").alias("to"), "kind")
    return {"out": out, "in": back, "both": out.unionByName(back)}[direction]


def reach(edges: DataFrame, start: DataFrame, max_depth: int | None = None, direction: str = "out", kinds: tuple | None = None, stop: DataFrame | None = None) -> DataFrame:
    """(id, depth) of everything within ``max_depth`` steps of ``start`` (ids). Nodes in ``stop`` are reached but not left."""
    step = directed(edges, direction, kinds).select("at", "to")  # repeated steps go with what they reach
    frontier = kept(start.select("id").distinct().withColumn("depth", F.lit(0)))
    seen, depth, n = frontier, 0, frontier.count()
    while max_depth is None or depth < max_depth:
        depth += 1
        leave = frontier if stop is None else frontier.join(stop.select("id"), "id", "left_anti")
        leave = F.broadcast(leave) if n <= SMALL_FRONTIER else leave  # spares the edges a shuffle
        frontier = kept(leave.join(step, leave["id"] == step["at"]).select(F.col("to").alias("id")).distinct().join(seen, "id", "left_anti").withColumn("depth", F.lit(depth)))
        n = frontier.count()
        if not n:
            break
        seen = seen.unionByName(frontier)
    return seen


def neighbours(edges: DataFrame, start: DataFrame, direction: str = "out", kinds: tuple | None = None) -> DataFrame:
    """One row for each edge at the start nodes."""
    step = directed(edges, direction, kinds)
    return start.join(step, start["id"] == step["at"]).select("id", F.col("to").alias("other"), "kind")


def callers(edges: DataFrame, start: DataFrame, depth: int = 1) -> DataFrame:
    return neighbours(edges, start, "in", CALL_KINDS) if depth == 1 else reach(edges, start, depth, "in", CALL_KINDS).where("depth > 0")


def callees(edges: DataFrame, start: DataFrame, depth: int = 1) -> DataFrame:
    return neighbours(edges, start, "out", CALL_KINDS) if depth == 1 else reach(edges, start, depth, "out", CALL_KINDS).where("depth > 0")


def call_graph(edges: DataFrame, start: DataFrame, depth: int = 2) -> DataFrame:
    """(id, depth): callers with negative depth, callees with positive depth, the focal nodes 0; the nearer side counts."""
    up = reach(edges, start, depth, "in", CALL_KINDS).select("id", (-F.col("depth")).alias("depth"))
    both = up.unionByName(reach(edges, start, depth, "out", CALL_KINDS))
    return both.groupBy("id").agg(F.min_by("depth", F.struct(F.abs("depth"), -F.col("depth"))).alias("depth"))


def impact(nodes: DataFrame, edges: DataFrame, start: DataFrame, depth: int = 3) -> DataFrame:
    """(id, depth): what depends on the start nodes. A container's members share its depth, unless it is reached at the last
    depth; containment is no dependency. With a column ``root`` in ``start``, (root, id, depth) for each root by itself."""
    key = [c for c in ("root", "id") if c in start.columns]
    root = key[:-1]
    containers = nodes.where(F.col("kind").isin(*CONTAINERS)).select("id")
    inside = kept(edges.where("kind = 'contains'").join(containers.withColumnRenamed("id", "source"), "source", "left_semi").select("source", "target"))
    depends = kept(edges.where("kind <> 'contains'").select("source", "target"))

    def members(x: DataFrame) -> DataFrame:
        own = x
        while True:
            inner = own.join(inside, F.col("id") == F.col("source")).select(*root, F.col("target").alias("id")).distinct()
            new = kept(inner.join(x, key, "left_anti"))
            if new.isEmpty():
                return x
            own, x = new, kept(x.unionByName(new))

    first = kept(start.select(*key).distinct())
    seen = (members(first) if depth else first).withColumn("depth", F.lit(0))
    frontier = seen
    for d in range(1, depth + 1):
        new = kept(frontier.join(depends, F.col("id") == F.col("target")).select(*root, F.col("source").alias("id")).distinct().join(seen, key, "left_anti"))
        new = (members(new) if d < depth else new).join(seen, key, "left_anti").select(*key).withColumn("depth", F.lit(d))
        frontier = kept(new)
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def definitions_impact(nodes: DataFrame, edges: DataFrame, name: str, depth: int = 2) -> DataFrame:
    """(root, id, depth) for every definition ``root`` of a name, whatever its case."""
    own = nodes.where((F.lower("name") == name.lower()) & ~F.col("kind").isin("import", "file")).select("id", F.col("id").alias("root"))
    return impact(nodes, edges, own, depth)


def node_context(nodes: DataFrame, edges: DataFrame, start: DataFrame) -> DataFrame:
    """(id, role, other, kind): ancestors, children, incoming and outgoing references, types and imports of nodes."""
    types, refs = ("type_of", "returns"), F.col("kind") != "contains"
    out, back = neighbours(edges, start, "out"), neighbours(edges, start, "in")
    rows = [
        ancestors(edges, start).select("id", F.lit("ancestor").alias("role"), F.col("ancestor").alias("other"), F.lit("contains").alias("kind")),
        out.where("kind = 'contains'").select("id", F.lit("child").alias("role"), "other", "kind"),
        back.where(refs).select("id", F.lit("incoming").alias("role"), "other", "kind"),
        out.where(refs).select("id", F.lit("outgoing").alias("role"), "other", "kind"),
        out.where(F.col("kind").isin(*types)).select("id", F.lit("type").alias("role"), "other", "kind"),
        out.where("kind = 'imports'").select("id", F.lit("import").alias("role"), "other", "kind"),
    ]
    all_rows = rows[0]
    for r in rows[1:]:
        all_rows = all_rows.unionByName(r)
    return all_rows


def shortest_path(edges: DataFrame, source: str, target: str, kinds: tuple | None = None) -> DataFrame:
    """(position, id) of one shortest path, of these the smallest by its ids; empty if there is none."""
    spark = edges.sparkSession
    start = spark.createDataFrame([(source,)], "id string")
    if source == target:
        return start.select(F.lit(0).alias("position"), "id")
    step = kept(directed(edges, "out", kinds).select("at", "to").distinct())
    frontier = kept(start.withColumn("path", F.array("id")))
    seen = frontier.select("id")
    while True:
        paths = frontier.join(step, frontier["id"] == step["at"]).select(F.col("to").alias("id"), F.concat("path", F.array("to")).alias("path")).join(seen, "id", "left_anti")
        frontier = kept(paths.groupBy("id").agg(F.min("path").alias("path")))
        if frontier.isEmpty():
            return spark.createDataFrame([], "position int, id string")
        hit = frontier.where(F.col("id") == target)
        if not hit.isEmpty():
            return hit.select(F.posexplode("path").alias("position", "id"))
        seen = seen.unionByName(frontier.select("id"))


def ancestors(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(id, ancestor, level) along each node's first containing edge: by ``id`` of the edges if they have one, else by the
    smallest container."""
    holds = edges.where("kind = 'contains'").groupBy(F.col("target").alias("child"))
    parent = kept(holds.agg((F.min_by("source", "id") if "id" in edges.columns else F.min("source")).alias("parent")))
    frontier = kept(start.select("id", F.col("id").alias("ancestor")))
    out, level = None, 0
    while True:
        level += 1
        up = frontier.join(parent, frontier["ancestor"] == parent["child"]).select("id", F.col("parent").alias("ancestor")).where("id <> ancestor")
        if out is not None:  # a cycle of containment ends where it meets itself
            up = up.join(out.select("id", "ancestor"), ["id", "ancestor"], "left_anti")
        frontier = kept(up)
        if frontier.isEmpty():
            break
        rows = frontier.withColumn("level", F.lit(level))
        out = rows if out is None else out.unionByName(rows)
    return out if out is not None else start.select("id", F.col("id").alias("ancestor"), F.lit(0).alias("level")).limit(0)


def hierarchy(edges: DataFrame, start: DataFrame, kinds: tuple = ("extends", "implements"), ancestors_only: bool = False) -> DataFrame:
    """(id, depth): supertypes with positive depth and subtypes with negative."""
    up = reach(edges, start, None, "out", kinds)
    if ancestors_only:
        return up
    return up.unionByName(reach(edges, start, None, "in", kinds).where("depth > 0").select("id", (-F.col("depth")).alias("depth")))


def dead_code(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Unexported functions, methods and classes that nothing but a container points to."""
    used = edges.where("kind <> 'contains'").select(F.col("target").alias("id")).distinct()
    return nodes.where(F.col("kind").isin(*DEAD_KINDS) & (F.col("is_exported") == 0)).join(used, "id", "left_anti")


def stats(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(what, value, n): nodes by kind and by language, edges by kind, in one pass of each table."""
    both = F.array(F.struct(F.lit("kind").alias("what"), F.col("kind").alias("value")), F.struct(F.lit("language").alias("what"), F.col("language").alias("value")))
    by_node = nodes.select(F.explode(both).alias("x")).groupBy("x.what", "x.value").agg(F.count(F.lit(1)).alias("n"))
    by_edge = edges.groupBy(F.lit("edge").alias("what"), F.col("kind").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return by_node.unionByName(by_edge)


def metrics(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """In, out, call, caller and child counts of every node."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("source").alias("id"), F.lit(True).alias("out")), F.struct(F.col("target").alias("id"), F.lit(False).alias("out")))).alias("e"), "kind").select("e.id", "e.out", "kind")
    counted = ends.groupBy("id").agg(
        F.count_if("out").alias("n_out"), F.count_if(~F.col("out")).alias("n_in"), F.count_if(F.col("out") & (F.col("kind") == "calls")).alias("n_calls"), F.count_if(~F.col("out") & (F.col("kind") == "calls")).alias("n_callers"), F.count_if(F.col("out") & (F.col("kind") == "contains")).alias("n_children")
    )
    return nodes.select("id", "kind").join(counted, "id", "left").na.fill(0, ["n_out", "n_in", "n_calls", "n_callers", "n_children"])


def file_edges(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(source_file, target_file, n) of edges between files, containment aside."""
    at = nodes.select("id", "file_path")
    a, b = at.withColumnsRenamed({"id": "source", "file_path": "source_file"}), at.withColumnsRenamed({"id": "target", "file_path": "target_file"})
    return edges.where("kind <> 'contains'").join(a, "source").join(b, "target").where("source_file <> target_file").groupBy("source_file", "target_file").agg(F.count(F.lit(1)).alias("n"))


def dominant_files(nodes: DataFrame, edges: DataFrame, low_value: Column, top: int = 20, least: int = 20) -> DataFrame:
    """(rank, file_path, n): of the ``top`` files by edges within the file, the best two that are no tests or generated; empty
    unless the first has ``least`` edges."""
    at = nodes.select("id", "file_path")
    a, b = at.withColumnsRenamed({"id": "source", "file_path": "file_a"}), at.withColumnsRenamed({"id": "target", "file_path": "file_b"})
    inside = edges.join(a, "source").join(b, "target").where("file_a = file_b").groupBy(F.col("file_a").alias("file_path")).agg(F.count(F.lit(1)).alias("n"))
    by = Window.orderBy(F.desc("n"), "file_path")  # over ``top`` rows
    best = inside.orderBy(F.desc("n"), "file_path").limit(top).where(~low_value).withColumns({"rank": F.row_number().over(by), "most": F.max("n").over(Window.partitionBy())})
    return best.where((F.col("rank") <= 2) & (F.col("most") >= least)).select("rank", "file_path", "n")


def top_route_file(nodes: DataFrame, low_value: Column, top: int = 20) -> DataFrame:
    """(file_path, n, total): the file with most routes among the ``top`` files that are no tests or generated, if it has 3
    and at least 30 of 100 of theirs."""
    counted = nodes.where("kind = 'route'").groupBy("file_path").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "file_path").limit(top).where(~low_value)
    first = counted.withColumn("total", F.sum("n").over(Window.partitionBy())).orderBy(F.desc("n"), "file_path").limit(1)
    return first.where("n >= 3 and total >= 3 and n / total >= 0.30")


def routing_manifest(nodes: DataFrame, edges: DataFrame, low_value: Column, limit: int = 40) -> DataFrame:
    """(url, handler, handler_file, handler_line, handler_kind): what handles the first ``limit`` routes, tests and generated
    files left out after the limit."""
    r = nodes.where("kind = 'route'").select(F.col("id").alias("source"), F.col("name").alias("url"), F.col("file_path").alias("r_file"), F.col("start_line").alias("r_line"))
    h = nodes.where(F.col("kind").isin(*DEAD_KINDS)).select(F.col("id").alias("target"), F.col("name").alias("handler"), F.col("file_path").alias("handler_file"), F.col("start_line").alias("handler_line"), F.col("kind").alias("handler_kind"))
    both = edges.where("kind in ('references', 'calls')").select("source", "target").join(r, "source").join(h, "target")
    first = both.orderBy("r_file", "r_line", "source", "target").limit(limit).withColumnRenamed("handler_file", "file_path").where(~low_value)
    return first.select("url", "handler", F.col("file_path").alias("handler_file"), "handler_line", "handler_kind")


def _trimmed(own: DataFrame) -> DataFrame:
    """Edges between nodes that have both a predecessor and a successor."""
    n = own.count()
    while True:
        ends = own.select(F.col("source").alias("x")).distinct().join(own.select(F.col("target").alias("x")).distinct(), "x", "left_semi")
        less = kept(own.join(ends.withColumnRenamed("x", "source"), "source", "left_semi").join(ends.withColumnRenamed("x", "target"), "target", "left_semi").select("source", "target"))
        m = less.count()
        if m == n:
            return less
        own, n = less, m


def cycles(deps: DataFrame) -> DataFrame:
    """(id, component): members of strongly connected components of two or more, named by the smallest member.

    By colouring: nodes without a predecessor or successor go; every node takes the smallest id that reaches it; what has
    a colour and reaches the node of that name is its component and goes. Work is edges times rounds, not pairs of nodes.
    """
    own, out = kept(deps.select("source", "target").where("source <> target").distinct()), None
    while True:
        own = _trimmed(own)
        if own.isEmpty():
            break
        colour = kept(own.select(F.col("source").alias("id")).distinct().withColumn("colour", F.col("id")))
        while True:  # the smallest id that reaches a node
            heard = own.join(colour, own["source"] == colour["id"]).select(F.col("target").alias("id"), "colour")
            now = colour.unionByName(heard).groupBy("id").agg(F.min("colour").alias("colour"))
            now = kept(now.join(colour.withColumnRenamed("colour", "old"), "id"))
            colour = now.select("id", "colour")
            if now.where("colour <> old").isEmpty():
                break
        a, b = (colour.select(F.col("id").alias(x), F.col("colour").alias(x + "_colour")) for x in ("source", "target"))
        same = kept(own.join(a, "source").join(b, "target").where("source_colour = target_colour").select("source", "target"))
        found = kept(colour.where("id = colour"))
        frontier = found
        while True:  # back from each root within its colour
            back = same.join(frontier, same["target"] == frontier["id"]).select(F.col("source").alias("id"), "colour").distinct()
            frontier = kept(back.join(found, "id", "left_anti"))
            if frontier.isEmpty():
                break
            found = kept(found.unionByName(frontier))
        out = found if out is None else out.unionByName(found)
        gone = found.select("id")
        own = kept(own.join(gone, own["source"] == gone["id"], "left_anti").join(gone, F.col("target") == gone["id"], "left_anti"))
    if out is None:
        return deps.select(F.col("source").alias("id"), F.col("source").alias("component")).limit(0)
    large = out.groupBy("colour").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("colour")
    return out.join(large, "colour").select("id", F.col("colour").alias("component"))


#: Steps along edges, of both directions, that are shuffled at once.
SLICE_STEPS = 24_000_000


def pagerank(nodes: DataFrame, edges: DataFrame, seeds: DataFrame | None = None, restart: float = 0.25, rounds: int = 25, kinds: tuple = RANK_KINDS, slice_steps: int = SLICE_STEPS) -> DataFrame:
    """(id, rank): personalised over the undirected multigraph of the given nodes, loops aside; isolated nodes keep their
    mass; the restart goes to the seeds among the nodes, or to all nodes if there are none.

    Of a large graph the nodes are dealt with in slices by a hash, one after the other, and what a slice shuffled goes before
    the next one. A slice's steps, the repeated ones as one with their number, are written once and read in each round: the
    edges themselves are read twice for each slice, however many rounds there are. Nodes and ends are told by 64-bit hashes
    of their ids, or by the ids where two nodes have the same hash."""
    spark, n = nodes.sparkSession, nodes.select("id")
    known = n.where("id is not null").distinct()
    told = known.agg(F.count(F.lit(1)), F.count_distinct(F.xxhash64("id"))).first()
    key = (lambda c: F.when(F.col(c).isNotNull(), F.xxhash64(c))) if told[0] == told[1] else F.col
    own = edges.where("source <> target").select("source", "target", "kind")
    both = directed(own, "both", kinds).select(key("at").alias("at"), key("to").alias("to"))
    slices = max(1, -(-both.count() // slice_steps))
    part = lambda df, c, k: df if slices == 1 else df.where(F.pmod(F.xxhash64(c), F.lit(slices)) == k)

    def each(make) -> DataFrame:
        out = []
        for k in range(slices):
            out.append(written(make(k)))
            let_go(spark)
        return together(out)

    inside = known.select(key("id").alias("key"))
    steps = []
    for k in range(slices):
        held = part(both, "to", k).repartition("to").groupBy("to", "at").agg(F.count(F.lit(1)).alias("n"))  # one shuffle, for the next join too
        held = held.join(part(inside, "key", k).withColumnRenamed("key", "to"), "to", "left_semi").join(inside.withColumnRenamed("key", "at"), "at", "left_semi")
        steps.append(written(held.select("to", "at", "n")))
        let_go(spark)
    if seeds is not None:
        seeds = kept(seeds.select("id").distinct().join(n, "id", "left_semi"))
    if seeds is None or seeds.isEmpty():
        seeds = n.distinct()
    share = 1.0 / max(seeds.count(), 1)
    started = seeds.select(key("id").alias("key"), F.lit(share).alias("seed"))
    mine = n.select("id", key("id").alias("key"))

    def first(k):
        degree = steps[k].groupBy(F.col("to").alias("key")).agg(F.sum("n").alias("degree"))  # as many steps lead to a node as from it
        return part(mine, "key", k).join(part(started, "key", k), "key", "left").join(degree, "key", "left").na.fill({"seed": 0.0, "degree": 0}).select("id", "key", "seed", "degree", F.col("seed").alias("rank"))

    last = each(first)
    for _ in range(rounds):

        def ranked(k, last=last):
            gives = last.where("rank > 0 and degree > 0").select(F.col("key").alias("at"), (F.col("rank") / F.col("degree")).alias("share"))
            sent = steps[k].join(gives, "at").groupBy(F.col("to").alias("key")).agg(F.sum(F.col("share") * F.col("n")).alias("got"))
            rank = restart * F.col("seed") + (1 - restart) * (F.coalesce("got", F.lit(0.0)) + F.when(F.col("degree") == 0, F.col("rank")).otherwise(0.0))
            return part(last, "key", k).join(sent, "key", "left").select("id", "key", "seed", "degree", rank.alias("rank"))

        now = each(ranked)
        let_go(spark, last)
        last = now
    let_go(spark, *steps)
    return last.select("id", "rank")


def affected(deps: DataFrame, changed: DataFrame, is_test: Column, depth: int = 5) -> DataFrame:
    """(id, depth): test files among the changed ones and their dependents; a test is collected and not passed."""
    files = deps.select(F.col("source").alias("id")).unionByName(deps.select(F.col("target").alias("id"))).unionByName(changed.select("id")).distinct()
    tests = files.where(is_test)
    found = reach(deps.withColumn("kind", F.lit("dep")), changed, depth, "in", None, tests)
    return found.join(tests, "id", "left_semi")


def filtered_subgraph(nodes: DataFrame, edges: DataFrame, keep: Column) -> DataFrame:
    """Edges both of whose nodes satisfy ``keep``."""
    own = nodes.where(keep).select("id")
    return edges.join(own.withColumnRenamed("id", "source"), "source", "left_semi").join(own.withColumnRenamed("id", "target"), "target", "left_semi")


def module_structure(nodes: DataFrame) -> DataFrame:
    """(folder, files): files by folder, the root being ``.``."""
    from ..functions.scalars import dirname

    return nodes.select(dirname(F.col("file_path")).alias("folder"), "file_path").distinct().groupBy("folder").agg(F.array_join(F.array_sort(F.collect_list("file_path")), ",").alias("files"), F.count(F.lit(1)).alias("n_files"))


#: Symbols of a flow, from end to end (fixed value).
MOST_HOPS = 7


def named_reach(edges: DataFrame, named: DataFrame, max_hops: int = MOST_HOPS) -> DataFrame:
    """(seed, id, depth, prev) of what each named symbol (id) reaches by calls that have a named symbol at one end at least,
    so that a flow bridges one symbol that nobody named, but never two; ``prev`` is the smallest symbol of the step before.

    All seeds advance together, a join for each step, and what a seed has reached is not reached again. Null ids and ends
    are no symbols; repeated calls and names do no harm."""
    own = named.select("id").where("id is not null").distinct()
    calls = edges.where("kind = 'calls'").select(F.col("source").alias("prev"), F.col("target").alias("id")).where("prev is not null and id is not null and prev <> id").distinct()
    mark = own.withColumn("named", F.lit(True))
    calls = calls.join(mark.withColumnsRenamed({"id": "prev", "named": "a"}), "prev", "left").join(mark.withColumnRenamed("named", "b"), "id", "left")
    calls = kept(calls.where("a or b").select("prev", "id"))
    frontier = kept(own.select(F.col("id").alias("seed"), "id", F.lit(0).alias("depth"), F.lit(None).cast("string").alias("prev")))
    seen = frontier
    for depth in range(1, max_hops):
        step = frontier.select("seed", F.col("id").alias("prev")).join(calls, "prev").groupBy("seed", "id").agg(F.min("prev").alias("prev"))
        step = step.join(seen.select("seed", "id"), ["seed", "id"], "left_anti")
        frontier = kept(step.select("seed", "id", F.lit(depth).alias("depth"), "prev"))
        if frontier.isEmpty():
            break
        seen = seen.unionByName(frontier)
    return seen


def named_flows(reached: DataFrame, named: DataFrame) -> DataFrame:
    """(seed, sink, depth): of ``named_reach`` the named symbol that lies deepest below each seed, the smallest of equals."""
    ends = reached.where("depth > 0").join(named.select("id").distinct(), "id")
    return ends.groupBy("seed").agg(F.min_by("id", F.struct(-F.col("depth"), F.col("id"))).alias("sink"), F.max("depth").alias("depth"))


#: Seeds whose flows are followed at once.
FLOW_SEEDS = 250_000


def all_flows(edges: DataFrame, named: DataFrame, max_hops: int = MOST_HOPS, most: int = FLOW_SEEDS) -> DataFrame:
    """``named_flows`` of all that ``named_reach`` reaches, without parents, about ``most`` seeds after the other.

    What seeds reach is many times the graph: the levels of a part are written, and go with their shuffles when its flows
    are known."""
    spark = edges.sparkSession
    own = named.select("id").where("id is not null").distinct()
    mark = own.withColumn("named", F.lit(True))
    calls = edges.where("kind = 'calls'").select(F.col("source").alias("prev"), F.col("target").alias("id")).where("prev is not null and id is not null and prev <> id").distinct()
    calls = calls.join(mark.withColumnsRenamed({"id": "prev", "named": "a"}), "prev", "left").join(mark.withColumnRenamed("named", "b"), "id", "left").where("a or b")
    calls = written(calls.select("prev", "id", F.coalesce("b", F.lit(False)).alias("named")))
    seeds = written(own)
    let_go(spark)
    parts = max(1, -(-seeds.count() // most))
    out = []
    for k in range(parts):
        frontier = written(seeds.where(F.pmod(F.xxhash64("id"), F.lit(parts)) == k).select(F.col("id").alias("seed"), "id", F.lit(True).alias("named")))
        levels, flows = [frontier], []
        for depth in range(1, max_hops):
            step = frontier.select("seed", F.col("id").alias("prev")).join(calls, "prev").select("seed", "id", "named").unionByName(together(levels).select("seed", "id", F.lit(None).cast("boolean").alias("named")))
            # a row that was reached has no ``named``
            new = step.groupBy("seed", "id").agg(F.count(F.lit(1)).alias("n"), F.count("named").alias("m"), F.first("named").alias("named")).where("n = m").select("seed", "id", "named")
            frontier = written(new)
            let_go(spark)
            if frontier.isEmpty():
                let_go(spark, frontier)
                break
            levels.append(frontier)
            flows.append(written(frontier.where("named").groupBy("seed").agg(F.min("id").alias("sink")).withColumn("depth", F.lit(depth))))
        let_go(spark, *levels)
        if flows:
            deepest = together(flows).groupBy("seed").agg(F.max(F.struct("depth", "sink")).alias("x"))
            out.append(written(deepest.select("seed", "x.sink", "x.depth")))
            let_go(spark, *flows)
    let_go(spark, calls, seeds)
    return together(out) if out else own.select(F.col("id").alias("seed"), F.col("id").alias("sink"), F.lit(0).alias("depth")).limit(0)


def longest_flow(reached: DataFrame, named: DataFrame) -> DataFrame:
    """(step, id) of the longest flow between named symbols, the first by seed of equals, from its parents step by step."""
    best = kept(named_flows(reached, named).orderBy(F.desc("depth"), "seed").limit(1))
    at = best.select("seed", F.col("sink").alias("id"), F.col("depth").alias("step"))
    steps = reached.select("seed", "id", "prev")
    out = at
    for _ in range(MOST_HOPS - 1):  # one row a step
        at = at.join(steps, ["seed", "id"]).where("prev is not null").select("seed", F.col("prev").alias("id"), (F.col("step") - 1).alias("step"))
        out = out.unionByName(at)
    return out.select("step", "id")
