"""What showed only on larger tables or odd values."""

from pyspark.sql import functions as F

from skarn.functions import scalars as S
from skarn.operators import assembly, chains, evaluation, graph, synthesis

CITES = "case_id string, query string, answer string, required string, granularity string, required_ids array<string>"
ITEMS = "case_id string, evidence_id string, source_id string, path string, lines string"


def test_a_range_that_is_none_overlaps_nothing(spark):
    cases = spark.createDataFrame([(c, "", f"look at p/x.c:{at}", "always", "path_line", []) for c, at in (("item", "3-8"), ("cited", "8-3"), ("good", "3-8"))], CITES)
    evidence = spark.createDataFrame([("item", "E1", "s", "p/x.c", "x"), ("cited", "E1", "s", "p/x.c", "5"), ("good", "E1", "s", "p/x.c", "5")], ITEMS)
    assert {r[0]: r[1] for r in evaluation.citation_pass(cases, evidence).collect()} == {"item": False, "cited": False, "good": True}
    one = spark.range(1).select(S.overlap(S.line_range(F.lit("x")), S.line_range(F.lit("3"))).alias("x"))
    assert one.first().x is None


def test_return_types_meet_by_scope_and_not_by_method_alone(spark):
    names = ["a::K1::make", "K2::make", "make", "K1::other", "n::a::K3::make", "y:::K4::make"]
    nodes = spark.createDataFrame([(f"t{i}", "method", q.split("::")[-1], q, "java", "f", f"R{i}") for i, q in enumerate(names)], "id string, kind string, name string, qualified_name string, language string, file_path string, return_type string")
    more = spark.range(10, 3010).select(F.concat(F.lit("x"), F.col("id")).alias("id"), F.lit("method").alias("kind"), F.lit("make").alias("name"), F.format_string("M%d::make", "id").alias("qualified_name"), F.lit("java").alias("language"), F.lit("f").alias("file_path"), F.lit("Z").alias("return_type"))
    free = spark.createDataFrame([("u2", "function", "make", None, "java", "f", "F2"), ("u1", "function", "make", "q::make", "java", "f", "F1")], nodes.schema)
    calls = [(1, "java", "K1", "make"), (2, "java", "b::K2", "make"), (3, "java", "a::K3", "make"), (4, "java", "K4", "make"), (5, "java", None, "make"), (6, "go", "K1", "make"), (7, "java", "M77", "make")]
    wanted = spark.createDataFrame(calls, "w long, language string, class string, method string")
    found = chains._returned(wanted, nodes.unionByName(more).unionByName(free))
    got = {r.w: r.ret for r in found.collect()}
    assert got == {1: "R0", 2: "R1", 3: "R2", 4: "R2", 5: "F1", 7: "R2"}  # a bare ``make`` fits every class; the smallest node counts
    many = spark.range(3000).select("id", F.lit("java").alias("language"), F.format_string("M%d", "id").alias("class"), F.lit("make").alias("method")).withColumnRenamed("id", "w")
    assert _largest(chains._returned(many, more)) <= 20_000  # not 9,000,000


def test_members_of_files_without_text_are_not_put_together(spark):
    nodes = spark.range(50_000).select(F.concat(F.lit("n"), F.col("id")).alias("id"), F.lit("method").alias("kind"), F.lit("f").alias("name"), F.when(F.col("id") < 40_000, "none").otherwise("text").alias("file_path"), F.lit("ts").alias("language"), F.lit(2).alias("start_line"), F.lit(3).alias("end_line"))
    files = spark.createDataFrame([("text", "a\nb\nc\nd"), ("null", None)], "path string, text string")
    own = synthesis.bodies(nodes, files)
    assert own.groupBy("body").count().collect() == [("b\nc", 10_000)]
    plan = own._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan and plan.index("collect_list") < plan.index("LeftSemi")  # the collection comes after, above in the plan


def test_points_look_at_levels_of_their_file_only(spark):
    points = spark.createDataFrame([("a", 5), ("a", 40), ("b", 1), (None, 1)], "file_path string, line int")
    spans = spark.createDataFrame([("s1", "a", 1, 8), ("s2", "a", 4, 6), ("s3", "a", 1, 100), ("t", "b", 1, None)], "id string, file_path string, start_line int, end_line int")
    out = synthesis.enclosing(points, spans)
    assert {tuple(r) for r in out.collect()} == {("a", 5, "s2"), ("a", 40, "s3"), ("b", 1, "t")}
    assert "sequence(" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_reach_does_not_shuffle_all_edges(spark):
    edges = spark.range(30_000).select(F.concat(F.lit("a"), F.col("id") % 10_000).alias("source"), F.concat(F.lit("b"), F.col("id") % 10_000).alias("target"), F.lit("calls").alias("kind"))
    written = _written(spark)
    out = graph.reach(edges, graph.ids(edges, ["a7"]), 1)
    assert {tuple(r) for r in out.collect()} == {("a7", 0), ("b7", 1)}
    assert _written(spark) - written < 1_000  # not the 10,000 different edges


def _written(spark) -> int:
    """Rows written to shuffles so far, over all stages."""
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark.sparkContext._jvm.double, 0), None)
    return sum(stages.apply(i).shuffleWriteRecords() for i in range(stages.size()))


def test_signals_for_rows_shuffles_no_pairs(spark):
    rows = spark.createDataFrame([("c1", "s1", "p1"), ("c1", "s1", "p2"), ("c2", "s2", "p1"), (None, "s1", "p1"), ("c3", None, None), ("c3", "s9", "p3")], "case_id string, source_id string, path string")
    signals = spark.createDataFrame([("A", "s1", "p1"), ("B", "s2", "p2"), ("B", "s1", "p3"), (None, "s2", "p1"), ("C", None, "p1"), ("A", "s1", "p1"), ("D", "s1", "p2")], "signal_id string, source_id string, path string")
    both = rows.join(signals.withColumnsRenamed({"source_id": "s", "path": "p"}), (F.col("source_id") == F.col("s")) | (F.col("path") == F.col("p")))
    want = {tuple(r) for r in both.select("case_id", "signal_id").distinct().collect()}
    got = [tuple(r) for r in assembly.signals_for_rows(rows, signals).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    wide = spark.range(2_000).select(F.col("id").alias("case_id"), F.lit("s").alias("source_id"), F.lit("p").alias("path"))
    many = spark.range(100).select(F.col("id").alias("signal_id"), F.lit("s").alias("source_id"), F.lit("q").alias("path"))
    out = assembly.signals_for_rows(wide, many)
    assert out.count() == 200_000 and _largest(out, "Exchange") <= 10_000


def _largest(df, node: str = "Join") -> int:
    """The largest number of rows that a node of this name put out or wrote, of the plan that ran last."""
    query = df._jdf.queryExecution()
    df._jdf.sparkSession().sparkContext()
    query.executedPlan().executeCollect()
    plan, most, left = query.executedPlan(), 0, []
    left.append(plan)
    while left:
        at = left.pop()
        name = at.nodeName()
        if name == "AdaptiveSparkPlan":
            left.append(at.executedPlan())
            continue
        if hasattr(at, "plan") and "QueryStage" in name:
            left.append(at.plan())
            continue
        if node in name:
            for key in ("numOutputRows", "shuffleRecordsWritten"):
                found = at.metrics().get(key)
                if found.isDefined():
                    most = max(most, found.get().value())
        children = at.children()
        left += [children.apply(i) for i in range(children.size())]
    return most


def test_pagerank_in_slices_is_the_same(spark):
    edges = spark.range(60).select(F.concat(F.lit("n"), F.col("id") % 13).alias("source"), F.concat(F.lit("n"), (F.col("id") * 7) % 17).alias("target"), F.lit("calls").alias("kind"))
    nodes = spark.range(16).select(F.concat(F.lit("n"), F.col("id")).alias("id")).unionByName(spark.createDataFrame([("alone",)], "id string"))
    pairs = [(r.source, r.target) for r in edges.collect() if r.source != r.target and "n16" not in (r.source, r.target)]
    steps = pairs + [(b, a) for a, b in pairs]
    ids, seeds = [r.id for r in nodes.collect()], {"n3", "alone"}
    degree = {i: sum(a == i for a, _ in steps) for i in ids}
    rank = {i: (i in seeds) / 2 for i in ids}
    for _ in range(4):
        got = {i: 0.0 for i in ids}
        for a, b in steps:
            got[b] += rank[a] / degree[a]
        rank = {i: 0.25 * (i in seeds) / 2 + 0.75 * (got[i] + (rank[i] if not degree[i] else 0)) for i in ids}
    for size in (10, 1_000):
        out = {r.id: r["rank"] for r in graph.pagerank(nodes, edges, graph.ids(edges, [*seeds, "absent"]), rounds=4, slice_steps=size).collect()}
        assert set(out) == set(ids) and all(abs(out[i] - rank[i]) < 1e-12 for i in ids)


def test_pagerank_reads_edges_as_often_for_more_rounds(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(x):
        read.add(1)
        return x

    pairs = [(f"n{i}", f"n{i * 7 % 17}", "calls") for i in range(17)] * 3
    edges = spark.createDataFrame(spark.sparkContext.parallelize(pairs, 2).map(seen), "source string, target string, kind string")
    nodes = spark.createDataFrame([(f"n{i}",) for i in range(17)], "id string")
    counts = []
    for rounds in (1, 3):
        before = read.value
        graph.pagerank(nodes, edges, rounds=rounds).count()
        counts.append(read.value - before)
    assert counts[0] == counts[1] > 0


def test_go_members_in_parts_are_the_same(spark):
    rows, links = [("I", "interface", "R", None, "p/a.go", "go", 1), ("I.f", "method", "f0", None, "p/a.go", "go", 2), ("U", "struct", "UnimplementedXServer", None, "p/x_grpc.pb.go", "go", 1)], [("I", "I.f"), ("I", "I.f")]
    for k in range(2):
        rows.append((f"U.f{k}", "method", f"f{k}", None, "p/x_grpc.pb.go", "go", 2 + k))
        links.append(("U", f"U.f{k}"))
    for s in range(12):
        rows.append((f"S{s:02}", "struct", f"S{s}", None, f"p/s{s}.go", "go", 1))
        for k in range(2):
            rows.append((f"S{s:02}.f{k}", "method", f"f{k}", None, f"p/s{s}.go", "go", 5 + k))
            links += [(f"S{s:02}", f"S{s:02}.f{k}"), (f"S{(s + 1) % 4:02}", f"S{s:02}.f{k}")][: 2 if s < 4 else 1]  # some are held by two
    rows += [("J", "class", "J", None, "j.java", "java", 1), ("J.f", "method", "f", None, "j.java", "java", 2), ("loose", "method", "g", "S5::g", "p/g.go", "go", 9), ("held", "method", "g", "S6::g", "p/g.go", "go", 9)]
    links += [("J", "J.f"), ("J", "held"), ("S07", "J.f")]
    nodes = spark.createDataFrame(rows, "id string, kind string, name string, qualified_name string, file_path string, language string, start_line int")
    edges = spark.createDataFrame([(*x, "contains", 1) for x in links], "source string, target string, kind string, line int")
    whole = [synthesis.contained_edges(nodes, edges), synthesis.implement_edges(nodes, edges), synthesis.stub_edges(nodes, edges)]
    want = sorted((tuple(r) for e in whole for r in e.collect()), key=str)
    assert len(want) > 30
    for most in (3, 1_000):
        assert sorted((tuple(r) for r in synthesis.go_members(nodes, edges, most).collect()), key=str) == want


def test_flows_of_seeds_in_parts_are_the_same(spark):
    edges = spark.range(90).select(F.concat(F.lit("n"), F.pmod(F.hash("id"), F.lit(50))).alias("source"), F.concat(F.lit("n"), F.pmod(F.hash("id", F.lit(1)), F.lit(50))).alias("target"), F.when(F.col("id") % 9 == 0, "contains").otherwise("calls").alias("kind"))
    named = spark.range(22).select(F.concat(F.lit("n"), F.col("id") * 2).alias("id")).unionByName(spark.createDataFrame([(None,), ("n2",)], "id string"))
    want = sorted(tuple(r) for r in graph.named_flows(graph.named_reach(edges, named), named).collect())
    assert len(want) > 10
    for most in (5, 1_000):
        assert sorted(tuple(r) for r in graph.all_flows(edges, named, most=most).select("seed", "sink", "depth").collect()) == want
    assert graph.all_flows(edges.limit(0), named).count() == 0
