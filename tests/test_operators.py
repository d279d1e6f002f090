"""Operators on literal fixtures, edge cases included."""

from pyspark.sql import functions as F

from skarn.functions import scalars as S
from skarn.operators import assembly, corpora, evaluation, gates, graph, quality, search, signals
from skarn.sources import bundle
from skarn.streaming import sync


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_line_ranges(spark):
    values = ["5", "5-9", "9-5", "0", "", "a", "1 - 2", None, "99999999999"]
    got = [one(spark, S.line_range(F.lit(v).cast("string"))) for v in values]
    assert [tuple(g) if g else None for g in got] == [(5, 5), (5, 9), None, None, None, None, None, None, (99999999999, 99999999999)]
    assert tuple(one(spark, S.line_range_split(F.lit("1 - 2")))) == (1, 2)
    assert one(spark, S.line_start(F.lit("x"))) == 1


def test_names_and_tokens(spark):
    assert one(spark, S.split_identifier(F.lit("getUserName_v2.x"))) == ["get", "user", "name", "v2", "x"]
    assert one(spark, S.query_surface(F.lit("what does foo_bar do 12?"))) == "X X X X 0?"
    assert one(spark, S.kind_bonus(F.lit("route"))) == 9 and one(spark, S.kind_bonus(F.lit("other"))) == 0
    assert [one(spark, S.name_bonus(F.lit(n), "TableWriter save")) for n in ("tablewritersave", "save", "zzz")] == [80, 60, 0]
    assert [one(spark, S.is_test_file(F.lit(p))) for p in ("src/tests/a.py", "a/test_x.py", "a/x.spec.ts", "src/latest.py")] == [True, True, True, False]
    assert [c["path"] for c in one(spark, S.citations(F.lit("see a/b.c:3-4 and d.py:9")))] == ["a/b.c", "d.py"]
    assert one(spark, S.redacted(F.lit("key sk-abcdefgh1234 end"))) == "key [redacted] end"


def test_retrieval_micro_case(spark):
    cases = spark.createDataFrame([("c", "answerable"), ("r", evaluation.REFUSAL), ("e", "answerable")], "case_id string, answerability string")
    gold = spark.createDataFrame([("c", "E1", None, "repo/a.c", "10-20"), ("c", "E2", None, "repo/b.c", "5-6")], "case_id string, evidence_id string, source_id string, path string, lines string")
    refs = spark.createDataFrame([("c", None, "repo/a.c")], "case_id string, source_id string, path string")
    preds = spark.createDataFrame([("c", 1, None, None, "repo/a.c", "15-16"), ("c", 2, None, None, "repo/c.c", "1-2")], "case_id string, position int, rank int, source_id string, path string, lines string")
    got = {r["case_id"]: r for r in evaluation.score_retrieval(cases, gold, refs, preds).collect()}
    assert (got["c"]["matched_ids"], got["c"]["evidence_recall"], got["c"]["evidence_precision"], got["c"]["reference_recall"]) == ("E1", 0.5, 0.5, 1.0)
    assert (got["r"]["evidence_recall"], got["r"]["evidence_precision"], got["r"]["evidence_f1"]) == (1.0, 1.0, 1.0)
    assert got["e"]["evidence_recall"] == 0.0
    assert evaluation.summary(evaluation.score_retrieval(cases.limit(0), gold, refs, preds)).first()["mean_evidence_recall"] == 0.0


CITES = "case_id string, query string, answer string, required string, granularity string, required_ids array<string>"
ITEMS = "case_id string, evidence_id string, source_id string, path string, lines string"


def test_citations(spark):
    rows = [
        ("overlap", "", "look at p/x.c:3-8", None, "path_line", []),
        ("apart", "", "look at p/x.c:6-8", "always", "path_line", []),
        ("never", "", "nothing", "never", "path_line", []),
        ("no_items", "", "p/x.c:5", "always", "path_line", []),
        ("by_source", "", "as src_1 says", "always", "source_only", []),
        ("by_path", "", "in p/x.c", "always", "path_only", ["E1"]),
        ("unknown_id", "", "p/x.c:5", "always", "path_line", ["E9"]),
        ("asked", "please cite", "p/x.c:5", None, "path_line", []),
        ("not_asked", "how", "nothing", None, "path_line", []),
        ("null", None, None, "always", None, None),
    ]
    items = [(r[0], "E1", "src_1", "p/x.c", "5") for r in rows if r[0] != "no_items"]
    cases, evidence = spark.createDataFrame(rows, CITES), spark.createDataFrame(items, ITEMS)
    loose = {r[0]: r[1] for r in evaluation.citation_pass(cases, evidence).collect()}
    assert loose == {"overlap": True, "apart": False, "never": True, "no_items": False, "by_source": True, "by_path": True, "unknown_id": False, "asked": True, "not_asked": False, "null": False}
    exact = {r[0]: r[1] for r in evaluation.citation_pass(cases, evidence, exact=True).collect()}
    assert exact["overlap"] is True and exact["asked"] is True and exact["not_asked"] is True and exact["apart"] is False
    assert evaluation.citation_pass(cases.limit(0), evidence).count() == 0


def test_atoms_and_verdicts(spark):
    atoms = spark.createDataFrame(
        [
            ("a", "A1", "conclusion", "the queue is full", 2.0, False, None),
            ("a", "A2", "reasoning", "set_state in core.c is called", 0.0, False, None),
            ("b", "A1", "reasoning", "the queue is full", None, False, None),
            ("c", "A1", "conclusion", "the queue is full", 1.0, False, None),
            ("c", "F1", None, "the queue never fills at all", None, True, None),
        ],
        "case_id string, atom_id string, role string, statement string, weight double, forbidden boolean, severity string",
    )
    answers = spark.createDataFrame([("a", "so the queue is full now"), ("b", "the queue is full"), ("c", "the queue is full; no, the queue never fills at all")], "case_id string, answer string")
    got = {r["case_id"]: r for r in evaluation.atom_coverage(atoms, answers).collect()}
    assert (round(got["a"]["coverage"], 3), got["a"]["conclusion_ok"], got["a"]["fatal"]) == (0.667, True, False)
    assert (got["b"]["coverage"], got["b"]["conclusion_ok"]) == (1.0, False) and got["c"]["fatal"]
    scored = evaluation.atom_coverage(atoms, answers).withColumns({"evidence_recall": F.lit(1.0), "citation_pass": F.lit(True)})
    assert {r["case_id"]: r["verdict"] for r in evaluation.case_verdict(scored, 0.6).collect()} == {"a": "PASS", "b": "WARN", "c": "FAIL"}
    assert one(spark, S.lexical_match(F.lit("uses set_state"), F.lit("uses something"))) is False
    assert one(spark, S.significant_tokens(F.lit("队 队列 a.b/c->d X"))) == ["a.b/c->d", "队", "队列"]
    assert [one(spark, S.verdict(F.lit(v).cast("string"))) for v in ("Pass", "warn", "no", "not_run", "?", None)] == ["correct", "partial", "incorrect", "not_run", "unknown", "unknown"]


def test_adversarial_rules(spark):
    rows = [("", "q", "gold", "x", "inconclusive"), ("I cannot confirm it", "q", "gold", "x", "baseline_failed"), ("no evidence", "q", "gold", "negative_evidence", "baseline_failed"), ("surely", "q", "gold", "negative_evidence", "baseline_succeeded"), ("the queue", "about queue", "queue wraps", "x", "inconclusive"), ("it wraps", "about queue", "queue wraps", "x", "baseline_succeeded"), (None, None, None, None, "inconclusive")]
    df = spark.createDataFrame(rows, "answer string, query string, gold string, attribute string, want string")
    got = df.select(assembly.outcome(F.col("answer"), F.col("query"), F.col("gold"), F.col("attribute")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)
    cases = spark.createDataFrame([("none",), ("one",), ("open",)], "case_id string")
    plan = assembly.baseline_plan(spark.createDataFrame([("none", []), ("one", ["long_tail", "false_premise"]), ("open", ["long_tail"])], "case_id string, attributes array<string>"))
    runs = [("one", "long_tail", "closed_book_llm", "baseline_succeeded"), ("one", "false_premise", "closed_book_llm", "baseline_failed"), ("one", "false_premise", "oracle_evidence_llm", "baseline_failed")]
    out = evaluation.adversarial(spark.createDataFrame(runs, "case_id string, attribute string, baseline string, outcome string"), cases, plan)
    assert {r["case_id"]: (r["passed"], r["reason"]) for r in out.collect()} == {"none": (True, "no_attributes_to_test"), "one": (True, "at_least_one_attribute_confirmed"), "open": (False, "untested_baselines")}


def test_gate_predicates(spark):
    statements = {"这些行显示：": True, "(blank lines)": True, "==== / x": True, "这些行显示：1. DEFINITIONS of": True, "a real statement": False, "==== / x / y": False}
    assert {s: one(spark, gates.is_boilerplate(F.lit(s))) for s in statements} == statements
    assert one(spark, gates.is_pointer(F.lit("a/b.c:3-4 显示：x"))) and not one(spark, gates.is_pointer(F.lit("see a/b.c:3")))
    assert [one(spark, gates.is_code(F.lit(p))) for p in ("a.sv", "x/src/readme", "docs/a.md", "Makefile")] == [True, False, False, False]
    assert one(spark, gates.is_question(F.lit("Is it so"))) and not one(spark, gates.is_question(F.lit("it is so")))


def test_paths_and_stems(spark):
    tests = {"test_a.py": True, "src/FooTest.kt": True, "a/jvmTest/x.kt": True, "pkg/testing/x.go": True, "demo/x.py": True, "latest/x.kt": False, "manifest.kt": False, "src/attest.c": False}
    assert {p: one(spark, S.is_test_file(F.lit(p))) for p in tests} == tests
    assert [one(spark, S.is_low_value_file(F.lit(p))) for p in ("api/rpc.pb.go", "x_mock.go", "a/FooGrpc.java", "server.go")] == [True, True, True, False]
    for w in ("caching", "running", "errors", "classes", "entries", "carried", "eviction", "management", "getter", "class", "seed"):
        assert sorted(one(spark, S.stems(F.lit(w)))) == sorted(S.stem_variants(w)), w
    assert "cache" in S.stem_variants("caching") and "run" in S.stem_variants("running") and S.stem_variants("class") == []
    assert S.search_terms("getUserName of the user_service")[:2] == ["getusername", "user_service"]


def test_cycles_against_brute_force(spark):
    import random

    r = random.Random(4)
    edges = {(r.randrange(40), r.randrange(40)) for _ in range(90)}
    after = {x: {b for a, b in edges if a == x} for x in range(40)}

    def reach(x):
        seen, todo = set(), [x]
        while todo:
            for y in after[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        return seen

    reached = {x: reach(x) for x in range(40)}
    name = lambda x: f"n{x:02d}"
    want = {(name(x), name(min({y for y in reached[x] if x in reached[y]} | {x}))) for x in range(40) if any(y != x and x in reached[y] for y in reached[x])}
    frame = spark.createDataFrame([(name(a), name(b)) for a, b in edges], "source string, target string")
    assert want and {tuple(x) for x in graph.cycles(frame).collect()} == want


def test_long_paths_are_found(spark):
    e = spark.createDataFrame([(f"n{i:03d}", f"n{i + 1:03d}", "contains") for i in range(70)], "source string, target string, kind string")
    assert graph.shortest_path(e, "n000", "n070").count() == 71
    assert graph.ancestors(e, graph.ids(e, ["n070"])).count() == 70


def test_rotated_anchors(spark):
    import random

    r = random.Random(2)
    rows = [(f"c{k}", k, f"E{i}", f"p{r.randrange(3)}", "1", r.randrange(4)) for k in range(30) for i in range(r.randrange(1, 4))]
    used, want = {}, set()
    for k in sorted({x[1] for x in rows}):
        own = sorted((x for x in rows if x[1] == k), key=lambda x: (used.get(x[3], 0) >= 3, -x[5], x[3], x[4], x[2]))
        used[own[0][3]] = used.get(own[0][3], 0) + 1
        want.add((own[0][0], own[0][2]))
    frame = spark.createDataFrame(rows, "case_id string, row int, candidate_id string, path string, lines string, degree int")
    assert {tuple(x) for x in corpora.rotated_anchors(frame).collect()} == want


def test_numbered_json_lines(spark, tmp_path):
    import pytest

    schema = spark.createDataFrame([], "a int, b string").schema
    f = tmp_path / "x.jsonl"
    f.write_text('{"a": 1, "b": "x"}\n\n[1]\nnot json\n{"a": 2}\n')
    rows, bad = bundle.json_rows(spark, str(f), schema, "permissive")
    assert {(r["a"], r["_line"]) for r in rows.collect()} == {(1, 1), (2, 5)} and {r["line"] for r in bad.collect()} == {3, 4}
    assert bundle.json_rows(spark, str(f), schema, "lenient")[1].count() == 0
    with pytest.raises(Exception, match="no JSON object at line"):
        bundle.json_rows(spark, str(f), schema)[0].collect()
    assert bundle.json_rows(spark, str(tmp_path / "none"), schema)[0].count() == 0
    done = spark.createDataFrame([("a",)], "case_id string")
    assert bundle.append_done(done, spark.createDataFrame([("a",), ("b",), ("b",)], "case_id string"), str(tmp_path / "out")) == 1


def test_api_and_command(spark, capsys):
    from skarn.__main__ import main
    from skarn.api import SymbolGraph

    own = SymbolGraph.over(spark, "/root/testdata/sf0.001")
    assert own.node("class:3").count() == 1 and own.callers("function:7").count() > 0 and own.children("module:3").count() > 0
    nodes, edges = own.explore("red widget", most=10)
    assert 0 < nodes.count() <= 20
    assert main(["/root/testdata/sf0.001", "node", "class:3"]) == 0 and "class:3" in capsys.readouterr().out


GRAPH = [("a", "b", "calls"), ("b", "c", "calls"), ("c", "a", "calls"), ("c", "d", "calls"), ("m", "a", "contains"), ("z", "z", "calls")]


def test_graph(spark):
    e = spark.createDataFrame([(*x, 1) for x in GRAPH], "source string, target string, kind string, line int")
    n = spark.createDataFrame([(x, "module" if x == "m" else "function", 0) for x in "abcdmzy"], "id string, kind string, is_exported int")
    start = graph.ids(e, ["a"])
    assert {tuple(r) for r in graph.reach(e, start, 2).collect()} == {("a", 0), ("b", 1), ("c", 2)}
    assert [r["id"] for r in graph.shortest_path(e, "a", "d").orderBy("position").collect()] == ["a", "b", "c", "d"]
    assert graph.shortest_path(e, "d", "a").count() == 0 and graph.shortest_path(e, "d", "d").count() == 1
    assert {tuple(r) for r in graph.cycles(e).collect()} == {(x, "a") for x in "abc"}
    assert {r["id"] for r in graph.dead_code(n, e).collect()} == {"y"}
    assert {tuple(r) for r in graph.impact(n, e, graph.ids(e, ["m"]), 1).collect()} == {("m", 0), ("a", 0), ("c", 1)}
    assert {tuple(r) for r in graph.impact(n, e, graph.ids(e, ["m"]), 0).collect()} == {("m", 0)}
    total = graph.pagerank(n, e, start).agg(F.sum("rank")).first()[0]
    assert abs(total - 1) < 1e-6
    assert graph.cycles(e.limit(0)).count() == 0 and graph.reach(e.limit(0), start).count() == 1


def test_search(spark):
    q = search.parse('kind:function lang:py path:"src dir" foo:bar "two words" name:x')
    assert (q.kinds, q.languages, q.paths, q.names, q.text) == (["function"], ["py"], ["src dir"], ["x"], "foo:bar two words")
    n = spark.createDataFrame([("1", "function", "parseFile", "m::parseFile", "src/a.py", "py", 1, 1), ("2", "class", "Parser", "m::Parser", "src/tests/b.py", "py", 1, 1), ("3", "function", "other", "m::other", "c.py", "py", 1, 0)], "id string, kind string, name string, qualified_name string, file_path string, language string, start_line int, is_exported int")
    assert [r["id"] for r in search.search(n, "pars").collect()][0] in {"1", "2"}
    assert [r["id"] for r in search.search(n, "othr").collect()] == ["3"]
    assert search.search(n, "kind:class").count() == 1 and search.search(n.limit(0), "x").count() == 0
    form = "ref_id string, name string, kind string, language string, file_path string, line int"
    refs = spark.createDataFrame([("r1", "m::Parser", "calls", "py", "", 1), ("r2", "PARSER", "calls", "py", "", 1), ("r3", "nope", "calls", "py", "", 1), ("r4", "other", "calls", "py", "x", 1), ("r5", "PARSER", "references", "java", "", 1)], form)
    assert {(r["ref_id"], r["target"], r["confidence"]) for r in search.resolve(refs, n).collect()} == {("r1", "2", 0.95), ("r2", "2", 0.5), ("r4", "3", 0.9)}
    many = spark.createDataFrame([("a", "function", "run", "x::run", "p/q/r/a.py", "py", 1, 0), ("b", "class", "run", "y::run", "p/q/r/b.py", "py", 1, 0), ("c", "function", "run", "z::run", "p/z.go", "go", 1, 1), ("f", "file", "k.h", "p/k.h", "p/k.h", "c", 0, 0)], ", ".join(f"{c} {t}" for c, t in n.dtypes))
    refs = spark.createDataFrame([("near", "run", "calls", "py", "p/q/s.py", 1), ("far", "run", "calls", "go", "w.go", 1), ("head", "k.h", "imports", "c", "p/x.c", 1)], form)
    assert {(r["ref_id"], r["target"], r["confidence"]) for r in search.resolve(refs, many).collect()} == {("near", "a", 0.7), ("far", "c", 0.4), ("head", "f", 0.85)}
    assert {r["ref_id"] for r in search.possible(spark.createDataFrame([("x", "obj.run"), ("y", "a::b::run"), ("z", "none.at.all"), ("w", "d/k.h")], "ref_id string, name string"), many).collect()} == {"x", "y", "w"}


def test_signals_and_quality(spark):
    s = spark.createDataFrame([("s", 1, "x"), ("s", 2, "y"), ("s", 3, "y"), ("t", 4, "z")], "signal_id string, emit_order int, anchor_id string")
    kept = {r["signal_id"]: r["emit_order"] for r in signals.suffixed(s, ["emit_order"]).collect()}
    assert kept["s"] == 1 and kept["t"] == 4 and sorted(kept.values()) == [1, 3, 4]
    assert signals.first_by(s, ["signal_id"], ["emit_order"]).count() == 2
    assert quality.repeated(s, "signal_id", ["emit_order"], "r").count() == 2
    findings = quality.repeated(s, "signal_id", ["emit_order"], "r")
    assert quality.severity_verdict(findings).first()["verdict"] == "FAIL"
    assert quality.severity_verdict(findings.limit(0)).first()["verdict"] == "PASS"
    assert "long_tail" in signals.REGISTRY


def test_sources(spark, tmp_path):
    schema = spark.createDataFrame([], "a int, b string").schema
    f = tmp_path / "x.jsonl"
    f.write_text('{"a": 1, "b": "x"}\nnot json\n')
    assert bundle.jsonl(spark, str(tmp_path / "none.jsonl"), schema).count() == 0
    assert bundle.jsonl(spark, str(f), schema, "lenient").count() == 1
    assert bundle.corrupt_findings(bundle.jsonl(spark, str(f), schema, "permissive").cache()).count() == 1
    for k in "12":
        bundle.write_jsonl(spark.createDataFrame([(2, "y"), (1, "x")], schema).coalesce(1), str(tmp_path / f"out{k}"), ["a"])
    texts = ["".join(p.read_text() for p in sorted((tmp_path / f"out{k}").glob("part-*"))) for k in "12"]
    assert texts[0] == texts[1] == '{"a":1,"b":"x"}\n{"a":2,"b":"y"}\n'
    old, new = spark.createDataFrame([(1, "x"), (2, "y")], schema), spark.createDataFrame([(2, "z")], schema)
    assert {tuple(r) for r in bundle.upsert(old, new, "a").collect()} == {(1, "x"), (2, "z")}


def test_sync(spark, tmp_path):
    kind = "path string, content_hash string, size bigint, modified_at double"
    old = spark.createDataFrame([("a", "1", 1, 1.0), ("b", "1", 1, 1.0), ("c", "1", 1, 1.0), ("d", "1", 1, 1.0)], kind)
    new = spark.createDataFrame([("a", "2", 1, 1.5), ("b", "2", 2, 1.0), ("c", "1", 1, 9.0), ("e", "1", 1, 1.0)], kind)
    assert {tuple(r) for r in sync.classify(old, new).collect()} == {("a", "unchanged"), ("b", "modified"), ("c", "touched"), ("d", "removed"), ("e", "added")}
    lines = spark.createDataFrame([('{"type":"turn.completed","usage":{"input_tokens":3,"output_tokens":4}}',), ("junk",), (None,)], "value string")
    assert [r["total_tokens"] for r in sync.usage_stream(lines).collect()] == [7]
    events = spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01"), ("a", "2024-01-01 00:01:00")], "path string, ts string").withColumn("ts", F.to_timestamp("ts"))
    assert sorted(r["n"] for r in sync.bursts(events).collect()) == [1, 2]
    events.write.parquet(str(tmp_path / "in"))
    seen = []
    stream = spark.readStream.schema(events.schema).parquet(str(tmp_path / "in"))
    sync.refresh(stream, lambda b: seen.append(b.count()), str(tmp_path / "cp")).awaitTermination(60)
    assert sum(seen) == 3
