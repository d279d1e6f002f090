"""Anchor rotation, diverse samples, scans with rules, names with parts: against loops and literal cases."""

import random

import pytest

from skarn.operators import context, corpora
from skarn.sources import scan


@pytest.mark.parametrize("seed", range(5))
def test_rotated_anchors_against_a_loop(spark, seed):
    r = random.Random(seed)
    cap = r.choice([1, 2, 4])
    rows = [(f"c{k}", k, f"E{i}", f"p{min(r.randrange(9), r.randrange(9))}", r.choice("12"), r.randrange(4)) for k in range(60) for i in range(r.randrange(1, 6))]
    used, want = {}, set()
    for k in sorted({x[1] for x in rows}):
        own = sorted((x for x in rows if x[1] == k), key=lambda x: (used.get(x[3:5], 0) >= cap, -x[5], x[3], x[4], x[2]))
        used[own[0][3:5]] = used.get(own[0][3:5], 0) + 1
        want.add((own[0][0], own[0][2]))
    frame = spark.createDataFrame(rows, "case_id string, row int, candidate_id string, path string, lines string, degree int")
    assert {tuple(x) for x in corpora.rotated_anchors(frame, cap).collect()} == want
    assert corpora.rotated_anchors(frame.limit(0), cap).count() == 0


def loop(rows, findings, size):
    code = lambda x: x or "unknown"
    by_case, chosen, ids, seen = {r[1]: r for r in rows}, [], set(), set()
    for _, case in sorted(findings):
        if case in by_case and case not in ids and len(chosen) < size:
            chosen.append(case)
            ids.add(case)
    for _, case, project, layer, capability in rows:
        if len(chosen) >= size:
            break
        bucket = (project or "", code(layer), code(capability))
        if case in ids or (bucket in seen and len(chosen) + len(seen) < size):
            continue
        chosen.append(case)
        ids.add(case)
        seen.add(bucket)
    return chosen


@pytest.mark.parametrize("seed", range(12))
def test_diverse_sample_against_the_loop(spark, seed):
    r = random.Random(seed)
    rows = [(k, f"c{k}", r.choice(["p", "q", None]), r.choice(["L1", "L2", "L3"]), r.choice("abc")) for k in range(r.choice([5, 30, 60]))]
    findings = [(i, r.choice([f"c{r.randrange(70)}", None])) for i in range(r.choice([0, 3, 20]))]
    frame = spark.createDataFrame(rows, "place int, case_id string, project string, layer string, capability string")
    told = spark.createDataFrame(findings, "place int, case_id string")
    for size in (0, r.randrange(1, 12), r.randrange(12, 50)):
        got = [x["case_id"] for x in sorted(corpora.diverse_sample(frame, told, size).collect(), key=lambda x: x["place"])]
        assert got == loop(rows, [f for f in findings if f[1]], size)


def test_scan_of_a_tree(spark, tmp_path):
    files = {
        ".gitignore": "# comment\n*.log\n!keep.log\n/top.txt\ndocs/*.md\n!vendor/\n\\#odd\ncache/\n",
        "a.py": "x = 1", "x.log": "no", "keep.log": "yes", "top.txt": "no", "sub/top.txt": "yes", "docs/a.md": "no", "docs/deep/a.md": "yes", "#odd": "no",
        "vendor/lib.go": "yes", "node_modules/x/y.js": "no", "pkg/node_modules/z.js": "no", "cache": "a file, yes", "sub/cache/c.py": "no",
        "sub/.gitignore": "*\n!*.py\n!/in/\nin/*.txt", "sub/only.py": "yes", "sub/gone.md": "no", "sub/in/a.py": "yes", "sub/in/b.txt": "no", "sub/in/keep.log": "no", "sub/out/a.py": "no",
        "big.py": "y" * 3000,
    }
    for name, text in files.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(text)
    got = {r["path"]: r for r in scan.scan(spark, str(tmp_path), most_bytes=2000).collect()}
    assert set(got) == {"a.py", "keep.log", "docs/deep/a.md", "vendor/lib.go", "cache", "sub/only.py", "sub/in/a.py", "big.py"}
    assert got["a.py"]["text"] == "x = 1" and got["a.py"]["size"] == 5 and got["a.py"]["error"] is None
    assert got["big.py"]["text"] is None and got["big.py"]["error"] == "File exceeds max size (3000 > 2000)"


def test_rules_of_odd_patterns(spark):
    rule = "a/**/b\n**/deep/\nx/**\nq[!0-9].c\nbad[\n \ntrail\\ \n!\n/"
    told = spark.createDataFrame([(".gitignore", rule), ("n/.gitignore", None)], "path string, text string")
    paths = ["a/b", "a/x/y/b", "z/a/b", "k/deep/f", "deep", "x/y", "x", "qa.c", "q1.c", "w/qz.c", "bad[", "n/x", None]
    frame = spark.createDataFrame([(p,) for p in paths], "path string")
    got = {r["path"] for r in scan.kept_paths(frame, scan.rules(told)).collect()}
    assert got == {"z/a/b", "deep", "x", "q1.c", "bad[", "n/x"}


def test_names_with_parts(spark):
    names = ["TransportSearchAction", "SearchShardsRequest", "RPCSearch", "search", "ResearchLab", "SearchPhaseShards", "My_Search", "XSearchShards", "lowsearchx"]
    rows = [(f"n{i}", "class", n, "src/t_test.py" if n == "XSearchShards" else "src/a.py") for i, n in enumerate(names)] + [("m", "method", "ASearchShards", "src/a.py")]
    nodes = spark.createDataFrame(rows, "id string, kind string, name string, file_path string")
    none = nodes.limit(0)
    got = {r["name"]: r["score"] for r in context.boundary_names(nodes, "search shards", ["search", "SEARCH", "shards", "of"], none).collect()}
    # SearchShardsRequest has Shards inside; SearchPhaseShards too; names that begin with a part are the word index's
    assert got == {"TransportSearchAction": 2 * (8 + 6 - 15 / 4), "RPCSearch": 2 * (8 + 6 - 3 / 4), "SearchShardsRequest": 2 * (8 + 6 - 13 / 4), "SearchPhaseShards": 2 * (8 + 6 - 11 / 4)}
    both = {r["name"]: r["score"] for r in context.boundary_names(nodes, "test search shards", ["search", "shards"], none).collect()}
    assert both["XSearchShards"] > 40
    pairs = {r["name"]: r["score"] for r in context.compound_names(nodes, "search shards", ["search", "shards"], none).collect()}
    assert pairs == {"SearchShardsRequest": 30 + 6 - 19 / 8, "SearchPhaseShards": 30 + 6 - 17 / 8}
    assert context.boundary_names(nodes, "of", ["of"], none).count() == 0 and context.compound_names(nodes, "of", ["of"], none).count() == 0
