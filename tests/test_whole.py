"""Queries over whole tables against loops."""

from skarn import catalog
from skarn.operators import signals

DIR = "/root/testdata/sf0.001"


def run(spark, name):
    return catalog.queries()[name](spark, DIR)


def table(spark, name):
    return spark.read.parquet(f"{DIR}/{name}.parquet")


def test_all_references_are_resolved(spark):
    got = {r["ref_id"] for r in run(spark, "resolve_references").collect()}
    for letter, name, key in (("a", "part", "p_partkey"), ("b", "supplier", "s_suppkey"), ("c", "customer", "c_custkey")):
        assert {f"{letter}{r[0]}" for r in table(spark, name).select(key).collect()} <= got


def test_two_hops_against_all_pairs(spark):
    import random

    r = random.Random(5)
    rows = [(r.randrange(40), r.randrange(25), r.choice(["imports_or_includes", "doc_mentions_entity"])) for _ in range(300)] + [(None, 1, "x"), (1, None, "x")]
    best = {}
    for a, o, p in rows:
        for b, q, _ in rows:
            if None not in (a, b, o) and o == q and a != b:
                best[a, b] = min(best.get((a, b), 1), int(p != "doc_mentions_entity"))
    want = {(a, b, n + 1) for x in {a for a, _ in best} for n, (_, a, b) in enumerate(sorted((k, a, b) for (a, b), k in best.items() if a == x)[:3])}
    frame = spark.createDataFrame(rows, "subject_id int, object_id int, predicate string")
    assert {tuple(x) for x in signals.two_hops(frame).collect()} == want


def test_two_hops_of_all_order_lines(spark):
    rows = {tuple(x) for x in table(spark, "lineitem").select("l_suppkey", "l_partkey").collect()}
    suppliers = {}
    for s, p in rows:
        suppliers.setdefault(p, set()).add(s)
    others = {}
    for s, p in rows:
        others.setdefault(s, set()).update(suppliers[p] - {s})
    want = {(s, b, n + 1) for s, found in others.items() for n, b in enumerate(sorted(found)[:3])}
    assert {tuple(x) for x in run(spark, "two_hop_neighbours").collect()} == want
