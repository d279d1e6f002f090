"""Chains of calls against a loop over random programs, and literal cases of the languages."""

import random

from skarn.operators import chains as C

NODES = "id string, kind string, name string, qualified_name string, language string, file_path string, start_line int, end_line int, return_type string, signature string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[None] * (10 - len(r))) for r in rows], NODES)


def test_against_a_loop(spark):
    r = random.Random(4)
    types = [f"T{i}" for i in range(14)]
    nodes = [(t, "class", t, t, "java", "f") for t in types]
    up = {t: sorted(set(r.sample(types, r.randrange(3))) - {t}) for t in types}
    methods = {}
    for t in types:
        for m in r.sample(["a", "b", "c", "d"], 2):
            methods[t, m] = (f"{t}.{m}", r.choice([*types, "self", None, ""]))
            nodes.append((f"{t}.{m}", "method", m, f"p::{t}::{m}", "java", "f", 1, 1, methods[t, m][1]))

    def nearest(t, m):
        level, seen = [t], {t}
        for _ in range(5):
            hit = sorted(methods[x, m][0] for x in level if (x, m) in methods)
            if hit:
                return next(v for v in methods.values() if v[0] == hit[0])
            level = sorted({u for x in level for u in up[x]} - seen)
            seen |= set(level)
        return None

    names = sorted({f"{r.choice(types)}.{r.choice('abcd')}()." + "().".join(r.choice("abcd") for _ in range(r.randrange(1, 4))) for _ in range(400)})
    want = {}
    for n in names:
        first, *links = n.split("().")
        t, m = first.split(".")
        kind = methods.get((t, m), (None, None))[1]
        target = None
        for k, link in enumerate(links):
            hit = nearest(kind, link) if kind in types else None
            target = hit and hit[0]
            if not hit:
                break
            kind = kind if hit[1] == "self" else hit[1]
        if target:
            want[n] = target
    edges = spark.createDataFrame([(t, u, r.choice(["extends", "implements"])) for t in types for u in up[t]], "source string, target string, kind string")
    refs = spark.createDataFrame([(n, n, "java", "f") for n in names] + [(names[0], names[0], "java", "f"), ("odd", "a.b", "java", "f"), ("null", None, "java", "f")], "ref_id string, name string, language string, file_path string")
    # a first link's own return type of self is a name that no type has, as for dotted languages
    got = C.chains(refs, frame(spark, nodes), edges).collect()
    assert {x["ref_id"]: x["target"] for x in got} == want and len(want) > 60
    assert any(n.count("()") > 2 for n in want)
    assert C.chains(refs.limit(0), frame(spark, nodes), edges).count() == 0


def test_first_links_of_languages(spark):
    rows, refs, want = [], [], {}

    def case(language, name, target, *nodes):
        key = f"{language} {name}"
        refs.append((key, name, language, "here.java"))
        rows.extend((f"{key} {n[1]}", n[0], n[1].split("::")[-1], n[1], language, n[3] if len(n) > 3 else "f", 1, 1, n[2] if len(n) > 2 else None) for n in nodes)
        if target:
            want[key] = (f"{key} {target}", 0.8 if language in ("objc", "pascal") else 0.85)

    case("rust", "Foo::new().bar", "Foo::bar", ("method", "Foo::new", "self"), ("method", "Foo::bar"))
    case("php", "App::Cls::for().run", "Out::run", ("method", "Cls::for", "Out"), ("method", "Out::run"))
    case("php", "App\\Own::for().run3", None, ("method", "Own::for", "Out3"), ("method", "Out3::run3"))
    case("php", "helper().run2", None, ("function", "helper", "Out2"), ("method", "Out2::run2"))
    case("cpp", "make_unique<W>().draw", "W::draw", ("method", "W::draw"))
    case("cpp", "ns::Reg::instance().get", "Reg::get", ("method", "Reg::instance", "Reg"), ("method", "Reg::get"))
    case("cpp", "ns::Widget().paint", "Widget::paint", ("class", "Widget"), ("method", "Widget::paint"))
    case("go", "New().Run", "Engine::Run", ("function", "New", "Engine"), ("method", "Engine::Run"))
    case("kotlin", "Foo().go", "Foo::go", ("class", "Foo"), ("method", "Foo::go"))
    case("java", "Foo().go", None, ("class", "Foo"), ("method", "Foo::go"))
    case("kotlin", "factory().go2", None, ("function", "factory", "Foo2"), ("method", "Foo2::go2"))
    case("swift", "a.b.Foo.shared().go", "Bar::go", ("method", "Foo::shared", "Bar"), ("method", "Bar::go"), ("method", "Decoy::go"))
    case("csharp", "Foo.Get().Absent", None, ("method", "Foo::Get", "Bar"), ("method", "Other::Absent"))
    case("objc", "X.alloc().start", "X::start", ("method", "X::start"))
    case("pascal", "TFoo.Create().Save", "TFoo::Save", ("method", "TFoo::Save"))
    none = spark.createDataFrame([], "source string, target string, kind string")
    table = spark.createDataFrame(refs, "ref_id string, name string, language string, file_path string")
    got = {x["ref_id"]: (x["target"], x["confidence"]) for x in C.chains(table, frame(spark, rows), none).collect()}
    assert got == want


def test_imports_tell_types_apart(spark):
    rows = [("m", "method", "make", "F::make", "java", "F.java", 1, 1, "Conv"), ("a", "method", "convert", "Conv::convert", "java", "src/dao/Conv.java"), ("b", "method", "convert", "Conv::convert", "java", "src/service/Conv.java")]
    refs = spark.createDataFrame([("1", "F.make().convert", "java", "x.java"), ("2", "F.make().convert", "java", "y.java")], "ref_id string, name string, language string, file_path string")
    imports = spark.createDataFrame([("x.java", "Conv", "service.Conv")], "file_path string, local_name string, source string")
    none = spark.createDataFrame([], "source string, target string, kind string")
    got = {x["ref_id"]: x["target"] for x in C.chains(refs, frame(spark, rows), none, imports).collect()}
    assert got == {"1": "b", "2": "a"}


def test_fields_of_the_class_around(spark):
    rows = [("K", "class", "K", "K", "java", "K.java", 1, 20), ("In", "class", "In", "K::In", "java", "K.java", 10, 15), ("f1", "field", "bo", "K::bo", "java", "K.java", 2, 2, None, "private com.x.UserBO<T> bo"), ("f2", "field", "bo", "In::bo", "java", "K.java", 11, 11, None, "Other bo"), ("u", "method", "save", "UserBO::save", "java", "U.java"), ("o", "method", "save", "Base::save", "java", "B.java"), ("Other", "class", "Other", "Other", "java", "O.java"), ("Base", "class", "Base", "Base", "java", "B.java")]
    refs = spark.createDataFrame([("outer", "bo.save", "java", "K.java", 5), ("inner", "bo.save", "java", "K.java", 12), ("none", "xx.save", "java", "K.java", 5)], "ref_id string, name string, language string, file_path string, line int")
    edges = spark.createDataFrame([("Other", "Base", "extends")], "source string, target string, kind string")
    got = {x["ref_id"]: x["target"] for x in C.field_calls(refs, frame(spark, rows), edges).collect()}
    assert got == {"inner": "o", "outer": "u"}


def test_flows_between_named_symbols(spark):
    from skarn.operators import graph

    r = random.Random(8)
    ids = [f"n{i:02}" for i in range(50)]
    edges = {(r.choice(ids), r.choice(ids)) for _ in range(90)}
    named = set(r.sample(ids, 22))
    want, chains = {}, {}
    for seed in named:
        parent, level = {seed: None}, [seed]
        depth = {seed: 0}
        for k in range(1, 7):
            step = {}
            for a, b in sorted(edges):
                if a in level and b not in parent and (a in named or b in named):
                    step.setdefault(b, a)
            parent |= step
            depth |= dict.fromkeys(step, k)
            level = list(step)
        ends = sorted((-depth[x], x) for x in named if depth.get(x, 0) > 0)
        if ends:
            want[seed] = (ends[0][1], -ends[0][0])
            at, chain = ends[0][1], []
            while at:
                chain.append(at)
                at = parent[at]
            chains[seed] = chain[::-1]
    table = spark.createDataFrame([(a, b, "calls") for a, b in edges] + [("n00", "n01", "contains"), (None, "n01", "calls")], "source string, target string, kind string")
    asked = spark.createDataFrame([(x,) for x in [*named, ids[0] if ids[0] in named else None]], "id string")
    reached = graph.named_reach(table, asked)
    assert {x["seed"]: (x["sink"], x["depth"]) for x in graph.named_flows(reached, asked).collect()} == want and len(want) > 10
    best = min(want, key=lambda s: (-want[s][1], s))
    got = [x["id"] for x in sorted(graph.longest_flow(reached, asked).collect(), key=lambda x: x["step"])]
    assert got == chains[best] and len(got) > 3


def test_references_with_nulls_are_resolved(spark):
    from skarn.operators import search

    nodes = spark.createDataFrame([("f", "function", "go", "a::go", "a.py", "python", 1, 1)], "id string, kind string, name string, qualified_name string, file_path string, language string, start_line int, is_exported int")
    refs = spark.createDataFrame([("1", "go", "calls", "python", "b.py", None), ("2", "go", None, "python", "b.py", 3), ("3", "go", "calls", "python", "b.py", 4)], "ref_id string, name string, kind string, language string, file_path string, line int")
    assert {x["ref_id"]: x["target"] for x in search.resolve(refs, nodes).collect()} == {"1": "f", "2": "f", "3": "f"}
