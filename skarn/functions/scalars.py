"""Scalar functions of the engine as Column expressions: line ranges, citations, names, paths, tokens."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Ranking bonus of a symbol's kind (fixed values).
KIND_BONUS = {
    "function": 10, "method": 10, "class": 8, "interface": 9, "type_alias": 6, "struct": 6, "trait": 9, "enum": 5, "component": 8, "route": 9, "module": 4,
    "property": 3, "field": 3, "variable": 2, "constant": 3, "import": 1, "export": 1, "parameter": 0, "namespace": 4, "file": 0, "protocol": 9, "enum_member": 3,
}
#: Patterns of citations and of secrets in reports (fixed values).
CITATION = r"([A-Za-z0-9_./@+-]+):(\d+(?:-\d+)?)"
SECRET = r"(?i)\b(?:sk|ds)-[A-Za-z0-9_-]{8,}\b"
#: Tokens of code and runs of Han characters (fixed values).
CODE_TOKEN = r"([a-z_][a-z0-9_:.>\\/-]*)"
HAN_RUN = r"([\x{4e00}-\x{9fff}]+)"


def line_range(lines: Column) -> Column:
    """struct(start, end) of ``N`` or ``N-M``; null unless 1 <= start <= end."""
    start = F.regexp_extract(lines, r"^(\d+)(?:-(\d+))?$", 1).try_cast("bigint")
    end = F.coalesce(F.regexp_extract(lines, r"^(\d+)(?:-(\d+))?$", 2).try_cast("bigint"), start)
    return F.when((start > 0) & (end >= start), F.struct(start.alias("start"), end.alias("end")))


def line_range_split(lines: Column) -> Column:
    """The tolerant variant: parts around the first dash, blanks allowed."""
    parts = F.split(lines, "-", 2)
    start = F.trim(F.get(parts, F.lit(0))).try_cast("int")
    end = F.when(F.size(parts) > 1, F.trim(F.get(parts, F.lit(1))).try_cast("int")).otherwise(start)
    return F.when((start > 0) & (end >= start), F.struct(start.alias("start"), end.alias("end")))


def line_start(lines: Column) -> Column:
    return F.coalesce(F.trim(F.substring_index(lines, "-", 1)).try_cast("int"), F.lit(1))


def overlap(a: Column, b: Column) -> Column:
    """Null where a range is: greatest and least would pass over it."""
    return (a["start"] <= b["end"]) & (b["start"] <= a["end"])


def citations(text: Column) -> Column:
    """array of struct(path, lines) cited as path:N or path:N-M."""
    paths, lines = (F.regexp_extract_all(text, F.lit(CITATION), F.lit(g)) for g in (1, 2))
    return F.zip_with(paths, lines, lambda p, n: F.struct(p.alias("path"), n.alias("lines")))


def redacted(text: Column) -> Column:
    return F.regexp_replace(text, SECRET, "[redacted]")


def kind_bonus(kind: Column) -> Column:
    table = F.create_map(*[F.lit(x) for kv in KIND_BONUS.items() for x in kv])
    return F.coalesce(F.try_element_at(table, kind), F.lit(0))


def name_bonus(name: Column, query: str) -> Column:
    """80 for the query itself, 60 for one of its words, a share for a prefix, 15 for all its terms, 10 for a substring."""
    import re

    low = F.lower(name)
    terms = [t.lower() for t in re.split(r"[\s_.\-]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", query)) if len(t) >= 2]
    words = [t.lower() for t in query.split() if len(t) >= 2]
    whole = re.sub(r"\s+", "", query).lower()
    out = F.when(low == whole, 80)
    if len(words) > 1:
        out = out.when(low.isin(words), 60)
    out = out.when(low.startswith(whole), F.floor(10 + 30 * (F.lit(float(len(whole))) / F.length(low)) + 0.5).cast("int"))
    if len(terms) > 1:
        every = F.lit(True)
        for t in terms:
            every = every & low.contains(t)
        out = out.when(every, 15)
    return out.when(low.contains(whole), 10).otherwise(0)


#: Words that a search ignores (fixed values).
STOP_WORDS = set("""the a an and or but in on at to for of with by from is it that this are was be has had have do does did will would could
should may might can shall not no all each every how what where when who which why i me my we our you your he she they show give tell
been done made used using work works found also into then than just more some such over only out its so up as if look need needs want
happen happens affect affected break breaks failing implemented implement
code file files function method class type fix bug called""".split())
#: Compound identifiers in a query: camel case and snake case (fixed values).
COMPOUNDS = (r"\b([a-zA-Z][a-zA-Z0-9]*(?:[A-Z][a-z]+)+|[A-Z][a-z]+(?:[A-Z][a-z]*)+)\b", r"\b([a-zA-Z][a-zA-Z0-9]*(?:_[a-zA-Z0-9]+)+)\b")
#: File names and folders of tests and of what is no production code (fixed values). The camel-cased ones see the case.
TEST_NAME = r"^test[_.]|[._-](test|tests|spec|specs)\.[a-z0-9]+$"
TEST_NAME_CASED = r"(Test|Tests|TestCase|Tester|Spec|Specs)\.[A-Za-z0-9]+$"
TEST_FOLDER = r"/(tests|test|__tests__|spec|specs|testlib|testing)/|^(test|tests|spec|specs)/|(^|/)(integration|samples?|examples?|fixtures?|benchmarks?|demos?)/"
TEST_FOLDER_CASED = r"(^|/)[A-Za-z0-9]*(Test|Tests|Spec)/"
#: Files of little value as a project's centre: tests by lower-case path, and generated files (fixed values).
LOW_VALUE = (
    r"(^|/)(tests?|__tests?__|spec)/|_test\.go$|(^|/)test_[^/]+\.py$|_test\.py$|_spec\.rb$|_test\.rb$|\.(test|spec)\.[jt]sx?$"
    r"|(test|spec|tests)\.(java|kt|scala)$|(tests?|spec)\.cs$|tests?\.swift$|_test\.dart$"
)
GENERATED = (
    r"\.pb\.go$|\.pulsar\.go$|_grpc\.pb\.go$|_mock\.go$|_mocks\.go$|^mock_[^/]+\.go$|\.generated\.[jt]sx?$|\.gen\.[jt]sx?$|\.pb\.[jt]s$|_pb\.[jt]s$"
    r"|_grpc_pb\.[jt]s$|\.min\.m?js$|_pb2(_grpc)?\.py$|_pb2\.pyi$|\.pb\.(cc|h)$|\.g\.cs$|Grpc\.cs$|OuterClass\.java$|Grpc\.java$|\.pb\.swift$"
    r"|\.g\.dart$|\.freezed\.dart$|\.pb\.dart$|\.pbgrpc\.dart$|\.chopper\.dart$|\.generated\.rs$"
)


def stem_variants(word: str) -> list[str]:
    """Forms of a lower-case word without common endings, of 3 letters or more and other than the word."""
    found, n = [], len(word)

    def bare(cut: int) -> None:
        base = word[:-cut]
        found.extend([base, base + "e"])
        if base[-2:-1] and base[-1] == base[-2]:
            found.append(base[:-1])

    if word.endswith("ing") and n > 5:
        bare(3)
    if word.endswith(("tion", "sion")) and n > 5:
        found.append(word[:-3])
    if word.endswith("ment") and n > 6:
        found.append(word[:-4])
    if word.endswith("ies") and n > 4:
        found.append(word[:-3] + "y")
    elif word.endswith("es") and n > 4:
        found.append(word[:-2])
    elif word.endswith("s") and not word.endswith("ss") and n > 4:
        found.append(word[:-1])
    if word.endswith("ed") and not word.endswith("eed") and n > 4:
        found.extend([word[:-1], word[:-2]] + ([word[:-3] + "y"] if word.endswith("ied") and n > 5 else []))
    if word.endswith("er") and n > 4:
        bare(2)
    return [w for w in dict.fromkeys(found) if len(w) >= 3 and w != word]


def stems(word: Column) -> Column:
    """``stem_variants`` of a column."""
    w, n = F.lower(word), F.length(word)
    cut = lambda k: F.substring(w, F.lit(1), n - k)
    none = F.array().cast("array<string>")

    def when(ending: Column, more_than: int, *made: Column) -> Column:
        return F.when(ending & (n > more_than), F.array(*made)).otherwise(none)

    def bare(k: int) -> list[Column]:
        last, before = F.substring(w, n - k, F.lit(1)), F.substring(w, n - k - 1, F.lit(1))
        return [cut(k), F.concat(cut(k), F.lit("e")), F.when((last == before) & (n - k >= 2), cut(k + 1))]

    ies, es, s = w.endswith("ies"), w.endswith("es"), w.endswith("s")
    parts = [
        when(w.endswith("ing"), 5, *bare(3)),
        when(w.endswith("tion") | w.endswith("sion"), 5, cut(3)),
        when(w.endswith("ment"), 6, cut(4)),
        when(ies, 4, F.concat(cut(3), F.lit("y"))),
        when(es & ~ies, 4, cut(2)),
        when(s & ~es & ~w.endswith("ss"), 4, cut(1)),
        when(w.endswith("ed") & ~w.endswith("eed"), 4, cut(1), cut(2), F.when(w.endswith("ied") & (n > 5), F.concat(cut(3), F.lit("y")))),
        when(w.endswith("er"), 4, *bare(2)),
    ]
    return F.array_distinct(F.filter(F.concat(*parts), lambda x: x.isNotNull() & (F.length(x) >= 3) & (x != w)))


def search_terms(query: str, with_stems: bool = True) -> list[str]:
    """Terms of a query: compounds whole, then the words they split into, then stems; no stop words, 3 letters or more."""
    import re

    terms = dict.fromkeys(m.lower() for pattern in COMPOUNDS for m in re.findall(pattern, query) if len(m) >= 3)
    spaced = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1 \2", re.sub(r"([a-z])([A-Z])", r"\1 \2", query))
    words = (w.lower() for w in re.split(r"[^a-zA-Z0-9]+", spaced))
    terms.update(dict.fromkeys(w for w in words if len(w) >= 3 and w not in STOP_WORDS))
    if with_stems:
        terms.update(dict.fromkeys(v for t in list(terms) for v in stem_variants(t) if v not in terms and v not in STOP_WORDS))
    return list(terms)


def is_distinctive(token: str) -> bool:
    """Whether a query's word looks like an identifier: an underscore, a digit, or a capital after its first letter."""
    return any(c == "_" or c.isdigit() for c in token) or any("A" <= c <= "Z" for c in token[1:])


def name_token(raw: Column) -> Column:
    """A name by its letters and digits alone, lower case."""
    return F.regexp_replace(F.lower(raw), "[^a-z0-9]", "")


def path_relevance(path: Column, query: str, project_names: tuple = ()) -> Column:
    """For each word of the query that does not name the project: 10 if a part of it is in the file's name, and 5 if in
    its folder, else 3 if anywhere in the path. Tests lose 15 unless the query asks for them."""
    import re

    low, out = F.lower(path), F.lit(0)
    base, folder = F.element_at(F.split(low, "/"), -1), F.lower(dirname(path))
    words = query.split()
    words = [w for w in words if re.sub("[^a-z0-9]", "", w.lower()) not in project_names] or words
    for parts in filter(None, (search_terms(w, with_stems=False) for w in words)):

        def in_(column: Column, parts=parts) -> Column:
            found = F.lit(False)
            for t in parts:
                found = found | column.contains(t)
            return found

        out = out + F.when(in_(base), 10).otherwise(0) + F.when(in_(folder), 5).when(in_(low), 3).otherwise(0)
    if not words or "test" in query.lower() or "spec" in query.lower():
        return out
    return out - F.when(is_test_file(path), 15).otherwise(0)


def is_test_file(path: Column) -> Column:
    base, low = basename(path), F.lower(path)
    return F.lower(base).rlike(TEST_NAME) | base.rlike(TEST_NAME_CASED) | low.rlike(TEST_FOLDER) | path.rlike(TEST_FOLDER_CASED)


def is_low_value_file(path: Column) -> Column:
    """Tests and generated files."""
    return F.lower(path).rlike(LOW_VALUE) | path.rlike(GENERATED)


def is_generated_file(path: Column) -> Column:
    return path.rlike(GENERATED)


def glob_pattern(glob: str) -> str:
    """Anchored regular expression of a glob with * and ?."""
    import re

    return "^" + "".join(".*" if c == "*" else "." if c == "?" else re.escape(c) for c in glob) + "$"


def basename(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def dirname(path: Column) -> Column:
    """Folder of a path; ``.`` at the root."""
    return F.coalesce(F.nullif(F.regexp_extract(path, r"^(.*)/[^/]*$", 1), F.lit("")), F.lit("."))


def split_identifier(name: Column) -> Column:
    """Lower-case words of a camel, snake or dotted name."""
    spaced = F.regexp_replace(F.regexp_replace(name, r"([a-z0-9])([A-Z])", "$1 $2"), r"[^A-Za-z0-9]+", " ")
    return F.filter(F.split(F.lower(F.trim(spaced)), " "), lambda w: F.length(w) > 0)


def query_surface(query: Column) -> Column:
    """Shape of a query: Latin runs X, Han runs C, digits 0, single blanks."""
    han = F.regexp_replace(F.regexp_replace(query, r"[A-Za-z_][A-Za-z0-9_]*", "X"), r"[\x{4e00}-\x{9fff}]+", "C")
    return F.trim(F.regexp_replace(F.regexp_replace(han, r"[0-9]+", "0"), r"\s+", " "))


def significant_tokens(text: Column) -> Column:
    """Code-like tokens of 3 characters or more, lower case, and the two-character pieces of Han runs (a lone one whole)."""
    code = F.filter(F.regexp_extract_all(F.lower(text), F.lit(CODE_TOKEN), F.lit(1)), lambda t: F.length(t) >= 3)
    runs = F.regexp_extract_all(text, F.lit(HAN_RUN), F.lit(1))
    pairs = F.flatten(F.transform(runs, lambda r: F.transform(F.sequence(F.lit(1), F.greatest(F.length(r) - 1, F.lit(1))), lambda i: F.substring(r, i, F.lit(2)))))
    return F.array_distinct(F.concat(code, pairs))


def lexical_match(wanted: Column, text: Column, threshold: float = 0.45) -> Column:
    """Whether enough of the wanted statement's tokens are in the text, and all of those with ``_``, ``.`` or ``/``."""
    want, have = significant_tokens(wanted), significant_tokens(text)
    code = F.filter(want, lambda t: t.rlike("[_./]"))
    share = F.size(F.array_intersect(want, have)) / F.greatest(F.size(want), F.lit(1))
    return F.when((F.size(want) == 0) | (F.size(have) == 0), False).when(F.size(F.array_except(code, have)) > 0, False).otherwise(share >= threshold)


def verdict(raw: Column) -> Column:
    """Normalised judge verdict."""
    low = F.lower(F.trim(F.coalesce(raw, F.lit(""))))
    return (
        F.when(low.isin("correct", "pass", "passed", "yes", "true"), "correct")
        .when(low.isin("partial", "partially_correct", "warn"), "partial")
        .when(low.isin("incorrect", "fail", "failed", "no", "false"), "incorrect")
        .when(low.isin("not_run", "error"), low)
        .otherwise("unknown")
    )


#: Tokens that tell answers apart, and words that don't (fixed values).
ANSWER_TOKEN = r"([A-Za-z_][A-Za-z0-9_]{2,}|[\x{4e00}-\x{9fff}]{2,})"
ANSWER_STOP = ("the", "and", "for", "with", "this", "that", "from", "any", "are", "but", "了", "的", "是", "在", "也", "和", "或", "由", "对", "为")


def answer_tokens(text: Column) -> Column:
    found = F.transform(F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANSWER_TOKEN), F.lit(1)), F.lower)
    return F.array_except(found, F.array(*[F.lit(w) for w in ANSWER_STOP]))


def label_code(label: Column, default: str = "unknown") -> Column:
    """Code of a label, a struct with ``code``; ``default`` where it is missing."""
    return F.coalesce(label["code"], F.lit(default))


def judgement(text: Column) -> Column:
    """struct(score, verdict, rationale) of a judge's JSON, or of the first ``{`` to the last ``}`` in its text; null without
    an object. The score is held to 0..1."""
    cut = F.regexp_extract(text, r"(?s)(\{.*\})", 1)
    raw = F.when(F.json_object_keys(text).isNotNull(), text).when(F.json_object_keys(cut).isNotNull(), cut)
    score = F.get_json_object(raw, "$.score").try_cast("double")
    return F.when(raw.isNotNull(), F.struct(F.when(score.isNotNull(), F.least(F.greatest(score, F.lit(0.0)), F.lit(1.0))).alias("score"), verdict(F.get_json_object(raw, "$.verdict")).alias("verdict"), F.coalesce(F.get_json_object(raw, "$.rationale"), F.lit("")).alias("rationale")))


def whole_number(value: Column) -> Column:
    """An integral number as long, else null."""
    return F.when(value == F.floor(value), value.cast("long"))


def truncated(text: Column, limit: int) -> Column:
    """Blanks collapsed, and at most ``limit`` characters, the last three dots where something went."""
    flat = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    return F.when(F.length(flat) > limit, F.concat(F.rtrim(F.substring(flat, 1, limit - 3)), F.lit("..."))).otherwise(flat)


def half_up(value: Column) -> Column:
    """Rounded, halves up; ``F.bround`` rounds halves to even."""
    return F.floor(value + 0.5)


def node_id(kind: Column, file_path: Column, name: Column, line: Column) -> Column:
    """kind: and the first 32 hex digits of sha256 over file, kind, name and line."""
    return F.concat(kind, F.lit(":"), F.substring(F.sha2(F.concat_ws(":", file_path, kind, name, line.cast("string")), 256), 1, 32))


def entity_id(project: Column, *parts: Column) -> Column:
    return F.concat(F.lit("ent_"), project, F.lit("_"), F.substring(F.sha2(F.concat_ws("|", project, *[p.cast("string") for p in parts]), 256), 1, 12))
