"""Secret spans by patterns and by character Markov models, in DataFrame operations only.

Three base patterns find assignments, access keys and long hexadecimal runs. Beside them, every run of 16 or more
key-like characters is scored by two first-order character models, one of random strings and one of ordinary
identifiers: the sum over its characters of the logarithm of the two transition probabilities' ratio. What base spans
leave of a run is scored by itself where it has 16 characters. If the mean ratio reaches ``least``, all of it is a span of
kind ``markov``; else its stretches are, of 16 characters or more, from where the sum of ratios less ``least`` rises to
its peak, a stretch ending where that sum is used up or falls by ``DROP`` from its peak. So a name or path before a value
does not hide it.

The models are counted from labelled samples, (text, random) rows, with add-one smoothing over character classes; the
counts of 65 x 65 transitions are all that reaches the driver. ``default_samples`` makes samples: digests in several
alphabets as random strings, and names joined from programming words and plain numbers as ordinary ones.

All work is near linear in a text: sums over its matches go by blocks, and what base spans leave is found in the text with
blanks in their place. Positions count code points, ends are exclusive. A pattern's matches are found whole and then filtered, so that what a
failing match covers is not searched again.

Defined results: a null text is empty and has no spans. Repeated rows give repeated results. Extra columns are ignored.
A text of one very long run is one candidate. An empty table gives an empty table. Without samples of a label its
transitions are all alike.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._common import bound, running

#: The base patterns (fixed values of the contract), in the order of kinds.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
LEAST_VALUE = 6
RUN = r"[A-Za-z0-9+/_=-]{16,}+"
KINDS = ("assign", "access", "hex", "markov")
#: Mean log-likelihood ratio, in nats a character, from which a run counts as random.
LEAST_RATIO = 0.45
LEAST_RUN = 16
#: A fall from the peak, in nats, that ends a stretch.
DROP = 8.0
#: Stretches of a run that are moved on together.
BLOCK = 256
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/"
_SIZE = len(ALPHABET) + 1  # all other characters are one class

#: Words that ordinary identifiers are made of (fixed values).
WORDS = """account action active address after agent alert array async base batch before begin binary block body buffer
build button cache call cancel channel check child class clean client close cluster code color column command commit
config connect content context control copy count create current data date debug default delete device dialog document
domain download driver element email empty enable encode engine entry error event export factory failed field file filter
first folder format function future gateway global graph group handler hash header height helper history host image
import index info init input insert instance item iterator join kernel label last layer layout length level library limit
line link list load local lock login manager map master match memory merge message method metric model module monitor
mouse name network node number object offset open option order output owner package page panel parent parse password path
pattern payload pending pipeline plugin point policy pool port prefix process product profile project property provider
proxy public query queue random range reader record reference region register release remote render report request reset
resource response result retry return root route runtime sample scale schedule schema scope screen script search section
select send sequence server service session setting shadow shape shared signal size socket source split stack start state
static status storage store stream string style submit summary switch system table target task template test text thread
time timeout title token total trace transaction transform tree trigger type unique update upload user util validate value
vector version view visible volume wait watch widget width window worker wrapper write""".split()


def default_samples(spark: SparkSession, n: int = 4_000) -> DataFrame:
    """(text, random): ``n`` random strings in four alphabets and ``n`` ordinary identifiers and numbers in seven styles."""
    digest = F.sha2(F.concat(F.lit("sample "), F.col("id")), 512)
    random = F.array(F.substring(digest, 1, 40), F.upper(F.substring(digest, 1, 32)), F.base64(F.unhex(F.substring(digest, 1, 64))), F.regexp_replace(F.base64(F.unhex(F.substring(digest, 65, 64))), "[+/=]", ""))
    word = F.array(*[F.lit(w) for w in WORDS])
    picked = [F.get(word, F.pmod(F.xxhash64("id", F.lit(k)), F.lit(len(WORDS))).cast("int")) for k in range(4)]
    named = F.array(F.concat_ws("_", *picked), F.concat(picked[0], *[F.initcap(w) for w in picked[1:]]), F.concat_ws("-", *picked[:3]), F.concat(*picked[:3]), F.upper(F.concat_ws("_", *picked)), F.upper(F.concat(*picked[:3])), F.lpad(F.pmod(F.xxhash64("id"), F.lit(10**16)).cast("string"), 16, "1"))
    ids = spark.range(n)
    return ids.select(F.get(random, F.pmod("id", F.lit(4)).cast("int")).alias("text"), F.lit(True).alias("random")).unionByName(ids.select(F.get(named, F.pmod("id", F.lit(7)).cast("int")).alias("text"), F.lit(False).alias("random")))


def _class(c: Column) -> Column:
    """Index of a character in the alphabet; the others share the last."""
    at = F.instr(F.lit(ALPHABET), c)
    return F.when((F.length(c) == 1) & (at > 0), at - 1).otherwise(_SIZE - 1)


def train(samples: DataFrame) -> list[float]:
    """Log ratio of the transition probabilities, random over ordinary, at ``previous * _SIZE + next``."""
    n = F.length("text")
    pair = F.explode(F.transform(F.sequence(F.lit(2), n), lambda i: F.struct(_class(F.substring("text", i - 1, F.lit(1))).alias("l"), _class(F.substring("text", i, F.lit(1))).alias("r"))))
    counts = samples.where(n >= 2).select("random", pair.alias("p")).groupBy("random", "p.l", "p.r").count().collect()  # at most 2 * _SIZE ** 2 rows
    table = {True: [1.0] * _SIZE**2, False: [1.0] * _SIZE**2}
    for r in counts:
        if r["random"] is not None:
            table[r["random"]][r["l"] * _SIZE + r["r"]] += r["count"]
    out = []
    for left in range(_SIZE):
        rows = {k: table[k][left * _SIZE : (left + 1) * _SIZE] for k in table}
        total = {k: sum(v) for k, v in rows.items()}
        out += [math.log(a / total[True]) - math.log(b / total[False]) for a, b in zip(rows[True], rows[False])]
    return out


def stretches(run: Column, model: list[float], least: float) -> Column:
    """(start, end) within ``run``: all of it where its mean ratio reaches ``least``, else its stretches that do."""
    table = F.array(*[F.lit(round(x, 6)) for x in model])
    kind = "array<struct<start:int,end:int>>"
    one = lambda start, end: F.array(F.struct(start.cast("int").alias("start"), end.cast("int").alias("end")))
    none = F.array().cast(kind)
    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("at"), F.lit(0.0).alias("total"), F.lit(0.0).alias("now"), F.lit(0.0).alias("peak"), F.lit(0).alias("start"), F.lit(0).alias("end"), none.alias("out"), F.array().cast(f"array<{kind}>").alias("outs"))

    def flushed(a: Column) -> Column:
        return F.when(a["end"] - a["start"] >= LEAST_RUN, F.concat(a["out"], one(a["start"], a["end"]))).otherwise(a["out"])

    def step(a: Column, c: Column) -> Column:
        x = F.when(a["last"] >= 0, F.get(table, a["last"] * _SIZE + c)).otherwise(0.0)
        over = (a["now"] <= 0) | (a["now"] < a["peak"] - DROP)
        begin = F.when(over, F.greatest(a["at"] - 1, F.lit(0))).otherwise(a["start"])
        before, peak = F.when(over, 0.0).otherwise(a["now"]), F.when(over, 0.0).otherwise(a["peak"])
        now = before + F.when(a["last"] >= 0, x - least).otherwise(0.0)
        end = F.when(now > peak, a["at"] + 1).when(over, begin).otherwise(a["end"])
        full = F.size(a["out"]) >= BLOCK  # what is found moves on in blocks, not as a whole at each step
        out = F.when(over, flushed(a)).when(full, none).otherwise(a["out"])
        outs = F.when(~over & full, F.concat(a["outs"], F.array(a["out"]))).otherwise(a["outs"])
        return F.struct(c.alias("last"), (a["at"] + 1).alias("at"), (a["total"] + x).alias("total"), now.alias("now"), F.greatest(now, peak).alias("peak"), begin.alias("start"), end.alias("end"), out.alias("out"), outs.alias("outs"))

    def finish(a: Column) -> Column:
        found = F.flatten(F.concat(a["outs"], F.array(flushed(a))))
        return F.when(a["total"] / F.greatest(a["at"] - 1, F.lit(1)) >= least, one(F.lit(0), a["at"])).otherwise(found)

    return F.aggregate(F.transform(F.split(run, ""), _class), start, step, finish)


def places(text: Column, pattern: str, found: Column) -> Column:
    """(start, end, at, match) of ``found``, all matches of ``pattern`` in ``text``; ``at`` is the byte where one starts."""
    gaps = F.split(text, pattern, -1)
    kind = "array<struct<start:int,end:int,at:int,match:string>>"
    both = F.zip_with(F.slice(gaps, F.lit(1), F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), F.octet_length(g).alias("bytes"), m.alias("match")))
    add = lambda a, b: a + b

    def put(parts: Column) -> Column:
        before = running(F.transform(parts, lambda x: x["gap"] + F.length(x["match"])), F.lit(0), add)
        bytes_before = running(F.transform(parts, lambda x: x["bytes"] + F.octet_length(x["match"])), F.lit(0), add)
        with_both = F.zip_with(before, bytes_before, lambda a, b: F.struct(a.alias("start"), b.alias("at")))

        def one(x: Column, b: Column) -> Column:
            start = b["start"] + x["gap"]
            return F.struct(start.alias("start"), (start + F.length(x["match"])).alias("end"), (b["at"] + x["bytes"]).alias("at"), x["match"].alias("match"))

        return F.zip_with(parts, with_both, one)

    return F.when(F.size(found) > 0, bound(both, put)).otherwise(F.array().cast(kind))


def merged(spans_: Column) -> Column:
    """(start, end, at) of what the spans, sorted by start, cover together."""

    def put(own: Column) -> Column:
        tops = running(F.transform(own, lambda s: s["end"]), F.lit(-1), lambda a, b: F.greatest(a, b))
        marked = F.zip_with(own, tops, lambda s, top: F.struct(s["start"].alias("start"), s["at"].alias("at"), top.alias("top")))
        last = F.array_max(F.transform(own, lambda s: s["end"]))
        first = F.filter(marked, lambda x: x["top"] < x["start"])
        return bound(first, lambda f: F.transform(f, lambda x, i: F.struct(x["start"].alias("start"), F.coalesce(F.get(f, i + 1)["top"], last).alias("end"), x["at"].alias("at"))))

    return bound(spans_, put)


def masked(text: Column, covered: Column) -> Column:
    """``text`` with blanks in place of the covered spans, which are ASCII; cut as bytes, so that a piece costs its length."""

    def put(both: Column) -> Column:
        raw, own = both["raw"], both["own"]
        behind = lambda m: F.coalesce(m["at"] + m["end"] - m["start"], F.lit(0))
        piece = lambda from_, size: F.substring(raw, from_ + 1, size).cast("string")
        kept = F.transform(own, lambda m, i: F.concat(piece(behind(F.get(own, i - 1)), m["at"] - behind(F.get(own, i - 1))), F.repeat(F.lit(" "), m["end"] - m["start"])))
        rest = behind(F.get(own, F.size(own) - 1))
        return F.concat(F.array_join(kept, ""), piece(rest, F.length(raw) - rest))

    return F.when(F.size(covered) > 0, bound(F.struct(text.cast("binary").alias("raw"), covered.alias("own")), put)).otherwise(text)


def spans(docs: DataFrame, model: list[float], id_col: str = "doc_id", text: str = "text", least: float = LEAST_RATIO) -> DataFrame:
    """(doc_id, assign, access, hex, markov): arrays of (start, end, match) for each kind."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    patterns = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}
    found = own.select("doc_id", "t", F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2)).alias("values"), *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"m_{k}") for k, p in patterns.items()])
    placed = found.select("doc_id", "t", "values", *[places(F.col("t"), p, F.col(f"m_{k}")).alias(k) for k, p in patterns.items()])
    valued = F.zip_with("assign", "values", lambda s, v: F.when(F.length(v) >= LEAST_VALUE, s))
    placed = placed.select("doc_id", "t", F.filter(valued, lambda s: s.isNotNull()).alias("assign"), "access", "hex")
    flat = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["at"].alias("at")))
    covered = merged(F.array_sort(F.concat(*[flat(k) for k in patterns])))
    # what base spans leave of runs are the runs of the text without them
    bare = placed.select("doc_id", *patterns, masked(F.col("t"), covered).alias("t"))
    free = bare.select("doc_id", *patterns, bound(F.col("t"), lambda t: places(t, RUN, F.regexp_extract_all(t, F.lit(RUN), F.lit(0)))).alias("runs"))
    part = lambda s, x: F.struct((s["start"] + x["start"]).alias("start"), (s["start"] + x["end"]).alias("end"), F.substring(s["match"], x["start"] + 1, x["end"] - x["start"]).alias("match"))
    markov = F.flatten(F.transform("runs", lambda s: F.transform(stretches(s["match"], model, least), lambda x: part(s, x))))
    plain = lambda k: F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["match"].alias("match"))).alias(k)
    return free.select("doc_id", *[plain(k) for k in patterns], markov.alias("markov"))


def listed(kinds: tuple) -> Column:
    """kind:start:end of the spans by start, then kind as listed, joined by commas."""
    return F.array_join(F.transform(F.array_sort(F.concat(*[_tag(k) for k in kinds])), lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _tag(kind: str) -> Column:
    return F.transform(kind, lambda s: F.struct(s["start"].alias("start"), F.lit(KINDS.index(kind)).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("name")))


def report(found: DataFrame) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, n_markov, base_sha256, spans)."""
    return found.select(
        "doc_id",
        *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS],
        F.sha2(listed(KINDS[:3]), 256).alias("base_sha256"),
        listed(KINDS).alias("spans"),
    )


def brute_force(text: str | None, model: list[float], least: float = LEAST_RATIO) -> list[tuple]:
    """(kind, start, end) of one text by Python's regular expressions, for tests."""
    import re

    t = text or ""
    assign = re.compile(r"""(?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    out = [("assign", m.start(), m.end()) for m in assign.finditer(t) if len(m[1]) >= LEAST_VALUE]
    out += [("access", m.start(), m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [("hex", m.start(), m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    base = list(out)
    for m in re.finditer(r"[A-Za-z0-9+/_=-]+", t):
        if len(m[0]) < LEAST_RUN:
            continue
        at = m.start()
        for start, end in [*((s, e) for s, e in sorted(b[1:] for b in base) if s < m.end() and m.start() < e), (m.end(), m.end())]:
            if start - at >= LEAST_RUN:
                out += [("markov", at + a, at + b) for a, b in _stretches(t[at:start], model, least)]
            at = max(at, end)
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _stretches(run: str, model: list[float], least: float) -> list[tuple]:
    c = [ALPHABET.find(x) if x in ALPHABET else _SIZE - 1 for x in run]
    ratios = [round(model[a * _SIZE + b], 6) for a, b in zip(c, c[1:])]
    if sum(ratios) / len(ratios) >= least:
        return [(0, len(run))]
    out, now, peak, start, end = [], 0.0, 0.0, 0, 0
    for i, x in enumerate(ratios):
        if now <= 0 or now < peak - DROP:
            out.append((start, end))
            now, peak, start, end = 0.0, 0.0, i, i
        now += x - least
        if now > peak:
            peak, end = now, i + 2
    return [(a, b) for a, b in [*out, (start, end)] if b - a >= LEAST_RUN]
