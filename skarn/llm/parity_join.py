"""Jaccard self-join of word-shingle sets over XOR parity sketches.

A document's set holds its distinct ``width``-word shingles (a shorter text is one shingle). Sets link when
``100 * intersection >= percent * union``. Equal sets are one class from the start; classes are joined so:

1. *Sketch.* In each size band the shingle space is cut into blocks and every shingle XORs its 64-bit hash into its
   block's word. A shingle that only one of two sets has changes one block, so the number of differing blocks (and of
   differing bits in the one-bit-a-shingle sketch used below) never exceeds the symmetric difference.
2. *Pigeonhole join.* Linked sets of n and m shingles differ in at most (n + m)(1 - j) / (1 + j) shingles, so they agree
   on all but ``d`` non-empty blocks. With the blocks in one global order, the first ``d + r`` of either side then share
   at least ``r``. These keys are joined; a class with fewer than ``r`` shared keys can link with nothing and goes, and
   of the others the ``r - 1`` most frequent keys go, so a passage that many documents share yields no candidates.
3. *Verify.* Each class is first compared with the smallest class of its keys; what has not become one component by
   that is compared across components where sizes and the Hamming distance of bit sketches leave a link possible.
   The exact shingle sets decide every link.

No pair is lost: steps 1 and 2 only discard by bounds. (A class whose shingles crowd into so few blocks that no bound
remains still joins on all of them; with at most one shingle a block on average this needs an event below 1e-9.)

Defined results: null, empty and blank texts have no shingles, link with nothing and form components of their own.
Repeated rows are members of the same class. Extra columns are ignored. An empty table gives an empty table.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import _text
from ._common import broadcast_if_small, drop_stored, free_shuffles, map_text, stored
from ._graph import cluster_by_keys

WIDTH = 5
PERCENT = 75
#: Each size band reaches from a power of this to the next; a set near the upper end also joins in the next band.
BAND = 16
#: Keys beyond the differing ones, as a share of the set: how many common keys a link is asked to show.
SURPLUS = 1 / 24
#: Bits of the one-bit-a-shingle sketch, in 64-bit words.
SKETCH_WORDS = 16
_BLOCK_SEED = np.uint64(0xA24BAED4963EE407)
_ORDER_SEED = np.uint64(0x9FB21C651E98DF25)


def tokens(flat: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of every document and their offsets."""
    flat = _text.LOWER[flat]
    starts, ends, bound = _text.spans(flat, offsets, _text.NOT_BLANK)
    return _text.span_hashes(flat, starts, ends), bound


def sets(flat: np.ndarray, offsets: np.ndarray, width: int = WIDTH) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every document."""
    words, bound = tokens(flat, offsets)
    shingles, at = _text.shingle_hashes(words, bound, width)
    out = []
    for d in range(len(offsets) - 1):
        s = np.sort(shingles[at[d] : at[d + 1]])
        out.append(s[np.concatenate([[True], s[1:] != s[:-1]])] if len(s) else s)
    return out


def set_id(s: np.ndarray) -> int:
    """Signed 64-bit identity of a sorted set."""
    return int(np.array([_text.mix(s * np.uint64(_text.BASE)).sum(dtype=np.uint64) ^ np.uint64(len(s))], dtype=np.uint64).view(np.int64)[0])


def most_different(n: int, percent: int) -> int:
    """Largest symmetric difference of a set of n with a linked one, which has at most 100 n / percent shingles."""
    top = 100 * n // percent
    return (n + top) * (100 - percent) // (100 + percent)


def keys(s: np.ndarray, percent: int, surplus: float) -> tuple[np.ndarray, int]:
    """The join keys of a set in all its bands, and how many of one band's keys any linked set shares at least."""
    n = len(s)
    bands = sorted({_band(n), _band(-(-100 * n // percent))})
    d = most_different(n, percent)
    least = (1 << 62) - 1
    out = []
    for band in bands:
        blocks = BAND ** (band + 1) if band else 1 << 30
        which = ((_text.mix(s ^ _BLOCK_SEED) >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        order = np.argsort(which, kind="stable")
        which = which[order]
        first = np.flatnonzero(np.concatenate([[True], which[1:] != which[:-1]]))
        parity = np.bitwise_xor.reduceat(s[order], first)
        key = _text.mix(parity ^ _text.mix(which[first] * np.uint64(_text.BASE) + np.uint64(band + 1)))
        r = 1 + int(n * surplus)
        if len(key) > d + r:
            rank = _text.mix(key ^ _ORDER_SEED)
            key = key[np.argpartition(rank, d + r - 1)[: d + r]]
        common = max(1, min(1 + int(n * percent // 100 * surplus), len(first) - d))
        least = min(least, common)
        out.append(key)
    return np.concatenate(out), least


def _band(n: int) -> int:
    band = 0
    while BAND ** (band + 1) <= n:
        band += 1
    return band


def bit_sketch(s: np.ndarray) -> list[int]:
    bits = np.zeros(SKETCH_WORDS * 64, dtype=np.uint8)
    np.bitwise_xor.at(bits, (_text.mix(s + _BLOCK_SEED) >> np.uint64(32)).astype(np.int64) % len(bits), 1)
    return np.packbits(bits).view(np.int64).tolist()


def _describe(width: int):
    def work(flat, offsets, part):
        found = sets(flat, offsets, width)
        return [[len(s) for s in found], [set_id(s) if len(s) else None for s in found]]

    return work


def _emit(docs: DataFrame, text: str, width: int, percent: int, surplus: float) -> DataFrame:
    """(key, sid, least) rows. A task emits a set it has seen only once, as far as its memory of ids reaches."""
    import pyarrow as pa

    from ._common import ship

    ship(docs.sparkSession)
    schema = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("least", pa.int32())])

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            for _, flat, offsets in _text.steps(batch, "text"):
                parts, sids, leasts, counts = [], [], [], []
                for s in sets(flat, offsets, width):
                    if not len(s) or (sid := set_id(s)) in seen:
                        continue
                    if len(seen) < 1 << 20:
                        seen.add(sid)
                    own, least = keys(s, percent, surplus)
                    parts.append(own)
                    sids.append(sid)
                    leasts.append(least)
                    counts.append(len(own))
                if parts:
                    flat_keys = np.concatenate(parts).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(flat_keys), pa.array(np.repeat(np.array(sids, np.int64), counts)), pa.array(np.repeat(np.array(leasts, np.int32), counts))], schema=schema)

    return docs.select(F.col(text).alias("text")).mapInArrow(run, "key bigint, sid bigint, least int")


def _contents(docs: DataFrame, text: str, width: int) -> DataFrame:
    def start():
        import pyarrow as pa

        def work(flat, offsets, part):
            found = sets(flat, offsets, width)
            values = np.concatenate([*found, np.zeros(0, np.uint64)]).view(np.int64)
            ends = np.concatenate([[0], np.cumsum([len(s) for s in found])]).astype(np.int32)
            return [pa.ListArray.from_arrays(pa.array(ends), pa.array(values)), *map(list, zip(*[bit_sketch(s) for s in found]))]

        return work

    return map_text(docs, text, ["sid"], "shingles array<bigint>, " + ", ".join(f"bits{i} bigint" for i in range(SKETCH_WORDS)), start)


def _all_keys(content: DataFrame, percent: int) -> DataFrame:
    """(key, sid, least) with the words of all non-empty blocks of the candidates, from their stored sets."""
    import pyarrow as pa

    schema = pa.schema([("key", pa.int64()), ("sid", pa.int64()), ("least", pa.int32())])

    def run(batches):
        for batch in batches:
            sids, lists = batch.column(0).to_numpy(), batch.column(1)
            for low in range(0, batch.num_rows, 512):
                made = [keys(lists[i].values.to_numpy().view(np.uint64), percent, float(BAND)) for i in range(low, min(low + 512, batch.num_rows))]
                counts = [len(k) for k, _ in made]
                columns = [np.concatenate([k for k, _ in made]).view(np.int64), np.repeat(sids[low : low + len(made)], counts), np.repeat(np.array([x for _, x in made], np.int32), counts)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    return content.select("sid", "shingles").mapInArrow(run, "key bigint, sid bigint, least int")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, sid): documents with equal sets share ``sid``; without shingles it is null."""
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    return map_text(own, "text", ["doc_id"], "n_shingles bigint, sid bigint", lambda: _describe(width))


def _shared(emitted: DataFrame) -> DataFrame:
    """The emitted (key, sid, least) rows, once each, whose key several classes have; ``low`` is the smallest of these.

    Equal sets are one class and emit once, so a key's rows in a task's sorted, spilling window are distinct documents'."""
    by_key = Window.partitionBy("key")
    found = emitted.withColumns({"low": F.min("sid").over(by_key), "high": F.max("sid").over(by_key)}).where("low <> high")
    return found.drop("high").dropDuplicates(["key", "sid"])


def _enough(shared: DataFrame) -> DataFrame:
    """(sid, least) of the classes with as many shared keys as any link would show."""
    own = shared.groupBy("sid").agg(F.count(F.lit(1)).alias("n_keys"), F.min("least").alias("least"))
    return own.where("n_keys >= least").drop("n_keys")


def linked(docs: DataFrame, described: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT, surplus: float = SURPLUS) -> DataFrame:
    """(node, component) over the classes that link with another."""
    spark = docs.sparkSession
    enough = stored(_enough(_shared(_emit(docs, text, width, percent, surplus))), "enough")
    free_shuffles(spark)
    chosen = described.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"))
    chosen = stored(chosen.join(broadcast_if_small(enough, 48), "sid"), "candidates")
    one = docs.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text")).join(broadcast_if_small(chosen.select("doc_id", "sid"), 64), "doc_id")
    content = stored(_contents(one, "text", width).dropDuplicates(["sid"]).join(chosen.select("sid", "n"), "sid"), "shingles")
    drop_stored(enough, chosen)

    every = stored(_shared(_all_keys(content, percent)).drop("low"), "all-keys")
    free_shuffles(spark)
    by_key = Window.partitionBy("key")
    again = _shared(every.drop("least").join(_enough(every), "sid").select("key", "sid", "least"))
    shared = stored(again.withColumn("size", F.count(F.lit(1)).over(by_key)).drop("low"), "kept-keys")
    drop_stored(every)
    free_shuffles(spark)
    own = _enough(shared)
    by_sid = Window.partitionBy("sid").orderBy(F.desc("size"), F.desc("key"))
    rare = shared.drop("least").join(own, "sid").withColumn("rank", F.row_number().over(by_sid)).where("rank >= least")
    probed = _shared(rare.select("key", "sid", F.lit(0).alias("least"))).withColumn("n", F.count(F.lit(1)).over(by_key))
    probed = stored(probed.select("key", F.col("sid").alias("item"), "low", "n"), "probed-keys")
    drop_stored(shared)
    free_shuffles(spark)

    def verified(pairs: DataFrame) -> DataFrame:
        left = content.select(F.col("sid").alias("a"), F.col("shingles").alias("sa"))
        right = content.select(F.col("sid").alias("b"), F.col("shingles").alias("sb"))
        both = pairs.join(left, "a").join(right, "b")
        common = F.size(F.array_intersect("sa", "sb"))
        union = F.size("sa") + F.size("sb") - common
        return both.where(common.cast("long") * 100 >= union.cast("long") * percent).select("a", "b")

    def plausible(x, y):
        differing = sum((F.bit_count(x(f"bits{i}").bitwiseXOR(y(f"bits{i}"))) for i in range(SKETCH_WORDS)), F.lit(0))
        sizes = F.least(x("n"), y("n")) * 100 >= F.greatest(x("n"), y("n")) * percent
        return sizes & (differing * (100 + percent) <= (x("n") + y("n")) * (100 - percent))

    facts = content.drop("shingles").withColumnRenamed("sid", "item")
    joined = cluster_by_keys(probed, verified, facts, plausible)
    drop_stored(probed, content)
    free_shuffles(spark)
    return joined


def join(docs: DataFrame, id_col: str = "doc_id", text: str = "text", width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document; component_id is the smallest doc_id reachable by links."""
    described = stored(classes(docs, id_col, text, width), "classes")
    joined = linked(docs, described, id_col, text, width, percent)
    per_class = described.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("least"))
    named = per_class.join(joined.withColumnRenamed("node", "sid"), "sid", "left").withColumn("component", F.coalesce("component", "sid"))
    smallest = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_class = named.join(smallest, "component").select("sid", "component_id")
    return described.join(by_class, "sid", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def brute_force(docs: list[tuple], width: int = WIDTH, percent: int = PERCENT) -> list[tuple]:
    """The same by comparing all pairs, for tests."""
    import re

    def shingles(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        w = re.findall("[^\x20\x09-\x0d]+", low)
        return {tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set()

    made = [(doc, shingles(text)) for doc, text in docs]
    root = {doc: doc for doc, _ in made}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (a, s) in enumerate(made):
        for b, t in made[:i]:
            if s and t and 100 * min(len(s), len(t)) >= percent * max(len(s), len(t)) and 100 * len(s & t) >= percent * len(s | t):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return [(doc, len(s), find(doc)) for doc, s in made]
