"""Ranked lexical search over inverted treaps: the highest-scoring documents of every item.

Terms are runs of letters, digits and everything beyond ASCII, with A-Z lower-cased. Scores add up integer impacts, in
which a term's weight depends on how many documents have it and its frequency counts less in long documents.

1. *Postings.* Each task counts its documents' terms, as far as items ask for them, and writes shards: ids in ascending
   order and, by term, the documents that have it with frequencies. A shard ends at ``shard_postings``, so its treaps fit
   into a task's memory. Documents, terms and document frequencies are summed by Spark.
2. *Treaps.* With these statistics a posting has its impact, and the postings of a term in a shard are a treap: search
   order by document, heap order by impact.
3. *Traversal.* An item walks the treaps of all its terms at once. An interval of documents has for each term the root of
   what lies in it, that is, the largest impact there; if these sum to less than the k-th best score so far, the interval
   goes. Otherwise the document of the largest root is scored and parts the interval. Many intervals go side by side.
4. *Merge.* A task keeps its k best of an item across its shards. A sixteenth of the shards goes first; the k-th best
   scores found there are floors for the others, which so return little, however many tasks there are. Spark ranks what
   is left. No floor or bound loses a document, as the k-th best of some documents is never above that of all.

Items go to the tasks in passes of at most ``pass_bytes`` of text. Terms are told apart by 64 bits of their bytes' hash.

Defined results: a null text has no terms, neither as a document nor as an item; such an item, or one whose terms occur
nowhere or everywhere, has no rows. Rows of one item id are one item with the terms of all; items without an id too.
Documents that repeat an id are documents of their own; those without an id come last among equal scores. Extra columns
are ignored. Empty tables give no rows.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from . import _text
from ._common import drop_stored, ship, stored

BEST = 50
SHARD_POSTINGS = 1 << 20
PASS_BYTES = 8 << 20
#: One shard in so many gives the floors for the others.
FIRST = 16
#: Intervals and cells (intervals by terms) that go side by side, and cells from which on the newest go first.
INTERVALS, CELLS, MANY_CELLS = 512, 1 << 18, 1 << 24


class Treaps:
    """The treaps of a shard's terms; a node is a posting, its document a number in the shard's order of ids."""

    def __init__(self, terms: np.ndarray, counts: np.ndarray, doc: np.ndarray, impact: np.ndarray):
        self.terms, self.doc, self.impact = terms, doc, impact
        n, ends = len(doc), np.cumsum(counts)
        prev, after = np.arange(-1, n - 1), np.arange(1, n + 1)
        prev[ends - counts] = -1
        after[ends - 1] = -1
        live = np.flatnonzero(prev >= 0)
        while len(live := live[impact[prev[live]] < impact[live]]):  # the nearest before that is not smaller
            prev[live] = prev[prev[live]]
            live = live[prev[live] >= 0]
        live = np.flatnonzero(after >= 0)
        while len(live := live[impact[after[live]] <= impact[live]]):  # the nearest behind that is larger
            after[live] = after[after[live]]
            live = live[after[live] >= 0]
        below = (prev >= 0) & ((after < 0) | (impact[prev] < impact[after]))
        above = ~below & (after >= 0)
        self.left, self.right = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
        self.right[prev[below]] = np.flatnonzero(below)
        self.left[after[above]] = np.flatnonzero(above)
        self.root = np.flatnonzero(~below & ~above).astype(np.int32)  # one for each term, in their order

    def roots(self, terms: np.ndarray) -> np.ndarray:
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return self.root[at[self.terms[at] == terms]]

    def _inside(self, nodes: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """The roots of what lies in [low, high) below nodes (interval, term)."""
        v = nodes.ravel().copy()
        low, high = (np.broadcast_to(x[:, None], nodes.shape).ravel() for x in (low, high))
        live = np.flatnonzero(v >= 0)
        while len(live):
            at = v[live]
            d = self.doc[at]
            less, more = d < low[live], d >= high[live]
            off = less | more
            live, at = live[off], at[off]
            v[live] = np.where(less[off], self.right[at], self.left[at])
            live = live[v[live] >= 0]
        return v.reshape(nodes.shape)

    def _scores(self, nodes: np.ndarray, docs: np.ndarray) -> np.ndarray:
        """The sums of the impacts of a document for each interval."""
        v, want = nodes.ravel().copy(), np.broadcast_to(docs[:, None], nodes.shape).ravel()
        out = np.zeros(len(v), np.int64)
        live = np.flatnonzero(v >= 0)
        while len(live):
            at = v[live]
            d = self.doc[at]
            hit = d == want[live]
            out[live[hit]] = self.impact[at[hit]]
            live, at, d = live[~hit], at[~hit], d[~hit]
            v[live] = np.where(d < want[live], self.right[at], self.left[at])
            live = live[v[live] >= 0]
        return out.reshape(nodes.shape).sum(axis=1)

    def best(self, terms: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores, of ``floor`` or more, of the k best by score, then by document."""
        docs, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
        roots = self.roots(terms)
        if not len(roots):
            return docs, scores
        top = int(self.doc.max()) + 1
        # chunks of intervals: largest sum, sums, bounds of documents, roots by term
        sums = np.array([int(self.impact[roots].sum())])
        pending = [(int(sums[0]), sums, np.array([0]), np.array([top]), roots[None])]
        while pending:
            many = sum(p[4].size for p in pending) > MANY_CELLS
            _, sums, low, high, nodes = pending.pop(-1 if many else max(range(len(pending)), key=lambda i: pending[i][0]))
            keep = sums >= floor
            if not keep.any():
                continue
            sums, low, high, nodes = sums[keep], low[keep], high[keep], nodes[keep]
            nodes = nodes[:, (nodes >= 0).any(axis=0)]
            most = max(1, min(INTERVALS, CELLS // nodes.shape[1]))
            if len(sums) > most:
                order = np.argsort(sums, kind="stable")
                rest, order = order[:-most], order[-most:]
                pending.append((int(sums[rest[-1]]), sums[rest], low[rest], high[rest], nodes[rest]))
                low, high, nodes = low[order], high[order], nodes[order]
            impacts = np.where(nodes >= 0, self.impact[nodes], -1)
            pivot = self.doc[nodes[np.arange(len(nodes)), impacts.argmax(axis=1)]].astype(np.int64)
            docs, scores = np.concatenate([docs, pivot]), np.concatenate([scores, self._scores(nodes, pivot)])
            order = np.lexsort((docs, -scores))[:k]
            docs, scores = docs[order], scores[order]
            if len(docs) == k:
                floor = max(floor, int(scores[-1]))
            low, high = np.concatenate([low, pivot + 1]), np.concatenate([pivot, high])
            nodes = self._inside(np.concatenate([nodes, nodes]), low, high)
            sums = np.where(nodes >= 0, self.impact[nodes], 0).sum(axis=1)
            keep = (sums >= floor) & (nodes >= 0).any(axis=1)
            if keep.any():
                pending.append((int(sums[keep].max()), sums[keep], low[keep], high[keep], nodes[keep]))
        keep = scores >= floor
        return docs[keep], scores[keep]


class Items:
    """The items of a pass: ids, distinct terms as sorted hashes, and the numbers of each item's terms."""

    def __init__(self, rows: list[tuple]):
        texts = [(text or "").encode("utf-8", "surrogatepass") for _, text in rows]
        flat = _text.LOWER[np.frombuffer(b"".join(texts), dtype=np.uint8)]
        offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
        starts, ends, bound = _text.spans(flat, offsets, _text.ALNUM_OR_HIGH)
        number = {item: k for k, item in enumerate(dict.fromkeys(item for item, _ in rows))}
        owner = np.repeat(np.array([number[item] for item, _ in rows], dtype=np.int64), np.diff(bound))
        self.ids = list(number)
        self.hashes, which = np.unique(_text.span_hashes(flat, starts, ends), return_inverse=True)
        both = np.unique(owner * (len(self.hashes) + 1) + which)
        owner, self.of = both // (len(self.hashes) + 1), both % (len(self.hashes) + 1)
        self.bound = np.searchsorted(owner, np.arange(len(self.ids) + 1))

    def terms(self, item: int) -> np.ndarray:
        return self.of[self.bound[item] : self.bound[item + 1]]


def postings(docs: DataFrame, sent, id_col: str = "doc_id", text: str = "text", shard_postings: int = SHARD_POSTINGS) -> DataFrame:
    """Shards of the documents' postings for the terms of the broadcast ``Items``.

    (shard, n_docs, n_terms, ids, lengths, terms, counts, doc, tf): documents with terms and their terms with repeats; the
    ids with postings, ascending, and their lengths; terms with their numbers of postings, and these, by term and document."""
    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql.pandas.types import to_arrow_type

    ship(docs.sparkSession)
    kind = docs.schema[id_col].dataType
    schema = pa.schema([("n_docs", pa.int64()), ("n_terms", pa.int64()), ("ids", pa.list_(to_arrow_type(kind))), ("lengths", pa.binary()), ("terms", pa.list_(pa.int32())), ("counts", pa.list_(pa.int32())), ("doc", pa.binary()), ("tf", pa.binary())])

    def run(batches):
        hashes = sent.value.hashes
        width = max(1, len(hashes))
        held, n_docs, n_terms, total = [], 0, 0, 0

        def shard():
            ids = pa.concat_arrays([h[0] for h in held]) if held else pa.array([], schema.field(2).type.value_type)
            lengths, doc, term, tf = (np.concatenate([h[k] for h in held]) if held else np.zeros(0, np.int64) for k in range(1, 5))
            if held:
                doc = doc + np.repeat(np.cumsum([0, *[len(h[0]) for h in held[:-1]]]), [len(h[2]) for h in held])
            order = pc.sort_indices(ids, null_placement="at_end").to_numpy().astype(np.int64)
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            doc = place[doc]
            by = np.lexsort((doc, term))
            terms, counts = np.unique(term, return_counts=True)
            columns = [[n_docs], [n_terms], [ids.take(pa.array(order))], [lengths[order].astype("<i8").tobytes()], [terms.astype(np.int32)], [counts.astype(np.int32)], [doc[by].astype("<i4").tobytes()], [tf[by].astype("<i4").tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

        for batch in batches:
            for part, flat, offsets in _text.steps(batch, "text"):
                flat = _text.LOWER[flat]
                starts, ends, bound = _text.spans(flat, offsets, _text.ALNUM_OR_HIGH)
                n = np.diff(bound)
                n_docs, n_terms = n_docs + int((n > 0).sum()), n_terms + int(n.sum())
                if not len(starts) or not len(hashes):
                    continue
                own = _text.span_hashes(flat, starts, ends)
                at = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                known = hashes[at] == own
                both, tf = np.unique(np.repeat(np.arange(len(n)), n)[known] * width + at[known], return_counts=True)
                if not len(both):
                    continue
                docs_of, doc = np.unique(both // width, return_inverse=True)
                held.append((part.column(0).take(pa.array(docs_of)), n[docs_of], doc, both % width, tf))
                total += len(both)
                if total >= shard_postings:
                    yield shard()
                    held, n_docs, n_terms, total = [], 0, 0, 0
        yield shard()

    ddl = f"n_docs bigint, n_terms bigint, ids array<{kind.simpleString()}>, lengths binary, terms array<int>, counts array<int>, doc binary, tf binary"
    made = docs.select(F.col(id_col).alias("id"), F.col(text).alias("text")).mapInArrow(run, ddl)
    return made.withColumn("shard", F.monotonically_increasing_id())


def weights(df: np.ndarray, n: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], dtype=np.int64)


def _walked(shards: DataFrame, sent, weight, n_docs: int, n_terms: int, floors, k: int, item_type) -> DataFrame:
    """(item_id, doc_id, score): the k best of each item in each task, of the item's floor or more."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    kind = shards.schema["ids"].dataType.elementType
    schema = pa.schema([("item_id", to_arrow_type(item_type)), ("doc_id", to_arrow_type(kind)), ("score", pa.int64())])

    def run(batches):
        items, weight_of, floor = sent.value, weight.value, floors.value
        found: list[list] = [[] for _ in items.ids]
        for batch in batches:
            ids, lengths, terms, counts, doc, tf = (batch.column(c) for c in range(6))
            for row in range(batch.num_rows):
                own, size = terms[row].values.to_numpy(), counts[row].values.to_numpy().astype(np.int64)
                if not len(own):
                    continue
                at = np.frombuffer(doc[row].as_buffer(), "<i4")
                times = np.frombuffer(tf[row].as_buffer(), "<i4").astype(np.int64)
                m = 50 + 50 * np.frombuffer(lengths[row].as_buffer(), "<i8") * n_docs // n_terms
                impact = np.repeat(weight_of[own], size) * (1_000_000_000 * times // (1000 * times + 20 * m[at]))
                treaps = Treaps(own, size, at, impact)
                names = ids[row].values
                for i, old in enumerate(found):
                    least = max(int(floor[i]), old[-1][0] if len(old) == k else 1)
                    docs, scores = treaps.best(items.terms(i), k, least)
                    if len(docs):
                        new = list(zip(scores.tolist(), names.take(pa.array(docs)).to_pylist()))
                        found[i] = sorted(old + new, key=lambda x: (-x[0], x[1] is None, x[1] if x[1] is not None else 0))[:k]
        for i in range(0, len(found), 256):
            rows = [(items.ids[j], doc_id, score) for j in range(i, min(i + 256, len(found))) for score, doc_id in found[j]]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return shards.select("ids", "lengths", "terms", "counts", "doc", "tf").mapInArrow(run, f"item_id {item_type.simpleString()}, doc_id {kind.simpleString()}, score bigint")


def _ranked(found: DataFrame, k: int) -> DataFrame:
    best = Window.partitionBy("item_id").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = BEST, id_col: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", shard_postings: int = SHARD_POSTINGS, pass_bytes: int = PASS_BYTES, first: int = FIRST) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` highest-scoring documents of each item, equal scores by ascending id."""
    spark = docs.sparkSession
    named = items.select(F.col(item).alias("item"), F.col(item_text).alias("words"))
    item_type = named.schema["item"].dataType
    passes = max(1, -(-(named.agg(F.sum(F.octet_length("words"))).first()[0] or 0) // pass_bytes))
    out = None
    for p in range(passes):
        own = named if passes == 1 else named.where(F.pmod(F.xxhash64("item"), F.lit(passes)) == p)
        asked = Items([tuple(r) for r in own.collect()])  # at most about pass_bytes
        sent = spark.sparkContext.broadcast(asked)
        shards = stored(postings(docs, sent, id_col, text, shard_postings), "postings")
        n_docs, n_terms = (x or 0 for x in shards.agg(F.sum("n_docs"), F.sum("n_terms")).first())
        df = np.zeros(len(asked.hashes), np.int64)
        each = shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("x")).groupBy("x.terms").agg(F.sum("x.counts").alias("df")).toArrow()  # a row for each term of the items
        df[each.column(0).to_numpy()] = each.column(1).to_numpy()
        weight = spark.sparkContext.broadcast(weights(df, n_docs))

        def walked(part: DataFrame, floor: np.ndarray) -> DataFrame:
            floors = spark.sparkContext.broadcast(floor)
            return stored(_walked(part, sent, weight, n_docs, max(1, n_terms), floors, k, item_type), "found")

        early = F.pmod(F.xxhash64("shard"), F.lit(first)) == 0
        floor = np.ones(len(asked.ids), np.int64)
        some = walked(shards.where(early), floor)
        number = {x: i for i, x in enumerate(asked.ids)}
        for r in _ranked(some, k).where(F.col("rank") == k).collect():  # a row for each item
            floor[number[r["item_id"]]] = r["score"]
        rest = walked(shards.where(~early), floor)
        drop_stored(shards)
        best = stored(_ranked(some.unionByName(rest), k).select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score"), "ranked")
        drop_stored(some, rest)
        out = best if out is None else out.unionByName(best)
    return out


def brute_force(docs: list[tuple], items: list[tuple], k: int = BEST) -> list[tuple]:
    """(item_id, rank, doc_id, score) by plain loops, for tests."""
    import re
    from collections import Counter

    def terms(text):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", low)

    bags = [(doc, Counter(terms(text))) for doc, text in docs]
    n, whole, df = sum(bool(b) for _, b in bags), sum(b.total() for _, b in bags), Counter(t for _, b in bags for t in b)
    asked: dict = {}
    for item, text in items:
        asked.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in asked.items():
        scored = []
        for doc, bag in bags:
            m = 100 - 50 + (50 * bag.total() * n) // whole if whole else 0
            score = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1_000_000_000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in own if t in bag)
            if score > 0:
                scored.append((-score, doc is None, doc if doc is not None else 0, doc))
        out += [(item, i + 1, doc, -score) for i, (score, _, _, doc) in enumerate(sorted(scored)[:k])]
    return out


SQL = r"""
with docs as (
  select row_number() over () as row, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
  from documents
), sizes as materialized (
  select row, doc_id, len(terms) as n from docs where len(terms) > 0
), whole as (
  select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from sizes
), postings as materialized (
  select row, term, count(*) as tf from (select row, unnest(terms) as term from docs) group by row, term
), weights as (
  select term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1))) as bigint) as w from postings, whole group by term, n_docs
), asked as (
  select distinct item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from benchmark
), scored as (
  select a.item_id, p.row, s.doc_id, cast(sum(w.w * ((1000000000 * p.tf) // (1000 * p.tf + 20 * (100 - 50 + (50 * s.n * n_docs) // n_terms)))) as bigint) as score
  from asked a join postings p using (term) join weights w using (term) join sizes s on p.row = s.row, whole
  group by a.item_id, p.row, s.doc_id
), ranked as (
  select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id nulls last) as int) as rank, doc_id, score from scored where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= 50
"""
