"""Vector code compression: product codes whose codebooks come from Lloyd's rounds with the filtering algorithm.

Vectors of floats become integers, ``floor(scale * x)``, and are cut into equal consecutive parts, each with a codebook of
its own. ``trees`` cuts the vectors of a partition into chunks of bounded size and builds a kd-tree for each part of a
chunk once: nodes hold their bounding box, the sums of their points and how many they are. Every round then walks the
trees from their roots with a codebook in hand. A node's entries are those that may be nearest to a point of its box; an
entry goes when the entry nearest to the box's middle is nearer at the box's corner that favours the other most. A node
with one entry left is assigned as a whole, from its sums; leaves that keep several compare their points. Nodes of a level
are walked side by side in numpy. All is integer arithmetic, so the result is that of plain rounds, ties included.

A task gives one row of sums for each entry, which Spark adds up: what goes to the driver is the codebooks alone. The
trees are a written table, so lost executors cost a chunk's walk. Equal vectors, however many, end in one node.

Defined results: rows whose vector is null or holds null, NaN or infinite components go. So do vectors of another length
than the most frequent one (the longer, if several are), which have no such parts; a length that the parts don't divide is
filled up with zeros. With fewer vectors than entries the codebooks are smaller; no vector gives no rows. Rows that repeat
an id are rows of their own; null ids come last. An unused entry stays. Components of 65,536 or more, in either direction,
are an error, as sums and squares must stay exact. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._common import drop_stored, ship, stored

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256
#: Vectors of a chunk, and points up to which a node stays a leaf.
CHUNK = 8192
LEAF = 16
#: Integers are below this, so that squared distances and sums of a chunk are exact.
MOST = 1 << 24
#: Numbers in one step of a walk.
STEP = 1 << 22


class Tree:
    """A kd-tree over the points of one part: ``order`` puts them so that each node is a range [low, high)."""

    def __init__(self, order, points, low, high, child, least, most, sums):
        self.order, self.points, self.low, self.high, self.child, self.least, self.most, self.sums = order, points, low, high, child, least, most, sums

    @staticmethod
    def build(points: np.ndarray, leaf: int = LEAF) -> Tree:
        n = len(points)
        order, low, high = np.arange(n), np.array([0]), np.array([n])
        levels, count = [], 0
        while len(low):
            own = points[order]
            starts = low
            # the nodes of a level may leave gaps, where leaves ended: a bound at each end keeps them apart
            cuts = np.stack([starts, high], axis=1).ravel()
            last = cuts[-1] == n
            cuts = cuts[:-1] if last else cuts
            least, most, sums = (f.reduceat(own, cuts, axis=0)[::2] for f in (np.minimum, np.maximum, np.add))
            split = (high - low > leaf) & (most > least).any(axis=1)
            child = np.full(len(low), -1)
            child[split] = count + len(low) + 2 * np.arange(split.sum())
            levels.append((low, high, child, least, most, sums))
            count += len(low)
            a, z = low[split], high[split]
            if not len(a):
                break
            widest = np.argmax((most - least)[split], axis=1)
            size = z - a
            node = np.repeat(np.arange(len(a)), size)
            at = np.repeat(a - (np.cumsum(size) - size), size) + np.arange(size.sum())
            value = own[at, widest[node]]
            order[at] = order[at[np.lexsort((value, node))]]
            middle = a + size // 2
            low, high = np.stack([a, middle], axis=1).ravel(), np.stack([middle, z], axis=1).ravel()
        return Tree(order, points[order], *(np.concatenate(x) for x in zip(*levels)))

    def dump(self) -> bytes:
        n, w = self.points.shape
        head = np.array([n, w, len(self.low)], dtype="<i4")
        return b"".join([head.tobytes(), *[x.astype("<i4").tobytes() for x in (self.order, self.points, self.low, self.high, self.child, self.least, self.most)], self.sums.astype("<i8").tobytes()])

    @staticmethod
    def load(raw: bytes) -> Tree:
        n, w, m = np.frombuffer(raw, "<i4", 3).tolist()
        at, out = 12, []
        for shape in ((n,), (n, w), (m,), (m,), (m,), (m, w), (m, w)):
            size = int(np.prod(shape))
            out.append(np.frombuffer(raw, "<i4", size, at).astype(np.int64).reshape(shape))
            at += 4 * size
        return Tree(*out, np.frombuffer(raw, "<i8", m * w, at).reshape(m, w))

    def walk(self, codebook: np.ndarray, whole, few) -> None:
        """``whole(nodes, entries)`` for nodes that keep one entry, ``few(points, entries)`` for points of other leaves."""
        k, w = codebook.shape
        norm = (codebook**2).sum(axis=1)
        most = max(1, STEP // (k * w))
        pending = [(np.array([0]), np.ones((1, k), dtype=bool))]
        while pending:
            nodes, open_ = pending.pop()
            if len(nodes) > most:
                pending += [(nodes[i : i + most], open_[i : i + most]) for i in range(0, len(nodes), most)]
                continue
            least, top = self.least[nodes], self.most[nodes]
            middle = ((2 * codebook[None] - (least + top)[:, None]) ** 2).sum(axis=2)
            best = np.argmin(np.where(open_, middle, np.iinfo(np.int64).max), axis=1)
            to = codebook[None] - codebook[best][:, None]
            lead = norm[None] - norm[best][:, None] - 2 * np.maximum(to * top[:, None], to * least[:, None]).sum(axis=2)
            open_ &= ~((lead > 0) | (lead == 0) & (np.arange(k)[None] > best[:, None]))
            one = open_.sum(axis=1) == 1
            if one.any():
                whole(nodes[one], best[one])
            child = self.child[nodes]
            leaf = ~one & (child < 0)
            if leaf.any():
                self._compare(nodes[leaf], open_[leaf], codebook, few)
            down = ~one & (child >= 0)
            if down.any():
                pending.append(((child[down][:, None] + np.arange(2)).ravel(), np.repeat(open_[down], 2, axis=0)))

    def _compare(self, nodes, open_, codebook, few):
        size = self.high[nodes] - self.low[nodes]
        at = np.repeat(self.low[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())
        own = np.repeat(np.arange(len(nodes)), size)
        step = max(1, STEP // codebook.size)
        for i in range(0, len(at), step):
            points = self.points[at[i : i + step]]
            distance = ((points[:, None] - codebook[None]) ** 2).sum(axis=2)
            few(at[i : i + step], np.argmin(np.where(open_[own[i : i + step]], distance, np.iinfo(np.int64).max), axis=1))

    def totals(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums and counts of the points nearest to each entry."""
        sums, counts = np.zeros(codebook.shape, np.int64), np.zeros(len(codebook), np.int64)

        def whole(nodes, entries):
            np.add.at(sums, entries, self.sums[nodes])
            np.add.at(counts, entries, self.high[nodes] - self.low[nodes])

        def few(at, entries):
            np.add.at(sums, entries, self.points[at])
            np.add.at(counts, entries, 1)

        self.walk(codebook, whole, few)
        return sums, counts

    def codes(self, codebook: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each point, in the order the tree was built from, and the squared distance to it."""
        found = np.zeros(len(self.points), np.int64)

        def whole(nodes, entries):
            size = self.high[nodes] - self.low[nodes]
            found[np.repeat(self.low[nodes] - (np.cumsum(size) - size), size) + np.arange(size.sum())] = np.repeat(entries, size)

        def few(at, entries):
            found[at] = entries

        self.walk(codebook, whole, few)
        out, error = np.zeros_like(found), np.zeros_like(found)
        out[self.order], error[self.order] = found, ((self.points - codebook[found]) ** 2).sum(axis=1)
        return out, error


def integers(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, scale: int = SCALE) -> tuple[DataFrame, int]:
    """(id, label, v) of the kept rows, v as integers, and the width of a part."""
    own = vectors.select(F.col(id_col).alias("id"), F.col(label).alias("label"), F.col(vector).cast("array<double>").alias("v")).where(F.col("v").isNotNull())
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    own = own.where(~F.coalesce(bad, F.lit(True)))
    row = own.groupBy(F.size("v").alias("n")).count().where("n > 0").orderBy(F.desc("count"), F.desc("n")).first()
    width = -(-row["n"] // parts) if row else 1
    size = row["n"] if row else 1
    error = F.raise_error(F.lit("a component of a vector is too large")).cast("bigint")
    filled = F.concat("v", F.array_repeat(F.lit(0.0), parts * width - size))
    whole = F.transform(filled, lambda x: F.when(F.abs(x) * scale < MOST, F.floor(x * scale)).otherwise(error))
    return own.where(F.size("v") == size).select("id", "label", whole.alias("v")), width


def trees(kept: DataFrame, parts: int = PARTS, chunk: int = CHUNK) -> DataFrame:
    """A row for each chunk of at most ``chunk`` vectors: arrays of its ids and labels, and a tree for each part."""
    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_type

    ship(kept.sparkSession)
    kinds = [kept.schema[c].dataType for c in ("id", "label")]
    schema = pa.schema([("ids", pa.list_(to_arrow_type(kinds[0]))), ("labels", pa.list_(to_arrow_type(kinds[1]))), ("trees", pa.list_(pa.binary()))])

    def rows(batches):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, labels, vectors = (table.column(c).chunk(0) for c in range(3))
        points = vectors.flatten().to_numpy().reshape(len(vectors), parts, -1)
        made = [Tree.build(np.ascontiguousarray(points[:, p])).dump() for p in range(parts)]
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.RecordBatch.from_arrays([one(ids).cast(schema.field(0).type), one(labels).cast(schema.field(1).type), pa.array([made], schema.field(2).type)], schema=schema)

    def run(batches):
        held, n = [], 0
        for batch in batches:
            while batch.num_rows:
                part = batch.slice(0, chunk - n)
                batch = batch.slice(part.num_rows)
                held.append(part)
                n += part.num_rows
                if n == chunk:
                    yield rows(held)
                    held, n = [], 0
        if n:
            yield rows(held)

    return kept.mapInArrow(run, f"ids array<{kinds[0].simpleString()}>, labels array<{kinds[1].simpleString()}>, trees array<binary>")


def first_codebooks(kept: DataFrame, parts: int, entries: int, width: int) -> np.ndarray:
    """(part, entry, position): the parts of the vectors with the smallest ids."""
    rows = kept.orderBy(F.col("id").asc_nulls_last(), "v").limit(entries).collect()
    return np.array([r["v"] for r in rows], dtype=np.int64).reshape(len(rows), parts, width).transpose(1, 0, 2).copy()


def improved(built: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks after a round: means of the parts nearest to each entry, rounded down; unused entries stay."""
    import pyarrow as pa

    parts, entries, width = codebooks.shape

    def run(batches):
        sums, counts = np.zeros(codebooks.shape, np.int64), np.zeros((parts, entries), np.int64)
        for batch in batches:
            for one in batch.column(0):
                for p, raw in enumerate(one.values):
                    s, c = Tree.load(raw.as_buffer()).totals(codebooks[p])
                    sums[p] += s
                    counts[p] += c
        part, entry = np.nonzero(counts)
        columns = [part, entry, counts[part, entry], *sums[part, entry].T]
        yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["part", "entry", "n", *[f"s{i}" for i in range(width)]])

    sums = [f"s{i}" for i in range(width)]
    made = built.select("trees").mapInArrow(run, ", ".join(f"{c} bigint" for c in ("part", "entry", "n", *sums)))
    out = codebooks.copy()
    for r in made.groupBy("part", "entry").agg(*[F.sum(c).alias(c) for c in ("n", *sums)]).collect():  # a row for each entry
        out[r["part"], r["entry"]] = [r[c] // r["n"] for c in sums]
    return out


def encoded(built: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(id, label, code, error) of every vector: entries in part order, two hex digits each, and its squared distance."""
    import pyarrow as pa

    ids, labels = (built.schema[c].dataType.elementType.simpleString() for c in ("ids", "labels"))
    parts = len(codebooks)
    digits = np.frombuffer(b"".join(b"%02x" % i for i in range(256)), dtype="S2")

    def run(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                found = [Tree.load(raw.as_buffer()).codes(codebooks[p]) for p, raw in enumerate(batch.column(2)[row].values)]
                text = digits[np.stack([c for c, _ in found], axis=1)].tobytes().decode()
                code = [text[i : i + 2 * parts] for i in range(0, len(text), 2 * parts)]
                yield pa.RecordBatch.from_arrays([batch.column(0)[row].values, batch.column(1)[row].values, pa.array(code), pa.array(sum(e for _, e in found))], ["id", "label", "code", "error"])

    return built.select("ids", "labels", "trees").mapInArrow(run, f"id {ids}, label {labels}, code string, error bigint")


def digest(codebooks: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()


def compress(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, chunk: int = CHUNK) -> tuple[DataFrame, np.ndarray]:
    """(id, label, code, error) of the kept vectors, and the codebooks as integers (part, entry, position)."""
    if not 1 <= entries <= 256:
        raise ValueError("codes have two hex digits: 1 to 256 entries")
    kept, width = integers(vectors, id_col, vector, label, parts, scale)
    codebooks = first_codebooks(kept, parts, entries, width)
    built = stored(trees(kept, parts, chunk), "trees")
    if codebooks.shape[1]:
        for _ in range(rounds):
            codebooks = improved(built, codebooks)
    return encoded(built, codebooks), codebooks


def codes(vectors: DataFrame, id_col: str = "vec_id", vector: str = "embedding", label: str = "label", **more) -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): ``label_error`` sums the errors of equal labels."""
    made, codebooks = compress(vectors, id_col, vector, label, **more)
    made = stored(made, "codes")
    sums = made.groupBy(F.col("label").alias("name")).agg(F.sum("error").alias("label_error"))
    sums = stored(sums, "label-errors")
    most = sums.agg(F.count(F.lit(1)), F.sum(F.length(F.col("name").cast("string")))).first()
    side = F.broadcast(sums) if most[0] * 32 + (most[1] or 0) <= 64 << 20 else sums
    both = made.join(side, F.col("label").eqNullSafe(F.col("name")))
    return both.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(codebooks)).alias("codebooks_sha256"))


def decode(code: str, codebooks: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """The vector that a code stands for."""
    return np.concatenate([codebooks[p, int(code[2 * p : 2 * p + 2], 16)] for p in range(len(codebooks))]) / scale


def brute_force(rows: list[tuple], parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> list[tuple]:
    """(vec_id, code, error, label_error, codebooks_sha256) of (vec_id, vector, label) rows by plain rounds, for tests."""
    import math

    kept = [(i, [math.floor(scale * x) for x in v], y) for i, v, y in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * w : p * w + w]
    books = [[cut(v, p) for _, v, _ in kept[:entries]] for p in range(parts)]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v: [min(range(len(books[p])), key=lambda e: (far(cut(v, p), books[p][e]), e)) for p in range(parts)]
    for _ in range(rounds):
        found = [near(v) for _, v, _ in kept]
        books = [[[sum(x) // len(own) for x in zip(*own)] if (own := [cut(v, p) for (_, v, _), f in zip(kept, found) if f[p] == e]) else books[p][e] for e in range(len(books[p]))] for p in range(parts)]
    found = [near(v) for _, v, _ in kept]
    error = [sum(far(cut(v, p), books[p][f[p]]) for p in range(parts)) for (_, v, _), f in zip(kept, found)]
    total: dict = {}
    for (_, _, y), e in zip(kept, error):
        total[y] = total.get(y, 0) + e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return [(i, "".join(f"{e:02x}" for e in f), e, total[y], sha) for (i, _, y), f, e in zip(kept, found, error)]


def _sql(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    distance = "list_sum(list_transform(list_zip(p.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"near{k} as materialized (select p.row, p.part, min({distance} * {entries} + c.entry) as best from points p join book{k} c on p.part = c.part group by p.row, p.part)")
        if k < rounds:
            steps.append(
                f"""sums{k} as (select n.part, n.best % {entries} as entry, u.pos, cast(sum(p.v[u.pos]) as bigint) as s, count(*) as c
  from near{k} n join points p on n.row = p.row and n.part = p.part, (select unnest(range(1, (select max(len(v)) from points) + 1)) as pos) u group by all),
book{k + 1} as materialized (select b.part, b.entry, coalesce(m.v, b.v) as v from book{k} b left join
  (select part, entry, list((s - ((s % c) + c) % c) // c order by pos) as v from sums{k} group by part, entry) m on b.part = m.part and b.entry = m.entry)"""
            )
    whole = ",\n".join(steps)
    return f"""
with kept as materialized (
  select row_number() over (order by vec_id nulls last) - 1 as row, vec_id, label, list_transform(embedding, lambda x: cast(floor({scale} * cast(x as double)) as bigint)) as v
  from embeddings where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), points as materialized (
  select row, part, list_slice(v, part * (len(v) // {parts}) + 1, (part + 1) * (len(v) // {parts})) as v from kept, (select unnest(range({parts})) as part)
), book0 as materialized (select part, row as entry, v from points where row < {entries}),
{whole}, coded as materialized (
  select row, string_agg(lpad(to_hex(best % {entries}), 2, '0'), '' order by part) as code, cast(sum(best // {entries}) as bigint) as error from near{rounds} group by row
), sha as (select sha256(string_agg(array_to_string(v, ','), ',' order by part, entry)) as codebooks_sha256 from book{rounds})
select vec_id, lower(code) as code, error, cast(sum(error) over (partition by label) as bigint) as label_error, (select codebooks_sha256 from sha) as codebooks_sha256
from kept join coded using (row)
"""


SQL = _sql()
