"""Mixing sources to target weights in DataFrame operations only.

Every source gets a target number of words, and every document the number of its words that the mix takes:

1. *Targets.* Sources in the order of their names share ``share`` times all words by ``weights``, repeated in that order.
   A target stops at ``most`` times its source's words, and what is over goes to the others by weight until none is
   above. That ends at one level: targets are the smaller of the bound and level times weight, and the level follows from
   prefix sums over the sources in the order in which they reach their bounds.
2. *Keys.* A document's place in its source is the digest of its id, so places are random, equal in every run and do not
   depend on partitions.
3. *Prefix sums.* The keys of a source are cut into ranges of about ``range_rows`` documents. Sums of the ranges give each
   range its start, a window over one range gives each document its own. So a source that holds most rows is many tasks.
4. *Cut.* A source repeats whole epochs while they fit into its target; the last one is cut at the exact word.

Rows with equal id, source and size are counted before they are sorted and stand side by side, so a repeated row is one
row of a range. The join with the sources is a broadcast only where a count proves them few, and a skew join otherwise.

Defined results: null and empty texts have size 0 and give nothing; a source of such texts has target 0. Documents without
a source are a source of their own, the last. A null id has a key like any other. An empty table gives an empty table.
Extra columns are ignored. Texts are read once, for their sizes, and are never shuffled.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._common import broadcast_if_small, drop_stored, stored

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Documents of a source that one task sorts.
RANGE_ROWS = 1 << 13
SEED = "mix:"
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, key, copies): documents with their words and keys, equal rows once."""
    key = F.md5(F.concat(F.lit(seed), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(source).alias("source"), F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(WORD)).cast("long").alias("size"), key.alias("key"))
    return own.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("copies"))


def prefix_sums(rows: DataFrame, order: list[Column], **values: Column) -> tuple[DataFrame, list[DataFrame]]:
    """``rows`` with a column for each of ``values``, its sum over all rows before, in distinct places of ``order``.

    Spark deals the rows out by ranges of ``order``; sums of the partitions, a row each, are added up by themselves.
    Second, the tables to drop when the result has been used."""
    place = F.struct(*order)
    dealt = stored(rows.withColumn("__place", place).repartitionByRange("__place").withColumn("__part", F.spark_partition_id()).withColumns({f"__of_{k}": v for k, v in values.items()}), "ranges")
    before = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    sums = dealt.groupBy("__part").agg(*[F.sum(f"__of_{k}").alias(k) for k in values])  # a row for each partition
    starts = sums.select("__part", *[F.coalesce(F.sum(k).over(before(Window.orderBy("__part"))), F.lit(0)).alias(f"__from_{k}") for k in values])
    within = before(Window.partitionBy("__part").orderBy("__place"))
    own = dealt.withColumns({k: F.coalesce(F.sum(f"__of_{k}").over(within), F.lit(0)) for k in values}).join(F.broadcast(starts), "__part")
    return own.select(*rows.columns, *[(F.col(k) + F.col(f"__from_{k}")).alias(k) for k in values]), [dealt]


def targets(rows: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(source, rows, source_size, target) of the sources of ``sizes`` rows, stored."""
    if min(weights) <= 0 or share > most:
        raise ValueError("weights are positive and the share is no more than the bound of a source")
    found = stored(rows.groupBy("source").agg(F.sum("copies").alias("rows"), F.sum(F.col("size") * F.col("copies")).alias("source_size")), "sources")
    ranked, used = prefix_sums(found, [F.col("source").isNull().alias("none"), F.col("source").alias("name")], place=F.lit(1))
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    weighted = stored(ranked.withColumn("weight", weight.cast("long")), "weights")
    total, whole = weighted.agg(F.sum("source_size"), F.sum("weight")).first()
    # sources reach their bounds in the order of size over weight, here in whole numbers
    scale = math.lcm(*weights)
    level, more = prefix_sums(weighted.withColumn("reach", F.col("source_size") * (F.lit(scale) / F.col("weight")).cast("long")), [F.col("reach"), F.col("place")], full=F.col("source_size"), taken=F.col("weight"))
    level = level.withColumn("level", (F.lit(share * (total or 0)) - F.lit(float(most)) * F.col("full")) / (F.lit(whole or 0) - F.col("taken")))
    open_ = level.where(F.lit(float(most)) * F.col("source_size") > F.col("level") * F.col("weight"))
    row = open_.agg(F.min_by("level", F.struct("reach", "place"))).first()
    bound = F.lit(float(most)) * F.col("source_size")
    target = bound if row[0] is None else F.least(bound, F.lit(float(row[0])) * F.col("weight"))
    out = stored(weighted.select("source", "rows", "source_size", target.alias("target")), "targets")
    drop_stored(found, weighted, *used, *more)
    return out


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, range_rows: int = RANGE_ROWS, seed: str = SEED) -> DataFrame:
    """(doc_id, source, size, source_size, target, taken) of every row of ``docs``."""
    rows = stored(sizes(docs, id_col, text, source, seed), "sizes")
    aims = targets(rows, weights, share, most)
    few = aims.agg(F.count(F.lit(1)), F.sum(F.octet_length("source"))).first()
    side = aims.withColumnRenamed("source", "name")
    side = F.broadcast(side) if few[0] * 64 + (few[1] or 0) <= 64 << 20 else side
    ranges = F.ceil(F.col("rows") / range_rows)
    part = F.floor(F.conv(F.substring("key", 1, 8), 16, 10).cast("double") * ranges / float(1 << 32)).cast("long")
    placed = rows.join(side, F.col("source").eqNullSafe(F.col("name"))).select("doc_id", "source", "size", "key", "copies", "source_size", "target", part.alias("range"))
    placed = stored(placed, "placed")
    drop_stored(rows, aims)

    before = lambda w: F.coalesce(F.sum("words").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    words = F.col("size") * F.col("copies")
    sums = placed.groupBy("source", "range").agg(F.sum(words).alias("words"))  # a row for each range of documents
    starts = stored(sums.select(F.col("source").alias("name"), F.col("range").alias("at"), before(Window.partitionBy("source").orderBy("range")).alias("start")), "starts")
    within = before(Window.partitionBy("source", "range").orderBy("key", "doc_id", "size"))
    few = starts.agg(F.count(F.lit(1)), F.sum(F.octet_length("name"))).first()
    starts = F.broadcast(starts) if few[0] * 64 + (few[1] or 0) <= 64 << 20 else starts
    own = placed.withColumn("words", words).withColumn("before", within).join(starts, F.col("source").eqNullSafe(F.col("name")) & (F.col("range") == F.col("at")))

    budget = F.floor("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(floor(target) as bigint) div greatest(source_size, 1)")).otherwise(F.lit(0).cast("long"))
    each = own.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)))
    left = budget - F.col("epochs") * F.col("source_size") - F.col("start") - F.col("before") - F.col("copy") * F.col("size")
    cut = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return each.withColumn("epochs", epochs).select("doc_id", "source", "size", "source_size", "target", (F.col("epochs") * F.col("size") + cut).alias("taken"))


def expanded(mixed: DataFrame) -> DataFrame:
    """(doc_id, source, epoch, words): a row for each time the mix takes a document, with the words it takes then."""
    times = F.expr("(taken + size - 1) div size")
    rows = mixed.where("taken > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), times - 1)))
    return rows.select("doc_id", "source", "epoch", F.least("size", F.col("taken") - F.col("epoch") * F.col("size")).alias("words"))


def brute_force(docs: list[tuple], weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED) -> list[tuple]:
    """(doc_id, size, source_size, target, taken) by plain loops over (doc_id, source, text), for tests."""
    import hashlib
    import re

    rows = [(i, s, len(re.findall(WORD, t or ""))) for i, s, t in docs]
    names = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, x, n in rows if x == s) for s in names}
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = dict.fromkeys(names, 0.0), list(names), share * sum(size.values())
    while open_:
        whole = sum(weight[s] for s in open_)
        full = [s for s in open_ if left * weight[s] / whole >= most * size[s]]
        for s in full or open_:
            target[s] = float(most * size[s]) if full else left * weight[s] / whole
        if not full:
            break
        left -= sum(target[s] for s in full)
        open_ = [s for s in open_ if s not in full]
    out = []
    for s in names:
        own = sorted((hashlib.md5(f"{seed}{'' if i is None else i}".encode()).hexdigest(), -1 if i is None else i, n, i) for i, x, n in rows if x == s)
        epochs, rest = divmod(math.floor(target[s] + 1e-6), size[s]) if size[s] else (0, 0)
        for _, _, n, i in own:
            out.append((i, n, size[s], target[s], epochs * n + max(0, min(n, rest))))
            rest -= n
    return out


SQL = r"""
with sized as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size, md5(concat('mix:', coalesce(cast(doc_id as varchar), ''))) as key
  from documents
), sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source
), weighted as (
  select source, source_size, [5, 2, 1][cast((row_number() over (order by source nulls last) - 1) % 3 + 1 as int)] as weight from sources
), levels as (
  select *, cast(source_size * (10 // weight) as bigint) as reach,
    (1.5::double * sum(source_size) over () - 2.0::double * coalesce(sum(source_size) over before, 0)) / (sum(weight) over () - coalesce(sum(weight) over before, 0)) as level
  from weighted
  window before as (order by source_size * (10 // weight), source nulls last rows between unbounded preceding and 1 preceding)
), chosen as (
  select level from levels where 2.0::double * source_size > level * weight order by reach, source nulls last limit 1
), aims as (
  select source, source_size, coalesce(least(2.0::double * source_size, (select level from chosen) * weight), 2.0::double * source_size) as target from weighted
), placed as (
  select s.doc_id, s.size, a.source_size, a.target,
    coalesce(sum(s.size) over (partition by s.source order by s.key, s.doc_id, s.size rows between unbounded preceding and 1 preceding), 0) as before,
    case when a.source_size > 0 then cast(floor(a.target) as bigint) // a.source_size else 0 end as epochs
  from sized s join aims a on s.source is not distinct from a.source
)
select doc_id, size, source_size, target,
  cast(epochs * size + greatest(0, least(size, cast(floor(target) as bigint) - epochs * source_size - before)) as bigint) as taken
from placed
"""
