"""Connected components of a table of links, kept distributed throughout."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._common import broadcast_if_small, drop_stored, stored


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component) for every node of ``links``; a component's name is its smallest node.

    Each round takes the smallest label among neighbours and then follows that label's own label, so long chains
    halve. Labels are written each round. Null ends are ignored; repeated links and self-links do no harm; an
    empty table gives an empty result.
    """
    both = (
        links.select(F.col(a).alias("node"), F.col(b).alias("other"))
        .unionByName(links.select(F.col(b).alias("node"), F.col(a).alias("other")))
        .where("node is not null and other is not null")
    )
    # each node is a neighbour of its own, so what it hears has its own label too
    edges = stored(both.unionByName(both.select("node", F.col("node").alias("other"))).distinct(), "edges")
    small = edges.count() * 64 <= 64 << 20  # labels are no more than edges

    def side(df: DataFrame) -> DataFrame:
        return F.broadcast(df) if small else df

    labels = stored(edges.groupBy("node").agg(F.min("other").alias("label")), "labels")
    while True:
        heard = edges.join(side(labels.select(F.col("node").alias("other"), F.col("label").alias("low"))), "other")
        heard = heard.groupBy("node").agg(F.min("low").alias("low"), F.max(F.when(F.col("other") == F.col("node"), F.col("low"))).alias("old"))
        jump = labels.select(F.col("node").alias("low"), F.col("label").alias("lower"))
        nxt = heard.join(side(jump), "low", "left").select("node", F.least("low", F.coalesce("lower", "low")).alias("label"), "old")
        nxt = stored(nxt, "labels")
        drop_stored(labels)
        labels = nxt
        if nxt.where("label <> old").isEmpty():
            drop_stored(edges)
            return nxt.select("node", F.col("label").alias("component"))
        labels = nxt.select("node", "label")
        labels._stored_at = nxt._stored_at


#: Rounds in which one pair of representatives stands for two components before all their pairs are compared.
PROBES = 3
#: Items of a key up to which all its pairs are compared at once.
FEW = 8


def cluster_by_keys(shared: DataFrame, verified: Callable[[DataFrame], DataFrame], facts: DataFrame, plausible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column], probes: int = PROBES) -> DataFrame:
    """(node, component) of the items that ``verified`` links among those sharing a key.

    ``shared`` is a stored table of distinct (key, item, low, n) rows of keys that several items have, ``low`` the smallest
    of them and ``n`` at least their number; ``facts`` has a row for each item. All pairs of a key of FEW items are
    compared at once; of others each item with the smallest. Where such a key's items are still of several components,
    one item of each is compared with one of the first component, in a few rounds with other items. Last, all items of different components that share a key are compared if
    ``plausible`` holds between the facts of both; the items of a key's first component are not gone through among each other. So a group of copies costs about one comparison each, and no link is
    lost that could join two components. A key's items are reduced to a row for each component before they meet in a
    task, however many they are.
    """
    names = ["item", *[c for c in facts.columns if c != "item"]]
    few = F.col("n") <= FEW
    x, y = (shared.where(few).select("key", F.col("item").alias(k)) for k in "ab")
    near = x.join(y, "key").where("a < b").select("a", "b")
    star = shared.where(~few & (F.col("low") != F.col("item"))).select(F.col("low").alias("a"), F.col("item").alias("b"))
    tested = stored(near.unionByName(star).distinct(), "pairs")
    found = stored(verified(tested), "links")
    joined = components(found)
    rows, garbage = shared.where(~few).select("key", "item"), [tested]
    if rows.isEmpty():
        drop_stored(tested)
        return joined
    for probe in range(probes + 1):
        labelled = rows.join(joined.withColumnRenamed("node", "item"), "item", "left").select("key", "item", F.coalesce("component", "item").alias("component"))
        labelled = stored(labelled, "labelled")
        ones = labelled.groupBy("key", "component").agg(F.min_by("item", F.xxhash64("item", F.lit(probe))).alias("item"))
        several = ones.groupBy("key").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.min_by("item", "component").alias("first"))
        several = stored(several.where("least <> most").select("key", "least", "first"), "several")
        rows = stored(labelled.join(broadcast_if_small(several, 64), "key").select("key", "item", "component", "least", "first"), "open-keys")
        drop_stored(labelled, several)
        garbage.append(rows)
        if probe == probes or rows.isEmpty():
            break
        x, y = (F.struct(*[F.col(f"{k}.{c}") for c in names]).alias(k) for k in "xy")
        ones = rows.where("component <> least").groupBy("key", "component", "first").agg(F.min_by("item", F.xxhash64("item", F.lit(probe))).alias("item"))
        both = ones.select("item", "first").distinct().join(facts.alias("x"), "item").select("first", x).join(facts.alias("y"), F.col("first") == F.col("y.item")).select("x", y)
        both = both.where(plausible(lambda c: F.col("x")[c], lambda c: F.col("y")[c]))
        pairs = both.select(F.least("x.item", "y.item").alias("a"), F.greatest("x.item", "y.item").alias("b")).distinct()
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "probes")
        garbage.append(pairs)
        more = stored(verified(pairs), "probed-links")
        tested = tested.unionByName(pairs)
        if more.isEmpty():
            break
        found = found.unionByName(more)
        joined = components(found)
        rows = rows.select("key", "item")
    if not rows.isEmpty():
        with_facts = rows.select("key", "item", "component", "least").join(facts, "item")
        x, y = (with_facts.select(*[F.col(c).alias(f"{k}_{c}") for c in with_facts.columns]) for k in "xy")
        x = x.where("x_component <> x_least")  # most items of a key are of one component: they meet the others, not each other
        once = (F.col("y_component") == F.col("y_least")) | (F.col("x_item") < F.col("y_item"))
        apart = once & (F.col("x_component") != F.col("y_component")) & plausible(lambda c: F.col(f"x_{c}"), lambda c: F.col(f"y_{c}"))
        pairs = x.join(y, (F.col("x_key") == F.col("y_key")) & apart).select(F.least("x_item", "y_item").alias("a"), F.greatest("x_item", "y_item").alias("b"))
        more = stored(verified(pairs.distinct().join(tested, ["a", "b"], "left_anti")), "more-links")
        joined = joined if more.isEmpty() else components(found.unionByName(more))
    drop_stored(*garbage)
    return joined
