"""Connected components and exact linking of items that share keys.

Used by the near-duplicate operators. Nothing is collected to the driver. Pairs
within a group of items are only made between members not yet known to be linked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from smogline.llm.common import stage


def components(edges: DataFrame) -> DataFrame:
    """``item`` and ``label`` (smallest item of its component) for edges ``a``, ``b`` of longs.

    Alternates large-star and small-star steps, so a chain of n items takes
    about log n rounds. Each round is written to the shared folder.
    """
    edges = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges"
    )
    seen = None
    while True:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        edges = stage(small, "edges")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_000_007), F.sum(F.xxhash64("v", "u") % 998_244_353)).first()
        if now == seen:
            break
        seen = now
    own = edges.select(F.col("v").alias("item"), F.col("v").alias("label")).distinct()
    return edges.select(F.col("u").alias("item"), F.col("v").alias("label")).unionByName(own)


def linked(
    postings: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    may_link: Callable[[str, str], Column],
    order: list[str],
    extra: DataFrame | None = None,
    sketches: DataFrame | None = None,
    near: Callable[[str, str], Column] | None = None,
) -> DataFrame:
    """``item``, ``label`` of items linked by verified pairs that share a key.

    postings: ``key``, ``item`` and attributes, a row once. Two items can only
    be linked if they share a key. verify: pairs ``a < b`` -> those that are
    links. may_link: a cheap necessary condition on the attributes of aliases.
    sketches: ``item`` once and more attributes, and near a second necessary
    condition on these; a pair with a missing attribute stays. They serve the
    pairs of the second step, of which there are many more than links.

    First only neighbours in each key's order and the pairs of extra are verified;
    their number is linear, and they join the members of a large group. Then every
    pair that still lies in different components is verified, so no link is lost,
    while members of a component that is already known make no pairs. Of these
    links one per pair of components is kept.
    """
    in_key = Window.partitionBy("key").orderBy(*order, "item")
    whole = F.struct(*[F.col(c) for c in postings.columns if c != "key"])
    postings = postings.select("key", whole.alias("x"), F.lead(whole).over(in_key).alias("y"), F.count("*").over(Window.partitionBy("key")).alias("many"))
    postings = postings.withColumn("y", F.when(F.col("y").isNotNull() & may_link("x", "y"), F.col("y")))
    postings = stage(postings.where("y is not null or many > 2"), "postings")
    chained = postings.where("y is not null")
    pair = [F.least("x.item", "y.item").alias("a"), F.greatest("x.item", "y.item").alias("b")]
    first = chained.select(*pair).where("a <> b")
    if extra is not None:
        first = first.unionByName(extra)
    first = stage(first.distinct(), "pairs")
    links = stage(verify(first), "links")
    labels = components(links)

    # keys of two items have had their only pair
    labelled = postings.where("many > 2").select("key", "x.*").join(labels, "item", "left").withColumn("label", F.coalesce("label", "item"))
    whole_key = Window.partitionBy("key")
    mixed = labelled.withColumns({"_lo": F.min("label").over(whole_key), "_hi": F.max("label").over(whole_key)})
    open_rows = mixed.where("_lo <> _hi").drop("_lo", "_hi")
    open_rows = stage(open_rows if sketches is None else open_rows.join(sketches, "item", "left"), "open")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    rest = (
        x.join(y, (F.col("x.key") == F.col("y.key")) & (F.col("x.item") < F.col("y.item")) & (F.col("x.label") != F.col("y.label")) & may_link("x", "y") & (F.lit(True) if near is None else F.coalesce(near("x", "y"), F.lit(True))))
        .select(F.col("x.item").alias("a"), F.col("y.item").alias("b"))
        .distinct()
        .join(first, ["a", "b"], "left_anti")
    )
    rest = stage(rest, "pairs")
    if rest.isEmpty():
        return labels
    more = stage(verify(rest), "links")
    la, lb = (labels.select(F.col("item").alias(c), F.col("label").alias(f"label_{c}")) for c in ("a", "b"))
    between = more.join(la, "a", "left").join(lb, "b", "left").select(F.coalesce("label_a", "a").alias("a"), F.coalesce("label_b", "b").alias("b"))
    moved = stage(components(between), "moved")
    to = moved.select(F.col("item").alias("label"), F.col("label").alias("root"))
    return labels.join(to, "label", "left").select("item", F.coalesce("root", "label").alias("label")).unionByName(moved).distinct()
