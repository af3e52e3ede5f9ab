"""Finds the connected components of a similarity relation from buckets of candidates.

Two items can only be similar if they share a bucket. Comparing all pairs of a bucket costs the square of its size, so it
is done in two rounds. First every item of a bucket is compared with one pivot of it; a large group of
near copies falls into few components this way. Then only pairs of different components are compared: the members
outside the bucket's largest component with all others. No link between components is lost, and pairs
that are known to be connected are never formed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hostpulse.llm.common import release, stored


#: Pairs for each member outside its bucket's largest component up to which further pivots are not worth a round.
PAIRS_A_MEMBER = 4
#: Members above which a bucket of several components is dealt into finer ones, where the caller has any.
FULL = 256


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, the smallest node that edges `a`, `b` connect it with, for the nodes of the edges.

    Each round hooks every node to its smallest neighbour, shortens the paths and contracts the edges; the number
    of nodes at least halves. All steps are joins and aggregations, and each round is written to the shared folder.
    """
    spark = edges.sparkSession
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    left = stored(both.where("a <> b").distinct(), "edges")
    labels = None
    while not left.isEmpty():
        low = left.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("up"))
        parents = stored(low, "parents")
        for _ in range(2):
            above = parents.select(F.col("a").alias("up"), F.col("up").alias("above"))
            parents = parents.join(above, "up", "left").select("a", F.coalesce("above", "up").alias("up"))
        parents = stored(parents, "parents")
        if labels is None:
            labels = parents.select(F.col("a").alias("node"), F.col("up").alias("component"))
        else:
            up = parents.select(F.col("a").alias("component"), "up")
            labels = labels.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("component"))
            labels = stored(labels, "labels")
        one = parents.select("a", F.col("up").alias("x"))
        two = parents.select(F.col("a").alias("b"), F.col("up").alias("y"))
        left = left.join(one, "a").join(two, "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b"))
        left = stored(left.distinct(), "edges")
    if labels is None:
        return spark.createDataFrame([], "node long, component long")
    return labels


def linked(
    members: DataFrame,
    first: Callable[[Column], Column],
    fits: Callable[[Column, Column], Column],
    profile: Callable[[DataFrame], DataFrame],
    close: Callable[[Column, Column], Column],
    verify: Callable[[DataFrame], DataFrame],
    rounds: int = 0,
    hot: bool = False,
    barren: Callable[[Column], Column] | None = None,
    split: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Components of the items in the buckets.

    `members`: `key` (the bucket), `node` and `info`, one number that says what a comparison needs to know of the
    member. Those with the smallest `first(info)` come first as pivots. A pair is compared if `fits(x, y)` holds for its
    infos and `close(x, y)` for what `profile` gives, as column `about`, for each of the nodes that share a bucket with another.
    `verify` gets pairs `a` < `b` and returns those that are linked; no pair is verified twice.
    With `rounds`, members outside their bucket's largest component meet further pivots, one a round and all of that
    component, before the rest is compared; only the work depends on it. Rounds end early where they no longer help.
    `hot` finds the first pivots by an aggregation that is joined back, so that a bucket of a third of all rows is split among tasks;
    otherwise a bucket is sorted in one task, which moves the members once instead of twice.
    `barren` says of a pivot's info that no two members of its bucket can fit; such buckets go at once.
    `split` gets the nodes of the buckets that still hold several components and more than `FULL` members, and returns members
    of finer buckets: any two of the nodes that are linked share one of these. They replace the full buckets.
    """
    # One order for all buckets: items that share many buckets then meet the same few pivots in all of them.
    rank = (first(F.col("info")).alias("first"), F.xxhash64("node").alias("turn"), F.col("node"))
    if hot:
        chosen = members.groupBy("key").agg(F.min(F.struct(*rank, "info")).alias("p"), F.count("*").alias("size"))
        stars = members.join(chosen.where("size > 1"), "key").where(F.col("p.node") != F.col("node"))
    else:
        pivot = F.first(F.struct("node", "info")).over(Window.partitionBy("key").orderBy(*rank))
        stars = members.withColumn("p", pivot).where(F.col("p.node") != F.col("node"))
    if barren is not None:
        stars = stars.where(~barren(F.col("p.info")))
    stars = stored(stars.select("key", "node", "info", F.col("p.node").alias("p_node"), F.col("p.info").alias("p_info")), "stars")
    pivots = stars.select("key", F.col("p_node").alias("node"), F.col("p_info").alias("info"))
    everyone = stored(stars.select("key", "node", "info").union(pivots).distinct(), "members")
    about = profile(everyone.select("node").distinct())

    def promising(pairs: DataFrame) -> DataFrame:
        both = pairs.join(about.toDF("a", "x"), "a").join(about.toDF("b", "y"), "b")
        return both.where(close(F.col("x"), F.col("y"))).select("a", "b")

    near = stars.where(fits(F.col("info"), F.col("p_info")))
    near = _pairs(near.select(F.col("node").alias("x_node"), F.col("p_node").alias("y_node")))
    tried = stored(promising(near), "pairs")
    release(stars)
    found = stored(verify(tried), "links")
    parts = components(found)

    placed, mixed = _placed(everyone, parts)
    release(everyone)
    before = None
    for turn in range(rounds):
        outside, most = _left(mixed)
        if most <= PAIRS_A_MEMBER * outside or (before is not None and 4 * outside > 3 * before):
            break
        before = outside
        some = stored(placed.join(mixed.select("key", "major"), "key"), "mixed-members")
        release(placed)
        inside = some.where("part = major").groupBy("key")
        chosen = inside.agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)).alias("turn"), "node", "info")).alias("p"))
        near = some.where("part <> major").join(chosen, "key").where(fits(F.col("info"), F.col("p.info")))
        near = _pairs(near.select(F.col("node").alias("x_node"), F.col("p.node").alias("y_node")))
        fresh = stored(promising(near.join(tried, ["a", "b"], "left_anti")), "pairs")
        tried = tried.union(fresh)
        found = found.union(stored(verify(fresh), "links"))
        parts = components(found)
        placed, mixed = _placed(some.select("key", "node", "info"), parts)
        release(some)

    def unlinked(placed: DataFrame, mixed: DataFrame) -> DataFrame:
        """The pairs of different components: of each bucket those outside its largest component with all others."""
        # Written, so that the join below deals its rows out anew and a frequent bucket can be split among tasks.
        rest = stored(placed.join(mixed.select("key", "major"), "key").join(about, "node"), "mixed-members")
        columns = ("node", "info", "part", "about")
        x = rest.where("part <> major").select("key", *(F.col(c).alias(f"x_{c}") for c in columns))
        y = rest.select("key", "major", *(F.col(c).alias(f"y_{c}") for c in columns))
        apart = (
            (F.col("x_part") != F.col("y_part"))
            & ((F.col("y_part") == F.col("major")) | (F.col("x_node") < F.col("y_node")))
            & fits(F.col("x_info"), F.col("y_info"))
            & close(F.col("x_about"), F.col("y_about"))
        )
        return _pairs(x.join(y, "key").where(apart))

    full = mixed.where(F.col("total") > FULL)
    if split is None or full.isEmpty():
        left = unlinked(placed, mixed)
    else:
        nodes = stored(placed.join(full.select("key"), "key").select("node").distinct(), "full")
        finer = _placed(split(nodes), parts)
        left = unlinked(placed, mixed.where(F.col("total") <= FULL)).union(unlinked(*finer)).distinct()
    release(placed)
    more = stored(verify(stored(left.join(tried, ["a", "b"], "left_anti"), "pairs")), "links")
    if more.isEmpty():
        return parts
    return components(found.union(more))


def _placed(rows: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members with their component, and the buckets of several: `major`, the largest, and the sizes of both."""
    placed = rows.join(parts, "node", "left").withColumn("part", F.coalesce("component", "node"))
    placed = stored(placed.select("key", "node", "info", "part"), "placed")
    shares = placed.groupBy("key", "part").agg(F.count("*").alias("size"))
    mixed = (
        shares.groupBy("key")
        .agg(F.max(F.struct("size", "part")).alias("largest"), F.sum("size").alias("total"), F.count("*").alias("parts"))
        .where("parts > 1")
        .select("key", F.col("largest.part").alias("major"), F.col("largest.size").alias("inside"), "total")
    )
    return placed, stored(mixed, "mixed")


def _left(mixed: DataFrame) -> tuple[int, int]:
    """Members outside the largest components, and the pairs that comparing them with all others would take."""
    outside = F.col("total") - F.col("inside")
    row = mixed.agg(F.sum(outside).alias("outside"), F.sum(outside * F.col("total")).alias("pairs")).first()
    return row.outside or 0, row.pairs or 0


def _pairs(rows: DataFrame) -> DataFrame:
    """The distinct pairs of nodes, the smaller first."""
    return rows.select(F.least("x_node", "y_node").alias("a"), F.greatest("x_node", "y_node").alias("b")).distinct()
