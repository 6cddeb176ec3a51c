"""Groups from buckets of candidates: leaders, verified links, connected components, pairs of blocks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ticktalk.session import settle

#: Members of the leader's component, besides the nearest, that those who failed with the leader try before they meet all.
TRIES = 4


def components(edges: DataFrame) -> DataFrame:
    """``id, root`` for every vertex of the links ``a, b``; vertices of one component share a root.

    Each round, a vertex joins its neighbour of smallest hash, if that is smaller than its own, and links are renamed; a round
    removes a constant share of the vertices on average. Everything is written between rounds, and nothing is collected."""

    def rank(c: str):
        return F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("v"))

    edges = settle(edges.where("a <> b").select("a", "b").distinct(), "links")
    labels = None
    while not edges.isEmpty():
        both = edges.union(edges.select("b", "a"))
        step = both.groupBy("a").agg(F.min(rank("b")).alias("n")).select(F.col("a").alias("id"), F.when(F.col("n") < rank("a"), F.col("n.v")).otherwise(F.col("a")).alias("root"))
        step = settle(step, "links-step")
        # A vertex that has no links left is not in the step and keeps its root.
        labels = step if labels is None else settle(labels.join(step.select(F.col("id").alias("root"), F.col("root").alias("next")), "root", "left").select("id", F.coalesce("next", "root").alias("root")), "links-labels")
        new = edges.join(step.select(F.col("id").alias("a"), F.col("root").alias("x")), "a").join(step.select(F.col("id").alias("b"), F.col("root").alias("y")), "b")
        edges = settle(new.where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "links")
    return labels if labels is not None else edges.select(F.col("a").alias("id"), F.col("b").alias("root"))


def candidate_groups(buckets: DataFrame) -> DataFrame:
    """``id, root`` for all members of the buckets ``key, id`` that share one with another member; members that a chain of buckets joins share
    a root. Nothing is compared: each member is joined to its bucket's least one."""
    least = F.min("id").over(Window.partitionBy("key"))
    return components(buckets.select(least.alias("a"), F.col("id").alias("b")))


def block_pairs(members: DataFrame, most: int, most_bytes: int) -> DataFrame:
    """``members`` with the columns ``part``, the block of the row's group ``root``, and ``pairs``, all pairs ``low, high`` of blocks which its block is
    in. Groups are dealt by hash into blocks of about ``most`` rows and ``most_bytes`` of ``size``. Whoever compares the rows of each pair of blocks,
    and those of one block where ``low`` is ``high``, has compared all pairs of the group, each once, with two blocks in memory."""
    parts = F.ceil(F.greatest(F.count(F.lit(1)) / F.lit(most), F.sum("size") / F.lit(most_bytes), F.lit(1.0))).cast("int")
    sizes = settle(members.groupBy("root").agg(parts.alias("parts")), "group-parts")
    dealt = members.join(sizes, "root").withColumn("part", F.pmod(F.xxhash64(F.lit(7), "fp"), F.col("parts")).cast("int"))
    pairs = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least("part", k).alias("low"), F.greatest("part", k).alias("high")))
    return dealt.withColumn("pairs", pairs).drop("parts")


def linked(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], near: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """Links ``a, b`` that connect all vertices which verified pairs of the same bucket connect. ``buckets``: ``key, id``.

    Pairs of a bucket are not all listed. Every member is compared with the bucket's leader, the smallest id; who passes is
    connected through it. Who fails is then compared with a few more members of the leader's
    component: the one nearest to the leader, as that tends to be what the others were made from, and ``TRIES`` chosen by hash; and at
    last with all members that are not yet in its component, so that no connection is lost. ``verify`` takes distinct pairs ``a, b`` and adds ``ok`` and ``gap``, a distance. ``near``, if given, is a cheap condition on two ids
    that every link fulfils, and is checked while pairs are formed."""
    leads = buckets.groupBy("key").agg(F.min("id").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
    leads = settle(leads, "bucket-leads")
    placed = settle(buckets.join(leads, "key").where("id <> lead").select("key", "id", "lead", "n"), "bucket-members")
    first = settle(verify(placed.select(F.col("lead").alias("a"), F.col("id").alias("b")).distinct()), "bucket-first")
    links = first.where("ok").select("a", "b")
    judged = placed.where("n > 2").join(first.select(F.col("a").alias("lead"), F.col("b").alias("id"), "ok", "gap"), ["lead", "id"])
    judged = settle(judged.select("key", "id", "ok", "gap"), "bucket-judged")
    if judged.where("NOT ok").isEmpty():
        return links
    # Who failed mostly passes with another member of the leader's component. A few such members per bucket are tried before all.
    roots = components(links)
    member = judged.join(roots.select("id", "root"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    member = settle(member, "bucket-roots")
    chosen = [F.min(F.struct("gap", "id", "root"))] + [F.min(F.struct(F.xxhash64(F.lit(i), "key", "id").cast("double").alias("gap"), "id", "root")) for i in range(TRIES)]
    pivots = member.where("ok").groupBy("key").agg(F.array(*chosen).alias("p")).select("key", F.explode("p").alias("p"))
    pivots = settle(pivots.select("key", F.col("p.id").alias("pivot"), F.col("p.root").alias("pivot_root")).distinct(), "bucket-pivots")
    tries = member.join(pivots, "key").where("NOT ok AND root <> pivot_root").select(F.least("pivot", "id").alias("a"), F.greatest("pivot", "id").alias("b")).distinct()
    second = settle(verify(tries.join(first.select("a", "b"), ["a", "b"], "left_anti")).select("a", "b", "ok"), "bucket-second")
    links = settle(links.union(second.where("ok").select("a", "b")), "links-two")
    done = settle(first.select("a", "b").union(second.select("a", "b")), "links-tried")
    roots = components(links)
    member = settle(judged.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id")), "bucket-roots")
    # What is left: members that failed, in buckets that still hold several components, meet the other components' members.
    several = settle(member.groupBy("key").agg(F.min("root").alias("x"), F.max("root").alias("y")).where("x <> y").select("key"), "bucket-several")
    member = member.join(several, "key", "left_semi")
    left = member.where("NOT ok").select("key", F.col("id").alias("b"), F.col("root").alias("root_b"))
    right = member.select("key", F.col("id").alias("a"), F.col("root").alias("root_a"))
    met = (left.key == right.key) & (F.col("root_a") != F.col("root_b"))
    rest = left.join(right, met & near(F.col("a"), F.col("b")) if near else met)
    rest = rest.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(done, ["a", "b"], "left_anti")
    return settle(links.union(verify(rest).where("ok").select("a", "b")), "links-all")
