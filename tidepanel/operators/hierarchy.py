"""Hierarchies of any depth from parent links, by pointer doubling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.sources.store import scratch_folder


def _cut(df: DataFrame, name: str) -> DataFrame:
    """The frame as a written table in the shared folder: a round's lineage ends there."""
    path = scratch_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cyclic(links: DataFrame, child: str, parent: str) -> DataFrame:
    """``node``: all nodes whose parents lead into a circle.

    Each round doubles the steps that a pointer has gone, so after the logarithm of the number of nodes only such nodes
    still point anywhere. A child has one parent (of several the least one counts); null ends and a node that is
    its own parent's child are links like others.
    """
    steps = links.where(F.col(child).isNotNull() & F.col(parent).isNotNull()).groupBy(F.col(child).alias("node")).agg(F.min(parent).alias("to"))
    steps = _cut(steps, "steps")
    links_, reach = steps.count(), 1
    while reach <= links_ and not steps.isEmpty():
        ahead = steps.select(F.col("node").alias("to"), F.col("to").alias("next"))
        steps = _cut(steps.join(ahead, "to").select("node", F.col("next").alias("to")), "steps")
        reach *= 2
    return steps.select("node")


def ancestors(links: DataFrame, child: str, parent: str) -> DataFrame:
    """``node, ancestor, distance``: every node of the links with itself (distance 0) and all nodes above it.

    Paths double in length with each round: those of up to n steps are joined to those of exactly n. Nodes whose
    parents lead into a circle have no finite set of paths and are left out; ``cyclic`` reports them.
    """
    lost = cyclic(links, child, parent)
    known = links.where(F.col(child).isNotNull() & F.col(parent).isNotNull())
    nodes = known.select(F.col(child).alias("node")).union(known.select(F.col(parent).alias("node"))).distinct().join(lost, "node", "left_anti")
    steps = known.groupBy(F.col(child).alias("node")).agg(F.min(parent).alias("ancestor")).join(lost, "node", "left_anti")
    near = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).alias("distance"))
    near, far, reach = _cut(near, "paths"), _cut(steps, "jumps"), 1
    while not far.isEmpty():
        # near: all paths shorter than reach; far: the paths of exactly that length
        above = near.select(F.col("node").alias("mid"), "ancestor", "distance")
        longer = far.select("node", F.col("ancestor").alias("mid")).join(above, "mid").select("node", "ancestor", (F.col("distance") + reach).alias("distance"))
        near = _cut(near.unionByName(longer), "paths")
        ahead = far.select(F.col("node").alias("mid"), "ancestor")
        far = _cut(far.select("node", F.col("ancestor").alias("mid")).join(ahead, "mid").select("node", "ancestor"), "jumps")
        reach *= 2
    return near


def rollup(links: DataFrame, child: str, parent: str, values: DataFrame, key: str, measures: Sequence[str]) -> DataFrame:
    """``node, depth, members`` and the sums of ``measures`` over each node and all nodes below it.

    ``values`` holds rows of nodes, any number each; they are added up per node before they meet the paths, and sums of
    an ancestor combine map-side, so a root over everything is no hot key. ``depth`` counts from the node's root.
    """
    paths = ancestors(links, child, parent)
    own = values.groupBy(F.col(key).alias("node")).agg(F.count("*").alias("members"), *[F.sum(m).alias(m) for m in measures])
    sums = paths.join(own, "node").groupBy(F.col("ancestor").alias("node")).agg(
        F.sum("members").alias("members"), *[F.sum(m).alias(m) for m in measures])
    depth = paths.groupBy("node").agg(F.max("distance").alias("depth"))
    return depth.join(sums, "node", "left")
