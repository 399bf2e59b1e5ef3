"""Connected components of a table of links by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import written


def components(links: DataFrame, a: str, b: str, rounds: int = 60) -> DataFrame:
    """``node, root`` for each node that some link joins to another; root is the least node it can reach.

    Nodes are values of any type with an order. A large star hangs a node's larger neighbours onto its least one, a
    small star the smaller ones; each keeps the components. It ends when a round changes no link, after some
    logarithm of the size. Least neighbours are map-side minima and the joins back are plain joins, whose hot
    nodes adaptive execution splits. Each round is written to the shared folder. Null ends are left out.
    """
    edges = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    edges = written(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "links")
    mark = lambda e: tuple(e.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")), F.lit(0))).first())
    before = mark(edges)
    for _ in range(rounds):
        if not before[0]:
            break
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least).where("u <> v").distinct()
        edges = written(small, "links")
        after = mark(edges)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components aren't settled after {rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(edges.select("v", "v").distinct())
