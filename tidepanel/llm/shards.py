"""Sharding by rendezvous hashing: the shard with the best weighted score of (key, shard) takes the record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts in which a shard's rows are numbered side by side.
SLICES = 1024


def score(key: Column, shard: Column, weight: Column) -> Column:
    """Weighted rendezvous score: -weight / ln(u), u uniform in (0, 1) from 53 hash bits of key and shard."""
    u = (F.shiftrightunsigned(F.xxhash64(key, shard), 11).cast("double") + 0.5) / float(2**53)
    return -weight / F.ln(u)


def rendezvous(key: Column, weights: Sequence[float]) -> tuple[Column, Column]:
    """The best score and its shard. Shards are 0 to len(weights) - 1; equal scores go to the larger number.

    A shard's score depends on nothing but the key, its number and its weight. One more shard, or a larger
    weight, therefore takes records into that shard and moves none between others.
    """
    if not weights or any(not w > 0 for w in weights):
        raise ValueError("weights must be positive, and there must be one at least")
    best = F.greatest(*[F.struct(score(key, F.lit(i), F.lit(float(w))).alias("score"), F.lit(i).alias("shard"))
                        for i, w in enumerate(weights)]) if len(weights) > 1 else F.struct(
        score(key, F.lit(0), F.lit(float(weights[0]))).alias("score"), F.lit(0).alias("shard"))
    return best["score"], best["shard"]


def assign(records: DataFrame, key: str, weights: Sequence[float], extra: float | None = None,
           slices: int = SLICES) -> DataFrame:
    """Give each record ``shard`` (int), ``slot`` (long, gapless from 0 in its shard) and ``grown_shard``.

    ``grown_shard`` is the shard if one more of weight ``extra`` joined (null if ``extra`` is None). The key is
    hashed as text; a null key is a key of its own. Columns are kept; those called like a result are replaced.
    Equal rows (all columns equal) are counted first and told apart again at the end, so a row repeated any
    number of times is one row in the shuffle and in the numbering. Slots go by (slice, key, other columns),
    where the slice is hashed from key and row: a shard is numbered in ``slices`` parts side by side, and parts
    are shifted by the counts before them, a table of shards x slices rows. Each law depends on content alone,
    so a task that runs again gives the same. No rows give no rows.
    """
    columns = [c for c in records.columns if c.lower() not in {"shard", "slot", "grown_shard"}]
    text = F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("\0null"))
    best, shard = rendezvous(text, weights)
    grown = F.lit(None).cast("int") if extra is None else F.when(
        score(text, F.lit(len(weights)), F.lit(float(extra))) >= best, F.lit(len(weights))).otherwise(shard)
    distinct = records.groupBy(*[F.col(f"`{c}`") for c in columns]).agg(F.count(F.lit(1)).alias("_copies"))
    placed = distinct.select(
        *[F.col(f"`{c}`") for c in columns], "_copies", shard.cast("int").alias("_shard"),
        grown.cast("int").alias("_grown"),
        F.pmod(F.xxhash64(text, *[F.col(f"`{c}`") for c in columns]), F.lit(slices)).cast("int").alias("_slice"))
    counts = placed.groupBy("_shard", "_slice").agg(F.sum("_copies").alias("_n"))
    ahead = Window.partitionBy("_shard").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_shard", "_slice", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_offset"))
    if len(weights) * slices <= 100_000:  # the bound of this table, whatever the records are
        offsets = F.broadcast(offsets)
    own = Window.partitionBy("_shard", "_slice").orderBy(*[F.col(f"`{c}`") for c in [key, *columns]])
    first = F.coalesce(F.sum("_copies").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = placed.withColumn("_first", first).join(offsets, ["_shard", "_slice"])
    copies = F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1))
    return numbered.withColumn("_copy", copies).select(
        *[F.col(f"`{c}`") for c in columns], F.col("_shard").alias("shard"),
        (F.col("_offset") + F.col("_first") + F.col("_copy")).cast("long").alias("slot"),
        F.col("_grown").alias("grown_shard"))
