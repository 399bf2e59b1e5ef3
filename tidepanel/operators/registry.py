"""Surrogate keys that last: a stored registry that only grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.ranking import with_row_number
from tidepanel.sources import store

#: Folders of a registry; a new key is looked up among the stored keys of its bucket.
BUCKETS = 64


def new_keys(registry: DataFrame, df: DataFrame, natural: str, out: str) -> DataFrame:
    """``natural, out`` for the natural keys of ``df`` that the registry lacks: from its greatest key on, in their order.

    Null isn't a key. The order decides the numbers, so a task that runs again gives the same ones; ranks are found in
    parallel, and only the greatest stored key is brought together.
    """
    fresh = df.select(F.col(natural)).where(F.col(natural).isNotNull()).distinct().join(registry.select(natural), natural, "left_anti")
    ranked = with_row_number(fresh, natural, natural, rank="_rank", total="_total")
    top = registry.agg(F.coalesce(F.max(out), F.lit(0)).alias("top"))
    return ranked.select(natural, (top.scalar() + F.col("_rank")).cast("long").alias(out))


def assign_keys(spark: SparkSession, table: str, df: DataFrame, natural: str, out: str, delivery: str) -> DataFrame:
    """Give every natural key of a delivery a number and return the registry: known keys keep theirs.

    The registry is a stored table; its new version is published last, so a job that dies or is run again gives
    no key twice. Two deliveries at a time clash when the second is published (``store.Conflict``) and the loser
    assigns anew.
    """
    kind = df.schema[natural].dataType
    store.create(spark, table, T.StructType([T.StructField(natural, kind), T.StructField(out, T.LongType())]))
    if delivery not in store.current(spark, table).deliveries:
        rows = new_keys(store.read(spark, table), df, natural, out)
        bucket = F.pmod(F.xxhash64(natural), F.lit(BUCKETS))
        store.merge_first_wins(spark, table, rows, [natural], bucket, [F.col(out)], delivery)
    return store.read(spark, table)
