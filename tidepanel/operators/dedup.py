"""Keyed de-duplication and surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.ranking import with_row_number


def first_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the earliest by load order (insert-or-ignore).

    The row_number filter becomes a per-task group limit, so a key holding a
    large part of the table sends one row per map task through the shuffle.
    """
    win = Window.partitionBy(*key).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(win)).where(F.col("_rn") == 1).drop("_rn")


def last_wins(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row per key, the latest by load order (insert-or-replace). ``order`` is
    given ascending, as plain columns."""
    return first_wins(df, key, [c.desc() for c in order])


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Trimmed distinct values without NULLs, sorted."""
    return df.select(F.trim(col).alias(col)).where(F.col(col).isNotNull()).distinct().orderBy(col)


def with_surrogate_key(df: DataFrame, natural: str, out: str) -> DataFrame:
    """Dense keys 1..n in the order of the natural key, which must be unique."""
    return with_row_number(df, natural, natural, rank=out, total="_total").drop("_total")
