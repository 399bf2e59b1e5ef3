"""Join helpers: bounded broadcasts, anti joins on pre-aggregated keys, as-of joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Two-letter country codes: an upper bound on distinct countries.
COUNTRY_CODES = 26 * 26
BROADCAST_LIMIT_BYTES = 64 << 20


def broadcast_bounded(df: DataFrame, max_rows: int, row_bytes: int = 64) -> DataFrame:
    """Hint a broadcast only where the key domain proves the side small.

    ``max_rows`` is the size of the key domain (country codes x calendar periods,
    rows of a constant table), not a guess about the data. Beyond the limit the
    frame is returned without a hint and adaptive execution picks the join from
    the measured sizes.
    """
    return F.broadcast(df) if max_rows * row_bytes <= BROADCAST_LIMIT_BYTES else df


def country_periods(per_year: int, years: int = 100) -> int:
    """Rows a (country, period) table can have over a century of periods."""
    return COUNTRY_CODES * per_year * years


def lookup_key(facts: DataFrame, dimension: DataFrame, natural: str, surrogate: str) -> DataFrame:
    """Replace a natural key by its surrogate; rows without a match are dropped."""
    keys = dimension.select(natural, surrogate)
    return facts.join(keys, natural, "inner")


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Keys (with row counts) of the child that the parent lacks.

    The child is reduced to one row per key first, so a hot key costs one row in
    the join. NULL keys reference nothing and are not orphans.
    """
    keys = child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("key")).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(parent_key).alias("key")), "key", "left_anti")


def asof_join(
    left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, values: list[str], slice_days: int | None = None,
) -> DataFrame:
    """Latest right row at or before each left row's time, per key.

    Both sides are unioned and the last right values are carried forward in one
    window over ``key``: one shuffle, no range join. Right rows sort before left
    rows of the same time, so an exact match counts.

    ``slice_days`` cuts the (date) time of each key into slices, so that a key with very many rows isn't one task: values
    are carried within a slice first, and a left row that finds none there takes the last of the slices before,
    of which there is one row each.
    """
    carried = F.struct(F.col(right_time).alias(f"asof_{right_time}"), *[F.col(v) for v in values])
    rows = F.struct(*[F.col(c) for c in left.columns if c != key])
    union = right.select(
        F.col(key), F.col(right_time).alias("_t"), F.lit(0).alias("_side"),
        F.lit(None).cast(left.select(rows.alias("x")).schema["x"].dataType).alias("_row"),
        carried.alias("_carry"),
    ).unionByName(
        left.select(
            F.col(key), F.col(left_time).alias("_t"), F.lit(1).alias("_side"), rows.alias("_row"),
            F.lit(None).cast(right.select(carried.alias("x")).schema["x"].dataType).alias("_carry"),
        )
    )
    group = [key]
    if slice_days:
        group = [key, "_slice"]
        union = union.withColumn("_slice", F.floor(F.unix_date("_t") / slice_days))
    span = Window.partitionBy(*group).orderBy("_t", "_side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    found = union.withColumn("_carry", F.last("_carry", ignorenulls=True).over(span)).where(F.col("_side") == 1)
    if slice_days:
        ends = union.groupBy(*group).agg(F.max_by("_carry", F.when(F.col("_side") == 0, F.col("_t"))).alias("_end"))
        earlier = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select(*group, F.last("_end", ignorenulls=True).over(earlier).alias("_before"))
        same = F.col("l._slice").eqNullSafe(F.col("r._slice")) & (F.col(f"l.{key}") == F.col(f"r.{key}"))
        found = found.alias("l").join(ends.alias("r"), same, "left").select(
            f"l.{key}", "_row", F.coalesce("_carry", "_before").alias("_carry"))
    return found.select(key, "_row.*", "_carry.*")
