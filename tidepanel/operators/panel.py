"""Entity-panel operators: lags, growth, streaks, rolling frames, latest rows.

Every window here is partitioned by an entity whose rows are unique per period,
so one partition holds at most one row per period of one entity.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.aggregates import _paired
from tidepanel.functions.scalars import pct_change

Keys = str | Sequence[str]


def _list(keys: Keys) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def entity_window(entity: Keys, order: Keys):
    return Window.partitionBy(*_list(entity)).orderBy(*_list(order))


def with_lags(df: DataFrame, entity: Keys, order: Keys, value: str, lags: Sequence[int], prefix: str | None = None) -> DataFrame:
    """Value of earlier rows (by row, so a missing period is skipped over)."""
    win = entity_window(entity, order)
    return df.withColumns({f"{prefix or value}_lag{k}": F.lag(value, k).over(win) for k in lags})


def with_calendar_lag(df: DataFrame, entity: Keys, period: str, value: str, k: int, out: str) -> DataFrame:
    """Value exactly ``k`` periods back (integer period), NULL where that period is missing."""
    frame = Window.partitionBy(*_list(entity)).orderBy(period).rangeBetween(-k, -k)
    return df.withColumn(out, F.max(value).over(frame))


def with_growth(df: DataFrame, entity: Keys, order: Keys, value: str, out: str = "growth", k: int = 1) -> DataFrame:
    """Percent change to the k-th earlier row; NULL for the first rows or a zero base."""
    return df.withColumn(out, pct_change(F.col(value), F.lag(value, k).over(entity_window(entity, order))))


def with_difference(df: DataFrame, entity: Keys, order: Keys, value: str, out: str) -> DataFrame:
    return df.withColumn(out, F.col(value) - F.lag(value, 1).over(entity_window(entity, order)))


def with_streak(df: DataFrame, entity: Keys, order: Keys, flag: Column, length: int, out: str = "streak") -> DataFrame:
    """How many of the last ``length`` rows carry the flag (missing earlier rows count 0)."""
    frame = entity_window(entity, order).rowsBetween(-(length - 1), 0)
    return df.withColumn(out, F.sum(flag.cast("int")).over(frame))


def with_monotone_decline(df: DataFrame, entity: Keys, order: Keys, value: str, steps: int = 2, out: str = "declining") -> DataFrame:
    """1 where the value fell on each of the last ``steps`` rows, NULL while history is too short."""
    win = entity_window(entity, order)
    chain = [F.col(value), *[F.lag(value, k).over(win) for k in range(1, steps + 1)]]
    falling = F.lit(True)
    for later, earlier in zip(chain, chain[1:]):
        falling = falling & (later < earlier)
    known = chain[-1].isNotNull()
    return df.withColumn(out, F.when(known, F.when(falling, 1).otherwise(0)))


def range_frame(entity: Keys, period: str, k: int):
    """The last ``k`` calendar periods of an entity (integer period), current one included."""
    return Window.partitionBy(*_list(entity)).orderBy(period).rangeBetween(-(k - 1), 0)


def with_rolling(df: DataFrame, entity: Keys, period: str, value: str, k: int, prefix: str = "roll") -> DataFrame:
    """Count, mean and population deviation over the last ``k`` calendar periods.

    One sort per entity replaces a range self-join of k rows for every row."""
    frame = range_frame(entity, period, k)
    return df.withColumns({
        f"{prefix}_count": F.count(value).over(frame),
        f"{prefix}_mean": F.avg(value).over(frame),
        f"{prefix}_std": F.stddev_pop(value).over(frame),
    })


def with_rolling_sliced(
    df: DataFrame, entity: Keys, period: str, value: str, k: int, slice_periods: int, prefix: str = "roll",
) -> DataFrame:
    """``with_rolling`` for entities whose rows are too many for one task: time is cut into slices of ``slice_periods``.

    A slice gets the rows of the ``k - 1`` periods before it as a halo, so every frame lies within one slice, and rows
    of one entity are spread over as many tasks as it has slices. With slices of at least k periods a row is copied
    once at most. Results are those of ``with_rolling``; rows without a period belong to a slice of their own.
    """
    if slice_periods < 1:
        raise ValueError("a slice needs at least one period")
    place = lambda p: F.floor(p / F.lit(slice_periods))
    own = place(F.col(period))
    slices = F.when(F.col(period).isNull(), F.array(F.lit(None).cast("long"))).otherwise(F.sequence(own, place(F.col(period) + (k - 1))))
    spread = df.withColumn("_slice", F.explode(slices))
    rolled = with_rolling(spread, [*_list(entity), "_slice"], period, value, k, prefix)
    return rolled.where(F.col("_slice").eqNullSafe(own)).drop("_slice")


def with_rolling_correlation(df: DataFrame, entity: Keys, period: str, x: str, y: str, k: int, prefix: str = "roll") -> DataFrame:
    """Correlation over the last ``k`` calendar periods; NULL for a constant side."""
    frame = range_frame(entity, period, k)
    px, py = _paired(F.col(x), F.col(y))
    cov, sx, sy = F.covar_pop(x, y).over(frame), F.stddev_pop(px).over(frame), F.stddev_pop(py).over(frame)
    return df.withColumns({
        f"{prefix}_count": F.count(F.when(F.col(y).isNotNull(), F.col(x))).over(frame),
        f"{prefix}_corr": F.try_divide(cov, sx * sy),
    })


def with_period_count(df: DataFrame, entity: Keys, period: str, out: str) -> DataFrame:
    """Number of distinct periods of the entity (DISTINCT is not allowed in a window)."""
    win = entity_window(entity, period)
    fresh = F.when(F.lag(period).over(win) == F.col(period), 0).otherwise(1)
    return df.withColumn("_fresh", fresh).withColumn(
        out, F.sum("_fresh").over(Window.partitionBy(*_list(entity)))
    ).drop("_fresh")


def latest_per_entity(df: DataFrame, entity: Keys, order: str, values: Sequence[str]) -> DataFrame:
    """The values of each entity's row with the greatest ``order``, in one aggregation.

    Partial results combine map-side, so nothing is joined back and a hot entity
    sends one row per task.
    """
    picked = F.max_by(F.struct(F.col(order), *[F.col(v) for v in values]), F.col(order)).alias("_latest")
    return df.groupBy(*_list(entity)).agg(picked).select(*_list(entity), "_latest.*")


def with_periods_since(df: DataFrame, entity: Keys, period: str) -> DataFrame:
    """Neighbouring periods of each entity row: ``prev_period`` and ``next_period``."""
    win = entity_window(entity, period)
    return df.withColumns({"prev_period": F.lag(period).over(win), "next_period": F.lead(period).over(win)})
