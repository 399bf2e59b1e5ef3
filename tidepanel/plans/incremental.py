"""Studies brought up to date: from changed inputs to the results that are stale, and from those to the inputs they need."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.sources import store

Study = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Horizon:
    """What a result depends on. Inputs and results share ``keys`` and a whole-number ``period``.

    The result of period p reads the inputs of its keys from p - ``back`` to p + ``ahead``, and each of those the
    ``lag`` rows of its keys before it, however far back they are (growth to the previous row has lag 1).
    """

    keys: tuple[str, ...] = ()
    period: str = "year"
    back: int = 0
    ahead: int = 0
    lag: int = 0

    def __post_init__(self) -> None:
        if self.lag and not self.keys:
            raise ValueError("rows have an order only within keys")

    @property
    def on(self) -> list[str]:
        return [*self.keys, self.period]


#: Concentration of a year depends on that year alone, an entry on the year before, an exit on the year after.
CONCENTRATION, CHURN = Horizon(), Horizon(back=1, ahead=1)


def rolling(keys: tuple[str, ...], window: int, lag: int = 1) -> Horizon:
    """The horizon of a frame of ``window`` calendar periods over changes to the previous row."""
    return Horizon(keys, back=window - 1, lag=lag)


def _spread(df: DataFrame, h: Horizon, before: int, after: int) -> DataFrame:
    """Each (keys, period) as all periods from ``before`` earlier to ``after`` later."""
    p = F.col(h.period)
    return df.select(*h.keys, F.explode(F.sequence(p - before, p + after)).alias(h.period)).distinct()


def _flagged(panel: DataFrame, marks: DataFrame, h: Horizon) -> DataFrame:
    """One row per (keys, period) of either frame, saying which has it; only for keys that have marks."""
    keys = marks.select(*h.keys).distinct()
    ours = panel.join(keys, list(h.keys), "left_semi").select(*h.on, F.lit(1).alias("ours"), F.lit(0).alias("mark"))
    rows = ours.unionByName(marks.select(*h.on, F.lit(0).alias("ours"), F.lit(1).alias("mark")))
    return rows.groupBy(*h.on).agg(F.max("ours").alias("ours"), F.max("mark").alias("mark"))


def stale_results(inputs: DataFrame, changed: DataFrame, h: Horizon) -> DataFrame:
    """(keys, period) of all results that changed inputs take part in. ``changed`` holds keys and period of rows that
    were added, altered or removed; ``inputs`` are the rows as they are now."""
    marks = changed.select(*h.on).distinct()
    if h.lag:
        rows_before = Window.partitionBy(*h.keys).orderBy(h.period).rowsBetween(-h.lag, 0)
        marks = _flagged(inputs, marks, h).withColumn("hit", F.max("mark").over(rows_before)).where("hit = 1")
    return _spread(marks, h, h.ahead, h.back)


def needed_inputs(inputs: DataFrame, stale: DataFrame, h: Horizon) -> DataFrame:
    """The inputs that the stale results read, found by equality of keys and period."""
    wanted = _spread(stale, h, h.back, h.ahead)
    if h.lag:
        rows_after = Window.partitionBy(*h.keys).orderBy(h.period).rowsBetween(0, h.lag)
        ours = _flagged(inputs, wanted, h).where("ours = 1")
        wanted = ours.withColumn("hit", F.max("mark").over(rows_after)).where("hit = 1").select(*h.on)
    return inputs.join(wanted, h.on, "left_semi")


def recomputed(inputs: DataFrame, stale: DataFrame, h: Horizon, study: Study) -> DataFrame:
    """The study's results for stale (keys, period) only, from the inputs that they need only."""
    return study(needed_inputs(inputs, stale, h)).join(stale, h.on, "left_semi")


def refreshed(results: DataFrame, inputs: DataFrame, changed: DataFrame, h: Horizon, study: Study) -> DataFrame:
    """Earlier results with the stale ones replaced: equal to the study over all inputs."""
    stale = stale_results(inputs, changed, h)
    return results.join(stale, h.on, "left_anti").unionByName(recomputed(inputs, stale, h, study))


def refresh_stored(spark: SparkSession, table: str, inputs: DataFrame, changed: DataFrame, h: Horizon, study: Study, name: str) -> DataFrame:
    """Bring a stored result up to date and return it. Periods are its partitions, so those without a stale result
    are neither read nor written; a table that is absent is computed in full."""
    if store.current(spark, table) is None:
        results = study(inputs)
        store.create(spark, table, results.schema)
        stale = results.select(*h.on)
        store.refresh(spark, table, results, stale, h.on, F.col(h.period), name)
    else:
        stale = stale_results(inputs, changed, h)
        store.refresh(spark, table, recomputed(inputs, stale, h, study), stale, h.on, F.col(h.period), name)
    return store.read(spark, table)
