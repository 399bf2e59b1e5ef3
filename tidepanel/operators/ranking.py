"""Top-N, exact distributed row numbers, n-tiles and percentiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.operators.joins import broadcast_bounded


def top_n(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows of each group. Catalyst limits each map task to n rows per
    group before the shuffle, so a hot group stays small."""
    win = Window.partitionBy(*group).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(win)).where(F.col(rank) <= n)


def _cut_points(df: DataFrame, key: Column, tie: str, group: list[str], slices: int) -> DataFrame:
    """A repeatable random sample of ``slices - 1`` sort keys per group, as one array.

    The rows with the smallest hash of the unique column are taken: a bounded
    top-k, limited in every map task before the shuffle."""
    draw = df.select(*group, F.xxhash64(tie).alias("_hash"), key.alias("_key"))
    if group:
        sample = top_n(draw, group, [F.col("_hash"), F.col("_key")], slices - 1)
    else:
        sample = draw.orderBy("_hash", "_key").limit(slices - 1)
    return sample.groupBy(*group).agg(F.collect_list("_key").alias("_cuts"))


def _same(columns: Sequence[str], prefix: str) -> Column:
    test = F.lit(True)
    for name in columns:
        test = test & F.col(name).eqNullSafe(F.col(f"{prefix}{name}"))
    return test


def with_row_number(
    df: DataFrame, order: str, tie: str, group: Sequence[str] = (), slices: int = 64,
    rank: str = "rank", total: str = "total", max_groups: int | None = None,
) -> DataFrame:
    """Exact row number by (order, tie) inside each group, and the group size.

    A plain window would sort a whole group (without a group, the whole table) in
    one task. Here sampled sort keys cut each group into slices; slices are ranked
    in parallel and shifted by the number of rows before them. The sample only
    decides the balance: any cut gives the exact rank. ``tie`` must be unique, so
    a value shared by many rows is cut as well. NULL sorts first. The slice table
    has ``slices`` rows per group; it is broadcast when ``max_groups`` bounds it.
    """
    group = list(group)
    groups = max_groups if group else 1
    key = F.struct(F.col(order).alias("a"), F.col(tie).alias("b"))
    cuts = _cut_points(df, key, tie, group, slices)
    if group:
        renamed = cuts.select(*[F.col(g).alias(f"_g_{g}") for g in group], "_cuts")
        if groups:
            renamed = broadcast_bounded(renamed, groups, row_bytes=64 * slices)
        cut = df.join(renamed, _same(group, "_g_")).drop(*[f"_g_{g}" for g in group])
    else:
        cut = df.withColumn("_cuts", cuts.scalar())
    sliced = cut.withColumn("_slice", F.size(F.filter("_cuts", lambda c: c < key))).drop("_cuts")

    place = [*group, "_slice"]
    before = Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sliced.groupBy(*place).agg(F.count("*").alias("_n")).select(
        *[F.col(p).alias(f"_o_{p}") for p in place],
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"),
        F.sum("_n").over(Window.partitionBy(*group)).alias(total),
    )
    if groups:
        offsets = broadcast_bounded(offsets, groups * slices)
    inside = Window.partitionBy(*place).orderBy(F.col(order).asc_nulls_first(), F.col(tie))
    return (
        sliced.withColumn("_inside", F.row_number().over(inside))
        .join(offsets, _same(place, "_o_"))
        .withColumn(rank, F.col("_before") + F.col("_inside"))
        .drop("_slice", "_inside", "_before", *[f"_o_{p}" for p in place])
    )


def ntile_of(rank: Column, total: Column, n: int) -> Column:
    """The NTILE(n) number of a row number: the first total mod n tiles get one row more."""
    size, extra = F.floor(total / n), total % n
    split = extra * (size + 1)
    return F.when(rank <= split, F.floor((rank - 1) / (size + 1)) + 1).otherwise(
        extra + F.floor(F.try_divide(rank - 1 - split, size)) + 1
    )


def with_ntile(df: DataFrame, n: int, order: str, tie: str, out: str, group: Sequence[str] = ()) -> DataFrame:
    ranked = with_row_number(df, order, tie, group, rank="_rank", total="_total")
    return ranked.withColumn(out, ntile_of(F.col("_rank"), F.col("_total"), n)).drop("_rank", "_total")


def percentiles(
    df: DataFrame, group: Sequence[str], value: str, tie: str, fractions: dict[str, float], max_groups: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles per group from distributed row numbers.

    Partial aggregates combine map-side, so the rows of a group never meet in one task.
    """
    ranked = with_row_number(df.where(F.col(value).isNotNull()), value, tie, group, rank="_rank", total="_total", max_groups=max_groups)
    aggs = []
    for name, q in fractions.items():
        place = (F.col("_total") - 1) * F.lit(q)
        low, high = F.floor(place) + 1, F.ceil(place) + 1
        below = F.max(F.when(F.col("_rank") == low, F.col(value)))
        above = F.max(F.when(F.col("_rank") == high, F.col(value)))
        weight = F.max(place - F.floor(place))
        aggs.append((below + (above - below) * weight).alias(name))
    return ranked.groupBy(*group).agg(F.max("_total").alias("n"), *aggs)
