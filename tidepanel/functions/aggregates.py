"""Aggregate expressions: exact sums, guarded moments, ordered string lists."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 20
_LOW = (1 << _SHIFT) - 1


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def scaled(col: Column | str, factor: int = 100) -> Column:
    """Non-negative number with a fixed count of decimals -> integer units (cents)."""
    return (_c(col) * F.lit(factor) + F.lit(0.5)).cast("long")


def sum_parts(units: Column, name: str) -> list[Column]:
    """Two long sums (high and low bits) that together hold the sum of ``units``.

    A sum of doubles depends on the order of the rows, a wide decimal sum boxes
    every value, and one long sum can overflow on a hot key. Two long sums are
    exact, order-free and stay in codegen; both parts have room for 2**43 rows.
    """
    return [
        F.sum(F.shiftright(units, _SHIFT)).alias(f"{name}_hi"),
        F.sum(units.bitwiseAND(F.lit(_LOW).cast("long"))).alias(f"{name}_lo"),
    ]


def merge_parts(name: str) -> list[Column]:
    """Roll parts up to a coarser group."""
    return [F.sum(f"{name}_hi").alias(f"{name}_hi"), F.sum(f"{name}_lo").alias(f"{name}_lo")]


def whole(name: str, scale: int = 1) -> Column:
    """The sum held in the parts as a double, divided by ``scale``."""
    total = F.col(f"{name}_hi").cast("double") * float(1 << _SHIFT) + F.col(f"{name}_lo").cast("double")
    return total / F.lit(float(scale))


def exact_sum(units: Column, scale: int = 1) -> Column:
    """Sum of integer units as one aggregate expression."""
    hi = F.sum(F.shiftright(units, _SHIFT)).cast("double")
    lo = F.sum(units.bitwiseAND(F.lit(_LOW).cast("long"))).cast("double")
    return (hi * float(1 << _SHIFT) + lo) / F.lit(float(scale))


def _paired(x: Column, y: Column) -> tuple[Column, Column]:
    return F.when(y.isNotNull(), x), F.when(x.isNotNull(), y)


def covariance(x: Column | str, y: Column | str) -> Column:
    """E[xy] - E[x]E[y], where each mean is over that column's own known values.

    This is the moment form of the studies. It is computed as the stable pairwise
    covariance plus a correction that is zero unless one side alone is NULL.
    """
    x, y = _c(x), _c(y)
    px, py = _paired(x, y)
    return F.covar_pop(x, y) + (F.avg(px) * F.avg(py) - F.avg(x) * F.avg(y))


def correlation(x: Column | str, y: Column | str, over=None) -> Column:
    """Population correlation, NULL for a constant series.

    ``corr`` raises a division error under ANSI mode when one side is constant.
    """
    px, py = _paired(_c(x), _c(y))
    parts = [F.covar_pop(_c(x), _c(y)), F.stddev_pop(px), F.stddev_pop(py)]
    if over is not None:
        parts = [p.over(over) for p in parts]
    return F.try_divide(parts[0], parts[1] * parts[2])


def beta(y: Column | str, x: Column | str, over=None) -> Column:
    """Slope of y on x (population moments), NULL for a constant x."""
    px, _ = _paired(_c(x), _c(y))
    parts = [F.covar_pop(_c(y), _c(x)), F.var_pop(px)]
    if over is not None:
        parts = [p.over(over) for p in parts]
    return F.try_divide(parts[0], parts[1])


def string_list(col: str, order: str | None = None, distinct: bool = False, sep: str = ", ") -> Column:
    """Ordered string aggregation, so the text is the same on every run.

    Meant for groups of bounded size (members of an index, sectors)."""
    word = "DISTINCT " if distinct else ""
    return F.expr(f"listagg({word}{col}, '{sep}') WITHIN GROUP (ORDER BY {order or col})")


def count_where(test: Column) -> Column:
    return F.count_if(test)


def compound(ret_pct: Column | str) -> Column:
    """Geometric compounding of percent returns, in percent."""
    return (F.exp(F.sum(F.log1p(_c(ret_pct) / 100))) - 1) * 100


def weighted_mean(value: Column | str, weight: Column | str) -> Column:
    v, w = _c(value), _c(weight)
    both = v.isNotNull() & w.isNotNull()
    return F.try_divide(F.sum(F.when(both, v * w)), F.sum(F.when(both, w)))
