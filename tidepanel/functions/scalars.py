"""Column expressions with the null, zero and ordering rules fixed once.

All of them are built-in functions, so they stay inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def ratio(num: Column | str, den: Column | str) -> Column:
    """num / den, NULL where den is zero (ANSI mode would raise)."""
    return F.try_divide(_c(num), _c(den))


def positive_ratio(num: Column | str, den: Column | str) -> Column:
    """num / den only for a positive denominator, else NULL."""
    return F.when(_c(den) > 0, F.try_divide(_c(num), _c(den)))


def pct_change(cur: Column | str, prev: Column | str) -> Column:
    """(cur - prev) / prev * 100, NULL where prev is zero or NULL."""
    return F.try_divide(_c(cur) - _c(prev), _c(prev)) * 100


def share_pct(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def band(col: Column | str, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose upper limit is above the value (strict); else ``otherwise``.

    A NULL value gets ``otherwise``, as a searched CASE does.
    """
    value, out = _c(col), None
    for limit, label in limits:
        test = value < F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def band_above(col: Column | str, limits: Sequence[tuple[float, str]], otherwise: str) -> Column:
    """First label whose lower limit is below the value (strict); else ``otherwise``."""
    value, out = _c(col), None
    for limit, label in limits:
        test = value > F.lit(limit)
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def sign_band(col: Column | str, tolerance: float, positive: str, negative: str, neutral: str) -> Column:
    value = _c(col)
    return (
        F.when(value > F.lit(tolerance), F.lit(positive))
        .when(value < F.lit(-tolerance), F.lit(negative))
        .otherwise(F.lit(neutral))
    )


def label_in(col: Column | str, labels: Mapping[str, Sequence], otherwise: str) -> Column:
    """Label by membership in value lists; the first matching list wins."""
    value, out = _c(col), None
    for label, values in labels.items():
        test = value.isin(list(values))
        out = F.when(test, F.lit(label)) if out is None else out.when(test, F.lit(label))
    return out.otherwise(F.lit(otherwise))


def clip_upper(col: Column | str, upper: float) -> Column:
    """Values above ``upper`` become ``upper``; NULL stays NULL (``least`` would not keep it)."""
    value = _c(col)
    return F.when(value > F.lit(upper), F.lit(upper)).otherwise(value)


def annualise(weekly_return: Column | str, periods: float = 52) -> Column:
    """Arithmetic scaling of a mean weekly return (52 for years, 4.33 for months)."""
    return _c(weekly_return) * F.lit(float(periods))


def excludes(col: Column | str, value: str) -> Column:
    """Inequality that also rejects NULL (three-valued logic)."""
    return _c(col) != F.lit(value)
