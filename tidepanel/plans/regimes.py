"""Sector returns across inflation regimes and rate moves."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions import periods
from tidepanel.functions.aggregates import beta, compound, correlation, covariance, weighted_mean
from tidepanel.functions.scalars import annualise, band_above, sign_band
from tidepanel.operators.panel import with_difference, with_growth, with_lags
from tidepanel.plans import macro as macro_plans

WEEKS_PER_MONTH = 4.33
WEEKS_PER_YEAR = 52

# Regime and sensitivity labels.
HIGH, LOW = "High Inflation", "Low Inflation"
CHART_HIGH, CHART_LOW = "High Inflation (CPI>3%)", "Low Inflation (CPI≤3%)"
CPI_LABELS = ("Positive (Inflation Beneficiary)", "Negative (Inflation Sensitive)", "Neutral")
RATE_LABELS = ("Rate Beneficiary", "Rate Sensitive (Duration Risk)", "Rate Neutral")
TOLERANCE = 0.001


def sector_prices(prices: DataFrame, companies: DataFrame, country: str | None = "US", keep_unknown: bool = False) -> DataFrame:
    """Weekly returns with the sector of the company, for one country."""
    firms = companies if country is None else companies.where(F.col("country_id") == country)
    if not keep_unknown:
        firms = firms.where(F.col("gics_sector_name").isNotNull())
    return prices.join(firms.select("company_id", "gics_sector_name"), "company_id")


def monthly_sector_returns(prices: DataFrame, companies: DataFrame, country: str = "US", keep_unknown: bool = False) -> DataFrame:
    return (
        sector_prices(prices, companies, country, keep_unknown)
        .groupBy(periods.month_start("price_date").alias("month"), "gics_sector_name")
        .agg(F.avg("total_return").alias("avg_weekly_return"), F.count("*").alias("weeks"))
    )


def weekly_sector_returns(prices: DataFrame, companies: DataFrame, country: str = "US") -> DataFrame:
    return (
        sector_prices(prices, companies, country)
        .groupBy("price_date", "gics_sector_name")
        .agg(F.avg("total_return").alias("sector_return"))
    )


def monthly_cpi(macro: DataFrame, country: str = "US", threshold: float = 3, high: str = HIGH, low: str = LOW) -> DataFrame:
    cpi = macro_plans.monthly(macro, macro_plans.CPI_YOY, "cpi_yoy", country)
    return cpi.withColumn("inflation_regime", band_above("cpi_yoy", [(threshold, high)], low))


def inflation_regime(prices: DataFrame, companies: DataFrame, macro: DataFrame, country: str = "US", threshold: float = 3) -> DataFrame:
    """Per regime and sector: months, mean CPI, mean monthly and annualised return."""
    cpi = monthly_cpi(macro, country, threshold).select("month", "cpi_yoy", "inflation_regime")
    return (
        monthly_sector_returns(prices, companies, country)
        .join(cpi, "month")
        .groupBy("inflation_regime", "gics_sector_name")
        .agg(
            F.count("*").alias("months"), F.round(F.avg("cpi_yoy"), 2).alias("avg_cpi"),
            F.round(annualise(F.avg("avg_weekly_return"), WEEKS_PER_MONTH), 4).alias("avg_monthly_return_pct"),
            F.round(annualise(F.avg("avg_weekly_return"), WEEKS_PER_YEAR), 2).alias("annualized_return_pct"),
        )
        .orderBy("inflation_regime", F.desc("annualized_return_pct"), "gics_sector_name")
    )


def regime_returns(
    prices: DataFrame, companies: DataFrame, macro: DataFrame, country: str = "US", threshold: float = 3,
    high: str = HIGH, low: str = LOW, keep_unknown: bool = True,
) -> DataFrame:
    """Per regime and sector: mean of monthly returns annualised first; unknown sectors may stay."""
    returns = monthly_sector_returns(prices, companies, country, keep_unknown).withColumn(
        "ann_return", annualise("avg_weekly_return", WEEKS_PER_YEAR)
    )
    cpi = monthly_cpi(macro, country, threshold, high, low).select("month", "inflation_regime")
    return (
        returns.join(cpi, on="month")
        .groupBy(F.col("inflation_regime").alias("regime"), "gics_sector_name")
        .agg(F.avg("ann_return").alias("ann_return"))
    )


def regime_report(prices: DataFrame, companies: DataFrame, macro: DataFrame) -> DataFrame:
    rows = regime_returns(prices, companies, macro)
    return rows.select("regime", "gics_sector_name", F.round("ann_return", 2).alias("avg_annual_return")).orderBy(
        "regime", F.desc("avg_annual_return"), "gics_sector_name"
    )


def regime_pivot(prices: DataFrame, companies: DataFrame, macro: DataFrame) -> DataFrame:
    """Sectors as rows, regimes as columns, 0 where a sector has no month in a regime."""
    rows = regime_returns(prices, companies, macro, high="high_inflation", low="low_inflation", keep_unknown=False)
    return (
        rows.groupBy("gics_sector_name")
        .pivot("regime", ["high_inflation", "low_inflation"])
        .agg(F.first("ann_return"))
        .na.fill(0.0, ["high_inflation", "low_inflation"])
        .orderBy("gics_sector_name")
    )


def yoy_regime(macro: DataFrame, threshold: float = 3) -> DataFrame:
    """Months and mean year-on-year change of CPI level series per regime, every series on its own."""
    cpi = macro.where((F.col("indicator_category") == "CPI") & F.col("indicator_name").ilike("%CPI%"))
    yoy = with_growth(cpi, ["country_id", "bloomberg_ticker"], "indicator_date", "indicator_value", "cpi_yoy", 12)
    return (
        yoy.where(F.col("cpi_yoy").isNotNull())
        .groupBy(band_above("cpi_yoy", [(threshold, HIGH)], LOW).alias("regime"))
        .agg(F.count("*").alias("months"), F.round(F.avg("cpi_yoy"), 2).alias("avg_cpi_yoy"))
        .orderBy("regime")
    )


def cpi_changes(macro: DataFrame, country: str = "US") -> DataFrame:
    cpi = macro_plans.monthly(macro, macro_plans.CPI_YOY, "cpi_yoy", country)
    return with_difference(cpi, "country_id", "month", "cpi_yoy", "cpi_change").drop("country_id")


def returns_with_cpi(prices: DataFrame, companies: DataFrame, macro: DataFrame, country: str = "US") -> DataFrame:
    monthly = monthly_sector_returns(prices, companies, country).select(
        "month", "gics_sector_name", annualise("avg_weekly_return", WEEKS_PER_MONTH).alias("monthly_return")
    )
    return monthly.join(cpi_changes(macro, country), "month")


def cpi_sensitivity(prices: DataFrame, companies: DataFrame, macro: DataFrame, country: str = "US") -> DataFrame:
    """Per sector: covariance of monthly return with the change of CPI, and its sign band."""
    sums = (
        returns_with_cpi(prices, companies, macro, country)
        .where(F.col("cpi_change").isNotNull())
        .groupBy("gics_sector_name")
        .agg(
            F.count("*").alias("months"), F.round(F.avg("monthly_return"), 4).alias("avg_return"),
            F.round(F.avg("cpi_change"), 4).alias("avg_cpi_change"), covariance("monthly_return", "cpi_change").alias("cov"),
        )
    )
    return (
        sums.withColumn("return_cpi_covariance", F.round("cov", 6))
        .withColumn("cpi_sensitivity", sign_band("cov", TOLERANCE, *CPI_LABELS))
        .drop("cov")
        .orderBy(F.desc("return_cpi_covariance"), "gics_sector_name")
    )


def yield_changes(rates: DataFrame, country: str = "US") -> DataFrame:
    rows = rates.where((F.col("country_id") == country) & (F.col("rate_type") == "10Y_YIELD"))
    return with_difference(rows, "country_id", "rate_date", "rate_value", "yield_change").select(
        F.col("rate_date").alias("price_date"), "yield_change"
    )


def returns_with_yields(prices: DataFrame, companies: DataFrame, rates: DataFrame, country: str = "US") -> DataFrame:
    changes = yield_changes(rates, country).where(F.col("yield_change").isNotNull())
    return weekly_sector_returns(prices, companies, country).join(changes, "price_date")


def rate_profile(prices: DataFrame, companies: DataFrame, rates: DataFrame, country: str = "US") -> DataFrame:
    """Per sector: covariance of weekly return with the 10-year yield change, and its sign band."""
    sums = (
        returns_with_yields(prices, companies, rates, country)
        .groupBy("gics_sector_name")
        .agg(
            F.count("*").alias("weeks"), F.round(F.avg("sector_return"), 4).alias("avg_weekly_return"),
            F.round(F.avg("yield_change"), 4).alias("avg_yield_change_bp"), covariance("sector_return", "yield_change").alias("cov"),
        )
    )
    return (
        sums.withColumn("rate_sensitivity", F.round("cov", 6))
        .withColumn("rate_profile", sign_band("cov", TOLERANCE, *RATE_LABELS))
        .drop("cov")
        .orderBy("rate_sensitivity", "gics_sector_name")
    )


def leadlag_profile(
    prices: DataFrame, companies: DataFrame, macro: DataFrame, lags: list[int] = [0, 1, 2, 3], window: int = 12,
) -> DataFrame:
    """Extension. Rolling correlation of sector return with CPI change at several lags, lags ranked.

    Lags are taken along the sector's own months, then unpivoted so one window covers all."""
    rows = with_lags(returns_with_cpi(prices, companies, macro), "gics_sector_name", "month", "cpi_change", lags, "cpi")
    long = rows.unpivot(
        ["gics_sector_name", "month", "monthly_return"], [f"cpi_lag{k}" for k in lags], "series", "cpi"
    ).where(F.col("cpi").isNotNull())
    long = long.withColumn("lag", F.regexp_extract("series", r"(\d+)$", 1).cast("int"))
    frame = Window.partitionBy("gics_sector_name", "lag").orderBy("month").rowsBetween(-(window - 1), 0)
    rolled = long.withColumn("n", F.count("*").over(frame)).withColumn("corr", correlation("monthly_return", "cpi", frame))
    per_lag = rolled.where(F.col("n") == window).groupBy("gics_sector_name", "lag").agg(
        F.count("*").alias("windows"), F.round(F.avg("corr"), 6).alias("mean_correlation")
    )
    order = Window.partitionBy("gics_sector_name").orderBy(F.abs("mean_correlation").desc_nulls_last(), "lag")
    return per_lag.withColumn("lag_rank", F.row_number().over(order)).orderBy("gics_sector_name", "lag_rank")


def rolling_beta(prices: DataFrame, companies: DataFrame, rates: DataFrame, window: int = 104) -> DataFrame:
    """Extension. Beta of weekly sector return on yield change over ``window`` weeks: latest, least, greatest."""
    frame = Window.partitionBy("gics_sector_name").orderBy("price_date").rowsBetween(-(window - 1), 0)
    rolled = (
        returns_with_yields(prices, companies, rates)
        .withColumn("n", F.count("*").over(frame))
        .withColumn("beta", beta("sector_return", "yield_change", frame))
        .where(F.col("n") == window)
    )
    return (
        rolled.groupBy("gics_sector_name")
        .agg(
            F.count("*").alias("windows"), F.round(F.max_by("beta", "price_date"), 6).alias("latest_beta"),
            F.round(F.min("beta"), 6).alias("min_beta"), F.round(F.max("beta"), 6).alias("max_beta"),
        )
        .orderBy("gics_sector_name")
    )


def weighted_sector_returns(prices: DataFrame, companies: DataFrame) -> DataFrame:
    """Extension. Monthly sector return weighted by (positive) market cap beside the plain mean."""
    firms = companies.where(F.col("gics_sector_name").isNotNull()).select(
        "company_id", "gics_sector_name",
        F.when(F.col("current_market_cap") > 0, F.col("current_market_cap").cast("double")).alias("cap"),
    )
    return (
        prices.join(firms, "company_id")
        .groupBy(periods.month_start("price_date").alias("month"), "gics_sector_name")
        .agg(
            F.round(weighted_mean("total_return", "cap"), 6).alias("weighted_return"),
            F.round(F.avg("total_return"), 6).alias("equal_return"),
        )
        .select(periods.year_month("month").alias("year_month"), "gics_sector_name", "weighted_return", "equal_return")
    )


def compound_returns(prices: DataFrame) -> DataFrame:
    """Extension. Geometric yearly return of each company beside the arithmetic sum."""
    return (
        prices.where(F.col("total_return").isNotNull())
        .groupBy("company_id", F.year("price_date").alias("year"))
        .agg(
            F.count("*").alias("weeks"), F.round(compound("total_return"), 4).alias("compound_return_pct"),
            F.round(F.sum("total_return"), 4).alias("summed_return_pct"),
        )
    )
