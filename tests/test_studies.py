"""Studies: properties, boundary rules and a few stored results retyped by hand."""

from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidepanel.plans import concentration, cycles, leverage, regimes, solvency
from tidepanel.sources.star import Star


@pytest.fixture(scope="module")
def star(spark):
    return Star(spark, "/root/testdata/sf0.01")


def firm(spark, rows):
    return spark.createDataFrame(rows, "company_id long, company_name string, country_id string, gics_sector_name string")


def books(spark, rows):
    cols = "company_id long, period_end_date date, period_type string, revenue double, ebitda double, interest_expense double, free_cash_flow double, total_debt double"
    return spark.createDataFrame(rows, cols)


def test_effective_positions_of_a_known_index(spark):
    # 2005: HHI 332.67 and 30.1 effective positions, unconcentrated.
    weights = [Decimal("18.239243")]
    df = spark.createDataFrame([("UKX", 1, date(2005, 12, 31), weights[0])], "index_id string, company_id long, as_of_date date, weight decimal(10,6)")
    row = concentration.hhi(df).first()
    assert (row.hhi_index, row.effective_positions, row.concentration_level) == (332.67, 30.1, "Unconcentrated")


def test_hhi_bounds(star):
    members = star.membership()
    for row in concentration.hhi(members).collect():
        assert 10000 / row.num_members - 0.01 <= row.hhi_index <= 10000
    total = members.where("index_id='UKX'").groupBy("as_of_date").agg(F.sum("weight").alias("w")).collect()
    assert all(abs(float(r.w) - 100) < 1e-3 for r in total)


def test_fraction_scale_bands_are_a_parameter(star):
    rows = concentration.hhi(star.membership(), bands=[(0.15, "Unconcentrated"), (0.25, "Moderate")]).collect()
    assert {r.concentration_level for r in rows} == {"Highly Concentrated"}


def test_members_without_weight_are_left_out(star):
    assert concentration.hhi(star.membership(), "SPX").count() == 0


def test_correlations_stay_within_one(star):
    rows = leverage.latest_correlation(star.financials("ANNUAL"), star.companies(), star.rates("POLICY_RATE"), 5, 6)
    worst = rows.agg(F.max(F.abs("roll_corr")).alias("m"), F.count("*").alias("n")).first()
    assert worst.n > 0 and worst.m <= 1 + 1e-12


def test_limit_is_a_parameter(star):
    rows = leverage.rate_sensitivity(star.financials("ANNUAL"), star.companies(), star.rates("POLICY_RATE"), 5, 6, limit=3).collect()
    assert len(rows) == 3
    assert [r.correlation_with_policy_rate for r in rows] == sorted(r.correlation_with_policy_rate for r in rows)


def test_shock_lowers_coverage_of_firms_that_earn(star):
    rows = solvency.shocked(solvency.latest_coverage(star.financials("ANNUAL"), star.companies(), 2001))
    assert rows.where((F.col("ebitda") > 0) & (F.col("shocked_icr") > F.col("icr"))).count() == 0


def test_rate_shock_thresholds(spark):
    firms = firm(spark, [(1, "a", "US", "Energy"), (2, "b", "US", "Energy"), (3, "c", "US", None), (4, "d", "US", "Financials")])
    year = date(2024, 12, 31)
    rows = books(spark, [
        (1, year, "ANNUAL", 1.0, 2.0, 1.0, 1.0, 100.0),  # 2.0 -> 1.0
        (2, year, "ANNUAL", 1.0, 1.6, 1.0, 1.0, None),  # debt unknown
        (3, year, "ANNUAL", 1.0, 1.6, 1.0, 1.0, 100.0),  # sector unknown
        (4, year, "ANNUAL", 1.0, 1.6, 1.0, 1.0, 100.0),
    ])
    out = solvency.rate_shock(rows, firms).collect()
    assert [tuple(r) for r in out] == [("US", 1, 1, 1, 2.0, 1.0, 1.0)]
    assert solvency.rate_shock(rows, firms, min_firms=2).count() == 0


def test_zombie_streak_and_macro_condition(spark):
    firms = firm(spark, [(1, "a", "US", "Energy"), (2, "b", "GB", "Energy")])
    rows = books(spark, [(c, date(y, 12, 31), "ANNUAL", 1.0, 1.0, 1.0, 1.0, 1.0) for c in (1, 2) for y in (2001, 2002, 2003)])
    gdp = spark.createDataFrame(
        [(c, date(y, 1, 1), "Real GDP (yoy %)", v) for c, ys in {"US": (3.0, 2.0, 1.0), "GB": (1.0, 2.0, 3.0)}.items() for y, v in zip((2001, 2002, 2003), ys)],
        "country_id string, indicator_date date, indicator_name string, indicator_value double",
    )
    got = [tuple(r) for r in solvency.persistent_zombies(rows, firms, gdp).collect()]
    assert got == [(2003, "US", 1, 1, 1.0, -1.0)]


def test_deleveraging_counts_firms_without_macro_rows(spark):
    firms = firm(spark, [(1, "a", "FR", "Energy")])
    rows = books(spark, [(1, date(2000 + i, 12, 31), "ANNUAL", 1.0, 1.0, 1.0, 1.0, d) for i, d in enumerate((9.0, 8.0, 7.0, 7.0))])
    gdp = spark.createDataFrame([], "country_id string, indicator_date date, indicator_name string, indicator_value double")
    got = [tuple(r) for r in leverage.deleveraging_by_phase(rows, firms, gdp).collect()]
    assert got == [(2002, None, 1, 1, 100.0), (2003, None, 1, 0, 0.0)]


def test_quartiles_differ_by_at_most_one(star):
    rows = cycles.volatility_quartiles(star.financials("ANNUAL"), star.companies(), 5, 5).collect()
    sizes = [r.company_count for r in rows]
    assert len(sizes) == 4 and max(sizes) - min(sizes) <= 1
    assert [r.avg_volatility for r in rows] == sorted(r.avg_volatility for r in rows)


def test_yoy_regime_keeps_series_apart(spark):
    rows = [("US", date(2000 + i // 12, i % 12 + 1, 1), f"CPI {s}", s, 100.0 * k * (1.05 if i >= 12 else 1.0), "CPI") for s, k in (("A", 1), ("B", 50)) for i in range(24)]
    df = spark.createDataFrame(rows, "country_id string, indicator_date date, indicator_name string, bloomberg_ticker string, indicator_value double, indicator_category string")
    assert [tuple(r) for r in regimes.yoy_regime(df).collect()] == [("High Inflation", 24, 5.0)]


def test_pivot_fills_zero(spark):
    prices = spark.createDataFrame([(1, date(2000, 1, 7), 1.0), (2, date(2000, 2, 4), 2.0)], "company_id long, price_date date, total_return double")
    firms = firm(spark, [(1, "a", "US", "Energy"), (2, "b", "US", "Utilities")])
    cpi = spark.createDataFrame([("US", date(2000, 1, 1), "CPI yoy", 4.0), ("US", date(2000, 2, 1), "CPI yoy", 1.0)], "country_id string, indicator_date date, indicator_name string, indicator_value double")
    got = [tuple(r) for r in regimes.regime_pivot(prices, firms, cpi).collect()]
    assert got == [("Energy", 52.0, 0.0), ("Utilities", 0.0, 104.0)]
