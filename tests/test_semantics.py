"""Null, zero, tie and ordering rules on hand-made frames. ANSI mode is on."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidepanel.functions import aggregates as A
from tidepanel.functions import cleaning, periods
from tidepanel.functions import scalars as S


def values(df, *cols):
    return [tuple(row[c] for c in cols) if len(cols) > 1 else row[cols[0]] for row in df.collect()]


def test_ansi_is_on(spark):
    assert spark.conf.get("spark.sql.ansi.enabled") == "true"


def test_ratios_are_true_division_and_guarded(spark):
    df = spark.createDataFrame([(1, 7.0, 2.0), (2, 7.0, 0.0), (3, 7.0, -2.0), (4, 7.0, None)], "i int, n double, d double").orderBy("i")
    out = df.select(S.ratio("n", "d").alias("r"), S.positive_ratio("n", "d").alias("p"), S.pct_change("n", "d").alias("g"))
    assert values(out, "r") == [3.5, None, -3.5, None]
    assert values(out, "p") == [3.5, None, None, None]
    assert values(out, "g") == [250.0, None, -450.0, None]


def test_integer_inputs_divide_truly(spark):
    assert values(spark.sql("select 7 as n, 2 as d").select(S.ratio("n", "d").alias("r")), "r") == [3.5]


def test_bands_are_strict_and_null_falls_through(spark):
    df = spark.createDataFrame([(1, 1499.9), (2, 1500.0), (3, 2500.0), (4, None)], "i int, h double").orderBy("i")
    out = df.select(S.band("h", [(1500, "low"), (2500, "mid")], "high").alias("b"), S.band_above("h", [(2000, "big")], "small").alias("a"))
    assert values(out, "b") == ["low", "mid", "high", "high"]
    assert values(out, "a") == ["small", "small", "big", "small"]


def test_sign_band_tolerance_is_neutral(spark):
    df = spark.createDataFrame([(1, 0.001), (2, 0.0011), (3, -0.001), (4, -0.2)], "i int, c double").orderBy("i")
    assert values(df.select(S.sign_band("c", 0.001, "pos", "neg", "flat").alias("b")), "b") == ["flat", "pos", "flat", "neg"]


def test_label_in(spark):
    df = spark.createDataFrame([(2008,), (2021,), (2015,)], "y int")
    got = values(df.select("y", S.label_in("y", {"Crisis": [2008, 2020], "Boom": [2021]}, "Normal").alias("l")), "y", "l")
    assert sorted(got) == [(2008, "Crisis"), (2015, "Normal"), (2021, "Boom")]


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(1, 99.0), (2, 5.0), (3, None)], "i int, x double").orderBy("i")
    assert values(df.select(S.clip_upper("x", 80).alias("c")), "c") == [80.0, 5.0, None]


def test_sector_exclusion_drops_null(spark):
    df = spark.createDataFrame([("Financials",), ("Energy",), (None,)], "s string")
    assert values(df.where(S.excludes("s", "Financials")), "s") == ["Energy"]


def test_round_is_half_away_from_zero(spark):
    df = spark.sql("select 2.5D as a, -2.5D as b, 0.125D as c")
    assert df.select(F.round("a", 0), F.round("b", 0), F.round("c", 2)).first()[0:3] == (3.0, -3.0, 0.13)


def test_pattern_ignores_case(spark):
    from tidepanel.plans import macro

    df = spark.createDataFrame(
        [("US", "real gdp growth (YOY)"), ("US", "Real GDP (qoq %)"), ("GB", "REAL GDP yoy")], "country_id string, indicator_name string"
    )
    assert macro.series(df, macro.REAL_GDP_YOY).count() == 2
    assert macro.series(df, macro.REAL_GDP_YOY, "GB").count() == 1


def test_correlation_of_constant_is_null_not_an_error(spark):
    df = spark.createDataFrame([(float(i), 3.0) for i in range(5)], "x double, y double")
    assert df.agg(A.correlation("x", "y").alias("c")).first().c is None


def test_correlation_uses_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (3.0, 6.0), (100.0, None), (None, 7.0)], "x double, y double")
    assert df.agg(A.correlation("x", "y").alias("c")).first().c == pytest.approx(1.0)


def test_near_constant_sigma_is_never_nan(spark):
    df = spark.createDataFrame([(0.1 + 0.2,)] * 10, "x double")
    assert df.agg(F.stddev_pop("x").alias("s")).first().s == 0.0


def test_covariance_means_use_own_known_values(spark):
    df = spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (None, 8.0)], "x double, y double")
    got = df.agg(A.covariance("x", "y").alias("c"), (F.avg(F.col("x") * F.col("y")) - F.avg("x") * F.avg("y")).alias("m")).first()
    assert got.c == pytest.approx(got.m)


def test_exact_sum_is_exact_past_the_long_range(spark):
    big = 2**62
    df = spark.range(8).select(F.lit(big).alias("v"))
    assert df.agg(A.exact_sum(F.col("v")).alias("s")).first().s == float(8 * big)
    mixed = spark.createDataFrame([(-5,), (3,), (-(2**40),), (None,)], "v long")
    assert mixed.agg(A.exact_sum(F.col("v")).alias("s")).first().s == float(-2 - 2**40)
    assert mixed.where("v is null").agg(A.exact_sum(F.col("v")).alias("s")).first().s is None


def test_parts_roll_up_to_the_same_sum(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("a"), (F.col("id") % 2).alias("b"), (F.col("id") * 1000003 - 400000000).alias("v"))
    fine = df.groupBy("a", "b").agg(*A.sum_parts(F.col("v"), "v"))
    got = fine.groupBy("a").agg(*A.merge_parts("v")).select("a", A.whole("v").alias("s")).collect()
    want = df.groupBy("a").agg(F.sum("v").alias("s")).collect()
    assert {r.a: r.s for r in got} == {r.a: float(r.s) for r in want}


def test_string_list_is_ordered(spark):
    df = spark.createDataFrame([("b", 2), ("a", 1), ("b", 3)], "s string, r int")
    assert df.agg(A.string_list("s").alias("l")).first().l == "a, b, b"
    assert df.agg(A.string_list("s", order="r desc").alias("l")).first().l == "b, b, a"
    assert df.agg(A.string_list("s", distinct=True, sep=",").alias("l")).first().l == "a,b"


def test_compounding_and_weights(spark):
    df = spark.createDataFrame([(10.0, 1.0), (-50.0, 3.0), (None, 100.0)], "r double, w double")
    got = df.agg(A.compound("r").alias("c"), A.weighted_mean("r", "w").alias("m")).first()
    assert got.c == pytest.approx(-45.0)
    assert got.m == pytest.approx(-35.0)


def test_null_tokens_and_numbers(spark):
    raw = [" #N/A ", "--", "N/A", "", "#N/A Requesting Data...", None, "1,234.5", " -7 ", "abc", "1e3"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(raw)], "i int, v string").orderBy("i")
    out = df.select(cleaning.null_if_token("v").alias("t"), cleaning.to_number("v").alias("n"), cleaning.is_reject("v", cleaning.to_number("v")).alias("r"))
    assert values(out, "t") == [None] * 6 + ["1,234.5", "-7", "abc", "1e3"]
    assert values(out, "n") == [None] * 6 + [1234.5, -7.0, None, 1000.0]
    assert values(out, "r") == [False] * 8 + [True, False]


def test_dates_in_six_formats(spark):
    cases = {
        "2005-12-31": date(2005, 12, 31), "03/04/2005": date(2005, 3, 4), "31/12/2005": date(2005, 12, 31),
        "2005/7/9": date(2005, 7, 9), "03-04-2005": date(2005, 4, 3), "12-31-2005": date(2005, 12, 31),
        " 2005-1-2 ": date(2005, 1, 2), "2005-13-01": None, "02/30/2005": None, "30/02/2005": None,
        "31-04-2005": None, "04-31-2005": None, "n.a.": None, "20051231": None, "2005-01-02x": None,
    }
    df = spark.createDataFrame([(k,) for k in cases], "v string")
    got = {r.v: r.d for r in df.select("v", cleaning.to_date("v").alias("d")).collect()}
    assert got == cases


def test_categories_first_match_wins(spark):
    cases = {
        "Real GDP Price Index": "GDP", "Producer price, employment goods": "CPI", "Unemployment Rate": "Employment",
        "Housing Starts": "Housing", "10Y Yield": "Rates", "Exports": "Trade", "Sentiment": "Other",
    }
    df = spark.createDataFrame([(k,) for k in cases], "n string")
    assert {r.n: r.c for r in df.select("n", cleaning.category("n").alias("c")).collect()} == cases


def test_column_helpers(spark):
    df = spark.createDataFrame([(" x ", 1)], "` Ticker ` string, n int")
    assert cleaning.trim_strings(df).first().asDict() == {"Ticker": "x", "n": 1}
    assert cleaning.resolve_column(cleaning.trim_names(df), "Ticker", "ticker") == "Ticker"
    with pytest.raises(ValueError):
        cleaning.resolve_column(df, "other")
    with pytest.raises(ValueError):
        cleaning.keep_known(df, ["Ticker"], ["Ticker"])


def test_period_buckets(spark):
    df = spark.createDataFrame([(date(2005, 3, 31),), (date(2005, 4, 1),), (date(2005, 12, 31),)], "d date")
    out = df.select(periods.year_quarter("d").alias("q"), periods.year_month("d").alias("m"), periods.week_friday("d").alias("f"))
    assert values(out, "q") == ["2005-Q1", "2005-Q2", "2005-Q4"]
    assert values(out, "m") == ["2005-03", "2005-04", "2005-12"]
    assert values(out, "f") == [date(2005, 4, 1), date(2005, 4, 1), date(2005, 12, 30)]
