"""Panel, ranking, de-duplication and join operators on small frames, against plain Python."""

import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import dedup, joins, panel, quality, ranking
from tidepanel.plans import concentration


def gap_panel(spark):
    rows = [(1, 2000, 5.0), (1, 2001, 6.0), (1, 2003, 7.0), (1, 2004, 4.0), (1, 2005, 3.0), (2, 2000, 9.0)]
    return spark.createDataFrame(rows, "id int, year int, v double")


def by_key(df, *cols):
    return {(r.id, r.year): tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.collect()}


def test_row_lag_skips_gaps_but_calendar_lag_does_not(spark):
    df = panel.with_lags(gap_panel(spark), "id", "year", "v", [1, 2])
    df = panel.with_calendar_lag(df, "id", "year", "v", 1, "cal")
    got = by_key(df, "v_lag1", "v_lag2", "cal")
    assert got[(1, 2003)] == (6.0, 5.0, None)
    assert got[(1, 2004)] == (7.0, 6.0, 7.0)
    assert got[(2, 2000)] == (None, None, None)


def test_growth_and_difference(spark):
    df = panel.with_growth(gap_panel(spark), "id", "year", "v", "g")
    df = panel.with_difference(df, "id", "year", "v", "d")
    got = by_key(df, "g", "d")
    assert got[(1, 2001)] == (pytest.approx(20.0), 1.0)
    assert got[(1, 2000)] == (None, None)


def test_incomplete_windows_are_visible(spark):
    got = by_key(panel.with_rolling(gap_panel(spark), "id", "year", "v", 3), "roll_count", "roll_mean", "roll_std")
    assert got[(1, 2003)][0] == 2  # 2001 and 2003: the gap year is missing
    count, mean, std = got[(1, 2005)]
    assert (count, mean) == (3, pytest.approx(14 / 3))
    assert std == pytest.approx(statistics.pstdev([7.0, 4.0, 3.0]))


def test_streak_counts_rows(spark):
    got = by_key(panel.with_streak(gap_panel(spark), "id", "year", F.col("v") < 6.5, 3), "streak")
    assert [got[(1, y)] for y in (2000, 2001, 2003, 2004, 2005)] == [1, 2, 2, 2, 2]


def test_monotone_decline_needs_history(spark):
    got = by_key(panel.with_monotone_decline(gap_panel(spark), "id", "year", "v"), "declining")
    assert [got[(1, y)] for y in (2000, 2001, 2003, 2004, 2005)] == [None, None, 0, 0, 1]


def test_period_count_ignores_repeats(spark):
    df = gap_panel(spark).unionByName(spark.createDataFrame([(2, 2000, 1.0)], "id int, year int, v double"))
    assert set(by_key(panel.with_period_count(df, "id", "year", "n"), "n").values()) == {5, 1}


def test_latest_per_entity(spark):
    got = {r.id: (r.year, r.v) for r in panel.latest_per_entity(gap_panel(spark), "id", "year", ["v"]).collect()}
    assert got == {1: (2005, 3.0), 2: (2000, 9.0)}


def test_duplicate_periods_are_reported(spark):
    df = spark.createDataFrame([(1, 2000), (1, 2000), (1, 2001), (None, 2001)], "id int, year int")
    assert [(r.id, r.year, r.rows) for r in quality.duplicate_keys(df, ["id", "year"]).collect()] == [(1, 2000, 2)]
    assert quality.key_report(df, ["id", "year"], "t").first().asDict() == {
        "table_name": "t", "rows": 4, "distinct_keys": 3, "repeated_rows": 1, "null_key_rows": 1,
    }
    assert quality.null_counts(df, ["id", "year"]).first().asDict() == {"id_nulls": 1, "year_nulls": 0}


def test_top_n_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("a", i, 1.0) for i in range(6)], "g string, id int, w double")
    got = ranking.top_n(df, ["g"], [F.col("w").desc(), F.col("id")], 3).collect()
    assert sorted(r.id for r in got) == [0, 1, 2]


@pytest.mark.parametrize("shape", ["spread", "ties", "nulls", "tiny"])
def test_distributed_row_number_is_exact(spark, shape):
    rng = random.Random(7)
    n = 3 if shape == "tiny" else 2000
    draw = {"spread": lambda: rng.random(), "ties": lambda: 0.0 if rng.random() < 0.4 else rng.randint(0, 5) * 1.0,
            "nulls": lambda: None if rng.random() < 0.3 else rng.random(), "tiny": lambda: rng.random()}[shape]
    rows = [(i, draw()) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, v double").repartition(5)
    got = {r.id: (r.rank, r.total) for r in ranking.with_row_number(df, "v", "id", slices=16).collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0.0, r[0]))
    assert got == {r[0]: (i + 1, n) for i, r in enumerate(order)}


def test_hot_values_are_spread_over_slices(spark):
    """A value held by most rows must not end up in one slice."""
    df = spark.range(4000).select("id", F.when(F.col("id") % 3 == 0, F.col("id").cast("double")).otherwise(0.0).alias("v"))
    key = F.struct(F.col("v").alias("a"), F.col("id").alias("b"))
    cuts = ranking._cut_points(df, key, "id", [], 32)
    sliced = df.withColumn("_cuts", cuts.scalar()).withColumn("s", F.size(F.filter("_cuts", lambda c: c < key)))
    sizes = [r["count"] for r in sliced.groupBy("s").count().collect()]
    assert max(sizes) < 4000 / 5


def test_grouped_row_number_and_percentiles(spark):
    rng = random.Random(3)
    rows = [(g, i, float(rng.randint(0, 30))) for g in ("x", "y", None) for i in range(150)]
    df = spark.createDataFrame(rows, "g string, id long, v double")
    got = {(r.g, r.id): r.rank for r in ranking.with_row_number(df, "v", "id", ["g"], slices=8).collect()}
    for g in ("x", "y", None):
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (r[2], r[1]))
        assert [got[(g, r[1])] for r in order] == list(range(1, 151))
    p = {r.g: r for r in ranking.percentiles(df, ["g"], "v", "id", {"p25": 0.25, "p50": 0.5}).collect()}
    for g in ("x", "y", None):
        want = statistics.quantiles([r[2] for r in rows if r[0] == g], n=4, method="inclusive")
        assert (p[g].p25, p[g].p50) == (pytest.approx(want[0]), pytest.approx(want[1]))


@pytest.mark.parametrize("n", [1, 3, 4, 5, 10, 103])
def test_ntile_sizes(spark, n):
    df = spark.range(n).select("id", (F.col("id") % 3).cast("double").alias("v"))
    want = {r.id: r.t for r in df.selectExpr("id", "ntile(4) over (order by v, id) t").collect()}
    assert {r.id: r.t for r in ranking.with_ntile(df, 4, "v", "id", "t").collect()} == want


def test_dedup_first_last_and_idempotence(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("l", 5, "c"), (None, 1, "d"), (None, 2, "e")], "k string, o int, v string")
    first = dedup.first_wins(df, ["k"], [F.col("o")])
    assert sorted(r.v for r in first.collect()) == ["a", "c", "d"]
    assert sorted(r.v for r in dedup.last_wins(df, ["k"], [F.col("o")]).collect()) == ["b", "c", "e"]
    assert set(dedup.first_wins(first, ["k"], [F.col("o")]).collect()) == set(first.collect())


def test_surrogate_keys_follow_the_natural_order(spark):
    names = [f"{w}{i}" for i in range(300) for w in ("T", "Zed ")]
    df = spark.createDataFrame([(n,) for n in names], "ticker string").repartition(7)
    got = {r.ticker: r.key for r in dedup.with_surrogate_key(df, "ticker", "key").collect()}
    assert got == {n: i + 1 for i, n in enumerate(sorted(names))}


def test_orphans_count_rows_and_skip_null(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "fk int")
    parent = spark.createDataFrame([(2,)], "pk int")
    assert [tuple(r) for r in joins.orphans(child, "fk", parent, "pk").collect()] == [(1, 2)]


def test_broadcast_hint_only_within_the_bound(spark):
    small = joins.broadcast_bounded(spark.range(3), 10)
    large = joins.broadcast_bounded(spark.range(3), 1 << 40)
    assert "Hint broadcast" in small._jdf.queryExecution().logical().toString()
    assert "Hint" not in large._jdf.queryExecution().logical().toString()


def test_asof_join_takes_the_latest_known_row(spark):
    left = spark.createDataFrame([(1, date(2005, 1, 10)), (1, date(2005, 3, 1)), (2, date(2005, 1, 1))], "id int, d date")
    right = spark.createDataFrame(
        [(1, date(2005, 1, 10), 1.0), (1, date(2005, 2, 1), None), (1, date(2005, 4, 1), 9.0), (3, date(2000, 1, 1), 5.0)],
        "id int, a date, x double",
    )
    got = {(r.id, r.d): (r.asof_a, r.x) for r in joins.asof_join(left, right, "id", "d", "a", ["x"]).collect()}
    assert got == {
        (1, date(2005, 1, 10)): (date(2005, 1, 10), 1.0),  # the same day counts
        (1, date(2005, 3, 1)): (date(2005, 2, 1), None),  # a known row with a NULL value is not skipped
        (2, date(2005, 1, 1)): (None, None),
    }


def test_membership_entry_and_exit_years(spark):
    years = {1: [2001, 2002, 2003], 2: [2001, 2003], 3: [2002], 4: [2003]}
    rows = [("UKX", c, date(y, 12, 31)) for c, ys in years.items() for y in ys] + [("SPX", 9, date(2001, 12, 31))]
    df = spark.createDataFrame(rows, "index_id string, company_id long, as_of_date date")
    got = sorted(tuple(r) for r in concentration.membership_changes(df, "UKX", 2003).collect())
    assert got == [
        (1, 2001, "ENTRY"), (2, 2001, "ENTRY"), (2, 2001, "EXIT"), (2, 2003, "ENTRY"),
        (3, 2002, "ENTRY"), (3, 2002, "EXIT"), (4, 2003, "ENTRY"),
    ]
    counts = {r.year: (r.entries, r.exits) for r in concentration.churn_counts(df, "UKX", 2003).collect()}
    members = {y: sum(y in ys for ys in years.values()) for y in (2001, 2002, 2003)}
    for y in (2002, 2003):  # entries of a year less exits stamped on the year before
        assert counts[y][0] - counts[y - 1][1] == members[y] - members[y - 1]
