"""Stale results and needed inputs against full computation; declared rules on planted errors."""

import random

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import panel, quality
from tidepanel.plans import incremental
from tidepanel.sources import store


def rolling_growth(rows):
    out = panel.with_growth(rows, "company_id", "year", "v", "growth")
    return panel.with_rolling(out, "company_id", "year", "growth", 3).select(
        "company_id", "year", F.round("roll_mean", 9).alias("mean"), "roll_count")


def panel_rows(rng):
    return {(c, y): rng.randint(1, 9) for c in range(6) for y in range(1990, 2004) if rng.random() < 0.7}


def frame(spark, rows):
    return spark.createDataFrame([(c, y, float(v)) for (c, y), v in rows.items()], "company_id long, year int, v double")


def keys(spark, pairs):
    return spark.createDataFrame(list(pairs), "company_id long, year int")


def collected(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("seed", [1, 2])
def test_rolling_growth_after_added_changed_and_removed_rows(spark, seed):
    rng = random.Random(seed)
    old = panel_rows(rng)
    new, changed = dict(old), set()
    for key in rng.sample(sorted(old), 4):
        changed.add(key)
        if rng.random() < 0.5:
            del new[key]
        else:
            new[key] = old[key] + 1
    new[2, 2004] = 5
    changed.add((2, 2004))
    h = incremental.rolling(("company_id",), 3)
    before, now = frame(spark, old), frame(spark, new)
    out = incremental.refreshed(rolling_growth(before), now, keys(spark, changed), h, rolling_growth)
    assert collected(out) == collected(rolling_growth(now))
    # All that changed is stale, and only companies with a change are read.
    stale = {tuple(r) for r in incremental.stale_results(now, keys(spark, changed), h).collect()}
    was, is_ = ({tuple(r)[:2]: tuple(r)[2:] for r in rolling_growth(f).collect()} for f in (before, now))
    assert {k for k in was.keys() | is_.keys() if was.get(k) != is_.get(k)} <= stale
    needed = incremental.needed_inputs(now, keys(spark, stale), h)
    assert {r["company_id"] for r in needed.collect()} <= {c for c, _ in changed} and needed.count() < len(new)


def test_year_horizon_reads_neighbours_only(spark):
    rows = keys(spark, [(1, y) for y in range(1990, 2000)])
    stale = incremental.stale_results(rows, rows.where("year = 1995"), incremental.CHURN)
    assert collected(stale) == [(1994,), (1995,), (1996,)]
    assert sorted(r["year"] for r in incremental.needed_inputs(rows, stale, incremental.CHURN).collect()) == list(range(1993, 1998))
    with pytest.raises(ValueError):
        incremental.Horizon(lag=1)


def test_stored_study_loses_what_has_no_inputs_left(spark, tmp_path):
    table, h = f"file://{tmp_path}/study", incremental.Horizon()
    count = lambda rows: rows.groupBy("year").agg(F.count("*").alias("n"))
    rows = keys(spark, [(1, 1990), (2, 1990), (1, 1991), (1, 1992)])
    incremental.refresh_stored(spark, table, rows, rows, h, count, "a")
    folders = store.current(spark, table).parts
    left = rows.where("year != 1991 AND NOT (company_id = 2)")
    out = incremental.refresh_stored(spark, table, left, keys(spark, [(1, 1991), (2, 1990)]), h, count, "b")
    assert collected(out) == [(1990, 1), (1992, 1)]
    assert store.current(spark, table).parts[1992] == folders[1992] and 1991 not in store.current(spark, table).parts
    assert collected(incremental.refresh_stored(spark, table, rows, rows, h, count, "b")) == [(1990, 1), (1992, 1)]


def test_declared_rules_on_planted_errors(spark):
    rows = [(1, "a", None), (1, "b", "x"), (None, "c", "y"), (None, None, "z"), (2, "a", None)]
    tables = {"t": spark.createDataFrame(rows, "id long, name string, extra string"), "p": spark.createDataFrame([("a",)], "name string")}
    report = quality.constraint_report(tables, {"t": ["id"], "p": ["name"]}, {"t": ["id", "extra"]}, {"t": [["name"]]})
    assert collected(report.select("table_name", "rule", "columns", "rows", "violations")) == [
        ("p", "unique", "name", 1, 0), ("t", "not_null", "extra", 5, 2), ("t", "not_null", "id", 5, 2),
        ("t", "unique", "id", 5, 1), ("t", "unique", "name", 5, 1)]
    lost = quality.reference_report(tables, [("t", "name", "p", "name")])
    assert collected(lost) == [("t.name -> p.name", 2, 2)]
    empty = {k: df.where("false") for k, df in tables.items()}
    assert {r["violations"] for r in quality.constraint_report(empty, {"t": ["id"], "p": ["name"]}, {"t": ["id"]}, {}).collect()} == {0}
