"""Plan shapes that must hold at scale, read from the physical plans."""

import re

import pytest

import compare
from tidepanel import catalogue
from tidepanel.sources.star import Star

SF_DIR = "/root/testdata/sf0.01"


def plan(spark, name):
    df = catalogue.run(name, Star(spark, SF_DIR))
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_no_cross_join_and_no_python(spark, name):
    text = plan(spark, name)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)
    assert not re.search(r"PythonUDF|EvalPython|MapInPandas|FlatMapGroups|ExistingRDD", text)


@pytest.mark.parametrize("name", ["dedup_first_wins", "dedup_last_wins", "topn_per_group", "filter_not_null"])
def test_groups_are_limited_before_the_shuffle(spark, name):
    text = plan(spark, name)
    assert text.count("WindowGroupLimit") >= 2  # partial before and final after the exchange


def test_year_bounds_and_columns_reach_the_scan(spark):
    df = catalogue.run("q_uc3_q2_rate_shock", Star(spark, SF_DIR))
    text = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in text.splitlines() if "FileScan" in line and "lineitem" in line)
    assert "GreaterThanOrEqual(l_shipdate" in scan and "LessThan(l_shipdate" in scan
    schema = re.search(r"ReadSchema: struct<(.*)", scan).group(1)
    assert "l_orderkey" not in schema and "l_quantity" not in schema


def test_only_needed_measures_are_summed(spark):
    text = plan(spark, "lag_features")
    scan = next(line for line in text.splitlines() if "FileScan" in line and "lineitem" in line)
    assert "l_tax" not in scan and "l_discount" not in scan


@pytest.mark.parametrize("name", ["q_uc2_q3_rate_sensitivity", "align_frequencies"])
def test_rates_are_broadcast_even_when_size_is_unknown(spark, name):
    """(country, year) would be a hot shuffle key for the firm rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(spark, name)
        assert "BroadcastHashJoin" in text
        assert not re.search(r"SortMergeJoin \[country_id", text)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", [
    "q_uc1_q1_top10_concentration", "q_uc1_q2_hhi", "q_uc2_q2_deleveraging", "q_uc2_q3_rate_sensitivity", "q_uc3_q1_zombies",
    "q_uc4_q2_volatility_quartiles", "q_uc5_q3_rate_profile", "ingest_wide_fields", "ext_percentiles",
])
def test_same_results_without_automatic_broadcasts(spark, name):
    """Large dimensions are joined by sort-merge; results must not change."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        assert compare.differences(spark, compare.connect(SF_DIR), SF_DIR, name) == []
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["q_uc4_q2_volatility_quartiles", "q_uc2_q2_deleveraging", "ext_asof_available", "ntile_quartiles"])
def test_same_results_with_another_partitioning(spark, name):
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert compare.differences(spark, compare.connect(SF_DIR), SF_DIR, name) == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
