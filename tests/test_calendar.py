"""First and last periods are those of the data: the same tables ten years later keep all their rows."""

from pathlib import Path

import duckdb
import pytest

import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def later(tmp_path_factory):
    folder = tmp_path_factory.mktemp("later")
    for file in Path(SF_DIR).glob("*.parquet"):
        (folder / file.name).symlink_to(file)
    for table, columns in {"lineitem": ["l_shipdate"], "orders": ["o_orderdate"]}.items():
        (folder / f"{table}.parquet").unlink()
        moved = ", ".join(f"{c} + INTERVAL 10 YEAR AS {c}" for c in columns)
        duckdb.sql(f"COPY (SELECT * REPLACE ({moved}) FROM '{SF_DIR}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    return str(folder)


@pytest.mark.parametrize("name", [
    "ingest_wide_pairs", "ingest_wide_fields", "ingest_month_columns", "calendar_fill", "membership_exits", "membership_entries",
    "q_uc1_q3_index_churn", "q_v_uc1_q3_pivot", "q_uc3_q2_rate_shock", "q_uc3_q3_geo_risk", "scenario_rate_shock",
    "ext_membership_flag_lag", "ext_churn_size_compare", "incremental_churn",
])
def test_ten_years_later(spark, later, name):
    assert compare.differences(spark, compare.connect(later), later, name) == []


def test_as_many_rows_as_before(spark, later):
    for name in ("calendar_fill", "ingest_month_columns", "q_uc3_q2_rate_shock", "ext_membership_flag_lag"):
        counts = [len(compare.connect(f).execute(compare.ORACLES[name]).fetchall()) for f in (SF_DIR, later)]
        assert counts[0] == counts[1] > 0
