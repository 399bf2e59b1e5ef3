"""The load job over small files: two deliveries, an absent source, a restart, rejects and declared rules."""

import time

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import quality
from tidepanel.sources import load, rejects, store

MASTER = """exported 2024
Ticker,NAME,COUNTRY,CRNCY,GICS_SECTOR_NAME,GICS_INDUSTRY_GROUP_NAME,GICS_INDUSTRY_NAME,GICS_SUB_INDUSTRY_NAME,CUR_MKT_CAP
{rows}"""
MEMBERS = "index_id,as_of_date,Ticker,Name,Weight,Shares,Price\n"
PRICES = """x
x
x
,M US,,Q US,,B US,
,Last Price,Day to Day Total Return,Last Price,Day to Day Total Return,Last Price,Day to Day Total Return
Dates
2001-01-05,"1,000.5",0.1,2,--,9,9
someday,1,1,1,1,1,1
2001-01-12,n.m.,0.2,3,0.4,9,9
"""


def write(folder, name, text):
    (folder / name).write_text(text)


def company(ticker, sector="Energy"):
    return f"{ticker},{ticker} Inc,US United States,USD,{sector},G,I,S,1000\n"


@pytest.fixture
def place(tmp_path):
    source, root = tmp_path / "in", tmp_path / "db"
    source.mkdir()
    return source, f"file://{source}", f"file://{root}"


def by_file(outcomes):
    return {o.source.file: o for o in outcomes}


def ids(spark, root):
    return {r["ticker"]: r["company_id"] for r in store.read(spark, f"{root}/companies").collect()}


def test_two_deliveries_restart_and_rejects(spark, place, monkeypatch):
    folder, source, root = place
    write(folder, "company_master.csv", MASTER.format(rows=company("M US") + company("Q US") + "#N/A,,,,,,,,\n"))
    write(folder, "index_membership_snapshot.csv", MEMBERS + "UKX,2001-12-31,M US,m,60,1,1\nUKX,2001-12-31,Z US,z,1,1,1\nUKX,never,M US,m,1,1,1\n")
    write(folder, "price_weekly.csv", PRICES)

    real = load.read_source

    def broken(spark_, src, path, companies):
        if src.table == "prices_weekly":
            raise OSError("lost")
        return real(spark_, src, path, companies)

    monkeypatch.setattr(load, "read_source", broken)
    with pytest.raises(OSError):
        load.load_all(spark, source, root)
    monkeypatch.setattr(load, "read_source", real)
    out = by_file(load.load_all(spark, source, root))
    assert (out["company_master.csv"].status, out["index_membership_snapshot.csv"].status) == ("known", "known")
    assert out["price_weekly.csv"].status == "loaded" and out["price_weekly.csv"].rejected == {"unknown_ticker": 1, "bad_date": 1, "bad_number": 1}
    assert out["financials_annual.csv"].status == out["interest_rates.csv"].status == "absent"
    assert ids(spark, root) == {"M US": 1, "Q US": 2}
    prices = {(r["company_id"], str(r["price_date"])): (r["close_price"], r["total_return"]) for r in store.read(spark, f"{root}/prices_weekly").collect()}
    assert prices == {(1, "2001-01-05"): (1000.5, 0.1), (2, "2001-01-05"): (2.0, None), (2, "2001-01-12"): (3.0, 0.4)}
    lost = spark.read.parquet(f"{root}/quarantine/index_membership/*").groupBy("reason").count().collect()
    assert {r["reason"]: r["count"] for r in lost} == {"unknown_ticker": 1, "bad_date": 1}

    time.sleep(0.01)
    write(folder, "company_master.csv", MASTER.format(rows=company("B US") + company("M US", "Utilities")))
    time.sleep(0.01)
    write(folder, "price_weekly.csv", PRICES.replace("9,9", "8,8"))
    out = by_file(load.load_all(spark, source, root))
    assert out["company_master.csv"].status == "loaded" and out["index_membership_snapshot.csv"].status == "known"
    assert ids(spark, root) == {"M US": 1, "Q US": 2, "B US": 3}
    stored = store.read(spark, f"{root}/companies").where("ticker = 'M US'").first()
    assert stored["gics_sector_name"] == "Energy"  # the first delivery wins
    assert store.read(spark, f"{root}/prices_weekly").where("company_id = 3").count() == 2
    tables = load.tables(spark, root)
    assert quality.constraint_report(tables).where("violations > 0").count() == 0
    assert quality.reference_report(tables).where("orphan_keys > 0").count() == 0
    assert {o.status for o in load.load_all(spark, source, root)} == {"known", "absent"}


def test_statements_of_a_later_file_replace(spark, place):
    folder, source, root = place
    sheet = "a\nb\nc\n,M US,,,,,,\nd\n,SALES_REV_TURN,EBITDA,x,x,x,x,x\n{rows}"
    write(folder, "company_master.csv", MASTER.format(rows=company("M US")))
    write(folder, "financials_annual.csv", sheet.format(rows="2000-12-31,1,2,,,,,\n2001-12-31,3,4,,,,,\n"))
    load.load_all(spark, source, root)
    time.sleep(0.01)
    write(folder, "financials_annual.csv", sheet.format(rows="2001-12-31,30,,,,,,\n"))
    load.load_all(spark, source, root)
    rows = store.read(spark, f"{root}/financials").orderBy("period_end_date").collect()
    assert [(r["revenue"], r["ebitda"], r["period_type"]) for r in rows] == [(1.0, 2.0, "ANNUAL"), (30.0, None, "ANNUAL")]


def test_reject_reasons(spark):
    firms = spark.createDataFrame([("A", 1)], "ticker string, company_id long")
    raw = spark.createDataFrame([("X", "2001-01-01", " A "), ("X", "soon", "B"), ("X", "2001-01-01", None)], "index_id string, as_of_date string, Ticker string")
    found = {(r["loader"], r["reason"]): r["rejected"] for r in rejects.counts(rejects.membership_rejects(raw, firms)).collect()}
    assert found == {("index_membership", "unknown_ticker"): 1, ("index_membership", "bad_date"): 1, ("index_membership", "no_key"): 1}
    cells = spark.createDataFrame([(2, 2, "x"), (2, 0, "name"), (3, 2, "1,0"), (3, 3, "--"), (6, 0, "bad"), (6, 1, "0x1")], "row_no long, col_no long, value string")
    assert rejects.month_rejects(cells).count() == 1
    assert sorted(r["reason"] for r in rejects.rate_rejects(cells).collect()) == ["bad_date", "bad_number"]
    assert rejects.counts(rejects.rate_rejects(cells.where(F.lit(False)))).count() == 0
