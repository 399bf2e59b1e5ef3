"""File sources, sheet grids and sinks on generated CSV files."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions import cleaning
from tidepanel.operators import quality
from tidepanel.sources import files, grids


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


@pytest.fixture()
def firms(spark):
    return spark.createDataFrame([("AAA US Equity", 1), ("BBB LN Equity", 2)], "ticker string, company_id long")


def test_company_master_with_preamble(spark, tmp_path):
    path = write(tmp_path / "master.csv", (
        "exported by vendor,,\n"
        ",NAME,COUNTRY,CRNCY,GICS_SECTOR_NAME,GICS_INDUSTRY_GROUP_NAME,GICS_INDUSTRY_NAME,GICS_SUB_INDUSTRY_NAME,CUR_MKT_CAP\n"
        ' AAA US Equity ,"Alpha, Inc",US,USD,Energy,Energy,Oil,#N/A,"1,234.5"\n'
        "BBB LN Equity,Beta,GB United,GBP,--,,,,#N/A\n"
        "AAA US Equity,Alpha again,US,USD,Energy,,,,1\n"
        "#N/A,Nobody,US,USD,,,,,\n"
        "\n"
    ))
    out = {r.ticker: r for r in files.company_master(files.read_csv_with_preamble(spark, path)).collect()}
    assert set(out) == {"AAA US Equity", "BBB LN Equity"}
    a, b = out["AAA US Equity"], out["BBB LN Equity"]
    assert (a.company_name, a.country_id, a.gics_sub_industry_name, float(a.current_market_cap), a.is_active) == ("Alpha, Inc", "US", None, 1234.5, True)
    assert (b.country_id, b.gics_sector_name, b.current_market_cap) == ("GB", None, None)


def test_preamble_needs_two_lines(spark, tmp_path):
    with pytest.raises(ValueError):
        files.read_csv_with_preamble(spark, write(tmp_path / "short.csv", "only one line\n"))


def test_snapshot_folder(spark, tmp_path):
    write(tmp_path / "UKX as of 2005.csv", "Ticker , Name,Weight,Shares,Price\n BBB LN Equity ,Beta ,1.5,10,2\nBBB LN Equity,Beta,9,9,9\n,,,,\n")
    write(tmp_path / "SPX as of 20061.csv", "Ticker,Name\nAAA US Equity,Alpha\n")
    write(tmp_path / "~$UKX as of 2007.csv", "Ticker,Name\nlock,lock\n")
    write(tmp_path / "notes.txt", "x")
    rows = {r.index_id: r for r in files.read_snapshots(spark, str(tmp_path)).collect()}
    ukx, spx = rows["UKX"], rows["SPX"]
    assert (ukx.as_of_date, ukx.Ticker, ukx.Name, ukx.Weight) == (date(2005, 12, 31), "BBB LN Equity", "Beta", "1.5")
    assert (spx.as_of_date, spx.Ticker, spx.Name, spx.Weight) == (date(2006, 12, 31), "AAA US Equity", "Alpha", None)
    assert len(rows) == 2


def test_snapshot_without_ticker_fails(spark, tmp_path):
    write(tmp_path / "UKX as of 2005.csv", "Name,Weight\nBeta,1\n")
    with pytest.raises(Exception, match="missing Ticker column"):
        files.read_snapshots(spark, str(tmp_path)).collect()


def test_consolidated_membership(spark, tmp_path, firms):
    path = write(tmp_path / "members.csv", (
        "index_id,as_of_date,Ticker,Name,Weight,Shares,Price\n"
        "UKX,12/31/2005, BBB LN Equity,Beta,1.25,--,7\n"
        "UKX,2005-12-31,BBB LN Equity,Beta,9,9,9\n"
        "UKX,2005-12-31,ZZZ Equity,Unknown,1,1,1\n"
        "UKX,some day,BBB LN Equity,Beta,1,1,1\n"
    ))
    raw = files.read_csv(spark, path, ["index_id", "as_of_date", "Ticker", "Name", "Weight", "Shares", "Price"])
    rows = files.membership_rows(raw, firms).collect()
    assert [(r.company_id, r.as_of_date, float(r.weight), r.shares_outstanding, float(r.price)) for r in rows] == [(2, date(2005, 12, 31), 1.25, None, 7.0)]


def test_ticker_list_accepts_both_names(spark):
    for name in ("Ticker", "ticker"):
        df = spark.createDataFrame([(" b ",), ("a",), (None,), ("b",)], f"{name} string")
        assert [r.ticker for r in files.ticker_list(df).collect()] == ["a", "b"]


def test_price_sheet(spark, tmp_path, firms):
    path = write(tmp_path / "price.csv", (
        "Start,2005\n\n\n"
        "x,AAA US Equity,,BBB LN Equity,,CCC Equity,\n"
        "x,Last Price,Day to Day Total Return,Day to Day Total Return,Last Price,Last Price,Day to Day Total Return\n"
        "Dates,,,,,,\n"
        '01/07/2005,"1,000.5",0.5,-1,20,1,1\n'
        "2005-01-14,#N/A,0.5,2,21,1,1\n"
        "not a date,5,5,5,5,5,5\n"
        "2005/1/7,7,7,7,7,7,7\n"
    ))
    got = sorted(tuple(r) for r in grids.price_grid(grids.read_grid(spark, path), firms).collect())
    assert got == [
        (1, date(2005, 1, 7), 1000.5, 0.5),
        (2, date(2005, 1, 7), 20.0, -1.0),
        (2, date(2005, 1, 14), 21.0, 2.0),
    ]


def test_statement_sheet_last_row_wins(spark, tmp_path, firms):
    codes = ",".join(schemas.FIELD_CODES)
    path = write(tmp_path / "fin.csv", (
        "a\nb\nc\n"
        "x,AAA US Equity,,,,,,,BBB LN Equity,,,,,,\n"
        "y\n"
        f"Dates,{codes},{codes}\n"
        "2005-12-31,1,2,3,4,5,6,7,#N/A,--,,N/A,,,\n"
        "2006-12-31,10,,,,,,,1,2,3,4,5,6,7\n"
        "2006-12-31,,20,,,,,,,,,,,,\n"
    ))
    out = {(r.company_id, r.period_end_date.year): r for r in grids.statement_grid(grids.read_grid(spark, path), firms, "ANNUAL").collect()}
    assert set(out) == {(1, 2005), (1, 2006), (2, 2006)}
    assert [out[(1, 2005)][m] for m in schemas.FIELD_CODES.values()] == [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
    assert (out[(1, 2006)].revenue, out[(1, 2006)].ebitda) == (None, 20.0)  # replaced as a whole
    assert out[(2, 2006)].cost_of_goods_sold == 7.0
    assert set(out[(2, 2006)].asDict()) == set(schemas.FINANCIALS.fieldNames())


def test_macro_sheet(spark, tmp_path):
    path = write(tmp_path / "macro.csv", (
        "\nText,Ticker,Dec,Nov,Oct\n"
        " Real GDP (yoy %) ,GDP YOY Index,1.5,#N/A,1.2\n"
        "Producer Prices,PPI Index,3,4,5\n"
        "Producer Prices again,PPI Index,9,9,\n"
        "No ticker one,,1,,\n"
        "No ticker two,,2,,\n"
        ",orphan,1,2,3\n"
    ))
    rows = grids.month_grid(grids.read_grid(spark, path), "US").collect()
    got = sorted((r.bloomberg_ticker or "", r.indicator_date, r.indicator_value, r.indicator_category) for r in rows)
    assert got == [
        ("", date(2024, 12, 1), 1.0, "Other"), ("", date(2024, 12, 1), 2.0, "Other"),
        ("GDP YOY Index", date(2024, 10, 1), 1.2, "GDP"), ("GDP YOY Index", date(2024, 12, 1), 1.5, "GDP"),
        ("PPI Index", date(2024, 10, 1), 5.0, "CPI"), ("PPI Index", date(2024, 11, 1), 4.0, "CPI"), ("PPI Index", date(2024, 12, 1), 3.0, "CPI"),
    ]
    assert {r.country_id for r in rows} == {"US"}


def test_month_offsets_cross_years(spark):
    cells = spark.createDataFrame([(2, 0, "CPI"), (2, 1, "T"), (2, 13, "1"), (2, 14, "2"), (2, 241, "3")], "row_no long, col_no long, value string")
    got = sorted(r.indicator_date for r in grids.month_grid(cells, "US").collect())
    assert got == [date(2005, 1, 1), date(2023, 12, 1), date(2024, 1, 1)]


def test_rate_sheet(spark, tmp_path):
    path = write(tmp_path / "rates.csv", "\n" * 6 + "2005-01-07,1,2,3,4,5,6,7,8,9,N/A,77\n01/14/2005,1.5,,,,,,,,,\n2005-01-07,9,9,9,9,9,9,9,9,9,9\n")
    rows = grids.rate_grid(grids.read_grid(spark, path)).collect()
    first = {(r.country_id, r.rate_type): r.rate_value for r in rows if r.rate_date == date(2005, 1, 7)}
    assert first[("US", "10Y_YIELD")] == 1.0 and first[("GB", "POLICY_RATE")] == 7.0
    assert first[("CN", "POLICY_RATE")] == 9.0  # the earlier row had no value
    assert [(r.country_id, r.bloomberg_ticker, r.rate_value) for r in rows if r.rate_date == date(2005, 1, 14)] == [("US", "USGG10YR Index", 1.5)]


@pytest.mark.parametrize("kind,ends", [
    ("ANNUAL", [date(2005, 12, 31), date(2006, 12, 31)]), ("QUARTERLY", [date(2005, 3, 31), date(2005, 6, 30)]),
])
def test_calendar_fill(spark, kind, ends):
    rows = [(5, 0, "Dates"), (6, 0, None), (6, 1, "1"), (7, 1, "2"), (7, 2, "3"), (200, 0, "kept"), (200, 1, "4")]
    cells = spark.createDataFrame(rows, "row_no long, col_no long, value string")
    out = {(r.row_no, r.col_no): r.value for r in grids.fill_calendar(cells, kind).collect()}
    assert (out[(6, 0)], out[(7, 0)]) == tuple(str(d) for d in ends)
    assert out[(5, 0)] == "Dates" and out[(200, 0)] == "kept"
    assert out[(7, 2)] == "3" and len(out) == 8


def test_optional_source(spark, tmp_path):
    missing = files.read_or_empty(spark, str(tmp_path / "none"), schemas.RATES)
    assert missing.count() == 0 and missing.columns == schemas.RATES.fieldNames()
    files.write_table(schemas.countries(spark), str(tmp_path / "c"))
    assert files.read_or_empty(spark, str(tmp_path / "c"), schemas.COUNTRIES).count() == 5


def test_recreate_tables_replaces_everything(spark, tmp_path):
    files.recreate_tables(spark, str(tmp_path), {"countries": schemas.countries(spark)})
    files.recreate_tables(spark, str(tmp_path), {"indices": schemas.indices(spark)})
    counts = {n: spark.read.parquet(str(tmp_path / n)).count() for n in schemas.TABLES}
    assert counts == {**dict.fromkeys(schemas.TABLES, 0), "indices": 2}


def test_export_catalogue_isolates_failures(spark, tmp_path):
    def broken():
        raise RuntimeError("no such table")

    done, errors = files.export_catalogue({"good": lambda: schemas.countries(spark), "bad": broken}, str(tmp_path))
    assert done == 1 and list(errors) == ["bad"]
    assert spark.read.option("header", True).csv(str(tmp_path / "good")).columns == ["country_id", "country_name", "currency"]


def test_views_can_be_queried_by_sql(spark):
    from tidepanel.plans import views
    from tidepanel.sources.star import Star

    star = Star(spark, "/root/testdata/sf0.001")
    views.register({
        "companies": star.companies(), "countries": schemas.countries(spark), "indices": schemas.indices(spark),
        "financials": star.financials(), "index_membership": star.membership(), "macro_indicators": star.macro(),
    })
    got = spark.sql("SELECT country_name, COUNT(*) n FROM v_company_details GROUP BY 1").agg(F.sum("n")).first()[0]
    assert got == star.companies().count()
    assert spark.sql("SELECT * FROM v_financials_annual WHERE interest_coverage_ratio < 1.5").count() > 0


def test_reject_counts(spark):
    from tidepanel.functions import cleaning

    df = spark.createDataFrame([("1",), ("x",), ("#N/A",), (None,)], "raw string")
    assert quality.reject_report(df, {"raw": cleaning.to_number("raw")}).first().asDict() == {"raw_parsed": 1, "raw_rejected": 1}


def test_wide_quoted_line_is_split_in_one_pass(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(",".join(['"1,234.50"'] * 9000) + ',"a ""b"" c",,plain\n')
    cells = {r.col_no: r.value for r in grids.read_grid(spark, str(tmp_path / "wide.csv")).collect()}
    assert len(cells) == 9003 and cells[0] == cells[8999] == "1,234.50"
    assert [cells[i] for i in (9000, 9001, 9002)] == ['a "b" c', "", "plain"]


def test_first_snapshot_by_name_wins_and_ragged_rows_are_read(spark, tmp_path):
    (tmp_path / "UKX as of 2005.csv").write_text("Ticker,Price,,\nA,111,,\n")
    (tmp_path / "UKX as of 20051.csv").write_text("Ticker,Price,,\n" + "A,222,,,,\n" * 2000 + "B,333,\n")
    rows = files.read_snapshots(spark, str(tmp_path)).collect()
    assert {(r.Ticker, r.Price) for r in rows} == {("A", "111"), ("B", "333")}


def test_numbers_are_plain_and_dates_may_have_a_time(spark):
    texts = ["12f", "1d", "0x1p3", "NaN", "Infinity", "1,234.5", "-.5", "2e3"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(cleaning.to_number("t")).collect()
    assert [r[0] for r in rows] == [None] * 5 + [1234.5, -0.5, 2000.0]
    days = spark.createDataFrame([("2005-01-14 00:00:00",), ("01/14/2005 9:30",)], "t string").select(cleaning.to_date("t")).collect()
    assert [str(r[0]) for r in days] == ["2005-01-14"] * 2
