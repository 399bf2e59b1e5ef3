"""From vendor-style CSV files to tables on disk to studies, without the star schema."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.operators.dedup import with_surrogate_key
from tidepanel.plans import concentration, cycles, leverage, regimes, solvency, views
from tidepanel.sources import files, grids

FIRMS = [("AAA US Equity", "US", "Energy"), ("BBB US Equity", "US", "Utilities"), ("CCC LN Equity", "GB", "Energy"),
         ("DDD LN Equity", "GB", "Financials"), ("EEE LN Equity", "GB", "#N/A")]
YEARS = range(2005, 2025)
WEEKS = [date(2005, 1, 7) + timedelta(weeks=i) for i in range(60)]


def _sheet(path, rows):
    path.write_text("\n".join(",".join(f'"{c}"' if "," in str(c) else str(c) for c in row) for row in rows) + "\n", encoding="utf-8")
    return str(path)


def _revenue(firm, year):
    return 1000 + 10 * (firm + 1) * (year - 2005) * (-1 if (year + firm) % 3 == 0 else 1)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("vendor")
    master = [["exported"], ["", *files.COMPANY_COLUMNS]]
    master += [[t, f"Name {t[:3]}", c, "USD", s, "g", "i", "s", "1,000"] for t, c, s in FIRMS]
    annual = [[], [], [], ["", *[x for t, _, _ in FIRMS for x in [t] + [""] * 6]], [], ["Dates", *list(schemas.FIELD_CODES) * len(FIRMS)]]
    for y in YEARS:
        cells = []
        for i in range(len(FIRMS)):
            interest = 100 if i < 4 else "#N/A"
            cells += [f"{_revenue(i, y):,}", 120 + 40 * i + (y % 5), interest, 50, "--", 3000 - 10 * (y - 2005), "N/A"]
        annual.append([f"12/31/{y}", *cells])
    prices = [[], [], [], ["", *[x for t, _, _ in FIRMS for x in (t, "")]], ["", *["Last Price", "Day to Day Total Return"] * len(FIRMS)], ["Dates"]]
    prices += [[d.isoformat(), *[x for i in range(len(FIRMS)) for x in (f"{1000 + k * i:,}.5", (k % 7 - 3) * (i + 1) / 10)]] for k, d in enumerate(WEEKS)]
    months = 240
    macro = [[], ["Text", "Ticker", *range(months)]]
    macro += [["Real GDP (yoy %)", "GDP Index", *[round((m % 36) / 6 - 2, 2) for m in range(months)]],
              ["Nominal GDP (USD bn)", "NGDP Index", *[f"{20000 - m:,}" for m in range(months)]],
              ["CPI (yoy %)", "CPI Index", *[round(2 + (m % 4), 1) for m in range(months)]]]
    rates = [[], [], [], ["x"], ["y"], ["Dates"]]
    rates += [[date(y, 6, 30).isoformat(), *[3 + (y % 4)] * 5, *[1 + (y * k) % 5 for k in range(1, 6)]] for y in YEARS]
    rates += [[d.isoformat(), *[round(2 + (k % 5) / 10, 2)] * 5, *["#N/A"] * 5] for k, d in enumerate(WEEKS)]
    folder = root / "snapshots"
    folder.mkdir()
    for y in YEARS:
        members = [t for i, (t, _, _) in enumerate(FIRMS) if i != 1 or y % 2]
        lines = ["Ticker,Name,Weight,Shares,Price"] + [f"{t},n,{100 / len(members):.4f},10,{5 + y % 3}" for t in members]
        (folder / f"UKX as of {y}.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")

    raw = files.company_master(files.read_csv_with_preamble(spark, _sheet(root / "master.csv", master)))
    companies = raw.join(with_surrogate_key(raw.select("ticker"), "ticker", "company_id"), "ticker").select(*schemas.COMPANIES.fieldNames())
    out = root / "tables"
    files.write_table(companies, str(out / "companies"))
    companies = spark.read.parquet(str(out / "companies"))
    macro_path = _sheet(root / "macro.csv", macro)
    built = {
        "companies": companies,
        "countries": schemas.countries(spark),
        "indices": schemas.indices(spark),
        "prices_weekly": grids.price_grid(grids.read_grid(spark, _sheet(root / "prices.csv", prices)), companies),
        "financials": grids.statement_grid(grids.read_grid(spark, _sheet(root / "annual.csv", annual)), companies, "ANNUAL"),
        "macro_indicators": grids.month_grid(grids.read_grid(spark, macro_path), "US").unionByName(grids.month_grid(grids.read_grid(spark, macro_path), "GB")),
        "interest_rates": grids.rate_grid(grids.read_grid(spark, _sheet(root / "rates.csv", rates))),
        "index_membership": files.membership_rows(files.read_snapshots(spark, str(folder)).withColumn("as_of_date", F.col("as_of_date").cast("string")), companies),
    }
    stored = {}
    for name, df in built.items():
        if name != "companies":
            files.write_table(df, str(out / name))
        stored[name] = spark.read.parquet(str(out / name))
    return stored


def test_tables_have_the_declared_columns_and_unique_keys(tables):
    for name, df in tables.items():
        assert df.columns == schemas.TABLES[name].fieldNames(), name
        assert df.groupBy(*schemas.KEYS[name]).count().where("count > 1").count() == 0, name


def test_row_counts(tables):
    assert {n: tables[n].count() for n in ("companies", "prices_weekly", "financials", "macro_indicators", "index_membership")} == {
        "companies": 5, "prices_weekly": 300, "financials": 100, "macro_indicators": 2 * 3 * 240, "index_membership": 90,
    }


def test_concentration_from_files(tables):
    rows = concentration.top_concentration(tables["index_membership"], tables["companies"], tables["macro_indicators"], n=2).collect()
    assert [r.year for r in rows] == list(YEARS)
    assert rows[0].top10_weight_pct == 40.0 and rows[1].top10_weight_pct == 50.0
    assert rows[0].top10_companies == "Name AAA, Name BBB"
    churn = {r.year: (r.entries, r.exits) for r in concentration.churn_counts(tables["index_membership"], last_year=2024).collect()}
    assert churn[2005] == (5, 1) and churn[2006] == (0, 0) and churn[2007] == (1, 1) and churn[2024] == (0, 0)


def test_leverage_from_files(tables):
    rows = leverage.leverage_distribution(tables["financials"], tables["companies"]).collect()
    assert {r.year: r.economic_period for r in rows}[2008] == "Crisis Year"
    assert {r.company_count for r in rows} == {3}  # no financial firm, no firm without a sector
    falling = leverage.deleveraging_by_year(tables["financials"], tables["companies"]).collect()
    assert [(r.year, r.companies, r.pct) for r in falling] == [(y, 3, 100.0) for y in range(2007, 2025)]
    rate = leverage.rate_sensitivity(tables["financials"], tables["companies"], tables["interest_rates"]).collect()
    assert len(rate) == 3 and all(abs(r.correlation_with_policy_rate) <= 1 and r.total_years_data == 20 for r in rate)


def test_solvency_from_files(tables):
    shock = {r.country_id: r for r in solvency.rate_shock(tables["financials"], tables["companies"]).collect()}
    # Debt 2810: +28.1 interest. US firms cover 1.24 and 1.64, the GB one 2.04.
    assert (shock["US"].total_companies, shock["US"].newly_distressed, shock["GB"].newly_distressed) == (2, 1, 0)
    risk = {r.country_id: r for r in solvency.geographic_risk(tables["financials"], tables["companies"], tables["macro_indicators"]).collect()}
    assert (risk["US"].zombie_count, risk["US"].zombie_pct, risk["GB"].zombie_count) == (1, 50.0, 0)
    assert solvency.persistent_zombies(tables["financials"], tables["companies"], tables["macro_indicators"]).count() > 0


def test_cycles_and_regimes_from_files(tables):
    quartiles = cycles.volatility_quartiles(tables["financials"], tables["companies"]).collect()
    assert [r.company_count for r in quartiles] == [2, 1, 1, 1]
    regime = regimes.inflation_regime(tables["prices_weekly"], tables["companies"], tables["macro_indicators"]).collect()
    assert {r.inflation_regime for r in regime} == {"High Inflation", "Low Inflation"}
    assert {r.gics_sector_name for r in regime} == {"Energy", "Utilities"}
    profile = regimes.rate_profile(tables["prices_weekly"], tables["companies"], tables["interest_rates"]).collect()
    assert {r.weeks for r in profile} == {60 - 1}


def test_views_and_export_from_files(spark, tables, tmp_path):
    views.register(tables)
    assert spark.sql("SELECT COUNT(*) FROM v_index_members WHERE index_name = 'FTSE 100'").first()[0] == 90
    done, errors = files.export_catalogue({
        "top": lambda: concentration.top_weight(tables["index_membership"]),
        "sectors": lambda: solvency.zombies_by_sector(tables["financials"], tables["companies"]),
    }, str(tmp_path))
    assert (done, errors) == (2, {})
