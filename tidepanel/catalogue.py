"""Every operator and study as a named query over one star-schema folder.

Each function takes a ``Star`` and returns a DataFrame. Thresholds follow the
defaults except where the data's calendar (seven years, the last one partial)
asks for shorter windows. First and last periods are those of the data.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions import aggregates as A
from tidepanel.functions import cleaning, periods
from tidepanel.functions import scalars as S
from tidepanel.operators import dedup, hierarchy, joins, panel, quality, ranking, registry
from tidepanel.plans import concentration, cycles, extensions, incremental, leverage, macro, regimes, solvency, views
from tidepanel.sources import files, grids, rejects, star_raw, store
from tidepanel.sources.star import Star

LABELS = {"Crisis Year": [1998, 2001], "Boom Year": [1996, 1997]}
WINDOW, MIN_YEARS = 5, 5
RATE_YEARS = 7

QUERIES: dict[str, Callable[[Star], DataFrame]] = {}


def _latest(s: Star) -> DataFrame:
    """Annual statements of the last year; the bound reaches the scan."""
    return s.financials("ANNUAL", (s.last_year(), s.last_year()))


def query(build: Callable[[Star], DataFrame]) -> Callable[[Star], DataFrame]:
    QUERIES[build.__name__] = build
    return build


# --- ingest -----------------------------------------------------------------

@query
def ingest_snapshot_union(s):
    rows = files.snapshot_rows(star_raw.snapshot_files(s), F.col("load_order"))
    return rows.select("index_id", "as_of_date", F.col("Ticker").alias("ticker"), F.col("Name").alias("name"),
                       F.col("Weight").alias("weight"), F.col("Price").alias("price"))


@query
def ingest_wide_pairs(s):
    return grids.price_grid(star_raw.price_cells(s), s.companies())


@query
def ingest_wide_fields(s):
    return grids.statement_grid(star_raw.statement_cells(s), s.companies(), "ANNUAL").drop("currency")


@query
def ingest_month_columns(s):
    layout = grids.MonthLayout(anchor=s.last_month())
    return grids.month_grid(star_raw.macro_cells(s), F.col("country_id"), layout)


@query
def ingest_text_cells(s):
    """The rate sheet printed as one text file and read back as cells."""
    folder = store.scratch_folder(s.spark, "sheet")
    star_raw.rate_lines(s).repartition(1).sortWithinPartitions("row_no").select("value").write.text(folder)
    return grids.read_grid(s.spark, folder).where(F.col("value") != "")


@query
def ingest_text_companies(s):
    """Company master sheets printed as several text files and read back as company rows."""
    folder = store.scratch_folder(s.spark, "masters")
    lines = star_raw.master_lines(s).repartition(star_raw.MASTER_FILES, "file_no").sortWithinPartitions("file_no", "line_no")
    lines.select("file_no", "value").write.partitionBy("file_no").text(folder)
    rows = files.company_master(files.read_csv_with_preamble(s.spark, folder + "/*", place=True))
    return rows.select("ticker", "company_name", "country_id", "currency", "gics_sector_name", "gics_sub_industry_name", "current_market_cap")


@query
def ingest_rate_columns(s):
    return grids.rate_grid(star_raw.rate_cells(s))


@query
def calendar_fill(s):
    cells = star_raw.statement_cells(s, "QUARTERLY", with_dates=False)
    filled = grids.fill_calendar(cells, "QUARTERLY", s.first_year(), last_year=None)
    data = filled.where(F.col("row_no") >= 6)
    return data.groupBy("row_no").agg(
        F.max(F.when(F.col("col_no") == 0, cleaning.to_date("value"))).alias("period_end_date"),
        F.count_if(F.col("col_no") > 0).alias("cells"),
    )


@query
def dim_constants(s):
    firms = s.companies().groupBy("country_id").agg(F.count("*").alias("companies"))
    markets = schemas.indices(s.spark).select("country_id", "index_id", "index_name")
    dims = schemas.countries(s.spark).join(F.broadcast(markets), "country_id", "left")
    return dims.join(firms, "country_id", "left")


@query
def dedup_first_wins(s):
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    kept = dedup.first_wins(s.table("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


@query
def dedup_last_wins(s):
    order = [F.col(c) for c in ("l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")]
    kept = dedup.last_wins(s.table("lineitem"), ["l_orderkey", "l_linenumber"], order)
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")


def _weekly_deliveries(s):
    """Units and lines per company and week in two deliveries that share many keys."""
    lines = s.table("lineitem")

    def delivery(part):
        day = F.date_add(F.trunc(F.col("l_shipdate").cast("date"), "week"), 4)
        return lines.where(part).groupBy(F.col("l_suppkey").alias("company_id"), day.alias("price_date")).agg(
            F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count("*").alias("lines"))

    return {"first": delivery(F.col("l_linenumber") <= 4), "second": delivery(F.col("l_linenumber") >= 3)}


def _merged(s, merge):
    """Both deliveries merged into a stored table, the second one twice, as after a job that was run again."""
    deliveries = _weekly_deliveries(s)
    table = store.scratch_folder(s.spark, "prices_weekly")
    store.create(s.spark, table, deliveries["first"].schema)
    for name in ("first", "second", "second"):
        merge(s.spark, table, deliveries[name], schemas.KEYS["prices_weekly"], F.year("price_date"), [F.col("lines")], name)
    return store.read(s.spark, table)


@query
def merge_first_wins(s):
    return _merged(s, store.merge_first_wins)


@query
def merge_last_wins(s):
    return _merged(s, store.merge_last_wins)


@query
def assign_keys_incremental(s):
    firms, table = s.companies().select("ticker", "company_id"), store.scratch_folder(s.spark, "company_keys")
    registry.assign_keys(s.spark, table, firms.where("company_id % 3 != 0"), "ticker", "company_key", "first")
    return registry.assign_keys(s.spark, table, firms, "ticker", "company_key", "second")


def _appended(s, inputs, horizon, study):
    """A stored study over all periods but the last, brought up to date when the last one is appended."""
    table = store.scratch_folder(s.spark, "study")
    last = F.col("year") == inputs.agg(F.max("year").alias("year")).scalar()
    incremental.refresh_stored(s.spark, table, inputs.where(~last), inputs, horizon, study, "before")
    return incremental.refresh_stored(s.spark, table, inputs, inputs.where(last), horizon, study, "appended")


@query
def incremental_hhi(s):
    members = s.membership().withColumn("year", F.year("as_of_date"))
    return _appended(s, members, incremental.CONCENTRATION, concentration.hhi)


@query
def incremental_churn(s):
    members = s.membership().withColumn("year", F.year("as_of_date"))
    final = members.agg(F.max("year").alias("year"))

    def churn(rows):  # also where only some years are looked at, the last one is that of all members
        return concentration.churn_counts(rows, last_year=final.scalar())

    return _appended(s, members, incremental.CHURN, churn)


def _rolling_volatility(financials):
    rows = panel.with_growth(financials, "company_id", "period_end_date", "revenue", "growth")
    rows = panel.with_rolling(rows, "company_id", "year", "growth", WINDOW)
    return rows.where(F.col("roll_count") == WINDOW).select(
        "company_id", "year", F.round("roll_mean", 6).alias("mean_growth"), F.round("roll_std", 6).alias("volatility")
    )


@query
def incremental_volatility(s):
    rows = s.financials("ANNUAL").select("company_id", "period_end_date", "revenue", F.year("period_end_date").alias("year"))
    return _appended(s, rows, incremental.rolling(("company_id",), WINDOW), _rolling_volatility)


@query
def clean_null_tokens(s):
    return star_raw.order_texts(s).select("o_orderkey", cleaning.null_if_token("label_text").alias("label"))


@query
def clean_numeric(s):
    return star_raw.order_texts(s).select("o_orderkey", cleaning.to_number("number_text").alias("number"))


@query
def parse_dates_multi(s):
    return star_raw.order_texts(s).select("o_orderkey", cleaning.to_date("date_text").alias("parsed_date"))


@query
def clean_odd_texts(s):
    """Numbers and dates from mixed forms, and which texts carry a value that can't be read."""
    number, date = cleaning.to_number("number_text"), cleaning.to_date("date_text")
    return star_raw.odd_texts(s).select(
        "o_orderkey", number.alias("number"), cleaning.is_reject("number_text", number).alias("number_rejected"),
        date.alias("parsed_date"), cleaning.is_reject("date_text", date).alias("date_rejected"))


@query
def clean_trim(s):
    raw = s.table("customer").select(
        F.col("c_custkey").alias(" c_custkey"), F.concat(F.lit("  "), "c_name", F.lit(" ")).alias("c_name "),
        F.concat("c_mktsegment", F.lit("   ")).alias(" segment "),
    )
    return cleaning.trim_strings(raw)


@query
def derive_country_code(s):
    full = s.companies().join(F.broadcast(schemas.countries(s.spark).select("country_id", "country_name")), "country_id")
    named = full.select(F.concat_ws(" ", "country_id", "country_name").alias("country"), "company_id")
    return named.select("company_id", "country", cleaning.country_code("country").alias("country_id"))


@query
def lookup_surrogate_key(s):
    facts = s.table("customer").select(
        "c_custkey", "c_acctbal", F.concat(F.lit("Supplier#"), F.substring_index("c_name", "#", -1)).alias("company_name")
    )
    return joins.lookup_key(facts, s.companies(), "company_name", "company_id")


@query
def assign_surrogate_key(s):
    return dedup.with_surrogate_key(s.companies().select("ticker"), "ticker", "company_key")


@query
def unpivot_long(s):
    rows = s.financials("ANNUAL")
    long = rows.unpivot(["company_id", "period_end_date"], schemas.MEASURES, "measure", "value")
    return long.where(F.col("value").isNotNull())


@query
def pivot_measures(s):
    rows = s.macro()
    names = ["HOUSST", "GDPNOM", "CPIYOY"]
    code = F.substring("bloomberg_ticker", 3, 6)
    wide = rows.groupBy("country_id", "indicator_date").agg(
        *[F.round(F.max(F.when(code == n, F.col("indicator_value"))), 6).alias(n.lower()) for n in names]
    )
    return wide


@query
def drop_null_measure(s):
    rows = s.financials("QUARTERLY").where(F.col("interest_expense").isNotNull())
    return rows.select("company_id", "period_end_date", "interest_expense")


@query
def drop_all_null(s):
    rows = s.financials("QUARTERLY").select(
        "company_id", "period_end_date", "interest_expense", F.when(F.col("ebitda") < 0, F.col("ebitda")).alias("loss")
    )
    return rows.na.drop(how="all", subset=["interest_expense", "loss"])


@query
def categorise_keywords(s):
    return s.table("documents").select("doc_id", cleaning.category("text").alias("category"))


@query
def distinct_sorted_keys(s):
    return files.ticker_list(s.table("part").select(F.concat(F.lit(" "), "p_name", F.lit(" ")).alias("Ticker")))


# --- constraints, quality, coverage -----------------------------------------

@query
def dq_unique_key(s):
    lines = quality.key_report(s.table("lineitem"), ["l_orderkey", "l_linenumber"], "lineitem")
    statements = quality.key_report(s.financials(), schemas.KEYS["financials"], "financials")
    prices = quality.key_report(s.prices(), schemas.KEYS["prices_weekly"], "prices_weekly")
    return lines.unionByName(statements).unionByName(prices)


@query
def dq_orphans(s):
    members = s.membership().where(F.col("index_id") == "UKX").select("company_id").distinct()
    checks = {
        "orders.o_custkey": (s.table("orders"), "o_custkey", s.table("customer"), "c_custkey"),
        "customer.c_custkey": (s.table("customer"), "c_custkey", s.table("supplier"), "s_suppkey"),
        "lineitem.l_partkey": (s.table("lineitem"), "l_partkey", s.table("part"), "p_partkey"),
        "lineitem.l_suppkey": (s.table("lineitem"), "l_suppkey", members, "company_id"),
        "events.user_id": (s.table("events"), "user_id", s.table("customer"), "c_custkey"),
    }
    out = None
    for name, (child, key, parent, parent_key) in checks.items():
        report = joins.orphans(child, key, parent, parent_key).agg(
            F.count("*").alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")
        ).select(F.lit(name).alias("reference"), "*")
        out = report if out is None else out.unionByName(report)
    return out


def _faulty_delivery(s):
    """The declared tables as a faulty delivery has them: companies missing, repeated and without ticker, members
    repeated, an indicator without a name and a country that isn't known."""
    firms = s.companies().withColumn("ticker", F.when(F.col("company_id") % 40 != 3, F.col("ticker")))
    levels = ["gics_sector_name", "gics_industry_group_name", "gics_industry_name", "gics_sub_industry_name"]
    sectors = firms.where(F.col("gics_sector_name").isNotNull()).groupBy(*levels).agg(F.min("company_id").alias("sector_id"))
    members, macro, rates = s.membership(), s.macro(), s.rates()
    nameless = (F.col("country_id") == "JP") & F.col("bloomberg_ticker").endswith("GDPNOM Index")
    return {
        "countries": schemas.countries(s.spark), "indices": schemas.indices(s.spark), "gics_sectors": sectors,
        "companies": firms.where("company_id % 10 != 0").unionByName(firms.where("company_id % 25 = 1")),
        "index_membership": members.unionByName(members.where("index_id = 'SPX'")),
        "prices_weekly": s.prices(), "financials": s.financials(),
        "macro_indicators": macro.withColumn("indicator_name", F.when(~nameless, F.col("indicator_name"))),
        "interest_rates": rates.withColumn("country_id", F.when(F.col("country_id") == "CN", F.lit("XX")).otherwise(F.col("country_id"))),
    }


@query
def dq_declared_rules(s):
    return quality.constraint_report(_faulty_delivery(s))


@query
def dq_declared_references(s):
    return quality.reference_report(_faulty_delivery(s))


@query
def dq_rejects(s):
    raw = star_raw.order_texts(s)
    return quality.reject_report(raw, {
        "number_text": cleaning.to_number("number_text"), "date_text": cleaning.to_date("date_text")
    })


@query
def load_rejects(s):
    """What each loader leaves out of faulty sheets when every seventh company is unknown."""
    firms, layout = s.companies().where("company_id % 7 != 0"), grids.MonthLayout(anchor=s.last_month())
    months = star_raw.macro_cells(s).withColumn("value", F.when(
        (F.col("col_no") >= layout.first_month_col) & (F.col("col_no") % 17 == 0), F.lit("?")).otherwise(F.col("value")))
    return rejects.counts(
        rejects.membership_rejects(star_raw.membership_lines(s), firms),
        rejects.price_rejects(star_raw.faulty_cells(star_raw.price_cells(s)), firms),
        rejects.statement_rejects(star_raw.faulty_cells(star_raw.statement_cells(s, "QUARTERLY")), firms),
        rejects.month_rejects(months, layout),
        rejects.rate_rejects(star_raw.faulty_cells(star_raw.rate_cells(s))),
    )


@query
def coverage_table_counts(s):
    return quality.table_counts({
        "companies": s.companies(), "index_membership": s.membership(), "prices_weekly": s.prices(),
        "financials": s.financials(), "macro_indicators": s.macro(), "interest_rates": s.rates(),
    })


@query
def coverage_profile(s):
    def scoped(df, scope, group):
        return df.select(F.lit(scope).alias("scope"), group.alias("member"), "first_date", "last_date", "entities", "records")

    prices = quality.coverage_profile(s.prices(), "price_date", "company_id")
    statements = quality.coverage_profile(s.financials(), "period_end_date", "company_id", ["period_type"])
    series = quality.coverage_profile(s.macro(), "indicator_date", "indicator_name", ["country_id"])
    return (
        scoped(prices, "prices_weekly", F.lit("all"))
        .unionByName(scoped(statements, "financials", F.col("period_type")))
        .unionByName(scoped(series, "macro_indicators", F.col("country_id")))
    )


@query
def coverage_members(s):
    return quality.members_per_snapshot(s.membership())


@query
def coverage_by_year(s):
    return quality.entities_by_year(s.financials("ANNUAL"), "period_end_date", "company_id")


@query
def coverage_continuity(s):
    names = ["Supplier#000000001", "Supplier#000000004", "Supplier#000000009"]
    return quality.continuity(s.financials("ANNUAL"), s.companies(), names, by="company_name")


@query
def coverage_nonnull_points(s):
    return quality.data_points_by_year(s.financials("QUARTERLY"), "period_end_date", "company_id", schemas.MEASURES)


# --- scalar functions ---------------------------------------------------------

@query
def fn_period_buckets(s):
    day = F.col("o_orderdate").cast("date")
    daily = s.table("orders").groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    return daily.groupBy(
        F.year("day").alias("year"), periods.year_month("day").alias("year_month"),
        periods.quarter_label("day").alias("quarter"), periods.year_quarter("day").alias("year_quarter"),
    ).agg(F.sum("n").alias("orders"))


@query
def ratio_guarded(s):
    rows = s.financials("QUARTERLY")
    return rows.select(
        "company_id", "period_end_date",
        F.round(S.positive_ratio("ebitda", "interest_expense"), 6).alias("icr"),
        F.round(S.ratio("free_cash_flow", "total_debt"), 6).alias("fcf_to_debt"),
        F.round(S.positive_ratio("revenue", "ebitda"), 6).alias("revenue_to_ebitda"),
    )


@query
def band_thresholds(s):
    rows = s.financials("ANNUAL").select(
        S.band(S.positive_ratio("ebitda", "interest_expense"), [(1.4, "weak"), (1.6, "fair")], "strong or unknown").alias("coverage_band"),
        S.band_above(S.positive_ratio("total_debt", "revenue") * 100, [(35, "high"), (30, "middle")], "low").alias("debt_band"),
    )
    return rows.groupBy("coverage_band", "debt_band").agg(F.count("*").alias("firms"))


@query
def label_periods(s):
    rows = s.table("orders").groupBy(F.year("o_orderdate").alias("year")).agg(
        F.count("*").alias("n"), A.exact_sum(A.scaled("o_totalprice"), 100).alias("v")
    )
    labelled = rows.withColumn("economic_period", S.label_in("year", LABELS, "Normal"))
    return labelled.groupBy("economic_period").agg(
        F.sum("n").alias("orders"), F.round(S.ratio(F.sum("v"), F.sum("n")), 4).alias("mean_value")
    )


@query
def growth_pct(s):
    rows = panel.with_growth(s.financials("ANNUAL"), "company_id", "period_end_date", "revenue", "growth")
    return rows.select("company_id", "period_end_date", F.round("growth", 6).alias("growth"))


@query
def annualise_returns(s):
    rows = s.prices().join(s.companies().select("company_id", "country_id"), "company_id")
    means = rows.groupBy("country_id", F.year("price_date").alias("year")).agg(F.avg("total_return").alias("m"))
    return means.select(
        "country_id", "year", F.round(S.annualise("m", 4.33), 4).alias("monthly_return_pct"),
        F.round(S.annualise("m", 52), 4).alias("annual_return_pct"),
    )


@query
def scenario_rate_shock(s):
    return solvency.scenario_grid(_latest(s), s.companies(), s.last_year(), [100, 200, 300], [0.25, 0.5, 1.0])


@query
def fn_clip(s):
    rows = s.financials("ANNUAL").withColumn("icr", S.positive_ratio("ebitda", "interest_expense"))
    return rows.select("company_id", "period_end_date", F.round(S.clip_upper("icr", 1.5), 6).alias("icr_clipped"))


# --- filters --------------------------------------------------------------------

@query
def filter_equality(s):
    return s.companies().where(F.col("country_id") == "US").select("company_id", "ticker", "country_id")


@query
def filter_exclude_sector(s):
    rows = s.companies().where(S.excludes("gics_sector_name", "Financials"))
    return rows.select("company_id", "gics_sector_name")


@query
def filter_not_null(s):
    rows = s.membership().where(F.col("weight").isNotNull())
    return rows.select("index_id", "company_id", "as_of_date", F.col("weight").cast("double").alias("weight"))


@query
def filter_in_list(s):
    return s.companies().where(F.col("gics_sector_name").isin(cycles.HOUSING_SECTORS)).select("company_id", "gics_sector_name")


@query
def filter_pattern(s):
    rows = macro.series(s.macro(), macro.REAL_GDP_YOY)
    return rows.select("country_id", "indicator_date", "indicator_name", F.round("indicator_value", 6).alias("indicator_value"))


@query
def filter_between(s):
    rows = s.financials("ANNUAL", (1997, 1999)).where(F.year("period_end_date").between(1997, 1999))
    return rows.select("company_id", F.year("period_end_date").alias("year"), "revenue")


@query
def topn_per_group(s):
    rows = concentration.top_members(s.membership(), "UKX", 10)
    return rows.select("year", "company_id", F.col("weight").cast("double").alias("weight"), "rank")


@query
def having_min_count(s):
    counts = s.companies().groupBy("country_id", "gics_sector_name").agg(F.count("*").alias("companies"))
    return counts.where(F.col("companies") >= 3)


@query
def membership_exits(s):
    rows = concentration.membership_changes(s.membership(), "UKX", s.last_year())
    return rows.where(F.col("status") == "EXIT")


@query
def semi_min_history(s):
    rows = s.financials("ANNUAL").where(F.col("interest_expense") > 0)
    enough = rows.groupBy("company_id").agg(F.count("*").alias("n")).where(F.col("n") >= RATE_YEARS)
    return rows.join(enough, "company_id", "left_semi").select("company_id", "period_end_date", "interest_expense")


# --- joins ----------------------------------------------------------------------

@query
def join_fact_dim(s):
    rows = s.financials("ANNUAL").join(s.companies(), "company_id")
    return rows.select("company_id", "company_name", "gics_sector_name", "period_end_date", "revenue")


@query
def join_left_single(s):
    hhi = concentration.hhi(s.membership())
    gdp = macro.yearly(s.macro(), macro.REAL_GDP_YOY, "gdp_growth", "GB").drop("country_id")
    return hhi.join(gdp, "year", "left").select("year", "hhi_index", F.round("gdp_growth", 6).alias("gdp_growth"))


@query
def join_left_composite(s):
    rows = leverage.statements(s.financials("ANNUAL"), s.companies())
    counts = rows.groupBy("country_id", "year").agg(F.count("*").alias("firms"))
    phases = macro.gdp_phase(s.macro()).select("country_id", "year", "gdp_phase")
    return counts.join(phases, ["country_id", "year"], "left")


@query
def join_period_align(s):
    rows = leverage.statements(s.financials("QUARTERLY"), s.companies(), "QUARTERLY", None)
    cells = rows.groupBy("country_id", periods.quarter_start("period_end_date").alias("quarter_start")).agg(
        F.count("*").alias("firms"), F.avg("revenue").alias("revenue")
    )
    starts = macro.quarterly(s.macro(), macro.HOUSING_STARTS, "starts")
    return cells.join(starts, ["country_id", "quarter_start"]).select(
        "country_id", periods.year_quarter("quarter_start").alias("year_quarter"), "firms",
        F.round("revenue", 2).alias("mean_revenue"), F.round("starts", 6).alias("housing_starts"),
    )


@query
def membership_entries(s):
    rows = concentration.membership_changes(s.membership(), "UKX", s.last_year())
    return rows.where(F.col("status") == "ENTRY")


@query
def rolling_window_range(s):
    return _rolling_volatility(s.financials("ANNUAL").withColumn("year", F.year("period_end_date")))


@query
def rolling_window_sliced(s):
    """The rolling moments with time cut into slices: a company isn't one task."""
    rows = panel.with_growth(s.financials("ANNUAL").withColumn("year", F.year("period_end_date")), "company_id", "period_end_date", "revenue", "growth")
    rows = panel.with_rolling_sliced(rows, "company_id", "year", "growth", WINDOW, slice_periods=WINDOW)
    return rows.where(F.col("roll_count") == WINDOW).select(
        "company_id", "year", F.round("roll_mean", 6).alias("mean_growth"), F.round("roll_std", 6).alias("volatility")
    )


@query
def join_on_period_expr(s):
    return concentration.member_returns(s.membership(), s.prices()).select(
        "year", F.round("avg_weekly_return", 6).alias("avg_weekly_return")
    )


@query
def join_exact_date(s):
    rows = regimes.returns_with_yields(s.prices(), s.companies(), s.rates("10Y_YIELD"))
    return rows.select(
        "price_date", "gics_sector_name", F.round("sector_return", 6).alias("sector_return"), F.round("yield_change", 6).alias("yield_change")
    )


@query
def latest_per_entity(s):
    return panel.latest_per_entity(s.prices(), "company_id", "price_date", ["close_price"]).withColumn(
        "close_price", F.round("close_price", 6)
    )


@query
def align_frequencies(s):
    rows = leverage.coverage_with_rates(s.financials("ANNUAL"), s.companies(), s.rates("POLICY_RATE"))
    return rows.select("company_id", "year", F.round("icr", 6).alias("icr"), F.round("policy_rate", 6).alias("policy_rate"))


# --- aggregations ---------------------------------------------------------------

@query
def agg_basic(s):
    rows = leverage.debt_to_revenue(s.financials("ANNUAL"), s.companies())
    return rows.groupBy("year", "country_id").agg(
        F.count("*").alias("firms"), F.round(F.sum("total_debt"), 2).alias("debt"), F.round(F.avg("debt_to_revenue"), 6).alias("mean_ratio"),
        F.round(F.min("debt_to_revenue"), 6).alias("min_ratio"), F.round(F.max("debt_to_revenue"), 6).alias("max_ratio"),
    )


@query
def agg_count_distinct(s):
    return s.macro().groupBy("country_id").agg(F.countDistinct("indicator_name").alias("indicators"))


@query
def agg_conditional(s):
    rows = solvency.coverage(s.financials("ANNUAL"), s.companies())
    low = F.col("icr") < 1.5
    return rows.groupBy("year").agg(
        F.count("*").alias("firms"), F.count_if(low).alias("low_firms"),
        F.round(F.sum(F.when(low, F.col("total_debt")).otherwise(0.0)), 2).alias("low_debt"),
    )


@query
def agg_share_pct(s):
    rows = solvency.coverage(s.financials("ANNUAL"), s.companies())
    counts = rows.groupBy("country_id").agg(F.count("*").alias("firms"), F.count_if(F.col("icr") < 1.5).alias("k"))
    return counts.select("country_id", "firms", F.round(S.share_pct(F.col("k"), F.col("firms")), 1).alias("low_pct"))


@query
def agg_listagg(s):
    return s.companies().groupBy("country_id").agg(
        A.string_list("gics_sector_name", distinct=True).alias("sectors"), F.count("*").alias("companies")
    )


@query
def agg_covariance(s):
    cpi = regimes.returns_with_cpi(s.prices(), s.companies(), s.macro()).where(F.col("cpi_change").isNotNull())
    by_cpi = cpi.groupBy("gics_sector_name").agg(F.count("*").alias("months"), F.round(A.covariance("monthly_return", "cpi_change"), 6).alias("cpi_covariance"))
    rate = regimes.returns_with_yields(s.prices(), s.companies(), s.rates("10Y_YIELD"))
    by_rate = rate.groupBy("gics_sector_name").agg(F.round(A.covariance("sector_return", "yield_change"), 6).alias("rate_covariance"))
    return by_cpi.join(by_rate, "gics_sector_name")


@query
def agg_correlation(s):
    rows = s.financials("ANNUAL").where(F.col("interest_expense").isNotNull())
    return rows.groupBy("company_id").agg(
        F.count("*").alias("years"), F.round(A.correlation("ebitda", "interest_expense"), 6).alias("correlation"),
        A.correlation("revenue", F.lit(1.0)).alias("constant_correlation"),
    )


@query
def agg_stddev(s):
    return s.prices().groupBy("company_id").agg(
        F.count("total_return").alias("weeks"), F.round(F.stddev_pop("total_return"), 4).alias("return_sigma")
    )


@query
def lag_of_aggregate(s):
    return macro.gdp_trend(s.macro()).select(
        "country_id", "year", F.round("gdp_growth", 6).alias("gdp_growth"), F.round("gdp_change", 6).alias("gdp_change")
    )


@query
def agg_max_by(s):
    return s.financials("ANNUAL").groupBy("company_id").agg(
        F.max("revenue").alias("best_revenue"), F.year(F.max_by("period_end_date", "revenue")).alias("best_year")
    )


@query
def pivot_regime(s):
    rows = regimes.regime_pivot(s.prices(), s.companies(), s.macro())
    return rows.select("gics_sector_name", *[F.round(c, 6).alias(c) for c in ("high_inflation", "low_inflation")])


@query
def agg_rate_by_year(s):
    return macro.yearly_rate(s.rates("10Y_YIELD"), "10Y_YIELD", "rate", "US").select("year", F.round("rate", 6).alias("rate")).orderBy("year")


# --- windows --------------------------------------------------------------------

@query
def lag_features(s):
    rows = panel.with_lags(s.financials("ANNUAL"), "company_id", "period_end_date", "total_debt", [1, 2])
    return rows.select("company_id", "period_end_date", "total_debt", "total_debt_lag1", "total_debt_lag2")


@query
def growth_yoy_lag12(s):
    cpi = s.macro().where(F.col("bloomberg_ticker").endswith("CPIIDX Index"))
    rows = panel.with_growth(cpi, ["country_id", "bloomberg_ticker"], "indicator_date", "indicator_value", "yoy", 12)
    return rows.select("country_id", "indicator_date", F.round("yoy", 6).alias("yoy"))


@query
def diff_series(s):
    rows = panel.with_difference(s.rates(), ["country_id", "rate_type"], "rate_date", "rate_value", "change")
    return rows.select("country_id", "rate_type", "rate_date", F.round("change", 6).alias("change"))


@query
def lag_quarters(s):
    starts = macro.quarterly(s.macro(), macro.HOUSING_STARTS, "starts")
    rows = panel.with_lags(starts, "country_id", "quarter_start", "starts", [2])
    return rows.select(
        "country_id", periods.year_quarter("quarter_start").alias("year_quarter"),
        F.round("starts", 6).alias("starts"), F.round("starts_lag2", 6).alias("starts_lag2"),
    )


@query
def streak_persistence(s):
    rows = solvency.coverage(s.financials("ANNUAL"), s.companies())
    rows = panel.with_streak(rows, "company_id", "year", F.col("icr") < 1.5, 3)
    return rows.select("company_id", "year", "streak")


@query
def monotone_decline(s):
    rows = panel.with_monotone_decline(s.financials("ANNUAL"), "company_id", "period_end_date", "total_debt")
    return rows.select("company_id", "period_end_date", "declining")


@query
def ntile_quartiles(s):
    rows = s.financials("ANNUAL").groupBy("company_id").agg(F.round(F.sum("revenue"), 4).alias("revenue"))
    return ranking.with_ntile(rows, 4, "revenue", "company_id", "quartile")


@query
def leadlag_profile(s):
    return regimes.leadlag_profile(s.prices(), s.companies(), s.macro())


# --- sorts and limits -----------------------------------------------------------

@query
def sort_multi_key(s):
    rows = leverage.statements(s.financials("ANNUAL"), s.companies())
    counts = rows.groupBy("year", "gics_sector_name").agg(F.count("*").alias("firms"))
    return counts.orderBy("year", F.desc("firms"), "gics_sector_name")


@query
def topk_global(s):
    rows = s.companies().where(F.col("gics_sector_name").isNotNull())
    counts = rows.groupBy("gics_sector_name").agg(F.count("*").alias("cnt"))
    return counts.orderBy(F.desc("cnt"), "gics_sector_name").limit(6)


# --- views ------------------------------------------------------------------------

@query
def view_company_details(s):
    return views.company_details(s.companies(), schemas.countries(s.spark))


@query
def view_financials_annual(s):
    rows = views.financials_annual(s.financials("ANNUAL"), s.companies())
    return rows.drop("currency").withColumn("interest_coverage_ratio", F.round("interest_coverage_ratio", 6)).withColumn(
        "gross_margin", F.round("gross_margin", 6)
    )


@query
def view_index_members(s):
    rows = views.index_members(s.membership(), s.companies(), schemas.indices(s.spark))
    return rows.select(
        "index_id", "index_name", "company_id", "as_of_date", "ticker", "company_name", "country_id", "gics_sector_name",
        *[F.col(c).cast("double").alias(c) for c in ("weight", "shares_outstanding", "price")],
    )


@query
def view_macro_country(s):
    return views.macro_with_country(s.macro(), schemas.countries(s.spark)).withColumn("indicator_value", F.round("indicator_value", 6))


# --- use case studies ---------------------------------------------------------------

@query
def q_uc1_q1_top10_concentration(s):
    return concentration.top_concentration(s.membership(), s.companies(), s.macro())


@query
def q_uc1_q2_hhi(s):
    return concentration.hhi_with_returns(s.membership(), s.prices())


@query
def q_uc1_q3_index_churn(s):
    return concentration.index_churn(s.membership(), s.companies(), last_year=s.last_year())


@query
def q_uc2_q1_leverage_distribution(s):
    return leverage.leverage_distribution(s.financials("ANNUAL"), s.companies(), LABELS)


@query
def q_uc2_q2_deleveraging(s):
    return leverage.deleveraging_by_phase(s.financials("ANNUAL"), s.companies(), s.macro())


@query
def q_uc2_q3_rate_sensitivity(s):
    return leverage.rate_sensitivity(s.financials("ANNUAL"), s.companies(), s.rates("POLICY_RATE"), WINDOW, RATE_YEARS)


@query
def q_uc3_q1_zombies(s):
    return solvency.persistent_zombies(s.financials("ANNUAL"), s.companies(), s.macro())


@query
def q_uc3_q2_rate_shock(s):
    return solvency.rate_shock(_latest(s), s.companies(), s.last_year(), healthy=1.7)


@query
def q_uc3_q3_geo_risk(s):
    return solvency.geographic_risk(_latest(s), s.companies(), s.macro(), s.last_year())


@query
def q_uc4_q1_housing_lead(s):
    return cycles.housing_lead(s.financials("QUARTERLY"), s.companies(), s.macro())


@query
def q_uc4_q2_volatility_quartiles(s):
    return cycles.volatility_quartiles(s.financials("ANNUAL"), s.companies(), WINDOW, MIN_YEARS)


@query
def q_uc4_q3_resilience(s):
    return cycles.downturn_resilience(s.financials("QUARTERLY"), s.companies(), s.macro())


@query
def q_uc5_q1_inflation_regime(s):
    return regimes.inflation_regime(s.prices(), s.companies(), s.macro())


@query
def q_uc5_q2_cpi_leadlag(s):
    return regimes.cpi_sensitivity(s.prices(), s.companies(), s.macro())


@query
def q_uc5_q3_rate_profile(s):
    return regimes.rate_profile(s.prices(), s.companies(), s.rates("10Y_YIELD"))


# --- variants ---------------------------------------------------------------------

@query
def q_v_uc1_q1_export(s):
    return concentration.top_weight(s.membership())


@query
def q_v_uc1_q2_export(s):
    return concentration.hhi(s.membership())


@query
def q_v_uc1_q3_pivot(s):
    return concentration.churn_counts(s.membership(), last_year=s.last_year())


@query
def q_v_uc1_q2_report(s):
    """Concentration with the report's bands, for weights as fractions."""
    fractions = s.membership().withColumn("weight", (F.col("weight") / 100).cast("decimal(10,8)"))
    out = concentration.hhi(fractions, bands=[(0.15, "Unconcentrated"), (0.25, "Moderately Concentrated")])
    return out.select("year", "num_members", "concentration_level")


@query
def q_v_uc2_q1_export(s):
    return leverage.leverage_distribution(s.financials("ANNUAL"), s.companies(), None)


@query
def q_v_uc2_q2_by_sector(s):
    return leverage.deleveraging_by_sector(s.financials("ANNUAL"), s.companies())


@query
def q_v_uc2_q2_by_year(s):
    return leverage.deleveraging_by_year(s.financials("ANNUAL"), s.companies())


@query
def q_v_uc2_q3_export(s):
    return leverage.rate_sensitivity(s.financials("ANNUAL"), s.companies(), s.rates("POLICY_RATE"), WINDOW, RATE_YEARS, limit=100)


@query
def q_v_uc2_q3_semi(s):
    return leverage.rate_correlation_all(s.financials("ANNUAL"), s.companies(), s.rates("POLICY_RATE"), WINDOW, RATE_YEARS)


@query
def q_v_uc3_q1_by_sector(s):
    return solvency.zombies_by_sector(s.financials("ANNUAL"), s.companies())


@query
def q_v_uc3_q1_all(s):
    return solvency.zombies_all(s.financials(), s.companies())


@query
def q_v_uc3_q2_report(s):
    rows = solvency.rate_shock(_latest(s), s.companies(), s.last_year(), require_debt="positive")
    return rows.select("country_id", "total_companies", "newly_distressed", "avg_current_icr", "avg_shocked_icr")


@query
def q_v_uc3_q3_report(s):
    return solvency.geographic_risk(_latest(s), s.companies(), s.macro(), s.last_year())


@query
def q_v_uc3_q2_min10(s):
    rows = solvency.rate_shock(_latest(s), s.companies(), s.last_year(), min_firms=10)
    return rows.select(
        "country_id", F.col("total_companies").alias("companies"), F.col("avg_current_icr").alias("current_icr"),
        F.col("avg_shocked_icr").alias("shocked_icr"), "newly_distressed",
    ).orderBy(F.desc("companies"), "country_id")


@query
def q_v_uc4_q1_annual(s):
    return cycles.housing_lead(s.financials("ANNUAL"), s.companies(), s.macro(), "ANNUAL")


@query
def q_v_uc4_q2_report(s):
    return cycles.volatility_quartiles(s.financials("ANNUAL"), s.companies(), WINDOW, MIN_YEARS)


@query
def q_v_uc4_q2_export(s):
    return cycles.volatility_quartiles(s.financials("ANNUAL"), s.companies(), WINDOW, MIN_YEARS, with_sectors=False)


@query
def vol_by_sector_full_history(s):
    rows = cycles.volatility_by_sector(s.financials("ANNUAL"), s.companies(), MIN_YEARS)
    return rows.select("gics_sector_name", "companies", *[F.round(c, 6).alias(c) for c in ("avg_vol", "min_vol", "max_vol")])


@query
def q_v_uc4_q3_annual(s):
    return cycles.downturn_resilience(s.financials("ANNUAL"), s.companies(), s.macro(), "ANNUAL")


@query
def q_v_uc5_q1_yoy_regime(s):
    return regimes.yoy_regime(s.macro())


@query
def q_v_uc5_q1_report(s):
    return regimes.regime_report(s.prices(), s.companies(), s.macro())


# --- extensions -------------------------------------------------------------------

@query
def ext_hierarchy_rollup(s):
    return extensions.hierarchy_rollup(s.companies())


@query
def ext_hierarchy_recursive(s):
    """Companies as a tree of any depth (the parent of number n is n / 2) with counts and market caps of subtrees."""
    firms = s.companies().select("company_id", "current_market_cap")
    links = firms.where("company_id > 0").select("company_id", F.floor(F.col("company_id") / 2).alias("parent_id"))
    out = hierarchy.rollup(links, "company_id", "parent_id", firms, "company_id", ["current_market_cap"])
    return out.select(F.col("node").alias("company_id"), F.col("depth").cast("long").alias("depth"), "members",
                      F.col("current_market_cap").cast("double").alias("market_cap"))


@query
def ext_asof_sliced(s):
    """Statements available at each price date, a company's time cut into slices of a year."""
    return extensions.available_statements(s.prices(), s.financials(), slice_days=365)


@query
def ext_membership_flag_lag(s):
    return extensions.membership_flag_changes(s.membership(), "UKX")


@query
def ext_churn_size_compare(s):
    return extensions.churn_size(s.membership(), "UKX")


@query
def ext_rolling_beta(s):
    return regimes.rolling_beta(s.prices(), s.companies(), s.rates("10Y_YIELD"))


@query
def ext_weighted_return(s):
    return regimes.weighted_sector_returns(s.prices(), s.companies())


@query
def ext_lead_persistence(s):
    return extensions.lead_persistence(s.financials("ANNUAL"), s.companies())


@query
def ext_trend_slope(s):
    return extensions.gdp_slope(s.macro())


@query
def ext_concentration_gdp(s):
    return extensions.concentration_gdp_correlation(s.membership(), s.macro())


@query
def ext_asof_available(s):
    return extensions.available_statements(s.prices(), s.financials())


@query
def ext_percentiles(s):
    return extensions.leverage_percentiles(s.financials("ANNUAL"), s.companies())


@query
def ext_housing_corr(s):
    return cycles.housing_correlation(s.financials("QUARTERLY"), s.companies(), s.macro())


@query
def ext_quartile_by_phase(s):
    return cycles.quartile_by_phase(s.financials("ANNUAL"), s.companies(), s.macro(), WINDOW, MIN_YEARS)


@query
def ext_compound_return(s):
    return regimes.compound_returns(s.prices())


def long_integers(df: DataFrame) -> DataFrame:
    """Widen integer columns, so year, rank and count columns have one type everywhere."""
    return df.select(*[F.col(n).cast("long").alias(n) if t in ("int", "smallint", "tinyint") else F.col(n) for n, t in df.dtypes])


def run(name: str, star: Star) -> DataFrame:
    return long_integers(QUERIES[name](star))
