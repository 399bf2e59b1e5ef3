"""Studies the workload describes in words only; no stored result defines them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.functions.aggregates import correlation
from tidepanel.operators.joins import asof_join
from tidepanel.operators.ranking import percentiles
from tidepanel.plans import concentration, macro as macro_plans, solvency
from tidepanel.plans.leverage import debt_to_revenue

LEVELS = ["gics_sector_name", "gics_industry_group_name", "gics_industry_name", "gics_sub_industry_name"]


def hierarchy_rollup(companies: DataFrame) -> DataFrame:
    """Companies and market cap at every level of the sector hierarchy.

    Leaves are aggregated first, so the rollup multiplies leaf rows and not companies."""
    leaves = companies.groupBy(*LEVELS).agg(F.count("*").alias("n"), F.sum("current_market_cap").alias("cap"))
    return leaves.rollup(*LEVELS).agg(
        F.grouping_id().alias("level"), F.sum("n").alias("companies"), F.sum("cap").cast("double").alias("market_cap")
    )


def membership_flag_changes(membership: DataFrame, index_id: str) -> DataFrame:
    """Joined, left and stayed per year from a lagged membership flag on a full company-year spine, from the first
    to the last year that the index has members in.

    Years are exploded from a range inside each company row, so no cross join is needed."""
    rows = membership.where(F.col("index_id") == index_id).select("company_id", F.year("as_of_date").alias("year"))
    first, last = (rows.agg(f("year").alias("year")).scalar() for f in (F.min, F.max))
    years = rows.groupBy("company_id").agg(F.collect_set("year").alias("member_years"))
    spine = years.select(
        "company_id", "member_years", F.explode(F.sequence(first, last)).alias("year")
    ).withColumn("flag", F.array_contains("member_years", F.col("year")).cast("int"))
    win = Window.partitionBy("company_id").orderBy("year")
    moved = spine.withColumn("change", F.col("flag") - F.lag("flag").over(win))
    return (
        moved.groupBy("year")
        .agg(
            F.count_if(F.col("change") == 1).alias("joined"), F.count_if(F.col("change") == -1).alias("left_index"),
            F.count_if((F.col("change") == 0) & (F.col("flag") == 1)).alias("stayed"),
        )
        .orderBy("year")
    )


def churn_size(membership: DataFrame, index_id: str) -> DataFrame:
    """Mean size (price x shares) of members in their last year against those that stayed."""
    sized = membership.where(F.col("index_id") == index_id).select(
        "company_id", F.year("as_of_date").alias("year"),
        (F.col("price").cast("double") * F.col("shares_outstanding").cast("double")).alias("size"),
    )
    last_year = membership.where(F.col("index_id") == index_id).agg(F.max(F.year("as_of_date")).alias("year")).scalar()
    gone = concentration.membership_changes(membership, index_id, last_year).where(F.col("status") == "EXIT")
    marked = sized.join(gone, ["company_id", "year"], "left").where(F.col("year") < last_year)
    return (
        marked.groupBy("year", F.when(F.col("status").isNull(), "STAYER").otherwise("LEAVER").alias("status"))
        .agg(F.count("*").alias("members"), F.round(F.avg("size"), 2).alias("avg_size"))
        .orderBy("year", "status")
    )


def lead_persistence(financials: DataFrame, companies: DataFrame, threshold: float = 1.5) -> DataFrame:
    """Per year: firms below the threshold now and on the next two rows (streak starts, by looking ahead)."""
    rows = solvency.coverage(financials, companies)
    win = Window.partitionBy("company_id").orderBy("year")
    low = F.col("icr") < threshold
    ahead = rows.withColumn("low", low).withColumns({"low1": F.lead("low", 1).over(win), "low2": F.lead("low", 2).over(win)})
    return (
        ahead.where(F.col("low2").isNotNull())
        .groupBy("year")
        .agg(F.count("*").alias("firms"), F.count_if(F.col("low") & F.col("low1") & F.col("low2")).alias("persistent"))
        .orderBy("year")
    )


def gdp_slope(macro: DataFrame, years: int = 3) -> DataFrame:
    """Slope of mean GDP growth over the last ``years`` rows of each country."""
    yearly = macro_plans.yearly(macro, macro_plans.REAL_GDP_YOY, "gdp_growth")
    frame = Window.partitionBy("country_id").orderBy("year").rowsBetween(-(years - 1), 0)
    return (
        yearly.withColumn("n", F.count("*").over(frame))
        .withColumn("slope", F.regr_slope("gdp_growth", F.col("year").cast("double")).over(frame))
        .where(F.col("n") == years)
        .select("country_id", "year", F.round("gdp_growth", 6).alias("gdp_growth"), F.round("slope", 6).alias("slope"))
    )


def concentration_gdp_correlation(membership: DataFrame, macro: DataFrame, index_id: str = "UKX", n: int = 10) -> DataFrame:
    """Correlation of yearly top-n weight with GDP growth, per country."""
    weights = concentration.top_weight(membership, index_id, n).select("year", "top10_weight_pct")
    gdp = macro_plans.yearly(macro, macro_plans.REAL_GDP_YOY, "gdp_growth")
    return weights.join(gdp, "year").groupBy("country_id").agg(
        F.count("*").alias("years"), F.round(correlation("top10_weight_pct", "gdp_growth"), 6).alias("correlation")
    )


def available_statements(
    prices: DataFrame, financials: DataFrame, quarterly_days: int = 45, annual_days: int = 75, slice_days: int | None = None,
) -> DataFrame:
    """For each price week the latest statement already published, with no look-ahead.

    A period may have a quarterly and an annual statement; they appear on different days."""
    delay = F.when(F.col("period_type") == "ANNUAL", annual_days).otherwise(quarterly_days)
    published = financials.select(
        "company_id", "period_type", "period_end_date", "revenue",
        F.date_add("period_end_date", delay).alias("available_date"),
    )
    return asof_join(
        prices.select("company_id", "price_date"), published, "company_id", "price_date", "available_date",
        ["period_type", "period_end_date", "revenue"], slice_days,
    )


def leverage_percentiles(financials: DataFrame, companies: DataFrame) -> DataFrame:
    """Exact cross-sectional percentiles of debt/revenue per year."""
    rows = debt_to_revenue(financials, companies).select("year", "company_id", "debt_to_revenue")
    cuts = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
    out = percentiles(rows, ["year"], "debt_to_revenue", "company_id", cuts, max_groups=200)
    return out.select("year", "n", *[F.round(c, 6).alias(c) for c in cuts]).orderBy("year")
