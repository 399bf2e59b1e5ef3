"""Index concentration and churn."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions.aggregates import string_list
from tidepanel.functions.scalars import annualise, band
from tidepanel.operators.joins import broadcast_bounded
from tidepanel.operators.panel import with_periods_since
from tidepanel.operators.ranking import top_n
from tidepanel.plans import macro as macro_plans

HHI_BANDS = [(1500, "Unconcentrated"), (2500, "Moderately Concentrated")]
HHI_TOP = "Highly Concentrated"
_MAX_YEARS = 100


def weighted_members(membership: DataFrame, index_id: str) -> DataFrame:
    """Members of one index with a weight, by year."""
    return (
        membership.where((F.col("index_id") == index_id) & F.col("weight").isNotNull())
        .withColumn("year", F.year("as_of_date"))
    )


def top_members(membership: DataFrame, index_id: str, n: int) -> DataFrame:
    order = [F.col("weight").desc(), F.col("company_id")]
    return top_n(weighted_members(membership, index_id), ["year"], order, n)


def top_weight(membership: DataFrame, index_id: str = "UKX", n: int = 10) -> DataFrame:
    """Per year: summed weight and count of the n largest members."""
    return (
        top_members(membership, index_id, n)
        .groupBy("year")
        .agg(F.sum("weight").cast("double").alias("top10_weight_pct"), F.count("*").alias("top10_count"))
        .orderBy("year")
    )


def top_concentration(
    membership: DataFrame, companies: DataFrame, macro: DataFrame,
    index_id: str = "UKX", country: str = "GB", n: int = 10,
) -> DataFrame:
    """Per year: weight of the n largest members, their names, and mean GDP growth.

    The n rows per year are the side of known size, so they are the broadcast one
    and the company table is streamed without a shuffle.
    """
    top = broadcast_bounded(top_members(membership, index_id, n).select("year", "company_id", "weight", "rank"), n * _MAX_YEARS)
    named = companies.select("company_id", "company_name").join(top, "company_id")
    weights = named.groupBy("year").agg(
        F.round(F.sum("weight").cast("double"), 2).alias("top10_weight_pct"),
        string_list("company_name", order="rank").alias("top10_companies"),
    )
    gdp = macro_plans.yearly(macro, macro_plans.REAL_GDP_YOY, "gdp_growth", country).drop("country_id")
    return (
        weights.join(gdp, "year", "left")
        .select("year", "top10_weight_pct", F.round("gdp_growth", 2).alias("uk_gdp_growth_pct"), "top10_companies")
        .orderBy("year")
    )


def hhi(
    membership: DataFrame, index_id: str = "UKX", bands=HHI_BANDS, top_band: str = HHI_TOP,
) -> DataFrame:
    """Per year: sum of squared weights, members, mean and greatest weight, effective positions, band."""
    sums = weighted_members(membership, index_id).groupBy("year").agg(
        F.sum(F.col("weight") * F.col("weight")).cast("double").alias("hhi"),
        F.count("*").alias("num_members"),
        F.sum("weight").cast("double").alias("sum_weight"),
        F.max("weight").cast("double").alias("max_weight"),
    )
    return sums.select(
        "year",
        F.round("hhi", 2).alias("hhi_index"),
        "num_members",
        F.round(F.col("sum_weight") / F.col("num_members"), 2).alias("avg_weight_pct"),
        F.round("max_weight", 2).alias("largest_weight_pct"),
        F.round(F.try_divide(F.lit(10000.0), F.col("hhi")), 1).alias("effective_positions"),
        band("hhi", bands, top_band).alias("concentration_level"),
    ).orderBy("year")


def member_returns(membership: DataFrame, prices: DataFrame, index_id: str = "UKX") -> DataFrame:
    """Per year: mean weekly return of the companies that were members in that year.

    Prices are reduced to one row per company and year before the join."""
    yearly = prices.groupBy("company_id", F.year("price_date").alias("year")).agg(
        F.sum("total_return").alias("ret"), F.count("total_return").alias("weeks")
    )
    members = membership.where(F.col("index_id") == index_id).select("company_id", F.year("as_of_date").alias("year"))
    return yearly.join(members, ["company_id", "year"]).groupBy("year").agg(
        F.try_divide(F.sum("ret"), F.sum("weeks")).alias("avg_weekly_return")
    )


def hhi_with_returns(
    membership: DataFrame, prices: DataFrame, index_id: str = "UKX", periods_per_year: float = 52,
) -> DataFrame:
    returns = member_returns(membership, prices, index_id)
    return (
        hhi(membership, index_id)
        .join(returns, "year", "left")
        .withColumn("approx_annual_return_pct", F.round(annualise("avg_weekly_return", periods_per_year), 2))
        .drop("avg_weekly_return")
        .orderBy("year")
    )


def member_years(membership: DataFrame, index_id: str, last_year: int | Column | None = None) -> DataFrame:
    """Member years of each company, marked where it entered (no membership in the year before)
    and where it left. An exit carries the last member year; the final year cannot show exits; unless it is given it is the last one that the index has members in.

    One pass over each company's years finds both, without a self-join."""
    years = membership.where(F.col("index_id") == index_id).select("company_id", F.year("as_of_date").alias("year")).distinct()
    if last_year is None:
        last_year = years.agg(F.max("year").alias("year")).scalar()
    near = with_periods_since(years, "company_id", "year")
    entered = F.col("prev_period").isNull() | (F.col("prev_period") != F.col("year") - 1)
    left = (F.col("next_period").isNull() | (F.col("next_period") != F.col("year") + 1)) & (F.col("year") < last_year)
    return near.select("company_id", "year", entered.alias("entered"), left.alias("left_after"))


def membership_changes(membership: DataFrame, index_id: str, last_year: int | Column | None = None) -> DataFrame:
    """One row per entry and per exit."""
    status = F.array_compact(F.array(F.when(F.col("entered"), F.lit("ENTRY")), F.when(F.col("left_after"), F.lit("EXIT"))))
    return member_years(membership, index_id, last_year).select("company_id", "year", F.explode(status).alias("status"))


def index_churn(membership: DataFrame, companies: DataFrame, index_id: str = "UKX", last_year: int | Column | None = None) -> DataFrame:
    """Per year and status: how many companies entered or left, and their names."""
    changes = membership_changes(membership, index_id, last_year)
    return (
        changes.join(companies.select("company_id", "company_name"), "company_id")
        .groupBy("year", "status")
        .agg(F.count("*").alias("company_count"), string_list("company_name").alias("companies"))
        .orderBy("year", "status")
    )


def churn_counts(membership: DataFrame, index_id: str = "UKX", last_year: int | Column | None = None) -> DataFrame:
    """Entries and exits as two columns for every member year, years without a change included."""
    return (
        member_years(membership, index_id, last_year)
        .groupBy("year")
        .agg(F.count_if("entered").alias("entries"), F.count_if("left_after").alias("exits"))
        .orderBy("year")
    )
