"""Domain tables derived from a star-schema sales database.

Suppliers act as companies, their sales lines as statements and prices, orders
as the macro series. Every builder reads only the columns it needs, and date
bounds are applied to the raw date column so they reach the Parquet scan.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions import cleaning, periods
from tidepanel.functions.aggregates import exact_sum, merge_parts, scaled, sum_parts, whole
from tidepanel.functions.scalars import pct_change
from tidepanel.operators.ranking import top_n

# Sector names by number and country codes by region number.
SECTORS = [
    "Energy", "Materials", "Industrials", "Consumer Discretionary", "Consumer Staples", "Health Care",
    "Financials", "Information Technology", "Communication Services", "Utilities", "Real Estate",
]
REGION_COUNTRY = ["US", "GB", "DE", "JP", "CN"]
REGION_CURRENCY = ["USD", "GBP", "EUR", "JPY", "CNY"]

# Indicator names; the vendor ticker is the country code and the short name.
INDICATORS = {
    "GDPYOY": "Real GDP (YoY %)",
    "GDPNOM": "Nominal GDP (USD bn)",
    "CPIYOY": "CPI (YoY %)",
    "CPIIDX": "CPI Index Level",
    "HOUSST": "Housing Starts (Units)",
    "EMPSHR": "Employment Share (%)",
}


def _pick(values: list[str], number: str) -> Column:
    """The value at a zero-based position given as a SQL expression."""
    items = ", ".join(f"'{v}'" for v in values)
    return F.expr(f"element_at(array({items}), cast({number} + 1 as int))")


def _annual_end() -> Column:
    return periods.year_end("bucket")


def _quarter_end() -> Column:
    """Last day of the quarter numbered year * 4 + quarter - 1."""
    year = F.floor(F.col("bucket") / 4).cast("int")
    month = ((F.col("bucket") % 4 + 1) * 3).cast("int")
    return F.last_day(F.make_date(year, month, F.lit(1)))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _once(build):
    """Keep the (lazy) frame a builder returned, so a study that asks twice plans it once."""

    @functools.wraps(build)
    def kept(self, *args, **kwargs):
        key = (build.__name__, args, tuple(sorted(kwargs.items())))
        if key not in self._frames:
            self._frames[key] = build(self, *args, **kwargs)
        return self._frames[key]

    return kept


class Star:
    """The domain tables of one star-schema folder, built lazily on request."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._frames: dict = {}

    @_once
    def table(self, name: str) -> DataFrame:
        return read(self.spark, self.sf_dir, name)

    @_once
    def last_year(self) -> int:
        """The year of the last sales line: the latest year of studies that look at one."""
        return self.table("lineitem").agg(F.year(F.max("l_shipdate"))).first()[0]

    def first_year(self) -> Column:
        """The year of the first sales line, as a subquery."""
        return self.table("lineitem").agg(F.year(F.min("l_shipdate")).alias("y")).scalar()

    def first_friday(self) -> Column:
        """The Friday of the first week with sales, as a subquery."""
        first = F.date_add(F.trunc(F.min("l_shipdate").cast("date"), "week"), 4)
        return self.table("lineitem").agg(first.alias("d")).scalar()

    def last_month(self) -> Column:
        """The first day of the last month with orders, as a subquery."""
        return self.table("orders").agg(F.trunc(F.max("o_orderdate").cast("date"), "month").alias("d")).scalar()

    def _lines(self, years: tuple[int, int] | None = None) -> DataFrame:
        lines = self.table("lineitem")
        if years:
            # The stored column is a timestamp: compare it directly so the bounds are pushed down.
            first = F.lit(f"{years[0]:04d}-01-01").cast("timestamp_ntz")
            last = F.lit(f"{years[1] + 1:04d}-01-01").cast("timestamp_ntz")
            lines = lines.where((F.col("l_shipdate") >= first) & (F.col("l_shipdate") < last))
        return lines

    @_once
    def companies(self) -> DataFrame:
        nation = self.table("nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_regionkey")
        group = F.concat_ws(" ", "gics_sector_name", _pick(["Equipment", "Services"], "company_id % 2"))
        industry = F.concat_ws(" ", "gics_industry_group_name", _pick(["North", "South", "West"], "company_id % 3"))
        sub = F.concat_ws(" ", "gics_industry_name", _pick(["Large", "Small"], "company_id % 5 % 2"))
        sector = F.when(F.col("s_nationkey") != 24, _pick(SECTORS, "s_nationkey % 11"))
        return (
            self.table("supplier")
            .join(nation, "s_nationkey")
            .select(
                F.col("s_suppkey").alias("company_id"),
                F.concat(F.lit("S"), "s_suppkey", F.lit(" "), _pick(REGION_COUNTRY, "n_regionkey"), F.lit(" Equity")).alias("ticker"),
                F.col("s_name").alias("company_name"),
                _pick(REGION_COUNTRY, "n_regionkey").alias("country_id"),
                _pick(REGION_CURRENCY, "n_regionkey").alias("currency"),
                sector.alias("gics_sector_name"),
                F.col("s_acctbal").cast("decimal(20,2)").alias("current_market_cap"),
                F.lit(True).alias("is_active"),
            )
            .withColumn("gics_industry_group_name", F.when(F.col("gics_sector_name").isNotNull(), group))
            .withColumn("gics_industry_name", F.when(F.col("gics_sector_name").isNotNull(), industry))
            .withColumn("gics_sub_industry_name", F.when(F.col("gics_sector_name").isNotNull(), sub))
        )

    def _statement_parts(self, bucket: Column, years: tuple[int, int] | None) -> DataFrame:
        price, disc, tax = scaled("l_extendedprice"), scaled("l_discount"), scaled("l_tax")
        units = {
            "revenue": price * (100 - disc),
            "ebitda": price * (11 - disc),
            "interest_expense": price * tax,
            "free_cash_flow": F.when(F.col("l_linestatus") == "F", price * (100 - disc)).otherwise(price * disc * -10),
            "gross_profit": price * (40 - disc * 2),
            "total_debt": F.when(F.col("l_returnflag") == "R", price * 100),
            "cost_of_goods_sold": price * (60 + disc),
        }
        aggs = [part for name, expr in units.items() for part in sum_parts(expr, name)]
        return (
            self._lines(years)
            .groupBy(F.col("l_suppkey").alias("company_id"), bucket.alias("bucket"))
            .agg(*aggs)
        )

    @staticmethod
    def _statements(parts: DataFrame, period_end: Column, period_type: str) -> DataFrame:
        """Parts -> measures. Every 17th company does not report its interest."""
        value = {m: whole(m, 10000) for m in schemas.MEASURES}
        value["interest_expense"] = F.when(F.col("company_id") % 17 != 0, value["interest_expense"])
        return parts.select(
            "company_id", period_end.alias("period_end_date"), F.lit(period_type).alias("period_type"),
            *[value[m].alias(m) for m in schemas.MEASURES], F.lit(None).cast("string").alias("currency"),
        )

    @_once
    def financials(self, period_type: str | None = None, years: tuple[int, int] | None = None) -> DataFrame:
        """Statements of one period type, or of both from a single pass over the lines."""
        year = F.year("l_shipdate")
        quarter = year * 4 + F.quarter("l_shipdate") - 1
        if period_type == "ANNUAL":
            return self._statements(self._statement_parts(year, years), _annual_end(), "ANNUAL")
        quarters = self._statement_parts(quarter, years)
        quarterly = self._statements(quarters, _quarter_end(), "QUARTERLY")
        if period_type == "QUARTERLY":
            return quarterly
        annual = quarters.groupBy("company_id", F.floor(F.col("bucket") / 4).cast("int").alias("bucket")).agg(
            *[part for name in schemas.MEASURES for part in merge_parts(name)]
        )
        return self._statements(annual, _annual_end(), "ANNUAL").unionByName(quarterly)

    @_once
    def weekly_sales(self) -> DataFrame:
        """Sales of each company and week: value in cents, and quantity."""
        day = F.col("l_shipdate").cast("date")
        return (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("company_id"), F.trunc(day, "week").alias("monday"))
            .agg(exact_sum(scaled("l_extendedprice"), 100).alias("value"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"), F.count("*").alias("lines"))
            .select("company_id", F.date_add("monday", 4).alias("price_date"), "value", "quantity", "lines")
        )

    @_once
    def prices(self) -> DataFrame:
        """Weekly mean price and its change to the company's previous traded week."""
        win = Window.partitionBy("company_id").orderBy("price_date")
        return (
            self.weekly_sales()
            .select("company_id", "price_date", F.try_divide("value", "quantity").alias("close_price"))
            .withColumn("total_return", pct_change(F.col("close_price"), F.lag("close_price").over(win)))
        )

    @_once
    def membership(self, size: int = 30, us_size: int = 15) -> DataFrame:
        """Year-end members: UKX is the top sellers with weights, SPX the US ones without."""
        price, disc = scaled("l_extendedprice"), scaled("l_discount")
        sales = (
            self.table("lineitem")
            .groupBy(F.col("l_suppkey").alias("company_id"), F.year("l_shipdate").alias("year"))
            .agg(
                exact_sum(price * (100 - disc), 10000).alias("revenue"),
                exact_sum(price, 100).alias("value"),
                F.sum(F.col("l_quantity").cast("long")).alias("quantity"),
            )
        )
        order = [F.col("revenue").desc(), F.col("company_id")]
        ukx = top_n(sales, ["year"], order, size, "rank")
        # Revenues are multiples of 1e-4, so the sum over the few members is exact in decimals.
        total = F.sum(F.col("revenue").cast("decimal(28,4)")).over(Window.partitionBy("year")).cast("double")
        ukx = ukx.withColumn("weight", F.round(F.col("revenue") / total * 100, 6).cast("decimal(10,6)"))
        us = self.companies().where(F.col("country_id") == "US").select("company_id")
        spx = top_n(sales.join(us, "company_id"), ["year"], order, us_size, "rank")
        spx = spx.withColumn("weight", F.lit(None).cast("decimal(10,6)"))

        def shaped(df: DataFrame, index_id: str, shares: Column) -> DataFrame:
            return df.select(
                F.lit(index_id).alias("index_id"), "company_id", periods.year_end("year").alias("as_of_date"), "weight",
                shares.cast("decimal(20,6)").alias("shares_outstanding"),
                F.round(F.col("value") / F.col("quantity"), 4).cast("decimal(15,4)").alias("price"),
            )

        return shaped(ukx, "UKX", F.col("quantity")).unionByName(shaped(spx, "SPX", F.lit(None)))

    def _monthly_orders(self) -> DataFrame:
        region = (
            self.table("customer")
            .join(self.table("nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_regionkey"), "c_nationkey")
            .select(F.col("c_custkey").alias("o_custkey"), "n_regionkey")
        )
        return (
            self.table("orders")
            .select("o_custkey", "o_totalprice", "o_orderpriority", "o_orderstatus", F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month"))
            .join(region, "o_custkey")
            .groupBy("n_regionkey", "month")
            .agg(
                exact_sum(scaled("o_totalprice"), 100).alias("value"), F.count("*").alias("orders"),
                F.count_if(F.col("o_orderpriority") == "1-URGENT").alias("urgent"),
                F.count_if(F.col("o_orderstatus") == "F").alias("filled"),
            )
            .select(_pick(REGION_COUNTRY, "n_regionkey").alias("country_id"), F.col("month").alias("indicator_date"), "value", "orders", "urgent", "filled")
        )

    @_once
    def macro(self) -> DataFrame:
        """Monthly indicators per country in long form."""
        win = Window.partitionBy("country_id").orderBy("indicator_date")
        mean = F.col("value") / F.col("orders")
        monthly = self._monthly_orders().withColumn("mean", mean)
        series = {
            "GDPYOY": pct_change(F.col("value"), F.lag("value", 12).over(win)),
            "GDPNOM": F.col("value") / 1000000.0,
            "CPIYOY": pct_change(F.col("mean"), F.lag("mean", 12).over(win)),
            "CPIIDX": F.col("mean"),
            "HOUSST": F.col("urgent").cast("double"),
            "EMPSHR": F.col("filled") * 100.0 / F.col("orders"),
        }
        wide = monthly.select("country_id", "indicator_date", *[e.alias(k) for k, e in series.items()])
        names = F.create_map(*[F.lit(x) for pair in INDICATORS.items() for x in pair])
        return (
            wide.unpivot(["country_id", "indicator_date"], list(series), "code", "indicator_value")
            .where(F.col("indicator_value").isNotNull())
            .withColumn("indicator_name", F.element_at(names, F.col("code")))
            .select(
                "country_id", "indicator_date", "indicator_name",
                F.concat("country_id", "code", F.lit(" Index")).alias("bloomberg_ticker"),
                "indicator_value", cleaning.category("indicator_name").alias("indicator_category"),
            )
        )

    @_once
    def rates(self, rate_type: str | None = None) -> DataFrame:
        """Weekly rates per country: mean tax as the 10-year yield, mean discount as the policy rate."""
        country = self.companies().select(F.col("company_id").alias("l_suppkey"), "country_id")
        weekly = (
            self.table("lineitem")
            .select("l_suppkey", "l_tax", "l_discount", F.trunc(F.col("l_shipdate").cast("date"), "week").alias("monday"))
            .join(country, "l_suppkey")
            .groupBy("country_id", "monday")
            .agg(F.count("*").alias("n"), F.sum(scaled("l_tax")).alias("tax"), F.sum(scaled("l_discount")).alias("disc"))
        )
        kinds = {"10Y_YIELD": F.col("tax") / F.col("n"), "POLICY_RATE": F.col("disc") / F.col("n")}
        if rate_type:
            kinds = {rate_type: kinds[rate_type]}
        wide = weekly.select("country_id", F.date_add("monday", 4).alias("rate_date"), *[e.alias(k) for k, e in kinds.items()])
        tickers = {(c, t): v for c, t, v in schemas.RATE_COLUMNS.values()}
        names = F.create_map(*[F.lit(x) for (c, t), v in tickers.items() for x in (f"{c}|{t}", v)])
        long = wide.unpivot(["country_id", "rate_date"], list(kinds), "rate_type", "rate_value")
        return long.select(
            "country_id", "rate_date", "rate_type",
            F.element_at(names, F.concat_ws("|", "country_id", "rate_type")).alias("bloomberg_ticker"), "rate_value",
        )
