"""Domain schemas, keys and the constant dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_S, _L, _D, _F = T.StringType(), T.LongType(), T.DateType(), T.DoubleType()

COUNTRIES = _struct(("country_id", _S), ("country_name", _S), ("currency", _S))
INDICES = _struct(("index_id", _S), ("index_name", _S), ("country_id", _S), ("currency", _S))
SECTORS = _struct(
    ("sector_id", _L), ("sector_name", _S), ("industry_group_name", _S),
    ("industry_name", _S), ("sub_industry_name", _S),
)
COMPANIES = _struct(
    ("company_id", _L), ("ticker", _S), ("company_name", _S), ("country_id", _S), ("currency", _S),
    ("gics_sector_name", _S), ("gics_industry_group_name", _S), ("gics_industry_name", _S),
    ("gics_sub_industry_name", _S), ("current_market_cap", T.DecimalType(20, 2)),
    ("is_active", T.BooleanType()),
)
MEMBERSHIP = _struct(
    ("index_id", _S), ("company_id", _L), ("as_of_date", _D), ("weight", T.DecimalType(10, 6)),
    ("shares_outstanding", T.DecimalType(20, 6)), ("price", T.DecimalType(15, 4)),
)
PRICES = _struct(("company_id", _L), ("price_date", _D), ("close_price", _F), ("total_return", _F))
MEASURES = [
    "revenue", "ebitda", "interest_expense", "free_cash_flow",
    "gross_profit", "total_debt", "cost_of_goods_sold",
]
FINANCIALS = _struct(
    ("company_id", _L), ("period_end_date", _D), ("period_type", _S),
    *[(m, _F) for m in MEASURES], ("currency", _S),
)
MACRO = _struct(
    ("country_id", _S), ("indicator_date", _D), ("indicator_name", _S), ("bloomberg_ticker", _S),
    ("indicator_value", _F), ("indicator_category", _S),
)
RATES = _struct(
    ("country_id", _S), ("rate_date", _D), ("rate_type", _S), ("bloomberg_ticker", _S), ("rate_value", _F),
)

TABLES = {
    "countries": COUNTRIES, "indices": INDICES, "gics_sectors": SECTORS, "companies": COMPANIES,
    "index_membership": MEMBERSHIP, "prices_weekly": PRICES, "financials": FINANCIALS,
    "macro_indicators": MACRO, "interest_rates": RATES,
}

KEYS = {
    "countries": ["country_id"],
    "indices": ["index_id"],
    "gics_sectors": ["sector_id"],
    "companies": ["company_id"],
    "index_membership": ["index_id", "company_id", "as_of_date"],
    "prices_weekly": ["company_id", "price_date"],
    "financials": ["company_id", "period_end_date", "period_type"],
    "macro_indicators": ["country_id", "indicator_date", "bloomberg_ticker"],
    "interest_rates": ["country_id", "rate_date", "rate_type"],
}

NOT_NULL = {
    "companies": ["ticker"],
    "index_membership": ["index_id", "company_id", "as_of_date"],
    "prices_weekly": ["company_id", "price_date"],
    "financials": ["company_id", "period_end_date", "period_type"],
    "macro_indicators": ["country_id", "indicator_date", "indicator_name"],
    "interest_rates": ["country_id", "rate_date", "rate_type"],
}

# Unique columns beside the key.
UNIQUE = {"companies": [["ticker"]]}

# (child table, child column, parent table, parent column)
REFERENCES = [
    ("indices", "country_id", "countries", "country_id"),
    ("companies", "country_id", "countries", "country_id"),
    ("index_membership", "index_id", "indices", "index_id"),
    ("index_membership", "company_id", "companies", "company_id"),
    ("prices_weekly", "company_id", "companies", "company_id"),
    ("financials", "company_id", "companies", "company_id"),
    ("macro_indicators", "country_id", "countries", "country_id"),
    ("interest_rates", "country_id", "countries", "country_id"),
]

# The constant dimension rows.
COUNTRY_ROWS = [
    ("US", "United States", "USD"),
    ("GB", "United Kingdom", "GBP"),
    ("DE", "Germany", "EUR"),
    ("JP", "Japan", "JPY"),
    ("CN", "China", "CNY"),
]
INDEX_ROWS = [
    ("SPX", "S&P 500", "US", "USD"),
    ("UKX", "FTSE 100", "GB", "GBP"),
]

# Column number -> (country, rate type, vendor ticker) of the rate sheet.
RATE_COLUMNS = {
    1: ("US", "10Y_YIELD", "USGG10YR Index"),
    2: ("GB", "10Y_YIELD", "GTGBP10Y Govt"),
    3: ("DE", "10Y_YIELD", "GTDEM10Y Govt"),
    4: ("JP", "10Y_YIELD", "GTJPY10Y Govt"),
    5: ("CN", "10Y_YIELD", "GTCNY10Y Govt"),
    6: ("US", "POLICY_RATE", "FDTR Index"),
    7: ("GB", "POLICY_RATE", "UKBRBASE Index"),
    8: ("DE", "POLICY_RATE", "EURR002W Index"),
    9: ("JP", "POLICY_RATE", "BOJDTR Index"),
    10: ("CN", "POLICY_RATE", "PBOC7P Index"),
}

# Vendor field code -> measure column of the statement sheets.
FIELD_CODES = {
    "SALES_REV_TURN": "revenue",
    "EBITDA": "ebitda",
    "IS_INT_EXPENSE": "interest_expense",
    "CF_FREE_CASH_FLOW": "free_cash_flow",
    "GROSS_PROFIT": "gross_profit",
    "SHORT_AND_LONG_TERM_DEBT": "total_debt",
    "ARD_COST_OF_GOODS_SOLD": "cost_of_goods_sold",
}


def constant(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    """A constant table as SQL VALUES: the optimizer knows its rows, and no Python job makes them."""
    text = ", ".join("(" + ", ".join(str(v) if isinstance(v, int) else "'" + v.replace("'", "\\'") + "'" for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {text} AS t({columns})")


def countries(spark: SparkSession) -> DataFrame:
    return constant(spark, COUNTRY_ROWS, "country_id, country_name, currency")


def indices(spark: SparkSession) -> DataFrame:
    return constant(spark, INDEX_ROWS, "index_id, index_name, country_id, currency")


def rate_columns(spark: SparkSession) -> DataFrame:
    rows = [(col, *meaning) for col, meaning in RATE_COLUMNS.items()]
    named = constant(spark, rows, "col_no, country_id, rate_type, bloomberg_ticker")
    return named.withColumn("col_no", named["col_no"].cast("long"))
