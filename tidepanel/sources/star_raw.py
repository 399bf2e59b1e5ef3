"""Raw vendor-style text derived from the star schema, for the ingest operators.

The cells carry the texts a vendor sheet has: thousands commas, no-value tokens,
dates in several formats, entities as groups of columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions.aggregates import scaled
from tidepanel.sources.star import INDICATORS, REGION_COUNTRY, Star

#: Sheet row of the first period.
FIRST_ROW = 6


def _by_priority(texts: dict[str, Column], otherwise: Column) -> Column:
    out = None
    for priority, text in texts.items():
        test = F.col("o_orderpriority") == priority
        out = F.when(test, text) if out is None else out.when(test, text)
    return out.otherwise(otherwise)


def order_texts(star: Star) -> DataFrame:
    """Per order: a number text, a date text and a label text as a vendor would print them."""
    price = F.col("o_totalprice").cast("decimal(18,2)")
    number = _by_priority({
        "5-LOW": F.lit("#N/A"), "4-NOT SPECIFIED": F.lit(" -- "), "2-HIGH": F.lit("pending"),
        "3-MEDIUM": F.concat(F.lit("  "), F.format_number(price, 2), F.lit(" ")),
    }, price.cast("string"))
    day = F.col("o_orderdate").cast("date")
    date = _by_priority({
        "1-URGENT": F.date_format(day, "yyyy-MM-dd"), "2-HIGH": F.date_format(day, "MM/dd/yyyy"),
        "3-MEDIUM": F.date_format(day, "dd/MM/yyyy"), "4-NOT SPECIFIED": F.date_format(day, "dd-MM-yyyy"),
    }, F.date_format(day, "yyyy/M/d"))
    date = F.when(F.col("o_orderstatus") == "P", F.concat(F.lit("on "), date)).otherwise(date)
    label = _by_priority({
        "5-LOW": F.lit("#N/A"), "4-NOT SPECIFIED": F.lit(" -- "), "1-URGENT": F.lit("  "),
        "2-HIGH": F.lit("#N/A Requesting Data..."),
    }, F.concat(F.lit(" "), "o_orderpriority", F.lit("  ")))
    return star.table("orders").select(
        "o_orderkey", number.alias("number_text"), date.alias("date_text"), label.alias("label_text")
    )


def odd_texts(star: Star) -> DataFrame:
    """Per order: a number and a date in the forms that vendors mix in, some of which aren't numbers or dates."""
    key, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    plain = key.cast("string")
    numbers = [F.format_number(key.cast("double"), 2), F.concat(plain, F.lit("f")), F.concat(F.lit("0x"), plain), F.lit("NaN"), F.lit("NULL"),
               F.concat(plain, F.lit("e2")), F.concat(F.lit("-"), plain), F.concat(F.lit("+"), plain, F.lit(".")), F.concat(F.lit("  "), plain, F.lit(" ")),
               F.lit(".5"), F.lit("Infinity"), F.concat(plain, F.lit(" 000"))]
    dates = [F.concat(day.cast("string"), F.lit(" 07:30:00")), F.concat(day.cast("string"), F.lit("T7:30")), F.date_format(day, "M/d/yyyy"),
             F.date_format(day, "dd/MM/yyyy"), F.date_format(day, "d-M-yyyy"), F.date_format(day, "yyyy-13-dd"), F.lit("  "), F.date_format(day, "yyyy")]
    pick = lambda texts: F.element_at(F.array(*texts), (key % len(texts) + 1).cast("int"))
    return star.table("orders").select("o_orderkey", pick(numbers).alias("number_text"), pick(dates).alias("date_text"))


def _cell(row: Column | int, col: Column | int, value: Column) -> list[Column]:
    as_long = lambda x: (F.lit(x) if isinstance(x, int) else x).cast("long")
    return [as_long(row).alias("row_no"), as_long(col).alias("col_no"), value.alias("value")]


def _date_cells(rows: DataFrame, fmt: str) -> DataFrame:
    """First-column cells, one per sheet row. The date is an aggregate, so filters on
    its text stay above the aggregation and are evaluated once per sheet row."""
    dates = rows.groupBy("row").agg(F.max("date").alias("date"))
    return dates.select(*_cell(F.col("row"), 0, F.date_format("date", fmt)))


def _week_row(star: Star, friday: Column) -> Column:
    return F.floor(F.datediff(friday, star.first_friday()) / 7) + FIRST_ROW


def price_cells(star: Star) -> DataFrame:
    """Two columns per company; every second company has its return column first."""
    first_col = F.col("company_id") * 2 + 1
    flipped = F.col("company_id") % 2 == 1
    price_col = F.when(flipped, first_col + 1).otherwise(first_col)
    return_col = F.when(flipped, first_col).otherwise(first_col + 1)
    price_text, return_text = F.lit("Last Price"), F.lit("Day to Day Total Return")
    firms = star.companies().select("company_id", "ticker")
    head = firms.select(F.explode(F.array(
        F.struct(*_cell(3, first_col, F.col("ticker"))),
        F.struct(*_cell(4, price_col, price_text)),
        F.struct(*_cell(4, return_col, return_text)),
    )).alias("c")).select("c.*")
    row = _week_row(star, F.col("price_date"))
    sales = star.weekly_sales()
    value = F.col("value").cast("decimal(18,2)")
    # Which cells are missing depends on the company and the day alone, not on the number of lines.
    place = F.col("company_id") + F.datediff("price_date", F.lit("1970-01-02").cast("date"))
    price = F.when(place % 11 == 0, F.lit("--")).otherwise(F.format_number(value, 2))
    change = F.when(place % 5 == 0, F.lit("#N/A")).otherwise(F.col("quantity").cast("string"))
    body = sales.select(F.explode(F.array(
        F.struct(*_cell(row, price_col, price)), F.struct(*_cell(row, return_col, change)),
    )).alias("c")).select("c.*")
    dates = _date_cells(sales.select(row.alias("row"), F.col("price_date").alias("date")), "MM/dd/yyyy")
    return head.unionByName(body).unionByName(dates)


def statement_cells(star: Star, period_type: str = "ANNUAL", with_dates: bool = True) -> DataFrame:
    """Seven columns per company, one row per period from the first year on."""
    codes = list(schemas.FIELD_CODES)
    width = len(codes)
    first_col = F.col("company_id") * width + 1
    firms = star.companies().select("company_id", "ticker")
    head = firms.select(F.explode(F.array(
        F.struct(*_cell(3, first_col, F.col("ticker"))),
        *[F.struct(*_cell(5, first_col + i, F.lit(code))) for i, code in enumerate(codes)],
    )).alias("c")).select("c.*")
    end = F.col("period_end_date")
    per_year = 1 if period_type == "ANNUAL" else 4
    row = (F.year(end) - star.first_year()) * per_year + (F.quarter(end) - 1 if per_year == 4 else 0) + FIRST_ROW
    rows = star.financials(period_type)
    texts = [
        F.coalesce(F.format_number(F.col(m).cast("decimal(28,4)"), 4), F.lit("N/A")) for m in schemas.FIELD_CODES.values()
    ]
    body = rows.select(F.explode(F.array(*[
        F.struct(*_cell(row, first_col + i, text)) for i, text in enumerate(texts)
    ])).alias("c")).select("c.*")
    cells = head.unionByName(body)
    if with_dates:
        cells = cells.unionByName(_date_cells(rows.select(row.alias("row"), end.alias("date")), "dd/MM/yyyy"))
    return cells


def macro_cells(star: Star) -> DataFrame:
    """One sheet row per indicator and country, newest month first. Counts and values are printed exactly, ratios with
    six digits."""
    codes = F.create_map(*[F.lit(x) for i, pair in enumerate(INDICATORS.items()) for x in (pair[1], i)])
    rows = star.macro()
    number = F.element_at(codes, F.col("indicator_name")).cast("long") + 2
    offset = F.months_between(star.last_month(), "indicator_date").cast("int")
    text = F.when(F.col("indicator_name") == INDICATORS["HOUSST"], F.col("indicator_value").cast("long").cast("string")).when(
        F.col("indicator_name") == INDICATORS["GDPNOM"], F.format_number((F.col("indicator_value") * 1000000).cast("decimal(28,2)"), 2)
    ).otherwise(F.format_number(F.round("indicator_value", 6), 6))
    body = rows.select("country_id", *_cell(number, offset + 2, text))
    labels = rows.select("country_id", "indicator_name", "bloomberg_ticker", number.alias("n")).distinct()
    labels = labels.select("country_id", F.explode(F.array(
        F.struct(*_cell(F.col("n"), 0, F.concat(F.lit(" "), "indicator_name"))),
        F.struct(*_cell(F.col("n"), 1, F.col("bloomberg_ticker"))),
    )).alias("c")).select("country_id", "c.*")
    return body.unionByName(labels)


def rate_cells(star: Star) -> DataFrame:
    """One sheet column per country and rate type; integer sums stand in for the rates."""
    country = star.companies().select(F.col("company_id").alias("l_suppkey"), "country_id")
    weekly = (
        star.table("lineitem")
        .select("l_suppkey", "l_tax", "l_discount", F.trunc(F.col("l_shipdate").cast("date"), "week").alias("monday"))
        .join(country, "l_suppkey")
        .groupBy("country_id", "monday")
        .agg(F.sum(scaled("l_tax")).alias("tax"), F.sum(scaled("l_discount")).alias("disc"))
    )
    row = _week_row(star, F.date_add("monday", 4))
    place = F.array_position(F.array(*[F.lit(c) for c in REGION_COUNTRY]), F.col("country_id"))
    text = lambda c: F.when(F.col(c) == 0, F.lit("N/A")).otherwise(F.col(c).cast("string"))
    body = weekly.select(F.explode(F.array(
        F.struct(*_cell(row, place, text("tax"))), F.struct(*_cell(row, place + 5, text("disc"))),
    )).alias("c")).select("c.*")
    dates = _date_cells(weekly.select(row.alias("row"), F.date_add("monday", 4).alias("date")), "yyyy-MM-dd")
    return body.unionByName(dates)


def snapshot_files(star: Star) -> DataFrame:
    """Rows of yearly membership files, UKX with and SPX without weights, and a repeated export of UKX."""
    members = star.membership().join(star.companies().select("company_id", "ticker", "company_name"), "company_id")
    name = F.concat("index_id", F.lit(" as of "), F.year("as_of_date"), F.lit(".csv"))
    base = members.select(
        name.alias("_file"), "index_id", F.concat(F.lit(" "), "ticker", F.lit(" ")).alias("Ticker"),
        F.concat("company_name", F.lit(" ")).alias("Name"), F.col("weight").cast("double").alias("Weight"),
        F.col("price").cast("double").alias("Price"), F.lit(0).alias("load_order"),
    )
    ukx = base.where(F.col("index_id") == "UKX").drop("index_id")
    spx = base.where(F.col("index_id") == "SPX").drop("index_id", "Weight")
    again = ukx.withColumn("Price", F.col("Price") * 0 - 1).withColumn("load_order", F.lit(1))
    again = again.withColumn("_file", F.regexp_replace("_file", r"\.csv$", "1.csv"))
    return ukx.unionByName(spx, allowMissingColumns=True).unionByName(again)


def _quoted(text: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(text, F.lit('"'), F.lit('""')), F.lit('"'))


def rate_lines(star: Star) -> DataFrame:
    """The rate sheet as text lines ``row_no, value``, numbers with commas and thus in quotes; no row is left out."""
    cells = rate_cells(star)
    number = F.format_number(F.col("value").try_cast("long"), 0)
    text = F.when(F.col("col_no") > 0, F.coalesce(_quoted(number), F.col("value"))).otherwise(F.col("value"))
    rows = cells.groupBy("row_no").agg(F.map_from_entries(F.collect_list(F.struct("col_no", text.alias("text")))).alias("cells"))
    columns = F.sequence(F.lit(0).cast("long"), F.lit(len(schemas.RATE_COLUMNS)).cast("long"))
    line = F.array_join(F.transform(columns, lambda c: F.coalesce(F.col("cells")[c], F.lit(""))), ",")
    all_rows = cells.agg(F.max("row_no").alias("last")).select(F.explode(F.sequence(F.lit(0).cast("long"), F.col("last"))).alias("row_no"))
    return all_rows.join(rows, "row_no", "left").select("row_no", F.coalesce(line, F.lit("")).alias("value"))


#: Files that the company master is exported to.
MASTER_FILES = 8


def master_lines(star: Star) -> DataFrame:
    """Company master sheets as text lines ``file_no, line_no, value``, each with a preamble and a header. Some names
    have a line break, and the first sheet has a line that equals its header."""
    firms = star.companies()
    header = "TICKER,NAME,COUNTRY,CRNCY,GICS_SECTOR_NAME,GICS_INDUSTRY_GROUP_NAME,GICS_INDUSTRY_NAME,GICS_SUB_INDUSTRY_NAME,CUR_MKT_CAP"
    name = F.when(F.col("company_id") % 5 == 0, F.concat("company_name", F.lit('\nformerly "'), "ticker", F.lit('"'))).otherwise(F.col("company_name"))
    cells = ["ticker", _quoted(name), F.concat_ws(" ", "country_id", F.lit("land")), "currency",
             *[F.coalesce(F.col(f"gics_{c}_name"), F.lit("#N/A")) for c in ("sector", "industry_group", "industry", "sub_industry")],
             _quoted(F.format_number("current_market_cap", 2))]
    body = firms.select((F.col("company_id") % MASTER_FILES).alias("file_no"), (F.col("company_id") + 2).alias("line_no"), F.concat_ws(",", *cells).alias("value"))
    heads = star.spark.range(MASTER_FILES).select(F.col("id").alias("file_no"), F.inline(F.array(
        F.struct(F.lit(0).cast("long").alias("line_no"), F.lit('exported, with a "preamble').alias("value")),
        F.struct(F.lit(1).cast("long").alias("line_no"), F.lit(header).alias("value")))))
    repeated = star.spark.range(1).select(F.col("id").alias("file_no"), F.lit(2).cast("long").alias("line_no"), F.lit(header).alias("value"))
    return heads.unionByName(body).unionByName(repeated)


def faulty_cells(cells: DataFrame, date: str = "some day") -> DataFrame:
    """Sheet cells of which some can't be read: a number in 97, and the date of a row in 50."""
    lost = (F.col("row_no") >= 6) & (F.col("col_no") > 0) & ((F.col("row_no") + F.col("col_no")) % 97 == 0)
    undated = (F.col("row_no") >= 6) & (F.col("col_no") == 0) & (F.col("row_no") % 50 == 0)
    return cells.withColumn("value", F.when(lost, F.lit("n.m.")).when(undated, F.lit(date)).otherwise(F.col("value")))


def membership_lines(star: Star) -> DataFrame:
    """Consolidated membership rows as text, some without a date."""
    members = star.membership().join(star.companies().select("company_id", "ticker", "company_name"), "company_id")
    date = F.when(F.col("company_id") % 13 == 0, F.lit("2001-13-45")).otherwise(F.col("as_of_date").cast("string"))
    return members.select("index_id", date.alias("as_of_date"), F.concat(F.lit(" "), "ticker").alias("Ticker"), F.col("company_name").alias("Name"))
