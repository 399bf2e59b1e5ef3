"""Wide vendor sheets as cells: (row_no, col_no, value), zero-based.

A sheet is never turned into a frame with one column per sheet column. Cells are
rows of a long table; the few header rows become a map keyed by column, joined
to the data cells, and measures are put back together by aggregation. The number
of sheet columns therefore only changes the number of rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions import cleaning
from tidepanel.operators.joins import broadcast_bounded
from tidepanel.sources.files import text_cells
from tidepanel.sources.lines import numbered_lines

SHEET_ROWS = 1 << 20  # row limit of a spreadsheet


@dataclass(frozen=True)
class PairLayout:
    """Two columns per entity: tickers on every second column, field texts below."""

    ticker_row: int = 3
    field_row: int = 4
    first_data_row: int = 6
    first_col: int = 1
    width: int = 2


@dataclass(frozen=True)
class FieldLayout:
    """A block of field columns per entity, field codes in their own row."""

    ticker_row: int = 3
    field_row: int = 5
    first_data_row: int = 6
    first_col: int = 1
    width: int = 7


@dataclass(frozen=True)
class MonthLayout:
    """One indicator per row, month columns from the newest backwards."""

    first_data_row: int = 2
    first_month_col: int = 2
    anchor: str | Column = "2024-12-01"


def read_grid(spark: SparkSession, path: str) -> DataFrame:
    """Cells of a CSV export of a sheet (one file). Lines are numbered where they are read and don't move."""
    cells = F.posexplode(text_cells(F.col("value"))).alias("col_no", "value")
    exploded = numbered_lines(spark, path).select(F.col("line_no").alias("row_no"), cells)
    return exploded.select("row_no", F.col("col_no").cast("long").alias("col_no"), "value")


def _row_dates(cells: DataFrame, first_data_row: int) -> DataFrame:
    """Row number -> date of the first column; rows without a date drop out with the join."""
    rows = cells.where((F.col("col_no") == 0) & (F.col("row_no") >= first_data_row))
    dated = rows.select("row_no", cleaning.to_date("value").alias("date")).where(F.col("date").isNotNull())
    return broadcast_bounded(dated, SHEET_ROWS, row_bytes=16)


def tickers(cells: DataFrame, layout: PairLayout | FieldLayout) -> DataFrame:
    """``ticker, block``: every ticker of a sheet and the column where its last block begins."""
    head = cells.where((F.col("row_no") == layout.ticker_row) & (F.col("col_no") >= layout.first_col))
    first = head.where((F.col("col_no") - layout.first_col) % layout.width == 0).select(
        cleaning.null_if_token("value").alias("ticker"), F.col("col_no").alias("block"))
    return first.where(F.col("ticker").isNotNull()).groupBy("ticker").agg(F.max("block").alias("block"))


def _blocks(cells: DataFrame, layout: PairLayout | FieldLayout) -> DataFrame:
    """Column -> (ticker of its block, field text of the column, place in the block).

    Both header rows are grouped by block in one pass; a block has a few columns. Of the
    blocks of one ticker the last one counts, as a whole."""
    head = cells.where(F.col("row_no").isin(layout.ticker_row, layout.field_row) & (F.col("col_no") >= layout.first_col))
    place = (F.col("col_no") - layout.first_col) % layout.width
    head = head.withColumns({"place": place, "value": cleaning.null_if_token("value")})
    is_ticker = (F.col("row_no") == layout.ticker_row) & (F.col("place") == 0)
    column = F.when(F.col("row_no") == layout.field_row, F.struct("col_no", "place", F.col("value").alias("field")))
    blocks = head.groupBy((F.col("col_no") - F.col("place")).alias("block")).agg(
        F.max(F.when(is_ticker, F.col("value"))).alias("ticker"), F.collect_list(column).alias("columns")
    )
    last = blocks.where(F.col("ticker").isNotNull()).groupBy("ticker").agg(F.max_by("columns", "block").alias("columns"))
    return last.select("ticker", "columns", F.inline("columns"))


def _keyed(header: DataFrame, companies: DataFrame) -> DataFrame:
    """Header columns with the company key; columns of unknown tickers drop out.

    The key is looked up once per sheet column and not once per cell."""
    return header.join(companies.select("ticker", "company_id"), "ticker").drop("ticker")


def _data(cells: DataFrame, header: DataFrame, first_data_row: int) -> DataFrame:
    body = cells.where((F.col("row_no") >= first_data_row) & (F.col("col_no") > 0))
    body = body.withColumn("value", cleaning.null_if_token("value")).where(F.col("value").isNotNull())
    return body.join(header, "col_no").join(_row_dates(cells, first_data_row), "row_no")


def price_grid(cells: DataFrame, companies: DataFrame, layout: PairLayout = PairLayout()) -> DataFrame:
    """Weekly prices: the price and return columns of a pair are told apart by their field text,
    for the pair as a whole: if the second says price and the first does not, they are swapped.

    A row needs a price; the first row of a (company, date) wins."""
    blocks = _blocks(cells, layout)
    says = lambda place, word: F.exists(
        "columns", lambda c: (c["place"] == place) & F.coalesce(c["field"].contains(word), F.lit(False)))
    price_place = F.when(~says(0, "Price") & says(1, "Price"), 1).otherwise(0)
    return_place = F.when(~says(1, "Return") & says(0, "Return"), 0).otherwise(1)
    roles = F.array_compact(F.array(
        F.when(F.col("place") == price_place, F.lit("close_price")), F.when(F.col("place") == return_place, F.lit("total_return"))))
    header = blocks.select("col_no", "ticker", F.explode(roles).alias("role"))
    data = _data(cells, _keyed(header, companies), layout.first_data_row).withColumn("number", cleaning.to_number("value"))
    rows = data.groupBy("company_id", "row_no", F.col("date").alias("price_date")).agg(
        F.max(F.when(F.col("role") == "close_price", F.col("number"))).alias("close_price"),
        F.max(F.when(F.col("role") == "total_return", F.col("number"))).alias("total_return"),
    ).where(F.col("close_price").isNotNull())
    return rows.groupBy("company_id", "price_date").agg(
        F.min_by("close_price", "row_no").alias("close_price"), F.min_by("total_return", "row_no").alias("total_return")
    )


def statement_grid(
    cells: DataFrame, companies: DataFrame, period_type: str, layout: FieldLayout = FieldLayout(),
    codes: dict[str, str] = schemas.FIELD_CODES,
) -> DataFrame:
    """Statements: field codes name the measures; rows with no measure at all drop out and
    the last row of a (company, period) replaces earlier ones as a whole."""
    names = F.create_map(*[F.lit(x) for pair in codes.items() for x in pair])
    header = _blocks(cells, layout).withColumn("measure", F.try_element_at(names, F.col("field")))
    header = header.where(F.col("measure").isNotNull()).select("col_no", "ticker", "measure")
    data = _data(cells, _keyed(header, companies), layout.first_data_row).withColumn("number", cleaning.to_number("value"))
    measures = list(codes.values())
    wide = data.groupBy("company_id", "row_no", F.col("date").alias("period_end_date")).agg(
        *[F.max(F.when(F.col("measure") == m, F.col("number"))).alias(m) for m in measures]
    ).na.drop(how="all", subset=measures)
    last = wide.groupBy("company_id", "period_end_date").agg(F.max_by(F.struct(*measures), "row_no").alias("m"))
    return last.select(
        "company_id", "period_end_date", F.lit(period_type).alias("period_type"), "m.*", F.lit(None).cast("string").alias("currency")
    )


def month_grid(cells: DataFrame, country_id: str | Column, layout: MonthLayout = MonthLayout()) -> DataFrame:
    """Macro indicators: column offset -> month, newest first; names classified by keyword.

    The two label columns are picked up by aggregation per row, not by a self-join."""
    country = F.lit(country_id) if isinstance(country_id, str) else country_id
    body = cells.where(F.col("row_no") >= layout.first_data_row)
    by_row = [c for c in ("country_id",) if c in cells.columns]
    labels = body.where(F.col("col_no") < layout.first_month_col).groupBy(*by_row, "row_no").agg(
        F.max(F.when(F.col("col_no") == 0, F.trim("value"))).alias("indicator_name"),
        F.max(F.when(F.col("col_no") == 1, F.nullif(F.trim("value"), F.lit("")))).alias("bloomberg_ticker"),
    ).where(F.col("indicator_name").isNotNull() & (F.col("indicator_name") != ""))
    values = body.where(F.col("col_no") >= layout.first_month_col).withColumn("indicator_value", cleaning.to_number("value"))
    values = values.where(F.col("indicator_value").isNotNull())
    offset = (F.col("col_no") - layout.first_month_col).cast("int")
    anchor = layout.anchor if isinstance(layout.anchor, Column) else F.lit(layout.anchor).cast("date")
    rows = values.join(broadcast_bounded(labels, SHEET_ROWS), [*by_row, "row_no"]).select(
        country.alias("country_id"), F.add_months(anchor, -offset).alias("indicator_date"),
        "indicator_name", "bloomberg_ticker", "indicator_value", cleaning.category("indicator_name").alias("indicator_category"), "row_no",
    )
    first = F.min_by(F.struct("indicator_name", "indicator_value", "indicator_category"), "row_no").alias("f")
    # Rows without a vendor ticker have no key to clash on: all of them stay.
    keyless = F.when(F.col("bloomberg_ticker").isNull(), F.col("row_no")).alias("keyless")
    return rows.groupBy("country_id", "indicator_date", "bloomberg_ticker", keyless).agg(first).select(
        "country_id", "indicator_date", "f.indicator_name", "bloomberg_ticker", "f.indicator_value", "f.indicator_category"
    )


def rate_grid(cells: DataFrame, first_data_row: int = 6) -> DataFrame:
    """Rates: a constant map tells what each column holds; the first row of a key wins."""
    spark = cells.sparkSession
    header = broadcast_bounded(schemas.rate_columns(spark), len(schemas.RATE_COLUMNS))
    data = _data(cells, header, first_data_row).withColumn("rate_value", cleaning.to_number("value"))
    data = data.where(F.col("rate_value").isNotNull())
    return data.groupBy("country_id", F.col("date").alias("rate_date"), "rate_type", "bloomberg_ticker").agg(
        F.min_by("rate_value", "row_no").alias("rate_value")
    )


def fill_calendar(
    cells: DataFrame, period_type: str, first_year: int | Column = 2005, last_year: int | None = 2024, first_data_row: int = 6,
) -> DataFrame:
    """Replace the first column of the n-th data row by the n-th year or quarter end.

    Rows beyond the last year keep their text; without a last year all data rows are dated. A row without a first cell
    gets one."""
    step = 12 if period_type == "ANNUAL" else 3
    start = F.make_date(first_year if isinstance(first_year, Column) else F.lit(first_year), F.lit(step), F.lit(1))
    n = (F.col("row_no") - first_data_row).cast("int")
    end = F.last_day(F.add_months(start, n * step))
    filled = F.col("row_no") >= first_data_row
    if last_year is not None:
        filled = filled & (F.year(end) <= last_year)
    others = cells.where(F.col("col_no") > 0)
    firsts = cells.groupBy("row_no").agg(F.max(F.when(F.col("col_no") == 0, F.col("value"))).alias("old"))
    firsts = firsts.select(
        "row_no", F.lit(0).cast("long").alias("col_no"),
        F.when(filled, F.date_format(end, "yyyy-MM-dd")).otherwise(F.col("old")).alias("value"),
    )
    return others.select("row_no", "col_no", "value").unionByName(firsts)
