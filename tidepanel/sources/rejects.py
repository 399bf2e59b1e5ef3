"""Quarantine: what each loader leaves out, row by row, with the reason.

Frames have ``loader, reason, row_no, col_no, value``; places are null where a source has none. Reasons: ``no_key`` (a row
without its natural key), ``unknown_ticker`` (no such company; once per row of a list, once per block of a sheet),
``bad_date`` and ``bad_number`` (a text that carries a value but can't be read). Missing values aren't errors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.functions import cleaning
from tidepanel.sources import grids
from tidepanel.sources.files import PLACE

COLUMNS = ["loader", "reason", "row_no", "col_no", "value"]


def _rows(df: DataFrame, loader: str, reasons: Column, value: Column, row: Column | None = None, col: Column | None = None) -> DataFrame:
    none = F.lit(None).cast("long")
    return df.select(
        F.lit(loader).alias("loader"), F.explode(F.array_compact(reasons)).alias("reason"),
        (none if row is None else row).alias("row_no"), (none if col is None else col).alias("col_no"), value.alias("value"))


def company_rejects(raw: DataFrame) -> DataFrame:
    """Rows of a company master sheet without a ticker."""
    ticker = F.trim(F.col(f"`{raw.columns[0]}`"))
    lost = ticker.isNull() | ticker.isin("", "#N/A")
    return _rows(raw, "companies", F.array(F.when(lost, F.lit("no_key"))), F.concat_ws(",", *[F.col(f"`{c}`") for c in raw.columns if c != PLACE]),
                 F.col(f"{PLACE}.line_no") if PLACE in raw.columns else None)


def membership_rejects(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Membership rows of unknown companies or without a date; a row can have both faults."""
    known = companies.select(F.col("ticker").alias("_known")).distinct()
    ticker = F.trim("Ticker")
    rows = raw.join(known, ticker == F.col("_known"), "left")
    lost = F.when(ticker.isNull(), F.lit("no_key")).when(F.col("_known").isNull(), F.lit("unknown_ticker"))
    undated = F.when(cleaning.to_date("as_of_date").isNull(), F.lit("bad_date"))
    return _rows(rows, "index_membership", F.array(lost, undated), F.concat_ws(",", "index_id", "as_of_date", "Ticker"),
                 F.col(f"{PLACE}.line_no") if PLACE in raw.columns else None)


def _cells(cells: DataFrame, loader: str, first_row: int, first_col: int, dated: bool) -> DataFrame:
    """Cells of dates and numbers that can't be read: one pass over the cells."""
    value = F.col("value")
    number = (F.col("col_no") >= first_col) & cleaning.is_reject(value, cleaning.to_number(value))
    reason = F.when(number, F.lit("bad_number"))
    if dated:
        reason = reason.when((F.col("col_no") == 0) & cleaning.is_reject(value, cleaning.to_date(value)), F.lit("bad_date"))
    return _rows(cells.where(F.col("row_no") >= first_row), loader, F.array(reason), value, F.col("row_no"), F.col("col_no"))


def _unknown(cells: DataFrame, companies: DataFrame, loader: str, layout: grids.PairLayout | grids.FieldLayout) -> DataFrame:
    heads = grids.tickers(cells, layout)
    lost = heads.join(companies.select("ticker"), "ticker", "left_anti")
    return _rows(lost, loader, F.array(F.lit("unknown_ticker")), F.col("ticker"), F.lit(layout.ticker_row).cast("long"), F.col("block"))


def price_rejects(cells: DataFrame, companies: DataFrame, layout: grids.PairLayout = grids.PairLayout()) -> DataFrame:
    found = _cells(cells, "prices_weekly", layout.first_data_row, layout.first_col, dated=True)
    return found.unionByName(_unknown(cells, companies, "prices_weekly", layout))


def statement_rejects(cells: DataFrame, companies: DataFrame, layout: grids.FieldLayout = grids.FieldLayout()) -> DataFrame:
    found = _cells(cells, "financials", layout.first_data_row, layout.first_col, dated=True)
    return found.unionByName(_unknown(cells, companies, "financials", layout))


def month_rejects(cells: DataFrame, layout: grids.MonthLayout = grids.MonthLayout()) -> DataFrame:
    return _cells(cells, "macro_indicators", layout.first_data_row, layout.first_month_col, dated=False)


def rate_rejects(cells: DataFrame, first_data_row: int = 6) -> DataFrame:
    return _cells(cells, "interest_rates", first_data_row, 1, dated=True)


def counts(*rejects: DataFrame) -> DataFrame:
    """``loader, reason, rejected``; map-side counts, whatever the number of rejects."""
    return reduce(DataFrame.unionByName, rejects).groupBy("loader", "reason").agg(F.count("*").alias("rejected"))
