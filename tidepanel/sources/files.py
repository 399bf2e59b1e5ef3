"""File sources and sinks: CSV layouts, snapshot folders, optional paths, Parquet tables."""

from __future__ import annotations

import csv
import io
import logging
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel import schemas
from tidepanel.functions import cleaning
from tidepanel.operators.dedup import distinct_sorted, first_wins
from tidepanel.sources.lines import numbered_lines, records

log = logging.getLogger(__name__)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence test on whatever file system the path names (globs allowed)."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    found = target.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(target)
    return found is not None and len(found) > 0


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", **options) -> DataFrame:
    """The source, or an empty frame of the same schema where the path is absent."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.format(fmt).schema(schema).options(**options).load(path)


#: Name of the column that tells a record's place, if asked for: its file and the number of its first line.
PLACE = "_place"


def _csv_records(spark: SparkSession, path: str, skip: int) -> DataFrame:
    """Records of CSV files as text columns named by the header, which is the first record after ``skip`` lines of
    each file. Lines count by their place: a later one that equals the header is data. Blank ones are left out."""
    lines = numbered_lines(spark, path).where(F.col("line_no") >= skip)
    found = records(lines).where(F.trim("value") != "")
    heads = found.groupBy("file").agg(F.min_by("value", "line_no").alias("header"), F.min("line_no").alias("head_no"))
    headers = heads.select("header").distinct().limit(2).collect()
    if len(headers) != 1:
        raise ValueError(f"{path}: expected {'a preamble and ' if skip else ''}one header line, the same in all files")
    names = [name.strip() or f"column_{i}" for i, name in enumerate(next(csv.reader(io.StringIO(headers[0][0]))))]
    schema = ", ".join(f"`{name}` string" for name in names)
    body = found.join(heads.select("file", "head_no"), "file").where(F.col("line_no") > F.col("head_no"))
    parsed = F.from_csv("value", F.lit(schema), {"escape": '"', "multiLine": "true"})
    return body.select(parsed.alias("r"), F.struct("file", "line_no").alias(PLACE)).select("r.*", PLACE)


def read_csv(spark: SparkSession, path: str, columns: Sequence[str], place: bool = False) -> DataFrame:
    """CSV with a header line; every column as text. Quoted values may hold line breaks."""
    wanted = [*columns, PLACE] if place else list(columns)
    return cleaning.keep_known(_csv_records(spark, path, 0), wanted, wanted)


def read_csv_with_preamble(spark: SparkSession, path: str, place: bool = False) -> DataFrame:
    """CSV whose first line is a preamble and second the header; every column as text.

    Quoted values may hold line breaks; only the first header is seen by the driver."""
    rows = _csv_records(spark, path, 1)
    return rows if place else rows.drop(PLACE)


def _in_place(df: DataFrame) -> Column:
    """Order of records: by their place where it is known, else as the rows come."""
    return F.col(PLACE) if PLACE in df.columns else F.monotonically_increasing_id()


COMPANY_COLUMNS = ["NAME", "COUNTRY", "CRNCY", "GICS_SECTOR_NAME", "GICS_INDUSTRY_GROUP_NAME",
                   "GICS_INDUSTRY_NAME", "GICS_SUB_INDUSTRY_NAME", "CUR_MKT_CAP"]


def company_master(raw: DataFrame) -> DataFrame:
    """Company rows of a master sheet: first column is the ticker, first row per ticker wins."""
    ticker = F.trim(F.col(f"`{raw.columns[0]}`"))
    rows = raw.withColumn("_ord", _in_place(raw)).select(
        "_ord", ticker.alias("ticker"), F.col("NAME").alias("company_name"),
        cleaning.country_code("COUNTRY").alias("country_id"), F.col("CRNCY").alias("currency"),
        cleaning.null_if_token("GICS_SECTOR_NAME").alias("gics_sector_name"),
        cleaning.null_if_token("GICS_INDUSTRY_GROUP_NAME").alias("gics_industry_group_name"),
        cleaning.null_if_token("GICS_INDUSTRY_NAME").alias("gics_industry_name"),
        cleaning.null_if_token("GICS_SUB_INDUSTRY_NAME").alias("gics_sub_industry_name"),
        cleaning.to_number("CUR_MKT_CAP").cast("decimal(20,2)").alias("current_market_cap"),
        F.lit(True).alias("is_active"),
    ).where(F.col("ticker").isNotNull() & ~F.col("ticker").isin("", "#N/A"))
    return first_wins(rows, ["ticker"], [F.col("_ord")]).drop("_ord")


SNAPSHOT_COLUMNS = ["Ticker", "Name", "Weight", "Shares", "Price"]


# One cell behind its comma; a quoted cell may hold commas and doubled quotes. Every repetition is possessive, so
# a line is read once from left to right, however many cells it has.
CELL = r',\s*+("[^"]*+(?:""[^"]*+)*+"[^,]*+|[^,]*+)'


def text_cells(line: Column) -> Column:
    """Cells of one CSV line, trimmed and without their quotes. A cell cannot hold a line break."""

    def bare(cell: Column) -> Column:
        inner = F.regexp_replace(cell, '^"|"$', "")
        return F.trim(F.when(cell.startswith('"'), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(inner))

    cells = F.regexp_extract_all(F.concat(F.lit(","), line), F.lit(CELL), F.lit(1))
    return F.transform(cells, lambda c: bare(F.trim(c)))


def read_snapshots(spark: SparkSession, folder: str, pattern: str = "*.csv") -> DataFrame:
    """Yearly membership files of a folder; index and year come from the file name.

    Every file has its own header line, so files may carry different columns; a
    column a file lacks is NULL, and a file without a ticker column is an error. Cells
    beyond the header and cells without a name are left out; of a repeated row the one
    in the file first by name stays.
    Files whose name starts with ``~$`` (editor locks) are left out.
    """
    name = F.element_at(F.split("file", "/"), -1)
    lines = numbered_lines(spark, folder, pattern).select(
        "value", F.url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))).alias("_file"), F.col("line_no").alias("_at"),
    ).where(~F.col("_file").startswith("~$") & (F.trim("value") != ""))
    headers = lines.groupBy("_file").agg(F.min_by("value", "_at").alias("_header"), F.min("_at").alias("_first"))
    names = text_cells(F.col("_header"))
    known = F.when(F.array_contains(names, "Ticker"), names).otherwise(
        F.raise_error(F.concat(F.lit("missing Ticker column in "), "_file"))
    )
    headers = headers.select("_file", F.col("_first"), known.alias("_names"))
    cells = lines.join(headers, "_file").where(F.col("_at") > F.col("_first")).withColumn(
        "_cells", text_cells(F.col("value"))
    )
    place = lambda name: (F.array_position("_names", name) - 1).cast("int")
    values = [F.nullif(F.get("_cells", place(c)), F.lit("")).alias(c) for c in SNAPSHOT_COLUMNS]
    return snapshot_rows(cells.select("_file", "_at", *values), F.struct("_file", "_at"))


def snapshot_rows(df: DataFrame, order: Column | None = None) -> DataFrame:
    """Snapshot rows with index id and year-end date from ``_file``, one row per index, date and
    ticker: the first by ``order``, or in file order."""
    year = F.regexp_extract("_file", r"(20\d{2}|19\d{2})", 1)
    rows = df.withColumn("_ord", F.monotonically_increasing_id() if order is None else order).withColumn("Ticker", F.trim("Ticker"))
    if "Name" in df.columns:
        rows = rows.withColumn("Name", F.trim("Name"))
    rows = rows.where(F.col("Ticker").isNotNull()).select(
        F.substring("_file", 1, 3).alias("index_id"), F.concat(year, F.lit("-12-31")).cast("date").alias("as_of_date"),
        *[c for c in df.columns if c != "_file"], "_ord",
    )
    return first_wins(rows, ["index_id", "as_of_date", "Ticker"], [F.col("_ord")]).drop("_ord")


def membership_rows(raw: DataFrame, companies: DataFrame) -> DataFrame:
    """Consolidated membership text rows -> keyed membership; unknown tickers and bad dates drop out."""
    rows = raw.select(
        "index_id", F.trim("Ticker").alias("ticker"), cleaning.to_date("as_of_date").alias("as_of_date"),
        cleaning.to_number("Weight").cast("decimal(10,6)").alias("weight"),
        cleaning.to_number("Shares").cast("decimal(20,6)").alias("shares_outstanding"),
        cleaning.to_number("Price").cast("decimal(15,4)").alias("price"),
        _in_place(raw).alias("_ord"),
    ).where(F.col("as_of_date").isNotNull())
    keyed = rows.join(companies.select("ticker", "company_id"), "ticker")
    first = first_wins(keyed, schemas.KEYS["index_membership"], [F.col("_ord")])
    return first.select(*schemas.MEMBERSHIP.fieldNames())


def ticker_list(membership: DataFrame) -> DataFrame:
    """Distinct sorted tickers; the column may be called ``Ticker`` or ``ticker``."""
    name = cleaning.resolve_column(membership, "Ticker", "ticker")
    return distinct_sorted(membership.select(F.col(name).alias("ticker")), "ticker")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """(Re)create a table folder."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def recreate_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame]) -> None:
    """Write every domain table; those not given become empty ones of the declared schema."""
    for name, schema in schemas.TABLES.items():
        write_table(tables.get(name, spark.createDataFrame([], schema)), f"{root}/{name}")


def export_catalogue(queries: dict[str, Callable[[], DataFrame]], folder: str) -> tuple[int, dict[str, str]]:
    """Run every named query and write it as CSV; a failing one does not stop the rest.

    Returns the number of successes and the errors by name.
    """
    done, errors = 0, {}
    for name, build in queries.items():
        try:
            write_csv(build(), f"{folder}/{name}")
            done += 1
        except Exception as exc:  # noqa: BLE001 - the point is to go on
            errors[name] = str(exc)
            log.warning("query %s failed: %s", name, exc)
    return done, errors
