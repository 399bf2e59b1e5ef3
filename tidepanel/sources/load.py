"""The load job: sources in the order in which they depend on each other, into stored tables that remember them.

A source that is absent is skipped. Each source becomes one delivery, named after its file, size and time, and is
published on its own; a job that failed is simply run again and goes on with the first source that isn't in its table.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.operators import registry
from tidepanel.sources import files, grids, rejects, store

MEMBERSHIP_COLUMNS = ["index_id", "as_of_date", "Ticker", "Name", "Weight", "Shares", "Price"]
#: Folders of the company table; a ticker's bucket follows from its hash.
TICKER_BUCKETS = 64


@dataclass(frozen=True)
class Source:
    """One file of a table. ``option`` tells what the file itself doesn't: a period type or a country."""

    table: str
    file: str
    option: str = ""


# File names and their countries, in the order of their dependencies. Sheets are read as CSV exports.
SOURCES = [
    Source("companies", "company_master.csv"),
    Source("index_membership", "index_membership_snapshot.csv"),
    Source("prices_weekly", "price_weekly.csv"),
    Source("financials", "financials_annual.csv", "ANNUAL"),
    Source("financials", "financials_quarterly.csv", "QUARTERLY"),
    Source("macro_indicators", "usa_macros_2024~2005.csv", "US"),
    Source("macro_indicators", "uk_macros_2024~2005.csv", "GB"),
    Source("macro_indicators", "de_macros_2024~2005.csv", "DE"),
    Source("macro_indicators", "jp_macros_2024~2005.csv", "JP"),
    Source("macro_indicators", "cn_macros_2024~2005.csv", "CN"),
    Source("interest_rates", "interest_rates.csv"),
]


@dataclass(frozen=True)
class Outcome:
    """What became of a source: ``loaded``, ``absent`` or ``known`` (in the table already), accepted and rejected rows."""

    source: Source
    status: str
    accepted: int = 0
    rejected: dict[str, int] | None = None


def delivery_name(spark: SparkSession, path: str) -> str | None:
    """Name, size and time of a file, None if it is absent: a changed file is a new delivery."""
    files_, target = store._file_system(spark, path)
    if not files_.exists(target):
        return None
    status = files_.getFileStatus(target)
    return f"{target.getName()}-{status.getLen()}-{status.getModificationTime()}"


def _year(date: str) -> Column:
    return F.year(date)


#: Table -> (partition number, whether a later delivery's row replaces a stored one). Statements replace, others don't.
PARTITIONS: dict[str, tuple[Column | Callable[[], Column], bool]] = {
    "companies": (lambda: F.pmod(F.xxhash64("ticker"), F.lit(TICKER_BUCKETS)), False),
    "index_membership": (lambda: _year("as_of_date"), False),
    "prices_weekly": (lambda: _year("price_date"), False),
    "financials": (lambda: _year("period_end_date"), True),
    "macro_indicators": (lambda: _year("indicator_date"), False),
    "interest_rates": (lambda: _year("rate_date"), False),
}


def read_source(spark: SparkSession, source: Source, path: str, companies: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The rows of a source for its table, and its quarantine."""
    if source.table == "companies":
        raw = files.read_csv_with_preamble(spark, path, place=True)
        return files.company_master(raw), rejects.company_rejects(raw)
    if source.table == "index_membership":
        raw = files.read_csv(spark, path, MEMBERSHIP_COLUMNS, place=True)
        return files.membership_rows(raw, companies), rejects.membership_rejects(raw, companies)
    cells = grids.read_grid(spark, path)
    if source.table == "prices_weekly":
        return grids.price_grid(cells, companies), rejects.price_rejects(cells, companies)
    if source.table == "financials":
        return grids.statement_grid(cells, companies, source.option), rejects.statement_rejects(cells, companies)
    if source.table == "macro_indicators":
        return grids.month_grid(cells, source.option), rejects.month_rejects(cells)
    return grids.rate_grid(cells), rejects.rate_rejects(cells)


def load_source(spark: SparkSession, source: Source, folder: str, root: str) -> Outcome:
    """Merge one source into its table. Rows and quarantine are written and counted in one pass each; the merge reads
    what was written, so a sheet isn't taken apart twice."""
    name = delivery_name(spark, f"{folder}/{source.file}")
    if name is None:
        return Outcome(source, "absent")
    table, schema = f"{root}/{source.table}", schemas.TABLES[source.table]
    version = store.create(spark, table, schema)
    if name in version.deliveries:
        return Outcome(source, "known")
    companies = store.read(spark, f"{root}/companies") if source.table != "companies" else None
    rows, lost = read_source(spark, source, f"{folder}/{source.file}", companies)
    if source.table == "companies":
        ids = registry.assign_keys(spark, f"{root}/company_keys", rows.select("ticker"), "ticker", "company_id", name)
        rows = rows.join(ids, "ticker")
    count, faults = Observation(), Observation()
    staged = f"{root}/staged/{source.table}/{name}"
    rows.select(*schema.fieldNames()).observe(count, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(staged)
    kinds = ["no_key", "unknown_ticker", "bad_date", "bad_number"]
    lost.observe(faults, *[F.count_if(F.col("reason") == k).alias(k) for k in kinds]).write.mode("overwrite").parquet(f"{root}/quarantine/{source.table}/{name}")
    partition, replacing = PARTITIONS[source.table]
    key = schemas.UNIQUE[source.table][0] if source.table in schemas.UNIQUE else schemas.KEYS[source.table]
    merge = store.merge_last_wins if replacing else store.merge_first_wins
    accepted = spark.read.schema(rows.select(*schema.fieldNames()).schema).parquet(staged)
    merge(spark, table, accepted, key, partition(), [F.col(c) for c in key], name)
    return Outcome(source, "loaded", count.get["rows"], {k: n for k, n in faults.get.items() if n})


def load_all(spark: SparkSession, folder: str, root: str, sources: Sequence[Source] = SOURCES) -> list[Outcome]:
    """Load every source of a folder that is there and not in its table yet; afterwards all declared tables exist."""
    outcomes = [load_source(spark, source, folder, root) for source in sources]
    for name, rows in (("countries", schemas.countries(spark)), ("indices", schemas.indices(spark))):
        store.create(spark, f"{root}/{name}", schemas.TABLES[name])
        store.merge_first_wins(spark, f"{root}/{name}", rows, schemas.KEYS[name], F.lit(0), [F.col(schemas.KEYS[name][0])], "constants")
    for name, schema in schemas.TABLES.items():
        store.create(spark, f"{root}/{name}", schema)
    return outcomes


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All stored tables of a load, as the studies and the declared-rule reports take them."""
    return {name: store.read(spark, f"{root}/{name}") for name in schemas.TABLES}
