"""Constraint checks and coverage profiles. All of them are plain aggregations."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel import schemas
from tidepanel.functions.cleaning import is_reject
from tidepanel.operators.joins import orphans


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row counts."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def null_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: NULLs per column that must not be NULL."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns])


def key_report(df: DataFrame, key: Sequence[str], table: str) -> DataFrame:
    """One row: rows, distinct keys, rows beyond the first per key, and NULLs in the key.

    Rows are counted per key first, so no distinct set is built in one place."""
    missing = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in key])
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"))
    return per_key.agg(
        F.sum("n").alias("rows"), F.count("*").alias("distinct_keys"),
        (F.sum("n") - F.count("*")).alias("repeated_rows"),
        F.coalesce(F.sum(F.when(missing, F.col("n"))), F.lit(0)).alias("null_key_rows"),
    ).select(F.lit(table).alias("table_name"), "*")


def _constraints(df: DataFrame, table: str, key: Sequence[str], required: Sequence[str]) -> DataFrame:
    """Rows, violations of a unique key and NULLs of required columns, from one grouping by the key."""
    others = [c for c in required if c not in key]
    null = lambda c: F.col(c).isNull()
    per_key = df.groupBy(*key).agg(F.count("*").alias("n"), *[F.count_if(null(c)).alias(f"_{c}") for c in others])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    no_null = reduce(lambda a, b: a & b, [~null(c) for c in key])
    rules = [("unique", ", ".join(key), total(F.when(no_null, F.col("n") - 1)))]
    rules += [("not_null", c, total(F.when(null(c), F.col("n"))) if c in key else total(f"_{c}")) for c in required]
    sums = per_key.agg(total("n").alias("rows"), *[v.alias(f"v{i}") for i, (_, _, v) in enumerate(rules)])
    each = F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(c).alias("columns"), F.col(f"v{i}").alias("violations")) for i, (r, c, _) in enumerate(rules)])
    return sums.select(F.lit(table).alias("table_name"), "rows", F.inline(each)).select("table_name", "rule", "columns", "rows", "violations")


def constraint_report(
    tables: dict[str, DataFrame], keys: dict[str, list[str]] = schemas.KEYS,
    not_null: dict[str, list[str]] = schemas.NOT_NULL, unique: dict[str, list[list[str]]] = schemas.UNIQUE,
) -> DataFrame:
    """Every declared key and NOT NULL rule: ``table_name, rule, columns, rows, violations``.

    A violation of a key is a row beyond the first of its key; NULLs never clash. A table's key and NULL rules share
    one grouping, which combines map-side, so a repeated key costs a row per task; a further unique column has its own."""
    parts = []
    for name, df in tables.items():
        parts.append(_constraints(df, name, keys[name], not_null.get(name, [])))
        parts += [_constraints(df, name, columns, []) for columns in unique.get(name, [])]
    return reduce(DataFrame.unionByName, parts)


def reference_report(
    tables: dict[str, DataFrame], references: Sequence[tuple[str, str, str, str]] = schemas.REFERENCES,
) -> DataFrame:
    """Every declared reference: ``reference, orphan_keys, orphan_rows``. A child's keys are counted before they meet
    the parent, so a hot key is one row there; NULL references nothing."""
    parts = []
    for child, column, parent, parent_key in references:
        lost = orphans(tables[child], column, tables[parent], parent_key)
        parts.append(lost.agg(F.count("*").alias("orphan_keys"), F.coalesce(F.sum("rows"), F.lit(0)).alias("orphan_rows")).select(
            F.lit(f"{child}.{column} -> {parent}.{parent_key}").alias("reference"), "*"))
    return reduce(DataFrame.unionByName, parts)


def reject_report(df: DataFrame, parsed: dict[str, Column]) -> DataFrame:
    """Per raw column: values, unusable values (a text that carries a value but did not parse)."""
    aggs = []
    for raw, value in parsed.items():
        aggs += [F.count(value).alias(f"{raw}_parsed"), F.count_if(is_reject(raw, value)).alias(f"{raw}_rejected")]
    return df.agg(*aggs)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [df.agg(F.count("*").alias("records")).select(F.lit(name).alias("table_name"), "records") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def coverage_profile(df: DataFrame, date: str, entity: str, group: Sequence[str] = ()) -> DataFrame:
    """First and last date, distinct entities and rows, per group.

    Reduced to one row per (group, entity) first, so the distinct count is a count."""
    per_entity = df.groupBy(*group, entity).agg(
        F.min(date).alias("lo"), F.max(date).alias("hi"), F.count("*").alias("n")
    )
    return per_entity.groupBy(*group).agg(
        F.min("lo").alias("first_date"), F.max("hi").alias("last_date"),
        F.count(entity).alias("entities"), F.sum("n").alias("records"),
    )


def members_per_snapshot(membership: DataFrame) -> DataFrame:
    return membership.groupBy("index_id", "as_of_date").agg(F.count("*").alias("member_count")).orderBy("index_id", "as_of_date")


def entities_by_year(df: DataFrame, date: str, entity: str) -> DataFrame:
    return df.groupBy(F.year(date).alias("year")).agg(F.countDistinct(entity).alias("companies")).orderBy("year")


def continuity(
    df: DataFrame, companies: DataFrame, names: Sequence[str], by: str = "ticker", date: str = "period_end_date",
) -> DataFrame:
    """Distinct years of data for named companies.

    The list of names is the bounded side: it reduces the companies first."""
    named = companies.where(F.col(by).isin(list(names))).select("company_id", "ticker", "company_name")
    return (
        df.join(named, "company_id")
        .groupBy("ticker", "company_name")
        .agg(F.countDistinct(F.year(date)).alias("years_of_data"))
        .orderBy("ticker")
    )


def data_points_by_year(df: DataFrame, date: str, entity: str, measures: Sequence[str]) -> DataFrame:
    """Non-NULL measure values per year, entities, and percent of the peak year."""
    points = reduce(lambda a, b: a + b, [F.col(m).isNotNull().cast("int") for m in measures])
    yearly = df.groupBy(F.year(date).alias("year"), entity).agg(F.sum(points).alias("p")).groupBy("year").agg(
        F.sum("p").alias("data_points"), F.count_if(F.col("p") > 0).alias("companies")
    )
    # One row per year reaches this window.
    peak = F.max("data_points").over(Window.partitionBy(F.lit(1)))
    return yearly.withColumn("pct_of_peak", F.round(F.try_divide(F.col("data_points") * 100.0, peak), 1)).orderBy("year")
