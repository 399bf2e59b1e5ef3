"""Stored tables as versions: deliveries are merged into new versions, and readers never see a half-written one.

A table is a folder. Its data lie in folders of their own per delivery and partition, which are written once and never
changed; a version is a small file that names the folders of every partition, and is put in its place last. A job that
dies before that leaves the table as it was, one that is repeated finds its delivery's name in the version and
changes nothing, and what a merge doesn't touch isn't read or written again.
"""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepanel.operators.dedup import first_wins

PART = "_part"
#: Partition number of rows without one.
NO_PART = -1


@dataclass(frozen=True)
class Version:
    """One state of a table: the data folders of each partition, and the deliveries that are in it."""

    number: int
    schema: T.StructType
    parts: dict[int, list[str]] = field(default_factory=dict)
    deliveries: dict[str, dict] = field(default_factory=dict)

    def to_json(self) -> str:
        parts = {str(p): folders for p, folders in self.parts.items()}
        return json.dumps({"number": self.number, "schema": json.loads(self.schema.json()), "parts": parts, "deliveries": self.deliveries})

    @staticmethod
    def from_json(text: str) -> Version:
        raw = json.loads(text)
        return Version(raw["number"], T.StructType.fromJson(raw["schema"]), {int(p): f for p, f in raw["parts"].items()}, raw["deliveries"])


class Conflict(RuntimeError):
    """Another writer has put its version in the place of ours; the delivery isn't in the table."""


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share, below the session's ``spark.checkpoint.dir``.

    Only a local session may have none; it gets a folder of this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tables-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, folder: str) -> list[str]:
    files, path = _file_system(spark, folder)
    return sorted(s.getPath().getName() for s in files.listStatus(path)) if files.exists(path) else []


def current(spark: SparkSession, table: str) -> Version | None:
    """The newest version of a table, None if it has none yet."""
    names = [n for n in _children(spark, f"{table}/versions") if n.endswith(".json")]
    if not names:
        return None
    files, path = _file_system(spark, f"{table}/versions/{names[-1]}")
    stream = files.open(path)
    try:
        return Version.from_json(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def _publish(spark: SparkSession, table: str, version: Version) -> Version:
    """Put a version in its place: written beside it first, then renamed, which fails where it is taken."""
    name = f"{table}/versions/{version.number:012d}.json"
    files, beside = _file_system(spark, f"{table}/versions/.{version.number}-{uuid.uuid4().hex}")
    stream = files.create(beside, True)
    try:
        stream.write(bytearray(version.to_json().encode()))
    finally:
        stream.close()
    place = spark._jvm.org.apache.hadoop.fs.Path(name)
    if files.exists(place) or not files.rename(beside, place):
        files.delete(beside, False)
        raise Conflict(f"{name} exists already")
    return version


def _rows(spark: SparkSession, version: Version, parts: Sequence[int] | None = None) -> DataFrame:
    """Rows of a version, of the given partitions only if some are given."""
    chosen = version.parts if parts is None else {p: version.parts[p] for p in parts if p in version.parts}
    folders = [f for p in sorted(chosen) for f in chosen[p]]
    if not folders:
        return spark.createDataFrame([], version.schema)
    return spark.read.schema(version.schema).parquet(*folders)


def read(spark: SparkSession, table: str, parts: Sequence[int] | None = None) -> DataFrame:
    """The table as its newest version has it; a table without a version is an error."""
    version = current(spark, table)
    if version is None:
        raise ValueError(f"no version of {table}")
    return _rows(spark, version, parts)


def create(spark: SparkSession, table: str, schema: T.StructType) -> Version:
    """An empty table; one that exists already stays as it is."""
    return current(spark, table) or _publish(spark, table, Version(0, schema))


def _write(rows: DataFrame, table: str, delivery: str) -> dict[int, str]:
    """Write rows with their partition number into new folders: the folder of each partition.

    The rows of a partition meet in few files; adaptive execution splits a partition that is too large for a task."""
    folder = f"{table}/data/{delivery}-{uuid.uuid4().hex}"
    rows.hint("rebalance", F.col(PART)).write.partitionBy(PART).parquet(folder)
    found = [n for n in _children(rows.sparkSession, folder) if n.startswith(PART + "=")]
    return {int(n.split("=")[1]): f"{folder}/{n}" for n in found}


def _prepared(version: Version, delivery: DataFrame, key: Sequence[str], partition: Column, order: Sequence[Column]) -> DataFrame:
    """The delivery's rows as the table has them, one per key (the first by ``order``; rows with a null in the key all
    stay, as nulls never clash), with their partition number."""
    part = F.coalesce(partition.cast("long"), F.lit(NO_PART)).alias(PART)
    known = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])
    rows = delivery.withColumn(PART, part)
    kept = first_wins(rows.where(known), key, order).unionByName(rows.where(~known))
    return kept.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in version.schema], PART)


def _touched(rows: DataFrame) -> list[int]:
    """Partition numbers of a delivery: as many as the table has partitions, whatever its rows are."""
    return sorted(r[0] for r in rows.select(PART).distinct().collect())


def _merge(spark: SparkSession, table: str, delivery: DataFrame, key: Sequence[str], partition: Column, order: Sequence[Column],
           name: str, replacing: bool) -> Version:
    version = current(spark, table)
    if version is None:
        raise ValueError(f"no version of {table}")
    if name in version.deliveries:
        return version
    rows = _prepared(version, delivery, key, partition, order)
    touched = _touched(rows)
    stored = _rows(spark, version, touched)
    parts = dict(version.parts)
    if replacing:
        # Copy on write: what is stored in the touched partitions and not replaced is written again beside the delivery.
        old = stored.withColumn(PART, F.coalesce(partition.cast("long"), F.lit(NO_PART)))
        kept = old.join(rows.select(*key), list(key), "left_anti").select(*rows.columns)
        written = _write(kept.unionByName(rows), table, name)
        parts.update({p: [folder] for p, folder in written.items()})
    else:
        # Stored rows stay where they are; only new keys are written, and only stored keys are read for that.
        new = rows.join(stored.select(*key), list(key), "left_anti").select(*rows.columns)
        written = _write(new, table, name)
        for p, folder in written.items():
            parts[p] = [*parts.get(p, []), folder]
    done = {**version.deliveries, name: {"partitions": len(written), "version": version.number + 1}}
    return _publish(spark, table, replace(version, number=version.number + 1, parts=parts, deliveries=done))


def merge_first_wins(spark: SparkSession, table: str, delivery: DataFrame, key: Sequence[str], partition: Column,
                     order: Sequence[Column], name: str) -> Version:
    """Insert a delivery's rows whose key isn't stored yet; stored rows stay as they are.

    ``partition`` is a whole number that follows from key columns alone (a year, a bucket), so rows of one key always
    meet in one partition; ``order`` decides between a delivery's own rows of one key. ``name`` tells the delivery: one
    that is in the table already changes nothing.
    """
    return _merge(spark, table, delivery, key, partition, order, name, replacing=False)


def merge_last_wins(spark: SparkSession, table: str, delivery: DataFrame, key: Sequence[str], partition: Column,
                    order: Sequence[Column], name: str) -> Version:
    """Insert a delivery's rows; a stored row of the same key is replaced. Otherwise as ``merge_first_wins``; ``order``
    is given ascending, as plain columns, and the last of a delivery's own rows of one key counts.

    Only partitions that the delivery has rows for are written anew."""
    return _merge(spark, table, delivery, key, partition, [c.desc() for c in order], name, replacing=True)


def refresh(spark: SparkSession, table: str, rows: DataFrame, stale: DataFrame, on: Sequence[str], partition: Column, name: str) -> Version:
    """Replace what is stored for the ``stale`` values of the ``on`` columns by ``rows``; without rows it is gone.

    ``partition`` follows from ``on`` columns alone. Other partitions aren't read or written."""
    version = current(spark, table)
    if version is None:
        raise ValueError(f"no version of {table}")
    if name in version.deliveries:
        return version
    number = F.coalesce(partition.cast("long"), F.lit(NO_PART))
    new = rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in version.schema]).withColumn(PART, number)
    touched = _touched(stale.select(number.alias(PART)).union(new.select(PART)))
    kept = _rows(spark, version, touched).withColumn(PART, number).join(stale.select(*on), list(on), "left_anti").select(*new.columns)
    written = _write(kept.unionByName(new), table, name)
    parts = {p: folders for p, folders in version.parts.items() if p not in touched} | {p: [folder] for p, folder in written.items()}
    done = {**version.deliveries, name: {"partitions": len(written), "version": version.number + 1}}
    return _publish(spark, table, replace(version, number=version.number + 1, parts=parts, deliveries=done))


def compacted(spark: SparkSession, table: str) -> Version:
    """Partitions that grew by several deliveries as one folder each; the rows stay the same."""
    version = current(spark, table)
    many = [p for p, folders in version.parts.items() if len(folders) > 1]
    if not many:
        return version
    rows = reduce(DataFrame.unionByName, [_rows(spark, version, [p]).withColumn(PART, F.lit(p).cast("long")) for p in many])
    written = _write(rows, table, "compacted")
    parts = {**version.parts, **{p: [folder] for p, folder in written.items()}}
    return _publish(spark, table, replace(version, number=version.number + 1, parts=parts))
