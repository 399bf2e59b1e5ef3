"""Helpers shared by the corpus operators: the shared folder, durable cuts and stable partition counts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Only where that setting is absent and the session is local (tests, a single machine) is a folder of this machine
    taken and set; a cluster must name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A folder name below the shared one that nothing else uses."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a frame to the shared folder as Parquet and read it back: lineage ends there, any executor may be lost."""
    spark = df.sparkSession
    path = new_folder(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names for helper columns that clash with no column of the frame, in any letter case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def documents(df: DataFrame, *names: str) -> DataFrame:
    """Only the named columns, taken exactly once each; other columns, whatever their names, are left out."""
    return df.select(*[df[f"`{n}`"] for n in names])


def text_bytes(text: Column) -> Column:
    """Size of a text in UTF-8 bytes; null counts 0."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long")


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
