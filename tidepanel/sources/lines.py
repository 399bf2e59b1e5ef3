"""Lines and records of text files by their place, without gathering a file's lines anywhere.

Splits of a file are counted, a prefix sum over the few splits tells where each one begins, and the lines get their
numbers where they are read. Both readings belong to one query; a session whose number of cores may change while it
runs should set ``spark.sql.files.minPartitionNum``, so that files are split alike whenever they are read. A split
that finds no count stops the query.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidepanel.operators.joins import broadcast_bounded

#: Bytes of a split's row in the table of prefix sums, at most: a file name and three numbers.
SPLIT_ROW_BYTES = 512


def most_splits(spark: SparkSession, path: str) -> int:
    """An upper bound on the splits of all files of a path, from their sizes."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = target.getFileSystem(spark._jsc.hadoopConfiguration())
    size = count = 0
    for status in files.globStatus(target) or []:
        summary = files.getContentSummary(status.getPath())
        size, count = size + summary.getLength(), count + summary.getFileCount()
    # A split is not smaller than the cost of opening a file, unless the largest allowed split is.
    setting = lambda name: spark._jsparkSession.sessionState().conf().getConfString(name)
    as_bytes = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes
    smallest = min(as_bytes(setting("spark.sql.files.openCostInBytes")), as_bytes(setting("spark.sql.files.maxPartitionBytes")))
    return size // max(smallest, 1) + count + 1


def numbered_lines(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """``file, block, line_no, value``: every line of every file with its number from 0 within the file."""
    reader = spark.read.option("pathGlobFilter", glob) if glob else spark.read
    scan = reader.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("id"),
    )
    splits = scan.groupBy("file", "block").agg(F.min("id").alias("first"), F.count("*").alias("lines"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("file", "block", "first", F.coalesce(F.sum("lines").over(earlier), F.lit(0)).alias("before"))
    starts = broadcast_bounded(starts, most_splits(spark, path), SPLIT_ROW_BYTES)
    number = F.coalesce(F.col("before") + F.col("id") - F.col("first"), F.raise_error(F.lit("files were split in two ways")).cast("long"))
    return scan.join(starts, ["file", "block"], "left").select("file", "block", number.alias("line_no"), "value")


def _odd_quotes(value: Column) -> Column:
    return (F.length(value) - F.length(F.replace(value, F.lit('"')))) % 2 == 1


def records(lines: DataFrame) -> DataFrame:
    """``file, line_no, value``: CSV records of ``numbered_lines``, those with line breaks in quotes put together.

    Whether a line begins within quotes depends on all quotes before it. Only lines with an odd number of quotes
    change that, so only their places are ranked, split by split with a prefix over the splits; each two of them
    enclose a record. Other lines are records as they are and don't move unless there are many broken records. A
    quote that is never closed is an error. ``line_no`` is that of a record's first line.
    """
    odd = lines.where(_odd_quotes(F.col("value"))).select("file", "block", "line_no")
    counts = odd.groupBy("file", "block").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("file", "block", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("file", "block").orderBy("line_no")
    ranked = odd.withColumn("rank", F.row_number().over(within) - 1).join(before, ["file", "block"])
    spans = ranked.groupBy("file", F.floor((F.col("before") + F.col("rank")) / 2).alias("pair")).agg(
        F.min("line_no").alias("first"), F.max("line_no").alias("last"))
    last = F.when(F.col("last") > F.col("first"), F.col("last")).otherwise(
        F.raise_error(F.concat(F.lit("a quote is never closed in "), "file")).cast("long"))
    broken = spans.select("file", "first", F.explode(F.sequence("first", last)).alias("line_no"))
    placed = lines.join(broken, ["file", "line_no"], "left")
    whole = placed.where(F.col("first").isNull()).select("file", "line_no", "value")
    joined = placed.where(F.col("first").isNotNull()).groupBy("file", "first").agg(
        F.array_sort(F.collect_list(F.struct("line_no", "value"))).alias("parts"))
    return whole.unionByName(joined.select(
        "file", F.col("first").alias("line_no"), F.array_join(F.transform("parts", lambda p: p["value"]), "\n").alias("value")))
