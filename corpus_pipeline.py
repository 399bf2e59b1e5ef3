"""Corpus pipeline: language, near duplicates, repeated passages, benchmark leaks, packing.

Each stage takes ``(spark, docs, sf_dir)``, works on all that its predecessor kept and, but for the last, returns the
columns of its input. Extra columns pass through whatever their names; ids may be null or repeated; empty tables stay
empty. Stages write intermediate tables only to the folder that the session names in ``spark.checkpoint.dir``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepanel.llm import language, leaks, neardup, packing, suffixes
from tidepanel.llm.common import load, written

#: A document stays if the network gives its language at least this mean probability.
LEAST_SCORE = 0.5


def plain(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """The same rows with columns named c0, c1, ...: no helper column can clash with one."""
    return docs.toDF(*[f"c{i}" for i in range(len(docs.columns))]), docs.columns


def keyed(docs: DataFrame) -> tuple[DataFrame, list[str], str, str]:
    """``plain`` and the names that id and text have there."""
    rows, names = plain(docs)
    return rows, names, f"c{names.index('doc_id')}", f"c{names.index('text')}"


def by_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a recognised language; those without a letter or that fit no language go.

    The network learns from the labelled documents of the input. If none is labelled, nothing can be judged and
    documents with a letter stay.
    """
    rows, names, key, text = keyed(docs)
    network = language.fit(rows, key, text, f"c{names.index('lang')}")
    if network is None:
        return rows.where(language.has_letter(F.col(text))).toDF(*names)
    judged = language.identify(rows, text, network)
    return judged.where((F.col("lang_pred") != "und") & (F.col("score") >= LEAST_SCORE)).drop("lang_pred", "score").toDF(*names)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8): the least id, without ids the first in the scan."""
    rows, names, key, text = keyed(docs)
    # Written once: several jobs read the numbers, and a scan that is split in another way would give others.
    rows = written(rows.withColumn("_uid", F.monotonically_increasing_id()), "numbered")
    groups = neardup.near_duplicates(rows, "_uid", text, words=5, percent=80).select(F.col("id").alias("_uid"), "component_id")
    first = rows.select("_uid", key).join(groups, "_uid").groupBy("component_id").agg(
        F.min(F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), "_uid")).alias("first"))
    kept = written(first.select(F.col("first._uid").alias("_uid")), "kept")
    return neardup.only(rows, kept, "_uid").drop("_uid").toDF(*names)


def without_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without bytes under strings of 100 bytes that start earlier; ``n_chars`` follows the text."""
    rows, names, key, text = keyed(docs)
    out = suffixes.without_repeats(rows, key, text)
    if "n_chars" in names:
        size = f"c{names.index('n_chars')}"
        kind = rows.schema[size].dataType
        out = out.withColumn(size, F.when(F.col(size).isNotNull(), F.char_length(text)).cast(kind))
    return out.toDF(*names)


def without_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, also not with other numbers, names or units."""
    rows, names, key, text = keyed(docs)
    found = written(leaks.leaks(rows, load(spark, sf_dir, "benchmark"), key, text, "item_id", "text").select(
        F.col("id").alias("_id"), F.col("text_key").alias("_key")).distinct(), "leaks")
    few = found.count() <= neardup.BROADCAST_KEYS
    same = F.col(key).eqNullSafe(F.col("_id")) & (F.xxhash64(text) == F.col("_key"))
    return rows.join(F.broadcast(found) if few else found, same, "left_anti").toDF(*names)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents and the sequences that they are packed into."""
    rows, _, key, text = keyed(docs)
    return packing.pack_documents(rows, key, text).withColumnRenamed("key", "doc_id")


STAGES = [
    ("language", by_language),
    ("near_duplicates", one_of_each_group),
    ("repeated_passages", without_passages),
    ("decontamination", without_leaks),
    ("packing", packed),
]

#: No stage but the fourth can be told in SQL: models, hashes and packings aren't queries. Tests hold each against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage after the other, each written as Parquet and read again."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
