"""Stored tables: merges against plain dictionaries, repeated and broken deliveries, keys that stay."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from tidepanel.operators import registry
from tidepanel.sources import store

SCHEMA = "k long, day date, v long"
KEY = ["k", "day"]


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture
def table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    store.create(spark, path, spark.createDataFrame([], SCHEMA).schema)
    return path


def delivery(spark, rows):
    return spark.createDataFrame([(k, d, v) for k, d, v in rows], "k long, day string, v long").withColumn("day", F.col("day").cast("date"))


def merge(spark, how, path, rows, name):
    return how(spark, path, delivery(spark, rows), KEY, F.year("day"), [F.col("v")], name)


@pytest.mark.parametrize("how", [store.merge_first_wins, store.merge_last_wins])
def test_merges_like_a_dictionary(spark, table, how):
    rng, held, keyless = random.Random(3), {}, 0
    for n in range(4):
        rows = [(rng.choice([1, 2, 3, None]), f"{rng.choice([1999, 2000, 2001])}-0{rng.randint(1, 3)}-01", rng.randint(0, 99)) for _ in range(25)]
        merge(spark, how, table, rows, f"d{n}")
        first = how is store.merge_first_wins
        for k, d, v in sorted(rows, key=lambda r: r[2], reverse=first):
            if k is None:
                keyless += 1
        own = {}
        for k, d, v in rows:
            if k is not None:
                own[k, d] = min(v, own.get((k, d), v)) if first else max(v, own.get((k, d), v))
        held = {**own, **held} if first else {**held, **own}
        got = store.read(spark, table)
        assert sorted((r["k"], str(r["day"]), r["v"]) for r in got.where("k IS NOT NULL").collect()) == sorted((k, d, v) for (k, d), v in held.items())
        assert got.where("k IS NULL").count() == keyless


def test_repeated_delivery_changes_nothing(spark, table):
    one = merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 5)], "d0")
    again = merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 9)], "d0")
    assert one == again and rows_of(store.read(spark, table).select("k", "v")) == [(1, 5)]
    same = merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 5)], "d1")
    assert rows_of(store.read(spark, table).select("k", "v")) == [(1, 5)] and same.number == 2


def test_untouched_partitions_keep_their_folders(spark, table):
    before = merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 5), (1, "2001-01-01", 6), (None, None, 0)], "d0")
    after = merge(spark, store.merge_last_wins, table, [(1, "2001-01-01", 7)], "d1")
    assert after.parts[2000] == before.parts[2000] and after.parts[2001] != before.parts[2001] and store.NO_PART in after.parts
    more = merge(spark, store.merge_first_wins, table, [(2, "2001-01-01", 8), (1, "2001-01-01", 0)], "d2")
    assert more.parts[2001][:1] == after.parts[2001] and len(more.parts[2001]) == 2
    want = rows_of(store.read(spark, table))
    packed = store.compacted(spark, table)
    assert len(packed.parts[2001]) == 1 and packed.parts[2000] == before.parts[2000] and rows_of(store.read(spark, table)) == want
    assert store.compacted(spark, table) == packed
    assert rows_of(store.read(spark, table, [2000]).select("v")) == [(5,)]


def test_broken_delivery_leaves_the_table(spark, table):
    merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 5)], "d0")
    bad = delivery(spark, [(1, "2000-01-01", 6)]).withColumn("v", F.raise_error(F.lit("broken")).cast("long"))
    with pytest.raises(Exception, match="broken"):
        store.merge_last_wins(spark, table, bad, KEY, F.year("day"), [F.col("k")], "d1")
    assert rows_of(store.read(spark, table).select("v")) == [(5,)]
    merge(spark, store.merge_last_wins, table, [(1, "2000-01-01", 6)], "d1")
    assert rows_of(store.read(spark, table).select("v")) == [(6,)]


def test_second_writer_of_a_version_fails(spark, table):
    old = store.current(spark, table)
    merge(spark, store.merge_first_wins, table, [(1, "2000-01-01", 5)], "d0")
    with pytest.raises(store.Conflict):
        store._publish(spark, table, store.replace(old, number=1))
    assert rows_of(store.read(spark, table).select("v")) == [(5,)]


def test_empty_delivery_and_missing_table(spark, table, tmp_path):
    assert merge(spark, store.merge_first_wins, table, [], "none").deliveries.keys() == {"none"}
    assert store.read(spark, table).count() == 0
    with pytest.raises(ValueError):
        store.read(spark, f"file://{tmp_path}/nothing")
    with pytest.raises(ValueError):
        merge(spark, store.merge_first_wins, f"file://{tmp_path}/nothing", [], "x")


def test_keys_stay_over_deliveries(spark, tmp_path):
    path = f"file://{tmp_path}/{uuid.uuid4().hex}"
    frame = lambda names: spark.createDataFrame([(n, 1) for n in names], "ticker string, x int")
    take = lambda df: {r["ticker"]: r["id"] for r in df.collect()}
    one = take(registry.assign_keys(spark, path, frame(["m", "b", "m", None]), "ticker", "id", "d0"))
    assert one == {"b": 1, "m": 2}
    two = take(registry.assign_keys(spark, path, frame(["a", "m", "z"]), "ticker", "id", "d1"))
    assert two == {"b": 1, "m": 2, "a": 3, "z": 4}
    assert take(registry.assign_keys(spark, path, frame(["q"]), "ticker", "id", "d1")) == two
    assert take(registry.assign_keys(spark, path, frame([]), "ticker", "id", "d2")) == two
