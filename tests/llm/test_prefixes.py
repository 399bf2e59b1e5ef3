"""Prefix tries against a dictionary of all beginnings."""

import hashlib
import random

import pytest
import same
from pyspark.sql import functions as F

from tidepanel.llm import prefixes

COLUMNS = [c.split()[0] for c in prefixes.NODE.split(", ")]


def plain(convs):
    """Nodes of {conv_id: [(role, text), ...]}."""
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)

    def words(text):
        for c in "\t\n\v\f\r":
            text = text.replace(c, " ")
        return len([w for w in text.split(" ") if w])

    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[b] for b in below) or 1
        saved[node] = sum(saved[b] for b in below) + (len(members[node]) - 1) * (words(node[-1][1]) if node else 0)
    out = []
    for node, ids in members.items():
        ends = sorted(c for c in ids if len(convs[c]) == len(node))
        out.append((min(ids), len(node), min(members[node[:-1]]) if node else None, len(ids), len(children.get(node, [])),
                    leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, convs):
    rows = [(c, i, r, t) for c, turns in convs.items() for i, (r, t) in enumerate(turns)]
    random.Random(1).shuffle(rows)
    return prefixes.sequences(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))


def nodes(df):
    return sorted((tuple(r[c] for c in COLUMNS) for r in df.collect()), key=repr)


def conversations(rng, count):
    convs = {}
    for c in range(count):
        kind = rng.random()
        size = rng.choice([1, 2, 3, 5, 9])
        turns = [(rng.choice(["user", "assistant"]), " ".join(rng.choice("ab") for _ in range(rng.randint(0, 2)))) for _ in range(size)]
        common = [("user", f"x y z\t{i}") for i in range(8)]
        convs[c * 7 - 90] = common if kind < 0.3 else common[:rng.randint(1, 8)] + turns if kind < 0.6 else turns
    return convs


@pytest.mark.parametrize("container, shard, block", [(5, 30, 4), (60, 100, 512), (10_000, 40_000, 512)])
def test_trie_at_any_container_size(spark, container, shard, block):
    convs = conversations(random.Random(container), 150)
    trie = prefixes.prefix_trie(frame(spark, convs), container, shard, block)
    assert nodes(trie) == plain(convs)


def test_containers_stay_small(spark):
    convs = conversations(random.Random(2), 150)
    rows = prefixes.weighted(frame(spark, convs)).select(
        "*", F.lit(0).alias("depth"), F.lit("").alias("head"), F.lit(None).cast("string").alias("parent"), F.lit(None).cast("long").alias("parent_conv"))
    kept, heads = prefixes.burst(rows, 20)
    size = F.sum(F.char_length("path") / prefixes.ID - F.col("depth"))
    for part in kept:
        assert part.groupBy("head").agg(size.alias("s"), F.count("*").alias("n")).where("s > 20 AND n > 1").count() == 0
    # The turns that many share are taken in one step where nothing branches.
    assert 1 < len(heads) <= 10


def test_odd_rows(spark):
    rows = [(1, None, "user", "b"), (1, 0, None, None), (1, 0, "a", "x"), (2, None, "user", "b"), (2, 5, "", ""), (2, 6, "a", "x"),
            (3, 0, "user", "w " * 5_000), (4, 0, "user", "w " * 5_000), (None, 0, "user", "gone"), (5, 1, "r", "t"), (5, 1, "r", "t"),
            (6, 0, "ab", "c"), (7, 0, "a", "bc"), (8, 1, "r", "t")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("N", F.lit(1)).withColumn("words", F.lit(2))
    convs = {1: [("user", "b"), ("", ""), ("a", "x")], 2: [("user", "b"), ("", ""), ("a", "x")], 3: [("user", "w " * 5_000)], 4: [("user", "w " * 5_000)],
             5: [("r", "t"), ("r", "t")], 6: [("ab", "c")], 7: [("a", "bc")], 8: [("r", "t")]}
    own = prefixes.sequences(turns)
    assert nodes(prefixes.prefix_trie(own)) == plain(convs)
    assert nodes(prefixes.prefix_trie(own, 1, 1, 1)) == plain(convs)
    assert prefixes.prefix_trie(own.where("false")).collect() == []


def test_shared_heads(spark):
    convs = {20: [("u", "1"), ("u", "2")], 21: [("u", "a"), ("u", "b"), ("u", "c"), ("u", "d")], 22: [("u", "z")], 45: [("u", "q")], -3: [("u", "n")]}
    for h in range(4):
        out = prefixes.with_shared_heads(frame(spark, convs), F.lit(h), F.col("conv_id") - F.col("conv_id") % 20, most=3)
        got = {r["conv_id"]: [t["id"] for t in r["turns"]] for r in out.collect()}
        ids = {r["conv_id"]: [t["id"] for t in r["turns"]] for r in frame(spark, convs).collect()}
        want = {c: ids.get({45: 40, -3: 0}.get(c, 20), [])[:h] + own[h:] for c, own in ids.items()}
        assert got == want
    trie = nodes(prefixes.prefix_trie(out))  # with three turns from elsewhere, 45 and -3 have none left
    assert trie[0][0] == -3 or any(t[1] == 0 and t[0] == -3 and t[3] == 5 for t in trie)


def test_query_against_sql(spark):
    assert same.differences(spark, "op13_prefixes", "/root/testdata/sf0.01") == []
