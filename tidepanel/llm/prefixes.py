"""Prefix trie of conversations as a burst trie: containers of suffixes under heads, oversized ones burst by the next turn.

Equal conversations are one suffix with a weight. All suffixes begin in the container of the root; a container with too
many turns is burst: its head grows by the turns that all its suffixes share, and each suffix moves on to the container
of its next turn. What remains small is dealt to shards, where a container's suffixes are sorted and swept once into
nodes. Sums over subtrees then climb from the containers through the burst heads, round by round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import written

#: Letters of a turn's id within a path: 128 bits of a SHA-256 in hex.
ID = 32
WORDS = "[^\\x20\\x09-\\x0D]+"
#: Turns below a container's head before it is burst, and turns of a shard, about.
CONTAINER_TURNS, SHARD_TURNS = 20_000, 40_000
#: Conversation ids of one block whose decimal forms are joined before the blocks of a node meet.
ID_BLOCK = 512
NOTHING = hashlib.sha256(b"").hexdigest()

NODE = ("conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, "
        "ends_sha256 string")


def sequences(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv_id, turns``: the ids and word counts of each conversation's turns as ``array<struct<id, words>>``, in order.

    Order is by turn, null first; equal turns go by role and then by id. Null role and text are empty, rows without a
    conversation id belong to none and are left out, repeated rows are turns of their own. Texts stay behind: only a
    fixed-size id and a count of each turn are gathered, with which a conversation must fit into a row.
    """
    said, who = F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")), F.coalesce(F.col(f"`{role}`").cast("string"), F.lit(""))
    unique = F.concat(F.char_length(who).cast("string"), F.lit(":"), who, said)
    rows = turns.where(F.col(f"`{conv}`").isNotNull()).select(
        F.col(f"`{conv}`").cast("long").alias("conv_id"),
        F.struct(F.col(f"`{turn}`").cast("long").alias("turn"), who.alias("role"), F.substring(F.sha2(unique, 256), 1, ID).alias("id"),
                 F.regexp_count(said, F.lit(WORDS)).cast("long").alias("words")).alias("t"))
    ordered = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    nulls_first = F.concat(F.filter("t", lambda x: x["turn"].isNull()), F.filter("t", lambda x: x["turn"].isNotNull()))
    return ordered.select("conv_id", F.transform(nulls_first, lambda x: F.struct(x["id"], x["words"])).alias("turns"))


def with_shared_heads(convs: DataFrame, head_turns: Column, base: Column, most: int) -> DataFrame:
    """Rebuild conversations: the first ``head_turns`` turns of conversation ``base``, then the own ones after as many.

    ``convs`` has ``conv_id`` and ``turns``; the columns are expressions of ``conv_id``, ``head_turns`` at most ``most``.
    A base that is absent gives no turns, one that is shorter gives all of its own. Only the ``most`` first turns of
    the bases are joined.
    """
    own = convs.select("conv_id", "turns", base.alias("base"), head_turns.cast("int").alias("h"))
    heads = convs.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most).alias("head"))
    bases = own.select("base").distinct()
    joined = own.join(heads.join(bases, "base", "left_semi"), "base", "left")
    rest = F.filter("turns", lambda x, i: i >= F.col("h"))
    head = F.filter(F.coalesce("head", F.slice("turns", 1, 0)), lambda x, i: i < F.col("h"))
    return joined.select("conv_id", F.concat(head, rest).alias("turns"))


def weighted(convs: DataFrame, id_block: int = ID_BLOCK) -> DataFrame:
    """Equal conversations as one row: ``conv_id`` (the least), ``path``, ``words``, ``n``, ``ends`` (hash of all their ids).

    The ids of equal conversations are sorted and joined in blocks of a range of ids each, then a task runs through the
    blocks of a path in order and keeps only the state of the hash. ``convs`` has distinct ``conv_id`` and ``turns``.
    """
    paths = written(convs.select("conv_id", F.array_join(F.transform("turns", lambda x: x["id"]), "").alias("path"),
                                 F.transform("turns", lambda x: x["words"]).alias("words")), "paths")
    blocks = paths.select(F.sha2("path", 256).alias("digest"), F.floor(F.col("conv_id") / id_block).alias("block"), "conv_id").groupBy(
        "digest", "block").agg(F.array_sort(F.collect_list("conv_id")).alias("ids"))
    blocks = blocks.select("digest", "block", F.array_join(F.col("ids").cast("array<string>"), ",").alias("joined"),
                           F.size("ids").cast("long").alias("n"), F.col("ids")[0].alias("least"))

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, state, n, least = None, None, 0, 0
        for batch in batches:
            out = []
            for digest, joined, count, first in zip(*(c.to_pylist() for c in batch.columns)):
                if digest != name:
                    if name is not None:
                        out.append((least, n, state.hexdigest()))
                    name, state, n, least = digest, hashlib.sha256(), 0, first
                else:
                    state.update(b",")
                state.update(joined.encode())
                n += count
            yield table(out)
        yield table([(least, n, state.hexdigest())] if name is not None else [])

    def table(rows: list) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [(), (), ()]
        return pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string()))], ["conv_id", "n", "ends"])

    met = blocks.repartition("digest").sortWithinPartitions("digest", "block").select("digest", "joined", "n", "least").mapInArrow(
        hashes, "conv_id long, n long, ends string")
    return paths.join(met, "conv_id")


# ---- bursting


def _key(depth: Column) -> Column:
    """The name of the head that a path has at a depth."""
    return F.sha2(F.substring("path", F.lit(1), depth * ID), 256)


def _shared(low: Column, high: Column) -> Column:
    """How many turns two paths share."""
    most = F.least(F.char_length(low), F.char_length(high)) / ID
    differ = lambda i: F.substring(low, i * ID + 1, F.lit(ID)) != F.substring(high, i * ID + 1, F.lit(ID))
    places = F.when(most > 0, F.sequence(F.lit(0), most.cast("int") - 1)).otherwise(F.array().cast("array<int>"))
    found = F.filter(places, differ)
    return F.coalesce(F.try_element_at(found, F.lit(1)), most.cast("int"))


def burst(rows: DataFrame, container_turns: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Burst containers until none has more than ``container_turns`` turns below its head, unless of one suffix.

    Rows are suffixes: ``conv_id, path, words, n, ends, depth, head, parent, parent_conv``. Returns the rows that stay
    in containers and, for each round, the burst heads ``head, parent, parent_conv, depth, branch, conv_id, n, words,
    ends``: their nodes from ``depth`` to ``branch`` have the same members, at ``branch`` suffixes part or one ends. A
    container's children always have fewer suffixes each, however long the turns are that all share.
    """
    kept, heads = [], []
    while True:
        size = F.char_length("path") / ID - F.col("depth")
        large = rows.groupBy("head").agg(F.sum(size).alias("turns"), F.count(F.lit(1)).alias("suffixes")).where(
            (F.col("turns") > container_turns) & (F.col("suffixes") > 1)).select("head")
        large = written(large, "large")
        if large.isEmpty():
            return [*kept, rows], heads
        kept.append(rows.join(large, "head", "left_anti"))
        open_ = rows.join(large, "head", "left_semi")
        facts = open_.groupBy("head").agg(
            F.min("parent").alias("parent"), F.min("parent_conv").alias("parent_conv"), F.min("depth").alias("depth"),
            F.min(F.struct("path", "words")).alias("low"), F.max("path").alias("high"), F.min("conv_id").alias("conv_id"), F.sum("n").alias("n"))
        # The suffix that ends at the branch is the least one, if there is one.
        facts = written(facts.withColumn("branch", _shared(F.col("low.path"), F.col("high"))).select(
            "head", "parent", "parent_conv", "depth", "branch", "conv_id", "n", F.slice("low.words", F.lit(1), F.col("branch")).alias("words")), "heads")
        moved = open_.drop("parent", "parent_conv", "depth").join(
            facts.select("head", "branch", F.col("conv_id").alias("parent_conv")), "head")
        ended = F.char_length("path") == F.col("branch") * ID
        ends = moved.where(ended).select("head", "ends")
        heads.append(facts.join(ends, "head", "left"))
        below = F.col("branch") + 1
        rows = written(moved.where(~ended).select(
            "conv_id", "path", "words", "n", "ends", below.alias("depth"), _key(below).alias("head"),
            F.col("head").alias("parent"), "parent_conv"), "suffixes")


# ---- sweeping


def sweep(paths: list[str], words: list, convs: list[int], weights: list[int], ends: list[str], depth: int) -> dict[str, list]:
    """Nodes of one container from ``depth`` on: its suffixes sorted and gone through once, with a stack of open nodes.

    Paths are distinct and share the first ``depth`` turns. The first node is the container's head; its parent's place
    is -1, that of others the parent's place in the lists.
    """
    order = sorted(range(len(paths)), key=paths.__getitem__)
    out: dict[str, list] = {c: [] for c in ("conv_id", "depth", "parent", "n_convs", "n_children", "n_leaves", "saved", "ends", "last")}
    conv, n, children, leaves, saved = out["conv_id"], out["n_convs"], out["n_children"], out["n_leaves"], out["saved"]
    stack: list[int] = []

    def close() -> None:
        node = stack.pop()
        leaves[node] = leaves[node] or 1
        saved[node] += (n[node] - 1) * out["last"][node]
        if stack:
            above = stack[-1]
            conv[above] = min(conv[above], conv[node])
            n[above] += n[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]

    before = None
    for i in order:
        path, size = paths[i], len(paths[i]) // ID
        shared = depth - 1 if before is None else common(before, path, depth)
        while len(stack) > shared - depth + 1:
            close()
        for d in range(shared + 1, size + 1):
            conv.append(convs[i])
            out["depth"].append(d)
            out["parent"].append(stack[-1] if stack else -1)
            n.append(0)
            children.append(0)
            leaves.append(0)
            saved.append(0)
            out["ends"].append(NOTHING)
            out["last"].append(int(words[i][d - 1]) if d else 0)
            stack.append(len(conv) - 1)
        end = stack[-1]
        n[end] += weights[i]
        out["ends"][end] = ends[i]
        before = path
    while stack:
        close()
    return out


def common(a: str, b: str, depth: int) -> int:
    """How many turns two paths share, of which ``depth`` are known to be."""
    size = min(len(a), len(b))
    start, step = depth * ID, 64 * ID
    while start < size and a[start:start + step] == b[start:start + step]:
        start += step
    d = min(start, size) // ID
    while (d + 1) * ID <= size and a[d * ID:(d + 1) * ID] == b[d * ID:(d + 1) * ID]:
        d += 1
    return d


def _sweeps(rows: pd.DataFrame) -> pd.DataFrame:
    """The nodes of all containers of a shard; a container's first node carries its head and the head above."""
    parts = []
    for head, held in rows.groupby("head", sort=False):
        nodes = sweep(held["path"].tolist(), held["words"].tolist(), held["conv_id"].tolist(), held["n"].tolist(),
                      held["ends"].tolist(), int(held["depth"].iloc[0]))
        conv, up = np.array(nodes["conv_id"], np.int64), np.array(nodes["parent"])
        top = up < 0
        above = held["parent_conv"].iloc[0]
        parent = pd.Series(conv[up], dtype="Int64")
        parent[top] = pd.NA if pd.isna(above) else int(above)
        size = len(conv)
        parts.append(pd.DataFrame({
            "conv_id": conv, "depth": nodes["depth"], "parent_conv_id": parent, "n_convs": nodes["n_convs"], "n_children": nodes["n_children"],
            "n_leaves": nodes["n_leaves"], "saved_tokens": nodes["saved"], "ends_sha256": nodes["ends"],
            "under": np.where(top, held["parent"].iloc[0], None) if size else []}))
    return pd.concat(parts, ignore_index=True)


def _climbed(heads: list[DataFrame], tops: DataFrame) -> list[DataFrame]:
    """Nodes of the burst heads: leaves and savings of their children's tops added up, from the last round to the first.

    ``tops`` has ``under, n_leaves, saved_tokens`` of the containers' heads. A head's sums are combined before they
    are shuffled.
    """
    out = []
    for facts in reversed(heads):
        sums = tops.groupBy(F.col("under").alias("head")).agg(
            F.count(F.lit(1)).alias("children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("below"))
        known = written(facts.join(sums, "head"), "climbed")
        last = F.slice(F.concat(F.array(F.lit(0).cast("long")), F.col("words")), F.col("depth") + 1, F.col("branch") - F.col("depth") + 1)
        each = known.select(*[c for c in known.columns if c != "words"], F.posexplode(last).alias("place", "last"))
        d, bottom_up = F.col("depth") + F.col("place"), Window.partitionBy("head").orderBy(F.col("place").desc())
        top, branch = F.col("place") == 0, d == F.col("branch")
        nodes = each.select(
            "conv_id", d.cast("long").alias("depth"), F.when(top, F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"), F.when(branch, F.col("children")).otherwise(1).cast("long").alias("n_children"),
            F.col("leaves").alias("n_leaves"), (F.col("below") + (F.col("n") - 1) * F.sum("last").over(bottom_up)).alias("saved_tokens"),
            F.when(branch, F.coalesce("ends", F.lit(NOTHING))).otherwise(NOTHING).alias("ends_sha256"),
            F.when(top, F.col("parent")).alias("under"))
        nodes = written(nodes, "nodes")
        out.append(nodes.drop("under"))
        tops = tops.unionByName(nodes.where("under IS NOT NULL").select("under", "n_leaves", "saved_tokens"))
    return out


def prefix_trie(convs: DataFrame, container_turns: int = CONTAINER_TURNS, shard_turns: int = SHARD_TURNS,
                id_block: int = ID_BLOCK) -> DataFrame:
    """One row per distinct beginning of the conversations ``convs`` (distinct ``conv_id``, ``turns`` as of ``sequences``).

    ``conv_id`` is the least of the ``n_convs`` members and ``depth`` the number of turns, from the root with none on;
    ``parent_conv_id`` the parent's ``conv_id`` (null for the root). ``n_leaves`` and ``saved_tokens``, the words of last
    turns that members after the first needn't repeat, are sums over the subtree. ``ends_sha256`` is the hash of
    the ids of members that end there, ascending and joined by commas. A conversation without turns belongs to the
    root alone. No conversations give no nodes.
    """
    start = weighted(convs, id_block).select("*", F.lit(0).alias("depth"), F.lit("").alias("head"),
                                             F.lit(None).cast("string").alias("parent"), F.lit(None).cast("long").alias("parent_conv"))
    kept, heads = burst(written(start, "suffixes"), container_turns)
    rows = kept[0]
    for more in kept[1:]:
        rows = rows.unionByName(more)
    size = F.char_length("path") / ID - F.col("depth") + 1
    shards = max(1, -(-int(rows.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]) // shard_turns))
    dealt = rows.withColumn("shard", F.pmod(F.xxhash64("head"), F.lit(shards))).repartition(shards, "shard")
    swept = written(dealt.groupBy("shard").applyInPandas(lambda held: _sweeps(held), NODE + ", under string"), "swept")
    out = swept.drop("under")
    for nodes in _climbed(heads, swept.where("under IS NOT NULL").select("under", "n_leaves", "saved_tokens")):
        out = out.unionByName(nodes)
    return out
