"""Near duplicates by b-bit MinHash: bands give candidates, low bits of the minima sift them, full sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import written
from tidepanel.llm.components import components

#: Minima per document, in bands of rows. At a similarity of 0.8, 3 pairs in a million share no band.
BANDS, ROWS = 32, 5
#: Low bits kept of each minimum, packed into 64-bit words.
BITS = 4
#: A pair is looked at if its estimated similarity is not this far below the threshold: five standard errors.
MARGIN = 0.17
#: Members of a bucket that meet in one task; larger buckets are cut into blocks that meet pairwise.
BLOCK = 1024
#: Up to so many keys a filter on whole documents is broadcast; more are joined by shuffle.
BROADCAST_KEYS = 1_000_000

_rng = np.random.default_rng(20240229)
_A = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, BANDS * ROWS, dtype=np.uint64)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied between documents when large."""

    def __missing__(self, word: bytes) -> int:
        self[word] = value = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
        return value

    def shingles(self, text: bytes, words: int) -> np.ndarray:
        """The sorted distinct hashes of a text's word shingles; a shorter text is one shingle, an empty one none."""
        if len(self) > 400_000:
            self.clear()
        found = text.lower().split()  # bytes: only A-Z, and white space is 0x20 and 0x09 to 0x0D
        h = np.fromiter(map(self.__getitem__, found), np.uint64, len(found))
        n = min(words, len(h))
        if not n:
            return h
        out = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            out = mixed(out * _STEP + h[i:len(h) - n + 1 + i])
        return np.unique(out)


def minima(shingles: np.ndarray, block: int = 4096) -> np.ndarray:
    out = np.full(len(_A), ~np.uint64(0))
    for at in range(0, len(shingles), block):
        np.minimum(out, (np.multiply.outer(_A, shingles[at:at + block]) + _B[:, None]).min(1), out)
    return out


def band_keys(low: np.ndarray) -> np.ndarray:
    """One 64-bit key per band from its whole minima; the band's number is part of it."""
    parts, key = low.reshape(BANDS, ROWS), np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        key = mixed(key * _STEP + parts[:, i])
    return key.view(np.int64)


def packed(low: np.ndarray) -> np.ndarray:
    """The low bits of all minima, 64 / BITS to a word."""
    each = 64 // BITS
    bits = np.zeros(-(-len(low) // each) * each, np.uint64)
    bits[:len(low)] = low & np.uint64(2**BITS - 1)
    shifts = np.arange(each, dtype=np.uint64) * np.uint64(BITS)
    return np.bitwise_or.reduce(bits.reshape(-1, each) << shifts, axis=1).view(np.int64)


def _ones() -> int:
    return sum(1 << (BITS * i) for i in range(64 // BITS))


def estimate(differing: Column | np.ndarray) -> Column | np.ndarray:
    """Similarity from the count of differing minima: equal low bits arise by chance in one case of 2^BITS."""
    chance = 2.0**-BITS
    return (1 - differing / float(len(_A)) - chance) / (1 - chance)


def differing(a: Column, b: Column) -> Column:
    """How many minima differ in their low bits: fold each group of bits of the XOR onto one, and count."""

    def word(x: Column, y: Column) -> Column:
        d = x.bitwiseXOR(y)
        fold = d
        for i in range(1, BITS):
            fold = fold.bitwiseOR(F.shiftrightunsigned(d, i))
        return F.bit_count(fold.bitwiseAND(F.lit(_ones())))

    return F.aggregate(F.zip_with(a, b, word), F.lit(0), lambda s, x: s + x)


def signatures(docs: DataFrame, key: str, text: str, words: int) -> DataFrame:
    """``id, text_key, n, node, signature, bands`` per row; node names the shingle set, null for an empty one."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                some = batch.slice(at, 1000)
                n, node, sig, bands = [], [], [], []
                for value in some.column(2):
                    s = hashes.shingles(value.as_py() or b"", words)
                    n.append(len(s))
                    low = minima(s) if len(s) else None
                    node.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    sig.append(packed(low) if len(s) else None)
                    bands.append(band_keys(low) if len(s) else None)
                longs = pa.list_(pa.int64())
                yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array(n, pa.int64()), pa.array(node, pa.binary()), pa.array(sig, longs),
                                                  pa.array(bands, longs)], names=["id", "text_key", "n", "node", "signature", "bands"])

    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
                       F.col(f"`{text}`").cast("binary").alias("text"))
    return rows.mapInArrow(sign, "id long, text_key long, n long, node binary, signature array<long>, bands array<long>")


def confirmed(pairs: DataFrame, texts: DataFrame, words: int, percent: int) -> DataFrame:
    """Those pairs ``a, b`` whose full shingle sets have 100 * intersection >= percent * union."""

    def decide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, known, sets = WordHashes(), None, None
        for batch in batches:
            keep = []
            for a, left, right in zip(batch.column(0), batch.column(2), batch.column(3)):
                if known != (a := a.as_py()):
                    known, sets = a, hashes.shingles(left.as_py(), words)
                other = hashes.shingles(right.as_py(), words)
                both = len(np.intersect1d(sets, other, assume_unique=True))
                keep.append(100 * both >= percent * (len(sets) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    met = pairs.join(texts.select(F.col("node").alias("b"), F.col("text").alias("right")), "b").join(
        texts.select(F.col("node").alias("a"), F.col("text").alias("left")), "a")
    return met.select("a", "b", "left", "right").mapInArrow(decide, "a binary, b binary")


def only(df: DataFrame, keys: DataFrame, *names: str) -> DataFrame:
    """Rows whose columns ``names`` are among ``keys`` (null equal to null); broadcast only if there are few keys."""
    few = keys.count() <= BROADCAST_KEYS
    keys = keys.select(*[F.col(n).alias(f"_k{i}") for i, n in enumerate(names)])
    same = [df[n].eqNullSafe(keys[f"_k{i}"]) for i, n in enumerate(names)]
    on = same[0]
    for s in same[1:]:
        on = on & s
    return df.join(F.broadcast(keys) if few else keys, on, "left_semi")


def near_duplicates(docs: DataFrame, key: str, text: str, words: int = 5, percent: int = 80) -> DataFrame:
    """One row per row of ``docs``: ``id, text_key, n_shingles, component_id, kept``.

    Words are runs of other than 0x20 and 0x09-0x0D with A-Z lower-cased, a set is the distinct shingles of
    ``words`` words (a shorter text: all its words as one). Rows with 100 * intersection >= ``percent`` * union are
    linked; ``component_id`` is the least id that links lead to. Null, empty and blank texts have the empty set,
    are linked with nothing and are their own component. ``kept`` is id = component_id; equal rows with that id
    are all kept. Rows without id take part, their component is that of the others, and they are kept only if no
    row of it has an id. ``text_key`` is a hash of the text. Other columns are ignored; no rows give no rows.

    Rows with equal sets are one node before anything is paired, so copies cost a map-side minimum. In every
    bucket of a band each node is paired with one member chosen by hash (not always the same one), which links
    most of a group; what is left are pairs of one bucket from different components, and these are all
    estimated, in blocks of bounded size. Pairs that the estimate lets pass are decided on full sets, the latter
    in the task where they meet, so that no more than the links themselves come out of a group.
    """
    signed = written(signatures(docs, key, text, words), "signatures")
    nodes = signed.where("node IS NOT NULL").groupBy("node").agg(
        F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key")).alias("rep"),
        F.min("id").alias("least_id"), F.first("signature").alias("signature"), F.first("bands").alias("bands"))
    nodes = written(nodes.select("node", "least_id", F.col("rep.id").alias("id"), F.col("rep.text_key").alias("text_key"),
                                 "signature", "bands"), "nodes")
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    centres = entries.groupBy("bucket").agg(F.min(F.struct(F.xxhash64("node", "bucket").alias("h"), "node")).alias("c"),
                                            F.count(F.lit(1)).alias("size")).where("size > 1")
    buckets = written(entries.join(centres.select("bucket", F.col("c.node").alias("centre"), "size"), "bucket"), "buckets")
    names = lambda p: p.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    sign = nodes.select("node", "signature")

    pairs = names(buckets.where("node <> centre").select(F.col("centre").alias("a"), F.col("node").alias("b")))
    least = percent / 100 - MARGIN
    likely = pairs.join(sign.toDF("a", "sa"), "a").join(sign.toDF("b", "sb"), "b").where(
        estimate(differing(F.col("sa"), F.col("sb"))) >= least).select("a", "b")
    likely = written(likely, "likely")
    ends = likely.select(F.col("a").alias("node")).union(likely.select("b")).distinct()
    links = written(confirmed(likely, texts_of(docs, text, key, nodes, ends), words, percent), "confirmed")
    found = written(components(links, "a", "b"), "components")

    member = buckets.where("size > 2 AND node <> centre").select("bucket", "node", "size").join(found, "node", "left").select(
        "bucket", "node", "size", F.coalesce("root", "node").alias("root"))
    mixed_buckets = member.groupBy("bucket").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select("bucket")
    open_ = written(member.join(mixed_buckets, "bucket"), "open")
    if open_.limit(1).count():
        texts = texts_of(docs, text, key, nodes, open_.select("node").distinct())
        more = written(across(open_, sign, texts, least, words, percent), "confirmed")
        found = written(components(links.union(more), "a", "b"), "components")

    roots = nodes.select("node", "least_id").join(found, "node")
    lowest = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    grouped = roots.join(lowest, "root").select("node", "component_id")
    whole = nodes.select("node", "least_id").join(grouped, "node", "left").select(
        "node", F.coalesce("component_id", "least_id").alias("component_id"))
    rows = signed.select("id", "text_key", "n", "node").join(whole, "node", "left")
    rows = rows.withColumn("component_id", F.when(F.col("node").isNull(), F.col("id")).otherwise(F.col("component_id")))
    return rows.select("id", "text_key", F.col("n").alias("n_shingles"), "component_id",
                       F.coalesce(F.col("id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"))


def texts_of(docs: DataFrame, text: str, key: str, nodes: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, text``: one text for each node of ``wanted``."""
    wanted = written(nodes.join(wanted, "node").select("node", "id", "text_key"), "wanted")
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.xxhash64(F.col(f"`{text}`")).alias("text_key"),
                       F.col(f"`{text}`").cast("binary").alias("text"))
    rows = only(rows, wanted, "id", "text_key").dropDuplicates(["id", "text_key"])
    same = wanted["id"].eqNullSafe(rows["id"]) & (wanted["text_key"] == rows["text_key"])
    return written(wanted.join(rows, same).select("node", "text"), "texts")


def across(members: DataFrame, sign: DataFrame, texts: DataFrame, least: float, words: int, percent: int) -> DataFrame:
    """Links ``a, b`` that join different components among members of open buckets.

    Buckets that share members form one group, so a node comes once however many buckets it is in. A group is cut
    into blocks of ``BLOCK`` members by hash, and each two blocks meet in a task, with signatures and texts: pairs
    of different components are estimated, and decided on full sets where the estimate is ``least`` or more. A
    link joins its components in the task, and what is in one component needs no further link. Only links leave.
    """
    hub = members.groupBy("bucket").agg(F.min("node").alias("hub"))
    groups = written(components(members.join(hub, "bucket"), "node", "hub"), "groups")
    own = members.select("node", "root").distinct().join(groups.select("node", F.col("root").alias("grp")), "node")
    sizes = own.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    rows = own.join(sizes, "grp").join(sign, "node").join(texts, "node").withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    met = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "grp", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "root", "signature", "text")
    ones, fits = np.uint64(_ones()), len(_A) * (1 - (least * (1 - 2.0**-BITS) + 2.0**-BITS))

    def link(table: pa.Table) -> pa.Table:
        node, root, text = (table[c].to_pylist() for c in ("node", "root", "text"))
        ranks = {r: i for i, r in enumerate(dict.fromkeys(root))}
        kind, own = np.array([ranks[r] for r in root]), table["own"].to_numpy()
        sig = np.array(table["signature"].to_pylist(), np.int64).view(np.uint64)
        hashes, sets, a, b = WordHashes(), {}, [], []
        first = table["i"][0].as_py()
        same = table["j"][0].as_py() == first
        left = np.flatnonzero(own == first)
        right = left if same else np.flatnonzero(own != first)
        for x in left:
            rest = right[right > x] if same else right
            d = sig[rest] ^ sig[x]
            fold = d.copy()
            for i in range(1, BITS):
                fold |= d >> np.uint64(i)
            differ = np.bitwise_count(fold & ones).sum(1)
            order = np.argsort(differ, kind="stable")
            for y in rest[order[differ[order] <= fits]]:
                if kind[x] == kind[y]:
                    continue
                for z in (x, y):
                    if z not in sets:
                        sets[z] = hashes.shingles(text[z], words)
                both = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
                if 100 * both >= percent * (len(sets[x]) + len(sets[y]) - both):
                    a.append(node[x])
                    b.append(node[y])
                    kind[kind == kind[y]] = kind[x]
        return pa.table({"a": pa.array(a, pa.binary()), "b": pa.array(b, pa.binary())})

    return met.groupBy("grp", "i", "j").applyInArrow(link, "a binary, b binary")
