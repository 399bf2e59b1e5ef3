"""Repeated passages: suffix arrays of batches in a family of levels that merge geometrically.

A byte goes if a string of ``SPAN`` bytes that covers it also starts earlier in the corpus. Two equal strings hold the
same least-hashed gram at the same place, so each string is owned by one *anchor*, and only strings of anchors with
equal grams need to be compared. Copies of an anchor's whole stretch of text are settled by grouping. For the rest, the
suffixes that begin in the stretch are sorted by their first SPAN bytes, batch by batch in the order of the corpus;
each batch's suffix array is scanned against the levels, what is new becomes a level, and levels of like size merge.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import written
from tidepanel.llm.neardup import mixed

SPAN = 100
#: Bytes of a gram; a string of SPAN bytes has SPAN - GRAM + 1 of them and is owned by the least-hashed, leftmost one.
GRAM = 24
WINDOWS = SPAN - GRAM + 1
#: Bytes of text, about, whose anchors are settled among themselves before they are shuffled.
FIND_BYTES = 1 << 24
#: Stretches of text in a task's index family, about, and in one batch of it.
TASK_STRETCHES, BATCH_STRETCHES = 6_000, 1_024
#: From so many different stretches of one gram on, each of its strings is dealt out by its own bytes.
HOT = 6_000

_rng = np.random.default_rng(20240507)
_BYTE = _rng.integers(0, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


class Powers:
    """Powers of the base modulo 2^64 and of its inverse, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            size = max(n, 2 * len(self.up), 1 << 16)
            self.up, self.down = (np.concatenate([np.ones(1, np.uint64), np.full(size - 1, b % 2**64, np.uint64)]).cumprod(dtype=np.uint64)
                                  for b in (_BASE, pow(_BASE, -1, 2**64)))
        return self.up[:n], self.down[:n]


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    done = 1
    while done < width:
        step = min(done, width - done)
        x, done = np.minimum(x[:-step], x[step:]), done + step
    return x


def leftmost(h: np.ndarray, starts: np.ndarray, block: int = 1 << 15) -> np.ndarray:
    """Where the least gram of the windows at ``starts`` is."""
    if not len(starts):
        return starts
    view = np.lib.stride_tricks.sliding_window_view(h, WINDOWS)
    return np.concatenate([starts[i:i + block] + view[starts[i:i + block]].argmin(1) for i in range(0, len(starts), block)])


def anchors(b: np.ndarray, powers: Powers) -> tuple[np.ndarray, ...]:
    """For each anchor of a text: gram hash, hash of its stretch, first string, number of strings (in a row).

    The stretch is ``b[first : first + strings + SPAN - 1]``. Every string of the text belongs to exactly one anchor.
    """
    n = len(b)
    if n < SPAN:
        return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 2
    up, down = powers.upto(n + 1)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[b] * up[:n], out=total[1:])
    grams = mixed((total[GRAM:] - total[:-GRAM]) * down[:n - GRAM + 1])
    h = (grams >> np.uint64(32)).astype(np.uint32)
    least = sliding_least(h, WINDOWS)
    first = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1])
    last = np.concatenate([first[1:], [len(least)]]) - 1
    fell = np.zeros(len(first), bool)
    fell[1:] = least[first[1:]] < least[first[1:] - 1]
    owner = first + WINDOWS - 1  # a smaller gram came in at the right
    owner[~fell] = leftmost(h, first[~fell])
    if (owner < last).any():  # equal hashes near each other: find the owner string by string
        tied = owner < last
        p = np.concatenate([np.arange(a, z + 1) for a, z in zip(first[tied], last[tied])])
        o = leftmost(h, p)
        cut = np.concatenate([[True], (o[1:] != o[:-1]) | (p[1:] != p[:-1] + 1)])
        ends = np.concatenate([np.flatnonzero(cut)[1:], [len(p)]]) - 1
        first, last, owner = (np.concatenate([x[~tied], y]) for x, y in ((first, p[cut]), (last, p[ends]), (owner, o[cut])))
        order = np.argsort(first)
        first, last, owner = first[order], last[order], owner[order]
    stretch = mixed((total[last + SPAN] - total[first]) * down[first]) ^ mixed(((last - first) * SPAN + owner - first).astype(np.uint64))
    return grams[owner], stretch, first, last - first + 1


def presettled(gram: np.ndarray, stretch: np.ndarray, row: np.ndarray, first: np.ndarray, strings: np.ndarray) -> tuple[np.ndarray, ...]:
    """Settle the copies among anchors that are given in the order of the corpus, before anything is shuffled.

    An anchor whose stretch came earlier here is a copy whatever else the corpus holds, so it need not meet the others
    of its gram: a passage of a third of all texts leaves each call once. Neighbouring copies of a text become one run,
    flagged and keyed by its own place. Anchors come back as they were, with a flag for runs.
    """
    order = np.lexsort((stretch, gram))  # stable
    copy = np.zeros(len(gram), bool)
    copy[order[1:]] = (gram[order[1:]] == gram[order[:-1]]) & (stretch[order[1:]] == stretch[order[:-1]])
    new, at = ~copy, np.flatnonzero(copy)
    starts = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (row[at[1:]] != row[at[:-1]]) | (first[at[1:]] != first[at[:-1]] + strings[at[:-1]])])[:len(at)]
    heads = at[starts]
    long = np.add.reduceat(strings[at], np.flatnonzero(starts)) if len(at) else strings[at]
    place = mixed(stretch[heads] ^ mixed((row[heads].astype(np.uint64) << np.uint64(32)) + first[heads].astype(np.uint64)))
    join = lambda x, y: np.concatenate([x[new], y])
    return (join(gram, place), join(stretch, stretch[heads]), join(row, row[heads]), join(first, first[heads]), join(strings, long),
            np.arange(new.sum() + len(heads)) >= new.sum())


def merged(ranges: np.ndarray) -> np.ndarray:
    """Union of ``(start, end)`` rows, touching ones joined."""
    if not len(ranges):
        return ranges.reshape(0, 2)
    ranges = ranges[np.lexsort((ranges[:, 1], ranges[:, 0]))]
    reach = np.maximum.accumulate(ranges[:, 1])
    new = np.concatenate([[True], ranges[1:, 0] > reach[:-1]])
    ends = np.concatenate([np.flatnonzero(new)[1:], [len(ranges)]]) - 1
    return np.stack([ranges[new, 0], reach[ends]], 1)


class Family:
    """Levels of sorted suffixes (their first SPAN bytes), each level more than twice the next one's size."""

    def __init__(self) -> None:
        self.levels: list[np.ndarray] = []

    def add(self, suffixes: np.ndarray) -> np.ndarray:
        """Scan a batch against the levels and take it in: says for each suffix whether an earlier one is equal."""
        array, first, whose = np.unique(suffixes, return_index=True, return_inverse=True)
        known = np.zeros(len(array), bool)
        for level in self.levels:
            at = np.searchsorted(level, array)
            known |= level[np.minimum(at, len(level) - 1)] == array
        again = np.ones(len(suffixes), bool)
        again[first] = False
        again |= known[whose]
        if not known.all():
            self.levels.append(array[~known])
        while len(self.levels) > 1 and len(self.levels[-2]) <= 2 * len(self.levels[-1]):
            small, large = self.levels.pop(), self.levels.pop()
            self.levels.append(np.insert(large, np.searchsorted(large, small), small))
        return again


def with_order(docs: DataFrame, key: str, text: str) -> DataFrame:
    """``id, uid, text`` (bytes) and ``row``, a struct of all columns. ``uid`` tells apart rows of a repeated or missing
    id by their place in the scan."""
    rows = docs.select(F.col(f"`{key}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text}`").cast("binary"), F.lit(b"")).alias("text"),
                       F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns) if c != text],
                                F.when(F.octet_length(f"`{text}`") == 0, "").alias(f"c{len(docs.columns)}")).alias("row"))
    total, known, distinct = rows.agg(F.count(F.lit(1)), F.count("id"), F.lit(0)).first()
    if total == known:
        distinct = rows.groupBy("id").count().where("count > 1").limit(1).count()
    plain = total == known and not distinct
    if plain:
        return rows.withColumn("uid", F.lit(0).cast("long"))
    # Written once: another scan may be split in other ways, and would give its rows other numbers.
    return written(rows.withColumn("uid", F.monotonically_increasing_id()), "numbered")


def marked(docs: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Join marks per document to the documents, which are dealt out by id at every size alike."""
    return docs.join(marks.hint("merge"), ["id", "uid"], how)


def repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """Per document its spans to remove: ``id, uid, row, n_bytes, n_removed, n_spans, spans, kept``.

    A byte is removed if a string of 100 bytes that covers it starts earlier too: in a smaller id, or in the same
    text further left; matches lie within texts, may overlap, and are judged on the input. Rows of one id, or
    without id (after all others), are ordered by their place in the scan. ``spans`` are maximal runs ``(start,
    end)`` in bytes, ``kept`` the remaining bytes. Null and empty texts have none. ``row`` has the columns other than
    the text, as fields c0, c1, ... by their place.
    """
    source = with_order(docs, key, text)

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers()
        for batch in batches:
            # in the order of the corpus, so that of equal stretches met here the first one is known
            keys = pa.table({"id": batch.column(0), "uid": batch.column(1)})
            order = pc.sort_indices(keys, [("id", "ascending"), ("uid", "ascending")], null_placement="at_end").to_pylist()
            ids, uids, texts = batch.columns
            at = 0
            while at < len(order):
                rows, size, found = [], 0, []
                while at < len(order) and size < FIND_BYTES:
                    value = texts[order[at]].as_buffer()
                    data = np.frombuffer(value, np.uint8) if value is not None and value.size else np.zeros(0, np.uint8)
                    found.append(anchors(data, powers))
                    rows.append(order[at])
                    size, at = size + len(data), at + 1
                gram, stretch, first, strings = (np.concatenate(c) for c in zip(*found))
                row = np.repeat(rows, [len(f[0]) for f in found])
                gram, stretch, row, first, strings, settled = presettled(gram, stretch, row, first, strings)
                take = pa.array(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(settled), pa.array(stretch.view(np.int64)), ids.take(take), uids.take(take),
                     pa.array(first.astype(np.int32)), pa.array(strings.astype(np.int32))],
                    names=["gram", "settled", "stretch", "id", "uid", "first", "strings"])

    found = source.select("id", "uid", "text").mapInArrow(
        find, "gram long, settled boolean, stretch long, id long, uid long, first int, strings int")
    by_gram = Window.partitionBy("gram", "settled")
    in_order = Window.partitionBy("gram", "settled", "stretch").orderBy(F.asc_nulls_last("id"), "uid", "first")
    # dealt out once, by gram: both windows are content with that; settled runs have keys of their own and spread evenly
    seen = found.repartition("gram", "settled").withColumn("n", F.row_number().over(in_order)).withColumn(
        "kinds", F.count(F.when(F.col("n") == 1, 1)).over(by_gram))
    # later copies of a stretch are settled; first ones must be compared where a gram has several
    facts = seen.where("settled OR n > 1 OR kinds > 1").select("id", "uid", F.struct(
        "first", "strings", (F.col("settled") | (F.col("n") > 1)).alias("copy"), (F.col("kinds") >= HOT).alias("hot"), "gram").alias("m"))
    facts = written(facts.groupBy("id", "uid").agg(F.collect_list("m").alias("m")), "marks")

    open_ = facts.select("id", "uid", F.filter("m", lambda m: ~m["copy"]).alias("m")).where(F.size("m") > 0)
    stretches = open_.select(F.sum(F.size("m"))).first()[0] or 0
    places = facts.select("id", "uid", F.transform(F.filter("m", lambda m: m["copy"]), lambda m: F.struct(
        m["first"].alias("start"), (m["first"] + m["strings"] + (SPAN - 1)).alias("end"))).alias("spans"))
    spans = places.where(F.size("spans") > 0)
    if stretches:
        spans = spans.unionByName(compared(source, open_, stretches))
    ranges = written(spans.groupBy("id", "uid").agg(F.flatten(F.collect_list("spans")).alias("spans")).withColumn(
        "marks", F.to_binary(F.array_join(F.transform("spans", lambda s: F.concat(
            F.lpad(F.hex(s["start"].cast("long")), 8, "0"), F.lpad(F.hex(s["end"].cast("long")), 8, "0"))), ""), F.lit("hex"))).drop("spans"), "ranges")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                removed, runs, spans, kept = [], [], [], []
                for value, marks in zip(part.column(3), part.column(4)):
                    data, marks = value.as_py(), marks.as_py() or b""
                    ranges = merged(np.frombuffer(marks, ">u4").astype(np.int64).reshape(-1, 2))
                    edges = [0, *ranges.ravel().tolist(), len(data)]
                    kept.append(b"".join(data[a:z] for a, z in zip(edges[::2], edges[1::2])) if len(ranges) else data)
                    removed.append(len(data) - len(kept[-1]))
                    runs.append(len(ranges))
                    spans.append([{"start": a, "end": z} for a, z in ranges.tolist()])
                n = pa.array([len(v.as_buffer()) for v in part.column(3)], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), part.column(2), n, pa.array(removed, pa.int64()), pa.array(runs, pa.int64()),
                     pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))), pa.array(kept, pa.binary())],
                    names=["id", "uid", "row", "n_bytes", "n_removed", "n_spans", "spans", "kept"])

    if source.where("id IS NULL").limit(1).count():  # a null id must meet its marks too
        out = marked(source.withColumn("id", F.coalesce("id", F.lit(-2**63))), ranges.withColumn("id", F.coalesce("id", F.lit(-2**63))), "left").withColumn(
            "id", F.when(F.col("id") != -2**63, F.col("id")))
    else:
        out = marked(source, ranges, "left")
    kind = source.schema["row"].dataType.simpleString()
    return out.select("id", "uid", "row", "text", "marks").mapInArrow(
        cut, f"id long, uid long, row {kind}, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary")


def without_repeats(docs: DataFrame, key: str, text: str) -> DataFrame:
    """The documents, all columns as they were but the text, which loses the spans of ``repeats``.

    Where a span cuts a character, the rest of that character goes too. A text without spans stays as it is, null
    stays null.
    """
    found = repeats(docs, key, text)
    valid = F.regexp_replace(F.make_valid_utf8(F.col("kept").cast("string")), "\ufffd", "")
    whole = F.when(F.col("n_removed") > 0, valid).otherwise(F.when(F.col("n_bytes") > 0, F.col("kept").cast("string")).otherwise(F.col("empty")))
    # null and empty texts are both empty bytes; which it was is carried beside them
    return found.withColumn("empty", F.col(f"row.c{len(docs.columns)}")).select(
        *[whole.alias(c) if c == text else F.col(f"row.c{i}").alias(c) for i, c in enumerate(docs.columns)])


def compared(source: DataFrame, open_: DataFrame, stretches: int) -> DataFrame:
    """Spans of strings that start earlier in another stretch of the same gram: ``id, uid, spans``."""
    point = lambda m: F.concat(F.lpad(F.hex(m["first"].cast("long")), 8, "0"), F.lpad(F.hex(m["strings"].cast("long")), 8, "0"),
                               F.lpad(F.hex(m["gram"]), 16, "0"), F.when(m["hot"], "01").otherwise("00"))
    null = -2**63
    marks = open_.select(F.coalesce("id", F.lit(null)).alias("id"), "uid", F.to_binary(F.array_join(F.transform("m", point), ""), F.lit("hex")).alias("marks"))
    kind = np.dtype([("first", ">u4"), ("strings", ">u4"), ("gram", ">i8"), ("hot", "u1")])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for i, (value, marks) in enumerate(zip(batch.column(2), batch.column(3))):
                data = value.as_py()
                for first, strings, gram, hot in np.frombuffer(marks.as_py(), kind).tolist():
                    if hot:
                        for p in range(first, first + strings):
                            string = data[p:p + SPAN]
                            out.append((int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "big", signed=True), i, p, string))
                    else:
                        out.append((gram, i, first, data[first:first + strings + SPAN - 1]))
                if len(out) > 20_000 or i == batch.num_rows - 1:
                    if out:
                        gram, who, first, text = zip(*out)
                        take = pa.array(who)
                        yield pa.RecordBatch.from_arrays([pa.array(gram, pa.int64()), batch.column(0).take(take), batch.column(1).take(take),
                                                          pa.array(first, pa.int32()), pa.array(text, pa.binary())], names=["gram", "id", "uid", "first", "text"])
                    out = []

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family()
        for batch in batches:
            for at in range(0, batch.num_rows, BATCH_STRETCHES):
                part = batch.slice(at, BATCH_STRETCHES)
                texts = [v.as_py() for v in part.column(3)]
                size = np.array([len(t) for t in texts])
                flat = np.frombuffer(b"".join(texts), np.uint8)
                strings, begin = size - SPAN + 1, np.cumsum(size) - size
                row = np.repeat(np.arange(len(texts)), strings)
                within = np.arange(len(row)) - np.repeat(np.cumsum(strings) - strings, strings)
                suffixes = np.lib.stride_tricks.sliding_window_view(flat, SPAN)[begin[row] + within]
                again = np.flatnonzero(family.add(np.ascontiguousarray(suffixes).view(f"S{SPAN}").ravel()))
                if not len(again):
                    continue
                new = np.concatenate([[True], (again[1:] != again[:-1] + 1) | (row[again[1:]] != row[again[:-1]])])
                ends = again[np.concatenate([np.flatnonzero(new)[1:], [len(again)]]) - 1]
                starts = again[new]
                base = part.column(2).to_numpy()[row[starts]]
                take = pa.array(row[starts])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(take), part.column(1).take(take), pa.array((base + within[starts]).astype(np.int32)),
                     pa.array((base + within[ends] + SPAN).astype(np.int32))], names=["id", "uid", "start", "end"])

    docs = source.select(F.coalesce("id", F.lit(null)).alias("id"), "uid", "text")
    parts = max(1, -(-stretches // TASK_STRETCHES))
    rows = marked(docs, marks, "inner").select("id", "uid", "text", "marks").mapInArrow(fetch, "gram long, id long, uid long, first int, text binary")
    last = F.col("id") == null
    rows = rows.repartition(parts, "gram").sortWithinPartitions(last, "id", "uid", "first")
    found = rows.select("id", "uid", "first", "text").mapInArrow(scan, "id long, uid long, start int, end int")
    return found.select(F.when(F.col("id") != null, F.col("id")).alias("id"), "uid", F.struct("start", "end").alias("s")).groupBy("id", "uid").agg(
        F.collect_list("s").alias("spans"))
