"""Best-fit packing of token pieces into sequences, certified by dual-feasible lower bounds."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepanel.llm.common import fresh, written
from tidepanel.llm.tokens import encoder

CAPACITY = 2048
#: Pieces of a group, about; a group is packed by one task.
GROUP_ROWS = 20_000
ROUNDS = 3
#: Characters encoded at a time.
BLOCK_CHARS = 1 << 19


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pieces(docs: DataFrame, key: str, text: str, tokenizer: str, capacity: int = CAPACITY, end: int = 0,
           with_ids: bool = False) -> DataFrame:
    """Encode whole texts, append id ``end`` and cut into pieces: ``key, piece, start, length, ids_crc32, uid``.

    ``tokenizer`` is a file's path on every machine. A document up to ``capacity`` ids is one piece; a longer one
    has full pieces, but for the first, which has what is over. Null and empty texts have the one id ``end``.
    ``uid`` tells rows apart, equal ones too: it counts the rows of a scan's task. ``with_ids`` adds the ids as
    little-endian unsigned 32-bit numbers. Keys may be null or repeated; other columns are left out.
    """
    last = np.asarray([end], "<u4").tobytes()
    names = ["key", "piece", "start", "length", "ids_crc32", "uid", *["ids"] * with_ids]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, uid = encoder(tokenizer), TaskContext.get().partitionId() << 40
        for batch in batches:
            keys, at = batch.column(0), 0
            while at < batch.num_rows:
                texts, chars = [], 0
                for value in batch.column(1).slice(at):
                    if texts and chars >= BLOCK_CHARS:
                        break
                    texts.append(value.as_py() or "")
                    chars += len(texts[-1])
                rows, whose = [], []
                for i, ids in enumerate(encoding.encode(texts), at):
                    ids += last
                    n, start, piece = len(ids) // 4, 0, 0
                    while start < n:
                        size = (n - start) % capacity or capacity
                        part = ids[4 * start:4 * (start + size)]
                        rows.append((piece, start, size, zlib.crc32(part), uid, *[part] * with_ids))
                        whose.append(i)
                        start, piece, uid = start + size, piece + 1, uid + 1
                at += len(texts)
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()))]
                yield pa.RecordBatch.from_arrays([keys.take(pa.array(whose)), *columns], names=names)

    source = docs.select(F.col(f"`{key}`").alias("key"), F.col(f"`{text}`").cast("string").alias("text"))
    kind = source.schema["key"].dataType.simpleString()
    schema = f"key {kind}, piece int, start long, length long, ids_crc32 long, uid long" + ", ids binary" * with_ids
    return source.mapInArrow(cut, schema)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing over sizes that fall already: the bin of each, and its offset there."""
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    stacks: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask, count = 0, 0  # bit r: some bin has r free
    for i, s in enumerate(sizes.tolist()):
        fits = mask >> s
        if fits:
            free = s + (fits & -fits).bit_length() - 1
            stack = stacks[free]
            b = stack.pop()
            if not stack:
                mask ^= 1 << free
        else:
            free, b = capacity, count
            count += 1
        bins[i], offsets[i] = b, capacity - free
        free -= s
        if free:
            stacks[free].append(b)
            mask |= 1 << free
    return bins, offsets


def lower_bound(sizes: np.ndarray, capacity: int) -> int:
    """The most bins that a family of dual-feasible functions proves to be needed; 0 for no sizes.

    Three families over the counts of sizes, in whole numbers: sizes with those above capacity - e raised to the
    capacity and those below e dropped; rounding by (k + 1)-ths; and the steps of e from the top for sizes over half.
    """
    if not len(sizes):
        return 0
    count = np.bincount(sizes, minlength=capacity + 1).astype(np.int64)
    s = np.arange(capacity + 1, dtype=np.int64)
    best = -(-int((count * s).sum()) // capacity)
    above, weight = np.cumsum(count[::-1])[::-1], np.cumsum((count * s)[::-1])[::-1]  # of sizes from s on
    for e in range(1, capacity // 2 + 1):
        large = int(above[capacity - e + 1])
        middle = int(weight[e] - weight[capacity - e + 1])
        best = max(best, large + -(-middle // capacity))
    for k in range(1, 65):
        exact = (k + 1) * s % capacity == 0
        value = np.where(exact, s * k, (k + 1) * s // capacity * capacity)
        best = max(best, -(-int((count * value).sum()) // (capacity * k)))
    used = np.flatnonzero(count)
    u, n = used.astype(np.int64), count[used]
    for e in range(1, capacity // 2 + 1):
        steps = capacity // e
        value = np.where(2 * u > capacity, 2 * (steps - (capacity - u) // e), np.where(2 * u == capacity, steps, 2 * (u // e)))
        best = max(best, -(-int((n * value).sum()) // (2 * steps)))
    return best


def pack(items: DataFrame, uid: str, length: str, capacity: int = CAPACITY, group_rows: int = GROUP_ROWS,
         rounds: int = ROUNDS) -> DataFrame:
    """Add ``sequence_id``, ``offset`` and ``certified`` to items of 1 to ``capacity`` tokens (else ValueError).

    Round 1 deals the items to groups by a hash of ``uid``, which must be unique: groups are even whatever else
    the rows hold, and their number follows the count of rows. Each group is packed best-fit decreasing and its
    bins are held against its lower bound. A group without gap is certified. Groups with a gap exchange the
    documents of their bins that aren't full: those are dealt anew and packed again, and what comes out
    is taken if it has fewer bins. Each round is written to the shared folder. ``certified`` says that the
    sequence's group needs no bin less. No rows give no rows. The driver sees only counts.
    """
    group, bin_, offset, fill, bins, bound = fresh(items, "_group", "_bin", "_offset", "_fill", "_bins", "_bound")
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema]
    schema = ", ".join([*fields, f"{group} long, {bin_} long, {offset} long, {fill} long, {bins} long, {bound} long"])
    columns = items.columns

    def fit(table: pa.Table) -> pa.Table:
        ids, sizes = table.column(uid).to_numpy(), table.column(length).to_numpy()
        if sizes.dtype.kind == "f" or (len(sizes) and not 1 <= sizes.min() <= sizes.max() <= capacity):
            raise ValueError(f"lengths must be from 1 to {capacity}")
        order = np.lexsort((ids, -sizes))
        placed, offsets = best_fit(sizes[order], capacity)
        full = np.bincount(placed, sizes[order]).astype(np.int64)
        out = table.select([*columns, group]).take(pa.array(order))
        n = len(order)
        for name, values in ((bin_, placed), (offset, offsets), (fill, full[placed]), (bins, np.full(n, len(full))),
                             (bound, np.full(n, lower_bound(sizes, capacity)))):
            out = out.append_column(name, pa.array(values, pa.int64()))
        return out

    def packed(rows: DataFrame, n: int, number: int) -> DataFrame:
        groups = max(1, -(-n // group_rows))
        dealt = rows.select(*[F.col(f"`{c}`") for c in columns],
                            F.pmod(F.xxhash64(F.col(f"`{uid}`"), F.lit(number)), F.lit(groups)).alias(group))
        return written(dealt.groupBy(group).applyInArrow(fit, schema), f"packed-{number}")

    def result(rows: DataFrame, number: int) -> DataFrame:
        return rows.select(
            *[F.col(f"`{c}`") for c in columns],
            (F.lit(number << 56) + F.col(group) * (1 << 24) + F.col(bin_)).cast("long").alias("sequence_id"),
            F.col(offset).cast("long").alias("offset"), (F.col(bins) == F.col(bound)).alias("certified"))

    current = packed(items, items.count(), 0)
    done, number = [], 0
    gap = F.col(bins) > F.col(bound)
    loose = gap & (F.col(fill) < capacity)
    while number + 1 < rounds:
        open_ = current.where(loose)
        n, before = open_.agg(F.count(F.lit(1)), F.count(F.when(F.col(offset) == 0, 1))).first()
        if not n:
            break
        again = packed(open_, n, number + 1)
        after = again.where(F.col(offset) == 0).count()
        if after >= before:
            break
        done.append(result(current.where(~loose), number))
        current, number = again, number + 1
    out = result(current, number)
    for part in done:
        out = out.unionByName(part)
    return out


def pack_documents(docs: DataFrame, key: str, text: str, tokenizer: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Encode, cut and pack: ``key, piece, start, length, ids_crc32, sequence_id, offset, certified``."""
    cut = written(pieces(docs, key, text, tokenizer or tokenizer_path(), capacity), "pieces")
    return pack(cut, "uid", "length", capacity).drop("uid")
