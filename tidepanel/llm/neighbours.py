"""Nearest neighbours by largest inner product: a forest of random-projection trees with one queue for all trees."""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepanel.llm.common import written

#: Vectors that the trees are fitted on, at most; all vectors are indexed.
SAMPLE = 16_384
TREES = 8
#: Indexed vectors for each task that queues queries, about.
VISIT_ROWS = 100_000
#: Vectors of a leaf, about, while the sample has LEAF_SAMPLE of its own for each leaf.
LEAF_ROWS, LEAF_SAMPLE = 1_000, 16
#: The recall that the number of visited leaves is set for, measured on the sample.
TARGET, PROBES = 0.97, 128


class Forest(NamedTuple):
    """Trees of one depth over vectors with one component more, which evens their norms out.

    Inner product among vectors of unequal norm is no distance; with sqrt(M^2 - |x|^2) as a further component all
    items have norm M and the largest inner product is the least angle. Node i goes to 2i+1 or 2i+2.
    """

    planes: np.ndarray  # trees x inner nodes x (dimension + 1)
    cuts: np.ndarray
    norm: float
    visits: int

    def wide(self, x: np.ndarray, item: bool) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.norm**2 - (x * x).sum(1), 0)) if item else np.zeros(len(x))
        return np.hstack([x, rest[:, None]])

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each item in each tree: trees x items."""
        x, inner = self.wide(x, True), self.cuts.shape[1]
        out = np.zeros((len(self.planes), len(x)), np.int64)
        for t, (planes, cuts) in enumerate(zip(self.planes, self.cuts)):
            node = np.zeros(len(x), np.int64)
            while inner and node[0] < inner:
                node = 2 * node + 1 + (np.einsum("ij,ij->i", planes[node], x) > cuts[node])
            out[t] = node - inner
        return out

    def margins(self, q: np.ndarray) -> np.ndarray:
        """Distance of each query from each plane: queries x trees x inner nodes."""
        trees, inner, wide = self.planes.shape
        return (self.wide(q, False) @ self.planes.reshape(-1, wide).T).reshape(len(q), trees, inner) - self.cuts

    def ordered(self, margins: np.ndarray) -> Iterator[tuple[int, int]]:
        """Leaves of all trees for one query, nearest first: by the largest margin crossed on the way."""
        inner = margins.shape[1]
        margins = margins.tolist()
        queue = [(0.0, t, 0) for t in range(len(margins))]
        while queue:
            crossed, t, node = heapq.heappop(queue)
            while node < inner:
                m = margins[t][node]
                heapq.heappush(queue, (max(crossed, abs(m)), t, 2 * node + 1 + (m <= 0)))
                node = 2 * node + 1 + (m > 0)
            yield t, node - inner


def grow(sample: np.ndarray, norm: float, depth: int, trees: int, k: int, seed: int = 11) -> Forest:
    """Split at the median along random directions; set the visits so that ``TARGET`` of the sample's own neighbours are found."""
    rng, inner = np.random.default_rng(seed), 2**depth - 1
    bare = Forest(np.zeros((trees, inner, sample.shape[1] + 1)), np.zeros((trees, inner)), norm, trees * 2**depth)
    if not depth:
        return bare._replace(visits=1)
    wide = bare.wide(sample, True)
    for t in range(trees):
        rows = {0: np.arange(len(wide))}
        for i in range(inner):
            d = rng.normal(size=wide.shape[1])
            along = wide[rows[i]] @ d / np.linalg.norm(d)
            cut = float(np.median(along)) if len(along) else 0.0
            bare.planes[t, i], bare.cuts[t, i] = d / np.linalg.norm(d), cut
            rows[2 * i + 1], rows[2 * i + 2], _ = rows[i][along <= cut], rows[i][along > cut], rows.pop(i)
    probes = sample[rng.permutation(len(sample))[:PROBES]]
    near = np.argsort(-(probes @ sample.T), axis=1)[:, :k + 1]
    leaf, ranks = bare.leaves(sample), []
    for own, margins in zip(near, bare.margins(probes)):
        place = np.empty((trees, 2**depth), np.int64)
        for n, (t, l) in enumerate(bare.ordered(margins)):
            place[t, l] = n
        ranks.append(place[np.arange(trees)[:, None], leaf[:, own]].min(0))
    needed = np.sort(np.concatenate(ranks))[min(math.ceil(TARGET * (k + 1) * len(probes)), (k + 1) * len(probes)) - 1]
    return bare._replace(visits=int(needed) + 1)


def usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrix(column: pa.Array) -> np.ndarray:
    """List arrays of one length as float64 rows."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def search(items: DataFrame, queries: DataFrame, key: str, vector: str, k: int, trees: int = TREES,
           sample: int = SAMPLE, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """The ``k`` nearest items of each query: ``query_id, rank`` (from 1), ``vec_id, score``; ties to the smaller id.

    Rows without id, and vectors that aren't ``usable`` or not of the commonest dimension (of equals the largest),
    take no part. An item with the query's id is the query's own and no candidate. An id with several vectors
    counts by its best. No items or no queries give no rows. Other columns are ignored.

    Equal vectors are one entry of the index with their k + 1 smallest ids; by the order of ties no other of them
    can be among the k nearest. Equal query vectors are searched once. Trees are fitted on ``sample`` vectors,
    every vector goes to its leaf in each tree, and each query is sent to the leaves that its queue names, so a
    task holds one leaf and the queries that visit it. Of the sample's vectors in the visited leaves, the
    (k + 1)-th best score bounds the query's from below, so a leaf returns nothing worse; and an item that the query
    meets in several trees is returned by the first. Scores are taken again in double precision, one pair at a time, so that they don't depend on
    where a pair meets.
    """
    spark = items.sparkSession
    rows = lambda df: df.select(
        F.col(f"`{key}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("vector")).where(
        F.col("id").isNotNull() & usable(F.col("vector")))
    result = "query_id long, rank int, vec_id long, score double"
    dimension = rows(items).groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    if dimension is None:
        return spark.createDataFrame([], result)
    d = dimension["d"]
    own = rows(items).where(F.size("vector") == d).distinct()
    smallest = Window.partitionBy("vector").orderBy("id")
    classes = own.withColumn("n", F.row_number().over(smallest)).where(F.col("n") <= k + 1).groupBy("vector").agg(
        F.array_sort(F.collect_list("id")).alias("ids"))
    classes = written(classes, "classes")
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x * x)
    n, norm = classes.agg(F.count(F.lit(1)), F.max(F.sqrt(square))).first()
    drawn = classes.select("vector", F.xxhash64(F.get("ids", F.lit(0))).alias("h")).orderBy("h").limit(sample).collect()
    points = np.array([r["vector"] for r in drawn])
    leaves = min(n / leaf_rows, len(points) / LEAF_SAMPLE)
    forest = grow(points, norm, max(0, round(math.log2(max(leaves, 1)))), trees if leaves >= 2 else 1, k)
    inner, drawn_leaves = forest.cuts.shape[1], forest.leaves(points)
    parts = max(1, round(n / 2 ** round(math.log2(forest.cuts.shape[1] + 1)) / (4 * leaf_rows)))

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                leaves = forest.leaves(matrix(b.column(0)))
                everywhere = pa.array(list(leaves.T.astype(np.int32)), pa.list_(pa.int32()))
                part = np.array([i[0] % parts for i in b.column(1).to_pylist()])
                for t, leaf in enumerate(leaves):
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(leaf), t, np.int32)), pa.array(leaf.astype(np.int32)), pa.array(part, pa.int32()), *b.columns,
                                                      everywhere], names=["tree", "leaf", "part", "vector", "ids", "leaves"])

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 256):
                some = b.slice(at, 256)
                q = matrix(some.column(0))
                scores, least = q @ points.T, np.full(len(q), -np.inf)
                visited = np.zeros((len(q), *forest.planes.shape[:1], inner + 1), bool)
                found = []
                for i, m in enumerate(forest.margins(q)):
                    for (t, leaf), _ in zip(forest.ordered(m), range(forest.visits)):
                        visited[i, t, leaf] = True
                        found += [(t, leaf, p, i) for p in range(parts)]
                    reached = scores[i, visited[i, np.arange(len(drawn_leaves))[:, None], drawn_leaves].any(0)]
                    if len(reached) > k:
                        least[i] = np.partition(reached, -(k + 1))[-(k + 1)]
                some = pa.RecordBatch.from_arrays([*some.columns, pa.array(least), pa.array([v.tobytes() for v in np.packbits(visited.reshape(len(q), -1), axis=1)], pa.binary())],
                                                  names=["vector", "query", "least", "visited"])
                t, leaf, p, i = (np.array(c, np.int32) for c in zip(*found))
                for cut in range(0, len(i), 8192):
                    s = slice(cut, cut + 8192)
                    yield pa.RecordBatch.from_arrays([pa.array(t[s]), pa.array(leaf[s]), pa.array(p[s]), *[c.take(pa.array(i[s])) for c in some.columns]],
                                                     names=["tree", "leaf", "part", "vector", "query", "least", "visited"])

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        found: list[tuple[int, int, float]] = []
        if left.num_rows and right.num_rows:
            x, q = matrix(left["vector"].combine_chunks()), matrix(right["vector"].combine_chunks())
            ids, asked = left["ids"].to_pylist(), right["query"].to_pylist()
            floor, tree = right["least"].to_numpy(), left["tree"][0].as_py()
            leaves = np.array(left["leaves"].to_pylist())[:, :tree]
            visited = np.unpackbits(np.frombuffer(b"".join(right["visited"].to_pylist()), np.uint8).reshape(len(q), -1), axis=1)
            visited = visited[:, :forest.planes.shape[0] * (inner + 1)].reshape(len(q), -1, inner + 1).astype(bool)
            for at in range(0, len(q), 512):
                rough = q[at:at + 512] @ x.T
                least = np.partition(rough, -min(k + 1, len(x)), axis=1)[:, -min(k + 1, len(x))]
                least = np.maximum(least, floor[at:at + 512])
                near, which = np.nonzero(rough >= (least - 1e-9 * (1 + np.abs(least)))[:, None])
                new = ~visited[(at + near)[:, None], np.arange(tree), leaves[which]].any(1)  # not met in a tree before
                near, which = near[new], which[new]
                exact = np.einsum("ij,ij->i", q[at + near], x[which])
                order = np.lexsort((-exact, near))
                near, which, exact = near[order], which[order], exact[order]
                for i, (b, e) in enumerate(zip(*(np.searchsorted(near, np.arange(len(rough)), s) for s in ("left", "right")))):
                    best = sorted((-s, v) for w, s in zip(which[b:e].tolist(), exact[b:e].tolist()) for v in ids[w])[:k + 1]
                    found += [(asked[at + i], v, -s) for s, v in best]
        query, vec, score = zip(*found) if found else ((), (), ())
        return pa.table({"query": pa.array(query, pa.int64()), "vec_id": pa.array(vec, pa.int64()), "score": pa.array(score, pa.float64())})

    asked = rows(queries).where(F.size("vector") == d).distinct()
    groups = asked.groupBy("vector").agg(F.min("id").alias("query"))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(n / VISIT_ROWS))
    groups = groups.repartition(tasks, "query")  # a number of its own: small rows, long work, so they must not be joined into few tasks
    stored = classes.select("vector", "ids").mapInArrow(index, "tree int, leaf int, part int, vector array<double>, ids array<long>, leaves array<int>")
    sent = groups.select("vector", "query").mapInArrow(visit, "tree int, leaf int, part int, vector array<double>, query long, least double, visited binary")
    place = ["tree", "leaf", "part"]
    met = stored.groupBy(*place).cogroup(sent.groupBy(*place)).applyInArrow(nearest, "query long, vec_id long, score double")
    best = met.groupBy("query", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = best.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1).drop("n")
    pairs = asked.join(groups, "vector").select(F.col("id").alias("query_id"), "query").join(best, "query")
    final = pairs.where(F.col("query_id") != F.col("vec_id")).groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return final.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
