"""Exact top-k by inner product with KD-trees.

Candidates are dealt into shards by a hash. Each shard becomes a KD-tree: median splits along
the widest dimension down to leaves, every node with the tight box of its points. For a query
q no point of a box [lo, hi] scores above sum(max(q_i lo_i, q_i hi_i)); nodes are visited
best bound first, and a node is left out once its bound can no longer enter the query's best
k. The k-th score is propagated: a first pass over a small seed of candidates gives each query
a k-th score that every shard starts from, and it tightens as leaves are scored.

Scores are sums of integer products, so they are exact, and ties go to the smaller id. A node
also keeps its smallest id, so equal vectors (however many) are passed over at once when their
ids cannot win a tie.

Shards hold about ``shard_rows`` rows, and there are at least as many as cores. The queries
are copied to each shard and stream past its tree in blocks; neither side is broadcast. Only
the seed (``seed_rows`` vectors) is.

Defined cases: vectors that are null or hold a null or a non-finite component take no part, nor
do rows without an id. Vectors of different lengths have no product: each length is searched
among its own (shards of the most common length apart from those of all others, which have a
tree for each length). Where a score could pass 2^53, products are taken in whole numbers of
63 bits, or of any size where it could pass those; a score of the result, or a component, that
does not fit in 63 bits is an error. A query is not a candidate of its own: rows with its id are left out. Of several query rows with one id the
smallest vector counts. Repeated candidate rows each take a rank. Fewer candidates than k:
all of them. Empty tables give empty results. Other columns are not touched.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

LEAF = 128
#: Stands for no k-th score yet.
LEAST = -(1 << 63)


def quantised(vector: Column, factor: float) -> Column:
    """floor(factor * x) of each component, null unless all are finite numbers."""
    cells = F.transform(vector, lambda x: F.floor(x.cast("double") * factor).cast("long"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == F.lit(float("inf"))))
    return F.when(vector.isNotNull() & ~F.coalesce(bad, F.lit(True)), cells)


class KDTree:
    """Over integer points (rows) with ids; nodes are arrays, children 2i + 1 and 2i + 2.
    ``kind`` is the number type in which all products are exact."""

    def __init__(self, points: np.ndarray, ids: np.ndarray, leaf: int = LEAF, kind: type = np.float64):
        order = np.arange(len(ids))
        self.lo, self.hi, self.least, self.span = {}, {}, {}, {}
        todo = [(0, 0, len(ids))]
        while todo:
            node, a, b = todo.pop()
            own = points[order[a:b]]
            lo, hi = own.min(0), own.max(0)
            self.lo[node], self.hi[node], self.least[node] = lo, hi, int(ids[order[a:b]].min())
            if b - a > leaf:
                by, mid = int(np.argmax(hi - lo)), (b - a) // 2
                # equal points are parted by id, so that a side's smallest id tells something
                key = own[:, by] if (hi > lo).any() else ids[order[a:b]]
                order[a:b] = order[a:b][np.argpartition(key, mid)]
                todo += [(2 * node + 1, a, a + mid), (2 * node + 2, a + mid, b)]
            else:
                self.span[node] = (a, b)
        self.points, self.ids = points[order].astype(kind), ids[order]
        self.nodes = sorted(self.lo)
        self.row = {n: i for i, n in enumerate(self.nodes)}
        self.box_lo = np.array([self.lo[n] for n in self.nodes]).astype(kind)
        self.box_hi = np.array([self.hi[n] for n in self.nodes]).astype(kind)

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The best score that any point of each node's box can have, per query."""
        return np.maximum(queries, 0) @ self.box_hi.T + np.minimum(queries, 0) @ self.box_lo.T

    def search(self, query: np.ndarray, bound: np.ndarray, own: int, k: int, kth: tuple[int, int]) -> tuple[list[tuple[int, int]], int]:
        """The best (score, -id) that reach ``kth``, and the number of leaves scored."""
        best: list[tuple[int, int]] = []
        heap, scored = [(-bound[0], 0)], 0
        while heap:
            top, node = heapq.heappop(heap)
            least = best[0] if len(best) == k else kth
            if -top < least[0]:
                break
            if (int(-top), -self.least[node]) < least:
                continue
            if node not in self.span:
                for child in (2 * node + 1, 2 * node + 2):
                    b = bound[self.row[child]]
                    if b >= least[0]:
                        heapq.heappush(heap, (-b, child))
                continue
            a, b = self.span[node]
            scored += 1
            score = self.points[a:b] @ query
            for i in np.flatnonzero(score >= least[0]).tolist():
                got = (int(score[i]), -int(self.ids[a + i]))
                if self.ids[a + i] != own and got >= kth:
                    if len(best) < k:
                        heapq.heappush(best, got)
                    elif got > best[0]:
                        heapq.heapreplace(best, got)
        return best, scored


def _vectors(column: pa.Array, rows: np.ndarray) -> np.ndarray:
    """These rows, all of one length, of a column of vectors."""
    ends = column.offsets.to_numpy()
    if not len(rows):
        return np.zeros((0, 0), np.int64)
    dim = int(ends[rows[0] + 1] - ends[rows[0]])
    return column.values.to_numpy(zero_copy_only=False)[ends[rows][:, None] + np.arange(dim)].astype(np.int64)


def exact_kind(dim: int, largest: int) -> type:
    """The number type that holds every sum of ``dim`` products of components up to ``largest``."""
    most = dim * largest**2
    return np.float64 if most < 1 << 53 else np.int64 if most < 1 << 63 else object


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 5,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    factor: float = 256.0,
    shard_rows: int = 1 << 16,
    seed_rows: int = 1 << 10,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best candidates of each query among all rows."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), is_query.alias("q"), quantised(F.col(vector_col), factor).alias("v"))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull())
    rows = rows.where(F.size("v") > 0)
    dims = rows.groupBy(F.size("v").alias("dim")).agg(F.count("*").alias("count")).orderBy(F.desc("count"), "dim").first()
    out = "query_id long, rank int, vec_id long, score long"
    if dims is None:
        return spark.createDataFrame([], out)
    n, wide, low, high = rows.agg(F.count("*"), F.max(F.size("v")), F.min(F.array_min("v")), F.max(F.array_max("v"))).first()
    largest = max(abs(low), abs(high))
    if largest >= 1 << 62:
        raise ValueError("a component does not fit in 62 bits")
    dim, kind = dims["dim"], exact_kind(wide, largest)
    common, others = dims["count"], n - dims["count"]
    shards = max(-(-common // shard_rows), spark.sparkContext.defaultParallelism)
    more = -(-others // shard_rows)
    usual = F.size("v") == dim
    seed = rows.where(usual).orderBy(F.xxhash64(F.lit("seed"), "id"), "id", "v").limit(seed_rows).select("id", "v").collect()
    seed_ids, seed_v = np.array([r["id"] for r in seed]), np.array([r["v"] for r in seed]).astype(kind)

    def first_kth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column(0).to_numpy()
            kth = np.full(len(ids), LEAST)
            own = np.flatnonzero(np.diff(b.column(1).offsets.to_numpy()) == dim)
            for j, row in zip(own.tolist(), _vectors(b.column(1), own).astype(kind) @ seed_v.T if len(own) else ()):
                score = np.sort(row[seed_ids != ids[j]])
                if len(score) >= k:
                    kth[j] = max(min(int(score[-k]), (1 << 63) - 1), LEAST)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(kth, pa.int64())], ["id", "v", "kth"])

    queries = rows.where("q").groupBy("id").agg(F.min("v").alias("v")).mapInArrow(first_kth, "id long, v array<bigint>, kth long")
    places = F.when(usual, F.sequence(F.lit(0), F.lit(shards - 1)))
    places = places.otherwise(F.sequence(F.lit(shards), F.lit(shards + more - 1))) if more else places
    every = queries.withColumn("shard", F.explode(places))
    by = F.xxhash64("id", "v")
    shard = F.when(usual, F.pmod(by, F.lit(shards))).otherwise(F.pmod(by, F.lit(max(more, 1))) + shards)
    dealt = rows.select(shard.cast("int").alias("shard"), F.lit(None).cast("long").alias("kth"), "id", "v")
    # a hot vector with a hot id would be one row per copy; rows of one vector but many ids spread
    both = dealt.unionAll(every.select("shard", "kth", "id", "v")).repartition("shard").sortWithinPartitions("shard", F.size("v"), F.col("kth").asc_nulls_first())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, tree = None, [], None
        for b in batches:
            shard, ids, size = b.column(0).to_numpy(), b.column(2).to_numpy(), np.diff(b.column(3).offsets.to_numpy())
            is_point = b.column(1).is_null().to_numpy(zero_copy_only=False)
            kth = b.column(1).fill_null(0).to_numpy()
            found = []
            cuts = np.flatnonzero((shard[1:] != shard[:-1]) | (size[1:] != size[:-1]) | (is_point[1:] != is_point[:-1])) + 1
            for part in np.split(np.arange(len(ids)), cuts):
                if not len(part):
                    continue
                if (shard[part[0]], size[part[0]]) != now:
                    now, held, tree = (shard[part[0]], size[part[0]]), [], None
                if is_point[part[0]]:
                    held.append((_vectors(b.column(3), part), ids[part]))
                    continue
                if tree is None and held:
                    tree, held = KDTree(np.concatenate([h[0] for h in held]), np.concatenate([h[1] for h in held]), kind=kind), []
                for some in np.array_split(part, -(-len(part) // 256)) if tree else []:
                    q = _vectors(b.column(3), some).astype(kind)
                    for j, bound in enumerate(tree.bounds(q)):
                        start = -math.inf if kth[some[j]] == LEAST else int(kth[some[j]])
                        best, _ = tree.search(q[j], bound, int(ids[some[j]]), k, (start, LEAST))
                        found += [(int(ids[some[j]]), -i, s) for s, i in best]
            cols = list(zip(*found)) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["query_id", "vec_id", "score"])

    found = both.mapInArrow(search, "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank.cast("int")).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
