"""Exact top-k search by inner product with a KD-tree per shard.

Vectors are dealt evenly to shards of bounded size, and each task builds the tree of its shard: splits at the median of
the widest dimension, and for every node the tight box around its vectors. A query's score cannot exceed the box's
bound, the sum of max(q*lo, q*hi) over the dimensions. Nodes are visited best bound first until none can reach the
query's k-th score. A first search in one shard gives a k-th score to start from, which is passed to all shards.
Queries go to the shards in blocks of bounded size.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramline.plans.storage import written

K = 5
SCALE = 256
SHARD_ROWS = 8192
LEAF_ROWS = 512
BLOCK_QUERIES = 16_384
_FOUND = "query_id long, vec_id long, score long"


class KDTree:
    """Median splits with tight boxes over integer vectors. `ids` break ties, the smaller first."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.nodes: list[tuple[int, int, int, int]] = []  # first row, last row, left child, right child
        self.lo, self.hi = [], []
        order = np.arange(len(ids))
        self._split(order, vectors, 0, len(ids), leaf_rows)
        self.ids, self.vectors = ids[order], vectors[order]
        self.lo, self.hi = np.array(self.lo, float), np.array(self.hi, float)

    def _split(self, order, vectors, first: int, last: int, leaf_rows: int) -> int:
        own = vectors[order[first:last]]
        lo, hi = own.min(0), own.max(0)
        me = len(self.nodes)
        self.nodes.append((first, last, -1, -1))
        self.lo.append(lo)
        self.hi.append(hi)
        if last - first > leaf_rows and (hi > lo).any():
            middle = (last - first) // 2
            order[first:last] = order[first:last][np.argpartition(own[:, int(np.argmax(hi - lo))], middle)]
            left = self._split(order, vectors, first, first + middle, leaf_rows)
            right = self._split(order, vectors, first + middle, last, leaf_rows)
            self.nodes[me] = (first, last, left, right)
        return me

    def search(self, query_ids, queries, k: int, least) -> list[tuple[int, int, int]]:
        """(query_id, vec_id, score) of the best k rows of each query that reach its `least` score."""
        exact = _fits(self.vectors, queries)
        kind = float if exact else object
        up, down = np.maximum(queries, 0).astype(kind), np.minimum(queries, 0).astype(kind)
        bounds = up @ self.hi.astype(kind).T + down @ self.lo.astype(kind).T
        vectors = self.vectors.astype(kind)
        out = []
        for i, own in enumerate(query_ids):
            best: list[tuple] = []  # a heap of (score, -vec_id): its first is the k-th
            floor, waiting = least[i], [(-bounds[i, 0], 0)]
            while waiting:
                bound, node = heapq.heappop(waiting)
                if -bound < (max(floor, best[0][0]) if len(best) == k else floor):
                    break
                first, last, left, right = self.nodes[node]
                if left >= 0:
                    heapq.heappush(waiting, (-bounds[i, left], left))
                    heapq.heappush(waiting, (-bounds[i, right], right))
                    continue
                scores = vectors[first:last] @ queries[i].astype(kind)
                bar = max(floor, best[0][0]) if len(best) == k else floor
                for j in np.flatnonzero((scores >= bar) & (self.ids[first:last] != own)):
                    entry = (int(scores[j]), -int(self.ids[first + j]))
                    if len(best) < k:
                        heapq.heappush(best, entry)
                    elif entry > best[0]:
                        heapq.heapreplace(best, entry)
            out += [(int(own), -minus_id, score) for score, minus_id in best]
        return out


def _fits(vectors: np.ndarray, queries: np.ndarray) -> bool:
    """Whether all sums are whole numbers that doubles hold exactly."""
    most = lambda x: float(np.abs(x).max(initial=0))
    return most(vectors) * most(queries) * max(1, vectors.shape[1]) < 2**52


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """(vec_id, embedding of whole numbers): floor(256 x) of each component x as a double. Vectors without an id, null, empty or
    with a component that is null or not finite are left out."""
    parts = F.col(column).cast("array<double>")
    wrong = F.exists(parts, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    usable = vectors.select(F.col(id_column).cast("long").alias("vec_id"), parts.alias("embedding"), wrong.alias("wrong"))
    usable = usable.filter("vec_id IS NOT NULL AND embedding IS NOT NULL AND size(embedding) > 0 AND NOT wrong")
    return usable.select("vec_id", F.transform("embedding", lambda x: F.floor(x * SCALE).cast("long")).alias("embedding"))


def top_k(vectors: DataFrame, is_query, k: int = K, shard_rows: int = SHARD_ROWS, block_queries: int = BLOCK_QUERIES) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query, a row of `vectors` for which `is_query` holds, the k best other
    rows by inner product, ties to the smaller id; all, if there are fewer.

    `vectors` is (vec_id, embedding array<long>), as `quantised` gives it. A query's own are the rows with its id. Rows
    that repeat an id count each; queries that repeat one with the same vector are asked once. Only vectors of the same
    length are compared. An empty table gives an empty table.
    """
    spark = vectors.sparkSession
    rows = written(vectors.select("vec_id", "embedding").withColumn("n_dims", F.size("embedding")), "vectors")
    counts = {r["n_dims"]: r["count"] for r in rows.groupBy("n_dims").count().collect()}
    n_shards = {d: -(-n // shard_rows) for d, n in counts.items()}
    queries = written(
        rows.filter(is_query).dropDuplicates().withColumn("block", F.lit(0)).withColumn("at", F.monotonically_increasing_id()),
        "queries",
    )
    found = []
    for dims, shards in n_shards.items():
        shard = F.pmod(F.monotonically_increasing_id(), F.lit(shards)).cast("int")
        own = written(rows.filter(F.col("n_dims") == dims).select("vec_id", "embedding", shard.alias("shard")), "vector-shards")
        asked = queries.filter(F.col("n_dims") == dims)
        n_blocks = max(1, -(-asked.count() // block_queries))
        for block in range(n_blocks):
            picked = asked.filter(F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks)) == block).select("vec_id", "embedding").toPandas()
            if len(picked):
                found += _search_block(spark, own, picked, shards, k)
    if not found:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    hits = found[0]
    for more in found[1:]:
        hits = hits.unionByName(more)
    best = F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))), 1, k)
    ranked = hits.groupBy("query_id").agg(best.alias("best")).select("query_id", F.posexplode("best").alias("at", "hit"))
    return ranked.select(
        "query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.minus")).alias("score"),
    )


def _search_block(spark, shards: DataFrame, picked: pd.DataFrame, n_shards: int, k: int) -> list[DataFrame]:
    """First one shard alone, then the others with the k-th scores that it gave."""
    matrix = np.stack(picked["embedding"].to_numpy()).astype(np.int64)
    ids = picked["vec_id"].to_numpy(np.int64)
    least = np.full(len(ids), -np.inf)

    def run(part: DataFrame, name: str) -> DataFrame:
        shared = spark.sparkContext.broadcast((ids, matrix, least.copy()))

        def search(frame: pd.DataFrame) -> pd.DataFrame:
            own_ids, own_queries, floors = shared.value
            tree = KDTree(frame["vec_id"].to_numpy(np.int64), np.stack(frame["embedding"].to_numpy()).astype(np.int64))
            return pd.DataFrame(tree.search(own_ids, own_queries, k, floors), columns=["query_id", "vec_id", "score"])

        return written(part.groupBy("shard").applyInPandas(search, _FOUND), name)

    first = run(shards.filter("shard = 0"), "hits")
    if n_shards == 1:
        return [first]
    kth = first.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("kth")).filter(F.col("n") >= k)
    known = {r["query_id"]: r["kth"] for r in kth.collect()}
    least[:] = [known.get(int(i), -np.inf) for i in ids]
    return [first, run(shards.filter("shard > 0"), "hits")]
