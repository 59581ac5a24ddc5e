"""Sharding by a hierarchical weighted hash tree.

Shards are leaves of racks, racks are children of regions. A row descends region, rack and shard levels; at each node
every child draws a hashed exponential waiting time whose rate is the child's weight, and the shortest time wins, so a
child wins in proportion to its weight. A draw depends on the row's key, the node and the node's weight alone: when the
weight of a shard changes, rows move only into or out of the subtrees on its path.

Regions have a fixed number of places. A place without a shard (a new region has some) holds weight 1 in reserve, but
never wins: waiting times of losing children are the winner's time plus their own lag, which is again exponential, so a
region with empty places waits for the first of its shards. Hence a shard that fills the next empty place takes rows
only into itself, and rows of a shard that leaves go to others without any other row moving.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm import numbering
from gramline.llm.arrays import mix64, uniform

RACKS = 3
SHARDS_PER_RACK = 4
_NULL_KEY = 0x6E756C6C


class ShardTree:
    """`weights[i]` is the weight of shard i; None or 0 marks a place whose shard has left."""

    def __init__(self, weights, racks: int = RACKS, shards_per_rack: int = SHARDS_PER_RACK):
        if not any(weights):
            raise ValueError("a tree needs a shard with a weight")
        places = racks * shards_per_rack
        self.n_regions = -(-len(weights) // places)
        full = np.ones(self.n_regions * places)
        self.active = np.zeros(self.n_regions * places, bool)
        for i, w in enumerate(weights):
            if w:
                full[i], self.active[i] = w, True
        self.leaf = full.reshape(self.n_regions, racks, shards_per_rack)
        self.active = self.active.reshape(self.leaf.shape)

    @staticmethod
    def _wait(keys: np.ndarray, level: int, node: int, weight: float) -> np.ndarray:
        salt = mix64(np.array([level * 0x100000000 + node + 1], np.uint64))
        return -np.log(uniform(mix64(keys ^ salt))) / weight

    def _children(self, keys, level: int, first: int, weights) -> np.ndarray:
        return np.stack([self._wait(keys, level, first + i, w) for i, w in enumerate(weights)], axis=1)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The shard of each key."""
        _, racks, leaves = self.leaf.shape
        keys = mix64(keys)
        times = self._children(keys, 1, 0, self.leaf.sum((1, 2)))
        partial = {}
        for r in np.flatnonzero(~self.active.all((1, 2))):
            lag = self._children(keys, 2, r * racks, self.leaf[r].sum(1))
            lag -= lag.min(1, keepdims=True)
            waits = []
            for k in range(racks):
                own = self._children(keys, 3, (r * racks + k) * leaves, self.leaf[r, k])
                waits.append(lag[:, k, None] + own - own.min(1, keepdims=True))
            waits = np.where(self.active[r].reshape(-1), np.concatenate(waits, axis=1), np.inf)
            partial[r] = waits.argmin(1)
            times[:, r] += waits.min(1)
        region = times.argmin(1)
        out = np.empty(len(keys), np.int64)
        for r in range(self.n_regions):
            here = np.flatnonzero(region == r)
            if r in partial:
                out[here] = r * racks * leaves + partial[r][here]
                continue
            rack = self._children(keys[here], 2, r * racks, self.leaf[r].sum(1)).argmin(1)
            for k in range(racks):
                inside = here[rack == k]
                first = (r * racks + k) * leaves
                out[inside] = first + self._children(keys[inside], 3, first, self.leaf[r, k]).argmin(1)
        return out


def _keys(column) -> np.ndarray:
    ids = column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
    return np.where(column.is_null().to_numpy(zero_copy_only=False), np.uint64(_NULL_KEY), mix64(ids))


def assign(docs: DataFrame, weights, grown=None, key: str = "doc_id") -> DataFrame:
    """`docs` with `shard`, `grown_shard` (its shard under the weights `grown`, else null) and `slot`, the row's place
    in its shard, counted from 0 without gaps.

    `key` is a whole-number column. Rows with equal keys share a shard, null keys share one too; columns of `docs` with
    the names of added ones are replaced. An empty table gives an empty table. Nothing is shuffled but one count per
    partition and shard.
    """
    tree, later = ShardTree(weights), ShardTree(grown) if grown else None
    added = T.StructType([T.StructField("shard", T.IntegerType()), T.StructField("grown_shard", T.IntegerType())])
    names = {*added.names, "slot", numbering.PART, numbering.ROW, numbering.START}
    rows = docs.drop(*names)

    def compute(batch):
        keys = _keys(batch.column(batch.schema.get_field_index(key)))
        shard = tree.place(keys).astype(np.int32)
        return shard, (later.place(keys) if later else np.full(len(keys), -1)).astype(np.int32)

    numbered = numbering.placed(rows, added, compute, "shard", None, "shards")
    return numbered.select(
        *rows.columns, "shard", F.when(F.col("grown_shard") >= 0, F.col("grown_shard")).alias("grown_shard"),
        F.col(numbering.START).alias("slot"),
    )
