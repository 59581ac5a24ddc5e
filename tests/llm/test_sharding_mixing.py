import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from brute import words
from gramline.llm import mixing, shard_tree
from gramline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_tree_takes_rows_only_into_new_shards():
    keys = np.arange(30_000, dtype=np.uint64)
    before = shard_tree.ShardTree([1.0]).place(keys)
    for n in range(2, 40):
        now = shard_tree.ShardTree([1.0] * n).place(keys)
        assert set(now[now != before]) <= {n - 1}
        before = now
    counts = np.bincount(before)
    assert counts.min() > 0.8 * counts.mean() and counts.max() < 1.2 * counts.mean()


def test_weights_and_confined_movement():
    keys = np.arange(60_000, dtype=np.uint64)
    weights = [1.0] * 24
    before = shard_tree.ShardTree(weights).place(keys)
    heavy = weights[:5] + [3.0] + weights[6:]
    after = shard_tree.ShardTree(heavy).place(keys)
    moved = before != after
    assert set(after[moved] // 12) == {0}  # rows move into the region of the shard alone
    assert set(after[moved & (before // 12 == 0)] // 4) == {1}  # inside it only into its rack
    assert set(after[moved & (before // 4 == 1)]) == {5}  # and inside that only into the shard
    assert np.isclose((after == 5).mean(), 3 / 26, rtol=0.1)
    gone = [1.0] * 7 + [None] + [1.0] * 16
    left = shard_tree.ShardTree(gone).place(keys)
    assert 7 not in left and (left[before != 7] == before[before != 7]).all()
    with pytest.raises(ValueError):
        shard_tree.ShardTree([0, None])


def test_query_keeps_its_law(spark):
    rows = QUERIES["op7_shard_tree"](spark, SF).collect()
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    slots = defaultdict(list)
    for r in rows:
        data = texts[r["doc_id"]].encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 8, zlib.crc32(data))
        assert r["grown_shard"] in (r["shard"], 24) and 0 <= r["shard"] < 24
        slots[r["shard"]].append(r["slot"])
    assert len(rows) == len(texts) and all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_assign_edge_cases(spark):
    rows = [(1, None, 5), (1, "a", 6), (None, "b", 7), (None, None, 8), (-3, "", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, slot int")
    got = shard_tree.assign(docs, [1.0, 2.0, 1.0]).collect()
    by_id = defaultdict(set)
    for r in got:
        by_id[r["doc_id"]].add(r["shard"])
        assert r["grown_shard"] is None
    assert len(got) == 5 and all(len(s) == 1 for s in by_id.values())
    assert Counter((r["shard"], r["slot"]) for r in got).most_common(1)[0][1] == 1
    assert shard_tree.assign(docs.limit(0), [1.0]).count() == 0


def test_targets():
    assert mixing.targets([100, 100, 100], [5, 2, 1], 450).tolist() == [200, 500 / 3, 250 / 3]
    assert mixing.targets([10, 0, 50], [1, 5, 1], 90).tolist() == [20, 0, 70]
    assert mixing.targets([], [], 0).tolist() == []


def test_permutation_is_one():
    for size in (1, 2, 3, 64, 1000):
        assert sorted(mixing.permuted(np.arange(size), size, 5).tolist()) == list(range(size))


def test_mix_meets_targets(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = QUERIES["op9_mixing"](spark, SF).collect()
    source = {r["doc_id"]: (r["source"], len(words(r["text"]))) for r in docs.collect()}
    total = defaultdict(int)
    for i, (s, n) in source.items():
        total[s] += n
    order = sorted(total, key=lambda s: (s is None, s or ""))
    goals = dict(zip(order, mixing.targets([total[s] for s in order], [(5, 2, 1)[i % 3] for i in range(len(order))], 1.5 * sum(total.values()))))
    taken = defaultdict(int)
    for r in rows:
        s, n = source[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (n, total[s]) and r["taken"] <= 2 * n
        assert abs(r["target"] - goals[s]) < 1e-6
        taken[s] += r["taken"]
    assert len(rows) == len(source)
    assert all(abs(taken[s] - goals[s]) <= 2 * mixing.BLOCK_WORDS for s in order)
    again = {r["doc_id"]: r["taken"] for r in QUERIES["op9_mixing"](spark, SF).collect()}
    assert again == {r["doc_id"]: r["taken"] for r in rows}


def test_mix_edge_cases(spark):
    rows = [(1, "a b  c", None), (1, "a b  c", None), (None, None, "s"), (2, "", "s"), (3, "\n x y", ""), (4, "z " * 500, "t")]
    names = ["size", "target", "source_size", "source_no", "named", "part_id", "part_row", "group_start", "held", "spans", "block"]
    extra = [F.concat(F.lit(n), F.coalesce(F.col("doc_id"), F.lit(0)).cast("string")).alias(n) for n in names]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").select("*", *extra)
    mix = mixing.Mix(docs, block_words=4, shard_words=100, keep=True)
    got = mix.taken().collect()
    assert len(got) == 6 and all(r["taken"] <= 2 * r["size"] for r in got)
    out = mix.documents().collect()
    assert sum(len(words(r["text"])) for r in out) == sum(r["taken"] for r in got)
    assert mix.documents().columns == docs.columns and out
    assert all(r[n] == f"{n}{r['doc_id'] or 0}" for r in out for n in names)
    assert all(r["text"] in rows[[x[0] for x in rows].index(r["doc_id"])][1] for r in out if r["doc_id"] != 4)
    assert mixing.Mix(docs.limit(0)).taken().count() == 0


def test_slots_are_not_broadcast(spark):
    """At sizes Spark itself would broadcast, the slots still go through a shuffle."""
    pieces = mixing.Mix(spark.read.parquet(f"{SF}/documents.parquet")).pieces()
    pieces.collect()
    plan = pieces._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "MapInPandas" not in plan
