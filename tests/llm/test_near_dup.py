import random

import pytest
from brute import near_duplicates as plain
from pyspark.sql import functions as F

from gramline.llm import graph, near_dup

SF = "/root/testdata/sf0.001"


def _found(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def test_same_as_brute_force_on_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert _found(near_dup.near_duplicates(docs)) == {i: (n, c, i == c) for i, (n, c) in expected.items()}


@pytest.mark.parametrize("block", [1000, 7])
def test_chains_and_group_of_variants(spark, monkeypatch, block):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", block)
    monkeypatch.setattr(near_dup, "SALT_PAIRS", block)
    rng = random.Random(4)
    base = [f"w{i}" for i in range(120)]
    rows = []
    for i in range(60):  # variants of one text, near the bound, so that links form chains
        own = list(base)
        for _ in range(rng.randint(0, 5)):
            own[rng.randrange(120)] = f"x{rng.random()}"
        rows.append((i, " ".join(own)))
    rows += [(100 + i, " ".join(f"v{rng.random()}" for _ in range(50))) for i in range(20)]
    expected = plain(rows)
    found = _found(near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")))
    assert found == {i: (n, c, i == c) for i, (n, c) in expected.items()}


def test_units_grow_in_proportion(spark):
    """Near copies beside ten strays: a row for each copy. All open pairs of a bucket meet in exactly one unit."""
    for m in (2000, 8000, 32000):
        placed = spark.range(m + 10).select(
            F.lit(1).cast("long").alias("band"), F.col("id").cast("string").cast("binary").alias("words_key"),
            F.lit(50).cast("long").alias("n_shingles"), F.when(F.col("id") < m, "main").otherwise(F.col("id").cast("string")).cast("binary").alias("root"),
        )
        assert near_dup._units(placed).count() <= 1.02 * m + 40


def test_open_pairs_meet_once(spark, monkeypatch):
    monkeypatch.setattr(near_dup, "BLOCK_MEMBERS", 4)
    rng = random.Random(2)
    rows = [(rng.randrange(3), str(i).encode(), 5, b"abc"[(r := min(2, rng.randrange(5))) : r + 1]) for i in range(60)]
    units = {}
    for r in near_dup._units(spark.createDataFrame(rows, "band long, words_key binary, n_shingles long, root binary")).collect():
        units.setdefault((r["band"], r["low"], r["high"]), []).append((r["own"], bytes(r["words_key"]), bytes(r["root"])))
    met = {}
    for (band, low, high), members in units.items():
        for x in members:
            for y in members:
                if x[2] < y[2] and (low == high or x[0] != y[0]):
                    met[band, x[1], y[1]] = met.get((band, x[1], y[1]), 0) + 1
    assert met == {(b, x, y): 1 for b, x, _, p in rows for c, y, _, q in rows if b == c and p < q}


def test_edge_cases(spark):
    rows = [
        (7, "One two  THREE four five", "x"), (3, "one two three four\nfive", None), (9, None, "x"), (8, "", "x"), (5, " \n\t", "x"),
        (2, "short", "x"), (4, "SHORT", "x"), (None, "short", None), (None, "alone in here", "x"), (2, "short", "x"), (6, "a b", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bands string")
    got = sorted((r["doc_id"] or -1, r["n_shingles"], r["component_id"] or -1, r["kept"]) for r in near_dup.near_duplicates(docs).collect())
    assert got == sorted([
        (7, 2, 3, False), (3, 2, 3, True), (9, 0, 9, True), (8, 0, 8, True), (5, 0, 5, True), (2, 1, 2, True), (4, 1, 2, False),
        (-1, 1, 2, False), (-1, 1, -1, True), (2, 1, 2, True), (6, 1, 6, True),
    ])
    assert near_dup.near_duplicates(docs.limit(0)).count() == 0


def test_long_chain_of_links(spark):
    edges = spark.range(200).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {r["root"] for r in graph.components(edges, "a", "b").collect()} == {0}


def test_further_links_join_components(spark):
    roots = spark.createDataFrame([(1, 1), (2, 1), (5, 5), (6, 5), (8, 8), (9, 8)], "node int, root int")
    more = spark.createDataFrame([(2, 6), (7, 6), (3, 4)], "a int, b int")
    got = near_dup._merged(roots, more)
    assert sorted(map(tuple, got.collect())) == [(1, 1), (2, 1), (3, 3), (4, 3), (5, 1), (6, 1), (7, 1), (8, 8), (9, 8)]
