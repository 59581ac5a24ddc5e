import numpy as np

from gramline.llm import nearest, token_files
from gramline.llm.queries import QUERIES
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"


def _plain(rows, queries, k):
    out = set()
    for q, v in queries:
        best = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out |= {(q, r + 1, i, -s) for r, (s, i) in enumerate(best)}
    return out


def _got(df):
    return {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in df.collect()}


def test_search_in_many_shards_and_blocks(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.integers(-9, 9, 3).tolist()) for i in range(700)] + [(1000 + i, [4, 4, 4]) for i in range(60)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<long>")
    got = _got(nearest.top_k(df, F.col("vec_id") % 50 == 0, shard_rows=100, block_queries=5))
    assert got == _plain(rows, [r for r in rows if r[0] % 50 == 0], 5)


def test_search_edge_cases(spark):
    big = float(2**31)
    raw = [(0, [1.0, 2.0]), (1, [1.0, None]), (2, None), (3, [float("nan"), 1.0]), (4, []), (50, [0.5, -0.001]), (None, [1.0, 1.0]),
           (6, [3.0]), (100, [7.0]), (7, [big, big]), (8, [1.0, 2.0]), (8, [1.0, 2.0]), (9, [float("inf"), 1.0])]
    df = nearest.quantised(spark.createDataFrame([(*r, 1) for r in raw], "vec_id long, embedding array<float>, score int"))
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    assert dict(rows)[50] == [128, -1] and len(rows) == 7
    assert _got(nearest.top_k(df, F.col("vec_id") % 50 == 0)) >= {(100, 1, 6, 1792 * 768), (0, 1, 7, 256 * 3 * 2**39)}
    assert nearest.top_k(df.limit(0), F.lit(True)).count() == 0


def test_token_counts_of_documents(spark):
    own = token_files._encoder(token_files.TOKENIZER)
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {r["doc_id"]: len(own.encode_ordinary(r["text"])) for r in docs}
    assert {r["doc_id"]: r["n_tokens"] for r in QUERIES["op5_token_counts"](spark, SF).collect()} == expected


def test_scan_stitches_blocks(spark, tmp_path):
    rng = np.random.default_rng(3)
    streams = {
        "a": rng.choice([1, 2, 9], 500, p=[0.45, 0.45, 0.1]), "b": np.array([9, 9, 1, 9]), "c": np.array([1] * 40), "d": np.array([], int),
        "e": np.array([1] * 16 + [9] + [2] * 16 + [9]),
    }
    for name, x in streams.items():
        (tmp_path / name).write_bytes(x.astype("<u2").tobytes())
    for block in (1, 7, 16, 1000):
        token_files.SPAN_BLOCKS, kept = 3, token_files.SPAN_BLOCKS
        try:
            rows = token_files.scan(spark, str(tmp_path), separator=9, block_tokens=block).collect()
        finally:
            token_files.SPAN_BLOCKS = kept
        got = sorted((r["path"][-1], r["start"], r["n_tokens"]) for r in rows)
        expected = []
        for name, x in streams.items():
            start = 0
            for end in [*np.flatnonzero(x == 9).tolist(), len(x)]:
                if end < len(x) or end > start:
                    expected.append((name, start, end - start))
                start = end + 1
        assert got == sorted(expected)


def test_token_edge_cases(spark, tmp_path):
    rows = [(1, None, "x"), (None, "a b", "x"), (-1, "", "x"), (2**62, "word " * 5000, None), (1, None, "x")]
    path = str(tmp_path / "files")
    token_files.write_token_files(spark.createDataFrame(rows, "doc_id long, text string, value string"), path)
    found = token_files.scan(spark, path, head=token_files.HEAD, block_tokens=64)
    got = sorted(((r[0] or 0, r[1]) for r in found.select(token_files.doc_ids("head"), "n_tokens").collect()))
    own = token_files._encoder(token_files.TOKENIZER)
    assert got == sorted([(1, 0), (1, 0), (-1, 0), (0, 2), (2**62, len(own.encode_ordinary("word " * 5000)))])
    empty = str(tmp_path / "none")
    token_files.write_token_files(spark.createDataFrame([], "doc_id long, text string"), empty)
    assert token_files.scan(spark, empty).count() == 0
