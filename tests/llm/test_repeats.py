import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from brute import repeated_bytes as plain

from gramline.llm import repeats
from gramline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def test_query_same_as_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    expected = {(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in plain([(r["doc_id"], r["text"]) for r in docs])}
    assert {tuple(r) for r in QUERIES["op2_repeated_bytes"](spark, SF).collect()} == expected


def test_matching_statistics_of_small_texts():
    rng = np.random.default_rng(2)
    for size, letters in ((1, 1), (40, 1), (200, 2), (500, 4)):
        text = rng.integers(1, letters + 1, size).astype(np.uint8)
        found = repeats.RunLengthIndex.build(text, -(-(size + 1) // 8) * 8, np.array([0])).matching()
        raw = text.tobytes()
        for p in range(size):
            best = 0
            for q in range(size):
                n = 0
                while q != p and max(p, q) + n < size and raw[p + n] == raw[q + n]:
                    n += 1
                best = max(best, n)
            assert min(found[p], size - p) == best, (size, p)


def test_windows_of_alike_contexts():
    rng = random.Random(3)
    for trial in range(500):
        length = rng.randint(2, 11)
        bases = ["".join(rng.choice("ab") for _ in range(rng.randint(length, 3 * length))) for _ in range(2)]
        contexts = []
        for _ in range(rng.randint(2, 8)):
            base = rng.choice(bases)
            at = rng.randrange(len(base))
            contexts.append((base[:at] + "c" + base[at + 1 :] if rng.random() < 0.6 else base).encode())
        windows = [len(c) - length + 1 for c in contexts]
        each = [[c[i : i + length] for i in range(n)] for c, n in zip(contexts, windows, strict=True)]
        times = Counter(w for own in each for w in own)
        found = repeats.repeated_windows(contexts, windows, length)
        assert [f.tolist() for f in found] == [[times[w] > 1 for w in own] for own in each], (trial, contexts)


def _rows():
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefé") for _ in range(rng.randint(2, 8)))
    passage = " ".join(word() for _ in range(150))
    rows = [(i, " ".join(word() for _ in range(rng.randint(5, 200)))) for i in range(12)]
    rows += [(20 + i, rows[i][1][:300] + passage[rng.randint(0, 300) :] + rows[i + 1][1]) for i in range(8)]
    rows += [(40, "x" * 1000), (41, "x" * 450), (42, "ab" * 700), (43, None), (44, ""), (45, rows[3][1]), (None, rows[3][1])]
    rows += [(46, passage), (46, passage[:399]), (47, passage[200:600] + passage[200:600]), (None, "y" * 399), (48, "y" * 400)]
    return rows


@pytest.mark.parametrize("limit", [1 << 22, 2000])
def test_same_as_brute_force(spark, limit):
    rows = _rows()
    docs = spark.createDataFrame([(*r, "own") for r in rows], "doc_id long, text string, kept string")
    found = repeats.remove_repeats(docs, index_bytes=limit, shard_bytes=5000).collect()
    got = sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in found), key=str)
    assert got == sorted(plain(rows), key=str)
    assert repeats.remove_repeats(docs.limit(0)).count() == 0


def test_long_texts_are_cut_into_pieces(monkeypatch):
    monkeypatch.setattr(repeats, "_PIECE", 700)
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    first, n, _ = repeats._runs_of_text(data, 400)
    assert first[0] == 0 and (first[1:] == first[:-1] + n[:-1]).all() and first[-1] + n[-1] == 5000 - 399
