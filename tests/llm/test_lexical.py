"""Ranked search against a plain version."""

import math
import re
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gramline.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return TERM.findall((text or "").translate(UPPER))


def _expected(docs, items, k=10):
    own = [(i, Counter(_terms(t))) for i, t in docs]
    own = [(i, c) for i, c in own if c]
    n_docs, total = len(own), sum(sum(c.values()) for _, c in own)
    held = Counter(t for _, c in own for t in c)
    out = []
    for item_id, text in items:
        scored = []
        for doc_id, c in own:
            m = 25 + 75 * sum(c.values()) * n_docs // total
            score = 0
            for t in _terms(text):
                w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * held[t] + 1)))
                score += w * (1000000000 * c[t] // (1000 * c[t] + 8 * m))
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, null, doc_id) in enumerate(sorted(scored)[:k], 1):
            out.append((item_id, rank, None if null else doc_id, -score))
    return sorted(out, key=str)


def _got(spark, docs, items, **settings):
    d = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    i = spark.createDataFrame(items, "item_id bigint, text string")
    return sorted((tuple(r) for r in lexical.search(d, i, **settings).collect()), key=str)


DOCS = [
    (1, "The cat's cat sat."), (2, "the CAT sat on a mat"), (3, None), (4, ""), (5, "?!"), (6, "naïve CAFÉ café 漢字 cat9"), (None, "cat"),
    (7, "cat"), (7, "cat"), (8, "a\x00b{c}|d~e\x7ff"), (9, "cat " * 40000), (10, "caté cat_e categorical concat"),
] + [(100 + i, "mat dog") for i in range(15)]
ITEMS = [(1, "cat cat mat"), (2, "CAFÉ"), (3, None), (4, "nothing here"), (5, "dog"), (5, "A b c d e f"), (None, "sat"), (6, "!!")]


@pytest.mark.parametrize("block_bytes", [120, lexical.BLOCK_BYTES])
def test_odd_texts(spark, block_bytes):
    assert _got(spark, DOCS, ITEMS, block_bytes=block_bytes) == _expected(DOCS, ITEMS)


def test_small_slices(spark, monkeypatch):
    monkeypatch.setattr(lexical, "SLICE_BYTES", 8)
    monkeypatch.setattr(lexical, "CELLS", 3)
    assert _got(spark, DOCS, ITEMS, k=3) == _expected(DOCS, ITEMS, 3)


def test_clashing_columns(spark):
    own = {c: F.lit("own") for c in ("item", "item_id", "rank", "score", "term", "n")}
    d = spark.createDataFrame(DOCS, "doc_id bigint, text string").withColumns(own)
    i = spark.createDataFrame(ITEMS, "item_id bigint, text string").withColumns({c: F.lit("own") for c in ("item", "doc_id", "block", "size")})
    assert sorted((tuple(r) for r in lexical.search(d, i).collect()), key=str) == _expected(DOCS, ITEMS)


def test_empty_tables(spark):
    assert _got(spark, [], ITEMS) == [] and _got(spark, DOCS, []) == [] and _got(spark, [], []) == []


@settings(max_examples=40, deadline=None)
@given(st.lists(st.text(st.characters(codec="utf-8"), max_size=30), max_size=8), st.lists(st.text("aB1 é.", max_size=6), min_size=1, max_size=4))
def test_scan_counts_whole_terms(texts, items):
    import pyarrow as pa

    block = lexical.Block([(i, i, t) for i, t in enumerate(items)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts)), pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])
    got, counts = {}, []
    for ids, n, doc, term, tf in lexical._scanned([batch], block):
        counts += n.tolist()
        got |= {(ids[int(d)].as_py(), block.terms[t].decode()): f for d, t, f in zip(doc, term, tf.tolist(), strict=True)}
    wanted = {t for text in items for t in _terms(text)}
    assert counts == [len(_terms(t)) for t in texts]
    assert got == {(i, t): n for i, text in enumerate(texts) for t, n in Counter(_terms(text)).items() if t in wanted}
