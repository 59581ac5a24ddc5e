import numpy as np
from brute import dedup_lines as plain

from gramline.llm.line_dedup import CuckooFilter, LineStore

LONG = "a line that is long enough"
SCHEMA = "doc_id long, text string, n_lines string"


def _marked(store, docs):
    return sorted(
        ((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in store.mark(docs).collect()), key=str
    )


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "own") for i, t in rows], SCHEMA)


ROWS = [
    (1, f"x\n{LONG}\n{LONG}\ny"), (2, f"  {LONG.upper()}\t"), (3, f"{LONG}\r\nend"), (4, None), (5, ""), (None, f"{LONG}\nz"),
    (6, "short\nshort"), (7, "short"), (8, "short"), (3, f"{LONG}\r\nend"), (9, "é" * 20), (10, "é" * 20), (11, "É" * 20),
    (12, "é" * 19 + " "), (13, "é" * 20),
]


def test_same_as_brute_force(spark):
    docs = _docs(spark, ROWS)
    store = LineStore(spark)
    store.insert(docs)
    assert _marked(store, docs) == sorted(plain(ROWS), key=str)


def test_insertions_and_deletions_are_reversible(spark):
    first, more = ROWS[:3], ROWS[3:]
    store = LineStore(spark, shard_keys=2)
    store.insert(_docs(spark, first))
    assert _marked(store, _docs(spark, first)) == sorted(plain(first), key=str)
    store.insert(_docs(spark, more))
    assert _marked(store, _docs(spark, ROWS)) == sorted(plain(ROWS), key=str)
    store.delete(_docs(spark, more))
    assert _marked(store, _docs(spark, first)) == sorted(plain(first), key=str)
    store.delete(_docs(spark, first[1:]))
    assert store.counts.count() == 0 and all(r[2] == 0 for r in _marked(store, _docs(spark, first)))


def test_empty_table(spark):
    docs = _docs(spark, ROWS).limit(0)
    store = LineStore(spark)
    store.insert(docs)
    assert store.mark(docs).count() == 0


def test_filter_holds_what_it_should():
    keys = np.arange(1, 40_001, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    own = CuckooFilter.sized_for(20_000)
    own.insert(keys[:20_000])
    assert own.contains(keys[:20_000]).all()
    assert own.contains(keys[20_000:]).mean() < 0.001
    again = CuckooFilter.from_row(*own.to_row())
    again.delete(keys[:10_000])
    assert again.contains(keys[10_000:20_000]).all()
    assert again.contains(keys[:10_000]).mean() < 0.001


def test_overfull_filter_loses_no_key():
    keys = np.arange(1, 101, dtype=np.uint64)
    own = CuckooFilter(2)
    own.insert(keys)
    assert own.contains(keys).all()
    own.delete(keys)
    assert not own.spare and not own.table.any()
