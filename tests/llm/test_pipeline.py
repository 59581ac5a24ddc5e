import pytest
from pyspark.sql import functions as F

from brute import edit_distance, near_duplicates, words

import corpus_pipeline
from gramline.llm import decontam
from gramline.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _best(item, text):
    k = decontam.edits_allowed(len(item))
    low, high = len(item) - k, len(item) + k
    return min((edit_distance(item, text[a:b]) for a in range(len(text)) for b in range(a + low, min(len(text), a + high) + 1)), default=len(item))


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = [{r["doc_id"] for r in docs.collect()}]
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        ids.append({r["doc_id"] for r in docs.collect()})
        if name != "sharding":
            assert docs.columns == COLUMNS
        if name == "near_duplicates":
            groups = near_duplicates([(r["doc_id"], r["text"]) for r in before.collect()])
            assert ids[-1] == {c for _, c in groups.values()}
    assert all(b <= a for a, b in zip(ids, ids[1:]))
    assert {(r["shard"], r["slot"]) for r in docs.collect()} and docs.count() == docs.select("shard", "slot").distinct().count()


@pytest.mark.parametrize("missing", ["text", "source", "doc_id"])
def test_stages_with_nulls_and_extra_columns(spark, missing):
    rows = [(i, f"some words of text number {i} " * 9, "en", f"s{i % 3}", 9, "x") for i in range(12)] + [(3, "", "en", "s", 0, "x")] * 2
    names = [
        "predicted", "spans", "toxic", "ref", "words_key", "component_id", "kept", "leaks", "more", "size", "target", "source_no",
        "source_size", "named", "part_id", "part_row", "group_start", "held", "own", "block", "pass_no",
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score string")
    docs = docs.select("*", *(F.lit(f"own {n}").alias(n) for n in names))
    nulls = docs.selectExpr(*(f"if(n_chars = 9 AND lang = 'en', NULL, {c}) AS {c}" if c == missing else c for c in docs.columns))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, nulls, SF)
        if name != "sharding":
            assert out.columns == docs.columns
            assert all(r["score"] == "x" and all(r[n] == f"own {n}" for n in names) for r in out.collect())
        assert out.count() <= 3 * len(rows)
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_leaks_same_as_brute_force(spark):
    docs = {r["doc_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    items = {r["item_id"]: words(r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()}
    got = {(r["doc_id"], r["item_id"]): r["distance"] for r in QUERIES["op10_decontamination"](spark, SF).collect()}
    clean = {i: [w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or w for w in ws] for i, ws in items.items()}
    for (d, i), distance in got.items():
        text = [w.strip("!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~") or w for w in docs[d]]
        assert distance == _best(clean[i], text) <= decontam.edits_allowed(len(clean[i]))
    for d, ws in docs.items():  # whole items that stand in a text are always found
        joined = f" {' '.join(ws)} "
        for i, item in items.items():
            if f" {' '.join(item)} " in joined:
                assert got[d, i] == 0


def test_recall_at_the_bound():
    import random

    rng, found, total = random.Random(8), 0, 0
    items = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randint(6, 60))) for _ in range(150)]
    index, texts = decontam.ItemIndex(list(range(150)), items), []
    for item in items:
        own = item.split()
        for _ in range(decontam.edits_allowed(len(own))):
            at = rng.randrange(len(own))
            own[at : at + rng.randint(0, 1)] = [f"x{rng.random()}"] * rng.randint(0, 1)
        pad = [f"y{rng.random()}" for _ in range(rng.randint(0, 30))]
        texts.append(" ".join([*pad, *own, *pad]))
    import pyarrow as pa

    for i, hits in enumerate(index.leaks(decontam.plain_strings(pa.array(texts)))):
        total += 1
        found += any(h["item_id"] == i for h in hits)
        assert all(h["item_id"] == i for h in hits)
    assert found >= 0.95 * total


@pytest.mark.parametrize("n", [5, 9, 15, 24, 25, 40, 59, 100, 200, 400, 700])
def test_recall_at_the_bound_by_length(n):
    import random

    import pyarrow as pa

    rng, texts = random.Random(n), []
    items = [[f"w{rng.randrange(3000)}" for _ in range(n)] for _ in range(60)]
    for item in items:
        own, k = list(item), decontam.edits_allowed(n)
        for at in sorted(rng.sample(range(n), k), reverse=True):  # k edits of different words, none of them without effect
            kind = rng.randrange(3)
            own[at : at + (kind != 1)] = [] if kind == 2 else [f"x{rng.random()}"]
        pad = [f"y{rng.random()}" for _ in range(30)]
        texts.append(" ".join([*pad, *own, *pad]))
    index = decontam.ItemIndex(list(range(60)), [" ".join(i) for i in items])
    found = [{h["item_id"]: h["distance"] for h in hits} for hits in index.leaks(decontam.plain_strings(pa.array(texts)))]
    assert all(set(hits) <= {i} and hits.get(i, 0) <= k for i, hits in enumerate(found))
    assert sum(i in hits for i, hits in enumerate(found)) >= (57 if n < 25 else 60)


def test_long_items_in_crowded_texts(monkeypatch):
    """Items that share most of their runs, repeated copies, and windows that are matched in several parts."""
    import random

    import pyarrow as pa

    rng = random.Random(3)
    base = [f"w{rng.randrange(40)}" for _ in range(30)]
    items = [[*base[:i], f"v{i}", *base[i + 1 :]] for i in range(0, 30, 3)]
    texts = [[*base, *base[::-1], *items[2]], [*items[5][:24], *base], base[:23], [], [*base[6:], *items[9]] * 2]
    monkeypatch.setattr(decontam, "WINDOW_BLOCK", 20)
    index = decontam.ItemIndex(list(range(10)), [" ".join(i) for i in items])
    got = index.leaks(decontam.plain_strings(pa.array([" ".join(t) for t in texts])))
    for text, hits in zip(texts, got, strict=True):
        found = {h["item_id"]: h for h in hits}
        for i, item in enumerate(items):
            best = _best(item, text)
            assert (i in found) == (best <= 6)
            if i in found:
                h = found[i]
                assert h["distance"] == best == edit_distance(item, text[h["first_word"] : h["last_word"]])


def test_pieces_of_every_length_keep_the_bound():
    """The piece with the fewest edits of an item is within its own bound, whatever the item's length."""
    for n in range(1, 3000):
        m = -(-n // decontam.PIECE_WORDS)
        assert decontam.edits_allowed(n) // m <= decontam.edits_allowed(n // m)


def test_short_items_match_exactly(spark, tmp_path):
    items = [(n, " ".join(f"s{n}w{i}" for i in range(n))) for n in range(1, 5)] + [(5, "again again"), (6, "")]
    texts = [f"before {text}, after" for _, text in items] + [text.replace("w0", "x0") for _, text in items[:4]] + ["again once", "s4w0 s4w1 s4w2"]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(list(enumerate(texts, 1)), "doc_id long, text string")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    got = QUERIES["op10_decontamination"](spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["item_id"], r["distance"], r["first_word"], r["last_word"]) for r in got) == [
        *((n, n, 0, 1, 1 + n) for n in range(1, 5)), (5, 5, 0, 1, 3),
    ]
    kept = corpus_pipeline.drop_benchmark_leaks(spark, docs, str(tmp_path)).collect()
    assert {r["doc_id"] for r in kept} == set(range(6, len(texts) + 1))


def test_leak_edge_cases(spark):
    item = "one two three four five six seven eight nine ten"
    docs = [(1, f"x {item.upper()}, y", "own"), (1, None, "own"), (None, item, "own"), (2, "", "own"), (3, item[4:], "own"), (4, "one two", "own")]
    items = [(7, item, 0), (7, item, 1), (8, None, 0), (9, "", 0), (10, "one two", 0), (None, "no such item stands here", 0)]
    found = decontam.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string, leaks string"),
        spark.createDataFrame(items, "item_id long, text string, doc_id long"), block_items=2,
    ).collect()
    got = {(r["doc_id"], r["text"]): [(x["item_id"], x["distance"], x["first_word"], x["last_word"]) for x in r["leaks"]] for r in found}
    assert got == {
        (1, docs[0][1]): [(7, 0, 1, 11)] * 2, (1, None): [], (None, item): [(7, 0, 0, 10)] * 2, (2, ""): [],
        (3, item[4:]): [(7, 1, 0, 9)] * 2, (4, "one two"): [],
    }
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["leaks"] == [] for r in decontam.find_leaks(spark.createDataFrame(docs[:2], "doc_id long, text string, leaks string"), none).collect())
