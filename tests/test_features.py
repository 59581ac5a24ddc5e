import math
from collections import Counter

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_text import _grams

from gramline.functions import grams as cutting
from gramline.operators import features, model, search
from gramline.plans import lookup

TEXTS = ["the cat sat", "the dog sat sat", "a bird", "", "the cat and the dog", "a", "zebra"]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "row_id bigint, tweet string")


def _tfidf(texts, lo, hi, min_df, max_df):
    counts = [Counter(_grams(t, lo, hi)) for t in texts]
    df = Counter(g for c in counts for g in c)
    kept = {g for g, n in df.items() if min_df <= n <= max_df * len(texts)}
    out = {}
    for i, c in enumerate(counts):
        raw = {g: tf * (math.log((1 + len(texts)) / (1 + df[g])) + 1) for g, tf in c.items() if g in kept}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        out |= {(i, g): x / norm for g, x in raw.items()}
    return out


@pytest.mark.parametrize("limit", [lookup.BROADCAST_BYTES, 0])
def test_tfidf(spark, rows, limit, monkeypatch):
    """Both with a broadcast vocabulary and with one too large for it."""
    vocabulary = features.fit_vocabulary(rows, "tweet", 2, 4, 2, 0.6)
    got = features.tfidf_transform(vocabulary, rows, "row_id", "tweet", limit=limit).collect()
    expected = _tfidf(TEXTS, 2, 4, 2, 0.6)
    assert {(r["row_id"], r["gram"]) for r in got} == set(expected)
    assert all(math.isclose(r["tfidf"], expected[r["row_id"], r["gram"]]) for r in got)


def test_vectors_equal_the_table(spark, rows):
    vocabulary = features.fit_vocabulary(rows, "tweet", 2, 4, 2, 0.6)
    vocabulary, size = model.numbered(vocabulary)
    grams = {r["index"]: r["gram"] for r in vocabulary.grams.collect()}
    assert sorted(grams) == list(range(size)) and [grams[i] for i in range(size)] == sorted(grams.values())
    expected = _tfidf(TEXTS, 2, 4, 2, 0.6)
    featured = model.with_features(vocabulary, size, rows, "row_id", "tweet").collect()
    assert len(featured) == len(TEXTS)
    for row in featured:
        got = {grams[i]: x for i, x in zip(row["features"].indices, row["features"].values)}
        want = {g: x for (i, g), x in expected.items() if i == row["row_id"]}
        assert got.keys() == want.keys() and all(math.isclose(got[g], want[g]) for g in got)


def test_an_empty_vocabulary_is_an_error(spark, rows):
    with pytest.raises(ValueError, match="grams"):
        model.numbered(features.fit_vocabulary(rows, "tweet", 2, 4, 100, 1.0))


def test_document_frequency_bounds(spark):
    table = spark.createDataFrame([("a", 1), ("b", 2), ("c", 6), ("d", 7), ("e", 10)], "gram string, df bigint")

    def kept(low, high):
        return "".join(sorted(r["gram"] for r in features.prune_vocabulary(table, 10, low, high).collect()))

    assert kept(2, 0.6) == "bc" and kept(1, 10) == "abcde" and kept(0.2, 1.0) == "bcde"


@pytest.mark.parametrize("lo, hi", [(2, 5), (3, 4), (4, 6), (5, 5)])
def test_narrower_range_from_a_wide_gram_table(spark, rows, lo, hi):
    wide = features.term_frequency(rows, "row_id", "tweet", 2, 6)
    narrow = features.term_frequency(rows, "row_id", "tweet", lo, hi)
    as_set = lambda df: {tuple(r) for r in df.collect()}
    assert as_set(search.grams_in_range(wide, lo, hi)) == as_set(narrow)


def test_gram_table_is_not_shuffled(spark, rows):
    """One exchange, of the text; none of (id, gram) rows."""
    plan = features.term_frequency(rows, "row_id", "tweet", 3, 7)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1


@pytest.mark.parametrize("how", ["inner", "left", "left_semi"])
@pytest.mark.parametrize("limit", [10**6, 60, 0])
def test_lookup_join(spark, monkeypatch, how, limit):
    """Broadcast, heavy keys broadcast and light ones shuffled, and all shuffled give the same rows."""
    monkeypatch.setattr(lookup, "HEAVY_KEYS", 2)
    facts = spark.createDataFrame([(k, i) for i, k in enumerate("aaaaaabbc")] + [(None, 99), ("z", 98)], "k string, i int")
    table = spark.createDataFrame([("a", 1, 6), ("b", 2, 2), ("c", 3, 1)], "k string, v int, n bigint")
    got = lookup.lookup_join(facts, table, ["k"], how, weight="n", limit=limit)
    expected = facts.join(table.drop("n"), ["k"], how)
    assert got.columns == expected.columns
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, expected.collect()))


def test_fold_vocabularies_are_those_of_the_other_folds(spark):
    rows = [(i, f"w{i % 3} common r{i % 7}" if i % 5 else None, i % 4 if i % 6 else None) for i in range(40)]
    folded = spark.createDataFrame(rows, "row_id long, tweet string, fold int")
    for min_df, max_df in ((2, 0.9), (0.1, 20)):
        got = features.fold_vocabularies(folded, "tweet", 3, 4, min_df, max_df, k=5)
        found = {(r["fold"], r["gram"]): (r["df"], r["n"], round(r["idf"], 9)) for r in got.collect()}
        expected = {}
        for f in range(5):  # no row has fold 4, so all rows with a fold are outside it
            other = folded.filter((F.col("fold") != f) & F.col("tweet").isNotNull())
            own = features.fit_vocabulary(other, "tweet", 3, 4, min_df, max_df)
            expected |= {(f, r["gram"]): (r["df"], own.n, round(r["idf"], 9)) for r in own.grams.collect()}
        assert found == expected and len({f for f, _ in found}) == 5
    assert features.fold_vocabularies(folded.limit(0), "tweet", 3, 4, 1, 1.0).count() == 0


@pytest.mark.parametrize("size, words", [(1, 1), (2, 3), (5, 10**6), (100, 2)])
def test_equal_ids_are_one_row_over_any_batches(size, words, monkeypatch):
    monkeypatch.setattr(cutting, "WORDS", words)
    rows = [(None, "ab ab c"), (None, None), (None, "c"), (1, "aaaa b"), (2, None), (3, "b"), (3, "aaaa"), (3, "b b"), (4, "")]
    ids, texts = zip(*rows, strict=True)
    whole = pa.record_batch([pa.array(ids, pa.int64()), pa.array([t and t.split() for t in texts], pa.list_(pa.string()))], ["id", "words"])
    batches = [whole.slice(i, size) for i in range(0, len(rows), size)]
    got = [tuple(r.values()) for b in cutting.term_frequencies(batches, 2, 3) for r in b.to_pylist()]
    expected = Counter()
    for id, t in rows:
        expected.update((id, g) for g in _grams(t or "", 2, 3))
    assert sorted(got, key=str) == sorted(((*k, n) for k, n in expected.items()), key=str)
    counts = Counter()
    for b in cutting.document_frequencies(batches, 2, 3):
        counts.update({(r["by"], r["gram"]): r["df"] for r in b.to_pylist()})
    assert counts == Counter((id, g) for id, t in rows for g in set(_grams(t or "", 2, 3)))


def test_weighing_with_a_broadcast_vocabulary_shuffles_no_grams(spark, rows):
    vocabulary = features.fit_vocabulary(rows, "tweet", 2, 4, 2, 0.6)
    plan = features.tfidf_transform(vocabulary, rows, "row_id", "tweet")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Window" not in plan and "Generate" not in plan
