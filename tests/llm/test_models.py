import zlib
from collections import Counter
from itertools import product
from math import log10

import numpy as np
import pyarrow as pa
from brute import words
from pyspark.sql import functions as F

from gramline.llm import maxent, toxicity
from gramline.llm.arrays import raw_bytes, plain_strings
from gramline.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
TINY = "/root/testdata/sf0.001"


def _counts(docs):
    return Counter(w for t in docs for w in [*words(t), "\0end"])


def test_language_model_query(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").collect()
    held = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2 for r in docs}
    counts = _counts(r["text"] for r in docs if not held[r["doc_id"]])
    n, v = sum(counts.values()), len(counts)
    rows = {r["doc_id"]: r for r in QUERIES["op3_language_model"](spark, TINY).collect()}
    assert len(rows) == len(docs)
    for r in docs:
        tokens, got = [*words(r["text"]), "\0end"], rows[r["doc_id"]]
        base = sum(log10((counts[w] + 1) / (n + v + 1)) for w in tokens)
        assert (got["held_out"], got["n_tokens"], got["train_tokens"]) == (held[r["doc_id"]], len(tokens), n)
        assert got["n_known"] == sum(counts[w] > 0 for w in tokens)
        assert np.isclose(got["base_score"], base, rtol=1e-9)


def test_language_model_beats_counts_on_unseen_texts(spark):
    rows = [r for r in QUERIES["op3_language_model"](spark, SF).collect() if r["held_out"]]
    assert sum(r["score"] for r in rows) > 0.97 * sum(r["base_score"] for r in rows)


def test_rare_words_are_joined(spark):
    docs = spark.read.parquet(f"{TINY}/documents.parquet").select("doc_id", "text")
    both = [
        {r["doc_id"]: (r["n_known"], round(r["base_score"], 6)) for r in maxent.score(docs, F.col("doc_id") % 5 != 0, table_words=m).collect()}
        for m in (50, 1 << 20)
    ]
    assert both[0] == both[1]


def test_language_model_edge_cases(spark):
    rows = [(1, "a b a", "x"), (1, None, "x"), (None, "", None), (2, "a c", "x"), (3, " \n", "x"), (None, "d " * 3000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = maxent.score(docs, F.coalesce(F.col("doc_id") != 2, F.lit(True))).collect()
    assert sorted(r["n_tokens"] for r in got) == [1, 1, 1, 3, 4, 3001]
    assert all(np.isfinite(r["score"]) and r["train_tokens"] == 3008 for r in got)
    assert [r["n_known"] for r in got if r["doc_id"] == 2] == [2]
    assert all(r["n_known"] == 0 for r in maxent.score(docs, F.lit(False)).collect())
    assert maxent.score(docs.limit(0), F.lit(True)).count() == 0


def test_scores_same_as_plain_sums(spark, monkeypatch):
    """Every token's probability from plain counts, its class, and a softmax over its shard's weights, summed by text."""
    monkeypatch.setattr(maxent, "SHARD_TOKENS", 512)
    rng = np.random.default_rng(4)
    texts = [" ".join(rng.choice(["the", "of", *(f"w{i}" for i in range(60))], 40, p=[0.35, 0.15, *[0.5 / 60] * 60])) for _ in range(80)]
    texts += [None, "", "Q " * 400, texts[0], "new words of the day"]
    learn = [i % 5 != 2 for i in range(len(texts))]
    docs = spark.createDataFrame(list(zip(range(len(texts)), texts, learn)), "doc_id long, text string, learn boolean").coalesce(1)
    for table_words in (1 << 20, 5):
        got = {r["doc_id"]: r for r in maxent.score(docs, F.col("learn"), table_words).collect()}
        held = docs.select("text", F.col("learn").alias("training"))
        vocabulary = maxent.vocabulary(held, maxent._count(held), table_words)
        assert vocabulary.shards > 3 and len(vocabulary.heavy) >= 2 and len(vocabulary.keys) <= table_words
        counts = _counts(t for t, own in zip(texts, learn) if own)
        data, offsets = raw_bytes(plain_strings(pa.array(texts)))
        stream = maxent.Stream(data, offsets)
        shard, target, features = stream.shards(vocabulary, 0), vocabulary.classes(stream), stream.features().astype(int)
        tokens = [(i, w) for i, t in enumerate(texts) for w in [*words(t), "\0end"]]
        known = {w: c for (_, w), c in zip(tokens, target.tolist())}
        room = Counter(known[w] for w in counts) + Counter({known[w]: 0 for w in counts})
        for w, n in counts.items():
            room[known[w]] += n
        bias, want = maxent._bias(vocabulary), Counter()
        for s in set(shard.tolist()):
            own = np.flatnonzero(shard == s)
            trained = [i for i in own if learn[tokens[i][0]]]
            weights = maxent._learned(features[:, trained], target[trained], bias).weights
            for i in own:
                logits = bias + sum(weights[f] for f in features[:, i])
                chance = np.exp(logits[target[i]]) / np.exp(logits).sum()
                rest = room[target[i]] + (target[i] >= vocabulary.n_frequent_classes)
                want[tokens[i][0]] += log10(chance) + log10((counts[tokens[i][1]] + 1) / rest)
        assert len(got) == len(texts)
        assert all(np.isclose(got[i]["score"], want[i], rtol=1e-4) for i in got)


def test_gradient_step_same_as_plain_one():
    rng = np.random.default_rng(2)
    model = maxent.Classes(rng.normal(size=(8, 3)).astype(np.float32), rng.normal(size=3).astype(np.float32))
    before, features, target = model.weights.astype(float), rng.integers(0, 5, (3, 20)), rng.integers(0, 3, 20)
    gradient = np.zeros((8, 3))
    for i in range(20):
        logits = model.bias + sum(before[f] for f in features[:, i])
        wrong = np.exp(logits) / np.exp(logits).sum() - np.eye(3)[target[i]]
        for f in features[:, i]:
            gradient[f] += wrong
    model.step(features, target, np.full((8, 3), 0.1, np.float32))
    assert np.allclose(model.weights, before - maxent.RATE * gradient / (np.sqrt(0.1 + gradient**2) + 1e-6), atol=1e-4)


def test_class_probabilities_sum_to_one():
    rng = np.random.default_rng(1)
    model = maxent.Classes(rng.normal(size=(1 << 16, 32)).astype(np.float32), rng.normal(size=32).astype(np.float32))
    data, offsets = raw_bytes(plain_strings(pa.array(["a b c d", "", "e f"])))
    stream = maxent.Stream(data, offsets)
    assert np.allclose(model.probabilities(stream.features()).sum(1), 1, atol=1e-5)
    assert stream.doc.tolist() == [0, 0, 0, 0, 0, 1, 2, 2, 2]


def test_marginals_same_as_all_paths():
    rng = np.random.default_rng(3)
    score, link = rng.normal(size=9), rng.normal(size=(2, 2))
    chain, length = np.array([0, 5, 6]), np.array([5, 1, 3])
    steps = toxicity.Steps(chain, length)
    got = toxicity._sigmoid(steps.forward(score, link) + steps.backward(score, link))
    for c, n in zip(chain, length):
        total, hot = 0.0, np.zeros(n)
        for path in product((0, 1), repeat=int(n)):
            w = np.exp(sum(score[c + i] for i in range(n) if path[i]) + sum(link[a, b] for a, b in zip(path, path[1:])))
            total += w
            hot += w * np.array(path)
        assert np.allclose(got[c : c + n], hot / total)


def test_toxicity_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = QUERIES["op4_toxicity"](spark, SF).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    judged = [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(p == t for p, t in judged) / len(judged) > 0.93
    assert sum(p for p, t in judged if not t) <= 0.02 * len(judged)


def test_toxicity_spans_and_edge_cases(spark):
    rows = [(i, f"Élan fine words here {i}. You utter {'nothing' if i % 3 else 'badword'}, friend.") for i in range(90)]
    labels = spark.createDataFrame([(i, int(i % 3 == 0), None) for i in range(90)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, toxic int, score string")
    docs = spark.createDataFrame([(*r, "own") for r in rows] + [(None, None, None), (7, "", "own"), (7, "\n. ", "own")], "doc_id long, text string, score string")
    tagger = toxicity.fit(docs, labels)
    got = toxicity.score(docs, tagger).collect()
    assert len(got) == 93 and all(0 <= r["score"] <= 1 for r in got)
    for r in got:
        if r["text"] and "badword" in r["text"]:
            assert r["predicted"] == 1 and "badword" in [r["text"][s["start"] : s["end"]] for s in r["spans"]][0]
        else:
            assert r["predicted"] == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert {r["predicted"] for r in toxicity.score(docs, none).collect()} == {0}
    assert toxicity.score(docs.limit(0), none).count() == 0
