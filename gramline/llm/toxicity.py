"""Toxic spans by a linear-chain conditional random field, and document scores from its marginals.

Tokens are words; a chain is a sentence of a line, cut after 64 words. A token's score for the toxic state is a sum of hashed weights of its
word, of the word with its left and with its right neighbour; two-by-two transitions link neighbours. Token labels come
from document labels: words of toxic documents that occur there far more often than chance allows. Training is gradient
descent inside tasks with the weights averaged between rounds; scoring is one map over the documents.

The fit uses at most `MOST_TOXIC` and `MOST_CLEAN` labelled documents, drawn by a hash of their ids.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import Words, mix64, plain_strings, slices
from gramline.plans.storage import written

MOST_TOXIC = 3000
MOST_CLEAN = 5000
THRESHOLD = 0.7
BITS = 18
ROUNDS = 2
LEAST_STEPS = 200  # of each task in a round, over whole passes
TASKS = 8
RATE = 1.0
PURITY = 20  # times as frequent in toxic documents as in clean ones, for a word to be labelled
SPAN_MARGINAL = 0.5
CHAIN_WORDS = 64
_VALUES = np.array([1.0, 0.3, 0.3])  # of a word's own feature and of its pairs, which are rarer and teach less
_STEP_TOKENS = 1 << 12
_LEFT, _RIGHT = np.uint64(0x9FB21C651E98DF25), np.uint64(0xD6E8FEB86659FD93)
_EDGE = np.uint64(0xA0761D6478BD642F)
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?"]] = True


class Tokens:
    """Words of a run of texts without punctuation at their ends, the features of each, and the chains."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets, strip=True)
        self.doc, self.word, n = words.doc, words.key, len(words.key)
        start, self.start, self.end = words.start, words.start, words.end
        # A stop anywhere from the word to the next one ends a chain.
        stops = np.r_[0, np.cumsum(_STOP[data])]
        last = stops[np.r_[start[1:], len(data)]] > stops[words.end] if n else np.zeros(0, bool)
        breaks = np.cumsum(data == 10)
        line = breaks[start] if n else np.zeros(0, np.int64)
        new = np.ones(n, bool)
        new[1:] = last[:-1] | (line[1:] != line[:-1]) | (self.doc[1:] != self.doc[:-1])
        begin = np.flatnonzero(new)
        new[(np.arange(n) - np.repeat(begin, np.diff(np.r_[begin, n]))) % CHAIN_WORDS == 0] = True
        self.chain = np.flatnonzero(new)
        self.length = np.diff(np.r_[self.chain, n])
        left, right = np.full(n, _EDGE), np.full(n, _EDGE)
        left[1:] = np.where(new[1:], _EDGE, self.word[:-1])
        right[:-1] = np.where(new[1:], _EDGE, self.word[1:])
        shift = np.uint64(64 - BITS)
        self.features = np.stack(
            [mix64(self.word) >> shift, mix64(self.word ^ left * _LEFT) >> shift, mix64(self.word ^ right * _RIGHT) >> shift]
        ).astype(np.int64)


class Steps:
    """Chains sorted by length, so that position t of all chains that reach it is one slice."""

    def __init__(self, chain: np.ndarray, length: np.ndarray):
        order = np.argsort(-length, kind="stable")
        self.first, self.length = chain[order], length[order]
        longest = int(self.length[0]) if len(order) else 0
        self.reach = np.searchsorted(-self.length, -np.arange(longest), "left")  # chains longer than t

    def forward(self, score: np.ndarray, link: np.ndarray) -> np.ndarray:
        """log alpha(1) / alpha(0) of every token."""
        out = score.copy()
        for t in range(1, len(self.reach)):
            at = self.first[: self.reach[t]] + t
            before = out[at - 1]
            out[at] += np.logaddexp(before + link[1, 1], link[0, 1]) - np.logaddexp(before + link[1, 0], link[0, 0])
        return out

    def backward(self, score: np.ndarray, link: np.ndarray) -> np.ndarray:
        """log beta(1) / beta(0) of every token."""
        out = np.zeros_like(score)
        for t in range(len(self.reach) - 1, 0, -1):
            at = self.first[: self.reach[t]] + t
            after = score[at] + out[at]
            out[at - 1] = np.logaddexp(link[1, 0], link[1, 1] + after) - np.logaddexp(link[0, 0], link[0, 1] + after)
        return out


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def _document_features(weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(weights)), np.log(weights + 1e-3), np.log1p(lengths)], axis=1)


@dataclass
class Tagger:
    """Weights of hashed features, `bias`, transitions `link`, and the calibration of document scores."""

    weights: np.ndarray
    bias: float
    link: np.ndarray
    scale: np.ndarray

    @classmethod
    def empty(cls) -> Tagger:
        return cls(np.zeros(1 << BITS), -3.0, np.zeros((2, 2)), np.array([-4.0, 0.0, 0.0]))

    def marginals(self, tokens: Tokens) -> np.ndarray:
        """The probability of the toxic state of each token."""
        score = _VALUES @ self.weights[tokens.features] + self.bias
        steps = Steps(tokens.chain, tokens.length)
        return _sigmoid(steps.forward(score, self.link) + steps.backward(score, self.link))

    def document_weights(self, tokens: Tokens, marginals: np.ndarray, n: int) -> np.ndarray:
        """Sums of squared marginals: about the number of toxic tokens, however many faint ones a long text has."""
        return np.bincount(tokens.doc, np.square(marginals), n).astype(float)

    def document_scores(self, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return _sigmoid(_document_features(weights, lengths) @ self.scale)

    def learn(self, tokens: Tokens, toxic: np.ndarray, squares: list) -> None:
        """One pass of adaptive gradient steps over runs of chains."""
        ends = np.cumsum(tokens.length)
        first = 0
        while first < len(ends):
            base = tokens.chain[first]
            last = max(first + 1, int(np.searchsorted(ends, base + _STEP_TOKENS, "right")))
            stop = ends[last - 1]
            self._step(tokens.features[:, base:stop], tokens.chain[first:last] - base, tokens.length[first:last], toxic[base:stop], squares)
            first = last

    def _step(self, features, chain, length, toxic, squares) -> None:
        n = len(toxic)
        score = _VALUES @ self.weights[features] + self.bias
        steps = Steps(chain, length)
        ahead, behind = steps.forward(score, self.link), steps.backward(score, self.link)
        wrong = (_sigmoid(ahead + behind) - toxic) / n
        gradient = sum(v * np.bincount(f, wrong, 1 << BITS) for v, f in zip(_VALUES, features, strict=True))
        inner = np.ones(n, bool)
        inner[chain] = False
        now = np.flatnonzero(inner)
        pair = np.zeros((2, 2))
        if len(now):
            logits = np.stack(
                [self.link[i, j] + i * ahead[now - 1] + j * (score[now] + behind[now]) for i in (0, 1) for j in (0, 1)]
            )
            odds = np.exp(logits - logits.max(0))
            seen = np.bincount(2 * toxic[now - 1] + toxic[now], minlength=4)
            pair = ((odds / odds.sum(0)).sum(1) - seen).reshape(2, 2) / n
        for i, g in enumerate((gradient, wrong.sum(), pair)):
            squares[i] = squares[i] + np.square(g)
        self.weights -= RATE * gradient / (np.sqrt(squares[0]) + 1e-8)
        self.bias -= RATE * wrong.sum() / (np.sqrt(squares[1]) + 1e-8)
        self.link = self.link - 0.1 * RATE * pair / (np.sqrt(squares[2]) + 1e-8)


def _sample(docs: DataFrame, labels: DataFrame, usable, most_toxic: int, most_clean: int) -> tuple[DataFrame, dict]:
    """(doc_id, text, toxic) of the documents to learn from, and the number of labels of each class."""
    judged = labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    judged = written(judged.filter(usable), "labels")
    counts = {r["toxic"]: r["count"] for r in judged.groupBy("toxic").count().collect()}
    draw = F.xxhash64("doc_id", F.lit(11))
    toxic = judged.filter("toxic = 1").orderBy(draw, "doc_id").limit(most_toxic)
    chosen = toxic.unionByName(judged.filter("toxic = 0").orderBy(draw, "doc_id").limit(most_clean))
    chosen = written(chosen.select(F.col("doc_id").alias("label_id"), "toxic"), "label-sample")  # at most 8,000 rows
    found = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
    return written(found.dropDuplicates(["label_id"]).select("doc_id", "text", "toxic").repartition(TASKS, "doc_id"), "sample"), counts


def _evidence(sample: DataFrame) -> np.ndarray:
    """Hashes of words that toxic documents hold more often than chance allows, by a likelihood ratio test whose bound
    grows with the number of words tested."""

    def words(batches):
        for batch in batches:
            toxic = np.array(batch.column(1).to_pylist(), np.int64)
            for first, data, offsets in slices(plain_strings(batch.column(0))):
                t = Tokens(data, offsets)
                pairs = np.unique(np.stack([t.doc.astype(np.uint64), t.word]), axis=1) if len(t.doc) else np.zeros((2, 0), np.uint64)
                flag = toxic[first + pairs[0].astype(np.int64)]
                yield pa.RecordBatch.from_arrays([pa.array(pairs[1].view(np.int64)), pa.array(flag)], ["word", "toxic"])

    by_class = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    n1, n0 = by_class.get(1, 0), by_class.get(0, 0)
    if not n1 or not n0:
        return np.zeros(0, np.uint64)
    held = sample.select("text", F.col("toxic").cast("long").alias("toxic")).mapInArrow(words, "word long, toxic long")
    counts = held.groupBy("word").agg(F.sum("toxic").alias("t"), F.count("*").alias("n")).filter("t >= 3").toPandas()
    t, n = counts["t"].to_numpy(float), counts["n"].to_numpy(float)
    share = n1 / (n1 + n0)
    c = n - t
    ratio = 2 * (t * np.log(t / (n * share)) + np.where(c > 0, c * np.log(np.maximum(c, 1e-9) / (n * (1 - share))), 0))
    chosen = (t / n1 > PURITY * (c + 0.5) / n0) & (ratio > 3 * np.log(10 * max(len(t), 1)))
    return counts["word"].to_numpy(np.int64).view(np.uint64)[chosen]


def fit(docs: DataFrame, labels: DataFrame, usable=None, most_toxic: int = MOST_TOXIC, most_clean: int = MOST_CLEAN) -> Tagger:
    """A tagger fitted to documents (doc_id, text) whose label row (doc_id, toxic) meets `usable`, a condition on
    `doc_id`. Only 0 and 1 are labels; a document with several is toxic if one says so. Without labels of both kinds
    every text gets the same low score."""
    spark = docs.sparkSession
    sample, counts = _sample(docs, labels, F.lit(True) if usable is None else usable, most_toxic, most_clean)
    evidence = _evidence(sample)
    tagger = Tagger.empty()

    def of(frames):
        texts, toxic = [], []
        for batch in frames:
            texts += plain_strings(batch.column(0)).to_pylist()
            toxic += batch.column(1).to_pylist()
        for first, data, offsets in slices(pa.array(texts, pa.large_string()), 1 << 22):
            t = Tokens(data, offsets)
            own = np.array(toxic[first : first + len(offsets) - 1], np.int64)
            yield t, (np.isin(t.word, evidence) & (own[t.doc] == 1)).astype(np.int64), own

    columns = sample.select("text", F.col("toxic").cast("long"))
    for _ in range(ROUNDS if len(evidence) else 0):
        shared = spark.sparkContext.broadcast(tagger)

        def learn(batches):
            own = shared.value
            own = Tagger(own.weights.copy(), own.bias, own.link.copy(), own.scale)
            squares, held = [np.zeros(1 << BITS), 0.0, np.zeros((2, 2))], list(of(batches))
            size = sum(len(toxic) for _, toxic, _ in held)
            for _ in range(max(3, -(-LEAST_STEPS * _STEP_TOKENS // max(size, _STEP_TOKENS)))):
                for tokens, toxic, _ in held:
                    own.learn(tokens, toxic, squares)
            if held:
                parts = np.r_[own.weights, own.bias, own.link.ravel()].astype("<f4")
                yield pa.RecordBatch.from_arrays([pa.array([parts.tobytes()], pa.binary())], ["weights"])

        found = [np.frombuffer(r["weights"], "<f4") for r in columns.mapInArrow(learn, "weights binary").collect()]
        # A weight is averaged over the tasks that met its feature.
        mean = np.sum(found, axis=0, dtype=float) / np.maximum(np.count_nonzero(found, axis=0), 1)
        tagger = Tagger(mean[:-5], float(mean[-5]), mean[-4:].reshape(2, 2), tagger.scale)

    shared = spark.sparkContext.broadcast(tagger)

    def expect(batches):
        for tokens, _, own in of(batches):
            sums = shared.value.document_weights(tokens, shared.value.marginals(tokens), len(own))
            lengths = np.bincount(tokens.doc, minlength=len(own))
            yield pa.RecordBatch.from_arrays([pa.array(sums), pa.array(lengths), pa.array(own)], ["weight", "length", "toxic"])

    pairs = columns.mapInArrow(expect, "weight double, length long, toxic long").toPandas()
    x = _document_features(pairs["weight"].to_numpy(float), pairs["length"].to_numpy(float))
    tagger.scale = _calibrated(x, pairs["toxic"].to_numpy(float), counts)
    return tagger


def _calibrated(x: np.ndarray, toxic: np.ndarray, counts: dict) -> np.ndarray:
    """Logistic regression of the label on the document's features, classes weighed as in all labels."""
    if not 0 < toxic.sum() < len(toxic):
        return np.array([-4.0, 0.0, 0.0])
    weight = np.where(toxic == 1, counts[1] / toxic.sum(), counts[0] / (len(toxic) - toxic.sum()))
    weight /= weight.sum()
    out, penalty = np.zeros(3), np.diag([1e-9, 1e-3, 1e-3])  # the penalty bounds the slopes on separable data
    for _ in range(100):
        p = _sigmoid(x @ out)
        gradient = x.T @ (weight * (p - toxic)) + penalty @ out
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + penalty, gradient)
        out -= step * min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        if np.abs(step).max() < 1e-6:
            break
    return out


def score(docs: DataFrame, tagger: Tagger, threshold: float = THRESHOLD) -> DataFrame:
    """`docs` with `score` (0 to 1), `predicted` (1 from `threshold` on) and `spans`, the offending runs of tokens as
    code point offsets (start, end). Only `text` is read; a null or empty text has no tokens and the lowest score.
    Columns of `docs` with the new names are replaced."""
    spark = docs.sparkSession
    own = docs.drop("score", "predicted", "spans")
    shared = spark.sparkContext.broadcast(tagger)
    names, at = own.columns, own.columns.index("text")
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    added = [("score", T.DoubleType()), ("predicted", T.IntegerType()), ("spans", T.ArrayType(span))]
    full = T.StructType([*own.schema.fields, *(T.StructField(n, t) for n, t in added)])
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches):
        model = shared.value
        for batch in batches:
            for first, data, offsets in slices(plain_strings(batch.column(at)), 1 << 21):
                n = len(offsets) - 1
                tokens = Tokens(data, offsets)
                p = model.marginals(tokens)
                scores = model.document_scores(model.document_weights(tokens, p, n), np.bincount(tokens.doc, minlength=n))
                made = [pa.array(scores), pa.array((scores >= threshold).astype(np.int32)), pa.array(_spans(tokens, p, data, offsets), kind)]
                part = batch.slice(first, n)
                yield pa.RecordBatch.from_arrays([*part.columns, *made], names=[*names, "score", "predicted", "spans"])

    return own.mapInArrow(run, full)


def _spans(tokens: Tokens, p: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> list[list[dict]]:
    """Runs of toxic tokens of one chain, by document."""
    out: list[list[dict]] = [[] for _ in range(len(offsets) - 1)]
    hot = np.flatnonzero(p >= SPAN_MARGINAL)
    if not len(hot):
        return out
    new = np.zeros(len(p), bool)
    new[tokens.chain] = True
    points = np.r_[0, np.cumsum((data & 0xC0) != 0x80)]
    begin = np.r_[True, (np.diff(hot) > 1) | new[hot[1:]]]
    for a, b in zip(hot[begin], hot[np.r_[begin[1:], True]], strict=True):
        d = tokens.doc[a]
        base = points[offsets[d]]
        out[d].append({"start": int(points[tokens.start[a]] - base), "end": int(points[tokens.end[b]] - base)})
    return out
