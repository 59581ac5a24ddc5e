"""Hashed maximum-entropy language model with a class-factored softmax.

p(word | history) = p(class | history) * p(word | class). The class softmax has hashed features of the history: the
last word, the last two words, and a skip feature, the word before the last. Frequent words are dealt to classes of
equal weight; all other words, unknown ones included, belong to the class of their ending, and endings are clustered by
the frequent words that stand next to them. Inside a class the probabilities are counts plus one, with one place for
unknown words in every ending class, so that the outcomes sum to 1.

The weights are partitioned by history: tokens go to a shard by the hash of the word before them, so the features of
one word's histories lie in one shard, and the skip feature is learned within it. There is a shard for every
`SHARD_TOKENS` tokens of the corpus, each with rows of its own, so the model grows with the corpus and no task or
driver holds it whole. Tokens after a word so frequent that it would crowd a shard are dealt evenly to several. A shard
takes adaptive gradient steps over its training tokens in small sparse batches, each token once, and then scores all
its tokens; a document's parts are summed. The number of classes grows with the logarithms of tokens and types.

Counts of words are exact; the `table_words` most frequent ones are broadcast, rarer ones are joined.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import _LOWER, Words, mix64, plain_strings, slices
from gramline.plans.storage import written

TABLE_WORDS = 1 << 20
FREQUENT_SHARE = 0.35
ANCHORS = 64
SHARD_TOKENS = 1 << 20
HEAVY_PART = 8  # a word with more than 1/HEAVY_PART of a shard's tokens has its followers dealt to several places
BUCKET_BITS = 16
ENDING_BITS = 12
BATCH = 8192
RATE = 0.25
END = np.uint64(0x656E64)  # the key of the token that ends a text
_NONE = np.uint64(0x626F73)
_MIX = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB)]
_TRAIN = 128  # set in an event's class if its text is a training text


def _features(codes: np.ndarray) -> np.ndarray:
    """The weight rows of the last word, the last two words, and the word before the last."""
    last, before = codes.astype(np.uint64)
    both = mix64((last << np.uint64(BUCKET_BITS) | before) * _MIX[1]) >> np.uint64(64 - BUCKET_BITS)
    return np.stack([codes[0], both, codes[1]]).astype(np.uint16)  # which numpy sorts by radix


class Stream:
    """Tokens of a run of texts, each text's words and then its end: `key`, `ending`, `doc`, and the two keys before."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        words = Words(data, offsets)
        n_docs = len(offsets) - 1
        n = len(words.key) + n_docs
        place = np.arange(len(words.key)) + words.doc
        ends = words.first[1:] + np.arange(n_docs)
        self.key = np.full(n, END)
        self.key[place] = words.key
        self.doc = np.empty(n, np.int64)
        self.doc[place], self.doc[ends] = words.doc, np.arange(n_docs)
        size = words.end - words.start
        code = np.zeros(len(place), np.uint64)
        for i in range(3):
            letter = np.where(size > i, _LOWER[data[np.maximum(words.end - 1 - i, 0)]], 0) if len(size) else size
            code = code * np.uint64(257) + letter.astype(np.uint64)
        self.ending = np.zeros(n, np.int64)
        self.ending[place] = (mix64(code) >> np.uint64(64 - ENDING_BITS)).astype(np.int64)
        self.last, self.before = np.full(n, _NONE), np.full(n, _NONE)
        same = self.doc[1:] == self.doc[:-1]
        self.last[1:][same] = self.key[:-1][same]
        self.before[1:][same] = self.last[:-1][same]

    def codes(self) -> np.ndarray:
        """Hashes of the last word and of the word before it, from which the features are made."""
        shift = np.uint64(64 - BUCKET_BITS)
        return np.stack([(mix64(h) >> shift).astype(np.uint16) for h in (self.last * _MIX[0], self.before * _MIX[3])])

    def features(self) -> np.ndarray:
        return _features(self.codes())

    def shards(self, words: Vocabulary, row_no: int) -> np.ndarray:
        """The shard of each token's history. `row_no` is the first text's number."""
        fan = _lookup(words.heavy, words.fan, self.last, 1).astype(np.uint64)
        token = (self.doc + row_no).astype(np.uint64) * _MIX[1] + np.arange(len(self.doc), dtype=np.uint64)
        place = mix64(token) % fan
        return (mix64(self.last * _MIX[2] + place * _MIX[3]) % np.uint64(words.shards)).astype(np.int64)


@dataclass
class Vocabulary:
    """What every task needs of the counts: the table of at most `table_words` words and what is derived from it."""

    tokens: int  # N
    types: int  # V
    shards: int
    keys: np.ndarray  # sorted keys of the table
    counts: np.ndarray  # in training texts, 0 for words found in others only
    heavy: np.ndarray  # sorted keys of words whose followers are dealt to several places
    fan: np.ndarray  # the number of those places
    frequent: np.ndarray  # sorted keys of words with a class of their own kind
    frequent_class: np.ndarray
    n_frequent_classes: int
    ending_class: np.ndarray
    class_tokens: np.ndarray
    class_types: np.ndarray

    def known_counts(self, key: np.ndarray) -> np.ndarray:
        """The count of each key in the table, else -1."""
        return _lookup(self.keys, self.counts, key, -1)

    def classes(self, stream: Stream) -> np.ndarray:
        own = _lookup(self.frequent, self.frequent_class, stream.key, -1)
        return np.where(own >= 0, own, self.ending_class[stream.ending])

    def room(self) -> np.ndarray:
        """log10 of each class's denominator: its tokens, plus one for each word and for unknown ones."""
        unknown = np.arange(len(self.class_tokens)) >= self.n_frequent_classes
        return np.log10(np.maximum(self.class_tokens + self.class_types + unknown, 1))


def _lookup(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray, default: int) -> np.ndarray:
    if not len(keys):
        return np.full(len(wanted), default, np.int64)
    different, back = np.unique(wanted, return_inverse=True)
    at = np.minimum(np.searchsorted(keys, different), len(keys) - 1)
    return np.where(keys[at] == different, values[at], default)[back]


def _streams(batches, column: int = 0):
    """(batch, first row, Stream, rows) for runs of about a megabyte of text."""
    for batch in batches:
        for first, data, offsets in slices(plain_strings(batch.column(column))):
            yield batch, first, Stream(data, offsets), len(offsets) - 1


def _count(texts: DataFrame) -> DataFrame:
    """(key, ending, n, met) of all tokens, a written table: occurrences in training texts and in all texts."""

    def run(batches):
        held: dict[str, list] = {"key": [], "ending": [], "n": [], "met": []}
        size = 0

        def flush():
            key, ending, n, met = (np.concatenate(c) for c in held.values())
            order = np.argsort(key)
            key, ending, n, met = key[order], ending[order], n[order], met[order]
            head = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            out = [pa.array(key[head].view(np.int64)), pa.array(ending[head].astype(np.int32)), *(pa.array(np.add.reduceat(c, head)) for c in (n, met))]
            for c in held.values():
                c.clear()
            return pa.RecordBatch.from_arrays(out, list(held))

        for batch, first, stream, n_texts in _streams(batches):
            training = batch.column(1).slice(first, n_texts).to_numpy(zero_copy_only=False).astype(bool)
            key, at, back, met = np.unique(stream.key, return_index=True, return_inverse=True, return_counts=True)
            held["key"].append(key)
            held["ending"].append(stream.ending[at])
            held["n"].append(np.bincount(back, training[stream.doc], len(key)).astype(np.int64))
            held["met"].append(met)
            size += len(key)
            if size > 1_500_000:
                yield flush()
                size = 0
        if held["key"]:
            yield flush()

    counted = texts.select("text", "training").mapInArrow(run, "key long, ending int, n long, met long")
    sums = (F.first("ending").alias("ending"), F.sum("n").alias("n"), F.sum("met").alias("met"))
    return written(counted.groupBy("key").agg(*sums), "token-counts")


_HEAD = {"key": np.int64, "ending": np.int32, "n": np.int64, "met": np.int64}


def _most_met(counts: DataFrame, table_words: int) -> pd.DataFrame:
    """The most frequent words, at most `table_words`; sent to the driver as packed numbers, 28 bytes a word."""
    # Counts are put in ranges by their leading six bits: at most some 2,000 rows, whatever the corpus.
    step = F.expr("bigint(greatest(0, floor(log2(met)) - 5))")
    low = F.expr("shiftleft(shiftright(met, int(step)), int(step))")
    ranges = counts.withColumn("step", step).groupBy(low.alias("low")).count().collect()
    least, total = None, 0
    for low, n in sorted(((r["low"], r["count"]) for r in ranges), reverse=True):
        total += n
        if total > table_words:
            break
        least = low

    def pack(batches):
        for batch in batches:
            if batch.num_rows:
                packed = [pa.array([batch.column(i).to_numpy().astype(t).tobytes()], pa.binary()) for i, t in enumerate(_HEAD.values())]
                yield pa.RecordBatch.from_arrays(packed, list(_HEAD))

    head = counts.filter(F.col("met") >= least) if least is not None else counts.limit(0)
    rows = head.select(*_HEAD).mapInArrow(pack, ", ".join(f"{c} binary" for c in _HEAD)).collect()
    return pd.DataFrame({c: np.frombuffer(b"".join(r[c] for r in rows), t) for c, t in _HEAD.items()})


def _neighbours(texts: DataFrame, anchors: np.ndarray) -> np.ndarray:
    """Counts of (ending, frequent word before or after): a matrix of fixed size, summed over the tasks."""
    width = 2 * (len(anchors) + 1)
    order = np.argsort(anchors)

    def run(batches):
        total = np.zeros((1 << ENDING_BITS) * width, np.int64)
        for _, _, stream, _ in _streams(batches):
            near = _lookup(anchors[order], order, stream.last, len(anchors))
            after = np.full(len(near), len(anchors))
            same = stream.doc[1:] == stream.doc[:-1]
            after[:-1][same] = _lookup(anchors[order], order, stream.key[1:][same], len(anchors))
            for column in (near, after + width // 2):
                total += np.bincount(stream.ending * width + column, minlength=len(total))
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    found = texts.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros((1 << ENDING_BITS) * width)
    out[found["at"].to_numpy(np.int64)] = found["n"]
    return out.reshape(-1, width)


def _clusters(rows: np.ndarray, weights: np.ndarray, k: int) -> np.ndarray:
    """Weighted k-means of endings by the square roots of their neighbours' shares."""
    shares = rows / np.maximum(rows.sum(1, keepdims=True), 1)
    points = np.sqrt(shares)
    heavy = np.argsort(-weights, kind="stable")
    centres = points[heavy[:1]]
    while len(centres) < k:  # farthest points among the heaviest endings
        pool = points[heavy[: 40 * k]]
        far = ((pool[:, None] - centres[None]) ** 2).sum(2).min(1) * np.sqrt(weights[heavy[: 40 * k]])
        centres = np.vstack([centres, pool[far.argmax()]])
    for _ in range(20):
        own = (-2 * points @ centres.T + (centres**2).sum(1)).argmin(1)
        for c in range(k):
            if weights[own == c].sum():
                centres[c] = np.average(points[own == c], axis=0, weights=weights[own == c])
    return own


def vocabulary(texts: DataFrame, counts: DataFrame, table_words: int) -> Vocabulary:
    total = counts.agg(F.sum("n"), F.count_if(F.col("n") > 0), F.sum("met")).first()
    n_tokens, n_types, n_met = (int(x or 0) for x in total)
    table = _most_met(counts, table_words)
    met = table[table["met"] > SHARD_TOKENS // HEAVY_PART].sort_values("key", key=lambda k: k.to_numpy().view(np.uint64))
    head = table[table["n"] > 0].sort_values(["n", "key"], ascending=[False, True])
    keys, n = head["key"].to_numpy(np.int64).view(np.uint64), head["n"].to_numpy(np.int64)
    n_frequent = min(int(np.searchsorted(np.cumsum(n), FREQUENT_SHARE * max(n_tokens, 1))) + 1, len(n))
    frequent, mass = keys[:n_frequent], n[:n_frequent]
    n_own = max(4, n_tokens.bit_length() - 12)
    own_class = np.minimum((np.cumsum(mass) - mass) * n_own // max(int(mass.sum()), 1), n_own - 1)
    by_ending = counts.groupBy("ending").agg(F.sum("n").alias("n"), F.count_if(F.col("n") > 0).alias("types")).toPandas()
    tokens, types = np.zeros(1 << ENDING_BITS), np.zeros(1 << ENDING_BITS)
    tokens[by_ending["ending"]], types[by_ending["ending"]] = by_ending["n"], by_ending["types"]
    np.subtract.at(tokens, head["ending"].to_numpy()[:n_frequent], mass)
    np.subtract.at(types, head["ending"].to_numpy()[:n_frequent], 1)
    n_ending = max(8, n_types.bit_length() - 2)
    ending_class = _clusters(_neighbours(texts.filter("training").select("text"), frequent[:ANCHORS]), tokens, n_ending) + n_own
    n_classes = n_own + n_ending
    class_tokens = np.bincount(own_class, mass, n_classes) + np.bincount(ending_class, tokens, n_classes)
    class_types = np.bincount(own_class, minlength=n_classes) + np.bincount(ending_class, types, n_classes)
    order = np.argsort(frequent)
    all_keys = table["key"].to_numpy(np.int64).view(np.uint64)
    by_key = np.argsort(all_keys)
    return Vocabulary(
        n_tokens, n_types, max(1, -(-n_met // SHARD_TOKENS)), all_keys[by_key], table["n"].to_numpy(np.int64)[by_key],
        met["key"].to_numpy(np.int64).view(np.uint64), -(-met["met"].to_numpy(np.int64) * HEAVY_PART // SHARD_TOKENS),
        frequent[order], own_class[order].astype(np.int64), n_own, ending_class, class_tokens, class_types,
    )


class Classes:
    """The class softmax: `weights[bucket, class]` and `bias[class]`."""

    def __init__(self, weights: np.ndarray, bias: np.ndarray):
        self.weights, self.bias = weights, bias

    def probabilities(self, features: np.ndarray) -> np.ndarray:
        logits = self.weights[features[0]]
        logits += self.weights[features[1]]
        logits += self.weights[features[2]]
        logits += self.bias
        logits -= logits.max(1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(1, keepdims=True)
        return logits

    def step(self, features: np.ndarray, target: np.ndarray, squares: np.ndarray) -> None:
        """One adaptive gradient step on the rows that the batch touches."""
        wrong = self.probabilities(features)
        wrong[np.arange(len(target)), target] -= 1
        flat = features.ravel()
        order = np.argsort(flat, kind="stable")
        rows, token = flat[order], order % len(target)
        head = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
        size = np.diff(np.r_[head, len(rows)])
        rows, gradient = rows[head], wrong[token[head]]
        many = size > 1  # most rows are met once, and need no sum
        if many.any():
            begin = np.cumsum(size[many]) - size[many]
            gradient[many] = np.add.reduceat(wrong[token[np.repeat(many, size)]], begin, axis=0)
        total = squares[rows] + np.square(gradient)
        squares[rows] = total
        self.weights[rows] -= RATE * gradient / (np.sqrt(total) + 1e-6)


def _bias(words: Vocabulary) -> np.ndarray:
    return np.log((words.class_tokens + 1) / (words.class_tokens + 1).sum()).astype(np.float32)


def _events(stream: Stream, words: Vocabulary, target: np.ndarray, training: np.ndarray, row_no: int) -> list:
    """(shard, packed events) of a run of texts: history codes, class with the training mark, steps of the text's number."""
    shard, codes = stream.shards(words, row_no), stream.codes()
    order = np.argsort(shard, kind="stable")
    marked = (target + _TRAIN * training[stream.doc]).astype(np.uint8)[order]
    codes, doc, shard = codes[:, order], stream.doc[order].astype(np.uint32), shard[order]
    cuts = np.r_[np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]]), len(shard)]
    return [
        {"shard": int(shard[lo]), "n": int(hi - lo), "events": _packed(codes[:, lo:hi], marked[lo:hi], doc[lo:hi])}
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True)
    ]


_EVENT_BYTES = 2 * 2 + 1 + 4


def _packed(codes: np.ndarray, marked: np.ndarray, doc: np.ndarray) -> bytes:
    """Steps are mostly 0 or 1; stored byte by byte of their four, nearly all compress to nothing."""
    steps = np.diff(doc, prepend=np.uint32(0)).view(np.uint8).reshape(-1, 4).T
    return pa.compress(codes.tobytes() + marked.tobytes() + steps.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    flat = np.frombuffer(pa.decompress(packed, n * _EVENT_BYTES, "zstd"), np.uint8)
    codes = flat[: 4 * n].view(np.uint16).reshape(2, n)
    steps = np.ascontiguousarray(flat[5 * n :].reshape(4, n).T).view(np.uint32).ravel()
    return codes, flat[4 * n : 5 * n], np.cumsum(steps, dtype=np.int64)


def _learned(features: np.ndarray, target: np.ndarray, bias: np.ndarray) -> Classes:
    """One pass of gradient steps over a shard's training tokens, in a fixed random order."""
    model = Classes(np.zeros((1 << BUCKET_BITS, len(bias)), np.float32), bias)
    squares = np.full_like(model.weights, 0.1)
    order = np.random.default_rng(len(target)).permutation(len(target))
    size = min(BATCH, max(256, len(target) // 128))
    for at in range(0, len(target), size):
        take = order[at : at + size]
        model.step(features[:, take], target[take], squares)
    return model


def _class_scores(events: DataFrame, bias: np.ndarray) -> DataFrame:
    """(row_no, class_score): the sum of log10 p(class | history) over a text's tokens. A shard answers each run of
    texts with one row of packed sums, which are added up run by run."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("base")
        parts = [_unpacked(e, n) for e, n in zip(frame["events"], frame["n"], strict=True)]
        features = _features(np.concatenate([p[0] for p in parts], axis=1))
        marked = np.concatenate([p[1] for p in parts])
        target, training = (marked % _TRAIN).astype(np.int64), np.flatnonzero(marked >= _TRAIN)
        model = _learned(features[:, training], target[training], bias)
        logs = np.empty(len(target))
        for at in range(0, len(target), BATCH):
            p = model.probabilities(features[:, at : at + BATCH])
            logs[at : at + BATCH] = np.log10(np.maximum(p[np.arange(len(p)), target[at : at + BATCH]], 1e-30))
        cuts, sums = np.cumsum(frame["n"].to_numpy())[:-1], []
        for part, own in zip(parts, np.split(logs, cuts), strict=True):
            text = part[2]
            head = np.flatnonzero(np.r_[True, text[1:] != text[:-1]])
            sums.append(text[head].tobytes() + np.add.reduceat(own, head).tobytes())
        return pd.DataFrame({"base": frame["base"], "shard": frame["shard"], "sums": sums})

    def total(frame: pd.DataFrame) -> pd.DataFrame:
        halves = [(s[: len(s) // 2], s[len(s) // 2 :]) for s in frame.sort_values("shard")["sums"]]
        text = np.frombuffer(b"".join(h[0] for h in halves), np.int64)
        sums = np.bincount(text, np.frombuffer(b"".join(h[1] for h in halves), np.float64))
        met = np.unique(text)
        return pd.DataFrame({"row_no": met + frame["base"].iloc[0], "class_score": sums[met]})

    scored = events.groupBy("shard").applyInPandas(run, "base long, shard long, sums binary")
    return scored.groupBy("base").applyInPandas(total, "row_no long, class_score double")


def score(docs: DataFrame, training, table_words: int = TABLE_WORDS) -> DataFrame:
    """`docs` (without `text`) with `n_tokens`, `n_known`, `train_tokens`, `base_score` and `score`, both log10
    probabilities of the whole text: of counts plus one, and of the model.

    The model learns from the rows for which `training` holds. Tokens are runs of other than space and \\t to \\r, A-Z
    lower-cased, and one end; a null or empty text is its end alone. Repeated rows and ids each count and are each
    scored. Without training rows all tokens are unknown; an empty table gives no rows. Columns of `docs` with the new
    names are replaced.
    """
    new = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    kept = [c for c in docs.columns if c not in new and c != "text"]
    held = F.struct(*(F.col(c) for c in kept)) if kept else F.struct(F.lit(None).cast("int").alias("none"))
    texts = docs.select("text", F.coalesce(training, F.lit(False)).alias("training"), held.alias("held"))
    counts = _count(texts)
    words = vocabulary(texts, counts, table_words)
    bias = _bias(words)
    shared = docs.sparkSession.sparkContext.broadcast((words, words.room()))
    event = T.StructType([T.StructField("shard", T.LongType()), T.StructField("n", T.LongType()), T.StructField("events", T.BinaryType())])
    schema = T.StructType([
        texts.schema["held"], *(T.StructField(n, T.LongType()) for n in ("row_no", "n_tokens", "n_known")),
        *(T.StructField(n, T.DoubleType()) for n in ("logs", "model")), T.StructField("rare", T.ArrayType(T.LongType())),
        T.StructField("parts", T.ArrayType(event)),
    ])
    packed = pa.list_(pa.struct([("shard", pa.int64()), ("n", pa.int64()), ("events", pa.binary())]))

    def run(batches):
        own, room = shared.value
        row_no = TaskContext.get().partitionId() << 33
        for batch, first, stream, n in _streams(batches):
            learn = batch.column(1).slice(first, n).to_numpy(zero_copy_only=False).astype(bool)
            count, target = own.known_counts(stream.key), own.classes(stream)
            logs = np.bincount(stream.doc, np.log10(np.maximum(count, 0) + 1), n)
            rare = np.flatnonzero(count < 0)
            cuts = np.searchsorted(stream.doc[rare], np.arange(n + 1))
            lists = pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(stream.key[rare].view(np.int64)))
            events = [_events(stream, own, target, learn, row_no), *[None] * (n - 1)]  # held by the run's first text
            made = [
                pa.array(np.arange(row_no, row_no + n)), pa.array(np.bincount(stream.doc, minlength=n)),
                pa.array(np.bincount(stream.doc, count > 0, n).astype(np.int64)), pa.array(logs),
                pa.array(-np.bincount(stream.doc, room[target], n)), lists, pa.array(events, packed),
            ]
            row_no += n
            yield pa.RecordBatch.from_arrays([batch.column(2).slice(first, n), *made], names=schema.names)

    rows = written(texts.mapInArrow(run, schema), "scores")
    events = rows.filter("parts IS NOT NULL").select(F.col("row_no").alias("base"), F.explode("parts").alias("part"))
    more = _class_scores(events.select("base", "part.*"), bias)
    rest = rows.select("row_no", F.explode("rare").alias("key")).groupBy("row_no", "key").agg(F.count("*").alias("times"))
    found = rest.join(counts.filter("n > 0").select("key", "n"), "key").groupBy("row_no").agg(
        F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("more_logs")
    )
    space = float(np.log10(words.tokens + words.types + 1))
    logs = F.col("logs") + F.coalesce("more_logs", F.lit(0.0))
    return rows.drop("rare", "parts").join(more, "row_no", "left").join(found, "row_no", "left").select(
        *(F.col("held").getField(c).alias(c) for c in kept), "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"), (logs - F.col("n_tokens") * space).alias("base_score"),
        (F.coalesce("class_score", F.lit(0.0)) + F.col("model") + logs).alias("score"),
    )
