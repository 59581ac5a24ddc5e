"""Removal of byte strings of a given length that occur more than once in a corpus, with a run-length index.

Equal windows choose equal anchors: the 32-byte gram with the least hash inside a window. Windows with the same anchor
place form a run, whose bytes are its context. Only contexts whose anchor's hash occurs again can hold a repeat:
equal contexts are repeats as a whole, and the bytes of different ones are gathered by anchor, once each, so that every
pair of equal windows meets in one index.

The index of some contexts is their run-compressed Burrows-Wheeler transform with the longest common prefixes sampled at
the run ends only. Matching statistics, the longest match of each position elsewhere, are streamed from the samples in
text order: between samples they fall by one per byte. Positions that match at least the window's length are repeats.

An anchor with more different contexts than one task should hold is split: its windows are counted one by one.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import mix64, plain_strings, slices
from gramline.plans.storage import written

LENGTH = 400
GRAM = 32
INDEX_BYTES = 4 << 20
SHARD_BYTES = 1 << 20
_PIECE = 1 << 22
_POSITION = np.uint64((1 << 24) - 1)
_SEPARATOR = 0xFF  # a byte that UTF-8 does not have


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """A hash of the GRAM bytes from each position on, by doubling."""
    h = (data.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    size = 1
    while size < GRAM:
        h = h[:-size] * np.uint64(0x94D049BB133111EB) + h[size:]
        h ^= h >> np.uint64(29)
        size *= 2
    return h


def anchor_runs(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, anchor hash) of each run of windows that share their anchor."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = gram_hashes(data)
    grams = length - GRAM + 1
    least = (mix64(h) & ~_POSITION) | np.arange(len(h), dtype=np.uint64)
    size = 1
    while size * 2 <= grams:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if grams > size:
        least = np.minimum(least[: len(least) - (grams - size)], least[grams - size :])
    place = (least & _POSITION).astype(np.int64)
    first = np.flatnonzero(np.r_[True, place[1:] != place[:-1]])
    return first, np.diff(np.r_[first, len(place)]), h[place[first]]


def _runs_of_text(data: np.ndarray, length: int):
    """`anchor_runs` of a text of any size, piece by piece; a run that crosses pieces is cut in two in both."""
    parts = []
    for lo in range(0, max(1, len(data) - length + 1), _PIECE):
        first, n, h = anchor_runs(data[lo : lo + _PIECE + length - 1], length)
        parts.append((first + lo, n, h))
    return tuple(np.concatenate(x) for x in zip(*parts, strict=True))


@dataclass
class RunLengthIndex:
    """The transform's runs, and for each run head the text position there, the position before it in suffix order, and
    the length that both share; `last` is the position of the last suffix."""

    symbols: np.ndarray
    lengths: np.ndarray
    head: np.ndarray
    before: np.ndarray
    shared: np.ndarray
    size: int
    last: int

    @classmethod
    def build(cls, text: np.ndarray, depth: int, begins: np.ndarray) -> RunLengthIndex:
        """Of a text of bytes. Suffixes are told apart by their bytes up to the next separator, then by position, as if
        no two separators were equal; where one is `depth` bytes away or more, order and streamed lengths would be wrong.
        The positions in `begins`, 0 and those behind separators, are sampled as run ends are."""
        n = len(text)
        ends = np.where(text == _SEPARATOR, np.arange(n), n + depth)
        left = np.minimum.accumulate(ends[::-1])[::-1] - np.arange(n)
        padded = np.r_[text, np.zeros(depth + 8, np.uint8)].astype(np.uint64)
        packed = padded[: n + depth].copy()
        for i in range(1, 8):
            packed = packed << np.uint64(8) | padded[i : n + depth + i]
        order = _suffix_order(packed, left, depth)
        symbols = text[order - 1]
        heads = np.flatnonzero(np.r_[True, symbols[1:] != symbols[:-1]])
        place = np.empty(n, np.int64)
        place[order] = np.arange(n)
        heads = np.unique(np.r_[heads, place[begins], np.minimum(place[begins] + 1, n - 1)])
        before = np.where(heads > 0, order[heads - 1], -1)
        shared = _common(packed, order[heads], before, depth)
        return cls(symbols[heads], np.diff(np.r_[heads, n]), order[heads], before, shared, n, int(order[-1]))

    def matching(self) -> np.ndarray:
        """The length of the longest match of each position with another one, streamed from the samples: of the suffix
        before it in order from run heads, of the one after it from run tails."""
        known = self.before >= 0
        out = np.zeros(self.size, np.int64)
        for position, value in ((self.head, self.shared), (np.r_[self.before[known], self.last], np.r_[self.shared[known], 0])):
            sample = np.full(self.size, -1, np.int64)
            sample[position] = value
            last = np.maximum.accumulate(np.where(sample >= 0, np.arange(self.size), -1))
            streamed = np.where(last >= 0, sample[last] - (np.arange(self.size) - last), 0)
            np.maximum(out, streamed, out=out)
        return out


def _suffix_order(packed: np.ndarray, left: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes by their bytes up to the separator that is `left` bytes away, `depth` at most, ties by position: prefix
    doubling over those that are still tied."""
    n = len(left)
    key = packed[:n].copy()
    near = np.flatnonzero(left < 8)
    key[near] &= ~np.uint64(0) << (np.uint64(56) - np.uint64(8) * left[near].astype(np.uint64))
    order = np.argsort(key, kind="stable")
    key = key[order]
    head = np.r_[True, key[1:] != key[:-1]] | (left[order] < 8)
    begin = np.flatnonzero(head)
    rank = np.zeros(n + depth, np.int64)  # 1 + the place of the first suffix that ties; 0 beyond the text
    rank[order] = np.repeat(begin, np.diff(np.r_[begin, n])) + 1
    tied = order[np.repeat(np.diff(np.r_[begin, n]) > 1, np.diff(np.r_[begin, n]))]
    known = 8
    while len(tied) and known < depth:
        step = min(known, depth - known)
        key = rank[tied].astype(np.uint64) << np.uint64(32) | rank[tied + step].astype(np.uint64)
        sort = np.argsort(key, kind="stable")
        tied, key = tied[sort], key[sort]
        group = np.flatnonzero(np.r_[True, (key[1:] >> np.uint64(32)) != (key[:-1] >> np.uint64(32))])
        begin = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
        size = np.diff(np.r_[begin, len(tied)])
        group_of = group[np.searchsorted(group, begin, "right") - 1]
        rank[tied] = rank[tied] + np.repeat(begin - group_of, size)
        tied = tied[np.repeat(size > 1, size)]
        known += step
    return np.argsort(rank[:n], kind="stable")


def _common(packed: np.ndarray, a: np.ndarray, b: np.ndarray, depth: int) -> np.ndarray:
    """Bytes that the text has in common from a and from b on, at most `depth`; 0 where b is -1."""
    out = np.zeros(len(a), np.int64)
    open_ = np.flatnonzero(b >= 0)
    for at in range(0, depth, 8):
        x = packed[np.minimum(a[open_] + at, len(packed) - 1)] ^ packed[np.minimum(b[open_] + at, len(packed) - 1)]
        differ = x != 0
        ended = open_[differ]
        # Leading zero bytes of the difference are further common bytes.
        lead = np.zeros(len(ended), np.int64)
        rest = x[differ]
        for shift in (56, 48, 40, 32, 24, 16, 8):
            lead += (rest >> np.uint64(shift)) == 0
        out[ended] = np.minimum(at + lead, depth)
        open_ = open_[~differ]
        if not len(open_):
            break
    out[open_] = depth
    return out


def repeated_windows(contexts: list[bytes], windows: list[int], length: int) -> list[np.ndarray]:
    """For each context, which of its first `windows` windows occur in another context or again in it."""
    joined = b"".join(c + bytes([_SEPARATOR]) for c in contexts)
    text = np.frombuffer(joined, np.uint8)
    depth = -(-(max(map(len, contexts)) + 1) // 8) * 8
    begins = np.cumsum([0, *(len(c) + 1 for c in contexts[:-1])])
    enough = RunLengthIndex.build(text, depth, begins).matching() >= length
    out, at = [], 0
    for c, n in zip(contexts, windows, strict=True):
        out.append(enough[at : at + n])
        at += len(c) + 1
    return out


def _digest(data: bytes) -> bytes:
    return hashlib.blake2b(data, digest_size=16).digest()


def _spans(marked: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.r_[0, marked.astype(np.int8), 0]))
    return [{"lo": int(a), "hi": int(b)} for a, b in zip(edge[::2], edge[1::2], strict=True)]


_SPANS = "array<struct<lo:long,hi:long>>"


def _anchors(texts: DataFrame, length: int) -> DataFrame:
    """(text_key, anchor, start, n, context_key): runs of windows of every text, with a digest of their bytes."""

    def run(batches):
        for batch in batches:
            keys, column = batch.column(0), plain_strings(batch.column(1))
            for first, data, offsets in slices(column):
                rows: list[tuple] = []
                digests: list[bytes] = []
                for d in range(len(offsets) - 1):
                    own = data[offsets[d] : offsets[d + 1]]
                    if len(own) >= length:
                        runs = _runs_of_text(own, length)
                        rows.append((first + d, *runs))
                        whole = memoryview(own.tobytes())
                        ends = runs[0] + runs[1] + length - 1
                        digests += [_digest(whole[x:y]) for x, y in zip(runs[0].tolist(), ends.tolist(), strict=True)]
                if rows:
                    owner = np.repeat([r[0] for r in rows], [len(r[1]) for r in rows])
                    start, n, h = (np.concatenate([r[i] for r in rows]) for i in (1, 2, 3))
                    yield pa.RecordBatch.from_arrays(
                        [keys.take(pa.array(owner)), pa.array(h.view(np.int64)), pa.array(start), pa.array(n), pa.array(digests, pa.binary())],
                        ["text_key", "anchor", "start", "n", "context_key"],
                    )

    return texts.mapInArrow(run, "text_key binary, anchor long, start long, n long, context_key binary")


_GROUPS = "anchor long, context_key binary, times long, n long, crowded boolean, context binary"


def _contexts(wanted: DataFrame, length: int) -> DataFrame:
    """(anchor, context_key, times, n, crowded, context) of (text, runs)."""

    def run(batches):
        for batch in batches:
            rows, size = [], 0
            for text, runs in zip(batch.column(0), batch.column(1), strict=True):
                data = (text.as_py() or "").encode()
                for r in runs.as_py():
                    context = data[r["start"] : r["start"] + r["n"] + length - 1]
                    rows.append((r["anchor"], r["context_key"], r["times"], r["n"], r["crowded"], context))
                    size += len(context)
                if size > 1 << 23:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    def _batch(rows):
        kinds = (pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.bool_(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["anchor", "context_key", "times", "n", "crowded", "context"])

    return wanted.mapInArrow(run, _GROUPS)


def _indexed(groups: DataFrame, length: int, index_bytes: int) -> DataFrame:
    """(anchor, context_key, spans) of (shard, anchor, context_key, times, n, context): runs of repeated windows."""

    def run(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values("anchor", kind="stable", ignore_index=True)
        frame = frame.drop_duplicates(["anchor", "context_key"], ignore_index=True)
        marked: list[np.ndarray] = [np.zeros(n, bool) for n in frame["n"]]
        size = frame["context"].map(len).to_numpy()
        anchors = frame["anchor"].to_numpy()
        begin = np.flatnonzero(np.r_[True, anchors[1:] != anchors[:-1]])
        end = np.r_[begin[1:], len(frame)]
        batch: list[int] = []
        for i, (a, b) in enumerate(zip(begin, end, strict=True)):
            batch += range(a, b)
            if batch and (i + 1 == len(begin) or size[batch].sum() + size[end[i] : end[i + 1]].sum() > index_bytes):
                found = repeated_windows([frame["context"][j] for j in batch], [int(frame["n"][j]) for j in batch], length)
                for j, more in zip(batch, found, strict=True):
                    marked[j] = marked[j] | more
                batch = []
        out = frame[["anchor", "context_key"]].copy()
        out["spans"] = [_spans(m) for m in marked]
        return out[out["spans"].map(len) > 0]

    return groups.groupBy("shard").applyInPandas(run, f"anchor long, context_key binary, spans {_SPANS}")


def _counted(groups: DataFrame, length: int) -> DataFrame:
    """The same of anchors with many contexts, by counting their windows."""

    def windows(batches):
        for batch in batches:
            for anchor, key, times, n, context in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
                rows = [_digest(context[i : i + length]) for i in range(n)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([anchor] * n), pa.array([key] * n, pa.binary()), pa.array(range(n), pa.int64()), pa.array(rows, pa.binary()), pa.array([times] * n)],
                    ["anchor", "context_key", "at", "window_key", "times"],
                )

    each = groups.select("anchor", "context_key", "times", "n", "context").mapInArrow(
        windows, "anchor long, context_key binary, at long, window_key binary, times long"
    )
    twice = each.groupBy("window_key").agg(F.sum("times").alias("all")).filter("all > 1").select("window_key")
    spans = F.transform(F.array_sort(F.collect_set("at")), lambda x: F.struct(x.alias("lo"), (x + 1).alias("hi")))
    return each.join(twice, "window_key").groupBy("anchor", "context_key").agg(spans.alias("spans"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, index_bytes: int = INDEX_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """`docs` with `n_bytes`, `n_removed`, `n_spans` and `kept` (binary): each byte covered by a string of `length` bytes
    that starts at another place too, in any document, is removed.

    Texts are their UTF-8 bytes; a null text is empty and shorter ones lose nothing. Every row is a document, also rows
    that share an id or a text: copies lose all they have. Columns of `docs` with the new names are replaced.
    """
    new = ("n_bytes", "n_removed", "n_spans", "kept", "text_key", "id_key")
    own = docs.drop(*new)
    text = F.coalesce("text", F.lit(""))
    keyed = own.withColumn("text_key", F.unhex(F.md5(text)))
    named = keyed.select("text_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id_key"), "text")
    long_enough = named.filter(F.octet_length("text") >= length)
    copies = long_enough.groupBy("text_key").agg(F.count("*").alias("copies"), F.min("id_key").alias("id_key"))
    copies = written(copies, "text-copies")

    anchors = written(_anchors(long_enough.select("text_key", "text"), length), "anchors")
    groups = anchors.groupBy("anchor", "context_key").agg(
        F.count("*").alias("times"), F.first("n").alias("n"), F.min(F.struct("text_key", "start")).alias("place")
    )
    groups = written(groups, "context-groups")
    sizes = groups.groupBy("anchor").agg(F.count("*").alias("different"), F.sum(F.col("n") + length - 1).alias("bytes"))
    sizes = written(sizes.filter("different > 1"), "anchor-sizes")
    n_shards = max(1, -(-(sizes.agg(F.sum("bytes")).first()[0] or 0) // shard_bytes))
    crowded = F.col("bytes") > index_bytes
    open_groups = groups.join(sizes.select("anchor", crowded.alias("crowded")), "anchor").select(
        "place.*", "anchor", "context_key", "times", "n", "crowded"
    )
    run = F.struct("anchor", "context_key", "times", "n", "crowded", "start")
    runs = open_groups.groupBy("text_key").agg(F.collect_list(run).alias("runs"))
    wanted = copies.select("text_key", "id_key").join(runs, "text_key")
    once = long_enough.dropDuplicates(["text_key", "id_key"])  # by the keys of the join, so it adds no shuffle
    contexts = _contexts(once.join(wanted, ["text_key", "id_key"]).select("text", "runs"), length)

    shard = F.pmod(F.xxhash64("anchor"), F.lit(n_shards)).alias("shard")
    if sizes.filter(crowded).take(1):
        contexts = written(contexts, "contexts")
        found = _indexed(contexts.filter("NOT crowded").select(shard, "*"), length, index_bytes)
        found = found.unionByName(_counted(contexts.filter("crowded"), length))
    else:
        found = _indexed(contexts.select(shard, "*"), length, index_bytes)
    whole = groups.filter("times > 1").select(
        "anchor", "context_key", F.array(F.struct(F.lit(0).cast("long").alias("lo"), F.col("n").alias("hi"))).alias("spans")
    )
    found = written(found.unionByName(whole), "context-spans")
    places = anchors.select("text_key", "anchor", "start", "context_key").join(found, ["anchor", "context_key"])
    span = F.transform("spans", lambda s: F.struct((s["lo"] + F.col("start")).alias("lo"), (s["hi"] + F.col("start") + length - 1).alias("hi")))
    marks = places.select("text_key", F.explode(span).alias("span")).groupBy("text_key").agg(F.collect_set("span").alias("spans"))
    marks = copies.select("text_key", "copies").join(marks, "text_key", "left").filter("copies > 1 OR spans IS NOT NULL")
    joined = keyed.join(written(marks, "marks"), "text_key", "left")
    cut = _cut("text", F.coalesce("copies", F.lit(1)) > 1, "spans")
    return joined.withColumn("cut", cut).select(*own.columns, "cut.n_bytes", "cut.n_removed", "cut.n_spans", "cut.kept")


_CUT = T.StructType([
    T.StructField("n_bytes", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
    T.StructField("kept", T.BinaryType()),
])


@F.pandas_udf(_CUT)
def _cut(texts: pd.Series, whole: pd.Series, spans: pd.Series) -> pd.DataFrame:
    rows = []
    for text, everything, own in zip(texts, whole, spans, strict=True):
        data = (text or "").encode()
        if everything:
            rows.append((len(data), len(data), 1, b""))
            continue
        merged: list[list[int]] = []
        for s in sorted((s["lo"], s["hi"]) for s in own) if own is not None else ():
            if merged and s[0] <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], s[1])
            else:
                merged.append(list(s))
        edges = [0, *(x for s in merged for x in s), len(data)]
        kept = b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True))
        rows.append((len(data), len(data) - len(kept), len(merged), kept))
    return pd.DataFrame(rows, columns=["n_bytes", "n_removed", "n_spans", "kept"])
