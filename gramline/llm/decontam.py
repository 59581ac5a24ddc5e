"""Benchmark decontamination: edit distance by CGK embedding, bit sampling and exact verification.

Texts are compared as sequences of words (A-Z lower-cased, punctuation at the ends left out) within an edit distance of
a fifth of the item's words. The CGK embedding walks over a sequence and repeats or leaves each word by a random bit of
(step, word), so that two sequences within a small edit distance agree in most steps. Each repetition samples a few
steps of its own walk as a key; a window of a document, as long as an item, is a candidate for the items that share a
key with it, and candidates are verified by the exact distance of the item to the best part of the text there.

Windows are embedded only where a match is possible: an item within k edits keeps all but q*k of its runs of q words,
so windows that hold fewer runs of the items of their length are passed over. That loses nothing.

Two walks part further the longer the sequence is, so items of more than `PIECE_WORDS` words are cut into pieces of
nearly equal length. Of m pieces, one has at most an m-th of the edits, which is within a fifth of its own words; so each
piece is searched as an item of its length, and where one is met the whole item is verified around it, after a count of
the whole item's runs there.

Recall at the bound itself, with edits spread at random, is over 0.95 at every length (tests/llm measures it); copies
with fewer edits are found nearly always, exact ones always.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import Words, mix64, plain_strings, slices

EDIT_SHARE = 0.2
LEAST_WORDS = 5
REPETITIONS = 32
SAMPLES = 3
PIECE_WORDS = 24
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 1 << 23
WINDOW_BLOCK = 1 << 14
HELD_WORDS = 1 << 22
_RUN_MIX = [np.uint64(c) for c in (0x9FB21C651E98DF25, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
_PAD = np.uint64(0)


def edits_allowed(n: int) -> int:
    return int(EDIT_SHARE * n + 1e-9)


def run_length(n: int) -> tuple[int, int]:
    """(q, least): within the allowed edits an item of n words keeps at least `least` of its runs of q words."""
    k = edits_allowed(n)
    for q in (3, 2):
        if (least := n - q + 1 - q * k) >= 2:
            return q, least
    return 1, max(1, n - k)


def _runs(keys: np.ndarray, q: int) -> np.ndarray:
    """A hash of the q words from each place on; the last q - 1 places have none."""
    n = max(0, len(keys) - q + 1)
    out = np.zeros(n, np.uint64)
    for i in range(q):
        out += keys[i : i + n] * _RUN_MIX[i]
    return mix64(out)


def embed(windows: np.ndarray, n: int, repetitions: int, samples: int) -> np.ndarray:
    """Keys (repetition, window) of the CGK embeddings of `windows` (window, word), made for items of n words."""
    rng = np.random.default_rng(n)
    steps = 2 * n
    salts = rng.integers(0, 1 << 63, (repetitions, steps), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    chosen = np.argsort(rng.random((repetitions, steps)), axis=1) < samples
    pointer = np.zeros((repetitions, len(windows)), np.int64)
    rows = np.arange(len(windows))
    width = windows.shape[1]
    out = np.zeros((repetitions, len(windows)), np.uint64)
    for j in range(steps):
        word = windows[rows, np.minimum(pointer, width - 1)]
        used = np.flatnonzero(chosen[:, j])
        if len(used):
            out[used] = mix64(out[used] * _RUN_MIX[0] ^ word[used])
        pointer += ((word * salts[:, j, None]) >> np.uint64(63)).astype(np.int64)
    return out


def best_part(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(distance, first, last): the part text[first:last] nearest to the item in edits, the earliest end first."""
    distance, ends = _table(item, text, free=True)
    last = int(ends)
    back, length = _table(item[::-1], text[:last][::-1], free=False)
    return distance, last - int(length), last


def _table(item: np.ndarray, text: np.ndarray, free: bool) -> tuple[int, int]:
    """The least edits from the item to a prefix of the text (`free`: to any part), and where it ends."""
    at = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64) if free else at.copy()
    for i, word in enumerate(item, 1):
        new = row + 1
        new[1:] = np.minimum(new[1:], row[:-1] + (text != word))
        new[0] = i
        row = np.minimum.accumulate(new - at) + at
    return int(row.min()), int(row.argmin())


class ItemIndex:
    """Items in pieces of at most PIECE_WORDS words; pieces by length: their runs, and their keys of every repetition."""

    def __init__(self, ids, texts, repetitions: int = REPETITIONS, samples: int = SAMPLES, least_words: int = LEAST_WORDS):
        self.ids, self.repetitions, self.samples = ids, repetitions, samples
        self.words: list[np.ndarray] = []
        for _, data, offsets in slices(plain_strings(pa.array(texts, pa.string()))):
            words = Words(data, offsets, strip=True)
            self.words += [words.key[a:b] for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
        pieces = []
        for i, own in enumerate(self.words):
            m = -(-len(own) // PIECE_WORDS) if len(own) >= max(1, least_words) else 0
            edges = [len(own) * j // m for j in range(m + 1)] if m else []
            pieces += [(i, at, end - at) for at, end in zip(edges, edges[1:])]
        self.piece_item, self.piece_at, size = np.array(pieces, np.int64).reshape(-1, 3).T
        self.by_length = {int(n): np.flatnonzero(size == n) for n in np.unique(size)}
        self.item_runs: dict[int, np.ndarray] = {}
        self.runs, self.keys = {}, {}
        for n, members in self.by_length.items():
            matrix = np.full((len(members), n + 1), _PAD)
            for row, p in zip(matrix, members, strict=True):
                row[:n] = self.words[self.piece_item[p]][self.piece_at[p] : self.piece_at[p] + n]
            q, _ = run_length(n)
            self.runs[n] = np.unique(np.concatenate([_runs(row[:n], q) for row in matrix]))
            keys = embed(matrix, n, repetitions, samples)
            order = np.argsort(keys, axis=1)
            self.keys[n] = (np.take_along_axis(keys, order, 1), members[order])
        kinds = {q: [r for n, r in self.runs.items() if run_length(n)[0] == q] for q in (1, 2, 3)}
        self.marks = {q: _mark_table(np.concatenate(runs)) for q, runs in kinds.items() if runs}

    def windows(self, words: Words) -> list[tuple[int, np.ndarray]]:
        """(length, first words) of windows that may match a piece of that length."""
        out = []
        held = {}
        for q, marks in self.marks.items():
            runs = _runs(words.key, q)
            rough = np.flatnonzero(marks[(runs >> np.uint64(40)).astype(np.int64)])
            rough = rough[words.doc[rough] == words.doc[rough + q - 1]]
            held[q] = (rough, runs[rough])
        for n in self.by_length:
            q, least = run_length(n)
            k = edits_allowed(n)
            place, runs = held[q]
            hits = place[np.isin(runs, self.runs[n])]
            if len(hits) < least:
                continue
            # A window from s holds the runs at s - k to s + n + k; `least` hits in a row must fit.
            near = np.flatnonzero((hits[least - 1 :] - hits[: len(hits) - least + 1]) <= n + 2 * k)
            if not len(near):
                continue
            low, high = hits[near + least - 1] - n - k, hits[near] + k
            edge = np.zeros(len(words.key) + 1, np.int64)
            np.add.at(edge, np.clip(low, 0, None), 1)
            np.add.at(edge, np.clip(high + 1, 0, len(words.key)), -1)
            starts = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
            out.append((n, starts))
        return out

    def candidates(self, n: int, windows: np.ndarray) -> np.ndarray:
        """(window, piece) pairs that share a key, without repeats."""
        keys = embed(windows, n, self.repetitions, self.samples)
        own, members = self.keys[n]
        found = [np.zeros((0, 2), np.int64)]
        for r in range(self.repetitions):
            a = np.searchsorted(own[r], keys[r], "left")
            b = np.searchsorted(own[r], keys[r], "right")
            hit = np.flatnonzero(b > a)
            size = (b - a)[hit]
            piece = members[r][np.repeat(a[hit], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
            found.append(np.stack([np.repeat(hit, size), piece], axis=1))
        return np.unique(np.concatenate(found), axis=0)

    def leaks(self, column: pa.Array) -> list[list[dict]]:
        """The matches of each text: at most one per item, its best part."""
        out: list[dict[int, dict]] = [{} for _ in range(len(column))]
        texts, row, n_windows, n_words = [], 0, 0, 0
        for first, data, offsets in slices(column):
            words = Words(data, offsets, strip=True)
            texts.append((words.key, words.first, self.windows(words)))
            n_windows += sum(len(starts) for _, starts in texts[-1][2])
            n_words += len(words.key)
            if n_windows >= WINDOW_BLOCK or n_words >= HELD_WORDS:
                self._match(texts, out, row)
                texts, row, n_windows, n_words = [], first + len(offsets) - 1, 0, 0
        self._match(texts, out, row)
        return [[hits[i] for i in sorted(hits)] for hits in out]

    def _match(self, texts: list, out: list[dict[int, dict]], row: int) -> None:
        """Adds the matches of `texts`, (words, first words, windows) of the rows from `row` on, to `out`."""
        base = np.cumsum([0] + [len(key) for key, _, _ in texts])
        key = np.concatenate([*(key for key, _, _ in texts), np.full(PIECE_WORDS + 1, _PAD)])
        edges = np.concatenate([*(first[:-1] + at for (_, first, _), at in zip(texts, base)), base[-1:]])
        spans = [np.zeros((0, 4), np.int64)]
        for n in self.by_length:
            starts = [s + at for (_, _, found), at in zip(texts, base) for length, s in found if length == n]
            starts = np.concatenate(starts) if starts else np.zeros(0, np.int64)
            for a in range(0, len(starts), WINDOW_BLOCK):
                start = starts[a : a + WINDOW_BLOCK]
                doc = np.searchsorted(edges, start, "right") - 1
                # The word after the window stays: a piece whose copy gained words runs into it.
                place = start[:, None] + np.arange(n + 1)
                matrix = np.where(place < edges[doc + 1][:, None], key[place], _PAD)
                window, piece = self.candidates(n, matrix).T
                item, at = self.piece_item[piece], start[window] - self.piece_at[piece]
                size = np.array([len(self.words[i]) for i in item], np.int64)
                k = np.array([edits_allowed(i) for i in size], np.int64)
                low, high = np.maximum(at - k, edges[doc[window]]), np.minimum(at + size + k, edges[doc[window] + 1])
                spans.append(np.stack([doc[window], item, low, high], axis=1))
        doc, item, low, high = np.unique(np.concatenate(spans), axis=0).T
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (low[1:] > high[:-1])
        begin = np.flatnonzero(new)
        last = np.r_[begin[1:], len(doc)][: len(begin)] - 1
        for d, i, lo, hi in zip(doc[begin], item[begin], low[begin], high[last], strict=True):
            if self._possible(i, key[lo:hi]):
                self._verify(out[row + d], i, key[lo:hi], lo - edges[d])

    def _possible(self, item: int, text: np.ndarray) -> bool:
        """Whether the text holds as many places with runs of the item as a copy keeps."""
        q, least = run_length(len(self.words[item]))
        if item not in self.item_runs:
            self.item_runs[item] = np.unique(_runs(self.words[item], q))
        return np.isin(_runs(text, q), self.item_runs[item]).sum() >= least

    def _verify(self, held: dict[int, dict], item: int, text: np.ndarray, lo: int) -> None:
        """Keeps the part of `text`, which starts at word `lo`, nearest to the item if it is a match and the best so far."""
        distance, begins, ends = best_part(self.words[item], text)
        old = held.get(item)
        if distance <= edits_allowed(len(self.words[item])) and (old is None or distance < old["distance"]):
            held[item] = {
                "item_id": self.ids[item], "distance": distance, "first_word": int(lo + begins), "last_word": int(lo + ends),
            }


def _mark_table(runs: np.ndarray) -> np.ndarray:
    table = np.zeros(1 << 24, bool)
    table[(runs >> np.uint64(40)).astype(np.int64)] = True
    return table


_LEAK = T.StructType(
    [T.StructField("item_id", T.LongType()), T.StructField("distance", T.IntegerType()), T.StructField("first_word", T.IntegerType()),
     T.StructField("last_word", T.IntegerType())]
)


def find_leaks(
    docs: DataFrame, items: DataFrame, repetitions: int = REPETITIONS, samples: int = SAMPLES, block_items: int = BLOCK_ITEMS,
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """`docs` with `leaks`: for each item of (item_id, text) found in the text, its id, the edit distance, and the words
    of the text that hold it, as [first_word, last_word).

    Items go to the tasks in blocks of about `block_items` items and BLOCK_BYTES bytes of text at most. Items of fewer than `least_words` words, null and empty ones
    match nothing, those of one to four words match exactly if they are let in; null and empty documents hold nothing;
    items that repeat an id or a text each count. A column of `docs` named `leaks` is replaced. Documents are not shuffled.
    """
    spark = docs.sparkSession
    own = docs.drop("leaks")
    items = items.select(F.col("item_id").cast("long"), "text").filter("text IS NOT NULL")
    n_items, n_bytes = items.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n_blocks = max(1, -(-n_items // block_items), -(-(n_bytes or 0) // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    at = own.columns.index("text")
    kind = pa.list_(pa.struct([("item_id", pa.int64()), ("distance", pa.int32()), ("first_word", pa.int32()), ("last_word", pa.int32())]))
    out = own.withColumn("leaks", F.array().cast(T.ArrayType(_LEAK)))
    for i in range(n_blocks):
        rows = items.filter(block == i).collect()
        shared = spark.sparkContext.broadcast(([r["item_id"] for r in rows], [r["text"] for r in rows]))

        def search(batches, shared=shared):
            index = ItemIndex(*shared.value, repetitions, samples, least_words)
            for batch in batches:
                found = pa.array(index.leaks(plain_strings(batch.column(at))), kind)
                yield pa.RecordBatch.from_arrays([*batch.columns, found], names=[*batch.schema.names, "more"])

        wider = T.StructType([*out.schema.fields, T.StructField("more", T.ArrayType(_LEAK))])
        out = out.mapInArrow(search, wider).withColumn("leaks", F.concat("leaks", "more")).drop("more")
    return out
