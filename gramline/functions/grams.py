"""Counting n-grams inside tasks: Spark cuts the texts into words, and an Arrow pass cuts each different word of a run of
rows once. What a task holds is bounded by a batch of rows and by `WORDS` words, besides the longest row."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WORDS = 1 << 17  # words that are cut at once


def word_grams(word: str, lo: int, hi: int) -> list[str]:
    padded = f" {word} "
    n = len(padded)
    return [padded[i : i + k] for k in range(lo, min(hi, n) + 1) for i in range(n + 1 - k)] or [padded]


def _numbered(words: list[str], lo: int, hi: int, known: dict[str, int] | None) -> tuple[np.ndarray, np.ndarray, list[str]]:
    """(grams of each word, the numbers of all of them, the grams by number). With `known` grams only these, by their numbers."""
    sizes, numbers = np.empty(len(words), np.int64), []
    found: dict[str, int] = {}
    for i, word in enumerate(words):
        before, grams = len(numbers), word_grams(word, lo, hi)
        if known is None:
            numbers.extend([found.setdefault(g, len(found)) for g in grams])
        else:
            numbers.extend([known[g] for g in grams if g in known])
        sizes[i] = len(numbers) - before
    return sizes, np.array(numbers, np.int64), list(found)


def counted(
    row: np.ndarray, words: pa.Array, times: np.ndarray | None, lo: int, hi: int, known: dict[str, int] | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[str]]:
    """(row, gram number, tf) of words that lie in numbered rows, ascending, and the grams by number unless they are `known`.
    With `times` each word comes once in a row."""
    coded = words.dictionary_encode()
    different = coded.dictionary.to_pylist()
    pair = row * len(different) + coded.indices.to_numpy().astype(np.int64)
    if times is None:
        pair, times = np.unique(pair, return_counts=True)
    sizes, numbers, grams = _numbered(different, lo, hi, known)
    span = max(1, len(grams) if known is None else len(known))
    row, word = np.divmod(pair, max(1, len(different)))
    n = sizes[word]
    who = np.repeat(np.arange(len(pair)), n)
    entry = np.arange(len(who)) + np.repeat((np.cumsum(sizes) - sizes)[word] - (np.cumsum(n) - n), n)
    code = row[who] * span + numbers[entry]
    order = np.argsort(code)
    code = code[order]
    begin = np.flatnonzero(np.r_[True, code[1:] != code[:-1]][: len(code)])
    tf = np.add.reduceat(times[who[order]], begin) if len(begin) else np.zeros(0, np.int64)
    return *np.divmod(code[begin], span), tf, grams


def _runs(counts: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int]]:
    """Runs of rows with about WORDS words that begin at some of these starts."""
    before = np.r_[0, np.cumsum(counts)]
    edges = np.r_[starts, len(counts)]
    at = 0
    while at < len(edges) - 1:
        upto = max(at + 1, int(np.searchsorted(before[edges], before[edges[at]] + WORDS, "right")) - 1)
        yield int(edges[at]), int(edges[upto])
        at = upto


def _lengths(words: pa.Array) -> np.ndarray:
    return words.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _groups(batches) -> Iterator[tuple[pa.Array, np.ndarray, pa.Array, np.ndarray | None]]:
    """(ids, id's place of each word, words, times) of rows (id, words) whose equal ids follow one another, each id once."""
    held = None  # the last id so far and its words

    def flush():
        id, bag = held
        return id, np.zeros(len(bag), np.int64), pa.array(list(bag), pa.string()), np.array(list(bag.values()), np.int64)

    for batch in batches:
        if not batch.num_rows:
            continue
        id, words = batch.column(0), batch.column(1)
        code = id.dictionary_encode(null_encoding="encode").indices.to_numpy()
        starts = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
        edges = np.r_[starts, batch.num_rows]
        begun = 0
        if held is not None:
            joint = pa.concat_arrays([held[0], id.slice(0, 1)]).dictionary_encode(null_encoding="encode")
            if len(joint.dictionary) == 1:
                held[1].update(words.slice(0, int(edges[1])).flatten().to_pylist())
                begun = 1
                if begun == len(starts):
                    continue
            yield flush()
        last = int(starts[-1])
        lengths = _lengths(words)
        if begun < len(starts) - 1:
            first = int(edges[begun])
            for low, high in _runs(lengths[first:last], starts[begun:-1] - first):
                low, high = low + first, high + first
                own = starts[(starts >= low) & (starts < high)]
                place = np.searchsorted(own, np.arange(low, high), "right") - 1
                yield id.take(pa.array(own)), np.repeat(place, lengths[low:high]), words.slice(low, high - low).flatten(), None
        held = id.slice(last, 1), Counter(words.slice(last).flatten().to_pylist())
    if held is not None:
        yield flush()


def term_frequencies(batches, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
    """(id, gram, tf) of rows (id, words)."""
    for ids, row, words, times in _groups(batches):
        row, gram, tf, grams = counted(row, words, times, lo, hi)
        if len(row):
            columns = [ids.take(pa.array(row)), pa.array(grams, pa.string()).take(pa.array(gram)), pa.array(tf.astype(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["id", "gram", "tf"])


def weighed(batches, lo: int, hi: int, vocabulary: pa.Table) -> Iterator[pa.RecordBatch]:
    """(id, gram, what else the vocabulary (gram, idf, ...) has, tfidf) of rows (id, words), each id scaled to length 1."""
    vocabulary = vocabulary.combine_chunks()
    known = {g: i for i, g in enumerate(vocabulary.column("gram").to_pylist())}
    idf = vocabulary.column("idf").to_numpy()
    carried = vocabulary.drop_columns("idf")
    names = ["id", *carried.column_names, "tfidf"]
    for ids, row, words, times in _groups(batches):
        row, gram, tf, _ = counted(row, words, times, lo, hi, known)
        if len(row):
            raw = tf * idf[gram]
            value = raw / np.sqrt(np.bincount(row, raw * raw, len(ids)))[row]
            own = carried.take(pa.array(gram)).combine_chunks()
            columns = [c.chunk(0) for c in own.columns]
            yield pa.RecordBatch.from_arrays([ids.take(pa.array(row)), *columns, pa.array(value)], names)


def document_frequencies(batches, lo: int, hi: int) -> Iterator[pa.RecordBatch]:
    """(by, gram, df) of rows (by, words), one document each, in parts that add up."""
    for batch in batches:
        if not batch.num_rows:
            continue
        words = batch.column(1)
        coded = batch.column(0).dictionary_encode(null_encoding="encode")
        lengths, by = _lengths(words), coded.indices.to_numpy().astype(np.int64)
        for low, high in _runs(lengths, np.arange(len(lengths))):
            row = np.repeat(np.arange(high - low), lengths[low:high])
            row, gram, _, grams = counted(row, words.slice(low, high - low).flatten(), None, lo, hi)
            if len(row):
                pair, n = np.unique(by[low:high][row] * len(grams) + gram, return_counts=True)
                place, gram = np.divmod(pair, len(grams))
                columns = [coded.dictionary.take(pa.array(place)), pa.array(grams, pa.string()).take(pa.array(gram)), pa.array(n)]
                yield pa.RecordBatch.from_arrays(columns, ["by", "gram", "df"])
