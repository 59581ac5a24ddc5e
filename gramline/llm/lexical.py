"""Ranked lexical search by scanning documents with an automaton of all items' terms.

A term is a maximal run of letters and digits (ASCII) and other code points from 128 on, A-Z lower-cased. Texts are
turned, byte by byte, into terms between single guards; the automaton holds every item's terms with a guard at both
ends, so that its matches are whole terms, and it gives their frequencies straight from the text. No index of the
documents is built: one scan counts documents, terms and the documents that hold each term, a second one scores. Each
automaton output leads to the items that hold the term, and a task keeps the best documents per item.

Items go to the tasks in blocks of bounded size, each block with scans of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramline.llm.arrays import plain_strings
from gramline.plans.storage import written

BLOCK_BYTES = 4 << 20  # of items' text to a block; its automaton takes some hundred times that
SLICE_BYTES = 1 << 20
CELLS = 1 << 22  # scores held at once
N_DOCUMENTS, N_TERMS = -1, -2
FOUND = "item long, item_id long, doc_id long, score long"

_GUARD = 32
_TABLE = bytearray([_GUARD] * 128 + list(range(128, 256)))
for _c in range(128):
    if chr(_c).isalnum():
        _TABLE[_c] = ord(chr(_c).lower())
_TABLE = bytes(_TABLE)


def terms_of(text: str | None) -> list[bytes]:
    return [t for t in (text or "").encode().translate(_TABLE).split(b" ") if t]


class Block:
    """Some items: their different terms, and for each term the items that hold it and how often, as flat arrays."""

    def __init__(self, items: list[tuple[int, int | None, str | None]]):
        self.item = [i for i, _, _ in items]
        self.item_id = [i for _, i, _ in items]
        number: dict[bytes, int] = {}
        held = [[number.setdefault(t, len(number)) for t in terms_of(text)] for _, _, text in items]
        self.terms = list(number)
        item = np.repeat(np.arange(len(items)), [len(t) for t in held])
        pair, times = np.unique(np.array(list(chain.from_iterable(held)), np.int64) * max(1, len(items)) + item, return_counts=True)
        self.posting_item, self.posting_times = pair % max(1, len(items)), times.astype(np.int64)
        self.first = np.searchsorted(pair // max(1, len(items)), np.arange(len(number) + 1))

    def automaton(self):
        import ahocorasick

        found = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        for i, term in enumerate(self.terms):
            found.add_word(f" {term.decode('latin-1')} ", i)
        found.make_automaton()
        return found


def _scanned(batches, block: Block):
    """(ids, n, doc, term, tf) for runs of rows: the number of terms of each row, and the frequency of every item term in
    every row that holds it."""
    automaton = block.automaton() if block.terms else None
    width = max(1, len(block.terms))
    for batch in batches:
        texts = plain_strings(batch.column(1))
        ends = np.cumsum(np.asarray(pc.binary_length(texts), np.int64))
        first = 0
        while first < len(texts):
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
            parts = [t.encode().translate(_TABLE) for t in texts[first:last].to_pylist()]
            guarded = b" " + b" ".join(parts) + b" "
            stop = np.cumsum([len(p) + 1 for p in parts])  # the guard after each row
            solid = np.frombuffer(guarded, np.uint8) != _GUARD
            starts = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
            n = np.bincount(np.searchsorted(stop, starts), minlength=len(parts)).astype(np.int64)
            hits = np.zeros((0, 2), np.int64)
            if automaton is not None:
                flat = chain.from_iterable(automaton.iter(guarded.decode("latin-1")))
                hits = np.fromiter(flat, np.int64).reshape(-1, 2)
            key, tf = np.unique(np.searchsorted(stop, hits[:, 0]) * width + hits[:, 1], return_counts=True)
            yield batch.column(0)[first:last], n, key // width, key % width, tf.astype(np.int64)
            first = last


def _statistics(docs: DataFrame, shared) -> dict[int, int]:
    """How many documents hold each term of the block, how many have any term, and how many terms all have."""

    def run(batches):
        block = shared.value
        held, documents, total = np.zeros(len(block.terms), np.int64), 0, 0
        for _, n, _, term, _ in _scanned(batches, block):
            held += np.bincount(term, minlength=len(held))
            documents += int((n > 0).sum())
            total += int(n.sum())
        own = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.r_[own, N_DOCUMENTS, N_TERMS]), pa.array(np.r_[held[own], documents, total])], ["term", "n"]
        )

    counted = docs.mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {row["term"]: row["n"] for row in counted.collect()}


class Best:
    """The k best documents of each item so far; equal scores go by ascending document, null last."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.item, self.score, self.doc = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.null = np.zeros(0, bool)
        self.least = np.ones(items, np.int64)  # what a document must score to be looked at

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        item, score = np.r_[self.item, item], np.r_[self.score, score]
        doc, null = np.r_[self.doc, doc], np.r_[self.null, null]
        order = np.lexsort((doc, null, -score, item))
        begin = np.searchsorted(item[order], item[order])
        kept = order[np.arange(len(order)) - begin < self.k]
        self.item, self.score, self.doc, self.null = item[kept], score[kept], doc[kept], null[kept]
        count = np.bincount(self.item, minlength=len(self.least))
        full = np.flatnonzero(count >= self.k)
        self.least[full] = self.score[np.searchsorted(self.item, full, "right") - 1]


def _add_scores(best: Best, ids: pa.Array, doc: np.ndarray, term: np.ndarray, value: np.ndarray, block: Block) -> None:
    """Scores a run of rows against all items of the block, some rows at a time."""
    items = len(block.item)
    own_ids, null = ids.fill_null(0).to_numpy(zero_copy_only=False), ids.is_null().to_numpy(zero_copy_only=False)
    rows = max(1, CELLS // items)
    n = block.first[term + 1] - block.first[term]
    for low in range(0, len(own_ids), rows):
        part = slice(*np.searchsorted(doc, [low, low + rows]))
        count = n[part]
        entry = np.repeat(np.arange(part.start, part.stop), count)
        posting = np.arange(len(entry)) - np.repeat(np.cumsum(count) - count, count) + block.first[term[entry]]
        score = np.zeros((min(rows, len(own_ids) - low), items), np.int64)
        np.add.at(score.ravel(), (doc[entry] - low) * items + block.posting_item[posting], value[entry] * block.posting_times[posting])
        at, item = np.nonzero(score >= best.least[None, :])
        best.add(item, score[at, item], own_ids[at + low], null[at + low])


def _block_search(docs: DataFrame, block: Block, k: int) -> DataFrame:
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(block)
    counted = _statistics(docs, shared)
    documents, total = counted.get(N_DOCUMENTS, 0), counted.get(N_TERMS, 0)
    held = np.array([counted.get(t, 0) for t in range(len(block.terms))], np.float64)
    weight = np.floor(1000 * np.log((2 * documents + 2) / (2 * held + 1))).astype(np.int64)

    def run(batches):
        block = shared.value
        best = Best(len(block.item), k)
        for ids, n, doc, term, tf in _scanned(batches, block):
            m = 25 + (75 * n * documents) // max(1, total)
            value = weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
            _add_scores(best, ids, doc, term, value, block)
        item = np.array(block.item, np.int64)[best.item]
        item_id = pa.array(block.item_id, pa.int64()).take(pa.array(best.item))
        yield pa.RecordBatch.from_arrays(
            [pa.array(item), item_id, pa.array(best.doc, mask=best.null), pa.array(best.score)],
            ["item", "item_id", "doc_id", "score"],
        )

    return docs.mapInArrow(run, FOUND)


def _blocks(items: DataFrame, limit: int) -> Iterator[list[tuple]]:
    """Items (item, item_id, text) dealt by hash into blocks of at most `limit` bytes of text, or one larger item; each
    is collected on its own."""
    blocks = 1
    while True:
        dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
        sizes = dealt.groupBy("block").agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 32).alias("size"), F.count("*").alias("n"))
        if sizes.filter((F.col("size") > limit) & (F.col("n") > 1)).isEmpty():
            break
        blocks *= 2
    for block in range(blocks):
        own = dealt.filter(F.col("block") == block).orderBy("item").select("item", "item_id", "text").collect()
        if own:
            yield [tuple(r) for r in own]


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, rank, doc_id, score): each item's k best documents with a score above 0, best first, equal ones by
    ascending doc_id.

    Every row of `items` is an item and every row of `docs` a document, whatever its id; a null id comes last among
    equal scores. Null and empty texts have no terms. Without items or documents there are no rows. Other columns than
    `doc_id`, `item_id` and `text` are not carried.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long"), "text")
    numbered = items.select(F.monotonically_increasing_id().alias("item"), F.col("item_id").cast("long"), "text")
    found = [_block_search(rows, Block(own), k) for own in _blocks(written(numbered, "items"), block_bytes)]
    if not found:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")
