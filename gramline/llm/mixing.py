"""Mixing sources to target weights.

The words of a source, in table order, are packed into blocks of a fixed length. The mix is a number of slots per
source, dealt to output shards by multinomial draws; a slot's number goes through a pseudorandom permutation of its
source's block numbers, one permutation for each pass over the source, and the blocks are joined by number.

A source's slots are fixed to its target first and then dealt to shards with equal chances, which is the law of
independent draws of (shard, source) given the totals: targets are met to within a block.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm import numbering
from gramline.llm.arrays import Words, mix64, plain_strings, word_counts
from gramline.plans.lookup import BROADCAST_BYTES
from gramline.plans.storage import written

BLOCK_WORDS = 64
SHARD_WORDS = 1 << 18
MOST_REPEATS = 2
SHARE = 1.5
WEIGHTS = (5.0, 2.0, 1.0)
SEED = 20


def targets(sizes, weights, total: float, most: float = MOST_REPEATS) -> np.ndarray:
    """Shares of `total` by weight; a share stops at `most` times its size and the rest is shared anew until none is above."""
    sizes, weights = np.asarray(sizes, float), np.asarray(weights, float)
    out, cap = np.zeros(len(sizes)), most * sizes
    free = np.ones(len(sizes), bool)
    while free.any():
        share = (total - out[~free].sum()) * weights / weights[free].sum()
        over = free & (share > cap)
        if not over.any():
            out[free] = share[free]
            break
        out[over] = cap[over]
        free &= ~over
    return out


def permuted(index: np.ndarray, size: int, key: int) -> np.ndarray:
    """Where a pseudorandom permutation of range(size) sends each index: a Feistel network, walked until inside."""
    half = max(1, -(-(size - 1).bit_length() // 2))
    low, shift = np.uint64((1 << half) - 1), np.uint64(half)

    def once(x):
        left, right = x >> shift, x & low
        for r in range(4):
            salt = np.uint64((key * 4 + r + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF)
            left, right = right, left ^ (mix64(right + salt) & low)
        return left << shift | right

    out = once(index.astype(np.uint64))
    while (outside := np.flatnonzero(out >= size)).size:
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def _listed(docs: DataFrame) -> DataFrame:
    """(source, source_no): sources numbered by code point, null last. The driver sees each source's name once."""
    names = [r["source"] for r in docs.select("source").distinct().collect()]
    order = sorted(names, key=lambda s: (s is None, s or ""))
    table = docs.sparkSession.createDataFrame(list(zip(order, range(len(order)))), "named string, source_no long")
    return _if_small(table, sum(len((s or "").encode()) + 16 for s in order))


def _if_small(table: DataFrame, n_bytes: int) -> DataFrame:
    """The table, to be broadcast if its size allows."""
    return F.broadcast(table) if n_bytes <= BROADCAST_BYTES else table


def _sources(rows: DataFrame, weights, share: float) -> pd.DataFrame:
    """One row per source, in order: its words and target."""
    totals = {r["source_no"]: r["n"] for r in rows.groupBy("source_no").agg(F.sum("size").alias("n")).collect()}
    sizes = np.array([totals[i] for i in range(len(totals))], np.int64)
    weight = np.array([weights[i % len(weights)] for i in range(len(sizes))])
    return pd.DataFrame({"words": sizes, "target": targets(sizes, weight, share * sizes.sum())})


def _slots(spark, sources: pd.DataFrame, block_words: int, shard_words: int, seed: int) -> DataFrame:
    """(out_shard, source_no, pass_no, block): the mix, one row per slot."""
    blocks = -(-sources["words"].to_numpy() // block_words)
    mean = np.divide(sources["words"], blocks, out=np.ones(len(sources)), where=blocks > 0)
    draws = np.minimum(MOST_REPEATS * blocks, np.rint(sources["target"].to_numpy() / mean)).astype(np.int64)
    n_shards = max(1, int(sources["target"].sum() // shard_words))
    per_range = max(8, -(-n_shards // 4096))
    edges = np.r_[np.arange(0, n_shards, per_range), n_shards]
    rng = np.random.default_rng(seed)
    by_range = np.array([rng.multinomial(d, np.diff(edges) / n_shards) for d in draws], np.int64).reshape(len(draws), len(edges) - 1)
    first = np.cumsum(by_range, axis=1) - by_range
    rows = [
        (i, int(edges[i]), int(edges[i + 1]), by_range[:, i].tolist(), first[:, i].tolist())
        for i in range(len(edges) - 1)
    ]
    n_blocks = blocks.tolist()

    def deal(frames):
        for frame in frames:
            for number, lo, hi, counts, starts in frame.itertuples(index=False):
                own = np.random.default_rng([seed, number])
                for s, (count, start) in enumerate(zip(counts, starts, strict=True)):
                    per_shard = own.multinomial(count, np.full(hi - lo, 1 / (hi - lo)))
                    shard = np.repeat(np.arange(lo, hi), per_shard)
                    for at in range(0, count, 1 << 18):
                        slot = np.arange(start + at, start + min(count, at + (1 << 18)))
                        turn, index = np.divmod(slot, n_blocks[s])
                        block = np.empty(len(slot), np.int64)
                        for t in np.unique(turn):
                            block[turn == t] = permuted(index[turn == t], n_blocks[s], (seed * 1_000_003 + s) * 64 + int(t))
                        yield pd.DataFrame(
                            {"out_shard": shard[at : at + len(slot)], "source_no": s, "pass_no": turn, "block": block}
                        )

    schema = "number long, lo long, hi long, counts array<long>, starts array<long>"
    plan = spark.createDataFrame(rows, schema).repartition(max(1, min(len(rows), 4096)))
    return plan.mapInPandas(deal, "out_shard long, source_no long, pass_no long, block long")


class Mix:
    """A mix of `docs`. `rows` has the documents with their size, source size, target and place; `pieces` has the parts
    of documents in each slot: (out_shard, pass_no, part_id, part_row, lo, hi), words lo to hi of the document.

    Words are runs of other than space and \\t to \\r. A null text has no words; null is a source of its own; rows are
    never merged, whatever they share. A source without words, or an empty table, gives no pieces. All columns of `docs`
    are kept, whatever their names, when `keep` is set: in `held` until `documents` gives them back. No document is used
    more than twice its size.

    Slots and blocks are both shuffled by source and block: neither is broadcast, as both grow with the documents.
    """

    def __init__(self, docs: DataFrame, weights=WEIGHTS, share=SHARE, block_words=BLOCK_WORDS, shard_words=SHARD_WORDS,
                 seed=SEED, keep: bool = False):
        spark = docs.sparkSession
        self.block_words = block_words
        own = docs.select("source", F.struct("*").alias("held")) if keep else docs.select("doc_id", "source", "text")
        listed = _listed(docs)
        own = own.join(listed, own["source"].eqNullSafe(listed["named"])).drop("named")
        sized = T.StructType([T.StructField("size", T.LongType())])

        def sizes(batch):
            texts = batch.column("held").field(batch.schema.field("held").type.get_field_index("text")) if keep else batch.column("text")
            return (word_counts(plain_strings(texts)),)

        rows = numbering.placed(own, sized, sizes, "source_no", "size", "mix-rows", () if keep else ("text",))
        self.sources = _sources(rows, weights, share)
        goals = spark.createDataFrame(
            [(i, int(w), float(t)) for i, (w, t) in enumerate(self.sources.itertuples(index=False))],
            "source_no long, source_size long, target double",
        )
        self.rows = rows.join(_if_small(goals, 24 * len(self.sources)), "source_no")
        self.slots = written(_slots(spark, self.sources, block_words, shard_words, seed), "mix-slots")

    def pieces(self) -> DataFrame:
        first = F.col(numbering.START)
        blocks = (
            self.rows.filter("size > 0")
            .select("source_no", numbering.PART, numbering.ROW, "size", numbering.START, F.explode(
                F.sequence((first / self.block_words).cast("long"), ((first + F.col("size") - 1) / self.block_words).cast("long"))
            ).alias("block"))
        )
        begin = F.col("block") * self.block_words - first
        parts = blocks.select(
            "source_no", "block", numbering.PART, numbering.ROW, F.greatest(begin, F.lit(0)).alias("lo"),
            F.least(begin + self.block_words, F.col("size")).alias("hi"),
        )
        return self.slots.hint("merge").join(parts, ["source_no", "block"]).select(
            "out_shard", "pass_no", numbering.PART, numbering.ROW, "lo", "hi"
        )

    def taken(self) -> DataFrame:
        """`rows` with `taken`: the words of the document in the mix, repeats counted."""
        used = self.pieces().groupBy(numbering.PART, numbering.ROW).agg(F.sum(F.col("hi") - F.col("lo")).alias("taken"))
        return self.rows.join(used, [numbering.PART, numbering.ROW], "left").fillna(0, ["taken"])

    def documents(self) -> DataFrame:
        """The mixed text as rows with the columns of the documents: one for each pass that takes a document, its text
        cut to the words taken."""
        spans = F.array_sort(F.collect_list(F.struct("lo", "hi")))
        chosen = self.pieces().groupBy(numbering.PART, numbering.ROW, "pass_no").agg(spans.alias("spans"))
        joined = self.rows.select("held", numbering.PART, numbering.ROW).join(chosen, [numbering.PART, numbering.ROW])
        text = _cut(F.col("held").getField("text"), "spans").alias("text")
        names = self.rows.schema["held"].dataType.names
        return joined.select(*(text if c == "text" else F.col("held").getField(c).alias(c) for c in names))


@F.pandas_udf(T.StringType())
def _cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
    out = []
    for text, wanted in zip(texts, spans, strict=True):
        data = text.encode()
        words = Words(np.frombuffer(data, np.uint8), np.array([0, len(data)]), keys=False)
        begin = np.r_[words.start, len(data)]
        begin[0] = 0
        out.append(b"".join(data[begin[s["lo"]] : begin[s["hi"]]] for s in wanted).decode())
    return pd.Series(out, dtype=object)
