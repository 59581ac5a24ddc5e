"""Reversible line deduplication: exact reference counts of line keys, and sharded cuckoo filters in front of them.

A line's key is the line without white space `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased, as a 16-byte
digest. A `LineStore` holds one reference per document and different key of at least `min_chars` code points. From the
references come exact counts, and the *repeated* keys, those of at least `min_docs` documents. Each shard of the key
space has a cuckoo filter of its repeated keys: lines are marked by looking into the filters first, and only lines that
pass go to the exact counts. Inserting or deleting documents changes references, counts and filters alike, so a
deletion gives lines back.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.llm.arrays import mix64, plain_strings
from gramline.plans.lookup import BROADCAST_BYTES, lookup_join
from gramline.plans.storage import written

MIN_CHARS = 20
MIN_DOCS = 3
SHARD_KEYS = 100_000
SLOTS = 4
MOST_KICKS = 500
_STRIP = b" \t\n\x0b\x0c\r"


class CuckooFilter:
    """A set of 64-bit keys as 16-bit fingerprints in buckets of four, with deletion. No false negatives: a key that
    finds no place is kept in `spare`, whole."""

    def __init__(self, n_buckets: int, table: np.ndarray | None = None, spare: set[int] | None = None):
        self.n = n_buckets
        self.table = np.zeros((n_buckets, SLOTS), np.uint16) if table is None else table
        self.spare = spare or set()

    @classmethod
    def sized_for(cls, n_keys: int) -> CuckooFilter:
        return cls(1 << max(1, int(np.ceil(np.log2(max(1, n_keys) / (0.85 * SLOTS))))))

    def _places(self, keys: np.ndarray):
        mixed = mix64(keys)
        mark = (mixed >> np.uint64(48)).astype(np.uint16)
        mark[mark == 0] = 1
        first = (mixed & np.uint64(self.n - 1)).astype(np.int64)
        return mark, first, first ^ self._jump(mark)

    def _jump(self, mark: np.ndarray) -> np.ndarray:
        return (mix64(mark.astype(np.uint64)) & np.uint64(self.n - 1)).astype(np.int64)

    def insert(self, keys: np.ndarray) -> None:
        mark, first, second = self._places(keys)
        rng = np.random.default_rng(1)
        for key, m, a, b in zip(keys.tolist(), mark.tolist(), first.tolist(), second.tolist(), strict=True):
            for at in (a, b):
                free = np.flatnonzero(self.table[at] == 0)
                if free.size:
                    self.table[at, free[0]] = m
                    break
            else:
                self._kick(key, m, (a, b)[int(rng.integers(2))], rng)

    def _kick(self, key: int, mark: int, at: int, rng) -> None:
        """Moves fingerprints to their other bucket until one finds room; else undoes it all and spares the key."""
        moves = []
        for _ in range(MOST_KICKS):
            slot = int(rng.integers(SLOTS))
            moves.append((at, slot, int(self.table[at, slot])))
            self.table[at, slot], mark = mark, int(self.table[at, slot])
            at ^= int(self._jump(np.array([mark], np.uint16))[0])
            free = np.flatnonzero(self.table[at] == 0)
            if free.size:
                self.table[at, free[0]] = mark
                return
        for bucket, slot, old in reversed(moves):
            self.table[bucket, slot] = old
        self.spare.add(key)

    def delete(self, keys: np.ndarray) -> None:
        """Removes keys that were inserted."""
        for key, m, a, b in zip(keys.tolist(), *(x.tolist() for x in self._places(keys)), strict=True):
            if key in self.spare:
                self.spare.discard(key)
                continue
            for at in (a, b):
                held = np.flatnonzero(self.table[at] == m)
                if held.size:
                    self.table[at, held[0]] = 0
                    break

    def contains(self, keys: np.ndarray) -> np.ndarray:
        mark, first, second = self._places(keys)
        found = (self.table[first] == mark[:, None]).any(1) | (self.table[second] == mark[:, None]).any(1)
        return found | np.isin(keys, np.fromiter(self.spare, np.uint64, len(self.spare))) if self.spare else found

    def to_row(self) -> tuple[int, bytes, list[int]]:
        return self.n, self.table.tobytes(), [k - (1 << 64) if k >> 63 else k for k in self.spare]

    @classmethod
    def from_row(cls, n: int, table: bytes, spare) -> CuckooFilter:
        return cls(n, np.frombuffer(table, np.uint16).reshape(n, SLOTS).copy(), {k & 0xFFFFFFFFFFFFFFFF for k in spare})


def _line_keys(text: str, min_chars: int) -> list[bytes | None]:
    """The digest of each line's key, None for short ones. Lower-casing bytes changes A-Z only."""
    out = []
    for line in text.encode().split(b"\n"):
        key = line.strip(_STRIP).lower()
        long_enough = len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode()) >= min_chars)
        out.append(hashlib.blake2b(key, digest_size=16).digest() if long_enough else None)
    return out


def _head(key: bytes) -> int:
    return int.from_bytes(key[:8], "little")


_KEPT = T.StructType(
    [T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType()), T.StructField("kept_text", T.StringType())]
)
_LINES = "doc_id long, row_key binary, pos int, key binary, head long"


def _cut_lines(batches, min_chars: int, once: bool, filters=None):
    """Lines with keys. `once` gives each key of a document once; `filters` drops lines that they do not hold."""
    opened, n_shards = filters or ({}, 0)
    for batch in batches:
        ids = batch.column(0).to_pylist()
        rows: list[tuple] = []

        def flush():
            heads = np.array([_head(r[3]) for r in rows], np.uint64)
            shards = heads.view(np.int64) % max(1, n_shards)
            if filters:
                passed = np.zeros(len(rows), bool)
                for s in np.unique(shards):
                    if s in opened:
                        here = np.flatnonzero(shards == s)
                        passed[here] = opened[s].contains(heads[here])
                rows[:] = [r for r, ok in zip(rows, passed, strict=True) if ok]
                heads = heads[passed]
            columns = list(zip(*rows, strict=True)) if rows else [[]] * 4
            types = (pa.int64(), pa.binary(), pa.int32(), pa.binary())
            arrays = [pa.array(c, t) for c, t in zip(columns, types, strict=True)]
            arrays.append(pa.array(heads.view(np.int64)))
            rows.clear()
            return pa.RecordBatch.from_arrays(arrays, ["doc_id", "row_key", "pos", "key", "head"])

        for doc_id, text in zip(ids, plain_strings(batch.column(1)).to_pylist(), strict=True):
            row_key = _row_key(doc_id, text)
            seen = set()
            for pos, key in enumerate(_line_keys(text, min_chars)):
                if key is not None and not (once and key in seen):
                    seen.add(key)
                    rows.append((doc_id, row_key, pos, key))
            if len(rows) >= 50_000:
                yield flush()
        if rows:
            yield flush()


def _row_key(doc_id, text: str) -> bytes:
    return hashlib.blake2b(f"{doc_id}\n{text}".encode(), digest_size=16).digest()


class LineStore:
    """References of line keys with their counts and filters, kept as written tables.

    Each row is a document: rows that share an id count each. A null id is a document too and the smallest of all; a
    null text is one empty line. Lines whose key is short are never dropped. Extra columns pass through `mark`.
    """

    def __init__(self, spark: SparkSession, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS, shard_keys: int = SHARD_KEYS):
        self.spark, self.min_chars, self.min_docs, self.shard_keys = spark, min_chars, min_docs, shard_keys
        self.references: DataFrame | None = None
        self.counts: DataFrame | None = None
        self.filters: DataFrame | None = None
        self.n_shards = 0

    def _refs_of(self, docs: DataFrame) -> DataFrame:
        least = self.min_chars
        lines = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lambda b: _cut_lines(b, least, True), _LINES)
        return lines.select("key", "head", "doc_id", "row_key")

    def insert(self, docs: DataFrame) -> None:
        """Adds the documents' references."""
        new = written(self._refs_of(docs), "line-references")
        old = self.references
        self.references = new if old is None else old.unionByName(new)
        self._recount()

    def delete(self, docs: DataFrame) -> None:
        """Takes back the references of the given documents (same id and text), as often as they are given."""
        if self.references is None:
            return
        gone = self._refs_of(docs).groupBy("key", "doc_id", "row_key").agg(F.count("*").alias("gone"))
        same = [F.col(f"r.{c}").eqNullSafe(F.col(f"g.{c}")) for c in ("key", "doc_id", "row_key")]
        held = self.references.groupBy("key", "head", "doc_id", "row_key").agg(F.count("*").alias("held"))
        left = held.alias("r").join(gone.alias("g"), same, "left").select(
            "r.*", F.greatest(F.col("held") - F.coalesce("gone", F.lit(0)), F.lit(0)).cast("int").alias("left")
        )
        self.references = written(
            left.filter("left > 0").withColumn("again", F.explode(F.expr("sequence(1, left)")))
            .select("key", "head", "doc_id", "row_key"), "line-references",
        )
        self._recount()

    def _recount(self) -> None:
        """Counts per repeated key, then the filters: keys that became repeated go in, keys that no longer are go out.
        The filters are laid out anew when there are none or the store has outgrown them."""
        before = self.counts
        counts = self.references.groupBy("key", "head").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id"))
        self.counts = written(counts.filter(F.col("n_docs") >= self.min_docs), "line-counts")
        n = self.counts.count()
        if self.filters is None or n > 2 * self.n_shards * self.shard_keys:
            self.n_shards = max(1, -(-n // self.shard_keys))
            self.filters = None
            added, removed = self.counts, None
        else:
            added = self.counts.join(before.select("key"), "key", "left_anti")
            removed = before.join(self.counts.select("key"), "key", "left_anti")
        self._update_filters(added, removed)

    def _update_filters(self, added: DataFrame, removed: DataFrame | None) -> None:
        """One task per shard; a shard holds about `shard_keys` keys, whatever the size of the store. Heads that two
        keys share are put in once each, so that one can leave."""
        n = self.n_shards
        shard = F.pmod(F.col("head"), F.lit(n)).cast("int").alias("shard")
        changes = added.select(shard, "head", F.lit(1).alias("sign"))
        if removed is not None:
            changes = changes.unionByName(removed.select(shard, "head", F.lit(-1).alias("sign")))
        room = 2 * self.shard_keys
        schema = "shard int, n int, cells binary, spare array<long>"

        def build(key, held: pd.DataFrame, change: pd.DataFrame) -> pd.DataFrame:
            if len(held):
                own = CuckooFilter.from_row(held["n"][0], held["cells"][0], held["spare"][0])
            else:
                own = CuckooFilter.sized_for(max(len(change) * 2, 64) if len(change) < room // 2 else room)
            heads = change["head"].to_numpy(np.int64).view(np.uint64)
            own.delete(heads[change["sign"].to_numpy() < 0])
            own.insert(heads[change["sign"].to_numpy() > 0])
            return pd.DataFrame([(int(key[0]), *own.to_row())], columns=["shard", "n", "cells", "spare"])

        held = self.filters if self.filters is not None else self.spark.createDataFrame([], schema)
        self.filters = written(held.groupBy("shard").cogroup(changes.groupBy("shard")).applyInPandas(build, schema), "line-filters")

    def candidates(self, docs: DataFrame) -> DataFrame:
        """Lines that the filters hold. Filters up to 64 MB go to every task; beyond that, all lines go to the counts."""
        least, n = self.min_chars, self.n_shards
        size = self.filters.agg(F.sum(F.length("cells") + 8 * F.size("spare"))).first()[0] or 0
        source = docs.select(F.col("doc_id").cast("long"), "text")
        if size > BROADCAST_BYTES:
            return source.mapInArrow(lambda b: _cut_lines(b, least, False), _LINES)
        shared = self.spark.sparkContext.broadcast([tuple(r) for r in self.filters.collect()])

        def look(batches):
            opened = {s: CuckooFilter.from_row(n_, cells, spare) for s, n_, cells, spare in shared.value}
            return _cut_lines(batches, least, False, (opened, n))

        return source.mapInArrow(look, _LINES)

    def drops(self, docs: DataFrame) -> DataFrame:
        """(row_key, positions): lines of `docs` that go, for each document that loses any."""
        found = lookup_join(self.candidates(docs), self.counts.drop("head"), ["key"], weight="n_docs")
        gone = found.filter(F.col("doc_id").isNull() | (F.col("doc_id") < F.col("last_id")))
        return gone.groupBy("row_key").agg(F.collect_set("pos").alias("dropped_lines"))

    def mark(self, docs: DataFrame) -> DataFrame:
        """`docs` with `n_lines`, `n_dropped` and `kept_text`."""
        own = [c for c in docs.columns if c not in ("n_lines", "n_dropped", "kept_text", "row_key", "dropped_lines")]
        keyed = docs.select(*own).withColumn("row_key", _row_keys(F.col("doc_id").cast("string"), "text"))
        joined = keyed.join(self.drops(docs), "row_key", "left")
        return joined.withColumn("kept", _without("text", "dropped_lines")).select(
            *own, "kept.n_lines", "kept.n_dropped", "kept.kept_text"
        )


@F.pandas_udf(T.BinaryType())
def _row_keys(ids: pd.Series, texts: pd.Series) -> pd.Series:
    return pd.Series([_row_key(i, t or "") for i, t in zip(ids, texts, strict=True)], dtype=object)


@F.pandas_udf(_KEPT)
def _without(texts: pd.Series, dropped: pd.Series) -> pd.DataFrame:
    rows = []
    for text, gone in zip(texts, dropped, strict=True):
        text = text or ""
        if gone is None or not len(gone):
            rows.append((text.count("\n") + 1, 0, text))
            continue
        lines, gone = text.split("\n"), set(gone)
        rows.append((len(lines), len(gone), "\n".join(x for i, x in enumerate(lines) if i not in gone)))
    return pd.DataFrame(rows, columns=["n_lines", "n_dropped", "kept_text"])
