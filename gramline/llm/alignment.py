"""Alignment of two tokenizers' tokens over the same text.

Both sides cut the same bytes, a space and the text. In every batch `pandas.merge_asof`, keyed by document, gives each
token start of one side the token of the other side that covers it; both directions together are all overlaps. Overlaps
with equal ends close a group, the smallest run of text on whose borders both sides agree. How many documents hold an
identifier pair linked is counted over the corpus from a written table of each document's pairs, and joined back.

Null and empty texts, and texts whose tokens do not spell the space and the text, have no tokens: their numbers are 0
and their digest is ''. Every row is a document of its own, whatever its id; columns other than `doc_id` and the text
are not carried. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramline.llm.arrays import plain_strings
from gramline.llm.token_files import PATTERN
from gramline.plans.lookup import lookup_join
from gramline.plans.storage import written

TOKENIZER_A = "/opt/tokenizers/byte_bpe_50k.json"
TOKENIZER_B = "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 1 << 20
SMALL_GROUP = 1 << 12  # links of larger groups are counted from their distinct identifiers
ALIGNED = (
    "ref long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
    "a array<int>, b array<int>, times array<int>"
)
GROUPS = "doc_id long, a array<int>, b array<int>, a_size array<int>, b_size array<int>, end array<long>"


def _byte_of_character() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 stands for itself, other bytes for the characters from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def _lengths(spelled: list[bytes]) -> np.ndarray:
    return np.fromiter(map(len, spelled), np.int64, len(spelled))


class ByteTokens:
    """A byte-level BPE vocabulary file. Identifiers are merge ranks, so the ranks are read off the vocabulary."""

    def __init__(self, path: str):
        import tiktoken

        with open(path, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["content"] for t in described["added_tokens"]}
        alphabet = _byte_of_character()
        ranks = {
            bytes(alphabet[c] for c in token): i for token, i in described["model"]["vocab"].items() if token not in special
        }
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token
        self.length = _lengths(self.bytes)
        self._encoder = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, texts: list[str]) -> list[list[int]]:
        return [self._encoder.encode_ordinary(" " + t) for t in texts]


class PieceTokens:
    """A piece model with byte fallback. It puts a space before the text by itself."""

    def __init__(self, path: str):
        import sentencepiece

        self._model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = self._model.get_piece_size()
        pieces = [self._model.id_to_piece(i) for i in range(size)]
        self.bytes = [
            bytes([int(p[3:5], 16)]) if self._model.is_byte(i) else p.replace("▁", " ").encode()
            for i, p in enumerate(pieces)
        ]
        self.length = _lengths(self.bytes)

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self._model.encode(texts, num_threads=1)


def _covering(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    """For each left token the right token of its document that covers the left token's start."""
    return pd.merge_asof(left, right, on="start", by="doc")


@dataclass
class Aligned:
    """Tokens of several texts, one after another: identifiers, and for each group its last token on either side, its
    document and its end in the run of all texts' bytes."""

    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray
    doc: np.ndarray
    end: np.ndarray

    @property
    def a_size(self) -> np.ndarray:
        return np.diff(self.last_a, prepend=-1)

    @property
    def b_size(self) -> np.ndarray:
        return np.diff(self.last_b, prepend=-1)


def _flat(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    counts = np.fromiter(map(len, rows), np.int64, len(rows))
    flat = np.fromiter(chain.from_iterable(rows), np.int64, int(counts.sum()))
    return flat, counts


def align_texts(texts: list[str], a_tokens: ByteTokens, b_tokens: PieceTokens) -> Aligned:
    """Aligns each text's tokens. A text that a side does not spell has no tokens."""
    spell_a, spell_b = a_tokens.bytes.__getitem__, b_tokens.bytes.__getitem__
    rows_a, rows_b = a_tokens.encode(texts), b_tokens.encode(texts)
    for i, text in enumerate(texts):
        whole = b" " + text.encode()
        if not text or b"".join(map(spell_a, rows_a[i])) != whole or b"".join(map(spell_b, rows_b[i])) != whole:
            rows_a[i] = rows_b[i] = []
    (a, n_a), (b, n_b) = _flat(rows_a), _flat(rows_b)
    a_length, b_length = a_tokens.length[a], b_tokens.length[b]
    a_end, b_end = np.cumsum(a_length), np.cumsum(b_length)
    docs = np.arange(len(texts))
    left = pd.DataFrame({"doc": np.repeat(docs, n_a), "start": a_end - a_length, "i": np.arange(len(a))})
    right = pd.DataFrame({"doc": np.repeat(docs, n_b), "start": b_end - b_length, "j": np.arange(len(b))})
    if not len(a):
        none = np.zeros(0, np.int64)
        return Aligned(a, b, n_a, n_b, none, none, none, none)
    forward, backward = _covering(left, right), _covering(right, left)
    # An overlap whose two tokens start together is found both ways; it is taken from the first.
    backward = backward[left["start"].to_numpy()[backward["i"].to_numpy()] != backward["start"].to_numpy()]
    i = np.concatenate([forward["i"].to_numpy(), backward["i"].to_numpy()])
    j = np.concatenate([forward["j"].to_numpy(), backward["j"].to_numpy()])
    closing = a_end[i] == b_end[j]
    last_a, last_b = np.sort(i[closing]), np.sort(j[closing])
    return Aligned(a, b, n_a, n_b, last_a, last_b, left["doc"].to_numpy()[last_a], a_end[last_a])


def _counted(keys: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, times, len(found)).astype(np.int64)


def _products(a: np.ndarray, b: np.ndarray, a_size: np.ndarray, b_size: np.ndarray, a_first: np.ndarray, b_first: np.ndarray):
    """(group, a, b) of all pairs of a token of either side inside each group."""
    n = a_size * b_size
    group = np.repeat(np.arange(len(n)), n)
    inner = np.arange(len(group)) - np.repeat(np.cumsum(n) - n, n)
    width = b_size[group]
    return group, a[a_first[group] + inner // width], b[b_first[group] + inner % width]


def linked_pairs(found: Aligned, span_b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(doc, pair, times): each document's different identifier pairs, `a * span_b + b`, and how often it links them."""
    a_size, b_size = found.a_size, found.b_size
    a_first, b_first = found.last_a - a_size + 1, found.last_b - b_size + 1
    small = a_size * b_size <= SMALL_GROUP
    group, a, b = _products(found.a, found.b, a_size[small], b_size[small], a_first[small], b_first[small])
    span = span_b * int(found.a.max(initial=0) + 1)
    keys, times = [found.doc[small][group] * span + a * span_b + b], [np.ones(len(a), np.int64)]
    for g in np.flatnonzero(~small):
        own_a, n_a = np.unique(found.a[a_first[g] : a_first[g] + a_size[g]], return_counts=True)
        own_b, n_b = np.unique(found.b[b_first[g] : b_first[g] + b_size[g]], return_counts=True)
        keys.append((found.doc[g] * span + own_a[:, None] * span_b + own_b[None, :]).ravel())
        times.append((n_a[:, None] * n_b[None, :]).ravel())
    key, n = _counted(np.concatenate(keys), np.concatenate(times))
    return key // span, key % span, n


class _Digests:
    """SHA-256 of documents' groups, written `a1,a2|b1;a3|b2,b3`."""

    def __init__(self, ids: int):
        number = np.array([str(i) for i in range(ids)], object)
        self._followed_by = [number + mark for mark in (",", "|", ";")]

    def of(self, found: Aligned) -> list[str]:
        """One digest per document, '' without tokens."""
        a_size, b_size = found.a_size, found.b_size
        a_group = np.repeat(np.arange(len(a_size)), a_size)
        b_group = np.repeat(np.arange(len(b_size)), b_size)
        parts = np.empty(len(found.a) + len(found.b), object)
        comma, bar, end = self._followed_by
        a_part, b_part = comma[found.a], comma[found.b]
        a_part[found.last_a], b_part[found.last_b] = bar[found.a[found.last_a]], end[found.b[found.last_b]]
        # A token comes after all tokens of earlier groups, and one of side B after its group's tokens of side A.
        parts[np.arange(len(found.a)) + (np.cumsum(b_size) - b_size)[a_group]] = a_part
        parts[np.arange(len(found.b)) + np.cumsum(a_size)[b_group]] = b_part
        ends = np.cumsum(found.n_a + found.n_b)
        out = []
        for first, last in zip(np.r_[0, ends[:-1]], ends, strict=True):
            text = "".join(parts[first:last].tolist())[:-1]
            out.append(hashlib.sha256(text.encode()).hexdigest() if text else "")
        return out


def _slices(texts: pa.Array):
    """Runs of rows of about SLICE_BYTES, or one longer row."""
    length = np.asarray(pc.binary_length(texts), np.int64)
    ends = np.cumsum(length)
    first = 0
    while first < len(texts):
        before = ends[first] - length[first]
        last = max(first + 1, int(np.searchsorted(ends, before + SLICE_BYTES, "right")))
        yield first, texts[first:last].to_pylist()
        first = last


def _lists(values: np.ndarray, counts: np.ndarray, kind=pa.int32()) -> pa.Array:
    offsets = np.r_[0, np.cumsum(counts)].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _ids(batch: pa.RecordBatch, first: int, n: int) -> pa.Array:
    return batch.column(0)[first : first + n]


def alignments(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """(doc_id, a, b, a_size, b_size, end): each document's tokens on both sides, the number of tokens of either side in
    each group, and where each group ends, in bytes of the space and the text."""

    def run(batches):
        own_a, own_b = ByteTokens(tokenizer_a), PieceTokens(tokenizer_b)
        for batch in batches:
            for first, texts in _slices(plain_strings(batch.column(1))):
                found = align_texts(texts, own_a, own_b)
                per_doc = np.bincount(found.doc, minlength=len(texts))
                before = np.cumsum([len(b" " + t.encode()) if n else 0 for t, n in zip(texts, per_doc, strict=True)])
                start = np.r_[0, before[:-1]]
                yield pa.RecordBatch.from_arrays(
                    [_ids(batch, first, len(texts)), _lists(found.a, found.n_a), _lists(found.b, found.n_b),
                     _lists(found.a_size, per_doc), _lists(found.b_size, per_doc),
                     _lists(found.end - start[found.doc], per_doc, pa.int64())],
                    ["doc_id", "a", "b", "a_size", "b_size", "end"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, GROUPS)


def document_links(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """One row per document: its counts, the digest of its groups, and its different linked pairs (a, b, times) as three
    arrays. `ref` numbers the rows."""

    def run(batches):
        own_a, own_b = ByteTokens(tokenizer_a), PieceTokens(tokenizer_b)
        span_b = len(own_b.bytes)
        digests = _Digests(max(len(own_a.bytes), span_b))
        ref = TaskContext.get().partitionId() << 33
        for batch in batches:
            for first, texts in _slices(plain_strings(batch.column(1))):
                n = len(texts)
                found = align_texts(texts, own_a, own_b)
                doc, pair, times = linked_pairs(found, span_b)
                n_pairs = np.bincount(doc, minlength=n)
                n_links = np.zeros(n, np.int64)
                np.add.at(n_links, found.doc, found.a_size * found.b_size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.arange(ref, ref + n)), _ids(batch, first, n), pa.array(found.n_a), pa.array(found.n_b),
                     pa.array(np.bincount(found.doc, minlength=n)), pa.array(n_links), pa.array(digests.of(found)),
                     _lists(pair // span_b, n_pairs), _lists(pair % span_b, n_pairs), _lists(times, n_pairs)],
                    ["ref", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "a", "b", "times"],
                )
                ref += n

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, ALIGNED)


def pair_counts(links: DataFrame) -> DataFrame:
    """(a, b, n, best): how many documents hold a pair linked, and whether no other pair of its A identifier is held by
    more."""
    pairs = links.select(F.explode(F.arrays_zip("a", "b")).alias("pair")).select("pair.*")
    counts = written(pairs.groupBy("a", "b").agg(F.count("*").alias("n")), "pair-counts")
    highest = counts.groupBy("a").agg(F.max("n").alias("highest"))
    # At most one row per identifier of side A, so the table that is joined has a bound of its own.
    return lookup_join(counts, written(highest, "pair-highest"), ["a"]).select(
        "a", "b", "n", (F.col("n") == F.col("highest")).alias("best")
    )


def link_statistics(docs: DataFrame, tokenizer_a: str = TOKENIZER_A, tokenizer_b: str = TOKENIZER_B) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) per document. `n_best` counts the links
    whose pair is held by as many documents as any pair of its A identifier, `count_sum` sums over links the number of
    documents that hold their pair."""
    links = written(document_links(docs, tokenizer_a, tokenizer_b), "links")
    counts = written(pair_counts(links), "pairs")
    per_doc = ["ref", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"]
    zipped = links.select(*per_doc, F.explode_outer(F.arrays_zip("a", "b", "times")).alias("p"))
    flat = zipped.select(*per_doc, "p.a", "p.b", "p.times")
    # Rows without a pair keep their document; the others find their pair in the counts.
    joined = lookup_join(flat, counts.withColumn("weight", F.col("n")), ["a", "b"], "left", weight="weight")
    total = joined.groupBy(*per_doc).agg(
        F.coalesce(F.sum(F.when(F.col("best"), F.col("times"))), F.lit(0)).cast("long").alias("n_best"),
        F.coalesce(F.sum(F.col("times") * F.col("n")), F.lit(0)).cast("long").alias("count_sum"),
    )
    return total.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
