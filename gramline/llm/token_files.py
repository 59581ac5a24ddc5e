"""Token counts of flat, unindexed token files by a scan for end-of-document identifiers.

A file is a run of little-endian identifiers; each document ends with the separator. Files are read in blocks of fixed
length. A task searches its block for separators with one vectorised comparison and reports where documents begin and
end inside it; documents that cross blocks are stitched by a prefix scan over the blocks' summaries, first over spans of
blocks and then inside each span, so that one huge file takes many tasks.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gramline.llm.arrays import plain_strings

BLOCK_TOKENS = 1 << 21
SPAN_BLOCKS = 1024
WIDTH = 2
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SEPARATOR = 50256
HEAD = 5  # identifiers before a document's tokens that hold its number
_DIGIT = 15
_NO_ID = (1 << _DIGIT) - 1

# Fixed value: how the public vocabulary's texts are cut before merging.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def _head_of(doc_id: int | None) -> list[int]:
    """A document's number as base 2^15 digits, none of which is the separator."""
    if doc_id is None:
        return [_NO_ID] * HEAD
    return [(doc_id & 0xFFFFFFFFFFFFFFFF) >> (_DIGIT * i) & _NO_ID for i in range(HEAD)]


def _encoder(path: str):
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("public", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def write_token_files(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, separator: int = SEPARATOR) -> None:
    """One document per row: its head, its tokens, the separator. `tokenizer` is a vocabulary file that every executor
    has. Spark's own writer puts the files in place, so lost tasks leave nothing behind."""

    def encode(batches):
        own = _encoder(tokenizer)
        for batch in batches:
            ids, texts = batch.column(0).to_pylist(), plain_strings(batch.column(1))
            for at in range(0, len(ids), 256):
                rows = []
                for doc_id, text in zip(ids[at : at + 256], texts[at : at + 256].to_pylist(), strict=True):
                    tokens = np.array([*_head_of(doc_id), *own.encode_ordinary(text)], "<u2")
                    rows.append(tokens.tobytes())
                yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], ["value"])

    rows = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(encode, "value binary")
    end = separator.to_bytes(WIDTH, "little").decode("latin-1")
    rows.select(F.col("value").cast("string")).write.option("lineSep", end).option("encoding", "ISO-8859-1").text(path)


def _read(path: str, offset: int, length: int) -> bytes:
    system, place = pafs.FileSystem.from_uri(path)
    with system.open_input_file(place) as file:
        return file.read_at(length, offset)


def _blocks(spark: SparkSession, path: str, block_bytes: int) -> DataFrame:
    """(path, size, block): from Spark's own listing, which reads no content."""
    files = spark.read.format("binaryFile").load(path).select("path", F.col("length").alias("size")).filter("size > 0")
    last = ((F.col("size") - 1) / block_bytes).cast("long")
    blocks = files.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    return blocks.repartition(max(1, spark.sparkContext.defaultParallelism * 4), "path", "block")


def scan(spark: SparkSession, path: str, separator: int = SEPARATOR, head: int = 0, width: int = WIDTH, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """(path, start, n_tokens, head): one row per document of the files under `path`, in any order. `start` counts
    identifiers from the file's begin; the `head` first identifiers of each document are returned as an array and not
    counted. A last document without a separator counts if it is not empty; two separators in a row enclose a document
    without tokens. An empty file has no documents. Files must be in a store that pyarrow reads.
    """
    kind = np.dtype(f"<u{width}")
    schema = "path string, block long, starts array<long>, ends array<long>, heads array<array<int>>, first_end long, file_end long"

    def search(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, size, block in frame.itertuples(index=False):
                begin, total = block * block_tokens, size // width
                length = min(block_tokens, total - begin)
                # One identifier before the block tells whether a document begins with it, some after it hold heads.
                before, after = min(1, begin), min(head, total - begin - length)
                data = np.frombuffer(_read(name, (begin - before) * width, (before + length + after) * width), kind)
                own = data[before : before + length]
                ends = np.flatnonzero(own == separator)
                starts = ends[:-1] + 1 if len(ends) and ends[-1] == length - 1 else ends + 1
                if begin == 0 or data[0] == separator:
                    starts = np.r_[0, starts]
                heads = [data[before + s : before + s + head].astype(np.int32).tolist() for s in starts]
                first_end = int(ends[0] + begin) if len(ends) else None
                yield pd.DataFrame(
                    [(name, block, starts + begin, ends + begin, heads, first_end, total)],
                    columns=["path", "block", "starts", "ends", "heads", "first_end", "file_end"],
                )

    from gramline.plans.storage import written

    found = written(_blocks(spark, path, block_tokens * width).mapInPandas(search, schema), "token-blocks")
    next_end = _next_ends(found.select("path", "block", "first_end"))
    # Inside a block the i-th start that has an end after it ends there; only the last start may end in a later block.
    joined = found.join(next_end, ["path", "block"])
    skip = F.when((F.size("starts") > 0) & (F.size("ends") > 0) & (F.element_at("ends", 1) < F.get("starts", F.lit(0))), 1).otherwise(0)
    docs = joined.withColumn("skip", skip).select(
        "path", "file_end", "next_end", "skip", "ends", F.posexplode(F.arrays_zip("starts", "heads")).alias("at", "doc")
    )
    end = F.coalesce(F.get("ends", F.col("at") + F.col("skip")), "next_end", "file_end")
    spans = docs.select("path", F.col("doc.starts").alias("start"), (end - F.col("doc.starts")).alias("length"), F.col("doc.heads").alias("head"))
    return spans.select("path", "start", F.greatest(F.col("length") - head, F.lit(0)).alias("n_tokens"), "head")


def _next_ends(blocks: DataFrame) -> DataFrame:
    """(path, block, next_end): the first separator after each block, by a backward scan over spans, then blocks."""
    span = F.floor(F.col("block") / SPAN_BLOCKS).alias("span")
    rows = blocks.select("*", span)
    later = lambda *keys: Window.partitionBy(*keys).rowsBetween(1, Window.unboundedFollowing)
    spans = rows.groupBy("path", "span").agg(F.min("first_end").alias("span_end"))
    spans = spans.select("path", "span", F.min("span_end").over(later("path").orderBy("span")).alias("after_span"))
    inside = rows.withColumn("after_block", F.min("first_end").over(later("path", "span").orderBy("block")))
    return inside.join(spans, ["path", "span"]).select("path", "block", F.coalesce("after_block", "after_span").alias("next_end"))


def doc_ids(head: str):
    """The document number that `write_token_files` put into the head."""
    digit = lambda i: F.shiftleft(F.get(head, F.lit(i)).cast("long"), _DIGIT * i)
    number = digit(0)
    for i in range(1, HEAD):
        number = number.bitwiseOR(digit(i))
    none = F.forall(head, lambda x: x == _NO_ID)
    return F.when(none, F.lit(None)).otherwise(number).cast("long")
