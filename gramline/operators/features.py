"""Character n-gram TF-IDF as long tables (id, gram, value).

A vocabulary is fitted without moving text: each row gives its different grams, and only per-gram totals, summed inside
each task, are shuffled. For the gram table of the rows themselves, rows are spread by id once, as text; everything per
row (words, grams, counts, lengths) then happens inside that partitioning, so the gram table, many times larger than the
text, is not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.functions import grams
from gramline.functions import words as w
from gramline.plans.lookup import BROADCAST_BYTES, lookup_join, measured_bytes
from gramline.plans.storage import written


def by_row(df: DataFrame, id: str, partitions: int | None = None) -> DataFrame:
    """Rows spread by id into a fixed number of tasks, which adaptive execution must not merge: grams outgrow text."""
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, id)


def char_wb_ngrams(df: DataFrame, input: str, output: str, lo: int, hi: int) -> DataFrame:
    return df.withColumn(output, w.char_wb_ngrams(F.col(input), lo, hi))


def term_frequency(
    df: DataFrame, id: str, text: str, lo: int, hi: int, partitions: int | None = None
) -> DataFrame:
    """(id, gram, tf): how often each gram occurs in each row. Words are counted first, so a repeated word is cut once."""
    rows = _words_by_id(df, id, text, lo, hi, partitions)
    schema = T.StructType([df.schema[id], T.StructField("gram", T.StringType()), T.StructField("tf", T.LongType())])
    return rows.mapInArrow(lambda batches: _named(grams.term_frequencies(batches, lo, hi), schema.names), schema)


def _words_by_id(df: DataFrame, id: str, text: str, lo: int, hi: int, partitions: int | None) -> DataFrame:
    """(id, words), equal ids following one another."""
    w.check_range(lo, hi)
    return by_row(df.select(id, text), id, partitions).sortWithinPartitions(id).select(id, w.words(F.col(text)).alias("_words"))


def _named(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    return (batch.rename_columns(names) for batch in batches)


def document_frequency(tf: DataFrame) -> DataFrame:
    """(gram, df): number of rows that contain each gram."""
    return tf.groupBy("gram").agg(F.count("*").alias("df"))


def document_frequency_of_text(df: DataFrame, text: str, lo: int, hi: int) -> DataFrame:
    """`document_frequency` of rows that are one document each, straight from their text."""
    return _document_frequencies(df.select(F.lit(0).alias("_by"), text), "_by", text, lo, hi).groupBy("gram").agg(F.sum("df").alias("df"))


def document_frequency_by(df: DataFrame, by: str, text: str, lo: int, hi: int) -> DataFrame:
    """(by, gram, df): the rows with each value of a column that contain each gram."""
    return _document_frequencies(df, by, text, lo, hi).groupBy(by, "gram").agg(F.sum("df").alias("df"))


def _document_frequencies(df: DataFrame, by: str, text: str, lo: int, hi: int) -> DataFrame:
    """(by, gram, df) in parts that add up."""
    w.check_range(lo, hi)
    rows = df.select(by, w.words(F.col(text)).alias("_words"))
    schema = T.StructType([rows.schema[by], T.StructField("gram", T.StringType()), T.StructField("df", T.LongType())])
    return rows.mapInArrow(lambda batches: _named(grams.document_frequencies(batches, lo, hi), schema.names), schema)


def prune_vocabulary(frequencies: DataFrame, n: int, min_df: int | float, max_df: int | float) -> DataFrame:
    """Grams neither too rare nor too common. Whole numbers are counts of rows, fractions are shares of `n` rows."""
    low = min_df if isinstance(min_df, int) else min_df * n
    high = max_df if isinstance(max_df, int) else max_df * n
    return frequencies.filter((F.col("df") >= F.lit(low)) & (F.col("df") <= F.lit(high)))


def inverse_document_frequency(frequencies: DataFrame, n: int) -> DataFrame:
    """(gram, df, idf) with the smoothed idf ln((1 + n) / (1 + df)) + 1."""
    return frequencies.withColumn("idf", F.log(F.lit(1.0 + n) / (1.0 + F.col("df"))) + 1.0)


@dataclass(frozen=True)
class Vocabulary:
    """A fitted vocabulary: a written table (gram, df, idf), the number of rows it was fitted on, and its range."""

    grams: DataFrame
    n: int
    lo: int
    hi: int


def fit_vocabulary(
    df: DataFrame, text: str, lo: int, hi: int, min_df: int | float, max_df: int | float
) -> Vocabulary:
    rows = df.filter(F.col(text).isNotNull())
    return vocabulary_of(document_frequency_of_text(rows, text, lo, hi), rows.count(), lo, hi, min_df, max_df)


def vocabulary_of(
    frequencies: DataFrame, n: int, lo: int, hi: int, min_df: int | float, max_df: int | float
) -> Vocabulary:
    """The vocabulary of `n` rows whose document frequencies (gram, df) are known already."""
    kept = prune_vocabulary(frequencies, n, min_df, max_df)
    return Vocabulary(written(inverse_document_frequency(kept, n), "vocabulary"), n, lo, hi)


def fold_vocabularies(
    folded: DataFrame, text: str, lo: int, hi: int, min_df: int | float, max_df: int | float, k: int = 5, fold: str = "fold"
) -> DataFrame:
    """(fold, gram, df, n, idf): for each of `k` folds the vocabulary of the `n` rows outside it, pruned for that number.

    Texts are cut once and grams shuffled once, as counts per fold; what a gram has outside a fold is its total less
    the fold's own. Rows without a fold or a text belong to none; a fold with no rows outside it has no vocabulary.
    """
    rows = folded.filter(F.col(fold).isNotNull() & F.col(text).isNotNull())
    sizes = {r[0]: r[1] for r in rows.groupBy(fold).count().collect()}  # one row per fold
    part, none = _document_frequencies(rows, fold, text, lo, hi), F.lit(0).cast("long")
    counts = part.groupBy("gram").agg(
        F.sum("df").alias("total"), *(F.sum(F.when(F.col(fold) == f, F.col("df")).otherwise(none)).alias(f"in_{f}") for f in range(k))
    )
    outside = []
    for f in range(k):
        n = sum(sizes.values()) - sizes.get(f, 0)
        low, high = (float(x if isinstance(x, int) else x * n) for x in (min_df, max_df))
        part = [F.lit(f).alias("fold"), (F.col("total") - F.col(f"in_{f}")).alias("df"), F.lit(n).cast("long").alias("n")]
        outside.append(F.struct(*part, F.lit(max(low, 1.0)).alias("low"), F.lit(high).alias("high")))
    kept = counts.select("gram", F.inline(F.array(*outside))).filter("df >= low AND df <= high")
    return kept.select("fold", "gram", "df", "n", (F.log((1.0 + F.col("n")) / (1.0 + F.col("df"))) + 1.0).alias("idf"))


def tfidf_transform(
    vocabulary: Vocabulary,
    df: DataFrame,
    id: str,
    text: str,
    partitions: int | None = None,
    limit: int = BROADCAST_BYTES,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """(id, gram, tfidf) with rows scaled to length 1. Unknown grams are ignored; a row without known grams has none.

    A vocabulary measured under `limit` bytes is broadcast, and one pass counts and weighs; a larger one is joined.
    `keep` names further columns of the vocabulary that the rows shall carry.
    """
    rows, lo, hi = df.filter(F.col(text).isNotNull()), vocabulary.lo, vocabulary.hi
    lookup = vocabulary.grams.select("gram", *keep, "idf")
    if measured_bytes(lookup) > limit:
        return weigh(term_frequency(rows, id, text, lo, hi, partitions), vocabulary, id, limit, keep)
    shared = df.sparkSession.sparkContext.broadcast(lookup.toArrow())
    fields = [df.schema[id], *lookup.drop("idf").schema.fields, T.StructField("tfidf", T.DoubleType())]
    schema = T.StructType(fields)
    words = _words_by_id(rows, id, text, lo, hi, partitions)
    return words.mapInArrow(lambda batches: _named(grams.weighed(batches, lo, hi, shared.value), schema.names), schema)


def weigh(
    tf: DataFrame, vocabulary: Vocabulary, id: str, limit: int = BROADCAST_BYTES, keep: tuple[str, ...] = ()
) -> DataFrame:
    known = lookup_join(tf, vocabulary.grams.select("gram", "df", "idf", *keep), ["gram"], weight="df", limit=limit)
    raw = known.select(id, "gram", *keep, (F.col("tf") * F.col("idf")).alias("raw"))
    length = F.sqrt(F.sum(F.col("raw") * F.col("raw")).over(Window.partitionBy(id)))
    return raw.select(id, "gram", *keep, (F.col("raw") / length).alias("tfidf"))


def tfidf(
    df: DataFrame,
    id: str,
    text: str,
    lo: int,
    hi: int,
    min_df: int | float,
    max_df: int | float,
    partitions: int | None = None,
) -> DataFrame:
    """Fits a vocabulary on the rows and weighs the same rows with it."""
    return tfidf_transform(fit_vocabulary(df, text, lo, hi, min_df, max_df), df, id, text, partitions)
