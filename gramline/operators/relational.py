"""Selecting, filtering and counting labelled rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramline.plans.lookup import lookup_join
from gramline.plans.storage import written


def select_labelled(df: DataFrame, text: str, label: str, id: str | None = None) -> DataFrame:
    """(row_id, tweet, target) from any table with a text and a label column."""
    kept = [F.col(text).alias("tweet"), F.col(label).cast("string").alias("target")]
    return df.select(*([F.col(id).alias("row_id")] if id else []), *kept)


def drop_nulls(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a value in every column. Plain null tests, unlike `dropna`, are pushed into the parquet scan."""
    for field in (df.schema[c] for c in columns):
        df = df.filter(F.col(field.name).isNotNull())
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            df = df.filter(~F.isnan(field.name))
    return df


def class_counts(df: DataFrame, label: str) -> DataFrame:
    """(label, n), one row per class."""
    return df.groupBy(label).agg(F.count("*").alias("n"))


def n_classes(df: DataFrame, label: str) -> DataFrame:
    return df.agg(F.count_distinct(label).alias("n_classes"))


def distinct_labels(df: DataFrame, label: str) -> DataFrame:
    return df.select(label).distinct()


def frequent_classes(df: DataFrame, label: str, k: int) -> DataFrame:
    """(label, n) of the classes with at least k rows, as a written table."""
    return written(class_counts(df.filter(F.col(label).isNotNull()), label).filter(F.col("n") >= k), "frequent-classes")


def filter_min_class_frequency(df: DataFrame, label: str, k: int) -> DataFrame:
    """Rows whose class has at least k rows. Rows without a class are never kept.

    Classes are counted with partial sums, never gathered, so a class of any size is fine.
    """
    return lookup_join(df, frequent_classes(df, label, k), [label], "left_semi", weight="n")


def filter_known_labels(test: DataFrame, train: DataFrame, label: str) -> DataFrame:
    """Rows of `test` whose class occurs in `train`."""
    known = class_counts(test, label).join(distinct_labels(train, label), label, "left_semi")
    return lookup_join(test, written(known, "known-classes"), [label], "left_semi", weight="n")


def exclude_rows(df: DataFrame, taken: DataFrame, id: str) -> DataFrame:
    """Rows of `df` whose id is not in `taken`. A table that already carries a split column needs only a filter on it."""
    return df.join(taken.select(id), id, "left_anti")
