"""From documents to training shards: toxic texts go, one of each group of near copies stays, texts that hold benchmark
items go, sources are mixed to their target weights, and the mix is placed in shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All but the last return the columns of the documents, whatever their names. Columns need not be unique in value or free of nulls;
each operator's docstring says what becomes of nulls, empty texts, repeated ids and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramline.llm import decontam, mixing, near_dup, shard_tree, toxicity
from gramline.llm.queries import N_SHARDS, learnable, table
from gramline.plans.storage import scratch_path

#: No stage's rows can be stated in SQL: models, hashed draws and edit distances decide.
ORACLE_SQL = None


def _apart(docs: DataFrame) -> DataFrame:
    """(doc_id, text, own): the other columns in one, so that their names meet no operator's."""
    return docs.select("doc_id", "text", F.struct(*(c for c in docs.columns if c not in ("doc_id", "text"))).alias("own"))


def _whole(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of `docs` again."""
    return rows.select(*(c if c in ("doc_id", "text") else F.col("own").getField(c).alias(c) for c in docs.columns))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the tagger, learned from the labels, does not predict to be toxic."""
    tagger = toxicity.fit(docs.select("doc_id", "text"), table(spark, sf_dir, "labels"), learnable())
    return _whole(toxicity.score(_apart(docs), tagger).filter("predicted = 0"), docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates. Rows that repeat that id all stay."""
    kept = near_dup.near_duplicates(docs).filter("kept").select("ref")
    return _whole(_apart(docs).withColumn("ref", near_dup.row_ref()).join(kept, "ref", "left_semi"), docs)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    found = decontam.find_leaks(_apart(docs), table(spark, sf_dir, "benchmark"), least_words=1)
    return _whole(found.filter(F.size("leaks") == 0), docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a row for each pass over a source that takes words of a document, with those words as its text."""
    mixed = mixing.Mix(docs, keep=True).documents()
    return (mixed.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in mixed.columns else mixed).select(*docs.columns)


def place_in_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mixed rows with their shard, their slot in it, and their shard if there were one more."""
    return shard_tree.assign(docs, [1.0] * N_SHARDS, [1.0] * (N_SHARDS + 1))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("sharding", place_in_shards),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
