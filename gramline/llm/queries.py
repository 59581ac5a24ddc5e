"""Registered queries of the operators, each over its whole table with the operators' own settings."""

from __future__ import annotations

from pyspark.sql import functions as F

from gramline.llm import alignment, cover_tree, decontam, lexical, line_dedup, maxent, mixing, near_dup, nearest, repeats, shard_tree, token_files, toxicity
from gramline.plans.storage import scratch_path

N_SHARDS = 24


def table(spark, sf: str, name: str):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def op1_line_dedup(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    store = line_dedup.LineStore(spark)
    store.insert(docs)
    return store.mark(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def op2_repeated_bytes(spark, sf):
    cut = repeats.remove_repeats(table(spark, sf, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def learnable():
    """Rows whose labels may be learned."""
    return ~remainder(3, 1)


def remainder(divisor: int, value: int):
    """Whether crc32 of the id as text leaves `value`; false for a null id."""
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    return F.coalesce(crc % divisor == value, F.lit(False))


def op3_language_model(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", remainder(7, 2).alias("held_out"))
    return maxent.score(docs, ~F.col("held_out")).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op4_toxicity(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    tagger = toxicity.fit(docs, table(spark, sf, "labels"), learnable())
    scored = toxicity.score(docs, tagger)
    return scored.select("doc_id", remainder(3, 1).alias("held_out"), "score", "predicted", F.size("spans").alias("n_spans"))


def op5_token_counts(spark, sf):
    """Documents go to flat token files first; the scan counts what it finds there."""
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf, "documents"), path)
    found = token_files.scan(spark, path, head=token_files.HEAD)
    return found.select(token_files.doc_ids("head").alias("doc_id"), "n_tokens")


def op6_near_duplicates(spark, sf):
    found = near_dup.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op7_shard_tree(spark, sf):
    text = F.coalesce("text", F.lit(""))
    docs = table(spark, sf, "documents").select(
        "doc_id", (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    placed = shard_tree.assign(docs, [1.0] * N_SHARDS, [1.0] * (N_SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def op8_exact_top_k(spark, sf):
    vectors = nearest.quantised(table(spark, sf, "embeddings"))
    return nearest.top_k(vectors, F.col("vec_id") % 50 == 0)


def op9_mixing(spark, sf):
    mix = mixing.Mix(table(spark, sf, "documents"))
    return mix.taken().select("doc_id", "size", "source_size", "target", "taken")


def op10_decontamination(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    found = decontam.find_leaks(docs, table(spark, sf, "benchmark"), least_words=1)
    return found.select("doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


def op11_alignment(spark, sf):
    return alignment.link_statistics(table(spark, sf, "documents"))


def op12_embedding_duplicates(spark, sf):
    return cover_tree.near_duplicates(table(spark, sf, "embeddings"))


def op13_lexical_search(spark, sf):
    return lexical.search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup, op2_repeated_bytes, op3_language_model, op4_toxicity, op5_token_counts, op6_near_duplicates,
        op7_shard_tree, op8_exact_top_k, op9_mixing, op10_decontamination,
        op11_alignment, op12_embedding_duplicates, op13_lexical_search,
    )
}
