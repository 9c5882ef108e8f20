"""Registered corpus queries with production parameters, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.llm import centroids, infilling, ngram_join, quality_rules
from patronage.llm.centroids import cluster_report, cluster_vectors
from patronage.llm.decontamination import contaminated_passages
from patronage.llm.encoding import byte_bpe_50k, word_bpe_49k
from patronage.llm.id_files import read_documents, write_ids
from patronage.llm.length_histogram import length_histogram
from patronage.llm.main_text import extract_main_text
from patronage.llm.ngram_join import ngram_jaccard_join
from patronage.llm.packing import pack
from patronage.llm.quality_model import quality_scores
from patronage.llm.repeats import remove_repeats
from patronage.llm.suffix_tree import suffix_tree_scores
from patronage.llm.text import held_out
from patronage.llm.toxicity import toxicity_scores
from patronage.session import scratch_path


def _table(name: str):
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return read


_documents, _pages, _benchmark, _labels, _embeddings = map(_table, ("documents", "pages", "benchmark", "labels", "embeddings"))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return length_histogram(_documents(spark, sf_dir), byte_bpe_50k())


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(_documents(spark, sf_dir), size=3, percent=90)


def op3_min_cut_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_main_text(_pages(spark, sf_dir))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_documents(spark, sf_dir), length=100).select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_documents(spark, sf_dir), "v3").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op6_attention_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(_documents(spark, sf_dir), _labels(spark, sf_dir), held_out(F.col("doc_id"), 5, 0))


def op7_mixture_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(_documents(spark, sf_dir), byte_bpe_50k(), length=2048, end_id=1)


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated_passages(_documents(spark, sf_dir), _benchmark(spark, sf_dir), percent=10)


def op9_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "ids")
    write_ids(_documents(spark, sf_dir), path, word_bpe_49k(), end_id=2)
    return read_documents(spark, path)


def op10_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _documents(spark, sf_dir)
    return suffix_tree_scores(documents, held_out(documents["doc_id"], 7, 2))


def op11_equal_average_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cluster_report(cluster_vectors(_embeddings(spark, sf_dir), k=16, rounds=3, size=64, scale=64, seed=1))


def op12_exception_index_infilling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infilling.fill_in_middle(_documents(spark, sf_dir), seed=42, rate=50, suffix_first=80).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(infilling.restored("form", "output"), 256).alias("restored_sha256"),
    )


def op13_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_scores(_documents(spark, sf_dir), _labels(spark, sf_dir), held_out(F.col("doc_id"), 5, 0))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_min_cut_extraction": op3_min_cut_extraction,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_attention_classifier": op6_attention_classifier,
    "op7_mixture_packing": op7_mixture_packing,
    "op8_benchmark_decontamination": op8_benchmark_decontamination,
    "op9_bit_planes": op9_bit_planes,
    "op10_suffix_tree": op10_suffix_tree,
    "op11_equal_average_search": op11_equal_average_search,
    "op12_exception_index_infilling": op12_exception_index_infilling,
    "op13_compression_toxicity": op13_compression_toxicity,
}

ORACLES: dict[str, str] = {
    "op2_ngram_jaccard": ngram_join.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op11_equal_average_search": centroids.ORACLE,
    "op12_exception_index_infilling": infilling.ORACLE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}
