"""The corpus pipeline: quality rules, near duplicates, repeated passages, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as
the next stage's docs. All but the last return the columns of `documents`. Rows with a null doc_id
are kept by every stage that can judge them alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from patronage.llm import quality_rules
from patronage.llm.decontamination import drop_contaminated
from patronage.llm.encoding import byte_bpe_50k
from patronage.llm.ngram_join import ngram_jaccard_join
from patronage.llm.packing import pack
from patronage.llm.repeats import remove_repeats
from patronage.llm.text import store


def reject_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept. Judged row by row, so repeated rows stay repeated."""
    judged = quality_rules.quality_rules(docs, "v3", carry=docs.columns)
    # without a column that differs between tasks the condition would move below the measurements and
    # compute each of them once more wherever a rule mentions it
    kept = judged.withColumn("task", F.spark_partition_id()).where("kept and task >= 0")
    return kept.select(*(F.col("row")[c].alias(c) for c in docs.columns))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest document of each group of five-word shingle sets with similarity 0.8 or more.

    Rows of one doc_id are one node, so of rows that repeat the smallest doc_id one stays.
    """
    groups = ngram_jaccard_join(docs, size=5, percent=80)
    lost = groups.where("doc_id <> component_id").select("doc_id").distinct()
    left = docs.join(lost, "doc_id", "left_anti").select(*docs.columns)
    # only ids that occur more than once need the choice of a row
    twice = groups.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 and doc_id is not null").select("doc_id")
    if twice.isEmpty():
        return left
    return left.join(twice, "doc_id", "left_anti").select(*docs.columns).unionByName(
        left.join(twice, "doc_id", "left_semi").select(*docs.columns).dropDuplicates(["doc_id"])
    )


def remove_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that occur earlier; a character cut in two is removed."""
    cut = remove_repeats(docs, length=100, carry=[c for c in docs.columns if c != "text"])
    columns = {c: F.col("kept_text") if c == "text" else F.col("row")[c] for c in docs.columns}
    if "n_chars" in docs.columns:
        changed = F.size("spans") > 0
        columns["n_chars"] = F.when(changed, F.length("kept_text").cast("bigint")).otherwise(F.col("row")["n_chars"])
    return cut.select(*(columns[c].alias(c) for c in docs.columns))


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage within a tenth of its bytes in edits of a benchmark item."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"), percent=10)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 2048 tokens, each with the mixture of the sources."""
    return pack(docs, byte_bpe_50k(), length=2048, end_id=1)


STAGES = [
    ("quality rules", reject_by_rules),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("suffix-array dedup", remove_repeated_passages),
    ("benchmark decontamination", drop_benchmark_passages),
    ("packing", pack_sequences),
]

#: SQL has neither the tokenizer nor the alignment; tests compare every stage with plain Python
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
