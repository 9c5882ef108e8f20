"""Exact token counts: a histogram of encoded lengths that answers every context limit.

Documents are encoded once and counted by length. Suffix sums over the lengths then give, for every
limit, how many documents reach it, their tokens, and the tokens left when texts are truncated there;
totals and quantiles are lookups. The sums run over stretches of lengths first and inside them second,
so no task holds all lengths.

Null and empty texts have length 0. Every row counts, also with a null or repeated doc_id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from patronage.llm.encoding import Vocabulary, encoded_blocks
from patronage.llm.text import column_bytes, store

STRETCH = 1024


def encoded_lengths(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(length, n): documents counted by encoded length, each task's before they are shuffled."""

    def lengths(batches):
        for batch in batches:
            raw, offsets = column_bytes(batch.column(0))
            found = [np.diff(first) for _, _, _, first in encoded_blocks(raw, offsets, vocabulary)]
            if found:
                length, n = np.unique(np.concatenate(found), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(length, pa.int64()), pa.array(n, pa.int64())], names=["length", "n"])

    return documents.select("text").mapInArrow(lengths, "length bigint, n bigint")


def length_histogram(documents: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """Per length that occurs: n_docs, n_tokens; docs_from, tokens_from (documents of this length or more);
    total_docs, total_tokens; truncated_tokens (the total when every text is cut at this length)."""
    # stored, because both sides of the join below read it: the texts are encoded once
    found = store(encoded_lengths(documents, vocabulary).groupBy("length").agg(F.sum("n").alias("n_docs")), "lengths")
    counts = found.withColumn("n_tokens", F.col("length") * F.col("n_docs")).withColumn("stretch", F.floor(F.col("length") / STRETCH))
    later = Window.orderBy(F.desc("stretch")).rowsBetween(Window.unboundedPreceding, -1)
    every = later.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    stretches = counts.groupBy("stretch").agg(F.sum("n_docs").alias("d"), F.sum("n_tokens").alias("t")).select(
        "stretch",
        F.coalesce(F.sum("d").over(later), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("t").over(later), F.lit(0)).alias("later_tokens"),
        F.sum("d").over(every).alias("total_docs"),
        F.sum("t").over(every).alias("total_tokens"),
    )
    inside = Window.partitionBy("stretch").orderBy(F.desc("length")).rowsBetween(Window.unboundedPreceding, 0)
    return (
        counts.join(stretches, "stretch")
        .select(
            "length", "n_docs", "n_tokens",
            (F.sum("n_docs").over(inside) + F.col("later_docs")).alias("docs_from"),
            (F.sum("n_tokens").over(inside) + F.col("later_tokens")).alias("tokens_from"),
            "total_docs", "total_tokens",
        )
        .withColumn("truncated_tokens", F.col("total_tokens") - F.col("tokens_from") + F.col("length") * F.col("docs_from"))
    )


def at_limits(histogram: DataFrame, limits: list[int]) -> DataFrame:
    """(context_limit, docs_over, truncated_tokens) for any limits, from the histogram alone."""
    answers = []
    for limit in limits:
        # the shortest length over a limit carries the sums of all documents over it
        first = F.min(F.when(F.col("length") > limit, F.struct("length", "docs_from", "tokens_from")))
        docs = F.coalesce(first["docs_from"], F.lit(0))
        total = F.coalesce(F.max("total_tokens"), F.lit(0))
        cut = total - F.coalesce(first["tokens_from"], F.lit(0)) + limit * docs
        answers.append(F.struct(F.lit(limit).alias("context_limit"), docs.alias("docs_over"), cut.alias("truncated_tokens")))
    return histogram.agg(F.array(*answers).alias("rows")).select(F.inline("rows"))


def at_quantiles(histogram: DataFrame, shares: list[float]) -> DataFrame:
    """(share, length): the smallest length that at least that share of documents do not exceed."""
    upto = F.col("total_docs") - F.col("docs_from") + F.col("n_docs")
    answers = [
        F.struct(F.lit(s).alias("share"), F.min(F.when(upto >= F.ceil(F.lit(s) * F.col("total_docs")), F.col("length"))).alias("length"))
        for s in map(float, shares)
    ]
    return histogram.agg(F.array(*answers).alias("rows")).select(F.inline("rows"))
