"""The corpus pipeline: quality filter, near-copy removal, passage removal, packing.

Every stage takes (spark, docs, sf_dir), where docs is a table that has been read from Parquet, and
returns a DataFrame; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.llm.chunkdedup import dedup_chunks
from stemma.llm.common import free_name, materialize, table
from stemma.llm.packing import pack_documents
from stemma.llm.quality import keep_good_documents
from stemma.llm.simhash import keep_one_of_each_group

#: Documents with a lower calibrated probability of being good go.
LEAST_QUALITY = 0.3


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from ``labels``, does not reject; empty texts are judged too."""
    return keep_good_documents(docs, table(spark, sf_dir, "labels"), LEAST_QUALITY)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose sets of 5-word shingles are similar by 0.8 or more."""
    return keep_one_of_each_group(docs, k=5)


def passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that stand in an earlier one; ``n_chars`` follows the text."""
    spans = free_name(docs, "_spans")
    rows = dedup_chunks(docs, spans=spans)
    return rows.select(
        *[
            F.when(F.size(spans) > 0, F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars") if c == "n_chars" else F.col(f"`{c}`")
            for c in docs.columns
        ]
    )


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids in sequences of at most 1024, with their places and step groups."""
    return pack_documents(docs, most_words=250_000, batch_rows=500, keep=False)  # workers serve other stages too


STAGES = [("quality", quality), ("near_copies", near_copies), ("passages", passages), ("packing", packing)]

#: Fits, fingerprints, chunks and token ids are beyond SQL; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
