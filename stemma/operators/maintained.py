"""Author profiles kept up to date: signed contributions of changed papers, merged into state by author and year (AG1, IN1, IN2).

The state is a bucketed table keyed by author and year: papers, citations and positions are sums, and
the first and last year are those with papers left, so that a paper can be taken back as well as
added.  A batch reads and writes the buckets of its own authors and years, no others.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.session import shared_path
from stemma.sources import buckets

KEYS, SUMS = ["author_id", "year"], ["papers", "citations", "first", "last"]


def contributions(auth: DataFrame, papers: DataFrame) -> DataFrame:
    """(author_id, year, papers, citations, first, last): what whole papers add to their authors.

    ``auth(paper_id, author_id, position)`` has every author of a paper, ``papers(paper_id, year, citations)``;
    a paper without facts has a null year.  Ties in position go to the smaller first and the larger last id.
    """
    key = F.struct("position", "author_id")
    ends = auth.groupBy("paper_id").agg(F.min(key)["author_id"].alias("first_id"), F.max(key)["author_id"].alias("last_id"))
    rows = auth.join(ends, "paper_id").join(papers, "paper_id", "left")
    return rows.groupBy(*KEYS).agg(
        F.count("*").alias("papers"), F.coalesce(F.sum("citations"), F.lit(0)).cast("bigint").alias("citations"),
        F.count_if(F.col("author_id") == F.col("first_id")).alias("first"), F.count_if(F.col("author_id") == F.col("last_id")).alias("last"),
    )


def change(spark: SparkSession, path: str, come: DataFrame | None, gone: DataFrame | None = None, size: int = 64) -> int:
    """Add the contributions ``come`` and take back ``gone``; returns how many (author, year) pairs changed.

    A paper that changes is taken back as it was and added as it is.  The table at ``path`` is created
    when it is missing.  Taking back what was never added makes a count negative and raises ValueError.
    """
    parts = [df.select(*KEYS, *[(F.col(c) * sign).alias(c) for c in SUMS]) for df, sign in ((come, 1), (gone, -1)) if df is not None]
    both = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    delta = both.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" OR ".join(f"{c} <> 0" for c in SUMS))
    if buckets.layout(spark, path) is None:
        buckets.create(spark, path, delta, KEYS, buckets=size)
    about = buckets.layout(spark, path)
    kept = shared_path(spark, "profile-delta")
    delta.withColumn("_bucket", buckets.bucket_of(KEYS, about.buckets)).write.parquet(kept)
    delta = spark.read.parquet(kept)
    touched = [r[0] for r in delta.select("_bucket").distinct().collect()]  # as many as there are buckets at most
    held = buckets.read(spark, path, touched)
    merged = delta.drop("_bucket")
    if held is not None:
        old = held.select(*[F.col(c).alias(f"_{c}") for c in (*KEYS, *SUMS)])
        same = F.col("author_id").eqNullSafe(F.col("_author_id")) & F.col("year").eqNullSafe(F.col("_year"))
        merged = merged.join(old, same, "left").select(*KEYS, *[(F.col(c) + F.coalesce(f"_{c}", F.lit(0))).alias(c) for c in SUMS])
    if not merged.where("papers < 0").isEmpty():
        raise ValueError("papers are taken back that were not added")
    return sum(buckets.upsert(spark, path, merged))


def yearly_totals(state: DataFrame, as_of_year: int) -> DataFrame:
    """One row of counts for each author that has papers left, as ``profiles.finished`` wants them."""
    left = state.where("papers > 0")
    return left.groupBy("author_id").agg(
        F.sum("papers").alias("paper_count"), F.sum("citations").alias("total_citations"), F.min("year").alias("first_year"), F.max("year").alias("latest_year"),
        F.sum("first").alias("first_author_count"), F.sum("last").alias("last_author_count"), F.sum(F.when(F.col("year") >= as_of_year - 3, F.col("papers")).otherwise(0)).alias("recent"),
    )
