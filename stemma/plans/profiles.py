"""Author profile: the flagship aggregation over authorships and papers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.session import table

AS_OF_YEAR = 2001


def authorships(lines: DataFrame) -> DataFrame:
    """(paper, author, position): one row for each author of a paper, at the first position.

    Lines are dealt and sorted by paper once; what is asked of whole papers later needs no other shuffle or sort.
    """
    rows = lines.select(F.col("l_orderkey").alias("paper_id"), F.col("l_suppkey").alias("author_id"), F.col("l_linenumber").alias("position"))
    same = Window.partitionBy("paper_id", "author_id").orderBy(F.asc_nulls_last("position"))
    return rows.repartition("paper_id").withColumn("_k", F.row_number().over(same)).where("_k = 1").drop("_k")


def with_byline_ends(auth: DataFrame) -> DataFrame:
    """Authorships with first and last author of their paper; ties in position go to the smaller / larger author id.

    Papers without a number are left out.
    """
    key, paper = F.struct("position", "author_id"), Window.partitionBy("paper_id")
    ends = auth.where(F.col("paper_id").isNotNull()).withColumns({"_first": F.min(key).over(paper), "_last": F.max(key).over(paper)})
    return ends.select(*auth.columns, F.col("_first.author_id").alias("first_author_id"), F.col("_last.author_id").alias("last_author_id"))


def papers(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("paper_id"),
        F.year("o_orderdate").alias("year"),
        F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("citations"),
    )


def author_profile(auth: DataFrame, paper: DataFrame, as_of_year: int) -> DataFrame:
    """Counts, citation sums, career length and position shares for each author.

    ``middle_author_count`` may be negative when an author is alone on a paper (both first and
    last); it is kept, as downstream readers expect it.  The career length runs to ``as_of_year``,
    never to the clock.
    """
    rows = with_byline_ends(auth).join(paper, "paper_id", "left")

    def share(flag: Column) -> Column:
        return F.count_if(flag).cast("bigint")

    counts = rows.groupBy("author_id").agg(
        F.count("*").alias("paper_count"),
        F.coalesce(F.sum("citations"), F.lit(0)).cast("bigint").alias("total_citations"),
        F.min("year").alias("first_year"),
        F.max("year").alias("latest_year"),
        share(F.col("author_id") == F.col("first_author_id")).alias("first_author_count"),
        share(F.col("author_id") == F.col("last_author_id")).alias("last_author_count"),
        share(F.col("year") >= as_of_year - 3).alias("recent"),
    )
    return finished(counts, as_of_year)


def finished(counts: DataFrame, as_of_year: int) -> DataFrame:
    """Shares, scores and career length from the counts of each author."""
    n = F.col("paper_count").cast("double")
    first, last = F.col("first_author_count") / n, F.col("last_author_count") / n
    return counts.select(
        "author_id",
        "paper_count",
        "total_citations",
        F.round(F.col("total_citations") / n, 6).alias("avg_citations"),
        "first_year",
        "latest_year",
        (F.lit(as_of_year) - F.col("first_year") + 1).cast("int").alias("career_length"),
        "first_author_count",
        "last_author_count",
        (F.col("paper_count") - F.col("first_author_count") - F.col("last_author_count")).alias("middle_author_count"),
        F.round(first, 6).alias("first_author_ratio"),
        F.round(last, 6).alias("last_author_ratio"),
        F.round(first * 0.4 + last * 0.6, 6).alias("contribution_score"),
        F.round(F.col("recent") / n, 6).alias("rising_star_score"),
    )


def author_profile_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AG1 over the star schema: orders are papers, suppliers are authors, line numbers positions."""
    return author_profile(
        authorships(table(spark, sf_dir, "lineitem")), papers(table(spark, sf_dir, "orders")), AS_OF_YEAR
    )


AUTH_SQL = """
auth AS (SELECT l_orderkey AS paper_id, l_suppkey AS author_id, min(l_linenumber) AS position
         FROM lineitem GROUP BY 1, 2),
ends AS (SELECT paper_id, arg_min(author_id, CAST(position AS BIGINT) * 1000000000 + author_id) AS first_author_id,
                arg_max(author_id, CAST(position AS BIGINT) * 1000000000 + author_id) AS last_author_id
         FROM auth GROUP BY 1),
paper AS (SELECT o_orderkey AS paper_id, CAST(year(o_orderdate) AS INTEGER) AS year,
                 CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations FROM orders)
"""

PROFILE_SQL = f"""
WITH {AUTH_SQL},
c AS (SELECT author_id, count(*) AS paper_count,
             CAST(coalesce(sum(citations), 0) AS BIGINT) AS total_citations,
             min(year) AS first_year, max(year) AS latest_year,
             count(*) FILTER (author_id = first_author_id) AS first_author_count,
             count(*) FILTER (author_id = last_author_id) AS last_author_count,
             count(*) FILTER (year >= {AS_OF_YEAR} - 3) AS recent
      FROM auth JOIN ends USING (paper_id) LEFT JOIN paper USING (paper_id) GROUP BY 1)
SELECT author_id, paper_count, total_citations, round(total_citations / paper_count, 6) AS avg_citations,
       first_year, latest_year, CAST({AS_OF_YEAR} - first_year + 1 AS INTEGER) AS career_length,
       first_author_count, last_author_count,
       paper_count - first_author_count - last_author_count AS middle_author_count,
       round(first_author_count / paper_count, 6) AS first_author_ratio,
       round(last_author_count / paper_count, 6) AS last_author_ratio,
       round(first_author_count / paper_count * 0.4 + last_author_count / paper_count * 0.6, 6) AS contribution_score,
       round(recent / paper_count, 6) AS rising_star_score
FROM c
"""
