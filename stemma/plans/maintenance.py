"""Queries over tables that change: bucketed upserts, replaced and dropped partitions, each with a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.operators import maintained
from stemma.plans import profiles
from stemma.plans.composed import PAPERS_SQL, paper_facts
from stemma.session import shared_path, table
from stemma.sources import buckets, manifests, tables

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"]


def _changes(spark: SparkSession, sf: str) -> list[DataFrame]:
    """Three batches for a table of orders: most of them, changed and late ones, changed once more with new keys."""
    o = table(spark, sf, "orders").select(*ORDER_COLUMNS)
    late = o.where("o_orderkey % 4 = 0 OR o_custkey % 5 = 0").withColumn("o_totalprice", F.round(F.col("o_totalprice") * 2, 2))
    last = o.where("o_custkey % 7 = 0").withColumns({"o_orderstatus": F.lit("X"), "o_orderkey": F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")).otherwise(-F.col("o_orderkey"))})
    return [o.where("o_orderkey % 4 <> 0"), late, last]


def _changed_table(spark: SparkSession, sf: str, filled: bool = False) -> tuple[str, list[tuple[int, int]]]:
    path, batches = shared_path(spark, "orders-in-buckets"), _changes(spark, sf)
    if filled:
        odd = F.col("o_orderkey") % 2 != 0
        batches = [b.withColumns({"o_orderstatus": F.when(odd, F.col("o_orderstatus")), "o_totalprice": F.when(~odd, F.col("o_totalprice"))}) if k else b for k, b in enumerate(batches)]
    buckets.create(spark, path, batches[0], ["o_orderkey"], buckets=16, filled=filled)
    return path, [buckets.upsert(spark, path, b) for b in batches]


def bucket_upserts(spark: SparkSession, sf: str) -> DataFrame:
    """SNK1, SNK4, IN6, MT17: orders after three batches, newest wins."""
    return buckets.read(spark, _changed_table(spark, sf)[0])


_BATCHES_SQL = """
b AS (
    SELECT 1 AS d, o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 4 <> 0
    UNION ALL SELECT 2, o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 2, 2) FROM orders WHERE o_orderkey % 4 = 0 OR o_custkey % 5 = 0
    UNION ALL SELECT 3, CASE WHEN o_orderkey % 2 = 0 THEN o_orderkey ELSE -o_orderkey END, o_custkey, 'X', o_totalprice FROM orders WHERE o_custkey % 7 = 0
)
"""
UPSERTS_SQL = f"WITH {_BATCHES_SQL} SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM b QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY d DESC) = 1"


def bucket_upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    """SNK24, SNK6: inserted and updated keys of each of the three batches."""
    rows = [(k, *n) for k, n in enumerate(_changed_table(spark, sf)[1], 1)]
    return spark.createDataFrame(rows, "batch int, inserted bigint, updated bigint")


UPSERT_COUNTS_SQL = f"""
WITH {_BATCHES_SQL}, k AS (SELECT d, d > min(d) OVER (PARTITION BY o_orderkey) AS again FROM b)
SELECT CAST(d AS INTEGER) AS batch, count(*) FILTER (NOT again) AS inserted, count(*) FILTER (again) AS updated FROM k GROUP BY d
"""


def bucket_upserts_filled(spark: SparkSession, sf: str) -> DataFrame:
    """SNK2, SNK3: the same batches where only values that are not null replace old ones, after compaction."""
    path, _ = _changed_table(spark, sf, filled=True)
    buckets.compact(spark, path)
    return buckets.read(spark, path)


FILLED_SQL = f"""
WITH {_BATCHES_SQL}, n AS (
    SELECT d, o_orderkey, o_custkey, CASE WHEN d = 1 OR o_orderkey % 2 <> 0 THEN o_orderstatus END AS s, CASE WHEN d = 1 OR o_orderkey % 2 = 0 THEN o_totalprice END AS p FROM b
)
SELECT o_orderkey, arg_max(o_custkey, d) AS o_custkey, arg_max(s, d) FILTER (s IS NOT NULL) AS o_orderstatus, arg_max(p, d) FILTER (p IS NOT NULL) AS o_totalprice FROM n GROUP BY o_orderkey
"""


def partition_maintenance(spark: SparkSession, sf: str) -> DataFrame:
    """PQ6, SNK10: of papers by year (15 later, so that each is a partition), 2010 written anew, 2007 dropped, 2012 detached, changed and attached."""
    path = shared_path(spark, "papers-changed")
    papers = paper_facts(spark, sf).withColumn("year", F.col("year") + 15).withColumn("year_bucket", tables.year_bucket())
    tables.overwrite(tables.dealt(papers, "year_bucket"), path, "year_bucket")
    some = tables.in_years(spark.read.parquet(path), 2010, 2010).where("paper_id % 3 <> 0").withColumn("citations", F.col("citations") + 1)
    aside = shared_path(spark, "papers-of-2010")
    some.write.parquet(aside)  # a partition cannot be read while it is written
    tables.replace_partitions(spark.read.parquet(aside), path, "year_bucket")
    tables.drop_partition(spark, path, "2007")
    out, back = shared_path(spark, "papers-out"), shared_path(spark, "papers-back")
    tables.detach_partition(spark, path, "2012", out)
    spark.read.parquet(out).withColumn("conference", F.lit("moved")).write.parquet(back)
    tables.attach_partition(spark, back, path, "2012")
    return spark.read.parquet(path).select("paper_id", "year", "citations", "conference")


PARTITIONS_SQL = f"""
SELECT paper_id, year + 15 AS year, CASE WHEN year = 1995 THEN citations + 1 ELSE citations END AS citations, CASE WHEN year = 1997 THEN 'moved' ELSE conference END AS conference
FROM {PAPERS_SQL} WHERE year IS NULL OR (year <> 1992 AND (year <> 1995 OR paper_id % 3 <> 0))
"""

def profiles_after_changes(spark: SparkSession, sf: str) -> DataFrame:
    """AG1, IN1, IN2: profiles after three batches: four fifths of the papers, the others, changed and withdrawn ones."""
    auth, papers = profiles.authorships(table(spark, sf, "lineitem")), profiles.papers(table(spark, sf, "orders"))
    path = shared_path(spark, "profile-state")
    of = lambda some, facts=papers: maintained.contributions(auth.where(some), facts)
    maintained.change(spark, path, of("paper_id % 5 <> 0"), size=8)
    maintained.change(spark, path, of("paper_id % 5 = 0"))
    doubled = papers.withColumns({"citations": F.col("citations") * 2, "year": F.col("year") + 1})
    maintained.change(spark, path, of("paper_id % 7 = 0 AND paper_id % 11 <> 0", doubled), of("paper_id % 7 = 0 OR paper_id % 11 = 0"))
    return profiles.finished(maintained.yearly_totals(buckets.read(spark, path), profiles.AS_OF_YEAR), profiles.AS_OF_YEAR)


CHANGED_SQL = (
    profiles.PROFILE_SQL.replace("FROM lineitem GROUP", "FROM lineitem WHERE l_orderkey % 11 <> 0 GROUP")
    .replace("CAST(year(o_orderdate) AS INTEGER) AS year", "CAST(year(o_orderdate) + CASE WHEN o_orderkey % 7 = 0 THEN 1 ELSE 0 END AS INTEGER) AS year")
    .replace("CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations", "CAST(floor(o_totalprice / 1000) AS BIGINT) * CASE WHEN o_orderkey % 7 = 0 THEN 2 ELSE 1 END AS citations")
)


def manifest_restore(spark: SparkSession, sf: str) -> DataFrame:
    """SNK21, SNK22: customers as restored from the first of two snapshots, the table having been overwritten between."""
    path, store, back = (shared_path(spark, x) for x in ("customers", "snapshots", "customers-back"))
    rows = table(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    tables.overwrite(rows.repartition(4), path)
    manifests.snapshot(spark, path, store, "first")
    tables.overwrite(rows.where("c_custkey % 2 = 0").repartition(2), path)
    manifests.snapshot(spark, path, store, "second")
    return manifests.restore(spark, store, "first", back)


QUERIES = {
    "bucket_upserts": bucket_upserts, "bucket_upsert_counts": bucket_upsert_counts, "bucket_upserts_filled": bucket_upserts_filled, "partition_maintenance": partition_maintenance,
    "profiles_after_changes": profiles_after_changes, "manifest_restore": manifest_restore,
}

ORACLES = {
    "bucket_upserts": UPSERTS_SQL, "bucket_upsert_counts": UPSERT_COUNTS_SQL, "bucket_upserts_filled": FILLED_SQL, "partition_maintenance": PARTITIONS_SQL,
    "profiles_after_changes": CHANGED_SQL, "manifest_restore": "SELECT c_custkey, c_name, c_acctbal, c_mktsegment FROM customer",
}
