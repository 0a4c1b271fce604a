"""Queries of enrichment, dumps, coverage and upkeep, each with a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.operators import authors, incremental, linking, venues, verify
from stemma.session import shared_path, table
from stemma.sources import bulk

KNOWN = ["1-Urgent", "2-HIGH", "7-NONE"]


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    c, key = table(spark, sf, "customer"), F.col("c_custkey")
    ids = F.concat_ws(", ", key.cast("string"), (key + 1).cast("string"), F.lit(""))
    profiles = c.select(
        key.cast("string").alias("author_name"), F.when(key % 7 != 0, ids).otherwise("").alias("author_ids"), F.when(key % 3 != 0, "page").alias("homepage"), F.lit("a").alias("remote_affiliations"),
        *[F.lit(1).cast("bigint").alias(x) for x in ("remote_paper_count", "remote_citation_count", "remote_h_index")],
    )
    fetched = c.where(key % 5 != 0).select(
        key.cast("string").alias("author_id"), F.concat(F.lit("u"), key.cast("string")).alias("url"), F.array("c_mktsegment").alias("affiliations"), (key % 4).alias("paper_count"),
        (key % 9).alias("citation_count"), F.col("c_nationkey").cast("bigint").alias("h_index"),
    )
    return authors.enrich_authors(profiles, fetched)


def author_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    """LK5: authors with ids and without a homepage, the records of their ids merged, counters."""
    return _enriched(spark, sf)


ENRICH_SQL = """
WITH p AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 = 0 AND c_custkey % 7 <> 0),
a AS (SELECT k, k + i AS id, i FROM p, (VALUES (0), (1)) v(i)),
f AS (SELECT a.k, a.i, c.c_custkey AS id, c_mktsegment AS s, c_nationkey AS h FROM a LEFT JOIN customer c ON c.c_custkey = a.id AND c.c_custkey % 5 <> 0),
s AS (SELECT k, string_agg(s, ',' ORDER BY i) AS remote_affiliations FROM (SELECT k, s, min(i) AS i FROM f WHERE id IS NOT NULL GROUP BY 1, 2) GROUP BY 1)
SELECT CAST(f.k AS VARCHAR) AS author_name, string_agg('u' || id, ',' ORDER BY i) FILTER (id IS NOT NULL) AS homepage, any_value(remote_affiliations) AS remote_affiliations,
       CAST(sum(id % 4) AS BIGINT) AS remote_paper_count, CAST(sum(id % 9) AS BIGINT) AS remote_citation_count, CAST(max(h) AS BIGINT) AS remote_h_index,
       count(*) AS ids_asked, count(id) AS ids_found, count(id) > 0 AS was_updated FROM f LEFT JOIN s ON s.k = f.k GROUP BY f.k
"""


def author_enrichment_totals(spark: SparkSession, sf: str) -> DataFrame:
    """LK5: the counters of the whole enrichment."""
    return authors.enrichment_totals(_enriched(spark, sf))


def search_titles(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ20: the title to search for, whether a record is linked, the tier in words."""
    key = F.col("p_partkey")
    tier = F.when(key % 4 == 0, "Tier2_Enhanced_High").when(key % 4 == 1, "Tier1_Dataset_Medium").when(key % 4 == 2, "Tier3_NoMatch")
    p = table(spark, sf, "part").select(
        "p_partkey", F.col("p_name").alias("title"), F.when(key % 3 == 0, F.col("p_brand")).when(key % 3 == 1, "").alias("remote_title"), F.when(key % 2 == 0, key.cast("string")).alias("remote_paper_id"), tier.alias("validation_tier")
    )
    return p.select("p_partkey", linking.search_title().alias("search_title"), linking.is_linked().alias("is_linked"), linking.tier_text().alias("tier"))


SEARCH_SQL = f"""
SELECT p_partkey, CASE WHEN p_partkey % 3 = 0 AND p_brand <> '' THEN p_brand ELSE p_name END AS search_title, p_partkey % 2 = 0 AS is_linked,
       CASE p_partkey % 4 WHEN 0 THEN '{linking.TIER_TEXT["High"]}' WHEN 1 THEN '{linking.TIER_TEXT["Medium"]}' WHEN 2 THEN '{linking.TIER_TEXT["NoMatch"]}' ELSE 'unknown' END AS tier FROM part
"""


def conference_membership(spark: SparkSession, sf: str) -> DataFrame:
    """MT18: rows of known and unknown conferences, whatever their case."""
    rows = venues.membership(table(spark, sf, "orders").select("o_orderpriority"), venues.conferences(spark, KNOWN), "o_orderpriority")
    return rows.groupBy("o_orderpriority", "is_known").agg(F.count("*").alias("papers"))


MEMBER_SQL = f"SELECT o_orderpriority, lower(o_orderpriority) IN ({', '.join(repr(c.lower()) for c in KNOWN)}) AS is_known, count(*) AS papers FROM orders GROUP BY 1, 2"


def _arrays(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_list(F.col("l_suppkey").cast("string")).alias("ids"))


def author_array_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """V6: authors in the papers' arrays that the cache lacks, with their number of papers."""
    cache = table(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").cast("string").alias("author_id"))
    each = _arrays(spark, sf).select("l_orderkey", F.explode(F.array_distinct("ids")).alias("author_id"))
    return each.join(cache, "author_id", "left_anti").groupBy("author_id").agg(F.count("*").alias("papers"))


ARRAYS_SQL = "SELECT CAST(l_suppkey AS VARCHAR) AS author_id, count(DISTINCT l_orderkey) AS papers FROM lineitem WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_suppkey % 2 = 0) GROUP BY 1"


def json_list_elements(spark: SparkSession, sf: str) -> DataFrame:
    """NS2: elements of JSON lists in text, counted; text that is no list has none."""
    text = F.when(F.col("l_orderkey") % 3 == 0, "no list").otherwise(F.to_json("ids"))
    each = _arrays(spark, sf).select(F.explode(F.from_json(text, "array<string>")).alias("author_id"))
    return each.groupBy("author_id").agg(F.count("*").alias("places"))


def missing_keys(spark: SparkSession, sf: str) -> DataFrame:
    """ST2: customers without an urgent finished order."""
    orders = table(spark, sf, "orders").where("o_orderpriority = '1-URGENT' AND o_orderstatus = 'F'")
    return incremental.missing_keys(table(spark, sf, "customer"), orders.select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


def id_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """SO5: orders in seven ranges of ids."""
    parts = incremental.id_ranges(table(spark, sf, "orders"), "o_orderkey", 7)
    return parts.groupBy("part").agg(F.count("*").alias("papers"), F.min("o_orderkey").alias("first_id"), F.max("o_orderkey").alias("last_id"))


RANGES_SQL = """
WITH b AS (SELECT min(o_orderkey) AS lo, greatest(1, (max(o_orderkey) - min(o_orderkey)) // 7) AS w FROM orders)
SELECT CAST(least((o_orderkey - lo) // w, 6) AS INTEGER) AS part, count(*) AS papers, min(o_orderkey) AS first_id, max(o_orderkey) AS last_id FROM orders, b GROUP BY 1
"""


def column_facts(spark: SparkSession, sf: str) -> DataFrame:
    """V5: columns of the labelled documents with rows and filled values."""
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left")
    return verify.column_facts(d.select("doc_id", "lang", "quality")).select("column", "rows", "filled")


FACTS_SQL = """
WITH d AS (SELECT d.doc_id, d.lang, l.quality FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT 'doc_id' AS "column", count(*) AS rows, count(doc_id) AS filled FROM d
UNION ALL SELECT 'lang', count(*), count(lang) FROM d UNION ALL SELECT 'quality', count(*), count(quality) FROM d
"""


def _dump(spark: SparkSession, sf: str, name: str, rows: DataFrame) -> list[str]:
    """``rows`` as a dump of gzipped JSON lines in the shared folder; its files."""
    path = shared_path(spark, name)
    rows.select(F.to_json(F.struct("*"))).write.option("compression", "gzip").text(path)
    return bulk.dump_files(spark, path)


def bulk_papers(spark: SparkSession, sf: str) -> DataFrame:
    """SRC2-SRC5, SRC7, SRC8, PRJ1, PRJ3: papers of a dump with either spelling of keys; papers without venue or title go."""
    key = F.col("o_orderkey")
    rows = table(spark, sf, "orders").select(
        F.when(key % 2 == 0, key).alias("corpusid"), F.when(key % 2 != 0, key).alias("corpusId"), F.when(key % 11 != 0, F.concat(F.lit("T "), key.cast("string"))).otherwise(" ").alias("title"),
        F.when(key % 5 != 0, F.col("o_orderpriority")).alias("venue"), F.year("o_orderdate").alias("year"), F.when(key % 4 != 0, F.col("o_custkey")).alias("citationCount"), F.when(key % 3 == 0, "True").otherwise("no").alias("isopenaccess"),
    )
    papers = bulk.paper_rows(spark, _dump(spark, sf, "paper_dump", rows))
    return papers.select("corpus_id", "title", "venue", "year", "citation_count", "is_open_access", F.col("source_file").endswith(".gz").alias("named"))


PAPERS_SQL = """
SELECT o_orderkey AS corpus_id, 'T ' || o_orderkey AS title, o_orderpriority AS venue, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(CASE WHEN o_orderkey % 4 <> 0 THEN o_custkey ELSE 0 END AS INTEGER) AS citation_count,
       o_orderkey % 3 = 0 AS is_open_access, true AS named FROM orders WHERE o_orderkey % 11 <> 0 AND o_orderkey % 5 <> 0
"""


def bulk_authors(spark: SparkSession, sf: str) -> DataFrame:
    """SRC6, PRJ6: authors of a dump; lines without an id or a name go, counts are 0 by default."""
    key = F.col("c_custkey")
    rows = table(spark, sf, "customer").select(
        F.when(key % 7 != 0, key.cast("string")).alias("authorid"), F.col("c_name").alias("name"), F.array("c_mktsegment").alias("affiliations"),
        F.when(key % 2 == 0, F.col("c_nationkey")).alias("hindex"), F.struct(F.lit("x").alias("ORCID")).alias("externalids"),
    )
    found = bulk.author_rows(spark, _dump(spark, sf, "author_dump", rows))
    return found.select("author_id", "name", F.array_join("affiliations", ",").alias("affiliations"), "h_index", "paper_count", F.col("external_ids")["ORCID"].alias("orcid"))


AUTHORS_SQL = """
SELECT CAST(c_custkey AS VARCHAR) AS author_id, c_name AS name, c_mktsegment AS affiliations, CAST(CASE WHEN c_custkey % 2 = 0 THEN c_nationkey ELSE 0 END AS INTEGER) AS h_index,
       CAST(0 AS INTEGER) AS paper_count, 'x' AS orcid FROM customer WHERE c_custkey % 7 <> 0
"""

QUERIES = {
    "author_enrichment": author_enrichment, "author_enrichment_totals": author_enrichment_totals, "search_titles": search_titles, "conference_membership": conference_membership,
    "author_array_coverage": author_array_coverage, "json_list_elements": json_list_elements, "missing_keys": missing_keys, "id_ranges": id_ranges, "column_facts": column_facts,
    "bulk_papers": bulk_papers, "bulk_authors": bulk_authors,
}

ORACLES = {
    "author_enrichment": ENRICH_SQL,
    "author_enrichment_totals": f"SELECT count(*) AS authors, count(*) FILTER (was_updated) AS updated, CAST(sum(ids_asked) AS BIGINT) AS ids_asked, CAST(sum(ids_found) AS BIGINT) AS ids_found FROM ({ENRICH_SQL})",
    "search_titles": SEARCH_SQL, "conference_membership": MEMBER_SQL, "author_array_coverage": ARRAYS_SQL,
    "json_list_elements": "SELECT CAST(l_suppkey AS VARCHAR) AS author_id, count(*) AS places FROM lineitem WHERE l_orderkey % 3 <> 0 GROUP BY 1",
    "missing_keys": "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT' AND o_orderstatus = 'F')", "id_ranges": RANGES_SQL, "column_facts": FACTS_SQL,
    "bulk_papers": PAPERS_SQL, "bulk_authors": AUTHORS_SQL,
}
