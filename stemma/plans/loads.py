"""Queries over dumps, responses and the tables that are loaded from them, each with a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.operators import authors, linking, venues
from stemma.session import shared_path, table
from stemma.sources import bulk, tables
from stemma.sources.schemas import BIBLIOGRAPHY_KEY


def _paper_dump(spark: SparkSession, sf: str) -> list[str]:
    """Orders as a dump of papers: both spellings of keys, every shape of a field that a dump has."""
    key, text = F.col("o_orderkey"), lambda c: c.cast("string")
    author = lambda n: F.struct(text((F.col("o_custkey") + n) % 50).alias("authorId"), F.concat(F.lit("Ann Bo"), text((F.col("o_custkey") + n) % 7)).alias("name"))
    ids = F.map_from_entries(F.array(F.struct(F.lit("DOI"), F.concat(F.lit("10.1/"), text(key))), F.struct(F.lit(BIBLIOGRAPHY_KEY), F.concat(F.lit("conf/"), text(key)))))
    kind = F.array(F.struct(F.col("o_orderstatus").alias("category")))
    rows = table(spark, sf, "orders").select(
        F.when(key % 2 == 0, key).alias("corpusid"), F.when(key % 2 != 0, text(key)).alias("corpusId"),
        F.concat(F.lit("https://x.org/paper/"), F.sha1(text(key))).alias("url"), F.when(key % 3 == 0, F.concat(F.lit("p"), text(key))).alias("paperId"),
        F.when(key % 13 == 0, " ").otherwise(F.concat(F.lit("Title: T "), text(key))).alias("title"), F.when(key % 2 == 0, "about").alias("abstract"),
        F.when(key % 5 != 0, F.concat(F.lit(" Proc. "), F.col("o_orderpriority"), F.lit(" "))).alias("venue"), F.when(key % 7 != 0, F.year("o_orderdate")).alias("year"),
        F.when(key % 2 == 0, F.col("o_custkey")).alias("citationcount"), F.when(key % 2 != 0, F.col("o_custkey")).alias("citationCount"), F.when(key % 4 == 0, "many").otherwise("3").alias("referenceCount"),
        F.when(key % 3 == 0, key % 10).alias("influentialcitationcount"), F.when(key % 6 != 0, F.array(author(0), author(1))).alias("authors"), F.when(key % 4 != 0, ids).alias("externalIds"),
        F.when(key % 4 == 0, F.array(F.lit("One"), F.lit("Two"))).alias("fieldsOfStudy"), F.when(key % 4 == 1, F.array(F.lit("Low"))).alias("fieldsofstudy_"), F.when(key % 4 == 2, kind).alias("s2fieldsofstudy"),
        F.when(key % 4 == 3, kind).alias("s2FieldsOfStudy_"), F.when(key % 2 == 0, F.array(F.lit("Review"), F.lit("Book"))).alias("publicationtypes"), (key % 3 == 0).alias("isopenaccess"),
        F.when(key % 2 == 0, F.struct(F.concat(F.lit("u"), text(key)).alias("url"))).alias("openaccesspdf"), F.when(key % 2 != 0, F.concat(F.lit("v"), text(key))).alias("openAccessPdf_"),
    )
    line = F.to_json(F.struct("*"))
    for name in ("fieldsofstudy", "s2FieldsOfStudy", "openAccessPdf"):  # spellings that one row of a table cannot have side by side
        line = F.replace(line, F.lit(f'"{name}_":'), F.lit(f'"{name}":'))
    path = shared_path(spark, "paper-dump")
    rows.select(line).write.option("compression", "gzip").text(path)
    return bulk.dump_files(spark, path)


def bulk_paper_columns(spark: SparkSession, sf: str) -> DataFrame:
    """SRC3, SRC5, SRC8, PRJ1-PRJ6: all columns of the papers of a dump, from one parse of each line."""
    p = bulk.paper_rows(spark, _paper_dump(spark, sf))
    people = F.array_join(F.transform("authors", lambda a: F.concat_ws(":", a["authorId"], a["name"])), ";")
    return p.select(
        "corpus_id", "paper_id", "title", "title_key", "abstract", "venue", "year", "citation_count", "reference_count", "influential_citation_count", people.alias("people"),
        F.col("external_ids")["DOI"].alias("doi"), F.array_join("fields_of_study", ";").alias("fields"), F.array_join("publication_types", ";").alias("types"), "is_open_access", "open_access_pdf",
        F.col("source_file").rlike("^part-.*[.]gz$").alias("named"),
    )


PAPER_COLUMNS_SQL = """
SELECT o_orderkey AS corpus_id, CASE WHEN o_orderkey % 3 = 0 THEN 'p' || o_orderkey ELSE sha1(CAST(o_orderkey AS VARCHAR)) END AS paper_id, 'Title: T ' || o_orderkey AS title, 't' || o_orderkey AS title_key,
       CASE WHEN o_orderkey % 2 = 0 THEN 'about' ELSE '' END AS abstract, 'Proc. ' || o_orderpriority AS venue, CAST(CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) END AS INTEGER) AS year,
       CAST(o_custkey AS INTEGER) AS citation_count, CASE WHEN o_orderkey % 4 = 0 THEN 0 ELSE 3 END AS reference_count, CAST(CASE WHEN o_orderkey % 3 = 0 THEN o_orderkey % 10 ELSE 0 END AS INTEGER) AS influential_citation_count,
       CASE WHEN o_orderkey % 6 <> 0 THEN (o_custkey % 50) || ':Ann Bo' || (o_custkey % 7) || ';' || ((o_custkey + 1) % 50) || ':Ann Bo' || ((o_custkey + 1) % 7) ELSE '' END AS people,
       CASE WHEN o_orderkey % 4 <> 0 THEN '10.1/' || o_orderkey END AS doi, CASE o_orderkey % 4 WHEN 0 THEN 'One;Two' WHEN 1 THEN 'Low' ELSE o_orderstatus END AS fields,
       CASE WHEN o_orderkey % 2 = 0 THEN 'Review;Book' ELSE '' END AS types, o_orderkey % 3 = 0 AS is_open_access, CASE WHEN o_orderkey % 2 = 0 THEN 'u' ELSE 'v' END || o_orderkey AS open_access_pdf, true AS named
FROM orders WHERE o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0
"""

CODES = ["1-URGENT", "2-HIGH", "5-LOW"]


def conference_author_rows(spark: SparkSession, sf: str) -> DataFrame:
    """SRC4, PRJ22, SNK7, NS1: papers of a dump without a venue filter, kept by conference, and their authors in one statement each."""
    dimension, aliases = venues.conferences(spark, CODES), venues.conference_aliases(spark, CODES, {})
    raw = bulk.paper_rows(spark, _paper_dump(spark, sf), need_venue=False)
    mapping = venues.build_mapping(raw.select(F.col("venue").alias("venue_raw")), venues.matcher_patterns(dimension, aliases))
    known = mapping.select(F.col("venue_raw").alias("venue"), F.col("conference").alias("venue_normalized"))
    papers = bulk.conference_papers(raw.join(known, "venue", "left"), dimension, "r1")
    return bulk.author_papers(papers).select("corpus_id", "author_id", "author_name", "author_sequence", "conference", "year", "bibliography_id", "release_id", "is_conference_paper")


CONFERENCE_SQL = """
WITH p AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS conference, CAST(CASE WHEN o_orderkey % 7 <> 0 THEN year(o_orderdate) ELSE 0 END AS INTEGER) AS year FROM orders
           WHERE o_orderkey % 13 <> 0 AND o_orderkey % 5 <> 0 AND o_orderkey % 6 <> 0 AND o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW')),
a AS (SELECT *, unnest([0, 1]) AS s FROM p)
SELECT k AS corpus_id, CAST((c + s) % 50 AS VARCHAR) AS author_id, 'Ann Bo' || ((c + s) % 7) AS author_name, CAST(s AS INTEGER) AS author_sequence, conference, year,
       CASE WHEN k % 4 <> 0 THEN 'conf/' || k END AS bibliography_id, 'r1' AS release_id, true AS is_conference_paper FROM a
"""


def response_fields(spark: SparkSession, sf: str) -> DataFrame:
    """PRJ8, PRJ19: what search responses give, and the primary identifier."""
    key, text = F.col("o_orderkey"), F.col("o_orderkey").cast("string")
    author = lambda n: F.struct(F.when(key % 4 != n, text).alias("authorId"), F.concat(F.lit(f"N{n} "), text).alias("name"))
    ids = F.map_from_entries(F.array(F.struct(F.lit("DOI"), F.when(key % 3 != 0, F.concat(F.lit("10.1/"), text))), F.struct(F.lit("ACL"), F.when(key % 5 == 0, F.concat(F.lit("P"), text))), F.struct(F.lit(BIBLIOGRAPHY_KEY), text)))
    rows = table(spark, sf, "orders").select(
        F.concat(F.lit("r"), text).alias("paperId"), F.col("o_orderpriority").alias("title"), F.year("o_orderdate").alias("year"), F.col("o_custkey").alias("citationCount"),
        F.when(key % 6 == 0, F.array()).otherwise(F.array(author(0), author(1))).alias("authors"), ids.alias("externalIds"), F.when(key % 2 == 0, F.array(F.lit("A"), F.lit("B"))).otherwise(F.array(F.lit("C"))).alias("fieldsOfStudy"),
        F.when(key % 7 != 0, F.struct(F.when(key % 2 == 0, "u").otherwise("").alias("url"), F.lit("GREEN").alias("status"), F.lit("by").alias("license"))).alias("openAccessPdf"),
        F.when(key % 3 == 0, F.struct(F.lit("@x").alias("bibtex"))).alias("citationStyles"),
    )
    return linking.parse_response(rows).withColumn("primary_id", linking.primary_identifier())


RESPONSE_SQL = f"""
SELECT 'r' || o_orderkey AS remote_paper_id, o_orderpriority AS remote_title, CAST(year(o_orderdate) AS INTEGER) AS remote_year, o_custkey AS remote_citation_count,
       CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE 'N0 ' || o_orderkey || ';N1 ' || o_orderkey END AS all_author_names,
       CASE WHEN o_orderkey % 6 = 0 THEN '' WHEN o_orderkey % 4 IN (0, 1) THEN CAST(o_orderkey AS VARCHAR) ELSE o_orderkey || ';' || o_orderkey END AS all_author_ids,
       CASE WHEN o_orderkey % 6 <> 0 AND o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS first_author_remote_id, CASE WHEN o_orderkey % 6 = 0 THEN 0 ELSE 2 END AS all_authors_count,
       CASE WHEN o_orderkey % 3 <> 0 THEN '10.1/' || o_orderkey END AS doi, CAST(NULL AS VARCHAR) AS arxiv_id, CAST(NULL AS VARCHAR) AS mag_id, CASE WHEN o_orderkey % 5 = 0 THEN 'P' || o_orderkey END AS acl_id,
       CAST(NULL AS VARCHAR) AS corpus_id, CAST(NULL AS VARCHAR) AS pmid, CAST(o_orderkey AS VARCHAR) AS bibliography_id,
       CASE WHEN o_orderkey % 2 = 0 THEN 'A' ELSE 'C' END AS field_primary, CASE WHEN o_orderkey % 2 = 0 THEN 'B' END AS field_secondary, CASE WHEN o_orderkey % 2 = 0 THEN 'A;B' ELSE 'C' END AS fields_all,
       CASE WHEN o_orderkey % 7 <> 0 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'u' ELSE '' END END AS oa_url, CASE WHEN o_orderkey % 7 <> 0 THEN 'GREEN' END AS oa_status, CASE WHEN o_orderkey % 7 <> 0 THEN 'by' END AS oa_license,
       CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 2 = 0 THEN 'TRUE' ELSE 'FALSE' END AS pdf_available, CASE WHEN o_orderkey % 3 = 0 THEN '@x' END AS bibtex,
       CASE WHEN o_orderkey % 5 = 0 THEN 'ACL:P' || o_orderkey WHEN o_orderkey % 3 <> 0 THEN 'DOI:10.1/' || o_orderkey END AS primary_id FROM orders
"""


def profile_rows_of_papers(spark: SparkSession, sf: str) -> DataFrame:
    """JN1: authorships with an id joined to the linked papers, unlinked ones kept, ids of the byline's ends filled in."""
    auth = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("paper_id"), F.concat(F.lit("name "), (F.col("l_suppkey") % 20).cast("string")).alias("author_name"), F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey").cast("string")).otherwise("").alias("matched_id"), F.col("l_linenumber").alias("match_order"))
    o = table(spark, sf, "orders").where("o_orderkey % 4 <> 0")
    papers = o.select(F.col("o_orderkey").alias("paper_id"), F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("influential"), F.year("o_orderdate").alias("year"), F.col("o_custkey").cast("string").alias("first_id"), F.lit(None).cast("string").alias("last_id"))
    rows = authors.rows_for_profiles(auth, papers)
    return rows.groupBy("author_name").agg(
        F.count("*").alias("rows"), F.sum("influential").alias("influential"), F.min("year").alias("first_year"), F.count_if(F.col("author_id") == F.col("first_id")).alias("firsts"), F.count_if(F.col("year").isNull()).alias("unlinked")
    )


JOIN_SQL = """
SELECT 'name ' || (l_suppkey % 20) AS author_name, count(*) AS rows, CAST(sum(CAST(floor(o_totalprice / 1000) AS BIGINT)) AS BIGINT) AS influential, CAST(min(year(o_orderdate)) AS INTEGER) AS first_year,
       count(*) FILTER (l_suppkey = o_custkey) AS firsts, count(*) FILTER (o_orderdate IS NULL) AS unlinked
FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 <> 0) ON l_orderkey = o_orderkey WHERE l_suppkey % 3 <> 0 GROUP BY 1
"""


def release_records(spark: SparkSession, sf: str) -> DataFrame:
    """SNK19, SNK20, IN8: releases created once, their status changed by events, the newest successful run of a type."""
    e = table(spark, sf, "events")
    releases = e.groupBy(F.col("user_id").alias("release_id")).agg(F.min("ts").alias("created_at")).withColumns({"status": F.lit("new"), "files": F.lit(None).cast("bigint")})
    again = releases.where("release_id % 2 = 0").withColumn("status", F.lit("twice"))
    created = tables.create_release(tables.create_release(None, releases.where("release_id % 3 <> 0")), again)
    changes = e.select(F.col("user_id").alias("release_id"), F.struct("ts", "event_id").alias("changed_at"), F.when(F.col("event_type") != "click", F.col("event_type")).alias("status"), F.when(F.col("event_id") % 5 == 0, F.col("event_id")).alias("files"))
    newest = tables.latest_run(e.select(F.col("event_type").alias("run_type"), F.when(F.col("event_id") % 2 == 0, "success").otherwise("failed").alias("status"), F.struct("ts", "event_id").alias("run_time"), "event_id"), "purchase")
    run = newest.agg(F.max("event_id").alias("last_run"))
    return tables.release_status(created, changes).select("release_id", "status", "files").join(F.broadcast(run))  # one row


RELEASES_SQL = """
WITH r AS (SELECT user_id AS release_id, CASE WHEN user_id % 3 <> 0 THEN 'new' ELSE 'twice' END AS status FROM events WHERE user_id % 3 <> 0 OR user_id % 2 = 0 GROUP BY ALL),
s AS (SELECT user_id AS release_id, arg_max(event_type, (ts, event_id)) FILTER (event_type <> 'click') AS status, arg_max(event_id, (ts, event_id)) FILTER (event_id % 5 = 0) AS files FROM events GROUP BY 1),
l AS (SELECT arg_max(event_id, (ts, event_id)) AS last_run FROM events WHERE event_type = 'purchase' AND event_id % 2 = 0)
SELECT r.release_id, coalesce(s.status, r.status) AS status, s.files, last_run FROM r LEFT JOIN s ON r.release_id = s.release_id, l
"""

QUERIES = {
    "bulk_paper_columns": bulk_paper_columns, "conference_author_rows": conference_author_rows, "response_fields": response_fields, "profile_rows_of_papers": profile_rows_of_papers,
    "release_records": release_records,
}

ORACLES = {
    "bulk_paper_columns": PAPER_COLUMNS_SQL, "conference_author_rows": CONFERENCE_SQL, "response_fields": RESPONSE_SQL, "profile_rows_of_papers": JOIN_SQL, "release_records": RELEASES_SQL,
}
