"""The pipelines end to end, as functions of DataFrames and paths (P1-P4, reports)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.operators import authors, incremental, linking, venues
from stemma.sources import bibliography, buckets, bulk, tables


def import_bibliography(spark: SparkSession, dump: str, table: str, target_venues: tuple[str, ...] = bibliography.VENUES) -> dict[str, int]:
    """P1: the dump's papers upserted by key into a bucketed table; returns how many were inserted and updated."""
    papers = incremental.first_of(bibliography.bibliography(spark, dump, target_venues), ["key"], ["title"])
    if buckets.layout(spark, table) is None:
        buckets.create(spark, table, papers, ["key"])
    inserted, updated = buckets.upsert(spark, table, papers)
    return {"inserted": inserted, "updated": updated}


def import_bulk(spark: SparkSession, dump: str, folder: str, dimension: DataFrame, aliases: DataFrame, release_id: str) -> dict[str, str]:
    """P2: stages 0 to 3; each table is written below ``folder`` and its path returned."""
    at = {name: f"{folder}/{name}" for name in ("venue_mapping", "dataset_all_papers", "dataset_papers", "dataset_author_papers")}
    raw = bulk.paper_rows(spark, dump)
    mapping = venues.build_mapping(raw.select(F.col("venue").alias("venue_raw")), venues.matcher_patterns(dimension, aliases))
    tables.overwrite(mapping, at["venue_mapping"])
    tables.overwrite(bulk.all_papers(spark, dump, spark.read.parquet(at["venue_mapping"])), at["dataset_all_papers"])
    papers = bulk.conference_papers(spark.read.parquet(at["dataset_all_papers"]), dimension, release_id)
    tables.overwrite(papers.withColumn("year_bucket", tables.year_bucket()), at["dataset_papers"], "year_bucket")
    tables.overwrite(bulk.author_papers(spark.read.parquet(at["dataset_papers"])), at["dataset_author_papers"])
    return at


def enrich_papers(papers: DataFrame, dataset: DataFrame, enriched: DataFrame | None = None, provider: DataFrame | None = None) -> DataFrame:
    """P3: papers that are new, updated or without a remote id, linked and joined with what they link to.

    ``papers(paper_id, key, title, authors, year int, venue, updated_at)``; ``dataset`` as ``dataset_papers``.
    """
    if enriched is not None:
        seen = enriched.select("paper_id", F.col("updated_at").alias("linked_at"), F.col("remote_paper_id").alias("remote_id"))
        papers = incremental.missing_or_stale(papers, seen, "paper_id")
    links = linking.link_cascade(papers.select("paper_id", "year", "title"), dataset.select("corpus_id", "year", "title"), provider)
    d = dataset.select(
        "corpus_id", F.col("paper_id").alias("remote_paper_id"), F.col("title").alias("remote_title"), F.col("year").alias("remote_year"),
        F.col("citation_count").alias("remote_citation_count"), F.col("influential_citation_count").alias("influential"), F.col("authors").alias("remote_authors"),
    )
    d = d.withColumn("first_author_remote_id", F.get("remote_authors", F.lit(0))["authorId"])
    d = d.withColumn("last_author_remote_id", F.try_element_at("remote_authors", F.lit(-1))["authorId"])
    out = papers.join(links, "paper_id").join(d, "corpus_id", "left")
    required = ["remote_paper_id", "remote_title", "remote_year", "authors", "venue", "title", "year"]
    return out.withColumn("data_completeness_score", linking.completeness([c for c in out.columns if c != "authors"], required).cast("decimal(5,3)"))


def author_pipeline(enriched: DataFrame, cached: DataFrame, as_of_year: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """P4: authorships, profiles and the published table of enriched papers.

    ``cached(author_id, updated_at, url, affiliations, paper_count, citation_count, h_index)``.
    """
    names = enriched.select("paper_id", F.posexplode("authors").alias("name_pos", "name"))
    cands = enriched.select("paper_id", F.posexplode("remote_authors").alias("cand_pos", "c")).select(
        "paper_id", "cand_pos", F.col("c.authorId").alias("cand_id"), F.col("c.name").alias("cand_name")
    )
    auth = authors.build_authorships(names, cands)
    facts = enriched.select("paper_id", "influential", F.col("remote_year").alias("year"), F.col("first_author_remote_id").alias("first_id"), F.col("last_author_remote_id").alias("last_id"))
    rows = authors.rows_for_profiles(auth, facts)
    profiles = authors.author_profiles(rows, as_of_year)
    own = authors.split_ids(profiles.select("author_name", "author_ids")).join(cached, "author_id")
    return auth, profiles, authors.final_table(profiles, authors.merge_cached(own))


def enrichment_report(enriched: DataFrame, fields: list[str]) -> str:
    """Coverage, tiers and filled shares as JSON, from two aggregations of a few rows (SNK16)."""
    rates = enriched.agg(
        F.count("*").alias("total"), F.count_if(F.col("match_method") != "No Match").alias("linked"), F.avg("data_completeness_score").alias("completeness"),
        *[F.count(F.col(f)).alias(f"n_{f}") for f in fields],
    ).first()
    tiers = enriched.groupBy("validation_tier").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "validation_tier").collect()
    total = rates.total
    share = lambda n: round(n / total, 3) if total else 0.0
    return json.dumps(
        {
            "total_papers": total,
            "coverage_pct": round(100 * share(rates.linked), 1),
            "tiers": {r.validation_tier: {"count": r.n, "pct": round(100.0 * r.n / total, 2)} for r in tiers},
            "fields": {f: share(rates[f"n_{f}"]) for f in fields},
            "average_completeness_pct": round(float(rates.completeness or 0) * 100, 1),
        },
        ensure_ascii=False,
    )
