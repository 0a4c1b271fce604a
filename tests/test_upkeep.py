import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from stemma.operators import authors, incremental, linking, venues, verify
from stemma.sources import bulk, tables


def test_dump_files_by_ending(spark, tmp_path):
    assert bulk.dump_files(spark, str(tmp_path)) == []
    for name in ("b.gz", "a.gz", "c.txt"):
        (tmp_path / name).write_bytes(b"")
    assert [x.rsplit("/", 1)[1] for x in bulk.dump_files(spark, str(tmp_path))] == ["a.gz", "b.gz"]
    (tmp_path / "z.jsonl.gz").write_bytes(b"")
    assert [x.rsplit("/", 1)[1] for x in bulk.dump_files(spark, str(tmp_path))] == ["z.jsonl.gz"]


def test_codes_from_csv_or_fixed(spark, tmp_path):
    (tmp_path / "c.csv").write_text("Conference,Area\nVLDB,db\nACL,nlp\nVLDB,db\n,x\n")
    (tmp_path / "d.csv").write_text("Name\nVLDB\n")
    assert venues.read_codes(spark, str(tmp_path / "c.csv")) == ["ACL", "VLDB"]
    assert venues.read_codes(spark, str(tmp_path / "d.csv")) == venues.read_codes(spark) == sorted(venues.CONFERENCES)


def test_venues_meet_only_patterns_inside_them(spark):
    """A hundred thousand patterns and no nested-loop join, as many codes as there are venues."""
    codes = spark.range(100_000).select(F.concat(F.lit("conf"), F.lpad("id", 6, "0")).alias("conference"))
    p = codes.select(F.lit("code").alias("kind"), F.col("conference").alias("pattern"), "conference", F.monotonically_increasing_id().alias("ord"))
    v = spark.createDataFrame([("Proceedings of conf000123 2020",), ("conf099999",), ("other",)], "venue_raw string")
    found = venues.resolve_venues(v, p)
    assert {tuple(r) for r in found.collect()} == {("Proceedings of conf000123 2020", "conf000123", 4), ("conf099999", "conf099999", 2)}
    joined = venues.pattern_join(v, p.select("conference", "pattern", F.lit("contains").alias("match_type")), "venue_raw", "venue_raw")
    assert joined.count() == 2
    for df in (found, venues.resolve_venues_simple(v, p), joined):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_vectors_are_kept_until_texts_change(spark, tmp_path):
    calls = []

    def embed(texts):
        calls.append(1)
        return texts.withColumn("vector", F.array(F.length("text").cast("double")))

    path, texts = str(tmp_path / "v"), spark.createDataFrame([("A", "aa"), ("B", "b")], "conference string, text string")
    for _ in range(2):
        assert {r.conference: r.vector for r in venues.kept_vectors(spark, path, texts, embed).collect()} == {"A": [2.0], "B": [1.0]}
    assert len(calls) == 1
    changed = texts.withColumn("text", F.concat("text", F.lit("!")))
    assert {r.vector[0] for r in venues.kept_vectors(spark, path, changed, embed).collect()} == {3.0, 2.0}
    venues.kept_vectors(spark, path, changed, embed, rebuild=True)
    assert len(calls) == 3


def test_table_over_jdbc(spark, tmp_path):
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    options = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    spark.range(50).selectExpr("id AS k", "id % 3 AS x").write.format("jdbc").options(url=url, dbtable="papers", **options).save()
    dealt = tables.from_database(spark, url, "papers", "k", (10, 30), 4, **options)
    assert dealt.rdd.getNumPartitions() == 4 and sorted(r.K for r in dealt.toDF("K", "X").collect()) == list(range(50))
    asked = tables.from_database(spark, url, '(SELECT "k" FROM papers WHERE "x" = 1) q', **options)
    assert asked.count() == 17


def test_snapshots_are_listed(spark, tmp_path):
    spark.range(3).write.parquet(f"{tmp_path}/t")
    made = [tables.snapshot(spark, f"{tmp_path}/t", f"{tmp_path}/s", datetime(2024, m, 1)) for m in (5, 2)]
    assert [x.rsplit("/", 1)[1] for x in tables.snapshots(spark, f"{tmp_path}/s", "t")] == sorted(x.rsplit("/", 1)[1] for x in made)
    assert tables.snapshots(spark, f"{tmp_path}/s", "u") == []


def test_checks_export_and_report(spark, tmp_path):
    checks = spark.createDataFrame([("a", "f", "1", "1", True), ("b", "f", "1", "2", False), ("a", "g", None, "0", True)], "author_name string, field string, expected string, actual string, passed boolean")
    summary = json.loads(verify.export_checks(checks, str(tmp_path / "out")))
    assert summary == {"checked": 3, "passed": 2, "fields": {"f": 50.0, "g": 100.0}}
    assert spark.read.option("header", True).csv(str(tmp_path / "out/rows")).count() == 3
    facts = {"profiles": spark.sql("SELECT 1.50BD AS mean, DATE'2024-01-02' AS day, CAST(null AS int) AS none"), "empty": spark.range(0)}
    assert json.loads(verify.phase_report(facts, {"n": "x"})) == {"statistics": {"profiles": {"mean": 1.5, "day": "2024-01-02", "none": None}, "empty": {}}, "notes": {"n": "x"}}


@pytest.mark.parametrize("rows", [[], [(5,)], [(k,) for k in range(3, 20)]])
def test_id_ranges_hold_every_row_once(spark, rows):
    got = incremental.id_ranges(spark.createDataFrame(rows, "k bigint"), "k", 4).collect()
    assert sorted(r.k for r in got) == [k for (k,) in rows]
    assert all(0 <= r.part < 4 for r in got) and [r.part for r in sorted(got)] == sorted(r.part for r in got)


def test_enrichment_of_authors_without_records(spark):
    wanted = "author_name string, author_ids string, homepage string, remote_affiliations string, remote_paper_count bigint, remote_citation_count bigint, remote_h_index bigint"
    profiles = spark.createDataFrame([("a", "1, ,2,1", None, None, 1, 1, 1), ("b", "9", None, "x", 1, 1, 1), ("c", "1", "h", "x", 1, 1, 1), ("d", None, None, None, None, None, None), ("e", " ,", None, None, None, None, None)], wanted)
    fetched = spark.createDataFrame([("1", "u", ["p", "q"], 2, 3, 4), ("2", "", ["q"], 1, 1, 9)], "author_id string, url string, affiliations array<string>, paper_count bigint, citation_count bigint, h_index bigint")
    got = {r.author_name: r for r in authors.enrich_authors(profiles, fetched).collect()}
    assert set(got) == {"a", "b"}
    assert (got["a"].homepage, got["a"].remote_affiliations, got["a"].remote_h_index, got["a"].ids_asked, got["a"].ids_found) == ("u", "p,q", 9, 3, 3)
    assert (got["b"].homepage, got["b"].ids_asked, got["b"].ids_found, got["b"].was_updated) == (None, 1, 0, False)
    assert authors.enrichment_totals(spark.createDataFrame([], "was_updated boolean, ids_asked bigint, ids_found bigint")).first().authors == 0


def test_titles_and_tiers_in_words(spark):
    rows = spark.createDataFrame([("", "own", None, None), ("far", "own", "7", "Tier2_Enhanced_High"), (None, None, "", "odd")], "remote_title string, title string, remote_paper_id string, validation_tier string")
    got = [tuple(r) for r in rows.select(linking.search_title(), linking.is_linked(), linking.tier_text()).collect()]
    assert got == [("own", False, "unknown"), ("far", True, linking.TIER_TEXT["High"]), (None, False, "unknown")]
