import gzip
import json
from datetime import datetime

from pyspark.sql import functions as F

from stemma.operators import venues
from stemma.plans import pipelines
from stemma.sources import bibliography, buckets, bulk, tables
from stemma.streaming.files import upsert_stream

XML = """<?xml version="1.0"?><!DOCTYPE dblp SYSTEM "dblp.dtd"><dblp>
<inproceedings key="conf/acl/A1" mdate="2020-01-01"><author>J&uuml;rgen M 0001</author><author>Bo Li</author><title>A <i>b</i> c.</title><year>2019</year><ee>https://doi.org/10.1/x</ee><booktitle>ACL</booktitle></inproceedings>
<article key="j/x/1"><author>No</author><title>No</title></article>
<inproceedings key="conf/emnlp/B2"><author>Ann &amp; Co</author><title>Deep Parsing &eacute;</title><year>2020</year></inproceedings>
<inproceedings key="conf/emnlp/B3"><title>No authors</title></inproceedings>
<inproceedings key="conf/icml/B4"><author>X</author><title>Other venue</title></inproceedings>
<inproceedings key="conf/acl/B5"><author>X</author><title><i>only child</i></title></inproceedings>
</dblp>"""


def paper(i, **more):
    return {"corpusid": i, "title": f"Paper {i}", "venue": "ACL", "year": 2020, "authors": [{"authorId": str(i), "name": f"Ann {i}"}], **more}


LINES = [
    paper(1, citationcount="5", externalids={"DBLP": "conf/acl/A1"}, openaccesspdf={"url": "u"}, isopenaccess="True", s2fieldsofstudy=[{"category": "CS"}]),
    paper(1, title="Second of 1"),
    {"corpusId": 2, "title": "Two: Words", "venue": "Proceedings of EMNLP", "citationCount": 7, "url": "https://x/paper/" + "a" * 40, "openAccessPdf": "text"},
    paper(3, venue=" "),
    paper(4, title=None),
    paper(5, venue="Unknown Journal", year="bad", fieldsOfStudy=["Math"]),
    paper(6, authors=[{"authorId": None, "name": "x"}, {"authorId": "9", "name": "y"}, {"authorId": "9", "name": "z"}], year=None),
]


def write_lines(path, rows, bad=True):
    with gzip.open(path, "wt") as f:
        f.write("\n".join(json.dumps(r) for r in rows) + ("\n{broken\n" if bad else "\n"))


def test_records_are_parsed_once_and_broken_ones_do_no_harm(spark, tmp_path):
    records = [
        '<inproceedings mdate="2020" key="conf/acl/A1"><author orcid="1">J &amp; M 0001</author><author>Bo <b>x</b></author><title>On 1 &lt; 2, &#60;nets&gt; and <i>deep</i> things</title><year> 2001 </year><ee type="oa">http://a</ee><ee>http://b</ee></inproceedings>',
        '<inproceedings key="conf/acl/A2"><title><i>x</i> after</title><author>Q</author></inproceedings>',
        '<inproceedings key="conf/acl/A3"><title>broken</inproceedings>',
        '<inproceedings key="conf/acl/A4"><author> </author><title>T</title></inproceedings>',
    ]
    (tmp_path / "d.xml").write_text("<dblp>" + "\n".join(records) + "</dblp>")
    found = bibliography.read_records(spark, str(tmp_path / "d.xml"))
    rows = {r.key: r for r in found.collect()}
    assert set(rows) == {"conf/acl/A1", "conf/acl/A2", None, "conf/acl/A4"}
    a = rows["conf/acl/A1"]
    assert (a.title, a.authors, a.year, a.ee, a.pages) == ("On 1 < 2, <nets> and", ["J & M 0001", "Bo"], "2001", "http://a", None)
    assert rows["conf/acl/A2"].title == "" and rows["conf/acl/A4"].authors == []
    kept = bibliography.bibliography(spark, str(tmp_path / "d.xml"))
    assert [r.key for r in kept.collect()] == ["conf/acl/A1"]
    assert kept._jdf.queryExecution().executedPlan().toString().count("from_xml") == 1


def test_bibliography(spark, tmp_path):
    with gzip.open(tmp_path / "dump.xml.gz", "wt") as f:
        f.write(XML)
    rows = {r.key: r for r in bibliography.bibliography(spark, str(tmp_path / "dump.xml.gz")).collect()}
    assert set(rows) == {"conf/acl/A1", "conf/emnlp/B2"}
    a = rows["conf/acl/A1"]
    assert (a.title, a.authors, a.year, a.venue, a.doi, a.first_author) == ("A", ["Jürgen M 0001", "Bo Li"], "2019", "acl", "10.1/x", "Jürgen M 0001")
    assert (rows["conf/emnlp/B2"].title, rows["conf/emnlp/B2"].authors) == ("Deep Parsing é", ["Ann & Co"])
    known = spark.createDataFrame([("conf/acl/A1",)], "key string")
    assert bibliography.bibliography(spark, str(tmp_path / "dump.xml.gz"), known=known).count() == 1
    table = str(tmp_path / "papers")
    assert pipelines.import_bibliography(spark, str(tmp_path / "dump.xml.gz"), table) == {"inserted": 2, "updated": 0}
    assert pipelines.import_bibliography(spark, str(tmp_path / "dump.xml.gz"), table) == {"inserted": 0, "updated": 2}
    assert [r.authors for r in bibliography.export_csv(buckets.read(spark, table)).collect()] == ["Jürgen M 0001|Bo Li", "Ann & Co"]


def test_bulk_papers(spark, tmp_path):
    write_lines(tmp_path / "part.jsonl.gz", LINES)
    rows = {r.corpus_id: r for r in bulk.paper_rows(spark, str(tmp_path / "*.gz")).where("title <> 'Second of 1'").collect()}
    assert set(rows) == {1, 2, 5, 6}
    one, two, five = rows[1], rows[2], rows[5]
    assert (one.citation_count, one.open_access_pdf, one.is_open_access, one.fields_of_study, one.source_file) == (5, "u", True, ["CS"], "part.jsonl.gz")
    assert (two.citation_count, two.paper_id, two.open_access_pdf, two.title_key, two.authors) == (7, "a" * 40, "text", "words", [])
    assert (five.year, five.fields_of_study) == (None, ["Math"])
    assert bulk.paper_rows(spark, str(tmp_path / "*.gz"), need_venue=False).count() == 6


def test_bulk_authors(spark, tmp_path):
    write_lines(tmp_path / "a.gz", [{"authorid": 1, "name": "Ann", "papercount": "3", "aliases": ["A"]}, {"authorid": 1, "name": "Bob"}, {"authorid": 2}, {"name": "x"}])
    (r,) = bulk.author_rows(spark, str(tmp_path / "a.gz")).collect()
    assert (r.author_id, r.name, r.paper_count, r.citation_count, r.aliases, r.affiliations) == ("1", "Ann", 3, 0, ["A"], None)


def test_pipelines_end_to_end(spark, tmp_path):
    write_lines(tmp_path / "part.jsonl.gz", LINES)
    at = pipelines.import_bulk(spark, str(tmp_path / "*.gz"), str(tmp_path / "t"), venues.conferences(spark), venues.conference_aliases(spark), "r1")
    papers = {r.corpus_id: r for r in spark.read.parquet(at["dataset_papers"]).collect()}
    assert {k: (r.venue, r.year, r.year_bucket) for k, r in papers.items()} == {1: ("ACL", 2020, "2020"), 2: ("EMNLP", 0, "0-1969"), 6: ("ACL", 0, "0-1969")}
    assert papers[1].bibliography_id == "conf/acl/A1" and papers[2].venue_raw == "Proceedings of EMNLP"
    assert sorted((r.corpus_id, r.author_id, r.author_sequence) for r in spark.read.parquet(at["dataset_author_papers"]).collect()) == [(1, "1", 0), (6, "9", 1)]
    loaded = spark.createDataFrame([("part.jsonl.gz",)], "source_file string")
    assert bulk.all_papers(spark, str(tmp_path / "*.gz"), spark.read.parquet(at["venue_mapping"]), loaded).count() == 0
    bib = spark.createDataFrame([(1, "conf/acl/A1", "paper 1", ["Ann 1"], 2020, "acl", datetime(2024, 1, 2)), (2, "conf/acl/A9", "nothing like it", ["Zed"], 2020, "acl", datetime(2024, 1, 2))], "paper_id bigint, key string, title string, authors array<string>, year int, venue string, updated_at timestamp_ntz")
    enriched = pipelines.enrich_papers(bib, spark.read.parquet(at["dataset_papers"]).withColumn("paper_id", F.concat(F.lit("s"), F.col("corpus_id").cast("string"))))
    found = {r.paper_id: (r.corpus_id, r.validation_tier, r.remote_paper_id) for r in enriched.collect()}
    assert found == {1: (1, "Tier1_Dataset_High", "s1"), 2: (None, "Tier3_NoMatch", None)}
    again = pipelines.enrich_papers(bib, spark.read.parquet(at["dataset_papers"]), enriched.withColumn("updated_at", F.lit(datetime(2024, 2, 1)).cast("timestamp_ntz")))
    assert [r.paper_id for r in again.collect()] == [2]
    cached = spark.createDataFrame([("1", 1, "home", ["Uni"], 10, 20, 3)], "author_id string, updated_at int, url string, affiliations array<string>, paper_count int, citation_count int, h_index int")
    auth, profiles, final = pipelines.author_pipeline(enriched, cached, 2025)
    assert {(r.author_name, r.matched_id) for r in auth.collect()} == {("Ann 1", "1"), ("Zed", "")}
    (row,) = final.collect()
    assert (row.byline_name, row.remote_paper_count, row.remote_h_index, row.homepage, row.career_length, row.first_author_count) == ("Ann 1", 10, 3, "home", 6, 1)
    report = json.loads(pipelines.enrichment_report(enriched, ["remote_paper_id", "title"]))
    assert report["total_papers"] == 2 and report["fields"] == {"remote_paper_id": 0.5, "title": 1.0}


def test_snapshots(spark, tmp_path):
    spark.range(5).write.parquet(str(tmp_path / "numbers"))
    copy = tables.snapshot(spark, str(tmp_path / "numbers"), str(tmp_path / "backup"), datetime(2024, 1, 2, 3, 4, 5))
    assert copy.endswith("numbers_20240102_030405")
    back = tables.restore(spark, copy, str(tmp_path / "restored"))
    assert spark.read.parquet(back).count() == 5
    try:
        tables.restore(spark, copy, str(tmp_path / "restored"))
        raise AssertionError
    except FileExistsError:
        pass
    assert spark.read.parquet(tables.restore(spark, copy, str(tmp_path / "restored"), rename="other")).count() == 5


def test_stream_of_files(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.json").write_text('{"k": 1, "v": "a"}\n{"k": 2, "v": "b"}\n')
    args = (spark, str(folder), "k int, v string", ["k"], str(tmp_path / "out"), str(tmp_path / "check"))
    upsert_stream(*args).awaitTermination()
    (folder / "b.json").write_text('{"k": 2, "v": "c"}\n')
    upsert_stream(*args).awaitTermination()
    assert sorted(map(tuple, buckets.read(spark, str(tmp_path / "out")).collect())) == [(1, "a"), (2, "c")]
