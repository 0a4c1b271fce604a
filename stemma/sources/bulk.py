"""Bulk JSON-lines dumps of papers and authors (SRC3-SRC9, PRJ1-PRJ7, PRJ22)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.functions.text import first_filled, paper_id_of, pdf_url, title_key, true_text
from stemma.operators.incremental import first_of
from stemma.sources.schemas import BIBLIOGRAPHY_KEY


def dump_files(spark: SparkSession, folder: str) -> list[str]:
    """The files of a dump by name: those that end in ``.jsonl.gz``, or else all that end in ``.gz`` (SRC7)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    for ending in (".jsonl.gz", ".gz"):
        if found := fs.globStatus(path(f"{folder}/*{ending}")):
            return sorted(str(x.getPath()) for x in found)
    return []


def read_json_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(value, source_file) of every line that may be a JSON object; one task for each gz file."""
    lines = spark.read.text(path).select("value", F.element_at(F.split(F.input_file_name(), "/"), -1).alias("source_file"))
    return lines.where(F.ltrim("value").startswith("{"))


#: Keys of a paper and of an author with their types; both spellings of a key occur in one dump.  Texts
#: take any value: numbers, flags and objects as they are written.
PAPER_KEYS = {
    "corpusid": "string", "corpusId": "string", "url": "string", "paperid": "string", "paperId": "string", "title": "string", "abstract": "string", "venue": "string", "year": "string",
    "citationcount": "string", "citationCount": "string", "referencecount": "string", "referenceCount": "string", "influentialcitationcount": "string", "influentialCitationCount": "string",
    "authors": "array<struct<authorId:string,name:string>>", "externalids": "map<string,string>", "externalIds": "map<string,string>", "fieldsOfStudy": "array<string>", "fieldsofstudy": "array<string>",
    "s2fieldsofstudy": "array<struct<category:string>>", "s2FieldsOfStudy": "array<struct<category:string>>", "publicationtypes": "array<string>", "publicationTypes": "array<string>",
    "isopenaccess": "string", "isOpenAccess": "string", "openaccesspdf": "string", "openAccessPdf": "string",
}
AUTHOR_KEYS = {
    "authorid": "string", "name": "string", "aliases": "array<string>", "affiliations": "array<string>", "homepage": "string", "papercount": "string", "citationcount": "string",
    "hindex": "string", "externalids": "map<string,string>", "url": "string",
}


def parsed(lines: DataFrame, keys: dict[str, str]) -> tuple[DataFrame, Callable[..., Column]]:
    """The lines with ``r``, all keys of each from one parse, and a function that gives the first filled value of some keys.

    Fields are named by place afterwards, as spellings that differ in capitals only cannot be told apart by name.
    """
    whole = F.from_json("value", ", ".join(f"`{k}` {kind}" for k, kind in keys.items()))
    places = {k: f"f{n}" for n, k in enumerate(keys)}
    named = whole.cast(f"struct<{','.join(f'{places[k]}:{kind}' for k, kind in keys.items())}>")
    # exploded, so that filters on single fields are not pushed down as parses of their own
    rows = lines.select(F.explode(F.array(named)).alias("r"), "source_file")

    def first(*names: str) -> Column:
        found = [F.col(f"r.{places[k]}") for k in names]
        return F.coalesce(*[F.nullif(c, F.lit("")) if keys[k] == "string" else c for k, c in zip(names, found, strict=True)])

    return rows, first


def paper_rows(spark: SparkSession, path: str | list[str], need_venue: bool = True) -> DataFrame:
    """Papers of a dump (a path, glob or list): either spelling of keys, defaults 0, {} and []; typed, from one parse of each line.

    Rows without corpus id or title go, and without venue unless ``need_venue`` is false.  Numbers
    that do not parse are null.  A value of another type than its key has is as if it were missing.
    """
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("int")
    strings = "array<string>"
    rows, first = parsed(read_json_lines(spark, path), PAPER_KEYS)
    number = lambda *names: first(*names).try_cast("bigint")
    rows = rows.select(
        number("corpusid", "corpusId").alias("corpus_id"),
        paper_id_of(F.coalesce(first("url"), F.lit("")), first("paperid", "paperId")).alias("paper_id"),
        first("title").alias("title"),
        title_key(first("title")).alias("title_key"),
        F.coalesce(first("abstract"), F.lit("")).alias("abstract"),
        F.trim(F.coalesce(first("venue"), F.lit(""))).alias("venue"),
        number("year").try_cast("int").alias("year"),
        zero(number("citationcount", "citationCount")).alias("citation_count"),
        zero(number("referencecount", "referenceCount")).alias("reference_count"),
        zero(number("influentialcitationcount", "influentialCitationCount")).alias("influential_citation_count"),
        F.coalesce(first("authors"), F.array().cast("array<struct<authorId:string,name:string>>")).alias("authors"),
        F.coalesce(first("externalids", "externalIds"), F.create_map().cast("map<string,string>")).alias("external_ids"),
        first_filled(first("fieldsOfStudy"), first("fieldsofstudy"), first("s2fieldsofstudy")["category"], first("s2FieldsOfStudy")["category"]).alias("fields_of_study"),
        F.coalesce(first("publicationtypes", "publicationTypes"), F.array().cast(strings)).alias("publication_types"),
        true_text(first("isopenaccess", "isOpenAccess")).alias("is_open_access"),
        pdf_url(first("openaccesspdf", "openAccessPdf")).alias("open_access_pdf"),
        "source_file",
    )
    rows = rows.where(F.col("corpus_id").isNotNull() & (F.col("corpus_id") != 0) & F.col("title").isNotNull() & (F.trim("title") != ""))
    return rows.where("venue <> ''") if need_venue else rows


def all_papers(spark: SparkSession, path: str, mapping: DataFrame, loaded_files: DataFrame | None = None) -> DataFrame:
    """``dataset_all_papers``: venues looked up in the mapping, first row of each corpus id, loaded files skipped.

    The mapping is the table of different venues; Spark broadcasts it when its size allows.
    """
    rows = paper_rows(spark, path)
    if loaded_files is not None:
        rows = rows.join(loaded_files.select("source_file").distinct(), "source_file", "left_anti")
    known = mapping.select(F.col("venue_raw").alias("venue"), F.col("conference").alias("venue_normalized"))
    rows = first_of(rows, ["corpus_id"], ["source_file", "title", "paper_id"])
    return rows.join(known, "venue", "left")


def conference_papers(papers: DataFrame, dimension: DataFrame, release_id: str) -> DataFrame:
    """``dataset_papers``: papers of known conferences, the conference as venue, year null as 0, its id in the bibliography (PRJ15, T20, T26)."""
    active = dimension.select(F.col("conference").alias("venue_normalized"))
    rows = papers.join(active, "venue_normalized", "left_semi")
    return rows.select(
        "corpus_id", "paper_id", F.col("external_ids")[BIBLIOGRAPHY_KEY].alias("bibliography_id"), "title", "title_key", "abstract",
        F.col("venue_normalized").alias("venue"), F.col("venue").alias("venue_raw"), F.coalesce("year", F.lit(0)).alias("year"),
        "citation_count", "reference_count", "influential_citation_count", "authors", "fields_of_study", "is_open_access", "open_access_pdf",
        F.col("venue_normalized").alias("conference"), F.lit(release_id).alias("release_id"), "source_file",
    )


def author_papers(papers: DataFrame) -> DataFrame:
    """``dataset_author_papers``: one row for each author id of a paper, sequence from 0 (NS1)."""
    rows = papers.select("*", F.posexplode("authors").alias("author_sequence", "a")).drop("authors")
    rows = rows.withColumn("author_id", F.col("a.authorId")).withColumn("author_name", F.col("a.name")).drop("a")
    rows = rows.where("author_id <> ''").withColumn("is_conference_paper", F.lit(True))
    return first_of(rows, ["corpus_id", "author_id"], ["author_sequence"])


def author_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``dataset_authors``: lines with an id and a name; counts 0 by default, lists may be null (SRC6, PRJ6)."""
    rows, first = parsed(read_json_lines(spark, path), AUTHOR_KEYS)
    count = lambda name: F.coalesce(first(name).try_cast("bigint"), F.lit(0)).cast("int")
    rows = rows.select(
        first("authorid").alias("author_id"), first("name").alias("name"), first("aliases").alias("aliases"), first("affiliations").alias("affiliations"), first("homepage").alias("homepage"),
        count("papercount").alias("paper_count"), count("citationcount").alias("citation_count"), count("hindex").alias("h_index"), first("externalids").alias("external_ids"), first("url").alias("url"),
        "source_file",
    )
    return first_of(rows.where("author_id IS NOT NULL AND name IS NOT NULL"), ["author_id"], ["source_file", "name"])
