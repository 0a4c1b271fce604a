"""Bibliography XML: records of a dump as rows, with entities and mixed content (SRC1, SRC2, IN4)."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.functions.text import clean_text, doi_of, venue_of_key

END = "</inproceedings>"
VENUES = ("acl", "naacl", "emnlp", "findings")
#: The five entities that XML itself knows stay as they are.
_XML = {"amp", "lt", "gt", "quot", "apos"}


def resolve_entities(text: Column) -> Column:
    """Named entities that a DTD declares, as their characters."""
    pairs = [(f"&{name};", chr(code)) for name, code in sorted(name2codepoint.items()) if name not in _XML]
    named = F.map_from_arrays(F.array(*[F.lit(a) for a, _ in pairs]), F.array(*[F.lit(b) for _, b in pairs]))
    found = F.array_distinct(F.regexp_extract_all(text, F.lit("(&[A-Za-z][A-Za-z0-9]*;)"), F.lit(1)))
    return F.aggregate(F.filter(found, lambda x: named[x].isNotNull()), text, lambda s, x: F.replace(s, x, named[x]))


#: Elements of a record; each may stand several times.
FIELDS = ("author", "title", "year", "pages", "ee", "booktitle")
#: A character of private use in the place of ``<`` that is text, while tags are looked for.
_LESS = "\ue000"


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """(key, title, authors, year, pages, ee, booktitle) of every record; compressed dumps by their ending.

    The file is cut at the end of records, so that a dump that is not compressed is read by many tasks,
    and each record is parsed once.  Of an element that stands several times the first counts, of authors
    all; its value is the text before its first child element.  A record that is not well formed gives nulls.
    """
    lines = spark.read.option("lineSep", END).text(path)
    body = F.concat(F.regexp_extract("value", r"(?s)(<inproceedings[\s>].*)$", 1), F.lit(END))
    # null, not filtered only: Catalyst may evaluate a shared expression before the filter
    body = F.when(F.regexp_like("value", F.lit(r"<inproceedings[\s>]")), body)
    rows = lines.select(resolve_entities(body).alias("x")).where("x IS NOT NULL")
    text = F.regexp_replace("x", "&(?:lt|#0*60|#[xX]0*3[cC]);", _LESS)
    whole = F.from_xml(text, ", ".join(["_key string", *(f"{f} array<string>" for f in FIELDS)]))
    # exploded, so that filters on single fields are not pushed down as parses of their own
    rows = rows.select(F.explode(F.array(whole)).alias("r"))
    plain = lambda c: F.replace(F.regexp_extract(c, "^[^<]*", 0), F.lit(_LESS), F.lit("<"))
    first = lambda name: plain(F.get(F.col(f"r.{name}"), F.lit(0)))
    filled = lambda name: F.nullif(F.trim(first(name)), F.lit(""))
    authors = F.filter(F.transform("r.author", lambda a: clean_text(plain(a))), lambda a: a != "")
    return rows.select(
        F.col("r._key").alias("key"),
        F.coalesce(clean_text(first("title")), F.lit("")).alias("title"),
        F.coalesce(authors, F.array().cast("array<string>")).alias("authors"),
        filled("year").alias("year"),
        filled("pages").alias("pages"),
        filled("ee").alias("ee"),
        filled("booktitle").alias("booktitle"),
    )


def bibliography(spark: SparkSession, path: str, venues: tuple[str, ...] = VENUES, known: DataFrame | None = None) -> DataFrame:
    """Papers of the target venues: records with a key of two segments, a title and authors; ``known`` keys are skipped."""
    rows = read_records(spark, path).where((F.size(F.split("key", "/")) >= 2) & (F.col("title") != "") & (F.size("authors") > 0))
    rows = rows.withColumn("venue", venue_of_key(F.col("key"))).where(F.col("venue").isin(*venues))
    if known is not None:
        rows = rows.join(known.select("key"), "key", "left_anti")
    return rows.select("key", "title", "authors", F.get("authors", F.lit(0)).alias("first_author"), "year", "venue", "pages", "ee", "booktitle", doi_of(F.col("ee")).alias("doi"))


def export_csv(papers: DataFrame) -> DataFrame:
    """The nine exported columns, authors joined with a pipe, in the published order (SNK14)."""
    chosen = papers.select("key", "title", F.array_join("authors", "|").alias("authors"), "year", "venue", "pages", "ee", "booktitle", "doi")
    return chosen.orderBy("venue", F.desc("year"), "key")
