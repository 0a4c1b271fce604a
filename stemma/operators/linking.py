"""Linking papers across sources: exact titles, similar titles, no match (MT10-MT15, JN16, PRJ8)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stemma.functions.similarity import title_similarity
from stemma.functions.text import like_pattern, title_key
from stemma.operators.setjoin import containing
from stemma.sources.schemas import BIBLIOGRAPHY_KEY

#: Thresholds of the tiers.
HIGH, MEDIUM = 0.85, 0.70


def tier_of(similarity: Column) -> Column:
    """High from 0.85, medium from 0.70 (MT14)."""
    return F.when(similarity >= HIGH, "Tier2_Enhanced_High").when(similarity >= MEDIUM, "Tier2_Enhanced_Medium").otherwise("Tier3_NoMatch")


def exact_links(papers: DataFrame, dataset: DataFrame, by_key: bool = False) -> DataFrame:
    """(paper_id, corpus_id): equal titles in lower case, or equal title keys, in the same year; smallest corpus_id (MT10).

    Titles leave the scan as SHA-256 digests.  Each side is aggregated by year and digest before they
    meet, so that a title which many rows share is one row of the join; only its papers are spread
    again.  Null years link with nothing.  Keys are dear: digests of them are dealt by number, and where
    both sides are the same rows Spark makes and deals them once.
    """
    key = title_key if by_key else (lambda c: F.lower(c))
    empty = F.sha2(F.lit(""), 256)

    def digests(rows: DataFrame, number: str) -> DataFrame:
        # the digest is an element of its own, so that the filters on it do not make it again
        made = F.explode(F.array(F.sha2(key(F.col("title")), 256)))
        keyed = rows.where("year IS NOT NULL").select(number, "year", made.alias("k")).where(F.col("k") != empty)
        keyed = keyed.select(number, "year", F.unhex("k").alias("k"))
        return keyed.repartition(number) if by_key else keyed

    least = digests(dataset, "corpus_id").groupBy("year", "k").agg(F.min("corpus_id").alias("corpus_id"))
    return digests(papers, "paper_id").join(least, ["year", "k"]).select("paper_id", "corpus_id")


def letter_counts(title: Column) -> Column:
    """How often each of a to z, 0 to 9 and space stands in a cleaned ASCII title; null for other titles, which have no bound."""
    low = F.lower(title)
    plain = F.regexp_replace(low, "[^a-z0-9 ]", "")
    letters = F.array(*[F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789 "])
    # the cleaned title is an element of its own, so that it is made once and not for each letter
    counts = F.transform(F.array(plain), lambda p: F.transform(letters, lambda c: F.length(p) - F.length(F.replace(p, c, F.lit("")))))
    return F.when(title.rlike(r"^[\x00-\x7F]*$"), F.get(counts, F.lit(0)))


def ratio_bound(a: Column, b: Column) -> Column:
    """What the ratio of two titles with these letter counts cannot exceed: twice the letters they share over all; 1 without counts."""
    total = lambda x: F.aggregate(x, F.lit(0), lambda s, v: s + v)
    shared = total(F.zip_with(a, b, lambda x, y: F.least(x, y)))
    return F.coalesce(F.try_divide(2.0 * shared, total(a) + total(b)), F.lit(1.0))


def similar_links(papers: DataFrame, dataset: DataFrame, least: float = MEDIUM) -> DataFrame:
    """(paper_id, corpus_id, similarity): the best candidate of the year whose title holds the first long words in order.

    Different titles of a year meet once, whatever the number of rows that have them: candidates are
    those whose title holds all of the first three long words (``containing``), in order, and whose
    letters could reach ``least``; the ratio itself is computed for those alone.  Ties go to the
    smallest corpus_id.  All candidates are ranked, not a page of them (JN16, T13).
    """
    words = F.slice(F.filter(F.split(F.lower("title"), " "), lambda w: F.length(w) > 3), 1, 3)
    a = papers.where("year IS NOT NULL").select("year", "title").distinct()
    a = a.select("year", "title", words.alias("needles"), like_pattern(F.col("title")).alias("pattern"), letter_counts(F.col("title")).alias("counts"))
    b = dataset.where("year IS NOT NULL").groupBy("year", F.col("title").alias("other")).agg(F.min("corpus_id").alias("corpus_id"))
    b = b.select("year", "other", F.lower("other").alias("text"), "corpus_id", letter_counts(F.col("other")).alias("other_counts"))
    pairs = containing(a, b, ["year"], (4,)).where(F.expr("text LIKE pattern")).where(ratio_bound(F.col("counts"), F.col("other_counts")) >= least - 1e-9)
    scored = pairs.select("year", "title", "corpus_id", title_similarity("title", "other").alias("similarity")).where(F.col("similarity") >= least)
    best = scored.groupBy("year", "title").agg(F.min(F.struct((-F.col("similarity")).alias("s"), "corpus_id")).alias("b"))
    found = papers.select("paper_id", "year", "title").join(best, ["year", "title"])
    return found.select("paper_id", "b.corpus_id", (-F.col("b.s")).alias("similarity"))


def link_cascade(papers: DataFrame, dataset: DataFrame, provider: DataFrame | None = None) -> DataFrame:
    """(paper_id, corpus_id, match_method, match_confidence, validation_tier), one row for each paper (MT13).

    Exact titles at 1.0, then similar ones, then the candidates of ``provider(paper_id, corpus_id,
    title)`` (what a remote search would return), then no match at 0.
    """
    exact = exact_links(papers, dataset).select("paper_id", "corpus_id", F.lit(1.0).alias("s"), F.lit(0).alias("p"))
    rest = papers.join(exact.select("paper_id"), "paper_id", "left_anti")
    found = exact.unionByName(similar_links(rest, dataset).select("paper_id", "corpus_id", F.col("similarity").alias("s"), F.lit(1).alias("p")))
    if provider is not None:
        asked = papers.join(provider.withColumnRenamed("title", "other"), "paper_id").select(
            "paper_id", "corpus_id", title_similarity("title", "other").alias("s"), F.lit(2).alias("p")
        )
        found = found.unionByName(asked.where(F.col("s") >= MEDIUM))
    best = found.groupBy("paper_id").agg(F.min_by(F.struct("corpus_id", "s", "p"), F.struct("p", -F.col("s"), "corpus_id")).alias("b"))
    joined = papers.select("paper_id").join(best, "paper_id", "left")
    tier = F.when(F.col("b.p") < 2, F.when(F.col("b.s") >= HIGH, "Tier1_Dataset_High").otherwise("Tier1_Dataset_Medium")).otherwise(tier_of(F.col("b.s")))
    return joined.select(
        "paper_id",
        "b.corpus_id",
        F.when(F.col("b").isNull(), "No Match").when(F.col("b.p") < 2, "Dataset Match").otherwise("Title Match").alias("match_method"),
        F.coalesce("b.s", F.lit(0.0)).cast("decimal(5,3)").alias("match_confidence"),
        F.when(F.col("b").isNull(), "Tier3_NoMatch").otherwise(tier).alias("validation_tier"),
    )


def completeness(columns: list[str], required: list[str]) -> Column:
    """Share of required fields that are there and not blank; a field without a column counts as missing (MT15)."""
    filled = [F.when(F.trim(F.col(c).cast("string")) != "", 1).otherwise(0) for c in required if c in columns]
    total = sum(filled[1:], filled[0]) if filled else F.lit(0)
    return total / F.lit(float(len(required)))


def populated_share(columns: list[str]) -> Column:
    """Share of columns that are not null (AG26)."""
    flags = [F.col(c).isNotNull().cast("int") for c in columns]
    return sum(flags[1:], flags[0]) / F.lit(float(len(columns)))


def parse_response(rows: DataFrame) -> DataFrame:
    """Linked-paper columns of a search response (PRJ8).

    ``rows(paperId, title, year, citationCount, authors array<struct<authorId,name>>, externalIds map,
    fieldsOfStudy array, openAccessPdf struct<url,status,license>, citationStyles struct<bibtex>)``.
    """
    names = F.transform("authors", lambda a: a["name"])
    ids = F.transform("authors", lambda a: a["authorId"])
    filled = lambda a: F.array_join(F.filter(a, lambda x: F.coalesce(x, F.lit("")) != ""), ";")
    field = lambda k: F.get("fieldsOfStudy", F.lit(k))
    outside = {"doi": "DOI", "arxiv_id": "ArXiv", "mag_id": "MAG", "acl_id": "ACL", "corpus_id": "CorpusId", "pmid": "PubMed", "bibliography_id": BIBLIOGRAPHY_KEY}
    return rows.select(
        F.col("paperId").alias("remote_paper_id"),
        F.col("title").alias("remote_title"),
        F.col("year").alias("remote_year"),
        F.col("citationCount").alias("remote_citation_count"),
        filled(names).alias("all_author_names"),
        filled(ids).alias("all_author_ids"),
        F.get(ids, F.lit(0)).alias("first_author_remote_id"),
        F.coalesce(F.size("authors"), F.lit(0)).alias("all_authors_count"),
        *[F.col("externalIds")[key].alias(name) for name, key in outside.items()],
        field(0).alias("field_primary"),
        field(1).alias("field_secondary"),
        F.array_join("fieldsOfStudy", ";").alias("fields_all"),
        F.col("openAccessPdf.url").alias("oa_url"),
        F.col("openAccessPdf.status").alias("oa_status"),
        F.col("openAccessPdf.license").alias("oa_license"),
        F.when(F.coalesce("openAccessPdf.url", F.lit("")) != "", "TRUE").otherwise("FALSE").alias("pdf_available"),
        F.col("citationStyles.bibtex").alias("bibtex"),
    )


def primary_identifier() -> Column:
    """``ACL:x``, else ``DOI:x`` (PRJ19)."""
    return F.coalesce(F.concat(F.lit("ACL:"), F.col("acl_id")), F.concat(F.lit("DOI:"), F.col("doi")))


def search_title(remote: str = "remote_title", own: str = "title") -> Column:
    """The title to search for: the remote one, or where that is null or empty the paper's own (PRJ20)."""
    return F.coalesce(F.nullif(F.col(remote), F.lit("")), F.col(own))


def is_linked(remote_id: str = "remote_paper_id") -> Column:
    """Whether a remote record is known; null and '' are none (PRJ20)."""
    return F.coalesce(F.col(remote_id) != "", F.lit(False))


#: What a tier means to a reader.
TIER_TEXT = {"High": "high: titles agree", "Medium": "medium: titles resemble each other", "NoMatch": "bibliography only"}


def tier_text(tier: str = "validation_tier") -> Column:
    """A tier in words, by the last part of its name; 'unknown' for others and null (PRJ20)."""
    words = F.create_map(*[F.lit(x) for pair in TIER_TEXT.items() for x in pair])
    return F.coalesce(F.try_element_at(words, F.substring_index(tier, "_", -1)), F.lit("unknown"))
