"""Venue resolution: seeds, pattern tables, the ranked matcher, cosine top-1 (MT3-MT9, JN5, TX16)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.functions.text import has_context, has_year, is_short, venue_normal, whole_word
from stemma.operators.anchors import best_anchor
from stemma.operators.setjoin import containing
from stemma.sources import tables

#: Conference codes used when no list is given.
CONFERENCES = [
    "AAAI", "IJCAI", "ASPLOS", "HPCA", "ISCA", "MICRO", "RTAS", "RTSS",
    "CRYPTO", "EuroCrypt", "ICDE", "PODS", "SIGMOD", "VLDB", "EC", "WINE",
    "SIGGRAPH", "CHI", "UIST", "CAV", "LICS", "ICLR", "ICML", "NeurIPS",
    "IMC", "SIGMETRICS", "MobiCom", "MobiSys", "SenSys", "ACL", "EMNLP",
    "NSDI", "SIGCOMM", "EuroSys", "FAST", "OSDI", "SOSP", "USENIX-ATC",
    "CC", "CGO", "ECOOP", "ICFP", "ISMM", "OOPSLA", "PLDI", "POPL", "PPoPP",
    "ICRA", "IROS", "ASE", "FSE", "ICSE", "ISSTA", "CCS", "NDSS", "Oakland",
    "UsenixSec", "FOCS", "SODA", "STOC", "CVPR", "ECCV", "ICCV", "SIGIR",
    "WSDM", "WWW",
]
#: Other names of conferences.
ALIASES = {
    "USENIX-ATC": ["ATC", "USENIX ATC", "USENIX Annual Technical Conference"],
    "Oakland": ["S&P", "IEEE S&P", "IEEE Symposium on Security and Privacy", "Security and Privacy"],
    "UsenixSec": ["USENIX Security", "USENIX Security Symposium"],
    "NeurIPS": ["NIPS", "Neural Information Processing Systems"],
    "EuroCrypt": ["EUROCRYPT"],
    "EuroSys": ["EUROSYS"],
    "SIGMOD": ["SIGMOD/PODS"],
    "VLDB": ["VLDB Conference"],
    "ICML": ["International Conference on Machine Learning"],
    "CVPR": ["IEEE Conference on Computer Vision and Pattern Recognition"],
    "ICCV": ["International Conference on Computer Vision"],
    "ECCV": ["European Conference on Computer Vision"],
    "ACL": ["Annual Meeting of the Association for Computational Linguistics"],
    "EMNLP": ["Conference on Empirical Methods in Natural Language Processing"],
    "CHI": ["CHI Conference on Human Factors in Computing Systems"],
    "SIGCOMM": ["ACM SIGCOMM"],
    "NSDI": ["Symposium on Networked Systems Design and Implementation"],
    "OSDI": ["Symposium on Operating Systems Design and Implementation"],
    "SOSP": ["Symposium on Operating Systems Principles"],
    "PLDI": ["Programming Language Design and Implementation"],
    "POPL": ["Principles of Programming Languages"],
    "ICSE": ["International Conference on Software Engineering"],
    "FSE": ["Foundations of Software Engineering"],
    "CCS": ["ACM Conference on Computer and Communications Security"],
    "NDSS": ["Network and Distributed System Security Symposium"],
}
#: Phrases that a venue of the conference contains.
PHRASES = {
    "CVPR": ["computer vision", "pattern recognition"],
    "ACL": ["computational linguistics", "association for computational linguistics"],
    "EMNLP": ["empirical methods", "natural language processing"],
    "ICML": ["machine learning"],
    "NeurIPS": ["neural information processing"],
    "ICLR": ["learning representations"],
    "Oakland": ["security", "privacy", "s&p"],
    "NDSS": ["network", "distributed system security"],
    "CCS": ["computer and communications security"],
    "UsenixSec": ["usenix security"],
    "SIGMOD": ["management of data"],
    "VLDB": ["very large"],
    "ICDE": ["data engineering"],
    "CHI": ["human factors"],
    "UIST": ["user interface"],
    "SIGGRAPH": ["computer graphics"],
    "OSDI": ["operating systems design"],
    "SOSP": ["operating systems principles"],
    "NSDI": ["networked systems"],
    "EuroSys": ["european"],
    "PLDI": ["programming language design"],
    "POPL": ["principles of programming"],
    "OOPSLA": ["object-oriented"],
    "ICSE": ["software engineering"],
    "FSE": ["foundations of software"],
    "ASE": ["automated software"],
}




def read_codes(spark: SparkSession, path: str | None = None, column: str = "Conference") -> list[str]:
    """Different codes in a CSV file's column, by name; the fixed list without a file or where it holds none (SRC12)."""
    if path is None:
        return sorted(CONFERENCES)
    rows = spark.read.option("header", True).csv(path)
    if column not in rows.columns:
        return sorted(CONFERENCES)
    found = rows.select(F.trim(column).alias("code")).where("code <> ''").distinct().collect()  # a dimension: some hundred
    return sorted(r.code for r in found) or sorted(CONFERENCES)


def membership(rows: DataFrame, dimension: DataFrame, code: str) -> DataFrame:
    """``rows`` with ``is_known``: the code is a conference, whatever its case (MT18)."""
    known = dimension.select(F.lower("conference").alias("_code")).distinct().withColumn("is_known", F.lit(True))
    joined = rows.join(known, F.lower(F.col(code)) == F.col("_code"), "left")
    return joined.select(*[rows[c] for c in rows.columns], F.coalesce("is_known", F.lit(False)).alias("is_known"))


def kept_vectors(spark: SparkSession, path: str, texts: DataFrame, embed: Callable[[DataFrame], DataFrame], rebuild: bool = False) -> DataFrame:
    """(conference, text, vector) from the table at ``path``; made by ``embed`` when it is missing, of other texts, or on demand (MT6).

    ``texts(conference, text)``; ``embed`` adds ``vector``.  Pairs are compared, so a changed text counts.
    """
    if not rebuild and (old := tables.read_or_none(spark, path)) is not None:
        pairs = old.select("conference", "text")
        if pairs.exceptAll(texts).isEmpty() and texts.exceptAll(pairs).isEmpty():
            return old
    tables.swap_in(spark, embed(texts).select("conference", "text", "vector"), path)
    return tables.read_or_none(spark, path)


def conferences(spark: SparkSession, codes: list[str] | None = None, full_names: dict[str, str] | None = None) -> DataFrame:
    """(conference, full_name, ord) of the dimension; ``ord`` is the load order, by name (MT8)."""
    full = full_names or {}
    rows = [(c, full.get(c), k) for k, c in enumerate(sorted(set(codes or CONFERENCES)))]
    return spark.createDataFrame(rows, "conference string, full_name string, ord int")


def conference_aliases(spark: SparkSession, codes: list[str] | None = None, aliases: dict[str, list[str]] | None = None) -> DataFrame:
    """(conference, alias, priority): the code itself at 100, other names at 50 unless they equal it (MT8)."""
    codes = codes or CONFERENCES
    rows = [(c, c, 100) for c in codes]
    for code, names in (ALIASES if aliases is None else aliases).items():
        rows += [(code, a, 50) for a in names if a.lower() != code.lower()]
    return spark.createDataFrame(rows, "conference string, alias string, priority int").dropDuplicates(["conference", "alias"])


def conference_patterns(spark: SparkSession) -> DataFrame:
    """(conference, pattern, match_type): exact codes, aliases, phrases (MT9)."""
    rows = [(c, c.lower(), "exact") for c in CONFERENCES]
    rows += [(c, a.lower(), "alias") for c, names in ALIASES.items() for a in names]
    rows += [(c, p, "contains") for c, phrases in PHRASES.items() for p in phrases]
    return spark.createDataFrame(rows, "conference string, pattern string, match_type string").distinct()


def dimension_from(names: DataFrame, aliases: list[str], phrases: list[str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The dimension of the different codes in a table: (conferences, aliases, patterns) as above (MT8, MT9).

    ``names(code, ...)`` has other names of the code in the columns ``aliases`` and phrases in
    ``phrases``; blank codes and names are none.  ``ord`` follows the codes' order and may have gaps: it comes from a
    distributed sort, not from a window over the whole table.
    """
    rows = names.where("code <> ''")

    def unpivot(columns: list[str], name: str) -> DataFrame:
        found = rows.select(F.col("code").alias("conference"), F.explode(F.array(*[F.col(c) for c in columns])).alias(name)) if columns else None
        return found.where(f"{name} <> ''").distinct() if columns else rows.select(F.col("code").alias("conference"), F.lit("").alias(name)).limit(0)

    codes = rows.select(F.col("code").alias("conference")).distinct()
    ordered = codes.orderBy("conference").select("conference", F.lit(None).cast("string").alias("full_name"), F.monotonically_increasing_id().alias("ord"))
    other = unpivot(aliases, "alias").where("lower(alias) <> lower(conference)")
    named = codes.select("conference", F.col("conference").alias("alias"), F.lit(100).alias("priority")).unionAll(other.select("conference", "alias", F.lit(50)))
    patterns = codes.select("conference", F.lower("conference").alias("pattern"), F.lit("exact").alias("match_type"))
    patterns = patterns.unionAll(other.select("conference", F.lower("alias"), F.lit("alias")).distinct())
    patterns = patterns.unionAll(unpivot(phrases, "phrase").select("conference", F.lower("phrase"), F.lit("contains")).distinct())
    return ordered, named, patterns


def matcher_patterns(dimension: DataFrame, aliases: DataFrame) -> DataFrame:
    """(kind, pattern, conference, ord) in lower case: kind ``full``, ``code`` or ``alias``.

    A pattern that several rows give belongs to the last loaded one; ties in length keep load order.
    """
    full = dimension.where("full_name <> ''").select(F.lit("full").alias("kind"), F.lower("full_name").alias("pattern"), "conference", F.col("ord").cast("long"))
    code = dimension.select(F.lit("code").alias("kind"), F.lower("conference").alias("pattern"), "conference", F.col("ord").cast("long"))
    # numbers that follow the order, from a distributed sort
    other = aliases.where("lower(alias) <> lower(conference)").orderBy(F.desc("priority"), "conference", "alias")
    other = other.select("conference", F.lower("alias").alias("pattern"), F.monotonically_increasing_id().alias("ord"))
    last = other.groupBy("pattern").agg(F.max_by("conference", "ord").alias("conference"), F.min("ord").cast("long").alias("ord"))
    return full.unionByName(code).unionByName(last.select(F.lit("alias").alias("kind"), "pattern", "conference", "ord"))


def _hit(text: Column, venue: Column, with_year: bool) -> Column:
    """The pattern is in the text; short ones need a word boundary and context, or a year where that counts."""
    shown = has_context(venue) | (has_year(text, F.col("pattern")) if with_year else F.lit(False))
    return F.when(is_short(F.col("pattern")), whole_word(text, F.col("pattern")) & shown).otherwise(F.contains(text, F.col("pattern")))


def _hits(venues: DataFrame, patterns: DataFrame) -> DataFrame:
    """``venues(venue, low, norm)`` with every pattern that their text holds: ``again`` when it is the norm, looked at where it differs."""
    again = (F.col("norm") != "") & (F.col("norm") != F.col("low"))
    two = F.array(F.struct(F.col("low").alias("text"), F.lit(False).alias("again")), F.struct(F.when(again, F.col("norm")).alias("text"), F.lit(True).alias("again")))
    texts = venues.select("venue", F.explode(two).alias("t")).select("venue", "t.text", "t.again").where("text <> ''")
    return containing(patterns.distinct().withColumn("needles", F.array("pattern")), texts, [], few=True)


def resolve_venues(venues: DataFrame, patterns: DataFrame, venue: str = "venue_raw") -> DataFrame:
    """(venue, conference, strategy) of each different venue that some strategy resolves (MT3).

    0 full name equal, 1 full name inside, 2 code equal, 3 alias inside, 4 code inside, 5 the venue
    without its usual beginnings: full names, then codes.  Within a strategy the longest pattern
    first, then load order.  Venues are made distinct first; a venue meets only patterns that stand in
    it, found by their rarest grams (``containing``), and keeps one row through a map-side minimum.
    """
    v = venues.select(F.col(venue).alias("venue")).where("venue <> ''").distinct()
    v = v.withColumn("low", F.trim(F.lower("venue"))).withColumn("norm", venue_normal(F.col("venue")))
    text, raw, kind = F.col("text"), F.col("venue"), F.col("kind")
    inside, shown = _hit(text, raw, True), ~F.col("again")
    strategy = (
        F.when(shown & (kind == "full") & (text == F.col("pattern")), 0)
        .when(shown & (kind == "full"), 1)
        .when(shown & (kind == "code") & (text == F.col("pattern")), 2)
        .when(shown & (kind == "alias") & inside, 3)
        .when(shown & (kind == "code") & inside, 4)
        .when(~shown & (kind == "full"), 5)
        .when(~shown & (kind == "code") & _hit(text, raw, False), 6)
    )
    rank = F.struct("strategy", (-F.length("pattern")).alias("short"), "ord")
    joined = _hits(v, patterns).withColumn("strategy", strategy).where("strategy IS NOT NULL")
    best = joined.groupBy("venue").agg(F.min_by(F.struct("conference", "strategy"), rank).alias("b"))
    return best.select("venue", "b.conference", F.least(F.col("b.strategy"), F.lit(5)).alias("strategy"))


def resolve_venues_simple(venues: DataFrame, patterns: DataFrame, venue: str = "venue_raw") -> DataFrame:
    """The older matcher: equal, code inside, alias inside, code in the normalised venue; longest first (MT4)."""
    v = venues.select(F.col(venue).alias("venue")).where("venue <> ''").distinct()
    v = v.withColumn("low", F.trim(F.lower("venue"))).withColumn("norm", venue_normal(F.col("venue")))
    shown, kind = ~F.col("again"), F.col("kind")
    strategy = (
        F.when(shown & (kind == "code") & (F.col("text") == F.col("pattern")), 1)
        .when(shown & (kind == "code"), 2)
        .when(shown & (kind == "alias"), 3)
        .when(~shown & (kind == "code"), 4)
    )
    rank = F.struct("strategy", (-F.length("pattern")).alias("short"), "pattern")
    joined = _hits(v, patterns).withColumn("strategy", strategy).where("strategy IS NOT NULL")
    return joined.groupBy("venue").agg(F.min_by("conference", rank).alias("conference"))


def pattern_join(papers: DataFrame, patterns: DataFrame, venue: str, key: str) -> DataFrame:
    """``papers`` with the conference of the best pattern equal to or inside the venue (JN5).

    One row for each paper: exact before alias before contains, then the longest pattern.
    """
    kind = F.when(F.col("match_type") == "exact", 0).when(F.col("match_type") == "alias", 1).otherwise(2)
    rank = F.struct(kind, -F.length("pattern"), "pattern", "conference")
    texts = papers.select(F.col(venue).alias("venue"), F.lower(venue).alias("text")).where("text <> ''").distinct()
    best = containing(patterns.select("conference", "pattern", "match_type").distinct().withColumn("needles", F.array("pattern")), texts, [], few=True)
    best = best.groupBy("venue").agg(F.min_by("conference", rank).alias("conference")).withColumnRenamed("venue", venue)
    return papers.join(best, venue)


def cosine_top1(rows: DataFrame, anchors: DataFrame, least: float) -> DataFrame:
    """(id, conference, score): the most similar anchor at ``least`` or more; ties: the first anchor (TX16).

    ``rows(id, vector)``, ``anchors(conference, ord, vector)``; see ``anchors.best_anchor``.
    """
    return best_anchor(rows, anchors, least)


def two_layers(exact: DataFrame, by_cosine: DataFrame) -> DataFrame:
    """(id, conference, score, method): exact matches at 1.0, else those by cosine (MT5)."""
    first = exact.select("id", "conference", F.lit(1.0).alias("score"), F.lit("exact").alias("method"))
    rest = by_cosine.join(first.select("id"), "id", "left_anti").select("id", "conference", "score", F.lit("cosine").alias("method"))
    return first.unionByName(rest)


def build_mapping(venues: DataFrame, patterns: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """venue_mapping rows of venues that are not mapped yet; unresolved ones stay with null (MT7, SNK5)."""
    fresh = venues.select(F.col("venue_raw")).where("venue_raw <> ''").distinct()
    if existing is not None:
        fresh = fresh.join(existing.select("venue_raw"), "venue_raw", "left_anti")
    found = resolve_venues(fresh, patterns)
    return fresh.join(found.withColumnRenamed("venue", "venue_raw"), "venue_raw", "left").select(
        "venue_raw",
        "conference",
        F.when(F.col("conference").isNotNull(), "exact").alias("method"),
        F.when(F.col("conference").isNotNull(), 1.0).alias("confidence"),
    )
