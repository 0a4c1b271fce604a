"""Queries that run the package's operators over the star schema, each with a DuckDB twin."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.functions import text as tx
from stemma.operators import authors, bloom, incremental, linking, setjoin, venues
from stemma.plans.profiles import AS_OF_YEAR, AUTH_SQL
from stemma.session import shared_path, table
from stemma.sources import tables
from stemma.sources.schemas import BIBLIOGRAPHY_KEY

Session = SparkSession
ANCHORS, LEAST_COSINE = 10, 0.2


def sql_text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- text ------------------------------------------------------------------------------------


def title_keys(spark: Session, sf: str) -> DataFrame:
    """TX1 over whole texts of documents."""
    return table(spark, sf, "documents").select("doc_id", tx.title_key(F.col("text")).alias("title_key"))


def _title_key_sql(column: str) -> str:
    prefixes = "|".join(tx.quote(p) for p in sorted(tx.TITLE_PREFIXES, key=len, reverse=True))
    t = f"regexp_replace(coalesce({column}, ''), '^\\s+', '')"
    t = f"regexp_replace({t}, {sql_text(f'^(?:{prefixes})')}, '', 'i')"
    t = f"regexp_replace(regexp_replace({t}, '^[^:]*:', '', 's'), '^[^：]*：', '', 's')"
    return f"regexp_replace(lower({t}), '[^a-z0-9]', '', 'g')"


def person_names(spark: Session, sf: str) -> DataFrame:
    """TX3 over customer and part names with commas, numbers and titles put in."""
    c = table(spark, sf, "customer")
    made = F.concat(F.lit("Smith-"), F.col("c_mktsegment"), F.lit(", "), F.lit("Dr "), F.substring("c_name", 1, 8), F.lit(" Jr 000"), (F.col("c_custkey") % 10).cast("string"))
    return c.select("c_custkey", tx.person_name(made).alias("name"))


PERSON_SQL = """
WITH m AS (SELECT c_custkey, trim('Dr ' || substr(c_name, 1, 8) || ' Jr 000' || CAST(c_custkey % 10 AS VARCHAR)) || ' ' || 'Smith-' || c_mktsegment AS n FROM customer),
t AS (SELECT c_custkey, lower(regexp_replace(regexp_replace(n, '\\s+\\d{4}$', ''), '\\s+\\d{1,3}$', '')) AS n FROM m),
u AS (SELECT c_custkey, array_to_string(list_filter(string_split(trim(regexp_replace(n, '\\s+', ' ', 'g')), ' '),
      lambda x: NOT list_contains(['jr','sr','phd','md','iii','ii','iv','v','esq','dr','prof','professor'], x)), ' ') AS n FROM t)
SELECT c_custkey, trim(regexp_replace(regexp_replace(replace(replace(n, '-', ' '), '_', ' '), '[^\\w\\s.]', '', 'g'), '\\s+', ' ', 'g')) AS name FROM u
"""


def initials(spark: Session, sf: str) -> DataFrame:
    """TX6 over part names."""
    return table(spark, sf, "part").select("p_partkey", tx.initials_key(F.lower("p_name")).alias("key"))


INITIALS_SQL = """
WITH t AS (SELECT p_partkey, list_filter(string_split(lower(p_name), ' '), lambda x: x <> '') AS w FROM part)
SELECT p_partkey, CASE WHEN len(w) >= 2 THEN array_to_string(list_transform(w[1:len(w) - 1], lambda x: left(x, 1)), '') || ' ' || w[-1] END AS key FROM t
"""


def like_patterns(spark: Session, sf: str) -> DataFrame:
    """TX14 over whole texts of documents."""
    return table(spark, sf, "documents").select("doc_id", tx.like_pattern(F.col("text")).alias("pattern"))


LIKE_SQL = """
WITH w AS (SELECT doc_id, list_filter(string_split(lower(text), ' '), lambda x: length(x) > 3)[1:3] AS w FROM documents)
SELECT doc_id, CASE WHEN len(w) > 0 THEN '%' || array_to_string(list_transform(w, lambda x: regexp_replace(x, '([%_\\\\])', '\\\\\\1', 'g')), '%') || '%' END AS pattern FROM w
"""


def venue_text(df: DataFrame) -> Column:
    return F.concat(F.element_at(F.array(*[F.lit(x) for x in ("Proceedings of ", "Proc. ", "International ", "", "proceedings of international ")]), (F.col("page_id") % 5 + 1).cast("int")), F.col("url"))


def venues_normal(spark: Session, sf: str) -> DataFrame:
    """TX7 over page addresses with venue beginnings put in front."""
    pages = table(spark, sf, "pages")
    return pages.select("page_id", tx.venue_normal(venue_text(pages)).alias("venue"))


def _venue_sql(column: str) -> str:
    v = f"trim(lower({column}))"
    for p in tx.VENUE_PREFIXES:
        v = f"(CASE WHEN starts_with({v}, '{p}') THEN trim(substr({v}, {len(p) + 1})) ELSE {v} END)"
    return v


VENUE_SQL = f"""
WITH p AS (SELECT page_id, ['Proceedings of ', 'Proc. ', 'International ', '', 'proceedings of international '][page_id % 5 + 1] || url AS v FROM pages),
a AS (SELECT page_id, trim(lower(v)) AS v FROM p),
{", ".join(f"{'bcdef'[k]} AS (SELECT page_id, CASE WHEN starts_with(v, '{p}') THEN trim(substr(v, {len(p) + 1})) ELSE v END AS v FROM {'abcde'[k]})" for k, p in enumerate(tx.VENUE_PREFIXES))}
SELECT page_id, v AS venue FROM f
"""


#: Codes that documents are asked for in turn: one to six characters.
DOC_CODES = ["the", "a", "that", "in", "of", "people"]


def venue_codes(spark: Session, sf: str) -> DataFrame:
    """TX8-TX11: a code between word boundaries, with context or a year, in whole documents of all languages."""
    d = table(spark, sf, "documents").withColumn("code", F.element_at(F.array(*[F.lit(x) for x in DOC_CODES]), (F.col("doc_id") % len(DOC_CODES) + 1).cast("int")))
    low = F.lower("text")
    dated = F.concat(low, F.lit(" the "), (F.col("doc_id") % 3000 + 1000).cast("string"))
    return d.select(
        "doc_id", tx.whole_word(low, F.col("code")).alias("has_code"), tx.has_context(F.col("text")).alias("has_context"),
        tx.has_year(dated, F.col("code")).alias("has_year"), tx.is_short(F.col("code")).alias("is_short"),
    )


CODES_SQL = f"""
WITH d AS (SELECT doc_id, lower(text) AS low, {DOC_CODES}[doc_id % {len(DOC_CODES)} + 1] AS code FROM documents),
y AS (SELECT *, low || ' the ' || CAST(doc_id % 3000 + 1000 AS VARCHAR) AS dated FROM d)
SELECT doc_id, regexp_matches(low, '(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])' || code || '($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') AS has_code,
       {" OR ".join(f"contains(low, '{w}')" for w in tx.VENUE_CONTEXT)} AS has_context,
       regexp_matches(dated, '(^|[^\\p{{L}}\\p{{N}}\\p{{M}}_])' || code || '(\\s+[12]\\d{{3}}|\\s*[''`]\\s*\\d{{2}}|\\s*-\\s*[12]\\d{{3}})($|[^\\p{{L}}\\p{{N}}\\p{{M}}_])') AS has_year,
       length(code) <= 3 AS is_short
FROM y
"""


def identifiers(spark: Session, sf: str) -> DataFrame:
    """PRJ2, PRJ3, PRJ9, PRJ12-PRJ14, SRC8: parts of addresses, keys and lists."""
    p = table(spark, sf, "pages")
    link = F.concat(F.lit("https://DOI.org/10.1145/v"), F.col("page_id").cast("string"), F.lit("/"), F.substring("url", 9, 5))
    hexed = F.concat(F.lit("http://x/paper/"), F.sha1(F.col("url")), F.lit("?q"))
    key = F.concat(F.lit("conf/ACL/"), F.col("page_id").cast("string"))
    return p.select(
        "page_id",
        tx.doi_of(link).alias("doi"),
        tx.doi_of(F.col("url")).alias("no_doi"),
        tx.paper_id_of(hexed).alias("paper_id"),
        tx.venue_of_key(key).alias("venue"),
        tx.true_text(F.when(F.col("page_id") % 2 == 0, "TRUE").otherwise("no")).alias("flag"),
        tx.clean_text(F.concat(F.lit(" a\nb\r"), F.col("url"), F.lit(" "))).alias("clean"),
        F.array_join(tx.author_field(F.concat(F.lit("A B; C D|"), F.col("page_id").cast("string"))), "+").alias("names"),
        F.element_at(F.split("url", "/"), -1).alias("last_part"),
    )


IDENTIFIERS_SQL = """
SELECT page_id, lower('v' || CAST(page_id AS VARCHAR) || '/' || substr(url, 9, 5)) AS doi, CAST(NULL AS VARCHAR) AS no_doi,
       sha1(url) AS paper_id, 'acl' AS venue, page_id % 2 = 0 AS flag, 'a b' || url AS clean,
       'A B+C D|' || CAST(page_id AS VARCHAR) AS names, string_split(url, '/')[-1] AS last_part
FROM pages
"""

# --- venues ----------------------------------------------------------------------------------

CODES = ["https", "com", "org", "net", "ex", "page", "site1", "a"]
OTHER = {"com": ["example", "www"], "org": ["wiki"], "page": ["article", "post"]}
FULL = {"site1": "https://site1.example"}


def _patterns(spark: Session) -> DataFrame:
    return venues.matcher_patterns(venues.conferences(spark, CODES, FULL), venues.conference_aliases(spark, CODES, OTHER))


def venue_resolve(spark: Session, sf: str) -> DataFrame:
    """MT3, JN5, SO7, T25: six strategies over page addresses, one row for each different venue."""
    return venues.resolve_venues(table(spark, sf, "pages").select(F.col("url").alias("venue_raw")), _patterns(spark))


def _venue_resolve_sql() -> str:
    codes = sorted(CODES)
    rows = [("full", f.lower(), c, codes.index(c)) for c, f in FULL.items()] + [("code", c.lower(), c, k) for k, c in enumerate(codes)]
    rows += [("alias", a.lower(), c, k) for k, (c, a) in enumerate(sorted((c, a) for c, names in OTHER.items() for a in names))]
    values = ", ".join(f"({sql_text(k)}, {sql_text(p)}, {sql_text(c)}, {o})" for k, p, c, o in rows)
    context = " OR ".join(f"contains(low, {sql_text(w)})" for w in tx.VENUE_CONTEXT)
    word = "regexp_matches({0}, '\\b' || pattern || '\\b')"
    year = "regexp_matches(low, '\\b' || pattern || '(?:\\s+[12]\\d{3}\\b|\\s*[''`]\\s*\\d{2}\\b|\\s*-\\s*[12]\\d{3}\\b)')"
    inside = f"CASE WHEN length(pattern) <= 3 THEN {word.format('low')} AND (({context}) OR {year}) ELSE contains(low, pattern) END"
    again = f"CASE WHEN length(pattern) <= 3 THEN {word.format('norm')} AND ({context}) ELSE contains(norm, pattern) END"
    return f"""
WITH p(kind, pattern, conference, ord) AS (VALUES {values}),
v AS (SELECT DISTINCT url AS venue, trim(lower(url)) AS low, {_venue_sql("url")} AS norm FROM pages WHERE url <> ''),
j AS (SELECT venue, conference, pattern, ord, CASE
        WHEN kind = 'full' AND low = pattern THEN 0 WHEN kind = 'full' AND contains(low, pattern) THEN 1
        WHEN kind = 'code' AND low = pattern THEN 2 WHEN kind = 'alias' AND ({inside}) THEN 3 WHEN kind = 'code' AND ({inside}) THEN 4
        WHEN kind = 'full' AND norm <> '' AND norm <> low AND contains(norm, pattern) THEN 5
        WHEN kind = 'code' AND norm <> '' AND norm <> low AND ({again}) THEN 6 END AS s FROM v, p),
r AS (SELECT venue, conference, s, row_number() OVER (PARTITION BY venue ORDER BY s, length(pattern) DESC, ord) AS place FROM j WHERE s IS NOT NULL)
SELECT venue, conference, CAST(least(s, 5) AS INTEGER) AS strategy FROM r WHERE place = 1
"""


def venue_mapping(spark: Session, sf: str) -> DataFrame:
    """MT7, JN12, SNK5: the mapping of different venues, unresolved ones with null."""
    return venues.build_mapping(table(spark, sf, "pages").select(F.col("url").alias("venue_raw")), _patterns(spark))


def _venue_mapping_sql() -> str:
    return f"""
SELECT u.url AS venue_raw, m.conference, CASE WHEN m.conference IS NOT NULL THEN 'exact' END AS method, CASE WHEN m.conference IS NOT NULL THEN 1.0E0 END AS confidence
FROM (SELECT DISTINCT url FROM pages WHERE url <> '') u LEFT JOIN ({_venue_resolve_sql()}) m ON u.url = m.venue
"""


def venue_mapping_stats(spark: Session, sf: str) -> DataFrame:
    """AG16: mapped venues by conference, the top twenty."""
    counts = venue_mapping(spark, sf).groupBy(F.coalesce("conference", F.lit("none")).alias("conference")).agg(F.count("*").alias("venues"))
    return counts.orderBy(F.desc("venues"), "conference").limit(20)


def venue_pattern_join(spark: Session, sf: str) -> DataFrame:
    """JN5: papers joined to the best pattern equal to or inside their venue."""
    rows = [("P", "page", "contains"), ("S", "site", "alias"), ("E", "example", "exact"), ("H", "http", "contains")]
    patterns = spark.createDataFrame(rows, "conference string, pattern string, match_type string")
    return venues.pattern_join(table(spark, sf, "pages").select("page_id", "url"), patterns, "url", "page_id").select("page_id", "conference")


PATTERN_SQL = """
WITH p(conference, pattern, k) AS (VALUES ('P', 'page', 2), ('S', 'site', 1), ('E', 'example', 0), ('H', 'http', 2)),
r AS (SELECT page_id, conference, row_number() OVER (PARTITION BY page_id ORDER BY k, length(pattern) DESC, pattern) AS place
      FROM pages, p WHERE lower(url) = pattern OR contains(lower(url), pattern))
SELECT page_id, conference FROM r WHERE place = 1
"""


def _vectors(spark: Session, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "embeddings")
    rows = e.select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    anchors = e.where(F.col("vec_id") < ANCHORS).select(F.col("vec_id").cast("string").alias("conference"), F.col("vec_id").cast("int").alias("ord"), F.col("embedding").alias("vector"))
    return rows, anchors


def cosine_top1(spark: Session, sf: str) -> DataFrame:
    """TX16, WN2: cosine best of ten anchors at 0.2 or more."""
    return venues.cosine_top1(*_vectors(spark, sf), LEAST_COSINE).select("id", "conference", F.round("score", 4).alias("score"))


COSINE_SQL = f"""
SELECT id, conference, round(score, 4) AS score FROM (
  SELECT e.vec_id AS id, CAST(a.vec_id AS VARCHAR) AS conference,
         list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) AS score,
         row_number() OVER (PARTITION BY e.vec_id ORDER BY list_cosine_similarity(CAST(e.embedding AS DOUBLE[]), CAST(a.embedding AS DOUBLE[])) DESC, a.vec_id) AS place
  FROM embeddings e, (SELECT * FROM embeddings WHERE vec_id < {ANCHORS}) a) WHERE place = 1 AND score >= {LEAST_COSINE}
"""


def two_layer_match(spark: Session, sf: str) -> DataFrame:
    """MT5: rows of label 0 are exact matches of conference ``0``, the rest by cosine."""
    rows, anchors = _vectors(spark, sf)
    exact = table(spark, sf, "embeddings").where("label = 0").select(F.col("vec_id").alias("id"), F.lit("0").alias("conference"))
    out = venues.two_layers(exact, venues.cosine_top1(rows, anchors, LEAST_COSINE))
    return out.select("id", "conference", F.round("score", 4).alias("score"), "method")


TWO_SQL = f"""
SELECT vec_id AS id, '0' AS conference, 1.0E0 AS score, 'exact' AS method FROM embeddings WHERE label = 0
UNION ALL SELECT s.id, s.conference, s.score, 'cosine' AS method FROM ({COSINE_SQL}) s
WHERE s.id NOT IN (SELECT vec_id FROM embeddings WHERE label = 0)
"""

# --- linking ---------------------------------------------------------------------------------


def _titles(spark: Session, sf: str) -> DataFrame:
    d = table(spark, sf, "documents")
    return d.select("doc_id", F.length("lang").alias("year"), F.col("text").alias("title"), "lang")


def exact_title_link(spark: Session, sf: str) -> DataFrame:
    """MT10 (exact), T12: each document to the smallest one with the key of its whole text and its language's size."""
    t = _titles(spark, sf)
    return linking.exact_links(t.withColumnRenamed("doc_id", "paper_id"), t.withColumnRenamed("doc_id", "corpus_id"), by_key=True)


EXACT_SQL = f"""
WITH t AS (SELECT doc_id, length(lang) AS year, {_title_key_sql("text")} AS k FROM documents)
SELECT a.doc_id AS paper_id, min(b.doc_id) AS corpus_id FROM t a JOIN t b ON a.year = b.year AND a.k = b.k WHERE a.k <> '' GROUP BY 1
"""


def tier_cascade(spark: Session, sf: str) -> DataFrame:
    """MT10-MT14, JN16: exact, similar and no match of even parts against odd ones of their size, by whole names."""
    t = table(spark, sf, "part").select("p_partkey", F.col("p_size").alias("year"), F.col("p_name").alias("title"))
    papers = t.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "paper_id")
    return linking.link_cascade(papers, t.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "corpus_id"))


#: Longest common blocks, first in the left and then in the right title, and again on both sides of each: the ratio by recursion.
TIER_SQL_TWIN = """
WITH RECURSIVE t AS (
    SELECT p_partkey, p_size AS year, p_name AS title, list_filter(string_split(lower(p_name), ' '), lambda x: length(x) > 3)[1:3] AS w FROM part
), papers AS (SELECT p_partkey AS paper_id, year, title, '%' || array_to_string(list_transform(w, lambda x: regexp_replace(x, '([%_\\\\])', '\\\\\\1', 'g')), '%') || '%' AS pattern, len(w) AS words FROM t WHERE p_partkey % 2 = 0),
dataset AS (SELECT p_partkey AS corpus_id, year, title AS other FROM t WHERE p_partkey % 2 = 1),
exact AS (SELECT paper_id, min(corpus_id) AS corpus_id FROM papers p JOIN dataset d ON p.year = d.year AND lower(title) = lower(other) AND title <> '' GROUP BY paper_id),
near AS (
    SELECT paper_id, corpus_id, title, other FROM papers p JOIN dataset d ON p.year = d.year AND words > 0 AND lower(other) LIKE pattern ESCAPE '\\'
    WHERE paper_id NOT IN (SELECT paper_id FROM exact)
), pairs AS (
    SELECT title, other, regexp_replace(lower(title), '[^a-z0-9 ]', '', 'g') AS x, regexp_replace(lower(other), '[^a-z0-9 ]', '', 'g') AS y FROM (SELECT DISTINCT title, other FROM near)
), common AS (
    SELECT title, other, i, j, k FROM pairs, range(1, 60) a(i), range(1, 60) b(j), range(1, 60) c(k)
    WHERE i + k - 1 <= length(x) AND j + k - 1 <= length(y) AND substr(x, i, k) = substr(y, j, k)
), parts AS (
    SELECT title, other, 1 AS alo, length(x) AS ahi, 1 AS blo, length(y) AS bhi, 0 AS size FROM pairs
    UNION ALL
    SELECT title, other, CASE WHEN side = 0 THEN alo WHEN side = 1 THEN i + k ELSE 1 END, CASE WHEN side = 0 THEN i - 1 WHEN side = 1 THEN ahi ELSE 0 END,
        CASE WHEN side = 0 THEN blo WHEN side = 1 THEN j + k ELSE 1 END, CASE WHEN side = 0 THEN j - 1 WHEN side = 1 THEN bhi ELSE 0 END, CASE WHEN side = 2 THEN k ELSE 0 END
    FROM (
        SELECT p.*, i, j, k FROM parts p JOIN common c ON c.title = p.title AND c.other = p.other AND i >= alo AND i + k - 1 <= ahi AND j >= blo AND j + k - 1 <= bhi
        QUALIFY row_number() OVER (PARTITION BY p.title, p.other, alo, ahi, blo, bhi ORDER BY k DESC, i, j) = 1
    ), (SELECT unnest([0, 1, 2]) AS side)
), ratios AS (
    SELECT p.title, p.other, 2.0E0 * sum(size) / (any_value(length(x)) + any_value(length(y))) AS s FROM parts q JOIN pairs p ON p.title = q.title AND p.other = q.other GROUP BY p.title, p.other
), best AS (
    SELECT paper_id, corpus_id, s FROM near n JOIN ratios r ON n.title = r.title AND n.other = r.other WHERE s >= 0.7
    QUALIFY row_number() OVER (PARTITION BY paper_id ORDER BY s DESC, corpus_id) = 1
), found AS (SELECT paper_id, corpus_id, 1.0E0 AS s FROM exact UNION ALL SELECT * FROM best)
SELECT p.paper_id, f.corpus_id, CASE WHEN f.paper_id IS NULL THEN 'No Match' ELSE 'Dataset Match' END AS match_method, CAST(coalesce(s, 0) AS DECIMAL(5, 3)) AS match_confidence,
    CASE WHEN s >= 0.85 THEN 'Tier1_Dataset_High' WHEN s IS NOT NULL THEN 'Tier1_Dataset_Medium' ELSE 'Tier3_NoMatch' END AS validation_tier
FROM papers p LEFT JOIN found f ON p.paper_id = f.paper_id
"""


def title_set_pairs(spark: Session, sf: str) -> DataFrame:
    """JN16, TX12: pairs of different page addresses whose sets of 4-grams are similar by 0.8 or more."""
    titles = table(spark, sf, "pages").where("url <> ''").groupBy(F.lower("url").alias("title")).agg(F.min("page_id").alias("id"))
    sets = titles.select("id", F.array_sort(setjoin.grams(F.col("title"), 4)).alias("tokens")).groupBy("tokens").agg(F.min("id").alias("id"))
    return setjoin.similar_sets(sets, 0.8).select("a", "b", "shared", F.round("similarity", 6).alias("similarity"))


SET_PAIRS_SQL = """
WITH t AS (SELECT lower(url) AS title, min(page_id) AS id FROM pages WHERE url <> '' GROUP BY 1),
g AS (SELECT id, list_sort(list_distinct(list_transform(range(1, greatest(1, length(title) - 3) + 1), lambda i: substr(title, i, 4)))) AS tokens FROM t),
s AS (SELECT min(id) AS id, tokens FROM g GROUP BY tokens),
p AS (SELECT x.id AS a, y.id AS b, len(list_intersect(x.tokens, y.tokens)) AS shared, len(x.tokens) + len(y.tokens) AS total FROM s x JOIN s y ON x.id < y.id)
SELECT a, b, CAST(shared AS INTEGER) AS shared, round(shared / CAST(total - shared AS DOUBLE), 6) AS similarity FROM p WHERE shared / CAST(total - shared AS DOUBLE) >= 0.8
"""


def completeness_score(spark: Session, sf: str) -> DataFrame:
    """MT15, T11: required fields without a column count as missing."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", F.round(linking.completeness(d.columns, ["text", "lang", "source", "quality", "toxic", "title", "year"]), 6).alias("score"))


COMPLETE_SQL = """
SELECT d.doc_id, round((CASE WHEN trim(d.text) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(d.lang) <> '' THEN 1 ELSE 0 END + CASE WHEN trim(d.source) <> '' THEN 1 ELSE 0 END
       + CASE WHEN l.quality IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN l.toxic IS NOT NULL THEN 1 ELSE 0 END) / 7.0E0, 6) AS score
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# --- authors ---------------------------------------------------------------------------------


def _bylines(spark: Session, sf: str, slips: bool = False) -> tuple[DataFrame, DataFrame]:
    """Names of papers and candidates, both from lines: the candidates in another order and spelling, with ``slips`` some with a letter too many."""
    auth = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("paper_id"), F.col("l_suppkey").alias("s")).agg(F.min("l_linenumber").alias("p"))
    pos = lambda o: (F.row_number().over(Window.partitionBy("paper_id").orderBy(*o)) - 1).cast("int")
    name = F.concat(F.lit("Ann Bo"), (F.col("s") % 7).cast("string"), F.lit(" Li"), (F.col("s") % 5).cast("string"))
    short = F.concat(F.lit("A. B. Li"), (F.col("s") % 5).cast("string"))
    other = F.when(F.col("s") % 2 == 0, name).otherwise(short)
    if slips:
        other = F.when(F.col("s") % 7 == 2, F.replace(name, F.lit("Li"), F.lit("Lii"))).otherwise(other)
    names = auth.select("paper_id", pos(["p", "s"]).alias("name_pos"), name.alias("name"))
    cands = auth.where("s % 3 <> 0").select("paper_id", pos([F.desc("s")]).alias("cand_pos"), F.col("s").cast("string").alias("cand_id"), other.alias("cand_name"))
    return names, cands


def author_match_exact(spark: Session, sf: str) -> DataFrame:
    """MT1 tier 1: the k-th equal name takes the k-th equal candidate."""
    found = authors.match_authors(*_bylines(spark, sf), tiers=("exact",))
    return found.select("paper_id", "name_pos", "cand_pos")


_BYLINE_SQL = """
auth AS (SELECT l_orderkey AS paper_id, l_suppkey AS s, min(l_linenumber) AS p FROM lineitem GROUP BY 1, 2),
names AS (SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY p, s) - 1 AS INTEGER) AS name_pos,
          'ann bo' || (s % 7) || ' li' || (s % 5) AS norm FROM auth),
cands AS (SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY s DESC) - 1 AS INTEGER) AS cand_pos,
          CASE WHEN s % 2 = 0 THEN 'ann bo' || (s % 7) || ' li' || (s % 5) ELSE 'a. b. li' || (s % 5) END AS norm FROM auth WHERE s % 3 <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY paper_id, norm ORDER BY name_pos) AS k FROM names),
c AS (SELECT *, row_number() OVER (PARTITION BY paper_id, norm ORDER BY cand_pos) AS k FROM cands),
exact AS (SELECT n.paper_id, name_pos, cand_pos FROM n JOIN c ON n.paper_id = c.paper_id AND n.norm = c.norm AND n.k = c.k)
"""
MATCH1_SQL = f"WITH {_BYLINE_SQL} SELECT paper_id, name_pos, cand_pos FROM exact"


def author_match_initials(spark: Session, sf: str) -> DataFrame:
    """MT1 tiers 1 and 3, TX6: what equal names leave, by initials and last token."""
    found = authors.match_authors(*_bylines(spark, sf), tiers=("exact", "initials"))
    return found.select("paper_id", "name_pos", "cand_pos", "tier")


MATCH3_SQL = f"""
WITH {_BYLINE_SQL},
key(norm, key) AS (SELECT DISTINCT norm, CASE WHEN norm LIKE 'ann%' THEN 'ab ' || string_split(norm, ' ')[3] ELSE 'ab ' || string_split(norm, ' ')[3] END FROM (SELECT norm FROM names UNION SELECT norm FROM cands)),
n3 AS (SELECT names.paper_id, names.name_pos, key, row_number() OVER (PARTITION BY names.paper_id, key ORDER BY names.name_pos) AS k
       FROM names JOIN key USING (norm) ANTI JOIN exact ON names.paper_id = exact.paper_id AND names.name_pos = exact.name_pos),
c3 AS (SELECT cands.paper_id, cands.cand_pos, key, row_number() OVER (PARTITION BY cands.paper_id, key ORDER BY cands.cand_pos) AS k
       FROM cands JOIN key USING (norm) ANTI JOIN exact ON cands.paper_id = exact.paper_id AND cands.cand_pos = exact.cand_pos)
SELECT paper_id, name_pos, cand_pos, 'exact' AS tier FROM exact
UNION ALL SELECT n3.paper_id, n3.name_pos, c3.cand_pos, 'initials' AS tier FROM n3 JOIN c3 ON n3.paper_id = c3.paper_id AND n3.key = c3.key AND n3.k = c3.k
"""


def authorships(spark: Session, sf: str) -> DataFrame:
    """MT1, MT2, T6, T7: all tiers and the unmatched, one row for each name of every paper."""
    return authors.build_authorships(*_bylines(spark, sf, slips=True))


def authorships_two_tiers(spark: Session, sf: str) -> DataFrame:
    """MT1, MT2 without the similarity tier: one row for each different name of every paper."""
    return authors.build_authorships(*_bylines(spark, sf), tiers=("exact", "initials"))


#: What two tiers leave: distinct pairs of texts, their longest common subsequences row by row, the best of
#: three ratios, and the assignment name by name.  Follows ``names``, ``cands`` and ``pairs``.
SIMILAR_SQL = """
n4 AS (SELECT paper_id, name_pos, norm, row_number() OVER (PARTITION BY paper_id ORDER BY name_pos) AS k FROM names ANTI JOIN pairs USING (paper_id, name_pos)),
c4 AS (SELECT paper_id, cand_pos, norm FROM cands ANTI JOIN pairs USING (paper_id, cand_pos)),
met AS (SELECT DISTINCT n4.norm AS a, c4.norm AS b FROM n4 JOIN c4 USING (paper_id)),
tokens AS (SELECT a, b, list_sort(string_split(a, ' ')) AS p, list_sort(string_split(b, ' ')) AS q FROM met),
sets AS (SELECT *, array_to_string(list_sort(list_distinct(list_intersect(p, q))), ' ') AS shared,
         array_to_string(list_sort(list_distinct(list_filter(p, lambda x: NOT list_contains(q, x)))), ' ') AS one,
         array_to_string(list_sort(list_distinct(list_filter(q, lambda x: NOT list_contains(p, x)))), ' ') AS two FROM tokens),
asked AS (
    SELECT a, b, 1 AS way, array_to_string(p, ' ') AS x, array_to_string(q, ' ') AS y FROM sets
    UNION ALL SELECT a, b, 2, trim(shared || ' ' || one), trim(shared || ' ' || two) FROM sets
    UNION ALL SELECT a, b, 2, shared, trim(shared || ' ' || unnest([one, two])) FROM sets WHERE shared <> ''
    UNION ALL SELECT a, b, 3, least_, substr(longer, greatest(0, e - length(least_)) + 1, least(e, length(longer)) - greatest(0, e - length(least_)))
    FROM (SELECT *, unnest(range(1, length(longer) + length(least_))) AS e FROM (SELECT a, b, CASE WHEN length(a) > length(b) THEN b ELSE a END AS least_, CASE WHEN length(a) > length(b) THEN a ELSE b END AS longer FROM met))
    WHERE contains(least_, CASE WHEN e >= length(longer) THEN substr(longer, greatest(0, e - length(least_)) + 1, 1) ELSE substr(longer, e, 1) END)
),
rows_of AS (
    SELECT x, y, 0 AS i, list_transform(range(length(y)), lambda t: 0) AS r FROM (SELECT DISTINCT x, y FROM asked WHERE x <> '' AND y <> '')
    UNION ALL
    SELECT x, y, i + 1, list_transform(range(1, length(y) + 1), lambda j: list_max(c[1:j])) FROM (
        SELECT x, y, i, list_transform(range(1, length(y) + 1), lambda j: greatest(r[j], CASE WHEN j > 1 THEN r[j - 1] ELSE 0 END + CASE WHEN substr(x, i + 1, 1) = substr(y, j, 1) THEN 1 ELSE 0 END)) AS c
        FROM rows_of WHERE i < length(x))
),
ratio AS (SELECT x, y, 200.0E0 * r[length(y)] / (length(x) + length(y)) AS s FROM rows_of WHERE i = length(x)),
score AS (
    SELECT asked.a, asked.b, CASE WHEN any_value(full_) THEN 100 ELSE CAST(max(round_even(coalesce(s, 0), 0)) AS INTEGER) END AS score
    FROM asked LEFT JOIN ratio USING (x, y) JOIN (SELECT a, b, shared <> '' AND (one = '' OR two = '') AS full_ FROM sets) f ON f.a = asked.a AND f.b = asked.b GROUP BY 1, 2
),
good AS (SELECT n4.paper_id, k, name_pos, cand_pos, score FROM n4 JOIN c4 USING (paper_id) JOIN score ON a = n4.norm AND b = c4.norm WHERE score > 85),
walk AS (
    SELECT DISTINCT paper_id, CAST(1 AS BIGINT) AS k, CAST([] AS INTEGER[]) AS taken, CAST(NULL AS INTEGER) AS pick FROM good
    UNION ALL
    SELECT paper_id, k + 1, CASE WHEN cand_pos IS NULL THEN taken ELSE list_append(taken, cand_pos) END, cand_pos FROM (
        SELECT w.paper_id, w.k, w.taken, g.cand_pos FROM walk w JOIN n4 ON n4.paper_id = w.paper_id AND n4.k = w.k
        LEFT JOIN good g ON g.paper_id = w.paper_id AND g.k = w.k AND NOT list_contains(w.taken, g.cand_pos)
        QUALIFY row_number() OVER (PARTITION BY w.paper_id ORDER BY g.score DESC NULLS LAST, g.cand_pos) = 1)
),
alike AS (SELECT walk.paper_id, n4.name_pos, pick AS cand_pos, 'similar' AS tier FROM walk JOIN n4 ON n4.paper_id = walk.paper_id AND n4.k = walk.k - 1 WHERE pick IS NOT NULL),
"""


def _authorships_sql() -> str:
    two = _two_tiers_sql()
    head, _, rest = two.partition("\nshown AS (")
    rest = rest.replace("LEFT JOIN pairs USING (paper_id, name_pos)", "LEFT JOIN (SELECT * FROM pairs UNION ALL SELECT * FROM alike) pairs USING (paper_id, name_pos)")
    rest = rest.replace("WHEN 'initials' THEN 3 END", "WHEN 'initials' THEN 3 WHEN 'similar' THEN 4 END")
    whole = head.replace("WITH ", "WITH RECURSIVE ", 1) + SIMILAR_SQL + "shown AS (" + rest
    for a, l in (("ann bo", "li"), ("Ann Bo", "Li")):
        whole = whole.replace(f"CASE WHEN s % 2 = 0 THEN '{a}'", f"CASE WHEN s % 7 = 2 THEN '{a}' || (s % 7) || ' {l}i' || (s % 5) WHEN s % 2 = 0 THEN '{a}'")
    return whole


def _two_tiers_sql() -> str:
    names = """
shown AS (SELECT paper_id, name_pos, 'Ann Bo' || split_part(substr(norm, 7), ' ', 1) || ' Li' || split_part(norm, ' li', 2) AS name FROM names),
who AS (SELECT paper_id, CAST(row_number() OVER (PARTITION BY paper_id ORDER BY s DESC) - 1 AS INTEGER) AS cand_pos, CAST(s AS VARCHAR) AS cand_id,
        CASE WHEN s % 2 = 0 THEN 'Ann Bo' || (s % 7) || ' Li' || (s % 5) ELSE 'A. B. Li' || (s % 5) END AS cand_name FROM auth WHERE s % 3 <> 0),
hits AS (SELECT shown.paper_id, shown.name_pos, shown.name, CASE tier WHEN 'exact' THEN 1 WHEN 'initials' THEN 3 END AS t, cand_id, cand_name
         FROM shown LEFT JOIN pairs USING (paper_id, name_pos) LEFT JOIN who ON who.paper_id = shown.paper_id AND who.cand_pos = pairs.cand_pos),
last AS (SELECT *, row_number() OVER (PARTITION BY paper_id, name ORDER BY coalesce(t, 0) DESC, name_pos DESC) AS late,
                min(name_pos) OVER (PARTITION BY paper_id, name) AS first_pos,
                min(CASE WHEN t IS NOT NULL THEN t * 1000 + name_pos END) OVER (PARTITION BY paper_id, name) AS best FROM hits)
SELECT paper_id, name AS author_name, coalesce(cand_name, '') AS matched_name, coalesce(cand_id, '') AS matched_id,
       CAST(row_number() OVER (PARTITION BY paper_id ORDER BY best IS NULL, best, first_pos) AS INTEGER) AS match_order, first_pos + 1 AS byline_position,
       CASE WHEN t IS NULL THEN 'unmatched' ELSE 'matched' END AS match_confidence,
       CASE WHEN t IS NULL THEN 'no_match_found' ELSE 'multi_tier_matching' END AS match_method
FROM last WHERE late = 1"""
    head, _, tail = MATCH3_SQL.rpartition("SELECT paper_id, name_pos, cand_pos, 'exact' AS tier FROM exact")
    return f"{head.rstrip()},\npairs AS (SELECT paper_id, name_pos, cand_pos, 'exact' AS tier FROM exact{tail}),{names}"


def match_statistics(spark: Session, sf: str) -> DataFrame:
    """AG25: matches by tier and the success rate, over the two exact tiers."""
    names, _ = _bylines(spark, sf)
    counts = author_match_initials(spark, sf).groupBy("tier").agg(F.count("*").alias("matches"))
    total = names.agg(F.count("*").alias("total"))
    return counts.join(F.broadcast(total)).select("tier", "matches", F.round(F.col("matches") * 100.0 / F.col("total"), 4).alias("share_pct"))


MATCH_STATS_SQL = f"""
SELECT tier, count(*) AS matches, round(count(*) * 100.0E0 / (SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)), 4) AS share_pct
FROM ({MATCH3_SQL}) GROUP BY tier
"""


def _profile_rows(spark: Session, sf: str) -> DataFrame:
    from stemma.plans import profiles

    auth = profiles.authorships(table(spark, sf, "lineitem"))
    rows = profiles.with_byline_ends(auth).join(profiles.papers(table(spark, sf, "orders")), "paper_id", "left")
    brand = (F.col("author_id") % 10).cast("string")
    return rows.select(
        brand.alias("author_name"), F.struct("paper_id", "author_id").alias("ord"), F.col("author_id").cast("string").alias("author_id"),
        F.concat(F.lit("N"), (F.col("author_id") % 20).cast("string")).alias("matched_name"), F.col("citations").alias("influential"), "year",
        F.col("first_author_id").cast("string").alias("first_id"), F.col("last_author_id").cast("string").alias("last_id"),
    )


def author_profile_by_name(spark: Session, sf: str) -> DataFrame:
    """AG1 complete: names that several ids share, ids and names concatenated in the order first seen."""
    p = authors.author_profiles(_profile_rows(spark, sf), AS_OF_YEAR)
    doubles = [f.name for f in p.schema.fields if f.dataType.simpleString() == "double"]
    return p.select(*[F.round(c, 6).alias(c) if c in doubles else F.col(c) for c in p.columns])


PROFILE_NAME_SQL = f"""
WITH {AUTH_SQL},
r AS (SELECT CAST(author_id % 10 AS VARCHAR) AS author_name, paper_id, author_id AS a, CAST(author_id AS VARCHAR) AS author_id, 'N' || (author_id % 20) AS matched_name,
             citations, year, first_author_id, last_author_id FROM auth JOIN ends USING (paper_id) LEFT JOIN paper USING (paper_id)),
i AS (SELECT author_name, string_agg(author_id, ',' ORDER BY p, a) AS author_ids FROM (
        SELECT author_name, author_id, min(paper_id) AS p, min(a) AS a FROM r GROUP BY 1, 2) GROUP BY 1),
mn AS (SELECT author_name, string_agg(matched_name, ',' ORDER BY first) AS matched_names FROM (
        SELECT author_name, matched_name, min(paper_id * 1000000 + a) AS first FROM r GROUP BY 1, 2) GROUP BY 1),
c AS (SELECT author_name, count(*) AS n, sum(citations) AS cites, min(year) AS fy, max(year) AS ly, count(*) FILTER (a = first_author_id) AS f,
             count(*) FILTER (a = last_author_id) AS l, count(*) FILTER (year >= {AS_OF_YEAR} - 3) AS recent FROM r GROUP BY 1)
SELECT author_name, author_ids, matched_names, CAST(n AS INTEGER) AS paper_count, CAST(cites AS INTEGER) AS total_citations, round(cites / n, 6) AS avg_citations_per_paper,
       fy AS first_publication_year, ly AS latest_publication_year, CAST({AS_OF_YEAR} - fy + 1 AS INTEGER) AS career_length,
       CAST(f AS INTEGER) AS first_author_count, CAST(l AS INTEGER) AS last_author_count, CAST(n - f - l AS INTEGER) AS middle_author_count,
       round(f / n, 6) AS first_author_ratio, round(l / n, 6) AS last_author_ratio, round(f / n * 0.4 + l / n * 0.6, 6) AS contribution_score,
       round(recent / n, 6) AS rising_star_score, 'high' AS match_confidence, 1.0E0 AS data_completeness_score
FROM c JOIN i USING (author_name) JOIN mn USING (author_name)
"""


def _cached(spark: Session, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    return c.select(
        (F.col("c_custkey") % 50).cast("string").alias("author_name"), F.col("c_custkey").alias("updated_at"),
        F.when(F.col("c_custkey") % 3 == 0, F.concat(F.lit("u"), F.col("c_custkey").cast("string"))).otherwise("").alias("url"),
        F.array(F.col("c_mktsegment"), F.lit("")).alias("affiliations"), (F.col("c_custkey") % 4).cast("bigint").alias("paper_count"),
        (F.col("c_custkey") % 9).cast("bigint").alias("citation_count"), F.col("c_nationkey").alias("h_index"), F.col("c_custkey").alias("ord"),
    )


def cache_merge(spark: Session, sf: str) -> DataFrame:
    """AG2: several cached records of an author merged; zero is null."""
    return authors.merge_cached(_cached(spark, sf))


CACHE_SQL = """
WITH c AS (SELECT CAST(c_custkey % 50 AS VARCHAR) AS author_name, c_custkey AS k, c_mktsegment AS s, c_nationkey AS h FROM customer)
SELECT author_name, arg_max('u' || k, k) FILTER (k % 3 = 0) AS homepage, array_to_string(list_sort(list(DISTINCT s)), ',') AS affiliations,
       CAST(nullif(sum(k % 4), 0) AS BIGINT) AS paper_count, CAST(nullif(sum(k % 9), 0) AS BIGINT) AS citation_count, nullif(max(h), 0) AS h_index FROM c GROUP BY 1
"""


def fetched_merge(spark: Session, sf: str) -> DataFrame:
    """AG3: fetched records merged in order, distinct homepages and affiliations joined."""
    return authors.merge_fetched(_cached(spark, sf)).select("author_name", "homepage", "remote_affiliations", F.col("remote_paper_count").cast("bigint").alias("remote_paper_count"), "remote_h_index")


FETCHED_SQL = """
WITH c AS (SELECT CAST(c_custkey % 50 AS VARCHAR) AS author_name, c_custkey AS k, c_mktsegment AS s, c_nationkey AS h FROM customer),
a AS (SELECT author_name, string_agg(s, ',' ORDER BY k) AS remote_affiliations FROM (SELECT author_name, s, min(k) AS k FROM c GROUP BY 1, 2) GROUP BY 1)
SELECT author_name, string_agg('u' || k, ',' ORDER BY k) FILTER (k % 3 = 0) AS homepage, any_value(remote_affiliations) AS remote_affiliations,
       CAST(sum(k % 4) AS BIGINT) AS remote_paper_count, max(h) AS remote_h_index FROM c JOIN a USING (author_name) GROUP BY 1
"""


def contains_list_join(spark: Session, sf: str) -> DataFrame:
    """JN8, NS7: comma-separated ids exploded and joined to the cache, sums and maximum."""
    profiles = author_profile_by_name(spark, sf).select("author_name", "author_ids")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").cast("string").alias("author_id"), "s_acctbal", "s_nationkey")
    return authors.split_ids(profiles).join(s, "author_id").groupBy("author_name").agg(
        F.count("*").alias("records"), F.round(F.sum("s_acctbal"), 2).alias("metric"), F.max("s_nationkey").alias("best")
    )


CONTAINS_SQL = """
WITH a AS (SELECT DISTINCT l_suppkey AS k FROM lineitem)
SELECT CAST(k % 10 AS VARCHAR) AS author_name, count(*) AS records, round(sum(s_acctbal), 2) AS metric, max(s_nationkey) AS best
FROM a JOIN supplier ON s_suppkey = k GROUP BY 1
"""


def fill_only_missing(spark: Session, sf: str) -> DataFrame:
    """AG4, JN6, LK6: nulls of two columns filled from a second source."""
    c = table(spark, sf, "customer")
    target = c.select("c_custkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("seg"), F.when(F.col("c_custkey") % 5 != 0, F.col("c_nationkey")).alias("nat"))
    source = c.where("c_custkey % 2 = 0").select("c_custkey", F.col("c_name").alias("seg"), F.lit(-1).alias("nat"))
    return authors.fill_missing(target, source, "c_custkey", ["seg", "nat"])


FILL_SQL = """
WITH t AS (SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS seg, CASE WHEN c_custkey % 5 <> 0 THEN c_nationkey END AS nat FROM customer),
s AS (SELECT c_custkey, c_name AS seg, -1 AS nat FROM customer WHERE c_custkey % 2 = 0)
SELECT t.c_custkey, coalesce(t.seg, s.seg) AS seg, coalesce(t.nat, s.nat) AS nat,
       (t.seg IS NULL AND s.seg IS NOT NULL) OR (t.nat IS NULL AND s.nat IS NOT NULL) AS was_filled FROM t LEFT JOIN s ON t.c_custkey = s.c_custkey
"""


def final_author_table(spark: Session, sf: str) -> DataFrame:
    """PRJ17, PRJ18: the published twenty columns."""
    return authors.final_table(authors.author_profiles(_profile_rows(spark, sf), AS_OF_YEAR), cache_merge(spark, sf))


FINAL_SQL = f"""
SELECT p.author_name AS byline_name, '' AS note, '' AS google_scholarid, p.author_name AS external_ids_bibliography, coalesce(c.affiliations, '') AS remote_affiliations,
       '' AS ranked_affiliation, 0 AS top_paper_total_paper_captured, 0 AS top_paper_last_author_count, p.first_author_count,
       CAST(coalesce(c.paper_count, 0) AS INTEGER) AS remote_paper_count, p.career_length, CAST(NULL AS INTEGER) AS last_author_percentage,
       p.total_citations AS total_influential_citations, CAST(coalesce(c.citation_count, 0) AS INTEGER) AS remote_citation_count,
       coalesce(c.h_index, 0) AS remote_h_index, p.author_name AS name, p.author_name AS name_snapshot, coalesce(c.affiliations, '') AS affiliations_snapshot,
       coalesce(c.homepage, '') AS homepage, p.author_ids AS remote_author_id
FROM ({PROFILE_NAME_SQL}) p LEFT JOIN ({CACHE_SQL}) c ON p.author_name = c.author_name
"""


GOLDEN_FIELDS = ["career_length", "first_author_count", "total_influential_citations", "remote_paper_count", "remote_citation_count", "remote_h_index"]


def golden_checks(spark: Session, sf: str) -> DataFrame:
    """V1-V3, JN10: six fields recomputed from their sources and compared with a published table that has errors.

    The careers of names 3 and 7, the paper count of name 5 and the citations of name 8 are published one too high.
    """
    from stemma.operators.verify import compare, pass_rates

    rows = _profile_rows(spark, sf)
    from_papers = rows.groupBy("author_name").agg(
        (F.lit(AS_OF_YEAR) - F.min("year") + 1).alias("career_length"), F.count_if(F.col("author_id") == F.col("first_id")).alias("first_author_count"),
        F.sum("influential").alias("total_influential_citations"),
    )
    from_cache = _cached(spark, sf).groupBy("author_name").agg(
        F.sum("paper_count").alias("remote_paper_count"), F.sum("citation_count").alias("remote_citation_count"), F.max("h_index").alias("remote_h_index")
    )
    published = final_author_table(spark, sf).withColumnRenamed("byline_name", "author_name")
    wrong = lambda c, names: (F.col(c) + F.col("author_name").isin(names).cast("int")).alias(c)
    published = published.select("author_name", wrong("career_length", ["3", "7"]), wrong("remote_paper_count", ["5"]), wrong("remote_citation_count", ["8"]), *[c for c in GOLDEN_FIELDS if c not in ("career_length", "remote_paper_count", "remote_citation_count")])
    return pass_rates(compare(published, from_papers.join(from_cache, "author_name", "left"), "author_name", GOLDEN_FIELDS))


def _golden_sql() -> str:
    each = " UNION ALL ".join(f"SELECT '{f}' AS field, coalesce(CAST(e.{f} AS DOUBLE), 0) = coalesce(CAST(p.{f} AS DOUBLE), 0) AS ok FROM pub p LEFT JOIN e USING (n)" for f in GOLDEN_FIELDS)
    return f"""
WITH {AUTH_SQL},
r AS (SELECT CAST(author_id % 10 AS VARCHAR) AS n, author_id, citations, year, first_author_id FROM auth JOIN ends USING (paper_id) LEFT JOIN paper USING (paper_id)),
a AS (SELECT n, {AS_OF_YEAR} - min(year) + 1 AS career_length, count(*) FILTER (author_id = first_author_id) AS first_author_count, sum(citations) AS total_influential_citations FROM r GROUP BY n),
b AS (SELECT CAST(c_custkey % 50 AS VARCHAR) AS n, sum(c_custkey % 4) AS remote_paper_count, sum(c_custkey % 9) AS remote_citation_count, max(c_nationkey) AS remote_h_index FROM customer GROUP BY 1),
e AS (SELECT * FROM a LEFT JOIN b USING (n)),
pub AS (SELECT n, career_length + CAST(n IN ('3', '7') AS INTEGER) AS career_length, first_author_count, total_influential_citations,
               coalesce(remote_paper_count, 0) + CAST(n = '5' AS INTEGER) AS remote_paper_count,
               coalesce(remote_citation_count, 0) + CAST(n = '8' AS INTEGER) AS remote_citation_count, remote_h_index FROM e),
c AS ({each})
SELECT field, count(*) AS checked, count(*) FILTER (ok) AS passed, round(avg(CAST(ok AS DOUBLE)) * 100, 2) AS pass_rate_pct FROM c GROUP BY field
"""


# --- nested ----------------------------------------------------------------------------------


def _nested(spark: Session, sf: str) -> DataFrame:
    item = F.struct(F.col("l_linenumber").alias("pos"), F.col("l_suppkey").cast("string").alias("authorId"), F.col("l_returnflag").alias("name"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(item)).alias("authors"))


def author_explode(spark: Session, sf: str) -> DataFrame:
    """NS1, WN4, SNK5: arrays exploded with positions from 0, first row of each (paper, author)."""
    rows = _nested(spark, sf).select("l_orderkey", F.posexplode("authors").alias("seq", "a")).select("l_orderkey", "seq", F.col("a.authorId").alias("author_id"))
    return incremental.first_of(rows.where("author_id <> ''"), ["l_orderkey", "author_id"], ["seq"])


EXPLODE_SQL = """
WITH a AS (SELECT l_orderkey, l_suppkey, CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR), l_returnflag) - 1 AS INTEGER) AS seq FROM lineitem)
SELECT l_orderkey, min(seq) AS seq, CAST(l_suppkey AS VARCHAR) AS author_id FROM a GROUP BY l_orderkey, l_suppkey
"""


def last_author_json(spark: Session, sf: str) -> DataFrame:
    """NS3, NS5: arrays to JSON and back, the last element's id; bad JSON is null."""
    kind = "array<struct<pos:int,authorId:string,name:string>>"
    j = _nested(spark, sf).withColumn("json", F.to_json("authors"))
    return j.select("l_orderkey", F.try_element_at(F.from_json("json", kind), F.lit(-1))["authorId"].alias("last_id"), F.from_json(F.when(F.col("l_orderkey") % 2 == 0, F.substring("json", 1, 5)).otherwise(F.col("json")), kind).isNull().alias("bad_is_null"))


LAST_SQL = """
WITH a AS (SELECT l_orderkey, l_suppkey, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber DESC, CAST(l_suppkey AS VARCHAR) DESC, l_returnflag DESC) AS k FROM lineitem)
SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) AS last_id, l_orderkey % 2 = 0 AS bad_is_null FROM a WHERE k = 1
"""


def json_props(spark: Session, sf: str) -> DataFrame:
    """PRJ21: values of JSON text, summed by type."""
    k = F.expr("try_cast(get_json_object(props, '$.k') AS bigint)")
    return table(spark, sf, "events").groupBy("event_type").agg(F.sum(k).alias("total"), F.count(F.get_json_object("props", "$.none")).alias("absent"))


JSON_SQL = "SELECT event_type, CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS total, CAST(0 AS BIGINT) AS absent FROM events GROUP BY 1"


def export_pipe_join(spark: Session, sf: str) -> DataFrame:
    """SNK14, NS4, AG5: arrays joined with a pipe, ordered."""
    return _nested(spark, sf).select("l_orderkey", F.array_join(F.transform("authors", lambda a: a["authorId"]), "|").alias("authors"))


EXPORT_SQL = """
SELECT l_orderkey, string_agg(CAST(l_suppkey AS VARCHAR), '|' ORDER BY l_linenumber, CAST(l_suppkey AS VARCHAR), l_returnflag) AS authors FROM lineitem GROUP BY 1
"""


def essential_export(spark: Session, sf: str) -> DataFrame:
    """SNK15, SO1: chosen columns in order."""
    return table(spark, sf, "documents").select("doc_id", "lang", "source", "n_chars").orderBy("lang", F.desc("n_chars"), "doc_id")


# --- incremental -----------------------------------------------------------------------------


def _events(spark: Session, sf: str) -> tuple[DataFrame, DataFrame]:
    e = table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return e.where("event_id % 3 <> 0"), e.where("event_id % 3 = 0")


def upsert_latest(spark: Session, sf: str) -> DataFrame:
    """SNK1, SNK4, SNK9: the last row of each user wins, new over old."""
    old, new = (incremental.first_of(x, ["user_id"], [F.desc("ts"), F.desc("event_id")]) for x in _events(spark, sf))
    return incremental.upsert(old, new, ["user_id"])


UPSERT_SQL = """
WITH r AS (SELECT user_id, event_id, event_type, value, ts, event_id % 3 = 0 AS fresh,
                  row_number() OVER (PARTITION BY user_id, event_id % 3 = 0 ORDER BY ts DESC, event_id DESC) AS k FROM events)
SELECT user_id, event_id, event_type, value, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY fresh DESC) AS p FROM r WHERE k = 1) WHERE p = 1
"""


def upsert_sparse(spark: Session, sf: str) -> DataFrame:
    """SNK2, SNK3, PRJ10, PRJ11: only values that are not null overwrite."""
    old, new = (incremental.first_of(x, ["user_id"], [F.desc("ts"), F.desc("event_id")]) for x in _events(spark, sf))
    new = new.withColumn("value", F.when(F.col("event_id") % 2 == 0, F.col("value")))
    return incremental.upsert_filled(old.select("user_id", "event_type", "value"), new.select("user_id", "event_type", "value"), ["user_id"])


SPARSE_SQL = """
WITH r AS (SELECT user_id, event_id, event_type, value, event_id % 3 = 0 AS fresh, row_number() OVER (PARTITION BY user_id, event_id % 3 = 0 ORDER BY ts DESC, event_id DESC) AS k FROM events),
o AS (SELECT * FROM r WHERE k = 1 AND NOT fresh), n AS (SELECT * FROM r WHERE k = 1 AND fresh)
SELECT coalesce(n.user_id, o.user_id) AS user_id, coalesce(n.event_type, o.event_type) AS event_type,
       coalesce(CASE WHEN n.event_id % 2 = 0 THEN n.value END, o.value) AS value FROM o FULL JOIN n ON o.user_id = n.user_id
"""


def insert_ignore(spark: Session, sf: str) -> DataFrame:
    """SNK5, NS1: only new keys come, the first row of each."""
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", "l_linenumber", "l_quantity")
    old = incremental.first_of(lines.where("l_linenumber <= 2"), ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_quantity"])
    return incremental.insert_ignore(old, lines.where("l_linenumber > 2"), ["l_orderkey", "l_suppkey"], ["l_linenumber", "l_quantity"])


IGNORE_SQL = """
SELECT l_orderkey, l_suppkey, l_linenumber, l_quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_suppkey ORDER BY l_linenumber > 2, l_linenumber, l_quantity) AS k FROM lineitem) WHERE k = 1
"""


def partial_overwrite(spark: Session, sf: str) -> DataFrame:
    """SNK10: rows of re-processed papers are replaced."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    new = o.where("o_custkey % 7 = 0").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    return incremental.replace_batch(o, new, "o_custkey")


OVERWRITE_SQL = "SELECT o_orderkey, o_custkey, CASE WHEN o_custkey % 7 = 0 THEN o_totalprice * 2 ELSE o_totalprice END AS o_totalprice FROM orders"


def upsert_counts(spark: Session, sf: str) -> DataFrame:
    """SNK6, SNK24, JN13, T32: inserted and updated keys of an upsert."""
    o = table(spark, sf, "orders").select("o_orderkey")
    return incremental.upsert_counts(o.where("o_orderkey % 3 <> 0"), o.where("o_orderkey % 2 = 0"), ["o_orderkey"])


COUNTS_SQL = "SELECT count(DISTINCT o_orderkey) FILTER (o_orderkey % 3 = 0) AS inserted, count(DISTINCT o_orderkey) FILTER (o_orderkey % 3 <> 0) AS updated FROM orders WHERE o_orderkey % 2 = 0"


def delete_release(spark: Session, sf: str) -> DataFrame:
    """SNK13: how many rows a deletion by release removes."""
    return incremental.delete_where(table(spark, sf, "orders"), F.col("o_orderstatus") == "F")[1]


def dedupe_keep_first(spark: Session, sf: str) -> DataFrame:
    """PRJ7, WN3, T16, T23: rows with a key and title, first of each title."""
    d = table(spark, sf, "documents").select("doc_id", "text", "lang", F.when(F.col("doc_id") % 2 == 0, "12").otherwise("x").alias("year"))
    rows = incremental.dedupe_clean(d, "text", "text", ["doc_id"], numbers=["year"], texts=["lang"])
    return rows.select("doc_id", "lang", "year")


DEDUPE_SQL = """
SELECT doc_id, coalesce(lang, '') AS lang, CAST(CASE WHEN doc_id % 2 = 0 THEN 12 ELSE 0 END AS BIGINT) AS year FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS k FROM documents WHERE text IS NOT NULL AND trim(text) <> '') WHERE k = 1
"""


def papers_needing_enrichment(spark: Session, sf: str) -> DataFrame:
    """JN2, IN2, T10: no linked row, or updated since, or no remote id."""
    o = table(spark, sf, "orders").select(F.col("o_custkey").alias("user_id"), F.col("o_orderkey").alias("paper_id"), F.lit("2024-01-29").cast("timestamp").alias("updated_at"))
    e = table(spark, sf, "events").groupBy("user_id").agg(F.max("ts").alias("linked_at"), F.max(F.when(F.col("event_type") == "purchase", "x")).alias("remote_id"))
    return incremental.missing_or_stale(o, e, "user_id").select("paper_id", "user_id")


NEEDING_SQL = """
SELECT o_orderkey AS paper_id, o_custkey AS user_id FROM orders
LEFT JOIN (SELECT user_id, max(ts) AS linked_at, max(CASE WHEN event_type = 'purchase' THEN 'x' END) AS remote_id FROM events GROUP BY 1) e ON e.user_id = o_custkey
WHERE linked_at IS NULL OR TIMESTAMP '2024-01-29' > linked_at OR coalesce(remote_id, '') = ''
"""


def papers_new_or_updated(spark: Session, sf: str) -> DataFrame:
    """JN4, IN1: no authorship at all, or one older than the update."""
    e = table(spark, sf, "events")
    papers = e.where("event_type = 'view'").groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    links = e.where("event_type = 'purchase'").select("user_id", F.col("ts").alias("created_at"))
    return incremental.new_or_updated(papers, links, "user_id")


NEW_SQL = """
WITH p AS (SELECT user_id, max(ts) AS updated_at FROM events WHERE event_type = 'view' GROUP BY 1),
a AS (SELECT user_id, ts AS created_at FROM events WHERE event_type = 'purchase')
SELECT user_id, updated_at FROM p WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.user_id = p.user_id) OR EXISTS (SELECT 1 FROM a WHERE a.user_id = p.user_id AND a.created_at < p.updated_at)
"""


def stale_cache_ids(spark: Session, sf: str) -> DataFrame:
    """JN3, IN3: different ids that the cache lacks or holds from long ago."""
    e = table(spark, sf, "events")
    cache = e.where("event_type = 'purchase'").groupBy("user_id").agg(F.max("ts").alias("updated_at"))
    return incremental.stale_ids(e, cache, "user_id", F.lit("2024-01-25").cast("timestamp"))


STALE_SQL = """
SELECT u.user_id FROM (SELECT DISTINCT user_id FROM events WHERE user_id IS NOT NULL) u LEFT JOIN (SELECT user_id, max(ts) AS t FROM events WHERE event_type = 'purchase' GROUP BY 1) c USING (user_id)
WHERE t IS NULL OR t < TIMESTAMP '2024-01-25'
"""


def resume_files(spark: Session, sf: str) -> DataFrame:
    """SRC9, IN5, SNK11: sources that no loaded document names."""
    d = table(spark, sf, "documents").select(F.col("source").alias("source_file"), "doc_id")
    return incremental.files_to_load(d.select("source_file").distinct(), d.where("doc_id % 20 < 7"))


RESUME_SQL = "SELECT DISTINCT source AS source_file FROM documents WHERE source NOT IN (SELECT source FROM documents WHERE doc_id % 20 < 7)"


def last_success(spark: Session, sf: str) -> DataFrame:
    """SNK19: the newest purchase of each user."""
    e = table(spark, sf, "events").where("event_type = 'purchase'")
    return e.groupBy("user_id").agg(F.max_by("event_id", F.struct("ts", "event_id")).alias("event_id"), F.max("ts").alias("ts"))


LAST_SUCCESS_SQL = """
SELECT user_id, event_id, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS k FROM events WHERE event_type = 'purchase') WHERE k = 1
"""


def bloom_sizing(spark: Session, sf: str) -> DataFrame:
    """MT16: bits, hashes and expected rate for the number of customers."""
    one = table(spark, sf, "customer").agg(F.count("*").alias("n"))
    sizes = bloom.sizing(F.col("n"), F.lit(0.01))
    return one.select("n", *[c.alias(k) for k, c in sizes.items()]).withColumn("fpp", bloom.false_positive_rate(F.col("n"), F.col("bits"), F.col("hashes")))


BLOOM_SQL = """
WITH s AS (SELECT n, CAST(floor(-(n * ln(0.01)) / pow(ln(2.0), 2)) AS BIGINT) AS bits FROM (SELECT count(*) AS n FROM customer)),
h AS (SELECT n, bits, CAST(floor(bits / n * ln(2.0)) + 1 AS INTEGER) AS hashes FROM s)
SELECT n, bits, hashes, CAST(floor(bits / 8) + 1 AS BIGINT) AS bytes, round(pow(1 - exp(-hashes * n / bits), hashes), 4) AS fpp FROM h
"""


def bloom_membership(spark: Session, sf: str) -> DataFrame:
    """MT16: a filter of the even customers is asked for all: none is missed, and few others are found."""
    c = table(spark, sf, "customer").select("c_custkey")
    added = c.where("c_custkey % 2 = 0")
    one = added.agg(F.count("*").alias("n"))
    sizes = one.select(*[x.alias(k) for k, x in bloom.sizing(F.col("n"), F.lit(0.01)).items()]).first()  # one row
    maybe = bloom.might_contain(c, "c_custkey", bloom.build(added, "c_custkey", sizes.bits, sizes.hashes), sizes.bits, sizes.hashes)
    found = c.join(maybe.withColumn("maybe", F.lit(True)), "c_custkey", "left").withColumn("maybe", F.coalesce("maybe", F.lit(False)))
    even = F.col("c_custkey") % 2 == 0
    rate = F.count_if(~even & F.col("maybe")) / F.count_if(~even)
    return found.agg(F.count_if(even & F.col("maybe")).alias("found"), F.count_if(even & ~F.col("maybe")).alias("missed"), F.count_if(~even).alias("absent"), (rate < 0.03).alias("few_false"))


BLOOM_ASKED_SQL = "SELECT count(*) FILTER (c_custkey % 2 = 0) AS found, CAST(0 AS BIGINT) AS missed, count(*) FILTER (c_custkey % 2 <> 0) AS absent, true AS few_false FROM customer"

# --- records of bulk dumps, older matcher, dimension ---------------------------------------------


def open_access_fields(spark: Session, sf: str) -> DataFrame:
    """PRJ4, PRJ5, PRJ15: the PDF's address from an object or a text, the first filled list, the id of the bibliography."""
    p = table(spark, sf, "pages")
    n = F.col("page_id") % 4
    raw = F.when(n == 0, F.to_json(F.struct(F.col("url").alias("url")))).when(n == 1, F.concat(F.lit('"'), F.col("url"), F.lit('"'))).when(n == 2, F.lit(""))
    lists = [F.when(n == k, F.array(F.lit(f"field{k}"))) for k in (1, 2)]
    ids = F.from_json(F.when(n == 3, F.lit("{}")).otherwise(F.concat(F.lit(f'{{"{BIBLIOGRAPHY_KEY}": "key/'), F.col("page_id").cast("string"), F.lit('"}'))), "map<string,string>")
    return p.select("page_id", tx.pdf_url(raw).alias("pdf"), F.array_join(tx.first_filled(*lists), ",").alias("fields"), ids[BIBLIOGRAPHY_KEY].alias("bibliography_id"))


OPEN_SQL = """
SELECT page_id, CASE WHEN page_id % 4 <= 1 THEN url END AS pdf, CASE WHEN page_id % 4 IN (1, 2) THEN 'field' || CAST(page_id % 4 AS VARCHAR) ELSE '' END AS fields,
       CASE WHEN page_id % 4 <> 3 THEN 'key/' || CAST(page_id AS VARCHAR) END AS bibliography_id FROM pages
"""


def venue_resolve_simple(spark: Session, sf: str) -> DataFrame:
    """MT4: the older matcher over page addresses, one row for each different venue."""
    return venues.resolve_venues_simple(table(spark, sf, "pages").select(F.col("url").alias("venue_raw")), _patterns(spark))


def _simple_sql() -> str:
    rows = [("code", c.lower(), c) for c in CODES] + [("alias", a.lower(), c) for c, names in OTHER.items() for a in names]
    values = ", ".join(f"({sql_text(k)}, {sql_text(p)}, {sql_text(c)})" for k, p, c in rows)
    return f"""
WITH p(kind, pattern, conference) AS (VALUES {values}),
v AS (SELECT DISTINCT url AS venue, trim(lower(url)) AS low, {_venue_sql("url")} AS norm FROM pages WHERE url <> ''),
j AS (SELECT venue, conference, pattern, CASE WHEN kind = 'code' AND low = pattern THEN 1 WHEN kind = 'code' AND contains(low, pattern) THEN 2
        WHEN kind = 'alias' AND contains(low, pattern) THEN 3 WHEN kind = 'code' AND contains(norm, pattern) THEN 4 END AS s FROM v, p),
r AS (SELECT venue, conference, row_number() OVER (PARTITION BY venue ORDER BY s, length(pattern) DESC, pattern) AS place FROM j WHERE s IS NOT NULL)
SELECT venue, conference FROM r WHERE place = 1
"""


def conference_dimension(spark: Session, sf: str) -> DataFrame:
    """MT8, MT9, MT18: codes, aliases by priority and match types of a dimension that is built from the pages' addresses, counted."""
    names = table(spark, sf, "pages").select(F.regexp_extract("url", "//([^./]+)[.]", 1).alias("code"), F.regexp_extract("url", "//([^/]+)", 1).alias("alias"), F.regexp_extract("url", "//[^/]+/([^/]+)", 1).alias("phrase"))
    d, a, p = venues.dimension_from(names, ["alias"], ["phrase"])
    kinds = d.select("conference", F.lit("code").alias("kind"))
    kinds = kinds.unionByName(a.select("conference", F.concat(F.lit("alias "), F.col("priority").cast("string")).alias("kind")))
    kinds = kinds.unionByName(p.select("conference", F.concat(F.lit("pattern "), F.col("match_type")).alias("kind")))
    return kinds.groupBy("kind").agg(F.count("*").alias("rows"), F.count_distinct("conference").alias("conferences"))


DIMENSION_SQL = """
WITH n AS (SELECT regexp_extract(url, '//([^./]+)[.]', 1) AS code, regexp_extract(url, '//([^/]+)', 1) AS alias, regexp_extract(url, '//[^/]+/([^/]+)', 1) AS phrase FROM pages),
k AS (SELECT * FROM n WHERE code <> ''),
r AS (SELECT code, 'code' AS kind, code AS value FROM k UNION SELECT code, 'alias 100', code FROM k UNION SELECT code, 'alias 50', alias FROM k WHERE alias <> '' AND lower(alias) <> lower(code)
      UNION SELECT code, 'pattern exact', lower(code) FROM k UNION SELECT code, 'pattern alias', lower(alias) FROM k WHERE alias <> '' AND lower(alias) <> lower(code)
      UNION SELECT code, 'pattern contains', lower(phrase) FROM k WHERE phrase <> '')
SELECT kind, count(*) AS rows, count(DISTINCT code) AS conferences FROM r GROUP BY kind
"""


def kept_anchor_match(spark: Session, sf: str) -> DataFrame:
    """MT6, TX16: part names against the vectors kept of the largest parts' names, read back from their table; a name is asked for once."""
    counts = lambda c: F.transform(linking.letter_counts(F.col(c)), lambda n: n.cast("double"))
    parts = table(spark, sf, "part")
    texts = parts.where("p_size = 50").groupBy(F.col("p_name").alias("text")).agg(F.min("p_partkey").cast("string").alias("conference")).select("conference", "text")
    path, embed = shared_path(spark, "kept-vectors"), lambda t: t.withColumn("vector", counts("text"))
    venues.kept_vectors(spark, path, texts, embed)
    kept = venues.kept_vectors(spark, path, texts, embed)
    anchors_ = kept.select("conference", F.col("conference").cast("bigint").alias("ord"), "vector")
    # vectors of an aggregate: filters on them stay behind it
    names = parts.groupBy("p_name").agg(F.max("p_name").alias("text")).select(F.col("p_name").alias("id"), counts("text").alias("vector"))
    best = venues.cosine_top1(names, anchors_, 0.5).withColumnRenamed("id", "p_name")
    return parts.join(best, "p_name").select(F.col("p_partkey").alias("id"), "conference", F.round("score", 4).alias("score"))


KEPT_SQL = """
WITH v AS (SELECT p_partkey, p_name, p_size, list_transform(string_split('abcdefghijklmnopqrstuvwxyz0123456789 ', ''), lambda c: CAST(length(lower(p_name)) - length(replace(lower(p_name), c, '')) AS DOUBLE)) AS v FROM part),
a AS (SELECT min(p_partkey) AS ord, any_value(v) AS v FROM v WHERE p_size = 50 GROUP BY p_name)
SELECT p_partkey AS id, CAST(ord AS VARCHAR) AS conference, round(s, 4) AS score FROM (
  SELECT p_partkey, ord, list_cosine_similarity(v.v, a.v) AS s, row_number() OVER (PARTITION BY p_partkey ORDER BY round(list_cosine_similarity(v.v, a.v), 12) DESC, ord) AS place FROM v, a)
WHERE place = 1 AND s >= 0.5
"""


# --- partitions, shares, tiers by the library's functions ----------------------------------------

PAPERS_SQL = "(SELECT o_orderkey AS paper_id, CAST(year(o_orderdate) AS INTEGER) AS year, CAST(floor(o_totalprice / 1000) AS BIGINT) AS citations, o_orderpriority AS conference, o_orderstatus AS status, o_custkey AS author_id FROM orders)"


def paper_facts(spark: Session, sf: str) -> DataFrame:
    """Orders as papers."""
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("paper_id"), F.year("o_orderdate").alias("year"), F.floor(F.col("o_totalprice") / 1000).cast("bigint").alias("citations"),
        F.col("o_orderpriority").alias("conference"), F.col("o_orderstatus").alias("status"), F.col("o_custkey").alias("author_id"),
    )


_years: dict[tuple[str, str], str] = {}


def papers_by_year(spark: Session, sf: str) -> str:
    """The path of the papers as a table partitioned by year, in the shared folder: written once for each session and input."""
    key = (spark.sparkContext.applicationId, sf)
    if key not in _years or not tables.exists(spark, f"{_years[key]}/_SUCCESS"):
        _years[key] = shared_path(spark, "papers-by-year")
        rows = paper_facts(spark, sf).withColumn("year_bucket", tables.year_bucket())
        tables.overwrite(tables.dealt(rows, "year_bucket"), _years[key], "year_bucket")
    return _years[key]


def _by_year(spark: Session, sf: str) -> DataFrame:
    return spark.read.parquet(papers_by_year(spark, sf))


def partition_equality(spark: Session, sf: str) -> DataFrame:
    """PQ1: one year of one conference, from one partition."""
    return tables.in_years(_by_year(spark, sf), 1997, 1997).where("conference = '1-URGENT'").select("paper_id", "citations")


def partition_unpruned(spark: Session, sf: str) -> DataFrame:
    """PQ2: a filter that prunes nothing."""
    return _by_year(spark, sf).where("conference = '5-LOW'").select("paper_id", "year")


def partition_range(spark: Session, sf: str) -> DataFrame:
    """PQ3: counts by year from the partitions of four years."""
    return tables.in_years(_by_year(spark, sf), 1996, 1999).groupBy("year").agg(F.count("*").alias("papers"))


def partition_top_years(spark: Session, sf: str) -> DataFrame:
    """PQ4: the ten years with most papers."""
    return _by_year(spark, sf).where("year IS NOT NULL").groupBy("year").agg(F.count("*").alias("papers")).orderBy(F.desc("papers"), F.desc("year")).limit(10)


def partition_listing(spark: Session, sf: str) -> DataFrame:
    """PQ5: partitions with their kind and rows."""
    kind = F.when(F.col("year_bucket").rlike("^[0-9]{4}$"), "year").when(F.col("year_bucket") == "null", "null").otherwise("range")
    return _by_year(spark, sf).groupBy("year_bucket").agg(F.count("*").alias("papers")).select(F.col("year_bucket").cast("string").alias("year_bucket"), kind.alias("kind"), "papers")


def _bucket_sql() -> str:
    cases = " ".join(f"WHEN year < {bound} THEN '{name}'" for bound, name in tables.YEAR_BOUNDS)
    return f"CASE WHEN year IS NULL THEN 'null' {cases} WHEN year < {tables.LAST_YEAR} THEN CAST(year AS VARCHAR) ELSE '{tables.LAST_YEAR}+' END"


def year_shares(spark: Session, sf: str) -> DataFrame:
    """AG18, WN1, SO2: rows of each partition and their share of all, nulls first."""
    return tables.bucket_shares(paper_facts(spark, sf)).orderBy(F.asc_nulls_first("first_year"))


YEAR_SHARES_SQL = f"""
WITH b AS (SELECT {_bucket_sql()} AS bucket, year FROM {PAPERS_SQL}), n AS (SELECT count(*) AS n FROM b)
SELECT bucket, count(*) AS rows, min(year) AS first_year, max(year) AS last_year, round(count(*) * 100.0E0 / any_value(n), 2) AS share_pct FROM b, n GROUP BY bucket
"""


def author_h_index(spark: Session, sf: str) -> DataFrame:
    """AG24: the largest h with h papers of h citations."""
    return authors.h_index(paper_facts(spark, sf), "author_id", "citations")


H_SQL = f"""
SELECT author_id, CAST(coalesce(max(least(place, citations)) FILTER (citations >= place), 0) AS INTEGER) AS h_index FROM (
  SELECT author_id, citations, row_number() OVER (PARTITION BY author_id ORDER BY citations DESC, paper_id) AS place FROM {PAPERS_SQL}) GROUP BY author_id
"""


def tier_of_method(spark: Session, sf: str) -> DataFrame:
    """MT14: the tier of a method and a confidence."""
    p = paper_facts(spark, sf).withColumn("confidence", (F.col("citations") % 100) / F.lit(100.0))
    return p.select("paper_id", F.when(F.col("status") == "O", "Tier3_NoMatch").otherwise(linking.tier_of(F.col("confidence"))).alias("tier"))


TIER_SQL = f"""
SELECT paper_id, CASE WHEN status = 'O' OR citations % 100 < 70 THEN 'Tier3_NoMatch' WHEN citations % 100 >= 85 THEN 'Tier2_Enhanced_High' ELSE 'Tier2_Enhanced_Medium' END AS tier FROM {PAPERS_SQL}
"""


def populated_share(spark: Session, sf: str) -> DataFrame:
    """AG26: the share of columns that are not null."""
    d = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return d.select("doc_id", F.round(linking.populated_share(["lang", "source", "quality", "toxic"]), 6).alias("share"))


POPULATED_SQL = """
SELECT d.doc_id, round((CAST(lang IS NOT NULL AS INTEGER) + CAST(source IS NOT NULL AS INTEGER) + CAST(quality IS NOT NULL AS INTEGER) + CAST(toxic IS NOT NULL AS INTEGER)) / 4.0E0, 6) AS share
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def seeded_sample(spark: Session, sf: str) -> DataFrame:
    """SO6: a sample of 50 customers that a seed decides, the same on every cluster."""
    return incremental.seeded_sample(table(spark, sf, "customer").select("c_custkey", "c_name"), "c_custkey", 50, 7)


SAMPLE_SQL = "SELECT c_custkey, c_name FROM customer ORDER BY md5('7:' || CAST(c_custkey AS VARCHAR)), c_custkey LIMIT 50"


def rule_violations(spark: Session, sf: str) -> DataFrame:
    """V4: rows of the papers that break bounds, required columns or known values, and repeated keys."""
    from stemma.operators import verify

    p = paper_facts(spark, sf)
    found = verify.violations(p, {"year_bounds": F.col("year").between(1993, 1997), "has_conference": F.col("conference").isNotNull(), "known_status": F.col("status").isin("F", "O"), "cited": F.col("citations") > 50})
    doubles = verify.repeated_keys(table(spark, sf, "lineitem"), ["l_orderkey", "l_suppkey"]).agg(F.lit("unique_pairs").alias("rule"), F.count("*").alias("violations"))
    return found.unionByName(doubles)


VIOLATIONS_SQL = f"""
SELECT 'year_bounds' AS rule, count(*) AS violations FROM {PAPERS_SQL} WHERE NOT coalesce(year BETWEEN 1993 AND 1997, false)
UNION ALL SELECT 'has_conference', count(*) FROM {PAPERS_SQL} WHERE conference IS NULL
UNION ALL SELECT 'known_status', count(*) FROM {PAPERS_SQL} WHERE NOT coalesce(status IN ('F', 'O'), false)
UNION ALL SELECT 'cited', count(*) FROM {PAPERS_SQL} WHERE NOT coalesce(citations > 50, false)
UNION ALL SELECT 'unique_pairs', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_suppkey HAVING count(*) > 1)
"""


QUERIES = {
    "title_key": title_keys, "name_normalize": person_names, "initialism_key": initials, "like_pattern": like_patterns, "venue_normalize": venues_normal,
    "venue_short_code": venue_codes, "identifier_parts": identifiers, "venue_resolve": venue_resolve, "venue_mapping_build": venue_mapping,
    "venue_mapping_stats": venue_mapping_stats, "venue_pattern_join": venue_pattern_join, "cosine_top1": cosine_top1, "two_layer_match": two_layer_match,
    "exact_title_link": exact_title_link, "tier_cascade": tier_cascade, "title_set_pairs": title_set_pairs, "completeness_score": completeness_score, "author_match_exact": author_match_exact,
    "author_match_initials": author_match_initials, "authorships": authorships, "match_statistics": match_statistics, "author_profile_by_name": author_profile_by_name,
    "cache_merge": cache_merge, "fetched_merge": fetched_merge, "contains_list_join": contains_list_join, "fill_only_missing": fill_only_missing,
    "final_author_table": final_author_table, "golden_checks": golden_checks, "author_explode": author_explode, "last_author_json": last_author_json,
    "json_props": json_props, "export_pipe_join": export_pipe_join, "essential_export": essential_export, "upsert_latest": upsert_latest, "upsert_sparse": upsert_sparse,
    "insert_ignore": insert_ignore, "partial_overwrite": partial_overwrite, "upsert_counts": upsert_counts, "delete_release": delete_release,
    "dedupe_keep_first": dedupe_keep_first, "papers_needing_enrichment": papers_needing_enrichment, "papers_new_or_updated": papers_new_or_updated,
    "stale_cache_ids": stale_cache_ids, "resume_files": resume_files, "last_success": last_success, "bloom_sizing": bloom_sizing, "bloom_membership": bloom_membership,
    "authorships_two_tiers": authorships_two_tiers, "open_access_fields": open_access_fields, "venue_resolve_simple": venue_resolve_simple, "conference_dimension": conference_dimension, "kept_anchor_match": kept_anchor_match,
    "partition_equality": partition_equality, "partition_unpruned": partition_unpruned, "partition_range": partition_range, "partition_top_years": partition_top_years,
    "partition_listing": partition_listing, "year_distribution_pct": year_shares, "author_h_index": author_h_index, "tier_of_method": tier_of_method,
    "populated_share": populated_share, "seeded_sample": seeded_sample, "rule_violations": rule_violations,
}

ORACLES = {
    "title_key": f"SELECT doc_id, {_title_key_sql('text')} AS title_key FROM documents",
    "name_normalize": PERSON_SQL, "initialism_key": INITIALS_SQL, "like_pattern": LIKE_SQL, "venue_normalize": VENUE_SQL, "venue_short_code": CODES_SQL,
    "identifier_parts": IDENTIFIERS_SQL, "venue_resolve": _venue_resolve_sql(), "venue_mapping_build": _venue_mapping_sql(),
    "venue_mapping_stats": f"SELECT coalesce(conference, 'none') AS conference, count(*) AS venues FROM ({_venue_mapping_sql()}) GROUP BY 1 ORDER BY venues DESC, conference LIMIT 20",
    "venue_pattern_join": PATTERN_SQL, "cosine_top1": COSINE_SQL, "two_layer_match": TWO_SQL, "exact_title_link": EXACT_SQL, "tier_cascade": TIER_SQL_TWIN, "title_set_pairs": SET_PAIRS_SQL, "completeness_score": COMPLETE_SQL,
    "author_match_exact": MATCH1_SQL, "author_match_initials": MATCH3_SQL, "match_statistics": MATCH_STATS_SQL, "author_profile_by_name": PROFILE_NAME_SQL,
    "cache_merge": CACHE_SQL, "fetched_merge": FETCHED_SQL, "contains_list_join": CONTAINS_SQL, "fill_only_missing": FILL_SQL, "final_author_table": FINAL_SQL,
    "golden_checks": _golden_sql(), "author_explode": EXPLODE_SQL, "last_author_json": LAST_SQL, "json_props": JSON_SQL, "export_pipe_join": EXPORT_SQL,
    "essential_export": "SELECT doc_id, lang, source, n_chars FROM documents", "upsert_latest": UPSERT_SQL, "upsert_sparse": SPARSE_SQL, "insert_ignore": IGNORE_SQL,
    "partial_overwrite": OVERWRITE_SQL, "upsert_counts": COUNTS_SQL, "delete_release": "SELECT count(*) FILTER (o_orderstatus = 'F') AS deleted FROM orders",
    "dedupe_keep_first": DEDUPE_SQL, "papers_needing_enrichment": NEEDING_SQL, "papers_new_or_updated": NEW_SQL, "stale_cache_ids": STALE_SQL, "resume_files": RESUME_SQL,
    "last_success": LAST_SUCCESS_SQL, "bloom_sizing": BLOOM_SQL, "bloom_membership": BLOOM_ASKED_SQL,
    "authorships": _authorships_sql(), "authorships_two_tiers": _two_tiers_sql(), "open_access_fields": OPEN_SQL, "venue_resolve_simple": _simple_sql(), "conference_dimension": DIMENSION_SQL, "kept_anchor_match": KEPT_SQL,
    "partition_equality": f"SELECT paper_id, citations FROM {PAPERS_SQL} WHERE year = 1997 AND conference = '1-URGENT'",
    "partition_unpruned": f"SELECT paper_id, year FROM {PAPERS_SQL} WHERE conference = '5-LOW'",
    "partition_range": f"SELECT year, count(*) AS papers FROM {PAPERS_SQL} WHERE year BETWEEN 1996 AND 1999 GROUP BY year",
    "partition_top_years": f"SELECT year, count(*) AS papers FROM {PAPERS_SQL} WHERE year IS NOT NULL GROUP BY year ORDER BY papers DESC, year DESC LIMIT 10",
    "partition_listing": f"SELECT {_bucket_sql()} AS year_bucket, CASE WHEN year IS NULL THEN 'null' WHEN year >= 2001 AND year < {tables.LAST_YEAR} THEN 'year' ELSE 'range' END AS kind, count(*) AS papers FROM {PAPERS_SQL} GROUP BY 1, 2",
    "year_distribution_pct": YEAR_SHARES_SQL, "author_h_index": H_SQL, "tier_of_method": TIER_SQL, "populated_share": POPULATED_SQL, "seeded_sample": SAMPLE_SQL, "rule_violations": VIOLATIONS_SQL,
}
