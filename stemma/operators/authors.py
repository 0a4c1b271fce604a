"""Author matching, authorships, profiles and their merges (MT1, MT2, AG1-AG4, PRJ17)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import StructType

from stemma.functions.similarity import name_scores
from stemma.functions.text import initials_key, person_name


#: Tiers of the matcher, in order, and their places.
TIERS = {"exact": 1, "initials": 3, "similar": 4}


def _pairing(rows: DataFrame, key: Column, name: str) -> DataFrame:
    """``rows(paper_id, side, pos)`` with ``name``: whether the k-th name with a key has a k-th candidate with it.

    This is what greedy one-to-one assignment by equality does.  ``{name}_key`` and ``{name}_k`` are
    equal for both of a pair.  The windows keep the rows' partitioning by paper.
    """
    rows = rows.withColumn(f"{name}_key", key)
    own = Window.partitionBy("paper_id", f"{name}_key", "side").orderBy("pos")
    both = Window.partitionBy("paper_id", f"{name}_key")
    least = F.least(F.sum("side").over(both), F.sum(1 - F.col("side")).over(both))
    rows = rows.withColumn(f"{name}_k", F.row_number().over(own))
    return rows.withColumn(name, F.col(f"{name}_key").isNotNull() & (F.col(f"{name}_k") <= least))


def _keyed(names: DataFrame, candidates: DataFrame, tiers: tuple[str, ...]) -> tuple[DataFrame, dict[str, Column]]:
    """Names and candidates in one table dealt by paper, with what the first two tiers decide; key and number that both of a pair have."""
    id_type, paper_type = (df.schema[c].dataType.simpleString() for df, c in ((candidates, "cand_id"), (names, "paper_id")))
    left = names.select("paper_id", F.col("name_pos").alias("pos"), F.lit(0).alias("side"), F.lit(None).cast(id_type).alias("cand_id"), F.col("name").alias("text"))
    right = candidates.where(F.trim("cand_name") != "").select("paper_id", F.col("cand_pos").alias("pos"), F.lit(1).alias("side"), "cand_id", F.col("cand_name").alias("text"))
    rows = left.unionByName(right).repartition("paper_id").withColumn("norm", person_name(F.col("text")))
    rows = _pairing(rows, F.col("norm"), "exact")
    if "initials" in tiers:
        rows = _pairing(rows, F.when(~F.col("exact"), initials_key(F.col("norm"))), "initials")
    else:
        rows = rows.withColumns({"initials": F.lit(False), "initials_key": F.lit(None).cast("string"), "initials_k": F.lit(None).cast("int")})
    rows = rows.withColumn("tier", F.when(F.col("exact"), "exact").when(F.col("initials"), "initials"))
    pick = {c: F.when(F.col("exact"), F.col(f"exact_{c}")).otherwise(F.col(f"initials_{c}")) for c in ("key", "k")}
    return rows, pick


def _assigned(names: DataFrame, candidates: DataFrame, least: int, tiers: tuple[str, ...]) -> DataFrame:
    """(paper_id, name_pos, name, cand_pos, cand_id, cand_name, tier): every name, with nulls where it has no match; see ``match_authors``."""
    rows, pick = _keyed(names, candidates, tiers)
    # one list for each paper: what the tiers have paired, by pair, and what they have left
    link = F.when(F.col("tier").isNotNull(), F.concat_ws("\x00", "tier", pick["k"].cast("string"), pick["key"]))
    entry = F.struct("pos", "norm", "cand_id", "text", "tier", link.alias("link"))
    listed = lambda side: F.array_sort(F.collect_list(F.when(F.col("side") == side, entry)))
    papers = rows.groupBy("paper_id").agg(listed(0).alias("names"), listed(1).alias("cands")).where("size(names) > 0")
    partner = F.map_from_entries(F.transform(F.filter("cands", lambda c: c["link"].isNotNull()), lambda c: F.struct(c["link"], c)))
    papers = papers.select("paper_id", "names", F.filter("cands", lambda c: c["link"].isNull()).alias("free"), partner.alias("partner"))
    papers = papers.withColumn("asking", F.filter("names", lambda n: n["link"].isNull()))

    def unmatched(df: DataFrame) -> DataFrame:
        return df.withColumn("picks", F.transform("asking", lambda n: F.lit(-1)))

    if "similar" in tiers:
        # papers without a name or a candidate left do not visit Python
        kind = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in papers.schema)
        todo = (F.size("asking") > 0) & (F.size("free") > 0)
        papers = unmatched(papers.where(~todo)).unionByName(papers.where(todo).mapInArrow(lambda batches: _greedy(batches, least), f"{kind}, picks array<int>"))
    else:
        papers = unmatched(papers)
    paired = F.transform(F.filter("names", lambda n: n["link"].isNotNull()), lambda n: F.struct(n["pos"].alias("name_pos"), n["text"].alias("name"), F.col("partner")[n["link"]].alias("c"), n["tier"].alias("tier")))

    def chosen(n: Column, k: Column) -> Column:
        at = F.get("picks", k)
        return F.struct(n["pos"].alias("name_pos"), n["text"].alias("name"), F.when(at >= 0, F.get("free", at)).alias("c"), F.when(at >= 0, "similar").alias("tier"))

    out = papers.select("paper_id", F.explode(F.concat(paired, F.transform("asking", chosen))).alias("m"))
    return out.select(
        "paper_id", "m.name_pos", "m.name", F.col("m.c.pos").alias("cand_pos"), F.col("m.c.cand_id").alias("cand_id"), F.col("m.c.text").alias("cand_name"), "m.tier"
    )


def _greedy(batches: Iterator[pa.RecordBatch], least: int) -> Iterator[pa.RecordBatch]:
    """Batches with ``picks``: for each name left, in order, the place of the free candidate most like it over ``least``, or -1.

    All different pairs of a batch are scored together; the assignment only looks scores up.
    """
    for batch in batches:
        asking, free = (batch.column(c) for c in ("asking", "free"))
        texts = pa.concat_arrays([c.flatten().field("norm") for c in (asking, free)]).dictionary_encode()
        codes = texts.indices.fill_null(-1).to_numpy()
        names, cands = np.split(codes, [len(asking.flatten())])
        n_sizes, c_sizes = (pc.list_value_length(c).to_numpy() for c in (asking, free))
        n_ends, c_ends = np.cumsum(n_sizes), np.cumsum(c_sizes)
        # every name left of a paper with every candidate left of it
        paper = np.repeat(np.arange(len(batch)), n_sizes)
        reps = c_sizes[paper]
        a = np.repeat(names, reps)
        first = np.cumsum(reps) - reps
        b = cands[np.repeat((c_ends - c_sizes)[paper], reps) + np.arange(len(a)) - np.repeat(first, reps)]
        different, back = np.unique(a * (len(texts.dictionary) + 1) + b, return_inverse=True)
        words = [*texts.dictionary.to_pylist(), None]
        x, y = different // (len(texts.dictionary) + 1), different % (len(texts.dictionary) + 1)
        scores = name_scores([words[i] for i in x.tolist()], [words[i] for i in y.tolist()], least)[back]
        picks: list[list[int]] = []
        for p in range(len(batch)):
            at, width = n_ends[p] - n_sizes[p], c_sizes[p]
            own = scores[first[at] : first[at] + n_sizes[p] * width].reshape(n_sizes[p], width).copy() if n_sizes[p] else np.zeros((0, 0))
            got = []
            for row in own:
                k = int(row.argmax())  # the first of the best
                got.append(k if row[k] > least else -1)
                if row[k] > least:
                    own[:, k] = -1
            picks.append(got)
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(picks, pa.list_(pa.int32()))], names=[*batch.schema.names, "picks"])


def match_authors(names: DataFrame, candidates: DataFrame, least: int = 85, tiers: tuple[str, ...] = tuple(TIERS)) -> DataFrame:
    """(paper_id, name_pos, name, cand_pos, cand_id, cand_name, tier): one-to-one matches in each paper.

    ``names(paper_id, name_pos, name)`` and ``candidates(paper_id, cand_pos, cand_id, cand_name)``.
    Tiers: equal normalised names, equal initials with equal last token, best similarity over
    ``least``; within a tier by position.  Names and candidates go in one table that is dealt by paper
    once; the first two tiers are windows over it, and what they leave, in papers that have both names
    and candidates left, goes to the sequential third in Arrow batches, if ``tiers`` has it.  A paper's names
    and candidates are one list each, so nothing is joined afterwards.  Candidates
    with blank names are dropped.  (A tier for repeated names by position can never find anything
    after the first, and has no plan here.)
    """
    if "similar" in tiers:
        return _assigned(names, candidates, least, tiers).where("tier IS NOT NULL")
    # both of a pair are one group where they lie, without lists; columns that are not asked for fall away
    rows, pick = _keyed(names, candidates, tiers)
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    pairs = rows.where("tier IS NOT NULL").groupBy("paper_id", "tier", pick["key"].alias("_key"), pick["k"].alias("_k"))
    found = pairs.agg(of(0, "pos").alias("name_pos"), of(0, "text").alias("name"), of(1, "pos").alias("cand_pos"), of(1, "cand_id").alias("cand_id"), of(1, "text").alias("cand_name"))
    return found.select("paper_id", "name_pos", "name", "cand_pos", "cand_id", "cand_name", "tier")


def build_authorships(names: DataFrame, candidates: DataFrame, tiers: tuple[str, ...] = tuple(TIERS)) -> DataFrame:
    """One row for each different name of a paper: its match, or unmatched; order: matches by tier, then the rest.

    Two equal names on a paper are one row and the later pair's match wins.
    """
    place = F.create_map(*[F.lit(x) for pair in TIERS.items() for x in pair])[F.col("tier")]
    all_names = _assigned(names, candidates, 85, tiers).withColumn("t", place)
    key = F.struct(F.coalesce("t", F.lit(0)), "name_pos")
    one = all_names.groupBy("paper_id", "name").agg(
        F.max(F.struct(key.alias("k"), "cand_id", "cand_name", "tier")).alias("m"),
        F.min(F.when(F.col("t").isNotNull(), F.struct("t", "name_pos"))).alias("at"),
        F.min("name_pos").alias("name_pos"),
    )
    order = Window.partitionBy("paper_id").orderBy(F.col("at").isNull(), "at", "name_pos")
    matched = F.col("m.tier").isNotNull()
    return one.select(
        "paper_id",
        F.col("name").alias("author_name"),
        F.coalesce("m.cand_name", F.lit("")).alias("matched_name"),
        F.coalesce("m.cand_id", F.lit("")).alias("matched_id"),
        F.row_number().over(order).alias("match_order"),
        (F.col("name_pos") + 1).alias("byline_position"),
        F.when(matched, "matched").otherwise("unmatched").alias("match_confidence"),
        F.when(matched, "multi_tier_matching").otherwise("no_match_found").alias("match_method"),
    )


def joined_in_order(rows: DataFrame, by: str, value: str, order: str, name: str) -> DataFrame:
    """(by, name): the distinct values that are not empty, in the order first seen, with commas; null without any.

    Values are made distinct first, so a list is as long as there are values, not rows.
    """
    first = first_seen(rows.where(F.col(value) != ""), [by, value], order).groupBy(by, value).agg(F.min("_o").alias("_o"))
    listed = F.array_sort(F.collect_list(F.struct("_o", value)))
    return first.groupBy(by).agg(F.array_join(F.transform(listed, lambda x: x[value]), ",").alias(name))


def first_seen(rows: DataFrame, by: list[str], order: str, sums: dict[str, Column] | None = None) -> DataFrame:
    """(by, _o, sums): the smallest ``order`` of the rows that agree in ``by`` and in all fields of a struct ``order`` but the first.

    The minimum of a struct takes a sort of all rows, that of its first field does not; so what is left
    for the minimum of the whole is a few rows of each group, unless the other fields differ everywhere.
    """
    sums = sums or {}
    made = [c.alias(k) for k, c in sums.items()]
    kind = rows.schema[order].dataType
    if not isinstance(kind, StructType):
        return rows.groupBy(*by).agg(F.min(order).alias("_o"), *made)
    first, *rest = kind.names
    missing = F.when(F.col(order).isNull(), 2).when(F.col(order)[first].isNull(), 1).otherwise(0)  # null comes first, no order at all does not count
    found = rows.groupBy(*by, missing.alias("_missing"), *[F.col(order)[c].alias(f"_o{i}") for i, c in enumerate(rest)]).agg(F.min(F.col(order)[first]).alias("_least"), *made)
    least = F.struct(F.col("_least").alias(first), *[F.col(f"_o{i}").alias(c) for i, c in enumerate(rest)])
    return found.select(*by, F.when(F.col("_missing") < 2, least).alias("_o"), *sums)


def rows_for_profiles(authorships: DataFrame, papers: DataFrame) -> DataFrame:
    """Authorships with a matched id joined to their papers, rows for ``author_profiles``; unlinked papers give nulls (JN1).

    ``authorships(paper_id, author_name, matched_id, match_order, ...)``, ``papers(paper_id, influential,
    year, first_id, last_id)``; a missing ``matched_name`` is null.
    """
    name = F.col("matched_name") if "matched_name" in authorships.columns else F.lit(None).cast("string")
    found = authorships.withColumn("matched_name", name).where("matched_id <> ''").join(papers, "paper_id", "left")
    return found.select(
        "author_name", F.struct("paper_id", "match_order").alias("ord"), F.col("matched_id").alias("author_id"), "matched_name", "influential", "year", "first_id", "last_id"
    )


def author_profiles(rows: DataFrame, as_of_year: int) -> DataFrame:
    """Profiles by ``author_name`` from (author_name, ord, author_id, matched_name, influential, year, first_id, last_id).

    ``ord`` is the reading order.  A null name has no profile.  See ``stemma.plans.profiles`` for the
    meaning of the counts.
    """
    most = F.lit(2147483647)
    sums = {
        "n": F.count("*"),
        "cites": F.sum("influential"),
        "first_year": F.min("year"),
        "latest_year": F.max("year"),
        "first_author_count": F.count_if(F.col("author_id") == F.col("first_id")),
        "last_author_count": F.count_if(F.col("author_id") == F.col("last_id")),
        "recent": F.count_if(F.col("year") >= as_of_year - 3),
    }
    rows = rows.where(F.col("author_name").isNotNull())
    few = first_seen(rows, ["author_name", "author_id", "matched_name"], "ord", sums)
    # each stands once for its id, with the counts, and once for its name
    once = F.struct(F.lit(True).alias("is_id"), F.col("author_id").alias("value"), *[F.col(c) for c in sums])
    again = F.struct(F.lit(False).alias("is_id"), F.col("matched_name").alias("value"), *[F.lit(None).alias(c) for c in sums])
    each = few.select("author_name", "_o", F.inline(F.array(once, again)))
    total = {c: {"first_year": F.min, "latest_year": F.max}.get(c, F.sum)(c).alias(c) for c in sums}
    values = each.groupBy("author_name", "is_id", "value").agg(F.min("_o").alias("_o"), *total.values())

    def listed(is_id: bool) -> Column:
        some = F.collect_list(F.when((F.col("is_id") == is_id) & (F.col("value") != ""), F.struct("_o", "value")))
        return F.nullif(F.array_join(F.transform(F.array_sort(some), lambda x: x["value"]), ","), F.lit(""))

    out = values.groupBy("author_name").agg(listed(True).alias("author_ids"), listed(False).alias("matched_names"), *total.values())
    out = out.withColumns({"cites": F.coalesce("cites", F.lit(0)).cast("bigint"), **{c: F.col(c).cast("int") for c in ("first_author_count", "last_author_count", "recent")}})
    n, first, last = F.col("n").cast("double"), F.col("first_author_count"), F.col("last_author_count")
    career = F.when(F.col("first_year") != 0, F.lit(as_of_year) - F.col("first_year") + 1)
    has_id = F.col("author_ids").isNotNull()
    whole = [has_id, F.col("n") > 0, F.col("cites") > 0, F.coalesce(career, F.lit(0)) > 0]
    return out.select(
        "author_name",
        "author_ids",
        "matched_names",
        F.least("n", most).cast("int").alias("paper_count"),
        F.least("cites", most).cast("int").alias("total_citations"),
        (F.col("cites") / n).alias("avg_citations_per_paper"),
        F.when(F.col("first_year") != 0, F.col("first_year")).alias("first_publication_year"),
        F.when(F.col("latest_year") != 0, F.col("latest_year")).alias("latest_publication_year"),
        F.when(career != 0, career).cast("int").alias("career_length"),
        "first_author_count",
        "last_author_count",
        (F.col("n") - first - last).cast("int").alias("middle_author_count"),
        (first / n).alias("first_author_ratio"),
        (last / n).alias("last_author_ratio"),
        (first / n * 0.4 + last / n * 0.6).alias("contribution_score"),
        (F.col("recent") / n).alias("rising_star_score"),
        F.when(has_id, "high").otherwise("low").alias("match_confidence"),
        (sum(c.cast("int") for c in whole) / F.lit(4.0)).alias("data_completeness_score"),
    )


def merge_cached(rows: DataFrame) -> DataFrame:
    """By ``author_name`` from (author_name, updated_at, url, affiliations, paper_count, citation_count, h_index).

    Homepage: the first filled one by recency.  Affiliations: the sorted union.  Sums and the maximum;
    zero is null (AG2).
    """
    none = lambda c: F.nullif(c, F.lit(0))
    filled = F.when(F.col("url") != "", F.col("url"))
    counts = rows.groupBy("author_name").agg(
        F.max_by(filled, F.when(filled.isNotNull(), F.col("updated_at"))).alias("homepage"),
        none(F.sum("paper_count")).alias("paper_count"),
        none(F.sum("citation_count")).alias("citation_count"),
        none(F.max("h_index")).alias("h_index"),
    )
    each = rows.select("author_name", F.explode("affiliations").alias("_a")).where("_a <> ''").distinct()
    union = each.groupBy(F.col("author_name").alias("_n")).agg(F.array_join(F.array_sort(F.collect_list("_a")), ",").alias("affiliations"))
    joined = counts.join(union, F.col("author_name").eqNullSafe(F.col("_n")), "left")
    return joined.select("author_name", "homepage", "affiliations", "paper_count", "citation_count", "h_index")


def merge_fetched(rows: DataFrame) -> DataFrame:
    """The same merge for fetched records in the order ``ord``: distinct homepages and affiliations joined (AG3).

    Values are made distinct before they are collected.  A null name has no record.
    """
    rows = rows.where(F.col("author_name").isNotNull())
    pages = rows.withColumn("_u", F.trim("url"))
    each = rows.select("author_name", "ord", F.posexplode("affiliations").alias("_i", "_x")).select("author_name", F.struct("ord", "_i").alias("_at"), F.trim("_x").alias("_x"))
    out = rows.groupBy("author_name").agg(
        F.sum("paper_count").alias("remote_paper_count"), F.sum("citation_count").alias("remote_citation_count"), F.max("h_index").alias("remote_h_index")
    )
    out = out.join(joined_in_order(pages, "author_name", "_u", "ord", "homepage"), "author_name", "left")
    out = out.join(joined_in_order(each, "author_name", "_x", "_at", "remote_affiliations"), "author_name", "left")
    return out.select("author_name", "homepage", "remote_affiliations", "remote_paper_count", "remote_citation_count", "remote_h_index")


def split_ids(profiles: DataFrame, ids: str = "author_ids") -> DataFrame:
    """One row for each id of a comma-separated list (JN8, NS7)."""
    parts = F.filter(F.transform(F.split(ids, ","), lambda x: F.trim(x)), lambda x: x != "")
    return profiles.withColumn("author_id", F.explode(parts))


def fill_missing(target: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """``target`` with nulls of ``columns`` filled from ``source``; ``was_filled`` tells where (AG4)."""
    fresh = source.select(key, *[F.col(c).alias(f"_{c}") for c in columns])
    filled = F.lit(False)
    for c in columns:
        filled = filled | (F.col(c).isNull() & F.col(f"_{c}").isNotNull())
    joined = target.join(fresh, key, "left")
    return joined.select(*[F.coalesce(c, f"_{c}").alias(c) if c in columns else F.col(c) for c in target.columns], filled.alias("was_filled"))


def final_table(profiles: DataFrame, cached: DataFrame) -> DataFrame:
    """The published layout: profile counts and cached metrics; text null as '', counts null as 0 (PRJ17).

    ``cached(author_name, homepage, affiliations, paper_count, citation_count, h_index)``.
    """
    c = cached.select("author_name", *[F.col(x).alias(f"_{x}") for x in ("homepage", "affiliations", "paper_count", "citation_count", "h_index")])
    text = lambda x: F.coalesce(F.col(x), F.lit(""))
    number = lambda x: F.coalesce(F.col(x), F.lit(0)).cast("int")
    return profiles.join(c, "author_name", "left").select(
        F.col("author_name").alias("byline_name"),
        F.lit("").alias("note"),
        F.lit("").alias("google_scholarid"),
        text("author_name").alias("external_ids_bibliography"),
        text("_affiliations").alias("remote_affiliations"),
        F.lit("").alias("ranked_affiliation"),
        F.lit(0).alias("top_paper_total_paper_captured"),
        F.lit(0).alias("top_paper_last_author_count"),
        number("first_author_count").alias("first_author_count"),
        number("_paper_count").alias("remote_paper_count"),
        number("career_length").alias("career_length"),
        F.lit(None).cast("int").alias("last_author_percentage"),
        number("total_citations").alias("total_influential_citations"),
        number("_citation_count").alias("remote_citation_count"),
        number("_h_index").alias("remote_h_index"),
        text("author_name").alias("name"),
        text("author_name").alias("name_snapshot"),
        text("_affiliations").alias("affiliations_snapshot"),
        text("_homepage").alias("homepage"),
        text("author_ids").alias("remote_author_id"),
    )


def h_index(papers: DataFrame, author: str, citations: str) -> DataFrame:
    """Largest h with h papers of at least h citations (AG24).

    Papers are counted by author and citations with map-side combine, so that what is sorted for an
    author are different numbers of citations, not papers; null citations count as none.
    """
    cited = F.greatest(F.coalesce(F.col(citations), F.lit(0)), F.lit(0)).cast("bigint")
    bins = papers.groupBy(author, cited.alias("_c")).agg(F.count("*").alias("_n"))
    down = F.sort_array(F.collect_list(F.struct("_c", "_n")), asc=False)
    start = F.struct(F.lit(0).cast("bigint").alias("papers"), F.lit(0).cast("bigint").alias("h"))

    def add(held: Column, bin: Column) -> Column:
        papers = held["papers"] + bin["_n"]
        return F.struct(papers.alias("papers"), F.greatest(held["h"], F.least(papers, bin["_c"])).alias("h"))

    return bins.groupBy(author).agg(F.aggregate(down, start, add, lambda held: held["h"]).cast("int").alias("h_index"))


#: What an author lacks when it is to be enriched.
WANTED = ["homepage", "remote_affiliations", "remote_paper_count", "remote_citation_count", "remote_h_index"]


def enrich_authors(profiles: DataFrame, fetched: DataFrame) -> DataFrame:
    """One row for each author with ids and a null among ``WANTED``: the merged records and counters (LK5).

    ``profiles(author_name, author_ids, WANTED)`` has comma-separated ids; ``fetched(author_id, url,
    affiliations, paper_count, citation_count, h_index)`` is what a remote lookup would return, one row
    for each id.  Records are merged in the order of the ids; an author none of whose ids is found is
    not updated.  Repeated ids count once each as asked.
    """
    lacking = F.greatest(*[F.col(c).isNull() for c in WANTED])
    ids = F.filter(F.transform(F.split("author_ids", ","), lambda x: F.trim(x)), lambda x: x != "")
    asked = profiles.where(lacking & (F.size(ids) > 0)).select("author_name", F.posexplode(ids).alias("ord", "author_id"))
    found = asked.join(fetched, "author_id", "left")
    counts = found.withColumn("_hit", F.col("paper_count").isNotNull() | F.col("url").isNotNull() | F.col("affiliations").isNotNull())
    counts = counts.groupBy("author_name").agg(F.count("*").alias("ids_asked"), F.count_if("_hit").alias("ids_found"))
    merged = merge_fetched(asked.join(fetched, "author_id"))
    return counts.join(merged, "author_name", "left").select("author_name", *WANTED, "ids_asked", "ids_found", (F.col("ids_found") > 0).alias("was_updated"))


def enrichment_totals(enriched: DataFrame) -> DataFrame:
    """One row of sums: authors, updated authors, ids asked and found (LK5)."""
    return enriched.agg(
        F.count("*").alias("authors"), F.count_if("was_updated").alias("updated"), F.coalesce(F.sum("ids_asked"), F.lit(0)).alias("ids_asked"), F.coalesce(F.sum("ids_found"), F.lit(0)).alias("ids_found")
    )
