import random

from pyspark.sql import functions as F

from stemma.functions.similarity import name_score
from stemma.operators import authors, bloom, incremental, linking, venues, verify


def names_df(spark, papers):
    return spark.createDataFrame([(p, i, n) for p, ns in papers.items() for i, n in enumerate(ns)], "paper_id bigint, name_pos int, name string")


def cands_df(spark, papers):
    return spark.createDataFrame([(p, i, k, n) for p, cs in papers.items() for i, (k, n) in enumerate(cs)], "paper_id bigint, cand_pos int, cand_id string, cand_name string")


BYLINES = {
    1: (["Zhiyuan Liu 0001", "Zhiyuan Liu 0010"], [("1", "Zhiyuan Liu"), ("2", "Zhiyuan Liu")]),
    2: (["John A. Smith"], [("7", "J. A. Smith")]),
    3: (["Wei Zhang"], []),
    4: (["Ann Lee", "Bob Ray"], [("5", "Bob Ray")]),
    5: (["Bo Li", "Bo Li"], [("3", "Bo Li"), ("4", "Bo Li")]),
    6: (["A B"], [("9", "  ")]),
}


def test_authorships_of_hand_made_bylines(spark):
    got = authors.build_authorships(names_df(spark, {k: v[0] for k, v in BYLINES.items()}), cands_df(spark, {k: v[1] for k, v in BYLINES.items()})).collect()
    rows = {(r.paper_id, r.author_name): (r.matched_id, r.match_order, r.match_confidence) for r in got}
    assert rows == {
        (1, "Zhiyuan Liu 0001"): ("1", 1, "matched"), (1, "Zhiyuan Liu 0010"): ("2", 2, "matched"), (2, "John A. Smith"): ("7", 1, "matched"),
        (3, "Wei Zhang"): ("", 1, "unmatched"), (4, "Bob Ray"): ("5", 1, "matched"), (4, "Ann Lee"): ("", 2, "unmatched"),
        (5, "Bo Li"): ("4", 1, "matched"), (6, "A B"): ("", 1, "unmatched"),
    }


def greedy(ns, cs):
    """One pass for each tier over names and free candidates, in order."""
    out, free, left = {}, list(range(len(cs))), list(range(len(ns)))
    key = lambda t: (lambda w: "".join(x[0] for x in w[:-1]) + " " + w[-1] if len(w) > 1 else None)(t.split())
    for tier, same in (("exact", lambda a, b: a == b), ("initials", lambda a, b: key(a) is not None and key(a) == key(b))):
        for i in list(left):
            for j in free:
                if same(ns[i], cs[j]):
                    out[i] = (j, tier)
                    free.remove(j)
                    left.remove(i)
                    break
    for i in left:
        best, place = 85, None
        for j in free:
            if (s := name_score(ns[i], cs[j])) > best:
                best, place = s, j
        if place is not None:
            out[i] = (place, "similar")
            free.remove(place)
    return out


def test_matching_equals_greedy_assignment(spark):
    rng = random.Random(7)
    first, last = ["ann", "a", "bo", "anne", "b c"], ["li", "lee", "liu"]
    make = lambda: f"{rng.choice(first)} {rng.choice(last)}"
    papers = {p: ([make() for _ in range(rng.randint(1, 5))], [(str(i), make()) for i in range(rng.randint(0, 5))]) for p in range(150)}
    got = authors.match_authors(names_df(spark, {k: v[0] for k, v in papers.items()}), cands_df(spark, {k: v[1] for k, v in papers.items()})).collect()
    found = {}
    for r in got:
        found.setdefault(r.paper_id, {})[r.name_pos] = (r.cand_pos, r.tier)
    for p, (ns, cs) in papers.items():
        assert found.get(p, {}) == greedy(ns, [c[1] for c in cs]), (ns, cs)


def test_profile_of_hand_made_rows(spark):
    rows = [("x", 1, "a1", "Ann L", 4, 2019, "a1", "a1"), ("x", 2, "a1", "Ann L", None, 2023, "zz", "a1"), ("x", 3, "a2", "A. L", 2, 2024, "a2", "yy"), ("x", 4, "a1", "Ann L", 0, None, None, None), (None, 5, "q", "q", 1, 2020, "q", "q")]
    df = spark.createDataFrame(rows, "author_name string, ord int, author_id string, matched_name string, influential int, year int, first_id string, last_id string")
    (r,) = authors.author_profiles(df, 2025).collect()
    assert (r.paper_count, r.total_citations, r.avg_citations_per_paper) == (4, 6, 1.5)
    assert (r.first_publication_year, r.latest_publication_year, r.career_length) == (2019, 2024, 7)
    assert (r.first_author_count, r.last_author_count, r.middle_author_count) == (2, 2, 0)
    assert (r.first_author_ratio, r.last_author_ratio, r.contribution_score, r.rising_star_score) == (0.5, 0.5, 0.5, 0.5)
    assert (r.author_ids, r.matched_names, r.match_confidence, r.data_completeness_score) == ("a1,a2", "Ann L,A. L", "high", 1.0)


def test_first_seen_is_the_smallest_order(spark):
    rng = random.Random(3)
    some = lambda *v: rng.choice([None, *v])
    rows = [(rng.choice("xy"), some(1, 2, 3), some(1, 2), rng.randint(0, 2) > 0) for _ in range(60)] + [("z", 1, 1, False)]
    df = spark.createDataFrame(rows, "k string, a int, b int, there boolean").withColumn("ord", F.when(F.col("there"), F.struct("a", "b")))
    want = {r.k: (r.o, r.n) for r in df.groupBy("k").agg(F.min("ord").alias("o"), F.count("*").alias("n")).collect()}
    few = authors.first_seen(df, ["k"], "ord", {"n": F.count("*")})
    assert few.groupBy("k", "_o").count().where("count > 1").isEmpty()
    assert {r.k: (r.o, r.n) for r in few.groupBy("k").agg(F.min("_o").alias("o"), F.sum("n").alias("n")).collect()} == want


def test_profiles_read_their_rows_once_and_sort_no_rows_for_them(spark):
    from stemma.plans import composed

    for query in (composed.author_profile_by_name, composed.contains_list_join):
        plan = query(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("lineitem.parquet") == 1
        assert plan.count("SortAggregate") <= 2  # those of the few rows of each value


def test_keys_of_exact_links_are_made_once(spark, tmp_path):
    from stemma.plans import composed

    rows = [(1, "On a: Tree", "en"), (2, "tree", "de"), (3, None, "en"), (4, "", "en"), (5, ":", "en"), (6, "a：b:tree", "en"), (7, "tree", None), (8, "tree", "abc"), (9, "x:：", "en")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    links = composed.exact_title_link(spark, str(tmp_path))
    assert sorted(map(tuple, links.collect())) == [(1, 1), (2, 1), (6, 1), (8, 8)]
    made = links._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert made.count("FileScan parquet") == 1 and made.count("sha2(") == 1


def test_merge_of_cached_records(spark):
    rows = [("x", "2025-01-02", None, ["X"], 3, 0, 1), ("x", "2025-01-01", "u2", ["Y", "X"], 2, None, 4)]
    df = spark.createDataFrame(rows, "author_name string, updated_at string, url string, affiliations array<string>, paper_count int, citation_count int, h_index int")
    (r,) = authors.merge_cached(df).collect()
    assert tuple(r) == ("x", "u2", "X,Y", 5, None, 4)


VENUES = [
    ("acl", "ACL", 2), ("Annual Meeting of the Association for Computational Linguistics", "ACL", 3), ("Advances in NIPS 31", "NeurIPS", 3), ("EC 2024", "EC", 4),
    ("ACM Conference on EC", "EC", 4), ("Technology Review", None, None), ("ec workshop", "EC", 4), ("my chi notes", None, None), ("SIGMOD Record", "SIGMOD", 4), ("EC'23", "EC", 4), ("EC-2024", "EC", 4),
]


def test_venues(spark):
    codes = ["ACL", "EC", "CHI", "NeurIPS", "SIGMOD"]
    aliases = {"NeurIPS": ["NIPS"], "ACL": ["Annual Meeting of the Association for Computational Linguistics"]}
    df = spark.createDataFrame([(v,) for v, _, _ in VENUES] + [(None,), ("",)], "venue_raw string")
    patterns = venues.matcher_patterns(venues.conferences(spark, codes), venues.conference_aliases(spark, codes, aliases))
    got = {r.venue: (r.conference, r.strategy) for r in venues.resolve_venues(df, patterns).collect()}
    assert got == {v: (c, s) for v, c, s in VENUES if c}
    full = venues.matcher_patterns(venues.conferences(spark, codes, {"CHI": "Conference on Human Factors in Computing Systems"}), venues.conference_aliases(spark, codes, aliases))
    one = spark.createDataFrame([("Proc. Conference on Human Factors in Computing Systems (Extended)",)], "venue_raw string")
    assert [(r.conference, r.strategy) for r in venues.resolve_venues(one, full).collect()] == [("CHI", 1)]
    assert {r.venue: r.conference for r in venues.resolve_venues_simple(df, patterns).collect()}["acl"] == "ACL"
    assert venues.conference_patterns(spark).where("match_type = 'exact'").count() == len(venues.CONFERENCES)


def test_links(spark):
    papers = [(1, 2020, "Attention Is All You Need"), (2, 2020, "Neural Parsing Methods Today"), (3, 2020, "Graph Networks"), (4, 2021, "Unlike anything")]
    data = [(10, 2020, "attention is all you need"), (11, 2020, "Neural Parsing Methods Today and More"), (12, 2020, "Bayesian Trees"), (13, 2020, "Neural parsing: methods of today again and again")]
    p = spark.createDataFrame(papers, "paper_id bigint, year int, title string")
    d = spark.createDataFrame(data, "corpus_id bigint, year int, title string")
    provider = spark.createDataFrame([(4, 99, "Unlike anything!")], "paper_id bigint, corpus_id bigint, title string")
    got = {r.paper_id: (r.corpus_id, r.match_method, r.validation_tier) for r in linking.link_cascade(p, d, provider).collect()}
    assert got[1] == (10, "Dataset Match", "Tier1_Dataset_High")
    assert got[2] == (11, "Dataset Match", "Tier1_Dataset_High")
    assert got[3] == (None, "No Match", "Tier3_NoMatch")
    assert got[4] == (99, "Title Match", "Tier2_Enhanced_High")


def test_parsed_response(spark):
    kind = "paperId string, title string, year int, citationCount int, authors array<struct<authorId:string,name:string>>, externalIds map<string,string>, fieldsOfStudy array<string>, openAccessPdf struct<url:string,status:string,license:string>, citationStyles struct<bibtex:string>"
    row = ("p", "t", 2020, 3, [("1", "A"), (None, "B")], {"DOI": "d", "DBLP": "b"}, ["CS"], ("u", "s", None), ("bib",))
    r = linking.parse_response(spark.createDataFrame([row, ("q",) + (None,) * 8], kind)).collect()[0]
    assert (r.all_author_names, r.all_author_ids, r.first_author_remote_id, r.all_authors_count) == ("A;B", "1", "1", 2)
    assert (r.doi, r.bibliography_id, r.arxiv_id, r.field_primary, r.field_secondary, r.pdf_available) == ("d", "b", None, "CS", None, "TRUE")


def test_bloom(spark):
    sizes = spark.createDataFrame([(5_000_000,), (1000,)], "n bigint").select(*[c.alias(k) for k, c in bloom.sizing(F.col("n"), F.lit(0.01)).items()]).collect()
    assert [tuple(r) for r in sizes] == [(47_925_291, 7, 5_990_662), (9_585, 7, 1_199)]
    items = spark.range(1000).select(F.col("id").cast("string").alias("x"))
    filter_ = bloom.build(items, "x", 9585, 7)
    assert bloom.might_contain(items, "x", filter_, 9585, 7).count() == 1000
    other = spark.range(10_000, 14_000).select(F.col("id").cast("string").alias("x"))
    assert bloom.might_contain(other, "x", filter_, 9585, 7).count() < 120


def test_upserts_are_idempotent(spark):
    old = spark.createDataFrame([(1, "a", "t1"), (2, "b", "t1")], "k int, v string, made string")
    new = spark.createDataFrame([(2, None, "t2"), (3, "c", "t2")], "k int, v string, made string")
    once = incremental.upsert(old, new, ["k"], created="made")
    assert sorted(map(tuple, once.collect())) == [(1, "a", "t1"), (2, None, "t1"), (3, "c", "t2")]
    assert sorted(map(tuple, incremental.upsert(once, new, ["k"], created="made").collect())) == sorted(map(tuple, once.collect()))
    assert sorted(map(tuple, incremental.upsert_filled(old, new, ["k"]).collect())) == [(1, "a", "t1"), (2, "b", "t2"), (3, "c", "t2")]
    assert tuple(incremental.upsert_counts(old, new, ["k"]).first()) == (1, 1)
    assert sorted(r.k for r in incremental.insert_ignore(old, new, ["k"], ["v"]).collect()) == [1, 2, 3]


def test_comparing_published_values(spark):
    df = spark.createDataFrame([("a", None, 0), ("b", 1, 1), ("c", 2, 3)], "k string, x int, y int")
    got = {r.k: r.passed for r in verify.compare(df.select("k", F.col("x").alias("f")), df.select("k", F.col("y").alias("f")), "k", ["f"]).collect()}
    assert got == {"a": True, "b": True, "c": False}
    rules = {"x is there": F.col("x").isNotNull(), "y below 3": F.col("y") < 3}
    assert {tuple(r) for r in verify.violations(df, rules).collect()} == {("x is there", 1), ("y below 3", 1)}


def test_every_paper_has_its_authorships(spark, tmp_path):
    from stemma.plans import composed

    lines = [(k, k % 5 + s, s) for k in range(1, 9) for s in (1, 2)]
    spark.createDataFrame(lines, "l_orderkey bigint, l_suppkey bigint, l_linenumber int").write.parquet(f"{tmp_path}/lineitem.parquet")
    assert {r.paper_id for r in composed.authorships(spark, str(tmp_path)).collect()} == set(range(1, 9))


def test_names_that_differ_after_character_60_are_no_exact_titles(spark, tmp_path):
    from stemma.plans import composed

    same = "alpha " * 12
    rows = [(1, 7, same + "left"), (2, 7, same + "right"), (3, 7, same + "left"), (4, 7, same + "left")]
    spark.createDataFrame(rows, "p_partkey bigint, p_size int, p_name string").write.parquet(f"{tmp_path}/part.parquet")
    got = {r.paper_id: (r.corpus_id, float(r.match_confidence)) for r in composed.tier_cascade(spark, str(tmp_path)).collect()}
    assert got[4] == (1, 1.0) and got[2][1] < 1.0
