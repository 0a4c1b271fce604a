import random

import pytest
from pyspark.sql import functions as F

from stemma.functions.similarity import title_ratio
from stemma.operators import linking, setjoin


def titles(rng, n):
    words = ["deep", "learning", "graph", "of", "on", "the", "networks", "neural", "100%_sure", "graphs", "net", "ab\\cd", "Über", "x"]
    return [" ".join(rng.choice(words) for _ in range(rng.randint(0, 6))).title() if rng.random() < 0.5 else " ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(n)]


@pytest.mark.parametrize("sizes", [(1, 2, 3), (2,), (1, 4)])
def test_containing_equals_brute_force(spark, sizes):
    rng = random.Random(3)
    letters = "aab%_.\\é😀 "
    text = lambda lo, hi: "".join(rng.choice(letters) for _ in range(rng.randint(lo, hi)))
    needles = sorted({(rng.choice([1, 2]), tuple(text(0, 4) for _ in range(rng.randint(0, 2)))) for _ in range(150)})
    texts = sorted({(rng.choice([1, 2]), text(0, 12)) for _ in range(150)})
    a = spark.createDataFrame([(g, list(n), k) for k, (g, n) in enumerate(needles)] + [(None, ["a"], -1), (1, None, -2)], "g int, needles array<string>, k int")
    b = spark.createDataFrame([(g, t) for g, t in texts] + [(None, "a"), (1, None)], "g int, text string")
    got = sorted((r.k, r.text) for r in setjoin.containing(a, b, ["g"], sizes).collect())
    want = sorted((k, t) for k, (g, n) in enumerate(needles) for h, t in texts if g == h and n and all(len(w) >= min(sizes) and w in t for w in n))
    assert got == want and got


def test_a_gram_of_every_text_makes_no_pairs(spark):
    """The word that all texts hold is not what rows meet by."""
    texts = spark.range(3000).select(F.concat(F.lit("common words "), F.lpad("id", 6, "0")).alias("text"))
    needles = spark.range(0, 3000, 10).select(F.array(F.lit("common"), F.lpad("id", 6, "0")).alias("needles"))
    assert setjoin.containing(needles, texts, [], (4,)).count() == 300


@pytest.mark.parametrize("least", [0.3, 0.5, 0.8, 1.0])
def test_similar_sets_equal_brute_force(spark, least):
    rng = random.Random(9)
    sets = {frozenset(rng.choice("abcdefghijklmnopqrst") for _ in range(rng.randint(1, 12))) for _ in range(160)}
    base = sorted(sets.pop())
    sets |= {frozenset(base[:k]) for k in range(1, len(base))}
    rows = [(k, sorted(s)) for k, s in enumerate(sorted(sets, key=sorted))]
    got = sorted(map(tuple, setjoin.similar_sets(spark.createDataFrame([*rows, (900, []), (901, None), (None, ["a"])], "id bigint, tokens array<string>"), least).collect()))
    want = [(i, j, len(set(s) & set(t)), len(set(s) & set(t)) / len(set(s) | set(t))) for i, s in rows for j, t in rows if i < j and len(set(s) & set(t)) / len(set(s) | set(t)) >= least]
    assert got == want


def test_similar_links_equal_brute_force(spark):
    rng = random.Random(4)
    papers = [(i, rng.choice([2001, 2002, None]), t) for i, t in enumerate(titles(rng, 150) + [None, ""])]
    dataset = [(1000 + i, rng.choice([2001, 2002, None]), t) for i, t in enumerate(titles(rng, 200) + [None, ""])]

    def holds(title, other):
        at, words = 0, [w for w in title.lower().split(" ") if len(w) > 3][:3]
        for w in words:
            at = other.lower().find(w, at) + len(w)
            if at < len(w):
                return False
        return bool(words)

    want = {}
    for i, y, t in papers:
        scored = [(-title_ratio(t, o), c) for c, z, o in dataset if y is not None and y == z and t and o and holds(t, o) and title_ratio(t, o) >= 0.7]
        if scored:
            want[i] = (min(scored)[1], -min(scored)[0])
    got = linking.similar_links(spark.createDataFrame(papers, "paper_id int, year int, title string"), spark.createDataFrame(dataset, "corpus_id int, year int, title string")).collect()
    assert {r.paper_id: (r.corpus_id, r.similarity) for r in got} == want and len(want) > 20


def test_letter_bound_is_never_too_low(spark):
    rng = random.Random(6)
    pairs = [("".join(rng.choice("abc d1!-É") for _ in range(rng.randint(1, 30))), "".join(rng.choice("abc d1!-") for _ in range(rng.randint(1, 30)))) for _ in range(300)]
    df = spark.createDataFrame(pairs, "a string, b string").select("a", "b", linking.ratio_bound(linking.letter_counts(F.col("a")), linking.letter_counts(F.col("b"))).alias("bound"))
    rows = df.collect()
    assert all(title_ratio(r.a, r.b) <= r.bound + 1e-12 for r in rows) and sum(r.bound < 0.7 for r in rows) > 20


def test_exact_links_of_a_title_that_many_share(spark):
    papers = spark.range(2000).select(F.col("id").alias("paper_id"), F.lit(2000).alias("year"), F.when(F.col("id") % 2 == 0, "Same Title").otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("title"))
    links = linking.exact_links(papers, papers.withColumnRenamed("paper_id", "corpus_id").withColumn("title", F.upper("title")))
    assert links.count() == 2000 and links.where("paper_id % 2 = 0").agg(F.max("corpus_id")).first()[0] == 0


@pytest.mark.parametrize("few", [True, False])
def test_grams_of_texts_are_never_broadcast(spark, few):
    """Their size is underestimated: each text has as many rows as grams."""
    texts = spark.range(2000).select(F.concat(F.lit("common words "), F.lpad("id", 6, "0")).alias("text")).distinct()
    needles = spark.range(0, 2000, 10).select(F.array(F.lpad("id", 6, "0")).alias("needles"))
    df = setjoin.containing(needles, texts, [], (4,), few=few)
    assert len(df.collect()) == 200
    last = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    top = next(line for line in last.splitlines() if "Join" in line)
    assert ("BroadcastHashJoin" in top and "BuildLeft" in top) if few else "SortMergeJoin" in top


def _joined(plan):
    """The largest number of rows that a join of a plan which has run made."""
    if plan.nodeName() == "AdaptiveSparkPlan":
        return _joined(plan.executedPlan())
    most = plan.metrics().apply("numOutputRows").value() if "Join" in plan.nodeName() else 0
    inner = [plan.plan()] if "QueryStage" in plan.nodeName() else [plan.children().apply(i) for i in range(plan.children().size())]
    return max([most, *map(_joined, inner)])


def test_sets_with_many_tokens_in_common_make_few_pairs(spark):
    """36 tokens of 45 are common to all sets: not alike, yet each was paired with each by the tenth token."""
    rows = [(k, sorted([f"c{i}" for i in range(36)] + [f"o{k // 2}-{i}" for i in range(8)] + [f"x{k}"])) for k in range(400)]
    df = setjoin.similar_sets(spark.createDataFrame(rows, "id bigint, tokens array<string>"), 0.8)
    assert sorted((r.a, r.b) for r in df.collect()) == [(k, k + 1) for k in range(0, 400, 2)]
    assert _joined(df._jdf.queryExecution().executedPlan()) <= 400 * 45


def test_signatures_differ_no_more_than_sets(spark):
    rng = random.Random(2)
    pairs = [([f"t{rng.randint(0, 60)}" for _ in range(30)], [f"t{rng.randint(0, 60)}" for _ in range(30)]) for _ in range(200)]
    df = spark.createDataFrame(pairs, "a array<string>, b array<string>").select("a", "b", setjoin.signature(F.array_distinct("a")).alias("x"), setjoin.signature(F.array_distinct("b")).alias("y"))
    apart = [(sum(bin((p ^ q) & (1 << 64) - 1).count("1") for p, q in zip(r.x, r.y, strict=True)), len(set(r.a) ^ set(r.b))) for r in df.collect()]
    assert all(bits <= tokens for bits, tokens in apart) and any(bits > 15 for bits, _ in apart)


def test_equal_names_are_paired_without_lists(spark):
    from stemma.operators import authors

    rng = random.Random(12)
    name = lambda: rng.choice(["Ann Li", "A. Li", "Bo Chen", "B. Chen", "ann  li", "", "Cy", None])
    names = spark.createDataFrame([(p, k, name()) for p in range(40) for k in range(rng.randint(0, 6))], "paper_id int, name_pos int, name string")
    cands = spark.createDataFrame([(p, k, f"id{k}", name()) for p in range(40) for k in range(rng.randint(0, 6))], "paper_id int, cand_pos int, cand_id string, cand_name string")
    for tiers in (("exact",), ("exact", "initials")):
        found = authors.match_authors(names, cands, tiers=tiers)
        want = authors._assigned(names, cands, 85, tiers).where("tier IS NOT NULL")
        got = sorted(map(tuple, found.collect()), key=str)
        assert got == sorted(map(tuple, want.collect()), key=str) and got
        assert "collect_list" not in found._jdf.queryExecution().optimizedPlan().toString()
