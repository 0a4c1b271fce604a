"""Audit of how filters interact: SQL CUBE over failure flags, survivors of every subset, all orders of application."""

from __future__ import annotations

import itertools
import math

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.llm.common import materialize, scratch, table

FILTERS = "ABCDE"
#: Fixed by the contract: white space between words, and thresholds of the filters.
SPACE = r"[\x20\x09-\x0D]+"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS, SYMBOLS = 50, 65, 5, r"[#$%&*|]"


def flags_of(text: Column) -> dict[str, Column]:
    """Failure of each filter that looks at one text alone: A to D."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    n = F.col("_words")
    return {
        "_words": F.size(words),
        "_distinct": F.size(F.array_distinct(words)),
        "A": n < LEAST_WORDS,
        "B": F.col("_distinct") * 100 < n * LEAST_DISTINCT,
        "C": (F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))) * 100 > F.length(text) * MOST_CAPITALS,
        "D": text.rlike(SYMBOLS),
    }


def flag_counts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, A, B, C, D, E, n, good, toxic): documents of each part by the filters that they fail.

    Texts are read once and leave the scan as a digest.  Rows equal in doc_id, text and source are
    counted before anything is shuffled by key; copies of one text are counted by part and label
    before they meet, so that a text in a third of all rows is at most four rows for each part there.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text")
    )
    flags = flags_of(F.col("text"))
    rows = rows.withColumns({k: flags[k] for k in ("_words", "_distinct")}).withColumns({k: flags[k] for k in "ABCD"})
    digest = F.unhex(F.sha2("text", 256))
    rows = rows.select("doc_id", "part", digest.alias("digest"), *"ABCD").groupBy("doc_id", "part", "digest", *"ABCD").agg(F.count("*").alias("n"))
    marks = labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("bigint").alias("doc_id"))
    marks = marks.agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = materialize(rows, "audit-rows")  # both branches below read it
    named = rows.where("doc_id IS NOT NULL").join(marks, "doc_id", "left").fillna(False, ["good", "toxic"])
    unnamed = rows.where("doc_id IS NULL").select(*rows.columns, F.lit(False).alias("good"), F.lit(False).alias("toxic"))
    kind = ["digest", "part", *"ABCD", "good", "toxic"]
    # (doc_id, kind) is unique: the smallest doc_id of a kind comes with its number of rows
    classes = named.unionByName(unnamed).groupBy(*kind).agg(
        F.sum("n").alias("n"),
        F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "n"))).alias("low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("unnamed"),
    )
    least = F.min("low.doc_id").over(Window.partitionBy("digest"))
    first = F.col("unnamed") + F.when(F.col("low.doc_id") == F.col("least"), F.col("low.n")).otherwise(0)
    both = F.array(F.struct(F.lit(False).alias("E"), first.alias("n")), F.struct(F.lit(True).alias("E"), (F.col("n") - first).alias("n")))
    split = classes.withColumn("least", least).select("part", *"ABCD", "good", "toxic", F.explode(both).alias("x"))
    return split.where("x.n > 0").groupBy("part", *"ABCD", F.col("x.E").alias("E")).agg(
        F.sum("x.n").alias("n"), F.sum(F.when(F.col("good"), F.col("x.n")).otherwise(0)).alias("good"), F.sum(F.when(F.col("toxic"), F.col("x.n")).otherwise(0)).alias("toxic")
    )


def survivors(counts: DataFrame) -> DataFrame:
    """(part, subset, n, good, toxic): documents of each part that fail no filter of the subset, a bit mask, for all 32.

    The cube's row for a subset is that of the grouping set with exactly its flags, all false; subsets
    that nothing survives have zeros.
    """
    cube = counts.cube("part", *FILTERS).agg(F.grouping_id().alias("gid"), *[F.sum(c).alias(c) for c in ("n", "good", "toxic")])
    # grouping_id has a set bit for each column that is rolled up: part first, then A, ..., E
    alive = [F.when(F.col("gid").bitwiseAND(1 << (len(FILTERS) - 1 - i)) != 0, True).otherwise(~F.col(f)) for i, f in enumerate(FILTERS)]
    mask = sum((F.when(F.col("gid").bitwiseAND(1 << (len(FILTERS) - 1 - i)) == 0, 1 << i).otherwise(0) for i in range(len(FILTERS))), F.lit(0))
    kept = cube.where(F.col("gid") < 1 << len(FILTERS)).where(F.forall(F.array(*alive), lambda x: x))
    kept = kept.select("part", mask.alias("subset"), "n", "good", "toxic")
    every = counts.select("part").distinct().select("part", F.explode(F.sequence(F.lit(0), F.lit((1 << len(FILTERS)) - 1))).alias("subset"))
    return every.join(kept, ["part", "subset"], "left").fillna(0, ["n", "good", "toxic"])


def steps(spark: SparkSession) -> DataFrame:
    """600 rows (filter_order, step, filter, before, after): the subsets applied before and after each step of each order."""
    rows = []
    for order in itertools.permutations(range(len(FILTERS))):
        before = 0
        for at, f in enumerate(order, 1):
            rows.append(("".join(FILTERS[i] for i in order), at, FILTERS[f], before, before | 1 << f))
            before |= 1 << f
    return spark.createDataFrame(rows, "filter_order string, step int, filter string, before int, after int")


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """What each filter removes at each step of each order: one row for each part, order and step.

    ``part`` is the source (null: empty string), ``docs`` have doc_id, text and source, ``labels`` have
    doc_id, quality and toxic.  Filters fail: A under 50 words, B under 65 % different words, C over 5 %
    capitals, D symbols, E a text that a smaller doc_id has too.  kept and removed are counts after and
    at the step; redundant fail the filter but went earlier; unique_fails fail no other; good_lost and
    toxic_lost are labelled documents removed at the step; shapley sums the filter's removals over all
    orders.  All follow from the survivors of subsets: each step joins two of them.  A null text is
    empty; a row without doc_id has no label, and neither fails E nor makes others fail; repeated rows of
    one doc_id count each and fail E alike; a document with several labels is good (toxic) if one says so;
    other columns are not read; an empty table has no parts and gives no rows.
    """
    spark = docs.sparkSession
    with scratch(spark):
        counts = materialize(flag_counts(docs, labels), "audit-counts")
        kept = materialize(survivors(counts), "audit-survivors", outlive=1)
    each = F.broadcast(steps(spark))  # 600 rows

    def side(name: str) -> DataFrame:
        return kept.select("part", F.col("subset").alias(name), F.struct("n", "good", "toxic").alias(f"at_{name}"))

    whole = (1 << len(FILTERS)) - 1
    totals = kept.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", "n"))).alias("left"))  # 32 entries a part
    # the share of orders that apply exactly a given set of s filters before: s! (4 - s)! of 120
    weights = {s: math.factorial(s) * math.factorial(len(FILTERS) - 1 - s) for s in range(len(FILTERS))}
    gains = []
    for i, f in enumerate(FILTERS):
        others = [m for m in range(whole + 1) if not m >> i & 1]
        share = sum((weights[m.bit_count()] * (F.col("left")[m] - F.col("left")[m | 1 << i]) for m in others), F.lit(0).cast("bigint"))
        alone = F.col("left")[whole & ~(1 << i)] - F.col("left")[whole]
        gains.append(F.struct(F.lit(f).alias("filter"), (F.col("left")[0] - F.col("left")[1 << i]).alias("fails"), alone.alias("unique_fails"), share.alias("shapley")))
    gains = totals.select("part", F.inline(F.array(*gains)))
    rows = side("before").join(each, "before").join(side("after"), ["part", "after"]).join(gains, ["part", "filter"])
    removed = F.col("at_before.n") - F.col("at_after.n")
    return rows.select(
        "part",
        "filter_order",
        "step",
        F.col("at_after.n").alias("kept"),
        removed.alias("removed"),
        (F.col("fails") - removed).alias("redundant"),
        "unique_fails",
        (F.col("at_before.good") - F.col("at_after.good")).alias("good_lost"),
        (F.col("at_before.toxic") - F.col("at_after.toxic")).alias("toxic_lost"),
        "shapley",
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents with their labels."""
    return filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Follows each kind of document through each order, and knows nothing of subsets.
OP12_SQL = r"""
WITH RECURSIVE o AS (
    SELECT '' AS filter_order
    UNION ALL
    SELECT filter_order || f FROM o, (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f) WHERE strpos(filter_order, f) = 0
), w AS (
    SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
        list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
    FROM documents
), marks AS (
    SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), d AS (
    SELECT part,
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END AS fails,
        coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
    FROM w LEFT JOIN marks USING (doc_id)
), k AS (
    SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM d GROUP BY part, fails
), s AS (
    SELECT filter_order, step, substr(filter_order, step, 1) AS f, substr(filter_order, 1, step - 1) AS earlier
    FROM o, (SELECT unnest([1, 2, 3, 4, 5]) AS step) WHERE length(filter_order) = 5
), x AS (
    SELECT part, filter_order, step, f, n, good, toxic, strpos(fails, f) > 0 AS failing, fails = f AS lone,
        length(translate(fails, earlier, '')) < length(fails) AS gone
    FROM k, s
), r AS (
    SELECT part, filter_order, step, f,
        CAST(coalesce(sum(n) FILTER (WHERE NOT failing AND NOT gone), 0) AS BIGINT) AS kept,
        CAST(coalesce(sum(n) FILTER (WHERE failing AND NOT gone), 0) AS BIGINT) AS removed,
        CAST(coalesce(sum(n) FILTER (WHERE failing AND gone), 0) AS BIGINT) AS redundant,
        CAST(coalesce(sum(n) FILTER (WHERE lone), 0) AS BIGINT) AS unique_fails,
        CAST(coalesce(sum(good) FILTER (WHERE failing AND NOT gone), 0) AS BIGINT) AS good_lost,
        CAST(coalesce(sum(toxic) FILTER (WHERE failing AND NOT gone), 0) AS BIGINT) AS toxic_lost
    FROM x GROUP BY part, filter_order, step, f
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    CAST(sum(removed) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM r
"""
