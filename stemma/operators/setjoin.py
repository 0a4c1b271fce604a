"""Joins by what texts have in common, without comparing every pair: substrings and similar sets (JN5, JN16, MT3, MT4, TX12).

Both choose for each row what is rarest on the other side, so that a word which stands everywhere
makes no pairs, and verify exactly what is left.  All of it is equality joins in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def grams(text: Column, size: Column | int) -> Column:
    """The different substrings of ``size`` characters; a shorter text is its own only one, an empty one has none."""
    n = F.lit(size) if isinstance(size, int) else size
    starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(text) - n + 1))
    return F.when(F.length(text) > 0, F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))).otherwise(F.array().cast("array<string>"))


def containing(needles: DataFrame, texts: DataFrame, by: list[str], sizes: tuple[int, ...] = (1, 2, 3), few: bool = False) -> DataFrame:
    """Pairs of rows, equal in the columns ``by``, where the text holds every needle.

    ``needles(by, needles array<string>, ...)`` and ``texts(by, text, ...)``; their other columns come
    along and must have different names; rows are distinct.  A row is looked for under one gram of its needles, the one in
    the fewest texts of its group (ties: the smallest); where a gram of its needles is in no text, no
    text is looked at.  A needle has grams of the largest of ``sizes`` that fits in it, and is never
    shorter than the smallest.  Nulls equal nothing; rows without needles, and empty needles, find
    nothing.  With ``few`` the needles are a dimension, which every task holds, and no gram of a text is
    shuffled.  The grams of the texts are never broadcast: there are many more than estimated from the texts.
    """
    if few:  # a short text makes many grams: it takes more tasks than its bytes ask for
        texts = texts.repartition(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), "text")
    fit = lambda w: F.greatest(F.lit(min(sizes)), *[F.when(F.length(w) >= s, s) for s in sizes])
    cut = F.array_distinct(F.flatten(F.transform("needles", lambda w: grams(w, fit(w)))))
    whole = (F.size("needles") > 0) & F.forall("needles", lambda w: F.length(w) >= min(sizes))
    rows = needles.where(whole)
    own = [c for c in needles.columns if c not in by]
    wanted = rows.select(*by, *own, F.explode(cut).alias("_gram"))
    every = F.flatten(F.array(*[F.when(F.length("text") >= s, grams(F.col("text"), s)).otherwise(F.array().cast("array<string>")) for s in sizes]))
    held = texts.select(*by, F.explode(every).alias("_gram"))
    grams_wanted = wanted.select(*by, "_gram").distinct()
    known = held.join(F.broadcast(grams_wanted) if few else grams_wanted, [*by, "_gram"], "left_semi").groupBy(*by, "_gram").agg(F.count("*").alias("_texts"))
    rated = wanted.join(known, [*by, "_gram"], "left")
    best = rated.groupBy(*by, *own).agg(F.count("*").alias("_all"), F.count("_texts").alias("_found"), F.min(F.struct("_texts", "_gram")).alias("_best"))
    keyed = best.where("_all = _found").select(*by, *own, F.col("_best._gram").alias("_gram"))
    placed = texts.select("*", F.explode(every).alias("_gram"))
    side = F.broadcast(keyed) if few else keyed.hint("merge")
    return side.join(placed, [*by, "_gram"]).where(F.forall("needles", lambda w: F.contains(F.col("text"), w))).drop("_gram")


#: Words of 64 bits in a signature.
WORDS = 4


def signature(tokens: Column) -> Column:
    """A bit for each token, by its hash: two sets differ in as many tokens, at least, as their bits differ."""
    places = F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(64 * WORDS)).cast("int"))

    def word(w: int) -> Column:
        own = F.filter(places, lambda p: F.floor(p / 64) == w)
        return F.aggregate(own, F.lit(0).cast("long"), lambda held, p: held.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), p % 64)))

    return F.struct(*[word(w).alias(f"w{w}") for w in range(WORDS)])


def similar_sets(sets: DataFrame, least: float) -> DataFrame:
    """(a, b, shared, similarity), a < b: all pairs of sets with a Jaccard similarity of at least ``least``.

    ``sets(id, tokens)``: ids and sets are distinct (give equal sets one id), tokens of a set too;
    nulls and empty sets are like nothing.  Tokens are put in the order of their frequency, rare ones
    first.  Two similar sets of n and m tokens share at least ceil((n + m) least / (1 + least)); so their
    first common token stands where each has that many left.  A set is entered under its first tokens
    for each size that a similar set can have, as many tokens as that size asks for, and meets only sets of that size with
    the same token there.  Of those, sets whose bits differ in more places than similar sets can differ in tokens are
    left out.  What passes is counted exactly.
    """
    if not 0 < least <= 1:
        raise ValueError("least must be above 0 and at most 1")
    some = sets.where("id IS NOT NULL AND size(tokens) > 0").select("id", "tokens")
    spread = some.select("id", F.size("tokens").alias("n"), F.explode("tokens").alias("token"))
    often = spread.groupBy("token").agg(F.count("*").alias("often"))
    order = Window.partitionBy("id").orderBy("often", "token")
    placed = spread.join(often, "token").where("often > 1 OR n > 1").withColumn("pos", F.row_number().over(order))
    slack = F.lit(1e-9)  # of products with ``least``: a bound is never too strict
    need = lambda x, y: F.ceil((x + y) * (least / (1 + least)) - slack)
    n = F.col("n")
    heads = placed.where(F.col("pos") <= n - F.ceil(n * least - slack) + 1).where("often > 1")
    heads = heads.join(some.select("id", signature(F.col("tokens")).alias("bits")), "id")

    def entries(longer: bool) -> DataFrame:
        """What a set is found under by sets of each size that is not smaller, or with ``longer`` not larger, than its own."""
        sizes = F.sequence(F.ceil(n * least - slack), n) if longer else F.sequence(n, F.floor(n / least + slack))
        each = heads.withColumn("m", F.explode(sizes)).where(F.col("pos") <= n - need(n, F.col("m")) + 1)
        pair = ("m", "n") if longer else ("n", "m")
        c = "b" if longer else "a"
        return each.select(F.xxhash64("token", *[F.col(x).cast("long") for x in pair]).alias("key"), F.col("id").alias(c), n.alias(f"n{c}"), F.col("bits").alias(f"bits{c}"))

    apart = sum((F.bit_count(F.col(f"bitsa.w{w}").bitwiseXOR(F.col(f"bitsb.w{w}"))) for w in range(1, WORDS)), F.bit_count(F.col("bitsa.w0").bitwiseXOR(F.col("bitsb.w0"))))
    near = apart <= F.col("na") + F.col("nb") - 2 * need(F.col("na"), F.col("nb"))
    once = (F.col("na") < F.col("nb")) | (F.col("a") < F.col("b"))
    # hinted: a few entries of each set make many pairs, so neither side is broadcast whole
    met = entries(False).hint("merge").join(entries(True), "key").where(once & near)
    may = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    own = lambda c: some.select(F.col("id").alias(c), F.col("tokens").alias(f"t{c}"))
    pairs = may.join(own("a"), "a").join(own("b"), "b")
    shared = F.size(F.array_intersect("ta", "tb"))
    counted = pairs.select("a", "b", shared.alias("shared"), (F.size("ta") + F.size("tb") - shared).alias("_both"))
    return counted.select("a", "b", "shared", (F.col("shared") / F.col("_both")).alias("similarity")).where(F.col("similarity") >= least)
