"""Bloom filter: sizing, and an explicit filter as a table of bit positions (MT16)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def sizing(n: Column, p: Column) -> dict[str, Column]:
    """bits, hashes and bytes for n items at false-positive rate p."""
    bits = F.floor(-(n * F.ln(p)) / F.pow(F.ln(F.lit(2.0)), F.lit(2))).cast("bigint")
    hashes = (F.floor(bits / n * F.ln(F.lit(2.0))) + 1).cast("int")
    return {"bits": bits, "hashes": hashes, "bytes": (F.floor(bits / 8) + 1).cast("bigint")}


def false_positive_rate(n: Column, bits: Column, hashes: Column) -> Column:
    return F.round(F.pow(1 - F.exp(-hashes * n / bits), hashes), 4)


def places(item: Column, bits: int, hashes: int) -> Column:
    """The item's bit positions."""
    return F.array(*[F.pmod(F.xxhash64(item, F.lit(k)), F.lit(bits)) for k in range(hashes)])


def build(items: DataFrame, column: str, bits: int, hashes: int) -> DataFrame:
    """The filter as 64-bit words (word, value): at most bits / 64 rows, or-ed map-side."""
    place = items.select(F.explode(places(F.col(column), bits, hashes)).alias("b"))
    word, bit = F.floor(F.col("b") / 64).cast("bigint"), F.pmod("b", F.lit(64)).cast("int")
    return place.groupBy(word.alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(b, 64) AS int))")).alias("value"))


def might_contain(items: DataFrame, column: str, filter_: DataFrame, bits: int, hashes: int) -> DataFrame:
    """Items all of whose bits are set; never misses one that was added."""
    asked = items.select(column).distinct().withColumn("b", F.explode(places(F.col(column), bits, hashes)))
    asked = asked.withColumn("word", F.floor(F.col("b") / 64).cast("bigint"))
    hit = asked.join(filter_, "word", "left").withColumn("set", F.coalesce(F.expr("shiftright(value, cast(pmod(b, 64) AS int)) & 1"), F.lit(0)) == 1)
    return hit.groupBy(column).agg(F.bool_and("set").alias("maybe")).where("maybe").select(column)
