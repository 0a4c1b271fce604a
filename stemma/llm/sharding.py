"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (DataFrame operations only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stemma.llm.common import materialize, table, unsigned_crc


def ring(spark: SparkSession, n_shards: int, vnodes: int, cell_bits: int) -> DataFrame:
    """The ring as intervals (lo, hi] cut at cell borders: arc, shard, cell, lo, hi, part.

    A key belongs to the first virtual node at or after its hash.  Cells are the leading
    ``cell_bits`` bits of the hash, so that a key finds its arc by an equality join.
    At most ``n_shards * vnodes + 2 ** cell_bits + 1`` rows, whatever the data.
    """
    nodes = spark.range(n_shards * vnodes).select(
        (F.col("id") % n_shards).cast("int").alias("shard"),
        F.xxhash64(F.lit("node"), F.col("id") % n_shards, F.floor(F.col("id") / n_shards)).alias("hi"),
    )
    nodes = nodes.groupBy("hi").agg(F.min("shard").alias("shard"))
    order = Window.orderBy("hi")
    nodes = nodes.select(
        "shard",
        "hi",
        (F.row_number().over(order) - 1).alias("arc"),
        F.lag("hi").over(order).alias("prev"),
        F.max("hi").over(Window.partitionBy()).alias("last"),
    )
    low, high, shift = -(2**63), 2**63 - 1, 64 - cell_bits
    arcs = nodes.select(
        "arc", "shard", F.lit(1).alias("part"), F.when(F.col("prev").isNull(), F.lit(low)).otherwise(F.col("prev") + 1).alias("lo"), "hi"
    )
    wrap = (
        nodes.where("arc = 0")
        .where(F.col("last") < high)
        .select("arc", "shard", F.lit(0).alias("part"), (F.col("last") + 1).alias("lo"), F.lit(high).alias("hi"))
    )
    cut = arcs.unionAll(wrap).withColumn(
        "cell", F.explode(F.sequence(F.shiftright("lo", shift), F.shiftright("hi", shift)))
    )
    start = F.shiftleft(F.col("cell"), shift)
    return cut.select(
        "arc", "shard", "part", "cell", F.greatest("lo", start).alias("lo"), F.least("hi", start + F.lit(2**shift - 1)).alias("hi")
    )


def allocate(arcs: DataFrame, n_shards: int, load_factor: float | None) -> DataFrame:
    """Which ranks of each arc go to which shard: arc, from, to, shard, base.

    ``arcs(arc, shard, n)`` has one row for each virtual node.  In round j every arc offers what it
    still holds to the j-th different shard clockwise, in ring order, and the shard takes as much as
    its capacity leaves.  The capacities sum to at least the number of keys, so after ``n_shards``
    rounds nothing is left.  One row of arrays of the ring's size is folded; no data row is touched.
    """
    one = arcs.agg(
        F.sum("n").alias("total"),
        F.transform(F.array_sort(F.collect_list(F.struct("arc", "n"))), lambda x: x["n"]).alias("left"),
        F.transform(F.array_sort(F.collect_list(F.struct("arc", "shard"))), lambda x: x["shard"]).alias("owner"),
    )
    if load_factor is None:  # exact: as many floors and ceilings as the total asks for
        cap = "transform(sequence(0, {s} - 1), s -> total div {s} + if(s < total % {s}, 1L, 0L))"
    else:
        cap = f"transform(sequence(0, {{s}} - 1), s -> cast(ceil(total * {load_factor}D / {{s}}) as bigint))"
    one = one.selectExpr(
        "total", "left", "owner", cap.format(s=n_shards) + " AS cap", "size(left) AS arcs"
    ).selectExpr(
        "*",
        "transform(sequence(0, arcs - 1), k -> array_distinct(concat(slice(owner, k + 1, arcs), slice(owner, 1, k)))) AS prefer",
    )
    taken = "least(element_at(s.left, k + 1), element_at(s.cap, p + 1))"
    step = f"""
      aggregate(sequence(0, arcs * {n_shards} - 1),
        named_struct('left', left, 'cap', cap, 'out',
          cast(array() AS array<struct<arc:int,lo:bigint,n:bigint,shard:int,base:bigint>>)),
        (s, i) -> if(element_at(s.left, cast(i % arcs AS int) + 1) = 0
                     OR size(element_at(prefer, cast(i % arcs AS int) + 1)) <= cast(i div arcs AS int), s,
          aggregate(array(cast(i % arcs AS int)), s, (z, k) ->
            aggregate(array(element_at(element_at(prefer, k + 1), cast(i div arcs AS int) + 1)), s, (y, p) ->
              named_struct(
                'left', transform(s.left, (x, j) -> if(j = k, x - {taken}, x)),
                'cap', transform(s.cap, (x, j) -> if(j = p, x - {taken}, x)),
                'out', concat(s.out, filter(array(named_struct('arc', k,
                   'lo', element_at(left, k + 1) - element_at(s.left, k + 1), 'n', {taken},
                   'shard', p, 'base', element_at(cap, p + 1) - element_at(s.cap, p + 1))), r -> r.n > 0)))))))"""
    return one.selectExpr(f"inline({step}.out)").selectExpr("arc", "lo", "lo + n AS hi", "shard", "base")


def ring_shards(
    df: DataFrame,
    key: str = "doc_id",
    keep: list[str] | None = None,
    n_shards: int = 8,
    vnodes: int = 64,
    cell_bits: int = 12,
    load_factor: float | None = None,
    lanes: int = 16,
) -> DataFrame:
    """``keep`` columns of each row with ``shard`` and ``slot`` (gapless from 0 in each shard).

    Keys are hashed onto the ring; a shard holds at most its capacity and what overflows goes on
    clockwise.  ``load_factor`` c gives every shard room for c times the mean; None makes all shards
    equal to within one row.  Repeated rows are rows like any other, and rows of a null key are hashed
    by their ``keep`` columns; an empty input gives an empty result.

    Shuffles only ``keep`` and the hash, by ring cell and ``lanes`` hash classes of the row, so that
    many rows of one key are no single task; only rows equal in all ``keep`` columns stay together.
    Raise ``cell_bits`` with the data so that a cell fits a task.  The broadcast tables have at most
    ``n_shards * vnodes + 2 ** cell_bits`` rows, ``lanes`` times that, and ``n_shards ** 2 * vnodes``.
    """
    spark = df.sparkSession
    keep = keep or df.columns
    hashed = F.xxhash64(F.lit("key"), F.col(key), F.when(F.col(key).isNull(), F.struct(*[F.col(f"`{c}`") for c in keep])))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in keep]).alias("row"), hashed.alias("pos"))
    cells = materialize(ring(spark, n_shards, vnodes, cell_bits), "ring")
    placed = rows.withColumn("cell", F.shiftright("pos", 64 - cell_bits)).join(
        F.broadcast(cells.select("cell", "lo", "hi", "arc", "part")), "cell"
    ).where("pos BETWEEN lo AND hi").select("row", "pos", "cell", "arc", "part", F.pmod(F.xxhash64("row"), F.lit(lanes)).alias("lane"))
    placed = materialize(placed, "placed")
    piece = ["arc", "part", "cell"]
    sizes = cells.join(placed.groupBy(*piece, "lane").count(), piece, "left").select(
        "shard", *piece, F.coalesce("lane", F.lit(0)).alias("lane"), F.coalesce("count", F.lit(0)).cast("bigint").alias("n")
    )
    sizes = materialize(sizes, "cell-sizes")
    turns = allocate(sizes.groupBy("arc", "shard").agg(F.sum("n").alias("n")), n_shards, load_factor)
    turns = materialize(turns, "turns")
    before = Window.partitionBy("arc").orderBy("part", "cell", "lane").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*piece, "lane", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    ranked = placed.withColumn("in_cell", F.row_number().over(Window.partitionBy(*piece, "lane").orderBy("pos", "row")) - 1)
    return (
        ranked.join(F.broadcast(offsets), [*piece, "lane"])
        .withColumn("rank", F.col("before") + F.col("in_cell"))
        .join(F.broadcast(turns), "arc")
        .where("rank >= lo AND rank < hi")
        .select("row.*", "shard", (F.col("base") + F.col("rank") - F.col("lo")).cast("bigint").alias("slot"))
    )


def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into eight shards under the law ``rows``: counts at most one apart."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("bigint").alias("size"),
        unsigned_crc(F.col("text").cast("binary")).alias("text_crc32"),
    )
    return ring_shards(docs, keep=["doc_id", "size", "text_crc32"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
