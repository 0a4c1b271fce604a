"""Shared plumbing: tables, the shared folder, Arrow batches, connected components."""

from __future__ import annotations

import atexit
import ctypes
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``.  Only a local master may do without it."""
    found = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='stemma-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


class _Written(threading.local):
    """The tables that each open ``scratch`` block of this thread has written; the first list is of none."""

    def __init__(self) -> None:
        self.blocks: list[list[str]] = [[]]


_written = _Written()
_left: list[tuple[SparkSession, list[str]]] = []


def _delete(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    paths.clear()


def own_path(spark: SparkSession, tag: str, outlive: int = 0) -> str:
    """A new path in the shared folder; what is written there goes as the files of ``materialize`` do."""
    path = f"{shared_dir(spark)}/{tag}-{uuid.uuid4().hex}"
    blocks = _written.blocks
    blocks[max(0, len(blocks) - 1 - outlive)].append(path)
    if not any(x is blocks[0] for _, x in _left):
        _left.append((spark, blocks[0]))
    return path


def materialize(df: DataFrame, tag: str, outlive: int = 0) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts lineage, survives lost executors.

    The files go when the ``scratch`` block that they were written in ends, or when the block that is
    ``outlive`` steps further out does; outside of blocks, when the driver's interpreter ends.
    """
    spark = df.sparkSession
    path = own_path(spark, tag, outlive)
    schema = df.schema
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are written inside go at the end, but those that outlive the block.

    The driver's memory is collected too: Spark removes the shuffle files of plans that are gone.
    """
    _written.blocks.append([])
    try:
        yield
    finally:
        _delete(spark, _written.blocks.pop())
        spark.sparkContext._jvm.System.gc()


@atexit.register
def _clean() -> None:
    for spark, paths in _left:
        if spark.sparkContext._jsc is not None:  # the session may have ended
            _delete(spark, paths)


def free_name(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it until no column of ``docs`` starts with it in any case of letters."""
    taken = [c.lower() for c in docs.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name += "_"
    return name


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` with a row number that every plan over the same files gives alike, however it splits them.

    ``name`` is the number's column, see ``free_name``.

    Rows count on from file to file in the order of their paths, and inside a file by their place in
    it.  The driver holds one path and one count for each file.  ``docs`` is a scan of files, perhaps
    with columns chosen; rows that come from no file are written to the shared folder first.
    """
    spark = docs.sparkSession
    if not docs.inputFiles():
        docs = materialize(docs, "rows")
    where = F.col("_metadata.file_path")
    files = docs.select(where.alias("path")).groupBy("path").count().collect()
    first, bases = 0, []
    for r in sorted(files):
        bases.append((r.path, first))
        first += r[1]
    base = spark.createDataFrame(bases, f"`{name}_path` string, `{name}_base` bigint")
    placed = docs.withColumn(f"{name}_file", where).withColumn(name, F.col("_metadata.row_index"))
    placed = placed.join(F.broadcast(base) if len(bases) <= MOST_FILES else base, F.col(f"{name}_file") == F.col(f"{name}_path"))
    return placed.select(*[F.col(f"`{c}`") for c in docs.columns], (F.col(name) + F.col(f"{name}_base")).alias(name))


#: Files whose first numbers are broadcast: some 100 bytes each.
MOST_FILES = 100_000


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Arrow batches of text small enough for several Python workers on one executor."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def trimmed(run: Callable) -> Callable:
    """``run`` for ``mapInArrow``; at its end freed memory goes back, as workers are used again."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)

    return wrapped


def part_id() -> int:
    return TaskContext.get().partitionId()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def texts_of(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def unsigned_crc(column: Column) -> Column:
    """crc32 of a binary column, 0 for null (no bytes)."""
    return F.coalesce(F.crc32(column), F.lit(0).cast("bigint"))


def batches_of(rows: dict[str, list], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    if len(next(iter(rows.values()))):
        yield pa.RecordBatch.from_pydict(rows, schema=schema)


def connected_components(edges: DataFrame, tag: str = "components", outlive: int = 0) -> DataFrame:
    """(node, component) for the nodes of ``edges(a, b)``: component is the smallest node reachable.

    Alternating large-star and small-star rounds until nothing changes; there is no limit of rounds,
    and some ten are usual.  The smallest neighbours are aggregated with map-side combine and written,
    so that both sides of the join behind are plain shuffles, which adaptive execution may split: one
    node with very many links is no single task.  Loops and repeated edges are allowed; null ends are
    dropped; an empty input gives an empty result.  The result is a table, see ``materialize``.
    """
    spark = edges.sparkSession
    e = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u IS NOT NULL AND v IS NOT NULL AND u <> v")
    e = e.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    with scratch(spark):
        e, before = materialize(e, tag), None
        while True:
            both = e.unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
            least = materialize(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), tag)
            large = both.join(least, "u").where("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            # a node keeps its own link to the smallest neighbour
            own = least.where("m < u").select("u", F.col("m").alias("v"))
            e1 = materialize(large.unionAll(own).distinct(), tag)
            low = materialize(e1.groupBy("u").agg(F.min("v").alias("m")), tag)
            small = e1.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            e = materialize(small.unionAll(low.select("u", F.col("m").alias("v"))).distinct(), tag)
            now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
            if now == before:
                break
            before = now
        roots = e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
        out = e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
        return materialize(out, tag, outlive + 1)
