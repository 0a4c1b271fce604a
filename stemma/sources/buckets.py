"""Tables in buckets of the key's hash: an upsert writes deltas to the buckets of its keys and nothing else (SNK1, SNK4, SNK24, IN6, MT17).

A table is a folder ``key_bucket=b/delta=n`` of Parquet files.  A batch of rows is appended as one
delta; rows of the same key lie in one bucket, whatever the delta, and the newest delta wins when the
table is read.  Only buckets with several deltas are merged then, and ``compact`` makes those with too
many into one again.  All of it is Spark's readers and writers; the driver lists folders, no rows.
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

BUCKET, DELTA, ABOUT = "key_bucket", "delta", "_about"


@dataclass(frozen=True)
class Layout:
    """What a table was created with."""

    keys: tuple[str, ...]
    buckets: int
    filled: bool
    columns: tuple[str, ...]


def _fs(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def create(spark: SparkSession, path: str, rows: DataFrame, keys: list[str], buckets: int = 64, filled: bool = False) -> None:
    """A table with the rows' columns and keys, without rows; ``filled`` tables take only values that are not null.

    The number of buckets stays; a bucket should hold what one task can sort, so choose the final size
    of the table over some 256 MB.
    """
    if layout(spark, path):
        raise FileExistsError(path)
    if taken := {BUCKET, DELTA} & {c.lower() for c in rows.columns}:
        raise ValueError(f"the table needs {', '.join(sorted(taken))} for itself")
    about = {"keys": keys, "buckets": buckets, "filled": filled, "columns": rows.columns}
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.text(f"{path}/{ABOUT}")


def layout(spark: SparkSession, path: str) -> Layout | None:
    """The table's layout, None where there is no table."""
    fs, where = _fs(spark, f"{path}/{ABOUT}/_SUCCESS")
    if not fs.exists(where):
        return None
    about = json.loads(spark.read.text(f"{path}/{ABOUT}").first().value)
    return Layout(tuple(about["keys"]), about["buckets"], about["filled"], tuple(about["columns"]))


def deltas(spark: SparkSession, path: str) -> dict[int, list[int]]:
    """The deltas of each bucket that has some, oldest first: one listing of folders."""
    fs, where = _fs(spark, f"{path}/{BUCKET}=*/{DELTA}=*")
    found: dict[int, list[int]] = {}
    for status in fs.globStatus(where) or []:
        b, d = re.search(rf"{BUCKET}=(\d+)/{DELTA}=(\d+)$", status.getPath().toString()).groups()
        found.setdefault(int(b), []).append(int(d))
    return {b: sorted(ds) for b, ds in found.items()}


def bucket_of(keys: list[str] | tuple[str, ...], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def _some(spark: SparkSession, path: str, buckets: list[int] | None) -> DataFrame:
    """All versions of the rows of some buckets, each bucket's folder alone listed and read; of all without ``buckets``."""
    reader = spark.read.option("basePath", path)
    return reader.parquet(path) if buckets is None else reader.parquet(*[f"{path}/{BUCKET}={b}" for b in buckets])


def _merged(versions: DataFrame, about: Layout) -> DataFrame:
    """One row for each key: the newest, or in filled tables each column's newest value that is not null."""
    keys = list(about.keys)
    if about.filled:
        values = [c for c in about.columns if c not in keys]
        newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(DELTA))).alias(c) for c in values]
        return versions.groupBy(BUCKET, *keys).agg(F.max(DELTA).alias(DELTA), *newest)
    place = F.row_number().over(Window.partitionBy(BUCKET, *keys).orderBy(F.desc(DELTA)))
    return versions.withColumn("_place", place).where("_place = 1").drop("_place")


def read(spark: SparkSession, path: str, only: list[int] | None = None) -> DataFrame | None:
    """The table as of now, None where there is none: newest wins.  Buckets of one delta are scanned, the others merged.

    With ``only`` nothing but these buckets is listed and read, see ``bucket_of``.
    """
    about = layout(spark, path)
    if about is None:
        return None
    held = {b: ds for b, ds in deltas(spark, path).items() if only is None or b in set(only)}
    if not held:
        return None
    several = [b for b, ds in held.items() if len(ds) > 1]
    rows = _some(spark, path, None if only is None else sorted(held))
    if several:
        one, more = rows.where(~F.col(BUCKET).isin(several)), rows.where(F.col(BUCKET).isin(several))
        rows = one.unionByName(_merged(more, about)) if len(several) < len(held) else _merged(rows, about)
    return rows.select(*about.columns)


def upsert(spark: SparkSession, path: str, new: DataFrame, delta: int | None = None, most_deltas: int = 8) -> tuple[int, int]:
    """Append ``new``, one row for each key, as a delta; returns how many keys were inserted and updated.

    Only the buckets of the new keys are listed, read (their keys alone) and written.  A delta that is
    written again, as a stream does after a failure, replaces itself.  Buckets that reach
    ``most_deltas`` are compacted afterwards.  Rows with repeated keys raise ValueError: which of them
    is newer only the caller can know.  An empty ``new`` changes nothing.
    """
    about = layout(spark, path)
    if about is None:
        raise FileNotFoundError(path)
    keys, held = list(about.keys), deltas(spark, path)
    delta = 1 + max((ds[-1] for ds in held.values()), default=0) if delta is None else delta
    rows = new.select(*about.columns).withColumn(BUCKET, bucket_of(keys, about.buckets)).withColumn(DELTA, F.lit(delta))
    target = f"{path}/{ABOUT}-new-{delta}"
    rows.repartition(about.buckets, BUCKET).write.mode("overwrite").partitionBy(BUCKET, DELTA).parquet(target)  # ``new`` is computed once
    if not deltas(spark, target):
        _fs(spark, target)[0].delete(_fs(spark, target)[1], True)
        return 0, 0
    written = spark.read.parquet(target)
    touched = sorted(deltas(spark, target))
    known = [b for b in touched if any(d != delta for d in held.get(b, []))]
    fresh = written.groupBy(BUCKET, *keys).agg(F.count("*").alias("_n"))
    if known:
        # equal, null keys too: a bucket and its keys meet once on either side
        old = _some(spark, path, known).where(F.col(DELTA) != delta).select(BUCKET, *keys).distinct().withColumn("_old", F.lit(True))
        same = [F.col(f"n.{c}").eqNullSafe(F.col(f"o.{c}")) for c in (BUCKET, *keys)]
        on = same[0]
        for s in same[1:]:
            on &= s
        fresh = fresh.alias("n").join(old.alias("o"), on, "left").select(F.col("n._n").alias("_n"), F.col("o._old").alias("_old"))
    else:
        fresh = fresh.withColumn("_old", F.lit(None).cast("boolean"))
    counts = fresh.agg(F.count_if(F.col("_old").isNull()).alias("inserted"), F.count_if("_old").alias("updated"), F.max("_n").alias("most")).first()
    fs, where = _fs(spark, target)
    if counts.most > 1:
        fs.delete(where, True)
        raise ValueError("repeated keys in one batch")
    for b in touched:  # renames of folders: rows stay where they are
        _move(spark, f"{target}/{BUCKET}={b}/{DELTA}={delta}", f"{path}/{BUCKET}={b}/{DELTA}={delta}")
    fs.delete(where, True)
    full = [b for b in touched if len(set(held.get(b, [])) | {delta}) >= most_deltas]
    if full:
        compact(spark, path, full)
    return counts.inserted, counts.updated


def _move(spark: SparkSession, source: str, target: str) -> None:
    """A folder to another place, which it replaces."""
    fs, to = _fs(spark, target)
    fs.delete(to, True)
    fs.mkdirs(to.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), to):
        raise OSError(f"{source} could not be moved to {target}")


def compact(spark: SparkSession, path: str, buckets: list[int] | None = None) -> None:
    """Merge all deltas of each of these buckets into its newest one; without ``buckets`` of those with several.

    The merged rows take the place of the newest delta, then the older ones go.  Stopped in between,
    the table reads the same, since the newest wins; files of other buckets are not touched.
    """
    about, held = layout(spark, path), deltas(spark, path)
    todo = [b for b in (held if buckets is None else buckets) if len(held.get(b, [])) > 1]
    if not todo:
        return
    target = f"{path}/{ABOUT}-compact"
    merged = _merged(_some(spark, path, todo), about).select(*about.columns, BUCKET)
    merged.repartition(len(todo), BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(target)
    for b in todo:
        _move(spark, f"{target}/{BUCKET}={b}", f"{path}/{BUCKET}={b}/{DELTA}={held[b][-1]}")
        for d in held[b][:-1]:
            fs, where = _fs(spark, f"{path}/{BUCKET}={b}/{DELTA}={d}")
            fs.delete(where, True)
    fs, where = _fs(spark, target)
    fs.delete(where, True)
