"""Snapshots as manifests: lists of files with checksums over one store of contents (SNK21, SNK22, V5).

A data file is copied when its content is not in the store yet, and never again; a snapshot of a table
that has not changed writes a list and no data.  Files are listed on the driver, read, checked and
copied by tasks.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from stemma.sources.tables import exists


def _files(spark: SparkSession, path: str) -> DataFrame:
    """(name, size, sum) of the Parquet files below ``path``: each is read once, by a task of its own."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(path)
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    root = root.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(root).toUri().getPath().rstrip("/")
    name = F.regexp_replace(F.url_decode(F.replace(F.col("path"), F.lit("+"), F.lit("%2B"))), "^.*?" + _quoted(root) + "/", "")
    return found.select(name.alias("name"), F.col("length").alias("size"), F.sha2("content", 256).alias("sum"), "content")


def _quoted(text: str) -> str:
    return "".join(c if c.isalnum() else f"\\{c}" for c in text)


def snapshot(spark: SparkSession, path: str, store: str, name: str) -> DataFrame:
    """Record the table at ``path`` as ``name``; returns (name, size, sum, copied), one row for each of its files.

    Contents lie in ``store/contents`` by their SHA-256; those that are there already are not written.
    """
    if exists(spark, f"{store}/manifests/{name}"):
        raise FileExistsError(name)
    files = _files(spark, path)
    listed = files.drop("content")
    held = spark.read.schema("sum string, content binary").parquet(f"{store}/contents") if exists(spark, f"{store}/contents") else None
    known = held.select("sum").distinct().withColumn("old", F.lit(True)) if held is not None else spark.createDataFrame([], "sum string, old boolean")
    listed = listed.join(known, "sum", "left").select("name", "size", "sum", F.col("old").isNull().alias("copied"), F.lit(spark.read.parquet(path).schema.json()).alias("schema"))
    listed.write.parquet(f"{store}/manifests/{name}")
    listed = spark.read.parquet(f"{store}/manifests/{name}")
    if not listed.where("copied").isEmpty():
        first = listed.where("copied").groupBy("sum").agg(F.min("name").alias("name"))
        fresh = files.join(first, ["name", "sum"], "left_semi")
        fresh.select("sum", "content").write.mode("append").option("compression", "none").parquet(f"{store}/contents")
    return listed.drop("schema")


def names(spark: SparkSession, store: str) -> list[str]:
    """The snapshots in a store, by name."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    found = p(store).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p(f"{store}/manifests/*")) or []
    return sorted(x.getPath().getName() for x in found)


def damaged(spark: SparkSession, path: str, store: str, name: str) -> DataFrame:
    """(name, fault): files of the table at ``path`` that are ``missing``, ``changed`` or ``unknown`` against the snapshot."""
    listed = spark.read.parquet(f"{store}/manifests/{name}").select("name", F.col("sum").alias("want"))
    now = _files(spark, path).select("name", "sum")
    both = listed.join(now, "name", "full_outer")
    fault = F.when(F.col("sum").isNull(), "missing").when(F.col("want").isNull(), "unknown").when(F.col("sum") != F.col("want"), "changed")
    return both.select("name", fault.alias("fault")).where("fault IS NOT NULL")


def restore(spark: SparkSession, store: str, name: str, target: str) -> DataFrame:
    """The rows of a snapshot, written as a table at ``target``: contents are verified before they are read.

    Columns that the table was partitioned by come from the files' names, and partition it again.  A
    content that is missing or does not have its checksum raises ValueError, and nothing is written.
    """
    if exists(spark, target):
        raise FileExistsError(target)
    manifest = spark.read.parquet(f"{store}/manifests/{name}")
    listed, one = manifest.select("name", "sum"), manifest.first()
    whole = StructType.fromJson(json.loads(one.schema))
    folders = [part.split("=", 1)[0] for part in one.name.split("/")[:-1]]
    kept = StructType([f for f in whole if f.name not in folders])
    held = spark.read.schema("sum string, content binary").parquet(f"{store}/contents").dropDuplicates(["sum"])
    both = listed.join(held, "sum", "left")
    good = F.coalesce(F.sha2("content", 256) == F.col("sum"), F.lit(False))
    if bad := [r.name for r in both.where(~good).select("name").limit(5).collect()]:
        raise ValueError(f"contents are missing or damaged: {', '.join(bad)}")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = [unquote(part.split("=", 1)[1]) for part in name.split("/")[:-1]]
                values = [None if v == "__HIVE_DEFAULT_PARTITION__" else v for v in values]
                for part in pq.ParquetFile(pa.BufferReader(content.as_py())).iter_batches(columns=kept.names):
                    own = [pa.array([v] * len(part), pa.string()) for v in values]
                    yield pa.RecordBatch.from_arrays([*(part.column(c) for c in kept.names), *own], names=[*kept.names, *folders])

    found = both.select("name", "content").mapInArrow(rows, StructType([*kept, *(StructField(c, StringType()) for c in folders)]))
    writer = found.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in whole]).write
    (writer.partitionBy(*folders) if folders else writer).parquet(target)
    return spark.read.parquet(target)
