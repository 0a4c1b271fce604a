"""Parquet tables as the store: overwrite, append, year partitions, snapshots, run and release records (SNK8-SNK22)."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.operators import incremental


def overwrite(df: DataFrame, path: str, *partitions: str) -> None:
    """Full overwrite; a table that is partly read from ``path`` itself must be written elsewhere first."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(path)


def dealt(df: DataFrame, *partitions: str) -> DataFrame:
    """``df`` before it is written by ``partitions``: few files for each, and a large partition is split over several tasks."""
    return df.hint("rebalance", *partitions)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def from_database(spark: SparkSession, url: str, source: str, key: str | None = None, bounds: tuple[int, int] = (0, 0), parts: int = 8, **options: str) -> DataFrame:
    """A table, or a query in brackets with a name, over JDBC (SRC10, SRC11).

    With a numeric ``key`` and its ``bounds`` the read is dealt over ``parts`` connections; rows outside
    the bounds and null keys belong to the outer ones.  Filters and columns are pushed to the database.
    """
    reader = spark.read.format("jdbc").options(url=url, dbtable=source, fetchsize="10000", **options)
    if key:
        reader = reader.options(partitionColumn=key, lowerBound=str(bounds[0]), upperBound=str(bounds[1]), numPartitions=str(parts))
    return reader.load()


def exists(spark: SparkSession, path: str) -> bool:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where)


def read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; one that a broken ``swap_in`` left beside it is put back first."""
    old = f"{path}.old"
    if not exists(spark, path) and exists(spark, old):
        p = spark._jvm.org.apache.hadoop.fs.Path
        p(old).getFileSystem(spark._jsc.hadoopConfiguration()).rename(p(old), p(path))
    return spark.read.parquet(path) if exists(spark, path) else None


def swap_in(spark: SparkSession, df: DataFrame, path: str) -> None:
    """Overwrite a table that ``df`` reads: written beside it, then renamed.

    A failure between the two renames leaves the old table at ``path.old``; ``read_or_none`` repairs it.
    """
    new, old = f"{path}.new", f"{path}.old"
    df.write.mode("overwrite").parquet(new)
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(path).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(p(old), True)
    if fs.exists(p(path)):
        fs.rename(p(path), p(old))
    fs.rename(p(new), p(path))
    fs.delete(p(old), True)


def upsert_table(spark: SparkSession, new: DataFrame, path: str, keys: list[str], created: str | None = None) -> DataFrame:
    """Upsert into the table at ``path``; returns the counts (inserted, updated)."""
    old = read_or_none(spark, path)
    if old is None:
        counts = new.select(*keys).distinct().agg(F.count("*").alias("inserted"), F.lit(0).cast("bigint").alias("updated"))
        counts = spark.createDataFrame(counts.collect(), counts.schema)  # one row
        swap_in(spark, new, path)
        return counts
    counts = incremental.upsert_counts(old, new, keys)
    counts = spark.createDataFrame(counts.collect(), counts.schema)  # one row, before the table changes
    swap_in(spark, incremental.upsert(old, new, keys, created), path)
    return counts


def snapshot(spark: SparkSession, path: str, folder: str, at: datetime) -> str:
    """A copy of a table under its name and a time; the name tells the table again."""
    name = f"{folder}/{path.rstrip('/').rsplit('/', 1)[-1]}_{at:%Y%m%d_%H%M%S}"
    spark.read.parquet(path).write.parquet(name)
    return name


def snapshots(spark: SparkSession, folder: str, table: str) -> list[str]:
    """The snapshots of a table, oldest first (SNK22)."""
    path = spark._jvm.org.apache.hadoop.fs.Path
    found = path(folder).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path(f"{folder}/{table}_[0-9]*_[0-9]*")) or []
    return sorted(str(x.getPath()) for x in found)


def restore(spark: SparkSession, copy: str, folder: str, rename: str | None = None, replace: bool = False) -> str:
    """A snapshot back as a table, under its own name or another."""
    name = rename or copy.rstrip("/").rsplit("/", 1)[-1].rsplit("_", 2)[0]
    target = f"{folder}/{name}"
    if exists(spark, target) and not replace:
        raise FileExistsError(target)
    spark.read.parquet(copy).write.mode("overwrite").parquet(target)
    return target


#: First years of the partitions, and their names; from the last-but-one to the last, each year is one.
YEAR_BOUNDS = [(1970, "0-1969"), (1990, "1970-1989"), (2001, "1990-2000")]
LAST_YEAR = 2031


def year_bucket(year: str = "year") -> Column:
    """The partition a year falls into."""
    y = F.col(year)
    out = F.when(y.isNull(), "null")
    for bound, name in YEAR_BOUNDS:
        out = out.when(y < bound, name)
    return out.when(y < LAST_YEAR, y.cast("string")).otherwise(f"{LAST_YEAR}+")


def bucket_names(first: int, last: int) -> list[str]:
    """The partitions that hold the years ``first`` to ``last``."""
    names, at = [], 0
    for bound, name in YEAR_BOUNDS:
        if first < bound and last >= at:
            names.append(name)
        at = bound
    names += [str(y) for y in range(max(first, at), min(last, LAST_YEAR - 1) + 1)]
    return names + [f"{LAST_YEAR}+"] * (last >= LAST_YEAR)


def in_years(papers: DataFrame, first: int, last: int) -> DataFrame:
    """Rows of a table that is partitioned by ``year_bucket``; other partitions are not read."""
    return papers.where(F.col("year_bucket").isin(bucket_names(first, last)) & F.col("year").between(first, last))


def replace_partitions(rows: DataFrame, path: str, *partitions: str) -> None:
    """Overwrite only the partitions that ``rows`` has; the files of all others stay (SNK10).

    A partition that ``rows`` has no row of stays too: drop it to empty it.
    """
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path)


def partition_folders(spark: SparkSession, path: str, column: str = "year_bucket") -> dict[str, str]:
    """The partitions of a table by value, with their folders: one listing, no file is read (PQ5)."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    found = p(path).getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p(f"{path}/{column}=*")) or []
    return {x.getPath().getName().split("=", 1)[1]: x.getPath().toString() for x in found}


def _move(spark: SparkSession, source: str, target: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path
    fs = p(source).getFileSystem(spark._jsc.hadoopConfiguration())
    if fs.exists(p(target)):
        raise FileExistsError(target)
    fs.mkdirs(p(target).getParent())
    if not fs.rename(p(source), p(target)):
        raise FileNotFoundError(source)


def detach_partition(spark: SparkSession, path: str, value: str, to: str) -> None:
    """A year partition out of the table, as a table of its own at ``to``; no row is copied (PQ6)."""
    _move(spark, f"{path}/year_bucket={value}", to)


def attach_partition(spark: SparkSession, folder: str, path: str, value: str, year: str = "year") -> None:
    """The table at ``folder`` becomes a year partition; rows of other years are refused, nothing is copied (PQ6)."""
    strays = spark.read.parquet(folder).where(year_bucket(year) != value).limit(1).count()
    if strays:
        raise ValueError(f"{folder} holds years outside of {value}")
    _move(spark, folder, f"{path}/year_bucket={value}")


def drop_partition(spark: SparkSession, path: str, value: str) -> bool:
    """Delete one year partition; whether there was one (PQ6)."""
    p = spark._jvm.org.apache.hadoop.fs.Path
    return p(path).getFileSystem(spark._jsc.hadoopConfiguration()).delete(p(f"{path}/year_bucket={value}"), True)


def bucket_shares(papers: DataFrame) -> DataFrame:
    """(bucket, rows, first_year, last_year, share_pct) of the partitions, each single year apart (AG18)."""
    counts = papers.groupBy(year_bucket().alias("bucket")).agg(F.count("*").alias("rows"), F.min("year").alias("first_year"), F.max("year").alias("last_year"))
    return counts.withColumn("share_pct", F.round(F.col("rows") * 100.0 / F.sum("rows").over(Window.partitionBy()), 2))


def latest_run(runs: DataFrame, run_type: str) -> DataFrame:
    """The newest successful run of a type (SNK19, IN8)."""
    return runs.where((F.col("run_type") == run_type) & (F.col("status") == "success")).orderBy(F.desc("run_time")).limit(1)


def create_release(releases: DataFrame | None, release: DataFrame) -> DataFrame:
    """A release is created once; a second time leaves it alone (SNK20)."""
    return release if releases is None else incremental.insert_ignore(releases, release, ["release_id"], ["created_at"])


def release_status(releases: DataFrame, changes: DataFrame) -> DataFrame:
    """Releases with the newest change of each applied: columns that a change leaves null stay as they are (SNK20).

    ``changes(release_id, changed_at, ...)`` has some of the releases' columns; changes of unknown
    releases are left out.
    """
    own = [c for c in changes.columns if c in releases.columns and c != "release_id"]
    newest = changes.groupBy("release_id").agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("changed_at"))).alias(f"_{c}") for c in own])
    joined = releases.join(newest, "release_id", "left")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in own else F.col(c) for c in releases.columns])
