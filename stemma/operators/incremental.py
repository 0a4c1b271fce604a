"""Upserts, insert-ignore, partial overwrites, new-or-stale selections (SNK1-SNK13, IN1-IN5, JN2-JN4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def first_of(rows: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """One row for each key, the first by ``order``: keep-first or latest-wins, by the given order."""
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_place", place).where("_place = 1").drop("_place")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], created: str | None = None) -> DataFrame:
    """Rows of ``new`` replace those of ``old`` with their key; ``created`` keeps its old value (SNK1, SNK4)."""
    if created:
        before = old.select(*keys, F.col(created).alias("_created"))
        new = new.join(before, keys, "left").withColumn(created, F.coalesce("_created", created)).drop("_created")
    return old.join(new.select(*keys), keys, "left_anti").unionByName(new.select(*old.columns))


def upsert_filled(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Only values that are not null replace old ones; new keys are added (SNK2, PRJ11)."""
    values = [c for c in old.columns if c not in keys]
    fresh = new.select(*keys, *[F.col(c).alias(f"_{c}") for c in values])
    joined = old.join(fresh, keys, "full_outer")
    return joined.select(*[F.coalesce(f"_{c}", c).alias(c) if c in values else F.col(c) for c in old.columns])


def insert_ignore(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column | str]) -> DataFrame:
    """New keys only, the first row of each (SNK5)."""
    fresh = first_of(new, keys, order).join(old.select(*keys), keys, "left_anti")
    return old.unionByName(fresh.select(*old.columns))


def upsert_counts(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """One row (inserted, updated) for an upsert of ``new`` (SNK6, SNK24, JN13)."""
    known = old.select(*keys).distinct().withColumn("_known", F.lit(True))
    marked = new.select(*keys).distinct().join(known, keys, "left")
    return marked.agg(F.count_if(F.col("_known").isNull()).alias("inserted"), F.count_if("_known").alias("updated"))


def replace_batch(old: DataFrame, new: DataFrame, batch_key: str) -> DataFrame:
    """All old rows of a re-processed batch key go, the new ones come (SNK10)."""
    return old.join(new.select(batch_key).distinct(), batch_key, "left_anti").unionByName(new.select(*old.columns))


def delete_where(old: DataFrame, gone: Column) -> tuple[DataFrame, DataFrame]:
    """What stays and a one-row count of what went (SNK13)."""
    return old.where(~F.coalesce(gone, F.lit(False))), old.agg(F.count_if(gone).alias("deleted"))


def missing_or_stale(papers: DataFrame, linked: DataFrame, key: str) -> DataFrame:
    """Papers without a linked row, updated after it, or linked without a remote id (JN2, IN2).

    ``papers(key, updated_at)``, ``linked(key, linked_at, remote_id)``.
    """
    joined = papers.join(linked, key, "left")
    stale = F.col("linked_at").isNull() | (F.col("updated_at") > F.col("linked_at")) | (F.coalesce("remote_id", F.lit("")) == "")
    return joined.where(stale).select(*[papers[c] if c != key else F.col(key) for c in papers.columns])


def new_or_updated(papers: DataFrame, authorships: DataFrame, key: str) -> DataFrame:
    """Papers with no authorship, or with one older than the paper's update (JN4, IN1): one aggregation, one join."""
    oldest = authorships.groupBy(key).agg(F.min("created_at").alias("_oldest"))
    joined = papers.join(oldest, key, "left")
    return joined.where(F.col("_oldest").isNull() | (F.col("updated_at") > F.col("_oldest"))).drop("_oldest")


def stale_ids(ids: DataFrame, cache: DataFrame, key: str, older_than: Column) -> DataFrame:
    """Different ids that the cache lacks or holds from before ``older_than`` (JN3, IN3)."""
    wanted = ids.select(key).where(F.col(key).isNotNull()).distinct()
    joined = wanted.join(cache.select(key, "updated_at"), key, "left")
    return joined.where(F.col("updated_at").isNull() | (F.col("updated_at") < older_than)).select(key)


def files_to_load(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Files of the release that no loaded row names (SRC9, IN5)."""
    return files.join(loaded.select("source_file").distinct(), "source_file", "left_anti")


def dedupe_clean(rows: DataFrame, key: str, title: str, order: list[Column | str], numbers: list[str] = (), texts: list[str] = ()) -> DataFrame:
    """Rows with a key and a title, numbers coerced (0 for bad ones), text null as '', first of each key (PRJ7, T16)."""
    good = rows.where(F.col(key).isNotNull() & (F.trim(F.coalesce(title, F.lit(""))) != ""))
    for c in numbers:
        good = good.withColumn(c, F.coalesce(F.expr(f"try_cast(`{c}` AS bigint)"), F.lit(0)))
    for c in texts:
        good = good.withColumn(c, F.coalesce(c, F.lit("")))
    return first_of(good, [key], order)


def seeded_sample(rows: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """``n`` rows that ``seed`` decides through a hash of the key, whatever the partitions; a top-n, no full sort (SO6)."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def missing_keys(wanted: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Different keys of ``wanted`` that ``held`` lacks; null is no key (ST2)."""
    return wanted.select(key).where(F.col(key).isNotNull()).distinct().join(held.select(key), key, "left_anti")


def id_ranges(rows: DataFrame, key: str, n: int) -> DataFrame:
    """``rows`` with ``part``: which of ``n`` equally wide ranges of the ids, from the least to the greatest, holds it (SO5).

    The last range takes the remainder; with fewer ids than ranges some parts are empty.
    """
    low, high = rows.agg(F.min(key), F.max(key)).first()
    width = max(1, ((high or 0) - (low or 0)) // n)
    return rows.withColumn("part", F.least(F.floor((F.col(key) - (low or 0)) / width), F.lit(n - 1)).cast("int"))
