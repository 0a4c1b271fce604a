import os
import random

import pytest
from pyspark.sql import functions as F

from stemma.operators import authors
from stemma.plans import composed
from stemma.sources import buckets, tables
from tests.oracle import SF

KIND = "k bigint, name string, v int, w string"


def files(path):
    return {os.path.relpath(os.path.join(d, f), path) for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def rows_of(spark, path):
    return sorted(map(tuple, buckets.read(spark, path).collect()), key=str)


@pytest.mark.parametrize("filled", [False, True])
def test_many_batches_equal_a_dictionary(spark, tmp_path, filled):
    rng, path, want = random.Random(5), str(tmp_path / "t"), {}
    buckets.create(spark, path, spark.createDataFrame([], KIND), ["k", "name"], buckets=5, filled=filled)
    for step in range(7):
        batch = {}
        for _ in range(rng.choice([0, 3, 60])):
            key = (rng.choice([None, *range(30)]), rng.choice(["a", None]))
            batch[key] = (rng.choice([None, step]), rng.choice([None, f"s{step}"]))
        got = buckets.upsert(spark, path, spark.createDataFrame([(*k, *v) for k, v in batch.items()], KIND), most_deltas=3)
        assert got == (len(batch.keys() - want.keys()), len(batch.keys() & want.keys()))
        for k, v in batch.items():
            old = want.get(k, (None, None)) if filled else (None, None)
            want[k] = tuple(n if n is not None else o for n, o in zip(v, old, strict=True))
        if want:
            assert rows_of(spark, path) == sorted(((*k, *v) for k, v in want.items()), key=str)
    assert max(map(len, buckets.deltas(spark, path).values())) < 3
    buckets.compact(spark, path)
    assert all(len(d) == 1 for d in buckets.deltas(spark, path).values())
    assert rows_of(spark, path) == sorted(((*k, *v) for k, v in want.items()), key=str)


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    path = str(tmp_path / "t")
    base = spark.range(2000).select(F.col("id").alias("k"), F.lit("old").alias("v"))
    buckets.create(spark, path, base, ["k"], buckets=16)
    assert buckets.upsert(spark, path, base) == (2000, 0)
    before = files(path)
    few = base.where("k IN (3, 700)").withColumn("v", F.lit("new"))
    hit = {r[0] for r in few.select(buckets.bucket_of(["k"], 16)).collect()}
    assert buckets.upsert(spark, path, few) == (0, 2)
    assert before <= files(path)  # not even the old files of touched buckets are written again
    assert {f.split("/")[0] for f in files(path) - before} == {f"key_bucket={b}" for b in hit}
    buckets.compact(spark, path)
    assert {f for f in before if int(f.split("/")[0].split("=")[1]) not in hit} <= files(path)
    assert buckets.read(spark, path).where("v = 'new'").count() == 2


def test_a_delta_that_runs_again_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    new = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    buckets.create(spark, path, new, ["k"], buckets=4)
    assert buckets.upsert(spark, path, new, delta=1) == (2, 0)
    assert buckets.upsert(spark, path, new, delta=1) == (2, 0)
    assert rows_of(spark, path) == [(1, "a"), (2, "b")]


def test_refusals(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (1, "b")], "k int, v string")
    with pytest.raises(FileNotFoundError):
        buckets.upsert(spark, path, rows)
    buckets.create(spark, path, rows, ["k"])
    with pytest.raises(FileExistsError):
        buckets.create(spark, path, rows, ["k"])
    with pytest.raises(ValueError, match="repeated"):
        buckets.upsert(spark, path, rows)
    with pytest.raises(ValueError, match="delta"):
        buckets.create(spark, str(tmp_path / "u"), rows.withColumn("Delta", F.lit(1)), ["k"])
    assert buckets.read(spark, path) is None and buckets.layout(spark, path).keys == ("k",)


def papers(spark, path):
    rows = spark.createDataFrame([(i, 1990 + i % 8) for i in range(80)], "paper_id int, year int").withColumn("year_bucket", tables.year_bucket())
    tables.overwrite(rows, path, "year_bucket")
    return spark.read.parquet(path)


def test_replacing_a_year_leaves_other_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    table = papers(spark, path)
    # up to 2000 the years share partitions: take single years
    rows = spark.createDataFrame([(i, 2005 + i % 3) for i in range(30)], "paper_id int, year int").withColumn("year_bucket", tables.year_bucket())
    tables.replace_partitions(rows, path, "year_bucket")
    before = files(path)
    tables.replace_partitions(rows.where("year = 2006").withColumn("paper_id", -F.col("paper_id")), path, "year_bucket")
    gone = before - files(path)
    assert gone and all(f.startswith("year_bucket=2006/") for f in gone)
    again = spark.read.parquet(path)
    assert again.where("year = 2006").count() == again.where("year = 2006 AND paper_id <= 0").count() == 10
    assert again.count() == 30 + table.count()


def test_detach_attach_drop(spark, tmp_path):
    path, out = str(tmp_path / "t"), str(tmp_path / "out")
    rows = spark.createDataFrame([(i, 2005 + i % 3) for i in range(30)], "paper_id int, year int").withColumn("year_bucket", tables.year_bucket())
    tables.overwrite(rows, path, "year_bucket")
    assert set(tables.partition_folders(spark, path)) == {"2005", "2006", "2007"}
    tables.detach_partition(spark, path, "2006", out)
    assert spark.read.parquet(path).where("year = 2006").isEmpty() and spark.read.parquet(out).count() == 10
    with pytest.raises(ValueError, match="2008"):
        tables.attach_partition(spark, out, path, "2008")
    with pytest.raises(FileExistsError):
        tables.attach_partition(spark, tables.partition_folders(spark, path)["2005"], path, "2005")
    tables.attach_partition(spark, out, path, "2006")
    assert spark.read.parquet(path).count() == 30
    assert tables.drop_partition(spark, path, "2007") and not tables.drop_partition(spark, path, "2007")
    assert spark.read.parquet(path).count() == 20


def test_year_queries_read_only_their_partitions(spark):
    assert composed.papers_by_year(spark, SF) == composed.papers_by_year(spark, SF)
    plan = composed.partition_equality(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "year_bucket" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_h_index_of_an_author_with_many_papers(spark):
    rng = random.Random(1)
    rows = [(a, rng.choice([None, -1, *range(40)])) for a in range(30) for _ in range(rng.randint(1, 60))]
    got = dict(map(tuple, authors.h_index(spark.createDataFrame(rows, "a int, c int"), "a", "c").collect()))
    for a in range(30):
        cited = [c or 0 for x, c in rows if x == a]
        assert got[a] == max(h for h in range(len(cited) + 1) if sum(c >= h for c in cited) >= h)
    many = spark.range(1_000_000).select(F.lit("x").alias("a"), (F.col("id") % 3000).alias("c"))
    found = authors.h_index(many, "a", "c")
    assert found.first().h_index == 2991 and "Window" not in found._jdf.queryExecution().executedPlan().toString()


def test_a_large_year_partition_is_written_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 200_000, 1, 8).select("id", F.sha1(F.col("id").cast("string")).alias("text"), F.when(F.col("id") < 10, "2005").otherwise("1990-2000").alias("year_bucket"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        tables.overwrite(tables.dealt(rows, "year_bucket"), str(tmp_path / "t"), "year_bucket")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = {v: len(list((tmp_path / "t" / f"year_bucket={v}").glob("*.parquet"))) for v in ("2005", "1990-2000")}
    assert files["2005"] <= 2 < files["1990-2000"] and spark.read.parquet(str(tmp_path / "t")).count() == 200_000
