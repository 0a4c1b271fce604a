import os
import random

import pytest
from pyspark.sql import functions as F

from stemma.operators import maintained
from stemma.plans import profiles
from stemma.sources import buckets, manifests, tables
from tests.test_buckets import files


def frames(spark, papers):
    auth = [(p, a, k) for p, (_, _, names) in papers.items() for k, a in enumerate(names)]
    facts = [(p, y, c) for p, (y, c, _) in papers.items()]
    return spark.createDataFrame(auth, "paper_id int, author_id int, position int"), spark.createDataFrame(facts, "paper_id int, year int, citations bigint")


def test_every_batch_equals_the_full_computation(spark, tmp_path):
    rng, path, now = random.Random(3), str(tmp_path / "state"), {}
    paper = lambda: (rng.choice([None, 1990, 1999, 2000, 2001]), rng.choice([None, 0, 5, 9]), rng.sample(range(12), rng.randint(1, 4)))
    for step in range(4):
        come = {p: paper() for p in rng.sample(range(60), 25 if step == 0 else 6)}
        gone = {p: now[p] for p in come if p in now} | {p: now[p] for p in rng.sample(sorted(now), min(len(now), 4))}
        for p in gone:
            now.pop(p)
        now |= come
        maintained.change(spark, path, maintained.contributions(*frames(spark, come)), maintained.contributions(*frames(spark, gone)) if gone else None, size=4)
        got = profiles.finished(maintained.yearly_totals(buckets.read(spark, path), 2001), 2001)
        want = profiles.author_profile(*frames(spark, now), 2001)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_only_the_buckets_of_changed_authors_are_written(spark, tmp_path):
    path = str(tmp_path / "state")
    papers = {p: (2000, 1, [p % 50]) for p in range(200)}
    maintained.change(spark, path, maintained.contributions(*frames(spark, papers)), size=32)
    before = files(path)
    assert maintained.change(spark, path, maintained.contributions(*frames(spark, {900: (2000, 4, [7])})), size=32) == 1
    assert before <= files(path) and len(files(path) - before) == 1
    with pytest.raises(ValueError, match="not added"):
        maintained.change(spark, path, None, maintained.contributions(*frames(spark, {901: (1950, 4, [7])})))


def test_manifests(spark, tmp_path):
    path, store = str(tmp_path / "t"), str(tmp_path / "store")
    rows = spark.range(100).select("id", F.concat(F.lit("x"), "id").alias("v"), (F.col("id") % 3).alias("p"))
    rows.repartition(3).write.partitionBy("p").parquet(path)
    assert manifests.snapshot(spark, path, store, "a").where("copied").count() == len(files(path))
    before = files(store + "/contents")
    assert manifests.snapshot(spark, path, store, "b").where("copied").count() == 0
    assert files(store + "/contents") == before and manifests.names(spark, store) == ["a", "b"]
    assert manifests.damaged(spark, path, store, "a").collect() == []
    tables.replace_partitions(rows.where("p = 1 AND id < 50"), path, "p")
    assert {r.fault for r in manifests.damaged(spark, path, store, "a").collect()} == {"missing", "unknown"}
    some = manifests.snapshot(spark, path, store, "c")
    assert 0 < some.where("copied").count() < some.count()
    victim = next(f for f in files(path) if f.startswith("p=0"))
    at = os.path.join(path, victim)
    os.remove(os.path.join(os.path.dirname(at), f".{os.path.basename(at)}.crc"))  # a local file system's own check
    with open(at, "r+b") as f:
        f.seek(8)
        f.write(b"\x00\x01\x02")
    assert [tuple(r) for r in manifests.damaged(spark, path, store, "c").collect()] == [(victim, "changed")]
    back = manifests.restore(spark, store, "a", str(tmp_path / "back"))
    assert sorted((r.id, r.v, r.p) for r in back.collect()) == [(i, f"x{i}", i % 3) for i in range(100)]
    assert {f.split("/")[0] for f in files(str(tmp_path / "back"))} == {"p=0", "p=1", "p=2"}
    with pytest.raises(FileExistsError):
        manifests.restore(spark, store, "a", str(tmp_path / "back"))
    contents = spark.read.parquet(store + "/contents").withColumn("content", F.when(F.col("sum") == some.first()["sum"], F.lit(b"x")).otherwise(F.col("content")))
    contents.write.parquet(str(tmp_path / "broken/contents"))
    spark.read.parquet(store + "/manifests/c").write.parquet(str(tmp_path / "broken/manifests/c"))
    with pytest.raises(ValueError, match="damaged"):
        manifests.restore(spark, str(tmp_path / "broken"), "c", str(tmp_path / "never"))
