import bisect
import math
import zlib
from collections import Counter

import pytest

from stemma.llm import sharding
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs


def check(rows, n):
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    sizes = [len(by.get(k, [])) for k in range(n)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(v) == list(range(len(v))) for v in by.values())


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_hard_rows(spark, tmp_path, make):
    docs = make(spark)
    rows = sharding.op3_sharding(spark, folder(spark, tmp_path, docs)).collect()
    want = Counter((r.doc_id, len((r.text or "").encode()) + 1, zlib.crc32((r.text or "").encode())) for r in docs.collect())
    assert Counter((r.doc_id, r["size"], r.text_crc32) for r in rows) == want
    check(rows, 8)


def test_whole_table_and_movement(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    eight = sharding.ring_shards(docs, keep=["doc_id"]).collect()
    nine = sharding.ring_shards(docs, keep=["doc_id"], n_shards=9).collect()
    check(eight, 8), check(nine, 9)
    a, b = ({r.doc_id: r.shard for r in x} for x in (eight, nine))
    assert 1 / 9 - 0.01 < sum(a[k] != b[k] for k in a) / len(a) < 0.25


def brute_ring(keys, nodes, capacity):
    """How many keys of each virtual node lie in each shard: rounds of offers clockwise, one key at a time."""
    places = sorted(nodes)
    left = Counter(bisect.bisect_left(places, k) % len(places) for k in keys)
    owner, room, out = [nodes[p] for p in places], list(capacity), Counter()
    prefer = [list(dict.fromkeys(owner[k:] + owner[:k])) for k in range(len(places))]
    for turn in range(len(capacity)):
        for arc in range(len(places)):
            while turn < len(prefer[arc]) and left[arc] and room[prefer[arc][turn]]:
                left[arc] -= 1
                room[prefer[arc][turn]] -= 1
                out[arc, prefer[arc][turn]] += 1
    return out


@pytest.mark.parametrize("load_factor", [None, 1.1])
def test_equals_a_ring_filled_key_by_key(spark, load_factor):
    n, vnodes = 3, 5
    docs = spark.range(400).selectExpr("if(id < 150, 7, id) AS doc_id", "id AS x")
    node = spark.range(n * vnodes).selectExpr(f"xxhash64('node', id % {n}, floor(id / {n})) AS at", f"int(id % {n}) AS shard")
    nodes = {r.at: r.shard for r in node.collect()}
    where = {r.x: r.at for r in docs.selectExpr("x", "xxhash64('key', doc_id, CAST(null AS struct<doc_id:bigint,x:bigint>)) AS at").collect()}
    rows = sharding.ring_shards(docs, n_shards=n, vnodes=vnodes, cell_bits=4, load_factor=load_factor).collect()
    capacity = [134, 133, 133] if load_factor is None else [math.ceil(400 * load_factor / n)] * n
    places = sorted(nodes)
    got = Counter((bisect.bisect_left(places, where[r.x]) % len(places), r.shard) for r in rows)
    assert len({r.x for r in rows}) == 400 and got == brute_ring(where.values(), nodes, capacity)


def test_load_factor_bounds(spark):
    rows = sharding.ring_shards(spark.range(2000).withColumnRenamed("id", "doc_id"), load_factor=1.1).collect()
    sizes = Counter(r.shard for r in rows)
    assert sum(sizes.values()) == 2000 and max(sizes.values()) <= 275


def test_one_key_for_many_rows(spark):
    rows = sharding.ring_shards(spark.range(900).selectExpr("cast(1 as bigint) AS doc_id", "id AS x")).collect()
    check(rows, 8)
    assert len({r.x for r in rows}) == 900
