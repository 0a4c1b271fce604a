import math
import random

import numpy as np
import pytest

from stemma.llm import embeddings, neighbours
from tests.llm.cases import SF

KIND = "vec_id bigint, embedding array<float>, label int, cls string, tile string, list string, rank string"


def vectors(seed=3, n=300, d=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(30, d))
    rows = []
    for i in range(n):
        v = base[rng.integers(30)] + rng.normal(size=d) * rng.choice([0, 0.05, 0.12, 1.0])
        rows.append((i, [float(np.float32(x)) for x in v * rng.uniform(0.5, 2)], int(rng.integers(3))))
    rows += [(900, rows[3][1], rows[3][2]), (901, rows[3][1], rows[3][2]), (901, rows[3][1], rows[3][2]), (902, rows[3][1], None)]
    rows += [(903, None, 1), (904, [0.0] * d, 1), (905, [None] + [1.0] * (d - 1), 1), (906, [float("nan")] * d, 1), (907, [math.inf] + [0.0] * (d - 1), 1), (908, [1.0, 2.0], 1), (909, [], 1), (None, rows[5][1], rows[5][2])]
    return [r + ("q", "q", "q", "q") for r in rows]


def brute(rows, least=0.98):
    def sound(v):
        return v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    good = [i for i, r in enumerate(rows) if sound(r[1]) and r[2] is not None]
    links, root = [0] * len(rows), list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in good:
        for b in good:
            if a < b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[i][1]) / np.abs(rows[i][1]).max() for i in (a, b))
                if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= least:
                    links[a] += 1
                    links[b] += 1
                    root[find(b)] = find(a)
    low = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            low[find(i)] = min(low.get(find(i), r[0]), r[0])
    return sorted(((r[0], links[i], low.get(find(i)), r[0] is not None and r[0] == low.get(find(i))) for i, r in enumerate(rows)), key=str)


@pytest.mark.parametrize("tile", [7, 1024])
def test_near_duplicates_equal_brute_force(spark, tile):
    rows = vectors()
    got = embeddings.near_duplicates(spark.createDataFrame(rows, KIND).repartition(3), tile=tile).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)


def test_near_duplicates_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]
    assert sorted(map(tuple, embeddings.op7_embedding_dedup(spark, SF).collect()), key=str) == brute(rows)


def test_vectors_with_one_seeded_hash_are_no_class(spark):
    """Pairs whose xxHash64 with the vector before the seed is equal, far apart: the second by swapped halves."""
    rows = [(1, [1.0, 2.0], 0), (2, [5.0, 2.27e-273], 0), (3, [2.0, 1.0], 0), (4, [2.27e-273, 5.0], 0), (5, [0.0, 1.0], 0), (6, [-0.0, 1.0], 0), (7, [1.0, 1e-300], 0), (8, [1.0, 0.0], 0)]
    got = embeddings.near_duplicates(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")).collect()
    assert sorted(map(tuple, got)) == brute(rows)
    assert {r.vec_id: r.component_id for r in got} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 4, 6: 4, 7: 2, 8: 2}


def test_bounds_never_lose_a_pair():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(80, 24)) + 2
    axes = np.linalg.eigh(x.T @ x)[1][:, ::-1]
    c = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)
    i, j = embeddings.close_pairs(x, x, axes, 0.9, True)
    assert set(zip(i.tolist(), j.tolist())) == {(a, b) for a in range(80) for b in range(a + 1, 80) if c[a, b] >= 0.9}


def exact(rows, k=20):
    good = [(r[0], np.array(r[1], float)) for r in rows if r[0] is not None and r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])]
    return {q: sorted(((-float((x * v).sum()), i) for i, x in good if i != q and len(x) == len(v)))[:k] for q, v in good if q % 20 == 0}


def test_vectors_of_rare_lengths_and_sizes_link(spark):
    """Another length than most, components whose squares vanish or overflow, both zeros."""
    rows = [(1, [1.0, 2.0], 1), (2, [2.0, 1.0], 1), (3, [-1.0, 5.0], 1), (4, [3.0, 1.0, 2.0], 1), (5, [3.0, 1.0, 2.0], 1), (6, [3.0, 1.0, 2.1], 1), (7, [9.0], 1), (8, [7.0], 1), (9, [-7.0], 1)]
    rows += [(10, [1e-200, 1e-200], 2), (11, [1e200, 1e200], 2), (12, [1e200, -1e200], 2), (13, [1e-310, 1.01e-310], 2), (14, [0.0, 5.0], 3), (15, [-0.0, 5.0], 3), (16, [-0.0, 0.0], 3)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int")
    got = sorted(map(tuple, embeddings.near_duplicates(df).collect()), key=str)
    assert got == brute(rows)
    assert {r[0]: r[1] for r in got}[4] == 2 and {r[0]: r[1] for r in got}[10] == 2


def test_tiles_in_blocks_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "BLOCK", 5)
    rng = np.random.default_rng(2)
    x = rng.normal(size=(23, 6)) + 1
    c = x @ x.T / np.linalg.norm(x, axis=1)[:, None] / np.linalg.norm(x, axis=1)
    want = {(a, b) for a in range(23) for b in range(a + 1, 23) if c[a, b] >= 0.8}
    i, j = embeddings.blocks_of_pairs(x, None, np.eye(6), 0.8)
    assert set(zip(i.tolist(), j.tolist())) == want and len(i) == len(want)
    i, j = embeddings.blocks_of_pairs(x[:11], x[11:], np.eye(6), 0.8)
    assert set(zip(i.tolist(), j.tolist())) == {p for p in want if p[0] < 11 <= p[1]}


def test_search_by_lengths_and_repeated_queries(spark):
    rows = [(i, [float(i % 7), 1.0, float(i % 3)], 0) for i in range(60)] + [(100 + i, [float(i), 2.0], 0) for i in range(30)]
    rows += [(20, rows[20][1], 0), (40, [9.0, 9.0, 9.0], 0)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>, label int").repartition(3)
    got = neighbours.search(df, probes=1.0).collect()
    by = lambda q: sorted((r.rank, r.vec_id) for r in got if r.query_id == q)
    want = {q: [v for _, v in best] for q, best in exact(rows).items()}
    assert by(20) == list(enumerate(want[20], 1)) and by(100) == list(enumerate(want[100], 1))
    assert len(by(40)) == 40 and [r[0] for r in by(40)] == sorted(2 * list(range(1, 21)))  # two vectors of one id ask apart


@pytest.mark.parametrize("chunk", [4096, 1 << 20])
def test_recall_with_half_of_the_lists(spark, chunk):
    """Whatever the groups, at the shipped setting, against brute force on the whole table."""
    sf = "/root/testdata/sf0.1"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, hits = exact(rows), 0
    for r in neighbours.search(spark.read.parquet(f"{sf}/embeddings.parquet"), chunk=chunk).collect():
        hits += r.vec_id in {v for _, v in want[r.query_id]}
    assert hits >= 0.9 * 20 * len(want)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.1"])
def test_recall_and_order(spark, sf):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding").collect()]
    want, got = exact(rows), {}
    for r in neighbours.op10_ann(spark, sf).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert set(got) == set(want)
    hits = 0
    vec = {r[0]: np.array(r[1], float) for r in rows}
    for q, best in got.items():
        best.sort()
        assert [b[0] for b in best] == list(range(1, 21))
        assert [(-b[2], b[1]) for b in best] == sorted((-b[2], b[1]) for b in best)
        assert all(abs(b[2] - vec[q] @ vec[b[1]]) < 1e-12 for b in best)
        hits += len({b[1] for b in best} & {x[1] for x in want[q]})
    assert hits / (20 * len(want)) >= 0.9


def test_search_hard_rows_and_ties(spark):
    rows = vectors() + [(1000 + i, vectors()[0][1], 0, "q", "q", "q", "q") for i in range(200)]
    df = spark.createDataFrame(rows, KIND).repartition(3)
    got = neighbours.search(df, probes=1.0, rerank=200, chunk=64).collect()
    want = exact(rows)
    for q, best in want.items():
        assert sorted((r.rank, r.vec_id) for r in got if r.query_id == q) == list(enumerate([b[1] for b in best], 1))


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(20, [1.0, 2.0], 1)], [(20, [1.0, 0.0], 1), (40, [0.5, 1.0], None)]])
def test_few_rows(spark, rows):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    assert embeddings.near_duplicates(df).count() == len(rows)
    assert neighbours.search(df).count() == (2 if len(rows) == 2 else 0)


@pytest.mark.parametrize("size", [1.0, 1e25, 1e160, 1e300, 1e-200, 1e-310])
def test_search_of_any_magnitude(spark, size):
    rng = np.random.default_rng(12)
    plain = rng.normal(size=(60, 2)).round(3)
    rows = [(i, (v * size).tolist()) for i, v in enumerate(plain)]
    got = neighbours.search(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), probes=1.0).collect()
    assert len(got) == 60
    near = plain if size > 1e-300 else np.array([v for _, v in rows]) * 1e300 * 1e10  # digits are lost below 2e-308
    for q in (0, 20, 40):
        best = sorted((r.rank, r.vec_id, r.score) for r in got if r.query_id == q)
        want = sorted((-float(near[q] @ near[i]), i) for i in range(60) if i != q)[:20]
        assert [b[1] for b in best] == [w[1] for w in want]
        with np.errstate(over="ignore", under="ignore"):
            assert all(b[2] == np.float64(-w[0]) * size * size or abs(b[2] / (-w[0] * size * size) - 1) < 1e-12 for b, w in zip(best, want, strict=True))
