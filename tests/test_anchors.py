import math

import numpy as np
import pytest

from stemma.operators import anchors

ROWS, HELD = "id bigint, vector array<double>", "conference string, ord bigint, vector array<double>"


def brute(rows, held, least):
    out = {}
    for i, x in rows:
        if x is None or not all(v is not None and math.isfinite(v) for v in x) or not any(x):
            continue
        scored = []
        for name, k, a in held:
            if len(a) == len(x) and any(a):
                p, q = (np.array(v) / np.abs(v).max() for v in (x, a))
                scored.append((round(float(p @ q / np.sqrt((p @ p) * (q @ q))), 13), -k, name))
        if scored and max(scored)[0] >= least:
            out[i] = max(scored)[2]
    return out


@pytest.mark.parametrize("block,most", [(1024, 1 << 27), (7, 1 << 27), (16, 2000)])
def test_equals_brute_force(spark, monkeypatch, block, most):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(9, 12))
    near = lambda: (base[rng.integers(9)] + rng.normal(size=12) * 0.4).tolist()
    held = [(f"a{k}", k, near()) for k in range(60)] + [("twin", 99, None), ("copy", 70, [0.0] * 12), ("short", 71, [1.0, 0.0])]
    held[61 - 1] = ("twin", 99, held[5][2])  # an equal anchor later loses
    rows = [(i, near()) for i in range(120)] + [(200, held[5][2]), (201, None), (202, [0.0] * 12), (203, [1.0, 1.0]), (204, [math.nan] * 12), (205, [v * 1e200 for v in near()]), (206, [v * 1e-200 for v in near()]), (207, [-v for v in held[3][2]])]
    monkeypatch.setattr(anchors, "MOST_BYTES", most)
    monkeypatch.setattr(anchors, "BLOCK", block)
    df = anchors.best_anchor(spark.createDataFrame(rows, ROWS).repartition(3), spark.createDataFrame(held, HELD), 0.7)
    assert {r.id: r.conference for r in df.collect()} == brute(rows, [h for h in held if h[2]], 0.7)
    assert "NestedLoop" not in df._jdf.queryExecution().executedPlan().toString()
    again = anchors.best_anchor(spark.createDataFrame(rows, ROWS), spark.createDataFrame([], HELD), 0.7)
    assert again.collect() == []


def test_many_anchors_are_left_out_by_their_bounds(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(40, 32))
    vectors = base[rng.integers(40, size=50_000)] + rng.normal(size=(50_000, 32)) * 0.02
    own = anchors.Anchors(vectors, np.arange(50_000))
    asked = vectors[::500] + rng.normal(size=(100, 32)) * 0.01
    place, score = own.best(asked, 0.5)
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    every = asked / np.linalg.norm(asked, axis=1, keepdims=True) @ unit.T
    assert np.allclose(score, every.max(1)) and (place == every.argmax(1)).all()
    assert own.skipped > own.seen / 2
    df = anchors.best_anchor(spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(asked)], ROWS), spark.createDataFrame([(str(k), k, v) for k, v in enumerate(vectors[:20_000].tolist())], HELD), 0.5)
    assert df.count() == 100


def test_a_part_name_is_turned_into_a_vector_once(spark):
    """The letters are counted above the aggregate by name, not for each part."""
    from stemma.plans import composed
    from tests.oracle import SF

    plan = composed.kept_anchor_match(spark, SF)._jdf.queryExecution().optimizedPlan().toString().split("MapInArrow")[1]
    assert "Aggregate [p_name" in plan and "abcdef" not in plan.split("Aggregate [p_name")[1] and "replace(" not in plan.split("Aggregate [p_name")[1].split("Relation")[0]
