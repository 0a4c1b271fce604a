import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from stemma.llm import suffixes
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs, words


def brute(texts, n=400):
    count = Counter(t[i : i + n] for t in texts for i in range(len(t) - n + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, np.int64)
        for i in range(len(t) - n + 1):
            if count[t[i : i + n]] > 1:
                gone[i] += 1
                gone[i + n] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        spans = int((np.diff(np.append(False, gone).astype(int)) == 1).sum())
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def repeats(seed, n=60):
    rng = random.Random(seed)
    common = words(rng, 400)
    rows = []
    for i in range(n):
        a = rng.randrange(len(common))
        piece = common[a : a + rng.choice([300, 398, 399, 400, 401, 402, 700, 1500])]
        rows.append(words(rng, rng.randint(0, 60)) + rng.choice(["", " ", "x"]) + piece + words(rng, rng.randint(0, 60)))
    rows += ["ab" * 300, "a" * 399, "a" * 400, "b" * 401, common + common, "é" * 250, words(rng, 2000, "ab")]
    return rows


@pytest.mark.parametrize("most", [2000, 1 << 19])
def test_repeats_equal_brute_force(spark, tmp_path, monkeypatch, most):
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", most)
    texts = repeats(most)
    sf = folder(spark, tmp_path, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3))
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.op6_suffix_dedup(spark, sf).collect()}
    want = dict(enumerate(brute([t.encode() for t in texts])))
    assert got == want


def test_one_minimiser_in_very_many_runs(spark, tmp_path, monkeypatch):
    """A passage in 1,500 different texts, of which some also share what stands beside it: no key fits an array at first."""
    monkeypatch.setattr(suffixes, "ARRAY_BYTES", 20_000)
    rng = random.Random(8)
    passage, left, right = (words(rng, 200)[:n] for n in (330, 80, 75))
    texts = [words(rng, 70)[:200] + (left if i % 7 == 0 else "") + passage + (right if i % 11 == 0 else "") + words(rng, 70)[:200] for i in range(1500)]
    sf = folder(spark, tmp_path, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3))
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.op6_suffix_dedup(spark, sf).collect()}
    assert got == dict(enumerate(brute([t.encode() for t in texts])))
    assert sum(r[1] > 0 for r in got.values()) > 200


def test_rows_are_numbered_alike_in_every_plan(spark, tmp_path, monkeypatch):
    """Splits that change between two reads of a table do not change which bytes go."""
    from stemma.llm import common

    texts = repeats(5)
    sf = folder(spark, tmp_path, spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(6))
    write = common.materialize

    def other_splits(*args, **named):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(2000 + 500 * random.randrange(40)))
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        return write(*args, **named)

    monkeypatch.setattr(suffixes, "materialize", other_splits)
    try:
        got = {r.doc_id: tuple(r)[1:] for r in suffixes.op6_suffix_dedup(spark, sf).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == dict(enumerate(brute([t.encode() for t in texts])))


def test_whole_table_equals_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    got = {r.doc_id: tuple(r)[1:] for r in suffixes.op6_suffix_dedup(spark, SF).collect()}
    assert got == {r.doc_id: x for r, x in zip(rows, brute([(r.text or "").encode() for r in rows]))}


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_hard_rows(spark, tmp_path, make):
    docs = make(spark)
    rows = docs.collect()
    got = suffixes.op6_suffix_dedup(spark, folder(spark, tmp_path, docs)).collect()
    want = [(r.doc_id, *x) for r, x in zip(rows, brute([(r.text or "").encode() for r in rows]))]
    assert Counter(map(tuple, got)) == Counter(want)


def test_long_text_in_blocks(monkeypatch):
    monkeypatch.setattr(suffixes, "BLOCK", 700)
    rng = random.Random(1)
    text = words(rng, 900).encode()
    seen = sorted((int(a), int(m)) for _, a, m, *_ in ((r, *x) for y in suffixes.runs_of([text]) for r, *x in zip(*y)))
    at = 0
    for a, m in seen:
        assert a == at
        at += m
    assert at == len(text) - 399


@pytest.mark.parametrize("seed", range(4))
def test_suffix_array_and_prefixes(seed):
    rng = np.random.default_rng(seed)
    t = np.append(rng.integers(1, [3, 257, 5, 2][seed], 700), 0).astype(np.uint16)
    t[300:450] = t[100:250]
    order, rolling = suffixes.suffix_array(t, 1000)
    listed = t.tolist()
    assert order.tolist() == sorted(range(len(t)), key=lambda i: listed[i:])
    lcp = suffixes.common_prefixes(order, 400, rolling)
    for a, b, n in zip(order[:-1], order[1:], lcp):
        k = 0
        while k < 400 and a + k < len(t) and b + k < len(t) and t[a + k] == t[b + k]:
            k += 1
        assert n == k
