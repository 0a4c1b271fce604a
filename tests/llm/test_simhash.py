import random
from collections import Counter
from itertools import combinations

import numpy as np
import pytest
import xxhash

from stemma.llm import simhash
from stemma.llm.common import connected_components
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs, words


def brute_fp(text, k):
    w = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not w:
        return 0
    hs = [xxhash.xxh64_intdigest(b" ".join(w[i : i + k]), 42) for i in range(max(1, len(w) - k + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in linked:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs, None])
def test_groups_equal_brute_force(spark, tmp_path, make):
    docs = make(spark) if make else spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    got = simhash.op9_simhash(spark, folder(spark, tmp_path, docs)).collect()
    fps = {r.text: brute_fp(r.text, 3) for r in rows}
    comp = brute_components(set(fps.values()), [(a, b) for a, b in combinations(set(fps.values()), 2) if (a ^ b).bit_count() <= 2])
    low = {}
    for r in rows:
        if r.doc_id is not None:
            c = comp[fps[r.text]]
            low[c] = min(low.get(c, r.doc_id), r.doc_id)
    want = Counter((r.doc_id, f"{fps[r.text]:016x}", low.get(comp[fps[r.text]])) for r in rows)
    assert Counter(map(tuple, got)) == want


def test_tally_rejects_what_shares_too_few_bytes():
    """Rows of one list share four bytes; two more must agree, and then the bits count."""
    low = 0x1122334400000000
    fps = np.array([low, low | 0x0101, low | 0x010101, low | 0x7, low | 0x3], "<u8")
    combo = np.full(len(fps), simhash.WORDS.index((2, 3)), np.int32)
    pairs = {(int(a), int(b)) for x, y in simhash._links(combo, np.full(len(fps), -1), fps, np.array([0])) for a, b in zip(x, y)}
    assert pairs == set()  # every close pair here agrees in an earlier list too
    combo[:] = simhash.WORDS.index((1, 2))
    fps = np.array([0x5500332211440000, 0x5600332211440001, 0x5600332211440101, 0x5500332211440100], "<u8")
    i, j = (x.ravel() for x in np.triu_indices(4, 1))
    apart = fps[i] ^ fps[j]
    shared = (apart.view(np.uint8).reshape(-1, 8) == 0).sum(1)
    assert (shared < simhash.MIN_SHARED).any() and (shared >= simhash.MIN_SHARED).any()
    a, b = simhash._tallied(combo, np.full(4, -1), fps, i, j)
    got = set(zip(a.tolist(), b.tolist()))
    assert all((x ^ y).bit_count() <= 2 for x, y in got)
    assert not got & {(int(fps[x]), int(fps[y])) for x, y, n in zip(i, j, shared) if n < simhash.MIN_SHARED}


@pytest.mark.parametrize("longest", [20, 4096])
def test_links_equal_brute_force_in_dense_lists(spark, monkeypatch, longest):
    monkeypatch.setattr(simhash, "LONG_LIST", longest)
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(40)]
    fps = {b ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(0, 4))) & (1 << 64) - 1 for b in base for _ in range(20)}
    fps |= {base[0] ^ (i << 8) for i in range(300)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    got = simhash.link_fingerprints(spark.createDataFrame([(x,) for x in signed], "fp bigint")).collect()
    pairs = [frozenset((r.a & (1 << 64) - 1, r.b & (1 << 64) - 1)) for r in got]
    want = {frozenset(p) for p in combinations(fps, 2) if (p[0] ^ p[1]).bit_count() <= 2}
    assert set(pairs) == want and len(pairs) == len(want)


@pytest.mark.parametrize("shape", ["path", "star", "random", "none"])
def test_components(spark, shape):
    rng = random.Random(2)
    edges = {
        "path": [(i, i + 1) for i in range(200)],
        "star": [(7, i) for i in range(300)] + [(1, 1)],
        "random": [(rng.randrange(400), rng.randrange(400)) for _ in range(250)],
        "none": [],
    }[shape]
    got = connected_components(spark.createDataFrame(edges + [(None, 3)], "a bigint, b bigint")).collect()
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert sorted((r.node, r.component) for r in got) == sorted(brute_components(nodes, edges).items())


def jaccard(a, b):
    x, y = (set(simhash.shingle_hashes(t.encode(), 5).tolist()) for t in (a, b))
    return len(x & y) / max(1, len(x | y))


def test_near_copies_found_and_others_left(spark):
    rng = random.Random(9)
    texts, pairs = [], []
    for _ in range(150):
        w = words(rng, rng.randint(30, 400)).split()
        v = list(w)
        for _ in range(rng.randint(0, max(1, len(w) // 60))):
            v[rng.randrange(len(v))] = "changed"
        pairs.append((len(texts), len(texts) + 1))
        texts += [" ".join(w), " ".join(v)]
    texts += [words(rng, n) for n in (1, 1, 2, 3, 5, 6, 7) for _ in range(30)]
    df = spark.createDataFrame(list(enumerate(texts)), "rid bigint, text string").repartition(4)
    got = {(r.a, r.b) for r in simhash.near_copy_links(df).collect()}
    sims = {p: jaccard(texts[p[0]], texts[p[1]]) for p in pairs}
    close = [p for p, j in sims.items() if j >= 0.8]
    assert len(close) > 50 and sum(p in got for p in close) >= 0.95 * len(close)
    assert all(jaccard(texts[a], texts[b]) >= 0.8 for a, b in got)


def test_partners_in_lists_equal_brute_force(monkeypatch):
    rng = np.random.default_rng(3)
    g = np.sort(np.append(rng.integers(0, 200, 900), np.full(300, 77)))
    c = np.where(rng.random(len(g)) < 0.6, 5, rng.integers(0, 50, len(g)))
    w = rng.integers(0, 1 << 63, (len(g), 4), dtype=np.uint64)
    near = np.flatnonzero(rng.random(len(g)) < 0.3)
    w[near] = w[near - 1] ^ np.uint64(0b1011)
    want = np.zeros(len(g), bool)
    for i in range(len(g)):
        for j in range(i + 1, len(g)):
            if g[i] == g[j] and c[i] != c[j] and sum(int(x).bit_count() for x in w[i] ^ w[j]) <= simhash.SOME_APART:
                want[i] = want[j] = True
    assert want.any() and (simhash._with_partner(g, c, w) == want).all()


def test_near_copies_inside_a_template(spark, monkeypatch):
    """Each text is similar by 0.7 to all others and by 0.84 to one; long lists go in several blocks."""
    monkeypatch.setattr(simhash, "BLOCK", 8)
    monkeypatch.setattr(simhash, "LIST_ROWS", 20)
    rng = random.Random(4)
    template, texts = words(rng, 165).split(), []
    for i in range(400):
        own = [f"{rng.getrandbits(40):x}" for _ in range(40)]
        texts += [" ".join(template + own), " ".join(template + own[:-17] + [f"{i}x{j}" for j in range(17)])]
    pairs = [(i, i + 1) for i in range(0, len(texts), 2)]
    assert all(jaccard(texts[a], texts[b]) > 0.83 for a, b in pairs) and jaccard(texts[0], texts[2]) < 0.72
    order = list(range(len(texts)))
    rng.shuffle(order)
    df = spark.createDataFrame([(order[i], t) for i, t in enumerate(texts)], "rid bigint, text string").repartition(4)
    got = {(r.a, r.b) for r in simhash.near_copy_links(df).collect()}
    want = {tuple(sorted((order[a], order[b]))) for a, b in pairs}
    assert got <= want and len(got) >= 0.97 * len(want)


@pytest.mark.parametrize("kind", ["equal sizes", "one contains the other"])
def test_near_copies_at_the_threshold(spark, kind):
    """Similarities from just below 0.8 to exactly 0.8 and just above: only those of 0.8 link, and nearly all of them."""
    rng = random.Random(6)
    texts = []
    for i in range(600):
        n = 180 if kind == "equal sizes" else 160
        off = i % 5 - 2  # shingles more or fewer than at exactly 0.8
        w = [f"{rng.getrandbits(40):x}" for _ in range(n + 4)]
        more = [f"{rng.getrandbits(40):x}" for _ in range((20 if n == 180 else 40) - off)]
        texts += [" ".join(w), " ".join((w[len(more) :] if n == 180 else w) + more)]
    df = spark.createDataFrame(list(enumerate(texts)), "rid bigint, text string").repartition(4)
    got = {(r.a, r.b) for r in simhash.near_copy_links(df).collect()}
    sims = {(i, i + 1): jaccard(texts[i], texts[i + 1]) for i in range(0, len(texts), 2)}
    assert min(sims.values()) > 0.77 and sum(j == 0.8 for j in sims.values()) >= 100
    want = {p for p, j in sims.items() if j >= 0.8}
    assert got <= want and len(got) >= 0.985 * len(want)


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_one_of_each_group_stays(spark, tmp_path, make):
    sf = folder(spark, tmp_path, make(spark).repartition(3))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = simhash.keep_one_of_each_group(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    texts = Counter(" ".join((r.text or "").lower().split()) for r in rows)
    assert all(n == 1 for n in texts.values())
    want = {" ".join((r.text or "").lower().split()) for r in docs.collect()}
    assert len(want) - len(texts) <= 2  # a near copy may go too
