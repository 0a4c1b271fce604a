import random
import re
from collections import Counter

import numpy as np
import pytest

from stemma.llm import phrases, registry
from tests.llm.cases import CLASH, DOCS, EXTRA, SF, empty_docs, hard_rows
from tests.oracle import connection, duck_rows, spark_rows


def pieces(text):
    text = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", text)]


def counted(rows):
    f, n = Counter(), Counter()
    for _, text, lang, *_ in rows:
        lang = lang or "und"
        for w in pieces(text):
            n[lang] += len(w)
            for k in range(1, 6):
                f.update((lang, tuple(w[i : i + k])) for i in range(len(w) - k + 1))
    return f, n


def brute(rows, least, top):
    f, n = counted(rows)
    cands = {k: v for k, v in f.items() if len(k[1]) > 1 and v >= least}
    found = {}
    for (lang, w), a in cands.items():
        longer = [v for (o, x), v in cands.items() if o == lang and len(x) > len(w) and any(x[i : i + len(w)] == w for i in range(len(x)))]
        if any(100 * v >= 100 * a for v in longer):
            continue
        cuts = [(1000 * a * n[lang] // (f[lang, w[:k]] * f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], n[lang]))
    return sorted((lang, rank, p.decode(), -a, x, y, m, -s) for lang, rows in found.items() for rank, (s, a, p, x, y, m) in enumerate(sorted(rows)[:top], 1))


def prose(seed=3):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(30)] + ["É", "é", "日本", "a", "A", "x" * 40]
    rows = []
    for i in range(200):
        w = [vocabulary[min(int(rng.expovariate(0.15)), len(vocabulary) - 1)] for _ in range(rng.randint(0, 60))]
        rows.append((i, "".join(x + rng.choice([" ", " ", " ", "  ", "\t", ". ", ", ", "\n", "?", "\x0b"]) for x in w), rng.choice(["en", "de", None]), "s", 1))
    return rows + [(900, "one fixed idiom here " * 40, "en", "s", 1), (901, "a a a a a a a", "en", "s", 1), (902, "!!..,", "fr", "s", 1), (903, None, "xx", None, None)]


@pytest.mark.parametrize("least,top", [(3, 25), (9, 2000)])
def test_equals_brute_force(spark, least, top):
    rows = prose() + hard_rows()
    wide = [(*r, *EXTRA) for r in rows]
    for docs in (spark.createDataFrame(rows, DOCS).repartition(5), spark.createDataFrame(wide, CLASH).withColumnsRenamed({"shard": "phrase", "cell": "f", "row": "size"})):
        got = sorted(map(tuple, phrases.collocations(docs, least, top).collect()))
        assert got == brute(rows, least, top) and got


@pytest.mark.parametrize("shard", [1, 3, 7, 50, 10_000])
def test_automata_count_every_occurrence(shard):
    texts = [(t or "").encode() for _, t, *_ in prose()]
    words = phrases.Words(texts, "en")
    full = np.full(phrases.DEPTH * (1 << 16) // 8, 255, np.uint8)
    single = full.copy()
    for at in phrases.cells(words.hashes[[words.vocabulary.index("w3")]], 1 << 16):
        single[at >> 3] &= ~(1 << (at & 7)).astype(np.uint8)
    bounds = phrases.Bounds(single, full, full)
    got = Counter()
    for names, _, counts in phrases.shard_counts(words, bounds, shard):
        assert len(set(names)) == len(names) and counts.min() > 0
        got.update(dict(zip(names, counts.tolist(), strict=True)))
    f, _ = counted([(0, t, "en") for _, t, *_ in prose()])
    assert got == {" ".join(w): v for (_, w), v in f.items() if len(w) > 1 and "w3" not in w}


def test_bounds_are_never_too_low(spark):
    rows = prose()
    words = phrases.Words([(t or "").encode() for _, t, *_ in rows], "en")
    docs = spark.createDataFrame([("en", t or "") for _, t, *_ in rows], "lang string, text string").repartition(4)
    bits = phrases.sketch(docs, 1 << 16, 20, lambda w: iter([w.hashes[w.ids]]))
    often = np.bincount(words.ids) >= 20
    assert phrases.frequent(bits, words.hashes)[often].all() and not phrases.frequent(bits, words.hashes)[~often].all()


def test_no_words(spark):
    assert phrases.collocations(empty_docs(spark)).collect() == []
    assert phrases.collocations(spark.createDataFrame([(1, None, None, None, 1), (2, " .\n", "en", None, 1)], DOCS), 1).collect() == []


def test_equals_sql(spark):
    got, names = spark_rows(registry.QUERIES["op13_collocations"](spark, SF))
    want, expected = duck_rows(connection(SF), registry.ORACLES["op13_collocations"])
    assert names == expected and got == want and got
