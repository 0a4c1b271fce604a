import itertools
import re
from collections import Counter

from stemma.llm import audit, registry
from tests.llm.cases import CLASH, DOCS, EXTRA, SF, folder, hard_rows, words
from tests.oracle import connection, duck_rows, spark_rows

LABELS = "doc_id bigint, quality int, toxic int"


def fails(rows):
    least = {}
    for i, t, *_ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, _, source, _ in rows:
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        yield i, source or "", {
            f for f, x in {
                "A": len(w) < 50, "B": 100 * len(set(w)) < 65 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 5 * len(t),
                "D": re.search(r"[#$%&*|]", t) is not None, "E": i is not None and i > least.get(t, i),
            }.items() if x
        }


def brute(rows, labels):
    good, toxic = ({i for i, q, x in labels if i is not None and (q, x)[k] == 1} for k in (0, 1))
    docs, out, total = list(fails(rows)), {}, Counter()
    for order in itertools.permutations("ABCDE"):
        for part in {p for _, p, _ in docs}:
            alive = [d for d in docs if d[1] == part]
            failing = {f: sum(f in d[2] for d in alive) for f in order}
            only = {f: sum(d[2] == {f} for d in alive) for f in order}
            for step, f in enumerate(order, 1):
                gone = [d for d in alive if f in d[2]]
                alive = [d for d in alive if f not in d[2]]
                total[part, f] += len(gone)
                out[part, "".join(order), step] = [len(alive), len(gone), failing[f] - len(gone), only[f], sum(d[0] in good for d in gone), sum(d[0] in toxic for d in gone)]
    return sorted((*k, *v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def cases():
    import random

    rng = random.Random(2)
    rows = hard_rows()
    rows += [(200 + i, words(rng, 80).title() + rng.choice(["", "#", " $ x", "|"]), "en", rng.choice(["a", "b", "", None]), 1) for i in range(60)]
    rows += [(300 + i, "Many copies of one line % " * 12, "en", rng.choice("ab"), 1) for i in range(300)]
    rows += [(None, "Many copies of one line % " * 12, "en", "a", 1), (250, "Many copies of one line % " * 12, "en", "b", 1), (250, "Many copies of one line % " * 12, "en", "b", 1)]
    labels = [(i, rng.randint(0, 1), rng.randint(0, 1)) for i in range(0, 600, 2)] + [(4, None, 1), (4, 1, None), (None, 1, 1), (None, 1, 1), (5, 1, 1)]
    return rows, labels


def test_equals_brute_force(spark):
    rows, labels = cases()
    wide = spark.createDataFrame([(*r, *EXTRA) for r in rows], CLASH).withColumnsRenamed({"n": "left", "shard": "part", "cell": "A", "row": "E", "ids": "digest", "start": "n"})
    for docs in (spark.createDataFrame(rows, DOCS), wide.repartition(3)):
        got = audit.filter_audit(docs, spark.createDataFrame(labels, LABELS))
        assert sorted(map(tuple, got.collect())) == brute(rows, labels)


def test_one_document_and_none(spark, tmp_path):
    rows = [(1, None, None, None, None)]
    got = audit.filter_audit(spark.createDataFrame(rows, DOCS), spark.createDataFrame([], LABELS)).collect()
    assert sorted(map(tuple, got)) == brute(rows, [])
    sf = folder(spark, tmp_path, spark.createDataFrame([], DOCS), labels=spark.createDataFrame([], LABELS))
    assert audit.op12_filter_audit(spark, sf).collect() == []


def test_equals_sql(spark):
    got, names = spark_rows(registry.QUERIES["op12_filter_audit"](spark, SF))
    want, expected = duck_rows(connection(SF), registry.ORACLES["op12_filter_audit"])
    assert names == expected and got == want
