from collections import Counter
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from stemma.llm import chunkdedup, quality, simhash
from stemma.llm.bpe import default_vocabulary, encoder
from tests.llm.cases import clash_docs, empty_docs, folder, hard_docs
from tests.llm.test_chunkdedup import brute
from tests.llm.test_simhash import brute_components

LABELS = "doc_id bigint, quality int, toxic int"


def stages(spark, sf, path):
    """The rows of each stage, each read from Parquet as the pipeline's driver does."""
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, sf).write.parquet(f"{path}/{k}")
        docs = spark.read.parquet(f"{path}/{k}")
        out.append(docs)
    return out


def test_whole_table_against_brute_force(spark, tmp_path):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, two, three, four = stages(spark, sf, tmp_path)
    assert one.columns == two.columns == three.columns == docs.columns
    # the classifier: what it scores below the threshold goes, and most good documents stay
    good = {r.doc_id for r in quality.op8_quality_classifier(spark, sf).where("predicted = 1").collect()}
    first = one.collect()
    assert sorted(r.doc_id for r in first) == sorted(good)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = [labels[r.doc_id] for r in first if r.doc_id in labels]
    assert sum(kept) >= 0.97 * sum(labels.values()) and np.mean(kept) > 0.97
    # near copies: of every group one stays; what goes is similar to something
    sets = {r.doc_id: set(simhash.shingle_hashes(r.text.encode(), 5).tolist()) for r in first}
    sims = {(a, b): len(sets[a] & sets[b]) / max(1, len(sets[a] | sets[b])) for a, b in combinations(sorted(sets), 2) if sets[a] & sets[b] or sets[a] == sets[b]}
    second = {r.doc_id for r in two.collect()}
    close = [p for p, j in sims.items() if j >= 0.8]
    assert sum(a in second and b in second for a, b in close) <= 0.05 * len(close)
    loose = brute_components(sets, [p for p, j in sims.items() if j >= 0.8])
    assert {loose[d] for d in second} == set(loose.values())
    # passages: as one pass over the texts in reading order
    rows = sorted(two.select("*", "_metadata.file_path", "_metadata.row_index").collect(), key=lambda r: (r.file_path, r.row_index))
    spans = brute([(0, r.text.encode()) for r in rows])
    got = {r.doc_id: r.text for r in three.collect()}
    assert len(got) == len(rows)
    for i, r in enumerate(rows):
        t, out, at = r.text.encode(), b"", 0
        for a, b in spans[i]:
            out, at = out + t[at:a], b
        assert got[r.doc_id].encode() == out + t[at:]
    assert all(r.n_chars == len(r.text) for r in three.collect())
    # packing: every id once
    ids = dict(zip(got, encoder(default_vocabulary()).encode(list(got.values())), strict=True))
    pieces = four.collect()
    at = Counter()
    for r in sorted(pieces, key=lambda r: (r.doc_id, r.start)):
        assert r.start == at[r.doc_id] and bytes(r.ids) == (ids[r.doc_id] + b"\0\0\0\0")[4 * r.start : 4 * (r.start + r.length)]
        at[r.doc_id] += r.length
    assert at == Counter({d: len(x) // 4 + 1 for d, x in ids.items()})
    assert corpus_pipeline.run(spark, sf).count() == len(pieces)


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_hard_rows(spark, tmp_path, make):
    sf = folder(spark, tmp_path, make(spark), labels=spark.createDataFrame([(1, 1, 0), (None, None, None)], LABELS))
    out = stages(spark, sf, tmp_path / "out")
    assert out[0].count() == make(spark).count()
    assert {r.doc_id for r in out[3].select("doc_id").collect()} == {r.doc_id for r in out[2].select("doc_id").collect()}
