import random

import numpy as np
import pytest

from stemma.llm import chunkdedup
from tests.llm.cases import clash_docs, empty_docs, folder, hard_docs, words


def brute(rows, min_run=64):
    """rows: (order key, bytes) -> removed spans of each."""
    seen, out = set(), {}
    for i, (_, text) in sorted(enumerate(rows), key=lambda x: (x[1][0], x[0])):
        spans, run, at = [], None, 0
        for end in chunkdedup.boundaries([text])[0] if text else []:
            if text[at:end] in seen:
                run = (run[0] if run else at, end)
            else:
                if run and run[1] - run[0] >= min_run:
                    spans.append(run)
                run = None
            seen.add(text[at:end])
            at = end
        if run and run[1] - run[0] >= min_run:
            spans.append(run)
        out[i] = spans
    return out


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_equals_brute_force(spark, tmp_path, make):
    sf = folder(spark, tmp_path, make(spark).coalesce(1))
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    got = sorted(map(tuple, chunkdedup.op2_substring_dedup(spark, sf).collect()), key=str)
    spans = brute([(0, (r.text or "").encode()) for r in docs])
    want = []
    for i, r in enumerate(docs):
        t, kept, at = (r.text or "").encode(), b"", 0
        for a, b in spans[i]:
            kept, at = kept + t[at:a], b
        kept += t[at:]
        want.append((r.doc_id, None if r.text is None else kept.decode(), len(t), len(t) - len(kept), len(spans[i])))
    assert got == sorted(want, key=str)


@pytest.mark.parametrize("remembered", [5, 400_000])
def test_result_does_not_depend_on_splits_or_memory(spark, tmp_path, monkeypatch, remembered):
    """Several files in one task, one file in several tasks: the first row in the order of files keeps its chunks."""
    monkeypatch.setattr(chunkdedup, "REMEMBERED", remembered)
    sf = folder(spark, tmp_path, hard_docs(spark).repartition(5))
    path = f"{sf}/documents.parquet"
    rows = spark.read.parquet(path).select("text", "_metadata.file_path", "_metadata.row_index", "doc_id").collect()
    rows.sort(key=lambda r: (r.file_path, r.row_index))
    spans = brute([(i, (r.text or "").encode()) for i, r in enumerate(rows)])
    want = sorted((str(r.doc_id), sum(b - a for a, b in spans[i])) for i, r in enumerate(rows))
    for size in ("4000", "10000000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "10")
        try:
            got = chunkdedup.op2_substring_dedup(spark, sf).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert sorted((str(r.doc_id), r.n_removed) for r in got) == want


def test_passages_go_and_clean_documents_stay(spark):
    rng = random.Random(4)
    passage = words(rng, 60)
    rows = [(i, words(rng, 80) + " " + (passage + " " if i % 4 == 0 else "") + words(rng, 50)) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    got = {r.doc_id: r for r in chunkdedup.dedup_chunks(df).collect()}
    for i, text in rows:
        if i % 4 or i == 0:
            assert got[i].text == text
        else:
            assert len(text) - len(got[i].text) > 0.5 * len(passage)


def test_boundaries_meet_again_and_keep_characters():
    rng = random.Random(8)
    text = words(rng, 900, "abcdéß梦").encode()
    moved = b"some new words in front " + text
    own = chunkdedup.boundaries([text])[0]
    a = {text[x:y] for x, y in zip([0, *own], own)}
    cuts = chunkdedup.boundaries([moved, b"", text])
    b = [moved[x:y] for x, y in zip([0, *cuts[0]], cuts[0])]
    assert sum(len(x) for x in b if x in a) > 0.9 * len(text)
    assert b"".join(b) == moved and cuts[1] == []
    for piece in b:
        piece.decode()
    assert cuts[2] == chunkdedup.boundaries([text])[0]
    assert np.diff([0, *cuts[2]]).max() <= chunkdedup.MOST
    assert 30 < len(text) / len(own) < 70
