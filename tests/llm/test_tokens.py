import zlib

import numpy as np
import pytest

from stemma.llm import packing, wavelet
from stemma.llm.bpe import Encoder, default_vocabulary
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs


def plain(texts):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(default_vocabulary())
    t.encode_special_tokens = True
    return [np.array(t.encode(x, add_special_tokens=False).ids + [0], "<u4").tobytes() for x in texts]


def test_cached_encoding_equals_the_library():
    texts = ["", " ", "  ", "a  b", " a\n b \n ", "a \n", "\n \nb", "it's  \t  5 x\x1c y", "  x   y", "end ", "梦 梦  é", "a" * 200 + " b", "<|endoftext|> x", "a\nb", "\n", "\nab.", "x.\n", "ab\nCd, é\nß. 5\n6", "a\n b", "a \nb", "x\r\ny", "a\n\nb", "\n.", "it's\n's"]
    assert [x + b"\0\0\0\0" for x in Encoder(default_vocabulary()).encode(texts)] == plain(texts)


@pytest.mark.parametrize("make", [hard_docs, clash_docs])
def test_packing_covers_every_id_once_without_padding(spark, make):
    docs = make(spark)
    whole = sorted((r.doc_id is None, r.doc_id or 0, ids) for r, ids in ((r, plain([r.text or ""])[0]) for r in docs.collect()))
    rows = packing.pack_documents(docs.repartition(3), group_tokens=2000, keep=make is hard_docs).collect()
    sequences, pieces = {}, {}
    for r in rows:
        assert len(r.ids) == 4 * r.length > 0
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.length, bytes(r.ids)))
    for parts in sequences.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    from collections import Counter

    total = Counter((k[0], s + i) for k, ps in pieces.items() for s, n, _ in ps for i in range(n))
    expected = Counter((None if null else d, i) for null, d, ids in whole for i in range(len(ids) // 4))
    assert total == expected
    by_id = {(None if null else d, len(ids) // 4): ids for null, d, ids in whole}
    for key, ps in pieces.items():
        if key[0] is not None:
            assert all(by_id[key][4 * s : 4 * (s + n)] == ids for s, n, ids in ps)


def test_packing_balances_steps(spark):
    rows = packing.pack_documents(spark.read.parquet(f"{SF}/documents.parquet")).groupBy("step_id").sum("length").collect()
    sizes = sorted(r[1] for r in rows)
    assert sizes[-1] - sizes[0] <= 2048


def test_wavelet_shard_answers():
    rng = np.random.default_rng(3)
    ids = np.minimum(rng.zipf(1.3, 5000), 50_000).astype("<u4")
    shard = wavelet.WaveletShard(wavelet.build(ids, [1, None], [3000, 2000]))
    assert (shard.decode() == ids).all()
    for token in (1, 2, 7, int(ids[17]), 49_999):
        where = np.flatnonzero(ids == token).tolist()
        assert shard.count(token) == len(where)
        assert shard.occurrences(token).tolist() == where
        assert [shard.locate(token, k) for k in range(0, len(where), 41)] == where[::41]
        assert shard.rank(token, 777) == sum(x < 777 for x in where)
    assert [shard.access(i) for i in range(0, 5000, 97)] == ids[::97].tolist()
    assert shard.count(1 << 20) == 0
    empty = wavelet.WaveletShard(wavelet.build(np.zeros(0, "<u4"), [], []))
    assert empty.decode().tolist() == [] and empty.count(3) == 0


def test_wavelet_questions_open_few_frames():
    rng = np.random.default_rng(5)
    ids = rng.integers(0, 50_000, 400_000).astype("<u4")
    payload = wavelet.build(ids, [7], [len(ids)])
    shard = wavelet.WaveletShard(payload)
    every = 1 + shard.levels * (1 + shard.chunks)
    assert shard.chunks > 5 and shard.access(123_456) == ids[123_456]
    assert shard.opened <= 1 + 2 * shard.levels < every // 2
    shard = wavelet.WaveletShard(payload)
    assert shard.count(int(ids[5])) == int((ids == ids[5]).sum())
    assert shard.opened <= 1 + 3 * shard.levels < every
    assert (shard.decode() == ids).all()


def test_find_token_in_written_shards(spark):
    docs = hard_docs(spark)
    shards = wavelet.write_shards(docs.repartition(3), shard_tokens=50)
    whole = [(r.doc_id, np.frombuffer(plain([r.text or ""])[0], "<u4")) for r in docs.collect()]
    for token in (0, int(whole[0][1][0]), 49_000):
        want = sorted(((d is None, d or 0, p) for d, ids in whole for p in np.flatnonzero(ids == token).tolist()))
        got = wavelet.find_token(shards, token).collect()
        assert sorted((r.doc_id is None, r.doc_id or 0, r.place) for r in got) == want


@pytest.mark.parametrize("make", [hard_docs, clash_docs])
def test_token_output_round_trip(spark, tmp_path, make):
    sf = folder(spark, tmp_path, make(spark).repartition(3))
    rows = wavelet.op5_token_output(spark, sf).orderBy("start").collect()
    docs = make(spark).collect()
    expected = sorted((-1 if r.doc_id is None else r.doc_id, zlib.crc32(ids), len(ids) // 4) for r, ids in ((r, plain([r.text or ""])[0]) for r in docs))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.ids_crc32, r.n_tokens) for r in rows) == expected
    keys = [-1 if r.doc_id is None else r.doc_id for r in rows]
    assert keys == sorted(keys)
    at = 0
    for r in rows:
        assert r.start == at
        at += r.n_tokens


def test_empty_tables(spark, tmp_path):
    sf = folder(spark, tmp_path, empty_docs(spark))
    assert packing.op4_packing(spark, sf).count() == 0
    assert wavelet.op5_token_output(spark, sf).count() == 0
