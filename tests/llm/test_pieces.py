import random
import zlib

import numpy as np
import pytest

from stemma.llm import pieces
from tests.llm.cases import SF, clash_docs, empty_docs, folder, hard_docs, words

TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b", "a\nb", "\n", "\n\n a", "a \n b", "12345 é梦😀\t\0 x", "▁a</s> <s>▁▁b", "the there's The\r\nend.", "x" * 300 + " y", "梦想" * 60, "    four    spaces    ", "Hello, world! a.b.c", "ﬁ Å é"]


def library(path=None, proto=None):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=proto) if proto else sentencepiece.SentencePieceProcessor(model_file=path)


def as_bytes(ids):
    return np.array(ids, "<u4").tobytes()


def corpus(spark):
    return TEXTS + [words(random.Random(i), 40, "aeinrst thlou") for i in range(20)] + [r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect()]


def test_bpe_ids_and_decoding_equal_the_library(spark):
    sp, own = library(pieces.default_model()), pieces.PieceModel(pieces.default_model())
    texts = corpus(spark)
    got = own.encode(texts)
    assert got == [as_bytes(sp.encode(t)) for t in texts]
    assert [own.decode(x) for x in got] == [sp.decode(sp.encode(t)) for t in texts]
    assert own.encode(texts) == got


def test_viterbi_equals_the_library_on_a_unigram_model(spark, tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    proto = pb.ModelProto()
    proto.ParseFromString(open(pieces.default_model(), "rb").read())
    proto.trainer_spec.model_type = pb.TrainerSpec.UNIGRAM
    for p in proto.pieces:  # scores with short sums, so that single precision is exact
        p.score = -1.0 - (abs(int(p.score)) % 64) / 8 - len(p.piece) / 4
    path = tmp_path / "unigram.model"
    path.write_bytes(proto.SerializeToString())
    sp, own = library(proto=proto.SerializeToString()), pieces.PieceModel(str(path))
    assert own.unigram
    texts = [t for t in corpus(spark) if len(t) < 3000]
    for t, ids in zip(texts, own.encode(texts)):
        want = sp.encode(t)
        score = lambda x: sum(own.scores[i] if own.scores[i] > -np.inf else 0 for i in x)
        assert ids == as_bytes(want) or score(np.frombuffer(ids, "<u4")) == score(want), t  # equal sums may be cut apart
    same = sum(ids == as_bytes(sp.encode(t)) for t, ids in zip(texts, own.encode(texts)))
    assert same > 0.9 * len(texts)


def test_viterbi_is_best_by_brute_force():
    own = pieces.PieceModel(pieces.default_model())

    def best(word):
        top = [0.0] + [-np.inf] * len(word)
        for e in range(1, len(word) + 1):
            for s in range(e):
                i = own.id_of.get(word[s:e])
                score = own.scores[i] if i is not None else own.unknown if e - s == 1 else -np.inf
                top[e] = max(top[e], top[s] + score)
        return top[-1]

    for word in ["▁thing", "▁unbelievable", "▁the梦x", "qqq"]:
        size, ids = own.viterbi(own.lattice(pieces.characters([word])))
        starts = np.flatnonzero(size[0])
        assert sum(own.scores[i] if i >= 0 else own.unknown for i in ids[0, starts]) == best(word)
        assert [0, *np.cumsum(size[0, starts])] == [*starts, len(word)]


@pytest.mark.parametrize("make", [hard_docs, clash_docs, empty_docs])
def test_query_on_hard_rows(spark, tmp_path, make):
    sp, docs = library(pieces.default_model()), make(spark)
    rows = pieces.op1_sentencepiece(spark, folder(spark, tmp_path, docs)).collect()
    want = sorted((str(r.doc_id), len(i := sp.encode(r.text or "")), zlib.crc32(as_bytes(i))) for r in docs.collect())
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want
    assert all(r.round_trip for r in rows)
    back = pieces.decode_documents(pieces.encode_documents(docs)).collect()
    assert sorted((str(r.doc_id), r.decoded) for r in back) == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    best = pieces.decode_documents(pieces.encode_documents(docs), column="best_ids").collect()
    assert sorted((str(r.doc_id), r.decoded) for r in best) == sorted((str(r.doc_id), r.text or "") for r in docs.collect())
    assert sorted(len(r.best_ids) // 4 for r in back) == sorted(r.n_best_tokens for r in rows)
