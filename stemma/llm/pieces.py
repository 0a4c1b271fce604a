"""SentencePiece encoding and decoding in batches of equal-length words, without the library's encoder.

A word is white space and what follows it; no piece of the supported models crosses into the next
word.  All substrings of up to sixteen characters of a batch are hashed together and probe the sorted
keys of the pieces.  Over that lattice runs either a Viterbi pass (the segmentation with the largest
sum of scores: unigram models) or the merges of a BPE model, both for all words of the batch at once.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.llm.bpe import ends_of
from stemma.llm.common import small_batches, table
from stemma.llm.ragged import Ragged, WordCache

SPACE = "▁"
MULTIPLY, START = np.uint64(0x9E3779B97F4A7C15), np.uint64(0x243F6A8885A308D3)
UNKNOWN_PENALTY = 10.0
#: Characters of one batch, of a word whose merges run in the batch, and words remembered.
CELLS, LONG, MOST_WORDS = 40_000, 48, 450_000
#: Texts encoded together.
SOME = 400
_WORD = re.compile(f"{SPACE}+[^{SPACE}]*")
#: Spaces that are no single space between two words.
_RUN = "^[ \n]| $|  | \n"
_MARKS = ".,;:!?%&$*#|)"


def keys_of(chars: np.ndarray) -> np.ndarray:
    """The hash of each row of characters."""
    h = np.full(chars.shape[0], START)
    for k in range(chars.shape[1]):
        h = h * MULTIPLY + chars[:, k].astype(np.uint64)
    return spread(h)


def spread(h: np.ndarray) -> np.ndarray:
    """The same hashes with even leading bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def characters(words: list[str]) -> np.ndarray:
    """Equal-length words as rows of code points."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(len(words), -1)


class PieceModel:
    """Pieces, scores and kind of a model file; only identity normalisation with escaped spaces."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        if spec.precompiled_charsmap or spec.remove_extra_whitespaces or not spec.escape_whitespaces or not spec.add_dummy_prefix:
            raise NotImplementedError("a model that normalises its text")
        self.unigram = proto.trainer_spec.model_type == pb.TrainerSpec.UNIGRAM
        normal = [(i, p.piece, p.score) for i, p in enumerate(proto.pieces) if p.type == pb.ModelProto.SentencePiece.NORMAL]
        if any(SPACE in p.lstrip(SPACE) or "\n" in p for _, p, _ in normal) or not proto.trainer_spec.byte_fallback:
            raise NotImplementedError("pieces that cross words, or no byte pieces")
        self.longest = max(len(p) for _, p, _ in normal)
        keys, ids = [], []
        for n in range(1, self.longest + 1):
            some = [(i, p) for i, p, _ in normal if len(p) == n]
            if some:
                keys.append(keys_of(characters([p for _, p in some])))
                ids.append(np.array([i for i, _ in some], np.int32))
        self.keys, self.ids = np.concatenate(keys), np.concatenate(ids)
        order = np.argsort(self.keys)
        self.keys, self.ids = self.keys[order], self.ids[order]
        #: Where the keys with each leading 16 bits begin, and the most that share them.
        self.bucket = np.searchsorted(self.keys >> np.uint64(48), np.arange(1 << 16, dtype=np.uint64)).astype(np.int32)
        self.deepest = int(np.bincount((self.keys >> np.uint64(48)).astype(np.int64)).max())
        self.scores = np.full(len(proto.pieces) + 1, -np.inf)
        for i, _, score in normal:
            self.scores[i] = score
        self.unknown = min(s for _, _, s in normal) - UNKNOWN_PENALTY
        self.id_of = {p: i for i, p, _ in normal}
        self.byte_ids = {int(p.piece[3:5], 16): i for i, p in enumerate(proto.pieces) if p.type == pb.ModelProto.SentencePiece.BYTE}
        self.surface = [p.piece.replace(SPACE, " ").encode() for p in proto.pieces]
        for b, i in self.byte_ids.items():
            self.surface[i] = bytes([b])
        for i, p in enumerate(proto.pieces):
            if p.type in (pb.ModelProto.SentencePiece.CONTROL, pb.ModelProto.SentencePiece.UNKNOWN):
                self.surface[i] = b"" if p.type == pb.ModelProto.SentencePiece.CONTROL else proto.trainer_spec.unk_surface.encode()
        #: Characters that stand side by side in some piece; elsewhere a word can be cut.
        self.pairs = {p[k : k + 2] for _, p, _ in normal for k in range(len(p) - 1)}
        self.of_byte = np.array([self.byte_ids[b] for b in range(256)], np.int32)
        self.bytes_of = np.array(self.surface, object)
        self.sizes = np.array([len(x) for x in self.surface], np.int64)
        self.words = WordCache(2, MOST_WORDS, LONG)  # the model's own ids and the best-scoring ones

    # --- equal-length words together

    def lattice(self, chars: np.ndarray) -> np.ndarray:
        """[word, start, length - 1]: the id of the piece there, else -1."""
        w, n = chars.shape
        out = np.full((w, n, min(n, self.longest)), -1, np.int32)
        h = np.full((w, n), START)
        last = len(self.keys) - 1
        for k in range(out.shape[2]):
            h = h[:, : n - k] * MULTIPLY + chars[:, k:].astype(np.uint64)
            flat = spread(h.ravel())
            at = self.bucket[(flat >> np.uint64(48)).astype(np.int64)]
            for step in range(self.deepest):
                place = np.minimum(at + step, last)
                hit = np.flatnonzero(self.keys[place] == flat)
                row, start = np.divmod(hit, n - k)
                out[row, start, k] = self.ids[place[hit]]
        return out

    def viterbi(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The pieces with the largest sum of scores, of all words at once; ties: the longest last piece.

        Returns [word, position]: the size of the piece that begins there, else 0; and its id or -1.
        """
        w, n, most = found.shape
        score = self.scores[found]
        score[:, :, 0] = np.where(found[:, :, 0] < 0, self.unknown, score[:, :, 0])
        best, back = np.full((w, n + 1), -np.inf), np.zeros((w, n + 1), np.int32)
        best[:, 0] = 0
        for end in range(1, n + 1):
            sizes = np.arange(min(end, most), 0, -1)  # the longest first
            ways = best[:, end - sizes] + score[:, end - sizes, sizes - 1]
            pick = ways.argmax(1)
            best[:, end] = ways[np.arange(w), pick]
            back[:, end] = sizes[pick]
        size, row, end = np.zeros((w, n), np.int32), np.arange(w), np.full(w, n)
        while len(row):
            step = back[row, end]
            end = end - step
            size[row, end] = step
            row, end = row[end > 0], end[end > 0]
        return size, self._ids_at(found, size)

    def merges(self, found: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """What is left when the pair with the best score, the leftmost first, is merged again and again."""
        w, n, most = found.shape
        score = self.scores[found].astype(np.float32).ravel()
        start = np.tile(np.arange(n + 2, dtype=np.int32), (w, 1))  # where symbol k begins; beyond the last: n
        start[:, n + 1] = n
        live = np.arange(w)
        columns = np.arange(n + 2)
        while len(live) and n > 1:
            s = start[live]
            size = s[:, 2 : n + 1] - s[:, : n - 1]
            good = (s[:, 1:n] < n) & (size <= most)
            place = ((live * n)[:, None] + np.minimum(s[:, : n - 1], n - 1)) * most + np.clip(size, 1, most) - 1
            pair = np.where(good, score.take(place), -np.inf)
            pick = pair.argmax(1)
            some = pair[np.arange(len(live)), pick] > -np.inf
            live, s, pick = live[some], s[some], pick[some]
            shift = np.minimum(columns[None, :] + (columns[None, :] > pick[:, None]), n + 1)
            start[live] = np.take_along_axis(s, shift, 1)
        size = np.zeros((w, n), np.int32)
        real = start[:, :n] < n
        row, k = np.nonzero(real)
        size[row, start[row, k]] = start[row, k + 1] - start[row, k]
        return size, self._ids_at(found, size)

    @staticmethod
    def _ids_at(found: np.ndarray, size: np.ndarray) -> np.ndarray:
        return np.where(size > 0, np.take_along_axis(found, np.maximum(size - 1, 0)[:, :, None], 2)[:, :, 0], 0)

    def merge_one(self, word: str) -> list[tuple[int, int, int]]:
        """The same for one long word, with a heap."""
        n = len(word)
        after, before, end = list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
        alive = [True] * n
        heap: list[tuple[float, int, int]] = []

        def offer(a: int) -> None:
            b = after[a]
            if b < n and (i := self.id_of.get(word[a : end[b]])) is not None:
                heapq.heappush(heap, (-self.scores[i], a, end[b]))

        for a in range(n - 1):
            offer(a)
        while heap:
            _, a, e = heapq.heappop(heap)
            if not alive[a] or after[a] >= n or end[after[a]] != e:
                continue
            b = after[a]
            alive[b], end[a], after[a] = False, e, after[b]
            if after[a] < n:
                before[after[a]] = a
            offer(a)
            if before[a] >= 0:
                offer(before[a])
        return [(a, end[a], self.id_of.get(word[a : end[a]], -1)) for a in range(n) if alive[a]]

    def segment(self, atoms: pa.Array) -> tuple[Ragged, Ragged]:
        """A row for each atom: the model's own ids, and the best-scoring ones.

        Characters without a piece become byte pieces.
        """
        text = "".join(atoms.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), "<u4")
        length = pc.utf8_length(atoms).to_numpy().astype(np.int64)
        start = np.cumsum(length) - length
        order = np.argsort(length, kind="stable")
        cuts = np.append(np.flatnonzero(np.diff(length[order], prepend=-1)), len(order)).tolist()
        own, best = Ragged(), Ragged()
        for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
            n = int(length[order[lo]])
            step = max(1, CELLS // max(1, n))
            for at in range(lo, hi, step):
                some = order[at : min(hi, at + step)]
                if not n:
                    rows = best_rows = (np.zeros(0, np.int32), np.zeros(len(some), np.int64))
                else:
                    chars = points[start[some][:, None] + np.arange(n)]
                    found = self.lattice(chars)
                    rows = best_rows = self._flat(chars, *self.viterbi(found))
                    if not self.unigram:
                        rows = self._flat(chars, *(self._merge_long(chars) if n > LONG else self.merges(found)))
                own.add(*rows)
                best.add(*best_rows)
        back = np.empty(len(order), np.int64)
        back[order] = np.arange(len(order))
        out = Ragged(), Ragged()
        for store, given in zip(out, (own, best), strict=True):
            store.add(*given.take(back))
        return out

    def _flat(self, chars: np.ndarray, size: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words in a row, and how many each has; a character without a piece gives its bytes."""
        row, at = np.nonzero(size)
        flat, counts = ids[row, at], np.bincount(row, minlength=len(size)).astype(np.int64)
        gaps = np.flatnonzero(flat < 0)
        if len(gaps):
            c = chars[row[gaps], at[gaps]]
            n = 1 + (c >= 0x80).astype(np.int64) + (c >= 0x800) + (c >= 0x10000)
            times = np.ones(len(flat), np.int64)
            times[gaps] = n
            counts = np.bincount(row, times, len(size)).astype(np.int64)
            flat = np.repeat(flat, times)
            flat[flat < 0] = self.of_byte[np.frombuffer(c.astype("<u4").tobytes().decode("utf-32-le").encode(), np.uint8)]
        return flat, counts

    def _merge_long(self, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """As ``merges``, for words that are too long for it."""
        size, ids = np.zeros(chars.shape, np.int32), np.zeros(chars.shape, np.int32)
        for row in range(len(chars)):
            for a, b, i in self.merge_one(chars[row].tobytes().decode("utf-32-le")):
                size[row, a], ids[row, a] = b - a, i
        return size, ids

    # --- texts

    def _learn(self, missing: pa.Array) -> None:
        """Rows of different words in both stores.

        A word stands for SPACE and itself, unless it begins with SPACE or with a line feed; an empty
        one has no ids.  Marks at its end are apart where no piece has the two characters at the border.
        """
        base = pc.utf8_rtrim(missing, characters=_MARKS)
        mark = ends_of(missing, base)
        border = pc.binary_join_element_wise(pc.utf8_slice_codeunits(base, -1), pc.utf8_slice_codeunits(mark, 0, 1), "").dictionary_encode()
        free = pa.array([len(x) == 2 and x not in self.pairs for x in border.dictionary.to_pylist()], pa.bool_()).take(border.indices)
        free = pc.and_(free, pc.not_equal(base, ""))
        atoms = pc.if_else(free, base, missing).dictionary_encode()
        marks = pc.if_else(free, mark, "").dictionary_encode()
        listed = atoms.dictionary.to_pylist()
        known = np.fromiter(map(self.words.number.get, listed, repeat(-1)), np.int64, len(listed))
        have, fresh = np.flatnonzero(known >= 0), np.flatnonzero(known < 0)
        row = np.empty(len(listed), np.int64)
        row[have], row[fresh] = np.arange(len(have)), len(have) + np.arange(len(fresh))
        asked = self._whole(atoms.dictionary.take(pa.array(fresh)))
        ends = self.segment(marks.dictionary)
        pair = np.stack([row[atoms.indices.to_numpy()], len(listed) + marks.indices.to_numpy()], 1).ravel()
        for store, new, end in zip(self.words.stores, asked, ends, strict=True):
            parts = Ragged()
            parts.add(*store.take(known[have]))
            parts.add(*new.take(np.arange(new.rows)))
            parts.add(*end.take(np.arange(end.rows)))
            ids, size = parts.take(pair)
            store.add(ids, size.reshape(-1, 2).sum(1))

    def _whole(self, words: pa.Array) -> tuple[Ragged, Ragged]:
        """Rows of words that are not known: line feeds are bytes of their own between atoms."""
        bare = pc.invert(pc.match_substring_regex(words, f"^$|^{SPACE}|\n"))
        simple = pc.binary_join_element_wise(SPACE, words.filter(bare), "")
        cut = [(w if w[:1] in ("", "\n", SPACE) else SPACE + w).split("\n") for w in words.filter(pc.invert(bare)).to_pylist()]
        found = self.segment(pa.concat_arrays([simple, pa.array([x for parts in cut for x in parts], pa.string()), pa.array(["\n"])]))
        feed, at, places, sizes = len(simple) + sum(map(len, cut)), len(simple), [], []
        for parts in cut:
            for k in range(len(parts)):
                places += [at + k] if not k else [feed, at + k]
            at += len(parts)
            sizes.append(2 * len(parts) - 1)
        where = np.empty(len(words), np.int64)
        flags = bare.to_numpy(zero_copy_only=False)
        where[flags], where[~flags] = np.arange(len(simple)), len(simple) + np.arange(len(cut))
        edges = np.append(0, np.cumsum(sizes, dtype=np.int64))
        out = Ragged(), Ragged()
        for store, given in zip(out, found, strict=True):
            both = Ragged()
            both.add(*given.take(np.arange(len(simple))))
            ids, size = given.take(np.array(places, np.int64))
            total = np.append(0, np.cumsum(size))
            both.add(ids, np.diff(total[edges]))
            store.add(*both.take(where))
        return out

    def encode_both(self, texts: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
        """The model's own ids of all texts and the best-scoring ones: ids in a row, and how many each text has."""
        if self.words.full():
            self.words.clear()
        texts = pc.replace_substring(pc.fill_null(texts, ""), SPACE, " ")
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        runs = pc.match_substring_regex(texts, _RUN).to_numpy(zero_copy_only=False)
        if runs.any():
            listed = lists.to_pylist()
            for i in np.flatnonzero(runs).tolist():
                listed[i] = _WORD.findall(SPACE + texts[i].as_py().replace(" ", SPACE))
            lists = pa.array(listed, pa.list_(pa.string()))
        ends = np.cumsum(lists.value_lengths().to_numpy())
        coded = lists.flatten().dictionary_encode()
        rows = self.words.find(coded.dictionary, self._learn)[coded.indices.to_numpy()]
        out = []
        for store in self.words.stores:
            ids, size = store.take(rows)
            total = np.append(0, np.cumsum(size))
            out.append((ids, np.diff(total[ends], prepend=0)))
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        return rows_of(*self.encode_both(pa.array(texts, pa.string()))[0])

    def decode_all(self, ids: np.ndarray, size: np.ndarray) -> list[bytes]:
        """UTF-8 of the texts of ids in a row, without the space that encoding put in front."""
        data = b"".join(self.bytes_of[ids].tolist())
        ends = np.append(0, np.cumsum(self.sizes[ids]))[np.append(0, np.cumsum(size))].tolist()
        return [data[a + (data[a : a + 1] == b" " and a < b) : b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def decode(self, ids: bytes) -> str:
        found = np.frombuffer(ids, "<u4")
        return self.decode_all(found, np.array([len(found)]))[0].decode("utf-8", "replace")


def rows_of(ids: np.ndarray, size: np.ndarray) -> list[bytes]:
    """Each row's ids as bytes, four for each id."""
    data, ends = ids.astype("<u4").tobytes(), (4 * np.cumsum(size)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends, strict=False)]


_models: dict[str, PieceModel] = {}


def model_at(path: str) -> PieceModel:
    if path not in _models:
        _models[path] = PieceModel(path)
    return _models[path]


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def encode_documents(docs: DataFrame, model: str | None = None, digest: bool = False) -> DataFrame:
    """(doc_id, text, ids, best_ids): the model's own ids of each whole text, and the best-scoring segmentation.

    ``ids`` follow the model's kind and equal the library's; ``best_ids`` are the Viterbi pass over the
    same pieces and scores, which for a unigram model is the same.  Reads ``doc_id`` and ``text`` only.
    A null or empty text gives no ids; U+2581 counts as a space, as in the library; a null doc_id stays
    null; ties and repeated rows are encoded alike; an empty table gives no rows.  No shuffle.  With
    ``digest`` the ids are decoded where they are made, and their numbers and unsigned crc32 and
    ``round_trip``, whether the text came back from both segmentations, take the place of texts and ids.
    """
    small_batches(docs.sparkSession)
    path = model or default_model()
    coded = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("ids", pa.binary()), ("best_ids", pa.binary())])
    longs = ["doc_id", "n_tokens", "ids_crc32", "n_best_tokens", "best_ids_crc32"]
    digests = pa.schema([*((k, pa.int64()) for k in longs), ("round_trip", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_at(path)
        for whole in batches:
            for at in range(0, len(whole), SOME):
                batch = whole.slice(at, SOME)
                own, best = pieces.encode_both(batch.column(1))
                ids, best_ids = rows_of(*own), rows_of(*best)
                if not digest:
                    yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()), pa.array(best_ids, pa.binary())], schema=coded)
                    continue
                numbers = [pa.array(x, pa.int64()) for x in (own[1], map(zlib.crc32, ids), best[1], map(zlib.crc32, best_ids))]
                plain = pc.replace_substring(pc.fill_null(batch.column(1), ""), SPACE, " ").cast(pa.binary()).to_pylist()
                same = [x == t == y for x, t, y in zip(pieces.decode_all(*own), plain, pieces.decode_all(*best), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *numbers, pa.array(same)], schema=digests)

    rows = docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))
    kinds = ", ".join(f"{k} bigint" for k in longs) + ", round_trip boolean"
    return rows.mapInArrow(run, kinds if digest else "doc_id bigint, text string, ids binary, best_ids binary")


def decode_documents(coded: DataFrame, model: str | None = None, column: str = "ids") -> DataFrame:
    """``coded`` with ``decoded``, the text of the ids in ``column`` (``ids`` or ``best_ids``); null ids give null."""
    path = model or default_model()
    others = [c for c in coded.columns if c != "decoded"]
    names = [column, *[c for c in others if c != column]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = model_at(path)
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[*names, "decoded"])

    types = ", ".join(f"`{c}` {coded.schema[c].dataType.simpleString()}" for c in names)
    return coded.select(*[F.col(f"`{c}`") for c in names]).mapInArrow(run, f"{types}, decoded string")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encodes all documents, decodes them again, and returns digests of both."""
    return encode_documents(table(spark, sf_dir, "documents"), digest=True)
