"""Phrase collocations: candidates from count sketches, counted exactly by Aho-Corasick automata, scored by exact integers."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import chain

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stemma.llm.common import materialize, scratch, small_batches, table, trimmed

#: Words of a phrase at most; rows of a sketch; cells that travel together.
LONGEST, DEPTH, BLOCK = 5, 2, 1 << 16
#: Bytes of text that are split into words together; words that one automaton scans, so that each of
#: its words has a code point of its own.
SHARD_BYTES, SHARD_WORDS = 8 << 20, 800_000
#: A sketch has one cell for so many bytes of text, and no more than MOST_CELLS, so that a task can hold it.
BYTES_A_CELL, LEAST_CELLS, MOST_CELLS = 64, 1 << 16, 1 << 26
#: Phrases whose counts a task adds up before it sends them, and blocks of phrases that they travel in:
#: the counts of a language's block meet in one task.
REMEMBERED, COUNT_BLOCKS = 400_000, 256

#: Fixed by the contract: 0 belongs to a word, 1 ends a word, 2 ends a piece.
KINDS = np.zeros(256, np.uint8)
KINDS[list(b"\x20\x09")] = 1
KINDS[list(b".,;:!?\x0a\x0b\x0c\x0d")] = 2
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
MULTIPLIERS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of about ``SHARD_BYTES``; a larger text is a slice of its own."""
    ends = np.cumsum([len(x) for x in batch.column(1).cast(pa.binary()).to_pylist()])
    at = 0
    while at < len(batch):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + SHARD_BYTES, "right")))
        yield batch.slice(at, to - at)
        at = to


class Words:
    """The words of some texts of one language, in reading order: ids in ``vocabulary``, and the number of the piece of each."""

    def __init__(self, texts: list[bytes], lang: str):
        data = LOWER[np.frombuffer(b"\n".join([*texts, b""]), np.uint8)]
        kinds = KINDS[data]
        inside = kinds == 0
        edge = np.diff(inside.astype(np.int8), prepend=0, append=0)
        starts = np.flatnonzero(edge == 1)
        offsets = np.append(0, np.cumsum(np.flatnonzero(edge == -1) - starts)).astype(np.int32)
        words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(data[inside])).dictionary_encode()
        self.ids = words.indices.to_numpy().astype(np.int64)
        self.vocabulary: list[str] = words.dictionary.to_pylist()
        self.piece = np.cumsum(kinds == 2, dtype=np.int32)[starts]
        seed = xxhash.xxh3_64_intdigest(lang.encode())
        digest = xxhash.xxh3_64_intdigest
        self.hashes = np.fromiter((digest(w.encode(), seed) for w in self.vocabulary), np.uint64, len(self.vocabulary))

    def within(self, k: int) -> np.ndarray:
        """Whether the k words from each place on lie in one piece."""
        n = len(self.ids) - k + 1
        return self.piece[:n] == self.piece[k - 1 :] if n > 0 else np.zeros(0, bool)

    def phrase_hashes(self, k: int, at: np.ndarray) -> np.ndarray:
        """64 bits of the k words from each of the given places on."""
        h = self.hashes[self.ids[at]]
        for j in range(1, k):
            h = (h ^ (h >> np.uint64(29))) * MULTIPLIERS[2] + self.hashes[self.ids[at + j]]
        return h


def cells(hashes: np.ndarray, width: int) -> list[np.ndarray]:
    """The cell of each hash in each row of a sketch; width is a power of two."""
    shift = np.uint64(64 - (width - 1).bit_length())
    return [(((hashes ^ (hashes >> np.uint64(31))) * MULTIPLIERS[j]) >> shift).astype(np.int64) + j * width for j in range(DEPTH)]


def frequent(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the sketch's upper bound of each hash reaches the threshold: all its cells do."""
    out = np.ones(len(hashes), bool)
    for at in cells(hashes, len(bits) * 8 // DEPTH):
        out &= (bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
    return out


def by_language(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Words]]:
    """The words of the texts, some ``SHARD_BYTES`` at a time, language by language."""
    for batch in (some for whole in batches for some in slices(whole)):
        langs = batch.column(0).dictionary_encode()
        texts, codes = batch.column(1).cast(pa.binary()), langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            yield lang, Words(texts.filter(pa.array(codes == k)).to_pylist(), lang)


def sketch(texts: DataFrame, width: int, least: int, hashes: Callable[[Words], Iterator[np.ndarray]]) -> np.ndarray:
    """Bits: whether each cell of a count sketch reaches ``least``, over all ``hashes`` of all texts.

    Each task counts in its own array, up to ``least`` in the smallest type that holds it, and sends the
    cells that it has touched, in blocks, dense or by place; the blocks are summed where they meet, and
    one bit for each cell is left, so that what the driver gets does not depend on the texts.
    """
    schema = pa.schema([("block", pa.int32()), ("at", pa.binary()), ("counts", pa.binary())])
    small = np.min_scalar_type(least)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(DEPTH * width, small)
        for _, words in by_language(batches):
            for h in hashes(words):
                for at in cells(h, width):
                    own, times = np.unique(at, return_counts=True)
                    total[own] = np.minimum(total[own] + times, least)
        for block in range(0, len(total), BLOCK):
            part = total[block : block + BLOCK]
            some = np.flatnonzero(part)
            if len(some):
                sparse = len(some) * (2 + part.itemsize) < part.nbytes
                row = [[block // BLOCK], [some.astype(np.uint16).tobytes() if sparse else None], [(part[some] if sparse else part).tobytes()]]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema, strict=True)], schema=schema)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for block, at, counts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = sums.setdefault(block, np.zeros(BLOCK, np.uint64))
                own[slice(None) if at is None else np.frombuffer(at, np.uint16)] += np.frombuffer(counts, small)
        for block, own in sums.items():
            bits = np.packbits(own >= least, bitorder="little").tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits])], names=["block", "bits"])

    kind = "block int, at binary, counts binary"
    found = texts.mapInArrow(trimmed(add), kind).repartition("block").mapInArrow(merge, "block int, bits binary").collect()
    bits = np.zeros(DEPTH * width // 8, np.uint8)
    for r in found:
        bits[r.block * BLOCK // 8 : (r.block + 1) * BLOCK // 8] = np.frombuffer(r.bits, np.uint8)
    return bits


class Bounds:
    """Which words, pairs of words and longer phrases may reach the threshold, by one sketch each."""

    def __init__(self, single: np.ndarray, pairs: np.ndarray | None = None, longer: np.ndarray | None = None):
        self.single, self.pairs, self.longer = single, pairs, longer

    def words(self, words: Words) -> np.ndarray:
        """Of each place."""
        return frequent(self.single, words.hashes)[words.ids]

    def twos(self, words: Words) -> np.ndarray:
        """Of the two words from each place on: both words and, where its sketch is known, the pair."""
        known = self.words(words)
        both = known[:-1] & known[1:] & words.within(2) if len(known) > 1 else np.zeros(0, bool)
        if self.pairs is not None:
            at = np.flatnonzero(both)
            both[at] = frequent(self.pairs, words.phrase_hashes(2, at))
        return both

    def longer_hashes(self, words: Words) -> Iterator[np.ndarray]:
        """Of the phrases of three and more words whose pairs may all reach the threshold."""
        alive = twos = self.twos(words)
        for k in range(3, LONGEST + 1):
            n = len(words.ids) - k + 1
            if n <= 0:
                break
            alive = alive[:n] & twos[k - 2 : k - 2 + n]
            yield words.phrase_hashes(k, np.flatnonzero(alive))


def candidates(words: Words, bounds: Bounds, twos: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, length) of one occurrence of each different candidate that starts in lo to hi - 1.

    A candidate's upper bound and those of its parts all reach the threshold (``twos`` are those of
    pairs).  Phrases are told apart by the ids of their words, one word more at a time.
    """
    ids = words.ids[lo : hi + LONGEST]
    alive, code, size = twos[lo : hi + LONGEST - 1], ids, len(words.vocabulary)
    places, sizes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for k in range(2, LONGEST + 1):
        count = len(ids) - k + 1
        if count <= 0:
            break
        if k > 2:
            at = np.flatnonzero(alive[:count] & alive[1 : count + 1])
            at = at[frequent(bounds.longer, words.phrase_hashes(k, at + lo))]
            alive = np.zeros(count, bool)
            alive[at] = True
        at = np.flatnonzero(alive[:count])
        _, first, inverse = np.unique(code[at] * size + ids[at + k - 1], return_index=True, return_inverse=True)
        code = np.zeros(count, np.int64)
        code[at] = inverse
        own = np.unique(inverse[at < hi - lo])  # the others start later
        places.append(at[first[own]] + lo)
        sizes.append(np.full(len(own), k))
    return np.concatenate(places), np.concatenate(sizes)


def occurrences(words: Words, places: np.ndarray, sizes: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """How often each phrase, named by a place and its length, starts in lo to hi - 1: one scan by an automaton.

    The automaton's letters are words: each word of a phrase has a code point, other words and the gaps
    between pieces are a guard that no phrase holds.
    """
    span = np.arange(lo, min(len(words.ids), hi + LONGEST - 1))
    letters = np.zeros(len(words.vocabulary), np.uint32)
    inside = np.unique(words.ids[np.concatenate([places[sizes > j] + j for j in range(LONGEST)])])
    code = np.arange(1, len(inside) + 1, dtype=np.uint32)
    letters[inside] = np.where(code < 0xD800, code, code + 0x800)  # surrogates are no characters
    piece = words.piece[span]
    at = np.arange(len(span)) + np.cumsum(np.append(0, piece[1:] != piece[:-1]))
    line = np.zeros(at[-1] + 1, np.uint32)
    line[at] = letters[words.ids[span]]
    text = line.astype("<u4").tobytes().decode("utf-32-le")
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
    for k, (p, size) in enumerate(zip(at[places - lo].tolist(), sizes.tolist(), strict=True)):
        automaton.add_word(text[p : p + size], k)
    automaton.make_automaton()
    hits = np.fromiter(chain.from_iterable(automaton.iter(text)), np.int64).reshape(-1, 2)
    edge = at[hi - lo] if hi - lo < len(at) else len(line)
    own = hits[hits[:, 0] - sizes[hits[:, 1]] + 1 < edge, 1]
    return np.bincount(own, minlength=len(places))


def shard_counts(words: Words, bounds: Bounds, shard_words: int = SHARD_WORDS) -> Iterator[tuple[list[str], list[int], np.ndarray]]:
    """(phrases, sizes, occurrences) of the candidates of 2 and more words, for each shard of the words."""
    twos = bounds.twos(words)
    for lo in range(0, len(words.ids), shard_words):
        hi = min(len(words.ids), lo + shard_words)
        places, sizes = candidates(words, bounds, twos, lo, hi)
        if len(places):
            names = [" ".join([words.vocabulary[i] for i in words.ids[p : p + k].tolist()]) for p, k in zip(places.tolist(), sizes.tolist(), strict=True)]
            yield names, sizes.tolist(), occurrences(words, places, sizes, lo, hi)


COUNTS = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int32()), ("f", pa.int64())])


def phrase_counts(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """(totals(lang, n), counts(lang, phrase, size, f)): words of each language, and phrases of 1 to 5 words with f >= least.

    Four scans.  Three count in sketches: words; pairs whose words reach ``least`` by the first;
    longer phrases whose pairs do by the second.  The fourth compiles, for each shard of text, the
    phrases in it that reach ``least`` by all bounds into an automaton, which counts them; a task adds
    up the counts of its shards, and sends them in blocks of phrases.  Blocks are summed, and those below ``least`` go: bounds are never
    too low, so the result is exact; a narrow sketch only makes more candidates.
    """
    spark = docs.sparkSession
    small_batches(spark, 2000)
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    width = min(MOST_CELLS, max(LEAST_CELLS, 1 << (size // BYTES_A_CELL).bit_length()))

    bounds = Bounds(sketch(texts, width, least, lambda words: iter([words.hashes[words.ids]])))
    bounds = Bounds(bounds.single, sketch(texts, width, least, lambda words, b=bounds: iter([words.phrase_hashes(2, np.flatnonzero(b.twos(words)))])))
    bounds = Bounds(bounds.single, bounds.pairs, sketch(texts, width, least, lambda words, b=bounds: b.longer_hashes(words)))

    block = pa.schema([("lang", pa.string()), ("block", pa.int32()), ("phrases", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])

    def blocks(lang: str, held: dict[str, int]) -> pa.RecordBatch:
        parts: list[tuple[list[str], list[int]]] = [([], []) for _ in range(COUNT_BLOCKS)]
        for phrase, n in held.items():
            names, counts = parts[xxhash.xxh3_64_intdigest(phrase.encode()) % COUNT_BLOCKS]
            names.append(phrase)
            counts.append(n)
        some = [k for k, (names, _) in enumerate(parts) if names]
        columns = [[lang] * len(some), some, [parts[k][0] for k in some], [parts[k][1] for k in some]]
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, block, strict=True)], schema=block)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[str, int]] = {}
        for lang, words in by_language(batches):
            own = sums.setdefault(lang, {})
            once = np.bincount(words.ids, minlength=len(words.vocabulary))
            some = np.flatnonzero(frequent(bounds.single, words.hashes))
            own[""] = own.get("", 0) + len(words.ids)  # all words of the language
            for i, n in zip(some.tolist(), once[some].tolist(), strict=True):
                own[words.vocabulary[i]] = own.get(words.vocabulary[i], 0) + n
            for phrases, _, occurring in shard_counts(words, bounds):
                for phrase, n in zip(phrases, occurring.tolist(), strict=True):
                    own[phrase] = own.get(phrase, 0) + n
            if sum(map(len, sums.values())) > REMEMBERED:
                yield from (blocks(x, held) for x, held in sums.items())
                sums = {}
        yield from (blocks(x, held) for x, held in sums.items())

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, dict[str, int]] = {}
        for batch in batches:
            for lang, names, counts in zip(*(batch.column(c).to_pylist() for c in ("lang", "phrases", "counts")), strict=True):
                own = sums.setdefault(lang, {})
                for phrase, n in zip(names, counts, strict=True):
                    own[phrase] = own.get(phrase, 0) + n
        for lang, own in sums.items():
            names = [x for x, n in own.items() if n >= least or not x]
            columns = [[lang] * len(names), names, [x.count(" ") + 1 if x else 0 for x in names], [own[x] for x in names]]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, COUNTS, strict=True)], schema=COUNTS)

    counted = texts.mapInArrow(trimmed(count), "lang string, block int, phrases array<string>, counts array<bigint>")
    found = counted.repartition("lang", "block").mapInArrow(trimmed(add), "lang string, phrase string, size int, f bigint")
    found = materialize(found, "phrases", outlive=1)
    return found.where("size = 0").select("lang", F.col("f").alias("n")), found.where("size > 0")


def collocations(docs: DataFrame, least: int = 100, top: int = 2000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of 2 to 5 words of each language.

    Texts are lower-cased (A to Z), cut into pieces at ``. , ; : ! ?`` and line ends, and into words at
    blanks and tabs.  A candidate occurs a >= ``least`` times; its lowest-scoring cut into parts with l
    and r occurrences scores floor(1000 a n / (l r)), n the words of the language, in 38-digit
    decimals; equal scores go to the earlier cut.  A candidate inside a longer one that occurs as often
    goes (a candidate one word longer occurs as often then).  Order: score, a, then the phrase's bytes.
    A null lang is ``und``; null and empty texts have no words; repeated rows count each; doc_id and
    other columns are not read; texts without words and empty tables give no rows.
    """
    with scratch(docs.sparkSession):
        totals, counts = phrase_counts(docs, least)
        several = counts.where("size > 1")
        words = F.split("phrase", " ")
        cut = several.select("lang", "phrase", "size", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
        cut = cut.select(
            "lang", "phrase", "size", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"), F.array_join(F.slice("w", F.col("k") + 1, F.col("size")), " ").alias("right")
        )
        parts = counts.select("lang", "phrase", "f")
        cut = cut.join(parts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        cut = cut.join(parts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(totals, "lang")
        wide = "CAST({} AS DECIMAL(18, 0))"
        score = F.expr(f"({wide.format('a')} * {wide.format('n')} * CAST(1000 AS DECIMAL(4, 0))) DIV ({wide.format('l')} * {wide.format('r')})")
        best = cut.groupBy("lang", "phrase", "size", "a", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
        shorter = F.array(F.array_join(F.slice(words, 1, F.col("size") - 1), " "), F.array_join(F.slice(words, F.lit(2), F.col("size") - 1), " "))
        inside = several.where("size > 2").select("lang", F.explode(shorter).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("longer"))
        kept = best.join(inside, ["lang", "phrase"], "left").where("longer IS NULL OR longer < a")
        rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase"))
        rows = kept.select("lang", rank.alias("rank"), "phrase", "a", F.col("cut.l").alias("l"), F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))
        return materialize(rows.where(F.col("rank") <= top), "collocations", outlive=1)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; phrases with at least 100 occurrences, 2000 for each language."""
    return collocations(table(spark, sf_dir, "documents"))


OP13_SQL = r"""
WITH p AS (
    SELECT coalesce(lang, 'und') AS lang,
        unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), w AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM p
), g AS (
    SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
    FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3, 4, 5]) AS k))
), c AS (
    SELECT lang, k, phrase, CAST(count(*) AS BIGINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100
), n AS (
    SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang
), cut AS (
    SELECT lang, k, phrase, f, array_to_string(string_split(phrase, ' ')[1 : j], ' ') AS lp, array_to_string(string_split(phrase, ' ')[j + 1 :], ' ') AS rp, j
    FROM (SELECT *, unnest(range(1, k)) AS j FROM c WHERE k > 1)
), s AS (
    SELECT cut.lang, cut.k, cut.phrase, cut.f AS a, j, x.f AS l, y.f AS r, n,
        CAST((CAST(1000 AS HUGEINT) * cut.f * n) // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
    FROM cut JOIN c x ON x.lang = cut.lang AND x.phrase = lp JOIN c y ON y.lang = cut.lang AND y.phrase = rp JOIN n ON n.lang = cut.lang
), b AS (
    SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), o AS (
    SELECT * FROM b WHERE NOT EXISTS (
        SELECT 1 FROM c WHERE c.lang = b.lang AND c.k > b.k AND 100 * c.f >= 100 * b.a AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))
)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
    SELECT *, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS INTEGER) AS rank FROM o
) WHERE rank <= 2000
"""
