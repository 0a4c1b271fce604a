"""SimHash near-duplicates by an inverted index of positional bytes with count filtering.

Two fingerprints of b bytes that differ in at most d bits share at least b - d bytes at their
positions.  Postings of single bytes would hold a 1/256 of the corpus each, so the index posts sets
of byte positions instead, smaller than that minimum; within a posting list the shared positional
bytes of a pair are tallied, pairs with fewer than the minimum are dropped, and the rest is verified
bit by bit.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.llm.common import connected_components, free_name, materialize, numbered, scratch, small_batches, table, text_bytes, trimmed

SEED = 42
#: Row b: the bits of byte value b, lowest first.
BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.float64)


def shingle_hashes(text: bytes, k: int) -> np.ndarray:
    """XXH64 (seed 42) of each k-word shingle of the text with A-Z in lower case, repeats included."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, "<u8")
    if len(words) <= k:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words), SEED)], "<u8")
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = [0, *(ends[: len(words) - k] + 1).tolist()]
    return np.fromiter((digest(joined[a:b], SEED) for a, b in zip(starts, ends[k - 1 :].tolist(), strict=True)), "<u8", len(starts))


def majority(hashes: np.ndarray) -> int:
    """Signed 64-bit fingerprint: a bit is 1 if set in over half the hashes."""
    if not len(hashes):
        return 0
    counts = np.zeros(64)
    for at in range(0, len(hashes), 1 << 18):
        some = hashes[at : at + (1 << 18)].view(np.uint8).reshape(-1, 8).astype(np.int32) + 256 * np.arange(8, dtype=np.int32)
        counts += (np.bincount(some.ravel(), minlength=2048).reshape(8, 256) @ BITS).ravel()
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, k: int = 3, keep: str = "doc_id") -> DataFrame:
    """(keep, fp): the 64-bit fingerprint of each whole text as a signed long."""
    small_batches(docs.sparkSession)
    kind = docs.schema[keep].dataType.simpleString()
    schema = pa.schema([("id", pa.int64()), ("fp", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [majority(shingle_hashes(t, k)) for t in text_bytes(batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], schema=schema)

    rows = docs.select(F.col(keep).cast("bigint").alias("id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "id bigint, fp bigint").select(F.col("id").cast(kind).alias(keep), "fp")


#: A posting is two of the four 16-bit words: with at most two differing bytes two words at least agree.
WORDS = list(combinations(range(4), 2))
MIN_SHARED, MAX_BITS, SHORT_RUN = 6, 2, 64
#: Rows of a list beyond which it is dealt by two more bytes.
LONG_LIST = 4096


def _free_bytes(combo: int) -> list[int]:
    return [b for b in range(8) if b // 2 not in WORDS[combo]]


#: For each posting the ways to add two of the four bytes that it leaves out.
MORE = [list(combinations(_free_bytes(c), 2)) for c in range(len(WORDS))]


def _mask(positions: list[int] | tuple[int, ...]) -> int:
    """Signed 64-bit mask of the bytes at ``positions``."""
    return int(np.array(sum(255 << 8 * b for b in positions), "<u8").view("<i8"))


def _tallied(combo: np.ndarray, more: np.ndarray, fp: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows i and j of one list that share MIN_SHARED positional bytes and differ in one or two bits.

    A pair that meets in several lists is reported by the first.
    """
    apart = fp[i] ^ fp[j]
    same = apart.view(np.uint8).reshape(-1, 8) == 0
    kept = np.flatnonzero(same.sum(1) >= MIN_SHARED)
    kept = kept[(np.bitwise_count(apart[kept]) <= MAX_BITS) & (apart[kept] != 0)]
    i, j, same = i[kept], j[kept], same[kept]
    words = same[:, ::2] & same[:, 1::2]
    first = np.stack([words[:, a] & words[:, b] for a, b in WORDS], 1).argmax(1)
    good = first == combo[i]
    for c in range(len(WORDS)):
        rows = np.flatnonzero((combo[i] == c) & (more[i] >= 0))
        if len(rows):
            good[rows] &= np.stack([same[rows, a] & same[rows, b] for a, b in MORE[c]], 1).argmax(1) == more[i[rows]]
    return fp[i[good]], fp[j[good]]


def _links(combo: np.ndarray, more: np.ndarray, fp: np.ndarray, start: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Verified pairs in posting lists: every two rows of each list, whose beginnings are ``start``."""
    size = np.diff(np.append(start, len(fp)))
    run = np.repeat(np.arange(len(start)), size)
    rows = np.flatnonzero(size[run] > 1)
    for d in range(1, int(size.max(initial=0))):
        rows = rows[rows + d < len(fp)]
        rows = rows[run[rows] == run[rows + d]]
        yield _tallied(combo, more, fp, rows, rows + d)


def link_fingerprints(distinct: DataFrame) -> DataFrame:
    """(a, b) for every two different fingerprints of ``distinct(fp)`` at most two bits apart.

    Six postings for each fingerprint: two of the four 16-bit words.  A list of over ``LONG_LIST`` rows
    is dealt again by two more bytes, six ways, so that no list holds more than 2^16 different
    fingerprints, whatever the corpus.  Every pair of a list is tallied; a posting holds four bytes, of
    which the tally asks six.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def out(combo: np.ndarray, more: np.ndarray, key: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            new = np.flatnonzero(np.append(True, (key[1:] != key[:-1]) | (combo[1:] != combo[:-1]) | (more[1:] != more[:-1])))
            for a, b in _links(combo, more, fp.view("<u8"), new):
                if len(a):
                    yield pa.RecordBatch.from_arrays([pa.array(a.view("<i8")), pa.array(b.view("<i8"))], schema=schema)

        held: list[tuple[np.ndarray, ...]] = []
        rows = 0
        for batch in batches:
            held.append(tuple(batch.column(k).to_numpy(zero_copy_only=False) for k in range(4)))
            rows += len(batch)
            if rows >= 1 << 18:
                combo, more, key, fp = (np.concatenate(x) for x in zip(*held, strict=True))
                last = np.flatnonzero((key != key[-1]) | (combo != combo[-1]) | (more != more[-1]))
                cut = last[-1] + 1 if len(last) else 0
                if cut:
                    yield from out(combo[:cut], more[:cut], key[:cut], fp[:cut])
                held, rows = [(combo[cut:], more[cut:], key[cut:], fp[cut:])], len(fp) - cut
        if rows:
            yield from out(*(np.concatenate(x) for x in zip(*held, strict=True)))

    words = [_mask([2 * a, 2 * a + 1, 2 * b, 2 * b + 1]) for a, b in WORDS]
    postings = F.array(*[F.struct(F.lit(c).alias("combo"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for c, m in enumerate(words)])
    posted = distinct.select("fp", F.explode(postings).alias("p")).select("p.combo", "p.key", "fp")
    long = materialize(posted.groupBy("combo", "key").count().where(F.col("count") > LONG_LIST).select("combo", "key", F.lit(True).alias("long")), "long-lists")
    masks = F.array(*[F.lit(_mask(pair)) for pairs in MORE for pair in pairs])
    ways = F.when(F.col("long"), F.sequence(F.lit(0), F.lit(len(MORE[0]) - 1))).otherwise(F.array(F.lit(-1)))
    posted = posted.join(long, ["combo", "key"], "left").select("combo", F.explode(ways).alias("more"), "key", "fp")
    extra = F.when(F.col("more") < 0, F.lit(0)).otherwise(F.get(masks, F.col("combo") * len(MORE[0]) + F.col("more")))
    posted = posted.select("combo", "more", F.col("key").bitwiseOR(F.col("fp").bitwiseAND(extra)).alias("key"), "fp")
    return posted.repartition("combo", "more", "key").sortWithinPartitions("combo", "more", "key").mapInArrow(run, "a bigint, b bigint")


def simhash_groups(docs: DataFrame, k: int = 3) -> DataFrame:
    """(doc_id, fp, component_id): documents whose fingerprints link at two or fewer differing bits.

    Reads ``doc_id`` and ``text`` only.  A null text is empty; texts without words have fingerprint
    zero and link like any other.  Repeated rows link with each other; component_id is the smallest
    doc_id reachable, null only where no row of the component has a doc_id.  An empty table gives no
    rows.  Equal fingerprints are one node, so large groups of copies cost nothing in the index.
    """
    prints = materialize(fingerprints(docs, k), "fingerprints")
    with scratch(docs.sparkSession):
        classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "classes")
        near = connected_components(link_fingerprints(classes.select("fp")))
        roots = classes.join(near.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", F.coalesce("component", "fp").alias("root"))
        roots = materialize(roots, "roots")
        lows = materialize(roots.groupBy("root").agg(F.min("low").alias("component_id")), "lows")
        roots = materialize(roots.join(lows, "root").select("fp", "component_id"), "roots", outlive=1)
    return prints.join(roots, "fp").select("doc_id", "fp", "component_id")


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, 3-word shingles, two bits."""
    rows = simhash_groups(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


# --- wide fingerprints: Jaccard similarity 0.8 of 5-word shingles -----------------------------------

WIDE, KEY_BYTES = 4096, 3
#: Postings of three bytes each: 170 of neighbouring bytes and 170 of bytes in a mixed order.
PLACES = np.concatenate([order[: WIDE // 8 // KEY_BYTES * KEY_BYTES] for order in (np.arange(WIDE // 8), np.arange(WIDE // 8) * 205 % (WIDE // 8))])
LISTS = len(PLACES) // KEY_BYTES
#: Pairs with at least 4/5 of all their shingles in common link.
SHARED, OF_ALL = 4, 5
#: Bit agreement at the cosine 2J/(1+J) that Jaccard 0.8 guarantees is 0.849; less five deviations of 4,096 bits.
AGREE = 0.82
#: Expected shared positional bytes at 0.849 are 138; less five deviations.
MIN_TALLY = 85
#: Differing bits of the 64, and of the 256, that are compared first: 10 and 39 are expected at 0.849, and five deviations more.
MAX_APART, SOME_BYTES, SOME_APART = 24, 32, 67
#: Rows of an Arrow batch with two texts each.
TEXT_ROWS = 200
#: Rows of a posting list whose whole fingerprints are compared in one task, at about twice as many.
BLOCK = 1024
#: Rows of a posting list whose leading 256 bits are compared in one task; longer lists go in blocks there too.
LIST_ROWS = 1 << 14


def wide_fingerprints(sets: list[np.ndarray]) -> np.ndarray:
    """4,096-bit SimHash of each set of shingle hashes, as rows of 512 bytes.

    Each shingle's hash gives four signed places in a sketch of 4,096 counts; a Walsh-Hadamard
    transform turns the sketch into 4,096 random projections, whose signs are the bits.
    """
    sketch = np.zeros((len(sets), WIDE), np.float32)
    for row, h in zip(sketch, sets, strict=True):
        for shift in (0, 13, 26, 39):
            sign = 1.0 - 2.0 * ((h >> np.uint64(shift + 12)) & np.uint64(1)).astype(np.float64)
            row += np.bincount(((h >> np.uint64(shift)) & np.uint64(WIDE - 1)).astype(np.int64), sign, WIDE).astype(np.float32)
    step = 1
    while step < WIDE:
        pairs = sketch.reshape(len(sets), -1, 2, step)
        a = pairs[:, :, 0] + pairs[:, :, 1]
        np.subtract(pairs[:, :, 0], pairs[:, :, 1], out=pairs[:, :, 1])
        pairs[:, :, 0] = a
        step *= 2
    return np.packbits(sketch > 0, axis=1, bitorder="little")


def _close(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which rows of two arrays of wide fingerprints, one of which may be a single row, agree in enough bits and bytes."""
    good = np.bitwise_count(x.view("<u8") ^ y.view("<u8")).sum(1, dtype=np.int64) <= (1 - AGREE) * WIDE
    good[good] = (x[good] == (y if len(y) == 1 else y[good])).sum(1) >= MIN_TALLY
    return good


def _wide(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), WIDE // 8)


def _dealt(rows: DataFrame) -> DataFrame:
    """``rows(g, b, c, blocks, ...)`` as (list, two blocks, own block, c, b, the last column), by list and blocks.

    A list of many blocks is dealt as pairs of blocks, so no task holds more than two of them.
    """
    own = rows.withColumn("k", F.pmod(F.xxhash64("b"), F.col("blocks"))).withColumn("l", F.explode(F.expr("sequence(0L, blocks - 1)")))
    dealt = own.select("g", F.least("k", "l").alias("i"), F.greatest("k", "l").alias("j"), "k", "c", "b", "blocks", rows.columns[-1])
    return dealt.repartition("g", "i", "j").sortWithinPartitions("g", "i", "j")


def _compared(close: Callable[[np.ndarray, np.ndarray], np.ndarray], value: Callable[[pa.Array], np.ndarray], pairs: bool) -> Callable:
    """For ``mapInArrow`` over ``_dealt`` rows: pairs (a, b) of each list with different ``c`` whose last columns are ``close``.

    Without ``pairs``: (g, b, c, blocks) of the rows that stand in some such pair.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(g: np.ndarray, rid: np.ndarray, fp: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Rows of ``g``: list, two blocks, own block, component, number of blocks."""
            ends = np.append(np.flatnonzero((g[1:, :3] != g[:-1, :3]).any(1)) + 1, len(g))
            start, left, right = 0, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for end in ends.tolist():
                one = g[start, 1] == g[start, 2]
                for r in range(start, end - 1):
                    other = g[r + 1 : end, 4] != g[r, 4]
                    if not one:
                        other &= g[r + 1 : end, 3] != g[r, 3]
                    at = np.flatnonzero(other) + r + 1
                    at = at[close(fp[at], fp[r : r + 1])]
                    left.append(np.full(len(at), r))
                    right.append(at)
                start = end
            x, y = np.concatenate(left), np.concatenate(right)
            if pairs:
                columns, names = [np.minimum(rid[x], rid[y]), np.maximum(rid[x], rid[y])], ["a", "b"]
            else:
                rows = np.unique(np.append(x, y))
                columns, names = [g[rows, 0], rid[rows], g[rows, 4], g[rows, 5]], ["g", "b", "c", "blocks"]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in columns], names=names)

        for batch in batches:
            new = [np.stack([batch.column(i).to_numpy() for i in (0, 1, 2, 3, 4, 6)], axis=1), batch.column(5).to_numpy(), value(batch.column(7))]
            g, rid, fp = (np.concatenate(x) for x in zip(held, new, strict=True)) if held else new
            last = np.flatnonzero((g[:, :3] != g[-1, :3]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            if cut:
                yield from out(g[:cut], rid[:cut], fp[:cut])
            held = [g[cut:], rid[cut:], fp[cut:]]
        if held:
            yield from out(*held)

    return trimmed(compare)


def _near(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether the leading 256 bits, four words in the last axis, are near."""
    return np.bitwise_count(x ^ y).sum(-1, dtype=np.int64) <= SOME_APART


def _some(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u8").reshape(len(column), SOME_BYTES // 8)


def _with_partner(g: np.ndarray, c: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Which rows have a near row of another component in their list; rows are sorted by list."""
    hit = np.zeros(len(g), bool)
    start = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
    size = np.diff(np.append(start, len(g)))
    short = np.flatnonzero(np.repeat(size <= SHORT_RUN, size))
    for d in range(1, min(SHORT_RUN, int(size.max(initial=0)))):
        short = short[short + d < len(g)]
        short = short[g[short] == g[short + d]]
        both = short[(c[short] != c[short + d]) & _near(w[short], w[short + d])]
        hit[both] = hit[both + d] = True
    for at, n in zip(start[size > SHORT_RUN].tolist(), size[size > SHORT_RUN].tolist(), strict=True):
        own, bits = c[at : at + n], w[at : at + n]
        _, kind, counts = np.unique(own, return_inverse=True, return_counts=True)
        for r in np.array_split(others := np.flatnonzero(kind != counts.argmax()), 1 + len(others) * n // (1 << 19)):
            good = (own[r, None] != own[None]) & _near(bits[r, None], bits[None])
            hit[at + r[good.any(1)]] = True
            hit[at : at + n] |= good.any(0)
    return hit


def _pairs_of_lists(rows: DataFrame, prints: DataFrame) -> DataFrame:
    """(a, b): close pairs with different ``c`` in the lists of ``rows(g, b, c, v)``.

    First by the 256 bits ``v``; only rows that have a partner there meet again with whole fingerprints.
    """
    schema = pa.schema([("g", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("blocks", pa.int64()), ("v", pa.binary()), ("long", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by list: those with a partner, and all of a list of over LIST_ROWS."""
        held, long = None, None
        for batch in batches:
            new = np.vstack([*(batch.column(i).to_numpy() for i in range(3)), _some(batch.column(3)).view("<i8").T])
            rows = np.concatenate([held, new], axis=1) if held is not None else new
            cut = int(np.searchsorted(rows[0], rows[0, -1]))  # where the last list begins
            tail = rows[:, cut:]
            if tail.shape[1] > LIST_ROWS or long == tail[0, 0]:
                long, held, cut = int(tail[0, 0]), None, rows.shape[1]
            else:
                held = tail
            yield from out(rows[:, :cut], long)
        if held is not None:
            yield from out(held, long)

    def out(rows: np.ndarray, long: int | None) -> Iterator[pa.RecordBatch]:
        all_of = rows[0] == long if long is not None else np.zeros(rows.shape[1], bool)
        some = rows[:, ~all_of]
        some = some[:, _with_partner(some[0], some[2], some[3:].T.view("<u8"))] if some.shape[1] else some
        for part, flag in ((some, False), (rows[:, all_of], True)):
            if n := part.shape[1]:
                v = part[3:].T.tobytes()
                v = [v[SOME_BYTES * k : SOME_BYTES * (k + 1)] for k in range(n)] if flag else [None] * n
                _, own, size = np.unique(part[0], return_inverse=True, return_counts=True)
                blocks = -(-size[own] // BLOCK)
                yield pa.RecordBatch.from_arrays([*(pa.array(x) for x in part[:3]), pa.array(blocks), pa.array(v, pa.binary()), pa.array(np.full(n, flag))], schema=schema)

    dealt = rows.select("g", "b", "c", "v").repartition("g").sortWithinPartitions("g")
    some = materialize(dealt.mapInArrow(trimmed(run), "g bigint, b bigint, c bigint, blocks bigint, v binary, long boolean"), "partners")
    longer = some.where("long")
    size = longer.groupBy("g").agg(F.ceil(F.count("*") / LIST_ROWS).cast("bigint").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    longer = longer.drop("blocks").join(materialize(size.select("g", F.col("n").alias("blocks")), "long-lists"), "g").select("g", "b", "c", "blocks", "v")
    longer = _dealt(longer).mapInArrow(_compared(_near, _some, False), "g bigint, b bigint, c bigint, blocks bigint").distinct()
    some = some.where("NOT long").select("g", "b", "c", "blocks").unionAll(longer.select("g", "b", "c", F.col("blocks") * (LIST_ROWS // BLOCK)))
    # a row's fingerprint travels once, with all its lists
    by_row = some.groupBy("b").agg(F.first("c").alias("c"), F.collect_list(F.struct("g", "blocks")).alias("lists"))
    by_row = materialize(by_row, "rows-with-partners").join(prints.select(F.col("rid").alias("b"), "fp"), "b")
    whole = by_row.select(F.explode("lists").alias("l"), "b", "c", "fp").select("l.g", "b", "c", "l.blocks", "fp")
    return _dealt(whole).mapInArrow(_compared(_close, _wide, True), "a bigint, b bigint").distinct()


def _similar(pairs: DataFrame, docs: DataFrame, k: int, tag: str) -> DataFrame:
    """Pairs of ``pairs(a, b)`` whose texts in ``docs(rid, text)`` have Jaccard similarity 0.8 or more, exactly.

    One pair of each ``b`` comes first; of the others those that it leaves in different components.
    """
    spark = docs.sparkSession

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            good = np.zeros(len(batch), bool)
            left, right = (text_bytes(batch.column(i)) for i in (2, 3))
            for i, both in enumerate(zip(left, right, strict=True)):
                x, y = (np.unique(shingle_hashes(t, k)) for t in both)
                if SHARED * max(len(x), len(y)) <= OF_ALL * min(len(x), len(y)):
                    n = len(np.intersect1d(x, y, assume_unique=True))
                    good[i] = OF_ALL * n >= SHARED * (len(x) + len(y) - n)
            rows = pa.array(good)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(rows), batch.column(1).filter(rows)], names=["a", "b"])

    pairs = materialize(pairs, f"{tag}-pairs")
    used = pairs.select(F.col("a").alias("rid")).unionAll(pairs.select("b")).distinct()
    texts = materialize(docs.select("rid", "text").join(used, "rid", "left_semi"), f"{tag}-texts")

    def exact(some: DataFrame) -> DataFrame:
        small_batches(spark, TEXT_ROWS)
        with_a = some.join(texts.select(F.col("rid").alias("a"), F.col("text").alias("x")), "a")
        both = with_a.join(texts.select(F.col("rid").alias("b"), F.col("text").alias("y")), "b")
        found = materialize(both.select("a", "b", "x", "y").mapInArrow(trimmed(verify), "a bigint, b bigint"), tag)
        small_batches(spark)
        return found

    found = exact(pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"))
    near = connected_components(found)
    for c in "ab":
        pairs = pairs.join(near.select(F.col("node").alias(c), F.col("component").alias(f"of_{c}")), c, "left")
    rest = pairs.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")
    return found.unionAll(exact(rest))


def near_copy_links(docs: DataFrame, k: int = 5) -> DataFrame:
    """(a, b): row numbers of texts whose sets of k-word shingles have Jaccard similarity 0.8 or more.

    ``docs(rid, text)`` must give the same rows each time.  Texts with equal sets are one class.
    Candidates share one of 340 sets of three positional bytes of the wide fingerprint; at similarity
    0.8 a pair shares one with probability 0.999, and what shares none is not found.  Candidates with
    ``AGREE`` of the bits and ``MIN_TALLY`` shared positional bytes are verified on the texts
    themselves, so no link is below 0.8.  First each row is compared with one other: with that which
    leads most of its lists.  Then, in lists whose rows these links leave in different components,
    every two rows of different components.  So all pairs of every list count, but pairs that links
    already join are left out: the components are those of all pairs.
    """
    small_batches(docs.sparkSession)
    prints_schema = pa.schema([("rid", pa.int64()), ("same", pa.binary()), ("w", pa.int64()), ("v", pa.binary()), ("fp", pa.binary())])

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = text_bytes(batch.column(1))
            for at in range(0, len(texts), 256):
                sets = [np.unique(shingle_hashes(t, k)) for t in texts[at : at + 256]]
                fps = wide_fingerprints(sets)
                rid = batch.column(0).slice(at, len(sets))
                same = [xxhash.xxh3_128_digest(h.tobytes()) for h in sets]
                some = pa.array(np.ascontiguousarray(fps[:, 5::64]).view("<i8").ravel())
                lead = [f.tobytes() for f in fps[:, 3 :: WIDE // 8 // SOME_BYTES]]
                columns = [rid, pa.array(same, pa.binary()), some, pa.array(lead, pa.binary()), pa.array([f.tobytes() for f in fps], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, schema=prints_schema)

    post_schema = pa.schema([("g", pa.int64()), ("rid", pa.int64())])

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = _wide(batch.column(1))[:, PLACES].reshape(len(batch), LISTS, KEY_BYTES).astype(np.int64)
            keys = parts[:, :, 0] | parts[:, :, 1] << 8 | parts[:, :, 2] << 16 | np.arange(LISTS) << 24
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(batch.column(0).to_numpy(), LISTS))], schema=post_schema)

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by list and row number: each row of a list of two or more, with the list's first."""
        schema = pa.schema([("g", pa.int64()), ("a", pa.int64()), ("b", pa.int64())])
        last = (-1, -1, False)  # list, its first row, and whether that has been given
        for batch in batches:
            g, rid = (batch.column(i).to_numpy() for i in range(2))
            new = np.append(g[0] != last[0], g[1:] != g[:-1])
            start = np.maximum.accumulate(np.where(new, np.arange(len(g)), -1))
            head = np.where(start >= 0, rid[start], last[1])
            second = np.append(not new[0] and not last[2], ~new[1:] & new[:-1])
            last = (int(g[-1]), int(head[-1]), bool(not new[-1]))
            columns = [np.append(g[~new], g[second]), np.append(head[~new], head[second]), np.append(rid[~new], head[second])]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], schema=schema)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.array(_close(_wide(batch.column(2)), _wide(batch.column(3))))
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(rows), batch.column(1).filter(rows)], names=["a", "b"])

    with scratch(docs.sparkSession):
        prints = materialize(docs.select("rid", "text").mapInArrow(trimmed(make), "rid bigint, same binary, w bigint, v binary, fp binary"), "wide")
        low = materialize(prints.groupBy("same").agg(F.min("rid").alias("a")), "wide-classes")
        copies = materialize(prints.select("rid", "same").join(low, "same").where("rid <> a").select("a", F.col("rid").alias("b")), "copies")
        heads = prints.select("rid", "fp").join(low.select(F.col("a").alias("rid")), "rid", "left_semi")
        posted = heads.mapInArrow(trimmed(post), "g bigint, rid bigint").repartition("g").sortWithinPartitions("g", "rid")
        members = materialize(posted.mapInArrow(trimmed(lead), "g bigint, a bigint, b bigint"), "members")

        found = members.where("a <> b").groupBy("a", "b").agg(F.count("*").alias("lists"))
        found = found.groupBy("b").agg(F.max_by("a", F.struct("lists", -F.col("a"))).alias("a")).select("a", "b")
        for c in "ab":
            found = found.join(prints.select(F.col("rid").alias(c), F.col("w").alias(f"w_{c}")), c)
        found = found.where(F.bit_count(F.col("w_a").bitwiseXOR(F.col("w_b"))) <= MAX_APART).select("a", "b")
        with_a = found.join(prints.select(F.col("rid").alias("a"), F.col("fp").alias("x")), "a")
        both = with_a.join(prints.select(F.col("rid").alias("b"), F.col("fp").alias("y")), "b")
        first = _similar(both.select("a", "b", "x", "y").mapInArrow(trimmed(verify), "a bigint, b bigint"), docs, k, "first-links")

        near = connected_components(first).select(F.col("node").alias("rid"), "component")
        facts = prints.select("rid", "v").join(near, "rid", "left").select(F.col("rid").alias("b"), F.coalesce("component", "rid").alias("c"), "v")
        rest = materialize(members.select("g", "b").join(facts, "b"), "rest")
        links = copies.unionAll(first).unionAll(_similar(_pairs_of_lists(rest, prints), docs, k, "list-links"))
        return materialize(links, "near-links", outlive=1)


def keep_one_of_each_group(docs: DataFrame, k: int = 5) -> DataFrame:
    """The documents without near copies: of each group linked by ``near_copy_links`` one row stays.

    It is the row with the smallest doc_id (nulls last), then the first in the order of files.  Texts
    without words are copies of each other.  All columns stay; an empty table gives no rows.
    """
    spark = docs.sparkSession
    rid = free_name(docs, "_rid")
    rows = numbered(docs, rid)
    with scratch(spark):
        near = connected_components(near_copy_links(rows.select(F.col(rid).alias("rid"), F.col("text").cast("string").alias("text")), k))
        order = F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id"), F.col("node"))
        members = near.join(rows.select(F.col(rid).alias("node"), "doc_id"), "node").select("component", order.alias("o"))
        members = materialize(members, "members")
        best = materialize(members.groupBy("component").agg(F.min("o").alias("best")), "best")
        gone = members.join(best, "component").where("o <> best OR (o.doc_id IS NULL) AND o.node <> best.node")
        gone = materialize(gone.select(F.col("o.node").alias(rid)), "gone", outlive=1)
    return rows.join(gone, rid, "left_anti").select(*[F.col(f"`{c}`") for c in docs.columns])
