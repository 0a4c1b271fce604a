"""Suffix-array dedup: every byte covered by a string of 400 bytes that also starts elsewhere.

A suffix array of the whole corpus is one huge sort.  Here each 400-byte window is first sent to the
place of its minimiser, a 100-byte substring that depends on the window's bytes alone: equal windows
have equal minimisers, so only texts around repeated minimisers need a suffix array, and those are
small, independent and built by two-stage sorting.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.llm.common import free_name, materialize, numbered, scratch, small_batches, table, text_bytes

LENGTH, GRAM = 400, 100
#: Bytes looked at together, and bytes of one suffix array.
BLOCK, ARRAY_BYTES = 1 << 19, 1 << 19
_rng = np.random.default_rng(400)
TABLE = _rng.integers(0, 1 << 63, 257, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
UNBASE = np.uint64(pow(int(BASE), -1, 1 << 64))


class Rolling:
    """Hashes of any substring, from prefix sums of a polynomial modulo 2^64."""

    up = down = np.ones(1, np.uint64)

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        if len(Rolling.up) < n + 1:
            ones = np.ones(n + (1 << 16), np.uint64)
            Rolling.up = np.cumprod(np.append(ones[:1], ones[1:] * BASE), dtype=np.uint64)
            Rolling.down = np.cumprod(np.append(ones[:1], ones[1:] * UNBASE), dtype=np.uint64)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(TABLE[symbols] * Rolling.up[:n], out=self.sums[1:])

    def all(self, size: int) -> np.ndarray:
        h = (self.sums[size:] - self.sums[:-size]) * Rolling.down[: len(self.sums) - size]
        return mixed(h)

    def at(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return (self.sums[start + size] - self.sums[start]) * Rolling.down[start]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def minimiser_runs(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one minimiser: start of the first window, number of windows, place and hash of the minimiser.

    ``begin`` and ``end`` bound the texts in ``data``; no window crosses them.
    """
    grams = Rolling(data).all(GRAM)
    key = grams & np.uint64(0xFFFFFFFF00000000) | np.arange(len(grams), dtype=np.uint64)  # ties: leftmost
    span, step = LENGTH - GRAM + 1, 1
    while 2 * step <= span:
        key = np.minimum(key[:-step], key[step:])
        step *= 2
    key = np.minimum(key[: len(key) - (span - step)], key[span - step :])
    counts = end - begin - LENGTH + 1
    good = counts > 0
    first, counts = begin[good], counts[good]
    start = np.repeat(first - np.append(0, np.cumsum(counts)[:-1]), counts) + np.arange(counts.sum())
    place = (key[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.append(True, (place[1:] != place[:-1]) | (start[1:] != start[:-1] + 1)) if len(place) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    return start[at], np.diff(np.append(at, len(place))), place[at], grams[place[at]]


def runs_of(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start in the text, windows, minimiser's distance from there, its hash, digest) of all runs.

    Long texts go in blocks of windows.
    """
    units = [(i, s, min(s + BLOCK, len(t) - LENGTH + 1)) for i, t in enumerate(texts) for s in range(0, len(t) - LENGTH + 1, BLOCK)]
    at = 0
    while at < len(units):
        some, size = [], 0
        while at < len(units) and (not some or size < BLOCK):
            i, s, e = units[at]
            some.append((i, s, texts[i][s : e + LENGTH - 1]))
            size += len(some[-1][2])
            at += 1
        joined = b"".join(x[2] for x in some)
        end = np.cumsum([len(x[2]) for x in some])
        begin = np.append(0, end[:-1])
        start, windows, place, gram = minimiser_runs(np.frombuffer(joined, np.uint8), begin, end)
        unit = np.searchsorted(end, start, "right")
        digest = xxhash.xxh3_128_digest
        d = np.frombuffer(b"".join([digest(joined[a:b]) for a, b in zip(start.tolist(), (start + windows + LENGTH - 1).tolist(), strict=True)]), "<i8").reshape(-1, 2)
        shift = np.array([x[1] for x in some]) - begin
        yield np.array([x[0] for x in some])[unit], start + shift[unit], windows, place - start, gram.view(np.int64), d


# --- two-stage suffix sorting --------------------------------------------------------------------


def smaller_than_next(t: np.ndarray) -> np.ndarray:
    """Whether each suffix is smaller than its successor; the last one is not."""
    n = len(t)
    where = np.append(np.where(t[:-1] != t[1:], np.arange(n - 1), n - 1), n - 1)
    after = np.minimum.accumulate(where[::-1])[::-1]
    return np.append(t[:-1] < t[1:], False)[after]


def sort_directly(t: np.ndarray, pos: np.ndarray, depth_most: int, rolling: Rolling) -> np.ndarray:
    """``pos`` ordered by the suffixes there, as far as ``depth_most`` symbols; ``t`` is padded with zeros.

    Seven symbols at a time; groups that agree in the next 56 (by hash) skip them without sorting.
    """
    word = np.zeros(len(t) - 6, np.uint64)
    for k in range(7):
        word = word << np.uint64(9) | t[k : len(t) - 6 + k].astype(np.uint64)
    pos = pos[np.argsort(word[pos], kind="stable")]
    slots, depth = np.arange(len(pos)), np.zeros(len(pos), np.int64)
    new = np.append(True, word[pos][1:] != word[pos][:-1]) if len(pos) else np.zeros(0, bool)
    depth += 7
    while True:
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(slots)))
        live = np.repeat((size > 1), size) & (depth < depth_most)
        slots, depth, new = slots[live], depth[live], new[live]
        if not len(slots):
            return pos
        start = np.flatnonzero(new)
        size = np.diff(np.append(start, len(slots)))
        here = pos[slots] + depth
        h = rolling.at(here, 56)
        same = np.repeat(np.minimum.reduceat(h, start) == np.maximum.reduceat(h, start), size)
        apart = np.flatnonzero(~same)
        group = np.repeat(np.arange(len(start)), size)
        w = word[here[apart]]
        order = np.lexsort((w, group[apart]))
        pos[slots[apart]] = pos[slots[apart]][order]
        w = w[order]
        new[apart] = np.append(True, (w[1:] != w[:-1]) | (group[apart][1:] != group[apart][:-1])) if len(apart) else []
        depth = depth + np.where(same, 56, 7)


def induce(t: np.ndarray, small: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """The suffix array from the sorted suffixes that are smaller than their successors.

    Scans the buckets of first symbols upwards: each entry's predecessor that is larger than it goes
    to the front of its own bucket.  Predecessors in the same bucket come in waves.
    """
    n = len(t)
    first = t[ordered]
    bounds = np.searchsorted(first, np.arange(258))
    fronts: list[list[np.ndarray]] = [[] for _ in range(258)]
    fronts[t[n - 1]].append(np.array([n - 1]))
    out = []
    for c in range(257):
        wave = np.concatenate(fronts[c]) if fronts[c] else np.zeros(0, np.int64)
        parts = [wave]
        while len(wave):
            before = wave[wave > 0] - 1
            wave = before[(t[before] == c) & ~small[before]]
            parts.append(wave)
        parts.append(ordered[bounds[c] : bounds[c + 1]])
        bucket = np.concatenate(parts)
        out.append(bucket)
        before = bucket[bucket > 0] - 1
        before = before[(t[before] > c) & ~small[before]]
        if len(before):
            symbol = t[before]
            order = np.argsort(symbol, kind="stable")
            before, symbol = before[order], symbol[order]
            cut = np.flatnonzero(symbol[1:] != symbol[:-1]) + 1
            for piece, s in zip(np.split(before, cut), symbol[np.append(0, cut)].tolist(), strict=True):
                fronts[s].append(piece)
    return np.concatenate(out)


def suffix_array(t: np.ndarray, depth: int) -> tuple[np.ndarray, Rolling]:
    """Suffixes of the symbols 0-256 in order as far as ``depth`` symbols, and hashes of their substrings."""
    padded = np.append(t, np.zeros(depth + 64, t.dtype))
    rolling = Rolling(padded)
    small = smaller_than_next(t)
    ordered = sort_directly(padded, np.flatnonzero(small), depth, rolling)
    return induce(t, small, ordered), rolling


def common_prefixes(order: np.ndarray, most: int, rolling: Rolling) -> np.ndarray:
    """Of each two adjacent suffixes the length of the common prefix, as far as ``most``."""
    a, b = order[:-1], order[1:]
    low, high = np.zeros(len(a), np.int64), np.full(len(a), most)
    while (low < high).any():
        mid = (low + high + 1) // 2
        same = rolling.at(a, mid) == rolling.at(b, mid)
        low, high = np.where(same, mid, low), np.where(same, high, mid - 1)
    return low


def repeated_windows(segments: list[bytes]) -> list[np.ndarray]:
    """For each segment, which of its 400-byte windows stand at another place of the segments too."""
    t = np.concatenate([np.append(np.frombuffer(s, np.uint8).astype(np.uint16) + np.uint16(1), np.uint16(0)) for s in segments])
    order, rolling = suffix_array(t, LENGTH)
    sizes = np.array([len(s) for s in segments])
    begin = np.append(0, np.cumsum(sizes + 1)[:-1])
    window = np.zeros(len(t) + 1, np.int32)
    np.add.at(window, begin, 1)
    np.add.at(window, begin + np.maximum(sizes - LENGTH + 1, 0), -1)
    window = np.cumsum(window[:-1]) > 0
    order = order[window[order]]
    hit = np.zeros(len(t), bool)
    same = np.flatnonzero(common_prefixes(order, LENGTH, rolling) >= LENGTH)
    hit[order[same]] = True
    hit[order[same + 1]] = True
    return [hit[b : b + max(0, n - LENGTH + 1)] for b, n in zip(begin.tolist(), sizes.tolist(), strict=True)]


def ranges(flags: np.ndarray) -> list[dict]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return [{"lo": a, "hi": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]


# --- the distributed operator --------------------------------------------------------------------

RANGES = "array<struct<lo:int,hi:int>>"
RANGES_ARROW = pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())]))
CLASS = [("g", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64())]
#: A part of a class's run: its first window, the common string of its windows (place and hash), and its bytes.
PART = [*CLASS, ("n", pa.int64()), ("lo", pa.int32()), ("k0", pa.int32()), ("k1", pa.int32()), ("key", pa.int64())]


def ddl(fields: list[tuple[str, pa.DataType]]) -> str:
    names = {pa.int64(): "bigint", pa.int32(): "int", pa.binary(): "binary", RANGES_ARROW: RANGES}
    return ", ".join(f"{k} {names[v]}" for k, v in fields)


def halves(k0: int, k1: int, m: int) -> Iterator[tuple[int, int, int, int]]:
    """(first window, end of windows, k0, k1): the windows around a common string, by a longer one.

    All ``m`` windows hold the string k0 to k1.  Those that reach far enough to the left of it hold it
    and half of the bytes that it lacks to a whole window, before it; the others, the rest behind it.
    Equal windows hold the string at one place, so they come to one half and one longer string.
    """
    free = LENGTH - (k1 - k0)
    half = (free + 1) // 2
    cut = min(max(k0 - half + 1, 0), m)
    if cut:
        yield 0, cut, k0 - half, k1
    if cut < m:
        yield cut, m, k0 - cut, k1 + free - half + 1 - cut


def array_flags(parts: DataFrame) -> DataFrame:
    """(g, d1, d2, ranges): windows of parts with n = 1 that stand at another place of the parts with their key.

    ``parts`` holds the columns of ``PART`` and ``bytes``, and at most ``ARRAY_BYTES`` for each key.
    """
    schema = pa.schema([*CLASS, ("ranges", RANGES_ARROW)])

    def arrays(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by key; whole keys together, about ARRAY_BYTES at a time."""
        held: list[tuple] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows: dict[str, list] = {k: [] for k in schema.names}
            for row, flags in zip(held, repeated_windows([r[6] for r in held]), strict=True):
                if row[4] == 1 and flags.any():
                    spans = [{"lo": x["lo"] + row[5], "hi": x["hi"] + row[5]} for x in ranges(flags)]
                    for k, v in zip(rows, (*row[1:4], spans), strict=True):
                        rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=schema)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True):
                if size > ARRAY_BYTES and held[-1][0] != row[0]:
                    yield from flush()
                    held, size = [], 0
                held.append(row)
                size += len(row[6])
        if held:
            yield from flush()

    few = parts.select("key", "g", "d1", "d2", "n", "lo", "bytes")
    return few.repartition("key").sortWithinPartitions("key").mapInArrow(arrays, ddl(list(zip(schema.names, schema.types))))


def split_parts(parts: DataFrame) -> DataFrame:
    """Parts by their longer common strings (``halves``), with a digest (e1, e2) of each one's bytes."""
    schema = pa.schema([*PART, ("e1", pa.int64()), ("e2", pa.int64()), ("bytes", pa.binary())])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: dict[str, list] = {k: [] for k in schema.names}
            for g, d1, d2, n, lo, k0, k1, data in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                for a, b, x, y in halves(k0, k1, len(data) - LENGTH + 1):
                    some = data[a : b + LENGTH - 1]
                    key = int.from_bytes(xxhash.xxh3_64_digest(some[x:y]), "little", signed=True)
                    e1, e2 = np.frombuffer(xxhash.xxh3_128_digest(some), "<i8").tolist()
                    for k, v in zip(out, (g, d1, d2, n, lo + a, x, y, key, e1, e2, some), strict=True):
                        out[k].append(v)
            yield pa.RecordBatch.from_pydict(out, schema=schema)

    return parts.select("g", "d1", "d2", "n", "lo", "k0", "k1", "bytes").mapInArrow(split, ddl(list(zip(schema.names, schema.types))))


def repeated_ranges(parts: DataFrame) -> DataFrame:
    """(g, d1, d2, ranges) for the classes of ``parts``: the windows that stand in another part with the same key.

    Keys with at most ``ARRAY_BYTES`` go to a suffix array.  The parts of the others are cut in two by
    a longer common string, as often as it takes: nine times at most, then that string is the window.
    What has equal bytes after a cut repeats whole, and one of it goes on.
    """
    found = []
    while True:
        found.append(materialize(array_flags(parts.where(F.col("total") <= ARRAY_BYTES)), "array-flags"))
        hot = parts.where(F.col("total") > ARRAY_BYTES)
        if hot.isEmpty():
            return functools.reduce(DataFrame.unionAll, found)
        cut = materialize(split_parts(hot), "parts")
        part = F.struct(*[name for name, _ in PART if name not in ("n", "key")], "bytes")
        classes = cut.groupBy("key", "e1", "e2").agg(F.count("*").alias("k"), F.min("n").alias("least"), F.first(part).alias("r"))
        classes = materialize(classes, "part-classes")
        whole = cut.where("n = 1").join(classes.where("k > 1").select("key", "e1", "e2"), ["key", "e1", "e2"])
        last = F.col("lo") + F.octet_length("bytes") - (LENGTH - 1)
        found.append(materialize(whole.select("g", "d1", "d2", F.array(F.struct("lo", last.alias("hi"))).cast(RANGES).alias("ranges")), "array-flags"))
        one = F.when(F.col("k") > 1, F.lit(2).cast("bigint")).otherwise(F.col("least"))
        classes = classes.select("r.*", one.alias("n"), "key")
        parts = materialize(with_totals(classes, F.octet_length("bytes")), "hot-parts")


def with_totals(classes: DataFrame, size: Column) -> DataFrame:
    """``classes`` whose key others share, where one is alone of its bytes, with ``total`` bytes of the key."""
    keys = classes.groupBy("key").agg(F.count("*").alias("c"), F.min("n").alias("least"), F.sum(size.cast("bigint")).alias("total"))
    return classes.join(materialize(keys.where("c > 1 AND least = 1").select("key", "total"), "keys"), "key")


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with ``kept`` (binary), ``n_bytes``, ``n_removed``, ``n_spans``: see the module's head.

    Bytes are the UTF-8 of ``text``; a null or empty text has none, and texts under 400 bytes keep all.
    Matches never cross documents; a string that starts twice in one text counts, overlaps too, and
    repeated rows remove each other.  Strings are judged on the input.  All columns stay, but for those
    named like the four, which are replaced; an empty table gives no rows.  Windows are equal when 128-bit digests of their surroundings are, or 64-bit
    hashes of adjacent suffixes inside one suffix array.

    Runs of windows around one minimiser fall into classes of equal bytes; the windows of a class with
    two members repeat.  Of other classes with the same minimiser one member's bytes go to a suffix
    array; a minimiser with too many different classes for one is made longer (``repeated_ranges``).
    """
    small_batches(docs.sparkSession, 1000)
    rid = free_name(docs, "_rid")
    with_ids = numbered(docs, rid)
    texts = with_ids.select(F.col(rid).alias("rid"), F.col("text").cast("string").alias("text"))
    run_fields = [("rid", pa.int64()), ("a", pa.int32()), ("m", pa.int32()), ("o", pa.int32()), *CLASS]
    run_schema = pa.schema(run_fields)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rid = batch.column(0).to_numpy()
            for row, a, m, o, g, d in runs_of(text_bytes(batch.column(1))):
                columns = (rid[row], a.astype(np.int32), m.astype(np.int32), o.astype(np.int32), g, d[:, 0].copy(), d[:, 1].copy())
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=run_schema)

    part_schema = pa.schema([*PART, ("total", pa.int64()), ("bytes", pa.binary())])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in part_schema.names}
            for text, wanted_ in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                for w in wanted_:
                    for k, v in zip(rows, (w["g"], w["d1"], w["d2"], w["n"], 0, w["o"], w["o"] + GRAM, w["g"], w["total"], text[w["a"] : w["a"] + w["m"] + LENGTH - 1]), strict=True):
                        rows[k].append(v)
            yield pa.RecordBatch.from_pydict(rows, schema=part_schema)

    with scratch(docs.sparkSession):
        runs = materialize(texts.mapInArrow(scan, ddl(run_fields)), "runs")
        twice = materialize(runs.groupBy("g").agg(F.count("*").alias("n")).where("n > 1").select("g"), "repeated-grams")
        runs = materialize(runs.join(twice, "g"), "repeated-runs")
        classes = runs.groupBy("g", "d1", "d2").agg(F.count("*").alias("n"), F.min(F.struct("rid", "a", "m", "o")).alias("one"))
        classes = materialize(classes, "run-classes")
        wanted = with_totals(classes.withColumn("key", F.col("g")), F.col("one.m") + LENGTH - 1)
        wanted = wanted.select("one.rid", F.struct("one.a", "one.m", "one.o", "g", "d1", "d2", "n", "total").alias("w"))
        wanted = wanted.groupBy("rid").agg(F.collect_list("w").alias("wanted"))
        parts = texts.join(wanted, "rid").select("text", "wanted").mapInArrow(extract, ddl(list(zip(part_schema.names, part_schema.types))))
        by_array = repeated_ranges(materialize(parts, "segments"))
        whole = classes.where("n > 1").select("g", "d1", "d2", F.expr("array(struct(0 AS lo, one.m AS hi))").alias("ranges"))
        spans = runs.join(whole.unionAll(by_array), ["g", "d1", "d2"]).groupBy("rid").agg(
            F.array_sort(F.flatten(F.collect_list(F.expr(f"transform(ranges, r -> struct(a + r.lo AS lo, a + r.hi + {LENGTH - 1} AS hi))")))).alias("spans")
        )
        spans = materialize(spans, "spans", outlive=1)
    names = [c for c in docs.columns if c.lower() not in ("kept", "n_bytes", "n_removed", "n_spans")]
    rest = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"])
    packed = with_ids.select(F.col(rid).alias("rid"), F.col("text").cast("string").alias("text"), rest.alias("rest"))
    joined = packed.join(spans, "rid", "left")
    rest_type = docs.select(rest.alias("rest")).schema["rest"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, sizes, runs_ = [], [], []
            for text, spans_ in zip(text_bytes(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                edges: list[list[int]] = []
                for s in spans_ or ():
                    if edges and s["lo"] <= edges[-1][1]:
                        edges[-1][1] = max(edges[-1][1], s["hi"])
                    else:
                        edges.append([s["lo"], s["hi"]])
                ends = [0, *(x for e in edges for x in e), len(text)]
                kept.append(b"".join(text[a:b] for a, b in zip(ends[::2], ends[1::2], strict=True)) if edges else text)
                sizes.append(len(text))
                runs_.append(len(edges))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(kept, pa.binary()), pa.array(sizes, pa.int64()), pa.array(runs_, pa.int64())],
                names=["text", "rest", "kept", "n_bytes", "n_spans"],
            )

    done = joined.select("text", "spans", "rest").mapInArrow(
        cut, f"text string, rest {rest_type}, kept binary, n_bytes bigint, n_spans bigint"
    )
    columns = [F.col("text") if c == "text" else F.col(f"rest.`{c}`") for c in names]
    return done.select(*columns, "kept", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"), "n_spans")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of repeated 400-byte strings."""
    rows = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
