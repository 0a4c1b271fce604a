"""Token-id output: one wavelet matrix for each shard of documents, in a compressed payload."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from stemma.llm.bpe import default_vocabulary, encoder
from stemma.llm.common import materialize, part_id, small_batches, table, trimmed

MAGIC, BLOCK = b"WVMX2", 512
#: Bytes of a plane in one compressed frame, and how many equal bits lie between two select samples.
CHUNK, STRIDE = 8192, 4096
END = b"\0\0\0\0"
SHARDS = "part int, seq int, n_docs bigint, n_tokens bigint, payload binary"
SHARDS_ARROW = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())]
)
DOCS = "part int, seq int, doc_id bigint, start_in_shard bigint, n_tokens bigint"
DOCS_ARROW = [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("start_in_shard", pa.int64()), ("n_tokens", pa.int64())]


def build(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int]) -> bytes:
    """The payload: header, places of the frames, then the frames, each compressed alone.

    The first frame is the document table.  Each bit-plane has a frame with its directories (counts of
    ones by block; the block of every ``STRIDE``-th one and zero) and frames of ``CHUNK`` bytes of bits.
    """
    levels = max(1, int(ids.max(initial=0)).bit_length())
    seq = ids.astype(np.uint16 if levels <= 16 else np.uint32)
    null = np.array([x is None for x in doc_ids], np.uint8)
    parts = [np.array([x or 0 for x in doc_ids], "<i8").tobytes() + np.array(lengths, "<i8").tobytes() + null.tobytes()]
    zeros = []
    for level in range(levels - 1, -1, -1):
        one = (seq >> level) & 1 > 0
        packed = np.packbits(one, bitorder="little")
        packed = np.pad(packed, (0, -len(packed) % (BLOCK // 8)))
        ones = np.bitwise_count(packed.view("<u8")).reshape(-1, BLOCK // 64).sum(1, dtype="<u4")
        set_at, clear_at = np.flatnonzero(one), np.flatnonzero(~one)
        samples = np.concatenate([set_at[::STRIDE], clear_at[::STRIDE]]) // BLOCK
        parts.append(np.cumsum(ones, dtype="<u4").tobytes() + samples.astype("<u4").tobytes())
        bits = packed.tobytes()
        parts += [bits[k : k + CHUNK] for k in range(0, len(bits), CHUNK)]
        zeros.append(len(clear_at))
        seq = np.concatenate([seq.take(clear_at), seq.take(set_at)])
    squeeze = zstandard.ZstdCompressor(level=1)
    frames = [squeeze.compress(x) for x in parts]
    head = struct.pack(f"<5sBqq{levels}q", MAGIC, levels, len(ids), len(doc_ids), *zeros)
    return head + np.cumsum([0, *map(len, frames)], dtype="<u4").tobytes() + b"".join(frames)


class WaveletShard:
    """Reads one payload: any token, counts and places of a token, documents, or all ids again.

    A frame is decompressed when it is first needed: rank and access touch the directory and one frame
    of each plane, so a question does not open the whole file.  ``opened`` counts frames.
    """

    def __init__(self, payload: bytes):
        magic, self.levels, self.n, self.n_docs = struct.unpack_from("<5sBqq", payload)
        if magic != MAGIC:
            raise ValueError("not a wavelet shard")
        at = struct.calcsize("<5sBqq")
        self.zeros = struct.unpack_from(f"<{self.levels}q", payload, at)
        self.blocks = -(-self.n // BLOCK)
        self.chunks = -(-self.blocks * (BLOCK // 8) // CHUNK)
        frames, at = 1 + self.levels * (1 + self.chunks), at + 8 * self.levels
        self.ends = np.frombuffer(payload, "<u4", frames + 1, at).astype(np.int64) + at + 4 * (frames + 1)
        self.payload, self.opened = memoryview(payload), 0
        self.unzip = zstandard.ZstdDecompressor()
        self.bits: dict[tuple[int, int], np.ndarray] = {}
        self.directories: dict[int, tuple[np.ndarray, ...]] = {}
        docs = self._frame(0)
        self.doc_ids = np.frombuffer(docs, "<i8", self.n_docs)
        self.lengths = np.frombuffer(docs, "<i8", self.n_docs, 8 * self.n_docs)
        self.null = np.frombuffer(docs, np.uint8, self.n_docs, 16 * self.n_docs)

    def _frame(self, k: int) -> bytes:
        self.opened += 1
        return self.unzip.decompress(self.payload[self.ends[k] : self.ends[k + 1]])

    def _chunk(self, level: int, chunk: int) -> np.ndarray:
        if (level, chunk) not in self.bits:
            self.bits[level, chunk] = np.frombuffer(self._frame(2 + level * (1 + self.chunks) + chunk), np.uint8)
        return self.bits[level, chunk]

    def _directory(self, level: int) -> tuple[np.ndarray, ...]:
        """Ones before each block, and the blocks of the sampled zeros and ones, closed by the last block."""
        if level not in self.directories:
            every = np.frombuffer(self._frame(1 + level * (1 + self.chunks)), "<u4").astype(np.int64)
            n_set = -(-(self.n - self.zeros[level]) // STRIDE)
            before, samples, last = np.concatenate([[0], every[: self.blocks]]), every[self.blocks :], [max(0, self.blocks - 1)]
            self.directories[level] = before, np.concatenate([samples[n_set:], last]), np.concatenate([samples[:n_set], last])
        return self.directories[level]

    def _block(self, level: int, block: int) -> np.ndarray:
        at = block * (BLOCK // 8)
        return self._chunk(level, at // CHUNK)[at % CHUNK : at % CHUNK + BLOCK // 8]

    def _bit(self, level: int, i: int) -> int:
        return int(self._block(level, i // BLOCK)[(i % BLOCK) >> 3] >> (i & 7)) & 1

    def _ones(self, level: int, i: int) -> int:
        """Ones of a plane before position i."""
        block, inside = divmod(i, BLOCK)
        ones = int(self._directory(level)[0][block])
        if inside:
            bits = self._block(level, block)
            ones += int(np.bitwise_count(bits[: inside >> 3]).sum())
            ones += (int(bits[inside >> 3]) & ((1 << (inside & 7)) - 1)).bit_count()
        return ones

    def _select(self, level: int, bit: int, ks: np.ndarray) -> np.ndarray:
        """Places of the k-th (from 0) such bits: the samples bound the blocks, the counts choose one."""
        before, *samples = self._directory(level)
        if not bit:
            before = np.arange(len(before)) * BLOCK - before
        lo, hi = samples[bit][ks // STRIDE], samples[bit][ks // STRIDE + 1]
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            up = before[mid] <= ks
            lo, hi = np.where(up, mid, lo), np.where(up, hi, mid - 1)
        out = np.empty(len(ks), np.int64)
        order = np.argsort(lo, kind="stable")
        cuts = np.flatnonzero(np.diff(lo[order], prepend=-1))
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(ks)], strict=True):
            block, mine = int(lo[order[a]]), order[a:b]
            places = np.flatnonzero(np.unpackbits(self._block(level, block), bitorder="little") == bit)
            out[mine] = block * BLOCK + places[ks[mine] - before[block]]
        return out

    def access(self, i: int) -> int:
        value = 0
        for level in range(self.levels):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, i: int) -> tuple[int, int]:
        lo, hi = 0, i
        for level in range(self.levels):
            bit = token >> (self.levels - 1 - level) & 1
            a, b = self._ones(level, lo), self._ones(level, hi)
            lo, hi = (self.zeros[level] + a, self.zeros[level] + b) if bit else (lo - a, hi - b)
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """How often the token stands before position i."""
        if token >> self.levels:
            return 0
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def _places(self, token: int, ks: np.ndarray) -> np.ndarray:
        places = self._range(token, self.n)[0] + ks
        for level in range(self.levels - 1, -1, -1):
            bit = token >> (self.levels - 1 - level) & 1
            places = self._select(level, bit, places - self.zeros[level] if bit else places)
        return places

    def locate(self, token: int, k: int) -> int:
        """Position of the k-th (from 0) occurrence."""
        if k >= self.count(token):
            raise IndexError(k)
        return int(self._places(token, np.array([k]))[0])

    def occurrences(self, token: int) -> np.ndarray:
        """Positions of all occurrences, ascending."""
        n = self.count(token)
        return self._places(token, np.arange(n)) if n else np.zeros(0, np.int64)

    def decode(self) -> np.ndarray:
        kind = np.uint16 if self.levels <= 16 else np.uint32
        seq = np.zeros(self.n, kind)
        for level in range(self.levels - 1, -1, -1):
            plane = np.concatenate([np.zeros(0, np.uint8), *(self._chunk(level, k) for k in range(self.chunks))])
            one = np.unpackbits(plane, count=self.n, bitorder="little").view(bool)
            out = np.empty(self.n, kind)
            out[np.flatnonzero(~one)] = seq[: self.zeros[level]]
            out[np.flatnonzero(one)] = seq[self.zeros[level] :] | kind(1 << (self.levels - 1 - level))
            seq = out
        return seq


def write_shards(docs: DataFrame, vocabulary: str | None = None, shard_tokens: int = 1 << 18) -> DataFrame:
    """Shards (part, seq, n_docs, n_tokens, payload) in ascending doc_id order: part, then seq.

    Reads ``doc_id`` and ``text`` only; a null text is empty; every document ends with id 0.  Null
    doc_ids come first; rows of one doc_id are ordered by their text's hash, which also lets them
    spread over tasks.  An empty table gives no shards.  A shard holds whole documents and is closed
    at ``shard_tokens`` ids.
    """
    small_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part, seq = encoder(vocabulary), part_id(), 0
        ids: list[bytes] = []
        names: list[int | None] = []
        held = 0

        def close() -> pa.RecordBatch:
            nonlocal ids, names, held, seq
            payload = build(np.frombuffer(b"".join(ids), "<u4"), names, [len(x) // 4 for x in ids])
            row = {"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [held], "payload": [payload]}
            ids, names, held, seq = [], [], 0, seq + 1
            return pa.RecordBatch.from_pydict(row, schema=SHARDS_ARROW)

        for batch in batches:
            for key, coded in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1)), strict=True):
                ids.append(coded + END)
                names.append(key)
                held += len(coded) // 4 + 1
                if held >= shard_tokens:
                    yield close()
        if ids:
            yield close()

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("tie", F.xxhash64("text"))
    ordered = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    return ordered.select("doc_id", "text").mapInArrow(trimmed(run), SHARDS)


def read_shards(shards: DataFrame, digest: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids) of every document in the shards; ids little-endian unsigned 32-bit.

    ``start`` counts the ids of all documents before it: sums by part, then within a part.  With
    ``digest`` the reader gives ``ids_crc32``, unsigned, instead of the ids.
    """
    value, kind = ("ids_crc32", pa.int64()) if digest else ("ids", pa.binary())
    schema = pa.schema([*DOCS_ARROW, (value, kind)])
    of = zlib.crc32 if digest else bytes

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, seq, payload in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                shard = WaveletShard(payload)
                ids, ends = memoryview(shard.decode().astype("<u4").tobytes()), np.cumsum(shard.lengths)
                starts = ends - shard.lengths
                yield pa.RecordBatch.from_pydict(
                    {
                        "part": [part] * len(ends),
                        "seq": [seq] * len(ends),
                        "doc_id": [None if x else d for x, d in zip(shard.null.tolist(), shard.doc_ids.tolist(), strict=True)],
                        "start_in_shard": starts,
                        "n_tokens": shard.lengths,
                        value: [of(ids[4 * a : 4 * b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)],
                    },
                    schema=schema,
                )

    parts = shards.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    up = Window.rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("n").over(up.orderBy("part")), F.lit(0)).alias("p"))
    inside = shards.select("part", "seq", "n_tokens").select(
        "part", "seq", F.coalesce(F.sum("n_tokens").over(up.partitionBy("part").orderBy("seq")), F.lit(0)).alias("s")
    )
    before = inside.join(parts, "part").select("part", "seq", (F.col("p") + F.col("s")).alias("before"))
    docs = shards.select("part", "seq", "payload").mapInArrow(run, f"{DOCS}, {value} {'bigint' if digest else 'binary'}")
    return docs.join(before, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("start_in_shard")).cast("bigint").alias("start"), "n_tokens", value
    )


def find_token(shards: DataFrame, token: int) -> DataFrame:
    """(doc_id, place) of every occurrence of a token, places counted inside the document.

    Answered from rank and select of the files; ids are not decoded.  A token that no shard holds
    gives no rows.
    """
    schema = pa.schema([("doc_id", pa.int64()), ("place", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for payload in batch.column(0).to_pylist():
                shard = WaveletShard(payload)
                found, ends = shard.occurrences(token), np.cumsum(shard.lengths)
                doc = np.searchsorted(ends, found, side="right")
                ids = pa.array(shard.doc_ids[doc], mask=shard.null[doc] > 0)
                yield pa.RecordBatch.from_arrays([ids, pa.array(found - (ends - shard.lengths)[doc])], schema=schema)

    return shards.select("payload").mapInArrow(run, "doc_id bigint, place bigint")


def op5_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as wavelet shards to the shared folder, reads the files back."""
    return read_shards(materialize(write_shards(table(spark, sf_dir, "documents")), "wavelet"), digest=True)
