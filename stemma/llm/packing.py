"""Hierarchical multi-length packing: tiers of context sizes, gaps filled from shorter tiers."""

from __future__ import annotations

import bisect
import heapq
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.llm.bpe import MOST_WORDS, default_vocabulary, encoder, forget
from stemma.llm.common import part_id, small_batches, table, trimmed

END = b"\0\0\0\0"
SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint, tier int, step_id bigint"
ARROW = pa.schema(
    [("doc_id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()), ("ids", pa.binary()), ("doc_tokens", pa.int64())]
    + [("sequence_id", pa.int64()), ("offset", pa.int64()), ("tier", pa.int32()), ("step_id", pa.int64())]
)


class Packer:
    """Packs pieces (document, start, length) into windows whose sizes are the tiers, powers of two.

    A document gives full windows of the largest tier; its rest is routed to the smallest tier that
    holds it.  The windows of each tier, longest first, take one rest each and fill the gap from the
    pool of shorter tiers, best fit first, and cut one piece where none fits.  A window that nothing
    can fill is cut back to the next tier and its end goes to the pool.  So every window is full; what
    is over at the very end becomes windows of smaller powers of two.
    """

    def __init__(self, tiers: tuple[int, ...], step_tokens: int):
        self.tiers, self.step_tokens = sorted(tiers), step_tokens
        self.pool: list[tuple[int, int, int]] = []  # (length, document's number, start), ascending
        self.full: list[list[tuple[int, int, int]]] = []

    def add(self, number: int, n: int) -> None:
        top = self.tiers[-1]
        for start in range(0, n - n % top, top):
            self.full.append([(top, number, start)])
        if n % top:
            bisect.insort(self.pool, (n % top, number, n - n % top))

    def _take(self, gap: int) -> tuple[int, int, int] | None:
        """The longest piece of at most ``gap``; else the first ids of the shortest one."""
        if not self.pool:
            return None
        at = bisect.bisect_right(self.pool, (gap, 1 << 62, 0))
        if at:
            return self.pool.pop(at - 1)
        n, number, start = self.pool.pop(0)
        bisect.insort(self.pool, (n - gap, number, start + gap))
        return gap, number, start

    def pack(self, last: bool) -> list[list[tuple[int, int, int]]]:
        """The windows that can be filled now; with ``last``, all that is left."""
        out, self.full = self.full, []
        sizes = self.tiers
        for tier in range(len(sizes) - 1, 0, -1):
            size, below = sizes[tier], sizes[tier - 1]
            while self.pool and self.pool[-1][0] > below:
                n, number, start = self.pool.pop()
                window, gap = [(n, number, start)], size - n
                while gap and (piece := self._take(gap)):
                    window.append(piece)
                    gap -= piece[0]
                if gap:
                    out.append([(below, number, start)])
                    for piece in [(n - below, number, start + below), *window[1:]]:
                        bisect.insort(self.pool, piece)
                    if not last and len(self.pool) < 64:
                        break
                else:
                    out.append(window)
        size = sizes[0]
        while self.pool and (last or sum(x[0] for x in self.pool[-size:]) >= size):
            while last and size > sum(x[0] for x in self.pool):
                size //= 2
            window, gap = [], size
            while gap and (piece := self._take(gap)):
                window.append(piece)
                gap -= piece[0]
            out.append(window)
        return out

    def steps(self, windows: list[list[tuple[int, int, int]]]) -> list[int]:
        """A step number for each window: longest first, always to the step with the fewest tokens."""
        sizes = [sum(x[0] for x in w) for w in windows]
        heap = [(0, k) for k in range(max(1, round(sum(sizes) / self.step_tokens)))]
        step = [0] * len(windows)
        for i in sorted(range(len(windows)), key=lambda i: -sizes[i]):
            tokens, k = heapq.heappop(heap)
            step[i] = k
            heapq.heappush(heap, (tokens + sizes[i], k))
        return step


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    tiers: tuple[int, ...] = (128, 256, 512, 1024),
    group_tokens: int = 1 << 18,
    step_tokens: int = 1 << 15,
    most_words: int = MOST_WORDS,
    batch_rows: int = 2000,
    keep: bool = True,
) -> DataFrame:
    """One row for each piece: where its ids lie in the document and in its sequence, and the ids.

    Reads ``doc_id`` and ``text`` only.  A null text is empty and gives one id, the end (0); ties and
    repeated rows are documents like any other; a null doc_id stays null; an empty table gives no
    rows.  No shuffle: each task packs its own documents, ``group_tokens`` at a time, and holds that
    many ids and one document at most.  ``step_id`` groups sequences into training steps of nearly
    ``step_tokens`` ids each.  A worker remembers the ids of ``most_words`` words and splits
    ``batch_rows`` texts together, which is memory against time only; so is ``keep``, whether it keeps
    its encoder and words for the next task.
    """
    small_batches(docs.sparkSession, batch_rows)
    vocabulary = vocabulary or default_vocabulary()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, packer = encoder(vocabulary, most_words), Packer(tiers, step_tokens)
        held: dict[int, tuple[int | None, bytes]] = {}
        base, sequences, steps, number, waiting = part_id() << 40, 0, 0, 0, 0

        def emit(last: bool) -> Iterator[pa.RecordBatch]:
            nonlocal sequences, steps, held
            windows = packer.pack(last)
            if windows:
                rows: dict[str, list] = {k: [] for k in ARROW.names}
                for window, step in zip(windows, packer.steps(windows), strict=True):
                    size, at = sum(x[0] for x in window), 0
                    for n, doc, start in window:
                        doc_id, ids = held[doc]
                        for k, v in zip(rows, (doc_id, start, n, ids[4 * start : 4 * (start + n)], len(ids) // 4, base + sequences, at, size, base + steps + step), strict=True):
                            rows[k].append(v)
                        at += n
                    sequences += 1
                steps += len(windows)
                yield pa.RecordBatch.from_pydict(rows, schema=ARROW)
            held = {x[1]: held[x[1]] for x in packer.pool}

        for batch in batches:
            for doc_id, coded in zip(batch.column(0).to_pylist(), enc.encode(batch.column(1)), strict=True):
                held[number] = (doc_id, coded + END)
                packer.add(number, len(coded) // 4 + 1)
                waiting += len(coded) // 4 + 1
                number += 1
                if waiting >= group_tokens:
                    yield from emit(False)
                    waiting = 0
        yield from emit(True)
        if not keep:
            forget(vocabulary)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(trimmed(run), SCHEMA)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens; every sequence is exactly a power of two long."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "tier", "step_id"
    )
