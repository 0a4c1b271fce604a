"""Quality classifier: random Fourier features of document statistics, ridge, isotonic calibration."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from stemma.llm.common import free_name, materialize, small_batches, table, text_bytes, trimmed

FEATURES, BINS, SEED = 256, 2000, 11
#: Raw ridge scores are binned between these for calibration.
LOW, HIGH = -0.5, 1.5
KINDS = np.zeros(256, np.int64)
for _b in range(256):
    _c = chr(_b)
    KINDS[_b] = (
        7 if _b >= 128 else 0 if "a" <= _c <= "z" else 1 if "A" <= _c <= "Z" else 2 if _c.isdigit()
        else 3 if _c in " \t\r\v\f" else 4 if _c == "\n" else 5 if _c in ".,;:'\"?-()" else 6
    )
NAMES = ["size", "upper", "digit", "space", "lines", "point", "symbol", "beyond", "word", "spread", "longest", "distinct", "again", "line", "same_lines", "entropy", "squeezed", "marked"]


def statistics(text: bytes) -> list[float]:
    """What NAMES says, all from the text alone; an empty text gives zeros."""
    n = len(text)
    words = text.split()
    if not words:
        return [float(np.log1p(n))] + [0.0] * (len(NAMES) - 1)
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    kinds = np.bincount(KINDS, counts, 8)
    letters = max(1.0, kinds[0] + kinds[1] + kinds[7])
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    p = counts[counts > 0] / n
    lines = [x for x in text.split(b"\n") if x]
    again = sum(a == b for a, b in zip(words, words[1:])) / len(words)
    marked = sum(w[-1:] in (b"!", b"$", b"%", b"&", b"*", b"#", b"|") for w in words) / len(words)
    return [
        float(np.log1p(n)), kinds[1] / letters, kinds[2] / n, kinds[3] / n, kinds[4] / n, kinds[5] / n, kinds[6] / n, kinds[7] / n,
        float(sizes.mean()), float(sizes.std()), float(np.log1p(sizes.max())), len(set(words)) / len(words), again,
        float(np.log1p(n / max(1, len(lines)))), 1 - len(set(lines)) / max(1, len(lines)), float(-(p * np.log2(p)).sum()),
        len(zlib.compress(text, 1)) / n, marked,
    ]


def document_statistics(docs: DataFrame) -> DataFrame:
    """``docs(doc_id, text)`` to (doc_id, x: array of NAMES)."""
    small_batches(docs.sparkSession)
    schema = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = pa.array([statistics(t) for t in text_bytes(batch.column(1))], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), x], schema=schema)

    return docs.select(F.col("doc_id").cast("bigint"), F.col("text").cast("string")).mapInArrow(trimmed(run), "doc_id bigint, x array<double>")


def matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.flatten()).reshape(len(column), len(NAMES))


class Model:
    """Standardisation, the random features, ridge weights and the calibration steps."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray):
        rng = np.random.default_rng(SEED)
        self.mean, self.scale = mean, scale
        self.w = rng.normal(0, 1 / np.sqrt(len(mean)), (len(mean), FEATURES))
        self.b = rng.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + len(mean) + 1)
        self.at, self.value = np.array([LOW, HIGH]), np.array([0.5, 0.5])

    def features(self, x: np.ndarray) -> np.ndarray:
        """Cosine features of the Gaussian kernel, the standardised statistics themselves and 1."""
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.w + self.b), z, np.ones((len(x), 1))])

    def raw(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        raw = np.clip(self.raw(x), LOW, HIGH)
        tie = (raw - LOW) / (HIGH - LOW)
        return 0.999 * np.interp(raw, self.at, self.value) + 0.001 * tie


def isotonic(value: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Pool adjacent violators: the non-decreasing fit to the bins' means."""
    blocks: list[list[float]] = []
    for v, w in zip(value.tolist(), weight.tolist(), strict=True):
        blocks.append([v, w, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v2, w2, k2 = blocks.pop()
            v1, w1, k1 = blocks.pop()
            blocks.append([(v1 * w1 + v2 * w2) / (w1 + w2), w1 + w2, k1 + k2])
    return np.repeat([b[0] for b in blocks], [int(b[2]) for b in blocks])


def fit(rows: DataFrame, ridge: float = 1.0) -> Model:
    """From ``rows(x, y)``: three passes of sums over partitions, none of which grows with the rows.

    Every labelled row counts.  The driver gets the statistics' means, one symmetric matrix of
    FEATURES + 19 rows, and at most BINS bins.  No rows, or one class only, give a constant score.
    """
    k = len(NAMES)
    columns = [F.avg(F.col("x")[i]).alias(f"m{i}") for i in range(k)] + [F.stddev_pop(F.col("x")[i]).alias(f"s{i}") for i in range(k)]
    sums = rows.agg(F.count("*").alias("n"), F.sum("y").alias("ones"), *columns).first()
    if not sums.n or sums.ones in (0, sums.n):
        model = Model(np.zeros(k), np.ones(k))
        model.value = np.full(2, 0.5 if not sums.n else float(sums.ones > 0))
        return model
    model = Model(np.array([sums[f"m{i}"] for i in range(k)]), np.array([sums[f"s{i}"] or 1.0 for i in range(k)]))
    size = len(model.weights)
    part = pa.schema([("row", pa.int32()), ("sums", pa.binary())])

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size + 1))
        for batch in batches:
            z, y = model.features(matrix(batch.column(0))), np.array(batch.column(1), np.float64)
            total += z.T @ np.column_stack([z, y])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array([r.tobytes() for r in total], pa.binary())], schema=part)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, sums_ in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[row] = total.get(row, 0.0) + np.frombuffer(sums_)
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], schema=part)

    partial = rows.select("x", "y").mapInArrow(trimmed(products), "row int, sums binary").repartition("row").mapInArrow(add, "row int, sums binary")
    normal = np.zeros((size, size + 1))
    for r in partial.collect():
        normal[r.row] = np.frombuffer(r.sums)
    model.weights = np.linalg.solve(normal[:, :-1] + ridge * np.eye(size), normal[:, -1])
    binned = pa.schema([("bin", pa.int32()), ("y", pa.float64())])

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = np.clip(model.raw(matrix(batch.column(0))), LOW, HIGH)
            at = np.minimum(((raw - LOW) / (HIGH - LOW) * BINS).astype(np.int32), BINS - 1)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.array(batch.column(1), np.float64))], schema=binned)

    found = rows.select("x", "y").mapInArrow(bins, "bin int, y double").groupBy("bin").agg(F.count("*").alias("n"), F.avg("y").alias("y")).orderBy("bin").collect()
    model.at = LOW + (np.array([r.bin for r in found]) + 0.5) * (HIGH - LOW) / BINS
    model.value = isotonic(np.array([r.y for r in found]), np.array([float(r.n) for r in found]))
    return model


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0


def learn(stats: DataFrame, labels: DataFrame) -> Model:
    """The model from the labelled rows of ``stats(doc_id, x)`` that are not held out."""
    known = labels.where("quality IS NOT NULL").select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("quality").cast("double").alias("y"))
    return fit(materialize(stats.join(known.where(~held_out()), "doc_id").select("x", "y"), "training"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score) of every document; learns from labelled ones that are not held out.

    Reads ``doc_id`` and ``text`` of ``docs``, ``doc_id`` and ``quality`` of ``labels``.  A null text
    is empty and is scored; a null doc_id is never held out and has no label; null labels are no
    labels; repeated rows are scored alike, and repeated labels count as often; empty tables give no
    rows or, without labels, 0.5 for all.
    """
    stats = materialize(document_statistics(docs), "statistics")
    model = learn(stats, labels)
    schema = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.score(matrix(batch.column(1))))], schema=schema)

    scores = stats.mapInArrow(run, "doc_id bigint, score double")
    return scores.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), F.least(F.greatest("score", F.lit(0.0)), F.lit(1.0)).alias("score"))


def keep_good_documents(docs: DataFrame, labels: DataFrame, least: float) -> DataFrame:
    """The rows of ``docs``, all columns, that score at least ``least``; cases as in ``score_documents``.

    The statistics are taken again while filtering, which costs less than shuffling the texts to
    their scores.
    """
    model = learn(materialize(document_statistics(docs), "statistics"), labels)
    names = docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                x = np.array([statistics(t) for t in text_bytes(batch.column(0))])
                yield pa.RecordBatch.from_arrays(batch.columns[1:], names=names).filter(pa.array(model.score(x) >= least))

    kinds = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in names)
    columns = [F.col(f"`{c}`") for c in names]
    return docs.select(F.col("text").cast("string").alias(free_name(docs, "_text")), *columns).mapInArrow(trimmed(run), kinds)


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, trained on the labels that are not held out."""
    rows = score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rows.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))
