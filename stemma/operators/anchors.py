"""The most similar anchor of each vector, by blocked matrix products in Arrow batches (TX16, MT5).

Anchors are held as one normalised matrix, a bounded number at a time.  A block of anchors is left out
for the rows that it cannot help: leading coordinates are multiplied first, and what the others can
add is at most the product of their norms.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

#: Bytes of anchors that a task holds at once; anchors of a block; what rounding may hide.
MOST_BYTES, BLOCK, SLACK = 1 << 27, 1024, 1e-9


def matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component near 1."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])


class Anchors:
    """Anchors of one length, sorted along their first principal axis."""

    def __init__(self, vectors: np.ndarray, places: np.ndarray):
        self.axes = np.linalg.eigh(scaled(vectors).T @ scaled(vectors))[1][:, ::-1]
        order = np.argsort(self._unit(vectors) @ self.axes[:, 0], kind="stable")
        self.places, self.plain = places[order], scaled(vectors[order])
        self.unit = self._unit(self.plain)
        self.turned = self.unit @ self.axes
        self.lead = max(4, vectors.shape[1] // 4)
        self.rest = self._rest(self.turned)
        self.skipped = self.seen = 0

    @staticmethod
    def _unit(x: np.ndarray) -> np.ndarray:
        x = scaled(x)
        return x / np.linalg.norm(x, axis=1, keepdims=True)

    def _rest(self, turned: np.ndarray) -> np.ndarray:
        return np.sqrt((turned[:, self.lead :] ** 2).sum(1))

    def best(self, vectors: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
        """(place, score) of the best anchor of each row; scores that agree in 12 digits are ties, to the smallest place; place -1 below ``least``."""
        unit = self._unit(vectors)
        turned = unit @ self.axes
        rest, edge = self._rest(turned), np.full(len(unit), least - SLACK)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for at in range(0, len(self.unit), BLOCK):
            bound = turned[:, : self.lead] @ self.turned[at : at + BLOCK, : self.lead].T + rest[:, None] * self.rest[at : at + BLOCK]
            alive = np.flatnonzero(bound.max(1) >= edge - SLACK)
            self.seen, self.skipped = self.seen + len(unit), self.skipped + len(unit) - len(alive)
            if not len(alive):
                continue
            score = unit[alive] @ self.unit[at : at + BLOCK].T
            edge[alive] = np.maximum(edge[alive], score.max(1) - SLACK)
            i, j = np.nonzero(score >= edge[alive][:, None])
            found.append((alive[i], j + at, score[i, j]))
        place, best = np.full(len(unit), -1, np.int64), np.full(len(unit), -np.inf)
        if found:
            i, j, rough = (np.concatenate(x) for x in zip(*found, strict=True))
            near = rough >= edge[i]  # the edge has risen since
            i, j = i[near], j[near]
            x, a = scaled(vectors)[i], self.plain[j]
            exact = (x * a).sum(1) / (np.sqrt((x * x).sum(1)) * np.sqrt((a * a).sum(1)))
            order = np.lexsort((self.places[j], -np.round(exact, 12), i))
            first = np.append(True, np.diff(i[order]) != 0) if len(order) else np.zeros(0, bool)
            top = order[first]
            place[i[top]], best[i[top]] = self.places[j[top]], exact[top]
        place[best < least] = -1
        return place, best


def sound(column: str) -> str:
    """SQL: the vector has numbers only, and one that is not zero."""
    return f"coalesce(forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity')) AND exists({column}, x -> x <> 0), false)"


def best_anchor(rows: DataFrame, anchors: DataFrame, least: float) -> DataFrame:
    """(id, conference, score): the anchor with the largest cosine, at ``least`` or more; ties: the smallest ``ord``.

    ``rows(id, vector)``, ``anchors(conference, ord bigint, vector)``, ord unique.  The driver takes anchors
    in turns of ``MOST_BYTES``, dealt by a hash of ord, and every turn is one pass over the rows; no row
    meets an anchor outside of a matrix product.  Vectors meet anchors of their own length; null, zero
    and non-finite vectors have no best anchor.  Of several rows with one id the best counts.
    """
    kind = rows.schema["id"].dataType.simpleString()
    vectors = lambda df: df.withColumn("vector", F.col("vector").cast("array<double>")).where(sound("vector"))
    held = vectors(anchors).select(F.col("ord").cast("bigint").alias("ord"), "conference", "vector").withColumn("d", F.size("vector"))
    found = None
    asked = vectors(rows).select("id", "vector")
    for r in held.groupBy("d").count().orderBy("d").collect():  # lengths of anchors: as a rule one
        turns = -(-r["count"] * r.d * 8 // MOST_BYTES)
        for turn in range(turns):
            some = held.where((F.col("d") == r.d) & (F.pmod(F.xxhash64("ord"), F.lit(turns)) == turn)).select("ord", "vector").toArrow()
            if not len(some):
                continue
            own = Anchors(matrix(some.column("vector").combine_chunks(), r.d), some.column("ord").to_numpy())

            def ask(batches: Iterator[pa.RecordBatch], own: Anchors = own, d: int = r.d) -> Iterator[pa.RecordBatch]:
                for batch in batches:
                    place, score = own.best(matrix(batch.column(1), d), least)
                    out = pa.RecordBatch.from_arrays([batch.column(0), pa.array(place), pa.array(score)], names=["id", "ord", "score"])
                    yield out.filter(pa.array(place >= 0))

            part = asked.where(F.size("vector") == r.d).mapInArrow(ask, f"id {kind}, ord bigint, score double")
            found = part if found is None else found.unionAll(part)
    if found is None:
        return rows.select("id", F.lit(None).cast("string").alias("conference"), F.lit(None).cast("double").alias("score")).limit(0)
    best = found.groupBy("id").agg(F.max(F.struct(F.round("score", 12).alias("s"), (-F.col("ord")).alias("neg"), "score")).alias("b")).select("id", (-F.col("b.neg")).alias("ord"), "b.score")
    return best.join(held.select("ord", "conference"), "ord").select("id", "conference", "score")
