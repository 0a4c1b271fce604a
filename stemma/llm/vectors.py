"""What both operators on embeddings need: which vectors count, batches as matrices, sums over partitions."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F


def sound(column: str) -> Column:
    """Not null, no null or non-finite component, not zero."""
    finite = f"forall({column}, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
    return F.expr(f"coalesce({column} IS NOT NULL AND {finite} AND exists({column}, x -> x <> 0), false)")


def sizes_of(df: DataFrame, column: str) -> list[int]:
    """The different lengths of the vectors, the most frequent first: as a rule one."""
    found = df.groupBy(F.size(column).alias("d")).count().orderBy(F.desc("count"), "d").collect()
    return [r.d for r in found]


def as_matrix(column: pa.Array, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), d)


def scaled(x: np.ndarray) -> np.ndarray:
    """Each row times the power of two that brings its largest component near 1: squares neither vanish nor overflow."""
    return np.ldexp(x, -np.frexp(np.abs(x).max(axis=1, initial=0))[1][:, None])
