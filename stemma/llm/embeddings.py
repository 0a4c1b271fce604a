"""Embedding near-duplicates: tiles compared in the order of principal components, with early stopping."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from stemma.llm.common import connected_components, materialize, scratch, table
from stemma.llm.vectors import as_matrix, scaled, sizes_of, sound

STEP, SPARSE, SLACK = 8, 0.05, 1e-9
#: Rows of two tiles compared at a time, and bytes of a tile.
BLOCK, MOST_BYTES = 1024, 1 << 26


def principal_axes(classes: DataFrame, d: int) -> np.ndarray:
    """Orthogonal axes, largest variance first: d sums of d numbers from each partition, all rows counted."""
    schema = pa.schema([("row", pa.int32()), ("sums", pa.binary())])

    def rows_of(total: dict[int, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())], schema=schema)

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((d, d))
        for batch in batches:
            x = scaled(as_matrix(batch.column(0), d))
            x /= np.linalg.norm(x, axis=1, keepdims=True)
            total += x.T @ x
        yield rows_of(dict(enumerate(total)))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, sums in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[row] = total.get(row, 0.0) + np.frombuffer(sums)
        yield rows_of(total)

    kind = "row int, sums binary"
    found = classes.select("embedding").mapInArrow(products, kind).repartition("row").mapInArrow(add, kind).collect()
    moments = np.zeros((d, d))
    for r in found:
        moments[r.row] = np.frombuffer(r.sums)
    return np.linalg.eigh(moments)[1][:, ::-1]


def close_pairs(x: np.ndarray, y: np.ndarray, axes: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows (i, j) with cosine(x[i], y[j]) >= least; with ``same`` only i < j.

    Leading principal coordinates first: what the others can add is at most the product of the
    suffix norms, and a pair is given up once that bound is below the threshold.  The pairs left are
    computed from the vectors themselves in double precision, but for an exact power of two.
    """
    x, y = scaled(x), scaled(y)
    nx, ny = np.linalg.norm(x, axis=1), np.linalg.norm(y, axis=1)
    a, b = (x / nx[:, None]) @ axes, (y / ny[:, None]) @ axes
    d = a.shape[1]
    dots = np.zeros((len(a), len(b)))
    i = j = None
    for at in range(0, d, STEP):
        dots += a[:, at : at + STEP] @ b[:, at : at + STEP].T
        ra = np.sqrt((a[:, at + STEP :] ** 2).sum(1))
        rb = np.sqrt((b[:, at + STEP :] ** 2).sum(1))
        alive = dots + ra[:, None] * rb >= least - SLACK
        if at + STEP >= d or np.count_nonzero(alive) <= SPARSE * alive.size:
            i, j = np.nonzero(alive)
            break
    if same:
        i, j = i[i < j], j[i < j]
    keep = np.zeros(len(i), bool)
    for at in range(0, len(i), 1 << 16):
        p, q = i[at : at + (1 << 16)], j[at : at + (1 << 16)]
        keep[at : at + len(p)] = (x[p] * y[q]).sum(1) / (nx[p] * ny[q]) >= least
    return i[keep], j[keep]


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest row linked to each of n rows."""
    low = np.arange(n)
    while len(i):
        before = low.copy()
        least = np.minimum(low[i], low[j])
        np.minimum.at(low, i, least)
        np.minimum.at(low, j, least)
        low = low[low]
        if (low == before).all():
            break
    return low


def blocks_of_pairs(x: np.ndarray, y: np.ndarray | None, axes: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """``close_pairs`` of two tiles, or of one with itself, ``BLOCK`` rows of each at a time; rows of y follow those of x."""
    i, j = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for at in range(0, len(x), BLOCK):
        for to in range(at if y is None else 0, len(x if y is None else y), BLOCK):
            own = y is None and at == to
            p, q = close_pairs(x[at : at + BLOCK], (x if y is None else y)[to : to + BLOCK], axes, least, own)
            i.append(p + at)
            j.append(q + to + (0 if y is None else len(x)))
    return np.concatenate(i), np.concatenate(j)


def near_duplicates(vectors: DataFrame, least: float = 0.98, tile: int = 1024) -> DataFrame:
    """``vectors(vec_id, embedding, label)`` to (vec_id, n_links, component_id, kept), one row for each.

    Rows with equal, not null labels and vectors of one length link at cosine >= ``least``.  Vectors
    that are null, zero, or hold null or non-finite components link with nothing; very small and very
    large components are scaled by powers of two.  Equal vectors are one class, linked by definition
    and compared once; SHA-256 digests of all their digits tell them, so that vectors travel once.  A pair at the threshold
    is at most sqrt(2 - 2 least) apart on the first axis (the first principal one of the most frequent
    length, the first component for others); so classes are cut into cells of that width, cells into
    tiles by hash, and only tiles of the same or adjacent cells meet.  Tiles hold about ``tile`` rows,
    in large cells more, so that a row is copied by the root of the cell's size.  A tile reports the
    number of links of each row and a forest of its links, not the pairs.
    Repeated rows count as other vectors; component_id is the smallest vec_id reachable (a row
    without links has its own; null only where no row has one); kept is false for null.  An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    plain = F.transform(F.col("embedding").cast("array<double>"), lambda x: x + 0.0)  # -0.0 is 0.0
    rows = vectors.select(F.col("vec_id").cast("bigint"), plain.alias("embedding"), "label")
    good = sound("embedding") & F.col("label").isNotNull()
    alone = rows.where(~F.coalesce(good, F.lit(False))).select(
        "vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id"), F.col("vec_id").isNotNull().alias("kept")
    )
    kind = ["label", "size", "digest"]
    digest = F.unhex(F.sha2(F.col("embedding").cast("string"), 256))  # a double's digits tell it from all others
    rows = rows.where(good).select("vec_id", "label", F.size("embedding").alias("size"), digest.alias("digest"), "embedding")
    with scratch(spark):
        classes = rows.groupBy(*kind).agg(F.min("vec_id").alias("low"), F.count("*").alias("mult"), F.first("embedding").alias("embedding"))
        classes = materialize(classes.withColumn("cls", F.monotonically_increasing_id()), "vector-classes")
        sizes = sizes_of(classes, "embedding")
        if not sizes:
            return alone
        d = sizes[0]
        axes = principal_axes(classes.where(F.col("size") == d), d)
        width = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
        named = ["cls", "label", "size", "mult", "embedding"]

        def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                lengths, out = batch.column("size").to_numpy(), np.zeros(len(batch), np.int32)
                for size in np.unique(lengths).tolist():
                    rows = lengths == size
                    x = scaled(as_matrix(batch.column("embedding").filter(pa.array(rows)), size))
                    c = (x @ axes[:, 0] if size == d else x[:, 0]) / np.linalg.norm(x, axis=1)
                    out[rows] = np.floor((c + 1) / width)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], names=[*named, "cell"])

        types = ", ".join(f"{c} {classes.schema[c].dataType.simpleString()}" for c in named)
        place = classes.select(*named).mapInArrow(cells, f"{types}, cell int")
        n = F.count("*") / tile
        most_rows = F.lit(MOST_BYTES / 8) / F.col("size")
        fewest = F.greatest(F.least(F.ceil(n), F.ceil(4 * F.sqrt(n))), F.ceil(F.count("*") / most_rows))
        tiles = materialize(place.groupBy("label", "size", "cell").agg(fewest.cast("int").alias("tiles")), "tiles")
        near = tiles
        for name, shift in (("above", 1), ("below", -1)):
            other = tiles.select("label", "size", (F.col("cell") - shift).alias("cell"), F.col("tiles").alias(name))
            near = near.join(other, ["label", "size", "cell"], "left")
        near = materialize(near, "near-tiles")
        placed = place.join(near, ["label", "size", "cell"]).withColumn("tile", F.pmod(F.xxhash64("cls"), F.col("tiles")).cast("int"))
        # the pairs of tiles a tile takes part in: (cell, tile, up, other tile)
        pair = "t -> named_struct('cell', {}, 'a', {}, 'up', {}, 'b', {})"
        own_up = f"transform(sequence(tile, tiles - 1), {pair.format('cell', 'tile', 0, 't')})"
        next_up = f"if(above IS NULL, array(), transform(sequence(0, above - 1), {pair.format('cell', 'tile', 1, 't')}))"
        own_down = f"if(tile = 0, array(), transform(sequence(0, tile - 1), {pair.format('cell', 't', 0, 'tile')}))"
        next_down = f"if(below IS NULL, array(), transform(sequence(0, below - 1), {pair.format('cell - 1', 't', 1, 'tile')}))"
        key = ["label", "size", "cell", "a", "up", "b"]

        def side(*pairs: str):
            both = placed.selectExpr("label", "size", "cls", "mult", "embedding", f"explode(concat({', '.join(pairs)})) AS k")
            fresh = [F.col(c).alias(c.removeprefix("k.")) for c in ("label", "size", "k.cell", "k.a", "k.up", "k.b", "cls", "mult", "embedding")]
            return both.select(*fresh).groupBy(*key)

        out = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

        def compare(left: pa.Table, right: pa.Table) -> pa.Table:
            if not len(left):
                return out.empty_table()
            size = left.column("size")[0].as_py()
            x = as_matrix(left.column("embedding").combine_chunks(), size)
            y = as_matrix(right.column("embedding").combine_chunks(), size) if len(right) else None
            cls, mult = left.column("cls").to_numpy(), left.column("mult").to_numpy()
            i, j = blocks_of_pairs(x, y, axes if size == d else np.eye(size), least)
            if y is not None:
                cls, mult = np.append(cls, right.column("cls").to_numpy()), np.append(mult, right.column("mult").to_numpy())
            links = np.bincount(i, mult[j], len(cls)) + np.bincount(j, mult[i], len(cls)) if len(i) else np.zeros(len(cls))
            hit = links > 0
            root = forest(len(cls), i, j)
            return pa.Table.from_arrays([pa.array(cls[hit]), pa.array(links[hit].astype(np.int64)), pa.array(cls[root][hit])], schema=out)

        met = side(own_up, next_up).cogroup(side(own_down, next_down)).applyInArrow(compare, "cls bigint, links bigint, root bigint")
        met = materialize(met, "tile-links")
        links = met.groupBy("cls").agg(F.sum("links").alias("links"))
        near = connected_components(met.where("cls <> root").select(F.col("cls").alias("a"), F.col("root").alias("b")))
        full = classes.select("cls", *kind, "low", "mult").join(links, "cls", "left").join(near.withColumnRenamed("node", "cls"), "cls", "left")
        full = materialize(full.withColumn("component", F.coalesce("component", "cls")), "vector-components")
        lows = materialize(full.groupBy("component").agg(F.min("low").alias("component_id")), "lows")
        full = full.join(lows, "component").select(*kind, (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), "component_id")
        full = materialize(full, "class-results", outlive=1)
    linked = rows.select("vec_id", *kind).join(full, kind).select(
        "vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept")
    )
    return linked.unionAll(alone)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, cosine 0.98 within labels."""
    return near_duplicates(table(spark, sf_dir, "embeddings"))
