"""Approximate nearest neighbours: inverted file of coarse centroids, product-quantised residuals, exact reranking."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from stemma.llm.common import materialize, table
from stemma.llm.vectors import as_matrix, sizes_of, sound

SEED = 5
#: Queries that meet a group of rows in one task.
QUERY_BLOCK = 16_384


def kmeans(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Centroids of the rows of x; an empty cluster gets a row again."""
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        own = nearest(x, c)
        counts = np.bincount(own, minlength=len(c))
        sums = np.zeros_like(c)
        np.add.at(sums, own, x)
        c = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], x[rng.integers(0, len(x), len(c))])
    return c


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return ((c * c).sum(1) - 2 * x @ c.T).argmin(1)


class Index:
    """Coarse centroids and one codebook for each subspace of the residuals, from a bounded sample."""

    def __init__(self, sample: np.ndarray, lists: int, spaces: int, codes: int = 256):
        self.coarse = kmeans(sample, lists)
        self.probes, self.counts, self.least = len(self.coarse), np.zeros(len(self.coarse), np.int64), 0
        rest = sample - self.coarse[nearest(sample, self.coarse)]
        self.cuts = np.array_split(np.arange(sample.shape[1]), min(spaces, sample.shape[1]))
        self.books = [kmeans(rest[:, cut], codes) for cut in self.cuts]

    def assign(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """List and codes of each row."""
        own = nearest(x, self.coarse)
        rest = x - self.coarse[own]
        return own, np.stack([nearest(rest[:, cut], book) for cut, book in zip(self.cuts, self.books, strict=True)], 1).astype(np.uint8)

    def probed(self, queries: np.ndarray) -> np.ndarray:
        """[query, list]: whether the query visits the list; its centroid's inner product decides, ties: the first.

        Beyond ``probes`` lists it visits others while those before hold no more than ``least`` rows.
        """
        best = np.argsort(-(queries @ self.coarse.T), axis=1, kind="stable")
        held = self.counts[best]
        visits = (np.arange(len(self.coarse)) < self.probes) | (np.cumsum(held, axis=1) - held <= self.least)
        out = np.zeros(best.shape, bool)
        np.put_along_axis(out, best, visits, axis=1)
        return out

    def tables(self, queries: np.ndarray) -> list[np.ndarray]:
        """For each subspace the inner products of each query with the codebook's entries."""
        return [queries[:, cut] @ book.T for cut, book in zip(self.cuts, self.books, strict=True)]

    def approximate(self, queries: np.ndarray, visits: np.ndarray, own: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(guesses, visited): inner products of queries and coded rows, for the lists that a query visits and for no other.

        A list's rows lie together in ``own``, which ascends.  The centroid's product and one table entry
        for each subspace are summed.
        """
        guesses, visited = np.zeros((len(queries), len(own))), np.zeros((len(queries), len(own)), bool)
        coarse, tables = queries @ self.coarse.T, np.concatenate(self.tables(queries), axis=1)
        entries = codes + np.cumsum([0, *(len(book) for book in self.books[:-1])])
        lists, starts = np.unique(own, return_index=True)
        for k, lo, hi in zip(lists.tolist(), starts.tolist(), [*starts[1:].tolist(), len(own)], strict=True):
            asking = np.flatnonzero(visits[:, k])
            if not len(asking):
                continue
            own_tables = tables[asking]
            sums = np.repeat(coarse[asking, k][:, None], hi - lo, axis=1)
            for column in entries[lo:hi].T:
                sums += np.take(own_tables, column, axis=1)
            guesses[asking, lo:hi] = sums
            visited[asking, lo:hi] = True
        return guesses, visited


def near_ones(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each row times a power of two that brings it near 1, which changes no digit, and the power taken out."""
    powers = np.frexp(np.abs(x).max(axis=1, initial=0))[1]
    return np.ldexp(x, -powers[:, None]), powers


def exact_products(x: np.ndarray, powers: np.ndarray, query: np.ndarray, power: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(score, order): inner products of rows and a query, both from ``near_ones``, and numbers that order them where the products overflow or vanish.

    ``order`` is in units of 2 to the power of ``scale``.
    """
    products = (x * query).sum(1)
    with np.errstate(over="ignore", under="ignore"):
        return np.ldexp(products, powers + power), np.ldexp(products, powers + power - scale)


def groups_of(counts: np.ndarray, chunk: int) -> tuple[np.ndarray, np.ndarray]:
    """(first group, number of groups) of each list: small lists share a group of about ``chunk`` rows, large ones have several."""
    first, parts, at, held = np.zeros(len(counts), np.int64), np.maximum(1, -(-counts // chunk)), -1, chunk
    for k in np.flatnonzero(parts == 1).tolist():
        if held + counts[k] > chunk:
            at, held = at + 1, 0
        first[k], held = at, held + counts[k]
    for k in np.flatnonzero(parts > 1).tolist():
        first[k], at = at + 1, at + parts[k]
    return first, parts


KIND = "query_id bigint, rank int, vec_id bigint, score double"


def search(
    vectors: DataFrame,
    is_query: Column | str = "vec_id % 20 = 0",
    k: int = 20,
    lists: int | None = None,
    probes: float = 0.5,
    spaces: int = 16,
    rerank: int = 400,
    sample_rows: int = 10_000,
    chunk: int = 4096,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows with the largest inner product found for each query.

    Vectors of each length have an index of their own and meet only each other.  Centroids and
    codebooks are fitted on at most ``sample_rows`` vectors, those with the smallest hashes of their id;
    every row is indexed.  There are four times the root of the rows lists, a quarter of the sample at
    most.  A query visits the share ``probes`` of the lists, those whose centroids have the largest
    inner product with it, and further ones until they hold over ``rerank`` rows.  Lists lie in groups of about ``chunk`` rows, a large list in several; a
    query goes once to each group that holds some of its lists, and there the ``rerank`` best by the
    tables are computed exactly, ties by the smaller vec_id.  So of all rows in its lists at least the
    ``rerank`` best by the tables are computed, in whatever way they are dealt.  Vectors that are null,
    zero, hold null or non-finite components or have no vec_id take no part; a row with the query's own
    vec_id is no candidate; repeated rows of one vec_id are candidates each.  The index sees the table
    times one power of two, so that components of any size are told apart; products that overflow or
    vanish keep the order of the true ones.  A query that stands in
    several equal rows asks once; different vectors of one vec_id ask each and are ranked apart.  Fewer
    candidates give fewer rows; an empty table gives none.
    """
    rows = vectors.select(F.col("vec_id").cast("bigint"), F.col("embedding").cast("array<double>").alias("embedding"))
    rows = rows.where(sound("embedding") & F.col("vec_id").isNotNull())
    found = None
    for d in sizes_of(rows, "embedding"):
        some = _search(rows.where(F.size("embedding") == d), d, is_query, k, lists, probes, spaces, rerank, sample_rows, chunk)
        found = some if found is None else found.unionAll(some)
    return vectors.sparkSession.createDataFrame([], KIND) if found is None else found


def _search(
    rows: DataFrame, d: int, is_query: Column | str, k: int, lists: int | None, probes: float, spaces: int, rerank: int, sample_rows: int, chunk: int
) -> DataFrame:
    n, largest = rows.agg(F.count("*"), F.max(F.array_max(F.transform("embedding", lambda x: F.abs(x))))).first()
    scale = int(np.frexp(largest)[1])

    def near_one(column: pa.Array) -> np.ndarray:
        return np.ldexp(as_matrix(column, d), -scale)

    hashed = F.xxhash64("vec_id")
    share = min(1 << 20, (1 << 20) * 2 * sample_rows // n)  # so that no task sends more than the sample needs
    sample = rows.where(F.pmod(hashed, F.lit(1 << 20)) < share).orderBy(hashed, "vec_id").limit(sample_rows).select("embedding").toArrow()
    if not len(sample):  # few different ids
        sample = rows.orderBy(hashed, "vec_id").limit(sample_rows).select("embedding").toArrow()
    lists = lists or min(int(4 * np.sqrt(n)), max(1, sample_rows // 4))
    index = Index(near_one(sample.column(0).combine_chunks()), lists, spaces)
    index.probes = max(1, int(np.ceil(probes * len(index.coarse))))
    coded = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("list", pa.int32()), ("codes", pa.binary())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own, codes = index.assign(near_one(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1).cast(coded.field(1).type), pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary())], schema=coded
            )

    posted = materialize(rows.mapInArrow(assign, "vec_id bigint, embedding array<double>, list int, codes binary"), "inverted-file")
    counts = np.zeros(len(index.coarse), np.int64)
    for r in posted.groupBy("list").count().collect():  # one row for each list
        counts[r[0]] = r[1]
    index.counts, index.least = counts, rerank
    first, parts = groups_of(counts, chunk)
    queries = rows.where(is_query).select("vec_id", "embedding").distinct()
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows with their group."""
        for batch in batches:
            own, ids = batch.column("list").to_numpy(), batch.column("vec_id").to_numpy()
            spread = (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(first[own] + spread % parts[own]), *batch.columns], names=["group", *batch.schema.names])

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("query_id", pa.int64()), ("query", pa.list_(pa.float64())), ("groups", pa.list_(pa.int64()))])
        for batch in batches:
            visits = index.probed(near_one(batch.column(1))) & (counts > 0)
            groups = [np.unique(np.concatenate([np.arange(first[j], first[j] + parts[j]) for j in np.flatnonzero(v)] or [first[:0]])) for v in visits]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1).cast(schema.field(1).type), pa.array(groups, pa.list_(pa.int64()))], schema=schema)

    dealt = posted.mapInArrow(deal, "group bigint, vec_id bigint, embedding array<double>, list int, codes binary")
    left = dealt.select("group", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), "vec_id", "embedding", "list", "codes")
    routed = queries.mapInArrow(route, "query_id bigint, query array<double>, groups array<bigint>")
    right = routed.select(
        F.explode("groups").alias("group"), F.pmod(F.xxhash64("query_id"), F.lit(blocks)).cast("int").alias("block"), "query_id", F.xxhash64("query").alias("asker"), "query"
    )
    out = pa.schema([("query_id", pa.int64()), ("asker", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64()), ("order", pa.float64())])

    def answer(held: pa.Table, asking: pa.Table) -> pa.Table:
        if not len(held) or not len(asking):
            return out.empty_table()
        held = held.sort_by([("list", "ascending"), ("vec_id", "ascending")])
        ids, x = held.column("vec_id").to_numpy(), as_matrix(held.column("embedding").combine_chunks(), d)
        own, codes = held.column("list").to_numpy(), np.frombuffer(b"".join(held.column("codes").to_pylist()), np.uint8).reshape(len(ids), -1)
        names, askers = asking.column("query_id").to_numpy(), asking.column("asker").to_numpy()
        q = as_matrix(asking.column("query").combine_chunks(), d)
        (rows, powers), (vectors, q_powers) = near_ones(x), near_ones(q)
        found: list[tuple[np.ndarray, ...]] = []
        for at in range(0, len(q), 256):
            near = np.ldexp(q[at : at + 256], -scale)
            guesses, visited = index.approximate(near, index.probed(near), own, codes)
            for n, (guess, mine) in enumerate(zip(guesses, visited, strict=True), at):
                name, asker = names[n], askers[n]
                some = np.flatnonzero(mine & (ids != name))
                if len(some) > rerank:
                    edge = np.partition(guess[some], len(some) - rerank)[len(some) - rerank]
                    over, level = some[guess[some] > edge], some[guess[some] == edge]
                    some = np.append(over, level[np.argsort(ids[level], kind="stable")[: rerank - len(over)]])  # ties: smaller vec_id
                score, order = exact_products(rows[some], powers[some], vectors[n], int(q_powers[n]), 2 * scale)
                best = np.lexsort((ids[some], -order))[:k]
                found.append((np.full(len(best), name), np.full(len(best), asker), ids[some][best], score[best], order[best]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=out)

    key = ["group", "block"]
    hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(answer, "query_id bigint, asker bigint, vec_id bigint, score double, order double")
    rank = F.row_number().over(Window.partitionBy("query_id", "asker").orderBy(F.desc("order"), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op10_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding whose vec_id is divisible by 20 against all rows."""
    return search(table(spark, sf_dir, "embeddings"))
