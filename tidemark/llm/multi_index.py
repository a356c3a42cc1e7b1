"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, each quantised with its own small codebook; a cell
is a pair of centroids.  A query walks the cells in the order of the summed
inner products with the two centroids (a heap over the two sorted centroid
lists) until the cells hold enough vectors, and the entries of these cells are
reranked by the exact inner product.

The codebooks are fitted on a bounded sample (``SAMPLE`` vectors of smallest
hash); every vector is indexed.  Entries are dealt by groups of first centroids,
large groups split over several blocks, queries in blocks of ``QUERY_BLOCK``; a
task holds one block of entries and one of queries, and returns the best few of
each query.

Cases: vectors that are null, empty, zero, hold null or non-finite components, or
differ from the most common length take no part; equal scores rank by smaller
id; with fewer candidates than asked, all are returned; extra columns are not
read; rows of equal id are separate entries and separate queries (each has a list of
its own, without itself but with the others).
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import hash_sample, keep

CENTROIDS = 128  # per half; CENTROIDS ** 2 cells
PARTS = 16  # groups of first centroids by which entries are dealt
SAMPLE = 16_384
KMEANS_ROUNDS = 15
PROBE = 0.45  # share of the vectors that a query's cells hold at least
LEAST = 2_000  # and at least so many vectors
ENTRY_BLOCK = 16_384
QUERY_BLOCK = 1_024
SEED = 5


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, vec as doubles) of the vectors that take part."""
    v = F.col("vec")
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
                      & F.exists(v, lambda x: x != 0))
    width = rows.groupBy(F.size("vec").alias("n")).count().orderBy(F.desc("count"), "n").first()
    return rows.where(F.size("vec") == (width["n"] if width else 0))


def kmeans(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.permutation(len(x))[:k]].copy()
    for _ in range(rounds):
        near = nearest(x, centres)
        for c in range(len(centres)):
            own = x[near == c]
            if len(own):
                centres[c] = own.mean(0)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres ** 2).sum(1) - 2 * x @ centres.T, axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


class Codebooks:
    def __init__(self, sample: np.ndarray, centroids: int):
        rng = np.random.default_rng(SEED)
        self.half = max(1, sample.shape[1] // 2)
        self.first = kmeans(sample[:, : self.half], centroids, KMEANS_ROUNDS, rng)
        self.second = kmeans(sample[:, self.half:], centroids, KMEANS_ROUNDS, rng)

    def cells(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return nearest(x[:, : self.half], self.first), nearest(x[:, self.half:], self.second)

    def number(self, c1, c2):
        return c1 * len(self.second) + c2

    def walk(self, q: np.ndarray, sizes: np.ndarray, enough: int) -> list[tuple[int, int]]:
        """Cells by falling sum of the two inner products, until they hold ``enough`` vectors."""
        a, b = self.first @ q[: self.half], self.second @ q[self.half:]
        i_order, j_order = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        heap = [(-(a[i_order[0]] + b[j_order[0]]), 0, 0)]
        out, held = [], 0
        while heap and held < enough:
            _, i, j = heapq.heappop(heap)
            cell = (int(i_order[i]), int(j_order[j]))
            if sizes[cell]:
                out.append(cell)
                held += sizes[cell]
            if j + 1 < len(b):
                heapq.heappush(heap, (-(a[i_order[i]] + b[j_order[j + 1]]), i, j + 1))
            if j == 0 and i + 1 < len(a):
                heapq.heappush(heap, (-(a[i_order[i + 1]] + b[j_order[0]]), i + 1, 0))
        return out


def _assign(rows: DataFrame, books: Codebooks, id_type: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                c1, c2 = books.cells(_matrix(batch.column(1)))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(c1 % PARTS, pa.int32()), pa.array(books.number(c1, c2), pa.int32())],
                    names=["id", "vec", "asks", "row", "part", "cell"])

    return rows.select("id", "vec", "asks", "row").mapInArrow(
        run, f"id {id_type}, vec array<double>, asks boolean, row long, part int, cell int")


def _probes(queries: DataFrame, books: Codebooks, sizes: np.ndarray, enough: int, id_type: str) -> DataFrame:
    """One row per query and part on its walk, with the cells to look at."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, parts, cells = [], [], []
            for row, q in enumerate(_matrix(batch.column(1)) if batch.num_rows else []):
                by_part: dict[int, list[int]] = {}
                for i, j in books.walk(q, sizes, enough):
                    by_part.setdefault(i % PARTS, []).append(books.number(i, j))
                for part, own in by_part.items():
                    take.append(row)
                    parts.append(part)
                    cells.append(own)
            at = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).take(at) for k in range(3)), pa.array(parts, pa.int32()),
                 pa.array(cells, pa.list_(pa.int32()))], names=["id", "vec", "row", "part", "cells"])

    return queries.select("id", "vec", "row").mapInArrow(
        run, f"id {id_type}, vec array<double>, row long, part int, cells array<int>")


def _rerank(probes: DataFrame, entries: DataFrame, k: int, id_type: str) -> DataFrame:
    """(query_row, query_id, vec_id, score): the best ``k`` entries of every block for every query that looks at it."""

    def run(queries: pa.Table, block: pa.Table) -> pa.Table:
        out_q, out_v, out_s = [], [], []
        if queries.num_rows and block.num_rows:
            x, y = _matrix(queries.column("vec").combine_chunks()), _matrix(block.column("vec").combine_chunks())
            cell, ids, rows, own = (c.to_numpy() for c in (*(block.column(c) for c in ("cell", "id", "row")), queries.column("row")))
            for row, cells in enumerate(queries.column("cells").to_numpy()):
                at = np.flatnonzero(np.isin(cell, cells) & (rows != own[row]))
                score = y[at] @ x[row]
                if len(at) > 4 * k:
                    edge = np.partition(score, len(score) - k)[len(score) - k]
                    at, score = at[score >= edge], score[score >= edge]
                best = np.lexsort((ids[at], -score))[:k]
                out_q.append(np.full(len(best), row))
                out_v.append(at[best])
                out_s.append(score[best])
        flat = lambda x, kind: pa.array(np.concatenate(x or [np.zeros(0)]).astype(kind))
        at = flat(out_q, np.int64)
        return pa.table([queries.column("row").take(at), queries.column("id").take(at),
                         block.column("id").take(flat(out_v, np.int64)), flat(out_s, np.float64)],
                        names=["query_row", "query_id", "vec_id", "score"])

    keys = ["part", "_eb", "_qb"]
    return probes.groupBy(*keys).cogroup(entries.groupBy(*keys)).applyInArrow(
        run, f"query_row long, query_id {id_type}, vec_id {id_type}, score double")


def search(vectors: DataFrame, is_query: Column, k: int = 20, centroids: int = CENTROIDS, probe: float = PROBE,
           least: int = LEAST, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """The ``k`` nearest by inner product of every query row: query_id, rank (from 1), vec_id, score."""
    id_type = dict(vectors.dtypes)[id_col]
    rows = usable(vectors, id_col, vec_col)
    sample = hash_sample(rows, "id", SAMPLE, SEED).select("vec").toPandas()["vec"]
    if not len(sample):
        return rows.limit(0).select(F.col("id").alias("query_id"), F.lit(1).alias("rank"), F.col("id").alias("vec_id"),
                                    F.lit(0.0).alias("score"))
    books = Codebooks(np.array(sample.tolist()), min(centroids, len(sample)))
    numbered = rows.withColumn("asks", F.coalesce(is_query, F.lit(False))).withColumn("row", F.monotonically_increasing_id())
    index = keep(_assign(numbered, books, id_type), "index")  # written: the row numbers stay
    sizes = np.zeros((len(books.first), len(books.second)), np.int64)
    for cell, n in index.groupBy("cell").count().collect():  # at most one row per cell
        sizes.flat[cell] = n
    queries = index.where("asks")
    # Blocks of a part: as many as its entries fill; every block meets every block of queries.
    fill = [max(1, -(-int(sizes[p::PARTS].sum()) // ENTRY_BLOCK)) for p in range(PARTS)]
    entry_blocks = F.get(F.array(*[F.lit(n) for n in fill]), F.col("part"))
    query_blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    enough = max(least, int(probe * sizes.sum()))
    probes = (_probes(queries.repartition(max(2, query_blocks)), books, sizes, enough, id_type)
              .withColumn("_eb", F.explode(F.sequence(F.lit(0), entry_blocks - 1)))
              .withColumn("_qb", F.pmod(F.xxhash64("row"), F.lit(query_blocks)).cast("int")))
    entries = (index.withColumn("_eb", F.pmod(F.xxhash64("row"), entry_blocks).cast("int"))
               .withColumn("_qb", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))))
    found = _rerank(probes, entries, k, id_type)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
