"""Nearest neighbours by inner product through an inverted multi-index.

Index. The two halves of the vectors are quantised separately, each by CENTROIDS centroids that
k-means finds on a sample of at most SAMPLE vectors; every vector is then entered in the cell
(first centroid, second centroid).

Search. A query walks the pairs of centroids by falling sum of its inner products with the two,
with a heap over the sorted halves, until the cells passed hold enough vectors; all entries of
those cells are scored exactly, in double precision, and the best kept. How many are enough is
measured: for PROBES sampled queries the true neighbours are found by brute force, and the number
is the smallest at which they would have met AIM of them.

Entries lie in blocks of about BLOCK vectors with neighbouring first centroids; a crowded
centroid is split over several blocks. A query is sent once to each block that it walks into, and
a block that many queries walk into is copied, so no task holds more than a block and QUERIES
queries.

Defined cases: see `stratastar.llm.vectors`; all-zero vectors take no part. A query with no other
vector has no rows. Ties go to the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, settle
from stratastar.llm.vectors import BLOCK, QUERIES, best, matrix, merged, usable

SAMPLE = 32_768
LARGEST = 512
ROUNDS = 10
PROBES = 128
AIM = 0.96


def k_means(points: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = points[rng.permutation(len(points))[:k]].copy()
    for _ in range(ROUNDS):
        nearest = assigned(points, centres)
        count = np.bincount(nearest, minlength=len(centres))
        total = np.zeros_like(centres)
        np.add.at(total, nearest, points)
        centres = np.where(count[:, None] > 0, total / np.maximum(count, 1)[:, None], centres)
    return centres


def assigned(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points @ centres.T - 0.5 * (centres * centres).sum(axis=1)).argmax(axis=1)


@dataclass(frozen=True)
class Quantiser:
    width: int
    halves: tuple[np.ndarray, np.ndarray]

    @property
    def k(self) -> int:
        return len(self.halves[0])

    def split(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cut = (self.width + 1) // 2
        return vectors[:, :cut], vectors[:, cut:]

    def cells(self, vectors: np.ndarray) -> np.ndarray:
        one, two = (assigned(part, centres) for part, centres in zip(self.split(vectors), self.halves, strict=True))
        return one * self.k + two

    def walk(self, query: np.ndarray, counts: Sequence[int]) -> Iterator[tuple[int, int]]:
        """(cell, vectors in it) of the non-empty cells, by falling sum of inner products.

        Only cells that the walk reaches are looked at.
        """
        k = self.k
        near = [part[0] @ centres.T for part, centres in zip(self.split(query[None]), self.halves, strict=True)]
        order = [np.argsort(-x, kind="stable") for x in near]
        a, b = (x[o].tolist() for x, o in zip(near, order, strict=True))
        first, second = (order[0] * k).tolist(), order[1].tolist()
        heap = [(-(a[0] + b[0]), 0, 0)]
        while heap:
            _, i, j = heapq.heappop(heap)
            cell = first[i] + second[j]
            if counts[cell]:
                yield cell, counts[cell]
            # The next pair of row i follows, and its first one opens the next row.
            if j + 1 < k:
                heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
            if j == 0 and i + 1 < k:
                heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def fitted(rows: DataFrame, n: int, width: int) -> Quantiser:
    """K-means on a sample taken by hash of the row; the number of cells follows the number of vectors."""
    sample = rows.orderBy(F.xxhash64("vec_id", "vector")).limit(SAMPLE).toArrow()
    points = matrix(sample["vector"], width)
    k = int(min(LARGEST, len(points), max(2, 2 ** round(np.log2(max(n, 2)) / 2 - 2))))
    cut = (width + 1) // 2
    return Quantiser(width, (k_means(points[:, :cut], k, 1), k_means(points[:, cut:], k, 2)))


def scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """(query, vector) inner products, summed in the order of the components, so that equal
    vectors have equal scores wherever they lie."""
    out = np.zeros((len(queries), len(vectors)))
    for q, v in zip(queries.T, vectors.T, strict=True):
        out += np.multiply.outer(q, v)
    return out


def blocks_of(counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """First block and number of blocks of every first centroid: small ones share a block."""
    first, number, block, held = np.zeros(k, np.int64), np.ones(k, np.int64), 0, 0
    for i, n in enumerate(counts.reshape(k, k).sum(axis=1).tolist()):
        if held and held + n > BLOCK:
            block, held = block + 1, 0
        first[i], number[i] = block, max(1, -(-n // BLOCK))
        if number[i] > 1:
            block, held = block + number[i], 0
        else:
            held += n
    return first, number


_FOUND = "row long, query_id long, vec_id long, score double"


def _searched(left: pa.Table, right: pa.Table, k: int, width: int) -> pa.Table:
    """Scores of the entries in the cells that each query walked, in one block."""
    rows, asked, ids = right["row"].to_numpy(), left["row"].to_numpy(), right["vec_id"].to_numpy()
    out = np.full((len(asked), len(rows)), -np.inf)
    if len(rows) and len(asked):
        vectors, queries, cell = matrix(right["vector"], width), matrix(left["vector"], width), right["cell"].to_numpy()
        walked = left["cells"].combine_chunks()
        flat = walked.flatten().to_numpy()
        owner = np.repeat(np.arange(len(asked)), walked.value_lengths().to_numpy())
        by_cell, by_walk = np.argsort(cell, kind="stable"), np.argsort(flat, kind="stable")
        there, starts = np.unique(cell[by_cell], return_index=True)
        for c, at, end in zip(there, starts, np.append(starts[1:], len(cell)), strict=True):
            low, high = np.searchsorted(flat[by_walk], [c, c + 1])
            near, cols = owner[by_walk[low:high]], by_cell[at:end]
            if len(near):
                out[np.ix_(near, cols)] = scores(queries[near], vectors[cols])
        out[asked[:, None] == rows[None, :]] = -np.inf
    at, col = best(out, ids, k, -np.inf)
    return pa.table({"row": asked[at], "query_id": left["query_id"].to_numpy()[at], "vec_id": ids[col], "score": out[at, col]})


def nearest(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for query rows whose id is divisible by `every`, against all other rows."""
    spark = settle(embeddings.sparkSession)
    scratch = Scratch(spark, "multi-index")
    rows = scratch.store(usable(embeddings, nonzero=True), "vectors")
    n, width = rows.agg(F.count("*"), F.max(F.size("vector"))).first()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    quantiser = spark.sparkContext.broadcast(fitted(rows, n, width))
    size = quantiser.value.k

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cell = quantiser.value.cells(matrix(batch.column(2), width))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], ["row", "vec_id", "vector", "cell"])

    entries = scratch.store(rows.mapInArrow(enter, "row long, vec_id long, vector array<double>, cell long"), "entries")
    scratch.drop("vectors")
    counts = np.zeros(size * size, np.int64)
    for r in entries.groupBy("cell").count().collect():  # one row per cell, LARGEST squared at most
        counts[r["cell"]] = r["count"]
    enough = _enough(entries, quantiser.value, counts, width, k, every)
    first, number = blocks_of(counts, size)
    layout = spark.sparkContext.broadcast((counts, first, number))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, first, number = layout.value
        counts = counts.tolist()
        for batch in batches:
            for at, query in enumerate(matrix(batch.column(2), width)):
                met, held = [], 0
                for cell, there in quantiser.value.walk(query, counts):
                    met.append(cell)
                    held += there
                    if held >= enough:
                        break
                met = np.sort(np.array(met))
                start, many = first[met // size], number[met // size]
                block = np.repeat(start, many) + np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
                cells = np.repeat(met, many)
                order = np.argsort(block, kind="stable")
                heads = np.flatnonzero(np.diff(block[order], prepend=-1))
                cuts = np.append(heads, len(order)).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(cuts), pa.array(cells[order]))
                take = pa.array(np.full(len(heads), at))
                own = [batch.column(i).take(take) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(block[order[heads]]), lists], ["row", "query_id", "vector", "block", "cells"])

    asking = entries.where(F.col("vec_id") % every == 0).select("row", "vec_id", "vector")
    walks = scratch.store(asking.mapInArrow(walk, "row long, query_id long, vector array<double>, block long, cells array<long>"), "walks")
    splits = walks.groupBy("block").agg(F.ceil(F.count("*") / QUERIES).alias("slots"))
    splits = scratch.store(splits, "splits")

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, first, number = layout.value
        for batch in batches:
            centroid = batch.column(3).to_numpy() // size
            block = first[centroid] + batch.column(4).to_numpy() % number[centroid]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(block)], ["row", "vec_id", "vector", "cell", "block"])

    spread = entries.select("row", "vec_id", "vector", "cell", F.shiftrightunsigned(F.xxhash64("row"), 1).alias("deal"))
    placed = spread.mapInArrow(place, "row long, vec_id long, vector array<double>, cell long, block long")
    left = walks.join(splits, "block").withColumn("slot", F.pmod(F.xxhash64("row"), F.col("slots"))).drop("slots")
    right = placed.join(splits, "block").withColumn("slot", F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))).drop("slots")
    found = left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot"))
    return merged(found.applyInArrow(lambda a, b: _searched(a, b, k, width), _FOUND), k).drop("row")


def _enough(entries: DataFrame, quantiser: Quantiser, counts: np.ndarray, width: int, k: int, every: int) -> int:
    """Vectors to pass in a walk so that the probes meet AIM of their true neighbours."""
    spark = entries.sparkSession
    some = entries.where(F.col("vec_id") % every == 0).orderBy(F.xxhash64("vec_id", "vector", F.lit(3))).limit(PROBES)
    probes = some.select("row", "vector").toArrow()
    if not probes.num_rows:
        return k
    shared = spark.sparkContext.broadcast((probes["row"].to_numpy(), matrix(probes["vector"], width)))

    def truth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, queries = shared.value
        for batch in batches:
            rows, ids, cell = (batch.column(i).to_numpy() for i in (0, 1, 3))
            found = np.where(asked[:, None] == rows[None, :], -np.inf, scores(queries, matrix(batch.column(2), width)))
            at, col = best(found, ids, k, -np.inf)
            values = [asked[at], ids[col], found[at, col], cell[col]]
            yield pa.RecordBatch.from_arrays([pa.array(v) for v in values], ["row", "vec_id", "score", "cell"])

    nearest = entries.mapInArrow(truth, "row long, vec_id long, score double, cell long").withColumn("query_id", F.col("row"))
    top = merged(nearest.withColumn("score", F.struct("score", "cell")), k).select("row", "score.cell").collect()
    wanted: dict[int, list[int]] = {}
    for r in top:
        wanted.setdefault(r["row"], []).append(r["cell"])
    counts = counts.tolist()
    need = []
    for query, vector in zip(*shared.value, strict=True):
        passed, left = 0, wanted.get(int(query), [])
        before = {}
        for cell, there in quantiser.walk(vector, counts):
            passed += there
            before[cell] = passed
            if len(before) % 64 == 0 and all(c in before for c in left):
                break
        need += [before[c] for c in left]
    return max(k + 1, int(np.quantile(need, AIM, method="higher"))) if need else k
