"""Exact top-k by inner product of integer vectors, accumulated term at a time.

Vectors are dealt into blocks by a hash of their id, queries into slots; each block meets each
slot once. In the block every dimension has a postings list of the vectors with a weight there.
A query's row of weights is taken term by term: each weight times the term's postings is added
into the dense array of scores. The best of a block are selected by partition, and the blocks'
results are merged.

Components are floor(SCALE * x) in double precision. Scores are summed in doubles where every
partial sum stays under 2**53, in 64-bit integers where it stays under 2**63, and in Python's
integers beyond, where a score outside (-2**63, 2**63) is held at the nearest long inside.

Defined cases: see `stratastar.llm.vectors`; an all-zero vector takes part. A query with no other
vector has no rows; with fewer than k others it returns all. Ties go to the smaller id.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, settle
from stratastar.llm.vectors import BLOCK, QUERIES, best, matrix, merged, usable

SCALE = 64
#: Rows scored at once, so that their scores stay in a core's cache.
STRIP = 256


def weights(column: pa.ChunkedArray, width: int) -> np.ndarray:
    return np.floor(SCALE * matrix(column, width))


def accumulated(vectors: np.ndarray, queries: np.ndarray) -> np.ndarray:
    """(query, vector) scores, one term after another."""
    n, m = len(vectors), len(queries)
    most = float(np.abs(vectors).sum(axis=1).max(initial=0)) * float(np.abs(queries).max(initial=0))
    kind = np.float64 if most < 2**53 else np.int64 if most < 2**62 else object
    if kind is object:
        vectors, queries = (np.array([[int(x) for x in row] for row in part], object).reshape(part.shape) for part in (vectors, queries))
    else:
        vectors, queries = vectors.astype(kind), queries.astype(kind)
    scores = np.zeros((n, m), kind)
    for at in range(0, n, STRIP):
        part, out = vectors[at : at + STRIP], scores[at : at + STRIP]
        for term in range(vectors.shape[1]):
            posting = np.flatnonzero(part[:, term])
            asking = np.flatnonzero(queries[:, term])
            if not len(posting) or not len(asking):
                continue
            # A list that holds most vectors is walked whole, its zeros included.
            if 2 * len(posting) > len(part):
                posting = slice(None)
            if 2 * len(asking) > m:
                out[posting] += np.multiply.outer(part[posting, term], queries[:, term])
            else:
                rows = np.arange(len(part))[posting]
                out[np.ix_(rows, asking)] += np.multiply.outer(part[posting, term], queries[asking, term])
    return scores.T


_FOUND = "row long, query_id long, vec_id long, score long"


def _scored(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    rows, asked = right["row"].to_numpy(), left["row"].to_numpy()
    if not len(rows) or not len(asked):
        return pa.table({name: pa.array([], pa.int64()) for name in ("row", "query_id", "vec_id", "score")})
    width = max(int(np.max(t["vector"].combine_chunks().value_lengths().to_numpy())) for t in (left, right))
    scores = accumulated(weights(right["vector"], width), weights(left["vector"], width))
    if scores.dtype == object:
        scores = np.vectorize(lambda x: max(1 - 2**63, min(2**63 - 1, x)), otypes=[np.int64])(scores)
    absent = -np.inf if scores.dtype == np.float64 else np.iinfo(np.int64).min
    scores = np.where(asked[:, None] == rows[None, :], absent, scores)
    ids = right["vec_id"].to_numpy()
    at, col = best(scores, ids, k, absent)
    return pa.table({"row": asked[at], "query_id": left["vec_id"].to_numpy()[at], "vec_id": ids[col], "score": scores[at, col].astype(np.int64)})


def exact_top_k(embeddings: DataFrame, k: int = 20, every: int = 20) -> DataFrame:
    """(query_id, rank, vec_id, score) for query rows whose id is divisible by `every`, against all other rows."""
    spark = settle(embeddings.sparkSession)
    scratch = Scratch(spark, "exact-search")
    rows = scratch.store(usable(embeddings, nonzero=False), "vectors")
    asking = rows.where(F.col("vec_id") % every == 0)
    blocks, slots = (max(1, -(-df.count() // size)) for df, size in ((rows, BLOCK), (asking, QUERIES)))
    block, slot = (F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)) for salt, n in ((1, blocks), (2, slots)))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))
    left = asking.withColumn("slot", slot).withColumn("block", all_of(blocks))
    right = rows.withColumn("block", block).withColumn("slot", all_of(slots))
    found = left.groupBy("block", "slot").cogroup(right.groupBy("block", "slot"))
    return merged(found.applyInArrow(lambda a, b: _scored(a, b, k), _FOUND), k).drop("row")
