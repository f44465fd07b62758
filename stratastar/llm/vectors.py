"""What the two vector searches share: usable vectors, matrices from Arrow, best of a block, merging.

Usable: an id, a vector that is not null, and no null or non-finite component. Rows alike in id and
vector count once; rows of one id with other vectors are rows of their own, as queries and as
candidates. Vectors of unequal lengths are compared as if padded with zeros.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Rows of a block of vectors, and queries that meet it in one task.
BLOCK = 4096
QUERIES = 1024


def finite(vector: Column) -> Column:
    """Whether no component is null, NaN or infinite."""
    return F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def usable(embeddings: DataFrame, nonzero: bool) -> DataFrame:
    """(row, vec_id, vector array<double>) of the rows that take part; `row` is fixed once it is stored."""
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("vector"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite(F.col("vector")))
    if nonzero:
        rows = rows.where(F.exists("vector", lambda x: x != 0))
    return rows.distinct().select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector")


def matrix(column: pa.Array | pa.ChunkedArray, width: int) -> np.ndarray:
    """Rows of a list column, padded with zeros to `width`."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(size) and (size == width).all():
        return flat.reshape(-1, width)
    out = np.zeros((len(size), width))
    owner = np.repeat(np.arange(len(size)), size)
    out[owner, np.arange(len(flat)) - np.repeat(np.cumsum(size) - size, size)] = flat
    return out


def best(scores: np.ndarray, ids: np.ndarray, k: int, absent) -> tuple[np.ndarray, np.ndarray]:
    """Row and column of the k highest scores of each row, ties to the smaller id; `absent` is no score."""
    rows, width = scores.shape
    if width > k:
        least = np.partition(scores, width - k, axis=1)[:, width - k]
        row, col = np.nonzero((scores >= least[:, None]) & (scores != absent))
    else:
        row, col = np.nonzero(scores != absent)
    order = np.lexsort((ids[col], -scores[row, col], row))
    row, col = row[order], col[order]
    first = np.searchsorted(row, np.arange(rows))
    keep = np.arange(len(row)) - first[row] < k
    return row[keep], col[keep]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query row over all blocks, ranked."""
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("row", "query_id", "rank", "vec_id", "score")
