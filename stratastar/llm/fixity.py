"""Merkle fixity audit of web-archive replicas, in DataFrame functions.

Records are written as archive records (header, payload) and ordered by id. RANGE ids make an
offset range, FANOUT ranges a file, FANOUT files a group, and so on to one root. A record's digest
is the SHA-256 of its bytes; a range's digest covers ids, offsets inside the range and digests of
its records in order; every node above covers its children in order. Replicas are compared at the
root, and only branches whose digests differ are followed down to the records.

A node has at most 2 * FANOUT children and a range at most RANGE ids, so no group grows with the data,
whatever the ids are. Offsets inside a file come from the ranges' lengths.

Defined cases: a null url or payload is empty. Rows without an id cannot be ordered and take no
part. Rows that repeat an id are one record: its digest covers their number, and their digests
independently of order; its length is the sum. Other columns are not read. Replicas without
records have no tree, and all records of the other are missing or added.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch

RANGE = 64
FANOUT = 1024


def record_of(url: Column, payload: Column) -> Column:
    """Text of an archive record; its bytes are UTF-8."""
    url, payload = (F.coalesce(c.cast("string"), F.lit("")) for c in (url, payload))
    head = F.concat(F.lit("WARC/1.1\r\nWARC-Type: response\r\nWARC-Target-URI: "), url)
    return F.concat(head, F.lit("\r\nContent-Length: "), F.octet_length(payload).cast("string"), F.lit("\r\n\r\n"), payload, F.lit("\r\n\r\n"))


def records(replica: DataFrame, key: str, url: str, payload: str) -> DataFrame:
    """(id, range, length, digest), one row per id."""
    rows = replica.where(F.col(key).isNotNull()).select(F.col(key).cast("long").alias("id"), record_of(F.col(url), F.col(payload)).alias("record"))
    rows = rows.select("id", F.octet_length("record").cast("long").alias("length"), F.sha2("record", 256).alias("digest"))
    part = lambda at: F.conv(F.substring("digest", at, 8), 16, 10).cast("decimal(20,0)")
    many = rows.groupBy("id").agg(
        F.sum("length").alias("length"), F.count("*").alias("n"), F.min("digest").alias("low"), F.max("digest").alias("high"), *(F.sum(part(at)).alias(f"s{at}") for at in range(1, 65, 8))
    )
    mixed = F.sha2(F.concat_ws(":", *(F.col(c).cast("string") for c in ("n", "low", "high", *(f"s{at}" for at in range(1, 65, 8))))), 256)
    digest = F.when(F.col("n") == 1, F.col("low")).otherwise(mixed)
    return many.select("id", F.floor(F.col("id") / RANGE).cast("long").alias("range"), "length", digest.alias("digest"))


def _joined(child: str) -> Column:
    """Children of a node with their digests, in order."""
    cells = F.array_sort(F.collect_list(F.struct(child, "digest")))
    return F.array_join(F.transform(cells, lambda x: F.concat(x[child].cast("string"), F.lit(":"), x["digest"])), ",")


class Tree:
    """Stored levels of one replica: records, ranges, files and so on; the last level is one root."""

    def __init__(self, replica: DataFrame, key: str, url: str, payload: str, scratch: Scratch, name: str) -> None:
        self.records = scratch.store(records(replica, key, url, payload), f"{name}-records")
        inside = W.partitionBy("range").orderBy("id").rowsBetween(W.unboundedPreceding, -1)
        placed = self.records.withColumn("at", F.coalesce(F.sum("length").over(inside), F.lit(0)))
        cells = F.array_sort(F.collect_list(F.struct("id", "at", "digest")))
        text = F.array_join(F.transform(cells, lambda x: F.concat_ws(":", x["id"].cast("string"), x["at"].cast("string"), x["digest"])), ",")
        ranges = placed.groupBy(F.col("range").alias("node")).agg(F.sha2(text, 256).alias("digest"), F.sum("length").alias("length"))
        self.scratch, self.name, self.levels = scratch, name, []
        self._store(ranges)

    def _store(self, level: DataFrame) -> None:
        # Files go by floor; above them division goes towards zero, so that nodes on both sides of it end in one root.
        parent = F.floor(F.col("node") / FANOUT).cast("long") if not self.levels else F.expr(f"node div {FANOUT}")
        level = level.withColumn("parent", parent)
        self.levels.append(self.scratch.store(level, f"{self.name}-level-{len(self.levels)}"))

    def grow(self) -> None:
        level = self.levels[-1]
        self._store(level.groupBy(F.col("parent").alias("node")).agg(F.sha2(_joined("node"), 256).alias("digest"), F.sum("length").alias("length")))

    def span(self) -> tuple[int, int] | None:
        """Smallest and largest node of the top level."""
        low, high = self.levels[-1].agg(F.min("node"), F.max("node")).first()
        return None if low is None else (low, high)


def _apart(one: DataFrame, two: DataFrame, node: str) -> DataFrame:
    """Nodes whose digests differ, or that only one replica has."""
    a, b = (df.select(F.col(node).alias("node"), F.col("digest").alias(name)) for df, name in ((one, "a"), (two, "b")))
    return a.join(b, "node", "full").where(~F.col("a").eqNullSafe(F.col("b"))).select("node")


def audit(primary: DataFrame, replica: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """(id, state, range_id, file_id, offset, length, digest, replica_digest) of every record that is not the same.

    state is changed, missing (from the replica) or added; offset and length are those in the
    primary's file, or in the replica's for a record that was added.
    """
    scratch = Scratch(primary.sparkSession, "fixity")
    trees = [Tree(df, key, url, payload, scratch, name) for df, name in ((primary, "one"), (replica, "two"))]
    # Both trees grow until each is one root, and to the same height.
    while any(span and span[0] != span[1] for span in (tree.span() for tree in trees)) or len({span for tree in trees if (span := tree.span())}) > 1:
        for tree in trees:
            tree.grow()
    apart = scratch.store(_apart(trees[0].levels[-1], trees[1].levels[-1], "node"), "apart-root")
    for depth in range(len(trees[0].levels) - 2, -1, -1):
        below = [tree.levels[depth].join(apart.withColumnRenamed("node", "parent"), "parent", "left_semi") for tree in trees]
        apart = scratch.store(_apart(*below, "node"), f"apart-{depth}")
    suspects = [tree.records.join(apart.withColumnRenamed("node", "range"), "range", "left_semi") for tree in trees]

    def placed(rows: DataFrame, tree: Tree, side: str) -> DataFrame:
        """Records of the suspect ranges with their offsets in the file."""
        files = tree.levels[0].join(apart.join(tree.levels[0], "node").select("parent").distinct(), "parent", "left_semi")
        start = F.sum("length").over(W.partitionBy("parent").orderBy("node").rowsBetween(W.unboundedPreceding, -1))
        starts = files.select(F.col("node").alias("range"), F.coalesce(start, F.lit(0)).alias("start"))
        inside = F.sum("length").over(W.partitionBy("range").orderBy("id").rowsBetween(W.unboundedPreceding, -1))
        rows = rows.withColumn("at", F.coalesce(inside, F.lit(0))).join(starts, "range")
        return rows.select("id", (F.col("start") + F.col("at")).alias(f"offset_{side}"), F.col("length").alias(f"length_{side}"), F.col("digest").alias(f"digest_{side}"))

    both = placed(suspects[0], trees[0], "a").join(placed(suspects[1], trees[1], "b"), "id", "full").where(~F.col("digest_a").eqNullSafe(F.col("digest_b")))
    state = F.when(F.col("digest_a").isNull(), "added").when(F.col("digest_b").isNull(), "missing").otherwise("changed")
    range_id = F.floor(F.col("id") / RANGE).cast("long")
    return both.select(
        "id",
        state.alias("state"),
        range_id.alias("range_id"),
        F.floor(range_id / FANOUT).cast("long").alias("file_id"),
        F.coalesce("offset_a", "offset_b").alias("offset"),
        F.coalesce("length_a", "length_b").alias("length"),
        F.col("digest_a").alias("digest"),
        F.col("digest_b").alias("replica_digest"),
    )
