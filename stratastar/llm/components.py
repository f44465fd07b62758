"""Connected components of a stored edge table, by repeated contraction towards smaller neighbours."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch


def scramble(node: Column) -> Column:
    """One-to-one shuffling of ids: neighbours on a path of rising ids get unrelated codes,
    so that a contraction round shrinks it by a constant factor rather than by one."""
    for left, right in ((13, 7), (17, 9)):
        node = node.bitwiseXOR(F.shiftleft(node, left))
        node = node.bitwiseXOR(F.shiftrightunsigned(node, right))
        node = node.bitwiseXOR(F.shiftleft(node, 17))
    return node


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, component): component is the smallest node reachable over `edges` (a, b).

    Each round every node moves to the smallest code among itself and its neighbours, edges
    follow, and loops and doubles go. Minima are aggregated before the shuffle, so a node with
    very many neighbours costs no more than others; the joins on it are splittable.
    """
    edges = scratch.store(
        edges.where("a <> b").select(scramble(F.col("a")).alias("x"), scramble(F.col("b")).alias("y"), "a", "b"), f"{name}-edges"
    )
    sides = edges.select(F.col("a").alias("node"), F.col("x").alias("code")).unionByName(
        edges.select(F.col("b").alias("node"), F.col("y").alias("code"))
    )
    labels = sides.distinct()
    live, turn, made = edges.select("x", "y"), 0, [f"{name}-edges"]
    while not live.isEmpty():
        both = live.unionByName(live.select(F.col("y").alias("x"), F.col("x").alias("y")))
        moves = both.groupBy("x").agg(F.min("y").alias("y")).select(F.col("x").alias("old"), F.least("x", "y").alias("new"))
        moves = scratch.store(moves, f"{name}-moves-{turn}")
        for side in ("x", "y"):
            live = live.join(moves, live[side] == moves["old"]).withColumn(side, F.col("new")).select("x", "y")
        live = live.where("x <> y").select(F.least("x", "y").alias("x"), F.greatest("x", "y").alias("y")).distinct()
        live = scratch.store(live, f"{name}-live-{turn}")
        labels = labels.join(moves, labels["code"] == moves["old"], "left").select("node", F.coalesce("new", "code").alias("code"))
        labels = scratch.store(labels, f"{name}-labels-{turn}")
        scratch.drop(*made, f"{name}-moves-{turn}")
        made = [f"{name}-live-{turn}", f"{name}-labels-{turn}"]
        turn += 1
    least = scratch.store(labels.groupBy("code").agg(F.min("node").alias("component")), f"{name}-least")
    found = scratch.store(labels.join(least, "code").select("node", "component"), f"{name}-components")
    scratch.drop(*made, f"{name}-least")
    return found
