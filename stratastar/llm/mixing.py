"""Mixing sources to target weights by hierarchical budgeting, in DataFrame functions alone.

Leaves are (domain, language, source). A leaf can give its tokens (words) up to `epochs` times.
Budgets go down the tree: a node shares its budget among its children by weight; a child that
cannot use its share keeps what it can, and the rest is shared among its siblings again, so a
shortage is made up under the same parent first, and only what the whole parent cannot use is left
to the parent's own siblings. Shares are exact integers; fractions of a token are dropped. The
level up to which children are filled is found by counting per digits of their ratios, so any
number of sources may share one parent.

A leaf's budget buys whole epochs first, in which every document stands once, then a prefix of
the next epoch: documents in an order seeded for that epoch, up to the last one that still fits.
The prefix ends at a threshold key, found by counting tokens per leading digits of the keys, digit
group by digit group, so no leaf is sorted in one task; a document is in if its key is not above
its leaf's threshold. Texts are never shuffled.

Defined cases: a null or empty text has no tokens and follows its key. A null language or source
is the node "(none)". Rows equal in id and text share one key and enter together; each is a row of
the result. A weight of 0 or below, or a budget of 0, takes nothing; a leaf with no tokens gives
nothing. Columns of the input pass through in the struct `carried`, whatever their names. An
empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch, carried

LEVELS = ("domain", "language", "source")
#: Digits of a key counted at a time; what remains after DEPTH groups of digits is summed row by row.
DIGITS, DEPTH = 3, 2
#: Groups of ratios per factor of two, at the first step and at the second.
RATIO_DIGITS = (8, 16_384)
WORD = r"[^\x20\x09-\x0D]+"
EXACT = "decimal(38,0)"


@dataclass(frozen=True)
class Mix:
    """Integer weights by level and name (1 where not given), tokens wanted as a share of those there."""

    weights: Mapping[str, Mapping[str, int]] = field(default_factory=dict)
    percent: int = 100
    epochs: int = 2
    seed: int = 17

    def weight(self, level: str) -> Column:
        given = [x for item in self.weights.get(level, {}).items() for x in map(F.lit, item)]
        found = F.element_at(F.create_map(*given), F.col(level)) if given else F.lit(None)
        return F.greatest(F.coalesce(found, F.lit(1)), F.lit(0)).cast("long")


def allotted(children: DataFrame, parent: list[str], scratch: Scratch, name: str) -> DataFrame:
    """`share` of the parent's `budget` for children with `weight` and `capacity` (both positive).

    The water level is the most that a child gets per weight; a child whose ratio of capacity to
    weight lies under it is full. A child is full if, with the level at its own ratio, all children
    together use no more than the budget. Children are never sorted for that: their sums per leading digits of the
    ratio tell the first group of digits that is not full as a whole, and inside it the same is done
    with more digits; only the different (capacity, weight) of one last group meet in a task.
    """
    if not parent:
        return allotted(children.withColumn("root", F.lit(0)), ["root"], scratch, name).drop("root")
    ratio = F.col("capacity").cast("double") / F.col("weight").cast("double")
    children = children.withColumn("ratio", ratio)
    order = F.struct("ratio", "capacity", "weight")
    rows = children.select(*parent, "ratio", "capacity", "weight", "budget", F.lit(0).cast("long").alias("after"))
    fits = "cast({c} as decimal(38,0)) * cast({rest} as decimal(18,0)) <= cast({w} as decimal(18,0)) * cast({left} as decimal(38,0))"
    one_parent = W.partitionBy(*parent)
    made = []
    for step, digits in enumerate(RATIO_DIGITS):
        rows = rows.withColumn("digit", F.floor(F.log2("ratio") * digits))
        groups = rows.groupBy(*parent, "digit").agg(
            F.sum("capacity").alias("capacity"), F.sum("weight").alias("weight"), F.max("budget").alias("budget"), F.max("after").alias("after"), F.max(order).alias("top")
        )
        by_digit = one_parent.orderBy("digit")
        groups = groups.withColumn("earlier", F.coalesce(F.sum("capacity").over(by_digit.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
        groups = groups.withColumn("later", F.col("after") + F.coalesce(F.sum("weight").over(by_digit.rowsBetween(1, W.unboundedFollowing)), F.lit(0)))
        # Full as a whole if the child of the largest ratio in it is.
        whole = fits.format(c="top.capacity", rest="later + top.weight", w="top.weight", left="budget - earlier - capacity + top.capacity")
        edge = groups.where(f"not ({whole})").groupBy(*parent).agg(F.min(F.struct("digit", (F.col("budget") - F.col("earlier")).alias("budget"), F.col("later").alias("after"))).alias("edge"))
        edge = scratch.store(edge.select(*parent, "edge"), f"{name}-edge-{step}")
        made.append(f"{name}-edge-{step}")
        rows = rows.drop("budget", "after").join(edge, parent).where(F.col("digit") == F.col("edge.digit"))
        rows = rows.select(*parent, "ratio", "capacity", "weight", F.col("edge.budget").alias("budget"), F.col("edge.after").alias("after"))
    pairs = rows.groupBy(*parent, "ratio", "capacity", "weight", "budget", "after").agg(F.count("*").alias("n"))
    by_ratio = one_parent.orderBy("ratio", "capacity", "weight")
    pairs = pairs.withColumn("earlier", F.coalesce(F.sum(F.col("n") * F.col("capacity")).over(by_ratio.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    pairs = pairs.withColumn("rest", F.col("after") + F.sum(F.col("n") * F.col("weight")).over(by_ratio.rowsBetween(W.currentRow, W.unboundedFollowing)))
    still = fits.format(c="capacity", rest="rest", w="weight", left="budget - earlier")
    opens = pairs.where(f"not ({still})").groupBy(*parent).agg(F.min(order).alias("opens"))
    opens = scratch.store(opens, f"{name}-opens")
    children = children.join(opens, parent, "left").withColumn("full", F.col("opens").isNull() | (order < F.col("opens")))
    sums = children.groupBy(*parent).agg(
        F.sum(F.when(F.col("full"), F.col("capacity")).otherwise(0)).alias("used"), F.sum(F.when(~F.col("full"), F.col("weight")).otherwise(0)).alias("open")
    )
    children = children.join(sums, parent)
    part = F.expr("cast((cast(weight as decimal(18,0)) * cast(budget - used as decimal(20,0))) div cast(open as decimal(18,0)) as bigint)")
    out = children.withColumn("share", F.when(F.col("full"), F.col("capacity")).otherwise(part)).drop("ratio", "opens", "full", "used", "open")
    out = scratch.store(out, f"{name}-shares")
    scratch.drop(*made, f"{name}-opens")
    return out


def budgets(leaves: DataFrame, mix: Mix, scratch: Scratch) -> DataFrame:
    """(domain, language, source, tokens, share): the leaf's budget, from leaves with their tokens."""
    wanted = (leaves.agg(F.sum("tokens")).first()[0] or 0) * mix.percent // 100
    for level in LEVELS:
        leaves = leaves.withColumn(f"{level}_weight", mix.weight(level))
    leaves = leaves.where(" and ".join(f"{level}_weight > 0" for level in LEVELS) + " and tokens > 0").withColumn("capacity", F.col("tokens") * mix.epochs)
    above = None
    for depth in range(1, len(LEVELS) + 1):
        names, parent = list(LEVELS[:depth]), list(LEVELS[: depth - 1])
        level = leaves.groupBy(*names).agg(F.sum("capacity").alias("capacity"), F.max(f"{LEVELS[depth - 1]}_weight").alias("weight"))
        level = level.join(above, parent) if parent else level.withColumn("budget", F.lit(wanted).cast("long"))
        above = allotted(level, parent, scratch, f"level-{depth}").select(*names, F.col("share").alias("budget"))
    return leaves.select(*LEVELS, "tokens").join(above, list(LEVELS)).withColumnRenamed("budget", "share")


def _named(documents: DataFrame, domain: Column, mix: Mix, carry: tuple[str, ...]) -> DataFrame:
    """Leaf, tokens and content digest of every row."""
    own = lambda c: F.coalesce(c.cast("string"), F.lit("(none)"))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    content = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text).cast("binary"))
    return documents.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        own(domain).alias("domain"),
        own(F.col("lang")).alias("language"),
        own(F.col("source")).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("n_tokens"),
        content.alias("content"),
        carried(carry),
    )


def mixed(documents: DataFrame, domain: Column, mix: Mix, carry: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, domain, language, source, n_tokens, epoch, carried): a row for each time a document is taken."""
    spark = documents.sparkSession
    scratch = Scratch(spark, "mixing")
    named = _named(documents, domain, mix, carry)
    sized = scratch.store(named.select(*LEVELS, "n_tokens", "content"), "sized")
    leaves = scratch.store(sized.groupBy(*LEVELS).agg(F.sum("n_tokens").alias("tokens")), "leaves")
    plan = budgets(leaves, mix, scratch).withColumn("epochs", F.expr("share div tokens")).withColumn("left", F.expr("share % tokens"))
    plan = scratch.store(plan, "plan")

    key = F.md5(F.concat(F.lit(f"{mix.seed}:"), F.col("epochs").cast("string"), F.lit(":"), F.col("content")).cast("binary"))
    rows = sized.join(plan.where("left > 0").select(*LEVELS, "epochs", F.col("left").alias("room")), list(LEVELS)).withColumn("key", key)
    rows = rows.withColumn("head", F.lit(""))
    edge = None
    running = W.partitionBy(*LEVELS).orderBy("head").rowsBetween(W.unboundedPreceding, W.currentRow)
    for depth in range(1, DEPTH + 1):
        if edge is not None:
            rows = _inside(rows, edge)
        heads = rows.withColumn("head", F.substring("key", 1, DIGITS * depth)).groupBy(*LEVELS, "head", "room").agg(F.sum("n_tokens").alias("tokens"))
        heads = heads.withColumn("sum", F.sum("tokens").over(running))
        # The first group of keys that does not fit whole; the threshold lies in it, or just before it.
        edge = heads.where("sum > room").groupBy(*LEVELS).agg(F.min(F.struct("head", (F.col("room") - F.col("sum") + F.col("tokens")).alias("room"))).alias("edge"))
        edge = scratch.store(edge.select(*LEVELS, F.col("edge.head").alias("edge_head"), F.col("edge.room").alias("edge_room")), f"edge-{depth}")
    last = _inside(rows, edge)
    total = F.sum("n_tokens").over(W.partitionBy(*LEVELS).orderBy("key").rangeBetween(W.unboundedPreceding, W.currentRow))
    fits = last.withColumn("sum", total).where("sum <= room").groupBy(*LEVELS).agg(F.max("key").alias("fits"))
    # Keys below the edge group are in, and those in it up to the last that fits.
    ends = edge.join(fits, list(LEVELS), "left").select(*LEVELS, F.coalesce("fits", "edge_head").alias("threshold"))
    plan = scratch.store(plan.join(ends, list(LEVELS), "left"), "thresholds")

    taken = named.join(plan.select(*LEVELS, "epochs", "left", "threshold"), list(LEVELS)).withColumn("key", key)
    whole = F.filter(F.sequence(F.lit(-1).cast("long"), F.col("epochs") - 1), lambda e: e >= 0)
    part = F.when((F.col("left") > 0) & (F.col("key") <= F.col("threshold")), F.array("epochs")).otherwise(F.array().cast("array<bigint>"))
    taken = taken.withColumn("epoch", F.explode(F.concat(whole, part)))
    return taken.select("doc_id", *LEVELS, "n_tokens", F.col("epoch").cast("int").alias("epoch"), "carried")


def _inside(rows: DataFrame, edge: DataFrame) -> DataFrame:
    """Rows whose key starts with their leaf's edge, with the room that is left at it."""
    rows = rows.drop("room").join(edge.withColumnRenamed("edge_room", "room"), list(LEVELS))
    return rows.where(F.col("key").startswith(F.col("edge_head"))).drop("edge_head")
