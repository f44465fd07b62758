"""What every order of a set of filters removes, from Lehmer-rank difference arrays.

A document's mask says which filters it fails. Filters applied in the order p remove it at the
first step whose filter it fails, so what counts is the prefix of p that ends there: letters that
it passes, then one that it fails. The orders that share a prefix of s of m letters have
consecutive lexicographic ranks, (m - s)! of them, and the Lehmer code of the prefix gives the
first. So:

1. Documents are counted by (part, mask); from here on the work does not grow with the corpus.
2. Each count is added at the first rank of every interval in which its mask is removed and taken
   off behind the last one, per step.
3. A running sum over the ranks gives what each order removes at each step; the totals follow.

All of it is DataFrame functions. The table of intervals depends on the number of filters alone
(840 rows for five), so it is broadcast.

Defined cases: a null text counts as empty, a null language as the part of empty name. A document
without an id has no smaller one, so it is never a repeat, and it has no label. Rows that repeat
are counted each; rows of one id and text are no repeats of each other, as neither id is smaller.
Of several labels of one document each says what it says: it is good if one is 1. An empty table
gives no rows. Other columns are not read.
"""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from stratastar.llm.common import Scratch

LETTERS = "ABCDE"
SPACE = r"[\x20\x09-\x0D]+"

# ---------------------------------------------------------------- ranks


def first_rank(prefix: str, letters: str) -> int:
    """Least lexicographic rank of the orders of `letters` that begin with `prefix`."""
    left, rank = sorted(letters), 0
    for letter in prefix:
        rank += left.index(letter) * factorial(len(left) - 1)
        left.remove(letter)
    return rank


def intervals(letters: str) -> list[tuple[int, int, int, int]]:
    """(mask, step, first rank, rank behind the last) in which documents of a mask are removed at a step.

    Bit i of a mask is the filter letters[i].
    """
    out = []
    for step in range(1, len(letters) + 1):
        for chosen in permutations(letters, step):
            prefix = "".join(chosen)
            free = [c for c in letters if c not in prefix]
            first = first_rank(prefix, letters)
            for number in range(2 ** len(free)):
                failed = [prefix[-1], *(c for i, c in enumerate(free) if number >> i & 1)]
                out.append((sum(1 << letters.index(c) for c in failed), step, first, first + factorial(len(letters) - step)))
    return out


def audited(facts: DataFrame, letters: str = LETTERS, flags: tuple[str, ...] = ()) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, one count per flag, shapley.

    `facts` has one row per document: part, mask (bit i: fails letters[i]) and boolean flags; the
    count of a flag is over the documents removed at the step that carry it.
    """
    spark, scratch = facts.sparkSession, Scratch(facts.sparkSession, "filter-audit")
    counted = [F.count("*").alias("removed"), *(F.count_if(F.col(f)).alias(f) for f in flags)]
    counts = scratch.store(facts.groupBy("part", "mask").agg(*counted), "counts")
    measures = ["removed", *flags]

    orders = factorial(len(letters))
    table = spark.createDataFrame(intervals(letters), "mask int, step int, first int, behind int")
    met = counts.join(F.broadcast(table), "mask")
    ends = F.explode(F.array(F.struct(F.col("first").alias("rank"), F.lit(1).alias("sign")), F.struct(F.col("behind").alias("rank"), F.lit(-1).alias("sign"))))
    changes = met.withColumn("end", ends).select("part", "step", "end.rank", *((F.col(m) * F.col("end.sign")).alias(m) for m in measures))
    # Every rank and step of every part appears, with no change where nothing begins or ends.
    steps, ranks = (F.explode(F.sequence(F.lit(a), F.lit(b))) for a, b in ((1, len(letters)), (0, orders - 1)))
    grid = counts.select("part").distinct().withColumn("step", steps).withColumn("rank", ranks)
    grid = grid.select("part", "step", "rank", *(F.lit(0).cast("long").alias(m) for m in measures))
    changes = changes.where(F.col("rank") < orders).unionByName(grid).groupBy("part", "step", "rank").agg(*(F.sum(m).alias(m) for m in measures))
    along = W.partitionBy("part", "step").orderBy("rank").rowsBetween(W.unboundedPreceding, 0)
    removed = changes.select("part", "step", "rank", *(F.sum(m).over(along).alias(m) for m in measures))

    names = F.array(*(F.lit("".join(p)) for p in permutations(sorted(letters))))
    removed = removed.withColumn("filter_order", F.element_at(names, F.col("rank") + 1))
    removed = removed.withColumn("filter", F.substring("filter_order", F.col("step"), F.lit(1)))
    before = W.partitionBy("part", "filter_order").orderBy("step").rowsBetween(W.unboundedPreceding, 0)
    out = removed.select(
        "*",
        F.sum("removed").over(before).alias("gone"),
        F.sum("removed").over(W.partitionBy("part", "filter")).alias("shapley"),
    )
    totals = counts.groupBy("part").agg(F.sum("removed").alias("total"))
    failed = F.explode(F.array(*(F.struct(F.lit(c).alias("filter"), F.lit(1 << i).alias("bit")) for i, c in enumerate(letters))))
    own = counts.withColumn("one", failed).groupBy("part", "one.filter").agg(
        F.sum(F.when(F.col("mask").bitwiseAND(F.col("one.bit")) != 0, F.col("removed")).otherwise(0)).alias("fails"),
        F.sum(F.when(F.col("mask") == F.col("one.bit"), F.col("removed")).otherwise(0)).alias("unique_fails"),
    )
    out = out.join(totals, "part").join(own, ["part", "filter"])
    return out.select(
        "part",
        "filter_order",
        "step",
        (F.col("total") - F.col("gone")).alias("kept"),
        "removed",
        (F.col("fails") - F.col("removed")).alias("redundant"),
        "unique_fails",
        *flags,
        "shapley",
    )


# ---------------------------------------------------------------- the five filters


def conditions(text: Column) -> dict[str, Column]:
    """Failure of the filters that look at one text alone."""
    words = F.filter(F.split(text, SPACE), lambda w: w != "")
    return {
        "A": F.size(words) < 200,
        "B": F.size(F.array_distinct(words)) * 100 < F.size(words) * 50,
        "C": F.regexp_count(text, F.lit("[A-Z]")) * 100 > F.length(text) * 3,
        "D": text.rlike("[#$%&*|]"),
    }


def facts(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: part, mask over A to E, good_lost and toxic_lost."""
    scratch = Scratch(documents.sparkSession, "filter-facts")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), text.alias("text"))
    alone = sum(failed.cast("int") * (1 << LETTERS.index(c)) for c, failed in conditions(F.col("text")).items())
    found = scratch.store(docs.select("doc_id", "part", alone.alias("mask"), F.unhex(F.sha2("text", 256)).alias("digest")), "masks")
    # The minima come from the map tasks, and rows look for theirs by text and id, so copies of one text spread.
    least = found.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    repeat = F.col("doc_id").isNotNull() & F.col("first").isNull()
    found = found.join(least, ["digest", "doc_id"], "left").withColumn("mask", F.col("mask") + repeat.cast("int") * (1 << LETTERS.index("E")))
    said = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good_lost"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic_lost")
    )
    flags = (F.coalesce(f, F.lit(False)).alias(f) for f in ("good_lost", "toxic_lost"))
    return found.join(said, "doc_id", "left").select("part", "mask", *flags)


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return audited(facts(documents, labels), LETTERS, ("good_lost", "toxic_lost"))
