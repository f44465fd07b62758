"""Exact distinct counts as a state that can be added up: bitmaps over dense member numbers.

A count of distinct values cannot be summed up over coarser groups; a set of values can. Members
get numbers without gaps, and a group's set is a bitmap per bucket of numbers. Bitmaps of finer
groups are OR-ed into those of coarser ones, of several facts, or of a new day, and the bits counted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratastar.session import materialise

BUCKET, BITS, BLANK = "__bucket", "__bits", "__blank"


def member_numbers(values: DataFrame) -> DataFrame:
    """(value, number): numbers from 1 without gaps for the distinct non-null values of a one-column table.

    The stored distinct values are numbered inside their partitions, and partitions follow each
    other by their counts, so only one row per partition is ever in one task.
    """
    (column,) = values.columns
    rows = values.where(F.col(f"`{column}`").isNotNull()).distinct().select(F.col(f"`{column}`").alias("value"))
    marked = materialise(rows.withColumn("__id", F.monotonically_increasing_id()), "members")
    part = F.shiftright("__id", 33)
    sizes = marked.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__n"))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("__part", F.coalesce(before, F.lit(0)).alias("__offset"))
    inside = F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    return marked.withColumn("__part", part).join(offsets, "__part").select("value", (inside + F.col("__offset") + 1).alias("number"))


def distinct_state(rows: DataFrame, groups: Sequence[str], value: Column, numbers: DataFrame, where: Column | None = None) -> DataFrame:
    """State per group: a bitmap per bucket of numbers, and in a row without a bucket whether a NULL was seen.

    Every group has its row without a bucket, so a group without any value is not lost. A value
    without a number is an error.
    """
    shown = rows.select(*[F.col(f"`{g}`") for g in groups], value.alias("__value"), (F.lit(True) if where is None else where).alias("__shown"))
    blank = F.max(F.coalesce(F.col("__shown"), F.lit(False)) & F.col("__value").isNull())
    blanks = shown.groupBy(*groups).agg(blank.alias(BLANK))
    # A group's repeated values go in the map tasks before they meet their numbers.
    pairs = shown.where("__shown and __value is not null").select(*[F.col(f"`{g}`") for g in groups], "__value").distinct()
    known = numbers.select(F.col("value").alias("__member"), F.col("number").alias("__number"))
    met = pairs.join(known, F.col("__value") == F.col("__member"), "left")
    number = F.coalesce("__number", F.raise_error(F.concat(F.lit("no member number for "), F.col("__value").cast("string"))).cast("long"))
    bits = met.withColumn("__number", number).groupBy(*groups, F.bitmap_bucket_number("__number").alias(BUCKET))
    bits = bits.agg(F.bitmap_construct_agg(F.bitmap_bit_position("__number")).alias(BITS))
    return bits.withColumn(BLANK, F.lit(None).cast("boolean")).unionByName(blanks, allowMissingColumns=True)


def merged_state(state: DataFrame, groups: Sequence[str]) -> DataFrame:
    """The state of coarser groups, or of several states put under each other."""
    bits = state.groupBy(*groups, BUCKET).agg(F.bitmap_or_agg(BITS).alias(BITS), F.max(BLANK).alias(BLANK))
    return bits.withColumn(BITS, F.when(F.col(BUCKET).isNotNull(), F.col(BITS)))


def distinct_counts(state: DataFrame, groups: Sequence[str], name: str) -> DataFrame:
    """Distinct values per group of the state; NULL counts as one value, and no value at all gives NULL."""
    merged = merged_state(state, groups)
    count = F.sum(F.coalesce(F.bitmap_count(BITS), F.lit(0))) + F.max(F.coalesce(F.col(BLANK), F.lit(False)).cast("int"))
    return merged.groupBy(*groups).agg(F.nullif(count, F.lit(0)).cast("long").alias(name))
