"""Tables stored in order over all their files, and the proof that they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION = "__position"


def write_sorted(df: DataFrame, order_by: Sequence[Column], path: str, *, files: int) -> None:
    """Write `df` in `files` files at most, each sorted, with ranges that follow the files' numbers.

    A range partitioning on all of `order_by` cuts through equal leading values as well, so one
    value with a third of all rows is spread over a third of the files.
    """
    df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by).write.parquet(path)


def _placed(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with the number of their file and their row in it, as files have it."""
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).cast("int")
    rows = spark.read.parquet(path)
    return rows.select("*", number.alias("__file"), F.col("_metadata.row_index").alias("__row"))


def positions(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows with their position (from 1) in the whole table, as the files hold them.

    Nothing is sorted: the position is the row's number in its file plus the rows of the files before.
    """
    rows = _placed(spark, path)
    sizes = rows.groupBy("__file").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__file", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    return rows.join(offsets, "__file").withColumn(POSITION, F.col("__offset") + F.col("__row") + 1).drop("__file", "__row", "__offset")


def boundaries(spark: SparkSession, path: str, order_by: Sequence[str]) -> DataFrame:
    """One row per file: file, n_rows, n_out_of_order inside it, its first and last values, and whether
    it follows the file before.

    Ascending, NULL first, is checked; a descending column is checked by its negative. Inside a file every row
    is compared with the one before it; between files the last row meets the next first one. So
    no two rows are out of order if all counts are 0 and all files follow.
    """
    rows = _placed(spark, path).withColumn("__values", F.struct(*order_by))
    inside = Window.partitionBy("__file").orderBy("__row")
    rows = rows.withColumn("__wrong", F.lag("__values").over(inside) > F.col("__values"))
    files = rows.groupBy("__file").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if("__wrong").alias("n_out_of_order"),
        F.min_by("__values", "__row").alias("first"),
        F.max_by("__values", "__row").alias("last"),
    )
    earlier = F.lag("last").over(Window.orderBy("__file"))
    follows = F.coalesce(earlier <= F.col("first"), F.lit(True))
    return files.select(F.col("__file").alias("file"), "n_rows", "n_out_of_order", "first", "last", follows.alias("follows"))
