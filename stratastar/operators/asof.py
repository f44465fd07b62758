"""As-of search: the next offered value at or after each wanted one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def next_at_or_after(wanted: DataFrame, offered: DataFrame, column: str, found: str, bucket: Callable[[Column], Column]) -> DataFrame:
    """For every distinct `column` of `wanted`, the least `column` of `offered` that is not below it, as `found`.

    The search has no bound: a value may be carried back over any number of buckets. Both sides
    are put in one order. Inside a bucket (`bucket` must rise with the value, such as the month of a
    day) a window carries the next offered value backwards; a bucket that ends without one takes the
    first value of the nearest later bucket that has any. Only one row per bucket takes part in
    that second step, so its number is what runs in one task. NULL finds nothing, and a value after
    the last offered one has a NULL.
    """
    sides = wanted.select(F.col(column), F.lit(False).alias("__offer")).unionByName(offered.select(F.col(column), F.lit(True).alias("__offer")))
    values = sides.where(F.col(column).isNotNull()).groupBy(column).agg(F.max("__offer").alias("__offer"), (~F.min("__offer")).alias("__wanted"))
    values = values.withColumn("__bucket", bucket(F.col(column)))
    offer = F.when(F.col("__offer"), F.col(column))
    ahead = Window.partitionBy("__bucket").orderBy(column).rowsBetween(Window.currentRow, Window.unboundedFollowing)
    inside = values.withColumn("__near", F.min(offer).over(ahead))
    later = Window.orderBy("__bucket").rowsBetween(1, Window.unboundedFollowing)
    firsts = values.groupBy("__bucket").agg(F.min(offer).alias("__first")).select("__bucket", F.min("__first").over(later).alias("__far"))
    met = inside.join(firsts, "__bucket").where("__wanted")
    found_rows = met.select(column, F.coalesce("__near", "__far").alias(found))
    nulls = wanted.where(F.col(column).isNull()).select(column).distinct()
    return found_rows.unionByName(nulls.withColumn(found, F.lit(None).cast(offered.schema[column].dataType)))
