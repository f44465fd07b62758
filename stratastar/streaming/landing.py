"""Append the files that arrived since the last run to a source table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratastar.sources.bronze import conform


def append_available(
    spark: SparkSession, folder: str, contract: Sequence[str], target: str, checkpoint: str, *, table: str = "batch"
) -> None:
    """Load all header files not seen before, then stop.

    The checkpoint remembers the files, so a rerun after a lost run or an interrupted
    one neither repeats nor skips any. Lines whose column count breaks the contract fail.
    """
    schema = T.StructType([T.StructField(c, T.StringType()) for c in contract])
    stream = (
        spark.readStream.schema(schema).option("header", True).option("enforceSchema", False).option("mode", "FAILFAST").csv(folder)
    )
    landed = conform(stream, contract, table).withColumn("source_file", F.col("_metadata.file_name"))
    query = (
        landed.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
