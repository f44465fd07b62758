"""Append-only source tables: contract, text form, append, run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratastar.functions.cleaning import source_text
from stratastar.operators.setops import union_all

RUN_LOG_SCHEMA = T.StructType(
    [
        T.StructField("date_cible", T.DateType()),
        T.StructField("table_cible", T.StringType()),
        T.StructField("nb_versions", T.LongType()),
        T.StructField("run_timestamp", T.TimestampNTZType()),
        T.StructField("run_mode", T.StringType()),
    ]
)


class ContractError(ValueError):
    """The columns of a batch differ from the contract."""


def conform(batch: DataFrame, contract: Sequence[str], table: str = "batch") -> DataFrame:
    """The batch in contract order; any missing or extra column is an error before the job starts."""
    missing = sorted(set(contract) - set(batch.columns))
    extra = sorted(set(batch.columns) - set(contract))
    if missing or extra:
        raise ContractError(f"{table}: missing={missing} extra={extra}")
    return batch.select(*[f"`{c}`" for c in contract])


def as_source(batch: DataFrame, contract: Sequence[str], table: str = "batch", scale: int = 2) -> DataFrame:
    """Conforming batch with every value in source text form."""
    conforming = conform(batch, contract, table)
    return conforming.select(*source_text(conforming, scale))


def append_versions(
    batch: DataFrame, path: str, *, day: str | None = None, batch_id: str | None = None, mode: str = "append"
) -> None:
    """Append versions; what is there stays.

    With `batch_id` the batch is laid out in a folder of its own: a rerun of that batch
    replaces it, and another batch adds to it, of whatever day. With `day`, a column of
    `batch` that names the processed day, the files are laid out by day.
    """
    if mode == "dry_run":
        return
    if mode != "append":
        raise ValueError("mode is 'append' or 'dry_run'")
    # One shuffle by day, in which adaptive execution splits a heavy day: few files per day.
    rows = batch if day is None else batch.hint("rebalance", day)
    writer = rows.write.mode("append" if batch_id is None else "overwrite").option("partitionOverwriteMode", "static")
    if day is not None:
        writer = writer.partitionBy(day)
    writer.parquet(path if batch_id is None else f"{path}/batch_id={batch_id}")


def read_versions(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """All versions. With the contract's `schema` no file footer is opened to find the columns, and
    a column that a file lacks is NULL; without it the columns of all files are merged."""
    if schema is not None:
        return spark.read.schema(schema).parquet(path)
    return spark.read.option("mergeSchema", "true").parquet(path)


def batch_counts(batches: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per table, nothing written: table_cible, nb_versions."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("nb_versions")).select(F.lit(t).alias("table_cible"), "nb_versions")
            for t, df in batches.items()
        ]
    )


def write_summary(batches: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Versions and distinct keys per table: table_cible, nb_versions, nb_cles."""
    return union_all(
        [
            df.agg(F.count(F.lit(1)).alias("nb_versions"), F.count_distinct(key).alias("nb_cles")).select(
                F.lit(t).alias("table_cible"), "nb_versions", "nb_cles"
            )
            for t, (df, key) in batches.items()
        ]
    )


def run_log_rows(
    journal: Mapping[str, tuple[DataFrame, str | Column]], run_timestamp: Column, mode: str = "append"
) -> DataFrame:
    """Versions per processed day and table, in the schema of the run log."""
    counts = [
        df.groupBy((F.col(day) if isinstance(day, str) else day).cast("date").alias("date_cible"))
        .agg(F.count(F.lit(1)).alias("nb_versions"))
        .withColumn("table_cible", F.lit(table))
        for table, (df, day) in journal.items()
    ]
    stamped = union_all(counts).withColumns({"run_timestamp": run_timestamp, "run_mode": F.lit(mode)})
    return stamped.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_LOG_SCHEMA])


def append_run_log(rows: DataFrame, path: str, batch_id: str | None = None) -> None:
    """Create the log if absent, then append. With `batch_id` a rerun replaces its own rows."""
    append_versions(rows, path, batch_id=batch_id)


def read_run_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RUN_LOG_SCHEMA).parquet(path).select(*RUN_LOG_SCHEMA.fieldNames())
