"""Data tests, quality log, freshness and run log."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.functions.cleaning import zero_to_null
from stratastar.operators.setops import union_all
from stratastar.session import materialise

WARN_BELOW = 5  # percent of failed records


def not_null_failures(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_failures(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with their count."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counts.where("n_records > 1")


def unique_failure_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """How many values occur more than once, for several columns at once: column_name, n_failures (see `column_failures`)."""
    return column_failures(df, [], columns).select("column_name", "n_failures")


def column_failures(df: DataFrame, never_null: Sequence[str], unique: Sequence[str]) -> DataFrame:
    """Failures of all tests on the columns of a table: column_name, test, n_failures.

    `df` is worked out once. One scan unpivots the unique columns to (number of the column, 64-bit print of the
    value), and a row with a NULL where none may be adds one cell that names all such columns; one shuffle counts
    them, like cells falling together in the map tasks. The few counts that matter are stored. Only if a print
    came twice are its rows looked at again: they are counted by the values themselves, so two values of one
    print are no failure.
    """
    names, filled = list(dict.fromkeys(unique)), list(dict.fromkeys(never_null))
    if len(filled) > 63:
        raise ValueError("at most 63 never-null columns fit the name of a row's NULLs")
    values = [F.col(f"`{c}`").cast("string") for c in names]
    prints = [F.when(v.isNotNull(), F.xxhash64(v)) for v in values]
    empty = F.lit(0).cast("long")
    for j, c in enumerate(filled):
        empty = empty.bitwiseOR(F.when(F.col(f"`{c}`").isNull(), F.lit(1 << j).cast("long")).otherwise(0))
    cells = df.select(F.posexplode(F.array(*prints, F.nullif(empty, F.lit(0).cast("long")))).alias("__i", "__print")).where("__print is not null")
    counts = cells.groupBy("__i", "__print").agg(F.count(F.lit(1)).alias("__n")).where((F.col("__i") == len(names)) | (F.col("__n") > 1))
    found = materialise(counts, "cells")
    rows = []
    if filled:
        held = [F.sum(F.when(F.col("__print").bitwiseAND(F.lit(1 << j).cast("long")) != 0, F.col("__n"))) for j in range(len(filled))]
        totals = found.where(F.col("__i") == len(names)).agg(*[F.coalesce(h, F.lit(0)).alias(f"__c{j}") for j, h in enumerate(held)])
        rows.append(totals.select(F.inline(F.array(*[_failures(c, "not_null", F.col(f"__c{j}")) for j, c in enumerate(filled)]))))
    if names:
        twice = found.where(F.col("__i") < len(names)).select("__i", "__print")
        every = df.sparkSession.range(1).select(F.posexplode(F.array(*[F.lit(c) for c in names])).alias("__i", "column_name"))
        failed = F.lit(0)
        if not twice.isEmpty():
            looked = df.select(F.inline(F.array(*[F.struct(F.lit(i).alias("__i"), v.alias("__value")) for i, v in enumerate(values)])))
            looked = looked.where("__value is not null").withColumn("__print", F.xxhash64("__value"))
            again = looked.join(twice, ["__i", "__print"], "left_semi").groupBy("__i", "__value").agg(F.count(F.lit(1)).alias("__n"))
            every = every.join(again.where("__n > 1").groupBy("__i").agg(F.count(F.lit(1)).alias("__failed")), "__i", "left")
            failed = F.coalesce("__failed", F.lit(0))
        rows.append(every.select("column_name", F.lit("unique").alias("test"), failed.cast("long").alias("n_failures")))
    return union_all(rows)


def _failures(column: str, test: str, count: Column) -> Column:
    return F.struct(F.lit(column).alias("column_name"), F.lit(test).alias("test"), count.cast("long").alias("n_failures"))


def accepted_values_failures(df: DataFrame, column: str, accepted: Sequence[str]) -> DataFrame:
    """Values outside the list, with their count."""
    outside = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*accepted))
    return outside.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))


@dataclass(frozen=True)
class Check:
    """`kind` is null_check, range_check (value below 0) or duplicate_check."""

    table: str
    column: str
    kind: str

    def failed(self) -> Column:
        value = F.col(self.column)
        if self.kind == "null_check":
            return F.sum(F.when(value.isNull(), 1).otherwise(0))
        if self.kind == "range_check":
            return F.sum(F.when(value < 0, 1).otherwise(0))
        if self.kind == "duplicate_check":
            return F.count(F.lit(1)) - F.count_distinct(value)
        raise ValueError(f"unknown check: {self.kind}")


def quality_log(
    tables: Mapping[str, DataFrame], checks: Sequence[Check], checked_at: Column, layer: str = "gold"
) -> DataFrame:
    """One row per check; every table is aggregated once for all its checks."""
    rows = []
    for name in dict.fromkeys(check.table for check in checks):
        own = [check for check in checks if check.table == name]
        totals = tables[name].agg(
            F.count(F.lit(1)).alias("records_checked"), *[c.failed().alias(f"failed_{i}") for i, c in enumerate(own)]
        )
        cells = [
            F.struct(
                F.lit(c.column).alias("column_name"),
                F.lit(c.kind).alias("check_type"),
                F.col(f"failed_{i}").alias("records_failed"),
            )
            for i, c in enumerate(own)
        ]
        rows.append(
            totals.select(F.lit(name).alias("table_name"), "records_checked", F.inline(F.array(*cells)))
        )
    good = F.col("records_checked") - F.col("records_failed")
    rate = F.round(F.try_divide(good.cast("decimal(20,0)") * 100, F.col("records_checked").cast("decimal(20,0)")), 2)
    return union_all(rows).select(
        checked_at.alias("checked_at"),
        F.lit(layer).alias("table_schema"),
        "table_name",
        "column_name",
        "check_type",
        "records_checked",
        "records_failed",
        F.when(F.col("records_checked") == 0, F.lit(0)).otherwise(rate).cast("decimal(5,2)").alias("pass_rate"),
        F.when(F.col("records_failed") == 0, "pass")
        .when(F.col("records_failed") * 100 < F.col("records_checked") * WARN_BELOW, "warn")
        .otherwise("fail")
        .alias("status"),
    )


def freshness(tables: Mapping[tuple[str, str], tuple[DataFrame, str]], checked_at: Column) -> DataFrame:
    """Newest version time and row count per (layer, table); the value is (data, time column)."""
    return union_all(
        [
            df.agg(
                F.max(F.col(column).cast("timestamp_ntz")).alias("last_load_time"),
                F.count(F.lit(1)).alias("row_count"),
            ).select(
                F.lit(layer).alias("table_schema"),
                F.lit(name).alias("table_name"),
                "last_load_time",
                "row_count",
                checked_at.alias("checked_at"),
            )
            for (layer, name), (df, column) in tables.items()
        ]
    )


# Statement types that the run log leaves out.
SKIPPED_STATEMENTS = ("COND WITH QUERY", "USE")


def run_log(
    statements: DataFrame,
    as_of: Column,
    *,
    environment: str = "DEV",
    days: int = 7,
    skipped: Sequence[str] = SKIPPED_STATEMENTS,
) -> DataFrame:
    """Statements of the last days. Input columns: run_id, pipeline_name, statement_type,
    status, start_time, end_time, elapsed_ms, row_count, error_code."""
    recent = statements.where(
        (F.col("start_time") >= as_of - F.expr(f"INTERVAL {days} DAYS")) & ~F.col("statement_type").isin(*skipped)
    )
    return recent.select(
        "run_id",
        "pipeline_name",
        F.lit(environment).alias("environment"),
        "status",
        F.col("start_time").cast("timestamp_ntz").alias("start_time"),
        F.col("end_time").cast("timestamp_ntz").alias("end_time"),
        F.expr("elapsed_ms div 1000").alias("duration_seconds"),
        F.col("row_count").alias("rows_processed"),
        zero_to_null("error_code").alias("error_message"),
        as_of.alias("inserted_at"),
    )
