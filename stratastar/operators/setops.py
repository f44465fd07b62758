"""Distinct unions behind the date and status dimensions, and unknown members."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratastar.functions.calendar import calendar_attributes
from stratastar.functions.keys import UNKNOWN, surrogate_key


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def observed_dates(sources: Sequence[tuple[DataFrame, Sequence[str | Column]]]) -> DataFrame:
    """One row per date seen in any of the columns, with calendar attributes.

    Each source is read once for all its date columns, and each task drops repeated
    dates before the one shuffle.
    """
    branches = []
    for df, columns in sources:
        dates = [(F.col(c) if isinstance(c, str) else c).cast("date") for c in columns]
        branches.append(df.select(F.explode(F.array(*dates)).alias("full_date")).where("full_date is not null"))
    return union_all(branches).distinct().select(*calendar_attributes("full_date"))


def domain_values(sources: Mapping[str, tuple[DataFrame, str]]) -> DataFrame:
    """Cleaned distinct (domain, value) pairs plus one unknown value per domain, with hash keys."""
    branches = []
    for domain, (df, column) in sources.items():
        value = F.upper(F.trim(F.col(column)))
        seen = df.select(F.lit(domain).alias("domaine_statut"), value.alias("statut_value"))
        branches.append(seen.where("statut_value is not null"))
    spark = branches[0].sparkSession
    unknown = spark.range(1).select(
        F.explode(F.array(*[F.lit(d) for d in sources])).alias("domaine_statut"), F.lit(UNKNOWN).alias("statut_value")
    )
    pairs = union_all([*branches, unknown]).distinct()
    return pairs.select(
        surrogate_key("domaine_statut", "statut_value").alias("statut_key"), "domaine_statut", "statut_value"
    )


def with_unknown(df: DataFrame, values: Mapping[str, Column | str | int | bool]) -> DataFrame:
    """`df` plus one member row: the given values, NULL elsewhere, in the types of `df`."""
    missing = set(values) - set(df.columns)
    if missing:
        raise ValueError(f"unknown member sets columns that do not exist: {sorted(missing)}")
    cells = []
    for field in df.schema:
        value = values.get(field.name)
        cell = value if isinstance(value, Column) else F.lit(value)
        cells.append(cell.cast(field.dataType).alias(field.name))
    return df.unionByName(df.sparkSession.range(1).select(*cells))
