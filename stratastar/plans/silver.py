"""Typed silver tables out of all-text source tables."""

from __future__ import annotations

from collections.abc import Callable, Collection

from pyspark.sql import Column, DataFrame

from stratastar.functions import cleaning
from stratastar.operators.versions import latest_columns, latest_version
from stratastar.plans.specs import SilverSpec

KINDS: dict[str, Callable[[str], Column]] = {
    "id": cleaning.id_text,
    "text": cleaning.clean_text,
    "code": cleaning.clean_code,
    "lower": cleaning.clean_lower,
    "date": cleaning.to_date,
    "timestamp": cleaning.to_timestamp,
    "int": cleaning.to_int,
    "flag": cleaning.flag,
    "flag_present": cleaning.flag_present,
}


def typed(name: str, kind: str) -> Column:
    """The column cleaned for its kind; a kind 'p,s' is a decimal."""
    if kind in KINDS:
        return KINDS[kind](f"`{name}`").alias(name)
    precision, scale = (int(part) for part in kind.split(","))
    return cleaning.to_decimal(f"`{name}`", precision, scale).alias(name)


def silver_table(bronze: DataFrame, spec: SilverSpec, *, dedup: bool = True) -> DataFrame:
    """One projection over the source; with `dedup`, only the latest version per key.

    The typed times decide which version is latest, so an unreadable time loses.
    """
    projected = bronze.select(*[typed(name, kind) for name, kind in spec.columns.items()])
    if not dedup:
        return projected
    return latest_version(projected, [spec.key], spec.version_order)


def silver_columns(bronze: DataFrame, spec: SilverSpec, columns: Collection[str], store: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Some columns of `silver_table` for consumers that read no others: key and times first, the rest in its order."""
    projected = bronze.select(*[typed(name, kind) for name, kind in spec.columns.items()])
    wanted = [name for name in dict.fromkeys([spec.key, *spec.version_order, *spec.columns]) if name in columns]
    return latest_columns(projected, [spec.key], spec.version_order, wanted, store)
