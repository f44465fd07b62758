"""Declarations that the layers are built from."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column

from stratastar.operators.lookup import Lookup


@dataclass(frozen=True)
class SilverSpec:
    """Source table: its columns with their kinds, natural key and version order."""

    name: str
    key: str
    columns: Mapping[str, str]
    version_order: tuple[str, ...] = ("updated_at", "created_at")
    deleted: str | None = None

    @property
    def source(self) -> str:
        return f"src_{self.name}"

    @property
    def contract(self) -> tuple[str, ...]:
        return tuple(self.columns)


@dataclass(frozen=True)
class DimensionSpec:
    """Dimension over a silver table: key, parent lookups and the unknown member's texts."""

    name: str
    source: str
    natural_key: str
    key: str
    parents: tuple[Lookup, ...] = ()
    full_name: tuple[str, str, str] | None = None
    unknown: Mapping[str, str | int | bool] = field(default_factory=dict)
    version_order: tuple[str, ...] = ("updated_at", "created_at")
    deleted: str | None = None


@dataclass(frozen=True)
class FactSpec:
    """Fact over a silver table: every date column becomes a date key, every lookup a key."""

    name: str
    source: str
    natural_key: str
    key: str
    lookups: tuple[Lookup, ...]
    date_role: str
    status: tuple[str, str] | None = None
    live: tuple[str, bool] = ("is_deleted", False)
    drop: tuple[str, ...] = ()
    extra: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
