"""Registry of queries: a Spark callable and, where SQL can say it, the checking SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Tables:
    """The given tables, by attribute; each is a lazy scan."""

    spark: SparkSession
    folder: str

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


Build = Callable[[Tables], DataFrame]
QUERIES: dict[str, Build] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build

    return register
