"""Where the tables of an environment live."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from stratastar.session import switch

LAYERS = ("bronze", "silver", "gold", "tech")


@dataclass(frozen=True)
class Layout:
    """Paths `<root>/<store>/<layer>/<table>`.

    `stores` names the store of each environment; an environment not named uses dev's.
    """

    root: str
    environment: str = "dev"
    stores: Mapping[str, str] = field(default_factory=lambda: {"dev": "dev", "test": "test", "prod": "prod"})

    @property
    def store(self) -> str:
        return self.stores.get(self.environment, self.stores["dev"])

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer: {layer}")
        return f"{self.root.rstrip('/')}/{self.store}/{layer}/{table}"

    def read(self, spark: SparkSession, layer: str, table: str, schema: T.StructType | str | None = None) -> DataFrame:
        """The stored table; with the contract's `schema` no footer is opened to find its columns."""
        if schema is not None:
            return spark.read.schema(schema).parquet(self.path(layer, table))
        reader = spark.read.option("mergeSchema", "true") if layer == "bronze" else spark.read
        return reader.parquet(self.path(layer, table))

    def save(self, layer: str, table: str, df: DataFrame, *, mode: str = "overwrite", rebalance: bool = False) -> DataFrame:
        """Replace (or append to) a table and read it back. A replacement is written beside the
        old table first, so a job that fails leaves the old one as it is.

        Plans that end in a shuffle already have partitions sized by adaptive execution.
        `rebalance` adds a shuffle that evens out the files of a plan without one.
        """
        path = self.path(layer, table)
        rows = df.hint("rebalance") if rebalance else df
        if mode == "overwrite":
            beside = f"{path}__{uuid.uuid4().hex}"
            rows.write.parquet(beside)
            switch(df.sparkSession, beside, path)
        else:
            rows.write.mode(mode).parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
