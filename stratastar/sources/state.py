"""Latest versions kept as a stored state that batches are merged into."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratastar.operators.versions import latest_version
from stratastar.session import scratch_path, remove, stored

BUCKET = "__bucket"


class BucketMismatch(ValueError):
    """A state was written with another number of buckets."""


@dataclass(frozen=True)
class LatestState:
    """The newest version of every key, in `buckets` folders by a hash of the key.

    A batch is compared with the buckets that its keys fall into; the other buckets are neither
    read nor written. What wins is the first version in a total order: descending `order_by`
    (unreadable last), then all other columns ascending, as in `latest_version`. Winning by a
    total order does not depend on when a version arrives, so batches may come in any order, late
    or twice, and the state equals a full rebuild from all versions. A winning version that is
    flagged `deleted` stays in the state as a tombstone and is only left out by `current`; were it
    dropped, an older version that comes late would bring its key back.

    Each bucket holds one row per key, whatever the number of versions: the ranking is a window
    group limit, so a hot key leaves each map task as one row. `buckets` is fixed when the
    state is first written; choose it so that a bucket is about a file in size.

    A merge first stores the merged buckets in the scratch folder, then overwrites those
    folders. If the second step fails half way, merging the batch again completes it: what is
    already in has no effect the second time.
    """

    spark: SparkSession
    path: str
    schema: T.StructType
    keys: Sequence[str]
    order_by: Sequence[str]
    buckets: int = 256
    deleted: str | None = None
    _root: str = field(init=False, default="")

    def __post_init__(self) -> None:
        object.__setattr__(self, "_root", f"{self.path.rstrip('/')}/of={self.buckets}")

    def bucket_of(self, keys: Sequence[Column]) -> Column:
        return F.pmod(F.xxhash64(*[k.cast("string") for k in keys]), F.lit(self.buckets)).cast("int")

    def versions(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """The state's rows with their bucket, tombstones included; only of some buckets if given."""
        if not stored(self.spark, self._root):
            if stored(self.spark, f"{self.path.rstrip('/')}/of=*"):
                raise BucketMismatch(f"{self.path} is not of {self.buckets} buckets")
            return self.spark.createDataFrame([], self._stored_schema)
        rows = self.spark.read.schema(self._stored_schema).parquet(self._root)
        # A filter on the partition column by values: only these folders are listed and opened.
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))

    @property
    def _stored_schema(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField(BUCKET, T.IntegerType())])

    def merge(self, batch: DataFrame) -> list[int]:
        """Merge versions into the state; returns the buckets that they fell into (at most `buckets` numbers)."""
        rows = batch.select(*[F.col(f"`{f.name}`").cast(f.dataType) for f in self.schema])
        rows = self._newest(rows.withColumn(BUCKET, self.bucket_of([F.col(k) for k in self.keys])))
        place = scratch_path(self.spark, "state-batch")
        rows.write.parquet(place)
        rows = self.spark.read.schema(rows.schema).parquet(place)
        touched = sorted(r[0] for r in rows.select(BUCKET).distinct().collect())
        if touched:
            beside = scratch_path(self.spark, "state-merged")
            self._newest(self.versions(touched).unionByName(rows)).write.parquet(beside)
            merged = self.spark.read.schema(rows.schema).parquet(beside)
            # One file per bucket.
            merged.repartition(F.col(BUCKET)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(BUCKET).parquet(self._root)
            remove(self.spark, beside)
        remove(self.spark, place)
        return touched

    def _newest(self, rows: DataFrame) -> DataFrame:
        return latest_version(rows, self.keys, self.order_by)

    def current(self) -> DataFrame:
        """The newest version of every key that is not deleted by it."""
        rows = self.versions()
        if self.deleted is not None:
            rows = rows.where(~F.coalesce(F.col(self.deleted), F.lit(False)))
        return rows.drop(BUCKET)
