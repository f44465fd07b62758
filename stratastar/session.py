"""Session settings and the shared scratch location."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of a scan task up to which they are sorted in memory, also after a wide projection.
TASK_ROWS = 1 << 20
#: Pieces that the keys of so many neighbouring rows are dealt out in.
PIECES = 1024
#: Bytes of given tables to a shuffle partition: their rows come to about five times that, typed and shuffled.
INPUT_OF_PARTITION = 6 << 20

PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Shuffled rows are sorted too, and take up to ten times their compressed size.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64m",
    # A scan task types and sorts wide rows, many times the size of their file; small splits keep them in memory.
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.session.timeZone": "UTC",
    # Wide typed projections compile to methods that the JIT skips; above this size
    # (bytes, the JIT's own limit) Spark splits the expressions instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


#: What the training-data operators were measured with, where they set nothing themselves.
TEXT_SETTINGS = {
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "256m",
}


def build_session(name: str = "stratastar", master: str | None = None, **extra: str) -> SparkSession:
    """Session with adaptive execution on; `extra` overrides any setting."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession, extra: Mapping[str, str] | None = None, folder: str | None = None) -> SparkSession:
    """Apply the settings to a session made elsewhere; all of them can change at run time. `extra` overrides any.

    With the `folder` of the given tables the number of shuffle partitions follows their size: adaptive execution merges
    small partitions, but cannot split those of a window, whose sorted rows would spill.
    """
    for key, value in {**SETTINGS, **(extra or {})}.items():
        spark.conf.set(key, value)
    spark.conf.unset(PARTITIONS)
    if folder:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        spark.conf.set(PARTITIONS, str(max(least, stored_bytes(spark, folder) // INPUT_OF_PARTITION)))
    return spark


def stored_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below `path`."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(place).getLength()


def scratch_root(spark: SparkSession) -> str:
    """Folder shared by all executors, as named in `spark.checkpoint.dir`.

    Only a local session without that setting (as in tests) gets a folder of its own.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="stratastar-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


#: Paths handed out inside each open `scratch_scope`, innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, label: str) -> str:
    path = f"{scratch_root(spark)}/{label}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes every scratch table made inside once the block ends: write what is to stay before that, elsewhere."""
    _SCOPES.append([])
    try:
        yield
    finally:
        for path in _SCOPES.pop():
            remove(spark, path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a stored table."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def stored(spark: SparkSession, path: str) -> bool:
    """Whether something is stored at `path`, which may be a pattern."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return len(place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []) > 0


def switch(spark: SparkSession, new: str, path: str) -> None:
    """Put the table stored at `new` in the place of `path`.

    The old table is moved aside, the new one moved in, and only then the old one deleted. If the
    new one cannot be moved in, the old one is moved back.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    source, place, aside = hadoop(new), hadoop(path), hadoop(f"{path}__old_{uuid.uuid4().hex}")
    store = place.getFileSystem(spark._jsc.hadoopConfiguration())
    store.mkdirs(place.getParent())
    had = store.exists(place)
    if had and not store.rename(place, aside):
        raise OSError(f"could not move {path} aside")
    moved = False
    try:
        moved = store.rename(source, place)
    finally:
        if had:
            if moved:
                store.delete(aside, True)
            else:
                store.rename(aside, place)
    if not moved:
        raise OSError(f"could not move {new} to {path}")


def dealt(df: DataFrame, keys: Sequence[Column] = (), task_rows: int | None = TASK_ROWS) -> DataFrame:
    """`df`, dealt out to all cores if its scan has fewer tasks than there are cores.

    A file of one row group is read by one task, which would then do a whole wide projection
    alone. A table with enough files or row groups is left as it is, so nothing is shuffled at scale.

    With `keys`, for consumers that rank the versions of a key, a stored table is also dealt out, by half of `task_rows`, if one of
    its scan tasks holds a tenth more rows than that: a row group is never split, and its sorted wide rows would spill.
    None is for narrow rows, which are dealt out to idle cores alone. Versions of a key stay together if they are among
    about a million neighbouring rows of a file, so one of them travels on; a hot key is spread.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = df._jdf.queryExecution().toRdd().getNumPartitions()
    parts = cores if 0 < tasks < cores else 0
    if not keys:
        return df.repartition(parts) if parts else df
    if task_rows is not None:
        # No column is read: the numbers come from the files' footers.
        held = df.groupBy(F.spark_partition_id().alias("task")).count().agg(F.max("count"), F.sum("count")).first()
        if (held[0] or 0) * 10 > task_rows * 11:
            parts = max(cores, held[1] * 2 // task_rows + 1)
    if not parts:
        return df
    run = F.floor(F.col("_metadata.row_index") / (task_rows or TASK_ROWS))
    piece = F.xxhash64("_metadata.file_path", run, F.pmod(F.xxhash64(*keys), F.lit(PIECES)))
    return df.select("*", piece.alias("__piece")).repartition(parts, "__piece").drop("__piece")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write `df` once and read it back.

    The lineage ends at a stored table that outlives any executor, several consumers
    share one computation, and the planner knows the real size, so it broadcasts the
    table only when that size is under `spark.sql.autoBroadcastJoinThreshold`.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialise_all(frames: Mapping[str, DataFrame], parallel: int = 8) -> dict[str, DataFrame]:
    """`materialise` for independent tables; their jobs share the cluster."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return dict(zip(frames, pool.map(lambda item: materialise(item[1], item[0]), frames.items()), strict=True))
