"""Stored intermediate tables and batch sizes shared by the operators."""

from __future__ import annotations

import ctypes
import io
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratastar.session import remove, scratch_path

#: Whole texts travel to Python in batches of about this size, so that few very long ones fit too.
#: Shuffled texts are dealt to tasks in smaller parts than Spark's own rows, as Python holds them too.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "1m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "32m",
    "spark.sql.files.maxPartitionBytes": "128m",
}


#: Folder of the shipped code by application; it goes when this Python ends.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def settle(spark: SparkSession) -> SparkSession:
    """Batch sizes, and this package's code for the Python workers, once per application."""
    for key, value in BATCH.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = Path(__file__).resolve().parent.parent
        code = io.BytesIO()
        with zipfile.ZipFile(code, "w", zipfile.ZIP_DEFLATED) as archive:
            for file in sorted(package.rglob("*.py")):
                archive.write(file, file.relative_to(package.parent))
        folder = _SHIPPED[context.applicationId] = tempfile.TemporaryDirectory()
        path = Path(folder.name, f"{package.name}.zip")
        path.write_bytes(code.getvalue())
        context.addPyFile(str(path))  # the driver serves it to the executors
    return spark


#: What a Python worker remembers for later tasks of the same operator, by operator.
REMEMBERED: dict[str, dict] = {}


@contextmanager
def lean(operator: str) -> Iterator[dict]:
    """Around a task's work: what this operator remembers in this Python worker.

    Workers serve one operator after another. What others remember goes when the task begins, and
    memory that is free goes back to the system when it ends, instead of staying with an idle worker.
    """
    for other in set(REMEMBERED) - {operator}:
        del REMEMBERED[other]
    try:
        yield REMEMBERED.setdefault(operator, {})
    finally:
        pa.default_memory_pool().release_unused()
        if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
            trim(0)


def leanly(operator: str, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """`work` inside `lean`, for an operator that remembers nothing between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with lean(operator):
            yield from work(batches)

    return run


def carried(columns: Sequence[str]) -> Column:
    """The named columns as one struct, whatever their names hold; a number if there are none."""
    return (F.struct(*("`" + name.replace("`", "``") + "`" for name in columns)) if columns else F.lit(0)).alias("carried")


def schema_of(**columns: str | T.DataType) -> T.StructType:
    """A schema of types by name, without spelling their names in text."""
    return T.StructType([T.StructField(name, T.DataType.fromDDL(kind) if isinstance(kind, str) else kind) for name, kind in columns.items()])


class Scratch:
    """Tables under `spark.checkpoint.dir`; `drop` removes those that nothing reads any more."""

    def __init__(self, spark: SparkSession, label: str) -> None:
        self.spark, self.label, self.paths = spark, label, {}

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write once, read back: lineage ends there and the planner knows the size."""
        path = scratch_path(self.spark, f"{self.label}-{name}")
        df.write.parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            remove(self.spark, self.paths.pop(name))

    def keep(self, *names: str) -> None:
        """Drop all tables but these."""
        self.drop(*(name for name in list(self.paths) if name not in names))
