"""Landing folder of header files into one all-text table per file."""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratastar.session import remove, stored, switch


def list_files(spark: SparkSession, folder: str, pattern: str = "*") -> DataFrame:
    """Files of a folder: path, file_name, table_name, length. File contents are not read."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("file_name"), table_name(name).alias("table_name"), "length")


def table_name(file_name: Column) -> Column:
    """File name without its last extension."""
    return F.regexp_replace(file_name, r"\.[^.]*$", "")


def read_landing(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text; the first row names them."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


class DuplicateTable(ValueError):
    """Two files of a landing folder would load into one table."""


def by_header(spark: SparkSession, paths: list[str]) -> dict[str, list[tuple[str, str]]]:
    """(path, path as file metadata has it) by the first line of the file; one scan finds all of them.

    A file without any line is left out.
    """
    lines = spark.read.text(paths).select("value", "_metadata.file_path", "_metadata.file_block_start")
    # The block at 0 is read by one task in the order of its lines, so the first value is the first line.
    found = lines.where("file_block_start = 0").groupBy("file_path").agg(F.first("value").alias("header")).collect()
    plain = lambda path: unquote(path).split(":", 1)[-1].lstrip("/")
    known = {plain(r["file_path"]): r for r in found}
    groups: dict[str, list[tuple[str, str]]] = {}
    for path in paths:
        row = known.get(path.split(":", 1)[-1].lstrip("/")) or known.get(plain(path))
        if row:
            groups.setdefault(row["header"], []).append((path, row["file_path"]))
    return groups


def ingest_folder(spark: SparkSession, folder: str, target: str, pattern: str = "*.csv", parallel: int = 8, renames: int = 16) -> list[str]:
    """Load every file into `<target>/<table>`, replacing data and schema; returns the table names.

    Two files of one table name are an error before anything is written. Only the file list and
    the first lines reach the driver. Files with the same header load in one job, which writes all
    their tables, and `renames` tables at once are moved to their places; jobs of different headers run
    side by side. A large file is split over many tasks.
    An empty file has no columns and loads nothing.
    """
    listed = list_files(spark, folder, pattern).select("path", "table_name").collect()
    names = Counter(r["table_name"] for r in listed)
    twice = sorted(name for name, n in names.items() if n > 1)
    if twice:
        raise DuplicateTable(", ".join(twice))
    tables = {r["path"]: r["table_name"] for r in listed}
    if not tables:
        return []
    groups = by_header(spark, sorted(tables))

    def load(paths: list[tuple[str, str]]) -> list[str]:
        beside = f"{target}/__{uuid.uuid4().hex}"
        data = spark.read.option("header", True).option("inferSchema", False).csv([path for path, _ in paths])
        data.withColumn("__table", F.md5(F.col("_metadata.file_path").cast("binary"))).write.partitionBy("__table").parquet(beside)

        def place(file: tuple[str, str]) -> str:
            path, known = file
            part = f"{beside}/__table={hashlib.md5(known.encode()).hexdigest()}"
            if stored(spark, part):
                switch(spark, part, f"{target}/{tables[path]}")
            else:  # a header without rows
                data.limit(0).write.mode("overwrite").parquet(f"{target}/{tables[path]}")
            return tables[path]

        with ThreadPoolExecutor(max_workers=renames) as movers:
            loaded = list(movers.map(place, paths))
        if stored(spark, f"{beside}/__table=*"):
            raise OSError(f"rows of unknown files are left in {beside}")
        remove(spark, beside)
        return loaded

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        return sorted(name for names in pool.map(load, groups.values()) for name in names)
