"""The resume ledger: what is known of which files of which export. A set of rows, so order doesn't matter.

A file is staged when its decoded lines are kept under `place`, and done when
its export has been applied.
"""

from __future__ import annotations

from typing import Protocol

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "export_id string, file string, items bigint, corrupt bigint, finished_at timestamp, state string, place string"
STAGED, DONE = "staged", "done"


class Ledger(Protocol):
    def read(self) -> DataFrame: ...

    def append(self, rows: DataFrame) -> None: ...


class ParquetLedger:
    """Rows under a path that all executors share. A path without files is an empty ledger; other errors are raised."""

    def __init__(self, spark: SparkSession, path: str):
        if not path:
            raise ValueError("a ledger needs a path")
        self.spark, self.path = spark, path

    def read(self) -> DataFrame:
        try:
            return self.spark.read.schema(SCHEMA).parquet(self.path)
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], SCHEMA)

    def append(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(self.path)


class MemoryLedger:
    """In this process, for tests."""

    def __init__(self, spark: SparkSession):
        self.spark, self.rows = spark, []

    def read(self) -> DataFrame:
        return self.spark.createDataFrame(self.rows, SCHEMA)

    def append(self, rows: DataFrame) -> None:
        self.rows += [tuple(r) for r in rows.select(*[c.split()[0] for c in SCHEMA.split(", ")]).collect()]


def pending_files(files: DataFrame, ledger: DataFrame, export_id: str) -> DataFrame:
    """The manifest's files that the ledger doesn't list as done for this export. Both hold one row a file."""
    done = ledger.where(F.col("export_id") == export_id)
    if "state" in ledger.columns:
        done = done.where(F.coalesce("state", F.lit(DONE)) == DONE)
    return files.join(done.select(F.col("file").alias("dataFileS3Key")), "dataFileS3Key", "left_anti")


def staged_places(ledger: DataFrame, export_id: str) -> dict[str, str]:
    """file -> where its decoded lines are kept, the latest place of each one."""
    rows = ledger.where((F.col("export_id") == export_id) & (F.col("state") == STAGED)).groupBy("file").agg(F.max_by("place", "finished_at").alias("place")).collect()  # one row a file
    return {r.file: r.place for r in rows}


def totals(ledger: DataFrame, export_id: str) -> DataFrame:
    """One row: files, items and corrupt lines that are decoded so far, whether applied or not."""
    own = ledger.where(F.col("export_id") == export_id).groupBy("file").agg(F.max("items").alias("items"), F.max("corrupt").alias("corrupt"))
    return own.agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("items"), F.lit(0)).alias("items"), F.coalesce(F.sum("corrupt"), F.lit(0)).alias("corrupt"))


def naive_pending(files: DataFrame, last_file: str) -> DataFrame:
    """What resuming at a file name, in name order, would read: it skips unread files of an unsorted list. For comparison only."""
    return files.where(F.col("dataFileS3Key") >= last_file)
