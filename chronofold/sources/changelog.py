"""Data files of an export: gzipped JSON lines, with each line's place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

EMPTY = "line string, file string, file_ordinal int, block_start bigint, line_number bigint"


def read_lines(spark: SparkSession, paths: list[tuple[int, str]]) -> DataFrame:
    """(line, file, file_ordinal, block_start, line_number) of the files. paths: (ordinal, path).

    A gzipped file is read by one task, a plain one in blocks; lines are ordered
    by block_start and line_number within a file either way.
    """
    if not paths:
        return spark.createDataFrame([], EMPTY)
    names = spark.createDataFrame([(k, p.rsplit("/", 1)[-1]) for k, p in paths], "file_ordinal int, file string")
    if len({p.rsplit("/", 1)[-1] for _, p in paths}) != len(paths):
        raise ValueError("data files must have distinct names")
    lines = spark.read.text([p for _, p in paths]).select(
        F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block_start"), F.monotonically_increasing_id().alias("line_number")
    )
    return lines.join(F.broadcast(names), "file").select("line", "file", "file_ordinal", "block_start", "line_number")  # one row a file
