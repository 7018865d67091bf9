"""The change log as a stream: files that arrive are decoded and applied to the kept table, each exactly once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from chronofold.operators.apply import apply_operations, strict_order
from chronofold.operators.decode import decode_lines, with_keys
from chronofold.operators.sink import read_current_or_none, swap_in
from chronofold.plans.restore import with_key_maps


def read_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """(line, file, block_start) of new files under a path."""
    reader = spark.readStream.format("text")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path).select(F.col("value").alias("line"), F.col("_metadata.file_name").alias("file"), F.col("_metadata.file_block_start").alias("block_start"))


def apply_batch(target: str, key_columns: list[str], keep_versions: int | None = 3) -> Callable[[DataFrame, int], None]:
    """For foreachBatch(). Each batch writes a new version of the table; the last `keep_versions` ones stay. Of a batch replayed after a failure the outcome is the same: it is applied in order to what is there."""

    def run(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        lines = batch.withColumn("line_number", F.monotonically_increasing_id()).withColumn("file_ordinal", F.lit(0))
        log = with_keys(decode_lines(lines), key_columns).where(~F.col("is_corrupt")).withColumn("export_ordinal", F.lit(1)).withColumn("file_ordinal", F.col("file"))
        columns = ["op", "keys", "new_image", "old_image", "export_ordinal", "write_micros", "file_ordinal", "block_start", "line_number"]
        log = log.select(*columns)
        base = read_current_or_none(spark, target)
        base = base if base is None else with_key_maps(base, key_columns)
        if base is not None:
            zero = F.lit(0).cast("bigint")
            first = base.select(F.lit("PUT").alias("op"), "keys", F.col("item").alias("new_image"), F.lit(None).cast("map<string,string>").alias("old_image"), F.lit(0).alias("export_ordinal"), zero.alias("write_micros"), F.lit("").alias("file_ordinal"), zero.alias("block_start"), zero.alias("line_number"))
            log = first.unionByName(log)
        swap_in(apply_operations(strict_order(log)), target, keep_versions)

    return run


def start(spark: SparkSession, source: str, target: str, checkpoint: str, key_columns: list[str], files_per_batch: int | None = None, once: bool = False) -> StreamingQuery:
    writer = read_stream(spark, source, files_per_batch).writeStream.foreachBatch(apply_batch(target, key_columns)).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
