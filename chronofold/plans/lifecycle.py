"""The whole life of a generated table, checked phase by phase."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from chronofold.operators.sink import read_current
from chronofold.operators.verify import compare_counts, compare_tables
from chronofold.sources.manifest import load_manifest, verify_checksums

from .config import Config
from .datagen import KEYS, Shape, full_lines, lifecycle_lines, write_export
from .restore import decode_export, restore, restore_chain

PHASES = ("generate", "full export", "lifecycle", "incremental export", "checksums", "restore full", "restore incremental", "counts", "differences")


def verify_lifecycle(spark: SparkSession, root: str, shape: Shape = Shape()) -> DataFrame:
    """(phase, ok, detail) in order: items are made and exported, changed and exported again, both exports restored one after the other, and the table compared with what the exports say."""
    found: list[tuple[str, bool, str]] = []
    lines = full_lines(shape)
    found.append((PHASES[0], len(lines) == shape.items, f"{len(lines)} items"))
    full = write_export(spark, root, "full", lines)
    found.append((PHASES[1], True, full))
    changes = lifecycle_lines(shape)
    found.append((PHASES[2], len(changes) == min(shape.updates, shape.items) + min(shape.deletes, shape.items), f"{len(changes)} changes"))
    incremental = write_export(spark, root, "incremental", changes, "INCREMENTAL")
    found.append((PHASES[3], True, incremental))
    manifests = [load_manifest(spark, x) for x in (full, incremental)]
    bad = [r.dataFileS3Key for m in manifests for r in verify_checksums(spark, m).where("status <> 'ok'").collect()]
    found.append((PHASES[4], not bad, ", ".join(bad)))
    target = f"{root}/table"
    first = restore(spark, Config("t", full, KEYS), target)
    found.append((PHASES[5], first.report.total_items == shape.items and not first.report.warnings, "; ".join(first.report.warnings)))
    second = restore(spark, Config("t", incremental, KEYS, "INCREMENTAL", "NEW_AND_OLD"), target)
    found.append((PHASES[6], second.report.total_items == len(changes) and not second.report.warnings, "; ".join(second.report.warnings)))
    counts = compare_counts(first.snapshot, read_current(spark, target), min(shape.deletes, shape.items)).first()
    found.append((PHASES[7], counts.equal, f"expected {counts.expected}, found {counts.actual}"))
    expected = restore_chain(spark, [decode_export(spark, m, list(KEYS)) for m in manifests], list(KEYS))
    different = compare_tables(expected, read_current(spark, target)).groupBy("status").count().collect()  # three rows at most
    found.append((PHASES[8], not different, ", ".join(f"{r['count']} {r.status}" for r in different)))
    return spark.createDataFrame(found, "phase string, ok boolean, detail string")
