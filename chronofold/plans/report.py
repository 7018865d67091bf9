"""What a run reports: totals, throughput, and by operation and file."""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def throughput(items: int, seconds: float) -> float:
    return items / seconds if seconds > 0 else 0.0


def duration_text(seconds: float) -> str:
    """Such as 1h2m3.5s."""
    whole, parts = int(seconds), []
    if whole >= 3600:
        parts.append(f"{whole // 3600}h")
    if whole >= 60:
        parts.append(f"{whole % 3600 // 60}m")
    return "".join(parts) + f"{seconds - whole // 60 * 60:.3f}".rstrip("0").rstrip(".") + "s"


@dataclass
class Report:
    start_time: str
    end_time: str
    total_items: int
    corrupt_count: int
    seconds: float
    batches: int = 0
    errors: int = 0
    by_op: dict[str, int] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    def as_json(self) -> str:
        return json.dumps(
            {"startTime": self.start_time, "endTime": self.end_time, "totalItems": self.total_items, "corruptCount": self.corrupt_count, "duration": duration_text(self.seconds), "throughput": throughput(self.total_items, self.seconds)}
            | {"batches": self.batches, "errors": self.errors, "byOperation": self.by_op, "warnings": self.warnings},
            indent=2,
        )

    def as_text(self) -> str:
        rows = asdict(self) | {"duration": duration_text(self.seconds), "throughput": f"{throughput(self.total_items, self.seconds):.1f} items/s"}
        return "\n".join(f"{k}: {v}" for k, v in rows.items())


def operation_counts(decoded: DataFrame) -> DataFrame:
    """(file, op, n): one row for each file and operation; op null: corrupt. One aggregation."""
    return decoded.groupBy("file", "op").agg(F.count(F.lit(1)).alias("n"))


def file_counts(counts: DataFrame, batch_size: int = 25) -> DataFrame:
    """operation_counts() -> (file, items, corrupt, batches): a file's operations of all kinds fill its batches together."""
    items = F.sum(F.when(F.col("op").isNotNull(), F.col("n")).otherwise(0))
    return counts.groupBy("file").agg(items.alias("items"), (F.sum("n") - items).alias("corrupt")).withColumn("batches", F.ceil(F.col("items") / batch_size))
