"""What a restore is told, checked in a fixed order."""

from __future__ import annotations

from dataclasses import dataclass

EXPORT_TYPES = ("FULL", "INCREMENTAL")
VIEWS = ("NEW", "NEW_AND_OLD")
LARGEST_BATCH = 25


@dataclass(frozen=True)
class Config:
    table: str
    export: str
    key_columns: tuple[str, ...] = ()
    export_type: str = "FULL"
    view: str = "NEW"
    region: str = ""
    resume: str = ""
    workers: int = 10
    batch_size: int = LARGEST_BATCH
    report: str = ""
    dry_run: bool = False
    shutdown_timeout: float = 300.0
    on_corrupt: str = "count"
    order: str = "strict"
    local: bool = True  # accept any path and no region
    root: str | None = None
    files_per_step: int = 0  # decode so many files at a time and keep them, so that a run that dies goes on from there; 0: all at once
    tries: int = 3  # of each step
    keep_versions: int | None = None  # of the table; all if None

    def __post_init__(self) -> None:
        checks = (
            (bool(self.table), "table name is required"),
            (bool(self.export), "export URI is required"),
            (self.local or self.export.startswith(("s3://", "s3a://")), "export URI must start with s3://"),
            (self.export_type in EXPORT_TYPES, "export type must be FULL or INCREMENTAL"),
            (self.view in VIEWS, "view type must be NEW or NEW_AND_OLD"),
            (self.local or bool(self.region), "region is required"),
            (self.workers >= 1, "at least one worker is needed"),
            (self.batch_size >= 1, "batch size must be at least 1"),
            (self.batch_size <= LARGEST_BATCH, f"batch size must be at most {LARGEST_BATCH}"),
            (self.local or not self.report or self.report.startswith(("s3://", "s3a://")), "report URI must start with s3://"),
            (self.shutdown_timeout >= 1, "shutdown timeout must be at least one second"),
            (self.on_corrupt in ("count", "fail"), "on_corrupt must be count or fail"),
            (self.order in ("strict", "batched"), "order must be strict or batched"),
            (self.files_per_step >= 0, "files per step must not be negative"),
            (self.tries >= 1, "at least one try is needed"),
            (self.keep_versions is None or self.keep_versions >= 1, "at least one version must be kept"),
        )
        for ok, message in checks:
            if not ok:
                raise ValueError(message)
