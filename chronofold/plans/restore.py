"""A restore: manifest, ledger, scan, decode, apply, write, ledger entry, report."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Callable
from contextlib import ExitStack
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.operators.apply import apply_operations, batched_order, key_text, strict_order
from chronofold.operators.decode import decode_lines, with_keys
from chronofold.operators.sink import current_version, delete, read_current, read_current_or_none, swap_in
from chronofold.sources.changelog import read_lines
from chronofold.sources.ledger import DONE, SCHEMA, STAGED, Ledger, ParquetLedger, pending_files, staged_places
from chronofold.sources.manifest import FILES, Manifest, load_manifest

from .config import Config
from .progress import Totals, shown_progress, stoppable, tried
from .report import Report, file_counts, operation_counts


class CorruptLines(ValueError):
    pass


class Loader(Protocol):
    """Finds an export's manifest."""

    def __call__(self, spark: SparkSession, uri: str, root: str | None = None) -> Manifest: ...


class Decoder(Protocol):
    """Adds to lines what decode_lines() adds: op, keys, new_image, old_image, write_micros, is_corrupt, reason."""

    def __call__(self, lines: DataFrame) -> DataFrame: ...


class Uploader(Protocol):
    """Puts a run's report where it belongs."""

    def __call__(self, spark: SparkSession, report: Report, uri: str) -> None: ...


def upload_report(spark: SparkSession, report: Report, uri: str) -> None:
    spark.createDataFrame([(report.as_json(),)], "value string").coalesce(1).write.mode("overwrite").text(uri)


#: What is kept of a decoded line.
KEPT = ("op", "keys", "new_image", "old_image", "write_micros", "is_corrupt", "reason", "file", "file_ordinal", "block_start", "line_number")


@dataclass
class Result:
    report: Report
    snapshot: DataFrame | None
    version: str | None


def decode_export(spark: SparkSession, manifest: Manifest, key_columns: list[str], files: list[str] | None = None, decode: Decoder = decode_lines) -> DataFrame:
    """The decoded lines of an export's data files, or of some of them. An empty file list gives no rows."""
    paths = [(k, p) for k, p in manifest.data_paths() if files is None or manifest.files[k]["dataFileS3Key"] in files]
    decoded = decode(read_lines(spark, paths))
    return with_keys(decoded, key_columns) if key_columns else decoded


def _merged(base: DataFrame | None, decoded: DataFrame, order: str, batch_size: int) -> DataFrame:
    log = decoded.where(~F.col("is_corrupt")).withColumn("export_ordinal", F.lit(1))
    if base is not None:
        empty = F.lit(None).cast("map<string,string>")
        first = base.select(
            F.lit("PUT").alias("op"), "keys", F.col("item").alias("new_image"), empty.alias("old_image"), F.lit(0).alias("export_ordinal"), F.lit(0).cast("bigint").alias("write_micros"),
            F.lit(0).alias("file_ordinal"), F.lit(0).cast("bigint").alias("block_start"), F.lit(0).cast("bigint").alias("line_number"),
        )
        if order == "batched":
            log = batched_order(log, batch_size)
            kind = log.schema["seq"].dataType
            zero = F.struct(*[F.lit(0).cast(f.dataType).alias(f.name) for f in kind])
            ops = first.withColumn("seq", zero).select("op", "keys", "new_image", "old_image", "seq").unionByName(log.select("op", "keys", "new_image", "old_image", "seq"))
            return apply_operations(ops)
        log = first.unionByName(log.select(*first.columns))
    ordered = strict_order(log) if order == "strict" else batched_order(log, batch_size)
    return apply_operations(ordered.select("op", "keys", "new_image", "old_image", "seq"))


def with_key_maps(snapshot: DataFrame, key_columns: list[str]) -> DataFrame:
    wanted = F.array(*[F.lit(k) for k in key_columns])
    return snapshot.withColumn("keys", F.map_filter("item", lambda k, _: F.array_contains(wanted, k)))


@dataclass
class _Run:
    """A restore as far as it has come."""

    spark: SparkSession
    config: Config
    target: str
    manifest: Manifest
    ledger: Ledger | None
    decode: Decoder
    totals: Totals = field(default_factory=Totals)
    errors: list[str] = field(default_factory=list)
    counts: dict[str, dict[str | None, int]] = field(default_factory=dict)  # file -> operation (None: corrupt) -> lines

    def tried(self, work: Callable) -> object:
        return tried(work, self.config.tries, lambda e: self.errors.append(repr(e)))

    def staging(self) -> str:
        return f"{self.target}/_staging/{hashlib.sha256(self.manifest.export_id.encode()).hexdigest()[:16]}"

    def counted(self, decoded: DataFrame) -> None:
        """Adds up a decoded part's lines by file and operation: a few rows a file."""
        names = {k.rsplit("/", 1)[-1]: k for k in (f["dataFileS3Key"] for f in self.manifest.files)}
        rows = operation_counts(decoded)
        for r in rows.collect():
            self.counts.setdefault(names[r.file], {})[r.op] = r.n
        for r in file_counts(rows, self.config.batch_size).collect():
            self.totals.items += r["items"]
            self.totals.batches += r.batches

    def enter(self, files: list[str], state: str, place: str | None = None) -> None:
        if self.ledger and files:
            now = datetime.now(timezone.utc)
            own = {f: self.counts.get(f, {}) for f in files}
            rows = [(self.manifest.export_id, f, sum(n for op, n in c.items() if op), c.get(None, 0), now, state, place) for f, c in own.items()]
            self.ledger.append(self.spark.createDataFrame(rows, SCHEMA))

    def stage(self, files: list[str]) -> str:
        """Decodes some files and keeps their lines; they enter the ledger after that."""
        place = f"{self.staging()}/{uuid.uuid4().hex}"
        decode_export(self.spark, self.manifest, list(self.config.key_columns), files, self.decode).select(*KEPT).write.parquet(place)
        return place


def restore(spark: SparkSession, config: Config, target: str, ledger: Ledger | None = None, say: Callable[[str], None] | None = None, load: Loader = load_manifest, decode: Decoder = decode_lines, upload: Uploader = upload_report) -> Result:
    """Applies one export to the table under `target`. A dry run decodes, checks and reports, and writes nothing.

    With a ledger and `files_per_step` the export's files are decoded in steps;
    what a step has decoded is kept and entered, so a run that dies goes on with
    the files that are left. All of the export is then applied in one write,
    swapped in, and entered as done: the order of operations is that of the
    whole export, however it was read. say: gets lines of progress.
    """
    began, start = time.time(), datetime.now(timezone.utc)
    manifest = load(spark, config.export, config.root)
    ledger = ledger or (ParquetLedger(spark, config.resume) if config.resume else None)
    run = _Run(spark, config, target, manifest, ledger, decode)
    warnings = []
    if manifest.export_type != config.export_type:
        warnings.append(f"the manifest is of a {manifest.export_type} export, not {config.export_type}")
    if config.files_per_step and not ledger:
        warnings.append("without a ledger no step is kept")
    keys = list(config.key_columns)
    files = spark.createDataFrame([tuple(f[c.split()[0]] for c in FILES.split(", ")) for f in manifest.files], FILES)
    places: dict[str, str] = {}
    if ledger:
        known = ledger.read()
        files = pending_files(files, known, manifest.export_id)
        places = staged_places(known, manifest.export_id)
    names = sorted(r.dataFileS3Key for r in files.select("dataFileS3Key").collect())  # one row a file
    places = {f: p for f, p in places.items() if f in names}
    base = read_current_or_none(spark, target)  # a table without its pointer stops the run here
    base = base if base is None else with_key_maps(base, keys)
    with ExitStack() as stack:
        stack.enter_context(stoppable(spark, config.shutdown_timeout))
        if say:
            stack.enter_context(shown_progress(spark, run.totals, say))
        if config.files_per_step and ledger and not config.dry_run:
            for place in sorted(set(places.values())):
                run.counted(spark.read.parquet(place).where(F.col("file").isin([f.rsplit("/", 1)[-1] for f, p in places.items() if p == place])))
            left = [f for f in names if f not in places]
            for k in range(0, len(left), config.files_per_step):
                step = left[k : k + config.files_per_step]
                place = run.tried(lambda step=step: run.stage(step))
                run.counted(spark.read.parquet(place))
                run.enter(step, STAGED, place)
                places |= dict.fromkeys(step, place)
            decoded = _staged(spark, places) if places else decode_export(spark, manifest, keys, [], decode)
        else:
            decoded = decode_export(spark, manifest, keys, names, decode).select(*KEPT).persist()
            stack.callback(decoded.unpersist)
            run.tried(lambda: run.counted(decoded))
        corrupt = sum(c.get(None, 0) for c in run.counts.values())
        if corrupt and config.on_corrupt == "fail":
            raise CorruptLines(f"{corrupt} corrupt lines")
        version = snapshot = None
        if not config.dry_run:
            if names:
                version = run.tried(lambda: swap_in(_merged(base, decoded, config.order, config.batch_size), target, config.keep_versions))
                run.enter(names, DONE)
                delete(spark, run.staging())
                snapshot = read_current(spark, target)
            elif base is not None:
                snapshot = base.drop("keys")
    by_op: dict[str, int] = {}
    for own in run.counts.values():
        for op, n in own.items():
            by_op[op or "CORRUPT"] = by_op.get(op or "CORRUPT", 0) + n
    listed = sum(f["itemCount"] or 0 for f in manifest.files if f["dataFileS3Key"] in names)
    if listed != run.totals.items:
        warnings.append(f"the manifest lists {listed} items; {run.totals.items} were decoded")
    report = Report(start.isoformat(), datetime.now(timezone.utc).isoformat(), run.totals.items, corrupt, time.time() - began, run.totals.batches, len(run.errors), by_op, warnings + [f"tried again after {e}" for e in run.errors])
    if config.report and not config.dry_run:
        upload(spark, report, config.report)
    return Result(report, snapshot, version)


def _staged(spark: SparkSession, places: dict[str, str]) -> DataFrame:
    """The kept lines of files; of a place only the files that it counts for."""
    out = None
    for place in sorted(set(places.values())):
        own = [f.rsplit("/", 1)[-1] for f, p in places.items() if p == place]
        part = spark.read.parquet(place).where(F.col("file").isin(own))
        out = part if out is None else out.unionByName(part)
    return out


def restore_chain(spark: SparkSession, exports: list[DataFrame], key_columns: list[str]) -> DataFrame:
    """(key, item) after decoded exports, one after the other, with nothing written in between."""
    whole = None
    for k, log in enumerate(exports):
        log = with_keys(log, key_columns).where(~F.col("is_corrupt")).withColumn("export_ordinal", F.lit(k))
        whole = log if whole is None else whole.unionByName(log)
    return apply_operations(strict_order(whole))


__all__ = ["Config", "CorruptLines", "Result", "current_version", "decode_export", "key_text", "restore", "restore_chain", "with_key_maps"]
