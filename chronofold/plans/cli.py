"""Command line: restore an export, generate one, compare two tables."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from chronofold import ship
from chronofold.operators.sink import LostPointer, read_current
from chronofold.operators.verify import compare_counts, compare_tables

from .config import Config
from .datagen import Shape, write_lifecycle
from .lifecycle import verify_lifecycle
from .progress import Cancelled
from .restore import restore


def seconds(text: str) -> float:
    """Such as 90s, 5m or 1h."""
    unit = {"s": 1, "m": 60, "h": 3600}.get(text[-1:])
    return float(text[:-1]) * unit if unit else float(text)


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(prog="chronofold")
    commands = out.add_subparsers(dest="command", required=True)
    r = commands.add_parser("restore")
    r.add_argument("--table", required=True)
    r.add_argument("--export", required=True, help="a manifest summary, or the folder that holds it")
    r.add_argument("--target", required=True, help="where the table is kept")
    r.add_argument("--keys", required=True, help="key attributes, comma-separated")
    r.add_argument("--type", default="FULL")
    r.add_argument("--view", default="NEW")
    r.add_argument("--region", default="")
    r.add_argument("--resume", default="", help="the ledger's path")
    r.add_argument("--workers", type=int, default=10)
    r.add_argument("--batch-size", type=int, default=25)
    r.add_argument("--report", default="")
    r.add_argument("--dry-run", action="store_true")
    r.add_argument("--shutdown-timeout", type=seconds, default=300.0)
    r.add_argument("--on-corrupt", default="count")
    r.add_argument("--order", default="strict")
    r.add_argument("--root")
    g = commands.add_parser("generate")
    g.add_argument("--path", required=True)
    g.add_argument("--items", type=int, default=100)
    g.add_argument("--updates", type=int, default=30)
    g.add_argument("--deletes", type=int, default=20)
    g.add_argument("--seed", type=int, default=42)
    r.add_argument("--files-per-step", type=int, default=0, help="decode so many files at a time and keep them; needs --resume")
    r.add_argument("--keep-versions", type=int, help="versions of the table that stay")
    r.add_argument("--quiet", action="store_true", help="no lines of progress")
    c = commands.add_parser("lifecycle", help="generate, restore and check a table phase by phase")
    c.add_argument("--path", required=True)
    c.add_argument("--items", type=int, default=100)
    c.add_argument("--updates", type=int, default=30)
    c.add_argument("--deletes", type=int, default=20)
    c.add_argument("--seed", type=int, default=42)
    v = commands.add_parser("verify")
    v.add_argument("--source", required=True)
    v.add_argument("--target", required=True)
    return out


def main(argv: list[str] | None = None) -> int:
    argv = sys.argv[1:] if argv is None else argv
    if argv and argv[0].startswith("-"):
        argv = ["restore", *argv]
    args = parser().parse_args(argv)
    try:
        return _run(args)
    except (ValueError, Cancelled, LostPointer) as e:
        print(f"error: {e}", file=sys.stderr)
        return 130 if isinstance(e, Cancelled) else 2


def _run(args: argparse.Namespace) -> int:
    config = None
    if args.command == "restore":
        remote = args.export.startswith(("s3:", "s3a:"))  # then the checks of URIs and region hold
        config = Config(
            args.table, args.export, tuple(args.keys.split(",")), args.type, args.view, args.region, args.resume, args.workers, args.batch_size, args.report, args.dry_run, args.shutdown_timeout, args.on_corrupt, args.order, not remote, args.root,
            args.files_per_step, keep_versions=args.keep_versions,
        )
    spark = SparkSession.builder.appName("chronofold").getOrCreate()
    ship(spark)
    if config:
        print(restore(spark, config, args.target, say=None if args.quiet else lambda line: print(line, flush=True)).report.as_text())
        return 0
    if args.command == "lifecycle":
        phases = verify_lifecycle(spark, args.path, Shape(args.items, args.updates, args.deletes, args.seed)).collect()
        print("\n".join(f"{'ok  ' if p.ok else 'FAIL'} {p.phase}: {p.detail}" for p in phases))
        return 0 if all(p.ok for p in phases) else 1
    if args.command == "generate":
        print("\n".join(write_lifecycle(spark, args.path, Shape(args.items, args.updates, args.deletes, args.seed))))
        return 0
    source, target = read_current(spark, args.source), read_current(spark, args.target)
    counts = compare_counts(source, target).first()
    different = compare_tables(source, target).groupBy("status").count().collect()  # three rows at most
    print(f"source {counts.expected}, target {counts.actual}; " + (", ".join(f"{r['count']} {r.status}" for r in different) or "no differences"))
    return 1 if different else 0


if __name__ == "__main__":
    sys.exit(main())
