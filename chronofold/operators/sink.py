"""Sinks: versions of a snapshot with pointers to them, and batched writes to an outside store."""

from __future__ import annotations

import json
import random
import re
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from itertools import islice
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

BASE_DELAY, LONGEST_DELAY, RETRIES = 0.1, 30.0, 5
VERSION, POINTER = re.compile(r"v-\d+-[0-9a-f]{8}"), re.compile(r"p-\d{12}")


class Throttled(Exception):
    """The store asks to slow down. Retried without a limit."""


class NoTable(LookupError):
    """Nothing was ever written under the path."""


class LostPointer(RuntimeError):
    """Versions were written under the path, but nothing says which one counts."""


class Store(Protocol):
    """An outside keyed store. write() returns the requests that weren't processed; close(), where there is one, comes last."""

    def write(self, batch: list) -> list: ...

    def update(self, row) -> None: ...


def backoff(attempt: int, jitter: Callable[[], float] = random.random) -> float:
    """Seconds to wait: twice as long each time up to a limit, and up to as much again."""
    delay = min(LONGEST_DELAY, BASE_DELAY * 2 ** min(attempt, 30))
    return delay + jitter() * delay


def batches(rows: Iterable, size: int) -> Iterator[list]:
    rows = iter(rows)
    while batch := list(islice(rows, size)):
        yield batch


def write_with_retries(send: Callable[[list], list], batch: list, sleep: Callable[[float], None] = time.sleep) -> None:
    """Sends a batch until the store has taken all of it. Throttling and leftovers are retried on and on, other errors five times."""
    slow = failed = 0
    while batch:
        try:
            batch = send(batch)
        except Throttled:
            pass
        except Exception:
            failed += 1
            if failed > RETRIES:
                raise
            sleep(backoff(failed - 1))
            continue
        if batch:
            sleep(backoff(slow))
            slow += 1


def write_to_store(operations: DataFrame, open_store: Callable[[], Store], batch_size: int = 25, writers: int | None = None) -> None:
    """Sends operations (key, op, seq ...) in order of `seq`, all of a key by one task; updates one by one, the rest in batches. A task that is retried sends its keys' operations again, in order."""
    dealt = operations.repartition(writers, "key") if writers else operations.repartition("key")

    def send(rows: Iterator) -> None:
        store = open_store()
        for batch in batches(rows, batch_size):
            plain: list = []
            for row in batch:
                if row.op == "UPDATE":
                    write_with_retries(store.write, plain)
                    plain = []
                    write_with_retries(lambda one: store.update(one[0]) or [], [row])
                else:
                    plain = [p for p in plain if p.key != row.key] + [row]  # of a key, a batch takes one
            write_with_retries(store.write, plain)
        if hasattr(store, "close"):
            store.close()

    dealt.sortWithinPartitions("seq").foreachPartition(send)


class FileStore:
    """A store of one JSON file a writer, under a folder that all executors share: key -> item. For tests and small tables."""

    def __init__(self, folder: str):
        self.path, self.items = f"{folder}/{uuid.uuid4().hex}.json", {}

    def write(self, batch: list) -> list:
        for row in batch:
            if row.op == "PUT":
                self.items[row.key] = dict(row.new_image)
            else:
                self.items.pop(row.key, None)
        return []

    def update(self, row) -> None:
        sets = {k: v for k, v in row.new_image.items() if k not in row.keys_of}
        removes = [k for k in row.old_image if k not in row.keys_of and k not in row.new_image]
        if sets or removes:
            item = self.items.setdefault(row.key, dict(row.keys_of))
            for k in removes:
                item.pop(k, None)
            item |= sets

    def close(self) -> None:
        with open(self.path, "w") as out:
            out.writelines(json.dumps({"key": k, "item": v}) + "\n" for k, v in self.items.items())


def file_system(spark: SparkSession, path: str) -> tuple:
    """Hadoop's file system of a path, and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder; none if there is no such folder."""
    fs, p = file_system(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    fs, p = file_system(spark, path)
    fs.delete(p, True)


def put_new(spark: SparkSession, path: str, content: bytes) -> None:
    """Writes a file that must not be there yet: under another name first, so readers see all of it or nothing."""
    fs, p = file_system(spark, path)
    hidden = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path.rpartition('/')[0]}/_{uuid.uuid4().hex}")
    out = fs.create(hidden, False)
    try:
        out.write(bytearray(content))
    finally:
        out.close()
    if fs.exists(p) or not fs.rename(hidden, p):
        fs.delete(hidden, False)
        raise FileExistsError(path)


def read_file(spark: SparkSession, path: str) -> str:
    fs, p = file_system(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def current_version(spark: SparkSession, path: str) -> tuple[int, str]:
    """(number of the newest pointer, the version that it names). NoTable if nothing was written, LostPointer if versions lack a pointer."""
    pointers = [n for n in list_names(spark, f"{path}/pointers") if POINTER.fullmatch(n)]
    if not pointers:
        versions = [n for n in list_names(spark, path) if VERSION.fullmatch(n)]
        if versions:
            raise LostPointer(f"{path} holds {len(versions)} versions but no pointer to one of them")
        raise NoTable(path)
    version = read_file(spark, f"{path}/pointers/{pointers[-1]}")
    _show(spark, path, version)
    return int(pointers[-1][2:]), version


def _show(spark: SparkSession, path: str, version: str) -> None:
    """Gives a version that a pointer names its own name. Whoever comes first does it: its writer, or a reader after the writer died."""
    fs, shown = file_system(spark, f"{path}/{version}")
    hidden = file_system(spark, f"{path}/_{version}")[1]
    if not fs.exists(shown) and fs.exists(hidden) and not fs.rename(hidden, shown) and not fs.exists(shown):
        raise OSError(f"{hidden} can't be renamed")


def swap_in(snapshot: DataFrame, path: str, keep: int | None = None) -> str:
    """Writes a snapshot as a new version under `path`, then a new pointer to it. Readers never see a half-written one, and no pointer is ever overwritten.

    keep: how many versions stay, the new one included; all if None. Of two
    writers at once, the second one fails.
    """
    spark = snapshot.sparkSession
    pointers = [n for n in list_names(spark, f"{path}/pointers") if POINTER.fullmatch(n)]
    number = int(pointers[-1][2:]) + 1 if pointers else 1
    version = f"v-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    snapshot.write.parquet(f"{path}/_{version}")  # whole before a pointer names it
    put_new(spark, f"{path}/pointers/p-{number:012d}", version.encode())
    _show(spark, path, version)
    if keep:
        for old in pointers[: max(0, len(pointers) + 1 - keep)]:
            delete(spark, f"{path}/{read_file(spark, f'{path}/pointers/{old}')}")
            delete(spark, f"{path}/pointers/{old}")
    return version


def read_current(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{current_version(spark, path)[1]}")


def read_current_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    """None only if nothing was ever written under the path; a lost pointer raises."""
    try:
        return read_current(spark, path)
    except NoTable:
        return None


__all__ = [
    "FileStore", "LostPointer", "NoTable", "Store", "Throttled", "backoff", "batches", "current_version", "delete", "file_system", "list_names", "put_new", "read_current", "read_current_or_none", "read_file", "swap_in", "write_to_store", "write_with_retries",
]
