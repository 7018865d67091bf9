"""What a run shows while it goes on, and how it is stopped."""

from __future__ import annotations

import os
import signal
import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import SparkSession

EVERY = 5.0
# Spark's local properties of a job group.
JOB_GROUP = ("spark.jobGroup.id", "spark.job.description", "spark.job.interruptOnCancel")


@dataclass
class Totals:
    """What is done so far; the run adds to it."""

    items: int = 0
    batches: int = 0


def active_tasks(spark: SparkSession) -> int:
    """Tasks that are running now, over all active stages. Spark's count lags behind: a stage that has just begun counts with the tasks that its executors can take."""
    sc = spark.sparkContext
    tracker = sc.statusTracker()
    stages = [tracker.getStageInfo(k) for k in tracker.getActiveStageIds()]
    return sum(max(s.numActiveTasks, min(s.numTasks - s.numCompletedTasks, sc.defaultParallelism)) for s in stages if s)


def progress_line(totals: Totals, active: int) -> str:
    return f"Progress: {totals.items} items decoded in {totals.batches} batches ({active} active tasks)"


@contextmanager
def shown_progress(spark: SparkSession, totals: Totals, say: Callable[[str], None], every: float = EVERY) -> Iterator[None]:
    """Says a line every few seconds until the block ends."""
    over = threading.Event()

    def run() -> None:
        while not over.wait(every):
            say(progress_line(totals, active_tasks(spark)))

    thread = threading.Thread(target=run, daemon=True)
    thread.start()
    try:
        yield
    finally:
        over.set()
        thread.join()


class Cancelled(RuntimeError):
    pass


@contextmanager
def stoppable(spark: SparkSession, timeout: float, end: Callable[[int], None] = os._exit) -> Iterator[Callable[[], None]]:
    """Interrupts and termination cancel the block's Spark jobs, which then raises Cancelled. What hasn't stopped after `timeout` seconds is ended.

    Gives a function that does the same from within the process. Nothing that
    was swapped in or entered into the ledger is undone; the next run goes on.
    """
    group, stopped, timers = f"restore-{uuid.uuid4().hex}", threading.Event(), []
    sc = spark.sparkContext
    own = {k: sc.getLocalProperty(k) for k in JOB_GROUP}  # the caller's
    sc.setJobGroup(group, "restore", interruptOnCancel=True)

    def stop(*_: object) -> None:
        if stopped.is_set():
            return
        stopped.set()
        timers.append(threading.Timer(timeout, end, (130,)))
        timers[0].daemon = True
        timers[0].start()
        threading.Thread(target=cancel, daemon=True).start()  # a handler must not call into the JVM that it interrupts

    def cancel() -> None:
        while timers and timers[0].is_alive():  # jobs that begin later are cancelled too
            sc.cancelJobGroup(group)
            time.sleep(0.2)

    main = threading.current_thread() is threading.main_thread()
    before = {s: signal.signal(s, stop) for s in (signal.SIGINT, signal.SIGTERM)} if main else {}
    try:
        yield stop
    except Exception as e:
        if stopped.is_set():
            raise Cancelled("stopped on request") from e
        raise
    finally:
        for t in timers:
            t.cancel()
        for s, handler in before.items():
            signal.signal(s, handler)
        for k, v in own.items():
            sc.setLocalProperty(k, v)


def tried(work: Callable[[], object], tries: int, on_error: Callable[[Exception], None], sleep: Callable[[float], None] = time.sleep) -> object:
    """work()'s result; after an error it is tried again, two seconds later, then four."""
    for k in range(1, tries + 1):
        try:
            return work()
        except Exception as e:
            on_error(e)
            if k == tries:
                raise
            sleep(2.0 * k)
    raise AssertionError
