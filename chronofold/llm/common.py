"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

import ctypes
import gc
import tempfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from py4j.java_gateway import JavaObject
from py4j.protocol import Py4JError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The session's `spark.checkpoint.dir`, which all executors share. Only where it is unset and all runs on one machine (tests) a temporary one is made."""
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder and sc.master.partition("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="checkpoint-"))
    return sc.getCheckpointDir()


def durable(df: DataFrame) -> DataFrame:
    """The rows written once into the shared folder, with no lineage left to recompute."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(*frames: DataFrame) -> None:
    """Deletes the files of durable() tables that nothing reads any more."""
    for df in frames:
        plan = df._jdf.queryExecution().analyzed()
        if plan.nodeName() != "LogicalRDD":
            continue  # not one of them
        path = plan.rdd().getCheckpointFile()
        if path.isDefined():
            drop_folder(df.sparkSession, path.get())


def drop_folder(spark: SparkSession, path: str) -> None:
    """Deletes a folder in whatever store it is."""
    sc = spark.sparkContext
    folder = sc._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(sc._jsc.hadoopConfiguration()).delete(folder, True)


def fold(id_column: str, folds: int) -> Column:
    """crc32 of the id's decimal text, modulo `folds`; null for a null id."""
    return F.crc32(F.col(id_column).cast("string").cast("binary")) % F.lit(folds)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


#: Rows of an Arrow batch, where the session sets none: Spark's own 10,000 whole texts take much memory on both sides.
ARROW_ROWS = 2000
ARROW_ROWS_KEY = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """The table, with its session set to small Arrow batches unless it has a number of its own."""
    conf = df.sparkSession.conf
    if conf.get(ARROW_ROWS_KEY, None) is None:
        conf.set(ARROW_ROWS_KEY, str(ARROW_ROWS))
    return df


def squeezed(*arrays: np.ndarray) -> bytes:
    """Arrays in one blob, compressed byte plane by byte plane: high bytes are mostly zero."""
    out = []
    for x in arrays:
        planes = np.ascontiguousarray(x).view(np.uint8).reshape(len(x), x.dtype.itemsize).T.tobytes()
        blob = pa.compress(planes, codec="zstd", asbytes=True)
        out += [np.array([len(planes), len(blob)], dtype=np.int64).tobytes(), x.dtype.str.encode().ljust(8), blob]
    return b"".join(out)


def opened(blob: bytes) -> list[np.ndarray]:
    """The arrays of squeezed()."""
    out, at = [], 0
    while at < len(blob):
        size, packed = np.frombuffer(blob, dtype=np.int64, count=2, offset=at).tolist()
        kind = np.dtype(blob[at + 16 : at + 24].decode().strip())
        at += 24 + packed
        planes = np.frombuffer(pa.decompress(blob[at - packed : at], size, codec="zstd", asbytes=True), dtype=np.uint8)
        out.append(np.ascontiguousarray(planes.reshape(kind.itemsize, -1).T).view(kind).reshape(-1))
    return out


def sealed(batch: pa.RecordBatch) -> bytes:
    """A batch in one blob, compressed."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unsealed(blob: bytes) -> pa.RecordBatch:
    """The batch of sealed()."""
    return pa.ipc.open_stream(blob).read_next_batch()


def steps(keys: np.ndarray) -> np.ndarray:
    """Sorted keys as differences, which compress well; np.cumsum() undoes it."""
    return np.diff(keys, prepend=keys.dtype.type(0))


Work = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def give_back() -> None:
    """Returns the free memory of Arrow's and C's allocators to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc
        pass


#: Per cent of the driver's heap that a full collection leaves free, at least and at most. The JVM's own bounds (40 and 70) let it hold three times what lives.
HEAP_FREE = {"MinHeapFreeRatio": "10", "MaxHeapFreeRatio": "30"}


def shrink_jvm(spark: SparkSession) -> None:
    """Collects the driver's JVM and returns what it then has free to the system: heap beyond HEAP_FREE, and C's free memory, of which the compilers and codecs leave much."""
    jvm = spark.sparkContext._jvm

    def array(kind: str, *items: object) -> JavaObject:
        out = jvm.java.lang.reflect.Array.newInstance(jvm.java.lang.Class.forName(kind), len(items))
        for i, x in enumerate(items):
            jvm.java.lang.reflect.Array.set(out, i, x)
        return out

    def manage(bean: str, operation: str, kinds: list[str], values: list[object]) -> None:
        name = jvm.javax.management.ObjectName(f"com.sun.management:type={bean}")
        call = [name, operation, array("java.lang.Object", *values), array("java.lang.String", *kinds)]
        by_interface.invoke(server, array("java.lang.Object", *call))  # the server's own class isn't open to py4j

    try:
        server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
        by_interface = next(m for m in jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods() if m.getName() == "invoke")
        for option in HEAP_FREE.items():
            manage("HotSpotDiagnostic", "setVMOption", ["java.lang.String"] * 2, list(option))
        jvm.System.gc()
        manage("DiagnosticCommand", "systemTrimNativeHeap", [], [])
    except Py4JError:  # another JVM, or an older one
        jvm.System.gc()


def release(spark: SparkSession) -> None:
    """Lets go of what finished steps have left: memory here, and shuffle files, which Spark deletes once the driver has collected the plans that made them."""
    gc.collect()
    shrink_jvm(spark)
    give_back()


def frugal(work: Work) -> Work:
    """A function for mapInArrow() whose tasks give back their memory. Workers are used again: what one step keeps, the next one lacks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
