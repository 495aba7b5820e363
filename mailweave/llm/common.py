"""Helpers shared by the operators: stage tables, bounded slices of Arrow batches."""

from __future__ import annotations

import ctypes
import os
import shutil
import tempfile
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from mailweave.session import stage_path

#: Bytes of text that one step of a Python task works on at a time. A longer
#: text is a step of its own.
SLICE_BYTES = 1 << 22

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Stage tables in a folder of the local file system have no checksum file beside each file. Without
#: its native library Hadoop starts a ``chmod`` for each of them, twice, and a small task writes a
#: small file; the process started shares the executor's memory for a moment and counts as much
#: again. Other file systems are not concerned.
_PLAIN_FILES = {
    "fs.file.impl": "org.apache.hadoop.fs.RawLocalFileSystem",
    "fs.file.impl.disable.cache": "true",
}


#: Bytes of an Arrow batch between the JVM and Python, unless the session sets its own: the
#: default number of rows would be tens of MB of text for each of a task's buffers.
BATCH_BYTES = 8 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"

_shipped: set[str] = set()


def ship(spark: SparkSession, batch_bytes: int = BATCH_BYTES) -> None:
    """Give the executors this package's code, as ``--py-files`` would, once per session, and
    bound the bytes of Arrow batches, unless they are."""
    context = spark.sparkContext
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(batch_bytes))
    if context.applicationId in _shipped:
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    folder = tempfile.mkdtemp(prefix="mailweave-code-")
    copy = os.path.join(folder, "copy", os.path.basename(package))
    shutil.copytree(package, copy, ignore=shutil.ignore_patterns("__pycache__"))
    archive = os.path.join(folder, os.path.basename(package))
    context.addPyFile(shutil.make_archive(archive, "zip", os.path.dirname(copy)))
    _shipped.add(context.applicationId)


_remembered: dict[str, Callable[[], object]] = {}


def claim(operator: str, forget: Callable[[], object]) -> None:
    """Called by a task of ``operator`` that remembers things in its Python worker, with the
    function that forgets them. Workers outlive stages, so what the operators of earlier
    stages remember is forgotten here."""
    for other in [name for name in _remembered if name != operator]:
        _remembered.pop(other)()
        release()
    _remembered[operator] = forget


def release() -> None:
    """Return this worker's free memory to the system, which else stays with the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of the shared folder; its shuffle files go at once.

    A table instead of a checkpoint drops the partitioning, so that a later
    join places both sides anew and adaptive execution can split hot keys.
    """
    spark = df.sparkSession
    path = stage_path(spark, label)
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**_PLAIN_FILES).parquet(path)
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def removed(*tables: DataFrame) -> None:
    """Delete tables of `written` that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        for folder in {file.rpartition("/")[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def by_slices(work, kind: pa.DataType, limit: int = 1 << 20):
    """An Arrow function of a struct of columns from ``work``, which gets a batch of bounded
    size (by its first column) and returns an array of ``kind``."""

    def run(*columns: pa.Array) -> pa.Array:
        batch = pa.RecordBatch.from_arrays(list(columns), names=[str(i) for i in range(len(columns))])
        parts = [work(part) for part in slices([batch], 0, limit)]
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    return run


def slices(
    batches: Iterable[pa.RecordBatch], column: int = 1, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Cut batches so that a variable-length column holds about ``limit`` bytes."""
    for batch in batches:
        values = batch.column(column)
        if pa.types.is_list(values.type):
            sizes = pc.multiply(pc.list_value_length(values), 4)
        else:
            sizes = pc.binary_length(values)
        ends = np.cumsum(pc.fill_null(sizes, 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < batch.num_rows:
            base = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, base + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
