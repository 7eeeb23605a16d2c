"""Python functions over Arrow batches, and the code they need on the workers."""

from __future__ import annotations

import ctypes
import io
import os
import sys
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

import wattledger
from wattledger.session import new_folder

ARCHIVE = "wattledger-code.zip"
BATCH_ROWS = 1000


def map_batches(
    rows: DataFrame,
    function: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
    schema: str | StructType,
) -> DataFrame:
    """rows.mapInArrow, with this package within reach of every worker. The function is given
    at most BATCH_ROWS rows at a time, and what it needed goes back to the system at its end:
    a worker lives on for the tasks of other stages. What other operators keep in it from task
    to task (an encoder and its matches) is forgotten first."""
    share_package(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(function.__module__)
        yield from function(_small(batches))
        give_back()

    return rows.mapInArrow(run, schema)


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, BATCH_ROWS):
            yield batch.slice(start, BATCH_ROWS)


def forget_others(module: str) -> None:
    """Empties the cached functions of the package's other modules."""
    package = __name__.rpartition(".")[0]
    for name, loaded in list(sys.modules.items()):
        if name.startswith(f"{package}.") and name != module:
            for value in list(vars(loaded).values()):
                if getattr(value, "__module__", None) == name and hasattr(value, "cache_clear"):
                    value.cache_clear()


def give_back() -> None:
    """Freed memory that Arrow's and the C library's allocators keep, to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def share_package(spark: SparkSession) -> None:
    """Sends the package's modules to the workers by way of the shared folder, once a context,
    unless their path has them already."""
    root = Path(wattledger.__file__).resolve().parent.parent
    context = spark.sparkContext
    if str(root) in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        return
    if any(name.endswith(ARCHIVE) for name in context._python_includes):
        return
    code = io.BytesIO()
    with zipfile.ZipFile(code, "w") as archive:
        for path in sorted(root.glob("wattledger/**/*.py")):
            archive.write(path, path.relative_to(root))
    target = f"{new_folder(spark, 'code')}/{ARCHIVE}"
    path = spark._jvm.org.apache.hadoop.fs.Path(target)
    out = path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path)
    out.write(code.getvalue())
    out.close()
    context.addPyFile(target)
