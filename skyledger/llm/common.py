"""What the operators of this subpackage share: tables, files on shared storage, text slices."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

SLICE_CHARS = 1 << 20
BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> None:
    """Makes this package importable in the tasks of the session, wherever the driver was started.

    Rows go to the tasks in batches of BATCH_BYTES, unless the session has a setting of its own: batches by
    number of rows alone grow with the texts, outside the heap.
    """
    if BATCH_SETTING not in spark.conf.getAll:
        spark.conf.set(BATCH_SETTING, BATCH_BYTES)
    context = spark.sparkContext
    if getattr(context, "_skyledger_shipped", False):
        return
    root = Path(__file__).resolve().parents[2]
    archive = Path(tempfile.mkdtemp(prefix="skyledger-")) / "skyledger.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for file in sorted((root / "skyledger").rglob("*.py")):
            z.write(file, str(file.relative_to(root)))
    context.addPyFile(str(archive))
    context._skyledger_shipped = True


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def open_output(path: str):
    """A binary stream to a new file on a local path or a file system pyarrow knows."""
    from pyarrow import fs

    if "://" in path or path.startswith("file:"):
        path = re.sub("^file:/*", "file:///", re.sub("^s3[an]://", "s3://", path))
        system, inner = fs.FileSystem.from_uri(path)
    else:
        system, inner = fs.LocalFileSystem(), path
    system.create_dir(inner.rpartition("/")[0], recursive=True)
    return system.open_output_stream(inner)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", binary: bool = False, chars: int = SLICE_CHARS) -> Iterator[tuple[pa.RecordBatch, list]]:
    """(rows, their texts) in slices of about `chars` bytes of text; null texts come as empty.

    A slice holds one text at least, so memory follows the longest text and not the batch. `binary`
    gives UTF-8 bytes.
    """
    none = b"" if binary else ""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        sizes = [x or 0 for x in pa.compute.binary_length(column).to_pylist()]
        if binary:
            column = column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())
        at = 0
        while at < len(sizes):
            end, total = at + 1, sizes[at]
            while end < len(sizes) and total + sizes[end] <= chars:
                total += sizes[end]
                end += 1
            yield batch.slice(at, end - at), [x or none for x in column.slice(at, end - at).to_pylist()]
            at = end
    _rest()


def _rest() -> None:
    """Gives a task's memory back: the worker lives on, and what it has loaded hangs together in circles."""
    gc.enable()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
    if trim:
        trim(0)


def with_columns(batch: pa.RecordBatch, columns: dict[str, pa.Array]) -> pa.RecordBatch:
    """`batch` and the new columns behind its own."""
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def extended(documents: DataFrame, columns: str) -> StructType:
    """The schema of `documents` and of the columns in DDL behind it."""
    return StructType([*documents.schema.fields, *StructType.fromDDL(columns).fields])
