"""Shared helpers: reading tables, folds, staged tables and Arrow batches."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterable, Iterator
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


_shipped: set[str] = set()
#: (setting, its usual value, ours)
BATCHES = [("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "1000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "4194304b")]


def ship(spark: SparkSession) -> None:
    """Gives the executors this package, once an application, so that they need no copy of their own, and sees that Arrow
    batches are small, where the session has left that open: texts are long, and Python and the JVM hold several batches."""
    for name, usual, ours in BATCHES:
        if spark.conf.get(name, usual) == usual:
            spark.conf.set(name, ours)
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        _shipped.add(context.applicationId)
        top = Path(__file__).resolve().parent.parent
        path = Path(tempfile.mkdtemp()) / "orefold.zip"
        with zipfile.ZipFile(path, "w") as z:
            for f in sorted(top.rglob("*.py")):
                z.write(f, f.relative_to(top.parent))
        context.addPyFile(str(path))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(key: Column, folds: int = 5) -> Column:
    """crc32 of the key's text modulo ``folds``; a null key counts as empty text (fold 0)."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % folds


def shared_folder(spark: SparkSession) -> str:
    """This application's folder below ``spark.checkpoint.dir``, which all executors see; it can go when the application has ended.

    Only a session on one machine may leave that setting open; then it becomes a new temporary folder.
    """
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        where = tempfile.mkdtemp(prefix="orefold-")
        spark.conf.set("spark.checkpoint.dir", where)
    return f"{where.rstrip('/')}/{spark.sparkContext.applicationId}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    It cuts the lineage, is computed once however often it is read, and outlives any executor.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], column: str, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Cut batches so that one slice's texts stay near ``limit`` bytes (one longer text is a slice of its own)."""
    for batch in batches:
        col = batch.column(column)
        start, size = 0, 0
        lengths = pc.binary_length(col.cast(pa.large_binary()))
        for i, n in enumerate(lengths.to_pylist()):
            n = n or 0
            if size and size + n > limit:
                yield batch.slice(start, i - start)
                start, size = i, 0
            size += n
        if start < batch.num_rows:
            yield batch.slice(start)
    trim()


def trim() -> None:
    """Gives freed memory back to the machine; Python workers live on after a task."""
    gc.collect()
    with contextlib.suppress(OSError, AttributeError):  # where the C library has no such call
        ctypes.CDLL(None).malloc_trim(0)


def as_bytes(col: pa.Array) -> list[bytes | None]:
    return col.cast(pa.large_binary()).to_pylist()
