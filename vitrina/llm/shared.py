"""Helpers of the llm operators: shared folders, written tables, mapped array files.

Everything that must outlive an executor lies under ``spark.checkpoint.dir``.
Tables are written as Parquet and read again, which cuts the lineage. Array
files are written by tasks with a temporary name and renamed, so a repeated
task replaces its own file with equal content.
"""

from __future__ import annotations

import mmap
import os
import tempfile
import uuid
from contextlib import contextmanager
from urllib.parse import unquote, urlparse

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

from vitrina.session import ensure_checkpoint_dir


def new_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint directory."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if "://" not in base and not base.startswith("file:"):
        base = f"file://{base}" if base.startswith("/") else base
    return f"{base}/vitrina-llm/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, size: str = "8m"):
    """Send smaller Arrow batches to Python while a table is written, for tasks that hold several per row."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, size)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def remove_folder(spark: SparkSession, uri: str) -> None:
    """Delete a folder of the shared file system (its owner no longer needs it)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only (doc_id, text), null texts as empty; other columns can't clash with ours."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def keep_rows(docs: DataFrame, digest: Column, kept: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose doc_id and ``digest`` of the text are in ``kept`` (doc_id, digest).

    Of rows that share both, the smallest by their other plain columns in
    order stays. The rows travel as one struct, so no column name can clash;
    one key for join and duplicates: the texts are shuffled and sorted once.
    """
    def key(doc_id: Column, text: Column) -> Column:
        return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("none")), text).alias("key")

    own = docs.select(key(F.col("doc_id"), digest), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    order = [F.col("row").getField(f.name) for f in docs.schema if isinstance(f.dataType, AtomicType) and f.name not in ("doc_id", "text")]
    wanted = kept.select(key(F.col("doc_id"), F.col("digest")))
    one = own.join(wanted, "key", "left_semi").groupBy("key").agg(F.min_by("row", F.struct(F.lit(0), *order)).alias("row"))
    return one.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))


def _local(uri: str) -> str | None:
    p = urlparse(uri)
    return unquote(p.path) if p.scheme in ("file", "") else None


def put_bytes(uri: str, data: bytes) -> None:
    """Write one file of the shared folder from a task."""
    path = _local(uri)
    if path is not None:
        os.makedirs(os.path.dirname(path), exist_ok=True)
        tmp = f"{path}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as f:
            f.write(data)
        os.replace(tmp, path)
        return
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    tmp = f"{path}.{uuid.uuid4().hex}.tmp"
    with store.open_output_stream(tmp) as f:
        f.write(data)
    store.move(tmp, path)


def mapped(uri: str) -> memoryview:
    """The bytes of a shared file, memory-mapped by this worker.

    A file on a mounted folder is mapped in place: its pages are read on
    demand and shared by all workers of a machine. From another store the
    file is copied once to the worker's own temporary folder, mapped and
    unlinked, so nothing is left behind.
    """
    path = _local(uri)
    if path is not None:
        if os.path.getsize(path) == 0:
            return memoryview(b"")
        with open(path, "rb") as f:
            return memoryview(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(uri)
    with tempfile.TemporaryFile() as out, store.open_input_stream(path) as src:
        while chunk := src.read(1 << 24):
            out.write(chunk)
        out.flush()
        if out.tell() == 0:
            return memoryview(b"")
        return memoryview(mmap.mmap(out.fileno(), 0, access=mmap.ACCESS_READ))


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Several arrays as one blob: count, then dtype, length and 8-aligned bytes of each."""
    head = [np.array([len(arrays)], "<i8").tobytes()]
    body = []
    for a in arrays:
        raw = np.ascontiguousarray(a).tobytes()
        head.append(a.dtype.str.encode().ljust(8) + np.array([a.size], "<i8").tobytes())
        body.append(raw + b"\0" * (-len(raw) % 8))
    return b"".join(head + body)


def unpack_arrays(blob) -> list[np.ndarray]:
    """The arrays of ``pack_arrays``, as views of the blob."""
    view = memoryview(blob)
    n = int(np.frombuffer(view, "<i8", 1)[0])
    at, out = 8 + 16 * n, []
    for k in range(n):
        dtype = np.dtype(bytes(view[8 + 16 * k: 16 + 16 * k]).strip().decode())
        size = int(np.frombuffer(view, "<i8", 1, 16 + 16 * k)[0])
        out.append(np.frombuffer(view, dtype, size, at))
        at += -(-size * dtype.itemsize // 8) * 8
    return out
