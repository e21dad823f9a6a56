"""Broadcast a derived lookup table only behind a proven size bound.

Catalyst cannot estimate the size of a table derived from big inputs (an
encoder dictionary, the zone medians), so it plans a shuffle join and moves
the big side through the network to meet a few rows. Here the small table is
checkpointed (written once to ``spark.checkpoint.dir``, so the measurement
and the join read the same rows and an executor loss does not recompute it;
skipped for tables already derived from checkpointed rows) and measured in
one job: its row count and its bytes (fixed-width columns by
their width, strings and binaries by their actual length). It is broadcast
only when both are within the bounds; beyond them the join stays a regular
(shuffle) join.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (BinaryType, BooleanType, ByteType, DataType, DateType, DecimalType,
                               DoubleType, FloatType, IntegerType, LongType, ShortType, StringType,
                               TimestampNTZType, TimestampType)

from ..session import ensure_checkpoint_dir

# Fixed bound on rows of a broadcast lookup table.
MAX_BROADCAST_ROWS = 1_000_000
# Byte bound used when the session sets no positive autoBroadcastJoinThreshold.
DEFAULT_MAX_BYTES = 10 * 1024 * 1024
# Per-row overhead of an UnsafeRow in a broadcast hash relation (header + key).
ROW_OVERHEAD_BYTES = 16


_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    """'10485760b', '10MB', '-1' -> bytes (Spark's byte-size notation)."""
    m = re.fullmatch(r"(-?\d+)\s*([a-z]*)", str(text).strip().lower())
    if not m or m.group(2) not in _UNITS:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2)]


def broadcast_byte_limit(spark) -> int:
    """The session's broadcast threshold in bytes (the default when unset/off)."""
    try:
        value = parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", str(DEFAULT_MAX_BYTES)))
    except ValueError:
        value = DEFAULT_MAX_BYTES
    return value if value > 0 else DEFAULT_MAX_BYTES


def _field_bytes(name: str, dt: DataType) -> Column:
    if isinstance(dt, (StringType, BinaryType)):
        return F.coalesce(F.octet_length(F.col(name)), F.lit(0)).cast("long") + 8
    if isinstance(dt, (ByteType, BooleanType)):
        return F.lit(1).cast("long")
    if isinstance(dt, ShortType):
        return F.lit(2).cast("long")
    if isinstance(dt, (IntegerType, FloatType, DateType)):
        return F.lit(4).cast("long")
    if isinstance(dt, DecimalType):
        return F.lit(8 if dt.precision <= 18 else 16).cast("long")
    if isinstance(dt, (LongType, DoubleType, TimestampType, TimestampNTZType)):
        return F.lit(8).cast("long")
    # nested values: their JSON text is an upper bound of the binary form
    return F.coalesce(F.octet_length(F.to_json(F.col(name))), F.lit(0)).cast("long") + 8


def _row_bytes(df: DataFrame) -> Column:
    """Bytes of one row: declared width for fixed-size types, length for strings."""
    total = F.lit(ROW_OVERHEAD_BYTES).cast("long")
    for f in df.schema.fields:
        total = total + _field_bytes(f.name, f.dataType)
    return total


def table_size(df: DataFrame) -> tuple[int, int]:
    """(rows, bytes) of ``df`` in one aggregation job."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS,
                      max_bytes: int | None = None, checkpoint: bool = True) -> DataFrame:
    """``df`` marked for broadcast if it is measured within the bounds, else as is.

    ``checkpoint=False`` is for small tables derived from already
    checkpointed rows by deterministic steps: measuring and joining them
    recompute the same rows cheaply, so no extra write is needed.
    """
    spark = df.sparkSession
    if checkpoint:
        ensure_checkpoint_dir(spark)
        fixed = df.checkpoint(eager=True)
    else:
        fixed = df
    rows, size = table_size(fixed)
    limit = broadcast_byte_limit(spark) if max_bytes is None else max_bytes
    return F.broadcast(fixed) if rows <= max_rows and size <= limit else fixed
