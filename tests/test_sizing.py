"""Size-checked broadcast of derived lookup tables."""

from vitrina.functions import sizing


def _hinted(df) -> bool:
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_parse_bytes():
    assert sizing.parse_bytes("10485760b") == 10 * 1024 * 1024
    assert sizing.parse_bytes("10MB") == 10 * 1024 * 1024
    assert sizing.parse_bytes("-1") == -1


def test_table_size_counts_string_lengths(spark):
    df = spark.createDataFrame([("abc", 1), ("de", None), (None, 3)], "s string, i int")
    rows, size = sizing.table_size(df)
    # per row: overhead + 8 + len(s) + 4
    assert rows == 3
    assert size == 3 * (sizing.ROW_OVERHEAD_BYTES + 8 + 4) + 3 + 2


def test_broadcast_only_within_bounds(spark):
    assert _hinted(sizing.bounded_broadcast(spark.range(1000)))
    assert not _hinted(sizing.bounded_broadcast(spark.range(1000), max_bytes=1000))
    assert not _hinted(sizing.bounded_broadcast(spark.range(1000), max_rows=999))
