"""Customer 360: one row per customer (profile + purchase + visit features).

Both feature sets come out of an aggregate hash-partitioned on ``id_cliente``;
the two left joins therefore reuse that partitioning (sort-merge join without
a re-shuffle of the feature sides). Each side holds one row per customer, so a
customer with many purchases or visits adds no skew to the joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from .cleaning import CLEAN_COLUMNS
from .features import TX_FEATURES, VISIT_FEATURES, build_tx_features, build_visit_features

C360_COLUMNS = CLEAN_COLUMNS + TX_FEATURES + VISIT_FEATURES


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns of a numeric type (the ``select_dtypes(number)`` of pandas)."""
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NumericType)]


def fill_numeric(df: DataFrame, value=0) -> DataFrame:
    """Numeric nulls -> 0; string columns keep their nulls."""
    return df.fillna(value, subset=numeric_columns(df))


def build_customer_360(clientes_clean: DataFrame, tx: DataFrame, visits: DataFrame) -> DataFrame:
    txf = build_tx_features(tx)
    vf = build_visit_features(visits)
    c360 = (clientes_clean.join(txf, "id_cliente", "left")
                          .join(vf, "id_cliente", "left"))
    return fill_numeric(c360.select(*C360_COLUMNS))


def dedupe_by_key(df: DataFrame, key: str = "id_cliente") -> DataFrame:
    """Keep one row per key: the smallest by the other columns in order.

    The choice is explicit, so a repeated task keeps the same row. It is an
    aggregate with a partial stage, so a duplicated hot key does not gather
    all its copies in one task.
    """
    others = [c for c in df.columns if c != key]
    kept = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*others)).alias("_row"))
    return kept.select(*[F.col(key) if c == key else F.col("_row")[c].alias(c) for c in df.columns])
