"""Left join of many rows to one row per key, with hot keys split.

A key that holds more rows than an even partition would get is found by a
count (partial aggregates, so a hot key costs one row a task). There are fewer
such keys than partitions, whatever the data, so they are broadcast. Their rows
are dealt over as many salts as the key fills partitions, and only these keys'
rows of the other side are repeated, once a salt; all other keys have the one
salt 0. Rows with a null key are spread in the same way.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """(_hot, _salts): keys with more than 1/parts of all rows, and how many partitions they would fill."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = df.groupBy(F.col(key).alias("_hot")).agg(F.count(F.lit(1)).alias("_n"))
    total = counts.agg(F.sum("_n")).scalar()
    return counts.where(F.col("_n") * parts > total).select("_hot", F.ceil(F.col("_n") * parts / total).cast("int").alias("_salts"))


def split_left_join(many: DataFrame, one: DataFrame, key: str, row_key: str, parts: int | None = None) -> DataFrame:
    """``many.join(one, key, "left")`` where no key's rows all meet in one task; ``row_key`` deals a key's rows over its salts.

    ``one`` has at most one row per key and no null key.
    """
    hot = F.broadcast(hot_keys(many, key, parts))  # fewer rows than partitions

    def salted(df: DataFrame, salt) -> DataFrame:
        return df.join(hot, F.col(key).eqNullSafe(F.col("_hot")), "left").withColumn("_salt", salt).drop("_hot", "_salts")

    salts = F.coalesce("_salts", F.lit(1))
    left = salted(many, F.pmod(F.xxhash64(row_key), salts).cast("int"))
    right = salted(one, F.explode(F.sequence(F.lit(0), salts - 1)))
    return left.join(right, [key, "_salt"], "left").drop("_salt")
