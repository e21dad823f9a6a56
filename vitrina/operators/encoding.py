"""Ordinal encoder as a dictionary table (column, value, code).

Fit: sorted distinct non-null values per column, 0-based codes. The distinct
step is an aggregate (partial per partition), so only distinct values are
shuffled; the codes are row numbers per column from the range-partitioned
helper of ``ranking``, so no column's values meet in one task.
Apply: one left join per column against its dictionary; a null value gets 0
(the reference's NaN code turned into 0 by ``fillna``) and an unseen value -1.
The dictionary is small but data-dependent, so it is broadcast only after its
rows and bytes have been measured (``bounded_broadcast``); the visit side then
keeps its partitioning instead of being shuffled once per coded column.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.sizing import bounded_broadcast
from .ranking import global_row_number

CAT_COLS = ["zona_geografica", "motivo_visita", "id_tienda"]
UNSEEN_CODE = -1
NULL_CODE = 0


def fit_dictionary(df: DataFrame, columns: list[str] = CAT_COLS,
                   others: list[tuple[DataFrame, str]] | None = None) -> DataFrame:
    """Rows (columna, valor, codigo) with values sorted as strings.

    ``others`` are columns of other tables that go into the same dictionary.
    """
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")) for c in columns
    ])).alias("p")).select("p.columna", "p.valor")
    for table, c in others or []:
        pairs = pairs.unionByName(table.select(F.lit(c).alias("columna"), F.col(c).cast("string").alias("valor")))
    distinct = pairs.where(F.col("valor").isNotNull()).distinct()
    # codes = rank within the column; the range-partitioned helper keeps a
    # column with very many distinct values out of a single window task
    ranked = global_row_number(distinct, ["valor"], alias="_rn", group_cols=["columna"])
    return ranked.select("columna", "valor", (F.col("_rn") - 1).cast("int").alias("codigo"))


def apply_dictionary(df: DataFrame, dictionary: DataFrame,
                     columns: list[str] = CAT_COLS, null_code: int = NULL_CODE,
                     sized: bool = False) -> DataFrame:
    """Replace each categorical column by its integer code.

    ``null_code`` is 0 when building the training table and -1 at serving
    time (a missing value there is just another unseen value). ``sized``
    says the dictionary already went through ``bounded_broadcast`` (a stream
    sizes it once, not once per micro-batch).
    """
    if not sized:
        # a fitted dictionary comes off the ranking helper's checkpoint, a
        # saved one from its parquet files: measured without another write
        dictionary = bounded_broadcast(dictionary, checkpoint=False)
    out = df
    for c in columns:
        d = (dictionary.where(F.col("columna") == c)
                       .select(F.col("valor").alias(f"_v_{c}"), F.col("codigo").alias(f"_c_{c}")))
        out = (out.join(d, out[c].cast("string") == d[f"_v_{c}"], "left")
                  .withColumn(c, F.when(F.col(c).isNull(), F.lit(null_code))
                                  .otherwise(F.coalesce(f"_c_{c}", F.lit(UNSEEN_CODE))).cast("int"))
                  .drop(f"_v_{c}", f"_c_{c}"))
    return out
