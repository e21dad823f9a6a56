"""Per-customer features from purchases (RFM) and from store visits.

Purchases are aggregated in two levels. The first adds them up by (customer,
category, payment method) and counts these sums by (customer, kind, value),
once with the category and once with the payment method; all its aggregates
are plain hash aggregates with a partial stage, so a customer holding a third
of all rows costs no more shuffle than any other. The second has a few rows
per customer and picks the most frequent values. Its result, one row per customer, is written once: the reference date
(the last purchase of all) and the features both read it, so the purchases
themselves are read once. Visits take one aggregate; their reference date is a
scan of one column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import whole_days
from ..session import ensure_checkpoint_dir

CREDIT_METHOD = "credito_propio_retail"

TX_FEATURES = ["recency_dias", "frequency", "monetary_total", "monetary_avg", "ticket_max",
               "diversidad_categorias", "categoria_favorita", "medio_pago_habitual",
               "usa_credito_propio"]
VISIT_FEATURES = ["total_visitas", "tasa_conversion_hist", "visitas_servicio_tecnico",
                  "visitas_cotizacion", "visitas_reclamo", "visitas_pago_cuota",
                  "dias_desde_ultima_visita"]
# Visit reason counted by each conditional-count feature.
VISIT_REASON_COUNTS = [
    ("visitas_servicio_tecnico", "servicio_tecnico"),
    ("visitas_cotizacion", "cotizacion"),
    ("visitas_reclamo", "reclamo"),
    ("visitas_pago_cuota", "pago_cuota_credito"),
]


def _with_reference(agg: DataFrame, source: DataFrame, date_col: str, ref_col: str) -> DataFrame:
    # the table's max date as a scalar subquery (run once, inlined; no join)
    return agg.withColumn(ref_col, source.agg(F.max(date_col)).scalar())


def reference_date(df: DataFrame, date_col: str, alias: str = "fecha_ref") -> DataFrame:
    return df.agg(F.max(date_col).alias(alias))


CATEGORY, PAYMENT = 0, 1


def tx_values(tx: DataFrame) -> DataFrame:
    """First level: one row per (customer, kind, value); amounts and dates are summed under the category only.

    Purchases are added up by (customer, category, payment method), each once, and only these sums are repeated by
    kind. They are dealt by customer, so neither this grouping nor the next one shuffles again.
    """
    pairs = tx.groupBy("id_cliente", "categoria_producto", "medio_pago").agg(
        F.count(F.lit(1)).alias("n"), F.count("id_transaccion").alias("n_ids"), F.max("fecha_compra").alias("last"),
        F.sum(F.col("monto_pago").cast("decimal(38,10)")).alias("total"), F.count("monto_pago").alias("n_amounts"),
        F.max("monto_pago").alias("top")).repartition("id_cliente")
    values = F.explode(F.array(F.struct(F.lit(CATEGORY).alias("kind"), F.col("categoria_producto").alias("value")),
                               F.struct(F.lit(PAYMENT).alias("kind"), F.col("medio_pago").alias("value")))).alias("v")
    rows = pairs.select("id_cliente", "n", "n_ids", "last", "total", "n_amounts", "top", values)

    def once(col: str) -> Column:
        return F.when(F.col("v.kind") == CATEGORY, F.col(col))

    return rows.groupBy("id_cliente", F.col("v.kind").alias("kind"), F.col("v.value").alias("value")).agg(
        F.sum("n").alias("n"), F.sum(once("n_ids")).alias("n_ids"), F.max(once("last")).alias("last"),
        F.sum(once("total")).alias("total"), F.sum(once("n_amounts")).alias("n_amounts"), F.max(once("top")).alias("top"))


def tx_aggregates(tx: DataFrame) -> DataFrame:
    """The raw per-customer aggregate, null customer ids included."""
    def most_frequent(kind: int) -> Column:  # ties go to the smallest value
        counted = (F.col("kind") == kind) & F.col("value").isNotNull()
        return F.min_by("value", F.when(counted, F.struct(-F.col("n"), F.col("value"))))

    return tx_values(tx).groupBy("id_cliente").agg(
        F.max("last").alias("_ultima_compra"),
        F.sum("n_ids").alias("frequency"),
        F.sum("total").cast("double").alias("monetary_total"),
        F.sum("n_amounts").alias("_n_montos"),
        F.max("top").alias("ticket_max"),
        F.count_if((F.col("kind") == CATEGORY) & F.col("value").isNotNull()).alias("diversidad_categorias"),
        most_frequent(CATEGORY).alias("categoria_favorita"),
        most_frequent(PAYMENT).alias("medio_pago_habitual"),
        F.max(F.coalesce((F.col("kind") == PAYMENT) & (F.col("value") == CREDIT_METHOD), F.lit(False)).cast("int"))
         .alias("usa_credito_propio"),
    )


def build_tx_features(tx: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(tx.sparkSession)
    written = tx_aggregates(tx).checkpoint()
    agg = _with_reference(written, written, "_ultima_compra", "_fecha_ref")
    return (agg.where(F.col("id_cliente").isNotNull())
               .select(
                   "id_cliente",
                   whole_days("_ultima_compra", "_fecha_ref").alias("recency_dias"),
                   "frequency",
                   F.coalesce("monetary_total", F.lit(0.0)).alias("monetary_total"),
                   F.try_divide("monetary_total", "_n_montos").alias("monetary_avg"),
                   "ticket_max", "diversidad_categorias", "categoria_favorita",
                   "medio_pago_habitual", "usa_credito_propio"))


def visit_aggregates(visits: DataFrame) -> DataFrame:
    counts = [F.count_if(F.col("motivo_visita") == reason).alias(name)
              for name, reason in VISIT_REASON_COUNTS]
    return visits.groupBy("id_cliente").agg(
        F.count("id_interaccion").alias("total_visitas"),
        F.avg("compro_en_visita").alias("tasa_conversion_hist"),
        *counts,
        F.max("fecha_visita").alias("_ultima_visita"),
    )


def build_visit_features(visits: DataFrame) -> DataFrame:
    agg = _with_reference(visit_aggregates(visits), visits, "fecha_visita", "_fecha_ref")
    return (agg.where(F.col("id_cliente").isNotNull())
               .select("id_cliente", "total_visitas", "tasa_conversion_hist",
                       *[name for name, _ in VISIT_REASON_COUNTS],
                       whole_days("_ultima_visita", "_fecha_ref").alias("dias_desde_ultima_visita")))
