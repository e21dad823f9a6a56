"""Point-in-time features: what was known of a customer just before a visit.

The training table's visit and purchase histories are totals over all time, so
they hold the visit that is to be predicted and later ones. Here purchases and
visits of all customers form one timeline, ordered by customer, time, kind
(purchases before visits of the same moment) and key. Running totals over it
come from the range-partitioned prefix helper, so a customer with a large
share of the events is spread over many tasks, and no window holds a customer.
A visit's history is its running total less its own entry. The categories
bought so far are a running total too: each of a customer's categories counts
once, at its first purchase. The last purchase is a running maximum, and its
recency counts from the visit.

Visits without a customer have no history (zeros). Events without a time come
first; a last purchase without a time gives no recency (zero). The customer's
own columns (zone, score, age of the account, contact flags) have no dates in
the input and stay as they are.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import whole_days
from .dataset import KEY, TARGET
from .features import VISIT_REASON_COUNTS
from .ranking import prefix_sums

PURCHASE, VISIT = 0, 1
REASONS = [(name, reason) for name, reason in VISIT_REASON_COUNTS if name != "visitas_pago_cuota"]
COUNTS = ["total_visitas", "_compras_en_visita", *(name for name, _ in REASONS), "frequency", "_montos", "monetary_total", "diversidad_categorias"]
LAST = "_ultima_compra"
ASOF_COLS = ["total_visitas", "tasa_conversion_hist", *(name for name, _ in REASONS), "frequency", "monetary_total", "monetary_avg"]
#: All columns of the training table that are a customer's history.
HISTORY_COLS = [*ASOF_COLS, "recency_dias", "diversidad_categorias"]
WHOSE = ["id_cliente", "fecha_visita"]


def timeline(visits: DataFrame, tx: DataFrame) -> DataFrame:
    """One row per event of a known customer: id, time, kind, key and what it adds to each count."""
    zero = F.lit(0).cast("long")
    money = F.lit(0).cast("decimal(38,10)")
    never = F.lit(None).cast("timestamp_ntz")
    v = visits.where(F.col("id_cliente").isNotNull()).select(
        "id_cliente", F.col("fecha_visita").cast("timestamp_ntz").alias("ts"), F.lit(VISIT).alias("kind"), F.col(KEY).alias("event"),
        F.lit(1).cast("long").alias("total_visitas"), F.col(TARGET).cast("long").alias("_compras_en_visita"),
        *[F.coalesce((F.col("motivo_visita") == reason).cast("long"), zero).alias(name) for name, reason in REASONS],
        zero.alias("frequency"), zero.alias("_montos"), money.alias("monetary_total"), zero.alias("diversidad_categorias"), never.alias(LAST))
    amount = F.col("monto_pago").cast("decimal(38,10)")
    bought = tx.where(F.col("id_cliente").isNotNull()).withColumn("ts", F.col("fecha_compra").cast("timestamp_ntz"))
    no_visit = [zero.alias(name) for name in ("total_visitas", "_compras_en_visita", *(name for name, _ in REASONS))]
    p = bought.select(
        "id_cliente", "ts", F.lit(PURCHASE).alias("kind"), F.col("id_transaccion").alias("event"), *no_visit,
        F.col("id_transaccion").isNotNull().cast("long").alias("frequency"), amount.isNotNull().cast("long").alias("_montos"),
        F.coalesce(amount, money).alias("monetary_total"), zero.alias("diversidad_categorias"), F.col("ts").alias(LAST))
    # the moment of a category's first purchase (a purchase without a time comes first)
    firsts = bought.where(F.col("categoria_producto").isNotNull()).groupBy("id_cliente", "categoria_producto").agg(F.min(F.struct("ts"))["ts"].alias("ts"))
    c = firsts.select(
        "id_cliente", "ts", F.lit(PURCHASE).alias("kind"), F.lit(None).cast("string").alias("event"), *no_visit, zero.alias("frequency"),
        zero.alias("_montos"), money.alias("monetary_total"), F.lit(1).cast("long").alias("diversidad_categorias"), never.alias(LAST))
    return v.unionByName(p).unionByName(c)


def visit_histories(visits: DataFrame, tx: DataFrame) -> DataFrame:
    """Per visit, its customer and its time: the customer's history before it."""
    # purchases of one customer, moment and key are added up first, so that the order keys are unique
    events = timeline(visits, tx).groupBy("id_cliente", "ts", "kind", "event").agg(*[F.sum(c).alias(c) for c in COUNTS], F.max(LAST).alias(LAST))
    run = prefix_sums(events, ["ts", "kind", "event"], COUNTS, group_cols=["id_cliente"], max_cols=[LAST])
    before = run.where(F.col("kind") == VISIT).select(
        F.col("event").alias(KEY), "id_cliente", F.col("ts").alias("fecha_visita"), F.col(f"cum_{LAST}").alias(LAST), *[(F.col(f"cum_{c}") - F.col(c)).alias(c) for c in COUNTS])
    known = before.select(
        KEY, *WHOSE, "total_visitas", F.try_divide(F.col("_compras_en_visita").cast("double"), F.col("total_visitas")).alias("tasa_conversion_hist"),
        *[name for name, _ in REASONS], "frequency", F.col("monetary_total").cast("double").alias("monetary_total"),
        F.try_divide(F.col("monetary_total").cast("double"), F.col("_montos")).alias("monetary_avg"),
        whole_days(LAST, "fecha_visita").alias("recency_dias"), "diversidad_categorias")
    kinds = dict(known.dtypes)
    nobody = visits.where(F.col("id_cliente").isNull()).select(
        KEY, "id_cliente", F.col("fecha_visita").cast("timestamp_ntz").alias("fecha_visita"), *[F.lit(0).cast(kinds[c]).alias(c) for c in HISTORY_COLS])
    return known.fillna(0, subset=HISTORY_COLS).unionByName(nobody)


def visit_asof(visits: DataFrame, tx: DataFrame) -> DataFrame:
    """Per visit: counts, conversion rate and amounts of its customer before it."""
    return visit_histories(visits, tx).select(KEY, *ASOF_COLS)


def without_leak(table: DataFrame, before: DataFrame) -> DataFrame:
    """The training table with all its histories replaced by those before each visit.

    Both hold each visit's customer and time besides its key (``WHOSE``), so rows that share a key don't mix; these two are left out
    of the result.
    """
    # one row for equal visits of a customer; a visit without a customer finds none, and has no history
    known = before.where(F.col("id_cliente").isNotNull()).select(*[F.col(c).alias(f"_{c}") for c in (KEY, *WHOSE)], *HISTORY_COLS)
    same = [F.col("id_cliente") == F.col("_id_cliente"), F.col(KEY).eqNullSafe(F.col(f"_{KEY}")),
            F.col("fecha_visita").cast("timestamp_ntz").eqNullSafe(F.col("_fecha_visita"))]
    joined = table.drop(*HISTORY_COLS).join(known, same, "left").fillna(0, subset=HISTORY_COLS)
    return joined.select(*[c for c in table.columns if c not in WHOSE])
