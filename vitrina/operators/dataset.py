"""Training table: one row per store visit, 20 features and the target.

The visits are joined to the (deduplicated) Customer 360 on ``id_cliente``; a
customer with a large share of the visits is split (``functions.skew``). The
encoder's dictionary is fitted on the columns it codes, before the join, so the
wide joined rows are never written: store and reason come from the visits, and
the zone of a visit is the zone of its customer.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import payday_flag, weekday0
from ..functions.skew import split_left_join
from .customer360 import dedupe_by_key
from .encoding import CAT_COLS, apply_dictionary, fit_dictionary

FEATURE_COLS = [
    "zona_geografica", "antiguedad_meses", "score_credito_interno",
    "tiene_celular_valido", "tiene_email_valido",
    "recency_dias", "frequency", "monetary_total", "monetary_avg",
    "diversidad_categorias", "total_visitas", "tasa_conversion_hist",
    "visitas_servicio_tecnico", "visitas_cotizacion", "visitas_reclamo",
    "motivo_visita", "id_tienda", "dia_semana", "mes", "es_quincena",
]
TARGET = "compro_en_visita"
KEY = "id_interaccion"

# The 16 customer columns brought onto each visit.
C360_MERGE_COLS = [
    "id_cliente", "antiguedad_meses", "score_credito_interno",
    "tiene_celular_valido", "tiene_email_valido", "recency_dias",
    "frequency", "monetary_total", "monetary_avg", "diversidad_categorias",
    "total_visitas", "tasa_conversion_hist", "visitas_servicio_tecnico",
    "visitas_cotizacion", "visitas_reclamo", "zona_geografica",
]


def date_parts(df: DataFrame, ts_col: str = "fecha_visita") -> DataFrame:
    return (df.withColumn("dia_semana", weekday0(ts_col))
              .withColumn("mes", F.month(ts_col))
              .withColumn("es_quincena", payday_flag(ts_col)))


def visit_join(visits: DataFrame, c360: DataFrame) -> DataFrame:
    """Visits LEFT JOIN Customer 360 (one row per visit)."""
    v = visits.select(KEY, "id_cliente", "id_tienda", "fecha_visita", "motivo_visita", TARGET)
    return split_left_join(v, dedupe_by_key(c360.select(*C360_MERGE_COLS)), "id_cliente", KEY)


def visit_dictionary(visits: DataFrame, c360: DataFrame) -> DataFrame:
    """The encoder's dictionary of the joined visits, from narrow columns: the customers that visited and the visits."""
    seen = visits.select("id_cliente").where(F.col("id_cliente").isNotNull()).distinct()
    # the same customer row that the visit join takes
    zones = dedupe_by_key(c360.select(*C360_MERGE_COLS)).select("id_cliente", "zona_geografica").join(seen, "id_cliente", "left_semi")
    return fit_dictionary(visits, ["motivo_visita", "id_tienda"], [(zones, "zona_geografica")])


def build_visit_dataset(visits: DataFrame, c360: DataFrame,
                        dictionary: DataFrame | None = None,
                        extra_cols: tuple[str, ...] = ()) -> tuple[DataFrame, DataFrame]:
    """Return (training table, fitted dictionary).

    ``extra_cols`` keeps more visit columns (e.g. ``fecha_visita`` to order
    the drift split) next to the key.
    """
    joined = date_parts(visit_join(visits, c360))
    if dictionary is None:
        dictionary = visit_dictionary(visits, c360)
    coded = apply_dictionary(joined, dictionary, CAT_COLS)
    table = coded.select(KEY, *extra_cols, *FEATURE_COLS, TARGET).fillna(0, subset=FEATURE_COLS)
    return table, dictionary


def target_rate(table: DataFrame) -> DataFrame:
    return table.agg(F.avg(TARGET).alias("target_rate"), F.count(F.lit(1)).alias("n_obs"))
