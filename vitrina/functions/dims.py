"""Small, fixed dimension tables (lookup maps) as DataFrames.

They have a proven size bound (a handful of rows each, defined here), so
joining them with ``broadcast`` never ships data that grows with the input.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (results depend on them; kept in their natural order).
# ---------------------------------------------------------------------------

# Product categories and the next category to offer.
CATEGORY_TRANSITIONS = [
    ("refrigeracion", "lavado"),
    ("lavado", "coccion"),
    ("coccion", "pequenos_electrodomesticos"),
    ("pequenos_electrodomesticos", "refrigeracion"),
]
DEFAULT_NEXT_CATEGORY = "refrigeracion"

# Segment id -> segment name; other ids are named "Segmento {id}".
SEGMENT_NAMES = [
    (0, "VIP Comprador"),
    (1, "Cliente Financiado"),
    (2, "Visitante Servicios"),
    (3, "Cliente Dormido"),
    (4, "Nuevo Potencial"),
]

# Segment name -> action text; "{cat}" is the next category.
ACTION_TEMPLATES = [
    ("VIP Comprador", "Ofrecer {cat} premium con garantia extendida"),
    ("Cliente Financiado", "Mostrar {cat} con financiacion a 24 cuotas"),
    ("Visitante Servicios", "Ofrecer descuento en {cat} por fidelidad"),
    ("Cliente Dormido", "Promocion especial de reactivacion en {cat}"),
    ("Nuevo Potencial", "Presentar catalogo completo de {cat}"),
]
DEFAULT_ACTION = "Recomendar {cat}"
LOW_PRIORITY_SUFFIX = " - prioridad baja, no presionar"

# Visit reason code -> label shown to the advisor (default: the code).
VISIT_REASON_LABELS = [
    ("cotizacion", "Cotizacion de producto"),
    ("pago_cuota_credito", "Pago de cuota de credito"),
    ("servicio_tecnico", "Servicio tecnico"),
    ("reclamo", "Reclamo o postventa"),
]

# Level -> (title, subtitle) of the opportunity card; any other level takes
# the BAJO pair.
OPPORTUNITY_MESSAGES = [
    ("ALTO", "Oportunidad de venta hoy",
     "Cliente listo para cerrar. Ejecuta la accion recomendada con confianza."),
    ("MEDIO", "Oportunidad con acompanamiento",
     "Cliente interesado. Escucha primero y adapta la propuesta."),
    ("BAJO", "Prioridad en atencion",
     "Enfocate en atender su solicitud. Registra la visita para futuras oportunidades."),
]

# Segment name -> (reading, strategy) for the advisor card. A
# brand word after "credito" in the second reading is left out. Unknown
# segments take the default pair.
SEGMENT_PLAYBOOK = [
    ("VIP Comprador", "Cliente de alto valor. Historial de compras premium, sensibilidad a precio baja.",
     "Ofrecer gama alta y experiencias exclusivas. No competir por precio."),
    ("Cliente Financiado", "Cliente que compra con credito. Responde bien a planes de cuotas.",
     "Destacar cuota mensual, no precio total. Explicar beneficios del credito."),
    ("Visitante Servicios", "Cliente activo con equipos en uso. Momento clave para recompra o upgrade.",
     "Preguntar por el equipo actual. Proponer renovacion o complemento."),
    ("Cliente Dormido", "Sin compras recientes. Necesita un motivo para volver.",
     "Aplicar incentivo o promocion vigente. Preguntar por su ultima compra."),
    ("Nuevo Potencial", "Cliente en construccion. Poco historial disponible.",
     "Escuchar antes de vender. Conocer su necesidad real primero."),
]
DEFAULT_PLAYBOOK = ("Perfil comercial asignado.", "Escucha y adapta la propuesta.")


def _df(spark: SparkSession, rows, schema: str) -> DataFrame:
    return spark.createDataFrame(rows, schema)


def category_transitions(spark: SparkSession) -> DataFrame:
    return _df(spark, CATEGORY_TRANSITIONS, "categoria string, next_best_category string")


def segment_names(spark: SparkSession) -> DataFrame:
    return _df(spark, SEGMENT_NAMES, "segmento_id int, segmento_nombre string")


def action_templates(spark: SparkSession) -> DataFrame:
    return _df(spark, ACTION_TEMPLATES, "segmento string, plantilla string")


def visit_reason_labels(spark: SparkSession) -> DataFrame:
    return _df(spark, VISIT_REASON_LABELS, "motivo_visita string, motivo_label string")


def opportunity_messages(spark: SparkSession) -> DataFrame:
    return _df(spark, OPPORTUNITY_MESSAGES, "nivel string, opp_title string, opp_subtitle string")


def segment_playbook(spark: SparkSession) -> DataFrame:
    return _df(spark, SEGMENT_PLAYBOOK, "segmento string, lectura string, estrategia string")


def segment_name_default(seg_id: Column) -> Column:
    return F.concat(F.lit("Segmento "), seg_id.cast("string"))


def values_sql(rows, columns) -> str:
    """The same rows as an SQL ``VALUES`` list (for the DuckDB oracles)."""
    def lit(v):
        if isinstance(v, str):
            return "'" + v.replace("'", "''") + "'"
        return str(v)
    body = ", ".join("(" + ", ".join(lit(v) for v in row) + ")" for row in rows)
    return f"(VALUES {body}) AS t({', '.join(columns)})"
