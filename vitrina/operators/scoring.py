"""Next-best-action for sets of visits (batch or micro-batch).

The reference answers one request at a time; here a DataFrame of visits is
scored at once: visits LEFT JOIN the deduplicated Customer 360 (unknown
customers get an error text instead of an HTTP 404; a customer with a large
share of the visits is split, ``functions.skew``), the saved segmentation and
propensity models run as ``transform``s over all requests in one pass (the
answer of an unknown customer is blanked), and level, next category and action
text are built from column expressions and broadcast lookups of fixed, tiny
dimension tables. Date features come from the visit timestamp, not the
wall clock, and the store comes from the visit (unseen store -> -1).
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import dims
from ..functions.columns import level
from ..functions.skew import split_left_join
from . import lookups
from .customer360 import dedupe_by_key
from .dataset import FEATURE_COLS, date_parts
from .encoding import CAT_COLS, apply_dictionary
from .propensity import score as propensity_score
from .segmentation import assign_segments

REQUEST_COLS = ["id_interaccion", "id_cliente", "id_tienda", "fecha_visita", "motivo_visita"]
RECOMMENDATION_COLS = ["id_interaccion", "id_cliente", "motivo_visita", "segmento", "score_compra_hoy",
                       "nivel", "next_best_category", "categoria_favorita", "accion_recomendada", "error"]
SCORE_DIGITS = 3


def lookup(visits: DataFrame, c360: DataFrame, split_hot: bool = True) -> DataFrame:
    """Each request with its customer profile; ``error`` when the id is unknown.

    ``split_hot=False`` is for the small micro-batches of a stream, which join
    a profile table that is bucketed on the customer.
    """
    prof = dedupe_by_key(c360).withColumn("_found", F.lit(True))
    asked = visits.select(*REQUEST_COLS)
    out = split_left_join(asked, prof, "id_cliente", "id_interaccion") if split_hot else asked.join(prof, "id_cliente", "left")
    found = F.coalesce(F.col("_found"), F.lit(False))
    return (out.withColumn("encontrado", found.cast("int"))
               .withColumn("error", F.when(~found, F.concat(F.lit("Cliente "), F.coalesce(
                   F.col("id_cliente"), F.lit("None")), F.lit(" no encontrado"))))
               .drop("_found"))


def serving_features(looked_up: DataFrame, dictionary: DataFrame, sized_dictionary: bool = False) -> DataFrame:
    """The 20 model features of each request, coded with the saved dictionary
    (unseen or missing value -> -1, as at serving time)."""
    with_dates = date_parts(looked_up.withColumn("_motivo", F.col("motivo_visita")))
    coded = apply_dictionary(with_dates, dictionary, CAT_COLS, null_code=-1, sized=sized_dictionary)
    return coded.fillna(0, subset=[c for c in FEATURE_COLS if c not in CAT_COLS])


def with_level(df: DataFrame, score_col: str = "score") -> DataFrame:
    """Level from the unrounded score, then the score rounded half-to-even."""
    return (df.withColumn("nivel", level(score_col))
              .withColumn("score_compra_hoy", F.bround(F.col(score_col), SCORE_DIGITS)))


def action_text(df: DataFrame, seg_col: str = "segmento", cat_col: str = "next_best_category",
                level_col: str = "nivel") -> DataFrame:
    """Segment template with the category filled in; a low level adds a suffix."""
    t = F.broadcast(dims.action_templates(df.sparkSession)
                    .select(F.col("segmento").alias("_seg"), F.col("plantilla").alias("_tpl")))
    tpl = F.coalesce(F.col("_tpl"), F.lit(dims.DEFAULT_ACTION))
    text = F.replace(tpl, F.lit("{cat}"), F.col(cat_col))
    text = F.when(F.col(level_col) == "BAJO", F.concat(text, F.lit(dims.LOW_PRIORITY_SUFFIX))).otherwise(text)
    return (df.join(t, df[seg_col] == F.col("_seg"), "left")
              .withColumn("accion_recomendada", text).drop("_seg", "_tpl"))


def finish(df: DataFrame) -> DataFrame:
    """From (segment name, raw score, favourite category) to the recommendation."""
    out = lookups.next_category(with_level(df))
    return action_text(out)


def recommend(visits: DataFrame, c360: DataFrame, seg_model: PipelineModel, prop_model,
              dictionary: DataFrame, sized_dictionary: bool = False, split_hot: bool = True) -> DataFrame:
    """The full recommendation row for every request (errors included), in one pass over the requests."""
    feats = serving_features(lookup(visits, c360, split_hot), dictionary, sized_dictionary)
    seg = assign_segments(feats, seg_model).withColumnRenamed("segmento_nombre", "segmento")
    scored = propensity_score(prop_model, seg).drop("motivo_visita").withColumnRenamed("_motivo", "motivo_visita")
    known = F.col("encontrado") == 1
    asked = ("id_interaccion", "id_cliente", "motivo_visita", "error")
    return finish(scored).select(*[F.col(c) if c in asked else F.when(known, F.col(c)).alias(c) for c in RECOMMENDATION_COLS])


def keyed_profiles(c360: DataFrame, path: str, table: str, buckets: int | None = None) -> DataFrame:
    """Customer 360, deduplicated, written once as a table bucketed and
    sorted by ``id_cliente`` (under ``path``, a folder in the shared
    checkpoint directory), and read back.

    A stream joins many small micro-batches to it. A left join cannot be
    built on the small (left) side, so against a plain DataFrame every batch
    would shuffle the whole profile table; the bucketed layout tells Spark
    the table is already hash-partitioned on the key, so each batch shuffles
    only its own visits (and the deduplication needs no shuffle either).
    """
    spark = c360.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (dedupe_by_key(c360).write.mode("overwrite").bucketBy(n, "id_cliente").sortBy("id_cliente")
        .option("path", path).saveAsTable(table))
    return spark.read.table(table)


def advisor_card(rec: DataFrame) -> DataFrame:
    """What the advisor sees: playbook, reason label, opportunity text and
    display names of the categories, joined to each recommendation."""
    out = lookups.playbook(rec, "segmento")
    out = lookups.reason_label(out, "motivo_visita")
    out = lookups.opportunity(out, "nivel")
    return (out.withColumn("categoria_sugerida", lookups.category_title("next_best_category"))
               .withColumn("categoria_historica", lookups.category_title("categoria_favorita")))
