"""Customer cleaning: contact validity flags and credit-score imputation.

Scale notes: medians are exact and never hold a group's rows in one task. The
customers are counted once by (zone, score); that table has one row per
distinct pair and is checkpointed. Both medians come from it by
``ranking.exact_quantiles`` (range-partitioned running totals of the counts,
the middle ranks picked with a join): the zones' from the pairs, the global one
from the same pairs with each zone's missing scores moved to its median. So the
customers are scanned once for both, whatever the number of distinct scores.
The per-zone result has one row per zone; it is broadcast when its size is
measured within bounds (``bounded_broadcast``), else joined normally. The
global median is one value, used as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import EMAIL_PATTERN, PHONE_PATTERN, regex_flag
from ..functions.sizing import bounded_broadcast
from ..session import ensure_checkpoint_dir
from .ranking import exact_quantiles

SCORE = "score_credito_interno"
ZONE = "zona_geografica"


def phone_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("tiene_celular_valido", regex_flag("celular_contacto", PHONE_PATTERN))


def email_flag(df: DataFrame) -> DataFrame:
    return df.withColumn("tiene_email_valido", regex_flag("email_contacto", EMAIL_PATTERN))


def score_counts(df: DataFrame) -> DataFrame:
    """(zone, score, customers): written once, both medians read it."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.groupBy(ZONE, SCORE).agg(F.count(F.lit(1)).alias("_c")).checkpoint()


def _zone_medians(counts: DataFrame) -> DataFrame:
    """One row per zone that has a score: (zona_geografica, mediana_zona), pandas semantics."""
    q = exact_quantiles(counts.where(F.col(ZONE).isNotNull()), SCORE, [0.5], group_cols=[ZONE], weight="_c")
    return bounded_broadcast(q.select(ZONE, F.col("quantile").alias("mediana_zona")), checkpoint=False)


def zone_median(df: DataFrame) -> DataFrame:
    """One row per non-null zone with the median score (null when the zone
    has no score; the null zone has no row)."""
    counts = score_counts(df)
    zones = counts.where(F.col(ZONE).isNotNull()).select(ZONE).distinct()
    return zones.join(_zone_medians(counts), ZONE, "left")


def _filled(df: DataFrame, medians: DataFrame) -> DataFrame:
    return df.join(medians, ZONE, "left").withColumn(SCORE, F.coalesce(SCORE, "mediana_zona")).drop("mediana_zona")


def _global_median(counts: DataFrame) -> DataFrame:
    """One row: the median of the counted scores (null if there is none)."""
    q = exact_quantiles(counts, SCORE, [0.5], weight="_c")
    return q.agg(F.max("quantile").alias("mediana_global"))


def impute_zone(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Fill a missing score with its zone median; rows of null zone keep null."""
    return _filled(df, _zone_medians(score_counts(df) if counts is None else counts))


def impute_global(df: DataFrame, counts: DataFrame | None = None) -> DataFrame:
    """Fill what is still missing with the median of the (zone-imputed) column."""
    # one value: a scalar subquery, run once and inlined
    return df.withColumn(SCORE, F.coalesce(F.col(SCORE), _global_median(score_counts(df) if counts is None else counts).scalar()))


CLEAN_COLUMNS = ["id_cliente", "zona_geografica", "antiguedad_meses", "score_credito_interno",
                 "tiene_celular_valido", "tiene_email_valido"]


def clean_clientes(df: DataFrame) -> DataFrame:
    """Flags instead of contacts, zone then global median for the score."""
    counts = score_counts(df)
    medians = _zone_medians(counts)
    filled = _filled(df.transform(phone_flag).transform(email_flag), medians)
    return impute_global(filled, _filled(counts, medians)).select(*CLEAN_COLUMNS)
