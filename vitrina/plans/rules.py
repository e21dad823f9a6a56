"""Fixed, deterministic stand-ins for model outputs used by exact checks.

Operators downstream of a model (evaluation, lookups by segment, action text)
are checked against DuckDB on a rule instead of a fitted model, so the check
is exact. Both rules read real columns of the whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# segment id = tenure in months mod 7 (ids 5 and 6 exercise the default name)
SEGMENT_RULE_SQL = "CAST(antiguedad_meses % 7 AS INT)"
# score = 0.5 for a quote visit + 0.5 x historic conversion rate
SCORE_RULE_SQL = ("0.5 * CAST(motivo_visita = 'cotizacion' AS DOUBLE) "
                  "+ 0.5 * coalesce(tasa_conversion_hist, 0)")


def segment_rule() -> Column:
    return (F.col("antiguedad_meses") % 7).cast("int")


def score_rule() -> Column:
    return (F.lit(0.5) * (F.col("motivo_visita") == "cotizacion").cast("double")
            + F.lit(0.5) * F.coalesce(F.col("tasa_conversion_hist"), F.lit(0.0)))
