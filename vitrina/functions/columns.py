"""Column expressions shared by the operators (all JVM-side built-ins).

Each helper returns a ``Column`` so it stays inside whole-stage codegen; no
Python UDF is needed anywhere in the row path.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Validity patterns for contact data (Python ``re.match``
# semantics). ``(?U)`` makes \d and \w Unicode-aware as in Python; ``(?d)``
# makes ``$`` accept only a final "\n" (Java would also accept "\r").
PHONE_PATTERN = r"^\d{10}$"
EMAIL_PATTERN = r"^[\w.-]+@[\w.-]+\.\w+$"
JAVA_FLAGS = "(?dU)"

# Days of the month counted as pay days (quincena).
PAYDAY_DAYS = (14, 15, 16, 28, 29, 30, 31)

# Propensity level thresholds (strict ``>`` on the raw score).
LEVEL_HIGH = 0.6
LEVEL_MEDIUM = 0.35

# Strings a pandas CSV read treats as missing.
NA_STRINGS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
              "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
              "n/a", "nan", "null")


def regex_flag(col: Column | str, pattern: str) -> Column:
    """1 when the value matches ``pattern`` from its start, else 0 (null -> 0)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.rlike(JAVA_FLAGS + pattern), F.lit(False)).cast("int")


def whole_days(start: Column | str, end: Column | str) -> Column:
    """Whole elapsed 24-hour days from ``start`` to ``end`` (not calendar days)."""
    s = F.col(start) if isinstance(start, str) else start
    e = F.col(end) if isinstance(end, str) else end
    return F.timestamp_diff("DAY", s, e)


def weekday0(ts: Column | str) -> Column:
    """Day of week with Monday = 0 .. Sunday = 6."""
    return F.weekday(F.col(ts) if isinstance(ts, str) else ts)


def payday_flag(ts: Column | str) -> Column:
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.dayofmonth(c).isin(*PAYDAY_DAYS).cast("int")


def nan_to_null(col: Column | str) -> Column:
    """Spark has NaN and null; pandas treats both as missing. Keep only null."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(F.isnan(c), F.lit(None).cast("double")).otherwise(c)


def level(score: Column | str) -> Column:
    """ALTO / MEDIO / BAJO from the unrounded score; null or NaN -> BAJO."""
    s = nan_to_null(score)
    return (F.when(s > LEVEL_HIGH, "ALTO")
             .when(s > LEVEL_MEDIUM, "MEDIO")
             .otherwise("BAJO"))


def na_normalise(col: Column | str) -> Column:
    """Turn the CSV missing-value words into null (before any cast)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.when(c.isin(*NA_STRINGS), F.lit(None).cast("string")).otherwise(c)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach every column of a one-row aggregate to every row of ``df``.

    The aggregate becomes ONE scalar subquery (``DataFrame.scalar``): Spark
    runs it once and inlines the value, so there is no join at all. An empty
    input gives nulls (an aggregate without grouping always has one row).
    """
    s = one_row.select(F.struct(*one_row.columns).alias("_s")).scalar()
    return df.withColumns({c: s[c] for c in one_row.columns})
