"""Profiling and data-quality tables (the notebook's profile and quality cells).

All metrics are single-pass aggregates (one scan per table); histograms and
monthly counts get a small generated spine (bins or months, bounded by the
bin count or the date range) joined to the counts so empty bins/months show
up as 0. The correlation matrix is ONE aggregation with a covariance per
column pair, unpivoted afterwards.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import regex_flag

BLANK_PATTERN = r"(?U)^\s*$"


def _problem(col: str) -> Column:
    c = F.col(col).cast("string")
    return c.isNull() | (F.lower(c) == "null") | c.rlike(BLANK_PATTERN)


def completeness(df: DataFrame, columns: list[str]) -> DataFrame:
    """1 - (null + text 'null' in any case + blank) / n, one row per column."""
    n = F.count(F.lit(1))
    agg = df.agg(*[(F.lit(1) - F.count_if(_problem(c)) / n).alias(c) for c in columns])
    return _unpivot(agg, columns, "completitud")


def validity(df: DataFrame, patterns: dict[str, str]) -> DataFrame:
    """Share of values matching the pattern (missing values do not match)."""
    agg = df.agg(*[F.avg(regex_flag(c, p)).alias(c) for c, p in patterns.items()])
    return _unpivot(agg, list(patterns), "validez")


def uniqueness(df: DataFrame, column: str) -> DataFrame:
    """1 - share of repeated values (null counts as one value)."""
    groups = df.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    agg = groups.agg(F.count(F.lit(1)).alias("_g"), F.sum("_n").alias("_rows"))
    return agg.select(F.lit(column).alias("variable"),
                      (F.lit(1) - (F.col("_rows") - F.col("_g")) / F.col("_rows")).alias("unicidad"))


def _unpivot(one_row: DataFrame, columns: list[str], value_name: str) -> DataFrame:
    return one_row.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias(value_name)) for c in columns
    ])).alias("r")).select("r.*")


def quality_report(df: DataFrame, completeness_cols: list[str], patterns: dict[str, str],
                   unique_col: str) -> DataFrame:
    """One row per variable; a metric that does not apply is null.

    Completeness and validity come from ONE aggregation (one scan); only
    uniqueness needs its own grouping by the id.
    """
    n = F.count(F.lit(1))
    one = df.agg(*[(F.lit(1) - F.count_if(_problem(c)) / n).alias(f"_c_{c}") for c in completeness_cols],
                 *[F.avg(regex_flag(c, p)).alias(f"_v_{c}") for c, p in patterns.items()])
    variables = list(completeness_cols) + [c for c in patterns if c not in completeness_cols]
    none = F.lit(None).cast("double")
    rows = [F.struct(F.lit(v).alias("variable"),
                     (F.col(f"_c_{v}").cast("double") if v in completeness_cols else none).alias("completitud"),
                     (F.col(f"_v_{v}").cast("double") if v in patterns else none).alias("validez"))
            for v in variables]
    comp_val = one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    uniq = uniqueness(df, unique_col)          # one row
    return (comp_val.join(F.broadcast(uniq), "variable", "left")
                    .select("variable", "completitud", "validez", "unicidad"))


def distinct_ids(tables: dict[str, DataFrame], column: str = "id_cliente") -> DataFrame:
    out = None
    for name, df in tables.items():
        part = df.agg(F.count_distinct(column).alias("n_ids")).select(F.lit(name).alias("tabla"), "n_ids")
        out = part if out is None else out.unionByName(part)
    return out


def ids_in_all(tables: list[DataFrame], column: str = "id_cliente") -> DataFrame:
    """Ids present in every table (set intersection, a distinct semi-join)."""
    sets = [t.select(column).where(F.col(column).isNotNull()) for t in tables]
    inter = sets[0]
    for s in sets[1:]:
        inter = inter.intersect(s)
    return inter.agg(F.count(F.lit(1)).alias("n_ids_en_todas"))


def value_counts(tables: list[tuple[DataFrame, list[str]]]) -> DataFrame:
    """(variable, valor, n) for each column; nulls excluded; largest first.

    Each table is scanned ONCE: its columns are unpivoted to (variable, valor)
    and counted in one aggregation (partial per task).
    """
    out = None
    for df, cols in tables:
        pairs = df.select(F.explode(F.array(*[
            F.struct(F.lit(c).alias("variable"), F.col(c).cast("string").alias("valor")) for c in cols
        ])).alias("p")).select("p.variable", "p.valor")
        part = (pairs.where(F.col("valor").isNotNull()).groupBy("variable", "valor")
                     .agg(F.count(F.lit(1)).alias("n")))
        out = part if out is None else out.unionByName(part)
    return out.orderBy("variable", F.desc("n"), "valor")


def histograms(df: DataFrame, columns: list[str], bins: int = 15) -> DataFrame:
    """Equal-width bins between min and max of each column; the last bin is
    closed. All columns in two scans: one for the per-column min/max, one
    for the bin counts (the columns are unpivoted to (variable, value))."""
    long = (df.select(F.explode(F.array(*[
                F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("_x")) for c in columns
            ])).alias("p")).select("p.variable", "p._x")
              .where(F.col("_x").isNotNull()))
    # one row per column: bounded by the caller's column list
    stats = long.groupBy("variable").agg(F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    binned = long.join(F.broadcast(stats), "variable").select(
        "variable",
        F.when(F.col("_hi") == F.col("_lo"), F.lit(0))
         .otherwise(F.least(F.floor((F.col("_x") - F.col("_lo")) / width).cast("int"), F.lit(bins - 1)))
         .alias("bin"))
    counts = binned.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    spine = stats.select("variable", "_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return (spine.join(counts, ["variable", "bin"], "left")
                 .select("variable", "bin",
                         (F.col("_lo") + F.col("bin") * width).alias("desde"),
                         (F.col("_lo") + (F.col("bin") + 1) * width).alias("hasta"),
                         F.coalesce("n", F.lit(0)).alias("n")))


def histogram(df: DataFrame, column: str, bins: int = 15) -> DataFrame:
    return histograms(df, [column], bins)


def monthly_counts(df: DataFrame, date_col: str, count_col: str) -> DataFrame:
    """Non-null ``count_col`` per calendar month, empty months included."""
    month = F.to_date(F.date_trunc("month", F.col(date_col)))
    counts = (df.where(F.col(date_col).isNotNull())
                .groupBy(month.alias("mes")).agg(F.count(count_col).alias("n")))
    rng = counts.agg(F.min("mes").alias("_a"), F.max("mes").alias("_b"))
    spine = rng.select(F.explode(F.sequence("_a", "_b", F.expr("INTERVAL 1 MONTH"))).alias("mes"))
    return spine.join(counts, "mes", "left").select("mes", F.coalesce("n", F.lit(0)).alias("n"))


def rate_by(df: DataFrame, key: str, target: str, alias: str) -> DataFrame:
    """Mean of a 0/1 target per non-null key, highest first."""
    return (df.where(F.col(key).isNotNull()).groupBy(key).agg(F.avg(target).alias(alias))
              .orderBy(F.desc(alias), key))


def correlation_matrix(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Pearson correlation for every pair below the diagonal, in one pass.

    A constant column gives null (no error): ``try_divide`` by a zero product
    of standard deviations.
    """
    cols = {c: F.col(c).cast("double") for c in columns}
    aggs = [F.stddev_pop(cols[c]).alias(f"_s_{i}") for i, c in enumerate(columns)]
    pairs = [(i, j) for i, j in combinations(range(len(columns)), 2)]
    aggs += [F.covar_pop(cols[columns[j]], cols[columns[i]]).alias(f"_c_{i}_{j}") for i, j in pairs]
    one = df.agg(*aggs)
    rows = [F.struct(F.lit(columns[j]).alias("variable_a"), F.lit(columns[i]).alias("variable_b"),
                     F.bround(F.try_divide(F.col(f"_c_{i}_{j}"), F.col(f"_s_{i}") * F.col(f"_s_{j}")),
                              digits).alias("correlacion"))
            for i, j in pairs]
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
