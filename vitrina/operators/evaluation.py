"""Binary-classifier evaluation on a (key, score, label) DataFrame.

Curves and AUC are computed from counts per DISTINCT score: one aggregate
(partial per partition), then running totals over the score order with the
range-partitioned helper of ``ranking`` (no single-task window), so the cost
is linear in the rows and the state is bounded by the distinct scores.
Quantile bins use exact, distributed quantiles and an edge array of at most
11 values inlined as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_scalars
from ..functions.sizing import bounded_broadcast
from .ranking import exact_quantiles, prefix_sums_with_totals

# Class names of the classification report and the decision
# threshold of a hard prediction (class 1 when score > 0.5).
CLASS_NAMES = [(0, "No compra"), (1, "Compra")]
THRESHOLD = 0.5
DECILE_PROBS = [i * 0.1 for i in range(10)] + [1.0]


def score_counts(df: DataFrame, score: str = "score", label: str = "y",
                 group_cols: list[str] | None = None) -> DataFrame:
    """Per distinct score: pos, neg, running totals ascending, and totals P, N.

    With ``group_cols`` (e.g. a fold id) everything restarts per group.
    """
    g = list(group_cols or [])
    counts = (df.where(F.col(score).isNotNull())
                .groupBy(*g, F.col(score).cast("double").alias("score"))
                .agg(F.sum(F.col(label).cast("long")).alias("pos"),
                     F.sum((1 - F.col(label)).cast("long")).alias("neg")))
    cum, totals = prefix_sums_with_totals(counts, ["score"], ["pos", "neg"], group_cols=g)
    # totals: one row per group (e.g. per fold), taken from the helper's
    # partition totals instead of a second aggregation of ``df``
    totals = totals.select(*g, F.col("tot_pos").alias("P"), F.col("tot_neg").alias("N"))
    if not g:
        return with_scalars(cum, totals)
    # any grouping is allowed, so the per-group totals are measured before a
    # broadcast (they derive from the helper's checkpoint: no extra write)
    return cum.join(bounded_broadcast(totals, checkpoint=False), g)


def auc(df: DataFrame, score: str = "score", label: str = "y",
        group_cols: list[str] | None = None) -> DataFrame:
    """Tie-aware ROC AUC: sum over positives of (negatives below + half the tied).

    Equals ``BinaryClassificationEvaluator(numBins=0)``; one row per group.
    """
    g = list(group_cols or [])
    sc = score_counts(df, score, label, g)
    term = F.col("pos") * ((F.col("cum_neg") - F.col("neg")) + F.lit(0.5) * F.col("neg"))
    agg = F.try_divide(F.sum(term), F.max("P") * F.max("N")).alias("auc")
    return sc.groupBy(*g).agg(agg) if g else sc.agg(agg)


def _tps_fps(sc: DataFrame) -> DataFrame:
    """Counts at threshold t = rows with score >= t."""
    return sc.select("score", "P", "N",
                     (F.col("P") - F.col("cum_pos") + F.col("pos")).alias("tps"),
                     (F.col("N") - F.col("cum_neg") + F.col("neg")).alias("fps"),
                     "pos")


def roc_curve(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """(threshold, fpr, tpr) per distinct score, plus the (inf, 0, 0) origin."""
    t = _tps_fps(score_counts(df, score, label))
    pts = t.select(F.col("score").alias("threshold"),
                   F.try_divide("fps", "N").alias("fpr"), F.try_divide("tps", "P").alias("tpr"))
    origin = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)],
                                             "threshold double, fpr double, tpr double")
    return pts.unionByName(origin)


def pr_curve(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """(threshold, precision, recall) per distinct score, plus the (-, 1, 0) end."""
    t = _tps_fps(score_counts(df, score, label))
    pts = t.select(F.col("score").alias("threshold"),
                   F.coalesce(F.try_divide("tps", F.col("tps") + F.col("fps")), F.lit(0.0)).alias("precision"),
                   F.try_divide("tps", "P").alias("recall"))
    end = df.sparkSession.createDataFrame([(None, 1.0, 0.0)],
                                          "threshold double, precision double, recall double")
    return pts.unionByName(end)


def average_precision(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """Sum over thresholds of (recall step) x precision."""
    t = _tps_fps(score_counts(df, score, label))
    prec = F.try_divide("tps", F.col("tps") + F.col("fps"))
    return t.agg(F.sum(F.try_divide("pos", "P") * prec).alias("average_precision"))


def with_prediction(df: DataFrame, score: str = "score", threshold: float = THRESHOLD) -> DataFrame:
    return df.withColumn("y_pred", (F.col(score) > threshold).cast("int"))


def confusion(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """(y_real, y_pred, n) for all four cells, empty cells as 0."""
    pred = with_prediction(df, score)
    counts = pred.groupBy(F.col(label).cast("int").alias("y_real"), "y_pred").agg(
        F.count(F.lit(1)).alias("n"))
    spine = df.sparkSession.createDataFrame([(a, b) for a in (0, 1) for b in (0, 1)],
                                            "y_real int, y_pred int")
    return (F.broadcast(spine).join(counts, ["y_real", "y_pred"], "left")
             .select("y_real", "y_pred", F.coalesce("n", F.lit(0)).alias("n")))


def class_report(df: DataFrame, score: str = "score", label: str = "y") -> DataFrame:
    """precision, recall, f1, support per class; accuracy; macro and weighted means.

    A zero denominator gives 0. f1 = 2 tp / (support + predicted).
    """
    cm = confusion(df, score, label)
    one = cm.agg(*[F.sum(F.when((F.col("y_real") == a) & (F.col("y_pred") == b), F.col("n")))
                   .alias(f"n{a}{b}") for a in (0, 1) for b in (0, 1)])
    per_class = []
    for c, name in CLASS_NAMES:
        o = 1 - c
        tp, sup = F.col(f"n{c}{c}"), F.col(f"n{c}{c}") + F.col(f"n{c}{o}")
        pred = F.col(f"n{c}{c}") + F.col(f"n{o}{c}")
        per_class.append((name,
                          F.coalesce(F.try_divide(tp, pred), F.lit(0.0)),
                          F.coalesce(F.try_divide(tp, sup), F.lit(0.0)),
                          F.coalesce(F.try_divide(2 * tp, sup + pred), F.lit(0.0)),
                          sup))
    total = F.col("n00") + F.col("n01") + F.col("n10") + F.col("n11")
    acc = F.try_divide(F.col("n00") + F.col("n11"), total)
    rows = [F.struct(F.lit(n).alias("clase"), p.alias("precision"), r.alias("recall"),
                     f.alias("f1_score"), s.cast("long").alias("support"))
            for n, p, r, f, s in per_class]
    rows.append(F.struct(F.lit("accuracy").alias("clase"), F.lit(None).cast("double").alias("precision"),
                         F.lit(None).cast("double").alias("recall"), acc.alias("f1_score"),
                         total.cast("long").alias("support")))
    (_, p0, r0, f0, s0), (_, p1, r1, f1, s1) = per_class
    rows.append(F.struct(F.lit("macro avg").alias("clase"), ((p0 + p1) / 2).alias("precision"),
                         ((r0 + r1) / 2).alias("recall"), ((f0 + f1) / 2).alias("f1_score"),
                         total.cast("long").alias("support")))
    rows.append(F.struct(F.lit("weighted avg").alias("clase"),
                         F.try_divide(p0 * s0 + p1 * s1, total).alias("precision"),
                         F.try_divide(r0 * s0 + r1 * s1, total).alias("recall"),
                         F.try_divide(f0 * s0 + f1 * s1, total).alias("f1_score"),
                         total.cast("long").alias("support")))
    return one.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def decile_edges(df: DataFrame, score: str = "score") -> DataFrame:
    """One row: the distinct quantile edges at 0, 0.1, ..., 1 (ascending)."""
    q = exact_quantiles(df, score, DECILE_PROBS)
    return q.agg(F.array_distinct(F.array_sort(F.collect_list("quantile"))).alias("edges"))


def deciles(df: DataFrame, score: str = "score") -> DataFrame:
    """Right-closed quantile bins like ``qcut(10, duplicates='drop')``."""
    edges = decile_edges(df, score).scalar()        # one array of <= 11 values, inlined
    s = F.col(score)
    # number of edges below the score (the array has at most len(DECILE_PROBS)
    # entries; a subquery cannot sit inside a lambda, so the count is unrolled)
    below = F.lit(0)
    for i in range(len(DECILE_PROBS)):
        below = below + F.when(F.try_element_at(edges, F.lit(i + 1)) < s, 1).otherwise(0)
    return df.withColumn("decil", F.greatest(below - 1, F.lit(0)))


def lift_by_decile(df: DataFrame, label: str = "y") -> DataFrame:
    return df.groupBy("decil").agg(F.avg(label).alias("tasa_compra"), F.count(F.lit(1)).alias("n"))


def top_lift(df: DataFrame, label: str = "y") -> DataFrame:
    """Purchase rate of the highest decile over the overall rate."""
    by = lift_by_decile(df, label)
    base = df.agg(F.avg(label).alias("baseline"))
    top = by.agg(F.max_by("tasa_compra", "decil").alias("tasa_top"))
    return with_scalars(top, base).select("baseline", "tasa_top",
                                      F.try_divide("tasa_top", "baseline").alias("lift_top"))


def top_row(df: DataFrame, key: str, score: str = "score") -> DataFrame:
    """The highest-scored row; ties go to the smallest key (a top-1 report)."""
    return df.orderBy(F.desc(score), F.asc(key)).limit(1)
