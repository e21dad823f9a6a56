"""Global-order helpers and evaluation metrics against brute force."""

import numpy as np
import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from vitrina.operators import drift, evaluation, ranking


def test_prefix_sums_match_window(spark):
    df = spark.range(0, 5000).select(F.col("id"), (F.col("id") % 7).alias("g"),
                                     ((F.col("id") * 37) % 101).alias("v"))
    got = ranking.prefix_sums(df, ["id"], ["v"], group_cols=["g"], num_partitions=6)
    w = Window.partitionBy("g").orderBy("id").rowsBetween(Window.unboundedPreceding, 0)
    ref = df.withColumn("ref", F.sum("v").over(w))
    bad = got.join(ref, ["id", "g", "v"]).where(F.col("cum_v") != F.col("ref")).count()
    assert bad == 0 and got.count() == 5000


def test_global_row_number(spark):
    df = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"))
    rn = ranking.global_row_number(df, ["k"], num_partitions=5)
    assert rn.where(F.col("rn") != F.col("k") + 1).count() == 0


def test_grouped_row_number_with_null_group_and_totals(spark):
    # a hot group (a third of the rows), a null group and more partitions than groups
    df = spark.range(0, 6000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit("hot"))
               .when(F.col("id") % 11 == 0, F.lit(None))
               .otherwise((F.col("id") % 5).cast("string")).alias("g"),
        ((F.col("id") * 7919) % 6000).alias("k"))
    got = ranking.global_row_number(df, ["k"], alias="rn", group_cols=["g"], num_partitions=9,
                                    total_alias="n")
    w = Window.partitionBy("g").orderBy("k")
    ref = (df.withColumn("rn_ref", F.row_number().over(w))
             .withColumn("n_ref", F.count(F.lit(1)).over(Window.partitionBy("g"))))
    assert got.count() == 6000
    bad = got.join(ref, "id").where((F.col("rn") != F.col("rn_ref")) | (F.col("n") != F.col("n_ref")))
    assert bad.count() == 0


def test_exact_quantiles_by_group_match_numpy(spark):
    rows = [("a", float(v)) for v in [1, 2, 4, 10]] + [("b", 5.0)] + [(None, float(v)) for v in [3, 9]] \
        + [("c", None)]
    df = spark.createDataFrame(rows, "g string, x double")
    got = {(r["g"], r["p"]): r["quantile"]
           for r in ranking.exact_quantiles(df, "x", [0.25, 0.5], group_cols=["g"]).collect()}
    for g, vals in [("a", [1, 2, 4, 10]), ("b", [5]), (None, [3, 9])]:
        for p in (0.25, 0.5):
            assert got[(g, p)] == np.quantile(np.array(vals, dtype=float), p)
    assert ("c", 0.5) not in got            # a group without values has no quantile


def test_exact_quantiles_match_numpy(spark):
    vals = [1.0, 1.0, 1.0, 1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0, 7.5, 10.0, 10.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    probs = [i * 0.1 for i in range(10)] + [1.0]
    got = {r["p"]: r["quantile"] for r in ranking.exact_quantiles(df, "x", probs).collect()}
    for p in probs:
        assert got[p] == np.quantile(np.array(vals), p)


def test_deciles_like_qcut(spark):
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate([1, 1, 1, 1, 2, 3, 4, 5, 6, 7])],
                               "id int, score double")
    got = [r["decil"] for r in evaluation.deciles(df).orderBy("id").collect()]
    assert got == [0, 0, 0, 0, 1, 2, 3, 4, 5, 6]
    assert got == list(pd.qcut(pd.Series([1, 1, 1, 1, 2, 3, 4, 5, 6, 7]), 10, labels=False, duplicates="drop"))


def _auc_brute(scores, labels):
    pos = [s for s, y in zip(scores, labels) if y == 1]
    neg = [s for s, y in zip(scores, labels) if y == 0]
    tot = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    return tot / (len(pos) * len(neg))


def test_auc_against_brute_force_and_symmetry(spark):
    rng = np.random.default_rng(0)
    scores = np.round(rng.random(400), 2).tolist()
    labels = (rng.random(400) < np.array(scores)).astype(int).tolist()
    df = spark.createDataFrame(list(zip(range(400), scores, labels)), "id int, score double, y int")
    a = evaluation.auc(df).first()["auc"]
    assert abs(a - _auc_brute(scores, labels)) < 1e-12
    neg = evaluation.auc(df.withColumn("score", -F.col("score"))).first()["auc"]
    assert abs(neg - (1 - a)) < 1e-12 and 0 <= a <= 1


def test_confusion_and_report(spark):
    df = spark.createDataFrame([(0.9, 1), (0.6, 0), (0.5, 1), (0.1, 0), (0.2, 0)], "score double, y int")
    cm = {(r["y_real"], r["y_pred"]): r["n"] for r in evaluation.confusion(df).collect()}
    assert cm == {(0, 0): 2, (0, 1): 1, (1, 0): 1, (1, 1): 1}      # 0.5 is not > 0.5
    rep = {r["clase"]: r for r in evaluation.class_report(df).collect()}
    assert rep["Compra"]["precision"] == 0.5 and rep["Compra"]["recall"] == 0.5
    assert rep["accuracy"]["f1_score"] == 0.6 and rep["accuracy"]["support"] == 5


def test_ks_of_identical_halves_is_zero(spark):
    rows = [(i, "referencia" if i % 2 == 0 else "actual", float(i // 2 % 10)) for i in range(200)]
    df = spark.createDataFrame(rows, "id int, corte string, x double")
    d = drift.ks_statistics(df, ["x"]).first()
    assert d["statistic"] == 0.0 and d["n_ref"] == 100 and d["n_cur"] == 100


def test_stat_tails():
    from vitrina.functions.stats import chi2_sf_scalar, ks_sf_scalar
    assert abs(chi2_sf_scalar(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf_scalar(18.307038053275146, 10) - 0.05) < 1e-9
    assert ks_sf_scalar(0.0, 100, 100) == 1.0
    assert abs(ks_sf_scalar(1.3580986393225507 / np.sqrt(50), 100, 100) - 0.05) < 1e-6


def test_split_halves(spark):
    df = spark.createDataFrame([(i, i % 3) for i in range(11)], "id int, t int")
    out = {r["id"]: r["corte"] for r in drift.split_halves(df, ["t", "id"]).collect()}
    order = sorted(range(11), key=lambda i: (i % 3, i))
    assert [out[i] for i in order] == ["referencia"] * 5 + ["actual"] * 6
