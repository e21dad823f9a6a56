"""Profiling edge cases and properties."""

import datetime as dt
import math

import numpy as np
import pandas as pd

from vitrina.operators import evaluation, profiling, segmentation


def test_monthly_counts_fill_empty_months(spark):
    t = dt.datetime
    df = spark.createDataFrame([("1", t(2024, 1, 5)), ("2", t(2024, 1, 30)), ("3", t(2024, 3, 1)),
                                (None, t(2024, 3, 2)), ("5", None)],
                               "id string, f timestamp_ntz")
    got = [(r["mes"], r["n"]) for r in profiling.monthly_counts(df, "f", "id").orderBy("mes").collect()]
    assert got == [(dt.date(2024, 1, 1), 2), (dt.date(2024, 2, 1), 0), (dt.date(2024, 3, 1), 1)]


def test_correlation_with_constant_column_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0), (2.0, 4.1, 5.0), (3.0, 5.9, 5.0)], "a double, b double, c double")
    got = {(r["variable_a"], r["variable_b"]): r["correlacion"]
           for r in profiling.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert got[("b", "a")] == round(float(np.corrcoef([1, 2, 3], [2, 4.1, 5.9])[0, 1]), 6)
    assert got[("c", "a")] is None and got[("c", "b")] is None


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in [0, 1, 2, 3, 15]], "x double")
    rows = profiling.histogram(df, "x").orderBy("bin").collect()
    counts, edges = np.histogram(np.array([0, 1, 2, 3, 15.0]), bins=15)
    assert [r["n"] for r in rows] == counts.tolist()
    assert sum(r["n"] for r in rows) == 5


def test_deciles_match_pandas_qcut_on_random_scores(spark):
    rng = np.random.default_rng(7)
    for scores in (rng.random(400), np.round(rng.random(300), 1), rng.integers(0, 4, 200).astype(float)):
        pdf = pd.DataFrame({"id": range(len(scores)), "score": scores})
        want = pd.qcut(pdf["score"], 10, labels=False, duplicates="drop").tolist()
        got = [r["decil"] for r in evaluation.deciles(spark.createDataFrame(pdf)).orderBy("id").collect()]
        assert got == want
        assert len(got) == len(scores)            # decile counts sum to n


def test_center_tolerance_keeps_sum_within_reference_bound():
    tol, mean_var = 1e-4, 0.9999
    for k in range(2, 8):
        eps = segmentation.center_tolerance(k, mean_var, tol)
        # every centre moving by exactly eps: the sum of squared shifts is the bound
        assert math.isclose(k * eps * eps, tol * mean_var)
    assert segmentation.center_tolerance(3, 0.0, tol) == tol
