"""Randomised properties of the distributed helpers against plain numpy/pandas
(SURVEY §5 item 3): exact grouped quantiles, grouped row numbers, tie-aware AUC."""

import numpy as np
import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from vitrina.operators import evaluation, ranking

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
groups = st.sampled_from(["a", "b", "c", None])
values = st.integers(min_value=-5, max_value=5).map(float)      # few values: many ties


@SETTINGS
@given(st.lists(st.tuples(groups, values), min_size=1, max_size=40))
def test_grouped_quantiles_match_numpy(spark, rows):
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {(r["g"], r["p"]): r["quantile"]
           for r in ranking.exact_quantiles(df, "x", probs, group_cols=["g"], num_partitions=3).collect()}
    pdf = pd.DataFrame(rows, columns=["g", "x"])
    for g, part in pdf.groupby("g", dropna=False):
        g = None if isinstance(g, float) and np.isnan(g) else g
        for p in probs:
            assert got[(g, p)] == np.quantile(part["x"].to_numpy(), p)


@SETTINGS
@given(st.lists(st.tuples(groups, st.integers(0, 10**6)), min_size=1, max_size=40, unique_by=lambda t: t[1]))
def test_grouped_row_numbers_match_sort(spark, rows):
    df = spark.createDataFrame(rows, "g string, k long")
    got = {r["k"]: (r["rn"], r["n"]) for r in ranking.global_row_number(
        df, ["k"], group_cols=["g"], num_partitions=4, total_alias="n").collect()}
    pdf = pd.DataFrame(rows, columns=["g", "k"]).fillna({"g": "<null>"})
    pdf["rn"] = pdf.groupby("g")["k"].rank(method="first").astype(int)
    pdf["n"] = pdf.groupby("g")["k"].transform("size")
    assert got == {int(k): (int(rn), int(n)) for k, rn, n in zip(pdf["k"], pdf["rn"], pdf["n"])}


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 6).map(lambda v: v / 6), st.integers(0, 1)), min_size=2, max_size=40))
def test_auc_matches_pair_count(spark, rows):
    ys = [y for _, y in rows]
    if len(set(ys)) < 2:
        return
    df = spark.createDataFrame([(i, s, y) for i, (s, y) in enumerate(rows)], "id int, score double, y int")
    got = evaluation.auc(df).first()["auc"]
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    wins = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(got - wins / (len(pos) * len(neg))) < 1e-12
