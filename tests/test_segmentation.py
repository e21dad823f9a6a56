"""K-Means fits in shared passes: equal to separate runs, draws and limits."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors

from vitrina.operators import segmentation as S


def frame(spark, x):
    return spark.createDataFrame([(f"c{i}", Vectors.dense(r)) for i, r in enumerate(x)], ["id_cliente", "features"]).repartition(3)


def lloyd(x, centres, limit, max_iter=300):
    for _ in range(max_iter):
        near = ((x[:, None] - centres) ** 2).sum(2).argmin(1)
        moved = np.array([x[near == k].mean(0) if (near == k).any() else centres[k] for k in range(len(centres))])
        shift, centres = ((moved - centres) ** 2).sum(), moved
        if shift <= limit:
            break
    return centres, ((x[:, None] - centres) ** 2).sum(2).min(1).sum()


@pytest.fixture(scope="module")
def blobs():
    draw = np.random.default_rng(3)
    return np.concatenate([draw.normal(c, 0.6, (80, 3)) for c in ((0, 0, 0), (4, 0, 1), (0, 5, 2), (4, 4, 4))])


def test_shared_fits_equal_separate_runs_from_the_same_starts(spark, blobs):
    draw = np.random.default_rng(1)
    starts = [blobs[draw.choice(len(blobs), k, replace=False)] for k in (2, 3, 4, 4, 5, 7)]
    fits = S.fit_many(frame(spark, blobs), [(len(c), i) for i, c in enumerate(starts)], start=starts)
    limit = S.TOL * blobs.var(0).mean()
    for f, c in zip(fits, starts):
        centres, inertia = lloyd(blobs, c, limit)
        assert f.inertia == pytest.approx(inertia, rel=1e-9) and np.allclose(f.centres, centres)


def test_passes_do_not_grow_with_the_number_of_fits(spark, blobs, monkeypatch):
    passes, real = [], S._sums
    monkeypatch.setattr(S, "_sums", lambda points, fits, active: passes.append(list(active)) or real(points, fits, active))
    fits = S.fit_many(frame(spark, blobs), [(k, 42 + i) for k in (2, 3, 4) for i in range(5)])
    assert len(passes) < 40 and len(passes[-2]) < len(passes[0]) == 15      # finished fits drop out
    best = S._best([f for f in fits if f.k == 4])
    assert best.inertia == pytest.approx(lloyd(blobs, np.array([[0, 0, 0], [4, 0, 1], [0, 5, 2], [4, 4, 4]], float), 0)[1], rel=1e-6)


def test_seeded_and_repartitioned_alike(spark, blobs):
    a = S.fit_many(frame(spark, blobs), [(4, 7), (4, 8)])
    b = S.fit_many(frame(spark, blobs).repartition(7), [(4, 7), (4, 8)])
    for p, q in zip(a, b):
        assert np.allclose(p.centres, q.centres) and p.inertia == pytest.approx(q.inertia)


def test_draws_follow_the_squared_distance(spark):
    x = np.array([[0.0, 0.0]] * 50 + [[10.0, 0.0]] * 2 + [[0.0, 1.0]] * 2)
    points = frame(spark, x).selectExpr("xxhash64(id_cliente) AS mark", "features")
    from pyspark.ml.functions import vector_to_array
    points = points.select("mark", vector_to_array("features").alias("x"))
    fits = [S.KMeansFit(2, s, np.array([[0.0, 0.0]])) for s in range(300)]
    far = [found[0] == 10.0 for found in S._next_centres(points, fits, 1).values()]
    assert len(far) == 300 and np.mean(far) == pytest.approx(200 / 202, abs=0.03)


def test_model_has_the_fits_centres(spark, blobs):
    f = S.fit_many(frame(spark, blobs), [(5, 1)])[0]
    centres = f.model(spark).clusterCenters()
    assert np.allclose(sorted(map(tuple, centres)), sorted(map(tuple, f.centres)))


def test_fewer_rows_than_clusters_and_no_rows(spark):
    f = S.fit_many(frame(spark, np.array([[1.0, 2.0], [1.0, 2.0]])), [(3, 1)])[0]
    assert f.inertia == 0 and len(f.centres) == 3 and (f.centres == [1.0, 2.0]).all()
    none = frame(spark, np.array([[1.0, 2.0]])).where("id_cliente = 'x'")
    assert S.fit_many(none, [(2, 1)])[0].inertia == float("inf")
