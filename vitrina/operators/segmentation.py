"""Customer segmentation: scaling, K-Means (best of several seeds), k sweep,
silhouette, stable segment names, per-segment profile / box statistics and a
2-D map.

All K-Means fits that are asked for together, every (k, restart) of a sweep,
share the scans of the scaled customers. One pass assigns each customer to the
nearest centre of every fit and sums them by (fit, cluster) in the task; the
sums meet in one aggregate keyed (fit, cluster), and only they (k x 10 numbers a
fit) reach the driver. Fits that have converged drop out of the next pass. The
first centres are drawn by k-means++, also for all fits at once: a customer's
chance follows its squared distance to the centres so far, by a hash of its id,
so a repeated task draws the same. The scaled frame is persisted once for the
whole sweep. Silhouette is Spark's linear-cost form (squared Euclidean), never
all pairs of rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import with_scalars
from ..functions.concurrency import run_concurrently
from ..functions.sizing import bounded_broadcast
from . import lookups
from .ranking import exact_quantiles

SEGMENT_FEATURES = [
    "recency_dias", "frequency", "monetary_total", "monetary_avg",
    "total_visitas", "tasa_conversion_hist", "usa_credito_propio",
    "diversidad_categorias", "score_credito_interno", "antiguedad_meses",
]
# Fixed values of the reference search: k range, restarts, seed, iterations.
K_RANGE = list(range(2, 8))
N_INIT = 10
SEED = 42
MAX_ITER = 300
TOL = 1e-4
# Stable naming: clusters are numbered by their centre on this feature,
# highest first, so segment 0 ("VIP Comprador") is the highest-spending one.
ORDER_FEATURE = "monetary_total"


def zscore(df: DataFrame, columns: list[str] = SEGMENT_FEATURES, keep: list[str] = ("id_cliente",),
           digits: int | None = None) -> DataFrame:
    """(x - mean) / population std per column, divisor 1 for a constant column.

    Nulls count as 0 first. One aggregate gives all means and deviations.
    ``digits`` rounds the result (a float mean's last bits depend on the
    summation order, so reports use a fixed precision).
    """
    filled = df.select(*keep, *[F.coalesce(F.col(c).cast("double"), F.lit(0.0)).alias(c) for c in columns])
    stats = filled.agg(*[F.avg(c).alias(f"_m_{c}") for c in columns],
                       *[F.stddev_pop(c).alias(f"_s_{c}") for c in columns])
    out = with_scalars(filled, stats)
    z = {c: (F.col(c) - F.col(f"_m_{c}")) / F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
         for c in columns}
    if digits is not None:
        z = {c: F.bround(e, digits) for c, e in z.items()}
    return out.select(*keep, *[z[c].alias(c) for c in columns])


def feature_stages(columns: list[str] = SEGMENT_FEATURES):
    """Assembler + scaler. Spark's scaler divides by the sample std, a factor
    sqrt((n-1)/n) off the population std for EVERY column alike, so clusters
    and silhouette are unchanged and inertia scales by (n-1)/n."""
    assembler = VectorAssembler(inputCols=columns, outputCol="raw_features", handleInvalid="keep")
    scaler = StandardScaler(inputCol="raw_features", outputCol="features", withMean=True, withStd=True)
    return [assembler, scaler]


def prepare(c360: DataFrame, columns: list[str] = SEGMENT_FEATURES) -> tuple[PipelineModel, DataFrame]:
    """Fit the scaler; return it and the persisted (id, features) frame.

    The frame is materialised here, before any fit reads it. Pass a
    checkpointed ``c360``, since the scaler fit and the transform both read it.
    """
    filled = c360.fillna(0, subset=columns)
    model = Pipeline(stages=feature_stages(columns)).fit(filled)
    scaled = model.transform(filled).select("id_cliente", "features").persist(StorageLevel.MEMORY_AND_DISK)
    scaled.count()
    return model, scaled


@dataclass
class KMeansFit:
    k: int
    seed: int
    centres: np.ndarray
    inertia: float = float("inf")

    def model(self, spark) -> KMeansModel:
        """A Spark model with these centres: K-Means of the centres alone, which are their own clusters."""
        from pyspark.ml.linalg import Vectors

        rows = spark.createDataFrame([(Vectors.dense(c),) for c in self.centres], ["features"]).coalesce(1)
        return KMeans(k=self.k, initMode="random", maxIter=1, seed=1, featuresCol="features", predictionCol="cluster").fit(rows)


def mean_variance(scaled: DataFrame) -> float:
    """Mean population variance of the feature columns (one summary job)."""
    if scaled.isEmpty():
        return 0.0
    s = scaled.select(Summarizer.metrics("variance", "count").summary(F.col("features")).alias("s")).first()["s"]
    n = int(s["count"])
    return float(s["variance"].toArray().mean() * (n - 1) / n) if n > 1 else 0.0


def _points(batch: pa.RecordBatch) -> np.ndarray:
    x = batch.column("x")
    return x.flatten().to_numpy().reshape(len(x), -1)


def _distances(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of rows to centres."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ centres.T + (centres * centres).sum(1), 0)


def _draw(mark: np.ndarray, seed: int, turn: int) -> np.ndarray:
    """A number in (0, 1] for each row, from a hash of its id, the seed and the turn."""
    h = mark.view(np.uint64) ^ np.uint64((seed * 1_000_003 + turn) * 0x9E3779B97F4A7C15 % (1 << 64))
    for _ in range(2):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((h ^ (h >> np.uint64(32))) >> np.uint64(11)).astype(np.float64) / (1 << 53) + 2.0 ** -54


def _next_centres(points: DataFrame, fits: list[KMeansFit], turn: int) -> dict[int, list[float]]:
    """One k-means++ draw for every fit: the row with the least exponential key, weighted by its squared distance."""
    wanted = [(f, fit.seed, fit.centres) for f, fit in enumerate(fits) if fit.k > turn]

    def run(batches):
        best: dict[int, tuple[float, np.ndarray]] = {}
        for batch in batches:
            x, mark = _points(batch), batch.column("mark").to_numpy()
            if not len(x):
                continue
            for f, seed, centres in wanted:
                weight = _distances(x, centres).min(1) if len(centres) else np.ones(len(x))
                with np.errstate(divide="ignore"):
                    key = -np.log(_draw(mark, seed, turn)) / weight
                k = int(np.argmin(key))
                if np.isfinite(key[k]) and (f not in best or key[k] < best[f][0]):
                    best[f] = (key[k], x[k])
        if best:
            yield pa.RecordBatch.from_pydict({"fit": pa.array(list(best), pa.int32()), "key": pa.array([b[0] for b in best.values()], pa.float64()),
                                              "x": pa.array([b[1].tolist() for b in best.values()], pa.list_(pa.float64()))})

    rows = points.mapInArrow(run, "fit int, key double, x array<double>").groupBy("fit").agg(F.min_by("x", "key").alias("x")).collect()
    return {r["fit"]: list(r["x"]) for r in rows}


def _sums(points: DataFrame, fits: list[KMeansFit], active: list[int]) -> dict[tuple[int, int], tuple[int, float, np.ndarray]]:
    """(rows, squared distances, sums) of every cluster of the active fits, in one pass."""
    own = [(f, fits[f].centres) for f in active]
    d = fits[active[0]].centres.shape[1]

    def run(batches):
        total: dict[int, np.ndarray] = {f: np.zeros((len(c), d + 2)) for f, c in own}
        for batch in batches:
            x = _points(batch)
            if not len(x):
                continue
            for f, centres in own:
                dist = _distances(x, centres)
                near = dist.argmin(1)
                part = np.zeros((len(x), len(centres)))
                part[np.arange(len(x)), near] = 1
                total[f][:, 0] += part.sum(0)
                total[f][:, 1] += np.bincount(near, dist[np.arange(len(x)), near], len(centres))
                total[f][:, 2:] += part.T @ x
        rows = [(f, k, t[k]) for f, t in total.items() for k in range(len(t)) if t[k, 0]]
        yield pa.RecordBatch.from_pydict({"fit": pa.array([r[0] for r in rows], pa.int32()), "cluster": pa.array([r[1] for r in rows], pa.int32()),
                                          "s": pa.array([r[2].tolist() for r in rows], pa.list_(pa.float64()))})

    parts = points.mapInArrow(run, "fit int, cluster int, s array<double>")
    rows = parts.groupBy("fit", "cluster").agg(*[F.sum(F.col("s")[j]).alias(f"s{j}") for j in range(d + 2)]).collect()
    return {(r["fit"], r["cluster"]): (int(r["s0"]), r["s1"], np.array([r[f"s{j + 2}"] for j in range(d)])) for r in rows}


def center_tolerance(k: int, mean_var: float, tol: float = TOL) -> float:
    """Spark's per-centre tolerance that matches the reference's relative ``tol``.

    The reference stops when the SUM over centres of squared centre shifts is
    at most ``tol x mean feature variance``; Spark stops when EVERY centre
    moved by at most its ``tol`` (a distance). A per-centre distance of
    sqrt(tol x mean_var / k) keeps the sum within the reference's bound.
    """
    return math.sqrt(tol * mean_var / k) if mean_var > 0 else tol


def fit_many(scaled: DataFrame, wanted: list[tuple[int, int]], max_iter: int = MAX_ITER, tol: float = TOL,
             start: list[np.ndarray] | None = None) -> list[KMeansFit]:
    """K-Means for every (k, seed), all in shared passes over the persisted frame.

    A fit ends when the sum of its squared centre shifts is at most ``tol``
    times the mean feature variance (the reference's rule); an emptied cluster
    keeps its centre. ``start`` gives first centres instead of drawing them.
    """
    points = scaled.select(F.xxhash64("id_cliente").alias("mark"), vector_to_array("features").alias("x"))
    limit = tol * mean_variance(scaled)
    fits = [KMeansFit(k, seed, np.zeros((0, 0)) if start is None else np.array(start[i], float)) for i, (k, seed) in enumerate(wanted)]
    if start is None:
        for turn in range(max((f.k for f in fits), default=0)):
            found = _next_centres(points, fits, turn)
            for i, f in enumerate(fits):
                if f.k > turn and (i in found or len(f.centres)):  # fewer different rows than k: a centre stands twice
                    row = np.array(found[i] if i in found else f.centres[-1])
                    f.centres = np.vstack([f.centres, row]) if len(f.centres) else row[None]
    active = [i for i, f in enumerate(fits) if len(f.centres)]
    for _ in range(max_iter):
        if not active:
            break
        sums = _sums(points, fits, active)
        for i in list(active):
            f = fits[i]
            moved = np.array([sums[i, c][2] / sums[i, c][0] if (i, c) in sums else f.centres[c] for c in range(f.k)])
            shift = float(((moved - f.centres) ** 2).sum())
            f.centres = moved
            if shift <= limit:
                active.remove(i)
    able = [i for i, f in enumerate(fits) if len(f.centres)]
    if able:
        cost = _sums(points, fits, able)
        for i in able:
            fits[i].inertia = float(sum(v[1] for (f, _), v in cost.items() if f == i))
    return fits


def _best(fits: list[KMeansFit]) -> KMeansFit:
    """Lowest within-cluster SS; the earliest seed on ties."""
    return min(fits, key=lambda f: (f.inertia, f.seed))


def fit_kmeans(scaled: DataFrame, k: int, n_init: int = N_INIT, seed: int = SEED,
               max_iter: int = MAX_ITER, tol: float = TOL) -> KMeansFit:
    """Best of ``n_init`` seeded K-Means runs (lowest within-cluster SS)."""
    return _best(fit_many(scaled, [(k, seed + i) for i in range(n_init)], max_iter, tol))


def silhouette(model: KMeansModel, scaled: DataFrame) -> float:
    ev = ClusteringEvaluator(featuresCol="features", predictionCol="cluster", metricName="silhouette",
                             distanceMeasure="squaredEuclidean")
    return ev.evaluate(model.transform(scaled))


def k_sweep(scaled: DataFrame, k_range=K_RANGE, n_init: int = N_INIT, seed: int = SEED,
            max_iter: int = MAX_ITER, parallelism: int | None = None) -> DataFrame:
    """(k, inertia, silhouette) for every k: one small row per k.

    All len(k_range) x n_init fits run in shared passes; the silhouettes of
    the best fits are independent jobs, ``parallelism`` at a time.
    """
    ks, spark = list(k_range), scaled.sparkSession
    fits = fit_many(scaled, [(k, seed + i) for k in ks for i in range(n_init)], max_iter)
    best = [_best([f for f in fits if f.k == k]) for k in ks]
    models = [f.model(spark) for f in best]
    sils = run_concurrently(spark, [lambda m=m: silhouette(m, scaled) for m in models], parallelism)
    rows = [(int(f.k), float(f.inertia), float(s)) for f, s in zip(best, sils)]
    return spark.createDataFrame(rows, "k int, inertia double, silhouette double")


def best_k(sweep: DataFrame) -> DataFrame:
    """Highest silhouette; the smallest k on ties."""
    return sweep.orderBy(F.desc("silhouette"), F.asc("k")).limit(1)


def stable_order(model: KMeansModel, columns: list[str] = SEGMENT_FEATURES,
                 order_feature: str = ORDER_FEATURE) -> list[int]:
    """Cluster index -> segment id, numbering clusters by one centre coordinate."""
    idx = columns.index(order_feature)
    centers = model.clusterCenters()
    ranked = sorted(range(len(centers)), key=lambda c: (-float(centers[c][idx]), c))
    mapping = [0] * len(centers)
    for seg_id, cluster in enumerate(ranked):
        mapping[cluster] = seg_id
    return mapping


def segment_model(c360: DataFrame, k: int, n_init: int = N_INIT, seed: int = SEED,
                  max_iter: int = MAX_ITER) -> PipelineModel:
    """Assembler + scaler + K-Means as one persistable PipelineModel."""
    scaler_model, scaled = prepare(c360)
    fit = fit_kmeans(scaled, k, n_init, seed, max_iter)
    scaled.unpersist()
    return PipelineModel(stages=list(scaler_model.stages) + [fit.model(c360.sparkSession)])


def assign_segments(c360: DataFrame, model: PipelineModel, stable: bool = True,
                    columns: list[str] = SEGMENT_FEATURES) -> DataFrame:
    """Add ``segmento_id`` and ``segmento_nombre`` to every customer."""
    km = model.stages[-1]
    scored = model.transform(c360.fillna(0, subset=columns))
    if stable:
        mapping = stable_order(km, columns)
        seg = F.element_at(F.array(*[F.lit(m) for m in mapping]), F.col("cluster") + 1)
    else:
        seg = F.col("cluster")
    out = scored.withColumn("segmento_id", seg.cast("int")).drop("raw_features", "features", "cluster")
    return lookups.segment_name(out)


def segment_profile(seg: DataFrame, columns: list[str] = SEGMENT_FEATURES, digits: int = 2) -> DataFrame:
    """Mean of each feature by segment name, rounded half-to-even."""
    return seg.groupBy("segmento_nombre").agg(
        *[F.bround(F.avg(c), digits).alias(c) for c in columns])


BOX_COLUMNS = ["monetary_total", "frequency", "recency_dias", "tasa_conversion_hist"]
WHISKER = 1.5


def segment_box(seg: DataFrame, columns: list[str] = BOX_COLUMNS, whisker: float = WHISKER) -> DataFrame:
    """Box-plot numbers by segment: quartiles, whiskers, outlier count."""
    long = seg.select("segmento_nombre", F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(c).cast("double").alias("x")) for c in columns
    ])).alias("p")).select("segmento_nombre", "p.variable", "p.x")
    keys = ["segmento_nombre", "variable"]
    q = exact_quantiles(long, "x", [0.25, 0.5, 0.75], group_cols=keys)
    qs = q.groupBy(*keys).agg(
        F.max(F.when(F.col("p") == 0.25, F.col("quantile"))).alias("q1"),
        F.max(F.when(F.col("p") == 0.5, F.col("quantile"))).alias("mediana"),
        F.max(F.when(F.col("p") == 0.75, F.col("quantile"))).alias("q3"))
    fences = qs.select(*keys, "q1", "mediana", "q3",
                       (F.col("q1") - whisker * (F.col("q3") - F.col("q1"))).alias("_lo"),
                       (F.col("q3") + whisker * (F.col("q3") - F.col("q1"))).alias("_hi"))
    inside = (F.col("x") >= F.col("_lo")) & (F.col("x") <= F.col("_hi"))
    # fences: one row per (segment, variable); measured before the broadcast
    # (derived from the quantile helper's checkpoint: no extra write)
    stats = (long.where(F.col("x").isNotNull()).join(bounded_broadcast(fences, checkpoint=False), keys)
                 .groupBy(*keys)
                 .agg(F.min(F.when(inside, F.col("x"))).alias("bigote_inf"),
                      F.max(F.when(inside, F.col("x"))).alias("bigote_sup"),
                      F.count_if(~inside).alias("n_atipicos")))
    return fences.drop("_lo", "_hi").join(stats, keys)


def segment_map(seg_scaled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """2-D PCA projection of the scaled features, and its mean per segment.

    ``seg_scaled`` has ``features`` and ``segmento_id``/``segmento_nombre``.
    """
    pca = PCA(k=2, inputCol="features", outputCol="pc").fit(seg_scaled)
    proj = pca.transform(seg_scaled).withColumn("_pc", vector_to_array("pc"))
    pts = proj.select("id_cliente", "segmento_id", "segmento_nombre",
                      F.col("_pc")[0].alias("x"), F.col("_pc")[1].alias("y"))
    centres = pts.groupBy("segmento_id", "segmento_nombre").agg(F.avg("x").alias("cx"), F.avg("y").alias("cy"))
    return pts, centres
