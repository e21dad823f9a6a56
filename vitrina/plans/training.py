"""End-to-end training flow: clean -> Customer 360 -> segments, and beside them
training table -> search -> final model and drift report -> run record.

Each derived table is written to the shared base folder and read back before
the next step, which cuts the lineage (a lost executor recomputes from the
written table, not from the raw scans) and leaves the artefacts the scoring
jobs load. Only scalars (best k, mean AUC) and the parameter list reach the
driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession

from ..functions.concurrency import run_concurrently
from ..operators import cleaning, customer360, dataset, drift, propensity, segmentation
from ..operators.evaluation import auc
from ..sources import artefacts, sinks
from ..sources.fixtures import RawTables


@dataclass
class FlowConfig:
    """Defaults are the reference's budgets (50 trials x 5 folds, 10 restarts)."""
    n_trials: int = 50
    n_folds: int = propensity.N_FOLDS
    n_init: int = segmentation.N_INIT
    k_range: list = field(default_factory=lambda: list(segmentation.K_RANGE))
    seed: int = 42
    batch: int = 10
    experiment: str = "propension_compra_visita"
    search_space: dict = field(default_factory=lambda: dict(propensity.SEARCH_SPACE))
    create_drift_report: bool = True


DRIFT_NUMERIC = [c for c in dataset.FEATURE_COLS if c not in ("zona_geografica", "motivo_visita", "id_tienda")]
DRIFT_CATEGORICAL = ["zona_geografica", "motivo_visita", "id_tienda", "target"]


def _materialise(spark: SparkSession, df: DataFrame, base: str, name: str) -> DataFrame:
    sinks.write_table(df, base, name)
    return sinks.read_table(spark, base, name)


def training_flow(spark: SparkSession, raw: RawTables, base: str,
                  cfg: FlowConfig | None = None) -> DataFrame:
    """Run every training step; return the one-row run summary."""
    cfg = cfg or FlowConfig()
    clean = cleaning.clean_clientes(raw.clientes)
    sinks.save_processed(base, clean, raw.transacciones, raw.interacciones)
    clean = sinks.read_table(spark, base, "clientes_clean")
    tx = sinks.read_table(spark, base, "transacciones_clean")
    visits = sinks.read_table(spark, base, "interacciones_clean")

    c360 = _materialise(spark, customer360.build_customer_360(clean, tx, visits), base, "customer_360")

    seg_path, model_path = (sinks.table_path(base, f"models/{name}") for name in ("segmentation", "propension"))
    run_id = sinks.new_run_id()

    def segments() -> int:
        scaler_model, scaled = segmentation.prepare(c360)
        sweep = segmentation.k_sweep(scaled, cfg.k_range, cfg.n_init, cfg.seed)
        sweep = _materialise(spark, sweep, base, "k_sweep")
        best_k = int(segmentation.best_k(sweep).first()["k"])
        km = segmentation.fit_kmeans(scaled, best_k, cfg.n_init, cfg.seed)
        scaled.unpersist()
        seg_model = PipelineModel(stages=list(scaler_model.stages) + [km.model(spark)])
        seg_model.write().overwrite().save(seg_path)
        _materialise(spark, segmentation.assign_segments(c360, seg_model), base, "customer_360_seg")
        return best_k

    def training_table() -> DataFrame:
        vd, dictionary = dataset.build_visit_dataset(visits, c360, extra_cols=("fecha_visita",))
        _materialise(spark, dictionary, base, "encoder_dictionary")
        return _materialise(spark, propensity.add_folds(vd, cfg.n_folds, cfg.seed, keys=visits), base, "training_table").persist()

    def searched(table: DataFrame) -> tuple[dict, Row]:
        binned = propensity.binned_table(table)
        results = propensity.search(table, cfg.n_trials, cfg.n_folds, cfg.seed, cfg.search_space, cfg.batch, binned)
        sinks.log_trials(spark, base, run_id, results)
        best_params, _ = propensity.best_trial(results)
        # the final model grows beside those of its folds
        model, held = propensity.fit_and_hold_out(binned, best_params, cfg.n_folds, cfg.seed)
        cv = propensity.cv_summary(auc(held, "score", "y", group_cols=["fold"])).first()
        model.save(spark, model_path)
        return best_params, cv

    def drifted(table: DataFrame) -> str | None:
        if not cfg.create_drift_report:
            return None
        halves = drift.split_halves(table.withColumnRenamed(dataset.TARGET, "target"),
                                    ["fecha_visita", dataset.KEY], visits)
        return drift.write_drift(drift.drift_table(halves, DRIFT_NUMERIC, DRIFT_CATEGORICAL),
                                 sinks.table_path(base, "drift"))

    def modelled() -> tuple[tuple[dict, Row], str | None]:
        table = training_table()
        found = run_concurrently(spark, [lambda: searched(table), lambda: drifted(table)])
        table.unpersist()
        return found

    # segments, search and drift need nothing of each other: their jobs share the cluster
    ((best_params, cv), drift_path), best_k = run_concurrently(spark, [modelled, segments])
    artefacts.publish(spark, base, run_id, seg_path, model_path,
                      sinks.table_path(base, "encoder_dictionary"), sinks.table_path(base, "customer_360"))
    sinks.log_run(spark, base, cfg.experiment, best_params, cv["auc_mean"], cv["auc_std"], model_path)

    row = [(cfg.experiment, run_id, best_k, float(cv["auc_mean"]), float(cv["auc_std"]), drift_path,
            model_path, sinks.table_path(base, "customer_360"))]
    return spark.createDataFrame(row, "experiment_name string, run_id string, best_k int, auc_mean double, "
                                      "auc_std double, drift_report_path string, model_path string, "
                                      "customer_360_path string")
