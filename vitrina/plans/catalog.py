"""Registry of named queries: key -> callable(spark, sf_dir) -> DataFrame.

Every query reads the driver tables through the fixture views and runs over
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from ..functions.columns import with_scalars
from ..operators import asof, cleaning, customer360, dataset, encoding, features, lookups
from ..session import ensure_checkpoint_dir, scratch_dir
from ..sources import csv as csv_source
from ..sources import fixtures, sinks

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(key: str):
    def register(fn: QueryFn) -> QueryFn:
        QUERIES[key] = fn
        return fn
    return register


def raw(spark: SparkSession, sf_dir: str) -> fixtures.RawTables:
    return fixtures.load_raw(spark, sf_dir)


def clean(spark, sf_dir) -> DataFrame:
    return cleaning.clean_clientes(fixtures.clientes(spark, sf_dir))


def c360(spark, sf_dir) -> DataFrame:
    r = raw(spark, sf_dir)
    return customer360.build_customer_360(cleaning.clean_clientes(r.clientes),
                                          r.transacciones, r.interacciones)


# --- sources ------------------------------------------------------------------
RAW_KEYS = {"clientes": "id_cliente", "transacciones": "id_transaccion", "interacciones": "id_interaccion"}


def csv_folder(spark: SparkSession, sf_dir: str, names=tuple(RAW_KEYS), spoil=None) -> str:
    """The raw tables written as CSV files (as text, with missing-value words, columns in another order)."""
    folder = scratch_dir(spark, f"csv-{sinks.new_run_id()}")
    for name in names:
        df = getattr(fixtures, name)(spark, sf_dir)
        fixtures.write_csv(spoil(name, df) if spoil else df, f"{folder}/{name}.csv", RAW_KEYS[name])
    return folder


def from_csv(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    folder = csv_folder(spark, sf_dir, (name,))
    return csv_source.read_checked(spark, f"{folder}/{name}.csv", csv_source.RAW_FILES[name], name)[0]


query("src_clientes")(lambda s, d: from_csv(s, d, "clientes"))
query("src_transacciones")(lambda s, d: from_csv(s, d, "transacciones"))
query("src_interacciones")(lambda s, d: from_csv(s, d, "interacciones"))


@query("raw_load")
def _raw_load(spark, sf_dir):
    """Rows that load and rows that don't, by table and column, from files in which some customers' scores and some visits' dates are no such values."""
    def spoil(name, df):
        if name == "clientes":
            return df.withColumn("score_credito_interno", F.when(F.col("antiguedad_meses") % 7 == 0, F.lit("alto")).otherwise(F.col("score_credito_interno").cast("string")))
        if name == "interacciones":
            return df.withColumn("fecha_visita", F.when(F.col("id_tienda") == "t3", F.lit("ayer")).otherwise(F.col("fecha_visita").cast("string")))
        return df

    tables, bad = csv_source.load_raw(spark, csv_folder(spark, sf_dir, spoil=spoil))
    good = [getattr(tables, name).agg(F.count(F.lit(1)).alias("filas")).select(F.lit(name).alias("tabla"), F.lit("").alias("columna"), "filas") for name in RAW_KEYS]
    return good[0].unionByName(good[1]).unionByName(good[2]).unionByName(csv_source.bad_row_counts(bad))

# --- cleaning -----------------------------------------------------------------
query("clean_phone")(lambda s, d: cleaning.phone_flag(fixtures.clientes(s, d))
                     .select("id_cliente", "celular_contacto", "tiene_celular_valido"))
query("clean_email")(lambda s, d: cleaning.email_flag(fixtures.clientes(s, d))
                     .select("id_cliente", "email_contacto", "tiene_email_valido"))
query("zone_median")(lambda s, d: cleaning.zone_median(fixtures.clientes(s, d)))
query("impute_zone")(lambda s, d: cleaning.impute_zone(fixtures.clientes(s, d))
                     .select("id_cliente", "zona_geografica", "score_credito_interno"))
query("impute_global")(lambda s, d: cleaning.impute_global(cleaning.impute_zone(fixtures.clientes(s, d)))
                       .select("id_cliente", "score_credito_interno"))
query("clean_clientes")(clean)

# --- purchase and visit features ----------------------------------------------
query("tx_ref_date")(lambda s, d: features.reference_date(fixtures.transacciones(s, d), "fecha_compra"))
for _key, _col in [("tx_recency", "recency_dias"), ("tx_frequency", "frequency"),
                   ("tx_monetary", "monetary_total"), ("tx_avg", "monetary_avg"),
                   ("tx_ticket_max", "ticket_max"), ("tx_diversity", "diversidad_categorias"),
                   ("tx_fav_category", "categoria_favorita"),
                   ("tx_usual_payment", "medio_pago_habitual"),
                   ("tx_uses_credit", "usa_credito_propio")]:
    query(_key)(lambda s, d, c=_col: features.build_tx_features(fixtures.transacciones(s, d))
                .select("id_cliente", c))
query("tx_features")(lambda s, d: features.build_tx_features(fixtures.transacciones(s, d)))

query("visit_ref_date")(lambda s, d: features.reference_date(fixtures.interacciones(s, d), "fecha_visita"))
for _key, _col in [("visit_total", "total_visitas"), ("visit_conversion", "tasa_conversion_hist"),
                   ("visit_service", "visitas_servicio_tecnico"), ("visit_quote", "visitas_cotizacion"),
                   ("visit_claim", "visitas_reclamo"), ("visit_instalment", "visitas_pago_cuota"),
                   ("visit_recency", "dias_desde_ultima_visita")]:
    query(_key)(lambda s, d, c=_col: features.build_visit_features(fixtures.interacciones(s, d))
                .select("id_cliente", c))
query("visit_features")(lambda s, d: features.build_visit_features(fixtures.interacciones(s, d)))
query("customer_360")(c360)

# --- sources, sinks, previews (2.1) -------------------------------------------
from . import rules  # noqa: E402


@query("na_normalise")
def _na_normalise(spark, sf_dir):
    """The customers with missing-value words in the places of their nulls, normalised."""
    clientes = fixtures.clientes(spark, sf_dir)
    clean = csv_source.normalise_na(fixtures.with_na_words(clientes, "id_cliente"))
    return clean.select(*[F.col(f.name).cast(f.dataType) for f in clientes.schema.fields])


def visit_table(spark, sf_dir, extra_cols=()):
    # Customer 360 (one row a customer) feeds the dictionary and the join: written once
    return dataset.build_visit_dataset(raw(spark, sf_dir).interacciones, c360(spark, sf_dir).checkpoint(), extra_cols=extra_cols)


@query("step_counts")
def _step_counts(spark, sf_dir):
    r = raw(spark, sf_dir)
    # each step is written once (checkpoint) and the next one reads it, so
    # counting six steps does not rebuild cleaning and Customer 360 each time
    cl = cleaning.clean_clientes(r.clientes).checkpoint()
    c = customer360.build_customer_360(cl, r.transacciones, r.interacciones).checkpoint()
    vd, _ = dataset.build_visit_dataset(r.interacciones, c)
    steps = [("clientes", r.clientes), ("transacciones", r.transacciones),
             ("interacciones", r.interacciones), ("clientes_clean", cl),
             ("customer_360", c), ("visit_dataset", vd)]
    out = None
    for name, df in steps:
        part = df.agg(F.count(F.lit(1)).alias("filas")).select(
            F.lit(name).alias("tabla"), "filas", F.lit(len(df.columns)).alias("columnas"))
        out = part if out is None else out.unionByName(part)
    return out


query("head_c360")(lambda s, d: c360(s, d).orderBy("id_cliente").limit(5))


@query("fill_numeric")
def _fill_numeric(spark, sf_dir):
    r = raw(spark, sf_dir)
    cl = cleaning.clean_clientes(r.clientes)
    joined = (cl.join(features.build_tx_features(r.transacciones), "id_cliente", "left")
                .join(features.build_visit_features(r.interacciones), "id_cliente", "left"))
    return customer360.fill_numeric(joined.select(*customer360.C360_COLUMNS))


@query("lookup_client")
def _lookup_client(spark, sf_dir):
    """Every customer id asked for by a visit, with its profile or a not-found flag."""
    r = raw(spark, sf_dir)
    c = customer360.build_customer_360(cleaning.clean_clientes(r.clientes), r.transacciones,
                                       r.interacciones)
    asked = r.interacciones.select("id_cliente").where(F.col("id_cliente").isNotNull()).distinct()
    prof = customer360.dedupe_by_key(c).select("id_cliente", "zona_geografica", "frequency",
                                               "monetary_total", F.lit(1).alias("_hit"))
    return (asked.join(prof, "id_cliente", "left")
                 .select("id_cliente", F.coalesce("_hit", F.lit(0)).alias("encontrado"),
                         "zona_geografica", "frequency", "monetary_total"))


def _sink(spark, sf_dir, which):
    r = raw(spark, sf_dir)
    base = scratch_dir(spark, f"sink-{sinks.new_run_id()}")
    cl = cleaning.clean_clientes(r.clientes)
    if which == "clean":
        sinks.save_processed(base, cl, r.transacciones, r.interacciones)
        return sinks.row_counts(spark, base, ["clientes_clean", "transacciones_clean",
                                              "interacciones_clean"])
    c = customer360.build_customer_360(cl, r.transacciones, r.interacciones)
    sinks.write_table(c, base, "customer_360")
    if which == "c360":
        return sinks.row_counts(spark, base, ["customer_360"])
    # scan: all rows, only the asked columns of the written parquet
    return sinks.read_table(spark, base, "customer_360").select("id_cliente", "frequency", "monetary_total")


query("sink_clean")(lambda s, d: _sink(s, d, "clean"))
query("sink_c360")(lambda s, d: _sink(s, d, "c360"))
query("scan_c360")(lambda s, d: _sink(s, d, "scan"))

# --- lookups (2.5) --------------------------------------------------------------
query("visit_join")(lambda s, d: dataset.visit_join(raw(s, d).interacciones, c360(s, d)))
query("next_category")(lambda s, d: lookups.next_category(
    c360(s, d).select("id_cliente", "categoria_favorita")))


def _rule_segments(spark, sf_dir):
    return c360(spark, sf_dir).select("id_cliente", rules.segment_rule().alias("segmento_id"))


query("segment_name")(lambda s, d: lookups.segment_name(_rule_segments(s, d)))
query("playbook")(lambda s, d: lookups.playbook(lookups.segment_name(_rule_segments(s, d)))
                  .select("id_cliente", "segmento_nombre", "lectura", "estrategia"))
query("reason_label")(lambda s, d: lookups.reason_label(
    raw(s, d).interacciones.select("id_interaccion", "motivo_visita")))

# --- training table (2.6) ---------------------------------------------------------
query("date_weekday")(lambda s, d: dataset.date_parts(raw(s, d).interacciones)
                      .select("id_interaccion", "dia_semana"))
query("date_month")(lambda s, d: dataset.date_parts(raw(s, d).interacciones)
                    .select("id_interaccion", "mes"))
query("date_payday")(lambda s, d: dataset.date_parts(raw(s, d).interacciones)
                     .select("id_interaccion", "es_quincena"))


query("ordinal_fit")(lambda s, d: dataset.visit_dictionary(raw(s, d).interacciones, c360(s, d)))


@query("ordinal_apply")
def _ordinal_apply(spark, sf_dir):
    visits, c = raw(spark, sf_dir).interacciones, c360(spark, sf_dir).checkpoint()
    coded = encoding.apply_dictionary(dataset.visit_join(visits, c), dataset.visit_dictionary(visits, c))
    return coded.select("id_interaccion", *encoding.CAT_COLS)


query("visit_dataset")(lambda s, d: visit_table(s, d)[0])
query("visit_asof")(lambda s, d: asof.visit_asof(raw(s, d).interacciones, raw(s, d).transacciones))


@query("visit_dataset_asof")
def _visit_dataset_asof(spark, sf_dir):
    """The training table without its look into the future: histories up to, not including, each visit."""
    r = raw(spark, sf_dir)
    before = asof.visit_histories(r.interacciones, r.transacciones)
    return asof.without_leak(visit_table(spark, sf_dir, tuple(asof.WHOSE))[0], before)


query("target_rate")(lambda s, d: dataset.target_rate(visit_table(s, d)[0]))

# --- profiling and quality (2.13) ----------------------------------------------
from ..functions.columns import EMAIL_PATTERN, PHONE_PATTERN  # noqa: E402
from ..operators import profiling  # noqa: E402

DQ_COMPLETENESS_COLS = ["id_cliente", "celular_contacto", "email_contacto", "score_credito_interno"]
DQ_PATTERNS = {"celular_contacto": PHONE_PATTERN, "email_contacto": EMAIL_PATTERN}


def _clientes_na(spark, sf_dir):
    return csv_source.normalise_na(fixtures.clientes(spark, sf_dir))


query("dq_completeness")(lambda s, d: profiling.completeness(_clientes_na(s, d), DQ_COMPLETENESS_COLS))
query("dq_validity")(lambda s, d: profiling.validity(_clientes_na(s, d), DQ_PATTERNS))
query("dq_uniqueness")(lambda s, d: profiling.uniqueness(_clientes_na(s, d), "id_cliente"))
query("dq_report")(lambda s, d: profiling.quality_report(_clientes_na(s, d), DQ_COMPLETENESS_COLS,
                                                         DQ_PATTERNS, "id_cliente"))
query("id_coverage")(lambda s, d: profiling.distinct_ids(
    {"clientes": raw(s, d).clientes, "transacciones": raw(s, d).transacciones,
     "interacciones": raw(s, d).interacciones}))
query("id_intersection")(lambda s, d: profiling.ids_in_all(
    [raw(s, d).clientes, raw(s, d).transacciones, raw(s, d).interacciones]))


@query("value_counts")
def _value_counts(spark, sf_dir):
    r = raw(spark, sf_dir)
    return profiling.value_counts([
        (r.clientes, ["zona_geografica"]),
        (r.transacciones, ["categoria_producto", "medio_pago"]),
        (r.interacciones, ["motivo_visita", "compro_en_visita"]),
    ])


query("histogram")(lambda s, d: profiling.histograms(raw(s, d).clientes,
                                                    ["antiguedad_meses", "score_credito_interno"]))
query("monthly_counts")(lambda s, d: profiling.monthly_counts(raw(s, d).transacciones, "fecha_compra",
                                                              "id_transaccion"))
query("conversion_by_reason")(lambda s, d: profiling.rate_by(raw(s, d).interacciones, "motivo_visita",
                                                             "compro_en_visita", "tasa_conversion"))


@query("correlation")
def _correlation(spark, sf_dir):
    c = c360(spark, sf_dir)
    return profiling.correlation_matrix(c, customer360.numeric_columns(c))

# --- evaluation on the fixed score rule (2.9) ------------------------------------
from ..operators import drift, evaluation  # noqa: E402


def scored_visits(spark, sf_dir):
    """(id_interaccion, y, score) with the fixed score rule over every visit."""
    j = dataset.visit_join(raw(spark, sf_dir).interacciones, c360(spark, sf_dir))
    return j.select("id_interaccion", F.col("compro_en_visita").alias("y"),
                    rules.score_rule().alias("score"))


query("auc")(lambda s, d: evaluation.auc(scored_visits(s, d)))
query("roc_curve")(lambda s, d: evaluation.roc_curve(scored_visits(s, d)))
query("pr_curve")(lambda s, d: evaluation.pr_curve(scored_visits(s, d)))
query("avg_precision")(lambda s, d: evaluation.average_precision(scored_visits(s, d)))
query("confusion")(lambda s, d: evaluation.confusion(scored_visits(s, d)))
query("class_report")(lambda s, d: evaluation.class_report(scored_visits(s, d)))
query("deciles")(lambda s, d: evaluation.deciles(scored_visits(s, d)))
query("lift_by_decile")(lambda s, d: evaluation.lift_by_decile(evaluation.deciles(scored_visits(s, d))))
query("top_lift")(lambda s, d: evaluation.top_lift(evaluation.deciles(scored_visits(s, d))))
query("top_row")(lambda s, d: evaluation.top_row(scored_visits(s, d), "id_interaccion"))

# --- drift between the two halves of the training table (2.12) -------------------
DRIFT_NUMERIC = [c for c in dataset.FEATURE_COLS if c not in encoding.CAT_COLS]
DRIFT_CATEGORICAL = list(encoding.CAT_COLS) + ["target"]


def drift_frame(spark, sf_dir):
    vd, _ = visit_table(spark, sf_dir, ("fecha_visita",))
    return drift.split_halves(vd.withColumnRenamed(dataset.TARGET, "target"), ["fecha_visita", dataset.KEY],
                              raw(spark, sf_dir).interacciones)


query("drift_split")(lambda s, d: drift_frame(s, d).select(dataset.KEY, "corte"))
query("drift_ks")(lambda s, d: drift.ks_statistics(drift_frame(s, d), DRIFT_NUMERIC))
query("drift_chi2")(lambda s, d: drift.chi2_statistics(drift_frame(s, d), DRIFT_CATEGORICAL))


def drift_results(spark, sf_dir):
    return drift.drift_table(drift_frame(spark, sf_dir), DRIFT_NUMERIC, DRIFT_CATEGORICAL)


query("drift_summary")(lambda s, d: drift.drift_summary(drift_results(s, d)))


@query("drift_sink")
def _drift_sink(spark, sf_dir):
    path = scratch_dir(spark, f"drift-{sinks.new_run_id()}")
    drift.write_drift(drift_results(spark, sf_dir), path)
    return spark.read.parquet(path)

@query("drift_tables")
def _drift_tables(spark, sf_dir):
    """Drift between two tables with text categories: cash purchases against all others."""
    tx = raw(spark, sf_dir).transacciones
    cash = F.coalesce(F.col("medio_pago") == "efectivo", F.lit(False))
    both = drift.between(tx.where(cash), tx.where(~cash), ["monto_pago", "categoria_producto", "medio_pago"])
    return drift.drift_table(both, ["monto_pago"], ["categoria_producto", "medio_pago"]).select(
        "columna", "test", F.bround("statistic", drift.STAT_DIGITS).alias("statistic"))

# --- segmentation (2.7) -------------------------------------------------------------
from ..operators import segmentation  # noqa: E402

# The reference's restarts (10) and k range (2..7).
Q_N_INIT = segmentation.N_INIT
Q_K = 5


query("seg_scaled")(lambda s, d: segmentation.zscore(c360(s, d), digits=9))


@query("kmeans_fit")
def _kmeans_fit(spark, sf_dir):
    c = c360(spark, sf_dir).checkpoint()
    _, scaled = segmentation.prepare(c)
    fit = segmentation.fit_kmeans(scaled, Q_K, n_init=Q_N_INIT)
    centres = [(i, float(fit.inertia), [float(v) for v in ctr])
               for i, ctr in enumerate(fit.centres)]
    scaled.unpersist()
    return spark.createDataFrame(centres, "cluster int, inertia double, centro array<double>")


def _sweep(spark, sf_dir):
    _, scaled = segmentation.prepare(c360(spark, sf_dir).checkpoint())
    result = segmentation.k_sweep(scaled, n_init=Q_N_INIT)  # a small local table: the fits have run
    scaled.unpersist()
    return result


query("k_sweep")(_sweep)
query("best_k")(lambda s, d: segmentation.best_k(_sweep(s, d)))


def segmented(spark, sf_dir, k=Q_K):
    c = c360(spark, sf_dir).checkpoint()
    model = segmentation.segment_model(c, k, n_init=Q_N_INIT)
    return segmentation.assign_segments(c, model), model


query("segments")(lambda s, d: segmented(s, d)[0].select("id_cliente", "segmento_id", "segmento_nombre"))


def _rule_segmented(spark, sf_dir):
    return lookups.segment_name(c360(spark, sf_dir).withColumn("segmento_id", rules.segment_rule()))


query("segment_profile")(lambda s, d: segmentation.segment_profile(_rule_segmented(s, d)))
query("segment_box")(lambda s, d: segmentation.segment_box(_rule_segmented(s, d)))


@query("segment_map")
def _segment_map(spark, sf_dir):
    seg, model = segmented(spark, sf_dir)
    feats = model.stages[0].transform(seg)
    feats = model.stages[1].transform(feats)
    return segmentation.segment_map(feats)[1]


@query("sink_c360_seg")
def _sink_c360_seg(spark, sf_dir):
    seg, _ = segmented(spark, sf_dir)
    base = scratch_dir(spark, f"seg-{sinks.new_run_id()}")
    sinks.write_table(seg, base, "customer_360_seg")
    return sinks.row_counts(spark, base, ["customer_360_seg"])

# --- propensity model (2.8) and explanation (2.10) ---------------------------------
from ..functions.concurrency import run_concurrently  # noqa: E402
from ..operators import explain, propensity  # noqa: E402
from . import training  # noqa: E402

# The reference fits and serves with given parameters; these are its notebook's 100 trees with the library's
# defaults. Only hpo, trial_log and run_summary search: its 50 trials x 5 folds over its ranges.
Q_PARAMS = {"n_estimators": 100}
Q_FLOW = training.FlowConfig()


def model_table(spark, sf_dir):
    """Training table with folds, checkpointed: every fit and fold reads it.

    The folds depend on the visits alone, so they are ranked while the table is built.
    """
    ensure_checkpoint_dir(spark)
    visits = raw(spark, sf_dir).interacciones
    (vd, _), folds = run_concurrently(spark, [lambda: visit_table(spark, sf_dir), lambda: propensity.fold_numbers(visits)])
    return vd.join(folds, dataset.KEY).checkpoint()


def search_results(tbl):
    return propensity.search(tbl, Q_FLOW.n_trials, Q_FLOW.n_folds, Q_FLOW.seed, Q_FLOW.search_space, Q_FLOW.batch)


def fitted(spark, sf_dir):
    tbl = model_table(spark, sf_dir)
    return propensity.fit(tbl, Q_PARAMS, Q_FLOW.seed), tbl


query("folds")(lambda s, d: propensity.add_folds(
    raw(s, d).interacciones.select(dataset.KEY, dataset.TARGET)).select(dataset.KEY, dataset.TARGET, "fold"))
query("cv_auc")(lambda s, d: propensity.cv_summary(
    propensity.cv_auc(model_table(s, d), Q_PARAMS, Q_FLOW.n_folds, Q_FLOW.seed)))
query("gbt_fit")(lambda s, d: propensity.feature_importances(s, fitted(s, d)[0]))


@query("score")
def _score(spark, sf_dir):
    model, tbl = fitted(spark, sf_dir)
    return propensity.score(model, tbl).select(dataset.KEY, dataset.TARGET, "score")


@query("hpo")
def _hpo_query(spark, sf_dir):
    res = search_results(model_table(spark, sf_dir))
    rows = [(i, {k: str(v) for k, v in p.items()}, v) for i, (p, v) in enumerate(res)]
    return spark.createDataFrame(rows, "number int, params map<string,string>, auc_mean double")


@query("model_eval")
def _model_eval(spark, sf_dir):
    """AUC, average precision and lift of the top decile of the fitted model: on its own rows and on held-out folds."""
    tbl = model_table(spark, sf_dir)
    binned = propensity.binned_table(tbl)
    model, held = propensity.fit_and_hold_out(binned, Q_PARAMS, Q_FLOW.n_folds, Q_FLOW.seed)
    own = propensity.score(model, tbl).select(F.col(dataset.TARGET).alias("y"), "score")

    def evaluated(name, scored):
        scored = scored.checkpoint()
        row = evaluation.auc(scored)
        for more in (evaluation.average_precision(scored), evaluation.top_lift(evaluation.deciles(scored))):
            row = with_scalars(row, more)
        return row.select(F.lit(name).alias("muestra"), "auc", "average_precision", "lift_top")

    # the samples are independent: their curves are worked out side by side
    inside, outside = run_concurrently(spark, [lambda: evaluated("dentro", own), lambda: evaluated("fuera", held.select("y", "score"))])
    return inside.unionByName(outside)


query("model_compare")(lambda s, d: propensity.compare_models(model_table(s, d)))


@query("model_roundtrip")
def _model_roundtrip(spark, sf_dir):
    """Save the model, load it back, and compare the two score columns."""
    from ..operators.boosting import BoostedTrees
    model, tbl = fitted(spark, sf_dir)
    path = scratch_dir(spark, f"model-{sinks.new_run_id()}")
    model.save(spark, path)
    loaded = BoostedTrees.load(spark, path)
    both = loaded.transform(model.transform(tbl, "a"), "b")
    return both.agg(F.count(F.lit(1)).alias("n"), F.max(F.abs(F.col("a") - F.col("b"))).alias("max_abs_diff"))


@query("importance")
def _importance(spark, sf_dir):
    model, tbl = fitted(spark, sf_dir)
    perm = explain.permutation_importance(model, tbl)        # importance = AUC drop
    gain = propensity.feature_importances(spark, model).withColumnRenamed("importance", "importance_gain")
    return perm.join(gain, "feature").orderBy(F.desc("importance"), "feature")


@query("shapley")
def _shapley(spark, sf_dir):
    model, tbl = fitted(spark, sf_dir)
    return explain.tree_shap(model, tbl)


@query("global_shap")
def _global_shap(spark, sf_dir):
    model, tbl = fitted(spark, sf_dir)
    return explain.global_shap(explain.tree_shap(model, tbl))


@query("explain_row")
def _explain_row(spark, sf_dir):
    model, tbl = fitted(spark, sf_dir)
    top = evaluation.top_row(propensity.score(model, tbl), dataset.KEY)
    row = tbl.join(F.broadcast(top.select(dataset.KEY)), dataset.KEY)  # one row
    return (explain.tree_shap(model, row).withColumn("base_value", F.lit(explain.base_margin(model)))
                   .orderBy(F.desc(F.abs("phi"))))

# --- next-best-action (2.11) ----------------------------------------------------------
from ..operators import scoring  # noqa: E402
from ..sources import artefacts  # noqa: E402
from ..streaming import nba_stream  # noqa: E402


def _found_requests(spark, sf_dir, c=None):
    return scoring.lookup(raw(spark, sf_dir).interacciones, c360(spark, sf_dir) if c is None else c)


def rule_recommendations(spark, sf_dir):
    """Recommendations with the fixed segment and score rules (exact checks)."""
    looked = _found_requests(spark, sf_dir).where(F.col("encontrado") == 1)
    seg = lookups.segment_name(looked.withColumn("segmento_id", rules.segment_rule()))
    seg = seg.withColumnRenamed("segmento_nombre", "segmento").withColumn("score", rules.score_rule())
    return scoring.finish(seg)


query("nba_lookup")(lambda s, d: _found_requests(s, d).select("id_interaccion", "id_cliente", "encontrado",
                                                              "error"))


@query("nba_features")
def _nba_features(spark, sf_dir):
    r, c = raw(spark, sf_dir), c360(spark, sf_dir).checkpoint()
    found = _found_requests(spark, sf_dir, c).where(F.col("encontrado") == 1)
    feats = scoring.serving_features(found, dataset.visit_dictionary(r.interacciones, c))
    return feats.select(dataset.KEY, *dataset.FEATURE_COLS)


query("nba_level")(lambda s, d: rule_recommendations(s, d).select("id_interaccion", "score_compra_hoy", "nivel"))
query("nba_action")(lambda s, d: rule_recommendations(s, d).select(
    "id_interaccion", "segmento", "nivel", "next_best_category", "accion_recomendada"))
query("opportunity")(lambda s, d: lookups.opportunity(rule_recommendations(s, d).select("id_interaccion", "nivel")))
query("category_title")(lambda s, d: c360(s, d).select(
    "id_cliente", "categoria_favorita", lookups.category_title("categoria_favorita").alias("categoria_titulo")))


@query("advisor_card")
def _advisor_card(spark, sf_dir):
    card = scoring.advisor_card(rule_recommendations(spark, sf_dir))
    return card.select("id_interaccion", "segmento", "lectura", "estrategia", "motivo_label_lower",
                       "opp_title", "opp_subtitle", "categoria_sugerida", "categoria_historica")


def publish_artefacts(spark, sf_dir) -> str:
    """Fit both models on whole tables and publish them with dictionary and profiles; the folder of the manifest.

    Customer 360 feeds several jobs (scaler, K-Means, training table, lookup),
    so it is checkpointed once to the shared checkpoint folder.
    """
    visits = raw(spark, sf_dir).interacciones
    c = c360(spark, sf_dir).checkpoint()

    def propensity_side():
        vd, dictionary = dataset.build_visit_dataset(visits, c)
        return propensity.fit(vd.checkpoint(), Q_PARAMS, Q_FLOW.seed), dictionary

    # the two models only share the checkpointed Customer 360: fit both at once
    seg_model, (prop_model, dictionary) = run_concurrently(
        spark, [lambda: segmentation.segment_model(c, Q_K, n_init=Q_N_INIT), propensity_side])
    base = scratch_dir(spark, f"artefacts-{sinks.new_run_id()}")
    artefacts.save(spark, base, seg_model, prop_model, dictionary, c)
    return base


def recommend_all(spark, visits, base):
    """Recommendations for all visits from published artefacts; nothing is fitted."""
    a = artefacts.load(spark, base)
    return scoring.recommend(visits, a.profiles, a.segmentation, a.propensity, a.dictionary)


def segment_all(spark, visits, base):
    """Segments of all visits of known customers from published artefacts; nothing is fitted."""
    a = artefacts.load(spark, base)
    found = scoring.lookup(visits, a.profiles).where(F.col("encontrado") == 1)
    return segmentation.assign_segments(found, a.segmentation).select("id_interaccion", "segmento_id", "segmento_nombre")


query("nba_segment")(lambda s, d: segment_all(s, raw(s, d).interacciones, publish_artefacts(s, d)))
query("nba_batch")(lambda s, d: recommend_all(s, raw(s, d).interacciones, publish_artefacts(s, d)))


@query("nba_stream")
def _nba_stream(spark, sf_dir):
    """Visits written as parquet files, scored by an availableNow stream."""
    a = artefacts.load(spark, publish_artefacts(spark, sf_dir))
    base = scratch_dir(spark, f"stream-{sinks.new_run_id()}")
    visits = raw(spark, sf_dir).interacciones
    visits.write.mode("overwrite").parquet(f"{base}/source")
    nba_stream.run_scoring_stream(spark, f"{base}/source", f"{base}/sink", f"{base}/checkpoint",
                                  a.profiles, a.segmentation, a.propensity, a.dictionary, max_files_per_trigger=2)
    return spark.read.parquet(f"{base}/sink")

# --- run records and the whole flow (2.1: O-S10, O-S11, O-S13) ------------------------
@query("run_log")
def _run_log(spark, sf_dir):
    """Cross-validate and fit the final model with the given parameters, and record the run."""
    binned = propensity.binned_table(model_table(spark, sf_dir))
    # the final model grows in the same scans as those of its folds
    model, held = propensity.fit_and_hold_out(binned, Q_PARAMS, Q_FLOW.n_folds, Q_FLOW.seed)
    cv = propensity.cv_summary(evaluation.auc(held, "score", "y", group_cols=["fold"])).first()
    base = scratch_dir(spark, f"runs-{sinks.new_run_id()}")
    model.save(spark, f"{base}/models/propension")
    return sinks.log_run(spark, base, Q_FLOW.experiment, Q_PARAMS, cv["auc_mean"], cv["auc_std"],
                         f"{base}/models/propension")


@query("trial_log")
def _trial_log(spark, sf_dir):
    base = scratch_dir(spark, f"trials-{sinks.new_run_id()}")
    return sinks.log_trials(spark, base, sinks.new_run_id(), search_results(model_table(spark, sf_dir)))


@query("run_summary")
def _run_summary(spark, sf_dir):
    base = scratch_dir(spark, f"flow-{sinks.new_run_id()}")
    return training.training_flow(spark, raw(spark, sf_dir), base, Q_FLOW)
