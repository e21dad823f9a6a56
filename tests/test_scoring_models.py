"""Scoring rules, encoder, models and stream = batch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from vitrina.functions.columns import level, payday_flag, weekday0
from vitrina.operators import (boosting, customer360, cleaning, dataset, encoding, evaluation, explain, propensity,
                               scoring, segmentation)
from vitrina.session import scratch_dir
from vitrina.sources import fixtures
from vitrina.streaming import nba_stream

from .conftest import SMALL


def test_levels_and_rounding(spark):
    df = spark.createDataFrame([(0.35,), (0.350001,), (0.6,), (0.600001,), (None,), (float("nan"),),
                                (0.0625,)], "score double")
    out = [(r["nivel"], r["score_compra_hoy"]) for r in scoring.with_level(df).collect()]
    assert [o[0] for o in out] == ["BAJO", "MEDIO", "MEDIO", "ALTO", "BAJO", "BAJO", "BAJO"]
    assert out[6][1] == 0.062                      # half-to-even like Python's round


def test_action_text(spark):
    df = spark.createDataFrame([("VIP Comprador", "lavado", "ALTO"), ("Segmento 6", "coccion", "BAJO")],
                               "segmento string, next_best_category string, nivel string")
    out = [r["accion_recomendada"] for r in scoring.action_text(df).orderBy("segmento").collect()]
    assert out == ["Recomendar coccion - prioridad baja, no presionar",
                   "Ofrecer lavado premium con garantia extendida"]


def test_next_category_default(spark):
    from vitrina.operators import lookups
    df = spark.createDataFrame([("a", "lavado"), ("b", None), ("c", "otros")], "id string, categoria_favorita string")
    out = {r["id"]: r["next_best_category"] for r in lookups.next_category(df).collect()}
    assert out == {"a": "coccion", "b": "refrigeracion", "c": "refrigeracion"}


def test_encoder_unseen_and_null(spark):
    train = spark.createDataFrame([("t2",), ("t1",), (None,)], "id_tienda string")
    d = encoding.fit_dictionary(train, ["id_tienda"])
    assert {r["valor"]: r["codigo"] for r in d.collect()} == {"t1": 0, "t2": 1}
    serve = spark.createDataFrame([("t1",), ("t9",), (None,)], "id_tienda string")
    tr = [r["id_tienda"] for r in encoding.apply_dictionary(serve, d, ["id_tienda"]).collect()]
    sv = [r["id_tienda"] for r in encoding.apply_dictionary(serve, d, ["id_tienda"], null_code=-1).collect()]
    assert sorted(tr) == [-1, 0, 0] and sorted(sv) == [-1, -1, 0]


def test_date_parts(spark):
    days = [dt.datetime(2024, 1, d) for d in (1, 7, 13, 14, 16, 17, 27, 28, 31)]
    df = spark.createDataFrame([(d,) for d in days], "ts timestamp_ntz")
    out = df.select(weekday0("ts").alias("w"), payday_flag("ts").alias("q")).collect()
    assert out[0]["w"] == 0 and out[1]["w"] == 6          # Monday 0, Sunday 6
    assert [r["q"] for r in out] == [0, 0, 0, 1, 1, 0, 0, 1, 1]


@pytest.fixture(scope="module")
def trained(spark):
    r = fixtures.load_raw(spark, SMALL)
    c = customer360.build_customer_360(cleaning.clean_clientes(r.clientes), r.transacciones, r.interacciones)
    vd, dictionary = dataset.build_visit_dataset(r.interacciones, c)
    tbl = propensity.add_folds(vd).persist()
    model = propensity.fit(tbl, {"n_estimators": 15, "max_depth": 3})
    seg_model = segmentation.segment_model(c, 4, n_init=2)
    return r, c, tbl, dictionary, model, seg_model


def test_folds_balanced(trained):
    _, _, tbl, *_ = trained
    counts = tbl.groupBy(dataset.TARGET, "fold").count().collect()
    for y in (0, 1):
        ns = [r["count"] for r in counts if r[dataset.TARGET] == y]
        assert len(ns) == 5 and max(ns) - min(ns) <= 1


def test_gbt_beats_chance_and_roundtrip(spark, trained):
    _, _, tbl, _, model, _ = trained
    scored = propensity.score(model, tbl)
    a = evaluation.auc(scored, "score", dataset.TARGET).first()["auc"]
    assert a > 0.6
    path = scratch_dir(spark, "test-model")
    model.save(spark, path)
    again = propensity.score(boosting.BoostedTrees.load(spark, path), tbl)
    diff = (scored.select(dataset.KEY, F.col("score").alias("a"))
                  .join(again.select(dataset.KEY, F.col("score").alias("b")), dataset.KEY)
                  .agg(F.max(F.abs(F.col("a") - F.col("b")))).first()[0])
    assert diff == 0.0


def test_cv_auc_in_range(trained):
    _, _, tbl, *_ = trained
    s = propensity.cv_summary(propensity.cv_auc(tbl, {"n_estimators": 5})).first()
    assert 0.5 < s["auc_mean"] <= 1 and s["n_folds"] == 5


def test_segments_non_empty_and_seeded(trained):
    _, c, _, _, _, seg_model = trained
    seg = segmentation.assign_segments(c, seg_model)
    assert seg.count() == c.count()
    assert seg.select("segmento_id").distinct().count() == 4
    again = segmentation.segment_model(c, 4, n_init=2)
    a = segmentation.assign_segments(c, again)
    assert (seg.select("id_cliente", F.col("segmento_id").alias("x"))
               .join(a.select("id_cliente", F.col("segmento_id").alias("y")), "id_cliente")
               .where("x != y").count()) == 0


def test_shapley_sums_to_score_minus_background(spark, trained):
    _, _, tbl, _, model, _ = trained
    phi = explain.shapley(model, tbl, samples=2)
    total = phi.groupBy(dataset.KEY).agg(F.sum("phi").alias("s"))
    fx = propensity.score(model, tbl).select(dataset.KEY, F.col("score").alias("fx"))
    d = explain.donors(tbl, dataset.FEATURE_COLS, 2)
    bg = propensity.score(model, d.select(dataset.KEY, "sample", *[F.col(f"d_{c}").alias(c)
                                                                  for c in dataset.FEATURE_COLS]))
    fz = bg.groupBy(dataset.KEY).agg(F.avg("score").alias("fz"))
    worst = (total.join(fx, dataset.KEY).join(fz, dataset.KEY)
                  .agg(F.max(F.abs(F.col("s") - (F.col("fx") - F.col("fz"))))).first()[0])
    assert worst < 1e-9


def test_stream_equals_batch_and_drops_repeats(spark, trained):
    r, c, _, dictionary, model, seg_model = trained
    base = scratch_dir(spark, "test-stream")
    visits = r.interacciones
    visits.repartition(3).write.mode("overwrite").parquet(f"{base}/source")
    visits.limit(20).write.mode("append").parquet(f"{base}/source")          # repeated request ids
    nba_stream.run_scoring_stream(spark, f"{base}/source", f"{base}/sink", f"{base}/ckpt",
                                  c, seg_model, model, dictionary)
    streamed = spark.read.parquet(f"{base}/sink").drop("batch_id")
    batch = scoring.recommend(visits, c, seg_model, model, dictionary)
    assert streamed.count() == visits.count()
    assert streamed.select(dataset.KEY).distinct().count() == visits.count()
    cols = sorted(batch.columns)
    a = sorted(tuple(r) for r in streamed.select(*cols).collect())
    b = sorted(tuple(r) for r in batch.select(*cols).collect())
    assert a == b


def test_many_batches_answer_every_visit_once(spark, trained):
    r, c, _, dictionary, model, seg_model = trained
    base = scratch_dir(spark, "test-stream-many")
    visits = r.interacciones
    visits.repartition(8).write.mode("overwrite").parquet(f"{base}/source")   # visit dates in no order
    visits.limit(20).write.mode("append").parquet(f"{base}/source")
    nba_stream.run_scoring_stream(spark, f"{base}/source", f"{base}/sink", f"{base}/ckpt",
                                  c, seg_model, model, dictionary, max_files_per_trigger=1)
    streamed = spark.read.parquet(f"{base}/sink")
    assert streamed.select("batch_id").distinct().count() >= 8
    assert streamed.count() == streamed.select(dataset.KEY).distinct().count() == visits.count()


def test_batches_read_a_constant_number_of_rows_and_a_restart_answers_once(spark, trained):
    r, c, _, dictionary, model, seg_model = trained
    base = scratch_dir(spark, "test-stream-rows")
    visits = r.interacciones

    def run():
        return nba_stream.run_scoring_stream(spark, f"{base}/source", f"{base}/sink", f"{base}/ckpt", c, seg_model, model, dictionary, max_files_per_trigger=1)

    visits.repartition(20).write.mode("overwrite").parquet(f"{base}/source")
    progress = [p for p in run() if p["numInputRows"]]
    rows = [p["numInputRows"] for p in progress]
    assert len(rows) == 20 and max(rows) <= 1.5 * visits.count() / 20          # its own files, nothing of the sink
    assert all(p["stateOperators"][0]["numRowsUpdated"] <= p["numInputRows"] for p in progress)
    visits.limit(50).write.mode("append").parquet(f"{base}/source")            # repeats, after a restart
    assert sum(p["stateOperators"][0]["numRowsUpdated"] for p in run() if p["stateOperators"]) == 0
    streamed = spark.read.parquet(f"{base}/sink")
    assert streamed.count() == streamed.select(dataset.KEY).distinct().count() == visits.count()


def test_unknown_customers_are_blanked_in_one_pass(spark, trained):
    r, c, _, dictionary, model, seg_model = trained
    known = r.interacciones.where("id_cliente IS NOT NULL").limit(3)
    odd = known.withColumn("id_cliente", F.lit("nobody")).unionByName(known.limit(1).withColumn("id_cliente", F.lit(None).cast("string")))
    out = scoring.recommend(odd, c, seg_model, model, dictionary)
    rows = out.collect()
    assert len(rows) == 4 and all(r["error"].endswith("no encontrado") for r in rows)
    assert all(r[k] is None for r in rows for k in ("segmento", "score_compra_hoy", "nivel", "next_best_category", "accion_recomendada"))
    plan = scoring.recommend(known, c, seg_model, model, dictionary, split_hot=False)._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan


def test_replayed_stream_batch_is_written_once(spark):
    base = scratch_dir(spark, "test-replay")
    rows = spark.range(10).withColumnRenamed("id", "x")
    nba_stream.write_batch(rows, f"{base}/sink", 0)
    nba_stream.write_batch(rows.where("x < 4"), f"{base}/sink", 1)
    nba_stream.write_batch(rows, f"{base}/sink", 0)          # batch 0 replayed
    out = spark.read.parquet(f"{base}/sink")
    assert out.where("batch_id = 0").count() == 10
    assert out.where("batch_id = 1").count() == 4


def test_importance_report_has_unique_columns_and_ranks_by_auc_drop(spark):
    import __spark_entry__ as entry
    df = entry.queries()["importance"](spark, "/root/testdata/sf0.001")
    assert len(df.columns) == len(set(df.columns))
    drops = [r["importance"] for r in df.collect()]
    assert len(drops) == 20 and drops == sorted(drops, reverse=True)


def test_search_keys_run_the_references_budgets_and_the_others_the_given_parameters(spark, monkeypatch):
    from vitrina.operators import tpe
    from vitrina.plans import catalog, training
    seen, real = {}, propensity.fit_many

    def fit_many(binned, fits):
        seen.setdefault("fits", []).extend(fits)
        return real(binned, [boosting.Fit({"n_estimators": 1, "max_depth": 2}, f.fold) for f in fits])

    monkeypatch.setattr(propensity, "fit_many", fit_many)
    monkeypatch.setattr(training, "training_flow", lambda spark, raw, base, cfg: seen.update(flow=cfg))
    catalog.QUERIES["hpo"](spark, SMALL)
    fits = seen.pop("fits")
    assert len(fits) == 250 and sorted(f.fold for f in fits) == sorted(list(range(5)) * 50)
    for f in fits:
        for name, (lo, hi, _) in propensity.SEARCH_SPACE.items():
            assert lo <= f.params[name] <= hi
    assert [f.params for f in fits[:50:5]] == tpe.suggest([], 10, propensity.SEARCH_SPACE)
    catalog.QUERIES["gbt_fit"](spark, SMALL)
    assert [(f.params, f.fold) for f in seen["fits"]] == [({"n_estimators": 100}, None)]
    catalog.QUERIES["run_summary"](spark, SMALL)
    assert seen["flow"] == training.FlowConfig() and training.FlowConfig().n_trials == 50


def test_the_flows_final_model_grows_with_its_folds_and_its_parts_side_by_side(spark, monkeypatch):
    import threading
    from vitrina.operators import segmentation
    from vitrina.plans import training
    from vitrina.sources import fixtures, sinks
    calls, both = [], threading.Barrier(2, timeout=300)

    def fit_many(binned, fits, own=propensity.fit_many):
        if not calls:
            both.wait()  # the sweep has begun too
        calls.append([f.fold for f in fits])
        return own(binned, fits)

    def k_sweep(*a, own=segmentation.k_sweep):
        both.wait()
        return own(*a)

    monkeypatch.setattr(propensity, "fit_many", fit_many)
    monkeypatch.setattr(segmentation, "k_sweep", k_sweep)
    cfg = training.FlowConfig(n_trials=2, n_init=1, k_range=[2, 3], batch=2, search_space={"n_estimators": (2, 4, "int"), "max_depth": (2, 3, "int")})
    base = scratch_dir(spark, f"flow-{sinks.new_run_id()}")
    row = training.training_flow(spark, fixtures.load_raw(spark, SMALL), base, cfg).first()
    assert calls == [[0, 1, 2, 3, 4] * 2, [0, 1, 2, 3, 4, None]]
    table = sinks.read_table(spark, base, "training_table")
    trials = sinks.read_table(spark, base, "trials").collect()
    assert len(trials) == 2 and row["best_k"] in (2, 3) and row["drift_report_path"]
    model = boosting.BoostedTrees.load(spark, row["model_path"])
    want = propensity.cv_summary(propensity.cv_auc(table, {k: int(model.params[k]) for k in cfg.search_space})).first()
    assert (row["auc_mean"], row["auc_std"]) == pytest.approx((want["auc_mean"], want["auc_std"]))
