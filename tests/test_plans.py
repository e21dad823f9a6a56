"""Plan-shape checks for the scale properties (no cross joins, column pruning,
a bucketed profile table that only the visits are shuffled to)."""

from pyspark.sql import functions as F

from vitrina.functions.skew import split_left_join
from vitrina.operators import customer360, features, scoring
from vitrina.plans import catalog
from vitrina.session import scratch_dir

from .conftest import SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_purchases_are_added_up_before_they_are_repeated(spark):
    r = catalog.raw(spark, SMALL)
    plan = _plan(features.tx_aggregates(r.transacciones))
    assert plan.index("Generate") < plan.rindex("HashAggregate")  # the plan is printed from its last step


def test_customer_360_has_no_cross_join_and_reads_purchases_once(spark):
    r = catalog.raw(spark, SMALL)
    plan = _plan(features.tx_aggregates(r.transacciones))
    # each raw table once; the purchase view needs 6 lineitem columns; comments and the like are never read
    for table in ("lineitem", "orders", "part"):
        scans = [line for line in plan.splitlines() if f"{table}.parquet" in line]
        assert len(scans) == 1 and "_comment" not in scans[0]
    assert "ObjectHashAggregate" not in plan
    whole = _plan(catalog.QUERIES["customer_360"](spark, SMALL))
    assert "CartesianProduct" not in whole + plan and "BroadcastNestedLoopJoin" not in whole + plan
    assert "lineitem.parquet" not in whole          # the written aggregate is read instead


def test_hot_customer_is_split_over_tasks(spark):
    visits = spark.range(20_000).select(
        F.concat(F.lit("int_"), F.col("id")).alias("id_interaccion"),
        F.when(F.col("id") % 10 < 6, "hot").when(F.col("id") % 10 == 6, F.lit(None)).otherwise(F.concat(F.lit("c"), F.col("id") % 97)).alias("id_cliente"))
    people = spark.createDataFrame([("hot", 1), *((f"c{k}", k) for k in range(90))], "id_cliente string, v int")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        joined = split_left_join(visits, people, "id_cliente", "id_interaccion").cache()
        plain = visits.join(people, "id_cliente", "left")
        assert sorted(map(str, joined.select("id_interaccion", "id_cliente", "v").collect())) == \
            sorted(map(str, plain.select("id_interaccion", "id_cliente", "v").collect()))
        sizes = joined.groupBy(F.spark_partition_id()).count().collect()
        assert max(r["count"] for r in sizes) < 0.3 * 20_000       # 60 % of the visits are one customer's
    finally:
        joined.unpersist()
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_split_join_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "id_cliente string, x string")
    people = spark.createDataFrame([("a", 1)], "id_cliente string, v int")
    assert split_left_join(empty, people, "id_cliente", "x").collect() == []
    assert split_left_join(people.withColumn("x", F.lit("1")), empty.drop("x"), "id_cliente", "x").count() == 1


def test_stream_profiles_are_bucketed_so_only_visits_shuffle(spark):
    c = catalog.c360(spark, SMALL)
    prof = scoring.keyed_profiles(c, scratch_dir(spark, "test-keyed-profiles"), "perfiles_test_plan")
    visits = catalog.raw(spark, SMALL).interacciones
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = scoring.lookup(visits, prof, split_hot=False)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS perfiles_test_plan")
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(exchanges) == 1                      # the visits, not the profile table
    assert "SortMergeJoin" in plan


def test_dedupe_keeps_one_row_per_key_on_bucketed_table(spark):
    c = catalog.c360(spark, SMALL)
    doubled = c.unionByName(c)
    prof = scoring.keyed_profiles(doubled, scratch_dir(spark, "test-keyed-dupes"), "perfiles_test_dupes")
    try:
        assert prof.count() == customer360.dedupe_by_key(c).count()
    finally:
        spark.sql("DROP TABLE IF EXISTS perfiles_test_dupes")


def test_run_log_grows_its_final_model_beside_the_folds(spark, monkeypatch):
    from vitrina.operators import propensity

    grown, own = [], propensity.fit_many
    monkeypatch.setattr(propensity, "fit_many", lambda binned, fits: grown.append(fits) or own(binned, fits))
    monkeypatch.setattr(catalog, "Q_PARAMS", {"n_estimators": 3, "max_depth": 2})
    (run,) = catalog.QUERIES["run_log"](spark, SMALL).collect()
    assert [[f.fold for f in fits] for fits in grown] == [[0, 1, 2, 3, 4, None]]
    table = catalog.model_table(spark, SMALL)
    (cv,) = propensity.cv_summary(propensity.cv_auc(table, catalog.Q_PARAMS)).collect()
    assert abs(run["auc_mean"] - cv["auc_mean"]) < 1e-12 and abs(run["auc_std"] - cv["auc_std"]) < 1e-12
