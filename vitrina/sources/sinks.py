"""Parquet sinks and scans for the derived tables, and small run records.

Paths live under a base folder that must be shared storage on a cluster
(``session.scratch_dir`` puts them below ``spark.checkpoint.dir``). Writes are
``overwrite`` of a whole table; a table is never read and overwritten in the
same job, so Customer 360 with segments goes to its own path.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("clientes_clean", "transacciones_clean", "interacciones_clean",
          "customer_360", "customer_360_seg")


def table_path(base: str, name: str) -> str:
    return f"{base.rstrip('/')}/{name}"


def write_table(df: DataFrame, base: str, name: str, partition_by: list[str] | None = None) -> str:
    path = table_path(base, name)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return path


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(base, name))


def remove_dir(spark: SparkSession, path: str | None) -> None:
    """Delete a folder of the shared storage that its writer no longer needs."""
    if path:
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def save_processed(base: str, clientes_clean: DataFrame, transacciones: DataFrame,
                   interacciones: DataFrame) -> dict[str, str]:
    return {
        "clientes_clean": write_table(clientes_clean, base, "clientes_clean"),
        "transacciones_clean": write_table(transacciones, base, "transacciones_clean"),
        "interacciones_clean": write_table(interacciones, base, "interacciones_clean"),
    }


def row_counts(spark: SparkSession, base: str, names) -> DataFrame:
    """(tabla, filas) of written tables, counted by Spark from the files."""
    parts = [read_table(spark, base, n).agg(F.count(F.lit(1)).alias("filas"))
             .select(F.lit(n).alias("tabla"), "filas") for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


RUNS_SCHEMA = ("run_id string, ts timestamp, experiment string, params map<string,string>, "
               "auc_mean double, auc_std double, model_path string")
TRIALS_SCHEMA = "run_id string, number int, params map<string,string>, value double"


def log_run(spark: SparkSession, base: str, experiment: str, params: dict, auc_mean: float,
            auc_std: float, model_path: str) -> DataFrame:
    """Append one row to the ``runs`` table (the experiment-tracking record)."""
    row = [(uuid.uuid4().hex, None, experiment, {k: json.dumps(v) if not isinstance(v, str) else v
                                                  for k, v in params.items()},
            float(auc_mean), float(auc_std), model_path)]
    df = (spark.createDataFrame(row, RUNS_SCHEMA)
               .withColumn("ts", F.current_timestamp()))
    df.write.mode("append").parquet(table_path(base, "runs"))
    return spark.read.parquet(table_path(base, "runs"))


def log_trials(spark: SparkSession, base: str, run_id: str, trials: list[tuple[dict, float]]) -> DataFrame:
    """Append the search trials and return them with the running best value."""
    rows = [(run_id, i, {k: str(v) for k, v in p.items()}, float(v)) for i, (p, v) in enumerate(trials)]
    spark.createDataFrame(rows, TRIALS_SCHEMA).write.mode("append").parquet(table_path(base, "trials"))
    from pyspark.sql import Window
    t = spark.read.parquet(table_path(base, "trials")).where(F.col("run_id") == run_id)
    w = Window.partitionBy("run_id").orderBy("number").rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("best_so_far", F.max("value").over(w))


def new_run_id() -> str:
    return f"{int(time.time())}-{uuid.uuid4().hex[:8]}"
