"""Scoring of arriving visits with Structured Streaming.

Visits arrive as parquet files in a folder. Every visit is answered once,
however late it is: the answered request ids are the keyed state of the stream
(``dropDuplicates`` without a watermark, in the RocksDB state store, kept below
the checkpoint folder), so a micro-batch looks up only its own ids and reads
nothing of what earlier batches wrote. Each micro-batch is scored by the same
batch code as ``scoring.recommend``, in one pass, and written to its own
``batch_id`` partition of a parquet sink; a micro-batch replayed after a failure
starts from the state before it and overwrites its own partition (exactly-once
output). A restarted query resumes where it stopped; ``availableNow`` processes
what is there and stops.
"""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.sizing import bounded_broadcast
from ..operators import scoring
from ..operators.boosting import BoostedTrees
from ..session import scratch_dir
from ..sources import sinks

VISIT_STREAM_SCHEMA = ("id_interaccion string, id_cliente string, id_tienda string, "
                       "fecha_visita timestamp_ntz, motivo_visita string, compro_en_visita int")
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass",
               "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


def visit_stream(spark: SparkSession, source_dir: str,
                 max_files_per_trigger: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(VISIT_STREAM_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(source_dir)


def once(stream: DataFrame) -> DataFrame:
    """Each request id the first time it arrives."""
    return stream.dropDuplicates(["id_interaccion"])


def write_batch(rows: DataFrame, sink_dir: str, batch_id: int) -> None:
    """Write one micro-batch into its own ``batch_id`` partition.

    Idempotent: a batch replayed after a failure replaces its partition
    instead of appending its rows a second time.
    """
    (rows.withColumn("batch_id", F.lit(batch_id)).write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("batch_id").parquet(sink_dir))


def run_scoring_stream(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint_dir: str,
                       c360: DataFrame, seg_model: PipelineModel, prop_model: BoostedTrees,
                       dictionary: DataFrame,
                       max_files_per_trigger: int | None = None) -> list[dict]:
    """Run until every file present at start is scored (``availableNow``); returns the batches' progress records.

    The static sides are prepared once, before the first batch: Customer 360
    as a table bucketed on the customer key (so a batch never re-shuffles
    it) and the encoder dictionary with its broadcast size already checked.
    """
    run = sinks.new_run_id()
    table = "perfiles_" + run.replace("-", "_")
    profiles = scoring.keyed_profiles(c360, scratch_dir(spark, f"profiles-{run}"), table)
    sized_dictionary = bounded_broadcast(dictionary)
    stream = once(visit_stream(spark, source_dir, max_files_per_trigger))

    def score_batch(batch: DataFrame, batch_id: int) -> None:
        rec = scoring.recommend(batch, profiles, seg_model, prop_model, sized_dictionary,
                                sized_dictionary=True, split_hot=False)
        write_batch(rec, sink_dir, batch_id)

    store = spark.conf.get(STATE_STORE[0])
    spark.conf.set(*STATE_STORE)
    try:
        q = (stream.writeStream.foreachBatch(score_batch)
                   .option("checkpointLocation", checkpoint_dir)
                   .trigger(availableNow=True).start())
        q.awaitTermination()
        return [json.loads(p.json) if hasattr(p, "json") else dict(p) for p in q.recentProgress]
    finally:
        spark.conf.set(STATE_STORE[0], store)
        # external table: only the catalog entry goes, the files stay in scratch
        spark.sql(f"DROP TABLE IF EXISTS {table}")
