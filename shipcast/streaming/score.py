"""Incremental scoring stream.

Feature files arrive as a stream; each micro-batch scores only the order ids
that have no prediction yet (the key index of the predictions table is asked,
so a batch opens few of its buckets) and appends the predictions with the run's timestamp: one for all micro-batches
of a run, so that the day quota and the latest batch see one run. Asking for
stored ids makes the append idempotent. ``daily_limit`` is the quota of a day
(A17) across micro-batches, restarts and other writers: the stored predictions
of the run's day are counted before each batch, and the newest orders of the
batch go first; orders beyond the quota stay unscored. ``scorer`` maps a feature DataFrame to one with a probability
column (the rule scorer or a fitted ``PipelineModel`` wrapper).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shipcast.operators.clean import dedupe_orders
from shipcast.operators.monitor import scored_on, to_predictions
from shipcast.sources.keyed import KeyIndex
from shipcast.sources.layers import has_files


def score_batch(batch: DataFrame, epoch_id: int, predictions_path: str, scorer: Callable[[DataFrame], DataFrame],
                prob_col: str, run_start: str, model_version: str, daily_limit: int = 0) -> None:
    spark = batch.sparkSession
    index = KeyIndex(spark, predictions_path)
    index.sync()
    todo = index.missing(dedupe_orders(batch))
    if daily_limit > 0:
        used = scored_on(spark.read.parquet(predictions_path), run_start) if has_files(spark, predictions_path) else 0
        if used >= daily_limit:
            return
        todo = todo.orderBy(F.col("order_timestamp").desc(), F.col("order_id")).limit(daily_limit - used)
    run_ts = F.lit(run_start).cast("timestamp_ntz")
    preds = to_predictions(scorer(todo), prob_col, run_ts, model_version=model_version)
    preds.write.mode("append").parquet(predictions_path)


def stream_score(spark: SparkSession, source_dir: str, schema, predictions_path: str, checkpoint: str,
                 scorer: Callable[[DataFrame], DataFrame], prob_col: str, run_start: str,
                 model_version: str = "rule-baseline-v1", max_files_per_trigger: int | None = None,
                 daily_limit: int = 0) -> StreamingQuery:
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return (reader.load(source_dir).writeStream.option("checkpointLocation", checkpoint)
            .foreachBatch(lambda df, eid: score_batch(df, eid, predictions_path, scorer, prob_col, run_start,
                                                      model_version, daily_limit))
            .trigger(availableNow=True).start())
