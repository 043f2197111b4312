"""Micro-batch ingest (R1, R2, S5, S6, S10) with Structured Streaming.

New order files are read as a stream; each micro-batch, in
``foreachBatch``:

1. keeps the first row per order id inside the batch (P8);
2. inserts into the operational store only ids it does not hold yet (S5:
   exact and unbounded — no watermark, so late rows are never dropped; the
   key index of the store is asked, so a batch opens few of its buckets);
3. appends the batch to the warehouse raw table (S6);
4. writes one audit row (S10): "warning" if the warehouse did not take all.

``foreachBatch`` is at-least-once. Every table is partitioned by the stream's
id and the epoch and written with dynamic partition overwrite, so a retried
epoch replaces its own rows and counts, and another stream (or the same files
under a new checkpoint folder) never does. Progress lives in the checkpoint
folder, which must be on shared storage on a cluster.

``watermark`` opts in to the other form (R2): keyed state in the stream drops
an id that was seen within the delay and every row that comes later than the
delay, and the store is not asked. State is bounded by the delay, but a late
row is lost, which the exact form never does.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shipcast.operators.clean import dedupe_orders
from shipcast.sources.keyed import KeyIndex
from shipcast.sources.layers import hadoop_path, has_files


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """Identity of the stream that owns a checkpoint folder: made once and
    kept in the folder, so a new folder is a new stream."""
    path, fs = hadoop_path(spark, checkpoint.rstrip("/") + "/stream-id")
    if not fs.exists(path):
        out = fs.create(path, False)
        out.writeUTF(uuid.uuid4().hex)
        out.close()
    read = fs.open(path)
    try:
        return read.readUTF()
    finally:
        read.close()


def _replace(rows: DataFrame, stream: str, epoch_id: int, path: str) -> int:
    """Write ``rows`` as the partition of this stream and epoch, replacing an
    earlier try's; the number of rows that are stored there."""
    tagged = rows.withColumn("_stream", F.lit(stream)).withColumn("_epoch", F.lit(epoch_id).cast("long"))
    (tagged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
           .partitionBy("_stream", "_epoch").parquet(path))
    if not has_files(rows.sparkSession, path):
        return 0
    return rows.sparkSession.read.parquet(path).where((F.col("_stream") == stream) & (F.col("_epoch") == epoch_id)).count()


def ingest_batch(batch: DataFrame, epoch_id: int, ops_path: str, raw_path: str, log_path: str,
                 warehouse_enabled: bool = True, stream: str = "stream", ask_store: bool = True) -> None:
    spark = batch.sparkSession
    batch = batch.persist()
    try:
        rows_generated = batch.count()
        new = dedupe_orders(batch)
        if ask_store:
            index = KeyIndex(spark, ops_path)
            index.sync(skip=f"_stream={stream}/_epoch={epoch_id}/")
            new = index.missing(new)
        new = new.persist()
        rows_ops = _replace(new, stream, epoch_id, ops_path)
        new.unpersist()

        rows_wh, message = 0, ""
        if warehouse_enabled:
            try:
                rows_wh = _replace(batch, stream, epoch_id, raw_path)
            except Exception as e:  # noqa: BLE001  the warehouse may be away; the audit row says so
                message = str(e).split("\n")[0][:200]
        status = "success" if (rows_wh == rows_generated or not warehouse_enabled) else "warning"
        time = F.max("ingestion_timestamp") if "ingestion_timestamp" in batch.columns else F.lit(None)
        key = f"{stream}-{epoch_id}"
        log = batch.agg(time.cast("timestamp_ntz").alias("created_at")).select(
            F.lit(key).alias("id"), F.lit(key).alias("batch_id"), F.lit(rows_generated).cast("long").alias("rows_generated"),
            F.lit(rows_ops).cast("long").alias("rows_inserted_sqlite"), F.lit(rows_wh).cast("long").alias("rows_inserted_bigquery"),
            F.lit(status).alias("status"), F.lit(message).alias("message"), "created_at")
        _replace(log, stream, epoch_id, log_path)
    finally:
        batch.unpersist()


def within_watermark(rows: DataFrame, delay: str, event_time: str = "order_timestamp", key: str = "order_id") -> DataFrame:
    """R2, opt-in: rows of a stream without those whose key was seen within
    ``delay`` of event time, and without those later than the watermark. Rows
    without a time never expire and are compared with each other for ever."""
    timed = rows.withColumn("_event", F.col(event_time).cast("timestamp"))
    return timed.withWatermark("_event", delay).dropDuplicatesWithinWatermark([key]).drop("_event")


def stream_ingest(spark: SparkSession, source_dir: str, schema, ops_path: str, raw_path: str, log_path: str,
                  checkpoint: str, max_files_per_trigger: int | None = None,
                  available_now: bool = True, processing_time: str | None = None,
                  watermark: str | None = None, event_time: str = "order_timestamp") -> StreamingQuery:
    """Start the ingest stream over Parquet files in ``source_dir``.
    ``watermark``: a delay such as "2 days" of ``event_time`` (see above)."""
    reader = spark.readStream.schema(schema).format("parquet")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    src = reader.load(source_dir)
    if watermark:
        src = within_watermark(src, watermark, event_time)
    own = stream_id(spark, checkpoint)
    w = (src.writeStream.option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, eid: ingest_batch(df, eid, ops_path, raw_path, log_path, stream=own, ask_store=not watermark)))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "240 minutes")
    return w.start()


def latest_ingestion_logs(logs: DataFrame, limit: int = 50) -> DataFrame:
    """Newest audit rows first (epoch breaks ties); the page size is the
    feature (1–500; other values are an error)."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    return logs.orderBy(F.col("created_at").desc(), F.col("_epoch").desc()).limit(limit)
