"""Streaming ingest / scoring: replaying files leaves the keyed tables as the
batch result."""

import os
import shutil
import tempfile

from pyspark.sql import functions as F

from shipcast.operators.clean import dedupe_orders
from shipcast.plans.medallion import raw_orders
from shipcast.streaming.budget import budget_breaches, encode_budget_events, stream_budget_breaches
from shipcast.streaming.ingest import ingest_batch, latest_ingestion_logs, stream_ingest
from shipcast.streaming.score import stream_score
from shipcast.operators.monitor import rule_score


def test_ingest_replay_is_idempotent(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-stream-")
    src = os.path.join(root, "incoming")
    raw = raw_orders(spark, sf_small)
    raw.write.partitionBy("batch_id").parquet(os.path.join(root, "staged"))
    os.makedirs(src)
    staged = os.path.join(root, "staged")
    files = []
    for d in sorted(os.listdir(staged)):
        if d.startswith("batch_id="):
            for f in os.listdir(os.path.join(staged, d)):
                if f.endswith(".parquet"):
                    files.append(os.path.join(staged, d, f))
    for i, f in enumerate(files):
        shutil.copy(f, os.path.join(src, f"part-{i:03d}.parquet"))
    schema = spark.read.parquet(src).schema
    paths = dict(ops_path=os.path.join(root, "ops"), raw_path=os.path.join(root, "raw"),
                 log_path=os.path.join(root, "log"), checkpoint=os.path.join(root, "ckpt"))
    q = stream_ingest(spark, src, schema, max_files_per_trigger=3, **paths)
    q.awaitTermination()
    expected = dedupe_orders(spark.read.parquet(src)).select("order_id").distinct().count()
    ops = spark.read.parquet(paths["ops_path"])
    assert ops.count() == expected == ops.select("order_id").distinct().count()
    # replay: the first file arrives again under a new name
    shutil.copy(files[0], os.path.join(src, "replayed.parquet"))
    stream_ingest(spark, src, schema, **paths).awaitTermination()
    ops2 = spark.read.parquet(paths["ops_path"])
    assert ops2.count() == expected
    logs = spark.read.parquet(paths["log_path"])
    assert logs.where("status = 'success'").count() == logs.count() >= 2
    # the same files under a new checkpoint folder: no row of the first stream is replaced
    before = spark.read.parquet(paths["raw_path"]).count()
    stream_ingest(spark, src, schema, **(paths | {"checkpoint": os.path.join(root, "ckpt2")})).awaitTermination()
    assert spark.read.parquet(paths["raw_path"]).count() == before + spark.read.parquet(src).count()
    assert spark.read.parquet(paths["ops_path"]).count() == expected


def test_retried_epoch_keeps_its_counts(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-retry-")
    ops, raw, log = (os.path.join(root, n) for n in ("ops", "raw", "log"))
    batch = raw_orders(spark, sf_small).limit(40)
    batch.write.parquet(os.path.join(root, "in"))
    batch = spark.read.parquet(os.path.join(root, "in"))
    for _ in range(2):
        ingest_batch(batch, 0, ops, raw, log, stream="a")
    n = dedupe_orders(batch).count()
    row = spark.read.parquet(log).collect()
    assert len(row) == 1 and (row[0]["rows_generated"], row[0]["rows_inserted_sqlite"], row[0]["rows_inserted_bigquery"], row[0]["status"]) == (40, n, 40, "success")
    assert spark.read.parquet(raw).count() == 40 and spark.read.parquet(ops).count() == n
    # a warehouse that cannot be written
    with open(os.path.join(root, "file"), "w") as f:
        f.write("x")
    ingest_batch(batch, 1, ops, os.path.join(root, "file", "raw"), log, stream="a")
    last = latest_ingestion_logs(spark.read.parquet(log), 1).first()
    assert (last["status"], last["rows_inserted_sqlite"], last["rows_inserted_bigquery"]) == ("warning", 0, 0) and last["message"]


def test_score_stream_scores_each_order_once(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-score-")
    src = os.path.join(root, "gold")
    raw_orders(spark, sf_small).repartition(4).write.parquet(src)
    schema = spark.read.parquet(src).schema
    preds = os.path.join(root, "preds")
    args = dict(predictions_path=preds, checkpoint=os.path.join(root, "ckpt"), scorer=rule_score,
                prob_col="rule_probability", run_start="2001-08-02 01:00:00")
    stream_score(spark, src, schema, max_files_per_trigger=1, **args).awaitTermination()
    p = spark.read.parquet(preds)
    n = spark.read.parquet(src).select("order_id").distinct().count()
    assert p.count() == n == p.select("order_id").distinct().count()
    assert [str(r[0]) for r in p.select("prediction_timestamp").distinct().collect()] == ["2001-08-02 01:00:00"]


def test_budget_stream_matches_batch(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-budget-")
    ev = spark.read.parquet(f"{sf_small}/events.parquet")
    msgs = encode_budget_events(ev, 50.0)
    msgs.write.parquet(os.path.join(root, "msgs"))
    schema = spark.read.parquet(os.path.join(root, "msgs")).schema
    stream_budget_breaches(spark, os.path.join(root, "msgs"), schema, os.path.join(root, "out"),
                           os.path.join(root, "ckpt")).awaitTermination()
    got = spark.read.parquet(os.path.join(root, "out")).count()
    assert got == budget_breaches(msgs).count() == ev.where(F.col("value") >= 50.0).count()


def _orders(spark, folder, name, rows):
    df = spark.createDataFrame(rows, "order_id string, order_timestamp string, delay_risk_label long").withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))
    df.coalesce(1).write.mode("append").parquet(os.path.join(folder, name))
    return df.schema


def test_watermark_form(spark):
    """R2, opt-in: a replay within the delay is dropped by the state, a row
    later than the watermark is dropped whether it is new or not; the state
    outlives a restart."""
    root = tempfile.mkdtemp(prefix="shipcast-mark-")
    ops, raw, log, ckpt = (os.path.join(root, n) for n in ("ops", "raw", "log", "ckpt"))
    src = os.path.join(root, "in")

    def step(k, rows):
        schema = _orders(spark, src, f"f{k}", rows)
        stream_ingest(spark, os.path.join(src, "*"), schema, ops, raw, log, ckpt, watermark="2 days").awaitTermination()
        return sorted(r[0] for r in spark.read.parquet(ops).select("order_id").collect())

    assert step(0, [("a", "2001-01-10 00:00:00", 0), ("a", "2001-01-10 01:00:00", 1), ("b", "2001-01-10 02:00:00", 0)]) == ["a", "b"]
    # after a restart: replays within the delay, and a row that sets the watermark to the 10th
    assert step(1, [("a", "2001-01-10 03:00:00", 0), ("b", "2001-01-10 02:00:00", 0), ("c", "2001-01-12 02:30:00", 0)]) == ["a", "b", "c"]
    # later than the watermark: lost, also the new order d; e is within the delay
    assert step(2, [("a", "2001-01-09 00:00:00", 0), ("d", "2001-01-09 12:00:00", 0), ("e", "2001-01-11 00:00:00", 0)]) == ["a", "b", "c", "e"]
    assert step(3, [("c", "2001-01-13 00:00:00", 0), ("e", "2001-01-11 01:00:00", 0), ("f", "2001-01-20 00:00:00", 0)]) == ["a", "b", "c", "e", "f"]


def test_exact_form_takes_late_rows(spark):
    root = tempfile.mkdtemp(prefix="shipcast-late-")
    ops, raw, log, ckpt = (os.path.join(root, n) for n in ("ops", "raw", "log", "ckpt"))
    src = os.path.join(root, "in")
    for k, rows in enumerate(([("a", "2001-01-10 00:00:00", 0), ("c", "2001-02-12 00:00:00", 0)], [("d", "2000-01-01 00:00:00", 0), ("a", "2001-03-01 00:00:00", 0)])):
        schema = _orders(spark, src, f"f{k}", rows)
        stream_ingest(spark, os.path.join(src, "*"), schema, ops, raw, log, ckpt).awaitTermination()
    assert sorted(r[0] for r in spark.read.parquet(ops).select("order_id").collect()) == ["a", "c", "d"]


def test_score_stream_keeps_the_quota_of_a_day(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-quota-")
    src, preds = os.path.join(root, "gold"), os.path.join(root, "preds")
    orders = dedupe_orders(raw_orders(spark, sf_small)).persist()
    schema = orders.schema
    args = dict(predictions_path=preds, checkpoint=os.path.join(root, "ckpt"), scorer=rule_score, prob_col="rule_probability", daily_limit=250)
    stored = lambda: {str(r["d"]): r["count"] for r in spark.read.parquet(preds).groupBy(F.to_date("prediction_timestamp").alias("d")).count().collect()}
    for k, day in enumerate(["2001-08-02 01:00:00", "2001-08-02 05:00:00", "2001-08-03 01:00:00"]):  # each call is a restart
        for part in range(3):
            orders.where(F.pmod(F.xxhash64("order_id"), F.lit(9)) == 3 * k + part).coalesce(1).write.parquet(os.path.join(src, f"f{k}{part}"))
        stream_score(spark, os.path.join(src, "*"), schema, run_start=day, max_files_per_trigger=1, **args).awaitTermination()
        assert max(stored().values()) <= 250
    assert stored() == {"2001-08-02": 250, "2001-08-03": 250}
    p = spark.read.parquet(preds)
    assert p.count() == p.select("order_id").distinct().count()
