"""Shapes of plans (scans, pruning, no sampling), value buckets, sinks and layer publishing."""

import math
import os
import re

from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.operators import evaluate as EV
from shipcast.operators.clean import normalize_columns
from shipcast.operators.features import ml_ready
from shipcast.operators.hypotheses import hypothesis_tests
from shipcast.operators.metrics import delta_direction
from shipcast.operators.monitor import lookback_start, unscored_orders
from shipcast.operators.ordered import running_sum, value_buckets
from shipcast.operators.quality import numeric_summary
from shipcast.plans import catalog, medallion
from shipcast.plans.training import stratified_split
from shipcast.sources import layers, sinks


def _plan(df):
    """The physical plan before execution, each exchange with what it reads."""
    return df._jdf.queryExecution().executedPlan().toString()


def _scanned_once(df, rows):
    """Rows that the scans of a file table give when the query has run (reused exchanges scan nothing)."""
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    final = text.split("+- == Initial Plan ==")[0]
    return len(re.findall(r"FileScan parquet", final)), len(re.findall("ReusedExchange", final))


def test_lookback_reads_few_months(spark, sf_small):
    start = lookback_start(catalog.AS_OF)
    out = unscored_orders(medallion.gold_table(spark, sf_small, start), catalog.predictions(spark, sf_small, start), catalog.AS_OF)
    scans = [line for line in _plan(out).splitlines() if "FileScan" in line]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(_month" in s for s in scans)
    whole = unscored_orders(medallion.gold_table(spark, sf_small), catalog.predictions(spark, sf_small), catalog.AS_OF)
    assert sorted(r["order_id"] for r in out.collect()) == sorted(r["order_id"] for r in whole.collect())
    files = medallion.gold_table(spark, sf_small).inputFiles()
    assert len({f.rsplit("/", 2)[1] for f in files}) > 50
    assert "_month" not in out.columns


def test_hypotheses_and_metrics_read_their_table_once(spark, sf_small):
    scans, reused = _scanned_once(hypothesis_tests(medallion.training_table(spark, sf_small)), 6000)
    assert scans - reused <= 1
    table = catalog.ops_orders(spark, sf_small).select("delay_risk_label", F.lit(1).alias("p"), (F.col("distance_km") / 9000).alias("s"))
    scans, reused = _scanned_once(EV.prediction_metrics(table, "delay_risk_label", "p", "s", band=None), 6000)
    assert scans - reused <= 1


def test_running_sums_are_not_sampled(spark):
    df = spark.createDataFrame([(float(k), 1) for k in range(50)], "k double, v long")
    plan = _plan(running_sum(df, [F.col("k")], ["v"]))
    assert "rangepartitioning" not in plan and "SPARK_PARTITION_ID" not in plan.upper()


def test_value_buckets_follow_the_value(spark):
    values = [None, -math.inf, -1e300, -7.5, -1.0, -1e-300, -0.0, 0.0, 5e-324, 1e-9, 0.2, 0.2000001, 0.5, 1.0, 1.5, 3.0, 1e12, 1e300, math.inf, math.nan]
    df = spark.createDataFrame([(k, v) for k, v in enumerate(values)], "k int, v double")
    part, size = value_buckets(F.col("v"), F.lit(0.0), F.lit(1.0))
    got = [(r["p"], r["s"]) for r in df.select("k", part.alias("p"), size.alias("s")).orderBy("k").collect()]
    assert got == sorted(got) and len(set(got)) >= 16
    cum = running_sum(df.withColumn("one", F.lit(1).cast("long")).where("k <> 6"), [F.col("v")], ["one"])
    assert [r["one_cum"] for r in cum.orderBy("k").collect()] == list(range(1, len(values)))
    down = running_sum(df.withColumn("one", F.lit(1).cast("long")).where("k <> 6"), [F.col("v")], ["one"], descending=True)
    assert [r["one_cum"] for r in down.orderBy("k").collect()] == list(range(len(values) - 1, 0, -1))


def test_quartiles_of_tails_nulls_and_constants(spark):
    rows = [(float(10 ** (k % 12)) * (-1) ** k, 3, None, k) for k in range(400)] + [(None, 3, None, 7)]
    df = spark.createDataFrame(rows, "tail double, same int, none double, k int")
    got = {r["column_name"]: r for r in numeric_summary(df).collect()}
    assert set(got) == {"tail", "same", "k"}
    import numpy as np
    for c, j in (("tail", 0), ("same", 1), ("k", 3)):
        x = [r[j] for r in rows if r[j] is not None]
        for q in (25, 50, 75):
            assert math.isclose(got[c][f"p{q}"], np.percentile(x, q), rel_tol=1e-12, abs_tol=1e-12)
    assert numeric_summary(df.limit(0)).collect() == []


def test_split_keeps_repeated_keys_together(spark):
    rows = [(f"o{k // 3}", k // 3 % 2) for k in range(900)] + [(None, None), ("x", None), ("y", None)]
    df = spark.createDataFrame(rows, "order_id string, y int")
    s = stratified_split(df, "y", "order_id", 0.2, 42)
    assert s.count() == 903 and s.columns == ["order_id", "y", "split"]
    assert s.groupBy("order_id").agg(F.count_distinct("split").alias("n")).where("n > 1").count() == 0
    test = {r["y"]: r["count"] for r in s.where("split = 'test'").groupBy("y").count().collect()}
    assert all(90 <= test[y] <= 92 for y in (0, 1)) and test[None] == 1
    plan = _plan(s)
    assert "rangepartitioning" not in plan


def test_sinks(spark, tmp_path):
    target = str(tmp_path / "store")
    schema = "order_id string, order_timestamp timestamp_ntz, v int"
    old = spark.createDataFrame([("a", None, 1), ("b", None, 2)], schema)
    sinks.append_rows(old, target)
    come = spark.createDataFrame([("b", None, 9), ("c", None, 3), ("c", None, 4), ("d", None, 5)], schema)
    assert sinks.insert_new_orders(come, spark.read.parquet(target), target) == 2
    assert sorted((r["order_id"], r["v"]) for r in spark.read.parquet(target).collect()) == [("a", 1), ("b", 2), ("c", 3), ("d", 5)]
    assert sorted(r["order_id"] for r in sinks.backfill_rows(come, old, max_rows=2).collect()) == ["c", "c"]
    assert sinks.backfill_rows(come, old).count() == 3
    ok = sinks.ingestion_log_row(7, come, 2, 4, True, "2001-01-01 00:00:00").first()
    late = sinks.ingestion_log_row(8, come, 2, 3, True, "2001-01-01 00:00:00").first()
    off = sinks.ingestion_log_row(9, come, 2, 0, False, "2001-01-01 00:00:00").first()
    assert (ok["status"], late["status"], off["status"]) == ("success", "warning", "success")
    back = layers.write_layer(come, str(tmp_path / "step"))
    assert back.count() == 4
    sinks.write_report(come.groupBy("order_id").count(), str(tmp_path / "report"))
    assert len([f for f in os.listdir(tmp_path / "report") if f.endswith(".json")]) == 1
    assert spark.read.json(str(tmp_path / "report")).count() == 3


def test_small_column_helpers(spark, sf_small):
    df = spark.createDataFrame([(-1.0,), (0.0,), (2.0,), (None,)], "`Delta (R$) x` double")
    named = normalize_columns(df)
    assert named.columns == ["delta_r_x"]
    assert [r[0] for r in named.select(delta_direction("delta_r_x")).collect()] == ["down", "neutral", "up", "neutral"]
    kept = ml_ready(medallion.training_table(spark, sf_small)).columns
    assert "delay_risk_label" in kept and not set(kept) & set(K.ML_DROP_COLUMNS)


def test_layers_are_published_by_pointer(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.range(5).selectExpr("id", "timestamp_ntz'2001-01-31 23:00:00' + make_dt_interval(cast(id as int)) AS t").write.parquet(src)
    read = lambda since=None: layers.layer(spark, src, "monthly", lambda: spark.read.parquet(src), "t", since)
    assert read().columns == ["id", "t"] and read().count() == 5
    assert [r["id"] for r in read("2001-02-02 23:00:00").orderBy("id").collect()] == [2, 3, 4]
    assert layers.drop_old_layers(spark, src, 1e6) == 0
    assert read().count() == 5


def test_rank_by_recall(spark):
    rows = [("a", 0.9, 0.5, 0.8, 0), ("b", 0.9, 0.6, 0.1, 1), ("c", 0.1, 0.9, 0.9, 2), ("d", 0.9, 0.6, 0.1, 3)]
    df = spark.createDataFrame(rows, "name string, recall double, f1 double, roc_auc double, position long")
    assert [r["name"] for r in EV.rank_by_recall(df).where("is_best").collect()] == ["b"]
