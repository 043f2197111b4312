"""Cleaning, dedupe, hypotheses, quality and monitoring operators."""

import numpy as np
from pyspark.sql import functions as F

from shipcast.operators.clean import clean_orders, coerce_types, dedupe_orders, normalize_name
from shipcast.operators.hypotheses import hypothesis_tests
from shipcast.operators.monitor import performance_row
from shipcast.operators.quality import numeric_summary, quality_checks


def test_silver_filter_edges(spark):
    rows = [("a", "2001-01-01 00:00:00", 1.0, 0.0), ("b", "2001-01-01 00:00:00", 0.0, 5.0),
            ("c", "2001-01-01 00:00:00", -1.0, 5.0), ("d", "2001-01-01 00:00:00", 5.0, -0.01),
            (None, "2001-01-01 00:00:00", 5.0, 5.0), ("f", None, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "order_id string, order_timestamp string, order_value double, distance_km double")
    df = df.withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))
    assert [r["order_id"] for r in clean_orders(df).collect()] == ["a"]


def test_coercion(spark):
    df = spark.createDataFrame([("x", "not a time", "abc"), ("y", "2025-06-01 00:03:38", "1")],
                               "order_id string, order_timestamp string, delay_risk_label string")
    rows = {r["order_id"]: r for r in coerce_types(df).collect()}
    assert rows["x"]["order_timestamp"] is None and rows["x"]["delay_risk_label"] == 0
    assert rows["y"]["delay_risk_label"] == 1 and rows["y"]["order_timestamp"].minute == 3


def test_normalize_name():
    assert normalize_name(" Order Value (R$) ") == "order_value_r"


def test_dedupe_keeps_first_and_handles_hot_key(spark):
    rows = [("hot", i, f"p{i % 7}") for i in range(3000)] + [("cold", 5, "p1"), ("cold", 2, "p9")]
    df = spark.createDataFrame(rows, "order_id string, ingestion_timestamp long, product_id string")
    out = {r["order_id"]: r for r in dedupe_orders(df).collect()}
    assert out["hot"]["ingestion_timestamp"] == 0 and out["cold"]["ingestion_timestamp"] == 2


def test_quality_checks_counts_null_id_once(spark):
    rows = [("a", None, 1.0, 1.0, 0, "S", "C"), ("a", "e", 0.0, -1.0, 1, "S", "C"),
            (None, "e", 1.0, 1.0, 1, "T", "D"), (None, "e", 1.0, 1.0, 0, "T", "D")]
    df = spark.createDataFrame(rows, "order_id string, customer_email string, order_value double, "
                                     "distance_km double, delay_risk_label int, state string, carrier string")
    r = quality_checks(df).first()
    # 4 rows, distinct ids {a, NULL} -> 2 duplicates
    assert r["duplicate_order_id"] == 2 and r["negative_order_values"] == 1 and r["invalid_distance"] == 1
    assert r["states"] == 2 and abs(r["missing_email_pct"] - 0.25) < 1e-12
    assert r["rows"] == 4 and r["carriers"] == 2 and r["delay_rate"] == 0.5
    empty = quality_checks(df.where("false")).first().asDict()
    assert empty == {"rows": 0, "duplicate_order_id": 0, "missing_email_pct": None, "negative_order_values": 0,
                     "invalid_distance": 0, "delay_rate": None, "states": 0, "carriers": 0}
    no_label = quality_checks(df.withColumn("delay_risk_label", F.lit(None).cast("int"))).first()
    assert no_label["delay_rate"] is None and no_label["rows"] == 4
    # No row is expanded for each distinct count: only the pairs of state and carrier are.
    plan = quality_checks(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") <= 1 and "order_id" not in "".join(x for x in plan.splitlines() if "Expand" in x)


def test_numeric_summary_matches_numpy(spark):
    rng = np.random.default_rng(11)
    x = np.round(rng.normal(size=501), 3)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    r = numeric_summary(df, ["x"]).first()
    for q, name in [(25, "p25"), (50, "p50"), (75, "p75")]:
        assert abs(r[name] - np.percentile(x, q)) < 1e-12
    assert abs(r["std"] - np.std(x, ddof=1)) < 1e-9 and r["count"] == 501


def test_hypothesis_lift_verdict(spark):
    # 100 rows, overall rate 0.3; traffic severe: 60 rows at rate 0.4 -> lift 1.333 TRUE
    rows = [("severe", 1 if i < 24 else 0) for i in range(60)] + [("low", 1 if i < 6 else 0) for i in range(40)]
    df = spark.createDataFrame(rows, "traffic_condition string, delay_risk_label int")
    out = {r["id"]: r for r in hypothesis_tests(df).collect()}
    h1 = out["H1"]
    assert h1["segment_count"] == 60 and abs(h1["lift"] - 0.4 / 0.3) < 1e-12 and h1["verdict"] == "TRUE"
    assert out["H2"]["verdict"] == "INCONCLUSIVE"  # feature missing
    assert "1.33x" in h1["business_insight"]


def test_performance_row_alert_inclusive(spark):
    cur = spark.createDataFrame([(10, 5, 5, 0.75, 0.5, 0.5, 0.5, None, None, 1, 1, 1, 1, 0.5, 0, 0, 10)],
                                "evaluated_rows long, positive_labels long, positive_predictions long, accuracy double,"
                                " precision double, recall double, f1 double, roc_auc double, average_precision double,"
                                " true_positives long, false_positives long, false_negatives long, true_negatives long,"
                                " avg_delay_probability double, high_risk_orders long, medium_risk_orders long,"
                                " low_risk_orders long")
    base = spark.createDataFrame([("2001-01-01 01:00:00", 0.8, 0.5, 0.5, 0.56, None, None)],
                                 "run_timestamp string, accuracy double, precision double, recall double, f1 double,"
                                 " roc_auc double, average_precision double").withColumn(
        "run_timestamp", F.col("run_timestamp").cast("timestamp_ntz"))
    r = performance_row(cur, base, base.limit(0), "2001-01-02 01:00:00").first()
    assert r["accuracy_drop_alert"] is True and r["f1_drop_alert"] is True
    assert r["roc_auc_delta"] is None and r["comparison_source"] == "performance_table"
    assert len(r) == 40


def test_page_sizes_are_checked(spark):
    import pytest

    from shipcast.operators.metrics import latest_orders
    from shipcast.operators.monitor import latest_predictions

    df = spark.createDataFrame([(f"o{k}", f"2001-01-0{k % 9 + 1} 00:00:00") for k in range(20)], "order_id string, t string")
    df = df.select("order_id", F.col("t").cast("timestamp_ntz").alias("order_timestamp"))
    for bad in (0, 1001):
        with pytest.raises(ValueError):
            latest_orders(df, bad)
    with pytest.raises(ValueError):
        latest_predictions(df, 501)
    newest = [r["order_id"] for r in latest_orders(df, 20).collect()]
    assert [r["order_id"] for r in latest_orders(df, 5, 7).collect()] == newest[7:12]


def test_cap_keeps_the_oldest_rows(spark):
    from shipcast.operators.metrics import cap_rows

    rows = [(f"o{k:03d}", None if k % 50 == 0 else f"200{k % 3}-0{k % 2 + 1}-01 0{k % 4}:0{k % 5}:{k % 60:02d}") for k in range(300)]
    df = spark.createDataFrame(rows, "order_id string, t string").select("order_id", F.col("t").cast("timestamp_ntz").alias("order_timestamp"))
    order = [r["order_id"] for r in df.orderBy("order_timestamp", "order_id").collect()]
    for n in (1, 6, 7, 50, 137, 299, 300, 400):
        assert sorted(r["order_id"] for r in cap_rows(df, n).collect()) == sorted(order[:n])
    assert cap_rows(df, None).count() == 300


def test_iso_text_keeps_fractions(spark):
    from shipcast.functions.expr import iso_timestamp

    df = spark.createDataFrame([("2001-02-03 04:05:06.123456",), ("2001-02-03 04:05:06",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [r[0] for r in df.select(iso_timestamp("t")).collect()] == ["2001-02-03T04:05:06.123456+00:00", "2001-02-03T04:05:06+00:00", None]


def test_layers_follow_their_input(spark, tmp_path):
    from shipcast.sources.layers import layer

    src = str(tmp_path / "in")
    spark.range(5).write.parquet(src)
    read = lambda: layer(spark, src, "probe", lambda: spark.read.parquet(src)).count()
    assert read() == read() == 5
    spark.range(3).write.mode("append").parquet(src)
    assert read() == 8
