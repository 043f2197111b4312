"""Daily scoring job (M17): stored predictions are what the monitoring row
describes, a run is written once, nothing is left out by default."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from shipcast.operators.clean import dedupe_orders
from shipcast.operators.evaluate import prediction_metrics
from shipcast.operators.monitor import rule_score
from shipcast.plans.medallion import gold_table
from shipcast.plans.scoring_job import ScoringConfig, model_scorer, read_feature_list, run_daily_scoring

RUNS = ["2001-08-02 01:00:00", "2001-08-03 01:00:00", "2001-08-04 01:00:00"]


def test_monitoring_describes_the_stored_predictions(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-job-")
    preds, perf = os.path.join(root, "preds"), os.path.join(root, "perf")
    gold = gold_table(spark, sf_small)
    cfg = ScoringConfig(batch_size=50, daily_limit=300)
    for run in RUNS:
        got = run_daily_scoring(spark, lambda: gold, preds, perf, run, rule_score, "rule_probability", cfg)
        assert got["quota"] == got["scored"] == 50 and got["monitoring"] and got["unscored"] > 0
    again = run_daily_scoring(spark, gold, preds, perf, RUNS[1], rule_score, "rule_probability", cfg)
    assert again["scored"] == 50 and not again["monitoring"] and again["quota"] is None
    p = spark.read.parquet(preds)
    assert p.count() == p.select("order_id").distinct().count() == 150
    rows = {str(r["run_timestamp"]): r for r in spark.read.parquet(perf).collect()}
    assert sorted(rows) == RUNS and all(len(r) == 40 for r in rows.values())
    labels = dedupe_orders(gold).select("order_id", "delay_risk_label")
    for run in RUNS:
        stored = p.where(F.col("prediction_timestamp") == F.lit(run).cast("timestamp_ntz")).join(labels, "order_id", "left")
        want = prediction_metrics(stored, "delay_risk_label", "delay_prediction", "delay_probability", "risk_band", missing_label_as_zero=True).first().asDict()
        got = rows[run].asDict()
        assert {k: got[k] for k in want if k in got} == {k: v for k, v in want.items() if k in got}
    assert rows[RUNS[2]]["comparison_source"] == "performance_table"


def test_a_lost_monitoring_row_is_completed(spark, sf_small):
    root = tempfile.mkdtemp(prefix="shipcast-job-")
    preds, perf = os.path.join(root, "preds"), os.path.join(root, "perf")
    gold = gold_table(spark, sf_small)
    first = run_daily_scoring(spark, gold, preds, perf, RUNS[0], rule_score, "rule_probability", ScoringConfig(monitoring=False))
    assert first["unscored"] == 0 and first["scored"] == gold.select("order_id").distinct().count()
    assert run_daily_scoring(spark, gold, preds, perf, RUNS[0], rule_score, "rule_probability")["monitoring"]
    assert spark.read.parquet(perf).count() == 1


def test_a_fitted_model_scores_aligned_features(spark, sf_small):
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import VectorAssembler

    gold = gold_table(spark, sf_small)
    root = tempfile.mkdtemp(prefix="shipcast-job-")
    names = ["distance_km", "order_value", "not_there"]
    with open(os.path.join(root, "features.json"), "w") as f:
        json.dump(names, f)
    assert read_feature_list(spark, os.path.join(root, "features.json")) == names
    train = gold.select(*names[:2], F.lit(0.0).alias("not_there"), F.col("delay_risk_label").cast("double").alias("label"))
    model = Pipeline(stages=[VectorAssembler(inputCols=names, outputCol="features"), LogisticRegression(maxIter=5)]).fit(train)
    got = run_daily_scoring(spark, gold, os.path.join(root, "p"), os.path.join(root, "m"), RUNS[0], model_scorer(model, names, {"not_there": 0.0}), "delay_probability", ScoringConfig(batch_size=20))
    assert got["scored"] == 20 and got["monitoring"]
