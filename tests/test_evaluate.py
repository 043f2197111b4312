"""Evaluation operators against golden numbers and brute force."""

import numpy as np
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.operators import evaluate as EV
from shipcast.operators.monitor import run_metrics
from shipcast.operators.ordered import running_sum


def _confusion_df(spark, tp, fp, fn, tn):
    rows = [(1, 1)] * tp + [(0, 1)] * fp + [(1, 0)] * fn + [(0, 0)] * tn
    return spark.createDataFrame(rows, "label int, prediction int")


def test_business_value_golden(spark):
    df = _confusion_df(spark, 5442, 14275, 16, 267)
    vals = {r["metric"]: r["value"] for r in EV.business_value(df).collect()}
    assert vals["model_value"] == 219315
    assert vals["baseline_value"] == -654960
    assert vals["incremental_value"] == 874275
    assert abs(vals["incremental_value_per_1000_orders"] - 43713.75) < 1e-9


def test_classification_metrics_golden(spark):
    df = _confusion_df(spark, 5442, 14275, 16, 267).withColumn("p", F.lit(0.5))
    m = EV.prediction_metrics(df, "label", "prediction", "p", band=None).first()
    assert abs(m["accuracy"] - 0.28545) < 1e-9
    assert abs(m["precision"] - 0.276005) < 1e-6
    assert abs(m["recall"] - 0.997069) < 1e-6
    assert abs(m["f1"] - 0.432334) < 1e-6


def test_selection_score_golden():
    w = K.SELECTION_WEIGHTS
    s = w[0] * 0.997069 + w[1] * 0.733363 + w[2] * 0.550170 + w[3] * 0.276005
    assert abs(s - 0.733603) < 1e-6


def _brute_auc_ap(y, s):
    pos, neg = s[y == 1], s[y == 0]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    order = np.argsort(-s, kind="stable")
    ap, tp_prev = 0.0, 0
    for t in np.unique(s)[::-1]:
        sel = s >= t
        tp = int(np.sum(y[sel] == 1))
        prec = tp / int(np.sum(sel))
        ap += (tp - tp_prev) / np.sum(y == 1) * prec
        tp_prev = tp
    del order
    return auc, ap


def test_auc_ap_tie_aware_against_brute_force(spark):
    rng = np.random.default_rng(7)
    y = rng.integers(0, 2, 400)
    s = np.round(rng.random(400), 2)  # many ties
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    r = EV.auc_ap(EV.score_curve(df)).first()
    auc, ap = _brute_auc_ap(y, s)
    assert abs(r["roc_auc"] - auc) < 1e-12
    assert abs(r["average_precision"] - ap) < 1e-12


def test_one_class_gives_null_auc(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.7)], "label int, score double")
    r = EV.auc_ap(EV.score_curve(df)).first()
    assert r["roc_auc"] is None and r["average_precision"] is None


def test_threshold_lowest_wins_ties(spark):
    # every row positive: all thresholds give the same score when tp counts are equal
    df = spark.createDataFrame([(1, 0.9), (1, 0.9), (0, 0.1), (1, 0.5)], "label int, score double")
    t = EV.choose_threshold(df).first()
    table = EV.threshold_table(EV.score_curve(df)).collect()
    best = max(r["business_score"] for r in table)
    assert t["threshold"] == min(r["threshold"] for r in table if r["business_score"] == best)


def test_running_sum_matches_cumsum(spark):
    rng = np.random.default_rng(3)
    vals = [(int(g), int(k), int(v)) for g, k, v in zip(rng.integers(0, 3, 3000), rng.permutation(3000),
                                                        rng.integers(0, 9, 3000))]
    df = spark.createDataFrame(vals, "g int, k int, v long")
    out = running_sum(df, [F.col("k")], ["v"], group=["g"], slices=5).toPandas()
    out = out.sort_values(["g", "k"])
    exp = out.groupby("g")["v"].cumsum()
    assert (out["v_cum"].values == exp.values).all()


def test_class_weights_balanced(spark):
    df = spark.createDataFrame([(1,)] * 3 + [(0,)] * 1, "delay_risk_label int")
    w = {r["label"]: r["weight"] for r in EV.class_weights(df).collect()}
    assert abs(w[1] - 4 / 6) < 1e-12 and abs(w[0] - 2.0) < 1e-12


def _scans(df):
    """Scans of files in the plan that ran; reused shuffles have none."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("+- == Initial Plan ==")[0].count("FileScan parquet")


def _joined_once(spark, build):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return _scans(build())
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_runs_are_joined_with_their_labels_once(spark, tmp_path):
    rng = np.random.default_rng(3)
    scores = np.round(rng.random(400), 2)
    rows = [(str(i), f"2001-01-0{i % 3 + 1} 01:00:00" if i % 10 else None, None if i % 50 == 7 else float(s), int(s >= 0.5), "high" if s > 0.7 else "low") for i, s in enumerate(scores)]
    (spark.createDataFrame(rows, "order_id string, t string, delay_probability double, delay_prediction long, risk_band string")
     .withColumn("prediction_timestamp", F.col("t").cast("timestamp_ntz")).write.parquet(str(tmp_path / "p")))
    spark.createDataFrame([(str(i), int(rng.random() < 0.4)) for i in range(0, 400, 2)], "order_id string, delay_risk_label long").write.parquet(str(tmp_path / "l"))
    predictions, labels = (spark.read.parquet(str(tmp_path / n)) for n in "pl")
    assert _joined_once(spark, lambda: run_metrics(predictions, labels)) == 2
    joined = predictions.join(labels, "order_id", "left")
    runs = {r["prediction_timestamp"]: r.asDict() for r in run_metrics(predictions, labels).collect()}
    assert len(runs) == 3
    for at, run in runs.items():
        alone = EV.prediction_metrics(joined.where(F.col("prediction_timestamp") == F.lit(str(at)).cast("timestamp_ntz")), "delay_risk_label", "delay_prediction", "delay_probability")
        for k, v in alone.first().asDict().items():
            assert run[k] == v or abs(run[k] - v) < 1e-12, k


def test_candidates_are_evaluated_once(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(str(i), int(rng.random() < 0.4), float(np.round(rng.random(), 2)), float(np.round(rng.random(), 1))) for i in range(300)]
    spark.createDataFrame(rows, "order_id string, label long, a double, b double").write.parquet(str(tmp_path / "t"))
    t = spark.read.parquet(str(tmp_path / "t"))

    def build():
        both = t.select("order_id", "label").join(t.select("order_id", "a", "b"), "order_id")
        long = both.select("label", F.explode(F.array(*[F.struct(F.lit(n).alias("name"), F.col(n).alias("score")) for n in "ab"])).alias("c")).select("label", "c.*")
        found = EV.evaluate_candidates(long).withColumn("position", F.when(F.col("name") == "a", 0).otherwise(1))
        return EV.select_best_model(found)

    assert _joined_once(spark, build) == 2
    got = {r["name"]: r for r in build().collect()}
    for n in "ab":
        assert got[n]["tp"] + got[n]["fn"] == sum(r[1] for r in rows) and got[n]["fp"] + got[n]["tn"] == 300 - sum(r[1] for r in rows)
    best = max("ab", key=lambda n: got[n]["selection_score"])
    assert [n for n in "ab" if got[n]["is_best"]] == [best]
