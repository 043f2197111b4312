"""Scalar expressions on edge rows: band edges, NULLs, zero divisors, maps."""

from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.functions import delivery as D
from shipcast.functions import expr as X
from shipcast.operators.features import gold_features, training_features


def _one(df, col):
    return [r[0] for r in df.select(col).collect()]


def test_gold_vs_training_distance_bands(spark):
    df = spark.createDataFrame([(80.0,), (300.0,), (900.0,), (1600.0,), (1800.0,), (None,)], "d double")
    gold = _one(df, X.lt_bands("d", K.GOLD_DISTANCE_BANDS, K.GOLD_DISTANCE_ELSE))
    train = _one(df, X.right_closed_bins("d", K.TRAIN_DISTANCE_BINS))
    assert gold == ["short", "medium", "long", "very_long", "very_long", "very_long"]
    assert train == ["same_city", "short", "regional", "long", "long", "nan"]


def test_weight_bands(spark):
    df = spark.createDataFrame([(0.5,), (1.0,), (2.0,), (5.0,), (10.0,), (15.0,), (None,)], "w double")
    assert _one(df, X.lt_bands("w", K.GOLD_WEIGHT_BANDS, K.GOLD_WEIGHT_ELSE)) == [
        "light", "medium", "medium", "heavy", "heavy", "bulky", "bulky"]
    assert _one(df, X.right_closed_bins("w", K.TRAIN_WEIGHT_BINS)) == [
        "very_light", "light", "light", "medium", "heavy", "very_heavy", "nan"]


def test_safe_and_eps_divide(spark):
    df = spark.createDataFrame([(4.0, 0.0), (4.0, None), (4.0, 2.0)], "a double, b double")
    assert _one(df, X.safe_divide("a", "b")) == [None, None, 2.0]
    eps = _one(df.where("b = 0"), X.eps_divide("a", "b"))
    assert abs(eps[0] - 4.0e6) < 1e-3


def test_log_clamp_null_and_negative(spark):
    df = spark.createDataFrame([(None,), (-5.0,), (0.0,)], "x double")
    assert _one(df, X.log1p_clamped("x")) == [None, 0.0, 0.0]
    assert _one(df, X.log1p_filled("x"))[0] == 0.0


def test_risk_maps_case_and_null(spark):
    df = spark.createDataFrame([("low",), ("SEVERE",), (None,)], "t string")
    assert _one(df, X.case_map("t", K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE)) == [0.35, 0.90, 0.35]
    assert _one(df, X.rank_map("t", K.TRAIN_TRAFFIC_RANK, K.TRAIN_TRAFFIC_FILL)) == [0.0, 1.0, 1.0]


def test_same_state_null_semantics(spark):
    rows = [("o1", None, None)]
    df = spark.createDataFrame(rows, "order_id string, state string, dc_state string")
    gold_flag = _one(df, X.flag(F.col("state") == F.col("dc_state")))
    train_flag = _one(df, X.flag(F.col("state").eqNullSafe(F.col("dc_state"))))
    assert gold_flag == [0] and train_flag == [1]


def test_delivery_formulas(spark):
    df = spark.createDataFrame([(79.99, 1.0, "urban", "clear", "low", 0),
                                (1799.0, 0.75, "remote", "storm", "severe", 1),
                                (None, 1.0, "urban", "clear", "low", 0)],
                               "d double, sp double, r string, w string, t string, wk long")
    assert _one(df, D.promised_days("d")) == [1, 6, 8]
    est = _one(df, D.estimated_days("d", "sp", "r", "w", "t", "wk"))
    # 1799/420/0.75 = 5.71 + 1.5 + 1.2 + 0.8 + 0.35 = 9.56 -> 10
    assert est[:2] == [1, 10]


def test_sample_row_training_features(spark):
    """Golden derived fields of a published sample request row."""
    row = {"order_timestamp": "2025-06-01 10:00:00", "order_value": 433.41, "order_weight_kg": 0.26,
           "distance_km": 474.27, "promised_delivery_days": 4, "estimated_delivery_days": 2,
           "state": "SP", "dc_state": "SP", "traffic_condition": "medium", "weather_condition": "rain",
           "route_type": "regional", "carrier_base_delay_rate": 0.0, "delay_risk_label": 0}
    df = spark.createDataFrame([row]).withColumn("order_timestamp", F.col("order_timestamp").cast("timestamp_ntz"))
    r = training_features(df).first()
    assert abs(r["estimated_over_promised"] - 0.499999875) < 1e-12
    assert abs(r["log_order_value"] - 6.073988788613) < 1e-9
    assert abs(r["value_per_kg"] - 1666.955127) < 1e-5
    assert r["distance_band"] == "regional" and r["weight_band"] == "very_light"
    assert abs(r["combined_operational_risk"] - 4.0) < 1e-12  # 1 + 2 + 1 + 0 + 0


def test_gold_zero_divisors(spark):
    from shipcast.operators.features import GOLD_BASE
    vals = {c: None for c in GOLD_BASE}
    vals.update(order_id="x", order_value=10.0, order_weight_kg=0.0, distance_km=0.0, promised_delivery_days=0,
                estimated_delivery_days=3, order_hour=0, order_day_of_week=0, order_month=1)
    schema = ", ".join(f"{c} {'double' if c in ('order_value', 'order_weight_kg', 'distance_km', 'product_fragility_score', 'carrier_base_delay_rate') else ('bigint' if c not in ('order_id', 'city', 'state', 'region', 'product_category', 'carrier', 'dc_id', 'dc_state', 'traffic_condition', 'weather_condition', 'route_type', 'order_timestamp') else 'string')}" for c in GOLD_BASE)
    df = spark.createDataFrame([tuple(vals[c] for c in GOLD_BASE)], schema)
    r = gold_features(df).first()
    assert r["estimated_over_promised"] is None and r["value_per_kg"] is None and r["value_per_km"] is None
    assert r["weight_band"] == "light" and r["distance_band"] == "short"
