"""Feature, profiling and hypothesis queries over the silver / training
layers."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast import oracle as O
from shipcast.operators import metrics as M
from shipcast.operators import quality as Q
from shipcast.operators.evaluate import class_weights
from shipcast.operators.features import (align_features, baseline_features, ml_ready_decisions)
from shipcast.operators.hypotheses import hypothesis_tests
from shipcast.operators.monitor import RULE_INPUTS, rule_score
from shipcast.operators.preprocess import fit as fit_preprocessing
from shipcast.operators.sketches import approx_profile, month_sketches
from shipcast.plans.catalog import INGEST_CUTOFF, RAW_DOUBLES, TRAINING_DOUBLES, _q, ops_orders
from shipcast.plans.medallion import gold_orders, silver_orders, training_table
from shipcast.registry import register, rnd, rounded, sql_rounded
from shipcast.sources.layers import layer
from shipcast.sources.orders import RAW_COLUMNS

R = rnd

RAW_STRINGS = ["order_id", "batch_id", "customer_id", "customer_name", "customer_email", "city", "state", "region",
               "address", "product_id", "product_bought", "product_category", "dc_id", "dc_city", "dc_state",
               "carrier", "delivery_status", "weather_condition", "traffic_condition", "route_type"]
RAW_TIMESTAMPS = ["order_timestamp", "ingestion_timestamp"]
TRAINING_NEW = ["hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin", "month_cos", "same_state_dc",
                "estimated_minus_promised_days", "estimated_over_promised", "log_order_value", "log_distance_km",
                "log_weight_kg", "value_per_kg", "value_per_km", "weight_distance_interaction", "distance_band",
                "weight_band", "traffic_risk_score", "weather_risk_score", "route_risk_score",
                "combined_operational_risk"]
SILVER_COLUMNS = RAW_COLUMNS + ["order_date"]
TRAINING_COLUMNS = SILVER_COLUMNS + TRAINING_NEW
TRAINING_STRINGS = RAW_STRINGS + ["order_date", "distance_band", "weight_band"]
TRAINING_LONGS = [c for c in TRAINING_COLUMNS if c not in TRAINING_STRINGS + RAW_TIMESTAMPS + TRAINING_DOUBLES]
SILVER_NUMERIC = [c for c in RAW_COLUMNS if c not in RAW_STRINGS + RAW_TIMESTAMPS]


def _spark_type(c: str, layer: str) -> str:
    if c in RAW_TIMESTAMPS:
        return "timestamp_ntz"
    if c == "order_date":
        return "date" if layer == "silver" else "string"
    if c in TRAINING_STRINGS:
        return "string"
    if c in TRAINING_DOUBLES:
        return "double"
    return "bigint"


def _training_sql() -> str:
    def cyc(fn: str, c: str, period: int) -> str:
        return f"{fn}({O.d(2.0 * math.pi)} * {c} / {O.d(float(period))})"

    def bins(c: str, spec) -> str:
        parts = []
        for lo, hi, label in spec:
            cond = f"{c} > {O.d(lo)}" + (f" AND {c} <= {O.d(hi)}" if hi is not None else "")
            parts.append(f"WHEN {cond} THEN {O.s(label)}")
        return "CASE " + " ".join(parts) + " ELSE 'nan' END"

    def rank(c: str, mapping, fill) -> str:
        return ("CASE " + " ".join(f"WHEN {c} = {O.s(k)} THEN {O.d(v)}" for k, v in mapping)
                + f" ELSE {O.d(fill)} END")

    eps = O.d(1e-6)
    return f"""
training_a AS (
  SELECT * REPLACE (strftime(order_timestamp, '%Y-%m-%d') AS order_date,
                    CAST(coalesce(CAST(delay_risk_label AS DOUBLE), 0.0) AS BIGINT) AS delay_risk_label),
    {cyc("sin", "order_hour", 24)} AS hour_sin, {cyc("cos", "order_hour", 24)} AS hour_cos,
    {cyc("sin", "order_day_of_week", 7)} AS dow_sin, {cyc("cos", "order_day_of_week", 7)} AS dow_cos,
    {cyc("sin", "order_month", 12)} AS month_sin, {cyc("cos", "order_month", 12)} AS month_cos,
    CAST(CASE WHEN state IS NOT DISTINCT FROM dc_state THEN 1 ELSE 0 END AS BIGINT) AS same_state_dc,
    CAST(estimated_delivery_days - promised_delivery_days AS BIGINT) AS estimated_minus_promised_days,
    estimated_delivery_days / (promised_delivery_days + {eps}) AS estimated_over_promised,
    ln(1 + coalesce(CAST(order_value AS DOUBLE), 0.0)) AS log_order_value,
    ln(1 + coalesce(CAST(distance_km AS DOUBLE), 0.0)) AS log_distance_km,
    ln(1 + coalesce(CAST(order_weight_kg AS DOUBLE), 0.0)) AS log_weight_kg,
    order_value / (order_weight_kg + {eps}) AS value_per_kg,
    order_value / (distance_km + {eps}) AS value_per_km,
    order_weight_kg * distance_km AS weight_distance_interaction,
    {bins("distance_km", K.TRAIN_DISTANCE_BINS)} AS distance_band,
    {bins("order_weight_kg", K.TRAIN_WEIGHT_BINS)} AS weight_band,
    {rank("traffic_condition", K.TRAIN_TRAFFIC_RANK, K.TRAIN_TRAFFIC_FILL)} AS traffic_risk_score,
    {rank("weather_condition", K.TRAIN_WEATHER_RANK, K.TRAIN_WEATHER_FILL)} AS weather_risk_score,
    {rank("route_type", K.TRAIN_ROUTE_RANK, K.TRAIN_ROUTE_FILL)} AS route_risk_score
  FROM silver
),
training AS (
  SELECT *, traffic_risk_score + weather_risk_score + route_risk_score
    + coalesce(carrier_base_delay_rate, 0.0) * {O.d(10.0)}
    + CAST(CASE WHEN estimated_minus_promised_days > 0 THEN 1 ELSE 0 END AS BIGINT) AS combined_operational_risk
  FROM training_a
)"""


O.register_cte("training", ["silver"], _training_sql)


@register("training_features", _q(["training"], f"SELECT * REPLACE ({sql_rounded(TRAINING_DOUBLES)}) FROM training"))
def q_training_features(spark: SparkSession, sf: str) -> DataFrame:
    """Training-set features of every silver order."""
    return rounded(training_table(spark, sf))


@register("baseline_features", _q(["ops"], f"""
SELECT state, city, product_category, {R("order_value")} AS order_value, {R("order_weight_kg")} AS order_weight_kg,
  {R("distance_km")} AS distance_km, carrier, dc_id, promised_delivery_days, estimated_delivery_days,
  CAST(isodow(order_timestamp) - 1 AS BIGINT) AS day_of_week,
  CAST(hour(order_timestamp) AS BIGINT) AS order_hour,
  CAST(CASE WHEN isodow(order_timestamp) - 1 IN (5, 6) THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
  delay_risk_label
FROM ops"""))
def q_baseline_features(spark: SparkSession, sf: str) -> DataFrame:
    """P5: the small trainer's 13 features + label over the operational store."""
    return rounded(baseline_features(ops_orders(spark, sf)))


def _ml_ready_sql() -> str:
    parts = []
    for i, c in enumerate(TRAINING_COLUMNS):
        if c in K.ML_DROP_COLUMNS:
            reason = "'leakage_or_id'"
        elif c == "delay_risk_label":
            reason = "CAST(NULL AS VARCHAR)"
        else:
            card = (f"WHEN count(DISTINCT {c}) > {K.MAX_CAT_CARDINALITY} THEN 'high_cardinality' "
                    if c in TRAINING_STRINGS else "")
            reason = (f"CASE {card}WHEN count({c}) = 0 THEN 'all_null' "
                      f"WHEN min({c}) = max({c}) THEN 'constant' END")
        parts.append(f"SELECT '{c}' AS column_name, CAST({i} AS BIGINT) AS position, "
                     f"count({c}) AS non_null, {reason} AS reason FROM training")
    return "\nUNION ALL\n".join(parts)


@register("ml_ready", lambda: O.with_ctes(["training"], _ml_ready_sql()))
def q_ml_ready(spark: SparkSession, sf: str) -> DataFrame:
    """P9 + P11: which training columns the ML-ready table keeps or drops."""
    return ml_ready_decisions(training_table(spark, sf))


def _audit_sql() -> str:
    parts = []
    for i, c in enumerate(SILVER_COLUMNS):
        parts.append(
            f"SELECT '{c}' AS column_name, CAST({i} AS BIGINT) AS position, '{_spark_type(c, 'silver')}' AS dtype, "
            f"count(DISTINCT {c}) AS nunique, {R(f'100.0 * (count(*) - count({c})) / count(*)')} AS null_pct, "
            f"{'true' if c in K.LEAKAGE_COLUMNS else 'false'} AS is_leakage FROM silver")
    return "\nUNION ALL\n".join(parts)


@register("column_audit", lambda: O.with_ctes(["silver"], _audit_sql()))
def q_column_audit(spark: SparkSession, sf: str) -> DataFrame:
    """A11 + P10: per-column type, distinct values, NULL share, leakage flag."""
    return rounded(Q.column_audit(silver_orders(spark, sf)))


@register("approx_profile")
def q_approx_profile(spark: SparkSession, sf: str) -> DataFrame:
    """A11 + A12, approximate: distinct values and quartiles of every silver
    column, merged from the stored sketches of its months."""
    stored = layer(spark, sf, "sketches", lambda: month_sketches(silver_orders(spark, sf)))
    return approx_profile(stored)


def _numeric_summary_sql() -> str:
    parts = []
    for c in SILVER_NUMERIC:
        v = f"CAST({c} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS column_name, count({c}) AS count, {R(f'avg({v})')} AS mean, "
            f"{R(f'stddev_samp({v})')} AS std, {R(f'min({v})')} AS min, "
            f"{R(f'quantile_cont({v}, 0.25)')} AS p25, {R(f'quantile_cont({v}, 0.5)')} AS p50, "
            f"{R(f'quantile_cont({v}, 0.75)')} AS p75, {R(f'max({v})')} AS max FROM silver")
    return "\nUNION ALL\n".join(parts)


@register("numeric_summary", lambda: O.with_ctes(["silver"], _numeric_summary_sql()))
def q_numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    """describe() of every numeric silver column, exact quartiles."""
    return rounded(Q.numeric_summary(silver_orders(spark, sf)))


@register("data_quality_report", _q(["silver"], f"""
SELECT count(*) AS rows, CAST({len(SILVER_COLUMNS)} AS BIGINT) AS columns,
  min(order_timestamp) AS min_timestamp, max(order_timestamp) AS max_timestamp,
  {R("avg(delay_risk_label)")} AS delay_rate,
  '{", ".join(K.LEAKAGE_COLUMNS)}' AS leakage_columns
FROM silver"""))
def q_data_quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Size, date range, target rate and leakage columns of silver."""
    return rounded(Q.data_quality_report(silver_orders(spark, sf)))


def _corr_sql() -> str:
    cols = [c for c in TRAINING_COLUMNS if c not in TRAINING_STRINGS + RAW_TIMESTAMPS and c != "delay_risk_label"]
    y = "CAST(delay_risk_label AS DOUBLE)"
    parts = [f"SELECT '{c}' AS column_name, CASE WHEN stddev_pop(CAST({c} AS DOUBLE)) > 0 AND stddev_pop({y}) > 0 "
             f"THEN covar_pop(CAST({c} AS DOUBLE), {y}) / (stddev_pop(CAST({c} AS DOUBLE)) * stddev_pop({y})) END AS r "
             f"FROM training" for c in cols]
    return (f"SELECT column_name, {R('r')} AS correlation FROM ({' UNION ALL '.join(parts)}) t "
            "WHERE r IS NOT NULL AND NOT isnan(r) ORDER BY abs(r) DESC, column_name LIMIT 20")


@register("target_correlations", lambda: O.with_ctes(["training"], _corr_sql()))
def q_target_correlations(spark: SparkSession, sf: str) -> DataFrame:
    """Top-20 numeric correlations with the label."""
    return rounded(Q.target_correlations(training_table(spark, sf)))


def _delay_rate_sql() -> str:
    parts = [f"SELECT '{d}' AS dimension, CAST({d} AS VARCHAR) AS value, delay_risk_label AS y FROM training"
             for d in M.DELAY_DIMENSIONS]
    return f"""
SELECT dimension, value, orders, {R("rate")} AS delay_rate, rank FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY dimension ORDER BY rate DESC, value) AS BIGINT) AS rank FROM (
    SELECT dimension, value, count(*) AS orders, avg(y) AS rate FROM ({" UNION ALL ".join(parts)}) s
    GROUP BY dimension, value) g) r
WHERE rank <= 20"""


@register("delay_rate_by", lambda: O.with_ctes(["training"], _delay_rate_sql()))
def q_delay_rate_by(spark: SparkSession, sf: str) -> DataFrame:
    """Delay rate by traffic, weather, carrier, route and state (top 20)."""
    return rounded(M.delay_rate_by(training_table(spark, sf)))


@register("target_distribution", _q(["training"], f"""
SELECT delay_risk_label AS label, count(*) AS orders,
  {R("count(*) / sum(count(*)) OVER ()")} AS share
FROM training GROUP BY delay_risk_label"""))
def q_target_distribution(spark: SparkSession, sf: str) -> DataFrame:
    """Label shares."""
    return rounded(M.target_distribution(training_table(spark, sf)))


@register("class_weights", _q(["training"], f"""
SELECT label, n_class, {R("n / (k * n_class)")} AS weight FROM (
  SELECT delay_risk_label AS label, count(*) AS n_class, sum(count(*)) OVER () AS n,
         count(*) OVER () AS k FROM training GROUP BY delay_risk_label) t"""))
def q_class_weights(spark: SparkSession, sf: str) -> DataFrame:
    """M3: balanced class weights."""
    return rounded(class_weights(training_table(spark, sf)))


def _hyp_sql() -> str:
    rows = []
    for hid, stmt, feat, cond in K.HYPOTHESES:
        if cond == "top_vs_overall":
            continue
        mask = f"{feat} > 0" if cond == "positive" else f"CAST({feat} AS VARCHAR) = '{cond}'"
        rows.append(f"SELECT '{hid}' AS id, {O.s(stmt)} AS hypothesis, '{feat}' AS feature, '{cond}' AS condition, "
                    f"count(*) FILTER (WHERE {mask}) AS segment_count, "
                    f"sum(CAST(delay_risk_label AS DOUBLE)) FILTER (WHERE {mask}) / "
                    f"count(*) FILTER (WHERE {mask}) AS segment_rate FROM training")
    hid, stmt, feat, _ = [h for h in K.HYPOTHESES if h[3] == "top_vs_overall"][0]
    rows.append(f"""SELECT '{hid}' AS id, {O.s(stmt)} AS hypothesis, '{feat}' AS feature, v AS condition,
  coalesce(cnt, 0) AS segment_count, rate AS segment_rate FROM (SELECT 1 AS one) o LEFT JOIN (
  SELECT CAST({feat} AS VARCHAR) AS v, count(*) AS cnt, avg(CAST(delay_risk_label AS DOUBLE)) AS rate
  FROM training GROUP BY {feat}
  HAVING count(*) >= greatest({O.d(K.H10_MIN_GROUP)}, (SELECT count(*) FROM training) * {O.d(K.H10_MIN_SHARE)})
  ORDER BY rate DESC, v LIMIT 1) t ON true""")
    seg = " UNION ALL ".join(rows)
    overall = "(SELECT sum(CAST(delay_risk_label AS DOUBLE)) / count(*) FROM training)"
    return f"""
SELECT id, hypothesis, feature, condition, CAST(segment_count AS BIGINT) AS segment_count,
  {R("segment_rate")} AS segment_rate, {R("overall")} AS overall_rate, {R("lift")} AS lift,
  CASE WHEN segment_count >= {K.HYPOTHESIS_MIN_COUNT} AND lift >= {O.d(K.HYPOTHESIS_MIN_LIFT)}
            AND segment_rate > overall THEN 'TRUE'
       WHEN segment_count >= {K.HYPOTHESIS_MIN_COUNT} THEN 'FALSE' ELSE 'INCONCLUSIVE' END AS verdict,
  CASE WHEN lift IS NOT NULL THEN printf('Orders matching %s=%s have %.2fx the average delay rate.',
       feature, condition, lift) ELSE 'Insufficient sample.' END AS business_insight
FROM (SELECT *, CASE WHEN overall <> 0 AND segment_count > 0 THEN segment_rate / overall END AS lift
      FROM (SELECT s.*, {overall} AS overall FROM ({seg}) s) a) b"""


@register("hypothesis_tests", lambda: O.with_ctes(["training"], _hyp_sql()))
def q_hypothesis_tests(spark: SparkSession, sf: str) -> DataFrame:
    """A10: hypotheses H1–H10 with counts, rates, lift and verdict."""
    return rounded(hypothesis_tests(training_table(spark, sf)))


MODEL_FEATURES = ["order_value", "order_weight_kg", "product_fragility_score", "distance_km",
                  "carrier_base_delay_rate", "promised_delivery_days", "estimated_delivery_days",
                  "estimated_minus_promised_days", "estimated_over_promised", "log_order_value", "log_distance_km",
                  "log_weight_kg", "value_per_kg", "value_per_km", "weight_distance_interaction",
                  "order_day_of_week", "order_hour", "is_weekend", "is_peak_hour", "hour_sin", "hour_cos",
                  "dow_sin", "dow_cos", "city", "state", "region", "product_category", "carrier", "dc_id",
                  "dc_state", "traffic_condition", "weather_condition", "route_type", "same_state_dc",
                  "distance_band", "weight_band", "order_day", "traffic_risk_score", "weather_risk_score",
                  "route_risk_score", "combined_operational_risk"]
# A serving-side request that also expects a feature the tables do not have.
SERVING_FEATURES = MODEL_FEATURES + ["customer_segment"]


def _align_sql() -> str:
    cols = []
    for f in SERVING_FEATURES:
        if f in TRAINING_COLUMNS:
            cols.append(R(f) + f" AS {f}" if f in TRAINING_DOUBLES else f)
        else:
            cols.append(f"CAST(NULL AS VARCHAR) AS {f}")
    return f"SELECT order_id, {', '.join(cols)} FROM gold"


@register("align_features", lambda: O.with_ctes(["gold"], _align_sql()))
def q_align_features(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows aligned to the serving feature list (missing features
    as typed NULLs, fixed order, other columns dropped)."""
    out = align_features(gold_orders(spark, sf), SERVING_FEATURES, types={"customer_segment": "string"},
                         keep=["order_id"])
    return rounded(out)


__all__ = ["RAW_DOUBLES"]


@register("stratified_split", _q(["ops"], """
SELECT order_id, delay_risk_label,
  CASE WHEN row_number() OVER (PARTITION BY delay_risk_label ORDER BY md5(order_id || '|42'), order_id)
            <= ceil(CAST(count(*) OVER (PARTITION BY delay_risk_label) AS DOUBLE) * CAST(0.2 AS DOUBLE))
       THEN 'test' ELSE 'train' END AS split
FROM ops"""))
def q_stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    """M1: exact stratified 80/20 split of the operational orders (seed 42)."""
    from shipcast.plans.training import stratified_split
    ops = ops_orders(spark, sf).select("order_id", "delay_risk_label")
    return stratified_split(ops, "delay_risk_label", "order_id", 0.2, 42)


# -- M2, M9 -------------------------------------------------------------------------

NUMBERS, TEXTS = ["distance_km", "order_value", "order_weight_kg", "carrier_base_delay_rate"], ["carrier", "traffic_condition", "product_category"]


def _preprocessed_sql() -> str:
    fills = ", ".join([f"median({c}) AS {c}" for c in NUMBERS])
    scales = ", ".join(f"nullif(stddev_pop(coalesce(t.{c}, m.{c})), 0) AS {c}" for c in NUMBERS)
    codes = "".join(f""",
code_{c} AS (SELECT {c}, CAST(row_number() OVER (ORDER BY {c}) - 1 AS INTEGER) AS code FROM (SELECT DISTINCT {c} FROM t WHERE {c} IS NOT NULL) x),
mode_{c} AS (SELECT {c} FROM (SELECT {c}, count(*) AS n FROM t WHERE {c} IS NOT NULL GROUP BY {c}) x ORDER BY n DESC, {c} LIMIT 1)""" for c in TEXTS)
    scaled = ", ".join(f"{rnd(f'coalesce(o.{c}, m.{c}) / coalesce(s.{c}, 1)')} AS {c}_scaled" for c in NUMBERS)
    coded = ", ".join(f"coalesce((SELECT code FROM code_{c} k WHERE k.{c} = coalesce(o.{c}, (SELECT {c} FROM mode_{c}))), -1) AS {c}_code" for c in TEXTS)
    ones = " + ".join(f"CASE WHEN {c}_code >= 0 THEN 1 ELSE 0 END" for c in TEXTS)
    return f""",  -- the fitted tables are further common table expressions
t AS (SELECT * FROM ops WHERE order_timestamp < TIMESTAMP '{INGEST_CUTOFF}'),
m AS (SELECT {fills} FROM t),
s AS (SELECT {scales} FROM t, m){codes},
p AS (SELECT order_id, {scaled}, {coded} FROM ops o, m, s)
SELECT *, {ones} AS indicators, {len(NUMBERS)} + {" + ".join(f"(SELECT count(*) FROM code_{c})" for c in TEXTS)} AS n_features FROM p"""


@register("preprocessed_features", lambda: O.with_ctes(["ops"], _preprocessed_sql()))
def q_preprocessed_features(spark: SparkSession, sf: str) -> DataFrame:
    """M2: exact medians, scales and category numbers, fitted on the orders
    before the cutoff and applied to all; how many indicators are set, and the
    length of the feature vector."""
    ops = ops_orders(spark, sf)
    own = fit_preprocessing(ops.where(F.col("order_timestamp") < F.lit(INGEST_CUTOFF).cast("timestamp_ntz")), NUMBERS, TEXTS)
    out = own.apply(ops, ["order_id"])
    ones = F.aggregate(F.slice("features", len(NUMBERS) + 1, 100_000), F.lit(0.0), lambda n, x: n + x).cast("int")
    return rounded(out.withColumn("indicators", ones).withColumn("n_features", F.size("features").cast("long")).drop("features"))


IMPORTANT = ["distance_km", "weather_condition", "traffic_condition", "carrier_base_delay_rate"]


def _importance_sql() -> str:
    ways = ", ".join(f"('{f}', {r})" for f in IMPORTANT for r in range(2))
    taken = ", ".join(f"CASE WHEN v.f = '{c}' THEN g.{c} ELSE b.{c} END AS {c}" for c in IMPORTANT)
    return O.with_ctes(["ops"], f"""
SELECT feature, {rnd("avg(base - ap)")} AS importance_mean, {rnd("stddev_pop(base - ap)")} AS importance_std FROM (
  WITH b AS (SELECT *, row_number() OVER (ORDER BY md5(order_id || '|42')) AS i FROM ops),
  v(f, r) AS (VALUES {ways}),
  g AS (SELECT f, r, {", ".join(IMPORTANT)}, row_number() OVER (PARTITION BY f, r ORDER BY md5(order_id || '|42|' || f || '|' || r)) AS i FROM ops, v),
  p AS (SELECT v.f, v.r, b.* REPLACE ({taken}) FROM b JOIN g ON g.i = b.i JOIN v ON v.f = g.f AND v.r = g.r),
  s AS (SELECT f, r, delay_risk_label AS y, {O.rule_probability_sql()} AS score FROM p
        UNION ALL SELECT '', 0, delay_risk_label, {O.rule_probability_sql()} FROM ops),
  c AS (SELECT f, r, score, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, count(*) AS n FROM s GROUP BY f, r, score),
  u AS (SELECT *, sum(pos) OVER w AS tp, sum(n) OVER w AS k FROM c WINDOW w AS (PARTITION BY f, r ORDER BY score DESC)),
  a AS (SELECT f, r, sum(pos * (tp / CAST(k AS DOUBLE))) / sum(pos) AS ap FROM u GROUP BY f, r)
  SELECT x.f AS feature, x.ap, y.ap AS base FROM a x, a y WHERE x.f <> '' AND y.f = '') z GROUP BY feature""")


@register("permutation_importance", _importance_sql)
def q_permutation_importance(spark: SparkSession, sf: str) -> DataFrame:
    """M9 over all operational orders and the rule scorer: two seeded
    permutations of each of four features."""
    from shipcast.plans.training import importance_of

    ops = ops_orders(spark, sf).select("order_id", "delay_risk_label", *RULE_INPUTS)
    score = lambda df: rule_score(df).withColumnRenamed("rule_probability", "score")
    return rounded(importance_of(ops, score, IMPORTANT, "delay_risk_label", repeats=2, seed=42, scored=RULE_INPUTS))
