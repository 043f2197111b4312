"""Scoring and monitoring queries over the replayed predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast import oracle as O
from shipcast.functions import expr as X
from shipcast.operators import evaluate as EV
from shipcast.operators import monitor as MO
from shipcast.plans.catalog import AS_OF, GOLD_DOUBLES, _q, ops_orders, performance, predictions
from shipcast.plans.medallion import gold_orders, gold_table
from shipcast.registry import register, rnd, round_half_away, rounded, sql_rounded, xavg

R = rnd
MODEL_VERSION = "rule-baseline-v1"


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions with their true labels (and carrier) from the operational
    store: one row per prediction."""
    labels = ops_orders(spark, sf).select("order_id", "delay_risk_label", "carrier", "traffic_condition",
                                          "weather_condition", "route_type", "carrier_base_delay_rate")
    return predictions(spark, sf).join(labels, "order_id")


SCORED_SQL = """SELECT p.*, o.delay_risk_label, o.carrier, o.traffic_condition, o.weather_condition, o.route_type,
  o.carrier_base_delay_rate FROM predictions p JOIN ops o ON p.order_id = o.order_id"""


def metrics_sql(src: str, group: list[str] | None = None) -> str:
    """Batch metrics in SQL over ``src`` with columns (group..., y, p, s, b)."""
    group = group or []
    gsel = "".join(f"{c}, " for c in group)
    gby = f"GROUP BY {', '.join(group)}" if group else ""
    part = f"PARTITION BY {', '.join(group)} " if group else ""
    on = " AND ".join(f"base.{c} = aa.{c}" for c in group) or "true"

    def ratio(a: str, b: str) -> str:
        return R(f"CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END")

    return f"""(
WITH src AS ({src}),
base AS (
  SELECT {gsel}count(*) AS evaluated_rows, count(*) FILTER (WHERE y = 1) AS positive_labels,
    count(*) FILTER (WHERE p = 1) AS positive_predictions,
    count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn,
    {xavg("s", 10)} AS avg_s, count(*) FILTER (WHERE b = 'high') AS hi, count(*) FILTER (WHERE b = 'medium') AS me,
    count(*) FILTER (WHERE b = 'low') AS lo
  FROM src {gby}),
curve AS (
  SELECT {gsel}s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
  FROM src GROUP BY {gsel}s),
cum AS (
  SELECT *, sum(pos) OVER ({part}ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp_c,
            sum(neg) OVER ({part}ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp_c
  FROM curve),
aa AS (
  SELECT {gsel}sum(pos) AS P, sum(neg) AS N, sum(pos * (fp_c - neg * 0.5)) AS a,
    sum(pos * (tp_c / (tp_c + fp_c))) AS pp
  FROM cum {gby})
SELECT {"".join(f"base.{c}, " for c in group)}
  CAST(evaluated_rows AS BIGINT) AS evaluated_rows, CAST(positive_labels AS BIGINT) AS positive_labels,
  CAST(positive_predictions AS BIGINT) AS positive_predictions,
  {ratio("tp + tn", "evaluated_rows")} AS accuracy,
  {ratio("tp", "tp + fp")} AS precision,
  {ratio("tp", "tp + fn")} AS recall,
  {ratio("2 * tp", "2 * tp + fp + fn")} AS f1,
  {R("CASE WHEN P > 0 AND N > 0 THEN 1.0 - a / (P * N) END")} AS roc_auc,
  {R("CASE WHEN P > 0 AND N > 0 THEN pp / P END")} AS average_precision,
  CAST(tp AS BIGINT) AS true_positives, CAST(fp AS BIGINT) AS false_positives,
  CAST(fn AS BIGINT) AS false_negatives, CAST(tn AS BIGINT) AS true_negatives,
  {R("avg_s")} AS avg_delay_probability, CAST(hi AS BIGINT) AS high_risk_orders,
  CAST(me AS BIGINT) AS medium_risk_orders, CAST(lo AS BIGINT) AS low_risk_orders
FROM base LEFT JOIN aa ON {on})"""


SCORED_YPSB = ("SELECT delay_risk_label AS y, delay_prediction AS p, delay_probability AS s, risk_band AS b "
               f"FROM ({SCORED_SQL}) x")


# -- predictions listings and summaries (A6, A7, T4) ------------------------------------

@register("prediction_summary", _q(["predictions"], f"""
SELECT count(*) AS total_predictions, {R(f"coalesce({xavg('delay_probability', 10)}, 0.0)")} AS avg_delay_probability,
  count(*) FILTER (WHERE risk_band = 'high') AS high_risk_orders,
  count(*) FILTER (WHERE risk_band = 'medium') AS medium_risk_orders,
  count(*) FILTER (WHERE risk_band = 'low') AS low_risk_orders,
  max(prediction_timestamp) AS last_prediction_timestamp
FROM predictions"""))
def q_prediction_summary(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(MO.prediction_summary(predictions(spark, sf)))


@register("risk_distribution", _q(["predictions"], f"""
SELECT risk_band, count(*) AS orders, {R(xavg("delay_probability", 10))} AS avg_delay_probability
FROM predictions GROUP BY risk_band"""))
def q_risk_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(MO.risk_distribution(predictions(spark, sf)))


@register("latest_predictions", _q(["predictions"], f"""
SELECT order_id, prediction_timestamp, {R("delay_probability")} AS delay_probability, delay_prediction, risk_band,
  endpoint_id, model_version
FROM predictions ORDER BY prediction_timestamp DESC, order_id LIMIT 100"""))
def q_latest_predictions(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(MO.latest_predictions(predictions(spark, sf), 100))


# -- J1, P14, P15, A16, A17 ---------------------------------------------------------------

@register("unscored_orders", _q(["gold", "predictions"], f"""
SELECT * REPLACE ({sql_rounded(GOLD_DOUBLES)}) FROM gold g
WHERE g.order_timestamp >= TIMESTAMP '{AS_OF}' - INTERVAL {K.SCORING_LOOKBACK_DAYS} DAY
  AND NOT EXISTS (SELECT 1 FROM predictions p WHERE p.order_id = g.order_id)"""))
def q_unscored_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Gold rows in the 7-day lookback that have no prediction.
    Neither table is read before the lookback: an order is scored after it
    was placed."""
    start = MO.lookback_start(AS_OF)
    return rounded(MO.unscored_orders(gold_table(spark, sf, start), predictions(spark, sf, start), AS_OF))


@register("scored_today", _q(["gold", "predictions"], f"""
SELECT CAST(TIMESTAMP '{AS_OF}' AS DATE) AS as_of_date,
  (SELECT count(*) FROM predictions WHERE CAST(prediction_timestamp AS DATE) = CAST(TIMESTAMP '{AS_OF}' AS DATE))
    AS scored_today,
  (SELECT count(*) FROM gold) AS source_rows"""))
def q_scored_today(spark: SparkSession, sf: str) -> DataFrame:
    return MO.scored_today(predictions(spark, sf, MO.lookback_start(AS_OF, 1)), gold_orders(spark, sf), AS_OF)


# A daily limit that the as-of day has partly used up on the test tables (the operator's default is 300).
DAILY_LIMIT = 60


@register("remaining_quota", _q(["predictions"], f"""
SELECT scored_today, CAST(greatest(0, least({K.BATCH_SIZE}, {DAILY_LIMIT} - scored_today)) AS BIGINT)
  AS remaining_quota
FROM (SELECT count(*) FILTER (WHERE CAST(prediction_timestamp AS DATE) = CAST(TIMESTAMP '{AS_OF}' AS DATE))
      AS scored_today FROM predictions) t"""))
def q_remaining_quota(spark: SparkSession, sf: str) -> DataFrame:
    today = predictions(spark, sf, MO.lookback_start(AS_OF, 1)).where(MO.on_day(F.col("prediction_timestamp"), AS_OF))
    return MO.remaining_quota(today.agg(F.count(F.lit(1)).alias("scored_today")), daily_limit=DAILY_LIMIT)


# -- J2, J3, A19, P13 -----------------------------------------------------------------------

def _latest_batch_sql(before: str) -> str:
    src = f"""SELECT p.prediction_timestamp AS g, f.delay_risk_label AS y, p.delay_prediction AS p,
  p.delay_probability AS s, p.risk_band AS b
FROM predictions p JOIN gold f ON p.order_id = f.order_id
WHERE p.prediction_timestamp = (SELECT max(prediction_timestamp) FROM predictions
                                WHERE prediction_timestamp < TIMESTAMP '{before}')
  AND f.delay_risk_label IS NOT NULL"""
    return f"SELECT g AS run_timestamp, m.* EXCLUDE (g), 'latest_prediction_batch' AS comparison_source " \
           f"FROM {metrics_sql(src, ['g'])} m"


@register("latest_batch_performance", lambda: O.with_ctes(["gold", "predictions"], _latest_batch_sql(AS_OF)))
def q_latest_batch_performance(spark: SparkSession, sf: str) -> DataFrame:
    """J2 + J3: metrics of the newest prediction batch before the as-of time."""
    return rounded(MO.latest_batch_performance(predictions(spark, sf), gold_orders(spark, sf), AS_OF))


# -- A18, W1, M7, M10–M13 ---------------------------------------------------------------------

@register("confusion_counts", _q(["predictions"], f"""
SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS true_positives,
  count(*) FILTER (WHERE y = 0 AND p = 1) AS false_positives,
  count(*) FILTER (WHERE y = 1 AND p = 0) AS false_negatives,
  count(*) FILTER (WHERE y = 0 AND p = 0) AS true_negatives,
  count(*) FILTER (WHERE y = 1) AS positive_labels, count(*) AS evaluated_rows
FROM ({SCORED_YPSB}) t"""))
def q_confusion_counts(spark: SparkSession, sf: str) -> DataFrame:
    return EV.confusion_counts(scored(spark, sf), "delay_risk_label", "delay_prediction")


@register("score_curve", _q(["predictions"], f"""
SELECT s AS score, pos, neg,
  CAST(sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS tp,
  CAST(sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS BIGINT) AS fp
FROM (SELECT s, CAST(sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS BIGINT) AS pos,
             CAST(sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS BIGINT) AS neg
      FROM ({SCORED_YPSB}) t GROUP BY s) c"""))
def q_score_curve(spark: SparkSession, sf: str) -> DataFrame:
    """Cumulative tp / fp per distinct score, highest score first."""
    return EV.score_curve(scored(spark, sf), "delay_risk_label", "delay_probability")


def _threshold_sql(src: str) -> str:
    return f"""
SELECT threshold, {R("bs")} AS business_score, {R("prec")} AS precision, {R("rec")} AS recall,
  {R("f1")} AS f1 FROM (
  SELECT s AS threshold,
    ({O.d(K.VALUE_TRUE_POSITIVE)} * tp - {O.d(K.COST_FALSE_POSITIVE)} * fp
     - {O.d(K.COST_FALSE_NEGATIVE)} * (P - tp)) / (P + N)
      - CASE WHEN (CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END) < {O.d(K.MIN_PRECISION)}
             THEN {O.d(K.LOW_PRECISION_PENALTY)} ELSE 0.0 END AS bs,
    CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS prec,
    CASE WHEN P > 0 THEN tp / P ELSE 0.0 END AS rec,
    CASE WHEN 2 * tp + fp + (P - tp) > 0 THEN 2.0 * tp / (2 * tp + fp + (P - tp)) ELSE 0.0 END AS f1
  FROM (SELECT s, sum(pos) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS tp,
               sum(neg) OVER (ORDER BY s DESC ROWS UNBOUNDED PRECEDING) AS fp,
               sum(pos) OVER () AS P, sum(neg) OVER () AS N
        FROM (SELECT s, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
              FROM ({src}) t GROUP BY s) c) w
) x ORDER BY bs DESC, threshold ASC LIMIT 1"""


@register("choose_threshold", lambda: O.with_ctes(["predictions"], _threshold_sql(SCORED_YPSB)))
def q_choose_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """M7: the business-optimal threshold on the rule scores."""
    return rounded(EV.choose_threshold(scored(spark, sf), "delay_risk_label", "delay_probability"))


def _business_sql() -> str:
    names = ["true_positives", "false_positives", "false_negatives", "true_negatives", "model_value",
             "baseline_value", "incremental_value", "incremental_value_per_1000_orders"]
    exprs = ["tp", "fp", "fn", "tn", "mv", "bv", "mv - bv", "CASE WHEN n > 0 THEN (mv - bv) / n * 1000.0 END"]
    body = ", ".join(f"{{'position': {i}, 'metric': '{nm}', 'value': CAST({e} AS DOUBLE)}}"
                     for i, (nm, e) in enumerate(zip(names, exprs)))
    return f"""
SELECT CAST(r.position AS BIGINT) AS position, r.metric AS metric, {R("r.value")} AS value FROM (
  SELECT unnest([{body}]) AS r FROM (
    SELECT *, {O.d(K.VALUE_TRUE_POSITIVE)} * tp - {O.d(K.COST_FALSE_POSITIVE)} * fp
      - {O.d(K.COST_FALSE_NEGATIVE)} * fn AS mv, -pos * {O.d(K.COST_FALSE_NEGATIVE)} AS bv FROM (
      SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
        count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn,
        count(*) FILTER (WHERE y = 1) AS pos, count(*) AS n
      FROM ({SCORED_YPSB}) t) c) v) u"""


@register("business_value", lambda: O.with_ctes(["predictions"], _business_sql()))
def q_business_value(spark: SparkSession, sf: str) -> DataFrame:
    """Business value of the scorer's 0.5 class vs flagging nothing."""
    return rounded(EV.business_value(scored(spark, sf), "delay_risk_label", "delay_prediction"))


@register("error_analysis", _q(["predictions"], f"""
SELECT error_type, carrier AS segment, count(*) AS orders FROM (
  SELECT CASE WHEN delay_risk_label = 1 AND delay_prediction = 0 THEN 'false_negative'
              WHEN delay_risk_label = 0 AND delay_prediction = 1 THEN 'false_positive' END AS error_type, carrier
  FROM ({SCORED_SQL}) x) t
WHERE error_type IS NOT NULL GROUP BY error_type, carrier"""))
def q_error_analysis(spark: SparkSession, sf: str) -> DataFrame:
    """False negatives / positives by carrier."""
    return EV.error_analysis(scored(spark, sf), "delay_risk_label", "delay_prediction", "carrier")


def _report_sql() -> str:
    def ratio(a: str, b: str) -> str:
        return f"(CASE WHEN {b} > 0 THEN CAST({a} AS DOUBLE) / ({b}) ELSE 0.0 END)"

    def f1(p: str, r: str) -> str:
        return f"(CASE WHEN {p} + {r} > 0 THEN 2.0 * {p} * {r} / ({p} + {r}) ELSE 0.0 END)"
    return f"""
SELECT class_label, {R("pr")} AS precision, {R("rc")} AS recall, {R("f")} AS f1_score,
  CAST(sup AS BIGINT) AS support FROM (
  SELECT '0' AS class_label, p0 AS pr, r0 AS rc, {f1("p0", "r0")} AS f, s0 AS sup FROM m
  UNION ALL SELECT '1', p1, r1, {f1("p1", "r1")}, s1 FROM m
  UNION ALL SELECT 'accuracy', NULL, NULL, {ratio("tp + tn", "n")}, n FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, ({f1("p0", "r0")} + {f1("p1", "r1")}) / 2.0, n FROM m
  UNION ALL SELECT 'weighted avg', {ratio("p0 * s0 + p1 * s1", "n")}, {ratio("r0 * s0 + r1 * s1", "n")},
    {ratio(f"{f1('p0', 'r0')} * s0 + {f1('p1', 'r1')} * s1", "n")}, n FROM m) t"""


def _report_ctes() -> str:
    return f"""
m0 AS (
  SELECT count(*) FILTER (WHERE y = 1 AND p = 1) AS tp, count(*) FILTER (WHERE y = 0 AND p = 1) AS fp,
    count(*) FILTER (WHERE y = 1 AND p = 0) AS fn, count(*) FILTER (WHERE y = 0 AND p = 0) AS tn, count(*) AS n
  FROM ({SCORED_YPSB}) t),
m AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS p1,
    CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS r1,
    CASE WHEN tn + fn > 0 THEN CAST(tn AS DOUBLE) / (tn + fn) ELSE 0.0 END AS p0,
    CASE WHEN tn + fp > 0 THEN CAST(tn AS DOUBLE) / (tn + fp) ELSE 0.0 END AS r0,
    tp + fn AS s1, tn + fp AS s0
  FROM m0)"""


O.register_cte("report_m", ["predictions"], _report_ctes)


@register("classification_report", lambda: O.with_ctes(["report_m"], _report_sql()))
def q_classification_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per-class precision / recall / f1 / support with averages."""
    return rounded(EV.classification_report(scored(spark, sf), "delay_risk_label", "delay_prediction"))


@register("prediction_metrics", lambda: O.with_ctes(["predictions"], f"SELECT * FROM {metrics_sql(SCORED_YPSB)} m"))
def q_prediction_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of all stored predictions against their labels."""
    return rounded(EV.prediction_metrics(scored(spark, sf), "delay_risk_label", "delay_prediction",
                                         "delay_probability", "risk_band"))


# -- W2, T5, T6, M14, M15 ---------------------------------------------------------------------

def _runs_sql() -> str:
    src = (f"SELECT prediction_timestamp AS g, coalesce(delay_risk_label, 0) AS y, delay_prediction AS p, "
           f"delay_probability AS s, risk_band AS b FROM predictions pr LEFT JOIN "
           f"(SELECT order_id, delay_risk_label FROM ops) o USING (order_id)")
    return f"runs AS (SELECT * FROM {metrics_sql(src, ['g'])} m)"


O.register_cte("runs", ["predictions"], _runs_sql)
BASE_METRICS = MO.BASELINE_METRICS


def _history_sql() -> str:
    cols = ", ".join(
        f"lag({m}) OVER w AS baseline_{m}, {R(f'{m} - lag({m}) OVER w')} AS {m}_delta" for m in BASE_METRICS)
    return f"""
SELECT g AS run_timestamp, * EXCLUDE (g), lag(g) OVER w AS baseline_run_timestamp, {cols}
FROM runs WINDOW w AS (ORDER BY g)"""


@register("performance_history", lambda: O.with_ctes(["runs"], _history_sql()))
def q_performance_history(spark: SparkSession, sf: str) -> DataFrame:
    """Every scoring run with the previous run's metrics and deltas."""
    return rounded(MO.performance_history(performance(spark, sf)))


@register("last_performance", lambda: O.with_ctes(["runs"], f"""
SELECT * FROM ({_history_sql()}) h ORDER BY run_timestamp DESC LIMIT 1"""))
def q_last_performance(spark: SparkSession, sf: str) -> DataFrame:
    """The last recorded run, with the deltas to the one before it."""
    last_two = MO.newest_runs(performance(spark, sf), 2)
    return rounded(MO.last_performance(MO.performance_history(last_two)))


def _perf_row_sql() -> str:
    metric_cols = ", ".join(f"cur.{c}" for c in EV.METRIC_COLUMNS)
    base = ", ".join(f"prev.{m} AS baseline_{m}" for m in BASE_METRICS)
    deltas = ", ".join(f"{R(f'cur.{m} - prev.{m}')} AS {m}_delta" for m in BASE_METRICS)
    ts = "strftime(cur.g, '%Y-%m-%d %H:%M:%S')"
    return f"""
SELECT sha256({ts} || '|' || '{MODEL_VERSION}') AS run_id, cur.g AS run_timestamp, CAST(cur.g AS DATE) AS run_date,
  '{MODEL_VERSION}' AS model_version, 'local' AS scoring_mode, 'local' AS endpoint_id, {metric_cols},
  prev.g AS baseline_run_timestamp, {base}, {deltas},
  coalesce(round(cur.accuracy - prev.accuracy, 6) + 0.0 <= {O.d(-abs(K.ACCURACY_DROP_ALERT_THRESHOLD))}, false)
    AS accuracy_drop_alert,
  coalesce(round(cur.f1 - prev.f1, 6) + 0.0 <= {O.d(-abs(K.F1_DROP_ALERT_THRESHOLD))}, false) AS f1_drop_alert,
  CASE WHEN prev.g IS NOT NULL THEN 'performance_table' END AS comparison_source,
  cur.g AS created_at
FROM (SELECT * FROM runs ORDER BY g DESC LIMIT 1) cur
LEFT JOIN (SELECT * FROM runs ORDER BY g DESC LIMIT 1 OFFSET 1) prev ON true"""


@register("performance_row", lambda: O.with_ctes(["runs"], _perf_row_sql()))
def q_performance_row(spark: SparkSession, sf: str) -> DataFrame:
    """M14 + M15: the monitoring row of the newest run; baseline = the last
    recorded run before it (else the previous batch), NULL-safe deltas and
    drop alerts."""
    runs = performance(spark, sf)
    last_ts = runs.agg(F.max("prediction_timestamp")).first()[0]  # the run being recorded: one scalar
    ts = last_ts.strftime("%Y-%m-%d %H:%M:%S")
    lit_ts = F.lit(ts).cast("timestamp_ntz")
    current = runs.where(F.col("prediction_timestamp") == lit_ts)
    earlier = runs.where(F.col("prediction_timestamp") < lit_ts)
    recorded = MO.newest_runs(earlier, 1).withColumnRenamed("prediction_timestamp", "run_timestamp")
    previous_batch = None
    if earlier.isEmpty():
        previous_batch = rounded(MO.latest_batch_performance(predictions(spark, sf), gold_orders(spark, sf), ts))
    row = MO.performance_row(current, recorded, previous_batch, ts, model_version=MODEL_VERSION)
    return rounded(row)


# -- M8: candidate evaluation and selection ------------------------------------------------------

def _candidates(df: DataFrame) -> list[tuple[str, object]]:
    gold_mean = (X.case_map("traffic_condition", K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE)
                 + X.case_map("weather_condition", K.GOLD_WEATHER_RISK, K.GOLD_WEATHER_ELSE)
                 + X.case_map("route_type", K.GOLD_ROUTE_RISK, K.GOLD_ROUTE_ELSE)) / F.lit(3.0)
    return [("rule_probability", F.col("delay_probability")),
            ("gold_operational_risk", gold_mean),
            ("carrier_base_rate", F.col("carrier_base_delay_rate"))]


def _cand_sql() -> list[tuple[str, str]]:
    def gold(col: str, mapping, default) -> str:
        return ("CASE lower(coalesce(" + col + ", '')) "
                + " ".join(f"WHEN {O.s(k)} THEN {O.d(v)}" for k, v in mapping) + f" ELSE {O.d(default)} END")
    mean = (f"(({gold('traffic_condition', K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE)}) + "
            f"({gold('weather_condition', K.GOLD_WEATHER_RISK, K.GOLD_WEATHER_ELSE)}) + "
            f"({gold('route_type', K.GOLD_ROUTE_RISK, K.GOLD_ROUTE_ELSE)})) / {O.d(3.0)}")
    return [("rule_probability", "delay_probability"), ("gold_operational_risk", mean),
            ("carrier_base_rate", "carrier_base_delay_rate")]


def _select_best_sql() -> str:
    w = K.SELECTION_WEIGHTS
    parts = []
    for i, (name, expr) in enumerate(_cand_sql()):
        src = f"SELECT delay_risk_label AS y, {expr} AS s FROM ({SCORED_SQL}) x"
        th = _threshold_sql(src)
        ypsb = (f"SELECT y, CASE WHEN s >= (SELECT threshold FROM ({th}) t0) THEN 1 ELSE 0 END AS p, s, "
                f"CAST(NULL AS VARCHAR) AS b FROM ({src}) z")
        parts.append(f"""SELECT CAST({i} AS BIGINT) AS position, '{name}' AS name, m.roc_auc, m.average_precision,
  m.accuracy, m.precision, m.recall, m.f1, t.threshold,
  {R(f"{w[0]} * m.recall + {w[1]} * m.roc_auc + {w[2]} * m.average_precision + {w[3]} * m.precision")}
    AS selection_score,
  m.true_negatives AS tn, m.false_positives AS fp, m.false_negatives AS fn, m.true_positives AS tp,
  t.business_score AS business_score_per_order
FROM {metrics_sql(ypsb)} m, ({th}) t""")
    allc = " UNION ALL ".join(parts)
    return f"""
SELECT c.*, c.name = (SELECT name FROM ({allc}) b ORDER BY selection_score DESC, position LIMIT 1) AS is_best
FROM ({allc}) c"""


@register("select_best_model", lambda: O.with_ctes(["predictions"], _select_best_sql()))
def q_select_best_model(spark: SparkSession, sf: str) -> DataFrame:
    """Three deterministic scorers evaluated at their business
    thresholds (AUC, AP, precision, recall, f1), ranked by the selection
    score; the best is flagged."""
    s = scored(spark, sf)
    cands = _candidates(s)
    positions = {n: i for i, (n, _e) in enumerate(cands)}
    long = s.select(F.col("delay_risk_label").alias("label"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), e.alias("score")) for n, e in cands])).alias("c")
    ).select("c.name", "label", "c.score")
    r = rounded(EV.evaluate_candidates(long))
    pos = F.lit(None).cast("long")
    for n, i in positions.items():
        pos = F.when(F.col("name") == n, F.lit(i).cast("long")).otherwise(pos)
    w = K.SELECTION_WEIGHTS  # score of the reported (6-decimal) metrics
    r = r.withColumn("position", pos).withColumn("selection_score", round_half_away(
        F.lit(w[0]) * F.col("recall") + F.lit(w[1]) * F.col("roc_auc")
        + F.lit(w[2]) * F.col("average_precision") + F.lit(w[3]) * F.col("precision")))
    return EV.select_best_model(r)


def _rank_by_recall_sql() -> str:
    parts = []
    for i, (name, expr) in enumerate(_cand_sql()):
        ypsb = (f"SELECT delay_risk_label AS y, CASE WHEN {expr} >= {O.d(K.CLASS_THRESHOLD)} THEN 1 ELSE 0 END AS p, "
                f"{expr} AS s, CAST(NULL AS VARCHAR) AS b FROM ({SCORED_SQL}) x")
        parts.append(f"SELECT CAST({i} AS BIGINT) AS position, '{name}' AS name, precision, recall, f1, roc_auc FROM {metrics_sql(ypsb)} m")
    allc = " UNION ALL ".join(parts)
    return f"""
SELECT c.*, c.name = (SELECT name FROM ({allc}) b ORDER BY recall DESC, f1 DESC, roc_auc DESC, position LIMIT 1) AS is_best
FROM ({allc}) c"""


@register("rank_by_recall", lambda: O.with_ctes(["predictions"], _rank_by_recall_sql()))
def q_rank_by_recall(spark: SparkSession, sf: str) -> DataFrame:
    """M8: the small trainer's ranking (recall, f1, ROC AUC at class 0.5) of
    the same three scorers."""
    s = scored(spark, sf)
    cands = _candidates(s)
    long = s.select(F.col("delay_risk_label").alias("label"), F.explode(F.array(*[
        F.struct(F.lit(n).alias("name"), e.alias("score")) for n, e in cands])).alias("c")).select("c.*", "label")
    m = rounded(EV.class_metrics(long))
    position = F.array_position(F.array(*[F.lit(n) for n, _e in cands]), F.col("name")).cast("long") - 1
    return EV.rank_by_recall(m.withColumn("position", position))
