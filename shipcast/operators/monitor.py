"""Scoring bookkeeping and prediction monitoring (J1–J3, P13–P15, A6, A7,
A16, A17, A19, W2, T4–T6, T9, M14, M15).

``as_of`` is always a parameter (never the clock) so every query is
repeatable.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.functions import delivery as D
from shipcast.functions import expr as X
from shipcast.operators.evaluate import METRIC_COLUMNS, SCORE_SCALE, prediction_metrics
from shipcast.sources.tables import bounded_broadcast

PREDICTION_COLUMNS = ["order_id", "prediction_timestamp", "delay_probability", "delay_prediction", "risk_band",
                      "endpoint_id", "model_version"]
BASELINE_METRICS = ["accuracy", "precision", "recall", "f1", "roc_auc", "average_precision"]


#: What the rule score is made from.
RULE_INPUTS = ["distance_km", "order_weight_kg", "weather_condition", "traffic_condition", "route_type",
               "carrier_base_delay_rate", "product_fragility_score", "is_weekend", "is_peak_hour",
               "estimated_delivery_days", "promised_delivery_days"]


def rule_score(df: DataFrame) -> DataFrame:
    """F13 as a deterministic scorer: the logistic rule probability."""
    return df.withColumn("rule_probability", D.rule_probability(D.rule_logit(*RULE_INPUTS)))


def to_predictions(scored: DataFrame, prob: str, run_ts, endpoint_id: str = "local",
                   model_version: str = "rule-baseline-v1",
                   threshold: float = K.CLASS_THRESHOLD) -> DataFrame:
    """Prediction rows with class, band and a shared run timestamp
    (a column or a literal)."""
    ts = run_ts if not isinstance(run_ts, str) else F.lit(run_ts).cast("timestamp_ntz")
    p = F.col(prob)
    return scored.select(
        "order_id", ts.alias("prediction_timestamp"), p.alias("delay_probability"),
        X.predicted_class(p, threshold).alias("delay_prediction"),
        X.risk_band(p).alias("risk_band"),
        F.lit(endpoint_id).alias("endpoint_id"), F.lit(model_version).alias("model_version"))


def replayed_predictions(orders: DataFrame, as_of: str) -> DataFrame:
    """The predictions history of a daily scoring job replayed over the
    order table: every order is scored by the run at 01:00 of the day after
    it was placed; runs at or after ``as_of`` have not happened yet."""
    run_ts = (F.date_trunc("day", F.col("order_timestamp"))
              + F.make_dt_interval(F.lit(1), F.lit(1))).cast("timestamp_ntz")
    scored = rule_score(orders).withColumn("_run", run_ts)
    return (to_predictions(scored, "rule_probability", F.col("_run"))
            .where(F.col("prediction_timestamp") < F.lit(as_of).cast("timestamp_ntz")))


def lookback_start(as_of: str, days: int = K.SCORING_LOOKBACK_DAYS) -> str:
    """The time ``days`` days before ``as_of``."""
    return str(datetime.fromisoformat(as_of) - timedelta(days=days))


def unscored_orders(features: DataFrame, predictions: DataFrame, as_of: str,
                    lookback_days: int = K.SCORING_LOOKBACK_DAYS, limit: int | None = None,
                    one_per_order: bool = False) -> DataFrame:
    """Feature rows without a prediction, inside the lookback;
    with a ``limit`` the newest (order_id breaks ties), without one all, in
    no order.
    ``one_per_order`` keeps the first row per order id (after the lookback
    filter and anti join, so only candidates are shuffled); the warehouse
    feature table itself may repeat ids."""
    f = features
    if lookback_days > 0:
        lo = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(lookback_days))
        f = f.where(F.col("order_timestamp") >= lo)
    out = f.join(predictions.select("order_id"), "order_id", "left_anti")
    if one_per_order:
        from shipcast.operators.clean import dedupe_orders
        out = dedupe_orders(out)
    return out if limit is None else out.orderBy(F.col("order_timestamp").desc(), F.col("order_id")).limit(limit)


def on_day(ts: Column, as_of: str) -> Column:
    """Timestamps of the as-of day, as a range that reaches the scan."""
    day = F.date_trunc("day", F.lit(as_of).cast("timestamp_ntz")).cast("timestamp_ntz")
    return (ts >= day) & (ts < day + F.make_dt_interval(F.lit(1)))


def scored_on(predictions: DataFrame, as_of: str) -> int:
    """Predictions stored on the as-of day."""
    return predictions.where(on_day(F.col("prediction_timestamp"), as_of)).count()


def scored_today(predictions: DataFrame, source: DataFrame, as_of: str) -> DataFrame:
    """Predictions whose date is the as-of date, and source rows."""
    day = F.to_date(F.lit(as_of).cast("timestamp_ntz"))
    a = predictions.where(on_day(F.col("prediction_timestamp"), as_of)).agg(F.count(F.lit(1)).alias("scored_today"))
    b = source.agg(F.count(F.lit(1)).alias("source_rows"))
    return (a.withColumn("_k", F.lit(1)).join(F.broadcast(b.withColumn("_k", F.lit(1))), "_k")
             .select(day.alias("as_of_date"), "scored_today", "source_rows"))


def remaining_quota(scored: DataFrame, batch_size: int = K.BATCH_SIZE,
                    daily_limit: int = K.DAILY_SCORING_LIMIT) -> DataFrame:
    """max(0, min(batch, limit − scored_today)); limit ≤ 0 → batch."""
    if daily_limit <= 0:
        q = F.lit(batch_size).cast("long")
    else:
        q = F.greatest(F.lit(0), F.least(F.lit(batch_size), F.lit(daily_limit) - F.col("scored_today")))
    return scored.select("scored_today", q.cast("long").alias("remaining_quota"))


#: A larger batch is joined by shuffle.
BATCH_ROWS = 500_000


def latest_batch_performance(predictions: DataFrame, features: DataFrame, before: str) -> DataFrame:
    """Metrics of the newest prediction batch strictly
    before ``before``, labels from the feature table (rows with a NULL label
    dropped). The batch's time is looked up first (one value, from the time
    column alone) and then filters the scan of the predictions; duplicate
    feature rows multiply as in an inner join. A batch of at most
    ``BATCH_ROWS`` rows is broadcast, so the features are not shuffled."""
    latest = (predictions.where(F.col("prediction_timestamp") < F.lit(before).cast("timestamp_ntz"))
              .agg(F.max("prediction_timestamp")).first()[0])
    batch = predictions.where(F.col("prediction_timestamp") == F.lit(None if latest is None else str(latest)).cast("timestamp_ntz"))
    batch = bounded_broadcast(batch, BATCH_ROWS)
    j = batch.join(features.select("order_id", "delay_risk_label"), "order_id")
    j = j.where(F.col("delay_risk_label").isNotNull())
    m = prediction_metrics(j, "delay_risk_label", "delay_prediction", "delay_probability", "risk_band",
                           missing_label_as_zero=False, group=["prediction_timestamp"])
    return m.select(F.col("prediction_timestamp").alias("run_timestamp"), *METRIC_COLUMNS,
                    F.lit("latest_prediction_batch").alias("comparison_source"))


#: Buckets of a run's scores: runs are many, so each has few (see ``running_sum``).
RUN_SLICES, RUN_PER_E = 64, 4


def run_metrics(predictions: DataFrame, labels: DataFrame) -> DataFrame:
    """Per-run metrics of every prediction batch (labels joined on order id;
    missing label counts as 0, the current-batch rule): one row per scoring
    run, the content of the performance table."""
    j = predictions.join(labels.select("order_id", "delay_risk_label"), "order_id", "left")
    return prediction_metrics(j, "delay_risk_label", "delay_prediction", "delay_probability", "risk_band",
                              missing_label_as_zero=True, group=["prediction_timestamp"], slices=RUN_SLICES, per_e=RUN_PER_E)


def performance_history(runs: DataFrame, limit: int | None = None) -> DataFrame:
    """Each run with the previous run's metrics and the deltas,
    newest first. The lag runs over one row per run (the run count grows by
    one per day), ordered by run timestamp."""
    w = Window.orderBy("prediction_timestamp")
    cols = [F.col("prediction_timestamp").alias("run_timestamp"), *[F.col(c) for c in METRIC_COLUMNS],
            F.lag("prediction_timestamp").over(w).alias("baseline_run_timestamp")]
    for m in BASELINE_METRICS:
        prev = F.lag(m).over(w)
        cols += [prev.alias(f"baseline_{m}"), (F.col(m) - prev).alias(f"{m}_delta")]
    out = runs.select(*cols).orderBy(F.col("run_timestamp").desc())
    return out.limit(limit) if limit else out


def last_performance(history: DataFrame) -> DataFrame:
    """The last recorded run (max by run timestamp)."""
    fields = [c for c in history.columns]
    return history.agg(F.max_by(F.struct(*fields), F.col("run_timestamp")).alias("r")).select("r.*")


def newest_runs(runs: DataFrame, n: int) -> DataFrame:
    """The last ``n`` runs of the performance table (a small page)."""
    return runs.orderBy(F.col("prediction_timestamp").desc()).limit(n)


def performance_row(current: DataFrame, last_recorded: DataFrame | None, previous_batch: DataFrame | None,
                    run_timestamp: str, model_version: str = "rule-baseline-v1", scoring_mode: str = "local",
                    endpoint_id: str = "local",
                    accuracy_alert: float = K.ACCURACY_DROP_ALERT_THRESHOLD,
                    f1_alert: float = K.F1_DROP_ALERT_THRESHOLD) -> DataFrame:
    """M14 + M15: one 40-field monitoring row. Baseline = the last recorded
    run if any, else the previous batch's metrics (either may be None);
    metrics that are NaN or infinite become NULL (F16); deltas are NULL-safe
    and alerts fire at ``delta <= -|threshold|``. ``created_at`` is the run
    timestamp and ``run_id`` a hash of it, so a retried run writes the same
    row."""
    def base_of(df: DataFrame, source: str) -> DataFrame:
        return df.select(F.lit(1).alias("_k"), F.col("run_timestamp").alias("b_run_timestamp"),
                         *[X.finite_or_null(m).alias(f"b_{m}") for m in BASELINE_METRICS],
                         F.lit(source).alias("b_source")).where(F.col("b_run_timestamp").isNotNull())

    found = [base_of(df, source).withColumn("_pri", F.lit(k)) for k, (df, source) in enumerate(
        ((last_recorded, "performance_table"), (previous_batch, "latest_prediction_batch"))) if df is not None]
    if not found:
        found = [base_of(current.withColumn("run_timestamp", F.lit(None).cast("timestamp_ntz")), "").withColumn("_pri", F.lit(0))]
    cands = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    bcols = ["b_run_timestamp", *[f"b_{m}" for m in BASELINE_METRICS], "b_source"]
    baseline = cands.groupBy("_k").agg(F.min_by(F.struct(*bcols), F.col("_pri")).alias("b")).select("_k", "b.*")
    ts = F.lit(run_timestamp).cast("timestamp_ntz")
    guarded = current.withColumns({f.name: X.finite_or_null(f.name) for f in current.schema.fields
                                   if f.name in METRIC_COLUMNS and f.dataType.typeName() == "double"})
    cur = guarded.withColumn("_k", F.lit(1)).join(F.broadcast(baseline), "_k", "left")

    def delta(m: str):
        # compared at 6 decimals, so a drop of exactly the threshold alerts
        return F.round((F.col(m) - F.col(f"b_{m}")) * F.lit(1e6)) / F.lit(1e6)

    out = cur.select(
        X.deterministic_id(F.lit(run_timestamp), F.lit(model_version)).alias("run_id"),
        ts.alias("run_timestamp"), F.to_date(ts).alias("run_date"), F.lit(model_version).alias("model_version"),
        F.lit(scoring_mode).alias("scoring_mode"), F.lit(endpoint_id).alias("endpoint_id"),
        *[F.col(c) for c in METRIC_COLUMNS],
        F.col("b_run_timestamp").alias("baseline_run_timestamp"),
        *[F.col(f"b_{m}").alias(f"baseline_{m}") for m in BASELINE_METRICS],
        *[delta(m).alias(f"{m}_delta") for m in BASELINE_METRICS],
        F.coalesce(delta("accuracy") <= F.lit(-abs(accuracy_alert)), F.lit(False)).alias("accuracy_drop_alert"),
        F.coalesce(delta("f1") <= F.lit(-abs(f1_alert)), F.lit(False)).alias("f1_drop_alert"),
        F.col("b_source").alias("comparison_source"),
        ts.alias("created_at"))
    return out


def prediction_summary(predictions: DataFrame) -> DataFrame:
    """Totals, mean probability, band counts, last timestamp (0 defaults)."""
    p = predictions
    return p.agg(
        F.count(F.lit(1)).alias("total_predictions"),
        F.coalesce(X.exact_avg("delay_probability", SCORE_SCALE), F.lit(0.0)).alias("avg_delay_probability"),
        F.count_if(F.col("risk_band") == "high").alias("high_risk_orders"),
        F.count_if(F.col("risk_band") == "medium").alias("medium_risk_orders"),
        F.count_if(F.col("risk_band") == "low").alias("low_risk_orders"),
        F.max("prediction_timestamp").alias("last_prediction_timestamp"))


def risk_distribution(predictions: DataFrame) -> DataFrame:
    """Orders and mean probability per risk band, most orders first."""
    return (predictions.groupBy("risk_band")
            .agg(F.count(F.lit(1)).alias("orders"),
                 X.exact_avg("delay_probability", SCORE_SCALE).alias("avg_delay_probability"))
            .orderBy(F.col("orders").desc(), F.col("risk_band")))


def latest_predictions(predictions: DataFrame, limit: int = 100) -> DataFrame:
    """T4: newest predictions (order_id breaks ties), LIMIT 1–500; other
    page sizes are an error."""
    if not 1 <= limit <= 500:
        raise ValueError("limit must be between 1 and 500")
    return (predictions.select(*PREDICTION_COLUMNS)
            .orderBy(F.col("prediction_timestamp").desc(), F.col("order_id")).limit(limit))
