"""The daily scoring job (M17): refresh → quota → fetch → score → write →
monitor, as one driver function composing the operators.

A run is its ``run_timestamp``. Predictions are appended once for a run; a
re-run of a stored timestamp scores nothing and only writes the monitoring
row if that is missing. Monitoring reads the stored predictions of the run,
never the plan that selected them, because that plan reads the table it adds
to. By default no order is left out: batch size, daily limit and lookback are
options, and the summary reports how many orders a run left unscored.
"""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.operators import monitor as MO
from shipcast.operators.clean import dedupe_orders
from shipcast.operators.evaluate import prediction_metrics
from shipcast.operators.features import align_features
from shipcast.sources.layers import has_files


@dataclass
class ScoringConfig:
    batch_size: int | None = None
    daily_limit: int = 0
    lookback_days: int = 0
    model_version: str = "rule-baseline-v1"
    scoring_mode: str = "local"
    endpoint_id: str = "local"
    monitoring: bool = True


PREDICTIONS = ("order_id string, prediction_timestamp timestamp_ntz, delay_probability double, "
               "delay_prediction bigint, risk_band string, endpoint_id string, model_version string")


def read_feature_list(spark: SparkSession, path: str) -> list[str]:
    """The model's feature names in order, from a JSON array file or a
    JSON document with the key ``features``."""
    body = "\n".join(r[0] for r in spark.read.text(path, wholetext=True).collect())
    doc = json.loads(body)
    return list(doc["features"] if isinstance(doc, dict) else doc)


def model_scorer(model, feature_list: list[str], modes: dict | None = None) -> Callable[[DataFrame], DataFrame]:
    """P12 + M16: a scorer that aligns the rows to the model's features,
    applies a fitted model and returns order_id and delay_probability."""
    from shipcast.plans.training import score_orders

    def score(rows: DataFrame) -> DataFrame:
        types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        types |= {k: "string" for k, v in (modes or {}).items() if isinstance(v, str)}
        return score_orders(model, align_features(rows, feature_list, types, keep=["order_id"]), modes)

    return score


def _predictions(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path) if has_files(spark, path) else spark.createDataFrame([], PREDICTIONS)


def run_daily_scoring(spark: SparkSession, features: DataFrame | Callable[[], DataFrame], predictions_path: str,
                      performance_path: str, run_timestamp: str, scorer: Callable[[DataFrame], DataFrame],
                      prob_col: str, cfg: ScoringConfig | None = None) -> dict:
    """Score the newest unscored feature rows of one run and record its
    monitoring row. ``features`` may be a function that refreshes the feature
    table first. Returns a small summary dict."""
    cfg = cfg or ScoringConfig()
    features = features() if callable(features) else features
    run = F.lit(run_timestamp).cast("timestamp_ntz")
    preds = _predictions(spark, predictions_path)
    summary = {"run_timestamp": run_timestamp, "quota": None, "scored": 0, "unscored": 0, "monitoring": False}
    if preds.where(F.col("prediction_timestamp") == run).isEmpty():
        limit = cfg.batch_size
        if cfg.daily_limit > 0:
            today = MO.scored_on(preds, run_timestamp)
            limit = max(0, min(cfg.batch_size if cfg.batch_size is not None else cfg.daily_limit, cfg.daily_limit - today))
        summary["quota"] = limit
        if limit is None or limit > 0:
            batch = MO.unscored_orders(features, preds, run_timestamp, cfg.lookback_days, limit=limit, one_per_order=True)
            new = MO.to_predictions(scorer(batch), prob_col, run_timestamp, cfg.endpoint_id, cfg.model_version)
            new.write.mode("append").parquet(predictions_path)
    stored = _predictions(spark, predictions_path)
    own = stored.where(F.col("prediction_timestamp") == run)
    summary["scored"] = own.count()
    summary["unscored"] = MO.unscored_orders(features, stored, run_timestamp, 0).select("order_id").distinct().count()
    if cfg.monitoring and summary["scored"] and "delay_risk_label" in features.columns:
        summary["monitoring"] = _monitor(spark, own, stored, features, performance_path, run_timestamp, cfg)
    return summary


def _monitor(spark: SparkSession, own: DataFrame, stored: DataFrame, features: DataFrame, performance_path: str,
             run_timestamp: str, cfg: ScoringConfig) -> bool:
    """Append the run's monitoring row unless it is there; true if written."""
    history = spark.read.parquet(performance_path) if has_files(spark, performance_path) else None
    run = F.lit(run_timestamp).cast("timestamp_ntz")
    if history is not None and not history.where(F.col("run_timestamp") == run).isEmpty():
        return False
    # The label of the feature row that was scored: the first of each order of the run.
    scored = dedupe_orders(features.join(own.select("order_id"), "order_id", "left_semi"))
    labelled = own.join(scored.select("order_id", "delay_risk_label"), "order_id", "left")
    current = prediction_metrics(labelled, "delay_risk_label", "delay_prediction", "delay_probability",
                                 "risk_band", missing_label_as_zero=True)
    recorded = None
    if history is not None:
        recorded = MO.last_performance(history.select("run_timestamp", *MO.BASELINE_METRICS).where(F.col("run_timestamp") < run))
    previous = MO.latest_batch_performance(stored, features, run_timestamp)
    row = MO.performance_row(current, recorded, previous, run_timestamp, cfg.model_version, cfg.scoring_mode, cfg.endpoint_id)
    row.write.mode("append").parquet(performance_path)
    return True
