"""Feature tables: gold SQL definition, training definition, baseline
projection, nearest centre, risk lookups, ML-ready pruning, feature
alignment (P2–P5, P9–P12, J4, J5; F1–F9).

The gold and training definitions give the *same column names different
meanings* (SURVEY §1.4); both are kept, named by their origin.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipcast import constants as K
from shipcast.functions import expr as X

GOLD_BASE = ["order_id", "order_timestamp", "delay_risk_label", "order_value", "order_weight_kg",
             "product_fragility_score", "distance_km", "carrier_base_delay_rate", "promised_delivery_days",
             "estimated_delivery_days", "city", "state", "region", "product_category", "carrier", "dc_id",
             "dc_state", "traffic_condition", "weather_condition", "route_type", "order_month", "order_day",
             "order_day_of_week", "order_hour", "is_weekend", "is_peak_hour"]

GOLD_DERIVED = ["estimated_minus_promised_days", "estimated_over_promised", "log_order_value",
                "log_distance_km", "log_weight_kg", "value_per_kg", "value_per_km",
                "weight_distance_interaction", "hour_sin", "hour_cos", "dow_sin", "dow_cos", "month_sin",
                "month_cos", "same_state_dc", "distance_band", "weight_band", "traffic_risk_score",
                "weather_risk_score", "route_risk_score", "combined_operational_risk"]

GOLD_COLUMNS = GOLD_BASE + GOLD_DERIVED


def gold_features(silver: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """P2 + P3: the 47-column gold feature table of the warehouse SQL
    (``keep`` columns are carried along)."""
    b = silver.select(*GOLD_BASE, *(keep or []))
    hs, hc = X.cyclic("order_hour", 24)
    ds, dc = X.cyclic("order_day_of_week", 7)
    ms, mc = X.cyclic("order_month", 12)
    g = b.select(
        "*",
        (F.col("estimated_delivery_days") - F.col("promised_delivery_days")).cast("long")
        .alias("estimated_minus_promised_days"),
        X.safe_divide("estimated_delivery_days", "promised_delivery_days").alias("estimated_over_promised"),
        X.log1p_clamped("order_value").alias("log_order_value"),
        X.log1p_clamped("distance_km").alias("log_distance_km"),
        X.log1p_clamped("order_weight_kg").alias("log_weight_kg"),
        X.safe_divide("order_value", "order_weight_kg").alias("value_per_kg"),
        X.safe_divide("order_value", "distance_km").alias("value_per_km"),
        (F.col("order_weight_kg") * F.col("distance_km")).alias("weight_distance_interaction"),
        hs.alias("hour_sin"), hc.alias("hour_cos"),
        ds.alias("dow_sin"), dc.alias("dow_cos"),
        ms.alias("month_sin"), mc.alias("month_cos"),
        X.flag(F.col("state") == F.col("dc_state")).alias("same_state_dc"),
        X.lt_bands("distance_km", K.GOLD_DISTANCE_BANDS, K.GOLD_DISTANCE_ELSE).alias("distance_band"),
        X.lt_bands("order_weight_kg", K.GOLD_WEIGHT_BANDS, K.GOLD_WEIGHT_ELSE).alias("weight_band"),
        X.case_map("traffic_condition", K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE).alias("traffic_risk_score"),
        X.case_map("weather_condition", K.GOLD_WEATHER_RISK, K.GOLD_WEATHER_ELSE).alias("weather_risk_score"),
        X.case_map("route_type", K.GOLD_ROUTE_RISK, K.GOLD_ROUTE_ELSE).alias("route_risk_score"),
    )
    return g.withColumn("combined_operational_risk",
                        (F.col("traffic_risk_score") + F.col("weather_risk_score")
                         + F.col("route_risk_score")) / F.lit(3.0))


def training_features(df: DataFrame, target: str = "delay_risk_label") -> DataFrame:
    """The training-set feature definition (calendar recomputed from the
    timestamp, epsilon ratios, right-closed bins, rank maps, summed risk)."""
    ts = F.col("order_timestamp")
    cal = {
        "order_date": F.date_format(F.to_date(ts), "yyyy-MM-dd"),
        "order_year": F.year(ts).cast("long"),
        "order_month": F.month(ts).cast("long"),
        "order_day": F.dayofmonth(ts).cast("long"),
        "order_day_of_week": X.weekday_mon0(ts),
        "order_hour": F.hour(ts).cast("long"),
    }
    df = df.withColumns(cal)
    hs, hc = X.cyclic("order_hour", 24)
    ds, dc = X.cyclic("order_day_of_week", 7)
    ms, mc = X.cyclic("order_month", 12)
    df = df.withColumns({
        "is_weekend": X.is_weekend("order_day_of_week"),
        "is_peak_hour": X.is_peak_hour("order_hour"),
        "hour_sin": hs, "hour_cos": hc, "dow_sin": ds, "dow_cos": dc, "month_sin": ms, "month_cos": mc,
        "same_state_dc": X.flag(F.col("state").eqNullSafe(F.col("dc_state"))),
        "estimated_minus_promised_days":
            (F.col("estimated_delivery_days") - F.col("promised_delivery_days")).cast("long"),
        "estimated_over_promised": X.eps_divide("estimated_delivery_days", "promised_delivery_days"),
        "log_order_value": X.log1p_filled("order_value"),
        "log_distance_km": X.log1p_filled("distance_km"),
        "log_weight_kg": X.log1p_filled("order_weight_kg"),
        "value_per_kg": X.eps_divide("order_value", "order_weight_kg"),
        "value_per_km": X.eps_divide("order_value", "distance_km"),
        "weight_distance_interaction": F.col("order_weight_kg") * F.col("distance_km"),
        "distance_band": X.right_closed_bins("distance_km", K.TRAIN_DISTANCE_BINS),
        "weight_band": X.right_closed_bins("order_weight_kg", K.TRAIN_WEIGHT_BINS),
        "traffic_risk_score": X.rank_map("traffic_condition", K.TRAIN_TRAFFIC_RANK, K.TRAIN_TRAFFIC_FILL),
        "weather_risk_score": X.rank_map("weather_condition", K.TRAIN_WEATHER_RANK, K.TRAIN_WEATHER_FILL),
        "route_risk_score": X.rank_map("route_type", K.TRAIN_ROUTE_RANK, K.TRAIN_ROUTE_FILL),
    })
    df = df.withColumn(
        "combined_operational_risk",
        F.col("traffic_risk_score") + F.col("weather_risk_score") + F.col("route_risk_score")
        + F.coalesce(F.col("carrier_base_delay_rate"), F.lit(0.0)) * F.lit(10.0)
        + X.flag(F.col("estimated_minus_promised_days") > 0))
    if target in df.columns:
        df = df.withColumn(target, F.coalesce(F.col(target).cast("double"), F.lit(0.0)).cast("long"))
    return df


def baseline_features(df: DataFrame, target: str = "delay_risk_label", keep: list[str] | None = None) -> DataFrame:
    """P5: the 13-feature projection of the small trainer, plus the label
    (``keep`` columns such as ids are carried in front)."""
    ts = F.col("order_timestamp")
    dow = F.coalesce(X.weekday_mon0(ts), F.lit(0)).cast("long")
    return df.select(
        *(keep or []), "state", "city", "product_category", "order_value", "order_weight_kg", "distance_km", "carrier",
        "dc_id", "promised_delivery_days", "estimated_delivery_days",
        dow.alias("day_of_week"),
        F.coalesce(F.hour(ts), F.lit(0)).cast("long").alias("order_hour"),
        X.flag(dow.isin(5, 6)).alias("is_weekend"),
        F.col(target).cast("long").alias(target),
    )


def nearest_dc(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Nearest distribution centre per row (deterministic branch).

    The 4 centres are literals, so instead of a cross join each row builds a
    4-element array of (km, position, id) structs and takes ``array_min``:
    smallest distance wins, ties go to the first centre in list order.
    """
    cands = F.array(*[
        F.struct(X.haversine_km(lat, lon, F.lit(la), F.lit(lo), digits=None).alias("km"),
                 F.lit(i).alias("pos"), F.lit(dc_id).alias("dc_id"), F.lit(city).alias("dc_city"),
                 F.lit(state).alias("dc_state"))
        for i, (dc_id, city, state, la, lo) in enumerate(K.DISTRIBUTION_CENTERS)])
    best = F.array_min(cands)
    return df.withColumns({
        "nearest_dc_id": best["dc_id"],
        "nearest_dc_city": best["dc_city"],
        "nearest_dc_state": best["dc_state"],
        "nearest_distance_km": F.round(best["km"], 2),
    })


def risk_scores(df: DataFrame) -> DataFrame:
    """Both lookup-map encodings side by side (gold CASE maps and the
    training rank maps). The maps are 4–5 literal entries, so they compile
    to CASE expressions instead of a join."""
    return df.withColumns({
        "gold_traffic_risk": X.case_map("traffic_condition", K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE),
        "gold_weather_risk": X.case_map("weather_condition", K.GOLD_WEATHER_RISK, K.GOLD_WEATHER_ELSE),
        "gold_route_risk": X.case_map("route_type", K.GOLD_ROUTE_RISK, K.GOLD_ROUTE_ELSE),
        "train_traffic_rank": X.rank_map("traffic_condition", K.TRAIN_TRAFFIC_RANK, K.TRAIN_TRAFFIC_FILL),
        "train_weather_rank": X.rank_map("weather_condition", K.TRAIN_WEATHER_RANK, K.TRAIN_WEATHER_FILL),
        "train_route_rank": X.rank_map("route_type", K.TRAIN_ROUTE_RANK, K.TRAIN_ROUTE_FILL),
    })


# -- P9 / P11: ML-ready pruning ---------------------------------------------

DECISION_SCHEMA = "column_name string, position bigint, non_null bigint, reason string"


def _is_categorical(dtype: T.DataType) -> bool:
    return isinstance(dtype, (T.StringType, T.BooleanType))


def ml_ready_decisions(df: DataFrame, target: str = "delay_risk_label",
                       max_cat_cardinality: int = K.MAX_CAT_CARDINALITY) -> DataFrame:
    """P9 + P11 as a per-column decision table:
    column_name, position, non_null, reason (leakage_or_id /
    high_cardinality / all_null / constant; NULL = kept).

    One aggregate over the table gives per column the non-NULL count, for
    categoricals an HLL distinct estimate and for the others min == max (at
    most one distinct value); it has no key, so nothing is sorted or shuffled
    but one row of each task. Only categoricals whose estimate lies within a
    factor of two of the cardinality cap (10 standard errors of the estimate)
    get an exact distinct count, and only those that may hold one value alone
    an exact min == max, both in narrow scans. The stats are one row, so
    building the table on the driver is bounded by the schema, not the data.
    """
    fields = list(df.schema.fields)
    aggs = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"nn__{f.name}"))
        if f.name in K.ML_DROP_COLUMNS:
            continue  # decided by its name
        if _is_categorical(f.dataType):
            # The buffer of an estimate grows with 1 / error²: 52 words at 0.05, 410 at 0.02.
            aggs.append(F.approx_count_distinct(c, 0.05).alias(f"hll__{f.name}"))
        else:
            aggs.append((F.min(c) == F.max(c)).alias(f"one__{f.name}"))
    stats = df.agg(*aggs).first().asDict()
    cats = [f.name for f in fields if f"hll__{f.name}" in stats]
    alone = [c for c in cats if stats[f"hll__{c}"] <= 2]
    if alone:
        stats |= df.agg(*[(F.min(F.col(f"`{c}`")) == F.max(F.col(f"`{c}`"))).alias(f"one__{c}") for c in alone]).first().asDict()
    near = [c for c in cats if max_cat_cardinality // 2 <= stats[f"hll__{c}"] <= max_cat_cardinality * 2]
    exact = {}
    if near:
        pairs = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(f"`{c}`").cast("string").alias("v")) for c in near])).alias("p")).select("p.*")
        exact = {r["c"]: r["n"] for r in pairs.distinct().groupBy("c").agg(F.count("v").alias("n")).collect()}
    rows = []
    for i, f in enumerate(fields):
        nn = int(stats[f"nn__{f.name}"])
        reason = None
        if f.name in K.ML_DROP_COLUMNS:
            reason = "leakage_or_id"
        elif f.name != target:
            if _is_categorical(f.dataType):
                nd = exact.get(f.name, stats[f"hll__{f.name}"])
                if nd > max_cat_cardinality:
                    reason = "high_cardinality"
            if reason is None and nn == 0:
                reason = "all_null"
            if reason is None and stats.get(f"one__{f.name}"):
                reason = "constant"
        rows.append((f.name, i, nn, reason))
    return df.sparkSession.createDataFrame(rows, DECISION_SCHEMA)


def ml_ready(df: DataFrame, target: str = "delay_risk_label") -> DataFrame:
    """P9 + P11: drop leakage / identifier columns, high-cardinality
    categoricals, all-NULL and constant columns."""
    decisions = ml_ready_decisions(df, target).where(F.col("reason").isNotNull()).collect()
    return df.drop(*[r["column_name"] for r in decisions])


# -- P12: feature alignment ---------------------------------------------------

def align_features(df: DataFrame, features: list[str], types: dict[str, str] | None = None,
                   keep: list[str] | None = None) -> DataFrame:
    """Add missing features as typed NULLs, fix their order, drop the
    rest (``keep`` columns such as ids are carried in front)."""
    types = types or {}
    have = set(df.columns)
    cols: list[Column] = [F.col(k) for k in (keep or [])]
    for f in features:
        if f in have:
            cols.append(F.col(f))
        else:
            cols.append(F.lit(None).cast(types.get(f, "double")).alias(f))
    return df.select(*cols)
