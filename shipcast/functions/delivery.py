"""Delivery-promise, ETA, rule-score and outcome expressions.

These are the deterministic formulas of the order simulator, expressed as
column expressions so they run JVM-side over any number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.functions.expr import col, flag


def promised_days(distance_km: str | Column) -> Column:
    """1 / 2 / 4 / 6 / 8 days by strict distance edges (NULL -> 8)."""
    d = col(distance_km)
    out = None
    for edge, days in K.PROMISED_DAYS_EDGES:
        out = F.when(d < edge, F.lit(days)) if out is None else out.when(d < edge, F.lit(days))
    return out.otherwise(F.lit(K.PROMISED_DAYS_ELSE)).cast("long")


def estimated_days(distance_km: str | Column, speed_factor: str | Column, route_type: str | Column,
                   weather: str | Column, traffic: str | Column, weekend: str | Column) -> Column:
    """max(1, ceil(km / 420 / speed + route + weather + traffic + weekend))."""
    w, t, r = col(weather), col(traffic), col(route_type)
    raw = ((col(distance_km) / F.lit(K.ETA_KM_PER_DAY)) / col(speed_factor)
           + F.when(r == "remote", F.lit(K.ETA_ROUTE_REMOTE)).otherwise(F.lit(0.0))
           + F.when(w == "storm", F.lit(K.ETA_WEATHER_STORM)).otherwise(F.lit(0.0))
           + F.when(w == "rain", F.lit(K.ETA_WEATHER_RAIN)).otherwise(F.lit(0.0))
           + F.when(t == "severe", F.lit(K.ETA_TRAFFIC_SEVERE)).otherwise(F.lit(0.0))
           + F.when(t == "high", F.lit(K.ETA_TRAFFIC_HIGH)).otherwise(F.lit(0.0))
           + F.when(col(weekend) == 1, F.lit(K.ETA_WEEKEND)).otherwise(F.lit(0.0)))
    return F.greatest(F.lit(1), F.ceil(raw).cast("long")).cast("long")


def rule_logit(distance_km, weight_kg, weather, traffic, route_type, carrier_rate, fragility,
               weekend, peak, est_days, promised) -> Column:
    """F13 logit: intercept plus 13 additive terms, in the simulator's order."""
    w, t, r = col(weather), col(traffic), col(route_type)

    def ind(c: Column) -> Column:
        return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))

    return (F.lit(K.LOGIT_INTERCEPT)
            + F.lit(K.LOGIT_DISTANCE) * col(distance_km)
            + F.lit(K.LOGIT_WEIGHT) * col(weight_kg)
            + F.lit(K.LOGIT_STORM) * ind(w == "storm")
            + F.lit(K.LOGIT_RAIN) * ind(w == "rain")
            + F.lit(K.LOGIT_TRAFFIC_SEVERE) * ind(t == "severe")
            + F.lit(K.LOGIT_TRAFFIC_HIGH) * ind(t == "high")
            + F.lit(K.LOGIT_ROUTE_REMOTE) * ind(r == "remote")
            + F.lit(K.LOGIT_ROUTE_LONG_HAUL) * ind(r == "long_haul")
            + F.lit(K.LOGIT_CARRIER_RATE) * col(carrier_rate)
            + F.lit(K.LOGIT_FRAGILITY) * col(fragility)
            + F.lit(K.LOGIT_WEEKEND) * col(weekend)
            + F.lit(K.LOGIT_PEAK) * col(peak)
            + F.when(col(est_days) > col(promised), F.lit(K.LOGIT_LATE_ESTIMATE)).otherwise(F.lit(0.0)))


def rule_probability(logit: Column, digits: int | None = 5) -> Column:
    p = F.lit(1.0) / (F.lit(1.0) + F.exp(-logit))
    return p if digits is None else F.round(p, digits)


def delivery_status(label: str | Column) -> Column:
    """delayed / on_time from the label."""
    return F.when(col(label) == 1, F.lit("delayed")).otherwise(F.lit("on_time"))


def lateness_days(actual: str | Column, estimated: str | Column) -> Column:
    return (col(actual) - col(estimated)).cast("long")


__all__ = ["promised_days", "estimated_days", "rule_logit", "rule_probability", "delivery_status",
           "lateness_days", "flag"]
