"""Scalar column expressions.

Every function takes and returns ``Column`` objects built from
``pyspark.sql.functions`` only, so they stay inside whole-stage codegen.
No Python UDFs.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from shipcast import constants as K

DEG_TO_RAD = math.pi / 180.0
TWO_PI = 2.0 * math.pi


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


# -- F1 / F2: division ------------------------------------------------------

def safe_divide(num: str | Column, den: str | Column) -> Column:
    """SAFE_DIVIDE(num, NULLIF(den, 0)): NULL when den is NULL or 0."""
    n, d = col(num), col(den)
    return F.when(d != 0, n / d)


def eps_divide(num: str | Column, den: str | Column, eps: float = 1e-6) -> Column:
    """num / (den + eps), the training-set form."""
    return col(num) / (col(den) + F.lit(eps))


# -- F3 / F4: logs and clamps -------------------------------------------------

def log1p_clamped(x: str | Column) -> Column:
    """LOG(1 + GREATEST(x, 0)) with the NULL-propagating GREATEST of the
    warehouse dialect (Spark's ``greatest`` skips NULLs, so guard)."""
    c = col(x)
    return F.when(c.isNotNull(), F.log(F.lit(1.0) + F.greatest(c, F.lit(0.0))))


def log1p_filled(x: str | Column) -> Column:
    """log1p(coerce(x) fill 0), the training-set form (no clamp)."""
    return F.log1p(F.coalesce(col(x).cast("double"), F.lit(0.0)))


# -- F5: cyclical encodings ---------------------------------------------------

def cyclic(x: str | Column, period: int) -> tuple[Column, Column]:
    angle = F.lit(TWO_PI) * col(x) / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


# -- F6 / F7: CASE maps and bins ---------------------------------------------

def case_map(x: str | Column, mapping: Sequence[tuple[str, float]], default: float,
             normalize: bool = True) -> Column:
    """CASE lower(coalesce(x, '')) WHEN k THEN v ... ELSE default END."""
    key = F.lower(F.coalesce(col(x), F.lit(""))) if normalize else col(x)
    out = None
    for k, v in mapping:
        out = (F.when(key == k, F.lit(float(v))) if out is None
               else out.when(key == k, F.lit(float(v))))
    return out.otherwise(F.lit(float(default)))


def rank_map(x: str | Column, mapping: Sequence[tuple[str, int]], fill: int) -> Column:
    """dict.map(x).fillna(fill) as double: exact-match lookup, unknown -> fill."""
    c = col(x)
    out = None
    for k, v in mapping:
        out = (F.when(c == k, F.lit(float(v))) if out is None
               else out.when(c == k, F.lit(float(v))))
    return out.otherwise(F.lit(float(fill)))


def lt_bands(x: str | Column, edges: Sequence[tuple[float, str]], default: str) -> Column:
    """CASE WHEN x < e1 THEN b1 ... ELSE default (NULL -> default)."""
    c = col(x)
    out = None
    for edge, label in edges:
        out = (F.when(c < edge, F.lit(label)) if out is None
               else out.when(c < edge, F.lit(label)))
    return out.otherwise(F.lit(default))


def right_closed_bins(x: str | Column, bins: Sequence[tuple[float, float | None, str]],
                      missing: str = "nan") -> Column:
    """pd.cut with right-closed (lo, hi] intervals; outside / NULL -> ``missing``.

    ``Bucketizer`` is left-closed, so the bins are an explicit ``when`` chain.
    """
    c = col(x)
    out = None
    for lo, hi, label in bins:
        cond = (c > lo) if hi is None else ((c > lo) & (c <= hi))
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return out.otherwise(F.lit(missing))


# -- F8 / F9: calendar parts and flags --------------------------------------

def weekday_mon0(ts: str | Column) -> Column:
    return F.weekday(col(ts)).cast("long")


def is_weekend(dow: str | Column) -> Column:
    return (col(dow) >= K.WEEKEND_FROM_WEEKDAY).cast("long")


def is_peak_hour(hour: str | Column) -> Column:
    return col(hour).isin(K.PEAK_HOURS).cast("long")


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 bigint with NULL -> 0 (CASE WHEN cond THEN 1 ELSE 0)."""
    return F.when(cond, F.lit(1)).otherwise(F.lit(0)).cast("long")


# -- F10: haversine -----------------------------------------------------------

def haversine_km(lat1: str | Column, lon1: str | Column, lat2: str | Column, lon2: str | Column,
                 digits: int | None = 2) -> Column:
    """Great-circle distance, arcsin form, R = 6371 km, rounded to ``digits``."""
    p1 = col(lat1) * F.lit(DEG_TO_RAD)
    p2 = col(lat2) * F.lit(DEG_TO_RAD)
    l1 = col(lon1) * F.lit(DEG_TO_RAD)
    l2 = col(lon2) * F.lit(DEG_TO_RAD)
    sdlat = F.sin((p2 - p1) / F.lit(2.0))
    sdlon = F.sin((l2 - l1) / F.lit(2.0))
    a = sdlat * sdlat + F.cos(p1) * F.cos(p2) * sdlon * sdlon
    km = F.lit(2.0 * K.EARTH_RADIUS_KM) * F.asin(F.sqrt(a))
    return km if digits is None else F.round(km, digits)


# -- F15: class and band ------------------------------------------------------

def risk_band(prob: str | Column, high: float = K.HIGH_RISK_THRESHOLD,
              medium: float = K.MEDIUM_RISK_THRESHOLD) -> Column:
    p = col(prob)
    return F.when(p >= high, "high").when(p >= medium, "medium").otherwise("low")


def predicted_class(prob: str | Column, threshold: float = K.CLASS_THRESHOLD) -> Column:
    return flag(col(prob) >= threshold)


# -- F16: NaN / Inf -> NULL ---------------------------------------------------

def finite_or_null(x: str | Column) -> Column:
    c = col(x)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


# -- F9 / F20: iso strings and deterministic ids ------------------------------

def iso_timestamp(ts: str | Column) -> Column:
    """ISO-8601 text with an explicit UTC offset (``+00:00``), as the
    warehouse sink receives it (S9), with six digits of a second's fraction
    where there is one. Timestamp-without-zone input is UTC."""
    whole = F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss")
    part = F.date_format(col(ts), ".SSSSSS")
    return F.concat(whole, F.when(part == ".000000", F.lit("")).otherwise(part), F.lit("+00:00"))


def deterministic_id(*parts: str | Column) -> Column:
    """Replay-stable run / batch id: sha2 of the parts."""
    return F.sha2(F.concat_ws("|", *[col(p).cast("string") for p in parts]), 256)


# -- exact sums of fixed-point values ------------------------------------------

def exact_sum(x: str | Column, scale: int) -> Column:
    """Sum of a fixed-point quantity (money: 2 decimals; stored scores) as an
    exact DECIMAL, returned as double. Float sums depend on the order in
    which partitions are combined; a decimal sum does not."""
    return F.sum(col(x).cast(f"decimal(38,{scale})")).cast("double")


def exact_avg(x: str | Column, scale: int) -> Column:
    """Mean from the exact decimal sum (NULL for no rows)."""
    n = F.count(col(x))
    return F.when(n > 0, exact_sum(x, scale) / n)
