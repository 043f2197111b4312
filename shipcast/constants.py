"""Fixed domain values.

FIXED VALUES — these must equal the reference application's values for the
results to match; they are stated plainly, in their natural order.
"""

from __future__ import annotations

# Distribution centres: (dc_id, dc_city, dc_state, dc_latitude, dc_longitude)
DISTRIBUTION_CENTERS = [
    ("DC_SP", "Sao Paulo", "SP", -23.5505, -46.6333),
    ("DC_PR", "Curitiba", "PR", -25.4284, -49.2733),
    ("DC_PE", "Recife", "PE", -8.0476, -34.8770),
    ("DC_GO", "Goiania", "GO", -16.6869, -49.2648),
]

# Carriers: (carrier, carrier_base_delay_rate, speed_factor)
CARRIERS = [
    ("BlueExpress", 0.055, 1.00),
    ("RoadRunner", 0.075, 0.95),
    ("EcoFrete", 0.105, 0.85),
    ("FlashLog", 0.090, 1.10),
    ("NationalPost", 0.130, 0.75),
]

PEAK_HOURS = [8, 9, 10, 11, 12, 18, 19, 20, 21]
WEEKEND_FROM_WEEKDAY = 5  # Monday = 0
EARTH_RADIUS_KM = 6371.0

# Promised delivery days by distance (strict "<" edges), else 8.
PROMISED_DAYS_EDGES = [(80.0, 1), (300.0, 2), (900.0, 4), (1800.0, 6)]
PROMISED_DAYS_ELSE = 8

# ETA: km per day at speed factor 1, and additive delays in days.
ETA_KM_PER_DAY = 420.0
ETA_ROUTE_REMOTE = 1.5
ETA_WEATHER_STORM = 1.2
ETA_WEATHER_RAIN = 0.35
ETA_TRAFFIC_SEVERE = 0.8
ETA_TRAFFIC_HIGH = 0.35
ETA_WEEKEND = 0.35

# Rule-based delay probability: logistic of these terms.
LOGIT_INTERCEPT = -3.0
LOGIT_DISTANCE = 0.00115
LOGIT_WEIGHT = 0.055
LOGIT_STORM = 1.05
LOGIT_RAIN = 0.42
LOGIT_TRAFFIC_SEVERE = 0.88
LOGIT_TRAFFIC_HIGH = 0.34
LOGIT_ROUTE_REMOTE = 0.48
LOGIT_ROUTE_LONG_HAUL = 0.23
LOGIT_CARRIER_RATE = 3.4
LOGIT_FRAGILITY = 4.0
LOGIT_WEEKEND = 0.25
LOGIT_PEAK = 0.18
LOGIT_LATE_ESTIMATE = 0.55

# Gold SQL risk maps (CASE on lower(coalesce(x, ''))), with ELSE values.
GOLD_TRAFFIC_RISK = [("light", 0.15), ("normal", 0.30), ("moderate", 0.45), ("heavy", 0.75), ("severe", 0.90)]
GOLD_TRAFFIC_ELSE = 0.35
GOLD_WEATHER_RISK = [("clear", 0.10), ("cloudy", 0.25), ("rain", 0.55), ("storm", 0.85), ("fog", 0.65)]
GOLD_WEATHER_ELSE = 0.35
GOLD_ROUTE_RISK = [("urban", 0.30), ("regional", 0.45), ("highway", 0.25), ("remote", 0.75)]
GOLD_ROUTE_ELSE = 0.40

# Gold SQL bands (strict "<" edges; NULL falls to the ELSE band).
GOLD_DISTANCE_BANDS = [(300.0, "short"), (900.0, "medium"), (1600.0, "long")]
GOLD_DISTANCE_ELSE = "very_long"
GOLD_WEIGHT_BANDS = [(1.0, "light"), (5.0, "medium"), (15.0, "heavy")]
GOLD_WEIGHT_ELSE = "bulky"

# Training feature ranks (map lookup, with the fill for missing / unknown).
TRAIN_TRAFFIC_RANK = [("low", 0), ("medium", 1), ("high", 2), ("severe", 3)]
TRAIN_TRAFFIC_FILL = 1
TRAIN_WEATHER_RANK = [("clear", 0), ("fog", 1), ("heatwave", 1), ("rain", 2), ("storm", 3)]
TRAIN_WEATHER_FILL = 0
TRAIN_ROUTE_RANK = [("urban", 0), ("regional", 1), ("long_haul", 2), ("remote", 3)]
TRAIN_ROUTE_FILL = 1

# Training bins: right-closed (lo, hi] intervals; the first lower edge is -1.
TRAIN_DISTANCE_BINS = [(-1.0, 80.0, "same_city"), (80.0, 300.0, "short"), (300.0, 900.0, "regional"),
                       (900.0, 1800.0, "long"), (1800.0, None, "very_long")]
TRAIN_WEIGHT_BINS = [(-1.0, 0.5, "very_light"), (0.5, 2.0, "light"), (2.0, 5.0, "medium"),
                     (5.0, 10.0, "heavy"), (10.0, None, "very_heavy")]

# Leakage (outcome) columns and the identifier drop list of the ML-ready table.
LEAKAGE_COLUMNS = ["delivery_status", "actual_delivery_days", "delay_probability_true"]
ML_DROP_COLUMNS = ["delivery_status", "actual_delivery_days", "delay_probability_true", "order_id", "batch_id",
                   "customer_id", "customer_name", "customer_email", "address", "order_date",
                   "ingestion_timestamp", "order_timestamp"]
MAX_CAT_CARDINALITY = 80

# Business costs / values of the threshold search and business evaluation.
VALUE_TRUE_POSITIVE = 80.0
COST_FALSE_POSITIVE = 15.0
COST_FALSE_NEGATIVE = 120.0
MIN_PRECISION = 0.20
LOW_PRECISION_PENALTY = 50.0

# Model selection score weights: recall, ROC AUC, average precision, precision.
SELECTION_WEIGHTS = (0.40, 0.25, 0.20, 0.15)

# Scoring thresholds and defaults.
CLASS_THRESHOLD = 0.5
HIGH_RISK_THRESHOLD = 0.7
MEDIUM_RISK_THRESHOLD = 0.4
BATCH_SIZE = 50
DAILY_SCORING_LIMIT = 300
SCORING_LOOKBACK_DAYS = 7
ACCURACY_DROP_ALERT_THRESHOLD = 0.05
F1_DROP_ALERT_THRESHOLD = 0.05

# Hypotheses: (id, statement, feature, condition). "positive" = value > 0,
# "top_vs_overall" = the group with the highest rate among groups of size
# >= max(100, 0.001 * n).
HYPOTHESES = [
    ("H1", "Severe traffic increases delay risk.", "traffic_condition", "severe"),
    ("H2", "Storm weather increases delay risk.", "weather_condition", "storm"),
    ("H3", "Remote routes increase delay risk.", "route_type", "remote"),
    ("H4", "NationalPost has higher delay risk than average.", "carrier", "NationalPost"),
    ("H5", "Very long distance orders have higher delay risk.", "distance_band", "very_long"),
    ("H6", "Weekend orders have higher delay risk.", "is_weekend", "1"),
    ("H7", "Peak-hour orders have higher delay risk.", "is_peak_hour", "1"),
    ("H8", "Orders estimated above promised SLA have higher delay risk.", "estimated_minus_promised_days", "positive"),
    ("H9", "Very heavy orders have higher delay risk.", "weight_band", "very_heavy"),
    ("H10", "Different states have materially different delay rates.", "state", "top_vs_overall"),
]
HYPOTHESIS_MIN_COUNT = 50
HYPOTHESIS_MIN_LIFT = 1.15
H10_MIN_GROUP = 100
H10_MIN_SHARE = 0.001
