"""DuckDB oracle SQL for the registered queries.

The oracle rebuilds the same derived tables with plain SQL over the input
views (``lineitem``, ``orders``, ``customer``, ...), as CTEs, so a query's
result can be compared with the Spark result. Literals are written as
explicit DOUBLEs because DuckDB reads ``0.15`` as DECIMAL.
"""

from __future__ import annotations

import math

from shipcast import constants as K

DEG = repr(math.pi / 180.0)


def d(x: float) -> str:
    return f"CAST({float(x)!r} AS DOUBLE)"


def s(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


def lt_case(expr: str, edges, default) -> str:
    parts = " ".join(f"WHEN {expr} < {e} THEN {v}" for e, v in edges)
    return f"CASE {parts} ELSE {default} END"


def haversine_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    p1, p2 = f"({lat1} * {DEG})", f"({lat2} * {DEG})"
    l1, l2 = f"({lon1} * {DEG})", f"({lon2} * {DEG})"
    sl = f"sin(({p2} - {p1}) / 2.0)"
    so = f"sin(({l2} - {l1}) / 2.0)"
    a = f"({sl} * {sl} + cos({p1}) * cos({p2}) * {so} * {so})"
    return f"({d(2.0 * K.EARTH_RADIUS_KM)} * asin(sqrt({a})))"



def _ind(cond: str) -> str:
    return f"(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)"


def logit_sql() -> str:
    """F13 logit over the order columns, in the simulator's term order."""
    ind = _ind
    return (f"{d(K.LOGIT_INTERCEPT)} + {d(K.LOGIT_DISTANCE)} * distance_km"
             f" + {d(K.LOGIT_WEIGHT)} * order_weight_kg"
             f" + {d(K.LOGIT_STORM)} * {ind("weather_condition = 'storm'")}"
             f" + {d(K.LOGIT_RAIN)} * {ind("weather_condition = 'rain'")}"
             f" + {d(K.LOGIT_TRAFFIC_SEVERE)} * {ind("traffic_condition = 'severe'")}"
             f" + {d(K.LOGIT_TRAFFIC_HIGH)} * {ind("traffic_condition = 'high'")}"
             f" + {d(K.LOGIT_ROUTE_REMOTE)} * {ind("route_type = 'remote'")}"
             f" + {d(K.LOGIT_ROUTE_LONG_HAUL)} * {ind("route_type = 'long_haul'")}"
             f" + {d(K.LOGIT_CARRIER_RATE)} * carrier_base_delay_rate"
             f" + {d(K.LOGIT_FRAGILITY)} * product_fragility_score"
             f" + {d(K.LOGIT_WEEKEND)} * is_weekend"
             f" + {d(K.LOGIT_PEAK)} * is_peak_hour"
             f" + (CASE WHEN estimated_delivery_days > promised_delivery_days THEN {d(K.LOGIT_LATE_ESTIMATE)}"
             f" ELSE 0.0 END)")


def rule_probability_sql() -> str:
    return f"round(1.0 / (1.0 + exp(-({logit_sql()}))), 5)"


def _pick(idx: str, values) -> str:
    return "CASE " + idx + " " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


def _raw_sql() -> str:
    dcs = K.DISTRIBUTION_CENTERS
    crs = K.CARRIERS
    dci, cri = "(sk % 4)", "(sk % 5)"
    weather = lt_case("((31 * ok + ln) % 100)", [(62, "'clear'"), (86, "'rain'"), (92, "'storm'"), (96, "'fog'")],
                      "'heatwave'")
    traffic = lt_case("((17 * pk + ln) % 100)", [(25, "'low'"), (65, "'medium'"), (90, "'high'")], "'severe'")
    route = lt_case("((13 * sk + pk) % 100)", [(38, "'urban'"), (70, "'regional'"), (92, "'long_haul'")],
                    "'remote'")
    promised = lt_case("distance_km", [(d(e), v) for e, v in K.PROMISED_DAYS_EDGES], K.PROMISED_DAYS_ELSE)

    def ind(cond: str) -> str:
        return f"(CASE WHEN {cond} THEN 1.0 ELSE 0.0 END)"

    eta = (f"distance_km / {d(K.ETA_KM_PER_DAY)} / speed_factor"
           f" + (CASE WHEN route_type = 'remote' THEN {d(K.ETA_ROUTE_REMOTE)} ELSE 0.0 END)"
           f" + (CASE WHEN weather_condition = 'storm' THEN {d(K.ETA_WEATHER_STORM)} ELSE 0.0 END)"
           f" + (CASE WHEN weather_condition = 'rain' THEN {d(K.ETA_WEATHER_RAIN)} ELSE 0.0 END)"
           f" + (CASE WHEN traffic_condition = 'severe' THEN {d(K.ETA_TRAFFIC_SEVERE)} ELSE 0.0 END)"
           f" + (CASE WHEN traffic_condition = 'high' THEN {d(K.ETA_TRAFFIC_HIGH)} ELSE 0.0 END)"
           f" + (CASE WHEN is_weekend = 1 THEN {d(K.ETA_WEEKEND)} ELSE 0.0 END)")
    logit = logit_sql()
    return f"""
src_lines AS (
  SELECT l.l_orderkey AS ok, l.l_partkey AS pk, l.l_suppkey AS sk, CAST(l.l_linenumber AS BIGINT) AS ln,
         l.l_quantity, l.l_extendedprice, o.o_orderdate, c.c_custkey AS ck, c.c_name, c.c_mktsegment,
         n.n_name, r.r_name, p.p_name, p.p_type, p.p_size
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
  JOIN part p ON l.l_partkey = p.p_partkey
),
raw_a AS (
  SELECT
    CAST(ok AS VARCHAR) || '-' || CAST(ln AS VARCHAR) AS order_id,
    'B' || CAST(ok % 10 AS VARCHAR) AS batch_id,
    CAST(o_orderdate AS TIMESTAMP) + to_hours(CAST((7 * ok + 5 * ln) % 24 AS BIGINT)) AS order_timestamp,
    CAST(ck AS VARCHAR) AS customer_id,
    c_name AS customer_name,
    CASE WHEN ck % 50 <> 0 THEN 'c' || CAST(ck AS VARCHAR) || '@example.com' END AS customer_email,
    n_name || '/' || c_mktsegment AS city,
    n_name AS state,
    r_name AS region,
    'Street ' || CAST(ck AS VARCHAR) AS address,
    {d(-30.0)} + (ck % 2800) / 100 AS latitude,
    {d(-65.0)} + ((37 * ck) % 3000) / 100 AS longitude,
    CAST(pk AS VARCHAR) AS product_id,
    p_name AS product_bought,
    p_type AS product_category,
    l_extendedprice AS order_value,
    round(p_size * l_quantity / 50, 2) AS order_weight_kg,
    {d(0.02)} + (p_size % 11) / 100 AS product_fragility_score,
    {_pick(dci, [s(x[0]) for x in dcs])} AS dc_id,
    {_pick(dci, [s(x[1]) for x in dcs])} AS dc_city,
    {_pick(dci, [s(x[2]) for x in dcs])} AS dc_state,
    {_pick(dci, [d(x[3]) for x in dcs])} AS dc_latitude,
    {_pick(dci, [d(x[4]) for x in dcs])} AS dc_longitude,
    {_pick(cri, [s(x[0]) for x in crs])} AS carrier,
    {_pick(cri, [d(x[1]) for x in crs])} AS carrier_base_delay_rate,
    {_pick(cri, [d(x[2]) for x in crs])} AS speed_factor,
    {weather} AS weather_condition,
    {traffic} AS traffic_condition,
    {route} AS route_type,
    ((7919 * ok + 104729 * pk + 1299709 * ln) % 100000) / 100000 AS draw,
    ln % 3 AS extra_days
  FROM src_lines
),
raw_b AS (
  SELECT *,
    order_timestamp + to_hours(1) AS ingestion_timestamp,
    CAST(year(order_timestamp) AS BIGINT) AS order_year,
    CAST(month(order_timestamp) AS BIGINT) AS order_month,
    CAST(day(order_timestamp) AS BIGINT) AS order_day,
    CAST(isodow(order_timestamp) - 1 AS BIGINT) AS order_day_of_week,
    CAST(hour(order_timestamp) AS BIGINT) AS order_hour
  FROM raw_a
),
raw_c AS (
  SELECT *,
    CAST(CASE WHEN order_day_of_week >= 5 THEN 1 ELSE 0 END AS BIGINT) AS is_weekend,
    CAST(CASE WHEN order_hour IN ({", ".join(str(h) for h in K.PEAK_HOURS)}) THEN 1 ELSE 0 END AS BIGINT)
      AS is_peak_hour,
    round({haversine_sql("latitude", "longitude", "dc_latitude", "dc_longitude")}, 2) AS distance_km
  FROM raw_b
),
raw_d AS (
  SELECT *,
    CAST({promised} AS BIGINT) AS promised_delivery_days,
    CAST(greatest(1, CAST(ceil({eta}) AS BIGINT)) AS BIGINT) AS estimated_delivery_days
  FROM raw_c
),
raw_e AS (
  SELECT *, round(1.0 / (1.0 + exp(-({logit}))), 5) AS delay_probability_true FROM raw_d
),
raw_f AS (
  SELECT *, CAST(CASE WHEN draw < delay_probability_true THEN 1 ELSE 0 END AS BIGINT) AS delay_risk_label
  FROM raw_e
),
raw AS (
  SELECT order_id, batch_id, order_timestamp, ingestion_timestamp, customer_id, customer_name, customer_email,
    city, state, region, address, latitude, longitude, product_id, product_bought, product_category,
    order_value, order_weight_kg, product_fragility_score, dc_id, dc_city, dc_state, dc_latitude,
    dc_longitude, distance_km, carrier, carrier_base_delay_rate, promised_delivery_days,
    estimated_delivery_days,
    CAST(estimated_delivery_days + delay_risk_label * (1 + extra_days
      + (CASE WHEN weather_condition = 'storm' THEN 1 ELSE 0 END)
      + (CASE WHEN route_type = 'remote' THEN 1 ELSE 0 END)) AS BIGINT) AS actual_delivery_days,
    CASE WHEN delay_risk_label = 1 THEN 'delayed' ELSE 'on_time' END AS delivery_status,
    delay_risk_label, delay_probability_true, order_year, order_month, order_day, order_day_of_week,
    order_hour, is_weekend, is_peak_hour, weather_condition, traffic_condition, route_type
  FROM raw_f
)"""


def _silver_sql() -> str:
    return """
silver AS (
  SELECT *, CAST(order_timestamp AS DATE) AS order_date
  FROM raw
  WHERE order_id IS NOT NULL AND order_timestamp IS NOT NULL AND order_value > 0 AND distance_km >= 0
)"""


def _case_map(expr: str, mapping, default: float) -> str:
    parts = " ".join(f"WHEN {s(k)} THEN {d(v)}" for k, v in mapping)
    return f"CASE lower(coalesce({expr}, '')) {parts} ELSE {d(default)} END"


def _gold_sql() -> str:
    def cyc(fn: str, c: str, period: int) -> str:
        return f"{fn}({d(2.0 * math.pi)} * {c} / {d(float(period))})"

    def log1p(c: str) -> str:
        return f"CASE WHEN {c} IS NOT NULL THEN ln(1 + greatest({c}, 0.0)) END"

    def sdiv(a: str, b: str) -> str:
        return f"CASE WHEN {b} <> 0 THEN {a} / {b} END"

    dist = lt_case("distance_km", [(d(e), s(v)) for e, v in K.GOLD_DISTANCE_BANDS], s(K.GOLD_DISTANCE_ELSE))
    wt = lt_case("order_weight_kg", [(d(e), s(v)) for e, v in K.GOLD_WEIGHT_BANDS], s(K.GOLD_WEIGHT_ELSE))
    return f"""
gold_base AS (
  SELECT order_id, order_timestamp, delay_risk_label, order_value, order_weight_kg, product_fragility_score,
    distance_km, carrier_base_delay_rate, promised_delivery_days, estimated_delivery_days, city, state, region,
    product_category, carrier, dc_id, dc_state, traffic_condition, weather_condition, route_type, order_month,
    order_day, order_day_of_week, order_hour, is_weekend, is_peak_hour
  FROM silver
),
gold_scored AS (
  SELECT *,
    CAST(estimated_delivery_days - promised_delivery_days AS BIGINT) AS estimated_minus_promised_days,
    {sdiv("CAST(estimated_delivery_days AS DOUBLE)", "promised_delivery_days")} AS estimated_over_promised,
    {log1p("order_value")} AS log_order_value,
    {log1p("distance_km")} AS log_distance_km,
    {log1p("order_weight_kg")} AS log_weight_kg,
    {sdiv("order_value", "order_weight_kg")} AS value_per_kg,
    {sdiv("order_value", "distance_km")} AS value_per_km,
    order_weight_kg * distance_km AS weight_distance_interaction,
    {cyc("sin", "order_hour", 24)} AS hour_sin,
    {cyc("cos", "order_hour", 24)} AS hour_cos,
    {cyc("sin", "order_day_of_week", 7)} AS dow_sin,
    {cyc("cos", "order_day_of_week", 7)} AS dow_cos,
    {cyc("sin", "order_month", 12)} AS month_sin,
    {cyc("cos", "order_month", 12)} AS month_cos,
    CAST(CASE WHEN state = dc_state THEN 1 ELSE 0 END AS BIGINT) AS same_state_dc,
    {dist} AS distance_band,
    {wt} AS weight_band,
    {_case_map("traffic_condition", K.GOLD_TRAFFIC_RISK, K.GOLD_TRAFFIC_ELSE)} AS traffic_risk_score,
    {_case_map("weather_condition", K.GOLD_WEATHER_RISK, K.GOLD_WEATHER_ELSE)} AS weather_risk_score,
    {_case_map("route_type", K.GOLD_ROUTE_RISK, K.GOLD_ROUTE_ELSE)} AS route_risk_score
  FROM gold_base
),
gold AS (
  SELECT *, (traffic_risk_score + weather_risk_score + route_risk_score) / {d(3.0)} AS combined_operational_risk
  FROM gold_scored
)"""


CTES = {
    "raw": _raw_sql,
    "silver": _silver_sql,
    "gold": _gold_sql,
}
CTE_DEPS = {"raw": [], "silver": ["raw"], "gold": ["silver"]}


def register_cte(name: str, deps: list[str], builder) -> None:
    CTES[name] = builder
    CTE_DEPS[name] = deps


def with_ctes(needs: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for dep in CTE_DEPS[n]:
            visit(dep)
        if n not in order:
            order.append(n)

    for n in needs:
        visit(n)
    parts = [CTES[n]().strip() for n in order]
    return "WITH " + ",\n".join(parts) + "\n" + body.strip()
