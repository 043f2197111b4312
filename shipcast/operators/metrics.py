"""Operational KPIs and grouped rates.

All are single-pass aggregates with partial (map-side) aggregation, so a
hot group (one state holding a third of the orders) is pre-reduced inside
every input task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shipcast.functions.expr import exact_avg, exact_sum

MONEY = 2  # order values and distances carry two decimals
DELAY_DIMENSIONS = ["traffic_condition", "weather_condition", "carrier", "route_type", "state"]


def order_kpis(orders: DataFrame) -> DataFrame:
    """A1: count, revenue, mean value, mean distance, delay rate (NULL -> 0)."""
    return orders.agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.coalesce(exact_sum("order_value", MONEY), F.lit(0.0)).alias("total_revenue"),
        F.coalesce(exact_avg("order_value", MONEY), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(exact_avg("distance_km", MONEY), F.lit(0.0)).alias("avg_distance_km"),
        F.coalesce(F.avg("delay_risk_label"), F.lit(0.0)).alias("delay_risk_rate"))


def orders_by_state(orders: DataFrame) -> DataFrame:
    """A2: orders and revenue per state, most orders first."""
    return (orders.groupBy("state")
            .agg(F.count(F.lit(1)).alias("orders"), exact_sum("order_value", MONEY).alias("revenue"))
            .orderBy(F.col("orders").desc(), F.col("state")))


def orders_by(orders: DataFrame, dim: str) -> DataFrame:
    """A3 / A4: orders and delay rate per ``dim``, most orders first."""
    return (orders.groupBy(dim)
            .agg(F.count(F.lit(1)).alias("orders"), F.avg("delay_risk_label").alias("delay_risk_rate"))
            .orderBy(F.col("orders").desc(), F.col(dim)))


def order_metrics_cube(orders: DataFrame) -> DataFrame:
    """A5: A1–A4 in one scan with grouping sets (), (state), (carrier) and
    (traffic_condition); ``grouping_set`` names the set of each row."""
    dims = ["state", "carrier", "traffic_condition"]
    sets = orders.groupingSets([[], *[[F.col(d)] for d in dims]], *[F.col(d) for d in dims])
    which = F.grouping_id(*dims)
    kind = F.when(which == 7, "all").when(which == 3, "state").when(which == 5, "carrier").otherwise("traffic_condition")
    return sets.agg(
        kind.alias("grouping_set"), F.count(F.lit(1)).alias("orders"),
        F.coalesce(exact_sum("order_value", MONEY), F.lit(0.0)).alias("revenue"),
        F.coalesce(exact_avg("order_value", MONEY), F.lit(0.0)).alias("avg_order_value"),
        F.coalesce(exact_avg("distance_km", MONEY), F.lit(0.0)).alias("avg_distance_km"),
        F.coalesce(F.avg("delay_risk_label"), F.lit(0.0)).alias("delay_risk_rate"))


def delay_rate_by(features: DataFrame, dims=DELAY_DIMENSIONS, label: str = "delay_risk_label",
                  top: int = 20) -> DataFrame:
    """Delay rate per value of each dimension, top ``top`` per
    dimension by rate. One unpivot + one grouped aggregate instead of one
    scan per dimension; the ranking window runs over the (small) grouped
    result, partitioned by dimension."""
    stacked = features.select(
        F.col(label).alias("_y"),
        F.explode(F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value"))
                             for d in dims])).alias("_d")).select("_d.*", "_y")
    g = (stacked.groupBy("dimension", "value")
         .agg(F.count(F.lit(1)).alias("orders"), F.avg("_y").alias("delay_rate")))
    w = Window.partitionBy("dimension").orderBy(F.col("delay_rate").desc(), F.col("value"))
    return g.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)


def target_distribution(df: DataFrame, label: str = "delay_risk_label") -> DataFrame:
    """Class share (value_counts(normalize=True))."""
    g = df.groupBy(label).agg(F.count(F.lit(1)).alias("orders"))
    w = Window.partitionBy()
    return g.select(F.col(label).alias("label"), "orders",
                    (F.col("orders") / F.sum("orders").over(w)).alias("share"))


def share_of_total(orders: DataFrame, dim: str = "state", scale: float = 300.0) -> DataFrame:
    """Per group, orders and the bar width min(100, scale·orders/total)."""
    g = orders.groupBy(dim).agg(F.count(F.lit(1)).alias("orders"))
    total = orders.agg(F.count(F.lit(1)).alias("_total")).withColumn("_k", F.lit(1))
    j = g.withColumn("_k", F.lit(1)).join(F.broadcast(total), "_k")
    return j.select(dim, "orders", F.least(F.lit(100.0), F.col("orders") / F.greatest(F.lit(1), F.col("_total"))
                                           * F.lit(scale)).alias("share_pct"))


def delta_direction(delta_col: str) -> F.Column:
    """P17: 'up' / 'down' / 'neutral' by the sign of a delta (NULL neutral)."""
    c = F.col(delta_col)
    return F.when(c < 0, "down").when(c > 0, "up").otherwise("neutral")


#: A page that ends within so many rows is taken from the top; a later one is looked up first.
TOP_ROWS = 10_000


def latest_orders(orders: DataFrame, limit: int = 100, offset: int = 0) -> DataFrame:
    """Newest orders page (order_id breaks ties, rows without a time come
    last); limit 1–1000, offset 0 or more; other values are an error.

    A deep page is found by counts: of each year, of the hours of the year in
    which it begins, and so on to the second. Only rows from that second back
    are ordered, so no task holds the rows that the offset skips."""
    if not 1 <= limit <= 1000 or offset < 0:
        raise ValueError("limit must be between 1 and 1000, offset not negative")
    ts, rows, left = F.col("order_timestamp"), orders, int(offset)
    if offset + limit > TOP_ROWS:
        inside = orders.where(ts.isNotNull())
        for unit in ("year", "hour", "minute", "second"):
            start = None
            for t, n in inside.groupBy(F.date_trunc(unit, ts).alias("t")).count().orderBy(F.desc("t")).collect():
                if n > left:
                    start = t
                    break
                left -= n
            if start is None:  # the page lies among the rows without a time
                rows = orders.where(ts.isNull())
                break
            inside = inside.where(F.date_trunc(unit, ts) == F.lit(start))
            rows = orders.where((F.date_trunc(unit, ts) <= F.lit(start)) | ts.isNull())
    out = rows.orderBy(ts.desc(), F.col("order_id"))
    return out.offset(left).limit(limit) if left else out.limit(limit)


def cap_rows(orders: DataFrame, max_rows: int | None = 500_000, key: str = "order_id") -> DataFrame:
    """The oldest ``max_rows`` rows (``key`` breaks ties), or all.

    The cap falls into one minute, found from the counts of each hour and of
    that hour's minutes; rows before that minute are kept by a plain filter,
    and only that minute's rows are ranked. Rows without a time come first,
    as in the order the cap is defined by, so they fill the cap first."""
    if max_rows is None:
        return orders
    ts = F.col("order_timestamp")
    missing = orders.where(ts.isNull())
    left = max_rows - missing.count()
    if left <= 0:
        return missing.orderBy(key).limit(max_rows)
    rows, start = orders.where(ts.isNotNull()), None
    for unit in ("year", "hour", "minute"):
        # One row for each year, then for each hour of a year, then for each minute of an hour.
        inside = rows if start is None else rows.where(F.date_trunc(before, ts) == F.lit(start))
        counts = inside.groupBy(F.date_trunc(unit, ts).alias("t")).count().orderBy("t").collect()
        before, start = unit, None
        for t, n in counts:
            if n > left:
                start = t
                break
            left -= n
        if start is None:
            return orders
    edge = F.date_trunc("minute", ts)
    kept = missing.unionByName(rows.where(edge < F.lit(start)))
    return kept.unionByName(rows.where(edge == F.lit(start)).orderBy(ts, key).limit(left)) if left else kept


def top_risk_orders(scored: DataFrame, score: str, limit: int = 100) -> DataFrame:
    """The riskiest orders (order_id breaks ties)."""
    return scored.orderBy(F.col(score).desc(), F.col("order_id")).limit(limit)
