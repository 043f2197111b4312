"""Data-quality and profiling aggregates.

Each profile is one scan: per-column statistics are computed as columns of
a single aggregate, or over an unpivoted (column, value) stream whose
grouped aggregates run partial (map-side) first, so no column's values are
ever gathered into one task.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shipcast import constants as K
from shipcast.operators.ordered import value_buckets

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, NUMERIC) and f.name not in exclude]


def column_audit(df: DataFrame) -> DataFrame:
    """A11 + P10: per column its type, distinct non-NULL values, NULL percent
    and whether it is a known outcome (leakage) column.

    The table is unpivoted to (column, value-as-text) pairs; distinct pairs
    are found with one grouped aggregate (partial aggregation first), then
    counted per column. This stays linear in the column count instead of
    one distinct-aggregation branch per column."""
    fields = df.schema.fields
    pairs = df.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("position"), F.col(f"`{f.name}`").cast("string").alias("v"))
        for i, f in enumerate(fields)])).alias("p")).select("p.*")
    per_col = (pairs.groupBy("position", "v").agg(F.count(F.lit(1)).alias("c"))
               .groupBy("position").agg(F.count("v").alias("nunique"),
                                        F.sum(F.when(F.col("v").isNull(), F.col("c")).otherwise(0)).alias("nulls"),
                                        F.sum("c").alias("n")))
    meta = df.sparkSession.createDataFrame(
        [(i, f.name, f.dataType.simpleString(), f.name in K.LEAKAGE_COLUMNS) for i, f in enumerate(fields)],
        "position bigint, column_name string, dtype string, is_leakage boolean")
    return (F.broadcast(meta).join(per_col, "position", "left")
            .select("column_name", "position", "dtype", F.coalesce("nunique", F.lit(0)).cast("long").alias("nunique"),
                    F.when(F.col("n") > 0, F.lit(100.0) * F.col("nulls") / F.col("n")).alias("null_pct"),
                    "is_leakage"))


def numeric_summary(df: DataFrame, cols: list[str] | None = None,
                    quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """Count, mean, sample std, min, exact 25/50/75 % (linear
    interpolation between order statistics), max per numeric column.

    Three scans: the moments of all columns as one row; the counts of each
    column's value buckets (bounded, see ``value_buckets``), which say in
    which buckets the wanted ranks lie; and the distinct values of those
    buckets alone. The moments and the target buckets are a few rows for each
    column, so what the driver sees is bounded by the schema.
    """
    cols = cols or numeric_columns(df)
    names = ("count", "mean", "std", "min", "max")
    values = {c: F.col(f"`{c}`").cast("double") for c in cols}
    moments = df.agg(*[f(v).alias(f"{i}_{n}") for i, v in enumerate(values.values())
                       for n, f in zip(names, (F.count, F.avg, F.stddev_samp, F.min, F.max))]).first().asDict()
    stats = [{n: moments[f"{i}_{n}"] for n in names} for i in range(len(cols))]
    cells = []
    for i, v in enumerate(values.values()):
        lo, hi = stats[i]["min"] or 0.0, stats[i]["max"] or 0.0
        span = hi - lo if 0 < hi - lo < math.inf else 1.0
        cells.append(F.struct(F.lit(i).alias("c"), v.alias("v"), F.lit(float(lo)).alias("lo"), F.lit(float(span)).alias("span")))
    stacked = df.select(F.explode(F.array(*cells)).alias("s")).select("s.*").where(F.col("v").isNotNull())
    part, size = value_buckets(F.col("v"), F.col("lo"), F.col("span"))
    stacked = stacked.select("c", "v", part.alias("part"), size.alias("size"))
    along = Window.partitionBy("c").orderBy("part", "size").rowsBetween(Window.unboundedPreceding, -1)
    counted = (stacked.groupBy("c", "part", "size").agg(F.count(F.lit(1)).alias("n"))
               .withColumn("before", F.coalesce(F.sum("n").over(along), F.lit(0))))
    ranks = {(i, q): (s["count"] - 1) * q for i, s in enumerate(stats) for q in quantiles if s["count"]}
    wanted = df.sparkSession.createDataFrame(
        sorted({(i, int(k)) for (i, _q), h in ranks.items() for k in (math.floor(h), math.ceil(h))}), "c int, rank long")
    inside = (F.col("rank") >= F.col("before")) & (F.col("rank") < F.col("before") + F.col("n"))
    targets = counted.join(F.broadcast(wanted), "c").where(inside).select("c", "part", "size", "before").distinct()
    freq = (stacked.join(F.broadcast(targets), ["c", "part", "size"])  # at most two for each column and quantile
            .groupBy("c", "before", "v").agg(F.count(F.lit(1)).alias("n")))
    up = Window.partitionBy("c", "before").orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = freq.withColumn("upto", F.col("before") + F.sum("n").over(up))
    hit = (F.col("rank") < F.col("upto")) & (F.col("rank") >= F.col("upto") - F.col("n"))
    found = {(r["c"], r["rank"]): r["v"] for r in upto.join(F.broadcast(wanted), "c").where(hit).select("c", "rank", "v").collect()}
    rows = []
    for i, (c, s) in enumerate(zip(cols, stats)):
        if not s["count"]:
            continue
        marks = []
        for q in quantiles:
            h = ranks[i, q]
            a, b, t = found[i, math.floor(h)], found[i, math.ceil(h)], h - math.floor(h)
            marks.append(b - (b - a) * (1.0 - t) if t >= 0.5 else a + (b - a) * t)
        rows.append((c, s["count"], s["mean"], s["std"], s["min"], *marks, s["max"]))
    marks = ", ".join(f"p{int(round(q * 100))} double" for q in quantiles)
    return df.sparkSession.createDataFrame(rows, f"column_name string, count long, mean double, std double, min double, {marks}, max double")


def data_quality_report(df: DataFrame, target: str = "delay_risk_label",
                        time_col: str = "order_timestamp") -> DataFrame:
    """Rows, columns, date range, target rate and leakage columns."""
    leak = [c for c in K.LEAKAGE_COLUMNS if c in df.columns]
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.lit(len(df.columns)).cast("long").alias("columns"),
        F.min(time_col).alias("min_timestamp"),
        F.max(time_col).alias("max_timestamp"),
        F.avg(target).alias("delay_rate"),
        F.lit(", ".join(leak)).alias("leakage_columns"))


def quality_checks(df: DataFrame) -> DataFrame:
    """Rows, duplicate ids (rows − distinct ids; NULL counts as one
    id), missing e-mail share, values ≤ 0, negative distances, delay rate,
    distinct states and carriers. An empty table has zero counts and NULL
    shares.

    The measures are summed for each state and carrier, a table of as many
    rows as there are pairs, and added up from there; the ids are grouped by
    a narrow scan of their own. One aggregate with three distinct counts
    would write every row once for each of them."""
    label = F.col("delay_risk_label")
    pairs = df.groupBy("state", "carrier").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("customer_email").isNull()).alias("no_email"),
        F.count_if(F.col("order_value") <= 0).alias("no_value"), F.count_if(F.col("distance_km") < 0).alias("no_distance"),
        F.sum(label.cast("double")).alias("late"), F.count(label).alias("labelled"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    measures = pairs.agg(
        total("n").alias("rows"), (F.sum("no_email") / F.sum("n")).alias("missing_email_pct"),
        total("no_value").alias("negative_order_values"), total("no_distance").alias("invalid_distance"),
        (F.sum("late") / F.nullif(F.sum("labelled"), F.lit(0))).alias("delay_rate"),
        F.count_distinct("state").alias("states"), F.count_distinct("carrier").alias("carriers"))
    ids = df.groupBy("order_id").agg(F.count(F.lit(1)).alias("n")).agg(total(F.col("n") - 1).alias("duplicate_order_id"))
    one = F.lit(1).alias("_k")
    return (measures.select("*", one).join(F.broadcast(ids.select("*", one)), "_k")  # a row each
            .select("rows", "duplicate_order_id", "missing_email_pct", "negative_order_values", "invalid_distance",
                    "delay_rate", "states", "carriers"))


def target_correlations(df: DataFrame, target: str = "delay_risk_label", top: int = 20) -> DataFrame:
    """Pearson correlation of each numeric column with the target
    (pairwise-complete), strongest |r| first; undefined (constant) columns
    are left out. Unpivoted to (column, x, y) and aggregated per column, so
    each column's moments merge from per-task partial aggregates."""
    cols = numeric_columns(df, exclude=(target,))
    y = F.col(target).cast("double")
    st = (df.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("x"), y.alias("y")) for c in cols]))
        .alias("s")).select("s.*").where(F.col("x").isNotNull() & F.col("y").isNotNull()))
    sx, sy = F.stddev_pop("x"), F.stddev_pop("y")
    # NULL when either side is constant (Spark's corr divides by zero there,
    # which ANSI mode rejects)
    r = st.groupBy("column_name").agg(F.when((sx > 0) & (sy > 0), F.covar_pop("x", "y") / (sx * sy))
                                      .alias("correlation"))
    r = r.where(F.col("correlation").isNotNull() & ~F.isnan("correlation"))
    return r.orderBy(F.abs("correlation").desc(), F.col("column_name")).limit(top)
