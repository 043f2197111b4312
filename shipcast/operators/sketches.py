"""Approximate profiles from mergeable sketches (A11, A12, P11 at scale).

The exact profiles shuffle every distinct value of a column. Here each month
of each column is one row of fixed size: its counts, a HyperLogLog sketch of
its distinct values and a KLL sketch of its quantiles. Sketches of months are
stored, new or changed months replace their own rows, and any span of months
is profiled by merging rows, without another look at the data.

Bounds: the number of distinct values has a relative standard error of
``1.04 / sqrt(2 ** lg_k)`` (1.6 % by default); the rank of a quantile is off by
at most ``RANK_ERROR`` with 99 % confidence (k = 200).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shipcast.operators.quality import numeric_columns

LG_K, KLL_K, RANK_ERROR = 12, 200, 0.0133
MONTH = "month"


def month_sketches(df: DataFrame, time_col: str = "order_timestamp", columns: list[str] | None = None, lg_k: int = LG_K, k: int = KLL_K) -> DataFrame:
    """(month, column_name, rows, filled, distinct, quantiles) of each column
    in each month (yyyy-MM; rows without a time have the month ``none``).
    ``quantiles`` is null for columns that are no numbers; NaN counts as
    missing there. One scan with partial aggregation."""
    columns = columns or df.columns
    numbers = set(numeric_columns(df))
    aggs = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), F.hll_sketch_agg(col.cast("string"), F.lit(lg_k)).alias(f"d{i}")]
        if c in numbers:
            aggs.append(F.kll_sketch_agg_double(F.nullif(col.cast("double"), F.lit(float("nan"))), F.lit(k)).alias(f"q{i}"))
    by = df.groupBy(F.coalesce(F.date_format(time_col, "yyyy-MM"), F.lit("none")).alias(MONTH)).agg(F.count(F.lit(1)).alias("rows"), *aggs)
    cells = [F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("filled"), F.col(f"d{i}").alias("distinct"),
                      (F.col(f"q{i}") if c in numbers else F.lit(None).cast("binary")).alias("quantiles")) for i, c in enumerate(columns)]
    return by.select(MONTH, "rows", F.explode(F.array(*cells)).alias("c")).select(MONTH, "c.column_name", "rows", "c.filled", "c.distinct", "c.quantiles")


def store_sketches(sketches: DataFrame, path: str) -> None:
    """Write the sketches of some months; other months stay as they are."""
    (sketches.repartition(MONTH).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(MONTH).parquet(path))


def approx_profile(sketches: DataFrame, quantiles=(0.25, 0.5, 0.75)) -> DataFrame:
    """column_name, rows, null_pct, nunique (estimate) and the approximate
    quantiles (null for columns that are no numbers or have no values) of
    the months in ``sketches``."""
    merged = sketches.groupBy("column_name").agg(F.sum("rows").alias("rows"), F.sum("filled").alias("filled"),
                                                 F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"))
    some = F.col("quantiles").isNotNull() & (F.coalesce(F.kll_sketch_get_n_double("quantiles"), F.lit(0)) > 0)
    marks = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q)))).alias(f"p{int(round(q * 100))}") for q in quantiles]
    return merged.select("column_name", "rows", F.when(F.col("rows") > 0, F.lit(100.0) * (F.col("rows") - F.col("filled")) / F.col("rows")).alias("null_pct"),
                         F.when(F.col("filled") > 0, F.hll_sketch_estimate("distinct")).otherwise(F.lit(0)).alias("nunique"), *marks)
