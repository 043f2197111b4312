"""Silver cleaning, coercion, normalisation and keep-first dedupe
(P1, P6, P7, P8, W3)."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DEDUPE_ORDER = ["ingestion_timestamp", "product_id", "dc_id", "order_value", "order_weight_kg",
                "order_timestamp", "batch_id"]


def clean_orders(raw: DataFrame) -> DataFrame:
    """Silver filter (id, timestamp not NULL; value > 0; distance >= 0)
    plus ``order_date`` = DATE(order_timestamp). The filter is pushed into the
    scan when ``raw`` is a Parquet read."""
    return (raw.where(F.col("order_id").isNotNull() & F.col("order_timestamp").isNotNull()
                      & (F.col("order_value") > 0) & (F.col("distance_km") >= 0))
               .withColumn("order_date", F.to_date("order_timestamp")))


def normalize_name(name: str) -> str:
    """Strip, lower, space -> '_', drop everything outside [a-z0-9_]."""
    return re.sub(r"[^a-z0-9_]", "", name.strip().lower().replace(" ", "_"))


def normalize_columns(df: DataFrame) -> DataFrame:
    """Rename columns by ``normalize_name`` (driver-side metadata only)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def coerce_types(df: DataFrame, timestamp_cols=("order_timestamp", "ingestion_timestamp"),
                 label: str = "delay_risk_label") -> DataFrame:
    """Bad timestamps -> NULL, label non-numeric -> NULL -> 0 -> bigint.

    Under ANSI mode a plain cast raises on bad input, so ``try_*`` forms are
    used. Timestamp columns that are already typed are left as they are.
    """
    exprs = {}
    types = dict(df.dtypes)
    for c in timestamp_cols:
        if c in types and types[c] == "string":
            exprs[c] = F.col(c).try_cast("timestamp_ntz")
    if label in types:
        num = (F.col(label) if types[label] != "string"
               else F.expr(f"try_cast({label} AS double)"))
        exprs[label] = F.coalesce(num.cast("double"), F.lit(0.0)).cast("long")
    return df.withColumns(exprs) if exprs else df


#: Mark of a row: 0 another row of its key comes first, 1 it is the first, 2 it may be.
MARK = "_first"


def mark_first(rows: DataFrame, key: list[str], order: list[Column]) -> DataFrame:
    """Add ``MARK`` to narrow rows from which wide ones are derived: 1 for the
    row that keep-first dedupe keeps by ``order``, one of each set of equal
    rows; 2 where rows of a key that differ tie by ``order``, so that only the
    wide rows decide, and where the key has a NULL; else 0.

    All windows lie in one sort of the rows by key, so no row is shuffled
    again that already lies by a column of the key."""
    by = {f"_o{i}": c for i, c in enumerate(order)}
    rest = [c for c in rows.columns if c not in key]
    all_equal = Window.partitionBy(*key).orderBy(*by, *rest)
    ranked = rows.withColumns(by).withColumns({"_row": F.row_number().over(all_equal), "_kind": F.dense_rank().over(all_equal)})
    ranked = ranked.withColumn("_rank", F.rank().over(Window.partitionBy(*key).orderBy(*by)))
    ranked = ranked.withColumn("_kinds", F.max("_kind").over(Window.partitionBy(*key, *by)))
    unkeyed = F.lit(False)
    for c in key:
        unkeyed = unkeyed | F.col(c).isNull()
    mark = (F.when(unkeyed, 2).when(F.col("_rank") > 1, 0).when(F.col("_kinds") > 1, 2)
            .when(F.col("_row") == 1, 1).otherwise(0))
    return ranked.select(*rows.columns, mark.alias(MARK))


def dedupe_orders(df: DataFrame, key: str = "order_id", order_by=None,
                  derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Keep the first row per key (what a primary key with INSERT OR
    IGNORE keeps), under a total order: ``order_by`` columns first, then every
    other column, so ties cannot pick an arbitrary row.

    Written as ``min(struct(...))`` per key rather than a ranked window: the
    aggregate runs a partial (map-side) pass, so a hot key holding a large
    share of the rows is reduced inside each input task before the shuffle
    instead of being sorted in a single task.

    With ``derive``, ``df`` are narrow rows that carry ``MARK`` (see
    ``mark_first``), and ``derive`` makes the wide rows: rows with mark 1 pass,
    and only those with mark 2, if there are any, go through the aggregate."""
    if derive:
        alone, tied = derive(df.where(F.col(MARK) == 1)), df.where(F.col(MARK) == 2)
        return alone if tied.isEmpty() else alone.unionByName(dedupe_orders(derive(tied), key, order_by))
    order_by = list(order_by or [c for c in DEDUPE_ORDER if c in df.columns])
    rest = [c for c in df.columns if c not in order_by and c != key]
    cols = df.columns
    return (df.groupBy(key)
              .agg(F.min(F.struct(*order_by, *rest)).alias("_first"))
              .select(key, "_first.*")
              .select(*cols))
