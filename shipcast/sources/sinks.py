"""Idempotent sinks (S5–S7, S10, S12): keyed inserts, backfill, audit rows,
prediction append and small JSON reports."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.operators.clean import MARK, dedupe_orders
from shipcast.operators.metrics import cap_rows
from shipcast.sources.keyed import KeyIndex
from shipcast.sources.layers import align_schema, append_rows, hadoop_path, has_files  # noqa: F401  (re-exported sinks)


def new_rows(incoming: DataFrame, target: DataFrame, key: str = "order_id",
             derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Rows of ``incoming`` whose key the target lacks, first row
    per key (INSERT OR IGNORE on a primary key). The anti join shuffles only
    the key column of the target. With ``derive``, ``incoming`` are marked
    narrow rows (see ``dedupe_orders``), and they are joined as such."""
    if derive:
        return dedupe_orders(incoming, key, derive=lambda rows: derive(rows.join(target.select(key), key, "left_anti")))
    return dedupe_orders(incoming, key).join(target.select(key), key, "left_anti")


def insert_new_orders(incoming: DataFrame, target: DataFrame, target_path: str, key: str = "order_id") -> int:
    """Append the new rows to the target table; returns by how many rows
    it grew (two counts from the file footers; the join runs once)."""
    spark = target.sparkSession
    before = _stored(spark, target_path)
    new_rows(incoming, target, key).write.mode("append").parquet(target_path)
    return _stored(spark, target_path) - before


def _stored(spark: SparkSession, path: str) -> int:
    """The rows of a table, from its file footers."""
    return spark.read.parquet(path).count() if has_files(spark, path) else 0


def insert_through_index(incoming: DataFrame, target_path: str, key: str = "order_id",
                         derive: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """S5 for small batches into a large table: the table's key index says
    which keys are stored; returns by how many rows the table grew. With
    ``derive``, ``incoming`` are marked narrow rows (see ``dedupe_orders``):
    they are sorted once, kept beside the table while the index is asked, and
    only the rows that are inserted are made wide."""
    spark = incoming.sparkSession
    index = KeyIndex(spark, target_path, key)
    index.sync()
    if derive:
        work = f"{target_path.rstrip('/')}_work/{uuid.uuid4().hex}"
        incoming.where(F.col(MARK) > 0).write.option("compression", "zstd").parquet(work)
        first = spark.read.schema(incoming.schema).parquet(work)
        before = _stored(spark, target_path)
        dedupe_orders(first, key, derive=lambda rows: derive(index.missing(rows))).write.mode("append").parquet(target_path)
        folder, fs = hadoop_path(spark, work)
        fs.delete(folder, True)
        return _stored(spark, target_path) - before
    new = index.missing(dedupe_orders(incoming, key)).persist()
    try:
        new.write.mode("append").parquet(target_path)
        return new.count()
    finally:
        new.unpersist()


def backfill_rows(source: DataFrame, warehouse: DataFrame, key: str = "order_id",
                  max_rows: int | None = None, derive: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """Source rows missing from the warehouse, optionally the oldest
    ``max_rows`` of them (order id breaks ties, see ``cap_rows``). One read →
    anti join → append job instead of LIMIT/OFFSET paging, so no row is
    skipped when a page fails; rows are appended, so they are not sorted.
    ``derive`` makes the wide rows from joined narrow ones."""
    rows = source.join(warehouse.select(key), key, "left_anti")
    return cap_rows(derive(rows) if derive else rows, max_rows, key)


PROGRESS = "lo timestamp_ntz, hi timestamp_ntz, rows bigint"


def backfill_in_ranges(source: DataFrame, warehouse_path: str, progress_path: str, key: str = "order_id",
                       time_col: str = "order_timestamp", range_rows: int = 50_000_000, max_ranges: int | None = None,
                       derive: Callable[[DataFrame], DataFrame] | None = None) -> int:
    """S7, resumable: append the source rows that the warehouse lacks, oldest
    range of months first, and note each finished range in the progress table
    (lo, hi, rows); the number of ranges done by this call.

    A retry leaves out the months of noted ranges. A range that was appended
    but not noted adds nothing again, because the missing keys are found anew
    by every call (one anti join of the narrow key columns). A range is as many
    whole months as hold ``range_rows`` missing rows, and reads only its time
    range of the source; rows without a time are a range of their own.
    ``max_ranges`` ends a call early. ``derive`` makes the wide rows from
    narrow ones of the source, after the join."""
    spark = source.sparkSession
    month = F.date_trunc("month", F.col(time_col)).cast("timestamp_ntz")
    keys = source.select(key, month.alias("_m"))
    if has_files(spark, progress_path):
        # One row for each range: bounded by the months.
        noted = spark.read.parquet(progress_path).select("lo", "hi").collect()
        for lo, hi in noted:
            keys = keys.where(F.col("_m").isNotNull() if lo is None else F.col("_m").isNull() | (F.col("_m") < _ntz(lo)) | (F.col("_m") >= _ntz(hi)))
    if has_files(spark, warehouse_path):
        keys = keys.join(spark.read.parquet(warehouse_path).select(key), key, "left_anti")
    work = f"{progress_path.rstrip('/')}_work/{uuid.uuid4().hex}"
    keys.write.partitionBy("_m").parquet(work)
    missing = spark.read.schema(keys.schema).parquet(work)
    ranges: list[list] = []
    for at, n in missing.groupBy("_m").count().orderBy("_m").collect():
        if ranges and ranges[-1][0] is not None and ranges[-1][2] < range_rows:
            ranges[-1][1:] = [_next_month(at), ranges[-1][2] + n]
        else:
            ranges.append([at, None if at is None else _next_month(at), n])
    for done, (lo, hi, n) in enumerate(ranges):
        if done == max_ranges:
            return done
        ts, m = F.col(time_col), F.col("_m")
        inside = (ts.isNull(), m.isNull()) if lo is None else ((ts >= _ntz(lo)) & (ts < _ntz(hi)), (m >= _ntz(lo)) & (m < _ntz(hi)))
        rows = source.where(inside[0]).join(missing.where(inside[1]).select(key), key, "left_semi")
        (derive(rows) if derive else rows).write.mode("append").parquet(warehouse_path)
        spark.createDataFrame([(lo, hi, n)], PROGRESS).coalesce(1).write.mode("append").parquet(progress_path)
    folder, fs = hadoop_path(spark, work)
    fs.delete(folder, True)
    return len(ranges)


def _ntz(at: datetime) -> Column:
    return F.lit(str(at)).cast("timestamp_ntz")


def _next_month(at: datetime) -> datetime:
    return (at.replace(day=1) + timedelta(days=32)).replace(day=1)


def ingestion_log_row(batch_id, rows_generated: DataFrame, rows_operational: int, rows_warehouse: int,
                      warehouse_enabled: bool, created_at: str, message: str = "") -> DataFrame:
    """One audit row; status success when every row reached the
    warehouse or the warehouse is off, else warning."""
    spark = rows_generated.sparkSession
    n = rows_generated.count()
    status = "success" if (rows_warehouse == n or not warehouse_enabled) else "warning"
    return spark.createDataFrame(
        [(str(batch_id), batch_id, created_at, n, rows_operational, rows_warehouse, status, message)],
        "id string, batch_id string, created_at string, rows_generated bigint, rows_inserted_sqlite bigint, "
        "rows_inserted_bigquery bigint, status string, message string",
    ).withColumn("created_at", F.col("created_at").cast("timestamp_ntz"))


def write_report(df: DataFrame, path: str) -> None:
    """Small result tables (metrics, hypotheses) as one JSON file.
    Only for aggregates whose size is bounded by the report, never data."""
    df.coalesce(1).write.mode("overwrite").json(path)
