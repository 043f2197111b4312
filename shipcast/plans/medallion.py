"""Layer accessors: the derived tables every query reads.

lines (the joined input tables, 15 narrow columns and the mark of the first
line of an order id) → raw (43 columns) → silver (cleaned, plus order_date) →
gold (47 columns) / training features. Lines are materialized once per input
folder when a shared checkpoint folder is configured (see
``shipcast.sources.layers.layer``); raw, silver and training rows follow from
a line alone and are derived where they are read, so a query computes the
columns it needs and no wide row is stored or shuffled for it. The refreshes
(S4) write silver and gold as tables: the narrow lines are dealt out and sorted
as the table is clustered, then the wide rows are made.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.operators.clean import clean_orders
from shipcast.operators.features import GOLD_COLUMNS, gold_features, training_features
from shipcast.session import prefer_compiled
from shipcast.sources.layers import MONTH, Step, as_stored, by_month, by_time, layer
from shipcast.sources.orders import by_date, joined_lines, order_columns


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefer_compiled(spark)
    return layer(spark, sf_dir, "lines", lambda: joined_lines(spark, sf_dir))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_stored(order_columns(lines(spark, sf_dir)))


def silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_orders(raw_orders(spark, sf_dir))


def silver_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver, stored in the order of its time and cluster keys."""
    return layer(spark, sf_dir, "silver", lambda: clean_orders(order_columns(lines(spark, sf_dir), by_time)), arranged=True)


def silver_by_date(spark: SparkSession, sf_dir: str, deal: Step, sort: Step) -> DataFrame:
    """Silver whose lines were dealt out and sorted by date before the wide
    rows were made (see ``layers.refresh_dates``)."""
    raw = order_columns(lines(spark, sf_dir), by_date(deal, sort), keep=["order_date"])
    # The date of the sort is the one that is kept, so that the writer knows the order of the rows.
    silver = clean_orders(raw.withColumnRenamed("order_date", "_date"))
    return silver.withColumn("order_date", F.col("_date")).drop("_date")


def gold_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold features, derived where they are read."""
    return as_stored(gold_features(silver_orders(spark, sf_dir)))


def gold_table(spark: SparkSession, sf_dir: str, since: str | None = None) -> DataFrame:
    """Gold features, stored by month; ``since``: orders from that time on."""
    def build() -> DataFrame:
        silver = clean_orders(order_columns(lines(spark, sf_dir), lambda df: by_month(df, "order_timestamp"), keep=[MONTH]))
        return gold_features(silver, keep=[MONTH])

    return layer(spark, sf_dir, "gold", build, month_of="order_timestamp", since=since, arranged=True).select(*GOLD_COLUMNS)


def training_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_stored(training_features(silver_orders(spark, sf_dir)))
