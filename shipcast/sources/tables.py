"""Readers for the input tables and a size-checked broadcast helper."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one input table; pass ``columns`` so the scan's ReadSchema is pruned
    at the source (Catalyst would prune anyway, this documents intent)."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Broadcast ``df`` only after proving it has at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows. Beyond the bound the frame
    is returned unhinted, so Catalyst / AQE pick a shuffle join instead.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
