"""Budget-event decoding and breach filter.

Works on batch and streaming DataFrames alike: the message column holds
base64 text of a JSON document with costAmount and budgetAmount.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BUDGET_SCHEMA = "costAmount double, budgetAmount double"


def encode_budget_events(events: DataFrame, budget_amount: float) -> DataFrame:
    """Wrap each event as a budget message: base64(JSON{costAmount, budgetAmount})."""
    body = F.to_json(F.struct(F.col("value").alias("costAmount"),
                              F.lit(float(budget_amount)).alias("budgetAmount")))
    return events.select("event_id", "ts", F.base64(F.encode(body, "UTF-8")).alias("message"))


def decode_budget(messages: DataFrame, column: str = "message") -> DataFrame:
    """from_json(unbase64(message))."""
    doc = F.from_json(F.decode(F.unbase64(F.col(column)), "UTF-8"), BUDGET_SCHEMA)
    return messages.withColumn("_b", doc).select(
        *[c for c in messages.columns if c != column],
        F.coalesce(F.col("_b.costAmount"), F.lit(0.0)).alias("cost_amount"),
        F.coalesce(F.col("_b.budgetAmount"), F.lit(0.0)).alias("budget_amount"))


def budget_breaches(messages: DataFrame, baseline: float = 0.0, ratio: float = 1.0) -> DataFrame:
    """keep messages with budget ≠ 0 and max(0, cost − baseline) ≥
    budget · ratio."""
    d = decode_budget(messages)
    inc = F.greatest(F.lit(0.0), F.col("cost_amount") - F.lit(float(baseline)))
    stop = F.col("budget_amount") * F.lit(float(ratio))
    return (d.where((F.col("budget_amount") != 0) & (inc >= stop))
             .select("event_id", "ts", "cost_amount", inc.alias("incremental_cost"), stop.alias("stop_at")))


def stream_budget_breaches(spark, source_dir: str, schema, sink_path: str, checkpoint: str,
                           baseline: float = 0.0, ratio: float = 1.0):
    """Budget messages arriving as files (column ``message``) → breach
    rows appended to ``sink_path``. Stateless, so the file sink's commit log
    makes it exactly-once."""
    src = spark.readStream.schema(schema).format("parquet").load(source_dir)
    return (budget_breaches(src, baseline, ratio).writeStream.format("parquet")
            .option("checkpointLocation", checkpoint).option("path", sink_path)
            .trigger(availableNow=True).start())
