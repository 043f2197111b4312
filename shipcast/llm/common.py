"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shipcast.session import ensure_checkpoint_dir

#: ASCII white space as the contracts define it: space and U+0009 to U+000D.
SPACE = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A key is heavy when it holds at least one of so many rows; so there are
#: at most this many heavy keys, whatever the input.
HEAVY_SHARE = 1000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{label}-{uuid.uuid4().hex}"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read back: computed
    once, with no lineage, and safe when an executor is lost."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def removed(df: DataFrame) -> None:
    """Delete the files of a table made by ``saved``."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, UPPER, LOWER)


def skew_join(rows: DataFrame, keyed: DataFrame, key: str, count: str, total: int, how: str = "inner") -> DataFrame:
    """Join ``rows`` (any number for each key) with ``keyed`` (one for each
    key; ``count`` is the number of ``rows`` with it, of ``total``).

    Heavy keys, at most ``HEAVY_SHARE`` of them because their counts add up
    to no more than ``total``, are broadcast; all other keys are shuffled and
    hold less than a thousandth of the rows each. ``how`` is inner or left;
    null keys match nothing and are not shuffled."""
    heavy_now = F.col(count) * F.lit(HEAVY_SHARE) >= F.lit(int(total))
    payload = [c for c in keyed.columns if c not in (key, count)]
    heavy = F.broadcast(keyed.where(heavy_now).select(key, *payload))
    light = keyed.where(~heavy_now).select(key, *payload)
    parts = [rows.join(heavy, key, "inner"),
             rows.where(F.col(key).isNotNull()).join(heavy.select(key), key, "left_anti").join(light, key, how)]
    if how == "left":
        parts.append(rows.where(F.col(key).isNull()).select("*", *[F.lit(None).cast(keyed.schema[c].dataType).alias(c) for c in payload]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
