"""Session helpers.

The library never creates sessions on its own inside operators; these helpers
are for tests, the bench and command-line jobs. On a cluster the session and
``spark.checkpoint.dir`` come from the cluster configuration.
"""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # The order-line and feature projections fuse ~40 derived columns into one
    # stage. Above 8000 bytes of bytecode the JVM never JIT-compiles a method
    # (DontCompileHugeMethods), so such a stage would run interpreted; with
    # the limit at 8000 Spark keeps per-operator codegen for it instead
    # (measured: raw order lines 30 s → 18 s cold, 9 s → 6 s warm at sf0.1).
    # Cluster sessions should carry the same setting.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "shipcast",
                  extra: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.setdefault("spark.driver.memory", os.environ.get("SHIPCAST_DRIVER_MEMORY", "16g"))
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def prefer_compiled(spark: SparkSession) -> None:
    """Let stages whose generated method the JVM would never compile run
    operator by operator (see ``DEFAULT_CONF``), in a session that has not
    chosen a limit itself: interpreted, a wide row takes twice the time."""
    name = "spark.sql.codegen.hugeMethodLimit"
    if not spark.sparkContext.getConf().contains(name) and spark.conf.get(name) == "65535":
        spark.conf.set(name, DEFAULT_CONF[name])


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names in ``spark.checkpoint.dir``, else
    the folder set on the context; None when neither is set."""
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    return configured or spark.sparkContext.getCheckpointDir()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Use the configured checkpoint folder; only when none is set and the
    master is local (tests, bench) point the context at a fresh scratch
    folder. On a cluster a machine's own folder would be lost to the others."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = sc.getConf().get("spark.checkpoint.dir", None)
        if not configured and not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="shipcast-ckpt-"))
    return checkpoint_dir(spark)
