"""Medallion layers (S3, S4): raw → silver → gold, plus write helpers.

``refresh_layer`` writes a layer as Parquet, each task's output sorted by
order time and then by the reference's cluster keys (a local sort: no extra
exchange, no sampling pass). A layer that is read by time is written in
folders of a month (``month_of``): rows of a month are brought together by a
rebalance, which splits a month that is large, and a reader that asks for
rows from a time on (``since``) lists and reads only the folders it needs.
``partition_by_date=True`` gives folders of a day for stores where one day
holds many files' worth of data; on small inputs it would only produce many
tiny files.

``layer`` is the read side: when the session names a shared folder in
``spark.checkpoint.dir`` the layer is materialized there once, under a key
built from the input files and this package's source, and read back;
otherwise it is returned as the lazy plan. A writer fills a folder of its own
and then publishes it through a small pointer file; nothing that a reader may
hold is renamed or deleted, and a killed writer leaves no pointer. Folders of
older inputs or code are deleted by ``drop_old_layers`` only.
"""

from __future__ import annotations

import functools
import hashlib
import os
import re
import time
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from shipcast.session import checkpoint_dir

CLUSTER_KEYS = ["state", "carrier", "product_category", "delay_risk_label"]
_PKG_DIR = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
LAYERS = "shipcast-layers"
_MEMO: dict[tuple[str, str, str], DataFrame] = {}


def _fingerprint(spark: SparkSession, sf_dir: str) -> str:
    """Key of a layer: the input files as the store lists them (path, size,
    time of change in milliseconds) and this package's source."""
    h = hashlib.sha256()
    root, fs = hadoop_path(spark, sf_dir)
    root = fs.makeQualified(root)
    found, files = [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        found.append(f"{f.getPath()}:{f.getLen()}:{f.getModificationTime()}")
    h.update("\n".join([str(root), *sorted(found), _source_print()]).encode())
    return h.hexdigest()[:16]


@functools.cache
def _source_print() -> str:
    """Hash of this package's source, read once in a process: the code that
    runs is the code that was loaded."""
    h = hashlib.sha256()
    for root, _dirs, files in sorted(os.walk(_PKG_DIR)):
        for f in sorted(files):
            if f.endswith(".py"):
                with open(os.path.join(root, f), "rb") as fh:
                    h.update(fh.read())
    return h.hexdigest()


def hadoop_path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """The data files of a table, as paths below it (without ``_SUCCESS`` and
    other markers, which not every committer writes)."""
    p, fs = hadoop_path(spark, path)
    if not fs.exists(p):
        return []
    root, out = fs.makeQualified(p).toString(), []
    files = fs.listFiles(p, True)
    while files.hasNext():
        name = files.next().getPath().toString()[len(root):]
        if "/_" not in re.sub(r"/_\w+=", "/", name) and "/." not in name:
            out.append(name.lstrip("/"))
    return out


def has_files(spark: SparkSession, path: str) -> bool:
    """Whether a table has a data file."""
    return bool(data_files(spark, path))


MONTH = "_month"


def refresh_layer(df: DataFrame, path: str, partition_by_date: bool = False,
                  date_col: str = "order_date", time_col: str = "order_timestamp",
                  mode: str = "overwrite", month_of: str | None = None, arranged: bool = False) -> None:
    """Full refresh of a layer. ``arranged``: the rows come dealt out and
    sorted (``by_month`` or ``by_time``), so wide rows need no sort here.

    ``overwrite`` deletes the old files before the job writes; readers that
    must never see an empty table read layers through ``layer``, which
    publishes a finished folder."""
    cluster = [c for c in CLUSTER_KEYS if c in df.columns]
    if arranged:
        _written(df, mode, *([MONTH] if month_of else [])).parquet(path)
    elif partition_by_date and date_col in df.columns:
        # A rebalance keeps a date together but splits one that is large.
        out = df.hint("rebalance", date_col).sortWithinPartitions(date_col, *cluster)
        _written(out, mode, date_col).parquet(path)
    elif month_of:
        _written(by_month(df, month_of), mode, MONTH).parquet(path)
    elif time_col in df.columns:
        _written(by_time(df, time_col), mode).parquet(path)
    else:
        _written(df, mode).parquet(path)


def _written(df: DataFrame, mode: str, *folders: str) -> DataFrameWriter:
    out = df.write.mode(mode).option("compression", "zstd")
    return out.partitionBy(*folders) if folders else out


def by_time(df: DataFrame, time_col: str = "order_timestamp") -> DataFrame:
    """Each task's rows sorted by time and the cluster keys."""
    return df.sortWithinPartitions(time_col, *[c for c in CLUSTER_KEYS if c in df.columns])


def by_month(df: DataFrame, time_col: str) -> DataFrame:
    """Rows with their ``MONTH``, dealt out by it and sorted inside."""
    out = df.withColumn(MONTH, _month(F.col(time_col))).hint("rebalance", MONTH)
    return out.sortWithinPartitions(MONTH, time_col, *[c for c in CLUSTER_KEYS if c in df.columns])


def _date_prints(df: DataFrame, date_col: str) -> DataFrame:
    """(date, n, mark) of each date: its rows and the sum of their hashes."""
    mark = F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)"))
    return df.groupBy(F.col(date_col).alias("date")).agg(F.count("*").alias("n"), mark.alias("mark"))


Step = Callable[[DataFrame], DataFrame]


def refresh_dates(df: DataFrame, path: str, date_col: str = "order_date",
                  arranged: Callable[[Step, Step], DataFrame] | None = None) -> list[str]:
    """S4, incremental: bring the table at ``path``, in folders of a date and
    clustered inside, to the rows of ``df``; the dates that were rewritten.

    Only dates whose rows differ from those of the last refresh are written
    (dynamic partition overwrite), and folders of dates that have gone are
    deleted; other folders are not touched. A date differs if its number of
    rows or the sum of their hashes does. What the last refresh wrote is kept
    beside the table; if a writer dies before it is noted, the next refresh
    writes the same dates again. NULL dates have a folder of their own.

    Where wide rows are made from narrow ones, ``arranged(deal, sort)`` gives
    the rows of ``df``, having dealt out and sorted the narrow rows with these
    two steps, which find the date and the cluster keys there: wide rows are
    then neither shuffled nor sorted."""
    spark, state = df.sparkSession, f"{path.rstrip('/')}_dates"
    root, fs = hadoop_path(spark, f"{state}/states")
    versions = [int(f.getPath().getName()) for f in fs.listStatus(root) if f.getPath().getName().isdigit()] if fs.exists(root) else []
    last = max(versions, default=0)
    prints = f"prints-{uuid.uuid4().hex}"
    _date_prints(df, date_col).write.parquet(f"{state}/{prints}")
    now = spark.read.parquet(f"{state}/{prints}")
    before = spark.read.parquet(f"{state}/{published(spark, f'{state}/states/{last}')}") if last else now.where("false")
    pair = now.alias("a").join(before.alias("b"), F.col("a.date").eqNullSafe(F.col("b.date")), "full_outer")
    differs = ~F.col("a.n").eqNullSafe(F.col("b.n")) | ~F.col("a.mark").eqNullSafe(F.col("b.mark"))
    # One row for each date that differs: bounded by the calendar, not by the rows.
    changed = [(r["date"], r["stays"]) for r in pair.where(differs).select(F.coalesce("a.date", "b.date").alias("date"), F.col("a.n").isNotNull().alias("stays")).collect()]
    written = [d for d, stays in changed if stays]
    if written:
        wanted = F.col(date_col).isin([d for d in written if d is not None])
        if None in written:
            wanted = wanted | F.col(date_col).isNull()
        deal = lambda rows: rows.where(wanted).hint("rebalance", date_col)
        sort = lambda rows: rows.sortWithinPartitions(date_col, *[c for c in CLUSTER_KEYS if c in rows.columns])
        out = arranged(deal, sort) if arranged else sort(deal(df))
        _written(out, "overwrite", date_col).option("partitionOverwriteMode", "dynamic").parquet(path)
    for d, stays in changed:
        if not stays:
            folder, fs = hadoop_path(spark, f"{path.rstrip('/')}/{date_col}={'__HIVE_DEFAULT_PARTITION__' if d is None else d}")
            fs.delete(folder, True)
    publish(spark, prints, f"{state}/states/{last + 1}")
    return sorted(str(d) for d in written)


def _month(ts: Column) -> Column:
    """Months since year 0 (NULL times have a folder of their own)."""
    return (F.year(ts) * 12 + F.month(ts) - 1).cast("int")


def published(spark: SparkSession, pointer: str) -> str | None:
    """What the pointer file says, None if there is none."""
    path, fs = hadoop_path(spark, pointer)
    if not fs.exists(path):
        return None
    read = fs.open(path)
    try:
        return read.readUTF()
    finally:
        read.close()


def publish(spark: SparkSession, folder: str, pointer: str) -> None:
    """Make the pointer name ``folder``. The pointer is written aside and
    renamed; of two writers either wins, both folders are whole. A rename is
    atomic on HDFS and local disks; an object store needs a file system that
    renames one small file atomically."""
    aside, fs = hadoop_path(spark, f"{pointer}.{uuid.uuid4().hex[:8]}")
    out = fs.create(aside, False)
    out.writeUTF(folder)
    out.close()
    if not fs.rename(aside, hadoop_path(spark, pointer)[0]):
        fs.delete(aside, False)  # the pointer is there already
        if published(spark, pointer) is None:
            raise OSError(f"cannot publish {pointer}")


def layer(spark: SparkSession, sf_dir: str, name: str, build: Callable[[], DataFrame],
          month_of: str | None = None, since: str | None = None, arranged: bool = False) -> DataFrame:
    """The layer ``name``. With ``month_of`` (a time column) it is stored in
    folders of a month; ``since`` then gives the rows from that time on."""
    wanted = F.col(month_of) >= F.lit(since).cast("timestamp_ntz") if since else None
    # memo per running application and input state: frames of a stopped session or of older input are never reused
    mark = _fingerprint(spark, sf_dir)
    key = (spark.sparkContext.applicationId, mark, name)
    if key not in _MEMO:
        base = checkpoint_dir(spark)
        if not base:
            return (build() if since is None else build().where(wanted)).drop(MONTH)
        pointer = f"{base.rstrip('/')}/{LAYERS}/{mark}/{name}.current"
        folder = published(spark, pointer)
        if folder is None:
            folder = f"{base.rstrip('/')}/{LAYERS}/{mark}/{name}-{uuid.uuid4().hex[:8]}"
            refresh_layer(build(), folder, month_of=month_of, arranged=arranged)
            publish(spark, folder, pointer)
            folder = published(spark, pointer)
        _MEMO[key] = spark.read.parquet(folder)
    df = _MEMO[key]
    if since is not None:
        df = df.where((F.col(MONTH) >= _month(F.lit(since).cast("timestamp_ntz"))) & wanted)
    return df.drop(MONTH)


def drop_old_layers(spark: SparkSession, sf_dir: str, older_than_hours: float) -> int:
    """Delete the layers of other inputs or code states that were not written
    for ``older_than_hours``; the number of states deleted. For a clean-up
    job: a running query of an older state would lose its files."""
    base = checkpoint_dir(spark)
    root, fs = hadoop_path(spark, f"{base.rstrip('/')}/{LAYERS}")
    if not fs.exists(root):
        return 0
    mark, gone = _fingerprint(spark, sf_dir), 0
    edge = (time.time() - older_than_hours * 3600) * 1000
    for state in fs.listStatus(root):
        if state.getPath().getName() != mark and state.getModificationTime() < edge:
            gone += bool(fs.delete(state.getPath(), True))
    return gone


def as_stored(df: DataFrame) -> DataFrame:
    """Rows derived where they are read, with the schema of a stored table:
    every column may be NULL."""
    return df.select(*[F.col(f.name) if f.nullable else F.nullif(F.col(f.name), F.lit(None).cast(f.dataType)).alias(f.name) for f in df.schema.fields])


def write_layer(df: DataFrame, path: str, mode: str = "overwrite") -> DataFrame:
    """S3: write a step's output as Parquet and return the re-read frame,
    which also cuts the lineage for the next step."""
    df.write.mode(mode).parquet(path)
    return df.sparkSession.read.parquet(path)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Chunked append to a table; Spark's tasks are the chunks."""
    df.write.mode("append").format(fmt).save(path)


def align_schema(df: DataFrame, target_schema) -> DataFrame:
    """Additive migration. Columns of ``target_schema`` missing from
    ``df`` are added as typed NULLs; order follows the target, and extra
    columns of ``df`` are appended (nothing is dropped)."""
    have = set(df.columns)
    cols = []
    for f in target_schema.fields:
        cols.append(F.col(f.name).cast(f.dataType).alias(f.name) if f.name in have
                    else F.lit(None).cast(f.dataType).alias(f.name))
    target_names = {f.name for f in target_schema.fields}
    cols += [F.col(c) for c in df.columns if c not in target_names]
    return df.select(*cols)
