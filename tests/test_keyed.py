"""The key index of a table, resumable backfill, incremental refresh by date
and the operational store scan."""

import os
import sqlite3

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from shipcast.operators.clean import dedupe_orders
from shipcast.plans.medallion import raw_orders, silver_by_date, silver_orders
from shipcast.sources import sinks
from shipcast.sources.keyed import KeyIndex, spots
from shipcast.sources.layers import CLUSTER_KEYS, data_files, refresh_dates
from shipcast.sources.operational import condition, operational_orders, quoted


def _ids(df):
    return sorted(r[0] for r in df.select("order_id").collect())


# -- key index ---------------------------------------------------------------------

def test_small_batches_open_few_buckets(spark, tmp_path):
    store = str(tmp_path / "store")
    stored = spark.range(40_000).select(F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"), F.lit("x" * 50).alias("rest"))
    stored.repartition(4).write.parquet(store)
    index = KeyIndex(spark, store, bucket_keys=200)
    index.sync()
    _, buckets, folders = index._state()
    assert buckets == 200 and len(folders) == 1
    new = spark.range(100_000, 100_040).select(F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"))
    assert index.known(new).collect() == []
    assert len(index.touched) <= 40 and len(index.opened) <= 5  # a filter seldom holds a new key
    old = spark.range(7, 17).select(F.concat(F.lit("ORD-"), F.col("id")).alias("order_id"))
    found = index.known(old.unionByName(new).unionByName(old))
    assert _ids(found) == _ids(old)
    assert 5 <= len(index.opened) <= 15
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan and "rest" not in plan  # nothing but buckets of keys is read
    missing = index.missing(old.unionByName(new).withColumn("n", F.lit(1)))
    assert _ids(missing) == _ids(new) and missing.columns == ["order_id", "n"]


def test_the_index_follows_the_table(spark, tmp_path):
    store = str(tmp_path / "store")
    index = KeyIndex(spark, store, bucket_keys=50)
    rows = lambda a, b: spark.range(a, b).select(F.col("id").cast("string").alias("order_id"))
    index.sync()
    assert index.known(rows(0, 5)).collect() == []
    for k in range(20):  # more than PARTS: merged on the way
        rows(30 * k, 30 * k + 40).write.mode("append").parquet(store)
        index.sync()
        assert _ids(index.known(rows(0, 2000))) == sorted(str(i) for i in range(30 * k + 40))
    _, _, folders = index._state()
    assert len(folders) <= 17 and index.drop_old_states() > 0 and index.known(rows(0, 2000)).count() == 610
    # an index of another writer, and one that skips what is being retried
    assert KeyIndex(spark, store).known(rows(600, 620)).count() == 10
    spark.range(900, 901).select(F.col("id").cast("string").alias("order_id"), F.lit("a").alias("_stream"), F.lit(3).alias("_epoch")).write.partitionBy("_stream", "_epoch").parquet(str(tmp_path / "parts"))
    part = KeyIndex(spark, str(tmp_path / "parts"))
    part.sync(skip="_stream=a/_epoch=3/")
    assert part.known(rows(900, 901)).collect() == []
    part.sync()
    assert part.known(rows(900, 901)).count() == 1


def test_null_keys_and_filters(spark, tmp_path):
    store = str(tmp_path / "store")
    spark.createDataFrame([("a",), (None,), ("b",), ("b",)], "order_id string").write.parquet(store)
    index = KeyIndex(spark, store)
    index.sync()
    asked = spark.createDataFrame([("a", 1), (None, 2), ("c", 3)], "order_id string, n int")
    assert _ids(index.known(asked)) == ["a"] and sorted(r["n"] for r in index.missing(asked).collect()) == [2, 3]
    import numpy as np

    at = spots(np.arange(-5000, 5000), 1000)
    assert at.min() >= 0 and at.max() < 8000 and len(np.unique(at)) > 7500


def test_insert_through_the_index(spark, sf_small, tmp_path):
    raw = raw_orders(spark, sf_small)
    store = str(tmp_path / "store")
    first = sinks.insert_through_index(raw.where("order_timestamp < timestamp_ntz '1998-01-01'"), store)
    second = sinks.insert_through_index(raw, store)
    assert first > 0 and second > 0 and sinks.insert_through_index(raw, store) == 0
    assert _ids(spark.read.parquet(store)) == _ids(dedupe_orders(raw))


# -- resumable backfill --------------------------------------------------------------

def test_backfill_is_taken_up_again(spark, sf_small, tmp_path, monkeypatch):
    ops = dedupe_orders(raw_orders(spark, sf_small)).select("order_id", "order_timestamp", "order_value").persist()
    ops = ops.unionByName(spark.createDataFrame([("untimed", None, 1.0)], "order_id string, order_timestamp timestamp_ntz, order_value double"))
    whole, wh, progress = (str(tmp_path / n) for n in ("whole", "wh", "progress"))
    for path in (whole, wh):
        ops.where("xxhash64(order_id) % 2 = 0").write.parquet(path)
    n = sinks.backfill_in_ranges(ops, whole, str(tmp_path / "p0"), range_rows=200)
    assert n > 4 and _ids(spark.read.parquet(whole)) == _ids(ops)
    # the third range is appended, but its writer dies before it is noted
    real, noted = spark.createDataFrame, []

    def dying(rows, schema=None, **kw):
        if schema == sinks.PROGRESS:
            noted.append(rows)
            if len(noted) == 3:
                raise KeyboardInterrupt
        return real(rows, schema, **kw)

    monkeypatch.setattr(type(spark), "createDataFrame", lambda self, *a, **k: dying(*a, **k))
    with pytest.raises(KeyboardInterrupt):
        sinks.backfill_in_ranges(ops, wh, progress, range_rows=200)
    monkeypatch.undo()
    assert spark.read.parquet(progress).count() == 2
    assert sinks.backfill_in_ranges(ops, wh, progress, range_rows=200) == n - 3
    got = spark.read.parquet(wh)
    assert _ids(got) == _ids(ops) and got.count() == ops.count()
    assert spark.read.parquet(progress).agg(F.sum("rows")).first()[0] == ops.count() - ops.where("xxhash64(order_id) % 2 = 0").count() - noted[2][0][2]
    assert sinks.backfill_in_ranges(ops, wh, progress, range_rows=200) == 0


# -- refresh by date -----------------------------------------------------------------

def _folders(path):
    return {d: sorted((f, os.stat(os.path.join(path, d, f)).st_mtime_ns) for f in os.listdir(os.path.join(path, d)) if f.endswith(".parquet")) for d in os.listdir(path) if "=" in d}


def test_only_changed_dates_are_rewritten(spark, sf_small, tmp_path):
    path = str(tmp_path / "silver")
    silver = silver_orders(spark, sf_small).where("order_date >= '2001-06-01'").select("order_id", "order_date", "state", "carrier", "product_category", "delay_risk_label", "order_value").persist()
    assert len(refresh_dates(silver, path)) == silver.select("order_date").distinct().count()
    edited, dropped = (str(r[0]) for r in silver.select("order_date").distinct().orderBy("order_date").take(2))
    before = _folders(path)
    assert refresh_dates(silver, path) == [] and _folders(path) == before
    changed = silver.withColumn("order_value", F.when(F.col("order_date") == edited, F.col("order_value") + 1).otherwise(F.col("order_value"))).where(F.col("order_date") != dropped)
    changed = changed.unionByName(silver.limit(3).withColumn("order_date", F.lit(None).cast("date")))
    assert refresh_dates(changed, path) == [edited, "None"]
    after = _folders(path)
    assert set(before) - set(after) == {f"order_date={dropped}"}
    assert {d for d in after if after[d] != before.get(d)} == {f"order_date={edited}", "order_date=__HIVE_DEFAULT_PARTITION__"}
    rows = lambda df: sorted(map(str, df.select(*silver.columns).collect()))
    assert rows(spark.read.schema(silver.schema).parquet(path)) == rows(changed)


def test_dates_are_clustered_inside(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(60_000).select(F.expr("date '2001-01-01'").alias("order_date"), F.concat(F.lit("S"), F.col("id") % 50).alias("state"), F.lit("c").alias("carrier"), F.xxhash64("id").alias("pay"))
    size = "spark.hadoop.parquet.block.size"
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    old = hadoop.get("parquet.block.size")
    hadoop.set("parquet.block.size", str(64 * 1024))
    try:
        refresh_dates(df, path)
    finally:
        hadoop.unset("parquet.block.size") if old is None else hadoop.set("parquet.block.size", old)
    groups = hit = 0
    for f in data_files(spark, path):
        meta = pq.ParquetFile(os.path.join(path, f)).metadata
        at = [i for i in range(meta.num_columns) if meta.schema.column(i).name == "state"][0]
        for g in range(meta.num_row_groups):
            s = meta.row_group(g).column(at).statistics
            groups, hit = groups + 1, hit + (s.min <= "S7" <= s.max)
    assert groups >= 4 and hit <= groups // 2, size  # a filter on a cluster key skips row groups


def test_dates_are_refreshed_from_narrow_lines(spark, sf_small, tmp_path):
    silver, path, found = silver_orders(spark, sf_small), str(tmp_path / "t"), {}

    def arranged(deal, sort):
        def seen(step, name):
            return lambda rows: step(found.setdefault(name, rows))

        return silver_by_date(spark, sf_small, seen(deal, "dealt"), seen(sort, "sorted")).where("year(order_date) = 2001")

    wanted = silver.where("year(order_date) = 2001")
    dates = wanted.select("order_date").distinct().count()
    assert dates and len(refresh_dates(wanted, path, arranged=arranged)) == dates
    # Few columns are shuffled, and those that follow from others are made after it.
    assert len(found["dealt"].columns) < len(silver.columns) // 2 and not {"state", "carrier", "customer_email"} & {*found["dealt"].columns}
    assert {"order_date", *CLUSTER_KEYS} <= {*found["sorted"].columns}
    rows = lambda df: sorted(map(str, df.select(*silver.columns).collect()))
    assert rows(spark.read.schema(silver.schema).parquet(path)) == rows(wanted)
    for d in wanted.select("order_date").distinct().limit(3).collect():
        for f in sorted((tmp_path / "t" / f"order_date={d[0]}").glob("*.parquet")):
            keys = [tuple(x.values()) for x in pq.ParquetFile(f).read(columns=CLUSTER_KEYS).to_pylist()]
            assert keys == sorted(keys)
    assert refresh_dates(wanted, path, arranged=arranged) == []


# -- operational store ------------------------------------------------------------------

def test_operational_store_scan(spark, sf_small, tmp_path):
    names = ["order_id", "batch_id", "order_timestamp", "order_value", "carrier"]
    rows = [tuple(r) for r in dedupe_orders(raw_orders(spark, sf_small)).select("order_id", "batch_id", F.col("order_timestamp").cast("string"), "order_value", "carrier").collect()]
    rows += [("odd", None, None, None, "It's \"odd\"")]
    path = str(tmp_path / "my orders.db")
    con = sqlite3.connect(path)
    kind = "INTEGER" if isinstance(rows[0][1], int) else "TEXT"
    con.execute(f"CREATE TABLE orders (order_id TEXT PRIMARY KEY, batch_id {kind}, order_timestamp TEXT, order_value REAL, carrier TEXT)")
    con.executemany("INSERT OR IGNORE INTO orders VALUES (?, ?, ?, ?, ?)", rows)
    con.execute("DELETE FROM orders WHERE rowid % 7 = 3")
    con.execute("CREATE TABLE bare (x INTEGER, y)")
    con.commit()
    left = con.execute("SELECT * FROM orders").fetchall()
    got = operational_orders(spark, path, rowsPerPartition=500)
    assert got.columns == names and got.rdd.getNumPartitions() == -(-len(rows) // 500)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, left))
    some = got.where((F.col("order_value") > 900.0) & F.col("carrier").isin("X", left[0][4]) & F.col("order_timestamp").isNotNull())
    want = [r for r in left if r[3] is not None and r[3] > 900 and r[4] in ("X", left[0][4]) and r[2]]
    assert want and sorted(map(str, map(tuple, some.collect()))) == sorted(map(str, want))
    assert got.where(F.col("carrier") == "It's \"odd\"").count() == sum(r[0] == "odd" for r in left)
    newest = operational_orders(spark, path, limit=20).collect()
    assert [r["order_id"] for r in newest] == [r[0] for r in sorted((r for r in left if r[2]), key=lambda r: (r[2], [-ord(c) for c in r[0]]), reverse=True)[:20]]
    narrow = spark.read.format("sqlite").options(path=path, table="orders", partitions=3).schema("carrier string, order_id string").load()
    assert narrow.rdd.getNumPartitions() == 3 and sorted(tuple(r) for r in narrow.collect()) == sorted((r[4], r[0]) for r in left)
    assert operational_orders(spark, path, "bare").collect() == []
    with pytest.raises(Exception, match="no table"):
        operational_orders(spark, path, "absent").collect()


def test_filters_as_sql():
    from pyspark.sql import datasource as D
    from pyspark.sql import types as T

    types = {'a"b': T.StringType(), "n": T.LongType(), "t": T.DateType()}
    assert condition(D.EqualTo(('a"b',), "x'"), types) == ('"a""b" = ?', ["x'"]) and quoted('a"b') == '"a""b"'
    assert condition(D.In(("n",), (1, 2)), types) == ('"n" IN (?, ?)', [1, 2])
    assert condition(D.IsNull(("n",)), types) == ('"n" IS NULL', []) and condition(D.IsNotNull(("n",)), types) == ('"n" IS NOT NULL', [])
    for other in (D.EqualTo(("n",), "1"), D.EqualTo(("t",), 1), D.EqualTo(("z",), 1), D.EqualTo(("n", "m"), 1), D.StringContains(('a"b',), "x")):
        assert condition(other, types) is None
