"""The narrow order lines: marks of first lines, wide rows derived late, joins of narrow rows."""

import datetime as dt
import os
import re

from pyspark.sql import functions as F

from shipcast.operators.clean import MARK, dedupe_orders
from shipcast.plans import catalog, medallion
from shipcast.sources import layers, orders, sinks
from shipcast.sources.orders import LINE_COLUMNS, RAW_COLUMNS, mark_lines, order_columns, with_order_id

SCHEMA = ("l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, o_orderdate timestamp_ntz, "
          "c_custkey long, c_name string, c_mktsegment string, n_name string, r_name string, p_name string, p_type string, p_size int")


def _line(ok=1, pk=7, sk=3, ln=1, qty=5.0, price=10.0, day=1, ck=11, name="n", size=9):
    date = None if day is None else dt.datetime(1999, 1, day)
    return (ok, pk, sk, ln, qty, price, date, ck, name, "M", "FRANCE", "EUROPE", "p", "T", size)


ROWS = [
    _line(day=2), _line(day=1),                                     # the earlier comes first
    _line(ok=2, pk=9), _line(ok=2, pk=10),                          # products are ordered as text
    _line(ok=3, ck=50, name="b"), _line(ok=3, ck=49, name="a"),     # a tie that only the wide rows decide
    _line(ok=4), _line(ok=4), _line(ok=4),                          # copies
    _line(ok=5, ln=None), _line(ok=6, ln=None, price=1.0),          # no id: one group
    _line(ok=7, day=None), _line(ok=7),                             # no time comes first
    _line(ok=8, sk=3), _line(ok=8, sk=23),                          # the same centre and carrier, another route
    _line(ok=9, price=None), _line(ok=9, price=float("nan")), _line(ok=10),
]


def _sorted(df):
    return sorted(tuple(map(repr, r)) for r in df.select(*RAW_COLUMNS).collect())


def test_marks_keep_what_the_aggregate_keeps(spark):
    lines = spark.createDataFrame(ROWS, SCHEMA)
    marked = mark_lines(lines).cache()
    assert _sorted(dedupe_orders(marked, derive=order_columns)) == _sorted(dedupe_orders(order_columns(lines)))
    marks = {(r["l_orderkey"], r["c_custkey"], r["l_suppkey"]): r[MARK] for r in marked.where("l_orderkey in (3, 8, 10)").collect()}
    assert marks == {(3, 50, 3): 2, (3, 49, 3): 2, (8, 11, 3): 2, (8, 11, 23): 2, (10, 11, 3): 1}
    assert marked.where(f"{MARK} = 1 and l_orderkey = 4").count() == 1 and marked.count() == len(ROWS)


def test_sinks_join_narrow_rows(spark):
    lines = spark.createDataFrame(ROWS, SCHEMA)
    held = spark.createDataFrame([("1-1",), ("10-1",)], "order_id string")
    wide = order_columns(lines)
    new = sinks.new_rows(with_order_id(mark_lines(lines)), held, "order_id", order_columns)
    assert _sorted(new) == _sorted(sinks.new_rows(wide, held))
    ops = with_order_id(mark_lines(lines).where(f"{MARK} = 1"))
    assert _sorted(sinks.backfill_rows(ops, held, derive=order_columns)) == _sorted(sinks.backfill_rows(order_columns(ops), held))


def test_arranged_rows_are_the_same(spark, tmp_path):
    lines = spark.createDataFrame(ROWS, SCHEMA)
    plain = _sorted(order_columns(lines))
    assert _sorted(order_columns(lines, layers.by_time)) == plain
    by_month = order_columns(lines, lambda df: layers.by_month(df, "order_timestamp"), keep=[layers.MONTH])
    layers.refresh_layer(by_month, str(tmp_path / "t"), month_of="order_timestamp", arranged=True)
    assert _sorted(spark.read.parquet(str(tmp_path / "t"))) == plain


def _exchanged(df):
    """The columns that shuffles and sorts of the final plan carry, at most."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    wide = plan.toString().split("+- == Initial Plan ==")[0]
    return re.findall(r"SortAggregate|Exchange hashpartitioning\(order_id", wide)


def test_wide_rows_are_neither_stored_nor_shuffled(spark, sf_small):
    stored = spark.read.parquet(medallion.lines(spark, sf_small).inputFiles()[0])
    assert set(stored.columns) == {*LINE_COLUMNS, MARK}
    for df in (catalog.ops_orders(spark, sf_small), catalog.q_dedupe_orders(spark, sf_small), medallion.training_table(spark, sf_small)):
        assert not _exchanged(df)
        assert df.columns == RAW_COLUMNS or all(f.nullable for f in df.schema.fields)
        files = {f.rsplit("/", 2)[1].rsplit("-", 1)[0] for f in df.inputFiles()}
        assert files == {"lines"}


def test_refreshed_layers_equal_derived_rows(spark, sf_small):
    silver = medallion.silver_table(spark, sf_small)
    own = medallion.silver_orders(spark, sf_small)
    assert silver.columns == own.columns and silver.exceptAll(own).isEmpty() and silver.count() == own.count()
    gold, derived = medallion.gold_table(spark, sf_small), medallion.gold_orders(spark, sf_small)
    assert gold.columns == derived.columns and gold.count() == derived.count()
    assert sorted(r[0] for r in gold.select("order_id").collect()) == sorted(r[0] for r in derived.select("order_id").collect())
    assert "zstd" in gold.inputFiles()[0]
    times = spark.read.parquet(silver.inputFiles()[0]).select(F.col("order_timestamp")).collect()
    assert times == sorted(times)


def test_lines_are_sorted_by_tasks_of_bounded_size(spark, sf_small, monkeypatch):
    monkeypatch.setattr(orders, "TASK_LINES", 200)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables that are large
    try:
        sizes = orders.joined_lines(spark, sf_small).groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    rows = sum(r["count"] for r in sizes)
    assert rows == medallion.lines(spark, sf_small).count()
    assert len(sizes) > rows / 200 / 2 and max(r["count"] for r in sizes) < 3 * 200


def test_slices_are_inserted_by_narrow_rows(spark, tmp_path):
    lines = spark.createDataFrame(ROWS, SCHEMA)
    wide, narrow = str(tmp_path / "wide"), str(tmp_path / "narrow")
    slices = ["o_orderdate < timestamp_ntz '1999-01-02' or o_orderdate is null", "o_orderdate >= timestamp_ntz '1999-01-02'", "true"]
    for part in (lines.where(c) for c in slices):
        own = with_order_id(mark_lines(orders.dealt(part, len(ROWS))))
        grown = sinks.insert_through_index(order_columns(part), wide)
        assert sinks.insert_through_index(own, narrow, derive=order_columns) == grown
        assert _sorted(spark.read.parquet(narrow)) == _sorted(spark.read.parquet(wide))
    assert grown == 1 and spark.read.parquet(narrow).where("order_id is null").count() == 2  # rows without an id are held by no index
    assert not os.listdir(tmp_path / "narrow_work")
