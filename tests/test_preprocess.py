"""Exact preprocessing, seeded permutations without one window, deep pages."""

import statistics

import pytest
from pyspark.sql import functions as F

from shipcast.operators import preprocess as PP
from shipcast.operators.metrics import latest_orders
from shipcast.operators.ordered import aligned_places, hash_places
from shipcast.plans.training import importance_of, permuted


def _rows():
    nan = float("nan")
    a = [3.0, None, 1.0, 8.0, nan, 5.0, 2.0, 8.0]
    b = [7, 7, None, 7, 7, 7, 7, 7]
    t = ["x", None, "y", "x", "y", "z", None, "w"]
    return [(k, a[k], b[k], t[k], None, None) for k in range(8)]


SCHEMA = "id long, a double, b int, t string, empty double, none string"


@pytest.mark.parametrize("centre", [False, True])
def test_exact_preprocessing(spark, centre):
    df = spark.createDataFrame(_rows(), SCHEMA)
    own = PP.fit(df, ["a", "b", "empty"], ["t", "none"], centre=centre)
    known = [x for _, x, *_ in _rows() if x is not None and x == x]
    med = statistics.median(known)
    filled = [x if x is not None and x == x else med for _, x, *_ in _rows()]
    mean, scale = statistics.fmean(filled), statistics.pstdev(filled)
    assert own.numbers["a"] == pytest.approx((med, mean, scale)) and own.numbers["b"] == (7.0, 7.0, 1.0) and own.numbers["empty"] == (0.0, 0.0, 1.0)
    assert own.texts == {"t": ("x", ["w", "x", "y", "z"]), "none": (None, [])}
    other = df.unionByName(spark.createDataFrame([(8, None, None, "never seen", 4.0, "q")], SCHEMA))
    again = PP.Preprocessing.from_table(own.table(spark), centre)
    assert again == own
    got = {r["id"]: r for r in again.apply(other, ["id"]).collect()}
    for k, x in enumerate(filled):
        assert got[k]["a_scaled"] == pytest.approx((x - mean * centre) / scale)
    assert [got[k]["t_code"] for k in range(9)] == [1, 1, 2, 1, 2, 3, 1, 0, -1] and got[8]["none_code"] == -1
    assert got[8]["features"][3:] == [0.0] * 4 and got[5]["features"][3:] == [0.0, 0.0, 0.0, 1.0] and len(got[0]["features"]) == 7
    plan = again.apply(other, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Python" not in plan


def test_too_many_categories_are_refused(spark):
    df = spark.range(30).select(F.col("id").cast("string").alias("t"))
    with pytest.raises(ValueError, match=r"more than 29 categories: \['t'\]"):
        PP.fit(df, [], ["t"], max_categories=29)
    assert len(PP.fit(df, [], ["t"], max_categories=30).texts["t"][1]) == 30
    empty = PP.fit(df.where("false"), [], ["t"])
    assert empty.texts == {"t": (None, [])} and empty.apply(df, []).first()["features"] == []


def test_places_without_one_window(spark):
    df = spark.range(5000).select(F.col("id").alias("key"), (F.col("id") % 3).alias("g"))
    got = hash_places(df, F.md5(F.col("key").cast("string")), "place", ["g"])
    by = {}
    for r in got.orderBy("g", "place").withColumn("h", F.md5(F.col("key").cast("string"))).collect():
        by.setdefault(r["g"], []).append((r["place"], r["h"]))
    for own in by.values():
        assert [p for p, _ in own] == list(range(1, len(own) + 1)) and [h for _, h in own] == sorted(h for _, h in own)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window [row_number" in plan and "SinglePartition" not in plan


def test_permutations_and_importance(spark):
    df = spark.range(900).select(F.col("id").cast("string").alias("order_id"), (F.col("id") % 2).alias("y"), F.col("id").alias("noise"), ((F.col("id") % 2) * 10 + F.col("id") % 7).alias("signal"))
    out = permuted(df, ["signal", "noise"], "order_id", 2, 5).persist()
    assert out.count() == 900 * 4
    orders = set()
    for f in ("signal", "noise"):
        for r in range(2):
            rows = out.where((F.col("_f") == f) & (F.col("_r") == r)).orderBy(F.col("order_id").cast("int")).collect()
            assert sorted(x[f] for x in rows) == sorted(x[f] for x in df.collect())
            other = "noise" if f == "signal" else "signal"
            assert [x[other] for x in rows] == [x[other] for x in df.collect()]
            orders.add(tuple(x[f] for x in rows))
    assert len(orders) == 4
    same = permuted(df.repartition(7), ["signal", "noise"], "order_id", 2, 5)
    assert out.exceptAll(same).isEmpty() and same.exceptAll(out).isEmpty()
    imp = {r["feature"]: r for r in importance_of(df, lambda d: d.withColumn("score", F.col("signal").cast("double")), ["signal", "noise"], "y", repeats=3).collect()}
    assert imp["signal"]["importance_mean"] > 0.3 and imp["noise"]["importance_mean"] == 0.0


def test_aligned_places(spark):
    n = 700
    df = spark.range(n * 3).select((F.col("id") % n).alias("key"), F.floor(F.col("id") / n).cast("int").alias("kind"))
    hexes = F.md5(F.concat_ws("|", F.col("key").cast("string"), F.col("kind").cast("string")))
    got = aligned_places(df.withColumn("hex", hexes), "hex", "kind", 3, n, ["key"]).withColumn("hex", hexes).withColumn("task", F.spark_partition_id()).collect()
    for kind in range(3):
        own = sorted((r for r in got if r["kind"] == kind), key=lambda r: r["hex"])
        assert [r["_place"] for r in own] == list(range(n))
    assert len({r["_stretch"] for r in got}) > 1
    assert len({(r["_place"], r["_stretch"], r["task"]) for r in got}) == n  # all kinds of a place lie together


def test_permuted_values_against_sorting(spark):
    import hashlib

    md5 = lambda *parts: hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()
    rows = [(f"k{i}", None if i % 11 == 0 else f"w{i % 4}", f"text {i}", None if i % 13 == 0 else i / 7, i % 5) for i in range(1300)]
    df = spark.createDataFrame(rows, "order_id string, few string, many string, x double, own long")
    features = ["few", "many", "x"]  # ``many`` has too many values to travel as numbers
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    old = spark.conf.get(threshold)
    spark.conf.set(threshold, -1)
    try:
        out = permuted(df, features, "order_id", 2, 7)
        plan = out._jdf.queryExecution().executedPlan().toString()
        got = {(r["_f"], r["_r"], r["order_id"]): r for r in out.collect()}
    finally:
        spark.conf.set(threshold, old)
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan  # places are not joined
    assert out.columns == ["order_id", "own", *features, "_f", "_r"] and len(got) == len(rows) * 6
    by = sorted(rows, key=lambda r: md5(r[0], 7))
    for i, f in enumerate(features, 1):
        for r in range(2):
            for to, of in zip(by, sorted(rows, key=lambda x: md5(x[0], 7, f, r)), strict=True):
                want = [*to[:i], of[i], *to[i + 1:]]
                row = got[f, r, to[0]]
                assert [row[c] for c in df.columns] == want


def test_deep_pages(spark, monkeypatch):
    from shipcast.operators import metrics

    monkeypatch.setattr(metrics, "TOP_ROWS", 50)
    ts = F.when(F.col("id") % 50 != 0, F.timestamp_add("SECOND", (F.col("id") * 7919 % 4000) * 40_000, F.lit("1999-01-01").cast("timestamp_ntz")).cast("timestamp_ntz"))
    df = spark.range(4000).select(F.col("id").cast("string").alias("order_id"), ts.alias("order_timestamp")).persist()
    whole = [r["order_id"] for r in df.orderBy(F.col("order_timestamp").desc(), "order_id").collect()]
    for offset in (0, 10, 45, 777, 3905, 3919, 3920, 3950, 3999, 4000, 9000):
        page = latest_orders(df, 30, offset)
        assert [r["order_id"] for r in page.collect()] == whole[offset:offset + 30], offset
    hot = df.withColumn("order_timestamp", F.lit("2001-01-01").cast("timestamp_ntz"))
    assert [r["order_id"] for r in latest_orders(hot, 5, 2000).collect()] == sorted(whole)[2000:2005]
