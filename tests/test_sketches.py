"""Stored sketches by month against the exact profiles."""

import bisect

from pyspark.sql import functions as F

from shipcast.operators.quality import column_audit
from shipcast.operators.sketches import LG_K, RANK_ERROR, approx_profile, month_sketches, store_sketches
from shipcast.plans.medallion import silver_orders


def _within(profile, df):
    exact = {r["column_name"]: r for r in column_audit(df).collect()}
    found = {r["column_name"]: r for r in profile.collect()}
    n = df.count()
    assert set(found) == set(exact)
    for c, r in found.items():
        assert r["rows"] == n and abs(r["null_pct"] - exact[c]["null_pct"]) < 1e-9
        assert abs(r["nunique"] - exact[c]["nunique"]) <= max(1, 4 * 1.04 / 2 ** (LG_K / 2) * exact[c]["nunique"]), c
        values = sorted(v[0] for v in df.select(F.col(c).cast("double")).where(F.col(c).isNotNull()).collect()) if r["p50"] is not None else []
        for q in (25, 50, 75) if values else ():
            lo, hi = bisect.bisect_left(values, r[f"p{q}"]) / len(values), bisect.bisect_right(values, r[f"p{q}"]) / len(values)
            assert lo - 2 * RANK_ERROR <= q / 100 <= hi + 2 * RANK_ERROR, (c, q)
    return found


def test_profile_is_within_its_bounds(spark, sf_small):
    silver = silver_orders(spark, sf_small)
    found = _within(approx_profile(month_sketches(silver)), silver)
    assert found["order_value"]["p50"] > 0 and found["carrier"]["p50"] is None


def test_months_are_merged_and_replaced(spark, sf_small, tmp_path):
    path = str(tmp_path / "sketches")
    cols = ["order_id", "order_timestamp", "order_value", "state", "delay_risk_label"]
    silver = silver_orders(spark, sf_small).select(*cols)
    odd = silver.unionByName(spark.createDataFrame([("x", None, float("nan"), None, None)], silver.schema)).withColumn("empty", F.lit(None).cast("double"))
    store_sketches(month_sketches(odd.where("order_timestamp < timestamp_ntz '1998-01-01' or order_timestamp is null")), path)
    changed = odd.withColumn("order_value", F.col("order_value") * 2)
    store_sketches(month_sketches(changed.where("order_timestamp >= timestamp_ntz '1997-01-01'")), path)  # new months and a changed year
    whole = odd.where("order_timestamp < timestamp_ntz '1997-01-01' or order_timestamp is null").unionByName(changed.where("order_timestamp >= timestamp_ntz '1997-01-01'"))
    stored = spark.read.parquet(path)
    clean = whole.withColumn("order_value", F.nullif("order_value", F.lit(float("nan"))))
    got = {r["column_name"]: r for r in approx_profile(stored).collect()}
    assert got["empty"]["nunique"] == 0 and got["empty"]["p50"] is None and got["order_id"]["rows"] == whole.count()
    _within(approx_profile(stored.where("column_name not in ('order_value')")), clean.drop("order_value"))
    year = stored.where("month like '1997-%'")
    _within(approx_profile(year), clean.where("year(order_timestamp) = 1997"))
    assert stored.where("month = 'none'").count() == 6
    assert month_sketches(odd.where("false")).collect() == []
