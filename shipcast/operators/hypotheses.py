"""Business hypothesis tests H1–H10 (A10, P16, F23) in one scan.

One aggregate with the grouping sets () and (feature of H10) holds every
counter. H1–H9 and the overall rate come from its total row; H10 picks the
group with the highest rate among those with at least max(100, 0.001·n) rows
(ties: first in name order). At most 1,000 groups can hold a thousandth of
the rows, so the total row and the 1,000 largest groups decide, whatever the
number of groups. An empty candidate set gives INCONCLUSIVE instead of an
error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shipcast import constants as K

OUTPUT = ["id", "hypothesis", "feature", "condition", "segment_count", "segment_rate", "overall_rate", "lift",
          "verdict", "business_insight"]


def _mask(feature: str, cond: str) -> Column:
    if cond == "positive":
        return F.col(feature) > 0
    return F.col(feature).cast("string") == F.lit(cond)


def hypothesis_tests(df: DataFrame, target: str = "delay_risk_label") -> DataFrame:
    y = F.col(target).cast("double")
    top_id, _stmt, top, _cond = next(h for h in K.HYPOTHESES if h[3] == "top_vs_overall")
    simple = [h for h in K.HYPOTHESES if h[0] != top_id and h[2] in df.columns]
    counters = {"_n": F.count(F.lit(1)), "_s": F.sum(y), "_m": F.count(y)}
    for hid, _stmt, feat, cond in simple:
        m = _mask(feat, cond)
        counters |= {f"n_{hid}": F.count_if(m), f"s_{hid}": F.sum(F.when(m, y))}
    by = F.col(top).cast("string") if top in df.columns else F.lit(None).cast("string")
    named = df.withColumn("_v", by)
    sets = (named.groupingSets([[], [F.col("_v")]], F.col("_v"))
            .agg(F.grouping_id("_v").alias("_total"), *[c.alias(n) for n, c in counters.items()]))
    decisive = sets.orderBy(F.col("_total").desc(), F.col("_n").desc()).limit(1 + round(1 / K.H10_MIN_SHARE))
    total = F.max_by(F.struct(*counters), F.col("_total"))
    rate = F.when(F.col("_m") > 0, F.col("_s") / F.col("_m"))
    group = F.when((F.col("_total") == 0) & rate.isNotNull(), F.struct(
        (-rate).alias("o"), F.col("_v").isNull().alias("last"), F.col("_v").alias("v"), F.col("_n").alias("cnt"), rate.alias("rate")))
    one = decisive.agg(total.alias("t"), F.collect_list(group).alias("groups")).select("t.*", "groups")
    one = one.withColumns({n: F.coalesce(n, F.lit(0)) for n in counters if n.startswith(("_n", "n_"))})
    enough = F.greatest(F.lit(float(K.H10_MIN_GROUP)), F.col("_n") * F.lit(K.H10_MIN_SHARE))
    one = one.withColumn("_top", F.array_min(F.filter("groups", lambda g: g["cnt"] >= enough)))

    none = F.lit(None).cast("string"), F.lit(None).cast("long"), F.lit(None).cast("double")
    rows = []
    for hid, stmt, feat, cond in K.HYPOTHESES:
        if feat not in df.columns:
            rows.append((hid, stmt, feat, *none))
        elif hid == top_id:
            t = F.col("_top")
            rows.append((hid, stmt, feat, t["v"], F.coalesce(t["cnt"], F.lit(0)), t["rate"]))
        else:
            n = F.col(f"n_{hid}")
            rows.append((hid, stmt, feat, F.lit(cond), n, F.when(n > 0, F.col(f"s_{hid}") / n)))
    base = one.select("_n", "_s", F.explode(F.array(*[
        F.struct(F.lit(hid).alias("id"), F.lit(stmt).alias("hypothesis"), F.lit(feat).alias("feature"),
                 c.alias("condition"), n.cast("long").alias("segment_count"), r.cast("double").alias("segment_rate"))
        for hid, stmt, feat, c, n, r in rows])).alias("h")).select("_n", "_s", "h.*")

    overall = F.when(F.col("_n") > 0, F.col("_s") / F.col("_n"))
    cnt, rate = F.col("segment_count"), F.col("segment_rate")
    lift = F.when((overall != 0) & (cnt > 0), rate / overall)
    verdict = (F.when((cnt >= K.HYPOTHESIS_MIN_COUNT) & (lift >= K.HYPOTHESIS_MIN_LIFT) & (rate > overall), "TRUE")
               .when(cnt >= K.HYPOTHESIS_MIN_COUNT, "FALSE").otherwise("INCONCLUSIVE"))
    insight = F.when(lift.isNotNull(), F.format_string(
        "Orders matching %s=%s have %.2fx the average delay rate.", F.col("feature"), F.col("condition"), lift)
    ).when(~F.col("feature").isin([c for c in df.columns]), F.format_string("Column %s not found.", F.col("feature"))
    ).otherwise(F.lit("Insufficient sample."))
    return base.select("id", "hypothesis", "feature", "condition", "segment_count", "segment_rate",
                       overall.alias("overall_rate"), lift.alias("lift"), verdict.alias("verdict"),
                       insight.alias("business_insight"))
