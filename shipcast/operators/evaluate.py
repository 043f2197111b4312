"""Classifier evaluation on Spark.

Everything starts from one pre-aggregation: rows are grouped by distinct
score (and label), so curve work scales with the number of distinct scores,
not rows. Running totals use ``ordered.running_sum`` (no one-partition
window). ROC AUC is the tie-aware rank statistic; average precision is the
step sum Σ ΔRecall · Precision (not the trapezoid of ``areaUnderPR``).
Single-row aggregates are combined with a one-row key join (both sides have
exactly one row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shipcast import constants as K
from shipcast.operators.ordered import LINEAR, PER_E, running_sum

SCORE_SCALE = 10  # decimals kept when summing probabilities exactly


def _one_row_join(a: DataFrame, b: DataFrame) -> DataFrame:
    """Join two single-row aggregates (a proven 1x1 size)."""
    return a.withColumn("_k", F.lit(1)).join(F.broadcast(b.withColumn("_k", F.lit(1))), "_k").drop("_k")


def score_curve(df: DataFrame, label: str = "label", score: str = "score",
                group: list[str] | None = None) -> DataFrame:
    """Per distinct score (descending): pos, neg at the score and the
    cumulative tp / fp of the rule ``score >= s`` (per ``group`` if given)."""
    group = group or []
    agg = df.groupBy(*group, score).agg(
        F.sum(F.when(F.col(label) == 1, 1).otherwise(0)).cast("long").alias("pos"),
        F.sum(F.when(F.col(label) == 1, 0).otherwise(1)).cast("long").alias("neg"))
    cur = running_sum(agg, [F.col(score)], ["pos", "neg"], group=group, descending=True)
    return cur.select(*group, F.col(score).alias("score"), "pos", "neg",
                      F.col("pos_cum").alias("tp"), F.col("neg_cum").alias("fp"))


def curve_totals(curve: DataFrame, group: list[str]) -> DataFrame:
    """All positives and negatives of a curve: its last running sums. So read,
    a plan that also uses the curve needs no other columns here, and the work
    behind the curve is done once for both."""
    return curve.groupBy(*group).agg(F.max("tp").alias("P"), F.max("fp").alias("N"))


def auc_ap(curve: DataFrame, group: list[str] | None = None) -> DataFrame:
    """ROC AUC (ties count one half) and average precision from a curve;
    NULL when only one class is present."""
    group = group or []
    s = curve.groupBy(*group).agg(
        F.sum("pos").alias("P"), F.sum("neg").alias("N"),
        F.sum(F.col("pos") * (F.col("fp") - F.col("neg") * F.lit(0.5))).alias("_a"),
        F.sum(F.col("pos") * (F.col("tp") / (F.col("tp") + F.col("fp")))).alias("_p"))
    both = (F.col("P") > 0) & (F.col("N") > 0)
    return s.select(
        *group,
        F.when(both, F.lit(1.0) - F.col("_a") / (F.col("P").cast("double") * F.col("N"))).alias("roc_auc"),
        F.when(both, F.col("_p") / F.col("P")).alias("average_precision"))


def _ratio(a: Column, b: Column) -> Column:
    """a / b with zero division -> 0 (the metric library's zero_division=0)."""
    return F.when(b > 0, a / b).otherwise(F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Tp / fp / fn / tn and positives in one pass."""
    y, p = F.col(label), F.col(pred)
    return df.agg(
        F.count_if((y == 1) & (p == 1)).alias("true_positives"),
        F.count_if((y == 0) & (p == 1)).alias("false_positives"),
        F.count_if((y == 1) & (p == 0)).alias("false_negatives"),
        F.count_if((y == 0) & (p == 0)).alias("true_negatives"),
        F.count_if(y == 1).alias("positive_labels"),
        F.count(F.lit(1)).alias("evaluated_rows"))


METRIC_COLUMNS = ["evaluated_rows", "positive_labels", "positive_predictions", "accuracy", "precision",
                  "recall", "f1", "roc_auc", "average_precision", "true_positives", "false_positives",
                  "false_negatives", "true_negatives", "avg_delay_probability", "high_risk_orders",
                  "medium_risk_orders", "low_risk_orders"]


def prediction_metrics(df: DataFrame, label: str = "label", pred: str = "prediction",
                       prob: str = "probability", band: str | None = "risk_band",
                       missing_label_as_zero: bool = True, group: list[str] | None = None,
                       slices: int = LINEAR, per_e: int = PER_E) -> DataFrame:
    """Batch metrics (accuracy, precision, recall, f1 with zero
    division 0; ROC AUC and AP only with both classes; mean probability;
    band counts), one row, or one row per ``group``.
    ``missing_label_as_zero`` reproduces the current-batch rule; the
    baseline path drops NULL labels instead. ``slices`` and ``per_e``: see
    ``running_sum``."""
    group = group or []
    y = F.coalesce(F.col(label), F.lit(0)) if missing_label_as_zero else F.col(label)
    d = df.select(*group, y.cast("long").alias("_y"), F.col(pred).cast("long").alias("_p"),
                  F.col(prob).cast("double").alias("_s"),
                  (F.col(band) if band else F.lit(None).cast("string")).alias("_b"))
    if not missing_label_as_zero:
        d = d.where(F.col("_y").isNotNull())
    # One row per distinct score holds all the counts, and the totals are the
    # last running sums of the curve: the rows are read and shuffled once.
    yy, pp, bb = F.col("_y"), F.col("_p"), F.col("_b")
    counts = {"evaluated_rows": F.lit(True), "positive_labels": yy == 1, "positive_predictions": pp == 1,
              "true_positives": (yy == 1) & (pp == 1), "false_positives": (yy == 0) & (pp == 1),
              "false_negatives": (yy == 1) & (pp == 0), "true_negatives": (yy == 0) & (pp == 0),
              "high_risk_orders": bb == "high", "medium_risk_orders": bb == "medium", "low_risk_orders": bb == "low"}
    cells = d.groupBy(*group, "_s").agg(*[F.count_if(c).alias(n) for n, c in counts.items()])
    curve = running_sum(cells, [F.col("_s")], list(counts), group=group, descending=True, slices=slices, per_e=per_e)
    rows = F.when(F.col("_s").isNotNull(), F.col("evaluated_rows"))
    exact = F.sum(F.col("_s").cast(f"decimal(18,{SCORE_SCALE})") * rows.cast("decimal(18,0)")).cast("double")
    pos, tp_at, all_at = F.col("positive_labels"), F.col("positive_labels_cum"), F.col("evaluated_rows_cum")
    neg = F.col("evaluated_rows") - pos
    base = curve.groupBy(*group).agg(
        *[F.coalesce(F.max(f"{n}_cum"), F.lit(0)).cast("long").alias(n) for n in counts],
        F.when(F.sum(rows) > 0, exact / F.sum(rows)).alias("avg_delay_probability"),
        F.sum(pos * (all_at - tp_at - neg * F.lit(0.5))).alias("_a"), F.sum(pos * (tp_at / all_at)).alias("_p"))
    tp, fp, fn = F.col("true_positives"), F.col("false_positives"), F.col("false_negatives")
    n, big_p = F.col("evaluated_rows"), F.col("positive_labels").cast("double")
    big_n = n - big_p
    both = (big_p > 0) & (big_n > 0)
    out = base.select(
        "*",
        _ratio(tp + F.col("true_negatives"), n).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1"),
        F.when(both, F.lit(1.0) - F.col("_a") / (big_p * big_n)).alias("roc_auc"),
        F.when(both, F.col("_p") / big_p).alias("average_precision"))
    return out.select(*group, *METRIC_COLUMNS)


def threshold_table(curve: DataFrame, tp_value: float = K.VALUE_TRUE_POSITIVE,
                    fp_cost: float = K.COST_FALSE_POSITIVE, fn_cost: float = K.COST_FALSE_NEGATIVE,
                    min_precision: float = K.MIN_PRECISION,
                    penalty: float = K.LOW_PRECISION_PENALTY, group: list[str] | None = None,
                    extra: list[str] | None = None) -> DataFrame:
    """Business score of the rule ``score >= t`` at every distinct score t
    (per ``group``; the per-group totals are one row per group). ``extra``
    curve columns are carried along."""
    group = group or []
    totals = curve_totals(curve, group)
    c = curve.join(totals, group) if group else _one_row_join(curve, totals)
    tp, fp = F.col("tp"), F.col("fp")
    fn = F.col("P") - tp
    n = F.col("P") + F.col("N")
    prec = _ratio(tp, tp + fp)
    rec = _ratio(tp, F.col("P"))
    gain = (F.lit(tp_value) * tp - F.lit(fp_cost) * fp - F.lit(fn_cost) * fn) / n
    return c.select(
        *group, F.col("score").alias("threshold"),
        (gain - F.when(prec < min_precision, F.lit(penalty)).otherwise(F.lit(0.0))).alias("business_score"),
        prec.alias("precision"), rec.alias("recall"),
        _ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1"), *(extra or []))


def choose_threshold(df: DataFrame, label: str = "label", score: str = "score",
                     group: list[str] | None = None, **costs) -> DataFrame:
    """M7: the business-optimal threshold; among equal scores the lowest
    threshold wins (the ascending scan with a strict ``>``)."""
    group = group or []
    t = threshold_table(score_curve(df, label, score, group=group), group=group, **costs)
    best = F.max_by(F.struct("threshold", "business_score", "precision", "recall", "f1"),
                    F.struct(F.col("business_score"), -F.col("threshold")))
    return t.groupBy(*group).agg(best.alias("b")).select(*group, "b.*")


def business_value(df: DataFrame, label: str = "label", pred: str = "prediction",
                   tp_value: float = K.VALUE_TRUE_POSITIVE, fp_cost: float = K.COST_FALSE_POSITIVE,
                   fn_cost: float = K.COST_FALSE_NEGATIVE) -> DataFrame:
    """Model value, baseline (flag nothing: every positive is a missed
    delay), incremental value and value per 1000 orders, as metric rows."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col("true_positives"), F.col("false_positives"), F.col("false_negatives"),
                      F.col("true_negatives"))
    model = F.lit(tp_value) * tp - F.lit(fp_cost) * fp - F.lit(fn_cost) * fn
    base = -F.col("positive_labels") * F.lit(fn_cost)
    v = c.select(tp.cast("double").alias("true_positives"), fp.cast("double").alias("false_positives"),
                 fn.cast("double").alias("false_negatives"), tn.cast("double").alias("true_negatives"),
                 model.alias("model_value"), base.alias("baseline_value"),
                 (model - base).alias("incremental_value"),
                 F.when(F.col("evaluated_rows") > 0, (model - base) / F.col("evaluated_rows") * F.lit(1000.0))
                 .alias("incremental_value_per_1000_orders"))
    names = v.columns
    return v.select(F.explode(F.array(*[
        F.struct(F.lit(i).cast("long").alias("position"), F.lit(nm).alias("metric"), F.col(nm).alias("value"))
        for i, nm in enumerate(names)])).alias("m")).select("m.*")


def classification_report(df: DataFrame, label: str = "label", pred: str = "prediction") -> DataFrame:
    """Per-class precision / recall / f1 / support, accuracy, macro and
    weighted averages (zero division 0)."""
    c = confusion_counts(df, label, pred)
    tp, fp, fn, tn = (F.col("true_positives"), F.col("false_positives"), F.col("false_negatives"),
                      F.col("true_negatives"))
    n = F.col("evaluated_rows")
    p1, r1 = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    p0, r0 = _ratio(tn, tn + fn), _ratio(tn, tn + fp)

    def f1(p, r):
        return F.when(p + r > 0, F.lit(2.0) * p * r / (p + r)).otherwise(F.lit(0.0))

    s1, s0 = tp + fn, tn + fp
    rows = [
        ("0", p0, r0, f1(p0, r0), s0),
        ("1", p1, r1, f1(p1, r1), s1),
        ("accuracy", F.lit(None).cast("double"), F.lit(None).cast("double"), _ratio(tp + tn, n), n),
        ("macro avg", (p0 + p1) / F.lit(2.0), (r0 + r1) / F.lit(2.0), (f1(p0, r0) + f1(p1, r1)) / F.lit(2.0), n),
        ("weighted avg", _ratio(p0 * s0 + p1 * s1, n), _ratio(r0 * s0 + r1 * s1, n),
         _ratio(f1(p0, r0) * s0 + f1(p1, r1) * s1, n), n),
    ]
    return c.select(F.explode(F.array(*[
        F.struct(F.lit(k).alias("class_label"), p.cast("double").alias("precision"),
                 r.cast("double").alias("recall"), f.cast("double").alias("f1_score"),
                 sup.cast("long").alias("support"))
        for k, p, r, f, sup in rows])).alias("r")).select("r.*")


def error_analysis(df: DataFrame, label: str = "label", pred: str = "prediction",
                   segment: str = "carrier") -> DataFrame:
    """False negatives and false positives counted by segment."""
    y, p = F.col(label), F.col(pred)
    kind = F.when((y == 1) & (p == 0), "false_negative").when((y == 0) & (p == 1), "false_positive")
    return (df.select(kind.alias("error_type"), F.col(segment).alias("segment"))
              .where(F.col("error_type").isNotNull())
              .groupBy("error_type", "segment").agg(F.count(F.lit(1)).alias("orders")))


def class_weights(df: DataFrame, label: str = "delay_risk_label") -> DataFrame:
    """M3: the 'balanced' weight n / (n_classes * n_class) per class."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n_class"))
    totals = counts.agg(F.sum("n_class").alias("n"), F.count(F.lit(1)).alias("k"))
    j = _one_row_join(counts, totals)
    return j.select(F.col(label).cast("long").alias("label"), F.col("n_class").cast("long").alias("n_class"),
                    (F.col("n") / (F.col("k") * F.col("n_class"))).alias("weight"))


def evaluate_candidates(df: DataFrame, label: str = "label", score: str = "score",
                        name: str = "name") -> DataFrame:
    """M8 / eval_model for many candidates in one pass: ``df`` holds one row
    per (candidate, order) with the candidate's score. Per candidate: choose
    the business threshold, classify at it, and report AUC, AP, accuracy,
    precision, recall, f1, confusion counts and the selection score
    0.40·recall + 0.25·AUC + 0.20·AP + 0.15·precision.

    One score curve per candidate serves all of it: the rule ``score >= t``
    flags exactly the rows counted in the curve's cumulative tp / fp at t,
    so the confusion counts at the chosen threshold are read off the curve
    (fn = P − tp, tn = N − fp) instead of re-scanning the rows."""
    curve = score_curve(df, label, score, group=[name])
    totals = curve_totals(curve, [name])
    th = threshold_table(curve, group=[name], extra=["tp", "fp"])
    best = th.groupBy(name).agg(F.max_by(F.struct("threshold", "business_score", "tp", "fp"),
                                         F.struct(F.col("business_score"), -F.col("threshold"))).alias("b"))
    m = (best.select(name, "b.*").join(totals, name).join(auc_ap(curve, group=[name]), name))
    flagged = F.col("threshold").isNotNull()
    tp = F.when(flagged, F.col("tp")).otherwise(F.lit(0))
    fp = F.when(flagged, F.col("fp")).otherwise(F.lit(0))
    fn, tn = F.col("P") - tp, F.col("N") - fp
    precision, recall = _ratio(tp, tp + fp), _ratio(tp, tp + fn)
    w = K.SELECTION_WEIGHTS
    return m.select(
        F.col(name).alias("name"), "roc_auc", "average_precision",
        _ratio(tp + tn, F.col("P") + F.col("N")).alias("accuracy"),
        precision.alias("precision"), recall.alias("recall"),
        _ratio(F.lit(2.0) * tp, F.lit(2.0) * tp + fp + fn).alias("f1"),
        "threshold",
        (F.lit(w[0]) * recall + F.lit(w[1]) * F.col("roc_auc") + F.lit(w[2]) * F.col("average_precision")
         + F.lit(w[3]) * precision).alias("selection_score"),
        tn.cast("long").alias("tn"), fp.cast("long").alias("fp"),
        fn.cast("long").alias("fn"), tp.cast("long").alias("tp"),
        F.col("business_score").alias("business_score_per_order"))


def select_best_model(results: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Mark the best candidate by selection score (first candidate
    wins ties, by ``position``)."""
    return _with_best(results, F.struct(F.col("selection_score"), -F.col("position")))


def _with_best(results: DataFrame, rank: Column) -> DataFrame:
    """Mark the candidate of the highest ``rank``. The window holds one row a
    candidate; a join with the best row would evaluate them all twice."""
    best = F.max_by("name", rank).over(Window.partitionBy(F.lit(1)))
    return results.withColumn("is_best", F.col("name") == best)


def class_metrics(df: DataFrame, label: str = "label", score: str = "score", name: str = "name",
                  threshold: float = K.CLASS_THRESHOLD) -> DataFrame:
    """The small trainer's report: per candidate precision, recall and f1 of
    the class at ``threshold``, and ROC AUC."""
    d = df.withColumn("_class", F.when(F.col(score) >= threshold, 1).otherwise(0))
    m = prediction_metrics(d, label, "_class", score, band=None, group=[name])
    return m.select(F.col(name).alias("name"), "precision", "recall", "f1", "roc_auc")


def rank_by_recall(results: DataFrame) -> DataFrame:
    """Mark the candidate with the highest recall, then f1, then ROC AUC
    (the first candidate wins ties, by ``position``)."""
    return _with_best(results, F.struct("recall", "f1", "roc_auc", -F.col("position")))
