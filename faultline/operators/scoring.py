"""Scores, thresholds and classification metrics.

Everything starts from a *score table*: one row per (group, distinct score) with positive and
negative counts (a partial/final aggregate, so the data is reduced before any ordering).
Counts at any threshold t (alerts = p >= t) are reverse running sums over that table, computed
with the range-bucketed ``prefix_sums`` — no unpartitioned window, no driver loop over
thresholds: candidate thresholds are merged into the same ordered pass as zero-weight rows.

``group_cols`` (e.g. ``["model"]``) evaluate many models / splits in the same jobs.
Costs: FN 4, FP 1 (the source's fixed weights).
"""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.plans.prefix import exact_quantiles, join_small, prefix_sums

C_FN_ROW, C_FP_ROW = 4, 1
C_FN, C_FP = 100_000, 25_000


def _and(conds):
    return reduce(lambda a, b: a & b, conds)


def score_table(df: DataFrame, y: str = "y", p: str = "p",
                group_cols: list[str] | None = None) -> DataFrame:
    """(group..., p, pos, neg): one row per distinct non-null score; rows without a label are in
    no count, here and in ``totals`` and ``confusion``."""
    g = list(group_cols or [])
    return (df.where(F.col(p).isNotNull() & F.col(y).isNotNull())
            .groupBy(*g, F.col(p).alias("p"))
            .agg(F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("pos"),
                 F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("neg")))


def totals(df: DataFrame, y: str = "y", group_cols: list[str] | None = None) -> DataFrame:
    g = list(group_cols or [])
    return df.where(F.col(y).isNotNull()).groupBy(*g).agg(
                              F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("n_pos"),
                              F.sum(F.when(F.col(y) == 1, 0).otherwise(1)).alias("n_neg"))


def _join(a: DataFrame, b: DataFrame, g: list[str]) -> DataFrame:
    # ``a`` has a few rows per group (candidates), ``b`` one; without groups b is one row, whose
    # values are scalar subqueries
    if g:
        return a.join(b, on=g, how="inner")
    return a.select("*", *[b.select(c).scalar().alias(c) for c in b.columns])


def counts_at(df: DataFrame, cands: DataFrame, y: str = "y", p: str = "p",
              group_cols: list[str] | None = None) -> DataFrame:
    """Confusion counts at candidate thresholds.

    ``cands``: (group..., thr, ...extra) — any number of rows per group, duplicates allowed.
    Returns cands + tp, fp, fn, tn, n, cost, precision, recall, alert_rate."""
    g = list(group_cols or [])
    st = score_table(df, y, p, g).select(*g, (-F.col("p")).alias("__nk"), F.lit(0).alias("__kind"),
                                         "pos", "neg")
    thr = cands.select(*g, "thr").distinct().select(
        *g, (-F.col("thr")).alias("__nk"), F.lit(1).alias("__kind"),
        F.lit(0).cast("long").alias("pos"), F.lit(0).cast("long").alias("neg"))
    # ordered by score descending; a candidate sorts right after an equal score, so its
    # running counts are exactly the rows with p >= thr
    cum = prefix_sums(st.unionByName(thr), ["__nk", "__kind"], ["pos", "neg"], g)
    at = cum.where(F.col("__kind") == 1).select(*g, (-F.col("__nk")).alias("thr"),
                                                 F.col("cum_pos").alias("tp"),
                                                 F.col("cum_neg").alias("fp"))
    t = totals(df, y, g)
    out = cands.join(at, on=[*g, "thr"], how="inner")
    out = _join(out, t, g)
    return with_metrics(out.select("*", (F.col("n_pos") - F.col("tp")).alias("fn"),
                                   (F.col("n_neg") - F.col("fp")).alias("tn")).drop("n_pos", "n_neg"))


def with_metrics(cm: DataFrame, fn_cost: int = C_FN_ROW, fp_cost: int = C_FP_ROW) -> DataFrame:
    """Add n, cost = 4*FN + FP, precision/recall (0 when undefined) and alert rate."""
    tp, fp, fn, tn = F.col("tp"), F.col("fp"), F.col("fn"), F.col("tn")
    n = tp + fp + fn + tn
    return cm.select("*", n.alias("n"), (F.lit(fn_cost) * fn + F.lit(fp_cost) * fp).alias("cost"),
                     F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0)).alias("precision"),
                     F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0)).alias("recall"),
                     F.when(n > 0, (tp + fp) / n).alias("alert_rate"))


def quantile_counts(df: DataFrame, probs: list[float], y: str = "y", p: str = "p",
                    group_cols: list[str] | None = None) -> DataFrame:
    """``counts_at`` for thresholds that are quantiles of the scores: (group..., q_idx, q, thr, counts).
    Quantiles and counts come from one ordered pass."""
    g = list(group_cols or [])
    known = F.col(y).isNotNull()
    q = exact_quantiles(df, p, probs, g, {"tp": F.when(known & (F.col(y) == 1), 1).otherwise(0),
                                          "fp": F.when(known & (F.col(y) != 1), 1).otherwise(0)})
    out = _join(q.withColumnRenamed("value", "thr"), totals(df, y, g), g)
    return with_metrics(out.select("*", (F.col("n_pos") - F.col("tp")).alias("fn"),
                                   (F.col("n_neg") - F.col("fp")).alias("tn")).drop("n_pos", "n_neg"))


# ------------------------------------------------------------------ I9
def ranking_metrics(df: DataFrame, y: str = "y", p: str = "p",
                    group_cols: list[str] | None = None) -> DataFrame:
    """Step average precision (sum over distinct scores of dRecall * precision) and
    tie-aware ROC AUC (Mann-Whitney with half credit for ties); NULL when a class is absent."""
    g = list(group_cols or [])
    st = score_table(df, y, p, g)
    j = prefix_sums(st, ["p"], ["pos", "neg"], g, descending=True, total_prefix="n_")
    prec = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    above = F.col("cum_pos") - F.col("pos")
    a = j.groupBy(*g).agg(
        F.sum(F.try_divide(F.col("pos"), F.col("n_pos")) * prec).alias("__ap"),
        F.sum(F.col("neg") * (above + 0.5 * F.col("pos"))).alias("__u"),
        F.first("n_pos").alias("n_pos"), F.first("n_neg").alias("n_neg"))
    return a.select(*g, F.when(F.col("n_pos") > 0, F.col("__ap")).alias("ap"),
                    F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
                           F.col("__u") / (F.col("n_pos") * F.col("n_neg"))).alias("auc"),
                    "n_pos", "n_neg")


def _counts_from(df: DataFrame, thrs, y: str, p: str, g: list[str]) -> DataFrame:
    """``counts_at`` for a few fixed thresholds: one aggregate, no ordering."""
    known = df.where(F.col(y).isNotNull())

    def cnt(c):
        return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    at = [F.struct(F.lit(float(t)).alias("thr"), cnt((F.col(p) >= t) & (F.col(y) == 1)).alias("tp"), cnt((F.col(p) >= t) & (F.col(y) != 1)).alias("fp"),
                   cnt(~F.coalesce(F.col(p) >= t, F.lit(False)) & (F.col(y) == 1)).alias("fn"),
                   cnt(~F.coalesce(F.col(p) >= t, F.lit(False)) & (F.col(y) != 1)).alias("tn")) for t in thrs]
    return with_metrics(known.groupBy(*g).agg(F.array(*at).alias("__at")).select(*g, F.inline("__at")))


# ------------------------------------------------------------------ K1-K7
def threshold_for_rate(df: DataFrame, rate: float, y: str = "y", p: str = "p",
                       group_cols: list[str] | None = None) -> DataFrame:
    """K1: largest distinct score whose alert rate (p >= score) is >= ``rate``; the maximum
    score when none qualifies (what the source's binary search returns)."""
    g = list(group_cols or [])
    # rows without a score count in the rate, below all scores
    none = F.lit(float("-inf"))
    st = df.groupBy(*g, F.coalesce(F.col(p), none).alias("p")).agg(F.count(F.lit(1)).alias("c"))
    j = prefix_sums(st, ["p"], ["c"], g, descending=True, total_prefix="n_").where(F.col("p") > none)
    return j.groupBy(*g).agg(
        F.coalesce(F.max(F.when(F.col("cum_c") / F.col("n_c") >= rate, F.col("p"))),
                   F.max("p")).alias("thr"))


def _budget_counts(df, budgets, y, p, g):
    c = quantile_counts(df, [1.0 - b for b in budgets], y, p, g)
    b = F.element_at(F.array(*[F.lit(float(x)) for x in budgets]), F.col("q_idx") + 1)
    return c.withColumn("budget", b).withColumnRenamed("q_idx", "budget_idx").drop("q")


def tune_alert_budget(df: DataFrame, budgets=(0.01, 0.02, 0.03, 0.05), y: str = "y",
                      p: str = "p", group_cols: list[str] | None = None) -> DataFrame:
    """K2: per budget b, thr = quantile(p, 1 - b); keep the lowest cost (first budget on ties)."""
    g = list(group_cols or [])
    c = _budget_counts(df, budgets, y, p, g)
    w = Window.partitionBy(*g).orderBy("cost", "budget_idx") if g else \
        Window.orderBy("cost", "budget_idx")  # one row per budget: a handful of rows
    return c.select("*", F.row_number().over(w).alias("__r")).where("__r = 1").select(
        *g, "budget", "thr", "cost", "tn", "fp", "fn", "tp")


def threshold_min_cost(df: DataFrame, y: str = "y", p: str = "p",
                       group_cols: list[str] | None = None,
                       fn_cost: int = C_FN_ROW, fp_cost: int = C_FP_ROW) -> DataFrame:
    """K3: grid 0, 0.01, ..., 1 (101 thresholds); lowest cost, lowest threshold on ties."""
    g = list(group_cols or [])
    grid = F.explode(F.array(*[F.lit(i * 0.01) for i in range(101)]))
    keys = df.select(*g).distinct() if g else df.sparkSession.range(1).select()
    cands = keys.select(*g, grid.alias("thr"))
    c = counts_at(df, cands, y, p, g).select(*g, "thr", "tp", "fp", "fn", "tn")
    c = with_metrics(c, fn_cost, fp_cost)
    w = Window.partitionBy(*g).orderBy("cost", "thr") if g else Window.orderBy("cost", "thr")
    return c.select("*", F.row_number().over(w).alias("__r")).where("__r = 1").select(*g, "thr", "cost")


def tune_budget_min_precision(df: DataFrame, budgets=(0.001, 0.002, 0.005, 0.0075, 0.01, 0.015, 0.02),
                              min_precision: float = 0.20, y: str = "y", p: str = "p",
                              group_cols: list[str] | None = None) -> DataFrame:
    """K4: as K2 restricted to precision >= ``min_precision``; no row when none qualifies."""
    g = list(group_cols or [])
    c = _budget_counts(df, budgets, y, p, g).where(F.col("precision") >= min_precision)
    w = Window.partitionBy(*g).orderBy("cost", "budget_idx") if g else Window.orderBy("cost", "budget_idx")
    return c.select("*", F.row_number().over(w).alias("__r")).where("__r = 1").select(
        *g, "budget", F.col("thr").alias("threshold"), "cost", "recall", "precision",
        (F.col("tp") + F.col("fp")).alias("alerts"))


def threshold_cost_or_budget(df: DataFrame, max_alert_rate: float = 0.05, y: str = "y",
                             p: str = "p", group_cols: list[str] | None = None) -> DataFrame:
    """K5: candidates {0, 1} and 201 quantiles; lowest cost (lowest threshold on ties).  If its
    alert rate exceeds ``max_alert_rate`` fall back to quantile(1 - max): the reported rate is
    then ``max_alert_rate`` (source behaviour) and ``realized_rate`` is the true rate."""
    g = list(group_cols or [])
    probs = [float(x) for x in np.linspace(0, 1, 201)]
    fallback_idx = len(probs)
    # quantiles, the fallback threshold and their counts come from one ordered pass
    q = quantile_counts(df, probs + [1.0 - max_alert_rate], y, p, g).withColumn("__fb", F.col("q_idx") == fallback_idx)
    c = q.drop("q_idx", "q").unionByName(_counts_from(df, (0.0, 1.0), y, p, g).withColumn("__fb", F.lit(False)))
    w = Window.partitionBy(*g).orderBy("cost", "thr") if g else Window.orderBy("cost", "thr")
    best = c.where(~F.col("__fb")).select("*", F.row_number().over(w).alias("__r")).where("__r = 1").drop("__fb")
    fb = c.where(F.col("__fb")).select(*g, F.col("thr").alias("__fbt"), F.col("alert_rate").alias("__fb_rate"))
    j = _join(best, fb, g)
    over = F.col("alert_rate") > max_alert_rate
    return j.select(*g, F.when(over, F.col("__fbt")).otherwise(F.col("thr")).alias("thr"),
                    F.when(over, F.lit(max_alert_rate)).otherwise(F.col("alert_rate")).alias("alert_rate"),
                    F.when(over, F.lit("budget_fallback")).otherwise(F.lit("cost_optimal")).alias("mode"),
                    F.when(over, F.col("__fb_rate")).otherwise(F.col("alert_rate")).alias("realized_rate"))


def threshold_min_precision(df: DataFrame, min_precision: float = 0.20, y: str = "y",
                            p: str = "p", group_cols: list[str] | None = None) -> DataFrame:
    """K6: candidates = 200 quantiles in [0.9, 1] and the max score, scanned from the top:
    the first (highest) with precision >= min wins; else the highest precision seen first."""
    g = list(group_cols or [])
    probs = [float(x) for x in np.linspace(0.90, 1.0, 200)]
    # the last quantile is the maximum
    c = quantile_counts(df, probs, y, p, g).select(*g, "thr", "precision", "alert_rate").distinct()
    a = c.groupBy(*g).agg(
        F.max(F.when(F.col("precision") >= min_precision, F.col("thr"))).alias("__ok"),
        F.max_by("thr", F.struct("precision", "thr")).alias("__best"))
    pick = a.select(*g, F.coalesce("__ok", "__best").alias("thr"))
    return pick.join(c.select(*g, "thr", "alert_rate"), on=[*g, "thr"], how="inner") if g else \
        pick.join(c.select("thr", "alert_rate"), on="thr", how="inner")


def apply_threshold(df: DataFrame, thr: float | None, p: str = "p", out: str = "pred") -> DataFrame:
    """P >= thr -> 1; with no threshold the input is already 0/1 (p > 0)."""
    c = (F.col(p) >= thr) if thr is not None else (F.col(p) > 0)
    return df.select("*", F.coalesce(c, F.lit(False)).cast("int").alias(out))


def cost_at_threshold(df: DataFrame, thr: float, y: str = "y", p: str = "p",
                      group_cols: list[str] | None = None) -> DataFrame:
    """K7: 4*FN + FP and the confusion counts at one threshold."""
    return confusion(apply_threshold(df, thr, p), y, "pred", group_cols, with_cost=True)


def confusion(df: DataFrame, y: str = "y", pred: str = "pred",
              group_cols: list[str] | None = None, with_cost: bool = False) -> DataFrame:
    """2x2 confusion counts; absent classes give zeros."""
    g = list(group_cols or [])
    yy, pp = F.col(y) == 1, F.col(pred) == 1

    def cnt(c):
        return F.coalesce(F.sum(F.when(c, 1).otherwise(0)), F.lit(0)).cast("long")
    cm = df.groupBy(*g).agg(cnt(~yy & ~pp).alias("tn"), cnt(~yy & pp).alias("fp"),
                            cnt(yy & ~pp).alias("fn"), cnt(yy & pp).alias("tp"))
    if not with_cost:
        return cm
    return cm.select("*", (F.lit(C_FN_ROW) * F.col("fn") + F.lit(C_FP_ROW) * F.col("fp")).alias("cost"))


def topk_alerts(df: DataFrame, k: int = 10, p: str = "p", out: str = "pred",
                key_cols=("device", "date")) -> DataFrame:
    """H3: the k highest scores alert (ties broken by the row key).  The k winners come from a
    TakeOrdered of k rows and are joined back, by broadcast if they are few."""
    top = df.orderBy(F.col(p).desc(), *key_cols).limit(k).select(*key_cols, F.lit(1).alias(out))
    return join_small(df, top, list(key_cols), "left") \
        .select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce(F.col(out), F.lit(0)).alias(out))


def score_profile(df: DataFrame, p: str = "p", group_cols: list[str] | None = None) -> DataFrame:
    """Quantiles 0, .5, .9, .95, .99, .995, .999, 1 of the scores."""
    probs = [0.0, 0.5, 0.9, 0.95, 0.99, 0.995, 0.999, 1.0]
    return exact_quantiles(df, p, probs, group_cols).select(*(group_cols or []), "q", "value")


# ------------------------------------------------------------------ J5-J7, J13, J14
def business_metrics(df: DataFrame, y: str = "y", pred: str = "pred", p: str = "p",
                     group_cols: list[str] | None = None) -> DataFrame:
    """AP, recall, alert rate, cost = 4FN + FP, economy = 4(TP + FN) - cost, counts."""
    g = list(group_cols or [])
    cm = confusion(df, y, pred, g)
    rk = ranking_metrics(df, y, p, g).select(*g, "ap")
    j = _join(cm, rk, g)
    cost = F.lit(4) * F.col("fn") + F.col("fp")
    n = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return j.select(*g, F.col("ap").alias("auc_pr"),
                    F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn")))
                    .otherwise(F.lit(0.0)).alias("recall_h"),
                    ((F.col("tp") + F.col("fp")) / n).alias("alert_rate"), cost.alias("cost"),
                    (F.lit(4) * (F.col("tp") + F.col("fn")) - cost).alias("economy"),
                    "tn", "fp", "fn", "tp")


def business_roi(cm: DataFrame, c_fn: int = C_FN, c_fp: int = C_FP) -> DataFrame:
    """Row-level ROI; true positives are cost-free (source behaviour)."""
    base = (F.col("tp") + F.col("fn")) * F.lit(c_fn)
    with_model = F.col("fn") * F.lit(c_fn) + F.col("fp") * F.lit(c_fp)
    return cm.select("*", (base - with_model).alias("roi_abs"),
                     F.when(base > 0, 1 - with_model / base).otherwise(F.lit(0.0)).alias("roi_pct"))


def break_even(cm: DataFrame, c_fn: int = C_FN, c_fp: int = C_FP) -> DataFrame:
    """Minimum precision c_fp/(c_fp + c_fn); precision, ROI, pass flag and, when failing,
    the TPs needed (ceil(fp / (c_fn/c_fp))) and the shortfall."""
    min_p = c_fp / (c_fp + c_fn)
    r = business_roi(cm, c_fn, c_fp)
    prec = F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(F.lit(0.0))
    needed = F.ceil(F.col("fp") / F.lit(c_fn / c_fp))
    return r.select("*", F.lit(min_p).alias("min_precision"), prec.alias("precision"),
                    (prec >= min_p).cast("int").alias("passes")) \
        .select("*", F.when(F.col("passes") == 0, needed).alias("needed_tp"),
                F.when(F.col("passes") == 0, F.greatest(F.lit(0), needed - F.col("tp"))).alias("missing_tp"))


def cost_sensitivity(cm: DataFrame, ratios=(2, 3, 4, 5, 6), group_cols: list[str] | None = None) -> DataFrame:
    """cost = r*FN + FP and recall for each cost ratio r (long form)."""
    g = list(group_cols or [])
    return cm.select(*g, "fn", "fp", "tp", F.explode(F.array(*[F.lit(r) for r in ratios])).alias("cost_ratio")) \
        .select(*g, "cost_ratio", (F.col("cost_ratio") * F.col("fn") + F.col("fp")).alias("cost"),
                F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn")))
                .otherwise(F.lit(0.0)).alias("recall"))


def false_negatives(df: DataFrame, y: str = "y", pred: str = "pred") -> DataFrame:
    """The missed positive rows."""
    return df.where((F.col(y) == 1) & (F.col(pred) == 0))


def false_negative_profile(df: DataFrame, y: str = "y", pred: str = "pred") -> dict[str, DataFrame]:
    """FN counts by weekday, the 10 devices with most FNs, and the FN period."""
    fn = false_negatives(df, y, pred)
    return {
        "by_weekday": fn.groupBy(F.weekday("date").alias("weekday")).agg(F.count(F.lit(1)).alias("n")),
        "top_devices": fn.groupBy("device").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.col("n").desc(), "device").limit(10),
        "period": fn.agg(F.count(F.lit(1)).alias("n"), F.min("date").alias("first_date"),
                         F.max("date").alias("last_date")),
    }


# ------------------------------------------------------------------ K8, K9
def apply_optimal_thresholds(val: DataFrame, test: DataFrame, budgets=(0.01, 0.015, 0.02, 0.03),
                             min_precision: float = 0.2, y: str = "y", p: str = "p",
                             group_cols: list[str] | None = None, readings: DataFrame | None = None,
                             horizon_days: int = 10) -> DataFrame:
    """K8: per model, K4 on validation (fallback: K3 grid threshold with budget 0.01), applied
    to the test scores; returns threshold, applied budget and the J5 metrics on test, and with
    the ``readings`` of the test devices and dates each model's event metrics."""
    g = list(group_cols or ["model"])
    k4 = tune_budget_min_precision(val, budgets, min_precision, y, p, g) \
        .select(*g, F.col("threshold").alias("__t4"), F.col("budget").alias("__b4"))
    k3 = threshold_min_cost(val, y, p, g).select(*g, F.col("thr").alias("__t3"))
    ch = k3.join(k4, on=g, how="left").select(
        *g, F.coalesce("__t4", "__t3").alias("threshold"),
        F.coalesce("__b4", F.lit(0.01)).alias("applied_budget"))
    scored = test.join(ch, on=g, how="inner")
    scored = scored.select("*", F.coalesce(F.col(p) >= F.col("threshold"), F.lit(False)).cast("int").alias("pred"))
    out = business_metrics(scored, y, "pred", p, g).join(ch, on=g, how="inner")
    if readings is not None:
        from faultline.operators.events import event_columns, match_alerts_failures
        out = out.join(event_columns(match_alerts_failures(readings, scored, horizon_days, group_cols=g), g), g, "left")
    return out


def budget_sweep(val: DataFrame, test: DataFrame, budgets=(0.002, 0.005, 0.01, 0.02, 0.03, 0.05),
                 min_precision: float = 0.2, y: str = "y", p: str = "p",
                 group_cols: list[str] | None = None) -> DataFrame:
    """K9: per budget the validation quantile threshold, its test cost / precision / recall /
    alert rate, and whether it is kept (precision >= min and alert rate <= budget)."""
    g = list(group_cols or [])
    b = F.element_at(F.array(*[F.lit(float(x)) for x in budgets]), F.col("q_idx") + 1)
    c = exact_quantiles(val, p, [1.0 - x for x in budgets], g).select(*g, F.col("q_idx").alias("budget_idx"), b.alias("budget"), F.col("value").alias("thr"))
    t = counts_at(test, c, y, p, g)
    return t.select(*g, "budget", "thr", "cost", "precision", "recall", "alert_rate",
                    ((F.col("precision") >= min_precision) & (F.col("alert_rate") <= F.col("budget")))
                    .cast("int").alias("kept"))


def best_budget(sweep: DataFrame, group_cols: list[str] | None = None) -> DataFrame:
    """K9 pick: the kept budget with the lowest test cost (smallest budget on ties)."""
    g = list(group_cols or [])
    k = sweep.where(F.col("kept") == 1)
    w = Window.partitionBy(*g).orderBy("cost", "budget") if g else Window.orderBy("cost", "budget")
    return k.select("*", F.row_number().over(w).alias("__r")).where("__r = 1").drop("__r", "kept")
