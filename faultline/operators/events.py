"""Alert <-> failure events and business reports.

``readings`` is the raw (device, date, failure) table; ``alerts`` are scored rows with a 0/1
``pred``.  All joins are equi-joins on ``device`` (plus a date-range predicate), so they shuffle
on the device key and each task sees one device's bounded history.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators.scoring import business_metrics, confusion, ranking_metrics, with_metrics

from faultline.operators.scoring import C_FN, C_FP


def subset_events(readings: DataFrame, eval_rows: DataFrame) -> DataFrame:
    """Readings dated within [min, max] of the evaluation rows, for devices present in
    them; keeps device, date, failure.  Bounds are scalar subqueries; the device set is a
    left-semi join (shuffle on device, no collect)."""
    lo = eval_rows.select(F.min("date")).scalar()
    hi = eval_rows.select(F.max("date")).scalar()
    devs = eval_rows.select("device").distinct()
    return (readings.where((F.col("date") >= lo) & (F.col("date") <= hi))
            .join(devs, on="device", how="left_semi")
            .select("device", "date", "failure"))


def _failures(readings: DataFrame) -> DataFrame:
    return readings.where(F.col("failure") == 1).select("device", F.col("date").alias("fdate"))


def _alerts(alerts: DataFrame, pred: str = "pred") -> DataFrame:
    return alerts.where(F.col(pred) == 1).select("device", F.col("date").alias("adate"))


def covered_failures(readings: DataFrame, alerts: DataFrame, horizon_days: int = 10,
                     pred: str = "pred") -> DataFrame:
    """Failures with at least one alert on the same device in [f - H, f) (left-semi join
    on device with a range predicate)."""
    f, a = _failures(readings), _alerts(alerts, pred)
    cond = (f.device == a.device) & (a.adate >= F.date_sub(f.fdate, horizon_days)) & (a.adate < f.fdate)
    return f.join(a, on=cond, how="left_semi")


def event_metrics(readings: DataFrame, alerts: DataFrame, horizon_days: int = 10,
                  pred: str = "pred") -> DataFrame:
    """Event coverage = covered failures / max(1, failures); alerts per 100 device-weeks =
    100 * alerts / (devices * dates / 7), devices and dates counted on ``readings``."""
    n_fail = _failures(readings).select(F.count(F.lit(1))).scalar()
    n_cov = covered_failures(readings, alerts, horizon_days, pred).select(F.count(F.lit(1))).scalar()
    n_dev = readings.select("device").distinct().select(F.count(F.lit(1))).scalar()
    n_dates = readings.select("date").distinct().select(F.count(F.lit(1))).scalar()
    n_alerts = _alerts(alerts, pred).agg(F.count(F.lit(1)).alias("alerts"))
    return n_alerts.select(
        (n_cov / F.greatest(n_fail, F.lit(1))).alias("event_coverage"),
        (F.lit(100) * (F.col("alerts") / (n_dev * (n_dates / F.lit(7.0))))).alias("alerts_per_100dev_week"),
        n_cov.alias("covered_failures"), n_fail.alias("failures"), "alerts")


def match_alerts_failures(readings: DataFrame, alerts: DataFrame, horizon_days: int = 10,
                          pred: str = "pred", count_unmatched_devices: bool = False,
                          group_cols: list[str] | None = None) -> DataFrame:
    """1:1 matching per device, and per ``group_cols`` of the alerts (models), each of which
    faces all failures.  Failures in date order each take the latest unused alert in
    [f - H, f); unmatched failures are FN, unused alerts FP.  Devices without failures are
    ignored (source behaviour) unless ``count_unmatched_devices``.

    Greedy latest-unused matching is a LIFO stack over the device's events in date order (a
    failure sorts before same-day alerts, which cannot cover it): a fold over the sorted event
    list with Catalyst's ``aggregate`` — no Python UDF.  The list is one device's history
    (bounded by its days), never a whole table.
    Returns per (group and) device: tp_events, fn_events, fp_alerts."""
    keys = list(group_cols or [])
    ev_f = _failures(readings).select("device", F.datediff("fdate", F.lit("1970-01-01")).alias("d"),
                                      F.lit(0).alias("k"))
    ev_a = alerts.where(F.col(pred) == 1).select(*keys, "device", F.datediff("date", F.lit("1970-01-01")).alias("d"),
                                                 F.lit(1).alias("k"))
    if keys:
        # the list of models is one value; every failure is dealt to each of them
        models = alerts.agg(F.collect_set(F.struct(*keys))).scalar()
        ev_f = ev_f.select(F.explode(models).alias("__g"), "device", "d", "k").select("__g.*", "device", "d", "k")
    ev = ev_f.unionByName(ev_a)
    g = ev.groupBy(*keys, "device").agg(F.array_sort(F.collect_list(F.struct("d", "k"))).alias("evs"),
                                 F.max(F.when(F.col("k") == 0, 1).otherwise(0)).alias("has_fail"))
    if not count_unmatched_devices:
        g = g.where(F.col("has_fail") == 1)
    init = F.struct(F.array().cast("array<int>").alias("stack"), F.lit(0).alias("tp"), F.lit(0).alias("fn"))

    def step(acc, e):
        top_ok = (F.size(acc.stack) > 0) & (F.element_at(acc.stack, -1) >= e.d - horizon_days)
        alert = F.struct(F.concat(acc.stack, F.array(e.d)).alias("stack"), acc.tp.alias("tp"), acc.fn.alias("fn"))
        hit = F.struct(F.slice(acc.stack, 1, F.size(acc.stack) - 1).alias("stack"),
                       (acc.tp + 1).alias("tp"), acc.fn.alias("fn"))
        miss = F.struct(acc.stack.alias("stack"), acc.tp.alias("tp"), (acc.fn + 1).alias("fn"))
        return F.when(e.k == 1, alert).when(top_ok, hit).otherwise(miss)

    r = g.select(*keys, "device", F.aggregate("evs", init, step).alias("s"))
    return r.select(*keys, "device", F.col("s.tp").alias("tp_events"), F.col("s.fn").alias("fn_events"),
                    F.size("s.stack").alias("fp_alerts"))


def event_roi(matched: DataFrame, c_fn: int = C_FN, c_fp: int = C_FP,
              group_cols: list[str] | None = None) -> DataFrame:
    """Totals of J1 and event ROI: baseline (tp + fn)*C_fn, with model fn*C_fn + fp*C_fp,
    roi_abs, roi_pct (0 if baseline 0), event precision and recall (0 when undefined)."""
    g = list(group_cols or [])
    t = matched.groupBy(*g).agg(F.coalesce(F.sum("tp_events"), F.lit(0)).alias("tp_events"),
                                F.coalesce(F.sum("fn_events"), F.lit(0)).alias("fn_events"),
                                F.coalesce(F.sum("fp_alerts"), F.lit(0)).alias("fp_alerts"))
    tp, fn, fp = F.col("tp_events"), F.col("fn_events"), F.col("fp_alerts")
    base = (tp + fn) * F.lit(c_fn)
    wm = fn * F.lit(c_fn) + fp * F.lit(c_fp)
    return t.select("*", (base - wm).alias("roi_abs"),
                    F.when(base == 0, F.lit(0.0)).otherwise(1 - wm / base).alias("roi_pct"),
                    F.when(tp + fp == 0, F.lit(0.0)).otherwise(tp / (tp + fp)).alias("precision_event"),
                    F.when(tp + fn == 0, F.lit(0.0)).otherwise(tp / (tp + fn)).alias("recall_event"))


def break_even_event(roi: DataFrame, c_fn: int = C_FN, c_fp: int = C_FP) -> DataFrame:
    """Event precision vs the break-even minimum; TPs needed = ceil(fp * mp / (1 - mp))."""
    mp = c_fp / (c_fp + c_fn)
    needed = F.ceil(F.col("fp_alerts") * F.lit(mp / (1 - mp)))
    ok = F.col("precision_event") >= mp
    return roi.select("*", F.lit(mp).alias("min_precision"), ok.cast("int").alias("passes"),
                      F.when(~ok, needed).alias("needed_tp"),
                      F.when(~ok, needed - F.col("tp_events")).alias("missing_tp"))


def compare_models(metrics: DataFrame, use_holdout: bool = False) -> DataFrame:
    """Model table (auc, cost, precision, recall) ordered by cost asc on hold-out, else by
    AUC desc (model name breaks ties)."""
    order = [F.col("cost").asc(), "model"] if use_holdout else [F.col("auc").desc(), "model"]
    return metrics.select("model", "auc", "cost", "precision", "recall").orderBy(*order)


def select_best_model(metrics: DataFrame, use_holdout: bool = True) -> DataFrame:
    """The first model of J9 (one row)."""
    return compare_models(metrics, use_holdout).limit(1)


def holdout_comparison(pred: DataFrame) -> DataFrame:
    """J9/J10 figures of each model (model, y, p, pred, split): AUC on test; cost, precision, recall and F1 on
    the hold-out, or on test where the model has no hold-out rows; ``metrics_source`` says which."""
    cm = with_metrics(confusion(pred.where(F.col("split").isin("hold", "test")), group_cols=["model", "split"]))
    p, r = F.col("precision"), F.col("recall")
    cm = cm.withColumn("f1", F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)))
    first = F.struct((F.col("split") != "hold").alias("test"), *[F.col(c) for c in ("cost", "precision", "recall", "f1", "split")])
    own = cm.groupBy("model").agg(F.min(first).alias("m")).select(
        "model", "m.cost", "m.precision", "m.recall", "m.f1",
        F.when(F.col("m.split") == "hold", "holdout").otherwise("test_fallback").alias("metrics_source"))
    auc = ranking_metrics(pred.where("split = 'test'"), group_cols=["model"]).select("model", "auc", "ap")
    return own.join(auc, "model", "left").select("model", "auc", "ap", "cost", "precision", "recall", "f1", "metrics_source")


def best_on_holdout(pred: DataFrame) -> DataFrame:
    """The model of least cost (names break ties), with its figures: one row."""
    return holdout_comparison(pred).orderBy("cost", "model").limit(1)


def event_columns(matched: DataFrame, group_cols: list[str]) -> DataFrame:
    """The event metrics that reports carry per model: J2's ROI, precision and recall."""
    return event_roi(matched, group_cols=group_cols).select(
        *group_cols, F.col("tp_events"), F.col("fn_events"), F.col("fp_alerts"),
        F.col("roi_pct").alias("roi_event"), "precision_event", "recall_event")


def final_evaluation(test: DataFrame, thresholds: DataFrame, readings: DataFrame, horizon_days: int = 10,
                     y: str = "y", p: str = "p") -> DataFrame:
    """The chosen models on the test rows: threshold, J5, event ROI and sample counts, one row
    per model.  ``thresholds``: (model, threshold); ``test``: the models' (calibrated) scores;
    ``readings``: those of the test devices and dates."""
    g = ["model"]
    scored = test.join(thresholds.select("model", "threshold"), g).select(
        "*", F.coalesce(F.col(p) >= F.col("threshold"), F.lit(False)).cast("int").alias("pred"))
    rows = scored.groupBy(*g).agg(
        F.first("threshold").alias("threshold"), F.count(F.lit(1)).alias("total_samples"),
        F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).alias("positive_samples"),
        F.sum(F.when(F.col(y) == 0, 1).otherwise(0)).alias("negative_samples"))
    events = event_columns(match_alerts_failures(readings, scored, horizon_days, group_cols=g), g)
    return (business_metrics(scored, y, "pred", p, g).join(rows, g).join(events, g, "left")
            .withColumn("positive_rate", F.col("positive_samples") / F.col("total_samples")))


def final_summary(evaluation: DataFrame, ranking: DataFrame, splits: DataFrame, n_features: int, purge_days: int = 7,
                  min_precision: float = 0.02, cv: DataFrame | None = None, leakage: DataFrame | None = None) -> DataFrame:
    """One row per model: AUC, AP, threshold, cost, event metrics, whether event precision
    reaches ``min_precision``, confusion counts; and of the run: the first and last day of train,
    val and test, purge, features, mean and sample deviation of each numeric column of the fold
    table ``cv``, and suspicious features besides the target (``leakage``: one row each).

    Run-level values are one-row aggregates, added as scalar subqueries."""
    ev = evaluation.join(ranking.select("model", "auc", "ap"), "model")
    out = ev.select("model", "auc", "ap", "threshold", "cost", "roi_event", "precision_event", "recall_event",
                    (F.coalesce("precision_event", F.lit(0.0)) >= min_precision).cast("int").alias("passes"),
                    "tn", "fp", "fn", "tp")
    once = {}
    for part in ("train", "val", "test"):
        own = splits.where(F.col("split") == part)
        once[f"{part}_start"] = own.select(F.min("date")).scalar()
        once[f"{part}_end"] = own.select(F.max("date")).scalar()
    once |= {"purge_days": F.lit(purge_days), "n_features": F.lit(n_features)}
    for c, kind in cv.dtypes if cv is not None else []:
        if c != "fold" and kind in ("int", "bigint", "double"):
            once |= {f"cv_{c}_mean": cv.select(F.avg(c)).scalar(), f"cv_{c}_std": cv.select(F.stddev_samp(c)).scalar()}
    n = leakage.select(F.greatest(F.count(F.lit(1)) - 1, F.lit(0))).scalar() if leakage is not None else F.lit(0)
    return out.select("*", *[v.alias(k) for k, v in (once | {"data_leakage_check": n}).items()])
