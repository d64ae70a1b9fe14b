"""Event queries (B19, C5, J1-J3, J8-J10): test-split alerts of the fixture score (p >= 0.3)
against the raw failures of the same devices and dates, horizon 3 days."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog.scoring import K8_BUDGETS, K8_SQL, THR, _AP2, _BM2, _CM2, _pred2, _s, _s2
from faultline.operators import events as ev, features as fe, scoring as sc, stats as st
from faultline.registry import query
from faultline.sources.fixtures import FIXTURE_HORIZON, FIXTURE_PURGE, device_readings

H = FIXTURE_HORIZON
FEATS = [c for c in fe.feature_names() if c not in ("device", "date", "early_warn_target")]
TESTA = f"SELECT device, date, CAST(p >= {THR} AS INTEGER) AS pred FROM scored WHERE split = 'test'"
SUBSET = f"""SELECT device, date, failure FROM device_readings
WHERE date >= (SELECT min(date) FROM scored WHERE split = 'test') AND date <= (SELECT max(date) FROM scored WHERE split = 'test')
  AND device IN (SELECT DISTINCT device FROM scored WHERE split = 'test')"""


def _alerts(spark, sf):
    return sc.apply_threshold(_s(spark, sf, "test"), THR)


def _subset(spark, sf):
    return ev.subset_events(device_readings(spark, sf), _s(spark, sf, "test"))


@query("b19_subset_events", SUBSET)
def b19(spark, sf):
    return _subset(spark, sf)


_COVERED = f"""SELECT f.device, f.date AS fdate FROM ({SUBSET}) f
WHERE f.failure = 1 AND EXISTS (SELECT 1 FROM ({TESTA}) a WHERE a.pred = 1 AND a.device = f.device
                                AND a.date >= f.date - INTERVAL {H} DAY AND a.date < f.date)"""


@query("c05_covered_failures", _COVERED)
def c05(spark, sf):
    return ev.covered_failures(_subset(spark, sf), _alerts(spark, sf), H)


@query("j03_event_metrics", f"""
SELECT (SELECT count(*) FROM ({_COVERED})) / greatest((SELECT count(*) FROM ({SUBSET}) WHERE failure = 1), 1) AS event_coverage,
       100 * ((SELECT count(*) FROM ({TESTA}) WHERE pred = 1) /
              ((SELECT count(DISTINCT device) FROM ({SUBSET})) * ((SELECT count(DISTINCT date) FROM ({SUBSET})) / 7.0::DOUBLE))) AS alerts_per_100dev_week,
       (SELECT count(*) FROM ({_COVERED})) AS covered_failures,
       (SELECT count(*) FROM ({SUBSET}) WHERE failure = 1) AS failures,
       (SELECT count(*) FROM ({TESTA}) WHERE pred = 1) AS alerts""")
def j03(spark, sf):
    return ev.event_metrics(_subset(spark, sf), _alerts(spark, sf), H)


_MATCH = f"""
WITH e AS (SELECT device, date_diff('day', DATE '1970-01-01', date) AS d, 0 AS k FROM ({SUBSET}) WHERE failure = 1
           UNION ALL
           SELECT device, date_diff('day', DATE '1970-01-01', date) AS d, 1 AS k FROM ({TESTA}) WHERE pred = 1),
g AS (SELECT device, list_sort(list({{'d': d, 'k': k}})) AS evs FROM e GROUP BY device HAVING max(CASE WHEN k = 0 THEN 1 ELSE 0 END) = 1),
r AS (SELECT device, list_reduce(evs, lambda acc, x:
        CASE WHEN x.k = 1 THEN {{'stack': list_append(acc.stack, x.d), 'tp': acc.tp, 'fn': acc.fn}}
             WHEN len(acc.stack) > 0 AND acc.stack[-1] >= x.d - {H}
                  THEN {{'stack': array_pop_back(acc.stack), 'tp': acc.tp + 1, 'fn': acc.fn}}
             ELSE {{'stack': acc.stack, 'tp': acc.tp, 'fn': acc.fn + 1}} END,
        {{'stack': []::BIGINT[], 'tp': 0, 'fn': 0}}) AS s FROM g)
SELECT device, s.tp AS tp_events, s.fn AS fn_events, len(s.stack) AS fp_alerts FROM r"""


@query("j01_match_alerts_failures", _MATCH)
def j01(spark, sf):
    return ev.match_alerts_failures(_subset(spark, sf), _alerts(spark, sf), H)


# the same greedy matching per model: alerts of either model against all failures
def _match2(alerts):
    return f"""
WITH a AS ({alerts}),
e AS (SELECT m.model, f.device, date_diff('day', DATE '1970-01-01', f.date) AS d, 0 AS k
      FROM ({SUBSET}) f, (SELECT DISTINCT model FROM a) m WHERE f.failure = 1
      UNION ALL SELECT model, device, date_diff('day', DATE '1970-01-01', date) AS d, 1 AS k FROM a WHERE pred = 1),
g AS (SELECT model, device, list_sort(list({{'d': d, 'k': k}})) AS evs FROM e GROUP BY ALL HAVING min(k) = 0),
r AS (SELECT model, list_reduce(evs, lambda acc, x:
        CASE WHEN x.k = 1 THEN {{'stack': list_append(acc.stack, x.d), 'tp': acc.tp, 'fn': acc.fn}}
             WHEN len(acc.stack) > 0 AND acc.stack[-1] >= x.d - {H}
                  THEN {{'stack': array_pop_back(acc.stack), 'tp': acc.tp + 1, 'fn': acc.fn}}
             ELSE {{'stack': acc.stack, 'tp': acc.tp, 'fn': acc.fn + 1}} END,
        {{'stack': []::BIGINT[], 'tp': 0, 'fn': 0}}) AS s FROM g),
t AS (SELECT model, sum(s.tp) AS tp_events, sum(s.fn) AS fn_events, sum(len(s.stack)) AS fp_alerts FROM r GROUP BY 1)
SELECT *, CASE WHEN tp_events + fn_events = 0 THEN 0.0
               ELSE 1 - (fn_events * 100000.0::DOUBLE + fp_alerts * 25000) / ((tp_events + fn_events) * 100000) END AS roi_event,
       CASE WHEN tp_events + fp_alerts = 0 THEN 0.0 ELSE CAST(tp_events AS DOUBLE) / (tp_events + fp_alerts) END AS precision_event,
       CASE WHEN tp_events + fn_events = 0 THEN 0.0 ELSE CAST(tp_events AS DOUBLE) / (tp_events + fn_events) END AS recall_event
FROM t"""


_ROI = f"""
SELECT tp_events, fn_events, fp_alerts,
       (tp_events + fn_events) * 100000 - (fn_events * 100000 + fp_alerts * 25000) AS roi_abs,
       CASE WHEN (tp_events + fn_events) * 100000 = 0 THEN 0.0
            ELSE 1 - CAST(fn_events * 100000 + fp_alerts * 25000 AS DOUBLE) / ((tp_events + fn_events) * 100000) END AS roi_pct,
       CASE WHEN tp_events + fp_alerts = 0 THEN 0.0 ELSE CAST(tp_events AS DOUBLE) / (tp_events + fp_alerts) END AS precision_event,
       CASE WHEN tp_events + fn_events = 0 THEN 0.0 ELSE CAST(tp_events AS DOUBLE) / (tp_events + fn_events) END AS recall_event
FROM (SELECT coalesce(sum(tp_events), 0) AS tp_events, coalesce(sum(fn_events), 0) AS fn_events,
             coalesce(sum(fp_alerts), 0) AS fp_alerts FROM ({_MATCH}))"""


@query("j02_event_roi", _ROI)
def j02(spark, sf):
    return ev.event_roi(ev.match_alerts_failures(_subset(spark, sf), _alerts(spark, sf), H))


@query("j08_break_even_event", f"""
SELECT *, 0.2 AS min_precision, CAST(precision_event >= 0.2 AS INTEGER) AS passes,
       CASE WHEN precision_event < 0.2 THEN CAST(ceil(fp_alerts * (0.2 / (1 - 0.2))::DOUBLE) AS BIGINT) END AS needed_tp,
       CASE WHEN precision_event < 0.2 THEN CAST(ceil(fp_alerts * (0.2 / (1 - 0.2))::DOUBLE) AS BIGINT) - tp_events END AS missing_tp
FROM ({_ROI})""")
def j08(spark, sf):
    return ev.break_even_event(ev.event_roi(ev.match_alerts_failures(_subset(spark, sf), _alerts(spark, sf), H)))


_MODELS = f"""
SELECT cm.model, a.auc, 4 * cm.fn + cm.fp AS cost,
       CASE WHEN cm.tp + cm.fp > 0 THEN CAST(cm.tp AS DOUBLE) / (cm.tp + cm.fp) ELSE 0.0 END AS precision,
       CASE WHEN cm.tp + cm.fn > 0 THEN CAST(cm.tp AS DOUBLE) / (cm.tp + cm.fn) ELSE 0.0 END AS recall
FROM ({_CM2}) cm JOIN ({_AP2}) a ON cm.model = a.model"""


def _model_table(spark, sf):
    d = _pred2(spark, sf)
    cm = sc.with_metrics(sc.confusion(d, group_cols=["model"]))
    auc = sc.ranking_metrics(d, group_cols=["model"]).select("model", "auc")
    return cm.join(auc, on="model").select("model", "auc", "cost", "precision", "recall")


@query("j09_compare_models", _MODELS)
def j09(spark, sf):
    return ev.compare_models(_model_table(spark, sf), use_holdout=False)


@query("j10_select_best_model", f"SELECT * FROM ({_MODELS}) ORDER BY cost, model LIMIT 1")
def j10(spark, sf):
    return ev.select_best_model(_model_table(spark, sf), use_holdout=True)


# ------------------------------------------------------------------ K8 with events, J11, J12
ALERTS2 = f"SELECT model, device, date, CAST(p >= {THR} AS INTEGER) AS pred FROM scored2 WHERE split = 'test'"


def _subset2(spark, sf):
    return ev.subset_events(device_readings(spark, sf), _s2(spark, sf, "test"))


@query("k08_event_metrics", _match2(f"""SELECT t.model, t.device, t.date, CAST(t.p >= k.threshold AS INTEGER) AS pred
      FROM scored2 t JOIN ({K8_SQL}) k ON t.model = k.model WHERE t.split = 'test'"""))
def k08_events(spark, sf):
    full = sc.apply_optimal_thresholds(_s2(spark, sf, "val"), _s2(spark, sf, "test"), K8_BUDGETS, 0.2,
                                       readings=_subset2(spark, sf), horizon_days=H)
    return full.select("model", "tp_events", "fn_events", "fp_alerts", "roi_event", "precision_event", "recall_event")


def _evaluation(spark, sf):
    test = _s2(spark, sf, "test")
    thresholds = test.select("model").distinct().withColumn("threshold", F.lit(THR))
    return ev.final_evaluation(test, thresholds, _subset2(spark, sf), H)


_EVALUATION = f"""
SELECT b.*, CAST({THR} AS DOUBLE) AS threshold, n.total_samples, n.positive_samples, n.negative_samples,
       CAST(n.positive_samples AS DOUBLE) / n.total_samples AS positive_rate,
       e.tp_events, e.fn_events, e.fp_alerts, e.roi_event, e.precision_event, e.recall_event
FROM ({_BM2}) b JOIN (SELECT model, count(*) AS total_samples, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS positive_samples,
                             sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS negative_samples
                      FROM scored2 WHERE split = 'test' GROUP BY 1) n ON b.model = n.model
LEFT JOIN ({_match2(ALERTS2)}) e ON b.model = e.model"""


@query("j11_final_evaluation", _EVALUATION)
def j11(spark, sf):
    return _evaluation(spark, sf)


# the fold table: cost and recall of the first model by day of the validation period
@query("j12_final_summary", f"""
WITH cv AS (SELECT date, sum(CASE WHEN y = 1 AND NOT p >= {THR} THEN 4 WHEN y <> 1 AND p >= {THR} THEN 1 ELSE 0 END) AS cost
            FROM scored WHERE split = 'val' GROUP BY 1)
SELECT v.model, a.auc, a.ap, v.threshold, v.cost, v.roi_event, v.precision_event, v.recall_event,
       CAST(coalesce(v.precision_event, 0) >= 0.02 AS INTEGER) AS passes, v.tn, v.fp, v.fn, v.tp,
       {', '.join(f"(SELECT {f}(date) FROM scored WHERE split = '{s}') AS {s}_{n}" for s in ('train', 'val', 'test') for f, n in (('min', 'start'), ('max', 'end')))},
       1 AS purge_days, {len(FEATS)} AS n_features,
       (SELECT avg(cost) FROM cv) AS cv_cost_mean, (SELECT stddev_samp(cost) FROM cv) AS cv_cost_std,
       (SELECT count(*) FROM (SELECT corr(attribute{1}, y) AS r FROM scored s JOIN device_readings d ON s.device = d.device AND s.date = d.date)
        WHERE abs(r) > 0.8) AS data_leakage_check
FROM ({_EVALUATION}) v JOIN ({_AP2}) a ON v.model = a.model""")
def j12(spark, sf):
    first = _s(spark, sf)
    folds = sc.cost_at_threshold(first.where("split = 'val'").withColumnRenamed("date", "fold"), THR, group_cols=["fold"]).select("fold", "cost")
    table = first.select("device", "date", "y").join(device_readings(spark, sf).select("device", "date", "attribute1"), ["device", "date"])
    suspicious = st.leakage_check(table, "y", 0.8)
    ranking = sc.ranking_metrics(_s2(spark, sf, "test"), group_cols=["model"])
    return ev.final_summary(_evaluation(spark, sf), ranking, first, len(FEATS), FIXTURE_PURGE, cv=folds, leakage=suspicious)
