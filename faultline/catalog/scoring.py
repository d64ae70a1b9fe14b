"""Score / threshold / metric queries (I9, K1-K9, B26, H3, E18, J4-J7, J13, J14) over the
deterministic ``scored`` fixture.  Oracles evaluate thresholds by brute force (every
candidate against every row), independent of the Spark prefix-sum plan."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from faultline.operators import scoring as sc
from faultline.registry import query
from faultline.sources.fixtures import scored

THR = 0.3          # decision threshold used by the fixture reports (the source's chosen value)
K2_BUDGETS = (0.01, 0.02, 0.03, 0.05)
K4_BUDGETS = (0.001, 0.002, 0.005, 0.0075, 0.01, 0.015, 0.02)
K8_BUDGETS = (0.01, 0.015, 0.02, 0.03)
K9_BUDGETS = (0.002, 0.005, 0.01, 0.02, 0.03, 0.05)


def _lits(xs):
    return "[" + ", ".join(repr(float(x)) for x in xs) + "]::DOUBLE[]"


def _s(spark, sf, split=None):
    d = scored(spark, sf)
    return d.where(F.col("split") == split) if split else d


def _s2(spark, sf, split=None):
    d = scored(spark, sf, two_models=True)
    return d.where(F.col("split") == split) if split else d


def _counts_sql(cands: str, rows: str, keys: str, join_on: str = "TRUE") -> str:
    """Brute-force confusion counts of every candidate threshold against every row."""
    return f"""SELECT {keys}, c.thr,
  sum(CASE WHEN r.p >= c.thr AND r.y = 1 THEN 1 ELSE 0 END) AS tp,
  sum(CASE WHEN r.p >= c.thr AND r.y <> 1 THEN 1 ELSE 0 END) AS fp,
  sum(CASE WHEN NOT (r.p >= c.thr) AND r.y = 1 THEN 1 ELSE 0 END) AS fn,
  sum(CASE WHEN NOT (r.p >= c.thr) AND r.y <> 1 THEN 1 ELSE 0 END) AS tn
FROM ({cands}) c JOIN ({rows}) r ON {join_on} GROUP BY ALL"""


def _metrics_sql(inner: str) -> str:
    return f"""SELECT *, tp + fp + fn + tn AS n, 4 * fn + fp AS cost,
  CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
  CAST(tp + fp AS DOUBLE) / (tp + fp + fn + tn) AS alert_rate FROM ({inner})"""


def _budget_cands_sql(budgets, rows: str) -> str:
    probs = [1.0 - b for b in budgets]
    return f"""SELECT unnest(range(0, {len(budgets)})) AS budget_idx, unnest({_lits(budgets)}) AS budget,
  unnest(q) AS thr FROM (SELECT quantile_cont(p, {_lits(probs)}) AS q FROM ({rows}))"""


VAL = "SELECT * FROM scored WHERE split = 'val'"
TEST = "SELECT * FROM scored WHERE split = 'test'"


# ------------------------------------------------------------------ I9
_RANK = """
WITH s AS (SELECT split, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
           FROM scored GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY split ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY split ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos) OVER (PARTITION BY split) AS PP, sum(neg) OVER (PARTITION BY split) AS NN FROM s)
SELECT split, CASE WHEN max(PP) > 0 THEN sum(CAST(pos AS DOUBLE) / PP * (CAST(cp AS DOUBLE) / (cp + cn))) END AS ap,
       CASE WHEN max(PP) > 0 AND max(NN) > 0 THEN sum(neg * ((cp - pos) + 0.5 * pos)) / (max(PP) * max(NN)) END AS auc,
       max(PP) AS n_pos, max(NN) AS n_neg
FROM c GROUP BY split"""


@query("i09_ranking_metrics", _RANK)
def i09(spark, sf):
    return sc.ranking_metrics(_s(spark, sf), group_cols=["split"])


# ------------------------------------------------------------------ K1-K7
@query("k01_threshold_for_rate", """
WITH s AS (SELECT split, p, count(*) AS c FROM scored GROUP BY 1, 2),
cum AS (SELECT *, sum(c) OVER (PARTITION BY split ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cc,
               sum(c) OVER (PARTITION BY split) AS n FROM s)
SELECT split, coalesce(max(CASE WHEN CAST(cc AS DOUBLE) / n >= 0.05 THEN p END), max(p)) AS thr FROM cum GROUP BY split""")
def k01(spark, sf):
    return sc.threshold_for_rate(_s(spark, sf), 0.05, group_cols=["split"])


@query("k02_tune_alert_budget", f"""
SELECT budget, thr, cost, tn, fp, fn, tp FROM (
  SELECT *, row_number() OVER (ORDER BY cost, budget_idx) AS rk FROM (
    {_metrics_sql(_counts_sql(_budget_cands_sql(K2_BUDGETS, VAL), VAL, "c.budget_idx, c.budget"))}))
WHERE rk = 1""")
def k02(spark, sf):
    return sc.tune_alert_budget(_s(spark, sf, "val"), K2_BUDGETS)


_GRID = f"SELECT unnest({_lits([i * 0.01 for i in range(101)])}) AS thr"


@query("k03_threshold_min_cost", f"""
SELECT thr, cost FROM (SELECT *, row_number() OVER (ORDER BY cost, thr) AS rk FROM (
  {_metrics_sql(_counts_sql(_GRID, VAL, "1 AS one"))})) WHERE rk = 1""")
def k03(spark, sf):
    return sc.threshold_min_cost(_s(spark, sf, "val"))


@query("k04_tune_budget_min_precision", f"""
SELECT budget, thr AS threshold, cost, recall, precision, tp + fp AS alerts FROM (
  SELECT *, row_number() OVER (ORDER BY cost, budget_idx) AS rk FROM (
    {_metrics_sql(_counts_sql(_budget_cands_sql(K4_BUDGETS, VAL), VAL, "c.budget_idx, c.budget"))})
  WHERE precision >= 0.2) WHERE rk = 1""")
def k04(spark, sf):
    return sc.tune_budget_min_precision(_s(spark, sf, "val"), K4_BUDGETS, 0.2)


# per model, at a precision that one of the two reaches
_K4_SQL = f"""
WITH b AS (SELECT model, unnest(range(0, {len(K4_BUDGETS)})) AS budget_idx, unnest({_lits(K4_BUDGETS)}) AS budget, unnest(q) AS thr
           FROM (SELECT model, quantile_cont(p, {_lits([1.0 - b for b in K4_BUDGETS])}) AS q FROM scored2 WHERE split = 'val' GROUP BY model))
SELECT model, budget, thr AS threshold, cost, recall, precision, tp + fp AS alerts FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost, budget_idx) AS rk FROM (
    {_metrics_sql(_counts_sql("SELECT * FROM b", "SELECT * FROM scored2 WHERE split = 'val'", "c.model, c.budget_idx, c.budget", "c.model = r.model"))})
  WHERE precision >= 0.1) WHERE rk = 1"""


@query("k04_budget_per_model", _K4_SQL)
def k04_models(spark, sf):
    return sc.tune_budget_min_precision(_s2(spark, sf, "val"), K4_BUDGETS, 0.1, group_cols=["model"])


_K5_PROBS = [float(x) for x in np.linspace(0, 1, 201)]


@query("k05_threshold_cost_or_budget", f"""
WITH cands AS (SELECT DISTINCT thr FROM (SELECT unnest(q) AS thr FROM (SELECT quantile_cont(p, {_lits(_K5_PROBS)}) AS q FROM ({VAL}))
                                   UNION ALL SELECT 0.0 UNION ALL SELECT 1.0)),
m AS ({_metrics_sql(_counts_sql("SELECT thr FROM cands", VAL, "1 AS one"))}),
best AS (SELECT * FROM (SELECT *, row_number() OVER (ORDER BY cost, thr) AS rk FROM m) WHERE rk = 1),
fb AS (SELECT quantile_cont(p, {repr(1.0 - 0.05)}::DOUBLE) AS t FROM ({VAL})),
fbr AS (SELECT CAST(sum(CASE WHEN r.p >= fb.t THEN 1 ELSE 0 END) AS DOUBLE) / count(*) AS rate FROM ({VAL}) r, fb GROUP BY fb.t)
SELECT CASE WHEN best.alert_rate > 0.05 THEN fb.t ELSE best.thr END AS thr,
       CASE WHEN best.alert_rate > 0.05 THEN 0.05 ELSE best.alert_rate END AS alert_rate,
       CASE WHEN best.alert_rate > 0.05 THEN 'budget_fallback' ELSE 'cost_optimal' END AS mode,
       CASE WHEN best.alert_rate > 0.05 THEN fbr.rate ELSE best.alert_rate END AS realized_rate
FROM best, fb, fbr""")
def k05(spark, sf):
    return sc.threshold_cost_or_budget(_s(spark, sf, "val"), 0.05)


_K6_PROBS = [float(x) for x in np.linspace(0.90, 1.0, 200)]


@query("k06_threshold_min_precision", f"""
WITH cands AS (SELECT DISTINCT thr FROM (SELECT unnest(q) AS thr FROM (SELECT quantile_cont(p, {_lits(_K6_PROBS)}) AS q FROM ({VAL}))
                                   UNION ALL SELECT max(p) FROM ({VAL}))),
m AS ({_metrics_sql(_counts_sql("SELECT thr FROM cands", VAL, "1 AS one"))}),
pick AS (SELECT coalesce((SELECT max(thr) FROM m WHERE precision >= 0.2),
                         (SELECT thr FROM m ORDER BY precision DESC, thr DESC LIMIT 1)) AS thr)
SELECT m.thr, m.alert_rate FROM m JOIN pick ON m.thr = pick.thr""")
def k06(spark, sf):
    return sc.threshold_min_precision(_s(spark, sf, "val"), 0.2)


@query("k07_cost_at_threshold", f"""
SELECT split, sum(CASE WHEN y <> 1 AND NOT p >= {THR} THEN 1 ELSE 0 END) AS tn,
       sum(CASE WHEN y <> 1 AND p >= {THR} THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN y = 1 AND NOT p >= {THR} THEN 1 ELSE 0 END) AS fn,
       sum(CASE WHEN y = 1 AND p >= {THR} THEN 1 ELSE 0 END) AS tp,
       4 * sum(CASE WHEN y = 1 AND NOT p >= {THR} THEN 1 ELSE 0 END) + sum(CASE WHEN y <> 1 AND p >= {THR} THEN 1 ELSE 0 END) AS cost
FROM scored GROUP BY split""")
def k07(spark, sf):
    return sc.cost_at_threshold(_s(spark, sf), THR, group_cols=["split"])


@query("b26_apply_threshold", f"SELECT device, date, y, p, CAST(p >= {THR} AS INTEGER) AS pred FROM ({TEST})")
def b26(spark, sf):
    return sc.apply_threshold(_s(spark, sf, "test").select("device", "date", "y", "p"), THR)


@query("h03_topk_alerts", f"""
SELECT device, date, y, p, CASE WHEN row_number() OVER (ORDER BY p DESC, device, date) <= 10 THEN 1 ELSE 0 END AS pred
FROM ({TEST})""")
def h03(spark, sf):
    return sc.topk_alerts(_s(spark, sf, "test").select("device", "date", "y", "p"), 10)


_E18 = [0.0, 0.5, 0.9, 0.95, 0.99, 0.995, 0.999, 1.0]


@query("e18_score_profile", f"""
SELECT split, unnest({_lits(_E18)}) AS q, unnest(v) AS value
FROM (SELECT split, quantile_cont(p, {_lits(_E18)}) AS v FROM scored GROUP BY split)""")
def e18(spark, sf):
    return sc.score_profile(_s(spark, sf), group_cols=["split"])


# ------------------------------------------------------------------ J4-J7, J13, J14 (two models)
_CM2 = f"""SELECT model, sum(CASE WHEN y <> 1 AND NOT p >= {THR} THEN 1 ELSE 0 END) AS tn,
       sum(CASE WHEN y <> 1 AND p >= {THR} THEN 1 ELSE 0 END) AS fp,
       sum(CASE WHEN y = 1 AND NOT p >= {THR} THEN 1 ELSE 0 END) AS fn,
       sum(CASE WHEN y = 1 AND p >= {THR} THEN 1 ELSE 0 END) AS tp
FROM scored2 WHERE split = 'test' GROUP BY model"""


def _pred2(spark, sf):
    return sc.apply_threshold(_s2(spark, sf, "test"), THR)


@query("j04_confusion_matrix", _CM2)
def j04(spark, sf):
    return sc.confusion(_pred2(spark, sf), group_cols=["model"])


_AP2 = """
WITH s AS (SELECT model, p, sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS pos, sum(CASE WHEN y = 1 THEN 0 ELSE 1 END) AS neg
           FROM scored2 WHERE split = 'test' GROUP BY 1, 2),
c AS (SELECT *, sum(pos) OVER (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cp,
             sum(neg) OVER (PARTITION BY model ORDER BY p DESC ROWS UNBOUNDED PRECEDING) AS cn,
             sum(pos) OVER (PARTITION BY model) AS PP, sum(neg) OVER (PARTITION BY model) AS NN FROM s)
SELECT model, CASE WHEN max(PP) > 0 THEN sum(CAST(pos AS DOUBLE) / PP * (CAST(cp AS DOUBLE) / (cp + cn))) END AS ap,
       CASE WHEN max(PP) > 0 AND max(NN) > 0 THEN sum(neg * ((cp - pos) + 0.5 * pos)) / (max(PP) * max(NN)) END AS auc
FROM c GROUP BY model"""

_BM2 = f"""
SELECT cm.model, a.ap AS auc_pr,
  CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall_h,
  CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp) AS alert_rate, 4 * fn + fp AS cost,
  4 * (tp + fn) - (4 * fn + fp) AS economy, tn, fp, fn, tp
FROM ({_CM2}) cm JOIN ({_AP2}) a ON cm.model = a.model"""


@query("j05_business_metrics", _BM2)
def j05(spark, sf):
    return sc.business_metrics(_pred2(spark, sf), group_cols=["model"])


@query("j06_j07_break_even", f"""
SELECT model, tn, fp, fn, tp, roi_abs, roi_pct, 0.2 AS min_precision, prec AS precision,
       CAST(prec >= 0.2 AS INTEGER) AS passes,
       CASE WHEN prec < 0.2 THEN CAST(ceil(fp / 4.0::DOUBLE) AS BIGINT) END AS needed_tp,
       CASE WHEN prec < 0.2 THEN greatest(0, CAST(ceil(fp / 4.0::DOUBLE) AS BIGINT) - tp) END AS missing_tp
FROM (SELECT model, tn, fp, fn, tp, (tp + fn) * 100000 - (fn * 100000 + fp * 25000) AS roi_abs,
             CASE WHEN (tp + fn) * 100000 > 0 THEN 1 - CAST(fn * 100000 + fp * 25000 AS DOUBLE) / ((tp + fn) * 100000) ELSE 0.0 END AS roi_pct,
             CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS prec
      FROM ({_CM2}))""")
def j07(spark, sf):
    return sc.break_even(sc.confusion(_pred2(spark, sf), group_cols=["model"]))


@query("j13_cost_sensitivity", f"""
SELECT model, r AS cost_ratio, r * fn + fp AS cost,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall
FROM ({_CM2}), (SELECT unnest([2, 3, 4, 5, 6]) AS r)""")
def j13(spark, sf):
    return sc.cost_sensitivity(sc.confusion(_pred2(spark, sf), group_cols=["model"]), group_cols=["model"])


_FN = f"SELECT * FROM scored WHERE split = 'test' AND y = 1 AND NOT p >= {THR}"


@query("j14_fn_by_weekday", f"SELECT isodow(date) - 1 AS weekday, count(*) AS n FROM ({_FN}) GROUP BY 1")
def j14a(spark, sf):
    return sc.false_negative_profile(sc.apply_threshold(_s(spark, sf, "test"), THR))["by_weekday"]


@query("j14_fn_top_devices", f"SELECT device, count(*) AS n FROM ({_FN}) GROUP BY 1 ORDER BY n DESC, device LIMIT 10")
def j14b(spark, sf):
    return sc.false_negative_profile(sc.apply_threshold(_s(spark, sf, "test"), THR))["top_devices"]


@query("j14_fn_period", f"SELECT count(*) AS n, min(date) AS first_date, max(date) AS last_date FROM ({_FN})")
def j14c(spark, sf):
    return sc.false_negative_profile(sc.apply_threshold(_s(spark, sf, "test"), THR))["period"]


# ------------------------------------------------------------------ K8, K9
_VAL2 = "SELECT * FROM scored2 WHERE split = 'val'"
_TEST2 = "SELECT * FROM scored2 WHERE split = 'test'"


K8_SQL = f"""
WITH bq AS (SELECT model, unnest(range(0, {len(K8_BUDGETS)})) AS budget_idx, unnest({_lits(K8_BUDGETS)}) AS budget, unnest(q) AS thr
            FROM (SELECT model, quantile_cont(p, {_lits([1.0 - b for b in K8_BUDGETS])}) AS q FROM ({_VAL2}) GROUP BY model)),
k4 AS (SELECT model, thr AS t4, budget AS b4 FROM (
         SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost, budget_idx) AS rk FROM (
           {_metrics_sql(_counts_sql("SELECT * FROM bq", _VAL2, "c.model, c.budget_idx, c.budget", "c.model = r.model"))})
         WHERE precision >= 0.2) WHERE rk = 1),
grid AS (SELECT m.model, g.thr FROM (SELECT DISTINCT model FROM ({_VAL2})) m, ({_GRID}) g),
k3 AS (SELECT model, thr AS t3 FROM (SELECT *, row_number() OVER (PARTITION BY model ORDER BY cost, thr) AS rk FROM (
         {_metrics_sql(_counts_sql("SELECT * FROM grid", _VAL2, "c.model", "c.model = r.model"))})) WHERE rk = 1),
ch AS (SELECT k3.model, coalesce(k4.t4, k3.t3) AS threshold, coalesce(k4.b4, 0.01) AS applied_budget
       FROM k3 LEFT JOIN k4 ON k3.model = k4.model),
t AS (SELECT r.*, CAST(coalesce(r.p >= ch.threshold, false) AS INTEGER) AS pred FROM ({_TEST2}) r JOIN ch ON r.model = ch.model),
cm AS (SELECT model, sum(CASE WHEN y <> 1 AND pred = 0 THEN 1 ELSE 0 END) AS tn, sum(CASE WHEN y <> 1 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn, sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp
       FROM t GROUP BY model)
SELECT cm.model, a.ap AS auc_pr, CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall_h,
       CAST(tp + fp AS DOUBLE) / (tn + fp + fn + tp) AS alert_rate, 4 * fn + fp AS cost, 4 * (tp + fn) - (4 * fn + fp) AS economy,
       tn, fp, fn, tp, ch.threshold, ch.applied_budget
FROM cm JOIN ({_AP2}) a ON cm.model = a.model JOIN ch ON cm.model = ch.model"""


@query("k08_apply_optimal_thresholds", K8_SQL)
def k08(spark, sf):
    return sc.apply_optimal_thresholds(_s2(spark, sf, "val"), _s2(spark, sf, "test"), K8_BUDGETS, 0.2)


K9_SQL = f"""
SELECT budget, thr, cost, precision, recall, alert_rate,
       CAST(precision >= 0.2 AND alert_rate <= budget AS INTEGER) AS kept
FROM ({_metrics_sql(_counts_sql(_budget_cands_sql(K9_BUDGETS, VAL), TEST, "c.budget_idx, c.budget"))})"""


@query("k09_budget_sweep", K9_SQL)
def k09(spark, sf):
    return sc.budget_sweep(_s(spark, sf, "val"), _s(spark, sf, "test"), K9_BUDGETS, 0.2)


@query("k09_best_budget", f"""
SELECT budget, thr, cost, precision, recall, alert_rate FROM ({K9_SQL}) WHERE kept = 1 ORDER BY cost, budget LIMIT 1""")
def k09_best(spark, sf):
    return sc.best_budget(sc.budget_sweep(_s(spark, sf, "val"), _s(spark, sf, "test"), K9_BUDGETS, 0.2))


# with a demand that two budgets meet
@query("k09_best_budget_reached", f"""
SELECT budget, thr, cost, precision, recall, alert_rate FROM ({K9_SQL}) WHERE precision >= 0.05 AND alert_rate <= budget ORDER BY cost, budget LIMIT 1""")
def k09_reached(spark, sf):
    return sc.best_budget(sc.budget_sweep(_s(spark, sf, "val"), _s(spark, sf, "test"), K9_BUDGETS, 0.05))
