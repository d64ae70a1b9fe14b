"""Model and I/O queries.

Model fits are Spark ML jobs whose scores are not reproducible in SQL, so most entries here
have no oracle (rows-only check).  The AP-weighted ensemble over the deterministic fixture
scores and the write/read round trips do have one.  Round trips write under the shared
``spark.checkpoint.dir`` (one fresh folder per call)."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import functions as F

from faultline.catalog.devices import H
from faultline.catalog.offers import _kpi_sql
from faultline.catalog.scoring import _s, _s2
from faultline.operators import events as ev, features as fe, kpis, labels as lb, ml, offers as ob
from faultline.registry import query
from faultline.session import ensure_checkpoint_dir, materialize
from faultline.sources import io
from faultline.sources.fixtures import FIXTURE_PURGE, FIXTURE_SIZE, device_readings, offers

TARGET = "early_warn_target"
#: Bounds of the other registered trainings (``_boosted_scores`` has none); the operators' own defaults are the
#: source's counts (1,000 and 1,500 rounds with a stop after 10 without a lower loss, 800 in the
#: cross-validation).  The README has measured seconds.  The ensembles' models, which stop by validation, the
#: quick ones of the ratios, and the folds':
STOPPED_ROUNDS, RATIO_ROUNDS, CV_ROUNDS = 12, 4, 8
#: Trees of their feature selection, and the source's count (its trees are boosted ones).
SELECTION_TREES, SOURCE_TREES = 20, 400


def _scratch(spark, name):
    return os.path.join(ensure_checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex}")


def _features(spark, sf):
    # the feature table feeds several fits: written once to the shared checkpoint folder
    return materialize(fe.device_features(device_readings(spark, sf), forecast_horizon=H, newest_first=True), "features")


def _prepared(spark, sf, k=80, impute=False, num_trees=SELECTION_TREES):
    table, feats = ml.prepare_dataset(_features(spark, sf), TARGET, FIXTURE_PURGE, FIXTURE_SIZE,
                                      FIXTURE_SIZE, k=k, num_trees=num_trees, impute=impute)
    return materialize(table, "prepared"), feats


def _split(table, name):
    return table.where(F.col("split") == name)


# ------------------------------------------------------------------ A2-A7
_RAW_OFFER_COLS = ["OFFER_START_DATE", "OFFER_START_DTTM", "OFFER_FINISH_DTTM", "OFFER_TYPE", "VERTICAL",
                   "DOMAIN_ID", "DOM_DOMAIN_AGG1", "SHIPPING_PAYMENT_TYPE", "ORIGIN", "INVOLVED_STOCK",
                   "REMAINING_STOCK_AFTER_END", "SOLD_AMOUNT", "SOLD_QUANTITY"]


@query("a02_load_offers_csv", f"""
SELECT CAST(OFFER_START_DATE AS TIMESTAMP) AS OFFER_START_DATE, OFFER_START_DTTM, OFFER_FINISH_DTTM,
       {', '.join(_RAW_OFFER_COLS[3:])} FROM offers""")
def a02(spark, sf):
    path = _scratch(spark, "offers-csv")
    offers(spark, sf).select(*_RAW_OFFER_COLS).write.option("header", True).csv(path)
    return io.load_offers(spark, path)


@query("a03_negative_remaining", "SELECT sum(CASE WHEN REMAINING_STOCK_AFTER_END < 0 THEN 1 ELSE 0 END) AS n_negative FROM offers")
def a03(spark, sf):
    return io.negative_remaining(io.coerce_types(offers(spark, sf)))


@query("a04_a07_metrics_roundtrip", f"SELECT *, 'fixture' AS run_id FROM ({_kpi_sql(['VERTICAL'], 'WHERE VERTICAL IS NOT NULL')})")
def a04(spark, sf):
    path = _scratch(spark, "metrics")
    rid = io.save_metrics(kpis.kpi_summary(ob.offer_features(offers(spark, sf)), "VERTICAL"), path, "fixture")
    return io.load_metrics(spark, path, rid)


@query("a05_a06_model_roundtrip")
def a05(spark, sf):
    """The ensemble of I10 saved under its name, loaded by name and applied to the test rows."""
    table, feats = _prepared(spark, sf)
    models = {}
    _, thresholds, _ = ml.train_evaluate(table, feats, TARGET, max_iter=STOPPED_ROUNDS, models=models)
    thr = {r["model"]: r["threshold"] for r in thresholds.collect()}            # one row per model
    members = {name: io.Member(m, thr[name], curves, 5, 0.5) for name, (m, curves) in models.items()}
    path = _scratch(spark, "bundles")
    io.save_bundle(spark, io.Bundle(ml.ENSEMBLE, feats, members, thr[ml.ENSEMBLE], TARGET), path)
    return io.load_bundle(spark, path, ml.ENSEMBLE).score(_split(table, "test"))


# ------------------------------------------------------------------ I1-I11
@query("i01_prepare_dataset")
def i01(spark, sf):
    return _prepared(spark, sf, impute=True)[0]


@query("i02_select_top_features")
def i02(spark, sf):
    f = _features(spark, sf)
    from faultline.operators.labels import temporal_split
    train = temporal_split(f, FIXTURE_PURGE, FIXTURE_SIZE, FIXTURE_SIZE).where(F.col("split") == "train")
    return ml.select_top_features(train, ml.feature_columns(f, TARGET), TARGET, k=80, num_trees=SELECTION_TREES)


def _boosted_scores(spark, sf):
    # the source's counts: a selection of 400 trees, 1,000 rounds unless the validation rows stop them
    table, feats = _prepared(spark, sf, num_trees=SOURCE_TREES)
    m = ml.train_boosted(_split(table, "train"), feats, TARGET, "A", validation=_split(table, "val_model"))
    return table, feats, m


@query("i03_train_boosted")
def i03(spark, sf):
    table, feats, m = _boosted_scores(spark, sf)
    return ml.score(m, _split(table, "test"), feats, TARGET, "GBT_A")


@query("i04_calibrate_isotonic")
def i04(spark, sf):
    table, feats, m = _boosted_scores(spark, sf)
    cal = ml.score(m, _split(table, "val_model"), feats, TARGET, "GBT_A")
    return ml.calibrate(cal, ml.score(m, _split(table, "test"), feats, TARGET, "GBT_A"))


@query("i05_timeaware_calibration")
def i05(spark, sf):
    table, feats, m = _boosted_scores(spark, sf)
    # both score tables are read more than once: written once to the checkpoint folder
    val = materialize(ml.score(m, table.where(F.col("split").isin("val_model", "val_hold")), feats, TARGET, "GBT_A"), "val")
    test = materialize(ml.score(m, _split(table, "test"), feats, TARGET, "GBT_A"), "test")
    return ml.timeaware_calibration(val, test)[1]


# The same calibrations of the fixture's scores, which SQL can follow: the curve at a score is the largest,
# over all starts up to it, of the least mean of the stretches that begin there and reach it.
def _curve_sql(cells: str, key: str = "1") -> str:
    return f"""(WITH n AS (SELECT fit, x, w, s, row_number() OVER o AS i, sum(w) OVER o AS cw, sum(s) OVER o AS cs
                  FROM ({cells}) WINDOW o AS (PARTITION BY fit ORDER BY x ROWS UNBOUNDED PRECEDING)),
    m AS (SELECT a.fit, a.i AS a, b.i AS b, b.x, CAST(b.cs - a.cs + a.s AS DOUBLE) / (b.cw - a.cw + a.w) AS mean FROM n a JOIN n b ON a.fit = b.fit AND b.i >= a.i),
    r AS (SELECT fit, a, x, min(mean) OVER (PARTITION BY fit, a ORDER BY b DESC ROWS UNBOUNDED PRECEDING) AS least FROM m)
    SELECT fit, x, max(least) AS v FROM r GROUP BY fit, x)"""


def _through_sql(rows: str, curve: str) -> str:
    """Rows (fit, p, ...) with ``cal``, linear between the curve's corners."""
    return f"""(SELECT t.*, CASE WHEN l.x IS NULL THEN r.v WHEN r.x IS NULL OR l.x = r.x THEN l.v
                                 ELSE (r.v - l.v) / (r.x - l.x) * (t.p - l.x) + l.v END AS cal
    FROM ({rows}) t ASOF LEFT JOIN {curve} l ON t.fit = l.fit AND t.p >= l.x ASOF LEFT JOIN {curve} r ON t.fit = r.fit AND t.p <= r.x)"""


@query("i04_isotonic_fixture", f"""
WITH curve AS MATERIALIZED {_curve_sql("SELECT 1 AS fit, p AS x, count(*) AS w, sum(y) AS s FROM scored WHERE split = 'val' GROUP BY p")}
SELECT device, date, y, cal AS p FROM {_through_sql("SELECT 1 AS fit, device, date, y, p FROM scored WHERE split = 'test'", "curve")}""")
def i04_fixture(spark, sf):
    return ml.calibrate(_s(spark, sf, "val"), _s(spark, sf, "test").select("device", "date", "y", "p"))


@query("i05_timeaware_fixture", f"""
WITH v AS (SELECT device, date, y, p, row_number() OVER (ORDER BY device, date) - 1 AS pos, count(*) OVER () AS n FROM scored WHERE split = 'val'),
folded AS MATERIALIZED (SELECT device, date, y, p, CASE WHEN pos < (n % 5) * (n // 5 + 1) THEN pos // (n // 5 + 1)
                              ELSE n % 5 + (pos - (n % 5) * (n // 5 + 1)) // (n // 5) END AS fold FROM v),
curve AS MATERIALIZED {_curve_sql("SELECT k.f AS fit, p AS x, count(*) AS w, sum(y) AS s FROM folded, range(5) k(f) WHERE fold <> k.f GROUP BY 1, 2")}
SELECT device, date, y, 'val' AS split, cal AS p FROM {_through_sql("SELECT fold AS fit, device, date, y, p FROM folded", "curve")}
UNION ALL
SELECT device, date, y, 'test' AS split, avg(cal) AS p
FROM {_through_sql("SELECT k.f AS fit, device, date, y, p FROM scored, range(5) k(f) WHERE split = 'test'", "curve")} GROUP BY 1, 2, 3""")
def i05_fixture(spark, sf):
    cols = ["device", "date", "y", "p"]
    val, test = ml.timeaware_calibration(_s(spark, sf, "val").select(*cols), _s(spark, sf, "test").select(*cols))
    return val.select(*cols, F.lit("val").alias("split")).unionByName(test.select(*cols, F.lit("test").alias("split")))


# average precision as the mean, over the positives, of the share of positives among rows scored as high
_ENS = """
WITH r AS (SELECT model, y, sum(y) OVER w AS tp, count(*) OVER w AS n FROM scored2 WHERE split = 'val'
           WINDOW w AS (PARTITION BY model ORDER BY p DESC RANGE UNBOUNDED PRECEDING)),
ap AS (SELECT model, coalesce(avg(CAST(tp AS DOUBLE) / n) FILTER (WHERE y = 1), 0.0) + 1e-9 AS w FROM r GROUP BY 1)
SELECT t.device, t.date, t.y, sum(t.p * ap.w) / (SELECT sum(w) FROM ap) AS p, 'EnsembleAvg' AS model
FROM scored2 t JOIN ap ON t.model = ap.model WHERE t.split = 'test' GROUP BY 1, 2, 3"""


@query("i06_ensemble_by_ap", _ENS)
def i06(spark, sf):
    return ml.ensemble_by_ap(_s2(spark, sf, "val"), _s2(spark, sf, "test"))


@query("i07_rolling_origin_cv")
def i07(spark, sf):
    f = _features(spark, sf)
    return ml.rolling_origin_cv(f, TARGET, 3, FIXTURE_PURGE, max_iter=CV_ROUNDS, num_trees=SELECTION_TREES)[1]


# the three splits of the fixture's scores as folds
_FOLDS = "SELECT CASE split WHEN 'train' THEN 1 WHEN 'val' THEN 2 ELSE 3 END AS fold, y, p FROM scored"
_FOLD_REPORT = f"""
WITH s AS (SELECT * FROM ({_FOLDS})),
t AS (SELECT fold, quantile_cont(p, 0.95) AS thr FROM s GROUP BY 1),
c AS (SELECT s.fold, sum(CASE WHEN y = 1 AND p < thr THEN 4 WHEN y <> 1 AND p >= thr THEN 1 ELSE 0 END) AS cost,
             CAST(sum(CASE WHEN y = 1 AND p >= thr THEN 1 ELSE 0 END) AS DOUBLE) / sum(y) AS recall FROM s JOIN t ON s.fold = t.fold GROUP BY 1),
ranked AS (SELECT fold, y, sum(y) OVER w AS tp, count(*) OVER w AS n FROM s WINDOW w AS (PARTITION BY fold ORDER BY p DESC RANGE UNBOUNDED PRECEDING)),
ap AS (SELECT fold, avg(CAST(tp AS DOUBLE) / n) AS ap FROM ranked WHERE y = 1 GROUP BY 1)
SELECT c.fold, cost, ap, recall FROM c JOIN ap ON c.fold = ap.fold"""


def _fold_scores(spark, sf):
    fold = F.when(F.col("split") == "train", 1).when(F.col("split") == "val", 2).otherwise(3)
    return _s(spark, sf).select(fold.alias("fold"), "y", "p")


@query("i07_fold_report", _FOLD_REPORT)
def i07_folds(spark, sf):
    return ml.fold_summary(_fold_scores(spark, sf))[0]


@query("i07_fold_summary", f"""
SELECT avg(cost) AS mean_cost, avg(ap) AS mean_ap, avg(recall) AS mean_recall, stddev_samp(cost) AS std_cost, stddev_samp(ap) AS std_ap,
       stddev_samp(recall) AS std_recall, min(cost) AS best_cost, first(fold ORDER BY cost, fold) AS best_fold FROM ({_FOLD_REPORT})""")
def i07_summary(spark, sf):
    return ml.fold_summary(_fold_scores(spark, sf))[1]


@query("i08_tune_neg_per_pos")
def i08(spark, sf):
    table, feats = _prepared(spark, sf)
    cols = ["device", "date", TARGET, *feats]
    return ml.tune_neg_per_pos(_split(table, "train").select(*cols),
                               table.where(F.col("split").isin("val_model", "val_hold")).select(*cols), TARGET, max_iter=RATIO_ROUNDS)


# two models' validation scores stand for two ratios
@query("i08_ratio_report", f"""
WITH s AS (SELECT CASE model WHEN 'm1' THEN 6 ELSE 8 END AS ratio, y, p FROM scored2 WHERE split = 'val'),
c AS (SELECT ratio, unnest(quantile_cont(p, {[i / 200 for i in range(201)]}::DOUBLE[])) AS thr FROM s GROUP BY 1
      UNION SELECT DISTINCT ratio, unnest([0.0, 1.0]) FROM s),
k AS (SELECT c.ratio, thr, sum(CASE WHEN y = 1 AND p >= thr THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y <> 1 AND p >= thr THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = 1 AND p < thr THEN 1 ELSE 0 END) AS fn, count(*) AS n FROM c JOIN s ON c.ratio = s.ratio GROUP BY 1, 2),
b AS (SELECT ratio, thr, CAST(tp + fp AS DOUBLE) / n AS rate FROM (SELECT *, row_number() OVER (PARTITION BY ratio ORDER BY 4 * fn + fp, thr) AS rk FROM k) WHERE rk = 1),
t AS (SELECT b.ratio, CASE WHEN rate > 0.05 THEN (SELECT quantile_cont(p, 1 - 0.05::DOUBLE) FROM s WHERE s.ratio = b.ratio) ELSE thr END AS thr FROM b),
r AS (SELECT t.ratio, t.thr, sum(CASE WHEN y = 1 AND p >= thr THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y <> 1 AND p >= thr THEN 1 ELSE 0 END) AS fp,
             sum(CASE WHEN y = 1 AND p < thr THEN 1 ELSE 0 END) AS fn FROM t JOIN s ON t.ratio = s.ratio GROUP BY 1, 2)
SELECT ratio AS neg_per_pos, thr, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision, CAST(4 * fn + fp AS DOUBLE) AS cost,
       CAST(row_number() OVER (ORDER BY 4 * fn + fp, ratio) = 1 AS INTEGER) AS best FROM r""")
def i08_report(spark, sf):
    s = _s2(spark, sf, "val")
    first = F.col("model") == "m1"
    return ml.ratio_report(s.select(F.when(first, 6).otherwise(8).alias("neg_per_pos"), F.when(first, 0).otherwise(1).alias("__i"), "y", "p"))


@query("i10_train_evaluate")
def i10(spark, sf):
    table, feats = _prepared(spark, sf)
    return ml.train_evaluate(table, feats, TARGET, max_iter=STOPPED_ROUNDS)[2]


# ------------------------------------------------------------------ I10 after the training, over fixture scores
def _chain_scores(spark, sf):
    """Two models and their ensemble; the validation rows' second half, by position, is the hold-out."""
    s = _s2(spark, sf)
    val = [lb.positional_holdout(s.where((F.col("split") == "val") & (F.col("model") == m)), 0.5) for m in ("m1", "m2")]
    held = val[0].unionByName(val[1]).withColumn("split", F.when(F.col("part") == "model", "val").otherwise("hold")).drop("part")
    return materialize(ml.with_ensemble(held.unionByName(s.where("split = 'test'"))), "chain")


CHAIN = f"""
v AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY device, date) - 1 AS pos, count(*) OVER (PARTITION BY model) AS n FROM scored2 WHERE split = 'val'),
base AS MATERIALIZED (SELECT device, date, y, p, model, CASE WHEN pos < floor(n * 0.5::DOUBLE) THEN 'val' ELSE 'hold' END AS split FROM v
         UNION ALL SELECT device, date, y, p, model, split FROM scored2 WHERE split = 'test'),
apr AS (SELECT model, y, sum(y) OVER w AS tp, count(*) OVER w AS n FROM base WHERE split = 'val' WINDOW w AS (PARTITION BY model ORDER BY p DESC RANGE UNBOUNDED PRECEDING)),
apm AS (SELECT model, avg(CAST(tp AS DOUBLE) / n) + 1e-9 AS wt FROM apr WHERE y = 1 GROUP BY 1),
chain AS MATERIALIZED (SELECT * FROM base UNION ALL
          SELECT device, date, y, sum(p * wt) / (SELECT sum(wt) FROM apm) AS p, 'EnsembleAvg' AS model, split FROM base JOIN apm ON base.model = apm.model GROUP BY device, date, y, split),
k4b AS (SELECT model, unnest(range(0, 7)) AS i, unnest([0.001, 0.002, 0.005, 0.0075, 0.01, 0.015, 0.02]::DOUBLE[]) AS budget,
               unnest(quantile_cont(p, {[1.0 - b for b in (0.001, 0.002, 0.005, 0.0075, 0.01, 0.015, 0.02)]}::DOUBLE[])) AS thr FROM chain WHERE split = 'val' AND model <> 'EnsembleAvg' GROUP BY model),
k2b AS (SELECT model, unnest(range(0, 4)) AS i, unnest([0.01, 0.015, 0.02, 0.03]::DOUBLE[]) AS budget,
               unnest(quantile_cont(p, {[1.0 - b for b in (0.01, 0.015, 0.02, 0.03)]}::DOUBLE[])) AS thr FROM chain WHERE split = 'val' AND model = 'EnsembleAvg' GROUP BY model),
counted AS (SELECT b.*, sum(CASE WHEN y = 1 AND p >= thr THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y <> 1 AND p >= thr THEN 1 ELSE 0 END) AS fp,
                   sum(CASE WHEN y = 1 AND p < thr THEN 1 ELSE 0 END) AS fn FROM (SELECT * FROM k4b UNION ALL SELECT * FROM k2b) b JOIN chain c ON b.model = c.model AND c.split = 'val' GROUP BY ALL),
best AS (SELECT *, row_number() OVER (PARTITION BY model ORDER BY 4 * fn + fp, i) AS rk FROM counted WHERE model = 'EnsembleAvg' OR CAST(tp AS DOUBLE) / (tp + fp) >= 0.1),
top AS (SELECT model, max(p) AS thr FROM chain WHERE split = 'val' GROUP BY 1),
thresholds AS MATERIALIZED (SELECT t.model, coalesce(b.thr, t.thr) AS threshold,
               coalesce(b.budget, (SELECT CAST(sum(CASE WHEN c.p >= t.thr THEN 1 ELSE 0 END) AS DOUBLE) / count(*) FROM chain c WHERE c.model = t.model AND c.split = 'val')) AS budget,
               CASE WHEN t.model = 'EnsembleAvg' THEN 'K2' WHEN b.thr IS NULL THEN 'K6' ELSE 'K4' END AS rule
        FROM top t LEFT JOIN (SELECT * FROM best WHERE rk = 1) b ON t.model = b.model),
decided AS MATERIALIZED (SELECT c.*, CAST(p >= threshold AS INTEGER) AS pred FROM chain c JOIN thresholds t ON c.model = t.model)"""


@query("i10_threshold_chain", f"WITH {CHAIN} SELECT * FROM thresholds")
def i10_chain(spark, sf):
    return ml.threshold_chain(_chain_scores(spark, sf).where("split = 'val'"), min_precision=0.1)


@query("i10_chain_predictions", f"WITH {CHAIN} SELECT device, date, y, p, model, split, pred FROM decided WHERE split <> 'val'")
def i10_predictions(spark, sf):
    return ml.evaluate_scores(_chain_scores(spark, sf), min_precision=0.1)[0].where("split <> 'val'")


# ------------------------------------------------------------------ J10 over hold-out and test
# the second model has no hold-out rows, so its figures are those of the test rows
_HOLDOUT = f"""
WITH {CHAIN},
own AS (SELECT * FROM decided WHERE split = 'hold' AND model <> 'm2' UNION ALL SELECT * FROM decided WHERE split = 'test' AND model = 'm2'),
cm AS (SELECT model, sum(CASE WHEN y = 1 AND pred = 1 THEN 1 ELSE 0 END) AS tp, sum(CASE WHEN y <> 1 AND pred = 1 THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y = 1 AND pred = 0 THEN 1 ELSE 0 END) AS fn FROM own GROUP BY 1),
pr AS (SELECT model, 4 * fn + fp AS cost, CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
              CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
              CASE WHEN 2 * tp + fp + fn > 0 THEN 2.0::DOUBLE * tp / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM cm),
test AS (SELECT * FROM decided WHERE split = 'test'),
auc AS (SELECT a.model, sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0.0 END)::DOUBLE / count(*) AS auc
        FROM test a JOIN test b ON a.model = b.model AND a.y = 1 AND b.y <> 1 GROUP BY 1),
tr AS (SELECT model, y, sum(y) OVER w AS tp, count(*) OVER w AS n FROM test WINDOW w AS (PARTITION BY model ORDER BY p DESC RANGE UNBOUNDED PRECEDING)),
tap AS (SELECT model, avg(CAST(tp AS DOUBLE) / n) AS ap FROM tr WHERE y = 1 GROUP BY 1)
SELECT pr.model, auc.auc, tap.ap, pr.cost, pr.precision, pr.recall, pr.f1, CASE WHEN pr.model = 'm2' THEN 'test_fallback' ELSE 'holdout' END AS metrics_source
FROM pr JOIN auc ON pr.model = auc.model JOIN tap ON pr.model = tap.model"""


def _holdout_pred(spark, sf):
    pred = ml.evaluate_scores(_chain_scores(spark, sf), min_precision=0.1)[0]
    return pred.where("not (split = 'hold' and model = 'm2')")


@query("j10_holdout_comparison", _HOLDOUT)
def j10_all(spark, sf):
    return ev.holdout_comparison(_holdout_pred(spark, sf))


@query("j10_best_on_holdout", f"SELECT * FROM ({_HOLDOUT}) ORDER BY cost, model LIMIT 1")
def j10_best(spark, sf):
    return ev.best_on_holdout(_holdout_pred(spark, sf))


# ------------------------------------------------------------------ A4 executive report
@query("a04_executive_summary", f"""
SELECT 'fixture' AS run_id, 'device_failure_model' AS model_name, model AS best_model, auc, ap, precision, recall, f1, CAST(cost AS DOUBLE) AS cost,
       threshold, metrics_source, 2 AS total_features, 0 AS suspicious_features
FROM (SELECT * FROM ({_HOLDOUT}) ORDER BY cost, model LIMIT 1) JOIN (WITH {CHAIN} SELECT model AS m, threshold FROM thresholds) ON model = m""")
def a04_executive(spark, sf):
    scores = _chain_scores(spark, sf)
    pred, thresholds, metrics = ml.evaluate_scores(scores, min_precision=0.1)
    best = materialize(ev.best_on_holdout(pred.where("not (split = 'hold' and model = 'm2')")).join(thresholds.select("model", "threshold"), "model"), "best")
    path = _scratch(spark, "runs")
    io.save_run(spark, path, best, metrics.join(best.select("model"), "model"), ["attribute2", "attribute4"],
                *ml.fold_summary(_fold_scores(spark, sf)), run_id="fixture")
    return io.load_executive(spark, path, "fixture").drop("file_paths")


@query("i11_feature_importance")
def i11(spark, sf):
    table, feats, m = _boosted_scores(spark, sf)
    return ml.feature_importance(m, feats)[1]


@query("b27_feature_family")
def b27(spark, sf):
    table, feats, m = _boosted_scores(spark, sf)
    return ml.feature_importance(m, feats)[0]
