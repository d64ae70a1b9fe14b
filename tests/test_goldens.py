"""Identities recomputed from the source's saved run (confusion / event counts, CV costs)."""
import math

from pyspark.sql import functions as F

from faultline.operators import events as ev, scoring as sc


def _cm(spark, tn, fp, fn, tp):
    return spark.createDataFrame([("m", tn, fp, fn, tp)], "model string, tn long, fp long, fn long, tp long")


def test_cost_economy_alert_rate(spark):
    r = sc.with_metrics(_cm(spark, 5552, 4, 28, 5)).first()
    assert r["cost"] == 116
    assert 4 * (r["tp"] + r["fn"]) - r["cost"] == 16
    assert math.isclose(r["alert_rate"], 9 / 5589, rel_tol=1e-12)
    assert math.isclose(r["recall"], 5 / 33, rel_tol=1e-12)


def test_event_roi_golden(spark):
    m = spark.createDataFrame([("d1", 1, 2, 4)], "device string, tp_events int, fn_events int, fp_alerts int")
    r = ev.event_roi(m).first()
    assert r["roi_abs"] == 0 and r["roi_pct"] == 0.0
    assert math.isclose(r["precision_event"], 0.2) and math.isclose(r["recall_event"], 1 / 3)
    b = ev.break_even_event(ev.event_roi(m)).first()
    assert b["passes"] == 1 and b["needed_tp"] is None


def test_cv_summary_golden(spark):
    cv = spark.createDataFrame([(1, 392.0), (2, 538.0), (3, 970.0)], "fold int, cost double")
    r = cv.agg(F.avg("cost").alias("m"), F.stddev_samp("cost").alias("s"),
               F.min_by("fold", F.struct("cost", "fold")).alias("best")).first()
    assert round(r["m"], 2) == 633.33 and round(r["s"], 2) == 300.56 and r["best"] == 1


def test_f1_golden():
    p, r = 6 / 19, 6 / 105
    assert round(2 * p * r / (p + r), 7) == 0.0967742


def test_break_even_row_level(spark):
    r = sc.break_even(_cm(spark, 5552, 4, 28, 5)).first()
    assert math.isclose(r["min_precision"], 0.2)
    assert r["passes"] == 1  # precision 5/9
    r2 = sc.break_even(_cm(spark, 100, 40, 10, 2)).first()
    assert r2["passes"] == 0 and r2["needed_tp"] == 10 and r2["missing_tp"] == 8
