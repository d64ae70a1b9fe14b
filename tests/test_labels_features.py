"""Label / split / sampling edges and window-feature properties."""
import datetime as dt

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from faultline.operators import features as fe, labels as lb, offers as ob, kpis

D0 = dt.date(2024, 1, 1)


def _readings(spark, rows):
    return spark.createDataFrame([(d, D0 + dt.timedelta(days=i), *a, f) for d, i, a, f in rows],
                                 "device string, date date, attribute1 double, attribute2 double, failure int")


def test_early_warning_edges(spark):
    rows = [("A", i, (float(i), 1.0), int(i == 9)) for i in range(12)]      # failure on day 9
    rows += [("B", i, (1.0, 1.0), 0) for i in range(12)]                    # never fails
    lab = {(r["device"], r["date"]): r["y"] for r in lb.early_warning_labels(_readings(spark, rows), "failure", 3, "y").collect()}
    d = lambda i: D0 + dt.timedelta(days=i)
    assert lab[("A", d(9))] == 1 and lab[("A", d(6))] == 1 and lab[("A", d(5))] == 0
    assert ("A", d(10)) not in lab and ("A", d(11)) not in lab     # unlabelable tail dropped
    assert ("B", d(8)) in lab and ("B", d(9)) not in lab


def test_split_disjoint_with_gap(spark):
    rows = [("A", i, (1.0, 1.0), 0) for i in range(30)]
    sp = lb.temporal_split(_readings(spark, rows), 1, 0.3, 0.3).toPandas()
    by = {s: sorted(g["date"]) for s, g in sp.dropna(subset=["split"]).groupby("split")}
    assert max(by["train"]) < min(by["val"]) and max(by["val"]) < min(by["test"])
    assert (min(by["val"]) - max(by["train"])).days >= 2 and (min(by["test"]) - max(by["val"])).days >= 2


def test_undersample_exact_counts(spark):
    rows = [(f"D{i % 7}", D0 + dt.timedelta(days=i), int(i % 10 == 0)) for i in range(400)]
    df = spark.createDataFrame(rows, "device string, date date, y int")
    out = lb.undersample(df, "y", neg_per_pos=3, seed=1)
    c = {r["y"]: r["n"] for r in out.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert c == {1: 40, 0: 120}
    again = lb.undersample(df, "y", neg_per_pos=3, seed=1).exceptAll(out).count()
    assert again == 0


def test_features_use_only_the_past(spark):
    rng = np.random.default_rng(1)
    rows = [("A", i, (float(rng.normal()), float(rng.normal())), 0) for i in range(40)]
    base = fe.device_features(_readings(spark, rows), label=False)
    rows2 = list(rows)
    rows2[-1] = ("A", 39, (999.0, -999.0), 1)
    pert = fe.device_features(_readings(spark, rows2), label=False)
    cols = [c for c in base.columns if c not in ("attribute1", "attribute2", "failure")
            and not c.endswith(("_diff", "_pct_diff", "_sum", "_ratio", "_normalized", "_isna", "sigma"))]
    a = base.where(F.col("date") < D0 + dt.timedelta(days=39)).select(*[F.col(f"`{c}`") for c in cols]).toPandas()
    b = pert.where(F.col("date") < D0 + dt.timedelta(days=39)).select(*[F.col(f"`{c}`") for c in cols]).toPandas()
    pd.testing.assert_frame_equal(a.sort_values("date").reset_index(drop=True), b.sort_values("date").reset_index(drop=True))


def test_slope_only_on_full_windows_and_zscore_fallback(spark):
    rows = [("A", i, (float(2 * i), 5.0), 0) for i in range(20)]
    f = fe.device_features(_readings(spark, rows), label=False).orderBy("date").toPandas()
    assert f["attribute1_slope_7"].iloc[:7].isna().all() and np.allclose(f["attribute1_slope_7"].iloc[7:], 2.0)
    assert (f["attribute2_normalized"] == 0.0).all()        # constant: std 0 -> 0


def test_offer_inf_and_zero_branches(spark):
    df = spark.createDataFrame([(0.0, 5.0, 3.0, None), (0.0, 0.0, 0.0, None), (10.0, -2.0, 12.0, 100.0)],
                               "INVOLVED_STOCK double, SOLD_QUANTITY double, REMAINING_STOCK_AFTER_END double, SOLD_AMOUNT double")
    r = ob.offer_features(df).collect()
    assert r[0]["SALES_RATE"] == float("inf") and r[0]["PERFORMANCE_CATEGORY"] == ob.CAT_SOLD_OUT
    assert r[1]["SALES_RATE"] == 0.0 and r[1]["PERFORMANCE_CATEGORY"] == ob.CAT_UNSOLD
    assert r[2]["PERFORMANCE_CATEGORY"] == ob.CAT_PARTIAL and r[2]["SELL_THROUGH"] == -0.2
    assert r[1]["SELL_THROUGH"] is None and r[0]["STOCKOUT_FLAG"] == 0


def test_kaplan_meier_zero_factor(spark):
    df = spark.createDataFrame([("F", 1.0, 1), ("F", 2.0, 0), ("F", 3.0, 1), ("P", 1.0, 0)],
                               "SHIPPING_PAYMENT_TYPE string, DURATION_HOURS double, STOCKOUT_FLAG int")
    km = {(r[0], r[1]): r["survival"] for r in kpis.kaplan_meier(df).collect()}
    assert abs(km[("F", 1.0)] - 2 / 3) < 1e-12 and abs(km[("F", 2.0)] - 2 / 3) < 1e-12
    assert km[("F", 3.0)] == 0.0 and km[("P", 1.0)] == 1.0
