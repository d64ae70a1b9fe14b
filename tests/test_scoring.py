"""Ranking metrics and thresholds against brute force."""
import numpy as np
import pandas as pd

from faultline.operators import scoring as sc


def ap_bruteforce(y, p):
    order = np.argsort(-p, kind="mergesort")
    ys, ps = y[order], p[order]
    ap, tp, fp, prev_recall = 0.0, 0, 0, 0.0
    P = y.sum()
    i = 0
    while i < len(ps):
        j = i
        while j < len(ps) and ps[j] == ps[i]:
            tp += ys[j]
            fp += 1 - ys[j]
            j += 1
        rec = tp / P
        ap += (rec - prev_recall) * tp / (tp + fp)
        prev_recall = rec
        i = j
    return ap


def auc_bruteforce(y, p):
    pos, neg = p[y == 1], p[y == 0]
    s = sum((pp > nn) + 0.5 * (pp == nn) for pp in pos for nn in neg)
    return s / (len(pos) * len(neg))


def test_ap_auc_with_ties(spark):
    rng = np.random.default_rng(11)
    p = np.round(rng.random(800), 2)
    y = (rng.random(800) < 0.2 + 0.5 * p).astype(int)
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    r = sc.ranking_metrics(df).first()
    assert abs(r["ap"] - ap_bruteforce(y, p)) < 1e-12
    assert abs(r["auc"] - auc_bruteforce(y, p)) < 1e-12


def test_absent_class_gives_null(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.5)], "y int, p double")
    r = sc.ranking_metrics(df).first()
    assert r["ap"] is None and r["auc"] is None
    cm = sc.confusion(sc.apply_threshold(df, 0.3)).first()
    assert (cm["tn"], cm["fp"], cm["fn"], cm["tp"]) == (1, 1, 0, 0)


def test_threshold_for_rate_monotone(spark):
    rng = np.random.default_rng(2)
    p = np.round(rng.random(500), 3)
    df = spark.createDataFrame(pd.DataFrame({"y": (p > 0.7).astype(int), "p": p}))
    thr = [sc.threshold_for_rate(df, r).first()["thr"] for r in (0.01, 0.05, 0.2, 0.5)]
    assert thr == sorted(thr, reverse=True)
    for r, t in zip((0.01, 0.05, 0.2, 0.5), thr):
        assert (p >= t).mean() >= r  # largest distinct score reaching the rate
        higher = np.unique(p[p > t])
        assert len(higher) == 0 or (p >= higher.min()).mean() < r


def test_min_cost_grid_and_counts(spark):
    p = np.array([0.05, 0.2, 0.35, 0.8, 0.9])
    y = np.array([0, 0, 1, 1, 0])
    df = spark.createDataFrame(pd.DataFrame({"y": y, "p": p}))
    best = sc.threshold_min_cost(df).first()
    costs = {round(t, 2): 4 * ((p < t) & (y == 1)).sum() + ((p >= t) & (y == 0)).sum()
             for t in np.linspace(0, 1, 101)}
    m = min(costs.values())
    assert best["cost"] == m and round(best["thr"], 2) == min(t for t, c in costs.items() if c == m)
