"""Model operators: early stopping, selection per fold, saved bundles."""
import datetime as dt

import numpy as np
import pandas as pd
import pytest

from pyspark.sql import functions as F

from faultline.catalog import models
from faultline.operators import ml
from faultline.sources import io

TARGET = "early_warn_target"


def readings(devices=30, days=40, seed=1, late=20):
    """``good`` explains the target throughout, ``late`` only from day ``late`` on, ``noise`` never."""
    rng = np.random.default_rng(seed)
    n = devices * days
    day = np.tile(np.arange(days), devices)
    good, noise = rng.normal(size=n), rng.normal(size=n)
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * good))).astype(int)
    pdf = pd.DataFrame({"device": np.repeat([f"D{i:02d}" for i in range(devices)], days),
                        "date": [dt.date(2020, 1, 1) + dt.timedelta(int(d)) for d in day],
                        "good": good, "noise": noise, "late": np.where(day >= late, 3.0 * y, rng.normal(size=n)), TARGET: y})
    pdf.loc[::17, "good"] = np.nan
    return pdf


def test_best_round_is_what_early_stopping_sees():
    assert ml.best_round([3, 2, 1, 2, 2, 2], 3) == (3, True)
    assert ml.best_round([3, 2, 1, 2, 2], 3) == (3, False)
    assert ml.best_round([3, 2, 2.5, 2.4, 2.3, 1.0], 3) == (2, True)          # the later low is never reached
    assert ml.best_round([1.0], 10) == (1, False)
    assert ml.best_round([2, 2, 2, 2], 2) == (1, True)                       # no better is not better


def test_training_stops_at_the_best_round(spark):
    df = spark.createDataFrame(readings())
    train, val = df.where("date < '2020-01-19'"), df.where("date >= '2020-01-22'")
    m = ml.train_boosted(train, ["good", "noise"], TARGET, "A", weighted=False, validation=val, max_iter=64, patience=3)
    kept = m.stages[-1].getNumTrees
    long = ml.train_boosted(train, ["good", "noise"], TARGET, "A", weighted=False, max_iter=min(64, kept + 3))
    rows = ml.PipelineModel(long.stages[:-1]).transform(ml._prepared_columns(val.withColumn("w", F.lit(1.0)), ["good", "noise"], TARGET))
    losses = long.stages[-1].evaluateEachIteration(rows.select("features", "label", "w"))
    assert ml.best_round(losses, 3) == (kept, kept < 64) and kept < 64
    # the trees kept are the first of the longer training
    assert [t.toDebugString for t in m.stages[-1].trees] == [t.toDebugString for t in long.stages[-1].trees[:kept]] or \
        [t.numNodes for t in m.stages[-1].trees] == [t.numNodes for t in long.stages[-1].trees[:kept]]


def test_the_first_rounds_are_those_of_a_shorter_training(spark, tmp_path):
    df = spark.createDataFrame(readings())
    short, long = (ml.train_boosted(df, ["good", "noise"], TARGET, "A", weighted=False, max_iter=n) for n in (3, 8))
    cut = ml.PipelineModel([*long.stages[:-1], ml.first_rounds(long.stages[-1], 3)])
    want, got = short.stages[-1], cut.stages[-1]
    assert got.getNumTrees == got.getMaxIter() == 3 and long.stages[-1].getNumTrees == 8
    assert got.featureImportances == want.featureImportances and got.treeWeights == want.treeWeights
    cut.write().overwrite().save(str(tmp_path / "cut"))
    scores = [[r.p for r in ml.score(m, df, ["good", "noise"], TARGET, "A").orderBy("device", "date").collect()]
              for m in (short, cut, ml.PipelineModel.load(str(tmp_path / "cut")))]
    assert scores[0] == scores[1] == scores[2]


def test_importances_are_those_of_a_whole_training(spark, monkeypatch):
    """The registered query of I11 stops by its validation rows and not by a bound."""
    pdf = readings(devices=60)
    rng = np.random.default_rng(7)
    for c in "abcd":
        pdf[c] = rng.normal(size=len(pdf))
    pdf[TARGET] = (pdf.a * pdf.b + pdf.c * pdf.d + 0.5 * pdf.a > 0).astype(int)
    monkeypatch.setattr(models, "_features", lambda *_: spark.createDataFrame(pdf))
    seen, select, best, report = {"losses": []}, ml.select_top_features, ml.best_round, ml.feature_importance
    monkeypatch.setattr(ml, "select_top_features", lambda *a, **k: seen.update(trees=k["num_trees"]) or select(*a, **k))
    monkeypatch.setattr(ml, "best_round", lambda losses, patience: seen["losses"].append(losses) or best(losses, patience))
    monkeypatch.setattr(ml, "feature_importance", lambda m, feats: seen.update(model=m.stages[-1]) or report(m, feats))
    families = models.i11(spark, None).collect()
    assert sum(r["n_features"] for r in families) == 7
    keep, stopped = ml.best_round(seen["losses"][-1], ml.PATIENCE)
    assert stopped and seen["model"].getNumTrees == keep > models.STOPPED_ROUNDS
    assert seen["trees"] == models.SOURCE_TREES == 400


def test_medians_come_from_training_rows_alone(spark):
    df = spark.createDataFrame(readings())
    train = df.where("date < '2020-01-19'")
    val = df.where("date >= '2020-01-22'").withColumn("good", F.lit(1000.0))
    m = ml.train_boosted(train, ["good"], TARGET, "A", weighted=False, validation=val, max_iter=2)
    assert abs(m.stages[0].surrogateDF.first()[0]) < 1


def test_selection_sees_the_training_rows_of_its_fold_alone(spark):
    df = spark.createDataFrame(readings(late=30))
    chosen = {}
    cv, summary = ml.rolling_origin_cv(df, TARGET, 2, 1, max_iter=2, k=1, num_trees=5, chosen=chosen)
    assert chosen == {1: ["good"], 2: ["good"]}
    assert sorted(r.fold for r in cv.collect()) == [1, 2] and summary.count() == 1


def test_an_ensemble_is_saved_and_loaded_by_name(spark, tmp_path):
    df = spark.createDataFrame(readings())
    train, val = df.where("date < '2020-01-19'"), df.where("date >= '2020-01-22'")
    feats, members = ["good", "noise"], {}
    for name, variant, weight in (("GBT_A", "A", 0.7), ("GBT_CV", "CV", 0.3)):
        m = ml.train_boosted(train, feats, TARGET, variant, weighted=False, max_iter=2)
        curves = ml.calibration_curves(ml.fold_rows(ml.score(m, val, feats, TARGET, name), 3), 3)
        members[name] = io.Member(m, 0.5, curves, 3, weight)
    bundle = io.Bundle(ml.ENSEMBLE, feats, members, 0.4, TARGET)
    path = str(tmp_path / "models")
    first = io.save_bundle(spark, bundle, path)
    io.save_bundle(spark, io.Bundle("other", feats, {"GBT_A": members["GBT_A"]}, 0.9, TARGET), path)

    def rows(b):
        return sorted((r.device, r.date, r.y, round(r.p, 9), r.model, r.pred) for r in b.score(val).collect())
    loaded = io.load_bundle(spark, path, ml.ENSEMBLE)
    assert loaded.threshold == 0.4 and loaded.features == feats and list(loaded.members) == ["GBT_A", "GBT_CV"]
    assert rows(loaded) == rows(bundle) and {r[4] for r in rows(loaded)} == {ml.ENSEMBLE}
    assert io.load_bundle(spark, path, ml.ENSEMBLE, first).members["GBT_CV"].weight == 0.3
    with pytest.raises(KeyError):
        io.load_bundle(spark, path, "missing")


def test_readings_lose_bytes_that_are_no_utf8(spark, tmp_path):
    head = b"device,date," + b",".join(b"attribute%d" % i for i in range(1, 10)) + b",failure\n"
    tail = b"," + b",".join(b"%d" % i for i in range(9)) + b",1.0\n"
    good = "Né日😀".encode()
    names = [b"A\xff1", b"A1", b"B\xc3", b"\xe2\x82C", good, b"\xed\xa0\x80D", b"\xc0\xafE"]
    body = b"".join(n + b",2020-01-%02d" % (i + 1) + tail for i, n in enumerate(names))
    body += b"A1,2020-01-01" + tail + b"F,never" + tail + b",2020-01-01" + tail + b"G,2020-01-01\n"
    (tmp_path / "r.csv").write_bytes(head + body)
    got = sorted((r.device, r.date.day) for r in io.load_device_readings(spark, str(tmp_path)).collect())
    assert got == sorted([(n.decode("utf-8", "ignore"), i + 1) for i, n in enumerate(names)] + [("G", 1)])
    report = io.readings_report(spark, str(tmp_path)).first().asDict()
    assert report == {"rows_read": 11, "rows_corrupt": 1, "rows_without_device": 1, "rows_without_date": 1, "rows_repeated": 1, "rows_kept": 8}
