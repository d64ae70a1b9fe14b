"""The steps that the reports and trainings over every feature share: same results in fewer readings."""
import datetime as dt
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from faultline.operators import features as fe, labels as lb, ml, stats as st


def _table(spark, n=120):
    rng = np.random.default_rng(3)
    rows = []
    for i in range(n):
        a, b = 1e7 + float(rng.normal()), float(rng.normal())
        late = i >= 5
        rows.append((a, a * 2 + b if late else None, b if late else None, a - b if i % 3 else None, 4.0, None, int(b > 0)))
    return rows, spark.createDataFrame(rows, "a double, b double, c double, d double, e double, f double, y int")


def test_prune_reads_the_table_in_one_pair_of_passes(spark, monkeypatch):
    rows, df = _table(spark)
    calls, real = [], st.pairwise_correlations
    monkeypatch.setattr(st, "pairwise_correlations", lambda *a, **k: calls.append(1) or real(*a, **k))
    names = ["a", "b", "c", "d", "e", "f"]
    got = {r["feature"]: r for r in st.feature_correlation_prune(df, names, "y", 0.5).collect()}
    assert len(calls) == 1 and sorted(got) == names

    def r(i, j):
        both = [(x[i], x[j]) for x in rows if x[i] is not None and x[j] is not None]
        p, q = np.array(both).T if both else (np.array([0.0]),) * 2
        return None if np.ptp(p) == 0 or np.ptp(q) == 0 else float(np.corrcoef(p - p.mean(), q - q.mean())[0, 1])
    for i, name in enumerate(names):
        want = r(i, 6)
        assert got[name]["target_corr"] == (None if want is None else pytest.approx(want, abs=1e-9))
        assert got[name]["removed"] == int(any((r(j, i) is not None and abs(r(j, i)) > 0.5) for j in range(i)))


def test_rounding_without_decimals_is_round(spark):
    xs = [0.0, -0.0, 0.5, -0.5, 1.5, 2.5, -2.5, 0.49999999999999994, -0.49999999999999994, 123456789.5, 4503599627370495.5,
          -4503599627370495.5, 2.0 ** 52, 2.0 ** 53 + 2, 9.3e18, -1e300, float("inf"), float("-inf"), float("nan"), None]
    got = spark.createDataFrame([(x,) for x in xs], "x double").select("x", F.round("x").alias("old"), st._rounded(F.col("x")).alias("new")).collect()
    for r in got:
        assert r["old"] == r["new"] or (math.isnan(r["old"]) and math.isnan(r["new"])), r


def test_mutual_information_of_bins(spark):
    rows, df = _table(spark)
    got = {r["feature"]: r["mi_score"] for r in st.mutual_information(df, ["a", "c", "e", "f"], "y", 4).collect()}
    assert sorted(got) == ["a", "c", "e"]
    for i, name in ((0, "a"), (2, "c"), (4, "e")):
        v = np.array([x[i] for x in rows if x[i] is not None]).round(9)
        y = np.array([x[6] for x in rows if x[i] is not None])
        bins = (v[:, None] >= np.quantile(v, [0.25, 0.5, 0.75])[None]).sum(1)
        want = sum((m := ((bins == b) & (y == k)).mean()) and m * math.log(m / ((bins == b).mean() * (y == k).mean()))
                   for b in set(bins) for k in set(y))
        assert got[name] == pytest.approx(want, abs=1e-9)


def test_selection_reads_the_wide_rows_twice(spark):
    rows, df = _table(spark)
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def counted(x):
        seen.add(1)
        return x
    wide = df.withColumn("a", counted.asNondeterministic()("a"))
    top = ml.select_top_features(wide, ["a", "b", "c", "f"], "y", 2, num_trees=3).collect()
    assert [r["rank"] for r in top] == [1, 2] and top[0]["feature"] == "c"
    assert seen.value <= 2 * len(rows)


def test_ratios_draw_once(spark, monkeypatch):
    day = dt.date(2024, 1, 1)
    df = spark.createDataFrame([(f"D{i}", day, float(i), int(i % 9 == 0)) for i in range(60)], "device string, date date, a double, y int")
    kept = []

    class Enough(Exception):
        pass

    def fit(train, *_, **__):
        kept.append(train.storageLevel.useDisk)
        raise Enough
    monkeypatch.setattr(ml, "train_boosted", fit)
    with pytest.raises(Enough):
        ml.tune_neg_per_pos(df, df, "y", ratios=(2,))
    assert kept == [True]


def test_medians_are_fields(spark):
    _, df = _table(spark)
    filled = lb.median_impute(df, df, ["b", "f"])
    assert "map_from_entries" not in filled._jdf.queryExecution().optimizedPlan().toString()
    got = filled.select("b", "f").collect()
    want = float(np.median([r["b"] for r in df.where("b is not null").collect()]))
    assert [r["b"] for r in got][:5] == pytest.approx([want] * 5) and all(r["f"] is None for r in got)


def test_label_before_or_after_the_features(spark):
    rows = [(f"D{d}", dt.date(2024, 1, 1) + dt.timedelta(i), float((i * 7 + d) % 5) if i % 4 else None, float(i), int((i + d) % 6 == 0))
            for d in range(3) for i in range(12)]
    df = spark.createDataFrame(rows, "device string, date date, attribute1 double, attribute2 double, failure int")
    first = fe.device_features(df, forecast_horizon=3)
    last = fe.device_features(df, forecast_horizon=3, newest_first=True)
    assert first.columns == last.columns and first.count() > 0
    assert sorted(map(str, first.collect())) == sorted(map(str, last.collect()))
