"""Correlations, ANOVA tails, column catalog, loaders and the storage rule."""
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from faultline.operators import offers as ob, stats as st
from faultline.sources import io
from faultline.session import ensure_checkpoint_dir


def corr_of(df, cols):
    return {(r.var1, r.var2): r.corr for r in st.pairwise_correlations(df, cols).collect()}


def test_correlations_are_pairwise_complete_and_do_not_depend_on_row_order(spark):
    a = [1e9] + list(map(float, range(10))) * 10
    b = [None] + list(map(float, range(10))) * 10
    c, d = [3.0] * 101, [float("nan")] + [x * x for x in a[1:]]
    rows = list(zip(a, b, c, d))
    expected = pd.DataFrame(rows, columns=list("abcd"), dtype=float).corr()
    for order in (rows, rows[::-1]):
        df = spark.createDataFrame(order, "a double, b double, c double, d double").repartition(3)
        for (x, y), r in corr_of(df, list("abcd")).items():
            assert (r is None) == math.isnan(expected.loc[x, y])
            assert r is None or abs(r - expected.loc[x, y]) < 1e-12


def test_correlations_of_random_gaps(spark):
    rng = np.random.default_rng(1)
    pdf = pd.DataFrame(rng.normal(size=(500, 5)) + rng.normal(size=(500, 1)), columns=list("abcde"))
    pdf = pdf.mask(rng.random(pdf.shape) < 0.3)
    rows = [tuple(None if math.isnan(x) else float(x) for x in r) for r in pdf.to_numpy()]
    got = corr_of(spark.createDataFrame(rows, "a double, b double, c double, d double, e double"), list("abcde"))
    for (x, y), r in got.items():
        assert abs(r - pdf.corr().loc[x, y]) < 1e-10


def test_f_tail(spark):
    cases = [(5.3, 1.0, 40.0, 0.0266101695), (0.0, 2.0, 10.0, 1.0), (1.2, 3.0, 7.0, 0.3774349252), (4.0, 1.0, 4e4, 0.0455064)]
    df = spark.createDataFrame([c[:3] for c in cases], "f double, a double, b double")
    for r, c in zip(df.select(st._f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).collect(), cases):
        assert abs(r.p - c[3]) < 1e-6
    none = spark.createDataFrame([(None, 1.0, 4.0)], "f double, a double, b double")
    assert none.select(st._f_tail(F.col("f"), F.col("a"), F.col("b")).alias("p")).first().p is None


def test_column_catalog():
    groups = ob.column_catalog()
    assert groups["numericas_originais"] == ["INVOLVED_STOCK", "REMAINING_STOCK_AFTER_END", "SOLD_AMOUNT", "SOLD_QUANTITY"]
    assert set(groups["flags"]) == {"WEEKEND", "STOCKOUT_FLAG", "OVERSELL_FLAG"}
    assert len(groups["numericas_analises"]) == 18 and "STOCK_SOLD_calc" not in groups["numericas_analises"]
    assert set(groups["valores_monetarios"]) == {"SOLD_AMOUNT", "POTENTIAL_VALUE", "PRICE_PER_UNIT", "VALUE_PER_STOCK_UNIT"}
    assert [ob.feature_family(c) for c in ("SOLD_AMOUNT", "SALES_RATE", "SELL_THROUGH", "VALUE_PER_STOCK_UNIT", "VERTICAL")] == [
        "Original", "Vendas", "Qualidade", "Preço", "Outra"]


def test_bad_readings_become_null(spark, tmp_path):
    attrs = ",".join(f"attribute{i}" for i in range(1, 10))
    (tmp_path / "r.csv").write_text(f"device,date,{attrs},failure\n"
                                    f"A,2024-01-01,{','.join(['1'] * 9)},1.0\n"
                                    f"A,2024-01-01,{','.join(['1'] * 9)},0\n"
                                    f"B,2024-01-02,NaN,x,{','.join(['2.5'] * 7)},nan\n"
                                    f"C,never,{','.join(['1'] * 9)},1\n")
    got = {r.device: r for r in io.load_device_readings(spark, str(tmp_path / "r.csv")).collect()}
    assert set(got) == {"A", "B"}
    assert got["A"].failure == 0 and got["B"].failure is None       # the smaller label wins a tie
    assert got["B"].attribute1 is None and got["B"].attribute2 is None and got["B"].attribute3 == 2.5
    table = spark.createDataFrame([("D", "2024-02-01", 1.0), ("E", "bad", 0.0)], "device string, date string, failure double")
    table.write.parquet(str(tmp_path / "p"))
    got = io.load_device_readings(spark, str(tmp_path / "p"), "parquet").collect()
    assert [(r.device, r.failure) for r in got] == [("D", 1)]


class _Cluster:
    class conf:
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:
        master = "spark://host:7077"


def test_a_cluster_without_a_shared_folder_is_an_error():
    with pytest.raises(ValueError):
        ensure_checkpoint_dir(_Cluster())


@pytest.fixture(scope="module")
def features(spark):
    from faultline.catalog import stats
    from faultline.operators import labels as lb
    table = stats._feat(spark, "/root/testdata/sf0.001")
    split = lb.temporal_split(table, stats.FIXTURE_PURGE, stats.FIXTURE_SIZE, stats.FIXTURE_SIZE)
    frames = [t.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in [*stats.FEATS, stats.TARGET]]).toPandas()
              for t in (table, split.where("split = 'train'"), split.where("split = 'test'"))]
    return stats, frames


def registered(spark, name):
    from faultline.registry import load_all
    load_all()
    import __spark_entry__ as entry_mod
    return {r.feature: r for r in entry_mod.queries()[name](spark, "/root/testdata/sf0.001").collect()}


def test_drift_of_every_feature(spark, features):
    stats, (_, train, test) = features
    got = registered(spark, "e17_drift_ks_all")
    some = [c for c in stats.FEATS if train[c].notna().any() or test[c].notna().any()]
    assert set(got) == set(some) and len(some) > 150
    for c in some:
        a, b = np.sort(train[c].dropna()), np.sort(test[c].dropna())
        if len(a) and len(b):
            at = np.concatenate([a, b])
            d = np.abs(np.searchsorted(a, at, "right") / len(a) - np.searchsorted(b, at, "right") / len(b)).max()
            assert abs(got[c].ks_stat - d) < 2e-6 and (got[c].n1, got[c].n2) == (len(a), len(b)), c
        else:                                          # nothing to compare with
            assert (got[c].ks_stat, got[c].p_value, got[c].drift) == (None, None, None), c


def test_redundancy_and_information_of_every_feature(spark, features):
    stats, (table, _, _) = features
    got = registered(spark, "e13_feature_correlation_prune_all")
    assert set(got) == set(stats.FEATS)
    for c in stats.FEATS:
        x = table[[c, stats.TARGET]].dropna()
        if len(x) > 2 and x[c].std() > 1e-6 * max(1.0, x[c].abs().max()) and x[stats.TARGET].std() > 0:
            assert abs(got[c].target_corr - np.corrcoef(x[c], x[stats.TARGET])[0, 1]) < 1e-5, c
    got = registered(spark, "e16_mutual_information_all")
    assert set(got) == {c for c in stats.FEATS if table[c].notna().any()}
    for c in got:
        x = table[[c, stats.TARGET]].dropna()
        value = (x[c] * 1e9).round() / 1e9
        bins = np.searchsorted(np.quantile(value, np.arange(1, 10) / 10), value, "right")
        n = pd.crosstab(bins, x[stats.TARGET].to_numpy()).to_numpy().astype(float)
        p = n / n.sum()
        part = p * np.log(np.where(p > 0, p / (p.sum(1, keepdims=True) * p.sum(0, keepdims=True)), 1.0))
        assert abs(got[c].mi_score - part.sum()) < 5e-3, c
