"""Distributed prefix sums and exact quantiles against pandas / numpy."""
import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from faultline.plans.prefix import exact_quantiles, prefix_sums, range_buckets


def test_prefix_sums_bucketed_matches_cumsum(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 3000), "k": rng.permutation(3000).astype(float),
                        "v": rng.integers(0, 10, 3000)})
    df = spark.createDataFrame(pdf)
    out = prefix_sums(df, ["k"], ["v"], ["g"], n_buckets=6).toPandas()
    exp = pdf.sort_values(["g", "k"]).assign(cum_v=lambda d: d.groupby("g")["v"].cumsum())
    m = out.merge(exp, on=["g", "k"], suffixes=("", "_e"))
    assert len(m) == 3000 and (m["cum_v"] == m["cum_v_e"]).all()
    desc = prefix_sums(df, ["k"], ["v"], [], descending=True, n_buckets=5).toPandas().sort_values("k", ascending=False)
    assert (desc["cum_v"].to_numpy() == pdf.sort_values("k", ascending=False)["v"].cumsum().to_numpy()).all()


def test_exact_quantiles_numpy_linear(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=2001), 2)  # ties included
    df = spark.createDataFrame(pd.DataFrame({"x": x}))
    probs = [0.0, 0.1, 0.25, 0.5, 0.9, 0.999, 1.0]
    got = [r["value"] for r in exact_quantiles(df, "x", probs).orderBy("q_idx").collect()]
    assert np.allclose(got, np.quantile(x, probs), rtol=0, atol=1e-12)


def test_no_nested_loops_and_hot_groups_use_many_buckets(spark):
    # one value shared by very many groups, and one group with most of the distinct values
    rows = [(f"g{i}", 0.0) for i in range(3000)] + [("hot", float(i)) for i in range(2000)]
    df = spark.createDataFrame(rows, "g string, x double")
    q = exact_quantiles(df, "x", [0.25, 0.5], ["g"])
    plan = q._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = {(r.g, r.q): r.value for r in q.collect()}
    assert got["hot", 0.5] == 999.5 and got["g7", 0.25] == 0.0 and len(got) == 2 * 3001
    keyed = df.distinct()
    buckets = range_buckets(keyed, ["g", "x"], 16)
    assert buckets.where("g = 'hot'").select("__bucket").distinct().count() >= 4


def test_plans_do_not_grow_with_the_partitions(spark):
    df = spark.range(3000).selectExpr("id % 7 as g", "cast(hash(id) % 1000 as double) as x")
    sizes = []
    for n in (4, 400):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            q = exact_quantiles(df, "x", [0.1, 0.5], ["g"])
            sizes.append(len(q._jdf.queryExecution().optimizedPlan().toString()))
            assert q.count() == 14
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert abs(sizes[0] - sizes[1]) < 200


def test_sums_from_quantiles_up(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 4000), "x": np.round(rng.normal(size=4000), 1), "w": rng.integers(0, 5, 4000)})
    probs = [0.0, 0.01, 0.3, 0.5, 0.777, 0.99, 1.0]
    got = {(r.g, r.q_idx): r for r in exact_quantiles(spark.createDataFrame(pdf), "x", probs, ["g"], {"s": F.col("w")}).collect()}
    for g, part in pdf.groupby("g"):
        for i, q in enumerate(probs):
            r = got[g, i]
            assert r.value == np.quantile(part["x"], q) or abs(r.value - np.quantile(part["x"], q)) < 1e-12
            assert r.s == part.loc[part["x"] >= r.value, "w"].sum()


def test_plans_without_groups_hold_no_cross_join(spark):
    df = spark.range(5).select(F.col("id").cast("double").alias("x"))
    for out in (exact_quantiles(df, "x", [0.5]), prefix_sums(df.groupBy("x").count(), ["x"], ["count"], total_prefix="all_")):
        plan = out._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert exact_quantiles(df, "x", [0.5]).first().value == 2.0
    assert exact_quantiles(df.limit(0), "x", [0.5]).count() == 0


def test_contiguous_folds(spark):
    from faultline.operators.ml import contiguous_fold
    for n, k in ((10, 4), (7, 3), (3, 5), (12, 4)):
        got = [r[0] for r in spark.range(n).select(contiguous_fold(F.col("id"), F.lit(n), k)).collect()]
        assert got == [f for f, part in enumerate(np.array_split(np.arange(n), k)) for _ in part]
