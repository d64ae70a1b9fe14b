"""Adapted views: the library's two source schemas derived from the test tables.

* ``device_readings`` — daily device telemetry (device, date, attribute1..9, failure) built
  from ``events`` by grouping on (user, day).
* ``offers`` — flash-offer rows built from ``lineitem`` joined to ``part``.
* ``scored`` — per-reading early-warning label, a deterministic score and the purged split.

The same views are spelled in DuckDB SQL in ``faultline.oracle`` so each operator can be
checked against an independent engine.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from faultline.sources.tables import read_table

ATTRS = [f"attribute{i}" for i in range(1, 10)]

# Unique row key of an offer (lineitem's (orderkey, linenumber) repeats in the test data).
OFFER_KEY = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
             "l_extendedprice", "l_shipdate"]

# Fixture parameters (30 days of data only): horizon 3, purge 1, val = test = 0.3.
FIXTURE_HORIZON = 3
FIXTURE_PURGE = 1
FIXTURE_SIZE = 0.3


def device_readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "value")
    v, et = F.col("value"), F.col("event_type")

    def count_type(t):
        return F.sum(F.when(et == t, 1).otherwise(0)).cast("double")

    return (ev.groupBy(F.concat(F.lit("D"), F.col("user_id").cast("string")).alias("device"),
                       F.col("ts").cast("date").alias("date"))
            .agg(F.count(F.lit(1)).cast("double").alias("attribute1"),
                 F.round(F.sum(v), 6).alias("attribute2"),
                 F.round(F.avg(v), 6).alias("attribute3"),
                 F.max(v).alias("attribute4"),
                 count_type("click").alias("attribute5"),
                 count_type("view").alias("attribute6"),
                 F.min(F.when(et == "purchase", v)).alias("attribute7"),
                 count_type("error").alias("attribute8"),
                 F.round(F.max(v) - F.min(v), 6).alias("attribute9"),
                 F.max(F.when((et == "error") & (v >= 150), 1).otherwise(0)).alias("failure")))


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_returnflag", "l_linestatus", "l_shipdate")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type",
                                                     "p_size")
    j = li.join(part, li.l_partkey == part.p_partkey, "inner")
    start = F.expr("timestampadd(HOUR, cast(l_orderkey % 24 as int), l_shipdate)")
    returned = F.col("l_returnflag") == "R"
    involved = (2 * F.col("p_size")).cast("double")
    sold_qty = F.when(returned, F.lit(0.0)).otherwise(F.col("l_quantity"))
    return j.select(
        *OFFER_KEY,
        F.col("l_shipdate").cast("date").alias("OFFER_START_DATE"),
        start.alias("OFFER_START_DTTM"),
        F.expr("timestampadd(MINUTE, l_linenumber * 90, "
               "timestampadd(HOUR, cast(l_orderkey % 24 as int), l_shipdate))").alias("OFFER_FINISH_DTTM"),
        F.col("p_type").alias("VERTICAL"),
        F.col("p_brand").alias("DOM_DOMAIN_AGG1"),
        F.col("p_name").alias("DOMAIN_ID"),
        F.when(F.col("l_linestatus") == "F", "FREE").otherwise("PAID").alias("SHIPPING_PAYMENT_TYPE"),
        F.col("l_returnflag").alias("OFFER_TYPE"),
        F.when(F.col("l_suppkey") % 20 == 0, F.lit("A")).alias("ORIGIN"),
        involved.alias("INVOLVED_STOCK"),
        sold_qty.alias("SOLD_QUANTITY"),
        F.when(~returned, F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("SOLD_AMOUNT"),
        (involved - sold_qty).alias("REMAINING_STOCK_AFTER_END"),
    )


def offer_features_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    from faultline.operators.offers import offer_features
    return offer_features(offers(spark, sf_dir))


def past_mean_lag_score(c: str, divisor: float) -> F.Column:
    """Deterministic stand-in for a model score: past-7 mean and lag of one attribute."""
    w = Window.partitionBy("device").orderBy("date")
    past7 = F.avg(c).over(w.rowsBetween(-7, -1))
    raw = (0.5 * F.coalesce(past7, F.lit(0.0)) + 0.5 * F.coalesce(F.lag(c, 1).over(w), F.lit(0.0))) / divisor
    return F.round(F.least(F.lit(1.0), raw), 6)


def scored(spark: SparkSession, sf_dir: str, two_models: bool = False,
           checkpoint: bool = True) -> DataFrame:
    """Labelled, split and scored readings: device, date, y, p, split[, model].

    ``two_models`` stacks a second score (attribute2 / 600) under model ``m2`` for the
    operators that compare models; the first model is ``m1``.  The table is reused by many
    jobs of one report (threshold sweeps, quantiles, prefix sums), so by default its lineage is
    cut with a reliable checkpoint in the shared ``spark.checkpoint.dir``.
    """
    from faultline.operators.labels import early_warning_labels, temporal_split

    dr = device_readings(spark, sf_dir)
    s = dr.select("device", "date", "failure", "attribute2", "attribute4",
                  past_mean_lag_score("attribute4", 300.0).alias("p1"),
                  past_mean_lag_score("attribute2", 600.0).alias("p2"))
    lab = early_warning_labels(s, "failure", FIXTURE_HORIZON, label_col="y")
    sp = temporal_split(lab, purge_days=FIXTURE_PURGE, val_size=FIXTURE_SIZE,
                        test_size=FIXTURE_SIZE)
    base = sp.where(F.col("split").isNotNull())
    if not two_models:
        out = base.select("device", "date", "y", F.col("p1").alias("p"), "split")
        return _cut(out) if checkpoint else out
    out = base.select("device", "date", "y", "split",
                       F.explode(F.array(F.struct(F.lit("m1").alias("model"), F.col("p1").alias("p")),
                                         F.struct(F.lit("m2").alias("model"), F.col("p2").alias("p")))
                                 ).alias("m")).select("device", "date", "y", "m.p", "split", "m.model")
    return _cut(out) if checkpoint else out


def _cut(df: DataFrame) -> DataFrame:
    from faultline.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
