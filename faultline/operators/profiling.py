"""Device-reading loading and profiling."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dedup_readings(df: DataFrame, tie_break: list[str] | None = None) -> DataFrame:
    """A1/H4: keep one row per (device, date).  File row order is not a Spark property, so
    "first" is defined by ``tie_break`` columns (default: all other columns, attributes first)."""
    order = tie_break or sorted((c for c in df.columns if c not in ("device", "date")),
                                key=lambda c: (not c.startswith("attribute"), c)) or ["date"]
    w = Window.partitionBy("device", "date").orderBy(*[F.col(c).asc_nulls_last() for c in order])
    return df.select("*", F.row_number().over(w).alias("__rn")).where("__rn = 1").drop("__rn")


def data_completeness(df: DataFrame, target: str = "failure") -> DataFrame:
    """Devices, dates, expected = devices x dates, actual rows, % complete, devices present
    on every date, dates with every device, failure rate and period (one row).

    Distinct counts come from per-device / per-date groupings (two partial/final aggregates);
    the derived numbers are scalar subqueries, not cross joins."""
    per_dev = df.groupBy("device").agg(F.count(F.lit(1)).alias("n"))
    per_date = df.groupBy("date").agg(F.count(F.lit(1)).alias("n"))
    n_dev = per_dev.select(F.count(F.lit(1))).scalar()
    n_dates = per_date.select(F.count(F.lit(1))).scalar()
    complete_dev = per_dev.select(F.sum(F.when(F.col("n") == n_dates, 1).otherwise(0))).scalar()
    complete_dates = per_date.select(F.sum(F.when(F.col("n") == n_dev, 1).otherwise(0))).scalar()
    return df.agg(F.count(F.lit(1)).alias("actual_records"), F.avg(target).alias("failure_rate"),
                  F.min("date").alias("first_date"), F.max("date").alias("last_date")).select(
        n_dev.alias("total_devices"), n_dates.alias("total_dates"),
        (n_dev * n_dates).alias("expected_records"), "actual_records",
        (F.col("actual_records") / (n_dev * n_dates) * 100).alias("completeness_rate"),
        F.coalesce(complete_dev, F.lit(0)).alias("complete_devices"),
        F.coalesce(complete_dates, F.lit(0)).alias("complete_dates"),
        "failure_rate", "first_date", "last_date")


def failure_distribution(df: DataFrame, target: str = "failure") -> DataFrame:
    """Count and % per class 0/1; an absent class gives 0 (not an error)."""
    f = F.col(target)
    a = df.agg(F.sum(F.when(f == 0, 1).otherwise(0)).alias("n0"),
               F.sum(F.when(f == 1, 1).otherwise(0)).alias("n1"),
               F.count(F.lit(1)).alias("n"), F.sum(f).alias("s"))
    rows = F.explode(F.array(F.struct(F.lit(0).alias("failure"), F.col("n0").alias("count")),
                             F.struct(F.lit(1).alias("failure"), F.col("n1").alias("count"))))
    rate = F.coalesce(F.col("s"), F.lit(0)) / F.col("n") * 100
    return a.select(rows.alias("r"), rate.alias("rate")).select(
        F.col("r.failure").alias(target), F.coalesce("r.count", F.lit(0)).alias("count"),
        F.when(F.col("r.failure") == 1, F.col("rate")).otherwise(100 - F.col("rate")).alias("pct"))


def device_failures(df: DataFrame, target: str = "failure") -> DataFrame:
    """D3: per device total failures, non-missing records and failure rate; total desc."""
    return (df.groupBy("device")
            .agg(F.coalesce(F.sum(target), F.lit(0)).alias("total_failures"),
                 F.count(target).alias("total_records"), F.avg(target).alias("failure_rate"))
            .orderBy(F.col("total_failures").desc(), "device"))


def daily_failures(df: DataFrame, target: str = "failure") -> DataFrame:
    """Per date total failures, devices reporting and failure rate."""
    return (df.groupBy("date")
            .agg(F.coalesce(F.sum(target), F.lit(0)).alias("total_failures"),
                 F.count(target).alias("total_devices"), F.avg(target).alias("failure_rate")))


def failure_pattern_summary(df: DataFrame, target: str = "failure") -> DataFrame:
    """D3/D4 headline: devices / days with and without failures and the mean rates (one row)."""
    dev = device_failures(df, target)
    day = daily_failures(df, target)
    d = dev.agg(F.sum(F.when(F.col("total_failures") > 0, 1).otherwise(0)).alias("devices_with_failures"),
                F.sum(F.when(F.col("total_failures") == 0, 1).otherwise(0)).alias("devices_without_failures"),
                F.avg("failure_rate").alias("mean_device_failure_rate"))
    t = day.agg(F.sum(F.when(F.col("total_failures") > 0, 1).otherwise(0)).alias("days_with_failures"),
                F.sum(F.when(F.col("total_failures") == 0, 1).otherwise(0)).alias("days_without_failures"),
                F.avg("failure_rate").alias("mean_daily_failure_rate"))
    return d.select("*", t.select("days_with_failures").scalar().alias("days_with_failures"),
                    t.select("days_without_failures").scalar().alias("days_without_failures"),
                    t.select("mean_daily_failure_rate").scalar().alias("mean_daily_failure_rate"))
