"""Device queries: loading/profiling (A1, D1-D4), features (F1-F14, B22-B24, B28) and
labels/splits/sampling (G1-G7) over the ``device_readings`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.oracle import sql_div
from faultline.operators import features as fe, labels as lb, profiling as pr
from faultline.registry import query
from faultline.sources import io
from faultline.sources.fixtures import (ATTRS, FIXTURE_HORIZON, FIXTURE_PURGE, FIXTURE_SIZE,
                                        device_readings, scored)

H = FIXTURE_HORIZON
FIRST4 = ATTRS[:4]


def _dr(spark, sf):
    return device_readings(spark, sf)


# ------------------------------------------------------------------ A1, D1-D4
@query("a01_load_device_readings", "SELECT * FROM device_readings")
def a01(spark, sf):
    return pr.dedup_readings(_dr(spark, sf))


def _messy_files(spark, sf):
    """Readings written as CSV with a byte that is no UTF-8 in some names, dates that are none, labels as
    1.0, and repeated rows of larger readings."""
    from faultline.catalog.models import _scratch
    d = _dr(spark, sf)
    again = d.where(F.dayofmonth("date") % 5 == 0).withColumn("attribute1", F.col("attribute1") + 1)
    rows = d.unionByName(again)
    name = F.when(F.col("attribute1") % 2 == 0, F.concat(F.lit("D\u00ff"), F.substring("device", 2, 99))).otherwise(F.col("device"))
    date = F.when(F.dayofmonth("date") == 13, F.lit("no date")).otherwise(F.col("date").cast("string"))
    path = _scratch(spark, "readings-csv")
    rows.select(name.alias("device"), date.alias("date"), *ATTRS, F.col("failure").cast("double").alias("failure")) \
        .write.option("header", True).option("encoding", "ISO-8859-1").csv(path)
    return path


@query("a01_h04_messy_readings", "SELECT * FROM device_readings WHERE day(date) <> 13")
def a01_messy(spark, sf):
    return io.load_device_readings(spark, _messy_files(spark, sf))


@query("a01_readings_report", """
SELECT count(*) + sum(CASE WHEN day(date) % 5 = 0 THEN 1 ELSE 0 END) AS rows_read, 0 AS rows_corrupt, 0 AS rows_without_device,
       sum(CASE WHEN day(date) = 13 THEN 1 ELSE 0 END) AS rows_without_date, sum(CASE WHEN day(date) % 5 = 0 THEN 1 ELSE 0 END) AS rows_repeated,
       sum(CASE WHEN day(date) <> 13 THEN 1 ELSE 0 END) AS rows_kept FROM device_readings""")
def a01_report(spark, sf):
    return io.readings_report(spark, _messy_files(spark, sf))


@query("d01_data_completeness", """
WITH pd AS (SELECT device, count(*) AS n FROM device_readings GROUP BY 1),
pt AS (SELECT date, count(*) AS n FROM device_readings GROUP BY 1),
k AS (SELECT (SELECT count(*) FROM pd) AS nd, (SELECT count(*) FROM pt) AS nt)
SELECT k.nd AS total_devices, k.nt AS total_dates, k.nd * k.nt AS expected_records,
       count(*) AS actual_records, CAST(count(*) AS DOUBLE) / (k.nd * k.nt) * 100 AS completeness_rate,
       (SELECT count(*) FROM pd WHERE n = k.nt) AS complete_devices,
       (SELECT count(*) FROM pt WHERE n = k.nd) AS complete_dates,
       avg(failure) AS failure_rate, min(date) AS first_date, max(date) AS last_date
FROM device_readings, k GROUP BY k.nd, k.nt""")
def d01(spark, sf):
    return pr.data_completeness(_dr(spark, sf))


@query("d02_failure_distribution", """
WITH a AS (SELECT sum(CASE WHEN failure = 0 THEN 1 ELSE 0 END) AS n0, sum(CASE WHEN failure = 1 THEN 1 ELSE 0 END) AS n1,
                  CAST(coalesce(sum(failure), 0) AS DOUBLE) / count(*) * 100 AS rate FROM device_readings)
SELECT 0 AS failure, n0 AS count, 100 - rate AS pct FROM a
UNION ALL SELECT 1, n1, rate FROM a""")
def d02(spark, sf):
    return pr.failure_distribution(_dr(spark, sf))


@query("d03_device_failures", """
SELECT device, coalesce(sum(failure), 0) AS total_failures, count(failure) AS total_records,
       avg(failure) AS failure_rate FROM device_readings GROUP BY 1""")
def d03(spark, sf):
    return pr.device_failures(_dr(spark, sf))


@query("d04_daily_failures", """
SELECT date, coalesce(sum(failure), 0) AS total_failures, count(failure) AS total_devices,
       avg(failure) AS failure_rate FROM device_readings GROUP BY 1""")
def d04(spark, sf):
    return pr.daily_failures(_dr(spark, sf))


@query("d03_failure_pattern_summary", """
WITH dv AS (SELECT device, coalesce(sum(failure), 0) AS t, avg(failure) AS r FROM device_readings GROUP BY 1),
dy AS (SELECT date, coalesce(sum(failure), 0) AS t, avg(failure) AS r FROM device_readings GROUP BY 1)
SELECT (SELECT sum(CASE WHEN t > 0 THEN 1 ELSE 0 END) FROM dv) AS devices_with_failures,
       (SELECT sum(CASE WHEN t = 0 THEN 1 ELSE 0 END) FROM dv) AS devices_without_failures,
       (SELECT avg(r) FROM dv) AS mean_device_failure_rate,
       (SELECT sum(CASE WHEN t > 0 THEN 1 ELSE 0 END) FROM dy) AS days_with_failures,
       (SELECT sum(CASE WHEN t = 0 THEN 1 ELSE 0 END) FROM dy) AS days_without_failures,
       (SELECT avg(r) FROM dy) AS mean_daily_failure_rate""")
def d03s(spark, sf):
    return pr.failure_pattern_summary(_dr(spark, sf))


# ------------------------------------------------------------------ F: SQL twin of the bundle
W = "PARTITION BY device ORDER BY date"


def _past(n=None):
    lo = "UNBOUNDED PRECEDING" if n is None else f"{n} PRECEDING"
    return f"({W} ROWS BETWEEN {lo} AND 1 PRECEDING)"


def _cal_sql():
    out = ["CAST(year(date) AS SMALLINT) AS year", "CAST(isodow(date) - 1 AS TINYINT) AS dayofweek"]
    for name, v, p in (("month", "month(date)", 12), ("day", "day(date)", 31),
                       ("doy", "dayofyear(date)", 365), ("week", "weekofyear(date)", 53),
                       ("quarter", "quarter(date)", 4)):
        out.append(f"CAST(sin(2.0::DOUBLE * pi() * {v} / {p}) AS FLOAT) AS {name}_sin")
        out.append(f"CAST(cos(2.0::DOUBLE * pi() * {v} / {p}) AS FLOAT) AS {name}_cos")
    out += ["CAST(isodow(date) - 1 >= 5 AS TINYINT) AS is_weekend",
            "CAST(day(date) = 1 AS TINYINT) AS is_month_start",
            "CAST(date = last_day(date) AS TINYINT) AS is_month_end",
            "CAST(day(date) = 1 AND month(date) IN (1, 4, 7, 10) AS TINYINT) AS is_quarter_start",
            "CAST(date = last_day(date) AND month(date) IN (3, 6, 9, 12) AS TINYINT) AS is_quarter_end"]
    return out


def _hist_sql():
    return [f"CAST(coalesce(sum(failure) OVER {_past()}, 0) AS DOUBLE) AS device_total_failures",
            f"coalesce(date_diff('day', max(CASE WHEN failure = 1 THEN date END) OVER {_past()}, date), 999)"
            " AS days_since_last_failure"]


def _attr_sql(a):
    out = [f"lag({a}, {k}) OVER ({W}) AS {a}_lag_{k}" for k in fe.lag_windows(7)]
    out += [f"avg({a}) OVER {_past(k)} AS {a}_ma_{k}" for k in (3, 7, 14)]
    out += [f"stddev_samp({a}) OVER {_past(k)} AS {a}_std_{k}" for k in (7, 14)]
    out.append(f"{a} - lag({a}, 1) OVER ({W}) AS {a}_diff")
    filled = f"last_value({a} IGNORE NULLS) OVER ({W} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    prev = f"last_value({a} IGNORE NULLS) OVER {_past()}"
    out.append(f"CASE WHEN {prev} <> 0 THEN {filled} / {prev} - 1 END AS {a}_pct_diff")
    return out


def _ctx_sql():
    out = [f"CAST(row_number() OVER ({W}) - 1 AS BIGINT) AS device_obs_so_far",
           f"coalesce(date_diff('day', lag(date, 1) OVER ({W}), date), 0) AS days_since_last_record"]
    out += [f"stddev_samp({a}) OVER {_past()} AS {a}_std_expanding" for a in FIRST4]
    return out


def _inter_sql():
    out = []
    for i, a in enumerate(FIRST4):
        for b in FIRST4[i + 1:]:
            out += [f"{a} + {b} AS {a}_{b}_sum", f"{a} - {b} AS {a}_{b}_diff",
                    f"{sql_div(a, f'{b} + 1e-8')} AS {a}_{b}_ratio"]
    return out


def _slope_sql():
    out = []
    for a in FIRST4:
        for k in (7, 14):
            f = _past(k)
            x = "CAST(__rn AS DOUBLE)"
            num = f"({k}.0::DOUBLE * sum({a} * {x}) OVER {f} - sum({x}) OVER {f} * sum({a}) OVER {f})"
            den = f"({k}.0::DOUBLE * sum({x} * {x}) OVER {f} - sum({x}) OVER {f} * sum({x}) OVER {f})"
            out.append(f"CASE WHEN count({a}) OVER {f} = {k} THEN {num} / {den} END AS {a}_slope_{k}")
    return out


def _z_sql(a):
    f = _past(30)
    return (f"coalesce(CASE WHEN count({a}) OVER {f} >= 5 THEN ({a} - avg({a}) OVER {f}) / "
            f"nullif(stddev_samp({a}) OVER {f}, 0) END, 0.0) AS {a}_normalized")


def feature_sql(parts=("cal", "hist", "attr", "ctx", "inter", "slope", "z"), keep_base=True):
    sel = []
    if "cal" in parts:
        sel += _cal_sql()
    if "hist" in parts:
        sel += _hist_sql()
    if "attr" in parts:
        for a in ATTRS:
            sel += _attr_sql(a)
    if "ctx" in parts:
        sel += _ctx_sql()
    if "inter" in parts:
        sel += _inter_sql()
    if "slope" in parts:
        sel += _slope_sql()
    z_extra = ""
    if "z" in parts:
        sel += [_z_sql(a) for a in ATTRS]
        sel += [f"CAST({a} IS NULL AS TINYINT) AS {a}_isna" for a in ATTRS]
        z_extra = ", " + ", ".join(
            f'CAST({a}_normalized > 2 AS TINYINT) AS {a}_normalized_gt2sigma, '
            f'CAST({a}_normalized < -2 AS TINYINT) AS "{a}_normalized_lt-2sigma"' for a in ATTRS)
    base = "device, date, " + ", ".join(ATTRS) + ", failure, " if keep_base else "device, date, "
    return (f"SELECT *{z_extra} FROM (SELECT {base}{', '.join(sel)} FROM "
            f"(SELECT *, row_number() OVER ({W}) AS __rn FROM device_readings))")


def label_sql(inner: str, horizon: int, label_col: str = "early_warn_target", drop_failure=True):
    nxt = (f"min(CASE WHEN failure = 1 THEN date END) OVER ({W} ROWS BETWEEN CURRENT ROW AND "
           f"UNBOUNDED FOLLOWING)")
    pos = f"coalesce(date_diff('day', date, __next) <= {horizon}, false)"
    excl = "EXCLUDE (__next, __last, failure)" if drop_failure else "EXCLUDE (__next, __last)"
    return f"""SELECT * {excl}, CAST({pos} AS INTEGER) AS {label_col} FROM (
  SELECT *, {nxt} AS __next, max(date) OVER (PARTITION BY device) AS __last FROM ({inner}))
WHERE {pos} OR (date <= __last - INTERVAL {horizon} DAY AND coalesce(failure, 0) <> 1)"""


def _feat(spark, sf, **kw):
    return fe.device_features(_dr(spark, sf), forecast_horizon=H, **kw)


def _cols(prefixes):
    return [f"`{c}`" for c in prefixes]


@query("f01_calendar_features", feature_sql(("cal",), keep_base=False))
def f01(spark, sf):
    d = _feat(spark, sf, label=False)
    names = ["device", "date", "year", "dayofweek"] + [f"{n}_{t}" for n in ("month", "day", "doy", "week", "quarter")
                                                       for t in ("sin", "cos")] + \
        ["is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end"]
    return d.select(*names)


@query("f02_failure_history", feature_sql(("hist",), keep_base=False))
def f02(spark, sf):
    return _feat(spark, sf, label=False).select("device", "date", "device_total_failures",
                                                "days_since_last_failure")


@query("f04_attribute_windows", feature_sql(("attr",), keep_base=False))
def f04(spark, sf):
    d = _feat(spark, sf, label=False)
    suffixes = [f"lag_{k}" for k in fe.lag_windows(7)] + ["ma_3", "ma_7", "ma_14", "std_7", "std_14",
                                                           "diff", "pct_diff"]
    return d.select("device", "date", *[f"{a}_{s}" for a in ATTRS for s in suffixes])


@query("f08_context_features", feature_sql(("ctx",), keep_base=False))
def f08(spark, sf):
    return _feat(spark, sf, label=False).select(
        "device", "date", "device_obs_so_far", "days_since_last_record",
        *[f"{a}_std_expanding" for a in FIRST4])


@query("b22_interaction_features", feature_sql(("inter",), keep_base=False))
def b22(spark, sf):
    d = _feat(spark, sf, label=False)
    return d.select("device", "date", *[c for c in d.columns
                                        if c.endswith(("_sum", "_ratio")) or
                                        (c.endswith("_diff") and c.count("attribute") == 2)])


@query("f11_trend_slopes", feature_sql(("slope",), keep_base=False))
def f11(spark, sf):
    return _feat(spark, sf, label=False).select(
        "device", "date", *[f"{a}_slope_{k}" for a in FIRST4 for k in (7, 14)])


@query("f12_rolling_zscore", feature_sql(("z",), keep_base=False))
def f12(spark, sf):
    d = _feat(spark, sf, label=False)
    return d.select("device", "date", *_cols([c for c in d.columns if "_normalized" in c or c.endswith("_isna")]))


@query("f13_past_median_impute", f"""
SELECT device, date, failure, {', '.join(
    f"coalesce({a}, CASE WHEN count({a}) OVER {_past(14)} >= 3 THEN quantile_cont({a}, 0.5) OVER {_past(14)} END) AS {a}"
    for a in ATTRS)} FROM device_readings""")
def f13(spark, sf):
    return fe.past_median_impute(_dr(spark, sf))


@query("f14_device_features", label_sql(feature_sql(), H))
def f14(spark, sf):
    return _feat(spark, sf)


# ------------------------------------------------------------------ G1-G7
@query("g01_early_warning_labels", label_sql("SELECT device, date, failure FROM device_readings", H,
                                             "y", drop_failure=False))
def g01(spark, sf):
    return lb.early_warning_labels(_dr(spark, sf).select("device", "date", "failure"), "failure", H, "y")


@query("g02_temporal_split", "SELECT device, date, y, split FROM split_rows")
def g02(spark, sf):
    lab = lb.early_warning_labels(_dr(spark, sf).select("device", "date", "failure"), "failure", H, "y")
    return lb.temporal_split(lab, FIXTURE_PURGE, FIXTURE_SIZE, FIXTURE_SIZE).select("device", "date", "y", "split")


def _folds_sql(n=3, purge=FIXTURE_PURGE, size=FIXTURE_SIZE):
    parts = []
    for f in range(1, n + 1):
        parts.append(f"""
SELECT device, date, y, {f} AS fold,
  CASE WHEN date <= vc - INTERVAL {purge} DAY THEN 'train'
       WHEN date >= vc + INTERVAL {purge} DAY AND date <= tc - INTERVAL {purge} DAY THEN 'val' END AS split
FROM (SELECT l.*, CAST(b.hi - to_days(CAST(floor(b.span * {size * f / n}::DOUBLE) AS INTEGER)) AS DATE) AS tc,
             CAST(b.hi - to_days(CAST(floor(b.span * {size * f / n}::DOUBLE) AS INTEGER))
                  - to_days(CAST(floor(b.span * {size}::DOUBLE) AS INTEGER)) AS DATE) AS vc
      FROM labelled l, (SELECT max(date) AS hi, date_diff('day', min(date), max(date)) AS span FROM labelled) b)""")
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE split IS NOT NULL"


@query("g03_rolling_origin_folds", _folds_sql())
def g03(spark, sf):
    lab = lb.early_warning_labels(_dr(spark, sf).select("device", "date", "failure"), "failure", H, "y")
    return lb.rolling_origin_folds(lab.select("device", "date", "y"), 3, FIXTURE_PURGE, FIXTURE_SIZE,
                                   FIXTURE_SIZE)


@query("g04_positional_holdout", """
WITH v AS (SELECT device, date, y FROM scored WHERE split = 'val')
SELECT device, date, y, CASE WHEN row_number() OVER (ORDER BY device, date) - 1 < floor((SELECT count(*) FROM v) * 0.2::DOUBLE)
                        THEN 'model' ELSE 'hold' END AS part FROM v""")
def g04(spark, sf):
    v = scored(spark, sf).where(F.col("split") == "val").select("device", "date", "y")
    return lb.positional_holdout(v, 0.2)


_KEY = "md5(device || '|' || CAST(date AS VARCHAR) || '|' || '42')"


@query("g05_undersample", f"""
WITH t AS (SELECT device, date, y FROM scored WHERE split = 'train'),
c AS (SELECT sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS nn FROM t),
neg AS (SELECT t.*, row_number() OVER (ORDER BY {_KEY}) AS rk FROM t WHERE y = 0)
SELECT device, date, y FROM t WHERE y <> 0
UNION ALL
SELECT device, date, y FROM neg, c WHERE c.np = 0 OR least(c.nn, c.np * 4) >= c.nn OR rk <= least(c.nn, c.np * 4)""")
def g05(spark, sf):
    t = scored(spark, sf).where(F.col("split") == "train").select("device", "date", "y")
    return lb.undersample(t, "y", neg_per_pos=4, seed=42)


@query("g06_undersample_hard_negatives", f"""
WITH t AS (SELECT device, date, y FROM scored WHERE split = 'train'),
d AS (SELECT *, coalesce(greatest(date_diff('day', date, min(CASE WHEN y = 1 THEN date END) OVER
        (PARTITION BY device ORDER BY date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)), 0), 9999) AS dist FROM t),
c AS (SELECT sum(CASE WHEN y = 1 THEN 1 ELSE 0 END) AS np, sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) AS nn FROM t),
neg AS (SELECT d.*, row_number() OVER (ORDER BY
          -ln((CAST(('0x' || substr({_KEY}, 1, 13)) AS BIGINT) + 0.5) / 4503599627370496.0) * (1.0 + dist), {_KEY}) AS rk
        FROM d WHERE y = 0)
SELECT device, date, y FROM t WHERE y <> 0
UNION ALL
SELECT device, date, y FROM neg, c WHERE c.np = 0 OR rk <= least(c.nn, c.np * 2)""")
def g06(spark, sf):
    t = scored(spark, sf).where(F.col("split") == "train").select("device", "date", "y")
    return lb.undersample_hard_negatives(t, "y", neg_per_pos=2, seed=42)


@query("g07_median_impute", f"""
WITH b AS (SELECT max(date) AS hi, date_diff('day', min(date), max(date)) AS span FROM device_readings),
tr AS (SELECT r.* FROM device_readings r, b
       WHERE r.date <= CAST(b.hi - to_days(2 * CAST(floor(b.span * 0.3::DOUBLE) AS INTEGER)) AS DATE) - INTERVAL 1 DAY),
m AS (SELECT {', '.join(f'quantile_cont({a}, 0.5) AS m_{a}' for a in ATTRS)} FROM tr)
SELECT device, date, failure, {', '.join(f'coalesce({a}, m.m_{a}) AS {a}' for a in ATTRS)}
FROM device_readings, m""")
def g07(spark, sf):
    dr = _dr(spark, sf)
    train = lb.temporal_split(dr, FIXTURE_PURGE, FIXTURE_SIZE, FIXTURE_SIZE).where(F.col("split") == "train")
    return lb.median_impute(train, dr, ATTRS).select("device", "date", "failure", *ATTRS)
