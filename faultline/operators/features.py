"""Per-device time-series features.

Every frame is a *row* frame over ``partitionBy(device).orderBy(date)``; "past" frames end at
the previous row.  The whole bundle is one ``select`` over one window specification, so the
physical plan has a single Exchange on ``device`` and a single Sort for all ~190 expressions
(a device's history is one bounded partition group; no per-feature shuffles).  The early
warning label adds one local Sort (descending date) on the same partitioning, no Exchange.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.exprs import np_div
from faultline.operators.labels import early_warning_labels, labelled, with_next_failure

NO_FAILURE = 999
TWO_PI = 2 * math.pi


def _w(device="device", date="date"):
    return Window.partitionBy(device).orderBy(date)


def _past(w, n=None):
    return w.rowsBetween(Window.unboundedPreceding if n is None else -n, -1)


def attribute_columns(df: DataFrame, prefix: str = "attribute") -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


# --------------------------------------------------------------------------- F1
def calendar_features(date: Column) -> dict[str, Column]:
    """calendar and cyclic encodings (Monday = 0; ISO week)."""
    m, d = F.month(date), F.dayofmonth(date)
    out = {
        "year": F.year(date),
        "dayofweek": F.weekday(date),
    }
    for name, v, period in (("month", m, 12), ("day", d, 31), ("doy", F.dayofyear(date), 365),
                            ("week", F.weekofyear(date), 53), ("quarter", F.quarter(date), 4)):
        ang = F.lit(2.0) * F.lit(math.pi) * v / F.lit(period)
        out[f"{name}_sin"] = F.sin(ang)
        out[f"{name}_cos"] = F.cos(ang)
    month_end = date == F.last_day(date)
    out["is_weekend"] = (F.weekday(date) >= 5).cast("int")
    out["is_month_start"] = (d == 1).cast("int")
    out["is_month_end"] = month_end.cast("int")
    out["is_quarter_start"] = ((d == 1) & m.isin(1, 4, 7, 10)).cast("int")
    out["is_quarter_end"] = (month_end & m.isin(3, 6, 9, 12)).cast("int")
    return out


NARROW_TYPES = {"year": "smallint", "dayofweek": "tinyint", "is_weekend": "tinyint",
                "is_month_start": "tinyint", "is_month_end": "tinyint",
                "is_quarter_start": "tinyint", "is_quarter_end": "tinyint"}


def narrow_types(cols: dict[str, Column]) -> dict[str, Column]:
    """Calendar features to narrow types (unsigned in the source; Spark has no unsigned
    types, so the next signed width is used); cyclic encodings to float."""
    out = {}
    for k, v in cols.items():
        if k in NARROW_TYPES:
            out[k] = v.cast(NARROW_TYPES[k])
        elif k.endswith("_sin") or k.endswith("_cos"):
            out[k] = v.cast("float")
        else:
            out[k] = v
    return out


# --------------------------------------------------------------------------- F2-F13
def failure_history(target: str, w) -> dict[str, Column]:
    """failures strictly before the row (0 if none); days since the last earlier
    failure (999 if none)."""
    f = F.col(target)
    last_fail = F.max(F.when(f == 1, F.col("date"))).over(_past(w))
    return {
        "device_total_failures": F.coalesce(F.sum(f).over(_past(w)), F.lit(0)).cast("double"),
        "days_since_last_failure": F.coalesce(F.datediff(F.col("date"), last_fail), F.lit(NO_FAILURE)),
    }


def lag_windows(max_lags: int = 7) -> list[int]:
    return [1, 2, 3, 7] if max_lags <= 7 else [1, 2, 3, 7, 14, 30]


def attribute_window_features(attr: str, w, max_lags: int = 7) -> dict[str, Column]:
    """F4-F7 for one attribute: lags, past means (3/7/14, >= 1 value), past sample std (7/14,
    >= 2 values), diff and forward-filled pct change (inf and 0/0 -> missing)."""
    x = F.col(attr)
    out = {f"{attr}_lag_{k}": F.lag(x, k).over(w) for k in lag_windows(max_lags)}
    for k in (3, 7, 14):
        out[f"{attr}_ma_{k}"] = F.avg(x).over(_past(w, k))
    for k in (7, 14):
        out[f"{attr}_std_{k}"] = F.stddev_samp(x).over(_past(w, k))
    out[f"{attr}_diff"] = x - F.lag(x, 1).over(w)
    filled = F.last(x, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    prev = F.last(x, ignorenulls=True).over(_past(w))
    out[f"{attr}_pct_diff"] = F.when(prev != 0, filled / prev - 1)
    return out


def trend_slope(attr: str, w, rn: Column, k: int) -> Column:
    """least-squares slope of the past ``k`` rows, only when all ``k`` are present.

    Closed form from window sums, (k*Sxy - Sx*Sy) / (k*Sxx - Sx^2) with x = row position:
    plain arithmetic on four framed sums, identical on every engine (the slope does not
    depend on where positions start)."""
    f = _past(w, k)
    y = F.col(attr)
    sy, sxy = F.sum(y).over(f), F.sum(y * rn).over(f)
    sx, sxx = F.sum(rn).over(f), F.sum(rn * rn).over(f)
    slope = (F.lit(float(k)) * sxy - sx * sy) / (F.lit(float(k)) * sxx - sx * sx)
    return F.when(F.count(y).over(f) == k, slope)


def rolling_zscore(attr: str, w, window: int = 30, min_periods: int = 5) -> Column:
    """(x - past mean) / past sample std over ``window`` rows with >= ``min_periods``
    values; infinite, undefined or missing results are 0."""
    f = _past(w, window)
    x = F.col(attr)
    z = F.when(F.count(x).over(f) >= min_periods,
               F.try_divide(x - F.avg(x).over(f), F.stddev_samp(x).over(f)))
    return F.coalesce(z, F.lit(0.0))


def interaction_features(attrs: list[str]) -> dict[str, Column]:
    """All pairs of the given attributes: sum, difference, a / (b + 1e-8)."""
    out = {}
    for i, a in enumerate(attrs):
        for b in attrs[i + 1:]:
            out[f"{a}_{b}_sum"] = F.col(a) + F.col(b)
            out[f"{a}_{b}_diff"] = F.col(a) - F.col(b)
            out[f"{a}_{b}_ratio"] = np_div(F.col(a), F.col(b) + F.lit(1e-8))
    return out


def device_features(df: DataFrame, target_col: str = "failure", forecast_horizon: int = 7,
                    enable_interactions: bool = True, max_lags: int = 7, narrow: bool = True,
                    label: bool = True, zscore_window: int = 30,
                    detailed: list[str] | None = None, newest_first: bool = False) -> DataFrame:
    """the full feature bundle, then the early-warning label (G1) and ``failure`` dropped.

    ``detailed``: the attributes that get expanding deviations, slopes and interactions (F10, F11,
    B22); by default the first four, as in the source.

    ``newest_first``: the label is worked out last, over the finished features, whose sort leaves each device's
    rows newest first; a training's draws hang on that order.  Otherwise it is worked out on the input's
    few columns, and the finished features are not sorted again.

    With ``label=False`` the unlabelled feature table is returned (target kept)."""
    w = _w()
    attrs = attribute_columns(df)
    first4 = attrs[:4] if detailed is None else list(detailed)
    cols: dict[str, Column] = {}
    cal = calendar_features(F.col("date"))
    cols.update(narrow_types(cal) if narrow else cal)
    cols.update(failure_history(target_col, w))
    for a in attrs:
        cols.update(attribute_window_features(a, w, max_lags))
    cols["device_obs_so_far"] = (F.row_number().over(w) - 1).cast("long")
    cols["days_since_last_record"] = F.coalesce(F.datediff(F.col("date"), F.lag("date", 1).over(w)),
                                                F.lit(0))
    for a in first4:
        cols[f"{a}_std_expanding"] = F.stddev_samp(a).over(_past(w))
    if enable_interactions:
        cols.update(interaction_features(first4))
    # slopes regress on the row position; positions come from the same sort
    rn = F.col("__rn").cast("double")
    slopes = {f"{a}_slope_{k}": trend_slope(a, w, rn, k) for a in first4 for k in (7, 14)}
    norm = {f"{a}_normalized": rolling_zscore(a, w, zscore_window) for a in attrs}
    isna = {f"{a}_isna": F.col(a).isNull().cast("tinyint" if narrow else "int") for a in attrs}
    marked = with_next_failure(df, target_col) if label and not newest_first else df
    base = marked.select("*", F.row_number().over(w).alias("__rn"))
    feats = base.select(*[F.col(f"`{c}`") for c in marked.columns],
                        *[v.alias(k) for k, v in cols.items()],
                        *[v.alias(k) for k, v in slopes.items()],
                        *[v.alias(k) for k, v in norm.items()],
                        *[v.alias(k) for k, v in isna.items()])
    sig = []
    for a in attrs:
        z = F.col(f"{a}_normalized")
        t = "tinyint" if narrow else "int"
        sig += [(z > 2).cast(t).alias(f"{a}_normalized_gt2sigma"),
                (z < -2).cast(t).alias(f"{a}_normalized_lt-2sigma")]
    out = feats.select("*", *sig)
    if not label:
        return out
    lab = early_warning_labels(out, target_col, forecast_horizon) if newest_first else labelled(out, target_col, forecast_horizon)
    return lab.drop(target_col)


def past_median_impute(df: DataFrame, window: int = 14, min_periods: int = 3,
                       prefix: str = "attribute") -> DataFrame:
    """a missing attribute takes the median of the device's previous ``window`` rows when
    at least ``min_periods`` of them are present (exact percentile over a bounded frame)."""
    w = _w()
    f = _past(w, window)
    cols = [c for c in df.columns if c.startswith(prefix)]
    rep = {c: F.coalesce(F.col(c), F.when(F.count(c).over(f) >= min_periods,
                                          F.percentile(F.col(c), 0.5).over(f))).alias(c)
           for c in cols}
    return df.select(*[rep.get(c, F.col(f"`{c}`")) for c in df.columns])


def feature_names(attrs: list[str] | None = None, max_lags: int = 7, enable_interactions: bool = True,
                  label_col: str | None = "early_warn_target", detailed: list[str] | None = None) -> list[str]:
    """Column names of ``device_features`` in output order (no Spark needed)."""
    attrs = attrs or [f"attribute{i}" for i in range(1, 10)]
    first4 = attrs[:4] if detailed is None else list(detailed)
    names = ["device", "date", *attrs, "year", "dayofweek"]
    names += [f"{n}_{t}" for n in ("month", "day", "doy", "week", "quarter") for t in ("sin", "cos")]
    names += ["is_weekend", "is_month_start", "is_month_end", "is_quarter_start", "is_quarter_end",
              "device_total_failures", "days_since_last_failure"]
    for a in attrs:
        names += [f"{a}_lag_{k}" for k in lag_windows(max_lags)]
        names += [f"{a}_ma_{k}" for k in (3, 7, 14)] + [f"{a}_std_{k}" for k in (7, 14)]
        names += [f"{a}_diff", f"{a}_pct_diff"]
    names += ["device_obs_so_far", "days_since_last_record"] + [f"{a}_std_expanding" for a in first4]
    if enable_interactions:
        for i, a in enumerate(first4):
            for b in first4[i + 1:]:
                names += [f"{a}_{b}_sum", f"{a}_{b}_diff", f"{a}_{b}_ratio"]
    names += [f"{a}_slope_{k}" for a in first4 for k in (7, 14)]
    names += [f"{a}_normalized" for a in attrs] + [f"{a}_isna" for a in attrs]
    for a in attrs:
        names += [f"{a}_normalized_gt2sigma", f"{a}_normalized_lt-2sigma"]
    if label_col:
        names.append(label_col)
    return names
