"""Labels, temporal splits and sampling.

Per-device logic uses windows partitioned by ``device`` (one shuffle on the device key,
bounded work per device).  Split bounds are scalar subqueries (one-row aggregates Spark
evaluates once and inlines as literals), never cross joins or driver loops.  Sampling is
keyed by an md5 of (device, date, seed), so the same rows are drawn on every engine and on
every task retry.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.plans.prefix import exact_quantiles, prefix_sums

NO_FAILURE_DAYS = 9999


def early_warning_labels(df: DataFrame, target_col: str = "failure", horizon_days: int = 10,
                         label_col: str = "early_warn_target") -> DataFrame:
    """G1: 1 if the next failure (on/after the row) is within ``horizon_days``; 0 if the row is
    at least ``horizon_days`` before the device's last reading, not positive and not a failure
    day; all other rows are dropped.  The failure day itself is positive (delta 0).
    """
    return labelled(with_next_failure(df, target_col), target_col, horizon_days, label_col)


def with_next_failure(df: DataFrame, target_col: str) -> DataFrame:
    """``df`` with ``__next``, the device's next failure on or after the row, and ``__last``, its last date."""
    desc = Window.partitionBy("device").orderBy(F.col("date").desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    dev = Window.partitionBy("device")
    # next failure on/after the row = running min over the reversed order (O(n) per device)
    next_fail = F.min(F.when(F.col(target_col) == 1, F.col("date"))).over(desc)
    last_date = F.max("date").over(dev)
    return df.select("*", next_fail.alias("__next"), last_date.alias("__last"))


def labelled(t: DataFrame, target_col: str, horizon_days: int, label_col: str = "early_warn_target") -> DataFrame:
    """The labelled rows (G1) of a table that ``with_next_failure`` has marked, without its two columns."""
    pos = F.coalesce(F.datediff("__next", "date") <= horizon_days, F.lit(False))
    is_fail = F.coalesce(F.col(target_col) == 1, F.lit(False))
    safe_neg = (F.col("date") <= F.date_sub("__last", horizon_days)) & ~pos & ~is_fail
    return t.where(pos | safe_neg).select(*[F.col(f"`{c}`") for c in t.columns if c not in ("__next", "__last")],
                                          pos.cast("int").alias(label_col))


def _bounds(df: DataFrame, date_col: str = "date"):
    b = df.select(F.min(date_col).alias("lo"), F.max(date_col).alias("hi"))
    lo = b.select("lo").scalar()
    hi = b.select("hi").scalar()
    return lo, hi


def split_cuts(df: DataFrame, val_size: float, test_size: float, fold_ratio: float = 1.0,
               date_col: str = "date"):
    """(val_cut, test_cut) as scalar-subquery columns: test_cut = max - int(span*test*ratio)."""
    lo, hi = _bounds(df, date_col)
    span = F.datediff(hi, lo)
    test_cut = F.date_sub(hi, F.floor(span * F.lit(test_size * fold_ratio)).cast("int"))
    val_cut = F.date_sub(test_cut, F.floor(span * F.lit(val_size)).cast("int"))
    return val_cut, test_cut


def temporal_split(df: DataFrame, purge_days: int = 7, val_size: float = 0.2,
                   test_size: float = 0.2, split_col: str = "split",
                   date_col: str = "date") -> DataFrame:
    """Train <= val_cut - p; val in [val_cut + p, test_cut - p]; test >= test_cut + p.
    Rows in the 2p-day purge gaps get a NULL split."""
    val_cut, test_cut = split_cuts(df, val_size, test_size, 1.0, date_col)
    d = F.col(date_col)
    s = (F.when(d <= F.date_sub(val_cut, purge_days), F.lit("train"))
         .when((d >= F.date_add(val_cut, purge_days)) & (d <= F.date_sub(test_cut, purge_days)),
               F.lit("val"))
         .when(d >= F.date_add(test_cut, purge_days), F.lit("test")))
    return df.select("*", s.alias(split_col))


def rolling_origin_folds(df: DataFrame, n_splits: int = 3, purge_days: int = 7,
                         val_size: float = 0.2, test_size: float = 0.2,
                         date_col: str = "date") -> DataFrame:
    """Rows tagged (fold, split) for every fold they belong to; fold 1 is the most recent.

    fold f: test_cut = max - int(span * test * f / n); val_cut = test_cut - int(span * val);
    train <= val_cut - p; val in [val_cut + p, test_cut - p].  A row may be in several folds.
    """
    d = F.col(date_col)
    tags = []
    for f in range(1, n_splits + 1):
        val_cut, test_cut = split_cuts(df, val_size, test_size, f / n_splits, date_col)
        s = (F.when(d <= F.date_sub(val_cut, purge_days), F.lit("train"))
             .when((d >= F.date_add(val_cut, purge_days)) & (d <= F.date_sub(test_cut, purge_days)),
                   F.lit("val")))
        tags.append(F.struct(F.lit(f).alias("fold"), s.alias("split")))
    return (df.select("*", F.explode(F.array(*tags)).alias("__t"))
            .where(F.col("__t.split").isNotNull())
            .select(*[F.col(f"`{c}`") for c in df.columns], "__t.fold", "__t.split"))


def positional_holdout(df: DataFrame, frac: float = 0.2, part_col: str = "part",
                       order_cols=("device", "date")) -> DataFrame:
    """The first ``int(n * frac)`` rows in (device, date) order are "model", the rest "hold".

    Exact global position without a single-partition window: per-device counts, a distributed
    prefix sum over devices, plus the row number inside the device.
    """
    first, rest = order_cols[0], list(order_cols[1:])
    counts = df.groupBy(first).agg(F.count(F.lit(1)).alias("__n"))
    offs = prefix_sums(counts, [first], ["__n"]).select(
        first, (F.col("cum___n") - F.col("__n")).alias("__off"))
    n = df.select(F.count(F.lit(1))).scalar()
    cut = F.floor(n * F.lit(frac))
    w = Window.partitionBy(first).orderBy(*rest)
    t = df.join(offs, on=first, how="inner")
    posn = F.col("__off") + F.row_number().over(w) - 1
    return t.select(*[F.col(f"`{c}`") for c in df.columns],
                    F.when(posn < cut, F.lit("model")).otherwise(F.lit("hold")).alias(part_col))


def sample_key(seed: int, device: str = "device", date: str = "date"):
    """Hex md5 of "device|date|seed" — the same string in Spark and DuckDB; ordering the hex
    text equals ordering the 128-bit number."""
    return F.md5(F.concat_ws("|", F.col(device), F.col(date).cast("string"), F.lit(str(seed))))


def sample_uniform01(seed: int, device: str = "device", date: str = "date"):
    """u in (0, 1) from the first 13 hex digits of the sample key."""
    h = F.substring(sample_key(seed, device, date), 1, 13)
    return (F.conv(h, 16, 10).cast("double") + F.lit(0.5)) / F.lit(float(16 ** 13))


def undersample(df: DataFrame, label_col: str = "y", neg_per_pos: int = 50,
                max_neg_cap: int | None = None, seed: int = 42) -> DataFrame:
    """All positives + exactly min(n_neg, r*n_pos, cap) negatives, uniformly drawn.

    No positives, or a target >= n_neg, leaves the input unchanged.  The draw is the
    ``target`` smallest sample keys.  Only the keys are ranked (distributed, no global sort into
    one task); the rows are then filtered by the largest key drawn.
    """
    y = F.col(label_col)
    counts = df.select(F.sum(F.when(y == 1, 1).otherwise(0)).alias("p"),
                       F.sum(F.when(y == 0, 1).otherwise(0)).alias("n"))
    n_pos = counts.select(F.coalesce("p", F.lit(0))).scalar()
    n_neg = counts.select(F.coalesce("n", F.lit(0))).scalar()
    target = F.least(n_neg, n_pos * F.lit(neg_per_pos))
    if max_neg_cap is not None:
        target = F.least(target, F.lit(max_neg_cap))
    key = sample_key(seed)
    last = _last_drawn(df.where(y == 0), [key], target)
    return df.where((y != 0) | ((y == 0) & ((n_pos == 0) | (target >= n_neg) | (key <= last["k0"]))))


def _last_drawn(negatives: DataFrame, keys: list, target):
    """The largest of the ``target`` smallest keys (a struct k0, k1, ..., as a scalar subquery)."""
    names = [f"k{i}" for i in range(len(keys))]
    counted = negatives.groupBy(*[k.alias(n) for k, n in zip(keys, names)]).agg(F.count(F.lit(1)).alias("__n"))
    ranked = prefix_sums(counted, names, ["__n"])
    return ranked.where(F.col("cum___n") <= target).select(F.max(F.struct(*names))).scalar()


def undersample_hard_negatives(df: DataFrame, label_col: str = "y", neg_per_pos: int = 10,
                               seed: int = 42) -> DataFrame:
    """Weighted draw of min(n_neg, r*n_pos) negatives, weight 1/(1 + days to the device's
    next positive row), 9999 days when none; either class empty -> unchanged.

    Weighted sampling without replacement = the smallest Efraimidis-Spirakis keys
    -ln(u)/w (same distribution as successive weighted draws).
    """
    y = F.col(label_col)
    desc = Window.partitionBy("device").orderBy(F.col("date").desc()) \
        .rowsBetween(Window.unboundedPreceding, 0)
    nxt = F.min(F.when(y == 1, F.col("date"))).over(desc)
    dist = F.coalesce(F.greatest(F.datediff(nxt, F.col("date")), F.lit(0)), F.lit(NO_FAILURE_DAYS))
    t = df.select("*", dist.alias("__dist"))
    key2 = sample_key(seed)
    counts = df.select(F.sum(F.when(y == 1, 1).otherwise(0)).alias("p"),
                       F.sum(F.when(y == 0, 1).otherwise(0)).alias("n"))
    n_pos = counts.select(F.coalesce("p", F.lit(0))).scalar()
    n_neg = counts.select(F.coalesce("n", F.lit(0))).scalar()
    target = F.least(n_neg, n_pos * F.lit(neg_per_pos))
    key = -F.ln(sample_uniform01(seed)) * (F.lit(1.0) + F.col("__dist"))
    last = _last_drawn(t.where(y == 0), [key, key2], target)
    drawn = (n_pos == 0) | (F.struct(key.alias("k0"), key2.alias("k1")) <= last)
    return t.where((y != 0) | ((y == 0) & drawn)).drop("__dist")


def median_impute(train: DataFrame, df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill NULLs of ``cols`` in ``df`` with the exact training median of each column.

    Medians come from one distributed exact-quantile job over the stacked (column, value)
    pairs, grouped by column; the result (one row per column) is pivoted to a single row and
    applied through a scalar subquery (one field per column, so that a cell looks nothing up).
    """
    if not cols:
        return df
    stacked = train.select(F.explode(F.array(*[
        F.struct(F.lit(c).alias("__c"), F.col(f"`{c}`").cast("double").alias("__x")) for c in cols
    ])).alias("__s")).select("__s.__c", "__s.__x")
    med = exact_quantiles(stacked, "__x", [0.5], ["__c"])
    m = med.select(F.struct(*[F.max(F.when(F.col("__c") == c, F.col("value"))).alias(f"m{i}") for i, c in enumerate(cols)])).scalar()
    fill = {c: F.coalesce(F.col(f"`{c}`"), m[f"m{i}"]).alias(c) for i, c in enumerate(cols)}
    return df.select(*[fill.get(c, F.col(f"`{c}`")) for c in df.columns])
