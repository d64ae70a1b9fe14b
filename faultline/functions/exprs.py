"""Shared column expressions.

They settle, once, how pandas/numpy semantics map onto ANSI Spark SQL:

* missing values are SQL NULL, never NaN;
* ``np_div`` reproduces numpy float division (x/0 = +-inf, 0/0 = missing) without tripping
  ANSI's DIVIDE_BY_ZERO;
* ``pearson`` is a pairwise-complete correlation that yields NULL (not an error) for
  constant inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def np_div(n, d) -> Column:
    """numpy division: d != 0 -> n/d; n>0,d=0 -> +inf; n<0,d=0 -> -inf; 0/0 or NULL -> NULL."""
    n, d = col(n), col(d)
    return (F.when(d != 0, F.try_divide(n, d))
            .when((d == 0) & (n > 0), F.lit(INF))
            .when((d == 0) & (n < 0), F.lit(-INF)))


def np_div_fill0(n, d) -> Column:
    """``(n / d).fillna(0)`` in pandas: NaN and missing become 0, infinities stay."""
    return F.coalesce(np_div(n, d), F.lit(0.0))


def finite_or_null(c) -> Column:
    """``replace([inf, -inf], nan)``."""
    c = col(c)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(INF)), c)


def flag(cond: Column) -> Column:
    """Boolean -> 0/1 int where a missing comparison counts as false (pandas astype(int))."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def pearson(a, b) -> Column:
    """Pairwise-complete Pearson correlation; NULL for constant or too-short inputs.

    Spark's ``corr`` raises DIVIDE_BY_ZERO under ANSI on a constant column, so the ratio is
    formed with ``try_divide`` over sample covariance and sample standard deviations of the
    rows where both sides are present.
    """
    a, b = col(a), col(b)
    a2 = F.when(b.isNotNull(), a)
    b2 = F.when(a.isNotNull(), b)
    r = F.try_divide(F.covar_samp(a2, b2), F.stddev_samp(a2) * F.stddev_samp(b2))
    # clamp float noise just outside [-1, 1]
    return F.when(r > 1.0, F.lit(1.0)).when(r < -1.0, F.lit(-1.0)).otherwise(r)


def weekday0(c) -> Column:
    """Day of week with Monday = 0 (pandas ``dayofweek``)."""
    return F.weekday(col(c))


def money_sum(c) -> Column:
    """Exact sum of a money column: terms cast to DECIMAL(38,6), so the total does not depend
    on partitioning or summation order (identical on every engine, retry and cluster size)."""
    return F.coalesce(F.sum(col(c).cast("decimal(38,6)")).cast("double"), F.lit(0.0))


def round_doubles(df, scale: int = 6):
    """Comparison form of a result: floats rounded (-0.0 normalised), dates/timestamps as
    ISO text, decimals as rounded doubles."""
    out = []
    for f in df.schema.fields:
        t = f.dataType.typeName()
        if t in ("date", "timestamp", "timestamp_ntz"):
            out.append(F.col(f"`{f.name}`").cast("string").alias(f.name))
        elif t in ("double", "float", "decimal"):
            # round(x * 10^s) / 10^s on the binary value: the same arithmetic on both engines,
            # so half-way ties in the 7th decimal resolve identically
            m = float(10 ** scale)
            x = F.col(f"`{f.name}`").cast("double")
            out.append((F.round(x * F.lit(m)) / F.lit(m) + F.lit(0.0)).alias(f.name))
        else:
            out.append(F.col(f"`{f.name}`"))
    return df.select(*out)
