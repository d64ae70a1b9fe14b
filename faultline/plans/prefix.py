"""Distributed ordered prefix sums and exact quantiles.

A running sum over a whole table (``sum(x) over (order by k)`` without PARTITION BY) makes
Spark move every row into one task.  Instead:

1. the reduced input (one row per distinct key) is shuffled by ranges of (group, key), and the
   partition that Spark's range partitioner chose is written with each row to the shared folder.
   The cuts stay inside the partitioner: no plan holds them, whatever the number of partitions,
   and a retried task reads the buckets that were written;
2. each (group, bucket) is totalled; running sums over these few rows give every bucket its
   offset and every group its total;
3. the offset is added to a running sum inside each (group, bucket).

The partitioner samples rows, so a group of a third of all rows gets a third of the buckets, however
its keys are distributed, and small groups share buckets.  Totals come with the offsets, so that
callers need no second pass and no join on the group alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from faultline.session import materialize

#: Rows up to which a table is broadcast; beyond, the same join is a shuffled one.
SMALL_ROWS = 100_000


def join_small(df: DataFrame, small: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join with a side whose rows are counted first, so that it is broadcast only if small."""
    return df.join(F.broadcast(small) if small.limit(SMALL_ROWS + 1).count() <= SMALL_ROWS else small, on, how)


def range_buckets(df: DataFrame, order_cols: list[str], n_buckets: int | None = None) -> DataFrame:
    """``df``, written and read back, with ``__bucket``: its range partition by ``order_cols``.  Without
    ``n_buckets`` there are as many as shuffle partitions, fewer where Spark merges small ones."""
    cols = [F.col(c) for c in order_cols]
    ranged = df.repartitionByRange(n_buckets, *cols) if n_buckets else df.repartitionByRange(*cols)
    return materialize(ranged.withColumn("__bucket", F.spark_partition_id()), "prefix")


def _ordered(df: DataFrame, order_cols: list[str], sum_cols: list[str], parts: list[str],
             n_buckets: int | None, attach=None) -> DataFrame:
    """``df`` with run_, off_ and tot_ of each ``sum_cols``: the running sum inside the row's
    bucket, the sum of the group's earlier buckets and of the whole group.  ``attach``: further
    columns of a bucket, worked out once per bucket from off_, tot_ and its own sum own_."""
    keys = [f"__b_{c}" for c in parts]
    tagged = range_buckets(df, [*parts, *order_cols], n_buckets)
    totals = tagged.groupBy(*[F.col(c).alias(k) for c, k in zip(parts, keys)], F.col("__bucket").alias("__b")) \
        .agg(*[F.sum(c).alias(f"own_{c}") for c in sum_cols])
    # one row per (group, bucket)
    before = Window.partitionBy(*keys).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    offsets = totals.select(*keys, "__b", *[f"own_{c}" for c in sum_cols],
                            *[F.coalesce(F.sum(f"own_{c}").over(before), F.lit(0)).alias(f"off_{c}") for c in sum_cols],
                            *[F.sum(f"own_{c}").over(whole).alias(f"tot_{c}") for c in sum_cols])
    if attach:
        offsets = offsets.select("*", *attach)
    w = Window.partitionBy(*parts, "__bucket").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    run = tagged.select("*", *[F.sum(c).over(w).alias(f"run_{c}") for c in sum_cols])
    on = F.col("__bucket") == F.col("__b")
    for c, k in zip(parts, keys):
        on = on & F.col(c).eqNullSafe(F.col(k))
    return run.join(offsets, on).drop(*keys, "__b", "__bucket", *[f"own_{c}" for c in sum_cols])


def prefix_sums(df: DataFrame, order_cols: list[str], sum_cols: list[str],
                partition_cols: list[str] | None = None, descending: bool = False,
                n_buckets: int | None = None, prefix: str = "cum_", total_prefix: str | None = None) -> DataFrame:
    """Add ``cum_<c>`` = inclusive running sum of each ``sum_cols`` in key order per group, and
    with ``total_prefix`` the group's total under that prefix.

    ``order_cols`` must be unique within a group (aggregate ties first) and non-null.
    ``descending`` runs the sum from the largest key down.
    """
    parts = list(partition_cols or [])
    if descending:
        neg = {c: f"__neg_{c}" for c in order_cols}
        tmp = df.select("*", *[(-F.col(c)).alias(n) for c, n in neg.items()])
        out = prefix_sums(tmp, list(neg.values()), sum_cols, parts, False, n_buckets, prefix, total_prefix)
        return out.drop(*neg.values())
    j = _ordered(df, order_cols, sum_cols, parts, n_buckets)
    return j.select(*[F.col(f"`{c}`") for c in df.columns],
                    *[(F.col(f"run_{c}") + F.col(f"off_{c}")).alias(f"{prefix}{c}") for c in sum_cols],
                    *[F.col(f"tot_{c}").alias(f"{total_prefix}{c}") for c in sum_cols if total_prefix])


def exact_quantiles(df: DataFrame, value_col: str, probs: list[float], group_cols: list[str] | None = None,
                    sums: dict[str, Column] | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles (numpy default / DuckDB ``quantile_cont``).

    One ordered pass: values are reduced to (value, count); a bucket knows which of the wanted
    ranks fall into it from the totals, and its rows look among those only.  Returns
    (group..., q_idx, q, value).  ``sums`` adds columns, by name the sum of an expression over the
    group's rows whose value is at least the quantile: these rows start at one of the two values that
    the quantile lies between, so the same pass knows them.
    """
    g = list(group_cols or [])
    names = {name: f"__s{i}" for i, name in enumerate(sums or {})}
    v = df.where(F.col(value_col).isNotNull()).groupBy(*g, F.col(value_col).alias("__v")) \
        .agg(F.count(F.lit(1)).alias("__n"), *[F.sum(e).alias(names[k]) for k, e in (sums or {}).items()])
    wanted = F.array(*[F.struct(F.lit(i).alias("q_idx"), F.lit(float(p)).alias("q")) for i, p in enumerate(probs)])
    placed = F.transform(wanted, lambda x: F.struct(
        x["q_idx"].alias("q_idx"), x["q"].alias("q"), (x["q"] * (F.col("tot___n") - 1)).alias("pos"),
        F.floor(x["q"] * (F.col("tot___n") - 1)).alias("lo"), F.ceil(x["q"] * (F.col("tot___n") - 1)).alias("hi")))

    def touches(x, first, end):
        return ((x["lo"] >= first) & (x["lo"] < end)) | ((x["hi"] >= first) & (x["hi"] < end))
    here = F.filter(placed, lambda x: touches(x, F.col("off___n"), F.col("off___n") + F.col("own___n")))
    j = _ordered(v, ["__v"], ["__n", *names.values()], g, None, attach=[here.alias("__here")])
    end = F.col("run___n") + F.col("off___n")
    # what a row's values and all greater ones sum to, and the greater ones alone
    left = [x for s in names.values() for x in (
        (F.col(f"tot_{s}") - F.col(f"run_{s}") - F.col(f"off_{s}") + F.col(s)).alias(f"__from{s}"),
        (F.col(f"tot_{s}") - F.col(f"run_{s}") - F.col(f"off_{s}")).alias(f"__above{s}"))]
    rows = j.select(*g, "__v", (end - F.col("__n")).alias("__first"), end.alias("__end"), "__here", *left) \
        .select("*", F.explode(F.filter("__here", lambda x: touches(x, F.col("__first"), F.col("__end")))).alias("x"))

    def at(bound, col="__v"):
        return F.max(F.when((F.col(f"x.{bound}") >= F.col("__first")) & (F.col(f"x.{bound}") < F.col("__end")), F.col(col)))
    found = rows.groupBy(*g, F.col("x.q_idx").alias("q_idx"), F.col("x.q").alias("q")).agg(
        at("lo").alias("__lo"), at("hi").alias("__hi"), F.first(F.col("x.pos") - F.col("x.lo")).alias("__part"),
        *[x for s in names.values() for x in (at("lo", f"__from{s}").alias(f"__lo{s}"), at("hi", f"__from{s}").alias(f"__hi{s}"),
                                              at("hi", f"__above{s}").alias(f"__end{s}"))])
    found = found.withColumn("value", F.col("__lo") + F.col("__part") * (F.col("__hi") - F.col("__lo")))
    return found.select(*g, "q_idx", "q", "value", *[
        F.when(F.col("value") <= F.col("__lo"), F.col(f"__lo{s}")).when(F.col("value") <= F.col("__hi"), F.col(f"__hi{s}"))
        .otherwise(F.col(f"__end{s}")).alias(k) for k, s in names.items()])
