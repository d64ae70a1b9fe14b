"""Offer KPI tables and aggregations.

Each report is one ``groupBy`` with every metric fused into the same aggregate (partial
aggregation runs map-side, so only one row per group and partition is shuffled).  pandas
``groupby`` drops NULL keys — every operator here filters them — except ``kpi_summary_2d``
which keeps them (``dropna=False`` in the source).  Sums over all-missing groups are 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.functions.exprs import money_sum, np_div, pearson
from faultline.operators.offers import CAT_PARTIAL, CAT_SOLD_OUT, CAT_UNSOLD, PERFORMANCE_CATEGORIES

KPI_INPUTS = ["SOLD_AMOUNT", "SOLD_QUANTITY", "INVOLVED_STOCK", "STOCK_SOLD", "STOCKOUT_FLAG",
              "OVERSELL_FLAG"]


def _zsum(c):
    return F.coalesce(F.sum(c), F.lit(0.0))


def _kpi_aggs():
    return [F.count(F.lit(1)).alias("n_ofertas"),
            money_sum("SOLD_AMOUNT").alias("GMV"),
            _zsum("SOLD_QUANTITY").alias("__units"),
            _zsum("INVOLVED_STOCK").alias("__inv"),
            _zsum("STOCK_SOLD").alias("__sold"),
            F.avg("STOCKOUT_FLAG").alias("stockout_rate"),
            F.avg("OVERSELL_FLAG").alias("pct_oversell")]


def _kpi_finish(g: DataFrame, keys: list[str]) -> DataFrame:
    return g.select(*keys, "n_ofertas", "GMV",
                    F.when(F.col("__units") > 0, F.col("GMV") / F.col("__units")).alias("PRICE_PER_UNIT"),
                    F.when(F.col("__inv") > 0, F.col("__sold") / F.col("__inv")).alias("SELL_THROUGH"),
                    "stockout_rate", "pct_oversell")


def kpi_summary(df: DataFrame, group_col: str, display: bool = False) -> DataFrame:
    """N, GMV, GMV/units, sell-through, stockout and oversell rates per group, GMV desc.

    ``display`` returns the rounded variant (money 2 dp, rates as % with 1 dp)."""
    miss = [c for c in [group_col, *KPI_INPUTS] if c not in df.columns]
    if miss:
        raise ValueError(f"missing columns for the KPI table: {miss}")
    g = df.where(F.col(group_col).isNotNull()).groupBy(group_col).agg(*_kpi_aggs())
    out = _kpi_finish(g, [group_col]).orderBy(F.col("GMV").desc(), F.col(group_col))
    return kpi_display(out, [group_col]) if display else out


def kpi_display(out: DataFrame, keys: list[str]) -> DataFrame:
    return out.select(*keys, "n_ofertas", F.round("GMV", 2).alias("GMV"),
                      F.round("PRICE_PER_UNIT", 2).alias("PRICE_PER_UNIT"),
                      F.round(F.col("SELL_THROUGH") * 100, 1).alias("sell_through_pct"),
                      F.round(F.col("stockout_rate") * 100, 1).alias("stockout_rate_pct"),
                      F.round(F.col("pct_oversell") * 100, 1).alias("pct_oversell_pct"))


def kpi_summary_2d(df: DataFrame, rows: str = "VERTICAL", cols: str = "DAYPART") -> DataFrame:
    """D6 (long form, primary): D5 metrics per (rows, cols) cell, NULL keys kept."""
    g = df.groupBy(rows, cols).agg(*_kpi_aggs())
    return _kpi_finish(g, [rows, cols])


def kpi_pivot(long: DataFrame, rows: str, cols: str, metric: str, values: list[str]) -> DataFrame:
    """D6 pivot of one metric: one row per ``rows`` value, one column per ``cols`` value.
    Values are passed explicitly so Spark plans one aggregation (no distinct-values job)."""
    return long.groupBy(rows).pivot(cols, values).agg(F.first(metric))


def performance_by_vertical(df: DataFrame, group_col: str = "VERTICAL") -> DataFrame:
    """Per group counts per performance category, Total, mean sales rate, % per category."""
    cat = F.col("PERFORMANCE_CATEGORY")
    aggs = [F.sum(F.when(cat == c, 1).otherwise(0)).alias(c) for c in PERFORMANCE_CATEGORIES]
    g = (df.where(F.col(group_col).isNotNull())
         .groupBy(group_col).agg(*aggs, F.count(F.lit(1)).alias("Total"),
                                 F.avg("SALES_RATE").alias("mean_sales_rate")))
    return g.select("*", *[F.round(F.col(c) / F.col("Total") * 100, 1).alias(f"pct_{c}")
                           for c in PERFORMANCE_CATEGORIES])


def best_worst_vertical(df: DataFrame, group_col: str = "VERTICAL") -> DataFrame:
    """Argmax / argmin of the mean sales rate (ties -> smallest key); one row."""
    per = performance_by_vertical(df, group_col)
    return per.agg(
        F.min_by(group_col, F.struct(-F.col("mean_sales_rate"), F.col(group_col))).alias("best"),
        F.max("mean_sales_rate").alias("best_rate"),
        F.min_by(group_col, F.struct(F.col("mean_sales_rate"), F.col(group_col))).alias("worst"),
        F.min("mean_sales_rate").alias("worst_rate"))


def top_groups(per: DataFrame, group_col: str, metric: str, k: int = 5) -> DataFrame:
    """H2 over a per-group table: top-k by ``metric`` desc, key as tie-break."""
    return per.orderBy(F.col(metric).desc(), F.col(group_col)).limit(k)


def performance_drilldown_counts(df: DataFrame, category: str, by: str) -> DataFrame:
    """Rows of one category counted per ``by`` value (vertical / domain / day / shipping)."""
    return (df.where(F.col("PERFORMANCE_CATEGORY") == category)
            .where(F.col(by).isNotNull())
            .groupBy(by).agg(F.count(F.lit(1)).alias("n")))


def vertical_rankings(df: DataFrame, k: int = 5, group_col: str = "VERTICAL") -> DataFrame:
    """The ``k`` groups with most sold-out offers, with the highest mean rate and with most offers, in
    one table (ranking, rank, group, value), with the shares of the performance categories of each.  Each
    list is a TakeOrdered over the per-group table; ties go to the smaller key."""
    per = performance_by_vertical(df, group_col)
    lists = [("sold_out", CAT_SOLD_OUT), ("mean_rate", "mean_sales_rate"), ("total", "Total")]
    out = None
    for name, metric in lists:
        top = top_groups(per, group_col, metric, k)
        order = Window.orderBy(F.col(metric).desc(), F.col(group_col))            # k rows
        top = top.select(F.lit(name).alias("ranking"), F.row_number().over(order).alias("rank"), group_col,
                         F.col(metric).cast("double").alias("value"), *[f"pct_{c}" for c in PERFORMANCE_CATEGORIES])
        out = top if out is None else out.unionByName(top)
    return out


def performance_drilldown_summary(df: DataFrame, category: str) -> DataFrame:
    """D9 header: count, % of all offers, mean sales rate, share with rate > 1 (one row)."""
    cat = F.col("PERFORMANCE_CATEGORY") == category
    return df.agg(F.sum(F.when(cat, 1).otherwise(0)).alias("n"),
                  F.count(F.lit(1)).alias("n_all"),
                  F.avg(F.when(cat, F.col("SALES_RATE"))).alias("mean_sales_rate"),
                  F.avg(F.when(cat, F.when(F.col("SALES_RATE") > 1, 1.0).otherwise(0.0))).alias("oversell_share")) \
        .select("n", (F.col("n") / F.col("n_all") * 100).alias("pct_of_all"), "mean_sales_rate",
                "oversell_share")


def performance_drilldown_by_vertical(df: DataFrame, category: str) -> DataFrame:
    """Per vertical count / mean rate / summed amount of one category, rounded."""
    return (df.where(F.col("PERFORMANCE_CATEGORY") == category)
            .where(F.col("VERTICAL").isNotNull())
            .groupBy("VERTICAL")
            .agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("SALES_RATE"), 2).alias("mean_sales_rate"),
                 F.round(money_sum("SOLD_AMOUNT"), 2).alias("sum_amount")))


def category_counts_by(df: DataFrame, keys: list[str]) -> DataFrame:
    """Counts per key(s) x performance category (long form) with per-key total and %."""
    k = df
    for c in keys:
        k = k.where(F.col(c).isNotNull())
    g = k.groupBy(*keys, "PERFORMANCE_CATEGORY").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*keys)
    return g.select("*", F.sum("n").over(w).alias("total"),
                    F.round(F.col("n") / F.sum("n").over(w) * 100, 1).alias("pct"))


def weekday_performance(df: DataFrame) -> DataFrame:
    """Weekday x category pivot (fixed category columns), total and % (1 dp)."""
    cat = F.col("PERFORMANCE_CATEGORY")
    g = (df.where(F.col("WEEKDAY").isNotNull()).groupBy("WEEKDAY")
         .agg(*[F.sum(F.when(cat == c, 1).otherwise(0)).alias(c) for c in PERFORMANCE_CATEGORIES],
              F.count(F.lit(1)).alias("total")))
    return g.select("*", *[F.round(F.col(c) / F.col("total") * 100, 1).alias(f"pct_{c}")
                           for c in PERFORMANCE_CATEGORIES])


def vertical_category_stats(df: DataFrame) -> DataFrame:
    """Count, mean rate, revenue, mean duration per (vertical, category)."""
    return (df.where(F.col("VERTICAL").isNotNull() & F.col("PERFORMANCE_CATEGORY").isNotNull())
            .groupBy("VERTICAL", "PERFORMANCE_CATEGORY")
            .agg(F.count(F.lit(1)).alias("n"), F.avg("SALES_RATE").alias("mean_sales_rate"),
                 money_sum("SOLD_AMOUNT").alias("revenue"),
                 F.avg("DURATION_HOURS").alias("mean_duration")))


def period_col(grain: str, ts: str = "OFFER_START_DTTM"):
    t = F.col(ts)
    if grain == "day":
        return t.cast("date")
    if grain == "week":  # ISO week number, year ignored (as in the source)
        return F.weekofyear(t)
    if grain == "month":
        return F.month(t)
    raise ValueError(grain)


def evolution(df: DataFrame, grain: str = "day") -> DataFrame:
    """Category counts per period, zero-filled (fixed category columns)."""
    cat = F.col("PERFORMANCE_CATEGORY")
    p = period_col(grain).alias("period")
    return (df.where(F.col("OFFER_START_DTTM").isNotNull()).groupBy(p)
            .agg(*[F.sum(F.when(cat == c, 1).otherwise(0)).alias(c) for c in PERFORMANCE_CATEGORIES]))


def rate_by_weekday(df: DataFrame) -> DataFrame:
    """Mean and sample std of the sales rate per weekday."""
    return (df.where(F.col("WEEKDAY").isNotNull()).groupBy("WEEKDAY")
            .agg(F.avg("SALES_RATE").alias("mean_sales_rate"),
                 F.stddev_samp("SALES_RATE").alias("std_sales_rate")))


def revenue_by(df: DataFrame) -> DataFrame:
    """Revenue by (vertical, category), by vertical and in total in one ``rollup``; and by
    category via the ``level`` column of a second grouping set (``cube`` restricted)."""
    d = df.where(F.col("VERTICAL").isNotNull() & F.col("PERFORMANCE_CATEGORY").isNotNull())
    return (d.cube("VERTICAL", "PERFORMANCE_CATEGORY")
            .agg(money_sum("SOLD_AMOUNT").alias("revenue"),
                 F.grouping_id().alias("level")))


def daily_rate(df: DataFrame, by_vertical: bool = False) -> DataFrame:
    """Mean sales rate per day (and per vertical when ``by_vertical``)."""
    keys = [F.col("OFFER_START_DTTM").cast("date").alias("day")]
    d = df.where(F.col("OFFER_START_DTTM").isNotNull())
    if by_vertical:
        d = d.where(F.col("VERTICAL").isNotNull())
        keys.append(F.col("VERTICAL"))
    return d.groupBy(*keys).agg(F.avg("SALES_RATE").alias("mean_sales_rate"))


def daily_rate_grid(df: DataFrame) -> DataFrame:
    """D16, the chart by vertical: every day with every vertical, 0 where a vertical had no offer that
    day (or no rate).  The spine is the table's days, each exploded over the one array of verticals."""
    cells = daily_rate(df, by_vertical=True)
    verticals = cells.select(F.array_sort(F.collect_set("VERTICAL"))).scalar()    # one name a vertical
    grid = cells.select("day").distinct().select("day", F.explode(verticals).alias("VERTICAL"))
    return grid.join(cells, ["day", "VERTICAL"], "left").select("day", "VERTICAL", F.coalesce("mean_sales_rate", F.lit(0.0)).alias("mean_sales_rate"))


def trend_first_last(df: DataFrame) -> DataFrame:
    """Mean rate on the first vs last day, verdict, number of days / ISO weeks, period."""
    day = F.col("OFFER_START_DTTM").cast("date")
    d = df.where(F.col("OFFER_START_DTTM").isNotNull()).select(day.alias("day"), "SALES_RATE",
                                                                 F.weekofyear("OFFER_START_DTTM").alias("wk"))
    lo = d.select(F.min("day")).scalar()
    hi = d.select(F.max("day")).scalar()
    r = d.agg(F.avg(F.when(F.col("day") == lo, F.col("SALES_RATE"))).alias("first_day_rate"),
              F.avg(F.when(F.col("day") == hi, F.col("SALES_RATE"))).alias("last_day_rate"),
              F.countDistinct("day").alias("n_days"), F.countDistinct("wk").alias("n_weeks"),
              F.min("day").alias("first_day"), F.max("day").alias("last_day"))
    return r.select("*", F.when(F.col("last_day_rate") > F.col("first_day_rate"), F.lit("improved"))
                    .otherwise(F.lit("worsened")).alias("trend"))


def seasonality(df: DataFrame) -> DataFrame:
    """Per month mean sales rate and number of sold-out offers."""
    return (df.where(F.col("OFFER_START_DTTM").isNotNull())
            .groupBy(F.month("OFFER_START_DTTM").alias("month"))
            .agg(F.avg("SALES_RATE").alias("mean_sales_rate"),
                 F.sum(F.when(F.col("PERFORMANCE_CATEGORY") == CAT_SOLD_OUT, 1).otherwise(0)).alias("n_sold_out")))


def temporal_insights(df: DataFrame) -> DataFrame:
    """Weekday with max % sold out, weekday with max % unsold, vertical with the highest
    mean rate, first/last day and number of days (one row; ties -> smallest key)."""
    wd = weekday_performance(df)
    vert = performance_by_vertical(df)
    best_so = wd.select(F.min_by("WEEKDAY", F.struct(-F.col(f"pct_{CAT_SOLD_OUT}"), F.col("WEEKDAY")))).scalar()
    best_un = wd.select(F.min_by("WEEKDAY", F.struct(-F.col(f"pct_{CAT_UNSOLD}"), F.col("WEEKDAY")))).scalar()
    best_v = vert.select(F.min_by("VERTICAL", F.struct(-F.col("mean_sales_rate"), F.col("VERTICAL")))).scalar()
    day = F.col("OFFER_START_DTTM").cast("date")
    return df.where(F.col("OFFER_START_DTTM").isNotNull()).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"),
        F.countDistinct(day).alias("n_days")).select(
        best_so.alias("weekday_max_sold_out"), best_un.alias("weekday_max_unsold"),
        best_v.alias("vertical_max_rate"), "first_day", "last_day", "n_days")


def top_combinations(df: DataFrame, k: int = 3) -> DataFrame:
    """Most frequent (vertical, weekday) pairs, count desc then keys."""
    return (df.where(F.col("VERTICAL").isNotNull() & F.col("WEEKDAY").isNotNull())
            .groupBy("VERTICAL", "WEEKDAY").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.col("n").desc(), "VERTICAL", "WEEKDAY").limit(k))


def offer_quality(df: DataFrame) -> DataFrame:
    """D21 summary: mismatch count/%/mean magnitude, ORIGIN missing count/% (one row)."""
    mm = F.col("SOLD_UNITS_MISMATCH")
    return df.agg(F.count(F.lit(1)).alias("n"),
                  F.sum(F.when(mm > 0, 1).otherwise(0)).alias("n_mismatch"),
                  F.avg(F.when(mm > 0, mm)).alias("mean_mismatch"),
                  F.sum(F.when(F.col("ORIGIN").isNull(), 1).otherwise(0)).alias("n_origin_missing")) \
        .select("n", "n_mismatch", (F.col("n_mismatch") / F.col("n") * 100).alias("pct_mismatch"),
                "mean_mismatch", "n_origin_missing",
                (F.col("n_origin_missing") / F.col("n") * 100).alias("pct_origin_missing"))


def oversell_by_vertical(df: DataFrame) -> DataFrame:
    """D21 per vertical: oversold offers, oversold units, % oversold."""
    return (df.where(F.col("VERTICAL").isNotNull()).groupBy("VERTICAL")
            .agg(F.sum("OVERSELL_FLAG").alias("n_oversell"),
                 F.coalesce(F.sum("OVERSELL_UNITS"), F.lit(0.0)).alias("oversell_units"),
                 (F.avg("OVERSELL_FLAG") * 100).alias("pct_oversell")))


def duration_revenue(df: DataFrame) -> DataFrame:
    """Mean / exact median duration, total / mean revenue, corr(duration, revenue) with
    a +-0.3 verdict; argmax verticals by revenue, mean duration and revenue per hour."""
    from faultline.plans.prefix import exact_quantiles
    med = exact_quantiles(df, "DURATION_HOURS", [0.5]).select("value").scalar()
    per = (df.where(F.col("VERTICAL").isNotNull()).groupBy("VERTICAL")
           .agg(money_sum("SOLD_AMOUNT").alias("rev"),
                F.avg("DURATION_HOURS").alias("dur"),
                F.avg(np_div(F.col("SOLD_AMOUNT"), F.col("DURATION_HOURS"))).alias("rph")))
    top_rev = per.select(F.min_by("VERTICAL", F.struct(-F.col("rev"), F.col("VERTICAL")))).scalar()
    top_dur = per.select(F.min_by("VERTICAL", F.struct(-F.col("dur"), F.col("VERTICAL")))).scalar()
    top_rph = per.select(F.min_by("VERTICAL", F.struct(-F.col("rph"), F.col("VERTICAL")))).scalar()
    r = pearson("DURATION_HOURS", "SOLD_AMOUNT")
    return df.agg(F.avg("DURATION_HOURS").alias("mean_duration"),
                  money_sum("SOLD_AMOUNT").alias("total_revenue"),
                  F.avg("SOLD_AMOUNT").alias("mean_revenue"), r.alias("corr_duration_revenue")) \
        .select(med.alias("median_duration"), "*",
                F.when(F.col("corr_duration_revenue") > 0.3, F.lit("positive"))
                .when(F.col("corr_duration_revenue") < -0.3, F.lit("negative"))
                .otherwise(F.lit("weak")).alias("verdict"),
                top_rev.alias("top_vertical_revenue"), top_dur.alias("top_vertical_duration"),
                top_rph.alias("top_vertical_revenue_per_hour"))


def mean_duration_by_vertical(df: DataFrame) -> DataFrame:
    """Mean duration per vertical."""
    return (df.where(F.col("VERTICAL").isNotNull()).groupBy("VERTICAL")
            .agg(F.avg("DURATION_HOURS").alias("mean_duration")))


def _value_runs(df: DataFrame, level: str, value_col: str) -> DataFrame:
    """(group, value, count) with cumulative count/sum from the largest value down.

    Offers are first reduced to distinct values per group, then ranked by the bucketed prefix
    sum, so a group holding a third of all offers is still spread over many tasks."""
    from faultline.plans.prefix import prefix_sums
    v = F.coalesce(F.col(value_col), F.lit(0.0))
    runs = (df.where(F.col(level).isNotNull())
            .groupBy(level, v.alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
            .select(level, "__v", "__c",
                    (F.col("__v").cast("decimal(38,6)") * F.col("__c")).cast("decimal(38,6)").alias("__s")))
    return prefix_sums(runs, ["__v"], ["__c", "__s"], [level], descending=True, total_prefix="all_")


def pareto_concentration(df: DataFrame, level: str = "VERTICAL", top_frac: float = 0.1,
                         value_col: str = "SOLD_AMOUNT") -> DataFrame:
    """Per group n_ofertas, n_top = max(1, ceil(frac*n)), gmv_share_top = GMV of the top
    n_top offers / max(GMV, 1), gmv_total, concentration class (>=.8 ALTA, >=.6 MÉDIA, BAIXA).

    Exact and skew-safe: the top-k sum is taken over value runs — every run fully inside the
    top k counts whole, the run crossing rank k counts (k - rank before it) times its value.
    """
    runs = _value_runs(df, level, value_col)
    k = F.greatest(F.lit(1), F.ceil(F.col("all___c") * F.lit(top_frac))).cast("long")
    before = F.col("cum___c") - F.col("__c")
    part = F.when(before < k, (F.least(F.col("__c"), k - before) * F.col("__v").cast("decimal(38,6)")).cast("decimal(38,6)"))
    out = runs.groupBy(level).agg(
        F.first("all___c").alias("n_ofertas"), F.first(k).alias("n_top"),
        F.first("all___s").cast("double").alias("gmv_total"), F.sum(part).cast("double").alias("__top")).select(
        level, "n_ofertas", "n_top",
        (F.coalesce(F.col("__top"), F.lit(0.0)) / F.greatest(F.col("gmv_total"), F.lit(1.0))).alias("gmv_share_top"),
        "gmv_total")
    return out.select("*", F.when(F.col("gmv_share_top") >= 0.8, F.lit("ALTA"))
                      .when(F.col("gmv_share_top") >= 0.6, F.lit("MÉDIA")).otherwise(F.lit("BAIXA"))
                      .alias("concentration"))


def pareto_curve(df: DataFrame, level: str = "VERTICAL", value_col: str = "SOLD_AMOUNT") -> DataFrame:
    """Cumulative % of offers vs cumulative % of revenue, offers sorted by value desc.

    The curve is piecewise linear and straight inside a run of equal values, so it is emitted
    exactly at run ends (one row per distinct value per group) instead of one row per offer."""
    runs = _value_runs(df, level, value_col)
    return runs.select(
        level, F.col("cum___c").alias("n_offers"),
        (F.col("cum___c") / F.col("all___c")).alias("offer_pct"),
        F.when(F.col("all___s") != 0, F.col("cum___s").cast("double") / F.col("all___s").cast("double"))
        .alias("revenue_pct"))


def shipping_comparison(df: DataFrame, ship_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """D26 (long form): per (vertical, duration bucket, shipping type) n, mean sell-through,
    mean value per stock unit, stockout rate and GMV."""
    keys = ["VERTICAL", "DURATION_BUCKET", ship_col]
    d = df
    for c in keys:
        d = d.where(F.col(c).isNotNull())
    return d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"),
                                F.avg("SELL_THROUGH").alias("sell_through"),
                                F.avg("VALUE_PER_STOCK_UNIT").alias("value_per_stock"),
                                F.avg("STOCKOUT_FLAG").alias("stockout_rate"),
                                money_sum("SOLD_AMOUNT").alias("gmv"))


def shipping_diff_ranking(df: DataFrame, a: str = "FREE", b: str = "PAID", k: int = 10,
                          metric: str = "sell_through",
                          ship_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """D27 + C7: strata present for both shipping types (inner match after a conditional
    pivot), differences a - b of three metrics, top-k by the chosen difference."""
    long = shipping_comparison(df, ship_col)
    keys = ["VERTICAL", "DURATION_BUCKET"]
    ms = ["sell_through", "value_per_stock", "stockout_rate"]
    sh = F.col(ship_col)
    w = long.groupBy(*keys).agg(*[F.max(F.when(sh == t, F.col(m))).alias(f"{m}_{t}")
                                  for m in ms for t in (a, b)],
                                F.max(F.when(sh == a, 1)).alias("__ha"),
                                F.max(F.when(sh == b, 1)).alias("__hb"))
    both = w.where(F.col("__ha").isNotNull() & F.col("__hb").isNotNull()).drop("__ha", "__hb")
    diffs = both.select("*", *[(F.col(f"{m}_{a}") - F.col(f"{m}_{b}")).alias(f"diff_{m}") for m in ms])
    return diffs.orderBy(F.col(f"diff_{metric}").desc_nulls_last(), *keys).limit(k)


def shipping_verdict(df: DataFrame, a: str = "FREE", b: str = "PAID",
                     ship_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """D27 tail: mean sell-through per type over common strata and the verdict."""
    long = shipping_comparison(df, ship_col)
    keys = ["VERTICAL", "DURATION_BUCKET"]
    sh = F.col(ship_col)
    w = long.groupBy(*keys).agg(F.max(F.when(sh == a, F.col("sell_through"))).alias("__a"),
                                F.max(F.when(sh == a, 1)).alias("__ha"),
                                F.max(F.when(sh == b, F.col("sell_through"))).alias("__b"),
                                F.max(F.when(sh == b, 1)).alias("__hb"))
    both = w.where(F.col("__ha").isNotNull() & F.col("__hb").isNotNull())
    return both.agg(F.avg("__a").alias(f"mean_{a}"), F.avg("__b").alias(f"mean_{b}"),
                    F.count(F.lit(1)).alias("n_strata")).select(
        "*", F.when(F.col(f"mean_{a}") > F.col(f"mean_{b}"), F.lit(a)).otherwise(F.lit(b)).alias("better"))


def stratum_score(df: DataFrame, ship_type: str = "FREE",
                  ship_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """score = 0.7*sell-through + 0.3*min-max(GMV/stock) for one shipping type over all
    strata; a stratum without offers of that type counts 0; when GMV/stock is constant the score is
    the sell-through.  Min/max are scalar subqueries over the (small) strata table."""
    own = F.col(ship_col) == ship_type
    long = shipping_comparison(df, ship_col).groupBy("VERTICAL", "DURATION_BUCKET").agg(
        F.max(F.when(own, F.col("sell_through"))).alias("sell_through"),
        F.max(F.when(own, F.col("value_per_stock"))).alias("value_per_stock"))
    v = F.coalesce(F.col("value_per_stock"), F.lit(0.0))
    st = F.coalesce(F.col("sell_through"), F.lit(0.0))
    lo = long.select(F.min(v)).scalar()
    hi = long.select(F.max(v)).scalar()
    norm = F.when(hi > lo, (v - lo) / (hi - lo))
    score = F.when(hi > lo, 0.7 * st + 0.3 * norm).otherwise(st)
    return long.select("VERTICAL", "DURATION_BUCKET", st.alias("sell_through"),
                       v.alias("value_per_stock"), score.alias("score"))


def stratum_extremes(df: DataFrame, k: int = 5, ship_type: str = "FREE",
                     ship_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """The ``k`` strata of highest and of lowest score (side, rank, stratum, score)."""
    scores = stratum_score(df, ship_type, ship_col)
    keys, out = ["VERTICAL", "DURATION_BUCKET"], None
    for side, first in (("top", F.col("score").desc()), ("bottom", F.col("score").asc())):
        some = scores.orderBy(first, *keys).limit(k)
        some = some.select(F.lit(side).alias("side"), F.row_number().over(Window.orderBy(first, *keys)).alias("rank"), *keys, "score")  # k rows
        out = some if out is None else out.unionByName(some)
    return out


def kaplan_meier(df: DataFrame, time_col: str = "DURATION_HOURS", event_col: str = "STOCKOUT_FLAG",
                 group_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """Kaplan-Meier S(t) = prod_{t_i <= t} (1 - d_i / n_i) per group at distinct times.

    at-risk n_i = offers with time >= t_i: the group's total less those before; the product is a prefix sum of
    logs of non-zero factors plus a running count of zero factors (a zero factor pins S to 0
    from then on).  Both prefix sums are range-bucketed, so no group is forced into one task.
    """
    from faultline.plans.prefix import prefix_sums
    ev = F.coalesce((F.col(event_col) == 1).cast("int"), F.lit(0))
    tbl = (df.where(F.col(time_col).isNotNull() & F.col(group_col).isNotNull())
           .groupBy(group_col, F.col(time_col).alias("time"))
           .agg(F.sum(ev).alias("events"), F.count(F.lit(1)).alias("total")))
    seen = prefix_sums(tbl, ["time"], ["total"], [group_col], total_prefix="all_")
    risk = seen.withColumn("risk_total", F.col("all_total") - F.col("cum_total") + F.col("total")).drop("cum_total", "all_total")
    fac = 1.0 - F.col("events") / F.col("risk_total")
    f = risk.select("*", F.when(fac > 0, F.ln(fac)).otherwise(F.lit(0.0)).alias("__lf"),
                    F.when(fac <= 0, 1).otherwise(0).alias("__zero"))
    cum = prefix_sums(f, ["time"], ["__lf", "__zero"], [group_col])
    return cum.select(group_col, "time", "events", "total", F.col("risk_total").alias("at_risk"),
                      F.when(F.col("cum___zero") > 0, F.lit(0.0)).otherwise(F.exp("cum___lf"))
                      .alias("survival"))


def kaplan_meier_summary(df: DataFrame, time_col: str = "DURATION_HOURS",
                         event_col: str = "STOCKOUT_FLAG",
                         group_col: str = "SHIPPING_PAYMENT_TYPE") -> DataFrame:
    """D29 header per group: n, events, event rate and final survival."""
    curve = kaplan_meier(df, time_col, event_col, group_col)
    return curve.groupBy(group_col).agg(
        F.sum("total").alias("n"), F.sum("events").alias("n_events"),
        (F.sum("events") / F.sum("total")).alias("event_rate"),
        F.min_by("survival", F.struct(-F.col("time"))).alias("final_survival"))
