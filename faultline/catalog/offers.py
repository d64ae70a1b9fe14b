"""Offer queries (B, D, H2): Spark operator + DuckDB oracle over the ``offers_f`` view."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.operators import kpis, offers as ob
from faultline.oracle import sql_corr, sql_div
from faultline.registry import query
from faultline.sources.fixtures import OFFER_KEY, offers

CATS = ob.PERFORMANCE_CATEGORIES


def _of(spark, sf):
    return ob.offer_features(offers(spark, sf))


def _cat_sums(prefix=""):
    return ", ".join(f"sum(CASE WHEN PERFORMANCE_CATEGORY = '{c}' THEN 1 ELSE 0 END) AS \"{c}\""
                     for c in CATS)


def _cat_pcts(total="total"):
    return ", ".join(f"round(CAST(\"{c}\" AS DOUBLE) / {total} * 100, 1) AS \"pct_{c}\"" for c in CATS)


# ------------------------------------------------------------------ B: features
@query("b01_offer_features", "SELECT * EXCLUDE (__dummy) FROM (SELECT *, 0 AS __dummy FROM offers_f)")
def b01(spark, sf):
    return _of(spark, sf)


@query("b16_calendar_columns", f"""
SELECT {', '.join(OFFER_KEY)}, CAST(OFFER_START_DTTM AS DATE) AS DIA, dayname(OFFER_START_DTTM) AS DIA_SEMANA,
       weekofyear(OFFER_START_DTTM) AS SEMANA, month(OFFER_START_DTTM) AS MES, day(OFFER_START_DTTM) AS DIA_MES
FROM offers_f""")
def b16(spark, sf):
    return ob.calendar_columns(_of(spark, sf)).select(*OFFER_KEY, "DIA", "DIA_SEMANA", "SEMANA", "MES", "DIA_MES")


@query("b17_revenue_per_hour", f"""
SELECT {', '.join(OFFER_KEY)}, {sql_div('SOLD_AMOUNT', 'DURATION_HOURS')} AS EFICIENCIA_RECEITA FROM offers_f""")
def b17(spark, sf):
    return ob.revenue_per_hour(_of(spark, sf)).select(*OFFER_KEY, "EFICIENCIA_RECEITA")


@query("b18_filter_sold_out", f"""
SELECT {', '.join(OFFER_KEY)}, SALES_RATE, VERTICAL FROM offers_f WHERE PERFORMANCE_CATEGORY = 'Esgotada'""")
def b18(spark, sf):
    return ob.filter_performance(_of(spark, sf), ob.CAT_SOLD_OUT).select(*OFFER_KEY, "SALES_RATE", "VERTICAL")


@query("b20_one_hot_daypart", f"""
SELECT {', '.join(OFFER_KEY)}, SALES_RATE,
  {', '.join(f"CASE WHEN DAYPART = '{d}' THEN 1 ELSE 0 END AS DAYPART_{d}" for d in ob.DAYPARTS)}
FROM offers_f""")
def b20(spark, sf):
    d = ob.one_hot(_of(spark, sf), "DAYPART", ob.DAYPARTS)
    return d.select(*OFFER_KEY, "SALES_RATE", *[f"DAYPART_{x}" for x in ob.DAYPARTS])


@query("b21_log1p_amount", f"""
SELECT {', '.join(OFFER_KEY)}, ln(1 + SOLD_AMOUNT) AS SOLD_AMOUNT_log1p FROM offers_f WHERE SOLD_AMOUNT >= 0""")
def b21(spark, sf):
    return ob.log_transform(_of(spark, sf), "SOLD_AMOUNT", "log1p").select(*OFFER_KEY, "SOLD_AMOUNT_log1p")


@query("b21_sqrt_amount", f"""
SELECT {', '.join(OFFER_KEY)}, sqrt(SOLD_AMOUNT) AS SOLD_AMOUNT_sqrt FROM offers_f WHERE SOLD_AMOUNT >= 0""")
def b21_sqrt(spark, sf):
    return ob.log_transform(_of(spark, sf), "SOLD_AMOUNT", "sqrt").select(*OFFER_KEY, "SOLD_AMOUNT_sqrt")


@query("b21_log_rate", f"""
SELECT {', '.join(OFFER_KEY)}, ln(SALES_RATE) AS SALES_RATE_log FROM offers_f WHERE SALES_RATE > 0""")
def b21_log(spark, sf):
    return ob.log_transform(_of(spark, sf), "SALES_RATE", "log").select(*OFFER_KEY, "SALES_RATE_log")


# offers that come with the inconsistent metric of the source lose it among the features
@query("b14_drop_inconsistent_metric", f"SELECT {', '.join(OFFER_KEY)}, SALES_RATE, SELL_THROUGH FROM offers_f")
def b14(spark, sf):
    out = ob.offer_features(offers(spark, sf).withColumn("VALUE_CONVERSION_RATE", F.col("SOLD_AMOUNT") / 2))
    kept = [c for c in ("VALUE_CONVERSION_RATE",) if c in out.columns]
    return out.select(*OFFER_KEY, "SALES_RATE", "SELL_THROUGH", *kept)


# the catalog's groups, with how many of their columns the feature table holds and how many values
@query("b15_column_catalog", "\nUNION ALL ".join(
    f"SELECT '{g}' AS group_name, {len(cols)} AS n_columns, {' + '.join(f'count({c})' for c in cols) or '0'} AS n_values FROM offers_f"
    for g, cols in ob.column_catalog().items()))
def b15(spark, sf):
    cells = F.array(*[F.struct(F.lit(g).alias("group_name"), F.lit(len(cols)).alias("n_columns"),
                               sum((F.count(c) for c in cols), F.lit(0).cast("long")).alias("n_values")) for g, cols in ob.column_catalog().items()])
    return _of(spark, sf).agg(cells.alias("c")).select(F.inline("c"))


# ------------------------------------------------------------------ D5 / D6 KPI tables
def _kpi_sql(keys, where="", display=False):
    k = ", ".join(keys)
    body = f"""
SELECT {k}, count(*) AS n_ofertas, coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS GMV,
  CASE WHEN coalesce(sum(SOLD_QUANTITY), 0.0) > 0 THEN coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) / sum(SOLD_QUANTITY) END AS PRICE_PER_UNIT,
  CASE WHEN coalesce(sum(INVOLVED_STOCK), 0.0) > 0 THEN coalesce(sum(STOCK_SOLD), 0.0) / sum(INVOLVED_STOCK) END AS SELL_THROUGH,
  avg(STOCKOUT_FLAG) AS stockout_rate, avg(OVERSELL_FLAG) AS pct_oversell
FROM offers_f {where} GROUP BY {k}"""
    if not display:
        return body
    return f"""SELECT {k}, n_ofertas, round(GMV, 2) AS GMV, round(PRICE_PER_UNIT, 2) AS PRICE_PER_UNIT,
  round(SELL_THROUGH * 100, 1) AS sell_through_pct, round(stockout_rate * 100, 1) AS stockout_rate_pct,
  round(pct_oversell * 100, 1) AS pct_oversell_pct FROM ({body})"""


@query("d05_kpi_summary_vertical", _kpi_sql(["VERTICAL"], "WHERE VERTICAL IS NOT NULL"))
def d05a(spark, sf):
    return kpis.kpi_summary(_of(spark, sf), "VERTICAL")


@query("d05_kpi_summary_daypart", _kpi_sql(["DAYPART"], "WHERE DAYPART IS NOT NULL"))
def d05b(spark, sf):
    return kpis.kpi_summary(_of(spark, sf), "DAYPART")


@query("d05_kpi_display_vertical", _kpi_sql(["VERTICAL"], "WHERE VERTICAL IS NOT NULL", display=True))
def d05c(spark, sf):
    return kpis.kpi_summary(_of(spark, sf), "VERTICAL", display=True)


@query("d06_kpi_summary_2d", _kpi_sql(["VERTICAL", "ORIGIN"]))
def d06a(spark, sf):
    # ORIGIN is ~95 % NULL: the NULL cell is kept, as in the source (dropna=False)
    return kpis.kpi_summary_2d(_of(spark, sf), "VERTICAL", "ORIGIN")


@query("d06_kpi_pivot_sell_through", f"""
SELECT VERTICAL, {', '.join(f"round(max(CASE WHEN DAYPART = '{d}' THEN SELL_THROUGH END) * 100, 1) AS {d}" for d in ob.DAYPARTS)}
FROM ({_kpi_sql(["VERTICAL", "DAYPART"])}) GROUP BY VERTICAL""")
def d06b(spark, sf):
    long = kpis.kpi_summary_2d(_of(spark, sf), "VERTICAL", "DAYPART") \
        .select("VERTICAL", "DAYPART", F.round(F.col("SELL_THROUGH") * 100, 1).alias("v"))
    return kpis.kpi_pivot(long, "VERTICAL", "DAYPART", "v", list(ob.DAYPARTS))


# the other pivots of the report: a metric by vertical over the values of a second column
_PIVOTS = {"gmv_daypart": ("GMV", "DAYPART", tuple(ob.DAYPARTS), 1, 2), "stockout_duration": ("stockout_rate", "DURATION_BUCKET", (ob.BUCKET_SHORT, ob.BUCKET_MEDIUM, ob.BUCKET_LONG), 100, 1),
           "sell_through_duration": ("SELL_THROUGH", "DURATION_BUCKET", (ob.BUCKET_SHORT, ob.BUCKET_MEDIUM, ob.BUCKET_LONG), 100, 1),
           "offers_shipping": ("n_ofertas", "SHIPPING_PAYMENT_TYPE", ("FREE", "PAID"), 1, 0), "oversell_shipping": ("pct_oversell", "SHIPPING_PAYMENT_TYPE", ("FREE", "PAID"), 100, 1)}
for _name, (_metric, _by, _values, _times, _digits) in _PIVOTS.items():
    def _pivot(spark, sf, m=_metric, by=_by, values=_values, times=_times, digits=_digits):
        long = kpis.kpi_summary_2d(_of(spark, sf), "VERTICAL", by).select("VERTICAL", by, F.round(F.col(m).cast("double") * times, digits).alias("v"))
        return kpis.kpi_pivot(long, "VERTICAL", by, "v", list(values))
    query(f"d06_kpi_pivot_{_name}", "SELECT VERTICAL, " + ", ".join(f"""round(max(CASE WHEN {_by} = '{v}' THEN {_metric} END)::DOUBLE * {_times}, {_digits}) AS "{v}\"""" for v in _values)
          + f" FROM ({_kpi_sql(['VERTICAL', _by])}) GROUP BY VERTICAL")(_pivot)


# ------------------------------------------------------------------ D7-D9
_PBV = f"""SELECT VERTICAL, {_cat_sums()}, count(*) AS Total, avg(SALES_RATE) AS mean_sales_rate
FROM offers_f WHERE VERTICAL IS NOT NULL GROUP BY VERTICAL"""


@query("d07_performance_by_vertical", f"SELECT *, {_cat_pcts('Total')} FROM ({_PBV})")
def d07(spark, sf):
    return kpis.performance_by_vertical(_of(spark, sf))


@query("d08_best_worst_vertical", f"""
SELECT (SELECT VERTICAL FROM ({_PBV}) ORDER BY mean_sales_rate DESC, VERTICAL LIMIT 1) AS best,
       (SELECT max(mean_sales_rate) FROM ({_PBV})) AS best_rate,
       (SELECT VERTICAL FROM ({_PBV}) ORDER BY mean_sales_rate, VERTICAL LIMIT 1) AS worst,
       (SELECT min(mean_sales_rate) FROM ({_PBV})) AS worst_rate""")
def d08(spark, sf):
    return kpis.best_worst_vertical(_of(spark, sf))


@query("d08_top5_vertical_sold_out", f"""
SELECT * FROM ({_PBV}) ORDER BY "Esgotada" DESC, VERTICAL LIMIT 5""")
def d08b(spark, sf):
    per = kpis.performance_by_vertical(_of(spark, sf)).drop(*[f"pct_{c}" for c in CATS])
    return kpis.top_groups(per, "VERTICAL", ob.CAT_SOLD_OUT, 5)


_RANKINGS = [("sold_out", '"Esgotada"'), ("mean_rate", "mean_sales_rate"), ("total", '"Total"')]


@query("d08_vertical_rankings", f"WITH v AS (SELECT *, {_cat_pcts('Total')} FROM ({_PBV}))\n" + "\nUNION ALL ".join(
    f"SELECT '{name}' AS ranking, row_number() OVER (ORDER BY {m} DESC, VERTICAL) AS rank, VERTICAL, CAST({m} AS DOUBLE) AS value, "
    f"""{', '.join(f'"pct_{c}"' for c in CATS)} FROM v QUALIFY rank <= 5""" for name, m in _RANKINGS))
def d08c(spark, sf):
    return kpis.vertical_rankings(_of(spark, sf))


@query("d09_drilldown_summary_sold_out", """
SELECT sum(CASE WHEN PERFORMANCE_CATEGORY = 'Esgotada' THEN 1 ELSE 0 END) AS n,
       CAST(sum(CASE WHEN PERFORMANCE_CATEGORY = 'Esgotada' THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS pct_of_all,
       avg(CASE WHEN PERFORMANCE_CATEGORY = 'Esgotada' THEN SALES_RATE END) AS mean_sales_rate,
       avg(CASE WHEN PERFORMANCE_CATEGORY = 'Esgotada' THEN (CASE WHEN SALES_RATE > 1 THEN 1.0 ELSE 0.0 END) END) AS oversell_share
FROM offers_f""")
def d09a(spark, sf):
    return kpis.performance_drilldown_summary(_of(spark, sf), ob.CAT_SOLD_OUT)


@query("d09_drilldown_by_vertical_partial", """
SELECT VERTICAL, count(*) AS n, round(avg(SALES_RATE), 2) AS mean_sales_rate,
       round(coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0), 2) AS sum_amount
FROM offers_f WHERE PERFORMANCE_CATEGORY = 'Venda_Parcial' AND VERTICAL IS NOT NULL GROUP BY VERTICAL""")
def d09b(spark, sf):
    return kpis.performance_drilldown_by_vertical(_of(spark, sf), ob.CAT_PARTIAL)


@query("d09_top10_domains_sold_out", """
SELECT DOMAIN_ID, count(*) AS n FROM offers_f
WHERE PERFORMANCE_CATEGORY = 'Esgotada' AND DOMAIN_ID IS NOT NULL
GROUP BY DOMAIN_ID ORDER BY n DESC, DOMAIN_ID LIMIT 10""")
def d09c(spark, sf):
    c = kpis.performance_drilldown_counts(_of(spark, sf), ob.CAT_SOLD_OUT, "DOMAIN_ID")
    return kpis.top_groups(c, "DOMAIN_ID", "n", 10)


@query("d09_per_day_unsold", """
SELECT CAST(OFFER_START_DTTM AS DATE) AS day, count(*) AS n FROM offers_f
WHERE PERFORMANCE_CATEGORY = 'Não_Vendida' AND OFFER_START_DTTM IS NOT NULL GROUP BY 1""")
def d09d(spark, sf):
    d = _of(spark, sf).select("*", F.col("OFFER_START_DTTM").cast("date").alias("day"))
    return kpis.performance_drilldown_counts(d, ob.CAT_UNSOLD, "day")


@query("d09_histogram_sales_rate_partial", """
WITH d AS (SELECT SALES_RATE AS x FROM offers_f WHERE PERFORMANCE_CATEGORY = 'Venda_Parcial' AND SALES_RATE IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM d)
SELECT CASE WHEN b.hi = b.lo THEN 0 ELSE least(CAST(floor((x - b.lo) / (b.hi - b.lo) * 30) AS INTEGER), 29) END AS bin,
       count(*) AS n,
       min(b.lo) + (CASE WHEN b.hi = b.lo THEN 0 ELSE least(CAST(floor((x - b.lo) / (b.hi - b.lo) * 30) AS INTEGER), 29) END) * (min(b.hi) - min(b.lo)) / 30.0 AS bin_start
FROM d, b GROUP BY 1""")
def d09e(spark, sf):
    from faultline.operators.stats import histogram
    d = _of(spark, sf).where(F.col("PERFORMANCE_CATEGORY") == ob.CAT_PARTIAL)
    return histogram(d, "SALES_RATE", 30).select("bin", "n", "bin_start")


@query("h02_top10_offers_by_rate", f"""
SELECT {', '.join(OFFER_KEY)}, SALES_RATE, VERTICAL FROM offers_f
ORDER BY SALES_RATE DESC, {', '.join(OFFER_KEY)} LIMIT 10""")
def h02(spark, sf):
    d = _of(spark, sf)
    return d.orderBy(F.col("SALES_RATE").desc(), *OFFER_KEY).limit(10).select(*OFFER_KEY, "SALES_RATE", "VERTICAL")


# ------------------------------------------------------------------ D10-D20 temporal
_WD = f"""SELECT WEEKDAY, {_cat_sums()}, count(*) AS total FROM offers_f WHERE WEEKDAY IS NOT NULL GROUP BY WEEKDAY"""


@query("d10_weekday_performance", f"SELECT *, {_cat_pcts()} FROM ({_WD})")
def d10(spark, sf):
    return kpis.weekday_performance(_of(spark, sf))


@query("d11_vertical_category_stats", """
SELECT VERTICAL, PERFORMANCE_CATEGORY, count(*) AS n, avg(SALES_RATE) AS mean_sales_rate,
       coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS revenue, avg(DURATION_HOURS) AS mean_duration
FROM offers_f WHERE VERTICAL IS NOT NULL AND PERFORMANCE_CATEGORY IS NOT NULL GROUP BY 1, 2""")
def d11(spark, sf):
    return kpis.vertical_category_stats(_of(spark, sf))


def _evo_sql(expr):
    return f"SELECT {expr} AS period, {_cat_sums()} FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL GROUP BY 1"


@query("d12_evolution_day", _evo_sql("CAST(OFFER_START_DTTM AS DATE)"))
def d12a(spark, sf):
    return kpis.evolution(_of(spark, sf), "day")


@query("d12_evolution_week", _evo_sql("weekofyear(OFFER_START_DTTM)"))
def d12b(spark, sf):
    return kpis.evolution(_of(spark, sf), "week")


@query("d12_evolution_month", _evo_sql("month(OFFER_START_DTTM)"))
def d12c(spark, sf):
    return kpis.evolution(_of(spark, sf), "month")


@query("d13_vertical_weekday_category", """
WITH g AS (SELECT VERTICAL, WEEKDAY, PERFORMANCE_CATEGORY, count(*) AS n FROM offers_f
           WHERE VERTICAL IS NOT NULL AND WEEKDAY IS NOT NULL GROUP BY 1, 2, 3)
SELECT *, sum(n) OVER (PARTITION BY VERTICAL, WEEKDAY) AS total,
       round(CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY VERTICAL, WEEKDAY) * 100, 1) AS pct FROM g""")
def d13(spark, sf):
    return kpis.category_counts_by(_of(spark, sf), ["VERTICAL", "WEEKDAY"])


@query("d14_rate_by_weekday", """
SELECT WEEKDAY, avg(SALES_RATE) AS mean_sales_rate, stddev_samp(SALES_RATE) AS std_sales_rate
FROM offers_f WHERE WEEKDAY IS NOT NULL GROUP BY 1""")
def d14(spark, sf):
    return kpis.rate_by_weekday(_of(spark, sf))


@query("d15_revenue_cube", """
SELECT VERTICAL, PERFORMANCE_CATEGORY, coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS revenue,
       GROUPING(VERTICAL, PERFORMANCE_CATEGORY) AS level
FROM offers_f WHERE VERTICAL IS NOT NULL AND PERFORMANCE_CATEGORY IS NOT NULL
GROUP BY CUBE (VERTICAL, PERFORMANCE_CATEGORY)""")
def d15(spark, sf):
    return kpis.revenue_by(_of(spark, sf))


@query("d16_daily_rate", """
SELECT CAST(OFFER_START_DTTM AS DATE) AS day, avg(SALES_RATE) AS mean_sales_rate
FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL GROUP BY 1""")
def d16a(spark, sf):
    return kpis.daily_rate(_of(spark, sf))


@query("d16_daily_rate_by_vertical", """
SELECT CAST(OFFER_START_DTTM AS DATE) AS day, VERTICAL, avg(SALES_RATE) AS mean_sales_rate
FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL AND VERTICAL IS NOT NULL GROUP BY 1, 2""")
def d16b(spark, sf):
    return kpis.daily_rate(_of(spark, sf), by_vertical=True)


@query("d16_daily_rate_grid", """
WITH c AS (SELECT CAST(OFFER_START_DTTM AS DATE) AS day, VERTICAL, avg(SALES_RATE) AS r
           FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL AND VERTICAL IS NOT NULL GROUP BY 1, 2)
SELECT d.day, v.VERTICAL, coalesce(c.r, 0.0) AS mean_sales_rate
FROM (SELECT DISTINCT day FROM c) d CROSS JOIN (SELECT DISTINCT VERTICAL FROM c) v LEFT JOIN c ON c.day = d.day AND c.VERTICAL = v.VERTICAL""")
def d16c(spark, sf):
    return kpis.daily_rate_grid(_of(spark, sf))


@query("d17_trend_first_last", """
WITH d AS (SELECT CAST(OFFER_START_DTTM AS DATE) AS day, SALES_RATE, weekofyear(OFFER_START_DTTM) AS wk
           FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL),
b AS (SELECT min(day) AS lo, max(day) AS hi FROM d)
SELECT avg(CASE WHEN day = b.lo THEN SALES_RATE END) AS first_day_rate,
       avg(CASE WHEN day = b.hi THEN SALES_RATE END) AS last_day_rate,
       count(DISTINCT day) AS n_days, count(DISTINCT wk) AS n_weeks, min(day) AS first_day, max(day) AS last_day,
       CASE WHEN avg(CASE WHEN day = b.hi THEN SALES_RATE END) > avg(CASE WHEN day = b.lo THEN SALES_RATE END)
            THEN 'improved' ELSE 'worsened' END AS trend
FROM d, b""")
def d17(spark, sf):
    return kpis.trend_first_last(_of(spark, sf))


@query("d18_seasonality", """
SELECT month(OFFER_START_DTTM) AS month, avg(SALES_RATE) AS mean_sales_rate,
       sum(CASE WHEN PERFORMANCE_CATEGORY = 'Esgotada' THEN 1 ELSE 0 END) AS n_sold_out
FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL GROUP BY 1""")
def d18(spark, sf):
    return kpis.seasonality(_of(spark, sf))


@query("d19_temporal_insights", f"""
WITH wd AS (SELECT *, {_cat_pcts()} FROM ({_WD})), v AS ({_PBV})
SELECT (SELECT WEEKDAY FROM wd ORDER BY "pct_Esgotada" DESC, WEEKDAY LIMIT 1) AS weekday_max_sold_out,
       (SELECT WEEKDAY FROM wd ORDER BY "pct_Não_Vendida" DESC, WEEKDAY LIMIT 1) AS weekday_max_unsold,
       (SELECT VERTICAL FROM v ORDER BY mean_sales_rate DESC, VERTICAL LIMIT 1) AS vertical_max_rate,
       min(CAST(OFFER_START_DTTM AS DATE)) AS first_day, max(CAST(OFFER_START_DTTM AS DATE)) AS last_day,
       count(DISTINCT CAST(OFFER_START_DTTM AS DATE)) AS n_days
FROM offers_f WHERE OFFER_START_DTTM IS NOT NULL""")
def d19(spark, sf):
    return kpis.temporal_insights(_of(spark, sf))


@query("d20_top_combinations", """
SELECT VERTICAL, WEEKDAY, count(*) AS n FROM offers_f WHERE VERTICAL IS NOT NULL AND WEEKDAY IS NOT NULL
GROUP BY 1, 2 ORDER BY n DESC, VERTICAL, WEEKDAY LIMIT 3""")
def d20(spark, sf):
    return kpis.top_combinations(_of(spark, sf), 3)


# ------------------------------------------------------------------ D21-D29
@query("d21_offer_quality", """
SELECT count(*) AS n, sum(CASE WHEN SOLD_UNITS_MISMATCH > 0 THEN 1 ELSE 0 END) AS n_mismatch,
       CAST(sum(CASE WHEN SOLD_UNITS_MISMATCH > 0 THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS pct_mismatch,
       avg(CASE WHEN SOLD_UNITS_MISMATCH > 0 THEN SOLD_UNITS_MISMATCH END) AS mean_mismatch,
       sum(CASE WHEN ORIGIN IS NULL THEN 1 ELSE 0 END) AS n_origin_missing,
       CAST(sum(CASE WHEN ORIGIN IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / count(*) * 100 AS pct_origin_missing
FROM offers_f""")
def d21a(spark, sf):
    return kpis.offer_quality(_of(spark, sf))


@query("d21_oversell_by_vertical", """
SELECT VERTICAL, sum(OVERSELL_FLAG) AS n_oversell, coalesce(sum(OVERSELL_UNITS), 0.0) AS oversell_units,
       avg(OVERSELL_FLAG) * 100 AS pct_oversell
FROM offers_f WHERE VERTICAL IS NOT NULL GROUP BY 1""")
def d21b(spark, sf):
    return kpis.oversell_by_vertical(_of(spark, sf))


@query("d22_duration_revenue", f"""
WITH per AS (SELECT VERTICAL, coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS rev, avg(DURATION_HOURS) AS dur,
                    avg({sql_div('SOLD_AMOUNT', 'DURATION_HOURS')}) AS rph
             FROM offers_f WHERE VERTICAL IS NOT NULL GROUP BY 1),
agg AS (SELECT quantile_cont(DURATION_HOURS, 0.5) AS median_duration, avg(DURATION_HOURS) AS mean_duration,
               coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS total_revenue, avg(SOLD_AMOUNT) AS mean_revenue,
               {sql_corr('DURATION_HOURS', 'SOLD_AMOUNT')} AS corr_duration_revenue FROM offers_f)
SELECT median_duration, mean_duration, total_revenue, mean_revenue, corr_duration_revenue,
       CASE WHEN corr_duration_revenue > 0.3 THEN 'positive' WHEN corr_duration_revenue < -0.3 THEN 'negative'
            ELSE 'weak' END AS verdict,
       (SELECT VERTICAL FROM per ORDER BY rev DESC, VERTICAL LIMIT 1) AS top_vertical_revenue,
       (SELECT VERTICAL FROM per ORDER BY dur DESC, VERTICAL LIMIT 1) AS top_vertical_duration,
       (SELECT VERTICAL FROM per ORDER BY rph DESC, VERTICAL LIMIT 1) AS top_vertical_revenue_per_hour
FROM agg""")
def d22(spark, sf):
    return kpis.duration_revenue(_of(spark, sf))


@query("d23_mean_duration_by_vertical", """
SELECT VERTICAL, avg(DURATION_HOURS) AS mean_duration FROM offers_f WHERE VERTICAL IS NOT NULL GROUP BY 1""")
def d23(spark, sf):
    return kpis.mean_duration_by_vertical(_of(spark, sf))


def _pareto_sql(level, frac):
    return f"""
WITH r AS (SELECT {level}, coalesce(SOLD_AMOUNT, 0.0) AS v,
                  row_number() OVER (PARTITION BY {level} ORDER BY coalesce(SOLD_AMOUNT, 0.0) DESC) AS rn,
                  count(*) OVER (PARTITION BY {level}) AS n
           FROM offers_f WHERE {level} IS NOT NULL),
g AS (SELECT {level}, n AS n_ofertas, greatest(1, CAST(ceil(n * {frac}::DOUBLE) AS BIGINT)) AS n_top,
             CAST(sum(CASE WHEN rn <= greatest(1, CAST(ceil(n * {frac}::DOUBLE) AS BIGINT)) THEN CAST(v AS DECIMAL(38,6)) ELSE 0 END) AS DOUBLE) AS top,
             CAST(sum(CAST(v AS DECIMAL(38,6))) AS DOUBLE) AS gmv_total
      FROM r GROUP BY {level}, n)
SELECT {level}, n_ofertas, n_top, top / greatest(gmv_total, 1.0) AS gmv_share_top, gmv_total,
       CASE WHEN top / greatest(gmv_total, 1.0) >= 0.8 THEN 'ALTA'
            WHEN top / greatest(gmv_total, 1.0) >= 0.6 THEN 'MÉDIA' ELSE 'BAIXA' END AS concentration
FROM g"""


@query("d24_pareto_vertical", _pareto_sql("VERTICAL", 0.1))
def d24a(spark, sf):
    return kpis.pareto_concentration(_of(spark, sf), "VERTICAL", 0.1)


@query("d24_pareto_brand", _pareto_sql("DOM_DOMAIN_AGG1", 0.2))
def d24b(spark, sf):
    return kpis.pareto_concentration(_of(spark, sf), "DOM_DOMAIN_AGG1", 0.2)


@query("d25_pareto_curve", """
WITH runs AS (SELECT VERTICAL, coalesce(SOLD_AMOUNT, 0.0) AS v, count(*) AS c
              FROM offers_f WHERE VERTICAL IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT VERTICAL, v, c,
               sum(c) OVER (PARTITION BY VERTICAL ORDER BY v DESC ROWS UNBOUNDED PRECEDING) AS cc,
               sum(CAST(v AS DECIMAL(38,6)) * c) OVER (PARTITION BY VERTICAL ORDER BY v DESC ROWS UNBOUNDED PRECEDING) AS cs,
               sum(c) OVER (PARTITION BY VERTICAL) AS n, sum(CAST(v AS DECIMAL(38,6)) * c) OVER (PARTITION BY VERTICAL) AS g
        FROM runs)
SELECT VERTICAL, cc AS n_offers, CAST(cc AS DOUBLE) / n AS offer_pct,
       CASE WHEN g <> 0 THEN CAST(cs AS DOUBLE) / CAST(g AS DOUBLE) END AS revenue_pct FROM cum""")
def d25(spark, sf):
    return kpis.pareto_curve(_of(spark, sf), "VERTICAL")


_SHIP = """SELECT VERTICAL, DURATION_BUCKET, SHIPPING_PAYMENT_TYPE, count(*) AS n, avg(SELL_THROUGH) AS sell_through,
       avg(VALUE_PER_STOCK_UNIT) AS value_per_stock, avg(STOCKOUT_FLAG) AS stockout_rate,
       coalesce(CAST(sum(CAST(SOLD_AMOUNT AS DECIMAL(38,6))) AS DOUBLE), 0.0) AS gmv
FROM offers_f WHERE VERTICAL IS NOT NULL AND DURATION_BUCKET IS NOT NULL AND SHIPPING_PAYMENT_TYPE IS NOT NULL
GROUP BY 1, 2, 3"""


@query("d26_shipping_comparison", _SHIP)
def d26(spark, sf):
    return kpis.shipping_comparison(_of(spark, sf))


_MS = ["sell_through", "value_per_stock", "stockout_rate"]


@query("d27_shipping_diff_ranking", f"""
WITH w AS (SELECT VERTICAL, DURATION_BUCKET,
  {', '.join(f"max(CASE WHEN SHIPPING_PAYMENT_TYPE = '{t}' THEN {m} END) AS {m}_{t}" for m in _MS for t in ('FREE', 'PAID'))},
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'FREE' THEN 1 END) AS ha, max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'PAID' THEN 1 END) AS hb
  FROM ({_SHIP}) GROUP BY 1, 2)
SELECT VERTICAL, DURATION_BUCKET, {', '.join(f"{m}_{t}" for m in _MS for t in ('FREE', 'PAID'))},
  {', '.join(f"{m}_FREE - {m}_PAID AS diff_{m}" for m in _MS)}
FROM w WHERE ha IS NOT NULL AND hb IS NOT NULL
ORDER BY diff_sell_through DESC NULLS LAST, VERTICAL, DURATION_BUCKET LIMIT 10""")
def d27a(spark, sf):
    return kpis.shipping_diff_ranking(_of(spark, sf))


for _metric in _MS[1:]:
    def _diffs(spark, sf, m=_metric):
        return kpis.shipping_diff_ranking(_of(spark, sf), metric=m)
    query(f"d27_shipping_diff_ranking_{_metric}", f"""
WITH w AS (SELECT VERTICAL, DURATION_BUCKET,
  {', '.join(f"max(CASE WHEN SHIPPING_PAYMENT_TYPE = '{t}' THEN {m} END) AS {m}_{t}" for m in _MS for t in ('FREE', 'PAID'))},
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'FREE' THEN 1 END) AS ha, max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'PAID' THEN 1 END) AS hb
  FROM ({_SHIP}) GROUP BY 1, 2)
SELECT VERTICAL, DURATION_BUCKET, {', '.join(f"{m}_{t}" for m in _MS for t in ('FREE', 'PAID'))},
  {', '.join(f"{m}_FREE - {m}_PAID AS diff_{m}" for m in _MS)}
FROM w WHERE ha IS NOT NULL AND hb IS NOT NULL
ORDER BY diff_{_metric} DESC NULLS LAST, VERTICAL, DURATION_BUCKET LIMIT 10""")(_diffs)


@query("d27_shipping_verdict", f"""
WITH w AS (SELECT VERTICAL, DURATION_BUCKET,
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'FREE' THEN sell_through END) AS a,
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'FREE' THEN 1 END) AS ha,
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'PAID' THEN sell_through END) AS b,
  max(CASE WHEN SHIPPING_PAYMENT_TYPE = 'PAID' THEN 1 END) AS hb
  FROM ({_SHIP}) GROUP BY 1, 2)
SELECT avg(a) AS mean_FREE, avg(b) AS mean_PAID, count(*) AS n_strata,
       CASE WHEN avg(a) > avg(b) THEN 'FREE' ELSE 'PAID' END AS better
FROM w WHERE ha IS NOT NULL AND hb IS NOT NULL""")
def d27b(spark, sf):
    return kpis.shipping_verdict(_of(spark, sf))


# each stratum's own average over its FREE offers, strata without one included
_STRATA = """
WITH l AS (SELECT VERTICAL, DURATION_BUCKET,
                  coalesce(avg(SELL_THROUGH) FILTER (WHERE SHIPPING_PAYMENT_TYPE = 'FREE'), 0.0) AS sell_through,
                  coalesce(avg(VALUE_PER_STOCK_UNIT) FILTER (WHERE SHIPPING_PAYMENT_TYPE = 'FREE'), 0.0) AS value_per_stock
           FROM offers_f WHERE VERTICAL IS NOT NULL AND DURATION_BUCKET IS NOT NULL AND SHIPPING_PAYMENT_TYPE IS NOT NULL
           GROUP BY 1, 2),
b AS (SELECT min(value_per_stock) AS lo, max(value_per_stock) AS hi FROM l)
SELECT VERTICAL, DURATION_BUCKET, sell_through, value_per_stock,
       CASE WHEN b.hi > b.lo THEN 0.7 * sell_through + 0.3 * ((value_per_stock - b.lo) / (b.hi - b.lo))
            ELSE sell_through END AS score
FROM l, b"""


@query("d28_stratum_score", _STRATA)
def d28(spark, sf):
    return kpis.stratum_score(_of(spark, sf))


@query("d28_stratum_extremes", f"""
WITH s AS (SELECT * FROM ({_STRATA}))
SELECT 'top' AS side, row_number() OVER (ORDER BY score DESC, VERTICAL, DURATION_BUCKET) AS rank, VERTICAL, DURATION_BUCKET, score FROM s QUALIFY rank <= 5
UNION ALL
SELECT 'bottom', row_number() OVER (ORDER BY score, VERTICAL, DURATION_BUCKET) AS rank, VERTICAL, DURATION_BUCKET, score FROM s QUALIFY rank <= 5""")
def d28b(spark, sf):
    return kpis.stratum_extremes(_of(spark, sf))


# the product of the factors up to each time, over the offers still at risk then
_KM = """
WITH t AS (SELECT SHIPPING_PAYMENT_TYPE, DURATION_HOURS AS time,
                  sum(CASE WHEN STOCKOUT_FLAG = 1 THEN 1 ELSE 0 END) AS events, count(*) AS total
           FROM offers_f WHERE DURATION_HOURS IS NOT NULL AND SHIPPING_PAYMENT_TYPE IS NOT NULL GROUP BY 1, 2),
r AS (SELECT a.SHIPPING_PAYMENT_TYPE, a.time, a.events, a.total, sum(b.total) AS at_risk
      FROM t a JOIN t b ON a.SHIPPING_PAYMENT_TYPE = b.SHIPPING_PAYMENT_TYPE AND b.time >= a.time GROUP BY ALL)
SELECT a.SHIPPING_PAYMENT_TYPE, a.time, a.events, a.total, a.at_risk, product(1.0::DOUBLE - CAST(b.events AS DOUBLE) / b.at_risk) AS survival
FROM r a JOIN r b ON a.SHIPPING_PAYMENT_TYPE = b.SHIPPING_PAYMENT_TYPE AND b.time <= a.time GROUP BY ALL"""


@query("d29_kaplan_meier", _KM)
def d29a(spark, sf):
    return kpis.kaplan_meier(_of(spark, sf))


@query("d29_kaplan_meier_summary", f"""
SELECT SHIPPING_PAYMENT_TYPE, sum(total) AS n, sum(events) AS n_events,
       CAST(sum(events) AS DOUBLE) / sum(total) AS event_rate, arg_max(survival, time) AS final_survival
FROM ({_KM}) GROUP BY 1""")
def d29b(spark, sf):
    return kpis.kaplan_meier_summary(_of(spark, sf))
