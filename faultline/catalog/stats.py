"""Statistics queries (E1-E17, B25) over the offer features and the device feature table."""

from __future__ import annotations

from pyspark.sql import functions as F

from faultline.catalog.devices import H, feature_sql, label_sql
from faultline.operators import features as fe, labels as lb, offers as ob, stats as st
from faultline.oracle import sql_corr
from faultline.registry import query
from faultline.sources.fixtures import ATTRS, FIXTURE_PURGE, FIXTURE_SIZE, OFFER_KEY, device_readings, offers

NUM = ob.column_catalog()["numericas_analises"]
BOX = ob.column_catalog()["box_quantidades"]
CATEG = ob.column_catalog()["todas_categoricas"]
FEATS = [c for c in fe.feature_names() if c not in ("device", "date", "early_warn_target")]
TARGET = "early_warn_target"
SCREEN = ATTRS + [f"{a}_normalized" for a in ATTRS]     # E13 / E16 feature set


def _of(spark, sf):
    return ob.offer_features(offers(spark, sf))


def _feat(spark, sf, saved=True):
    # screening reports read the table in two passes: it is written once to the shared folder.
    # Reports of one pass over some columns read it as it is, and the windows of others are pruned
    table = fe.device_features(device_readings(spark, sf), forecast_horizon=H)
    if not saved:
        return table
    from faultline.session import materialize
    # doubles that seldom repeat: a dictionary of each would be built and dropped
    return materialize(table, "features", {"parquet.enable.dictionary": "false"})


FEAT_SQL = f"({label_sql(feature_sql(), H)})"
#: The feature table as a CTE that DuckDB works out once.
FF = f"WITH ff AS MATERIALIZED (SELECT * FROM {FEAT_SQL})"


def _q(c):
    return f'"{c}"'


def _pairs_sql(src, pairs, idx):
    parts = [f"SELECT '{a}' AS var1, '{b}' AS var2, {idx.get(a, -1)} AS i, {idx.get(b, -1)} AS j, "
             f"{sql_corr(f'CAST({_q(a)} AS DOUBLE)', f'CAST({_q(b)} AS DOUBLE)')} AS corr FROM {src}"
             for a, b in pairs]
    return "\nUNION ALL ".join(parts)


def _all_pairs(cols):
    return [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]


_IDX = {c: i for i, c in enumerate(NUM)}
_CORR = _pairs_sql("offers_f", _all_pairs(NUM), _IDX)


@query("e01_correlation", f"SELECT {sql_corr('DURATION_HOURS', 'SOLD_AMOUNT')} AS corr FROM offers_f")
def e01(spark, sf):
    return st.correlation(_of(spark, sf), "DURATION_HOURS", "SOLD_AMOUNT")


@query("e02_correlation_matrix", _CORR)
def e02(spark, sf):
    return st.pairwise_correlations(_of(spark, sf), NUM)


def _tipo(c):
    originals = set(ob.DATE_COLS + ob.NUMERIC_COLS + ob.CATEGORICAL_COLS)
    return "Original" if c in originals else "Criada"


def _case(col, d):
    return "CASE " + " ".join(f"WHEN {col} = '{k}' THEN '{v}'" for k, v in d.items()) + " END"


def _pairs_tagged_sql(cmp):
    tipo = {c: _tipo(c) for c in NUM}
    fam = {c: ob.feature_family(c) for c in NUM}
    return f"""SELECT var1 AS Variavel_1, {_case('var1', tipo)} AS Tipo_1, {_case('var1', fam)} AS Categoria_1,
  var2 AS Variavel_2, {_case('var2', tipo)} AS Tipo_2, {_case('var2', fam)} AS Categoria_2,
  corr AS Correlacao, abs(corr) AS Correlacao_Abs, {_case('var1', tipo)} || ' × ' || {_case('var2', tipo)} AS Tipo_Relacao
FROM ({_CORR}) WHERE abs(corr) {cmp}"""


@query("e03_correlated_pairs", _pairs_tagged_sql(">= 0.7"))
def e03(spark, sf):
    return st.correlated_pairs(_of(spark, sf), NUM, 0.7)


@query("e04_correlated_pairs_report", f"""
SELECT * FROM (SELECT Tipo_Relacao, count(*) OVER (PARTITION BY Tipo_Relacao) AS n_pairs,
                      max(Correlacao_Abs) OVER (PARTITION BY Tipo_Relacao) AS max_abs_corr,
                      row_number() OVER (PARTITION BY Tipo_Relacao ORDER BY round(Correlacao_Abs, 9) DESC, Variavel_1, Variavel_2) AS rank,
                      Variavel_1, Variavel_2, Correlacao FROM ({_pairs_tagged_sql('>= 0.7')})) WHERE rank <= 10""")
def e04(spark, sf):
    return st.correlated_pairs_report(st.correlated_pairs(_of(spark, sf), NUM, 0.7))


@query("e05_strong_correlations", _pairs_tagged_sql("> 0.5"))
def e05(spark, sf):
    return st.correlated_pairs(_of(spark, sf), NUM, 0.5, strict=True)


@query("e06_iqr_outliers", f"""
WITH q AS (SELECT quantile_cont(SOLD_AMOUNT, 0.25) AS q1, quantile_cont(SOLD_AMOUNT, 0.75) AS q3 FROM offers_f)
SELECT {', '.join(OFFER_KEY)}, SOLD_AMOUNT FROM offers_f, q
WHERE SOLD_AMOUNT < q1 - 1.5 * (q3 - q1) OR SOLD_AMOUNT > q3 + 1.5 * (q3 - q1)""")
def e06(spark, sf):
    return st.iqr_outliers(_of(spark, sf), "SOLD_AMOUNT").select(*OFFER_KEY, "SOLD_AMOUNT")


@query("e06_iqr_outliers_readings", """
WITH q AS (SELECT quantile_cont(attribute4, 0.25) AS q1, quantile_cont(attribute4, 0.75) AS q3 FROM device_readings)
SELECT device, date, attribute4 FROM device_readings, q
WHERE attribute4 < q1 - 1.5 * (q3 - q1) OR attribute4 > q3 + 1.5 * (q3 - q1)""")
def e06_readings(spark, sf):
    return st.iqr_outliers(device_readings(spark, sf), "attribute4").select("device", "date", "attribute4")


def _long_sql(cols, src, extra=""):
    return "\nUNION ALL ".join(f"SELECT {extra}'{c}' AS variable, CAST({_q(c)} AS DOUBLE) AS value FROM {src}"
                               for c in cols)


@query("e07_outlier_report", f"""
WITH l AS ({_long_sql(NUM, 'offers_f')}),
q AS (SELECT variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.75) AS q3 FROM l GROUP BY 1)
SELECT l.variable, sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END) AS n_outliers,
       sum(CASE WHEN value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1) THEN 1 ELSE 0 END)
         / (SELECT CAST(count(*) AS DOUBLE) FROM offers_f) * 100 AS pct_outliers
FROM l JOIN q ON l.variable = q.variable GROUP BY 1""")
def e07(spark, sf):
    return st.outlier_report(_of(spark, sf), NUM)


@query("e08_histogram_by_shipping", """
WITH d AS (SELECT SELL_THROUGH AS x, SHIPPING_PAYMENT_TYPE FROM offers_f WHERE SELL_THROUGH IS NOT NULL),
b AS (SELECT min(x) AS lo, max(x) AS hi FROM d)
SELECT CASE WHEN b.hi = b.lo THEN 0 ELSE least(CAST(floor((x - b.lo) / (b.hi - b.lo) * 30) AS INTEGER), 29) END AS bin,
       SHIPPING_PAYMENT_TYPE, count(*) AS n,
       min(b.lo) + (CASE WHEN b.hi = b.lo THEN 0 ELSE least(CAST(floor((x - b.lo) / (b.hi - b.lo) * 30) AS INTEGER), 29) END)
                  * (min(b.hi) - min(b.lo)) / 30.0 AS bin_start
FROM d, b GROUP BY 1, 2""")
def e08(spark, sf):
    return st.histogram(_of(spark, sf), "SELL_THROUGH", 30, by="SHIPPING_PAYMENT_TYPE")


_TRANSFORMS = {"log1p": ("ln(1 + x)", "x >= 0"), "sqrt": ("sqrt(x)", "x >= 0"), "log": ("ln(x)", "x > 0")}
for _kind, (_fn, _ok) in _TRANSFORMS.items():
    def _histogram(spark, sf, kind=_kind):
        return st.transformed_histogram(_of(spark, sf), "SALES_RATE", "SHIPPING_PAYMENT_TYPE", kind, 30)
    query(f"e08_histogram_{_kind}", f"""
WITH d AS (SELECT {_fn} AS x, SHIPPING_PAYMENT_TYPE FROM (SELECT SALES_RATE AS x, SHIPPING_PAYMENT_TYPE FROM offers_f) WHERE {_ok}),
l AS (SELECT min(x) AS lo, max(x) AS hi FROM d),
b AS (SELECT CASE WHEN hi = lo THEN 0 ELSE least(CAST(floor((x - lo) / (hi - lo) * 30) AS INTEGER), 29) END AS bin, SHIPPING_PAYMENT_TYPE, lo, hi FROM d, l),
g AS (SELECT 'all' AS level, NULL AS SHIPPING_PAYMENT_TYPE, bin, count(*) AS n FROM b GROUP BY bin
      UNION ALL SELECT 'group', SHIPPING_PAYMENT_TYPE, bin, count(*) FROM b GROUP BY 2, 3)
SELECT level, SHIPPING_PAYMENT_TYPE, bin, n, lo + bin * (hi - lo) / 30.0 AS bin_start FROM g, l""")(_histogram)


@query("e09_kde_sales_rate", """
WITH d AS (SELECT SHIPPING_PAYMENT_TYPE AS g, SALES_RATE AS v FROM offers_f WHERE SALES_RATE IS NOT NULL AND SHIPPING_PAYMENT_TYPE IS NOT NULL),
s AS (SELECT g, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), -0.2) AS bw FROM d GROUP BY g),
vc AS (SELECT g, v, count(*) AS c FROM d GROUP BY 1, 2),
grid AS (SELECT s.*, gi, s.lo + gi * (s.hi - s.lo) / 49.0 AS x FROM s, range(0, 50) t(gi))
SELECT grid.g AS SHIPPING_PAYMENT_TYPE, gi, min(x) AS x,
       sum(vc.c * exp(-0.5 * ((x - vc.v) / bw) * ((x - vc.v) / bw)) / (n * bw * sqrt(2 * pi()))) AS density
FROM grid JOIN vc ON grid.g = vc.g GROUP BY 1, 2""")
def e09(spark, sf):
    return st.kde(_of(spark, sf), "SALES_RATE", 50, by="SHIPPING_PAYMENT_TYPE")


@query("e10_box_summary", f"""
WITH l AS ({_long_sql(BOX, 'offers_f', 'PERFORMANCE_CATEGORY, ')}),
l2 AS (SELECT * FROM l WHERE value IS NOT NULL AND PERFORMANCE_CATEGORY IS NOT NULL),
q AS (SELECT PERFORMANCE_CATEGORY, variable, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
             quantile_cont(value, 0.75) AS q3 FROM l2 GROUP BY 1, 2)
SELECT l2.PERFORMANCE_CATEGORY, l2.variable, min(q1) AS q1, min(median) AS median, min(q3) AS q3,
       min(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_low,
       max(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN value END) AS whisker_high,
       sum(CASE WHEN value >= q1 - 1.5 * (q3 - q1) AND value <= q3 + 1.5 * (q3 - q1) THEN 0 ELSE 1 END) AS n_outliers
FROM l2 JOIN q ON l2.PERFORMANCE_CATEGORY = q.PERFORMANCE_CATEGORY AND l2.variable = q.variable GROUP BY 1, 2""")
def e10(spark, sf):
    return st.box_summary(_of(spark, sf), BOX, by="PERFORMANCE_CATEGORY")


@query("e11_category_counts", 'SELECT "column", value, count(*) AS n FROM ('
       + "\nUNION ALL ".join(f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value FROM offers_f" for c in CATEG)
       + ") WHERE value IS NOT NULL GROUP BY 1, 2")
def e11(spark, sf):
    return st.category_counts(_of(spark, sf), CATEG)


_LEAK_COLS = FEATS + [TARGET]


@query("e12_leakage_check", f"""{FF}
SELECT var1 AS feature, abs(corr) AS abs_corr FROM (
{_pairs_sql('ff', [(c, TARGET) for c in _LEAK_COLS], {c: i for i, c in enumerate(_LEAK_COLS)})})
WHERE abs(corr) > 0.8""")
def e12(spark, sf):
    return st.leakage_check(_feat(spark, sf), TARGET, 0.8)


_SCREEN_IDX = {c: i for i, c in enumerate(SCREEN)}


@query("e13_feature_correlation_prune", f"""{FF},
pc AS ({_pairs_sql('ff', _all_pairs(SCREEN), _SCREEN_IDX)}),
rem AS (SELECT DISTINCT var2 AS feature FROM pc WHERE abs(corr) > 0.95),
tc AS ({_pairs_sql('ff', [(c, TARGET) for c in SCREEN], _SCREEN_IDX)})
SELECT tc.var1 AS feature, tc.corr AS target_corr, CASE WHEN rem.feature IS NULL THEN 0 ELSE 1 END AS removed,
       CAST(rem.feature IS NULL AND coalesce(abs(tc.corr) >= 0.01, false) AS INTEGER) AS recommended
FROM tc LEFT JOIN rem ON tc.var1 = rem.feature""")
def e13(spark, sf):
    return st.feature_correlation_prune(_feat(spark, sf), SCREEN, TARGET)


# the reports over every feature have no SQL: ties and bins of the derived ones hang on last bits
@query("e13_feature_correlation_prune_all")
def e13_all(spark, sf):
    return st.feature_correlation_prune(_feat(spark, sf), FEATS, TARGET)


@query("e14_low_variance", FF + "\n" + "\nUNION ALL ".join(
    f"SELECT '{c}' AS feature, var_samp(CAST({_q(c)} AS DOUBLE)) AS variance, "
    f"CAST(coalesce(var_samp(CAST({_q(c)} AS DOUBLE)) < 0.01, false) AS INTEGER) AS low_variance FROM ff"
    for c in FEATS))
def e14(spark, sf):
    return st.low_variance(_feat(spark, sf, saved=False), FEATS)


# two classes: F(1, d) is the square of Student's t, whose tail is integrated by Simpson's rule
@query("e15_anova_f", f"""{FF},
l AS ({_long_sql(FEATS, 'ff', TARGET + ', ')}),
per AS (SELECT variable, {TARGET}, count(*) AS n, avg(value) AS m, var_pop(value) AS v FROM l WHERE value IS NOT NULL GROUP BY 1, 2),
tot AS (SELECT variable, sum(n) AS n_all, count(*) AS k, sum(n * m) / sum(n) AS grand, sum(n * v) AS ssw FROM per GROUP BY 1),
sb AS (SELECT per.variable, sum(n * (m - grand) * (m - grand)) AS ssb FROM per JOIN tot ON per.variable = tot.variable GROUP BY 1),
f AS (SELECT tot.variable AS feature, CAST(n_all - k AS DOUBLE) AS d,
             CASE WHEN k > 1 AND ssw / (n_all - k) <> 0 THEN (ssb / (k - 1)) / (ssw / (n_all - k)) END AS f_score
      FROM tot JOIN sb ON tot.variable = sb.variable),
t AS (SELECT *, sqrt(f_score) AS x, exp(lgamma((d + 1) / 2) - lgamma(d / 2)) / sqrt(d * pi()) AS peak FROM f),
s AS (SELECT feature, sum((CASE WHEN i IN (0, 2000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
                          * peak * pow(1 + (x * i / 2000.0::DOUBLE) * (x * i / 2000.0::DOUBLE) / d, -(d + 1) / 2)) * x / 6000.0::DOUBLE AS half
      FROM t, range(0, 2001) r(i) WHERE x IS NOT NULL GROUP BY feature, x)
SELECT t.feature, t.f_score, CASE WHEN t.x IS NOT NULL THEN greatest(0.0, 1 - 2 * s.half) END AS p_value
FROM t LEFT JOIN s ON t.feature = s.feature""")
def e15(spark, sf):
    return st.anova_f(_feat(spark, sf, saved=False), FEATS, TARGET)


@query("e16_mutual_information", f"""
WITH l AS ({_long_sql(SCREEN, FEAT_SQL, TARGET + ', ')}),
l2 AS (SELECT * EXCLUDE (value), round(value * 1e9) / 1e9 AS value FROM l WHERE value IS NOT NULL),
c AS (SELECT variable, quantile_cont(value, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9]::DOUBLE[]) AS cuts FROM l2 GROUP BY 1),
ct AS (SELECT l2.variable, len(list_filter(c.cuts, lambda q: q <= l2.value)) AS bin, {TARGET} AS y, count(*) AS n
       FROM l2 JOIN c ON l2.variable = c.variable GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER (PARTITION BY variable) AS NN, sum(n) OVER (PARTITION BY variable, bin) AS nb,
             sum(n) OVER (PARTITION BY variable, y) AS ny FROM ct)
SELECT variable AS feature, sum(CAST(n AS DOUBLE) / NN * ln(CAST(n AS DOUBLE) * NN / (nb * ny))) AS mi_score FROM t GROUP BY 1""")
def e16(spark, sf):
    return st.mutual_information(_feat(spark, sf), SCREEN, TARGET, 10)


@query("e16_mutual_information_all")
def e16_all(spark, sf):
    return st.mutual_information(_feat(spark, sf), FEATS, TARGET, 10)


_KS_FEATS = FEATS[:10]


def _ks_sides(spark, sf):
    """Training and test rows in one table; windows of features that are not asked for are pruned."""
    f = lb.temporal_split(_feat(spark, sf, saved=False), FIXTURE_PURGE, FIXTURE_SIZE, FIXTURE_SIZE)
    return f.where(F.col("split").isin("train", "test")).withColumn("side", F.when(F.col("split") == "train", 1).otherwise(2))


_KS_SQL = f"""
WITH f AS (SELECT * FROM {FEAT_SQL}),
b AS (SELECT max(date) AS hi, date_diff('day', min(date), max(date)) AS span FROM f),
s AS (SELECT f.*, CASE WHEN date <= CAST(b.hi - to_days(2 * CAST(floor(b.span * 0.3::DOUBLE) AS INTEGER)) AS DATE) - INTERVAL 1 DAY THEN 1
                       WHEN date >= CAST(b.hi - to_days(CAST(floor(b.span * 0.3::DOUBLE) AS INTEGER)) AS DATE) + INTERVAL 1 DAY THEN 2 END AS side
      FROM f, b),
l AS ({_long_sql(_KS_FEATS, '(SELECT * FROM s WHERE side IS NOT NULL)', 'side, ')}),
v AS (SELECT variable, value, sum(CASE WHEN side = 1 THEN 1 ELSE 0 END) AS c1, sum(CASE WHEN side = 2 THEN 1 ELSE 0 END) AS c2
      FROM l WHERE value IS NOT NULL GROUP BY 1, 2),
cum AS (SELECT *, sum(c1) OVER w AS cc1, sum(c2) OVER w AS cc2, sum(c1) OVER (PARTITION BY variable) AS n1,
               sum(c2) OVER (PARTITION BY variable) AS n2
        FROM v WINDOW w AS (PARTITION BY variable ORDER BY value ROWS UNBOUNDED PRECEDING)),
d AS (SELECT variable, n1, n2, max(abs(CAST(cc1 AS DOUBLE) / n1 - CAST(cc2 AS DOUBLE) / n2)) AS ks_stat FROM cum GROUP BY 1, 2, 3),
lam AS (SELECT *, (sqrt(CAST(n1 * n2 AS DOUBLE) / (n1 + n2)) + 0.12 + 0.11 / sqrt(CAST(n1 * n2 AS DOUBLE) / (n1 + n2))) * ks_stat AS l FROM d),
p AS (SELECT variable, least(1.0, greatest(0.0, 2 * sum(pow(-1.0, k - 1) * exp(-2.0 * k * k * l * l)))) AS p_value
      FROM lam, range(1, 101) t(k) GROUP BY variable)
SELECT lam.variable AS feature, ks_stat, p_value, n1, n2, CAST(p_value < 0.05 AS INTEGER) AS drift
FROM lam JOIN p ON lam.variable = p.variable"""


@query("e17_drift_ks", _KS_SQL)
def e17(spark, sf):
    return st.drift_between(_ks_sides(spark, sf), "side", _KS_FEATS)


@query("e17_drift_ks_all")
def e17_all(spark, sf):
    return st.drift_between(_ks_sides(spark, sf), "side", FEATS)


# the columns tested for drift that stay, with the values each has left
@query("b25_remove_drift_features", f"""
WITH report AS ({_KS_SQL}), n AS ({" UNION ALL ".join(f"SELECT '{c}' AS feature, count({_q(c)}) AS n_values FROM {FEAT_SQL}" for c in _KS_FEATS)})
SELECT n.feature, n_values FROM n JOIN report ON n.feature = report.feature
WHERE NOT (coalesce(drift, 0) = 1 AND starts_with(n.feature, 'attribute') AND NOT suffix(n.feature, '_normalized'))""")
def b25(spark, sf):
    report = st.drift_between(_ks_sides(spark, sf), "side", _KS_FEATS)
    drifted = [r["feature"] for r in report.where("drift = 1").select("feature").collect()]        # names of columns
    left = st.remove_drift_features(_feat(spark, sf, saved=False).select(*_KS_FEATS), drifted)
    return left.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.count(F.col(f"`{c}`")).alias("n_values")) for c in left.columns]).alias("c")).select(F.inline("c"))


# every feature with its family, and the values it has
_FAMILY_SQL = ("CASE WHEN contains(f, '_lag_') THEN 'Temporal (Lag)' WHEN contains(f, '_ma_') THEN 'Temporal (Média Móvel)' "
               "WHEN contains(f, '_std_') THEN 'Temporal (Desvio Padrão)' WHEN contains(f, '_diff') THEN 'Temporal (Diferença)' "
               "WHEN contains(f, '_slope_') THEN 'Temporal (Tendência)' WHEN contains(f, 'device') THEN 'Dispositivo' "
               "WHEN f IN ('year', 'month', 'day', 'dayofweek', 'dayofyear', 'weekofyear', 'quarter') THEN 'Temporal (Data)' "
               "WHEN starts_with(f, 'is_') THEN 'Sazonalidade' WHEN contains(f, '_sum') OR contains(f, '_ratio') THEN 'Interação' ELSE 'Original' END")


@query("b27_feature_families", f"""
WITH c AS (SELECT unnest({FEATS}) AS f, unnest([{", ".join(f"count({_q(c)})" for c in FEATS)}]) AS n_values FROM {FEAT_SQL})
SELECT f AS feature, {_FAMILY_SQL} AS family, n_values FROM c""")
def b27_families(spark, sf):
    from faultline.operators.ml import feature_family
    f = _feat(spark, sf, saved=False)
    cells = f.agg(F.array(*[F.struct(F.lit(c).alias("feature"), F.count(F.col(f"`{c}`")).alias("n_values")) for c in FEATS]).alias("c")).select(F.inline("c"))
    return cells.select("feature", feature_family("feature").alias("family"), "n_values")
