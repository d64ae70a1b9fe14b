"""Statistics and distribution summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def histogram(df: DataFrame, column: str, bins: int = 30, by: str | None = None) -> DataFrame:
    """Equal-width histogram between the column's min and max (last bin closed), counts
    per bin (and per ``by`` value).  Bounds are scalar subqueries; binning is a projection and
    the counts one partial/final aggregate."""
    x = F.col(column)
    d = df.where(x.isNotNull())
    lo = d.select(F.min(x)).scalar()
    hi = d.select(F.max(x)).scalar()
    b = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((x - lo) / (hi - lo) * bins).cast("int"), F.lit(bins - 1)))
    keys = [b.alias("bin")] + ([F.col(by)] if by else [])
    g = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    return g.select("*", (lo + F.col("bin") * (hi - lo) / F.lit(float(bins))).alias("bin_start"))


def transformed_histogram(df: DataFrame, column: str, by: str, transform: str | None = "log1p", bins: int = 30) -> DataFrame:
    """Histogram of a transformed column (B21: log1p and sqrt of x >= 0, log of x > 0) over all rows
    and per value of ``by``, on the same bins, in one pass over grouping sets: (level, by, bin, n,
    bin_start), level "all" or "group"."""
    from faultline.operators.offers import log_transform
    d = log_transform(df, column, transform).withColumn("__x", F.col(f"{column}_{transform}")) if transform else df.withColumn("__x", F.col(column).cast("double"))
    d = d.where(F.col("__x").isNotNull()).select(F.col(by).alias(by), "__x")
    lo, hi = d.select(F.min("__x")).scalar(), d.select(F.max("__x")).scalar()
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("__x") - lo) / (hi - lo) * bins).cast("int"), F.lit(bins - 1)))
    g = d.withColumn("bin", b).groupingSets([[F.col("bin")], [F.col("bin"), F.col(by)]], "bin", by).agg(
        F.count(F.lit(1)).alias("n"), F.grouping(by).alias("__all"))
    return g.select(F.when(F.col("__all") == 1, "all").otherwise("group").alias("level"), by, "bin", "n",
                    (lo + F.col("bin") * (hi - lo) / F.lit(float(bins))).alias("bin_start"))


# ------------------------------------------------------------------ E1-E5 correlations
import numpy as np  # noqa: E402
import pyarrow as pa  # noqa: E402
from pyspark.sql import Window  # noqa: E402

from faultline.functions.exprs import pearson  # noqa: E402
from faultline.plans.prefix import exact_quantiles, join_small, prefix_sums  # noqa: E402
from faultline.session import materialize  # noqa: E402


def correlation(df: DataFrame, a: str, b: str) -> DataFrame:
    """Pairwise-complete Pearson correlation of two columns (one row; NULL if constant)."""
    return df.agg(pearson(F.col(a).cast("double"), F.col(b).cast("double")).alias("corr"))


def pairwise_correlations(df: DataFrame, cols: list[str], pairs: list[tuple[str, str]] | None = None) -> DataFrame:
    """E2 (long form): (var1, var2, i, j, corr) for every pair i < j of ``cols`` (or ``pairs``),
    pairwise-complete like pandas ``DataFrame.corr``; NaN counts as missing.

    Two passes over the rows.  The first counts and sums each column over the rows where each other one is
    present, the second sums squares and products of the deviations from exactly these means, so
    that neither rows missing in the partner nor large offsets cost precision.  Columns that are present in the
    same rows (their counts agree with their common one) have the same partners' means: their products are
    one matrix product.  Each task reduces its rows to one row per pair; nothing but (pair, sums) is shuffled, and
    the counts and sums, one pair of numbers per pair of columns, are all that the driver sees.  NULL if a column
    is constant over the pair's rows, or there are fewer than two."""
    idx = {c: i for i, c in enumerate(cols)}
    if pairs is None:
        pairs = [(cols[i], cols[j]) for i in range(len(cols)) for j in range(i + 1, len(cols))]
    used = list(dict.fromkeys([c for p in pairs for c in p]))
    at = {c: i for i, c in enumerate(used)}
    left = np.array([at[a] for a, _ in pairs], np.int64)
    right = np.array([at[b] for _, b in pairs], np.int64)
    values = [F.col(f"`{c}`").cast("double") for c in used]
    x = df.select(*[F.when(~F.isnan(v), v).alias(f"c{i}") for i, v in enumerate(values)])

    def table_of(batch):
        m = np.column_stack([c.to_numpy(zero_copy_only=False).astype(np.float64) for c in batch.columns])
        return m, ~np.isnan(m)

    def means_pass(batches):
        n = total = None
        for batch in batches:
            m, there = table_of(batch)
            one = there.astype(np.float64)
            both, sums = one.T @ one, np.where(there, m, 0.0).T @ one
            n, total = (both, sums) if n is None else (n + both, total + sums)
        if n is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n.size, dtype=np.int32)), pa.array(n.ravel()), pa.array(total.ravel())],
                                             names=["cell", "n", "s"])
    n, total = np.zeros((2, len(used), len(used)))
    for r in x.mapInArrow(means_pass, "cell int, n double, s double").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect():
        n.flat[r.cell], total.flat[r.cell] = r.n, r.s
    mean = np.divide(total, n, out=np.zeros_like(total), where=n > 0)
    # the first column that is present in the same rows
    like = np.array([next(j for j in range(i + 1) if n[i, j] == n[i, i] == n[j, j]) for i in range(len(used))], np.int64)
    groups = {}
    for k, (i, j) in enumerate(zip(left, right)):
        groups.setdefault((min(like[i], like[j]), max(like[i], like[j])), []).append(k)
    blocks = []
    for (p, q), members in groups.items():
        k = np.array(members)
        turned = like[left[k]] != p
        a, b = np.where(turned, right[k], left[k]), np.where(turned, left[k], right[k])
        ca, ia = np.unique(a, return_inverse=True)
        cb, ib = np.unique(b, return_inverse=True)
        blocks.append((p, q, k, turned, ca, ia, mean[ca, q], cb, ib, mean[cb, p]))

    def sums_of(v, means):
        d = v - means
        return d, np.vstack([(d * d).sum(0), v.min(0), v.max(0)])

    def plus(a, b):
        return b if a is None else np.vstack([a[:1] + b[:1], np.minimum(a[1], b[1]), np.maximum(a[2], b[2])])

    def products_pass(batches):
        counts, xy, of_a, of_b = ([v] * len(blocks) for v in (0.0, 0.0, None, None))
        seen = False
        for batch in batches:
            m, there = table_of(batch)
            seen = True
            for g, (p, q, _, _, ca, _, ma, cb, _, mb) in enumerate(blocks):
                both = there[:, p] & there[:, q]
                if not both.any():
                    continue
                rows = m if both.all() else m[both]
                da, a = sums_of(rows[:, ca], ma)
                db, b = sums_of(rows[:, cb], mb)
                counts[g], xy[g] = counts[g] + len(rows), xy[g] + da.T @ db
                of_a[g], of_b[g] = plus(of_a[g], a), plus(of_b[g], b)
        if seen:
            out = np.zeros((8, len(left)))
            out[[4, 6]], out[[5, 7]] = np.inf, -np.inf
            for g, (_, _, k, turned, _, ia, _, _, ib, _) in enumerate(blocks):
                if of_a[g] is not None:
                    a, b = of_a[g][:, ia], of_b[g][:, ib]
                    first, second = np.where(turned, b, a), np.where(turned, a, b)
                    out[:, k] = (np.full(len(k), counts[g]), xy[g][ia, ib], first[0], second[0], first[1], first[2], second[1], second[2])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(left), dtype=np.int32)), *[pa.array(t) for t in out]],
                                             names=["pid", *names])
    names = ["n", "xy", "xx", "yy", "a0", "a1", "b0", "b1"]
    g = x.mapInArrow(products_pass, "pid int, " + ", ".join(f"{c} double" for c in names)).groupBy("pid").agg(
        *[F.sum(c).alias(c) for c in names[:4]], F.min("a0").alias("a0"), F.max("a1").alias("a1"),
        F.min("b0").alias("b0"), F.max("b1").alias("b1"))
    varied = (F.col("n") > 1) & (F.col("a0") < F.col("a1")) & (F.col("b0") < F.col("b1"))
    r = F.when(varied, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.col("xy") / F.sqrt(F.col("xx")) / F.sqrt(F.col("yy")))))
    listed = df.sparkSession.createDataFrame([(k, a, b, idx.get(a, -1), idx.get(b, -1)) for k, (a, b) in enumerate(pairs)],
                                             "pid int, var1 string, var2 string, i int, j int")
    return listed.join(g.select("pid", r.alias("corr")), "pid", "left").select("var1", "var2", "i", "j", "corr")


def correlated_pairs(df: DataFrame, cols: list[str], threshold: float = 0.7, strict: bool = False) -> DataFrame:
    """Upper-triangle pairs with |r| >= threshold (> when ``strict``), tagged Original /
    Criada and by feature family, sorted by |r| desc."""
    from faultline.operators.offers import CATEGORICAL_COLS, DATE_COLS, NUMERIC_COLS, feature_family
    originals = set(DATE_COLS + NUMERIC_COLS + CATEGORICAL_COLS)
    tipo = {c: ("Original" if c in originals else "Criada") for c in cols}
    fam = {c: feature_family(c) for c in cols}

    def lookup(d, c):
        return F.element_at(F.create_map(*[F.lit(x) for kv in d.items() for x in kv]), F.col(c))
    long = pairwise_correlations(df, cols)
    r = F.abs(F.col("corr"))
    keep = (r > threshold) if strict else (r >= threshold)
    return long.where(keep).select(
        F.col("var1").alias("Variavel_1"), lookup(tipo, "var1").alias("Tipo_1"),
        lookup(fam, "var1").alias("Categoria_1"), F.col("var2").alias("Variavel_2"),
        lookup(tipo, "var2").alias("Tipo_2"), lookup(fam, "var2").alias("Categoria_2"),
        F.col("corr").alias("Correlacao"), r.alias("Correlacao_Abs"),
        F.concat(lookup(tipo, "var1"), F.lit(" × "), lookup(tipo, "var2")).alias("Tipo_Relacao"),
        "i", "j").orderBy(F.col("Correlacao_Abs").desc(), "i", "j").drop("i", "j")


def correlated_pairs_report(pairs: DataFrame, top: int = 10) -> DataFrame:
    """Per relation type the number of pairs, the strongest |r| and the ``top`` pairs, one row
    per pair with its rank in its type (ties by name); one row per pair of columns at most."""
    by_type = Window.partitionBy("Tipo_Relacao")
    best = by_type.orderBy(F.round("Correlacao_Abs", 9).desc(), "Variavel_1", "Variavel_2")
    return pairs.select("Tipo_Relacao", F.count(F.lit(1)).over(by_type).alias("n_pairs"),
                        F.max("Correlacao_Abs").over(by_type).alias("max_abs_corr"), F.row_number().over(best).alias("rank"),
                        "Variavel_1", "Variavel_2", "Correlacao").where(F.col("rank") <= top)


# ------------------------------------------------------------------ E6, E7, E10 quartiles
def _stack(df: DataFrame, cols: list[str], extra: list[str] | None = None) -> DataFrame:
    """(extra..., variable, value) long form of numeric columns (one explode, no shuffle)."""
    e = list(extra or [])
    return df.select(*e, F.explode(F.array(*[
        F.struct(F.lit(c).alias("variable"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols
    ])).alias("__s")).select(*e, "__s.variable", "__s.value")


def _quartiles(long: DataFrame, keys: list[str]) -> DataFrame:
    q = exact_quantiles(long, "value", [0.25, 0.5, 0.75], keys)
    return q.groupBy(*keys).agg(
        F.max(F.when(F.col("q_idx") == 0, F.col("value"))).alias("q1"),
        F.max(F.when(F.col("q_idx") == 1, F.col("value"))).alias("median"),
        F.max(F.when(F.col("q_idx") == 2, F.col("value"))).alias("q3"))


def iqr_outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows below Q1 - 1.5 IQR or above Q3 + 1.5 IQR (linear-interpolated quartiles)."""
    x = F.col(column)
    q = exact_quantiles(df, column, [0.25, 0.75])
    q1 = q.where("q_idx = 0").select("value").scalar()
    q3 = q.where("q_idx = 1").select("value").scalar()
    iqr = q3 - q1
    return df.where((x < q1 - 1.5 * iqr) | (x > q3 + 1.5 * iqr))


def outlier_report(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column the number and % (of all rows) of IQR outliers — one quartile job for
    all columns (grouped by column) and one conditional count."""
    qs = {r["variable"]: r for r in _quartiles(_stack(df, cols), ["variable"]).collect()}     # one row per column
    cells = []
    for c in cols:
        x, q = F.col(f"`{c}`").cast("double"), qs.get(c)
        far = (x < q["q1"] - 1.5 * (q["q3"] - q["q1"])) | (x > q["q3"] + 1.5 * (q["q3"] - q["q1"])) if q else F.lit(False)
        cells.append(F.struct(F.lit(c).alias("variable"), F.sum(F.when(far, 1).otherwise(0)).alias("n_outliers")))
    one = df.agg(F.array(*cells).alias("__c"), F.count(F.lit(1)).alias("__n"))
    return one.select(F.explode("__c").alias("c"), "__n").select("c.variable", "c.n_outliers", (F.col("c.n_outliers") / F.col("__n") * 100).alias("pct_outliers"))


def box_summary(df: DataFrame, cols: list[str], by: str | None = None) -> DataFrame:
    """Median, quartiles, whiskers (extreme values inside 1.5 IQR) and outlier count per
    column (and per ``by`` group)."""
    keys = ([by] if by else []) + ["variable"]
    long = _stack(df.where(F.col(by).isNotNull()) if by else df, cols, [by] if by else [])
    long = long.where(F.col("value").isNotNull())
    qs = _quartiles(long, keys)
    lo = F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))
    j = join_small(long, qs, keys)
    inside = (F.col("value") >= lo) & (F.col("value") <= hi)
    return j.groupBy(*keys).agg(F.first("q1").alias("q1"), F.first("median").alias("median"),
                                F.first("q3").alias("q3"),
                                F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
                                F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
                                F.sum(F.when(inside, 0).otherwise(1)).alias("n_outliers"))


# ------------------------------------------------------------------ E9 KDE
def kde(df: DataFrame, column: str, grid_size: int = 100, by: str | None = None) -> DataFrame:
    """Gaussian kernel density on ``grid_size`` points between min and max, Scott bandwidth
    (sample std * n^(-1/5)), overall or per ``by`` group.

    Values are first reduced to (value, count); each distinct value emits its weighted kernel
    at every grid point (explode of a bounded array) and the points are summed with a
    partial/final aggregate — no join with the data."""
    d = df.where(F.col(column).isNotNull() & (F.col(by).isNotNull() if by else F.lit(True)))
    if not by:
        d = d.withColumn("__g", F.lit(0))
    keys = [by or "__g"]
    st = d.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"), F.stddev_samp(column).alias("__sd"),
                              F.min(column).alias("__lo"), F.max(column).alias("__hi"))
    st = st.select(*keys, "__n", "__lo", "__hi",
                   (F.col("__sd") * F.pow(F.col("__n").cast("double"), F.lit(-0.2))).alias("__bw"))
    v = d.groupBy(*keys, F.col(column).alias("__v")).agg(F.count(F.lit(1)).alias("__c"))
    j = join_small(v, st, keys)
    pts = F.posexplode(F.array_repeat(F.lit(0), grid_size)).alias("gi", "__z")
    e = j.select(*keys, "__v", "__c", "__n", "__lo", "__hi", "__bw", pts)
    x = F.col("__lo") + F.col("gi") * (F.col("__hi") - F.col("__lo")) / F.lit(float(grid_size - 1))
    z = (x - F.col("__v")) / F.col("__bw")
    k = F.col("__c") * F.exp(-0.5 * z * z) / (F.col("__n") * F.col("__bw") * F.lit(float(np.sqrt(2 * np.pi))))
    out = e.groupBy(*keys, "gi").agg(F.first(x).alias("x"), F.sum(k).alias("density"))
    return out if by else out.drop("__g")


# ------------------------------------------------------------------ E11
def category_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Value counts per categorical column, long form (column, value, n)."""
    long = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value"))
                                          for c in cols])).alias("__s")).select("__s.*")
    return long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ E12-E16 feature screening
def leakage_check(df: DataFrame, target: str, threshold: float = 0.8,
                  exclude=("device", "date")) -> DataFrame:
    """|corr(feature, target)| > threshold, descending; the target itself is part of the
    result (|r| = 1), as in the source; constant features (NULL r) are excluded."""
    feats = [c for c in df.columns if c not in exclude]
    pairs = [(c, target) for c in feats]
    long = pairwise_correlations(df, feats, pairs)
    return long.select(F.col("var1").alias("feature"), F.abs("corr").alias("abs_corr")) \
        .where(F.col("abs_corr") > threshold).orderBy(F.col("abs_corr").desc(), "feature")


def feature_correlation_prune(df: DataFrame, features: list[str], target: str,
                              corr_threshold: float = 0.95, target_threshold: float = 0.01) -> DataFrame:
    """A feature is removed when any *earlier* feature has |r| > corr_threshold with it;
    recommended when not removed and |r with target| >= target_threshold (NULL r -> not kept).
    Returns (feature, target_corr, removed, recommended)."""
    # the pairs with the target, told apart by their place (-1 if it is no feature), come from the same two passes
    both = [(a, b) for i, a in enumerate(features) for b in features[i + 1:]]
    long = materialize(pairwise_correlations(df, features, list(dict.fromkeys(both + [(c, target) for c in features]))), "pairs")
    earlier = F.col("i") < F.col("j")
    rem = long.where(earlier & (F.abs("corr") > corr_threshold)).select(F.col("var2").alias("feature")).distinct() \
        .select("feature", F.lit(1).alias("removed"))
    tc = long.where(F.col("var2") == target).select(F.col("var1").alias("feature"), F.col("corr").alias("target_corr"))
    out = tc.join(rem, on="feature", how="left").select(
        "feature", "target_corr", F.coalesce("removed", F.lit(0)).alias("removed"))
    return out.select("*", ((F.col("removed") == 0) & F.coalesce(F.abs("target_corr") >= target_threshold,
                                                                   F.lit(False))).cast("int").alias("recommended"))


def low_variance(df: DataFrame, features: list[str], threshold: float = 0.01) -> DataFrame:
    """Sample variance per feature and a flag for variance < threshold."""
    agg = df.agg(*[F.var_samp(F.col(f"`{c}`").cast("double")).alias(f"v{i}") for i, c in enumerate(features)])
    long = agg.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"v{i}").alias("variance"))
                                          for i, c in enumerate(features)])).alias("s")).select("s.*")
    return long.select("*", F.coalesce(F.col("variance") < threshold, F.lit(False)).cast("int").alias("low_variance"))


def anova_f(df: DataFrame, features: list[str], target: str, max_features: int | None = None) -> DataFrame:
    """One-way ANOVA F statistic and p-value per feature over the target classes (rows where
    the feature is present).  One aggregate by class holds count, mean and variance of every
    feature; the classes are then few rows.  ``max_features`` optionally limits the features."""
    feats = features[:max_features]
    x = [F.col(f"`{c}`").cast("double") for c in feats]
    # stable aggregates per class, so a constant feature gives exactly zero within-class variance
    # (F undefined -> NULL), not float noise
    per = df.groupBy(F.col(target).alias("__y")).agg(*[
        F.struct(F.count(v).alias("n"), F.avg(v).alias("m"), F.var_pop(v).alias("v")).alias(f"s{i}") for i, v in enumerate(x)])
    long = per.select("__y", F.explode(F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"s{i}").alias("s"))
                                                 for i, c in enumerate(feats)])).alias("e")).select("__y", "e.variable", "e.s.*")
    t = long.where("n > 0").groupBy("variable").agg(
        F.sum("n").alias("n_all"), F.count(F.lit(1)).alias("k"), F.collect_list(F.struct("n", "m")).alias("classes"),
        (F.sum(F.col("n") * F.col("m")) / F.sum("n")).alias("grand"), F.sum(F.col("n") * F.col("v")).alias("ssw"))
    ssb = F.aggregate("classes", F.lit(0.0), lambda acc, c: acc + c["n"] * (c["m"] - F.col("grand")) * (c["m"] - F.col("grand")))
    d1, d2 = (F.col("k") - 1).cast("double"), (F.col("n_all") - F.col("k")).cast("double")
    f = F.try_divide(F.try_divide(ssb, d1), F.try_divide(F.col("ssw"), d2))
    out = t.select(F.col("variable").alias("feature"), f.alias("f_score"), d1.alias("d1"), d2.alias("d2"))
    return out.select("feature", "f_score", _f_tail(F.col("f_score"), F.col("d1"), F.col("d2")).alias("p_value"))


def _ln_gamma(z):
    """ln of the gamma function for z > 0: Stirling's series, shifted to where it is exact."""
    shifted = z + 8
    series = (shifted - 0.5) * F.ln(shifted) - shifted + 0.5 * float(np.log(2 * np.pi)) + 1 / (12 * shifted) \
        - 1 / (360 * F.pow(shifted, F.lit(3.0))) + 1 / (1260 * F.pow(shifted, F.lit(5.0)))
    product = F.lit(1.0)
    for i in range(8):
        product = product * (z + i)
    return series - F.ln(product)


def _f_tail(f, d1, d2):
    """P(F > f): the regularised incomplete beta function by its continued fraction, evaluated
    from the innermost of ``terms`` levels outwards; NULL where that many are too few."""
    terms = 400
    a, b, x = d2 / 2, d1 / 2, d2 / (d2 + d1 * f)

    def beta(p, q, at):
        def level(m):
            down = -(p + m) * (p + q + m) * at / ((p + 2 * m) * (p + 2 * m + 1))
            up = m * (q - m) * at / ((p + 2 * m - 1) * (p + 2 * m))
            return down, up

        def fold(n):
            # 1 + d1/(1 + d2/(1 + ...)), d of level m: down(m - 1) then up(m)
            return F.aggregate(F.sequence(F.lit(n), F.lit(1), F.lit(-1)), F.lit(0.0), lambda acc, m: (
                level(m - 1)[0] / (1 + level(m)[1] / (1 + acc))))
        front = F.exp(p * F.ln(at) + q * F.ln(1 - at) + _ln_gamma(p + q) - _ln_gamma(p) - _ln_gamma(q)) / p
        long, short = front / (1 + fold(terms)), front / (1 + fold(terms // 2))
        return F.when(F.abs(long - short) <= F.lit(1e-12) + F.lit(1e-9) * F.abs(long), long)
    turned = x > (a + 1) / (a + b + 2)
    value = F.when(turned, 1 - beta(b, a, 1 - x)).otherwise(beta(a, b, x))
    return F.when(f <= 0, F.lit(1.0)).when(x <= 0, F.lit(0.0)).otherwise(F.when(value < 0, F.lit(0.0)).otherwise(value))


def _rounded(x):
    """``round(x)`` of a double (halves away from zero) without its decimal arithmetic: the fraction is exact
    below 2^52, and greater numbers, infinities and NaN are left as they are."""
    whole = F.floor(F.abs(x)).cast("double")
    up = whole + F.when(F.abs(x) - whole >= 0.5, 1.0).otherwise(0.0)
    return F.when(F.abs(x) < float(2 ** 52), F.when((x < 0) & (up > 0), -up).otherwise(up)).otherwise(x)


def _cuts_upto(x, cuts, lo: int, hi: int):
    """How many of the ascending ``cuts`` are at most ``x``, at least ``lo`` and at most ``hi`` of them: by halves."""
    if lo == hi:
        return F.lit(lo)
    mid = (lo + hi) // 2
    return F.when(x < cuts[mid], _cuts_upto(x, cuts, lo, mid)).otherwise(_cuts_upto(x, cuts, mid + 1, hi))


def mutual_information(df: DataFrame, features: list[str], target: str, bins: int = 10,
                       resolution: float = 1e-9) -> DataFrame:
    """E16 (re-aimed): plug-in mutual information (nats) between the target and each feature
    cut into ``bins`` equal-frequency bins (exact quantile cut points; a value's bin = number of
    cut points <= value).  Deterministic, unlike the nearest-neighbour estimator of the source.
    Values are binned at ``resolution`` (rounded first), so last-bit noise cannot move a point
    across a cut."""
    m = 1.0 / resolution
    # features go by their place; their cut points (bins - 1 each) are all that the driver sees
    long = df.select(F.explode(F.array(*[F.struct(F.lit(i).alias("variable"), F.col(f"`{c}`").cast("double").alias("x")) for i, c in enumerate(features)]))
                     .alias("s"), F.col(target).alias("y")).where(F.col("s.x").isNotNull()) \
        .select("s.variable", (_rounded(F.col("s.x") * F.lit(m)) / F.lit(m)).alias("value"), "y")
    cuts = [[] for _ in features]
    for r in exact_quantiles(long, "value", [i / bins for i in range(1, bins)], ["variable"]).collect():
        cuts[r["variable"]].append(r["value"])
    held = F.array(*[F.array(*[F.lit(c) for c in sorted(of, key=lambda c: (c != c, c))]).cast("array<double>") for of in cuts])
    ct = long.groupBy("variable", _cuts_upto(F.col("value"), F.element_at(held, F.col("variable") + 1), 0, bins - 1).alias("bin"), "y") \
        .agg(F.count(F.lit(1)).alias("n"))
    ct = ct.withColumn("variable", F.element_at(F.array(*[F.lit(c) for c in features]), F.col("variable") + 1))
    w_f = Window.partitionBy("variable")
    w_b = Window.partitionBy("variable", "bin")
    w_y = Window.partitionBy("variable", "y")
    t = ct.select("*", F.sum("n").over(w_f).alias("n_all"), F.sum("n").over(w_b).alias("nb"),
                  F.sum("n").over(w_y).alias("ny"))
    term = F.col("n") / F.col("n_all") * F.ln(F.col("n") * F.col("n_all") / (F.col("nb") * F.col("ny")))
    return t.groupBy(F.col("variable").alias("feature")).agg(F.sum(term).alias("mi_score"))


# ------------------------------------------------------------------ E17 KS drift
def drift_ks(train: DataFrame, test: DataFrame, features: list[str], alpha: float = 0.05,
             max_features: int | None = None) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov D per feature (all, or the first ``max_features``),
    asymptotic p-value, and a drift flag (p < alpha).

    Both samples are reduced to (feature, value, count per side); the two empirical CDFs are
    running sums over values per feature (range-bucketed prefix sums, so a feature with many
    distinct values is spread over many tasks); D = max |F1 - F2|.  A feature without values in one
    sample cannot be tested: its D, p-value and flag are NULL."""
    feats = features[:max_features]
    both = train.select(*[F.col(f"`{c}`") for c in feats], F.lit(1).alias("__side")).unionByName(
        test.select(*[F.col(f"`{c}`") for c in feats], F.lit(2).alias("__side")))
    return drift_between(both, "__side", feats, alpha)


def drift_between(df: DataFrame, side: str, features: list[str], alpha: float = 0.05) -> DataFrame:
    """E17 for one table whose column ``side`` is 1 (training) or 2 (test): both samples in one pass."""
    long = _stack(df, features, [side]).where(F.col("value").isNotNull())
    v = long.groupBy("variable", "value").agg(F.sum(F.when(F.col(side) == 1, 1).otherwise(0)).alias("c1"),
                                              F.sum(F.when(F.col(side) == 2, 1).otherwise(0)).alias("c2"))
    j = prefix_sums(v, ["value"], ["c1", "c2"], ["variable"], total_prefix="n_").withColumnsRenamed({"n_c1": "n1", "n_c2": "n2"})
    d = j.groupBy("variable", "n1", "n2").agg(
        F.max(F.abs(F.try_divide("cum_c1", "n1") - F.try_divide("cum_c2", "n2"))).alias("ks_stat"))
    ne = F.nullif(F.col("n1") * F.col("n2"), F.lit(0)) / (F.col("n1") + F.col("n2"))
    lam = (F.sqrt(ne) + 0.12 + 0.11 / F.sqrt(ne)) * F.col("ks_stat")
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0),
                         lambda acc, k: acc + F.pow(F.lit(-1.0), k - 1) * F.exp(-2.0 * k * k * lam * lam))
    p = F.when(F.col("ks_stat").isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), 2 * series)))
    return d.select(F.col("variable").alias("feature"), "ks_stat", p.alias("p_value"), "n1", "n2") \
        .select("*", (F.col("p_value") < alpha).cast("int").alias("drift"))


def remove_drift_features(df: DataFrame, drifted: list[str]) -> DataFrame:
    """Drop drifted columns that start with ``attribute`` and are not ``_normalized``
    (normalised versions are never dropped)."""
    return df.drop(*[c for c in drifted if c.startswith("attribute") and not c.endswith("_normalized")])
