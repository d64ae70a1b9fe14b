"""Model operators on Spark ML.

The source trains gradient-boosted trees in one process; here every fit is a distributed
Spark ML job over the feature table, keyed rows stay as columns (no positional arrays), and
scores come back as a DataFrame ``(device, date, y, p, model)`` that the threshold / metric
operators consume.  Scores are not expected to equal the source's numerically.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.wrapper import JavaWrapper
from pyspark import SparkContext, StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from faultline.operators import labels as lb
from faultline.operators import scoring as sc
from faultline.operators.isotonic import isotonic_apply, isotonic_blocks
from faultline.plans.prefix import prefix_sums
from faultline.session import materialize

KEYS = ["device", "date"]

# Family labels of the feature-importance report (ordered name rules).
FAMILY_RULES = [
    ("contains", "_lag_", "Temporal (Lag)"),
    ("contains", "_ma_", "Temporal (Média Móvel)"),
    ("contains", "_std_", "Temporal (Desvio Padrão)"),
    ("contains", "_diff", "Temporal (Diferença)"),
    ("contains", "_slope_", "Temporal (Tendência)"),
    ("contains", "device", "Dispositivo"),
    ("in", ("year", "month", "day", "dayofweek", "dayofyear", "weekofyear", "quarter"), "Temporal (Data)"),
    ("startswith", "is_", "Sazonalidade"),
    ("contains", "_sum", "Interação"),
    ("contains", "_ratio", "Interação"),
]
OTHER_FAMILY = "Original"


def feature_family(col):
    """First matching name rule (an interaction ``_diff`` falls in "Diferença")."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for kind, arg, label in FAMILY_RULES:
        cond = (c.contains(arg) if kind == "contains" else
                c.startswith(arg) if kind == "startswith" else c.isin(*arg))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(OTHER_FAMILY))


def feature_columns(df: DataFrame, target: str) -> list[str]:
    return [c for c in df.columns if c not in ("device", "date", target, "failure", "split", "part", "fold")]


def _double_features(df: DataFrame, feats: list[str]) -> DataFrame:
    keep = [F.col(f"`{c}`") for c in df.columns if c not in feats]
    return df.select(*keep, *[F.col(f"`{c}`").cast("double").alias(c) for c in feats])


def _safe(c: str) -> str:
    return c.replace("-", "_m_")


def usable_features(train: DataFrame, feats: list[str]) -> list[str]:
    """Features with at least one value in the training rows (one aggregate row); columns
    that are entirely missing at fit time are discarded, like a median imputer does."""
    row = train.agg(*[F.count(F.col(f"`{c}`")).alias(f"n{i}") for i, c in enumerate(feats)]).first()
    return [c for i, c in enumerate(feats) if row[i] > 0]


def select_top_features(train: DataFrame, feats: list[str], target: str, k: int = 80,
                        num_trees: int = 50, seed: int = 42) -> DataFrame:
    """Rank features by random-forest impurity importance on the training rows (median
    imputation first); returns (feature, importance, rank) for the top ``k``.

    The wide rows are read twice: for the medians (the median imputer's own, to its relative error; a column
    without values has none and is left out), and for the filled vectors, which stay on the executors' disks for
    all passes of the forest (not written and read back: its draws hang on the partitions)."""
    x = [F.col(f"`{c}`").cast("double") for c in feats]
    t = train.select(F.col(target).cast("double").alias("label"), *[v.alias(f"c{i}") for i, v in enumerate(x)])
    medians = t.approxQuantile([f"c{i}" for i in range(len(feats))], [0.5], 0.001)
    used = [i for i, m in enumerate(medians) if m]
    feats = [feats[i] for i in used]
    filled = t.select("label", *[F.when(F.col(f"c{i}").isNull() | F.isnan(f"c{i}"), F.lit(medians[i][0])).otherwise(F.col(f"c{i}")).alias(f"c{i}") for i in used])
    vectors = VectorAssembler(inputCols=[f"c{i}" for i in used], outputCol="features", handleInvalid="keep").transform(filled)
    rows = vectors.select("label", "features").persist(StorageLevel.DISK_ONLY)
    model = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=num_trees, maxDepth=6, seed=seed).fit(rows)
    rows.unpersist()
    imp = model.featureImportances.toArray().tolist()
    spark = train.sparkSession
    rows = sorted(zip(feats, imp), key=lambda r: (-r[1], r[0]))
    out = spark.createDataFrame([(f, float(v), i + 1) for i, (f, v) in enumerate(rows)],
                                "feature string, importance double, rank int")
    return out.where(F.col("rank") <= k)


def prepare_dataset(features: DataFrame, target: str, purge_days: int = 7, val_size: float = 0.2,
                    test_size: float = 0.2, k: int = 80, holdout_frac: float = 0.2, seed: int = 42,
                    num_trees: int = 50, impute: bool = False):
    """Purged temporal split (G2), feature columns, top-k selection fitted on train only
    (I2), and the positional model/hold-out split of validation (G4).

    Returns (table, selected) where ``table`` = keys + target + split (train / val_model /
    val_hold / test) + selected features; with ``impute`` their missing values are the exact training
    medians (G7), as the source hands them on (models here fit their own medians otherwise)."""
    sp = lb.temporal_split(features, purge_days, val_size, test_size).where(F.col("split").isNotNull())
    feats = feature_columns(features, target)
    train = sp.where(F.col("split") == "train")
    top = select_top_features(train, feats, target, k, num_trees=num_trees, seed=seed)
    selected = [r["feature"] for r in top.orderBy("rank").collect()]  # k names (metadata)
    val = lb.positional_holdout(sp.where(F.col("split") == "val"), holdout_frac)
    val = val.withColumn("split", F.when(F.col("part") == "model", F.lit("val_model"))
                         .otherwise(F.lit("val_hold"))).drop("part")
    rest = sp.where(F.col("split") != "val")
    cols = [*KEYS, target, "split", *selected]
    table = rest.select(*[F.col(f"`{c}`") for c in cols]).unionByName(val.select(*[F.col(f"`{c}`") for c in cols]))
    if impute:
        table = lb.median_impute(train, table, selected)
    return table, selected


def _prepared_columns(df: DataFrame, feats: list[str], target: str) -> DataFrame:
    """Feature columns as doubles under names that Spark ML accepts, and the label."""
    t = _double_features(df, feats)
    return t.select("*", *[F.col(f"`{c}`").alias(_safe(c)) for c in feats if c != _safe(c)],
                    F.col(target).cast("double").alias("label"))


def _median_vector(train: DataFrame, feats: list[str], target: str) -> PipelineModel:
    """Medians of the training rows' features, and the vector of the filled features."""
    safe = [_safe(c) for c in usable_features(train, feats)]
    stages = [Imputer(inputCols=safe, outputCols=[f"{s}__i" for s in safe], strategy="median"),
              VectorAssembler(inputCols=[f"{s}__i" for s in safe], outputCol="features", handleInvalid="keep")]
    return Pipeline(stages=stages).fit(_prepared_columns(train, feats, target))


def score(model: PipelineModel, df: DataFrame, feats: list[str], target: str, name: str) -> DataFrame:
    """Apply a fitted pipeline: (device, date, y, p, model)."""
    safe = [_safe(c) for c in feats]
    t = _double_features(df, feats)
    t = t.select("*", *[F.col(f"`{c}`").alias(s) for c, s in zip(feats, safe) if c != s])
    out = model.transform(t)
    return out.select(*KEYS, F.col(target).cast("int").alias("y"),
                      vector_to_array("probability")[1].alias("p"), F.lit(name).alias("model"))


def class_weight_col(train: DataFrame, target: str, out: str = "w") -> DataFrame:
    """Positive rows weighted n_neg / n_pos (the source's scale_pos_weight) via scalars."""
    n_pos = train.select(F.sum(F.when(F.col(target) == 1, 1).otherwise(0))).scalar()
    n_neg = train.select(F.sum(F.when(F.col(target) == 1, 0).otherwise(1))).scalar()
    w = F.when(F.col(target) == 1, n_neg / F.greatest(n_pos, F.lit(1))).otherwise(F.lit(1.0))
    return train.select("*", w.cast("double").alias(out))


#: Rounds of the source's models: A and B stop early, the one of the cross-validation (CV) does not.
ROUNDS = {"A": 1000, "B": 1500, "CV": 800}
PATIENCE = 10
#: Rounds fitted before the losses are first looked at; then twice as many each time.
FIRST_ROUNDS = 16


def best_round(losses: list[float], patience: int = PATIENCE) -> tuple[int, bool]:
    """(rounds to keep, whether training has stopped): the first round without a better one among the next
    ``patience``, as early stopping sees the losses one after the other."""
    best, at = float("inf"), -1
    for i, x in enumerate(losses):
        if x < best:
            best, at = x, i
        elif i - at >= patience:
            return at + 1, True
    return at + 1, False


def _classifier(variant: str, rounds: int, seed: int) -> GBTClassifier:
    params = dict(labelCol="label", featuresCol="features", weightCol="w", maxIter=rounds,
                  maxDepth=6, subsamplingRate=0.8, featureSubsetStrategy="0.8", seed=seed)
    if variant == "B":
        params.update(stepSize=0.03, minInstancesPerNode=200)
    else:
        params.update(stepSize=0.05 if variant == "CV" else 0.1)
    return GBTClassifier(**params)


def first_rounds(model: GBTClassificationModel, rounds: int) -> GBTClassificationModel:
    """The model that a fit of ``rounds`` rounds gives: the first trees of a longer one of the same seed."""
    sc_, java = SparkContext._active_spark_context, model._java_obj
    trees = JavaWrapper._new_java_array(list(java.trees())[:rounds], sc_._jvm.org.apache.spark.ml.regression.DecisionTreeRegressionModel)
    weights = JavaWrapper._new_java_array(list(java.treeWeights())[:rounds], sc_._gateway.jvm.double)
    out = GBTClassificationModel(sc_._jvm.org.apache.spark.ml.classification.GBTClassificationModel(
        java.uid(), trees, weights, java.numFeatures(), java.numClasses()))
    out._resetUid(model.uid)
    model._copyValues(out, {out.maxIter: rounds})
    out._transfer_params_to_java()
    return out


def train_boosted(train: DataFrame, feats: list[str], target: str, variant: str = "A",
                  max_iter: int | None = None, weighted: bool = True, seed: int = 42,
                  validation: DataFrame | None = None, patience: int = PATIENCE) -> PipelineModel:
    """Boosted trees.  Variant A: depth 6, step 0.1, row/feature subsampling 0.8, up to 1000 rounds;
    variant B: step 0.03, min 200 rows per leaf, up to 1500 (Spark GBT has no leaf count or L1/L2
    terms); CV: step 0.05, 800 rounds.

    ``validation`` rows stop the training: the model keeps the rounds up to the lowest loss that
    ``patience`` further rounds did not lower.  Spark fits a given number of rounds, and the trees of a
    seed do not depend on it; so FIRST_ROUNDS are fitted, then twice as many until the losses show the
    stop, and the last fit's trees are cut at the best round: at most four times the rounds that a
    training in one go would take, and no round beyond the best is kept.  Medians and usable features come
    from the training rows alone."""
    most = max_iter or ROUNDS[variant]
    d = class_weight_col(train, target) if weighted else train.withColumn("w", F.lit(1.0))
    head = _median_vector(d, feats, target)
    wanted = ["features", "label", "w"]
    rows = materialize(head.transform(_prepared_columns(d, feats, target)).select(*wanted), "boosted")
    if validation is None:
        return PipelineModel([*head.stages, _classifier(variant, most, seed).fit(rows)])
    v = validation.withColumn("w", F.lit(1.0))
    held = materialize(head.transform(_prepared_columns(v, feats, target)).select(*wanted), "boosted-check")
    rounds = min(FIRST_ROUNDS, most)
    while True:
        model = _classifier(variant, rounds, seed).fit(rows)
        keep, stopped = best_round(model.evaluateEachIteration(held), patience)
        if stopped or rounds >= most:
            break
        rounds = min(2 * rounds, most)
    if keep < rounds:
        model = first_rounds(model, max(keep, 1))
    return PipelineModel([*head.stages, model])


def _logistic(train: DataFrame, scores: DataFrame) -> DataFrame:
    vec = VectorAssembler(inputCols=["raw"], outputCol="f")
    rows = train.groupBy("raw", "label").agg(F.count(F.lit(1)).cast("double").alias("w"))    # a weighted row per score
    n = train.count()
    lr = LogisticRegression(featuresCol="f", labelCol="label", weightCol="w", regParam=1.0 / max(n, 1),
                            standardization=False, maxIter=200)
    m = lr.fit(vec.transform(rows))
    out = m.transform(vec.transform(scores.withColumnRenamed("p", "raw")))
    return out.select(*[c for c in scores.columns if c != "p"], vector_to_array("probability")[1].alias("p"))


def calibrate(cal_scores: DataFrame, scores: DataFrame, method: str = "isotonic") -> DataFrame:
    """I4: map raw scores to calibrated probabilities fitted on ``cal_scores`` (y, p).
    Isotonic (ties averaged, linear between blocks, clipped outside the fitted range; pooled range by
    range, see ``operators.isotonic``) or a 1-D logistic map.  Columns keep their order only for
    isotonic maps; the logistic one puts ``p`` last."""
    if method == "isotonic":
        return isotonic_apply(isotonic_blocks(cal_scores), scores)
    train = cal_scores.where(F.col("p").isNotNull() & F.col("y").isNotNull()).select(F.col("p").alias("raw"), F.col("y").cast("double").alias("label"))
    return _logistic(train, scores)


def contiguous_fold(position, n, k: int):
    """The fold of a 0-based position among n rows: k runs, the first n mod k one row longer."""
    size, longer = F.floor(n / F.lit(k)), n % F.lit(k)
    edge = longer * (size + 1)
    return F.when(position < edge, F.floor(position / (size + 1))).otherwise(
        longer + F.floor((position - edge) / F.greatest(size, F.lit(1)))).cast("int")


def fold_rows(val_scores: DataFrame, k: int) -> DataFrame:
    """``val_scores`` with ``fold``: k contiguous runs of the rows in (device, date) order."""
    n = val_scores.select(F.count(F.lit(1))).scalar()
    counts = val_scores.groupBy("device").agg(F.count(F.lit(1)).alias("__n"))
    offs = prefix_sums(counts, ["device"], ["__n"]).select("device", (F.col("cum___n") - F.col("__n")).alias("__off"))
    w = Window.partitionBy("device").orderBy("date")
    pos = val_scores.join(offs, on="device").select(*val_scores.columns,
                                                      (F.col("__off") + F.row_number().over(w) - 1).alias("__pos"))
    return pos.select("*", contiguous_fold(F.col("__pos"), n, k).alias("fold")).drop("__pos")


def calibration_curves(folded: DataFrame, k: int) -> DataFrame:
    """The isotonic blocks of the k maps, each fitted on the rows of the other folds, in one job: a row
    counts in k - 1 maps, after rows of equal score and label are counted."""
    cells = folded.where(F.col("p").isNotNull() & F.col("y").isNotNull()).groupBy("fold", "p").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("y").cast("long")).alias("s"))
    maps = F.filter(F.array(*[F.lit(i) for i in range(k)]), lambda f: f != F.col("fold"))
    return isotonic_blocks(cells.select(F.explode(maps).alias("fold"), "p", "n", "s"), ["fold"], counted=("n", "s"))


def mean_of_curves(curves: DataFrame, scores: DataFrame, k: int) -> DataFrame:
    """``scores`` with ``p`` replaced by the mean of the k calibrated versions; only distinct scores are
    multiplied by k."""
    asked = scores.where(F.col("p").isNotNull()).select("p").distinct().select(
        F.col("p").alias("__raw"), "p", F.explode(F.array(*[F.lit(i) for i in range(k)])).alias("fold"))
    mean = isotonic_apply(curves, asked, ["fold"]).groupBy("__raw").agg(F.avg("p").alias("__cal"))
    out = scores.join(mean, scores.p == F.col("__raw"), "left")
    return out.select(*[F.col("__cal").alias("p") if c == "p" else F.col(f"`{c}`") for c in scores.columns])


def timeaware_calibration(val_scores: DataFrame, test_scores: DataFrame, k: int = 5,
                          method: str = "isotonic") -> tuple[DataFrame, DataFrame]:
    """K contiguous folds of the validation rows in (device, date) order, the first n mod k
    folds one row longer (as the source);
    each fold is calibrated by a map fitted on the other folds (out-of-fold scores), and test
    scores are the mean of the k calibrated versions."""
    folded = fold_rows(val_scores, k)
    if method == "isotonic":
        folded = materialize(folded, "folded")
        curves = calibration_curves(folded, k)
        return isotonic_apply(curves, folded, ["fold"]), mean_of_curves(curves, test_scores, k)
    oof, tests = [], []
    for f in range(k):
        fit_on = folded.where(F.col("fold") != f)
        oof.append(calibrate(fit_on, folded.where(F.col("fold") == f), method))
        tests.append(calibrate(fit_on, test_scores, method).withColumn("fold", F.lit(f)))
    val_cal = reduce(lambda a, b: a.unionByName(b), oof)
    test_all = reduce(lambda a, b: a.unionByName(b), tests)
    keys = [c for c in test_scores.columns if c != "p"]
    return val_cal, test_all.groupBy(*keys).agg(F.avg("p").alias("p"))


def ensemble_by_ap(val_scores: DataFrame, test_scores: DataFrame, name: str = "EnsembleAvg") -> DataFrame:
    """weights = validation AP + 1e-9 per model, normalised; the ensemble score is the
    weighted sum of the model scores per row (validation AP, not test AP: fixed on purpose)."""
    ap = sc.ranking_metrics(val_scores, group_cols=["model"]).select(
        "model", (F.coalesce(F.col("ap"), F.lit(0.0)) + 1e-9).alias("__w"))
    tot = ap.select(F.sum("__w")).scalar()
    j = test_scores.join(F.broadcast(ap), on="model")  # one row per model
    return j.groupBy(*KEYS, "y").agg((F.sum(F.col("p") * F.col("__w")) / tot).alias("p")) \
        .select(*KEYS, "y", "p", F.lit(name).alias("model"))


def fold_summary(scores: DataFrame, alert_quantile: float = 0.95) -> tuple[DataFrame, DataFrame]:
    """I7 reports of a score table (fold, y, p): per fold the cost, AP and recall at the fold's
    ``alert_quantile`` of its scores; and means, sample deviations and the fold of least cost."""
    at = sc.quantile_counts(scores, [alert_quantile], group_cols=["fold"]).select("fold", "cost", "recall")
    ap = sc.ranking_metrics(scores, group_cols=["fold"]).select("fold", F.coalesce("ap", F.lit(0.0)).alias("ap"))
    cv = at.join(ap, "fold").select("fold", "cost", "ap", "recall")
    summary = cv.agg(F.avg("cost").alias("mean_cost"), F.avg("ap").alias("mean_ap"),
                     F.avg("recall").alias("mean_recall"), F.stddev_samp("cost").alias("std_cost"),
                     F.stddev_samp("ap").alias("std_ap"), F.stddev_samp("recall").alias("std_recall"),
                     F.min_by("fold", F.struct("cost", "fold")).alias("best_fold"), F.min("cost").alias("best_cost"))
    return cv, summary


def rolling_origin_cv(features: DataFrame, target: str, n_splits: int = 3, purge_days: int = 7,
                      alert_quantile: float = 0.95, max_iter: int | None = None, seed: int = 42, k: int = 80,
                      num_trees: int = 50, chosen: dict | None = None) -> tuple[DataFrame, DataFrame]:
    """Per rolling-origin fold (G3) the medians, the ``k`` features (I2) and a boosted model are
    fitted on the fold's training rows alone; all folds' validation scores are written once and reported
    by ``fold_summary``.  ``chosen`` gets each fold's features."""
    folds = lb.rolling_origin_folds(features, n_splits, purge_days)
    feats = feature_columns(features, target)
    scored = []
    for f in range(1, n_splits + 1):
        tr = folds.where((F.col("fold") == f) & (F.col("split") == "train")).drop("fold", "split")
        va = folds.where((F.col("fold") == f) & (F.col("split") == "val")).drop("fold", "split")
        top = [r["feature"] for r in select_top_features(tr, feats, target, k, num_trees, seed).orderBy("rank").collect()]  # k names
        if chosen is not None:
            chosen[f] = top
        m = train_boosted(tr, top, target, "CV", max_iter=max_iter, weighted=False, seed=seed)
        scored.append(score(m, va, top, target, "cv").select(F.lit(f).alias("fold"), *KEYS, "y", "p"))
    return fold_summary(materialize(reduce(lambda a, b: a.unionByName(b), scored), "cv"), alert_quantile)


def tune_neg_per_pos(train: DataFrame, val: DataFrame, target: str, ratios=(6, 8, 10, 12, 15, 20),
                     min_precision: float = 0.0, max_iter: int | None = None, seed: int = 42) -> DataFrame:
    """I8: per negatives-per-positive ratio: undersample train (G5), fit a quick model, pick the
    validation threshold with K5, cost there (infinite when precision < ``min_precision``).
    Returns one row per ratio and ``best`` = 1 on the first lowest finite cost (none when all
    are infinite).  All ratios' scores are written once; thresholds and costs are worked out together."""
    feats = feature_columns(train, target)
    scored = []
    for i, r in enumerate(ratios):
        bal = lb.undersample(train, target, neg_per_pos=r, seed=seed).persist(StorageLevel.DISK_ONLY)   # drawn once for several fits
        m = train_boosted(bal, feats, target, "A", max_iter=max_iter, weighted=False, seed=seed, validation=val)
        scored.append(score(m, val, feats, target, "r").select("y", "p", F.lit(r).alias("neg_per_pos"), F.lit(i).alias("__i")))
        bal.unpersist()
    s = materialize(reduce(lambda a, b: a.unionByName(b), scored), "ratios")
    return ratio_report(s, min_precision)


def ratio_report(scores: DataFrame, min_precision: float = 0.0) -> DataFrame:
    """I8 report of a score table (neg_per_pos, __i its place in the list, y, p)."""
    g = ["neg_per_pos", "__i"]
    thr = sc.threshold_cost_or_budget(scores, group_cols=g).select(*g, "thr")
    pred = scores.join(F.broadcast(thr), g).select("*", F.coalesce(F.col("p") >= F.col("thr"), F.lit(False)).cast("int").alias("pred"))  # one row per ratio
    cm = sc.with_metrics(sc.confusion(pred, group_cols=[*g, "thr"]))
    out = cm.select(*g, "thr", "precision", F.when(F.col("precision") >= min_precision, F.col("cost").cast("double"))
                    .otherwise(F.lit(float("inf"))).alias("cost"))
    ranked = out.select("*", F.row_number().over(Window.orderBy("cost", "__i")).alias("__r"))  # one row per ratio
    return ranked.select("neg_per_pos", "thr", "precision", "cost",
                         ((F.col("__r") == 1) & (F.col("cost") < float("inf"))).cast("int").alias("best"))


def feature_importance(model: PipelineModel, feats: list[str], top_n: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Importance per feature (descending) with its family (B27), and the per-family mean
    importance and count (computed but never shown by the source; returned here)."""
    from pyspark.sql import SparkSession
    used = set(model.stages[0].getInputCols())
    feats = [c for c in feats if _safe(c) in used]
    imp = model.stages[-1].featureImportances.toArray().tolist()
    spark = SparkSession.getActiveSession()
    rows = sorted(zip(feats, imp), key=lambda r: (-r[1], r[0]))
    if top_n:
        rows = rows[:top_n]
    t = spark.createDataFrame([(f, float(v)) for f, v in rows], "feature string, importance double")
    t = t.select("*", feature_family("feature").alias("family"))
    fam = t.groupBy("family").agg(F.avg("importance").alias("mean_importance"),
                                  F.count(F.lit(1)).alias("n_features"))
    return t, fam


ENSEMBLE = "EnsembleAvg"


def threshold_chain(val: DataFrame, min_precision: float = 0.2, alert_budgets=(0.01, 0.015, 0.02, 0.03),
                    use_alert_budget: bool = True, ensemble: str = ENSEMBLE) -> DataFrame:
    """(model, threshold, budget, rule) from validation scores (model, y, p).

    With budgets: a model takes the budget of least cost that reaches ``min_precision`` (K4), else its
    highest threshold (K6 without a demand), whose alert rate is then its budget; the ensemble takes the
    budget of least cost (K2).  Without: the grid threshold of least cost (K3) and 0.01 for all."""
    if not use_alert_budget:
        k3 = sc.threshold_min_cost(val, group_cols=["model"])
        return k3.select("model", F.col("thr").alias("threshold"), F.lit(0.01).alias("budget"), F.lit("K3").alias("rule"))
    single, both = val.where(F.col("model") != ensemble), val.where(F.col("model") == ensemble)
    k4 = sc.tune_budget_min_precision(single, min_precision=min_precision, group_cols=["model"]).select(
        "model", F.col("threshold").alias("__t"), F.col("budget").alias("__b"))
    k6 = sc.threshold_min_precision(single, 0.0, group_cols=["model"])
    own = k6.join(k4, "model", "left").select("model", F.coalesce("__t", "thr").alias("threshold"), F.coalesce("__b", "alert_rate").alias("budget"),
                                              F.when(F.col("__t").isNotNull(), "K4").otherwise("K6").alias("rule"))
    k2 = sc.tune_alert_budget(both, alert_budgets, group_cols=["model"])
    return own.unionByName(k2.select("model", F.col("thr").alias("threshold"), "budget", F.lit("K2").alias("rule")))


def decided(scores: DataFrame, thresholds: DataFrame) -> DataFrame:
    """``scores`` with ``pred`` at each model's threshold (one row per model)."""
    t = thresholds.select("model", "threshold")
    return scores.join(F.broadcast(t), "model").select(*scores.columns, F.coalesce(F.col("p") >= F.col("threshold"), F.lit(False)).cast("int").alias("pred"))


def with_ensemble(scores: DataFrame, name: str = ENSEMBLE) -> DataFrame:
    """``scores`` (device, date, y, p, model, split) and, for every split, the rows of the ensemble whose
    weights are the validation APs."""
    val = scores.where(F.col("split") == "val")
    ap = sc.ranking_metrics(val, group_cols=["model"]).select("model", (F.coalesce(F.col("ap"), F.lit(0.0)) + 1e-9).alias("__w"))
    tot = ap.select(F.sum("__w")).scalar()
    both = (scores.join(F.broadcast(ap), "model").groupBy(*KEYS, "y", "split")          # one row per model
            .agg((F.sum(F.col("p") * F.col("__w")) / tot).alias("p")))
    return scores.unionByName(both.select(*KEYS, "y", "p", F.lit(name).alias("model"), "split"))


def evaluate_scores(scores: DataFrame, **chain) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(scores with pred, thresholds, test metrics) of a score table (device, date, y, p, model, split) with
    the splits val, hold and test: thresholds from val, predictions for every split."""
    thresholds = materialize(threshold_chain(scores.where(F.col("split") == "val"), **chain), "thresholds")
    pred = decided(scores, thresholds)
    test = pred.where(F.col("split") == "test")
    metrics = sc.business_metrics(test, group_cols=["model"]).join(
        sc.ranking_metrics(test, group_cols=["model"]).select("model", "auc"), "model").join(thresholds, "model")
    return pred, thresholds, metrics


def train_evaluate(table: DataFrame, feats: list[str], target: str, max_iter: int | None = None,
                   neg_per_pos: int = 50, seed: int = 42, folds: int = 5, models: dict | None = None,
                   **chain) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Hard-negative rebalancing (G6) of train, boosted models A and B stopped early on the
    validation rows, time-aware isotonic calibration (I5: out-of-fold on validation, the mean of the
    maps elsewhere), an ensemble weighted by validation AP (I6), the threshold chain on validation, and
    predictions for validation, hold-out and test.  Returns (scores with split and pred, thresholds,
    test metrics); ``models`` gets name -> (model, curves)."""
    rows = {"val": table.where(F.col("split") == "val_model"), "hold": table.where(F.col("split") == "val_hold"),
            "test": table.where(F.col("split") == "test")}
    bal = materialize(lb.undersample_hard_negatives(table.where(F.col("split") == "train"), target, neg_per_pos, seed), "balanced")
    out = []
    for name, variant in (("GBT_A", "A"), ("GBT_B", "B")):
        m = train_boosted(bal, feats, target, variant, max_iter=max_iter, weighted=False, seed=seed, validation=rows["val"])
        raw = {s: materialize(score(m, d, feats, target, name), "raw") for s, d in rows.items()}
        folded = materialize(fold_rows(raw["val"], folds), "folded")
        curves = calibration_curves(folded, folds)
        cal = {"val": isotonic_apply(curves, folded, ["fold"]), **{s: mean_of_curves(curves, raw[s], folds) for s in ("hold", "test")}}
        out += [d.select(*KEYS, "y", "p", "model", F.lit(s).alias("split")) for s, d in cal.items()]
        if models is not None:
            models[name] = m, curves
    scores = materialize(reduce(lambda a, b: a.unionByName(b), out), "scores")
    return evaluate_scores(materialize(with_ensemble(scores), "ensemble"), **chain)
