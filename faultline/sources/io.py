"""Loaders and sinks.

Readers take an explicit schema (no inference pass over 100 TB) and coerce unparseable values
to NULL with ``try_*`` functions instead of failing the job.  Sinks write partitioned,
self-describing outputs (parquet / JSON) and Spark ML's native model format.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.operators.offers import DATE_COLS, NUMERIC_COLS
from faultline.operators.profiling import dedup_readings

READINGS_SCHEMA = ("device string, date string, "
                   + ", ".join(f"attribute{i} string" for i in range(1, 10)) + ", failure string")
OFFERS_SCHEMA = ("OFFER_START_DATE string, OFFER_START_DTTM string, OFFER_FINISH_DTTM string, "
                 "OFFER_TYPE string, VERTICAL string, DOMAIN_ID string, DOM_DOMAIN_AGG1 string, "
                 "SHIPPING_PAYMENT_TYPE string, ORIGIN string, INVOLVED_STOCK string, "
                 "REMAINING_STOCK_AFTER_END string, SOLD_AMOUNT string, SOLD_QUANTITY string")


# fixed values: the byte sequences that spell one character beyond ASCII in UTF-8
_UTF8 = (r"[\xC2-\xDF][\x80-\xBF]|\xE0[\xA0-\xBF][\x80-\xBF]|[\xE1-\xEC\xEE\xEF][\x80-\xBF]{2}|\xED[\x80-\x9F][\x80-\xBF]"
         r"|\xF0[\x90-\xBF][\x80-\xBF]{2}|[\xF1-\xF3][\x80-\xBF]{3}|\xF4[\x80-\x8F][\x80-\xBF]{2}")
CORRUPT = "_corrupt_record"


def _read(spark: SparkSession, path: str, fmt: str, schema: str | None, encoding: str = "UTF-8", prune: bool = True) -> DataFrame:
    """``prune=False``: rows are parsed whole, as only then the number of their fields is seen."""
    if fmt == "csv":
        r = spark.read.option("header", True).option("mode", "PERMISSIVE").option("encoding", encoding).option("columnPruning", prune)
        r = r.option("columnNameOfCorruptRecord", CORRUPT)
        return r.schema(schema).csv(path) if schema else r.csv(path)
    return spark.read.format(fmt).load(path)


def utf8_text(column):
    """The text of a column that holds one character a byte (ISO-8859-1): bytes that are no UTF-8 are
    dropped, where Spark's reader would put replacement characters."""
    kept = F.regexp_replace(column, f"({_UTF8})|[\\x80-\\xFF]", "$1")
    return F.when(column.rlike("[\\x80-\\xFF]"), F.decode(F.encode(kept, "ISO-8859-1"), "UTF-8")).otherwise(column)


def _number(column: str):
    """A column as double; text that is no number and NaN become NULL."""
    x = F.col(f"`{column}`").cast("string").try_cast("double")
    return F.when(~F.isnan(x), x)


def _parsed_readings(spark: SparkSession, path: str, fmt: str, prune: bool = True) -> DataFrame:
    """Readings as typed columns, one row per row of the files, with the reader's corrupt-record text."""
    if fmt == "csv":
        df = _read(spark, path, fmt, f"{READINGS_SCHEMA}, {CORRUPT} string", "ISO-8859-1", prune)
        text = {c: utf8_text(F.col(c)) for c in ("device", "date")}
    else:
        df = _read(spark, path, fmt, None).withColumn(CORRUPT, F.lit(None).cast("string"))
        text = {c: F.col(c).cast("string") for c in ("device", "date")}
    attrs = [c for c in df.columns if c.startswith("attribute")]
    return df.select(text["device"].alias("device"), F.try_to_timestamp(text["date"]).cast("date").alias("date"),
                     *[_number(a).alias(a) for a in attrs], _number("failure").try_cast("int").alias("failure"),
                     F.col(CORRUPT))


def load_device_readings(spark: SparkSession, path: str, fmt: str = "csv",
                         tie_break: list[str] | None = None) -> DataFrame:
    """A1: read readings, drop bytes that are no UTF-8, parse ``date``, coerce attributes and failure to
    numbers (bad values -> NULL), drop rows without device or date and duplicate (device, date),
    keeping the first by ``tie_break``.  ``readings_report`` counts what is left out."""
    out = _parsed_readings(spark, path, fmt).drop(CORRUPT)
    return dedup_readings(out.where(F.col("device").isNotNull() & F.col("date").isNotNull()), tie_break)


def readings_report(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A1, what the loader left out: rows read, rows whose number of fields is wrong, rows without device,
    rows without a date that can be read, repeated (device, date) rows, and rows kept (one row)."""
    rows = _parsed_readings(spark, path, fmt, prune=False)
    good = F.col("device").isNotNull() & F.col("date").isNotNull()

    def n(c):
        return F.coalesce(F.sum(F.when(c, F.col("n")).otherwise(0)), F.lit(0)).cast("long")
    cells = rows.groupBy("device", "date", F.col(CORRUPT).isNotNull().alias("corrupt")).agg(F.count(F.lit(1)).alias("n"))
    one = cells.agg(n(F.lit(True)).alias("rows_read"), n(F.col("corrupt")).alias("rows_corrupt"), n(F.col("device").isNull()).alias("rows_without_device"),
                    n(F.col("device").isNotNull() & F.col("date").isNull()).alias("rows_without_date"), n(good).alias("__good"))
    kept = cells.where(good).select("device", "date").distinct().select(F.count(F.lit(1))).scalar()
    return one.select("rows_read", "rows_corrupt", "rows_without_device", "rows_without_date",
                      (F.col("__good") - kept).alias("rows_repeated"), kept.alias("rows_kept"))


def coerce_types(df: DataFrame, date_cols=tuple(DATE_COLS), num_cols=tuple(NUMERIC_COLS)) -> DataFrame:
    """A3: unparseable dates / numbers -> NULL; columns absent from ``df`` are skipped."""
    have = set(df.columns)
    rep = {}
    for c in date_cols:
        if c in have:
            rep[c] = F.try_to_timestamp(F.col(c).cast("string")).alias(c)
    for c in num_cols:
        if c in have:
            rep[c] = _number(c).alias(c)
    return df.select(*[rep.get(c, F.col(f"`{c}`")) for c in df.columns])


def negative_remaining(df: DataFrame) -> DataFrame:
    """A3: number of negative REMAINING_STOCK_AFTER_END values (overselling in the raw data)."""
    return df.agg(F.sum(F.when(F.col("REMAINING_STOCK_AFTER_END") < 0, 1).otherwise(0)).alias("n_negative"))


def load_offers(spark: SparkSession, path: str, fmt: str = "csv") -> DataFrame:
    """A2: read the offers table with a declared schema, then A3 coercion."""
    return coerce_types(_read(spark, path, fmt, OFFERS_SCHEMA if fmt == "csv" else None))


def save_metrics(metrics: DataFrame, path: str, run_id: str | None = None, fmt: str = "json") -> str:
    """A4: append a metrics table under ``run_id=<timestamp>`` (numeric types kept)."""
    rid = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    metrics.withColumn("run_id", F.lit(rid)).write.mode("append").partitionBy("run_id").format(fmt).save(path)
    return rid


def load_metrics(spark: SparkSession, path: str, run_id: str | None = None, fmt: str = "json") -> DataFrame:
    """Read saved metrics (one run or all)."""
    df = spark.read.format(fmt).load(path)
    return df.where(F.col("run_id") == run_id) if run_id else df


def save_run(spark: SparkSession, path: str, best: DataFrame, evaluation: DataFrame, features: list[str],
             cv: DataFrame | None = None, cv_summary: DataFrame | None = None, suspicious: int = 0,
             model_path: str | None = None, model_name: str = "device_failure_model", run_id: str | None = None) -> str:
    """A4: the two reports of a run as JSON under ``metrics/`` and ``executive/`` of ``path``, by run_id.

    ``best``: one row (model, auc, ap, precision, recall, f1, cost, threshold, metrics_source);
    ``evaluation``: the final test figures of that model (one row); ``cv``: one row per fold.  Missing
    figures are 0, a missing threshold 0.5, a missing source "unknown"."""
    rid = run_id or _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S")
    have = set(best.columns)

    def figure(c, default):
        return F.coalesce(F.col(c).cast("double"), F.lit(default)).alias(c) if c in have else F.lit(default).alias(c)
    summary = F.struct(*[figure(c, 0.0) for c in ("auc", "ap", "precision", "recall", "f1", "cost")], figure("threshold", 0.5),
                       (F.coalesce("metrics_source", F.lit("unknown")) if "metrics_source" in have else F.lit("unknown")).alias("metrics_source"),
                       F.lit(len(features)).alias("total_features"), F.lit(suspicious).alias("suspicious_features"))
    tested = evaluation.select(F.struct(*[F.col(f"`{c}`") for c in evaluation.columns])).limit(1).scalar()
    common = best.limit(1).select(F.lit(rid).alias("run_id"), F.lit(model_name).alias("model_name"), F.col("model").alias("best_model"),
                                  summary.alias("performance_summary"), tested.alias("final_test_results"))
    extra = [F.array(*[F.lit(f) for f in features]).cast("array<string>").alias("selected_features")]
    if cv is not None:                                   # one row per fold
        extra.append(cv.agg(F.array_sort(F.collect_list(F.struct(*cv.columns)))).scalar().alias("cv_results"))
    if cv_summary is not None:
        extra.append(cv_summary.select(F.struct(*cv_summary.columns)).limit(1).scalar().alias("cv_summary"))
    common.select("*", *extra).write.mode("append").partitionBy("run_id").json(f"{path}/metrics")
    places = F.struct(F.lit(model_path).cast("string").alias("model"), F.lit(f"{path}/metrics/run_id={rid}").alias("metrics"))
    common.select("*", places.alias("file_paths")).write.mode("append").partitionBy("run_id").json(f"{path}/executive")
    return rid


def load_executive(spark: SparkSession, path: str, run_id: str | None = None) -> DataFrame:
    """Saved executive summaries, the figures as columns."""
    df = spark.read.json(f"{path}/executive")
    df = df.where(F.col("run_id") == run_id) if run_id else df
    return df.select("run_id", "model_name", "best_model", "performance_summary.*", "file_paths")


# ---------------------------------------------------------------------------- model bundles
@dataclass
class Member:
    """A model of a bundle: its pipeline, the blocks of its calibration curves (I5), its decision
    threshold and its weight in the ensemble (NULL outside one)."""
    model: PipelineModel
    threshold: float
    curves: DataFrame | None = None
    folds: int = 0
    weight: float | None = None


@dataclass
class Bundle:
    name: str
    features: list[str]
    members: dict[str, Member]
    threshold: float
    target: str = "early_warn_target"

    def score(self, df: DataFrame) -> DataFrame:
        """(device, date, y, p, model, pred) of the named model or ensemble: every member's calibrated
        scores, weighted, against the bundle's threshold."""
        from faultline.operators import ml
        out = None
        for name, m in self.members.items():
            s = ml.score(m.model, df, self.features, self.target, name)
            s = ml.mean_of_curves(m.curves, s, m.folds) if m.curves is not None else s
            s = s.withColumn("__w", F.lit(1.0 if m.weight is None else m.weight))
            out = s if out is None else out.unionByName(s)
        both = out.groupBy("device", "date", "y").agg((F.sum(F.col("p") * F.col("__w")) / F.sum("__w")).alias("p"))
        return both.select("device", "date", "y", "p", F.lit(self.name).alias("model"),
                           F.coalesce(F.col("p") >= self.threshold, F.lit(False)).cast("int").alias("pred"))


def save_bundle(spark: SparkSession, bundle: Bundle, path: str) -> str:
    """A5: the models and curves of a bundle under a new version folder of ``path``/name, then the
    manifest (one JSON row: name, version, features, members, thresholds, weights).  The manifest is
    written last: a bundle whose saving failed has none, and readers keep the version before."""
    version = _dt.datetime.now(_dt.timezone.utc).strftime("%Y%m%d_%H%M%S_%f")
    base = f"{path}/{bundle.name}/{version}"
    for name, m in bundle.members.items():
        m.model.write().save(f"{base}/{name}/model")
        if m.curves is not None:
            m.curves.write.parquet(f"{base}/{name}/curves")
    manifest = {"name": bundle.name, "version": version, "features": bundle.features, "threshold": bundle.threshold, "target": bundle.target,
                "members": [{"name": k, "threshold": m.threshold, "weight": m.weight, "folds": m.folds, "curves": m.curves is not None}
                            for k, m in bundle.members.items()]}
    spark.createDataFrame([(bundle.name, version, json.dumps(manifest))], "name string, version string, manifest string") \
        .coalesce(1).write.mode("append").json(f"{path}/manifests")
    return version


def load_bundle(spark: SparkSession, path: str, name: str, version: str | None = None) -> Bundle:
    """A bundle by name, the latest version unless one is named."""
    rows = spark.read.schema("name string, version string, manifest string").json(f"{path}/manifests").where(F.col("name") == name)
    rows = rows.where(F.col("version") == version) if version else rows
    row = rows.orderBy(F.desc("version")).first()
    if row is None:
        raise KeyError(f"no model {name} in {path}")
    m = json.loads(row["manifest"])
    base = f"{path}/{name}/{m['version']}"
    members = {x["name"]: Member(PipelineModel.load(f"{base}/{x['name']}/model"), x["threshold"],
                                 spark.read.parquet(f"{base}/{x['name']}/curves") if x["curves"] else None, x["folds"], x["weight"])
               for x in m["members"]}
    return Bundle(m["name"], m["features"], members, m["threshold"], m["target"])


def save_model(model: PipelineModel, path: str, meta: dict) -> None:
    """A5: Spark ML model in its native format plus a one-row metadata table (threshold,
    feature names, model type, ...)."""
    model.write().overwrite().save(f"{path}/model")
    spark = SparkSession.getActiveSession()
    spark.createDataFrame([(json.dumps(meta, default=str),)], "meta string") \
        .write.mode("overwrite").json(f"{path}/meta")


def load_model(path: str) -> tuple[PipelineModel, dict]:
    """Model and its metadata."""
    spark = SparkSession.getActiveSession()
    meta = json.loads(spark.read.json(f"{path}/meta").first()["meta"])
    return PipelineModel.load(f"{path}/model"), meta
