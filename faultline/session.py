"""Session construction and lineage-cutting helpers."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: ANSI-safe arithmetic is handled in expressions, AQE
# re-plans shuffles at runtime (partition coalescing + skew-join splitting), and
# timestamps are zone-less so a UTC session keeps calendar maths stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


#: Scratch folders of local sessions without a folder of their own, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def get_session(master: str | None = None, app: str = "faultline",
                shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; ``shuffle_partitions``
    should be sized so one shuffle partition holds ~128-256 MB at the target scale.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster this setting names shared storage and is always honoured; a folder of one
    machine would lose rows there, so an unset setting is an error.  Only a session whose
    executors are threads of the driver (local tests) gets a scratch folder.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"spark.checkpoint.dir is not set: master {master} needs a folder that all executors share")
        # the setting is fixed once a session runs, so the folder is remembered beside it
        d = _LOCAL_FOLDERS.setdefault(spark.sparkContext.applicationId, "") or tempfile.mkdtemp(prefix="faultline-ckpt-")
        _LOCAL_FOLDERS[spark.sparkContext.applicationId] = d
    spark.sparkContext.setCheckpointDir(d)
    return d


def materialize(df: DataFrame, name: str, options: dict[str, str] | None = None) -> DataFrame:
    """Cut lineage by writing ``df`` as parquet under the shared checkpoint folder.

    Unlike ``cache`` this survives executor loss, and unlike ``localCheckpoint`` it does not
    pin blocks to one machine.  Used for outputs that several later jobs reuse (device features).
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    df.write.mode("overwrite").options(**(options or {})).parquet(path)
    return spark.read.parquet(path)
