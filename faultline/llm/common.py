"""Helpers shared by the operators of this package."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from faultline.session import ensure_checkpoint_dir

#: A word is a run of characters other than the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"

_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def folded_words(text: str | None) -> list[bytes]:
    """Words of a text as UTF-8 with A-Z lower-cased; a null text has none.

    ``bytes.split()`` splits on exactly the white space that ``WORD`` excludes.
    """
    return [] if text is None else text.encode().translate(_FOLD).split()


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name under the cluster's shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: the lineage is cut there."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def join_on_small(df: DataFrame, small: DataFrame, on, how: str = "inner",
                  rows: int = 100_000) -> DataFrame:
    """Join with a side whose size is counted first: broadcast up to ``rows`` rows, beyond that
    a shuffled join whose skewed keys Spark splits.  Both give the same rows."""
    return df.join(F.broadcast(small) if small.count() <= rows else small, on, how)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    """Where an installed public vocabulary file lies; queries take another path as a parameter."""
    import public_tokenizers
    return public_tokenizers.path(name)


def worker_memory(kind: str, key, make):
    """``make()``, kept by the Python worker process for its later tasks; of each kind the one made last
    stays.  What is kept bounds its own size."""
    import sys
    import types
    held = sys.modules.setdefault("faultline_worker_memory", types.ModuleType("faultline_worker_memory")).__dict__
    if kind not in held or held[kind][0] != key:
        held.pop(kind, None)
        held[kind] = key, make()
    return held[kind][1]


def spread(files: DataFrame, total_bytes: int, task_bytes: int = 128 << 20) -> DataFrame:
    """Rows that name files, dealt to tasks that read about ``task_bytes`` each, and to as many tasks as
    the cluster runs at once where there is less.  The count is explicit: Spark would put so few small
    rows into one task, which then reads every file."""
    n = max(files.sparkSession.sparkContext.defaultParallelism, -(-total_bytes // task_bytes))
    return files.repartition(n)


def open_folder(uri: str):
    """(filesystem, path) of a folder that all executors share; any store that pyarrow reaches."""
    import re

    from pyarrow import fs
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def put_file(folder: str, name: str, data: bytes) -> None:
    """Write a file under its final name in one step.  A task that runs again writes the same
    bytes under the same name; readers never see a part of a file."""
    store, base = open_folder(folder)
    store.create_dir(base, recursive=True)
    draft = f"{base}/.{name}.{uuid.uuid4().hex}"
    with store.open_output_stream(draft, compression=None) as out:
        out.write(data)
    store.move(draft, f"{base}/{name}")
