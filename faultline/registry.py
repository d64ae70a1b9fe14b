"""Registry of named queries: Spark callable + DuckDB oracle text.

``@query(name, sql)`` registers ``fn(spark, sf_dir) -> DataFrame``.  The Spark result is
returned with float columns rounded to 6 dp; the oracle text is the shared fixture prefix plus
the body with the same rounding.  Which oracle columns are floating is derived from DuckDB's
own ``DESCRIBE`` of the body (cached in ``oracle_floats.json``).
"""

from __future__ import annotations

import json
import os
from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from faultline.functions.exprs import round_doubles

_FLOATS_FILE = os.path.join(os.path.dirname(__file__), "oracle_floats.json")
_SCHEMA_SF = os.environ.get("FAULTLINE_SCHEMA_SF_DIR", "/root/testdata/sf0.001")
_FLOAT_TYPES = ("DOUBLE", "FLOAT", "REAL")


@dataclass
class Entry:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def spark(self, spark: SparkSession, sf_dir: str) -> DataFrame:
        return round_doubles(self.fn(spark, sf_dir))


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Entry(name, fn, sql)
        return fn
    return deco


def load_all() -> dict[str, Entry]:
    # importing the catalog modules registers their queries
    from faultline.catalog import devices, events, models, offers, scoring, stats  # noqa: F401
    return REGISTRY


def _load_float_cache() -> dict:
    try:
        with open(_FLOATS_FILE) as f:
            return json.load(f)
    except (OSError, ValueError):
        return {}


def describe_floats(body: str, sf_dir: str = _SCHEMA_SF) -> dict:
    """Floating/decimal and date/time output columns of an oracle body (DuckDB DESCRIBE)."""
    import duckdb

    from faultline.oracle import PREFIX
    from faultline.sources.tables import TABLES
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    rows = con.execute(f"DESCRIBE {PREFIX} SELECT * FROM (\n{body}\n) AS q").fetchall()
    return {"float": [r[0] for r in rows if r[1] in _FLOAT_TYPES or r[1].startswith("DECIMAL")],
            "time": [r[0] for r in rows if r[1] in ("DATE", "TIMESTAMP", "TIMESTAMP_NS",
                                                     "TIMESTAMP WITH TIME ZONE")],
            "bigint": [r[0] for r in rows if r[1] in ("HUGEINT", "UHUGEINT", "UBIGINT")]}


def oracle_texts() -> dict[str, str]:
    from faultline.oracle import wrap
    cache = _load_float_cache()
    out = {}
    for name, e in load_all().items():
        if e.sql is None:
            continue
        kinds = cache.get(name)
        if kinds is None or cache.get(f"{name}#sql") != hash_text(e.sql):
            kinds = describe_floats(e.sql)             # an oracle that DuckDB cannot bind is an error
        out[name] = wrap(e.sql, kinds["float"], kinds["time"], kinds.get("bigint", []))
    return out


def hash_text(s: str) -> str:
    import hashlib
    return hashlib.sha1(s.encode()).hexdigest()


def refresh_float_cache() -> dict:
    cache = {}
    for name, e in load_all().items():
        if e.sql is not None:
            cache[name] = describe_floats(e.sql)
            cache[f"{name}#sql"] = hash_text(e.sql)
    with open(_FLOATS_FILE, "w") as f:
        json.dump(cache, f, indent=0, sort_keys=True)
    return cache
