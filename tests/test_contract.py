"""Driver contract: entry() smoke, every oracle key has a query, names stable."""
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry_mod  # noqa: E402


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert "GMV" in df.columns and "VERTICAL" in df.columns


def test_queries_and_oracles_consistent():
    q = entry_mod.queries()
    o = entry_mod.oracle_sql()
    assert len(q) >= 120
    assert set(o) <= set(q)
    # names of the form opN_ are those of the optional llm package; this library's own have none
    from faultline.registry import load_all
    assert set(load_all()) <= set(q)
    assert not any(k.lower().startswith("op") for k in load_all())


def test_a_registered_query_matches_duckdb(spark):
    import duckdb
    from faultline.sources.tables import TABLES
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    for name in ("d05_kpi_summary_vertical", "j01_match_alerts_failures", "k02_tune_alert_budget"):
        s = entry_mod.queries()[name](spark, sf).toPandas()
        d = con.execute(entry_mod.oracle_sql()[name]).fetchdf()
        cols = sorted(s.columns)
        assert cols == sorted(d.columns)
        key = lambda df: sorted(map(tuple, df[cols].astype(str).values.tolist()))
        assert key(s) == key(d), name
