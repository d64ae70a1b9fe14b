"""Query catalog: each module registers Spark queries with their DuckDB oracle."""
