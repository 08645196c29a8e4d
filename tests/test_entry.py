import os
import sys

import duckdb

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as E  # noqa: E402
from gridwake.plans import catalog, duckdb_sql  # noqa: E402
from tools.oracle_check import compare  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_entry_runs(spark):
    df = E.entry(spark)
    assert set(df.columns) >= {"lat_idx", "lon_idx", "lat", "lon", "dt", "value", "velocity", "direction"}
    assert df.count() > 0


def test_every_query_has_sql():
    assert set(catalog.QUERIES) == set(duckdb_sql.build())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_oracle_small(spark):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW events AS SELECT * FROM read_parquet('{SF}/events.parquet')")
    sql = E.oracle_sql()
    for name in ("segments_consecutive", "crossings_all", "cell_stats", "bin_counts", "pipeline_mercator",
                 "temporal_buckets"):
        s = E.queries()[name](spark, SF).toPandas()
        o = con.sql(sql[name]).df()
        exact, close, note = compare(s, o)
        assert exact, f"{name}: {note}"
