"""Every registered query against its DuckDB oracle on the sf0.01 tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as entry  # noqa: E402
from check_oracle import TABLES, rows_of  # noqa: E402

from conftest import SF01  # noqa: E402

SQL = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF01)
    cur = con.execute(SQL[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(dcols, cur.fetchall())


CLOSE = ["hourly_congestion", "daily_index", "heatmap", "weekly_summary_lineitem", "block_activity", "daily_volume_lineitem",
         "event_vs_month", "kpi_row", "feature_table", "regressor_cv", "fit_standard_scaler"]


@pytest.mark.parametrize("name", CLOSE)
def test_doubles_agree_to_1e9(spark, con, name, monkeypatch):
    """The same queries in double precision, relative difference below 1e-9."""
    from feescope.plans import registry

    monkeypatch.setattr(registry, "COMPARE_AS", "double")
    df = entry.queries()[name](spark, SF01)
    cur = con.execute(SQL[name].replace("AS FLOAT)", "AS DOUBLE)"))
    dcols = [d[0] for d in cur.description]
    at = [dcols.index(c) for c in df.columns]
    doubles = [i for i, t in enumerate(df.dtypes) if t[1] == "double"]

    def ordered(rows):  # by everything that is no double; those are keys in these queries
        return sorted(rows, key=lambda r: [str(v) for i, v in enumerate(r) if i not in doubles])

    ours = ordered(tuple(r) for r in df.collect())
    theirs = ordered(tuple(r[i] for i in at) for r in cur.fetchall())
    assert len(ours) == len(theirs)
    for a, b in zip(ours, theirs):
        for i in doubles:
            assert a[i] == b[i] or a[i] == pytest.approx(b[i], rel=1e-9, abs=1e-12), (name, df.columns[i], a, b)


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.columns[0] == "hour_of_day" and df.count() > 0
