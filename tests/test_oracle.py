"""Every registered query equals its DuckDB oracle (rows, columns, values)."""

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from compare import duck, rows  # noqa: E402

from demandlake.oracle import ORACLE_SQL  # noqa: E402
from demandlake.queries import QUERIES, ROWS_ONLY  # noqa: E402

import pandas as pd  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return duck(sf_dir)


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE_SQL) - ROWS_ONLY)
    assert missing == []


#: The whole grids take minutes; tests/test_training.py fits configurations of each kind, tests/test_boosting.py the ensembles.
WHOLE_GRIDS = {"stage1_search", "stage2_search"}


@pytest.mark.parametrize("name", sorted(ROWS_ONLY - WHOLE_GRIDS))
def test_rows_only_queries(spark, sf_dir, name):
    df = QUERIES[name](spark, sf_dir)
    rows = df.collect()
    assert len(rows) >= 2
    assert {"model", "run_name", "feature"} & set(df.columns)


@pytest.mark.parametrize("name", sorted(set(QUERIES) - ROWS_ONLY))
def test_query_matches_oracle(spark, con, sf_dir, name):
    sdf = QUERIES[name](spark, sf_dir)
    spd = pd.DataFrame([r.asDict(recursive=True) for r in sdf.collect()], columns=sdf.columns)
    cur = con.execute(ORACLE_SQL[name])
    dpd = pd.DataFrame(cur.fetchall(), columns=[d[0] for d in cur.description])
    sc, sr = rows(spd)
    dc, dr = rows(dpd)
    assert sc == dc
    assert len(sr) == len(dr)
    assert sr == dr


def test_entry_smoke(spark):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    assert set(ORACLE_SQL) & set(QUERIES) <= set(E.oracle_sql()) and set(QUERIES) <= set(E.queries())


def test_every_oracle_binds_in_duckdb():
    """Each oracle statement parses and binds (EXPLAIN) against the tables."""
    con = duck("/root/testdata/sf0.001")
    for name, sql in ORACLE_SQL.items():
        con.execute("EXPLAIN " + sql)
    assert set(ORACLE_SQL) <= set(QUERIES)
