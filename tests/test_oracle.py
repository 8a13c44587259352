"""Every registered query against its SQL twin in DuckDB (sf0.001)."""

import hashlib
import math

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from claimlens.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if v is None or str(v) == "<NA>" or (isinstance(v, float) and math.isnan(v)):
        return "<null>"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):  # a nullable integer may read back as a float
        return str(int(v)) if v.is_integer() else repr(round(v, 6))
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def _hash(df):
    cols = sorted(df.columns)
    rows = sorted("|".join(_norm(r[c]) for c in cols) for r in df.to_dict("records"))
    return hashlib.sha256("\n".join(rows).encode()).hexdigest()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_every_query_has_a_twin_but_the_forest():
    from claimlens.plans.catalogue import QUERIES
    from claimlens.plans.incremental import INCREMENTAL

    assert (set(QUERIES) | set(INCREMENTAL)) - set(oracle_sql()) == {"forest_scores"}
    assert set(oracle_sql()) <= set(queries())


def test_entry_runs(spark):
    rows = entry(spark).collect()
    assert len(rows) == 25
    assert sum(r.is_quality_concern for r in rows) >= 1


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = queries()[name](spark, SF).toPandas()
    want = con.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert _hash(got) == _hash(want)
