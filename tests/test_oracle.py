"""Every registered query against its DuckDB oracle on the smallest tables."""

import hashlib
import math
import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import SF_SMALL
from tidepool.plans import catalog

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v)
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return str(v)


def _digest(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    lines = sorted("|".join(_norm(r[i]) for i in order) for r in rows)
    return [cols[i] for i in order], hashlib.sha256("\n".join(lines).encode()).hexdigest()


def test_every_query_has_an_oracle():
    assert set(catalog.queries()) <= set(E.oracle_sql())
    assert set(catalog.queries()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["page_id", "name", "nationality"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(catalog.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    want = cur.fetchall()
    ocols = [d[0] for d in cur.description]
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest(ocols, want)


def test_the_harder_branches_are_reached(spark):
    q = catalog.queries()
    outer = q["top_pages_details_outer"](spark, SF_SMALL).collect()
    assert {r["name"] == "Unknown" for r in outer} == {True, False}
    from tidepool.sources import tables as V
    assert V.reports(spark, SF_SMALL).select("test").distinct().count() == 2
    assert q["healthy_at_risk"](spark, SF_SMALL).count() != q["healthy_at_sick_table"](spark, SF_SMALL).count()
    assert all(r["converged"] for r in q["kmeans_early_stop"](spark, SF_SMALL).collect())
