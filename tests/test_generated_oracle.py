"""Every registered job on generated tables, checked by the same SQL.

The generators give a different distribution from the driver tables:
friend ids that have no people row, duplicate friend pairs, twenty years of
access times, many seating tables. The oracle statements are reused with
their table definitions swapped for the generated parquet folders.
"""

import hashlib
import math
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from tidepool.plans import catalog, oracle
from tidepool.plans import synth as G
from tidepool.sources import tables as V
from tidepool.plans import params as P

NAMES = ("people", "friends", "access_log", "attendees", "points")


@pytest.fixture(scope="module")
def generated(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("generated"))
    frames = {
        "people": G.gen_people(spark, 400),
        "friends": G.gen_friends(spark, 400, 8000, dangling=True),
        "access_log": G.gen_access_log(spark, 400, 6000),
        "attendees": G.gen_attendees(spark, 4000, tables=60, p_sick=0.02),
        "points": G.gen_points(spark, 3000, 0, 60),
    }
    for name, df in frames.items():
        df.write.parquet(f"{base}/{name}")
    return base


def _tables(spark, base):
    loaders = {name: (lambda n=name: spark.read.parquet(f"{base}/{n}")) for name in NAMES}
    loaders["no_disclosure"] = lambda: loaders["attendees"]().drop("test")
    loaders["reports"] = lambda: loaders["attendees"]().where(F.col("test") == "sick") \
        .select("id", "test")
    loaders["access_log_text"] = lambda: loaders["access_log"]().select(F.col("what_page").cast("string").alias("what_page"))
    loaders["access_log_unowned"] = lambda: loaders["access_log"]().withColumn(
        "what_page", F.when(F.col("what_page") % 5 == 0, -F.col("what_page") - 1).otherwise(F.col("what_page")))
    loaders["access_log_lines"] = lambda: V.lines_of(loaders["access_log"]())
    loaders["seeds"] = lambda: V.seeds(spark, P.SEEDS)
    return lambda name: loaders[name]()


def _views(base):
    views = {n: f"{n} AS (SELECT * FROM read_parquet('{base}/{n}/*.parquet'))" for n in NAMES}
    views["access_log_text"] = "access_log_text AS (SELECT CAST(what_page AS VARCHAR) AS what_page " \
        f"FROM read_parquet('{base}/access_log/*.parquet'))"
    views["access_log_unowned"] = oracle.VIEWS["access_log_unowned"]
    views["access_log_lines"] = oracle.VIEWS["access_log_lines"]
    views["reports"] = "reports AS (SELECT id, test FROM attendees WHERE test = 'sick')"
    return views


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


@pytest.mark.parametrize("name", sorted(catalog.JOBS))
def test_job_on_generated_tables(spark, generated, name):
    df = catalog.bind(catalog.JOBS[name], _tables(spark, generated))
    got = [tuple(r) for r in df.collect()]
    cur = duckdb.connect().execute(oracle.all_sql(_views(generated))[name])
    want = cur.fetchall()
    assert len(got) == len(want)
    assert _digest(df.columns, got) == _digest([d[0] for d in cur.description], want)


def test_generated_data_has_the_awkward_cases(spark, generated):
    t = _tables(spark, generated)
    friends = t("friends")
    assert friends.where("my_friend = 400 OR person_id = 400").count() > 0  # dangling id
    pairs = friends.groupBy("person_id", "my_friend").count()
    assert pairs.where("count > 1").count() > 0                         # duplicate pairs
    assert os.path.isdir(f"{generated}/points")
