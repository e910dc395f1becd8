"""Generators are deterministic, distributed and reproducible in DuckDB."""

import duckdb

from conftest import rows
from tidepool.plans import synth as G


def test_hash_matches_duckdb(spark):
    from pyspark.sql import functions as F
    got = [r[0] for r in spark.range(0, 2000, 7).select(G.mix(F.col("id"), 5)).collect()]
    want = [r[0] for r in duckdb.sql(
        f"SELECT {G.mix_sql('range', 5)} FROM range(0, 2000, 7) ORDER BY range").fetchall()]
    assert got == want


def test_points_reproducible_and_in_range(spark):
    a = rows(G.gen_points(spark, 500, 0, 50))
    b = rows(G.gen_points(spark, 500, 0, 50).repartition(7))
    assert a == b and len(a) == 500
    assert all(0 <= x <= 50 and 0 <= y <= 50 for x, y in a)
    want = sorted(duckdb.sql(
        f"SELECT 0 + {G.mix_sql('range', 31)} % 51, 0 + {G.mix_sql('range', 32)} % 51 "
        "FROM range(500)").fetchall())
    assert a == want


def test_friends_distinct_endpoints_and_dangling(spark):
    f = G.gen_friends(spark, 20, 2000)
    got = rows(f, "person_id", "my_friend", "descr")
    assert all(p != q and 0 <= p < 20 and 0 <= q < 20 for p, q, _ in got)
    assert {d for _, _, d in got} <= set(G.RELATIONSHIP_TYPES)
    d = rows(G.gen_friends(spark, 20, 2000, dangling=True), "person_id", "my_friend")
    assert max(max(p, q) for p, q in d) == 20


def test_access_log_no_self_access(spark):
    got = rows(G.gen_access_log(spark, 30, 1000), "by_who", "what_page", "type_of_access")
    assert all(b != p for b, p, _ in got)
    assert {t for _, _, t in got} <= set(G.ACCESS_TYPES)


def test_people_codes_and_attendees(spark):
    p = rows(G.gen_people(spark, 300), "country_code")
    assert all(1 <= c <= 50 for (c,) in p)
    att = G.gen_attendees(spark, 20000, tables=50, p_sick=0.01)
    stats = att.groupBy().agg({"table": "max", "id": "count"}).collect()[0]
    assert stats["count(id)"] == 20000 and stats["max(table)"] == 50
    sick = att.where("test = 'sick'").count()
    assert 100 < sick < 320
    t = G.event_tables(att)
    assert t["reported_illnesses"].count() == sick
    assert t["mega_event_no_disclosure"].columns == ["id", "name", "table"]


def test_seeds(spark):
    s = rows(G.gen_seeds(spark, 3))
    assert [r[0] for r in s] == [0, 1, 2]
    assert all(0 <= r[1] <= 7000 for r in s)
