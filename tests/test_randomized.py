"""Randomised checks against plain-Python statements of the rules."""

import math

from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import rows
from tidepool.plans import health as H
from tidepool.plans import kmeans as M
from tidepool.plans import social as D

SETTINGS = settings(max_examples=8, deadline=None, derandomize=True)

pairs = st.lists(st.tuples(st.integers(0, 6), st.integers(0, 6)), min_size=0, max_size=40)


@SETTINGS
@given(friend_pairs=pairs, access_pairs=pairs)
def test_never_accessed_is_set_difference(spark, friend_pairs, access_pairs):
    f = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(friend_pairs)],
                              "friend_rel BIGINT, person_id BIGINT, my_friend BIGINT")
    log = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(access_pairs)],
                                "access_id BIGINT, by_who BIGINT, what_page BIGINT")
    got = {(r[0], r[1]) for r in D.friends_never_accessed(f, log).collect()}
    assert got == set(friend_pairs) - set(access_pairs)


seats = st.lists(st.tuples(st.integers(1, 5), st.sampled_from(["sick", "not-sick", "other"])),
                 min_size=1, max_size=40)


@SETTINGS
@given(seating=seats)
def test_health_jobs_match_python(spark, seating):
    att = spark.createDataFrame([(i, f"P{i}", t, s) for i, (t, s) in enumerate(seating)],
                                "id BIGINT, name STRING, table BIGINT, test STRING")
    sick_tables = {t for t, s in seating if s == "sick"}
    e3 = {(i, f"P{i}") for i, (t, s) in enumerate(seating) if s == "not-sick" and t in sick_tables}
    assert set(map(tuple, rows(H.healthy_at_sick_table(att)))) == e3
    flags = {}
    for t, s in seating:
        n, ok = flags.get(t, (0, True))
        flags[t] = (n + 1, ok and s == "not-sick")
    want = sorted((t, n, "healthy" if ok else "concern") for t, (n, ok) in flags.items())
    assert rows(H.table_health(att)) == want
    reports = att.where("test = 'sick'").select("id", "test")
    e5 = {(i, f"P{i}", t) for i, (t, s) in enumerate(seating) if s != "sick" and t in sick_tables}
    assert set(map(tuple, rows(H.healthy_at_risk(att.drop("test"), reports)))) == e5


points = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=60)
seeds = st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), min_size=1, max_size=4)


def _brute(pts, cs, steps, tol):
    cur = [(i, float(x), float(y)) for i, (x, y) in enumerate(cs)]
    for i in range(steps):
        acc = {}
        for x, y in pts:
            best = min(cur, key=lambda c: (math.sqrt((x - c[1]) * (x - c[1])
                                                     + (y - c[2]) * (y - c[2])), c[0]))
            a = acc.setdefault(best[0], [0, 0, 0])
            a[0] += x
            a[1] += y
            a[2] += 1
        new = sorted((cid, sx / n, sy / n) for cid, (sx, sy, n) in acc.items())
        if [c[0] for c in new] == [c[0] for c in cur] and all(
                math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) <= tol
                for a, b in zip(cur, new)):
            return cur, i + 1, True
        cur = new
    return cur, steps, False


@SETTINGS
@given(pts=points, cs=seeds)
def test_kmeans_early_stop_matches_python(spark, pts, cs):
    df = spark.createDataFrame(pts, "x BIGINT, y BIGINT")
    sd = spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(cs)],
                               "id INT, x DOUBLE, y DOUBLE")
    got = rows(M.kmeans_partial_agg(df, sd, 6, 0.001))
    cur, it, conv = _brute(pts, cs, 6, 0.001)
    assert [(r[0], r[1], r[2]) for r in got] == cur
    assert all(r[3] == it and r[4] == conv for r in got)
