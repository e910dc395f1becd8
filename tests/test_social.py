"""Edge fixtures for the social jobs."""

import datetime as dt

from conftest import rows
from tidepool.plans import social as D

PEOPLE = "person_id BIGINT, name STRING, nationality STRING, country_code INT, hobby STRING"
FRIENDS = ("friend_rel BIGINT, person_id BIGINT, my_friend BIGINT, "
           "date_of_friendship DATE, descr STRING")
LOG = ("access_id BIGINT, by_who BIGINT, what_page BIGINT, type_of_access STRING, "
       "access_time TIMESTAMP_NTZ")


def T(s):
    return dt.datetime.fromisoformat(s)


def people(spark):
    return spark.createDataFrame([
        (1, " Ann ", "Armenia", 7, "Chess"),
        (2, "Bob", "Armenia", 7, None),
        (3, "Cid", "Chile", 0, "Golf"),
        (4, "Dee", "Chile", 51, "Judo"),
        (5, "Eve", "Peru", 50, "Yoga"),
    ], PEOPLE)


def friends(spark):
    d = dt.date(2020, 1, 1)
    return spark.createDataFrame([
        (10, 1, 2, d, "Friend"),
        (11, 1, 2, d, "Friend"),     # duplicate pair
        (12, 1, 3, d, "Cousin"),
        (13, 2, 1, d, "Friend"),
        (14, 3, 99, d, "Uncle"),     # dangling target (no people row)
        (15, 4, 1, d, "Aunt"),
    ], FRIENDS)


def log(spark):
    return spark.createDataFrame([
        (1, 1, 2, "Viewed Profile", T("2024-01-30 10:00:00")),
        (2, 1, 2, "Liked Post", T("2024-01-10 10:00:00")),
        (3, 2, 1, "Shared Post", T("2024-01-01 00:00:00")),
        (4, 3, 1, "Viewed Profile", T("2024-01-31 00:00:00")),
        (5, 4, 77, "Viewed Profile", None),  # only an unparsable time; page 77 has no owner
        (6, 5, 1, "Viewed Profile", T("2024-01-29 00:00:00")),
    ], LOG)


def test_people_by_nationality_keeps_null_hobby(spark):
    got = rows(D.people_by_nationality(people(spark), "Armenia"))
    assert got == sorted([(" Ann ", "Chess"), ("Bob", None)])


def test_top_pages_ties_go_to_lowest_page(spark):
    got = rows(D.top_pages(log(spark), 2))
    assert got == [(1, 3), (2, 2)]
    got3 = rows(D.top_pages(log(spark), 3))
    assert (77, 1) in got3


def test_top_pages_details_inner_and_outer(spark):
    inner = rows(D.top_pages_details(log(spark), people(spark), 3))
    outer = rows(D.top_pages_details_outer(log(spark), people(spark), 3))
    assert [r[0] for r in inner] == [1, 2]
    assert (77, "Unknown", "Unknown") in outer and len(outer) == 3


def test_country_code_range_and_nationality_counts(spark):
    assert rows(D.people_per_country_code(people(spark))) == [(7, 2), (50, 1)]
    got = rows(D.people_per_nationality(people(spark)))
    assert got == [("Armenia", 2), ("Chile", 2), ("Peru", 1)]
    assert sum(n for _, n in got) == 5


def test_connectedness_includes_dangling_and_zero(spark):
    got = dict(rows(D.connectedness(people(spark), friends(spark))))
    assert got == {1: 2, 2: 2, 3: 1, 4: 0, 5: 0, 99: 1}
    assert sum(got.values()) == friends(spark).count()


def test_connectedness_named_only_people_rows(spark):
    got = rows(D.connectedness_named(people(spark), friends(spark)))
    assert got == sorted([(" Ann ", 2), ("Bob", 2), ("Cid", 1), ("Dee", 0), ("Eve", 0)])


def test_access_profile(spark):
    got = rows(D.access_profile(log(spark)))
    assert got == [(1, 2, 1), (2, 1, 1), (3, 1, 1), (4, 1, 1), (5, 1, 1)]
    named = rows(D.access_profile_named(log(spark), people(spark)))
    assert (" Ann ", 2, 1) in named and len(named) == 5


def test_friends_never_accessed_is_distinct_and_directed(spark):
    got = rows(D.friends_never_accessed(friends(spark), log(spark)))
    assert got == [
        (1, 3, "NEVER ACCESSED FRIEND 3"),
        (3, 99, "NEVER ACCESSED FRIEND 99"),
        (4, 1, "NEVER ACCESSED FRIEND 1"),
    ]
    ign = rows(D.people_ignoring_a_friend(friends(spark), log(spark), people(spark)))
    assert ign == [(1, " Ann "), (3, "Cid"), (4, "Dee")]


def test_disconnected_users_default_anchor_and_unparsable(spark):
    # anchor = max time 2024-01-31; threshold 14 days earlier = 2024-01-17
    got = rows(D.disconnected_users(log(spark)))
    assert got == [(2,), (4,)]
    got_asof = rows(D.disconnected_users(log(spark), days=1, as_of="2024-01-30 12:00:00"))
    assert got_asof == [(2,), (4,), (5,)]
    named = rows(D.matching_people(people(spark), D.disconnected_users(log(spark))))
    assert named == [(2, "Bob"), (4, "Dee")]


def test_isolated_inactive_people(spark):
    # no outgoing friend row: 5 (Eve); Eve accessed at 01-29 > 01-17 so is active
    assert rows(D.isolated_inactive_people(people(spark), friends(spark), log(spark))) == []
    got = rows(D.isolated_inactive_people(people(spark), friends(spark), log(spark), days=1))
    assert got == [(5, "Eve")]


def test_friend_counts_report_and_popular(spark):
    fc = rows(D.friend_counts(friends(spark)))
    assert fc == [(1, 3), (2, 1), (3, 1), (4, 1)]
    rep = dict(rows(D.friend_count_report(friends(spark))))
    assert rep["USER_1"] == 3 and rep["Average Friendships"] == 1  # 6 / 4 truncated
    pop = rows(D.popular_people(friends(spark), people(spark)))
    assert pop == [("Ann", 3)]  # 3 > 1.5, name trimmed


def test_friend_counts_from_adjacency(spark):
    lines = spark.createDataFrame([("1,2,3",), ("2,1",), ("3",)], "value STRING")
    got = rows(D.friend_counts_from_adjacency(lines))
    assert got == [(1, 2), (2, 1)]


def test_outer_details_one_line_per_page_with_duplicate_ids(spark):
    dup = people(spark).unionByName(spark.createDataFrame(
        [(1, "Zed", "Zambia", 9, "Ski")], PEOPLE))
    got = rows(D.top_pages_details_outer(log(spark), dup, 3))
    assert [r[0] for r in got] == [1, 2, 77]
    assert (1, " Ann ", "Armenia") in got
    inner = rows(D.top_pages_details(log(spark), dup, 3))
    assert len([r for r in inner if r[0] == 1]) == 2  # the inner version keeps both


def test_tie_exactly_at_rank_ten_goes_to_lowest_ids(spark):
    # pages 100..111 each accessed 3 times, page 1 five times: 13 candidates
    rows_ = [(i, 1, 1, "V", T("2024-01-01 00:00:00")) for i in range(5)]
    n = 5
    for page in range(100, 112):
        for _ in range(3):
            rows_.append((n, 2, page, "V", T("2024-01-01 00:00:00")))
            n += 1
    top = rows(D.top_pages(spark.createDataFrame(rows_, LOG), 10))
    assert [p for p, _ in top] == [1] + list(range(100, 109))
