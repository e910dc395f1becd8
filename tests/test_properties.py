"""Cross-job properties on the driver tables."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidepool.plans import health as H
from tidepool.plans import kmeans as M
from tidepool.plans import social as D
from tidepool.sources import tables as V


@pytest.fixture(scope="module")
def views(spark):
    return {
        "people": V.people(spark, SF_SMALL),
        "friends": V.friends(spark, SF_SMALL),
        "log": V.access_log(spark, SF_SMALL),
        "att": V.attendees(spark, SF_SMALL),
        "pts": V.points(spark, SF_SMALL),
    }


def test_counts_add_up(views):
    assert D.people_per_nationality(views["people"]).agg(F.sum("n")).collect()[0][0] \
        == views["people"].count()
    assert D.connectedness(views["people"], views["friends"]).agg(F.sum("factor")).collect()[0][0] \
        == views["friends"].count()
    assert D.friend_counts(views["friends"]).agg(F.sum("num_friends")).collect()[0][0] \
        == views["friends"].count()


def test_ignoring_ids_are_distinct_never_accessed_persons(views):
    d11 = {r[0] for r in D.friends_never_accessed(views["friends"], views["log"])
           .select("person_id").collect()}
    people_ids = {r[0] for r in views["people"].select("person_id").collect()}
    d12 = [r[0] for r in D.people_ignoring_a_friend(views["friends"], views["log"],
                                                   views["people"]).collect()]
    assert len(d12) == len(set(d12)) and set(d12) == d11 & people_ids


def test_e3_size_from_table_health(views):
    att = views["att"]
    concern = H.table_health(att).where("flag = 'concern'")
    at_concern = concern.agg(F.sum("n")).collect()[0][0]
    sick = att.where("test = 'sick'").count()
    assert H.healthy_at_sick_table(att).count() == at_concern - sick


def test_e5_equals_e3_when_reports_match_tests(views):
    att = views["att"]
    reports = att.where("test = 'sick'").select("id", "test")
    e3 = rows(H.healthy_at_sick_table(att))
    e5 = rows(H.healthy_at_risk(att.drop("test"), reports), "id", "name")
    assert e3 == e5


def test_partial_agg_equals_early_stop(spark, views):
    seeds = V.seeds(spark)
    a = rows(M.kmeans_early_stop(views["pts"], seeds, 8))
    b = rows(M.kmeans_partial_agg(views["pts"], seeds, 8))
    assert a == b
