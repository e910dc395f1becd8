"""Edge fixtures for the event-health jobs."""

from conftest import rows
from tidepool.plans import health as H

ATT = "id BIGINT, name STRING, table BIGINT, test STRING"


def attendees(spark):
    return spark.createDataFrame([
        (1, "A", 1, "sick"),
        (2, "B", 1, "not-sick"),
        (3, "C", 1, "unknown"),
        (4, "D", 2, " Sick "),      # counts as sick only for the trimming job
        (5, "E", 2, "not-sick"),
        (6, "F", 3, "NOT-SICK"),
        (7, "G", 3, " not-sick "),
        (8, "H", 4, ""),            # empty test: not counted by table_health
        (9, "I", 4, "not-sick"),
        (10, "J", 5, "sick"),       # a table with one person
    ], ATT)


def test_sick_attendees_exact(spark):
    assert rows(H.sick_attendees(attendees(spark)), "id") == [(1,), (10,)]


def test_healthy_at_sick_table_exact_values_only(spark):
    assert rows(H.healthy_at_sick_table(attendees(spark))) == [(2, "B")]


def test_table_health_trims_and_lowers(spark):
    got = rows(H.table_health(attendees(spark)))
    assert got == [(1, 3, "concern"), (2, 2, "concern"), (3, 2, "healthy"),
                   (4, 1, "healthy"), (5, 1, "concern")]


def test_sick_attendee_tables_duplicates_and_non_sick_reports(spark):
    nd = attendees(spark).drop("test")
    reports = spark.createDataFrame([(1, "sick"), (1, "sick"), (5, "not-sick"), (42, "sick")],
                                    "id BIGINT, test STRING")
    assert rows(H.sick_attendee_tables(nd, reports)) == [(1, 1), (1, 1)]


def test_healthy_at_risk_any_report_counts(spark):
    nd = attendees(spark).drop("test")
    reports = spark.createDataFrame([(1, "sick"), (1, "sick"), (6, "not-sick"), (42, "sick")],
                                    "id BIGINT, test STRING")
    got = rows(H.healthy_at_risk(nd, reports))
    assert got == [(2, "B", 1), (3, "C", 1), (7, "G", 3)]


def test_e3_equals_e5_when_reports_match_tests(spark):
    att = attendees(spark)
    reports = H.sick_attendees(att).select("id", "test")
    e3 = {r[0] for r in rows(H.healthy_at_sick_table(att))}
    e5 = {r[0] for r in rows(H.healthy_at_risk(att.drop("test"), reports))}
    # E5 also keeps 'unknown' people (not reported) -> E3 is a subset
    assert e3 <= e5 and e5 - e3 == {3}
