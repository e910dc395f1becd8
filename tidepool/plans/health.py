"""Event-health jobs over attendees / reported illnesses.

attendees(id, name, table, test), no-disclosure attendees(id, name, table),
reports(id, test). ``table`` is the seating table number.

Scale notes: a table may seat a large share of all attendees. No job groups
attendee rows per table into a collection; the per-table questions are
answered by a partial aggregate (one row per table and map task) or by a
semi/anti join against the de-duplicated set of flagged tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.operators import relational as R

# Fixed health values and labels.
SICK, NOT_SICK = "sick", "not-sick"
HEALTHY, CONCERN = "healthy", "concern"


def event_outputs() -> dict[str, tuple[Column, list[str]]]:
    """The three files of one event, for ``sinks.write_tagged``: attendees with
    their test, attendees without it, and the reports of the sick."""
    return {"attendees": (F.lit(True), ["id", "name", "table", "test"]),
            "no_disclosure": (F.lit(True), ["id", "name", "table"]),
            "reports": (F.col("test") == F.lit(SICK), ["id", "test"])}


def sick_attendees(attendees: DataFrame) -> DataFrame:
    """Attendees whose test is exactly 'sick' (all columns)."""
    return attendees.where(F.col("test") == F.lit(SICK)).select("id", "name", "table", "test")


def sick_attendee_tables(no_disclosure: DataFrame, reports: DataFrame) -> DataFrame:
    """(id, table) of attendees with a 'sick' report. An inner join: a
    duplicated report duplicates the row, as a relational join does."""
    sick = reports.where(F.col("test") == F.lit(SICK)).select(F.col("id").alias("_rid"))
    return (no_disclosure.join(sick, no_disclosure.id == sick._rid, "inner")
            .select("id", "table"))


def sick_tables_from_tests(attendees: DataFrame) -> DataFrame:
    """Distinct tables with at least one exactly-'sick' attendee."""
    return attendees.where(F.col("test") == F.lit(SICK)).select("table").distinct()


def healthy_at_sick_table(attendees: DataFrame) -> DataFrame:
    """Exactly-'not-sick' attendees seated at a table with an exactly
    'sick' attendee (other test values count as neither)."""
    healthy = attendees.where(F.col("test") == F.lit(NOT_SICK))
    return R.keep_matching(healthy, "table", sick_tables_from_tests(attendees),
                           "table").select("id", "name")


def table_health(attendees: DataFrame) -> DataFrame:
    """Per table, attendee count and 'healthy' iff every test (trimmed,
    lower-cased) is 'not-sick', else 'concern'. Rows with a missing or empty
    test or a missing table are not counted."""
    t = F.lower(F.trim(F.col("test")))
    valid = attendees.where(F.col("table").isNotNull() & F.col("test").isNotNull()
                            & (F.trim(F.col("test")) != F.lit("")))
    agg = valid.groupBy("table").agg(F.count(F.lit(1)).alias("n"),
                                     F.bool_and(t == F.lit(NOT_SICK)).alias("_ok"))
    return agg.select("table", "n",
                      F.when(F.col("_ok"), F.lit(HEALTHY)).otherwise(F.lit(CONCERN)).alias("flag"))


def healthy_at_risk(no_disclosure: DataFrame, reports: DataFrame) -> DataFrame:
    """E5: without the test column. An attendee is sick when their id has a
    report (any test value); return the not-sick attendees seated at a table
    with a sick attendee.

    Plan: semi join attendees x report ids -> distinct sick tables; keep
    attendees at those tables (semi join) who have no report (anti join).
    The report ids are de-duplicated by the join itself (semi/anti never
    multiply rows).
    """
    ids = reports.select(F.col("id").alias("_rid")).where(F.col("_rid").isNotNull())
    sick_people = R.keep_matching(no_disclosure, "id", ids, "_rid")
    sick_tables = sick_people.select("table").distinct()
    at_table = R.keep_matching(no_disclosure, "table", sick_tables, "table")
    return R.drop_matching(at_table, "id", ids, "_rid").select("id", "name", "table")
