"""Text scans and writers (S1-S9, K1-K9) round-tripped through temp folders."""

import glob
import os

import pytest

from conftest import rows
from tidepool.plans import health as H
from tidepool.plans import social as D
from tidepool.plans import synth as G
from tidepool.sources import readers as Rd
from tidepool.sources import schemas as S
from tidepool.sources import sinks as K


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)
    return path


def test_people_csv_header_short_rows_bad_numbers_quotes(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "pages.csv"),
               "PersonID,Name,Nationality,Country Code,Hobby\n"
               "1,Ann,Armenia,07,Chess\n"
               "2,\"Bob, Jr\",Armenia,7,\n"
               "x3,Cid,Chile,5,Golf\n"
               "4,Dee,Chile,notanumber,Judo\n"
               "5,Eve\n")
    raw = Rd.read_people(spark, p)
    got = rows(raw)
    assert (1, "Ann", "Armenia", 7, "Chess") in got          # "07" -> 7
    assert (2, "Bob, Jr", "Armenia", 7, None) in got          # quoted comma, empty hobby
    assert (None, "Cid", "Chile", 5, "Golf") in got           # bad id -> NULL
    assert (5, "Eve", None, None, None) in got                # short row padded
    clean = Rd.clean_rows(raw, ["person_id", "country_code"])
    assert [r[0] for r in rows(clean)] == [1, 2]
    assert Rd.reject_count(raw, ["person_id", "country_code"]).collect()[0][0] == 3
    # the job runs on what the reader produced; code 7 counted twice
    assert rows(D.people_per_country_code(clean)) == [(7, 2)]


def test_corrupt_record_column(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "att.csv"),
               "id,name,table,test\n1,A,3,sick\n2,B\n")
    df = Rd.read_text_table(spark, p, S.ATTENDEES, header=True, keep_corrupt=True)
    got = {r["id"]: r[Rd.CORRUPT] for r in df.collect()}
    assert got[1] is None and got[2] == "2,B"


def test_access_log_timestamps_and_digits(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "access_logs.csv"),
               "AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime\n"
               "1,1,2,Viewed Profile,2024-01-30 10:00:00\n"
               "2,7,2,Viewed Profile,not a time\n")
    log = Rd.read_access_log(spark, p)
    got = rows(log, "by_who", "access_time")
    assert got[1] == (7, None) and got[0][1].year == 2024
    # a user with only unparsable times is reported as disconnected
    assert (7,) in rows(D.disconnected_users(log))


def test_scan_restricted_by_file_name(spark, tmp_dir):
    _write(os.path.join(tmp_dir, "access_logs.csv"), "a,b,c,d,e\n1,1,2,V,2024-01-01 00:00:00\n")
    _write(os.path.join(tmp_dir, "other.csv"), "a,b,c,d,e\n9,9,9,V,2024-01-01 00:00:00\n")
    df = Rd.read_text_table_by_file_name(spark, tmp_dir, "access_logs.csv", S.ACCESS_LOG)
    assert rows(df, "access_id") == [(1,)]


def test_key_value_round_trip_snappy(spark, tmp_dir):
    df = spark.createDataFrame([(1, 10, 3), (2, 20, 4)], "k INT, a INT, b INT")
    out = os.path.join(tmp_dir, "kv")
    K.write_key_value(df, out, "k", ["a", "b"], compression="snappy")
    assert glob.glob(os.path.join(out, "*.snappy"))
    back = Rd.read_key_value(spark, out, "k", ["a", "b"], S.T.IntegerType(), S.T.IntegerType())
    assert rows(back) == [(1, 10, 3), (2, 20, 4)]


def test_csv_modes_and_single_file(spark, tmp_dir):
    df = spark.range(5).selectExpr("id", "id * 2 AS v")
    out = os.path.join(tmp_dir, "csv")
    K.write_csv(df, out, header=True, single_file=True)
    assert len(glob.glob(os.path.join(out, "part-*"))) == 1
    with pytest.raises(Exception):
        K.write_csv(df, out)  # errorifexists
    K.write_csv(df, out, mode="overwrite")


def test_report_lines_trailer_last(spark):
    centres = spark.createDataFrame([(1, 2.5, 3.0, True), (0, 1.0, 2.0, True)],
                                    "id INT, x DOUBLE, y DOUBLE, converged BOOLEAN")
    lines = [r[0] for r in K.report_lines(centres).collect()]
    assert lines == ["0\t1.0,2.0", "1\t2.5,3.0", "Convergence: yes"]


def test_event_tables_written_and_reloaded(spark, tmp_dir):
    att = G.gen_attendees(spark, 3000, tables=20, p_sick=0.02)
    G.write_event_tables(att, tmp_dir)
    full = Rd.read_attendees(spark, os.path.join(tmp_dir, "mega_event"))
    nd = Rd.read_attendees_no_disclosure(spark, os.path.join(tmp_dir, "mega_event_no_disclosure"))
    rep = Rd.read_reports(spark, os.path.join(tmp_dir, "reported_illnesses"))
    assert full.count() == 3000
    e3 = {r[0] for r in H.healthy_at_sick_table(full).collect()}
    e5 = {r[0] for r in H.healthy_at_risk(nd, rep).select("id").collect()}
    assert e3 == e5  # reports match the test column


def test_split_fields_java_semantics(spark):
    lines = spark.createDataFrame([("a,b,,",)], "value STRING")
    spark_like = Rd.split_fields(lines).collect()[0]["fields"]
    java_like = Rd.split_fields(lines, drop_trailing_empty=True).collect()[0]["fields"]
    assert spark_like == ["a", "b", "", ""] and java_like == ["a", "b"]


def test_empty_and_non_ascii_pages_are_not_counted(spark, tmp_dir):
    p = _write(os.path.join(tmp_dir, "access_logs.csv"),
               "AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime\n"
               "1,1,2,Viewed Profile,2024-01-30 10:00:00\n"
               "2,1,,Viewed Profile,2024-01-30 10:00:00\n"
               "3,1,é7,Viewed Profile,2024-01-30 10:00:00\n"
               "4,1,７,Viewed Profile,2024-01-30 10:00:00\n")
    log = Rd.read_access_log(spark, p)
    assert rows(D.top_pages(log)) == [(2, 1)]


def test_observed_rejects_count_in_the_jobs_own_pass(spark):
    df = spark.createDataFrame([(1, 2), (None, 2), (None, None), (3, None), (4, 5)], "by_who BIGINT, what_page BIGINT")
    clean, seen = Rd.observed_clean(df, ["by_who", "what_page"])
    assert rows(clean.groupBy("by_who").count()) == [(1, 1), (4, 1)]
    assert rows(Rd.reject_report(spark, seen)) == [("by_who", 2), ("clean", 2), ("what_page", 1)]
    empty, seen = Rd.observed_clean(df.where("by_who = 9"), ["by_who", "what_page"])
    assert empty.count() == 0 and {r.n for r in Rd.reject_report(spark, seen).collect()} == {0}


def test_malformed_access_log_has_every_reason(spark):
    from tidepool.plans import catalog
    got = {r.reason: r.n for r in catalog.queries()["access_log_reject_reasons"](spark, "/root/testdata/sf0.001").collect()}
    assert set(got) == {"clean", "by_who", "what_page"} and all(n > 0 for n in got.values())
