"""End to end over text files: the driver views are written as CSV in the
original header layout, every social and health job runs through the
command-line entry point, and its CSV output equals the same job on the
parquet views."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, rows
from tidepool import cli
from tidepool.sources import sinks as K
from tidepool.sources import tables as V

# Header lines of the original text files.
HEADERS = {
    "people": ["PersonID", "Name", "Nationality", "Country Code", "Hobby"],
    "friends": ["FriendRel", "PersonID", "MyFriend", "DateOfFriendship", "Desc"],
    "access_log": ["AccessID", "ByWho", "WhatPage", "TypeOfAccess", "AccessTime"],
    "attendees": ["id", "name", "table", "test"],
    "no_disclosure": ["id", "name", "table"],
    "reports": ["id", "test"],
}


@pytest.fixture(scope="module")
def text_inputs(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("cli-inputs"))
    log = V.access_log(spark, SF_SMALL).withColumn(
        "access_time", F.date_trunc("second", "access_time").cast("timestamp_ntz"))
    views = {
        "people": V.people(spark, SF_SMALL),
        "friends": V.friends(spark, SF_SMALL),
        "access_log": log,
        "attendees": V.attendees(spark, SF_SMALL),
        "no_disclosure": V.attendees_no_disclosure(spark, SF_SMALL),
        "reports": V.reports(spark, SF_SMALL),
    }
    paths = {}
    for name, df in views.items():
        out = df
        if name == "access_log":
            out = df.withColumn("access_time", F.date_format("access_time", "yyyy-MM-dd HH:mm:ss"))
        out = out.toDF(*HEADERS[name])
        paths[name] = os.path.join(base, name)
        K.write_csv(out, paths[name], header=True)
    return views, paths


def _as_text(df):
    return df.select([F.col(c).cast("string").alias(c) for c in df.columns])


JOBS = sorted(set(cli.SOCIAL_INPUTS) | set(cli.HEALTH_INPUTS))


@pytest.mark.parametrize("job", JOBS)
def test_cli_job_matches_parquet_views(spark, text_inputs, tmp_dir, job):
    views, paths = text_inputs
    out = os.path.join(tmp_dir, job)
    argv = [job, "--out", out, "--nationality", "NATION_7", "--days", "1"]
    for name in cli.SOCIAL_INPUTS.get(job) or cli.HEALTH_INPUTS[job]:
        argv += [f"--{name.replace('_', '-')}", paths[name]]
    cli.run(spark, cli._parser().parse_args(argv))
    got = spark.read.option("header", True).csv(out)
    a = cli._parser().parse_args(argv)
    want = cli._social_or_health(a, {n: views[n] for n in views})
    assert got.columns == want.columns
    assert rows(got) == rows(_as_text(want))


def test_cli_kmeans_report(spark, tmp_dir):
    pts = os.path.join(tmp_dir, "points.csv")
    seeds = os.path.join(tmp_dir, "seeds.csv")
    with open(pts, "w") as f:
        f.write("x,y\n" + "".join(f"{x},{y}\n" for x in range(0, 40, 3) for y in range(0, 40, 7)))
    with open(seeds, "w") as f:
        f.write("0,0\n35,35\n")
    out = os.path.join(tmp_dir, "report")
    cli.run(spark, cli._parser().parse_args(
        ["kmeans_centers_report", "--points", pts, "--seeds", seeds, "--out", out,
         "--steps", "20"]))
    lines = [r[0] for r in spark.read.text(out).collect()]
    assert lines[-1] in ("Convergence: yes", "Convergence: no")
    assert [ln.split("\t")[0] for ln in lines[:-1]] == ["0", "1"]


def test_cli_parquet_in_and_out(spark, tmp_dir):
    people = V.people(spark, SF_SMALL)
    src = os.path.join(tmp_dir, "people_pq")
    people.write.parquet(src)
    out = os.path.join(tmp_dir, "by_nat")
    cli.run(spark, cli._parser().parse_args(
        ["people_per_nationality", "--people", src, "--input-format", "parquet",
         "--output-format", "parquet", "--out", out]))
    from tidepool.plans import social as D
    assert rows(spark.read.parquet(out)) == rows(D.people_per_nationality(people))


def test_cli_clean_rows(spark, tmp_dir):
    src = os.path.join(tmp_dir, "pages.csv")
    with open(src, "w") as f:
        f.write("PersonID,Name,Nationality,Country Code,Hobby\n"
                "1,Ann,Armenia,7,Chess\n"
                "x2,Bob,Armenia,7,Golf\n"
                "3,Cid\n"
                "4,Dee,Chile,5,Judo\n"
                "y5,\"Roe, Al\",Chile,3,Go,extra\n"
                "6,\"Poe, Bo\",Chile,3,Go,extra\n")
    out = os.path.join(tmp_dir, "clean")
    cli.run(spark, cli._parser().parse_args(
        ["clean_rows", "--table", "people", "--input", src, "--out", out]))
    both = spark.read.option("header", True).csv(out)
    clean = both.where("status = 'clean'")
    rejected = both.where("status = 'rejected'")
    assert sorted(r["person_id"] for r in clean.collect()) == ["1", "3", "4", "6"]
    from tidepool.sources import readers as Rd
    direct = Rd.clean_rows(Rd.read_people(spark, src), Rd.REQUIRED["people"])  # the same verdicts
    assert sorted(str(r["person_id"]) for r in direct.collect()) == ["1", "3", "4", "6"]
    rejected = Rd.classify_rows(spark, src, "people").where("status = 'rejected'")
    assert sorted(r["raw_line"] for r in rejected.collect()) == ["x2,Bob,Armenia,7,Golf", 'y5,"Roe, Al",Chile,3,Go,extra']


def test_cli_friend_count_report_from_adjacency(spark, tmp_dir):
    src = os.path.join(tmp_dir, "adjacency.txt")
    with open(src, "w") as f:
        f.write("1,2,3\n2,1\n3\nx,1,2\n4,1,2,3\n")
    out = os.path.join(tmp_dir, "report")
    cli.run(spark, cli._parser().parse_args(["friend_count_report", "--adjacency", src, "--out", out]))
    got = sorted((r["label"], r["value"]) for r in spark.read.option("header", True).csv(out).collect())
    assert got == [("Average Friendships", "2"), ("USER_1", "2"), ("USER_2", "1"), ("USER_4", "3")]


def test_cli_centroid_shift(spark, tmp_dir):
    old = os.path.join(tmp_dir, "old.csv")
    new = os.path.join(tmp_dir, "new.txt")
    with open(old, "w") as f:
        f.write("0,0\n5,5\n")
    with open(new, "w") as f:
        f.write("0\t3.0,4.0\n1\t5.0,5.0\n")
    out = os.path.join(tmp_dir, "shift")
    cli.run(spark, cli._parser().parse_args(
        ["centroid_shift", "--seeds", old, "--centres", new, "--out", out]))
    got = sorted((r["id"], r["shift"], r["converged"])
                 for r in spark.read.option("header", True).csv(out).collect())
    assert got == [("0", "5.0", "false"), ("1", "0.0", "false")]
