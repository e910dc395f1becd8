"""Run any job over delimited text files and write its result.

    python -m tidepool.cli JOB --out DIR --master 'local[*]' [inputs] [options]
    spark-submit tidepool/cli.py JOB --out DIR [inputs] [options]

Inputs are CSV files or folders with a header line (``--no-header`` for
headerless files) or, with ``--input-format parquet``, parquet tables with
the library's column names: ``--people``, ``--friends``, ``--access-log``,
``--attendees``, ``--no-disclosure``, ``--reports``; k-means reads
``--points`` and ``--seeds`` text. Output is CSV with a header (or parquet);
the folder must not exist unless ``--overwrite`` is given. k-means jobs take ``--steps`` and ``--tol``; the
``kmeans_centers_report`` job writes the text report with its
``Convergence:`` trailer. ``clean_rows --table T --input F`` writes every
row of a text file once, split into ``--out/status=clean`` and
``--out/status=rejected`` (with the raw line). ``friend_count_report`` also
takes ``--adjacency`` lines.
"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import functions as F

from tidepool.operators import adjacency
from tidepool.plans import health as H
from tidepool.plans import kmeans as M
from tidepool.plans import social as D
from tidepool.sources import readers as Rd
from tidepool.sources import schemas as S
from tidepool.sources import sinks as K
from tidepool.sources.state import LastAccessStore

SOCIAL_INPUTS = {
    "people_by_nationality": ("people",),
    "top_pages": ("access_log",),
    "top_pages_details": ("access_log", "people"),
    "top_pages_details_outer": ("access_log", "people"),
    "access_log_rejects": ("access_log",),
    "access_log_reject_reasons": ("access_log",),
    "rolling_access_profile": ("access_log",),
    "people_per_country_code": ("people",),
    "people_per_nationality": ("people",),
    "connectedness": ("people", "friends"),
    "connectedness_named": ("people", "friends"),
    "access_profile": ("access_log",),
    "access_profile_named": ("access_log", "people"),
    "friends_never_accessed": ("friends", "access_log"),
    "people_ignoring_a_friend": ("friends", "access_log", "people"),
    "disconnected_users": ("access_log",),
    "matching_people": ("people", "access_log"),
    "isolated_inactive_people": ("people", "friends", "access_log"),
    "friend_counts": ("friends",),
    "friend_count_report": ("friends",),
    "popular_people": ("friends", "people"),
}
HEALTH_INPUTS = {
    "sick_attendees": ("attendees",),
    "sick_attendee_tables": ("no_disclosure", "reports"),
    "healthy_at_sick_table": ("attendees",),
    "table_health": ("attendees",),
    "healthy_at_risk": ("no_disclosure", "reports"),
}
KMEANS_JOBS = ("kmeans_step", "kmeans_iterate", "kmeans_early_stop", "kmeans_partial_agg",
               "kmeans_centers_report", "kmeans_history", "kmeans_assignments")
JOBS = tuple(SOCIAL_INPUTS) + tuple(HEALTH_INPUTS) + KMEANS_JOBS + ("centroid_shift", "clean_rows", "top_pages_text", "adjacency_lists",
                                                                  "merge_last_access", "event_outputs")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidepool", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("job", choices=JOBS)
    p.add_argument("--out", required=True)
    for name in ("people", "friends", "access-log", "attendees", "no-disclosure", "reports",
                 "points", "seeds"):
        p.add_argument(f"--{name}")
    p.add_argument("--no-header", action="store_true")
    p.add_argument("--input-format", choices=("csv", "parquet"), default="csv",
                   help="parquet inputs must carry the library's column names")
    p.add_argument("--output-format", choices=("csv", "parquet"), default="csv")
    p.add_argument("--overwrite", action="store_true")
    p.add_argument("--single-file", action="store_true",
                   help="one output file (only for small results)")
    p.add_argument("--nationality", default="Armenia")
    p.add_argument("--top", type=int, default=10)
    p.add_argument("--rolling-days", type=int, default=7)
    p.add_argument("--width", type=int, default=1024, help="adjacency_lists: friend ids a chunk spans")
    p.add_argument("--state", help="merge_last_access: the store's folder; --as-of is the day that the log ends")
    p.add_argument("--days", type=int, default=14)
    p.add_argument("--as-of", default=None, help="'yyyy-MM-dd HH:mm:ss'; default latest access")
    p.add_argument("--steps", type=int, default=10)
    p.add_argument("--tol", type=float, default=M.DEFAULT_TOL)
    p.add_argument("--empty", choices=("drop", "keep"), default="drop")
    p.add_argument("--centres", help="centroid_shift: the newer centre file (--seeds is the older)")
    p.add_argument("--table", choices=tuple(Rd.REQUIRED),
                   help="clean_rows: which layout the --input file has")
    p.add_argument("--input", help="clean_rows: the text file or folder to check")
    p.add_argument("--adjacency", help="friend_count_report: lines user,f1,f2,... instead of --friends")
    p.add_argument("--collapse", action="store_true",
                   help="k-means: combine equal points before the loop")
    p.add_argument("--master", default=None)
    return p


def _load(spark, a, name: str):
    path = getattr(a, name)
    if not path:
        raise SystemExit(f"--{name.replace('_', '-')} is required for {a.job}")
    if a.input_format == "parquet":
        schema = {"people": S.PEOPLE, "friends": S.FRIENDS, "access_log": S.ACCESS_LOG,
                  "attendees": S.ATTENDEES, "no_disclosure": S.ATTENDEES_NO_DISCLOSURE,
                  "reports": S.REPORTS}[name]
        df = spark.read.parquet(path)
        return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
    header = not a.no_header
    reader = {
        "people": Rd.read_people, "friends": Rd.read_friends, "access_log": Rd.read_access_log,
        "attendees": Rd.read_attendees, "no_disclosure": Rd.read_attendees_no_disclosure,
        "reports": Rd.read_reports,
    }[name]
    return reader(spark, path, header=header)


def run(spark, a) -> None:
    mode = "overwrite" if a.overwrite else "errorifexists"
    if a.job == "clean_rows":
        if not (a.table and a.input):
            raise SystemExit("clean_rows needs --table and --input")
        rows = Rd.classify_rows(spark, a.input, a.table, header=not a.no_header)
        w = rows.write.mode(mode).partitionBy("status")
        if a.output_format == "parquet":
            w.parquet(a.out)
        else:
            w.option("header", True).csv(a.out)
        return
    if a.job == "friend_count_report" and a.adjacency:
        counts = D.friend_counts_from_adjacency(Rd.read_lines(spark, a.adjacency))
        _write(D.friend_count_report(counts=counts), a, mode)
        return
    if a.job == "top_pages_text":
        if not a.access_log:
            raise SystemExit("--access-log is required for top_pages_text")
        if a.input_format == "parquet":
            log = spark.read.parquet(a.access_log).select(F.col("what_page").cast("string"))
        else:
            log = Rd.read_text_table(spark, a.access_log, S.as_text(S.ACCESS_LOG), header=not a.no_header)
        _write(D.top_pages_text(log, a.top), a, mode)
        return
    if a.job == "adjacency_lists":
        chunks = adjacency.build_chunks(_load(spark, a, "friends"), a.width)
        if a.output_format == "parquet":
            chunks.write.mode(mode).parquet(a.out)
        else:
            K.write_lines(adjacency.chunk_lines(chunks), a.out, mode=mode, single_file=a.single_file)
        return
    if a.job == "event_outputs":
        K.write_tagged(_load(spark, a, "attendees"), H.event_outputs(), a.out, mode=mode)
        return
    if a.job == "merge_last_access":
        if not (a.state and a.as_of):
            raise SystemExit("merge_last_access needs --state and --as-of")
        store = LastAccessStore(spark, a.state)
        store.merge(_load(spark, a, "access_log"), dt.date.fromisoformat(a.as_of))
        _write(D.disconnected_as_of(store.state(), a.days), a, mode)
        return
    if a.job in SOCIAL_INPUTS or a.job in HEALTH_INPUTS:
        names = SOCIAL_INPUTS.get(a.job) or HEALTH_INPUTS[a.job]
        t = {n: _load(spark, a, n) for n in names}
        _write(_social_or_health(a, t), a, mode)
        return
    if a.job == "centroid_shift":
        if not (a.seeds and a.centres):
            raise SystemExit("centroid_shift needs --seeds (older) and --centres (newer)")
        out = M.centroid_shift(Rd.read_seeds(spark, a.seeds), Rd.read_seeds(spark, a.centres),
                               a.tol)
        _write(out, a, mode)
        return
    points = Rd.read_points(spark, a.points)
    seeds = Rd.read_seeds(spark, a.seeds)
    if a.job == "kmeans_step":
        out = M.kmeans_step(points, seeds)
    elif a.job == "kmeans_iterate":
        out = M.kmeans_iterate(points, seeds, a.steps, a.empty)
    elif a.job == "kmeans_early_stop":
        out = M.kmeans_early_stop(points, seeds, a.steps, a.tol, a.empty)
    elif a.job == "kmeans_partial_agg":
        out = M.kmeans_partial_agg(points, seeds, a.steps, a.tol, a.empty, a.collapse)
    elif a.job == "kmeans_history":
        out = M.kmeans_history(points, seeds, a.steps, a.tol, a.empty)
    elif a.job == "kmeans_assignments":
        final = M.kmeans_partial_agg(points, seeds, a.steps, a.tol, a.empty)
        out = M.kmeans_assignments(points, final)
    else:  # kmeans_centers_report
        report = M.kmeans_centers_report(points, seeds, a.steps, a.tol, a.empty)
        K.write_lines(K.report_lines(report), a.out, mode=mode, single_file=True)
        return
    _write(out, a, mode)


def _write(out, a, mode: str) -> None:
    if a.output_format == "parquet":
        (out.coalesce(1) if a.single_file else out).write.mode(mode).parquet(a.out)
    else:
        K.write_csv(out, a.out, header=True, mode=mode, single_file=a.single_file)


def _social_or_health(a, t):
    j = a.job
    if j == "people_by_nationality":
        return D.people_by_nationality(t["people"], a.nationality)
    if j == "access_log_rejects":
        return Rd.reject_count(t["access_log"], Rd.REQUIRED["access_log"])
    if j == "access_log_reject_reasons":
        clean, seen = Rd.observed_clean(t["access_log"], Rd.REQUIRED["access_log"])
        D.top_pages(clean, a.top).collect()  # the job whose pass does the counting
        return Rd.reject_report(clean.sparkSession, seen)
    if j == "rolling_access_profile":
        return D.rolling_access_profile(D.daily_pages(t["access_log"]), a.rolling_days)
    if j == "top_pages":
        return D.top_pages(t["access_log"], a.top)
    if j == "top_pages_details":
        return D.top_pages_details(t["access_log"], t["people"], a.top)
    if j == "top_pages_details_outer":
        return D.top_pages_details_outer(t["access_log"], t["people"], a.top)
    if j == "disconnected_users":
        return D.disconnected_users(t["access_log"], a.days, a.as_of)
    if j == "matching_people":
        return D.matching_people(t["people"], D.disconnected_users(t["access_log"], a.days, a.as_of))
    if j == "isolated_inactive_people":
        return D.isolated_inactive_people(t["people"], t["friends"], t["access_log"],
                                          a.days, a.as_of)
    fn = getattr(D, j, None) or getattr(H, j)
    names = SOCIAL_INPUTS.get(j) or HEALTH_INPUTS[j]
    return fn(*[t[n] for n in names])


def main(argv=None) -> None:
    a = _parser().parse_args(argv)
    from tidepool.session import build_session
    # Without --master the deployment decides (spark-submit, Spark's own defaults).
    spark = build_session(a.master, app_name=f"tidepool-{a.job}")
    try:
        run(spark, a)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
