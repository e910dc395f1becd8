"""Registry of the data jobs.

Each job is written once against a table accessor ``t(name)`` that returns
a fresh DataFrame for one of the logical tables (people, friends,
access_log, access_log_text, access_log_unowned, access_log_lines, attendees, no_disclosure,
reports, points, seeds).
``queries()`` binds the accessor to the views of the driver's parquet tables
(``tidepool.sources.tables``), so every registered query reads and runs
over the whole driver tables; ``bind`` binds it to any other tables with the
library's columns.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.plans import health as H
from tidepool.plans import kmeans as M
from tidepool.plans import params as P
from tidepool.plans import social as D
from tidepool.operators import adjacency, grid
from tidepool.operators import pairs as Pr
from tidepool.session import ensure_checkpoint_dir
from tidepool.sources import readers as Rd
from tidepool.sources import schemas as S
from tidepool.sources import sinks as K
from tidepool.sources.state import LastAccessStore
from tidepool.sources import tables as V

Query = Callable[[SparkSession, str], DataFrame]
Tables = Callable[[str], DataFrame]
Job = Callable[[Tables], DataFrame]


def _assignments(t: Tables) -> DataFrame:
    final = M.kmeans_partial_agg(t("points"), t("seeds"), P.KMEANS_MAX_STEPS, P.KMEANS_TOL)
    return M.kmeans_assignments(t("points"), final)


def _shift(t: Tables) -> DataFrame:
    step = M.kmeans_step(t("points"), t("seeds")).select("id", "x", "y")
    return M.centroid_shift(t("seeds"), step, P.KMEANS_TOL)


def _reject_reasons(t: Tables) -> DataFrame:
    lines = Rd.typed_lines(t("access_log_lines"), S.ACCESS_LOG)
    clean, seen = Rd.observed_clean(lines, Rd.REQUIRED["access_log"])
    D.top_pages(clean, P.TOP_K).collect()  # the job whose pass does the counting: k rows
    return Rd.reject_report(lines.sparkSession, seen)


def _nearest_of_many(t: Tables) -> DataFrame:
    """Per centre that is nearest to some point: the points and the greatest
    distance. The centres are the most frequent places of the points."""
    places = M.usable_points(t("points")).groupBy("x", "y").agg(F.count("*").alias("w"))
    top = places.orderBy(F.desc("w"), "x", "y").limit(P.MANY_CENTRES).collect()
    near = grid.with_nearest(places, [(i, float(r.x), float(r.y)) for i, r in enumerate(top)])
    return near.groupBy("nearest.id").agg(F.any_value("nearest.x").alias("cx"), F.any_value("nearest.y").alias("cy"),
                                          F.sum("w").alias("n"), F.max("nearest.dist").alias("farthest"))


def _pair_tables(t: Tables) -> tuple[DataFrame, DataFrame]:
    return (Pr.write_pairs(t("friends"), ["person_id", "my_friend"]),
            Pr.write_pairs(t("access_log"), ["by_who", "what_page"]))


def _disconnected_by_period(t: Tables) -> DataFrame:
    """(as_of, by_who): the users who are disconnected at the end of each of
    a few equal periods of the log, from a state into which the periods merge one by one."""
    log = t("access_log").select("by_who", "access_time", F.to_date("access_time").alias("day"))
    spark = log.sparkSession
    first, last = log.agg(F.min("day"), F.max("day")).first()
    none = spark.createDataFrame([], "as_of DATE, by_who BIGINT")
    if first is None:
        return none
    store = LastAccessStore(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/last-access-{uuid.uuid4().hex}")
    step = (last - first).days // P.STATE_MERGES + 1
    out = none
    for i in range(P.STATE_MERGES):
        start = first + dt.timedelta(i * step)
        end = start + dt.timedelta(step - 1)
        new = F.col("day").between(F.lit(start), F.lit(end))
        store.merge(log.where(new | F.col("day").isNull() if start == first else new), end)
        ended = D.disconnected_as_of(store.state(end), P.INACTIVE_DAYS)
        out = out.unionByName(ended.select(F.lit(end).alias("as_of"), "by_who"))
    return out


def _adjacency_chunks(t: Tables) -> DataFrame:
    """Each chunk with its number of different friends and of friend rows."""
    return adjacency.build_chunks(t("friends"), P.CHUNK_WIDTH).select(
        "person_id", "chunk", F.size("friends").cast("bigint").alias("n_friends"), "n")


SOCIAL: dict[str, Job] = {
    "people_by_nationality": lambda t: D.people_by_nationality(t("people"), P.NATIONALITY),
    "top_pages": lambda t: D.top_pages(t("access_log"), P.TOP_K),
    "top_pages_details": lambda t: D.top_pages_details(t("access_log"), t("people"), P.TOP_K),
    "top_pages_details_outer": lambda t: D.top_pages_details_outer(
        t("access_log_unowned"), t("people"), P.TOP_K),
    "top_pages_text": lambda t: D.top_pages_text(t("access_log_text"), P.TOP_K),
    "access_log_rejects": lambda t: Rd.reject_count(t("access_log"), Rd.REQUIRED["access_log"]),
    "access_log_reject_reasons": _reject_reasons,
    "people_per_country_code": lambda t: D.people_per_country_code(t("people")),
    "people_per_nationality": lambda t: D.people_per_nationality(t("people")),
    "connectedness": lambda t: D.connectedness(t("people"), t("friends")),
    "connectedness_named": lambda t: D.connectedness_named(t("people"), t("friends")),
    "access_profile": lambda t: D.access_profile(t("access_log")),
    "access_profile_named": lambda t: D.access_profile_named(t("access_log"), t("people")),
    "friends_never_accessed": lambda t: D.friends_never_accessed(t("friends"), t("access_log")),
    "people_ignoring_a_friend": lambda t: D.people_ignoring_a_friend(
        t("friends"), t("access_log"), t("people")),
    "access_profile_merged": lambda t: D.access_profile_merged(D.daily_pages(t("access_log"))),
    "rolling_access_profile": lambda t: D.rolling_access_profile(D.daily_pages(t("access_log")), P.ROLLING_DAYS),
    "friends_never_accessed_bucketed": lambda t: D.friends_never_accessed_of(*_pair_tables(t)),
    "people_ignoring_a_friend_bucketed": lambda t: D.people_ignoring_a_friend_of(*_pair_tables(t), t("people")),
    "disconnected_by_period": _disconnected_by_period,
    "adjacency_chunks": _adjacency_chunks,
    "friend_count_report_chunked": lambda t: D.friend_count_report_chunked(
        adjacency.build_chunks(t("friends"), P.CHUNK_WIDTH)),
    "disconnected_users": lambda t: D.disconnected_users(t("access_log"), days=P.INACTIVE_DAYS),
    "matching_people": lambda t: D.matching_people(
        t("people"), D.disconnected_users(t("access_log"), days=P.INACTIVE_DAYS)),
    "isolated_inactive_people": lambda t: D.isolated_inactive_people(
        t("people"), t("friends"), t("access_log"), days=P.INACTIVE_DAYS),
    "friend_counts": lambda t: D.friend_counts(t("friends")),
    "friend_count_report": lambda t: D.friend_count_report(t("friends")),
    "popular_people": lambda t: D.popular_people(t("friends"), t("people")),
}

HEALTH: dict[str, Job] = {
    "event_outputs": lambda t: K.tagged_lines(t("attendees"), H.event_outputs()),
    "sick_attendees": lambda t: H.sick_attendees(t("attendees")),
    "sick_attendee_tables": lambda t: H.sick_attendee_tables(t("no_disclosure"), t("reports")),
    "healthy_at_sick_table": lambda t: H.healthy_at_sick_table(t("attendees")),
    "table_health": lambda t: H.table_health(t("attendees")),
    "healthy_at_risk": lambda t: H.healthy_at_risk(t("no_disclosure"), t("reports")),
}

KMEANS: dict[str, Job] = {
    "kmeans_step": lambda t: M.kmeans_step(t("points"), t("seeds")),
    "kmeans_iterate": lambda t: M.kmeans_iterate(t("points"), t("seeds"), P.KMEANS_STEPS),
    "kmeans_early_stop": lambda t: M.kmeans_early_stop(
        t("points"), t("seeds"), P.KMEANS_MAX_STEPS, P.KMEANS_TOL),
    "kmeans_partial_agg": lambda t: M.kmeans_partial_agg(
        t("points"), t("seeds"), P.KMEANS_MAX_STEPS, P.KMEANS_TOL),
    "kmeans_centers_report": lambda t: M.kmeans_centers_report(
        t("points"), t("seeds"), P.KMEANS_MAX_STEPS, P.KMEANS_TOL),
    "kmeans_history": lambda t: M.kmeans_history(
        t("points"), t("seeds"), P.KMEANS_MAX_STEPS, P.KMEANS_TOL),
    "kmeans_assignments": _assignments,
    "centroid_shift": _shift,
    "nearest_of_many": _nearest_of_many,
}

JOBS: dict[str, Job] = {**SOCIAL, **HEALTH, **KMEANS}


def driver_tables(spark: SparkSession, sf_dir: str) -> Tables:
    loaders = {
        "people": lambda: V.people(spark, sf_dir),
        "friends": lambda: V.friends(spark, sf_dir),
        "access_log": lambda: V.access_log(spark, sf_dir),
        "access_log_text": lambda: V.access_log_text(spark, sf_dir),
        "access_log_unowned": lambda: V.access_log_unowned(spark, sf_dir),
        "access_log_lines": lambda: V.access_log_lines(spark, sf_dir),
        "attendees": lambda: V.attendees(spark, sf_dir),
        "no_disclosure": lambda: V.attendees_no_disclosure(spark, sf_dir),
        "reports": lambda: V.reports(spark, sf_dir),
        "points": lambda: V.points(spark, sf_dir),
        "seeds": lambda: V.seeds(spark, P.SEEDS),
    }
    return lambda name: loaders[name]()


def bind(job: Job, tables: Tables) -> DataFrame:
    return job(tables)


def _query(job: Job) -> Query:
    return lambda spark, sf_dir: job(driver_tables(spark, sf_dir))


def queries() -> dict[str, Query]:
    return {name: _query(job) for name, job in JOBS.items()}


FLAGSHIP = "top_pages_details"
