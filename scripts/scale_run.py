"""Scale run at the original workload sizes with the distributed generators.

Usage: python scripts/scale_run.py OUT_DIR [factor]

Generates people / friends / access log / attendees / points with
``tidepool.plans.synth`` (factor 1.0 = 200k people, 20M friendships, 10M
accesses, 1.5M attendees, 40k points), writes them as parquet under OUT_DIR
(a fresh folder), then times every job over the files with the noop sink.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def main() -> None:
    out = sys.argv[1]
    factor = float(sys.argv[2]) if len(sys.argv) > 2 else 1.0
    from tidepool.session import build_session
    from tidepool.plans import health as H
    from tidepool.plans import kmeans as M
    from tidepool.plans import social as D
    from tidepool.plans import synth as G

    spark = build_session("local[8]", shuffle_partitions=32,
                          extra={"spark.driver.memory": "16g"})
    n_people = int(200_000 * factor)
    sizes = {"people": n_people, "friends": int(20_000_000 * factor),
             "access_log": int(10_000_000 * factor), "attendees": int(1_500_000 * factor),
             "points": int(40_000 * factor)}
    gen = {
        "people": lambda: G.gen_people(spark, n_people),
        "friends": lambda: G.gen_friends(spark, n_people, sizes["friends"]),
        "access_log": lambda: G.gen_access_log(spark, n_people, sizes["access_log"]),
        "attendees": lambda: G.gen_attendees(spark, sizes["attendees"]),
        "points": lambda: G.gen_points(spark, sizes["points"]),
    }
    gen_times = {}
    for name, make in gen.items():
        t0 = time.perf_counter()
        make().write.mode("errorifexists").parquet(f"{out}/{name}")
        gen_times[name] = round(time.perf_counter() - t0, 2)

    def t(name):
        return spark.read.parquet(f"{out}/{name}")

    seeds = G.gen_seeds(spark, 10, 0, 5000)
    jobs = {
        "top_pages_details": lambda: D.top_pages_details(t("access_log"), t("people")),
        "top_pages_details_outer": lambda: D.top_pages_details_outer(t("access_log"), t("people")),
        "people_per_country_code": lambda: D.people_per_country_code(t("people")),
        "connectedness": lambda: D.connectedness(t("people"), t("friends")),
        "connectedness_named": lambda: D.connectedness_named(t("people"), t("friends")),
        "access_profile_named": lambda: D.access_profile_named(t("access_log"), t("people")),
        "friends_never_accessed": lambda: D.friends_never_accessed(t("friends"), t("access_log")),
        "people_ignoring_a_friend": lambda: D.people_ignoring_a_friend(
            t("friends"), t("access_log"), t("people")),
        "disconnected_users": lambda: D.disconnected_users(t("access_log"), days=14),
        "isolated_inactive_people": lambda: D.isolated_inactive_people(
            t("people"), t("friends"), t("access_log"), days=14),
        "friend_count_report": lambda: D.friend_count_report(t("friends")),
        "popular_people": lambda: D.popular_people(t("friends"), t("people")),
        "healthy_at_sick_table": lambda: H.healthy_at_sick_table(t("attendees")),
        "table_health": lambda: H.table_health(t("attendees")),
        "healthy_at_risk": lambda: H.healthy_at_risk(
            t("attendees").drop("test"),
            t("attendees").where("test = 'sick'").select("id", "test")),
        "kmeans_early_stop": lambda: M.kmeans_early_stop(t("points"), seeds, 30),
        "kmeans_partial_agg": lambda: M.kmeans_partial_agg(t("points"), seeds, 30),
    }
    times, counts = {}, {}
    for name, make in jobs.items():
        t0 = time.perf_counter()
        df = make()
        df.write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 2)
    spark.stop()
    print(json.dumps({"factor": factor, "sizes": sizes, "generate_sec": gen_times,
                      "job_sec": times, "total_job_sec": round(sum(times.values()), 2)}))


if __name__ == "__main__":
    main()
