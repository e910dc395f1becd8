"""Equivalent DuckDB SQL for every registered query (the correctness oracle).

The driver registers the parquet tables as views (customer, nation, orders,
lineitem, events, ...). Each statement starts with the same CTEs as the
Spark views in ``tidepool.sources.tables`` and then states the job's
semantics independently, in plain SQL; the k-means loop is a recursive CTE.
"""

from __future__ import annotations

from tidepool.plans import params as P

VIEWS = {
    "people": """people AS (
  SELECT CAST(c.c_custkey AS BIGINT) AS person_id, c.c_name AS name,
         n.n_name AS nationality, CAST(c.c_nationkey AS INTEGER) AS country_code,
         c.c_mktsegment AS hobby
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
    "friends": """friends AS (
  SELECT CAST(l.l_orderkey AS BIGINT) AS friend_rel, CAST(o.o_custkey - o.o_custkey % 2 AS BIGINT) AS person_id,
         CAST(l.l_suppkey AS BIGINT) AS my_friend, CAST(o.o_orderdate AS DATE) AS date_of_friendship,
         o.o_orderpriority AS descr
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)""",
    "access_log": """access_log AS (
  SELECT CAST(event_id AS BIGINT) AS access_id, CAST(user_id AS BIGINT) AS by_who,
         TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) AS what_page,
         event_type AS type_of_access, ts AS access_time
  FROM events)""",
    "attendees": """attendees AS (
  SELECT CAST(event_id AS BIGINT) AS id, 'P' || CAST(event_id AS VARCHAR) AS name,
         CAST(user_id AS BIGINT) AS "table",
         CASE WHEN event_type = 'error' AND value > 200 THEN 'sick' ELSE 'not-sick' END AS test
  FROM events)""",
    "access_log_text": """access_log_text AS (
  SELECT json_extract_string(props, '$.k') AS what_page FROM events)""",
    "access_log_unowned": """access_log_unowned AS (
  SELECT * REPLACE (CASE WHEN what_page % 5 = 0 THEN -what_page - 1 ELSE what_page END AS what_page)
  FROM access_log)""",
    "access_log_lines": """access_log_lines AS (
  SELECT CASE WHEN access_id % 13 = 7 THEN short
              ELSE short || ',' || CASE WHEN what_page % 7 = 5 THEN '' ELSE coalesce(CAST(what_page AS VARCHAR), '') END
                         || ',' || coalesce(type_of_access, '') END AS value
  FROM (SELECT *, coalesce(CAST(access_id AS VARCHAR), '') || ',' || CASE WHEN by_who % 11 = 3 THEN 'user' ELSE '' END
               || coalesce(CAST(by_who AS VARCHAR), '') AS short FROM access_log))""",
    "reports": """reports AS (
  SELECT CAST(event_id AS BIGINT) AS id, CASE WHEN value > 200 THEN 'sick' ELSE 'recovered' END AS test
  FROM events WHERE event_type = 'error')""",
    "points": """points AS (
  SELECT CAST(floor(l_quantity) AS BIGINT) AS x,
         CAST(floor(l_extendedprice / 1000) AS BIGINT) AS y
  FROM lineitem)""",
}


def with_views(views: dict[str, str], names: list[str], *ctes: str, body: str) -> str:
    parts = [views[n] for n in names] + list(ctes)
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body


TOP = """top AS (
  SELECT what_page AS page_id, count(*) AS access_count FROM {log}
  WHERE what_page IS NOT NULL GROUP BY what_page
  ORDER BY access_count DESC, page_id ASC LIMIT {k})"""

FC = """fc AS (SELECT person_id, count(*) AS num_friends FROM friends
  WHERE person_id IS NOT NULL GROUP BY person_id)"""

NEVER = """never AS (
  SELECT DISTINCT f.person_id, f.my_friend AS friend_id,
         'NEVER ACCESSED FRIEND ' || CAST(f.my_friend AS VARCHAR) AS message
  FROM friends f
  WHERE f.person_id IS NOT NULL AND f.my_friend IS NOT NULL
    AND NOT EXISTS (SELECT 1 FROM access_log a
                    WHERE a.by_who = f.person_id AND a.what_page = f.my_friend))"""

DISCONNECTED = """disc AS (
  SELECT by_who FROM (SELECT by_who, max(access_time) AS last_time FROM access_log
                      WHERE by_who IS NOT NULL GROUP BY by_who) t
  WHERE last_time IS NULL
     OR last_time < (SELECT max(access_time) FROM access_log) - INTERVAL {days} DAY)"""


def social_sql(views: dict[str, str] = VIEWS) -> dict[str, str]:
    k = P.TOP_K
    top = TOP.format(k=k, log="access_log")
    top_unowned = TOP.format(k=k, log="access_log_unowned")
    q = {}
    q["people_by_nationality"] = with_views(views, ["people"], body=(
        f"SELECT name, hobby FROM people WHERE nationality = '{P.NATIONALITY}'"))
    q["top_pages"] = with_views(views, ["access_log"], top, body="SELECT page_id, access_count FROM top")
    q["top_pages_details"] = with_views(views, ["people", "access_log"], top, body=(
        "SELECT t.page_id, p.name, p.nationality FROM top t JOIN people p ON p.person_id = t.page_id"))
    q["top_pages_details_outer"] = with_views(views, ["people", "access_log", "access_log_unowned"], top_unowned, body=(
        "SELECT t.page_id, coalesce(struct_extract(q.o, 'name'), 'Unknown') AS name, "
        "coalesce(struct_extract(q.o, 'nationality'), 'Unknown') AS nationality "
        "FROM top t LEFT JOIN (SELECT person_id, min({'name': name, 'nationality': nationality}) AS o "
        "FROM people GROUP BY person_id) q ON q.person_id = t.page_id"))
    q["top_pages_text"] = with_views(views, ["access_log_text"], body=(
        "SELECT what_page, count(*) AS access_count FROM access_log_text "
        "WHERE what_page <> '' AND regexp_full_match(what_page, '[\\x20-\\x7E]*') "
        f"GROUP BY what_page ORDER BY access_count DESC, what_page ASC LIMIT {k}"))
    q["access_log_rejects"] = with_views(views, ["access_log"], body=(
        "SELECT count(*) AS rejected FROM access_log WHERE by_who IS NULL OR what_page IS NULL"))
    q["access_log_reject_reasons"] = with_views(views, ["access_log", "access_log_lines"], (
        "f AS (SELECT TRY_CAST(split_part(value, ',', 2) AS BIGINT) AS who, "
        "TRY_CAST(split_part(value, ',', 3) AS BIGINT) AS page FROM access_log_lines)"), body=(
        "SELECT 'clean' AS reason, count(*) AS n FROM f WHERE who IS NOT NULL AND page IS NOT NULL "
        "UNION ALL SELECT 'by_who', count(*) FROM f WHERE who IS NULL "
        "UNION ALL SELECT 'what_page', count(*) FROM f WHERE who IS NOT NULL AND page IS NULL"))
    q["people_per_country_code"] = with_views(views, ["people"], body=(
        "SELECT country_code, count(*) AS n FROM people "
        "WHERE country_code BETWEEN 1 AND 50 GROUP BY country_code"))
    q["people_per_nationality"] = with_views(views, ["people"], body=(
        "SELECT nationality, count(*) AS n FROM people GROUP BY nationality"))
    q["connectedness"] = with_views(views, ["people", "friends"], body=(
        "SELECT person_id, CAST(sum(one) AS BIGINT) AS factor FROM ("
        "SELECT person_id, 0 AS one FROM people UNION ALL "
        "SELECT my_friend AS person_id, 1 AS one FROM friends) u "
        "WHERE person_id IS NOT NULL GROUP BY person_id"))
    q["connectedness_named"] = with_views(views, ["people", "friends"], body=(
        "SELECT p.name, CAST(coalesce(c.n, 0) AS BIGINT) AS factor FROM people p LEFT JOIN "
        "(SELECT my_friend, count(*) AS n FROM friends WHERE my_friend IS NOT NULL "
        "GROUP BY my_friend) c ON p.person_id = c.my_friend"))
    q["access_profile"] = with_views(views, ["access_log"], body=(
        "SELECT by_who, count(*) AS total, count(DISTINCT what_page) AS distinct_pages "
        "FROM access_log WHERE by_who IS NOT NULL GROUP BY by_who"))
    q["access_profile_named"] = with_views(views, ["people", "access_log"], body=(
        "SELECT p.name, a.total, a.distinct_pages FROM "
        "(SELECT by_who, count(*) AS total, count(DISTINCT what_page) AS distinct_pages "
        "FROM access_log WHERE by_who IS NOT NULL GROUP BY by_who) a "
        "JOIN people p ON a.by_who = p.person_id"))
    q["friends_never_accessed"] = with_views(views, ["friends", "access_log"], NEVER, body=(
        "SELECT person_id, friend_id, message FROM never"))
    q["people_ignoring_a_friend"] = with_views(views, ["people", "friends", "access_log"], NEVER, body=(
        "SELECT p.person_id, p.name FROM people p "
        "WHERE p.person_id IN (SELECT person_id FROM never)"))
    disc = DISCONNECTED.format(days=P.INACTIVE_DAYS)
    q["disconnected_users"] = with_views(views, ["access_log"], disc, body="SELECT by_who FROM disc")
    q["matching_people"] = with_views(views, ["people", "access_log"], disc, body=(
        "SELECT p.person_id, p.name FROM people p WHERE p.person_id IN (SELECT by_who FROM disc)"))
    q["isolated_inactive_people"] = with_views(views, ["people", "friends", "access_log"], body=(
        "SELECT p.person_id, p.name FROM people p "
        "WHERE p.person_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM friends f WHERE f.person_id = p.person_id) "
        "AND NOT EXISTS (SELECT 1 FROM access_log a WHERE a.by_who = p.person_id AND "
        f"a.access_time > (SELECT max(access_time) FROM access_log) - INTERVAL {P.INACTIVE_DAYS} DAY)"))
    q["friend_counts"] = with_views(views, ["friends"], FC, body="SELECT person_id, num_friends FROM fc")
    q["friend_count_report"] = with_views(views, ["friends"], FC, body=(
        "SELECT 'USER_' || CAST(person_id AS VARCHAR) AS label, num_friends AS value FROM fc "
        "UNION ALL SELECT 'Average Friendships' AS label, "
        "CAST(coalesce(sum(num_friends) // count(*), 0) AS BIGINT) AS value FROM fc"))
    q["access_profile_merged"] = q["access_profile"]
    q["rolling_access_profile"] = with_views(views, ["access_log"], (
        "v AS (SELECT by_who, CAST(access_time AS DATE) AS day, what_page FROM access_log "
        "WHERE by_who IS NOT NULL AND access_time IS NOT NULL)"), (
        "ends AS (SELECT DISTINCT by_who, day FROM v)"), body=(
        "SELECT e.by_who, e.day, count(*) AS total, count(DISTINCT v.what_page) AS distinct_pages FROM ends e "
        f"JOIN v ON v.by_who = e.by_who AND v.day > e.day - {P.ROLLING_DAYS} AND v.day <= e.day GROUP BY e.by_who, e.day"))
    q["friends_never_accessed_bucketed"] = q["friends_never_accessed"]
    q["people_ignoring_a_friend_bucketed"] = q["people_ignoring_a_friend"]
    q["disconnected_by_period"] = with_views(views, ["access_log"], (
        "span AS (SELECT CAST(min(access_time) AS DATE) AS a, CAST(max(access_time) AS DATE) AS b FROM access_log)"), (
        f"periods AS (SELECT a + CAST((i + 1) * ((b - a) // {P.STATE_MERGES} + 1) AS INTEGER) - 1 AS as_of "
        f"FROM span, range({P.STATE_MERGES}) t(i))"), (
        "known AS (SELECT p.as_of, l.by_who, max(l.access_time) AS last_time FROM periods p JOIN access_log l "
        "ON CAST(l.access_time AS DATE) <= p.as_of OR l.access_time IS NULL GROUP BY p.as_of, l.by_who)"), body=(
        "SELECT k.as_of, k.by_who FROM known k JOIN (SELECT as_of, max(last_time) AS latest FROM known GROUP BY as_of) m "
        "ON k.as_of = m.as_of WHERE k.by_who IS NOT NULL "
        f"AND (k.last_time IS NULL OR k.last_time < m.latest - INTERVAL {P.INACTIVE_DAYS} DAY)"))
    q["adjacency_chunks"] = with_views(views, ["friends"], body=(
        f"SELECT person_id, CAST(floor(my_friend / {P.CHUNK_WIDTH}) AS BIGINT) AS chunk, "
        "count(DISTINCT my_friend) AS n_friends, count(*) AS n FROM friends WHERE person_id IS NOT NULL "
        f"GROUP BY person_id, CAST(floor(my_friend / {P.CHUNK_WIDTH}) AS BIGINT)"))
    q["friend_count_report_chunked"] = q["friend_count_report"]
    q["popular_people"] = with_views(views, ["people", "friends"], FC, body=(
        "SELECT trim(p.name) AS name, fc.num_friends AS friend_count FROM fc "
        "JOIN people p ON fc.person_id = p.person_id "
        "WHERE CAST(fc.num_friends AS DOUBLE) > "
        "(SELECT CAST(sum(num_friends) AS DOUBLE) / CAST(count(*) AS DOUBLE) FROM fc)"))
    return q


def health_sql(views: dict[str, str] = VIEWS) -> dict[str, str]:
    q = {}
    q["sick_attendees"] = with_views(views, ["attendees"], body=(
        "SELECT id, name, \"table\", test FROM attendees WHERE test = 'sick'"))
    full = "concat_ws(',', CAST(id AS VARCHAR), name, CAST(\"table\" AS VARCHAR)"
    q["event_outputs"] = with_views(views, ["attendees"], body=(
        f"SELECT 'attendees' AS output, {full}, test) AS value FROM attendees "
        f"UNION ALL SELECT 'no_disclosure', {full}) FROM attendees "
        "UNION ALL SELECT 'reports', CAST(id AS VARCHAR) || ',sick' FROM attendees WHERE test = 'sick'"))
    q["sick_attendee_tables"] = with_views(views, ["attendees", "reports"], body=(
        "SELECT a.id, a.\"table\" FROM attendees a JOIN reports r ON a.id = r.id "
        "WHERE r.test = 'sick'"))
    q["healthy_at_sick_table"] = with_views(views, ["attendees"], body=(
        "SELECT id, name FROM attendees WHERE test = 'not-sick' AND \"table\" IN "
        "(SELECT \"table\" FROM attendees WHERE test = 'sick')"))
    q["table_health"] = with_views(views, ["attendees"], body=(
        "SELECT \"table\", count(*) AS n, CASE WHEN bool_and(lower(trim(test)) = 'not-sick') "
        "THEN 'healthy' ELSE 'concern' END AS flag FROM attendees "
        "WHERE \"table\" IS NOT NULL AND test IS NOT NULL AND trim(test) <> '' "
        "GROUP BY \"table\""))
    q["healthy_at_risk"] = with_views(views, ["attendees", "reports"], body=(
        "SELECT a.id, a.name, a.\"table\" FROM attendees a "
        "WHERE a.\"table\" IN (SELECT b.\"table\" FROM attendees b "
        "WHERE b.id IN (SELECT id FROM reports WHERE id IS NOT NULL)) "
        "AND NOT EXISTS (SELECT 1 FROM reports r WHERE r.id = a.id)"))
    return q


# --- k-means ---------------------------------------------------------------------

def _dist(px: str, py: str, cx: str, cy: str) -> str:
    return f"sqrt(({px} - {cx}) * ({px} - {cx}) + ({py} - {cy}) * ({py} - {cy}))"


def _kmeans_ctes(seeds, steps: int, tol: float | None) -> list[str]:
    """The loop as a recursive CTE: allc holds every step's centres, with
    conv telling whether that step ended the run; fin the final centres."""
    vals = ", ".join(f"({i}, CAST({x!r} AS DOUBLE), CAST({y!r} AS DOUBLE))"
                     for i, (x, y) in enumerate(seeds))
    moved = _dist("o.x", "o.y", "n.x", "n.y")
    near = f"bool_and({moved} <= {tol!r}) OVER () AND count(*) OVER () = o.k" if tol is not None else "false"
    return [
        "pts AS (SELECT x, y, count(*) AS w FROM points "
        "WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY x, y)",
        f"c0 AS (SELECT CAST(id AS INTEGER) AS id, x, y FROM (VALUES {vals}) AS t(id, x, y))",
        "allc AS (SELECT 0 AS i, id, x, y, CAST(NULL AS BIGINT) AS n, false AS conv FROM c0 "
        "UNION ALL "
        f"SELECT o.i + 1, n.id, n.x, n.y, n.n, {near} FROM ("
        "SELECT id, CAST(sum(x * w) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS x, "
        "CAST(sum(y * w) AS DOUBLE) / CAST(sum(w) AS DOUBLE) AS y, CAST(sum(w) AS BIGINT) AS n FROM ("
        "SELECT p.x, p.y, p.w, c.id, row_number() OVER ("
        f"PARTITION BY p.x, p.y ORDER BY {_dist('p.x', 'p.y', 'c.x', 'c.y')}, c.id) AS rn "
        "FROM pts p CROSS JOIN allc c) a WHERE rn = 1 GROUP BY id) n "
        "JOIN (SELECT *, count(*) OVER () AS k FROM allc) o ON o.id = n.id "
        f"WHERE NOT o.conv AND o.i < {steps})",
        "stop AS (SELECT max(i) AS j, bool_or(conv) AS converged FROM allc)",
        "fin AS (SELECT a.id, a.x, a.y, CAST(s.j AS INTEGER) AS iterations, s.converged "
        "FROM allc a CROSS JOIN stop s WHERE a.i = s.j - CAST(s.converged AS INTEGER))",
    ]


def kmeans_sql(views: dict[str, str] = VIEWS) -> dict[str, str]:
    seeds = P.SEEDS
    q = {}
    q["kmeans_step"] = with_views(views, ["points"], *_kmeans_ctes(seeds, 1, None),
                                  body="SELECT id, x, y, n FROM allc WHERE i = 1")
    q["kmeans_iterate"] = with_views(views, ["points"], *_kmeans_ctes(seeds, P.KMEANS_STEPS, None),
                                     body="SELECT id, x, y FROM fin")
    early = _kmeans_ctes(seeds, P.KMEANS_MAX_STEPS, P.KMEANS_TOL)
    body = "SELECT id, x, y, iterations, converged FROM fin"
    q["kmeans_early_stop"] = with_views(views, ["points"], *early, body=body)
    q["kmeans_partial_agg"] = with_views(views, ["points"], *early, body=body)
    q["kmeans_centers_report"] = with_views(views, ["points"], *early,
                                            body="SELECT id, x, y, converged FROM fin")
    q["kmeans_history"] = with_views(views, ["points"], *early, body=(
        "SELECT CAST(i - 1 AS INTEGER) AS iteration, id, x, y, n FROM allc WHERE i >= 1"))
    q["kmeans_assignments"] = with_views(views, ["points"], *early, (
        "asg AS (SELECT x, y, id, cx, cy FROM (SELECT p.x, p.y, c.id, c.x AS cx, c.y AS cy, "
        f"row_number() OVER (PARTITION BY p.x, p.y ORDER BY {_dist('p.x', 'p.y', 'c.x', 'c.y')}, c.id) "
        "AS rn FROM pts p CROSS JOIN fin c) t WHERE rn = 1)"), body=(
        "SELECT r.x, r.y, a.id, a.cx, a.cy FROM points r JOIN asg a ON r.x = a.x AND r.y = a.y"))
    step1 = _kmeans_ctes(seeds, 1, None)
    q["centroid_shift"] = with_views(views, ["points"], *step1, (
        "sh AS (SELECT CAST(coalesce(o.id, n.id) AS INTEGER) AS id, "
        f"{_dist('o.x', 'o.y', 'n.x', 'n.y')} AS shift FROM c0 o FULL OUTER JOIN (SELECT * FROM allc WHERE i = 1) n ON o.id = n.id)"),
        body=(f"SELECT id, shift, (SELECT coalesce(bool_and(coalesce(shift <= {P.KMEANS_TOL!r}, false)), "
              "false) FROM sh) AS converged FROM sh"))
    q["nearest_of_many"] = with_views(views, ["points"], (
        "places AS (SELECT x, y, count(*) AS w FROM points WHERE x IS NOT NULL AND y IS NOT NULL GROUP BY x, y)"), (
        "many AS (SELECT CAST(row_number() OVER (ORDER BY w DESC, x, y) - 1 AS INTEGER) AS id, CAST(x AS DOUBLE) AS cx, "
        f"CAST(y AS DOUBLE) AS cy FROM places ORDER BY w DESC, x, y LIMIT {P.MANY_CENTRES})"), (
        "every AS (SELECT p.x, p.y, p.w, c.id, c.cx, c.cy, sqrt((p.x - c.cx) * (p.x - c.cx) + (p.y - c.cy) * (p.y - c.cy)) AS dist "
        "FROM places p CROSS JOIN many c)"), (
        "best AS (SELECT x, y, any_value(w) AS w, min({'dist': dist, 'id': id, 'cx': cx, 'cy': cy}) AS b FROM every GROUP BY x, y)"), body=(
        "SELECT b.id AS id, any_value(b.cx) AS cx, any_value(b.cy) AS cy, CAST(sum(w) AS BIGINT) AS n, max(b.dist) AS farthest "
        "FROM best GROUP BY b.id"))
    return q


def all_sql(views: dict[str, str] = VIEWS) -> dict[str, str]:
    """Every statement; ``views`` may replace the table definitions (e.g. to
    run the same statements over other tables with the library's columns)."""
    out = {}
    out.update(social_sql(views))
    out.update(health_sql(views))
    out.update(kmeans_sql(views))
    return out
