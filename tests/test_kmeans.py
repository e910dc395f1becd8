"""k-means rules checked against a brute-force
Python implementation on small fixtures."""

import math
import random

import pytest

from conftest import rows
from tidepool.plans import kmeans as M
from tidepool.sources import readers

PTS = "x BIGINT, y BIGINT"


def brute_step(points, centres, empty="drop"):
    acc = {}
    for x, y in points:
        best = None
        for cid, cx, cy in sorted(centres):
            d = math.sqrt((x - cx) * (x - cx) + (y - cy) * (y - cy))
            if best is None or d < best[0]:
                best = (d, cid)
        s = acc.setdefault(best[1], [0, 0, 0])
        s[0] += x
        s[1] += y
        s[2] += 1
    out = {cid: (cid, sx / n, sy / n) for cid, (sx, sy, n) in acc.items()}
    if empty == "keep":
        for c in centres:
            out.setdefault(c[0], c)
    return [out[k] for k in sorted(out)]


def brute_early(points, seeds, steps, tol):
    cur = list(seeds)
    for i in range(steps):
        new = brute_step(points, cur)
        same = {c[0] for c in cur} == {c[0] for c in new}
        if same and all(math.sqrt((a[1] - b[1]) ** 2 + (a[2] - b[2]) ** 2) <= tol
                        for a, b in zip(cur, new)):
            return cur, i + 1, True
        cur = new
    return cur, steps, False


def fixture_points(n=400, seed=7):
    rnd = random.Random(seed)
    pts = [(rnd.randint(0, 60), rnd.randint(0, 60)) for _ in range(n)]
    return pts + pts[:50]  # duplicates


SEEDS = [(0, 5.0, 5.0), (1, 50.0, 10.0), (2, 30.0, 55.0), (3, 1000.0, 1000.0)]


def seeds_df(spark, seeds=SEEDS):
    return spark.createDataFrame(seeds, "id INT, x DOUBLE, y DOUBLE")


def test_step_matches_brute_force_and_drops_empty(spark):
    pts = fixture_points()
    got = rows(M.kmeans_step(spark.createDataFrame(pts, PTS), seeds_df(spark)), "id", "x", "y")
    want = brute_step(pts, SEEDS)
    assert got == want and 3 not in [g[0] for g in got]


def test_tie_goes_to_lowest_id(spark):
    pts = spark.createDataFrame([(5, 0)], PTS)
    seeds = seeds_df(spark, [(0, 0.0, 0.0), (1, 10.0, 0.0)])
    assert rows(M.kmeans_step(pts, seeds), "id") == [(0,)]
    seeds_rev = seeds_df(spark, [(1, 0.0, 0.0), (0, 10.0, 0.0)])
    assert rows(M.kmeans_step(pts, seeds_rev), "id") == [(0,)]


def test_early_stop_and_partial_agg_agree_with_brute_force(spark):
    pts = fixture_points()
    df = spark.createDataFrame(pts, PTS)
    m3 = rows(M.kmeans_early_stop(df, seeds_df(spark), 20, 0.001))
    m4 = rows(M.kmeans_partial_agg(df, seeds_df(spark), 20, 0.001))
    assert m3 == m4
    cur, it, conv = brute_early(pts, SEEDS, 20, 0.001)
    assert [(r[0], r[1], r[2]) for r in m3] == cur
    assert all(r[3] == it and r[4] == conv for r in m3)


def test_iterate_exact_steps_and_history(spark):
    pts = fixture_points()
    df = spark.createDataFrame(pts, PTS)
    cur = SEEDS
    for _ in range(3):
        cur = brute_step(pts, cur)
    assert rows(M.kmeans_iterate(df, seeds_df(spark), 3)) == cur
    hist = rows(M.kmeans_history(df, seeds_df(spark), 3, tol=None), "iteration", "id", "x", "y")
    assert [(h[1], h[2], h[3]) for h in hist if h[0] == 2] == cur


def test_keep_empty_clusters(spark):
    pts = fixture_points()
    df = spark.createDataFrame(pts, PTS)
    got = rows(M.kmeans_iterate(df, seeds_df(spark), 2, empty="keep"))
    want = brute_step(pts, brute_step(pts, SEEDS, "keep"), "keep")
    assert got == want and got[-1] == (3, 1000.0, 1000.0)


def test_cost_non_increasing(spark):
    pts = fixture_points()
    df = spark.createDataFrame(pts, PTS)

    def cost(cs):
        return sum(min((x - a) ** 2 + (y - b) ** 2 for _, a, b in cs) for x, y in pts)

    hist = rows(M.kmeans_history(df, seeds_df(spark), 5, tol=None), "iteration", "id", "x", "y")
    costs = [cost([(h[1], h[2], h[3]) for h in hist if h[0] == i]) for i in range(5)]
    assert all(b <= a + 1e-6 for a, b in zip(costs, costs[1:]))


def test_assignments_are_argmin_with_duplicates(spark):
    pts = fixture_points()
    df = spark.createDataFrame(pts, PTS)
    got = rows(M.kmeans_assignments(df, seeds_df(spark)), "x", "y", "id", "cx", "cy")
    assert len(got) == len(pts)
    pos = {c[0]: c for c in SEEDS}
    want = []
    for x, y in pts:
        cid = min(SEEDS, key=lambda c: (math.sqrt((x - c[1]) ** 2 + (y - c[2]) ** 2), c[0]))[0]
        want.append((x, y, cid, pos[cid][1], pos[cid][2]))
    assert got == sorted(want)


def test_centroid_shift(spark):
    old = seeds_df(spark, [(0, 0.0, 0.0), (1, 5.0, 5.0)])
    same = seeds_df(spark, [(0, 0.0, 0.0005), (1, 5.0, 5.0)])
    moved = seeds_df(spark, [(0, 3.0, 4.0)])
    a = rows(M.centroid_shift(old, same))
    assert [r[2] for r in a] == [True, True]
    b = rows(M.centroid_shift(old, moved))
    assert b == [(0, 5.0, False), (1, None, False)]


def test_zero_seeds_raise(spark):
    df = spark.createDataFrame([(1, 1)], PTS)
    empty = spark.createDataFrame([], "id INT, x DOUBLE, y DOUBLE")
    with pytest.raises(ValueError):
        M.kmeans_step(df, empty)


def test_seed_files_in_both_layouts(spark, tmp_dir):
    import os
    plain = os.path.join(tmp_dir, "seeds.csv")
    tabbed = os.path.join(tmp_dir, "centroids.txt")
    with open(plain, "w") as f:
        f.write("10,20\n40,20\n\n10,80\n")
    with open(tabbed, "w") as f:
        f.write("3\t1.5,2.5\n7\t4.0,5.0\n")
    assert rows(readers.read_seeds(spark, plain)) == [(0, 10.0, 20.0), (1, 40.0, 20.0),
                                                      (2, 10.0, 80.0)]
    assert rows(readers.read_seeds(spark, tabbed)) == [(3, 1.5, 2.5), (7, 4.0, 5.0)]


def test_many_centres(spark):
    pts = fixture_points(200)
    df = spark.createDataFrame(pts, PTS)
    seeds = [(i, float(i % 9) * 7, float(i // 9) * 7) for i in range(81)]
    got = rows(M.kmeans_step(df, seeds_df(spark, seeds)), "id", "x", "y")
    assert got == brute_step(pts, seeds)


def test_step_plan_is_partial_aggregate_without_python(spark):
    df = spark.createDataFrame(fixture_points(), PTS)
    plan = M.kmeans_step(df, seeds_df(spark))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan
    assert "Python" not in plan and "Join" not in plan


def test_bad_centres_raise(spark):
    df = spark.createDataFrame([(1, 1)], PTS)
    for bad in ([(0, 0.0, 0.0), (0, 1.0, 1.0)], [(None, 0.0, 0.0)], [(0, None, 0.0)], [(0, float("nan"), 0.0)]):
        with pytest.raises(ValueError):
            M.kmeans_step(df, seeds_df(spark, bad))


def test_nan_and_null_points_take_no_part(spark):
    pts = [(1.0, 1.0), (float("nan"), 2.0), (3.0, float("nan")), (None, 1.0), (3.0, 3.0)]
    df = spark.createDataFrame(pts, "x DOUBLE, y DOUBLE")
    seeds = seeds_df(spark, [(0, 0.0, 0.0)])
    assert rows(M.kmeans_step(df, seeds)) == [(0, 2.0, 2.0, 2)]
    assert rows(M.kmeans_iterate(df, seeds, 2)) == [(0, 2.0, 2.0)]
    assert M.kmeans_assignments(df, seeds).count() == 2


def test_every_seed_line_counts(spark, tmp_dir):
    import os
    for name, last in (("old", "1,1"), ("new", "9,9")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write("0,0\n" * 100_004 + last + "\n")
    old = readers.read_seeds(spark, os.path.join(tmp_dir, "old"))
    new = readers.read_seeds(spark, os.path.join(tmp_dir, "new"))
    assert old.count() == 100_005 and old.agg({"id": "max"}).first()[0] == 100_004
    assert M.centroid_shift(old, new, 0.5).where("converged").count() == 0


def test_seed_folder_in_order_of_file_names(spark, tmp_dir):
    import os
    for name, line in (("part-0", "1,1"), ("part-1", "2,2\n3,3\n4,4"), ("part-2", "5,5")):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(line + "\n")
    assert rows(readers.read_seeds(spark, tmp_dir)) == [(i, i + 1.0, i + 1.0) for i in range(5)]


def test_collapse_gives_the_same_result_and_steps_read_the_cache(spark):
    df = spark.createDataFrame(fixture_points(), PTS)
    plain = M.run_kmeans(df, seeds_df(spark), 20)
    assert M.run_kmeans(df, seeds_df(spark), 20, collapse=True) == plain and plain.converged
    for collapse in (False, True):
        wp = M.prepare_points(df, collapse)
        plan = M.step_frame(wp, SEEDS)._jdf.queryExecution().executedPlan().toString()
        wp.unpersist()
        assert "InMemoryTableScan" in plan and "Coalesce" not in plan


def test_bounds_change_nothing_and_save_distances(spark):
    rnd = random.Random(11)
    pts = [(rnd.gauss(cx, 6), rnd.gauss(cy, 6)) for cx, cy in ((0, 0), (60, 0), (0, 60), (60, 60)) for _ in range(150)]
    pts += [(30.0, 30.0)] * 40 + [(30.0, 0.0)] * 10  # ties while the centres are symmetric
    df = spark.createDataFrame(pts, "x DOUBLE, y DOUBLE")
    seeds = [(0, -5.0, 3.0), (1, 20.0, 20.0), (2, 5.0, 40.0), (3, 55.0, 35.0), (4, 900.0, 900.0)]
    res = M.run_kmeans(df, seeds_df(spark, seeds), 25)
    cur, steps = list(seeds), 0
    for _ in range(25):
        new = brute_step(pts, cur)
        steps += 1
        got = [h for h in res.history if h[0] == steps - 1]
        assert [h[1] for h in got] == [c[0] for c in new]
        assert all(abs(h[2] - c[1]) < 1e-9 and abs(h[3] - c[2]) < 1e-9 for h, c in zip(got, new))
        if M.has_converged(cur, new, M.DEFAULT_TOL):
            break
        cur = new
    assert (res.iterations, res.converged) == (steps, True)
    assert len(res.compared) == steps and res.compared[0] == len(pts)
    assert min(res.compared) < len(pts) / 3 and sum(res.compared) < 0.8 * steps * len(pts)


def test_bounds_with_one_centre_and_with_ties(spark):
    df = spark.createDataFrame([(0, 0), (2, 0), (4, 0)] * 5, PTS)
    one = M.run_kmeans(df, seeds_df(spark, [(7, 1.0, 1.0)]), 4, tol=None)
    assert one.centres == [(7, 2.0, 0.0)]
    tie = M.run_kmeans(df, seeds_df(spark, [(3, 0.0, 0.0), (1, 4.0, 0.0)]), 1, tol=None)
    assert [h[1:] for h in tie.history] == [(1, 3.0, 0.0, 10), (3, 0.0, 0.0, 5)]


def test_grid_equals_all_distances(spark):
    from tidepool.operators import grid
    rnd = random.Random(4)
    pts = [(rnd.choice([rnd.randint(-20, 20), rnd.gauss(0, 300)]), float(rnd.randint(-20, 20))) for _ in range(400)]
    odd = [(None, 1.0), (float("nan"), 1.0), (float("inf"), 0.0)]
    for centres in ([(5, 1.0, 1.0)], [(i, float(rnd.randint(-20, 20)), float(rnd.randint(-20, 20))) for i in range(300)],
                    [(i, 0.0, float(i % 7)) for i in range(40)]):
        df = spark.createDataFrame([(float(x) if x is not None else None, y) for x, y in pts + odd], "x DOUBLE, y DOUBLE")
        out = grid.with_nearest(df, centres).collect()
        assert len(out) == len(pts)
        for r in out:
            best = min((math.sqrt((r.x - cx) * (r.x - cx) + (r.y - cy) * (r.y - cy)), i) for i, cx, cy in centres)
            assert (r.nearest.dist, r.nearest.id) == best
    assert grid.with_nearest(df.where("x > 1e9 and x < 1e10"), [(0, 1.0, 1.0)]).count() == 0
    with pytest.raises(ValueError):
        grid.with_nearest(df, [])
