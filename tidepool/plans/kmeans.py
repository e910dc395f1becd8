"""Two-dimensional k-means (M1-M7).

Shape of every step: each point picks its nearest centre with one
``least`` over the k current centres, constants of the plan (a
projection -- no join, no shuffle of points); a ``groupBy(id)`` with sum/count
gives the new means. Partial aggregation leaves at most k rows per map task,
so the shuffle per step is k x tasks rows however skewed the clusters are.
Only the k new centres travel to the driver between steps.

Points are prepared once and persisted, in the partitions of their scan: a
lost block is recomputed from the source files. ``collapse=True`` first groups
equal points into one with a weight ``w``, which pays where coordinates repeat
heavily; its shuffle is cut off by a checkpoint in the shared folder
(``spark.checkpoint.dir``), which is what is then persisted and read.

The loop skips most distances by exact bounds. At an anchor step every point is
compared with every centre and kept (persisted, straight from the points) with
its centre, the distance u to it and the distance l to the next one. When the
centres have since drifted by m(id), its centre is at most u + m(id) away and any
other at least l - max m(others); only points for which these cross are compared
again. When more than ``REANCHOR`` of the points were, the next step is an
anchor. Results are those of comparing everything, ties included: bounds must
clear each other by more than rounding.

Rules (fixed by the reference's intent):
* centre ids are the seed positions and stay stable across steps;
* ties go to the lowest id;
* points with a NULL or NaN coordinate take no part;
* a centre that attracts no point disappears (``empty='drop'``) or keeps
  its position (``empty='keep'``);
* converged when the id set is unchanged and every centre moved <= tol;
  the early-stopping job then returns the centres *before* that step.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import expressions as X
from tidepool.session import ensure_checkpoint_dir

DEFAULT_TOL = 0.001

Centres = list  # list[tuple[int, float, float]]


def centres_of(df: DataFrame) -> Centres:
    """Collect a centre DataFrame (id, x, y): k rows. Raises when there is no
    centre, an id or coordinate is missing, or an id occurs twice."""
    rows = df.select(F.col("id").cast("int"), F.col("x").cast("double"), F.col("y").cast("double")).collect()
    seen = set()
    for r in rows:
        if any(v is None or v != v for v in r):
            raise ValueError(f"centre with a missing id or coordinate: {tuple(r)}")
        if r[0] in seen:
            raise ValueError(f"centre id {r[0]} occurs twice")
        seen.add(r[0])
    if not rows:
        raise ValueError("k-means needs at least one seed")
    return sorted((int(r[0]), float(r[1]), float(r[2])) for r in rows)


def centres_frame(spark: SparkSession, centres) -> DataFrame:
    return spark.createDataFrame([(c[0], c[1], c[2]) for c in centres],
                                 "id INT, x DOUBLE, y DOUBLE")


def usable_points(points: DataFrame) -> DataFrame:
    """(x, y) of the points with two numbers for coordinates."""
    number = F.lit(True)
    for c in ("x", "y"):
        number = number & F.col(c).isNotNull() & ~F.isnan(F.col(c).cast("double"))
    return points.select("x", "y").where(number)


def prepare_points(points: DataFrame, collapse: bool = False) -> DataFrame:
    """Points (x, y) -> persisted (x, y, w); the caller unpersists."""
    pts = usable_points(points)
    if collapse:
        ensure_checkpoint_dir(points.sparkSession)
        pts = pts.groupBy("x", "y").agg(F.count(F.lit(1)).alias("w")).checkpoint(eager=True)
    else:
        pts = pts.withColumn("w", F.lit(1).cast("bigint"))
    return pts.persist()


def _step_sums(wpoints: DataFrame, centres: Centres) -> DataFrame:
    """Per nearest centre: weighted coordinate sums and point count
    (id, sx, sy, n) -- one projection and one partially aggregated
    ``groupBy``."""
    near = X.nearest_centre_id("x", "y", centres)
    return _sums(wpoints.select(near.alias("id"), "x", "y", "w", F.lit(True).alias("again")))


def _sums(assigned: DataFrame) -> DataFrame:
    """(id, sx, sy, n, compared) from (id, x, y, w, again): compared counts the
    rows whose distances were computed."""
    return assigned.groupBy("id").agg(
        F.sum(F.col("x") * F.col("w")).alias("sx"),
        F.sum(F.col("y") * F.col("w")).alias("sy"),
        F.sum("w").alias("n"), F.count_if("again").alias("compared"))


#: Share of compared rows above which the next step compares, and keeps, all.
REANCHOR = 0.25
#: Bounds must be apart by this share of their size, far above a distance's rounding.
SLACK = 1e-9


class BoundedSteps:
    """The assignments of successive centre sets to the same points."""

    def __init__(self, wpoints: DataFrame):
        self._points, self._kept, self._from, self._due = wpoints, None, [], True
        self.compared: list[int] = []  # rows whose distances were computed, per step
        self._rows = 0

    def sums(self, centres: Centres) -> list:
        """Rows (id, sx, sy, n, compared), one per centre that has points."""
        ids = [c[0] for c in centres]
        if self._due or ids != [c[0] for c in self._from]:
            self._anchor(centres)
            moved = self._kept.select("id", "x", "y", "w", F.lit(True).alias("again"))
        else:
            moved = self._moved(centres)
        rows = _sums(moved).collect()  # at most k rows
        self.compared.append(sum(r["compared"] for r in rows))
        self._rows = max(self._rows, self.compared[-1])
        self._due = len(self.compared) > 1 and self._from is not centres and self.compared[-1] > REANCHOR * self._rows
        return rows

    def _anchor(self, centres: Centres) -> None:
        self.close()
        near = self._points.select("x", "y", "w", X.nearest_centre_id("x", "y", centres).alias("id"))
        self._kept = near.withColumns({"u": X.distance_to("id", "x", "y", centres),
                                       "l": X.distance_to_others("id", "x", "y", centres)}).persist()
        self._from, self._due = centres, False

    def _moved(self, centres: Centres) -> DataFrame:
        drift = {cid: d for cid, d in shifts(self._from, centres).items()}
        others = {cid: max((d for o, d in drift.items() if o != cid), default=0.0) for cid in drift}
        upper, lower = F.col("u") + X.by_id("id", drift), F.col("l") - X.by_id("id", others)
        again = ~(upper * (1 + SLACK) < lower * (1 - SLACK))
        near = X.nearest_centre_id("x", "y", centres)
        return (self._kept.withColumn("again", again)
                .select(F.when(F.col("again"), near).otherwise(F.col("id")).alias("id"), "x", "y", "w", "again"))

    def close(self) -> None:
        if self._kept is not None:
            self._kept.unpersist()
            self._kept = None


def step_frame(wpoints: DataFrame, centres: Centres) -> DataFrame:
    """One assignment + mean step as a DataFrame (id, x, y, n)."""
    return _step_sums(wpoints, centres).select(
        F.col("id").cast("int").alias("id"),
        (F.col("sx").cast("double") / F.col("n").cast("double")).alias("x"),
        (F.col("sy").cast("double") / F.col("n").cast("double")).alias("y"),
        F.col("n").cast("bigint").alias("n"))


def _step(steps: BoundedSteps, centres: Centres, empty: str) -> list:
    """Run one step; the k result rows come to the driver, where the means
    are the same IEEE divisions Spark would do (float(sum) / float(n))."""
    new = {}
    for r in steps.sums(centres):
        cid, n = int(r["id"]), int(r["n"])
        new[cid] = (cid, float(r["sx"]) / float(n), float(r["sy"]) / float(n), n)
    if empty == "keep":
        for cid, cx, cy in centres:
            new.setdefault(cid, (cid, cx, cy, 0))
    return [new[k] for k in sorted(new)]


def shifts(old: Centres, new: Centres) -> dict:
    """id -> distance moved (None when the id is on one side only)."""
    o = {c[0]: c for c in old}
    n = {c[0]: c for c in new}
    out = {}
    for cid in sorted(set(o) | set(n)):
        if cid in o and cid in n:
            dx, dy = o[cid][1] - n[cid][1], o[cid][2] - n[cid][2]
            out[cid] = math.sqrt(dx * dx + dy * dy)
        else:
            out[cid] = None
    return out


def has_converged(old: Centres, new: Centres, tol: float) -> bool:
    s = shifts(old, new)
    return bool(s) and all(v is not None and v <= tol for v in s.values())


@dataclass
class KMeansResult:
    centres: list                      # [(id, x, y)]
    iterations: int                    # steps executed
    converged: bool
    history: list = field(default_factory=list)  # [(iteration, id, x, y, n)]
    compared: list = field(default_factory=list, compare=False)  # rows compared with all centres, per step


def run_kmeans(points: DataFrame, seeds: DataFrame, max_steps: int,
               tol: float | None = DEFAULT_TOL, empty: str = "drop",
               collapse: bool = False) -> KMeansResult:
    """Driver loop shared by M2-M5. ``tol=None`` runs exactly ``max_steps``."""
    if empty not in ("drop", "keep"):
        raise ValueError("empty must be 'drop' or 'keep'")
    cur = centres_of(seeds)
    wp = prepare_points(points, collapse)
    bounded = BoundedSteps(wp)
    history, converged, steps = [], False, 0
    try:
        for i in range(int(max_steps)):
            new4 = _step(bounded, cur, empty)
            steps = i + 1
            history.extend((i, c[0], c[1], c[2], c[3]) for c in new4)
            new = [(c[0], c[1], c[2]) for c in new4]
            if tol is not None and has_converged(cur, new, tol):
                converged = True
                break  # keep the centres from before this step
            cur = new
            if not cur:
                break
    finally:
        bounded.close()
        wp.unpersist()
    return KMeansResult(cur, steps, converged, history, bounded.compared)


# --- the jobs ------------------------------------------------------------------

def kmeans_step(points: DataFrame, seeds: DataFrame) -> DataFrame:
    """M1: one step from the seeds: new centres (id, x, y, n); a seed that
    attracts no point is absent. Fully lazy (the seeds are k rows); a single
    pass, so points are not collapsed first (that would add a shuffle)."""
    pts = usable_points(points)
    return step_frame(pts.withColumn("w", F.lit(1).cast("bigint")), centres_of(seeds))


def kmeans_iterate(points: DataFrame, seeds: DataFrame, steps: int,
                   empty: str = "drop") -> DataFrame:
    """M2: exactly ``steps`` steps; final centres (id, x, y)."""
    res = run_kmeans(points, seeds, steps, tol=None, empty=empty)
    return centres_frame(points.sparkSession, res.centres)


def _result_frame(spark: SparkSession, res: KMeansResult) -> DataFrame:
    return spark.createDataFrame(
        [(c[0], c[1], c[2], res.iterations, res.converged) for c in res.centres],
        "id INT, x DOUBLE, y DOUBLE, iterations INT, converged BOOLEAN")


def kmeans_early_stop(points: DataFrame, seeds: DataFrame, max_steps: int,
                      tol: float = DEFAULT_TOL, empty: str = "drop") -> DataFrame:
    """M3: up to ``max_steps`` steps, stopping once every centre moved <= tol.
    Output (id, x, y, iterations, converged)."""
    res = run_kmeans(points, seeds, max_steps, tol=tol, empty=empty)
    return _result_frame(points.sparkSession, res)


def kmeans_partial_agg(points: DataFrame, seeds: DataFrame, max_steps: int,
                       tol: float = DEFAULT_TOL, empty: str = "drop",
                       collapse: bool = False) -> DataFrame:
    """M4: M3 with map-side combined sums, which is how Spark runs every step
    here; with ``collapse`` equal points are combined before the loop too.
    Same result as M3."""
    res = run_kmeans(points, seeds, max_steps, tol=tol, empty=empty, collapse=collapse)
    return _result_frame(points.sparkSession, res)


def kmeans_centers_report(points: DataFrame, seeds: DataFrame, max_steps: int,
                          tol: float = DEFAULT_TOL, empty: str = "drop") -> DataFrame:
    """M5: final centres with the convergence indicator (id, x, y, converged).
    ``tidepool.sources.sinks.report_lines`` renders it as the text report."""
    return kmeans_partial_agg(points, seeds, max_steps, tol, empty).select(
        "id", "x", "y", "converged")


def kmeans_history(points: DataFrame, seeds: DataFrame, max_steps: int,
                   tol: float | None = DEFAULT_TOL, empty: str = "drop") -> DataFrame:
    """K9: the centres produced by every step (iteration, id, x, y, n)."""
    res = run_kmeans(points, seeds, max_steps, tol=tol, empty=empty)
    return points.sparkSession.createDataFrame(
        res.history, "iteration INT, id INT, x DOUBLE, y DOUBLE, n BIGINT")


def kmeans_assignments(points: DataFrame, centres: DataFrame) -> DataFrame:
    """M6: every point (duplicates kept) with its nearest centre: x, y, id,
    cx, cy. Map-only: the centres are a constant of the projection."""
    near = X.nearest_centre("x", "y", centres_of(centres))
    return (usable_points(points).select("x", "y", near.alias("_c"))
            .select("x", "y", F.col("_c.id").alias("id"), F.col("_c.x").alias("cx"), F.col("_c.y").alias("cy")))


def centroid_shift(old: DataFrame, new: DataFrame, tol: float = DEFAULT_TOL) -> DataFrame:
    """M7: per id the distance between two centre sets (NULL when the id is
    in one set only) and whether the whole set converged (every shift <= tol
    and the same ids). Both inputs are k-row centre sets."""
    o = old.select(F.col("id").alias("id"), F.col("x").alias("_ox"), F.col("y").alias("_oy"))
    n = new.select(F.col("id").alias("_nid"), F.col("x").alias("_nx"), F.col("y").alias("_ny"))
    j = o.join(n, o.id == n._nid, "full_outer")
    shifted = j.select(F.coalesce("id", "_nid").cast("int").alias("id"),
                       X.euclidean("_ox", "_oy", "_nx", "_ny").alias("shift"))
    ok = shifted.select(F.coalesce(F.bool_and(F.coalesce(F.col("shift") <= F.lit(tol),
                                                         F.lit(False))),
                                   F.lit(False))).scalar()
    return shifted.select("id", "shift", ok.alias("converged"))
