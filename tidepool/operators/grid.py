"""Nearest of many centres by a grid of cells.

The plane around the points and the centres is cut into cells. A centre is a
candidate of a cell unless it is certainly not the nearest to any point of it:
some centre is at most r from all of the cell, so the nearest centre of
any point in it is at most r away, and a centre whose least distance to the cell
exceeds r is out. Every other centre is a candidate, so the nearest is among
them, ties included. Only cells that hold points are worked out, in tasks that
get the centres broadcast (k rows, which the caller's ``max_centres`` bounds);
points meet their cell's candidates in an equi-join and pick the least
(distance, id). No row ever carries more than its cell's candidates, and a cell
that holds a third of all points is a join key whose point side adaptive
execution splits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def candidates(cells: DataFrame, centres: list[tuple[int, float, float]], box: tuple[float, float, float, float],
               side: int) -> DataFrame:
    """(cell, near): for each cell (i * side + j) its candidate centres (id, x, y)."""
    x0, y0, wide, high = box
    shared = cells.sparkSession.sparkContext.broadcast(np.array(centres, float))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = shared.value
        ids, cx, cy = c[:, 0].astype(int), c[:, 1], c[:, 2]
        for b in batches:
            near = []
            for cell in b["cell"]:
                i, j = divmod(int(cell), side)
                # Cells are taken a little wider, so that rounding at an edge loses nothing.
                left, right = x0 + (i - 0.001) * wide, x0 + (i + 1.001) * wide
                low, top = y0 + (j - 0.001) * high, y0 + (j + 1.001) * high
                far = np.hypot(np.maximum(abs(cx - left), abs(cx - right)), np.maximum(abs(cy - low), abs(cy - top)))
                least = np.hypot(np.maximum(0, np.maximum(left - cx, cx - right)), np.maximum(0, np.maximum(low - cy, cy - top)))
                keep = np.flatnonzero(least <= far.min() * (1 + 1e-9))
                near.append([{"id": int(ids[k]), "x": float(cx[k]), "y": float(cy[k])} for k in keep])
            yield pd.DataFrame({"cell": b["cell"], "near": near})

    return cells.select("cell").mapInPandas(run, "cell bigint, near array<struct<id:int,x:double,y:double>>")


def with_nearest(points: DataFrame, centres: list[tuple[int, float, float]], max_centres: int = 1_000_000) -> DataFrame:
    """points (x, y, ...) with ``nearest`` (dist, id, x, y), lowest id on ties.

    Points whose coordinates are no finite numbers are left out; no points
    give no rows. Raises without centres or beyond ``max_centres`` of them.
    Building the result runs one aggregate over the points."""
    if not centres or len(centres) > max_centres:
        raise ValueError("with_nearest needs between 1 and max_centres centres")
    finite = F.lit(True)
    for c in ("x", "y"):
        v = F.col(c).cast("double")
        finite = finite & v.isNotNull() & (F.abs(v) < F.lit(math.inf))  # NaN is above it
    points = points.where(finite)
    x, y = F.col("x").cast("double"), F.col("y").cast("double")
    ends = points.agg(F.min(x), F.min(y), F.max(x), F.max(y)).first()
    if ends[0] is None:
        ends = (0.0, 0.0, 0.0, 0.0)
    x0, y0 = min(ends[0], min(c[1] for c in centres)), min(ends[1], min(c[2] for c in centres))
    x1, y1 = max(ends[2], max(c[1] for c in centres)), max(ends[3], max(c[2] for c in centres))
    side = max(1, math.ceil(math.sqrt(len(centres))))
    wide, high = (x1 - x0) / side or 1.0, (y1 - y0) / side or 1.0

    def index(v, start, size):
        return F.least(F.lit(side - 1), F.greatest(F.lit(0), F.floor((v - F.lit(start)) / F.lit(size)))).cast("bigint")

    placed = points.withColumn("_cell", index(x, x0, wide) * side + index(y, y0, high))
    cells = placed.select(F.col("_cell").alias("cell")).distinct()
    near = candidates(cells, centres, (x0, y0, wide, high), side)
    gap = "(x - c.x) * (x - c.x) + (y - c.y) * (y - c.y)"
    best = F.expr(f"array_min(transform(near, c -> named_struct('dist', sqrt({gap}), 'id', c.id, 'x', c.x, 'y', c.y)))")
    return placed.join(near, F.col("_cell") == F.col("cell")).withColumn("nearest", best).drop("_cell", "cell", "near")
