"""Near-duplicate embeddings by PCA-ordered tiled comparison.

Vectors are brought to length one and rotated onto the principal axes, largest
first (a rotation changes no cosine; it is fitted on a sample of about
`fit_rows` distinct vectors, and a poor fit costs time, never a link). Copies
collapse: all work below is on distinct vectors of a label.

1. Tiles. The vectors of a label are cut at quantiles of the first axis, the
   parts that are still larger than `tile` at those of the second, and so on.
   Each tile knows the box of its leading coordinates. A label of any size is
   many tiles; equal coordinates are dealt by a hash.
2. Pairs of tiles are found from the top: a pair of parts is opened only if the
   gap between their boxes leaves room for the threshold, for a cosine c means
   a squared distance of 2 - 2c.
3. Each remaining pair of tiles is one group of two rows. Inner products
   accumulate a stretch of axes at a time; what the axes to come can add is at
   most the product of the two suffix norms, and a pair of vectors whose bound
   is below the threshold is not taken further. Cosines that end within
   rounding of the threshold are decided in the original coordinates.
4. No pair of vectors leaves a task: only each vector's number of links and one
   link to its smallest neighbour component in the tile pair, which the
   components of the whole table need.

Defined results: a null, empty or zero vector, one that holds null or
non-finite components, and one without label link with nothing; so do vectors
of different lengths; repeated rows are vectors of their own, linked to each
other; a null id takes part, is never a component's smallest id (null if all
are) and is not kept; rows that repeat a component's smallest id are all kept;
an empty table gives no rows; further columns are ignored, whatever their
names. There is no text. Building the result runs the jobs up to the links.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.components import components
from tidepool.llm.store import Scratch

#: Axes that boxes have, and axes that are accumulated between two looks at the bound.
LEADING, STRETCH = 8, 16
#: Far above the rounding of a rotated inner product, far below any use of a threshold.
EPS = 1e-9
_ROWS = 512  # of a tile against the whole other one


def usable(rows: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(id, key, part, vec): key names the label and the vector (null if it
    can't be compared), part the label and the length, vec holds doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, parts, vecs = [], [], []
            for v, label in zip(b.column("v"), b.column("label").to_pylist()):
                x = np.zeros(0) if label is None or not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False)
                x = x.astype("<f8") + 0.0  # no negative zeros: equal vectors are equal bytes
                fine = len(x) > 0 and bool(np.isfinite(x).all()) and bool(x.any())
                part = f"{len(x)}/{label}"
                parts.append(part if fine else None)
                vecs.append(x.tobytes() if fine else None)
                keys.append(hashlib.blake2b(part.encode() + b"\0" + x.tobytes(), digest_size=16).hexdigest() if fine else None)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(keys, pa.string()), pa.array(parts, pa.string()),
                                              pa.array(vecs, pa.binary())], names=["id", "key", "part", "vec"])

    src = rows.select(F.col(id_col).cast("bigint").alias("id"), F.col(vector_col).alias("v"),
                      F.col(label_col).cast("string").alias("label"))
    return src.mapInArrow(run, "id bigint, key string, part string, vec binary")


def unit(x: np.ndarray) -> np.ndarray:
    """Rows at length one; scaled first, so that no square overflows."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def principal_axes(distinct: DataFrame, fit_rows: int) -> np.ndarray:
    """Columns: axes by falling variance about the origin, of the commonest
    length; other lengths go without. One length x length matrix per task of a
    sample of bounded size is collected."""
    sizes = distinct.groupBy(F.substring_index("part", "/", 1).cast("int").alias("dim")).agg(F.count("*").alias("n"))
    top = sizes.orderBy(F.desc("n"), "dim").limit(1).collect()
    if not top:
        return np.zeros((0, 0))
    dim, n = top[0]
    share = min(1.0, fit_rows / n)
    chosen = F.shiftrightunsigned(F.xxhash64("key"), 11) < F.lit(int(share * 2**53))
    sample = distinct.where((F.length("vec") == 8 * dim) & chosen).select("vec")

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for b in batches:
            if b.num_rows:
                x = unit(np.stack([np.frombuffer(v, "<f8") for v in b.column("vec").to_pylist()]))
                total += x.T @ x
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()])], names=["m"])

    parts = sample.repartition(4).mapInArrow(moments, "m binary").collect()
    _, axes = np.linalg.eigh(sum(np.frombuffer(r.m).reshape(dim, dim) for r in parts))
    return np.ascontiguousarray(axes[:, ::-1])


def leading(distinct: DataFrame, axes) -> DataFrame:
    """(key, part, lead): the leading coordinates of each distinct vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turn = axes.value
        for b in batches:
            lead = []
            for v in b.column("vec").to_pylist():
                x = unit(np.frombuffer(v, "<f8")[None])
                x = x @ turn[:, :LEADING] if x.shape[1] == len(turn) else x[:, :LEADING]
                lead.append(np.pad(x[0], (0, LEADING - x.shape[1])))
            yield pa.RecordBatch.from_arrays([b.column("key"), b.column("part"), pa.array(lead, pa.list_(pa.float64()))],
                                             names=["key", "part", "lead"])

    return distinct.select("key", "part", "vec").mapInArrow(run, "key string, part string, lead array<double>")


def _box() -> list[Column]:
    return [F.array(*[f(F.col("lead")[i]) for i in range(LEADING)]).alias(name) for f, name in ((F.min, "lo"), (F.max, "hi"))]


def tiles(scratch: Scratch, lead: DataFrame, tile: int) -> tuple[DataFrame, list[DataFrame]]:
    """(key, node) with each vector's tile, and the nodes (parent, node, lo,
    hi) of every level. A level is a grouping for quantiles and one for boxes."""
    now = scratch.write(lead.withColumn("node", F.col("part")), "level")
    levels = [scratch.write(now.groupBy("node").agg(F.count("*").alias("n"), *_box())
                            .select(F.lit("").alias("parent"), "node", "n", "lo", "hi"), "nodes")]
    axis = 0
    while not levels[-1].where(F.col("n") > tile).isEmpty():
        # The hash decides between equal coordinates, and only between those.
        x = F.col("lead")[axis % LEADING] + F.xxhash64("key") / F.lit(2.0**63) * 1e-7
        large = levels[-1].where(F.col("n") > tile).select("node", F.least(F.lit(64), F.ceil(F.sqrt(F.col("n") / (0.6 * tile))) + 1).alias("cuts"))
        at = (now.withColumn("x", x).join(large.select("node"), "node", "left_semi")
              .groupBy("node").agg(F.percentile_approx("x", [k / 64 for k in range(1, 64)], 2000).alias("q"))
              .join(large, "node")
              .select("node", F.transform(F.sequence(F.lit(1), F.col("cuts") - 1),
                                          lambda k: F.col("q")[F.floor(k * 64 / F.col("cuts")).cast("int") - 1]).alias("q")))
        cut = scratch.write(at, "cuts")
        part = F.concat("node", F.lit("."), F.size(F.filter("q", lambda v: v < F.col("x"))))
        done, now = now, scratch.write(now.withColumn("x", x).join(cut, "node", "left")
                                       .select("key", "part", "lead", F.col("node").alias("parent"),
                                               F.when(F.col("q").isNull(), F.col("node")).otherwise(part).alias("node")), "level")
        levels.append(scratch.write(now.groupBy("parent", "node").agg(F.count("*").alias("n"), *_box()), "nodes"))
        scratch.drop(done, cut)
        axis += 1
    return now.select("key", "node"), levels


def tile_pairs(scratch: Scratch, levels: list[DataFrame], threshold: float) -> DataFrame:
    """(a, b): the pairs of tiles, a tile with itself among them, that may hold a link."""
    def gap(p: str, q: str) -> Column:
        side = [F.greatest(F.lit(0.0), F.col(f"{q}.lo")[i] - F.col(f"{p}.hi")[i], F.col(f"{p}.lo")[i] - F.col(f"{q}.hi")[i])
                for i in range(LEADING)]
        return sum((s * s for s in side), F.lit(0.0))

    pairs = levels[0].select(F.col("node").alias("a"), F.col("node").alias("b"))
    for level in levels[1:]:
        pairs = (pairs.join(level.alias("p"), F.col("a") == F.col("p.parent")).join(level.alias("q"), F.col("b") == F.col("q.parent"))
                 .where(((F.col("a") != F.col("b")) | (F.col("p.node") <= F.col("q.node"))) & (gap("p", "q") <= 2 - 2 * threshold + 1e-6))
                 .select(F.col("p.node").alias("a"), F.col("q.node").alias("b")))
        pairs = scratch.write(pairs, "tile-pairs")
    return pairs


def near(a: np.ndarray, b: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(i, j, cosine) of the rows of a and b, of length one and rotated, that
    the suffix bound lets reach the last axis and that reach the threshold."""
    dim, out = a.shape[1], []
    steps = [*range(0, dim, STRETCH), dim]
    rest_a, rest_b = ([np.sqrt(np.einsum("ij,ij->i", x[:, s:], x[:, s:])) for s in steps[1:]] for x in (a, b))
    for lo in range(0, len(a), _ROWS):
        rows = slice(lo, lo + _ROWS)
        dense = a[rows, :steps[1]] @ b[:, :steps[1]].T
        i, j = np.nonzero(dense >= threshold - EPS - np.outer(rest_a[0][rows], rest_b[0]))
        dot = dense[i, j]
        i += lo
        for k in range(1, len(steps) - 1):
            axes = slice(steps[k], steps[k + 1])
            for at in range(0, len(i), 1 << 16):  # bounds memory
                p = slice(at, at + (1 << 16))
                dot[p] += np.einsum("ij,ij->i", a[i[p], axes], b[j[p], axes])
            keep = dot >= threshold - EPS - rest_a[k][i] * rest_b[k][j]
            i, j, dot = i[keep], j[keep], dot[keep]
        out.append((i, j, dot))
    return tuple(np.concatenate(x) for x in zip(*out))


def smallest_linked(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n vertices the smallest of its component under links (i, j)."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        new = root.copy()
        for side in (i, j):
            np.minimum.at(new, root[side], low)
            np.minimum.at(new, side, low)
        new = new[new]
        if (new == root).all():
            break
        root = new
    return root


def compare(pair: pd.DataFrame, turn: np.ndarray, threshold: float) -> pd.DataFrame:
    """Links within one pair of tiles: a row for each linked vector with its
    links (copies counted) and the smallest vector of its component there."""
    sides = []
    for keys, copies, vecs in zip(pair["keys"], pair["copies"], pair["vecs"]):
        x = np.frombuffer(vecs, "<f8").reshape(len(keys), -1)
        y = unit(x)
        sides.append((np.asarray(keys), np.asarray(copies, np.int64), x, y @ turn if y.shape[1] == len(turn) else y))
    one = len(sides) == 1
    (ka, ca, xa, ya), (kb, cb, xb, yb) = sides[0], sides[-1]
    i, j, dot = near(ya, yb, threshold)
    if one:
        i, j, dot = i[i < j], j[i < j], dot[i < j]
    doubt = np.flatnonzero(dot < threshold + EPS)
    if len(doubt):
        p, q = unit(xa[i[doubt]]), unit(xb[j[doubt]])
        p, q = p[np.arange(len(p))], q[np.arange(len(q))]
        below = doubt[np.einsum("ij,ij->i", p, q) < threshold]
        i, j = np.delete(i, below), np.delete(j, below)
    keys = ka if one else np.r_[ka, kb]
    shift = 0 if one else len(ka)
    links = np.zeros(len(keys), np.int64)
    np.add.at(links, i, cb[j])
    np.add.at(links, j + shift, ca[i])
    order = np.argsort(keys)  # the smallest vertex is the one with the smallest key
    rank = np.empty(len(keys), np.int64)
    rank[order] = np.arange(len(keys))
    root = smallest_linked(len(keys), rank[i], rank[j + shift])[rank]
    some = np.flatnonzero(links)
    return pd.DataFrame({"key": keys[some], "links": links[some], "root": keys[order][root[some]]})


def links(scratch: Scratch, distinct: DataFrame, threshold: float, tile: int, fit_rows: int) -> DataFrame:
    """(key, links, root): for each distinct vector and each pair of tiles
    where it has links, how many, and a smaller vector of its component."""
    turn = principal_axes(distinct, fit_rows)
    shared = distinct.sparkSession.sparkContext.broadcast(turn)  # length x length
    placed, levels = tiles(scratch, leading(distinct, shared), tile)
    pairs = tile_pairs(scratch, levels, threshold)

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"node": group["node"].iloc[:1], "keys": [group["key"].tolist()], "copies": [group["n"].tolist()],
                             "vecs": [b"".join(group["vec"])]})

    packed = scratch.write(placed.join(distinct.select("key", "n", "vec"), "key").groupBy("node")
                           .applyInPandas(pack, "node string, keys array<string>, copies array<bigint>, vecs binary"), "tiles")
    sides = pairs.select("a", "b", F.explode(F.array_distinct(F.array("a", "b"))).alias("node"))

    def run(pair: pd.DataFrame) -> pd.DataFrame:
        return compare(pair, shared.value, threshold)

    found = scratch.write(sides.join(packed, "node").groupBy("a", "b").applyInPandas(run, "key string, links bigint, root string"), "links")
    scratch.drop(packed, placed, *levels, pairs)
    return found


def near_duplicates(rows: DataFrame, threshold: float = 0.93, tile: int = 1024, fit_rows: int = 20_000, id_col: str = "vec_id",
                    vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """id, n_links, component_id and kept, per row."""
    if not 0 < threshold <= 1:
        raise ValueError("the threshold must be above 0 and at most 1")
    scratch = Scratch(rows.sparkSession, "embeddings")
    named = scratch.write(usable(rows, id_col, vector_col, label_col), "vectors")
    distinct = scratch.write(named.where("key IS NOT NULL").groupBy("key").agg(
        F.first("part").alias("part"), F.first("vec").alias("vec"), F.count("*").alias("n"), F.min("id").alias("first")), "distinct")
    found = links(scratch, distinct, threshold, tile, fit_rows)
    roots = components(scratch, found.select(F.col("key").alias("a"), F.col("root").alias("b")))
    rooted = distinct.select("key", "n", "first").join(roots, distinct.key == roots.v, "left").select(
        "key", "n", "first", F.coalesce("root", "key").alias("root"))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    linked = found.groupBy("key").agg(F.sum("links").alias("links"))
    known = scratch.write(rooted.join(smallest, "root").join(linked, "key", "left")
                          .select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("links"), "component"), "known")
    scratch.drop(distinct, found)
    single = F.col("key").isNull()
    return (named.select("id", "key").join(known, "key", "left")
            .select(F.col("id").alias(id_col), F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
                    F.when(single, F.col("id")).otherwise(F.col("component")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(False))))
