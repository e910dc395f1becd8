import math
import random

import numpy as np
import pandas as pd
import pytest

from tidepool.llm import embedding_dedup as E
from tidepool.llm import queries
from tidepool.llm.store import Scratch

SCHEMA = "vec_id bigint, embedding array<double>, label int"


def brute(rows, threshold):
    """{position: (links, smallest id)} of (id, vector, label), pair by pair."""
    def fine(v):
        return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    parent, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, (_, v, lv) in enumerate(rows):
        for j, (_, w, lw) in enumerate(rows[:i]):
            if lv is None or lv != lw or not fine(v) or not fine(w) or len(v) != len(w):
                continue
            x, y = (np.array(u) / max(map(abs, u)) for u in (v, w))
            if x @ y / math.sqrt(x @ x) / math.sqrt(y @ y) >= threshold:
                links[i] += 1
                links[j] += 1
                parent[find(i)] = find(j)
    least = {}
    for i, (k, _, _) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(k, least.get(find(i), k))
    return [(k, links[i], least.get(find(i)), k is not None and k == least.get(find(i))) for i, (k, _, _) in enumerate(rows)]


def got(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=repr)


@pytest.mark.parametrize("tile", [12, 1000])
def test_against_brute_force(spark, tile):
    rnd = np.random.default_rng(tile)
    rows, k = [], 0
    for label in (0, 0, 1, 2):
        for _ in range(6):
            centre = rnd.normal(size=20) * np.linspace(2, 0.2, 20)
            for _ in range(int(rnd.integers(1, 14))):
                k += 1
                rows.append((k * 7 % 1000, (centre + rnd.normal(size=20) * rnd.choice([0.05, 0.2, 0.35])).tolist(), label))
    rows += [(2000 + i, rows[3][1], rows[3][2]) for i in range(40)]  # copies
    rows += [(3000, (np.array(rows[3][1]) * 1e200).tolist(), rows[3][2])]
    out = E.near_duplicates(spark.createDataFrame(rows, SCHEMA), 0.93, tile=tile, fit_rows=50)
    assert got(out) == sorted(brute(rows, 0.93), key=repr)


def test_edge_rows(spark):
    inf, nan = float("inf"), float("nan")
    v = [1.0, 2.0, 3.0]
    rows = [(1, None, 0), (2, [], 0), (3, [0.0, -0.0, 0.0], 0), (4, [1.0, None, 3.0], 0), (5, [1.0, inf, 3.0], 0), (6, [nan, 1.0, 1.0], 0),
            (7, v, None), (8, v, None), (9, v, 0), (9, v, 0), (None, v, 0), (None, [9.0, -1.0, 0.0], 0), (10, v[:2], 0), (11, v[:2], 0),
            (12, [1.0, 0.0, -0.0], 1), (13, [1.0, -0.0, 0.0], 1), (14, [-1.0, 0.0, 0.0], 1), (15, [0.6, 0.8, 0.0], 2), (16, [1.0, 0.0, 0.0], 2)]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA + ", key string, n_links int")
    out = E.near_duplicates(df, 0.6)
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert got(out) == sorted(brute(rows, 0.6), key=repr)
    assert E.near_duplicates(df.where("vec_id = -1")).count() == 0
    assert E.near_duplicates(df.where("vec_id < 7")).where("kept and n_links = 0").count() == 6
    with pytest.raises(ValueError):
        E.near_duplicates(df, 0.0)


def test_suffix_bound_loses_no_pair():
    rnd = np.random.default_rng(3)
    a = E.unit(rnd.normal(size=(700, 40)) * np.linspace(3, 0.1, 40))
    b = E.unit(a[:90] + rnd.normal(size=(90, 40)) * 0.1)
    i, j, dot = E.near(a, b, 0.8)
    full = a @ b.T
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(np.ndarray.tolist, np.nonzero(full >= 0.8 - E.EPS))))
    assert np.allclose(dot, full[i, j], atol=1e-12) and len(i) > 20


def test_equal_coordinates_and_one_label_are_many_tiles(spark):
    flat = spark.range(500).selectExpr("cast(id as string) as key", "'2/0' as part", "array(0D,0D,0D,0D,0D,0D,0D,0D) as lead")
    placed, levels = E.tiles(Scratch(spark, "t"), flat, 50)
    assert placed.groupBy("node").count().agg({"count": "max"}).first()[0] <= 50 and len(levels) < 9
    rnd = random.Random(1)
    far = spark.createDataFrame([(str(i), "2/0", [float(i % 2)] + [rnd.random() / 100 for _ in range(7)]) for i in range(400)],
                                "key string, part string, lead array<double>")
    _, levels = E.tiles(Scratch(spark, "t"), far, 50)
    sizes = levels[-1].select("node").distinct().count()
    pairs = E.tile_pairs(Scratch(spark, "t"), levels, 0.93).count()
    assert sizes <= pairs <= 0.7 * sizes * (sizes + 1) / 2  # the two halves never meet


def test_components_of_a_chain_in_one_pair_of_tiles():
    i = np.arange(999)
    assert not E.smallest_linked(1000, i + 1, i).any()
    turn = np.eye(2)
    angles = np.linspace(0, 1, 50)
    x = np.c_[np.cos(angles), np.sin(angles)]
    pair = pd.DataFrame({"keys": [[f"{k:02}" for k in range(50)]], "copies": [[1] * 50], "vecs": [x.tobytes()]})
    out = E.compare(pair, turn, math.cos(0.03))
    assert set(out["root"]) == {"00"} and sorted(out["links"])[:3] == [1, 1, 2]


def test_query_against_its_sql(spark, duck):
    df = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    out = queries.op11_embedding_near_dedup(spark, "/root/testdata/sf0.01")
    sql = queries.oracle_sql()["op11_embedding_near_dedup"]
    assert got(out) == sorted(duck(sql, embeddings=df).fetchall(), key=repr)
    # Denser links than the table has.
    rnd = np.random.default_rng(5)
    rows = [(i, (np.eye(8)[i % 3] + rnd.normal(size=8) * 0.12).tolist(), i % 2) for i in range(150)]
    rows += [(200, None, 0), (201, [0.0] * 8, 0), (202, rows[0][1], None), (203, [float("inf")] + [1.0] * 7, 0), (204, [None] + [1.0] * 7, 0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(E.near_duplicates(df, tile=20)) == sorted(duck(sql, embeddings=df).fetchall(), key=repr)
