import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import quality_rules as Q
from tidepool.llm import queries
from tidepool.llm.store import Scratch

SF = "/root/testdata/sf0.001"


def plain_statistics(text):
    w = re.findall("[^\x20\x09-\x0D]+", text or "")
    lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0D]", x)]
    windows = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    seen = Counter(windows)
    covered = {j for i, x in enumerate(windows) if seen[x] > 1 for j in range(i, i + 3)}
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered))


def texts(rnd, n):
    words = ["a", "b", "cc", "é#", "|", " x", "Zz", "*$"]
    out = [None, "", " \n\t", "one", "a b", "a a a a a", "a b c a b c a b", "x\x1cy \x0bz", "line\nline\n\n \nline", "w " * 30_000]
    return out + ["".join(rnd.choice(words) + rnd.choice([" ", "  ", "\n", "\t"]) for _ in range(rnd.randint(0, 120))) for _ in range(n)]


def test_statistics_equal_a_plain_statement(spark):
    own = texts(random.Random(1), 150)
    df = spark.createDataFrame(list(enumerate(own)), "doc_id bigint, text string")
    got = {r.id: tuple(r[s] for s in Q.STATISTICS) for r in Q.statistics(df, {"id": F.col("doc_id")}).collect()}
    assert got == {i: plain_statistics(t) for i, t in enumerate(own)}


def plain_mcd(x, steps, support, floors):
    """The same concentration steps, in numpy, one group at a time."""
    q = lambda p: np.sort(x, 0)[math.ceil(p * len(x)) - 1]
    mean, cov = q(0.5), np.diag(((q(0.75) - q(0.25)) / 1.349) ** 2 + np.square(floors))
    for _ in range(steps):
        d = np.einsum("ij,jk,ik->i", x - mean, np.linalg.inv(cov), x - mean)
        bins = np.floor(np.log2(np.maximum(d, 1e-6)) * 64)
        near = x[bins <= np.sort(bins)[math.ceil(support * len(x)) - 1]]
        mean, cov = near.mean(0), np.cov(near.T, bias=True) + np.diag(np.square(floors))
    return mean, np.linalg.cholesky(cov)


def test_estimates_equal_a_plain_statement(spark):
    rng = np.random.default_rng(2)
    floors = [0.1, 0.05]
    groups = {"a": rng.multivariate_normal([1, 2], [[1, 0.7], [0.7, 1]], 400), "b": rng.normal(0, 1, (300, 2)),
              "few": rng.normal(5, 1, (20, 2)), "flat": np.ones((150, 2))}
    groups["a"][:80] += 50  # a fifth of outliers
    rows = [(g, *map(float, v)) for g, x in groups.items() for v in x]
    fit = Q.estimates(Scratch(spark, "t"), spark.createDataFrame(rows, "g string, x0 double, x1 double"), 6, 0.75, 100, floors).collect()
    assert {r.g for r in fit} == {"a", "b", "flat", None}
    groups[None] = np.concatenate(list(groups.values()))
    for r in fit:
        mean, low = plain_mcd(groups[r.g], 6, 0.75, floors)
        assert [r.m0, r.m1] == pytest.approx(list(mean), abs=1e-6)
        assert [r.l00, r.l10, r.l11] == pytest.approx([low[0, 0], low[1, 0], low[1, 1]], abs=1e-6)
    a = next(r for r in fit if r.g == "a")
    assert abs(a.m0 - 1) < 0.3 and abs(a.m1 - 2) < 0.3  # not pulled by the outliers


def test_outliers_go_and_edges(spark):
    rnd = random.Random(3)
    words = [f"w{i:03d}" for i in range(500)]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(60, 120))), "aa", f"s{i % 2}") for i in range(260)]
    junk = [(1000 + i, " ".join(rnd.choice(words) + "###" for _ in range(80)), "aa", "s0") for i in range(12)]
    odd = [(2000, None, None, None), (2001, "", "aa", "s0"), (None, " ".join(words[:60]), None, "s0"), (2002, "w " * 100, "aa", "s0")]
    df = spark.createDataFrame([(*r, 1) for r in rows + junk + odd + odd[:1]], "doc_id bigint, text string, lang string, source string, id int")
    got = Q.judge(df).collect()
    assert len(got) == len(rows) + len(junk) + 5
    by = {r.doc_id: r for r in got}
    assert all(by[r[0]].kept for r in rows) and not any(by[r[0]].kept for r in junk) and by[None].kept
    assert by[2000].base_failed and by[2001].base_failed and by[2002].base_failed and not by[2002].kept
    assert Q.judge(df.where("id = 2")).count() == 0
    assert Q.judge(df.where("doc_id = 2001")).where("kept").count() == 0


def test_query_on_the_driver_table(spark):
    got = queries.op8_quality_rules(spark, SF)
    plan = got._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
    own = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in got.collect():
        want = plain_statistics(own[r.doc_id])
        assert tuple(r[s] for s in Q.STATISTICS) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0]) and (not r.base_failed or not r.kept)


def test_cutoff_follows_the_chi_square_law():
    assert Q.chi_square_quantile(0.99, 4) == pytest.approx(13.2767, abs=1e-3)
    x = np.random.default_rng(6).normal(size=(200_000, 4))
    d = np.square(x).sum(1)
    assert np.cov(x[d <= np.quantile(d, 0.75)].T)[0, 0] * Q.consistency(0.75, 4) == pytest.approx(1, abs=0.02)


def test_every_coordinate_rejects_alone(spark):
    rnd = random.Random(7)
    words = [f"w{i:03d}" for i in range(900)]
    usual = [(i, "\n".join(" ".join(rnd.sample(words, 10)) for _ in range(10)), "aa", "s") for i in range(120)]
    line = lambda: " ".join(rnd.sample(words, 9))
    lines = "\n".join(x for _ in range(10) for x in ("same", line()))  # 9 of 20 lines are copies
    phrase = " ".join(f"p q r {a} {b} {c}" for a, b, c in zip(*[iter(rnd.sample(words, 45))] * 3)) + " " + " ".join(rnd.sample(words, 10))
    long = " ".join(w + "xxx" for w in rnd.sample(words, 100))
    symbols = " ".join(w + "#" * (i % 5 == 0) for i, w in enumerate(rnd.sample(words, 100)))
    df = spark.createDataFrame([*usual, *((1000 + i, t, "aa", "s") for i, t in enumerate((lines, phrase, long, symbols)))],
                               "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r for r in Q.judge(df).collect()}
    assert all(got[r[0]].kept for r in usual)
    assert [(got[i].base_failed, got[i].kept) for i in range(1000, 1004)] == [(False, False)] * 4


def test_small_groups_are_judged_by_their_language(spark):
    rnd = random.Random(8)
    text = lambda w: " ".join(f"{w}{i:03d}" for i in rnd.sample(range(900), 80))
    many = [(i, text("w"), "aa", "s") for i in range(300)]
    own = [(1000 + i, text("longerword"), "bb", f"s{i % 3}") for i in range(36)]  # 12 a source
    strange = [(2000, text("w"), "bb", "s0")]
    alone = [(3000, text("w"), "cc", "s"), (3001, text("longerword"), "cc", "s"), (3002, text("w"), None, "s")]
    df = spark.createDataFrame(many + own + strange + alone, "doc_id bigint, text string, lang string, source string")
    kept = {r.doc_id: r.kept for r in Q.judge(df).collect()}
    assert all(kept[r[0]] for r in many + own)  # a language's own manner is no outlier
    assert not kept[2000]  # and the largest language's is one there
    assert kept[3000] and not kept[3001] and kept[3002]  # too few of the language: all rows
