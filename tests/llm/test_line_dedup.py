import hashlib
import random
import re
import time
from collections import Counter

import pytest

from tidepool.llm import line_dedup, queries
from tidepool.llm.store import Scratch

SF = "/root/testdata/sf0.01"


def brute(rows, min_docs, min_chars=1):
    def key(line):
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line)
        return re.sub("^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", low)

    seen = Counter(k for _, t in rows for k in {key(x) for x in (t or "").split("\n")})
    gone = {k for k, n in seen.items() if n >= min_docs and len(k) >= min_chars}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if key(x) not in gone]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def as_set(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (5, 2), (7, 3)])
def test_equals_brute_force(spark, batches, fan_in):
    rnd = random.Random(batches)
    pool = [" Menu", "menu\t", "MENU", "", " ", "É", "é", "a\x0b", "\x1ca", "x" * 5000] + [f"line {i}" for i in range(40)]
    rows = [(rnd.choice([None, i, i // 2]), "\n".join(rnd.choice(pool) for _ in range(rnd.randint(1, 12)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "\n\n"), rows[0], rows[0]]
    df = spark.createDataFrame([(a, b, 1, 2, 3) for a, b in rows], "doc_id bigint, text string, d1 int, row int, n_lines int")
    got = line_dedup.dedup_lines(df, min_docs=4, batches=batches, fan_in=fan_in)
    assert got.columns == ["doc_id", "text", "d1", "row", "n_lines", "n_dropped"]
    assert as_set((r.doc_id, r.n_lines, r.n_dropped, r.text or "") for r in got.collect()) == as_set(brute(rows, 4))
    assert line_dedup.dedup_lines(df.where("d1 = 2")).count() == 0


def test_cut_is_linear_in_the_dropped_lines(spark):
    def seconds(n):
        df = spark.createDataFrame([(i, "\n".join(f"shared {k}" for k in range(n)) + f"\nown {i}") for i in range(10)], "doc_id bigint, text string")
        begin = time.perf_counter()
        out = line_dedup.dedup_lines(df, min_docs=10).agg({"n_dropped": "sum"}).first()[0]
        assert out == 10 * n
        return time.perf_counter() - begin

    seconds(2000)
    assert seconds(200_000) <= 12 * seconds(20_000)


def test_runs_are_levelled_and_settled_hashes_stop_growing(spark):
    runs = line_dedup.LineRuns(Scratch(spark, "t"), min_docs=3, fan_in=2)
    hot = [(1, 1)] * 3
    for b in range(5):
        runs.add(spark.createDataFrame(hot + [(10 + b, 0), (99, 0)], "h1 bigint, h2 bigint"))
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    counts = sorted(tuple(r) for level in runs.levels for run in level for r in run.select("h1", "n").collect())
    assert (1, 3) in counts and sum(n for h, n in counts if h == 1) == 3  # later batches added none
    assert sorted(r.h1 for r in runs.compact().collect()) == [1, 99]


def test_query_equals_its_sql_and_brute_force(spark, duck):
    got = as_set(tuple(r) for r in queries.op2_line_dedup(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    sql = duck(queries.ORACLES["op2_line_dedup"], documents=docs).fetchall()
    assert got == as_set(sql)
    plain = brute([tuple(r) for r in docs.collect()], 10)
    assert got == as_set((i, n, d, hashlib.sha256(t.encode()).hexdigest()) for i, n, d, t in plain)


def test_no_python_in_the_plan(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    plan = line_dedup.dedup_lines(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_cross_the_exchange_once(spark):
    df = spark.createDataFrame([(i, f"shared\nown {i}") for i in range(12)], "doc_id bigint, text string")
    out = line_dedup.dedup_lines(df, min_docs=10, min_chars=1)
    plan = out._jdf.queryExecution().optimizedPlan()
    while "Join" not in plan.nodeName():
        plan = plan.children().apply(0)
    left = plan.children().apply(0).output()
    assert [left.apply(i).name() for i in range(left.size())] == ["row", "d1", "d2"]
    assert sorted(r.text for r in out.collect()) == sorted(f"own {i}" for i in range(12))
