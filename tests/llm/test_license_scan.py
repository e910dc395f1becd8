import random
import re

from tidepool.llm import license_scan, queries

SF = "/root/testdata/sf0.01"
LONG = license_scan.TEMPLATES["MIT"][1]


def brute(text, templates, bound=0.8):
    def sh(t):
        w = [x for x in re.split(r"[\W_]+", (t or "").lower()) if x]
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}

    own, found, top = sh(text), set(), 0
    for name, texts in templates.items():
        for t in texts:
            if sh(t) and (c := len(sh(t) & own) / len(sh(t))) >= bound:
                found.add(name)
                top = max(top, c)
    return sorted(found), top or None


def test_planted_texts_equal_brute_force(spark):
    rnd = random.Random(1)
    words = lambda n: " ".join(f"w{rnd.randrange(2000)}" for _ in range(n))
    texts = [None, "", " \n", "one two", LONG, LONG.upper(), words(3000)]
    for name, wordings in license_scan.TEMPLATES.items():
        for t in wordings:
            for k in (0, 3, 8, 15, 101):
                texts.append(f"{words(k)} {t} {words(30)}")
            texts.append(f"{words(20)}\n{t.replace(' ', chr(10))}\n{words(7)}")
    parts = LONG.split()
    texts.append(" ".join(["zzz", *parts[1:]]))
    texts.append(" ".join([*parts[:40], "zzz", *parts[41:]]))
    texts.append(" ".join(parts[:len(parts) // 2]))
    texts.append(words(20_000) + " " + LONG + " " + words(500))
    texts += [LONG, LONG]
    df = spark.createDataFrame([(None if i % 7 == 0 else i, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, sh string")
    got = license_scan.scan(df).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2] or 0)
    expect = [(None if i % 7 == 0 else i, *brute(t, license_scan.TEMPLATES)) for i, t in enumerate(texts)]
    assert sorted(((r.doc_id, r.licenses, r.containment) for r in got), key=key) == sorted(expect, key=key)
    assert all(r.n_windows > 0 for r in got if r.licenses)
    assert license_scan.scan(df.where("doc_id = -1")).count() == 0
    assert license_scan.scan(df, {"tiny": ["too short"]}).where("size(licenses) > 0").count() == 0


def test_query_equals_its_sql(spark, duck):
    got = sorted((r.doc_id, r.licenses, r.containment) for r in queries.op5_license_scans(spark, SF).collect())
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    assert got == sorted(duck(queries.ORACLES["op5_license_scans"], documents=docs).fetchall())
    assert sum(r[1] != "" for r in got) > 10


def test_no_python_in_the_plan(spark):
    plan = license_scan.scan(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan
