import math
import random
import re
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidepool.llm import quality_classifier as Q
from tidepool.llm.store import Scratch

SF = "/root/testdata/sf0.01"
SF_LARGE = "/root/testdata/sf0.1"


def made(n, rnd):
    """Texts of invented words; some bad by a word, some by repetition."""
    vocab = [f"{a}{b}{c}" for a in ("lo", "mi", "tar", "en") for b in ("sa", "ri", "du") for c in ("m", "nto", "x", "")]
    for i in range(n):
        words = [rnd.choice(vocab) for _ in range(rnd.randint(20, 200))]
        toxic, low = i % 10 == 0, i % 7 == 0
        if toxic:
            words[rnd.randrange(len(words))] = rnd.choice(["Idiotus!", "idiotus"])
        if low:
            words = words[:10] + [words[0]] * 100
        yield i, " ".join(words), low, toxic


def frames(spark, n=900):
    rnd = random.Random(4)
    rows = list(made(n, rnd))
    docs = spark.createDataFrame([(i, t, "aa", f"site{i % 5}/p{i % 3}", "x", 1) for i, t, _, _ in rows],
                                 "doc_id bigint, text string, lang string, source string, kept string, e int")
    labels = spark.createDataFrame([(i, int(not low), int(tox)) for i, _, low, tox in rows],
                                   "doc_id bigint, quality int, toxic int")
    return rows, docs, labels


def test_held_out_documents_are_judged_right(spark):
    rows, docs, labels = frames(spark)
    got = {r.doc_id: r for r in Q.classify(docs, labels.where("doc_id % 3 <> 0")).collect()}
    assert len(got) == len(rows) and set(got[0].asDict()) == {*docs.columns, "p_low", "p_toxic"}
    test = [r for r in rows if r[0] % 3 == 0]
    right = [got[i].kept == (not low and not tox) for i, _, low, tox in test]
    assert sum(right) / len(right) > 0.97
    assert all(0 <= r.p_low <= 1 and 0 <= r.p_toxic <= 1 for r in got.values())


def test_site_priors_equal_a_plain_statement(spark):
    rnd = random.Random(1)
    rates = {"low": 0.2, "toxic": 0.1}
    rows = [(f"h{i % 4}", f"h{i % 4}/{i % 3}", rnd.gauss(i % 4 - 2, 2), rnd.gauss(-2, 2)) for i in range(400)] + [("rare", "rare/0", 3.0, -3.0)]
    scored = spark.createDataFrame(rows, "host string, path string, low double, toxic double")
    sites, levels = Q.site_sums(Scratch(spark, "t"), scored, rates)
    own = {h: Q._posterior(F.col(h), F.lit(rates[h])) for h in Q.HEADS}
    got = {tuple(r)[:4]: tuple(r)[4:] for r in scored.join(sites, ["host", "path"]).select(
        "host", "path", *Q.HEADS, *[Q.site_prior(h, own[h], levels[h]).alias(f"prior_{h}") for h in Q.HEADS]).collect()}
    for n, head in enumerate(Q.HEADS):
        p = [1 / (1 + math.exp(-(r[2 + n] + math.log(rates[head] / (1 - rates[head]))))) for r in rows]
        base = min(max(sum(p) / len(p), 1e-4), 0.5)
        by = lambda k: {v: [p[i] for i, r in enumerate(rows) if r[k] == v] for v in {r[k] for r in rows}}

        def strength(groups, above):
            n = {g: len(v) for g, v in groups.items()}
            spread = sum(n[g] * (sum(v) / n[g] - above[g]) ** 2 for g, v in groups.items())
            noise = sum(above[g] * (1 - above[g]) for g in groups)
            scale = sum(n[g] * above[g] * (1 - above[g]) for g in groups)
            between = max(spread - noise, 0) / sum(n.values())
            return min(max(scale / sum(n.values()) / between - 1, 1), 1e6) if between else 1e6

        hosts, paths = by(0), by(1)
        m1 = strength(hosts, dict.fromkeys(hosts, base))
        m2 = strength(paths, {g: (sum(hosts[h]) + m1 * base) / (len(hosts[h]) + m1) for g in paths for h in [g.split("/")[0]]})
        for i, r in enumerate(rows):  # the others of a document's host and path
            host = (sum(hosts[r[0]]) - p[i] + m1 * base) / (len(hosts[r[0]]) - 1 + m1)
            path = (sum(paths[r[1]]) - p[i] + m2 * host) / (len(paths[r[1]]) - 1 + m2)
            assert got[r][n] == pytest.approx(min(max(path, 1e-4), 0.999), rel=1e-6)
        assert got[rows[-1]][n] == pytest.approx(base)  # alone on its host: the global rate


def plain_features(t):
    words = t.split()
    up, bare = (sum(Q.token_shape(w)[i] for w in words) for i in (0, 1))
    out = Counter(Q.text_features(t, words, len(set(words)), up, bare))
    for w in words:
        core = re.sub(r"^\W+|\W+$", "", w.lower())
        tail = re.search(r"\W*$", w.lower()).group()
        out.update([f"w:{core}"] * bool(core) + [f"p:{core[:n]}" for n in (4, 5, 6) if len(core) > n])
        out.update([f"t:{tail}"] * (tail not in ("", ",", ".")))
    return out, len(words)


def plain_evidence(known, found, n, lang, caution=1.5, least=6.0, text_caution=2.0, least_text=12.0):
    """The strongest kept feature of a text with features `found` and n words,
    from (features, words, lang, bad) of the labelled ones."""
    best = -math.inf
    for f, k in found.items():
        base = [r for r in known if not f.startswith("p:") or r[2] == lang]
        bad, good = [r for r in base if r[3]], [r for r in base if not r[3]]
        hold = [r for r in bad if f in r[0]]
        if len(hold) <= 4 or not good:
            continue
        care = text_caution if f.startswith("x:") else caution
        sure = len(hold) - care * math.sqrt(len(hold))
        high = lambda c: c + care * math.sqrt(c) + care
        p = sure / len(bad)
        if f.startswith("x:"):
            r = p / (high(sum(f in g[0] for g in good)) / len(good))
            value = math.log(r) if r >= least_text else -math.inf
        else:
            mu = sum(r[0][f] for r in hold) / sum(r[1] for r in hold) * sure / len(hold)
            lam = high(sum(r[0][f] for r in good)) / sum(r[1] for r in good)
            kept = p * mu / lam >= least and mu > lam
            value = math.log(p) + k * math.log(mu / lam) - n * (mu - lam) if kept else -math.inf
        best = max(best, value)
    return best


def test_evidence_and_decision_equal_a_plain_statement(spark):
    rows, docs, labels = frames(spark, 300)
    docs = docs.withColumn("lang", F.when(F.col("doc_id") % 3 == 0, "bb").otherwise("aa"))
    lang = {i: "aa" if i % 3 else "bb" for i, *_ in rows}
    model, rates = Q.fit(docs, labels)
    strongest, features = {}, {i: plain_features(t) for i, t, _, _ in rows}
    for n, head in enumerate(Q.HEADS):
        known = [(*features[i], lang[i], (low, tox)[n]) for i, _, low, tox in rows]
        strongest[head] = {i: plain_evidence(known, *features[i], lang[i]) for i, *_ in rows}
        quiet = {i for i, v in strongest[head].items() if v <= 0}
        bad = {i for i, _, low, tox in rows if (low, tox)[n]}
        none = math.log((len(quiet & bad) + 0.5) / (len(bad) + 1)) - math.log((len(quiet - bad) + 0.5) / (len(rows) - len(bad) + 1))
        assert model.none[head] == pytest.approx(min(0.0, none))
        strongest[head] = {i: none if i in quiet else v for i, v in strongest[head].items()}
    for i, t, _, _ in rows:
        assert model(t, lang[i]) == pytest.approx([strongest[h][i] for h in Q.HEADS])
    scored = spark.createDataFrame([(i, f"site{i % 5}", f"site{i % 5}/p{i % 3}\t{lang[i]}", *[strongest[h][i] for h in Q.HEADS]) for i, *_ in rows],
                                   "id bigint, host string, path string, low double, toxic double")
    sites, levels = Q.site_sums(Scratch(spark, "t"), scored, rates)
    own = {h: Q._posterior(F.col(h), F.lit(rates[h])) for h in Q.HEADS}
    want = {r.id: r for r in scored.join(sites, ["host", "path"]).select(
        "id", *[Q._posterior(F.col(h), Q.site_prior(h, own[h], levels[h])).alias(h) for h in Q.HEADS]).collect()}
    for r in Q.classify(docs, labels).collect():
        assert (r.p_low, r.p_toxic) == pytest.approx((want[r.doc_id].low, want[r.doc_id].toxic), abs=1e-9)
        assert r.kept == (max(r.p_low, r.p_toxic) <= 0.5)


def test_a_bad_site_rejects_a_document_without_evidence(spark):
    rows = [(i, "vile vile " + "word " * 20 if i % 2 else "word " * 20, "aa", "bad/x" if i % 2 or i == 0 else f"good/{i % 3}") for i in range(800)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    labels = spark.createDataFrame([(i, 1, i % 2) for i, *_ in rows], "doc_id bigint, quality int, toxic int")
    noisy = docs.withColumn("text", F.concat_ws(" ", "text", F.expr("concat_ws(' ', transform(sequence(1, 12), x -> concat('n', doc_id * x)))")))
    got = {r.doc_id: r for r in Q.classify(noisy, labels).collect()}
    assert got[0].p_toxic > 20 * max(got[i].p_toxic for i in range(2, 800, 2))
    assert all(got[i].kept for i in range(2, 800, 2)) and not any(got[i].kept for i in range(1, 800, 2))


def test_parts_of_tokens_take_linear_time():
    assert Q.word_features("¡Hola!?") == ["w:hola", "t:!?"]
    assert Q.word_features("--") == ["t:--"] and Q.word_features("lo_x.") == ["w:lo_x"]
    start = time.perf_counter()
    Q.word_features("a" + "!" * 1_000_000 + "a")
    assert time.perf_counter() - start < 5


def test_edge_rows(spark):
    _, docs, labels = frames(spark, 60)
    odd = spark.createDataFrame([(None, None, None, None, None, None), (1, "", None, None, "k", 2), (1, "", None, None, "k", 2),
                                 (7, "w " * 60_000, "aa", "/", "k", 3)], docs.schema)
    assert Q.classify(docs.union(odd), labels.union(labels)).count() == 64
    none = labels.where("doc_id < 0")
    assert Q.classify(docs.union(odd), none).where("kept").count() == 64
    nulls = spark.createDataFrame([(None, None, None), (3, None, 1)], labels.schema)
    assert Q.classify(docs, nulls).where("kept").count() == 60
    assert Q.classify(docs.where("doc_id < 0"), labels).count() == 0


def test_driver_table_keeps_clean_documents(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = Q.classify(docs, labels).join(labels, "doc_id").collect()
    clean = [r.kept for r in got if r.quality == 1 and r.toxic == 0]
    bad = [r.kept for r in got if r.quality == 0]
    assert sum(clean) / len(clean) > 0.97 and sum(bad) / len(bad) < 0.1


def test_held_out_toxic_documents_of_every_language_go(spark):
    """Half of the labels teach; of the other half's documents of good quality
    at least 0.8 of the toxic go and 0.97 of the clean stay, in each language."""
    docs, labels = (spark.read.parquet(f"{SF_LARGE}/{t}.parquet") for t in ("documents", "labels"))
    labelled = docs.join(labels.select("doc_id"), "doc_id", "left_semi")
    half = F.crc32(F.col("doc_id").cast("string")) % 2
    got = (Q.classify(labelled, labels.where(half == 0)).join(labels.where(half == 1).where("quality = 1"), "doc_id")
           .groupBy("lang", "toxic").agg(F.count("*").alias("n"), F.avg(F.col("kept").cast("int")).alias("kept")).collect())
    for r in got:
        assert r.kept <= 0.2 if r.toxic else r.kept >= 0.97, r
    assert len(got) == 8
