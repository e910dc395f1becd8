import random
from itertools import combinations

import numpy as np

from tidepool.llm import decontamination as D
from tidepool.llm import queries

SF = "/root/testdata/sf0.01"
HASHES = D.Hashes()


def brute(doc, item, overlap=20, agree=0.8, min_words=5):
    """Every alignment of the item with the document, without seeds."""
    w, x = D.words(doc, HASHES), D.words(item, HASHES)
    if len(x) < min_words:
        return False
    pad = np.zeros(len(x), np.uint64)
    return any(D.best_agreement(x, np.r_[pad, w, pad + 1], s, overlap) >= agree for s in range(len(w) + 2 * len(x)))


def test_filter_has_every_hash_and_few_others(spark):
    rnd = random.Random(1)
    hs = np.array([rnd.getrandbits(64) for _ in range(3000)], np.uint64)
    bits = D.filter_bitmap(spark.createDataFrame([(int(h),) for h in hs.view(np.int64)], "h bigint"), 1 << 18)
    assert len(D._set(bits, hs)) == len(hs)
    other = np.array([rnd.getrandbits(64) for _ in range(20000)], np.uint64)
    assert len(D._set(bits, other)) < 40


def test_planted_with_substitutions_and_edges(spark):
    rnd = random.Random(2)
    vocab = [f"w{i}" for i in range(3000)]
    text = lambda n: [rnd.choice(vocab) for _ in range(n)]
    items = [text(n) for n in (40, 60, 25, 12, 8, 5)] + [["a", "b"]]
    bench = [(i, " ".join(x)) for i, x in enumerate(items)] + [(50, " ".join(items[0]).upper() + "."), (51, None), (None, "x")]

    def changed(x, share):
        x = list(x)
        for i in rnd.sample(range(len(x)), int(len(x) * share)):
            x[i] = "zzz"
        return x

    docs = []
    for i, x in enumerate(items):
        for share in (0, 0.1, 0.15):
            docs.append(" ".join(text(100) + changed(x, share) + text(50)))
        docs.append("\n".join(x).title())
    docs.append(" ".join(text(30) + items[1][20:45] + text(30)))  # a part
    docs.append(" ".join(text(30) + items[1][20:32] + text(30)))  # too little of it
    docs.append(" ".join(text(30) + changed(items[0], 0.5)))
    docs += [None, "", " \n", "a b", " ".join(text(30_000) + items[2] + text(30_000)), " ".join(items[0] * 40)]
    docs += [docs[0], docs[0]] + [" ".join(text(200)) for _ in range(20)]
    df = spark.createDataFrame([(i if i % 9 else None, t, "x", 1) for i, t in enumerate(docs)],
                               "doc_id bigint, text string, items string, d1 int")
    bf = spark.createDataFrame([(*b, 3) for b in bench], "item_id bigint, text string, ids int")
    got = D.decontaminate(df, bf).collect()
    assert len(got) == len(docs) and got[0].asDict().keys() == {"doc_id", "text", "items", "d1", "contaminated", "agreement"}
    missed = 0
    for r in got:
        expect = sorted(i for i, t in bench if i is not None and t and len(r.text or "") < 50_000 and brute(r.text, t))
        if len(r.text or "") >= 50_000:
            expect = [2]
        assert set(r.items or []) <= set(expect)  # verified: nothing that is not there
        missed += len(set(expect) - set(r.items or []))
        assert r.contaminated == (r.items is not None)
    assert missed == 0
    assert not any(r.contaminated for r in D.decontaminate(df, bf.where("item_id = 77")).collect())
    assert D.decontaminate(df.where("doc_id = -1"), bf).count() == 0


def test_query_against_brute_force(spark):
    got = {r.doc_id: r.items or [] for r in queries.op10_benchmark_decontamination(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    bench = spark.read.parquet(f"{SF}/benchmark.parquet").collect()
    assert len(got) == len(docs)
    item_words = {b.item_id: D.words(b.text, HASHES) for b in bench}
    checked = 0
    for d in docs:
        w = D.words(d.text, HASHES)
        near = [b for b in bench if len(set(item_words[b.item_id].tolist()) & set(w.tolist())) >= 0.8 * min(
            20, len(set(item_words[b.item_id].tolist())))] if len(w) < 1500 else [b for b in bench if b.item_id in got[d.doc_id]]
        if len(w) < 1500:
            checked += 1
            assert got[d.doc_id] == sorted(b.item_id for b in near if brute(d.text, b.text)), d.doc_id
    assert checked > 500 and sum(map(bool, got.values())) > 5


def test_blocks_equal_documents_one_by_one(monkeypatch):
    rnd = np.random.default_rng(4)
    docs = [rnd.integers(0, 1 << 60, n).astype(np.uint64) for n in (0, 3, 900, 1, 40, 0, 2500, 13, 7)]
    masks = ["1111", "110101", "1001000000001"]
    every = np.full(1 << 10, 255, np.uint8)  # a filter that lets everything through
    ends = np.cumsum([len(d) for d in docs])
    expect = set()
    for d, end in zip(docs, ends):
        for m in masks:
            for at, h in enumerate(D.seeds(D.places(d, 13), m).view(np.int64)):
                expect.add((int(end) - len(d) + at, int(h)))
    for block in (64, 1 << 16):
        monkeypatch.setattr(D, "BLOCK", block)
        at, hs = D.hits_in(np.concatenate(docs), ends, masks, 13, every)
        assert set(zip(at.tolist(), hs.tolist())) == expect and len(at) == len(expect)


def test_masks_hit_every_admitted_pattern():
    of = D.masks_of(20, 0.8, 5)
    assert sorted(of) == list(range(5, 21))
    for need, masks in of.items():
        ways = list(combinations(range(need), D.substitutions(need, 0.8)))
        for way in ways if len(ways) < 600 else random.Random(need).sample(ways, 600):
            kept = [i not in way for i in range(need)]
            assert any(all(kept[at + k] for k, one in enumerate(m) if one == "1")
                       for m in masks for at in range(need - len(m) + 1)), (need, way)


def test_no_admitted_substitution_is_missed(spark):
    rnd = random.Random(5)
    items = {n: [f"i{n}x{k}" for k in range(n)] for n in range(5, 21)}
    docs = []
    for n, x in items.items():
        ways = list(combinations(range(n), D.substitutions(n, 0.8)))
        for way in rnd.sample(ways, min(40, len(ways))):
            docs.append((n, " ".join(["pad"] * 30 + ["zzz" if k in way else w for k, w in enumerate(x)] + ["pad"] * 30)))
    bench = spark.createDataFrame([(n, " ".join(x)) for n, x in items.items()], "item_id bigint, text string")
    got = D.decontaminate(spark.createDataFrame(docs, "doc_id bigint, text string"), bench).collect()
    missed = [r.doc_id for r in got if r["items"] != [r.doc_id]]
    assert len(got) == len(docs) and missed == []
