import math
import zlib
from collections import Counter

import numpy as np

from tidepool.llm import language_id, ngrams, queries

SF = "/root/testdata/sf0.01"


def plain_counts(text, bits):
    """One n-gram at a time, over the whole text at once."""
    points = ngrams.code_points(" " + " ".join(text.lower().split()) + " ")
    out = Counter()
    for n in language_id.SIZES:
        for i in range(len(points) - n + 1):
            out[int(ngrams.buckets(points[i:i + n], (n,), bits)[0])] += 1
    return out


def test_buckets_of_long_texts_equal_one_by_one():
    for text in ("", "a", "Ab cd", "é" * 10, "x y " * 3000):
        at, n = language_id.text_buckets(text, 12)
        assert dict(zip(at.tolist(), n.astype(int).tolist())) == plain_counts(text, 12)


def test_slices_do_not_change_counts(monkeypatch):
    text = "une phrase, ein Satz; " * 800
    whole = language_id.text_buckets(text, 12)
    monkeypatch.setattr(language_id, "_SLICE", 700)
    sliced = language_id.text_buckets(text, 12)
    assert (whole[0] == sliced[0]).all() and (whole[1] == sliced[1]).all()


def test_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows}
    counts = {}
    for r in rows:
        if r.lang and r.text is not None and not held[r.doc_id]:
            counts.setdefault(r.lang, Counter()).update(plain_counts(r.text, 10))
    total = {k: sum(c.values()) + 0.5 * 1024 for k, c in counts.items()}
    got = {r.doc_id: r for r in language_id.predict_languages(docs, bits=10).collect()}
    assert len(got) == len(rows)
    for r in rows:
        g = got[r.doc_id]
        score = {k: sum(n * math.log((counts[k][b] + 0.5) / total[k]) for b, n in plain_counts(r.text, 10).items())
                 for k in counts}
        best = max(score.values())
        assert g.held_out == held[r.doc_id]
        assert score[g.lang_pred] >= best - 1e-2 * max(1, abs(best) * 1e-3)
        assert 0 <= g.score <= 1


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang")
    got = queries.op7_language_id(spark, SF).where("held_out").join(docs, "doc_id").collect()
    assert len(got) > 100
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97


def test_edge_rows(spark):
    rows = [(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (None, None, None), (3, "", "en"),
            (4, "123 ... !", None), (4, "123 ... !", None), (6, "the dog " * 50_000, None), (7, "Hund", None)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, lang string, score string")
    got = language_id.predict_languages(df, folds=1_000_003, bits=10).collect()
    assert len(got) == len(rows) and got[0].asDict().keys() == {"doc_id", "held_out", "lang_pred", "score"}
    by = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by[3] == by[4] == by[None] == ("und", 0.0)
    assert by[6][0] == "en" and by[7][0] == "de"
    assert language_id.predict_languages(df.where("doc_id > 9")).count() == 0
    none = language_id.predict_languages(df.where("lang is null"), bits=10).collect()
    assert {r.lang_pred for r in none} == {"und"}
