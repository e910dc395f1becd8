import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidepool.llm import alignment, bpe, queries

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(bpe.vocabulary_path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path("piece_bpe_32k.model"))


def spell(a, b, text):
    """Tokens of a text as (ids, byte strings) of both libraries, whole text at once."""
    stand_in = bpe.byte_symbols()
    ids_a = a.encode(" " + text, add_special_tokens=False).ids
    out_a = [bytes(stand_in[c] for c in a.id_to_token(i)) for i in ids_a]
    ids_b = b.encode(text)
    out_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
    return ids_a, out_a, ids_b, out_b


def slices(ids, ends, both):
    out = [[]]
    for i, e in zip(ids, ends):
        out[-1].append(i)
        if e in both:
            out.append([])
    return out[:-1]


def brute(texts, a, b):
    """Columns of every text by the plain statement: sets of offsets, all pairs of each group."""
    docs = []
    for t in texts:
        groups = []
        if t:
            ids_a, by_a, ids_b, by_b = spell(a, b, t)
            if b"".join(by_a) == b"".join(by_b) == (" " + t).encode():
                ends_a, ends_b = np.cumsum([len(x) for x in by_a]).tolist(), np.cumsum([len(x) for x in by_b]).tolist()
                both = set(ends_a) & set(ends_b)
                left, right = slices(ids_a, ends_a, both), slices(ids_b, ends_b, both)
                groups = list(zip(left, right))
        docs.append(groups)
    links = [Counter((i, j) for x, y in g for i in x for j in y) for g in docs]
    held = Counter(p for c in links for p in c)
    best = {}
    for (i, _), n in held.items():
        best[i] = max(n, best.get(i, 0))
    out = []
    for g, c in zip(docs, links):
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        out.append((sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), sum(c.values()),
                    sum(n for p, n in c.items() if held[p] == best[p[0]]), sum(n * held[p] for p, n in c.items()),
                    hashlib.sha256(text.encode()).hexdigest() if text else ""))
    return out


ODD = [None, "", " ", "  ", "a", " a", "a ", "a  b", "\n", "a\n\n b", "x▁y", "▁", "<|endoftext|> end<s></s>", "ﬁn   　z",
       "é مرحبا \U0001f469‍\U0001f469‍\U0001f467 你好世界。 テスト", "a\x00b \x7f", "1234567890 0x1F 3.14", "don't we'll I'M",
       "สวัสดี नमस्ते", "aaaa" * 300, "\t\ttab\r\nline  two spaces ", "한국어 \U00020000\U0010ffff", "word " * 3000]


def columns(rows):
    return [(r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in rows]


def test_gallop_equals_intersection():
    rnd = random.Random(1)
    for _ in range(300):
        span = rnd.choice([5, 60, 5000])
        x, y = (np.array(sorted(rnd.sample(range(span), rnd.randint(0, min(span, 900)))), np.int64) for _ in range(2))
        ia, ib = alignment.common_ends(x, y)
        assert x[ia].tolist() == y[ib].tolist() == sorted(set(x.tolist()) & set(y.tolist()))
        for block in (1, 2, 7):
            at = alignment.gallop(x, y, block)
            assert [y.tolist().index(v) if v in y else -1 for v in x.tolist()] == at.tolist()


@pytest.mark.parametrize("hot", [0, 40, 1 << 18])
def test_odd_rows_against_whole_texts(spark, libraries, hot):
    rnd = random.Random(2)
    alphabet = "ab \n\té你\U0001f600م.,'1"
    texts = ODD + ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(1, 80))) for _ in range(60)] + ["same text twice"] * 5
    df = spark.createDataFrame([(i if i % 7 else None, t, "x", 1) for i, t in enumerate(texts)],
                               "doc_id bigint, text string, pairs string, row int").repartition(3)
    from pyspark.sql import functions as F
    out = alignment.align(df, hot_pairs=hot, derive={"groups_sha256": F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256))})
    got = sorted(map(repr, columns(out.collect())))
    assert got == sorted(map(repr, brute(texts, *libraries)))


def test_edges_and_wide_groups(spark, libraries, monkeypatch):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert alignment.align(df).count() == 0
    model = alignment.aligner(bpe.vocabulary_path("byte_bpe_50k.json"), bpe.vocabulary_path("piece_bpe_32k.model"))
    a, b = np.array([5, 6, 5, 9], np.int32), np.array([1, 2, 1], np.int32)
    one, each = np.array([0]), (np.array([4]), np.array([3]))
    (t, p), n = model._pairs(a, b, one, one, *each, one)
    monkeypatch.setattr(alignment, "_WIDE", 2)
    (t2, p2), n2 = model._pairs(a, b, one, one, *each, one)
    assert p.tolist() == p2.tolist() and n.tolist() == n2.tolist() and t.tolist() == t2.tolist() and n.sum() == 12
    out = alignment.align(spark.createDataFrame([(1, "two words"), (2, None)], "doc_id bigint, text string")).collect()
    assert {r.doc_id: r.groups for r in out}[2] == "" and {r.doc_id: r.groups for r in out}[1].count("|") == 2


def test_query_against_brute_force(spark, libraries):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = {r.doc_id: r for r in queries.op13_cross_tokenizer_alignment(spark, SF).collect()}
    expect = brute([d.text for d in docs], *libraries)
    assert len(got) == len(docs)
    assert columns([got[d.doc_id] for d in docs]) == expect
