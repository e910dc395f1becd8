import random
import tracemalloc
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pyarrow as pa
from tokenizers import Tokenizer

from tidepool.llm import bpe, packing, queries

SF = "/root/testdata/sf0.001"


def check(rows, docs):
    """Pieces (doc, start, length, crc, tokens, sequence, offset) against the
    documents' ids, any number of documents per key."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for doc, start, length, crc, tokens, seq, offset in rows:
        by_doc[doc].append((start, length, crc, tokens))
        by_seq[seq].append((offset, length))
    for key, own in docs.items():
        pieces = sorted(by_doc.pop(key))
        want = sorted(p for ids in own for p in _cuts(ids, pieces))
        assert pieces == want
    assert not by_doc
    for pieces in by_seq.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 1024
    return [sum(n for _, n in p) for p in by_seq.values()]


def _cuts(ids, pieces):
    """The pieces of one document, following the cuts that the result made."""
    at = 0
    while at < len(ids):
        start, length, crc, tokens = next(p for p in pieces if p[0] == at and p[3] == len(ids) and p[2] == _crc(ids[at:at + p[1]]))
        yield start, length, crc, tokens
        at += length


def _crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def plain_place(count, need, size):
    """The fill level after which the sum of squares is least, fullest first."""
    best = None
    for level in [0, *[h for h in range(1, size - need + 1) if count[h]]]:
        after = count.copy()
        if level:
            after[level] -= 1
        if level + need < size:
            after[level + need] += 1
        squares = int((after[1:size] ** 2).sum())
        if best is None or squares <= best[0]:
            best = (squares, level)
    return best[1]


def test_placement_minimises_the_sum_of_squares():
    rnd = random.Random(3)
    packer = packing.Packer(64, 0)
    for i in range(1500):
        need = rnd.choice([rnd.randint(1, 63), 20, 40])
        level, before = plain_place(packer.count, need, 64), packer.count.copy()
        packer.add(i, np.arange(need, dtype=np.uint32))
        if level:
            before[level] -= 1
        if level + need < 64:
            before[level + need] += 1
        assert (packer.count[1:64] == before[1:64]).all()


def test_every_id_once_and_little_padding():
    rnd = random.Random(5)
    docs = {i: [np.array([rnd.randrange(50_000) for _ in range(rnd.choice([1, 7, 600, 1024, 1025, 5000]))], np.uint32)]
            for i in range(700)}
    for max_open in (4096, 8):
        packer = packing.Packer(1024, 1 << 40, max_open)
        for i, (ids,) in docs.items():
            packer.add(i, ids)
        packer.finish()
        fills = check(packer.rows, docs)
        assert all(f & (f - 1) == 0 for f in fills)  # full, or a power of two
        assert sum(f < 1024 for f in fills) <= 10


def test_rows_and_query(spark):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rows = [(1, None), (2, ""), (None, "some text"), (4, "word " * 9000), (4, "word " * 9000), (5, "<|endoftext|> x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id bigint, text string, offset int")
    docs = defaultdict(list)
    for i, t in rows:
        docs[i].append([*library.encode(t or "", add_special_tokens=False).ids, 0])
    got = [tuple(r) for r in packing.pack(df).collect()]
    by_key = {k: v for k, v in docs.items() if k != 4}
    assert sum(r[2] for r in got if r[0] == 4) == 2 * len(docs[4][0])
    for key, own in by_key.items():
        assert sorted(r[1:5] for r in got if r[0] == key) == sorted(p for ids in own for p in _cuts(ids, [r[1:5] for r in got if r[0] == key]))
    assert packing.pack(df.where("doc_id = 99")).count() == 0

    texts = spark.read.parquet(f"{SF}/documents.parquet").collect()
    own = {r.doc_id: [[*library.encode(r.text, add_special_tokens=False).ids, 0]] for r in texts}
    fills = check([tuple(r) for r in queries.op1_packing(spark, SF).collect()], own)
    padding = sum(1024 - f for f in fills if f & (f - 1))
    assert padding <= 0.01 * sum(fills)


def test_pieces_are_encoded_in_runs_with_the_ids_of_each():
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    model = packing.Encoder(P.path("byte_bpe_50k.json"))
    calls, ids = [], model._ids
    model._ids = lambda text: calls.append(text) or ids(text)
    rnd = random.Random(11)
    words = ["a", "'s", "d'll", "12", "x,", "(", "\n", "x\n\ny", "é", "日本", "\u00a0", "<|endoftext|>", "a<|endoftext|>", "\x1c", "z\t", "\tz", "  ", "🙂"]
    pieces = [" " + w for w in words] + words + ["", " "] + [" w%d" % rnd.randrange(10**9) for _ in range(20_000)]
    rnd.shuffle(pieces)
    got = model.encode(pieces)
    assert len(calls) < 200  # it was one for each piece
    want = [e.ids for e in library.encode_batch(pieces, add_special_tokens=False)]
    assert [np.frombuffer(b, np.uint32).tolist() for b in got] == want
    assert model.encode([]) == []
    apart = packing.Encoder(P.path("byte_bpe_50k.json"))
    apart._n_bytes = apart._n_bytes * 0  # no end is found: each piece by itself
    assert apart.encode(pieces) == got


def test_memory_of_encoding_does_not_grow_with_the_batch():
    model = packing.Encoder(P.path("byte_bpe_50k.json"))
    text = " ".join(["a few words of no great length and then some more"] * 40)
    texts, memo = pa.array([text] * 4000), bpe.Memo(model.encode)  # 8 MB: it was one slice
    tracemalloc.start()
    n = sum(len(ids) for _, ids in model.documents(texts, 0, memo))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert n == 4000 * (len(model._ids(text)) + 1)
    assert peak < 24 << 20


def test_ids_whatever_the_slices_and_the_pieces_gathered_at_a_time(monkeypatch):
    library = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    rnd = random.Random(13)
    words = ["", "a", "\n", "x\n\ny", "é", "日本", "<|endoftext|>", "z\t", "🙂"]
    texts = ["", " ", "one", *(" ".join(rnd.choice(words) for _ in range(rnd.randrange(60))) for _ in range(200))]
    want = [[*e.ids, 0] for e in library.encode_batch(texts, add_special_tokens=False)]
    model = packing.Encoder(P.path("byte_bpe_50k.json"))
    for slice_bytes, gather in ((1, 1), (300, 7), (1 << 20, 1 << 16)):
        monkeypatch.setattr(packing, "_SLICE_BYTES", slice_bytes)
        monkeypatch.setattr(packing, "_GATHER", gather)
        got = dict((row, ids.tolist()) for row, ids in model.documents(pa.array(texts), 0, bpe.Memo(model.encode)))
        assert [got[i] for i in range(len(texts))] == want
