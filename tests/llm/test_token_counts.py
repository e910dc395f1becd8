import random

import numpy as np
import pyarrow as pa
import public_tokenizers as P
import pytest
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidepool.llm import bpe, packing, queries, token_counts
from tidepool.llm.bpe import Memo as memo

PATH = P.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_texts(n, seed=1):
    rnd = random.Random(seed)
    parts = [" ", "  ", "\n", " \n", "\t", "\x1c", "\x85", " ", "　", "a", "aaaa", "aaaaaaa", "ab'll", "'s", "<|endoftext|>",
             "é", "中文", "123", "½", "Ⅷ", "!!!", "😀", "x" * 300, "ab" * 50, "\U0001ccf2", "Ɤ", "ी"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 30))) for _ in range(n)]
    out += ["".join(chr(rnd.choice([rnd.randint(0, 0x250), rnd.randint(0x250, 0xd7ff), rnd.randint(0xe000, 0x1ffff), 32, 32]))
                    for _ in range(rnd.randint(0, 60))) for _ in range(n)]
    return [*out, "", " ", "<|endoftext|>", "a" * 20_000, " ".join(["word", "Word,", "the"] * 3000)]


def test_counts_and_ids_equal_the_library(library):
    texts = odd_texts(1500)
    ids = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert token_counts.count_array(pa.array(texts), memo(bpe.RankMerger(PATH).count_pieces)).tolist() == [len(i) for i in ids]
    model = packing.encoder(PATH)
    got = dict(model.documents(pa.array(texts), 0, memo(model.encode)))
    assert all(got[n].tolist() == [*i, 0] for n, i in enumerate(ids))


def test_small_slices_and_memo_change_nothing(library, monkeypatch):
    texts = odd_texts(150, seed=2)
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    slices = bpe.slices
    monkeypatch.setattr(bpe, "slices", lambda t: slices(t, 200))
    assert token_counts.count_array(pa.array(texts), memo(bpe.RankMerger(PATH).count_pieces, 50)).tolist() == want


def test_pretokens_agree_on_every_character_of_some_blocks():
    library = ByteLevel(add_prefix_space=False)
    for o in [*range(0x80, 0x600), *range(0xa7c0, 0xa800), *range(0x1cc00, 0x1cd00), *range(0x10d40, 0x10d90)]:
        text = f"a{chr(o)}1"
        assert bpe.pretokens(text) == [text[a:b] for _, (a, b) in library.pre_tokenize_str(text)]


def test_edge_rows(spark, library):
    rows = [(1, None), (None, "hello world"), (2, ""), (3, "a b " * 40_000), (3, "same"), (3, "same")]
    df = spark.createDataFrame([(*r, 7) for r in rows], "doc_id bigint, text string, id int")
    got = token_counts.token_counts(df).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "").ids), n > 1024) for i, t in rows]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert token_counts.token_counts(df.where("doc_id = 9")).count() == 0


def test_query_equals_the_library(spark, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = queries.op4_token_counts(spark, SF).collect()
    assert len(got) == len(texts)
    for r in got:
        n = len(library.encode(texts[r.doc_id], add_special_tokens=False).ids)
        assert tuple(r) == (r.doc_id, len(texts[r.doc_id].encode()), n, n > 1024)
    assert np.mean([r.over_limit for r in got]) > 0
