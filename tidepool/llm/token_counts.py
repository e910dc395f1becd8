"""Token counts by rank-synchronous array merging.

Map-only: each task counts its own rows, nothing is shuffled, and the text of
a row is only ever in the task that scans it. Defined results: a null or empty
text has 0 bytes and 0 tokens; repeated rows give repeated results; an empty
table gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm import bpe


@lru_cache(maxsize=2)
def merger(path: str) -> bpe.RankMerger:
    """One per Python worker."""
    return bpe.RankMerger(path)


def count_array(texts: pa.Array, memo: bpe.Memo) -> np.ndarray:
    out = np.zeros(len(texts), np.int64)
    for rows, parts in bpe.slices(texts):
        codes, starts, distinct, firsts = bpe.pieces(parts)
        counts = np.array(memo([" " + d for d in distinct]), np.int64)
        each = counts[codes]
        each[starts[:-1]] = memo(firsts)
        out[rows] = np.add.reduceat(each, starts[:-1])
    return out


def token_counts(docs: DataFrame, tokenizer: str = "byte_bpe_50k.json", limit: int = 1024,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_bytes, n_tokens and whether n_tokens exceeds `limit`, per row.

    `tokenizer` is a path on every executor, or a file name of
    public_tokenizers; it must be a byte-level BPE vocabulary.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # The memo is the task's own, and gone with it.
        memo = bpe.Memo(merger(bpe.vocabulary_path(tokenizer)).count_pieces)
        for b in batches:
            texts = b.column("text")
            n = count_array(texts, memo)
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), pc.binary_length(texts).cast(pa.int64()), pa.array(n), pa.array(n > limit)],
                names=["id", "n_bytes", "n_tokens", "over_limit"])

    src = docs.select(F.col(id_col).cast("bigint").alias("id"),
                      F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return (src.mapInArrow(run, "id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean")
            .withColumnRenamed("id", id_col))
