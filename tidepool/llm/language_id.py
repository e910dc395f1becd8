"""Language identification: multinomial naive Bayes over hashed character n-grams.

Learning: every task adds up n-gram counts of its labelled texts in one array
per language and emits one row per language, a block of buckets and its
counts; Spark sums the blocks by key. The result, languages x 2^bits, has a
size that the parameters bound and not the data, and goes to the driver and
from there to the tasks as a log-probability matrix. Scoring is map-only: a
text's n-grams are counted sparsely (distinct buckets and their counts) and
multiplied with the matrix.

About `sample` texts of a language are learned from, or all if it has fewer,
chosen by a hash of the id; the bound is on the model's fitting only. Every
text is scored whole.

Defined results: a null text, or one without a letter, is `und` with score 0;
so is every text if nothing could be learned. A null id counts as the empty
string for the fold. Ties go to the alphabetically first language. Languages
beyond the `max_langs` most frequent are not learned. Repeated rows give
repeated results; an empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import ngrams

SIZES = (1, 2, 3)
UNKNOWN = "und"
_SLICE = 1 << 16  # code points of a text that are hashed at a time; bounds memory


def held_out(id_col: str = "doc_id", folds: int = 5) -> Column:
    """Rows of the fold that is not learned from."""
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(folds)) == 0


def text_buckets(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct buckets of a whole text's n-grams and their counts."""
    points = ngrams.code_points(" " + " ".join(text.lower().split()) + " ")
    if len(points) <= 4096:
        return np.unique(ngrams.buckets(points, SIZES, bits), return_counts=True)
    counts = np.zeros(1 << bits, np.int64)
    for lo in range(0, len(points), _SLICE):  # the n-grams that start in the slice
        for n in SIZES:
            counts += np.bincount(ngrams.buckets(points[lo:lo + _SLICE + n - 1], (n,), bits), minlength=1 << bits)
    at = np.flatnonzero(counts)
    return at, counts[at]


def learn(docs: DataFrame, bits: int = 14, sample: int = 20_000, max_langs: int = 256, block: int = 1024,
          text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id") -> tuple[list[str], np.ndarray]:
    """(languages, counts): n-gram counts per language, float64 [languages, 2^bits]."""
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    sizes = (known.groupBy(lang_col).count().orderBy(F.desc("count"), lang_col).limit(max_langs)
             .toPandas())  # at most max_langs rows
    if sizes.empty:
        return [], np.zeros((0, 1 << bits))
    langs = sorted(sizes[lang_col])
    share = {r[0]: min(1.0, sample / r[1]) for r in sizes.itertuples(index=False)}
    rate = F.create_map(*[F.lit(x) for lang in langs for x in (lang, share[lang])])
    unit = F.pmod(F.xxhash64(F.col(key_col)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    taken = known.where(unit < F.try_element_at(rate, F.col(lang_col))).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {}
        for b in batches:
            for text, lang in zip(b["text"], b["lang"]):
                at, n = text_buckets(text, bits)
                if lang not in total:
                    total[lang] = np.zeros(1 << bits)
                total[lang][at] += n
        for lang, c in total.items():
            yield pd.DataFrame({"lang": lang, "block": range(0, len(c), block),
                                "counts": [c[i:i + block] for i in range(0, len(c), block)]})

    def add(part: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": part["lang"].iloc[:1], "block": part["block"].iloc[:1],
                             "counts": [np.sum(np.stack(part["counts"]), axis=0)]})

    schema = "lang string, block int, counts array<double>"
    parts = taken.mapInPandas(count, schema)
    # A first sum by a spread of the tasks, so that no key gathers a row from every task.
    parts = (parts.withColumn("spread", F.spark_partition_id() % 32).groupBy("lang", "block", "spread")
             .applyInPandas(lambda p: add(p), schema).groupBy("lang", "block").applyInPandas(add, schema))
    counts = np.zeros((len(langs), 1 << bits))
    for r in parts.toLocalIterator():  # languages x blocks
        counts[langs.index(r.lang), r.block:r.block + len(r.counts)] = r.counts
    return langs, counts


def identify(docs: DataFrame, langs: list[str], counts: np.ndarray, smoothing: float = 0.5,
             keep: dict[str, Column] | None = None, text_col: str = "text") -> DataFrame:
    """keep, lang_pred and score (its posterior probability) per row."""
    keep = keep or {}
    seen = counts.sum(1) > 0
    langs, counts = [x for x, s in zip(langs, seen) if s], counts[seen] + smoothing
    log_p = np.log(counts / counts.sum(1, keepdims=True)).astype(np.float32).T.copy() if langs else None
    bits = (counts.shape[1] - 1).bit_length()
    model = docs.sparkSession.sparkContext.broadcast((langs, log_p))
    names = list(keep)

    def one(text: str | None) -> tuple[str, float]:
        langs_, matrix = model.value
        if not langs_ or text is None or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        at, n = text_buckets(text, bits)
        score = n.astype(np.float32) @ matrix[at]
        best = int(np.argmax(score))
        return langs_[best], float(1 / np.exp(score - score[best], dtype=np.float64).sum())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [one(t.as_py()) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(k) for k in names] + [pa.array([f[0] for f in found], pa.string()),
                                                pa.array([f[1] for f in found], pa.float64())],
                names=[*names, "lang_pred", "score"])

    src = docs.select(*[c.alias(k) for k, c in keep.items()], F.col(text_col).alias("text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields if f.name in keep]
    return src.mapInArrow(run, ", ".join([*fields, "lang_pred string", "score double"]))


def predict_languages(docs: DataFrame, bits: int = 14, sample: int = 20_000, smoothing: float = 0.5, folds: int = 5,
                      id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """id, held_out, lang_pred and score: learned from the rows that are not
    held out, predicted for all."""
    out = held_out(id_col, folds)
    langs, counts = learn(docs.where(~out), bits, sample, text_col=text_col, lang_col=lang_col, key_col=id_col)
    return identify(docs, langs, counts, smoothing,
                    {id_col: F.col(id_col).cast("bigint"), "held_out": out}, text_col)
