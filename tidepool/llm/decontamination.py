"""Benchmark decontamination by spaced seeds.

Texts are sequences of lower-cased words. A spaced seed is a mask over a
window of words; its hash leaves out the masked positions, so that a window in
which only those were substituted still has the same hash. The masks are
hashed at every position of benchmark items and of documents, the hashes are
joined, and a join hit fixes an item, a document and how the two align. Around
the hit the aligned words are compared: a document is contaminated if some
`overlap` aligned words in a row (or the whole item, if shorter) agree in at
least `agree` of their positions. The masks of an item are chosen by enumeration
(`masks_of`): every way to substitute as many of the required words as `agree`
admits leaves at least one mask a hit, so no contaminated document is missed.
A shorter passage of a longer item than `overlap` words is no contamination.

A document's windows that cannot match are left out before the shuffle by a
Bloom filter of the benchmark's hashes. Its size is `filter_bits`, whatever
the benchmark's; a benchmark too large for it only lets more windows through
to the join, which decides. Hits of a document that lie near one another
travel as one span with its words' hashes.

Shorter items have masks of their own, of lower weight the fewer words they
have; items below `min_words` words are too short to tell and match nothing.
Items of equal words are compared once. Defined results: a null or empty text is clean; an empty
benchmark makes every document clean; null ids are carried; repeated rows give
repeated results, as verdicts are joined by a 128-bit hash of the text; an
empty table gives no rows; further columns are passed through, except that
contaminated, items and agreement are replaced if present.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.store import Scratch

#: Masks have at most this weight, this span, and are this many to a length.
MOST_WEIGHT, MOST_SPAN, MOST_MASKS = 8, 13, 6
#: Patterns of substitutions enumerated at most; beyond it, a part is looked at.
MOST_PATTERNS = 10_000
_WORDS = re.compile(r"\w+")
_ODD = np.array([2 * i + 1 for i in range(64)], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xFF51AFD7ED558CCD)
_PROBES = (0, 17, 34)
_PAGE = 32768  # bits of one bitmap row
BLOCK = 1 << 16  # words that are hashed at a time, of many documents or a part of one


class Hashes(dict):
    """Word hashes, remembered up to a bound on memory; each task has its own."""

    def __missing__(self, word: str) -> int:
        if len(self) > 300_000:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


def words(text: str | None, hashes: Hashes) -> np.ndarray:
    found = _WORDS.findall((text or "").lower())
    return np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))


def substitutions(need: int, agree: float) -> int:
    """How many of `need` aligned words may differ; at least one agrees."""
    return max(k for k in range(need) if k == 0 or (need - k) / need >= agree)


@lru_cache(maxsize=None)
def _covering(length: int, misses: int, earlier: tuple[str, ...]) -> tuple[str, ...]:
    """Masks (0 leaves a word out) of which one fits, at some place of `length`
    words, between any `misses` substituted ones. The weight is the largest
    that MOST_MASKS masks do with; masks of `earlier` that do half as well as the
    best are taken first."""
    parts = 1
    while comb(length // parts, misses // parts) > MOST_PATTERNS:
        parts += 1  # one of so many parts has no more than its share of the misses
    length, misses = length // parts, misses // parts
    patterns = np.array([sum(1 << i for i in c) for c in combinations(range(length), misses)], np.int64)
    for weight in range(min(MOST_WEIGHT, length - misses), 0, -1):
        masks = {m: int(m[::-1], 2) for m in earlier if len(m) <= length and m.count("1") >= weight}
        old = len(masks)
        for span in range(weight, min(length, max(MOST_SPAN, weight)) + 1):
            for c in combinations(range(1, span - 1), weight - 2) if weight > 1 else [()][span - 1:]:
                bits = 1 | sum(1 << i for i in c) | 1 << (span - 1)
                masks.setdefault(format(bits, "b")[::-1], bits)
        fits = np.zeros((len(masks), len(patterns)), np.float32)
        for row, (mask, bits) in zip(fits, masks.items()):
            for at in range(length - len(mask) + 1):
                row[(patterns & (bits << at)) == 0] = 1
        names, left, chosen = list(masks), np.ones(len(patterns), np.float32), []
        while left.any() and len(chosen) < MOST_MASKS:
            gain = fits @ left
            best = int(gain.argmax())
            if old and gain[:old].max() * 2 >= gain[best]:
                best = int(gain[:old].argmax())
            if not gain[best]:
                break
            chosen.append(names[best])
            left[fits[best] > 0] = 0
        if not left.any():
            return tuple(chosen)
    raise ValueError(f"no masks for {misses} of {length} words")  # not reached: a single word fits


@lru_cache(maxsize=None)
def masks_of(overlap: int, agree: float, min_words: int) -> dict[int, tuple[str, ...]]:
    """The masks for items of which 1, 2, ... `overlap` words are required."""
    out: dict[int, tuple[str, ...]] = {}
    used: dict[str, None] = {}
    last, masks = -1, ()
    for need in range(max(1, min_words), overlap + 1):
        # More words with no more substitutions hold a window of the fewer ones.
        if (misses := substitutions(need, agree)) != last:
            last, masks = misses, _covering(need, misses, tuple(used))
            used.update(dict.fromkeys(masks))
        out[need] = masks
    return out


def places(w: np.ndarray, span: int) -> list[np.ndarray]:
    """The words' hashes as they count at each place of a mask."""
    mixed = w ^ (w >> np.uint64(31))
    return [mixed * odd for odd in _ODD[:span]]


def seeds(at: list[np.ndarray], mask: str) -> np.ndarray:
    """Hash of the mask's words at every place of a text."""
    n = len(at[0]) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, np.uint64(int(mask, 2)), np.uint64)
    for k, one in enumerate(mask):
        if one == "1":
            h += at[k][k:k + n]
    h ^= h >> np.uint64(32)
    return h * _MIX


def _set(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Places whose hash may be in the filter."""
    size = np.uint64(len(bits) * 8 - 1)
    at = np.arange(len(h))
    for p in _PROBES:
        b = (h[at] >> np.uint64(p)) & size
        at = at[(bits[b >> np.uint64(3)] >> (b & np.uint64(7)).astype(np.uint8)) & 1 > 0]
    return at


def benchmark_seeds(benchmark: DataFrame, min_words: int, id_col: str, text_col: str, overlap: int = 20,
                    agree: float = 0.8) -> DataFrame:
    """(item, words, seeds): distinct word sequences, named by their smallest
    id, with all ids and their seeds (h, at)."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = Hashes()
        for b in batches:
            w = [words(t, hashes) for t in b["text"]]
            yield pd.DataFrame({"id": b["id"], "words": [x.view(np.int64) for x in w]})[[len(x) >= min_words for x in w]]

    src = benchmark.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    one = (src.mapInPandas(run, "id bigint, words array<bigint>").groupBy("words")
           .agg(F.sort_array(F.collect_set("id")).alias("ids")))

    masks = masks_of(overlap, agree, min(min_words, overlap))
    span = max(len(m) for ms in masks.values() for m in ms)

    @F.pandas_udf("array<struct<h:bigint,at:int>>")
    def of(rows: pd.Series) -> pd.Series:
        out = []
        for r in rows:
            w = np.asarray(r, np.int64).view(np.uint64)
            at_place = places(w, span)
            found = [seeds(at_place, m) for m in masks.get(min(overlap, len(w)), ())]
            out.append([{"h": int(h), "at": at} for f in found for at, h in enumerate(f.view(np.int64))])
        return pd.Series(out)

    return one.select(F.xxhash64("words", "ids").alias("item"), "ids", "words", of("words").alias("seeds"))


def filter_bitmap(hashes: DataFrame, filter_bits: int) -> np.ndarray:
    """The Bloom filter of (h): filter_bits / 32768 rows of fixed size are collected."""
    positions = F.explode(F.array(*[F.shiftrightunsigned("h", p).bitwiseAND(F.lit(filter_bits - 1)) for p in _PROBES]))
    pages = (hashes.select(positions.alias("b")).groupBy(F.expr(f"b div {_PAGE}").alias("page"))
             .agg(F.bitmap_construct_agg(F.col("b") % _PAGE).alias("bits")).collect())
    out = np.zeros(filter_bits // 8, np.uint8)
    for r in pages:
        out[r.page * (_PAGE // 8):(r.page + 1) * (_PAGE // 8)] = np.frombuffer(r.bits, np.uint8)
    return out


def hits_in(w: np.ndarray, ends: np.ndarray, masks: list[str], span: int, filter_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash), by place, of the windows of documents laid end to end (one
    ends before each of `ends`) that may be in the filter. A stretch of BLOCK
    places is looked at in one go, however many documents it holds."""
    at, hs = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    for lo in range(0, len(w), BLOCK):
        part = w[lo:lo + BLOCK + span - 1]
        at_place = places(part, span)
        for m in masks:
            h = seeds(at_place, m)[:BLOCK]
            found = _set(filter_, h)
            begin = found + lo
            inside = np.searchsorted(ends, begin, "right") == np.searchsorted(ends, begin + len(m) - 1, "right")
            at.append(begin[inside])
            hs.append(h[found[inside]])
    at, hs = np.concatenate(at), np.concatenate(hs)
    order = np.argsort(at, kind="stable")
    return at[order], hs[order].view(np.int64)


def spans(docs: DataFrame, bits: np.ndarray, masks: list[str], around: int) -> DataFrame:
    """(d1, d2, first, words, hits) from docs (d1, d2, text): stretches of a
    document with possible hits (h, at), their words from word `first` on."""
    span = max(map(len, masks), default=1)
    shared = docs.sparkSession.sparkContext.broadcast(bits)
    hit = pa.struct([("h", pa.int64()), ("at", pa.int64())])
    schema = pa.schema([("d1", pa.int64()), ("d2", pa.int64()), ("first", pa.int64()),
                        ("words", pa.list_(pa.int64())), ("hits", pa.list_(hit))])

    def found_in(block: list[tuple[int, int, np.ndarray]], filter_: np.ndarray) -> pa.RecordBatch:
        w = np.concatenate([x[2] for x in block])
        ends = np.cumsum([len(x[2]) for x in block])
        at, hs = hits_in(w, ends, masks, span, filter_)
        doc = np.searchsorted(ends, at, "right")
        rows = []
        for part in np.split(np.arange(len(at)), np.flatnonzero((np.diff(at) > 2 * around) | (np.diff(doc) > 0)) + 1):
            if not len(part):
                continue
            d1, d2, own = block[doc[part[0]]]
            base = int(ends[doc[part[0]]]) - len(own)
            first = max(0, int(at[part[0]]) - base - around)
            last = int(at[part[-1]]) - base + span + around
            rows.append((d1, d2, first, own[first:last].view(np.int64),
                         [{"h": int(h), "at": int(a) - base} for h, a in zip(hs[part], at[part])]))
        columns = list(zip(*rows)) or [[]] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_, hashes, block, size = shared.value, Hashes(), [], 0
        for b in batches:
            for d1, d2, text in zip(b.column("d1").to_pylist(), b.column("d2").to_pylist(), b.column("text")):
                block.append((d1, d2, words(text.as_py(), hashes)))
                size += len(block[-1][2])
                if size >= BLOCK:
                    yield found_in(block, filter_)
                    block, size = [], 0
        if block:
            yield found_in(block, filter_)

    return docs.mapInArrow(run, "d1 bigint, d2 bigint, first bigint, words array<bigint>, hits array<struct<h:bigint,at:bigint>>")


def best_agreement(item: np.ndarray, doc: np.ndarray, shift: int, overlap: int) -> float:
    """Best share of equal words among `overlap` aligned ones in a row, item
    word i standing at doc word i + shift."""
    need = min(overlap, len(item))
    lo, hi = max(0, -shift), min(len(item), len(doc) - shift)
    if hi - lo < need:
        return 0.0
    same = np.r_[0, np.cumsum(item[lo:hi] == doc[lo + shift:hi + shift])]
    return float((same[need:] - same[:-need]).max() / need)


def contaminated(scratch: Scratch, docs: DataFrame, benchmark: DataFrame, overlap: int = 20, agree: float = 0.8,
                 min_words: int = 5, filter_bits: int = 1 << 25, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(d1, d2, items, agreement) of contaminated texts among docs (d1, d2, text)."""
    items = scratch.write(benchmark_seeds(benchmark, min_words, item_col, item_text_col, overlap, agree), "items")
    known = scratch.write(items.select("item", F.explode("seeds").alias("s")).select("item", "s.h", "s.at"), "seeds")
    # At most `overlap` lengths, whatever the benchmark's size.
    needs = sorted(r[0] for r in items.select(F.least(F.size("words"), F.lit(overlap))).distinct().collect())
    of = masks_of(overlap, agree, min(min_words, overlap))
    masks = list(dict.fromkeys(m for need in needs for m in of.get(need, ())))
    found = scratch.write(spans(docs, filter_bitmap(known.select("h"), filter_bits), masks, overlap)
                          .dropDuplicates(["d1", "d2", "first"]), "spans")
    hits = found.select("d1", "d2", "first", F.explode("hits").alias("hit")).select("d1", "d2", "first", "hit.h", (F.col("hit.at") - F.col("first")).alias("place"))
    aligned = scratch.write(hits.join(known, "h").select("d1", "d2", "first", "item", (F.col("place") - F.col("at")).alias("shift"))
                            .distinct(), "aligned")

    @F.pandas_udf("double")
    def agreement(item: pd.Series, doc: pd.Series, shift: pd.Series) -> pd.Series:
        return pd.Series([best_agreement(np.asarray(i), np.asarray(d), int(s), overlap) for i, d, s in zip(item, doc, shift)], dtype=float)

    scored = (aligned.join(items.select("item", "ids", F.col("words").alias("item_words")), "item")
              .join(found.drop("hits"), ["d1", "d2", "first"])
              # Only the words that the item lies against go on.
              .select("d1", "d2", "ids", "item_words", F.least("shift", F.lit(0)).alias("shift"),
                      F.slice("words", F.greatest("shift", F.lit(0)) + 1, F.greatest(F.lit(0), F.size("item_words") + F.least("shift", F.lit(0)))).alias("words"))
              .select("d1", "d2", "ids", agreement("item_words", "words", "shift").alias("agreement"))
              .where(F.col("agreement") >= agree))
    best = (scored.select("d1", "d2", F.explode("ids").alias("id"), "agreement")
            .groupBy("d1", "d2", "id").agg(F.max("agreement").alias("agreement"))
            .groupBy("d1", "d2").agg(F.sort_array(F.collect_list("id")).alias("items"), F.max("agreement").alias("agreement")))
    out = scratch.write(best, "contaminated")
    scratch.drop(known, found, aligned, items)
    return out


def text_key(text_col: str) -> tuple[Column, Column]:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.xxhash64(text), F.xxhash64(F.lit(1), text)


def decontaminate(docs: DataFrame, benchmark: DataFrame, overlap: int = 20, agree: float = 0.8, min_words: int = 5,
                  text_col: str = "text", **options) -> DataFrame:
    """The rows of docs with contaminated, the items found and the best agreement."""
    scratch = Scratch(docs.sparkSession, "decontaminate")
    d1, d2 = text_key(text_col)
    keyed = docs.select(d1.alias("d1"), d2.alias("d2"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    hit = contaminated(scratch, keyed, benchmark, overlap, agree, min_words, **options)
    joined = docs.select(F.struct("*").alias("row"), d1.alias("d1"), d2.alias("d2")).join(hit, ["d1", "d2"], "left")
    out = joined.select("row.*", F.struct("items", "agreement").alias("__hit"))
    return out.withColumns({"contaminated": F.col("__hit.items").isNotNull(), "items": F.col("__hit.items"),
                            "agreement": F.col("__hit.agreement")}).drop("__hit")
