"""Alignment of the tokens that two tokenizers cut the same text into.

Tokenizer A is a byte-level BPE, tokenizer B a sentencepiece model that puts a
space in front of a text; A gets that space too, so both spell the same bytes.
The ascending byte offsets at which tokens end are one list per tokenizer. The
common offsets come from galloping: the shorter list drives, a block at a time;
steps that double find how far the block reaches into the longer list, binary
search in that stretch finds its members. Common offsets slice both lists into
groups; differences of ranks give each group's range of A and of B tokens, and
every A token of a group is linked with every B token of it.

How many documents hold an id pair linked is counted over the whole corpus by a
grouping. Those counts come back to the documents in two ways at every size:
the most frequent pairs, as many as fit `hot_pairs`, as a broadcast table of
that bounded size, and all others by a join. So a pair that most documents
hold is never a join key, and what is joined are the rare ones.

Texts are taken in slices of about `slice_bytes`, cut where no token of either
vocabulary can cross (`bpe.slices`), and each distinct piece of a slice is
encoded once. B must not have pieces with a space after another character;
this is checked when it is loaded.

Defined results: a null or empty text, or one whose A or B tokens do not spell
the space and the text (it holds U+2581, say), has no tokens, groups or links
and '' for groups; texts of any length are whole (a longer one than a slice is
a slice of its own); repeated rows are documents of their own and count as
such; a pair that is linked several times in a document is one document's
count and several links; ties for the highest count are all best; a null id is
carried; an empty table gives no rows; further columns are ignored, whatever
their names. Building the result runs the counting jobs.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import bpe
from tidepool.llm.store import Scratch

BLOCK = 256
#: Groups with more links than this are reduced to distinct ids first.
_WIDE = 1 << 12

_ALIGNED = pa.schema([("row", pa.int64()), ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                      ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.large_binary()),
                      ("pairs", pa.list_(pa.int64())), ("times", pa.list_(pa.int64()))])


def gallop(short: np.ndarray, long: np.ndarray, block: int = BLOCK) -> np.ndarray:
    """Index in `long` of each member of `short`, -1 if it is not there. Both ascend."""
    out = np.full(len(short), -1, np.int64)
    lo = 0
    for at in range(0, len(short), block):
        want = short[at:at + block]
        step, hi = block, lo
        while hi < len(long) and long[hi] < want[-1]:
            hi += step
            step *= 2
        stretch = long[lo:hi + 1]
        found = np.searchsorted(stretch, want)
        inside = np.flatnonzero(found < len(stretch))
        same = inside[stretch[found[inside]] == want[inside]]
        out[at + same] = lo + found[same]
        lo += int(found[-1])
        if lo >= len(long):
            break
    return out


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices in a and in b of the offsets that both hold."""
    swap = len(b) < len(a)
    at = gallop(b, a) if swap else gallop(a, b)
    hit = np.flatnonzero(at >= 0)
    return (at[hit], hit) if swap else (hit, at[hit])


class Aligner:
    """Two vocabularies, and the pieces of a task in both."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        import tiktoken
        with open(path_a, encoding="utf-8") as f:
            spec = json.load(f)
        stand_in = bpe.byte_symbols()
        special = {t["content"] for t in spec.get("added_tokens") or []}
        ranks = {bytes(stand_in[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        self.a = tiktoken.Encoding("alignment", pat_str=bpe.PRETOKEN.pattern, mergeable_ranks=ranks, special_tokens={})
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        size_a, size_b = max(ranks.values()) + 1, self.b.vocab_size()
        a_bytes = dict(zip(ranks.values(), ranks))
        names = [self.b.id_to_piece(i) for i in range(size_b)]
        if any("▁" in n.lstrip("▁") for n in names):
            raise ValueError("a piece of tokenizer B has a space after another character")
        self.b_bytes = [bytes([int(n[3:-1], 16)]) if self.b.is_byte(i) else n.replace("▁", " ").encode()
                        for i, n in enumerate(names)]
        self.len_a = np.array([len(a_bytes.get(i, b"")) for i in range(size_a)], np.int64)
        self.len_b = np.array([len(x) for x in self.b_bytes], np.int64)
        self.radix = size_b
        # A token's decimal id with what follows it: another one or the group's other half.
        self.words = ([b"%d," % i for i in range(size_a)] + [b"%d|" % i for i in range(size_a)]
                      + [b"%d," % i for i in range(size_b)] + [b"%d;" % i for i in range(size_b)])

    def encode(self, pieces: list[str]) -> list[tuple[bytes, bytes, bool]]:
        """(A ids, B ids, whether B spells the piece) of every piece with a space in front."""
        out = []
        for piece, b in zip(pieces, self.b.encode(pieces, num_threads=1)):
            spaced = " " + piece
            out.append((np.array(self.a.encode_ordinary(spaced), np.int32).tobytes(), np.array(b, np.int32).tobytes(),
                        b"".join(map(self.b_bytes.__getitem__, b)) == spaced.encode()))
        return out

    def align(self, codes: np.ndarray, starts: np.ndarray, encoded: list[tuple[bytes, bytes, bool]]) -> dict[str, list]:
        """Columns n_a ... times for texts made of the pieces codes[starts[i]:starts[i+1]], at least one each."""
        n = len(starts) - 1
        fine = np.logical_and.reduceat(np.array([e[2] for e in encoded])[codes], starts[:-1])
        codes, sizes = codes[np.repeat(fine, np.diff(starts))], np.diff(starts)[fine]
        text = np.repeat(np.arange(len(sizes)), sizes)
        a, in_a = _spread([e[0] for e in encoded], codes, text, len(sizes))
        b, in_b = _spread([e[1] for e in encoded], codes, text, len(sizes))
        at_a, at_b = common_ends(np.cumsum(self.len_a[a]), np.cumsum(self.len_b[b]))
        from_a, from_b = np.r_[0, at_a[:-1] + 1], np.r_[0, at_b[:-1] + 1]
        wide_a, wide_b = at_a + 1 - from_a, at_b + 1 - from_b
        of = np.searchsorted(np.cumsum(in_a), at_a, "right")  # each group's text; every text's end is common

        pairs, times = self._pairs(a, b, from_a, from_b, wide_a, wide_b, of)
        split = np.searchsorted(pairs[0], np.arange(len(sizes) + 1))
        kinds = np.empty(len(a) + len(b), np.int64)
        group_a, group_b = np.repeat(np.arange(len(at_a)), wide_a), np.repeat(np.arange(len(at_a)), wide_b)
        last_a, last_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        last_a[at_a], last_b[at_b] = len(self.len_a), self.radix
        kinds[np.arange(len(a)) + from_b[group_a]] = a + last_a
        kinds[np.arange(len(b)) + at_a[group_b] + 1] = b + last_b + 2 * len(self.len_a)
        ends = np.r_[0, np.cumsum(in_a + in_b)]
        word = self.words.__getitem__
        spelt = [b"".join(map(word, kinds[lo:hi].tolist()))[:-1] for lo, hi in zip(ends[:-1].tolist(), ends[1:].tolist())]

        groups, links = np.bincount(of, minlength=len(sizes)), np.bincount(of, wide_a * wide_b, len(sizes)).astype(np.int64)
        put = {name: np.zeros(n, np.int64) for name in ("n_a", "n_b", "n_groups", "n_links", "lists")}
        for name, values in zip(put, (in_a, in_b, groups, links, np.diff(split))):
            put[name][fine] = values
        texts = iter(spelt)
        offsets = pa.array(np.r_[0, np.cumsum(put.pop("lists"))], pa.int32())
        return {k: pa.array(v) for k, v in put.items()} | {
            "groups": pa.array([next(texts) if f else b"" for f in fine], pa.large_binary()),
            "pairs": pa.ListArray.from_arrays(offsets, pa.array(pairs[1])),
            "times": pa.ListArray.from_arrays(offsets, pa.array(times))}

    def _pairs(self, a, b, from_a, from_b, wide_a, wide_b, of):
        """((text, id pair), times linked) of distinct pairs, by text and pair."""
        many = wide_a * wide_b
        thin = np.flatnonzero(many <= _WIDE)
        total = int(many[thin].sum())
        group = np.repeat(thin, many[thin])
        k = np.arange(total) - np.repeat(np.cumsum(many[thin]) - many[thin], many[thin])
        ids = a[from_a[group] + k // wide_b[group]].astype(np.int64) * self.radix + b[from_b[group] + k % wide_b[group]]
        texts, times = [of[group]], [np.ones(total, np.int64)]
        ids = [ids]
        for g in np.flatnonzero(many > _WIDE):
            left, n_left = np.unique(a[from_a[g]:from_a[g] + wide_a[g]], return_counts=True)
            right, n_right = np.unique(b[from_b[g]:from_b[g] + wide_b[g]], return_counts=True)
            ids.append((left.astype(np.int64)[:, None] * self.radix + right).ravel())
            times.append(np.outer(n_left, n_right).ravel())
            texts.append(np.full(len(ids[-1]), of[g]))
        texts, ids, times = np.concatenate(texts), np.concatenate(ids), np.concatenate(times)
        order = np.lexsort((ids, texts))
        texts, ids, times = texts[order], ids[order], times[order]
        new = np.flatnonzero(np.r_[True, (np.diff(texts) != 0) | (np.diff(ids) != 0)]) if len(ids) else np.zeros(0, np.int64)
        return (texts[new], ids[new]), np.add.reduceat(times, new) if len(new) else times


def _spread(parts: list[bytes], codes: np.ndarray, text: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the pieces `codes` in a row, and how many each of n texts has."""
    flat = np.frombuffer(b"".join(parts), np.int32)
    sizes = np.array([len(p) >> 2 for p in parts], np.int64)
    begins, each = np.cumsum(sizes) - sizes, sizes[codes]
    ends = np.cumsum(each)
    take = np.repeat(begins[codes] - (ends - each), each) + np.arange(ends[-1] if len(ends) else 0)
    return flat[take], np.bincount(text, each, n).astype(np.int64)


@lru_cache(maxsize=2)
def aligner(path_a: str, path_b: str) -> Aligner:
    """One per Python worker."""
    return Aligner(path_a, path_b)


def aligned(docs: DataFrame, tokenizer_a: str, tokenizer_b: str, id_col: str = "doc_id", text_col: str = "text",
            slice_bytes: int = 2 << 20) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, groups, pairs, times): each row's
    groups as `a1,a2|b1;a3|b2,b3`, its distinct id pairs (A id times the size
    of B's vocabulary, plus B id) and how often each is linked. Map-only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = aligner(bpe.vocabulary_path(tokenizer_a), bpe.vocabulary_path(tokenizer_b))
        memo = bpe.Memo(model.encode, limit=200_000)  # the task's own, and gone with it
        row = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts, ids = batch.column("text"), batch.column("id")
            for rows, parts in bpe.slices(texts, slice_bytes):
                codes, starts, distinct, _ = bpe.pieces(parts)
                # An empty text is the empty piece, which spells no text at all.
                encoded = [e if d else (b"", b"", False) for d, e in zip(distinct, memo(distinct))]
                columns = model.align(codes.astype(np.int64), starts, encoded)
                columns |= {"row": pa.array(np.arange(row, row + len(rows))), "id": ids.take(pa.array(rows))}
                row += len(rows)
                yield pa.RecordBatch.from_arrays([columns[f.name] for f in _ALIGNED], schema=_ALIGNED)

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return src.mapInArrow(run, "row bigint, id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, "
                               "groups binary, pairs array<bigint>, times array<bigint>").withColumn("groups", F.col("groups").cast("string"))


def pair_counts(scratch: Scratch, rows: DataFrame, radix: int) -> DataFrame:
    """(pair, n, best): in how many rows each id pair is linked, and whether no
    other pair of its A id is in more. Map-side sums; nothing gathers a group."""
    counts = scratch.write(rows.select(F.explode("pairs").alias("pair")).groupBy("pair").agg(F.count("*").alias("n")), "pairs")
    a = F.expr(f"pair div {radix}")
    most = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return scratch.write(counts.withColumn("a", a).join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "counts")


def hot_from(counts: DataFrame, hot_pairs: int) -> int:
    """The least power of two such that no more than hot_pairs pairs are as
    frequent. At most 63 rows are collected."""
    level = F.length(F.conv(F.col("n").cast("string"), 10, 2))
    sizes = {r.level: r.m for r in counts.groupBy(level.alias("level")).agg(F.count("*").alias("m")).collect()}
    seen, least = 0, max(sizes, default=0) + 1
    for k in sorted(sizes, reverse=True):
        seen += sizes[k]
        if seen > hot_pairs:
            break
        least = k
    return 1 << (least - 1) if least else 1


def with_counts(scratch: Scratch, rows: DataFrame, counts: DataFrame, hot_pairs: int) -> DataFrame:
    """rows without pairs and times, with n_best and count_sum."""
    least = hot_from(counts, hot_pairs)
    hot = counts.where(F.col("n") >= least).toArrow()  # hot_pairs rows at most
    known = hot.column("pair").to_numpy()
    order = np.argsort(known)
    shared = rows.sparkSession.sparkContext.broadcast(
        (known[order], hot.column("n").to_numpy()[order], hot.column("best").to_numpy()[order]))
    kept = [c for c in rows.columns if c not in ("pairs", "times")]
    fields = ["row", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, n, best = shared.value
        for batch in batches:
            pairs, times = batch.column("pairs"), batch.column("times")
            sizes = pc.list_value_length(pairs).to_numpy(zero_copy_only=False).astype(np.int64)
            row = np.repeat(np.arange(len(sizes)), sizes)
            flat, often = pairs.flatten().to_numpy(), times.flatten().to_numpy()
            at = np.minimum(np.searchsorted(known, flat), max(len(known) - 1, 0))
            hit = known[at] == flat if len(known) else np.zeros(len(flat), bool)
            n_best, total = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
            np.add.at(n_best, row[hit], often[hit] * best[at[hit]])
            np.add.at(total, row[hit], often[hit] * n[at[hit]])
            left = np.bincount(row[~hit], minlength=len(sizes))
            offsets = pa.array(np.r_[0, np.cumsum(left)], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], pa.array(n_best), pa.array(total),
                 pa.ListArray.from_arrays(offsets, pa.array(flat[~hit])),
                 pa.ListArray.from_arrays(offsets, pa.array(often[~hit]))], names=[*kept, "n_best", "count_sum", "pairs", "times"])

    kinds = dict(rows.dtypes)
    schema = ", ".join([*[f"`{c}` {kinds[c]}" for c in kept], "n_best bigint, count_sum bigint, pairs array<bigint>, times array<bigint>"])
    scored = scratch.write(rows.mapInArrow(run, schema), "scored")
    rare = (scored.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("p")).select("row", "p.pairs", "p.times")
            .join(counts.where(F.col("n") < least), F.col("pairs") == F.col("pair"))
            .groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
                                F.sum(F.col("times") * F.col("n")).alias("more_sum")))
    return (scored.drop("pairs", "times").join(rare, "row", "left")
            .select(*kept, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
                    (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum")))


def align(docs: DataFrame, tokenizer_a: str = "byte_bpe_50k.json", tokenizer_b: str = "piece_bpe_32k.model",
          hot_pairs: int = 1 << 18, id_col: str = "doc_id", text_col: str = "text",
          derive: dict[str, Column] | None = None) -> DataFrame:
    """id, n_a, n_b, n_groups, n_links, n_best, count_sum per row, and its
    groups, or instead the columns `derive` of them.

    The tokenizers are paths on every executor, or file names of
    public_tokenizers.
    """
    import sentencepiece
    scratch = Scratch(docs.sparkSession, "alignment")
    radix = sentencepiece.SentencePieceProcessor(model_file=bpe.vocabulary_path(tokenizer_b)).vocab_size()
    found = aligned(docs, tokenizer_a, tokenizer_b, id_col, text_col)
    if derive:
        found = found.withColumns(derive).drop(*{"groups"} - set(derive))
    rows = scratch.write(found, "aligned")
    out = with_counts(scratch, rows, pair_counts(scratch, rows.select("pairs"), radix), hot_pairs)
    return out.drop("row").withColumnRenamed("id", id_col)
