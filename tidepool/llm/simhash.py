"""Near-duplicates by SimHash fingerprints and covering hashing.

A fingerprint bit is the majority over the document's word shingles of that
bit of the shingle's XXH64. Fingerprints with at most `max_bits` differing
bits are linked, and documents take the smallest id of their component.

Finding the links: give each bit position i a non-zero vector m(i) of
max_bits + 1 bits. For every non-zero vector v, table v keeps the positions
with an odd inner product <m(i), v>. Whatever max_bits positions two
fingerprints differ in, some v is orthogonal to all their vectors, so table v
keeps none of them: the two fall into the same bucket of that table. That is a
guarantee, not a probability, for 2^(max_bits+1) - 1 tables of about 33 bits.

Copies collapse first: all work below the first step is on distinct
fingerprints. Links are then found without listing a bucket's pairs:

1. every member of a bucket is checked against the bucket's smallest and
   largest fingerprint, and the links found are contracted to components;
2. only buckets that still hold several components are joined with
   themselves, across components. A bucket of more than `split_above` members
   is first dealt again by covering hashing over the bits its members need not
   share, which keeps the guarantee; what then still shares a bucket agrees in
   about 49 of 64 bits, so the bucket holds at most some 2^15 fingerprints.

Every link between different components is among those pairs, so the result
is exact; `split_above` chooses a path, never a result.

Defined results: null and empty texts have fingerprint zero, linked like any
other; fewer words than a shingle count as one shingle; a null id takes part
in linking and never is a component's smallest id (null if all are); repeated
rows give repeated results; an empty table gives no rows; further columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.components import components
from tidepool.llm.store import Scratch

SEED = 42
_BLOCK = 1 << 15


def fingerprint(text: str | None, shingle: int = 4) -> int:
    """The unsigned 64-bit fingerprint of a whole text."""
    words = (text or "").encode().lower().split()  # both ASCII-only on bytes
    if not words:
        return 0
    joined = b" ".join(words)
    size = min(shingle, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]][:len(words) - size + 1].tolist()
    stops = (ends[size - 1:] - 1).tolist()
    n, ones, digest = len(starts), np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for lo in range(0, n, _BLOCK):  # bounds the memory that a very long text takes
        h = np.array([digest(joined[a:b], SEED) for a, b in zip(starts[lo:lo + _BLOCK], stops[lo:lo + _BLOCK])],
                     np.uint64)
        ones += np.unpackbits(h.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text",
                 carry: dict[str, Column] | None = None) -> DataFrame:
    """(id, fp, carried columns): fp is the fingerprint as a signed 64-bit integer."""
    carry = carry or {}
    names = list(carry)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in b.column("text")], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(fp), *[b.column(c) for c in names]],
                                             names=["id", "fp", *names])

    src = docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"),
                      *[c.alias(k) for k, c in carry.items()])
    kinds = dict(src.dtypes)
    return src.mapInArrow(run, ", ".join(["id bigint, fp bigint", *[f"{c} {kinds[c]}" for c in carry]]))


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over `positions` of which, for any `radius` of them, one has none."""
    vectors = (1 << (radius + 1)) - 1
    m = {p: j % vectors + 1 for j, p in enumerate(positions)}
    return [sum(1 << p for p in positions if (m[p] & v).bit_count() % 2) for v in range(1, vectors + 1)]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _near(a: str, b: str, max_bits: int) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b))) <= max_bits


def groups(scratch: Scratch, distinct: DataFrame, max_bits: int, split_above: int = 64) -> DataFrame:
    """(fp, root) for every fingerprint of `distinct` (fp) linked, directly or
    not, to a smaller one (by signed order) that is its component's smallest."""
    masks = covering_masks(list(range(64)), max_bits)
    keyed = distinct.select("fp", F.posexplode(F.array(
        *[F.col("fp").bitwiseAND(F.lit(_signed(m)).cast("bigint")) for m in masks])).alias("mask", "key"))
    bucket = ["mask", "key"]
    shared = scratch.write(keyed.groupBy(*bucket).agg(F.min("fp").alias("lo"), F.max("fp").alias("hi"))
                           .where("lo < hi"), "buckets")
    # Both grow with the documents: a merge join at every size.
    members = scratch.write(keyed.join(shared.hint("merge"), bucket), "members")
    ends = (members.where(_near("fp", "lo", max_bits)).select(F.col("fp").alias("a"), F.col("lo").alias("b"))
            .union(members.where(_near("fp", "hi", max_bits)).select("fp", "hi")))
    first = components(scratch, ends)

    named = scratch.write(members.join(first, F.col("fp") == F.col("v"), "left")
                          .select(*bucket, "fp", F.coalesce("root", "fp").alias("comp")), "named")
    mixed = scratch.write(named.groupBy(*bucket).agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"),
                                                     F.count("*").alias("n"))
                          .where("c0 < c1").select(*bucket, "n"), "mixed")
    rest = scratch.write(named.join(mixed, bucket), "rest")
    scratch.drop(shared, members, named, mixed)

    free = [[p for p in range(64) if not m >> p & 1] for m in masks]
    again = F.array(*[F.array(*[F.lit(_signed(m)).cast("bigint") for m in covering_masks(p, max_bits)]) for p in free])
    dealt = (rest.where(F.col("n") <= split_above).withColumn("sub", F.lit(-1)).withColumn("subkey", F.lit(0).cast("bigint"))
             .unionByName(rest.where(F.col("n") > split_above)
                          .select("*", F.posexplode(F.element_at(again, F.col("mask") + 1)).alias("sub", "submask"))
                          .withColumn("subkey", F.col("fp").bitwiseAND(F.col("submask"))).drop("submask")))
    left = dealt.select(*bucket, "sub", "subkey", F.col("fp").alias("fp1"), F.col("comp").alias("a"))
    right = dealt.select(*bucket, "sub", "subkey", F.col("fp").alias("fp2"), F.col("comp").alias("b"))
    across = (left.join(right, [*bucket, "sub", "subkey"]).where((F.col("a") < F.col("b")) & _near("fp1", "fp2", max_bits))
              .select("a", "b"))
    second = components(scratch, across)

    # A vertex of the second step is a root of the first, or was alone in it.
    one = first.join(second.withColumnRenamed("root", "top"), first.root == second.v, "left").select(
        first.v.alias("fp"), F.coalesce("top", "root").alias("root"))
    alone = second.join(first.select("v"), "v", "left_anti").select(F.col("v").alias("fp"), "root")
    out = scratch.write(one.union(alone), "groups")
    scratch.drop(rest, first, second)
    return out


def near_duplicates(docs: DataFrame, shingle: int = 4, max_bits: int = 4, split_above: int = 64,
                    id_col: str = "doc_id", text_col: str = "text", carry: dict[str, Column] | None = None) -> DataFrame:
    """id, fingerprint (16 hex digits) and component_id, per row, with the
    component's smallest fingerprint as root (signed) and carried columns."""
    scratch = Scratch(docs.sparkSession, "simhash")
    rows = scratch.write(fingerprints(docs, shingle, id_col, text_col, carry), "fingerprints")
    distinct = scratch.write(rows.groupBy("fp").agg(F.min("id").alias("first")), "distinct")
    linked = groups(scratch, distinct.select("fp"), max_bits, split_above)
    rooted = scratch.write(distinct.join(linked, "fp", "left")
                           .select("fp", F.coalesce("root", "fp").alias("root"), "first"), "rooted")
    smallest = scratch.write(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "smallest")
    named = scratch.write(rooted.join(smallest, "root").select("fp", "root", "component_id"), "components")
    scratch.drop(distinct, linked, rooted, smallest)
    return rows.join(named, "fp").select(
        F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id",
        "root", *(carry or {}))
