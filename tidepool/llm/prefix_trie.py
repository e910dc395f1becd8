"""Prefix trie of conversations, its subtree totals by time-forward processing.

A node of depth d is a distinct sequence of the first d turns (role, text); its
members are the conversations that begin with it, its owner is the smallest of
them. A turn counts as its hash with its position, and a prefix as the sums of
its turns' hashes (128 bits in four parts), so that all prefixes come from
running sums: within blocks of `block` turns, and over the block totals. No
conversation, however long, is one group, and a prefix that a third of all
conversations share is one row a map task.

Subtree totals are sent from children to parents. Nodes are sorted by reverse
level order; a node that is reached takes the messages addressed to it from a
priority queue, adds its own values and puts a message to its parent. The queue
keeps `queue` messages in memory and sorted runs of the rest in the task's own
unnamed spill files.

Shards. A node is light if no more than `light` turns lie in its subtree
(counted over conversations, so at least its nodes). The subtree below a topmost light
node is one unit; heavy nodes of one owner in one band of `light` depths, a
chain, are one unit as well. Units are dealt to shards whole, so each
shard's pass is its own. Then the roots of units send their totals on: those
of light units are complete and are summed by a grouping, the tree of the heavy
units (as many as depth x turns / light at most, and few in practice) is one
more pass, across shard roots; and a last pass over the heavy nodes adds what has come in from
other units to their chains.

Defined results: a null role or text is empty; turns go by number (null first),
equal ones by content hash; repeated rows are turns of their own; rows without
conversation id belong to no conversation; a conversation without turns is a
member of the root alone; texts of any length count whole; an empty table
gives no rows (a trie without members has no root); further columns are
ignored, whatever their names. Building the result runs the jobs up to the
totals.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
import tempfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidepool.llm.store import Scratch

_PARTS = ["p1", "p2", "p3", "p4"]
KEY, PARENT = ["k1", "k2"], ["q1", "q2"]


class SpillingQueue:
    """Priority queue of tuples: `limit` of them in memory, sorted runs of the
    rest in unnamed files of the task that vanish with it."""

    def __init__(self, limit: int):
        self._limit, self._heap, self._runs = limit, [], []

    def put(self, item: tuple) -> None:
        heapq.heappush(self._heap, item)
        if len(self._heap) > self._limit:
            run = tempfile.TemporaryFile()
            for x in sorted(self._heap):
                pickle.dump(x, run)
            run.seek(0)
            self._heap = []
            self._advance(run)

    def _advance(self, run) -> None:
        try:
            heapq.heappush(self._runs, (pickle.load(run), id(run), run))
        except EOFError:
            run.close()

    def first(self) -> tuple | None:
        in_memory = self._heap[0] if self._heap else None
        spilled = self._runs[0][0] if self._runs else None
        return min((x for x in (in_memory, spilled) if x is not None), default=None)

    def take(self) -> tuple:
        if self._runs and (not self._heap or self._runs[0][0] < self._heap[0]):
            item, _, run = heapq.heappop(self._runs)
            self._advance(run)
            return item
        return heapq.heappop(self._heap)


def ordered_turns(scratch: Scratch, turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """((conv_id, pos, g1, g2, bytes), (conv_id, n)) from turns (conv_id, turn,
    role, text). Positions count on from one sorted range of the table to the
    next, so a conversation of any length is spread over several."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    thin = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"), "turn", F.xxhash64(role, text).alias("g1"),
        F.xxhash64(F.lit(1), role, text).alias("g2"), F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("row"))
    order = ["turn", "g1", "g2", "row"]
    ranged = scratch.write(thin.repartitionByRange("conv_id", *order).withColumn("range", F.spark_partition_id()), "turns")
    sizes = ranged.groupBy("conv_id", "range").agg(F.count("*").alias("n"))
    before = Window.partitionBy("conv_id").orderBy("range")
    offsets = scratch.write(sizes.select("conv_id", "range", (F.sum("n").over(before) - F.col("n")).alias("before"), "n"), "offsets")
    inner = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(F.col("turn").asc_nulls_first(), *order[1:]))
    placed = (ranged.withColumn("inner", inner).join(offsets.drop("n"), ["conv_id", "range"])
              .select("conv_id", (F.col("before") + F.col("inner")).alias("pos"), "g1", "g2", "bytes"))
    out = scratch.write(placed, "placed")
    lengths = scratch.write(offsets.groupBy("conv_id").agg(F.sum("n").alias("n")), "lengths")
    scratch.drop(ranged, offsets)
    return out, lengths


def regrouped(scratch: Scratch, turns: DataFrame, lengths: DataFrame, family: int, most: int) -> tuple[DataFrame, DataFrame]:
    """Every conversation c anew: the first h turns of conversation c - c % family
    (a remainder of 0 or more), then its own after its first h; h = crc32(c) % most.
    ((conv_id, pos, g1, g2, bytes, n), (conv_id, n)) as in `ordered_turns`."""
    base = F.col("conv_id") - F.pmod("conv_id", F.lit(family))
    heads = F.crc32(F.col("conv_id").cast("string")) % most
    plan = lengths.select("conv_id", F.col("n").alias("own"), heads.alias("h"), base.alias("base"))
    known = lengths.where(F.col("conv_id") == base).select(F.col("conv_id").alias("base"), F.col("n").alias("there"))
    plan = scratch.write(plan.join(known, "base", "left").select(
        "conv_id", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken"), "own")
        .withColumn("n", F.col("taken") + F.greatest(F.lit(0), F.col("own") - F.col("h"))), "plan")
    lent = (turns.where((F.col("pos") < most) & (F.col("conv_id") == base))
            .withColumn("conv_id", F.explode(F.sequence("conv_id", F.col("conv_id") + family - 1)))
            .where(F.col("pos") <= heads).join(plan.select("conv_id", "n"), "conv_id"))
    own = (turns.where(F.col("pos") > heads).join(plan.select("conv_id", "n", "h", "taken"), "conv_id")
           .withColumn("pos", F.col("pos") - F.col("h") + F.col("taken")))
    columns = ["conv_id", "pos", "g1", "g2", "bytes", "n"]
    return scratch.write(lent.select(columns).unionByName(own.select(columns)), "rebuilt"), plan.select("conv_id", "n")


def prefixes(scratch: Scratch, turns: DataFrame, block: int) -> DataFrame:
    """turns with the keys of the prefix that ends there (k1, k2) and of the one before (q1, q2)."""
    h1, h2 = F.xxhash64("pos", "g1", "g2"), F.xxhash64(F.lit(1), "pos", "g1", "g2")
    low = F.lit(0xFFFFFFFF)
    own = dict(zip(_PARTS, (F.shiftrightunsigned(h1, 32), h1.bitwiseAND(low), F.shiftrightunsigned(h2, 32), h2.bitwiseAND(low))))
    parts = turns.select("conv_id", "pos", "bytes", "n", F.expr(f"(pos - 1) div {block}").alias("block"), *[c.alias(p) for p, c in own.items()])
    totals = parts.where(F.col("n") > block).groupBy("conv_id", "block").agg(*[F.sum(p).alias(p) for p in _PARTS])
    earlier = Window.partitionBy("conv_id").orderBy("block")
    offsets = totals.select("conv_id", "block", *[(F.sum(p).over(earlier) - F.col(p)).alias(f"{p}_before") for p in _PARTS])
    within = Window.partitionBy("conv_id", "block").orderBy("pos")
    sums = parts.select("conv_id", "pos", "bytes", "n", "block", *_PARTS, *[F.sum(p).over(within).alias(f"{p}_to") for p in _PARTS])
    to = [F.col(f"{p}_to") + F.coalesce(F.col(f"{p}_before"), F.lit(0)) for p in _PARTS]
    before = [t - F.col(p) for t, p in zip(to, _PARTS)]
    depth, up = F.col("pos"), F.col("pos") - 1
    return scratch.write(sums.join(offsets, ["conv_id", "block"], "left").select(
        "conv_id", F.col("pos").alias("depth"), "n", "bytes", F.xxhash64(depth, *to).alias("k1"), F.xxhash64(F.lit(1), depth, *to).alias("k2"),
        _unless_root(up, F.xxhash64(up, *before)).alias("q1"), _unless_root(up, F.xxhash64(F.lit(1), up, *before)).alias("q2")), "prefixes")


def _unless_root(depth: Column, key: Column) -> Column:
    """The root has key (0, 0)."""
    return F.when(depth > 0, key).otherwise(F.lit(0).cast("bigint"))


_NODE = "shard int, depth bigint, k1 bigint, k2 bigint, up bigint, q1 bigint, q2 bigint, inside boolean, leaves bigint, saved bigint"


def time_forward(nodes: DataFrame, queue: int, shards: int | None) -> DataFrame:
    """nodes with leaves and saved summed over what lies below them in their
    own unit. `inside`: the parent, of depth `up`, is in the same unit and so
    in the shard.

    The rows of a task are sorted from the deepest level up; that order is the
    queue's as well."""
    names = [c.split()[0] for c in _NODE.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pending = SpillingQueue(queue)
        for b in batches:
            columns = {c: b.column(c).to_pylist() for c in names}
            leaves, saved = columns["leaves"], columns["saved"]
            for i, (depth, k1, k2, up, q1, q2, inside) in enumerate(zip(*[columns[c] for c in names[1:8]])):
                address = (-depth, k1, k2)
                while (message := pending.first()) is not None and message[:3] == address:
                    _, _, _, more_leaves, more_saved = pending.take()
                    leaves[i] += more_leaves
                    saved[i] += more_saved
                if inside:
                    pending.put((-up, q1, q2, leaves[i], saved[i]))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:-2]], pa.array(leaves, pa.int64()), pa.array(saved, pa.int64())], names=names)

    dealt = nodes.select(*names)
    dealt = dealt.coalesce(1) if shards == 1 else dealt.repartition("shard")
    return dealt.sortWithinPartitions(F.desc("depth"), "k1", "k2").mapInArrow(run, _NODE)


def subtree_totals(scratch: Scratch, nodes: DataFrame, rows: DataFrame, light: int, queue: int) -> DataFrame:
    """(k1, k2, leaves, saved) over each node's subtree, from nodes (conv_id =
    owner, depth, k1, k2, q1, q2, parent_conv_id, leaves, saved, turns =
    turns of conversations in the subtree) and rows (conv_id, depth, k1, k2)."""
    heavy = scratch.write(nodes.where((F.col("turns") > light) | (F.col("depth") == 0)).select("k1", "k2"), "heavy")
    deepest = rows.join(heavy, KEY, "left_semi").groupBy("conv_id").agg(F.max("depth").alias("d"))
    tops = rows.join(deepest, "conv_id", "left").where(F.col("depth") == F.coalesce("d", F.lit(0)) + 1).select(
        "conv_id", F.col("depth").alias("top"), F.col("k1").alias("u1"), F.col("k2").alias("u2"))
    band = F.expr(f"depth div {light}")
    chain = [F.xxhash64(F.lit(s), "conv_id", band) for s in (2, 3)]
    above = [F.xxhash64(F.lit(s), "parent_conv_id", F.expr(f"(depth - 1) div {light}")) for s in (2, 3)]
    is_light = F.coalesce(F.col("depth") >= F.col("top"), F.lit(False))
    united = nodes.join(tops, "conv_id", "left").select(
        "depth", *KEY, (F.col("depth") - 1).alias("up"), *PARENT, "leaves", "saved", is_light.alias("is_light"),
        *[F.when(is_light, u).otherwise(c).alias(n) for n, u, c in zip(("u1", "u2"), (F.col("u1"), F.col("u2")), chain)],
        *[a.alias(n) for n, a in zip(("above1", "above2"), above)],
        F.when(is_light, F.col("depth") > F.col("top")).otherwise((F.col("depth") > 0) & (chain[0] == above[0]) & (chain[1] == above[1])).alias("inside"))
    united = scratch.write(united.withColumn("shard", F.pmod(F.hash("u1", "u2"), F.lit(1 << 20))), "united")
    scratch.drop(heavy)

    local = scratch.write(time_forward(united, queue, None), "local")
    sent = scratch.write(local.where("not inside and depth > 0").join(united.where("not inside").select(*KEY, "is_light", "u1", "u2", "above1", "above2"), KEY), "sent")
    sums = [F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved")]
    complete = scratch.write(sent.where("is_light").groupBy(*PARENT, "above1", "above2").agg(*sums), "complete")

    # The tree of heavy units; a unit stands at the depth of its root.
    units = united.where("not is_light and not inside").select("depth", *KEY, "u1", "u2", "above1", "above2")
    into = complete.groupBy("above1", "above2").agg(F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
    parents = units.select(F.col("u1").alias("above1"), F.col("u2").alias("above2"), F.col("depth").alias("up"))
    tree = scratch.write(
        units.join(local.select(*KEY, "leaves", "saved"), KEY).drop(*KEY).join(parents, ["above1", "above2"], "left")
        .join(into.toDF("u1", "u2", "more", "more_saved"), ["u1", "u2"], "left")
        .select(F.lit(0).alias("shard"), "depth", F.col("u1").alias("k1"), F.col("u2").alias("k2"), "up", F.col("above1").alias("q1"), F.col("above2").alias("q2"),
                (F.col("depth") > 0).alias("inside"), (F.col("leaves") + F.coalesce("more", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("more_saved", F.lit(0))).alias("saved")), "tree")
    across = scratch.write(time_forward(tree, queue, 1), "across")
    # What heavy units bring to the node that their root hangs from.
    hung = (across.select(F.col("k1").alias("u1"), F.col("k2").alias("u2"), "leaves", "saved")
            .join(sent.where("not is_light").select("u1", "u2", *PARENT), ["u1", "u2"]).select(*PARENT, "leaves", "saved"))
    arrived = complete.select(*PARENT, "leaves", "saved").unionByName(hung).groupBy(*PARENT).agg(
        F.sum("leaves").alias("more"), F.sum("saved").alias("more_saved"))
    again = (united.where("not is_light").join(arrived.withColumnsRenamed({"q1": "k1", "q2": "k2"}), KEY, "left")
             .withColumn("leaves", F.col("leaves") + F.coalesce("more", F.lit(0))).withColumn("saved", F.col("saved") + F.coalesce("more_saved", F.lit(0))))
    final = time_forward(again, queue, None)
    out = scratch.write(local.join(united.where("is_light").select(*KEY), KEY, "left_semi").unionByName(final).select(*KEY, "leaves", "saved"), "totals")
    scratch.drop(local, sent, complete, tree, across, united)
    return out


def trie(turns: DataFrame, regroup: tuple[int, int] | None = None, light: int = 20_000, block: int = 1024,
         queue: int = 100_000) -> tuple[DataFrame, DataFrame]:
    """(nodes, ends) of conversations (conv_id, turn, role, text).

    nodes: k1, k2, conv_id (owner), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens. ends: (k1, k2, conv_id), the node each conversation
    ends at. `regroup` = (family, most) takes the conversations as `regrouped`
    makes them.
    """
    scratch = Scratch(turns.sparkSession, "trie")
    placed, lengths = ordered_turns(scratch, turns)
    if regroup:
        source, (rebuilt, lengths) = placed, regrouped(scratch, placed, lengths, *regroup)
        scratch.drop(source)
    else:
        rebuilt = placed.join(lengths, "conv_id")
    rows = prefixes(scratch, rebuilt, block)
    zero = F.lit(0).cast("bigint")
    root = (lengths.agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.sum(F.col("n") + 1).alias("turns"))
            .where("n_convs > 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id", zero.alias("depth"), "n_convs", zero.alias("bytes"), "turns",
                                         F.lit(None).cast("bigint").alias("q1"), F.lit(None).cast("bigint").alias("q2")))
    found = rows.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.min("depth").alias("depth"), F.count("*").alias("n_convs"), F.min("bytes").alias("bytes"),
                                   F.sum(F.col("n") - F.col("depth") + 1).alias("turns"), F.min("q1").alias("q1"), F.min("q2").alias("q2"))
    plain = scratch.write(found.unionByName(root), "plain")
    children = plain.where("depth > 0").groupBy(*PARENT).agg(F.count("*").alias("n_children")).withColumnsRenamed({"q1": "k1", "q2": "k2"})
    owners = plain.select(F.col("k1").alias("q1"), F.col("k2").alias("q2"), F.col("conv_id").alias("parent_conv_id"))
    nodes = scratch.write(plain.join(children, KEY, "left").join(owners, PARENT, "left").withColumns({
        "n_children": F.coalesce("n_children", zero), "leaves": F.when(F.col("n_children").isNull(), 1).otherwise(0).cast("bigint"),
        "saved": (F.col("n_convs") - 1) * F.col("bytes")}), "nodes")
    scratch.drop(plain)
    totals = subtree_totals(scratch, nodes, rows.select("conv_id", "depth", *KEY), light, queue)
    out = nodes.drop("leaves", "saved").join(totals, KEY).select(
        *KEY, "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ends = rows.where("depth = n").select(*KEY, "conv_id").unionByName(lengths.where("n = 0").select(zero.alias("k1"), zero.alias("k2"), "conv_id"))
    return out, ends


def digests(ends: DataFrame, chunk: int = 4096) -> DataFrame:
    """(k1, k2, sha256) of each node's ids, ascending, in decimals with commas
    between. Sorted ranges join their ids to chunks, and a node's chunks
    stream through one hash: no node's ids are ever held together."""
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, first, ids, rows = None, None, [], []

        def close():
            if ids:
                rows.append((*at, first, ",".join(map(str, ids))))

        for b in batches:
            for k1, k2, c in zip(*[b.column(x).to_pylist() for x in (*KEY, "conv_id")]):
                if (k1, k2) != at or len(ids) >= chunk:
                    close()
                    at, first, ids = (k1, k2), c, []
                ids.append(c)
            yield pack(rows, schema)
            rows = []
        close()
        yield pack(rows, schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, sha, rows = None, None, []
        for b in batches:
            for k1, k2, text in zip(*[b.column(x).to_pylist() for x in (*KEY, "text")]):
                if (k1, k2) == at:
                    sha.update(b"," + text.encode())
                    continue
                if at:
                    rows.append((*at, sha.hexdigest()))
                at, sha = (k1, k2), hashlib.sha256(text.encode())
            yield pack(rows, last)
            rows = []
        if at:
            rows.append((*at, sha.hexdigest()))
        yield pack(rows, last)

    def pack(rows: list[tuple], names: pa.Schema) -> pa.RecordBatch:
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, names)], schema=names)

    schema = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("first", pa.int64()), ("text", pa.string())])
    last = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("sha256", pa.string())])
    order = [*KEY, "conv_id"]
    chunks = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(join, "k1 bigint, k2 bigint, first bigint, text string")
    return (chunks.repartition(*KEY).sortWithinPartitions(*KEY, "first").select(*KEY, "text").mapInArrow(digest, "k1 bigint, k2 bigint, sha256 string"))
