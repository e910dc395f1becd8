"""Removal of lines that many documents share, by levelled sorted runs.

The store of line hashes is a log-structured merge tree in Parquet. A run
holds (h1, h2, n), sorted by hash: the line's 128-bit hash and in how many
documents of the run's batches it was seen. A new batch is counted, anti-joins
the settled part of the runs (hashes already seen in `min_docs` documents, for
which counting is over) and adds what is left as a run of level 0. When a
level holds `fan_in` runs they are merged into one run of the next level, so
each hash is rewritten once per level. After the last batch the remaining
runs are merged; the settled hashes are the lines to drop.

Counting groups are hashes and are combined before the shuffle; a document
that is in no join with a settled line is passed through. The text is read
twice: once to hash its lines and once to cut them.

A line's key is the line without ASCII white space at its ends and with A-Z
lower-cased. Keys shorter than `min_chars` code points are always kept.

Defined results: a null or empty text is one empty line (a null text stays
null); texts of any length are whole, and cut in time linear in their lines;
repeated rows count as documents of their own, as ids need not be
unique or set; an empty table gives no rows; further columns are passed
through, except that n_lines and n_dropped are replaced if present.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.store import Scratch

SPACE = " \t\n\x0b\x0c\r"


def _keys(lines: Column) -> Column:
    return F.transform(lines, lambda x: F.btrim(x, F.lit(SPACE)))


def _lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _entries(keys: Column, once: Column) -> Column:
    """(line, pos, counts): every line with its position, of which each distinct
    one counts once. A text without repeated lines needs no further entries for that."""
    yes, no, nowhere = F.lit(True), F.lit(False), F.lit(None).cast("int")
    entry = lambda line, pos, counts: F.struct(line.alias("line"), pos.alias("pos"), counts.alias("counts"))
    return F.when(F.size(once) == F.size(keys), F.transform(keys, lambda x, i: entry(x, i, yes))).otherwise(
        F.concat(F.transform(once, lambda x: entry(x, nowhere, yes)), F.transform(keys, lambda x, i: entry(x, i, no))))


def _without(lines: Column, dropped: Column) -> Column:
    """lines without those at the positions `dropped`, by a set of integers and
    look-ups by position: linear in the lines (a slice would copy all of them)."""
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped)
    return F.transform(kept, lambda i: F.get(lines, i))


class LineRuns:
    """Levelled runs of line hashes in the scratch folder."""

    def __init__(self, scratch: Scratch, min_docs: int, fan_in: int = 2):
        self.scratch, self.min_docs, self.fan_in = scratch, min_docs, fan_in
        self.levels: list[list[DataFrame]] = []

    def _run(self, counts: DataFrame) -> DataFrame:
        """A sorted run; its settled part is a partition of its own."""
        return self.scratch.write(
            counts.withColumn("settled", F.col("n") >= self.min_docs)
            .repartition("h1").sortWithinPartitions("settled", "h1", "h2"), "run", ["settled"])

    def _merged(self, runs: list[DataFrame]) -> DataFrame:
        rows = runs[0]
        for r in runs[1:]:
            rows = rows.union(r)
        return rows.groupBy("h1", "h2").agg(F.sum("n").alias("n"))

    def settled(self) -> DataFrame | None:
        parts = [r.where("settled").select("h1", "h2") for level in self.levels for r in level]
        if not parts:
            return None
        out = parts[0]
        for p in parts[1:]:
            out = out.union(p)
        return out

    def add(self, batch: DataFrame) -> None:
        """batch: (h1, h2), one row per document and line key."""
        known = self.settled()
        fresh = batch.groupBy("h1", "h2").agg(F.count("*").alias("n"))
        if known is not None:
            fresh = fresh.join(known, ["h1", "h2"], "left_anti")
        self._push(0, self._run(fresh))

    def _push(self, level: int, run: DataFrame) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fan_in:
            old, self.levels[level] = self.levels[level], []
            new = self._run(self._merged(old))
            self.scratch.drop(*old)
            self._push(level + 1, new)

    def compact(self) -> DataFrame:
        """Merge every run into one and return its settled hashes."""
        runs = [r for level in self.levels for r in level]
        if len(runs) > 1:
            one = self._run(self._merged(runs))
            self.scratch.drop(*runs)
            self.levels = [[one]]
        return self.settled()


def dedup_lines(docs: DataFrame, min_docs: int = 10, min_chars: int = 1, batches: int = 4, fan_in: int = 2,
                id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs without the lines whose key is in at least `min_docs`
    of them, with n_lines (before) and n_dropped."""
    scratch = Scratch(docs.sparkSession, "lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    by_text = {"d1": F.xxhash64(text), "d2": F.xxhash64(F.lit(1), text)}
    # The text is hashed below the explode: beside it, it would be hashed for every line.
    keyed = docs.select(F.pmod(F.xxhash64(F.col(id_col)), F.lit(batches)).alias("batch"), *[c.alias(k) for k, c in by_text.items()],
                        _keys(_lines(_lower(text))).alias("keys"))
    entries = (keyed.select("batch", *by_text, "keys", F.array_distinct("keys").alias("once"))
               .select("batch", *by_text, _entries(F.col("keys"), F.col("once")).alias("entries")))
    hashed = (entries.select("batch", *by_text, F.explode("entries").alias("e")).where(F.length("e.line") >= max(1, min_chars))
              .select("batch", *by_text, "e.pos", "e.counts", F.xxhash64("e.line").alias("h1"), F.xxhash64(F.lit(1), "e.line").alias("h2")))
    lines = scratch.write(hashed, "lines", ["batch"])

    runs = LineRuns(scratch, min_docs, fan_in)
    for b in range(batches):
        runs.add(lines.where((F.col("batch") == b) & F.col("counts")).select("h1", "h2"))
    drop = runs.compact()

    hits = scratch.write(lines.where("pos IS NOT NULL").join(drop, ["h1", "h2"], "left_semi")
                         .groupBy("d1", "d2").agg(F.sort_array(F.collect_set("pos")).alias("hits")), "hits")
    scratch.drop(lines)

    # The exchange carries each text once, in its row.
    row = docs.select(F.struct("*").alias("row"), *[c.alias(k) for k, c in by_text.items()])
    own = F.coalesce(F.col(f"row.`{text_col}`"), F.lit(""))
    joined = row.join(hits, ["d1", "d2"], "left").select("row", "hits", _lines(own).alias("lines"))
    cut = joined.select("row", F.size("lines").cast("bigint").alias("n_lines"),
                        F.when(F.col("hits").isNotNull(), _without(F.col("lines"), F.col("hits"))).alias("kept"))
    out = cut.select("row.*", F.struct(
        F.when(F.col("kept").isNull(), F.col(f"row.`{text_col}`")).otherwise(F.array_join("kept", "\n")).alias("text"),
        "n_lines", F.coalesce(F.col("n_lines") - F.size("kept"), F.lit(0)).cast("bigint").alias("n_dropped")).alias("__cut"))
    return out.withColumns({text_col: F.col("__cut.text"), "n_lines": F.col("__cut.n_lines"),
                            "n_dropped": F.col("__cut.n_dropped")}).drop("__cut")
