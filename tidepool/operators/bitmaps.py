"""Exact distinct counts that can be merged: paged bitmaps.

A set of integers is a few rows (page, bits): page is the block of 32 768
numbers, bits has one bit for each number of the block, cut after its last
set byte. Sets of several days, files or regions merge by OR, so that a
distinct count over any union of them never reads the rows again. Groups are
formed on words of 8 bytes, whose fixed-size buffers are hashed and may spill;
only what they hold is packed into bitmaps.

Defined results: null values are counted by nobody, but their row keeps its
key (with no bit set); negative values count like others; an empty input
gives no rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PAGE, BITS, ROWS = "page", "bits", "n_rows"


WORD, VALUE = "_word", "_w"  # a bitmap on its way: rows of 8 bytes, as a long in the order of the bytes


def _words(bits):
    """[(word, value)] of the words of a bitmap that hold a bit."""
    word = lambda i: F.substring(bits, i * 8 + 1, F.lit(8))
    n = F.ceil(F.length(bits) / 8).cast("int")
    every = F.transform(F.slice(F.sequence(F.lit(0), n), F.lit(1), n), lambda i: F.struct(
        i.alias(WORD), F.conv(F.rpad(F.hex(word(i)), 16, "0"), 16, -10).cast("bigint").alias(VALUE)))
    return F.filter(every, lambda x: x[VALUE] != 0)


def _bits(words):
    """The bitmap of the words of one key and page, in any order, cut after its last set byte."""
    s = F.array_sort(words)
    gap = lambda x, i: x[WORD] - F.when(i > 0, F.get(s, i - 1)[WORD]).otherwise(-1) - 1
    word = lambda x: F.lpad(F.hex(x[VALUE]), 16, "0")
    digits = F.array_join(F.transform(s, lambda x, i: F.concat(
        F.repeat(F.lit("0"), 16 * gap(x, i)),
        F.when(i < F.size(s) - 1, word(x)).otherwise(F.regexp_replace(word(x), "(00)+$", "")))), "")
    return F.unhex(digits)


def _unpacked(sets: DataFrame, others: Sequence[str]) -> DataFrame:
    """(others, page, word, value, n_rows): a row for each word that holds a bit,
    or for a set without one; the first has the set's rows."""
    out = sets.select(*others, PAGE, ROWS, F.posexplode_outer(_words(F.col(BITS))).alias("_i", "_x"))
    return out.select(*others, PAGE, F.col(f"_x.{WORD}"), F.col(f"_x.{VALUE}"),
                      F.when(F.coalesce("_i", F.lit(0)) == 0, F.col(ROWS)).otherwise(F.lit(0)).alias(ROWS))


def _packed(words: DataFrame, keys: Sequence[str], *more) -> DataFrame:
    """(keys, page, bits, n_rows, more) from (keys, page, word, value, n_rows), one row a word."""
    entry = F.when(F.col(WORD).isNotNull(), F.struct(WORD, VALUE))
    packed = words.groupBy(*keys, PAGE).agg(F.collect_list(entry).alias(VALUE), F.sum(ROWS).alias(ROWS), *more)
    return packed.withColumn(BITS, _bits(F.col(VALUE))).select(*keys, PAGE, BITS, ROWS, *packed.columns[len(keys) + 3:])


def build(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, page, bits, n_rows): the distinct values and the rows of each key.

    Rows of a key are combined before the shuffle into one long for each 64
    numbers, so that a group takes the memory of the numbers it has; a hot key
    is as many rows as its values have blocks.
    """
    v = F.col(value).cast("bigint")
    at = F.bitmap_bit_position(v)
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), (56 - at % 64 + 2 * (at % 8)).cast("int"))
    words = df.groupBy(*keys, F.bitmap_bucket_number(v).alias(PAGE), (at / 64).cast("int").alias(WORD)).agg(
        F.bit_or(bit).alias(VALUE), F.count(F.lit(1)).alias(ROWS))
    return _packed(words, keys)


def merge(sets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The union of the sets of each (coarser) key, in the same form."""
    words = _unpacked(sets, keys).groupBy(*keys, PAGE, WORD).agg(F.bit_or(VALUE).alias(VALUE), F.sum(ROWS).alias(ROWS))
    return _packed(words, keys)


def counts(sets: DataFrame, keys: Sequence[str], total: str = "total", distinct: str = "distinct") -> DataFrame:
    """Rows and distinct values of each key, over sets merged to that key."""
    return sets.groupBy(*keys).agg(F.sum(ROWS).alias(total), F.sum(F.bitmap_count(BITS)).cast("bigint").alias(distinct))


def rolling(sets: DataFrame, keys: Sequence[str], day: str, days: int) -> DataFrame:
    """The sets of each key over the ``days`` days that end at each of its own days.

    The words of a day's bitmap are handed to the days they count for, and OR'ed
    there; only days on which the key has a row stay. One exchange serves both
    the words and the bitmaps: days of a key are seldom together before it.
    """
    ends = _unpacked(sets, [*keys, day]).withColumn("_end", F.explode(F.sequence(day, F.date_add(day, days - 1))))
    words = (ends.repartition(*keys, "_end", PAGE).groupBy(*keys, "_end", PAGE, WORD)
             .agg(F.bit_or(VALUE).alias(VALUE), F.sum(ROWS).alias(ROWS), F.max(F.col("_end") == F.col(day)).alias("_own")))
    return _packed(words, [*keys, "_end"], F.max("_own").alias("_own")).withColumnRenamed("_end", day)


def rolling_counts(sets: DataFrame, keys: Sequence[str], day: str, days: int, total: str = "total",
                   distinct: str = "distinct") -> DataFrame:
    """``counts`` over the ``days`` days that end at each day a key has rows on."""
    r = rolling(sets, keys, day, days)
    return (r.groupBy(*keys, day).agg(F.sum(ROWS).alias(total), F.sum(F.bitmap_count(BITS)).cast("bigint").alias(distinct),
                                      F.max("_own").alias("_own"))
            .where("_own").drop("_own"))
