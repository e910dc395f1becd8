"""Relational building blocks shared by the jobs.

Each is a thin, declarative composition of DataFrame operators; the value
is in choosing the shape Catalyst plans well at scale:

* aggregations are written so partial (map-side) aggregation applies, which
  also defuses hot keys: a key holding a third of the rows leaves each map
  task as one partial row;
* membership filters use ``left_semi`` / ``left_anti`` joins against the
  de-duplicated key set, and a set difference of two key sets is a
  co-group (tag, union, one partially aggregated ``groupBy``) -- never a
  per-key collection of values;
* no broadcast is forced: a top-k's limit gives the planner its size, and
  everything else is left to AQE, which measures the materialised shuffle at
  run time, converts to a broadcast join only below its threshold, and
  otherwise splits skewed partitions of a sort-merge join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import expressions as X

def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """The k first rows under a total order (planned as
    TakeOrderedAndProject: a bounded heap per partition, then one merge of
    k x partitions rows)."""
    return df.orderBy(*order).limit(int(k))


def count_by(df: DataFrame, keys: Sequence[str] | str, name: str = "n") -> DataFrame:
    """A1: rows per key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def zero_filled_count(universe: DataFrame, universe_key: str,
                      hits: DataFrame, hit_key: str,
                      out_key: str, name: str) -> DataFrame:
    """Count of ``hits`` per key over every key seen in either input,
    with 0 for keys only in ``universe`` -- one union and one aggregation
    (a single shuffle), partial sums on the map side."""
    u = universe.select(F.col(universe_key).alias(out_key), F.lit(0).alias("_one"))
    h = hits.select(F.col(hit_key).alias(out_key), F.lit(1).alias("_one"))
    return (u.unionAll(h).where(F.col(out_key).isNotNull())
            .groupBy(out_key).agg(F.sum("_one").cast("bigint").alias(name)))


def count_and_distinct(df: DataFrame, key: str, col: str,
                       total: str = "total", distinct: str = "distinct") -> DataFrame:
    """A3: per key, row count and number of distinct ``col`` values, as one
    aggregation (Spark plans the distinct part on (key, col) first, so a hot
    key is spread over its distinct values)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(total),
                               F.count_distinct(F.col(col)).alias(distinct))


def distinct_minus(left: DataFrame, left_keys: Sequence[str],
                   right: DataFrame, right_keys: Sequence[str]) -> DataFrame:
    """Distinct ``left_keys`` tuples that have no match in
    ``right`` (equality; a NULL key never matches).

    Written as a co-group rather than a join: both key sets are tagged,
    unioned and grouped once, keeping the tuples seen on the left and never
    on the right. That is one shuffle with partial aggregation on both
    inputs, so copies of a tuple -- even one holding a third of all rows --
    collapse to one row per map task before anything moves, and no sort or
    join is needed. (A distinct followed by an anti join lets the optimizer
    push the join below the distinct, so the left side would be shuffled
    with all its copies.)
    """
    names = [f"_k{i}" for i in range(len(left_keys))]
    l = left.select(*[F.col(k).alias(n) for k, n in zip(left_keys, names)],
                    F.lit(True).alias("_l"), F.lit(False).alias("_r"))
    r_keys = [F.col(k).alias(n) for k, n in zip(right_keys, names)]
    r = right.select(*r_keys, F.lit(False).alias("_l"), F.lit(True).alias("_r"))
    r = r.where(X.all_present(names))
    tagged = l.unionByName(r).groupBy(*names).agg(F.bool_or("_l").alias("_l"),
                                                 F.bool_or("_r").alias("_r"))
    return (tagged.where(F.col("_l") & ~F.col("_r"))
            .select(*[F.col(n).alias(k) for n, k in zip(names, left_keys)]))


def _key_set(ids: DataFrame, ids_key: str) -> DataFrame:
    """Distinct non-null keys. Membership only needs existence, and the
    partial aggregation collapses a hot key to one row per map task before
    anything is shuffled, so a key holding a third of the rows cannot make
    one join task heavy; AQE may then broadcast the reduced set."""
    return ids.select(F.col(ids_key).alias("_k")).where(F.col("_k").isNotNull()).distinct()


def keep_matching(df: DataFrame, key: str, ids: DataFrame, ids_key: str) -> DataFrame:
    """Rows of ``df`` whose key appears in ``ids`` (semi join; a
    row is kept once however many matches it has)."""
    k = _key_set(ids, ids_key)
    return df.join(k, df[key] == F.col("_k"), "left_semi")


def drop_matching(df: DataFrame, key: str, ids: DataFrame, ids_key: str) -> DataFrame:
    """Rows of ``df`` whose key does not appear in ``ids``."""
    k = _key_set(ids, ids_key)
    return df.join(k, df[key] == F.col("_k"), "left_anti")
