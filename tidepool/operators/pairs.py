"""Distinct key pairs as bucketed tables, and set differences between them.

A pair table holds each distinct pair once, bucketed by both of its columns:
copies of a pair collapse map-side before the table's one shuffle, and a hub
(a person in a third of all pairs) is spread over all buckets. Tables of as
many buckets are co-partitioned, so that a join of them moves no row.

Defined results: a pair with a null in it is left out; an empty input gives
an empty table; further columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.functions import expressions as X
from tidepool.session import ensure_checkpoint_dir

LEFT, RIGHT = "left_id", "right_id"


def write_pairs(df: DataFrame, keys: Sequence[str], name: str | None = None, path: str | None = None,
                buckets: int | None = None) -> DataFrame:
    """Write the distinct pairs of ``keys`` as table ``name`` (left_id,
    right_id) and return the table.

    ``buckets`` defaults to ``spark.sql.shuffle.partitions``: then each bucket
    is one partition of the distinct's own shuffle, hence one file. Without a
    name the table is one of this session, in a folder of its own under
    ``spark.checkpoint.dir``.
    """
    spark = df.sparkSession
    left, right = keys
    pairs = (df.select(F.col(left).alias(LEFT), F.col(right).alias(RIGHT))
             .where(X.all_present([LEFT, RIGHT])).distinct())
    own = f"pairs_{uuid.uuid4().hex}"
    if name is None:
        name, path = own, path or f"{ensure_checkpoint_dir(spark).rstrip('/')}/{own}"
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    writer = pairs.write.format("parquet").mode("overwrite").bucketBy(n, LEFT, RIGHT).sortBy(LEFT, RIGHT)
    (writer.option("path", path) if path else writer).saveAsTable(name)
    return spark.table(name)


def minus(pairs: DataFrame, others: DataFrame) -> DataFrame:
    """The pairs of one pair table that are not in another one.

    The merge join reads bucket against bucket: no row of either table is
    shuffled, whatever their sizes.
    """
    o = others.select(F.col(LEFT).alias("_l"), F.col(RIGHT).alias("_r"))
    return pairs.join(o.hint("merge"), (F.col(LEFT) == F.col("_l")) & (F.col(RIGHT) == F.col("_r")), "left_anti")
