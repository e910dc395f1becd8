"""Connected components of a link table, by alternating stars.

Each round replaces every link by one that is nearer to its component's
smallest vertex (large star: neighbours above a vertex point at its smallest
neighbour; small star: the same for those below). A round is two groupings
with map-side minima and two joins; it is written to the shared folder, so a
lost executor never repeats earlier rounds. No vertex's neighbours are ever
gathered: a hub is many rows of a join side, which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidepool.llm.store import Scratch


def components(scratch: Scratch, links: DataFrame) -> DataFrame:
    """(v, root) for every vertex of links (a, b) that is not the smallest of
    its component. Null ends and loops are ignored; repeats are harmless; no
    links give no rows."""
    def state(t: DataFrame):
        return t.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    now = scratch.write(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                        .distinct(), "links")
    before = state(now)
    while before[0]:
        both = scratch.write(now.union(now.select("b", "a")).toDF("u", "v"), "both")
        least = scratch.write(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        up = scratch.write(both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("a"), F.col("m").alias("b"))
                           .distinct(), "large-star")
        least2 = scratch.write(up.groupBy("a").agg(F.min("b").alias("m")), "least")
        down = (up.join(least2, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
                .union(least2.select("a", F.col("m").alias("b"))).distinct())
        done, now = now, scratch.write(down, "small-star")
        scratch.drop(done, both, least, up, least2)
        after = state(now)
        if after == before:
            break
        before = after
    return now.select(F.col("a").alias("v"), F.col("b").alias("root"))
