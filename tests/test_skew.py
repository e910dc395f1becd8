"""One seating table holds a third of all attendees."""

from pyspark.sql import functions as F

from conftest import rows
from tidepool.plans import health as H


def test_hot_table(spark):
    n = 30_000
    att = spark.range(n).select(
        "id", F.concat(F.lit("P"), "id").alias("name"),
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(100 + F.col("id") % 5000).alias("table"),
        F.when(F.col("id") % 97 == 0, F.lit("sick")).otherwise(F.lit("not-sick")).alias("test"))
    sick_tables = {7} | {100 + i % 5000 for i in range(0, n, 97) if i % 3}
    want = sorted(i for i in range(n) if i % 97 and (7 if i % 3 == 0 else 100 + i % 5000) in sick_tables)
    assert [r[0] for r in rows(H.healthy_at_sick_table(att), "id")] == want
    reports = att.where("test = 'sick'").select("id", "test")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "16k")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "16k")
    try:
        assert [r[0] for r in rows(H.healthy_at_risk(att.drop("test"), reports), "id")] == want
    finally:
        for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes",
                  "spark.sql.adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(k)
