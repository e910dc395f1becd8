"""Views of the logical tables over the driver's parquet tables.

Each view is a lazy projection of the parquet scans, so Catalyst prunes the
columns a job does not use and pushes its filters into the scan.

  people      customer x nation: person_id=c_custkey, name=c_name,
              nationality=n_name, country_code=c_nationkey, hobby=c_mktsegment
  friends     lineitem x orders: friend_rel=l_orderkey,
              person_id=o_custkey - o_custkey % 2, my_friend=l_suppkey,
              date_of_friendship=date(o_orderdate), descr=o_orderpriority
              (even ids own all friendships, so odd ones have none, and id 0
              has no people row)
  access_log  events: access_id=event_id, by_who=user_id,
              what_page=props.k, type_of_access=event_type, access_time=ts;
              as text (access_log_text), or with every fifth page id negated
              (access_log_unowned: pages without a people row)
              as lines of text, some of them malformed (access_log_lines: short
              lines, user ids with letters, empty pages)
  attendees   events: id=event_id, name='P'||event_id, table=user_id,
              test='sick' if event_type='error' and value>200 else 'not-sick'
  reports     error events: id, test='sick' above 200, else 'recovered'
  points      lineitem: x=floor(l_quantity), y=floor(l_extendedprice/1000)
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.functions import expressions as X

# Fixed values of the adapter definitions.
SICK, NOT_SICK, RECOVERED = "sick", "not-sick", "recovered"
SICK_EVENT_TYPE = "error"
SICK_VALUE_ABOVE = 200.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def people(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    # nation is a small dimension; the planner broadcasts it from its file
    # size statistics (no hint needed, nothing forced if it were large).
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .select(F.col("c_custkey").cast("bigint").alias("person_id"),
                    F.col("c_name").alias("name"),
                    F.col("n_name").alias("nationality"),
                    F.col("c_nationkey").cast("int").alias("country_code"),
                    F.col("c_mktsegment").alias("hobby")))


def friends(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey")
    o = (table(spark, sf_dir, "orders")
         .select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority"))
    return (li.join(o, li.l_orderkey == o.o_orderkey, "inner")
            .select(F.col("l_orderkey").cast("bigint").alias("friend_rel"),
                    (F.col("o_custkey") - F.col("o_custkey") % 2).cast("bigint").alias("person_id"),
                    F.col("l_suppkey").cast("bigint").alias("my_friend"),
                    F.to_date("o_orderdate").alias("date_of_friendship"),
                    F.col("o_orderpriority").alias("descr")))


def access_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        F.col("event_id").cast("bigint").alias("access_id"),
        F.col("user_id").cast("bigint").alias("by_who"),
        X.json_int_field("props", "k").alias("what_page"),
        F.col("event_type").alias("type_of_access"),
        F.col("ts").alias("access_time"))


def access_log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(F.get_json_object("props", "$.k").alias("what_page"))


def access_log_unowned(spark: SparkSession, sf_dir: str) -> DataFrame:
    page = F.col("what_page")
    return access_log(spark, sf_dir).withColumn(
        "what_page", F.when(page % 5 == 0, -page - 1).otherwise(page))


def lines_of(log: DataFrame) -> DataFrame:
    """An access log as comma-separated lines (``value``): one in 13 is cut
    after the user, one user id in 11 has letters, one page in 7 is empty."""
    def text(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(""))

    who = F.when(F.col("by_who") % 11 == 3, F.concat(F.lit("user"), text("by_who"))).otherwise(text("by_who"))
    page = F.when(F.col("what_page") % 7 == 5, F.lit("")).otherwise(text("what_page"))
    short = F.concat_ws(",", text("access_id"), who)
    return log.select(F.when(F.col("access_id") % 13 == 7, short).otherwise(
        F.concat_ws(",", short, page, text("type_of_access"))).alias("value"))


def access_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_of(access_log(spark, sf_dir))


def attendees(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    sick = (F.col("event_type") == SICK_EVENT_TYPE) & (F.col("value") > SICK_VALUE_ABOVE)
    return ev.select(
        F.col("event_id").cast("bigint").alias("id"),
        F.concat(F.lit("P"), F.col("event_id").cast("string")).alias("name"),
        F.col("user_id").cast("bigint").alias("table"),
        F.when(sick, F.lit(SICK)).otherwise(F.lit(NOT_SICK)).alias("test"))


def attendees_no_disclosure(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attendees(spark, sf_dir).drop("test")


def reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").where(F.col("event_type") == SICK_EVENT_TYPE)
    return ev.select(F.col("event_id").cast("bigint").alias("id"),
                     F.when(F.col("value") > SICK_VALUE_ABOVE, F.lit(SICK))
                     .otherwise(F.lit(RECOVERED)).alias("test"))


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.select(F.floor("l_quantity").cast("bigint").alias("x"),
                     F.floor(F.col("l_extendedprice") / 1000).cast("bigint").alias("y"))


# Fixed seed set for the driver's points (x spans 1..50, y 0..104); the last
# seed attracts no point and exercises the empty-cluster rule.
DRIVER_SEEDS = [(10.0, 20.0), (40.0, 20.0), (10.0, 80.0), (40.0, 80.0), (500.0, 500.0)]


def seeds(spark: SparkSession, coords=None) -> DataFrame:
    coords = list(DRIVER_SEEDS if coords is None else coords)
    return spark.createDataFrame(
        [(i, float(x), float(y)) for i, (x, y) in enumerate(coords)],
        "id INT, x DOUBLE, y DOUBLE")
