"""Synthetic tables for scale runs.

Generated on executors from ``spark.range(n)``: each row is a pure function
of its id through an integer hash (multiply-add and squaring modulo the
prime 2^31-1, all in 64-bit arithmetic without overflow), so the output is
deterministic, independent of partitioning, and reproducible in any SQL
engine. Nothing is built on the driver, whatever n is.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PRIME = 2147483647  # 2^31 - 1

# Relationship descriptions (10) and access types (5) of the
# original generator.
RELATIONSHIP_TYPES = ["Friend", "Father", "Mother", "Son", "Daughter",
                      "Uncle", "Aunt", "Cousin", "Brother", "Sister"]
ACCESS_TYPES = ["Viewed Profile", "Shared Post", "Left a Comment", "Liked Post",
                "Followed Profile"]
# Own small vocabularies for hobbies (the original read them from files
# that are not published).
HOBBIES = ["Reading", "Chess", "Hiking", "Cooking", "Painting", "Cycling",
           "Gardening", "Photography", "Music", "Swimming"]

FRIENDSHIP_START = _dt.date(2004, 2, 4)
DEFAULT_END = _dt.date(2024, 12, 31)


def mix(i: Column, salt: int) -> Column:
    """Deterministic pseudo-random value in [0, 2^31-1) from a row id."""
    x0 = (F.pmod(i, F.lit(PRIME)) * F.lit(48271) + F.lit(salt * 7919 + 12345)) % PRIME
    x1 = (x0 * x0 + F.lit(salt + 101)) % PRIME
    return (x1 * x1 + F.lit(salt + 7)) % PRIME


def mix_sql(i: str, salt: int) -> str:
    """The same hash as SQL text (for checking in another engine)."""
    x0 = f"((({i}) % {PRIME}) * 48271 + {salt * 7919 + 12345}) % {PRIME}"
    x1 = f"(({x0}) * ({x0}) + {salt + 101}) % {PRIME}"
    return f"(({x1}) * ({x1}) + {salt + 7}) % {PRIME}"


def _pick(values: list[str], h: Column) -> Column:
    arr = F.array(*[F.lit(v) for v in values])
    return F.get(arr, (h % len(values)).cast("int"))


def _word(h: Column, min_len: int, spread: int) -> Column:
    """A letter string of length min_len..min_len+spread-1 derived from h."""
    digits = F.lpad(h.cast("string"), 10, "0")
    word = F.translate(F.concat(digits, F.reverse(digits)), "0123456789", "aeioulnrst")
    return F.initcap(F.substring(word, 1, (F.lit(min_len) + h % spread).cast("int")))


def gen_people(spark: SparkSession, n: int = 200_000) -> DataFrame:
    """G1: person_id 0..n-1, name, nationality + code 1..50, hobby."""
    i = F.col("id")
    code = (mix(i, 3) % 50 + 1).cast("int")
    return spark.range(n).select(
        i.alias("person_id"),
        F.concat(_word(mix(i, 1), 4, 5), F.lit(" "), _word(mix(i, 2), 5, 6)).alias("name"),
        F.concat(F.lit("Country_"), code.cast("string")).alias("nationality"),
        code.alias("country_code"),
        _pick(HOBBIES, mix(i, 4)).alias("hobby"))


def gen_friends(spark: SparkSession, n_people: int, n: int = 20_000_000,
                end: _dt.date = DEFAULT_END, dangling: bool = False) -> DataFrame:
    """Directed friendships with distinct endpoints. Ids are drawn from
    0..n_people-1, or 0..n_people with ``dangling=True`` (the original's extra
    id that has no people row)."""
    i = F.col("id")
    ids = n_people + (1 if dangling else 0)
    if ids < 2:
        raise ValueError("need at least two ids")
    person = mix(i, 11) % ids
    friend = (person + 1 + mix(i, 12) % (ids - 1)) % ids
    span = (end - FRIENDSHIP_START).days + 1
    return spark.range(n).select(
        i.alias("friend_rel"), person.alias("person_id"), friend.alias("my_friend"),
        F.date_add(F.lit(FRIENDSHIP_START), (mix(i, 13) % span).cast("int")).alias("date_of_friendship"),
        _pick(RELATIONSHIP_TYPES, mix(i, 14)).alias("descr"))


def gen_access_log(spark: SparkSession, n_people: int, n: int = 10_000_000,
                   end: _dt.date = DEFAULT_END) -> DataFrame:
    """Accesses with by_who != what_page, 5 access types, a timestamp in
    [2004-02-04, end)."""
    i = F.col("id")
    by = mix(i, 21) % n_people
    page = (by + 1 + mix(i, 22) % (n_people - 1)) % n_people
    start = _dt.datetime.combine(FRIENDSHIP_START, _dt.time())
    span = int((_dt.datetime.combine(end, _dt.time()) - start).total_seconds())
    ts = F.lit(start).cast("timestamp_ntz") + F.make_interval(
        F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), F.lit(0), (mix(i, 23) % span).cast("int"))
    return spark.range(n).select(
        i.alias("access_id"), by.alias("by_who"), page.alias("what_page"),
        _pick(ACCESS_TYPES, mix(i, 24)).alias("type_of_access"),
        ts.alias("access_time"))


def gen_points(spark: SparkSession, n: int = 40_000, low: int = 0, high: int = 5000) -> DataFrame:
    """Integer points, both coordinates uniform in [low, high]."""
    i = F.col("id")
    width = high - low + 1
    return spark.range(n).select((F.lit(low) + mix(i, 31) % width).alias("x"),
                                 (F.lit(low) + mix(i, 32) % width).alias("y"))


def gen_seeds(spark: SparkSession, k: int = 3, low: int = 0, high: int = 7000,
              salt: int = 0) -> DataFrame:
    """K integer seeds in [low, high] with ids 0..k-1."""
    i = F.col("id")
    width = high - low + 1
    return spark.range(k).select(i.cast("int").alias("id"),
                                 (F.lit(low) + mix(i, 41 + salt) % width).cast("double").alias("x"),
                                 (F.lit(low) + mix(i, 42 + salt) % width).cast("double").alias("y"))


def gen_attendees(spark: SparkSession, n: int = 1_500_000, tables: int = 500,
                  p_sick: float = 0.001) -> DataFrame:
    """Id 1..n, a two-word letter name, table 1..tables, test 'sick' with
    probability p_sick (resolution 1e-6) else 'not-sick'."""
    i = F.col("id")
    threshold = int(round(p_sick * 1_000_000))
    return spark.range(1, n + 1).select(
        i.alias("id"),
        F.concat(_word(mix(i, 51), 5, 4), F.lit(" "), _word(mix(i, 52), 6, 5)).alias("name"),
        (mix(i, 53) % tables + 1).alias("table"),
        F.when(mix(i, 54) % 1_000_000 < threshold, F.lit("sick"))
        .otherwise(F.lit("not-sick")).alias("test"))


def event_tables(attendees: DataFrame) -> dict[str, DataFrame]:
    """The three derived tables: full, without the test column, reports."""
    return {
        "mega_event": attendees,
        "mega_event_no_disclosure": attendees.drop("test"),
        "reported_illnesses": attendees.where(F.col("test") == "sick").select("id", "test"),
    }


def write_event_tables(attendees: DataFrame, out_dir: str, mode: str = "overwrite") -> None:
    """K7: write the three derived tables from one persisted dataset."""
    from tidepool.sources.sinks import write_multi
    outs = {f"{out_dir.rstrip('/')}/{name}": df for name, df in event_tables(attendees).items()}
    write_multi(attendees, outs, mode=mode, header=True)
