"""Social-activity jobs over people / friends / access_log.

Inputs follow ``tidepool.sources.schemas``: people(person_id, name,
nationality, country_code, hobby), friends(friend_rel, person_id, my_friend,
date_of_friendship, descr), access_log(access_id, by_who, what_page,
type_of_access, access_time). Friendships are directed: person_id -> my_friend.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.functions import expressions as X
from tidepool.operators import adjacency, bitmaps, pairs
from tidepool.operators import relational as R
from tidepool.sources import readers as Rd

# Fixed output texts.
UNKNOWN = "Unknown"
NEVER_ACCESSED = "NEVER ACCESSED FRIEND "
USER_PREFIX = "USER_"
AVERAGE_LABEL = "Average Friendships"


# --- D1 ----------------------------------------------------------------------
def people_by_nationality(people: DataFrame, nationality: str) -> DataFrame:
    """Name and hobby of every person of one nationality (map-only)."""
    return people.where(F.col("nationality") == F.lit(nationality)).select("name", "hobby")


# --- D2 / D3 / D4 --------------------------------------------------------------
def page_access_counts(access_log: DataFrame) -> DataFrame:
    return R.count_by(access_log.where(F.col("what_page").isNotNull()),
                      "what_page", "access_count").withColumnRenamed("what_page", "page_id")


def top_pages(access_log: DataFrame, k: int = 10) -> DataFrame:
    """The k most accessed pages; ties at the cut go to the lowest page id."""
    return R.top_k(page_access_counts(access_log), k,
                   [F.col("access_count").desc(), F.col("page_id").asc()])


def top_pages_details(access_log: DataFrame, people: DataFrame, k: int = 10) -> DataFrame:
    """Top pages joined (inner) with their owner's name and nationality.

    The top-k side has at most k rows, which the planner knows from the limit,
    so it is the broadcast build side and people is streamed through once.
    """
    top = top_pages(access_log, k)
    return (people.join(top, people.person_id == top.page_id, "inner")
            .select("page_id", "name", "nationality"))


def top_pages_details_outer(access_log: DataFrame, people: DataFrame, k: int = 10) -> DataFrame:
    """Every top page, once, with owner details; 'Unknown' when the page
    has no people row.

    people is first reduced by a semi join against the k top ids and grouped
    to one row per id (so at most k rows), which then meets the k top rows.
    """
    top = top_pages(access_log, k)
    matched = R.keep_matching(people, "person_id", top, "page_id")
    # One line per page even if an id occurs twice in people: keep the
    # smallest (name, nationality) pair, deterministically.
    owners = matched.groupBy("person_id").agg(
        F.min(F.struct("name", "nationality")).alias("_o"))
    joined = top.join(owners, top.page_id == owners.person_id, "left")
    return joined.select("page_id",
                         X.default(F.col("_o.name"), UNKNOWN).alias("name"),
                         X.default(F.col("_o.nationality"), UNKNOWN).alias("nationality"))


def top_pages_text(access_log: DataFrame, k: int = 10) -> DataFrame:
    """``top_pages`` over pages as text (column ``what_page``): only non-empty
    printable-ASCII pages count; ties go to the first in text order."""
    valid = access_log.where(X.non_empty("what_page") & X.printable_ascii("what_page"))
    return R.top_k(R.count_by(valid, "what_page", "access_count"), k,
                   [F.col("access_count").desc(), F.col("what_page").asc()])


# --- D5 / D6 -------------------------------------------------------------------
def people_per_country_code(people: DataFrame, low: int = 1, high: int = 50) -> DataFrame:
    """Citizens per country code, codes restricted to [low, high]."""
    valid = people.where(F.col("country_code").between(low, high))
    return R.count_by(valid, "country_code", "n")


def people_per_nationality(people: DataFrame) -> DataFrame:
    """Citizens per nationality."""
    return R.count_by(people, "nationality", "n")


# --- D7 / D8 -------------------------------------------------------------------
def connectedness(people: DataFrame, friends: DataFrame) -> DataFrame:
    """In-degree of every id found in people or as a friend target, 0-filled."""
    return R.zero_filled_count(people, "person_id", friends, "my_friend", "person_id", "factor")


def connectedness_named(people: DataFrame, friends: DataFrame) -> DataFrame:
    """In-degree of every people row (by name), 0 when nobody lists them."""
    indeg = R.count_by(friends.where(F.col("my_friend").isNotNull()), "my_friend", "_n")
    joined = people.join(indeg, people.person_id == indeg.my_friend, "left")
    return joined.select("name", X.default("_n", 0).cast("bigint").alias("factor"))


# --- D9 / D10 ------------------------------------------------------------------
def access_profile(access_log: DataFrame) -> DataFrame:
    """Per user: number of accesses and number of distinct pages accessed."""
    return R.count_and_distinct(access_log.where(F.col("by_who").isNotNull()),
                                "by_who", "what_page", "total", "distinct_pages")


def access_profile_named(access_log: DataFrame, people: DataFrame) -> DataFrame:
    """``access_profile`` with the user's name (users with a people row)."""
    prof = access_profile(access_log)
    return (prof.join(people, prof.by_who == people.person_id, "inner")
            .select("name", "total", "distinct_pages"))


def daily_pages(access_log: DataFrame) -> DataFrame:
    """(by_who, day, page, bits, n_rows): the distinct pages of each user and day as
    bitmaps, to be kept and merged (``operators.bitmaps``). Accesses
    without a user are left out; those without a time are in day null."""
    dated = access_log.where(F.col("by_who").isNotNull()).withColumn("day", F.to_date("access_time"))
    return bitmaps.build(dated, ["by_who", "day"], "what_page")


def access_profile_merged(daily: DataFrame) -> DataFrame:
    """``access_profile`` from the daily bitmaps, without the log."""
    return bitmaps.counts(bitmaps.merge(daily, ["by_who"]), ["by_who"], "total", "distinct_pages")


def rolling_access_profile(daily: DataFrame, days: int = 7) -> DataFrame:
    """``access_profile`` over the ``days`` days that end at each day on which a user accessed a page."""
    return bitmaps.rolling_counts(daily.where(F.col("day").isNotNull()), ["by_who"], "day", days, "total", "distinct_pages")


# --- D11 / D12 -----------------------------------------------------------------
def friends_never_accessed(friends: DataFrame, access_log: DataFrame) -> DataFrame:
    """Distinct (person, friend) pairs where the person never accessed the
    friend's page."""
    pairs = R.distinct_minus(friends.where(F.col("person_id").isNotNull()
                                           & F.col("my_friend").isNotNull()),
                             ["person_id", "my_friend"],
                             access_log, ["by_who", "what_page"])
    return pairs.select("person_id", F.col("my_friend").alias("friend_id"),
                        X.prefixed(NEVER_ACCESSED, "my_friend").alias("message"))


def friends_never_accessed_of(friend_pairs: DataFrame, access_pairs: DataFrame) -> DataFrame:
    """``friends_never_accessed`` from the bucketed tables of both kinds of
    pairs (``operators.pairs``): no row is shuffled."""
    return pairs.minus(friend_pairs, access_pairs).select(
        F.col(pairs.LEFT).alias("person_id"), F.col(pairs.RIGHT).alias("friend_id"),
        X.prefixed(NEVER_ACCESSED, pairs.RIGHT).alias("message"))


def people_ignoring_a_friend_of(friend_pairs: DataFrame, access_pairs: DataFrame, people: DataFrame) -> DataFrame:
    """``people_ignoring_a_friend`` from the bucketed tables: of the pairs, only
    each task's distinct people are shuffled."""
    ignoring = pairs.minus(friend_pairs, access_pairs)
    return R.keep_matching(people, "person_id", ignoring, pairs.LEFT).select("person_id", "name")


def people_ignoring_a_friend(friends: DataFrame, access_log: DataFrame,
                             people: DataFrame) -> DataFrame:
    """People with at least one friend whose page they never accessed."""
    ignoring = friends_never_accessed(friends, access_log).select("person_id").distinct()
    return R.keep_matching(people, "person_id", ignoring, "person_id").select("person_id", "name")


# --- D13 / D14 / D15 -----------------------------------------------------------
def _last_access(access_log: DataFrame) -> DataFrame:
    """Latest access per user, and how many of the group's rows name a user
    (0 for the group without one, which is kept for the overall maximum)."""
    return access_log.groupBy("by_who").agg(F.max("access_time").alias("_last"),
                                            F.count("by_who").alias("_named"))


def _threshold(last: DataFrame, as_of, days: int) -> Column:
    """``as_of - days``; the default anchor is the maximum over ``last``, with
    the columns its other use needs, so that both share one exchange and the
    log is read once."""
    if as_of is None:
        anchor = last.select(F.max(F.when(F.col("_named") >= 0, F.col("_last")))).scalar()
    elif isinstance(as_of, Column):
        anchor = as_of
    else:
        if isinstance(as_of, str):
            as_of = _dt.datetime.fromisoformat(as_of)
        anchor = F.lit(as_of).cast("timestamp_ntz")
    return X.days_before(anchor, days)


def disconnected_users(access_log: DataFrame, days: int = 14, as_of=None) -> DataFrame:
    """Users (with at least one log row) whose latest access is older than
    ``as_of - days``. ``as_of`` defaults to the latest access in the log (never
    the wall clock); a user whose times are all missing counts as inactive."""
    last = _last_access(access_log)
    thr = _threshold(last, as_of, days)
    return (last.where((F.col("_named") > 0) & (F.col("_last").isNull() | (F.col("_last") < thr)))
            .select("by_who"))


def disconnected_as_of(state: DataFrame, days: int = 14) -> DataFrame:
    """``disconnected_users`` from a state of last accesses (``sources.state``)."""
    last = state.select("by_who", F.col("last_time").alias("_last"), F.col("named").cast("int").alias("_named"))
    thr = _threshold(last, None, days)
    return (last.where((F.col("_named") > 0) & (F.col("_last").isNull() | (F.col("_last") < thr)))
            .select("by_who"))


def matching_people(people: DataFrame, ids: DataFrame, ids_key: str = "by_who") -> DataFrame:
    """People whose id is in an id list (semi join)."""
    return R.keep_matching(people, "person_id", ids, ids_key).select("person_id", "name")


def isolated_inactive_people(people: DataFrame, friends: DataFrame, access_log: DataFrame,
                             days: int = 14, as_of=None) -> DataFrame:
    """People with no outgoing friendship and no access after
    ``as_of - days`` (``as_of`` defaults to the latest access time)."""
    last = _last_access(access_log)
    recent = last.where((F.col("_named") > 0) & (F.col("_last") > _threshold(last, as_of, days)))
    alone = R.drop_matching(people.where(F.col("person_id").isNotNull()),
                            "person_id", friends, "person_id")
    return R.drop_matching(alone, "person_id", recent, "by_who").select("person_id", "name")


# --- D16 / D17 / D18 -----------------------------------------------------------
def friend_counts(friends: DataFrame) -> DataFrame:
    """Out-degree per person with at least one friend row."""
    return R.count_by(friends.where(F.col("person_id").isNotNull()), "person_id", "num_friends")


def friend_counts_from_adjacency(lines: DataFrame) -> DataFrame:
    """Out-degree from adjacency-list lines ``user,f1,f2,...`` (column
    ``value``): the number of fields after the first, which must be digits."""
    first = F.trim(F.get("fields", F.lit(0)))
    return (Rd.split_fields(lines).where((F.size("fields") > 1) & X.digits_only(first))
            .select(first.try_cast("bigint").alias("person_id"),
                    (F.size("fields") - 1).cast("bigint").alias("num_friends")))


def friend_count_report(friends: DataFrame = None, counts: DataFrame = None) -> DataFrame:
    """``USER_<id>`` rows with each out-degree plus one 'Average Friendships'
    row holding the truncated mean over persons with a friend row."""
    fc = counts if counts is not None else friend_counts(friends)
    detail = fc.select(X.prefixed(USER_PREFIX, "person_id").alias("label"),
                       F.col("num_friends").cast("bigint").alias("value"))
    # Integer division of non-negative totals = truncation of the mean.
    average = fc.agg(
        F.lit(AVERAGE_LABEL).alias("label"),
        F.coalesce(F.expr("sum(num_friends) div count(1)"), F.lit(0)).cast("bigint").alias("value"))
    return detail.unionByName(average)


def friend_count_report_chunked(chunks: DataFrame) -> DataFrame:
    """``friend_count_report`` from adjacency lists in chunks (``operators.adjacency``)."""
    return friend_count_report(counts=adjacency.degrees(chunks))


def popular_people(friends: DataFrame, people: DataFrame) -> DataFrame:
    """People whose out-degree is strictly above the mean out-degree of
    persons with at least one friend row; name trimmed."""
    fc = friend_counts(friends)
    mean = fc.select(X.safe_ratio(F.sum("num_friends"), F.count(F.lit(1)))).scalar()
    above = fc.where(F.col("num_friends").cast("double") > mean)
    return (above.join(people, above.person_id == people.person_id, "inner")
            .select(F.trim("name").alias("name"), F.col("num_friends").alias("friend_count")))
