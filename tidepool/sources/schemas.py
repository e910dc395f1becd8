"""Declared schemas of the logical tables.

Ids are 64-bit everywhere (they join against 64-bit driver-table keys and
never overflow at scale); counts produced by the jobs are 64-bit as well.
"""

from pyspark.sql import types as T

PEOPLE = T.StructType([
    T.StructField("person_id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("nationality", T.StringType()),
    T.StructField("country_code", T.IntegerType()),
    T.StructField("hobby", T.StringType()),
])

FRIENDS = T.StructType([
    T.StructField("friend_rel", T.LongType()),
    T.StructField("person_id", T.LongType()),
    T.StructField("my_friend", T.LongType()),
    T.StructField("date_of_friendship", T.DateType()),
    T.StructField("descr", T.StringType()),
])

ACCESS_LOG = T.StructType([
    T.StructField("access_id", T.LongType()),
    T.StructField("by_who", T.LongType()),
    T.StructField("what_page", T.LongType()),
    T.StructField("type_of_access", T.StringType()),
    T.StructField("access_time", T.TimestampNTZType()),
])

ATTENDEES = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("name", T.StringType()),
    T.StructField("table", T.LongType()),
    T.StructField("test", T.StringType()),
])

ATTENDEES_NO_DISCLOSURE = T.StructType([f for f in ATTENDEES.fields if f.name != "test"])

REPORTS = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("test", T.StringType()),
])

POINTS = T.StructType([
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

CENTROIDS = T.StructType([
    T.StructField("id", T.IntegerType()),
    T.StructField("x", T.DoubleType()),
    T.StructField("y", T.DoubleType()),
])

# Text layouts: the raw column names used in the reference's header lines.
# Fixed values (header spellings of the original files):
#   pages.csv:        PersonID,Name,Nationality,Country Code,Hobby
#   friends.csv:      FriendRel,PersonID,MyFriend,DateOfFriendship,Desc
#   access_logs.csv:  AccessID,ByWho,WhatPage,TypeOfAccess,AccessTime
#   attendee files:   id,name,table,test
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"

# Every text source is first read as strings, then typed with try_cast so a
# dirty field becomes NULL instead of failing the job (ANSI mode is on).
def as_text(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
