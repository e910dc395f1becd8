"""Adjacency lists in bounded chunks.

A person's list is cut into rows (person_id, chunk, friends, n): chunk c holds
the friends whose ids lie in [c * width, (c + 1) * width), each once with its
number of friend rows, so that no row has more than ``width`` entries and a hub
with millions of friends is many rows. A chunk's address follows from the ids
alone: edges that come later meet the chunk they belong to.

Defined results: rows without a person are left out; rows without a friend
count and are in a chunk of their own (null); an empty input gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SCHEMA = "person_id BIGINT, chunk BIGINT, friends ARRAY<STRUCT<friend: BIGINT, copies: BIGINT>>, n BIGINT"


def _chunked(edges: DataFrame, width: int) -> DataFrame:
    """Chunks of (person_id, friend, copies) with each pair once."""
    entry = F.struct("friend", "copies")
    return (edges.groupBy("person_id", F.floor(F.col("friend") / F.lit(width)).cast("bigint").alias("chunk"))
            .agg(F.sort_array(F.collect_list(entry)).alias("friends"), F.sum("copies").alias("n")))


def build_chunks(friends: DataFrame, width: int = 1024) -> DataFrame:
    """The chunks of a friends table; copies of a pair collapse before the
    first shuffle, and no group of the second has more than ``width`` rows."""
    edges = (friends.where(F.col("person_id").isNotNull())
             .groupBy("person_id", F.col("my_friend").alias("friend")).agg(F.count(F.lit(1)).alias("copies")))
    return _chunked(edges, width)


def explode_chunks(chunks: DataFrame) -> DataFrame:
    """(person_id, friend, copies) of chunks."""
    return chunks.select("person_id", F.explode("friends").alias("e")).select("person_id", "e.friend", "e.copies")


def merge_chunks(chunks: DataFrame, more: DataFrame, width: int = 1024) -> DataFrame:
    """Chunks of two sets of edges, both in chunks of ``width``: entries of the
    same friend add up."""
    edges = (explode_chunks(chunks).unionByName(explode_chunks(more))
             .groupBy("person_id", "friend").agg(F.sum("copies").alias("copies")))
    return _chunked(edges, width)


def degrees(chunks: DataFrame) -> DataFrame:
    """Friend rows per person, from the sizes of the chunks: their entries are
    not read."""
    return chunks.groupBy("person_id").agg(F.sum("n").alias("num_friends"))


def chunk_lines(chunks: DataFrame) -> DataFrame:
    """Adjacency-list lines ``person,f1,f2,...`` (column ``value``), one a chunk; a friend of several rows is
    repeated, and one without an id is an empty field."""
    ids = F.flatten(F.transform("friends", lambda e: F.array_repeat(
        F.coalesce(e["friend"].cast("string"), F.lit("")), e["copies"].cast("int"))))
    return chunks.select(F.concat_ws(",", F.col("person_id").cast("string"), ids).alias("value"))
