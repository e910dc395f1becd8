"""Delimited-text scans.

All text is read by Spark's CSV reader (never ``textFile`` + split): it
splits files into partitions, honours quoting, and lets the typed projection
below push column pruning into the scan. Fields are read as strings and typed
with ``try_cast`` / ``try_to_timestamp`` so that a malformed field becomes
NULL; ``clean_rows`` then drops (and ``rejected_rows`` returns) every row
whose required fields failed to type.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.functions import expressions as X
from tidepool.sources import schemas as S

CORRUPT = "_corrupt_record"


def _typed(col: Column, dtype: T.DataType) -> Column:
    trimmed = F.trim(col)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return X.parse_timestamp(trimmed, S.TIMESTAMP_FORMAT).cast(dtype)
    if isinstance(dtype, T.DateType):
        return F.to_date(F.try_to_timestamp(trimmed, F.lit(S.DATE_FORMAT)))
    if isinstance(dtype, T.StringType):
        return col
    return trimmed.try_cast(dtype)


def read_text_table(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    sep: str = ",", header: bool = False,
                    keep_corrupt: bool = False) -> DataFrame:
    """Positional delimited scan with a declared schema.

    Columns are bound by position (the header, if any, is skipped but its
    spelling is not checked, so ``Country Code`` and ``country_code`` both
    load). Short rows are padded with NULL; extra fields are ignored.
    """
    text_schema = S.as_text(schema)
    if keep_corrupt:
        text_schema = text_schema.add(T.StructField(CORRUPT, T.StringType()))
    reader = (spark.read.schema(text_schema)
              .option("sep", sep)
              .option("header", header)
              .option("mode", "PERMISSIVE")
              .option("enforceSchema", True))
    if keep_corrupt:
        reader = reader.option("columnNameOfCorruptRecord", CORRUPT)
    raw = reader.csv(path)
    cols = [_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields]
    if keep_corrupt:
        cols.append(F.col(CORRUPT))
    return raw.select(*cols)


def read_text_table_by_file_name(spark: SparkSession, directory: str, file_name: str,
                                 schema: T.StructType, sep: str = ",",
                                 header: bool = True) -> DataFrame:
    """Scan a folder but keep only rows that came from ``file_name``.

    The predicate is on the hidden ``_metadata.file_name`` column, which is
    resolved per file split, so non-matching files cost no parsing work
    beyond being listed.
    """
    raw = (spark.read.schema(S.as_text(schema)).option("sep", sep)
           .option("header", header).csv(directory)
           .where(F.col("_metadata.file_name") == F.lit(file_name)))
    return raw.select(*[_typed(F.col(f.name), f.dataType).alias(f.name) for f in schema.fields])


def read_key_value(spark: SparkSession, path: str, key_name: str = "key",
                   value_names: Iterable[str] = ("value",),
                   key_type: T.DataType = T.StringType(),
                   value_type: T.DataType = T.StringType()) -> DataFrame:
    """Read a ``key<TAB>v1,v2,...`` output of an earlier job."""
    value_names = list(value_names)
    raw = (spark.read.schema("k STRING, v STRING").option("sep", "\t").csv(path))
    parts = F.split(F.col("v"), ",")
    cols = [_typed(F.col("k"), key_type).alias(key_name)]
    for i, name in enumerate(value_names):
        cols.append(_typed(F.get(parts, i), value_type).alias(name))
    return raw.select(*cols)


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Raw lines (one ``value`` string per line) for irregular layouts."""
    return spark.read.text(path)


def read_file_lines(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """Lines (``value``) as they stand in the files, without blank ones; with
    ``header``, less the first line of each file, and no other line like it.

    A file's first line is told by its place (the CSV scan's own rule, as
    files are split), so lines are read as one column whose separator and quote
    do not occur; a line that has the separator is kept whole.
    """
    if not header:
        return read_lines(spark, path).where(F.trim("value") != "")
    raw = (spark.read.schema(f"value STRING, {CORRUPT} STRING").option("header", True)
           .option("sep", "\u0001").option("quote", "").option("mode", "PERMISSIVE")
           .option("columnNameOfCorruptRecord", CORRUPT).csv(path))
    return raw.select(F.coalesce(F.col(CORRUPT), F.col("value")).alias("value")).where(F.trim("value") != "")


def split_fields(lines: DataFrame, sep: str = ",", limit: int = -1,
                 drop_trailing_empty: bool = False) -> DataFrame:
    """Split each line into an array column ``fields``.

    ``drop_trailing_empty=True`` mimics Java's ``String.split`` (trailing
    empty strings removed); Spark's ``split`` keeps them.
    """
    src = F.col("value")
    if drop_trailing_empty:
        src = F.regexp_replace(src, f"(?:{re.escape(sep)})+$", "")
    return lines.select(F.col("value"), F.split(src, re.escape(sep), limit).alias("fields"))


def required_present(schema_or_cols: T.StructType | Iterable[str]) -> Column:
    names = ([f.name for f in schema_or_cols.fields]
             if isinstance(schema_or_cols, T.StructType) else list(schema_or_cols))
    return X.all_present(names)


def clean_rows(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Keep rows whose required fields typed successfully."""
    out = df.where(required_present(required))
    return out.drop(CORRUPT) if CORRUPT in df.columns else out


def rejected_rows(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """Complement of ``clean_rows`` (for a reject count or a quarantine write)."""
    return df.where(~required_present(required))


def reject_count(df: DataFrame, required: Iterable[str]) -> DataFrame:
    """One-row DataFrame ``rejected`` counting the rows ``clean_rows`` drops."""
    return rejected_rows(df, required).agg(F.count(F.lit(1)).alias("rejected"))


# Key columns a row must type correctly to be usable, per logical table.
REQUIRED = {
    "people": ["person_id"],
    "friends": ["person_id", "my_friend"],
    "access_log": ["by_who", "what_page"],
    "attendees": ["id", "table"],
    "no_disclosure": ["id", "table"],
    "reports": ["id"],
}
TEXT_SCHEMAS = {
    "people": S.PEOPLE, "friends": S.FRIENDS, "access_log": S.ACCESS_LOG,
    "attendees": S.ATTENDEES, "no_disclosure": S.ATTENDEES_NO_DISCLOSURE,
    "reports": S.REPORTS,
}


def typed_lines(lines: DataFrame, schema: T.StructType, sep: str = ",") -> DataFrame:
    """``value`` and its typed fields, of every line (``value``) that is not blank."""
    ddl = ", ".join(f"`{f.name}` STRING" for f in schema.fields)
    fields = lines.where(F.trim("value") != "").select(
        "value", F.from_csv("value", F.lit(ddl), {"sep": sep, "mode": "PERMISSIVE"}).alias("f"))
    return fields.select("value", *[_typed(F.col(f"f.{f.name}"), f.dataType).alias(f.name)
                                    for f in schema.fields])


CLEAN = "clean"


def observed_clean(df: DataFrame, required: Iterable[str]) -> tuple[DataFrame, Observation]:
    """``clean_rows`` that count as they run: the observation has, once an
    action over the whole result has run, the number of clean rows and, for
    each required field, of rows of which it is the first that failed to type.

    The counts are taken in the job's own pass, from tasks that succeeded; an
    action that stops early (a ``limit`` straight on the rows) sees a part only.
    """
    required = list(required)
    seen = Observation()
    counts = [F.count_if(required_present(required)).alias(CLEAN)]
    earlier = F.lit(True)
    for name in required:
        counts.append(F.count_if(earlier & F.col(name).isNull()).alias(name))
        earlier = earlier & F.col(name).isNotNull()
    return clean_rows(df.observe(seen, *counts), required), seen


def reject_report(spark: SparkSession, seen: Observation) -> DataFrame:
    """(reason, n) of an observation whose job has run: 'clean', and the
    required fields by name."""
    return spark.createDataFrame(sorted(seen.get.items()), "reason STRING, n BIGINT")


def classify_rows(spark: SparkSession, path: str, table: str, header: bool = True,
                  sep: str = ",") -> DataFrame:
    """S9 as a job: every line of ``table``'s text layout, typed, with
    ``status`` = 'clean' or 'rejected' and, for rejected rows, ``raw_line``.

    The rule is that of ``clean_rows``: the key columns must type; a short
    line is padded with NULL and extra fields are ignored. Lines come from a
    text scan, so ``raw_line`` is the line as it stands in the file. With
    ``header``, the first line of each file is its header line.
    """
    schema = TEXT_SCHEMAS[table]
    typed = typed_lines(read_file_lines(spark, path, header), schema, sep)
    ok = required_present(REQUIRED[table])
    return typed.select(
        *[f.name for f in schema.fields],
        F.when(~ok, F.col("value")).alias("raw_line"),
        F.when(ok, F.lit("clean")).otherwise(F.lit("rejected")).alias("status"))


# --- convenience loaders for the reference's text layouts -------------------

def read_people(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.PEOPLE, header=header)


def read_friends(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.FRIENDS, header=header)


def read_access_log(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.ACCESS_LOG, header=header)


def read_attendees(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.ATTENDEES, header=header)


def read_attendees_no_disclosure(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.ATTENDEES_NO_DISCLOSURE, header=header)


def read_reports(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    return read_text_table(spark, path, S.REPORTS, header=header)


def read_points(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Points ``x,y``; a textual ``x,y`` header line simply fails to type and
    is removed by ``clean_rows``."""
    return clean_rows(read_text_table(spark, path, S.POINTS, header=header), ["x", "y"])


def read_seeds(spark: SparkSession, path: str) -> DataFrame:
    """Seeds in either layout: ``x,y`` or ``id<TAB>x,y`` (the centroid state).

    Ids are the seed's position in the file for ``x,y`` lines and the given
    id for the tabbed layout; files of a folder count in order of their
    names. A seed file has one line per cluster, and all its lines are
    numbered in one window.
    """
    from pyspark.sql import Window
    lines = spark.read.text(path).where(F.trim("value") != "")
    tabbed = F.instr(F.col("value"), "\t") > 0
    key = F.when(tabbed, F.substring_index("value", "\t", 1))
    body = F.when(tabbed, F.substring_index("value", "\t", -1)).otherwise(F.col("value"))
    parts = F.split(F.trim(body), ",")
    with_pos = lines.select(
        F.struct("_metadata.file_path", "_metadata.file_block_start",
                 F.monotonically_increasing_id()).alias("_pos"),
        F.trim(key).try_cast("int").alias("_id"),
        F.trim(F.get(parts, 0)).try_cast("double").alias("x"),
        F.trim(F.get(parts, 1)).try_cast("double").alias("y"),
    ).where(F.col("x").isNotNull() & F.col("y").isNotNull())
    pos = (F.row_number().over(Window.orderBy("_pos")) - 1).cast("int")
    return with_pos.select(F.coalesce(F.col("_id"), pos).alias("id"), "x", "y")
