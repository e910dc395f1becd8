"""Writers (K1-K9).

Writes keep the job's parallelism: one file per partition. A single output
file (``coalesce(1)``) is opt-in because it funnels the whole result through
one task; use it only for results whose size is bounded (a top-k, a centroid
report).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, sep: str = ",", header: bool = False,
              mode: str = "errorifexists", compression: str | None = None,
              single_file: bool = False) -> None:
    """K3/K5/K6: delimited text output.

    ``mode='errorifexists'`` fails when the folder exists (the plain text
    save of the reference); ``'overwrite'`` replaces it.
    """
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(mode).option("sep", sep).option("header", header)
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_key_value(df: DataFrame, path: str, key: str, values: Iterable[str],
                    mode: str = "errorifexists", compression: str | None = None) -> None:
    """K1/K2: ``key<TAB>v1,v2,...`` lines, optionally compressed (e.g. snappy)."""
    vals = [F.col(v).cast("string") for v in values]
    out = df.select(F.col(key).cast("string").alias("k"),
                    F.concat_ws(",", *vals).alias("v"))
    write_csv(out, path, sep="\t", header=False, mode=mode, compression=compression)


def write_lines(df: DataFrame, path: str, mode: str = "errorifexists",
                single_file: bool = False) -> None:
    """Plain text lines from a single string column ``value``."""
    out = df.coalesce(1) if single_file else df
    out.write.mode(mode).text(path)


def report_lines(centers: DataFrame) -> DataFrame:
    """K8: centre report as text lines ``id<TAB>x,y`` plus a trailer
    ``Convergence: yes|no`` (from the ``converged`` column).

    ``centers`` holds one row per cluster (k rows), so ordering the lines in
    one partition is bounded by k.
    """
    body = centers.select(
        F.lit(0).alias("_part"), F.col("id").alias("_ord"),
        F.concat(F.col("id").cast("string"), F.lit("\t"), F.col("x").cast("string"),
                 F.lit(","), F.col("y").cast("string")).alias("value"))
    trailer = centers.agg(
        F.lit(1).alias("_part"), F.lit(0).alias("_ord"),
        F.concat(F.lit("Convergence: "),
                 F.when(F.bool_and("converged"), F.lit("yes")).otherwise(F.lit("no"))
                 ).alias("value"))
    return (body.unionByName(trailer).coalesce(1)
            .sortWithinPartitions("_part", "_ord").select("value"))


def tagged_lines(df: DataFrame, outputs: dict[str, tuple[Column, list[str]]]) -> DataFrame:
    """K7: (output, value): each row as a CSV line of every output whose condition
    it meets, with that output's columns.

    All outputs come from one pass over ``df``, however many they are. A row
    that meets no condition (or whose conditions are null) is in none.
    """
    lines = [F.when(condition, F.struct(F.lit(name).alias("output"),
                                        F.to_csv(F.struct(*[F.col(f"`{c}`") for c in columns])).alias("value")))
             for name, (condition, columns) in outputs.items()]
    return df.select(F.explode(F.array_compact(F.array(*lines))).alias("o")).select("o.output", "o.value")


def write_tagged(df: DataFrame, outputs: dict[str, tuple[Column, list[str]]], path: str,
                 mode: str = "overwrite") -> None:
    """K7: ``tagged_lines`` written once, as text in ``path/output=<name>``
    (without header lines)."""
    tagged_lines(df, outputs).write.mode(mode).partitionBy("output").text(path)


def write_multi(df: DataFrame, outputs: dict[str, DataFrame], mode: str = "overwrite",
                header: bool = True, persist: bool = False) -> None:
    """K7: several outputs derived from one dataset.

    Each write reads the source anew, which for a scan is cheaper than
    caching it; ``persist`` keeps ``df`` for sources that are dear to repeat.
    """
    if persist:
        df.persist()
    try:
        for path, derived in outputs.items():
            write_csv(derived, path, header=header, mode=mode)
    finally:
        if persist:
            df.unpersist()
