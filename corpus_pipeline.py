"""A training corpus from `documents`, in five stages.

Each stage calls one operator of ``tidepool.llm``; its result is written as
Parquet and read again as the next one's documents. Every stage but the last
returns the columns of documents, n_chars being counted anew where the text
was cut.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import decontamination, line_dedup, packing, quality_classifier, simhash
from tidepool.llm.store import Scratch, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    judged = quality_classifier.classify(docs, table(spark, sf_dir, "labels"), columns=COLUMNS)
    return judged.where("kept").select(*COLUMNS)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that ten documents or more share go; the documents stay."""
    out = line_dedup.dedup_lines(docs, min_docs=10, min_chars=1)
    return out.withColumn("n_chars", F.when(F.col("n_dropped") > 0, F.length("text").cast("bigint"))
                          .otherwise(F.col("n_chars"))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group, the row of the smallest id stays (ids before none, then
    by text hash); of rows alike in both, one."""
    d1, d2 = decontamination.text_key("text")
    named = simhash.near_duplicates(docs, shingle=4, max_bits=4, carry={"d1": d1, "d2": d2})
    first = named.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "d1", "d2")).alias("k"))
    # The id as two columns that are never null: one exchange of the texts serves the join and what follows.
    key = lambda i: [i.isNull().alias("none"), F.coalesce(i, F.lit(0)).alias("i")]
    kept = Scratch(spark, "pipeline").write(first.select(*key(F.col("k.doc_id")), F.col("k.d1").alias("d1"),
                                                         F.col("k.d2").alias("d2")), "kept")
    keyed = docs.select(*COLUMNS, *key(F.col("doc_id")), d1.alias("d1"), d2.alias("d2"))
    same = ["none", "i", "d1", "d2"]
    return keyed.join(kept, same, "left_semi").dropDuplicates(same).select(*COLUMNS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage go."""
    judged = decontamination.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return judged.where("NOT contaminated").select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", decontaminate),
    ("packing", pack),
]

#: Not expressible: fingerprints, a trained classifier, tokens.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scratch = Scratch(spark, "corpus")
    for name, stage in STAGES:
        done = docs
        docs = scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(done)
    return docs
