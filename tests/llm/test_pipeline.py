import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tidepool.llm import decontamination, line_dedup, packing, quality_classifier, simhash
from tests.llm.test_decontamination import brute as leaked
from tests.llm.test_line_dedup import brute as cut
from tests.llm.test_simhash import brute_components, brute_fingerprint

SF = "/root/testdata/sf0.001"


def test_stages_are_the_operators():
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None


def test_each_stage_against_a_plain_statement(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    state = docs
    for n, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in state.collect()}
        stage(spark, state, SF).write.parquet(str(tmp_path / str(n)))
        state = spark.read.parquet(str(tmp_path / str(n)))
        rows = state.collect()
        if n < 4:
            assert set(state.columns) == set(docs.columns)
            after = {r.doc_id: r for r in rows}
            assert len(after) == len(rows)
        if n == 0:
            assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
        elif n == 1:
            plain = {i: t for i, _, _, t in cut([(i, r.text) for i, r in before.items()], 10)}
            assert {i: r.text or "" for i, r in after.items()} == plain
            assert all(r.n_chars == len(r.text) for r in rows if r.text is not None)
        elif n == 2:
            ids = sorted(before)
            root = brute_components([brute_fingerprint(before[i].text) for i in ids], 4)
            least = {}
            for i, g in zip(ids, root):
                least.setdefault(g, i)
            assert set(after) == set(least.values())
        elif n == 3:
            bench = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
            gone = set(before) - set(after)
            for i, r in before.items():
                if len(r.text) < 3000:
                    assert (i in gone) == any(leaked(r.text, b) for b in bench)
        else:
            assert {r.doc_id for r in rows} == set(before)


def test_edge_rows(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    base = " ".join(f"word{i}" for i in range(80))
    rows = [(None, None, None, None, None), (None, base, "en", "s", 1), (1, base, "en", "s", 1), (1, base, "en", "s", 1),
            (2, "", "en", None, 0), (3, "x", None, "s", 1), (4, "y " * 50_000, "en", "s", 9), (5, "other words here", "en", "s", 2)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert quality_classifier.classify(df, labels).where("kept").count() == len(rows)
    kept = corpus_pipeline.near_duplicates(spark, df, SF).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == [1, 2, 3, 4, 5]
    assert len(kept) == 5
    none = df.where("doc_id = -1")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0


def test_texts_cross_one_exchange_to_lose_their_near_duplicates(spark):
    rows = [(i, f"text number {i} of a few", "en", "s", 1) for i in range(50)] * 2
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = corpus_pipeline.near_duplicates(spark, df, SF)
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 2  # of the texts, and of the rows to keep
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("op", [
    lambda d: line_dedup.dedup_lines(d), lambda d: simhash.near_duplicates(d), lambda d: packing.pack(d),
    lambda d: decontamination.decontaminate(d, d.select(F.col("doc_id").alias("item_id"), "text").where("doc_id = 9"))])
def test_operators_take_a_table_of_nulls(spark, op):
    df = spark.createDataFrame([(None, None)] * 3, "doc_id bigint, text string")
    assert op(df).count() == 3
