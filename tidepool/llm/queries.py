"""Registered queries of the numbered operators.

Each applies its operator, with production parameters, to its whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tidepool.llm import alignment as alignment_
from tidepool.llm import decontamination as decontamination_
from tidepool.llm import embedding_dedup as embedding_dedup_
from tidepool.llm import language_id as language_id_
from tidepool.llm import license_scan as license_scan_
from tidepool.llm import line_dedup as line_dedup_
from tidepool.llm import packing as packing_
from tidepool.llm import prefix_trie as prefix_trie_
from tidepool.llm import quality_classifier as quality_classifier_
from tidepool.llm import quality_rules as quality_rules_
from tidepool.llm import simhash as simhash_
from tidepool.llm import token_counts as token_counts_
from tidepool.llm import url_filter as url_filter_
from tidepool.llm.store import table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_.pack(table(spark, sf_dir, "documents"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup_.dedup_lines(table(spark, sf_dir, "documents"), min_docs=10, min_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


#: The rules of the registered URL filter.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"),
             ("allow", "com/fr/"), ("block", "com/de/")]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter_.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts_.token_counts(table(spark, sf_dir, "documents"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = license_scan_.scan(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.concat_ws(",", "licenses").alias("licenses"), "containment")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = quality_classifier_.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"),
                                       columns=["doc_id"])
    return out.select("doc_id", "p_low", "p_toxic", "kept")


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id_.predict_languages(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules_.judge(table(spark, sf_dir, "documents"))


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash_.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)
    return out.select("doc_id", "fingerprint", "component_id")


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontamination_.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "contaminated", "items", "agreement")


def op11_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup_.near_duplicates(table(spark, sf_dir, "embeddings"), threshold=0.93)


def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    nodes, ends = prefix_trie_.trie(table(spark, sf_dir, "conversations"), regroup=(5, 9))
    out = nodes.join(prefix_trie_.digests(ends), prefix_trie_.KEY, "left")
    return out.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
                      F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"))


def op13_cross_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2("groups", 256))
    return alignment_.align(table(spark, sf_dir, "documents"), derive={"groups_sha256": digest})


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: list[Callable[[SparkSession, str], DataFrame]] = [
    op1_packing, op2_line_dedup, op3_url_filters, op4_token_counts, op5_license_scans, op6_quality_classifier, op7_language_id, op8_quality_rules,
    op9_simhash_near_dedup,
    op10_benchmark_decontamination, op11_embedding_near_dedup,
    op12_conversation_prefix_trie, op13_cross_tokenizer_alignment, pipeline]
_WORDINGS = ",\n         ".join(f"('{name}', '{text}')" for name, texts in license_scan_.TEMPLATES.items() for text in texts)
ORACLES: dict[str, str] = {
    "op2_line_dedup": r"""
WITH l AS (
  SELECT doc_id, i, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                               ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
  FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS i
        FROM documents)),
f AS (SELECT key FROM l WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.*, f.key IS NOT NULL AS gone FROM l LEFT JOIN f USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
""",
    "op5_license_scans": rf"""
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (SELECT doc_id, list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh FROM w),
v(name, text) AS (
  VALUES {_WORDINGS}),
t AS (SELECT name, list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)]) AS sh
      FROM (SELECT name, list_filter(regexp_split_to_array(lower(text), '[^\p{{L}}\p{{N}}]+'), lambda x: x <> '') AS w FROM v)),
c AS (SELECT doc_id, name, max(len(list_intersect(s.sh, t.sh)) / len(t.sh)) AS c FROM s, t GROUP BY doc_id, name)
SELECT doc_id, coalesce(string_agg(name, ',' ORDER BY name) FILTER (WHERE c >= 0.8), '') AS licenses,
       CASE WHEN max(c) >= 0.8 THEN max(c) END AS containment
FROM c GROUP BY doc_id
""",
    # Prefixes as lists of turns; a leaf or a node's saving counts for every prefix of its owner's path to it.
    "op12_conversation_prefix_trie": """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY pos) AS turns FROM t GROUP BY conv_id),
h AS (SELECT conv_id, turns, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))),
        lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]),
                                 lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 9 AS h
      FROM l),
r AS (SELECT h.conv_id, list_concat(coalesce(b.turns[:h.h], []), h.turns[h.h + 1:]) AS turns
      FROM h LEFT JOIN l b ON b.conv_id = h.conv_id - h.conv_id % 5),
p AS (SELECT conv_id, d AS depth, turns[:d] AS prefix, len(turns) AS n FROM r, unnest(range(len(turns) + 1)) AS u(d)),
g AS (SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '') AS ends
      FROM p GROUP BY prefix, depth),
k AS (SELECT prefix[:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
n AS (SELECT g.*, coalesce(k.n_children, 0) AS n_children, CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(prefix[depth].text) ELSE 0 END AS saved
      FROM g LEFT JOIN k USING (prefix, depth)),
s AS (SELECT prefix[:d] AS prefix, d AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
      FROM n, unnest(range(depth + 1)) AS u(d) GROUP BY ALL)
SELECT n.conv_id, n.depth, q.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves,
       CAST(s.saved_tokens AS BIGINT) AS saved_tokens, sha256(n.ends) AS ends_sha256
FROM n JOIN s USING (prefix, depth) LEFT JOIN g q ON q.depth = n.depth - 1 AND q.prefix = n.prefix[:n.depth - 1]
""",
    "op11_embedding_near_dedup": """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CASE WHEN label IS NOT NULL AND len(embedding) > 0
    AND list_count(embedding) = len(embedding) AND list_bool_and(list_transform(embedding, lambda x: isfinite(x)))
    AND list_bool_or(list_transform(embedding, lambda x: x <> 0)) THEN CAST(embedding AS DOUBLE[]) END AS e
  FROM embeddings),
p AS (SELECT a.r AS r, b.r AS s FROM v a JOIN v b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
      WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
c(r, s) AS (SELECT r, r FROM v UNION SELECT c.r, p.s FROM c JOIN p ON c.s = p.r),
m AS (SELECT c.r, min(v.vec_id) AS component_id FROM c JOIN v ON v.r = c.s GROUP BY c.r),
n AS (SELECT r, count(*) AS n FROM p GROUP BY r)
SELECT vec_id, coalesce(n.n, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM v JOIN m USING (r) LEFT JOIN n USING (r)
""",
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
