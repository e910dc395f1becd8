"""URL filter: explicit rules, and logistic regression where none fits.

A rule is a host and a path prefix; it fits its host and all subdomains, and
the longest that fits decides. Other URLs are judged by a logistic regression
on hashed character n-grams of host and path, kept apart by field. It is
trained on the driver from a small labelled table, about `max_urls` distinct
URLs a class at most, chosen by a hash of host and path, however many copies
each has; the model is 2^bits weights, broadcast.
Judging is map-only: parsing and rules are column expressions, and only
scoring runs in numpy, over Arrow batches.

Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased;
path: from there up to `?`, `#` or the end. Defined results: a null URL or one
without `://` has empty host and path and is judged like any other; ties
between rules cannot occur, as rules of one length that fit one URL are equal;
with no labelled URL, or one class only, the method's verdict is that class
or else `allow`; repeated rows give repeated results; an empty table gives no
rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm import ngrams

SIZES = (2, 3, 4)
ALLOW, BLOCK = "allow", "block"
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: str = "url") -> Column:
    raw = F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 1)
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path(url: str = "url") -> Column:
    return F.regexp_extract(F.coalesce(F.col(url), F.lit("")), _PARTS, 2)


def rule(rules: list[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decision, text in sorted(rules, key=lambda r: len(r[1])):
        own, slash, rest = text.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        found, verdict = F.when(fits, F.lit(text)).otherwise(found), F.when(fits, F.lit(decision)).otherwise(verdict)
    return found, verdict


def features(host: str, path: str, bits: int) -> np.ndarray:
    """Distinct buckets of a URL's n-grams; ends are marked."""
    return np.unique(np.concatenate([
        ngrams.buckets(ngrams.code_points(f"\x02{host}\x03"), SIZES, bits, 0),
        ngrams.buckets(ngrams.code_points(f"\x02{path}\x03"), SIZES, bits, 1)]))


def train(labelled: DataFrame, bits: int = 16, max_urls: int = 4000, steps: int = 150, penalty: float = 1e-3) -> np.ndarray:
    """Weights, the last one the constant, from labelled (host, path, verdict)."""
    known = labelled.where(F.col("verdict").isin(ALLOW, BLOCK)).select("host", "path", "verdict")
    # Copies share their hash, so the share is of distinct URLs.
    number = F.xxhash64("host", "path")
    share = F.lit(0.0)
    for r in known.select("verdict", number.alias("u")).distinct().groupBy("verdict").count().collect():  # two classes
        share = F.when(F.col("verdict") == r.verdict, F.lit(max_urls / r["count"])).otherwise(share)
    unit = F.pmod(number, F.lit(1 << 30)) / F.lit(float(1 << 30))
    rows = sorted(known.where(unit < share).distinct().collect())
    w = np.zeros((1 << bits) + 1)
    y = np.array([r.verdict == BLOCK for r in rows], float)
    if not len(y) or y.min() == y.max():
        w[-1] = 20.0 if len(y) and y[0] else -20.0
        return w
    found = [features(r.host, r.path, bits) for r in rows]
    size = np.array([len(f) for f in found])
    at, row = np.concatenate(found), np.repeat(np.arange(len(rows)), size)
    value = (1 / np.sqrt(np.maximum(size, 1)))[row]  # rows of length one
    weight = np.where(y > 0, 0.5 / y.sum(), 0.5 / (len(y) - y.sum()))  # both classes count alike
    speed, square = np.zeros_like(w), np.zeros_like(w)
    for step in range(1, steps + 1):  # Adam on the whole sample
        z = np.bincount(row, w[at] * value, len(y)) + w[-1]
        miss = (1 / (1 + np.exp(-z)) - y) * weight
        grad = penalty / len(w) * w
        grad[:-1] += np.bincount(at, miss[row] * value, len(w) - 1)
        grad[-1] += miss.sum()
        speed = 0.9 * speed + 0.1 * grad
        square = 0.99 * square + 0.01 * grad * grad
        w -= 0.1 * (speed / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    return w


def judge(pages: DataFrame, rules: list[tuple[str, str]], labelled: DataFrame | None = None, bits: int = 16,
          max_urls: int = 4000, threshold: float = 0.5, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """id, host, path, rule, verdict and p_block (null where a rule decides).

    `labelled` holds host, path and verdict; without it, the URLs that the
    rules decide are the labelled ones.
    """
    src = pages.select(F.col(id_col).cast("bigint").alias("id"), host(url_col).alias("host"), path(url_col).alias("path"))
    found, verdict = rule(rules, F.col("host"), F.col("path"))
    src = src.withColumns({"rule": found, "verdict": verdict})
    model = train(src.where("verdict IS NOT NULL") if labelled is None else labelled, bits, max_urls)
    weights = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights.value
        for b in batches:
            p, out = [], []
            for h, s, v in zip(*(b.column(k).to_pylist() for k in ("host", "path", "verdict"))):
                if v is None:
                    f = features(h, s, bits)
                    z = w[f].sum() / np.sqrt(max(1, len(f))) + w[-1]
                    p.append(float(1 / (1 + np.exp(-z))))
                    out.append(BLOCK if p[-1] > threshold else ALLOW)
                else:
                    p.append(None)
                    out.append(v)
            yield pa.RecordBatch.from_arrays([*(b.column(k) for k in ("id", "host", "path", "rule")),
                                              pa.array(out, pa.string()), pa.array(p, pa.float64())],
                                             names=["id", "host", "path", "rule", "verdict", "p_block"])

    return src.mapInArrow(run, "id bigint, host string, path string, rule string, verdict string, p_block double"
                          ).withColumnRenamed("id", id_col)
