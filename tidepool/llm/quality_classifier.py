"""Quality classifier: document evidence with hierarchical site priors.

Two heads, low quality and toxic, each in three levels.

Document. Features are a document's words, their prefixes within its language,
the punctuation its words end in, and thresholds a few ratios of the whole text
reach. From at most about `sample` labelled documents a class, Spark counts each
feature's documents and occurrences. A prefix is weighed against the labelled
documents of its own language, all else against those of all. With p the share
of bad documents that hold a feature, mu its occurrences a word in those and
lam in good documents, k occurrences in n words speak for bad by the Poisson
log ratio log p + k log(mu / lam) - n (mu - lam): repeated weak words add up, and a
word that a long text holds by chance does not count. A text's ratio that
is reached speaks by the log ratio of the documents that reach it. All rates
are taken at the cautious end of their counts (`caution` standard errors, for
texts' ratios `text_caution`), and
features with p mu / lam below `min_ratio`, or reached ratios below `min_text_ratio`,
are left out. A document's evidence
is its strongest feature's; if none speaks for bad, it is the log ratio of
labelled documents in which none does. Of labelled near-copies, those that share
three least shingle hashes, one counts.
`max_features` bounds the model a head: beyond it the weakest go. It bites only
when more features than that pass `min_ratio` (some 130 do at sf0.1).

Site. Host is the part of the source before the first slash, path the whole
source with the language. Summing the documents' posteriors under the global
prior gives a rate per host and path; each path's rate is shrunk to its host's,
each host's to the global one, by strengths estimated from the spread of the
rates (method of moments), so that sparse sites lean on the level above. A
document's own posterior is taken off its path's and host's sums first.

Decision. Evidence plus the log odds of the path's rate is the posterior; a
document goes if either head's exceeds `threshold`. The sums are combined
before the shuffle, and site tables are joined as Spark's size statistics say.
Building the DataFrame runs jobs: the fit, the scores and the site sums.

Defined results: a null text is an empty one; a null source or language counts
as the empty string; a very long text is scored whole, in time linear in it (one long
word too); without labels of a class that head never rejects;
conflicting labels of one id count each; labels without a document are
ignored; repeated rows give repeated results; an empty table gives no rows;
further columns are passed through, except that p_low, p_toxic and kept are
replaced if present.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import islice
from operator import eq

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidepool.llm.store import Scratch

HEADS = ("low", "toxic")
_WORDLIKE = re.compile(r"\w")
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>!@^~=+_{}[]\\")] = True
_REACHED = (0.02, 0.05, 0.1, 0.15, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8)
#: Labelled documents that feature counts refer to: all, or those of a language.
_ALL, _EVERY = "*", ""
#: Names longer than this are told by their hash.
_LONG = 64
#: Bound on memory, not on results: words remembered by one task.
MEMO_WORDS = 200_000
_COUNTED = 100_000  # rows a batch of counted features holds


def _named(kind: str, value: str) -> str:
    return kind + (value if len(value) <= _LONG else xxhash.xxh128_hexdigest(value.encode("utf-8", "surrogatepass")))


def _parts(token: str) -> tuple[str, str]:
    """A lower-cased token without what surrounds its word, and what follows it."""
    if token.isalnum():
        return token, ""
    first = _WORDLIKE.search(token)
    if not first:
        return "", token
    end = len(token) - _WORDLIKE.search(token[::-1]).start()
    return token[first.start():end], token[end:]


def word_features(token: str) -> list[str]:
    """Features of one white-space separated token: the word and the
    punctuation it ends in, in any language, and its prefixes (``p:``), which
    belong to its own."""
    word, tail = _parts(token.lower())
    names = [_named("w:", word)] if word else []
    names += ["p:" + word[:n] for n in (4, 5, 6) if len(word) > n]
    if tail and tail not in {",", "."}:
        names.append(_named("t:", tail))
    return names


def token_shape(token: str) -> tuple[bool, bool]:
    """Whether a token is upper-case throughout, and without letter or digit."""
    return len(token) > 1 and token.isupper(), not (token.isalnum() or any(map(str.isalnum, token)))


def text_features(text: str, tokens: list[str], distinct: int, upper: int, bare: int) -> list[str]:
    """Ratios of the whole text, as the thresholds they reach (``x:``)."""
    if not tokens:
        return ["x:empty"]
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    n = len(tokens)
    ratios = {"upper": upper / n, "symbol": _SYMBOL[raw].mean(), "bare": bare / n,
              "same": sum(map(eq, tokens, islice(tokens, 1, None))) / n}
    out = [f"x:{k}:{t}" for k, r in ratios.items() for t in _REACHED if r >= t]
    return out + [f"x:few:{t}:{int(math.log2(n) / 2)}" for t in _REACHED if distinct < t * n]


def document_features(text: str | None) -> tuple[Counter, int]:
    """Occurrences of every feature, and the number of words."""
    tokens = (text or "").split()
    counts = Counter(tokens)
    shapes = {t: token_shape(t) for t in counts}
    found = Counter(text_features(text or "", tokens, len(counts), *(
        sum(n for t, n in counts.items() if shapes[t][i]) for i in (0, 1))))
    for t, n in counts.items():
        for name in word_features(t):
            found[name] += n
    return found, len(tokens)


def _sketch(text: str) -> str:
    """Three least hashes of the shingles of five words, under three orders."""
    tokens = text.lower().split()
    shingles = (" ".join(tokens[i:i + 5]) for i in range(max(1, len(tokens) - 4)))
    h = np.fromiter((xxhash.xxh64_intdigest(x.encode("utf-8", "surrogatepass")) for x in shingles), np.uint64)
    orders = np.array([1, 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)
    return ",".join(str((h * o ^ (h * o >> np.uint64(32))).min()) for o in orders)


def labelled_sample(scratch: Scratch, docs: DataFrame, labels: DataFrame, sample: int, id_col: str, text_col: str,
                    lang_col: str) -> DataFrame:
    """(text, lang, low, toxic) of about `sample` labelled documents a class,
    one of each set of near-copies."""
    classes = labels.select(F.col("doc_id").alias("id"), (F.col("quality") == 0).cast("int").alias("low"),
                            F.col("toxic").cast("int").alias("toxic")).na.drop().distinct()
    share = F.lit(0.0)
    for r in classes.groupBy("low", "toxic").count().collect():  # at most four classes
        share = F.when((F.col("low") == r.low) & (F.col("toxic") == r.toxic), F.lit(sample / r["count"])).otherwise(share)
    unit = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # About 4 * sample ids of 16 bytes: bounded by the parameter, so broadcast.
    chosen = F.broadcast(classes.where(unit < share))
    known = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
                        F.coalesce(F.col(lang_col), F.lit("")).alias("lang")).join(chosen, "id")

    @F.pandas_udf("string")
    def sketch(texts: pd.Series) -> pd.Series:
        return texts.map(_sketch)

    one = (known.groupBy(sketch("text").alias("sketch"), "low", "toxic")
           .agg(F.min_by(F.struct("text", "lang"), F.xxhash64("text", "lang")).alias("d")))
    return scratch.write(one.select("d.text", "d.lang", "low", "toxic"), "sample")


def feature_counts(scratch: Scratch, sample: DataFrame) -> DataFrame:
    """Per (base, feature) that more than four bad documents of a head hold:
    documents (docs, docs_<head>), occurrences (times...) and words of the
    documents (words...). The feature _EVERY counts a base's documents."""

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        columns = ["base", "feature", "times", "words", *HEADS]
        rows: list[tuple] = []
        for b in batches:
            for text, lang, *bad in zip(b["text"], b["lang"], *(b[h] for h in HEADS)):
                found, n = document_features(text)
                own = "l:" + lang
                rows += [(_ALL, _EVERY, 0, n, *bad), (own, _EVERY, 0, n, *bad)]
                rows += [(own if f.startswith("p:") else _ALL, f, k, n, *bad) for f, k in found.items()]
                if len(rows) > _COUNTED:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
        yield pd.DataFrame(rows, columns=columns)

    found = sample.select("text", "lang", *HEADS).mapInPandas(
        extract, "base string, feature string, times bigint, words bigint, low int, toxic int")
    sums = [F.count("*").alias("docs"), F.sum("times").alias("times"), F.sum("words").alias("words")]
    for h in HEADS:
        sums += [F.sum(h).alias(f"docs_{h}"), F.sum(F.col(h) * F.col("times")).alias(f"times_{h}"),
                 F.sum(F.col(h) * F.col("words")).alias(f"words_{h}")]
    some = F.greatest(*[f"docs_{h}" for h in HEADS]) > 4
    return scratch.write(found.groupBy("base", "feature").agg(*sums).where(some | (F.col("feature") == _EVERY)), "counts")


def weigh(counts: DataFrame, head: str, caution: float, text_caution: float, min_ratio: float,
          min_text_ratio: float, max_features: int) -> list[tuple]:
    """(base, feature, log p, log ratio of an occurrence, excess rate a word) of
    the kept features; for a text's ratios the whole log ratio stands as log p."""
    every = counts.where(F.col("feature") == _EVERY).select(
        "base", F.col(f"docs_{head}").alias("bad"), (F.col("docs") - F.col(f"docs_{head}")).alias("good"),
        (F.col("words") - F.col(f"words_{head}")).alias("good_words"))

    reached = F.col("feature").startswith("x:")
    care = F.when(reached, text_caution).otherwise(caution)

    def high(n):
        return n + care * F.sqrt(n) + care

    a, c = F.col(f"docs_{head}"), F.col("docs") - F.col(f"docs_{head}")
    sure = a - care * F.sqrt(a)
    d = (counts.where((F.col("feature") != _EVERY) & (a > 4)).join(every.where("bad > 0 AND good > 0"), "base")
         .withColumn("p", sure / F.col("bad"))
         .withColumn("mu", F.when(reached, 1.0).otherwise(F.col(f"times_{head}") / F.col(f"words_{head}") * sure / a))
         .withColumn("lam", F.when(reached, high(c) / F.col("good")).otherwise(
             high(F.col("times") - F.col(f"times_{head}")) / F.greatest(F.col("good_words"), F.lit(1)))))
    ratio = F.col("p") * F.col("mu") / F.col("lam")
    kept = (d.where((ratio >= F.when(reached, min_text_ratio).otherwise(min_ratio)) & (F.col("mu") > F.col("lam"))).orderBy(ratio.desc(), "base", "feature")
            .limit(max_features).select("base", "feature", "p", "mu", "lam", ratio.alias("r")).collect())
    return [(k.base, k.feature, math.log(k.r), 0.0, 0.0) if k.feature.startswith("x:")
            else (k.base, k.feature, math.log(k.p), math.log(k.mu / k.lam), k.mu - k.lam) for k in kept]


class Evidence:
    """A document's log likelihood ratio per head, from the kept features."""

    def __init__(self, weights: dict[str, list[tuple]], none: dict[str, float]):
        self.none = none
        self.rows = [(i, *w[2:]) for i, h in enumerate(HEADS) for w in weights[h]]
        self.bases: dict[str, dict[str, list[int]]] = {_ALL: {}}
        for n, (base, name) in enumerate(w[:2] for h in HEADS for w in weights[h]):
            self.bases.setdefault(base, {}).setdefault(name, []).append(n)
        self._known: dict[str, dict[str, tuple]] = {}

    def __getstate__(self):
        return {**self.__dict__, "_known": {}}

    def _token(self, token: str, base: str) -> tuple:
        """The rows of a token's kept features, and its shape."""
        own, shared = self.bases.get(base, {}), self.bases[_ALL]
        hits = [i for f in word_features(token) for i in (own if f[0] == "p" else shared).get(f, ())]
        return hits, *token_shape(token)

    def strongest(self, text: str | None, lang: str | None) -> list[float]:
        """Each head's strongest feature, -inf if no kept one is present."""
        tokens = (text or "").split()
        counts = Counter(tokens)
        base = "l:" + (lang or "")
        if sum(map(len, self._known.values())) > MEMO_WORDS:
            self._known.clear()
        known = self._known.setdefault(base, {})
        times: dict[int, int] = {}
        upper = bare = 0
        for t, n in counts.items():
            k = known.get(t)
            if k is None:
                k = self._token(t, base)
                if len(t) <= _LONG:
                    known[t] = k
            hits, is_upper, is_bare = k
            if is_upper:
                upper += n
            if is_bare:
                bare += n
            for i in hits:
                times[i] = times.get(i, 0) + n
        for f in text_features(text or "", tokens, len(counts), upper, bare):
            for i in self.bases[_ALL].get(f, ()):
                times[i] = 1
        best = [-math.inf] * len(HEADS)
        for i, k in times.items():
            head, log_p, log_ratio, excess = self.rows[i]
            best[head] = max(best[head], log_p + k * log_ratio - len(tokens) * excess)
        return best

    def __call__(self, text: str | None, lang: str | None) -> list[float]:
        return [b if b > 0 else self.none[h] for b, h in zip(self.strongest(text, lang), HEADS)]


def fit(docs: DataFrame, labels: DataFrame, sample: int = 4000, max_features: int = 20_000, min_ratio: float = 6.0,
        min_text_ratio: float = 12.0, caution: float = 1.5, text_caution: float = 2.0, id_col: str = "doc_id", text_col: str = "text",
        lang_col: str = "lang") -> tuple[Evidence, dict[str, float]]:
    """The document classifier and each head's global rate among the labels."""
    scratch = Scratch(docs.sparkSession, "quality")
    known = labelled_sample(scratch, docs, labels, sample, id_col, text_col, lang_col)
    counts = feature_counts(scratch, known)
    weights = {h: weigh(counts, h, caution, text_caution, min_ratio, min_text_ratio, max_features) for h in HEADS}
    silent = Evidence(weights, dict.fromkeys(HEADS, -math.inf))
    judged = known.select(*HEADS, evidence_column(silent, "text", "lang").alias("e"))
    sums = [F.count("*").alias("docs")]
    for h in HEADS:
        quiet = (F.col(f"e.{h}") == -math.inf).cast("int")
        sums += [F.sum(h).alias(h), F.sum(quiet).alias(f"none_{h}"), F.sum(quiet * F.col(h)).alias(f"none_bad_{h}")]
    seen = judged.agg(*sums).first()
    none = {}
    for h in HEADS:
        if not weights[h]:
            none[h] = -math.inf
            continue
        bad, quiet = seen[h], seen[f"none_bad_{h}"]
        none[h] = min(0.0, math.log((quiet + 0.5) / (bad + 1)) - math.log((seen[f"none_{h}"] - quiet + 0.5) / (seen.docs - bad + 1)))
    scratch.drop(counts, known)
    rates = labels.agg(F.avg((F.col("quality") == 0).cast("int")).alias("low"), F.avg("toxic").alias("toxic")).first()
    return Evidence(weights, none), {h: min(max(rates[h] or 0.0, 1e-4), 0.5) for h in HEADS}


def evidence_column(model: Evidence, text_col: str, lang_col: str) -> Column:
    shared = None

    @F.pandas_udf("low double, toxic double")
    def evidence(texts: pd.Series, langs: pd.Series) -> pd.DataFrame:
        nonlocal shared
        shared = shared or model
        return pd.DataFrame([shared(t, x) for t, x in zip(texts, langs)], columns=list(HEADS), dtype=float)

    return evidence(F.col(text_col), F.col(lang_col))


def _odds(p: Column) -> Column:
    return F.ln(p / (1 - p))


def _posterior(evidence: Column, prior: Column) -> Column:
    return 1 / (1 + F.exp(-(F.greatest(evidence, F.lit(-700.0)) + _odds(prior))))


def _strength(rates: DataFrame, rate: str, above: str, n: str) -> float:
    """Pseudo-documents that the level above counts for: with rates of
    variance s around the level above, a Beta prior of mean m has m(1-m)/s - 1.
    The spread that counting itself makes is taken off first."""
    r, m = F.col(rate), F.col(above)
    row = rates.agg(F.sum(F.col(n) * F.pow(r - m, 2)).alias("spread"), F.sum(m * (1 - m)).alias("noise"),
                    F.sum(F.col(n) * m * (1 - m)).alias("scale"), F.sum(n).alias("n")).first()
    if not row.n or not row.scale:
        return 1.0
    between = max(row.spread - row.noise, 0.0) / row.n
    return min(max(row.scale / row.n / between - 1, 1.0), 1e6) if between else 1e6


def site_sums(scratch: Scratch, scored: DataFrame, rates: dict[str, float]) -> tuple[DataFrame, dict[str, tuple[float, float, float]]]:
    """Documents and summed posteriors per path and its host, from scored
    (host, path, low, toxic); and each head's global rate and the strengths of
    the global rate over hosts and of hosts over paths."""
    paths = scratch.write(scored.groupBy("host", "path").agg(
        F.count("*").alias("n"), *[F.sum(_posterior(F.col(h), F.lit(rates[h]))).alias(f"k_{h}") for h in HEADS]), "paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("host_n"), *[F.sum(f"k_{h}").alias(f"host_k_{h}") for h in HEADS])
    whole = paths.agg(F.sum("n").alias("n"), *[F.sum(f"k_{h}").alias(h) for h in HEADS]).first()
    out = scratch.write(paths.join(hosts, "host"), "sites")
    levels = {}
    for h in HEADS:
        base = min(max((whole[h] or 0.0) / (whole.n or 1), 1e-4), 0.5)
        above = hosts.select((F.col(f"host_k_{h}") / F.col("host_n")).alias("r"), F.lit(base).alias("m"), "host_n")
        m1 = _strength(above, "r", "m", "host_n")
        host = (F.col(f"host_k_{h}") + m1 * base) / (F.col("host_n") + m1)
        m2 = _strength(out.select((F.col(f"k_{h}") / F.col("n")).alias("r"), host.alias("m"), "n"), "r", "m", "n")
        levels[h] = (base, m1, m2)
    return out, levels


def site_prior(head: str, own: Column, levels: tuple[float, float, float]) -> Column:
    """The rate of a document's path, shrunk to its host's and that to the
    global one, without the document's own posterior."""
    base, m1, m2 = levels
    host = (F.col(f"host_k_{head}") - own + m1 * base) / (F.col("host_n") - 1 + m1)
    path = (F.col(f"k_{head}") - own + m2 * host) / (F.col("n") - 1 + m2)
    return F.least(F.greatest(path, F.lit(1e-4)), F.lit(0.999))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, sample: int = 4000, max_features: int = 20_000,
             columns: list[str] | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             source_col: str = "source") -> DataFrame:
    """The given columns of docs (all, if not named) with p_low, p_toxic and kept."""
    model, rates = fit(docs, labels, sample, max_features, id_col=id_col, text_col=text_col, lang_col=lang_col)
    scratch = Scratch(docs.sparkSession, "scores")
    source = F.coalesce(F.col(source_col), F.lit(""))
    # Both the sites' rates and the decisions need the evidence: it is kept with
    # the columns to return, so that each text is scored once.
    scored = scratch.write(docs.select(
        F.struct(*(columns or ["*"])).alias("row"), F.substring_index(source, "/", 1).alias("host"),
        F.concat(source, F.lit("\t"), F.coalesce(F.col(lang_col), F.lit(""))).alias("path"),
        evidence_column(model, text_col, lang_col).alias("e"))
        .select("row", "host", "path", *[F.col(f"e.{h}").alias(h) for h in HEADS]), "scored")
    sites, levels = site_sums(scratch, scored.select("host", "path", *HEADS), rates)
    out = scored.join(sites, ["host", "path"]).select("row", F.struct(*[
        _posterior(F.col(h), site_prior(h, _posterior(F.col(h), F.lit(rates[h])), levels[h])).alias(h)
        for h in HEADS]).alias("p"))
    out = out.select("row.*", F.col("p").alias("__p"))
    bad = (F.col("__p.low") > threshold) | (F.col("__p.toxic") > threshold)
    return out.withColumns({"p_low": F.col("__p.low"), "p_toxic": F.col("__p.toxic"), "kept": ~bad}).drop("__p")
