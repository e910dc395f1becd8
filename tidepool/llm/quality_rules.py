"""Quality rules: text statistics, base limits and robust outlier rejection.

Statistics of a text become a vector of transformed ratios. For every group of
language and source a minimum-covariance-determinant estimate is made by
concentration steps: from a robust start (mid quantile and quartile spread of
each coordinate) the distances of all vectors are taken, the `support` share
of nearest ones gives the next mean and covariance, and so on. The covariance of
that share is made consistent with a normal law; a vector whose squared
Mahalanobis distance from its group's estimate is beyond the chi-square
`quantile` for as many dimensions is rejected.

Everything is DataFrame expressions. A step is two groupings with map-side
combining: a histogram of the distances per group (bins of equal ratio, from
which the share's bound is read) and the moments of the vectors within it.
The estimates, one row per group, are joined back to the vectors; Spark
chooses a broadcast by size, or a shuffle join that it can split. Vectors are
a small table in the shared folder; texts are read once.

Groups of fewer than `min_group` vectors take their language's estimate, and
languages of as few that of all rows, which are made alongside. Each coordinate has a least standard deviation, whose square
is added to its variance: constant coordinates neither break the inverse nor
reject what is no more than usual variety.

Defined results: a null text has no words and fails the base rules, as does
any text below `min_words`; a null language or source is a group of its own;
null ids are carried; repeated rows give repeated results; an empty table
gives no rows; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidepool.llm.store import Scratch

SPACE = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "[#*$%&|<>]"

#: The coordinates: expression over the statistics and least standard deviation.
#: The floors are what one measurement of a short text (50 words, ten lines) may
#: be off: the mean of 50 word lengths, one symbol, one line, one phrase.
COORDINATES = {
    "word_length": ("ln(word_chars / n_words)", 0.08),
    "symbols": ("ln(1 + n_symbols / n_words)", 0.02),
    "dup_lines": ("n_dup_lines / n_lines", 0.1),
    "repeats": ("n_repeat_words / n_words", 0.1),
}
FLOORS = [floor for _, floor in COORDINATES.values()]
DIMS = len(COORDINATES)
STATISTICS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def _covered(starts: Column) -> Column:
    """Words in 3-word windows that begin at the sorted positions `starts`."""
    steps = F.transform(F.slice(starts, 1, F.size(starts) - 1),
                        lambda x, i: F.least(F.lit(3), F.element_at(starts, i + 2) - x))
    return F.aggregate(steps, F.lit(3), lambda a, x: a + x)


def statistics(docs: DataFrame, keep: dict[str, Column], text_col: str = "text") -> DataFrame:
    """keep, n_lines and the statistics of each row's whole text."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(*[c.alias(k) for k, c in keep.items()], text.alias("text"))
    words = base.select(*keep, "text", F.filter(F.split("text", SPACE_RUN), lambda w: w != "").alias("w"))
    words = words.withColumn("n_words", F.size("w"))
    # 64-bit hashes of the 3-word windows; sorted with their positions, equal ones meet.
    n = F.col("n_words")
    windows = F.when(n >= 3, F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.xxhash64(
        F.element_at("w", i), F.element_at("w", i + 1), F.element_at("w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    lines = F.filter(F.split("text", "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "")
    out = words.select(
        *keep, "n_words", F.size(F.split("text", "\n", -1)).alias("n_lines"),
        F.length(F.array_join("w", "")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).alias("n_symbols"),
        lines.alias("lines"), windows.alias("h"))
    out = out.withColumn("n_dup_lines", F.size("lines") - F.size(F.array_distinct("lines"))).drop("lines")
    # Only texts with a window found again need the sorting.
    pairs = F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    out = out.withColumn("p", F.when(F.size(F.array_distinct("h")) < F.size("h"), pairs)).drop("h")
    again = F.filter("p", lambda x, i: (F.try_element_at("p", i + 2)["h"] == x["h"])
                     | F.when(i > 0, F.try_element_at("p", i)["h"] == x["h"]))
    out = out.withColumn("s", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("p")
    out = out.withColumn("n_repeat_words", F.when(F.col("s").isNull(), 0).otherwise(_covered(F.col("s")))).drop("s")
    return out.select(*keep, "n_lines", *[F.col(s).cast("bigint").alias(s) for s in STATISTICS])


def chi_square(x: float, dims: int) -> float:
    """Distribution function, for an even number of dimensions."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(dims // 2))


def chi_square_quantile(p: float, dims: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(100):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square(mid, dims) < p else (low, mid)
    return high


def consistency(support: float, dims: int) -> float:
    """What the covariance of a normal law's nearest `support` share lacks."""
    return support / chi_square(chi_square_quantile(support, dims), dims + 2) if support < 1 else 1.0


def _x(i: int) -> Column:
    return F.col(f"x{i}")


def _factored(fit: DataFrame, dims: int) -> DataFrame:
    """The Cholesky factor l{i}{j} in place of the covariance, per group."""
    low = lambda i, j: F.col(f"l{i}{j}")
    for i in range(dims):
        for j in range(i + 1):
            inner = F.col(f"c{j}{i}")
            for k in range(j):
                inner = inner - low(i, k) * low(j, k)
            # Rounding may take an almost dependent coordinate's rest below zero.
            fit = fit.withColumn(f"l{i}{j}", inner / low(j, j) if j < i else F.sqrt(F.greatest(inner, F.lit(1e-9))))
    return fit.drop(*[f"c{j}{i}" for i in range(dims) for j in range(i + 1)])


def _distance(x: list[Column], m: list[Column], low: dict[tuple[int, int], Column]) -> Column:
    """Squared Mahalanobis distance by forward substitution."""
    solved: list[Column] = []
    for i in range(len(x)):
        rest = x[i] - m[i]
        for j in range(i):
            rest = rest - low[i, j] * solved[j]
        solved.append(rest / low[i, i])
    return sum((y * y for y in solved[1:]), solved[0] * solved[0])


def _fit_columns(dims: int) -> list[str]:
    return [f"m{i}" for i in range(dims)] + [f"l{i}{j}" for i in range(dims) for j in range(i + 1)]


def _fit_distance(dims: int, value=F.col) -> Column:
    return _distance([_x(i) for i in range(dims)], [value(f"m{i}") for i in range(dims)],
                     {(i, j): value(f"l{i}{j}") for i in range(dims) for j in range(i + 1)})


def _moments(floors: list[float], factor: float) -> list[Column]:
    dims, cov = len(floors), []
    mean = [F.avg(_x(i)).alias(f"m{i}") for i in range(dims)]
    for i in range(dims):
        for j in range(i, dims):
            c = F.covar_pop(_x(i), _x(j)) * factor
            cov.append((c + F.lit(floors[i] ** 2) if i == j else c).alias(f"c{i}{j}"))
    return mean + cov


def estimates(scratch: Scratch, vectors: DataFrame, steps: int = 6, support: float = 0.75,
              min_group: int = 20, floors: list[float] = FLOORS, factor: float = 1.0,
              levels: tuple[str, ...] = ("g",)) -> DataFrame:
    """(g, mean, covariance) per group of vectors (levels, x0..), and for the
    group null, all rows: the minimum-covariance-determinant estimates,
    covariances times `factor`. Each of `levels` names a group of a vector."""
    dims = len(floors)
    # Each vector counts for its groups and for the whole.
    both = vectors.select(F.explode(F.array(*levels, F.lit(None).cast("string"))).alias("g"), *[_x(i) for i in range(dims)])
    size = both.where("g IS NOT NULL").groupBy("g").count().where(F.col("count") >= min_group).select("g")
    both = scratch.write(both.join(size.union(vectors.sparkSession.sql("SELECT CAST(NULL AS STRING) AS g"))
                                   .withColumnRenamed("g", "kept"), F.col("g").eqNullSafe(F.col("kept")), "left_semi"), "both")
    quartiles = [F.percentile_approx(_x(i), F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 1000).alias(f"q{i}") for i in range(dims)]
    start = both.groupBy("g").agg(*quartiles).select(
        "g", *[F.col(f"q{i}")[1].alias(f"m{i}") for i in range(dims)],
        *[(F.pow((F.col(f"q{i}")[2] - F.col(f"q{i}")[0]) / 1.349, 2) + floors[i] ** 2 if i == j else F.lit(0.0)).alias(f"c{i}{j}")
          for i in range(dims) for j in range(i, dims)])
    now = scratch.write(_factored(start, dims), "start")
    for _ in range(steps):
        fit = now.withColumnRenamed("g", "k")
        far = scratch.write(both.join(fit, F.col("g").eqNullSafe(F.col("k"))).select(
            "g", *[_x(i) for i in range(dims)],
            # bins of equal ratio, 64 to a doubling: per group they are few, whatever its size
            F.floor(F.log2(F.greatest(_fit_distance(dims), F.lit(1e-6))) * 64).cast("int").alias("bin")), "distances")
        by_bin = Window.partitionBy("g").orderBy("bin")
        bound = (far.groupBy("g", "bin").agg(F.count("*").alias("n"))
                 .select("g", "bin", F.sum("n").over(by_bin).alias("upto"),
                         F.sum("n").over(Window.partitionBy("g")).alias("all"))
                 .where(F.col("upto") >= F.col("all") * support)
                 .groupBy(F.col("g").alias("k")).agg(F.min("bin").alias("most")))
        bound = scratch.write(bound, "bounds")
        near = far.join(bound, F.col("g").eqNullSafe(F.col("k"))).where("bin <= most")
        new = scratch.write(_factored(near.groupBy("g").agg(*_moments(floors, factor)), dims), "step")
        scratch.drop(now, far, bound)
        now = new
    scratch.drop(both)
    return now


def judge(docs: DataFrame, min_words: int = 50, max_repeat_percent: int = 50, quantile: float = 0.99,
          steps: int = 6, support: float = 0.75, min_group: int = 20,
          id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """id, the statistics, base_failed, distance (squared; null if the base
    rules failed) and kept, per row.

    `quantile` is the share of a normal law's texts that is kept; as ratios have
    longer tails, somewhat fewer are.
    """
    scratch = Scratch(docs.sparkSession, "quality")
    group = F.to_json(F.struct(F.col(lang_col).alias("l"), F.col(source_col).alias("s")))
    language = F.concat(F.lit("language "), F.to_json(F.struct(F.col(lang_col).alias("l"))))
    stats = statistics(docs, {"id": F.col(id_col), "g": group, "l": language}, text_col)
    failed = (F.col("n_words") < min_words) | (F.col("n_repeat_words") * 100 > F.col("n_words") * max_repeat_percent)
    stats = scratch.write(stats.withColumn("base_failed", failed), "statistics")
    # A share below zero words is never taken: those rows failed the base rules.
    vectors = stats.where("NOT base_failed").select("g", "l", *[F.expr(e).alias(f"x{i}") for i, (e, _) in enumerate(COORDINATES.values())])
    fit = estimates(scratch, vectors, steps, support, min_group, factor=consistency(support, DIMS), levels=("g", "l"))
    names = _fit_columns(DIMS)
    whole = fit.where("g IS NULL").first()  # one row

    def value(name: str) -> Column:
        """A group without an estimate of its own takes its language's, or else that of all rows."""
        known = [F.col(name), F.col(f"l_{name}")]
        return F.coalesce(*known, F.lit(float(whole[name])) if whole else F.lit(None)).alias(name)

    some = fit.where("g IS NOT NULL")
    of_language = some.select(F.col("g").alias("l"), *[F.col(n).alias(f"l_{n}") for n in names])
    # One row per group, so that the texts are joined once, by their group.
    own = (stats.select("g", "l").distinct().join(some.select("g", *names), "g", "left")
           .join(of_language, "l", "left").select(F.col("g").alias("k"), *[value(n) for n in names]))
    own = scratch.write(own, "resolved")
    far = _fit_distance(DIMS)
    out = stats.withColumns({f"x{i}": F.when(~F.col("base_failed"), F.expr(e)) for i, (e, _) in enumerate(COORDINATES.values())})
    return (out.join(own, F.col("g") == F.col("k"), "left").withColumn("distance", far)
            .select(F.col("id").alias(id_col), *STATISTICS, "base_failed", "distance",
                    (~F.col("base_failed") & (F.col("distance") <= chi_square_quantile(quantile, DIMS))).alias("kept")))
