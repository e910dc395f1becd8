"""License scan: MinHash bands over text windows, verified by containment.

Texts are lower-cased words (runs of letters and digits) and their hashed
five-word shingles. Templates are a parameter, a list that the driver holds;
their band keys and shingles are literals of the plan. Scanning is map-only
and made of column expressions.

A long template (16 shingles or more) is cut into windows of 16 shingles, a
step of 4 apart; a text into windows of two blocks of 8. Whatever its place, a
copy has text windows that lie within 2 shingles of a template's, so they share
14 of 18 shingles; eight bands of one row then collide with probability
1 - (1 - 14/18)^8 = 0.99999, and still with 0.998 where a fifth is changed
(Jaccard 0.55). Windows for short templates are single shingles: all of the
eight shingles that are least under some band's order must be lost for a
template to be missed, and none is if it is copied whole.

Retrieved templates are verified: of a template's distinct shingles, at least
`containment` must be in the text around the window, over the template's own
length to either side.

Defined results: a null text, an empty one, or one below five words has no
license; matches are sorted, without repeats; null ids are carried; repeated
rows give repeated results; an empty table gives no rows; templates below five
words, which have no shingle, match nothing; further columns are ignored.
"""

from __future__ import annotations

from functools import partial, reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Wordings of common license statements.
TEMPLATES = {
    "Apache-2.0": ["Licensed under the Apache License, Version 2.0."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
    "GPL-3.0": ["This work is licensed under the GNU General Public License, version 3."],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        "documentation files, to deal in the software without restriction, including without limitation the rights to "
        "use, copy, modify, merge, publish, distribute, sublicense, and sell copies of the software."],
    "BSD": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
        "the following conditions are met"],
}

SHINGLE = 5
BLOCK, WINDOW, STEP = 8, 16, 4
#: Bands: each orders shingles by the hash's bits flipped by its constant.
BANDS = [(2 * i + 1) * 0x9E3779B97F4A7C15 % (1 << 63) for i in range(8)]
NOT_WORD = "[^\\p{L}\\p{N}]+"


def _with_shingles(df: DataFrame, text_col: str, keep: dict[str, Column]) -> DataFrame:
    """keep, and sh: the hashed five-word shingles of the text, in order."""
    words = F.filter(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), NOT_WORD), lambda x: x != "")
    sh = F.when(F.size("w") >= SHINGLE, F.transform(
        F.sequence(F.lit(1), F.size("w") - (SHINGLE - 1)),
        lambda i: F.xxhash64(*[F.element_at("w", i + k) for k in range(SHINGLE)]))).otherwise(F.array().cast("array<bigint>"))
    return df.select(*[c.alias(k) for k, c in keep.items()], words.alias("w")).select(*keep, sh.alias("sh"))


def prepare(spark: SparkSession, templates: dict[str, list[str]]) -> list[dict]:
    """Each wording's name, distinct shingles and band keys per window."""
    wordings = [(name, text) for name, texts in templates.items() for text in texts]
    rows = _with_shingles(spark.createDataFrame(wordings, "name string, text string"), "text", {"name": F.col("name")}).collect()
    out = []
    for r in rows:  # the templates themselves
        if not r.sh:
            continue
        long = len(r.sh) >= WINDOW
        starts = range(0, len(r.sh) - WINDOW + STEP, STEP) if long else [0]
        windows = [r.sh[s:s + WINDOW] for s in starts] if long else [r.sh]
        keys = sorted({(i, min(x ^ c for x in w)) for w in windows for i, c in enumerate(BANDS)})
        out.append({"name": r.name, "long": long, "sh": sorted(set(r.sh)), "reach": len(r.sh),
                    "keys": [[k for j, k in keys if j == i] for i in range(len(BANDS))]})
    return out


def _least(sh: Column, flip: int) -> Column:
    return F.array_min(F.transform(sh, lambda x: x.bitwiseXOR(F.lit(flip))))


def _places(column: str, hit) -> Column:
    """Places j (from 0) of an array column where hit(element, j) holds."""
    return F.filter(F.transform(column, lambda x, j: F.when(hit(x, j), j)), lambda j: j.isNotNull())


def _containment(place: Column, wording: dict) -> Column:
    """Share of the wording's shingles in the text around shingle `place` (from 0)."""
    around = F.slice("sh", F.greatest(F.lit(1), place + 1 - wording["reach"]), F.lit(2 * wording["reach"] + WINDOW))
    own = F.array(*[F.lit(v).cast("bigint") for v in wording["sh"]])
    return F.size(F.array_intersect(around, own)) / F.lit(len(wording["sh"]))


def _where(places: Column, anchors: list[int]) -> Column:
    return F.filter(places, lambda j: F.element_at("sh", j + 1).isin(anchors))


def _best(places: Column, wording: dict) -> Column:
    return F.array_max(F.transform(places, lambda j: _containment(j, wording)))


def scan(docs: DataFrame, templates: dict[str, list[str]] = TEMPLATES, containment: float = 0.8,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, licenses (sorted names), containment (the best, at least the bound,
    else null) and n_windows (windows that retrieved a template), per row."""
    known = prepare(docs.sparkSession, templates)
    base = _with_shingles(docs, text_col, {"id": F.col(id_col)})
    # Minima of the text's blocks of 8 shingles, per band; a window is two blocks.
    base = base.withColumn("blocks", F.transform(
        F.when(F.size("sh") > 0, F.sequence(F.lit(1), F.size("sh"), F.lit(BLOCK))).otherwise(F.array().cast("array<int>")),
        lambda p: F.struct(*[_least(F.slice("sh", p, F.lit(BLOCK)), c).alias(f"b{i}") for i, c in enumerate(BANDS)])))
    # A band's least shingle is its key with the constant's bits flipped back.
    anchors = {n: sorted({key ^ c for keys, c in zip(k["keys"], BANDS) for key in keys})
               for n, k in enumerate(known) if not k["long"]}

    def in_window(wording: dict, block: Column, j: Column) -> Column:
        after = F.try_element_at("blocks", j + 2)
        return reduce(or_, [F.least(block[f"b{i}"], after[f"b{i}"]).isin(keys) for i, keys in enumerate(wording["keys"])])

    columns = {"short": _places("sh", lambda x, j: x.isin(sorted({a for v in anchors.values() for a in v})))}
    for n, k in enumerate(known):
        if k["long"]:
            columns[f"p{n}"] = _places("blocks", partial(in_window, k))
    base = base.withColumns(columns)
    best = {}
    for n, k in enumerate(known):
        places = (F.transform(f"p{n}", lambda j: j * BLOCK) if k["long"] else
                  _where(F.col("short"), anchors[n]))
        best[f"c{n}"] = _best(places, k)
    base = base.select("id", F.size("short").alias("n"), *[F.size(f"p{n}").alias(f"n{n}") for n, k in enumerate(known) if k["long"]],
                       *[c.alias(k) for k, c in best.items()])
    names = F.array(*[F.when(F.col(f"c{n}") >= containment, F.lit(k["name"])) for n, k in enumerate(known)])
    windows = reduce(add, [F.col("n"), *[F.col(f"n{n}") for n, k in enumerate(known) if k["long"]]])
    top = F.array_max(F.array(*[F.col(c) for c in best]))
    return base.select(F.col("id").alias(id_col),
                       F.sort_array(F.array_distinct(F.array_compact(names))).alias("licenses"),
                       F.when(top >= containment, top).alias("containment"), windows.cast("bigint").alias("n_windows"))
