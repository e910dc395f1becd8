"""Column expressions used by the jobs (P-series).

All are built-in Spark SQL expressions, so they stay inside whole-stage
code generation; none needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed patterns (Java ``String.matches`` semantics: whole-string match).
# \A and \z, as $ also matches before a line end that closes the text.
PRINTABLE_ASCII = r"\A[\x20-\x7E]*\z"
DIGITS_ONLY = r"\A\d+\z"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def printable_ascii(c) -> Column:
    """Every character in 0x20..0x7E."""
    return _c(c).rlike(PRINTABLE_ASCII)


def digits_only(c) -> Column:
    """One or more decimal digits and nothing else."""
    return _c(c).rlike(DIGITS_ONLY)


def non_empty(c) -> Column:
    """P7."""
    return _c(c).isNotNull() & (_c(c) != F.lit(""))


def all_present(cols) -> Column:
    """True when every named column is not NULL (a key that failed to type
    is NULL)."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & _c(c).isNotNull()
    return cond


def default(c, value) -> Column:
    """NULL -> default."""
    return F.coalesce(_c(c), F.lit(value))


def prefixed(prefix: str, c) -> Column:
    """``prefix || string(c)``."""
    return F.concat(F.lit(prefix), _c(c).cast("string"))


def safe_ratio(num, den) -> Column:
    """Num / den as double, NULL when den is 0."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def days_before(ts, days: int) -> Column:
    """Timestamp minus N whole days (works on TIMESTAMP_NTZ)."""
    return _c(ts) - F.make_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(int(days)))


def parse_timestamp(c, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """P20: text -> TIMESTAMP_NTZ, NULL when unparsable."""
    return F.try_to_timestamp(_c(c), F.lit(fmt)).cast("timestamp_ntz")


def json_int_field(c, key: str) -> Column:
    """Top-level field ``key`` of a JSON object text cast to BIGINT (NULL
    when absent or not castable), exactly as ``get_json_object`` + cast.

    Fast path: a text that is exactly a one-field object ``{"key": <int>}``
    (the common shape of event properties) is matched by one anchored
    regular expression, for which the result is provably the same as a JSON
    parse; any other text goes through ``get_json_object``. On event logs
    this halves the parsing cost of the scan stage.
    """
    import re
    k = re.escape(key)
    ws = "[ \\t\\n\\r]*"  # JSON whitespace only
    number = "(-?(?:0|[1-9][0-9]*))"  # JSON integer: no leading zeros
    fast = F.regexp_extract(_c(c), f'^\\{{{ws}"{k}"{ws}:{ws}{number}{ws}\\}}$', 1)
    slow = F.get_json_object(_c(c), f"$.{key}")
    return F.when(fast != F.lit(""), fast).otherwise(slow).try_cast("bigint")


def squared_gap(x, a) -> Column:
    d = _c(x).cast("double") - _c(a).cast("double")
    return d * d


def euclidean(x, y, a, b) -> Column:
    """sqrt((x-a)^2 + (y-b)^2) with explicit products (no pow)."""
    return F.sqrt(squared_gap(x, a) + squared_gap(y, b))


def _num(v: float) -> str:
    """Exact SQL text for a double (shortest round-trip repr, parsed as DOUBLE)."""
    return f"CAST('{float(v)!r}' AS DOUBLE)"


def _distances(x: str, y: str, centres: Sequence[tuple[int, float, float]]) -> list[tuple[int, str, str, str]]:
    """(id, x, y, distance) of each centre as SQL text, by id. Raises on an empty list."""
    if not centres:
        raise ValueError("nearest_centre needs at least one centre")
    out = []
    for cid, cx, cy in sorted(centres, key=lambda t: t[0]):
        a, b = _num(cx), _num(cy)
        out.append((int(cid), a, b, f"sqrt((`{x}` - {a}) * (`{x}` - {a}) + (`{y}` - {b}) * (`{y}` - {b}))"))
    return out


def _least(parts: list[str]) -> str:
    return f"least({', '.join(parts)})" if len(parts) > 1 else parts[0]


def nearest_centre(x: str, y: str, centres: Sequence[tuple[int, float, float]]) -> Column:
    """The nearest centre as a struct (dist, id, x, y), lowest id on ties.

    ``centres`` is the (driver-known) centroid list; ``least`` over (dist, id,
    ..) structs takes the least distance and then the least id. It is compiled,
    whatever the number of centres; for thousands of them use
    ``tidepool.operators.grid``. Emitted as one SQL text: one parse instead of
    many client round trips per k-means step. Raises on an empty list.
    """
    return F.expr(_least([f"named_struct('dist', {d}, 'id', {cid}, 'x', {a}, 'y', {b})"
                          for cid, a, b, d in _distances(x, y, centres)]))


def nearest_centre_id(x: str, y: str, centres: Sequence[tuple[int, float, float]]) -> Column:
    """Id of the nearest centre, lowest id on ties."""
    return F.expr(_least([f"named_struct('dist', {d}, 'id', {cid})" for cid, _, _, d in _distances(x, y, centres)]))["id"]


def distance_to(id_col: str, x: str, y: str, centres: Sequence[tuple[int, float, float]]) -> Column:
    """Distance to the centre named by ``id_col``."""
    cases = " ".join(f"WHEN {cid} THEN {d}" for cid, _, _, d in _distances(x, y, centres))
    return F.expr(f"CASE `{id_col}` {cases} END")


def distance_to_others(id_col: str, x: str, y: str, centres: Sequence[tuple[int, float, float]]) -> Column:
    """Least distance to a centre other than ``id_col``; infinite if there is none."""
    far = "CAST('Infinity' AS DOUBLE)"
    return F.expr(_least([f"if(`{id_col}` = {cid}, {far}, {d})" for cid, _, _, d in _distances(x, y, centres)]))


def by_id(id_col: str, values: dict[int, float]) -> Column:
    """The value that belongs to ``id_col``, as a double."""
    cases = " ".join(f"WHEN {int(k)} THEN {_num(v)}" for k, v in sorted(values.items()))
    return F.expr(f"CASE `{id_col}` {cases} END")
