"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

METRICS = ("euclidean", "manhattan", "chebyshev", "minkowski", "cosine")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def sentinel_to_null(c, sentinel=0) -> Column:
    """PF-04: the sentinel becomes a real NULL (never NaN)."""
    col = _c(c)
    return F.when(col == F.lit(sentinel), F.lit(None)).otherwise(col)


def is_sentinel(c, sentinel=0) -> Column:
    """PF-05: rows to fill."""
    return _c(c) == F.lit(sentinel)


def not_sentinel(c, sentinel=0) -> Column:
    """PF-05: rows with evidence (NULL is not evidence)."""
    return _c(c) != F.lit(sentinel)


def safe_div(num, den) -> Column:
    """num / den, 0 when the denominator is 0 or NULL (``zero_division=0``)."""
    den = _c(den)
    return F.when(den.isNull() | (den == 0), F.lit(0.0)).otherwise(_c(num).cast("double") / den)


def hash_order(seed: int | str, keys: Sequence[str]) -> Column:
    """Seeded, partition-independent row order: md5 of ``seed|key...`` (hex)."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def _sum(terms: list[Column]) -> Column:
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def _sql_term(x) -> str | None:
    """SQL text for a column name or a float literal; None for other Columns."""
    if isinstance(x, str):
        return "`" + x.replace("`", "``") + "`"
    if isinstance(x, (int, float)) and not isinstance(x, bool):
        return f"({float(x)!r}D)"
    return None


def distance_sql(a: Sequence, b: Sequence, metric: str = "euclidean", p: float = 2.0) -> str:
    """SQL text of the distance between two lists of column names / float literals."""
    A = [_sql_term(x) for x in a]
    B = [_sql_term(y) for y in b]
    if any(t is None for t in A + B):
        raise TypeError("distance_sql needs column names or numbers")
    if metric == "euclidean":
        return "sqrt(" + " + ".join(f"({x} - {y}) * ({x} - {y})" for x, y in zip(A, B)) + ")"
    if metric == "manhattan":
        return " + ".join(f"abs({x} - {y})" for x, y in zip(A, B))
    if metric == "chebyshev":
        terms = [f"abs({x} - {y})" for x, y in zip(A, B)]
        return terms[0] if len(terms) == 1 else "greatest(" + ", ".join(terms) + ")"
    if metric == "minkowski":
        if p < 1:
            raise ValueError("minkowski needs p >= 1")
        return ("pow(" + " + ".join(f"pow(abs({x} - {y}), {float(p)!r}D)" for x, y in zip(A, B))
                + f", {1.0 / p!r}D)")
    if metric == "cosine":
        dot = " + ".join(f"{x} * {y}" for x, y in zip(A, B))
        na = "sqrt(" + " + ".join(f"{x} * {x}" for x in A) + ")"
        nb = "sqrt(" + " + ".join(f"{y} * {y}" for y in B) + ")"
        return f"(1.0D - CASE WHEN ({na}) * ({nb}) = 0 THEN 0.0D ELSE ({dot}) / (({na}) * ({nb})) END)"
    raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")


def distance(a: Sequence, b: Sequence, metric: str = "euclidean", p: float = 2.0) -> Column:
    """NN-02: distance between two equally long lists of numeric columns.

    Terms are summed left to right in feature order, so the same SQL written
    by hand gives the same doubles.  Lists of column names / numbers are
    compiled from SQL text in one call (wide expressions stay cheap to build).
    """
    if len(a) != len(b) or not a:
        raise ValueError("distance needs two non-empty feature lists of equal length")
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; expected one of {METRICS}")
    if all(_sql_term(x) is not None for x in list(a) + list(b)):
        return F.expr(distance_sql(a, b, metric, p))
    a = [_c(x) for x in a]
    b = [_c(x) for x in b]
    if metric == "euclidean":
        return F.sqrt(_sum([(x - y) * (x - y) for x, y in zip(a, b)]))
    if metric == "manhattan":
        return _sum([F.abs(x - y) for x, y in zip(a, b)])
    if metric == "chebyshev":
        terms = [F.abs(x - y) for x, y in zip(a, b)]
        return terms[0] if len(terms) == 1 else F.greatest(*terms)
    if metric == "minkowski":
        if p < 1:
            raise ValueError("minkowski needs p >= 1")
        return F.pow(_sum([F.pow(F.abs(x - y), F.lit(float(p))) for x, y in zip(a, b)]), F.lit(1.0 / p))
    dot = _sum([x * y for x, y in zip(a, b)])
    na = F.sqrt(_sum([x * x for x in a]))
    nb = F.sqrt(_sum([y * y for y in b]))
    return F.lit(1.0) - safe_div(dot, na * nb)
