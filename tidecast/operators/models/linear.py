"""Per-series least squares from Spark-aggregated Gram sums, solved in the JVM.

``gram_sums`` is one partial aggregate per series (``Σ x_i x_j``, ``Σ x_i y``, ``Σ y²``,
``n``), so a series of any length is summed across many tasks; ``solve`` turns each
series' small ``k×k`` system into coefficients by a Cholesky factorisation written with
array functions, one row per series (never the points), no Python worker.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_VECTOR = "array<double>"
_MATRIX = "array<array<double>>"


def pairs(names: Sequence[str]) -> list[tuple[str, str]]:
    out = [(a, b) for i, a in enumerate(names) for b in names[i:]]
    return out + [(a, "y") for a in names] + [("y", "y")]


def gram_sums(rows: DataFrame, key: str, names: Sequence[str], target: str = "y") -> DataFrame:
    """``rows`` holds ``key``, the feature columns ``names`` and ``target``."""
    x = rows.select(key, F.col(target).alias("y"), *names)
    aggs = [F.count(F.lit(1)).alias("n")]
    aggs += [F.sum(F.col(a) * F.col(b)).alias(f"g__{a}__{b}") for a, b in pairs(names)]
    return x.groupBy(key).agg(*aggs)


# ---------------------------------------------------------------- arrays

def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it."""
    return F.transform(F.array(value), body)[0]


def dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)


def _empty(kind: str) -> Column:
    return F.array().cast(kind)


def factor(matrix: Column) -> Column:
    """Rows of the lower triangle ``L`` with ``L·Lᵀ = matrix`` (symmetric, positive definite).

    Row by row: entry ``(i, j)`` needs the row so far and row ``j``, both already there.
    A pivot that rounding makes negative is floored, so a singular system gives a large
    coefficient instead of a failed job; callers add a ridge.
    """
    def row(done: Column, i: Column) -> Column:
        def entry(r: Column, j: Column) -> Column:
            other = F.when(j < i, F.slice(F.coalesce(F.get(done, j), r), 1, j)).otherwise(r)
            return let(F.get(F.get(matrix, i), j) - dot(r, other), lambda s: F.concat(r, F.array(
                F.when(j < i, s / F.get(F.get(done, j), j)).otherwise(F.sqrt(F.greatest(s, F.lit(1e-300)))))))

        return F.aggregate(F.sequence(F.lit(0), i), _empty(_VECTOR), entry)

    return F.aggregate(F.sequence(F.lit(0), F.size(matrix) - 1), _empty(_MATRIX), lambda done, i: F.concat(done, F.array(row(done, i))))


def substitute(lower: Column, right: Column) -> Column:
    """``x`` with ``L·Lᵀ·x = right``: once down, once up."""
    def down(z: Column, i: Column) -> Column:
        return let(F.get(lower, i), lambda r: F.concat(z, F.array((F.get(right, i) - dot(z, F.slice(r, 1, i))) / F.get(r, i))))

    def up(z: Column):
        k = F.size(lower)

        def step(x: Column, i: Column) -> Column:
            below = F.transform(F.slice(lower, i + 2, k - 1 - i), lambda r: F.get(r, i))
            return F.concat(F.array((F.get(z, i) - dot(x, below)) / F.get(F.get(lower, i), i)), x)

        return F.aggregate(F.sequence(k - 1, F.lit(0), F.lit(-1)), _empty(_VECTOR), step)

    return let(F.aggregate(F.sequence(F.lit(0), F.size(lower) - 1), _empty(_VECTOR), down), up)


def solved(matrix: Column, right: Column) -> Column:
    return let(factor(matrix), lambda lower: substitute(lower, right))


def with_penalties(matrix: Column, penalties: Sequence[float]) -> Column:
    """The penalties added on the diagonal."""
    pen = F.array(*[F.lit(float(p)) for p in penalties])
    return F.transform(matrix, lambda r, i: F.transform(r, lambda v, j: F.when(i == j, v + F.get(pen, i)).otherwise(v)))


def residual_sum(matrix: Column, right: Column, yy: Column, beta: Column) -> Column:
    """``Σ (y − x·beta)²`` from the sums alone, not below 0."""
    quadratic = dot(beta, F.transform(matrix, lambda r: dot(r, beta)))
    return F.greatest(yy - 2 * dot(beta, right) + quadratic, F.lit(0.0))


# ---------------------------------------------------------------- per series

def gram_arrays(gram: DataFrame, names: Sequence[str]) -> DataFrame:
    """The sums of ``gram`` as ``xx`` (matrix), ``xy`` (vector) and ``yy`` besides its columns."""
    names = list(names)
    at = {n: i for i, n in enumerate(names)}

    def entry(a: str, b: str) -> Column:
        a, b = sorted((a, b), key=at.get)
        return F.col(f"g__{a}__{b}").cast("double")

    return gram.withColumns({"xx": F.array(*[F.array(*[entry(a, b) for b in names]) for a in names]),
                             "xy": F.array(*[F.col(f"g__{a}__y").cast("double") for a in names]),
                             "yy": F.col("g__y__y").cast("double")})


def solve(gram: DataFrame, key: str, names: Sequence[str], penalties: Sequence[float],
          scale: str | None = None, dof_correction: bool = True) -> DataFrame:
    """``(key, beta ARRAY<DOUBLE>, sigma DOUBLE)``: ridge solution and residual RMS.

    scale: optional Gram column holding a per-series scale ``s``; the system is solved
    for ``y/s`` (so the ridge penalty means the same for every series) and the
    coefficients and ``sigma`` are returned in the original units.
    """
    s = F.col(scale).cast("double") if scale else F.lit(1.0)
    sums = gram_arrays(gram, names).withColumn("s", F.when((s > 0) & (s < float("inf")), s).otherwise(1.0))
    sums = sums.select(key, "n", "xx", "s", F.transform("xy", lambda v: v / F.col("s")).alias("xy"), (F.col("yy") / (F.col("s") * F.col("s"))).alias("yy"))
    k = len(names)
    n = F.greatest(F.col("n").cast("double"), F.lit(1.0))
    dof = F.greatest(n - k, F.lit(1.0)) if dof_correction else n
    fitted = sums.withColumn("b", solved(with_penalties(F.col("xx"), penalties), F.col("xy")))
    return fitted.select(key, F.transform("b", lambda v: v * F.col("s")).alias("beta"),
                         (F.sqrt(residual_sum(F.col("xx"), F.col("xy"), F.col("yy"), F.col("b")) / dof) * F.col("s")).alias("sigma"))
