"""Pearson correlation of column pairs and the full matrix."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The variables of the correlation report, in its order.
CORRELATED = [
    "vendor_id",
    "passenger_count",
    "pickup_longitude",
    "pickup_latitude",
    "dropoff_longitude",
    "dropoff_latitude",
    "store_and_fwd_flag_int",
]


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """(corr) of two columns over the rows where both are present; null if one is constant.

    F.corr raises under ANSI when a column is constant; dividing the moments does not.
    """
    both = df.selectExpr(f"cast(`{a}` as double) as a", f"cast(`{b}` as double) as b").dropna()
    spread = F.stddev_pop("a") * F.stddev_pop("b")
    return both.agg(F.try_divide(F.covar_pop("a", "b"), spread).alias("corr"))


def correlation_pairs(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """(row, col, corr) for all ordered pairs; null where a column is constant.

    A pair leaves out the rows where one of its two columns is null, like pearson.
    """
    entries = ", ".join(
        f"struct('{a}' as row, '{b}' as col, r{min(i, j)}_{max(i, j)} as corr)"
        for i, a in enumerate(columns)
        for j, b in enumerate(columns)
    )
    return _coefficients(df, columns).selectExpr(f"inline(array({entries}))")


def correlation_matrix(df: DataFrame, columns: Sequence[str] = CORRELATED) -> DataFrame:
    """One line per variable: position, row, and one column per variable."""
    lines = []
    for i, a in enumerate(columns):
        cells = ", ".join(f"r{min(i, j)}_{max(i, j)} as `{b}`" for j, b in enumerate(columns))
        lines.append(f"struct({i + 1} as position, '{a}' as row, {cells})")
    return _coefficients(df, columns).selectExpr(f"inline(array({', '.join(lines)}))")


def _coefficients(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with r<i>_<j>, the correlation of columns i and j, for i <= j, from one pass.

    Every unordered pair has its own co-moment and deviations over the rows where both of its
    columns are present, as in pearson.
    """
    values = df.selectExpr(*[f"cast(`{c}` as double) as x{i}" for i, c in enumerate(columns)])
    return values.selectExpr(*coefficient_measures(len(columns)))


def coefficient_measures(n: int) -> list[str]:
    """SQL aggregates r<i>_<j> over columns x0, x1, ... of doubles, for all i <= j."""

    def coefficient(i: int, j: int) -> str:
        if i == j:
            return f"case when min(x{i}) < max(x{i}) then 1D end as r{i}_{i}"
        spread = " * ".join(
            f"stddev_pop(case when x{b} is not null then x{a} end)" for a, b in ((i, j), (j, i))
        )
        return f"try_divide(covar_pop(x{i}, x{j}), {spread}) as r{i}_{j}"

    return [coefficient(i, j) for i, j in combinations_with_replacement(range(n), 2)]
