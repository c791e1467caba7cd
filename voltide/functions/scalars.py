"""Column helpers and the tail probabilities that Spark does not have."""

from __future__ import annotations

import math
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ratio(a: Column | str, b: Column | str) -> Column:
    """``a / b`` in doubles, null when ``b`` is 0 or null."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.try_divide(a.cast("double"), b.cast("double"))


def flag(condition: Column) -> Column:
    """0/1 with an unknown condition counted as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def no_nan(value: Column) -> Column:
    """Null instead of NaN and of the two infinities."""
    bad = F.isnan(value) | (F.abs(value) == F.lit(float("inf")))
    return F.when(~bad, value)


def hash_draw(*parts: Column | str | int) -> Column:
    """Portable 32-bit draw: first 8 hex digits of the md5 of the parts."""
    columns = [F.col(p) if isinstance(p, str) else (p if isinstance(p, Column) else F.lit(p)) for p in parts]
    text = F.concat_ws(",", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def hash_uniform(*parts: Column | str | int) -> Column:
    """Portable uniform number in [0, 1)."""
    return hash_draw(*parts) / F.lit(4294967296.0)


@F.pandas_udf(T.DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    """Two-sided p-value of a standard normal statistic (finished rows only)."""
    return z.map(lambda v: None if pd.isna(v) else math.erfc(abs(v) / math.sqrt(2.0))).astype("float64")


# Coefficients of P. J. Acklam's rational approximation of the
# normal quantile (relative error below 1.2e-9).
QUANTILE_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02, 1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
QUANTILE_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02, 6.680131188771972e01, -1.328068155288572e01, 1.0)
QUANTILE_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00, -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
QUANTILE_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00, 3.754408661907416e00, 1.0)
QUANTILE_TAIL = 0.02425


def _polynomial(x: Column, coefficients: Sequence[float]) -> Column:
    out: Column = F.lit(coefficients[0])
    for c in coefficients[1:]:
        out = out * x + F.lit(c)
    return out


def normal_quantile(p: Column | str) -> Column:
    """Quantile of the standard normal; null outside (0, 1)."""
    p = (F.col(p) if isinstance(p, str) else p).cast("double")
    near = F.least(p, F.lit(1.0) - p)
    q = F.sqrt(F.lit(-2.0) * F.ln(near))
    tail = _polynomial(q, QUANTILE_C) / _polynomial(q, QUANTILE_D)
    m = p - F.lit(0.5)
    middle = m * _polynomial(m * m, QUANTILE_A) / _polynomial(m * m, QUANTILE_B)
    value = F.when(near >= QUANTILE_TAIL, middle).when(p < 0.5, tail).otherwise(-tail)
    return F.when((p > 0) & (p < 1), value)


def chi2_tail_even(stat: Column, df: int) -> Column:
    """Upper tail of chi-square with an even number of degrees of freedom."""
    if df % 2:
        raise ValueError("closed form needs an even number of degrees of freedom")
    half = stat / F.lit(2.0)
    term: Column = F.lit(1.0)
    total: Column = F.lit(1.0)
    for i in range(1, df // 2):
        term = F.pow(half, F.lit(float(i))) / F.lit(float(math.factorial(i)))
        total = total + term
    return F.least(F.lit(1.0), F.exp(-half) * total)


@F.pandas_udf(T.DoubleType())
def chi2_tail(stat: pd.Series, dof: pd.Series) -> pd.Series:
    """Upper tail of chi-square for any whole number of degrees of freedom
    (finished rows only)."""

    def tail(x: float, k: float) -> float | None:
        if pd.isna(x) or pd.isna(k) or k < 1:
            return None
        half, k = max(x, 0.0) / 2.0, int(k)
        if k % 2 == 0:
            return min(1.0, math.exp(-half) * sum(half**i / math.factorial(i) for i in range(k // 2)))
        odd = sum(half ** (i - 0.5) / math.gamma(i + 0.5) for i in range(1, (k - 1) // 2 + 1))
        return min(1.0, math.erfc(math.sqrt(half)) + math.exp(-half) * odd)

    return pd.Series([tail(x, k) for x, k in zip(stat, dof)], dtype="float64")


def rounded(columns: Sequence[str], digits: int = 8) -> list[Column]:
    return [F.round(F.col(c), digits).alias(c) for c in columns]
