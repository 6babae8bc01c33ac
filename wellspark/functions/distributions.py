"""Normal and Student t distribution functions for aggregated rows.

Spark has no distribution functions, so these are Arrow-batched Pandas UDFs. They are only
applied after a groupBy, to one row per experiment or arm.
"""

from __future__ import annotations

import math
import sys
from statistics import NormalDist

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

# The UDFs travel to the executors as code, so these need not have the package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# From here on the first terms of the series in 1 / df are exact to 1e-12.
SERIES_FROM = 1e5
# Terms after which a continued fraction counts as not converging.
TERMS = 10_000


def z_quantile(p: float) -> float:
    """Standard normal quantile of a plan-time constant such as 1 - alpha/2."""
    return NormalDist().inv_cdf(p)


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function (modified Lentz method)."""
    tiny = 1e-300
    c, d = 1.0, 1.0 - (a + b) * x / (a + 1.0)
    d = 1.0 / (d if abs(d) > tiny else tiny)
    value = d
    for m in range(1, TERMS):
        for term in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + term * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + term / c
            c = c if abs(c) > tiny else tiny
            value *= c * d
        if abs(c * d - 1.0) < 1e-15:
            return value
    raise ArithmeticError(f"no convergence for a={a}, b={b}, x={x}")


def _log_gamma_ratio(a: float) -> float:
    """log(gamma(a + 1/2) / gamma(a)).

    For large ``a`` the difference of two huge logarithms keeps no digits; Stirling's series
    for the ratio does.
    """
    if a < 100.0:
        return math.lgamma(a + 0.5) - math.lgamma(a)
    u = 1.0 / a
    return 0.5 * math.log(a) - u / 8.0 + u**3 / 192.0 - u**5 / 640.0


def _near_normal(t: float, df: float) -> float:
    """The tail by its difference from the normal one; the fraction would lose digits here."""
    if t > 40.0:
        return 0.0
    density = math.exp(-t * t / 2.0) / math.sqrt(2.0 * math.pi)
    first = (t**3 + t) / 2.0
    second = (3.0 * t**7 - 7.0 * t**5 - 5.0 * t**3 - 3.0 * t) / 48.0
    return math.erfc(t / math.sqrt(2.0)) + density * (first + second / df) / df


def t_two_sided(t: float, df: float) -> float:
    """P(|T| > |t|) for Student t with (fractional) df degrees of freedom."""
    a, b = df / 2.0, 0.5
    x, y = df / (df + t * t), t * t / (df + t * t)
    if y == 0.0:
        return 1.0
    if df > SERIES_FROM:
        return _near_normal(abs(t), df)
    # x ** a by way of log1p, because x is next to 1 for large df.
    log_front = _log_gamma_ratio(a) - 0.5 * math.log(math.pi) - a * math.log1p(t * t / df) + b * math.log(y)
    front = math.exp(log_front)
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, y) / b


def t_critical(alpha: float, df: float) -> float:
    """The t with P(|T| > t) = alpha, by bisection on the tail probability."""
    low, high = 0.0, 1.0
    while t_two_sided(high, df) > alpha:
        low, high = high, high * 2.0
    for _ in range(200):
        mid = (low + high) / 2.0
        if mid in (low, high):
            break
        if t_two_sided(mid, df) > alpha:
            low = mid
        else:
            high = mid
    return (low + high) / 2.0


def _missing(*values: float) -> bool:
    return any(v is None or math.isnan(v) for v in values)


@F.pandas_udf(DoubleType())
def normal_two_sided(z: pd.Series) -> pd.Series:
    return z.map(lambda v: None if _missing(v) else math.erfc(abs(v) / math.sqrt(2.0))).astype(float)


@F.pandas_udf(DoubleType())
def normal_cdf(x: pd.Series) -> pd.Series:
    return x.map(lambda v: None if _missing(v) else 0.5 * math.erfc(-v / math.sqrt(2.0))).astype(float)


@F.pandas_udf(DoubleType())
def student_two_sided(t: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [None if _missing(a, b) else t_two_sided(a, b) for a, b in zip(t, df)], dtype="float64"
    )


@F.pandas_udf(DoubleType())
def student_critical(alpha: pd.Series, df: pd.Series) -> pd.Series:
    return pd.Series(
        [None if _missing(a, b) else t_critical(a, b) for a, b in zip(alpha, df)], dtype="float64"
    )
