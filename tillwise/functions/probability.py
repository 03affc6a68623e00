"""Tail probabilities for the hypothesis tests, as small column functions.

They run on result rows (one per test), after Spark has reduced the data to a few sums.
"""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column, functions as F


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta function, evaluated from the front."""
    tiny = 1e-300
    front, up = 1.0, 1.0
    down = 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = down
    for m in range(1, 500):
        even = m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1))
        step = front
        for term in (even, odd):
            down = 1.0 + term * down
            down = 1.0 / (down if abs(down) > tiny else tiny)
            up = 1.0 + term / up
            up = up if abs(up) > tiny else tiny
            step = up * down
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def beta_share(a: float, b: float, x: float) -> float:
    """Regularised incomplete beta function I_x(a, b)."""
    if x <= 0.0 or x >= 1.0:
        return 0.0 if x <= 0.0 else 1.0
    log_front = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(log_front) * _beta_fraction(a, b, x) / a
    return 1.0 - math.exp(log_front) * _beta_fraction(b, a, 1.0 - x) / b


def student_two_sided(t: float, df: float) -> float:
    """P(|T| >= |t|) for Student's t with ``df`` degrees of freedom."""
    if math.isnan(t) or math.isnan(df) or df <= 0:
        return math.nan
    return beta_share(df / 2.0, 0.5, df / (df + t * t))


def student_p(t: Column, df: Column) -> Column:
    @F.pandas_udf("double")
    def tail(ts: pd.Series, dfs: pd.Series) -> pd.Series:
        return pd.Series([student_two_sided(a, b) for a, b in zip(ts.astype(float), dfs.astype(float))])

    return tail(t, df)


def chi2_two_p(value: Column) -> Column:
    """P(X >= value) for a chi-square with two degrees of freedom."""
    return F.exp(-value / 2)


# Coefficients of Wichura's algorithm AS 241, constant term first, as pairs of
# numerator and denominator for the middle, the tails and the far tails.
AS_241 = {
    "middle": (
        [3.3871328727963666080, 133.14166789178437745, 1971.5909503065514427, 13731.693765509461125,
         45921.953931549871457, 67265.770927008700853, 33430.575583588128105, 2509.0809287301226727],
        [1.0, 42.313330701600911252, 687.18700749205790830, 5394.1960214247511077,
         21213.794301586595867, 39307.895800092710610, 28729.085735721942674, 5226.4952788528545610],
    ),
    "tail": (
        [1.42343711074968357734, 4.63033784615654529590, 5.76949722146069140550, 3.64784832476320460504,
         1.27045825245236838258, 0.241780725177450611770, 0.0227238449892691845833, 0.000774545014278341407640],
        [1.0, 2.05319162663775882187, 1.67638483018380384940, 0.689767334985100004550,
         0.148103976427480074590, 0.0151986665636164571966, 0.000547593808499534494600, 0.00000000105075007164441684324],
    ),
    "far": (
        [6.65790464350110377720, 5.46378491116411436990, 1.78482653991729133580, 0.296560571828504891230,
         0.0265321895265761230930, 0.00124266094738807843860, 0.0000271155556874348757815, 0.000000201033439929228813265],
        [1.0, 0.599832206555887937690, 0.136929880922735805310, 0.0148753612908506148525,
         0.000786869131145613259100, 0.0000184631831751005468180, 0.000000142151175831644588870, 0.00000000000000204426310338993978564],
    ),
}


def normal_quantile(probability: Column) -> Column:
    """Inverse of the normal distribution function, to about 16 digits; NULL outside (0, 1)."""

    def ratio(part: str, x: Column) -> Column:
        def polynomial(terms: list[float]) -> Column:
            value = F.lit(terms[-1])
            for term in reversed(terms[:-1]):
                value = value * x + F.lit(term)
            return value

        top, bottom = AS_241[part]
        return polynomial(top) / polynomial(bottom)

    p = probability.cast("double")
    q = p - 0.5
    depth = F.sqrt(-F.log(F.least(p, 1 - p)))
    outer = F.when(depth <= 5, ratio("tail", depth - 1.6)).otherwise(ratio("far", depth - 5))
    inner = q * ratio("middle", 0.180625 - q * q)
    return F.when((p > 0) & (p < 1), F.when(F.abs(q) <= 0.425, inner).otherwise(F.signum(q) * outer))
