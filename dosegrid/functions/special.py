"""Special functions as column expressions: logarithm of the gamma function, tail of Student's t."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Steps of the continued fraction for few degrees of freedom; it takes some multiples of their root for many.
LEAST_STEPS, MOST_STEPS = 100, 20_000


def log_gamma(z: Column) -> Column:
    """ln of gamma for z > 0: Stirling's series eight places further, to some 1e-13."""
    far = z + 8
    series = 1 / (12 * far) - 1 / (360 * far**3) + 1 / (1260 * far**5) - 1 / (1680 * far**7) + 1 / (1188 * far**9)
    shift = F.log(z)
    for k in range(1, 8):
        shift = shift + F.log(z + k)
    return (far - 0.5) * F.log(far) - far + 0.5 * math.log(2 * math.pi) + series - shift


def _safe(x: Column) -> Column:
    return F.when(F.abs(x) < 1e-300, 1e-300).otherwise(x)


def steps_for(n: Column) -> Column:
    return F.least(F.greatest(F.floor(10 * F.sqrt(n)).cast("int"), F.lit(LEAST_STEPS)), F.lit(MOST_STEPS))


def beta_fraction(x: Column, a: Column, b: Column, steps: Column) -> Column:
    """Continued fraction of the incomplete beta function, forwards, as a fold over its coefficients."""
    m = lambda j: F.floor(j / 2).cast("double")
    even = lambda k: k * (b - k) * x / ((a + 2 * k - 1) * (a + 2 * k))
    odd = lambda k: -(a + k) * (a + b + k) * x / ((a + 2 * k) * (a + 2 * k + 1))
    terms = F.transform(F.sequence(F.lit(2), 2 * steps), lambda j: F.when(j % 2 == 0, even(m(j))).otherwise(odd(m(j))))
    first = 1 / _safe(1 - (a + b) * x / (a + 1))
    start = F.struct(F.lit(1.0).alias("c"), first.alias("d"), first.alias("h"))

    def step(s: Column, k: Column) -> Column:
        c, d = _safe(1 + k / s["c"]), 1 / _safe(1 + k * s["d"])
        return F.struct(c.alias("c"), d.alias("d"), (s["h"] * d * c).alias("h"))

    return F.aggregate(terms, start, step, lambda s: s["h"])


def beta_share(x: Column, rest: Column, a: Column, b: Column, n: Column) -> Column:
    """The regularised incomplete beta function for 0 < x < 1; rest: 1 - x, which may be known better than by that; n: what the number of steps goes by."""
    front = F.exp(log_gamma(a + b) - log_gamma(a) - log_gamma(b) + a * F.log(x) + b * F.log(rest))
    one = lambda x, a, b: front * beta_fraction(x, a, b, steps_for(n)) / a
    return F.when(x > (a + 1) / (a + b + 2), 1 - one(rest, b, a)).otherwise(one(x, a, b))


def correlation_p(r: Column, n: Column) -> Column:
    """Two-sided p-value of a correlation of n pairs: Student's t with n - 2 degrees of freedom. Null for a null r or fewer than three pairs, 0 for one of size 1, 1 for none."""
    free = (n - 2).cast("double")
    inner = F.when((r != 0) & (F.abs(r) < 1), r)
    share = beta_share((1 - inner) * (1 + inner), inner * inner, free / 2, F.lit(0.5), n)  # free / (free + t * t) is 1 - r * r
    return F.when(r.isNull() | (n < 3), None).when(F.abs(r) >= 1, 0.0).when(r == 0, 1.0).otherwise(share)
