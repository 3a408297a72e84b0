"""Distribution functions as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Coefficients of the rational approximation of the normal distribution function
# (Hart 1968, as given by West 2005), highest power first: fixed values.
_HART_NUMERATOR = [
    3.52624965998911e-02, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
_HART_DENOMINATOR = [
    8.83883476483184e-02, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]


def _polynomial(x: Column, coefficients: list[float]) -> Column:
    return reduce(lambda acc, c: acc * x + F.lit(c), coefficients[1:], F.lit(coefficients[0]))


def normal_cdf(z: Column) -> Column:
    """Standard normal distribution function, double precision."""
    x = F.abs(z)
    near = _polynomial(x, _HART_NUMERATOR) / _polynomial(x, _HART_DENOMINATOR)
    far = F.lit(0.65)
    for k in (4.0, 3.0, 2.0, 1.0):
        far = F.lit(k) / (x + far)
    far = F.lit(1.0) / ((x + far) * F.lit(2.506628274631))
    tail = (F.when(x > 37, 0.0)
            .otherwise(F.exp(-x * x / 2) * F.when(x < 7.07106781186547, near).otherwise(far)))
    return F.when(z > 0, 1.0 - tail).otherwise(tail)


def kolmogorov_pvalue(d: Column, n: Column, terms: int = 100) -> Column:
    """P(sqrt(n) D > lambda) by the Kolmogorov series; n is the effective size."""
    lam2 = n * d * d
    series = F.aggregate(
        F.sequence(F.lit(1), F.lit(terms)), F.lit(0.0),
        lambda acc, k: acc + F.when(k % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * k * k * lam2))
    return F.when(lam2 < 0.04, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))
