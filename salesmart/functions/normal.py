"""The normal distribution as column expressions, and a few array helpers (Spark has none of them)."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_TERMS = 160
_FAR = 6.5


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def dot(a: Column, b: Column) -> Column:
    """Sum of products of two arrays of one length (0.0 of empty ones)."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def norm_pdf(z: Column) -> Column:
    return F.exp(-z * z / 2) / math.sqrt(2 * math.pi)


def norm_cdf(z: Column) -> Column:
    """Normal distribution function: 1/2 + pdf(z) * (z + z^3/3 + z^5/15 + ...), to about 1e-15;
    beyond 6.5 deviations the first terms of the asymptotic series."""
    def near(x: Column) -> Column:
        step = lambda s, k: F.struct((s["term"] * x * x / (2 * k + 1)).alias("term"),
                                     (s["sum"] + s["term"] * x * x / (2 * k + 1)).alias("sum"))
        total = F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), F.struct(x.alias("term"), x.alias("sum")), step, lambda s: s["sum"])
        return 0.5 + norm_pdf(x) * total

    def any_(x: Column) -> Column:
        tail = norm_pdf(x) / F.abs(x) * (1 - 1 / (x * x) + 3 / (x * x * x * x))
        return F.when(F.abs(x) <= _FAR, near(x)).when(x < 0, tail).when(x > 0, 1 - tail)

    return let(z.cast("double"), any_)


def norm_quantile(p: Column) -> Column:
    """Inverse of ``norm_cdf`` for 0 < p < 1 (else NULL): a published rational approximation, then Newton steps."""
    # Abramowitz and Stegun 26.2.23.
    c, d = (2.515517, 0.802853, 0.010328), (1.432788, 0.189269, 0.001308)

    def start(q: Column) -> Column:
        t = F.sqrt(-2 * F.log(q))
        return let(t, lambda t: t - (c[0] + t * (c[1] + t * c[2])) / (1 + t * (d[0] + t * (d[1] + t * d[2]))))

    def solve(p: Column) -> Column:
        low = F.least(p, 1 - p)
        x = F.aggregate(F.sequence(F.lit(1), F.lit(3)), -start(low), lambda x, _: x - (norm_cdf(x) - low) / norm_pdf(x))
        return F.when((p > 0) & (p < 1), F.when(p <= 0.5, x).otherwise(-x))

    return let(p.cast("double"), solve)
