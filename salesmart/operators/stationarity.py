"""Augmented Dickey-Fuller test per series (T5) and its verdicts (T6), in column expressions.

Test definition (constant, no trend): regress dy_t on (1, y_(t-1),
dy_(t-1), ..., dy_(t-p)); the statistic is the t-value of y_(t-1).
The lag p is chosen by AIC among 0..maxlag on the common sample left after
maxlag, maxlag = ceil(12 (n/100)^(1/4)) capped at n/2 - 2; the final
regression is refitted at the chosen lag on its own, longer sample.

A series' days become one row with an array (days, not lines: lines are summed
long before), so any number of series spread over tasks, and no Python worker is
needed. Each regression is one lagged Gram matrix and one Cholesky sweep over it.
The regressors come in nested order, so the sweep's last row gives the residual
sum of squares of *every* lag at once: the squared target less the squares of the
row's first entries.

A series without enough values, without change, or with a perfect fit has no
statistic: its row says why (``reason``), and other series are not touched.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from salesmart.functions.normal import dot, let, norm_cdf

# MacKinnon (1994) p-value surface, constant-only case, one
# variable: bounds of the statistic, switch point, small-p and large-p
# polynomial coefficients (ascending powers of the statistic).
TAU_MAX, TAU_MIN, TAU_STAR = 2.74, -18.83, -1.61
SMALL_P = (2.1659, 1.4412, 0.038269)
LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)

# MacKinnon (2010) critical values, constant-only case, one
# variable: b_inf, b1, b2, b3 of b_inf + b1/n + b2/n^2 + b3/n^3.
CRITICAL_2010 = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}

#: A pivot this small beside its diagonal entry counts as zero: the column follows from those before it.
_TINY = 1e-12


def _poly(x: Column, coefficients) -> Column:
    out = F.lit(0.0)
    for c in reversed(coefficients):
        out = out * x + c
    return out


def mackinnon_p(stat: Column) -> Column:
    """Approximate asymptotic p-value of the ADF statistic."""
    small, large = norm_cdf(_poly(stat, SMALL_P)), norm_cdf(_poly(stat, LARGE_P))
    return (F.when(stat > TAU_MAX, F.lit(1.0)).when(stat < TAU_MIN, F.lit(0.0))
             .when(stat <= TAU_STAR, small).when(stat.isNotNull(), large))


def mackinnon_crit(nobs: Column, level: str) -> Column:
    """Finite-sample critical value for ``nobs`` observations."""
    return _poly(1.0 / nobs, CRITICAL_2010[level])


def gram(columns: Column) -> Column:
    """Lower triangle of the matrix of products of an array of columns, row by row."""
    return F.transform(columns, lambda c, i: F.transform(F.slice(columns, 1, i + 1), lambda d: dot(c, d)))


def cholesky(rows: Column) -> Column:
    """The lower factor of a ``gram`` triangle, row by row. From a pivot that is zero (or not
    above rounding) on, entries are NULL."""
    def entry(done: Column, above: Column, row: Column) -> Column:
        k = F.size(done)
        return F.array_append(done, (F.element_at(row, k + 1) - dot(done, F.slice(above, 1, k))) / F.element_at(above, k + 1))

    def add(factor: Column, row: Column) -> Column:
        def diagonal(done: Column) -> Column:
            own = F.element_at(row, F.size(row))
            return let(own - dot(done, done), lambda left: F.array_append(
                done, F.when(left > own * _TINY, F.sqrt(left))))
        return F.array_append(factor, let(F.aggregate(factor, F.array().cast("array<double>"), lambda done, above: entry(done, above, row)), diagonal))

    return F.aggregate(rows, F.array().cast("array<array<double>>"), add)


def _lagged(y: Column, p: Column, level_last: bool) -> Column:
    """Regressors 1, y_(t-1) and the ``p`` differences before t, and dy_t, as columns over the
    sample that ``p`` lags leave. ``level_last`` puts y_(t-1) behind the differences."""
    n = F.size(y)
    size = n - 1 - p

    def build(dy: Column) -> Column:
        shifted = F.transform(F.sequence(F.lit(0), p), lambda j: F.slice(dy, p + 1 - j, size))  # dy_t, dy_(t-1) ...
        ones, level = F.array(F.array_repeat(F.lit(1.0), size)), F.array(F.slice(y, p + 1, size))

        def order(s: Column) -> Column:
            lags = F.slice(s, 2, p)
            return F.concat(ones, *([lags, level] if level_last else [level, lags]), F.array(F.element_at(s, 1)))
        return let(shifted, order)

    return let(F.zip_with(F.slice(y, 2, n - 1), F.slice(y, 1, n - 1), lambda b, a: b - a), build)


def _fit(y: Column, p: Column, level_last: bool) -> Column:
    return let(_lagged(y, p, level_last), lambda c: cholesky(gram(c)))


def _choose(factor: Column, size: Column) -> Column:
    """(aic, lag) of the best lag, from the factor's last row: lag p has 2 + p regressors."""
    def best(last: Column) -> Column:
        # Squares left after k regressors: the last entry's, and those of the entries behind the k-th.
        left = lambda k: let(F.slice(last, k + 1, F.size(last) - k), lambda r: dot(r, r))
        score = lambda k: size * (math.log(2 * math.pi) + F.log(left(k) / size) + 1) + 2 * k
        lags = F.transform(F.sequence(F.lit(2), F.size(last) - 1), lambda k: F.struct(score(k).alias("aic"), (k - 2).alias("lag")))
        return F.array_min(F.filter(lags, lambda s: s["aic"].isNotNull()))
    return let(F.element_at(factor, -1), best)


def adf_test(series: DataFrame, max_lag: int | None = None) -> DataFrame:
    """T5+T6 for every series of a (series_id, idx, y) frame; NULL and NaN values are left out.

    Columns: series_id, adf_stat, p_value, used_lag, nobs, crit_1pct, crit_5pct, crit_10pct,
    ic_best, stationary_1pct, stationary_5pct, stationary_10pct, reason (NULL with a statistic).
    """
    value = F.when(~F.isnan("y"), F.col("y").cast("double"))
    days = series.groupBy("series_id").agg(F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct("idx", value.alias("y"))))).alias("days"))
    # A shift changes neither the statistic nor the fits (there is a constant), but saves digits.
    shifted = let(F.transform("days", lambda d: d["y"]), lambda y: let(
        dot(y, F.transform(y, lambda _: F.lit(1.0))) / F.greatest(F.size(y), F.lit(1)), lambda m: F.transform(y, lambda v: v - m)))
    n = F.size("y")
    wanted = F.lit(max_lag) if max_lag is not None else F.ceil(12.0 * F.pow(n / 100.0, F.lit(0.25))).cast("int")
    top = F.least(F.floor(n / 2).cast("int") - 2, wanted)
    rows = days.select("series_id", shifted.alias("y")).withColumn("top", top)
    rows = rows.withColumn("best", F.when(F.col("top") >= 0, let(F.col("y"), lambda y: let(
        F.col("top"), lambda p: _choose(_fit(y, p, False), F.size(y) - 1 - p)))))
    lag = F.col("best.lag")
    rows = rows.withColumn("last", F.when(lag.isNotNull(), let(F.col("y"), lambda y: let(
        lag, lambda p: F.slice(_fit(y, p, True), p + 2, 2)))))
    level, target = F.element_at("last", 1), F.element_at("last", 2)
    left, z = F.element_at(target, -1), F.element_at(target, -2)
    nobs = F.size("y") - 1 - lag
    stat = F.when(F.element_at(level, -1).isNotNull(), z / (left / F.sqrt((nobs - lag - 2).cast("double"))))
    rows = rows.select("series_id", "top", "best", "y", nobs.cast("bigint").alias("nobs"), stat.alias("adf_stat"))
    reason = (F.when(F.col("top") < 0, "too few values for the ADF test")
               .when(F.array_max("y") == F.array_min("y"), "the series is constant")
               .when(F.col("adf_stat").isNull(), "the regressors fit the differences without error, or follow from each other"))
    crit = {k: F.when(F.col("adf_stat").isNotNull(), mackinnon_crit(F.col("nobs"), k)) for k in CRITICAL_2010}
    found = lambda c: F.when(F.col("adf_stat").isNotNull(), c)
    return rows.select(
        "series_id", "adf_stat", mackinnon_p(F.col("adf_stat")).alias("p_value"), found(F.col("best.lag")).cast("bigint").alias("used_lag"),
        found(F.col("nobs")).alias("nobs"), *[c.alias(f"crit_{k[:-1]}pct") for k, c in crit.items()],
        found(F.col("best.aic")).alias("ic_best"),
        # The null of a unit root is rejected when the statistic is below the value.
        *[(F.col("adf_stat") < c).alias(f"stationary_{k[:-1]}pct") for k, c in crit.items()], reason.alias("reason"))
