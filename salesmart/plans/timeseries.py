"""Registered time-series queries (T1-T5 lag 0, T7, T13, T16, T17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.functions.numeric import round4
from salesmart.operators import series as ts
from salesmart.plans.registry import query, with_sales
from salesmart.sources.star import star_sum
from salesmart.sources.tables import Tables

SEED = 42


def _r4(expr: str) -> str:
    return f"round_even(({expr}) * 10000, 0) / 10000"


# DuckDB: T1 daily mean on a full calendar, then T2 interpolation.
_SERIES_SQL = """
, daily AS (SELECT order_date AS ds,
                   CAST(SUM(CAST(sales AS DECIMAL(18,4))) AS DOUBLE) / COUNT(sales) AS y
            FROM sales WHERE order_date IS NOT NULL GROUP BY order_date)
, cal AS (SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS ds
          FROM (SELECT CAST(MIN(ds) AS TIMESTAMP) AS a, CAST(MAX(ds) AS TIMESTAMP) AS b FROM daily) m)
, dm AS (SELECT 'all' AS series_id, c.ds,
                CAST(date_diff('day', (SELECT MIN(ds) FROM cal), c.ds) AS BIGINT) AS idx, d.y
         FROM cal c LEFT JOIN daily d ON c.ds = d.ds)
, di AS (SELECT series_id, ds, idx,
                CASE WHEN y IS NOT NULL THEN y WHEN y0 IS NULL THEN NULL WHEN y1 IS NULL THEN y0
                     ELSE y0 + (y1 - y0) * ((idx - i0) / (i1 - i0)) END AS y
         FROM (SELECT *,
                 last_value(y IGNORE NULLS) OVER w0 AS y0,
                 last_value(CASE WHEN y IS NOT NULL THEN idx END IGNORE NULLS) OVER w0 AS i0,
                 first_value(y IGNORE NULLS) OVER w1 AS y1,
                 first_value(CASE WHEN y IS NOT NULL THEN idx END IGNORE NULLS) OVER w1 AS i1
               FROM dm
               WINDOW w0 AS (ORDER BY idx ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                      w1 AS (ORDER BY idx ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)) s)
"""


def _series(t: Tables) -> DataFrame:
    """Daily series from per-order partial sums and counts (eager aggregation)."""
    return ts.daily_series(star_sum(t, ["order_date"], counts=True), count_col="n")


@query("daily_mean", with_sales(_SERIES_SQL + f"SELECT series_id, ds, idx, {_r4('y')} AS y FROM dm"))
def daily_mean(t: Tables) -> DataFrame:
    """Mean line value per day on a gap-free calendar (empty days NULL)."""
    s = ts.daily_mean(star_sum(t, ["order_date"], counts=True), count_col="n")
    return s.withColumn("y", round4("y"))


@query("daily_interpolated", with_sales(_SERIES_SQL + f"SELECT series_id, ds, idx, {_r4('y')} AS y FROM di"))
def daily_interpolated(t: Tables) -> DataFrame:
    """The daily series with gaps filled linearly."""
    return _series(t).withColumn("y", round4("y"))


@query("split_stats", with_sales(_SERIES_SQL + f"""
, sp AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(ds AS VARCHAR) || ':{SEED}'), ds) AS rn,
                COUNT(*) OVER () AS n FROM di)
SELECT series_id,
       CASE WHEN rn <= floor(n * 0.6) THEN 'train' WHEN rn <= floor(n * 0.8) THEN 'test'
            ELSE 'validate' END AS split,
       COUNT(y) AS n, {_r4('AVG(y)')} AS mean, {_r4('var_samp(y)')} AS var
FROM sp GROUP BY 1, 2"""))
def split_stats(t: Tables) -> DataFrame:
    """T3+T4: seeded 60/20/20 split of the days; mean and variance per split."""
    out = ts.split_stats(_series(t), SEED)
    return out.withColumn("mean", round4("mean")).withColumn("var", round4("var"))


@query("decompose_additive", with_sales(_SERIES_SQL + f"""
, tr AS (SELECT *, CASE WHEN COUNT(y) OVER w = 7 THEN AVG(y) OVER w END AS trend, idx % 7 AS phase
         FROM di WINDOW w AS (ORDER BY idx ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING))
, pm AS (SELECT *, AVG(y - trend) OVER (PARTITION BY phase) AS phase_mean FROM tr)
, se AS (SELECT *, phase_mean - AVG(CASE WHEN idx < 7 THEN phase_mean END) OVER () AS seasonal FROM pm)
SELECT series_id, ds, idx, {_r4('y')} AS y, {_r4('trend')} AS trend, {_r4('seasonal')} AS seasonal,
       {_r4('y - trend - seasonal')} AS resid FROM se"""))
def decompose_additive(t: Tables) -> DataFrame:
    """Additive decomposition with period 7."""
    d = ts.decompose_additive(_series(t), 7)
    return d.select("series_id", "ds", "idx", *[round4(c).alias(c) for c in
                                                ("y", "trend", "seasonal", "resid")])


@query("seasonal_naive_rmse", with_sales(_SERIES_SQL + f"""
, p AS (SELECT series_id, y, lag(y, 7) OVER (ORDER BY idx) AS yhat FROM di)
SELECT series_id, COUNT(*) AS n, {_r4('sqrt(AVG((y - yhat) * (y - yhat)))')} AS rmse
FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY series_id"""))
def seasonal_naive_rmse(t: Tables) -> DataFrame:
    """T17+T13: RMSE of the weekly seasonal-naive forecast."""
    return ts.rmse(ts.seasonal_naive(_series(t), 7)).withColumn("rmse", round4("rmse"))


@query("moving_average_rmse", with_sales(_SERIES_SQL + f"""
, p AS (SELECT series_id, y,
               CASE WHEN COUNT(y) OVER w = 7 THEN AVG(y) OVER w END AS yhat
        FROM di WINDOW w AS (ORDER BY idx ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
SELECT series_id, COUNT(*) AS n, {_r4('sqrt(AVG((y - yhat) * (y - yhat)))')} AS rmse
FROM p WHERE y IS NOT NULL AND yhat IS NOT NULL GROUP BY series_id"""))
def moving_average_rmse(t: Tables) -> DataFrame:
    """T17+T13: RMSE of the trailing 7-day moving-average forecast."""
    return ts.rmse(ts.moving_average(_series(t), 7)).withColumn("rmse", round4("rmse"))


_ACF_LAGS = 10


@query("residual_acf", with_sales(_SERIES_SQL + """
, r AS (SELECT series_id, idx, y - lag(y, 7) OVER (ORDER BY idx) AS x FROM di)
, c AS (SELECT series_id, idx, x - AVG(x) OVER () AS c FROM r WHERE x IS NOT NULL)
, l AS (SELECT a.series_id, k.lag, a.c * b.c AS prod
        FROM c a CROSS JOIN (SELECT CAST(range AS BIGINT) AS lag FROM range(1, """ + str(_ACF_LAGS + 1) + """)) k
        JOIN c b ON b.idx = a.idx - k.lag)
SELECT l.series_id, l.lag, """ + _r4("SUM(prod) / (SELECT SUM(c * c) FROM c)") + """ AS acf
FROM l GROUP BY l.series_id, l.lag"""))
def residual_acf(t: Tables) -> DataFrame:
    """Autocorrelation of the seasonal-naive residuals, lags 1..10."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.acf(res, "resid", _ACF_LAGS).withColumn("acf", round4("acf"))


_RESID_SQL = _SERIES_SQL + """
, r AS (SELECT series_id, y - lag(y, 7) OVER (ORDER BY idx) AS x FROM di)"""


@query("residual_spread", with_sales(_RESID_SQL + f"""
SELECT series_id, COUNT(x) AS n, {_r4('AVG(x)')} AS mean, {_r4('stddev_samp(x)')} AS std FROM r GROUP BY series_id"""))
def residual_spread(t: Tables) -> DataFrame:
    """Mean and standard deviation of the seasonal-naive residuals."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.spread(res).select("series_id", "n", round4("mean").alias("mean"), round4("std").alias("std"))


@query("residual_histogram", with_sales(_RESID_SQL + """
, e AS (SELECT min(x) AS low, (max(x) - min(x)) / 10 AS width FROM r)
SELECT series_id, CAST(least(floor((x - low) / width), 9) AS BIGINT) AS bin, COUNT(*) AS n
FROM r, e WHERE x IS NOT NULL GROUP BY 1, 2"""))
def residual_histogram(t: Tables) -> DataFrame:
    """Ten-bin histogram of the seasonal-naive residuals."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.histogram(res)


_STD_SQL = _SERIES_SQL + """
, r AS (SELECT series_id, idx, y - lag(y, 7) OVER (ORDER BY idx) AS x FROM di)
, z AS (SELECT series_id, idx, (x - AVG(x) OVER ()) / stddev_samp(x) OVER () AS z, COUNT(*) OVER () AS n FROM r WHERE x IS NOT NULL)"""


def _cdf(z: str) -> str:
    return (f"(0.5 + exp(-{z} * {z} / 2) / sqrt(2 * pi()) * list_sum(list_transform(range(0, 100), "
            f"lambda k: power({z}, 2 * k + 1) * sqrt(pi()) / (power(2.0, k + 1) * gamma(k + 1.5)))))")


def _newton(i: int) -> str:
    return f", q{i + 1} AS (SELECT *, x{i} - ({_cdf(f'x{i}')} - p) / (exp(-x{i} * x{i} / 2) / sqrt(2 * pi())) AS x{i + 1} FROM q{i})"


@query("residual_qq", with_sales(_STD_SQL + """
, o AS (SELECT series_id, z, row_number() OVER (ORDER BY z, idx) AS place, n FROM z)
, q0 AS (SELECT *, place / (n + 1) AS p, 4.91 * (power(place / (n + 1), 0.14) - power(1 - place / (n + 1), 0.14)) AS x0 FROM o)"""
    + "".join(map(_newton, range(5))) + f"""
SELECT series_id, CAST(place AS BIGINT) AS place, {_r4('x5')} AS theoretical, {_r4('z')} AS sample FROM q5"""))
def residual_qq(t: Tables) -> DataFrame:
    """Normal Q-Q of the standardised seasonal-naive residuals."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.normal_qq(res).select("series_id", "place", round4("theoretical").alias("theoretical"), round4("sample").alias("sample"))


@query("residual_density", with_sales(_STD_SQL + f"""
, e AS (SELECT min(z) AS low, max(z) AS high, (max(z) - min(z)) / 512 AS width, any_value(n) AS n, power(any_value(n), -0.2) AS h FROM z)
, b AS (SELECT series_id, low + (least(floor((z - low) / width), 511) + 0.5) * width AS centre, COUNT(*) AS m FROM z, e GROUP BY ALL)
, g AS (SELECT CAST(range AS BIGINT) AS point, low - 3 * h + range * ((high - low + 6 * h) / 63) AS spot, n, h FROM range(64), e)
SELECT series_id, point, {_r4('spot')} AS z, {_r4('SUM(m * exp(-power((spot - centre) / h, 2) / 2)) / (any_value(n) * any_value(h) * sqrt(2 * pi()))')} AS density
FROM b, g GROUP BY series_id, point, spot"""))
def residual_density(t: Tables) -> DataFrame:
    """Estimated density of the standardised seasonal-naive residuals at 64 places."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.kernel_density(res).select("series_id", "point", round4("z").alias("z"), round4("density").alias("density"))


@query("residual_standardised", with_sales(_STD_SQL + f"SELECT series_id, idx, {_r4('z')} AS z FROM z"))
def residual_standardised(t: Tables) -> DataFrame:
    """The standardised seasonal-naive residuals, day by day."""
    res = ts.seasonal_naive(_series(t), 7).withColumn("resid", F.col("y") - F.col("yhat"))
    return ts.standardised(res).select("series_id", "idx", round4("z").alias("z"))


@query("dickey_fuller_lag0", with_sales(_SERIES_SQL + f"""
, d AS (SELECT series_id, y - lag(y) OVER (ORDER BY idx) AS dy, lag(y) OVER (ORDER BY idx) AS ylag FROM di)
, g AS (SELECT series_id, regr_count(dy, ylag) AS nobs, regr_sxx(dy, ylag) AS sxx, regr_sxy(dy, ylag) AS sxy,
               regr_syy(dy, ylag) AS syy, regr_slope(dy, ylag) AS gamma, regr_intercept(dy, ylag) AS const
        FROM d GROUP BY series_id)
SELECT series_id, CAST(nobs AS BIGINT) AS nobs, {_r4('gamma')} AS gamma, {_r4('const')} AS const,
       {_r4('gamma / sqrt((syy - sxy * sxy / sxx) / (nobs - 2) / sxx)')} AS t_stat FROM g"""))
def dickey_fuller_lag0(t: Tables) -> DataFrame:
    """T5 (no augmentation): Dickey-Fuller regression by regression aggregates."""
    out = ts.dickey_fuller_lag0(_series(t))
    return out.select("series_id", F.col("nobs").cast("bigint").alias("nobs"),
                      *[round4(c).alias(c) for c in ("gamma", "const", "t_stat")])
