"""Daily time series built and analysed in Spark.

A series frame has one row per (series_id, day): ``series_id, ds, idx, y``,
where ``idx`` counts days from the series start and gives the order (never
the physical row order). Order lines are reduced to days by a distributed
group-by first; every window afterwards is partitioned by ``series_id`` and
so only sees one series' days (a few thousand rows), however many lines the
days were built from. Many series (per region, per category, ...) spread
over tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from salesmart.functions.normal import norm_pdf, norm_quantile
from salesmart.functions.numeric import money_mean

DEFAULT_SERIES = "all"


def _series_id(series_cols: list[str] | None) -> Column:
    if not series_cols:
        return F.lit(DEFAULT_SERIES)
    # Separators inside a key are escaped, and NULL keys give a NULL id, so different keys never share one.
    keys = [F.regexp_replace(F.col(c).cast("string"), r"([|\\])", r"\\$1") for c in series_cols]
    return F.concat(*[x for k in keys for x in (F.lit("|"), k)][1:])


def _by_series(order: str = "idx") -> Window:
    return Window.partitionBy("series_id").orderBy(order)


def daily_mean(df: DataFrame, date_col: str = "order_date", value_col: str = "sales",
               series_cols: list[str] | None = None, count_col: str | None = None) -> DataFrame:
    """T1 (+J3): mean value per calendar day, days without rows are NULL.

    The mean is over order lines (the reference resamples line values with
    ``mean``), computed as the exact decimal sum / count. With ``count_col``
    the input is already partially aggregated: ``value_col`` holds exact
    partial sums and ``count_col`` the partial line counts. The calendar runs
    from each series' first to last day; rows with a NULL date or a NULL series key are ignored.

    Gap days are generated from the aggregated days themselves: each present
    day emits itself and the missing days up to the next present day
    (``lead`` + ``sequence``), so the lines are aggregated once and no
    calendar join is needed.
    """
    lines = (df.where(F.col(date_col).isNotNull() & _series_id(series_cols).isNotNull())
               .select(_series_id(series_cols).alias("series_id"),
                       F.col(date_col).cast("date").alias("ds"), F.col(value_col).alias("v"),
                       *([F.col(count_col).alias("n")] if count_col else [])))
    if count_col:
        # Pre-aggregated input (exact decimal partial sums + partial counts).
        mean = F.sum("v").cast("double") / F.sum("n")
        daily = lines.groupBy("series_id", "ds").agg(
            F.when(F.sum("n") > 0, mean).alias("y"))
    else:
        daily = lines.groupBy("series_id", "ds").agg(money_mean("v").alias("y"))
    by_day = Window.partitionBy("series_id").orderBy("ds")
    spans = (daily.withColumn("next_ds", F.lead("ds").over(by_day))
                  .withColumn("d0", F.min("ds").over(Window.partitionBy("series_id"))))
    last = F.coalesce(F.date_sub("next_ds", 1), F.col("ds"))
    days = spans.select("series_id", "d0", F.col("ds").alias("present"), "y",
                        F.explode(F.sequence("ds", last)).alias("ds"))
    return days.select("series_id", "ds", F.datediff("ds", "d0").cast("bigint").alias("idx"),
                       F.when(F.col("ds") == F.col("present"), F.col("y")).alias("y"))


def interpolate_linear(series: DataFrame) -> DataFrame:
    """Linear interpolation over ``idx`` inside each series.

    Leading NULLs stay NULL; trailing NULLs take the last known value (the
    pandas ``interpolate(method='linear')`` behaviour).
    """
    known_idx = F.when(F.col("y").isNotNull(), F.col("idx"))
    # Both neighbours come from running (growing) frames, which Spark
    # evaluates in one pass; the "next known value" is the last known value
    # when walking the series backwards. (A current-row..unbounded-following
    # frame would be re-aggregated for every row: quadratic in the days.)
    back = _by_series().rowsBetween(Window.unboundedPreceding, 0)
    ahead = (Window.partitionBy("series_id").orderBy(F.col("idx").desc())
             .rowsBetween(Window.unboundedPreceding, 0))
    s = (series.withColumn("y0", F.last("y", ignorenulls=True).over(back))
               .withColumn("i0", F.last(known_idx, ignorenulls=True).over(back))
               .withColumn("y1", F.last("y", ignorenulls=True).over(ahead))
               .withColumn("i1", F.last(known_idx, ignorenulls=True).over(ahead)))
    filled = (F.when(F.col("y").isNotNull(), F.col("y"))
               .when(F.col("y0").isNull(), F.lit(None))
               .when(F.col("y1").isNull(), F.col("y0"))
               .otherwise(F.col("y0") + (F.col("y1") - F.col("y0"))
                          * ((F.col("idx") - F.col("i0")) / (F.col("i1") - F.col("i0")))))
    return s.select("series_id", "ds", "idx", filled.cast("double").alias("y"))


def daily_series(df: DataFrame, date_col: str = "order_date", value_col: str = "sales",
                 series_cols: list[str] | None = None, count_col: str | None = None) -> DataFrame:
    """T1 + T2: the gap-free daily series the analysis and models run on."""
    return interpolate_linear(daily_mean(df, date_col, value_col, series_cols, count_col))


def random_split(series: DataFrame, seed: int = 42, cuts=(0.6, 0.8)) -> DataFrame:
    """Seeded shuffle of the days into train / test / validate.

    Days are ordered by md5(date || ':' || seed) - reproducible, and the
    same in any engine - then cut at floor(0.6 n) and floor(0.8 n).
    """
    key = F.md5(F.concat(F.col("ds").cast("string"), F.lit(f":{seed}")))
    w = Window.partitionBy("series_id").orderBy(key, F.col("ds"))
    n = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    rn = F.row_number().over(w)
    split = (F.when(rn <= F.floor(n * cuts[0]), "train")
              .when(rn <= F.floor(n * cuts[1]), "test")
              .otherwise("validate"))
    return series.withColumn("split", split)


def split_stats(series: DataFrame, seed: int = 42) -> DataFrame:
    """T4: mean and sample variance of each split (ddof = 1)."""
    s = random_split(series, seed)
    return s.groupBy("series_id", "split").agg(
        F.count("y").alias("n"), F.avg("y").alias("mean"), F.var_samp("y").alias("var"))


def decompose_additive(series: DataFrame, period: int = 7) -> DataFrame:
    """Classical additive decomposition y = trend + seasonal + resid.

    Trend is the centred moving average (2x(period) for an even period,
    plain for odd), NULL where the window is incomplete; the seasonal
    component is the per-phase mean of the detrended series, centred so the
    phases sum to zero; phase = idx mod period.
    """
    half = period // 2
    if period % 2:
        win = _by_series().rowsBetween(-half, half)
        full = F.count(F.col("y")).over(win) == period
        trend = F.when(full, F.avg("y").over(win))
    else:
        # 2 x period MA: weights 1/(2p) at both ends, 1/p inside.
        win = _by_series().rowsBetween(-half, half)
        full = F.count(F.col("y")).over(win) == period + 1
        ends = F.first("y").over(win) + F.last("y").over(win)
        trend = F.when(full, (F.sum("y").over(win) - ends / 2) / period)
    s = series.withColumn("trend", trend).withColumn("phase", F.col("idx") % period)
    s = s.withColumn("detr", F.col("y") - F.col("trend"))
    s = s.withColumn("phase_mean", F.avg("detr").over(Window.partitionBy("series_id", "phase")))
    # Mean over the phases (each counted once: the first period rows hold one of each).
    centre = F.avg(F.when(F.col("idx") < period, F.col("phase_mean"))).over(
        Window.partitionBy("series_id"))
    s = s.withColumn("seasonal", F.col("phase_mean") - centre)
    return s.select("series_id", "ds", "idx", "y", "trend", "seasonal",
                    (F.col("y") - F.col("trend") - F.col("seasonal")).alias("resid"))


def seasonal_naive(series: DataFrame, season: int = 7) -> DataFrame:
    """Forecast y_t by y_(t-season)."""
    return series.withColumn("yhat", F.lag("y", season).over(_by_series()))


def moving_average(series: DataFrame, window: int = 7) -> DataFrame:
    """Forecast y_t by the mean of the previous ``window`` days."""
    w = _by_series().rowsBetween(-window, -1)
    return series.withColumn("yhat", F.when(F.count("y").over(w) == window, F.avg("y").over(w)))


def rmse(pred: DataFrame, truth: str = "y", fitted: str = "yhat") -> DataFrame:
    """Root mean squared error per series over rows holding both values."""
    both = pred.where(F.col(truth).isNotNull() & F.col(fitted).isNotNull())
    err = F.col(truth) - F.col(fitted)
    return both.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"),
                                         F.sqrt(F.avg(err * err)).alias("rmse"))


def acf(series: DataFrame, column: str = "resid", nlags: int = 10) -> DataFrame:
    """Sample autocorrelation of ``column`` for lags 1..nlags.

    acf_k = sum((x_t - m)(x_(t-k) - m)) / sum((x_t - m)^2) over the non-null
    values in idx order (the standard estimator, full-sample mean and
    denominator). All lags come from one sorted window pass per series.
    """
    x = series.where(F.col(column).isNotNull()).select("series_id", "idx", F.col(column).alias("x"))
    x = x.withColumn("c", F.col("x") - F.avg("x").over(Window.partitionBy("series_id")))
    w = _by_series()
    for k in range(1, nlags + 1):
        x = x.withColumn(f"l{k}", F.lag("c", k).over(w))
    sums = x.groupBy("series_id").agg(
        F.sum(F.col("c") * F.col("c")).alias("den"),
        *[F.sum(F.col("c") * F.col(f"l{k}")).alias(f"n{k}") for k in range(1, nlags + 1)])
    stacked = ", ".join(f"{k}, n{k}" for k in range(1, nlags + 1))
    return sums.selectExpr("series_id", "den", f"stack({nlags}, {stacked}) AS (lag, num)") \
               .select("series_id", F.col("lag").cast("bigint").alias("lag"),
                       (F.col("num") / F.col("den")).alias("acf"))


def spread(series: DataFrame, column: str = "resid") -> DataFrame:
    """Count, mean and sample standard deviation of ``column`` per series."""
    return series.groupBy("series_id").agg(
        F.count(column).alias("n"), F.avg(column).alias("mean"), F.stddev_samp(column).alias("std"))


def histogram(series: DataFrame, column: str = "resid", bins: int = 10) -> DataFrame:
    """Rows per equal-width bin between a series' least and greatest value (bins
    without rows are left out; a constant series is one bin)."""
    x = series.where(F.col(column).isNotNull()).select("series_id", F.col(column).alias("x"))
    ends = x.groupBy("series_id").agg(F.min("x").alias("low"), F.max("x").alias("high"))
    width = (F.col("high") - F.col("low")) / bins
    bin_ = F.when(width > 0, F.least(F.floor((F.col("x") - F.col("low")) / width), F.lit(bins - 1).cast("bigint")))
    return x.join(ends, "series_id").groupBy("series_id", F.coalesce(bin_, F.lit(0).cast("bigint")).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))


def standardised(series: DataFrame, column: str = "resid") -> DataFrame:
    """The non-null values of ``column`` less their mean, over their sample deviation: series_id, idx, z
    and n (values). A series without spread, or with one value, has no rows."""
    whole = Window.partitionBy("series_id")
    x = series.where(F.col(column).isNotNull()).select("series_id", "idx", F.col(column).cast("double").alias("x"))
    x = x.withColumn("std", F.stddev_samp("x").over(whole)).withColumn("mean", F.avg("x").over(whole))
    return x.where("std > 0").select("series_id", "idx", ((F.col("x") - F.col("mean")) / F.col("std")).alias("z"),
                                     F.count(F.lit(1)).over(whole).alias("n"))


def normal_qq(series: DataFrame, column: str = "resid") -> DataFrame:
    """Normal Q-Q of the standardised ``column``: place i of n in rising order, the normal
    quantile of i / (n + 1), and the value there. Equal values follow the days."""
    z = standardised(series, column)
    place = F.row_number().over(Window.partitionBy("series_id").orderBy("z", "idx")).cast("bigint")
    return z.withColumn("place", place).select("series_id", "place", norm_quantile(F.col("place") / (F.col("n") + 1)).alias("theoretical"),
                                               F.col("z").alias("sample"))


def kernel_density(series: DataFrame, column: str = "resid", bins: int = 512, points: int = 64) -> DataFrame:
    """Estimated density of the standardised ``column`` at ``points`` places, with a normal kernel of
    width n^(-1/5) (Scott's rule). Values are counted in ``bins`` first, so the sum runs over bins, not
    days: at most bins x points terms per series, spread over tasks."""
    z = standardised(series, column)
    ends = z.groupBy("series_id").agg(F.min("z").alias("low"), F.max("z").alias("high"), F.first("n").alias("n"))
    ends = ends.withColumn("h", F.pow(F.col("n").cast("double"), F.lit(-0.2))).withColumn("width", (F.col("high") - F.col("low")) / bins)
    bin_ = F.least(F.floor((F.col("z") - F.col("low")) / F.col("width")), F.lit(bins - 1).cast("bigint"))
    held = z.select("series_id", "z").join(ends, "series_id").groupBy("series_id", "low", "high", "n", "h", "width", bin_.alias("bin")).agg(
        F.count(F.lit(1)).alias("m"))
    centre = F.col("low") + (F.col("bin") + 0.5) * F.col("width")
    first, step = F.col("low") - 3 * F.col("h"), (F.col("high") - F.col("low") + 6 * F.col("h")) / (points - 1)
    spots = held.withColumn("centre", centre).withColumn("first", first).withColumn("step", step).withColumn(
        "point", F.explode(F.sequence(F.lit(0), F.lit(points - 1)))).withColumn("z", F.col("first") + F.col("point") * F.col("step"))
    share = F.col("m") * norm_pdf((F.col("z") - F.col("centre")) / F.col("h")) / (F.col("n") * F.col("h"))
    return spots.groupBy("series_id", F.col("point").cast("bigint").alias("point"), "z").agg(F.sum(share).alias("density"))


def dickey_fuller_lag0(series: DataFrame) -> DataFrame:
    """T5 with no augmentation lags: OLS of dy_t on (1, y_(t-1)).

    Uses the regression aggregates (regr_sxx/sxy/syy), so it is one
    aggregate per series; ``t_stat`` is the Dickey-Fuller statistic.
    """
    w = _by_series()
    s = (series.withColumn("ylag", F.lag("y").over(w))
               .withColumn("dy", F.col("y") - F.col("ylag")))
    g = s.groupBy("series_id").agg(
        F.regr_count("dy", "ylag").alias("nobs"), F.regr_sxx("dy", "ylag").alias("sxx"),
        F.regr_sxy("dy", "ylag").alias("sxy"), F.regr_syy("dy", "ylag").alias("syy"),
        F.regr_slope("dy", "ylag").alias("gamma"), F.regr_intercept("dy", "ylag").alias("const"))
    ssr = F.col("syy") - F.col("sxy") * F.col("sxy") / F.col("sxx")
    se = F.sqrt(ssr / (F.col("nobs") - 2) / F.col("sxx"))
    return g.select("series_id", "nobs", "gamma", "const", (F.col("gamma") / se).alias("t_stat"))
