"""Seasonal ARIMA per series, fitted in parallel on the executors.

Spark does the data work: lines -> days (distributed group-by), gap filling,
and the distribution of fits: one ``applyInPandas`` group per series - or per
(series, model order) for the grid search, so 64 candidate models of one
series run as 64 independent tasks. Inside a group a small numpy helper fits
the model by conditional sum of squares (CSS):

    phi(B) PHI(B^m) (1-B)^d (1-B^m)^D y_t = theta(B) THETA(B^m) e_t

with residuals computed recursively from zero pre-sample errors, minimised
by Levenberg-Marquardt. Stationarity and invertibility are not enforced
(the reference switches both off); a fit that diverges is reported as not
converged instead of being skipped. AIC counts the ARMA coefficients plus
the innovation variance. Values differ slightly from an exact state-space
likelihood; compare models by AIC / RMSE, not digit by digit.
"""

from __future__ import annotations

import datetime as _dt
import itertools
import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# The reference's final model and its search grid.
DEFAULT_ORDER = (1, 1, 1)
DEFAULT_SEASONAL = (1, 1, 1, 12)
GRID_VALUES = (0, 1)
GRID_SEASON = 12
Z95 = 1.959963984540054


def order_grid(values=GRID_VALUES, season: int = GRID_SEASON) -> list[tuple]:
    """Every (p, d, q) x (P, D, Q, m) combination (64 for {0, 1})."""
    pdq = list(itertools.product(values, values, values))
    return [(*a, *b, season) for a in pdq for b in pdq]


# ---------------------------------------------------------------- numpy core

def _lag_poly(coefs, step: int, sign: float) -> np.ndarray:
    """1 + sign*c1 B^step + sign*c2 B^(2 step) ..."""
    out = np.zeros(step * len(coefs) + 1)
    out[0] = 1.0
    for i, c in enumerate(coefs, 1):
        out[i * step] = sign * c
    return out


def _polys(params, order, seasonal):
    p, d, q = order
    P, D, Q, m = seasonal
    phi, theta = params[:p], params[p:p + q]
    sphi, stheta = params[p + q:p + q + P], params[p + q + P:p + q + P + Q]
    ar = np.convolve(_lag_poly(phi, 1, -1.0), _lag_poly(sphi, m, -1.0))
    ma = np.convolve(_lag_poly(theta, 1, 1.0), _lag_poly(stheta, m, 1.0))
    diff = np.array([1.0])
    for _ in range(d):
        diff = np.convolve(diff, [1.0, -1.0])
    for _ in range(D):
        seasonal_diff = np.zeros(m + 1)
        seasonal_diff[0], seasonal_diff[m] = 1.0, -1.0
        diff = np.convolve(diff, seasonal_diff)
    return np.convolve(ar, diff), ma


def _residuals(y, params, order, seasonal):
    """CSS residuals e_t for t >= r (r = AR order incl. differencing)."""
    full_ar, ma = _polys(params, order, seasonal)
    r = len(full_ar) - 1
    n = len(y)
    if n <= r:
        raise ValueError("series shorter than the model's conditioning window")
    # AR side as one vectorised convolution: u_t = sum_i full_ar[i] y_(t-i).
    u = np.convolve(y, full_ar)[r:n]
    pairs = [(j, float(ma[j])) for j in range(1, len(ma)) if ma[j] != 0.0]
    if not pairs:
        return u, r
    # MA inversion e_t = u_t - sum_j ma_j e_(t-j): inherently sequential, run
    # on plain floats (no per-element numpy boxing).
    ul = u.tolist()
    m = len(ul)
    e = [0.0] * m
    top = pairs[-1][0]
    for t in range(min(top, m)):
        acc = ul[t]
        for j, c in pairs:
            if t >= j:
                acc -= c * e[t - j]
        e[t] = acc
    if len(pairs) == 1:
        (j1, c1), = pairs
        for t in range(top, m):
            e[t] = ul[t] - c1 * e[t - j1]
    elif len(pairs) == 3:
        (j1, c1), (j2, c2), (j3, c3) = pairs
        for t in range(top, m):
            e[t] = ul[t] - c1 * e[t - j1] - c2 * e[t - j2] - c3 * e[t - j3]
    else:
        for t in range(top, m):
            acc = ul[t]
            for j, c in pairs:
                acc -= c * e[t - j]
            e[t] = acc
    return np.array(e), r


def _lm(fun, x0, max_iter: int = 100, tol: float = 1e-10):
    """Levenberg-Marquardt on a residual vector function; returns (x, J, ok)."""
    x = np.asarray(x0, dtype=float)
    r = fun(x)
    f = float(r @ r)
    lam = 1e-3
    ok = False
    J = None
    for _ in range(max_iter):
        J = np.empty((len(r), len(x)))
        for k in range(len(x)):
            h = 1e-6 * max(1.0, abs(x[k]))
            xk = x.copy()
            xk[k] += h
            J[:, k] = (fun(xk) - r) / h
        g = J.T @ r
        H = J.T @ J
        improved = False
        for _ in range(20):
            A = H + lam * np.diag(np.diag(H) + 1e-12)
            try:
                step = -np.linalg.solve(A, g)
            except np.linalg.LinAlgError:
                lam *= 10
                continue
            xn = x + step
            rn = fun(xn)
            fn = float(rn @ rn)
            if np.isfinite(fn) and fn < f:
                improved = True
                break
            lam *= 10
        if not improved:
            ok = True  # no descent direction left: at a (local) minimum
            break
        rel = (f - fn) / max(f, 1e-300)
        x, r, f = xn, rn, fn
        lam = max(lam / 10, 1e-12)
        if rel < tol:
            ok = True
            break
    return x, J, ok


def conditioning(order, seasonal) -> int:
    """Observations a model needs before its first residual: p + d + m (P + D)."""
    p, d, _ = order
    P, D, _, m = seasonal
    return p + d + m * (P + D)


def fit_sarima(y, order=DEFAULT_ORDER, seasonal=DEFAULT_SEASONAL,
               score_from: int | None = None) -> dict:
    """Fit one model by CSS. Returns params, errors, sigma2, aic and residuals.

    ``score_from`` (an observation index) makes the fit and its AIC use only
    residuals from that observation on: models with different differencing
    orders are then compared on the same sample, as the grid search does.
    """
    y = np.asarray(y, dtype=float)
    p, d, q = order
    P, D, Q, m = seasonal
    k = p + q + P + Q
    scale = float(np.std(y)) or 1.0
    z = y / scale  # conditioning only; the model is scale-invariant
    skip = max(0, (score_from or 0) - conditioning(order, seasonal))

    def fun(theta):
        with np.errstate(all="ignore"):
            e, _ = _residuals(z, theta, order, seasonal)
        e = e[skip:]
        if not np.all(np.isfinite(e)) or np.max(np.abs(e)) > 1e8:
            return np.full(len(e), 1e8)
        return e

    if k:
        params, J, ok = _lm(fun, np.zeros(k))
    else:
        params, J, ok = np.zeros(0), np.zeros((0, 0)), True
    e, r = _residuals(z, params, order, seasonal)
    ok = ok and bool(np.all(np.isfinite(e)))
    scored = e[skip:]
    n_eff = len(scored)
    ssr = float(scored @ scored)
    sigma2_z = ssr / n_eff
    if k and J is not None and J.size:
        try:
            cov = sigma2_z * np.linalg.pinv(J.T @ J)
            se = np.sqrt(np.clip(np.diag(cov), 0, None))
        except np.linalg.LinAlgError:
            se = np.full(k, np.nan)
    else:
        se = np.zeros(0)
    sigma2 = sigma2_z * scale * scale
    llf = -0.5 * n_eff * (math.log(2 * math.pi * sigma2) + 1.0)
    aic = -2.0 * llf + 2.0 * (k + 1)
    return {"params": params, "se": se, "sigma2": sigma2, "aic": aic, "llf": llf,
            "resid": e * scale, "start": r, "converged": ok, "n_eff": n_eff}


def term_names(order, seasonal) -> list[str]:
    p, _, q = order
    P, _, Q, m = seasonal
    return ([f"ar.L{i}" for i in range(1, p + 1)] + [f"ma.L{i}" for i in range(1, q + 1)]
            + [f"ar.S.L{m * i}" for i in range(1, P + 1)] + [f"ma.S.L{m * i}" for i in range(1, Q + 1)])


def forecast_path(y, fit: dict, order, seasonal, steps: int):
    """Point forecasts and their standard errors for ``steps`` days ahead."""
    full_ar, ma = _polys(fit["params"], order, seasonal)
    y = list(np.asarray(y, dtype=float))
    e = [0.0] * fit["start"] + list(fit["resid"])
    for _ in range(steps):
        t = len(y)
        val = -sum(full_ar[i] * y[t - i] for i in range(1, len(full_ar)))
        val += sum(ma[j] * e[t - j] for j in range(1, len(ma)) if t - j >= 0)
        y.append(val)
        e.append(0.0)
    psi = [1.0]
    for j in range(1, steps):
        v = ma[j] if j < len(ma) else 0.0
        v -= sum(full_ar[i] * psi[j - i] for i in range(1, min(j, len(full_ar) - 1) + 1))
        psi.append(v)
    se = np.sqrt(fit["sigma2"] * np.cumsum(np.square(psi)))
    return np.array(y[-steps:]), se


# --------------------------------------------------------- Spark operators

def _cfg(row) -> tuple[tuple, tuple]:
    return ((int(row["ar"]), int(row["diff"]), int(row["ma"])),
            (int(row["sar"]), int(row["sdiff"]), int(row["sma"]), int(row["season"])))


GRID_SCHEMA = ("series_id string, ar int, diff int, ma int, sar int, sdiff int, sma int, "
               "season int, aic double, sigma2 double, converged boolean, error string")


def _grid_group(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("idx")
    first = pdf.iloc[0]
    order, seasonal = _cfg(first)
    out = {"series_id": first["series_id"], "ar": order[0], "diff": order[1], "ma": order[2],
           "sar": seasonal[0], "sdiff": seasonal[1], "sma": seasonal[2], "season": seasonal[3],
           "aic": None, "sigma2": None, "converged": False, "error": None}
    try:
        y = pdf["y"].dropna().to_numpy()
        fit = fit_sarima(y, order, seasonal, score_from=int(first["score_from"]))
        out.update(aic=fit["aic"], sigma2=fit["sigma2"], converged=fit["converged"])
    except Exception as exc:  # reported per model, not skipped
        out["error"] = f"{type(exc).__name__}: {exc}"
    return pd.DataFrame([out])


def sarima_grid(series: DataFrame, grid: list[tuple] | None = None,
                partitions: int | None = None) -> DataFrame:
    """T8+T9: fit every order of ``grid`` to every series; ``best`` marks the
    lowest AIC per series among the fits that converged.

    The grid is a fixed list (64 orders by default); each series row is
    repeated once per order so that every (series, order) is its own
    group. All orders are fitted and scored on the same observations (after
    the grid's longest conditioning window), so their AICs are comparable. ``repartition`` fixes the task count so the fits spread over
    executors even though the shuffled bytes are small.
    """
    grid = grid or order_grid()
    cfgs = F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(
        ("ar", "diff", "ma", "sar", "sdiff", "sma", "season"), g)]) for g in grid])
    keys = ["series_id", "ar", "diff", "ma", "sar", "sdiff", "sma", "season"]
    # Every order of the grid is scored on the same observations: those after
    # the longest conditioning window in the grid.
    score_from = max(conditioning(g[:3], g[3:]) for g in grid)
    tasks = (series.select("series_id", "idx", "y").withColumn("cfg", F.explode(cfgs))
                   .select("series_id", "cfg.*", "idx", "y",
                           F.lit(score_from).alias("score_from")))
    n = partitions or int(series.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fits = tasks.repartition(n, *keys).groupBy(*keys).applyInPandas(_grid_group, GRID_SCHEMA)
    best = F.min_by(F.struct(*keys[1:]), F.when(F.col("converged"), F.col("aic"))).over(Window.partitionBy("series_id"))
    return (fits.withColumn("_best", best)
                .withColumn("best", F.col("converged") & F.coalesce(F.struct(*keys[1:]) == F.col("_best"), F.lit(False)))
                .drop("_best"))


def _or_reason(schema: str):
    """A group function whose failure is one row of the group's ``series_id`` and the ``error``, so
    that a series too short or too plain for the model never fails the others."""
    names = [c.split()[0] for c in schema.split(", ")]

    def wrap(run):
        def guarded(pdf: pd.DataFrame) -> pd.DataFrame:
            try:
                out = run(pdf)
                out["error"] = None
            except Exception as exc:  # reported per series, not raised
                out = pd.DataFrame([dict.fromkeys(names) | {"series_id": pdf["series_id"].iloc[0], "error": f"{type(exc).__name__}: {exc}"}])
            # Whole numbers stay whole beside missing ones.
            return out.astype({c.split()[0]: "Int64" for c in schema.split(", ") if c.endswith("bigint")})
        return guarded
    return wrap


COEF_SCHEMA = ("series_id string, term string, coef double, std_err double, z double, "
               "p_value double, ci_lower double, ci_upper double, error string")


def _model_args(order, seasonal):
    return tuple(order), tuple(seasonal)


def sarima_coefficients(series: DataFrame, order=DEFAULT_ORDER,
                        seasonal=DEFAULT_SEASONAL) -> DataFrame:
    """Coefficient table (coef, std err, z, p, 95 % interval) and sigma2; a series that can't
    be fitted gives one row with the ``error``."""
    order, seasonal = _model_args(order, seasonal)

    @_or_reason(COEF_SCHEMA)
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("idx")
        fit = fit_sarima(pdf["y"].dropna().to_numpy(), order, seasonal)
        rows = []
        for name, c, s in zip(term_names(order, seasonal), fit["params"], fit["se"]):
            z = c / s if s > 0 else float("nan")
            p = 2 * (1 - 0.5 * (1 + math.erf(abs(z) / math.sqrt(2)))) if s > 0 else float("nan")
            rows.append((name, float(c), float(s), float(z), float(p),
                         float(c - Z95 * s), float(c + Z95 * s)))
        rows.append(("sigma2", fit["sigma2"], None, None, None, None, None))
        out = pd.DataFrame(rows, columns=["term", "coef", "std_err", "z", "p_value",
                                          "ci_lower", "ci_upper"])
        out.insert(0, "series_id", pdf["series_id"].iloc[0])
        return out

    return series.select("series_id", "idx", "y").groupBy("series_id").applyInPandas(run, COEF_SCHEMA)


PRED_SCHEMA = "series_id string, ds date, y double, yhat double, lower double, upper double, error string"


def sarima_predict(series: DataFrame, order=DEFAULT_ORDER, seasonal=DEFAULT_SEASONAL,
                   start: _dt.date | str | None = None) -> DataFrame:
    """T11+T12: one-step-ahead in-sample predictions with 95 % intervals,
    from ``start`` (default: the first day the model can predict). A series that
    can't be fitted gives one row with the ``error``."""
    order, seasonal = _model_args(order, seasonal)
    start = _dt.date.fromisoformat(start) if isinstance(start, str) else start

    @_or_reason(PRED_SCHEMA)
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["y"]).sort_values("idx")
        y = pdf["y"].to_numpy()
        fit = fit_sarima(y, order, seasonal)
        r = fit["start"]
        half = Z95 * math.sqrt(fit["sigma2"])
        yhat = y[r:] - fit["resid"]
        out = pd.DataFrame({"series_id": pdf["series_id"].iloc[r:].to_numpy(),
                            "ds": pdf["ds"].iloc[r:].to_numpy(), "y": y[r:], "yhat": yhat,
                            "lower": yhat - half, "upper": yhat + half})
        if start is not None:
            out = out[pd.to_datetime(out["ds"]) >= pd.Timestamp(start)]
        return out

    return (series.select("series_id", "ds", "idx", "y").groupBy("series_id")
                  .applyInPandas(run, PRED_SCHEMA))


FORECAST_SCHEMA = ("series_id string, prediction_date date, predicted_sales bigint, "
                   "yhat double, lower double, upper double, error string")


def sarima_forecast(series: DataFrame, steps: int = 7, order=DEFAULT_ORDER,
                    seasonal=DEFAULT_SEASONAL) -> DataFrame:
    """T14+T15: ``steps`` days after each series' last day; the sales figure
    is truncated to an integer as in the reference's forecast mart. A series that can't be
    fitted gives one row with the ``error``."""
    order, seasonal = _model_args(order, seasonal)

    @_or_reason(FORECAST_SCHEMA)
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.dropna(subset=["y"]).sort_values("idx")
        y = pdf["y"].to_numpy()
        fit = fit_sarima(y, order, seasonal)
        mean, se = forecast_path(y, fit, order, seasonal, steps)
        if not np.isfinite(mean).all():
            raise ValueError("the forecast is not finite")
        last = pd.Timestamp(pdf["ds"].iloc[-1])
        dates = [(last + pd.Timedelta(days=h)).date() for h in range(1, steps + 1)]
        return pd.DataFrame({"series_id": pdf["series_id"].iloc[0], "prediction_date": dates,
                             "predicted_sales": np.trunc(mean).astype("int64"), "yhat": mean,
                             "lower": mean - Z95 * se, "upper": mean + Z95 * se})

    return (series.select("series_id", "ds", "idx", "y").groupBy("series_id")
                  .applyInPandas(run, FORECAST_SCHEMA))


# The group functions above run in Python workers, which need not have this
# package on their path (e.g. a driver importing it from a checkout): ship
# this module's functions with the tasks, by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
