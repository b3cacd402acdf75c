"""Demand forecasting: additive trend and seasonality, one fit per series.

The model follows Taylor and Letham, "Forecasting at Scale" (2018): a piecewise-linear trend
with shrunken slope changes plus yearly and weekly Fourier terms. It is fitted by penalised
least squares; results are not those of any particular library.

Spark reduces the facts to one row per series and day, fills gaps and spreads the series;
a task fits one series at a time. A series has at most one row per calendar day, so a group
stays small however many sales lie behind it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from larder.operators.gold import training_series
from larder.session import ship_package
from larder.sources.tables import Lake

# --- fixed values that results must agree on --------------------------------------

DATE_COLUMNS = ("date", "order_date_id", "ds")
VALUE_COLUMNS = ("sales_qty", "quantity", "qty", "total_items_sold")
FORECAST_DAYS = 30
RETRAIN_DAYS = 7
CV_PERIOD_DAYS = 30
CV_HORIZON_DAYS = 30
CV_MIN_INITIAL_DAYS = 30
Z80 = 1.2815515655446004


# --- series preparation (plain Spark) --------------------------------------------------


def daily_totals(
    df: DataFrame, date: str | None = None, value: str | None = None, by: Sequence[str] = ()
) -> DataFrame:
    """Daily sums as ``ds`` and ``y``; the columns are picked by their usual names."""
    date = date or next(c for c in DATE_COLUMNS if c in df.columns)
    value = value or next(c for c in VALUE_COLUMNS if c in df.columns)
    return (
        df.filter(F.col(date).isNotNull())
        .groupBy(*by, F.col(date).cast("date").alias("ds"))
        .agg(F.sum(value).cast("double").alias("y"))
    )


def zero_fill_daily(daily: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Every day from a series' first to its last; days without a row have 0.

    The days are added as zero rows and summed with the data: one aggregation, no join.
    """
    limits = daily.groupBy(*by).agg(F.min("ds").alias("first"), F.max("ds").alias("last"))
    days = limits.select(*by, F.explode(F.sequence("first", "last")).alias("ds"), F.lit(0.0).alias("y"))
    return (
        daily.select(*by, "ds", F.coalesce("y", F.lit(0.0)).alias("y"))
        .unionByName(days)
        .groupBy(*by, "ds")
        .agg(F.sum("y").alias("y"))
    )


# --- the model (small, per series) ------------------------------------------------------


@dataclass(frozen=True)
class Additive:
    """Settings of the additive model. Daily terms are constant on whole days and are
    accepted without effect."""

    changepoint_prior_scale: float = 0.05
    yearly: bool = True
    weekly: bool = True
    daily: bool = False
    changepoints: int = 25
    changepoint_range: float = 0.8
    seasonality_prior_scale: float = 10.0
    draws: int = 1000
    seed: int = 0

    def fit_predict(self, days: np.ndarray, y: np.ndarray, future: np.ndarray) -> np.ndarray:
        """Forecast, lower and upper bound (80 %) for ``future`` day numbers, from history.

        Up to the last day of history the bounds are those of the noise. After it the trend is uncertain too: see :meth:`_ahead`.
        """
        start, span = days.min(), max(float(days.max() - days.min()), 1.0)
        scale = max(float(np.abs(y).max()), 1e-9)
        knots = self._knots(days, start, span)
        x = self._design(days, start, span, knots)
        target = y / scale
        slopes = slice(2, 2 + len(knots))
        penalty = np.full(x.shape[1], 1.0 / self.seasonality_prior_scale**2)
        penalty[:2] = 1.0 / 5.0**2
        weights, noise = np.zeros(x.shape[1]), 0.1
        for _ in range(8):
            # Reweighting turns the Laplace prior of slope changes into a quadratic one.
            penalty[slopes] = 1.0 / (self.changepoint_prior_scale * (np.abs(weights[slopes]) + 1e-3))
            gram = x.T @ x / noise**2 + np.diag(penalty)
            weights = np.linalg.solve(gram, x.T @ target / noise**2)
            noise = max(float(np.std(target - x @ weights)), 1e-6)
        mean = self._design(future, start, span, knots) @ weights
        # Eigenvalues are never below the smallest penalty; rounding may say otherwise where there is no noise.
        values, vectors = np.linalg.eigh(gram)
        root = vectors / np.sqrt(np.maximum(values, penalty.min()))
        # Residuals are smaller than the noise by the share of the days that the fit used up.
        used = min(float(np.sum((x @ root) ** 2)) / noise**2, len(days) - 1.0)
        noise *= np.sqrt(len(days) / (len(days) - used))
        low, high = np.full(len(future), -Z80 * noise), np.full(len(future), Z80 * noise)
        later = future > days.max()
        if later.any():
            # The fit shrinks slope changes; their size as the fit leaves it open is the root of both squares.
            changes = np.sqrt(weights[slopes] ** 2 + np.sum(root[slopes] ** 2, axis=1))
            open_ = self._design(future[later], start, span, knots) @ root
            low[later], high[later] = self._ahead((future[later] - days.max()) / span, changes, noise, open_)
        return np.column_stack([mean, mean + low, mean + high]) * scale

    def _ahead(self, ahead: np.ndarray, changes: np.ndarray, noise: float, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Tenth and ninetieth percentile of what may be added to the forecast at times ``ahead`` of the history's end (history: length one).

        Every draw is a possible future: from the last knot on slope changes come as often as the knots did and are as large as
        the fitted ones are on average (Poisson and Laplace), weights vary as the fit leaves them open (``open_``: days by independent
        parts), and each day has its noise. The seed fixes the draws.
        """
        rng = np.random.default_rng(self.seed)
        order = np.argsort(ahead, kind="stable")
        at = ahead[order]
        trend = np.zeros((self.draws, len(at)))
        if len(changes):
            since = 1.0 - self.changepoint_range
            number = rng.poisson(len(changes) / self.changepoint_range * (at[-1] + since), self.draws)
            draw = np.repeat(np.arange(self.draws), number)
            time = rng.uniform(-since, at[-1], len(draw))
            size = rng.laplace(0.0, max(float(np.mean(np.abs(changes))), 1e-12), len(draw))
            # Of a change after the last knot, the fit's last straight piece takes up what a line of least squares does.
            part = np.minimum(time / since + 1.0, 1.0) if since else np.ones_like(time)
            missed = part**2 * (3.0 - 2.0 * part)
            level = since * ((1.0 - part) - (1.0 - part) ** 2 / 2.0 - (1.0 - missed) / 2.0)
            # A change counts from the first day after it: sums of slopes and of slopes times their time give the trend of all days.
            first = np.searchsorted(at, time)
            slope, offset = np.zeros_like(trend), np.zeros_like(trend)
            np.add.at(slope, (draw, first), size * missed)
            np.add.at(offset, (draw, first), size * (np.maximum(time, 0.0) - level))
            trend = np.cumsum(slope, axis=1) * at - np.cumsum(offset, axis=1)
        trend += rng.standard_normal((self.draws, open_.shape[1])) @ open_[order].T
        ends = np.empty((2, len(at)))
        ends[:, order] = np.quantile(trend + rng.normal(0.0, noise, trend.shape), [0.1, 0.9], axis=0)
        return ends[0], ends[1]

    def solve(self, gram: np.ndarray, right: np.ndarray, square: float, n: int, slopes: slice) -> tuple[np.ndarray, float]:
        """Weights and noise from the normal equations alone: ``gram`` = X'X, ``right`` = X'y, ``square`` = y'y over ``n`` days.

        Residuals follow from the same sums, so the reweighting needs no second look at the days.
        """
        penalty = np.full(len(right), 1.0 / self.seasonality_prior_scale**2)
        penalty[:2] = 1.0 / 5.0**2
        weights, noise = np.zeros(len(right)), 0.1
        for _ in range(8):
            # Reweighting turns the Laplace prior of slope changes into a quadratic one.
            penalty[slopes] = 1.0 / (self.changepoint_prior_scale * (np.abs(weights[slopes]) + 1e-3))
            weights = np.linalg.solve(gram / noise**2 + np.diag(penalty), right / noise**2)
            # Column 0 is the constant, so the sum of residuals is the first entry of X'(y - Xw).
            mean = (right[0] - gram[0] @ weights) / n
            left = square - 2 * right @ weights + weights @ gram @ weights
            noise = max(float(np.sqrt(max(left / n - mean**2, 0.0))), 1e-6)
        return weights, noise

    def _knots(self, days: np.ndarray, start: float, span: float) -> np.ndarray:
        n = min(self.changepoints, int(len(days) * self.changepoint_range) - 1)
        return np.linspace(0, self.changepoint_range, n + 1)[1:] if n > 0 else np.empty(0)

    def _design(self, days: np.ndarray, start: float, span: float, knots: np.ndarray) -> np.ndarray:
        t = (days - start) / span
        columns = [np.ones_like(t), t, *(np.maximum(t - k, 0.0) for k in knots)]
        for enabled, period, order in ((self.yearly, 365.25, 10), (self.weekly, 7.0, 3)):
            if enabled:
                for k in range(1, order + 1):
                    angle = 2.0 * np.pi * k * days / period
                    columns += [np.sin(angle), np.cos(angle)]
        return np.column_stack(columns)


def _day_numbers(dates: pd.Series) -> np.ndarray:
    return (pd.to_datetime(dates) - pd.Timestamp(1970, 1, 1)).dt.days.to_numpy(dtype=float)


def _dates(numbers: np.ndarray) -> list[dt.date]:
    return [dt.date(1970, 1, 1) + dt.timedelta(days=int(n)) for n in numbers]


def _key_schema(df: DataFrame, by: Sequence[str]) -> str:
    return "".join(f"`{c}` {df.schema[c].dataType.simpleString()}, " for c in by)


def _series(df: DataFrame, by: Sequence[str]) -> tuple[DataFrame, list[str]]:
    """The frame with a column to group by also where there is one series only."""
    return (df, list(by)) if by else (df.withColumn("_series", F.lit(0)), ["_series"])


# --- forecasts ---------------------------------------------------------------------------


def forecast_daily(
    daily: DataFrame, by: Sequence[str] = (), horizon: int = FORECAST_DAYS, model: Additive = Additive()
) -> DataFrame:
    """Fitted values for the history and forecasts for ``horizon`` days after it."""
    ship_package(daily.sparkSession)
    grouped, keys = _series(daily, by)

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ds")
        days, y = _day_numbers(rows["ds"]), rows["y"].to_numpy(dtype=float)
        wanted = np.concatenate([days, days.max() + np.arange(1, horizon + 1)])
        result = model.fit_predict(days, y, wanted)
        out = pd.DataFrame(result, columns=["forecast_qty", "lower_bound", "upper_bound"])
        out.insert(0, "ds", _dates(wanted))
        out["historical_qty"] = np.concatenate([y, np.full(horizon, np.nan)])
        for name, part in zip(by, key):
            out[name] = part
        return out[[*by, "ds", "forecast_qty", "lower_bound", "upper_bound", "historical_qty"]]

    schema = _key_schema(daily, by) + "ds date, forecast_qty double, lower_bound double, upper_bound double, historical_qty double"
    fitted = grouped.groupBy(*keys).applyInPandas(fit, schema)
    return fitted.withColumn("historical_qty", F.nanvl("historical_qty", F.lit(None).cast("double")))


def demand_forecast(
    sales: DataFrame,
    horizon: int = FORECAST_DAYS,
    changepoint_prior_scale: float = 0.10,
    yearly: bool = True,
    weekly: bool = True,
    by: Sequence[str] = (),
    date: str | None = None,
    value: str | None = None,
) -> DataFrame:
    """Daily demand with its forecast and 80 % bounds, per series; future days have no
    ``historical_qty``."""
    series = zero_fill_daily(daily_totals(sales, date, value, by), by)
    return forecast_daily(series, by, horizon, Additive(changepoint_prior_scale, yearly, weekly))


def walk_forward_cv(
    series: DataFrame,
    by: Sequence[str] = (),
    initial: int | None = None,
    period: int = CV_PERIOD_DAYS,
    horizon: int = CV_HORIZON_DAYS,
    model: Additive = Additive(0.10),
) -> DataFrame:
    """Forecasts from earlier cutoffs against what happened: ``cutoff, ds, y, yhat``.

    Cutoffs step back by ``period`` from ``horizon`` days before the end, as long as
    ``initial`` days (default: half the history, at least 30) lie before them. A series
    too short for one cutoff gives no rows. A task walks along a series once and fits every
    cutoff from running sums, see :class:`Prefixes`.
    """
    ship_package(series.sparkSession)
    grouped, keys = _series(series, by)
    columns = [*by, "cutoff", "ds", "y", "yhat"]

    def fit(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("ds")
        days, y = _day_numbers(rows["ds"]), rows["y"].to_numpy(dtype=float)
        length = int(days[-1] - days[0])
        lead = max(CV_MIN_INITIAL_DAYS, length // 2) if initial is None else initial
        steps = (length - horizon - lead) // period
        if steps < 0:
            return pd.DataFrame(columns=columns)
        cutoffs = days[-1] - horizon - period * np.arange(steps, -1, -1)
        parts = []
        for cutoff, predicted, ahead in Prefixes(model, days, y).forecasts(cutoffs, horizon):
            part = pd.DataFrame({"ds": _dates(days[ahead]), "y": y[ahead], "yhat": predicted})
            part["cutoff"] = _dates(np.array([cutoff]))[0]
            parts.append(part)
        out = pd.concat(parts)
        for name, part in zip(by, key):
            out[name] = part
        return out[columns]

    schema = _key_schema(series, by) + "cutoff date, ds date, y double, yhat double"
    return grouped.groupBy(*keys).applyInPandas(fit, schema)


class Prefixes:
    """Fits of one series up to many cutoffs from running normal equations.

    Knots lie on one grid of days for all cutoffs; a cutoff uses those in the first ``changepoint_range`` of its history. So the
    columns are the same for every cutoff but for their scale: X'X and X'y are summed up day by day, and a fit
    takes them as they stand at its cutoff. No history is read twice.
    """

    def __init__(self, model: Additive, days: np.ndarray, y: np.ndarray):
        self.model, self.days, self.y = model, days, y
        start, span = days[0], max(float(days[-1] - days[0]), 1.0)
        self.knots = start + np.linspace(0, model.changepoint_range, model.changepoints + 1)[1:] * span
        t = days - start
        trend = np.column_stack([np.ones_like(t), t, *(np.maximum(days - k, 0.0) for k in self.knots)])
        season = model._design(days, 0.0, 1.0, np.empty(0))[:, 2:]
        self.columns = np.column_stack([trend, season])

    def forecasts(self, cutoffs: np.ndarray, horizon: int):
        """``cutoff, forecast, places of the days ahead`` for ascending cutoffs."""
        x, y, n_knots = self.columns, self.y, len(self.knots)
        gram, right, square, done = np.zeros((x.shape[1],) * 2), np.zeros(x.shape[1]), 0.0, 0
        for cutoff in cutoffs:
            upto = int(np.searchsorted(self.days, cutoff, side="right"))
            new = slice(done, upto)
            gram, right, square, done = gram + x[new].T @ x[new], right + x[new].T @ y[new], square + float(y[new] @ y[new]), upto
            ahead = np.flatnonzero((self.days > cutoff) & (self.days <= cutoff + horizon))
            yield cutoff, self._at(upto, gram, right, square, ahead), ahead

    def _at(self, upto: int, gram: np.ndarray, right: np.ndarray, square: float, ahead: np.ndarray) -> np.ndarray:
        days, n_knots = self.days[:upto], len(self.knots)
        span = max(float(days[-1] - days[0]), 1.0)
        used = np.flatnonzero(self.knots <= days[0] + self.model.changepoint_range * span)
        chosen = np.concatenate([[0, 1], 2 + used, np.arange(2 + n_knots, self.columns.shape[1])])
        # Trend columns are counted in days; the priors hold for a history of length one and values up to one.
        units = np.ones(len(chosen))
        units[1 : 2 + len(used)] = 1.0 / span
        scale = max(float(np.abs(self.y[:upto]).max()), 1e-9)
        slopes = slice(2, 2 + len(used))
        part = gram[np.ix_(chosen, chosen)] * np.outer(units, units)
        weights, _ = self.model.solve(part, right[chosen] * units / scale, square / scale**2, upto, slopes)
        return self.columns[np.ix_(ahead, chosen)] @ (weights * units) * scale


def rolling_mape(cv: DataFrame, by: Sequence[str] = (), window: float = 0.1) -> DataFrame:
    """Absolute percentage error by horizon, ``horizon_days, mape``, as a rolling mean over the share ``window`` of all errors.

    Errors are ordered by the days between cutoff and forecast day; the mean at a horizon is over the last errors up to
    it. Where the window begins within a horizon, that horizon's mean stands for the part. Horizons with fewer errors
    up to them have no row, and a series with a day of no demand has none at all.
    """
    keys = list(by)
    days = F.datediff(F.col("ds").cast("date"), F.col("cutoff").cast("date"))
    error = F.abs((F.col("y") - F.col("yhat")) / F.nullif(F.col("y"), F.lit(0.0)))
    per_day = cv.groupBy(*keys, days.alias("horizon_days")).agg(
        F.avg(error).alias("mean"), F.count(F.lit(1)).alias("n"), F.min(F.abs("y")).alias("least")
    )
    series, ordered = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("horizon_days")
    # One row per horizon and series from here on.
    per_day = per_day.withColumns(
        {"upto": F.sum("n").over(ordered), "all": F.sum("n").over(series), "least": F.min("least").over(series)}
    ).filter("least >= 1e-8")
    size = F.greatest(F.floor(F.col("all") * window), F.lit(1))
    ends = per_day.select(*keys, "horizon_days", F.col("upto").alias("end"), size.alias("size")).filter("end >= size")
    inside = per_day.select(*keys, F.col("horizon_days").alias("_day"), "mean", "upto", (F.col("upto") - F.col("n")).alias("before"))
    on = [ends[k].eqNullSafe(inside[k]) for k in keys] + [inside["_day"] <= ends["horizon_days"]]
    share = F.greatest(F.col("upto") - F.greatest("before", F.col("end") - F.col("size")), F.lit(0)) / F.col("size")
    met = ends.join(inside, on).select(*(ends[k] for k in keys), "horizon_days", (share * F.col("mean")).alias("part"))
    return met.groupBy(*keys, "horizon_days").agg(F.sum("part").alias("mape"))


def mean_mape(cv: DataFrame, by: Sequence[str] = (), window: float = 0.1) -> DataFrame:
    """Mean of :func:`rolling_mape` over its horizons, in percent."""
    return rolling_mape(cv, by, window).groupBy(*by).agg((F.avg("mape") * 100).alias("mape_pct"))


def retrain(demand: DataFrame, horizon: int = RETRAIN_DAYS, generated_at: Column | None = None) -> DataFrame:
    """Forecast of the next days from the daily demand table, stamped with the run's time."""
    history = training_series(demand).select("ds", F.col("y").cast("double").alias("y"))
    fitted = forecast_daily(history, (), horizon, Additive(yearly=True, weekly=True, daily=True))
    future = fitted.filter(F.col("historical_qty").isNull())
    return future.select(
        F.col("ds").cast("timestamp_ntz").alias("ds"),
        F.col("forecast_qty").alias("yhat"),
        F.col("lower_bound").alias("yhat_lower"),
        F.col("upper_bound").alias("yhat_upper"),
        (F.localtimestamp() if generated_at is None else generated_at).alias("prediction_generated_at"),
    )


def retrain_and_append(lake: Lake, demand: DataFrame, horizon: int = RETRAIN_DAYS) -> int | None:
    """Append the next days' forecast to the prediction history; stops when there is no demand."""
    if demand.filter(F.col("date_id").isNotNull()).isEmpty():
        return None
    return lake.append_predictions(retrain(demand, horizon))
