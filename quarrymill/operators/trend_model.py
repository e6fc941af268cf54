"""Piecewise-linear trend with Laplace slope changes times (1 + season), with simulated bands.

With times scaled to 0..1 over the history and values divided by their largest magnitude,

    value = (offset + slope t + sum of changes_j (t - s_j)+) (1 + Fourier terms of the year) + noise,

the most likely parameters are sought under normal priors of offset, slope (sd 5) and Fourier terms
(sd 10), Laplace priors of the slope changes (scale `prior`, or `known_prior` where a changeover is
known) and a half-normal prior of the noise (sd 0.5). Trend given season is least squares with an
absolute penalty (coordinate descent, then exact steps on the changes that are not 0), season given
trend is ridge regression, the noise has a closed form; they are solved in turn until the
posterior stands still. Bands are quantiles of simulated futures: slope changes as often and as
large as in the history, and noise, drawn from a generator that is seeded by the key.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import fit_alike, series_rows, solve

CHANGES, REACH, ORDER, YEAR = 25, 0.8, 3, 365.25
LEVEL_SD, SEASON_SD, NOISE_SD = 5.0, 10.0, 0.5
PRIOR, KNOWN_PRIOR = 0.05, 0.25
LEAST_NOISE = 1e-4
#: Series that are brought forward at once, with some 25 kB each.
TOGETHER = 2048


def change_places(n: int) -> np.ndarray:
    """Months of the history, from 0, at which the slope may change: evenly over its first 80 %."""
    seen = int(np.floor(n * REACH))
    count = min(CHANGES, seen - 1)
    return np.linspace(0, seen - 1, count + 1).round().astype(int)[1:] if count > 0 else np.zeros(0, int)


def year_terms(days: np.ndarray) -> np.ndarray:
    angle = 2 * np.pi * np.outer(days / YEAR, np.arange(1, ORDER + 1))
    return np.stack([np.sin(angle), np.cos(angle)], axis=2).reshape(len(days), 2 * ORDER)


def _each(matrix: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """matrix x for every row x, one by one: a product of all at once rounds by how many there are."""
    return (matrix @ rows[..., None])[..., 0]


@dataclass
class Fitted:
    """Parameters of many series over the same days; the first axis is the series."""

    days: np.ndarray
    trend: np.ndarray  # offset, slope, slope changes
    season: np.ndarray
    noise: np.ndarray
    scale: np.ndarray

    def times(self, days: np.ndarray) -> np.ndarray:
        return (days - self.days[0]) / max(self.days[-1] - self.days[0], 1)

    def hinges(self, t: np.ndarray) -> np.ndarray:
        at = self.times(self.days[change_places(len(self.days))])
        return np.concatenate([np.ones((len(t), 1)), t[:, None], np.maximum(t[:, None] - at, 0)], axis=1)

    def trend_at(self, days: np.ndarray) -> np.ndarray:
        return _each(self.hinges(self.times(days)), self.trend)

    def season_at(self, days: np.ndarray) -> np.ndarray:
        return _each(year_terms(days), self.season)


def _cost(rest: np.ndarray, trend: np.ndarray, season: np.ndarray, noise: np.ndarray, prior: np.ndarray) -> np.ndarray:
    fit = rest.shape[1] * np.log(noise) + (rest**2).sum(1) / (2 * noise**2)
    drawn = (trend[:, :2] ** 2).sum(1) / (2 * LEVEL_SD**2) + np.abs(trend[:, 2:]).sum(1) / prior
    return fit + drawn + (season**2).sum(1) / (2 * SEASON_SD**2) + noise**2 / (2 * NOISE_SD**2)


def penalised_cost(f: Fitted, y: np.ndarray, prior: np.ndarray) -> np.ndarray:
    """Minus the logarithm of the posterior of the scaled values y, but for constants."""
    return _cost(y - f.trend_at(f.days) * (1 + f.season_at(f.days)), f.trend, f.season, f.noise, prior)


def _noise(rest: np.ndarray) -> np.ndarray:
    """The noise at which n log s + ssr / 2 s^2 + s^2 / 2 NOISE_SD^2 is least."""
    n, ssr = rest.shape[1], (rest**2).sum(1)
    variance = NOISE_SD**2 / 2 * (np.sqrt(n * n + 4 * ssr / NOISE_SD**2) - n)
    return np.maximum(np.sqrt(variance), LEAST_NOISE)


def _penalised_squares(gram: np.ndarray, target: np.ndarray, x: np.ndarray, ridge: np.ndarray, pull: np.ndarray, sweeps: int) -> np.ndarray:
    """Better x for x' gram x / 2 - target' x + ridge/2 (x_0^2 + x_1^2) + pull sum |x_j|, j > 1."""
    x, width = x.copy(), x.shape[1]
    product = (gram @ x[..., None])[..., 0]
    for _ in range(sweeps):
        for j in range(width):
            g = np.maximum(gram[:, j, j], 1e-12)
            want = target[:, j] - product[:, j] + g * x[:, j]
            new = want / (g + ridge) if j < 2 else np.sign(want) * np.maximum(np.abs(want) - pull, 0) / g
            product += gram[:, j] * (new - x[:, j])[:, None]
            x[:, j] = new
    # on the changes that are not 0 the penalty is linear: go to its minimum, or to where the first sign turns
    for _ in range(3):
        live = x != 0
        live[:, :2] = True
        a = np.where(live[:, :, None] & live[:, None, :], gram, 0.0)
        b = target - pull[:, None] * np.sign(x)
        b[:, :2] = target[:, :2]
        diagonal = np.where(live, 1e-12, 1.0)
        diagonal[:, :2] += ridge[:, None]
        a[:, np.arange(width), np.arange(width)] += diagonal
        goal = solve(a, np.where(live, b, 0.0))
        turns = live & (np.sign(goal) != np.sign(x))
        turns[:, :2] = False
        share = np.where(turns, x / np.where(turns, x - goal, 1.0), 1.0)
        step = share.min(axis=1)
        moved = x + step[:, None] * (goal - x)
        moved[turns & (share <= step[:, None])] = 0.0
        moved[~live] = 0.0
        x = moved
        if (step >= 1).all():
            break
    return x


def _settle(base: np.ndarray, waves: np.ndarray, y: np.ndarray, prior: np.ndarray, trend: np.ndarray, rounds: int, tolerance: float) -> tuple[np.ndarray, np.ndarray]:
    """(trend, season) at which the cost of each series stands still; a series leaves the rounds when its own does."""
    found, seasons = trend.copy(), np.zeros((len(y), waves.shape[1]))
    at, season, cost = np.arange(len(y)), seasons.copy(), np.full(len(y), np.inf)
    for _ in range(rounds):
        swing = 1 + _each(waves, season)
        noise = _noise(y - _each(base, trend) * swing)
        z = base * swing[:, :, None]
        turned = z.transpose(0, 2, 1)
        trend = _penalised_squares(turned @ z, (turned @ y[..., None])[..., 0], trend, noise**2 / LEVEL_SD**2, noise**2 / prior, 3)
        level = _each(base, trend)
        w = waves * level[:, :, None]
        turned = w.transpose(0, 2, 1)
        gram = turned @ w + (noise**2 / SEASON_SD**2)[:, None, None] * np.eye(waves.shape[1])
        season = solve(gram, (turned @ (y - level)[..., None])[..., 0])
        before, cost = cost, _cost(y - level * (1 + _each(waves, season)), trend, season, noise, prior)
        found[at], seasons[at] = trend, season
        going = before - cost > tolerance * (1 + np.abs(cost))
        if not going.any():
            break
        at, y, prior, trend, season, cost = (v[going] for v in (at, y, prior, trend, season, cost))
    return found, seasons


def fit_batch(days: np.ndarray, ys: np.ndarray, prior: np.ndarray, rounds: int = 400, tolerance: float = 1e-14) -> Fitted:
    """The most likely parameters of series (a row each) over the same days."""
    scale = np.abs(ys).max(axis=1)
    scale[scale == 0] = 1.0
    y = ys / scale[:, None]
    width = 2 + len(change_places(len(days)))
    f = Fitted(days, np.zeros((len(y), width)), np.zeros((len(y), 2 * ORDER)), np.ones(len(y)), scale)
    f.trend[:, 0], f.trend[:, 1] = y[:, 0], y[:, -1] - y[:, 0]
    flat = y.max(axis=1) == y.min(axis=1)
    base, waves = f.hinges(f.times(days)), year_terms(days)
    for i in range(0, len(y), TOGETHER):
        own = slice(i, i + TOGETHER)
        f.trend[own], f.season[own] = _settle(base, waves, y[own], prior[own], f.trend[own], rounds, tolerance)
    f.noise = _noise(y - f.trend_at(days) * (1 + f.season_at(days)))
    if flat.any():  # a constant has nothing to fit
        f.trend[flat], f.season[flat], f.noise[flat] = 0.0, 0.0, LEAST_NOISE
        f.trend[flat, 0] = y[flat, 0]
    return f


def _limits(paths: np.ndarray, width: float) -> np.ndarray:
    """The quantiles (1 - width) / 2 and (1 + width) / 2 of each row, between neighbours in proportion."""
    last = paths.shape[1] - 1
    places = [last * (1 - width) / 2, last * (1 + width) / 2]
    ends = [(int(x), min(int(x) + 1, last), x - int(x)) for x in places]
    paths.partition(sorted({k for a, b, _ in ends for k in (a, b)}), axis=1)
    return np.stack([paths[:, a] + (paths[:, b] - paths[:, a]) * share for a, b, share in ends])


def forecast_batch(f: Fitted, ahead: np.ndarray, seeds: list[int], draws: int, width: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(forecast, lower, upper) of each series at the days ahead, in its own units."""
    t, season, level = f.times(ahead), f.season_at(ahead), f.trend_at(ahead)
    span, count = max(t[-1] - 1.0, 0.0), f.trend.shape[1] - 2
    size = np.abs(f.trend[:, 2:]).mean(axis=1) + 1e-8 if count else np.full(len(level), 1e-8)
    low, high = np.empty_like(level), np.empty_like(level)
    for i, seed in enumerate(seeds):
        rng = np.random.default_rng(seed)
        changes = rng.poisson(count * span, draws)
        whose, drawn = np.repeat(np.arange(draws), changes), int(changes.sum())
        at, delta = 1 + span * rng.random(drawn), rng.laplace(0, size[i], drawn)
        bends = np.stack([np.bincount(whose, delta * np.maximum(x - at, 0), draws) for x in t])
        paths = (level[i][:, None] + bends) * (1 + season[i])[:, None] + f.noise[i] * rng.standard_normal((len(t), draws))
        low[i], high[i] = _limits(paths, width)
    return tuple(x * f.scale[:, None] for x in (level * (1 + season), low, high))


RESULT = "trend_at_end double, slope_changes int, places int, noise double, min_pct double, max_pct double, forecast array<struct<yhat:double,yhat_lower:double,yhat_upper:double>>"


def fit_trends(grid: DataFrame, known: DataFrame | None = None, *, horizon: int = 6, min_train: int = 24, prior: float = PRIOR, known_prior: float = KNOWN_PRIOR, width: float = 0.95, draws: int = 1000, least_change: float = 0.01, ahead: bool = True) -> DataFrame:
    """(key, last, known_changeover, trend_at_end, slope_changes, places, noise, min_pct, max_pct, forecast) of each series.

    grid: (key, month, units); known: (key) of series with a known changeover, which get the wider prior.
    Series of fewer than min_train months give no rows. last: their last month; trend_at_end and noise
    are in the series' units; slope_changes counts scaled changes above least_change of the places where
    one may be; min_pct and max_pct are the season's swing over the last 12 months in percent of the
    trend. forecast: the next `horizon` months with a band of `width`, not below 0; null where not `ahead`,
    which saves simulating them. Equal series with equal keys give equal rows. One shuffle by key, one to
    join the flag and one to deal the series over all cores; fits run in Arrow batches.
    """
    rows = series_rows(grid, min_train)
    last = F.date_from_unix_date(F.element_at("days", -1))
    rows = rows.withColumn("last", last).withColumn("ahead", F.transform(F.sequence(F.lit(1), F.lit(horizon)), lambda h: F.unix_date(F.add_months(last, h))))
    if known is not None:
        flags = known.select(F.col("key").alias("_known")).distinct()
        rows = rows.join(flags, F.col("key") == F.col("_known"), "left").select(*rows.columns, F.col("_known").isNotNull().alias("known_changeover"))
    else:
        rows = rows.withColumn("known_changeover", F.lit(False))

    def fit(c: dict[str, list]) -> list[dict]:
        days = np.array(c["days"][0], float)
        f = fit_batch(days, np.array(c["ys"]), np.where(c["known_changeover"], known_prior, prior))
        futures = [None] * len(c["key"])
        if ahead:
            seeds = [zlib.crc32(str(k).encode()) for k in c["key"]]
            paths = [np.maximum(x, 0).tolist() for x in forecast_batch(f, np.array(c["ahead"][0], float), seeds, draws, width)]
            futures = [[{"yhat": a, "yhat_lower": b, "yhat_upper": z} for a, b, z in zip(*own, strict=True)] for own in zip(*paths, strict=True)]
        season, end = 100 * f.season_at(days[-12:]), f.trend_at(days[-1:])[:, 0] * f.scale
        return [
            {
                "last": c["last"][i], "known_changeover": c["known_changeover"][i], "trend_at_end": float(end[i]), "slope_changes": int((np.abs(f.trend[i, 2:]) > least_change).sum()),
                "places": f.trend.shape[1] - 2, "noise": float(f.noise[i] * f.scale[i]), "min_pct": float(season[i].min()), "max_pct": float(season[i].max()),
                "forecast": futures[i],
            }
            for i in range(len(c["key"]))
        ]

    return fit_alike(rows, ["days", "ahead"], fit, f"last date, known_changeover boolean, {RESULT}")


def trend_forecast(fitted: DataFrame) -> DataFrame:
    """fit_trends' rows to (key, step, target_month, yhat, yhat_lower, yhat_upper)."""
    steps = fitted.select("key", "last", F.posexplode("forecast").alias("pos", "f"))
    return steps.select("key", (F.col("pos") + 1).alias("step"), F.add_months("last", F.col("pos") + 1).alias("target_month"), "f.*")
