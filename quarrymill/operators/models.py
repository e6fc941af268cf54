"""Regression models of single series, fitted in Arrow tasks, all series of a length at a time.

Each key is a few hundred numbers; Spark deals the keys out. The fits are least squares in numpy, close
to but not the same as the libraries that the models are known from.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import fit_alike, series_rows

def _design(t: np.ndarray, n: int, order: int, knots: int) -> np.ndarray:
    """Trend with changes of slope in the first 80 % of the history, and a Fourier year."""
    at = np.linspace(0, 0.8 * n, knots + 2)[1:-1]
    cols = [np.ones_like(t), t / n, *(np.maximum(t - a, 0) / n for a in at)]
    cols += [f(2 * np.pi * k * t / 12) for k in range(1, order + 1) for f in (np.sin, np.cos)]
    return np.stack(cols, axis=1)


def trend_and_season(ys: np.ndarray, horizon: int, order: int = 3, knots: int = 6, prior: float = 0.05) -> tuple[np.ndarray, np.ndarray]:
    """(forecast, residual spread) of series of one length, a row each: ridge regression, slope changes and seasons drawn to 0.

    Each series is solved by itself, so that its last bits do not depend on the others.
    """
    n = ys.shape[1]
    x = _design(np.arange(n, dtype=float), n, order, knots)
    weight = np.concatenate([[1e-6, 1e-6], np.full(knots, 1 / (prior * n)), np.full(2 * order, 0.1)])
    beta = np.linalg.solve(x.T @ x + np.diag(weight), x.T @ ys[..., None])
    ahead = _design(np.arange(n, n + horizon, dtype=float), n, order, knots) @ beta
    return ahead[..., 0], np.std(ys - (x @ beta)[..., 0], axis=1)


MODELS = {"trend_and_season": trend_and_season}


def fit_models(grid: DataFrame, model: str, horizon: int = 6, min_train: int = 24, band: float = 1.96) -> DataFrame:
    """(key, step, target_month, yhat, yhat_lower, yhat_upper), clipped at 0; shorter series give no rows."""
    fit = MODELS[model]
    rows = series_rows(grid, min_train).select("key", "ys", F.date_from_unix_date(F.element_at("days", -1)).alias("last"))

    def one(c: dict[str, list]) -> list[dict]:
        yhat, spread = fit(np.array(c["ys"], float), horizon)
        wide = band * spread[:, None]
        cut = [np.maximum(x, 0).tolist() for x in (yhat, yhat - wide, yhat + wide)]
        return [{"last": last, "path": [dict(zip(("yhat", "yhat_lower", "yhat_upper"), p, strict=True)) for p in zip(*own, strict=True)]} for last, *own in zip(c["last"], *cut, strict=True)]

    fitted = fit_alike(rows, ["ys"], one, "last date, path array<struct<yhat:double,yhat_lower:double,yhat_upper:double>>")
    steps = fitted.select("key", "last", F.posexplode("path").alias("pos", "f"))
    return steps.select("key", (F.col("pos") + 1).alias("step"), F.add_months("last", F.col("pos") + 1).alias("target_month"), "f.*")
