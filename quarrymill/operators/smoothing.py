"""Exponential smoothing with an additive trend, damped or linear, fitted by search inside each series.

The squared one-step errors are least over level weight a in [0, 1], trend weight b in [0, a], damping
in [0.8, 0.995] (1 for the linear form) and the two starting states. Errors are linear in the starting
states, so these are solved for exactly at every trial; the weights are searched from the best points
of a grid by steps in each direction that are halved where none helps. All series of a batch with the
same length are tried together.
"""

from __future__ import annotations

import itertools

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .batches import fit_alike

LEVELS, SHARES, DAMPINGS = (0.02, 0.1, 0.3, 0.5, 0.8, 0.98), (0.0, 0.1, 0.3, 0.6, 1.0), (0.8, 0.9, 0.97, 0.995)
LOWEST_DAMPING, HIGHEST_DAMPING, LEAST_STEP = 0.8, 0.995, 1e-6
#: Series that the whole grid is tried on at once.
TOGETHER = 256


def errors_squared(ys: np.ndarray, level: np.ndarray, share: np.ndarray, damping: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least sum of squared errors, last level and trend) of trials (trial, series); ys: (series, month).

    share: trend weight over level weight. States are kept as what they are without a start and how they
    change with each starting state. How they change depends on the weights only, so trials that are the
    same for all series may have one column of weights.
    """
    trend, keep = level * share, (1 - level * share) * damping
    own = np.broadcast_shapes(level.shape, (1, len(ys)))
    l0, b0 = np.zeros(own), np.zeros(own)
    l1, b1, l2, b2 = np.ones(level.shape), np.zeros(level.shape), np.zeros(level.shape), np.ones(level.shape)
    g00, g01, g02 = np.zeros(own), np.zeros(own), np.zeros(own)
    g11, g12, g22 = np.zeros(level.shape), np.zeros(level.shape), np.zeros(level.shape)
    for t in range(ys.shape[1]):
        p0, p1, p2 = l0 + damping * b0, l1 + damping * b1, l2 + damping * b2
        e0 = ys[:, t] - p0
        g00 += e0 * e0
        g01 -= e0 * p1
        g02 -= e0 * p2
        g11 += p1 * p1
        g12 += p1 * p2
        g22 += p2 * p2
        d0, d1, d2 = level * e0, -level * p1, -level * p2
        n0, n1, n2 = p0 + d0, p1 + d1, p2 + d2
        b0, b1, b2 = trend * (n0 - l0) + keep * b0, trend * (n1 - l1) + keep * b1, trend * (n2 - l2) + keep * b2
        l0, l1, l2 = n0, n1, n2
    ridge = 1e-9 * (g11 + g22 + 1e-12)
    a11, a22 = g11 + ridge, g22 + ridge
    scale = a11 * a22 - g12 * g12
    x1, x2 = (g12 * g02 - a22 * g01) / scale, (g12 * g01 - a11 * g02) / scale
    sse = g00 + 2 * (x1 * g01 + x2 * g02) + x1 * x1 * g11 + 2 * x1 * x2 * g12 + x2 * x2 * g22
    return np.maximum(sse, 0), np.stack([l0 + x1 * l1 + x2 * l2, b0 + x1 * b1 + x2 * b2], axis=-1)


def search(ys: np.ndarray, damped: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(level weight, share and damping; least error; last states) of each series."""
    grid = np.array(list(itertools.product(LEVELS, SHARES, DAMPINGS if damped else (1.0,))))
    weights = [grid[:, k, None] for k in range(3)]
    best = grid[np.concatenate([errors_squared(ys[i : i + TOGETHER], *weights)[0].argmin(axis=0) for i in range(0, len(ys), TOGETHER)])]
    low, high = np.array([0.0, 0.0, LOWEST_DAMPING]), np.array([1.0, 1.0, HIGHEST_DAMPING])
    step = np.tile([0.1, 0.15, 0.05], (len(ys), 1))
    moves = np.concatenate([np.zeros((1, 3)), np.eye(3)[: 3 if damped else 2], -np.eye(3)[: 3 if damped else 2]])
    found, least, states = best.copy(), np.full(len(ys), np.inf), np.zeros((len(ys), 2))
    at = np.arange(len(ys))  # series whose steps are not small yet
    while len(at):
        tried = best[None] + moves[:, None, :] * step[None]
        tried[..., :2] = np.clip(tried[..., :2], low[:2], high[:2])
        if damped:
            tried[..., 2] = np.clip(tried[..., 2], low[2], high[2])
        sse, ends = errors_squared(ys, tried[..., 0], tried[..., 1], tried[..., 2])
        pick, each = sse.argmin(axis=0), np.arange(len(ys))
        better = sse[pick, each] < sse[0] * (1 - 1e-12)
        pick = np.where(better, pick, 0)
        best = tried[pick, each]
        found[at], least[at], states[at] = best, sse[pick, each], ends[pick, each]
        step[~better] *= 0.5
        going = step[:, 0] > LEAST_STEP
        at, ys, best, step = at[going], ys[going], best[going], step[going]
    return found, least, states


def smoothed_forecasts(past: DataFrame, horizon: int, forms: tuple[bool, ...] = (True, False), least_months: int = 10) -> DataFrame:
    """(key, train_end, method, step, target_month, predicted, sse) of histories (key, train_end, ys), clipped at 0.

    forms: damped or not; method is 'ets_damped' or 'ets_linear'. Histories shorter than least_months give
    no rows. All forms are fitted in one pass over the histories.
    """
    rows = past.where(F.size("ys") >= least_months).select("key", "train_end", "ys")

    def fit(c: dict[str, list]) -> list[dict]:
        ys = np.array(c["ys"], float)
        made: list[dict] = [{"train_end": end, "fits": []} for end in c["train_end"]]
        for damped in forms:
            best, least, states = search(ys, damped)
            growth = np.cumsum(best[:, 2:] ** np.arange(1, horizon + 1), axis=1)
            ahead = np.maximum(states[:, :1] + growth * states[:, 1:], 0).tolist()
            for row, sse, path in zip(made, least.tolist(), ahead, strict=True):
                row["fits"].append({"method": "ets_damped" if damped else "ets_linear", "sse": sse, "path": path})
        return made

    fitted = fit_alike(rows, ["ys"], fit, "train_end date, fits array<struct<method:string,sse:double,path:array<double>>>")
    each = fitted.select("key", "train_end", F.explode("fits").alias("f"))
    steps = each.select("key", "train_end", "f.method", "f.sse", F.posexplode("f.path").alias("pos", "predicted"))
    return steps.select("key", "train_end", "method", (F.col("pos") + 1).alias("step"), F.add_months("train_end", F.col("pos") + 1).alias("target_month"), "predicted", "sse")


def smoothed_forecast(past: DataFrame, horizon: int, damped: bool, least_months: int = 10) -> DataFrame:
    """smoothed_forecasts of one form."""
    return smoothed_forecasts(past, horizon, (damped,), least_months)
