"""Seasonal autoregression against dense covariances and direct search, smoothing against plain loops."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarrymill.operators import arima, forecast, smoothing


def arrays(spark, series: dict):
    return spark.createDataFrame([(k, [float(x) for x in y]) for k, y in series.items()], "key long, ys array<double>").withColumn("train_end", F.to_date(F.lit("2000-12-01")))


def ar_series(seed, n, a, b, c, s=3.0):
    rng = random.Random(seed)
    y = [rng.gauss(20, 5) for _ in range(4)]
    while len(y) < n:
        y.append(c + a * y[-1] + b * y[-3] - a * b * y[-4] + rng.gauss(0, s))
    return y


def squared(y, a, b):
    d = np.array([y[t] - a * y[t - 1] - b * y[t - 3] + a * b * y[t - 4] for t in range(4, len(y))])
    return float(((d - d.mean()) ** 2).sum()), float(d.mean())


def test_fit_is_the_least_squares_of_a_fine_search(spark):
    series = {1: ar_series(1, 60, 0.5, 0.3, 5), 2: ar_series(2, 40, -0.6, 0.5, 12), 3: ar_series(3, 120, 0.2, -0.7, 30), 4: ar_series(4, 30, 0.0, 0.0, 9)}
    for r in arrays(spark, series).select("key", arima.fit(F.col("ys")).alias("f")).collect():
        y, f = series[r["key"]], r["f"]
        sse, c = squared(y, f["a"], f["b"])
        assert math.isclose(sse / (len(y) - 4), f["variance"], rel_tol=1e-6) and math.isclose(c, f["c"], rel_tol=1e-6, abs_tol=1e-8)
        grid = np.linspace(-1.2, 1.2, 97)
        assert sse <= min(squared(y, a, b)[0] for a in grid for b in grid) + 1e-6
        n = len(y) - 4
        assert math.isclose(f["log_likelihood"], -n / 2 * (math.log(2 * math.pi * sse / n) + 1), rel_tol=1e-9)


def dense_likelihood(y, a, b, c, variance, start_variance):
    """The values as linear functions of the four before the first and of the noise."""
    n = len(y)
    t = np.zeros((4, 4))
    t[0] = [a, 0, b, -a * b]
    t[1:, :3] = np.eye(3)
    weights, mean = np.zeros((n, 4 + n)), np.zeros(n)
    state, centre = np.concatenate([np.eye(4), np.zeros((4, n))], axis=1), np.zeros(4)
    for i in range(n):
        if i:
            state, centre = t @ state, t @ centre
            state[0, 4 + i] += 1
            centre[0] += c
        weights[i], mean[i] = state[0], centre[0]
    cov = weights @ np.diag([start_variance] * 4 + [variance] * n) @ weights.T
    d = np.array(y) - mean
    return -0.5 * (n * math.log(2 * math.pi) + np.linalg.slogdet(cov)[1] + d @ np.linalg.solve(cov, d))


@pytest.mark.parametrize("start", [25.0, 1e5])
def test_kalman_recursion_equals_dense_covariance(spark, start):
    y = ar_series(7, 36, 0.4, 0.2, 6)
    df = arrays(spark, {1: y, 2: y[:4]})
    args = [F.lit(x) for x in (0.4, 0.2, 6.0, 8.0, start)]
    got = {r["key"]: r["v"] for r in df.select("key", arima.state_space_likelihood(F.col("ys"), *args).alias("v")).collect()}
    want = {1: dense_likelihood(y, 0.4, 0.2, 6.0, 8.0, start), 2: dense_likelihood(y[:4], 0.4, 0.2, 6.0, 8.0, start)}
    assert all(math.isclose(got[k], want[k], rel_tol=1e-6) for k in want)
    held = df.where("key = 1").select(arima.state_space_likelihood(F.col("ys"), *args, held=4).alias("v")).first()["v"]
    assert math.isclose(held, want[1] - want[2], rel_tol=1e-6)


def test_fit_makes_the_recursions_likelihood_greatest(spark):
    y = ar_series(11, 50, 0.5, 0.3, 5)
    df = arrays(spark, {1: y}).withColumn("f", arima.fit(F.col("ys")))
    like = lambda da, db: arima.state_space_likelihood(F.col("ys"), F.col("f.a") + da, F.col("f.b") + db, F.col("f.c"), F.col("f.variance"), F.lit(1e9), held=4)
    r = df.select("f.log_likelihood", like(0, 0).alias("at"), *(like(x, y).alias(f"n{i}") for i, (x, y) in enumerate([(0.02, 0), (-0.02, 0), (0, 0.02), (0, -0.02)]))).first()
    assert math.isclose(r["at"], r["log_likelihood"], rel_tol=1e-4) and all(r[f"n{i}"] < r["at"] for i in range(4))


def test_seasonal_forecast_follows_the_recursion(spark):
    y, flat = ar_series(5, 48, 0.3, 0.5, 8), [6.0] * 30
    rows = arima.seasonal_ar(arrays(spark, {1: y, 2: flat, 3: y[:23]}), 6).orderBy("key", "step").collect()
    assert [r["key"] for r in rows] == [1] * 6 + [2] * 6
    f = arrays(spark, {1: y}).select(arima.fit(F.col("ys")).alias("f")).first()["f"]
    path = list(y)
    for _ in range(6):
        path.append(f["c"] + f["a"] * path[-1] + f["b"] * path[-3] - f["a"] * f["b"] * path[-4])
    assert np.allclose([r["yhat"] for r in rows[:6]], np.maximum(path[48:], 0))
    widths = [r["yhat_upper"] - r["yhat"] for r in rows[:6]]
    assert math.isclose(widths[0], 1.96 * math.sqrt(f["variance"]), rel_tol=1e-9) and all(a <= b + 1e-9 for a, b in zip(widths, widths[1:], strict=False))
    assert all(abs(r["yhat"] - 6) < 1e-6 and r["yhat_upper"] - r["yhat"] < 1e-3 for r in rows[6:])
    assert str(rows[0]["target_month"]) == "2001-01-01"


def plain_errors(y, level, trend, damping, l, b):
    out = 0.0
    for x in y:
        ahead = l + damping * b
        out += (x - ahead) ** 2
        new = level * x + (1 - level) * ahead
        l, b = new, trend * (new - l) + (1 - trend) * damping * b
    return out, l, b


def trending(seed, n):
    rng = random.Random(seed)
    return [20 + 0.8 * i + 6 * math.sin(i / 5) + rng.gauss(0, 3) for i in range(n)]


def test_errors_are_those_of_the_recursion_with_the_best_start():
    y = trending(1, 30)
    sse, ends = smoothing.errors_squared(np.array([y]), np.array([[0.4]]), np.array([[0.5]]), np.array([[0.9]]))
    starts = [(20 + i, j / 4) for i in range(-15, 16) for j in range(-12, 13)]
    tried = [plain_errors(y, 0.4, 0.2, 0.9, *s)[0] for s in starts]
    assert sse[0, 0] <= min(tried) + 1e-6 and sse[0, 0] > 0.9 * min(tried)
    # walking back from the last states' own errors gives the same sum
    h = 1e-4
    base = [plain_errors(y, 0.4, 0.2, 0.9, *s)[0] for s in ((20, 0), (20 + h, 0), (20 - h, 0), (20, h), (20, -h), (20 + h, h))]
    grad = np.array([(base[1] - base[2]) / (2 * h), (base[3] - base[4]) / (2 * h)])
    hess = np.array([[(base[1] + base[2] - 2 * base[0]) / h**2, (base[5] - base[1] - base[3] + base[0]) / h**2]] * 2)
    hess[1] = [hess[0, 1], (base[3] + base[4] - 2 * base[0]) / h**2]
    best = np.array([20, 0]) - np.linalg.solve(hess, grad)
    want = plain_errors(y, 0.4, 0.2, 0.9, *best)
    assert math.isclose(want[0], sse[0, 0], rel_tol=1e-4) and np.allclose(ends[0, 0], want[1:], rtol=1e-2, atol=1e-2)


@pytest.mark.parametrize("damped", [True, False])
def test_search_is_never_above_a_fine_grid(damped):
    ys = np.array([trending(s, 36) for s in range(6)] + [[5.0] * 36, [0.0] * 30 + [9.0] * 6])
    best, least, _ = smoothing.search(ys, damped)
    grid = [(a, s, d) for a in np.linspace(0, 1, 11) for s in np.linspace(0, 1, 9) for d in (np.linspace(0.8, 0.995, 6) if damped else [1.0])]
    trial = np.broadcast_to(np.array(grid)[:, :, None], (len(grid), 3, len(ys)))
    sse, _ = smoothing.errors_squared(ys, trial[:, 0], trial[:, 1], trial[:, 2])
    assert (least <= sse.min(axis=0) * (1 + 1e-6) + 1e-6).all()
    assert ((best[:, :2] >= 0) & (best[:, :2] <= 1)).all() and (((best[:, 2] >= 0.8) & (best[:, 2] <= 0.995)).all() if damped else (best[:, 2] == 1).all())


def test_smoothing_is_never_above_the_coarser_fold(spark):
    past = arrays(spark, {k: trending(k, 30 + k) for k in range(12)})
    held = {r["key"]: r["f"]["sse"] for r in past.select("key", forecast.holt_fit(F.col("ys")).alias("f")).collect() if r["f"]["b"] <= 1}
    ours = {r["key"]: r["sse"] for r in smoothing.smoothed_forecast(past, 6, True).where("step = 1").collect()}
    assert set(ours) == set(held) and all(ours[k] <= held[k] + 1e-3 for k in held)


def test_smoothing_forecasts_lines_and_odd_series(spark):
    line = [3.0 * i + 4 for i in range(30)]
    past = arrays(spark, {1: line, 2: [7.0] * 24, 3: [0.0] * 12, 4: [50.0 - 5 * i for i in range(11)], 5: [1.0] * 9})
    rows = smoothing.smoothed_forecast(past, 4, False).collect()
    got = {(r["key"], r["step"]): r["predicted"] for r in rows}
    assert {k for k, _ in got} == {1, 2, 3, 4} and len(got) == 16
    assert all(got[1, h] == pytest.approx(line[-1] + 3 * h, abs=1e-3) and got[2, h] == pytest.approx(7) and got[3, h] == pytest.approx(0) for h in range(1, 5))
    assert got[4, 1] == 0.0 and {r["method"] for r in rows} == {"ets_linear"}
    assert smoothing.smoothed_forecast(past.where("false"), 4, True).count() == 0
