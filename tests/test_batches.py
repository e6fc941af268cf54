"""Fits of many series at once: each series by itself, over all cores, whatever else is in its batch."""

import numpy as np
from test_series_models import arrays, trending
from test_trend_model import DAYS, MONTHS, frame, made

from quarrymill.operators import models, smoothing, trend_model


def test_a_series_trend_does_not_depend_on_its_batch():
    slow = np.random.default_rng(4).poisson(2, 60).astype(float)
    ys = np.array([made(1), slow, made(2, jump=-3), made(3, jump=4)])
    prior = np.full(len(ys), 0.05)
    both = trend_model.fit_batch(DAYS[:60], ys, prior)
    for i in range(len(ys)):
        alone = trend_model.fit_batch(DAYS[:60], ys[i : i + 1], prior[:1])
        assert np.allclose(alone.trend[0], both.trend[i], atol=1e-9) and np.allclose(alone.season[0], both.season[i], atol=1e-9)


def test_limits_are_quantiles():
    paths = np.random.default_rng(1).normal(size=(6, 1000))
    assert np.allclose(trend_model._limits(paths.copy(), 0.95), np.quantile(paths, [0.025, 0.975], axis=1), atol=1e-12)


def test_few_series_are_dealt_over_all_cores(spark):
    grid = frame(spark, {k: made(k, 30) for k in range(8)}).coalesce(1)
    fitted = trend_model.fit_trends(grid, ahead=False)
    assert fitted.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    rows = fitted.collect()
    assert len(rows) == 8 and all(r["forecast"] is None for r in rows)
    whole = {r["key"]: r for r in trend_model.fit_trends(grid).collect()}
    assert all(abs(r["trend_at_end"] - whole[r["key"]]["trend_at_end"]) < 1e-9 and len(whole[r["key"]]["forecast"]) == 6 for r in rows)


def test_a_series_smoothing_does_not_depend_on_its_batch():
    ys = np.array([trending(s, 36) for s in range(40)])
    for damped in (True, False):
        together = smoothing.search(ys, damped)
        alone = smoothing.search(ys[:1], damped)
        assert all(np.allclose(a[0], b[0], rtol=1e-12, atol=1e-12) for a, b in zip(alone, together, strict=True))


def test_both_forms_come_of_one_pass(spark):
    past = arrays(spark, {k: trending(k, 30) for k in range(5)})
    both = smoothing.smoothed_forecasts(past, 3)
    assert both._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    each = [r for damped in (True, False) for r in smoothing.smoothed_forecast(past, 3, damped).collect()]
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, each)) and len(each) == 30


def test_regressions_go_to_python_in_batches_and_equal_single_fits(spark):
    series = {k: made(k, 30 + k % 3) for k in range(12)}
    out = models.fit_models(frame(spark, series), "trend_and_season")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "FlatMapGroups" not in plan
    got = {(r["key"], r["step"]): r for r in out.collect()}
    assert len(got) == 72 and all(str(got[k, h]["target_month"]) == MONTHS[len(y) - 1 + h] for k, y in series.items() for h in range(1, 7))
    for k, y in series.items():
        x = models._design(np.arange(len(y), dtype=float), len(y), 3, 6)
        weight = np.concatenate([[1e-6, 1e-6], np.full(6, 1 / (0.05 * len(y))), np.full(6, 0.1)])
        beta = np.linalg.solve(x.T @ x + np.diag(weight), x.T @ y)
        want, spread = models._design(np.arange(len(y), len(y) + 6, dtype=float), len(y), 3, 6) @ beta, np.std(y - x @ beta)
        assert np.allclose([got[k, h]["yhat"] for h in range(1, 7)], np.maximum(want, 0), rtol=1e-10)
        assert np.allclose([got[k, h]["yhat_upper"] for h in range(1, 7)], np.maximum(want + 1.96 * spread, 0), rtol=1e-10)
