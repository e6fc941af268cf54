"""The trend model against a long-run optimiser of its own cost, and its bands by how much they cover."""

import numpy as np
import pytest

from quarrymill.operators import assembly, trend_model
from quarrymill.plans import all_queries

MONTHS = [f"{1995 + i // 12}-{i % 12 + 1:02d}-01" for i in range(150)]
DAYS = np.array([np.datetime64(m).astype("datetime64[D]").astype(int) for m in MONTHS], float)


def cost(y, t, hinge, waves, k, m, change, season, noise, prior):
    rest = y - (m + k * t + hinge @ change) * (1 + waves @ season)
    return len(y) * np.log(noise) + rest @ rest / (2 * noise**2) + (k * k + m * m) / 50 + np.abs(change).sum() / prior + season @ season / 200 + noise**2 / 0.5


def long_run(y, days, prior, rounds=4000):
    """One number at a time is set to where the cost is least, thousands of times over."""
    n = len(y)
    t = (days - days[0]) / (days[-1] - days[0])
    seen = int(n * 0.8)
    at = t[np.round(np.linspace(0, seen - 1, min(25, seen - 1) + 1)).astype(int)[1:]]
    hinge = np.maximum(t[:, None] - at[None], 0)
    waves = np.column_stack([g(2 * np.pi * j * days / 365.25) for j in (1, 2, 3) for g in (np.sin, np.cos)])
    base = np.column_stack([np.ones(n), t, hinge])
    x, season, noise = np.zeros(base.shape[1]), np.zeros(6), 1.0
    x[0], x[1] = y[0], y[-1] - y[0]
    for _ in range(rounds):
        rest = y - (base @ x) * (1 + waves @ season)
        noise = max(np.sqrt(0.125 * (np.sqrt(n * n + 16 * rest @ rest) - n)), 1e-4)
        for j in range(len(x)):
            col = base[:, j] * (1 + waves @ season)
            rest = rest + col * x[j]
            want, g = col @ rest, col @ col
            x[j] = want / (g + noise**2 / 25) if j < 2 else np.sign(want) * max(abs(want) - noise**2 / prior, 0) / max(g, 1e-12)
            rest = rest - col * x[j]
        level = base @ x
        for j in range(6):
            col = waves[:, j] * level
            rest = rest + col * season[j]
            season[j] = (col @ rest) / (col @ col + noise**2 / 100)
            rest = rest - col * season[j]
    return cost(y, t, hinge, waves, x[1], x[0], x[2:], season, noise, prior), (base @ x) * (1 + waves @ season)


def made(seed, n=60, jump=0.0):
    rng = np.random.default_rng(seed)
    t = np.arange(n)
    return np.maximum((60 + 0.7 * t + jump * np.maximum(t - n // 2, 0)) * (1 + 0.25 * np.sin(2 * np.pi * t / 12)) + rng.normal(0, 4, n), 0)


@pytest.mark.parametrize("prior", [0.05, 0.25])
def test_fit_equals_a_long_run_of_single_steps(prior):
    ys = np.array([made(1), made(2, jump=-3), made(3, jump=4), np.random.default_rng(4).poisson(2, 60)], float)
    f = trend_model.fit_batch(DAYS[:60], ys, np.full(4, prior))
    ours = trend_model.penalised_cost(f, ys / f.scale[:, None], np.full(4, prior))
    for i, y in enumerate(ys):
        theirs, line = long_run(y / np.abs(y).max(), DAYS[:60], prior)
        assert ours[i] <= theirs + 1e-6 * (1 + abs(theirs)), (i, ours[i], theirs)
        assert np.allclose((f.trend_at(DAYS[:60]) * (1 + f.season_at(DAYS[:60])))[i], line, atol=2e-3)


def test_a_wider_prior_lets_the_slope_change():
    y = np.r_[np.full(30, 20.0), np.full(30, 80.0)] + np.random.default_rng(0).normal(0, 1, 60)
    f = trend_model.fit_batch(DAYS[:60], np.array([y, y]), np.array([0.001, 0.25]))
    tight, wide = np.abs(f.trend[:, 2:]).sum(axis=1)
    end = (f.trend_at(DAYS[59:60]) * f.scale[:, None])[:, 0]
    assert wide > 3 * tight and abs(end[1] - 80) < abs(end[0] - 80)


def test_places_of_changes():
    assert len(trend_model.change_places(60)) == 25 and trend_model.change_places(60).max() == 47
    assert trend_model.change_places(24).tolist() == list(range(1, 19))


def frame(spark, series: dict):
    rows = [(k, MONTHS[i], float(v)) for k, y in series.items() for i, v in enumerate(y)]
    return spark.createDataFrame(rows, "key long, month string, units double").selectExpr("key", "cast(month as date) as month", "units")


def test_bands_cover_what_comes(spark):
    series = {k: made(100 + k, 66) for k in range(120)}
    grid = frame(spark, {k: y[:60] for k, y in series.items()})
    got = trend_model.trend_forecast(trend_model.fit_trends(grid)).collect()
    inside = [r["yhat_lower"] <= series[r["key"]][59 + r["step"]] <= r["yhat_upper"] for r in got]
    # measured: 0.89; the most likely parameters are taken as known, so bands are somewhat narrow
    assert len(inside) == 720 and 0.85 <= np.mean(inside) <= 0.99
    assert all(str(r["target_month"]) == MONTHS[59 + r["step"]] for r in got)
    again = trend_model.trend_forecast(trend_model.fit_trends(grid.repartition(7))).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, again))


def test_odd_series(spark):
    short, flat, zero, gap = made(1, 23), np.full(30, 7.0), np.zeros(40), made(2, 40)
    grid = frame(spark, {1: short, 2: flat, 3: zero, 4: gap}).selectExpr("key", "month", "if(key = 4 and month = '1996-03-01', null, units) as units")
    got = {r["key"]: r for r in trend_model.fit_trends(grid, spark.createDataFrame([(4,), (4,), (None,), (9,)], "key long")).collect()}
    assert sorted(got) == [2, 3, 4] and [got[k]["known_changeover"] for k in (2, 3, 4)] == [False, False, True]
    assert got[2]["trend_at_end"] == pytest.approx(7) and got[2]["slope_changes"] == 0
    assert all(f["yhat"] == pytest.approx(7) and f["yhat_lower"] == pytest.approx(7, abs=0.01) for f in got[2]["forecast"])
    assert got[3]["trend_at_end"] == 0 and all(f["yhat"] == 0 for f in got[3]["forecast"])
    assert trend_model.fit_trends(grid.where("false")).count() == 0


def test_audit_finds_a_trend_above_a_dead_series(spark):
    dead = np.r_[made(5, 50), np.zeros(10)]
    grid = frame(spark, {1: dead, 2: made(6)}).selectExpr("*", "row_number() over (partition by key order by month) as i", "count(*) over (partition by key) as n")
    fitted = trend_model.fit_trends(grid)
    got = {r["key"]: r for r in assembly.trend_audit(grid, fitted.select("key", "trend_at_end")).collect()}
    assert got[1]["disconnected"] and not got[2]["disconnected"]


def test_queries_fit_every_long_series_once(spark):
    queries, _ = all_queries()
    sf = "/root/testdata/sf0.001"
    ahead, audit = queries["multiplicative_forecast"](spark, sf), queries["fitted_trend_audit"](spark, sf)
    keys = {r["key"] for r in audit.select("key").collect()}
    assert ahead.count() == 6 * len(keys) > 0
    plan = audit._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "Scan ExistingRDD" in plan  # fitted before, into the checkpoint that both parts of the audit read
