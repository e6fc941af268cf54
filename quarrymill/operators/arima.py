"""Autoregression at lag 1 and at a season of three months with a constant, as folds; no Python in the plan.

    y_t = c + a y_(t-1) + b y_(t-3) - a b y_(t-4) + noise

Nothing keeps a and b inside the stationary region, so the start is diffuse: the first four values
are taken as given, and the Gaussian likelihood of the others is greatest where their squared errors
are least. These are a polynomial in a and b whose coefficients are sums of products over the series,
so a series is read once; for a given b the best a is a quotient, and the other way round, and the two
are set in turn from several starts. state_space_likelihood is the same model as a Kalman recursion.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarrymill.functions.folds import dot, let, total

SEASON, HELD, ROUNDS = 3, 4, 100
STARTS = (-0.9, -0.45, 0.0, 0.45, 0.9)
LAGS = (0, 1, SEASON, SEASON + 1)


def _products(ys: Column) -> Column:
    """struct(mean, n, s0.., q00, q01, ...): sums, and sums of products about their means, of the lagged series."""

    def of(d: Column, mean: Column) -> Column:
        n = F.size(d) - HELD
        lagged = F.struct(*(F.slice(d, F.lit(HELD + 1 - k), n).alias(f"y{k}") for k in LAGS))

        def sums(v: Column) -> Column:
            plain = F.struct(*(total(v[f"y{k}"]).alias(f"s{k}") for k in LAGS))
            pairs = [(j, k) for i, j in enumerate(LAGS) for k in LAGS[i:]]
            return let(plain, lambda s: F.struct(mean.alias("mean"), n.cast("double").alias("n"), *(s[f"s{k}"].alias(f"s{k}") for k in LAGS), *((dot(v[f"y{j}"], v[f"y{k}"]) - s[f"s{j}"] * s[f"s{k}"] / n).alias(f"q{j}{k}") for j, k in pairs)))

        return let(lagged, sums)

    return let(total(ys) / F.size(ys), lambda m: let(F.transform(ys, lambda y: y - m), lambda d: of(d, m)))


def _quotient(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 1e-9, top / bottom).otherwise(0.0)


def _alternated(q: Column, start: float) -> Column:
    """struct(sse, start, a, b) after the rounds from b = start."""

    def turn(at: Column, _: Column) -> Column:
        b = at["b"]
        a = _quotient(q["q01"] - b * (q["q04"] + q["q13"]) + b * b * q["q34"], q["q11"] - 2 * b * q["q14"] + b * b * q["q44"])
        other = lambda x: _quotient(q["q03"] - x * (q["q04"] + q["q13"]) + x * x * q["q14"], q["q33"] - 2 * x * q["q34"] + x * x * q["q44"])
        return let(a, lambda x: F.struct(x.alias("a"), other(x).alias("b")))

    def weighed(at: Column) -> Column:
        w = {0: F.lit(1.0), 1: -at["a"], SEASON: -at["b"], SEASON + 1: at["a"] * at["b"]}
        sse = sum((2 if j < k else 1) * w[j] * w[k] * q[f"q{j}{k}"] for i, j in enumerate(LAGS) for k in LAGS[i:])
        return F.struct(F.round(F.greatest(sse, F.lit(0.0)), 6).alias("sse"), F.lit(start).alias("start"), at["a"].alias("a"), at["b"].alias("b"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), F.struct(F.lit(0.0).alias("a"), F.lit(start).alias("b")), turn, weighed)


def fit(ys: Column) -> Column:
    """struct(a, b, c, variance, log_likelihood) of series of more than HELD values; ties: the lowest start."""

    def from_products(q: Column) -> Column:
        def finished(best: Column) -> Column:
            a, b = best["a"], best["b"]
            centred = (q["s0"] - a * q["s1"] - b * q["s3"] + a * b * q["s4"]) / q["n"]
            c = centred + q["mean"] * (1 - a) * (1 - b)
            variance = best["sse"] / q["n"]
            return F.struct(a.alias("a"), b.alias("b"), c.alias("c"), variance.alias("variance"), F.when(variance > 0, -q["n"] / 2 * (F.log(2 * math.pi * variance) + 1)).alias("log_likelihood"))

        return let(F.array_min(F.array(*(_alternated(q, s) for s in STARTS))), finished)

    return let(_products(ys), from_products)


def _ahead(f: Column, start: Column, constant: Column, horizon: int) -> Column:
    """The next values after the four of start, oldest first."""
    step = lambda v, _: F.concat(v, F.array(constant + f["a"] * F.element_at(v, -1) + f["b"] * F.element_at(v, -SEASON) - f["a"] * f["b"] * F.element_at(v, -SEASON - 1)))
    return F.slice(F.aggregate(F.sequence(F.lit(1), F.lit(horizon)), start, step), HELD + 1, horizon)


def seasonal_ar(past: DataFrame, horizon: int, band: float = 1.96) -> DataFrame:
    """(key, train_end, step, target_month, yhat, yhat_lower, yhat_upper) of histories (key, train_end, ys), clipped at 0.

    The band is that of the forecast errors' variance, which grows by the squared responses to a shock.
    Histories of fewer than 24 months give no rows.
    """
    long = past.where(F.size("ys") >= 24)
    shock = F.concat(F.array(*[F.lit(0.0)] * (HELD - 1)), F.array(F.lit(1.0)))

    def steps(f: Column) -> Column:
        """array<struct<y, spread>>: the path, and how far its errors reach."""
        path = _ahead(f, F.slice("ys", -HELD, HELD), f["c"], horizon)
        response = F.concat(F.array(F.lit(1.0)), _ahead(f, shock, F.lit(0.0), horizon))
        reach = lambda r, i: band * F.sqrt(f["variance"] * total(F.transform(F.slice(r, F.lit(1), i + 1), lambda x: x * x)))
        return let(response, lambda r: F.transform(path, lambda y, i: F.struct(y.alias("y"), reach(r, i).alias("spread"))))

    rows = long.select("key", "train_end", F.posexplode(let(fit(F.col("ys")), steps)).alias("pos", "s"))  # one expression, so a series is fitted once
    y, spread = F.col("s.y"), F.col("s.spread")
    cut = lambda c: F.greatest(c, F.lit(0.0))
    return rows.select(
        "key", "train_end", (F.col("pos") + 1).alias("step"), F.add_months("train_end", F.col("pos") + 1).alias("target_month"),
        cut(y).alias("yhat"), cut(y - spread).alias("yhat_lower"), cut(y + spread).alias("yhat_upper"),
    )


def state_space_likelihood(ys: Column, a: Column, b: Column, c: Column, variance: Column, start_variance: Column, held: int = 0) -> Column:
    """Gaussian log-likelihood of ys by a Kalman recursion over the last four values, without the first `held` terms.

    The four values before the first are normal around 0 with start_variance. With a large one and
    held = 4 this is the likelihood that fit makes greatest.
    """
    t = [a, F.lit(0.0), b, -a * b]

    def step(s: Column, y: Column) -> Column:
        def seen(gain: Column) -> Column:
            error, known = y - F.get(s["x"], 0), F.get(s["p"], 0)
            x = [F.get(s["x"], i) + F.get(gain, i) * error for i in range(4)]
            p = F.array(*(F.get(s["p"], 4 * i + j) - F.get(gain, i) * F.get(s["p"], j) for i in range(4) for j in range(4)))

            def moved(p: Column) -> Column:
                first = [sum((t[m] * F.get(p, 4 * m + j) for m in range(4)), F.lit(0.0)) for j in range(4)]
                rows = [[sum((first[m] * t[m] for m in range(4)), F.lit(0.0)) + variance, *first[:3]]]
                rows += [[first[i], *(F.get(p, 4 * i + j) for j in range(3))] for i in range(3)]
                return F.array(*(e for r in rows for e in r))

            gone = F.when(s["i"] >= held, -0.5 * (F.log(2 * math.pi * known) + error * error / known)).otherwise(0.0)
            return F.struct((s["i"] + 1).alias("i"), F.array(c + sum((t[m] * x[m] for m in range(4)), F.lit(0.0)), *x[:3]).alias("x"), let(p, moved).alias("p"), (s["sum"] + gone).alias("sum"))

        return let(F.transform(F.array(*(F.lit(4 * i) for i in range(4))), lambda i: F.get(s["p"], i) / F.get(s["p"], 0)), seen)

    zero = F.array(*[F.lit(0.0)] * 4)
    start = F.struct(F.lit(0).alias("i"), zero.alias("x"), F.array(*(start_variance if i == j else F.lit(0.0) for i in range(4) for j in range(4))).alias("p"), F.lit(0.0).alias("sum"))
    return F.aggregate(ys, start, step, lambda s: s["sum"])
