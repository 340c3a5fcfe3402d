"""Seasonal ARMA by two-stage least squares: numpy by hand, simulated orders, series that are short or flat."""

import datetime as dt

import numpy as np
import pytest

from farelane.plans import forecast as fc

MONDAY = dt.date(2015, 1, 5)


def _weekly(spark, series):
    rows = [(s, MONDAY + dt.timedelta(weeks=i), int(v)) for s, values in series.items() for i, v in enumerate(values)]
    return fc.weekly_lags(spark.createDataFrame(rows, "series long, week date, n long"))


def _by_hand(y, season):
    """All orders from the definition: least squares on the weeks where every lag exists."""
    y = np.asarray(y, float)
    d = np.full(len(y), np.nan)
    d[season:] = y[season:] - y[:-season]
    lag = lambda x, k: np.concatenate([np.full(k, np.nan), x])[:len(y) + 1]  # noqa: E731  one week more than y
    one = np.ones(len(y) + 1)
    full = np.append(d, np.nan)
    X = np.stack([one, *[lag(d, k) for k in range(1, 5)]], axis=1)
    ok = ~np.isnan(X).any(axis=1) & ~np.isnan(full)
    e = (full - X @ np.linalg.lstsq(X[ok], full[ok], rcond=None)[0])[:-1]
    cols = [lag(d, 1), lag(d, 2), lag(e, 1), lag(e, 2)]
    ok = ~np.isnan(np.stack(cols)).any(axis=0) & ~np.isnan(full)
    out = {}
    for p in range(3):
        for q in range(3):
            X = np.stack([one, *cols[:p], *cols[2:2 + q]], axis=1)
            b = np.linalg.lstsq(X[ok], full[ok], rcond=None)[0]
            rss, n = float(((full[ok] - X[ok] @ b) ** 2).sum()), int(ok.sum())
            out[p, q] = (n, rss, n * np.log(rss / n) + 2 * (p + q + 1), float(np.append(y, 0)[-1 - season] + X[-1] @ b))
    return out


@pytest.mark.parametrize("weeks,season", [(260, 52), (90, 1)])
def test_equals_least_squares_by_hand(spark, weeks, season):
    rng = np.random.default_rng(weeks)
    y = np.round(1000 + 200 * np.sin(np.arange(weeks) * 2 * np.pi / 52) + np.cumsum(rng.normal(0, 3, weeks)) + rng.normal(0, 20, weeks))
    got = {(r.p, r.q): r for r in fc.forecast_arma(_weekly(spark, {7: y})).collect()}
    want = _by_hand(y, season)
    assert set(got) == set(want) and {r.season for r in got.values()} == {season}
    for order, (n, rss, aic, ahead) in want.items():
        r = got[order]
        assert r.n_obs == n
        np.testing.assert_allclose([r.rss, r.aic, r.yhat_next], [rss, aic, ahead], rtol=1e-6)
    assert [o for o, r in got.items() if r.best] == [min(want, key=lambda o: want[o][2])]


def test_each_series_gets_its_own_order(spark):
    """Seasonal differences made by known models: the order's kind is found."""
    rng = np.random.default_rng(4)

    def make(phi, theta, weeks=1200):
        e = rng.normal(0, 50, weeks)
        d = np.zeros(weeks)
        for t in range(2, weeks):
            d[t] = sum(f * d[t - 1 - i] for i, f in enumerate(phi)) + e[t] + sum(f * e[t - 1 - i] for i, f in enumerate(theta))
        y = np.full(weeks, 100_000.0)
        for t in range(52, weeks):
            y[t] = y[t - 52] + d[t]
        return np.round(y)

    out = fc.forecast_arma(_weekly(spark, {1: make([0.8], []), 2: make([], [0.7]), 3: make([], []), 4: make([0.5, 0.3], [])})).where("best").collect()
    best = {r.series: (r.p, r.q) for r in out}
    assert best[1][0] >= 1 and best[2][1] >= 1 and best[4] != (0, 0) and best[3][0] + best[3][1] <= 1


def test_short_and_flat_series(spark):
    got = fc.forecast_arma(_weekly(spark, {1: [5], 2: [5, 6, 7], 3: [9] * 40, 4: [3, 8] * 4})).collect()
    assert {r.series for r in got} <= {3, 4} and sum(r.best for r in got if r.series == 3) == 1
    assert all(r.aic is None and r.yhat_next == 9 for r in got if r.series == 3)
