"""Weekly demand series, gap-filled lags and per-series forecasts with AIC.

Many series are forecast at once: every step is a grouped aggregate or a
window partitioned by series over the already aggregated weekly table (a
series holds one row per week, so no window partition grows with the trips).
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.calendar import week_start
from ..session import materialize
from .local_models import fit_local_lr, lr_moments

SEASON = 52
#: Weeks a series needs for the season of 52; a shorter one is forecast with season 1.
MIN_SEASONAL_WEEKS = 60


def weekly_counts(trips: DataFrame, series: str, ts: str = "pickup_datetime") -> DataFrame:
    """(series, week, n): trips per Monday-start week."""
    return trips.groupBy(F.col(series).alias("series"), week_start(ts).alias("week")).agg(
        F.count("*").alias("n"))


def weekly_lags(counts: DataFrame) -> DataFrame:
    """Fill missing weeks with 0 between each series' first and last week; add lags 1 and 52."""
    span = counts.groupBy("series").agg(F.min("week").alias("w0"), F.max("week").alias("w1"))
    spine = span.select("series", F.explode(F.sequence("w0", "w1", F.expr("INTERVAL 7 DAYS"))).alias("week"))
    filled = spine.join(counts, ["series", "week"], "left").fillna(0, subset=["n"])
    w = Window.partitionBy("series").orderBy("week")
    return filled.withColumns({
        "t": F.row_number().over(w),
        "lag_1": F.lag("n", 1).over(w),
        "lag_52": F.lag("n", SEASON).over(w),
    })


def forecast(lags: DataFrame, min_seasonal_weeks: int = MIN_SEASONAL_WEEKS) -> DataFrame:
    """Seasonal-naive and AR(1)-on-seasonal-differences forecasts, scored by AIC.

    Season s = 52 weeks when a series has at least ``min_seasonal_weeks`` weeks, else 1; column ``season`` says which.
    d_t = y_t - y_{t-s}; AR: d_t = a + b d_{t-1}; one-step in-sample
    yhat_t = y_{t-s} (naive) or y_{t-s} + a + b d_{t-1} (AR), both scored on
    the rows where d_{t-1} exists. AIC = n ln(RSS/n) + 2k (k = 0 naive, 2 AR);
    RSS = 0 gives a null AIC. Output one row per (series, model) with the
    next week's forecast and ``best`` for the lower AIC.
    """
    w = Window.partitionBy("series").orderBy("week")
    nweeks = F.max("t").over(Window.partitionBy("series"))
    df = lags.withColumn("s", F.when(nweeks >= min_seasonal_weeks, SEASON).otherwise(1))
    df = df.withColumn("y_s", F.when(F.col("s") == SEASON, F.col("lag_52")).otherwise(F.col("lag_1")))
    df = df.withColumn("d", F.col("n") - F.col("y_s"))
    df = df.withColumn("d_prev", F.lag("d", 1).over(w))
    # the value one season before next week: lag s-1 at the last row
    df = df.withColumn("y_next_s", F.when(F.col("s") == SEASON, F.lag("n", SEASON - 1).over(w))
                       .otherwise(F.col("n")))
    # series x weeks rows, read three times below: write once, re-read.
    df = materialize(df)
    fit = df.groupBy("series").agg(
        F.regr_slope("d", "d_prev").alias("b"),
        F.regr_intercept("d", "d_prev").alias("a"),
        F.max("t").alias("t_last"), F.max("s").alias("season"))
    last = df.join(fit.select("series", "t_last"), "series").where(F.col("t") == F.col("t_last")) \
        .select("series", F.col("d").alias("d_last"), "y_next_s")
    scored = (df.where(F.col("d_prev").isNotNull() & F.col("y_s").isNotNull())
              .join(fit, "series")
              .withColumn("e_ar", F.col("d") - (F.col("a") + F.col("b") * F.col("d_prev"))))
    stats = scored.groupBy("series").agg(
        F.count("*").alias("n_obs"),
        F.sum(F.col("d") * F.col("d")).alias("rss_naive"),
        F.sum(F.col("e_ar") * F.col("e_ar")).alias("rss_ar"))
    out = stats.join(fit, "series").join(last, "series")

    def aic(rss, k):
        return F.when(F.col(rss) > 0, F.col("n_obs") * F.log(F.col(rss) / F.col("n_obs")) + 2 * k)

    naive = out.select("series", F.lit("seasonal_naive").alias("model"), "season", "n_obs",
                       F.col("rss_naive").cast("double").alias("rss"), aic("rss_naive", 0).alias("aic"),
                       F.col("y_next_s").cast("double").alias("yhat_next"))
    ar = out.select("series", F.lit("ar1_seasonal_diff").alias("model"), "season", "n_obs",
                    F.col("rss_ar").alias("rss"), aic("rss_ar", 2).alias("aic"),
                    (F.col("y_next_s") + F.col("a") + F.col("b") * F.col("d_last")).alias("yhat_next"))
    both = naive.unionByName(ar)
    best = both.groupBy("series").agg(F.min_by("model", F.struct(F.col("aic").isNull(), "aic", "model"))
                                      .alias("best_model"))
    return both.join(best, "series").withColumn("best", F.col("model") == F.col("best_model")).drop("best_model")


# ---------------------------------------------------------------------------
# seasonal ARMA, orders chosen by AIC
# ---------------------------------------------------------------------------

#: Lags of the long autoregression whose residuals stand in for the unseen shocks.
LONG_AR = 4
MAX_ORDER = 2
#: Weeks a series needs for seasonal differences; a shorter one is differenced once.
MIN_ARMA_WEEKS = 2 * SEASON


def _orders(group: str):
    """mapInPandas function: every order of a series from one row of its moments of (lags, residuals, label)."""
    k = 2 * MAX_ORDER

    def solve(batches):
        for pdf in batches:
            out = []
            for r in pdf.to_dict("records"):
                c = np.zeros((k + 1, k + 1))
                for i in range(k + 1):
                    for j in range(i, k + 1):
                        c[i, j] = c[j, i] = r[f"c_{i}_{j}"]
                m = np.array([r[f"m_{i}"] for i in range(k + 1)])
                for p in range(MAX_ORDER + 1):
                    for q in range(MAX_ORDER + 1):
                        at = [*range(p), *range(MAX_ORDER, MAX_ORDER + q)]
                        beta = np.linalg.pinv(c[np.ix_(at, at)]) @ c[at, k]
                        full = np.zeros(k)
                        full[at] = beta
                        n, rss = int(r["n"]), float(r["n"] * (c[k, k] - beta @ c[at, k]))
                        aic = n * np.log(rss / n) + 2 * (p + q + 1) if rss > 0 and n > p + q + 1 else None
                        out.append((r[group], p, q, n, rss, aic, float(m[k] - full @ m[:k]), full.tolist()))
            yield pd.DataFrame(out, columns=[group, "p", "q", "n_obs", "rss", "aic", "const", "coef"])

    return solve


def forecast_arma(lags: DataFrame, min_seasonal_weeks: int = MIN_ARMA_WEEKS) -> DataFrame:
    """ARMA(p, q) of the seasonal differences, p and q from 0 to ``MAX_ORDER``, for all series at once; the lowest AIC is ``best``.

    Two-stage least squares: a long autoregression of d_t = y_t - y_{t-s} on its
    ``LONG_AR`` last values gives residuals e_t; then d_t is regressed on p of
    its lags and q lags of e. All orders of a series use the same weeks (those
    where every lag exists) and come from one row of its moments, so no series
    is gathered. AIC = n ln(RSS / n) + 2 (p + q + 1), null without spread or with
    too few weeks; ties go to the smaller order. s is 52 weeks, or 1 for a
    series of under ``min_seasonal_weeks``; a series without a usable week has no row.
    """
    w = Window.partitionBy("series").orderBy("week")
    nweeks = F.max("t").over(Window.partitionBy("series"))
    future = lags.groupBy("series").agg(F.expr("max(week) + INTERVAL 7 DAYS").cast("date").alias("week"), (F.max("t") + 1).alias("t"))
    rows = lags.select("series", "week", "t", "n").unionByName(future.withColumn("n", F.lit(None).cast("bigint")))
    df = rows.withColumn("season", F.when(nweeks > min_seasonal_weeks, SEASON).otherwise(1))  # the week to come counts one
    df = df.withColumn("y_s", F.when(F.col("season") == SEASON, F.lag("n", SEASON).over(w)).otherwise(F.lag("n", 1).over(w)))
    df = df.withColumn("d", (F.col("n") - F.col("y_s")).cast("double"))
    long_lags = [f"d{i}" for i in range(1, LONG_AR + 1)]
    # series x weeks rows, read by both stages: written once
    df = materialize(df.withColumns({c: F.lag("d", i).over(w) for i, c in enumerate(long_lags, 1)}))
    long = fit_local_lr(df, long_lags, "d", group="series")
    long = long.groupBy("series").pivot("term", ["intercept", *long_lags]).agg(F.first("coef"))
    long = long.select("series", F.col("intercept").alias("b0"), *[F.col(c).alias(f"b_{c}") for c in long_lags])
    fitted = F.col("b0")
    for c in long_lags:
        fitted = fitted + F.col(f"b_{c}") * F.col(c)
    df = df.join(long, "series").withColumn("e", F.col("d") - fitted)
    used = [f"d{i}" for i in range(1, MAX_ORDER + 1)] + [f"e{i}" for i in range(1, MAX_ORDER + 1)]
    df = materialize(df.withColumns({f"e{i}": F.lag("e", i).over(w) for i in range(1, MAX_ORDER + 1)})
                     .select("series", "season", "n", "y_s", "d", *used))
    kind = dict(df.dtypes)["series"]
    models = lr_moments(df, used, "d", "series").mapInPandas(
        _orders("series"), f"series {kind}, p int, q int, n_obs bigint, rss double, aic double, const double, coef array<double>")
    ahead = df.where(F.col("n").isNull()).select("series", "season", "y_s", F.array(*used).alias("x"))
    out = models.join(ahead, "series").withColumn("yhat_next", F.expr("y_s + const + aggregate(zip_with(coef, x, (a, b) -> IF(a = 0, 0D, a * b)), 0D, (s, v) -> s + v)"))
    best = Window.partitionBy("series").orderBy(F.col("aic").isNull(), "aic", F.col("p") + F.col("q"), "p")
    return out.select("series", "season", "p", "q", "n_obs", "rss", "aic", "yhat_next", (F.row_number().over(best) == 1).alias("best"))
