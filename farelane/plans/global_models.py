"""Global models (one fit over all training rows), scoring and RMSE."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.features import LABEL, train_test_split
from ..session import local_table, materialize, scratch_scope
from .model_tables import NodeTable, node_table


def rmse(df: DataFrame, label: str = LABEL, pred: str = "prediction") -> DataFrame:
    """Root mean squared error as a one-row aggregate (n, rmse)."""
    err = F.col(label) - F.col(pred)
    return df.agg(F.count(err).alias("n"), F.sqrt(F.avg(err * err)).alias("rmse"))


def rmse_value(df: DataFrame, label: str = LABEL, pred: str = "prediction") -> float:
    return float(rmse(df, label, pred).first()["rmse"])


def estimator(kind: str, label: str = LABEL, depth: int = 5, seed: int = 42):
    if kind == "gbt":
        return GBTRegressor(maxDepth=depth, labelCol=label, featuresCol="features", seed=seed)
    if kind == "dt":
        return DecisionTreeRegressor(maxDepth=depth, labelCol=label, featuresCol="features", seed=seed)
    if kind == "lr":
        return LinearRegression(labelCol=label, featuresCol="features", solver="normal")
    raise ValueError(kind)


def fit_global(train: DataFrame, features: list[str], kind: str = "gbt", label: str = LABEL,
               depth: int = 5) -> PipelineModel:
    """Pipeline of a skip-invalid assembler and one regressor over all rows."""
    asm = VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")
    return Pipeline(stages=[asm, estimator(kind, label, depth)]).fit(train)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    return model.transform(df)


def _kept(rows: DataFrame, features: list[str], label: str, key: str) -> DataFrame:
    """Complete rows, written once over enough partitions for every core: the split, the fit's passes and the counts read them."""
    kept = rows.dropna(subset=[*features, label]).select(key, *features, label)
    return materialize(kept.repartition(rows.sparkSession.sparkContext.defaultParallelism))


def global_nodes(rows: DataFrame, features: list[str], kind: str = "dt", label: str = LABEL, depth: int = 5, key: str = "trip_id") -> NodeTable:
    """The nodes of the model fitted on the training rows."""
    with scratch_scope(rows.sparkSession):
        train, _ = train_test_split(_kept(rows, features, label, key), key)
        return node_table(fit_global(train, features, kind, label, depth).stages[-1], features)


def global_rmse(rows: DataFrame, features: list[str], kind: str = "gbt", label: str = LABEL, depth: int = 5,
                key: str = "trip_id", stages: tuple[int, ...] = ()) -> DataFrame:
    """Split, fit, score and evaluate; one row (model, n_train, n_test, rmse, mean_rmse, beats_mean, rmse_<k>...).

    ``mean_rmse`` is the error of the training mean. Tree models are scored by
    walking their table of nodes; ``rmse_<k>`` is the error of the first k trees
    alone, for each k of ``stages``.
    """
    spark = rows.sparkSession
    with scratch_scope(spark):
        train, test = train_test_split(_kept(rows, features, label, key), key)
        model = fit_global(train, features, kind, label, depth)
        base = train.agg(F.count("*").alias("n"), F.avg(label).alias("m")).first()
        if kind == "lr":
            scored = score(model, test)
        else:
            nodes = node_table(model.stages[-1], features)
            scored = nodes.score(test)
            for k in stages:
                scored = nodes.score(scored, f"prediction_{k}", k)
        error = lambda c: F.sqrt(F.avg((F.col(label) - c) ** 2))
        r = scored.agg(F.count("*").alias("n"), error(F.col("prediction")).alias("rmse"), error(F.lit(base.m)).alias("mean_rmse"),
                       *[error(F.col(f"prediction_{k}")).alias(f"rmse_{k}") for k in stages]).first()
        row = (kind, int(base.n), int(r.n), r.rmse, r.mean_rmse, bool(r.rmse is not None and r.rmse < r.mean_rmse), *[r[f"rmse_{k}"] for k in stages])
        return local_table(spark, [row], "model string, n_train bigint, n_test bigint, rmse double, mean_rmse double, beats_mean boolean"
                           + "".join(f", rmse_{k} double" for k in stages))


def ols_single(df: DataFrame, x: str, y: str = LABEL) -> DataFrame:
    """One-feature least squares as SQL aggregates: slope, intercept, n."""
    return df.agg(F.regr_slope(F.col(y), F.col(x)).alias("slope"),
                  F.regr_intercept(F.col(y), F.col(x)).alias("intercept"),
                  F.regr_count(F.col(y), F.col(x)).alias("n"))


def predict_linear(coef: dict[str, float], intercept: float) -> Column:
    e = F.lit(intercept)
    for c, b in coef.items():
        e = e + F.col(c) * F.lit(b)
    return e
