"""Feature scaling, principal component, linear regression and its evaluation on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rename_features(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Coded columns to feature names; codes the table lacks are ignored."""
    return df.withColumnsRenamed({k: v for k, v in names.items() if k in df.columns})


def standardise(df: DataFrame, columns: Sequence[str], suffix: str = "_std") -> DataFrame:
    """Zero mean and unit population deviation; a constant column becomes zero."""
    facts = df.agg(
        F.struct(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns])
    ).scalar()
    return df.withColumns(
        {
            f"{c}{suffix}": F.coalesce(
                F.try_divide(F.col(c) - facts.getField(c).getField("m"), facts.getField(c).getField("s")), F.lit(0.0)
            )
            for c in columns
        }
    )


def _assembled(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip").transform(df)


def variance_inflation(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Variance inflation factors: the diagonal of the inverse correlation matrix. Runs one job, returns k rows."""
    matrix = Correlation.corr(_assembled(df, features).select("features"), "features").first()[0].toArray()
    factors = np.diag(np.linalg.inv(matrix))
    from metricmart.sources.literals import literal_table

    return literal_table(
        df.sparkSession, [(f, float(v)) for f, v in zip(features, factors, strict=True)], "feature string, vif double"
    )


def principal_component(df: DataFrame, columns: Sequence[str], name: str = "component") -> DataFrame:
    """Add the first principal component of the standardised columns. Runs two aggregates; the driver sees k × k numbers.

    A NULL or a constant column counts as the mean. The sign is fixed so that the first column has a positive weight.
    """
    facts = df.agg(*[F.avg(c).alias(f"m_{c}") for c in columns], *[F.stddev_pop(c).alias(f"s_{c}") for c in columns]).first()

    def standard(c: str) -> Column:
        spread = facts[f"s_{c}"]
        if not spread:
            return F.lit(0.0)
        return F.coalesce((F.col(c) - F.lit(float(facts[f"m_{c}"]))) / F.lit(float(spread)), F.lit(0.0))

    pairs = [(i, j) for i in range(len(columns)) for j in range(i, len(columns))]
    sums = df.agg(*[F.sum(standard(columns[i]) * standard(columns[j])).alias(f"p{i}_{j}") for i, j in pairs]).first()
    moments = np.zeros((len(columns), len(columns)))
    for i, j in pairs:
        moments[i, j] = moments[j, i] = sums[f"p{i}_{j}"] or 0.0
    weights = np.linalg.eigh(moments)[1][:, -1]
    weights = weights if weights[0] >= 0 else -weights
    total = F.lit(0.0)
    for c, weight in zip(columns, weights, strict=True):
        total = total + standard(c) * F.lit(float(weight))
    return df.withColumn(name, total)


def key_hash(keys: Sequence[str]) -> Column:
    """Number 0..65535 of a row key; the same for the same key on any cluster."""
    text = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys])
    return F.conv(F.left(F.md5(text), F.lit(4)), 16, 10).cast("int")


def split(df: DataFrame, keys: Sequence[str], test_share: float = 0.2) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by key hash: repeatable, whatever the partitioning."""
    is_test = key_hash(keys) < F.lit(int(65536 * test_share))
    return df.filter(~is_test), df.filter(is_test)


def fit(df: DataFrame, features: Sequence[str], label: str) -> LinearRegressionModel:
    """Linear regression by normal equations: one pass, the driver only sees a k × k matrix."""
    model = LinearRegression(featuresCol="features", labelCol=label, solver="normal", predictionCol="prediction")
    return model.fit(_assembled(df, features))


def predict(model: LinearRegressionModel, df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Add ``prediction``; with few features this is plain arithmetic in generated code."""
    total = F.lit(float(model.intercept))
    for name, weight in zip(features, model.coefficients, strict=True):
        total = total + F.col(name) * F.lit(float(weight))
    return df.withColumn("prediction", total)


def evaluate(df: DataFrame, label: str, prediction: str = "prediction", keys: Sequence[str] = ()) -> DataFrame:
    """Mean absolute error, mean squared error and R²."""
    error = F.col(label) - F.col(prediction)
    sums = df.groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(F.abs(error)).alias("mae"), F.avg(error * error).alias("mse"),
        F.var_pop(label).alias("_var"),
    )
    return sums.withColumn("r2", 1.0 - F.try_divide(F.col("mse"), F.col("_var"))).drop("_var")


def coefficients(model: LinearRegressionModel, features: Sequence[str], df: DataFrame) -> DataFrame:
    """Coefficients as a table."""
    from metricmart.sources.literals import literal_table

    rows = [(f, float(w)) for f, w in zip(features, model.coefficients, strict=True)]
    return literal_table(df.sparkSession, [*rows, ("intercept", float(model.intercept))], "feature string, weight double")


def cross_validate(df: DataFrame, keys: Sequence[str], features: Sequence[str], label: str, folds: int = 5) -> DataFrame:
    """Mean squared error per fold, folds by key hash.

    The sums a fit needs add up over rows, so the model without a fold comes from all sums minus that fold's: one pass
    for all folds instead of one fit per fold.
    """
    import functools

    names = ["_one", *features]
    rows = df.withColumns({"_one": F.lit(1.0), "fold": key_hash(keys) % folds})
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = rows.groupBy("fold").agg(
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"x{i}_{j}") for i, j in pairs],
        *[F.sum(F.col(n) * F.col(label)).alias(f"y{i}") for i, n in enumerate(names)],
    ).collect()  # one row per fold
    k = len(names)

    def moments(row) -> tuple[np.ndarray, np.ndarray]:
        xx = np.zeros((k, k))
        for i, j in pairs:
            xx[i, j] = xx[j, i] = row[f"x{i}_{j}"]
        return xx, np.array([row[f"y{i}"] for i in range(k)])

    parts = {row["fold"]: moments(row) for row in sums}
    all_xx = functools.reduce(np.add, [p[0] for p in parts.values()])
    all_xy = functools.reduce(np.add, [p[1] for p in parts.values()])
    prediction = None
    for fold, (xx, xy) in parts.items():
        weights = np.linalg.solve(all_xx - xx, all_xy - xy)
        value = functools.reduce(lambda a, b: a + b, [F.col(n) * F.lit(float(w)) for n, w in zip(names, weights)])
        here = F.col("fold") == fold
        prediction = F.when(here, value) if prediction is None else prediction.when(here, value)
    return evaluate(rows.withColumn("prediction", prediction), label, keys=["fold"]).select("fold", "n", "mse")
