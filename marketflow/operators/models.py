"""Linear models of the close, per sector."""

from __future__ import annotations

from functools import partial
from multiprocessing.pool import ThreadPool

import numpy as np
import pyarrow as pa
from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketflow.schema import ELASTIC_NET, small_frame
from marketflow.session import settle

FEATURES = ("open", "high", "low")


def assemble(frame: DataFrame, inputs=FEATURES, output: str = "features", invalid: str = "error") -> DataFrame:
    """Add a feature vector; `invalid="skip"` drops rows with nulls."""
    return VectorAssembler(inputCols=list(inputs), outputCol=output, handleInvalid=invalid).transform(frame)


def moments(frame: DataFrame, inputs=FEATURES, label: str = "close", key: str = "sector") -> DataFrame:
    """Row count, means and population covariances of features and label per key.

    One scan and one hash aggregation for all keys, whatever their number or size.
    """
    columns = [*inputs, label]
    covariances = [
        F.covar_pop(a, b).alias(f"cov_{a}_{b}")
        for i, a in enumerate(columns)
        for b in columns[i:]
    ]
    complete = frame.dropna(subset=columns)
    return complete.groupBy(key).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns], *covariances
    )


def _moment_points(row, columns: list[str]) -> pa.Table:
    """Weighted points whose count, mean and covariance are those of `row`."""
    size = len(columns)
    mean = np.array([row[f"mean_{c}"] for c in columns])
    cov = np.empty((size, size))
    for i, a in enumerate(columns):
        for j, b in enumerate(columns[i:], start=i):
            cov[i, j] = cov[j, i] = row[f"cov_{a}_{b}"]
    values, vectors = np.linalg.eigh(cov)
    spread = (vectors * np.sqrt(np.clip(values, 0.0, None) * size)).T
    points = np.concatenate([mean + spread, mean - spread])
    arrays = {c: points[:, i] for i, c in enumerate(columns)}
    return pa.table({**arrays, "weight": np.full(len(points), row["n"] / len(points))})


def fit_sector_models(
    frame: DataFrame, inputs=FEATURES, label: str = "close", key: str = "sector", **params
) -> dict[str, LinearRegressionModel]:
    """One fitted elastic net per sector from a single pass over the bars.

    The solver works on second moments only. So the moments of all sectors are
    aggregated in one job, and each model is fitted on a handful of weighted
    points that have exactly these moments: same normal equations, same
    iterations, same coefficients as a fit on the rows, without a scan per
    sector. What reaches the driver is one row of sums per sector.
    """
    spark = frame.sparkSession
    columns = [*inputs, label]
    regression = LinearRegression(
        featuresCol="features", labelCol=label, weightCol="weight", **{**ELASTIC_NET, **params}
    )

    def fit(row) -> tuple[str, LinearRegressionModel]:
        points = spark.createDataFrame(_moment_points(row, columns)).coalesce(1)
        return row[key], regression.fit(assemble(points, inputs))

    rows = moments(frame, inputs, label, key).collect()
    if not rows:
        return {}
    # the fits wait on small jobs; side by side they take the time of one.
    # Each is wrapped by itself: fits that share one set of local properties clear each other's
    tasks = [inheritable_thread_target(spark)(partial(fit, row)) for row in rows]
    pool = ThreadPool(min(8, len(rows)))
    try:
        return dict(pool.map(lambda task: task(), tasks))
    finally:
        pool.close()


def fit_one(frame: DataFrame, inputs=FEATURES, label: str = "close", **params) -> LinearRegressionModel:
    """The elastic net fitted on the rows of a single sector."""
    regression = LinearRegression(featuresCol="features", labelCol=label, **{**ELASTIC_NET, **params})
    return regression.fit(assemble(frame, inputs).select("features", label))


def coefficient_frame(
    spark: SparkSession, models: dict[str, LinearRegressionModel], inputs=FEATURES, key: str = "sector"
) -> DataFrame:
    """The models as a small dimension: intercept and one coefficient per feature."""
    names = sorted(models)
    columns = {key: names, "intercept": [float(models[name].intercept) for name in names]}
    for i, feature in enumerate(inputs):
        columns[f"coef_{feature}"] = [float(models[name].coefficients[i]) for name in names]
    return small_frame(spark, columns)


def score(
    frame: DataFrame, coefficients: DataFrame, inputs=FEATURES, key: str = "sector", name: str = "prediction"
) -> DataFrame:
    """Score every sector in one job: coefficients joined by sector, dot product."""
    dot = F.col("intercept")
    for c in inputs:
        dot = dot + F.col(f"coef_{c}") * F.col(c)
    return frame.join(coefficients, key).select(*[F.col(c) for c in frame.columns], dot.alias(name))


def save_models(models: dict[str, LinearRegressionModel], root: str) -> None:
    """Save every fitted model under `{root}/{sector}`, replacing older ones."""
    for name, model in models.items():
        model.write().overwrite().save(f"{root.rstrip('/')}/{name}")


def load_models(root: str, names) -> dict[str, LinearRegressionModel]:
    """Load the models that `save_models` wrote."""
    return {name: LinearRegressionModel.load(f"{root.rstrip('/')}/{name}") for name in names}


def _cov(a: str, b: str, order: list[str]) -> Column:
    first, second = sorted((a, b), key=order.index)
    return F.col(f"cov_{first}_{second}")


def ols_by_key(frame: DataFrame, inputs=FEATURES, label: str = "close", key: str = "sector") -> DataFrame:
    """Least squares with three features in closed form, one job for all keys."""
    order = [*inputs, label]
    a = [[_cov(r, c, order) for c in inputs] for r in inputs]
    y = [_cov(r, label, order) for r in inputs]

    def det(m) -> Column:
        return (
            m[0][0] * (m[1][1] * m[2][2] - m[1][2] * m[2][1])
            - m[0][1] * (m[1][0] * m[2][2] - m[1][2] * m[2][0])
            + m[0][2] * (m[1][0] * m[2][1] - m[1][1] * m[2][0])
        )

    solved = moments(frame, inputs, label, key)
    for i, name in enumerate(inputs):
        replaced = [[y[r] if c == i else a[r][c] for c in range(3)] for r in range(3)]
        solved = solved.withColumn(f"coef_{name}", F.try_divide(det(replaced), det(a)))
    intercept = F.col(f"mean_{label}")
    for name in inputs:
        intercept = intercept - F.col(f"coef_{name}") * F.col(f"mean_{name}")
    return solved.select(key, "n", intercept.alias("intercept"), *[f"coef_{c}" for c in inputs])


def trend_by_key(frame: DataFrame, feature: str = "open", label: str = "close", key: str = "sector") -> DataFrame:
    """Least squares with one feature."""
    return frame.groupBy(key).agg(
        F.regr_slope(label, feature).alias("slope"), F.regr_intercept(label, feature).alias("intercept")
    )


def elastic_net_of(
    figures: DataFrame,
    keys: list[str],
    inputs=FEATURES,
    label: str = "close",
    regParam: float = ELASTIC_NET["regParam"],
    elasticNetParam: float = ELASTIC_NET["elasticNetParam"],
    sweeps: int = 500,
) -> DataFrame:
    """The converged elastic net of every row of `moments`, or of `rolling_moments`, named by `keys`.

    Coordinate descent on the correlations, as a fold over an array: for many
    keys, where one fit per key would be too many jobs. Standardized features,
    with an intercept, the same objective as the model fit.
    """
    order = [*inputs, label]
    std = {c: F.sqrt(F.col(f"cov_{c}_{c}")) for c in order}
    # a label without spread leaves all coefficients 0
    l1 = F.try_divide(F.lit(regParam * elasticNetParam), F.col("_std"))
    l2 = F.try_divide(F.lit(regParam * (1.0 - elasticNetParam)), F.col("_std"))
    size = len(inputs)

    scaled = figures.withColumn("_std", std[label])
    corr = F.array(
        *[F.array(*[F.try_divide(_cov(r, c, order), std[r] * std[c]) for c in order]) for r in inputs]
    )
    scaled = scaled.withColumn("_corr", corr).withColumn("_l1", l1).withColumn("_l2", l2)

    def update(weights: Column, step: Column) -> Column:
        i = F.pmod(step, F.lit(size))
        row = F.get("_corr", i)
        rest = F.get(row, F.lit(size)) + F.get(weights, i)
        for j in range(size):
            rest = rest - F.get(row, F.lit(j)) * F.get(weights, F.lit(j))
        shrunk = F.signum(rest) * F.greatest(F.abs(rest) - F.col("_l1"), F.lit(0.0))
        new = shrunk / (F.lit(1.0) + F.col("_l2"))
        return F.transform(weights, lambda old, j: F.when(j == i, new).otherwise(old))

    steps = F.sequence(F.lit(0), F.lit(sweeps * size - 1))
    start = F.array(*[F.lit(0.0)] * size)
    fitted = scaled.withColumn("_weights", F.aggregate(steps, start, update))
    for i, name in enumerate(inputs):
        fitted = fitted.withColumn(
            f"coef_{name}", F.coalesce(F.try_divide(F.col("_weights")[i] * F.col("_std"), std[name]), F.lit(0.0))
        )
    intercept = F.col(f"mean_{label}")
    for name in inputs:
        intercept = intercept - F.col(f"coef_{name}") * F.col(f"mean_{name}")
    return fitted.select(*keys, "n", intercept.alias("intercept"), *[f"coef_{c}" for c in inputs])


def elastic_net_by_key(frame: DataFrame, inputs=FEATURES, label: str = "close", key: str = "sector", **params) -> DataFrame:
    """The converged elastic net of every key as one Spark job (`params` as for `elastic_net_of`)."""
    return elastic_net_of(moments(frame, inputs, label, key), [key], inputs, label, **params)


def rolling_moments(
    frame: DataFrame, span: int, inputs=FEATURES, label: str = "close", key: str = "sector", time: str = "timestamp"
) -> DataFrame:
    """`moments` of every key over the `span` up to each of its times, that time included, the other end not.

    The sums of a time are added to a running total when it enters the window and
    taken back when it leaves, so the window slides without reading a row twice. The bars are
    summed by key and time first: what is ordered are two rows per time, bounded by
    the calendar. Values are taken from the mean of their key, so that the difference
    of sums keeps its digits. Rows that lack the key, the time or a value are left out.
    """
    columns = [*inputs, label]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    complete = frame.dropna(subset=[key, time, *columns])
    middles = settle(complete.groupBy(key).agg(*[F.avg(c).alias(f"_mid_{c}") for c in columns]), "middles")
    off = {c: F.col(c) - F.col(f"_mid_{c}") for c in columns}
    sums = {f"_sum_{c}": F.sum(off[c]) for c in columns} | {f"_sum_{a}_{b}": F.sum(off[a] * off[b]) for a, b in pairs}
    daily = complete.join(middles, key).groupBy(key, time).agg(
        F.count(F.lit(1)).alias("n"), *[total.alias(name) for name, total in sums.items()]
    )
    turn = F.explode(F.array(*[F.struct((F.col(time) + d).alias("at"), F.lit(s).alias("sign")) for d, s in ((0, 1), (span, -1))]))
    turns = daily.withColumn("_turn", turn).groupBy(key, F.col("_turn.at").alias(time)).agg(
        F.max("_turn.sign").alias("_enters"), *[F.sum(F.col(c) * F.col("_turn.sign")).alias(c) for c in ("n", *sums)]
    )
    running = Window.partitionBy(key).orderBy(time).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    slid = turns.withColumns({c: F.sum(c).over(running) for c in ("n", *sums)}).where("_enters = 1")

    def cov(a: str, b: str) -> Column:
        square = F.col(f"_sum_{a}_{b}") / F.col("n")
        value = square - F.col(f"_sum_{a}") * F.col(f"_sum_{b}") / (F.col("n") * F.col("n"))
        # a window of equal values leaves rounding only
        return F.when((F.col("n") > 1) & (value > square * 1e-12), value).otherwise(0.0) if a == b else value

    return slid.join(middles, key).select(
        key,
        time,
        "n",
        *[(F.col(f"_mid_{c}") + F.col(f"_sum_{c}") / F.col("n")).alias(f"mean_{c}") for c in columns],
        *[cov(a, b).alias(f"cov_{a}_{b}") for a, b in pairs],
    )


def elastic_net_rolling(
    frame: DataFrame, span: int, inputs=FEATURES, label: str = "close", key: str = "sector", time: str = "timestamp", **params
) -> DataFrame:
    """The converged elastic net of every key at each of its times, fitted on the `span` up to it."""
    return elastic_net_of(rolling_moments(frame, span, inputs, label, key, time), [key, time], inputs, label, **params)


def standard_scale(frame: DataFrame, column: str, key: str = "sector", name: str | None = None) -> DataFrame:
    """Centre by the mean and divide by the sample standard deviation of each key.

    As with any scaler the figures are fitted first: one row per key, settled, so
    that Spark knows its size and joins it to the rows without shuffling them.
    """
    fitted = settle(
        frame.groupBy(key).agg(F.avg(column).alias("_mean"), F.stddev_samp(column).alias("_std")), "scaler"
    )
    # a constant column scales to zero
    scaled = F.when(F.col("_std") == 0, F.lit(0.0)).otherwise(
        (F.col(column) - F.col("_mean")) / F.col("_std")
    )
    return frame.join(fitted, key).select(
        *[F.col(c) for c in frame.columns], scaled.alias(name or f"scaled_{column}")
    )


def fit_scaled_regression(frame: DataFrame, feature: str = "close", label: str = "Output") -> PipelineModel:
    """Vector of one column, standard scaler with mean and deviation, ridge regression."""
    stages = [
        VectorAssembler(inputCols=[feature], outputCol="features"),
        StandardScaler(inputCol="features", outputCol="scaled_features", withMean=True, withStd=True),
        LinearRegression(featuresCol="scaled_features", labelCol=label, regParam=0.1, maxIter=100),
    ]
    return Pipeline(stages=stages).fit(frame.select(feature, label))
