"""Regression of precipitation and clustering of stations, with ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from skyledger.operators.ranks import medians

FEATURES = ("snow_avg", "tmax_avg", "tmin_avg")
LABEL = "prcp_avg"
POSITION = ("latitude", "longitude", "elevation")


def drawn(share: float, *keys: str) -> Column:
    """True for ``share`` of the keys, by their digest: no layout or rerun changes it."""
    text = F.concat_ws("|", *[F.col(k).cast("string") for k in keys])
    first = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long")
    return first < round(share * 16**8)


def split(df: DataFrame, *keys: str, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """A share of the keys for training, the others for testing."""
    return df.filter(drawn(train, *keys)), df.filter(~drawn(train, *keys))


def random_split(df: DataFrame, seed: int, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """By chance; the seed repeats it for the same layout of the data only."""
    first, second = df.randomSplit([train, 1 - train], seed)
    return first, second


def complete_cases(df: DataFrame) -> DataFrame:
    return df.na.drop("any")


def impute_medians(
    df: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """Fill missing features with exact medians; rows without a label go.

    Reads ``df`` several times: pass a written table.
    """
    fill = {c: m for c, m in medians(df, list(features)).items() if m is not None}
    labelled = df.filter(F.col(label).isNotNull())
    return labelled.na.fill(fill) if fill else labelled


def assemble(df: DataFrame, features: Sequence[str], output: str = "features") -> DataFrame:
    return VectorAssembler(inputCols=list(features), outputCol=output).transform(df)


def fit_regression(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> LinearRegressionModel:
    return LinearRegression(labelCol=label).fit(assemble(train, features).select("features", label))


def predict(
    model: LinearRegressionModel, df: DataFrame, features: Sequence[str] = FEATURES
) -> DataFrame:
    return model.transform(assemble(df, features)).drop("features")


def regression_report(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str] = FEATURES,
    label: str = LABEL,
) -> DataFrame:
    """One row: intercept, a coefficient per feature, and the RMSE on ``test``."""
    model = fit_regression(train, features, label)
    error = F.col("prediction") - F.col(label)
    return predict(model, test, features).agg(
        F.lit(float(model.intercept)).alias("intercept"),
        *[F.lit(float(c)).alias(f"coef_{f}") for f, c in zip(features, model.coefficients)],
        F.sqrt(F.avg(error * error)).alias("rmse"),
    )


def line_report(df: DataFrame, train: Column, feature: str, label: str) -> DataFrame:
    """The report of a regression on one feature from a single aggregate.

    ``train`` says which rows are fitted; on the others the mean squared error follows
    from the moments of feature and label. Rows with a NULL in either count for nothing.
    """
    known = F.col(feature).isNotNull() & F.col(label).isNotNull()
    rows = df.filter(known).select(
        F.col(feature).alias("x"), F.col(label).alias("y"), train.alias("train")
    )
    fit = {c: F.when(F.col("train"), F.col(c)) for c in ("x", "y")}
    test = {c: F.when(~F.col("train"), F.col(c)) for c in ("x", "y")}
    moments = rows.agg(
        F.regr_slope(fit["y"], fit["x"]).alias("slope"),
        F.regr_intercept(fit["y"], fit["x"]).alias("intercept"),
        F.avg(test["x"]).alias("mx"),
        F.avg(test["y"]).alias("my"),
        F.var_pop(test["x"]).alias("xx"),
        F.var_pop(test["y"]).alias("yy"),
        F.covar_pop(test["x"], test["y"]).alias("xy"),
    )
    off = F.col("my") - F.col("intercept") - F.col("slope") * F.col("mx")
    spread = F.col("yy") - 2 * F.col("slope") * F.col("xy") + F.col("slope") ** 2 * F.col("xx")
    return moments.select(
        "intercept",
        F.col("slope").alias(f"coef_{feature}"),
        F.sqrt(F.greatest(spread, F.lit(0.0)) + off * off).alias("rmse"),
    )


# ---- regression from mergeable moments ----


def _moment_names(features: Sequence[str], label: str) -> list[tuple[str, str | None]]:
    """The sums of a state: of each column, and of each product of two."""
    columns = [*features, label]
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i:]]
    return [(c, None) for c in columns] + pairs


def moment_state(
    rows: DataFrame, train: Column, features: Sequence[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """One row: numbers, sums and sums of products of the training and the test rows.

    Rows with a NULL in a feature or in the label count for nothing. Like (sum, count) the
    states of any split of the rows add up, so a regression needs no second pass over them.
    """
    known = rows.withColumn("train", train).na.drop("any", subset=[*features, label])
    columns = []
    for part, chosen in (("train", F.col("train")), ("test", ~F.col("train"))):
        columns.append(F.count(F.when(chosen, 1)).alias(f"{part}_n"))
        for a, b in _moment_names(features, label):
            value = F.col(a).cast("double") * (F.lit(1.0) if b is None else F.col(b).cast("double"))
            total = F.coalesce(F.sum(F.when(chosen, value)), F.lit(0.0))
            columns.append(total.alias(f"{part}_{a}" if b is None else f"{part}_{a}_x_{b}"))
    return known.agg(*columns)


def merge_moments(states: DataFrame) -> DataFrame:
    return states.agg(*[F.coalesce(F.sum(c), F.lit(0)).cast(t).alias(c) for c, t in states.dtypes])


def _centred(state: dict, part: str, features: Sequence[str], label: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Number of rows, means, and second moments about them."""
    columns = [*features, label]
    n = state[f"{part}_n"]
    mean = np.array([state[f"{part}_{c}"] for c in columns]) / max(n, 1)
    second = np.zeros((len(columns), len(columns)))
    for i, a in enumerate(columns):
        for j in range(i, len(columns)):
            second[i, j] = second[j, i] = state[f"{part}_{a}_x_{columns[j]}"] / max(n, 1)
    return n, mean, second - np.outer(mean, mean)


def regression_from_moments(
    states: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> DataFrame:
    """The report of ``regression_report`` from moments: the normal equations, solved once.

    Only one row of sums comes to the driver. Without training rows all is NULL; without test
    rows the error is. Of features that depend on each other the least coefficients are taken.
    """
    spark = states.sparkSession
    state = merge_moments(states).first().asDict()
    names = ["intercept", *[f"coef_{f}" for f in features], "rmse"]
    schema = ", ".join(f"{n} double" for n in names)
    n, mean, second = _centred(state, "train", features, label)
    if not n:
        return spark.createDataFrame([(None,) * len(names)], schema)
    k = len(features)
    weights = np.linalg.lstsq(second[:k, :k], second[:k, k], rcond=None)[0]
    intercept = float(mean[k] - weights @ mean[:k])
    n, mean, second = _centred(state, "test", features, label)
    error = None
    if n:
        slope = np.append(weights, -1.0)  # prediction less label, but for the intercept
        off = intercept + slope @ mean
        error = float(np.sqrt(max(slope @ second @ slope, 0.0) + off * off))
    return spark.createDataFrame([(intercept, *map(float, weights), error)], schema)


# ---- a model that is kept ----


def fit_pipeline(
    train: DataFrame, features: Sequence[str] = FEATURES, label: str = LABEL
) -> PipelineModel:
    """Assembler, scaler and regression in one model."""
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="raw_features"),
            StandardScaler(inputCol="raw_features", outputCol="features", withStd=True, withMean=False),
            LinearRegression(labelCol=label),
        ]
    ).fit(train)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def score(model: PipelineModel, rows: DataFrame, features: Sequence[str] = FEATURES) -> DataFrame:
    """``rows`` of a table or a stream with ``prediction``; rows that lack a feature go."""
    whole = rows.na.drop("any", subset=list(features))
    return model.transform(whole).drop("raw_features", "features")


def standardise(df: DataFrame, features: Sequence[str], output: str = "zfeatures") -> DataFrame:
    """Divide by the sample standard deviation, without centring."""
    vectors = assemble(df, features)
    scaler = StandardScaler(inputCol="features", outputCol=output, withStd=True, withMean=False)
    return scaler.fit(vectors).transform(vectors).drop("features")


def standardised_columns(df: DataFrame, features: Sequence[str]) -> DataFrame:
    scaled = standardise(df, features).withColumn("z", vector_to_array("zfeatures"))
    return scaled.withColumns({f"z_{f}": F.col("z")[i] for i, f in enumerate(features)}).drop(
        "z", "zfeatures", *features
    )


def fit_clusters(
    stations: DataFrame, k: int = 10, seed: int = 1, features: Sequence[str] = POSITION
) -> tuple[KMeansModel, DataFrame]:
    """K-means of the scaled positions: the model and the stations with ``cluster``."""
    scaled = standardise(stations, features)
    model = KMeans(featuresCol="zfeatures", predictionCol="cluster", k=k, seed=seed).fit(scaled)
    return model, model.transform(scaled)


# ---- clusters that do not depend on chance ----

#: Decimals of scaled positions and of centers, so that the order of sums does not matter.
DECIMALS = 6
ROUNDS = 10

Centers = list[tuple[float, ...]]


def scaled_positions(
    rows: DataFrame, key: str = "station_id", features: Sequence[str] = POSITION
) -> DataFrame:
    """Features divided by their sample standard deviation, rounded."""
    spread = rows.agg(*[F.stddev_samp(f).alias(f) for f in features]).first()
    return rows.select(
        key, *[F.round(F.col(f) / F.lit(spread[f] or 1.0), DECIMALS).alias(f) for f in features]
    )


def _distance(features: Sequence[str], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for f, c in zip(features, center, strict=True):
        total = total + (F.col(f) - F.lit(c)) * (F.col(f) - F.lit(c))
    return total


def farthest_first(
    rows: DataFrame, k: int, key: str = "station_id", features: Sequence[str] = POSITION
) -> Centers:
    """The row with the least key, and then each time the row that is farthest from all chosen.

    The least key decides between equally far ones. One aggregate of one row per center; there
    are fewer than ``k`` if there are fewer different positions.
    """
    values = [F.col(f) for f in features]
    first = rows.agg(F.min(F.struct(F.col(key), *values)).alias("row")).first()["row"]
    centers = [] if first is None else [tuple(first[f] for f in features)]
    while 0 < len(centers) < k:
        distances = [_distance(features, c) for c in centers]
        near = F.least(*distances) if len(distances) > 1 else distances[0]
        row = F.struct((-near).alias("far"), F.col(key), *values)
        found = rows.agg(F.min(row).alias("row")).first()["row"]
        if found["far"] == 0:
            break
        centers.append(tuple(found[f] for f in features))
    return centers


def lloyd(
    rows: DataFrame, centers: Centers, rounds: int = ROUNDS, features: Sequence[str] = POSITION
) -> Centers:
    """Centers after a number of rounds, or fewer if they come to rest. An empty cluster stays."""
    for _ in range(rounds if centers else 0):
        cluster = nearest_center(rows, features, centers).alias("cluster")
        means = rows.groupBy(cluster).agg(*[F.round(F.avg(f), DECIMALS).alias(f) for f in features])
        after = list(centers)
        for row in means.collect():  # at most a row per center
            after[row["cluster"]] = tuple(row[f] for f in features)
        if after == centers:
            break
        centers = after
    return centers


def settled_clusters(
    rows: DataFrame, k: int = 10, rounds: int = ROUNDS, key: str = "station_id",
    features: Sequence[str] = POSITION,
) -> tuple[Centers, DataFrame]:
    """K-means from ``farthest_first``: its centers, and the scaled rows with ``cluster``.

    The same for every layout of the data. Reads ``rows`` once per center and round: pass a
    written table.
    """
    scaled = scaled_positions(rows, key, features)
    centers = lloyd(scaled, farthest_first(scaled, k, key, features), rounds, features)
    if not centers:
        return centers, scaled.withColumn("cluster", F.lit(None).cast("int"))
    return centers, scaled.withColumn("cluster", nearest_center(scaled, features, centers))


def cluster_table(model: KMeansModel, features: Sequence[str] = POSITION) -> DataFrame:
    """A row per cluster: centre in scaled features, size, and the cost of the whole fit."""
    spark = SparkSession.active()
    summary = model.summary
    rows = [
        (i, int(size), float(summary.trainingCost), *map(float, center))
        for i, (center, size) in enumerate(zip(model.clusterCenters(), summary.clusterSizes, strict=True))
    ]
    centers = ", ".join(f"center_{f} double" for f in features)
    return spark.createDataFrame(rows, f"cluster int, size long, cost double, {centers}")


def nearest_center(
    df: DataFrame, features: Sequence[str], centers: Sequence[Sequence[float]]
) -> Column:
    """Index of the nearest of a few given centers; the lowest one on a tie."""
    candidates = []
    for i, center in enumerate(centers):
        distance = F.lit(0.0)
        for f, c in zip(features, center):
            d = df[f] - F.lit(float(c))
            distance = distance + d * d
        candidates.append(F.struct(distance.alias("distance"), F.lit(i).alias("cluster")))
    return F.array_min(F.array(*candidates))["cluster"]
