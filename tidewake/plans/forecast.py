"""Daily pollution forecast per series: random forests, recursive prediction, uncertainty bands.

Fitted forests become a table of tree nodes. The recursion over the horizon runs
in the executors, one task per series: each tree carries its own line of
predictions, and one more line carries the mean of all trees.
"""

from __future__ import annotations

import sys
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import RandomForestRegressionModel, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewake.operators.temporal import future_calendar, lag_features, trailing_values
from tidewake.session import shared_dir

# Python workers may not have the library on their path.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LAGS = (1, 7, 14)
FEATURES = ["day_of_week", "month", "day", "lag_1", "lag_7", "lag_14"]
HORIZON = 31
BAND = 1.96


def forecast_features(daily: DataFrame, series: str = "country", exclude: str = "INTERNATIONAL") -> DataFrame:
    """Training rows of all series but the excluded one."""
    return lag_features(daily.where(F.col(series) != exclude), series, "date", "pollution", LAGS)


def _assemble(features: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(features)


def fit_forests(
    features: DataFrame, series: str = "country", trees: int = 100, seed: int = 42, max_depth: int = 30,
    max_bins: int = 1024, parallelism: int = 4, bootstrap: bool = True,
) -> dict[str, RandomForestRegressionModel]:
    """One random forest per series, each fitted as Spark jobs; several are in flight at a time.

    Without ``bootstrap`` every tree sees all rows, so the fit is the same under any seed.

    Series are countries: the loop grows with their number, not with the reports.
    Trees grow as deep as Spark allows (30 levels), and with a bin per value up
    to 1,024 days, so that splits are as fine as the data.
    """
    assembled = _assemble(features).select(series, "features", "pollution").persist()
    names = [row[0] for row in assembled.select(series).distinct().orderBy(series).collect()]
    forest = RandomForestRegressor(
        labelCol="pollution", numTrees=trees, seed=seed, maxDepth=max_depth, maxBins=max_bins, featureSubsetStrategy="all", bootstrap=bootstrap,
    )
    try:
        with ThreadPoolExecutor(parallelism) as pool:
            models = pool.map(lambda name: forest.fit(assembled.where(F.col(series) == name)), names)
            return dict(zip(names, models))
    finally:
        assembled.unpersist()


def in_sample_fit(models: dict[str, RandomForestRegressionModel], features: DataFrame, series: str = "country") -> DataFrame:
    """Model values beside the observed ones."""
    assembled = _assemble(features)
    fitted = None
    for name, model in models.items():
        part = model.transform(assembled.where(F.col(series) == name)).select(
            series, "date", "pollution", F.col("prediction").alias("fitted")
        )
        fitted = part if fitted is None else fitted.unionByName(part)
    return fitted


def forest_nodes(spark: SparkSession, models: dict[str, RandomForestRegressionModel], series: str = "country", kind: str = "string") -> DataFrame:
    """All nodes of the forests: series, ``tree``, ``id``, ``prediction``, ``left``, ``right`` (-1 at leaves), ``feature`` and ``threshold``.

    The executors write them, as Spark's saved form of the models, to the shared folder.
    """
    base = shared_dir(spark, "forests")
    names = list(models.items())
    for number, (_, model) in enumerate(names):
        model.save(f"{base}/number={number}")
    nodes = spark.read.option("basePath", base).parquet(f"{base}/number=*/data")
    named = spark.createDataFrame([(k, name) for k, (name, _) in enumerate(names)], f"number int, {series} {kind}")
    return nodes.join(named, "number").select(
        series, F.col("treeID").alias("tree"), "nodeData.id", "nodeData.prediction", F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"), F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
    )


class Forest:
    """Trees as flat arrays: children of all nodes, and where each tree's root is."""

    def __init__(self, nodes: pd.DataFrame):
        nodes = nodes.sort_values(["tree", "id"])
        trees, first = np.unique(nodes["tree"].to_numpy(), return_index=True)
        # Nodes of a tree are numbered from 0 without gaps.
        start = np.repeat(first, np.diff(np.append(first, len(nodes))))
        self.roots, self.value = first, nodes["prediction"].to_numpy()
        self.left, self.right = (start + nodes[c].to_numpy() for c in ("left", "right"))
        self.inner = nodes["left"].to_numpy() >= 0
        self.feature, self.threshold = nodes["feature"].to_numpy(), nodes["threshold"].to_numpy()

    def __call__(self, vectors: np.ndarray) -> np.ndarray:
        """Each tree's value for its own vector, [tree, feature]."""
        at, lane = self.roots, np.arange(len(self.roots))
        while (going := self.inner[at]).any():
            # Leaves have no feature; any will do, since they stay.
            seen = vectors[lane, np.maximum(self.feature[at], 0)]
            at = np.where(going, np.where(seen <= self.threshold[at], self.left[at], self.right[at]), at)
        return self.value[at]


def recursion(forest: Callable[[np.ndarray], np.ndarray], trees: int, calendar: np.ndarray, trailing: np.ndarray) -> np.ndarray:
    """Day by day predictions [day, line]: a line for each tree and a last one for their mean, each feeding its own lags.

    ``forest`` maps one vector per tree to one value per tree.

    Observed values come first, then a line's own predictions: lag k of step i is
    entry i - k. ``calendar`` has step, weekday, month and day.
    """
    known = len(trailing)
    lines = np.tile(np.asarray(trailing, float)[:, None], (1, trees + 1))
    for step, *date in calendar:
        lags = lines[[known + int(step) - k for k in LAGS]]
        vectors = np.concatenate([np.tile(np.asarray(date, float)[:, None], (1, trees + 1)), lags]).T
        lines = np.vstack([lines, np.append(forest(vectors[:-1]), forest(np.tile(vectors[-1], (trees, 1))).mean())])
    return lines[known:]


def forecast(
    models: dict[str, RandomForestRegressionModel], daily: DataFrame, series: str = "country", horizon: int = HORIZON,
    offset: int = 0,
) -> DataFrame:
    """(series, date, prediction, std, lower, upper) for ``horizon`` days.

    The first day is the last observed one (``offset=0``), whose lags are then a
    day late; ``offset=1`` starts on the day after. ``std`` is the population
    deviation between the trees, each of which runs its own recursion. A task
    has the forest, the last two weeks and the calendar of one series.
    """
    kind = daily.schema[series].dataType.simpleString()
    nodes = forest_nodes(daily.sparkSession, models, series, kind)
    past = trailing_values(daily, series, "date", "pollution", max(LAGS)).where(F.size("trailing") == max(LAGS))
    calendar = future_calendar(daily, series, "date", horizon, offset).join(past, series)

    def ahead(nodes: pd.DataFrame, days: pd.DataFrame) -> pd.DataFrame:
        if nodes.empty or days.empty:
            return pd.DataFrame({series: [], "date": [], "prediction": [], "std": []})
        days = days.sort_values("step")
        forest = Forest(nodes)
        lines = recursion(forest, len(forest.roots), days[["step", "day_of_week", "month", "day"]].to_numpy(), days["trailing"].iloc[0])
        return pd.DataFrame({series: days[series], "date": days["date"], "prediction": lines[:, -1], "std": lines[:, :-1].std(axis=1)})

    found = nodes.groupBy(series).cogroup(calendar.groupBy(series)).applyInPandas(ahead, f"{series} {kind}, date date, prediction double, std double")
    return banded(found)


def banded(found: DataFrame) -> DataFrame:
    """Add the 95 % band around ``prediction``."""
    half = F.lit(BAND) * F.col("std")
    return found.withColumns({"lower": F.col("prediction") - half, "upper": F.col("prediction") + half})


def with_band(mean: DataFrame, members: DataFrame, series: str = "country") -> DataFrame:
    """Add the population deviation of the ensemble members and the 95 % band to a mean prediction."""
    spread = members.groupBy(series, "date").agg(F.stddev_pop("prediction").alias("std"))
    return banded(mean.join(spread, [series, "date"]).select(series, "date", "prediction", "std"))


def with_last_actual(forecasted: DataFrame, daily: DataFrame, series: str = "country") -> DataFrame:
    """The forecast with the last observed value (deviation 0) in front of each series."""
    last = daily.groupBy(series).agg(F.max("date").alias("date"), F.max_by("pollution", "date").alias("prediction"))
    last = last.join(forecasted.select(series).distinct(), series, "left_semi")
    actual = last.select(
        series, "date", "prediction", F.lit(0.0).alias("std"), F.col("prediction").alias("lower"),
        F.col("prediction").alias("upper"), F.lit("actual").alias("kind"),
    )
    return actual.unionByName(forecasted.withColumn("kind", F.lit("forecast")))


def common_scale(features: DataFrame, forecasted: DataFrame, series: str = "country") -> DataFrame:
    """One row: lowest and highest value over all series, for charts that share an axis.

    Bands count per series with its largest (upper) and smallest (lower) deviation.
    """
    seen = features.groupBy(series).agg(F.max("pollution").alias("_hi"), F.min("pollution").alias("_lo"))
    ahead = forecasted.groupBy(series).agg(
        (F.max("prediction") + F.lit(BAND) * F.max("std")).alias("_fhi"),
        (F.min("prediction") - F.lit(BAND) * F.min("std")).alias("_flo"),
    )
    return seen.join(ahead, series, "left").agg(
        F.greatest(F.lit(0.0), F.max(F.greatest("_hi", "_fhi"))).alias("max_pollution"),
        F.min(F.least("_lo", "_flo")).alias("min_pollution"),
    )


def backtest(fitted: DataFrame) -> dict[str, float]:
    """MAE and RMSE of fitted against observed values."""
    evaluator = RegressionEvaluator(labelCol="pollution", predictionCol="fitted")
    return {name: evaluator.evaluate(fitted, {evaluator.metricName: name}) for name in ("mae", "rmse")}


def backtest_by_series(fitted: DataFrame, series: str = "country") -> DataFrame:
    """The same per series, in one aggregation."""
    error = F.col("fitted") - F.col("pollution")
    return fitted.groupBy(series).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"), F.count(F.lit(1)).alias("days"),
    )


@dataclass(frozen=True)
class ForecastJob:
    """Fitted forests of a daily pollution table. The fit and the forecast are only worked out when asked for."""

    daily: DataFrame
    features: DataFrame
    models: dict[str, RandomForestRegressionModel] = field(repr=False)

    def fitted(self) -> DataFrame:
        return in_sample_fit(self.models, self.features)

    def ahead(self, horizon: int = HORIZON, offset: int = 0) -> DataFrame:
        return forecast(self.models, self.daily, horizon=horizon, offset=offset)


def forecast_job(daily: DataFrame, exclude: str = "INTERNATIONAL", **forest) -> ForecastJob:
    """Forests for all countries of a daily pollution table but the excluded one; ``forest`` goes to ``fit_forests``."""
    features = forecast_features(daily, exclude=exclude)
    return ForecastJob(daily.where(F.col("country") != exclude), features, fit_forests(features, **forest))
