"""Shape of the physical plans, and the forecast."""

import datetime as dt
import statistics

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidewake.functions import geo
from tidewake.operators import lookups, spatial, temporal
from tidewake.plans import forecast as fc
from tidewake.plans import pollution as pp
from tidewake.plans.destinations import normalize_destinations


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def method_sizes(spark, build):
    """Byte code sizes of the generated methods; stages exist up front only without adaptive execution."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = build()
        debug = spark.sparkContext._jvm.org.apache.spark.sql.execution.debug
        module = getattr(getattr(debug, "package$"), "MODULE$")
        found, stages = [], module.codegenStringSeq(df._jdf.queryExecution().executedPlan()).iterator()
        while stages.hasNext():
            found.append(stages.next()._3().maxMethodCodeSize())
        return found
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.fixture
def stored(spark, fx, tmp_path):
    """Augmented positions and 44 ports as tables on disk, as in production."""
    mode = F.when(F.col("id") % 2 == 0, "Cruise").otherwise("Berth")
    rates = [F.lit(float(i)).alias(c) for i, c in enumerate(lookups.EMISSIONS)]
    fx.positions.select("*", mode.alias("operation_mode"), *rates).write.parquet(str(tmp_path / "positions"))
    ports = spark.range(44).select(
        F.col("id").cast("int").alias("port_id"), F.concat(F.lit("P"), "id").alias("port_name"), F.lit("NL").alias("country"),
        (50 + F.col("id") / 5).alias("latitude"), (F.col("id") / 4).alias("longitude"))
    return spark.read.parquet(str(tmp_path / "positions")), ports


def test_pollution_exchanges_its_reports_once(spark, stored):
    """Reports go through one exchange, by ship, and their days and countries through another; few columns are read."""
    positions, ports = stored
    daily = pp.daily_pollution(pp.pollution(positions, ports))
    text = plan(daily)
    assert text.count("Exchange hashpartitioning") == 2 and "rangepartitioning" not in text
    assert "NestedLoop" not in text and "CartesianProduct" not in text
    assert text.count("FileScan parquet") == 1
    scan = text.split("FileScan parquet")[1].split("\n")[0]
    assert "destination" not in scan and "true_heading" not in scan


def test_generated_methods_stay_compilable(spark, stored):
    positions, ports = stored
    builds = [
        lambda: spatial.nearest_site(positions, ports),
        lambda: pp.daily_pollution(pp.pollution(positions, ports)),
        lambda: normalize_destinations(positions, lookup=False).where("destination IS NOT NULL").groupBy("destination").count(),
    ]
    for build in builds:
        assert max(method_sizes(spark, build)) < 8000


def test_box_reaches_the_scan(spark, stored):
    boxed = stored[0].where(geo.within_bbox(F.col("latitude"), F.col("longitude"), geo.STUDY_BOX)).select("id")
    spark.conf.set("spark.sql.maxMetadataStringLength", "1000")
    text = plan(boxed)
    assert "GreaterThanOrEqual(latitude,51.0)" in text and "LessThanOrEqual(longitude,9.0)" in text


def test_large_keys_are_cut(stored):
    """Rows are windowed per (key, piece); over whole keys run only the summaries, of one row a piece."""
    text = plan(temporal.hours_since_previous(stored[0], piece_rows=5).select("id", "time_diff"))
    windows = [line for line in text.split("\n") if "- Window [" in line]
    assert len(windows) == 2 and sum("_piece" in w.split("], [")[1] for w in windows) == 1


def test_country_rules_as_published_never_apply(spark, fx):
    placed = fx.positions.withColumn("operation_mode", F.lit("Cruise"))
    assert pp.discharge_allowed(placed, fx.ports, port_rules=()).where("NOT discharge_allowed").count() == 0


# ------------------------------------------------------------------- forecast

@pytest.fixture(scope="module")
def daily(spark):
    rows = [
        (dt.date(2024, 1, 1) + dt.timedelta(days=d), c, float(100 * i + (d % 7) * 10 + d))
        for i, c in enumerate(["NL", "DE", "INTERNATIONAL"]) for d in range(45)
    ]
    return spark.createDataFrame(rows, "date date, country string, pollution double")


@pytest.fixture(scope="module")
def job(spark, daily):
    return fc.forecast_job(daily, trees=7)


def test_forecast_shape(job, daily):
    ahead = job.ahead()
    assert job.features.count() == 2 * 31 and job.fitted().count() == 2 * 31
    rows = ahead.orderBy("country", "date").collect()
    assert len(rows) == 2 * 31 and {r["country"] for r in rows} == {"NL", "DE"}
    assert rows[0]["date"] == dt.date(2024, 2, 14)
    assert all(r["std"] >= 0 and r["lower"] <= r["prediction"] <= r["upper"] for r in rows)
    extended = fc.with_last_actual(ahead, daily)
    assert extended.count() == 2 * 32 and extended.where("kind = 'actual' AND std = 0").count() == 2


def test_forecast_repeats_under_seed(spark, daily, job):
    again = fc.forecast_job(daily, trees=7).ahead()
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, job.ahead().collect()))


def test_recursion_follows_the_lag_rule():
    # One tree: 10 where lag_7 is at most 50, 90 otherwise.
    past = [float(v) for v in (0, 0, 0, 0, 0, 0, 0, 40, 60, 40, 60, 40, 60, 40)]
    calendar = np.array([(i, 0, 1, 1) for i in range(10)])
    lines = fc.recursion(lambda x: np.where(x[:, 4] <= 50, 10.0, 90.0), 1, calendar, past)
    assert lines[:, 0].tolist() == lines[:, 1].tolist() == [10, 90, 10, 90, 10, 90, 10, 10, 90, 10]


def driver_loop(model, past, first, offset, horizon=31):
    """Day by day, vector by vector, with the model's own ``predict``."""
    line = list(past)
    for step in range(horizon):
        day = first + dt.timedelta(days=offset + step)
        lags = [line[len(past) + step - k] for k in fc.LAGS]
        line.append(model.predict(Vectors.dense([day.weekday(), day.month, day.day, *lags])))
    return line[len(past):]


@pytest.mark.parametrize("offset", [0, 1])
def test_forecast_equals_the_models_own_predictions(job, daily, offset):
    """Every tree runs its own recursion, the mean of all trees another; values agree with a loop over the fitted models."""
    found = job.ahead(offset=offset).collect()
    for country, model in job.models.items():
        past = [r["pollution"] for r in daily.where(F.col("country") == country).orderBy("date").collect()]
        rows = sorted((r for r in found if r["country"] == country), key=lambda r: r["date"])
        own = (past[-14:], dt.date(2024, 2, 14), offset)
        assert [r["prediction"] for r in rows] == pytest.approx(driver_loop(model, *own), abs=1e-9)
        trees = zip(*(driver_loop(tree, *own) for tree in model.trees))
        assert [r["std"] for r in rows] == pytest.approx([statistics.pstdev(values) for values in trees], abs=1e-9)
        assert len({len(t._call_java("toDebugString")) for t in model.trees}) > 1  # the trees differ


def test_forecast_loops_over_nothing_on_the_driver(job, monkeypatch):
    """No prediction and no rows on the driver: the plan is a grouped map over nodes and calendars."""
    from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressionModel
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    def never(*_):
        raise AssertionError("on the driver")

    for model in (DecisionTreeRegressionModel, RandomForestRegressionModel):
        monkeypatch.setattr(model, "predict", never, raising=False)
    monkeypatch.setattr(Frame, "collect", never)
    ahead = job.ahead()
    assert "FlatMapCoGroupsInPandas" in ahead._jdf.queryExecution().optimizedPlan().toString()


def test_one_series_or_none(daily):
    short = daily.where("country = 'NL'").limit(10)
    assert fc.forecast_job(short, trees=2).models == {}


def test_scale_and_errors(job):
    features, fitted, ahead = job.features, job.fitted(), job.ahead()
    scale = fc.common_scale(features, ahead).first()
    assert scale["max_pollution"] >= ahead.agg(F.max("prediction")).first()[0]
    assert scale["min_pollution"] <= features.agg(F.min("pollution")).first()[0]
    overall, by_series = fc.backtest(fitted), fc.backtest_by_series(fitted).collect()
    assert overall["mae"] == pytest.approx(sum(r["mae"] for r in by_series) / 2)
    assert overall["rmse"] >= overall["mae"] > 0
