"""Compiled forests against Spark ML's own scores."""

import math

import pytest
from pyspark.sql import functions as F

from stratum.operators import forests as Fo
from stratum.operators import models as Mo
from stratum.session import written

def cols():
    return [F.col(c) for c in Mo.FEATURES]


@pytest.fixture(scope="module")
def trips(spark):
    """Whole numbers and fractions, missing and odd values."""
    df = spark.range(600).select(
        F.col("id").alias("trip_id"), (F.pmod(F.xxhash64("id"), F.lit(400)) / 20).alias("trip_distance"),
        *[F.pmod(F.xxhash64("id", F.lit(i)), F.lit(n)).cast("int").alias(c) for i, (c, n) in enumerate(
            [("passenger_count", 6), ("hour_of_day", 24), ("day_of_week", 7), ("is_rush_hour", 2), ("is_weekend", 2)])])
    df = df.withColumn("fare_amount", 3 + 2.5 * F.col("trip_distance") + F.col("is_rush_hour") + F.col("trip_id") % 5)
    return written(df.withColumn("tip_amount", F.col("fare_amount") * 0.1 + F.col("hour_of_day")), "forest-trips")


@pytest.fixture(scope="module")
def models(trips):
    return Mo.train_fare(trips, num_trees=7, max_depth=6)[0], Mo.train_tip(trips, num_trees=5, max_depth=5)


def test_compiled_scores_are_the_models_own(spark, trips, models):
    fare, tip = models[0], models[1][0]
    fj, tj = Fo.compile_forest(spark, fare), Fo.compile_forest(spark, tip)
    rows = fare.transform(trips).withColumnRenamed("prediction", "fare_model").drop("features")
    rows = Mo.with_class_probs(tip.transform(rows))
    rows = Fo.with_forests(rows, fj, tj).withColumn("p", Fo.forest_probabilities(tj, [F.col("fare_amount"), *cols()]))
    for r in rows.collect():
        assert r.predicted_fare == max(0.0, r.fare_model)
        assert r.p == r.probabilities and r.predicted_tip_category == r.class_name


def test_sql_functions(spark, trips, models):
    Fo.register_model_functions(spark, models[0], models[1][0])
    args = "trip_distance, passenger_count, hour_of_day, day_of_week, is_rush_hour, is_weekend"
    trips.createOrReplaceTempView("forest_trips")
    q = spark.sql(f"SELECT *, predict_taxi_fare({args}) AS f, predict_tip_category(fare_amount, {args}) AS c FROM forest_trips "
                  f"WHERE predict_taxi_fare({args}) > 10")
    assert "Python" not in q._jdf.queryExecution().executedPlan().toString()
    want = {r.trip_id: (max(0.0, r.prediction)) for r in models[0].transform(trips).collect()}
    got = {r.trip_id: r.f for r in q.collect()}
    assert got == {k: v for k, v in want.items() if v > 10} and got
    assert {r.c for r in q.collect()} <= set(Mo.TIP_LABELS)
    # defaults 1, 12, 3, 0, 0; no distance or no fare gives no answer
    a, b, c, d, e = spark.sql("""SELECT predict_taxi_fare(2.5, NULL, NULL, NULL, NULL, NULL), predict_taxi_fare(2.5, 1, 12, 3, 0, 0),
      predict_taxi_fare(NULL, 1, 12, 3, 0, 0), predict_tip_category(NULL, 2.5, 1, 12, 3, 0, 0),
      predict_tip_category(9.0, 2.5, NULL, NULL, NULL, NULL, NULL)""").first()
    assert a == b and c is None and d is None and e in Mo.TIP_LABELS


def test_missing_features_go_right(spark, trips, models):
    """Without the defaults a NULL is NaN, as the assembler has it."""
    odd = spark.createDataFrame([(float("nan"), 1, 2, 3, 0, 1), (None, None, None, None, None, None), (1e9, -5, 99, 0, 1, 1)],
                                "trip_distance double, passenger_count int, hour_of_day int, day_of_week int, is_rush_hour int, is_weekend int")
    f = Fo.compile_forest(spark, models[0])
    for r in models[0].transform(odd).withColumn("v", Fo.forest_value(f, cols())).collect():
        assert r.v == r.prediction and math.isfinite(r.v)


def test_tip_training_reports_metrics_and_importance(models):
    _, pred, metrics, importance = models[1]
    m = {r.metric: r.value for r in metrics.collect()}
    rows = pred.select("tip_category", "prediction").collect()
    assert abs(m["accuracy"] - sum(r.tip_category == r.prediction for r in rows) / len(rows)) < 1e-9 and 0 <= m["f1"] <= 1
    imp = {r.feature: r.importance for r in importance.collect()}
    assert set(imp) == {"fare_amount", *Mo.FEATURES} and abs(sum(imp.values()) - 1) < 1e-9


def test_few_partitions_are_spread_over_the_cores(spark):
    df = spark.range(1000).coalesce(1)
    some = Mo.spread(df, rows=200)
    assert some.rdd.getNumPartitions() == 5 and sorted(r.id for r in some.collect()) == list(range(1000))
    assert Mo.spread(df, rows=10).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    assert Mo.spread(df).rdd.getNumPartitions() == 1


def test_packed_forest_gives_the_models_scores(spark, trips, models):
    f = Fo._packed(Fo.compile_forest(spark, models[0]))
    assert len(set(f["tests"])) == len(f["tests"]) < len(f["child"]) and len(f["roots"]) == 7
    for r in models[0].transform(trips.limit(100)).collect():
        bits = [int(not r[Mo.FEATURES[i]] <= x) for i, x in f["tests"]] + [0]
        total = 0.0
        for node in f["roots"]:
            for _ in range(f["depth"]):
                node = f["child"][node] + bits[f["asks"][node]]
            total += f["values"][0][node]
        assert total / 7 == r.prediction


def test_sql_functions_on_odd_features(spark, trips, models):
    Fo.register_model_functions(spark, models[0], models[1][0])
    odd = spark.createDataFrame([(x, 1, 2, 3, 0, 1, y) for x in (float("nan"), float("inf"), -float("inf"), -0.0) for y in (5.0, float("nan"), -1e300)],
                                "trip_distance double, passenger_count int, hour_of_day int, day_of_week int, is_rush_hour int, is_weekend int, fare_amount double")
    rows = models[0].transform(odd).withColumnRenamed("prediction", "fare_model").drop("features")
    args = ", ".join(Mo.FEATURES)
    rows = Mo.with_class_probs(models[1][0].transform(rows)).withColumn("f", F.expr(f"predict_taxi_fare({args})")).withColumn(
        "c", F.expr(f"predict_tip_category(fare_amount, {args})"))
    for r in rows.collect():
        assert r.f == max(0.0, r.fare_model) and r.c == r.class_name


def test_training_keeps_the_nodes_of_rows_and_the_forest(trips, models):
    """The node that a row has reached in each tree is kept from level to level; the forest is that of walks from the roots."""
    for model, label in ((models[0], "fare_amount"), (models[1][0], "tip_category")):
        assert model.stages[-1].getCacheNodeIds() and model.stages[-1].getLabelCol() == label
    from pyspark.ml import Pipeline
    from pyspark.ml.regression import RandomForestRegressor
    plain = RandomForestRegressor(labelCol="fare_amount", numTrees=7, maxDepth=6, minInstancesPerNode=5, seed=42)
    train = Mo.spread(trips).randomSplit([0.8, 0.2], seed=42)[0]
    nodes = [m.stages[-1].toDebugString.split("\n", 1)[1] for m in (models[0], Pipeline(stages=[Mo._assembler(), plain]).fit(train))]
    assert nodes[0] == nodes[1]
